"""Layouts of files from their bytes: planted ones are found, noise and text are refused."""

import numpy as np
import pytest

from voltplane.sources import layouts


def waves(rnd, n, places, scale):
    t = np.arange(n)[:, None]
    return scale * (np.sin(2 * np.pi * t / rnd.uniform(150, 400, places) + rnd.uniform(0, 6, places)) + rnd.uniform(-3, 3, places)) + 0.002 * scale * rnd.normal(size=(n, places))


PLANTED = [("<f4", 5, 0), ("<f4", 16, 2), (">f4", 7, 0), ("<f8", 3, 0), (">f8", 6, 4), ("<i2", 9, 1), (">i2", 4, 0), ("<i4", 5, 0), (">i4", 8, 3), ("<f4", 80, 0)]


def test_planted_layouts(spark, tmp_path):
    rnd = np.random.default_rng(0)
    rows = []
    for i, (kind, places, lead) in enumerate(PLANTED):
        scale = {"f": 0.7, "i": 5000 if kind[2] == "2" else 3e8}[kind[1]]
        data = bytes(rnd.integers(0, 256, lead, np.uint8)) + np.ascontiguousarray(waves(rnd, 6000, places, scale)).astype(kind).tobytes()
        (tmp_path / f"{i}.bin").write_bytes(data)
        rows.append((str(tmp_path / f"{i}.bin"), len(data)))
    for name, data in (("noise", rnd.integers(0, 256, 200_000, np.uint8).tobytes()), ("flat", bytes(50_000)), ("tiny", b"abc")):
        (tmp_path / name).write_bytes(data)
        rows.append((str(tmp_path / name), len(data)))
    rows.append((str(tmp_path / "empty"), 0))
    got = {r.path.rsplit("/", 1)[1]: r for r in layouts.layouts(spark.createDataFrame(rows, "path string, n_bytes long")).collect()}
    assert len(got) == len(rows)
    found = {i: (got[f"{i}.bin"].type, got[f"{i}.bin"].record, got[f"{i}.bin"].first, got[f"{i}.bin"].reason) for i in range(len(PLANTED))}
    want = {i: (k, int(k[2:]) * n, lead % int(k[2:]), None) for i, (k, n, lead) in enumerate(PLANTED)}
    assert found == want
    assert {got[n].reason for n in ("noise", "flat", "tiny", "empty")} == {"no record length"} and got["noise"].type is None


def test_correlation_against_a_plain_sum(spark, tmp_path, monkeypatch):
    rnd = np.random.default_rng(1)
    b = rnd.integers(0, 256, 500, np.uint8)
    (tmp_path / "x").write_bytes(b.tobytes())
    row = layouts.correlations(spark.createDataFrame([(str(tmp_path / "x"), 500)], "path string, n_bytes long"), 20).first()
    z = np.exp(2j * np.pi * b / 256)
    z = z - z.mean()
    want = [np.mean((np.conj(z[: 500 - k]) * z[k:]).real) for k in range(21)]
    assert row.correlation == pytest.approx([w / want[0] for w in want])


def test_two_singles_are_no_double(spark, tmp_path):
    # running sums whose singles, two by two, move as smoothly as doubles; true doubles stay
    rows, want = [], {}
    for seed in (12, 1771, 1810, 2001, 2236):
        rnd = np.random.default_rng(seed)
        v = rnd.normal(size=(64, 64))
        sums = np.cumsum((v / np.linalg.norm(v, axis=1)[:, None]).astype("<f4").reshape(-1, 8).astype(float), axis=0)
        fine = sums + 1e-9 * rnd.normal(size=sums.shape)
        for kind, lead, values in (("<f4", 0, sums), (">f4", 0, sums), ("<f4", 4, sums), ("<f8", 0, fine), (">f8", 3, fine)):
            name = f"{seed}_{kind[1:]}_{kind[0] == '<'}_{lead}"
            data = bytes(range(lead)) + values.astype(kind).tobytes()
            (tmp_path / name).write_bytes(data)
            rows.append((str(tmp_path / name), len(data)))
            want[name] = (kind, 8 * int(kind[2:]), lead % int(kind[2:]), None)
    got = {r.path.rsplit("/", 1)[1]: (r.type, r.record, r.first, r.reason) for r in layouts.layouts(spark.createDataFrame(rows, "path string, n_bytes long")).collect()}
    assert got == want


def test_halves_over_spans(spark, tmp_path, monkeypatch):
    # every other place is noisy: the lesser score is that of these, whichever half a span begins with
    rnd = np.random.default_rng(3)
    values = np.cumsum(rnd.normal(size=(1600, 8)), axis=0)
    values[:, 1::2] += rnd.normal(size=(1600, 4))
    (tmp_path / "x").write_bytes(values.astype("<f4").tobytes())
    files = spark.createDataFrame([(str(tmp_path / "x"), 4 * values.size)], "path string, n_bytes long")
    records = spark.createDataFrame([(str(tmp_path / "x"), 32)], "path string, record int")
    lesser = []
    for span in (4096, 4100):
        monkeypatch.setattr(layouts, "SPAN", span)
        scores = {(r.type, r.first): r for r in layouts.layout_scores(files, records).collect()}
        assert scores["<f8", 0].halves == scores["<f8", 4].halves and scores["<f8", 3].halves < 0.05 and scores["<f4", 0].halves == 0
        lesser.append(scores["<f8", 0].halves)
    assert lesser[0] == pytest.approx(lesser[1], abs=0.03) and 0.05 < lesser[0] < scores["<f4", 0].score - 0.1
