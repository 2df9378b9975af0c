"""MDF 4 files: round trips at any block bounds and packings, and files that can't be read."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.sources import mdf4


def columns(n, rnd):
    return {
        "t": np.arange(n) * 0.25,
        "Current": rnd.normal(size=n).astype("<f4"),
        "Count": rnd.integers(0, 60000, n).astype("<u2"),
        "Big": rnd.normal(size=n).astype(">f8"),
        "Level": rnd.integers(-99, 99, n).astype("<i1"),
    }


@pytest.mark.parametrize("way", [None, 0, 1])
@pytest.mark.parametrize("block_bytes", [17, 23 * 10, 1000, 1 << 20])
def test_round_trip(spark, tmp_path, way, block_bytes):
    rnd = np.random.default_rng(0)
    made = {f"f{i}.mf4": columns(n, rnd) for i, n in enumerate((100, 1, 0))}
    for name, c in made.items():
        mdf4.write_mdf4(str(tmp_path / name), c, block_bytes=block_bytes, way=way, units={"Current": "A"}, linear={"Count": (-5.0, 0.5)})
    files = mdf4.listed(spark, str(tmp_path / "*.mf4"))
    blocks = mdf4.data_blocks(files).where("path like '%f0.mf4'").collect()
    assert len(blocks) == -(-2300 // block_bytes) and {b.kind for b in blocks} == {"DT" if way is None else "DZ"}
    got = {}
    for r in mdf4.tall(mdf4.read_mdf4(files, tasks=4)).collect():
        got.setdefault((r.path.rsplit("/", 1)[1], r.channel), {})[r.record] = (r.t, r.value, r.unit)
    assert set(got) == {(f, c) for f in ("f0.mf4", "f1.mf4") for c in ("Current", "Count", "Big", "Level")}
    for (f, c), rows in got.items():
        n = len(made[f]["t"])
        want = made[f][c].astype(float)
        want = -5 + 0.5 * want if c == "Count" else want
        assert sorted(rows) == list(range(n))
        assert np.array_equal([rows[k][1] for k in range(n)], want) and np.array_equal([rows[k][0] for k in range(n)], made[f]["t"])
        assert {rows[k][2] for k in range(n)} == {"A" if c == "Current" else ""}
    assert mdf4.read_mdf4(files, ["Level"]).select("channel").distinct().count() == 1


def test_files_that_cannot_be_read(spark, tmp_path):
    (tmp_path / "a.mf4").write_bytes(b"nothing")
    with pytest.raises(Exception, match="not an MDF file"):
        mdf4.read_mdf4(mdf4.listed(spark, str(tmp_path / "a.mf4"))).collect()
    raw = bytearray(mdf4.encoded({"t": np.arange(3.0), "odd": np.arange(3.0)}, linear={"odd": (0.0, 1.0)}))
    raw[raw.index(b"##CC") + 24 + 32] = 7
    (tmp_path / "b.mf4").write_bytes(raw)
    with pytest.raises(Exception, match="channel odd: conversion 7"):
        mdf4.read_mdf4(mdf4.listed(spark, str(tmp_path / "b.mf4"))).collect()
    cut = mdf4.encoded({"t": np.arange(300.0)}, block_bytes=800)
    (tmp_path / "c.mf4").write_bytes(cut)
    assert mdf4.read_mdf4(mdf4.listed(spark, str(tmp_path / "c.mf4"))).agg(F.count("*")).first()[0] == 0
