"""Clocks of cards against imposed offsets and rates."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from voltplane.operators import clocks, lags

FS, BAND = 10_000.0, (20.0, 4000.0)
TONES = [2, 3, 5, 8, 13, 21, 34, 55, 89, 144, 233, 377, 610, 987, 1597, 2584, 3571.0]


def record(t, seed=1, noise=5e-7, rnd=None):
    """A multisine at these times, with noise of its own."""
    phases = np.random.default_rng(seed).uniform(0, 2 * np.pi, len(TONES))
    x = sum(np.sin(2 * np.pi * f * t + p) for f, p in zip(TONES, phases))
    return 4e-3 / np.sqrt(len(TONES) / 2) * x + noise * rnd.normal(size=len(t))


def stored(spark, path, cards, size=7001, channel=None):
    rows = [(c, a, x[a : a + size]) for c, x in cards.items() for a in range(0, len(x), size)]
    table = pa.table({"card": [r[0] for r in rows], "first_sample": [r[1] for r in rows], "samples": pa.array([r[2] for r in rows], pa.list_(pa.float64()))})
    pq.write_table(table, path, row_group_size=4)
    return spark.read.parquet(str(path))


def test_kernel():
    t = np.arange(400.0)
    f = lambda t: np.cos(2 * np.pi * 0.03 * t) + 0.5 * np.sin(2 * np.pi * 0.39 * t)
    at = np.concatenate((np.linspace(40, 350, 1777), [50.0, -3.0, 399.0]))
    got = clocks.resampled(f(t), at)
    assert np.abs(got - f(at))[:1778].max() < 2e-4 and np.isnan(got[-2:]).all()
    broken = f(t)
    broken[200] = np.nan
    assert np.isnan(clocks.resampled(broken, np.array([190.5]))).all() and np.isfinite(clocks.resampled(broken, np.array([150.5]))).all()


@pytest.mark.parametrize("size", [7001, 65_536])
def test_offsets_and_rates(spark, tmp_path, size):
    rnd = np.random.default_rng(2)
    n = int(FS * 30)
    t = np.arange(n) / FS
    imposed = {"a": (0.3, 0.0), "b": (12.4, 0.0), "c": (-5.2, 0.0), "d": (137.0, 0.0), "e": (31.0, 6.0), "f": (-15.0, -4.0)}
    cards = {"ref": record(t, rnd=rnd)}
    for c, (samples, ppm) in imposed.items():
        cards[c] = record(t - samples / FS - ppm * 1e-6 * t, rnd=rnd)
    cards["dead"] = 1e-5 * rnd.normal(size=n)
    chunks = stored(spark, tmp_path / "r.parquet", cards, size)
    pairs = lags.pair_lags(lags.pair_correlations(chunks.where("card in ('ref', 'd')"), 300, 1 << 16), 300, 20).first()
    start = {"d": -pairs.lag if pairs.a == "ref" else pairs.lag}
    start["d"] = pairs.lag if pairs.a == "ref" else -pairs.lag
    assert abs(start["d"] - 137) <= 1
    got = {r.card: r for r in clocks.card_clocks(chunks, "ref", FS, BAND, start).collect()}
    assert not got["dead"].ok and got["dead"].offset_s is None and got["dead"].coherence < 0.3
    for c, (samples, ppm) in imposed.items():
        r = got[c]
        assert r.ok and r.rounds <= 3 and r.n_blocks >= 9
        assert abs(r.offset_s - samples / FS) < 73e-9, (c, (r.offset_s - samples / FS) * 1e9)
        assert abs(r.rate_ppm - ppm) < 0.02, (c, r.rate_ppm)
    if size == 7001:
        known = clocks.card_clocks(chunks, "ref", FS, BAND, start).unionByName(spark.createDataFrame([("ref", 0.0, 0.0, 0.0, 1.0, 1, 1, True)], "card string, offset_s double, rate_ppm double, offset_error_s double, coherence double, n_blocks long, rounds int, ok boolean"))
        laid = {}
        for r in clocks.aligned(chunks, known, FS).collect():
            laid.setdefault(r.card, {})[r.first_sample] = np.array(r.samples)
        assert set(laid) == {"ref", *imposed}
        for c in imposed:
            same = [k for k in laid[c] if k in laid["ref"]]
            x, y = (np.concatenate([laid[v][k] for k in sorted(same)]) for v in (c, "ref"))
            known = np.isfinite(x) & np.isfinite(y)
            assert known.sum() > n - 2000 and np.sqrt(np.mean((x - y)[known] ** 2)) < 4e-6


def test_gaps_and_nothing(spark):
    rnd = np.random.default_rng(3)
    x = np.convolve(rnd.normal(size=60_000), np.hanning(5), "same")
    rows = [(c, a, x[a - d : a - d + 1000].tolist()) for c, d in (("ref", 0), ("late", 9)) for a in range(1000, 58_000, 1000) if (c, a) != ("late", 30_000)]
    rows += [("late", 5, None), ("short", 1000, x[1000:1200].tolist())]
    chunks = spark.createDataFrame(rows, "card string, first_sample long, samples array<double>")
    got = {r.card: r for r in clocks.card_clocks(chunks, "ref", 1000.0, (1.0, 400.0), block=8192, frame=512).collect()}
    assert got["late"].ok and abs(got["late"].offset_s - 0.009) < 1e-6 and abs(got["late"].rate_ppm) < 0.05
    assert not got["short"].ok and got["short"].n_blocks == 0
    assert clocks.card_clocks(chunks.where("card = 'ref'"), "ref", 1000.0, (1.0, 400.0)).count() == 0
    assert clocks.card_clocks(chunks.limit(0), "ref", 1000.0, (1.0, 400.0)).count() == 0
