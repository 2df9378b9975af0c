"""Segmented scans and sine sums: the same results for any chunks, and a plain loop's."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.operators import scans, sines
from voltplane.plans import measurement

FS = 1000.0


def chunked(spark, channels, size, path="r", gaps=()):
    rows = [(path, c, a, FS, x[a : a + size].tolist()) for c, x in channels.items() for a in range(0, len(x), size) if a not in gaps]
    return spark.createDataFrame(rows, "path string, channel string, first_sample long, fs double, samples array<double>").repartition(5)


def looped(x, rate, r, high, low):
    """Dwells of one tone by a loop over samples."""
    y, on, out, start = 0j, False, [], 0
    for n, v in enumerate(x):
        y = r * y + (1 - r) * v * np.exp(-2j * np.pi * ((rate * n) % 1.0))
        e = 2 * abs(y)
        if not on and e >= high:
            on, start = True, n
        elif on and e < low:
            on = False
            out.append((start, n - 1))
    return out + ([(start, len(x) - 1)] if on else [])


@pytest.fixture(scope="module")
def bursts():
    rnd = np.random.default_rng(0)
    t = np.arange(6000)
    x = 0.05 * rnd.normal(size=6000)
    for a, b, rate in ((300, 900, 0.05), (1500, 1530, 0.05), (2000, 3100, 0.12), (2900, 4000, 0.05), (5500, 6000, 0.12)):
        x[a:b] += np.cos(2 * np.pi * rate * t[a:b])
    x[700] = np.nan
    return {"c1": x, "c2": np.roll(np.nan_to_num(x), 77), "quiet": 0.01 * rnd.normal(size=6000)}


@pytest.mark.parametrize("size", [37, 500, 6000])
def test_dwells_are_the_same_for_any_chunks(spark, bursts, size):
    rates, r, high, low = [0.05, 0.12], 0.97, 0.6, 0.3
    got = sorted((w.channel, w.tone, w.first_sample, w.last_sample) for w in scans.tone_dwells(chunked(spark, bursts, size), rates, r, high, low).collect())
    want = sorted((c, k, a, b) for c, x in bursts.items() for k, rate in enumerate(rates) for a, b in looped(np.nan_to_num(x), rate, r, high, low))
    assert got == want and len(got) >= 8
    long_ones = scans.tone_dwells(chunked(spark, bursts, size), rates, r, high, low, least=200)
    assert {(w.channel, w.tone, w.first_sample) for w in long_ones.collect()} == {(c, k, a) for c, k, a, b in want if b - a + 1 >= 200}


def test_more_chunks_than_are_composed_together(spark, bursts, monkeypatch):
    monkeypatch.setattr(scans, "TOGETHER", 7)
    x = bursts["c2"][:3000]
    got = sorted((w.first_sample, w.last_sample) for w in scans.tone_dwells(chunked(spark, {"c": x}, 40), [0.05], 0.97, 0.6, 0.3).collect())
    assert got == looped(x, 0.05, 0.97, 0.6, 0.3)


def test_a_gap_ends_a_dwell(spark):
    x = np.cos(2 * np.pi * 0.1 * np.arange(1000))
    rows = scans.tone_dwells(chunked(spark, {"c": x}, 100, gaps={400}), [0.1], 0.9, 0.8, 0.4).orderBy("first_sample").collect()
    assert [w.last_sample for w in rows] == [399, 999] and rows[1].first_sample == rows[0].first_sample + 500
    empty = spark.createDataFrame([("r", "c", 0, None), ("r", "c", 5, [])], "path string, channel string, first_sample long, samples array<double>")
    assert scans.tone_dwells(empty, [0.1], 0.9, 0.8, 0.4).count() == 0
    with pytest.raises(ValueError, match="low"):
        scans.tone_dwells(empty, [0.1], 0.9, 0.2, 0.4)


@pytest.mark.parametrize("size", [33, 700, 5000])
def test_sums_over_chunks_equal_a_whole_fit(spark, size):
    rnd = np.random.default_rng(1)
    channels = {c: rnd.normal(size=5000) + 4 for c in ("a", "b")}
    channels["a"][1234] = np.nan
    tones = [("r", 0, 17.3, 100, 1700), ("r", 1, 200.0, 1600, 4999), ("r", 2, 3.0, 4990, 5100), ("r", 3, 3.0, 6000, 7000), ("other", 4, 3.0, 0, 10)]
    frame = spark.createDataFrame(tones, "path string, tone int, freq_hz double, first_sample long, last_sample long")
    got = {(r.channel, r.tone): r for r in sines.solved(sines.sums_of_chunks(chunked(spark, channels, size), frame)).collect()}
    assert set(got) == {(c, k) for c in "ab" for k in (0, 1, 2)}
    for (c, k), r in got.items():
        _, _, f, lo, hi = tones[k]
        y = channels[c][lo : hi + 1]
        t, y = np.arange(len(y))[np.isfinite(y)], y[np.isfinite(y)]
        design = np.column_stack((np.cos(2 * np.pi * f * t / FS), np.sin(2 * np.pi * f * t / FS), np.ones(len(t))))
        fit, *_ = np.linalg.lstsq(design, y, rcond=None)
        rest = y - design @ fit
        assert r.n == len(y)
        if k < 2:
            assert np.allclose([r.re, r.im, r.offset, r.rms], [fit[0], -fit[1], fit[2], np.sqrt(np.mean(rest**2))], rtol=1e-9, atol=1e-9)
            spread = np.linalg.inv(design.T @ design)
            sigma = math.sqrt(rest @ rest / (len(y) - 3) * (spread[0, 0] + spread[1, 1]) / 2) / math.hypot(fit[0], fit[1])
            assert r.sigma_rel == pytest.approx(sigma, rel=1e-6)


def test_uneven_instants_and_rounded_readings(spark):
    rnd = np.random.default_rng(2)
    rows = []
    for c, shift in (("a", 0.0), ("b", 0.013)):
        t = np.sort(rnd.uniform(0, 2, 300))
        x = np.round((0.7 * np.cos(2 * np.pi * 5 * (t + shift) + 0.4) + 0.2) / 0.05) * 0.05
        rows += [(c, float(a), float(b), shift) for a, b in zip(t, x)]
    rows += [("a", 0.5, None, 0.0), ("b", 0.5, float("inf"), 0.0), ("few", 0.1, 1.0, 0.0), ("still", 0.0, 1.0, 0.0)] + [("still", 0.2 * k, 1.0, 0.0) for k in range(1, 9)]
    frame = spark.createDataFrame(rows, "channel string, t double, x double, shift double")
    sums = sines.sums_of_rows(frame, ["channel"], "x", 2 * math.pi * 5 * (F.col("t") + F.col("shift")))
    got = {r.channel: r for r in sines.solved(sums, 0.05).collect()}
    plain = {r.channel: r for r in sines.solved(sums).collect()}
    for c in "ab":
        z = got[c].re + 1j * got[c].im
        assert abs(z - 0.7 * np.exp(0.4j)) < 6 * got[c].sigma_rel * abs(z) and got[c].n == 300
        assert got[c].sigma_rel > plain[c].sigma_rel > 0
    # instants a turn apart can't tell a sine from an offset
    assert got["still"].re is None and got["few"].re is None and got["few"].n == 1


def test_peak_ratio_tells_a_tone_from_noise(spark):
    rnd = np.random.default_rng(3)
    t = np.arange(4000) / FS
    channels = {"tone": 0.3 * np.cos(2 * np.pi * 41 * t) + rnd.normal(size=4000) * 0.5, "noise": rnd.normal(size=4000)}
    tones = spark.createDataFrame([("r", 0, 41.0, 0, 3999, FS)], "path string, tone int, freq_hz double, first_sample long, last_sample long, fs double")
    sided = sines.with_sides(tones)
    cut = sided.withColumn("tone", F.struct("tone", "side"))
    fits = sines.solved(sines.sums_of_chunks(chunked(spark, channels, 512), cut)).select("channel", "tone.*", "re", "im")
    got = {r.channel: r for r in sines.peak_ratio(fits, ["channel", "tone"]).collect()}
    assert got["tone"].excited and not got["noise"].excited and got["tone"].peak_ratio > 10 > got["noise"].peak_ratio


@pytest.mark.parametrize("size", [300, 4096, 50_000])
def test_schedule_at_any_chunk_size(spark, size):
    rnd = np.random.default_rng(4)
    true = [200.3, 90.07, 40.11, 21.9]
    x = np.concatenate([np.cos(2 * np.pi * f * np.arange(8000) / FS) for f in true]) + 0.05 * rnd.normal(size=32_000)
    chunks = chunked(spark, {"UC1": x, "1": 2 * x}, size)
    steps = measurement.schedule(chunks, "UC1", 512).orderBy("step").collect()
    assert [abs(s.freq_hz - f) < 2e-3 for s, f in zip(steps, true, strict=True)] == [True] * 4
    assert [(s.start, s.stop) for s in steps] == [(k * 8000 + a, k * 8000 + b) for k, (a, b) in enumerate(zip([s.start % 8000 for s in steps], [s.stop - k * 8000 for k, s in enumerate(steps)]))]
    assert all(s.start - 8000 * k < 700 and 8000 * (k + 1) - s.stop < 700 for k, s in enumerate(steps))
    key = [(s.step, s.start, s.stop, round(s.freq_hz, 7), round(s.snr_db, 6)) for s in steps]
    assert SEEN.setdefault("steps", key) == key


#: What the first chunk size gave.
SEEN = {}
