"""Array detection, common components, ladders and recovered schedules against planted tones and brute force."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.operators import detection

FS = 10_000.0


def chunked(spark, x, size, path="r", fs=FS):
    """Channels x samples as chunks of one recording."""
    rows = [(path, f"{c:02d}", a, fs, x[c, a : a + size].astype(float).tolist()) for c in range(len(x)) for a in range(0, x.shape[1], size)]
    return spark.createDataFrame(rows, "path string, channel string, first_sample long, fs double, samples array<double>").repartition(4)


def test_false_alarms_come_at_the_stated_rate(spark):
    rnd = np.random.default_rng(0)
    n_frames, size, channels, n_bg, alpha = 60, 512, 8, 24, 0.02
    tested = detection.frames(chunked(spark, rnd.normal(size=(channels, size * n_frames)), size), n_bg, 2, alpha)
    found = detection.detections(tested).collect()
    first, last = detection.background_bins(256, n_bg, 2)
    tests = n_frames * (last - first + 1)
    by_max = sum(r.is_max for r in found) / tests
    by_count = sum(r.n_over >= r.threshold for r in found) / tests
    expected, p = 1 / (1 + 2 * n_bg), 1 / (1 + 2 * n_bg)
    assert abs(by_max - expected) < 4 * math.sqrt(expected / tests)
    exact = sum(math.comb(channels, c) * p**c * (1 - p) ** (channels - c) for c in range(found[0].threshold, channels + 1))
    assert exact <= alpha and abs(by_count - exact) < 4 * math.sqrt(alpha / tests)


def test_tone_below_every_single_channel_is_found(spark):
    rnd = np.random.default_rng(1)
    size, channels, bin_ = 1024, 24, 300
    t = np.arange(size * 3) / FS
    x = rnd.normal(size=(channels, len(t))) * rnd.uniform(0.5, 40, (channels, 1))
    noise = x.std(axis=1)
    x += 0.07 * noise[:, None] * np.cos(2 * np.pi * bin_ * FS / size * t + rnd.uniform(0, 6, channels)[:, None])
    for row, level in zip(x, noise):  # in each channel the tone is under a third of the largest bin of noise
        assert (0.07 * level * size / 2) ** 2 < np.sort(np.abs(np.fft.rfft(row[:size]))[1:512] ** 2)[-3] / 3
    x[3, 5] = np.nan  # a channel that can't count in the first frame
    tested = detection.frames(chunked(spark, x, size))
    counts = {r.first_sample: r.n_channels for r in tested.collect()}
    assert counts == {0: 23, 1024: 24, 2048: 24}
    best = detection.detections(tested).where("is_max").groupBy("first_sample").agg(F.max_by("bin", "ratio_db").alias("bin")).collect()
    assert [r.bin for r in best] == [bin_] * 3


def test_array_tests_against_a_loop():
    rnd = np.random.default_rng(2)
    x = rnd.normal(size=(5, 128))
    total, found = detection.array_tests(x, 6, 1, 0.05)
    power = np.abs(np.fft.rfft(x - x.mean(axis=1, keepdims=True), axis=1))[:, :64] ** 2
    power /= np.median(power[:, 1:], axis=1, keepdims=True)
    want = []
    for k in range(1 + 1 + 6, 64 - 1 - 6):
        beside = [j for j in range(k - 7, k + 8) if abs(j - k) > 1]
        is_max = power.sum(axis=0)[k] > max(power.sum(axis=0)[j] for j in beside)
        over = sum(power[c, k] > max(power[c, j] for j in beside) for c in range(5))
        if is_max or over >= detection.count_threshold(5, 1 / 13, 0.05):
            want.append((k, is_max, over))
    assert [(k, m, o) for k, _, m, o, _ in found] == want and np.allclose(total, power.sum(axis=0))
    assert [detection.count_threshold(m, 0.1, a) for m, a in ((1, 0.5), (1, 0.05), (3, 0.05), (0, 0.5))] == [1, 2, 2, 1]


def test_one_common_component(spark):
    rnd = np.random.default_rng(3)
    channels, snaps = 9, 16
    noise = lambda: rnd.normal(size=(channels, snaps)) + 1j * rnd.normal(size=(channels, snaps))
    common, own, none = noise(), noise(), noise()
    common += 2.5 * np.exp(1j * rnd.uniform(0, 6, channels))[:, None]
    own[4] += 60 * np.exp(1j * rnd.uniform(0, 0.2, snaps))
    rows = [(name, f"c{c}", s, float(z[c, s].real), float(z[c, s].imag)) for name, z in (("common", common), ("own", own), ("none", none)) for c in range(channels) for s in range(snaps)]
    rows += [("common", "flat", s, 1.0, 0.0) for s in range(snaps)]  # never changes, has no spread
    frame = spark.createDataFrame(rows, "tone string, channel string, snap int, re double, im double")
    got = {r.tone: r for r in detection.rank_one(frame, ["tone"], "snap").collect()}
    assert {t: r.shared for t, r in got.items()} == {"common": True, "own": False, "none": False}
    for name, z in (("common", common), ("own", own)):
        white = z / z.std(axis=1, keepdims=True)
        values = np.linalg.eigvalsh(white @ white.conj().T / snaps)
        assert got[name].n_channels == channels and got[name].n_snapshots == snaps
        assert got[name].statistic == pytest.approx(values[-1] / values.mean(), rel=1e-9)
    assert got["own"].participation < 2 and got["common"].participation > 6


@pytest.mark.parametrize(("per_decade", "missing", "jitter"), [(10.0, {3, 4, 9}, 0.002), (7.0, {1, 2, 5, 11}, 0.001), (12.0, set(), 0.0), (4.889, {2}, 0.002)])
def test_ladder(spark, per_decade, missing, jitter):
    rnd = np.random.default_rng(4)
    f = [0.7 * 10 ** (k / per_decade) * (1 + jitter * rnd.normal()) for k in range(24) if k not in missing]
    rows = [("a", float(v)) for v in [*f, *f[:3]]] + [("few", 1.0), ("few", 2.0), ("bad", -1.0)]
    got = {r.path: r for r in detection.ladder(spark.createDataFrame(rows, "path string, f double"), ["path"], "f").collect()}
    assert set(got) == {"a"}
    r = got["a"]
    assert r.per_decade == pytest.approx(per_decade, rel=0.002) and r.residual < 3 * jitter + 1e-9 and r.n_steps == len(f)
    place = (math.log(0.7) - r.log_f0) / r.log_ratio
    assert abs(place - round(place)) < 0.05


def sweep(rnd, channels, size, rungs, per_decade, frames_each, weak, absent, amp=0.5):
    """A sweep down a ladder of frequencies; weak rungs are 14 dB lower, absent ones are noise only."""
    f = [3000 * 10 ** (-k / per_decade) for k in range(rungs)]
    x = rnd.normal(size=(channels, rungs * frames_each * size))
    t = np.arange(x.shape[1]) / FS
    phase, sign = rnd.uniform(0, 6, channels), rnd.choice([-1, 1], channels)
    for k, v in enumerate(f):
        at = slice(k * frames_each * size, (k + 1) * frames_each * size)
        a = 0 if k in absent else amp * (0.18 if k in weak else 1)
        x[:, at] += a * sign[:, None] * np.cos(2 * np.pi * v * t[None, at] + phase[:, None])
    return f, x


def test_recovered_schedule(spark):
    rnd = np.random.default_rng(5)
    f, x = sweep(rnd, 12, 1024, 12, 12.0, 8, weak={4, 11}, absent={7})
    chunks = chunked(spark, x, 1024)
    rows = detection.recovered_schedule(chunks, 300.0, 3600.0).orderBy("first_sample").collect()
    detected = [r for r in rows if r.source == "detected"]
    verified = [r for r in rows if r.source == "verified"]
    near = lambda rs: [min(range(12), key=lambda k: abs(f[k] / r.freq_hz - 1)) for r in rs]
    assert set(near(detected)) | set(near(verified)) == set(range(12)) - {7}
    assert set(near(verified)) <= {4, 11} and all(abs(f[k] / r.freq_hz - 1) < 0.005 for k, r in zip(near(rows), rows))
    # frequencies of strong steps come from the turn of the phasors, far below a bin of 19.5 Hz
    assert all(abs(f[k] - r.freq_hz) < 0.5 for k, r in zip(near(detected), detected) if k not in (4, 11))
    again = detection.recovered_schedule(chunks.repartition(7).sort("samples"), 300.0, 3600.0).orderBy("first_sample").collect()
    assert [(r.first_sample, round(r.freq_hz, 6), r.source) for r in again] == [(r.first_sample, round(r.freq_hz, 6), r.source) for r in rows]


def test_nothing_is_recovered_from_noise_or_nothing(spark):
    rnd = np.random.default_rng(6)
    noise = detection.recovered_schedule(chunked(spark, rnd.normal(size=(5, 512 * 12)), 512), 300.0, 3600.0)
    assert noise.where("source = 'verified'").count() == 0
    empty = spark.createDataFrame([], "path string, channel string, first_sample long, fs double, samples array<double>")
    assert detection.recovered_schedule(empty, 300.0, 3600.0).count() == 0
    odd = spark.createDataFrame([("r", "a", 0, FS, None), ("r", "b", 0, FS, []), ("r", "c", 0, FS, [1.0, None])], "path string, channel string, first_sample long, fs double, samples array<double>")
    assert [r.n_channels for r in detection.frames(odd).collect()] == [0]
