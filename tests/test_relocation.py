"""Lock-in peaks against a plain sum, assignments against all of them, and a log found again."""

import itertools

import numpy as np
import pytest

from voltplane.operators import relocation


def chunked(spark, x, size, path="r", channel="c"):
    rows = [(path, channel, a, x[a : a + size].tolist()) for a in range(0, len(x), size)]
    return spark.createDataFrame(rows, "path string, channel string, first_sample long, samples array<double>").repartition(4)


@pytest.mark.parametrize(("size", "block"), [(100, 256), (997, 5000), (64, 64)])
def test_peaks_against_a_plain_sum(spark, size, block):
    rnd = np.random.default_rng(0)
    x, rates, w = rnd.normal(size=2000), [0.07, 0.19, 0.31], 50
    x[1500] = np.nan
    power = np.full((3, 2000), np.nan)
    for k, rate in enumerate(rates):
        turned = x * np.exp(-2j * np.pi * rate * np.arange(2000))
        power[k, : 2000 - w + 1] = [2 / w * abs(turned[n : n + w].sum()) for n in range(2000 - w + 1)]
    want = []
    filled = np.nan_to_num(power, nan=-1.0)
    for k in range(3):
        for n in range(2000):
            near = slice(max(0, n - w // 2), n + w // 2 + 1)
            if filled[k, n] >= 0.2 and filled[k, n] == filled[k, near].max():
                want.append((k, n, round(filled[k, n], 9), round(filled[k, n] / max(filled[j, near].max() for j in range(3) if j != k), 9)))
    got = sorted((r.tone, r.at, round(r.size, 9), round(r.dominance, 9)) for r in relocation.lock_in_peaks(chunked(spark, x, size), rates, w, 0.2, block).collect())
    assert got == sorted(want) and len(got) > 60


def brute(scores, places, gaps):
    """The largest sum over all assignments in order."""
    best = 0.0
    for pick in itertools.product(*[[None, *range(len(places))] for _ in scores]):
        used = [(e, k) for e, k in enumerate(pick) if k is not None]
        ok = all(b[1] > a[1] and places[b[1]] >= places[a[1]] + gaps[b[0]] for a, b in itertools.pairwise(used))
        if ok:
            best = max(best, sum(scores[e][k] for e, k in used))
    return best


def test_assignment_against_all_of_them():
    rnd = np.random.default_rng(1)
    for _ in range(150):
        n, m = int(rnd.integers(0, 5)), int(rnd.integers(0, 5))
        places = np.sort(rnd.integers(0, 12, m)).astype(float)
        scores = [np.where(rnd.random(m) < 0.3, -np.inf, np.round(rnd.random(m), 1)) for _ in range(n)]
        gaps = [float(rnd.integers(0, 4)) for _ in range(n)]
        got = relocation.assigned(scores, places, gaps)
        used = [(e, k) for e, k in enumerate(got) if k is not None]
        assert all(b[1] > a[1] and places[b[1]] >= places[a[1]] + gaps[b[0]] for a, b in itertools.pairwise(used))
        assert sum(scores[e][k] for e, k in used) == pytest.approx(brute(scores, places, gaps)), (scores, places, gaps, got)


def test_a_log_is_found_again(spark):
    rnd = np.random.default_rng(2)
    rates, w = [0.05, 0.11, 0.23], 200
    true = [(0, 1000), (1, 1600), (2, 2300), (1, 3100), (0, 4000)]
    x = 0.5 * rnd.normal(size=6000)
    for tone, at in true:
        x[at : at + w] += np.cos(2 * np.pi * rates[tone] * np.arange(w) + 1)
    x[5200:5400] += 1.5 * np.cos(2 * np.pi * rates[1] * np.arange(w))  # nothing in the log
    peaks = relocation.lock_in_peaks(chunked(spark, x, 512), rates, w, 0.3)
    log = [("r", i, tone, at + 40, 300) for i, (tone, at) in enumerate(true)] + [("r", 5, 2, None, 300), ("none", 0, 1, 10, 0)]
    entries = spark.createDataFrame(log, "path string, entry int, tone int, expected long, gap long")
    got = {(r.path, r.entry): r for r in relocation.relocated(entries, peaks, 2000.0, 1.2).collect()}
    assert all(abs(got["r", i].at - at) <= 12 for i, (_, at) in enumerate(true))
    assert got["r", 5].at is None and got["none", 0].at is None and len(got) == 7
    # without an expected place the order alone decides
    blind = spark.createDataFrame([(p, i, t, None, 300) for p, i, t, _, _ in log[:5]], "path string, entry int, tone int, expected long, gap long")
    placed = {r.entry: r.at for r in relocation.relocated(blind, peaks, 1.0, 1.2).collect()}
    assert all(abs(placed[i] - at) <= 12 for i, (_, at) in enumerate(true))


def test_sliding_max():
    rnd = np.random.default_rng(3)
    for n, reach in ((1, 3), (10, 0), (50, 4), (49, 12)):
        v = rnd.normal(size=(2, n))
        want = [[row[max(0, i - reach) : i + reach + 1].max() for i in range(n)] for row in v]
        assert np.array_equal(relocation.sliding_max(v, reach), want)
