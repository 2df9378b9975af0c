"""Lags of cards: block correlations against a plain sum, planted lags beyond a chunk, cards that disagree."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.operators import lags


def chunked(spark, traces, size, extra=()):
    rows = [(c, a, x[a : a + size].tolist()) for c, x in traces.items() for a in range(0, len(x), size)]
    return spark.createDataFrame([*rows, *extra], "card string, first_sample long, samples array<double>").repartition(5)


@pytest.mark.parametrize(("size", "block", "max_lag"), [(64, 128, 150), (100, 300, 40), (1000, 77, 10)])
def test_products_against_a_plain_sum(spark, size, block, max_lag):
    rnd = np.random.default_rng(0)
    traces = {c: rnd.normal(size=1000) for c in "abc"}
    traces["a"][17] = np.nan
    got = lags.pair_correlations(chunked(spark, traces, size, [("d", 0, None), ("d", 5, [])]), max_lag, block, centre=False).collect()
    assert {(r.a, r.b) for r in got} == {("a", "b"), ("a", "c"), ("b", "c")}
    clean = {c: np.nan_to_num(x) for c, x in traces.items()}
    for r in got:
        x, y = clean[r.a], clean[r.b]
        want = [sum(x[max(0, -k) : 1000 - max(0, k)] * y[max(0, k) : 1000 + min(0, k)]) for k in range(-max_lag, max_lag + 1)]
        assert np.allclose(r.products, want) and r.energy_a == pytest.approx(x @ x) and r.energy_b == pytest.approx(y @ y)


def cards(rnd, n, shifts, noise=0.5):
    source = np.convolve(rnd.normal(size=n + 8000), np.hanning(9), "same")
    return {c: source[4000 - s : 4000 - s + n] + noise * rnd.normal(size=n) + 3.0 for c, s in shifts.items()}


def test_planted_lags_beyond_a_chunk(spark):
    rnd = np.random.default_rng(1)
    shifts = {"k1": 0, "k2": 1, "k3": 2856, "k4": -1267, "k5": 1274}
    traces = cards(rnd, 20_000, shifts)
    traces["noise"] = rnd.normal(size=20_000)
    pairs = lags.pair_lags(lags.pair_correlations(chunked(spark, traces, 512), 4500, 4096), 4500, 50)
    got = {r.card: r for r in lags.card_lags(lags.closures(pairs), 5.0).collect()}
    assert {c: round(r.lag) for c, r in got.items()} == shifts and all(r.agrees and r.n_pairs == 4 for r in got.values())
    noise = pairs.where("a = 'noise' or b = 'noise'").agg(F.max(F.abs("correlation")).alias("c"), F.max("prominence").alias("p")).first()
    good = pairs.where("a <> 'noise' and b <> 'noise'").agg(F.min(F.abs("correlation")).alias("c"), F.min("prominence").alias("p")).first()
    assert noise.c < 0.1 < 0.5 < good.c and noise.p < good.p


def test_correlation_in_a_band(spark):
    rnd = np.random.default_rng(2)
    t = np.arange(12_000) / 1000
    traces = cards(rnd, 12_000, {"a": 0, "b": 240}, noise=0.1)
    hum = 30 * np.sin(2 * np.pi * 7 * t)
    wide = chunked(spark, {c: x + hum for c, x in traces.items()}, 500)
    lag = lambda band: lags.pair_lags(lags.pair_correlations(wide, 400, 3000, fs=1000.0, band=band), 400, 20).first()
    assert lag((20.0, 400.0)).lag == 240 and abs(lag((20.0, 400.0)).correlation) > 0.7
    assert lag(None).lag != 240


def test_a_lying_card_is_rejected(spark):
    true = {"a": 0, "b": 40, "c": -900, "d": 77, "e": 300}
    rnd = np.random.default_rng(3)
    rows = []
    for a in true:
        for b in true:
            if a < b:
                lie = int(rnd.integers(-4000, 4000)) if "d" in (a, b) else 0
                rows.append(("r", a, b, true[b] - true[a] + lie + int(rnd.integers(-1, 2)), 0.9))
    rows += [("r", "a", "f", 5, 0.2), ("two", "x", "y", 12, 0.8)]
    pairs = spark.createDataFrame(rows, "rec string, a string, b string, lag long, correlation double")
    closed = lags.closures(pairs, ["rec"])
    off = {(r.a, r.b): r.closure for r in closed.where("rec = 'r'").collect()}
    both = {**{(a, b): l for _, a, b, l, _ in rows[:10]}, **{(b, a): -l for _, a, b, l, _ in rows[:10]}}
    assert off["b", "c"] == np.median([abs(both["b", "c"] + both["c", x] - both["b", x]) for x in "ade"]) and off["a", "f"] is None
    got = {(r.rec, r.card): r for r in lags.card_lags(closed, 5.0, keys=["rec"]).collect()}
    assert got["r", "d"].lag is None and not got["r", "d"].agrees
    assert all(abs(got["r", c].lag - true[c]) <= 1 and got["r", c].agrees for c in "abce") and ("r", "f") not in got
    assert round(got["two", "y"].lag, 9) == 12 and got["two", "x"].lag == 0


def test_arrays_add_up_over_many_tasks(spark):
    rnd = np.random.default_rng(4)
    values = rnd.normal(size=(300, 5))
    rows = [(i % 3, v.tolist()) for i, v in enumerate(values)]
    got = {r.k: r.v for r in lags.array_sums(spark.createDataFrame(rows, "k int, v array<double>").repartition(150), ["k"], "v").collect()}
    assert set(got) == {0, 1, 2} and all(np.allclose(got[k], values[k::3].sum(axis=0)) for k in got)


def test_nothing_to_correlate(spark):
    empty = spark.createDataFrame([], "card string, first_sample long, samples array<double>")
    assert lags.pair_correlations(empty, 10, 100).count() == 0
    still = chunked(spark, {"a": np.ones(50), "b": np.zeros(50)}, 10)
    assert lags.card_lags(lags.closures(lags.pair_lags(lags.pair_correlations(still, 10, 100), 10, 2)), 1.0).count() == 0
