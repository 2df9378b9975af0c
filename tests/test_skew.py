"""Delays shared by many spectra against a dense joint fit."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from voltplane.operators import skew


def made(rnd, cards, segments=16, noise=1e-3, n=30):
    """(rows, truth): spectra of a resistance and two arcs, turned by each card's delays."""
    rows, truth = [], {}
    f = np.logspace(-0.5, 3.7, n)
    w = 2 * np.pi * f
    lo, hi = -np.log10(w.max()), -np.log10(w.min())
    taus = 10 ** np.linspace(lo, hi, int(round((hi - lo) * 2)) + 1)
    for c in range(cards):
        truth[f"c{c}"] = (rnd.uniform(-8e-6, 8e-6), rnd.uniform(-2e-6, 2e-6))
        for s in range(segments):
            z = rnd.uniform(0.5, 1) + rnd.uniform(1, 2) / (1 + 1j * w * taus[5]) + rnd.uniform(0.5, 1) / (1 + 1j * w * taus[2])
            z = z * np.exp(-1j * w * (truth[f"c{c}"][0] + truth[f"c{c}"][1] * s)) * (1 + noise * (rnd.normal(size=n) + 1j * rnd.normal(size=n)))
            rows += [(f"c{c}", s, 1.0, float(s), float(a), float(b.real), float(b.imag)) for a, b in zip(f, z)]
    return rows, truth


SCHEMA = "card string, segment int, one double, slot double, freq_hz double, re double, im double"


def dense_fit(rows, card, rounds=30):
    """All linear parts and both delays at once, by Gauss-Newton on the whole system."""
    by = {}
    for c, s, _, slot, f, re, im in rows:
        if c == card:
            by.setdefault(s, (slot, [], []))[1].append(f)
            by[s][2].append(re + 1j * im)
    theta = np.zeros(2)
    for _ in range(rounds):
        blocks, right = [], []
        for n, (slot, f, z) in enumerate(by.values()):
            f, z = np.array(f), np.array(z)
            turned = z / np.abs(z) * np.exp(2j * np.pi * f * (theta[0] + theta[1] * slot))
            basis = skew.linear_part(f, np.abs(z), 2.0)
            slope = 2j * np.pi * f * turned
            block = np.zeros((2 * len(f), 2 + len(by) * basis.shape[1]))
            block[:, 0], block[:, 1] = np.concatenate((slope.real, slope.imag)), np.concatenate((slope.real, slope.imag)) * slot
            block[:, 2 + n * basis.shape[1] : 2 + (n + 1) * basis.shape[1]] = basis
            blocks.append(block)
            right.append(-np.concatenate((turned.real, turned.imag)))
        a = np.vstack(blocks)
        scale = np.linalg.norm(a, axis=0)
        theta = theta + (np.linalg.lstsq(a / scale, np.concatenate(right), rcond=None)[0] / scale)[:2]
    return theta


def test_equals_a_dense_joint_fit(spark):
    rnd = np.random.default_rng(0)
    rows, truth = made(rnd, 3)
    rows += [("c0", 99, 1.0, None, 10.0, 1.0, 0.0), ("c1", 98, 1.0, 3.0, 10.0, 1.0, 0.1), ("c1", 97, 1.0, 3.0, None, 1.0, 0.1), ("c1", 0, 1.0, 0.0, 5.0, float("nan"), 0.1)]
    spectra = skew.assembled(spark.createDataFrame(rows, SCHEMA).repartition(6), ["card", "segment"], kept=["one", "slot"])
    got = {r.card: r for r in skew.shared_skew(spectra, ["card"], ["one", "slot"]).collect()}
    clean = [r for r in rows if r[1] < 90 and r[5] == r[5]]
    assert set(got) == set(truth)
    for card, r in got.items():
        dense = dense_fit(clean, card)
        assert np.allclose(r.theta, dense, rtol=1e-4, atol=1e-11), (r.theta, dense)
        assert r.n_spectra == 16 and r.cost < r.cost_before and r.rounds < 12
        assert all(abs(t - v) < 6 * e for t, v, e in zip(r.theta, truth[card], r.error)), (r.theta, truth[card], r.error)


def test_basis_is_chosen_by_cost(spark):
    rnd = np.random.default_rng(1)
    rows, truth = made(rnd, 2)
    frame = spark.createDataFrame(rows, SCHEMA).withColumn("mirror", 15 - F.col("slot")).withColumn("odd", F.col("segment") % 2)
    spectra = skew.assembled(frame, ["card", "segment"], kept=["one", "slot", "mirror", "odd"])
    best, fits = skew.chosen_basis(spectra, ["card"], {"common": ["one"], "odd": ["one", "odd"], "slots": ["one", "slot"]})
    assert best == "slots" and set(fits) == {"common", "odd", "slots"}
    # a common delay and one that is the same everywhere can't be told apart
    both = skew.shared_skew(spectra.withColumn("same", F.lit(1.0)), ["card"], ["one", "same"]).first()
    assert both.error == [float("inf")] * 2 and both.theta[0] == pytest.approx(both.theta[1])
    straight = {(r.card, r.segment, r.freq_hz): r for r in skew.deskewed(frame, fits["slots"], ["card"], ["one", "slot"]).collect()}
    for c, s, _, slot, f, re, im in rows[:40]:
        z = (re + 1j * im) * np.exp(2j * np.pi * f * (truth[c][0] + truth[c][1] * slot))
        r = straight[c, s, f]
        assert abs(r.re + 1j * r.im - z) < 5e-3 * abs(z)


def test_nothing_to_deskew(spark):
    empty = skew.assembled(spark.createDataFrame([], SCHEMA), ["card", "segment"], kept=["one"])
    assert skew.shared_skew(empty, ["card"], ["one"]).count() == 0
    # no relaxations: a resistance and an inductance, whose delay can't be told from the inductance alone
    f = np.linspace(1, 50, 40)
    rows = [("a", 0, 1.0, 0.0, float(v), float(z.real), float(z.imag)) for v, z in zip(f, 2 * np.exp(-2j * np.pi * f * 1e-3))]
    plain = skew.shared_skew(skew.assembled(spark.createDataFrame(rows, SCHEMA), ["card", "segment"], kept=["one"]), ["card"], ["one"], per_decade=None).first()
    assert plain.theta[0] == pytest.approx(1e-3, rel=1e-6) and plain.cost < 1e-10
