"""Measurement models: left-out residuals against refits, orders of made spectra, points that don't fit."""

import numpy as np
import pytest

from voltplane.operators import measurement_model, skew


def made(rnd, f, arcs, noise):
    w = 2 * np.pi * f
    z = 0.8 + sum(r / (1 + 1j * w * t) for r, t in arcs)
    return z * (1 + noise * (rnd.normal(size=len(f)) + 1j * rnd.normal(size=len(f))))


def test_left_out_residuals_equal_refits():
    rnd = np.random.default_rng(0)
    f = np.logspace(-1, 3, 15)
    z = made(rnd, f, [(1.0, 0.01), (0.5, 0.3)], 0.02)
    weight, tau = 0.01 * np.abs(z), np.array([0.012, 0.25])
    got, size = measurement_model.left_out(f, z, weight, tau)
    for i in range(len(f)):
        rest = np.arange(len(f)) != i
        a, y = measurement_model.columns(f[rest], tau, weight[rest]), measurement_model.stacked(z[rest], weight[rest])
        p, *_ = np.linalg.lstsq(a, y, rcond=None)
        model = p[0] + sum(r / (1 + 2j * np.pi * f[i] * t) for r, t in zip(p[1:], tau))
        assert got[i] == pytest.approx(z[i] - model, rel=1e-8)
        # what the others leave is the noise that the point is held against
        e = y - a @ p
        assert size[i] > 0 and np.isfinite(size[i])
        free = 2 * len(f) - 5
        whole = measurement_model.columns(f, tau, weight)
        q, _ = np.linalg.qr(whole)
        r = measurement_model.stacked(z, weight)
        r = r - q @ (q.T @ r)
        own = float(r @ r) - float(e @ e)
        assert size[i] == pytest.approx(np.sqrt(own / 2 / (float(e @ e) / free)), rel=1e-6)


@pytest.mark.parametrize(("arcs", "order"), [([], 0), ([(1.0, 0.02)], 1), ([(1.0, 0.005), (0.6, 0.3)], 2), ([(1.0, 0.001), (0.6, 0.03), (0.8, 1.0)], 3)])
def test_orders_of_made_spectra(arcs, order):
    rnd = np.random.default_rng(order)
    f = np.logspace(-2, 4, 40)
    found = 0
    for _ in range(6):
        z = made(rnd, f, arcs, 0.003)
        r, tau, covariance, chi = measurement_model.grown(f, z, 0.003 * np.abs(z))
        found += len(tau) == order
        if len(tau) == order:
            want = [0.8, *(x for x, _ in arcs)]
            assert np.abs(r - want).max() < 6 * np.sqrt(np.diag(covariance))[: order + 1].max() and 0.5 < chi < 2
            assert np.abs(np.log(tau) - np.log([t for _, t in arcs])).max(initial=0) < 0.1
    assert found >= 5


def test_points_that_do_not_fit_go(spark):
    rnd = np.random.default_rng(5)
    f = np.logspace(-1, 3.5, 30)
    rows, bad = [], {}
    for k in range(12):
        z = made(rnd, f, [(1.0, 0.01), (0.6, 0.4)], 0.003)
        bad[k] = sorted(rnd.choice(30, k % 3, replace=False).tolist())
        z[bad[k]] *= 1.08
        rows += [(k, float(a), float(b.real), float(b.imag)) for a, b in zip(f, z)]
    rows += [(90, 1.0, 1.0, 0.0)] + [(91, 2.0, 1.0, -0.1)] * 9
    spectra = skew.assembled(spark.createDataFrame(rows, "k int, freq_hz double, re double, im double").repartition(3), ["k"])
    got = {r.k: r for r in measurement_model.measurement_models(spectra, ["k"], 0.003).collect()}
    assert len(got) == 14 and got[90].order is None and got[91].tau is None
    right = 0
    for k, places in bad.items():
        r = got[k]
        assert {round(float(f[i]), 6) for i in places} <= {round(x, 6) for x in r.removed}
        right += r.order == 2 and len(r.removed) == len(places) and abs(r.resistances[0] / 0.8 - 1) < 0.01
        assert len(r.errors) == 2 * r.order + 1 and len(r.resistances) == r.order + 1
    assert right >= 10
