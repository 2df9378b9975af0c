"""Kernels against known truth."""

import numpy as np
import pytest

from voltplane.operators import numeric

RNG = np.random.default_rng(3)


def multisine(n, fs, tones, shift=0.0):
    t = np.arange(n) / fs - shift
    return sum(np.cos(2 * np.pi * f * t + f) for f in tones)


def test_delay_is_found_below_a_sample():
    fs = 10_000.0
    x = RNG.normal(size=40_000)
    smooth = np.fft.irfft(np.fft.rfft(x) * (np.fft.rfftfreq(len(x), 1 / fs) < 4200), len(x))
    for true in (0.0, 13.4 / fs, -137.25 / fs):
        found, error = numeric.estimate_delay(smooth, numeric.shifted(smooth, -true, fs), fs)
        assert found == pytest.approx(true, abs=2e-7) and error < 1e-6


def test_gcc_peak_is_sharp():
    x = RNG.normal(size=4096)
    tau, sharp = numeric.gcc_phat(x[100:3100], x[90:3090], 1000.0, strong=0.0)
    assert tau == pytest.approx(0.01, abs=1e-4) and sharp > 1.5


def test_sines():
    fs = 1000.0
    t = np.arange(500) / fs
    y = 2 * np.cos(2 * np.pi * 33.3 * t + 0.4) + 0.5 * np.sin(2 * np.pi * 71 * t) + 0.1
    amp, rms = numeric.sine_fit(y, t, np.array([33.3, 71.0]))
    assert abs(amp[0]) == pytest.approx(2) and np.angle(amp[0]) == pytest.approx(0.4) and rms < 1e-9
    f, _, _ = numeric.sine_frequency(2 * np.cos(2 * np.pi * 33.3 * t + 0.4), fs, 33.0)
    assert f == pytest.approx(33.3, abs=1e-6)


def test_notch_leaves_phase():
    fs, t = 1000.0, np.arange(4000) / 1000.0
    y = np.cos(2 * np.pi * 7 * t) + np.cos(2 * np.pi * 50 * t)
    out = numeric.notched(y, fs, 50.0, 5.0)
    amp, _ = numeric.sine_fit(out[1000:3000], t[1000:3000], np.array([7.0, 50.0]))
    assert abs(amp[1]) < 0.02 and np.angle(amp[0]) == pytest.approx(0, abs=0.02)


def test_nnls_has_no_better_neighbour():
    for _ in range(10):
        a, b = RNG.normal(size=(20, 8)), RNG.normal(size=20)
        x = numeric.nnls(a, b)
        assert (x >= 0).all()
        gradient = a.T @ (b - a @ x)
        assert (gradient <= 1e-6).all() and abs(gradient @ x) < 1e-6


def spectrum(noise=0.0):
    f = np.logspace(0, 4, 40)
    z = 0.05 + 0.01 / (1 + (2j * np.pi * f * 1e-2) ** 0.9)
    return f, z * (1 + noise * (RNG.normal(size=40) + 1j * RNG.normal(size=40)))


def test_models_recover_the_parts():
    f, z = spectrum(1e-4)
    arcs, p, sd = numeric.select_circuit(f, z, 1)
    assert arcs == 1 and np.exp(p[0]) == pytest.approx(0.05, rel=0.02) and np.exp(p[2]) == pytest.approx(0.01, rel=0.05) and np.exp(p[3]) == pytest.approx(1e-2, rel=0.1)
    tau, gamma, series = numeric.relaxation_times(f, z)
    assert series == pytest.approx(0.05, rel=0.02) and tau[np.argmax(gamma)] == pytest.approx(1e-2, rel=0.4)
    assert np.max(np.abs(numeric.modulus_from_phase(f, z) / np.abs(z) - 1)[3:-3]) < 0.02


def test_kramers_kronig_tells_a_broken_spectrum():
    f, z = spectrum(1e-5)
    _, _, good, _ = numeric.kramers_kronig(f, z, mu_limit=0.3)
    broken = z * (1 + 0.2 * (f > 100))
    _, _, bad, _ = numeric.kramers_kronig(f, broken, mu_limit=0.3)
    assert good < 1.0 < bad


def test_field_keeps_to_its_values():
    x = RNG.uniform(0, 10, (40, 2))
    v = np.sin(x[:, 0]) + 0.1 * x[:, 1]
    mean, sd = numeric.field(x, v, np.full(40, 1e-3), np.vstack((x, [[500.0, 500.0]])))
    assert np.abs(mean[:-1] - v).max() < 0.05 and sd[-1] > sd[:-1].max() and mean[-1] == pytest.approx(v.mean(), abs=1e-3)


def test_one_frequency_for_both_channels():
    fs, t = 1000.0, np.arange(600) / 1000.0
    ref = 2 * np.cos(2 * np.pi * 33.3 * t + 0.4) + 0.01 * RNG.normal(size=600)
    x = 0.5 * np.cos(2 * np.pi * 33.3 * t + 1.1) + 0.2 + 0.01 * RNG.normal(size=600)
    f, a, b = numeric.joint_sine(ref, x, fs, 33.0)
    assert f == pytest.approx(33.3, abs=2e-3) and abs(b / a) == pytest.approx(0.25, rel=0.01) and np.angle(b / a) == pytest.approx(0.7, abs=0.01)


def test_delay_that_makes_a_spectrum_causal():
    f = np.logspace(1, 4.5, 60)
    z = 0.05 + 0.01 / (1 + 2j * np.pi * f * 1e-3)
    for true in (0.0, 1e-7, -1.5e-7):
        found, left = numeric.causal_delay(f, z * np.exp(-2j * np.pi * f * true), elements=12)
        assert found == pytest.approx(true, abs=1e-8) and left < 1e-3


def test_relaxation_posterior():
    f, z = spectrum(1e-3)
    tau, gamma, sd, series = numeric.relaxation_posterior(f, z, noise=2e-3)
    assert (gamma >= 0).all() and series == pytest.approx(0.05, rel=0.02) and tau[np.argmax(gamma)] == pytest.approx(1e-2, rel=0.4)
    assert gamma.sum() * np.log(tau[1] / tau[0]) == pytest.approx(0.01, rel=0.15) and (sd > 0).all()


def test_thin_plate():
    x, at = RNG.uniform(0, 10, (12, 2)), RNG.uniform(0, 10, (5, 2))
    v = 60 + x @ np.array([1.0, -0.5])
    value, how = numeric.thin_plate(x, v, np.vstack((x, at)))
    assert how == "spline" and value == pytest.approx(60 + np.vstack((x, at)) @ np.array([1.0, -0.5]), abs=1e-6)
    bent = v + np.sin(x[:, 0])
    assert numeric.thin_plate(x, bent, x)[0] == pytest.approx(bent, abs=1e-6)
    value, how = numeric.thin_plate(x[:3], v[:3], at)
    assert how == "plane" and value == pytest.approx(np.clip(60 + at @ np.array([1.0, -0.5]), v[:3].min() - 15, v[:3].max() + 15), abs=1e-6)
    assert numeric.thin_plate(x[:2], v[:2], at) [0] == pytest.approx(v[:2].mean()) and numeric.thin_plate(x[:0], v[:0], at)[1] == "none"


def test_kept_windows_against_every_order():
    """One window stays of each run of near frequencies, and one that goes overlaps a kept one with a higher level."""
    for _ in range(50):
        n = int(RNG.integers(0, 25))
        f = np.exp(RNG.uniform(0, 2, n))
        a = RNG.uniform(0, 100, n)
        b, snr = a + RNG.uniform(1, 30, n), RNG.permutation(n).astype(float)
        kept = np.flatnonzero(numeric.kept_windows(f, a, b, snr))
        clash = lambda i, j: min(b[i], b[j]) - max(a[i], a[j]) > 0.5 * min(b[i] - a[i], b[j] - a[j])
        assert not any(clash(i, j) for i in kept for j in kept if i < j)
        for i in set(range(n)) - set(kept.tolist()):
            near = [j for j in range(n) if j != i and abs(np.log(f[i] / f[j])) <= np.log(1.02) and snr[j] > snr[i]]
            assert near or any(clash(i, j) and snr[j] > snr[i] for j in kept)


def test_notch_in_blocks_against_a_loop():
    rng = np.random.default_rng(8)
    for n in (0, 1, 2, 63, 64, 65, 1000):
        x = rng.normal(size=n) + 3
        w = 2 * np.pi * 50 / 1000
        alpha = np.sin(w) / 10

        def run(v):
            out, x1, x2, y1, y2 = [], v[0], v[0], v[0], v[0]
            for value in v:
                y = (value - 2 * np.cos(w) * x1 + x2 + 2 * np.cos(w) * y1 - (1 - alpha) * y2) / (1 + alpha)
                x1, x2, y1, y2 = value, x1, y, y1
                out.append(y)
            return np.array(out)

        want = run(run(x)[::-1])[::-1] if n else np.zeros(0)
        assert np.allclose(numeric.notched(x, 1000.0, 50.0, 5.0), want, atol=1e-9)
