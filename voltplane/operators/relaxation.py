"""Relaxation times of spectra with credible bands: a Gaussian process that can't be negative.

A spectrum is a series resistance, an inductance and a density g of relaxations over ln tau, none of them negative. The prior of g is a Gaussian process over ln tau, cut off at 0, with an amplitude,
a width and a mean that lies some amplitudes below 0, so that stretches without relaxations are likely too; the noise is the points' own, times a factor. These four are chosen by the marginal likelihood of the cut-off model: the Gaussian evidence times the share of the posterior
that isn't negative over that of the prior, both by expectation propagation, which has no chance in it. The posterior, a Gaussian within an orthant, is sampled exactly by trajectories that
bounce off its walls (Pakman and Paninski), so bands of g, of resistances and of the spectrum itself, also beyond the measured frequencies, are quantiles of samples.

A row is a spectrum, so spectra are worked on where they lie. The same spectrum gives the same numbers anywhere: random numbers are seeded by nothing else.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_upper = np.frompyfunc(lambda x: 0.5 * math.erfc(x / math.sqrt(2)), 1, 1)
#: Trials of the width in ln tau, of the amplitude over the spectrum's size, of the mean's depth in amplitudes, and of the noise factor.
WIDTHS, AMPLITUDES, DEPTHS, NOISES = (0.4, 0.8, 1.6), (0.1, 0.3, 1.0), (0.0, 1.0, 3.0), (0.5, 1.0, 2.0)


def design(f: np.ndarray, tau: np.ndarray) -> np.ndarray:
    """Columns of the series resistance, the inductance (over the highest frequency) and each relaxation, real parts above imaginary ones."""
    w = 2 * np.pi * f
    step = np.log(tau[1] / tau[0])
    columns = np.column_stack((np.ones_like(w), 1j * w / w.max(), step / (1 + 1j * w[:, None] * tau)))
    return np.vstack((columns.real, columns.imag))


def _cut_moments(z: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """log of the share of a standard normal above -z, and its density there over that share."""
    far = z < -25
    near = np.where(far, 0.0, z)
    share = _upper(-near).astype(float)
    log_share = np.where(far, -0.5 * z * z - 0.5 * math.log(2 * math.pi) - np.log(np.where(far, -z, 1)), np.log(share))
    ratio = np.where(far, -z - 1 / np.where(far, z, 1), np.exp(-0.5 * near * near) / math.sqrt(2 * math.pi) / share)
    return log_share, ratio


def orthant_share(precision: np.ndarray, right: np.ndarray, rounds: int = 200, tolerance: float = 1e-8) -> float:
    """log of the share of a Gaussian in which no entry is negative, by expectation propagation; right: precision times mean."""
    n = len(right)
    t, v = np.zeros(n), np.zeros(n)
    damp, total, last = 1.0, -np.inf, np.inf
    for _ in range(rounds):
        cov = np.linalg.inv(precision + np.diag(t))
        mean, own = cov @ (right + v), np.diag(cov)
        cavity_t, cavity_v = 1 / own - t, mean / own - v
        cavity_t = np.maximum(cavity_t, 1e-12 / own)
        m, s = cavity_v / cavity_t, 1 / np.sqrt(cavity_t)
        log_share, h = _cut_moments(m / s)
        inside = np.maximum(1 - h * (m / s + h), 1e-12)
        new_t = np.maximum(cavity_t / inside - cavity_t, 0)
        new_v = (m + s * h) * (cavity_t + new_t) - cavity_v
        sites = -0.5 * np.log1p(t / cavity_t) + 0.5 * ((cavity_v + v) ** 2 / (cavity_t + t) - cavity_v**2 / cavity_t)
        whole = 0.5 * (np.linalg.slogdet(precision)[1] + np.linalg.slogdet(cov)[1]) + 0.5 * ((right + v) @ mean - right @ np.linalg.solve(precision, right))
        last, total = total, float(log_share.sum() - sites.sum() + whole)
        if abs(total - last) < tolerance * max(1.0, abs(total)):
            break
        t, v = t + damp * (new_t - t), v + damp * (new_v - v)
        damp = 0.7
    return total


def bounced_samples(mean: np.ndarray, root: np.ndarray, start: np.ndarray, n: int, rnd: np.random.Generator, most: int = 5000) -> np.ndarray:
    """Samples of a Gaussian without negative entries. start: an inner point. Each is a quarter turn from the last, with bounces at the walls; a trajectory of more than `most` bounces stays."""
    x = np.linalg.solve(root, start - mean)
    walls = root
    norms = (walls**2).sum(axis=1)
    out = []
    for _ in range(n):
        z, speed, left, count = x.copy(), rnd.normal(size=len(x)), np.pi / 2, 0
        last = -1
        while count < most:
            a, b = walls @ speed, walls @ z
            size = np.hypot(a, b)
            can = size > np.abs(mean) * (1 - 1e-15)
            # b cos t + a sin t + mean = 0, at the first t after now
            phase = np.arctan2(a, b)
            turn = np.arccos(np.clip(np.where(can, -mean / np.where(size > 0, size, 1), 0), -1, 1))
            times = np.minimum((phase + turn) % (2 * np.pi), (phase - turn) % (2 * np.pi))
            later = np.maximum((phase + turn) % (2 * np.pi), (phase - turn) % (2 * np.pi))
            times = np.where(times < 1e-9, later, times)
            if last >= 0:
                times[last] = later[last] if times[last] < 1e-9 or times[last] > 2 * np.pi - 1e-9 else times[last]
            times = np.where(can, times, np.inf)
            k = int(np.argmin(times))
            if times[k] >= left:
                break
            t = times[k]
            z, speed = z * np.cos(t) + speed * np.sin(t), speed * np.cos(t) - z * np.sin(t)
            speed = speed - 2 * (walls[k] @ speed) / norms[k] * walls[k]
            left, last, count = left - t, k, count + 1
        if count < most:
            moved = z * np.cos(left) + speed * np.sin(left)
            if (walls @ moved + mean > -1e-9 * np.abs(mean).max()).all():
                x = moved
        out.append(np.maximum(mean + walls @ x, 0))
    return np.array(out)


def _inner(gram: np.ndarray, right: np.ndarray, rounds: int = 400) -> np.ndarray:
    """A point near the largest density without negative entries, by coordinate descent, a little inside the walls."""
    x = np.maximum(np.linalg.solve(gram, right), 0)
    for _ in range(rounds):
        before = x.copy()
        for i in range(len(x)):
            x[i] = max(0.0, x[i] + (right[i] - gram[i] @ x) / gram[i, i])
        if np.abs(x - before).max() <= 1e-9 * max(1e-300, np.abs(x).max()):
            break
    return x + 1e-3 * np.sqrt(1 / np.diag(gram))


def posterior(f: np.ndarray, z: np.ndarray, sigma_rel: np.ndarray, tau: np.ndarray, samples: int = 400, inductance: bool = False, seed: int = 1) -> tuple[dict, np.ndarray]:
    """The chosen width, amplitude, depth and noise factor with the log evidence, and samples of (series resistance, inductance, g)."""
    rnd = np.random.default_rng(seed)
    a, y = design(f, tau), np.concatenate((z.real, z.imag))
    noise = np.tile(sigma_rel * np.abs(z), 2)
    size = float(np.abs(z).max())
    n, k = len(y), len(tau)
    place = np.log(tau)
    shares: dict[tuple, float] = {}

    def solve(width: float, amplitude: float, depth: float, factor: float):
        shape = np.exp(-0.5 * ((place[:, None] - place) / width) ** 2) + 1e-6 * np.eye(k)
        inverse = np.zeros((k + 2, k + 2))
        inverse[0, 0] = inverse[1, 1] = (10 * size) ** -2.0
        if not inductance:
            inverse[1, 1] = (1e-6 * size) ** -2.0
        plain = np.linalg.inv(shape)
        inverse[2:, 2:] = (plain + plain.T) / 2 / (amplitude * size) ** 2
        middle = np.concatenate((np.zeros(2), np.full(k, -depth * amplitude * size)))
        weighted = a / (factor * noise)[:, None] ** 2
        gram = a.T @ weighted + inverse
        right = weighted.T @ y + inverse @ middle
        if (width, depth) not in shares:
            own = inverse[2:, 2:] * (amplitude * size) ** 2
            shares[width, depth] = orthant_share(own, own @ np.full(k, -depth)) + 2 * math.log(0.5)
        return gram, right, middle @ inverse @ middle, 2 * math.log(10 * size) - math.log(inverse[1, 1]) + np.linalg.slogdet(shape)[1] + 2 * k * math.log(amplitude * size)

    def evidence(width: float, amplitude: float, depth: float, factor: float) -> float:
        gram, right, offset, spread = solve(width, amplitude, depth, factor)
        scale = factor * noise
        # the determinant and the quadratic form of the marginal covariance, by way of the posterior's
        quadratic = ((y / scale) ** 2).sum() + offset - right @ np.linalg.solve(gram, right)
        determinant = 2 * np.log(scale).sum() + spread + np.linalg.slogdet(gram)[1]
        return float(-0.5 * (quadratic + determinant + n * math.log(2 * math.pi)) + orthant_share(gram, right) - shares[width, depth])

    tried = {c: evidence(*c) for c in product(WIDTHS, AMPLITUDES, DEPTHS, NOISES)}
    for step in (1.5, 1.2):
        w, s, d, v = max(tried, key=tried.get)
        for trial in ((w * step, s, d, v), (w / step, s, d, v), (w, s * step, d, v), (w, s / step, d, v), (w, s, d + step - 1, v), (w, s, max(0.0, d - step + 1), v), (w, s, d, v * step), (w, s, d, v / step)):
            tried[trial] = evidence(*trial)
    best = max(tried, key=tried.get)
    gram, right, *_ = solve(*best)
    cov = np.linalg.inv(gram)
    root = np.linalg.cholesky((cov + cov.T) / 2 + 1e-14 * np.diag(np.diag(cov)))
    drawn = bounced_samples(cov @ right, root, _inner(gram, right), samples + samples // 4, rnd)[samples // 4 :]
    return {"width": best[0], "amplitude": best[1], "depth": best[2], "noise": best[3], "evidence": tried[best]}, drawn


def bands(f: np.ndarray, z: np.ndarray, sigma_rel: np.ndarray, beyond: float, per_decade: int, share: float, samples: int, margin: float = 0.0, inductance: bool = False) -> dict:
    """The middle and the band (share of the samples inside) of the resistances, of g, and of the spectrum at its frequencies and up to `beyond` decades above them."""
    # relaxations far outside the band can't be told from the resistances, and a prior without negative values would put some there
    lo, hi = -np.log10(2 * np.pi * f.max()) - margin, -np.log10(2 * np.pi * f.min()) + margin
    tau = 10 ** np.linspace(lo, hi, int(np.ceil((hi - lo) * per_decade)) + 1)
    chosen, drawn = posterior(f, z, sigma_rel, tau, samples, inductance)
    cut = [0.5, 0.5 - share / 2, 0.5 + share / 2]
    further = f.max() * 10 ** (np.arange(1, int(round(beyond * 4)) + 1) / 4)
    out_f = np.concatenate((f, further))
    # the inductance's column is over the highest measured frequency
    a = design(np.append(out_f, f.max()), tau)
    a[:, 1] *= max(out_f.max(), f.max()) / f.max()
    rows = np.concatenate((np.arange(len(out_f)), len(out_f) + 1 + np.arange(len(out_f))))
    spectra = drawn @ a[rows].T
    step = np.log(tau[1] / tau[0])
    quantiles = lambda v: np.quantile(v, cut, axis=0)
    series, polar, g, at = quantiles(drawn[:, 0]), quantiles(drawn[:, 2:].sum(axis=1) * step), quantiles(drawn[:, 2:]), quantiles(spectra)
    m = len(out_f)
    out = chosen | {"tau": tau, "g": g[0], "g_low": g[1], "g_high": g[2], "f": out_f}
    for name, v in (("series", series), ("polarisation", polar)):
        out |= {name: v[0], f"{name}_low": v[1], f"{name}_high": v[2]}
    for name, part in (("re", slice(0, m)), ("im", slice(m, 2 * m))):
        out |= {name: at[0, part], f"{name}_low": at[1, part], f"{name}_high": at[2, part]}
    return out


_ARRAYS = ("tau", "g", "g_low", "g_high", "f", "re", "re_low", "re_high", "im", "im_low", "im_high")
_NUMBERS = ("width", "amplitude", "depth", "noise", "evidence", "series", "series_low", "series_high", "polarisation", "polarisation_low", "polarisation_high")


def relaxation_bands(spectra: DataFrame, keys: list[str], sigma_rel: float = 0.01, beyond: float = 1.0, per_decade: int = 4, share: float = 0.9, samples: int = 400, margin: float = 0.0, inductance: bool = False, least: int = 6) -> DataFrame:
    """(keys, width, amplitude, depth, noise, evidence, series, polarisation, tau, g, f, re, im; …_low and …_high of what has a band): one row a spectrum.

    spectra: skew.assembled(). sigma_rel: each point's standard deviation over its size; the noise factor corrects it. f holds the measured frequencies and, after them, four a decade up
    to `beyond` decades above. margin: decades by which relaxation times reach beyond the measured band on either side.
    inductance: False holds it at 0; an inductance and fast relaxations undo each other, so one that isn't there makes the series resistance look smaller. Spectra of fewer than `least` points, or of a single frequency, have nulls.
    """
    kinds = dict(spectra.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), *(f"{c} double" for c in _NUMBERS), *(f"{c} array<double>" for c in _ARRAYS)])

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for row in pdf.itertuples(index=False):
                head = [getattr(row, k) for k in keys]
                f, z = np.asarray(row.f), np.asarray(row.re) + 1j * np.asarray(row.im)
                found = bands(f, z, np.full(len(f), sigma_rel), beyond, per_decade, share, samples, margin, inductance) if len(f) >= least and f.min() < f.max() else {}
                yield pd.DataFrame([[*head, *(found.get(c) for c in _NUMBERS), *(found[c].tolist() if c in found else None for c in _ARRAYS)]], columns=[*keys, *_NUMBERS, *_ARRAYS])

    return spectra.select(*keys, "f", "re", "im").mapInPandas(each, schema)
