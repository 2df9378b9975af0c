"""Measurement models of spectra: as many relaxations as the data bear, and points that don't fit the others.

A model is a series resistance and some relaxations R / (1 + iw tau). It grows one relaxation at a time, begun where the last model's residuals want one, as long as every resistance's and every ln tau's
confidence interval keeps away from 0 and from its neighbours; the largest model for which they do is kept (the stop of Agarwal and Orazem). With its times held, the model is linear, so what
a point misses by when all others are fitted without it follows from the hat matrix, without refits: for a point's two rows b, (1 - H_bb)^-1 times their residuals. The point that misses most, in its
own standard deviations, goes if it misses by more than a limit, and the rest is judged anew.

A row is a spectrum; spectra are worked on where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from .numeric import minimise


def columns(f: np.ndarray, tau: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """The linear model's columns over the points' weights: real parts above imaginary ones."""
    w = 2 * np.pi * f
    a = np.column_stack([np.ones_like(w, complex), *(1 / (1 + 1j * w * t) for t in tau)]) / weight[:, None]
    return np.vstack((a.real, a.imag))


def stacked(z: np.ndarray, weight: np.ndarray) -> np.ndarray:
    return np.concatenate((z.real, z.imag)) / np.tile(weight, 2)


def fitted(f: np.ndarray, z: np.ndarray, weight: np.ndarray, tau: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Resistances, times, the covariance of (resistances, ln tau) and the reduced chi square, from times to begin with."""
    k = len(tau)
    y = stacked(z, weight)
    begin = np.linalg.lstsq(columns(f, tau, weight), y, rcond=None)[0]

    def residuals(p: np.ndarray) -> np.ndarray:
        return columns(f, np.exp(p[k + 1 :]), weight) @ p[: k + 1] - y

    p, covariance, cost = minimise(residuals, np.concatenate((begin, np.log(tau))))
    return p[: k + 1], np.exp(p[k + 1 :]), covariance, cost / max(1, len(y) - len(p))


def grown(f: np.ndarray, z: np.ndarray, weight: np.ndarray, most: int = 6, sure: float = 1.96) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """fitted() of the largest order, up to `most`, whose intervals of `sure` standard deviations are all sound."""
    y = stacked(z, weight)
    flat = columns(f, np.zeros(0), weight)
    series = np.linalg.lstsq(flat, y, rcond=None)[0]
    rest = y - flat @ series
    chi = float(rest @ rest) / max(1, len(y) - 1)
    best = series, np.zeros(0), np.linalg.pinv(flat.T @ flat) * chi, chi
    tau = np.zeros(0)
    trials = 10 ** np.linspace(-np.log10(2 * np.pi * f.max()) - 0.3, -np.log10(2 * np.pi * f.min()) + 0.3, 40)
    for _ in range(most):
        if len(y) <= 2 * (len(tau) + 1) + 2:
            break
        # the time that leaves least, with those there are held
        left = []
        for t in trials:
            a = columns(f, np.append(tau, t), weight)
            r = y - a @ np.linalg.lstsq(a, y, rcond=None)[0]
            left.append(float(r @ r))
        resistances, times, covariance, chi = fitted(f, z, weight, np.sort(np.append(tau, trials[int(np.argmin(left))])))
        order = np.argsort(times)
        k = len(times)
        spread = np.sqrt(np.maximum(np.diag(covariance), 0))
        sd_r, sd_t = spread[1 : k + 1][order], spread[k + 1 :][order]
        r, log_t = resistances[1:][order], np.log(times[order])
        apart = np.diff(log_t) > sure * np.hypot(sd_t[1:], sd_t[:-1])
        inside = (log_t > np.log(trials[0]) - 1) & (log_t < np.log(trials[-1]) + 1)
        if not (np.isfinite(covariance).all() and (r > sure * sd_r).all() and apart.all() and inside.all() and chi < best[3]):
            break
        tau = times[order]
        index = np.concatenate(([0], 1 + order, k + 1 + order))
        best = np.concatenate((resistances[:1], r)), tau, covariance[np.ix_(index, index)], chi
    return best


def left_out(f: np.ndarray, z: np.ndarray, weight: np.ndarray, tau: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each point's residual when the others alone are fitted, with the times held, and its size in its own standard deviations (without the point's own part in the noise)."""
    n = len(f)
    a, y = columns(f, tau, weight), stacked(z, weight)
    q, _ = np.linalg.qr(a)
    e = y - q @ (q.T @ y)
    total, free = float(e @ e), 2 * n - a.shape[1] - 2
    out, size = np.zeros(n, complex), np.zeros(n)
    for i in range(n):
        b = [i, n + i]
        keep = np.eye(2) - q[b] @ q[b].T
        missing = np.linalg.solve(keep, e[b])
        out[i] = (missing[0] + 1j * missing[1]) * weight[i]
        own = float(e[b] @ missing)
        noise = max(total - own, 0) / max(1, free)
        size[i] = np.sqrt(own / 2 / noise) if noise > 0 else (np.inf if own > 1e-20 * max(1.0, float(y @ y)) else 0.0)
    return out, size


def cleaned(f: np.ndarray, z: np.ndarray, sigma_rel: float, limit: float = 4.0, share: float = 0.2, most: int = 6) -> dict:
    """The model of the points that stay: order, resistances, times, their standard deviations, chi square, and the frequencies that went, worst first."""
    stay, gone = np.ones(len(f), bool), []
    while True:
        weight = sigma_rel * np.abs(z[stay])
        resistances, tau, covariance, chi = grown(f[stay], z[stay], weight, most)
        if len(gone) + 1 > share * len(f) or stay.sum() <= 2 * len(tau) + 4:
            break
        _, size = left_out(f[stay], z[stay], weight, tau)
        worst = int(np.argmax(size))
        if size[worst] <= limit:
            break
        k = np.flatnonzero(stay)[worst]
        gone.append(float(f[k]))
        stay[k] = False
    return {"order": len(tau), "resistances": resistances.tolist(), "tau": tau.tolist(), "errors": np.sqrt(np.maximum(np.diag(covariance), 0)).tolist(), "chi_square": float(chi), "removed": gone}


RESULT = "order int, resistances array<double>, tau array<double>, errors array<double>, chi_square double, removed array<double>"


def measurement_models(spectra: DataFrame, keys: list[str], sigma_rel: float = 0.01, limit: float = 4.0, share: float = 0.2, most: int = 6, least: int = 6) -> DataFrame:
    """(keys, order, resistances, tau, errors, chi_square, removed) of skew.assembled() spectra.

    resistances: the series one first. errors: of these and of ln tau. removed: frequencies of points that went, at most `share` of them. Spectra of fewer than `least` points, or of a single frequency, have nulls.
    """
    kinds = dict(spectra.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), RESULT])
    names = [c.split(" ")[0] for c in RESULT.split(", ")]

    def each(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for row in pdf.itertuples(index=False):
                f, z = np.asarray(row.f), np.asarray(row.re) + 1j * np.asarray(row.im)
                found = cleaned(f, z, sigma_rel, limit, share, most) if len(f) >= least and f.min() < f.max() else {}
                rows.append([*(getattr(row, k) for k in keys), *(found.get(c) for c in names)])
            yield pd.DataFrame(rows, columns=[*keys, *names]).astype({"order": "Int32"})

    return spectra.select(*keys, "f", "re", "im").mapInPandas(each, schema)
