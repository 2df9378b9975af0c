"""Delays that many spectra share, fitted by variable projection.

A spectrum of a group (a card) is turned by exp(-i w dt), with dt = theta . basis: theta is the group's, basis the spectrum's own (1 for a common delay, its place
in the multiplexer for one that grows with it). Undone, a spectrum is consistent with Kramers and Kronig: a series resistance, relaxations on a fixed grid of
times and, if asked for, an inductance (which a delay is much like, at low frequencies), all linear. These linear parts are projected out of each spectrum by itself, which leaves three numbers a spectrum and round: the residual's square, the
derivative's square and their product. They add up over a group on the map side, and a Gauss-Newton step a round is taken on the sums. No spectrum leaves its task.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assembled(points: DataFrame, keys: list[str], frequency: str = "freq_hz", re: str = "re", im: str = "im", kept: list[str] | None = None) -> DataFrame:
    """(keys, kept, f, re, im): one row a spectrum, by frequency. Points with a null, a number that isn't finite, no size or no positive frequency go. kept: columns that a spectrum has one value of."""
    sound = (F.col(frequency) > 0) & (F.abs(re) + F.abs(im) > 0) & (F.abs(re) + F.abs(im) < float("inf")) & (F.col(frequency) < float("inf"))
    rows = F.sort_array(F.collect_list(F.struct(F.col(frequency).alias("f"), F.col(re).alias("re"), F.col(im).alias("im"))))
    out = points.where(sound).groupBy(*keys).agg(rows.alias("_p"), *[F.first(c, ignorenulls=True).alias(c) for c in kept or []])
    return out.select(*keys, *(kept or []), *[F.col(f"_p.{n}").cast("array<double>").alias(n) for n in ("f", "re", "im")])


def linear_part(f: np.ndarray, size: np.ndarray, per_decade: float | None, inductance: bool = False) -> np.ndarray:
    """An orthonormal basis of the consistent spectra at these frequencies, each point over its size, real parts above imaginary ones. per_decade: of relaxation times; None for none."""
    w = 2 * np.pi * f
    columns = [np.ones_like(f, complex)] + [1j * w / w.max()] * inductance
    if per_decade is not None:
        lo, hi = -np.log10(w.max()), -np.log10(w.min())
        columns += [1 / (1 + 1j * w * 10**t) for t in np.linspace(lo, hi, max(2, int(round((hi - lo) * per_decade)) + 1))]
    a = np.column_stack(columns) / size[:, None]
    u, s, _ = np.linalg.svd(np.vstack((a.real, a.imag)), full_matrices=False)
    return u[:, s > 1e-10 * s[0]]


def projected(f: np.ndarray, z: np.ndarray, dt: float, per_decade: float | None, inductance: bool = False) -> tuple[float, float, float]:
    """The squares of the derivative and of the residual after dt is undone, and their product, without the linear part."""
    basis = linear_part(f, np.abs(z), per_decade, inductance)
    turned = z / np.abs(z) * np.exp(2j * np.pi * f * dt)
    slope = 2j * np.pi * f * turned
    r, g = (np.concatenate((v.real, v.imag)) for v in (turned, slope))
    r, g = r - basis @ (basis.T @ r), g - basis @ (basis.T @ g)
    return float(g @ g), float(g @ r), float(r @ r)


def _sums(spectra: DataFrame, group: list[str], bases: list[str], theta: dict[tuple, np.ndarray], per_decade: float | None, inductance: bool) -> dict[tuple, tuple[np.ndarray, np.ndarray, float, int, int]]:
    """Per group the sums of a round: normal matrix, right side, cost, spectra, points."""
    spark = spectra.sparkSession

    @F.pandas_udf("struct<gg:double,gr:double,rr:double>")
    def each(f: pd.Series, re: pd.Series, im: pd.Series, dt: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([projected(np.asarray(a), np.asarray(b) + 1j * np.asarray(c), d, per_decade, inductance) for a, b, c, d in zip(f, re, im, dt, strict=True)], columns=["gg", "gr", "rr"])

    if theta:
        kinds = dict(spectra.dtypes)
        schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in group), *(f"_t{i} double" for i in range(len(bases)))])
        now = spark.createDataFrame([(*k, *map(float, t)) for k, t in theta.items()], schema)
        spectra = spectra.join(F.broadcast(now), group)
        dt = sum((F.col(f"_t{i}") * F.col(b) for i, b in enumerate(bases)), F.lit(0.0))
    else:
        dt = F.lit(0.0)
    rows = spectra.withColumn("_v", each("f", "re", "im", dt))
    p = range(len(bases))
    sums = rows.groupBy(*group).agg(
        *[F.sum(F.col("_v.gg") * F.col(bases[i]) * F.col(bases[j])).alias(f"_m{i}_{j}") for i in p for j in p if i <= j],
        *[F.sum(F.col("_v.gr") * F.col(bases[i])).alias(f"_g{i}") for i in p],
        F.sum("_v.rr").alias("_cost"),
        F.count(F.lit(1)).alias("_n"),
        F.sum(F.size("f")).alias("_points"),
    )
    out = {}
    for row in sums.collect():
        m = np.array([[row[f"_m{min(i, j)}_{max(i, j)}"] for j in p] for i in p])
        out[tuple(row[k] for k in group)] = (m, np.array([row[f"_g{i}"] for i in p]), row._cost, row._n, row._points)
    return out


def shared_skew(spectra: DataFrame, group: list[str], bases: list[str], per_decade: float | None = 2.0, inductance: bool = False, rounds: int = 12, tolerance: float = 1e-10) -> DataFrame:
    """(group, theta array, error array, cost_before, cost, n_spectra, rounds): the delays of each group in seconds a unit of each basis.

    spectra: assembled(), with the bases as columns; a spectrum with a null basis, or fewer points than its linear part has columns, takes no part. A step that doesn't lower the cost is
    halved. Rounds end when every group's step changes its cost by less than `tolerance` of it. error: standard errors from the normal matrix; bases that the group can't tell apart share
    what they explain, with an infinite error. Only groups' sums, a few numbers each, reach the driver.
    """
    least = F.lit(3) if per_decade is None else 2 + F.ceil(per_decade * F.log10(F.array_max("f") / F.array_min("f"))) / 2
    held = spectra.where((F.size("f") > least) & sum((F.col(b).isNull().cast("int") for b in bases), F.lit(0)).__eq__(0)).select(*group, *[F.col(b).cast("double").alias(b) for b in bases], "f", "re", "im").persist(StorageLevel.MEMORY_AND_DISK)
    try:
        state: dict[tuple, dict] = {}
        for k in range(rounds + 1):
            sums = _sums(held, group, bases, {g: s["trial"] for g, s in state.items()}, per_decade, inductance)
            moving = False
            for g, (m, right, cost, n, points) in sums.items():
                if g not in state:
                    s = state[g] = {"theta": np.zeros(len(bases)), "first": cost, "n": n, "rounds": 0, "step": None}
                    better = True
                else:
                    s = state[g]
                    better = cost <= s["cost"]
                if s.get("done"):
                    continue
                s["rounds"] = k
                if better:
                    change = (s["cost"] - cost) / s["cost"] if s["step"] is not None and s["cost"] > 0 else None
                    s["theta"] = s["theta"] if s["step"] is None else s["trial"]
                    # bases differ in scale
                    scale = np.sqrt(np.where(np.diag(m) > 0, np.diag(m), 1))
                    scaled = m / np.outer(scale, scale)
                    s["step"] = -np.linalg.lstsq(scaled, right / scale, rcond=1e-9)[0] / scale
                    values = np.linalg.eigvalsh(scaled)
                    known = values[0] > 1e-9 * values[-1] > 0
                    dof = max(1, 2 * points - n - len(bases))
                    s["error"] = np.sqrt(np.diag(np.linalg.inv(scaled)) * cost / dof) / scale if known else np.full(len(bases), np.inf)
                    s["cost"] = cost
                    s["done"] = change is not None and change <= tolerance
                else:
                    s["step"] = s["step"] / 2
                    s["done"] = bool(np.abs(s["step"]).max() < 1e-3 * tolerance * max(1e-12, np.abs(s["theta"]).max()))
                s["trial"] = s["theta"] if s["done"] else s["theta"] + s["step"]
                moving = moving or not s["done"]
            if not moving:
                break
    finally:
        held.unpersist()
    kinds = dict(spectra.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in group), "theta array<double>, error array<double>, cost_before double, cost double, n_spectra long, rounds int"])
    return spectra.sparkSession.createDataFrame([(*g, s["theta"].tolist(), s["error"].tolist(), float(s["first"]), float(s["cost"]), int(s["n"]), int(s["rounds"])) for g, s in state.items()], schema)


def chosen_basis(spectra: DataFrame, group: list[str], candidates: dict[str, list[str]], least_gain: float = 0.05, **how) -> tuple[str, dict[str, DataFrame]]:
    """The name of the bases that fit all groups best, and each candidate's shared_skew(). A candidate with more bases must lower the summed cost by a further `least_gain` of it."""
    fits = {name: shared_skew(spectra, group, bases, **how) for name, bases in candidates.items()}
    costs = {name: fit.agg(F.sum("cost")).first()[0] or 0.0 for name, fit in fits.items()}
    best = None
    for name in sorted(candidates, key=lambda c: (len(candidates[c]), costs[c], c)):
        if best is None or costs[name] < costs[best] * (1 - (least_gain if len(candidates[name]) > len(candidates[best]) else 0)):
            best = name
    return best, fits


def deskewed(points: DataFrame, skews: DataFrame, group: list[str], bases: list[str], frequency: str = "freq_hz", re: str = "re", im: str = "im") -> DataFrame:
    """The points with their group's delay undone; points of groups without one stay as they are."""
    known = points.join(skews.select(*group, "theta"), group, "left")
    dt = sum((F.col("theta")[i] * F.col(b) for i, b in enumerate(bases)), F.lit(0.0))
    turn = 2 * F.pi() * F.col(frequency) * F.coalesce(dt, F.lit(0.0))
    new_re = F.col(re) * F.cos(turn) - F.col(im) * F.sin(turn)
    new_im = F.col(re) * F.sin(turn) + F.col(im) * F.cos(turn)
    return known.select(*[new_re.alias(c) if c == re else new_im.alias(c) if c == im else F.col(c) for c in points.columns])
