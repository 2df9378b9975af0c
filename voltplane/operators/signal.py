"""Phasors and spectra of array-valued windows, in column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def as_double(window: Column) -> Column:
    return F.transform(window, lambda x: x.cast("double"))


def dft(window: Column, cycles: int | float) -> tuple[Column, Column]:
    """Cosine and sine sums of a window that holds so many cycles."""
    n = F.size(window)
    turn = lambda i: 2 * math.pi * cycles * i / n
    return _sum(F.transform(window, lambda x, i: x * F.cos(turn(i)))), _sum(F.transform(window, lambda x, i: x * F.sin(turn(i))))


def phasor(window: Column, cycles: int | float) -> tuple[Column, Column]:
    """Real and imaginary part of the amplitude at a whole number of cycles: the least-squares sine fit, as the columns are orthogonal."""
    c, s = dft(window, cycles)
    return 2 * c / F.size(window), -2 * s / F.size(window)


def mean(window: Column) -> Column:
    return _sum(window) / F.size(window)


def residual_rms(window: Column, re: Column, im: Column) -> Column:
    """RMS of what a fit of mean and one sine leaves, by Parseval; 0 where rounding makes it negative."""
    power = _sum(F.transform(window, lambda x: x * x)) / F.size(window) - F.pow(mean(window), 2)
    return F.sqrt(F.greatest(F.lit(0.0), power - (re * re + im * im) / 2))


def snr_db(re: Column, im: Column, rms: Column) -> Column:
    return F.when(rms > 0, 20 * F.log10(F.sqrt((re * re + im * im) / 2) / rms))


def harmonic_distortion(window: Column, cycles: int, orders: tuple[int, ...] = (2, 3)) -> Column:
    """The RSS amplitude of the harmonics over that of the fundamental."""
    size = lambda k: sum((p * p for p in phasor(window, k)), F.lit(0.0))
    base = size(cycles)
    return F.sqrt(sum((size(cycles * k) for k in orders), F.lit(0.0))) / F.when(base > 0, F.sqrt(base))


def cross_spectra(frames: DataFrame, group: list[str], x_re: str, x_im: str, y_re: str, y_im: str) -> DataFrame:
    """Per group the averaged auto and cross spectra, the H1, H2 and Hv estimators of y / x, and the coherence.

    Sxy = conj(X) Y. H1 = Sxy / Sxx; H2 = Syy / conj(Sxy); Hv = sqrt(Syy / Sxx) with the phase of Sxy; null where a spectrum is zero.
    """
    a, b, c, d = (F.col(n) for n in (x_re, x_im, y_re, y_im))
    s = frames.groupBy(*group).agg(F.avg(a * a + b * b).alias("sxx"), F.avg(c * c + d * d).alias("syy"), F.avg(a * c + b * d).alias("sxy_re"), F.avg(a * d - b * c).alias("sxy_im"), F.count(F.lit(1)).alias("n_frames"))
    cross = F.col("sxy_re") * F.col("sxy_re") + F.col("sxy_im") * F.col("sxy_im")
    sxx, some = F.when(F.col("sxx") > 0, F.col("sxx")), F.when(cross > 0, cross)
    size = F.sqrt(F.col("syy") / sxx)
    return s.select(
        "*",
        (F.col("sxy_re") / sxx).alias("h1_re"),
        (F.col("sxy_im") / sxx).alias("h1_im"),
        (F.col("syy") * F.col("sxy_re") / some).alias("h2_re"),
        (F.col("syy") * F.col("sxy_im") / some).alias("h2_im"),
        (size * F.col("sxy_re") / F.sqrt(some)).alias("hv_re"),
        (size * F.col("sxy_im") / F.sqrt(some)).alias("hv_im"),
        (cross / F.when(F.col("sxx") * F.col("syy") > 0, F.col("sxx") * F.col("syy"))).alias("coherence"),
    )


def relative_sigma(coherence: Column, n_eff: Column) -> Column:
    """Relative standard deviation of H1 from the coherence."""
    return F.sqrt((1 - coherence) / (2 * F.when(coherence * n_eff > 0, coherence * n_eff)))


def sigma_from_snr(snr: Column, n: Column, floor: float = 1e-3, ceiling: float = 1.0) -> Column:
    """The Cramer-Rao bound of a phasor's relative error, kept within floor and ceiling; null for fewer than one sample."""
    return F.when(n >= 1, F.least(F.lit(ceiling), F.greatest(F.lit(floor), F.sqrt(1 / (n * F.pow(F.lit(10.0), snr / 10))))))


def combined_snr(a: Column, b: Column) -> Column:
    """SNR in dB of the ratio of two phasors."""
    return -10 * F.log10(F.pow(F.lit(10.0), -a / 10) + F.pow(F.lit(10.0), -b / 10))


def level_gate(frames: DataFrame, group: list[str], level: str, k: float = 4.0, most: float = 0.5) -> DataFrame:
    """The frames with `accepted`: within k * 1.4826 MAD of the group's median level. A group of which more than `most` would go keeps all."""
    middle = frames.groupBy(*group).agg(F.median(level).alias("_m"))
    marked = frames.join(middle, group)
    spread = marked.groupBy(*group).agg(F.median(F.abs(F.col(level) - F.col("_m"))).alias("_s"))
    marked = marked.join(spread, group).withColumn("_ok", F.abs(F.col(level) - F.col("_m")) <= k * 1.4826 * F.col("_s"))
    share = marked.groupBy(*group).agg(F.avg(F.when(F.col("_ok"), 0.0).otherwise(1.0)).alias("_out"))
    return marked.join(share, group).withColumn("accepted", F.col("_ok") | (F.col("_out") > most)).drop("_m", "_s", "_ok", "_out")


def background(frames: DataFrame, group: list, window: str, cycles: int, n: int, away: tuple[int, ...]) -> DataFrame:
    """(group, n_windows, background): the coherent amplitude at so many cycles in windows of n samples, less the mean power of the bins `away` on both sides; 0 below it."""
    power = lambda k: sum((x * x for x in dft(F.col(window), k)), F.lit(0.0)) * 4 / (n * n)
    off = [cycles + side * k for k in away for side in (-1, 1)]
    each = frames.select(*group, power(cycles).alias("_own"), (sum((power(k) for k in off), F.lit(0.0)) / len(off)).alias("_off"))
    keys = [c for c in each.columns if not c.startswith("_")]
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_windows"), F.sqrt(F.greatest(F.lit(0.0), F.avg("_own") - F.avg("_off"))).alias("background"))
