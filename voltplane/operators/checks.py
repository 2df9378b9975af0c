"""Repairs and plausibility checks of spectra, cards and calibrations: each keeps what it judged and why."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def polarity(points: DataFrame, key: str, re: str, snr: str, least_snr: float = 8.0, most: float = 30.0, share: float = 0.6) -> DataFrame:
    """(key, n_used, negative_share, sign): one sign a segment, -1 where over `share` of the weight has a negative real part.

    Points of at least least_snr count, all points where fewer than three reach it; the weight is the SNR kept within 0.1 and `most`.
    """
    good = F.col(snr) >= least_snr
    weight = F.greatest(F.lit(0.1), F.least(F.lit(most), F.col(snr)))
    sums = points.groupBy(key).agg(
        F.count_if(good).alias("_good"),
        F.count(F.lit(1)).alias("_n"),
        *[F.sum(F.when(where & test, weight).otherwise(0.0)).alias(name) for name, where, test in (("_w", F.lit(True), F.lit(True)), ("_neg", F.lit(True), F.col(re) < 0), ("_wg", good, F.lit(True)), ("_negg", good, F.col(re) < 0))],
    )
    some = F.col("_good") >= 3
    part = F.when(some, F.col("_negg") / F.col("_wg")).otherwise(F.col("_neg") / F.col("_w"))
    return sums.select(key, F.when(some, F.col("_good")).otherwise(F.col("_n")).alias("n_used"), part.alias("negative_share"), F.when(part > share, -1).otherwise(1).alias("sign"))


def passivity(points: DataFrame, card: str, segment: str, re: str) -> DataFrame:
    """(card, n_segments, n_failing, worst, verdict): a segment fails with any real part that isn't positive."""
    each = points.groupBy(card, segment).agg(F.bool_or(F.col(re) <= 0).alias("_bad"), F.min(re).alias("_least"))
    return each.groupBy(card).agg(F.count(F.lit(1)).alias("n_segments"), F.count_if("_bad").alias("n_failing"), F.min("_least").alias("worst")).withColumn("verdict", F.when(F.col("n_failing") > 0, "fail").otherwise("pass"))


def share_faults(values: DataFrame, edges: DataFrame, value: str, ratio: float, least: int = 2) -> DataFrame:
    """(segment, share, n_ring, reason): segments whose value is below `ratio` or above 1 / ratio of the median of their neighbours."""
    ring = edges.join(values.select(F.col("segment").alias("neighbour"), F.col(value).alias("_v")), "neighbour").groupBy("segment").agg(F.median("_v").alias("_m"), F.count("_v").alias("n_ring"))
    share = F.col(value) / F.when(F.col("_m") != 0, F.col("_m"))
    out = values.join(ring, "segment", "left").withColumn("share", share)
    reason = F.when(F.coalesce(F.col("n_ring"), F.lit(0)) < least, "").when(F.col("share") < ratio, "low").when(F.col("share") > 1 / ratio, "high").otherwise("")
    return out.select("segment", "share", F.coalesce("n_ring", F.lit(0)).alias("n_ring"), F.coalesce(reason, F.lit("")).alias("reason"))


def imputed(values: DataFrame, coefficients: list[str]) -> DataFrame:
    """The rows with missing coefficients replaced by the median of those that are known, and `imputed` where any was."""
    middle = values.agg(*[F.median(c).alias(f"_{c}") for c in coefficients])
    # one row of medians
    filled = values.join(F.broadcast(middle))
    missing = F.lit(False)
    for c in coefficients:
        missing = missing | F.col(c).isNull()
    return filled.select(*[F.coalesce(F.col(c), F.col(f"_{c}")).alias(c) if c in coefficients else F.col(c) for c in values.columns], missing.alias("imputed"))


def rung(frequency: Column, first: float, ratio: float) -> tuple[Column, Column]:
    """The rung of a geometric ladder that a frequency is nearest to, and how far off it is, relative to the rung."""
    k = F.round(F.log(frequency / first) / F.log(F.lit(ratio)))
    return k.cast("long"), F.abs(frequency / (first * F.pow(F.lit(ratio), k)) - 1)


def check_status(n_bad: Column, n_doubtful: Column, n: Column, most: float = 0.1) -> Column:
    """The status of a check over counted verdicts: fail above a share of bad ones, warn with any bad or doubtful one, unknown over none."""
    return F.when(n == 0, "unknown").when(n_bad > most * n, "fail").when(n_bad + n_doubtful > 0, "warn").otherwise("pass")


def banded_check(values: DataFrame, group: list[str], value: Column, good: float, doubtful: float) -> DataFrame:
    """Counts per group of values within good, within doubtful, beyond it and unknown, and the status of the check."""
    off = F.abs(value)
    out = values.groupBy(*group).agg(F.count_if(off <= good).alias("n_good"), F.count_if((off > good) & (off <= doubtful)).alias("n_doubtful"), F.count_if(off > doubtful).alias("n_bad"), F.count_if(off.isNull()).alias("n_unknown"))
    return out.withColumn("status", check_status(F.col("n_bad"), F.col("n_doubtful"), F.col("n_good") + F.col("n_doubtful") + F.col("n_bad")))


def band_masses(gamma: Column, log10_tau: Column, step: Column, edges: list[float], names: list[str]) -> list[Column]:
    """The mass of a distribution of relaxation times within each band of log10 tau; null where a band's sum is negative."""
    pairs = F.zip_with(gamma, log10_tau, lambda g, t: F.struct(g.alias("g"), t.alias("t")))
    masses = [(name, _mass(pairs, low, high) * step) for name, low, high in zip(names, edges[:-1], edges[1:], strict=True)]
    return [F.when(mass >= 0, mass).alias(name) for name, mass in masses]


def _mass(pairs: Column, low: float, high: float) -> Column:
    return F.aggregate(pairs, F.lit(0.0), lambda s, x: s + F.when((x["t"] >= low) & (x["t"] < high), x["g"]).otherwise(0.0))


def says(name: Column, pattern: str, wanted: Column) -> Column:
    """Whether a name names what is wanted: true, false, or null where the name says nothing or nothing is wanted."""
    found = F.regexp_extract(name, pattern, 1)
    return F.when(found == "", F.lit(None).cast("boolean")).otherwise(F.lower(found) == F.lower(wanted))


def card_ratios(phasors: DataFrame, card: str, step: str, size: str, angle: str, usable: Column) -> DataFrame:
    """Per card and step: its size over the median size of the usable cards, and its angle off their circular mean."""
    turn = phasors.where(usable).groupBy(step).agg(F.median(size).alias("_m"), F.atan2(F.sum(F.sin(angle)), F.sum(F.cos(angle))).alias("_a"))
    off = F.col(angle) - F.col("_a")
    return phasors.where(usable).join(turn, step).select(card, step, (F.col(size) / F.col("_m")).alias("ratio"), F.atan2(F.sin(off), F.cos(off)).alias("turned"))


def gain_verdicts(ratios: DataFrame, card: str, good: float = 0.02, flat: float = 0.05) -> DataFrame:
    """Per card the median ratio, its flatness over the steps, a verdict, and whether one factor corrects it."""
    out = ratios.groupBy(card).agg(F.count(F.lit(1)).alias("n_steps"), F.median("ratio").alias("gain"), (F.stddev_pop("ratio") / F.avg("ratio")).alias("spread"), F.median("turned").alias("turned"))
    verdict = F.when(F.abs(F.col("gain") - 1) <= good, "agrees").when(F.col("spread") <= flat, "gain").otherwise("shape")
    return out.withColumn("verdict", verdict).withColumn("correctable", F.col("verdict") == "gain")


def linearity(steps: DataFrame, key: str, i: str, u: str) -> DataFrame:
    """(key, slope, linearity_pct): the largest distance from the straight line through a key's steps, relative to the span of u."""
    line = steps.groupBy(key).agg(F.regr_slope(u, i).alias("slope"), F.regr_intercept(u, i).alias("_b"), (F.max(u) - F.min(u)).alias("_span"))
    far = steps.join(line, key).groupBy(key, "slope", "_span").agg(F.max(F.abs(F.col(u) - F.col("slope") * F.col(i) - F.col("_b"))).alias("_far"))
    return far.select(key, "slope", (100 * F.col("_far") / F.when(F.col("_span") > 0, F.col("_span"))).alias("linearity_pct"))


def implied_area(steps: DataFrame, key: str, ratio: Column, most: float = 5.0) -> DataFrame:
    """(key, area, cv, outlier): the median ratio of a segment's steps, their spread, and whether it is over `most` MAD from the plate's median."""
    each = steps.groupBy(key).agg(F.median(ratio).alias("area"), (F.stddev_pop(ratio) / F.avg(ratio)).alias("cv"))
    middle = each.agg(F.median("area").alias("_m"))
    # one row each
    off = each.join(F.broadcast(middle)).withColumn("_d", F.abs(F.col("area") - F.col("_m")))
    return off.join(F.broadcast(off.agg(F.median("_d").alias("_mad")))).select(key, "area", "cv", (F.col("_d") > most * F.col("_mad")).alias("outlier"))


def prominence(windows: DataFrame, key: str, values: str, guard: int) -> DataFrame:
    """(key, peak, prominence): the largest value's place and its height in robust sigmas of the values beyond the guard around it."""
    each = windows.select(key, F.posexplode(values).alias("_k", "_v"))
    top = each.groupBy(key).agg(F.max(F.struct("_v", (-F.col("_k")).alias("_n"))).alias("_t")).select(key, F.col("_t._v").alias("_peak"), (-F.col("_t._n")).alias("peak"))
    far = each.join(top, key).where(F.abs(F.col("_k") - F.col("peak")) > guard)
    middle = far.groupBy(key, "peak", "_peak").agg(F.median("_v").alias("_m"))
    spread = far.join(middle.select(key, "_m"), key).groupBy(key).agg(F.median(F.abs(F.col("_v") - F.col("_m"))).alias("_s"))
    return middle.join(spread, key).select(key, "peak", ((F.col("_peak") - F.col("_m")) / (1.4826 * F.when(F.col("_s") > 0, F.col("_s")))).alias("prominence"))


def anchor(traces: DataFrame, card: str, t: str, value: str) -> DataFrame:
    """(card, median_r, is_anchor): of three cards at least, the one with the highest median |r| against all others; of fewer the first."""
    other = traces.select(t, F.col(card).alias("_c"), F.col(value).alias("_v"))
    r = traces.join(other, t).where(F.col(card) != F.col("_c")).groupBy(card, "_c").agg(F.abs(F.corr(value, "_v")).alias("_r"))
    rated = traces.select(card).distinct().join(r.groupBy(card).agg(F.median("_r").alias("median_r")), card, "left")
    best = rated.agg(F.count(F.lit(1)).alias("_n"), F.min(card).alias("_first"), F.max_by(card, F.struct("median_r", card)).alias("_best"))
    return rated.join(F.broadcast(best)).select(card, "median_r", (F.col(card) == F.when(F.col("_n") < 3, F.col("_first")).otherwise(F.col("_best"))).alias("is_anchor"))


def nyquist_zones(channels: DataFrame, group: str, angle: str, tau: str, alias_hz: float, fs: float, most: int = 4, gain: float = 0.15) -> DataFrame:
    """Per group of channels the frequency, in zone m of the sampling, at which their angles agree best with their delays.

    Odd sides are conjugated. undersampled: the best is beyond the base frequency and beats it by `gain`.
    """
    candidates = [(0, alias_hz, 1)] + [(m, m * fs + s * alias_hz, s) for m in range(1, most + 1) for s in (-1, 1)]
    listed = F.array(*[F.struct(F.lit(m).alias("zone"), F.lit(float(f)).alias("hz"), F.lit(s).alias("side")) for m, f, s in candidates])
    each = channels.withColumn("_x", F.explode(listed)).select(group, angle, tau, "_x.*")
    turn = F.col("side") * F.col(angle) - 2 * F.pi() * F.col("hz") * F.col(tau)
    score = each.groupBy(group, "zone", "side", "hz").agg((F.sqrt(F.pow(F.sum(F.cos(turn)), 2) + F.pow(F.sum(F.sin(turn)), 2)) / F.count(F.lit(1))).alias("r"))
    base = score.groupBy(group).agg(F.max(F.when(F.col("zone") == 0, F.col("r"))).alias("_base"), F.max_by(F.struct("zone", "hz", "r"), F.struct(F.round("r", 9), -F.col("hz"))).alias("_b"))
    return base.select(group, "_b.zone", "_b.hz", "_b.r", ((F.col("_b.zone") > 0) & (F.col("_b.r") > F.col("_base") + gain)).alias("undersampled"))


def confined(windows: DataFrame, group: list[str], start: str, stop: str, least: float) -> DataFrame:
    """Windows cut where they run into the next one of their group, with `kept` where `least` is left."""
    order = Window.partitionBy(*group).orderBy(start, stop)
    out = windows.withColumn("_next", F.lead(start).over(order)).withColumn(stop, F.least(F.col(stop), F.coalesce("_next", F.col(stop)))).drop("_next")
    return out.withColumn("kept", F.col(stop) - F.col(start) >= least)


def spectrum_outliers(spectra: DataFrame, edges: DataFrame, least: int = 4) -> DataFrame:
    """Per segment against the complex median of its neighbours at equal frequencies: the median and the worst ratio in dB, and the median turn in degrees."""
    other = spectra.select(F.col("segment").alias("neighbour"), "freq_hz", F.col("re").alias("_re"), F.col("im").alias("_im"))
    ring = edges.join(other, "neighbour").groupBy("segment", "freq_hz").agg(F.median("_re").alias("_re"), F.median("_im").alias("_im"))
    size = lambda a, b: F.sqrt(F.col(a) * F.col(a) + F.col(b) * F.col(b))
    turn = F.atan2(F.col("im"), F.col("re")) - F.atan2(F.col("_im"), F.col("_re"))
    both = spectra.join(ring, ["segment", "freq_hz"]).withColumn("_db", 20 * F.log10(size("re", "im") / size("_re", "_im"))).withColumn("_deg", F.degrees(F.atan2(F.sin(turn), F.cos(turn))))
    out = both.groupBy("segment").agg(F.count(F.lit(1)).alias("n_points"), F.median("_db").alias("median_db"), F.max_by("_db", F.struct(F.abs(F.round("_db", 9)), F.col("freq_hz"))).alias("worst_db"), F.median("_deg").alias("median_deg"))
    return out.where(F.col("n_points") >= least)


def half_coverage_grid(spectra: DataFrame, segment: str, frequency: str, share: float = 0.5) -> DataFrame:
    """(frequency, n_segments, share): the frequencies that at least a share of all segments was measured at."""
    total = spectra.agg(F.countDistinct(segment).alias("_n"))
    each = spectra.groupBy(frequency).agg(F.countDistinct(segment).alias("n_segments"))
    return each.join(F.broadcast(total)).withColumn("share", F.col("n_segments") / F.col("_n")).where(F.col("share") >= share).drop("_n")
