"""Aggregations over segments: parallel sums, closures, regressions, per-card factors."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ac_rms(value: str) -> Column:
    """RMS after the mean is removed."""
    return F.stddev_pop(value)


def admittance(area: Column, re: Column, im: Column) -> tuple[Column, Column]:
    """Real and imaginary part of area / z."""
    size = re * re + im * im
    return F.when(size > 0, area * re / size), F.when(size > 0, -area * im / size)


def parallel_sum(points: DataFrame, keys: list[str], area: str, re: str, im: str, cell_area: float) -> DataFrame:
    """Per key the whole-cell spectrum: segments lie in parallel, so area / z adds up.

    z_re, z_im in ohm; z_used_* for the area that returned a value, z_full_* for the whole cell; coverage of the area; number of segments.
    """
    y_re, y_im = admittance(F.col(area), F.col(re), F.col(im))
    total = points.select(*keys, F.col(area).alias("_a"), y_re.alias("_yr"), y_im.alias("_yi")).where(F.col("_yr").isNotNull())
    total = total.groupBy(*keys).agg(F.sum("_yr").alias("y_re"), F.sum("_yi").alias("y_im"), F.sum("_a").alias("area_used"), F.count(F.lit(1)).alias("n_segments"))
    size = F.col("y_re") * F.col("y_re") + F.col("y_im") * F.col("y_im")
    z_re, z_im = F.when(size > 0, F.col("y_re") / size), F.when(size > 0, -F.col("y_im") / size)
    return total.select(
        *keys,
        z_re.alias("z_re"),
        z_im.alias("z_im"),
        (z_re * F.col("area_used")).alias("z_used_re"),
        (z_im * F.col("area_used")).alias("z_used_im"),
        (z_re * cell_area).alias("z_full_re"),
        (z_im * cell_area).alias("z_full_im"),
        "area_used",
        (F.col("area_used") / cell_area).alias("coverage"),
        "n_segments",
    )


def parallel_resistance(area: Column, r: Column, sd: Column, cell_area: float) -> tuple[Column, Column]:
    """cell_area / sum(A / R) over positive R, and its standard deviation."""
    good = r > 0
    s = F.sum(F.when(good, area / r))
    spread = F.sqrt(F.sum(F.when(good, F.pow(cell_area * area * sd / (r * r), 2)))) / (s * s)
    return cell_area / s, spread


def in_every(points: DataFrame, member: str, key: Column) -> DataFrame:
    """The keys that every member has: relational division."""
    n = points.agg(F.countDistinct(member).alias("_n"))
    have = points.select(member, key.alias("key")).distinct().groupBy("key").agg(F.count(F.lit(1)).alias("n_members"))
    return have.join(F.broadcast(n), F.col("n_members") == F.col("_n")).drop("_n")


def dc_closure(j: Column, area: Column, cell_area: float, setpoint: Column) -> list[Column]:
    """The total current, extended to the cell's area, and its deviation from the setpoint in percent."""
    total = F.sum(j * area) * cell_area / F.sum(area)
    return [total.alias("total"), (100 * (total / setpoint - 1)).alias("deviation_pct")]


def tile_stats(value: str) -> list[Column]:
    """n, mean, median, sample sd, cv %, min, max, span % of tiles."""
    mean = F.avg(value)
    safe = F.when(mean != 0, mean)
    return [
        F.count(value).alias("n_tiles"),
        mean.alias("mean"),
        F.median(value).alias("median"),
        F.stddev_samp(value).alias("sd"),
        (100 * F.stddev_samp(value) / safe).alias("cv_pct"),
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        (100 * (F.max(value) - F.min(value)) / safe).alias("span_pct"),
    ]


def line(x: str, y: str) -> list[Column]:
    """Ordinary least squares y = slope x + intercept and r2."""
    return [F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2"), F.count(F.lit(1)).alias("n")]


def origin_slope(x: Column, y: Column) -> Column:
    return F.sum(x * y) / F.when(F.sum(x * x) > 0, F.sum(x * x))


def weighted_line(x: Column, y: Column, w: Column) -> list[Column]:
    """Weighted least squares slope and intercept, in sums only."""
    sw, sx, sy, sxx, sxy = F.sum(w), F.sum(w * x), F.sum(w * y), F.sum(w * x * x), F.sum(w * x * y)
    det = F.when(sw * sxx - sx * sx != 0, sw * sxx - sx * sx)
    return [((sw * sxy - sx * sy) / det).alias("slope"), ((sxx * sy - sx * sxy) / det).alias("intercept")]


def two_level(points: DataFrame, segment: str, step: str, temperature: str, i: str, u: str, area: float) -> DataFrame:
    """Per segment and step R = slope of u over i; per segment R = a + b T, per area; with the least r2 of the first level."""
    first = points.groupBy(segment, step).agg(F.regr_slope(u, i).alias("_r"), F.regr_r2(u, i).alias("_r2"), F.avg(temperature).alias("_t")).where(F.col("_r").isNotNull())
    return first.groupBy(segment).agg((F.regr_intercept("_r", "_t") / area).alias("c0"), (F.regr_slope("_r", "_t") / area).alias("c1"), F.min("_r2").alias("r2_min"), F.count(F.lit(1)).alias("n_steps"))


def ratio_to_median(df: DataFrame, values: list[str], keys: list[str] | None = None) -> DataFrame:
    """The rows with <value>_ratio, the value over the median of the positive values of all rows (or of the rows of the same keys)."""
    middle = df.groupBy(*(keys or [])).agg(*[F.median(F.when(F.col(v) > 0, F.col(v))).alias(f"_m_{v}") for v in values])
    # without keys it is one row
    joined = df.join(middle, keys) if keys else df.join(F.broadcast(middle))
    return joined.select("*", *[(F.col(v) / F.when(F.col(f"_m_{v}") != 0, F.col(f"_m_{v}"))).alias(f"{v}_ratio") for v in values]).drop(*[f"_m_{v}" for v in values])


def fault_labels(rules: dict[str, dict[str, tuple[float | None, float | None]]]) -> Column:
    """The names of the rules whose ratio columns all lie in their ranges, joined by a bar."""

    def holds(rule: dict[str, tuple[float | None, float | None]]) -> Column:
        ok = F.lit(True)
        for column, (low, high) in rule.items():
            ok = ok & F.col(column).isNotNull()
            ok = ok if low is None else ok & (F.col(column) >= low)
            ok = ok if high is None else ok & (F.col(column) <= high)
        return F.coalesce(ok, F.lit(False))

    return F.array_join(F.array_compact(F.array(*[F.when(holds(rule), F.lit(name)) for name, rule in rules.items()])), "|")


def partial_corr(df: DataFrame, value: str, of: str, control: str) -> DataFrame:
    """corr(of, what is left of value after a straight line in control)."""
    fit = df.agg(F.regr_slope(value, control).alias("_b"), F.regr_intercept(value, control).alias("_a"))
    left = df.join(F.broadcast(fit)).withColumn("_resid", F.col(value) - F.coalesce(F.col("_b") * F.col(control) + F.col("_a"), F.lit(0.0)))
    return left.agg(F.corr(of, "_resid").alias("r"))


def card_factors(points: DataFrame, card: str, frequency: str, magnitude: str, bands: dict[str, tuple[float, float]], least: int = 3) -> DataFrame:
    """Per card and band 100 (exp(median ln(magnitude / plate median at that frequency)) - 1), null below `least` points."""
    plate = points.groupBy(frequency).agg(F.median(magnitude).alias("_plate"))
    name = F.lit(None).cast("string")
    for label, (low, high) in bands.items():
        name = F.when((F.col(frequency) >= low) & (F.col(frequency) < high), F.lit(label)).otherwise(name)
    logs = points.join(plate, frequency).where((F.col(magnitude) > 0) & (F.col("_plate") > 0)).withColumn("band", name).where(F.col("band").isNotNull())
    return logs.groupBy(card, "band").agg(F.count(F.lit(1)).alias("n"), F.when(F.count(F.lit(1)) >= least, 100 * (F.exp(F.median(F.ln(F.col(magnitude) / F.col("_plate")))) - 1)).alias("factor_pct"))


def circular_mean(phase: Column, weight: Column | None = None) -> Column:
    w = F.lit(1.0) if weight is None else weight
    return F.atan2(F.sum(w * F.sin(phase)), F.sum(w * F.cos(phase)))


def pooled_phasor(re: Column, im: Column, snr_db: Column, weight: Column, least: int = 2) -> list[Column]:
    """Weighted mean phasor of several cards; SNR adds in linear power; null below `least` cards."""
    enough = F.count(F.lit(1)) >= least
    return [
        F.when(enough, F.sum(weight * re) / F.sum(weight)).alias("re"),
        F.when(enough, F.sum(weight * im) / F.sum(weight)).alias("im"),
        F.when(enough, 10 * F.log10(F.sum(F.pow(F.lit(10.0), snr_db / 10)))).alias("snr_db"),
    ]
