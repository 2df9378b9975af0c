"""Operators over ordered rows: runs, clusters, unwrapping, decimation, repeats, crossings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _by(group: list[str], *order) -> Window:
    return Window.partitionBy(*group).orderBy(*order)


def before(df: DataFrame, group: list[str], order: list[str], values: list[str], bucket: Column) -> DataFrame:
    """The rows with `_before`, a struct of the values in the row before, in tasks of a group's bucket instead of a whole group.

    bucket never falls along the order. The last row of each bucket, one record, is carried over to the group's next one. Keys aren't null.
    """
    held = F.struct(*values)
    rows = df.withColumn("_bucket", bucket)
    last = rows.groupBy(*group, "_bucket").agg(F.max_by(held, F.struct(*order)).alias("_carried"))
    last = last.withColumn("_carried", F.lag("_carried").over(_by(group, "_bucket")))
    inside = rows.withColumn("_before", F.lag(held).over(_by([*group, "_bucket"], *order)))
    return inside.join(last, [*group, "_bucket"], "left").withColumn("_before", F.coalesce("_before", "_carried")).drop("_bucket", "_carried")


def runs_of_true(df: DataFrame, group: list[str], order: list[str], flag: Column, bucket: Column | None = None) -> DataFrame:
    """(group, first, last, n_rows) of each run of rows in order whose flag is true; first and last are row numbers from 1.

    Rows are numbered within buckets, which never fall along the order, and the counts of earlier buckets are added: no task holds a whole group.
    """
    rows = df.withColumn("_bucket", F.lit(0) if bucket is None else bucket).select(*group, "_bucket", *[c for c in order if c not in group], F.coalesce(flag, F.lit(False)).alias("_f"))
    sizes = rows.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_all"), F.count_if("_f").alias("_on"))
    earlier = _by(group, "_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.select(*group, "_bucket", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(c) for c in ("_all", "_on")])
    w = _by([*group, "_bucket"], *order)
    rows = rows.withColumn("_n", F.row_number().over(w)).withColumn("_k", F.count_if("_f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    on = rows.where("_f").join(sizes, [*group, "_bucket"]).withColumn("_n", F.col("_n") + F.col("_all")).withColumn("_island", F.col("_n") - F.col("_k") - F.col("_on"))
    return on.groupBy(*group, "_island").agg(F.min("_n").alias("first"), F.max("_n").alias("last"), F.count(F.lit(1)).alias("n_rows")).drop("_island")


def clusters(df: DataFrame, group: list[str], x: str, gap: Column | float, relative: bool = False) -> DataFrame:
    """The rows with `cluster`, counted from 0 a group: a new one begins where x is more than `gap` above the one before (or `gap` times it)."""
    w = _by(group, x)
    before = F.lag(x).over(w)
    gap = F.lit(gap) if not isinstance(gap, Column) else gap
    far = F.col(x) > before * (1 + gap) if relative else F.col(x) - before > gap
    return df.withColumn("_new", F.coalesce(far, F.lit(False)).cast("int")).withColumn("cluster", F.sum("_new").over(w)).drop("_new")


def unwrap(df: DataFrame, group: list[str], order: list[str], phase: str) -> DataFrame:
    """The rows with `unwrapped`: jumps of more than half a turn are taken out."""
    w = _by(group, *order)
    turns = F.coalesce(-F.round((F.col(phase) - F.lag(phase).over(w)) / (2 * F.pi())), F.lit(0.0))
    return df.withColumn("_turn", turns).withColumn("unwrapped", F.col(phase) + 2 * F.pi() * F.sum("_turn").over(w)).drop("_turn")


def decimate(df: DataFrame, group: list[str], t: str, value: str, bucket: Column) -> DataFrame:
    """At most two rows a bucket: the least and the largest value, each at its first time, so that spikes stay."""
    picked = df.withColumn("bucket", bucket).groupBy(*group, "bucket").agg(F.min(F.struct(value, t)).alias("_low"), F.max(F.struct(F.col(value), -F.col(t))).alias("_high"))
    low = picked.select(*group, "bucket", F.col(f"_low.{t}").alias(t), F.col(f"_low.{value}").alias(value))
    high = picked.select(*group, "bucket", (-F.col("_high.col2")).alias(t), F.col(f"_high.{value}").alias(value))
    return low.unionByName(high).distinct()


def repeats_and_gaps(df: DataFrame, group: list[str], t: str, value: str, gap: float, bucket: Column | None = None) -> DataFrame:
    """Per group: samples, repeated times, repeats with another value, gaps above `gap`, and the longest one. bucket as in `before`, over t."""
    marked = before(df, group, [t, value], [t, value], F.lit(0) if bucket is None else bucket)
    marked = marked.select(*group, (F.col(t) - F.col(f"_before.{t}")).alias("_dt"), (F.col(value) != F.col(f"_before.{value}")).alias("_other"))
    return marked.groupBy(*group).agg(
        F.count(F.lit(1)).alias("n_samples"),
        F.count_if(F.col("_dt") == 0).alias("n_repeats"),
        F.count_if((F.col("_dt") == 0) & F.col("_other")).alias("n_conflicts"),
        F.count_if(F.col("_dt") > gap).alias("n_gaps"),
        F.max("_dt").alias("longest_gap"),
    )


def sessions(df: DataFrame, group: list[str], t: str, gap: float) -> DataFrame:
    """(group, session, start, stop, n) of stretches whose rows are at most `gap` apart."""
    marked = clusters(df, group, t, gap)
    return marked.groupBy(*group, F.col("cluster").alias("session")).agg(F.min(t).alias("start"), F.max(t).alias("stop"), F.count(F.lit(1)).alias("n"))


def cumulative_share(df: DataFrame, group: list[str], order: list[str], amount: str) -> DataFrame:
    """The rows with `upstream`: the share of the group's amount that lies before the row."""
    w, whole = _by(group, *order), Window.partitionBy(*group)
    before = F.coalesce(F.sum(amount).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    return df.withColumn("upstream", before / F.sum(amount).over(whole))


def crossing(df: DataFrame, group: list[str], x: str, re: str, im: str, above: float | None = None) -> DataFrame:
    """Per group re where im goes from negative to non-negative first, straight between the two rows; null if it never does."""
    w = _by(group, x)
    rows = df if above is None else df.where(F.col(x) >= above)
    rows = rows.select(*group, x, re, im, F.lead(re).over(w).alias("_re"), F.lead(im).over(w).alias("_im"))
    share = F.col(im) / (F.col(im) - F.col("_im"))
    at = F.col(re) + share * (F.col("_re") - F.col(re))
    return rows.groupBy(*group).agg(F.min_by(at, F.when((F.col(im) < 0) & (F.col("_im") >= 0), F.col(x))).alias("crossing"), F.count_if((F.col(im) < 0) & (F.col("_im") >= 0)).alias("n_crossings"))


def halves(df: DataFrame, group: list[str], key: str, order: list[str], value: str) -> DataFrame:
    """Per group the largest and the median relative difference between the means of each key's first and second half."""
    half = F.ntile(2).over(_by([*group, key], *order))
    means = df.withColumn("_half", half).groupBy(*group, key).agg(F.avg(F.when(F.col("_half") == 1, F.col(value))).alias("_a"), F.avg(F.when(F.col("_half") == 2, F.col(value))).alias("_b"))
    change = F.abs(F.col("_b") - F.col("_a")) / F.when(F.col("_a") != 0, F.abs("_a"))
    return means.groupBy(*group).agg(F.max(change).alias("max_change"), F.median(change).alias("median_change"), F.count(F.lit(1)).alias("n_keys"))


def first_last(df: DataFrame, group: list[str], order: str, value: str) -> DataFrame:
    """Per group the first and the last value and their difference in percent of the first."""
    out = df.groupBy(*group).agg(F.min_by(value, order).alias("first"), F.max_by(value, order).alias("last"))
    return out.withColumn("change_pct", 100 * (F.col("last") - F.col("first")) / F.when(F.col("first") != 0, F.col("first")))


def grid_check(df: DataFrame, group: list[str], frequency: str) -> DataFrame:
    """Per group a line through log10 f over rank: points a decade, largest residual in ppm of f, and whether it is a regular ladder."""
    ranked = df.withColumn("_k", F.row_number().over(_by(group, frequency)).cast("double")).withColumn("_y", F.log10(frequency))
    fit = ranked.groupBy(*group).agg(F.regr_slope("_y", "_k").alias("_b"), F.regr_intercept("_y", "_k").alias("_a"), F.count(F.lit(1)).alias("n"))
    resid = F.max(F.abs(F.pow(F.lit(10.0), F.col("_y") - F.col("_b") * F.col("_k") - F.col("_a")) - 1)) * 1e6
    out = ranked.join(fit, group).groupBy(*group, "_b", "n").agg(resid.alias("residual_ppm")).withColumn("per_decade", 1 / F.when(F.col("_b") > 0, F.col("_b")))
    regular = (F.col("n") >= 3) & (F.col("residual_ppm") < 5000) & (F.abs(F.col("per_decade") - F.round("per_decade")) < 0.15)
    return out.withColumn("regular", F.coalesce(regular, F.lit(False))).drop("_b")
