"""Point gates: keep or reject measured points, and keep the first reason.

A gate is a (name, column) pair; the column is true where the point passes. A null counts as failed, so a point that can't be judged is rejected
by the first gate that can't judge it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Gate = tuple[str, Column]


def band(frequency: Column | str, low: float, high: float) -> Column:
    frequency = F.col(frequency) if isinstance(frequency, str) else frequency
    return frequency.between(low, high)


def first_reason(gates: Sequence[Gate]) -> Column:
    """The name of the first gate that a point fails; an empty string if it passes all."""
    reason = F.lit("")
    for name, passes in reversed(gates):
        reason = F.when(F.coalesce(passes, F.lit(False)), reason).otherwise(F.lit(name))
    return reason


def ledger(points: DataFrame, gates: Sequence[Gate]) -> DataFrame:
    """All points with `reason` and `kept`: nothing is dropped, so that a later stage can tell why a point is missing."""
    return points.withColumn("reason", first_reason(gates)).withColumn("kept", F.col("reason") == "")


def staged(points: DataFrame, gate: Gate) -> DataFrame:
    """A ledger with one more gate whose column was computed on survivors only; points rejected before keep their reason."""
    name, passes = gate
    fails = F.col("kept") & ~F.coalesce(passes, F.lit(False))
    return points.withColumn("reason", F.when(fails, F.lit(name)).otherwise(F.col("reason"))).withColumn("kept", F.col("reason") == "")


def reach(points: DataFrame, group: str, frequency: str, dimension: DataFrame | None = None) -> DataFrame:
    """Per group of a ledger: points, kept, lowest and highest kept frequency, points rejected above it and what rejects most of them.

    A tie between reasons goes to the alphabetically first. Members of `dimension` without any point get a row with `no_channel`.
    """
    top = F.max(F.when(F.col("kept"), F.col(frequency))).over(Window.partitionBy(group))
    marked = points.withColumn("f_max", top).withColumn("above", ~F.col("kept") & (F.col("f_max").isNull() | (F.col(frequency) > F.col("f_max"))))
    by_reason = marked.groupBy(group, "reason").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if("kept").alias("kept"),
        F.min(F.when(F.col("kept"), F.col(frequency))).alias("low"),
        F.max("f_max").alias("high"),
        F.count_if("above").alias("n_above"),
    )
    worst = F.min_by("reason", F.struct(-F.col("n_above"), F.col("reason")))
    out = by_reason.groupBy(group).agg(
        F.sum("n").alias("n_points"),
        F.sum("kept").alias("n_kept"),
        F.min("low").alias("f_min_kept"),
        F.max("high").alias("f_max_kept"),
        F.sum("n_above").alias("n_above"),
        F.when(F.sum("n_above") > 0, worst).otherwise(F.lit("")).alias("blocked_by"),
    )
    if dimension is None:
        return out
    return dimension.select(group).distinct().join(out, group, "left").select(
        group, *[F.coalesce(c, F.lit(0)).alias(c) for c in ("n_points", "n_kept")], "f_min_kept", "f_max_kept", F.coalesce("n_above", F.lit(0)).alias("n_above"), F.coalesce("blocked_by", F.lit("no_channel")).alias("blocked_by")
    )


def tally(points: DataFrame, group: str | None = None, most: int | None = None) -> DataFrame:
    """How many points each reason rejected, most first; with a group, the `most` reasons of each."""
    keys = [group, "reason"] if group else ["reason"]
    counted = points.where(F.col("reason") != "").groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    if most is None:
        return counted.orderBy(F.desc("n"), "reason")
    window = Window.partitionBy(*([group] if group else [])).orderBy(F.desc("n"), "reason")
    return counted.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= most)


def tier(value: Column, residual: Column, cv: Column, tolerance: float, imputed: Column | None = None, unreliable: Column | None = None) -> Column:
    """Grade A, B or C of a segment from its model residual and the spread of its value."""
    a, b = (residual <= tolerance) & (cv <= 0.10), (residual <= 3 * tolerance) & (cv <= 0.25)
    if imputed is not None:
        a = a & ~imputed
        b = b | ((residual <= tolerance) & (cv <= 0.10))
    grade = F.when(value.isNull() | (value <= 0), F.lit("C")).when(a, F.lit("A")).when(b, F.lit("B")).otherwise(F.lit("C"))
    return grade if unreliable is None else F.when(unreliable, F.lit("C")).otherwise(grade)


def verdict(value: Column, ok: float, warn: float) -> Column:
    """pass, warn or fail by an upper bound; na where there is no value."""
    return F.when(value.isNull(), "na").when(value <= ok, "pass").when(value <= warn, "warn").otherwise("fail")


def worst_verdict(column: str) -> Column:
    """The worst verdict of a group."""
    order = F.when(F.col(column) == "fail", 3).when(F.col(column) == "warn", 2).when(F.col(column) == "pass", 1).otherwise(0)
    return F.max_by(column, order)
