"""Joins that Spark has no operator for: as-of, nearest, band, interval and range joins, adjacency and donor rings."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof(left: DataFrame, right: DataFrame, keys: list[str], on: str, values: list[str], forward: bool = False) -> DataFrame:
    """The left rows with the values of the last right row of the same keys at or before `on` (forward: the first at or after).

    One union and one ordered window: a shuffle on the keys, no join and no blow-up. Of right rows at one time the one with the largest
    values counts. A key that holds much of the data is ordered by one task, which spills; split it by a time bucket beforehand.
    """
    both_left = left.withColumn("_side", F.lit(1)).withColumn("_v", F.lit(None).cast(right.select(F.struct(*values).alias("v")).schema["v"].dataType))
    both_right = right.select(*keys, on, F.struct(*values).alias("_v"), F.lit(0 if not forward else 2).alias("_side"))
    stacked = both_left.unionByName(both_right, allowMissingColumns=True)
    if forward:
        window = Window.partitionBy(*keys).orderBy(on, "_side", "_v").rowsBetween(0, Window.unboundedFollowing)
        found = F.first("_v", ignorenulls=True).over(window)
    else:
        window = Window.partitionBy(*keys).orderBy(on, "_side", "_v").rowsBetween(Window.unboundedPreceding, 0)
        found = F.last("_v", ignorenulls=True).over(window)
    stacked = stacked.withColumn("_found", found).where(F.col("_side") == 1)
    return stacked.select(*left.columns, *[F.col(f"_found.{v}").alias(v) for v in values])


def nearest(df: DataFrame, group: list[str], distance: Column, values: list[str]) -> DataFrame:
    """Per group the values of the row with the least distance."""
    picked = df.groupBy(*group).agg(F.min(F.struct(distance.alias("_d"), *values)).alias("_v"))
    return picked.select(*group, *[F.col(f"_v.{v}").alias(v) for v in values], F.col("_v._d").alias("distance"))


def interpolate_log(points: DataFrame, grid: DataFrame, keys: list[str], f: str, values: list[str]) -> DataFrame:
    """The grid rows with each value read off the points, straight in ln f between neighbours and held beyond the ends."""
    below = asof(grid, points.withColumn("_f0", F.col(f)), keys, f, ["_f0", *values])
    low = below.select(*grid.columns, "_f0", *[F.col(v).alias(f"_{v}0") for v in values])
    above = asof(low, points.withColumn("_f1", F.col(f)), keys, f, ["_f1", *values], forward=True)
    share = F.when(F.col("_f1") > F.col("_f0"), (F.ln(f) - F.ln("_f0")) / (F.ln("_f1") - F.ln("_f0"))).otherwise(F.lit(0.0))

    def read(v: str) -> Column:
        a, b = F.coalesce(F.col(f"_{v}0"), F.col(v)), F.coalesce(F.col(v), F.col(f"_{v}0"))
        return (a + (b - a) * F.coalesce(share, F.lit(0.0))).alias(v)

    return above.select(*grid.columns, *[read(v) for v in values])


def in_ranges(samples: DataFrame, ranges: DataFrame, keys: list[str], at: str, start: str, stop: str, width: float) -> DataFrame:
    """Samples joined with the ranges [start, stop) of the same keys that hold them.

    Both sides are cut into buckets of `width`, so it is an equi-join on (keys, bucket) and each sample meets only ranges of its bucket. Choose
    width near a typical range: a range costs a row for each bucket that it touches.
    """
    bucket = lambda c: F.floor(c / width).cast("long")
    wide = ranges.where(F.col(stop) > F.col(start)).withColumn("_b", F.explode(F.sequence(bucket(F.col(start)), bucket(F.col(stop)))))
    out = samples.withColumn("_b", bucket(F.col(at))).join(wide, [*keys, "_b"])
    return out.where((F.col(at) >= F.col(start)) & (F.col(at) < F.col(stop))).drop("_b")


def state_at(times: DataFrame, log: DataFrame, keys: list[str], t: str, value: str, before: float, after: float) -> DataFrame:
    """The times with the median of the log within [t - before, t + after], else the last value at or before t + after, else null."""
    spans = times.withColumn("_start", F.col(t) - before).withColumn("_stop", F.col(t) + after + 1e-9)
    near = in_ranges(log.select(*keys, F.col(t).alias("_at"), F.col(value).alias("_v")), spans, keys, "_at", "_start", "_stop", before + after)
    middle = near.groupBy(*times.columns).agg(F.median("_v").alias("_median"), F.count("_v").alias("n_near"))
    held = asof(times.withColumn("_later", F.col(t) + after).withColumnRenamed(t, "_t"), log.select(*keys, F.col(t).alias("_later"), F.col(value).alias("_hold")), keys, "_later", ["_hold"])
    out = held.withColumnRenamed("_t", t).drop("_later").join(middle, times.columns, "left")
    return out.select(*times.columns, F.coalesce("_median", "_hold").alias(value), F.coalesce("n_near", F.lit(0)).alias("n_near"))


def within_ratio(left: DataFrame, right: DataFrame, keys: list[str], x: str, y: str, tol: float) -> DataFrame:
    """Pairs of equal keys with |y / x - 1| <= tol, for positive x and y: an equi-join on buckets of ln, so a row meets only those near it."""
    width = -math.log(1 - tol) * (1 + 1e-9)
    bucket = lambda c: F.floor(F.ln(c) / width)
    spread = left.where(F.col(x) > 0).withColumn("_b", F.explode(F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda i: bucket(F.col(x)) + i)))
    placed = right.where(F.col(y) > 0).withColumn("_b", bucket(F.col(y)))
    return spread.join(placed, [*keys, "_b"]).where(F.abs(F.col(y) / F.col(x) - 1) <= tol).drop("_b")


def nearest_interval(times: DataFrame, intervals: DataFrame, keys: list[str], t: str, start: str, stop: str, most_gap: float, values: list[str]) -> DataFrame:
    """The times with the interval that holds them or else the nearest within most_gap; null if none is, or if two are equally near.

    Intervals, longer by most_gap on both sides, meet the times of their buckets only (`in_ranges`).
    """
    gap = F.greatest(F.lit(0.0), F.col(start) - F.col(t), F.col(t) - F.col(stop))
    # the range is open above, so it ends a gap later and the distance decides
    reached = intervals.withColumn("_from", F.col(start) - most_gap).withColumn("_to", F.col(stop) + 2 * most_gap)
    rated = in_ranges(times, reached, keys, t, "_from", "_to", 3 * most_gap).drop("_from", "_to").withColumn("_gap", gap).where(F.col("_gap") <= most_gap)
    best = Window.partitionBy(*[c for c in times.columns])
    rated = rated.withColumn("_least", F.min("_gap").over(best)).where(F.col("_gap") == F.col("_least"))
    picked = rated.groupBy(*times.columns).agg(F.count(F.lit(1)).alias("n_nearest"), *[F.min(v).alias(v) for v in values], F.min("_gap").alias("gap"))
    single = F.col("n_nearest") == 1
    return times.join(picked, times.columns, "left").select(*times.columns, F.coalesce("n_nearest", F.lit(0)).alias("n_nearest"), *[F.when(single, F.col(v)).alias(v) for v in [*values, "gap"]])


def adjacency(pads: DataFrame, col: str = "col", row: str = "row", owner: str = "segment") -> DataFrame:
    """(segment, neighbour): owners of pads that share an edge."""
    pads = pads.select(col, row, owner).distinct()
    side = pads.select(F.col(col).alias("_c"), F.col(row).alias("_r"), F.col(owner).alias("neighbour"))
    moved = pads.select(F.col(owner).alias("segment"), F.explode(F.array(*[F.struct((F.col(col) + dc).alias("_c"), (F.col(row) + dr).alias("_r")) for dc, dr in ((1, 0), (-1, 0), (0, 1), (0, -1))])).alias("_p"))
    moved = moved.select("segment", "_p._c", "_p._r")
    return moved.join(side, ["_c", "_r"]).where(F.col("segment") != F.col("neighbour")).select("segment", "neighbour").distinct()


def donor_ring(wanted: DataFrame, edges: DataFrame, measured: DataFrame, max_hops: int = 2) -> DataFrame:
    """(segment, donor, hops): the measured segments of the first ring around each wanted one that holds any, within max_hops."""
    reached = wanted.select("segment", F.col("segment").alias("at"), F.lit(0).alias("hops"))
    front, seen = reached, reached.select("segment", "at")
    for hop in range(1, max_hops + 1):
        front = front.join(edges.select(F.col("segment").alias("at"), "neighbour"), "at").select("segment", F.col("neighbour").alias("at")).distinct().join(seen, ["segment", "at"], "left_anti").withColumn("hops", F.lit(hop))
        seen = seen.unionByName(front.select("segment", "at"))
        reached = reached.unionByName(front)
    donors = reached.where(F.col("hops") > 0).join(measured.select(F.col("segment").alias("at")), "at", "left_semi")
    nearest_ring = donors.groupBy("segment").agg(F.min("hops").alias("hops"))
    return donors.join(nearest_ring, ["segment", "hops"]).select("segment", F.col("at").alias("donor"), "hops")


def keep_best(df: DataFrame, key: str, claimant: str, score: str) -> DataFrame:
    """All rows of the claimant with the highest median score for each key; ties to the smallest claimant."""
    rated = df.groupBy(key, claimant).agg(F.median(score).alias("_score"))
    best = rated.groupBy(key).agg(F.min(F.struct((-F.col("_score")).alias("_s"), claimant)).alias("_b")).select(key, F.col(f"_b.{claimant}").alias(claimant))
    return df.join(best, [key, claimant], "left_semi")
