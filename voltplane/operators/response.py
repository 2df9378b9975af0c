"""Responses of measuring chains over frequency, lags of channels and cards, schedules agreed on by cards, and fields over the plate."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import joins, windows


def smoothed(df: DataFrame, group: list[str], x: Column, y: str) -> DataFrame:
    """The rows with `smooth`: the parabola in x through their group, from sums alone; null where it isn't determined. Keep x within a few units of 0."""
    terms = df.withColumn("_x", x)
    moments = [F.sum(F.pow("_x", F.lit(k))).alias(f"_s{k}") for k in range(5)] + [F.sum(F.pow("_x", F.lit(k)) * F.col(y)).alias(f"_t{k}") for k in range(3)]
    sums = terms.groupBy(*group).agg(*moments)
    s, t = [F.col(f"_s{k}") for k in range(5)], [F.col(f"_t{k}") for k in range(3)]
    rows = [[s[0], s[1], s[2]], [s[1], s[2], s[3]], [s[2], s[3], s[4]]]
    whole = _det(rows)
    solved = [_det([[t[i] if k == j else rows[i][j] for j in range(3)] for i in range(3)]) / F.when(F.abs(whole) > 1e-9, whole) for k in range(3)]
    fits = sums.select(*group, *[c.alias(f"_c{k}") for k, c in enumerate(solved)])
    out = terms.join(fits, group).withColumn("smooth", F.col("_c0") + F.col("_c1") * F.col("_x") + F.col("_c2") * F.col("_x") * F.col("_x"))
    return out.drop("_x", "_c0", "_c1", "_c2")


def _det(m: list[list[Column]]) -> Column:
    (a, b, c), (d, e, f), (g, h, i) = m
    return a * (e * i - f * h) - b * (d * i - f * g) + c * (d * h - e * g)


def relative_response(magnitudes: DataFrame, card: str, f: str, size: str, low: float, high: float, scale: float) -> DataFrame:
    """(card, f, response, smooth): each card's median magnitude a step over the median of its steps within [low, high], and its parabola in f / scale - 1."""
    steps = magnitudes.groupBy(card, f).agg(F.median(size).alias("_m"))
    level = steps.where(F.col(f).between(low, high)).groupBy(card).agg(F.median("_m").alias("_level"))
    ratio = steps.join(level, card).select(card, f, (F.col("_m") / F.when(F.col("_level") > 0, F.col("_level"))).alias("response"))
    return smoothed(ratio, [card], F.col(f) / scale - 1, "response")


def nearest_step(left: DataFrame, right: DataFrame, keys: list[str], f: str, values: list[str]) -> DataFrame:
    """The left rows with the values of the right step of their keys whose ln f is nearest; of two as near the lower one."""
    right = right.withColumn("_at", F.col(f))
    below = joins.asof(left, right, keys, f, ["_at", *values])
    below = below.withColumn("_below", F.struct("_at", *values)).drop("_at", *values)
    both = joins.asof(below, right, keys, f, ["_at", *values], forward=True).withColumn("_above", F.struct("_at", *values)).drop("_at", *values)
    gap = lambda side: F.round(F.abs(F.ln(F.col(f) / F.col(f"{side}._at"))), 12)
    lower = F.col("_above._at").isNull() | (gap("_below") <= gap("_above"))
    return both.select(*left.columns, *[F.when(lower, F.col(f"_below.{v}")).otherwise(F.col(f"_above.{v}")).alias(v) for v in values])


def composed(new: DataFrame, old: DataFrame, keys: list[str], f: str, value: str, near: float = 0.005) -> DataFrame:
    """(keys, f, value): the product of two responses, each interpolated over ln f and held beyond its ends, at the new steps and at the old ones not within `near` in ln f of one."""
    pairs = joins.within_ratio(old.select(*keys, f), new.select(*keys, F.col(f).alias("_new")), keys, f, "_new", math.exp(near) - 1)
    close = pairs.where(F.abs(F.ln(F.col("_new") / F.col(f))) <= near).select(*keys, f).distinct()
    grid = new.select(*keys, f).unionByName(old.select(*keys, f).join(close, [*keys, f], "left_anti"))
    first = joins.interpolate_log(new.select(*keys, f, F.col(value).alias("_a")), grid, keys, f, ["_a"])
    both = joins.interpolate_log(old.select(*keys, f, F.col(value).alias("_b")), first, keys, f, ["_b"])
    return both.select(*keys, f, (F.col("_a") * F.col("_b")).alias(value))


def held_out(responses: DataFrame, card: str, f: str, value: str) -> DataFrame:
    """Per card how far it is off the median of all other cards at the same steps: (card, n, deviation_pct, worst_pct). A card has one value a step; nulls don't count.

    Without its own value a card sees the step's order statistics beside the middle, moved by one above its own place: no card meets another.
    """
    whole = Window.partitionBy(f)
    rows = responses.where(F.col(value).isNotNull()).withColumn("_r", F.row_number().over(whole.orderBy(value, card)) - 1).withColumn("_m", F.count(F.lit(1)).over(whole) - 1)
    at = lambda k: F.max(F.when(F.col("_r") == k, F.col(value))).over(whole)
    seen = lambda k: F.when(F.col("_r") > k, at(k)).otherwise(at(k + 1))
    rest = rows.where("_m > 0").withColumn("_m", (seen(F.floor((F.col("_m") - 1) / 2)) + seen(F.floor(F.col("_m") / 2))) / 2)
    off = 100 * (F.col(value) / F.when(F.col("_m") != 0, F.col("_m")) - 1)
    return rest.groupBy(card).agg(F.count(off).alias("n"), F.median(off).alias("deviation_pct"), F.max(F.abs(off)).alias("worst_pct"))


def channel_lags(phases: DataFrame, key: str, f: str, phase: str, most: float, rounds: int = 3, least: int = 4) -> DataFrame:
    """(key, tau, n, status): the delay of each channel against the median of the plate, in seconds.

    Each round takes the plate's median phase a step, with the lags so far taken out, fits every channel's rest by a line through the origin, and
    moves the lags to a median of 0. status: few steps, large for a lag above `most`, else ok.
    """
    w = 2 * math.pi * F.col(f)
    lagged = phases.withColumn("tau", F.lit(0.0))
    for _ in range(rounds):
        straight = F.col(phase) + w * F.col("tau")
        plate = lagged.groupBy(f).agg(F.median(straight).alias("_plate"))
        fits = lagged.join(plate, f).groupBy(key).agg((F.max("tau") - F.sum(w * (straight - F.col("_plate"))) / F.sum(w * w)).alias("tau"), F.count(F.lit(1)).alias("n"))
        # one row
        middle = fits.agg(F.median("tau").alias("_mid"))
        fits = fits.join(F.broadcast(middle)).select(key, (F.col("tau") - F.col("_mid")).alias("tau"), "n")
        lagged = phases.join(fits, key)
    status = F.when(F.col("n") < least, "few").when(F.abs("tau") > most, "large").otherwise("ok")
    return fits.select(key, "tau", "n", status.alias("status"))


def window_lag(x: Column, y: Column, n: int, most: int) -> Column:
    """By how many samples y is later than x, from the largest correlation within `most`; of equal ones the smallest. Windows of n samples."""
    size = n - 2 * most
    held = F.slice(x, most + 1, size)
    product = lambda k: F.aggregate(F.zip_with(held, F.slice(y, most + 1 + k, size), lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    rated = F.array(*[F.struct(F.round(product(k), 9).alias("c"), F.lit(-k).alias("k")) for k in range(-most, most + 1)])
    return -F.array_max(rated)["k"]


def consensus(dwells: DataFrame, group: list[str], card: str, f: str, start: str, stop: str, tol: float = 0.01, least_cards: int = 3) -> DataFrame:
    """(group, step, f, start, stop, n_cards, agreed): dwells of all cards whose frequencies lie within `tol` of the next are one step of the schedule, at their medians."""
    marked = windows.clusters(dwells, group, f, tol, relative=True)
    out = marked.groupBy(*group, F.col("cluster").alias("step")).agg(F.median(f).alias(f), F.median(start).alias(start), F.median(stop).alias(stop), F.countDistinct(card).alias("n_cards"))
    return out.withColumn("agreed", F.col("n_cards") >= least_cards)


def snapped(steps: DataFrame, group: list[str], f: str, per_decade: list[int]) -> DataFrame:
    """The steps with `per_decade`, `snapped` and `off_pct`: the rung nearest to each on the group's ladder.

    The ladder is the number of points a decade, of those given, at which the fractions of log10 f agree best, with their circular mean as its offset.
    """
    tried = steps.withColumn("_p", F.explode(F.array(*map(F.lit, per_decade))))
    turn = 2 * math.pi * F.col("_p") * F.log10(f)
    rated = tried.groupBy(*group, "_p").agg(F.sum(F.cos(turn)).alias("_c"), F.sum(F.sin(turn)).alias("_s"), F.count(F.lit(1)).alias("_n"))
    strength = F.round(F.sqrt(F.col("_c") * F.col("_c") + F.col("_s") * F.col("_s")) / F.col("_n"), 9)
    best = rated.groupBy(*group).agg(F.max_by(F.struct("_p", (F.atan2("_s", "_c") / (2 * math.pi)).alias("_o")), F.struct(strength, -F.col("_p"))).alias("_b"))
    p, offset = F.col("_b._p"), F.col("_b._o")
    rung = F.pow(F.lit(10.0), (F.round(p * F.log10(f) - offset) + offset) / p)
    out = steps.join(best, group).withColumn("per_decade", p).withColumn("snapped", rung)
    return out.withColumn("off_pct", 100 * (F.col(f) / F.col("snapped") - 1)).drop("_b")


def occupancy(frames: DataFrame, record: str, frame: str, powers: Column, peak_db: float = 12.0) -> DataFrame:
    """(record, tone, occupancy, n_frames): the share of a record's frames in which a bin stands peak_db above the median of the frame's bins.

    powers: an array of the bins' powers a frame; tones count from 1. A tone of a multisine is in all frames, one of a stepped sweep in few.
    """
    bins = frames.select(record, frame, F.posexplode(powers).alias("_k", "_p"))
    over = 10 * F.log10(F.col("_p") / F.median("_p").over(Window.partitionBy(record, frame))) > peak_db
    marked = bins.select(record, (F.col("_k") + 1).alias("tone"), over.alias("_on"))
    return marked.groupBy(record, "tone").agg(F.avg(F.when(F.col("_on"), 1.0).otherwise(0.0)).alias("occupancy"), F.count(F.lit(1)).alias("n_frames"))


def filled(spectra: DataFrame, donors: DataFrame, areas: DataFrame) -> DataFrame:
    """(segment, freq_hz, re, im, n_donors): the area-weighted mean of the spectra of each segment's donors, on the grid of the donor with the widest one.

    Donors are interpolated over ln f and held beyond their ends. The widest grid has the largest ratio of its ends; of equal ones the most steps.
    """
    span = spectra.groupBy(F.col("segment").alias("donor")).agg(F.round(F.max("freq_hz") / F.min("freq_hz"), 9).alias("_span"), F.count(F.lit(1)).alias("_n"))
    widest = donors.join(span, "donor").groupBy("segment").agg(F.max_by("donor", F.struct("_span", "_n", -F.col("donor"))).alias("_grid"))
    steps = widest.join(spectra.select(F.col("segment").alias("_grid"), "freq_hz"), "_grid").select("segment", "freq_hz")
    wanted = steps.join(donors.select("segment", "donor"), "segment")
    known = spectra.select(F.col("segment").alias("donor"), "freq_hz", "re", "im")
    # a donor's spectrum is met once a step, however many segments ask for it
    read = joins.interpolate_log(known, wanted.select("donor", "freq_hz").distinct(), ["donor"], "freq_hz", ["re", "im"])
    weighed = wanted.join(read, ["donor", "freq_hz"]).join(areas.select(F.col("segment").alias("donor"), F.col("area").alias("_a")), "donor")
    mean = lambda c: (F.sum(F.col("_a") * F.col(c)) / F.sum("_a")).alias(c)
    return weighed.groupBy("segment", "freq_hz").agg(mean("re"), mean("im"), F.count(F.lit(1)).alias("n_donors"))
