"""Tones that no single channel shows: detection over all channels of a frame, ladders of frequencies, and schedules recovered from both.

A frame is the chunk of every channel of a recording at one first_sample: (path, channel, first_sample, fs, samples). Channels of a frame meet once, in a group of at
most the plate's channels times a chunk; what leaves it is one array of bins a frame. All later steps are sums of bins or phasors over frames (map-side
combined) and windows over frames or rungs, so neither a channel nor a recording is ever held whole.

Under noise alone the bins of a frame (no taper, mean removed) are exchangeable, so both tests have exact false-alarm rates without a noise level:

* the array test: a bin of the power summed over channels exceeds all its background bins with probability 1 / (1 + background bins);
* the count test: the number of channels whose own bin does so is binomial with that probability.

A frame of fewer than 3 channels, or too short for background bins, has no tests. Channels with a null or a number that isn't finite in a frame don't count in it, nor do
those that never change.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .materialise import kept

FRAME = "path string, first_sample long, fs double, n_samples int, n_channels int, power array<double>, found array<struct<bin:int,ratio_db:double,is_max:boolean,n_over:int,threshold:int>>"


def background_bins(n_bins: int, n_bg: int, guard: int) -> tuple[int, int]:
    """The first and the last bin that has n_bg background bins on both sides, beyond `guard` bins next to it; bin 0 is none."""
    return 1 + guard + n_bg, n_bins - 1 - guard - n_bg


def _background(power: np.ndarray, n_bg: int, guard: int) -> np.ndarray:
    """For each testable bin (last axis) the background bins of both sides."""
    first, last = background_bins(power.shape[-1], n_bg, guard)
    runs = np.lib.stride_tricks.sliding_window_view(power, n_bg, axis=-1)
    at = np.arange(first, last + 1)
    return np.concatenate((runs[..., at - guard - n_bg, :], runs[..., at + guard + 1, :]), axis=-1)


def count_threshold(m: int, p: float, alpha: float) -> int:
    """The least count that at least so many of m channels reach by chance with probability alpha at most; m + 1 if there is none."""
    tail = np.cumsum([math.comb(m, c) * p**c * (1 - p) ** (m - c) for c in range(m, -1, -1)])[::-1]
    return int(np.argmax(np.append(tail, 0.0) <= alpha))


def array_tests(samples: np.ndarray, n_bg: int, guard: int, alpha: float) -> tuple[np.ndarray, list[tuple[int, float, bool, int, int]]]:
    """For channels x samples: the summed power a bin, each channel's in units of its median bin, and the bins that pass a test."""
    power = np.abs(np.fft.rfft(samples - samples.mean(axis=1, keepdims=True), axis=1)) ** 2
    power = power[:, : (samples.shape[1] - 1) // 2 + 1]
    level = np.median(power[:, 1:], axis=1, keepdims=True)
    power = (power / np.where(level > 0, level, 1))[(level > 0)[:, 0]]
    total, m = power.sum(axis=0), len(power)
    first, last = background_bins(power.shape[1], n_bg, guard)
    if m < 3 or first > last:
        return total, []
    at = slice(first, last + 1)
    beside = _background(total, n_bg, guard)
    is_max = total[at] > beside.max(axis=-1)
    over = (power[:, at] > _background(power, n_bg, guard).max(axis=-1)).sum(axis=0)
    least = count_threshold(m, 1 / (1 + 2 * n_bg), alpha)
    ratio = 10 * np.log10(total[at] / np.median(beside, axis=-1))
    return total, [(first + k, float(ratio[k]), bool(is_max[k]), int(over[k]), least) for k in np.flatnonzero(is_max | (over >= least)).tolist()]


def frames(chunks: DataFrame, n_bg: int = 24, guard: int = 2, alpha: float = 1e-3) -> DataFrame:
    """One row a frame: the number of its channels, the summed power of its bins, and the bins that pass a test."""

    def test(key: tuple, table: pa.Table) -> pa.Table:
        column = table.column("samples").combine_chunks()
        lengths = np.asarray(column.value_lengths().fill_null(0))
        size = int(lengths.max(initial=0))
        whole = [x for x, n in zip(column, lengths, strict=True) if n == size and x.values.null_count == 0]
        x = np.array([v.values.to_numpy(zero_copy_only=False) for v in whole], float).reshape(len(whole), size)
        x = x[np.isfinite(x).all(axis=1)]
        x = x[(x != x[:, :1]).any(axis=1)] if size else x
        power, found = array_tests(x, n_bg, guard, alpha) if len(x) else (np.zeros(0), [])
        fs = table.column("fs")[0].as_py()
        names = ("bin", "ratio_db", "is_max", "n_over", "threshold")
        rows = [{"path": key[0].as_py(), "first_sample": key[1].as_py(), "fs": fs, "n_samples": size, "n_channels": len(x), "power": power.tolist(), "found": [dict(zip(names, f, strict=True)) for f in found]}]
        kind = pa.struct([("bin", pa.int32()), ("ratio_db", pa.float64()), ("is_max", pa.bool_()), ("n_over", pa.int32()), ("threshold", pa.int32())])
        return pa.Table.from_pylist(rows, pa.schema([("path", pa.string()), ("first_sample", pa.int64()), ("fs", pa.float64()), ("n_samples", pa.int32()), ("n_channels", pa.int32()), ("power", pa.list_(pa.float64())), ("found", pa.list_(kind))]))

    source = chunks.select("path", "first_sample", F.col("fs").cast("double").alias("fs"), F.transform("samples", lambda x: x.cast("double")).alias("samples"))
    return source.groupBy("path", "first_sample").applyInArrow(test, FRAME)


def detections(tested: DataFrame) -> DataFrame:
    """One row a bin that passes a test: (path, first_sample, n_channels, freq_hz, bin, ratio_db, is_max, n_over, threshold)."""
    rows = tested.select("path", "first_sample", "fs", "n_samples", "n_channels", F.explode("found").alias("f"))
    return rows.select("path", "first_sample", "n_samples", "n_channels", (F.col("f.bin") * F.col("fs") / F.col("n_samples")).alias("freq_hz"), "f.*")


def dwells(found: DataFrame, least: int = 2, gap: int = 1) -> DataFrame:
    """(path, step, first_sample, last_sample, n_frames, bin): frames in a row whose strongest array detection stays within a bin of the one before.

    Of a frame only the strongest bin that passes the array test counts. Up to `gap` frames without one don't end a dwell; those of fewer than `least` frames go.
    """
    top = found.where("is_max").groupBy("path", "first_sample", "n_samples").agg(F.max(F.struct("ratio_db", (-F.col("bin")).alias("_bin"))).alias("_top"))
    top = top.select("path", "first_sample", "n_samples", (-F.col("_top._bin")).alias("bin"))
    w = Window.partitionBy("path").orderBy("first_sample")
    far = (F.col("first_sample") - F.lag("first_sample").over(w) > (gap + 1) * F.col("n_samples")) | (F.abs(F.col("bin") - F.lag("bin").over(w)) > 1)
    runs = top.withColumn("_new", F.coalesce(far, F.lit(False)).cast("int")).withColumn("_run", F.sum("_new").over(w))
    kept = runs.groupBy("path", "_run").agg(
        F.min("first_sample").alias("first_sample"), F.max(F.col("first_sample") + F.col("n_samples") - 1).alias("last_sample"), F.count(F.lit(1)).alias("n_frames"), F.percentile("bin", 0.5).cast("int").alias("bin")
    ).where(F.col("n_frames") >= least)
    return kept.withColumn("step", F.row_number().over(Window.partitionBy("path").orderBy("first_sample")) - 1).drop("_run")


def phasors_at(chunks: DataFrame, tones: DataFrame) -> DataFrame:
    """(path, tone, channel, first_sample, freq_hz, re, im, power, n): each channel's least phasor of a tone in each frame that the tone covers.

    tones: (path, tone, freq_hz, first_sample, last_sample). Tones meet the frames that lie in them through an equi-join on (path, chunk number), as both lists of numbers are
    derived from sample positions; a chunk counts if it lies wholly within the tone. Phases refer to sample 0 of the recording. power: the mean square after the mean is taken out.
    """
    sizes = chunks.groupBy("path").agg(F.max(F.size("samples")).alias("_size"))
    spread = tones.join(F.broadcast(sizes), "path").withColumn("_at", F.explode(F.sequence(F.floor(F.col("first_sample") / F.col("_size")), F.floor(F.col("last_sample") / F.col("_size")))))
    spread = spread.select("path", "tone", "freq_hz", F.col("first_sample").alias("_lo"), F.col("last_sample").alias("_hi"), "_at", "_size")
    # a chunk may begin anywhere in its grid cell
    held = chunks.join(F.broadcast(sizes), "path").withColumn("_at", F.floor(F.col("first_sample") / F.col("_size"))).drop("_size")
    met = held.join(spread, ["path", "_at"]).where((F.col("first_sample") >= F.col("_lo")) & (F.col("first_sample") + F.size("samples") - 1 <= F.col("_hi")))
    rows = met.select("path", "tone", "channel", "first_sample", "freq_hz", F.col("fs").cast("double").alias("fs"), F.transform("samples", lambda x: x.cast("double")).alias("samples"))

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("samples")
            n = np.asarray(column.value_lengths())
            x = column.flatten().to_numpy(zero_copy_only=False).astype(float)
            starts = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
            owner = np.repeat(np.arange(len(n)), n)
            rate = np.asarray(batch.column("freq_hz")) / np.asarray(batch.column("fs"))
            at = np.arange(len(x)) - starts[owner] + np.asarray(batch.column("first_sample"))[owner]
            turn = 2 * np.pi * ((rate[owner] * at) % 1.0)
            sums = lambda v: np.add.reduceat(v, starts) if len(v) else np.zeros(0)
            x = x - (sums(x) / n)[owner]
            columns = [2 * sums(x * np.cos(turn)) / n, -2 * sums(x * np.sin(turn)) / n, sums(x * x) / n]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], *map(pa.array, columns), pa.array(n.astype(np.int64))], names=["path", "tone", "channel", "first_sample", "freq_hz", "re", "im", "power", "n"])

    kinds = dict(rows.dtypes)
    return rows.where(F.size("samples") > 0).mapInArrow(fit, f"path string, tone {kinds['tone']}, channel {kinds['channel']}, first_sample long, freq_hz double, re double, im double, power double, n long")


def refined_frequency(phasors: DataFrame, keys: list[str], every: str = "step_s") -> DataFrame:
    """(keys, freq_hz, n_pairs): the frequency from the mean turn of phasors between frames in a row, over all channels at once.

    Channels may have any phases: only each channel's own turn counts, and products add up before the angle is taken, so strong ones weigh more. `every`: the column with the
    seconds between a frame and the one before; the tone must be off by less than half a turn in that.
    """
    w = Window.partitionBy(*keys, "channel").orderBy("first_sample")
    was_re, was_im = F.lag("re").over(w), F.lag("im").over(w)
    pairs = phasors.select(*keys, "freq_hz", every, (F.col("re") * was_re + F.col("im") * was_im).alias("_c"), (F.col("im") * was_re - F.col("re") * was_im).alias("_s")).where(F.col("_c").isNotNull() & F.col(every).isNotNull())
    sums = pairs.groupBy(*keys).agg(F.first("freq_hz").alias("_f"), F.avg(every).alias("_t"), F.sum("_c").alias("_c"), F.sum("_s").alias("_s"), F.count(F.lit(1)).alias("n_pairs"))
    return sums.select(*keys, (F.col("_f") + F.atan2("_s", "_c") / (2 * F.pi() * F.col("_t"))).alias("freq_hz"), "n_pairs")


def gram(phasors: DataFrame, keys: list[str], snapshot: str) -> DataFrame:
    """(keys, i, j, re, im, n_snapshots, n_channels): the second moments of the channels' phasors, whitened by each channel's spread over snapshots.

    i, j number the channels from 0 by name. Pairs are made within a snapshot, of which each channel has one value, and add up on the map side. Channels without a spread don't count.
    """
    w = Window.partitionBy(*keys, "channel")
    spread = F.sqrt(F.avg(F.col("re") * F.col("re") + F.col("im") * F.col("im")).over(w) - F.pow(F.avg("re").over(w), 2) - F.pow(F.avg("im").over(w), 2))
    white = phasors.withColumn("_s", spread).where(F.col("_s") > 0).select(*keys, "channel", snapshot, (F.col("re") / F.col("_s")).alias("re"), (F.col("im") / F.col("_s")).alias("im"))
    numbered = white.withColumn("k", F.dense_rank().over(Window.partitionBy(*keys).orderBy("channel")) - 1)
    each = numbered.groupBy(*keys, snapshot).agg(F.sort_array(F.collect_list(F.struct("k", "re", "im"))).alias("a"))
    pairs = each.select(*keys, snapshot, F.explode("a").alias("x"), "a").select(*keys, snapshot, "x", F.explode("a").alias("y")).where("x.k <= y.k")
    dot = lambda re: F.sum(F.col("x.re") * F.col("y.re") + F.col("x.im") * F.col("y.im") if re else F.col("x.im") * F.col("y.re") - F.col("x.re") * F.col("y.im"))
    sums = pairs.groupBy(*keys, F.col("x.k").alias("i"), F.col("y.k").alias("j")).agg(dot(True).alias("re"), dot(False).alias("im"))
    counts = numbered.groupBy(*keys).agg(F.countDistinct(snapshot).alias("n_snapshots"), F.countDistinct("k").alias("n_channels"))
    return sums.join(counts, keys).select(*keys, "i", "j", (F.col("re") / F.col("n_snapshots")).alias("re"), (F.col("im") / F.col("n_snapshots")).alias("im"), "n_snapshots", "n_channels")


def rank_one(phasors: DataFrame, keys: list[str], snapshot: str) -> DataFrame:
    """(keys, n_channels, n_snapshots, statistic, edge, participation, shared): is one component common to the channels?

    statistic: the largest eigenvalue of gram() over the mean one; edge: what noise alone tends to, (1 + sqrt(channels / snapshots))^2;
    participation: how many channels the component spans; shared: above the edge, and over a third of the channels (at least 3).
    """
    entries = gram(phasors, keys, snapshot).groupBy(*keys, "n_channels", "n_snapshots").agg(F.collect_list(F.struct("i", "j", "re", "im")).alias("e"))

    @F.pandas_udf("struct<statistic:double,participation:double>")
    def largest(e, m):
        import pandas as pd

        rows = []
        for entries, n in zip(e, m, strict=True):
            a = np.zeros((n, n), complex)
            for x in entries:
                a[x["i"], x["j"]] = x["re"] + 1j * x["im"]
                a[x["j"], x["i"]] = x["re"] - 1j * x["im"]
            values, vectors = np.linalg.eigh(a)
            share = np.abs(vectors[:, -1]) ** 2
            rows.append((float(values[-1] / values.mean()), float(1 / (share**2).sum())))
        return pd.DataFrame(rows, columns=["statistic", "participation"])

    out = entries.select(*keys, "n_channels", "n_snapshots", largest("e", "n_channels").alias("v")).select(*keys, "n_channels", "n_snapshots", "v.*")
    edge = F.pow(1 + F.sqrt(F.col("n_channels") / F.col("n_snapshots")), 2)
    shared = (F.col("n_channels") >= 3) & (F.col("n_snapshots") >= 4) & (F.col("statistic") >= edge) & (F.col("participation") >= F.greatest(F.lit(3.0), F.col("n_channels") / 3))
    return out.withColumn("edge", edge).withColumn("shared", shared)


def ladder(steps: DataFrame, keys: list[str], frequency: str, per_decade: tuple[float, float] = (2.0, 40.0), grid: float = 0.01, near: float = 0.9) -> DataFrame:
    """(keys, per_decade, log_f0, log_ratio, n_steps, residual): the geometric ladder that a list of frequencies lies on, some missing.

    For each number of points a decade on a grid the frequencies are unit vectors turned by their place between rungs. Their mean is long where all places agree: at the true
    ladder and at its subdivisions, not at multiples. So the coarsest local maximum within `near` of the longest is the ladder. Rungs are then numbered (0 at log_f0), and a line
    through ln f gives spacing and offset, twice. residual: the median relative distance from the rungs. Null for fewer than 5 frequencies.
    """
    f = steps.where(F.col(frequency) > 0).select(*keys, F.log(frequency).alias("_y")).distinct()
    n = int(round((per_decade[1] - per_decade[0]) / grid))
    tried = f.withColumn("_c", F.explode(F.sequence(F.lit(0), F.lit(n)))).withColumn("_d", per_decade[0] + F.col("_c") * grid)
    turn = 2 * F.pi() * F.col("_y") * F.col("_d") / math.log(10)
    means = tried.groupBy(*keys, "_c", "_d").agg(F.avg(F.cos(turn)).alias("_re"), F.avg(F.sin(turn)).alias("_im"), F.count(F.lit(1)).alias("n_steps")).withColumn("_r", F.sqrt(F.col("_re") * F.col("_re") + F.col("_im") * F.col("_im")))
    w, whole = Window.partitionBy(*keys).orderBy("_c"), Window.partitionBy(*keys)
    peaks = means.withColumn("_top", F.max("_r").over(whole)).withColumn("_peak", (F.col("_r") >= F.coalesce(F.lag("_r").over(w), F.lit(0.0))) & (F.col("_r") >= F.coalesce(F.lead("_r").over(w), F.lit(0.0))))
    first = peaks.where(F.col("_peak") & (F.col("_r") >= near * F.col("_top"))).groupBy(*keys).agg(F.min_by(F.struct("_d", "_re", "_im", "n_steps"), "_c").alias("_p"))
    spacing = math.log(10) / F.col("_p._d")
    fit = first.select(*keys, "_p.n_steps", spacing.alias("_b"), (spacing * F.atan2("_p._im", "_p._re") / (2 * F.pi())).alias("_a"))
    for _ in range(2):
        rung = F.round((F.col("_y") - F.col("_a")) / F.col("_b"))
        fit = f.join(fit, keys).select(*keys, "n_steps", "_y", rung.alias("_k")).groupBy(*keys, "n_steps").agg(F.regr_slope("_y", "_k").alias("_b"), F.regr_intercept("_y", "_k").alias("_a"))
    off = F.abs(F.exp(F.col("_y") - F.col("_a") - F.col("_b") * F.round((F.col("_y") - F.col("_a")) / F.col("_b"))) - 1)
    out = f.join(fit, keys).groupBy(*keys, "n_steps", "_a", "_b").agg(F.median(off).alias("residual")).where((F.col("n_steps") >= 5) & (F.col("_b") > 0))
    return out.select(*keys, (math.log(10) / F.col("_b")).alias("per_decade"), F.col("_a").alias("log_f0"), F.col("_b").alias("log_ratio"), "n_steps", "residual")


def missing_rungs(steps: DataFrame, ladders: DataFrame, low: float, high: float, tolerance: float) -> DataFrame:
    """(path, tone, freq_hz, first_sample, last_sample): rungs between low and high Hz without a step, and where they should be.

    steps: (path, freq_hz, first_sample, last_sample) in a sweep that goes up or down the ladder. Rungs between two steps share what lies between these evenly; those
    beyond the outermost step follow it at its own length and the distance of the outermost two steps a rung. Rungs before the first sample are dropped.
    """
    rung = F.round((F.log("freq_hz") - F.col("log_f0")) / F.col("log_ratio")).cast("long")
    on = steps.join(F.broadcast(ladders.select("path", "log_f0", "log_ratio")), "path").withColumn("k", rung)
    on = on.where(F.abs(F.exp(F.log("freq_hz") - F.col("log_f0") - F.col("log_ratio") * F.col("k")) - 1) <= tolerance)
    on = on.groupBy("path", "k", "log_f0", "log_ratio").agg(F.min("first_sample").alias("a"), F.max("last_sample").alias("b"))
    w = Window.partitionBy("path").orderBy("k")
    place = F.struct("k", "a", "b")
    on = on.withColumn("next", F.lead(place).over(w)).withColumn("back", F.lag(place).over(w))
    at = lambda k: F.exp(F.col("log_f0") + F.col("log_ratio") * k)
    between = on.where(F.col("next.k") > F.col("k") + 1).withColumn("m", F.explode(F.sequence(F.col("k") + 1, F.col("next.k") - 1)))
    gone, up = F.col("next.k") - F.col("k") - 1, F.col("next.a") > F.col("a")
    lo, hi = F.when(up, F.col("b") + 1).otherwise(F.col("next.b") + 1), F.when(up, F.col("next.a") - 1).otherwise(F.col("a") - 1)
    order = F.when(up, F.col("m") - F.col("k") - 1).otherwise(F.col("next.k") - 1 - F.col("m"))
    share = (hi - lo + 1) / gone
    inside = between.select("path", F.col("m").alias("tone"), at(F.col("m")).alias("freq_hz"), (lo + F.floor(share * order)).alias("first_sample"), (lo + F.floor(share * (order + 1)) - 1).alias("last_sample"))
    last = lambda c: F.floor((F.log(F.lit(c)) - F.col("log_f0")) / F.col("log_ratio"))
    ends = []
    for beside, sign, bound in (("back", 1, last(high)), ("next", -1, -F.floor((F.col("log_f0") - F.log(F.lit(low))) / F.col("log_ratio")))):
        outer = on.where(F.col("next" if sign == 1 else "back").isNull() & F.col(beside).isNotNull() & (sign * (bound - F.col("k")) >= 1))
        pace = (F.col("a") - F.col(f"{beside}.a")) / F.abs(F.col("k") - F.col(f"{beside}.k"))
        outer = outer.withColumn("m", F.explode(F.sequence(F.col("k") + sign, bound.cast("long"))))
        start = F.col("a") + F.floor(pace * F.abs(F.col("m") - F.col("k"))).cast("long")
        ends.append(outer.select("path", F.col("m").alias("tone"), at(F.col("m")).alias("freq_hz"), start.alias("first_sample"), (start + F.col("b") - F.col("a")).alias("last_sample")))
    out = inside.unionByName(ends[0]).unionByName(ends[1])
    return out.where((F.col("first_sample") >= 0) & (F.col("last_sample") > F.col("first_sample")) & F.col("freq_hz").between(low, high))


def integrated_tests(tested: DataFrame, tones: DataFrame, n_bg: int = 24, guard: int = 2) -> DataFrame:
    """(path, tone, n_frames, is_max, ratio_db): the array test on the power summed over all frames that lie in a tone, at the two bins beside its frequency.

    Only bins that the test needs leave a frame. ratio_db: over the median background bin.
    """
    sizes = tested.groupBy("path").agg(F.max("n_samples").alias("_size"))
    spread = tones.join(F.broadcast(sizes), "path").withColumn("_at", F.explode(F.sequence(F.floor(F.col("first_sample") / F.col("_size")), F.floor(F.col("last_sample") / F.col("_size")))))
    spread = spread.select("path", "tone", "freq_hz", F.col("first_sample").alias("_lo"), F.col("last_sample").alias("_hi"), "_at")
    held = tested.join(F.broadcast(sizes), "path").withColumn("_at", F.floor(F.col("first_sample") / F.col("_size")))
    met = held.join(spread, ["path", "_at"]).where((F.col("first_sample") >= F.col("_lo")) & (F.col("first_sample") + F.col("n_samples") - 1 <= F.col("_hi")) & (F.col("n_channels") >= 3))
    own = F.floor(F.col("freq_hz") * F.col("n_samples") / F.col("fs")).cast("int")
    met = met.withColumn("_k", own).where((own - guard - n_bg >= 1) & (own + 1 + guard + n_bg < F.size("power")))
    bins = met.select("path", "tone", "first_sample", F.posexplode(F.slice("power", F.col("_k") - guard - n_bg + 1, 2 * (guard + n_bg) + 2)).alias("_d", "_p"))
    sums = bins.groupBy("path", "tone", "_d").agg(F.sum("_p").alias("_p"), F.count(F.lit(1)).alias("n_frames"))
    beside = (F.col("_d") < n_bg) | (F.col("_d") >= n_bg + 2 * guard + 2)
    tone = F.col("_d").isin(n_bg + guard, n_bg + guard + 1)
    out = sums.groupBy("path", "tone").agg(F.max("n_frames").alias("n_frames"), F.max(F.when(tone, F.col("_p"))).alias("_t"), F.max(F.when(beside, F.col("_p"))).alias("_b"), F.median(F.when(beside, F.col("_p"))).alias("_m"))
    return out.select("path", "tone", "n_frames", (F.col("_t") > F.col("_b")).alias("is_max"), (10 * F.log10(F.col("_t") / F.col("_m"))).alias("ratio_db"))


def precise_enough(phasors: DataFrame, keys: list[str], most: float) -> DataFrame:
    """(keys, snr_db, sigma_rel, precise): the median channel's SNR at a tone, over all its frames, and whether its Cramer-Rao bound is at most `most`."""
    each = phasors.groupBy(*keys, "channel").agg((F.pow(F.avg("re"), 2) + F.pow(F.avg("im"), 2)).alias("_a"), F.avg("power").alias("_p"), F.sum("n").alias("_n"))
    each = each.withColumn("_snr", F.col("_a") / 2 / F.greatest(F.col("_p") - F.col("_a") / 2, F.lit(1e-300)))
    out = each.groupBy(*keys).agg(F.median("_snr").alias("_snr"), F.median("_n").alias("_n"))
    sigma = F.sqrt(1 / F.greatest(F.col("_n") * F.col("_snr"), F.lit(1e-300)))
    return out.select(*keys, (10 * F.log10(F.greatest(F.col("_snr"), F.lit(1e-300)))).alias("snr_db"), sigma.alias("sigma_rel"), (sigma <= most).alias("precise"))


def recovered_schedule(chunks: DataFrame, low: float, high: float, tolerance: float = 0.02, sigma: float = 0.6, n_bg: int = 24, guard: int = 2, least: int = 2) -> DataFrame:
    """(path, freq_hz, first_sample, last_sample, source): the steps of each recording, `detected` or `verified`.

    Detected: dwells of array detections, their frequency refined by the turn of the phasors. The ladder is fitted on these alone and must lie within `tolerance` of half of them.
    Verified: rungs of the ladder without a step, whose frames pass the integrated array test, the common-component test (from 4 frames on) and the bound on sigma.
    """
    # one row a frame, a dwell or a rung: what several of the steps below read is written once
    tested = kept(frames(chunks, n_bg, guard))
    held = dwells(detections(tested), least).join(tested.groupBy("path").agg(F.first("fs").alias("fs"), F.max("n_samples").alias("_n")), "path")
    coarse = kept(held).select("path", F.col("step").cast("long").alias("tone"), (F.col("bin") * F.col("fs") / F.col("_n")).alias("freq_hz"), "first_sample", "last_sample", (F.col("_n") / F.col("fs")).alias("step_s"))
    turned = phasors_at(chunks, coarse.drop("step_s")).join(F.broadcast(coarse.select("path", "tone", "step_s")), ["path", "tone"])
    fine = refined_frequency(turned, ["path", "tone"])
    # a dwell of a single whole frame has no turn: its bin stands
    steps = kept(coarse.withColumnRenamed("freq_hz", "_f").join(fine.select("path", "tone", "freq_hz"), ["path", "tone"], "left").select("path", F.coalesce("freq_hz", "_f").alias("freq_hz"), "first_sample", "last_sample"))
    ladders = ladder(steps, ["path"], "freq_hz").where(F.col("residual") <= tolerance)
    wanted = kept(missing_rungs(steps, ladders, low, high, tolerance))
    each = kept(phasors_at(chunks, wanted))
    common = rank_one(each, ["path", "tone"], "first_sample")
    passed = integrated_tests(tested, wanted, n_bg, guard).where("is_max").join(precise_enough(each, ["path", "tone"], sigma).where("precise"), ["path", "tone"]).join(common, ["path", "tone"])
    passed = passed.where(F.col("shared") | (F.col("n_snapshots") < 4))
    verified = wanted.join(passed.select("path", "tone"), ["path", "tone"]).select("path", "freq_hz", "first_sample", "last_sample", F.lit("verified").alias("source"))
    return steps.withColumn("source", F.lit("detected")).unionByName(verified)
