"""Least-squares sines as normal equations: sums that combine on the map side, solved in columns.

A fit of a cos(wt) + b sin(wt) + c needs ten sums, whatever the instants: they may be uneven, have gaps, and differ a channel. So a fit over a dwell is an aggregate of samples or of
chunks; no task holds a dwell or a channel. The phasor is a - ib: the tone is its real part times exp(iwt).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .windows import unwrap

#: n, then the sums of cos, sin, cos^2, sin^2, cos sin, x, x cos, x sin, x^2.
SUMS = ("n", "sc", "ss", "scc", "sss", "scs", "sx", "sxc", "sxs", "sxx")


def sums_of_rows(rows: DataFrame, keys: list[str], x: str, turn: Column) -> DataFrame:
    """(keys, SUMS) of single samples; turn: the tone's phase at the sample's own instant, in radians. Samples without a value, or whose value or phase isn't finite, don't count."""
    c, s, v = F.cos(turn), F.sin(turn), F.col(x).cast("double")
    sound = v.isNotNull() & turn.isNotNull() & (F.abs(v) < float("inf")) & (F.abs(turn) < float("inf"))
    each = rows.where(sound).select(*keys, c.alias("_c"), s.alias("_s"), v.alias("_x"))
    c, s, v = F.col("_c"), F.col("_s"), F.col("_x")
    products = (c, s, c * c, s * s, c * s, v, v * c, v * s, v * v)
    return each.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), *[F.sum(p).alias(name) for name, p in zip(SUMS[1:], products, strict=True)])


def sums_of_chunks(chunks: DataFrame, tones: DataFrame) -> DataFrame:
    """(path, channel, tone, freq_hz, SUMS) over each tone's samples, first_sample to last_sample inclusive, of each channel of its recording.

    chunks: (path, channel, first_sample, fs, samples), of any sizes; tones: (path, tone, freq_hz, first_sample, last_sample). They meet by an equi-join on stretches of the longest chunk's
    length, so a tone goes to the chunks that it overlaps only. Phases count from the tone's first sample. Samples that aren't finite don't count.
    """
    longest = chunks.groupBy("path").agg(F.max(F.size("samples")).alias("_size")).where(F.col("_size") > 0)
    # a chunk touches at most two stretches; it is dealt to that of its first sample, and a tone reaches one stretch further back
    held = chunks.join(F.broadcast(longest), "path").withColumn("_at", F.floor(F.col("first_sample") / F.col("_size"))).drop("_size")
    reach = F.explode(F.sequence(F.floor(F.col("first_sample") / F.col("_size")) - 1, F.floor(F.col("last_sample") / F.col("_size"))))
    wanted = tones.join(F.broadcast(longest), "path").withColumn("_at", reach)
    wanted = wanted.select("path", "_at", "tone", F.col("freq_hz").cast("double").alias("freq_hz"), F.col("first_sample").alias("_lo"), F.col("last_sample").alias("_hi"))
    met = held.join(wanted, ["path", "_at"]).where((F.col("first_sample") <= F.col("_hi")) & (F.col("first_sample") + F.size("samples") > F.col("_lo")))
    lo, hi = F.greatest(F.col("_lo"), F.col("first_sample")), F.least(F.col("_hi"), F.col("first_sample") + F.size("samples") - 1)
    part = F.slice("samples", (lo - F.col("first_sample") + 1).cast("int"), (hi - lo + 1).cast("int"))
    rows = met.select("path", "channel", "tone", "freq_hz", F.col("fs").cast("double").alias("fs"), (lo - F.col("_lo")).alias("_from"), F.transform(part, lambda v: v.cast("double")).alias("samples"))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("samples")
            lengths = np.asarray(column.value_lengths())
            starts = np.concatenate(([0], np.cumsum(lengths)[:-1])).astype(np.int64)
            owner = np.repeat(np.arange(len(lengths)), lengths)
            x = column.flatten().to_numpy(zero_copy_only=False).astype(float)
            at = np.arange(len(x)) - starts[owner] + np.asarray(batch.column("_from"))[owner]
            turn = 2 * np.pi * (((np.asarray(batch.column("freq_hz")) / np.asarray(batch.column("fs")))[owner] * at) % 1.0)
            known = np.isfinite(x)
            c, s, x = np.where(known, np.cos(turn), 0), np.where(known, np.sin(turn), 0), np.where(known, x, 0)
            products = (known.astype(float), c, s, c * c, s * s, c * s, x, x * c, x * s, x * x)
            columns = [np.add.reduceat(p, starts) if len(x) else np.zeros(0) for p in products]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(columns[0].astype(np.int64)), *map(pa.array, columns[1:])], names=["path", "channel", "tone", "freq_hz", *SUMS])

    kinds = dict(rows.dtypes)
    each = rows.mapInArrow(add, f"path {kinds['path']}, channel {kinds['channel']}, tone {kinds['tone']}, freq_hz double, n long, " + ", ".join(f"{c} double" for c in SUMS[1:]))
    return each.groupBy("path", "channel", "tone", "freq_hz").agg(*[F.sum(c).alias(c) for c in SUMS])


def solved(sums: DataFrame, quantum: Column | float = 0.0) -> DataFrame:
    """The rows without SUMS but n, with re, im, offset, rms and sigma_rel.

    rms: of what the fit leaves. sigma_rel: the phasor's standard deviation over its size, from the residual's variance and, added to it, quantum^2 / 12 for readings that are rounded to steps
    of quantum. All null where the samples can't tell the three parts apart (fewer than four, or instants that a sine of this frequency sees alike).
    """
    col = lambda name: F.col(name)
    n = col("n")
    centred = lambda both, a, b: col(both) - col(a) * col(b) / n
    cc, ss, cs = centred("scc", "sc", "sc"), centred("sss", "ss", "ss"), centred("scs", "sc", "ss")
    xc, xs, xx = centred("sxc", "sx", "sc"), centred("sxs", "sx", "ss"), centred("sxx", "sx", "sx")
    det = cc * ss - cs * cs
    known = sums.where(n > 0).withColumn("_det", F.when((n >= 4) & (det > 1e-9 * n * n), det))
    a, b = (xc * ss - xs * cs) / F.col("_det"), (xs * cc - xc * cs) / F.col("_det")
    fit = known.withColumn("_a", a).withColumn("_b", b).withColumn("_rest", F.greatest(F.lit(0.0), xx - F.col("_a") * xc - F.col("_b") * xs)).withColumn("_spread", (cc + ss) / F.col("_det"))
    kept = [c for c in sums.columns if c not in SUMS]
    step = quantum if isinstance(quantum, Column) else F.lit(float(quantum))
    size = F.sqrt(F.col("_a") * F.col("_a") + F.col("_b") * F.col("_b"))
    variance = F.col("_rest") / F.when(n > 3, n - 3) + step * step / 12
    return fit.select(
        *kept,
        "n",
        F.col("_a").alias("re"),
        (-F.col("_b")).alias("im"),
        ((col("sx") - F.col("_a") * col("sc") - F.col("_b") * col("ss")) / n).alias("offset"),
        F.when(F.col("_det").isNotNull(), F.sqrt(F.col("_rest") / n)).alias("rms"),
        (F.sqrt(variance * F.col("_spread") / 2) / F.when(size > 0, size)).alias("sigma_rel"),
    )


def with_sides(tones: DataFrame, away: tuple[float, ...] = (3, 4, 5, 6)) -> DataFrame:
    """(path, tone, side, freq_hz, ...): each tone (side 0) and the frequencies that lie so many resolution widths (rate over samples) beside it, for peak_ratio().

    tones: with a column fs. Sides at or below 0 Hz are left out.
    """
    width = F.col("fs") / (F.col("last_sample") - F.col("first_sample") + 1)
    side = F.explode(F.array(F.lit(0.0), *[F.lit(float(s * k)) for k in away for s in (-1, 1)]))
    rows = tones.withColumn("side", side).withColumn("freq_hz", F.col("freq_hz") + F.col("side") * width)
    return rows.where(F.col("freq_hz") > 0)


def peak_ratio(fits: DataFrame, keys: list[str], least: float = 10.0) -> DataFrame:
    """(keys, peak_ratio, excited): the size of the phasor at side 0 over the median size at the other sides, and whether it is at least `least`. Null without sides."""
    size = F.sqrt(F.col("re") * F.col("re") + F.col("im") * F.col("im"))
    out = fits.groupBy(*keys).agg(F.max(F.when(F.col("side") == 0, size)).alias("_t"), F.median(F.when(F.col("side") != 0, size)).alias("_s"))
    ratio = F.col("_t") / F.when(F.col("_s") > 0, F.col("_s"))
    return out.select(*keys, ratio.alias("peak_ratio"), (ratio >= least).alias("excited"))


def exact_frequency(chunks: DataFrame, tones: DataFrame, part: int) -> DataFrame:
    """(path, channel, tone, freq_hz, n_parts): each tone's frequency on each channel, from the phases of its parts of `part` samples.

    tones: with a frequency that is right to half a turn a part. A line through the unwrapped phases over the parts, by the rate and the length of a part, gives what is missing; its
    error is near the Cramer-Rao bound of the whole dwell. A tone of fewer than two parts keeps its frequency.
    """
    n = F.floor((F.col("last_sample") - F.col("first_sample") + 1) / part)
    cut = tones.where(n >= 1).withColumn("_p", F.explode(F.sequence(F.lit(0).cast("long"), n - 1)))
    parts = cut.select("path", F.struct("tone", "_p").alias("tone"), "freq_hz", (F.col("first_sample") + F.col("_p") * part).alias("first_sample"), (F.col("first_sample") + (F.col("_p") + 1) * part - 1).alias("last_sample"))
    rate = chunks.groupBy("path").agg(F.first("fs").cast("double").alias("_fs"))
    fits = solved(sums_of_chunks(chunks, parts)).where(F.col("re").isNotNull()).join(F.broadcast(rate), "path")
    turns = F.col("freq_hz") / F.col("_fs") * part * F.col("tone._p")
    phase = F.atan2("im", "re") - 2 * F.pi() * (turns - F.floor(turns))
    rows = fits.select("path", "channel", F.col("tone.tone").alias("tone"), F.col("tone._p").alias("_p"), "freq_hz", "_fs", phase.alias("_phase"))
    line = unwrap(rows, ["path", "channel", "tone"], ["_p"], "_phase").groupBy("path", "channel", "tone", "freq_hz", "_fs").agg(F.regr_slope("unwrapped", F.col("_p").cast("double")).alias("_b"), F.count(F.lit(1)).alias("n_parts"))
    return line.select("path", "channel", "tone", (F.col("freq_hz") + F.coalesce("_b", F.lit(0.0)) * F.col("_fs") / (2 * F.pi() * part)).alias("freq_hz"), "n_parts")
