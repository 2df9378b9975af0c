"""The layout of unknown binary files, from their bytes: how long a record is, what its values are, and where the first record begins.

1. Bytes a record apart belong to the same place of a value, so they are alike: the record's length is the first peak of the bytes' autocorrelation that is not far below the highest. It is summed over spans of the files
   that overlap by the longest record, by one transform a span.
2. For each type and byte order that divides the record, and each byte at which a value may begin, values are held against what readings are: finite, neither tiny nor huge, and changing little from record
   to record. Counts and sums of these add up over spans, and the score is their product.
   Two single floats read as a double move as its upper one does, so by its own score a double can't be told from them. The lower half of a true double is noise or still, so both halves are scored as singles too.
3. The best layout is given with its lead over the next one that isn't the same by another name. Bytes without a peak, or a layout without a lead, are refused, with the reason.

Tasks read spans, a megabyte each; what leaves them is an array of correlations or a row of sums a layout.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.lags import array_sums
from .recordings import _store, sizes

#: Types and byte orders that are tried, in the order that decides ties.
TYPES = ("<f4", ">f4", "<f8", ">f8", "<i2", ">i2", "<i4", ">i4")
SPAN = 1 << 20
#: Doubles of which both halves score at least this share as single floats are two singles. Running sums had 0.7 to 2.1 where they were singles, below 0.2 where they were doubles.
HALVES = 0.5


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_bytes) of the files that a path with wildcards in its last part stands for."""
    return spark.createDataFrame(sizes(path), "path string, n_bytes long")


def write_bytes(path: str, data: bytes) -> None:
    store, inner = _store(path)
    with store.open_output_stream(inner) as f:
        f.write(data)


def _spans(files: DataFrame) -> DataFrame:
    begin = F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("n_bytes") - 1, F.lit(0)).cast("long"), F.lit(SPAN).cast("long")))
    return files.where(F.col("n_bytes") > 0).select("path", "n_bytes", begin.alias("begin"))


def _bytes(path: str, begin: int, n: int) -> np.ndarray:
    store, inner = _store(path)
    with store.open_input_file(inner) as f:
        f.seek(begin)
        return np.frombuffer(f.read(n), np.uint8)


def correlations(files: DataFrame, longest: int = 1024) -> DataFrame:
    """(path, correlation): of bytes 0 .. longest apart, as an array. files: (path, n_bytes)."""

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for path, begin in zip(pdf.path, pdf.begin):
                b = _bytes(path, begin, SPAN + longest).astype(float)
                # bytes count on a circle, where 255 lies beside 0
                z = np.exp(2j * np.pi * b / 256)
                z = z - z.mean()
                own = z[:SPAN]
                n = 1 << (len(z) + len(own)).bit_length()
                product = np.fft.ifft(np.conj(np.fft.fft(own, n)) * np.fft.fft(z, n))[: longest + 1].real
                pairs = np.minimum(len(own), np.maximum(0, len(z) - np.arange(longest + 1)))
                yield pd.DataFrame({"path": [path], "v": [np.concatenate((product, pairs)).tolist()]})

    total = array_sums(_spans(files).mapInPandas(sums, "path string, v array<double>"), ["path"], "v")
    n = longest + 1
    each = F.zip_with(F.slice("v", 1, n), F.slice("v", n + 1, n), lambda a, m: F.when(m > 0, a / m).otherwise(0.0))
    zero = F.col("_c")[0]
    return total.select("path", each.alias("_c")).select("path", F.transform("_c", lambda c: F.when(zero > 0, c / zero).otherwise(0.0)).alias("correlation"))


def record_lengths(correlation: DataFrame, shortest: int = 2, near: float = 0.6, least: float = 0.05) -> DataFrame:
    """(path, record, height): the least distance that is a peak of at least `near` times the highest (low bytes may differ from one record to the next, and agree better some records on); null where the highest is below `least`, as for noise."""
    rows = correlation.select("path", F.posexplode("correlation").alias("d", "c"))
    w = Window.partitionBy("path").orderBy("d")
    peaks = rows.withColumn("_b", F.lag("c").over(w)).withColumn("_a", F.lead("c").over(w)).where((F.col("d") >= shortest) & (F.col("c") >= F.coalesce("_b", F.lit(-1.0))) & (F.col("c") >= F.coalesce("_a", F.lit(-1.0))))
    top = peaks.withColumn("_top", F.max("c").over(Window.partitionBy("path")))
    found = top.where(F.col("_top") >= least).where(F.col("c") >= near * F.col("_top")).groupBy("path").agg(F.min_by(F.struct("d", "c"), "d").alias("_p"))
    return correlation.select("path").join(found, "path", "left").select("path", F.col("_p.d").alias("record"), F.col("_p.c").alias("height"))


def layout_scores(files: DataFrame, records: DataFrame) -> DataFrame:
    """(path, record, type, first, n, finite, usual, smooth, score, halves): each type and first byte (0 .. its width - 1) that values may have.

    usual: the share of finite values that are 0 or between 1e-9 and 1e9 in size. smooth: 1 less the root of the mean bend (second difference from record to record) over the mean distance from the
    place's mean; 0 below it. A value read from one byte further keeps its high byte, so its steps look right, but not its bends.
    halves: of doubles, the lesser score that their lower and upper halves have as single floats; places that stay still don't count as smooth there. 0 for other types.
    """
    spans = _spans(files).join(F.broadcast(records.where(F.col("record").isNotNull()).select("path", "record")), "path")
    counts = ["n", "finite", "usual", "bend", "bends"]
    names = ["path", "record", "type", "first", *[half + c for half in ("", "even_", "odd_") for c in counts]]

    def weigh(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for path, begin, record in zip(pdf.path, pdf.begin, pdf.record):
                raw = _bytes(path, begin, SPAN)
                for kind in TYPES:
                    width = int(kind[2:])
                    if record % width:
                        continue
                    for first in range(width):
                        # the span's first value that begins at `first`, counted from the file's start
                        skip = (first - begin) % width
                        whole = (len(raw) - skip) // record * record
                        if whole < 3 * record:
                            continue
                        with np.errstate(invalid="ignore"):
                            v = np.ascontiguousarray(raw[skip : skip + whole]).view(kind).astype(float).reshape(-1, record // width)
                        known = np.isfinite(v)
                        size = np.abs(np.where(known, v, 0))
                        usual = known & ((size == 0) | ((size >= 1e-9) & (size <= 1e9)))
                        clean = np.where(usual, v, np.nan)
                        many = np.maximum(1, usual.sum(axis=0))
                        spread = np.abs(clean - np.nansum(clean, axis=0) / many)
                        # places count alike, whatever their unit
                        unit = np.nansum(spread, axis=0) / many
                        bend = np.abs(np.diff(clean, 2, axis=0)) / np.where(unit > 0, unit, np.inf)
                        bends = np.isfinite(bend)
                        row = [path, record, kind, first, v.size, int(known.sum()), int(usual.sum()), float(np.nansum(bend)), float(bends.sum())]
                        for half in (0, 1):
                            # every other single from the file's first one; spans may begin with either
                            places = slice((half + (begin + skip - first) // width) % 2, None if kind[1:] == "f4" and record % 8 == 0 else 0, 2)
                            row += [known[:, places].size, int(known[:, places].sum()), int(usual[:, places].sum()), float(np.nansum(bend[:, places])), float((bends & (unit > 0))[:, places].sum())]
                        rows.append(row)
            yield pd.DataFrame(rows, columns=names)

    kinds = {"n": "long", "finite": "long", "usual": "long", "bend": "double", "bends": "double"}
    each = spans.mapInPandas(weigh, "path string, record int, type string, first int, " + ", ".join(f"{c} {kinds[c.split('_')[-1]]}" for c in names[4:]))
    sums = each.groupBy("path", "record", "type", "first").agg(*[F.sum(c).alias(c) for c in names[4:]])
    share = lambda a, b: F.coalesce(F.col(a) / F.when(F.col(b) > 0, F.col(b)), F.lit(0.0))
    smooth = lambda half: F.greatest(F.lit(0.0), 1 - F.sqrt(F.coalesce(F.col(half + "bend") / F.when(F.col(half + "bends") > 0, F.col(half + "bends")), F.lit(1.0))))
    score = lambda half: share(half + "finite", half + "n") * share(half + "usual", half + "finite") * share(half + "usual", half + "finite") * smooth(half)
    # wider values say more: two narrow ones lie in a wide one, not the other way round
    out = sums.select("path", "record", "type", "first", "n", share("finite", "n").alias("finite"), share("usual", "finite").alias("usual"), smooth("").alias("smooth"), score("").alias("score"), F.least(score("even_"), score("odd_")).alias("_halves"))
    # a double that begins at byte b is made of the singles from byte b % 4
    singles = Window.partitionBy("path", F.substring("type", 1, 1), F.col("first") % 4)
    return out.withColumn("halves", F.when(F.substring("type", 2, 2) == "f8", F.max("_halves").over(singles)).otherwise(0.0)).drop("_halves")


def layouts(files: DataFrame, longest: int = 1024, least: float = 0.3, lead: float = 0.02) -> DataFrame:
    """(path, record, type, first, score, lead, reason): the layout of each file (path, n_bytes), or nulls and the reason why there is none.

    lead: by how much the best score is above the best one of another type or first byte. Where it is below `lead` the file could be either. Of equal scores the type that TYPES names first counts.
    Doubles whose halves are single floats (HALVES) are no layout of their own.
    """
    lengths = record_lengths(correlations(files, longest))
    rank = F.array_position(F.array(*[F.lit(t) for t in TYPES]), F.col("type"))
    scores = layout_scores(files, lengths).where((F.col("halves") == 0) | (F.col("halves") < HALVES * F.col("score"))).withColumn("_s", F.round("score", 9)).withColumn("_rank", rank)
    w = Window.partitionBy("path").orderBy(F.desc("_s"), "_rank", "first")
    best = scores.withColumn("_next", F.lead("score").over(w)).withColumn("_n", F.row_number().over(w)).where("_n = 1")
    best = best.select("path", "type", "first", "score", (F.col("score") - F.coalesce("_next", F.lit(0.0))).alias("lead"))
    both = files.select("path").join(lengths, "path", "left").join(best, "path", "left")
    reason = F.when(F.col("record").isNull(), "no record length").when(F.coalesce(F.col("score"), F.lit(0.0)) < least, "no type fits").when(F.col("lead") < lead, "more than one type fits")
    out = both.withColumn("reason", reason)
    kept = lambda c: F.when(F.col("reason").isNull(), F.col(c)).alias(c)
    return out.select("path", kept("record"), kept("type"), kept("first"), F.col("score"), F.col("lead"), "reason")
