"""Dwells of tones by a segmented scan: chunks give summaries, summaries compose, a second pass finishes.

A tone's envelope is twice the size of y, with y[n] = r y[n-1] + (1 - r) x[n] exp(-iwn): a filter whose state runs through the whole record. A chunk of N samples turns the state y that
it gets into r^N y + b, with its own b alone from the samples; such maps compose associatively, so the states at the starts of all chunks follow from one small row a chunk. A
second pass filters each chunk from its state. The trigger (on at `high`, off below `low`) also composes: of a chunk's crossings only the changes of kind leave it, and a crossing of the same
kind as the one before, in whatever chunk, changes nothing. So the dwells are the same for any chunks, and a task holds one chunk.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Chunks whose maps are composed in one group.
TOGETHER = 1024


def lowpass(u: np.ndarray, r: float, start: complex, width: int = 64) -> np.ndarray:
    """y[n] = r y[n-1] + (1 - r) u[n] from y[-1] = start, along the last axis: within blocks by a matrix, from block to block by their last values."""
    n = u.shape[-1]
    padded = np.zeros((*u.shape[:-1], -(-n // width) * width), complex)
    padded[..., :n] = u
    blocks = padded.reshape(*u.shape[:-1], -1, width)
    k = np.arange(width)
    inside = (1 - r) * np.where(k[:, None] >= k, r ** np.maximum(k[:, None] - k, 0).astype(float), 0.0)
    own = blocks @ inside.T
    fade = r ** (k + 1.0)
    state = np.broadcast_to(np.asarray(start, complex), u.shape[:-1]).copy()
    for b in range(own.shape[-2]):
        own[..., b, :] += state[..., None] * fade
        state = own[..., b, -1]
    return own.reshape(*u.shape[:-1], -1)[..., :n]


def _turned(batch_row: np.ndarray, first: int, rates: np.ndarray) -> np.ndarray:
    """x exp(-iwn) for each tone, n counted from sample 0 of the record; a value that isn't finite counts as 0."""
    at = first + np.arange(len(batch_row))
    return np.where(np.isfinite(batch_row), batch_row, 0.0) * np.exp(-2j * np.pi * ((rates[:, None] * at) % 1.0))


def affine_states(maps: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, chunk, re, im): the state that each chunk gets: arrays, one value a tone.

    maps: (keys, chunk, gain, re, im), state -> gain * state + (re, im), chunks from 0 or after; the first state is 0. Chunks are composed in groups of TOGETHER, these groups in a
    second step, and a third gives each chunk its state.
    """
    kinds = dict(maps.dtypes)
    head = ", ".join(f"`{k}` {kinds[k]}" for k in keys)
    rows = maps.withColumn("_group", F.floor(F.col("chunk") / TOGETHER))
    state = lambda pdf: np.array(pdf.re.tolist()) + 1j * np.array(pdf.im.tolist())

    def compose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("chunk")
        gain, b = 1.0, 0j
        for g, v in zip(pdf.gain, state(pdf)):
            gain, b = gain * g, g * b + v
        return pd.DataFrame([[*key, gain, b.real.tolist(), b.imag.tolist()]])

    def run(order: str, start):
        def states(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
            pdf = pdf.sort_values(order)
            y, out = start(pdf), []
            for at, g, v in zip(pdf[order], pdf.gain, state(pdf)):
                y = np.broadcast_to(y, v.shape)
                out.append([*key[: len(keys)], at, y.real.tolist(), y.imag.tolist()])
                y = g * y + v
            return pd.DataFrame(out)

        return states

    groups = rows.groupBy(*keys, "_group").applyInPandas(compose, f"{head}, _group long, gain double, re array<double>, im array<double>")
    starts = groups.groupBy(*keys).applyInPandas(run("_group", lambda pdf: 0j), f"{head}, _group long, _re array<double>, _im array<double>")
    known = rows.join(starts, [*keys, "_group"])
    from_start = lambda pdf: np.array(pdf._re.iloc[0]) + 1j * np.array(pdf._im.iloc[0])
    return known.groupBy(*keys, "_group").applyInPandas(run("chunk", from_start), f"{head}, chunk long, re array<double>, im array<double>")


def tone_dwells(chunks: DataFrame, rates: list[float], r: float, high: float, low: float, least: int = 1) -> DataFrame:
    """(path, channel, tone, first_sample, last_sample): where the envelope of a tone (number in `rates`, cycles a sample) is on, for at least `least` samples.

    chunks: (path, channel, first_sample, samples), of any sizes, without overlap. Between chunks that don't follow each other the filter begins anew; the trigger is off
    there. A dwell that is still on ends with its last sample. Empty and null chunks count as not there.
    """
    if not 0 < r < 1 or not 0 < low <= high:
        raise ValueError("give 0 < r < 1 and 0 < low <= high")
    w = Window.partitionBy("path", "channel").orderBy("first_sample")
    rows = chunks.where(F.size("samples") > 0).select("path", "channel", "first_sample", F.transform("samples", lambda v: v.cast("double")).alias("samples"))
    # numbers chunks and marks gaps by their places alone; samples stay where they are
    places = rows.select("path", "channel", "first_sample", F.size("samples").alias("n"))
    places = places.withColumn("chunk", (F.row_number().over(w) - 1).cast("long")).withColumn("follows", F.coalesce(F.lag(F.col("first_sample") + F.col("n")).over(w) == F.col("first_sample"), F.lit(False)))
    tones = np.array(rates)
    kinds = dict(chunks.dtypes)
    head = f"path {kinds['path']}, channel {kinds['channel']}"

    def each(batch: pa.RecordBatch) -> Iterator[tuple[int, int, np.ndarray]]:
        for i, (first, values) in enumerate(zip(batch.column("first_sample").to_pylist(), batch.column("samples"), strict=True)):
            yield i, first, _turned(values.values.to_numpy(zero_copy_only=False).astype(float), first, tones)

    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b = [u @ ((1 - r) * r ** np.arange(u.shape[1] - 1, -1, -1.0)) for _, _, u in each(batch)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array([v.real.tolist() for v in b], pa.list_(pa.float64())), pa.array([v.imag.tolist() for v in b], pa.list_(pa.float64()))], names=["path", "channel", "first_sample", "re", "im"])

    own = rows.mapInArrow(summarise, f"{head}, first_sample long, re array<double>, im array<double>").join(places, ["path", "channel", "first_sample"])
    # what enters a chunk after a gap is nothing: the map before it has no gain and gives nothing on
    after = F.coalesce(F.lead("follows").over(Window.partitionBy("path", "channel").orderBy("chunk")), F.lit(False))
    kept = own.withColumn("_on", after).select("path", "channel", "chunk", F.when(F.col("_on"), F.pow(F.lit(r), F.col("n"))).otherwise(0.0).alias("gain"), *[F.when(F.col("_on"), F.col(c)).otherwise(F.transform(c, lambda v: F.lit(0.0))).alias(c) for c in ("re", "im")])
    states = affine_states(kept, ["path", "channel"]).join(places, ["path", "channel", "chunk"]).select("path", "channel", "first_sample", "follows", "re", "im")
    ready = rows.join(states, ["path", "channel", "first_sample"])

    def cross(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = np.array(batch.column("re").to_pylist()) + 1j * np.array(batch.column("im").to_pylist())
            follows = batch.column("follows").to_pylist()
            owner, out = [], []
            for i, first, u in each(batch):
                size = 2 * np.abs(lowpass(u, r, start[i]))
                for tone, e in enumerate(size):
                    kind = np.where(e >= high, 1, np.where(e < low, -1, 0))
                    at = np.flatnonzero(kind)
                    at = at[np.concatenate(([True], kind[at[1:]] != kind[at[:-1]]))] if len(at) else at
                    # a chunk after a gap begins with the trigger off
                    marks = [(first - 1, -1)] if not follows[i] else []
                    marks += [(first + int(k), int(kind[k])) for k in at]
                    owner += [i] * len(marks)
                    out += [(tone, a, k) for a, k in marks]
            columns = [pa.array([o[j] for o in out], t) for j, t in ((0, pa.int32()), (1, pa.int64()), (2, pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(owner, pa.int64())) for c in ("path", "channel")), *columns], names=["path", "channel", "tone", "at", "kind"])

    marks = ready.mapInArrow(cross, f"{head}, tone int, at long, kind int")
    by = Window.partitionBy("path", "channel", "tone").orderBy("at", F.desc("kind"))
    changes = marks.withColumn("_was", F.coalesce(F.lag("kind").over(by), F.lit(-1))).where("kind <> _was")
    changes = changes.withColumn("_off", F.lead("at").over(by)).where("kind = 1")
    # the end of the stretch of chunks that a dwell lies in
    ends = places.withColumn("_stretch", F.sum((~F.col("follows")).cast("int")).over(w)).groupBy("path", "channel", "_stretch").agg(F.max(F.col("first_sample") + F.col("n") - 1).alias("_end"))
    last = ends.groupBy("path", "channel").agg(F.sort_array(F.collect_list("_end")).alias("_ends"))
    closed = changes.join(last, ["path", "channel"]).withColumn("_end", F.element_at(F.filter("_ends", lambda e: e >= F.col("at")), 1))
    out = closed.select("path", "channel", "tone", F.col("at").alias("first_sample"), F.least(F.coalesce(F.col("_off") - 1, F.col("_end")), F.col("_end")).alias("last_sample"))
    return out.where(F.col("last_sample") - F.col("first_sample") + 1 >= least)


def frame_tops(chunks: DataFrame, frame: int, block: int = 1 << 16) -> DataFrame:
    """(path, start, fs, top, snr_db): for each frame of `frame` samples, every half a frame, its strongest bin under a Hann taper and that bin's power, with two on each side, over the rest.

    Frames begin at multiples of half a frame. A chunk goes to the blocks whose frames it meets: a block is `block` samples and, as a halo, the frame that
    begins at its end. Frames with a missing sample, or one that isn't finite, are left out, and so are those that never change.
    """
    hop = frame // 2
    block = -(-block // hop) * hop
    rows = chunks.where(F.size("samples") > 0).select("path", "first_sample", F.col("fs").cast("double").alias("fs"), F.transform("samples", lambda v: v.cast("double")).alias("samples"))
    low, high = F.floor((F.col("first_sample") - frame + 1) / block), F.floor((F.col("first_sample") + F.size("samples") - 1) / block)
    dealt = rows.withColumn("_block", F.explode(F.sequence(low, high)))
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / frame)

    def tops(key: tuple, table: pa.Table) -> pa.Table:
        start = key[1].as_py() * block
        x = np.full(block + frame - hop, np.nan)
        for first, values in zip(table.column("first_sample").to_pylist(), table.column("samples"), strict=True):
            v = values.values.to_numpy(zero_copy_only=False).astype(float)
            lo, hi = max(0, first - start), min(len(x), first - start + len(v))
            if lo < hi:
                x[lo:hi] = v[lo - first + start : hi - first + start]
        cut = np.lib.stride_tricks.sliding_window_view(x, frame)[::hop]
        sound = np.flatnonzero(np.isfinite(cut).all(axis=1) & (cut != cut[:, :1]).any(axis=1))
        power = np.abs(np.fft.rfft((cut[sound] - cut[sound].mean(axis=1, keepdims=True)) * taper, axis=1)) ** 2
        power[:, :2] = 0
        top, at = power.argmax(axis=1), np.arange(len(sound))
        near = sum(power[at, np.clip(top + d, 0, power.shape[1] - 1)] for d in (-2, -1, 0, 1, 2)) if len(sound) else np.zeros(0)
        snr = 10 * np.log10(np.maximum(near, 1e-300) / np.maximum(power.sum(axis=1) - near, 1e-300))
        fs = table.column("fs")[0].as_py()
        return pa.table({"path": pa.array([key[0].as_py()] * len(sound), pa.string()), "start": pa.array(start + sound * hop, pa.int64()), "fs": pa.array([fs] * len(sound), pa.float64()), "top": pa.array(top.astype(np.int32)), "snr_db": pa.array(snr)})

    return dealt.groupBy("path", "_block").applyInArrow(tops, "path string, start long, fs double, top int, snr_db double")


def top_runs(tops: DataFrame, frame: int, near: float = 0.03, least: int = 3, least_db: float = 10.0) -> DataFrame:
    """(path, step, bin, start, stop, snr_db): runs of frames whose strongest bin stays within a bin, or `near` of it, of the frame before; without the half frame at either end.

    stop is the first sample after the run. Runs of fewer than `least` frames, or with a median SNR below least_db, go. A missing frame ends a run.
    """
    w = Window.partitionBy("path").orderBy("start")
    was = F.lag("top").over(w)
    far = (F.abs(F.col("top") - was) > F.greatest(F.lit(1.0), near * was)) | (F.col("start") - F.lag("start").over(w) > frame // 2)
    runs = tops.withColumn("_run", F.sum(F.coalesce(far, F.lit(False)).cast("int")).over(w))
    held = runs.groupBy("path", "_run").agg((F.min("start") + frame // 2).alias("start"), (F.max("start") + frame // 2).alias("stop"), F.percentile("top", 0.5).alias("bin"), F.percentile("snr_db", 0.5).alias("snr_db"), F.count(F.lit(1)).alias("_n"))
    kept = held.where((F.col("_n") >= least) & (F.col("snr_db") >= least_db) & (F.col("stop") > F.col("start")))
    return kept.withColumn("step", (F.row_number().over(Window.partitionBy("path").orderBy("start")) - 1).cast("int")).select("path", "step", "bin", "start", "stop", "snr_db")
