"""Entries of a log found again in a recording: sliding lock-in power, and the best assignment in order.

The lock-in size of a tone over the window of W samples from n is twice the mean of x exp(-iwt) over it: a difference of two prefix sums of the turned samples. Blocks take
their samples and a halo of the window and the neighbourhood of a peak, so peaks are the same for any chunks or blocks, and a task holds a block.

A log's entries, each of one tone, happened in their order, so they go to peaks of their tones at rising places: of all such assignments the one with the largest sum of scores is found by
dynamic programming over entries and peaks, one recording's few hundred of each in a group.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sliding_max(v: np.ndarray, reach: int) -> np.ndarray:
    """The largest value within `reach` places on either side, along the last axis: from running maxima in blocks of the neighbourhood's length, forward and backward."""
    width = 2 * reach + 1
    n = v.shape[-1]
    padded = np.full((*v.shape[:-1], -(-(n + 2 * reach) // width) * width), -np.inf)
    padded[..., reach : reach + n] = v
    blocks = padded.reshape(*v.shape[:-1], -1, width)
    forward = np.maximum.accumulate(blocks, axis=-1).reshape(padded.shape)
    backward = np.maximum.accumulate(blocks[..., ::-1], axis=-1)[..., ::-1].reshape(padded.shape)
    return np.maximum(backward[..., :n], forward[..., 2 * reach : 2 * reach + n])


def lock_in(x: np.ndarray, first: int, rates: np.ndarray, window: int) -> np.ndarray:
    """Tones x places: the lock-in size over the window from each place; nan where a sample is missing. first: the number of x[0] in the recording."""
    known = np.isfinite(x)
    at = first + np.arange(len(x))
    turned = np.where(known, x, 0.0) * np.exp(-2j * np.pi * ((rates[:, None] * at) % 1.0))
    prefix = np.concatenate((np.zeros((len(rates), 1)), np.cumsum(turned, axis=1)), axis=1)
    full = np.convolve(known, np.ones(window), "valid") > window - 0.5
    return np.where(full, 2 / window * np.abs(prefix[:, window:] - prefix[:, :-window]), np.nan)


def lock_in_peaks(chunks: DataFrame, rates: list[float], window: int, least: float, block: int = 1 << 16) -> DataFrame:
    """(path, channel, tone, at, size, dominance): places where a tone's lock-in size over the window from there is the largest within half a window, and at least `least`.

    rates: cycles a sample of each tone, numbered from 0. Of equal sizes within half a window the first place counts. dominance: the size over the largest of the other tones' within half a window; null
    with one tone. chunks: (path, channel, first_sample, samples). Windows with a missing sample don't count.
    """
    reach = window // 2
    rows = chunks.where(F.size("samples") > 0).select("path", "channel", "first_sample", F.transform("samples", lambda v: v.cast("double")).alias("samples"))
    low = F.floor((F.col("first_sample") - window - reach + 1) / block)
    high = F.floor((F.col("first_sample") + F.size("samples") - 1 + reach) / block)
    dealt = rows.withColumn("_block", F.explode(F.sequence(low, high)))
    tones = np.array(rates)
    kinds = dict(chunks.dtypes)

    def peaks(key: tuple, table: pa.Table) -> pa.Table:
        start = key[2].as_py() * block - reach
        x = np.full(block + 2 * reach + window - 1, np.nan)
        for first, values in zip(table.column("first_sample").to_pylist(), table.column("samples"), strict=True):
            v = values.values.to_numpy(zero_copy_only=False).astype(float)
            lo, hi = max(0, first - start), min(len(x), first - start + len(v))
            if lo < hi:
                x[lo:hi] = v[lo - first + start : hi - first + start]
        size = np.nan_to_num(lock_in(x, start, tones, window), nan=-np.inf)
        top = sliding_max(size, reach)
        own = slice(reach, reach + block)
        out = []
        for k in range(len(tones)):
            rest = np.delete(top, k, axis=0).max(axis=0) if len(tones) > 1 else None
            for n in np.flatnonzero((size[k, own] >= least) & (size[k, own] == top[k, own])) + reach:
                if size[k, n - reach : n].max(initial=-np.inf) < size[k, n]:
                    out.append((k, start + int(n), float(size[k, n]), float(size[k, n] / rest[n]) if rest is not None and rest[n] > 0 else None))
        columns = [pa.array([key[i].as_py()] * len(out), key[i].type) for i in (0, 1)]
        return pa.table([*columns, *(pa.array([o[i] for o in out], t) for i, t in enumerate((pa.int32(), pa.int64(), pa.float64(), pa.float64())))], names=["path", "channel", "tone", "at", "size", "dominance"])

    return dealt.groupBy("path", "channel", "_block").applyInArrow(peaks, f"path {kinds['path']}, channel {kinds['channel']}, tone int, at long, size double, dominance double")


def assigned(scores: list[np.ndarray], places: np.ndarray, gaps: list[float]) -> list[int | None]:
    """For each entry the number of its place, rising, or None: the assignment with the largest sum of scores.

    scores: an entry's score at each place, -inf where it can't go; an entry without a place scores 0. places: rising. gaps: how far an entry's place must lie behind that of the entry last assigned,
    the entry's own gap. Of equal sums the one that leaves later entries out counts first.
    """
    n = len(places)
    # best[p]: the largest sum so far if the last place used is among the first p
    best = np.zeros(n + 1)
    chosen = []
    for score, gap in zip(scores, gaps, strict=True):
        # the places far enough before each place, and before it at any rate
        free = np.minimum(np.searchsorted(places, places - gap, "right"), np.arange(n))
        here = score + best[free]
        ahead = np.concatenate(([-np.inf], np.maximum.accumulate(here))) if n else np.array([-np.inf])
        chosen.append((here, free, ahead > best))
        best = np.maximum(best, ahead)
    out: list[int | None] = []
    p = n
    for here, free, takes in reversed(chosen):
        if takes[p]:
            k = int(np.argmax(here[:p]))
            out.append(k)
            p = int(free[k])
        else:
            out.append(None)
    return out[::-1]


def relocated(entries: DataFrame, peaks: DataFrame, spread: float, least_dominance: float = 0.0) -> DataFrame:
    """(path, entry, tone, at, size, score): where each entry of a recording's log is; nulls for entries that are nowhere.

    entries: (path, entry, tone, expected, gap); they happened in the order of `entry`, about at sample `expected` (null: unknown), and at least `gap` samples after the entry before. peaks: (path,
    tone, at, size, dominance) of one channel a recording, or more. An entry scores a peak of its tone with its size over the tone's largest in the recording, less |at - expected| / spread; below 0
    it isn't taken. A group is one recording's entries and peaks.
    """
    kinds = dict(entries.dtypes)
    sound = peaks.where((F.coalesce("dominance", F.lit(float("inf"))) >= least_dominance) & (F.col("size") > 0)).select("path", "tone", "at", "size")

    def place(key: tuple, log: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        log, found = log.sort_values("entry"), found.sort_values(["at", "tone", "size"]).reset_index(drop=True)
        at, size, tone = found["at"].to_numpy(float), found["size"].to_numpy(float), found["tone"].to_numpy()
        top = found.groupby("tone")["size"].max().to_dict()
        scores = []
        for e in log.itertuples(index=False):
            own = np.where(tone == e.tone, size / top.get(e.tone, 1.0), -np.inf)
            if not pd.isna(e.expected):
                own = own - np.abs(at - e.expected) / spread
            scores.append(np.where(own > 0, own, -np.inf))
        to = assigned(scores, at, [0.0 if pd.isna(g) else float(g) for g in log["gap"]])
        rows = [(key[0], e.entry, e.tone, *((None, None, None) if k is None else (int(at[k]), float(size[k]), float(s[k])))) for e, k, s in zip(log.itertuples(index=False), to, scores, strict=True)]
        return pd.DataFrame(rows, columns=["path", "entry", "tone", "at", "size", "score"]).astype({"at": "Int64"})

    schema = f"path {kinds['path']}, entry {kinds['entry']}, tone {kinds['tone']}, at long, size double, score double"
    return entries.select("path", "entry", "tone", "expected", "gap").groupBy("path").cogroup(sound.groupBy("path")).applyInPandas(place, schema)
