"""Clocks of cards by a closed loop: resample by what is known, measure what is left, correct, at most a few rounds.

A card's record shows at its own time t what the reference shows at t - (offset + rate * t). Each round lays the card's record onto the reference's sample places by an interpolation kernel, block by
block: a block takes the reference's samples of its own and, of the card, those that its places fall on with a halo of the kernel's half width. What delay is left in a block comes
from its cross-spectrum (from the peak of the correlation as long as that is far off), and a weighted line through the blocks of a card corrects offset and rate. The loop ends where both are
the same record, so leakage and the kernel's own errors cancel. A task holds one block of one card; a few sums a card reach the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Half width of the kernel in samples, its shape, and the places between two samples for which it is tabled (with straight lines between them).
HALF, SHAPE, PLACES = 32, 10.0, 4096


def _table() -> np.ndarray:
    at = np.arange(PLACES + 1)[:, None] / PLACES
    x = np.arange(-HALF + 1, HALF + 1) - at
    taper = np.i0(SHAPE * np.sqrt(np.clip(1 - (x / HALF) ** 2, 0, 1))) / np.i0(SHAPE)
    kernel = np.sinc(x) * taper
    return kernel / kernel.sum(axis=1, keepdims=True)


_KERNEL: list[np.ndarray] = []


def resampled(x: np.ndarray, at: np.ndarray) -> np.ndarray:
    """x at places between its samples; nan where the kernel reaches beyond x, or over a missing sample."""
    if not _KERNEL:
        _KERNEL.append(_table())
    whole = np.floor(at).astype(np.int64)
    place = (at - whole) * PLACES
    row = np.minimum(place.astype(np.int64), PLACES - 1)
    share = (place - row)[:, None]
    taps = whole[:, None] + np.arange(-HALF + 1, HALF + 1)
    inside = (taps[:, 0] >= 0) & (taps[:, -1] < len(x))
    out = np.full(len(at), np.nan)
    for first in range(0, len(at), 1 << 14):
        part = np.flatnonzero(inside[first : first + (1 << 14)]) + first
        kernel = _KERNEL[0][row[part]] * (1 - share[part]) + _KERNEL[0][row[part] + 1] * share[part]
        out[part] = np.einsum("ij,ij->i", x[taps[part]], kernel)
    return out


def left_delay(ref: np.ndarray, x: np.ndarray, fs: float, band: tuple[float, float], search: int, frame: int) -> tuple[float, float, float]:
    """(seconds by which x runs behind ref, weight, coherence) of two records of the same places; coherence: cross power over the geometric mean of both powers, in the band."""
    n = 1 << (len(ref) + search).bit_length()
    f = np.fft.rfftfreq(n, 1 / fs)
    use = (f >= band[0]) & (f <= band[1])
    c = np.fft.irfft(np.where(use, np.conj(np.fft.rfft(ref - ref.mean(), n)) * np.fft.rfft(x - x.mean(), n), 0), n)
    near = np.concatenate((c[-search:], c[: search + 1]))
    k = int(np.argmax(near))
    bend = near[k - 1] - 2 * near[k] + near[k + 1] if 0 < k < 2 * search else 0.0
    coarse = k - search + (0.5 * (near[k - 1] - near[k + 1]) / bend if bend else 0.0)
    taper = 0.5 - 0.5 * np.cos(2 * np.pi * np.arange(frame) / frame)
    cut = lambda v: np.fft.rfft((w := np.lib.stride_tricks.sliding_window_view(v, frame)[:: frame // 2]) * taper - taper * w.mean(axis=1, keepdims=True), axis=1)
    a, b = cut(ref), cut(x)
    f = np.fft.rfftfreq(frame, 1 / fs)
    use = (f >= band[0]) & (f <= band[1])
    cross = (np.conj(a) * b).sum(axis=0)[use]
    both = np.sqrt((np.abs(a) ** 2).sum(axis=0)[use] * (np.abs(b) ** 2).sum(axis=0)[use])
    size, f = np.abs(cross), f[use]
    coherence = float(size.sum() / both.sum()) if both.sum() > 0 else 0.0
    weight = float((size * f * f).sum())
    if abs(coarse) > 0.4 or not weight:
        return coarse / fs, weight, coherence
    return float(-(size * f * np.angle(cross)).sum() / (2 * np.pi * weight)), weight, coherence


def _dealt(chunks: DataFrame, clocks: DataFrame, block: int) -> DataFrame:
    """The chunks with the blocks (of the reference's places) that their samples, and the kernel's reach, fall on."""
    known = chunks.where(F.size("samples") > 0).join(F.broadcast(clocks), "card")
    place = lambda m: m * (1 - F.col("rate")) - F.col("offset")
    low = F.floor((place(F.col("first_sample")) - HALF - 1) / block)
    high = F.floor((place(F.col("first_sample") + F.size("samples") - 1) + HALF + 1) / block)
    return known.withColumn("_block", F.explode(F.sequence(low, high)))


def _laid(start: int, length: int, rows: list[tuple[int, np.ndarray]]) -> np.ndarray:
    out = np.full(length, np.nan)
    for first, v in rows:
        lo, hi = max(0, first - start), min(length, first - start + len(v))
        if lo < hi:
            out[lo:hi] = v[lo - first + start : hi - first + start]
    return out


def _values(column: pa.ChunkedArray) -> list[np.ndarray]:
    return [v.values.to_numpy(zero_copy_only=False).astype(float) for v in column]


def _places(start: int, block: int, offset: float, rate: float) -> tuple[int, np.ndarray]:
    """Where the block's places fall in the card's own record: the first sample that is needed, and the places from there."""
    at = (start + np.arange(block) + offset) / (1 - rate)
    first = int(np.floor(at[0])) - HALF
    return first, at - first


def block_delays(chunks: DataFrame, reference: str, clock: dict[str, tuple[float, float]], fs: float, band: tuple[float, float], block: int, search: int, frame: int) -> DataFrame:
    """(card, block, centre, delay, weight, coherence): the delay of each card that is left in each block, in seconds. clock: offset and rate of each card, in samples."""
    clocks = chunks.sparkSession.createDataFrame([(c, o, r) for c, (o, r) in clock.items()], "card string, offset double, rate double")
    rows = chunks.select("card", "first_sample", F.transform("samples", lambda v: v.cast("double")).alias("samples"))
    own = _dealt(rows.where(F.col("card") != reference), clocks, block).select("card", "_block", "offset", "rate", "first_sample", "samples", F.lit(False).alias("_ref"))
    ref = rows.where((F.col("card") == reference) & (F.size("samples") > 0)).select("first_sample", "samples")
    ref = ref.withColumn("_block", F.explode(F.sequence(F.floor(F.col("first_sample") / block), F.floor((F.col("first_sample") + F.size("samples") - 1) / block))))
    # each card gets a copy of the reference's block, as it measures against it in a task of its own
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("card"), F.lit(o).alias("offset"), F.lit(r).alias("rate")) for c, (o, r) in clock.items()]))
    ref = ref.withColumn("_c", each).select("_c.card", "_block", "_c.offset", "_c.rate", "first_sample", "samples", F.lit(True).alias("_ref"))

    def measure(key: tuple, table: pa.Table) -> pa.Table:
        start = key[1].as_py() * block
        kind, first, values = table.column("_ref").to_pylist(), table.column("first_sample").to_pylist(), _values(table.column("samples"))
        of = lambda r: [(a, v) for k, a, v in zip(kind, first, values, strict=True) if k is r]
        begin, at = _places(start, block, table.column("offset")[0].as_py(), table.column("rate")[0].as_py())
        x = resampled(_laid(begin, int(np.ceil(at[-1])) + HALF + 1, of(False)), at)
        y = _laid(start, block, of(True))
        known = np.isfinite(x) & np.isfinite(y)
        edges = np.flatnonzero(np.diff(np.concatenate(([0], known, [0]))))
        names = ["card", "block", "centre", "delay", "weight", "coherence"]
        rows = []
        if len(edges):
            # the longest stretch that both have
            a, b = max(zip(edges[::2], edges[1::2], strict=True), key=lambda s: s[1] - s[0])
            if b - a >= 2 * frame:
                rows = [(key[0].as_py(), key[1].as_py(), (start + (a + b) / 2) / fs, *left_delay(y[a:b], x[a:b], fs, band, search, frame))]
        return pa.Table.from_pylist([dict(zip(names, r, strict=True)) for r in rows], pa.schema([("card", pa.string()), ("block", pa.int64()), *((c, pa.float64()) for c in names[2:])]))

    return own.unionByName(ref).groupBy("card", "_block").applyInArrow(measure, "card string, block long, centre double, delay double, weight double, coherence double")


def card_clocks(chunks: DataFrame, reference: str, fs: float, band: tuple[float, float], start: dict[str, float] | None = None, block: int = 1 << 15, search: int = 64, frame: int = 4096, rounds: int = 3, done_s: float = 5e-9, least: float = 0.5) -> DataFrame:
    """(card, offset_s, rate_ppm, offset_error_s, coherence, n_blocks, rounds, ok): each card's clock against the reference's.

    chunks: (card, first_sample, samples) of the channel that all cards share, each card on its own sample numbers. start: offsets in samples to begin with, as
    lags.card_lags() gives them; without one, a card may be off by `search` samples. ok: the blocks cohere by `least` on average; else the clock is null, as no common signal is no delay.
    Blocks without two frames of common samples don't count. The loop ends early where every correction is below done_s over the whole record.
    """
    spark = chunks.sparkSession
    names = [r.card for r in chunks.where(F.col("card") != reference).select("card").distinct().collect()]
    clock = {c: (float((start or {}).get(c, 0.0)), 0.0) for c in names}
    found: dict[str, dict] = {}
    for k in range(1, rounds + 1):
        if not clock:
            break
        each = block_delays(chunks, reference, clock, fs, band, block, search, frame).withColumn("w", F.col("weight") * F.col("coherence") * F.col("coherence"))
        w, t, d = F.col("w"), F.col("centre"), F.col("delay")
        sums = each.groupBy("card").agg(F.sum(w).alias("w"), F.sum(w * t).alias("wt"), F.sum(w * d).alias("wd"), F.sum(w * t * t).alias("wtt"), F.sum(w * t * d).alias("wtd"), F.sum(w * d * d).alias("wdd"), F.avg("coherence").alias("coherence"), F.count(F.lit(1)).alias("n"), F.max("centre").alias("last"))
        largest = 0.0
        for s in sums.collect():
            if not s.w:
                continue
            mean_t, mean_d = s.wt / s.w, s.wd / s.w
            spread = s.wtt / s.w - mean_t**2
            slope = (s.wtd / s.w - mean_t * mean_d) / spread if s.n > 1 and spread > 0 else 0.0
            at_0 = mean_d - slope * mean_t
            rest = max(0.0, s.wdd / s.w - mean_d**2 - slope**2 * spread)
            offset, rate = clock[s.card]
            # what is left is a delay against the reference's time of a record that is already laid onto it
            clock[s.card] = (offset + at_0 * fs / (1 - rate), rate + slope * (1 - rate))
            found[s.card] = {"coherence": s.coherence, "n": s.n, "error": float(np.sqrt(rest / max(1, s.n - 2))), "rounds": k}
            if s.coherence >= least:
                largest = max(largest, abs(at_0), abs(at_0 + slope * s.last))
        if largest < done_s:
            break
    rows = []
    for c in names:
        f = found.get(c, {"coherence": 0.0, "n": 0, "error": None, "rounds": rounds})
        ok = f["n"] > 0 and f["coherence"] >= least
        rows.append((c, clock[c][0] / fs if ok else None, clock[c][1] * 1e6 if ok else None, f["error"] if ok else None, float(f["coherence"]), int(f["n"]), int(f["rounds"]), bool(ok)))
    return spark.createDataFrame(rows, "card string, offset_s double, rate_ppm double, offset_error_s double, coherence double, n_blocks long, rounds int, ok boolean")


def aligned(chunks: DataFrame, clocks: DataFrame, fs: float, block: int = 1 << 15, keys: list[str] | None = None) -> DataFrame:
    """(card, keys, first_sample, samples): every channel's record on the reference's sample places, in blocks; nan where a card has no samples.

    clocks: card_clocks() or rows (card, offset_s, rate_ppm); cards without a clock stay out, the reference goes along with an offset and a rate of 0. keys: of a channel within its card.
    """
    keys = keys or []
    now = clocks.where(F.col("offset_s").isNotNull()).select("card", (F.col("offset_s") * fs).alias("offset"), (F.col("rate_ppm") * 1e-6).alias("rate"))
    rows = chunks.select("card", *keys, "first_sample", F.transform("samples", lambda v: v.cast("double")).alias("samples"))
    kinds = dict(chunks.dtypes)

    def lay(key: tuple, table: pa.Table) -> pa.Table:
        start = key[-1].as_py() * block
        begin, at = _places(start, block, table.column("offset")[0].as_py(), table.column("rate")[0].as_py())
        x = resampled(_laid(begin, int(np.ceil(at[-1])) + HALF + 1, list(zip(table.column("first_sample").to_pylist(), _values(table.column("samples")), strict=True))), at)
        if not np.isfinite(x).any():
            x = x[:0]
        columns = [pa.array([k.as_py()], k.type) for k in key[:-1]]
        out = pa.table([*columns, pa.array([start], pa.int64()), pa.array([x.tolist()], pa.list_(pa.float64()))], names=["card", *keys, "first_sample", "samples"])
        return out.slice(0, min(1, len(x)))

    schema = ", ".join([f"card {kinds['card']}", *(f"`{k}` {kinds[k]}" for k in keys), "first_sample long, samples array<double>"])
    return _dealt(rows, now, block).groupBy("card", *keys, "_block").applyInArrow(lay, schema)
