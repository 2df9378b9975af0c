"""Lags of cards that were started apart: correlations over chunks with halos, and lags of all cards from those of pairs.

Chunks are (card, first_sample, samples). The record is cut into blocks of `block` samples on all cards' own sample numbers. A chunk goes to its own block and, as a halo, to
the blocks that lie within `max_lag` of it, so a block meets its neighbours' edges and never a channel; lags may be longer than a chunk. Each block
gives, a pair of cards, the products at all lags (by one transform a card); these add up in tasks, then in groups of bounded size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: How many partial arrays of a key meet in one group, and how many bytes of arrays a task adds up before it hands them on.
FAN_IN, HELD_BYTES = 64, 64 << 20


def array_sums(rows: DataFrame, keys: list[str], column: str) -> DataFrame:
    """(keys, column): arrays of doubles added up element by element, those of a key of equal length.

    Tasks add up what they hold, a key's sums of tasks meet by FAN_IN of task numbers, and these at last: no group holds more than FAN_IN arrays, or tasks / FAN_IN.
    """
    schema = ", ".join([*(f"`{k}` {dict(rows.dtypes)[k]}" for k in keys), f"`{column}` array<double>"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple, np.ndarray] = {}
        size, part = 0, TaskContext.get().partitionId()
        for batch in batches:
            named = [batch.column(k).to_pylist() for k in keys]
            for key, values in zip(zip(*named, strict=True), batch.column(column), strict=True):
                v = values.values.to_numpy(zero_copy_only=False)
                if key in sums:
                    sums[key] = sums[key] + v
                else:
                    sums[key] = v
                    size += v.nbytes
            if size > HELD_BYTES:
                yield from out(sums, part)
                sums, size = {}, 0
        yield from out(sums, part)

    arrow = {name: field.type for name, field in ((f.name, f) for f in _arrow_schema(rows, keys))}

    def out(sums, part):
        for key, v in sums.items():
            columns = [pa.array([x], arrow[k]) for k, x in zip(keys, key, strict=True)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([v.tolist()], pa.list_(pa.float64())), pa.array([part], pa.int32())], names=[*keys, column, "_part"])

    def total(table: pa.Table) -> pa.Table:
        v = np.sum([x.values.to_numpy(zero_copy_only=False) for x in table.column(column)], axis=0)
        head = table.slice(0, 1).select([*keys])
        return head.append_column(column, pa.array([v.tolist()], pa.list_(pa.float64())))

    partial = rows.select(*keys, column).mapInArrow(add, f"{schema}, _part int").withColumn("_g", F.floor(F.col("_part") / FAN_IN))
    return partial.groupBy(*keys, "_g").applyInArrow(total, schema).groupBy(*keys).applyInArrow(total, schema)


def _arrow_schema(rows: DataFrame, keys: list[str]) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(rows.select(*keys).schema)


def correlate(x: np.ndarray, y: np.ndarray, max_lag: int, fs: float = 1.0, band: tuple[float, float] | None = None) -> np.ndarray:
    """Sums of x[n] * y[n + lag] for lags -max_lag .. max_lag; y begins max_lag samples before x and ends as many after it."""
    n = 1 << (len(y) + len(x) - 1).bit_length()
    a, b = np.fft.rfft(x, n), np.fft.rfft(y, n)
    cross = np.conj(a) * b
    if band is not None:
        f = np.fft.rfftfreq(n, 1 / fs)
        cross = cross * ((f >= band[0]) & (f <= band[1]))
    return np.fft.irfft(cross, n)[: 2 * max_lag + 1]


def pair_correlations(chunks: DataFrame, max_lag: int, block: int = 1 << 18, keys: list[str] | None = None, fs: float = 1.0, band: tuple[float, float] | None = None, centre: bool = True) -> DataFrame:
    """(keys, a, b, products, energy_a, energy_b): for each pair of cards a < b the products at lags -max_lag .. max_lag, and both energies.

    keys: of a recording; its cards meet. centre: the mean of each block's own samples is taken out. Samples that are missing, null or not finite count 0; samples that
    come twice count once.
    """
    keys = keys or []
    rows = chunks.where(F.size("samples") > 0).select(*keys, "card", "first_sample", F.transform("samples", lambda v: v.cast("double")).alias("samples"))
    low = F.floor((F.col("first_sample") - max_lag) / block)
    high = F.floor((F.col("first_sample") + F.size("samples") - 1 + max_lag) / block)
    dealt = rows.withColumn("_block", F.explode(F.sequence(low, high)))
    kinds = dict(chunks.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "a string", "b string", "products array<double>"])

    def products(key: tuple, table: pa.Table) -> pa.Table:
        start = key[-1].as_py() * block - max_lag
        cards: dict[str, np.ndarray] = {}
        for card, first, values in zip(table.column("card").to_pylist(), table.column("first_sample").to_pylist(), table.column("samples"), strict=True):
            x = cards.setdefault(card, np.full(block + 2 * max_lag, np.nan))
            v = values.values.to_numpy(zero_copy_only=False).astype(float)
            at = first - start
            lo, hi = max(0, at), min(len(x), at + len(v))
            if lo < hi:
                x[lo:hi] = v[lo - at : hi - at]
        own = slice(max_lag, max_lag + block)
        held = {}
        for card, x in cards.items():
            x[~np.isfinite(x)] = np.nan
            middle = np.nanmean(x[own]) if centre and np.isfinite(x[own]).any() else 0.0
            held[card] = np.nan_to_num(x - middle)
        out = []
        for a, b in combinations(sorted(held), 2):
            x, y = held[a][own], held[b]
            if x.any() or y[own].any():
                energy = [float(x @ x), float(y[own] @ y[own])] if band is None else [float(correlate(v, np.pad(v, (0, 0)), 0, fs, band)[0]) for v in (x, y[own])]
                out.append((a, b, [*correlate(x, y, max_lag, fs, band).tolist(), *energy]))
        columns = [pa.array([k.as_py()] * len(out), k.type) for k in key[:-1]]
        columns += [pa.array([o[0] for o in out], pa.string()), pa.array([o[1] for o in out], pa.string()), pa.array([o[2] for o in out], pa.list_(pa.float64()))]
        return pa.table(columns, names=[*keys, "a", "b", "products"])

    each = dealt.groupBy(*keys, "_block").applyInArrow(products, schema)
    sums = array_sums(each, [*keys, "a", "b"], "products")
    n = 2 * max_lag + 1
    return sums.select(*keys, "a", "b", F.slice("products", 1, n).alias("products"), F.element_at("products", n + 1).alias("energy_a"), F.element_at("products", n + 2).alias("energy_b"))


def pair_lags(correlations: DataFrame, max_lag: int, guard: int) -> DataFrame:
    """(…, lag, correlation, prominence): by how many samples b's record runs behind a's, from the largest product in size.

    Of equal products the least lag counts. prominence: the peak over the median size of the products beyond `guard` samples from it. Null without energy on both cards.
    """
    sizes = F.transform("products", lambda v: F.abs(v))
    found = correlations.where((F.col("energy_a") > 0) & (F.col("energy_b") > 0)).withColumn("_s", sizes).withColumn("_k", F.array_position("_s", F.array_max("_s")).cast("int") - 1)
    away = F.array_sort(F.filter("_s", lambda v, i: F.abs(i - F.col("_k")) > guard))
    found = found.withColumn("_away", away).withColumn("_n", F.size("_away"))
    middle = (F.element_at("_away", F.floor((F.col("_n") + 1) / 2).cast("int")) + F.element_at("_away", F.floor(F.col("_n") / 2).cast("int") + 1)) / 2
    kept = [c for c in correlations.columns if c not in ("products", "energy_a", "energy_b")]
    peak = F.element_at("products", F.col("_k") + 1)
    return found.select(
        *kept,
        (F.col("_k") - max_lag).cast("long").alias("lag"),
        (peak / F.sqrt(F.col("energy_a") * F.col("energy_b"))).alias("correlation"),
        F.when((F.col("_n") > 0) & (middle > 0), F.abs(peak) / middle).alias("prominence"),
    )


def closures(pairs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The pairs with `closure`: the median size of lag(a, b) + lag(b, c) - lag(a, c) over all third cards c; null without one.

    Cards meet by joins on the pair's ends, cards^3 rows a recording.
    """
    keys = keys or []
    both = pairs.select(*keys, F.col("a").alias("p"), F.col("b").alias("q"), "lag").unionByName(pairs.select(*keys, F.col("b").alias("p"), F.col("a").alias("q"), (-F.col("lag")).alias("lag")))
    first = both.select(*keys, F.col("p").alias("b"), F.col("q").alias("c"), F.col("lag").alias("_bc"))
    second = both.select(*keys, F.col("p").alias("a"), F.col("q").alias("c"), F.col("lag").alias("_ac"))
    met = pairs.select(*keys, "a", "b", "lag").join(first, [*keys, "b"]).join(second, [*keys, "a", "c"])
    off = met.groupBy(*keys, "a", "b").agg(F.median(F.abs(F.col("lag") + F.col("_bc") - F.col("_ac"))).alias("closure"))
    return pairs.join(off, [*keys, "a", "b"], "left")


def solve_lags(a: np.ndarray, b: np.ndarray, lag: np.ndarray, weight: np.ndarray, tolerance: float, rounds: int = 20) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Cards, their lags behind the first and their residuals, from the lags of pairs by least squares; residuals beyond the tolerance lose weight round by round."""
    cards = sorted({*a, *b})
    at = {c: i for i, c in enumerate(cards)}
    i, j = np.array([at[c] for c in a]), np.array([at[c] for c in b])
    design = np.zeros((len(lag), len(cards)))
    design[np.arange(len(lag)), j] += 1
    design[np.arange(len(lag)), i] -= 1
    w, t = weight.astype(float), np.zeros(len(cards))
    for _ in range(rounds):
        root = np.sqrt(w)[:, None]
        t[1:] = np.linalg.lstsq(design[:, 1:] * root, lag * root[:, 0], rcond=None)[0]
        off = np.abs(lag - design @ t)
        w = weight / (1 + (off / tolerance) ** 2)
    each = np.array([np.median(off[(i == k) | (j == k)]) for k in range(len(cards))])
    return cards, t, each


def card_lags(pairs: DataFrame, tolerance: float, least: float = 0.5, keys: list[str] | None = None) -> DataFrame:
    """(keys, card, lag, residual, n_pairs, agrees): the lag of each card behind the first by name, from closures(pair_lags()).

    Pairs with a correlation below `least` in size are no claim. The weight of a pair is its squared correlation over 1 + (closure / tolerance)^2. A card that misses the others by more than
    the tolerance, by the median over its pairs, disagrees: the lags are then solved without the worst such card, again and again, and it keeps a null lag. A group is the pairs of one recording's cards.
    """
    keys = keys or []
    kinds = dict(pairs.dtypes)
    schema = ", ".join([*(f"`{k}` {kinds[k]}" for k in keys), "card string, lag double, residual double, n_pairs long, agrees boolean"])

    def solve(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["a", "b"])
        out, refused = [], []
        while len(pdf):
            weight = pdf.correlation.to_numpy() ** 2 / (1 + (pdf.closure.fillna(0).to_numpy() / tolerance) ** 2)
            cards, lag, residual = solve_lags(pdf.a.to_numpy(), pdf.b.to_numpy(), pdf.lag.to_numpy(float), weight, tolerance)
            n = [int(((pdf.a == c) | (pdf.b == c)).sum()) for c in cards]
            worst = int(np.argmax(residual))
            if residual[worst] <= tolerance or len(cards) < 3:
                out = [(*key[: len(keys)], c, float(t), float(r), m, bool(r <= tolerance)) for c, t, r, m in zip(cards, lag, residual, n, strict=True)]
                break
            refused.append((*key[: len(keys)], cards[worst], None, float(residual[worst]), n[worst], False))
            pdf = pdf[(pdf.a != cards[worst]) & (pdf.b != cards[worst])]
        return pd.DataFrame([*out, *refused], columns=[*keys, "card", "lag", "residual", "n_pairs", "agrees"])

    claims = pairs.where(F.abs("correlation") >= least)
    if not keys:
        return claims.withColumn("_all", F.lit(0)).groupBy("_all").applyInPandas(solve, schema)
    return claims.groupBy(*keys).applyInPandas(solve, schema)
