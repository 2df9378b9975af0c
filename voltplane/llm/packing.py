"""Best-fit packing of token sequences into bins of several permitted lengths.

Documents are dealt by a hash of their place in the input into groups of about `group_docs`, so rows that share an id and a length are spread too; each group
is packed by itself, so no task sees more than a group, and a group wastes at most a few open bins. A document longer than the largest length
is cut into full pieces of that length and a rest; the other documents stay whole. Within a group, longest piece first (ties by id and place):

* best fit: the piece goes into the open bin that it fits with the least room left, of equal ones the first;
* else a bin is opened. For each permitted length the rest of it is filled, on trial, with the largest pieces left that fit, and the length counts
  with what it would be downsized to: the one of least cost a token is opened, of equal ones the shortest. cost(length) = overhead + length +
  attention * length^2. So the choice follows the sizes that are still to be packed;
* at the end each bin is downsized to the shortest permitted length that holds its contents.

Rows with equal ids and texts are packed one by one. A document without tokens (null or empty) gets a row with a null bin. A very long document is many
pieces, dealt 64 to a group. Other columns of the input don't enter the result, whatever their names.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import in_groups

RESULT = "doc_id long, piece int, start long, n_tokens int, bin_id long, bin_offset int, bin_length int, bin_used int"


def cost(length: int, overhead: float, attention: float) -> float:
    return overhead + length + attention * length * length


class Left:
    """The pieces that are still to be packed, by size; they are taken from the largest down."""

    def __init__(self, sizes: list[int]):
        """sizes: descending."""
        self.falling = [-s for s in dict.fromkeys(sizes)]
        counts = Counter(sizes)
        self.counts = [counts[-s] for s in self.falling]
        self.at = 0

    def take(self) -> None:
        """One piece of the largest size is packed."""
        self.counts[self.at] -= 1
        if not self.counts[self.at]:
            self.at += 1

    def fill(self, room: int) -> int:
        """How many tokens of a room are filled, if the largest piece that fits goes in again and again."""
        filled, at = 0, self.at
        while room and (at := bisect_left(self.falling, -room, at)) < len(self.falling):
            size = -self.falling[at]
            n = min(self.counts[at], room // size)
            filled, room, at = filled + n * size, room - n * size, at + 1
        return filled


def opened(size: int, left: Left, lengths: list[int], overhead: float, attention: float) -> int:
    """The permitted length of least cost a token for a bin that begins with a piece of this size."""

    def token_cost(length: int) -> float:
        content = size + left.fill(length - size)
        return cost(lengths[bisect_left(lengths, content)], overhead, attention) / content

    return min((x for x in lengths if x >= size), key=lambda x: (token_cost(x), x))


def pack_group(sizes: list[int], lengths: list[int], overhead: float, attention: float) -> tuple[list[int], list[int], list[int], list[int]]:
    """For pieces in descending size: the bin and the offset of each; the length and the used tokens of each bin."""
    lengths = sorted(lengths)
    room: list[tuple[int, int]] = []
    used, place, offset = [], [], []
    left = Left(sizes)
    for size in sizes:
        left.take()
        at = bisect_left(room, (size, -1))
        if at < len(room):
            free, b = room.pop(at)
        else:
            b = len(used)
            free = opened(size, left, lengths, overhead, attention)
            used.append(0)
        place.append(b)
        offset.append(used[b])
        used[b] += size
        if free > size:
            insort(room, (free - size, b))
    return place, offset, [lengths[bisect_left(lengths, u)] for u in used], used


def pack_lengths(docs: DataFrame, lengths: tuple[int, ...] = (512, 1024, 2048, 4096), overhead: float = 64, attention: float = 1e-5, group_docs: int = 20_000, id_col: str = "doc_id", tokens_col: str = "n_tokens", n_docs: int | None = None) -> DataFrame:
    """One row a piece: doc_id, piece, start (token in the document), n_tokens, bin_id, bin_offset, bin_length, bin_used.

    n_docs: the number of documents where it is known; else they are counted, which reads them once more.
    """
    if not lengths or min(lengths) < 1:
        raise ValueError("give at least one positive length")
    sized = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(tokens_col), F.lit(0)).cast("long").alias("n"), F.monotonically_increasing_id().alias("place"))
    most, sorted_lengths = max(lengths), sorted(lengths)
    groups = max(1, -(-(docs.select(id_col).count() if n_docs is None else n_docs) // group_docs))
    full = F.transform(F.sequence(F.lit(0), F.greatest(F.ceil(F.col("n") / most), F.lit(1)).cast("int") - 1), lambda p: F.struct(p.cast("int").alias("piece"), (p.cast("long") * most).alias("start")))
    pieces = sized.select("doc_id", "n", "place", F.explode(full).alias("p")).select("doc_id", "n", "place", "p.piece", "p.start", F.least(F.lit(most), F.col("n") - F.col("p.start")).cast("int").alias("n_tokens"))
    # a long document's pieces go to different groups, so that a group stays bounded
    pieces = pieces.withColumn("g", F.pmod(F.xxhash64("place", F.floor(F.col("piece") / 64)), F.lit(groups)).cast("long")).drop("n", "place")

    def pack(table: pa.Table) -> pa.Table:
        size = table.column("n_tokens").to_numpy().astype(np.int64)
        ids = table.column("doc_id").fill_null(-1).to_numpy()
        order = np.lexsort((table.column("start").to_numpy(), ids, -size))
        some = int((size > 0).sum())
        place, offset, capacity, used = pack_group(size[order[:some]].tolist(), sorted_lengths, overhead, attention)
        group = table.column("g")[0].as_py() << 32
        none = [None] * (len(size) - some)
        out = table.select(["doc_id", "piece", "start", "n_tokens"]).take(pa.array(order))
        columns = [[group + b for b in place], offset, [capacity[b] for b in place], [used[b] for b in place]]
        kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32()]
        return pa.table([*out.columns, *(pa.array([*c, *none], k) for c, k in zip(columns, kinds, strict=True))], names=[*out.column_names, "bin_id", "bin_offset", "bin_length", "bin_used"])

    return pieces.groupBy("g").applyInArrow(in_groups(pack), RESULT)


def pack_documents(docs: DataFrame, tokenizer: str, lengths: tuple[int, ...] = (512, 1024, 2048, 4096), text_col: str = "text", id_col: str = "doc_id", **how) -> DataFrame:
    """pack_lengths() of the token counts of the texts."""
    from .token_counts import token_counts

    counted = token_counts(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), tokenizer).select("doc_id", "n_tokens")
    return pack_lengths(counted, lengths, n_docs=docs.select(id_col).count(), **how)
