"""Repeated passages of many words, by a sparse suffix array.

Words are runs of letters and digits as in `decontaminate`, so case and punctuation don't matter. Of a document's suffixes only those are kept
that start at a minimiser: a word whose `gram`-word hash is the least of `n - gram + 1` in a row. Any `n` consecutive words hold one, whatever
the text around them, so two copies of a passage of `n` words keep the same suffix.

1. A map reads each whole text and sends each kept suffix to the shard of its first `gram` words, with the words on both sides as far as
   a passage of `n` words can reach, two bytes a word. Suffixes of a batch that are equal on both sides match each other on the spot if they are of two documents; one
   record goes on, with all places of the smallest document. So a passage in a third of all documents is one record a batch, with the places of the others already settled.
2. A shard groups its suffixes by each of the `n - gram + 1` windows of `n` words that hold the gram, so each window meets all others that are
   equal to it, whatever stands around them. A place gets the words of its windows that a smaller document holds, and of those that only larger ones hold.
3. The matches of a document are put together; what overlaps is one span. Documents are dealt to tasks by hash; a document's spans are bounded by its length.

A passage that is repeated within one document only is no finding. Results name the smallest partner that was met as `other_doc_id`, one for
a whole span. `without_repeats` doesn't cut by spans: it cuts the words of those windows that a smaller document holds. Followed from one smaller
holder to the next, each word that is cut is left in some document; a window is left in its smallest holder, unless it overlaps there
with another window that a still smaller document holds.

Defined results: null and empty texts and texts below `n` words have no findings; rows with the same doc_id count as one document, and so don't
match each other; a null doc_id has no findings; other columns are not returned by `repeated_spans` and stay in `without_repeats`.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, binary_column, free_name, in_groups, in_parts, pack, pieces_for, segment_starts, utf8
from .decontaminate import without_spans
from .perfect_hash import mix
from .shingles import _FACTOR, WordHashes, windows, word_hashes

SHARD_BYTES = 8 << 20
BATCH_DOCS, BATCH_BYTES = 1024, 4 << 20
SUFFIXES, MATCHES = 0, 1
#: A row packs a shard's records of a batch. more: (record, place) of the places of a record's document after the first; pair: (record, next document with its sides).
ROWS = "kind int, shard long, hash binary, doc binary, at binary, sides binary, more binary, pair binary"
NAMES = ["kind", "shard", "hash", "doc", "at", "sides", "more", "pair"]
FOUND = "doc long, first int, end int, other long"
#: A wide number for each two-byte word.
_WORDS = mix(np.arange(1 << 16, dtype=np.uint64), 9)


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (np.minimum or np.maximum) over each width values in a row, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = pick(out[:-step], out[step:])
        have += step
    return out


def minimisers(grams: np.ndarray, width: int) -> np.ndarray:
    """The places whose value is the least of some width values in a row."""
    if len(grams) < width:
        return np.zeros(0, np.int64)
    least = _slide(grams, width, np.minimum)
    edge = np.zeros(width - 1, np.uint64)
    return np.flatnonzero(_slide(np.concatenate((edge, least, edge)), width, np.maximum) == grams)


def _suffixes(text: str | None, n: int, gram: int, hashes: WordHashes):
    """Hash, place and sides (left then right, 2 (n - gram) words) of the kept suffixes of a text."""
    words = word_hashes(utf8(text).translate(ALNUM_TABLE), hashes)
    side = n - gram
    if len(words) < n:
        return None
    grams = windows(words, gram)
    at = minimisers(grams, side + 1)
    short = np.zeros(len(words) + 2 * side, np.uint16)
    short[side : side + len(words)] = (words & np.uint64(0xFFFF)).astype(np.uint16) | np.uint16(1)
    left = short[at[:, None] + np.arange(side)]
    right = short[at[:, None] + np.arange(side + gram, 2 * side + gram)]
    return grams[at], at.astype(np.int32), np.concatenate((left, right), axis=1)


def _as_keys(sides: np.ndarray) -> list[np.ndarray]:
    """Columns to sort rows of two-byte words by, first word first."""
    rows, width = sides.shape
    wide = np.zeros((rows, -(-width // 4) * 4), ">u2")
    wide[:, :width] = sides
    keys = wide.view(">u8").astype(np.uint64)
    return [keys[:, i] for i in range(keys.shape[1])]


def held_elsewhere(hash_: np.ndarray, doc: np.ndarray, following: np.ndarray, sides: np.ndarray, side: int):
    """Per record: (first, last, other) of its windows that a smaller document holds, and of those that only larger ones hold.

    A window is numbered by its words left of the gram; without any, last is -1. other is the smallest document of a window but the record's own.
    following is the next larger document with the same sides, or the record's own document if there is none.
    """
    none = np.iinfo(np.int64).max
    paired = following != doc
    after = np.where(paired, following, none)
    out = [(np.full(len(doc), side + 1, np.int32), np.full(len(doc), -1, np.int32), np.full(len(doc), none)) for _ in range(2)]
    top = np.uint64(pow(int(_FACTOR), side - 1, 1 << 64))
    rolled = np.zeros(len(doc), np.uint64)
    for i in range(side):
        rolled = rolled * _FACTOR + _WORDS[sides[:, i]]
    for start in range(side + 1):
        if start:
            rolled = (rolled - _WORDS[sides[:, start - 1]] * top) * _FACTOR + _WORDS[sides[:, start + side - 1]]
        # 0 is no word
        whole = np.flatnonzero((sides[:, start] != 0) & (sides[:, start + side - 1] != 0))
        if not len(whole):
            continue
        key = mix(rolled[whole] ^ mix(hash_[whole], 7), 11)
        order = np.argsort(key)
        who, key = whole[order], key[order]
        fresh = np.append(True, key[1:] != key[:-1])
        cut, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
        mine = doc[who]
        least = np.minimum.reduceat(mine, cut)[group]
        smallest = mine == least
        shared = np.logical_or.reduceat(~smallest | paired[who], cut)[group]
        second = np.minimum.reduceat(np.where(smallest, after[who], mine), cut)[group]
        for (first, last, other), which, partner in zip(out, (~smallest, smallest & shared), (least, second), strict=True):
            x = who[which]
            first[x], last[x], other[x] = np.minimum(first[x], side - start), np.maximum(last[x], side - start), np.minimum(other[x], partner[which])
    return out


def joined(doc, first, end, other) -> tuple[np.ndarray, ...]:
    """Spans put together where they touch or overlap, with the least partner; those with a smaller and with a larger partner apart."""
    larger = other > doc
    order = np.lexsort((first, larger, doc))
    doc, first, end, other, larger = doc[order], first[order].astype(np.int64), end[order].astype(np.int64), other[order], larger[order]
    return _put_together(doc, first, end, other, (doc[1:] != doc[:-1]) | (larger[1:] != larger[:-1]))


def _put_together(doc, first, end, other, changed) -> tuple[np.ndarray, ...]:
    if not len(doc):
        return doc, first.astype(np.int32), end.astype(np.int32), other
    fresh = np.append(True, changed)
    group = np.cumsum(fresh) - 1
    reach = np.maximum.accumulate((group << 32) | end) & 0xFFFFFFFF
    fresh[1:] |= first[1:] > reach[:-1]
    start = np.flatnonzero(fresh)
    return doc[start], first[start].astype(np.int32), np.maximum.reduceat(end, start).astype(np.int32), np.minimum.reduceat(other, start)


def _encode(n: int, gram: int, shards: int):
    side = n - gram

    def encode() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        hashes = WordHashes()

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            got = [(i, x) for i, t in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True) if i is not None and (x := _suffixes(t.as_py(), n, gram, hashes))]
            if got:
                doc = np.repeat(np.array([i for i, _ in got], np.int64), [len(x[0]) for _, x in got])
                columns = [np.concatenate([x[c] for _, x in got]) for c in range(3)]
                got.clear()
                yield _rows(doc, *columns, side, gram, shards)

        return part

    return in_parts(encode, "text", BATCH_DOCS, BATCH_BYTES)


def _rows(doc, hash_, at, sides, side, gram, shards) -> pa.RecordBatch:
    keys = (*_as_keys(sides)[::-1], hash_)
    order = np.lexsort((at, doc, *keys))
    changed = np.zeros(len(order) - 1, bool)
    for k in keys:
        changed |= k[order][1:] != k[order][:-1]
    start = np.flatnonzero(np.append(True, changed))
    group = np.cumsum(np.append(False, changed))
    low = doc[order][start]
    # equal on both sides, in two documents: the larger ones name the smallest, which goes on
    again = np.flatnonzero(doc[order] != low[group])
    who = order[again]
    reach = (sides[who] != 0).astype(np.int32)
    found = joined(doc[who], at[who] - reach[:, :side].sum(axis=1, dtype=np.int32), at[who] + gram + reach[:, side:].sum(axis=1, dtype=np.int32), low[group[again]])
    following = low.copy()
    following[group[again][::-1]] = doc[who][::-1]
    keep = order[start]
    shard = (mix(hash_[keep], 5) % np.uint64(shards)).astype(np.int64)
    by = np.lexsort((keep, shard))
    keep, shard = keep[by], shard[by]
    cut = np.append(np.flatnonzero(np.append(True, shard[1:] != shard[:-1])), len(shard))
    # the other places of the smallest document of each group, by the record that its first place has become
    record = np.empty(len(by), np.int64)
    record[by] = np.arange(len(by))
    extra = np.flatnonzero((doc[order] == low[group]) & np.append(False, ~changed))
    extra = extra[np.argsort(record[group[extra]], kind="stable")]
    of, place = record[group[extra]], at[order[extra]]
    bounds = np.searchsorted(of, cut)
    following = following[by]
    pairs = np.flatnonzero(following != doc[keep])
    pair_bounds = np.searchsorted(pairs, cut)
    rows = [[] for _ in NAMES]
    for a, b, e, f, g, h in zip(cut[:-1], cut[1:], bounds[:-1], bounds[1:], pair_bounds[:-1], pair_bounds[1:], strict=True):
        mine = keep[a:b]
        more = np.column_stack(((of[e:f] - a).astype(np.int32), place[e:f]))
        pair = np.column_stack((pairs[g:h] - a, following[pairs[g:h]]))
        for column, x in zip(rows, (SUFFIXES, int(shard[a]), pack(hash_[mine]), pack(doc[mine]), pack(at[mine]), pack(sides[mine]), pack(more), pack(pair)), strict=True):
            column.append(x)
    if len(again):
        for column, x in zip(rows, (MATCHES, int(shard[0]), *map(pack, found), b"", b""), strict=True):
            column.append(x)
    return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.int64()), *map(binary_column, rows[2:])], names=NAMES)


def _numbered(table: pa.Table, column: str, dtype) -> tuple[np.ndarray, np.ndarray]:
    """The pairs (record, value) of a column of pairs, with the records numbered over all rows of the table."""
    rows = [np.frombuffer(x, dtype).reshape(-1, 2) for x in table.column(column).to_pylist()]
    first = segment_starts(np.array([len(x) // 8 for x in table.column("hash").to_pylist()], np.int64))
    return np.concatenate([r[:, 0] + f for r, f in zip(rows, first, strict=True)]).astype(np.int64), np.concatenate([r[:, 1] for r in rows])


def _match(n: int, gram: int):
    side = n - gram

    def match(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_numpy()
        join = lambda kind, c, t: np.frombuffer(b"".join(table.column(c).filter(pa.array(kinds == kind)).to_pylist()), t)
        out = [(join(MATCHES, "hash", np.int64), join(MATCHES, "doc", np.int32), join(MATCHES, "at", np.int32), join(MATCHES, "sides", np.int64))]
        hash_, doc, at, sides = join(SUFFIXES, "hash", np.uint64), join(SUFFIXES, "doc", np.int64), join(SUFFIXES, "at", np.int32), join(SUFFIXES, "sides", np.uint16).reshape(-1, 2 * side)
        if len(doc):
            records = table.filter(pa.array(kinds == SUFFIXES))
            of, larger = _numbered(records, "pair", np.int64)
            following = doc.copy()
            following[of] = larger
            of, place = _numbered(records, "more", np.int32)
            of, place = np.concatenate((np.arange(len(at)), of)), np.concatenate((at, place))
            order = np.argsort(hash_)
            fresh = np.append(True, hash_[order][1:] != hash_[order][:-1])
            cut, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
            mine = order[(np.minimum.reduceat(doc[order], cut) != np.maximum.reduceat(following[order], cut))[group]]
            number = np.full(len(doc), -1)
            number[mine] = np.arange(len(mine))
            of, place = number[of], place[number[of] >= 0]
            of = of[of >= 0]
            for first, last, other in held_elsewhere(hash_[mine], doc[mine], following[mine], sides[mine], side):
                has = last[of] >= 0
                x, where = of[has], place[has]
                out.append((doc[mine][x], where - last[x], where - first[x] + n, other[x]))
        return pa.table([pa.array(x) for x in joined(*(np.concatenate([o[i] for o in out]) for i in range(4)))], names=["doc", "first", "end", "other"])

    return in_groups(match)


def _merge(table: pa.Table) -> pa.Table:
    doc, first, end, other = (table.column(c).to_numpy() for c in ("doc", "first", "end", "other"))
    order = np.lexsort((first, doc))
    doc, first, end, other = doc[order], first[order].astype(np.int64), end[order].astype(np.int64), other[order]
    return pa.table([pa.array(x) for x in _put_together(doc, first, end, other, doc[1:] != doc[:-1])], names=["doc", "first", "end", "other"])


def _found(docs: DataFrame, n: int, gram: int, id_col: str, text_col: str) -> tuple[DataFrame, int]:
    """Words of documents that repeat in a smaller document or in larger ones only, not yet put together; and the number of shards."""
    if not 0 < gram < n:
        raise ValueError("gram lies between 0 and n")
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    shards = pieces_for(docs, SHARD_BYTES, 8)
    rows = texts.mapInArrow(_encode(n, gram, shards), ROWS)
    return rows.groupBy("shard").applyInArrow(_match(n, gram), FOUND), shards


def _spans(found: DataFrame, shards: int) -> DataFrame:
    merged = found.withColumn("bucket", F.pmod(F.xxhash64("doc"), F.lit(8 * shards))).groupBy("bucket").applyInArrow(in_groups(_merge), FOUND)
    return merged.select(F.col("doc").alias("doc_id"), F.col("first").alias("first_word"), (F.col("end") - F.col("first")).alias("n_words"), F.col("other").alias("other_doc_id"))


def repeated_spans(docs: DataFrame, n: int = 50, gram: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, first_word, n_words, other_doc_id): a row for each span of a document that repeats in another document."""
    return _spans(*_found(docs, n, gram, id_col, text_col))


def without_repeats(docs: DataFrame, n: int = 50, gram: int = 32, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the words of windows that a document with a smaller id holds too; columns stay as they are."""
    found, shards = _found(docs, n, gram, id_col, text_col)
    spans = _spans(found.where(F.col("other") < F.col("doc")), shards)
    spans_col, key = free_name(docs.columns, "spans"), free_name(docs.columns, "span_key")
    by_doc = spans.groupBy(F.col("doc_id").alias(key)).agg(F.array_sort(F.collect_list(F.array("first_word", F.col("first_word") + F.col("n_words")))).alias(spans_col))
    columns, place = docs.columns, docs.columns.index(text_col)
    out = docs.join(by_doc, docs[id_col] == F.col(key), "left").select(*columns, spans_col)

    def cut() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            spans, kept = batch.column(spans_col).to_pylist(), [batch.column(c) for c in columns]
            if any(spans):
                kept[place] = pa.array(map(without_spans, kept[place].to_pylist(), spans), kept[place].type)
            yield pa.RecordBatch.from_arrays(kept, names=columns)

        return part

    return out.mapInArrow(in_parts(cut, text_col), docs.schema)
