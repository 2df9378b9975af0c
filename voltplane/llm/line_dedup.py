"""Line deduplication: documents probe sharded arrays behind a minimal perfect hash; no line is joined with another.

A line's key is the line without `[\\x20\\x09-\\x0D]` at both ends and with A-Z lower-cased. Keys of at least `least_chars` code points in
at least two documents lose all their lines except in the smallest doc_id that holds them.

1. Documents are dealt to blocks by a hash of id and text, so an id, null or not, that many rows share doesn't fill one block. A block hashes
   its distinct keys to 128 bits and sends each shard one packed row: the key's 64-bit hash, a 32-bit fingerprint, in how many of the block's
   documents it is (1 or 2, more counts as 2) and the smallest of them. However frequent a line is, a block sends it once.
2. A shard builds a minimal perfect hash over its distinct line hashes. Its slots index three arrays: fingerprint, document count, smallest
   document; a key that a block has in two documents, or two blocks in different ones, counts as 2. Then the packed rows of all blocks are looked up in the arrays, and each block gets back the places in its own row of the keys
   that repeat, with their keeper.
3. A block drops the lines. Its documents come from the shuffle of step 1, which Spark reads a second time.

A line hash that belongs to several fingerprints in a shard keeps the further ones in a small side table, so that equal means 96 equal bits.
The number of blocks and shards follows the size of the input; a block sends at most one row a key, however many shards there are.

Defined results: a null or empty text is one empty line, and a null text stays null; rows with the same doc_id count as one document;
a null doc_id counts as one document behind all others; other columns stay, and columns named like the results are replaced.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BLANKS, binary_column, free_name, in_groups, pack, pieces_for, release
from .perfect_hash import PerfectHash

#: A doc_id behind all others, for null.
LAST = np.iinfo(np.int64).max
BLOCK_BYTES, SHARD_BYTES = 2 << 20, 16 << 20
ROUTED = "shard int, block long, hashes binary, prints binary, counts binary, owners binary"


def line_key(line: str) -> bytes:
    return line.strip(BLANKS).encode("utf-8", "surrogatepass").lower()


def _key_digests(text: str | None, least_chars: int) -> list[bytes | None]:
    """A 128-bit hash for each line of the text; None where the key is too short."""
    out: list[bytes | None] = []
    for line in (text or "").split("\n"):
        key = line.strip(BLANKS)
        out.append(xxhash.xxh3_128_digest(key.encode("utf-8", "surrogatepass").lower()) if len(key) >= least_chars else None)
    return out


class BlockLines:
    """The hashed lines of a block's documents, and its distinct keys in an order that depends on the keys alone."""

    def __init__(self, texts: list[str | None], ids: list[int | None], least_chars: int, shards: int):
        digests = [_key_digests(t, least_chars) for t in texts]
        self.n_lines = [len(d) for d in digests]
        flat = [d for doc in digests for d in doc]
        self.keyed = np.array([d is not None for d in flat], bool)
        words = np.frombuffer(b"".join(d for d in flat if d is not None), ">u8").astype(np.uint64).reshape(-1, 2)
        doc = np.repeat(np.array([LAST if i is None else i for i in ids], np.int64), self.n_lines)[self.keyed]
        shard = (words[:, 0] % np.uint64(shards)).astype(np.int32)
        order = np.lexsort((doc, words[:, 1], words[:, 0], shard))
        w, d, s = words[order], doc[order], shard[order]
        first = np.ones(len(order), bool)
        first[1:] = (w[1:] != w[:-1]).any(axis=1)
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(first) - 1
        starts = np.flatnonzero(first)
        self.hash, self.print = w[starts, 0], w[starts, 1].astype(np.uint32)
        self.shard, self.owner = s[starts], d[starts]
        ends = np.append(starts[1:], len(order)) - 1
        self.count = (1 + (d[ends] != d[starts])).astype(np.uint8) if len(starts) else np.zeros(0, np.uint8)

    def bounds(self):
        """(shard, first, end) of the distinct keys of each shard."""
        if not len(self.shard):
            return []
        cut = np.flatnonzero(np.append(True, self.shard[1:] != self.shard[:-1]))
        return [(int(self.shard[a]), int(a), int(b)) for a, b in zip(cut, np.append(cut[1:], len(self.shard)), strict=True)]


class ShardIndex:
    """The arrays of a shard: fingerprint, count and owner at the slot of a line hash."""

    def __init__(self, hashes: np.ndarray, prints: np.ndarray, counts: np.ndarray, owners: np.ndarray):
        order = np.lexsort((prints, hashes))
        h, p = hashes[order], prints[order]
        first = np.ones(len(h), bool)
        first[1:] = (h[1:] != h[:-1]) | (p[1:] != p[:-1])
        starts = np.flatnonzero(first)
        h, p = h[starts], p[starts]
        owner = np.minimum.reduceat(owners[order], starts) if len(starts) else owners[:0]
        # rows of one document may come from several blocks
        total = np.where(np.maximum.reduceat(owners[order], starts) != owner, 2, np.maximum.reduceat(counts[order], starts)).astype(np.uint8) if len(starts) else counts[:0]
        main = np.ones(len(h), bool)
        main[1:] = h[1:] != h[:-1]
        self.perfect = PerfectHash(h[main])
        slot = self.perfect.slots(h[main])
        self.prints, self.counts, self.owners = np.empty(len(slot), np.uint32), np.empty(len(slot), np.uint8), np.empty(len(slot), np.int64)
        self.prints[slot], self.counts[slot], self.owners[slot] = p[main], total[main], owner[main]
        self.more = {(int(a), int(b)): (int(c), int(o)) for a, b, c, o in zip(h[~main], p[~main], total[~main], owner[~main], strict=True)}

    def probe(self, hashes: np.ndarray, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The document count (0: not a key) and the owner for each pair."""
        if not len(self.prints):
            return np.zeros(len(hashes), np.uint8), np.zeros(len(hashes), np.int64)
        slot = self.perfect.slots(hashes)
        at = np.maximum(slot, 0)
        fits = (slot >= 0) & (self.prints[at] == prints)
        count, owner = np.where(fits, self.counts[at], 0).astype(np.uint8), np.where(fits, self.owners[at], 0)
        if self.more:
            for i in np.flatnonzero(~fits):
                count[i], owner[i] = self.more.get((int(hashes[i]), int(prints[i])), (0, 0))
        return count, owner


def _shard_answers(table: pa.Table) -> pa.Table:
    column = lambda name, kind: [np.frombuffer(x, kind) for x in table.column(name).to_pylist()]
    hashes, prints = column("hashes", np.uint64), column("prints", np.uint32)
    index = ShardIndex(np.concatenate(hashes), np.concatenate(prints), np.concatenate(column("counts", np.uint8)), np.concatenate(column("owners", np.int64)))
    places, keepers = [], []
    for h, p in zip(hashes, prints, strict=True):
        count, owner = index.probe(h, p)
        again = np.flatnonzero(count >= 2)
        places.append(pack(again.astype(np.uint32)))
        keepers.append(pack(owner[again]))
    return pa.table([table.column("block"), table.column("shard"), binary_column(places), binary_column(keepers)], names=["block", "shard", "places", "owners"])


def dedup_lines(docs: DataFrame, least_chars: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents with the kept text, n_lines long (before dropping) and n_dropped long."""
    docs = docs.drop("n_lines", "n_dropped")
    columns = docs.columns
    blocks, shards = pieces_for(docs, BLOCK_BYTES), pieces_for(docs, SHARD_BYTES, 4)
    block_col = free_name(columns, "block")
    dealt = docs.withColumn(block_col, F.pmod(F.xxhash64(id_col, text_col), F.lit(blocks)))

    def route(table: pa.Table) -> pa.Table:
        lines = BlockLines(table.column(text_col).to_pylist(), table.column(id_col).to_pylist(), least_chars, shards)
        rows = lines.bounds()
        return pa.table(
            [
                pa.array([s for s, _, _ in rows], pa.int32()),
                pa.array([table.column(block_col)[0].as_py()] * len(rows), pa.int64()),
                *(binary_column([pack(x[a:b]) for _, a, b in rows]) for x in (lines.hash, lines.print, lines.count, lines.owner)),
            ],
            names=["shard", "block", "hashes", "prints", "counts", "owners"],
        )

    def drop(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, ids = table.column(text_col).to_pylist(), table.column(id_col).to_pylist()
        lines = BlockLines(texts, ids, least_chars, shards)
        keeper = np.full(len(lines.hash), -1, np.int64)
        first = {s: a for s, a, _ in lines.bounds()}
        for s, places, owners in zip(*(answers.column(c).to_pylist() for c in ("shard", "places", "owners")), strict=True):
            at = first[s] + np.frombuffer(places, np.uint32).astype(np.int64)
            keeper[at] = np.frombuffer(owners, np.int64)
        repeated = np.zeros(len(lines.hash), bool)
        for s, places in zip(*(answers.column(c).to_pylist() for c in ("shard", "places")), strict=True):
            repeated[first[s] + np.frombuffer(places, np.uint32).astype(np.int64)] = True
        doc = np.repeat(np.array([LAST if i is None else i for i in ids], np.int64), lines.n_lines)
        gone = np.zeros(len(doc), bool)
        gone[lines.keyed] = repeated[lines.group] & (keeper[lines.group] != doc[lines.keyed])
        kept, dropped, at = [], [], 0
        for text, n in zip(texts, lines.n_lines, strict=True):
            out = gone[at : at + n]
            at += n
            dropped.append(int(out.sum()))
            kept.append("\n".join(x for x, g in zip((text or "").split("\n"), out, strict=True) if not g) if dropped[-1] else text)
        out = {c: table.column(c) for c in columns} | {text_col: pa.array(kept, pa.string())}
        release()
        return pa.table([*out.values(), pa.array(lines.n_lines, pa.int64()), pa.array(dropped, pa.int64())], names=[*columns, "n_lines", "n_dropped"])

    schema = T.StructType([*docs.schema.fields, T.StructField("n_lines", T.LongType()), T.StructField("n_dropped", T.LongType())])
    answers = dealt.groupBy(block_col).applyInArrow(in_groups(route), ROUTED).groupBy("shard").applyInArrow(in_groups(_shard_answers), "block long, shard int, places binary, owners binary")
    return dealt.groupBy(block_col).cogroup(answers.groupBy("block")).applyInArrow(drop, schema)


def report(kept: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: n_lines, n_dropped and the SHA-256 of the kept text."""
    return kept.select(id_col, "n_lines", "n_dropped", F.sha2(F.coalesce(text_col, F.lit("")), 256).alias("kept_sha256"))


#: The same rows as the report, for DuckDB over `documents`.
SQL = r"""
WITH l AS (
  SELECT doc_id, n, line, k FROM (
    SELECT doc_id, n, line, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, unnest(range(len(string_split(coalesce(text, ''), chr(10))))) AS n FROM documents))
),
r AS (SELECT k, min(doc_id) AS owner FROM l WHERE length(k) >= 10 GROUP BY k HAVING count(DISTINCT doc_id) >= 2)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE r.k IS NOT NULL AND doc_id <> owner) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (WHERE r.k IS NULL OR doc_id = owner), '')) AS kept_sha256
FROM l LEFT JOIN r ON l.k = r.k
GROUP BY doc_id
"""
