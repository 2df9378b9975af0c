r"""Ranked lexical search: impact-ordered postings, processed score at a time, with an exact stop.

A term is a run of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after A-Z became a-z, taken from whole texts. With N documents with terms, L terms in all, df documents that
hold a term, a term weighs w = floor(1000 * ln((2N + 2) / (2df + 1))); a document of n terms has m = 75 + (25 * n * N) div L, and holding a term tf times
gives it the impact w * ((10^9 * tf) div (1000 * tf + 12 * m)) for that term. A document's score is the sum of its impacts over a query's terms, repeats included.

1. A map reads each document once, whole, and writes its term count and the numbers and counts of those of its terms that any query has. Queries are
   collected and broadcast behind a check of their size: beyond `pass_bytes` of text they are dealt into passes.
2. N, L and df are added up over all documents.
3. A map takes the postings of `block_docs` documents at a time, turns them into impacts and groups them by term and exact impact. For each query the groups are taken in descending
   order of what they add to a score, and accumulators are kept. What is left of each term is bounded by its next group, so a document's score lies
   between its accumulator and that plus the sum of these bounds. The scan stops only when documents not met yet can't reach the k-th best score, of this block so far or of the
   task's earlier blocks, and completing those that still can costs less than going on. Their scores are then completed from their own terms, so they are exact.
4. Each task gives its k best documents a query; one window takes the k best of these.

Memory a task: one block's postings and k rows a query. Nothing but df (bounded by the queries' terms) reaches the driver.

Defined results: null, empty or wordless texts hold no terms, are not among N and are never found; such queries find nothing. Rows of documents are ranked one by one,
those that share an id too; equal scores rank by ascending id, rows without an id last. Rows of queries with the same id and the same text are one
query; with one id and different texts, each has its own ranking under that id. Scores of 0 are left out. Extra columns don't enter, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import ALNUM_TABLE, binary_column, cut_at_blanks, dropped, in_parts, pack, ranges, release, segment_starts, utf8, written

#: Terms of a text are numbered from 0; this is none of the queries'.
_OTHER = -1


def words(text: str | None) -> list[bytes]:
    return utf8(text).translate(ALNUM_TABLE).split()


class Queries:
    """Terms of some queries, numbered, and per query the numbers and how often each occurs."""

    def __init__(self, texts: list[str | None]):
        self.vocab: dict[bytes, int] = {}
        self.terms: list[tuple[np.ndarray, np.ndarray]] = []
        for text in texts:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab)) for w in words(text)], np.int64)
            self.terms.append(tuple(np.unique(ids, return_counts=True)))

    def count(self, text: str | None) -> tuple[int, np.ndarray, np.ndarray]:
        """Number of terms of a text; the numbers of those that queries have, and how often they occur."""
        get, n, parts = self.vocab.get, 0, []
        for part in cut_at_blanks(utf8(text).translate(ALNUM_TABLE)):
            ids = np.array([get(w, _OTHER) for w in part.split()], np.int32)
            n += len(ids)
            parts.append(ids[ids >= 0])
        return n, *np.unique(np.concatenate(parts), return_counts=True)


def weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(x) + 1))) for x in df], np.int64)


class Best:
    """The k best rows so far of one query."""

    def __init__(self, k: int):
        self.k, self.scores, self.ids, self.missing = k, np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def least(self) -> int:
        """What a further document must score at least to get in; 1 as long as any can."""
        return int(self.scores[-1]) if len(self.scores) == self.k else 1

    def add(self, scores: np.ndarray, ids: np.ndarray, missing: np.ndarray) -> None:
        if len(scores) > self.k:
            some = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids, missing = scores[some], ids[some], missing[some]
        scores, ids, missing = np.concatenate((self.scores, scores)), np.concatenate((self.ids, ids)), np.concatenate((self.missing, missing))
        order = np.lexsort((ids, missing, -scores))[: self.k]
        self.scores, self.ids, self.missing = scores[order], ids[order], missing[order]


class ImpactBlock:
    """The postings of some documents, by term and exact impact in descending order, and by document."""

    def __init__(self, lengths: np.ndarray, terms: np.ndarray, tfs: np.ndarray, m: np.ndarray, weight: np.ndarray):
        """lengths: postings of each document; terms, tfs: of these, document after document."""
        docs = np.repeat(np.arange(len(lengths)), lengths)
        impacts = weight[terms] * ((10**9 * tfs) // (1000 * tfs + 12 * m[docs]))
        self.n, self.terms, self.impacts = len(lengths), terms, impacts
        self.starts, self.lengths = segment_starts(lengths), lengths
        held = np.flatnonzero(impacts > 0)
        order = held[np.lexsort((-impacts[held], terms[held]))]
        self.docs = docs[order].astype(np.int32)
        t, x = terms[order], impacts[order]
        first = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (x[1:] != x[:-1])))) if len(order) else np.zeros(0, np.int64)
        self.group_at = np.append(first, len(order))
        self.group_term, self.group_impact = t[first], x[first]
        self.times = np.zeros(len(weight), np.int64)

    def search(self, terms: np.ndarray, times: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of the block and their scores: all that are among the k best of the block and score at least `least`, and maybe others."""
        lo, hi = np.searchsorted(self.group_term, terms, "left"), np.searchsorted(self.group_term, terms, "right")
        counts = hi - lo
        groups = ranges(lo, counts)
        owner = np.repeat(np.arange(len(terms)), counts)
        adds = self.group_impact[groups] * times[owner]
        order = np.argsort(-adds, kind="stable")
        groups, owner, adds = groups[order], owner[order], adds[order]
        sizes = self.group_at[groups + 1] - self.group_at[groups]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        # per term, what its groups add, in order: the bound of a term is its first one that isn't processed
        falling = np.append(adds[np.argsort(owner, kind="stable")], 0)
        base, done = segment_starts(counts), np.zeros(len(terms), np.int64)
        scores = np.zeros(self.n, np.int64)
        at, step = 0, 1024
        while at < len(groups):
            upto = min(len(groups), max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + step, "right"))))
            part = slice(at, upto)
            np.add.at(scores, self.docs[ranges(self.group_at[groups[part]], sizes[part])], np.repeat(adds[part], sizes[part]))
            done += np.bincount(owner[part], minlength=len(terms))
            at, step = upto, step * 2
            rest = int(np.where(done < counts, falling[np.minimum(base + done, len(falling) - 1)], 0).sum())
            bar = max(least, int(np.partition(scores, self.n - k)[self.n - k]) if self.n >= k else 1)
            if rest < bar:
                able = np.flatnonzero(scores + rest >= bar)
                if rest == 0 or int(self.lengths[able].sum()) <= total - int(ends[at - 1]):
                    return able, scores[able] if rest == 0 else self.complete(able, terms, times)
        found = np.flatnonzero(scores >= max(least, 1))
        return found, scores[found]

    def complete(self, docs: np.ndarray, terms: np.ndarray, times: np.ndarray) -> np.ndarray:
        """The exact scores of these documents, from all their postings."""
        self.times[terms] = times
        at = ranges(self.starts[docs], self.lengths[docs])
        sums = np.zeros(len(docs), np.int64)
        np.add.at(sums, np.repeat(np.arange(len(docs)), self.lengths[docs]), self.impacts[at] * self.times[self.terms[at]])
        self.times[terms] = 0
        return sums


def term_counts(docs: DataFrame, queries, text_col: str, id_col: str) -> DataFrame:
    """id, n (terms), terms and tfs (packed 32-bit numbers) of the documents with terms. queries: a broadcast Queries."""

    def count():
        held = queries.value

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            found = [held.count(t) for t in batch.column(1).to_pylist()]
            n = pa.array([f[0] for f in found], pa.int64())
            out = pa.RecordBatch.from_arrays([batch.column(0), n, binary_column([pack(f[1].astype(np.int32)) for f in found]), binary_column([pack(f[2].astype(np.int32)) for f in found])], names=["id", "n", "terms", "tfs"])
            yield out.filter(pa.array([f[0] > 0 for f in found], pa.bool_()))

        return part

    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    return source.mapInArrow(in_parts(count, "text"), "id long, n long, terms binary, tfs binary")


def _numbers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """How many numbers each row of a packed column holds, and all of them end to end."""
    rows = column.to_pylist()
    return np.array([len(b) // 4 for b in rows], np.int64), np.frombuffer(b"".join(rows), np.int32).astype(np.int64)


def document_frequencies(counted: DataFrame, n_terms: int) -> np.ndarray:
    """In how many documents each of the queries' terms occurs."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(n_terms, np.int64)
        for batch in batches:
            df += np.bincount(_numbers(batch.column(0))[1], minlength=n_terms)
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(df[some])], names=["term", "df"])

    out = np.zeros(n_terms, np.int64)
    for r in counted.select("terms").mapInArrow(add, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():
        out[r.term] = r.df
    return out


def _best_of_tasks(counted: DataFrame, queries, weight, n_docs: int, n_terms: int, k: int, block_docs: int) -> DataFrame:
    """Each task's k best rows of each query: query, id, score."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, w = queries.value.terms, weight.value
        best = [Best(k) for _ in asked]
        # a term of every document weighs nothing and can't change a score
        asked = [(t[w[t] > 0], c[w[t] > 0]) for t, c in asked]

        def block(table: pa.Table) -> None:
            column = lambda c: table.column(c).combine_chunks()
            ids, missing = column("id").fill_null(0).to_numpy(zero_copy_only=False), column("id").is_null().to_numpy(zero_copy_only=False)
            lengths, terms = _numbers(column("terms"))
            m = 75 + np.array([25 * n * n_docs // n_terms for n in column("n").to_pylist()], np.int64)
            held = ImpactBlock(lengths, terms, _numbers(column("tfs"))[1], m, w)
            for (t, c), top in zip(asked, best, strict=True):
                if len(t):
                    found, scores = held.search(t, c, top.least(), k)
                    top.add(scores, ids[found], missing[found])

        waiting, rows = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, block_docs):
                part = batch.slice(at, block_docs)
                if rows and rows + part.num_rows > block_docs:
                    block(pa.Table.from_batches(waiting))
                    waiting, rows = [], 0
                waiting.append(part)
                rows += part.num_rows
        if rows:
            block(pa.Table.from_batches(waiting))
        numbers = np.repeat(np.arange(len(best), dtype=np.int32), [len(b.scores) for b in best])
        if len(numbers):
            ids = pa.array(np.concatenate([b.ids for b in best]), mask=np.concatenate([b.missing for b in best]))
            yield pa.RecordBatch.from_arrays([pa.array(numbers), ids, pa.array(np.concatenate([b.scores for b in best]))], names=["query", "id", "score"])
        release()

    return counted.mapInArrow(search, "query int, id long, score long")


def ranked(docs: DataFrame, items: DataFrame, k: int = 20, text_col: str = "text", id_col: str = "doc_id", item_col: str = "item_id", item_text_col: str = "text", block_docs: int = 1 << 14, pass_bytes: int = 4 << 20) -> DataFrame:
    """The k best documents of each item: item_id, rank (from 1), doc_id, score. pass_bytes: item text that is collected and broadcast at a time."""
    spark = docs.sparkSession
    asked = items.select(F.col(item_col).alias("i"), F.col(item_text_col).alias("t")).distinct()
    total = asked.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    passes = max(1, -(-total // pass_bytes))
    kind = items.schema[item_col].dataType.simpleString()
    results = []
    for p in range(passes):
        rows = (asked if passes == 1 else asked.where(F.pmod(F.xxhash64("i", "t"), F.lit(passes)) == p)).collect()
        queries = Queries([r.t for r in rows])
        if not queries.vocab:
            continue
        sent = spark.sparkContext.broadcast(queries)
        counted = written(term_counts(docs, sent, text_col, id_col))
        sums = counted.agg(F.count("*").alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("terms")).first()
        if sums.docs:
            weight = spark.sparkContext.broadcast(weights(document_frequencies(counted, len(queries.vocab)), sums.docs))
            best = _best_of_tasks(counted.where(F.length("terms") > 0), sent, weight, sums.docs, sums.terms, k, block_docs)
            numbered = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("id"))
            top = written(best.withColumn("rank", F.row_number().over(numbered)).where(F.col("rank") <= k))
            named = spark.createDataFrame([(j, r.i) for j, r in enumerate(rows)], f"query int, item {kind}")
            results.append(top.join(F.broadcast(named), "query").select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score"))
        dropped(counted)
    return reduce(DataFrame.unionByName, results) if results else spark.createDataFrame([], f"item_id {kind}, rank int, doc_id long, score long")


#: The rows of ranked() for DuckDB over `documents` and `benchmark`.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
q AS (SELECT item_id, t, count(*) AS times FROM (SELECT item_id, unnest(w) AS t FROM b) GROUP BY item_id, t),
s AS (SELECT count(*) AS nd, sum(len(w))::BIGINT AS nt FROM d WHERE len(w) > 0),
m AS (SELECT doc_id, 75 + ((25 * len(w)::BIGINT * nd) // nt) AS m FROM d, s WHERE len(w) > 0),
p AS (SELECT doc_id, t, count(*) AS tf FROM (SELECT doc_id, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY doc_id, t),
f AS (SELECT t, floor(1000 * ln((2 * nd + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM p, s GROUP BY t, nd),
x AS (SELECT doc_id, t, weight * ((1000000000 * tf) // (1000 * tf + 12 * m)) AS impact FROM p JOIN f USING (t) JOIN m USING (doc_id)),
r AS (SELECT item_id, doc_id, sum(times * impact)::BIGINT AS score FROM q JOIN x USING (t) GROUP BY item_id, doc_id),
n AS (SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score FROM r WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM n WHERE rank <= 20
"""
