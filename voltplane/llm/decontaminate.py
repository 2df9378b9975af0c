r"""Benchmark decontamination: a broadcast hash set of normalised test n-grams is held against every window of the training words.

A word is a run of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]` after A-Z became a-z. A window is `n` consecutive words of an item; an item with
fewer words, but not none, is one window. Each document is read once in a map, whole, without a shuffle.

The hash set grows with the benchmark, not with the corpus. Its size is checked: a worker's copy takes about 21 bytes a byte of item text, so
beyond `pass_bytes` of it the items are dealt into passes of that size each. What a pass has found is written with its documents before the next
begins, and its hash set is released, so that a worker holds one at a time. Documents are taken in parts of bounded size.

Defined results: a null or empty text has no words and no hits; a null, empty or wordless item has no windows; equal items all count;
repeated documents are judged one by one; other columns stay, and columns named like the results are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ALNUM_TABLE, cut_at_blanks, dropped, in_parts, utf8, written

SPANS = T.ArrayType(T.ArrayType(T.IntegerType()))
_WORD = re.compile(rb"[^ ]+")


class WindowIndex:
    """The windows of some items: word -> number, and per window length the packed numbers of a window -> positions in `items`."""

    def __init__(self, rows: list[tuple[int, str | None]], n: int):
        self.vocab: dict[bytes, int] = {}
        self.items: list[int] = []
        self.windows: dict[int, dict[bytes, tuple[int, ...]]] = {}
        for item_id, text in rows:
            ids = np.array([self.vocab.setdefault(w, len(self.vocab) + 1) for w in utf8(text).translate(ALNUM_TABLE).split()], np.int32)
            if not len(ids):
                continue
            self.items.append(item_id)
            k = min(n, len(ids))
            table = self.windows.setdefault(k, {})
            for i in range(len(ids) - k + 1):
                key = ids[i : i + k].tobytes()
                held = table.get(key, ())
                if not held or held[-1] != len(self.items) - 1:
                    table[key] = (*held, len(self.items) - 1)

    def scan(self, text: str | None) -> tuple[int, list[list[int]], list[int]]:
        """Number of words; spans [first, end) of hit words, merged; the ids of the items with occurring windows."""
        data = utf8(text).translate(ALNUM_TABLE)
        get = self.vocab.get
        parts = [np.array([get(w, 0) for w in part.split()], np.int32) for part in cut_at_blanks(data)]
        ids = parts[0] if len(parts) == 1 else np.concatenate(parts)
        known = np.concatenate(([0], np.cumsum(ids > 0)))
        spans: list[list[int]] = []
        found: set[int] = set()
        for k, table in self.windows.items():
            if len(ids) < k:
                continue
            for p in np.flatnonzero(known[k:] - known[:-k] == k).tolist():
                held = table.get(ids[p : p + k].tobytes())
                if held:
                    spans.append([p, p + k])
                    found.update(held)
        return len(ids), _merge(spans), sorted({self.items[i] for i in found})


def without_spans(text: str | None, spans: list[list[int]] | None) -> str | None:
    """The text without the bytes from the first to the last word of each span; a text without spans, or null, as it is."""
    if text is None or not spans:
        return text
    data = utf8(text)
    at = [m.span() for m in _WORD.finditer(data.translate(ALNUM_TABLE))]
    out, last = [], 0
    for a, b in spans:
        out.append(data[last : at[a][0]])
        last = at[b - 1][1]
    return b"".join([*out, data[last:]]).decode("utf-8", "surrogatepass")


def _passes(items: DataFrame, item_col: str, text_col: str, pass_bytes: int) -> Iterator[tuple[bool, list[tuple[int, str | None]]]]:
    """The items, some at a time, and whether they are the last."""
    items = items.select(F.col(item_col).alias("i"), F.col(text_col).alias("t"))
    total = items.agg(F.coalesce(F.sum(F.octet_length("t")), F.lit(0))).first()[0]
    n = max(1, -(-total // pass_bytes))
    for p in range(n):
        part = items if n == 1 else items.where(F.pmod(F.xxhash64("i", "t"), F.lit(n)) == p)
        yield p == n - 1, [(r.i, r.t) for r in part.collect()]


def hits(docs: DataFrame, items: DataFrame, n: int = 10, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", pass_bytes: int = 4 << 20, cut: bool = False) -> DataFrame:
    """The documents with n_words long, hit_spans array<array<int>> ([first, end) in words) and hit_items array<long>.

    pass_bytes bounds the item text that is collected and broadcast at a time. cut: the hit words are taken out of the texts.
    """
    docs = docs.drop("n_words", "hit_spans", "hit_items")
    before = None
    for last, rows in _passes(items, item_col, item_text_col, pass_bytes):
        index = docs.sparkSession.sparkContext.broadcast(WindowIndex(rows, n))
        docs = _scan(docs, index, text_col, cut and last)
        if not last:
            docs = written(docs)
            index.destroy()
            if before is not None:
                dropped(before)
            before = docs
    return docs


def _scan(docs: DataFrame, index, text_col: str, cut: bool) -> DataFrame:
    """Adds the hits of one index, to those that the documents have from earlier passes if any."""
    before = "hit_spans" in docs.columns
    kept_names = [c for c in docs.columns if c not in ("n_words", "hit_spans", "hit_items")]
    schema = T.StructType([*docs.select(*kept_names).schema.fields, T.StructField("n_words", T.LongType()), T.StructField("hit_spans", SPANS), T.StructField("hit_items", T.ArrayType(T.LongType()))])

    def scan() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        held = index.value

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = batch.column(text_col).to_pylist()
            words, spans, items = (list(x) for x in zip(*map(held.scan, texts), strict=True))
            if before:
                spans = [_merge([*a, *b]) for a, b in zip(spans, batch.column("hit_spans").to_pylist(), strict=True)]
                items = [sorted({*a, *b}) for a, b in zip(items, batch.column("hit_items").to_pylist(), strict=True)]
            kept = {c: batch.column(c) for c in kept_names}
            if cut and any(spans):
                kept[text_col] = pa.array(map(without_spans, texts, spans), kept[text_col].type)
            yield pa.RecordBatch.from_arrays([*kept.values(), pa.array(words, pa.int64()), pa.array(spans, pa.list_(pa.list_(pa.int32()))), pa.array(items, pa.list_(pa.int64()))], names=schema.names)

        return part

    return docs.mapInArrow(in_parts(scan, text_col), schema)


def _merge(spans: list[list[int]]) -> list[list[int]]:
    merged: list[list[int]] = []
    for a, b in sorted(map(tuple, spans)):
        if merged and a <= merged[-1][1]:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    return merged


def decontaminate(docs: DataFrame, items: DataFrame, n: int = 10, mode: str = "spans", text_col: str = "text", **how) -> DataFrame:
    """The documents without test passages: mode "spans" cuts the hit spans out of the texts, "documents" drops the documents that are hit.

    The columns of docs stay as they are; clean documents are unchanged.
    """
    if mode not in ("spans", "documents"):
        raise ValueError(f"mode is spans or documents, not {mode}")
    found = hits(docs, items, n, text_col, cut=mode == "spans", **how)
    if mode == "documents":
        found = found.where(F.size("hit_spans") == 0)
    return found.select(*docs.columns)


def report(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per document: n_words, n_hit, n_items, items_sha256 and contaminated, from the columns of hits()."""
    digest = F.sha2(F.array_join(F.array_sort(F.transform("hit_items", lambda x: x.cast("string"))), ","), 256)
    n_hit = F.aggregate("hit_spans", F.lit(0).cast("long"), lambda s, x: s + (x[1] - x[0]))
    return found.select(id_col, "n_words", n_hit.alias("n_hit"), F.size("hit_items").cast("long").alias("n_items"), digest.alias("items_sha256"), (n_hit > 0).alias("contaminated"))



#: The rows of report() for DuckDB over `documents` and `benchmark`.
SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
i AS (SELECT item_id, least(10, len(w)) AS k, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS p FROM b WHERE len(w) > 0),
g AS (SELECT DISTINCT item_id, k, array_to_string(w[p:p + k - 1], ' ') AS t FROM i),
c AS (SELECT doc_id, k, w, unnest(range(1, len(w) - k + 2)) AS p FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k),
h AS (SELECT doc_id, item_id, p, c.k FROM c JOIN g ON g.k = c.k AND g.t = array_to_string(w[p:p + c.k - 1], ' ')),
n AS (SELECT doc_id, count(*) AS n_hit FROM (SELECT DISTINCT doc_id, p + unnest(range(k)) AS q FROM h) GROUP BY doc_id),
s AS (SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN s USING (doc_id)
"""
