"""Quality classifier: a factorisation machine over hashed words, statistics of the text's structure and its length as metadata.

    score = sigmoid(w0 + sum_j w_j x_j + sum_{j<k} <v_j, v_k> x_j x_k)

The pairwise sum is taken in linear time as half of |sum_j v_j x_j|^2 - sum_j |v_j|^2 x_j^2. x holds, for each distinct word, log(1 + its
count) at a hashed place, scaled to length 1 over the words, and the standardised statistics. All documents are scored whole, in one map.

The model is fitted on the driver on a bounded sample: the labelled documents outside the held-out fold whose id has a small hash,
about `train_rows` of them at any size of the input. The fit runs a fixed number of passes from a fixed seed.

Defined results: a null text counts as empty; an empty text has no words and gets the score of its statistics; a null doc_id is hashed as an
empty text; documents without a label are scored like any other; a document with both labels takes part once for each; of several rows with one
doc_id the first text in order is learned from, and each is scored; without labelled rows to learn from every score is 1; columns named like the
results are replaced, others stay. The length is counted from the text, so a wrong `n_chars` does no harm. Labels, language, source and id are no inputs.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut_at_blanks, in_parts, utf8

DIMS = 1 << 14
_SPACES = bytes(32 if b in b"\t\n\x0b\x0c\r" else b for b in range(256))
_STATS = ("chars", "words", "word_len", "upper", "digit", "punct", "other", "line_len", "repeat", "bang", "bar")


class WordPlaces(dict):
    """Word -> its hashed place; emptied when it holds many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= 1 << 17:
            self.clear()
        place = zlib.crc32(word) % DIMS
        self[word] = place
        return place


def _deleted(data: bytes, chars: bytes) -> int:
    return len(data) - len(data.translate(None, chars))


_CAPS, _DIGITS = bytes(range(65, 91)), bytes(range(48, 58))
_PUNCT = bytes(b for b in range(33, 127) if not chr(b).isalnum())
_HIGH = bytes(range(128, 256))


def features(text: str | None, places: WordPlaces) -> tuple[np.ndarray, np.ndarray, list[float]]:
    """The distinct places, their values (of length 1 in all), and the statistics of a text."""
    data = utf8(text)
    parts = [np.fromiter(map(places.__getitem__, ws := part.split()), np.int32, len(ws)) for part in cut_at_blanks(data.translate(_SPACES))]
    words = parts[0] if len(parts) == 1 else np.concatenate(parts)
    at, count = np.unique(words, return_counts=True)
    value = np.log1p(count)
    if len(at):
        value /= np.sqrt(np.square(value).sum())
    n, nw, lines = max(len(data), 1), max(len(words), 1), data.count(b"\n") + 1
    stats = [
        np.log1p(len(text or "")),
        np.log1p(len(words)),
        len(data) / nw,
        _deleted(data, _CAPS) / n,
        _deleted(data, _DIGITS) / n,
        _deleted(data, _PUNCT) / n,
        _deleted(data, _HIGH) / n,
        np.log1p(len(data) / lines),
        1 - len(at) / nw,
        data.count(b"!") / nw,
        data.count(b"|") / nw,
    ]
    return at, value, [float(x) for x in stats]


@dataclass
class Machine:
    """w0, w (DIMS + statistics), v (the same, rank), and the mean and scale of each statistic."""

    w0: float
    w: np.ndarray
    v: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def scores(self, at: np.ndarray, value: np.ndarray, lengths: np.ndarray, stats: np.ndarray) -> np.ndarray:
        """One score a document; at and value lie end to end, lengths a document."""
        n, z = len(lengths), np.clip((stats - self.mean) / self.scale, -5, 5)
        doc = np.repeat(np.arange(n), lengths)
        # row by row: a matrix product's rounding would depend on the rows beside
        linear = self.w0 + np.bincount(doc, self.w[at] * value, n) + (z * self.w[DIMS:]).sum(axis=1)
        rows = self.v[at] * value[:, None]
        total = np.stack([np.bincount(doc, rows[:, f], n) for f in range(rows.shape[1])], axis=1) + (z[:, :, None] * self.v[DIMS:]).sum(axis=1)
        squares = np.bincount(doc, np.square(rows).sum(axis=1), n) + (np.square(z) * np.square(self.v[DIMS:]).sum(axis=1)).sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(linear + 0.5 * (np.square(total).sum(axis=1) - squares), -30, 30)))


def fit(docs: list[tuple[np.ndarray, np.ndarray, list[float]]], labels: np.ndarray, rank: int = 6, passes: int = 8, batch: int = 256, rate: float = 0.02, decay: float = 1e-5, seed: int = 7) -> Machine:
    """Adam on the log loss, in batches of documents in a fixed random order."""
    rng = np.random.default_rng(seed)
    stats = np.array([s for _, _, s in docs], float)
    mean, scale = stats.mean(axis=0), stats.std(axis=0) + 1e-6
    z = np.clip((stats - mean) / scale, -5, 5)
    size = DIMS + z.shape[1]
    share = np.clip(labels.mean(), 1e-3, 1 - 1e-3)
    theta = np.concatenate((np.zeros((size, 1)), rng.normal(0, 0.05, (size, rank))), axis=1)
    bias = float(np.log(share / (1 - share)))
    m, s, mb, sb = np.zeros_like(theta), np.zeros_like(theta), 0.0, 0.0
    step = 0
    for _ in range(passes):
        order = rng.permutation(len(docs))
        for first in range(0, len(order), batch):
            mine = order[first : first + batch]
            at = np.concatenate([docs[i][0] for i in mine]).astype(np.int64)
            value = np.concatenate([docs[i][1] for i in mine])
            doc = np.repeat(np.arange(len(mine)), [len(docs[i][0]) for i in mine])
            zs, y, n = z[mine], labels[mine], len(mine)
            w, v = theta[:, 0], theta[:, 1:]
            rows = v[at] * value[:, None]
            total = np.stack([np.bincount(doc, rows[:, f], n) for f in range(rank)], axis=1) + zs @ v[DIMS:]
            squares = np.bincount(doc, np.square(rows).sum(axis=1), n) + np.square(zs) @ np.square(v[DIMS:]).sum(axis=1)
            raw = bias + np.bincount(doc, w[at] * value, n) + zs @ w[DIMS:] + 0.5 * (np.square(total).sum(axis=1) - squares)
            error = (1 / (1 + np.exp(-np.clip(raw, -30, 30))) - y) / n
            grad = decay * theta
            ev = error[doc] * value
            grad[:DIMS, 0] += np.bincount(at, ev, DIMS)
            grad[DIMS:, 0] += zs.T @ error
            inner = ev[:, None] * (total[doc] - rows)
            for f in range(rank):
                grad[:DIMS, 1 + f] += np.bincount(at, inner[:, f], DIMS)
            grad[DIMS:, 1:] += zs.T @ (error[:, None] * total) - (np.square(zs).T @ error)[:, None] * v[DIMS:]
            step += 1
            m, s = 0.9 * m + 0.1 * grad, 0.999 * s + 0.001 * np.square(grad)
            theta = theta - rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
            gb = float(error.sum())
            mb, sb = 0.9 * mb + 0.1 * gb, 0.999 * sb + 0.001 * gb * gb
            bias -= rate * (mb / (1 - 0.9**step)) / (np.sqrt(sb / (1 - 0.999**step)) + 1e-8)
    return Machine(bias, theta[:, 0].copy(), theta[:, 1:].copy(), mean, scale)


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; 0 is held out."""
    return F.pmod(F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")), F.lit(5))


_FEATURES = T.StructType([T.StructField("label", T.IntegerType()), T.StructField("at", T.BinaryType()), T.StructField("value", T.BinaryType()), T.StructField("stats", T.ArrayType(T.DoubleType()))])


def train(docs: DataFrame, labels: DataFrame, label_col: str = "quality", train_rows: int = 12_000, id_col: str = "doc_id", text_col: str = "text", **how) -> Machine | None:
    """A machine for P(label = 1), fitted on about train_rows labelled documents outside fold 0; None if there are none."""
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("label")).where(F.col("i").isNotNull() & F.col("label").isin(0, 1) & (fold(F.col("i")) != 0)).distinct()
    n = known.count()
    if not n:
        return None
    if n > train_rows:
        known = known.where(F.pmod(F.xxhash64("i"), F.lit(1 << 30)) < int(train_rows / n * (1 << 30)))
    texts = docs.select(F.col(id_col).alias("i"), F.coalesce(text_col, F.lit("")).alias("t"))

    def extract() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        places = WordPlaces()

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            got = [features(t, places) for t in batch.column("t").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array([a.astype(np.int32).tobytes() for a, _, _ in got], pa.binary()), pa.array([v.astype(np.float32).tobytes() for _, v, _ in got], pa.binary()), pa.array([s for _, _, s in got], pa.list_(pa.float64()))],
                names=_FEATURES.names,
            )

        return part

    # known has about train_rows rows at most, at any size of the input; rows with one id are one example
    chosen = texts.join(F.broadcast(known), "i").groupBy("i", "label").agg(F.min("t").alias("t"))
    rows = chosen.select("label", "t").mapInArrow(in_parts(extract, "t"), _FEATURES).collect()
    rows.sort(key=lambda r: (r.label, bytes(r.value), bytes(r["at"])))
    if not rows:
        return None
    examples = [(np.frombuffer(r["at"], np.int32), np.frombuffer(r.value, np.float32).astype(float), r.stats) for r in rows]
    return fit(examples, np.array([r.label for r in rows], float), **how)


def score(docs: DataFrame, machine: Machine | None, threshold: float = 0.3, text_col: str = "text") -> DataFrame:
    """The documents with score double and predicted int (1 if score >= threshold)."""
    docs = docs.drop("score", "predicted")
    if machine is None:
        return docs.withColumn("score", F.lit(1.0)).withColumn("predicted", F.lit(1))
    model = docs.sparkSession.sparkContext.broadcast(machine)
    schema = T.StructType([*docs.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())])

    def apply() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        places, held = WordPlaces(), model.value

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            got = [features(t, places) for t in batch.column(text_col).to_pylist()]
            sizes = np.array([len(a) for a, _, _ in got])
            scores = held.scores(np.concatenate([a for a, _, _ in got]), np.concatenate([v for _, v, _ in got]), sizes, np.array([s for _, _, s in got]))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32), pa.int32())], names=schema.names)

        return part

    return docs.mapInArrow(in_parts(apply, text_col, rows=500), schema)


def report(docs: DataFrame, labels: DataFrame, **how) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    return score(docs.select("doc_id", "text"), train(docs, labels, **how)).select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "score", "predicted")
