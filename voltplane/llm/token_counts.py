"""Token counts in one map over the texts, without a shuffle.

A text is cut at the tokenizer's special strings and then into pre-tokens by its pattern; the number of tokens of a text is the sum over
them. Two tiers look a pre-token up: first a broadcast compact table of the lengths, in tokens, of frequent pre-tokens; then a cache of the
worker, which the tokenizer itself fills on a miss. Both tiers only save time: the counts are those of the tokenizer.

The frequent pre-tokens are those of a sample of the whole table (about `sample_docs` documents, `table_size` entries), so the broadcast has a fixed
bound; the cache of a worker changes generation at `cache_size` entries. Texts are taken in parts of bounded size, but a single one is cut into its pre-tokens at once.

Defined results: a null text counts as empty, with 0 bytes and 0 tokens; texts are never cut short; repeated rows are counted one by one;
other columns stay, and columns named like the results are replaced.
"""

from __future__ import annotations

import functools
import json
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import in_parts, release, utf8

#: Longer pre-tokens are not kept in a cache.
LONGEST_KEPT = 64


def check_kind(spec: dict) -> None:
    """Raises for tokenizers that don't cut texts by the byte-level pattern below."""
    pre = spec.get("pre_tokenizer") or {}
    if spec.get("normalizer") or spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex") or pre.get("add_prefix_space"):
        raise ValueError("only byte-level BPE without a normalizer or a prefix blank can be counted by pre-tokens")


def _cut(letters: str, numbers: str, blanks: str) -> re.Pattern:
    """The byte-level pattern (contractions, then runs of letters, numbers or others after a blank, then white space) over listed classes."""
    return re.compile(rf" ?[{letters}]+| ?[{numbers}]+|'(?:[stmd]|re|ve|ll)| ?[^{blanks}{letters}{numbers}]+|[{blanks}]+(?![^{blanks}])|[{blanks}]+")


#: Basic Latin to Latin Extended-B, where letters, digits and white space can be listed.
LATIN = _cut("A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼½¾", " \t-\r\x85\xa0").findall
BEYOND_LATIN = re.compile("[^\x00-\u024f]").search
#: The same cut for texts whose characters beyond ASCII are replaced by one of their class.
BY_CLASS = _cut("A-Za-z", "0-9", " \t-\r").finditer


class Classes(dict):
    """Code point -> itself in ASCII, else a character that stands for its class: X letter, 9 number, tab white space, ! other.

    The library itself is asked for the class of each code point, once a worker, so that its Unicode tables decide and no others.
    """

    def __init__(self, pre_tokenize):
        super().__init__({c: chr(c) for c in range(128)})
        self.pre_tokenize = pre_tokenize

    def __missing__(self, code: int) -> str:
        joined = lambda beside: len(self.pre_tokenize(f"{beside}{chr(code)}{beside}")) == 1
        self[code] = "X" if joined("a") else "9" if joined("1") else "!" if joined("!") else "\t"
        return self[code]


#: Byte-level tokenizers write a byte as a character: visible ones of Latin-1 as they are, the others in order from U+0100 on.
_UNSEEN = [b for b in range(256) if not (0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or b >= 0xAE)]
_BYTE_CHARS = {b: 0x100 + i for i, b in enumerate(_UNSEEN)}


def as_byte_chars(piece: str) -> str:
    # of visible ASCII only the blank is written as another character
    return piece.replace(" ", "\u0120") if piece.isascii() and piece.isprintable() else utf8(piece).decode("latin-1").translate(_BYTE_CHARS)


class Lengths(dict):
    """Pre-token -> number of tokens, or what else encode gives: a worker's cache above the broadcast table.

    Beyond cache_size entries a new generation begins. What it meets of the last one is taken over, so frequent pre-tokens stay and rare ones go with the second change.
    """

    def __init__(self, table: dict, encode, cache_size: int):
        super().__init__(table)
        self.table, self.encode, self.cache_size, self.last = table, encode, cache_size, {}

    def __missing__(self, piece: str):
        n = self.last.get(piece)
        if n is None:
            n = self.encode(piece)
        if len(piece) <= LONGEST_KEPT:
            if len(self) >= self.cache_size:
                self.last = dict(self)
                self.clear()
                self.update(self.table)
            self[piece] = n
        return n


class PreTokens:
    """The tokenizer in a file, taken apart: its special strings, its cut into pre-tokens and its model."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        spec = json.loads(tokenizer.to_str())
        check_kind(spec)
        if any(x["lstrip"] or x["rstrip"] or x["single_word"] for x in spec["added_tokens"]):
            raise ValueError("added tokens that take blanks along can't be counted by pre-tokens")
        self.specials = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.specials, key=len, reverse=True))) + ")") if self.specials else None
        self.classes = Classes(tokenizer.pre_tokenizer.pre_tokenize_str)
        # a pre-token goes to the library's model at once, which spares the cut and the offsets of a whole encoding
        self.model = tokenizer.model

    def tokens(self, piece: str) -> list:
        return self.model.tokenize(as_byte_chars(piece))

    def pieces(self, text: str) -> list[str]:
        if not BEYOND_LATIN(text):
            return LATIN(text)
        return [text[m.start() : m.end()] for m in BY_CLASS(text.translate(self.classes))]

    def parts(self, text: str) -> list[str]:
        """The text between special strings at even places, the special strings at odd ones."""
        return self.special.split(text) if self.special and any(x in text for x in self.specials) else [text]


class Counter2Tier(PreTokens):
    """Counts tokens; table: what packed_table() has made."""

    def __init__(self, path: str, table: bytes = b"", cache_size: int = 1 << 18):
        super().__init__(path)
        self.lengths = Lengths(unpacked_table(table), lambda piece: len(self.tokens(piece)), cache_size)

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        length = self.lengths.__getitem__
        parts = self.parts(text)
        return len(parts) // 2 + sum(sum(map(length, self.pieces(p))) for p in parts[::2])


class TokenIds(PreTokens):
    """Token ids as packed 32-bit integers, little end first, with a worker's cache of pre-tokens."""

    def __init__(self, path: str, cache_size: int = 1 << 18):
        super().__init__(path)
        self.known = Lengths({}, lambda piece: b"".join(t.id.to_bytes(4, "little") for t in self.tokens(piece)), cache_size)

    def packed(self, text: str | None) -> bytes:
        if not text:
            return b""
        known = self.known.__getitem__
        return b"".join(self.specials[p].to_bytes(4, "little") if i % 2 else b"".join(map(known, self.pieces(p))) for i, p in enumerate(self.parts(text)))


@functools.lru_cache(maxsize=1)
def worker_ids(path: str, cache_size: int) -> TokenIds:
    """One TokenIds for all tasks of a Python worker: frequent pre-tokens are the same in all of them. It holds at most twice cache_size pre-tokens."""
    return TokenIds(path, cache_size)


def packed_table(lengths: dict[str, int]) -> bytes:
    return zlib.compress(json.dumps(lengths, ensure_ascii=False).encode("utf-8", "surrogatepass"))


def unpacked_table(table: bytes) -> dict[str, int]:
    return json.loads(zlib.decompress(table)) if table else {}


def frequent_lengths(docs: DataFrame, path: str, text_col: str = "text", sample_docs: int = 2000, table_size: int = 1 << 16) -> bytes:
    """The packed lengths of the most frequent pre-tokens of about sample_docs documents from all over the table."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter, seen = Counter2Tier(path), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                seen.update(counter.pieces(text or ""))
        top = [(p, n) for p, n in seen.most_common(table_size) if len(p) <= LONGEST_KEPT]
        yield pa.RecordBatch.from_arrays([pa.array([p for p, _ in top], pa.string()), pa.array([counter.lengths[p] for p, _ in top], pa.int32()), pa.array([n for _, n in top], pa.int64())], names=["piece", "n", "times"])
        release()

    # drawn from all partitions, as the first rows may be of one source; each counts its own part of the sample, and the counts are added up
    share = min(1.0, sample_docs / max(1, docs.count()))
    counted = docs.select(text_col).sample(share, seed=1).mapInArrow(count, "piece string, n int, times long")
    rows = counted.groupBy("piece", "n").agg(F.sum("times").alias("times")).orderBy(F.desc("times"), "piece").limit(table_size).collect()
    return packed_table({r.piece: r.n for r in rows})


def token_counts(docs: DataFrame, path: str, limit: int = 512, text_col: str = "text", sample_docs: int = 2000, table_size: int = 1 << 16, cache_size: int = 1 << 18) -> DataFrame:
    """The documents with n_bytes long, n_tokens long and over_limit boolean (n_tokens > limit). path: the tokenizer's file, on every executor."""
    docs = docs.drop("n_bytes", "n_tokens", "over_limit")
    table = docs.sparkSession.sparkContext.broadcast(frequent_lengths(docs, path, text_col, sample_docs, table_size))
    schema = T.StructType([*docs.schema.fields, T.StructField("n_bytes", T.LongType()), T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def count() -> Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]:
        counter = Counter2Tier(path, table.value, cache_size)

        def part(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
            texts = batch.column(text_col).to_pylist()
            n_tokens = [counter.count(t) for t in texts]
            n_bytes = [len(utf8(t)) for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(n_bytes, pa.int64()), pa.array(n_tokens, pa.int64()), pa.array([n > limit for n in n_tokens], pa.bool_())], names=schema.names)

        return part

    return docs.mapInArrow(in_parts(count, text_col), schema)
