"""Homomorphic multiset fingerprints of documents, in DataFrame operations only.

A paragraph is a line of the text. Its vector has two parts:

* EXACT lanes of 32 bits, hashed from the whole paragraph;
* SKETCH lanes of 30 bits, two to a 60-bit word: for each clause of the paragraph (up to eight words, cut short after punctuation) one bit
  of the clause's hash a lane. A lane holds 2^30 clauses, more than the longest string has, so lanes don't run into each other.

A document's fingerprint is the sum of its paragraphs' vectors, the exact lanes modulo 2^32 and the packed words modulo 2^60, with the number
of paragraphs and clauses. Sums don't know an order, so documents with the same paragraphs have equal fingerprints, and a paragraph is
inserted into or deleted from a fingerprint by adding or subtracting its own (`combine`). The hashes are xxHash64 with a seed a lane: good
against accidents, not against an attacker.

Likeness: twice a sketch lane less the number of clauses is a sum of random signs, so the cosine of two documents' lanes estimates the cosine
of their multisets of clauses; it is cut to 0 .. 1, and equal fingerprints give 1.

Defined results: a null text counts as empty, one empty paragraph without clauses; an empty text is like another empty text (1) and unlike
any other (0). The next document follows in ascending (doc_id, text), nulls first; after the last comes the first; a single document follows
itself. Other columns stay out of `with_next`'s way: they are kept, and columns named like its results are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, pieces_for

EXACT, HASHES, PER_HASH = 8, 2, 30
SKETCH = HASHES * PER_HASH * 2
#: One bit in each of the two 30-bit lanes of a word.
LANES = 1 | 1 << 30
MASK32, MASK60, MASK30 = (1 << 32) - 1, (1 << 60) - 1, (1 << 30) - 1
#: Up to seven words without punctuation at their end, then any word.
CLAUSE = r"(?:[^\s.,;:!?|]++[ \t]++(?=\S)){0,7}+\S++"
#: The driver and each task hold 8 bytes for each so many bytes of input: the bounds of the buckets.
BUCKET_BYTES = 16 << 20


def _long(value: int) -> Column:
    return F.lit(value).cast("long")


def _sum(items: Column, lane, mask: int) -> Column:
    """The sum of lane(item) over an array, modulo a power of two."""
    return F.aggregate(items, _long(0), lambda s, x: (s + lane(x)).bitwiseAND(_long(mask)))


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text: struct<paragraphs long, clauses long, exact array<long>, sketch array<long>>."""
    paragraphs = F.split(F.coalesce(text, F.lit("")), "\n", -1)
    clauses = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(CLAUSE), F.lit(0))
    hashed = F.struct(*[F.transform(clauses, lambda c: F.xxhash64(F.lit(i), c)).alias(f"h{i}") for i in range(HASHES)])
    wide = F.transform(paragraphs, lambda p: F.struct(*[F.xxhash64(F.lit(100 + i), p).alias(f"e{i}") for i in range(EXACT // 2)]))
    exact = F.aggregate(
        wide,
        F.array(*[_long(0)] * EXACT),
        lambda s, p: F.array(
            *[
                (s[i] + (p[f"e{i // 2}"] if i % 2 == 0 else F.shiftrightunsigned(p[f"e{i // 2}"], 32)).bitwiseAND(_long(MASK32))).bitwiseAND(_long(MASK32))
                for i in range(EXACT)
            ]
        ),
    )

    def lane_pair(hashes: Column, bit: int) -> Column:
        return _sum(hashes, lambda h: F.shiftrightunsigned(h, bit).bitwiseAND(_long(LANES)), MASK60)

    # through an array of one, so that the hashes are taken once for all words
    sums = F.transform(F.array(hashed), lambda h: F.struct(F.size(h["h0"]).cast("long").alias("clauses"), F.array(*[lane_pair(h[f"h{i}"], bit) for i in range(HASHES) for bit in range(PER_HASH)]).alias("sketch")))[0]
    return F.struct(F.size(paragraphs).cast("long").alias("paragraphs"), sums["clauses"].alias("clauses"), exact.alias("exact"), sums["sketch"].alias("sketch"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """The fingerprint of the paragraphs of both (sign 1), or of those of a without those of b (sign -1)."""

    def lanes(name: str, mask: int) -> Column:
        return F.zip_with(a[name], b[name], lambda x, y: (x + y * sign).bitwiseAND(_long(mask))).alias(name)

    return F.struct((a["paragraphs"] + b["paragraphs"] * sign).alias("paragraphs"), (a["clauses"] + b["clauses"] * sign).alias("clauses"), lanes("exact", MASK32), lanes("sketch", MASK60))


def as_text(f: Column) -> Column:
    """The fingerprint as lowercase hex: counts, exact lanes, sketch words."""
    lane = lambda width: lambda x: F.lpad(F.lower(F.hex(x)), width, "0")
    return F.concat(lane(8)(f["paragraphs"]), lane(8)(f["clauses"]), F.array_join(F.transform(f["exact"], lane(8)), ""), F.array_join(F.transform(f["sketch"], lane(15)), ""))


def signs(f: Column) -> Column:
    """The sketch as an array of sums of signs."""
    return F.flatten(F.transform(f["sketch"], lambda w: F.array(*[(F.shiftrightunsigned(w, 30 * j).bitwiseAND(_long(MASK30)) * 2 - f["clauses"]).cast("double") for j in range(2)])))


def likeness(a: Column, b: Column, signs_a: Column | None = None, signs_b: Column | None = None) -> Column:
    """How like two fingerprints are, 0 to 1."""
    u, v = signs(a) if signs_a is None else signs_a, signs(b) if signs_b is None else signs_b
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p * q), F.lit(0.0), lambda s, z: s + z)
    both = F.sqrt(dot(u, u)) * F.sqrt(dot(v, v))
    cosine = F.when(both > 0, dot(u, v) / both).otherwise(F.lit(0.0))
    return F.when((a["exact"] == b["exact"]) & (a["sketch"] == b["sketch"]), F.lit(1.0)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), cosine)))


def _bounds(keys: DataFrame, n: int) -> list[int]:
    """The least keys of about n ranges of about as many rows each, in order; Spark takes the ranges from a sample of all partitions."""
    ranges = keys.repartitionByRange(n, "i").groupBy(F.spark_partition_id().alias("r")).agg(F.min("i").alias("i"))
    return sorted({r.i for r in ranges.collect()})


def _rank(key: Column, bounds: Column, n: int) -> Column:
    """How many of the n sorted bounds are not above the key, by halving."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(bounds, at + step - 1) <= key, at + step).otherwise(at))


def with_next(docs: DataFrame, values: list[str], id_col: str = "doc_id", text_col: str = "text", made: dict[str, Column] | None = None) -> DataFrame:
    """The documents with next_<value> of the document that follows, after the last of the first.

    Bounds that are doc_ids themselves cut the order into buckets of about BUCKET_BYTES of input, as many as the input needs. The first document of
    each bucket goes to the bucket before it as well, as a guest, so that each bucket is ordered alone. The rows of one doc_id share a bucket; a
    bucket's sort spills. made: columns that are made after documents went to their buckets, and so don't travel.
    """
    key, bucket, guest, place = (free_name(docs.columns, x) for x in ("key", "bucket", "guest", "place"))
    docs = docs.drop(*[f"next_{v}" for v in values]).withColumn(key, F.coalesce(F.col(id_col), _long(-(1 << 63))))
    cuts = _bounds(docs.select(F.col(key).alias("i")), pieces_for(docs, BUCKET_BYTES))
    n = len(cuts)
    # one folded literal, however many bounds there are
    bounds = F.split(F.lit(",".join(map(str, cuts))), ",").cast("array<bigint>")
    docs = docs.withColumn(bucket, F.transform(F.array(bounds), lambda b: _rank(F.col(key), b, n))[0] if n else F.lit(0))
    first = F.get(bounds, F.col(bucket) - 1) == F.col(key) if n else F.lit(False)
    before = F.when(F.col(bucket) == 1, F.lit(n)).otherwise(F.col(bucket) - 1)
    own = F.struct(F.col(bucket).alias("b"), F.lit(0).alias("g"))
    docs = docs.withColumn(place, F.explode(F.when(first, F.array(own, F.struct(before.alias("b"), F.lit(1).alias("g")))).otherwise(F.array(own))))
    docs = docs.withColumn(bucket, F.col(place)["b"]).withColumn(guest, F.col(place)["g"]).drop(place).repartition(bucket)
    for name, column in (made or {}).items():
        docs = docs.withColumn(name, column)
    order = Window.partitionBy(bucket).orderBy(guest, key, text_col)
    return docs.select("*", *[F.lead(v).over(order).alias(f"next_{v}") for v in values]).where(F.col(guest) == 0).drop(bucket, guest, key)


def edited_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, whose last floor(n_chars / 2) code points are replaced by the first as many of the next document."""
    docs = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    near = with_next(docs, ["text", "f"], made={"f": fingerprint(F.col("text"))})
    half = F.floor(F.length("text") / 2).cast("int")
    edited = near.withColumn("n_chars", F.length("text").cast("long")).withColumn("edited", F.concat(F.left(F.col("text"), (F.length("text") - half)), F.left(F.col("next_text"), half))).select("doc_id", "n_chars", "f", "next_f", "edited")
    out = edited.withColumn("g", fingerprint(F.col("edited"))).withColumn("s", signs(F.col("f")))
    return out.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        as_text(F.col("f")).alias("fingerprint"),
        as_text(F.col("g")).alias("edited_fingerprint"),
        likeness(F.col("f"), F.col("g"), F.col("s")).alias("near_edited"),
        likeness(F.col("f"), F.col("next_f"), F.col("s")).alias("near_next"),
    )
