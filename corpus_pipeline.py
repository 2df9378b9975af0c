"""A corpus pipeline of five stages over `documents`: each reads what the one before it has written.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents, and each decision takes effect:

1. quality: documents that the factorisation machine rejects go. It learns from labelled rows outside the held-out fold;
2. lines: lines that repeat across the documents that are left stay in the smallest doc_id only; a document that is left without a
   word by that goes;
3. near_duplicates: of each group of documents linked by Jaccard similarity the smallest doc_id stays;
4. decontamination: the words of benchmark windows are cut out of the texts; a document that is left without a word by that goes;
5. packing: the token counts of the texts are packed into sequences.

Where a cut changed a text, n_chars is set anew. Null and empty texts pass through, unless the machine rejects them. Rows that share a doc_id
are judged one by one, each by its own text, but the third stage takes them as one document that stays or goes as a whole; rows without an id
are nobody's duplicate and stay there. Packing gives every row its own place. Columns beyond those of documents pass through.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltplane.llm import decontaminate, line_dedup, ngram_join, packing, quality
from voltplane.llm.common import dropped, read_table, written
from voltplane.llm.queries import tokenizer_path


def _cut(before: DataFrame, after: DataFrame, changed) -> DataFrame:
    """The columns of before from after: n_chars anew where changed, and no document that a cut left without a word."""
    columns = [F.when(changed, F.length("text").cast("long")).otherwise(F.col(c)).alias(c) if c == "n_chars" else F.col(c) for c in before.columns]
    return after.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]")).select(*columns)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    machine = quality.train(docs, read_table(spark, sf_dir, "labels"))
    return quality.score(docs, machine).where(F.col("predicted") == 1).select(*docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _cut(docs, line_dedup.dedup_lines(docs), F.col("n_dropped") > 0)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    found = ngram_join.jaccard_components(docs)
    gone = found.where(F.col("doc_id") != F.col("component_id")).select("doc_id").distinct()
    # rows without an id meet no key, so they needn't gather in one task
    named = docs.where(F.col("doc_id").isNotNull()).join(gone, "doc_id", "left_anti").select(*docs.columns)
    return named.unionByName(docs.where(F.col("doc_id").isNull()))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return _cut(docs, decontaminate.hits(docs, read_table(spark, sf_dir, "benchmark"), cut=True), F.size("hit_spans") > 0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, tokenizer_path())


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", keep_quality),
    ("lines", dedup_lines),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_benchmark),
    ("packing", pack),
]

#: Training, perfect hashing of a text's lines after training, and packing have no SQL; tests hold the stages against brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; what a stage returns is written to the shared folder before the next reads it."""
    docs, before = read_table(spark, sf_dir, "documents"), []
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
        dropped(*before)
        before = [docs]
    return STAGES[-1][1](spark, docs, sf_dir)
