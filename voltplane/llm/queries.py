"""The corpus queries: name -> function of (spark, sf_dir), and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import decontaminate, lexical_search, line_dedup, ngram_join
from .common import read_table


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import dedup_lines, report

    return report(dedup_lines(read_table(spark, sf_dir, "documents").select("doc_id", "text")))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .license_scan import report

    return report(read_table(spark, sf_dir, "documents"))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import repeated_spans

    return repeated_spans(read_table(spark, sf_dir, "documents"))


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .token_counts import token_counts

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts(docs, tokenizer_path()).drop("text")


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judged

    return judged(read_table(spark, sf_dir, "pages"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path())


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import hits, report

    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return report(hits(docs, read_table(spark, sf_dir, "benchmark")))


def op8_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprints import edited_report

    return edited_report(read_table(spark, sf_dir, "documents"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import report

    return report(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import jaccard_components

    return jaccard_components(read_table(spark, sf_dir, "documents"))


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whitened

    return whitened(read_table(spark, sf_dir, "embeddings"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.ranked(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def op13_online_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .online_packing import pack_online

    return pack_online(read_table(spark, sf_dir, "documents"), tokenizer_path())


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_dedup": op1_line_dedup,
    "op2_license_scan": op2_license_scan,
    "op3_suffix_array_dedup": op3_suffix_array_dedup,
    "op4_token_counts": op4_token_counts,
    "op5_url_filter": op5_url_filter,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_decontaminate": op7_decontaminate,
    "op8_document_fingerprints": op8_document_fingerprints,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_ngram_join": op10_ngram_join,
    "op11_whitening": op11_whitening,
    "op12_lexical_search": op12_lexical_search,
    "op13_online_packing": op13_online_packing,
}

SQL: dict[str, str] = {"op1_line_dedup": line_dedup.SQL, "op7_decontaminate": decontaminate.SQL, "op10_ngram_join": ngram_join.SQL, "op12_lexical_search": lexical_search.SQL}
