"""Named queries over the shared test tables, each with the DuckDB SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}

#: Measured points: card = event type, segment = user, t_us = microseconds.
EVENTS_SQL = "e AS (SELECT event_id, event_type AS card, user_id AS segment, epoch_us(ts) AS t_us, value, props FROM events)"
#: Spectra: segment = supplier, a card for every fifth of them, a frequency step a month.
POINTS_SQL = (
    "p AS (SELECT l_orderkey AS point_id, l_linenumber AS line, l_suppkey AS segment, CAST(l_suppkey % 5 AS BIGINT) AS card, "
    "CAST((year(l_shipdate) - 1995) * 12 + month(l_shipdate) AS DOUBLE) AS freq_hz, l_extendedprice / 1000 AS z_re, -l_quantity * (0.5 + l_discount) AS z_im, "
    "l_quantity AS area, 400 * l_discount AS snr_db, l_tax AS thd, l_returnflag AS flag, l_linestatus AS status FROM lineitem)"
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("card"), F.col("user_id").alias("segment"), micros.alias("t_us"), "value", "props")


def points(spark: SparkSession, sf_dir: str) -> DataFrame:
    step = (F.year("l_shipdate") - 1995) * 12 + F.month("l_shipdate")
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("point_id"),
        F.col("l_linenumber").alias("line"),
        F.col("l_suppkey").alias("segment"),
        (F.col("l_suppkey") % 5).alias("card"),
        step.cast("double").alias("freq_hz"),
        (F.col("l_extendedprice") / 1000).alias("z_re"),
        (-F.col("l_quantity") * (0.5 + F.col("l_discount"))).alias("z_im"),
        F.col("l_quantity").alias("area"),
        (400 * F.col("l_discount")).alias("snr_db"),
        F.col("l_tax").alias("thd"),
        F.col("l_returnflag").alias("flag"),
        F.col("l_linestatus").alias("status"),
    )


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Registers a query; sql sees the common table expressions e and p where it names them."""

    def add(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            import re

            own = re.sub(r"^\s*WITH\s+", "", sql)
            heads = [x for x, letter in ((EVENTS_SQL, "e"), (POINTS_SQL, "p")) if re.search(rf"\b(?:FROM|JOIN|,)\s+{letter}\b", sql)]
            SQL[name] = (f"WITH {', '.join(heads)}{', ' if own != sql else ' '}{own}" if heads else sql).strip()
        return f

    return add


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles rounded, so that the order of a sum doesn't show."""
    return df.select(*[F.round(c, digits).alias(c) if kind == "double" else F.col(c) for c, kind in df.dtypes])
