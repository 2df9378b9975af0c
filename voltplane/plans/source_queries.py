"""Files that are written from the test tables and read again."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.materialise import files_folder, kept
from ..sources import layouts, mdf4, recordings, texts
from .registry import query, rounded, table

#: Vectors a file.
PER_FILE = 64


def _files(vectors: DataFrame, ending: str, write: Callable[[str, int, np.ndarray], None]) -> DataFrame:
    """(path): a file of each PER_FILE vectors by id, in the shared folder, as write(path, number, vectors by id) makes it."""
    folder = files_folder(vectors.sparkSession)

    def each(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        path = f"{folder}/{key[0]:09d}.{ending}"
        write(path, int(key[0]), np.stack(pdf.sort_values("vec_id").embedding.to_list()))
        return pd.DataFrame({"path": [path]})

    # written once, before anything reads
    return kept(vectors.select("vec_id", "embedding", F.floor(F.col("vec_id") / PER_FILE).alias("_file")).groupBy("_file").applyInPandas(each, "path string"))


@query(
    "mdf4_readings",
    f"""WITH x AS (SELECT vec_id // {PER_FILE} AS file, (vec_id % {PER_FILE}) * 64 + i - 1 AS k, embedding[i]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i))
    SELECT file, 'Voltage' AS channel, 'V' AS unit, count(*) AS n, round(sum(v), 6) AS total, round(sum(v * k * 0.25::DOUBLE), 4) AS moment, max(k) * 0.25::DOUBLE AS last_t FROM x GROUP BY file
    UNION ALL SELECT file, 'Steps', '', count(*), round(sum(1 + 0.5::DOUBLE * (k % 100)), 6), round(sum((1 + 0.5::DOUBLE * (k % 100)) * k * 0.25::DOUBLE), 4), max(k) * 0.25::DOUBLE FROM x GROUP BY file""",
)
def mdf4_readings(spark, d):
    """Vectors end to end as the voltage of MDF 4 files of transposed, deflated blocks, whose bounds cut records."""

    def write(path: str, number: int, vectors: np.ndarray) -> None:
        k = np.arange(vectors.size)
        columns = {"t": k * 0.25, "Voltage": vectors.ravel().astype("<f4"), "Steps": (k % 100).astype("<u2")}
        mdf4.write_mdf4(path, columns, block_bytes=5000, way=1, units={"Voltage": "V"}, linear={"Steps": (1.0, 0.5)})

    readings = mdf4.tall(mdf4.read_mdf4(_files(table(spark, d, "embeddings"), "mf4", write)))
    name = F.regexp_extract("path", r"(\d+)\.mf4$", 1).cast("long").alias("file")
    out = readings.groupBy(name, "channel", "unit").agg(F.count("value").alias("n"), F.round(F.sum("value"), 6).alias("total"), F.round(F.sum(F.col("value") * F.col("t")), 4).alias("moment"), F.max("t").alias("last_t"))
    return out


@query(
    "recordings_chosen",
    f"""WITH x AS (SELECT vec_id // {PER_FILE} AS file, vec_id % 8 AS channel, embedding[i]::DOUBLE AS v FROM embeddings, (SELECT unnest(range(1, 65)) AS i))
    SELECT file, channel::VARCHAR AS channel, count(*) AS n_samples, round(sum(v), 6) AS total FROM x WHERE file % 3 = 1 AND channel IN (2, 5) AND file < (SELECT (max(vec_id) + 1) // {PER_FILE} FROM embeddings) GROUP BY ALL""",
)
def recordings_chosen(spark, d):
    """Eight vectors at a time as the channels of recordings; every third full file and two of its channels are chosen from the index."""

    def write(path: str, number: int, vectors: np.ndarray) -> None:
        whole = vectors[: len(vectors) // 8 * 8].reshape(-1, 8, 64).transpose(0, 2, 1).reshape(-1, 8)
        recordings.write_recording(path, [str(c) for c in range(8)], whole, 100.0, str(number) if len(vectors) == PER_FILE else "part")

    files = _files(table(spark, d, "embeddings"), "dat", write)
    folder = files.agg(F.max(F.regexp_extract("path", "^(.*)/", 1))).first()[0]
    known = recordings.index(spark, f"{folder}/*.dat")
    chosen = recordings.read_chosen(known.where("start <> 'part' and cast(start as long) % 3 = 1"), ["2", "5"], chunk=200)
    samples = chosen.select(F.col("start").cast("long").alias("file"), "channel", F.explode("samples").alias("v"))
    return rounded(samples.groupBy("file", "channel").agg(F.count(F.lit(1)).alias("n_samples"), F.sum(F.col("v").cast("double")).alias("total")))


@query(
    "file_layouts",
    f"SELECT DISTINCT vec_id // {PER_FILE} AS file, 32 AS record, '<f4' AS type, 0 AS first, true AS clear FROM embeddings",
)
def file_layouts(spark, d):
    """Running sums of vectors as records of eight single floats, in files that say nothing about it; their layout is found from the bytes."""

    def write(path: str, number: int, vectors: np.ndarray) -> None:
        layouts.write_bytes(path, np.cumsum(vectors.reshape(-1, 8).astype(float), axis=0).astype("<f4").tobytes())

    files = _files(table(spark, d, "embeddings"), "bin", write)
    folder = files.agg(F.max(F.regexp_extract("path", "^(.*)/", 1))).first()[0]
    found = layouts.layouts(layouts.listed(spark, f"{folder}/*.bin"), longest=256)
    return found.select(F.regexp_extract("path", r"(\d+)\.bin$", 1).cast("long").alias("file"), "record", "type", "first", F.col("reason").isNull().alias("clear"))


@query(
    "text_lines",
    """WITH f AS (SELECT doc_id // 64 AS file, string_split(string_agg(replace(coalesce(text, ''), chr(13), ' '), chr(10) ORDER BY doc_id), chr(10)) AS l FROM documents GROUP BY ALL),
    x AS (SELECT file, unnest(range(len(l))) AS k, unnest(l) AS line FROM f)
    SELECT file, count(*) AS n_lines, max(k)::INTEGER AS last_line, sum(k * length(line))::BIGINT AS moment, arg_max(length(line), (length(line), -k))::BIGINT AS longest, arg_max(k, (length(line), -k))::INTEGER AS longest_at FROM x GROUP BY file""",
)
def text_lines(spark, d):
    """Documents as text files of 64 each, whose lines are numbered again as they are read by splits."""
    folder = f"{files_folder(spark)}/text"
    docs = table(spark, d, "documents").select(F.floor(F.col("doc_id") / 64).alias("file"), "doc_id", F.translate(F.coalesce("text", F.lit("")), "\r", " ").alias("value"))
    docs.repartition("file").sortWithinPartitions("file", "doc_id").select("file", "value").write.partitionBy("file").text(folder)
    lines = texts.lines(spark, folder).withColumn("file", F.regexp_extract("path", r"file=(\d+)/", 1).cast("long")).withColumn("n", F.length("line").cast("long"))
    longest = F.struct("n", (-F.col("line_no")).alias("k"))
    return lines.groupBy("file").agg(F.count(F.lit(1)).alias("n_lines"), F.max("line_no").alias("last_line"), F.sum(F.col("line_no") * F.col("n")).alias("moment"), F.max(longest)["n"].alias("longest"), (-F.max(longest)["k"]).alias("longest_at"))
