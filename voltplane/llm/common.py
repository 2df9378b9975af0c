"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A-Z to a-z and every separator of `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+` to a blank, for UTF-8 bytes.
ALNUM_TABLE = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256))
#: The characters that `[\x20\x09-\x0D]` matches.
BLANKS = " \t\n\x0b\x0c\r"
#: How many bytes of a text are cut into words at a time.
CHUNK = 4 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Above this an estimate is no estimate: a plan without statistics, or a product of two sides of a join.
NO_ESTIMATE = 1 << 52


def input_bytes(df: DataFrame) -> int:
    """What the optimizer takes for the size of the frame's input; for files, their bytes, without a job. Without an estimate, the bytes are counted."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size < NO_ESTIMATE:
        return size
    widths = [F.coalesce(F.octet_length(c), F.lit(0)) if kind in ("string", "binary") else F.lit(8) for c, kind in df.dtypes]
    return int(df.agg(F.coalesce(F.sum(sum(widths, F.lit(0)).cast("long")), F.lit(0))).first()[0])


def pieces_for(df: DataFrame, piece_bytes: int, least: int = 1) -> int:
    """How many pieces of about piece_bytes of input the frame divides into; grows with the input without a limit."""
    return max(least, -(-input_bytes(df) // piece_bytes))


def scratch_dir(spark: SparkSession) -> str:
    """A new folder below spark.checkpoint.dir, which all executors share; only where that is unset (local tests), below a temporary folder."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = f"file://{tempfile.gettempdir()}/checkpoints"
    return f"{base.rstrip('/')}/voltplane/{uuid.uuid4().hex}"


def _folder(spark: SparkSession, path: str):
    """The file system and the path of a folder."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def written(df: DataFrame) -> DataFrame:
    """The frame, written to the shared folder and read again: it cuts the lineage and survives lost executors.

    The folder goes when the application ends; `dropped` takes it away before.
    """
    spark = df.sparkSession
    path = scratch_dir(spark)
    files, at = _folder(spark, path)
    files.deleteOnExit(at)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._scratch = path
    return out


def dropped(*frames: DataFrame) -> None:
    """Deletes the folders of frames that `written` has returned. Nothing may read them any more."""
    for df in frames:
        files, at = _folder(df.sparkSession, df._scratch)
        files.delete(at, True)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Gives what a task's arrays took back to the system: Spark keeps the Python worker, with all it holds, for other tasks."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch, text_col: str, rows: int = 1024, size: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """Parts of a batch: each of at most so many rows, and of at most so many bytes of text or of one row."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(text_col)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    first = 0
    while first < batch.num_rows:
        before = ends[first - 1] if first else 0
        last = max(first + 1, min(first + rows, int(np.searchsorted(ends, before + size, "right"))))
        yield batch.slice(first, last - first)
        first = last


def in_parts(make: Callable[[], Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]]], text_col: str, rows: int = 1024, size: int = 1 << 20):
    """A function for mapInArrow: make() is called once a task, what it returns once for each of the slices of the batches."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = make()
        for batch in batches:
            for part in slices(batch, text_col, rows, size):
                yield from apply(part)
        del apply
        release()

    return run


def in_groups(apply: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """The function for applyInArrow, with what it took given back after each group."""

    def run(table: pa.Table) -> pa.Table:
        out = apply(table)
        release()
        return out

    return run


def free_name(df_columns: list[str], name: str) -> str:
    """The name, with underscores before it until no column has it."""
    taken = {c.lower() for c in df_columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def utf8(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "surrogatepass")


def cut_at_blanks(data: bytes, most: int = CHUNK) -> Iterator[bytes]:
    """Parts of the data of about most bytes, cut at blanks only, so that a long text never becomes one list of words."""
    at = 0
    while len(data) - at > most:
        end = data.find(b" ", at + most)
        if end < 0:
            break
        yield data[at:end]
        at = end
    yield data[at:] if at else data


def pack(values: np.ndarray) -> bytes:
    return np.ascontiguousarray(values).tobytes()


def binary_column(parts: list[bytes]) -> pa.Array:
    return pa.array(parts, pa.binary())


def segment_starts(lengths: np.ndarray) -> np.ndarray:
    """Where each of the segments of these lengths starts when they lie end to end."""
    out = np.zeros(len(lengths), np.int64)
    np.cumsum(lengths[:-1], out=out[1:])
    return out


def ranges(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers start .. start+length-1 of each range, end to end."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    keep = lengths > 0
    starts, lengths = starts[keep].astype(np.int64), lengths[keep].astype(np.int64)
    steps = np.ones(total, np.int64)
    steps[0] = starts[0]
    ends = np.cumsum(lengths)[:-1]
    steps[ends] = starts[1:] - (starts[:-1] + lengths[:-1] - 1)
    return np.cumsum(steps)
