"""Binary recordings as a Spark data source: one row a chunk of a channel.

The file begins with a text header of `|KEY,a,b,...;` records and goes on with little-endian frames, a value a channel. NT holds the start. Three dialects are read:

* plain: `|CS,<bytes>;` ends the header. CD holds the sample interval, CR the number of channels, CN one name a channel in order; values are float32;
* packed: `|CS,<n>,<bytes>,` ends it. CD's second field is the interval, CR's second the number of channels, and one CP holds all names, each with a type and a length before it. Values are
  float32. The payload is what the file holds, as these headers state half of it. CR's further numbers are a factor and an offset, which are handed on but not applied;
* by channel: as packed, but a CN of seven fields or more, the seventh the name, and a CD, the third field the interval, for each channel. They must agree. CP's fourth field is the bytes of a value,
  4 or 8.

Cb's eleventh field, if there, is the time of the first sample. A payload that is cut off keeps its whole frames; a header that contradicts itself is an error.

    spark.dataSource.register(RecordingSource)
    spark.read.format("recording").option("chunk", 65536).option("channels", "1,2,UC3").load("/data/*.DAT")

Paths are local or URIs of any store that pyarrow knows (s3, gs, hdfs, ...), with wildcards in the last part. Files are cut into ranges of bytes by
their sizes alone; the task of a range reads the header and those chunks that begin in it. Only the named channels are kept, though a frame is read
whole, as the channels of a frame lie together.

`index` tells what the headers of many files say, for a table that is written once. `read_chosen` reads the files of those of its rows that a query keeps: filters reach the table as any other, and
files beyond them aren't opened. (Filters aren't pushed into the source itself: Spark keeps what it has pushed with the frame, so a frame that is used twice with two filters would give both
uses the rows of one.)
"""

from __future__ import annotations

import fnmatch
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyarrow import fs as stores
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "path string, channel string, role string, fs double, start string, first_sample long, samples array<float>, x_offset double, factor double, offset double"
INDEX = "path string, n_bytes long, start string, fs double, n_frames long, x_offset double, channels array<string>"
_RECORD = re.compile(rb"\|([A-Z][A-Za-z]),([^;]*);")
_PAYLOAD = re.compile(rb"\|CS,(?:(\d+);|\d+,\s*(\d+),)")


@dataclass
class Header:
    interval: float
    channels: list[str]
    start: str
    #: Where the payload begins.
    at: int
    n_frames: int
    #: Bytes of a value.
    width: int = 4
    x_offset: float = 0.0
    #: As the header states them; samples stay as they are stored.
    factor: float = 1.0
    offset: float = 0.0


def _number(text: str) -> float | None:
    try:
        return float(text)
    except ValueError:
        return None


def _common(values: list[float | None], what: str) -> float:
    """The one value that all channels state."""
    known = [v for v in values if v is not None]
    if not known:
        raise ValueError(f"no {what}")
    if max(known) > min(known) * 1.000001:
        raise ValueError(f"channels with different {what}: {min(known):g} to {max(known):g}")
    return known[0]


def parse_header(head: bytes, file_size: int) -> Header:
    """The header of any of the dialects that the module's text describes."""
    payload = _PAYLOAD.search(head)
    if not payload:
        raise ValueError("no recording header")
    found: dict[str, list[list[str]]] = {}
    for m in _RECORD.finditer(head[: payload.start()]):
        found.setdefault(m[1].decode(), []).append([x.strip() for x in m[2].decode("latin-1").split(",")])
    if "CD" not in found:
        raise ValueError("no recording header")
    declared, here = int(payload[1] or payload[2]), max(0, file_size - payload.end())
    each = [c for c in found.get("CN", []) if len(c) > 6]
    packed = found.get("CP", [[]])[0]
    width, whole = 4, min(declared, here)
    if payload[1]:
        names = [c[0] for c in found.get("CN", [])]
        interval = _number(found["CD"][0][0])
    elif each:
        names = [c[6] for c in each]
        interval = _common([_number(c[2]) if len(c) > 2 else None for c in found["CD"]], "sample intervals")
        width = int(packed[3]) if len(packed) > 3 else 8
    else:
        names = [packed[i + 2] for i in range(4, len(packed) - 2, 3)]
        interval = _number(found["CD"][0][1]) if len(found["CD"][0]) > 1 else None
        # these state half of what they hold
        whole = here
    if not interval or interval <= 0:
        raise ValueError("the sample interval must be positive")
    if width not in (4, 8):
        raise ValueError(f"values of {width} bytes")
    stated = found.get("CR", [[]])[0]
    count = len(names) if each else int(stated[0] if payload[1] else stated[1]) if stated else 0
    if count != len(names) or not count:
        raise ValueError(f"{count} channels, but {len(names)} names")
    if declared % (width * count):
        raise ValueError("the payload holds no whole number of frames")
    scale = [_number(x) for x in stated[2:]] if not payload[1] and not each else []
    scale = [x for x in scale if x is not None]
    places = [_number(x) for x in found.get("Cb", [[]])[0][1:]]
    shift = places[9] if len(places) > 9 and places[9] is not None and abs(places[9]) < 1e6 else 0.0
    start = ",".join(found.get("NT", [[""]])[0])
    return Header(interval, names, start, payload.end(), whole // (width * count), width, shift, scale[0] if scale else 1.0, scale[1] if len(scale) > 1 else 0.0)


def _store(path: str) -> tuple[stores.FileSystem, str]:
    return stores.FileSystem.from_uri(path) if re.match(r"[a-z0-9]+:/", path) else (stores.LocalFileSystem(), path)


def sizes(path: str) -> list[tuple[str, int]]:
    """(path, bytes) of the files that a path with wildcards in its last part stands for, by one listing of its folder."""
    store, inner = _store(path)
    folder, _, name = inner.rpartition("/")
    if not any(c in name for c in "*?["):
        return [(path, store.get_file_info(inner).size)]
    start = path[: len(path) - len(name)]
    found = store.get_file_info(stores.FileSelector(folder or "/"))
    return sorted((start + f.base_name, f.size) for f in found if f.is_file and fnmatch.fnmatchcase(f.base_name, name))


def read_header(path: str, most: int = 1 << 20) -> Header:
    store, inner = _store(path)
    with store.open_input_file(inner) as f:
        return parse_header(f.read(most), f.size())


def role(name: str) -> str:
    if re.fullmatch(r"-?\d+", name.strip()):
        return "segment"
    if name.strip().upper().startswith("UC"):
        return "cell_voltage"
    return "temperature" if name.strip().lower().startswith("temp") else "other"


def write_recording(path: str, names: list[str], samples: np.ndarray, fs: float, start: str = "") -> None:
    """samples: (frames, channels)."""
    data = np.ascontiguousarray(samples, "<f4").tobytes()
    head = f"|CD,{1 / fs!r};|CR,{len(names)};|NT,{start};" + "".join(f"|CN,{n};" for n in names) + f"|CS,{len(data)};"
    store, inner = _store(path)
    with store.open_output_stream(inner) as f:
        f.write(head.encode("latin-1") + data)


@dataclass
class Span(InputPartition):
    path: str
    #: bytes
    begin: int
    end: int


class RecordingReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.path = options["path"]
        self.chunk = int(options.get("chunk", 65536))
        self.per_task = max(1, int(options.get("chunksPerTask", 64)))
        self.channels = [c.strip() for c in options["channels"].split(",")] if "channels" in options else None

    def wanted(self, channel: str) -> bool:
        return self.channels is None or channel in self.channels

    def partitions(self) -> list[Span]:
        # as many bytes as the chunks of one channel take
        step = max(self.per_task * self.chunk * 4, 1 << 10)
        return [Span(path, at, min(at + step, size)) for path, size in sizes(self.path) for at in range(0, size, step)]

    def read(self, partition: Span):
        store, inner = _store(partition.path)
        with store.open_input_file(inner) as f:
            h = parse_header(f.read(1 << 20), f.size())
            count = len(h.channels)
            wanted = [i for i, c in enumerate(h.channels) if self.wanted(c)]
            stride = h.width * count * self.chunk
            # the first chunk that begins in the span
            k = max(0, -(-(partition.begin - h.at) // stride))
            while wanted and h.at + k * stride < partition.end and k * self.chunk < h.n_frames:
                first = k * self.chunk
                n = min(self.chunk, h.n_frames - first)
                f.seek(h.at + k * stride)
                block = np.frombuffer(f.read(h.width * count * n), f"<f{h.width}").reshape(n, count)
                for i in wanted:
                    column = pa.array([np.ascontiguousarray(block[:, i], np.float32)], pa.list_(pa.float32()))
                    name = h.channels[i]
                    head = [(partition.path, pa.string()), (name, pa.string()), (role(name), pa.string()), (1 / h.interval, pa.float64()), (h.start, pa.string()), (first, pa.int64())]
                    tail = [(h.x_offset, pa.float64()), (h.factor, pa.float64()), (h.offset, pa.float64())]
                    yield pa.RecordBatch.from_arrays([*(pa.array([x], t) for x, t in head), column, *(pa.array([x], t) for x, t in tail)], names=[c.split(" ")[0] for c in SCHEMA.split(", ")])
                k += 1


class RecordingSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "recording"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> RecordingReader:
        return RecordingReader(self.options)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(RecordingSource)


def index(spark: SparkSession, path: str) -> DataFrame:
    """(path, n_bytes, start, fs, n_frames, x_offset, channels): a row a file with a header, read in tasks; others are left out. Write it as a table, and choose files from there."""

    def look(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            rows = []
            for p, n in zip(pdf.path, pdf.n_bytes, strict=True):
                try:
                    h = read_header(p)
                except ValueError:
                    continue
                rows.append((p, n, h.start, 1 / h.interval, h.n_frames, h.x_offset, h.channels))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in INDEX.split(", ")])

    return spark.createDataFrame(sizes(path), "path string, n_bytes long").mapInPandas(look, INDEX)


def read_chosen(chosen: DataFrame, channels: list[str] | None = None, chunk: int = 65536, per_task: int = 64) -> DataFrame:
    """The source's rows of the files in chosen (path, n_bytes), rows of index(). Spans of bytes are dealt out, so a large file is many tasks."""
    options = {"path": "", "chunk": str(chunk), "chunksPerTask": str(per_task)} | ({"channels": ",".join(channels)} if channels is not None else {})
    step = max(per_task * chunk * 4, 1 << 10)
    spans = chosen.where(F.col("n_bytes") > 0).select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_bytes") - 1, F.lit(step).cast("long"))).alias("begin"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        reader = RecordingReader(options)
        for batch in batches:
            for path, n, begin in zip(*(batch.column(c).to_pylist() for c in ("path", "n_bytes", "begin")), strict=True):
                yield from reader.read(Span(path, begin, min(begin + step, n)))

    return spans.repartition("path", "begin").mapInArrow(read, SCHEMA)


def missing(wanted: DataFrame, known: DataFrame, on: list[str]) -> DataFrame:
    """The wanted recordings that an index doesn't have."""
    return wanted.join(known.select(*on).distinct(), on, "left_anti")
