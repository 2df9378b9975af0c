"""MDF 4 files: the pointers are walked once in small tasks, then every data block is read by itself.

    files = listed(spark, "/data/*.mf4")
    read_mdf4(files, ["Current", "Voltage"])

`data_blocks` gives a row for each data block of each file: where it lies, how it is packed, and at which byte of its group's records it begins. These rows are dealt out, and a task holds one block: it
reads the file's channel definitions, undoes deflation and transposition, and completes the record that the block's end cuts through from the blocks after it. Sorted files only (one channel group a
data group), whole-byte integers and floats, without a conversion or with a linear one; anything else is an error that names the channel.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .recordings import _store, sizes

BLOCKS = "path string, data_group long, block long, at long, kind string, first_byte long, n_bytes long, more array<long>"
VALUES = "path string, data_group long, channel string, unit string, first_record long, t array<double>, values array<double>"
#: Types by their number in a channel block (fixed values of the format).
TYPES = {0: "<u", 1: ">u", 2: "<i", 3: ">i", 4: "<f", 5: ">f"}


class Block(NamedTuple):
    kind: str
    links: tuple[int, ...]
    #: Where its data begins, and how long that is.
    data_at: int
    n_data: int


@dataclass
class Channel:
    name: str
    unit: str
    #: 2 and 3: the group's own times.
    kind: int
    type: str
    at: int
    width: int
    offset: float
    factor: float

    def values(self, records: np.ndarray) -> np.ndarray:
        raw = np.ascontiguousarray(records[:, self.at : self.at + self.width]).view(f"{self.type}{self.width}")[:, 0]
        return self.offset + self.factor * raw.astype(float)


def _block(f, at: int) -> Block:
    f.seek(at)
    head = f.read(24)
    if len(head) < 24 or head[:2] != b"##":
        raise ValueError(f"no block at byte {at}")
    size, n = struct.unpack_from("<QQ", head, 8)
    links = struct.unpack(f"<{n}Q", f.read(8 * n))
    return Block(head[2:4].decode("latin-1"), links, at + 24 + 8 * n, size - 24 - 8 * n)


def _data(f, block: Block, most: int | None = None) -> bytes:
    f.seek(block.data_at)
    return f.read(block.n_data if most is None else min(most, block.n_data))


def _text(f, at: int) -> str:
    return _data(f, _block(f, at)).split(b"\0", 1)[0].decode("utf-8", "replace") if at else ""


def _groups(f) -> Iterator[tuple[int, Block, Block | None]]:
    """(place, data group, its channel group)."""
    f.seek(0)
    if f.read(4) != b"MDF ":
        raise ValueError("not an MDF file")
    at = _block(f, 64).links[0]
    while at:
        group = _block(f, at)
        first = _block(f, group.links[1]) if group.links[1] else None
        if first is not None and first.links[0]:
            raise ValueError("unsorted: several channel groups share a data group")
        yield at, group, first
        at = group.links[0]


def _channels(f, group: Block, first: Block) -> tuple[list[Channel], int, int]:
    """The channels of a group, the bytes of a record, and how many records there are."""
    lead = _data(f, group, 1)[0] if group.n_data else 0
    _, cycles, _, _, _, n_data, n_invalid = struct.unpack_from("<QQHHIII", _data(f, first))
    out, at = [], first.links[1]
    while at:
        block = _block(f, at)
        kind, _, number, bit, byte, bits = struct.unpack_from("<BBBBII", _data(f, block))
        name = _text(f, block.links[2])
        if number not in TYPES or bit or bits % 8 or bits // 8 not in (1, 2, 4, 8):
            raise ValueError(f"channel {name}: type {number} of {bits} bits can't be read")
        offset, factor = 0.0, 1.0
        if block.links[4]:
            data = _data(f, _block(f, block.links[4]))
            if data[0] == 1:
                offset, factor = struct.unpack_from("<dd", data, 24)
            elif data[0]:
                raise ValueError(f"channel {name}: conversion {data[0]} can't be applied")
        out.append(Channel(name, _text(f, block.links[6]) if len(block.links) > 6 else "", kind, TYPES[number], lead + byte, bits // 8, offset, factor))
        at = block.links[0]
    return out, lead + n_data + n_invalid, cycles


def _chain(f, at: int) -> Iterator[tuple[int, Block]]:
    """The data blocks that a link leads to, in order."""
    if not at:
        return
    block = _block(f, at)
    if block.kind == "HL":
        yield from _chain(f, block.links[0])
    elif block.kind == "DL":
        while True:
            for link in block.links[1:]:
                if link:
                    yield link, _block(f, link)
            if not block.links[0]:
                return
            block = _block(f, block.links[0])
    elif block.kind in ("DT", "DV", "DZ"):
        yield at, block
    else:
        raise ValueError(f"data block {block.kind} can't be read")


def _unpacked(f, at: int, most: int | None = None) -> bytes:
    """The record bytes of a data block; most: as many from its start, if no transposition has mixed them."""
    block = _block(f, at)
    if block.kind != "DZ":
        return _data(f, block, most)
    data = _data(f, block)
    origin, way, columns = data[:2], data[2], struct.unpack_from("<I", data, 4)[0]
    if origin not in (b"DT", b"DV"):
        raise ValueError(f"deflated block of {origin!r} can't be read")
    raw = zlib.decompress(data[24:])
    if way == 1 and columns > 1:
        rows = len(raw) // columns
        mixed = np.frombuffer(raw, np.uint8, rows * columns).reshape(columns, rows)
        raw = mixed.T.tobytes() + raw[rows * columns :]
    return raw[:most]


def listed(spark: SparkSession, path: str) -> DataFrame:
    """(path): the files that a path with wildcards in its last part stands for."""
    return spark.createDataFrame([(p,) for p, _ in sizes(path)], "path string")


def data_blocks(files: DataFrame) -> DataFrame:
    """One row a data block. files: (path). Only headers and the blocks' own heads are read."""

    def walk(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for path in pdf.path:
                rows = []
                store, inner = _store(path)
                with store.open_input_file(inner) as f:
                    for group, data_group, first in _groups(f):
                        if first is None:
                            continue
                        chain, size = list(_chain(f, data_group.links[2])), _channels(f, data_group, first)[1]
                        lengths = [struct.unpack_from("<Q", _data(f, block, 24), 8)[0] if block.kind == "DZ" else block.n_data for _, block in chain]
                        begins = np.concatenate(([0], np.cumsum(lengths))).astype(int)
                        for k, (at, block) in enumerate(chain):
                            # the blocks that the record at this one's end may go on in
                            last = np.searchsorted(begins, begins[k + 1] + size - 1)
                            rows.append((path, group, k, at, block.kind, int(begins[k]), int(lengths[k]), [x for x, _ in chain[k + 1 : last]]))
                yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in BLOCKS.split(", ")])

    return files.select("path").mapInPandas(walk, BLOCKS)


def read_mdf4(files: DataFrame, channels: list[str] | None = None, tasks: int | None = None) -> DataFrame:
    """(path, data_group, channel, unit, first_record, t, values): one row a channel and data block; t: the group's own times of the same records, null without any.

    channels: names that are kept; the times come with each of them and are no row of their own. Records beyond the number that the file states don't count. tasks: over how many tasks the blocks are dealt.
    """
    blocks = data_blocks(files)
    blocks = blocks.repartition(tasks, "path", "data_group", "block") if tasks else blocks.repartition("path", "data_group", "block")

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            for b in pdf.itertuples(index=False):
                store, inner = _store(b.path)
                with store.open_input_file(inner) as f:
                    group = _block(f, b.data_group)
                    known, size, cycles = _channels(f, group, _block(f, group.links[1]))
                    if not size:
                        continue
                    first = -(-b.first_byte // size)
                    raw = _unpacked(f, b.at)[first * size - b.first_byte :]
                    for at in b.more:
                        if len(raw) % size:
                            raw += _unpacked(f, int(at), size - len(raw) % size)
                n = min(len(raw) // size, max(0, cycles - first))
                if not n:
                    continue
                records = np.frombuffer(raw, np.uint8, n * size).reshape(n, size)
                clock = next((c for c in known if c.kind in (2, 3)), None)
                t = clock.values(records).tolist() if clock else None
                rows = [(b.path, b.data_group, c.name, c.unit, first, t, c.values(records).tolist()) for c in known if c is not clock and (channels is None or c.name in channels)]
                yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in VALUES.split(", ")])

    return blocks.mapInPandas(read, VALUES)


def tall(values: DataFrame) -> DataFrame:
    """(path, channel, unit, record, t, value): one row a reading of read_mdf4()."""
    each = values.select("path", "channel", "unit", "first_record", F.posexplode(F.arrays_zip(F.coalesce("t", F.transform("values", lambda v: F.lit(None).cast("double"))).alias("t"), F.col("values").alias("v"))).alias("_k", "_p"))
    return each.select("path", "channel", "unit", (F.col("first_record") + F.col("_k")).alias("record"), F.col("_p.t").alias("t"), F.col("_p.v").alias("value"))


def encoded(columns: dict[str, np.ndarray], block_bytes: int = 1 << 20, way: int | None = None, units: dict[str, str] | None = None, linear: dict[str, tuple[float, float]] | None = None) -> bytes:
    """A file of one group; the first column is its times. way: None plain, 0 deflated, 1 transposed and deflated. linear: offset and factor of channels, which are stored as given."""
    out = bytearray(b"MDF     4.10    voltplan".ljust(64, b"\0"))

    def add(kind: str, links: list[int], data: bytes) -> int:
        while len(out) % 8:
            out.append(0)
        at = len(out)
        out.extend(b"##" + kind.encode() + bytes(4) + struct.pack("<QQ", 24 + 8 * len(links) + len(data), len(links)) + struct.pack(f"<{len(links)}Q", *links) + data)
        return at

    header = add("HD", [0] * 6, bytes(32))
    names = list(columns)
    width = sum(v.dtype.itemsize for v in columns.values())
    n = len(columns[names[0]]) if names else 0
    records = np.zeros((n, width), np.uint8)
    next_at, byte = 0, width
    numbers = {v: k for k, v in TYPES.items()}
    for i in reversed(range(len(names))):
        v = columns[names[i]]
        byte -= v.dtype.itemsize
        records[:, byte : byte + v.dtype.itemsize] = np.ascontiguousarray(v).view(np.uint8).reshape(n, v.dtype.itemsize)
        kind = (">" if v.dtype.byteorder == ">" else "<") + v.dtype.kind
        name, unit = add("TX", [], names[i].encode() + b"\0"), add("TX", [], (units or {}).get(names[i], "").encode() + b"\0")
        conversion = 0
        if names[i] in (linear or {}):
            conversion = add("CC", [0] * 4, struct.pack("<BBHHHdd", 1, 0, 0, 0, 2, 0, 0) + struct.pack("<dd", *linear[names[i]]))
        next_at = add("CN", [next_at, 0, name, 0, conversion, 0, unit, 0], struct.pack("<BBBBII", 2 if i == 0 else 0, 1 if i == 0 else 0, numbers[kind], 0, byte, 8 * v.dtype.itemsize) + bytes(56))
    group = add("CG", [0, next_at, 0, 0, 0, 0], struct.pack("<QQHHIII", 0, n, 0, 0, 0, width, 0))
    raw, blocks = records.tobytes(), []
    for a in range(0, len(raw), block_bytes):
        part = raw[a : a + block_bytes]
        if way is None:
            blocks.append(add("DT", [], part))
            continue
        packed = part
        if way == 1:
            rows = len(part) // width
            packed = np.frombuffer(part, np.uint8, rows * width).reshape(rows, width).T.tobytes() + part[rows * width :]
        packed = zlib.compress(packed)
        blocks.append(add("DZ", [], b"DT" + struct.pack("<BBIQQ", way, 0, width if way else 0, len(part), len(packed)) + packed))
    chain = add("DL", [0, *blocks], struct.pack("<BBHI", 0, 0, 0, len(blocks)) + bytes(8 * len(blocks)))
    data_group = add("DG", [0, group, chain, 0], bytes(8))
    struct.pack_into("<Q", out, header + 24, data_group)
    return bytes(out)


def write_mdf4(path: str, columns: dict[str, np.ndarray], **how) -> None:
    """encoded() into a file of any store that recordings can be read from."""
    store, inner = _store(path)
    with store.open_output_stream(inner) as f:
        f.write(encoded(columns, **how))
