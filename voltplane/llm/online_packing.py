"""Sum-of-squares online packing of token sequences into windows of one length.

A task packs the documents of its partition as they come, in one pass over the texts and without a shuffle. It keeps an array with the number of its open windows at
each fill level. A document (its ids and the separator) longer than a window is cut into full windows and a rest. A rest goes to the fill level, or to a new window, for
which the sum of the squares of these numbers becomes least; of equal ones to the fullest. That keeps windows at many different levels, so later
documents meet one that they fill up to the end.

The ids of pre-tokens are cached in a worker, at most twice `cache_size` of them, and kept for its next task.

Where many documents have sizes that never meet (say a third of them copies just over half a window), open windows would grow with the input. So at
most `open_windows` are open at once: a document that no open window takes by then is cut, its head fills up a window of the most frequent level, and
its tail goes on as a document of its own. A task thus holds the ids of that many windows and one batch, whatever the number of rows or equal rows.

At the end of the partition what is open is merged: the emptiest windows are cut to fill the fullest. The one window that stays partly filled is cut into sequences whose
lengths are powers of two, which need no padding. So no sequence is padded at all, and pieces beyond one a window of a document only arise where the method has to cut.

Defined results: a null or empty text is the separator alone, one piece of one token. Repeated rows and ids are packed one by one. A sequence's id is that of its task and a number
within it; sequences never span tasks. An empty table has no pieces. Texts are never cut short. Other columns of the input don't enter the result, whatever their names.
"""

from __future__ import annotations

import zlib
from collections import deque
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import release, slices

RESULT = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Piece(NamedTuple):
    doc_id: int | None
    start: int
    #: The packed ids, 4 bytes each.
    ids: bytes
    doc_tokens: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(ids=self.ids[: 4 * at]), self._replace(start=self.start + at, ids=self.ids[4 * at :])


class SquaresPacker:
    """Packs pieces online; sequences that are full are in `done` as lists of pieces, until they are taken from there."""

    def __init__(self, window: int = 1024, open_windows: int = 512):
        if window < 1 or window & (window - 1) or open_windows < 1:
            raise ValueError("a window's length is a power of two, and at least one window is open")
        self.window, self.most = window, open_windows
        #: Open windows at each fill level; levels 0 and window count none.
        self.counts = np.zeros(window + 1, np.int64)
        self.open: dict[int, deque[list[Piece]]] = {}
        self.n_open = 0
        self.done: list[list[Piece]] = []

    def add(self, piece: Piece) -> None:
        """A document; it may be longer than a window."""
        while (size := len(piece.ids) // 4) > self.window:
            head, piece = piece.split(self.window)
            self.done.append([head])
        while size:
            level = self.level_for(size)
            if level is None:
                level = self.window - int(np.argmax(self.counts[::-1]))
                head, piece = piece.split(self.window - level)
                self.put(head, level)
                size = len(piece.ids) // 4
            else:
                self.put(piece, level)
                size = 0

    def level_for(self, size: int) -> int | None:
        """The level, 0 for a new window, for which the sum of squares becomes least; None if no open window takes so much and no more may be opened."""
        if size == self.window:
            return 0
        # level h loses a window and level h + size gains one: 2 * (counts[h + size] - counts[h]) + 2, and one less where the window is full
        here, there = self.counts[1 : self.window - size + 1], self.counts[size + 1 :]
        growth = 2 * (there - here) + 2
        growth[-1] -= 1
        growth = np.where(here > 0, growth, np.iinfo(np.int64).max)
        best = len(growth) - 1 - int(np.argmin(growth[::-1]))
        fits = here[best] > 0
        if self.n_open < self.most and (not fits or 2 * self.counts[size] + 1 < growth[best]):
            return 0
        return best + 1 if fits else None

    def put(self, piece: Piece, level: int) -> None:
        """The piece into a window of this level, the one that has been at it for longest."""
        if level:
            window = self.open[level].popleft()
            self.counts[level] -= 1
        else:
            window = []
            self.n_open += 1
        window.append(piece)
        level += len(piece.ids) // 4
        if level == self.window:
            self.done.append(window)
            self.n_open -= 1
        else:
            self.open.setdefault(level, deque()).append(window)
            self.counts[level] += 1

    def close(self) -> None:
        """Merges what is open, the emptiest windows into the fullest; the rest becomes sequences whose lengths are powers of two."""
        left = deque(w for level in sorted(self.open, reverse=True) for w in self.open[level])
        self.open, self.n_open = {}, 0
        self.counts[:] = 0
        size = lambda window: sum(len(p.ids) for p in window) // 4
        while left:
            window = left.popleft()
            room = self.window - size(window)
            while room and left:
                giver = left[-1]
                piece = giver.pop()
                if len(piece.ids) // 4 > room:
                    piece, rest = piece.split(room)
                    giver.append(rest)
                window.append(piece)
                room -= len(piece.ids) // 4
                if not giver:
                    left.pop()
            if not room:
                self.done.append(window)
                continue
            pieces = deque(window)
            filled = self.window - room
            while filled:
                part = need = 1 << (filled.bit_length() - 1)
                sequence = []
                while need:
                    piece = pieces.popleft()
                    if len(piece.ids) // 4 > need:
                        piece, rest = piece.split(need)
                        pieces.appendleft(rest)
                    sequence.append(piece)
                    need -= len(piece.ids) // 4
                self.done.append(sequence)
                filled -= part


def pack_online(docs: DataFrame, tokenizer: str, window: int = 1024, separator: int = 0, open_windows: int = 512, text_col: str = "text", id_col: str = "doc_id", cache_size: int = 1 << 19) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset. window: a power of two; tokenizer: its file, on every executor."""
    SquaresPacker(window, open_windows)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from .token_counts import worker_ids

        ids, packer, number = worker_ids(tokenizer, cache_size), SquaresPacker(window, open_windows), TaskContext.get().partitionId() << 40
        end = np.array([separator], "<u4").tobytes()

        def finished() -> Iterator[pa.RecordBatch]:
            nonlocal number
            rows = []
            for sequence in packer.done:
                at = 0
                for p in sequence:
                    n = len(p.ids) // 4
                    rows.append((p.doc_id, p.start, n, zlib.crc32(p.ids), p.doc_tokens, number, at))
                    at += n
                number += 1
            packer.done = []
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"])

        for batch in batches:
            for part in slices(batch, "text"):
                for doc_id, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    packed = ids.packed(text) + end
                    packer.add(Piece(doc_id, 0, packed, len(packed) // 4))
                yield from finished()
        packer.close()
        yield from finished()
        del ids, packer
        release()

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(pack, RESULT)
