"""Packing token sequences: sum-of-squares online packing over a level array.

Windows hold `capacity` tokens. A document's full windows are cut off first; the rest
goes to the fill level that makes the sum of squared counts of partially filled windows
smallest. What stays open at the end (or beyond `max_open` windows) is closed by moving
pieces of the emptiest windows into the gaps of the fullest, cutting them where needed,
so a task leaves at most one window short.
"""

from __future__ import annotations

import zlib
from collections import deque

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from paytide.llm.frames import narrowed
from paytide.llm.tokens import encoded_slices

PIECES = (
    "start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


class Packer:
    """Packs one task's documents. Memory: the ids of at most `max_open` open windows."""

    def __init__(self, capacity: int, max_open: int, first_sequence: int):
        self.capacity = capacity
        self.max_open = max_open
        self.next = first_sequence
        self.counts = np.zeros(capacity + 1, np.int64)  # open windows by fill level
        self.levels: dict[int, deque] = {}  # level -> windows, each a list of pieces
        self.open = 0
        self.out: list[tuple] = []

    def add(self, doc, ids: np.ndarray) -> None:
        total, start = len(ids), 0
        while total - start >= self.capacity:
            piece = (doc, start, ids[start : start + self.capacity], total)
            self._close([piece])
            start += self.capacity
        if start < total:
            # A copy, so that an open window does not keep the whole batch alive.
            self._place((doc, start, ids[start:].copy(), total))

    def _best_level(self, size: int) -> int:
        """The level to put `size` tokens on; 0 opens a window."""
        n, top = self.counts, self.capacity - size
        change = 2 * (n[size : self.capacity + 1] - n[: top + 1]) + 2
        change[top] = 1 - 2 * n[top]  # fills a window to the brim
        change[0] = 2 * n[size] + 1
        usable = n[: top + 1] > 0
        usable[0] = True
        change = np.where(usable, change, np.iinfo(np.int64).max)
        # Of equal choices the fullest window is taken.
        return top - int(np.argmin(change[::-1]))

    def _place(self, piece: tuple) -> None:
        size = len(piece[2])
        level = self._best_level(size)
        window = self._take(level) if level else []
        window.append(piece)
        if level + size == self.capacity:
            self._close(window)
        else:
            self._put(level + size, window)
            if self.open > self.max_open:
                self.drain(self.max_open // 2)

    def _take(self, level: int) -> list:
        self.counts[level] -= 1
        self.open -= 1
        return self.levels[level].popleft()

    def _put(self, level: int, window: list) -> None:
        self.counts[level] += 1
        self.open += 1
        self.levels.setdefault(level, deque()).append(window)

    def _close(self, window: list) -> None:
        at = 0
        for doc, start, ids, total in window:
            crc = zlib.crc32(np.ascontiguousarray(ids, "<u4"))
            self.out.append((doc, start, len(ids), crc, total, self.next, at))
            at += len(ids)
        self.next += 1

    def drain(self, keep: int = 0) -> None:
        """Close windows until `keep` are open: the emptiest fill the fullest."""
        while self.open > keep:
            fullest = int(np.flatnonzero(self.counts)[-1])
            window, level = self._take(fullest), fullest
            while level < self.capacity and self.open:
                emptiest = int(np.flatnonzero(self.counts)[0])
                donor, gap = self._take(emptiest), self.capacity - level
                while donor and gap:
                    doc, start, ids, total = donor.pop()
                    if len(ids) > gap:
                        donor.append((doc, start, ids[:-gap], total))
                        start, ids = start + len(ids) - gap, ids[-gap:]
                    window.append((doc, start, ids, total))
                    level += len(ids)
                    gap -= len(ids)
                if donor:
                    self._put(sum(len(p[2]) for p in donor), donor)
            self._close(window)

    def taken(self) -> list[tuple]:
        out, self.out = self.out, []
        return out


def pack(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str = "byte_bpe_50k.json",
    capacity: int = 2048,
    end_id: int = 1,
    max_open: int = 2048,
) -> DataFrame:
    """Pack all documents into windows of `capacity` tokens: one row per piece.

    Columns: `doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`. A
    document is its ids and then `end_id`; a null or empty text is `end_id` alone, and a
    repeated row is packed again. A piece is `length` ids from the document's `start`-th
    on, at `offset` of its window. Every task packs what it scans, so nothing is
    shuffled; a task that runs again yields another complete packing of its rows. A
    window's number is the task's partition in the upper bits and a counter below.
    Each task may leave one window short; `coalesce` the input to have fewer of them.
    """

    def run(batches):
        packer = Packer(capacity, max_open, TaskContext.get().partitionId() << 40)
        for batch in batches:
            docs = batch["doc_id"].to_pylist()
            for lo, _, _, counts, ids in encoded_slices(batch["text"], vocabulary, False):
                at = 0
                for i, n in enumerate(counts):
                    own = np.append(ids[at : at + n], np.uint32(end_id))
                    packer.add(docs[lo + i], own)
                    at += n
                if len(packer.out) > 20_000:
                    yield table(packer.taken())
        packer.drain()
        yield table(packer.taken())

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True)) if rows else [()] * 7
        return pa.RecordBatch.from_arrays(
            [pa.array(columns[0], arrow_id), *[pa.array(c, pa.int64()) for c in columns[1:]]],
            names=["doc_id", *[x.split()[0] for x in PIECES.split(", ")]],
        )

    from pyspark.sql.pandas.types import to_arrow_type

    rows = narrowed(df, doc_id=id_col, text=text_col)
    kind = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(kind)
    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, {PIECES}")
