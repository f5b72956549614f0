"""Training sequences of one length, packed by best fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tokens import Ids, table
from .workers import give_back, tidy


class OpenWindows:
    """Open windows by what is left in them: a segment tree over the remaining capacities 0..capacity.

    A leaf holds the windows with exactly that much left, an inner node tells whether any lies below it;
    the tightest window that takes a piece is found in one walk up and down.
    """

    def __init__(self, capacity: int):
        self.leaves = 1 << capacity.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _add(self, left: int, by: int) -> None:
        node = self.leaves + left
        while node:
            self.count[node] += by
            node >>= 1

    def put(self, window: int, left: int) -> None:
        self.windows[left].append(window)
        self._add(left, 1)

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with least room of at least ``need``, and that room."""
        node = self.leaves + need
        if not self.count[node]:
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.count[2 * node] else 2 * node + 1
        left = node - self.leaves
        self._add(left, -1)
        return self.windows[left].pop(), left


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Window number and offset of each piece; ties keep the given order."""
    window, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_windows, opened = OpenWindows(capacity), 0
    for i in np.argsort(-lengths, kind="stable"):
        need = int(lengths[i])
        found = open_windows.take(need)
        if found is None:
            found, opened = (opened, capacity), opened + 1
        window[i], offset[i] = found[0], capacity - found[1]
        if found[1] > need:
            open_windows.put(found[0], found[1] - need)
    return window, offset


def _packed(path: str, capacity: int, end_id: int, block: int, cached: int):
    end = np.array([end_id], "<u4").tobytes()

    def emit(rows: list[tuple], first: int) -> tuple[pa.RecordBatch, int]:
        start, length = np.array([r[1] for r in rows]), np.array([r[2] for r in rows])
        window, offset = best_fit(length, capacity)
        columns = [[r[0] for r in rows], start, length, [r[3] for r in rows], [r[4] for r in rows], window + first, offset]
        names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names), first + int(window.max()) + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, rows = table(Ids, path, cached), []
        sequence = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for doc, own in zip(batch.column(0).to_pylist(), ids.of(texts), strict=True):
                own = own.astype("<u4").tobytes() + end
                total = len(own) // 4
                for start in range(0, total, capacity):
                    part = own[4 * start : 4 * (start + capacity)]
                    rows.append((doc, start, len(part) // 4, zlib.crc32(part), total))
            # what the last texts took goes back now: two tasks share an executor
            give_back()
            if len(rows) >= block:
                out, sequence = emit(rows, sequence)
                rows = []
                yield out
        if rows:
            yield emit(rows, sequence)[0]

    return tidy(run, keeps=True)


def pack(
    docs: DataFrame,
    path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = 4096,
    end_id: int = 2,
    block: int = 200_000,
    cached: int = 600_000,
) -> DataFrame:
    """``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` per piece of a document.

    A document is its token ids and ``end_id``. One longer than ``capacity`` is cut into full windows
    and a remainder; remainders and short documents are packed by best fit decreasing. Each task packs
    what it reads, in blocks of about ``block`` pieces, so nothing is shuffled, memory does not grow
    with the table, and only the last windows of a block stay partly empty. A retried task gives the
    same sequences: their ids are made of the partition number and a running number.

    NULL and empty texts are a document of ``end_id`` alone. Repeated rows are packed as often as they
    occur, a NULL id stays NULL, other columns are not read. An empty table gives an empty result.
    """
    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    read = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return read.mapInArrow(_packed(path, capacity, end_id, block, cached), schema)
