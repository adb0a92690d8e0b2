"""Packing documents into sequences of a fixed window by best-fit decreasing, with hardly any padding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from revrecon.llm.common import slices, table, text_of
from revrecon.llm.tokens import reader, vocabulary_path

WINDOW = 4096
#: Ids that a task holds before it packs them: memory stays the same whatever the input.
HELD = 1 << 20


class OpenWindows:
    """Windows with room left: a segment tree over remaining capacities finds the tightest that fits."""

    def __init__(self, window: int):
        self.leaves = 1 << window.bit_length()
        self.filled = [0] * (2 * self.leaves)
        self.at: list[list[int]] = [[] for _ in range(window + 1)]

    def add(self, room: int, name: int) -> None:
        self.at[room].append(name)
        node = room + self.leaves
        while node:
            self.filled[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The window with the least room of at least ``need``, removed; None where none has it."""
        filled, node = self.filled, need + self.leaves
        while not filled[node]:
            while node & 1:
                node >>= 1
                if node <= 1:
                    return None
            if node <= 1:
                return None
            node += 1
        while node < self.leaves:
            node *= 2
            if not filled[node]:
                node += 1
        room = node - self.leaves
        name = self.at[room].pop()
        while node:
            filled[node] -= 1
            node >>= 1
        return room, name


def best_fit_decreasing(lengths: list[int], window: int) -> list[list[int]]:
    """Indices of the pieces in each window; no piece is longer than the window."""
    opened, windows = OpenWindows(window), []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        found = opened.take(lengths[i])
        room, name = found or (window, len(windows))
        if found is None:
            windows.append([])
        windows[name].append(i)
        if room > lengths[i]:
            opened.add(room - lengths[i], name)
    return windows


class Packer:
    """One task's pieces. A piece is (document, start, ids)."""

    def __init__(self, window: int, first: int):
        self.window, self.next, self.rows = window, first, []
        self.waiting: list[tuple] = []
        self.held = 0

    def put(self, pieces: list[tuple]) -> None:
        offset = 0
        for doc, start, ids in pieces:
            self.rows.append((*doc, start, len(ids), ids.astype("<u4").tobytes(), self.next, offset))
            offset += len(ids)
        self.next += 1

    def add(self, doc: tuple, ids: np.ndarray) -> None:
        for start in range(0, len(ids), self.window):
            piece = (doc, start, ids[start : start + self.window])
            if len(piece[2]) == self.window:
                self.put([piece])
            else:
                self.waiting.append(piece)
                self.held += len(piece[2])

    def pack(self, last: bool) -> None:
        """Closes windows; what is in windows that are not nearly full waits for more, or at the end is cut to fit."""
        waiting, self.waiting, self.held = self.waiting, [], 0
        for names in best_fit_decreasing([len(p[2]) for p in waiting], self.window):
            pieces = [waiting[i] for i in names]
            n = sum(len(p[2]) for p in pieces)
            if n >= self.window - self.window // 128:
                self.put(pieces)
            else:
                self.waiting += pieces
                self.held += n
        if last or self.held > HELD // 2:
            self.cut()

    def cut(self) -> None:
        """The waiting pieces end to end, cut at full windows; the rest, under one window, at powers of two."""
        left, queue = self.held, [*reversed(self.waiting)]
        self.waiting, self.held = [], 0
        while left:
            size = self.window if left >= self.window else 1 << (left.bit_length() - 1)
            left, need, pieces = left - size, size, []
            while need:
                doc, start, ids = queue.pop()
                if len(ids) > need:
                    queue.append((doc, start + need, ids[need:]))
                    ids = ids[:need]
                pieces.append((doc, start, ids))
                need -= len(ids)
            self.put(pieces)


def pack(docs: DataFrame, end_id: int = 2, window: int = WINDOW, vocabulary: str | None = None) -> DataFrame:
    """Pieces of documents in sequences: doc_id, doc_tokens, start, length, ids (little-endian u32), sequence_id, offset.

    Each task tokenises the documents of its own partition and packs them there, ``HELD`` ids at a time, so nothing is
    shuffled and no task holds more than that. Overlong documents are first cut into full windows. Windows that stay
    open wait for the next lot; at the end of the task the rest is cut into full windows and, under one window, into
    sequences whose lengths are powers of two, which need no padding.

    A null or empty text is a document of the end id alone. Repeated rows are packed once each. An empty table gives no
    rows. Only doc_id and text are read, so other columns may have any name.
    """
    path = vocabulary or vocabulary_path()

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        read, packer = reader(path), Packer(window, TaskContext.get().partitionId() << 40)
        names = ["doc_id", "doc_tokens", "start", "length", "ids", "sequence_id", "offset"]

        def flush() -> pd.DataFrame:
            rows, packer.rows = packer.rows, []
            out = pd.DataFrame(rows, columns=names)
            return out.assign(doc_id=out["doc_id"].astype("Int64"))

        for pdf in slices(batches, "text"):
            for doc_id, ids in zip(pdf["doc_id"], read.encode(pdf["text"].tolist()), strict=True):
                ids = np.append(ids.astype("<u4"), np.uint32(end_id)).astype("<u4")
                packer.add((None if pd.isna(doc_id) else int(doc_id), len(ids)), ids)
                if packer.held >= HELD:
                    packer.pack(False)
            if packer.rows:
                yield flush()
        packer.pack(True)
        if packer.rows:
            yield flush()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    return rows.mapInPandas(
        work, "doc_id long, doc_tokens long, start long, length long, ids binary, sequence_id long, offset long"
    )


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096."""
    return pack(table(spark, sf_dir, "documents")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
