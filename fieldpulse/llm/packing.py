"""Packing documents into fixed windows by best-fit decreasing.

Overlong documents are first cut into full windows; each full window is a sequence of
its own. What remains of every document is a piece shorter than a window. Pieces are
dealt by hash over partitions of many windows each, sorted there by decreasing length,
and each goes into the open window with the smallest room that still holds it. A
segment tree over remaining room finds that window in logarithmic time: a node holds
how many open windows have a room in its range.

A task streams its sorted pieces and keeps one number per open window, so its memory
does not grow with the texts. Windows left open lose little room because a partition
holds hundreds of windows; the number of partitions follows the size of the texts.
Sequence ids carry the partition in their upper bits, so they need no second pass.

Defined cases: null and empty texts are the end id alone; a document whose length is a
multiple of the window leaves no rest; ties in length are ordered by doc_id, start and
checksum, so a task that is run again packs alike; repeated rows are packed each, and
spread over partitions however many there are; an empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from fieldpulse.llm.common import slices
from fieldpulse.llm.tokens import encoder

WINDOW = 4096
#: Text bytes a packing partition is made for.
PARTITION_BYTES = 32 << 20
MAX_PARTITIONS = 20_000
_PIECES = "doc_id long, start long, length long, doc_tokens long, ids binary"


class RoomTree:
    """Open windows by remaining room, 0 to ``largest``; the tightest fit is found from the root."""

    def __init__(self, largest: int):
        self.leaves = 1 << largest.bit_length()
        self.open = np.zeros(2 * self.leaves, np.int64).tolist()
        self.windows: list[list[int]] = [[] for _ in range(largest + 1)]

    def _count(self, room: int, change: int) -> None:
        node = room + self.leaves
        while node:
            self.open[node] += change
            node >>= 1

    def put(self, room: int, window: int) -> None:
        self.windows[room].append(window)
        self._count(room, 1)

    def take(self, needed: int) -> tuple[int, int] | None:
        """Smallest room of at least ``needed`` and a window with it, taken out; None if there is none."""
        node = needed + self.leaves
        if not self.open[node]:
            # Up to the first ancestor whose right sibling has a window, then down its left side.
            while node > 1 and (node & 1 or not self.open[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node = 2 * node if self.open[2 * node] else 2 * node + 1
        room = node - self.leaves
        self._count(room, -1)
        return room, self.windows[room].pop()


def pieces_of(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW) -> DataFrame:
    """``doc_id``, ``start``, ``length``, ``doc_tokens``, ``ids``: full windows and rests of every document."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, end = encoder(vocabulary).encode_all, np.array([end_id], "<u4").tobytes()
        names = ["doc_id", "start", "length", "doc_tokens", "ids"]
        kinds = [pa.int64()] * 4 + [pa.binary()]
        for batch in batches:
            found = encode_all(text.as_py() for text in batch.column(1))
            for some in slices([batch]):
                rows = ([], [], [], [], [])
                for doc_id, ids in zip(some.column(0).to_pylist(), found):
                    ids += end
                    total = len(ids) // 4
                    for start in range(0, total, window):
                        piece = ids[4 * start : 4 * (start + window)]
                        for column, value in zip(rows, (doc_id, start, len(piece) // 4, total, piece), strict=True):
                            column.append(value)
                arrays = [pa.array(c, k) for c, k in zip(rows, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(cut, _PIECES)


def partitions_for(docs: DataFrame, partition_bytes: int = PARTITION_BYTES) -> int:
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    return min(MAX_PARTITIONS, 1 + size // partition_bytes)


def pack(docs: DataFrame, vocabulary: str, end_id: int, window: int = WINDOW, partitions: int | None = None) -> DataFrame:
    """Pieces of all documents with ``sequence_id``, ``offset`` and their ``ids``.

    Every id lies in exactly one piece; the pieces of a sequence follow each other from
    offset 0 without a gap.
    """
    pieces = pieces_of(docs, vocabulary, end_id, window)
    # The row number deals out copies of one text like other texts; equal pieces pack alike in any order.
    marked = pieces.withColumns({"check": F.crc32("ids"), "row": F.monotonically_increasing_id()})
    dealt = marked.repartition(partitions or partitions_for(docs), "doc_id", "start", "check", "row")
    dealt = dealt.sortWithinPartitions(F.desc("length"), "doc_id", "start", "check").drop("check", "row")

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rooms, opened = RoomTree(window), 0
        first = TaskContext.get().partitionId() << 32
        for batch in slices(batches):
            sequences, offsets = [], []
            for length in batch.column(2).to_pylist():
                if found := rooms.take(length):
                    room, sequence = found
                else:
                    room, sequence, opened = window, opened, opened + 1
                sequences.append(first + sequence)
                offsets.append(window - room)
                if room > length:
                    rooms.put(room - length, sequence)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sequences, pa.int64()), pa.array(offsets, pa.int64())],
                names=[*batch.schema.names, "sequence_id", "offset"],
            )

    return dealt.mapInArrow(fit, f"{_PIECES}, sequence_id long, offset long")
