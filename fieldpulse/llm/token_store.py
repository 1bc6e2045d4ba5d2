"""Token ids in patched frame-of-reference blocks.

A store is a folder of segments in ascending doc_id order. Spark writes it as a Parquet
table, so that a lost task leaves nothing half written; each row holds one binary
segment of whole documents:

    header     8 unsigned 64-bit: magic, documents, ids, ids a block, blocks, exceptions, payload bytes, 0
    documents  per document 1 byte (0: doc_id is null), its doc_id (signed 64), its ids (unsigned 64)
    blocks     per block its minimum (unsigned 32), width in bits (1 byte), exceptions (1 byte),
               and the start of its packed bits in the payload (unsigned 64): the index
    payload    per block the lowest ``width`` bits of id - minimum, least significant first
    exceptions per outlier its place in the block (1 byte) and its id - minimum (unsigned 32)

The width of a block is that of a percentile of its differences, so a few large ids do
not widen the rest; ids that need more bits are outliers. The index allows reading any
range of ids without its neighbours.

Defined cases: null and empty texts hold the end id alone; rows without doc_id come
first; rows with equal doc_id lie side by side in the order of their text's hash, equal ones
in that of the table;
documents longer than a segment are a segment of their own; an empty table gives an
empty store. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpulse.llm.tokens import encoder

MAGIC = 0x31524F4650  # "PFOR1"
BLOCK = 128
PERCENTILE = 0.9
SEGMENT_IDS = 1 << 18
#: Text bytes that one task encodes, at most as a rule.
PART_BYTES = 128 << 20
_HEADER = 8
_SEGMENT_SCHEMA = "part int, segment long, part_start long, n_ids long, data binary"
_READ_SCHEMA = "part int, segment long, place long, doc_id long, start long, ids binary"


# --- One segment ----------------------------------------------------------------------


def _widths(differences: np.ndarray, percentile: float) -> np.ndarray:
    """Bits of the percentile of each block's differences."""
    at = min(BLOCK - 1, int(np.ceil(percentile * BLOCK)) - 1)
    chosen = np.partition(differences, at, axis=1)[:, at].astype(np.float64)
    return np.frexp(chosen)[1].astype(np.uint8)


def _pack(values: np.ndarray, width: int) -> np.ndarray:
    """The lowest bits of each row's 32-bit values, one after another."""
    bits = np.unpackbits(values.view(np.uint8).reshape(len(values), BLOCK, 4), axis=2, bitorder="little")
    return np.packbits(bits[:, :, :width].reshape(len(values), BLOCK * width), axis=1, bitorder="little")


def _unpack(packed: np.ndarray, width: int) -> np.ndarray:
    bits = np.zeros((len(packed), BLOCK, 32), np.uint8)
    bits[:, :, :width] = np.unpackbits(packed, axis=1, bitorder="little").reshape(len(packed), BLOCK, width)
    return np.packbits(bits, axis=2, bitorder="little").view("<u4").reshape(len(packed), BLOCK)


def encode_segment(doc_ids: list[int | None], documents: list[bytes], percentile: float = PERCENTILE) -> bytes:
    """A segment of documents given as little-endian 32-bit ids."""
    ids = np.frombuffer(b"".join(documents), "<u4")
    blocks = -(-len(ids) // BLOCK)
    padded = np.concatenate([ids, np.repeat(ids[-1:], blocks * BLOCK - len(ids))]).reshape(blocks, BLOCK)
    lowest = padded.min(axis=1) if blocks else np.zeros(0, "<u4")
    differences = np.ascontiguousarray(padded - lowest[:, None], "<u4")
    widths = _widths(differences, percentile) if blocks else np.zeros(0, np.uint8)
    outlier = (differences.astype(np.uint64) >> widths[:, None].astype(np.uint64)) != 0
    starts = np.zeros(blocks + 1, np.uint64)
    np.cumsum(widths.astype(np.uint64) * (BLOCK // 8), out=starts[1:])
    payload = np.zeros(int(starts[-1]), np.uint8)
    for width in np.unique(widths[widths > 0]):
        rows = np.flatnonzero(widths == width)
        packed = _pack(differences[rows], int(width))
        payload[starts[rows].astype(np.int64)[:, None] + np.arange(packed.shape[1])] = packed
    where = np.nonzero(outlier)
    header = np.array([MAGIC, len(documents), len(ids), BLOCK, blocks, len(where[0]), len(payload), 0], "<u8")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    return b"".join(part.tobytes() for part in (
        header,
        known,
        np.array([d or 0 for d in doc_ids], "<i8"),
        np.array([len(d) // 4 for d in documents], "<u8"),
        lowest.astype("<u4"),
        widths,
        outlier.sum(axis=1, dtype=np.uint8),
        starts[:-1].astype("<u8"),
        payload,
        where[1].astype(np.uint8),
        differences[where].astype("<u4"),
    ))


@dataclass
class Segment:
    """A segment's tables; ids are unpacked on demand."""

    doc_ids: list[int | None]
    lengths: np.ndarray
    n_ids: int
    lowest: np.ndarray
    widths: np.ndarray
    exceptions: np.ndarray
    starts: np.ndarray
    payload: np.ndarray
    places: np.ndarray
    outliers: np.ndarray

    @classmethod
    def parse(cls, data: bytes) -> Segment:
        magic, docs, n_ids, block, blocks, outliers, size, _ = np.frombuffer(data, "<u8", _HEADER).tolist()
        if magic != MAGIC or block != BLOCK:
            raise ValueError("not a segment of patched frame-of-reference blocks")
        at = _HEADER * 8

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            part = np.frombuffer(data, kind, n, at)
            at += part.nbytes
            return part

        known, ids = take("u1", docs), take("<i8", docs)
        doc_ids = [i if k else None for k, i in zip(known.tolist(), ids.tolist(), strict=True)]
        return cls(
            doc_ids, take("<u8", docs).astype(np.int64), n_ids, take("<u4", blocks), take("u1", blocks),
            take("u1", blocks), take("<u8", blocks).astype(np.int64), take("u1", size),
            take("u1", outliers), take("<u4", outliers),
        )

    def ids(self, start: int = 0, end: int | None = None) -> np.ndarray:
        """Ids from ``start`` to ``end``, unpacking only the blocks they lie in."""
        end = self.n_ids if end is None else min(end, self.n_ids)
        first, last = start // BLOCK, -(-end // BLOCK)
        widths = self.widths[first:last]
        values = np.zeros((len(widths), BLOCK), np.uint32)
        for width in np.unique(widths[widths > 0]):
            rows = np.flatnonzero(widths == width)
            span = np.arange(int(width) * (BLOCK // 8))
            values[rows] = _unpack(self.payload[self.starts[first + rows][:, None] + span], int(width))
        before = int(self.exceptions[:first].sum(dtype=np.int64))
        counts = self.exceptions[first:last].astype(np.int64)
        chosen = slice(before, before + int(counts.sum()))
        values[np.repeat(np.arange(len(widths)), counts), self.places[chosen]] = self.outliers[chosen]
        flat = (values + self.lowest[first:last, None]).reshape(-1)
        return flat[start - first * BLOCK : end - first * BLOCK]


# --- The store ------------------------------------------------------------------------


def write_store(
    docs: DataFrame, path: str, vocabulary: str, end_id: int, segment_ids: int = SEGMENT_IDS,
    part_bytes: int = PART_BYTES,
) -> None:
    """Encode every ``text``, append ``end_id``, and write segments in ascending doc_id order.

    Documents are dealt out by ranges of doc_id, as many as the texts' size needs, so
    partition p's ids precede those of p + 1. A row number continues the range key: rows
    equal in id and text, such as a third of all without either, are cut as well. ``part_start`` counts the ids before a segment in its own part; a part's place
    among all ids follows when reading, from one total per part.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text").cast("long")).alias("n")).first()["n"] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 + size // part_bytes)
    order = ["doc_id", "text_hash", "row"]
    ordered = (
        docs.select("doc_id", "text", F.xxhash64("text").alias("text_hash"), F.monotonically_increasing_id().alias("row"))
        .repartitionByRange(parts, *order).sortWithinPartitions(*order).select("doc_id", "text")
    )

    def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode_all, end = encoder(vocabulary).encode_all, np.array([end_id], "<u4").tobytes()
        part = TaskContext.get().partitionId()
        doc_ids, documents, waiting, number, start = [], [], 0, 0, 0

        def row() -> pa.RecordBatch:
            data = encode_segment(doc_ids, documents)
            columns = [[part], [number], [start], [waiting], [data]]
            kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            return pa.RecordBatch.from_arrays(arrays, names=["part", "segment", "part_start", "n_ids", "data"])

        for batch in batches:
            found = encode_all(text.as_py() for text in batch.column(1))
            for doc_id, ids in zip(batch.column(0).to_pylist(), found, strict=True):
                ids += end
                if documents and waiting + len(ids) // 4 > segment_ids:
                    yield row()
                    number, start, waiting = number + 1, start + waiting, 0
                    doc_ids.clear()
                    documents.clear()
                doc_ids.append(doc_id)
                documents.append(ids)
                waiting += len(ids) // 4
        if documents:
            yield row()

    ordered.mapInArrow(segments, _SEGMENT_SCHEMA).write.mode("errorifexists").option(
        "compression", "uncompressed"  # the blocks are packed already
    ).parquet(path)


def read_store(spark: SparkSession, path: str) -> DataFrame:
    """``part``, ``segment``, ``place``, ``doc_id``, ``start``, ``ids`` of every document.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian
    unsigned 32-bit. The totals of the parts are the only thing that the driver sees.
    """
    stored = spark.read.schema(_SEGMENT_SCHEMA).parquet(path)
    totals = stored.groupBy("part").agg(F.sum("n_ids").alias("n")).orderBy("part").collect()
    bases, base = {}, 0
    for row in totals:
        bases[row["part"]], base = base, base + row["n"]

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["part", "segment", "place", "doc_id", "start", "ids"]
        kinds = [pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
        for batch in batches:
            for part, number, start, data in zip(*(batch.column(i) for i in range(4)), strict=True):
                segment = Segment.parse(data.as_py())
                raw = memoryview(segment.ids().astype("<u4").tobytes())
                ends = np.cumsum(segment.lengths)
                begins = ends - segment.lengths
                n = len(ends)
                base = bases[part.as_py()] + start.as_py()
                columns = [
                    [part.as_py()] * n, [number.as_py()] * n, range(n), segment.doc_ids, begins + base,
                    [raw[4 * b : 4 * e].tobytes() for b, e in zip(begins.tolist(), ends.tolist(), strict=True)],
                ]
                arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return stored.select("part", "segment", "part_start", "data").mapInArrow(documents, _READ_SCHEMA)


