"""Embedding near-dedup by an epsilon grid order join.

Vectors of length one with cosine of at least c lie within epsilon = sqrt(2 - 2c) of each
other. They are projected on their leading principal directions, which never lengthens a
distance, and sorted by the cells, epsilon wide, they fall in. The sequence is cut into
intervals, each one row of a written table. Pairs of intervals are found from a tree of
bounding boxes, level by level: pairs whose boxes are farther apart than epsilon are skipped
with all below them. A box also bounds what the directions leave of each vector, the norm of
the rest, which is one coordinate more: by it two vectors are at least as far apart as their
rests differ in length. For the pairs left, a task takes a few neighbouring intervals of
either side and joins the sequences recursively, halving them and skipping halves that are
provably distant; what remains is compared in blocks, in single precision with a margin, and
all that passes again in double precision, which alone decides.

Vectors of different length never meet: each length has its own directions, sequence and
boxes. Directions come by power iterations from a sample, bounded for all lengths together
by ``SAMPLE_BYTES``; lengths of few vectors, and those beyond the ``MAX_BASES`` most frequent,
go without. Directions decide what is skipped, never what is linked. Intervals are bounded in
rows and in bytes, so one very long vector among short ones costs what it is long.

Equal vectors are one representative with a count, so a vector on a third of all rows
costs one row. A task emits no pairs: per representative the number of vectors linked, and
links contracted to a star per component.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components
link with nothing and are their own component; vectors of different length do not link;
rows without vec_id take part, and a component is named by its smallest vec_id, null if it
has none; rows equal in id and vector are vectors of their own; an empty table gives an
empty result. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from fieldpulse.llm.common import components, slices
from fieldpulse.session import written

COSINE = 0.95
#: Leading directions, rounds of finding them, and the samples they are found from.
DIRECTIONS = 8
ROUNDS = 6
SAMPLE = 10_000
SAMPLE_BYTES = 64 << 20
MAX_BASES = 256
#: Representatives and bytes an interval is made for, most tasks that make them, and children of a box in the tree.
INTERVAL = 4096
INTERVAL_BYTES = 4 << 20
MAX_INTERVALS = 1 << 20
FAN_OUT = 16
#: Intervals on a side of a task: each is sent once to every group of partners.
GROUP = 4
#: Rows of a sequence below which a join compares instead of halving.
LEAF = 512
#: What single precision may be wrong by, and double precision in a squared box distance.
SINGLE_MARGIN = 1e-4
BOX_MARGIN = 1e-6

_FOUND = "rep long, links long, root long"


def is_usable(vector: Column) -> Column:
    """Not null, not zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(raw: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled first, so that no square overflows or vanishes."""
    scaled = raw / np.abs(raw).max(axis=1, keepdims=True)
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _by_length(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions and vectors of each length in ``column``, in order."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    lengths = np.asarray(column.value_lengths())
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield at, flat[starts[at][:, None] + np.arange(length)]


def leading(unit: np.ndarray, directions_: int) -> np.ndarray:
    """Leading principal directions of the rows, orthonormal columns, by power iterations."""
    width = unit.shape[1]
    centred = unit - unit.mean(axis=0)
    basis = np.random.default_rng(7).normal(size=(width, min(directions_, width)))
    for _ in range(ROUNDS):
        basis, _ = np.linalg.qr(centred.T @ (centred @ np.linalg.qr(basis)[0]))
    return basis


def directions(reps: DataFrame) -> dict[int, np.ndarray]:
    """Leading principal directions of a sample of the unit vectors of each frequent length."""
    counted = reps.groupBy(F.size("embedding").alias("size")).agg(F.count("*").alias("n")).where(F.col("n") > INTERVAL)
    frequent = {row["size"]: row["n"] for row in counted.orderBy(F.desc("n"), "size").limit(MAX_BASES).collect()}
    wanted = {size: min(SAMPLE, SAMPLE_BYTES // (8 * size * len(frequent))) for size in frequent}
    shares = [(size, int((1 << 30) * min(1.0, wanted[size] / n))) for size, n in frequent.items()]
    if not shares:
        return {}
    share = F.broadcast(reps.sparkSession.createDataFrame(shares, "size int, share long"))
    chosen = reps.join(share, F.size("embedding") == F.col("size")).where(
        F.pmod(F.xxhash64(F.lit(7), "rep"), F.lit(1 << 30)) < F.col("share")
    )
    found = chosen.select("embedding").toArrow().column(0).combine_chunks()
    if not len(found):
        return {}
    return {
        vectors.shape[1]: leading(_unit(vectors.astype(np.float64)), DIRECTIONS)
        for _, vectors in _by_length(found) if len(vectors) > DIRECTIONS
    }


def project(unit: np.ndarray, bases: dict[int, np.ndarray]) -> np.ndarray:
    """Coordinates along the directions of the vectors' length, and the norm of the rest."""
    out = np.zeros((len(unit), DIRECTIONS + 1))
    basis = bases.get(unit.shape[1])
    if basis is not None:
        out[:, : basis.shape[1]] = unit @ basis
    out[:, -1] = np.sqrt(np.maximum(0, 1 - np.einsum("nd,nd->n", out, out)))
    return out


# --- The join of two sequences --------------------------------------------------------


def _apart(low_a, high_a, low_b, high_b) -> float:
    """Squared distance of two boxes."""
    gap = np.maximum(0, np.maximum(low_a - high_b, low_b - high_a))
    return float(gap @ gap)


class _Sequence:
    """Unit vectors in grid order, with their projections."""

    def __init__(self, vectors: np.ndarray, counts: np.ndarray, bases: dict[int, np.ndarray]):
        self.vectors, self.counts = vectors, counts
        self.single = vectors.astype(np.float32)
        self.projected = project(vectors, bases)
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        if (low, high) not in self.boxes:
            part = self.projected[low:high]
            self.boxes[low, high] = part.min(axis=0), part.max(axis=0)
        return self.boxes[low, high]


def join_sequences(a: _Sequence, b: _Sequence, cosine: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the linked rows of ``a`` and ``b``; each pair once if both are the ``same``."""
    reach = 2 - 2 * cosine + BOX_MARGIN
    stack = [(0, len(a.vectors), 0, len(b.vectors))]
    while stack:
        a_low, a_high, b_low, b_high = stack.pop()
        if a_low == a_high or b_low == b_high or (same and b_high <= a_low):
            continue
        if _apart(*a.box(a_low, a_high), *b.box(b_low, b_high)) > reach:
            continue
        a_half = a_high if a_high - a_low <= LEAF else (a_low + a_high) // 2
        b_half = b_high if b_high - b_low <= LEAF else (b_low + b_high) // 2
        if a_half < a_high or b_half < b_high:
            for first in ((a_low, a_half), (a_half, a_high)):
                stack += [(*first, b_low, b_half), (*first, b_half, b_high)]
            continue
        near = a.single[a_low:a_high] @ b.single[b_low:b_high].T >= np.float32(cosine - SINGLE_MARGIN)
        i, j = np.nonzero(near)
        i, j = i + a_low, j + b_low
        if same:
            i, j = i[i < j], j[i < j]
        exact = np.einsum("nd,nd->n", a.vectors[i], b.vectors[j]) >= cosine
        if exact.any():
            yield i[exact], j[exact]


def _links_of(group: pa.Table, bases: dict[int, np.ndarray], cosine: float, kind: str, side: int) -> pa.Table:
    """Links between the blocks of two sides of ``side`` intervals, or among those of one, summed per representative."""
    rows = group.sort_by("interval").to_pylist()
    blocks = [Block.unpack(row, kind) for row in rows]
    sequences = [_Sequence(_unit(x.vectors.astype(np.float64)), x.counts, bases) for x in blocks]
    reps = np.concatenate([x.reps for x in blocks])
    ends = np.cumsum([len(x.reps) for x in blocks])
    starts = ends - [len(x.reps) for x in blocks]
    links, root = np.zeros(len(reps), np.int64), np.arange(len(reps))
    left = [n for n, row in enumerate(rows) if row["interval"] // side == row["left"]]
    right = [n for n, row in enumerate(rows) if row["interval"] // side == row["right"]]
    for m in left:
        for n in right:
            if m > n:
                continue
            a, b = sequences[m], sequences[n]
            for i, j in join_sequences(a, b, cosine, m == n):
                np.add.at(links, i + starts[m], b.counts[j])
                np.add.at(links, j + starts[n], a.counts[i])
                _merge(root, i + starts[m], j + starts[n])
    found = links > 0
    return pa.table({"rep": reps[found], "links": links[found], "root": reps[root[found]]})


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of positions ``a`` and ``b``; ``root`` stays the smallest position of each set."""
    while len(a):
        ra, rb = root[a], root[b]
        apart = ra != rb
        a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
        np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
        while not np.array_equal(root, root[root]):
            root[:] = root[root]


# --- Intervals ------------------------------------------------------------------------


@dataclass
class Block:
    """The vectors of one interval in grid order, all of one length, as they came."""

    reps: np.ndarray
    counts: np.ndarray
    vectors: np.ndarray

    def pack(self, kind: str) -> dict[str, bytes]:
        """The arrays as bytes; ``kind`` is the vectors' own precision."""
        whole = {name: getattr(self, name).astype("<i8").tobytes() for name in ("reps", "counts")}
        return whole | {"vectors": self.vectors.astype(kind).tobytes()}

    @classmethod
    def unpack(cls, row: dict, kind: str) -> Block:
        whole = [np.frombuffer(row[name], "<i8") for name in ("reps", "counts")]
        return cls(*whole, np.frombuffer(row["vectors"], kind).reshape(len(whole[0]), row["size"]))


_BLOCK = (
    "size int, part int, number int, low array<double>, high array<double>, reps binary, counts binary, vectors binary"
)


def precision_of(reps: DataFrame) -> str:
    """Numpy's name of the precision that holds the vectors' components exactly."""
    return "<f4" if reps.schema["embedding"].dataType.simpleString() == "array<float>" else "<f8"


class _Gathering:
    """Rows of one length in grid order on their way into blocks."""

    def __init__(self, kind: str):
        self.kind, self.held, self.rows = kind, [], 0

    def most(self, size: int) -> int:
        """Rows that a block may have: a range may be somewhat larger than an interval, and stays one block."""
        return max(1, min(2 * INTERVAL, INTERVAL_BYTES // (np.dtype(self.kind).itemsize * size)))

    def take(self, reps: np.ndarray, counts: np.ndarray, vectors: np.ndarray) -> Iterator[Block]:
        if self.held and self.held[0].vectors.shape[1] != vectors.shape[1]:
            yield from self.rest()
        most = self.most(vectors.shape[1])
        while len(reps):
            room = most - self.rows
            self.held.append(Block(reps[:room], counts[:room], vectors[:room]))
            self.rows += len(self.held[-1].reps)
            reps, counts, vectors = reps[room:], counts[room:], vectors[room:]
            if self.rows == most:
                yield from self.rest()

    def rest(self) -> Iterator[Block]:
        if self.held:
            yield Block(*[np.concatenate([getattr(b, name) for b in self.held]) for name in ("reps", "counts", "vectors")])
        self.held, self.rows = [], 0


def blocks_in_grid_order(reps: DataFrame, bases: dict[int, np.ndarray], cosine: float, total: int) -> DataFrame:
    """One row per interval of the grid order: its bounding box and its :class:`Block`, as a written table.

    Intervals are named by ``size``, the ``part`` that made them and a ``number`` in it.
    """
    epsilon = float(np.sqrt(2 - 2 * cosine))
    kind = reps.schema["embedding"].dataType.simpleString()
    precision = precision_of(reps)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            column = batch.column("embedding")
            cells = np.zeros((batch.num_rows, DIRECTIONS))
            for at, vectors in _by_length(column):
                cells[at] = np.floor(project(_unit(vectors.astype(np.float64)), bases)[:, :-1] / epsilon)
            made = [pa.array(np.asarray(column.value_lengths()), pa.int32()), pa.array(list(cells), pa.list_(pa.float64()))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*batch.schema.names, "size", "cells"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathering, number = _Gathering(precision), 0

        def blocks() -> Iterator[Block]:
            for batch in batches:
                reps, counts = batch.column("rep").to_numpy(), batch.column("count").to_numpy()
                for at, vectors in _by_length(batch.column("embedding")):
                    yield from gathering.take(reps[at], counts[at], vectors)
            yield from gathering.rest()

        lists = pa.list_(pa.float64())
        kinds = [pa.int32(), pa.int32(), pa.int32(), lists, lists, *[pa.binary()] * 3]
        for block in blocks():
            projected = project(_unit(block.vectors.astype(np.float64)), bases)
            row = {
                "size": block.vectors.shape[1], "part": TaskContext.get().partitionId(), "number": number,
                "low": projected.min(axis=0).tolist(), "high": projected.max(axis=0).tolist(), **block.pack(precision),
            }
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([x], k) for x, k in zip(row.values(), kinds, strict=True)], names=list(row)
            )

    located = written(
        reps.select("embedding", "count", "rep").mapInArrow(
            locate, f"embedding {kind}, count long, rep long, size int, cells array<double>"
        ),
        "cells",
    )
    size = located.agg(F.sum("size")).first()[0] * np.dtype(precision).itemsize
    intervals = min(MAX_INTERVALS, max(-(-total // INTERVAL), -(-size // INTERVAL_BYTES)))
    ordered = located.repartitionByRange(intervals, "size", "cells", "rep").sortWithinPartitions("size", "cells", "rep")
    return written(ordered.mapInArrow(gather, _BLOCK), "blocks")


def numbered(blocks: DataFrame) -> DataFrame:
    """The intervals without their vectors, each length's numbered in grid order as ``interval``."""
    place = Window.partitionBy("size").orderBy("part", "number")
    index = blocks.select("size", "part", "number", "low", "high")
    return written(index.withColumn("interval", F.row_number().over(place).cast("long") - 1), "intervals")


def _boxes(points: DataFrame, node: Column) -> DataFrame:
    """Bounding box of every ``node`` of a length over the rows' ``low`` and ``high`` corners."""
    sides = [
        f(F.get(corner, F.lit(d))).alias(f"{corner}{d}")
        for d in range(DIRECTIONS + 1) for corner, f in (("low", F.min), ("high", F.max))
    ]
    corner = lambda name: F.array(*[F.col(f"{name}{d}") for d in range(DIRECTIONS + 1)]).alias(name)
    return points.groupBy("size", node.alias("node")).agg(*sides).select("size", "node", corner("low"), corner("high"))


def near_intervals(index: DataFrame, cosine: float) -> DataFrame:
    """Pairs ``left`` <= ``right`` of a length's intervals whose boxes come within reach, from the root down."""
    gap = lambda x, y: F.greatest(F.lit(0.0), x, y)
    levels = [index.select("size", F.col("interval").alias("node"), "low", "high")]
    while levels[-1].agg(F.max("node")).first()[0] >= FAN_OUT:
        levels.append(written(_boxes(levels[-1], F.floor(F.col("node") / FAN_OUT)), "boxes"))
    # The root of a length meets itself; below, a box meets the children of the boxes its parent came near.
    root = F.lit(0).cast("long")
    pairs = index.select("size").distinct().select("size", root.alias("left"), root.alias("right"))
    for boxes in reversed(levels):
        above = pairs.select("size", F.col("left").alias("over_a"), F.col("right").alias("over_b"))
        up = F.floor(F.col("node") / FAN_OUT)
        a = boxes.select(
            "size", F.col("node").alias("left"), F.col("low").alias("low_a"), F.col("high").alias("high_a"),
            up.alias("over_a"),
        )
        b = boxes.select(
            "size", F.col("node").alias("right"), F.col("low").alias("low_b"), F.col("high").alias("high_b"),
            up.alias("over_b"),
        )
        met = above.join(a, ["size", "over_a"]).join(b, ["size", "over_b"]).where("left <= right")
        one_way = F.zip_with("low_a", "high_b", lambda x, y: x - y)
        other = F.zip_with("low_b", "high_a", lambda x, y: x - y)
        apart = F.aggregate(F.zip_with(one_way, other, gap), F.lit(0.0), lambda acc, x: acc + x * x)
        near = met.where(apart <= 2 - 2 * cosine + BOX_MARGIN)
        pairs = written(near.select("size", "left", "right"), "near-intervals")
    return pairs


# --- The operator ---------------------------------------------------------------------


def near_duplicates(vectors: DataFrame, cosine: float = COSINE) -> DataFrame:
    """``vec_id``, ``n_links``, ``component_id``, ``kept`` for every row of ``vec_id``, ``embedding``."""
    rows = vectors.select("vec_id", "embedding", is_usable(F.col("embedding")).alias("usable"))
    usable = rows.where("usable")
    reps = written(
        usable.groupBy("embedding").agg(F.min("vec_id").alias("smallest"), F.count("*").alias("count"))
        .withColumn("rep", F.monotonically_increasing_id()),
        "vectors",
    )
    total = reps.count()
    if not total:
        return rows.select(
            "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept")
        )
    bases, precision = directions(reps), precision_of(reps)
    blocks = blocks_in_grid_order(reps, bases, cosine, total)
    index = numbered(blocks)
    side = GROUP
    of = lambda name: F.floor(F.col(name) / side)
    sides = near_intervals(index, cosine).select(
        "size", of("left").alias("left"), of("right").alias("right"), F.explode(F.array("left", "right")).alias("interval")
    ).distinct()
    sent = written(sides.join(index.select("size", "part", "number", "interval"), ["size", "interval"]), "partners")
    found = written(
        blocks.drop("low", "high").join(sent, ["size", "part", "number"])
        .groupBy("size", "left", "right").applyInArrow(lambda group: _links_of(group, bases, cosine, precision, side), _FOUND),
        "vector-links",
    )
    linked = components(found.select(F.col("rep").alias("a"), F.col("root").alias("b")))
    links = found.groupBy("rep").agg(F.sum("links").alias("links"))
    labelled = written(
        reps.join(linked.withColumnRenamed("node", "rep"), "rep", "left").join(links, "rep", "left").select(
            "embedding", "smallest", F.coalesce("component", "rep").alias("component"),
            (F.coalesce("links", F.lit(0)) + F.col("count") - 1).alias("n_links"),
        ),
        "labelled-vectors",
    )
    roots = written(labelled.groupBy("component").agg(F.min("smallest").alias("component_id")), "vector-components")
    named = written(labelled.join(roots, "component").select("embedding", "n_links", "component_id"), "named-vectors")
    joined = usable.select("vec_id", "embedding").join(named, "embedding").select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return joined.union(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
