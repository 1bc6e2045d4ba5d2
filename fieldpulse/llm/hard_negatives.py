"""Hard negatives of anchors, by shared lists of anchor clusters (MAXIMUS-style).

For an anchor, its ``positives`` are the rows of its label with the highest inner products;
for each of them, its hard negatives are the rows of other labels that score next below a
share ``high`` of the positive's score, and not below the share ``low``.

Anchors are taken in blocks of ``ANCHOR_BYTES``, each held against all rows twice: for the
positives, then, with their scores known, for the negatives. In a block, anchors of one
label and length are clustered by direction. If theta is a row's angle to the centre of a
cluster and beta the widest of its members, no member's product with the row exceeds
|member| |row| cos(max(0, theta - beta)). A task takes its rows in segments, sorts a
segment once for each cluster by that bound, and every member walks the list, by matrix
products of a stretch of it with all members still walking, until the bound certifies that
nothing further down can be among its best. What a task found serves as the mark to beat
in its next segments. Clusters and bounds decide what is skipped, never what is found.

Components become floor(scale * x), and products of integers are exact in float64 below
2^53; pairs that could reach it are multiplied in integers without bound. Scores that
leave 64 bits count as their largest or smallest value.

Memory in a task: the anchors of a block, a segment of rows, and the best of each anchor;
through the driver go only a block's anchors and their positives. Rows are dealt out evenly
whatever their label, so a label on a third of all rows is nobody's group.

Defined cases: rows take no part whose id or label is null, whose vector is null or has a
null or non-finite component (before or after scaling); a row has no product with rows of
another length; zero and empty vectors score 0; rows with the anchor's own id are neither
its positives nor negatives; rows that repeat an id count each, and an anchor that repeats
gives its results each time; equal scores go by the smaller id; an anchor without positives,
and a positive without negatives, give no row; an empty table gives an empty result. Extra
columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from fieldpulse.llm.best import Best, best_per_key
from fieldpulse.session import written

#: Bytes of anchors held against all rows at a time.
ANCHOR_BYTES = 16 << 20
#: Members a cluster is made for, and rounds of finding the centres.
CLUSTER = 64
ROUNDS = 4
#: Rows a list is made of, and those a walk takes at a time.
SEGMENT = 8192
STRETCH = 256
#: Products of anchors and rows that a task is made for.
TASK_PRODUCTS = 1 << 31
#: What a cosine may be wrong by, through the angles it is computed from.
MARGIN = 1e-6
EXACT = 2.0**53

_FOUND = "owner int, id long, score long"
_RESULT = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"


# --- Vectors and clusters -------------------------------------------------------------


def _usable(rows: DataFrame, scale: float) -> Column:
    scaled = F.transform("vector", lambda x: x.cast("double") * scale)
    finite = F.forall(scaled, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(F.col("id").isNotNull() & F.col("label").isNotNull() & finite, F.lit(False))


@dataclass(frozen=True)
class Vectors:
    """Rows of one length."""

    ids: np.ndarray
    labels: np.ndarray
    values: np.ndarray

    def __getitem__(self, chosen) -> Vectors:
        return Vectors(self.ids[chosen], self.labels[chosen], self.values[chosen])


def by_length(batch: pa.RecordBatch | pa.Table, scale: float) -> Iterator[tuple[np.ndarray, Vectors]]:
    """Rows ``id, label, vector`` of each length, with their positions."""
    ids, labels = (batch.column(name).to_numpy() for name in ("id", "label"))
    vectors = batch.column("vector")
    vectors = vectors.combine_chunks() if isinstance(vectors, pa.ChunkedArray) else vectors
    lengths = np.asarray(vectors.value_lengths())
    flat = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    starts = np.cumsum(lengths) - lengths
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        values = flat[starts[at][:, None] + np.arange(length)]
        yield at, Vectors(ids[at], labels[at], values)


def _units(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and norms; a zero vector has direction zero. Scaled first, so that no square overflows."""
    top = np.abs(values).max(axis=1, initial=0, keepdims=True)
    scaled = np.divide(values, top, out=np.zeros_like(values), where=top > 0)
    norm = np.linalg.norm(scaled, axis=1, keepdims=True)
    return np.divide(scaled, norm, out=scaled, where=norm > 0), (norm * top)[:, 0]


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact, within the range of 64 bits."""
    size = max(1, a.shape[1])
    top_a, top_b = (np.abs(x).max(axis=1, initial=0) for x in (a, b))
    if top_a.max(initial=0) * top_b.max(initial=0) * size < EXACT:
        return (a @ b.T).astype(np.int64)
    small_a, small_b = (top < math.sqrt(EXACT / size) for top in (top_a, top_b))
    out = np.zeros((len(a), len(b)), np.int64)
    out[np.ix_(small_a, small_b)] = (a[small_a] @ b[small_b].T).astype(np.int64)
    whole_a, whole_b = ([[int(x) for x in row] for row in rows] for rows in (a, b))
    for i, j in np.argwhere(~(small_a[:, None] & small_b)):
        product = sum(x * y for x, y in zip(whole_a[i], whole_b[j]))
        out[i, j] = min(max(product, -(1 << 63)), (1 << 63) - 1)
    return out


@dataclass(frozen=True)
class Cluster:
    """Anchors of one label and length: positions in their block, and the cone they lie in."""

    members: np.ndarray
    anchors: Vectors
    norms: np.ndarray
    centre: np.ndarray
    spread: float

    @property
    def label(self) -> int:
        return int(self.anchors.labels[0])


def clusters(block: pa.Table, scale: float) -> list[Cluster]:
    """The anchors of a block, clustered by direction within label and length."""
    made = []
    for at, vectors in by_length(block, scale):
        for label in np.unique(vectors.labels):
            chosen = np.flatnonzero(vectors.labels == label)
            units, norms = _units(vectors.values[chosen])
            k = math.ceil(len(chosen) / CLUSTER)
            centres = units[np.arange(k) * len(chosen) // k]
            for _ in range(ROUNDS):
                nearest = np.argmax(units @ centres.T, axis=1)
                sums = np.zeros_like(centres)
                np.add.at(sums, nearest, units)
                centres, _ = _units(sums)
            nearest = np.argmax(units @ centres.T, axis=1)
            for number in np.unique(nearest):
                inside = nearest == number
                angles = np.arccos(np.clip(units[inside] @ centres[number], -1, 1))[norms[inside] > 0]
                made.append(Cluster(
                    at[chosen[inside]], vectors[chosen[inside]], norms[inside], centres[number],
                    float(angles.max(initial=0)),
                ))
    return made


# --- The walk -------------------------------------------------------------------------


@dataclass
class Walk:
    """What a cluster's members look for: several slots a member, each with its range of scores."""

    cluster: Cluster
    #: Per slot its number in the block, its member in the cluster, the lowest and highest score.
    owners: np.ndarray
    member: np.ndarray
    low: np.ndarray
    high: np.ndarray
    same_label: bool
    best: Best

    def along(self, rows: Vectors, units: np.ndarray, norms: np.ndarray) -> int:
        """Offer the members all of ``rows`` that can matter; returns the products taken."""
        cluster = self.cluster
        wanted = np.flatnonzero((rows.labels == cluster.label) == self.same_label)
        if not len(wanted) or not len(self.owners):
            return 0
        angles = np.arccos(np.clip(units[wanted] @ cluster.centre, -1, 1))
        bounds = norms[wanted] * (np.cos(np.maximum(0, angles - cluster.spread)) + MARGIN)
        order = np.argsort(-bounds, kind="stable")
        bounds, listed = bounds[order], rows[wanted[order]]
        taken = 0
        for start in range(0, len(order), STRETCH):
            mark = np.maximum(self.low, self.best.floor)
            walking = np.flatnonzero(cluster.norms[self.member] * bounds[start] >= mark)
            if not len(walking):
                break
            members, of = np.unique(self.member[walking], return_inverse=True)
            part = listed[slice(start, start + STRETCH)]
            scores = products(cluster.anchors.values[members], part.values)
            taken += scores.size
            scores = scores[of]
            other = cluster.anchors.ids[self.member[walking]][:, None] != part.ids
            slot, row = np.nonzero((scores >= mark[walking][:, None]) & (scores <= self.high[walking][:, None]) & other)
            self.best.offer(walking[slot], scores[slot, row], part.ids[row])
        return taken


def _walked(rows: DataFrame, made: list[Cluster], scale: float, slots: list[tuple], same_label: bool, k: int) -> DataFrame:
    """The best ``k`` rows of each slot ``(owner, anchor, low, high)`` within every task."""
    owner, anchor, low, high = (np.array(column, np.int64) for column in (zip(*slots) if slots else [[]] * 4))

    def walks() -> Iterator[Walk]:
        for cluster in made:
            at = {int(position): number for number, position in enumerate(cluster.members)}
            chosen = np.flatnonzero(np.isin(anchor, cluster.members))
            member = np.array([at[int(a)] for a in anchor[chosen]], np.int64)
            yield Walk(cluster, owner[chosen], member, low[chosen], high[chosen], same_label, Best(len(chosen), k))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walking = list(walks())
        for segment in segments(batches):
            for _, vectors in by_length(segment, scale):
                units, norms = _units(vectors.values)
                for walk in walking:
                    if walk.cluster.anchors.values.shape[1] == vectors.values.shape[1]:
                        walk.along(vectors, units, norms)
        for walk in walking:
            yield pa.RecordBatch.from_arrays([
                pa.array(walk.owners[walk.best.owner], pa.int32()), pa.array(walk.best.id), pa.array(walk.best.score),
            ], ["owner", "id", "score"])

    return best_per_key(
        rows.mapInArrow(find, _FOUND), ["owner"], [F.desc("score"), F.asc("id")], k, "rank", F.col("id"),
    )


def segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, SEGMENT):
            yield batch.slice(start, SEGMENT)


# --- Blocks of anchors ----------------------------------------------------------------


def _mine_block(rows: DataFrame, block: pa.Table, scale: float, positives: int, negatives: int, low: int, high: int) -> DataFrame:
    spark = rows.sparkSession
    ids = block.column("id").to_pylist()
    made = clusters(block, scale)
    least, most = -(1 << 63), (1 << 63) - 1
    everyone = [(anchor, anchor, least, most) for anchor in range(len(ids))]
    found = _walked(rows, made, scale, everyone, same_label=True, k=positives).collect()
    slots = [
        (number, row["owner"], -(-low * row["score"] // 100), high * row["score"] // 100)
        for number, row in enumerate(found)
    ]
    slots = [(number, anchor, max(a, least), min(b, most)) for number, anchor, a, b in slots if a <= b]
    mined = _walked(rows, made, scale, slots, same_label=False, k=negatives)
    asked = spark.createDataFrame(
        [(number, ids[row["owner"]], row["id"], row["score"]) for number, row in enumerate(found)],
        "owner int, anchor_id long, positive_id long, positive_score long",
    )
    return mined.join(F.broadcast(asked), "owner").select(
        "anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"),
    )


def hard_negatives(
    rows: DataFrame, is_anchor: Column, id: str = "vec_id", label: str = "label", vector: str = "embedding",
    scale: float = 256, positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score`` of all anchors.

    ``is_anchor`` is a condition on ``rows``; ``low`` and ``high`` are percentages of a
    positive's score. Ids and labels are integers.
    """
    spark = rows.sparkSession
    held = rows.select(
        F.col(id).cast("long").alias("id"), F.col(label).cast("long").alias("label"), F.col(vector).alias("vector"),
        F.coalesce(is_anchor, F.lit(False)).alias("anchor"),
    )
    held = held.where(_usable(held, scale))
    size = F.sum(F.when(F.col("anchor"), 8 * F.size("vector") + 16))
    total, anchors, anchor_bytes = held.agg(F.count("*"), F.count_if("anchor"), size).first()
    if not anchors:
        return spark.createDataFrame([], _RESULT)
    blocks = math.ceil(anchor_bytes / ANCHOR_BYTES)
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(total * anchors / blocks / TASK_PRODUCTS))
    held = written(held.repartition(tasks), "vectors")
    block = F.pmod(F.xxhash64("id", "vector"), F.lit(blocks))
    columns = held.select("id", "label", "vector")
    taken = (held.where(F.col("anchor") & (block == n)).select(columns.columns).toArrow() for n in range(blocks))
    mined = [_mine_block(columns, part, scale, positives, negatives, low, high) for part in taken if part.num_rows]
    return reduce(DataFrame.union, mined)
