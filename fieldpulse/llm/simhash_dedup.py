"""SimHash near-dedup: 64-bit fingerprints linked through BK-trees of shards.

A fingerprint bit is 1 if it is set in over half of the XXH64 hashes (seed 42) of a
text's word shingles, repeats included. Fingerprints that differ in at most
``max_bits`` bits are linked; components are groups of near-duplicates.

Sharding. 64 bits are cut into ``blocks`` runs. Two fingerprints within ``max_bits``
bits agree on at least ``blocks - max_bits`` whole runs, so each fingerprint goes to
one shard per choice of that many runs, keyed by their bits, and no link is lost at any
choice of ``blocks``. More runs make smaller shards and more copies of a fingerprint;
the number is derived from the count of distinct fingerprints. Each shard has a BK-tree
whose children are keyed by their integer Hamming distance to the parent, and a search
follows only edges within the radius. A tree would grow with the corpus if it were sent
to every fingerprint; here a tree and its queries meet by their shard key instead. A
shard above ``TREE_NODES`` is split into trees of at most about that size, and each tree
is sent only to the query blocks of its own shard, one pair of blocks per group.

Equal fingerprints are one node, so a third of all rows may be copies of one text. A
task emits no pairs: links found in a shard are contracted to a star per component.

Defined cases: a null text counts as empty; a text without words has fingerprint zero
and is linked like any other; fewer words than a shingle make one shingle of all of
them; repeated rows are near-duplicates of each other; rows without doc_id take part
and their component is the smallest doc_id of the group, null if none has one; an empty
table gives an empty result. Extra columns pass through and may have any name.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

from fieldpulse.llm.common import components, fresh_name, slices
from fieldpulse.session import written

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
BITS = 64
#: Nodes of one BK-tree, and queries it meets in one group.
TREE_NODES = 8192
#: Shards are made smaller, by cutting more runs, until this many fingerprints are expected in one.
SHARD_NODES = 4096
#: Query and node pairs compared in one step of a search.
STEP = 1 << 18

_UPPER_TO_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


# --- Fingerprints ---------------------------------------------------------------------


def fingerprint_of(text: str | None, words_per_shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one text, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").translate(_UPPER_TO_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    k = min(words_per_shingle, len(words))
    digest, view = xxhash.xxh64_intdigest, memoryview(joined)
    spans = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    hashes = np.fromiter((digest(view[s:e], SEED) for s, e in spans), np.uint64, len(words) - k + 1)
    ones = np.zeros(BITS, np.int64)
    for part in range(0, len(hashes), STEP):
        chunk = hashes[part : part + STEP].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(chunk, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<i8")[0])


def with_fingerprint(docs: DataFrame, column: str, words_per_shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``docs`` plus a bigint ``column``; texts stay in their Arrow batches."""
    schema = StructType([*docs.schema.fields, StructField(column, LongType())])
    at = docs.columns.index("text")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            values = [fingerprint_of(t.as_py(), words_per_shingle) for t in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(values, pa.int64())], names=[*batch.schema.names, column]
            )

    return docs.mapInArrow(add, schema)


# --- BK-trees -------------------------------------------------------------------------


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    # Counted unsigned: of a negative number numpy counts the bits of its absolute value.
    return np.bitwise_count(np.bitwise_xor(a, b).view(np.uint64)).astype(np.int64)


class BkForest:
    """One BK-tree per shard, built level by level for all shards at once.

    Within a shard the fingerprints have to be distinct. ``edge[i]`` is node i's
    distance to its parent; the children of a node lie side by side, ordered by edge.
    """

    def __init__(self, shards: np.ndarray, prints: np.ndarray):
        group, waiting, level_parent, level_edge = shards, np.arange(len(prints)), None, None
        order, edges, parents = [], [], []
        placed = 0
        self.root_shards = np.unique(shards)
        while len(waiting):
            # The first of each group becomes a node, the rest wait below it by distance.
            _, first, inverse = np.unique(group, return_index=True, return_inverse=True)
            node_of = placed + np.arange(len(first))
            order.append(waiting[first])
            edges.append(np.zeros(len(first), np.int64) if level_edge is None else level_edge[first])
            parents.append(np.full(len(first), -1) if level_parent is None else level_parent[first])
            rest = np.ones(len(waiting), bool)
            rest[first] = False
            apart = _distance(prints[waiting], prints[waiting[first]][inverse])
            level_parent, level_edge = node_of[inverse][rest], apart[rest]
            waiting = waiting[rest]
            group = level_parent * (BITS + 1) + level_edge
            placed += len(first)
        self.item = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.edge = np.concatenate(edges) if edges else np.zeros(0, np.int64)
        parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        self.prints = prints[self.item]
        # Nodes were numbered by (parent, edge), so a parent's children are one run.
        key = parent * (BITS + 1) + self.edge
        self.keys = key[len(self.root_shards) :]
        self.first_child = len(self.root_shards)

    def search(self, shards: np.ndarray, prints: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs of (query position, item position) within ``radius``, in pieces."""
        at = np.searchsorted(self.root_shards, shards)
        known = at < len(self.root_shards)
        known[known] = self.root_shards[at[known]] == shards[known]
        stack = [(np.flatnonzero(known), at[known])]
        while stack:
            query, node = stack.pop()
            if len(query) > STEP:
                half = len(query) // 2
                stack += [(query[:half], node[:half]), (query[half:], node[half:])]
                continue
            apart = _distance(prints[query], self.prints[node])
            near = apart <= radius
            if near.any():
                yield query[near], self.item[node[near]]
            low = np.searchsorted(self.keys, node * (BITS + 1) + np.maximum(apart - radius, 1), "left")
            high = np.searchsorted(self.keys, node * (BITS + 1) + np.minimum(apart + radius, BITS), "right")
            n = high - low
            if n.any():
                ends = np.cumsum(n)
                child = np.arange(ends[-1]) - np.repeat(ends - n, n) + np.repeat(low, n) + self.first_child
                stack.append((np.repeat(query, n), child))


def _roots(n: int, pieces: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest position reachable for each of ``n`` positions."""
    root = np.arange(n)
    for a, b in pieces:
        while len(a):
            ra, rb = root[a], root[b]
            apart = ra != rb
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(root, root[root]):
                root = root[root]
    return root


def _star_links(trees, tree_prints, tree_nodes, queries, query_prints, query_nodes, radius):
    """Links between nodes contracted to one edge per node: (node, its root)."""
    both = np.concatenate([tree_nodes, query_nodes])
    nodes, position = np.unique(both, return_inverse=True)
    of_tree, of_query = position[: len(tree_nodes)], position[len(tree_nodes) :]
    found = BkForest(trees, tree_prints).search(queries, query_prints, radius)
    root = _roots(len(nodes), ((of_query[q], of_tree[t]) for q, t in found))
    linked = root != np.arange(len(nodes))
    return pa.RecordBatch.from_arrays(
        [pa.array(nodes[linked]), pa.array(nodes[root[linked]])], schema=_LINKS
    )


# --- Linking --------------------------------------------------------------------------


def runs_of_bits(blocks: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each run."""
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    return [(lo, hi - lo) for lo, hi in zip(cuts, cuts[1:], strict=False)]


def blocks_for(prints: int, max_bits: int) -> int:
    """Fewest runs at which a shard is expected to hold at most ``SHARD_NODES``."""
    blocks = max_bits + 1
    while blocks < 2 * max_bits and prints > SHARD_NODES << (BITS * (blocks - max_bits) // blocks):
        blocks += 1
    return blocks


def _shard_keys(fingerprint: Column, blocks: int, max_bits: int) -> Column:
    """One key per choice of runs; the choice is hashed in with the bits."""
    runs = runs_of_bits(blocks)
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - max_bits)):
        mask = 0
        for run in chosen:
            low, size = runs[run]
            mask |= ((1 << size) - 1) << low
        signed = mask - (1 << BITS) if mask >> (BITS - 1) else mask
        keys.append(F.struct(F.lit(number).alias("choice"), fingerprint.bitwiseAND(F.lit(signed)).alias("bits")))
    return F.array(*keys)


def link_fingerprints(prints: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges ``a``, ``b`` that connect the distinct ``fingerprint`` values within ``max_bits``."""
    blocks = blocks_for(prints.count(), max_bits)
    sharded = prints.select(
        F.explode(_shard_keys(F.col("fingerprint"), blocks, max_bits)).alias("s"), "fingerprint"
    ).select("s.choice", "s.bits", "fingerprint")
    large = written(
        sharded.groupBy("choice", "bits").count().where(F.col("count") > TREE_NODES), "large-shards"
    ).withColumn("parts", F.ceil(F.col("count") / TREE_NODES).cast("int")).drop("count")
    small = sharded.join(large, ["choice", "bits"], "left_anti")
    return _small_shards(small, max_bits).union(_large_shards(sharded.join(large, ["choice", "bits"]), max_bits))


def _small_shards(shards: DataFrame, max_bits: int) -> DataFrame:
    """Whole shards pass a task in order; those that end in a batch are searched together."""

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64)] * 3

        def search(choice, bits, prints):
            _, shard = np.unique(np.stack([choice, bits]), axis=1, return_inverse=True)
            shard = shard.reshape(-1)
            return _star_links(shard, prints, prints, shard, prints, prints, max_bits)

        for batch in batches:
            arrays = [np.concatenate([old, new.to_numpy()]) for old, new in zip(kept, batch.columns, strict=True)]
            choice, bits, _ = arrays
            change = np.flatnonzero((choice[1:] != choice[:-1]) | (bits[1:] != bits[:-1]))
            cut = change[-1] + 1 if len(change) else 0
            if cut:
                yield search(*(x[:cut] for x in arrays))
            kept = [x[cut:] for x in arrays]
        if len(kept[0]):
            yield search(*kept)

    ordered = shards.select(F.col("choice").cast("long"), "bits", "fingerprint")
    ordered = ordered.repartition("choice", "bits").sortWithinPartitions("choice", "bits", "fingerprint")
    return ordered.mapInArrow(link, "a long, b long")


def _large_shards(shards: DataFrame, max_bits: int) -> DataFrame:
    """Trees of a large shard against its query blocks, one group per pair of parts."""
    part = F.pmod(F.xxhash64("fingerprint"), "parts").cast("int")
    everywhere = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    paired = shards.withColumn("part", part).withColumn("other", everywhere).select(
        "choice", "bits", F.least("part", "other").alias("tree"), F.greatest("part", "other").alias("query"),
        "part", "fingerprint",
    )

    def link(group: pa.Table) -> pa.Table:
        part, prints = group["part"].to_numpy(), group["fingerprint"].to_numpy()
        tree, query = part == group["tree"][0].as_py(), part == group["query"][0].as_py()
        zero = lambda mask: np.zeros(mask.sum(), np.int64)
        links = _star_links(zero(tree), prints[tree], prints[tree], zero(query), prints[query], prints[query], max_bits)
        return pa.Table.from_batches([links])

    return paired.groupBy("choice", "bits", "tree", "query").applyInArrow(link, "a long, b long")


def components_of(printed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``fingerprint``, ``component`` (a fingerprint), ``component_id`` (the smallest doc_id)
    for every distinct fingerprint of ``doc_id``, ``fingerprint`` rows."""
    smallest = written(
        printed.groupBy("fingerprint").agg(F.min("doc_id").alias("smallest")), "fingerprints"
    )
    edges = link_fingerprints(smallest.select("fingerprint"), max_bits)
    linked = components(edges)
    grouped = smallest.join(linked.withColumnRenamed("node", "fingerprint"), "fingerprint", "left").select(
        "fingerprint", "smallest", F.coalesce("component", "fingerprint").alias("component")
    )
    roots = written(
        grouped.groupBy("component").agg(F.min("smallest").alias("component_id")), "component-roots"
    )
    return grouped.join(roots, "component").select("fingerprint", "component", "component_id")


def near_duplicates(
    docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (bigint), ``component_id`` for every row of ``docs``."""
    printed = written(
        with_fingerprint(docs.select("doc_id", "text"), "fingerprint", words_per_shingle).drop("text"),
        "printed",
    )
    return printed.join(components_of(printed, max_bits), "fingerprint").select(
        "doc_id", "fingerprint", "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame, words_per_shingle: int = SHINGLE_WORDS, max_bits: int = MAX_BITS
) -> DataFrame:
    """``docs`` with one row of each component: the smallest doc_id, ids before nulls."""
    names = [fresh_name(docs, n) for n in ("simhash_print", "simhash_row", "simhash_keep")]
    print_, row, keep = names
    # Rows are numbered in a written table, so every reading sees the same numbers.
    printed = written(
        with_fingerprint(docs, print_, words_per_shingle).withColumn(row, F.monotonically_increasing_id()),
        "printed-docs",
    )
    slim = printed.select(F.col("doc_id"), F.col(print_).alias("fingerprint"), F.col(row).alias("row"))
    found = slim.join(components_of(slim.select("doc_id", "fingerprint"), max_bits), "fingerprint")
    smallest = found.where(F.col("doc_id").eqNullSafe(F.col("component_id")))
    first = smallest.groupBy("component").agg(F.min("row").alias(keep))
    return printed.join(first.select(F.col(keep).alias(row)), row, "left_semi").select(*docs.columns)
