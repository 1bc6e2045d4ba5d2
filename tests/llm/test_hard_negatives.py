"""Mined negatives against all products, in integers without bound."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import hard_negatives as hn

DDL = "vec_id long, label int, embedding array<double>, rank string, score string"


def plain(rows, anchors):
    def usable(i, label, v):
        return i is not None and label is not None and v is not None and all(
            x is not None and math.isfinite(x) and math.isfinite(256 * x) for x in v
        )

    whole = [(i, label, [math.floor(256 * x) for x in v]) for i, label, v in rows if usable(i, label, v)]
    product = lambda v, w: min(max(sum(x * y for x, y in zip(v, w)), -(1 << 63)), (1 << 63) - 1)
    out = []
    for anchor, label, v in whole:
        if not anchors(anchor):
            continue
        scored = [(i, k, product(v, w)) for i, k, w in whole if i != anchor and len(w) == len(v)]
        positives = sorted((-s, i) for i, k, s in scored if k == label)[:5]
        for p, positive in positives:
            near = sorted((-s, i) for i, k, s in scored if k != label and 50 * -p <= 100 * s <= 95 * -p)[:3]
            out += [(anchor, positive, rank, i, -p, -s) for rank, (s, i) in enumerate(near, 1)]
    return sorted(map(str, out))


def mine(spark, rows, condition):
    df = spark.createDataFrame([(*row, "x", "y") for row in rows], DDL)
    found = hn.hard_negatives(df, condition)
    assert found.dtypes == [
        ("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"),
        ("positive_score", "bigint"), ("negative_score", "bigint"),
    ]
    return sorted(str(tuple(row)) for row in found.collect())


def structured(rng, n, dims, spread):
    centres = rng.normal(size=(12, dims))
    return centres[rng.integers(0, 12, n)] * rng.uniform(0.5, 2, (n, 1)) + rng.normal(scale=spread, size=(n, dims))


@pytest.mark.parametrize(("dims", "spread", "cluster", "segment", "stretch", "block"), [
    (8, 0.3, 64, 8192, 256, 16 << 20), (8, 0.1, 3, 50, 7, 1000), (2, 0.05, 5, 100, 10, 500), (32, 1.0, 8, 64, 64, 16 << 20),
])
def test_against_all_products(spark, monkeypatch, dims, spread, cluster, segment, stretch, block):
    for name, value in {"CLUSTER": cluster, "SEGMENT": segment, "STRETCH": stretch, "ANCHOR_BYTES": block}.items():
        monkeypatch.setattr(hn, name, value)
    rng = np.random.default_rng(dims)
    x = structured(rng, 500, dims, spread)
    rows = [(i, int(rng.integers(0, 3)), v.tolist()) for i, v in enumerate(x)]
    # A third of the rows are copies, so most scores tie.
    rows += [(1000 + i, i % 3, rows[4][2]) for i in range(250)]
    got = mine(spark, rows, F.col("vec_id") % 20 == 0)
    assert got and got == plain(rows, lambda i: i % 20 == 0)


def test_odd_rows(spark):
    one, two = [1.0, 0.5], [1.0, 0.4]
    rows = [
        (0, 1, one), (1, 1, one), (2, 2, two), (3, 2, one), (4, 2, [0.9, 0.4]), (5, None, two), (None, 2, two),
        (6, 2, None), (7, 2, [1.0, None]), (8, 2, [1.0, float("nan")]), (9, 2, [float("inf"), 0.0]),
        (10, 2, [1e308, 0.0]), (11, 2, [0.9, 0.3, 0.0]), (12, 1, []), (13, 1, []), (14, 2, []), (15, 1, [0.0, 0.0]),
        (16, 3, [0.0, 0.0]), (17, 3, [0.0, 0.0]), (18, 4, [-1.0, 0.0]), (3, 2, [0.8, 0.3]), (19, 1, one), (0, 1, one),
    ]
    everyone = lambda i: i is not None
    got = mine(spark, rows, F.lit(True))
    assert got and got == plain(rows, everyone)
    assert mine(spark, rows, F.col("vec_id") == 18) == []
    assert mine(spark, rows, F.lit(None).cast("boolean")) == []
    assert mine(spark, [], F.lit(True)) == []


def test_products_beyond_float64_are_exact(spark):
    big = float(2**40)
    rows = [(i, i % 2, [big + i, big - i, 1.0 * i]) for i in range(12)] + [(20 + i, i % 2, [1.0, 2.0, 1.0 * i]) for i in range(8)]
    rows += [(40, 0, [1e30, 0.0, 0.0]), (41, 1, [1e30, 1.0, 0.0])]
    assert mine(spark, rows, F.col("vec_id") % 4 == 0) == plain(rows, lambda i: i % 4 == 0)
    a = np.array([[2.0**30 + 1, 1.0], [3.0, 1.0]])
    assert hn.products(a, a).tolist() == [[(2**30 + 1) ** 2 + 1, 3 * (2**30 + 1) + 1], [3 * (2**30 + 1) + 1, 10]]


def test_walks_end_early_where_vectors_have_structure():
    rng = np.random.default_rng(1)
    x = structured(rng, 6000, 24, 0.02)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    as_table = lambda ids: pa.table({
        "id": ids, "label": np.zeros(len(ids), np.int64), "vector": pa.array(x[ids].tolist()),
    })
    made = hn.clusters(as_table(np.arange(0, 6000, 50)), 256)
    (_, rows), = hn.by_length(as_table(np.arange(6000)), 256)
    units, norms = hn._units(rows.values)
    taken = 0
    for cluster in made:
        n = len(cluster.members)
        whole = np.full(n, -(1 << 62)), np.full(n, 1 << 62)
        walk = hn.Walk(cluster, cluster.members, np.arange(n), *whole, True, hn.Best(n, 5))
        taken += walk.along(rows, units, norms)
    assert taken < 0.5 * 120 * 6000
