from __future__ import annotations

import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import quality_pu as pu
from fieldpulse.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    rows = QUERIES["op3_quality_classifier"](spark, SF_DIR).collect()
    labels = dict(duckdb.sql(f"SELECT doc_id, quality FROM read_parquet('{SF_DIR}/labels.parquet')").fetchall())
    assert len(rows) == 1000
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3)
    good = np.array([r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 1])
    bad = np.array([r["score"] for r in rows if r["held_out"] and labels.get(r["doc_id"]) == 0])
    assert (good[:, None] > bad[None]).mean() > 0.97
    assert (good >= 0.3).mean() > 0.97


def test_held_out_labels_change_nothing(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    flipped = labels.selectExpr(
        "doc_id", "CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 5 = 0 THEN 1 - quality ELSE quality END quality"
    )
    assert np.array_equal(pu.train(docs, labels).weights, pu.train(docs, flipped).weights)


def test_negative_labels_are_not_used(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    assert np.array_equal(pu.train(docs, labels).weights, pu.train(docs, labels.where("quality = 1")).weights)


@pytest.mark.parametrize("prior", [0.3, 0.6, 0.85])
def test_prior_of_known_mixtures(prior):
    rng = np.random.default_rng(1)
    positive = rng.normal(1.5, 1, (3000, 3))
    n = int(6000 * prior)
    unlabelled = np.concatenate([rng.normal(1.5, 1, (n, 3)), rng.normal(-1.5, 1, (6000 - n, 3))])
    assert abs(pu.estimate_prior(positive, unlabelled, rng) - prior) < 0.06


def test_risk_gradient_against_differences():
    rng = np.random.default_rng(2)
    n_p, n_u, prior = 40, 60, 0.6
    rows, slope = next(iter(pu._non_negative(n_p, n_u, prior)(rng)))
    cut = int((rows < n_p).sum())

    def risk(z):
        positive, unlabelled = z[:cut], z[cut:]
        negative = np.logaddexp(0, unlabelled).mean() - prior * np.logaddexp(0, positive).mean()
        return prior * np.logaddexp(0, -positive).mean() + negative, negative

    for scale in (0.1, 3.0):
        z = rng.normal(0, scale, len(rows))
        z[cut:] += 2 * scale  # keeps the negatives' risk above zero
        assert risk(z)[1] > 0
        numeric = [(risk(z + h)[0] - risk(z - h)[0]) / 2e-6 for h in np.eye(len(z)) * 1e-6]
        assert np.allclose(slope(z), numeric, atol=1e-5)
    z = np.where(np.arange(len(rows)) < cut, 9.0, -9.0)
    assert risk(z)[1] < 0
    numeric = [-(risk(z + h)[1] - risk(z - h)[1]) / 2e-6 for h in np.eye(len(z)) * 1e-6]
    assert np.allclose(slope(z), numeric, atol=1e-5)


def test_edges(spark):
    ddl = "doc_id long, score string, text string"
    docs = spark.createDataFrame([(1, "a", None), (None, "b", ""), (1, "c", "x " * 50000), (2, None, "Some text.")], ddl)
    labels = spark.createDataFrame([(1, 1), (1, 1), (2, None), (None, 1), (99, 1)], "doc_id long, quality int")
    scored = pu.score(docs, pu.train(docs, labels), "quality_score").collect()
    assert len(scored) == 4 and all(0 <= r["quality_score"] <= 1 for r in scored)
    assert pu.keep_good(docs, labels).columns == docs.columns
    nothing = docs.limit(0)
    assert pu.keep_good(nothing, labels.limit(0)).collect() == []
    unlabelled = pu.score(docs, pu.train(docs, labels.limit(0)), "s").collect()
    assert {r["s"] for r in unlabelled} == {0.5}


def test_mean_score_of_all_unlabelled_rows_is_the_prior(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = pu.train(docs, labels, positives=100, unlabelled=100)
    rows = pu.score(docs.where(~pu.held_out()), model).collect()
    assert abs(np.mean([r["score"] for r in rows]) - model.prior) < 1e-6


@pytest.mark.parametrize("doc_id", [5, None])
def test_sample_under_a_hot_id_is_bounded(spark, doc_id):
    rows = [(doc_id if i % 3 else i, "equal" if i % 2 else f"text {i}") for i in range(9000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for salt in range(4):
        hot = pu._sample(docs, salt, 900, len(rows)).where(F.col("doc_id").eqNullSafe(F.lit(doc_id))).count()
        assert 450 < hot < 750
