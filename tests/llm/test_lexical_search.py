"""Ranked search against a plain count of every document's terms."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from fieldpulse.llm import best, lexical_search as ls

DOCS = "doc_id long, text string, rank string, score string"
ITEMS = "item_id long, text string, id string"


def terms(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+", lower)


def plain(docs, items, top=10):
    counted = [(i, Counter(terms(t))) for i, t in docs if terms(t)]
    n, size = len(counted), sum(c.total() for _, c in counted)
    out = []
    for item, text in items:
        found = []
        for doc, counts in counted:
            m = 25 + (75 * counts.total() * n) // size
            score = 0
            for term in terms(text):
                df = sum(1 for _, c in counted if term in c)
                if tf := counts[term]:
                    w = math.floor(1000 * math.log((2 * n + 2) / (2 * df + 1)))
                    score += w * ((1000000000 * tf) // (1000 * tf + 8 * m))
            if score > 0:
                found.append((-score, doc is None, doc, score))
        ranked = sorted(found, key=lambda f: f[:2] + (f[2] or 0,))[:top]
        out += [(item, rank, doc, score) for rank, (_, _, doc, score) in enumerate(ranked, 1)]
    return sorted(map(str, out))


def search(spark, docs, items, top=10):
    found = ls.rank_documents(
        spark.createDataFrame([(*d, "x", "y") for d in docs], DOCS).repartition(3),
        spark.createDataFrame([(*i, "x") for i in items], ITEMS), top,
    )
    assert found.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    return sorted(str(tuple(row)) for row in found.collect())


@pytest.mark.parametrize(("documents", "width", "bits", "block"), [(512, 1024, 22, 1 << 17), (3, 2, 3, 60), (7, 5, 12, 200)])
def test_against_a_plain_count(spark, monkeypatch, documents, width, bits, block):
    monkeypatch.setattr(ls, "DOCUMENTS", documents)
    monkeypatch.setattr(ls, "TERMS", width)
    monkeypatch.setattr(ls, "PLANE_BITS", bits)
    monkeypatch.setattr(ls, "ITEM_BYTES", block)
    monkeypatch.setattr(ls, "PART_BYTES", 16)
    rng = random.Random(documents)
    words = ["a", "B", "b", "Ñu", "ñu", "中文", "7", "x9", "ÉTÉ", "été", *[f"w{i}" for i in range(20)]]
    text = lambda most: rng.choice([" ", "-", "_\n"]).join(rng.choices(words, k=rng.randint(1, most)))
    docs = [(i, text(40)) for i in range(90)]
    docs += [(200 + i, docs[5][1]) for i in range(30)]
    items = [(i, text(12)) for i in range(9)]
    assert search(spark, docs, items, 4) == plain(docs, items, 4)


def test_odd_rows(spark):
    docs = [(1, None), (2, ""), (3, "..."), (4, "one two"), (5, "one two"), (5, "one two"), (None, "one two"), (6, "two"),
            (7, "zero " * 50)]
    items = [(1, "one ONE"), (1, "one ONE"), (2, None), (3, ""), (4, "nowhere"), (None, "two"), (5, "?!")]
    assert search(spark, docs, items) == plain(docs, items)
    assert search(spark, docs, items, 2) == plain(docs, items, 2)
    assert search(spark, docs[:3], items) == []
    assert search(spark, [], items) == []
    assert search(spark, docs, []) == []


def test_sums_stay_exact_beyond_float64(spark):
    docs = [(i, "rare " * (i + 1) + "filler " * 30) for i in range(3)] + [(9, "other")]
    items = [(0, "rare " * 400_000 + "filler")]
    got = search(spark, docs, items)
    assert got == plain_of_counts(docs, {"rare": 400_000, "filler": 1})
    weights = [{0: 3 << 40, 1: 5, 2000: 7}]
    made = ls.tiles(weights, 1024)
    assert all((tile.weights.sum(axis=1) * ls.IMPACTS < 2**53).all() for tile in made)
    total = Counter()
    for tile in made:
        for column, w in zip(tile.columns, tile.weights[0]):
            total[int(column)] += int(w) * tile.scale
    assert total == weights[0]


def plain_of_counts(docs, asked):
    counted = [(i, Counter(terms(t))) for i, t in docs]
    n, size = len(counted), sum(c.total() for _, c in counted)
    weight = {
        t: math.floor(1000 * math.log((2 * n + 2) / (2 * sum(1 for _, c in counted if t in c) + 1))) for t in asked
    }
    scores = []
    for doc, c in counted:
        m = 25 + (75 * c.total() * n) // size
        score = sum(times * weight[t] * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in asked.items())
        if score:
            scores.append((-score, doc))
    return sorted(str((0, rank, doc, -s)) for rank, (s, doc) in enumerate(sorted(scores), 1))


def test_best_of_many_offers():
    rng = np.random.default_rng(5)
    kept, offered = best.Best(4, 3, lowest=10), []
    for _ in range(30):
        n = int(rng.integers(1, 20))
        owner, score, ids = rng.integers(0, 4, n), rng.integers(0, 40, n), rng.integers(0, 9, n)
        no_id = rng.random(n) < 0.1
        offered += zip(owner.tolist(), score.tolist(), no_id.tolist(), ids.tolist())
        kept.offer(owner, score, ids, no_id)
    for owner in range(4):
        expected = sorted((-s, no, 0 if no else i) for o, s, no, i in offered if o == owner and s >= 10)[:3]
        got = [
            (-s, no, 0 if no else i) for o, s, no, i in
            zip(kept.owner.tolist(), kept.score.tolist(), kept.no_id.tolist(), kept.id.tolist()) if o == owner
        ]
        assert got == expected
