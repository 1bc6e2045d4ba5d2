"""Decontamination, line dedup and the shared helpers against plain forms, on odd tables."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from fieldpulse.llm import common, decontaminate as dc, line_dedup as ld

# --- Decontamination ------------------------------------------------------------------


def shingles(text, lengths=None):
    """Of five words, or of all words of a shorter item; a document's are of all ``lengths``."""
    words = [w for w in re.split(r"[\W_]+", (text or "").lower()) if w]
    return {tuple(words[i:i + k]) for k in lengths or [min(5, len(words))] if k for i in range(len(words) - k + 1)}


def plain_finds(docs, items):
    by_item = defaultdict(set)
    for item_id, text in items:
        by_item[item_id] |= shingles(text)
    found = set()
    for doc_id, text in docs:
        held = shingles(text, range(1, 6))
        for item_id, wanted in by_item.items():
            if wanted and len(wanted & held) >= 0.8 * len(wanted) - 1e-9:
                found.add((doc_id, item_id, len(wanted), len(wanted & held)))
    return sorted(map(str, found))


def finds(spark, docs, items):
    found = dc.find_contaminated(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )
    return sorted(str(tuple(r)) for r in found.select("doc_id", "item_id", "n_shingles", "n_matched").collect())


def test_containment_against_all_pairs(spark):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(400)]
    passage = lambda n: [rng.choice(words) for _ in range(n)]
    items = [(i, " ".join(passage(rng.choice([3, 5, 6, 9, 14, 30, 64, 65])))) for i in range(40)]
    docs = []
    for d in range(120):
        body = passage(rng.choice([0, 4, 40, 600]))
        if d % 3 == 0:
            inside = items[d % 40][1].split()
            for _ in range(rng.choice([0, 1, 2, 4])):
                inside[-1 - rng.randrange(min(3, len(inside)))] = "changed"
            at = rng.randint(0, len(body))
            body[at:at] = inside
        docs.append((d, rng.choice([" ", ", ", "\n", " - "]).join(body).title()))
    expected = plain_finds(docs, items)
    assert len(expected) >= 10
    assert finds(spark, docs, items) == expected


@pytest.mark.parametrize("n", range(1, 40))
def test_sketches_meet_every_set_that_is_contained_enough(n):
    """One sketch entry more than can be missing."""
    import math

    largest = 2 ** (math.floor(math.log2(n)) + 1) - 1
    needed = largest - math.ceil(largest * 0.8 - 1e-9) + 1
    assert min(needed, n) > n - math.ceil(0.8 * n - 1e-9)


def test_odd_documents_and_items(spark):
    item = "one two three four five six seven"
    items = [(1, item), (1, item), (2, "too few words here"), (3, None), (4, ""), (None, "a b c d e f"), (5, "É à ü ñ ß ok")]
    docs = [
        (1, item), (1, item), (None, f"x {item.upper()}! y"), (2, None), (3, ""), (4, "too few words here"),
        (5, "one two three four five " * 3), (6, "a-b_c d\te\nf"), (7, "É À Ü Ñ ẞ".lower() + " ok"), (8, "word " * 20_000),
    ]
    assert finds(spark, docs, items) == plain_finds(docs, items)
    table = spark.createDataFrame([(*d, "k", 1) for d in docs], "doc_id long, text string, key string, n_matched int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    kept = dc.decontaminate(table, bench)
    assert kept.columns == table.columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == ["2", "3", "5", "8"]
    assert dc.decontaminate(table, bench.limit(0)).count() == len(docs)
    assert dc.decontaminate(table.limit(0), bench).count() == 0


def test_short_items_are_found_at_their_own_length(spark):
    items = [(1, "Four words, no more"), (2, "two words"), (3, "一つの文 次の文"), (4, "two words of five or so"), (4, "alone"), (5, "-!")]
    docs = [
        (1, "there are four words no more here"), (2, "four words no less"), (3, "see TWO-words, twice: two words"),
        (4, "。一つの文、次の文。"), (5, "two words of five or so"), (6, "two words of five or so, alone"), (7, "alone"), (8, None),
    ]
    expected = plain_finds(docs, items)
    assert finds(spark, docs, items) == expected
    assert {(1, 1), (3, 2), (4, 3), (6, 4)} <= {eval(row)[:2] for row in expected} and len(expected) == 6


# --- Line dedup -----------------------------------------------------------------------


def plain_lines(docs, min_sites):
    split = [None if t is None else t.split("\n") for t, _ in docs]
    strip = lambda line: line.strip(ld.BLANKS)

    sites, sets = defaultdict(set), defaultdict(set)
    for lines, (_, site) in zip(split, docs, strict=True):
        held = frozenset(strip(line) for line in lines or () if strip(line))
        for line in held:
            sites[line].add(site)
            sets[line].add(held)
    gone = {line for line in sites if len(sites[line]) >= min_sites and len(sets[line]) >= min_sites}
    return [None if ls is None else "\n".join(x for x in ls if strip(x) not in gone) for ls in split]


def cleaned(spark, docs, min_sites):
    table = spark.createDataFrame([(i, *d) for i, d in enumerate(docs)], "doc_id long, text string, source string")
    rows = ld.remove_boilerplate(table, min_sites, counted="n").orderBy("doc_id").collect()
    return [r["text"] for r in rows], [r["n"] for r in rows]


@pytest.mark.parametrize("min_sites", [2, 5, 12])
def test_lines_against_plain_counts(spark, min_sites):
    rng = random.Random(min_sites)
    own = lambda: " ".join(rng.choice("abcdefghij") * rng.randint(1, 9) for _ in range(rng.randint(2, 12)))
    common_lines = [f"notice {i} of all sites" for i in range(12)]
    copied = "\n".join(own() for _ in range(12))
    docs = []
    for i in range(260):
        lines = [own() for _ in range(rng.randint(0, 8))]
        for line in common_lines[: rng.randint(0, 12)]:
            if rng.random() < 0.4:
                lines.insert(rng.randint(0, len(lines)), rng.choice(["", " ", "\t"]) + line)
        docs.append((rng.choice([copied, "\n".join(lines)]) if i % 4 == 0 else "\n".join(lines), f"s{rng.randrange(20)}"))
    expected = plain_lines(docs, min_sites)
    texts, counts = cleaned(spark, docs, min_sites)
    assert texts == expected
    assert counts == [a.count("\n") - b.count("\n") if b else a.count("\n") + bool(a.strip()) for (a, _), b in zip(docs, expected, strict=True)]
    assert any(counts)


def test_copied_documents_stay_whole(spark):
    copied = "first line of a copied text\nsecond line of it\nthird"
    docs = [(copied + ("\nedited" if i % 2 else ""), f"s{i}") for i in range(30)]
    docs += [(f"own words of document {i}, long enough\nfooter", f"s{i}") for i in range(30)]
    texts, _ = cleaned(spark, docs, 10)
    assert texts[:30] == [t for t, _ in docs[:30]]
    assert texts[30:] == [f"own words of document {i}, long enough" for i in range(30)]


def test_a_passage_in_short_documents_goes_and_a_copied_page_stays(spark):
    passage = " ".join(f"passage{i}" for i in range(60))
    docs = [(f"short text {i}\n{passage}", f"s{i}") for i in range(12)]
    page = "\n".join(f"line {n} of the page that was copied" for n in range(6))
    docs += [(page, f"t{i}") for i in range(12)] + [(page, "t1")] * 30
    docs += [(f"{passage} unlike\nown {i % 9}", f"s{i}") for i in range(12)]
    texts, _ = cleaned(spark, docs, 10)
    assert texts == [f"short text {i}" for i in range(12)] + [t for t, _ in docs[12:]]
    # On nine sites, however many documents, it stays.
    nine = [(f"short text {i}\n{passage}", f"s{i % 9}") for i in range(90)]
    assert cleaned(spark, nine, 10)[0] == [t for t, _ in nine]


def test_odd_texts(spark):
    many = [(f"text number {i} with words of its own\nall\n\nall ", f"s{i}") for i in range(12)]
    docs = [*many, (None, "s1"), ("", "s1"), ("\n\n", None), ("all", "s3"), (" all\t\r\nall", None), ("x" * 200_000 + "\nall", "s4")]
    texts, counts = cleaned(spark, docs, 10)
    assert texts == plain_lines(docs, 10)
    assert texts[0] == "text number 0 with words of its own\n" and counts[0] == 2
    assert texts[12:] == [None, "", "\n\n", "", "", "x" * 200_000]


def test_repeated_rows_and_clashing_names(spark):
    rows = [(1, "same words in a long line of text\nfoot", f"s{i}", 3, "k") for i in range(12)]
    rows += [(None, "no id but text, also long enough\nfoot", None, 3, "k")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, line_key string")
    got = ld.remove_boilerplate(docs, 10)
    assert got.schema.simpleString() == docs.schema.simpleString()
    # All twelve are rows of one text: each has its line on twelve sites.
    kept = [(r["text"], r["n_chars"]) for r in got.collect()]
    assert all(n == len(t) for t, n in kept) and len(kept) == 14
    assert ld.remove_boilerplate(docs.limit(0), 10).collect() == []


def test_estimates_near_the_threshold_are_counted(spark):
    """Sites around the threshold, more than a sketch of this size holds exactly."""
    hits = [(line, site) for line in range(90, 111) for site in range(line) for _ in range(2)]
    rows = spark.createDataFrame(hits, "h long, site long").withColumn("site", F.xxhash64("site"))
    assert sorted(r["h"] for r in ld.spread_lines(rows, 100).collect()) == list(range(100, 111))


# --- Components -----------------------------------------------------------------------


@pytest.mark.parametrize("shape", ["random", "path", "star", "clique", "empty", "loops"])
def test_components(spark, shape):
    rng = random.Random(1)
    edges = {
        "random": [(rng.randrange(300), rng.randrange(300)) for _ in range(200)],
        "path": [(i + 1, i) if i % 2 else (i, i + 1) for i in range(120)],
        "star": [(500, i) for i in range(200)],
        "clique": [(i, j) for i in range(15) for j in range(15)],
        "empty": [],
        "loops": [(4, 4), (4, 4), (-3, 7), (7, -3), (7, 4)],
    }[shape]
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = common.components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["component"] for r in got} == {n: find(n) for n in root if find(n) != n}
    assert len(got) == len({r["node"] for r in got})
