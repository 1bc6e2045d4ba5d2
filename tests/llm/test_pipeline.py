"""The pipeline against plain forms of its stages, and the entry module with and without it."""

from __future__ import annotations

import re
import zlib
from collections import defaultdict

import duckdb
import pytest

import corpus_pipeline as pipeline
from fieldpulse.llm import quality_pu, simhash_dedup
from fieldpulse.llm.queries import vocabulary

SF_DIR = "/root/testdata/sf0.001"


def plain_lines(docs):
    """Texts without lines that stand on ten sites in ten different sets of lines."""
    split = [(t or "").split("\n") for _, t, _ in docs]
    strip = lambda line: line.strip(" \t\r\x0b\x0c")
    sites, sets = defaultdict(set), defaultdict(set)
    for lines, (_, _, site) in zip(split, docs, strict=True):
        held = frozenset(strip(line) for line in lines if strip(line))
        for line in held:
            sites[line].add(site)
            sets[line].add(held)
    gone = {line for line in sites if len(sites[line]) >= 10 and len(sets[line]) >= 10}
    return ["\n".join(x for x in ls if strip(x) not in gone) for ls in split]


def plain_run(docs, benchmark, good):
    docs = [d for d in docs if d[0] in good]
    texts = plain_lines(docs)
    prints = [simhash_dedup.fingerprint_of(t) for t in texts]
    group = list(range(len(docs)))
    for i in range(len(docs)):
        for j in range(i):
            if bin((prints[i] ^ prints[j]) & (2**64 - 1)).count("1") <= 4:
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    first = {}
    for i, g in enumerate(group):
        first[g] = min(first.get(g, i), i, key=lambda k: docs[k][0])
    shingles = lambda t: {tuple(w[i:i + 5]) for w in [re.findall(r"[^\W_]+", t.lower())] for i in range(len(w) - 4)}
    items = [shingles(t) for t in benchmark]
    kept = {}
    for i in first.values():
        held = shingles(texts[i])
        if not any(item and len(item & held) >= 0.8 * len(item) for item in items):
            kept[docs[i][0]] = texts[i]
    return kept


def test_pipeline_against_the_plain_form(spark):
    from tokenizers import Tokenizer

    tables = {t: duckdb.sql(f"SELECT * FROM read_parquet('{SF_DIR}/{t}.parquet')") for t in ("documents", "benchmark")}
    docs = tables["documents"].project("doc_id, text, source").fetchall()
    benchmark = [r[0] for r in tables["benchmark"].project("text").fetchall()]
    source = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    good = {r["doc_id"] for r in quality_pu.keep_good(source, spark.read.parquet(f"{SF_DIR}/labels.parquet")).collect()}
    expected = plain_run(docs, benchmark, good)
    assert 0 < len(expected) < len(good) < len(docs)

    tokenizer = Tokenizer.from_file(vocabulary())
    got = defaultdict(list)
    for r in pipeline.run(spark, SF_DIR).collect():
        got[r["doc_id"]].append(r)
    assert got.keys() == expected.keys()
    for doc_id, pieces in got.items():
        ids = [*tokenizer.encode(expected[doc_id], add_special_tokens=False).ids, 2]
        for r in pieces:
            part = ids[r["start"]:r["start"] + r["length"]]
            assert r["ids_crc32"] == zlib.crc32(b"".join(i.to_bytes(4, "little") for i in part))
            assert r["doc_tokens"] == len(ids) and r["offset"] + r["length"] <= 4096
        assert sum(r["length"] for r in pieces) == len(ids)


def test_stages_return_the_columns_of_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    for name, stage in pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF_DIR).schema.simpleString() == docs.schema.simpleString(), name


def test_entry_lists_every_query_and_lives_without_them(monkeypatch):
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if re.match(r"op\d+_", n)]
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names} == set(range(1, 14)) and len(names) == 13
    assert entry.queries()["pipeline"] is pipeline.run
    assert set(entry.oracle_sql()) <= set(entry.queries())

    real = entry.importlib.import_module

    def without(name, *rest):
        if name in ("fieldpulse.llm.queries", "corpus_pipeline"):
            raise ModuleNotFoundError(name=name.removesuffix(".queries"))
        return real(name, *rest)

    monkeypatch.setattr(entry.importlib, "import_module", without)
    assert not [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert set(entry.oracle_sql()) == set(entry.queries())

    def broken(name, *rest):
        raise ModuleNotFoundError(name="numpy")

    monkeypatch.setattr(entry.importlib, "import_module", broken)
    with pytest.raises(ModuleNotFoundError):
        entry.queries()
