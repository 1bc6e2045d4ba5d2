"""Ranked lexical search by dense blocked matrix multiplication.

Items are taken in blocks of about ``ITEM_BYTES`` of text. For a block, the documents are
read once: an Arrow function counts each document's terms and keeps those of the block's
vocabulary, as one row of a written table. From it come the number of documents, their
terms and the document frequencies, all over the whole corpus, and from these the weights.

A second pass multiplies tiles: ``DOCUMENTS`` documents' impacts times ``TERMS`` terms of
the vocabulary, on the other side the weights of those items that hold a term of the tile.
All factors are integers in float64. An impact is below 10^6, a weight of a tile below
2^22 (larger ones go into further planes of 22 bits), a tile has 1024 terms: sums stay
below 2^53 and are exact in any order of addition. Tiles are added in 64-bit integers.

Of each tile of scores an item keeps its best, equal scores by the smaller id, and every
score that reaches the last one kept is looked at, so ties are decided by the id and never
by the tile. A task gives at most ``top`` rows an item; these are ranked in parts of an
item's rows first, then over all.

Memory in a task: the weights of a block, bounded by its bytes, one tile of documents, and
the counts of one part of a text (long texts are read in parts of ``PART_BYTES``). Only the
items of a block and the frequencies of its terms go through the driver.

Defined cases: null and empty texts have no terms, such documents do not count and such
items find nothing; items are queries by row, so repeated ones get their rows each;
documents are ranked by row, those without an id after others of the same score; no
documents or no items give an empty result; extra columns are ignored. Scores are long
integers; an item whose weights add up to more than 9 * 10^12 (some 10^8 terms) would leave
their range and is refused.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, functions as F

from fieldpulse.llm.best import Best, best_per_key
from fieldpulse.llm.common import slices
from fieldpulse.session import written

#: Bytes of items searched in one pass over the documents.
ITEM_BYTES = 1 << 17
#: Documents and terms of a tile; bits of a weight in a plane.
DOCUMENTS = 512
TERMS = 1024
PLANE_BITS = 22
#: Bytes of a text whose terms are split at a time.
PART_BYTES = 1 << 20
#: No impact reaches this.
IMPACTS = 1_000_000

#: Terms in UTF-8: every byte of a character beyond ASCII belongs to one.
TERM = re.compile(rb"[0-9A-Za-z\x80-\xff]+")
_BETWEEN = re.compile(rb"[^0-9A-Za-z\x80-\xff]")

_HITS = "id long, length long, columns array<int>, counts array<long>"
_FOUND = "item int, id long, score long"


def count_terms(text: bytes) -> Counter:
    """Occurrences of each term; only A-Z are lower-cased."""
    counts: Counter = Counter()
    start = 0
    while start < len(text):
        end = start + PART_BYTES
        if end < len(text):
            gap = _BETWEEN.search(text, end)
            end = gap.start() if gap else len(text)
        counts.update(TERM.findall(text[start:end].lower()))
        start = end
    return counts


def _hits(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """Per document with a term: its number of terms, and columns and counts of those in the vocabulary."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            ids, lengths, columns, counts = [], [], [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                found = count_terms(text.as_py())
                if not found:
                    continue
                ids.append(doc)
                lengths.append(found.total())
                held = [(column, n) for term, n in found.items() if (column := vocabulary.get(term)) is not None]
                columns.append([column for column, _ in held])
                counts.append([n for _, n in held])
            yield pa.RecordBatch.from_arrays([
                pa.array(ids, pa.int64()), pa.array(lengths, pa.int64()),
                pa.array(columns, pa.list_(pa.int32())), pa.array(counts, pa.list_(pa.int64())),
            ], ["id", "length", "columns", "counts"])

    return docs.mapInArrow(find, _HITS)


@dataclass(frozen=True)
class Tile:
    """Weights of some terms, as integers times ``scale``, for the items that hold one of them."""

    columns: np.ndarray
    items: np.ndarray
    weights: np.ndarray
    scale: int


def tiles(weights: list[dict[int, int]], width: int) -> list[Tile]:
    """Each item's weights by column, cut into tiles of columns and planes of bits."""
    entries = [(column, item, w) for item, held in enumerate(weights) for column, w in held.items() if w]
    by_tile: dict[tuple[int, int], list[tuple[int, int, int]]] = {}
    for column, item, w in entries:
        plane = 0
        while w:
            if digit := w & ((1 << PLANE_BITS) - 1):
                by_tile.setdefault((column // width, plane), []).append((column, item, digit))
            w, plane = w >> PLANE_BITS, plane + 1
    made = []
    for (_, plane), held in sorted(by_tile.items()):
        columns, column = np.unique([c for c, _, _ in held], return_inverse=True)
        items, item = np.unique([i for _, i, _ in held], return_inverse=True)
        matrix = np.zeros((len(items), len(columns)))
        matrix[item, column] = [digit for _, _, digit in held]
        made.append(Tile(columns, items, matrix, 1 << (PLANE_BITS * plane)))
    return made


def _norms(lengths: list[int], documents: int, terms: int) -> np.ndarray:
    """The part of an impact's divisor that grows with the document, in whole numbers."""
    return np.array([100 - 75 + (75 * n * documents) // terms for n in lengths], np.int64)


def tile_scores(made: list[Tile], items: int, rows: pa.RecordBatch, documents: int, terms: int) -> np.ndarray:
    """Scores of a tile of documents, items by documents."""
    columns = rows.column("columns")
    owner = np.repeat(np.arange(rows.num_rows), np.asarray(columns.value_lengths()))
    column = columns.flatten().to_numpy()
    counts = rows.column("counts").flatten().to_numpy()
    norm = _norms(rows.column("length").to_pylist(), documents, terms)[owner]
    impact = (1000 * IMPACTS * counts) // (1000 * counts + 8 * norm)
    order = np.argsort(column, kind="stable")
    owner, column, impact = owner[order], column[order], impact[order]
    scores = np.zeros((items, rows.num_rows), np.int64)
    for tile in made:
        low, high = np.searchsorted(column, (tile.columns[0], tile.columns[-1] + 1))
        place = np.searchsorted(tile.columns, column[low:high])
        of_tile = tile.columns[place] == column[low:high]
        impacts = np.zeros((len(tile.columns), rows.num_rows))
        impacts[place[of_tile], owner[low:high][of_tile]] = impact[low:high][of_tile]
        scores[tile.items] += (tile.weights @ impacts).astype(np.int64) * tile.scale
    return scores


def _search(hits: DataFrame, weights: list[dict[int, int]], documents: int, terms: int, top: int) -> DataFrame:
    """The best documents of each item within every task."""
    if any(sum(held.values()) * IMPACTS >= 1 << 63 for held in weights):
        raise ValueError("an item is too long for scores of 64 bits")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made = tiles(weights, TERMS)
        best = Best(len(weights), top, lowest=1)
        for rows in slices(batches, DOCUMENTS):
            if not rows.num_rows:
                continue
            scores = tile_scores(made, len(weights), rows, documents, terms)
            item, doc = np.nonzero(scores >= best.floor[:, None])
            ids = rows.column("id")
            no_id = ids.is_null().to_numpy(zero_copy_only=False)
            values = ids.fill_null(0).to_numpy()
            best.offer(item, scores[item, doc], values[doc], no_id[doc])
        yield pa.RecordBatch.from_arrays([
            pa.array(best.owner, pa.int32()), pa.array(best.id, pa.int64(), mask=best.no_id), pa.array(best.score),
        ], ["item", "id", "score"])

    return hits.mapInArrow(search, _FOUND)


def _search_block(docs: DataFrame, items: list[Row], top: int) -> DataFrame:
    """``items`` ranked against all documents."""
    counted = [count_terms(bytes(item["text"])) for item in items]
    vocabulary = {term: column for column, term in enumerate(sorted(set().union(*counted)))}
    hits = written(_hits(docs, vocabulary), "term-hits")
    documents, terms = hits.agg(F.count("*"), F.sum("length")).first()
    frequency = {
        row["column"]: row["n"]
        for row in hits.select(F.explode("columns").alias("column")).groupBy("column").agg(F.count("*").alias("n")).collect()
    }
    weight = {
        column: math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for column, n in frequency.items()
    }
    weights = [
        {vocabulary[t]: n * weight[vocabulary[t]] for t, n in terms_of.items() if vocabulary[t] in weight}
        for terms_of in counted
    ]
    found = best_per_key(
        _search(hits, weights, documents, terms or 1, top),
        ["item"], [F.desc("score"), F.asc_nulls_last("id")], top, "rank", F.col("id"),
    )
    names = docs.sparkSession.createDataFrame(
        [(number, item["id"]) for number, item in enumerate(items)], "item int, item_id long"
    )
    return found.join(F.broadcast(names), "item").select(
        "item_id", "rank", F.col("id").alias("doc_id"), "score"
    )


def rank_documents(docs: DataFrame, items: DataFrame, top: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each item with a score above 0.

    Takes ``doc_id, text`` and ``item_id, text``, the ids integers.
    """
    texts = docs.select(
        F.col("doc_id").cast("long").alias("id"), F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    )
    queries = items.where("text <> ''").select(
        F.col("item_id").cast("long").alias("id"), F.col("text").cast("binary").alias("text")
    )
    size = queries.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    blocks = math.ceil(size / ITEM_BYTES)
    block = F.pmod(F.xxhash64("id", "text"), F.lit(max(1, blocks)))
    found = [
        _search_block(texts, held, top)
        for number in range(blocks) if (held := queries.where(block == number).collect())
    ]
    if not found:
        return docs.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, found)
