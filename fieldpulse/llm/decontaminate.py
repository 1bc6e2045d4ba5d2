"""Benchmark decontamination: size-partitioned MinHash containment search.

Items are grouped into size classes (powers of two of their number of distinct
shingles). An item's sketch is its smallest shingle hashes, as many as the class
needs: if at least ``threshold`` of an item's shingles occur in a document, at most
``n - ceil(threshold * n)`` are missing, so one more sketch entry than that must meet
the document. The sketch search thus loses no document, however long it is.
Candidates are then verified by exact shingle containment on the shingles' text.

Words are runs of letters, marks and digits of the lower-cased text. An item with fewer
words than a shingle is one shingle of all its words, and documents are searched at that
length as well; only lengths that the benchmark has cost anything. Defined cases: null or
empty texts and texts without a word hold nothing, and such items are found nowhere; an
item of one word is found wherever that word stands; repeated shingles count once; repeated documents are judged row by row (rows equal in id and text give one
result); repeated item ids are one item with all their shingles; an empty table on
either side gives no finds. Extra columns pass through and may have any name.

Only DataFrame functions are used. The corpus is not shuffled for the search: each
document's shingles meet the broadcast sketch table where they are read. That table
grows with the benchmark, not with the corpus, and is broadcast only if measured small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from fieldpulse.llm.common import broadcast_if_small, fresh_name, row_key
from fieldpulse.session import written

SHINGLE_WORDS = 5
THRESHOLD = 0.8
SEPARATORS = r"[^\p{L}\p{M}\p{N}]+"


def _with_words(df: DataFrame, text: str, words: str) -> DataFrame:
    return df.withColumn(words, F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATORS))


def _starts(words: Column, k: int) -> Column:
    """First positions of all shingles; splitting can leave an empty word at either end."""
    first = F.when(F.get(words, F.lit(0)) == "", 1).otherwise(0)
    last = F.size(words) - F.when(F.get(words, F.size(words) - 1) == "", 1).otherwise(0) - k
    return F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<int>"))


def _hashes(words: Column, k: int) -> Column:
    return F.transform(
        _starts(words, k), lambda i: F.xxhash64(*[F.get(words, i + j) for j in range(k)])
    )


def _texts(words: Column, k: int) -> Column:
    return F.transform(
        _starts(words, k), lambda i: F.concat_ws(" ", *[F.get(words, i + j) for j in range(k)])
    )


def item_shingles(benchmark: DataFrame, k: int) -> DataFrame:
    """``item_id``, ``shingle``, ``n_shingles``, ``length``: the distinct shingles of every item, in words long."""
    words = _with_words(benchmark.select("item_id", "text"), "text", "words")
    lengths = F.least(F.size(_starts(F.col("words"), 1)), F.lit(k))
    texts = F.lit(None).cast("array<string>")
    for length in range(1, k + 1):
        texts = F.when(lengths == length, _texts(F.col("words"), length)).otherwise(texts)
    shingles = words.select("item_id", lengths.alias("length"), F.explode(texts).alias("shingle")).distinct()
    return shingles.withColumn("n_shingles", F.count("*").over(Window.partitionBy("item_id")))


def sketches(shingles: DataFrame, threshold: float) -> DataFrame:
    """``item_id``, ``h``: each item's smallest hashes, as many as its size class needs."""
    largest = F.pow(F.lit(2), F.floor(F.log2("n_shingles")) + 1) - 1
    needed = largest - F.ceil(largest * threshold - 1e-9) + 1
    hashed = shingles.withColumn("h", F.xxhash64(*[F.get(F.split("shingle", " "), F.lit(j)) for j in range(SHINGLE_WORDS)]))
    rank = F.row_number().over(Window.partitionBy("item_id").orderBy("h", "shingle"))
    return hashed.withColumn("rank", rank).where(F.col("rank") <= needed).select("item_id", "h").distinct()


def find_contaminated(
    docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD
) -> DataFrame:
    """Documents that hold a benchmark item: ``key``, ``doc_id``, ``item_id``,
    ``n_shingles``, ``n_matched``, one row per pair with containment >= ``threshold``.

    ``key`` is :func:`common.row_key` of the document row.
    """
    k = SHINGLE_WORDS
    items = written(item_shingles(benchmark, k), "items")
    lengths = sorted({k, *(row["length"] for row in items.select("length").distinct().collect())})
    of_all = lambda shingles: F.flatten(F.array(*[shingles(F.col("words"), n) for n in lengths]))
    sketch = written(sketches(items, threshold), "sketches")
    keyed = docs.select(row_key().alias("key"), "doc_id", "text")

    searched = _with_words(keyed, "text", "words").select("key", F.explode(of_all(_hashes)).alias("h"))
    candidates = written(
        searched.join(broadcast_if_small(sketch, 16), "h").select("key").distinct(), "candidates"
    )

    suspects = keyed.join(candidates, "key", "left_semi")
    held = _with_words(suspects, "text", "words").select(
        "key", "doc_id", F.explode(of_all(_texts)).alias("shingle")
    )
    near = broadcast_if_small(items, F.octet_length("shingle") + 24)
    matched = held.join(near, "shingle").groupBy("key", "doc_id", "item_id").agg(
        F.max("n_shingles").alias("n_shingles"), F.count_distinct("shingle").alias("n_matched")
    )
    return matched.where(F.col("n_matched") >= F.ceil(F.col("n_shingles") * threshold - 1e-9))


def decontaminate(docs: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; all columns stay."""
    found = find_contaminated(docs, benchmark, threshold).select(F.col("key").alias("found")).distinct()
    key = fresh_name(docs, "key")
    found = found.withColumnRenamed("found", key)
    return docs.withColumn(key, row_key()).join(found, key, "left_anti").drop(key)
