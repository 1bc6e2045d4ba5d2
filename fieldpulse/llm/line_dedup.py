"""Line dedup by distinct-site spread.

A line that stands on many sites is boilerplate, unless it is there because whole documents
were copied. So per line hash two HyperLogLog sketches are merged by aggregation: one of the
sites, and one of the distinct sets of lines that the documents with it have. Copies of a
document are one set, however many sites they are on. Lines for which either estimate lies
near the threshold get exact distinct counts. What stands on enough sites in as many
different sets of lines is removed from all documents; the lines of a copied document stay,
and document dedup decides about it.

Lines are cut at ``\\n``, compared without white space at their ends, and blank lines
always stay. Defined cases: a null text stays null; an empty text stays empty; a
document of boilerplate alone becomes empty; a null source is one site; a line
repeated in a document counts once for its site and goes at every place; an empty
table stays empty. ``n_chars``, where present, follows the new text. Other columns
pass through and may have any name.

Only DataFrame functions are used. Sketches and counts combine before the shuffle,
so a line on a third of all rows is one partial row per task. The boilerplate set is
joined, never collected.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from fieldpulse.llm.common import broadcast_if_small, fresh_name, row_key
from fieldpulse.session import written

MIN_SITES = 10
#: Sketches have 2 ** LG_K registers; their relative error is below 1.04 / sqrt(2 ** LG_K).
LG_K = 8
#: Estimates within this share of the threshold are counted exactly: four standard errors.
BAND = 4 * 1.04 / 2 ** (LG_K / 2)
BLANKS = " \t\r\x0b\x0c"


def line_hash(line: Column) -> Column:
    return F.xxhash64(F.btrim(line, F.lit(BLANKS)))


def _is_blank(line: Column) -> Column:
    return F.btrim(line, F.lit(BLANKS)) == ""


def spread_lines(hits: DataFrame, least: int, of: list[str] = ("site",)) -> DataFrame:
    """Hashes ``h`` that have at least ``least`` distinct values of every column in ``of``."""
    sketches = hits.groupBy("h").agg(*[F.hll_sketch_agg(name, LG_K).alias(name) for name in of])
    estimates = sketches.select("h", *[F.hll_sketch_estimate(name).alias(name) for name in of])
    every = lambda bound: reduce(Column.__and__, [F.col(name) >= bound for name in of])
    possible = written(estimates.where(every(least * (1 - BAND))), "possible-lines")
    sure = reduce(Column.__and__, [F.col(name) > least * (1 + BAND) for name in of])
    near = written(hits.join(possible.where(~sure), "h", "left_semi").distinct(), "near-lines")
    exact = [near.groupBy("h").agg(F.count_distinct(name).alias("n")).where(F.col("n") >= least).select("h") for name in of]
    return possible.where(sure).select("h").union(reduce(lambda a, b: a.join(b, "h", "left_semi"), exact))


def boilerplate_of(docs: DataFrame, min_sites: int = MIN_SITES) -> DataFrame:
    """``key``, ``removed``: per document row key the hashes of its boilerplate lines."""
    bodies = F.filter(F.split("text", "\n"), lambda line: ~_is_blank(line))
    hashed = docs.select(
        row_key().alias("key"),
        F.coalesce(F.xxhash64(F.col("source").cast("string")), F.lit(0)).alias("site"),
        F.array_sort(F.array_distinct(F.transform(bodies, line_hash))).alias("hashes"),
    )
    lines = hashed.select("key", "site", F.xxhash64("hashes").alias("lines"), F.explode("hashes").alias("h"))
    boilerplate = written(spread_lines(lines.drop("key"), min_sites, ["site", "lines"]), "boilerplate")
    small = broadcast_if_small(boilerplate, 8)
    return lines.join(small, "h", "left_semi").groupBy("key").agg(F.collect_set("h").alias("removed"))


def remove_boilerplate(docs: DataFrame, min_sites: int = MIN_SITES, counted: str | None = None) -> DataFrame:
    """``docs`` with boilerplate lines cut out of ``text``.

    ``counted`` names a column to add with the number of lines removed.
    """
    key, removed = fresh_name(docs, "line_key"), fresh_name(docs, "line_hashes")
    found = boilerplate_of(docs, min_sites).withColumnsRenamed({"key": key, "removed": removed})
    joined = docs.withColumn(key, row_key()).join(found, key, "left")
    lines = F.split("text", "\n")
    kept = F.filter(lines, lambda line: _is_blank(line) | ~F.array_contains(F.col(removed), line_hash(line)))
    text = F.when(F.col(removed).isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    changes = {"text": text}
    if counted:
        changes[counted] = F.when(F.col(removed).isNull(), 0).otherwise(F.size(lines) - F.size(kept))
    result = joined.withColumns(changes).drop(key, removed)
    if "n_chars" in docs.columns:
        result = result.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return result.select(*docs.columns, *([counted] if counted else []))
