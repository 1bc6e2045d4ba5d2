"""The registered corpus queries: each applies its operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from fieldpulse.llm import (
    decontaminate,
    hard_negatives,
    lexical_search,
    line_dedup,
    main_text,
    packing,
    pii,
    quality_pu,
    simhash_dedup,
    token_counts,
    token_store,
    url_rules,
    vector_dedup,
)
from fieldpulse.session import scratch_path
from fieldpulse.llm.oracles import ORACLES  # noqa: F401  read by the entry module
from fieldpulse.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def _register(build):
    QUERIES[build.__name__] = build
    return build


@_register
def op1_benchmark_decontamination(spark, sf_dir):
    """Every document that holds a benchmark item, with the exact containment."""
    found = decontaminate.find_contaminated(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.select("doc_id", "item_id", "n_shingles", "n_matched")


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    """Path of the vocabulary file; the package is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


@_register
def op2_token_store(spark, sf_dir):
    """Every document's place and checksum, read back from the written store."""
    path = scratch_path(spark, "token-store")
    token_store.write_store(table(spark, sf_dir, "documents"), path, vocabulary(), end_id=1)
    return token_store.read_store(spark, path).select(
        "doc_id", "start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


@_register
def op3_quality_classifier(spark, sf_dir):
    """Every document's score by a model of trusted positives and unlabelled text."""
    docs = table(spark, sf_dir, "documents")
    scored = quality_pu.learn_and_score(docs, table(spark, sf_dir, "labels"), ["doc_id"])
    return scored.select(
        "doc_id", quality_pu.held_out().alias("held_out"), "score",
        (F.col("score") >= quality_pu.THRESHOLD).cast("int").alias("predicted"),
    )


#: Key of the registered query only; a job gives its own from a secret store.
PII_KEY = "demonstration key"


@_register
def op5_pii_pseudonyms(spark, sf_dir):
    """Every document with its personal data replaced by format-preserving pseudonyms."""
    replaced = pii.pseudonymise(table(spark, sf_dir, "documents"), PII_KEY, counted="n_replaced")
    return replaced.select("doc_id", "text", F.col("n_replaced").cast("long").alias("n_replaced"))


@_register
def op4_html_extraction(spark, sf_dir):
    """Every page's main text."""
    extracted = main_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    return extracted.select("page_id", "url", "text", "n_chars")


URL_RULES = [
    url_rules.Rule.parse("allow", "com/"),
    url_rules.Rule.parse("block", "example.com/en/"),
    url_rules.Rule.parse("allow", "www.example.com/en/"),
    url_rules.Rule.parse("block", "net/es/"),
    url_rules.Rule.parse("block", "net/fr/"),
]


@_register
def op6_url_filters(spark, sf_dir):
    """Every page's url judged by the curated rules, else by those mined from their verdicts."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    judged = url_rules.judge(pages, URL_RULES, mined_rule="mined_rule")
    return judged.select("page_id", "host", "path", "rule", "verdict", "mined_rule")


@_register
def op7_embedding_near_dedup(spark, sf_dir):
    """Every vector's links at cosine 0.95 or more and the smallest vec_id of its component."""
    return vector_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@_register
def op8_packing(spark, sf_dir):
    """Every piece of every document with its place in a sequence of at most 4096 ids."""
    packed = packing.pack(table(spark, sf_dir, "documents"), vocabulary(), end_id=2)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@_register
def op9_simhash_near_dedup(spark, sf_dir):
    """Every document with its fingerprint and the smallest doc_id of its group."""
    found = simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")


@_register
def op10_line_dedup(spark, sf_dir):
    """Every document without its cross-site boilerplate lines."""
    cleaned = line_dedup.remove_boilerplate(table(spark, sf_dir, "documents"), counted="n_removed")
    return cleaned.select("doc_id", "text", F.col("n_removed").cast("long").alias("n_removed"))


#: Tokens beyond which a text is over the limit.
TOKEN_LIMIT = 1024


@_register
def op11_token_counts(spark, sf_dir):
    """Every document's bytes and tokens."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, vocabulary("byte_bpe_50k.json"), TOKEN_LIMIT)
    return counted.select("doc_id", "n_bytes", "n_tokens", "over_limit")


@_register
def op12_hard_negatives(spark, sf_dir):
    """The hard negatives of every fiftieth vector, for each of its positives."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", moved)
    return hard_negatives.hard_negatives(vectors, F.col("vec_id") % 50 == 0)


@_register
def op13_ranked_lexical_search(spark, sf_dir):
    """The ten documents of each benchmark item that score highest."""
    return lexical_search.rank_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
