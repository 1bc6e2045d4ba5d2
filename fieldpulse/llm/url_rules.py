"""URL filters: curated rules first, then association rules mined by FP-growth.

A curated rule names a host and the start of a path. It fits its host and all
subdomains; of those that fit, the longest wins. Curated verdicts label pages. A URL's
tokens (labels of the host with their level, path segments, file endings, query keys,
scheme, fragment) and its label are one transaction; Spark's FP-growth finds the token
combinations that are frequent, and those that imply a label with enough confidence
become rules. A rule is dropped if one with a token less says the same at least as
surely. Rules are matched by an inverted index: each stands under its rarest token, a
URL looks up its own tokens and checks the rest of each rule found. The surest rule
decides; ties go to the better supported, then the shorter, then to blocking.

A mined rule may block only on evidence of its own: under one top host label there must be
a labelled url that it fits and that is blocked, and an allowed one that it does not fit. So
a path may block that is blocked on ``com`` while other paths there are allowed, wherever it
occurs; the label ``net`` may not, if all that is labelled under it is blocked: that says
which urls were judged, not why.

FP-growth gives every subset of tokens that occur together, so transactions are reduced
first, without losing a rule: infrequent tokens go; tokens that stand in exactly the same
labelled urls become one item, which a URL has if it has any of them; an item that by
itself implies a label in all its urls, or that all urls have, is judged alone, as each
larger rule with it would be dropped. What can still grow are items that almost always
occur together, in different urls, with both labels.

Defined cases: null urls and urls without ``://`` have an empty host and path and no
tokens; what no rule covers is allowed; equal urls get equal verdicts however often they
occur; without a labelled page nothing is mined; an empty table gives an empty result.
Extra columns pass through and may have any name.

Mining, looking up and joining back run over distinct urls, so a url on a third of
all pages is one row; the curated rules are a reviewed list and are matched row by row.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from fieldpulse.llm.common import broadcast_if_small, fresh_name
from fieldpulse.session import written

MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.9
LABELS = {"allow": "=allow", "block": "=block"}


@dataclass(frozen=True)
class Rule:
    """Fits urls of ``host`` and its subdomains whose path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @classmethod
    def parse(cls, verdict: str, text: str) -> Rule:
        host, slash, rest = text.partition("/")
        return cls(verdict, host, slash + rest)

    @property
    def text(self) -> str:
        return self.host + self.path


# --- Parts of a url -------------------------------------------------------------------


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def tokens_of(url: Column) -> Column:
    """Distinct tokens of a url; none without ``://``. Numbers count as one token."""
    text = F.coalesce(url, F.lit(""))
    labels = F.reverse(F.filter(F.split(host_of(url), r"\."), lambda x: x != ""))
    segments = F.filter(F.split(path_of(url), "/"), lambda x: x != "")
    words = F.filter(F.split(F.regexp_replace(path_of(url), r"[0-9]+", "0"), r"[/._-]+"), lambda x: x != "")
    query = F.split(F.regexp_extract(text, r"(?s)^[^#]*?\?([^#]*)", 1), "&")
    keys = F.filter(F.transform(query, lambda x: F.split(x, "=")[0]), lambda x: x != "")
    tokens = F.concat(
        F.array(F.concat(F.lit("scheme:"), F.lower(F.regexp_extract(text, r"(?s)^(.*?)://", 1)))),
        F.transform(labels, lambda x, i: F.concat(F.lit("host"), i.cast("string"), F.lit(":"), x)),
        F.transform(words, lambda x: F.concat(F.lit("path:"), F.lower(x))),
        F.array(F.concat(F.lit("depth:"), F.size(segments).cast("string"))),
        F.transform(keys, lambda x: F.concat(F.lit("key:"), x)),
        F.when(F.contains(text, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>")),
    )
    return F.when(F.contains(text, F.lit("://")), F.array_distinct(tokens)).otherwise(F.array().cast("array<string>"))


# --- Curated rules --------------------------------------------------------------------


def curated(url: Column, rules: list[Rule]) -> Column:
    """The longest fitting rule as a struct ``rule``, ``verdict``; null if none fits."""
    host, path = F.concat(F.lit("."), host_of(url)), path_of(url)
    ordered = sorted(rules, key=lambda r: (-len(r.text), r.text, r.verdict))
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in reversed(ordered):
        fits = F.endswith(host, F.lit("." + rule.host)) & F.startswith(path, F.lit(rule.path))
        found = F.when(fits, F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(found)
    return found


# --- Mined rules ----------------------------------------------------------------------


def merged_tokens(labelled: DataFrame, min_support: float = MIN_SUPPORT) -> DataFrame:
    """``token``, ``item`` of tokens that stand in exactly the same rows: one of them names all.

    Tokens below the support are left out; those that are left are few, as a row has few
    tokens and each needs its share of the rows.
    """
    rows = written(labelled.select(F.monotonically_increasing_id().alias("row"), "tokens"), "url-rows")
    stands = rows.select("row", F.explode("tokens").alias("token"))
    first, second = (F.xxhash64(F.lit(seed), "row") for seed in (1, 2))
    marks = stands.groupBy("token").agg(
        F.count("*").alias("n"), F.bit_xor(first).alias("first"), F.bit_xor(second).alias("second")
    ).where(F.col("n") >= F.lit(min_support) * rows.count())
    marks = written(marks, "url-token-marks")
    groups = marks.groupBy("n", "first", "second").agg(F.min("token").alias("item"), F.count("*").alias("size"))
    alike = marks.join(groups.where("size > 1"), ["n", "first", "second"]).select("token", "item", "size")
    alike = written(alike, "url-tokens-alike")
    # The marks are hashes: a group counts if every row with one of its tokens has all of them.
    held = stands.join(broadcast_if_small(alike, F.octet_length("token") + F.octet_length("item") + 32), "token")
    apart = held.groupBy("row", "item", "size").agg(F.count("*").alias("n")).where("n < size").select("item").distinct()
    return written(alike.join(apart, "item", "left_anti").select("token", "item"), "url-items")


def as_items(rows: DataFrame, items: DataFrame, key: str) -> DataFrame:
    """``rows`` with tokens replaced by their items; ``key`` names a column with a value of its own per row."""
    if items.isEmpty():
        return rows
    named = broadcast_if_small(items, F.octet_length("token") + F.octet_length("item") + 32)
    spread = rows.select(key, F.explode("tokens").alias("token")).join(named, "token", "left")
    found = spread.groupBy(key).agg(F.collect_set(F.coalesce("item", "token")).alias("items"))
    joined = rows.join(found, key, "left")
    return joined.withColumn("tokens", F.coalesce("items", "tokens")).drop("items")


def mine(labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE) -> DataFrame:
    """Rules ``tokens``, ``verdict``, ``confidence``, ``support`` from ``tokens``, ``verdict`` rows."""
    filled = written(labelled.where(F.size("tokens") > 0).select("tokens", "verdict"), "url-baskets")
    total = filled.count()
    counted = filled.select(F.explode("tokens").alias("token"), "verdict").groupBy("token").agg(
        F.count("*").alias("n"), *[F.count_if(F.col("verdict") == name).alias(name) for name in LABELS]
    )
    counted = written(counted, "url-token-counts")
    # What a larger rule with the token could not say more surely: the token is judged alone.
    alone = (F.col("n") == total) | (F.greatest(*LABELS) == F.col("n"))
    least = F.lit(min_support) * total
    single = counted.where(alone).select(
        F.array("token").alias("tokens"), F.explode(F.array(*[
            F.struct(F.lit(name).alias("verdict"), F.col(name).alias("together")) for name in LABELS
        ])).alias("of"), "n",
    ).where(F.col("of.together") >= least).select(
        "tokens", "of.verdict", (F.col("of.together") / F.col("n")).alias("confidence"),
        (F.col("of.together") / F.lit(max(total, 1))).alias("support"),
    ).where(F.col("confidence") >= min_confidence)
    combined = written(counted.where(~alone & (F.col("n") >= least)).select("token"), "url-tokens")
    several = _combinations(filled, combined, total, min_support, min_confidence)
    sure = written(single.unionByName(several) if several is not None else single, "url-rules")
    # A rule's next more general ones are its token sets with one token left out.
    parents = sure.where(F.size("tokens") > 1).select(
        "tokens", "verdict", "confidence",
        F.explode(F.transform("tokens", lambda t: F.array_remove("tokens", t))).alias("general"),
    )
    general = sure.select(F.col("tokens").alias("general"), "verdict", F.col("confidence").alias("of_general"))
    needless = parents.join(general, ["general", "verdict"]).where("of_general >= confidence")
    return written(sure.join(needless.select("tokens", "verdict").distinct(), ["tokens", "verdict"], "left_anti"), "url-rules")


def _combinations(
    filled: DataFrame, tokens: DataFrame, total: int, min_support: float, min_confidence: float
) -> DataFrame | None:
    """Rules among ``tokens`` by FP-growth, supports as shares of all rows."""
    numbered = filled.withColumn("row", F.monotonically_increasing_id())
    known = broadcast_if_small(tokens, F.octet_length("token") + 16)
    spread = numbered.select("row", "verdict", F.explode("tokens").alias("token")).join(known, "token")
    marks = F.create_map(*[F.lit(x) for pair in LABELS.items() for x in pair])
    baskets = written(
        spread.groupBy("row", "verdict").agg(F.collect_set("token").alias("held"))
        .select(F.array_append("held", marks[F.col("verdict")]).alias("items")),
        "url-baskets",
    )
    held = baskets.count()
    if not held:
        return None
    share = total / held
    model = FPGrowth(itemsCol="items", minSupport=min(1.0, min_support * share), minConfidence=min_confidence).fit(baskets)
    back = F.create_map(*[F.lit(x) for name, mark in LABELS.items() for x in (mark, name)])
    sure = model.associationRules.select(
        F.array_sort("antecedent").alias("tokens"), back[F.get("consequent", F.lit(0))].alias("verdict"),
        "confidence", (F.col("support") / share).alias("support"),
    ).where("verdict IS NOT NULL")
    return sure.where(~F.arrays_overlap("tokens", F.array(*map(F.lit, LABELS.values()))))


def _anchored(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """The inverted index: every rule under the ``token`` that the fewest urls have."""
    spread = F.explode("tokens").alias("token")
    common = urls.select(spread).groupBy("token").count()
    return (
        rules.select("*", spread).join(common, "token", "left")
        .groupBy(*rules.columns)
        .agg(F.min_by("token", F.struct(F.coalesce("count", F.lit(0)), "token")).alias("token"))
        .withColumnRenamed("tokens", "needed")
    )


def _fitting(urls: DataFrame, index: DataFrame) -> DataFrame:
    """Rows of ``urls`` with each rule of the index that fits them."""
    looked_up = urls.select("*", F.explode("tokens").alias("token")).join(
        broadcast_if_small(index, F.lit(400)), "token"
    )
    return looked_up.where(F.size(F.array_except("needed", "tokens")) == 0).drop("token")


def match(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url``, ``verdict``, ``mined_rule`` of the surest mined rule for the distinct ``url``, ``tokens`` rows it covers."""
    index = written(_anchored(rules, urls), "url-rule-index")
    fits = _fitting(urls.select("url", "tokens"), index)
    rank = F.struct("confidence", "support", -F.size("needed"), "verdict", F.array_join("needed", " "))
    return fits.groupBy("url").agg(
        F.max_by("verdict", rank).alias("verdict"), F.max_by(F.array_join("needed", " "), rank).alias("mined_rule")
    )


def _top(tokens: str) -> Column:
    """The token of a url's top host label; null if it has none."""
    return F.get(F.filter(tokens, lambda t: F.startswith(t, F.lit("host0:"))), F.lit(0))


def contrasted(rules: DataFrame, labelled: DataFrame) -> DataFrame:
    """``rules`` without the blocking ones that labelled urls give no evidence for.

    ``labelled`` has ``words``, the urls' own tokens, beside ``tokens``, their items.
    """
    placed = labelled.select("tokens", "verdict", _top("words").alias("top")).where("top IS NOT NULL")
    index = written(_anchored(rules.where("verdict = 'block'").select("tokens"), labelled), "url-block-index")
    fits = _fitting(placed, index).groupBy("needed", "top").agg(
        F.count_if(F.col("verdict") == "block").alias("blocked"), F.count_if(F.col("verdict") == "allow").alias("fitting")
    ).where("blocked > 0")
    allowed = placed.where("verdict = 'allow'").groupBy("top").agg(F.count("*").alias("allowed"))
    shown = fits.join(allowed, "top").where("allowed > fitting").select(F.col("needed").alias("tokens")).distinct()
    return rules.join(shown.withColumn("shown", F.lit(True)), "tokens", "left").where(
        "verdict = 'allow' OR shown"
    ).drop("shown")


# --- The filter -----------------------------------------------------------------------


def judge(
    pages: DataFrame, rules: list[Rule], labels: DataFrame | None = None, mined_rule: str | None = None
) -> DataFrame:
    """``pages`` plus ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    Rules are mined from the urls of ``pages`` that a curated rule judges, and from
    ``labels``, rows of ``url`` and ``verdict``, where they are given. ``mined_rule``
    names a column to add with the tokens of the mined rule that decided, null if none did.
    """
    found, mined, by = (fresh_name(pages, name) for name in ("curated_rule", "mined_verdict", "decided_by"))
    ruled = curated(F.col("url"), rules)
    urls = written(
        pages.select("url").where("url IS NOT NULL").distinct()
        .withColumns({"tokens": tokens_of(F.col("url")), "ruled": ruled}),
        "urls",
    )
    labelled = urls.where("ruled IS NOT NULL").select("tokens", F.col("ruled.verdict").alias("verdict"))
    if labels is not None:
        named = labels.where(F.col("verdict").isin(*LABELS)).select("url", "verdict")
        labelled = labelled.union(named.select(tokens_of(F.col("url")), "verdict"))
    labelled = written(
        labelled.where(F.size("tokens") > 0).select(
            F.monotonically_increasing_id().alias("row"), "tokens", F.col("tokens").alias("words"), "verdict"
        ),
        "labelled-urls",
    )
    items = merged_tokens(labelled)
    labelled = written(as_items(labelled, items, "row"), "labelled-items")
    learned = contrasted(mine(labelled), labelled)
    covered = match(as_items(urls.where("ruled IS NULL").select("url", "tokens"), items, "url"), learned)
    verdicts = covered.withColumnsRenamed({"verdict": mined, "mined_rule": by})
    new = ["host", "path", "rule", "verdict", *([mined_rule.lower()] if mined_rule else [])]
    kept = [c for c in pages.columns if c.lower() not in new]
    return pages.select(*kept).withColumn(found, ruled).join(verdicts, "url", "left").select(
        *kept,
        host_of(F.col("url")).alias("host"),
        path_of(F.col("url")).alias("path"),
        F.col(f"{found}.rule").alias("rule"),
        F.coalesce(F.col(f"{found}.verdict"), F.col(mined), F.lit("allow")).alias("verdict"),
        *([F.col(by).alias(mined_rule)] if mined_rule else []),
    )
