"""URL filters: stated rules first, association rules for the rest.

Pages that a stated rule covers are labelled by it.  FP-growth mines token
combinations of their URLs together with the label; rules that support and
confidence keep, and that beat every rule with one token less, judge the other
URLs.  A mined rule stands in the inverted index under its rarest token, so a
URL only meets rules whose rarest token it has, and then must hold the rest.
Tokens that stand in the same labelled URLs are one item, present when one of
them is: as rules with one more of them are never kept, this gives the rules
that mining the tokens would, without the combinations among them.
Everything is built-in column functions and Spark's own FP-growth.

Defined results: a null URL or one without ``://`` has empty host and path and
no tokens; such a URL, and one no mined rule fits, gets the commoner label (allow
on a tie or without labels); equal URLs are judged alike; columns other than
the id and the URL are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

#: The stated rules as (verdict, host and path).
RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.6
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: str) -> Column:
    found = F.coalesce(F.regexp_extract(url, r"://([^/?#]*)", 1), F.lit(""))
    return F.translate(found, _UPPER, _LOWER)


def path(url: str) -> Column:
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def stated(rules: Sequence[tuple[str, str]], host: str, path: str) -> Column:
    """(rule, verdict) of the longest stated rule that fits, else null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: len(r[1])):
        name, slash, rest = rule.partition("/")
        of_host = (F.col(host) == name) | F.col(host).endswith(f".{name}")
        fits = of_host & F.col(path).startswith(slash + rest)
        found = F.when(
            fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        ).otherwise(found)
    return found


def tokens(url: str, host: str, path: str) -> Column:
    """Distinct tokens of a URL: host names with their distance from the top,
    path parts with numbers made alike, names of query fields."""
    names = F.reverse(F.split(F.col(host), r"\."))
    of_host = F.transform(names, lambda x, i: F.concat(F.lit("h"), i, F.lit(":"), x))
    parts = F.filter(F.split(F.col(path), "/"), lambda x: x != "")
    of_path = F.transform(
        parts, lambda x: F.concat(F.lit("p:"), F.regexp_replace(x, "[0-9]+", "0"))
    )
    asked = F.coalesce(F.regexp_extract(url, r"\?([^#]*)", 1), F.lit(""))
    fields = F.filter(F.split(asked, "&"), lambda x: x != "")
    of_query = F.transform(
        fields, lambda x: F.concat(F.lit("q:"), F.substring_index(x, "=", 1))
    )
    found = F.array_distinct(F.concat(of_host, of_path, of_query))
    return F.when(F.col(host) == "", F.array().cast("array<string>")).otherwise(found)


def alike(labelled: DataFrame, min_support: float) -> DataFrame:
    """(token, item): frequent tokens that stand in exactly the same rows (tokens,
    label) as a smaller token, with that token.

    Rows are compared by two xors of their hashes over the different rows, and
    tokens below the support are left out, so no more than the tokens of a row
    over the support remain.
    """
    rows = labelled.groupBy(F.array_sort("tokens").alias("tokens"), "label").agg(
        F.count(F.lit(1)).alias("n")
    )
    total = F.lit(min_support) * labelled.agg(F.count(F.lit(1))).scalar()
    column = rows.select(
        F.explode("tokens").alias("token"),
        "n",
        F.xxhash64("tokens", "label").alias("a"),
        F.xxhash64(F.lit(1), "label", "tokens").alias("b"),
    ).groupBy("token").agg(
        F.bit_xor("a").alias("a"), F.bit_xor("b").alias("b"),
        F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"),
    ).where(F.col("n") >= total)
    same = column.groupBy("a", "b", "rows").agg(
        F.min("token").alias("item"), F.collect_set("token").alias("tokens")
    )
    return same.select(F.explode("tokens").alias("token"), "item").where("token <> item")


def as_items(tokens: str, same: DataFrame) -> Column:
    """The tokens with one item for each set of tokens that are alike; their
    table, whose size ``alike`` bounds, becomes part of the expression."""
    pairs = sorted(same.collect())
    if not pairs:
        return F.col(tokens)
    known = F.map_from_arrays(F.lit([t for t, _ in pairs]), F.lit([i for _, i in pairs]))
    return F.array_distinct(
        F.transform(tokens, lambda x: F.coalesce(F.try_element_at(known, x), x))
    )


def mine(labelled: DataFrame, min_support: float, min_confidence: float) -> DataFrame:
    """Rules (antecedent, label, confidence, support, rarest) from rows
    (tokens, label)."""
    width = labelled.sparkSession.conf.get("spark.sql.shuffle.partitions")
    growth = FPGrowth(
        itemsCol="items",
        minSupport=min_support,
        minConfidence=min_confidence,
        numPartitions=int(width),
    )
    marked = F.concat(F.lit("="), F.col("label"))
    model = growth.fit(
        labelled.select(F.concat("tokens", F.array(marked)).alias("items"))
    )
    rules = (
        model.associationRules.where(
            F.col("consequent")[0].startswith("=")
            & ~F.exists("antecedent", lambda x: x.startswith("="))
            & (F.col("lift") > 1)
        )
        .select(
            F.array_sort("antecedent").alias("antecedent"),
            F.substring(F.col("consequent")[0], 2, 100).alias("label"),
            "confidence",
            "support",
        )
    )
    shorter = rules.select(
        F.col("antecedent").alias("part"), "label", F.col("confidence").alias("part_confidence")
    )
    parts = F.transform(
        F.col("antecedent"), lambda x: F.array_except("antecedent", F.array(x))
    )
    beaten = (
        rules.where(F.size("antecedent") > 1)
        .select("antecedent", "label", "confidence", F.explode(parts).alias("part"))
        .join(shorter, ["part", "label"])
        .where("part_confidence >= confidence")
        .select("antecedent", "label")
        .distinct()
    )
    kept = rules.join(beaten, ["antecedent", "label"], "left_anti")
    seen = model.freqItemsets.where(F.size("items") == 1).select(
        F.col("items")[0].alias("token"), "freq"
    )
    return (
        kept.withColumn("token", F.explode("antecedent"))
        .join(seen, "token")
        .groupBy("antecedent", "label", "confidence", "support")
        .agg(F.min_by("token", F.struct("freq", "token")).alias("rarest"))
    )


def judge(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(url, label) for URLs (url, tokens) that at least one mined rule fits:
    the most confident rule, then the best supported, then by its tokens."""
    index = rules.withColumnRenamed("rarest", "token")
    met = urls.select("url", "tokens", F.explode("tokens").alias("token")).join(index, "token")
    fits = F.size(F.array_except("antecedent", "tokens")) == 0
    return met.where(fits).groupBy("url").agg(
        F.max_by(
            "label",
            F.struct(
                "confidence", "support", (-F.size("antecedent")).alias("n"), "antecedent", "label"
            ),
        ).alias("label")
    )


def filter_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    min_support: float = MIN_SUPPORT,
    min_confidence: float = MIN_CONFIDENCE,
    *,
    id_column: str = "page_id",
    url_column: str = "url",
) -> DataFrame:
    """page_id, host, path, rule and verdict of every page.  ``rules`` is a
    list in the job's configuration; it becomes part of the expression."""
    rows = (
        pages.select(
            pages[id_column].alias("page_id"), pages[url_column].cast("string").alias("url")
        )
        .withColumns({"host": host("url"), "path": path("url")})
        .withColumn("stated", stated(rules, "host", "path"))
    )
    of_urls = rows.withColumn("tokens", tokens("url", "host", "path"))
    labelled = of_urls.where("stated IS NOT NULL").select(
        "tokens", F.col("stated.verdict").alias("label")
    )
    counts = labelled.agg(
        F.count(F.when(F.col("label") == "block", 1)).alias("block"),
        F.count(F.when(F.col("label") == "allow", 1)).alias("allow"),
    ).first()
    usual = "block" if counts["block"] > counts["allow"] else "allow"
    if counts["block"] + counts["allow"]:
        asked = (
            of_urls.where("stated IS NULL AND url IS NOT NULL").groupBy("url")
            .agg(F.first("tokens").alias("tokens"))
        )
        items = as_items("tokens", alike(labelled, min_support))
        judged = judge(
            asked.withColumn("tokens", items),
            mine(labelled.withColumn("tokens", items), min_support, min_confidence),
        )
    else:
        judged = rows.select("url", F.lit(usual).alias("label")).where("false")
    return rows.join(judged, "url", "left").select(
        "page_id",
        "host",
        "path",
        F.col("stated.rule").alias("rule"),
        F.coalesce("stated.verdict", "label", F.lit(usual)).alias("verdict"),
    )
