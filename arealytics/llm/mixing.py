"""Mixing sources to target weights.

Sources take weights in code-point order (a null source last), share a budget
of words by weight, and stop at a multiple of their own size; what a stopped
source leaves is shared again.  A document is taken floor(rate) times and once
more with the rate's fraction as probability, drawn from a hash of its id, so
that reruns agree.  Only built-in column functions are used.

Defined results: a null text has size 0; a null id is drawn as the empty text;
a source without words has target 0; repeated rows are taken alike; an empty
table gives an empty mix; other columns are ignored by ``mix`` and kept by
``emit``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from arealytics.llm.common import WORD
from arealytics.operators.joins import lookup_join
from arealytics.operators.keys import in_ranges, with_offset
from arealytics.session import pin

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
CAP = 2.0
SEED = "mix"


def words(text: str) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def _key(source: str) -> Column:
    """One key per source, null included."""
    return F.coalesce(F.concat(F.lit("="), F.col(source).cast("string")), F.lit("-"))


def source_targets(
    sized: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
) -> DataFrame:
    """(_key, source_size, target) per source of rows (_source, size)."""
    sizes = pin(
        sized.groupBy("_source").agg(F.sum("size").alias("source_size"))
    )
    named = sizes.select("_source").where(F.col("_source").isNotNull())
    ordered = with_offset(in_ranges(named, ["_source"]), F.count(F.lit(1))).select(
        _key("_source").alias("_key"), (F.col("_offset") + F.col("_place")).alias("_rank")
    )
    known = named.count()
    ranked = (
        sizes.withColumn("_key", _key("_source"))
        .join(ordered, "_key", "left")
        .withColumn("_turn", F.pmod(F.coalesce("_rank", F.lit(known)), F.lit(len(weights))))
    )
    weight = F.element_at(F.array(*map(F.lit, weights)), F.col("_turn").cast("int") + 1)
    ranked = pin(
        ranked.select(
            "_key",
            "source_size",
            weight.alias("_weight"),
            (F.lit(cap) * F.col("source_size")).alias("_cap"),
        )
    )
    level = _level(ranked, share)
    return ranked.select(
        "_key",
        "source_size",
        F.least(F.col("_cap"), F.col("_weight") * F.lit(level)).alias("target"),
    )


def _level(ranked: DataFrame, share: float) -> float:
    """Words per unit of weight such that capped targets add up to the budget.
    Each round reads one row of sums; the capped set only grows."""
    level, before = 0.0, -1
    while True:
        above = F.col("_weight") * F.lit(level) > F.col("_cap")
        row = ranked.agg(
            F.sum("source_size").alias("words"),
            F.sum(F.when(above, F.col("_cap"))).alias("capped"),
            F.sum(F.when(~above, F.col("_weight"))).alias("open"),
            F.count(F.when(above, 1)).alias("stopped"),
        ).first()
        if not row["open"] or row["stopped"] == before:
            return level
        before = row["stopped"]
        level = (share * row["words"] - (row["capped"] or 0.0)) / row["open"]


def copies(identity: Column, target: Column, source_size: Column, seed: str = SEED) -> Column:
    """floor(rate) plus the hash-seeded copy."""
    rate = F.coalesce(F.try_divide(target, source_size), F.lit(0.0))
    named = F.coalesce(identity.cast("string"), F.lit(""))
    digest = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), named)), 1, 8)
    draw = F.conv(digest, 16, 10).cast("double") / F.lit(float(1 << 32))
    extra = F.when(draw < rate - F.floor(rate), 1).otherwise(0)
    return (F.floor(rate) + extra).cast("int")


def _sized(documents: DataFrame, id_column: str, text_column: str, source_column: str):
    return documents.select(
        documents[id_column].cast("long").alias("doc_id"),
        documents[source_column].cast("string").alias("_source"),
        words(text_column).alias("size"),
    )


def mix(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = SEED,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target
    (its source's) and taken, the words it gives with repeats."""
    sized = pin(_sized(documents, id_column, text_column, source_column))
    targets = pin(source_targets(sized, weights, share, cap))
    return lookup_join(sized.withColumn("_key", _key("_source")), targets, ["_key"]).select(
        "doc_id",
        "size",
        "source_size",
        "target",
        (
            F.col("size")
            * copies(F.col("doc_id"), F.col("target"), F.col("source_size"), seed)
        ).cast("long").alias("taken"),
    )


def emit(
    documents: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    share: float = SHARE,
    cap: float = CAP,
    seed: str = SEED,
    *,
    id_column: str = "doc_id",
    text_column: str = "text",
    source_column: str = "source",
) -> DataFrame:
    """The mixed corpus itself: every row as often as the mix takes it."""
    sizes = _sized(documents, id_column, text_column, source_column).groupBy("_source").agg(
        F.sum("size").alias("size")
    )
    targets = pin(source_targets(sizes, weights, share, cap).select(
        F.col("_key").alias("_mix_key"),
        F.struct("source_size", "target").alias("_mix"),
    ))
    # columns of the documents may have any name
    rows = documents.select(
        F.struct(*[documents[f.name] for f in documents.schema.fields]).alias("row"),
        documents[id_column].alias("id"),
        _key(source_column).alias("_mix_key"),
    )
    joined = lookup_join(rows, targets, ["_mix_key"])
    times = copies(
        F.col("id"), F.col("_mix.target"), F.col("_mix.source_size"), seed
    )
    # one array element per copy; a document taken zero times leaves no row
    return joined.select("row", F.explode(F.array_repeat(F.lit(True), times))).select("row.*")


MIX_SQL = """
WITH sized AS (
  SELECT doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source
), weighed AS (
  SELECT source, source_size, 2.0::DOUBLE * source_size AS cap,
    [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS w
  FROM sources
), filled AS (
  SELECT *, coalesce(sum(cap) OVER stopped, 0) AS capped,
    sum(w) OVER () - coalesce(sum(w) OVER stopped, 0) AS open_weight,
    1.5::DOUBLE * sum(source_size) OVER () AS budget,
    cap / w AS stop,
    row_number() OVER (ORDER BY cap / w, source NULLS LAST) AS place
  FROM weighed
  WINDOW stopped AS (ORDER BY cap / w, source NULLS LAST
                     ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT coalesce(arg_min((budget - capped) / open_weight, place), 0) AS per_weight FROM filled
  WHERE (budget - capped) / open_weight <= stop
), targets AS (
  SELECT source, source_size, least(cap, w * per_weight) AS target FROM weighed, level
), rated AS (
  SELECT doc_id, size, source_size, target,
    CASE WHEN source_size = 0 THEN 0 ELSE target / source_size END AS rate,
    ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::UBIGINT
      / 4294967296.0::DOUBLE AS draw
  FROM sized JOIN targets ON sized.source IS NOT DISTINCT FROM targets.source
)
SELECT doc_id, size, source_size, target,
  (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT
    AS taken
FROM rated
"""
