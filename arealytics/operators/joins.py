"""Lookup joins that hold when one key owns a large part of the rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

_SUFFIXES = {"k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def _bytes(setting: str) -> int:
    text = setting.strip().lower().removesuffix("b")
    if text and text[-1] in _SUFFIXES:
        return int(text[:-1]) * _SUFFIXES[text[-1]]
    return int(text)


def broadcast_limit(df: DataFrame) -> int:
    return _bytes(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold"))


def estimated_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate; an unfiltered, unreduced upper guess for
    filters and aggregates, file size for scans."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def fits_broadcast(df: DataFrame) -> bool:
    return estimated_bytes(df) <= broadcast_limit(df)


def fits_stored(df: DataFrame, times: int = 1) -> bool:
    """Whether ``times`` the rows of a stored table may be broadcast.  Counted
    from the files' footers: equal values compress to nearly nothing, so the
    size of the files says little about the rows in memory."""
    row = 8 + df._jdf.schema().defaultSize()
    return df.count() * row * times <= broadcast_limit(df)


def shuffle_width(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def null_safe(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> Column:
    return reduce(
        lambda a, b: a & b, [left[k].eqNullSafe(right[k]) for k in keys]
    )


def hot_keys(df: DataFrame, keys: Sequence[str], width: int) -> DataFrame:
    """Keys holding more than one ``width``-th of the rows, with ``_spread``,
    the number of average partitions such a key fills.

    At most ``width`` keys can be hot, and their spreads add up to at most
    twice ``width``: both are bounded whatever the data holds.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"))
    per_task = counts.agg((F.sum("_rows") / F.lit(width)).alias("_per_task")).scalar()
    return counts.where(F.col("_rows") > per_task).select(
        *keys, F.ceil(F.col("_rows") / per_task).cast("int").alias("_spread")
    )


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """Join ``left`` rows to ``right`` on equally named ``keys``.

    A right side below the session's broadcast threshold is broadcast and
    ``left`` does not move.  Above it both sides are shuffled; hot keys of
    ``left`` (the null key included) are spread over several tasks by a salt
    taken from the row's own content, and the few right rows of those keys are
    repeated once per salt.  ``small`` states the outcome of a size check the
    caller has already made; one that found a side too large also keeps the
    planner from broadcasting it by the size of its files.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"lookup_join does not do {how!r}")
    keys = list(keys)
    checked = small is not None
    if not checked:
        small = fits_broadcast(right)
    if small:
        return left.join(F.broadcast(right), keys, how)

    width = shuffle_width(left)
    hot = hot_keys(left, keys, width)
    content = [F.col(f"`{f.name}`") for f in left.schema.fields if hashable(f)]

    salted = F.pmod(F.xxhash64(*content), F.col("_spread")).cast("int")
    many = _with_spread(left, hot, keys).withColumn(
        "_salt", F.coalesce(salted, F.lit(0))
    )
    salts = F.sequence(F.lit(0), F.coalesce(F.col("_spread"), F.lit(1)) - 1)
    few = _with_spread(right, hot, keys).withColumn("_salt", F.explode(salts))
    few = few.drop("_spread")
    return many.drop("_spread").join(
        few.hint("merge") if checked else few, [*keys, "_salt"], how
    ).drop("_salt")


def hashable(field) -> bool:
    return "map<" not in field.dataType.simpleString()


def _with_spread(df: DataFrame, hot: DataFrame, keys: Sequence[str]) -> DataFrame:
    # bounded by hot_keys: never more than `width` rows
    hot = F.broadcast(hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys}))
    match = reduce(
        lambda a, b: a & b,
        [F.col(f"`{k}`").eqNullSafe(F.col(f"`_hot_{k}`")) for k in keys],
    )
    return df.join(hot, match, "left").drop(*[f"_hot_{k}" for k in keys])


def keep_known(df: DataFrame, column: str, known: DataFrame, known_column: str):
    """Rows whose ``column`` occurs in ``known_column`` of the other table."""
    ids = known.select(F.col(known_column).alias(column)).where(
        F.col(column).isNotNull()
    ).distinct()
    return df.join(ids, column, "left_semi")


def renamed_lookup(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    how: str = "left",
    small: bool | None = None,
) -> DataFrame:
    """``lookup_join`` for differently named keys; the right names vanish."""
    right = right.withColumnsRenamed({b: a for a, b in on.items()})
    return lookup_join(left, right, list(on), how, small)
