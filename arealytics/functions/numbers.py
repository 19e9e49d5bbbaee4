"""Text to number, fills, and shares with half-even rounding."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _blanked(name: str, blanks: Sequence[str]) -> Column:
    column = F.col(name).cast("string")
    return F.when(~column.isin(["", *blanks]), column)


def _number(column: Column) -> Column:
    """NaN never enters the engine; it is the null of text tables.  ``nanvl``
    evaluates its argument once, which keeps the generated code small."""
    return F.nanvl(column, F.lit(None).cast("double"))


def clean_numeric(
    df: DataFrame, columns: Sequence[str], blanks: Sequence[str], mode: str = "strict"
) -> DataFrame:
    """Blank texts and nulls become 0.  Other text fails the job in ``strict``
    mode and becomes 0 in ``permissive`` mode."""
    if mode not in ("strict", "permissive"):
        raise ValueError(f"unknown mode {mode!r}")

    def cast(column: Column) -> Column:
        return (
            column.cast("double") if mode == "strict" else column.try_cast("double")
        )

    return df.withColumns(
        {
            c: F.coalesce(_number(cast(_blanked(c, blanks))), F.lit(0.0))
            for c in columns
        }
    )


def clean_code(
    df: DataFrame, columns: Sequence[str], blanks: Sequence[str]
) -> DataFrame:
    """Integer codes kept as text: '12.7' gives '12', anything unreadable '0'."""
    return df.withColumns(
        {
            c: F.coalesce(
                _number(_blanked(c, blanks).try_cast("double")), F.lit(0.0)
            )
            .cast("long")
            .cast("string")
            for c in columns
        }
    )


def coerce_numeric(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Numbers where they can be read, null elsewhere."""
    return df.withColumns(
        {c: _number(F.col(c).try_cast("double")) for c in columns}
    )


def numeric_if_all(df: DataFrame, keep: Sequence[str]) -> DataFrame:
    """Turn each text column outside ``keep`` into numbers when all of its
    values can be read.  One aggregate decides for all columns."""
    texts = [
        f.name
        for f in df.schema.fields
        if f.name not in keep and f.dataType.simpleString() == "string"
    ]
    if not texts:
        return df
    unreadable = df.agg(
        *[
            F.count_if(
                F.col(f"`{c}`").isNotNull()
                & F.col(f"`{c}`").try_cast("double").isNull()
            ).alias(c)
            for c in texts
        ]
    ).first()
    return df.withColumns(
        {
            c: _number(F.col(f"`{c}`").cast("double"))
            for c in texts
            if unreadable[c] == 0
        }
    )


def fill_defaults(df: DataFrame, numeric: Sequence[str] = ()) -> DataFrame:
    """Null text becomes '', null in the named number columns becomes 0."""
    filled = df.fillna("")
    return filled.fillna(0, list(numeric)) if numeric else filled


def share(part: Column, whole: Column, digits: int) -> Column:
    """``part / whole`` in percent, rounded half to even; null when undefined."""
    return F.bround(F.try_divide(part, whole) * F.lit(100.0), digits)


def guarded_share(part: Column, whole: Column) -> Column:
    """Older share: 0 for an empty whole, four digits, then whole percents."""
    ratio = F.when(whole == 0, F.lit(0.0)).otherwise(
        F.bround(F.try_divide(part, whole), 4)
    )
    return F.bround(ratio * F.lit(100.0), 0).cast("long")


def percent_difference(base: Column, other: Column) -> Column:
    return F.bround(F.try_divide(base - other, base), 4) * F.lit(100.0)
