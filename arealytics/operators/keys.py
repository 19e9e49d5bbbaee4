"""Row keys: composite ids, dense numbers, first positions."""

from __future__ import annotations

from collections import Counter
from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from arealytics.operators.joins import hashable, shuffle_width
from arealytics.session import pin

_POSITION_BITS = 33  # monotonically_increasing_id: partition above, row below
_DRAWN = 60  # sampled rows for each range of dense_index


def use_id() -> Column:
    """Key of one application; null when the month or the pounds are missing.

    Pounds enter with fifteen digits and, where these name another double, with
    what is left, so that all doubles are told apart in a form that does not
    depend on how an engine prints them; a missing number or section enters as
    'nan'.
    """
    pounds = F.col("lbs_prd_used").cast("double")
    text = F.format_string("%.14e", pounds)
    left = pounds - text.cast("double")
    # from 1 to below 10,000,000 a double prints plainly; when its digits are
    # fifteen at most they are those of the long form, and nothing is left
    plain = pounds.cast("string")
    short = (pounds >= 1) & (pounds < 1e7) & (F.length(plain) <= 16)
    fraction = F.rpad(F.translate(F.substr(plain, F.lit(2)), ".", ""), 14, "0")
    power = (F.instr(plain, ".") - 2).cast("string")
    digits = F.when(
        short, F.concat(F.left(plain, F.lit(1)), F.lit("."), fraction, F.lit("e+0"), power)
    ).otherwise(
        F.concat(text, F.when(left != 0, F.format_string("%+.14e", left)).otherwise(""))
    )
    return F.concat(
        F.col("monthyear"),
        F.coalesce(F.col("use_number"), F.lit("nan")),
        F.when(pounds.isNotNull(), digits),
        F.coalesce(F.col("comtrs"), F.lit("nan")),
    )


def in_ranges(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """Rows sorted into range partitions, with ``_part`` and the 0-based place
    ``_place`` inside it.

    Rows must differ in ``order``, so that no value can fill a range alone.
    Pinned: range bounds come from a sample and must not be drawn twice.
    """
    ranged = pin(
        df.repartitionByRange(shuffle_width(df), *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
    )
    mask = (1 << _POSITION_BITS) - 1
    return ranged.select(
        *df.columns,
        F.shiftright("_at", _POSITION_BITS).alias("_part"),
        F.col("_at").bitwiseAND(F.lit(mask)).alias("_place"),
    )


def with_offset(ranged: DataFrame, size: Column) -> DataFrame:
    """Add ``_offset``, the total ``size`` of all ranges before the row's own.
    The running sum sees one row per range partition, never the data."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        ranged.groupBy("_part")
        .agg(size.alias("_size"))
        .select(
            "_part",
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"),
        )
    )
    # bounded by the shuffle width
    return ranged.join(F.broadcast(offsets), "_part")


Bound = tuple[tuple, int | None]


def _range_bounds(df: DataFrame, keys: Sequence[str], ranges: int) -> list[Bound]:
    """At most ``ranges - 1`` ascending bounds that cut ``df`` into ranges of like
    size, from a random sample of the keys.  They decide only how the rows are
    dealt; every row is dealt.

    A bound is a key, and for a key that fills several ranges a place among the
    content hashes too, which are even over all whole numbers.
    """
    drawn = df.select(*keys).orderBy(F.rand(0)).limit(_DRAWN * ranges)
    drawn = drawn.orderBy(*keys).collect()  # bounded by the number of ranges
    cuts = Counter(tuple(drawn[len(drawn) * i // ranges]) for i in range(1, ranges) if drawn)
    return [
        (key, None if n == 1 else -(1 << 63) + (i << 64) // (n + 1))
        for key, n in cuts.items()  # in ascending order, as counted
        for i in range(1, n + 1)
    ]


def _range_of(df: DataFrame, keys: Sequence[str], bounds: Sequence[Bound]) -> Column:
    """Number of ``bounds`` at or before a row, nulls first: nested conditions as
    deep as the logarithm of their number."""
    content = F.xxhash64(*[F.col(f"`{f.name}`") for f in df.schema.fields if hashable(f)])

    def before(columns: list[Column], values: list) -> Column:
        column, value = columns[0], values[0]
        rest = before(columns[1:], values[1:]) if len(values) > 1 else None
        if value is None:
            return F.lit(False) if rest is None else column.isNull() & rest
        lower = column.isNull() | (column < F.lit(value))
        return lower if rest is None else lower | ((column == F.lit(value)) & rest)

    def place(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        key, cut = bounds[middle]
        columns, values = [F.col(f"`{k}`") for k in keys], list(key)
        if cut is not None:
            columns, values = [*columns, content], [*values, cut]
        return F.when(before(columns, values), place(low, middle)).otherwise(
            place(middle + 1, high)
        )

    return place(0, len(bounds))


def _counted(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows in ranges ``_part`` of the key, with ``_rank``, the 0-based number of
    the row's key among the range's keys (null for a null key), and ``_end``, the key
    itself on rows of the range's first key and on the last row only.

    The bounds are drawn from the keys alone, before the rows move, and each
    window sees one range.  A frequent key, the null key included, may fill
    several ranges.
    """
    width = shuffle_width(df)
    ranges = 2 * width  # several to a task, which evens out its rows
    part = _range_of(df, keys, _range_bounds(df, keys, ranges))
    present = reduce(and_, [F.col(f"`{k}`").isNotNull() for k in keys])
    dealt = df.select(*df.columns, part.alias("_part"), present.alias("_present"))
    in_part = Window.partitionBy("_part", "_present").orderBy(*keys)
    number = F.dense_rank().over(in_part).cast("long") - 1
    last = F.lead(F.lit(1)).over(in_part).isNull()
    return (
        dealt.repartition(width, "_part")
        .withColumns({"_rank": F.when(F.col("_present"), number), "_last": last})
        .withColumn("_end", F.when((F.col("_rank") == 0) | (F.col("_present") & F.col("_last")), F.struct(*keys)))
        .drop("_present", "_last")
    )


def dense_index(
    df: DataFrame, keys: Sequence[str], name: str = "use_index"
) -> DataFrame:
    """Replace ``keys`` by one 0-based integer, dense over their distinct values.

    Numbers follow the order of the keys.  Rows with any null key share the one
    number after the last.  The rows move once: they are dealt to ranges of the
    key, numbered within their range and stored; one row per range then tells how
    many keys lie before it, a key on the border of two ranges counted once.
    """
    keys = list(keys)
    counted = pin(_counted(df, keys).drop(*keys))
    borders = counted.where(F.col("_end").isNotNull()).groupBy("_part").agg(
        (F.max("_rank") + 1).alias("_keys"),
        F.min_by("_end", "_rank").alias("_first"),
        F.max_by("_end", "_rank").alias("_last"),
    )
    # these windows see one row per range
    order = Window.orderBy("_part")
    shared = F.col("_first").eqNullSafe(F.lag("_last").over(order)).cast("long")
    upto = F.sum(F.col("_keys") - F.col("_shared")).over(
        order.rowsBetween(Window.unboundedPreceding, 0)
    )
    offsets = pin(
        borders.withColumn("_shared", shared).withColumn("_upto", upto)
        .select("_part", "_upto", (F.col("_upto") - F.col("_keys")).alias("_offset"))
    )
    after_last = offsets.agg(F.coalesce(F.max("_upto"), F.lit(0))).scalar()
    # bounded by the shuffle width
    return (
        counted.join(F.broadcast(offsets.drop("_upto")), "_part", "left")
        .withColumn(name, F.coalesce(F.col("_offset") + F.col("_rank"), after_last))
        .drop("_part", "_rank", "_offset", "_end")
    )


def first_row_id(
    df: DataFrame, column: str, ordinal: str, name: str | None = None
) -> DataFrame:
    """Distinct values with the smallest source position (null is a value)."""
    return df.groupBy(column).agg(F.min(ordinal).alias(name or f"{column}_ID"))


def first_per_key(
    df: DataFrame, keys: Sequence[str], ordinal: str
) -> DataFrame:
    """The first row of each key by source position, as a plain aggregate."""
    rest = [c for c in df.columns if c not in keys]
    packed = F.min_by(F.struct(*rest), F.col(ordinal))
    return df.groupBy(*keys).agg(packed.alias("_first")).select(
        *keys, *[F.col("_first")[c].alias(c) for c in rest]
    )
