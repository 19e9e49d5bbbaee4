"""Month and year expressions."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, functions as F

from arealytics.specs import MONTHS


def month_year(date: Column) -> Column:
    """'2021-03' from '05-MAR-21': strict upper-case months, century 20.

    A month outside the table gives null.
    """
    months = F.create_map(*[F.lit(x) for x in chain.from_iterable(MONTHS.items())])
    month = F.try_element_at(months, F.substring(date, 4, 3))
    return F.concat(F.lit("20"), F.right(date, F.lit(2)), F.lit("-"), month)


def parsed_month(date: Column) -> Column:
    """'2021-03' by calendar parsing: ignores case, null for impossible days."""
    return F.date_format(F.try_to_timestamp(date, F.lit("dd-MMM-yy")), "yyyy-MM")


def year_of(monthyear: Column) -> Column:
    return F.substring(monthyear, 1, 4)


def month_of(monthyear: Column) -> Column:
    return F.substring(monthyear, 6, 2)


def slash_date(text: Column) -> Column:
    """Date from 'MM/dd/yyyy'; the text 'nan' and unreadable text give null."""
    return F.try_to_timestamp(
        F.nullif(text, F.lit("nan")), F.lit("M/d/yyyy")
    ).cast("date")
