"""Text expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

from arealytics.specs import Label


def township_range(section: Column) -> Column:
    """'T10N R02E' from characters 4-9 of a section code; null when shorter."""
    return F.when(
        F.length(section) >= 9,
        F.concat(
            F.lit("T"),
            F.substring(section, 4, 3),
            F.lit(" R"),
            F.substring(section, 7, 3),
        ),
    )


def label_string(labels: Sequence[Label], flagged: str = "Y") -> Column:
    """Ids of the labels a row carries, in table order, joined by a pipe."""

    def carries(label: Label) -> Column:
        return F.array_contains(
            F.array(*[F.coalesce(F.col(f"`{c}`"), F.lit("")) for c in label.flags]),
            flagged,
        )

    return F.concat_ws("|", *[F.when(carries(x), F.lit(x.id)) for x in labels])


def label_count(labels: Column) -> Column:
    """Parts of a label string.  An empty string counts as one part."""
    return F.coalesce(F.size(F.split(labels, "[|]")), F.lit(0))


def title_case(text: Column) -> Column:
    """Upper case after every non-letter, lower case after a letter."""
    letter = F.split(text, "")

    def fix(char: Column, at: Column) -> Column:
        before = F.substring(text, at, F.lit(1))
        inner = (at > 0) & before.rlike(r"\p{L}")
        return F.when(inner, F.lower(char)).otherwise(F.upper(char))

    return F.when(text.isNotNull(), F.array_join(F.transform(letter, fix), ""))


def zero_pad(text: Column, width: int) -> Column:
    """Zeros to the left up to ``width``; longer text stays whole."""
    text = text.cast("string")
    return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))


def nth_word(text: Column, n: int) -> Column:
    return F.try_element_at(F.split(text, " "), F.lit(n))


def display_name(first: Column, second: Column) -> Column:
    return F.concat(first, F.lit(" "), second)


def district_id(first_choice: Column, second_choice: Column) -> Column:
    """First known district id without its two-character state prefix."""
    chosen = F.coalesce(first_choice, second_choice)
    return F.substring(chosen, F.lit(3), F.length(chosen))


def link_targets(html: Column) -> Column:
    """All href values of anchor elements, in page order."""
    return F.regexp_extract_all(
        html,
        F.lit(r"(?is)<a\s(?:[^>]*?\s)?href\s*=\s*[\"']([^\"'>]*)[\"']"),
        F.lit(1),
    )
