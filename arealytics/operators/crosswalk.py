"""Area-ratio crosswalks and what is shared out by them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from arealytics.operators.geometry import Layer, overlay_ratios
from arealytics.operators.joins import fits_broadcast, fits_stored, lookup_join
from arealytics.operators.keys import dense_index
from arealytics.session import give_back, pin
from arealytics.specs import APPORTIONED, DOMINANT_SHARE, UnitSpec


def normalize_ratios(
    ratios: DataFrame,
    source_id: str,
    ratio: str = "AREA_RATIO",
    small: bool | None = None,
) -> DataFrame:
    """Keep a source's dominant targets only, if it has any, and rescale what is
    left so that each source sums to 1 (null where the sum is 0).

    The group figures come from one partial aggregate that is joined back, so a
    source with very many targets never sits in one task.  ``small`` says whether
    the groups may be broadcast, where the caller knows.
    """
    if small is None:
        small = fits_broadcast(ratios)
    dominant = F.col(ratio) > DOMINANT_SHARE
    groups = ratios.groupBy(source_id).agg(
        F.max(dominant).alias("_has_dominant"),
        F.sum(ratio).alias("_all"),
        F.sum(F.when(dominant, F.col(ratio))).alias("_dominant"),
    )
    kept = F.when(F.col("_has_dominant"), F.col("_dominant")).otherwise(F.col("_all"))
    return (
        lookup_join(ratios, groups, [source_id], "inner", small)
        .where(dominant | ~F.col("_has_dominant"))
        .withColumn(ratio, F.col(ratio) * F.try_divide(F.lit(1.0), kept))
        .drop("_has_dominant", "_all", "_dominant")
    )


def build_crosswalk(
    source: DataFrame | Layer, target: DataFrame | Layer, source_id: str, target_id: str
) -> DataFrame:
    """Crosswalk ``(source_id, target_id, AREA_RATIO)`` between two layers.  The
    ratios are stored: their groups' figures are joined back to them."""
    ratios = pin(overlay_ratios(source, target, source_id, target_id))
    return normalize_ratios(ratios, source_id, small=fits_stored(ratios))


def weight(
    fact: DataFrame,
    crosswalk: DataFrame,
    spec: UnitSpec,
    section: str = "comtrs",
    crosswalk_section: str = "CO_MTRS",
    measures: Sequence[str] = APPORTIONED,
) -> DataFrame:
    """Fact rows split over the areas of their section, pounds by area share.

    A row without an area stays, with null area and null pounds.  The null
    section, shared by all non-farm rows of a full fact, is one of the keys
    ``lookup_join`` spreads.
    """
    if spec.usetypes is not None:
        fact = fact.where(F.col("usetype").isin(list(spec.usetypes)))
    shares = crosswalk.select(
        F.col(crosswalk_section).alias(section), spec.area_id, spec.ratio
    )
    return lookup_join(fact, shares, [section], "left").withColumns(
        {m: F.col(m) * F.col(spec.ratio) for m in measures}
    )


def apportion(fact: DataFrame, crosswalk: DataFrame, spec: UnitSpec) -> DataFrame:
    """Unit fact table: weighted pounds, helper columns dropped, and one dense
    integer per (application, area) instead of the long key.  The weighted rows are
    stored, as they are read twice, until they are numbered."""
    weighted = pin(weight(fact, crosswalk, spec).drop(spec.ratio, *spec.drop))
    numbered = dense_index(
        weighted.withColumn("_area", F.col(spec.area_id)), ["use_id", "_area"]
    )
    give_back(weighted)
    return numbered
