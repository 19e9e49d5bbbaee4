"""Earlier report layout: slash dates, section keys and county names."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from arealytics.functions.dates import slash_date
from arealytics.functions.projection import from_grid, project_grid, project_rings
from arealytics.functions.text import nth_word, zero_pad
from arealytics.operators.geometry import interior_point
from arealytics.operators.joins import renamed_lookup
from arealytics.specs import STATE_PREFIX


def section_points(sections: DataFrame, section: str = "CO_MTRS") -> DataFrame:
    """``(point, x, y)``: a point inside each section, found on the local grid
    and given in degrees.  Rows that repeat another whole row go."""
    inside = interior_point(project_rings(F.col("rings"), project_grid))
    points = sections.select(F.col(section).alias("point"), "rings").distinct().select(
        "point", inside.alias("_p")
    )
    at = from_grid(F.col("_p.x"), F.col("_p.y"))
    return points.select("point", at.alias("_at")).select(
        "point", F.col("_at.x").alias("x"), F.col("_at.y").alias("y")
    )


def with_section_keys(use: DataFrame, keys: DataFrame) -> DataFrame:
    """Use rows with the area ids of their section (``CO_MTRS`` and one column
    per kind of area); a row without a known section keeps nulls."""
    named = keys.withColumnRenamed("county_id", "COUNTY").distinct()
    return renamed_lookup(use, named, {"comtrs": "CO_MTRS"})


def older_use(
    use: DataFrame,
    counties: DataFrame,
    since: str = "2017-01-01",
    keys: DataFrame | None = None,
) -> DataFrame:
    """Dated use from ``since`` on, farm use told by the presence of a section,
    with five-digit county codes and county names, and with the area ids of the
    section where ``keys`` are given."""
    dated = (
        use.withColumn("date", slash_date(F.col("applic_dt")))
        .where(F.col("date") >= F.lit(since).cast("date"))
        .withColumn("year", F.year("date"))
        .withColumn(
            "usetype",
            F.when(F.col("comtrs").isNotNull(), "ag").otherwise("nonag"),
        )
        .withColumn(
            "county_cd",
            F.concat(F.lit(STATE_PREFIX), zero_pad(F.col("county_cd"), 3)),
        )
        .drop("applic_dt")
    )
    names = counties.select(
        zero_pad(F.col("CountyCode"), 5).alias("CountyCode"),
        zero_pad(F.col("FIPS"), 5).alias("FIPS"),
        "Name",
    )
    if keys is not None:
        dated = with_section_keys(dated, keys)
    return renamed_lookup(dated, names, {"county_cd": "CountyCode"})


def state_zips(areas: DataFrame, crosswalk: DataFrame) -> DataFrame:
    """Zip areas with the counties of this state they lie in."""
    padded = crosswalk.select(
        zero_pad(F.col("ZIP"), 5).alias("ZIP"),
        zero_pad(F.col("COUNTY"), 5).alias("COUNTY"),
    ).where(F.col("COUNTY").startswith(STATE_PREFIX))
    return areas.join(padded, areas["ZCTA5CE20"] == padded["ZIP"], "inner")


def zip_survey_ids(survey: DataFrame, name: str = "Qualifying Name") -> DataFrame:
    """Zip code as the second word of the area's full name."""
    return survey.withColumn("GEOID", nth_word(F.col(f"`{name}`"), 2))
