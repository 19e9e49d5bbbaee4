"""The area-ratio crosswalks between geographic layers.

Layers come in longitude and latitude and are projected inside the plan.  A
layer that several crosswalks use is stored once with its boxes and areas.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from arealytics.functions.projection import project_rings
from arealytics.operators.crosswalk import build_crosswalk
from arealytics.operators.geometry import Layer, stored_layer, to_edges
from arealytics.operators.union import union_edges
from arealytics.sinks import write_table

TOWNSHIP = "MeridianTownshipRange"


def projected(shapes: DataFrame, shape_id: str) -> DataFrame:
    """Edges of geographic shapes in metres."""
    metres = shapes.select(shape_id, project_rings(F.col("rings")).alias("rings"))
    return to_edges(metres, shape_id)


def township_edges(parts: DataFrame) -> DataFrame:
    """Townships merged from rows ``(Meridian, TownshipRange, rings)``; rows
    without a name are left out."""
    name = F.trim(F.concat(F.col("Meridian"), F.lit(" "), F.col("TownshipRange")))
    named = parts.select(name.alias(TOWNSHIP), "rings").where(F.col(TOWNSHIP) != "")
    # a row is a part of its own, known by its outline
    numbered = named.withColumn("_part", F.sha2(F.to_json("rings"), 256))
    keys = numbered.select("_part", TOWNSHIP).distinct()
    return union_edges(projected(numbered.dropDuplicates(["_part"]), "_part"), keys, "_part", TOWNSHIP)


def area_layer(shapes: DataFrame, shape_id: str) -> Layer:
    return stored_layer(projected(shapes, shape_id))


def crosswalk_job(
    sections: DataFrame,
    tracts: DataFrame,
    zips: DataFrame,
    schools: DataFrame,
    townships: DataFrame,
) -> dict[str, DataFrame]:
    """All crosswalks: sections over three census layers, tracts over sections
    and townships."""
    section = area_layer(sections, "CO_MTRS")
    tract = area_layer(tracts, "GEOID")
    census = {
        "section_zip": (area_layer(zips, "ZCTA5CE20"), "ZCTA5CE20"),
        "section_tract": (tract, "GEOID"),
        "section_school": (area_layer(schools, "FIPS"), "FIPS"),
    }
    found = {
        name: build_crosswalk(section, layer, "CO_MTRS", target)
        for name, (layer, target) in census.items()
    }
    found["tract_section"] = build_crosswalk(tract, section, "GEOID", "CO_MTRS")
    found["tract_township"] = build_crosswalk(
        tract, stored_layer(township_edges(townships)), "GEOID", TOWNSHIP
    )
    return found


def section_areas(sections: DataFrame) -> DataFrame:
    """``(comtrs, ALAND)``: projected area of each section, as the demography of
    sections and townships uses it."""
    return area_layer(sections, "CO_MTRS").areas.select(
        F.col("id").alias("comtrs"), F.col("area").alias("ALAND")
    )


def write_crosswalks(crosswalks: Mapping[str, DataFrame], folder: str) -> None:
    for name, df in crosswalks.items():
        write_table(df, f"{folder.rstrip('/')}/{name}")
