"""Equal-area projection of longitude/latitude to state metres.

Albers conic for an ellipsoid (Snyder, Map Projections: A Working Manual, USGS
Professional Paper 1395, equations 14-1 to 14-21 and 3-12, 14-15).
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, functions as F

# GRS80 ellipsoid and the state's Albers parameters
SEMI_MAJOR = 6378137.0
INVERSE_FLATTENING = 298.257222101
PARALLEL_1 = 34.0
PARALLEL_2 = 40.5
ORIGIN_LATITUDE = 0.0
CENTRAL_MERIDIAN = -120.0
FALSE_EASTING = 0.0
FALSE_NORTHING = -4000000.0

_F = 1.0 / INVERSE_FLATTENING
_E2 = _F * (2.0 - _F)
_E = math.sqrt(_E2)


def _m(latitude: float) -> float:
    s = math.sin(math.radians(latitude))
    return math.cos(math.radians(latitude)) / math.sqrt(1.0 - _E2 * s * s)


def _q(latitude: float) -> float:
    s = math.sin(math.radians(latitude))
    return (1.0 - _E2) * (
        s / (1.0 - _E2 * s * s)
        - math.log((1.0 - _E * s) / (1.0 + _E * s)) / (2.0 * _E)
    )


CONE = (_m(PARALLEL_1) ** 2 - _m(PARALLEL_2) ** 2) / (_q(PARALLEL_2) - _q(PARALLEL_1))
SCALE = _m(PARALLEL_1) ** 2 + CONE * _q(PARALLEL_1)
RADIUS_0 = SEMI_MAJOR * math.sqrt(SCALE - CONE * _q(ORIGIN_LATITUDE)) / CONE
ECCENTRICITY = _E
ECCENTRICITY_2 = _E2


def project_albers(longitude: Column, latitude: Column) -> Column:
    """``struct(x, y)`` in metres."""
    s = F.sin(F.radians(latitude))
    e = F.lit(_E)
    q = F.lit(1.0 - _E2) * (
        s / (F.lit(1.0) - F.lit(_E2) * s * s)
        - F.log((F.lit(1.0) - e * s) / (F.lit(1.0) + e * s)) / F.lit(2.0 * _E)
    )
    radius = F.lit(SEMI_MAJOR / CONE) * F.sqrt(F.lit(SCALE) - F.lit(CONE) * q)
    angle = F.radians(longitude - F.lit(CENTRAL_MERIDIAN)) * F.lit(CONE)
    return F.struct(
        (F.lit(FALSE_EASTING) + radius * F.sin(angle)).alias("x"),
        (F.lit(FALSE_NORTHING + RADIUS_0) - radius * F.cos(angle)).alias("y"),
    )


# --------------------------------------------------------------------------
# The older layers' local grid: Lambert conformal conic (Snyder, equations
# 14-15, 15-1 to 15-11, 3-5), in survey feet
# --------------------------------------------------------------------------

# EPSG 2227
GRID_PARALLEL_1 = 38.0 + 26.0 / 60.0
GRID_PARALLEL_2 = 37.0 + 4.0 / 60.0
GRID_ORIGIN_LATITUDE = 36.5
GRID_CENTRAL_MERIDIAN = -120.5
GRID_FALSE_EASTING = 2000000.0  # metres
GRID_FALSE_NORTHING = 500000.0
SURVEY_FOOT = 1200.0 / 3937.0


def _t(latitude: float) -> float:
    s = _E * math.sin(math.radians(latitude))
    return math.tan(math.pi / 4 - math.radians(latitude) / 2) / ((1 - s) / (1 + s)) ** (_E / 2)


GRID_CONE = (math.log(_m(GRID_PARALLEL_1)) - math.log(_m(GRID_PARALLEL_2))) / (
    math.log(_t(GRID_PARALLEL_1)) - math.log(_t(GRID_PARALLEL_2))
)
GRID_SCALE = SEMI_MAJOR * _m(GRID_PARALLEL_1) / (GRID_CONE * _t(GRID_PARALLEL_1) ** GRID_CONE)
GRID_RADIUS_0 = GRID_SCALE * _t(GRID_ORIGIN_LATITUDE) ** GRID_CONE
# latitude from the conformal one: factors of sin(2x), sin(4x), sin(6x), sin(8x)
LATITUDE_SERIES = (
    _E2 / 2 + 5 * _E2**2 / 24 + _E2**3 / 12 + 13 * _E2**4 / 360,
    7 * _E2**2 / 48 + 29 * _E2**3 / 240 + 811 * _E2**4 / 11520,
    7 * _E2**3 / 120 + 81 * _E2**4 / 1120,
    4279 * _E2**4 / 161280,
)


def project_grid(longitude: Column, latitude: Column) -> Column:
    """``struct(x, y)`` in survey feet of the local grid."""
    phi = F.radians(latitude)
    s = F.lit(_E) * F.sin(phi)
    t = F.tan(F.lit(math.pi / 4) - phi / 2.0) / F.pow((1.0 - s) / (1.0 + s), F.lit(_E / 2))
    radius = F.lit(GRID_SCALE) * F.pow(t, F.lit(GRID_CONE))
    angle = F.radians(longitude - F.lit(GRID_CENTRAL_MERIDIAN)) * F.lit(GRID_CONE)
    return F.struct(
        ((F.lit(GRID_FALSE_EASTING) + radius * F.sin(angle)) / F.lit(SURVEY_FOOT)).alias("x"),
        (
            (F.lit(GRID_FALSE_NORTHING + GRID_RADIUS_0) - radius * F.cos(angle))
            / F.lit(SURVEY_FOOT)
        ).alias("y"),
    )


def from_grid(x: Column, y: Column) -> Column:
    """``struct(x, y)`` in degrees from survey feet of the local grid."""
    east = x * F.lit(SURVEY_FOOT) - F.lit(GRID_FALSE_EASTING)
    south = F.lit(GRID_FALSE_NORTHING + GRID_RADIUS_0) - y * F.lit(SURVEY_FOOT)
    radius = F.sqrt(east * east + south * south)
    t = F.pow(radius / F.lit(GRID_SCALE), F.lit(1.0 / GRID_CONE))
    conformal = F.lit(math.pi / 2) - 2.0 * F.atan(t)
    latitude = conformal
    for n, factor in enumerate(LATITUDE_SERIES, 1):
        latitude = latitude + F.lit(factor) * F.sin(conformal * float(2 * n))
    angle = F.degrees(F.atan2(east, south)) / F.lit(GRID_CONE)
    return F.struct(
        (angle + F.lit(GRID_CENTRAL_MERIDIAN)).alias("x"), F.degrees(latitude).alias("y")
    )


def project_rings(
    rings: Column, project: Callable[[Column, Column], Column] = project_albers
) -> Column:
    """A projection of every point of a ``rings`` column."""
    return F.transform(
        rings,
        lambda ring: F.struct(
            ring["hole"].alias("hole"),
            F.transform(ring["points"], lambda p: project(p["x"], p["y"])).alias("points"),
        ),
    )
