"""Spherical geometry as Column expressions, so every formula stays in generated JVM code."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0
FENCE_RADIUS_KM = 15.0

# Grid steps in degrees.  Powers of two keep the division exact, so a cell never depends on
# rounding.  "7" and "9" name the two resolutions the tables carry (about 1.7 km and 0.2 km).
CELL_DEGREES = {7: 1 / 64, 9: 1 / 512}


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    half_dlat = F.radians(lat2 - lat1) / 2
    half_dlon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_dlat), 2.0) + (
        F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(half_dlon), 2.0)
    )
    return 2 * EARTH_RADIUS_KM * F.atan2(F.sqrt(chord), F.sqrt(1 - chord))


def great_circle_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Law of cosines.  ``least``/``greatest`` skip NULLs, hence the explicit guard."""
    p1, p2 = F.radians(lat1), F.radians(lat2)
    cosine = F.sin(p1) * F.sin(p2) + F.cos(p1) * F.cos(p2) * F.cos(F.radians(lon2) - F.radians(lon1))
    clamped = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), cosine))
    return F.when(cosine.isNotNull(), EARTH_RADIUS_KM * F.acos(clamped))


def in_fence(
    lat: Column, lon: Column, fence_lat: Column, fence_lon: Column, radius_km: Column | float | None = None
) -> Column:
    """A missing or zero radius means the default one."""
    if radius_km is None:
        radius = F.lit(FENCE_RADIUS_KM)
    else:
        given = radius_km if isinstance(radius_km, Column) else F.lit(float(radius_km))
        radius = F.coalesce(F.nullif(given, F.lit(0.0)), F.lit(FENCE_RADIUS_KM))
    return haversine_km(lat, lon, fence_lat, fence_lon) <= radius


def bearing_deg(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Initial compass bearing in [0, 360)."""
    p1, p2, dlon = F.radians(lat1), F.radians(lat2), F.radians(lon2) - F.radians(lon1)
    east = F.sin(dlon) * F.cos(p2)
    north = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dlon)
    return F.pmod(F.degrees(F.atan2(east, north)) + 360.0, F.lit(360.0))


def interpolate(start: Column, end: Column, fraction: Column | float) -> Column:
    return start + (end - start) * fraction


def cell_index(degrees: Column, step: float) -> Column:
    return F.floor(degrees / F.lit(step))


def geo_cell(lat: Column, lon: Column, resolution: int = 7) -> Column:
    """Text id of the latitude/longitude grid cell that holds a point; NULL for a missing point.

    A square grid of about the size of ``hexagons.hex_cell``, and cheaper; any other
    ``(lat, lon, resolution) -> Column`` function can be passed where a cell function is asked for.
    """
    step = CELL_DEGREES[resolution]
    return F.concat(
        F.lit(f"C{resolution}_"),
        cell_index(lat, step).cast("string"),
        F.lit("_"),
        cell_index(lon, step).cast("string"),
    )
