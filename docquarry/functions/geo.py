"""Geographic predicates over ``struct(lat, lon)`` columns."""

from __future__ import annotations

import math
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_KM = 6371.0088

# Kilometres per distance unit.
_KM = {
    "km": 1.0, "kilometers": 1.0,
    "m": 1e-3, "meters": 1e-3,
    "cm": 1e-5, "centimeters": 1e-5,
    "mm": 1e-6, "millimeters": 1e-6,
    "mi": 1.609344, "miles": 1.609344,
    "yd": 0.0009144, "yards": 0.0009144,
    "ft": 0.0003048, "feet": 0.0003048,
    "in": 0.0000254, "inch": 0.0000254,
    "nmi": 1.852, "nauticalmiles": 1.852, "NM": 1.852,
}


def kilometres(distance: str | float) -> float:
    """Read ``"10km"``, ``"5 mi"`` or a bare number of metres."""
    found = re.fullmatch(r"\s*([0-9.]+(?:[eE][+-]?\d+)?)\s*([A-Za-z]*)\s*", str(distance))
    if not found or (found[2] and found[2] not in _KM):
        raise ValueError(f"bad distance {distance!r}")
    return float(found[1]) * _KM[found[2] or "m"]


def haversine_km(lat: Column, lon: Column, to_lat: float, to_lon: float) -> Column:
    dlat = F.radians(lat - F.lit(float(to_lat)))
    dlon = F.radians(lon - F.lit(float(to_lon)))
    half = (F.pow(F.sin(dlat / 2), 2)
            + F.cos(F.radians(lat)) * F.lit(math.cos(math.radians(to_lat)))
            * F.pow(F.sin(dlon / 2), 2))
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(F.least(half, F.lit(1.0))))


def within_distance(lat: Column, lon: Column, distance: str | float,
                    to_lat: float, to_lon: float) -> Column:
    """Great-circle distance test behind a pushable latitude/longitude box."""
    km = kilometres(distance)
    reach = math.degrees(km / EARTH_RADIUS_KM) * (1 + 1e-9) + 1e-9
    south, north = to_lat - reach, to_lat + reach
    box = (lat >= F.lit(south)) & (lat <= F.lit(north))
    # A cap that covers a pole holds every longitude.
    if south > -90 and north < 90:
        ratio = math.sin(math.radians(reach)) / math.cos(math.radians(to_lat))
        spread = math.degrees(math.asin(min(1.0, ratio))) + 1e-9
        west, east = to_lon - spread, to_lon + spread
        if spread < 180:
            # Longitudes are met in -180..180 and in 0..360 notation.
            spans = [(west + turn, east + turn) for turn in (-360.0, 0.0, 360.0)]
            near = [(lon >= F.lit(w)) & (lon <= F.lit(e)) for w, e in spans
                    if e >= -180 and w <= 360]
            any_near = near[0]
            for span in near[1:]:
                any_near = any_near | span
            box = box & any_near
    return box & (haversine_km(lat, lon, to_lat, to_lon) <= F.lit(km))


def within_box(lat: Column, lon: Column, top: float, left: float,
               bottom: float, right: float) -> Column:
    if bottom > top:
        raise ValueError("the top edge must not lie below the bottom edge")
    inside = (lat <= F.lit(float(top))) & (lat >= F.lit(float(bottom)))
    from_left, to_right = lon >= F.lit(float(left)), lon <= F.lit(float(right))
    # A box whose left edge lies east of its right edge crosses the antimeridian.
    return inside & ((from_left | to_right) if left > right else (from_left & to_right))
