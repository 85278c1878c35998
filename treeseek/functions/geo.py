"""Geo points, cells and great-circle distance."""

from __future__ import annotations

import functools
import math
import operator
import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Mean earth radius, and metres per distance unit.
EARTH_RADIUS_M = 6_371_008.8
METRES = {
    "mi": 1609.344, "miles": 1609.344, "yd": 0.9144, "yards": 0.9144, "ft": 0.3048, "feet": 0.3048,
    "in": 0.0254, "inch": 0.0254, "km": 1000.0, "kilometers": 1000.0, "m": 1.0, "meters": 1.0,
    "cm": 0.01, "centimeters": 0.01, "mm": 0.001, "millimeters": 0.001,
    "NM": 1852.0, "nmi": 1852.0, "nauticalmiles": 1852.0,
}
GEOHASH_ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
CELL_LENGTH = 12
# A circle is covered by so many cells at most; more would only make the filter longer.
COVER_CELLS = 24


def metres(distance: str | float) -> float:
    """``'5km'`` → 5000.0; a bare number is metres."""
    if isinstance(distance, (int, float)):
        return float(distance)
    match = re.fullmatch(r"\s*([0-9.]+)\s*([A-Za-z]*)\s*", distance)
    if not match or (match[2] and match[2] not in METRES):
        raise ValueError(f"not a distance: {distance}")
    return float(match[1]) * METRES[match[2] or "m"]


def cell_bounds(text: str) -> tuple[float, float, float, float]:
    """South, north, west, east of a geohash cell."""
    bounds = {"lat": [-90.0, 90.0], "lon": [-180.0, 180.0]}
    axis = "lon"
    for letter in text.lower():
        value = GEOHASH_ALPHABET.index(letter)
        for bit in (16, 8, 4, 2, 1):
            low, high = bounds[axis]
            middle = (low + high) / 2
            bounds[axis] = [middle, high] if value & bit else [low, middle]
            axis = "lat" if axis == "lon" else "lon"
    return *bounds["lat"], *bounds["lon"]


def decode_geohash(text: str) -> tuple[float, float]:
    """Centre (lat, lon) of a geohash cell."""
    south, north, west, east = cell_bounds(text)
    return (south + north) / 2, (west + east) / 2


def point(value: object) -> tuple[float, float]:
    """(lat, lon) from a mapping, a [lon, lat] list, 'lat,lon' or a geohash."""
    if isinstance(value, dict):
        return float(value["lat"]), float(value["lon"])
    if isinstance(value, (list, tuple)):
        return float(value[1]), float(value[0])
    if isinstance(value, str) and "," in value:
        lat, lon = value.split(",")
        return float(lat), float(lon)
    if isinstance(value, str) and value and all(c in GEOHASH_ALPHABET for c in value.lower()):
        return decode_geohash(value)
    raise ValueError(f"not a geo point: {value!r}")


def point_column(value: Column) -> Column:
    """Stored text as struct<lat,lon>: a mapping or a ``[lon, lat]`` list in JSON, ``lat,lon`` or a geohash.

    Anything else gives null, as do pairs with a part missing or too many.
    """
    text = F.trim(value)
    pair = F.split(text, ",")
    forms = (
        F.when(text.startswith("{"), _both(F.get_json_object(text, "$.lat"), F.get_json_object(text, "$.lon")))
        .when(
            text.startswith("[") & (F.size(F.from_json(text, "array<string>")) == 2),
            _both(F.get_json_object(text, "$[1]"), F.get_json_object(text, "$[0]")),
        )
        .when(F.size(pair) == 2, _both(F.get(pair, F.lit(0)), F.get(pair, F.lit(1))))
        .when(F.lower(text).rlike(f"^[{GEOHASH_ALPHABET}]+$"), geohash_column(text))
    )
    return forms


def _both(lat: Column, lon: Column) -> Column:
    lat, lon = lat.try_cast("double"), lon.try_cast("double")
    return F.when(lat.isNotNull() & lon.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon")))


def geohash_column(text: Column) -> Column:
    """Centre of a geohash cell as struct<lat,lon>.

    A letter has five bits, which halve longitude and latitude in turn. So it
    cuts one axis in eight and the other in four, beginning with longitude.
    """
    letters = F.filter(F.split(F.lower(text), ""), lambda c: c != "")

    def bit(value: Column, k: int) -> Column:
        return F.shiftright(value, k).bitwiseAND(1)

    def finer(at: Column, letter: Column) -> Column:
        value = F.call_function("instr", F.lit(GEOHASH_ALPHABET), letter) - 1
        eighths = 4 * bit(value, 4) + 2 * bit(value, 2) + bit(value, 0)
        quarters = 2 * bit(value, 3) + bit(value, 1)
        east = F.when(at["first"], eighths / 8).otherwise(quarters / 4)
        north = F.when(at["first"], quarters / 4).otherwise(eighths / 8)
        return F.struct(
            (at["south"] + north * at["height"]).alias("south"),
            (at["west"] + east * at["width"]).alias("west"),
            (at["height"] / F.when(at["first"], 4.0).otherwise(8.0)).alias("height"),
            (at["width"] / F.when(at["first"], 8.0).otherwise(4.0)).alias("width"),
            (~at["first"]).alias("first"),
        )

    world = F.struct(
        F.lit(-90.0).alias("south"), F.lit(-180.0).alias("west"), F.lit(180.0).alias("height"),
        F.lit(360.0).alias("width"), F.lit(True).alias("first"),
    )
    return F.aggregate(
        letters,
        world,
        finer,
        lambda at: F.struct(
            (at["south"] + at["height"] / 2).alias("lat"), (at["west"] + at["width"] / 2).alias("lon")
        ),
    )


def cell_column(lat: Column, lon: Column, length: int = CELL_LENGTH) -> Column:
    """The geohash cell of a point, ``length`` letters long; null where a coordinate is."""
    lon_bits, lat_bits = (5 * length + 1) // 2, 5 * length // 2

    def steps(value: Column, low: float, span: float, bits: int) -> Column:
        step = F.floor((value - low) / span * (1 << bits)).cast("bigint")
        return F.greatest(F.lit(0), F.least(F.lit((1 << bits) - 1), step))

    def letters(at: Column) -> Column:
        out = []
        for first in range(0, 5 * length, 5):
            value = F.lit(0).cast("bigint")
            for k in range(first, first + 5):
                axis, below = ("lat", lat_bits - 1 - k // 2) if k % 2 else ("lon", lon_bits - 1 - k // 2)
                value = value * 2 + F.shiftright(at[axis], below).bitwiseAND(1)
            out.append(F.substring(F.lit(GEOHASH_ALPHABET), value.cast("int") + 1, F.lit(1)))
        return F.concat(*out)

    whole = F.struct(steps(lat, -90.0, 180.0, lat_bits).alias("lat"), steps(lon, -180.0, 360.0, lon_bits).alias("lon"))
    cell = F.get(F.transform(F.array(whole), letters), F.lit(0))
    return F.when(lat.isNotNull() & lon.isNotNull(), cell)


def with_cell(point: Column, length: int = CELL_LENGTH) -> Column:
    """A point as struct<lat,lon,cell>: rows stored in the order of ``cell`` lie near each other in files."""
    lat, lon = point["lat"], point["lon"]
    cell = cell_column(lat, lon, length)
    return F.when(point.isNotNull(), F.struct(lat.alias("lat"), lon.alias("lon"), cell.alias("cell")))


def _reach(lat0: float, limit: float) -> tuple[float, float]:
    """Degrees of latitude and longitude that a circle reaches; 180 of longitude where it holds a pole."""
    reach = math.degrees(limit / EARTH_RADIUS_M) * (1 + 1e-9) + 1e-9
    if abs(lat0) + reach < 90:
        ratio = math.sin(math.radians(min(reach, 90))) / math.cos(math.radians(lat0))
        if ratio < 1:
            return reach, math.degrees(math.asin(ratio)) * (1 + 1e-9) + 1e-9
    return reach, 180.0


def cover(origin: object, distance: str | float, most: int = COVER_CELLS, length: int = CELL_LENGTH) -> list[str]:
    """At most ``most`` geohash cells of one length that hold all of a circle; ``[""]`` is the whole world."""
    lat0, lon0 = point(origin)
    reach, width = _reach(lat0, metres(distance))

    def meets(cell: str) -> bool:
        south, north, west, east = cell_bounds(cell)
        if north < lat0 - reach or south > lat0 + reach:
            return False
        return any(east + turn >= lon0 - width and west + turn <= lon0 + width for turn in (-360, 0, 360))

    cells = [""]
    for _ in range(length):
        finer = [cell + letter for cell in cells for letter in GEOHASH_ALPHABET]
        finer = [cell for cell in finer if meets(cell)]
        if len(finer) > most:
            break
        cells = finer
    return cells


def distance_m(lat: Column, lon: Column, origin: object) -> Column:
    """Haversine distance in metres to a literal point."""
    lat0, lon0 = (math.radians(v) for v in point(origin))
    phi = F.radians(lat)
    half_lat = F.sin((phi - F.lit(lat0)) / 2)
    half_lon = F.sin((F.radians(lon) - F.lit(lon0)) / 2)
    a = half_lat * half_lat + F.lit(math.cos(lat0)) * F.cos(phi) * half_lon * half_lon
    return F.lit(2 * EARTH_RADIUS_M) * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def within(
    lat: Column, lon: Column, origin: object, distance: str | float, cell: Column | None = None
) -> Column:
    """Inclusive distance test behind a bounding box that Parquet can use.

    The box leaves longitude open where the circle reaches a pole or crosses
    the antimeridian. With a column of cells, prefixes that cover the circle
    come first: on files in the order of cells they leave out row groups.
    """
    lat0, lon0 = point(origin)
    limit = metres(distance)
    reach, width = _reach(lat0, limit)
    box = lat.between(lat0 - reach, lat0 + reach)
    if lon0 - width >= -180 and lon0 + width <= 180:
        box = box & lon.between(lon0 - width, lon0 + width)
    if cell is not None:
        cells = cover(origin, distance)
        if cells != [""]:
            box = functools.reduce(operator.or_, [cell.startswith(c) for c in cells]) & box
    return box & (distance_m(lat, lon, origin) <= limit)
