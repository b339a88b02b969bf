"""Geographic columns: distances, areas, zones, tiles, alert ids, map links."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values. Distances use the mean radius, box areas the authalic one.
MEAN_RADIUS_M, AREA_RADIUS_M, EQUATOR_RADIUS_M, METRES_PER_DEGREE = 6371008.8, 6371007.181, 6378137.0, 111320.0


def haversine_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat1), F.radians(lon2 - lon1)
    a = F.pow(F.sin(dlat / 2), 2) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon / 2), 2)
    return 2 * MEAN_RADIUS_M * F.asin(F.sqrt(F.least(F.lit(1.0), a)))


def sphere_m(lon: Column, lat: Column) -> list[Column]:
    """A place as metres from the centre of the earth along three axes: no seam at 180 degrees, no poles."""
    phi, lam = F.radians(lat), F.radians(lon)
    return [MEAN_RADIUS_M * F.cos(phi) * F.cos(lam), MEAN_RADIUS_M * F.cos(phi) * F.sin(lam), MEAN_RADIUS_M * F.sin(phi)]


def _packed(x: Column, y: Column, z: Column) -> Column:
    """Three cell numbers, each within 20 bits either way, as one."""
    return ((x + (1 << 20)) * (1 << 21) + (y + (1 << 20))) * (1 << 21) + (z + (1 << 20))


def sphere_cell(lon: Column, lat: Column, width_m: float) -> Column:
    """The cube that a place lies in, of a grid of cubes through the earth; places within width_m are in the same cube or in touching ones."""
    if width_m * (1 << 20) < MEAN_RADIUS_M:
        raise ValueError(f"cells of {width_m} m are too many to number")
    return _packed(*(F.floor(v / width_m) for v in sphere_m(lon, lat)))


def sphere_cells_within(lon: Column, lat: Column, radius_m: float, width_m: float) -> Column:
    """The cubes that may hold places within a radius (array); eight at most for cubes twice as wide."""
    # the straight way through the earth is never longer than the way over it
    around = [F.sequence(F.floor((v - radius_m) / width_m), F.floor((v + radius_m) / width_m)) for v in sphere_m(lon, lat)]
    return F.flatten(F.transform(around[0], lambda x: F.flatten(F.transform(around[1], lambda y: F.transform(around[2], lambda z: _packed(x, y, z))))))


def cells_beside(cell: Column) -> Column:
    """A cube's number and those of the 26 that touch it (array)."""
    return F.array(*(cell + F.lit(((i << 21) + j << 21) + k).cast("long") for i in (-1, 0, 1) for j in (-1, 0, 1) for k in (-1, 0, 1)))


def utm_epsg(lon: Column, lat: Column) -> Column:
    """Unchecked, unlike zone_of: a place off the globe gets whatever the rule gives."""
    zone = F.least(F.floor((lon + 180) / 6) + 1, F.lit(60))
    return (zone + F.when(lat >= 0, 32600).otherwise(32700)).cast("int")


def zone_of(lon: float, lat: float) -> int:
    """The code of a place's zone; a place off the globe is an error."""
    if not (-180 <= lon <= 180 and -90 <= lat <= 90):
        raise ValueError(f"no place on the globe: {lon}, {lat}")
    return (32600 if lat >= 0 else 32700) + min(60, 1 + math.floor((lon + 180) / 6))


def bbox_area_km2(west: Column, south: Column, east: Column, north: Column) -> Column:
    return F.abs(F.lit(AREA_RADIUS_M**2) * F.radians(east - west) * (F.sin(F.radians(north)) - F.sin(F.radians(south)))) / 1e6


def pixel_ha(lat: Column, pixel_m: float = 10.0) -> Column:
    """Area of a pixel that is pixel_m wide at the equator, on the sphere."""
    return F.lit((pixel_m / EQUATOR_RADIUS_M) ** 2 * MEAN_RADIUS_M**2 / 1e4) * F.cos(F.radians(lat))


def pixels_to_ha(n: Column, pixel_m: float) -> Column:
    return n * (pixel_m * pixel_m / 1e4)


def min_clearing_pixels(ha: float, pixel_m: float) -> int:
    """Half-even, at least 1."""
    return max(1, round(ha / (pixel_m * pixel_m / 1e4)))


def mercator_px(lon: Column, lat: Column, zoom: int) -> tuple[Column, Column]:
    scale = 2.0**zoom * 256
    phi = F.radians(lat)
    return (lon + 180) / 360 * scale, (1 - F.log(F.tan(phi) + 1 / F.cos(phi)) / math.pi) / 2 * scale


def half_width_degrees(metres: float, lat: Column) -> tuple[Column, Column]:
    """Longitude and latitude spans of half a chip."""
    return metres / (METRES_PER_DEGREE * F.cos(F.radians(lat))), F.lit(metres / METRES_PER_DEGREE)


def alert_id(lon: Column, lat: Column, seen: Column) -> Column:
    return F.substring(F.sha2(F.concat_ws(",", F.format_string("%.6f", lon), F.format_string("%.6f", lat), seen.cast("string")), 256), 1, 16)


def satellite_url(lat: Column, lon: Column, zoom: int = 16) -> Column:
    return F.format_string(f"https://www.google.com/maps/@%.6f,%.6f,{zoom}z/data=!3m1!1e3", lat, lon)


def map_url(lat: Column, lon: Column, zoom: int = 16) -> Column:
    return F.format_string(f"https://www.openstreetmap.org/?mlat=%.6f&mlon=%.6f#map={zoom}/%.6f/%.6f", lat, lon, lat, lon)


def slug_of(name: str) -> str:
    return name.lower().translate({ord(" "): "-", ord("_"): "-"})


def slug(name: Column) -> Column:
    return F.regexp_replace(F.lower(name), "[ _]", "-")
