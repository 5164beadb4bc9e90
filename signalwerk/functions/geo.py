"""Coordinates as SQL expressions: projection, hexagon cells, tiles, distances. They stay in generated code and need no library."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# GRS80 and the transverse Mercator series, third order in the flattening
_F = 1 / 298.257222101
_N = _F / (2 - _F)
_RADIUS = 6378137 / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64) * 0.9996
_ALPHA = (_N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16, 13 * _N**2 / 48 - 3 * _N**3 / 5, 61 * _N**3 / 240)
TILE_X, TILE_Y = 0.04, 0.025


def utm_sql(lon: str, lat: str, zone: int) -> tuple[str, str]:
    """SQL for easting and northing in a UTM zone of the northern half, for SQL of longitude and latitude in degrees."""
    k = 2 * math.sqrt(_N) / (1 + _N)
    phi, lam = f"radians({lat})", f"radians(({lon}) - {6 * zone - 183})"
    t = f"sinh(atanh(sin({phi})) - {k!r} * atanh({k!r} * sin({phi})))"
    xi, eta = f"atan2({t}, cos({lam}))", f"atanh(sin({lam}) / sqrt(1 + ({t}) * ({t})))"
    e = " + ".join(f"{a!r} * cos({2 * j} * {xi}) * sinh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1))
    n = " + ".join(f"{a!r} * sin({2 * j} * {xi}) * cosh({2 * j} * {eta})" for j, a in enumerate(_ALPHA, 1))
    return f"(500000 + {_RADIUS!r} * ({eta} + {e}))", f"({_RADIUS!r} * ({xi} + {n}))"


def valid_point(lon: Column, lat: Column) -> Column:
    return lon.isNotNull() & lat.isNotNull() & ~F.isnan(lon) & ~F.isnan(lat) & (F.abs(lon) <= 180) & (lat > -90) & (lat < 90)


def hex_cell(x: Column, y: Column, size: Column) -> Column:
    """Key `size:i:j` of the flat-top hexagon of an edge length that holds a projected point. Of the nine nearest centres the closest wins, then the smaller i and j."""
    height = size * math.sqrt(3)
    col = F.rint(x / (size * 1.5))
    options = []
    for di in (-1, 0, 1):
        i = col + di
        odd = F.pmod(i, F.lit(2.0))
        row = F.rint(y / height - odd / 2)
        for dj in (-1, 0, 1):
            j = row + dj
            cx, cy = size * 1.5 * i, height * (j + odd / 2)
            options.append(F.struct(((x - cx) * (x - cx) + (y - cy) * (y - cy)).alias("d"), i.cast("long").alias("i"), j.cast("long").alias("j")))
    best = F.array_min(F.array(*options))
    return F.concat_ws(":", size.cast("int").cast("string"), best["i"].cast("string"), best["j"].cast("string"))


def tile_keys(lon_min: Column, lat_min: Column, lon_max: Column, lat_max: Column) -> Column:
    """Keys `x_y` of all tiles that a bounding box touches."""
    span = lambda low, high, step: F.sequence(F.floor(low / step), F.floor(high / step))
    ys = span(lat_min, lat_max, TILE_Y)
    return F.flatten(F.transform(span(lon_min, lon_max, TILE_X), lambda x: F.transform(ys, lambda y: F.concat_ws("_", x.cast("string"), y.cast("string")))))


def haversine(lon_a: Column, lat_a: Column, lon_b: Column, lat_b: Column, radius: float = 6371008.8) -> Column:
    dlat, dlon = F.radians(lat_b - lat_a), F.radians(lon_b - lon_a)
    h = F.sin(dlat / 2) * F.sin(dlat / 2) + F.cos(F.radians(lat_a)) * F.cos(F.radians(lat_b)) * F.sin(dlon / 2) * F.sin(dlon / 2)
    return F.asin(F.sqrt(F.least(h, F.lit(1.0)))) * (2 * radius)
