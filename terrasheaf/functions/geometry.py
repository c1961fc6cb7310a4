"""Column functions over grids, rings and coordinates. A ring is an array of (x, y) structs whose last point repeats the first."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Radius of the spherical Mercator projection in metres.
MERCATOR_RADIUS = 6378137.0
# The GRS80 ellipsoid and the parameters of the contiguous-US Albers equal-area projection.
SEMI_MAJOR, FLATTENING = 6378137.0, 1 / 298.257222101
PARALLEL_1, PARALLEL_2, ORIGIN_LAT, ORIGIN_LON = map(math.radians, (29.5, 45.5, 23.0, -96.0))
ECCENTRICITY2 = 2 * FLATTENING - FLATTENING**2
ECCENTRICITY = math.sqrt(ECCENTRICITY2)


def pixel_area(a: Column, b: Column, d: Column, e: Column) -> Column:
    """The area of a cell under an affine transform."""
    return F.abs(a * e - b * d)


def grid_bbox(x0: Column, y0: Column, dx: Column, dy: Column, ncols: Column, nrows: Column) -> Column:
    """The extent of a grid; ``dy`` is signed, so rows may run up or down."""
    x1, y1 = x0 + ncols * dx, y0 + nrows * dy
    return F.struct(F.least(x0, x1).alias("minx"), F.least(y0, y1).alias("miny"), F.greatest(x0, x1).alias("maxx"), F.greatest(y0, y1).alias("maxy"))


def polygon_area(ring: Column) -> Column:
    """The planar area of a ring, by the cross products of its sides."""
    side = lambda p, i: p["x"] * F.element_at(ring, F.least(i + 2, F.size(ring)))["y"] - F.element_at(ring, F.least(i + 2, F.size(ring)))["x"] * p["y"]
    return F.abs(F.aggregate(F.transform(ring, side), F.lit(0.0), lambda acc, x: acc + x)) / 2


def crossings(ring: Column, y: Column) -> Column:
    """Where a ring's sides cross a horizontal line, in order; a side counts if it has one end above the line and one not above it."""

    def cross(p: Column, i: Column) -> Column:
        q = F.element_at(ring, F.least(i + 2, F.size(ring)))
        return F.when((p["y"] > y) != (q["y"] > y), (q["x"] - p["x"]) * (y - p["y"]) / (q["y"] - p["y"]) + p["x"])

    return F.array_sort(F.filter(F.transform(ring, cross), lambda x: x.isNotNull()))


def ring_bbox(ring: Column) -> Column:
    xs, ys = F.transform(ring, lambda p: p["x"]), F.transform(ring, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy"))


def mercator_from_lonlat(lon: Column, lat: Column) -> tuple[Column, Column]:
    return F.radians(lon) * MERCATOR_RADIUS, F.ln(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2)) * MERCATOR_RADIUS


def lonlat_from_mercator(x: Column, y: Column) -> tuple[Column, Column]:
    return F.degrees(x / MERCATOR_RADIUS), F.degrees(2 * F.atan(F.exp(y / MERCATOR_RADIUS)) - math.pi / 2)


def _q(sine: float) -> float:
    return (1 - ECCENTRICITY2) * (sine / (1 - ECCENTRICITY2 * sine**2) - math.log((1 - ECCENTRICITY * sine) / (1 + ECCENTRICITY * sine)) / (2 * ECCENTRICITY))


def _m(lat: float) -> float:
    return math.cos(lat) / math.sqrt(1 - ECCENTRICITY2 * math.sin(lat) ** 2)


ALBERS_N = (_m(PARALLEL_1) ** 2 - _m(PARALLEL_2) ** 2) / (_q(math.sin(PARALLEL_2)) - _q(math.sin(PARALLEL_1)))
ALBERS_C = _m(PARALLEL_1) ** 2 + ALBERS_N * _q(math.sin(PARALLEL_1))
ALBERS_RHO0 = SEMI_MAJOR * math.sqrt(ALBERS_C - ALBERS_N * _q(math.sin(ORIGIN_LAT))) / ALBERS_N


def albers_from_lonlat(lon: Column, lat: Column) -> tuple[Column, Column]:
    """Equal-area coordinates of the contiguous US from degrees (published closed form, no datum shift)."""
    s = F.sin(F.radians(lat))
    q = (s / (1 - s * s * ECCENTRICITY2) - F.ln((1 - s * ECCENTRICITY) / (1 + s * ECCENTRICITY)) / (2 * ECCENTRICITY)) * (1 - ECCENTRICITY2)
    rho, theta = F.sqrt(F.lit(ALBERS_C) - q * ALBERS_N) * (SEMI_MAJOR / ALBERS_N), (F.radians(lon) - ORIGIN_LON) * ALBERS_N
    return rho * F.sin(theta), F.lit(ALBERS_RHO0) - rho * F.cos(theta)


def lonlat_from_albers(x: Column, y: Column) -> tuple[Column, Column]:
    """Degrees from equal-area coordinates, by the series of the authalic latitude."""
    dy = F.lit(ALBERS_RHO0) - y
    rho, theta = F.sqrt(x * x + dy * dy), F.atan2(x, dy)
    q = (F.lit(ALBERS_C) - rho * rho * (ALBERS_N / SEMI_MAJOR) ** 2) / ALBERS_N
    beta = F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), q / _q(1.0))))
    e2, e4, e6 = ECCENTRICITY2, ECCENTRICITY2**2, ECCENTRICITY2**3
    lat = beta + F.sin(beta * 2) * (e2 / 3 + 31 * e4 / 180 + 517 * e6 / 5040) + F.sin(beta * 4) * (23 * e4 / 360 + 251 * e6 / 3780) + F.sin(beta * 6) * (761 * e6 / 45360)
    return F.degrees(F.lit(ORIGIN_LON) + theta / ALBERS_N), F.degrees(lat)


def reproject_xy(x: Column, y: Column, source: int, target: int) -> tuple[Column, Column]:
    """Coordinates between EPSG 4326, 3857 and 5070."""
    to_degrees = {4326: lambda a, b: (a, b), 3857: lonlat_from_mercator, 5070: lonlat_from_albers}
    from_degrees = {4326: lambda a, b: (a, b), 3857: mercator_from_lonlat, 5070: albers_from_lonlat}
    return from_degrees[target](*to_degrees[source](x, y))


def xyz_tile(lon: Column, lat: Column, zoom: Column) -> tuple[Column, Column]:
    """Column and row of the Web-Mercator tile that holds a point, clamped to the zoom level's range."""
    n = F.shiftleft(F.lit(1), zoom).cast("double") if isinstance(zoom, int) else F.pow(F.lit(2.0), zoom)
    fit = lambda v: F.greatest(F.lit(0), F.least(n.cast("int") - 1, F.floor(v).cast("int")))
    r = F.radians(lat)
    return fit((lon + 180) / 360 * n), fit((1 - F.ln(F.tan(r) + 1 / F.cos(r)) / math.pi) / 2 * n)


def morton(x: Column, y: Column, bits: int) -> Column:
    """The bits of a tile's column and row in turn, so that a tile's number is how those of all tiles within it begin."""
    bit = lambda v, k, to: F.shiftleft(F.shiftright(v.cast("long"), k).bitwiseAND(F.lit(1).cast("long")), to)
    return sum((bit(x, k, 2 * k) + bit(y, k, 2 * k + 1) for k in range(bits)), F.lit(0).cast("long"))


def from_morton(key: Column, bits: int) -> tuple[Column, Column]:
    bit = lambda k, to: F.shiftleft(F.shiftright(key, k).bitwiseAND(F.lit(1).cast("long")), to)
    return tuple(sum((bit(2 * k + odd, k) for k in range(bits)), F.lit(0).cast("long")).cast("int") for odd in (0, 1))


def value_mask(value: Column, values: list[int], nodata: Column, invert: bool = False) -> Column:
    """255 for cells whose value is in (or, inverted, not in) the set, else 0; cells without data stay so."""
    hit = value.isin(values)
    return F.when(value == nodata, nodata.cast("int")).otherwise(F.when(~hit if invert else hit, 255).otherwise(0))
