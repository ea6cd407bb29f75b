"""Geometry and geodesy as Column expressions.

A polygon is ``rings array<array<struct<x:double,y:double>>>``; inside and outside follow the even-odd rule over all rings, so holes and
parts of a multipolygon need no special case.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# WGS84 and the UTM projection (Snyder 1987, chapter 8)
_A, _INVERSE_F, _K0, _EASTING = 6378137.0, 298.257223563, 0.9996, 500000.0
_F = 1 / _INVERSE_F
_E2 = _F * (2 - _F)
_EP2 = _E2 / (1 - _E2)


def utm_zone(lon: Column) -> Column:
    return ((lon + 180) / 6).cast("int") + 1


def central_meridian(zone: Column) -> Column:
    return (zone - 1) * 6 - 180 + 3


def utm_epsg(lon: Column, lat: Column) -> Column:
    return F.when(lat >= 0, F.lit(32600)).otherwise(F.lit(32700)) + utm_zone(lon)


def wgs84_to_utm(lat: Column, lon: Column, zone: Column) -> Column:
    """struct(easting, northing), north of the equator, in metres."""
    phi, lam = F.radians(lat), F.radians(lon - central_meridian(zone))
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    n = F.lit(_A) / F.sqrt(1 - _E2 * sin * sin)
    t, c, a = tan * tan, _EP2 * cos * cos, cos * lam
    e4, e6 = _E2**2, _E2**3
    m = _A * (
        (1 - _E2 / 4 - 3 * e4 / 64 - 5 * e6 / 256) * phi
        - (3 * _E2 / 8 + 3 * e4 / 32 + 45 * e6 / 1024) * F.sin(2 * phi)
        + (15 * e4 / 256 + 45 * e6 / 1024) * F.sin(4 * phi)
        - (35 * e6 / 3072) * F.sin(6 * phi)
    )
    a2 = a * a
    east = _K0 * n * (a + (1 - t + c) * a2 * a / 6 + (5 - 18 * t + t * t + 72 * c - 58 * _EP2) * a2 * a2 * a / 120) + _EASTING
    north = _K0 * (m + n * tan * (a2 / 2 + (5 - t + 9 * c + 4 * c * c) * a2 * a2 / 24 + (61 - 58 * t + t * t + 600 * c - 330 * _EP2) * a2 * a2 * a2 / 720))
    return F.struct(east.alias("easting"), north.alias("northing"))


def utm_to_wgs84(easting: Column, northing: Column, zone: Column) -> Column:
    """struct(lat, lon)."""
    e1 = (1 - (1 - _E2) ** 0.5) / (1 + (1 - _E2) ** 0.5)
    mu = northing / _K0 / (_A * (1 - _E2 / 4 - 3 * _E2**2 / 64 - 5 * _E2**3 / 256))
    phi = (
        mu
        + (3 * e1 / 2 - 27 * e1**3 / 32) * F.sin(2 * mu)
        + (21 * e1**2 / 16 - 55 * e1**4 / 32) * F.sin(4 * mu)
        + (151 * e1**3 / 96) * F.sin(6 * mu)
        + (1097 * e1**4 / 512) * F.sin(8 * mu)
    )
    sin, cos, tan = F.sin(phi), F.cos(phi), F.tan(phi)
    root = F.sqrt(1 - _E2 * sin * sin)
    n, r = F.lit(_A) / root, F.lit(_A * (1 - _E2)) / (root * root * root)
    t, c, d = tan * tan, _EP2 * cos * cos, (easting - _EASTING) / (n * _K0)
    d2 = d * d
    lat = phi - (n * tan / r) * (d2 / 2 - (5 + 3 * t + 10 * c - 4 * c * c - 9 * _EP2) * d2 * d2 / 24 + (61 + 90 * t + 298 * c + 45 * t * t - 252 * _EP2 - 3 * c * c) * d2 * d2 * d2 / 720)
    lon = (d - (1 + 2 * t + c) * d2 * d / 6 + (5 - 2 * c + 28 * t - 3 * c * c + 8 * _EP2 + 24 * t * t) * d2 * d2 * d / 120) / cos
    return F.struct(F.degrees(lat).alias("lat"), (F.degrees(lon) + central_meridian(zone)).alias("lon"))


def edges(rings: Column) -> Column:
    """array<struct(p, q)>: all edges of all rings; rings close by themselves."""
    ring = lambda r: F.zip_with(r, F.concat(F.slice(r, 2, F.greatest(F.size(r) - 1, F.lit(0))), F.slice(r, 1, 1)), lambda p, q: F.struct(p.alias("p"), q.alias("q")))
    return F.flatten(F.transform(rings, ring))


def on_edge(x: Column, y: Column, e: Column) -> Column:
    p, q = e["p"], e["q"]
    cross = (q["x"] - p["x"]) * (y - p["y"]) - (q["y"] - p["y"]) * (x - p["x"])
    return (cross == 0) & x.between(F.least(p["x"], q["x"]), F.greatest(p["x"], q["x"])) & y.between(F.least(p["y"], q["y"]), F.greatest(p["y"], q["y"]))


def covered_by(all_edges: Column, x: Column, y: Column) -> Column:
    """Inside the polygon of these edges or on one of them, by casting a ray to the right."""
    crossed = lambda e: ((e["p"]["y"] > y) != (e["q"]["y"] > y)) & (
        x < (e["q"]["x"] - e["p"]["x"]) * (y - e["p"]["y"]) / F.nullif(e["q"]["y"] - e["p"]["y"], F.lit(0.0)) + e["p"]["x"]
    )
    return F.exists(all_edges, lambda e: on_edge(x, y, e)) | (F.size(F.filter(all_edges, crossed)) % 2 == 1)


def covers(rings: Column, x: Column, y: Column) -> Column:
    """Inside or on the boundary."""
    return covered_by(edges(rings), x, y)


def signed_area(ring: Column) -> Column:
    return F.aggregate(edges(F.array(ring)), F.lit(0.0), lambda s, e: s + e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]) / 2


def area(rings: Column) -> Column:
    """Shoelace over rings of one polygon: the first ring less the rest, whichever way they run."""
    sizes = F.transform(rings, lambda r: F.abs(signed_area(r)))
    return F.coalesce(F.get(sizes, F.lit(0)), F.lit(0.0)) - F.aggregate(F.slice(sizes, 2, F.greatest(F.size(sizes) - 1, F.lit(0))), F.lit(0.0), lambda s, a: s + a)


def oriented_area(rings: Column) -> Column:
    """Of rings that run counter-clockwise around the polygon and clockwise around its holes, however many parts it has."""
    return F.aggregate(F.transform(rings, signed_area), F.lit(0.0), lambda s, a: s + a)


def centroid(ring: Column) -> Column:
    """struct(x, y) of an outer ring, weighted by area; the mean of its points if it has none."""
    zero = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def step(s: Column, e: Column) -> Column:
        w = e["p"]["x"] * e["q"]["y"] - e["q"]["x"] * e["p"]["y"]
        return F.struct((s["x"] + (e["p"]["x"] + e["q"]["x"]) * w).alias("x"), (s["y"] + (e["p"]["y"] + e["q"]["y"]) * w).alias("y"))

    total = F.aggregate(edges(F.array(ring)), zero, step)
    six = F.nullif(signed_area(ring) * 6, F.lit(0.0))
    mean = lambda k: F.aggregate(ring, F.lit(0.0), lambda s, p: s + p[k]) / F.size(ring)
    return F.struct(F.coalesce(total["x"] / six, mean("x")).alias("x"), F.coalesce(total["y"] / six, mean("y")).alias("y"))


def perimeter(rings: Column) -> Column:
    return F.aggregate(edges(rings), F.lit(0.0), lambda s, e: s + F.hypot(e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"]))


def bounds(rings: Column) -> Column:
    points = F.flatten(rings)
    of = lambda k: F.transform(points, lambda p: p[k])
    return F.struct(F.array_min(of("x")).alias("minx"), F.array_min(of("y")).alias("miny"), F.array_max(of("x")).alias("maxx"), F.array_max(of("y")).alias("maxy"))


def distance(rings: Column, x: Column, y: Column) -> Column:
    """From a point to the nearest point of a polygon; 0 inside."""

    def to_edge(e: Column) -> Column:
        # between the ends the cross product by the length: whole numbers lose nothing to rounding
        dx, dy = e["q"]["x"] - e["p"]["x"], e["q"]["y"] - e["p"]["y"]
        ax, ay, bx, by = x - e["p"]["x"], y - e["p"]["y"], x - e["q"]["x"], y - e["q"]["y"]
        along, square = ax * dx + ay * dy, dx * dx + dy * dy
        return F.when((along > 0) & (along < square), F.abs(ax * dy - ay * dx) / F.sqrt(F.nullif(square, F.lit(0.0)))).otherwise(F.sqrt(F.least(ax * ax + ay * ay, bx * bx + by * by)))

    return F.when(covers(rings, x, y), F.lit(0.0)).otherwise(F.array_min(F.transform(edges(rings), to_edge)))


def project(rings: Column, zone: Column) -> Column:
    """Rings from UTM to longitude (x) and latitude (y)."""

    def point(p: Column) -> Column:
        g = utm_to_wgs84(p["x"], p["y"], zone)
        return F.struct(g["lon"].alias("x"), g["lat"].alias("y"))

    return F.transform(rings, lambda r: F.transform(r, point))


def to_utm(rings: Column, zone: Column) -> Column:
    """Rings from longitude (x) and latitude (y) to UTM."""

    def point(p: Column) -> Column:
        g = wgs84_to_utm(p["y"], p["x"], zone)
        return F.struct(g["easting"].alias("x"), g["northing"].alias("y"))

    return F.transform(rings, lambda r: F.transform(r, point))


def box(minx: Column, miny: Column, maxx: Column, maxy: Column) -> Column:
    """Rings of a rectangle."""
    p = lambda x, y: F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))
    return F.array(F.array(p(minx, miny), p(maxx, miny), p(maxx, maxy), p(minx, maxy)))
