"""Closed-form geometry as Columns.

A geometry is ARRAY<polygon>, a polygon ARRAY<ring> (shell first), a ring ARRAY<STRUCT<x, y>> that is
closed; coordinates are doubles. Nothing here leaves generated JVM code for Python.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

GEOM = "array<array<array<struct<x:double,y:double>>>>"
SPHERE = 6_378_137.0  # radius of the published area formula


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def point(x: Column, y: Column) -> Column:
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def box_ring(minx: Column | str, miny: Column | str, maxx: Column | str, maxy: Column | str) -> Column:
    a, b, c, d = map(_c, (minx, miny, maxx, maxy))
    return F.array(point(a, b), point(c, b), point(c, d), point(a, d), point(a, b))


def box(minx: Column | str, miny: Column | str, maxx: Column | str, maxy: Column | str) -> Column:
    return F.array(F.array(box_ring(minx, miny, maxx, maxy)))


def vertices(geom: Column | str) -> Column:
    return F.flatten(F.flatten(_c(geom)))


def envelope(geom: Column | str) -> list[Column]:
    v = vertices(geom)
    xs, ys = F.transform(v, lambda p: p["x"]), F.transform(v, lambda p: p["y"])
    return [F.array_min(xs).alias("minx"), F.array_min(ys).alias("miny"), F.array_max(xs).alias("maxx"), F.array_max(ys).alias("maxy")]


def _steps(ring: Column) -> Column:
    """Pairs of neighbours of a closed ring, each against the ring's first vertex for precision."""
    n = F.size(ring)
    return F.transform(F.sequence(F.lit(0), n - 2), lambda i: F.struct(ring[i].alias("p"), ring[i + 1].alias("q"), ring[0].alias("o")))


def _cross(s: Column) -> Column:
    return (s["p"]["x"] - s["o"]["x"]) * (s["q"]["y"] - s["o"]["y"]) - (s["q"]["x"] - s["o"]["x"]) * (s["p"]["y"] - s["o"]["y"])


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, v: a + v)


def ring_area(ring: Column | str) -> Column:
    """Signed: positive if counter-clockwise."""
    ring = _c(ring)
    return F.when(F.size(ring) < 4, 0.0).otherwise(_sum(F.transform(_steps(ring), _cross)) / 2)


def is_ccw(ring: Column | str) -> Column:
    return ring_area(ring) > 0


def _rings(geom: Column | str, of_ring) -> Column:
    """Sum of of_ring over shells less that over holes; of_ring gives magnitudes."""
    polygon = lambda p: of_ring(p[0]) - _sum(F.transform(F.slice(p, 2, F.greatest(F.size(p) - 1, F.lit(0))), of_ring))
    return _sum(F.transform(_c(geom), polygon))


def area(geom: Column | str) -> Column:
    return _rings(geom, lambda r: F.abs(ring_area(r)))


def centroid(geom: Column | str) -> Column:
    """Struct (x, y) of the area centroid."""

    def moment(ring: Column, axis: str) -> Column:
        signed = _sum(F.transform(_steps(ring), lambda s: _cross(s) * (s["p"][axis] + s["q"][axis] + s["o"][axis]))) / 6
        return signed * F.signum(ring_area(ring))

    total = area(geom)
    return point(_rings(geom, lambda r: moment(r, "x")) / total, _rings(geom, lambda r: moment(r, "y")) / total)


def remove_holes(geom: Column | str) -> Column:
    return F.transform(_c(geom), lambda p: F.slice(p, 1, 1))


def spherical_area(geom: Column | str, radius: float = SPHERE) -> Column:
    """Square metres on the sphere (Chamberlain and Duquette, 2007), coordinates in degrees."""
    rad = math.pi / 180

    def ring(r: Column) -> Column:
        n = F.size(r) - 1
        term = lambda i: (r[F.pmod(i + 1, n)]["x"] - r[F.pmod(i + n - 1, n)]["x"]) * rad * F.sin(r[i]["y"] * rad)
        return F.when(n < 3, 0.0).otherwise(F.abs(_sum(F.transform(F.sequence(F.lit(0), n - 1), term))) * (radius * radius / 2))

    return _rings(geom, ring)


def contains_point(geom: Column | str, x: Column | str, y: Column | str) -> Column:
    """Even-odd test of a point against all rings; a ray to the left, half-open edges."""
    x, y = _c(x), _c(y)

    def crossings(ring: Column) -> Column:
        def hit(s: Column) -> Column:
            a, b = s["p"], s["q"]
            spans = (a["y"] > y) != (b["y"] > y)
            at = a["x"] + (y - a["y"]) * (b["x"] - a["x"]) / F.when(spans, b["y"] - a["y"]).otherwise(1.0)
            return F.when(spans & (x > at), 1.0).otherwise(0.0)

        return F.when(F.size(ring) < 4, 0.0).otherwise(_sum(F.transform(_steps(ring), hit)))

    return _sum(F.transform(F.flatten(_c(geom)), crossings)) % 2 == 1


def utm_zone(lon: Column | str) -> Column:
    """ceil((lon + 180) / 6), without the exceptions of the north; null for the antimeridian's west side."""
    zone = F.ceil((_c(lon) + 180) / 6).cast("int")
    return F.when(zone > 0, zone)


def utm_north(lat: Column | str) -> Column:
    return _c(lat) > 0


def haversine(lon1: Column | str, lat1: Column | str, lon2: Column | str, lat2: Column | str, radius: float = 6_371_008.8) -> Column:
    a, b = F.radians(_c(lat1)), F.radians(_c(lat2))
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(_c(lon2) - _c(lon1)) / 2), 2)
    return 2 * radius * F.asin(F.sqrt(h))


# projections -------------------------------------------------------------------------------------
_A, _F = 6_378_137.0, 1 / 298.257223563
_N = _F / (2 - _F)
_E = math.sqrt(_F * (2 - _F))
_RECT = _A / (1 + _N) * (1 + _N**2 / 4 + _N**4 / 64 + _N**6 / 256)
# Krueger's series (Karney, 2011), fixed values, to the sixth order in n
_ALPHA = (
    _N / 2 - 2 / 3 * _N**2 + 5 / 16 * _N**3 + 41 / 180 * _N**4 - 127 / 288 * _N**5 + 7891 / 37800 * _N**6,
    13 / 48 * _N**2 - 3 / 5 * _N**3 + 557 / 1440 * _N**4 + 281 / 630 * _N**5 - 1983433 / 1935360 * _N**6,
    61 / 240 * _N**3 - 103 / 140 * _N**4 + 15061 / 26880 * _N**5 + 167603 / 181440 * _N**6,
    49561 / 161280 * _N**4 - 179 / 168 * _N**5 + 6601661 / 7257600 * _N**6,
    34729 / 80640 * _N**5 - 3418889 / 1995840 * _N**6,
    212378941 / 319334400 * _N**6,
)


def web_mercator(lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
    return F.radians(_c(lon)) * _A, F.log(F.tan(math.pi / 4 + F.radians(_c(lat)) / 2)) * _A


def transverse_mercator(lon: Column | str, lat: Column | str, centre: Column, scale: float = 0.9996, false_x: float = 500_000.0) -> tuple[Column, Column]:
    """Easting and northing on the WGS 84 ellipsoid; the south keeps negative northings."""
    phi, lam = F.radians(_c(lat)), F.radians(_c(lon) - centre)
    t = F.sinh(F.atanh(F.sin(phi)) - _E * F.atanh(_E * F.sin(phi)))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_ALPHA, 1):
        x = x + a * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + a * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return x * (_RECT * scale) + false_x, y * (_RECT * scale)


def utm(lon: Column | str, lat: Column | str) -> tuple[Column, Column]:
    return transverse_mercator(lon, lat, utm_zone(lon) * 6.0 - 183.0)


def laea(lon: Column | str, lat: Column | str, lon0: float, lat0: float) -> tuple[Column, Column]:
    """Lambert's equal-area azimuthal projection of the ellipsoid (Snyder, 1987)."""
    e2 = _E * _E
    q_of = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - F.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    s0 = math.sin(math.radians(lat0))
    qn = lambda s: (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - _E * s) / (1 + _E * s)) / (2 * _E))
    qp = qn(1.0)
    rq = _A * math.sqrt(qp / 2)
    b0 = math.asin(qn(s0) / qp)
    m0 = math.cos(math.radians(lat0)) / math.sqrt(1 - e2 * s0 * s0)
    d = _A * m0 / (rq * math.cos(b0))
    b, lam = F.asin(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), q_of(F.sin(F.radians(_c(lat)))) / qp))), F.radians(_c(lon) - lon0)
    k = rq * F.sqrt(2 / (1 + math.sin(b0) * F.sin(b) + math.cos(b0) * F.cos(b) * F.cos(lam)))
    return k * d * F.cos(b) * F.sin(lam), k / d * (math.cos(b0) * F.sin(b) - math.sin(b0) * F.cos(b) * F.cos(lam))
