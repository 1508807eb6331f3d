"""WKT, WKB, EWKB and GeoJSON of polygons to nested rings and back."""

from __future__ import annotations

import json
import re
import struct

from geoloom.functions.kernel import Geometry

POLYGON, MULTI, COLLECTION = 3, 6, 7


def to_wkb(geom: Geometry, srid: int | None = None) -> bytes:
    """A multipolygon, little-endian; with an SRID the extended form."""
    head = struct.pack("<BI", 1, MULTI | (0x20000000 if srid is not None else 0)) + (struct.pack("<I", srid) if srid is not None else b"")
    parts = [head, struct.pack("<I", len(geom))]
    for p in geom:
        parts.append(struct.pack("<BII", 1, POLYGON, len(p)))
        for r in p:
            parts.append(struct.pack(f"<I{2 * len(r)}d", len(r), *(c for q in r for c in q)))
    return b"".join(parts)


def from_wkb(data: bytes) -> tuple[Geometry, int | None]:
    """(polygons, SRID if given) of a polygon, multipolygon or a collection with exactly one of them; z and m are dropped."""
    at = 0

    def take(fmt: str, order: str) -> tuple:
        nonlocal at
        out = struct.unpack_from(order + fmt, data, at)
        at += struct.calcsize(order + fmt)
        return out

    def one() -> tuple[Geometry, int | None, bool]:
        nonlocal at
        order = "<" if data[at] == 1 else ">"
        at += 1
        kind = take("I", order)[0]
        srid = take("I", order)[0] if kind & 0x20000000 else None
        width = 2 + bool(kind & 0x80000000) + bool(kind & 0x40000000)
        kind &= 0x0FFFFFFF
        width, kind = (width + {0: 0, 1: 1, 2: 1, 3: 2}[kind // 1000], kind % 1000) if kind >= 1000 else (width, kind)
        if kind == POLYGON:
            polygon = []
            for _ in range(take("I", order)[0]):
                n = take("I", order)[0]
                c = take(f"{n * width}d", order)
                polygon.append([(c[i], c[i + 1]) for i in range(0, n * width, width)])
            return [polygon] if polygon else [], srid, True
        if kind in (MULTI, COLLECTION):
            found = [one() for _ in range(take("I", order)[0])]
            areal = [g for g, _, is_area in found if is_area]
            if kind == COLLECTION and len(areal) != 1:
                raise ValueError("a collection must hold exactly one polygon or multipolygon")
            return [p for g in areal for p in g], srid, True
        n = {1: 1}.get(kind)
        if kind == 2:
            n = take("I", order)[0]
        if n is None:
            raise ValueError(f"geometry type {kind} has no area")
        take(f"{n * width}d", order)
        return [], srid, False

    geom, srid, is_area = one()
    if not is_area:
        raise ValueError("not a polygon or multipolygon")
    return geom, srid


def to_wkt(geom: Geometry) -> str:
    ring = lambda r: "(" + ", ".join(f"{x!r} {y!r}" for x, y in r) + ")"
    return "MULTIPOLYGON (" + ", ".join("(" + ", ".join(map(ring, p)) + ")" for p in geom) + ")" if geom else "MULTIPOLYGON EMPTY"


def from_wkt(text: str) -> Geometry:
    kind, _, body = re.sub(r"^\s*SRID=\d+;", "", text).strip().partition("(")
    kind = kind.strip().upper()
    if kind in ("POLYGON EMPTY", "MULTIPOLYGON EMPTY"):
        return []
    if kind not in ("POLYGON", "MULTIPOLYGON"):
        raise ValueError(f"not a polygon: {kind}")
    nested = re.sub(r"([-+.\deE]+)\s+([-+.\deE]+)(?:\s+[-+.\deE]+)*", r"[\1,\2]", "(" + body).replace("(", "[").replace(")", "]")
    found = json.loads(re.sub(r"(?<=[\[,])\.", "0.", nested))
    polygons = [found] if kind == "POLYGON" else found
    return [[[(float(x), float(y)) for x, y in r] for r in p] for p in polygons]


def to_geojson(geom: Geometry) -> str:
    return json.dumps({"type": "MultiPolygon", "coordinates": [[[list(q) for q in r] for r in p] for p in geom]})


def from_geojson(value: str | dict) -> Geometry:
    g = json.loads(value) if isinstance(value, str) else value
    if g["type"] not in ("Polygon", "MultiPolygon"):
        raise ValueError(f"not a polygon: {g['type']}")
    polygons = [g["coordinates"]] if g["type"] == "Polygon" else g["coordinates"]
    return [[[(float(q[0]), float(q[1])) for q in r] for r in p] for p in polygons]
