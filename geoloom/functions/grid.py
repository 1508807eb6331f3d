"""Raster grids: the arithmetic that ties coordinates, cells and chunks together."""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

from pyspark.sql import Column
from pyspark.sql import functions as F

_EARTH = 6_371_008.8  # mean radius, metres


def _col(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


@dataclass(frozen=True)
class GridSpec:
    """A north-up grid; ``pixel_height`` is negative, row 0 is the top."""

    origin_x: float
    origin_y: float
    pixel_width: float
    pixel_height: float
    cols: int
    rows: int
    srid: int = 4326
    nodata: float | None = None

    # cells of coordinates -------------------------------------------------------------------
    def cell_x(self, x: Column | str) -> Column:
        return F.floor((_col(x) - self.origin_x) / self.pixel_width).cast("long")

    def cell_y(self, y: Column | str) -> Column:
        return F.floor((_col(y) - self.origin_y) / self.pixel_height).cast("long")

    def cell(self, x: float, y: float) -> tuple[int, int]:
        return math.floor((x - self.origin_x) / self.pixel_width), math.floor((y - self.origin_y) / self.pixel_height)

    def nearest_edge(self, x: float) -> int:
        """Cell border nearest to x, halves away from zero."""
        q = (x - self.origin_x) / self.pixel_width
        return math.floor(abs(q) + 0.5) * (1 if q >= 0 else -1)

    def centre_x(self, rx: Column | str) -> Column:
        return F.lit(self.origin_x) + F.lit(self.pixel_width) * (_col(rx) + 0.5)

    def centre_y(self, ry: Column | str) -> Column:
        return F.lit(self.origin_y) + F.lit(self.pixel_height) * (_col(ry) + 0.5)

    def left(self, rx: Column | str) -> Column:
        return F.lit(self.origin_x) + F.lit(self.pixel_width) * _col(rx)

    def top(self, ry: Column | str) -> Column:
        return F.lit(self.origin_y) + F.lit(self.pixel_height) * _col(ry)

    def inside(self, rx: Column | str, ry: Column | str) -> Column:
        return (_col(rx) >= 0) & (_col(rx) < self.cols) & (_col(ry) >= 0) & (_col(ry) < self.rows)

    def clamp_x(self, rx: Column | str) -> Column:
        return F.least(F.greatest(_col(rx), F.lit(0)), F.lit(self.cols - 1))

    def clamp_y(self, ry: Column | str) -> Column:
        return F.least(F.greatest(_col(ry), F.lit(0)), F.lit(self.rows - 1))

    def centred_columns(self, minx: Column | str, maxx: Column | str) -> tuple[Column, Column]:
        """First and last column whose centre is in (minx, maxx]; empty if first > last."""
        w = 2 * self.pixel_width
        edge = lambda x: F.floor((2 * (_col(x) - self.origin_x) - self.pixel_width) / w).cast("long")
        return F.greatest(edge(minx) + 1, F.lit(0)), F.least(edge(maxx), F.lit(self.cols - 1))

    def centred_rows(self, miny: Column | str, maxy: Column | str) -> tuple[Column, Column]:
        """First and last row whose centre, measured downwards, is in (top, bottom]."""
        h = -2 * self.pixel_height
        edge = lambda y: F.floor((2 * (self.origin_y - _col(y)) + self.pixel_height) / h).cast("long")
        return F.greatest(edge(maxy) + 1, F.lit(0)), F.least(edge(miny), F.lit(self.rows - 1))

    # chunks -----------------------------------------------------------------------------------
    def chunk_size(self, chunk_cols: int, chunk_rows: int, aligned: bool = True) -> tuple[float, float]:
        if aligned:
            return math.ceil(self.cols / chunk_cols) * self.pixel_width, math.ceil(self.rows / chunk_rows) * -self.pixel_height
        return self.cols * self.pixel_width / chunk_cols, self.rows * -self.pixel_height / chunk_rows

    def chunk(self, x: Column | str, y: Column | str, chunk_cols: int, chunk_rows: int, aligned: bool = True) -> Column:
        """Number of the chunk that holds a point, null outside."""
        w, h = self.chunk_size(chunk_cols, chunk_rows, aligned)
        cx, cy = F.floor((_col(x) - self.origin_x) / w), F.floor((self.origin_y - _col(y)) / h)
        held = (cx >= 0) & (cx < chunk_cols) & (cy >= 0) & (cy < chunk_rows)
        held = held & (_col(x) < self.origin_x + self.cols * self.pixel_width) & (_col(y) > self.origin_y + self.rows * self.pixel_height)
        return F.when(held, cx + cy * chunk_cols).cast("int")

    def chunk_of(self, x: float, y: float, chunk_cols: int, chunk_rows: int, aligned: bool = True) -> int | None:
        w, h = self.chunk_size(chunk_cols, chunk_rows, aligned)
        cx, cy = math.floor((x - self.origin_x) / w), math.floor((self.origin_y - y) / h)
        return cx + cy * chunk_cols if 0 <= cx < chunk_cols and 0 <= cy < chunk_rows else None

    # grids against each other -------------------------------------------------------------
    def same_as(self, other: GridSpec) -> bool:
        return (
            (self.cols, self.rows) == (other.cols, other.rows)
            and abs(self.origin_x - other.origin_x) <= 1e-6 and abs(self.origin_y - other.origin_y) <= 1e-6
            and abs(self.pixel_width - other.pixel_width) <= 1e-10 and abs(self.pixel_height - other.pixel_height) <= 1e-10
        )

    def aligned_with(self, other: GridSpec) -> bool:
        off = ((self.origin_x - other.origin_x) / self.pixel_width, (self.origin_y - other.origin_y) / self.pixel_height)
        return self.srid == other.srid and all(abs(o - round(o)) <= 1e-6 for o in off)

    def common(self, other: GridSpec) -> tuple[tuple[int, int], tuple[int, int], tuple[int, int]]:
        """(x offsets of both, y offsets of both, columns and rows) of the window both grids cover."""
        dx = round((other.origin_x - self.origin_x) / self.pixel_width)
        dy = round((other.origin_y - self.origin_y) / self.pixel_height)
        x, y = (max(dx, 0), max(-dx, 0)), (max(dy, 0), max(-dy, 0))
        return x, y, (min(self.cols - x[0], other.cols - x[1]), min(self.rows - y[0], other.rows - y[1]))

    def expanded(self, minx: float, miny: float, maxx: float, maxy: float, margin: int = 1) -> GridSpec:
        """The aligned grid that covers an extent with a margin of whole cells."""
        x0, x1 = math.floor((minx - self.origin_x) / self.pixel_width) - margin, math.ceil((maxx - self.origin_x) / self.pixel_width) + margin
        y0, y1 = math.floor((maxy - self.origin_y) / self.pixel_height) - margin, math.ceil((miny - self.origin_y) / self.pixel_height) + margin
        return replace(self, origin_x=self.origin_x + x0 * self.pixel_width, origin_y=self.origin_y + y0 * self.pixel_height, cols=x1 - x0, rows=y1 - y0)

    def windows(self, n: int) -> Iterator[tuple[tuple[int, int], tuple[int, int]]]:
        """At most n x n windows in row-major order: (column, row offset), (columns, rows)."""
        w, h = math.ceil(self.cols / n), math.ceil(self.rows / n)
        for y in range(0, self.rows, h):
            for x in range(0, self.cols, w):
                yield (x, y), (min(w, self.cols - x), min(h, self.rows - y))

    def average_cell_area(self) -> float:
        """Square metres of a cell: mean height times mean width, on the sphere."""
        x0, y0 = self.origin_x, self.origin_y
        x1, y1 = x0 + self.cols * self.pixel_width, y0 + self.rows * self.pixel_height
        height = haversine(x0, y0, x0, y1) / self.rows
        width = (haversine(x0, y0, x1, y0) + haversine(x0, y1, x1, y1)) / 2 / self.cols
        return width * height


def square_size(minx: float, miny: float, maxx: float, maxy: float, metres: float) -> tuple[float, float]:
    """Width and height in degrees of a square of so many metres: means over the two sides of a box, by geodesics."""
    from geoloom.functions.kernel import geodesic_distance

    across = [(maxx - minx) / (geodesic_distance(minx, y, maxx, y) / metres) for y in (miny, maxy)]
    along = [(maxy - miny) / (geodesic_distance(x, miny, x, maxy) / metres) for x in (minx, maxx)]
    return sum(across) / 2, sum(along) / 2


def haversine(lon1: float, lat1: float, lon2: float, lat2: float) -> float:
    a, b = math.radians(lat1), math.radians(lat2)
    h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    return 2 * _EARTH * math.asin(math.sqrt(h))


def spans(first: int, last: int, parts: int) -> list[tuple[int, int]]:
    """Ranges (inclusive) that cut first..last into at most ``parts`` of equal length."""
    step = math.ceil((last - first + 1) / parts)
    return [(a, min(a + step - 1, last)) for a in range(first, last + 1, step)]


def index_width(n: int) -> int:
    """Digits that number 0..n-1 needs."""
    return 1 if n <= 1 else len(str(n - 1))


def is_nodata(value: Column | str, nodata: float | None) -> Column:
    """Whether a cell holds no data: null, not finite, or nodata within 5 units in the last place."""
    v = _col(value).cast("double")
    odd = v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))
    if nodata is None or not math.isfinite(nodata):
        return odd
    near = max(abs(nodata) * 5 * 2.0**-23, 5 * 2.0**-23)
    return odd | (F.abs(v - nodata) <= near)
