"""Many geometries at once: an Arrow column as flat arrays, and tests and areas of whole lists of pairs.

Convex polygons of one ring and up to ``SIDES`` sides go through numpy for all pairs together; any other pair
goes through the kernel by itself, with the same meaning.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa

from geoloom.functions import kernel

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
GEOM = pa.list_(pa.list_(pa.list_(POINT)))
SIDES = 16
CHUNK = 50_000  # pairs at a time


class Shapes:
    """Geometries by position; cx and cy hold the convex ones counter-clockwise, a column each, padded with the last vertex."""

    def __init__(self, array: pa.Array):
        if isinstance(array, pa.ChunkedArray):
            array = array.combine_chunks() if array.num_chunks != 1 else array.chunk(0)
        self.geoms = np.asarray(array.offsets, np.int64)
        polygons = array.values
        self.polys = np.asarray(polygons.offsets, np.int64)
        rings = polygons.values
        self.rings = np.asarray(rings.offsets, np.int64)
        points = rings.values
        self.x, self.y = (np.asarray(points.field(k), float) for k in (0, 1))
        self.n = len(array)
        self._read: dict[int, kernel.Geometry] = {}
        self._convex()

    def _convex(self) -> None:
        first = np.minimum(self.geoms[:-1], max(len(self.polys) - 2, 0))
        one = self.geoms[1:] - self.geoms[:-1] == 1
        start, length = np.zeros(self.n, np.int64), np.zeros(self.n, np.int64)
        if one.any():
            poly = first[one]
            ring = self.polys[poly]
            lone = self.polys[poly + 1] - ring == 1
            at = np.flatnonzero(one)[lone]
            start[at], length[at] = self.rings[ring[lone]], self.rings[ring[lone] + 1] - self.rings[ring[lone]]
        self.start, self.sides = start, np.maximum(length - 1, 0)
        self.convex, self.area = np.zeros(self.n, bool), np.zeros(self.n)
        found = []
        for size in np.unique(length[(length >= 4) & (length <= SIDES + 1)]).tolist():
            at = np.flatnonzero(length == size)
            where = start[at][None, :] + np.arange(size)[:, None]
            px, py = self.x[where], self.y[where]
            dx, dy = np.diff(px, axis=0), np.diff(py, axis=0)
            ex, ey = np.roll(dx, -1, 0), np.roll(dy, -1, 0)
            turn = dx * ey - dy * ex
            swept = np.abs(np.arctan2(turn, dx * ex + dy * ey).sum(0))
            ok = ((turn >= 0).all(0) | (turn <= 0).all(0)) & (np.abs(swept - 2 * np.pi) < 1e-6) & (px[0] == px[-1]) & (py[0] == py[-1])
            px, py = px[:-1, ok], py[:-1, ok]
            signed = shoelace(px, py)
            back = signed < 0
            px[:, back], py[:, back] = px[::-1, back], py[::-1, back]
            found.append((at[ok], px, py))
            self.convex[at[ok]], self.area[at[ok]] = signed != 0, np.abs(signed)
        wide = max((len(f[1]) for f in found), default=3)
        self.cx, self.cy = np.zeros((wide, self.n)), np.zeros((wide, self.n))
        for at, px, py in found:
            self.cx[: len(px), at], self.cy[: len(py), at] = px, py
            self.cx[len(px) :, at], self.cy[len(py) :, at] = px[-1], py[-1]

    def geom(self, i: int) -> kernel.Geometry:
        if i not in self._read:
            self._read[i] = [
                [list(zip(self.x[a:b].tolist(), self.y[a:b].tolist(), strict=True)) for a, b in zip(self.rings[self.polys[p] : self.polys[p + 1]], self.rings[self.polys[p] + 1 : self.polys[p + 1] + 1], strict=True)]
                for p in range(self.geoms[i], self.geoms[i + 1])
            ]
        return self._read[i]


def shoelace(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Signed areas of open rings in columns, against each one's first vertex for precision."""
    x, y = x - x[0], y - y[0]
    return (x * np.roll(y, -1, 0) - np.roll(x, -1, 0) * y).sum(0) / 2


def _pairwise(a: Shapes, b: Shapes, i: np.ndarray, j: np.ndarray, quick: Callable, slow: Callable, columns: dict[str, type]) -> dict[str, np.ndarray]:
    """quick(i, j) for all pairs of convex shapes, slow(geometry, geometry) for each other pair; both give the columns in order."""
    out = {c: np.zeros(len(i), kind) for c, kind in columns.items()}
    both = a.convex[i] & b.convex[j]
    easy = np.flatnonzero(both)
    for k in range(0, len(easy), CHUNK):
        at = easy[k : k + CHUNK]
        for c, v in zip(out, quick(i[at], j[at]), strict=True):
            out[c][at] = v
    for k in np.flatnonzero(~both).tolist():
        for c, v in zip(out, slow(a.geom(i[k]), b.geom(j[k])), strict=True):
            out[c][k] = v
    return out


def _apart(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray) -> np.ndarray:
    """Whether a side of a convex shape has all of the other strictly beyond it."""
    out = np.zeros(ax.shape[1], bool)
    for k in range(len(ax)):
        px, py, n = ax[k], ay[k], (k + 1) % len(ax)
        dx, dy = ax[n] - px, ay[n] - py
        beyond = dx * (by[0] - py) < dy * (bx[0] - px)
        for v in range(1, len(bx)):
            beyond &= dx * (by[v] - py) < dy * (bx[v] - px)
        out |= beyond
    return out


def intersects(a: Shapes, b: Shapes, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the shapes of each pair share a point; touching counts."""

    def quick(i: np.ndarray, j: np.ndarray) -> tuple:
        ax, ay, bx, by = a.cx[:, i], a.cy[:, i], b.cx[:, j], b.cy[:, j]
        return (~(_apart(ax, ay, bx, by) | _apart(bx, by, ax, ay)),)

    return _pairwise(a, b, i, j, quick, lambda g, h: (kernel.intersects(g, h),), {"met": bool})["met"]


def _clip(x: np.ndarray, y: np.ndarray, side: np.ndarray, length: np.ndarray | None = None, axis: int | None = None, bound: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Open rings in columns cut by a half plane each, side >= 0 being kept: rings padded with their first vertex, and their lengths.

    length: vertices before padding. The line is where the coordinate of ``axis`` is ``bound``, if given.
    """
    k, n = x.shape
    nx, ny, beyond = np.roll(x, -1, 0), np.roll(y, -1, 0), np.roll(side, -1, 0)
    kept, cut = side >= 0, ((side > 0) & (beyond < 0)) | ((side < 0) & (beyond > 0))
    if length is not None:
        kept &= np.arange(k)[:, None] < length
    t = side / np.where(cut, side - beyond, 1.0)
    cx, cy = bound if axis == 0 else x + t * (nx - x), bound if axis == 1 else y + t * (ny - y)
    cx, cy = np.broadcast_to(cx, x.shape), np.broadcast_to(cy, x.shape)
    count = np.zeros(n, np.int64)
    ox, oy = np.zeros((2 * k, n)), np.zeros((2 * k, n))
    for r in range(k):
        for which, vx, vy in ((kept[r], x[r], y[r]), (cut[r], cx[r], cy[r])):
            c = np.flatnonzero(which)
            ox[count[c], c], oy[count[c], c] = vx[c], vy[c]
            count[c] += 1
    most = max(int(count.max(initial=0)), 1)
    ox, oy = ox[:most], oy[:most]
    pad = np.arange(most)[:, None] >= count
    return np.where(pad, ox[0], ox), np.where(pad, oy[0], oy), count


def common_area(a: Shapes, b: Shapes, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Area that convex shapes of each pair share."""
    x0, y0 = a.cx[0, i], a.cy[0, i]
    x, y, bx, by = a.cx[:, i] - x0, a.cy[:, i] - y0, b.cx[:, j] - x0, b.cy[:, j] - y0
    for k in range(len(bx)):
        px, py, n = bx[k], by[k], (k + 1) % len(bx)
        x, y, _ = _clip(x, y, (bx[n] - px) * (y - py) - (by[n] - py) * (x - px))
    return np.maximum(shoelace(x, y), 0.0)


def overlay_areas(a: Shapes, b: Shapes, i: np.ndarray, j: np.ndarray) -> dict[str, np.ndarray]:
    """both_area and left_only of each pair: areas of the intersection and of the difference."""

    def quick(i: np.ndarray, j: np.ndarray) -> tuple:
        both = common_area(a, b, i, j)
        return both, np.maximum(a.area[i] - both, 0.0)

    slow = lambda g, h: (kernel.area(kernel.intersection(g, h)), kernel.area(kernel.difference(g, h)))
    return _pairwise(a, b, i, j, quick, slow, {"both_area": float, "left_only": float})


PREDICATES = ("covers", "covered_by", "touches", "overlaps", "contains_properly", "crosses")


def predicates(a: Shapes, b: Shapes, i: np.ndarray, j: np.ndarray) -> dict[str, np.ndarray]:
    """The kernel's predicates of each pair, by name."""

    def box(s: Shapes, at: np.ndarray) -> tuple:
        return s.cx[:, at].min(0), s.cy[:, at].min(0), s.cx[:, at].max(0), s.cy[:, at].max(0)

    def quick(i: np.ndarray, j: np.ndarray) -> tuple:
        ax, ay, bx, by = a.cx[:, i], a.cy[:, i], b.cx[:, j], b.cy[:, j]
        met = ~(_apart(ax, ay, bx, by) | _apart(bx, by, ax, ay))
        both, of_a, of_b = common_area(a, b, i, j), a.area[i], b.area[j]
        o, p = box(a, i), box(b, j)
        covers = (o[0] <= p[0]) & (o[1] <= p[1]) & (o[2] >= p[2]) & (o[3] >= p[3]) & (of_b - both <= 1e-9 * of_b)
        covered = (p[0] <= o[0]) & (p[1] <= o[1]) & (p[2] >= o[2]) & (p[3] >= o[3]) & (of_a - both <= 1e-9 * of_a)
        inner = met & (both > 1e-9 * np.minimum(of_a, of_b))
        deep = covers.copy()
        for k in range(len(ax)):
            n = (k + 1) % len(ax)
            dx, dy = ax[n] - ax[k], ay[n] - ay[k]
            side = (dx != 0) | (dy != 0)
            for v in range(len(bx)):
                deep &= ~side | (dx * (by[v] - ay[k]) > dy * (bx[v] - ax[k]))
        return covers, covered, met & ~inner, inner & ~covers & ~covered, deep, np.zeros(len(i), bool)

    slow = lambda g, h: (kernel.covers(g, h), kernel.within(g, h), kernel.touches(g, h), kernel.overlaps(g, h), kernel.contains_properly(g, h), kernel.crosses(g, h))
    return _pairwise(a, b, i, j, quick, slow, dict.fromkeys(PREDICATES, bool))


# polygons cut by boxes ---------------------------------------------------------------------------
def clip_to_boxes(array: pa.Array, minx: np.ndarray, miny: np.ndarray, maxx: np.ndarray, maxy: np.ndarray) -> pa.Array:
    """kernel.clip_to_box of each geometry and its own box; convex ones in arrays."""
    s = Shapes(array)
    quick = np.flatnonzero(s.convex)
    parts = []
    for sides in np.unique(s.sides[quick]).tolist():
        alike = quick[s.sides[quick] == sides]
        for k in range(0, len(alike), CHUNK):
            at = alike[k : k + CHUNK]
            where = s.start[at] + np.arange(sides)[:, None]
            x, y, count = s.x[where], s.y[where], np.full(len(at), sides)
            for axis, bound, sign in ((0, minx[at], 1), (0, maxx[at], -1), (1, miny[at], 1), (1, maxy[at], -1)):
                x, y, count = _clip(x, y, sign * ((y if axis else x) - bound), count, axis, bound)
            parts.append((at, x, y, count, (count > 2) & (np.abs(shoelace(x, y)) > 0)))
    out: list = [None] * s.n
    # rows are put together as flat arrays, in order; what isn't convex goes one by one
    slow = {k: kernel.clip_to_box(s.geom(k), minx[k], miny[k], maxx[k], maxy[k]) for k in np.flatnonzero(~s.convex).tolist()}
    if slow:
        for k, g in slow.items():
            out[k] = [[[{"x": float(px), "y": float(py)} for px, py in r] for r in p] for p in g]
    return _assembled(s, parts, out)


def _assembled(s: Shapes, parts: list, out: list) -> pa.Array:
    """One ring for each convex shape that has a part left, as an Arrow column; the others from lists."""
    xs, ys, lengths, owners = [], [], [], []
    for at, x, y, count, kept in parts:
        c = np.flatnonzero(kept)
        rows = len(x)
        px, py = np.vstack((x[:, c], x[:1, c])), np.vstack((y[:, c], y[:1, c]))  # a row after the last for the closing vertex
        n = count[c]
        take = np.arange(rows + 1)[:, None] <= n
        last = np.arange(rows + 1)[:, None] == n
        px, py = np.where(last, px[0], px), np.where(last, py[0], py)
        xs.append(px.T[take.T])
        ys.append(py.T[take.T])
        lengths.append(n + 1)
        owners.append(at[c])
    if xs:
        x, y, length, owner = (np.concatenate(v) for v in (xs, ys, lengths, owners))
    else:
        x = y = np.zeros(0)
        length = owner = np.zeros(0, np.int64)
    points = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(POINT))
    offsets = lambda n: pa.array(np.concatenate(([0], np.cumsum(n))), pa.int32())
    order = np.argsort(owner, kind="stable")
    if (order[1:] < order[:-1]).any():  # rings in the order of their shapes
        begin = np.concatenate(([0], np.cumsum(length)))[:-1][order]
        length = length[order]
        take = np.repeat(begin - np.concatenate(([0], np.cumsum(length)))[:-1], length) + np.arange(length.sum())
        points = points.take(pa.array(take))
    has = np.zeros(s.n, np.int64)
    has[owner] = 1
    rings = pa.ListArray.from_arrays(offsets(length), points)
    polygons = pa.ListArray.from_arrays(pa.array(np.arange(len(owner) + 1), pa.int32()), rings)
    quick = pa.ListArray.from_arrays(offsets(has), polygons).cast(GEOM)
    other = [k for k, g in enumerate(out) if g is not None]
    if not other:
        return quick
    place = np.arange(s.n)
    place[other] = s.n + np.arange(len(other))
    return pa.concat_arrays([quick, pa.array([out[k] for k in other], GEOM)]).take(pa.array(place))


class Outlines:
    """Geometries as lists of sides by number of sides, for tests by even and odd over all rings."""

    def __init__(self, array: pa.Array):
        s = self.shapes = Shapes(array)
        self.n = s.n
        ring_of = np.repeat(np.arange(len(s.rings) - 1), np.diff(s.rings))
        poly_of_ring = np.repeat(np.arange(len(s.polys) - 1), np.diff(s.polys))
        geom_of_poly = np.repeat(np.arange(s.n), np.diff(s.geoms))
        start = np.flatnonzero((np.arange(len(ring_of)) + 1 < len(ring_of)) & (np.append(ring_of[1:], -1) == ring_of))
        self.p = start  # a side goes from point p to p + 1
        self.owner = geom_of_poly[poly_of_ring[ring_of[start]]] if len(start) else np.zeros(0, np.int64)
        self.first = s.rings[ring_of[start]] if len(start) else np.zeros(0, np.int64)
        self.hole = (ring_of[start] != s.polys[poly_of_ring[ring_of[start]]]) if len(start) else np.zeros(0, bool)
        self.ring = ring_of[start] if len(start) else np.zeros(0, np.int64)
        small = (s.rings[1:] - s.rings[:-1] < 4)[self.ring] if len(start) else np.zeros(0, bool)
        self.small = small
        self.count = np.bincount(self.owner, minlength=self.n)
        self.begin = np.concatenate(([0], np.cumsum(self.count)))[:-1]

    def _sides(self, at: np.ndarray) -> tuple:
        """Positions among the sides, a column each, padded, and what is no padding."""
        most = int(self.count[at].max(initial=0))
        k = np.arange(most)[:, None]
        real = k < self.count[at]
        return np.where(real, self.begin[at] + k, 0), real

    def contain(self, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether each shape holds its own point: a ray to the left, half-open edges."""
        out = np.zeros(len(at), bool)
        if not len(self.p):
            return out
        s = self.shapes
        for group in self._alike(at):
            side, real = self._sides(at[group])
            odd = np.zeros(len(group), bool)
            gx, gy = x[group], y[group]
            for k in range(len(side)):
                p = self.p[side[k]]
                odd ^= real[k] & ~self.small[side[k]] & _hit(s.x[p], s.y[p], s.x[p + 1], s.y[p + 1], gx, gy)
            out[group] = odd
        return out

    def _alike(self, at: np.ndarray) -> list[np.ndarray]:
        """Positions in ``at`` by the size of their number of sides, so that padding at most doubles them."""
        size = np.ceil(np.log2(np.maximum(self.count[at], 1))).astype(int)
        return [np.flatnonzero(size == v) for v in np.unique(size)]

    def hold_any(self, at: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether any of the points lies in each shape; more points at a time for those that held none so far."""
        found = np.zeros(len(at), bool)
        if not len(self.p):
            return found
        s = self.shapes
        for group in self._alike(at):
            left, begin, step = group, 0, 8
            while len(left) and begin < len(x):
                side, real = self._sides(at[left])
                step = max(1, min(step, 2_000_000 // len(left)))
                gx, gy = x[begin : begin + step][:, None], y[begin : begin + step][:, None]
                odd = np.zeros((len(gx), len(left)), bool)
                for k in range(len(side)):
                    p = self.p[side[k]]
                    odd ^= (real[k] & ~self.small[side[k]]) & _hit(s.x[p], s.y[p], s.x[p + 1], s.y[p + 1], gx, gy)
                held = odd.any(0)
                found[left[held]] = True
                left = left[~held]
                begin += step
                step *= 2
        return found

    def centroids(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centroids by area as columns.centroid has them, summed side by side in order, ring by ring."""
        s, p = self.shapes, self.p
        ox, oy = s.x[self.first], s.y[self.first]
        cross = (s.x[p] - ox) * (s.y[p + 1] - oy) - (s.x[p + 1] - ox) * (s.y[p] - oy)
        of_ring = lambda v: np.bincount(self.ring, v, minlength=len(s.rings) - 1)  # adds in order
        area = of_ring(np.where(self.small, 0.0, cross)) / 2
        hole = np.zeros(len(area), bool)
        hole[self.ring[self.hole]] = True
        owner = np.zeros(len(area), np.int64)
        owner[self.ring] = self.owner
        of_shape = lambda v: np.bincount(owner, np.where(hole, -v, v), minlength=self.n)[at]
        moment = lambda c, o: of_ring(cross * (c[p] + c[p + 1] + o)) / 6 * np.sign(area)
        total = of_shape(np.abs(area))
        with np.errstate(divide="ignore", invalid="ignore"):
            return of_shape(moment(s.x, ox)) / total, of_shape(moment(s.y, oy)) / total


def _hit(ax: np.ndarray, ay: np.ndarray, bx: np.ndarray, by: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    spans = (ay > y) != (by > y)
    return spans & (x > ax + (y - ay) * (bx - ax) / np.where(spans, by - ay, 1.0))
