"""Groups of buildings whose centres are filled, without a group in one row."""

import random

import numpy as np
import pytest

from geoloom.functions import columns as geo
from geoloom.functions import kernel
from geoloom.functions.grid import GridSpec
from geoloom.operators import vector

GRID = GridSpec(-7, 311, 10, -10, 200, 200)


def box(a, b, c, d):
    return [[(a, b), (c, b), (c, d), (a, d), (a, b)]]


def dense(cells):
    """Inner cells by a flood cell by cell."""
    x0, x1 = min(x for x, _ in cells) - 1, max(x for x, _ in cells) + 1
    y0, y1 = min(y for _, y in cells) - 1, max(y for _, y in cells) + 1
    around = [(dx, dy) for dx in (-1, 0, 1) for dy in (-1, 0, 1)]
    out, todo = {(x0, y0)}, [(x0, y0)]
    while todo:
        x, y = todo.pop()
        for dx, dy in around:
            q = x + dx, y + dy
            if q not in out and q not in cells and x0 <= q[0] <= x1 and y0 <= q[1] <= y1:
                out.add(q)
                todo.append(q)
    filled = {(x, y) for x in range(x0, x1 + 1) for y in range(y0, y1 + 1)} - out
    return {(x, y) for x, y in filled if all((x + dx, y + dy) in filled for dx, dy in around)}


@pytest.mark.parametrize("seed", range(40))
def test_inner_cells_by_a_flood(seed):
    r = random.Random(seed)
    n, share = r.randrange(4, 16), r.choice((0.3, 0.6, 0.8))
    cells = {(x - 5, y + 3) for x in range(n) for y in range(n) if r.random() < share} | {(0, 0)}
    cells |= {(x, y) for x in range(20, 26) for y in range(20, 26) if x in (20, 25) or y in (20, 25)} if seed % 2 else set()
    x, y = np.array(sorted(cells), np.int64).T
    got = kernel.inner_cells(x, y)
    assert sorted(zip(*(v.tolist() for v in got), strict=True)) == sorted(dense(cells))


def test_wide_group_needs_no_dense_window():
    """a group's cells took an array as large as their envelope, here 3.6 * 10**9 cells."""
    ring = [[(x + 0.2, y + 0.2), (x + 0.6, y + 0.2), (x + 0.6, y + 0.6), (x + 0.2, y + 0.2)] for x in range(5) for y in range(5) if x in (0, 4) or y in (0, 4)]
    far = [(60_000.2, 60_000.2), (60_000.6, 60_000.2), (60_000.6, 60_000.6), (60_000.2, 60_000.2)]
    filled = kernel.fill_centre([[r] for r in [*ring, far]], GridSpec(0, 400_000, 1, -1, 400_000, 400_000))
    assert kernel.area(filled) == pytest.approx(9 + 17 * 0.08, rel=1e-3)


def members(seed):
    """Group 1 a dense block, 2 a ring with an island, 3 without inner cells, 4 a block and a street of lone buildings that touch cells or not."""
    r = random.Random(seed)
    at = lambda x, y, w: box(x, y, x + r.randrange(2, w), y + r.randrange(2, w))
    out = [(1, [at(r.randrange(0, 90), r.randrange(0, 90), 12)]) for _ in range(700)]
    out += [(2, [at(x, y, 9)]) for x in range(100, 200, 5) for y in range(100, 200, 5) if min(x, y) < 110 or max(x, y) > 185]
    out += [(2, [box(151, 151, 154, 153)]), (2, [box(130, 130, 132, 139), box(170, 170, 171, 171)])]
    out += [(3, [at(210 + 4 * k, 5, 9)]) for k in range(6)]
    out += [(4, [at(r.randrange(203, 243), r.randrange(203, 243), 12)]) for _ in range(300)] + [(4, [box(260 + 5 * k, 221, 263 + 5 * k, 224)]) for k in range(40)]
    return [*out, (5, None), (6, [])]


@pytest.mark.parametrize("size,levels", [(7, 2), (40, 1), (1000, 0)])
def test_filled_by_buckets_is_filled_at_once(spark, size, levels):
    """groups stood in one row, and one task united all their outer buildings."""
    rows = members(size)
    frame = spark.createDataFrame([(k, None if g is None else vector.write(g)) for k, g in rows], f"id long, geom {geo.GEOM}")
    got = {r["id"]: r for r in vector.fill_centres(frame, GRID, size, levels).collect()}
    assert sorted(got) == [1, 2, 3, 4, 5, 6]
    for k, r in got.items():
        whole = [p for of, g in rows if of == k for p in g or []]
        want, geom = kernel.fill_centre(whole, GRID), vector.read(r["geom"])
        assert r["poly_count"] == len(whole)
        if k == 3:
            assert sorted(geom) == sorted(want)
        # sides along the axes and whole numbers: the overlay is exact
        assert len(geom) == len(want) and kernel.area(geom) == kernel.area(want)
        assert k in (3, 5, 6) or kernel.area(kernel.overlay([geom, want], lambda w: (w[:, 0] > 0) != (w[:, 1] > 0))) == 0


def test_no_task_sees_a_whole_group(spark, tmp_path, monkeypatch):
    """no union is given more shapes than a bucket or what is left of a component."""
    rows = [(1, vector.write([box(x, y, x + 9, y + 9)])) for x in range(0, 200, 3) for y in range(0, 200, 3)]
    seen = tmp_path / "seen"
    frame = spark.createDataFrame(rows, f"id long, geom {geo.GEOM}")
    united = vector._united

    def watched(layer, keys):
        counted = layer.groupBy(*keys).count().agg({"count": "max"}).first()[0]
        with seen.open("a") as out:
            out.write(f"{counted}\n")
        return united(layer, keys)

    monkeypatch.setattr(vector, "_united", watched)
    got = vector.fill_centres(frame, GRID, 20).first()
    assert got["poly_count"] == len(rows) == 4489 and len(got["geom"]) == 1
    assert 0 < max(map(int, seen.read_text().split())) <= 70
