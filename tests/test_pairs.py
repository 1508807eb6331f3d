"""Lists of pairs in arrays against the kernel, one pair at a time; joins by block against all pairs."""

import random

import numpy as np
import pyarrow as pa
import pytest

from geoloom.functions import columns as geo
from geoloom.functions import kernel, pairs
from geoloom.operators import joins, vector


def some_shapes(n, seed=5):
    """Triangles, boxes either way round, hulls, and shapes that aren't convex, have holes or two parts."""
    r = random.Random(seed)

    def one(k):
        x, y, s, t = r.randrange(40), r.randrange(40), r.randrange(2, 20), r.randrange(2, 20)
        box = lambda a, b, w, h: [(a, b), (a, b + h), (a + w, b + h), (a + w, b), (a, b)]
        return [
            lambda: [[[(x, y + 0.25), (x + s, y + 0.25), (x + s, y + s + 0.25), (x, y + 0.25)]]],
            lambda: [[box(x, y, s, t)]],
            lambda: [[box(x, y, s, t)[::-1]]],
            lambda: [[kernel.convex_hull([(40 * r.random(), 40 * r.random()) for _ in range(9)])]],
            lambda: [[[(x, y), (x + 20, y), (x + 20, y + 5), (x + 5, y + 5), (x + 5, y + 20), (x, y + 20), (x, y)]]],
            lambda: [[box(x, y, 20, 20), box(x + 4, y + 4, 8, 8)]],
            lambda: [[box(x, y, 3, 3)], [box(x + 10, y + 5, 4, 4)]],
        ][k % 7]()

    return [one(k) for k in range(n)]


def as_column(shapes):
    return pairs.Shapes(pa.array([vector.write(g) for g in shapes], vector.GEOM))


def test_pairs_mean_what_the_kernel_means():
    shapes = some_shapes(35)
    s = as_column(shapes)
    assert 0 < s.convex.sum() < len(shapes)
    i, j = (v.ravel() for v in np.meshgrid(np.arange(35), np.arange(35), indexing="ij"))
    met, named, areas = pairs.intersects(s, s, i, j), pairs.predicates(s, s, i, j), pairs.overlay_areas(s, s, i, j)
    for k, (a, b) in enumerate((shapes[x], shapes[y]) for x, y in zip(i, j, strict=True)):
        assert met[k] == kernel.intersects(a, b)
        assert {n: bool(named[n][k]) for n in pairs.PREDICATES} == {
            "covers": kernel.covers(a, b), "covered_by": kernel.within(a, b), "touches": kernel.touches(a, b),
            "overlaps": kernel.overlaps(a, b), "contains_properly": kernel.contains_properly(a, b), "crosses": kernel.crosses(a, b),
        }
        assert areas["both_area"][k] == pytest.approx(kernel.area(kernel.intersection(a, b)), abs=1e-4)
        assert areas["left_only"][k] == pytest.approx(kernel.area(kernel.difference(a, b)), abs=1e-4)


def test_convex_pairs_need_no_call_each(monkeypatch):
    """what made the queries slow was a call of the kernel for each pair."""

    def called(*_):
        raise AssertionError("one pair at a time")

    shapes = as_column([g for g in some_shapes(200) if len(g) == 1 and len(g[0]) == 1 and kernel._is_convex(g[0][0])])
    for name in ("overlay", "intersects"):
        monkeypatch.setattr(kernel, name, called)
    i, j = (v.ravel() for v in np.meshgrid(np.arange(shapes.n), np.arange(shapes.n)))
    for f in (pairs.intersects, pairs.predicates, pairs.overlay_areas):
        f(shapes, shapes, i, j)


def layer(spark, shapes, first=0):
    rows = [(first + k, vector.write(g)) for k, g in enumerate(shapes)]
    return vector.with_envelope(spark.createDataFrame(rows, f"id long, geom {geo.GEOM}"))


@pytest.mark.parametrize("crowd", [3, 4096])
def test_blocks_lose_and_repeat_no_pair(spark, crowd):
    a, b = some_shapes(40), some_shapes(30, 6)
    left, right = layer(spark, a), layer(spark, b, 100)
    across = sorted((x, 100 + y) for x, g in enumerate(a) for y, h in enumerate(b) if kernel.intersects(g, h))
    own = sorted((x, y) for x, g in enumerate(a) for y, h in enumerate(a) if x < y and kernel.intersects(g, h))
    assert sorted(map(tuple, joins.block_pairs(left, right, 10, crowd=crowd).collect())) == across
    assert sorted(map(tuple, joins.block_pairs(left, None, 10, crowd=crowd).collect())) == own
    least = {x: min(y for z, y in across if z == x) for x, _ in across}
    assert {r["id"]: r["least"] for r in joins.least_met(left, right, 10, crowd=crowd).collect()} == least


@pytest.mark.parametrize("crowd", [3, 4096])
def test_links_hold_together_what_all_pairs_do(spark, crowd):
    """F8: fewer links than shapes in each block, the same groups."""
    shapes = some_shapes(60)
    frame = layer(spark, shapes).drop("geom")
    links = [tuple(r) for r in joins.links(frame, 200, 2, crowd=crowd).collect()]
    all_pairs = [tuple(r) for r in joins.proximity_pairs(frame, 2, 200, "id").collect()]

    def groups(edges):
        low = list(range(60))
        while True:
            new = list(low)
            for x, y in edges:
                new[x] = new[y] = min(new[x], new[y])
            if new == low:
                return low
            low = new

    assert groups(links) == groups(all_pairs)
    if crowd > 60:
        assert len(links) < 60 < len(all_pairs)


def test_groups_are_made_from_links(spark, monkeypatch):
    """F8: no table of all pairs is made for groups."""

    def called(*_):
        raise AssertionError("all pairs")

    monkeypatch.setattr(joins, "proximity_pairs", called)
    frame = layer(spark, some_shapes(60)).drop("geom")
    assert joins.group_near(frame, 40, 200, "id").select("group_id").distinct().count() == 1


def test_boxes_cut_as_the_kernel_cuts():
    """cutting by grid lines, in arrays; the same rings, in order."""
    shapes, r = some_shapes(140), random.Random(2)
    low = [(r.randrange(40), r.randrange(40)) for _ in shapes]
    box = [np.array(v, float) for v in zip(*((x, y, x + 12, y + 9) for x, y in low), strict=True)]
    cut = pairs.clip_to_boxes(pa.array([vector.write(g) for g in shapes], vector.GEOM), *box).to_pylist()
    for k, g in enumerate(shapes):
        assert vector.read(cut[k]) == kernel.clip_to_box(g, *(float(v[k]) for v in box))


@pytest.mark.parametrize("crowd", [3, 4096])
def test_centre_check_meets_no_table_of_pairs(spark, monkeypatch, crowd):
    """the least plan that joins points with slices row by row grows with the square of a crowded cell."""
    from pyspark.sql import functions as F

    from geoloom.functions.grid import GridSpec

    monkeypatch.setattr(joins, "CROWD", crowd)
    grid = GridSpec(0, 64, 8, -8, 8, 8)
    r = random.Random(3)
    points = spark.createDataFrame([(64 * r.random(), 64 * r.random()) for _ in range(300)], "x double, y double")
    points = points.select("x", "y", grid.cell_x("x").alias("rx"), grid.cell_y("y").alias("ry"))
    slices = vector.grid_slice(layer(spark, some_shapes(70)), grid, "id").localCheckpoint()
    found = sorted(map(tuple, vector.centre_check(points, slices, grid).collect()))
    # as it was: a join, then tests in Columns
    met = points.join(slices, ["rx", "ry"]).where(geo.contains_point("geom", "x", "y")).select("id", "rx", "ry").distinct()
    named = slices.join(met, ["id", "rx", "ry"]).where(~geo.contains_point("geom", grid.centre_x("rx"), grid.centre_y("ry"))).withColumn("c", geo.centroid("geom"))
    right = grid.left(F.col("rx") + 1) - F.col("c.x") < F.col("c.x") - grid.left("rx")
    top = grid.top("ry") - F.col("c.y") < F.col("c.y") - grid.top(F.col("ry") + 1)
    old = named.select("id", "rx", "ry", F.when(right & top, 0).when(right, 1).when(top, 3).otherwise(2).alias("corner"))
    assert found == sorted(map(tuple, old.collect())) and found
    plan = vector.centre_check(points, slices, grid)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join Inner" not in plan
