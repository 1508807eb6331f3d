"""Overlays of many geometries together."""

import random

from geoloom.functions import kernel


def rings(n, seed=4):
    r = random.Random(seed)
    out = []
    for k in range(n):
        ring = [(r.randrange(30), r.randrange(30)) if k % 2 else (r.random(), r.random()) for _ in range(r.randrange(3, 9))]
        out.append([[[*ring, ring[0]]]])
    return out


def test_repair_together_is_repair_one_by_one(monkeypatch):
    """one pass over the segments of all geometries; those of others don't count."""
    shapes = [*rings(200), [], [[[(0, 0), (1, 1)]]]]
    single = [kernel.make_valid(g) for g in shapes]
    calls = []
    node = kernel._node
    monkeypatch.setattr(kernel, "_node", lambda seg: calls.append(len(seg)) or node(seg))
    assert kernel.make_all_valid(shapes) == single
    assert len(calls) == 1
    for g in single:
        assert g == [] or kernel.is_valid(g)


def test_cut_places_are_those_of_each_geometry():
    bow = [[[(0, 0), (10, 10), (10, 0), (0, 10), (0, 0)]]]
    aside = [[[(4, 0), (14, 10), (14, 0), (4, 10), (4, 0)]]]
    both = kernel.make_all_valid([bow, aside, bow])
    assert both[0] == both[2] == [[[(0, 0), (5, 5), (0, 10), (0, 0)]], [[(5, 5), (10, 0), (10, 10), (5, 5)]]]
    assert kernel.area(both[1]) == 50


def test_repair_runs_once_for_each_row(spark):
    """the filter on what is left of a shape repeated its repair."""
    from geoloom.functions import columns as geo
    from geoloom.operators import vector

    frame = spark.createDataFrame([(k, vector.write(g)) for k, g in enumerate(rings(4))], f"fid long, geom {geo.GEOM}")
    plan = vector.fix_geom(frame).select("fid", geo.area("geom").alias("area"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython [") == 1


def test_union_of_hundreds_leaves_out_what_is_held(monkeypatch):
    """deep heaps of shapes; most lie inside others' union and need no cut."""
    r = random.Random(8)
    boxes = []
    for _ in range(400):
        x, y, w, h = r.randrange(300), r.randrange(300), r.randrange(20, 90), r.randrange(20, 90)
        boxes.append([[[(x, y), (x + w, y), (x + w, y + h), (x, y + h), (x, y)]]])
    cut = []
    many = kernel.overlays
    monkeypatch.setattr(kernel, "overlays", lambda inputs, *a, **k: cut.append(sum(len(g) for i in inputs for g in i)) or many(inputs, *a, **k))
    whole = kernel.union(boxes)
    cells = {(x, y) for (((ax, ay), _, (bx, by), *_),), in boxes for x in range(ax, bx) for y in range(ay, by)}
    assert kernel.area(whole) == len(cells)
    assert sum(cut) < 3 * len(boxes)
