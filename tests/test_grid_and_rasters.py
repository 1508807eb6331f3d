import math

import numpy as np
import pytest

from geoloom.functions.grid import GridSpec, index_width, is_nodata, spans
from geoloom.operators import raster

G0 = GridSpec(6.021557, 46.242485, 0.004, -0.005, 3, 3)
ND = None


def cells(spark, rows):
    data = [(x, y, float(v)) for y, r in enumerate(rows) for x, v in enumerate(r) if v is not ND]
    return spark.createDataFrame(data, "rx long, ry long, v double")


def table(df):
    return {(r["rx"], r["ry"]): r["v"] for r in df.collect()}


def test_zonal(spark):
    data = cells(spark, [[1, ND, 3], [4, 5, 6], [7, ND, 9.5]])
    zones = cells(spark, [[1, 1, ND], [1, 1, 2], [ND, ND, 2]]).withColumnRenamed("v", "id")
    got = {r["id"]: (r["square_count"], r["square_sum"]) for r in raster.zonal_stats(zones, data).collect()}
    assert got == {1: (3, 10.0), 2: (2, 15.5)}


def test_map_algebra(spark):
    left, right = cells(spark, [[1, ND], [3, 4]]), cells(spark, [[-2, -2], [ND, 5]])
    assert table(raster.ratio(left, right)) == {(0, 0): -0.5, (1, 1): 0.8}
    a = cells(spark, [[1, ND], [3, 0], [ND, ND]])
    b = cells(spark, [[-7, -2], [ND, 5], [1e-7, ND]])
    assert table(raster.diff(a, b)) == {(0, 0): 8, (1, 0): 2, (0, 1): 3, (1, 1): -5}
    c = cells(spark, [[-1, -2, -3], [-4, -5, ND], [-7, ND, -50]])
    d = cells(spark, [[10, 11, 12], [13, 14, 15], [ND, ND, 200]])
    got = table(raster.add(c, d))
    assert (got[0, 0], got[2, 1], got[0, 2], got.get((1, 2)), got[2, 2]) == (9, 15, -7, None, 150)
    assert table(raster.keep_where_data(a, b)) == {(0, 0): 1, (1, 1): 0} and table(raster.keep_where_no_data(a, b)) == {(0, 1): 3}


def test_cells_and_common_windows():
    g = GridSpec(4, 5, 1, -2, 5, 4)
    assert [g.cell(x, 5)[0] for x in (4.0, 4.999, 5.0)] == [0, 0, 1] and [g.nearest_edge(x) for x in (4.0, 4.999, 5.0)] == [0, 1, 1]
    assert g.common(GridSpec(5, 9, 1, -2, 10, 3)) == ((1, 0), (0, 2), (4, 1))
    p = 0.000277777777778
    big = GridSpec(-31.266805555555553, 39.709861111111117, p, -p, 341152, 268347)
    small = GridSpec(16.626250000000002, -22.500138888888891, p, -p, 58590, 44391)
    assert big.common(small) == ((172415, 0), (223956, 0), (58590, 44391))
    a, b = GridSpec(-13.261527777777777, 35.324305555555554, p, -p, 1, 1), GridSpec(34.908472222222223, 5.457361111111111, p, -p, 1, 1)
    assert a.aligned_with(b) and not a.aligned_with(GridSpec(b.origin_x, b.origin_y + p * 0.05, p, -p, 1, 1))
    assert GridSpec(-0.147916651080003, 11.138750156820009, 0.00083333333, -0.00083333333, 2350, 6036).chunk_of(1.3953136, 6.6087473, 10, 10) == 97


def test_windows_spans_and_widths():
    assert list(GridSpec(0, 0, 1, -1, 5, 5).windows(2)) == [((0, 0), (3, 3)), ((3, 0), (2, 3)), ((0, 3), (3, 2)), ((3, 3), (2, 2))]
    many = list(GridSpec(0, 0, 1, -1, 112, 103).windows(10))
    assert len(many) == 100 and many[0][1] == (12, 11)
    assert spans(0, 10, 4) == [(0, 2), (3, 5), (6, 8), (9, 10)] and spans(4, 4, 1) == [(4, 4)]
    assert [index_width(n) for n in (1, 10, 11, 100, 101, 1000)] == [1, 1, 2, 2, 3, 3]


def test_nodata(spark):
    low = -3.4028234663852886e38
    values = [low, low + 1e4, math.nan, math.inf, low + 1e34, 1.0, None]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    assert [r[0] for r in df.select(is_nodata("v", low)).collect()] == [True, True, True, True, False, False, True]
    assert [r[0] for r in df.select(is_nodata("v", math.nan)).collect()] == [False, False, True, True, False, False, True]


def test_contours_of_flat_and_framed_fields(spark):
    grid = GridSpec(0, 0, 1, -1, 6, 6)
    flat = cells(spark, [[1] * 6] * 6)
    assert raster.contour_segments(flat, grid, 2).count() == 0 and raster.contour_segments(flat.limit(0), grid, 2).count() == 0
    framed = cells(spark, [[3 if x in (0, 5) or y in (0, 5) else 0 for x in range(6)] for y in range(6)])
    from geoloom.operators import vector

    rings = vector.contour_rings(framed, grid, 2).collect()
    assert len(rings) == 1 and rings[0]["is_hole"]


@pytest.mark.parametrize(("dx", "dy", "fx", "fy"), [(0.003, -0.002, 1, 1), (-0.003, 0.002, 1, 1), (0, 0, 5, 7), (0.001, 0, 0.5, 0.4)])
def test_resampling_keeps_mass_and_equals_overlaps(spark, dx, dy, fx, fy):
    data = {(x, y): float(1 + x + 3 * y) for x in range(3) for y in range(3) if (x, y) != (1, 1)}
    target = GridSpec(G0.origin_x + dx - 0.02, G0.origin_y + dy + 0.025, 0.004 * fx, -0.005 * fy, 60, 60)
    got = table(raster.resample(spark.createDataFrame([(x, y, v) for (x, y), v in data.items()], "rx long, ry long, v double"), G0, target))
    want = {}
    for (x, y), v in data.items():
        a, b = G0.origin_x + x * 0.004, G0.origin_y - y * 0.005
        for tx in range(60):
            for ty in range(60):
                c, d = target.origin_x + tx * 0.004 * fx, target.origin_y - ty * 0.005 * fy
                w, h = min(a + 0.004, c + 0.004 * fx) - max(a, c), min(b, d) - max(b - 0.005, d - 0.005 * fy)
                if w > 0 and h > 0 and (share := w * h / 2e-5) >= 1e-6:
                    want[tx, ty] = want.get((tx, ty), 0) + v * share
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 1e-9 for k in got)
    assert sum(got.values()) == pytest.approx(sum(data.values()))


def test_flood_fill_links_all_runs_that_touch(spark):
    rng = np.random.default_rng(8)
    set_cells = [(int(x), int(y)) for y in range(12) for x in range(12) if rng.random() < 0.45]
    grid = GridSpec(0, 0, 1, -1, 12, 12)
    gaps = raster.row_gaps(spark.createDataFrame(set_cells, "rx long, ry long"), grid)
    runs = [(g["run"], g["ry"], g["x0"], g["x1"]) for g in gaps.collect()]
    want = {(a[0], b[0]) for a in runs for b in runs if b[1] == a[1] + 1 and b[2] <= a[3] + 1 and a[2] <= b[3] + 1}
    assert {(min(r), max(r)) for r in raster._touching(gaps).collect()} == want
