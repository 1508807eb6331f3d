"""Steps that turn footprints into classified settlements."""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions.grid import GridSpec
from geoloom.functions.kernel import geodesic_distance
from geoloom.operators import joins

CELL = ["rx", "ry"]


def classify(zones: DataFrame, zonal: DataFrame, large: int = 3000, small: int = 50) -> DataFrame:
    """Zones with bldg_count (null where no cell of theirs has data) and level: 2 over ``large``, 1 over ``small``, else 0."""
    counted = zones.join(zonal.select("id", F.col("square_sum").cast("long").alias("bldg_count")), "id", "left")
    return counted.withColumn("level", F.when(F.col("bldg_count") > large, 2).when(F.col("bldg_count") > small, 1).otherwise(0))


def count_check(settlements: DataFrame, buildings: DataFrame) -> DataFrame:
    """One row: buildings that settlements count, and all."""
    total = buildings.agg(F.count("*").alias("buildings"))
    return settlements.agg(F.coalesce(F.sum("bldg_count"), F.lit(0)).alias("settled")).join(total)  # one row each


def promote(zones: DataFrame, contours: DataFrame, least_area: float, size: float, meets=None, within=None) -> DataFrame:
    """(id, cur_level, new_level): level 2 for zones that meet a contour of at least an area and lie in no hole.

    meets() and within() are the exact tests on l_ (zone) and r_ (contour) columns; without them envelopes decide.
    """
    inside = (F.col("r_minx") <= F.col("l_minx")) & (F.col("r_maxx") >= F.col("l_maxx")) & (F.col("r_miny") <= F.col("l_miny")) & (F.col("r_maxy") >= F.col("l_maxy"))
    shell = contours.where((~F.col("is_hole")) & (F.col("area") >= least_area))
    up = joins.anti(joins.semi(zones, shell, size, exact=meets), contours.where("is_hole"), size, exact=within or (lambda: inside))
    marked = zones.join(up.select("id", F.lit(2).alias("up")), "id", "left")
    return marked.select("id", F.col("level").alias("cur_level"), F.coalesce("up", "level").alias("new_level"))


def to_single(features: DataFrame) -> DataFrame:
    """One row for each polygon of geom; the other columns are repeated."""
    rest = [c for c in features.columns if c != "geom"]
    return features.select(*rest, F.explode("geom").alias("p")).select(*rest, F.array("p").alias("geom"))


def merge_layers(layers: dict[str, DataFrame], skip: tuple[str, ...] = ()) -> DataFrame:
    """All layers by column name, with source_merge; a column of two types is an error."""
    kinds: dict[str, tuple[str, str]] = {}
    for name, df in layers.items():
        for column, kind in df.dtypes:
            first = kinds.setdefault(column, (kind, name))
            if first[0] != kind:
                raise ValueError(f"column {column} is {first[0]} in {first[1]} and {kind} in {name}")
    tagged = [df.drop(*skip).withColumn("source_merge", F.lit(name)) for name, df in layers.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)


def outside_of(shapes: DataFrame, inner: DataFrame, grid: GridSpec, id_col: str = "id") -> DataFrame:
    """Shapes not all of whose four envelope corners lie in cells of ``inner``."""
    x, y = (grid.cell_x("minx"), grid.cell_x("maxx")), (grid.cell_y("miny"), grid.cell_y("maxy"))
    corners = F.array(*[F.struct(a.alias("rx"), b.alias("ry")) for a in x for b in y])
    held = shapes.select(id_col, F.explode(corners).alias("c")).select(id_col, "c.rx", "c.ry").join(inner.select(*CELL), CELL)
    return shapes.join(held.groupBy(id_col).agg(F.count("*").alias("n")).where("n = 4"), id_col, "left_anti")


def slice_boxes(boxes: DataFrame, grid: GridSpec) -> DataFrame:
    """Boxes cut by all grid lines: (id, rx, ry, envelope of the piece); pieces without area are left out."""
    x0, x1, y0, y1 = grid.cell_x("minx"), grid.cell_x("maxx"), grid.cell_y("maxy"), grid.cell_y("miny")
    cut = boxes.select("id", "minx", "miny", "maxx", "maxy", F.explode(F.sequence(x0, x1)).alias("rx"), y0.alias("y0"), y1.alias("y1")).withColumn("ry", F.explode(F.sequence("y0", "y1")))
    clipped = cut.select(
        "id", *CELL, F.greatest("minx", grid.left("rx")).alias("minx"), F.greatest("miny", grid.top(F.col("ry") + 1)).alias("miny"),
        F.least("maxx", grid.left(F.col("rx") + 1)).alias("maxx"), F.least("maxy", grid.top("ry")).alias("maxy"),
    )
    return clipped.where("minx < maxx and miny < maxy")


def point_in_slice(points: DataFrame, slices: DataFrame) -> DataFrame:
    """(fid, id): the slice, least id first, of the point's own cell that holds the point (fid, x, y, rx, ry)."""
    s = slices.select("id", *CELL, *[F.col(c).alias("s_" + c) for c in joins.ENVELOPE])
    met = points.join(s, CELL).where("x between s_minx and s_maxx and y between s_miny and s_maxy")
    return met.groupBy("fid").agg(F.min("id").alias("id"))


def assign(buildings: DataFrame, slices: DataFrame, size: float, exact=None) -> DataFrame:
    """(fid, set_orig_fid): the least settlement that a building meets, null for none."""
    met = joins.spatial_join(buildings.select("fid", *joins.ENVELOPE), slices.select("id", *joins.ENVELOPE), size, exact=exact)
    met = met.groupBy(F.col("l_fid").alias("fid")).agg(F.min("r_id").alias("set_orig_fid"))
    return buildings.select("fid").join(met, "fid", "left")


def centre_check(points: DataFrame, slices: DataFrame, grid: GridSpec) -> DataFrame:
    """(id, rx, ry, corner) for slices that hold a building but not their cell's centre.

    corner is the cell's corner nearest to the slice's centroid: 0 NE, 1 SE, 2 SW, 3 NW; ties go left and down.
    """
    held = points.join(point_in_slice(points, slices), "fid").select("id", *CELL).distinct()
    s = slices.join(held, ["id", *CELL])
    cx, cy = grid.centre_x("rx"), grid.centre_y("ry")
    off = ~((F.col("minx") <= cx) & (cx <= F.col("maxx")) & (F.col("miny") <= cy) & (cy <= F.col("maxy")))
    mx, my = (F.col("minx") + F.col("maxx")) / 2, (F.col("miny") + F.col("maxy")) / 2
    right = grid.left(F.col("rx") + 1) - mx < mx - grid.left("rx")
    top = grid.top("ry") - my < my - grid.top(F.col("ry") + 1)
    corner = F.when(right & top, 0).when(right, 1).when(top, 3).otherwise(2)
    return s.where(off).select("id", *CELL, corner.alias("corner"))


def centre_records(checked: DataFrame, settlements: DataFrame, grid: GridSpec) -> DataFrame:
    """What centre_check found as records: settlement_fid, settlement_level, raster_x, raster_y, long and lat of the centre, grid_index (row by row), corner.

    settlements: id, level. An id without a level keeps a null.
    """
    placed = checked.join(settlements.select("id", "level"), "id", "left")
    return placed.select(
        F.col("id").alias("settlement_fid"), F.col("level").alias("settlement_level"), F.col("rx").alias("raster_x"), F.col("ry").alias("raster_y"),
        grid.centre_x("rx").alias("long"), grid.centre_y("ry").alias("lat"), (F.col("ry") * grid.cols + F.col("rx")).alias("grid_index"), "corner",
    )


def corner_shape(grid: GridSpec, radius: float = 0.8, quad_segs: int = 4) -> Column:
    """The quarter disc at a cell's corner that points into the cell: it covers the centre of any square cell."""
    first_angle = {0: 180, 1: 90, 2: 0, 3: 270}
    out = None
    for corner, start in first_angle.items():
        x = grid.left(F.col("rx") + (1 if corner < 2 else 0))
        y = grid.top(F.col("ry") + (1 if corner in (1, 2) else 0))
        arc = [math.radians(start + 90 * k / quad_segs) for k in range(quad_segs + 1)]
        r = radius * grid.pixel_width
        ring = F.array(geo.point(x, y), *[geo.point(x + r * math.cos(a), y + r * math.sin(a)) for a in arc], geo.point(x, y))
        shape = F.array(F.array(ring))
        out = F.when(F.col("corner") == corner, shape) if out is None else out.when(F.col("corner") == corner, shape)
    return out


def projection_accuracy(spark, minx: float, miny: float, maxx: float, maxy: float, n: int = 12) -> DataFrame:
    """(box, projection, mean_error): mean difference between plane and geodesic distance over all pairs of an n x n lattice.

    Box 0 is the whole extent, 1 to 5 are small boxes at its corners and centre. n is a parameter, so the
    pairs are bounded.
    """
    w, h = maxx - minx, maxy - miny
    boxes = [(minx, miny, w, h), *[(minx + fx * w * 0.9, miny + fy * h * 0.9, w / 10, h / 10) for fx, fy in ((0, 0), (1, 0), (0.5, 0.5), (0, 1), (1, 1))]]
    rows = [(b, k, x + bw * (k % n) / (n - 1), y + bh * (k // n) / (n - 1)) for b, (x, y, bw, bh) in enumerate(boxes) for k in range(n * n)]
    p = spark.createDataFrame(rows, "box int, k int, lon double, lat double")
    cx, cy = minx + w / 2, miny + h / 2
    zone = F.lit(math.ceil((cx + 180) / 6) * 6.0 - 183.0)
    kinds = {"utm": geo.transverse_mercator("lon", "lat", zone), "tm": geo.transverse_mercator("lon", "lat", F.lit(cx), 1.0, 0.0), "laea": geo.laea("lon", "lat", cx, cy), "mercator": geo.web_mercator("lon", "lat")}
    p = p.select("*", F.create_map(*[v for name, (x, y) in kinds.items() for v in (F.lit(name), F.struct(x.alias("x"), y.alias("y")))]).alias("at"))

    @F.arrow_udf("double")
    def geodesic(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return pa.array([geodesic_distance(*q) for q in zip(*(v.to_pylist() for v in (a, b, c, d)), strict=True)])

    l, r = p.alias("l"), p.alias("r")
    pairs = l.join(r, (F.col("l.box") == F.col("r.box")) & (F.col("l.k") < F.col("r.k"))).select(F.col("l.box").alias("box"), F.col("l.at").alias("s"), F.col("r.at").alias("t"), geodesic("l.lon", "l.lat", "r.lon", "r.lat").alias("true"))
    each = pairs.select("box", "true", "t", F.explode("s").alias("projection", "u")).withColumn("v", F.col("t")[F.col("projection")])
    plane = F.sqrt(F.pow(F.col("u.x") - F.col("v.x"), 2) + F.pow(F.col("u.y") - F.col("v.y"), 2))
    return each.groupBy("box", "projection").agg(F.round(F.avg(F.abs(plane - F.col("true"))), 3).alias("mean_error"))
