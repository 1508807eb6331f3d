"""Operators on polygon layers: repair, reproject, buffer, dissolve, slice, rasterise, contour rings.

Layers are frames with a key, a column geom (see functions.columns) and any attributes. The kernels run in
Arrow batches; what has a closed form stays in Columns.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions import kernel, pairs
from geoloom.functions.grid import GridSpec
from geoloom.operators import joins, raster
from geoloom.operators.graph import connected_components
from geoloom.plans.batches import by_block, by_group, width
from geoloom.plans.materialize import materialize

GEOM = pairs.GEOM


def read(geom: list | None) -> kernel.Geometry:
    return [[[(q["x"], q["y"]) for q in r] for r in p] for p in geom or []]


def write(geom: kernel.Geometry) -> list:
    return [[[{"x": float(x), "y": float(y)} for x, y in r] for r in p] for p in geom]


def geometry_udf(f: Callable[[kernel.Geometry], kernel.Geometry]):
    """A Column function from a kernel on geometries; null stays null."""

    @F.arrow_udf(geo.GEOM)
    def run(geoms: pa.Array) -> pa.Array:
        return pa.array([None if g is None else write(f(read(g))) for g in geoms.to_pylist()], GEOM)

    return run


def predicate_udf(f: Callable[[kernel.Geometry, kernel.Geometry], bool]):
    @F.arrow_udf("boolean")
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else f(read(x), read(y)) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], pa.bool_())

    return run




def overlay_udf(f: Callable[[kernel.Geometry, kernel.Geometry], kernel.Geometry]):
    @F.arrow_udf(geo.GEOM)
    def run(a: pa.Array, b: pa.Array) -> pa.Array:
        return pa.array([None if x is None or y is None else write(f(read(x), read(y))) for x, y in zip(a.to_pylist(), b.to_pylist(), strict=True)], GEOM)

    return run


# each is made when it is used: workers import this module without a session
def make_valid(geom: Column | str) -> Column:
    @F.arrow_udf(geo.GEOM)
    def run(geoms: pa.Array) -> pa.Array:
        out = geoms.to_pylist()
        at = [k for k, g in enumerate(out) if g is not None]
        for k in range(0, len(at), 2_000):
            some = at[k : k + 2_000]
            for place, g in zip(some, kernel.make_all_valid([read(out[q]) for q in some]), strict=True):
                out[place] = write(g)
        return pa.array(out, GEOM)

    # else a filter on the result, as in fix_geom, would be pushed below it with a second call
    return run.asNondeterministic()(geom)


def tidy(geom: Column | str) -> Column:
    """Each geometry as kernel.union gives it by itself."""

    @F.arrow_udf(geo.GEOM)
    def run(geoms: pa.Array) -> pa.Array:
        out = [read(g) for g in geoms.to_pylist()]
        for k in range(0, len(out), 2_000):
            out[k : k + 2_000] = kernel.overlays([[g] for g in out[k : k + 2_000]], lambda w: w[:, 0] > 0)
        return pa.array([write(g) for g in out], GEOM)

    return run.asNondeterministic()(geom)


def intersects(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.intersects)(a, b)


def contains(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.contains)(a, b)


def within(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.within)(a, b)


def covers(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.covers)(a, b)


def covered_by(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.within)(a, b)


def contains_properly(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.contains_properly)(a, b)


def touches(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.touches)(a, b)


def overlaps(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.overlaps)(a, b)


def crosses(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.crosses)(a, b)


def largest_polygon(geom: Column | str) -> Column:
    """The polygon of most area, the first of equal ones, as a geometry of its own; null for none."""
    polys = F.col(geom) if isinstance(geom, str) else geom
    best = F.reduce(
        F.transform(polys, lambda p: F.struct(geo.area(F.array(p)).alias("a"), p.alias("p"))), F.lit(None).cast(f"struct<a:double,p:{geo.GEOM[6:-1]}>"),
        lambda done, x: F.when(done.isNull() | (x["a"] > done["a"]), x).otherwise(done),
    )
    return F.when(best.isNotNull(), F.array(best["p"]))


def disjoint(a: Column | str, b: Column | str) -> Column:
    return predicate_udf(kernel.disjoint)(a, b)


def intersection(a: Column | str, b: Column | str) -> Column:
    return overlay_udf(kernel.intersection)(a, b)


def difference(a: Column | str, b: Column | str) -> Column:
    return overlay_udf(kernel.difference)(a, b)


def ellipsoid_area(geom: Column | str) -> Column:
    @F.arrow_udf("double")
    def run(geoms: pa.Array) -> pa.Array:
        return pa.array([None if g is None else kernel.ellipsoid_area(read(g)) for g in geoms.to_pylist()], pa.float64())

    return run(geom)


def with_envelope(layer: DataFrame) -> DataFrame:
    names = ("minx", "miny", "maxx", "maxy")
    return layer.drop(*names).select("*", *geo.envelope("geom"))


def fix_geom(layer: DataFrame, key: str = "fid") -> DataFrame:
    """Valid geometries, attributes as they are, orig_fid as the key; what has no area left is dropped.

    Rows are dealt out first: a small file is one or two tasks otherwise, and repair costs far more than reading.
    """
    fixed = layer.drop("orig_fid").repartition(width(layer.sparkSession)).withColumn("geom", make_valid("geom")).withColumn("orig_fid", F.col(key))
    return fixed.where(F.size("geom") > 0)


def transform(geom: Column | str, f: Callable[[Column, Column], tuple[Column, Column]]) -> Column:
    """Each vertex through a projection of Columns."""
    g = F.col(geom) if isinstance(geom, str) else geom
    return F.transform(g, lambda p: F.transform(p, lambda r: F.transform(r, lambda q: geo.point(*f(q["x"], q["y"])))))


def fix_reproject_split(layer: DataFrame, grid: GridSpec, chunk_cols: int, chunk_rows: int, projection=None, by_centroid: bool = False) -> DataFrame:
    """Repaired, reprojected, numbered by chunk; what can't be repaired, projected or placed is dropped."""
    out = fix_geom(layer)
    if projection:
        out = out.withColumn("geom", transform("geom", projection))
        bad = F.exists(geo.vertices("geom"), lambda q: q["x"].isNull() | q["y"].isNull() | F.isnan(q["x"]) | F.isnan(q["y"]) | (F.abs(q["x"]) == float("inf")) | (F.abs(q["y"]) == float("inf")))
        out = out.where(~bad)
    out = with_envelope(out)
    at = geo.centroid("geom") if by_centroid else F.struct(((F.col("minx") + F.col("maxx")) / 2).alias("x"), ((F.col("miny") + F.col("maxy")) / 2).alias("y"))
    out = out.withColumn("__at", at)
    return out.withColumn("chunk", grid.chunk(F.col("__at.x"), F.col("__at.y"), chunk_cols, chunk_rows)).drop("__at").where("chunk is not null")


def buffer_metres(layer: DataFrame, metres: float, quad_segs: int = 2) -> DataFrame:
    return layer.withColumn("geom", geometry_udf(lambda g: kernel.buffer_metres(g, metres, quad_segs))("geom"))


def simplify(layer: DataFrame, tolerance: float) -> DataFrame:
    def f(g: kernel.Geometry) -> kernel.Geometry:
        cut = [[kernel.simplify(r, tolerance) for r in p] for p in g]
        return [[r for r in p if len(r) > 3] for p in cut if len(p[0]) > 3]

    return layer.withColumn("geom", geometry_udf(f)("geom"))


def _unite(layer: DataFrame, keys: list[str], strip: bool) -> DataFrame:
    def f(key: tuple, rows: pa.Table) -> list[tuple]:
        geoms = [read(g) for g in rows["geom"].to_pylist()]
        if strip:
            geoms = [kernel.remove_holes(x) for x in geoms]
        g = geoms[0] if len(geoms) == 1 and len(geoms[0]) == 1 else kernel.union(geoms)
        return [(*key, write(kernel.remove_holes(g) if strip else g), sum(rows["n"].to_pylist()))]

    kinds = dict(layer.dtypes)
    return by_group(layer.select(*keys, "geom", "n"), keys, f, ", ".join(f"{k} {kinds[k]}" for k in keys) + f", geom {geo.GEOM}, n long")


def dissolve(layer: DataFrame, size: float, no_holes: bool = False, levels: int = 3) -> DataFrame:
    """(orig_fid, geom, n): shapes that meet become one; n counts them. orig_fid numbers results from 1 by envelope.

    Shapes of a component are first united within buckets of side ``size``, then of 8 and 64 times that, so no
    task unites a large component from its single shapes. With no_holes, holes are filled and what
    lies in them is united too, until nothing meets any more.
    """
    work = layer.select(F.monotonically_increasing_id().alias("id"), "geom", F.lit(1).cast("long").alias("n"))
    first = True
    while True:
        work = materialize(with_envelope(work))
        met = joins.links(work.select("id", "geom", *joins.ENVELOPE), size, exact=pairs.intersects).toDF("src", "dst")
        met = materialize(met)
        if met.isEmpty() and not first:
            break
        component = connected_components(met, finish=200_000)
        work = work.join(component, F.col("id") == F.col("node"), "left").withColumn("c", F.coalesce("component", "id")).drop("node", "component")
        for level in range(levels):
            side = size * 8**level
            placed = work.withColumns({"bx": F.floor(F.col("minx") / side).cast("long"), "by": F.floor(F.col("miny") / side).cast("long")})
            work = with_envelope(_unite(placed, ["c", "bx", "by"], no_holes).drop("bx", "by"))
        work = _unite(work, ["c"], no_holes).withColumnRenamed("c", "id")
        first = False
        if not no_holes:
            work = materialize(with_envelope(work))
            break
    return numbered(work, "orig_fid").select("orig_fid", "geom", "n")


def numbered(layer: DataFrame, name: str) -> DataFrame:
    """Dense numbers from 1 in the order of envelopes: counts of ranges of minx, then numbers within a range."""
    from pyspark.sql import Window

    span = layer.agg(F.min("minx").alias("a"), F.max("minx").alias("b"), F.count("*").alias("n")).first()
    if not span["n"]:
        return layer.withColumn(name, F.lit(0).cast("long"))
    ranges = 1 + span["n"] // 50_000
    width = (span["b"] - span["a"]) / ranges or 1.0
    cut = layer.withColumn("__r", F.least(F.floor((F.col("minx") - span["a"]) / width), F.lit(ranges - 1)).cast("int"))
    sizes = {r["__r"]: r["n"] for r in cut.groupBy("__r").agg(F.count("*").alias("n")).collect()}
    before, total = F.lit(0), 0
    for r in sorted(sizes):
        before = F.when(F.col("__r") == r, total).otherwise(before)
        total += sizes[r]
    own = F.row_number().over(Window.partitionBy("__r").orderBy("minx", "miny", "maxx", "maxy"))
    return cut.withColumn(name, (own + before).cast("long")).drop("__r")


def group_members(layer: DataFrame, within: float, size: float, key: str = "fid") -> DataFrame:
    """(id, geom): each shape with the group of those that hang together by proximity."""
    named = with_envelope(layer)
    of = joins.group_near(named, within, size, key).withColumnRenamed("id", "__id")
    return named.join(of, F.col(key) == F.col("__id")).select(F.col("group_id").alias("id"), "geom")


def group_polygons(layer: DataFrame, within: float, size: float, key: str = "fid") -> DataFrame:
    """(id, geom, poly_count): shapes that hang together by proximity, as multipolygons."""
    both = group_members(layer, within, size, key)
    return both.groupBy("id").agg(F.flatten(F.collect_list("geom")).alias("geom"), F.sum(F.size("geom")).alias("poly_count"))


def _united(layer: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, geom, n): the polygons of the union of each key's shapes, n of which are in it; a lone polygon stays as it is."""

    def f(key: tuple, rows: pa.Table) -> Iterator[list]:
        geoms = [read(g) for g in rows.column("geom").to_pylist()]
        whole = geoms[0] if len(geoms) == 1 and len(geoms[0]) == 1 else kernel.union(geoms)
        yield [*([k] * len(whole) for k in key), [write([p]) for p in whole], [sum(rows.column("n").to_pylist())] * len(whole)]

    return by_block(layer.select(*keys, "geom", "n"), keys, f, ", ".join(f"{k} long" for k in keys) + f", geom {geo.GEOM}, n long")


def fill_centres(members: DataFrame, grid: GridSpec, size: float, levels: int = 2) -> DataFrame:
    """(id, geom, poly_count): kernel.fill_centre of groups given as members (id, geom); poly_count is that of the members.

    No group is put together before its inner buildings are gone: those left are united in buckets of side
    ``size``, what meets across buckets in ones 8 and 64 times as large, and then with the inner cells.
    """
    polys = members.select("id", F.explode_outer("geom").alias("p")).select("id", F.when(F.col("p").isNotNull(), F.array("p")).alias("geom"))
    polys = materialize(with_envelope(polys))
    shell = F.get(F.get("geom", F.lit(0)), F.lit(0))
    cell = F.transform(shell, lambda q: F.struct(grid.cell_x(q["x"]).alias("rx"), grid.cell_y(q["y"]).alias("ry")))
    occupied = polys.select("id", F.explode(F.array_distinct(cell)).alias("c")).select("id", "c.rx", "c.ry").distinct()

    def run(key: tuple, rows: pa.Table) -> Iterator[list]:
        rx, ry = kernel.inner_cells(rows.column("rx").to_numpy(), rows.column("ry").to_numpy())
        if len(rx):
            yield [np.full(len(rx), key[0]), rx, ry]

    inner = materialize(by_block(occupied, ["id"], run, "id long, rx long, ry long"))
    filled = inner.select("id").distinct()

    # a building goes whose envelope corners are all in inner cells
    at = {"ax": grid.cell_x("minx"), "ay": grid.cell_y("miny"), "bx": grid.cell_x("maxx"), "by": grid.cell_y("maxy")}
    placed = polys.join(filled, "id", "left_semi").where("minx is not null").withColumns(at)
    corners = F.array(*[F.struct(F.col(x).alias("rx"), F.col(y).alias("ry")) for x in ("ax", "bx") for y in ("ay", "by")])
    places = placed.select("id", *at).distinct().withColumn("c", F.explode(F.array_distinct(corners))).select("id", *at, "c.rx", "c.ry")
    held = places.join(inner.withColumn("held", F.lit(1)), ["id", "rx", "ry"], "left").groupBy("id", *at).agg(F.count("*").alias("corners"), F.count("held").alias("held"))
    kept = placed.join(held.where("corners = held").select("id", *at), ["id", *at], "left_anti").withColumn("n", F.lit(1).cast("long"))

    def bucketed(shapes: DataFrame, side: float) -> DataFrame:
        return shapes.withColumns({"bx": F.floor(F.col("minx") / side).cast("long"), "by": F.floor(F.col("miny") / side).cast("long")})

    pieces = with_envelope(_united(bucketed(kept.drop(*at), size), ["id", "bx", "by"]).drop("bx", "by"))
    pieces = materialize(pieces.withColumn("piece", F.monotonically_increasing_id()))
    met = joins.links(pieces.select(F.col("piece").alias("id"), "geom", *joins.ENVELOPE), size, exact=pairs.intersects)
    component = connected_components(met, "a", "b", finish=200_000)
    pieces = materialize(pieces.join(component, F.col("piece") == F.col("node"), "left").withColumn("c", F.coalesce("component", "piece")).drop("node"))
    # what meets an inner cell, in its border too, is united with all inner cells of the group: as component -1
    u = lambda x: (F.col(x) - grid.origin_x) / grid.pixel_width
    v = lambda y: (F.col(y) - grid.origin_y) / grid.pixel_height
    span = lambda a, b: F.explode(F.sequence((F.ceil(F.least(a, b)) - 1).cast("long"), F.floor(F.greatest(a, b)).cast("long")))
    near = pieces.select("id", "c", span(u("minx"), u("maxx")).alias("rx"), v("miny").alias("v0"), v("maxy").alias("v1")).select("id", "c", "rx", span(F.col("v0"), F.col("v1")).alias("ry"))
    core = near.distinct().join(inner, ["id", "rx", "ry"], "left_semi").select("c").distinct().withColumn("core", F.lit(-1).cast("long"))
    pieces = materialize(pieces.join(core, "c", "left"))
    met, alone = F.coalesce("core", "component").isNotNull(), pieces.where("core is null and component is null")
    alone = alone.where("n > 1").select("id", "geom").union(alone.where("n = 1").select("id", tidy("geom").alias("geom")))
    work = pieces.where(met).withColumn("c", F.coalesce("core", "c"))
    for level in range(1, levels + 1):
        work = with_envelope(_united(bucketed(work, size * 8**level), ["id", "c", "bx", "by"]).drop("bx", "by"))
    none = lambda kind: F.lit(None).cast(kind)
    work = work.select("id", "c", "geom", "n", none("long").alias("rx"), none("long").alias("ry"))
    cells = inner.select("id", F.lit(-1).cast("long").alias("c"), none(geo.GEOM).alias("geom"), F.lit(0).cast("long").alias("n"), "rx", "ry")

    def whole(key: tuple, rows: pa.Table) -> Iterator[list]:
        is_cell = rows.column("geom").is_null().to_numpy()
        of = rows.filter(pa.array(~is_cell))
        geoms = [read(g) for g in of.column("geom").to_pylist()]
        if is_cell.any():
            rx, ry = (rows.filter(pa.array(is_cell)).column(c).to_pylist() for c in ("rx", "ry"))
            geoms.append(kernel.cells_to_polygons(set(zip(rx, ry, strict=True)), grid))
        yield [[key[0]], [write(kernel.union(geoms))]]

    done = by_block(work.union(cells), ["id", "c"], whole, f"id long, geom {geo.GEOM}")
    rest = polys.join(filled, "id", "left_anti").select("id", "geom")
    gathered = done.union(alone).union(rest).groupBy("id").agg(F.flatten(F.collect_list("geom")).alias("geom"))
    counts = polys.groupBy("id").agg(F.count("geom").alias("poly_count"))
    return counts.join(gathered, "id", "left").select("id", F.coalesce("geom", F.array().cast(geo.GEOM)).alias("geom"), "poly_count")


def rasterize(layer: DataFrame, grid: GridSpec, key: str = "orig_fid", all_touched: bool = False) -> DataFrame:
    """(id, rx, ry) of the cells whose centre is inside; with all_touched, of all that share area with the shape."""
    kind = pa.list_(pa.struct([("rx", pa.int64()), ("ry", pa.int64())]))
    inside = kernel.touched if all_touched else kernel.scan

    @F.arrow_udf("array<struct<rx:long,ry:long>>")
    def cells(geoms: pa.Array) -> pa.Array:
        return pa.array([[{"rx": x, "ry": y} for x, y in inside(read(g), grid)] for g in geoms.to_pylist()], kind)

    return layer.select(F.col(key).alias("id"), F.explode(cells("geom")).alias("c")).select("id", "c.rx", "c.ry")


def burn_field(layer: DataFrame, grid: GridSpec, field: str, order: str = "fid", all_touched: bool = False) -> DataFrame:
    """(rx, ry, v): the field of the feature that covers a cell, of several the one last in ``order``; equal places go to the greatest value."""
    named = layer.select(F.struct(F.col(order).alias("at"), F.col(field).alias("v")).alias("of"), "geom")
    last = rasterize(named, grid, "of", all_touched).groupBy("rx", "ry").agg(F.max("id").alias("of"))
    return last.select("rx", "ry", "of.v")


def _cell_boxes(grid: GridSpec, rx: np.ndarray, ry: np.ndarray) -> tuple[np.ndarray, ...]:
    """Left, lower, right and upper sides of cells."""
    left, top = grid.origin_x + rx * grid.pixel_width, grid.origin_y + ry * grid.pixel_height
    return left, top + grid.pixel_height, left + grid.pixel_width, top


def grid_slice(layer: DataFrame, grid: GridSpec, key: str = "orig_fid") -> DataFrame:
    """(id, rx, ry, geom): the layer cut by all grid lines."""
    named = with_envelope(layer.select(F.col(key).alias("id"), "geom"))
    cut = named.select("id", "geom", F.explode(F.sequence(grid.cell_x("minx"), grid.cell_x("maxx"))).alias("rx"), grid.cell_y("maxy").alias("y0"), grid.cell_y("miny").alias("y1")).withColumn("ry", F.explode(F.sequence("y0", "y1")))

    @F.arrow_udf(geo.GEOM)
    def clip(geoms: pa.Array, xs: pa.Array, ys: pa.Array) -> pa.Array:
        return pairs.clip_to_boxes(geoms, *_cell_boxes(grid, xs.to_numpy(), ys.to_numpy()))

    return cut.select("id", "rx", "ry", clip.asNondeterministic()("geom", "rx", "ry").alias("geom")).where(F.size("geom") > 0)


def centre_check(points: DataFrame, slices: DataFrame, grid: GridSpec) -> DataFrame:
    """(id, rx, ry, corner) for polygon slices that hold a point (x, y, rx, ry) but not their cell's centre; see settle.centre_check."""
    none = F.lit(None).cast("double")
    both = slices.select("rx", "ry", "id", none.alias("x"), none.alias("y"), "geom").union(points.select("rx", "ry", F.lit(None).cast(slices.schema["id"].dataType), F.col("x").cast("double"), F.col("y").cast("double"), F.lit(None).cast(geo.GEOM)))

    # a crowded cell's slices are dealt into blocks, each with all points of the cell
    full = slices.groupBy("rx", "ry").agg(F.ceil(F.count("*") / joins.CROWD).cast("int").alias("parts")).where("parts > 1")
    dealt = both.where("rx is not null and ry is not null").join(full, ["rx", "ry"], "left")
    parts = F.coalesce("parts", F.lit(1))
    each = F.sequence(F.lit(0), parts - 1)
    dealt = dealt.withColumn("part", F.explode(F.when(F.col("geom").isNull(), each).otherwise(F.array(F.pmod(F.xxhash64("id"), parts).cast("int"))))).drop("parts")

    def run(key: tuple, rows: pa.Table):
        is_point = rows.column("geom").is_null().to_numpy()
        px, py = (rows.column(c).to_numpy(zero_copy_only=False)[is_point] for c in ("x", "y"))
        of = rows.filter(pa.array(~is_point))
        if not len(px) or not of.num_rows:
            return
        shapes = pairs.Outlines(of.column("geom"))
        rx, ry = np.full(shapes.n, key[0]), np.full(shapes.n, key[1])
        x0, y0, x1, y1 = _cell_boxes(grid, rx, ry)
        at = np.flatnonzero(~shapes.contain(np.arange(shapes.n), grid.origin_x + (rx + 0.5) * grid.pixel_width, grid.origin_y + (ry + 0.5) * grid.pixel_height))
        at = at[shapes.hold_any(at, px, py)]
        if len(at):
            cx, cy = shapes.centroids(at)
            right, top = x1[at] - cx < cx - x0[at], y1[at] - cy < cy - y0[at]
            corner = np.select([right & top, right, top], [0, 1, 3], 2)
            yield [of.column("id").take(pa.array(at)).to_pylist(), rx[at].tolist(), ry[at].tolist(), corner.tolist()]

    return by_block(dealt, ["rx", "ry", "part"], run, f"id {slices.schema['id'].dataType.simpleString()}, rx long, ry long, corner int")


def contour_rings(data: DataFrame, grid: GridSpec, level: float, pad: bool = False) -> DataFrame:
    """(id, is_hole, geom): closed contours as polygons in coordinates; lines that pass a place twice are cut into loops.

    With ``pad`` what lies outside the grid counts as 0, so every contour closes; without, lines that leave the
    grid between solid squares of its border stay open and give no polygon.
    """
    segments = materialize(raster.contour_segments(data, grid, level, pad))
    number = F.col("rx") + 1 + (F.col("ry") + 1) * (grid.cols + 2)
    squares = segments.select("rx", "ry", number.alias("sq")).distinct()
    side = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i, j in ((0, 0), (1, 0), (0, 1))])).alias("d")
    beside = squares.select("sq", (F.col("rx")).alias("ax"), F.col("ry").alias("ay"), side).select("sq", (F.col("ax") + F.col("d.i")).alias("rx"), (F.col("ay") + F.col("d.j")).alias("ry"))
    edges = beside.join(squares.withColumnRenamed("sq", "other"), ["rx", "ry"])
    component = connected_components(edges, "sq", "other", finish=200_000)
    placed = segments.withColumn("sq", number).join(component, F.col("sq") == F.col("node"))

    def rings(key: tuple, rows: pa.Table) -> list[tuple]:
        lines = kernel.stitch(list(zip(*(rows[c].to_pylist() for c in ("x0", "y0", "x1", "y1")), strict=True)))
        out = []
        for line in lines:
            if line[0] == line[-1]:
                for r in kernel.split_loops(line):
                    placed = [(grid.origin_x + (x + 0.5) * grid.pixel_width, grid.origin_y + (y + 0.5) * grid.pixel_height) for x, y in r]
                    out.append((key[0], kernel.ring_area(placed) < 0, write([[placed]])))
        return out

    found = by_group(placed.select("component", "x0", "y0", "x1", "y1"), ["component"], rings, f"component long, is_hole boolean, geom {geo.GEOM}")
    return with_envelope(found)
