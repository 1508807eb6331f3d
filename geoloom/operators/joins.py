"""Spatial joins as equi-joins on buckets of a coarse grid, with the exact test on what meets.

A shape is listed in every bucket that its envelope touches. A pair that meets in several buckets is kept
in one only, the one that holds the lower left corner of the common part of both envelopes, so no
distinct is needed. Nothing is compared across buckets, and crowded buckets are ordinary skewed join
keys, which adaptive execution splits.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions.grid import GridSpec
from geoloom.functions.kernel import geodesic_distance, linked
from geoloom.functions.pairs import Shapes
from geoloom.functions.pairs import intersects as shapes_meet
from geoloom.operators.graph import connected_components
from geoloom.plans.batches import by_block

ENVELOPE = ["minx", "miny", "maxx", "maxy"]
CROWD = 4096  # shapes of one side that are compared in one block; fuller buckets are dealt into several


def _bucketed(shapes: DataFrame, size: float, prefix: str, grow: float = 0) -> DataFrame:
    """All columns under a prefix, and a row for each bucket (bx, by) that the grown envelope touches."""
    named = shapes.select(*[F.col(c).alias(prefix + c) for c in shapes.columns])
    at = lambda c, g: F.floor((F.col(prefix + c) + g) / size).cast("long")
    across = named.withColumn("bx", F.explode(F.sequence(at("minx", -grow), at("maxx", grow))))
    return across.withColumn("by", F.explode(F.sequence(at("miny", -grow), at("maxy", grow))))


def _met_here(size: float, grow: float = 0) -> Column:
    """Whether this bucket is the one in which the pair counts."""
    x = F.greatest(F.col("l_minx") - grow, F.col("r_minx"))
    y = F.greatest(F.col("l_miny") - grow, F.col("r_miny"))
    return (F.floor(x / size) == F.col("bx")) & (F.floor(y / size) == F.col("by"))


def envelopes_meet(grow: float = 0) -> Column:
    c = F.col
    return (c("r_minx") <= c("l_maxx") + grow) & (c("l_minx") <= c("r_maxx") + grow) & (c("r_miny") <= c("l_maxy") + grow) & (c("l_miny") <= c("r_maxy") + grow)


def spatial_join(left: DataFrame, right: DataFrame, size: float, within: float = 0, exact: Callable[[], Column] | None = None) -> DataFrame:
    """Pairs whose envelopes come within ``within`` of each other on both axes; columns get l_ and r_.

    size: the buckets' side, about that of a common shape. exact() may test the pair further.
    """
    l, r = _bucketed(left, size, "l_", within), _bucketed(right, size, "r_")
    pairs = l.join(r, ["bx", "by"]).where(envelopes_meet(within) & _met_here(size, within)).drop("bx", "by")
    return pairs.where(exact()) if exact else pairs


def _blocks(left: DataFrame, right: DataFrame | None, size: float, within: float, crowd: int) -> tuple[DataFrame, list[str]]:
    """Both sides (without right: one, against itself) by bucket and block, and the columns that name a block.

    A bucket with more than ``crowd`` shapes of a side is dealt into blocks, each pair of them in one.
    """
    sides = [left] if right is None else [left, right]
    listed = None
    for side, shapes in enumerate(sides):
        geom = ["geom"] if "geom" in shapes.columns else []
        named = shapes.select(F.col("id").cast("long"), *[F.col(c).cast("double").alias(c) for c in ENVELOPE], *geom).where("id is not null")
        one = _bucketed(named.withColumn("side", F.lit(side)), size, "", 0 if side else within)
        listed = one if listed is None else listed.union(one)
    full = listed.groupBy("bx", "by", "side").agg(F.count("*").alias("n")).where(F.col("n") > crowd)
    parts = lambda s: F.coalesce(F.max(F.when(F.col("side") == s, F.ceil(F.col("n") / crowd).cast("int"))), F.lit(1)).alias(f"parts{s}")
    dealt = listed.join(full.groupBy("bx", "by").agg(parts(0), parts(1)), ["bx", "by"], "left")
    number = lambda s: F.pmod(F.xxhash64("id"), F.coalesce(F.col(f"parts{s}"), F.lit(1))).cast("int")
    others = lambda s: F.sequence(F.lit(0), F.coalesce(F.col(f"parts{s}"), F.lit(1)) - 1)
    if right is None:  # the block of parts i <= j, once; both sides of it are told apart by their part
        own = number(0)
        dealt = dealt.withColumn("part", own).withColumn("other", F.explode(others(0)))
        dealt = dealt.withColumns({"i": F.least("part", "other"), "j": F.greatest("part", "other")}).drop("other")
    else:
        dealt = dealt.withColumn("other", F.explode(F.when(F.col("side") == 0, others(1)).otherwise(others(0)))).withColumn("part", F.lit(0))
        dealt = dealt.withColumns({"i": F.when(F.col("side") == 0, number(0)).otherwise(F.col("other")), "j": F.when(F.col("side") == 0, F.col("other")).otherwise(number(1))}).drop("other")
    return dealt.drop("parts0", "parts1"), ["bx", "by", "i", "j"]


def _meetings(key: tuple, rows: pa.Table, same: bool, size: float, within: float, exact: Callable | None) -> Iterator[tuple]:
    """(shapes, ids, left positions, right positions) of the pairs of a block that meet in it, some at a time."""
    ids, side, part = (rows.column(c).to_numpy() for c in ("id", "side", "part"))
    box = [rows.column(c).to_numpy() for c in ENVELOPE]
    shapes = Shapes(rows.column("geom")) if "geom" in rows.column_names else None
    bx, by, i, j = key
    if same:
        order = np.argsort(ids, kind="stable")
        lefts = rights = order
    else:
        lefts, rights = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
    if not len(lefts) or not len(rights):
        return
    r = [v[rights] for v in box]
    step = max(1, 1_000_000 // len(rights))
    for start in range(0, len(lefts), step):
        at = lefts[start : start + step]
        past = start if same else 0  # the lesser id is on the left
        minx, miny, maxx, maxy = (v[at][:, None] for v in box)
        near = (r[0][past:] <= maxx + within) & (minx <= r[2][past:] + within) & (r[1][past:] <= maxy + within) & (miny <= r[3][past:] + within)
        a, b = np.nonzero(near)
        a, b = at[a], rights[past + b]
        here = (np.floor(np.maximum(box[0][a] - within, box[0][b]) / size) == bx) & (np.floor(np.maximum(box[1][a] - within, box[1][b]) / size) == by)
        if same:
            here &= ids[a] < ids[b]
            if i != j:
                here &= part[a] != part[b]
        a, b = a[here], b[here]
        if exact is not None:
            met = exact(shapes, shapes, a, b)
            a, b = a[met], b[met]
        if len(a):
            yield shapes, ids, a, b


def block_pairs(left: DataFrame, right: DataFrame | None, size: float, within: float = 0, exact: Callable | None = shapes_meet, measure: Callable | None = None, schema: str = "", crowd: int = CROWD) -> DataFrame:
    """(l_id, r_id, measures): pairs of shapes (id, envelope, geom) that meet, found block by block in arrays.

    Without right: pairs within left, l_id < r_id. exact(shapes, shapes, i, j) tests pairs of positions,
    measure(shapes, shapes, i, j) gives further columns by name, of which schema holds the types (", a double").
    """
    dealt, keys = _blocks(left, right, size, within, crowd)
    same = right is None

    def run(key: tuple, rows: pa.Table) -> Iterator[list]:
        for shapes, ids, a, b in _meetings(key, rows, same, size, within, exact):
            for k in range(0, len(a), 200_000):
                i, j = a[k : k + 200_000], b[k : k + 200_000]
                yield [ids[i], ids[j], *(measure(shapes, shapes, i, j).values() if measure else ())]

    return by_block(dealt, keys, run, "l_id long, r_id long" + schema)


def least_met(left: DataFrame, right: DataFrame, size: float, exact: Callable | None = shapes_meet, crowd: int = CROWD) -> DataFrame:
    """(id, least): the least id on the right that each shape on the left meets."""
    dealt, keys = _blocks(left, right, size, 0, crowd)

    def run(key: tuple, rows: pa.Table) -> Iterator[list]:
        least = None
        for _, ids, a, b in _meetings(key, rows, False, size, 0, exact):
            if least is None:
                least, met = np.full(len(ids), np.iinfo(np.int64).max), np.zeros(len(ids), bool)
            np.minimum.at(least, a, ids[b])
            met[a] = True
        if least is not None:
            yield [ids[met], least[met]]

    return by_block(dealt, keys, run, "id long, least long").groupBy("id").agg(F.min("least").alias("least"))


def links(shapes: DataFrame, size: float, within: float = 0, exact: Callable | None = None, crowd: int = CROWD) -> DataFrame:
    """(a, b): links that hold together what meets, fewer than shapes in each block, instead of all pairs."""
    dealt, keys = _blocks(shapes, None, size, within, crowd)

    def run(key: tuple, rows: pa.Table) -> Iterator[list]:
        root = np.arange(rows.num_rows)
        for shapes, ids, a, b in _meetings(key, rows, True, size, within, None):
            step = 20_000 if exact else len(a)
            for k in range(0, len(a), step):
                i, j = a[k : k + step], b[k : k + step]
                apart = root[i] != root[j]  # what is linked already needs no test
                i, j = i[apart], j[apart]
                if exact and len(i):
                    met = exact(shapes, shapes, i, j)
                    i, j = i[met], j[met]
                root = linked(root, i, j)
        tied = np.flatnonzero(root != np.arange(len(root)))
        if len(tied):
            yield [ids[root[tied]], ids[tied]]

    return by_block(dealt, keys, run, "a long, b long")


def proximity_pairs(shapes: DataFrame, within: float, size: float, id_col: str = "fid") -> DataFrame:
    """(a, b), a < b: shapes whose envelopes are at most ``within`` apart on both axes, ends included."""
    only = shapes.select(F.col(id_col).alias("id"), *ENVELOPE)
    return spatial_join(only, only, size, within).where("l_id < r_id").select(F.col("l_id").alias("a"), F.col("r_id").alias("b"))


def group_near(shapes: DataFrame, within: float, size: float, id_col: str = "fid") -> DataFrame:
    """(id, group_id): shapes that hang together by proximity; the group is named by its least id."""
    pairs = links(shapes.select(F.col(id_col).alias("id"), *ENVELOPE), size, within)
    alone = shapes.select(F.col(id_col).alias("a"), F.col(id_col).alias("b"))
    return connected_components(pairs.union(alone), "a", "b", finish=200_000).select(F.col("node").alias("id"), F.col("component").alias("group_id"))


def semi(left: DataFrame, right: DataFrame, size: float, id_col: str = "id", exact: Callable[[], Column] | None = None) -> DataFrame:
    """Rows of left that some row of right meets."""
    met = spatial_join(left, right, size, exact=exact).select(F.col("l_" + id_col).alias(id_col)).distinct()
    return left.join(met, id_col, "left_semi")


def anti(left: DataFrame, right: DataFrame, size: float, id_col: str = "id", exact: Callable[[], Column] | None = None) -> DataFrame:
    """Rows of left that no row of right meets."""
    met = spatial_join(left, right, size, exact=exact).select(F.col("l_" + id_col).alias(id_col)).distinct()
    return left.join(met, id_col, "left_anti")


def nearest(points: DataFrame, places: DataFrame, size: float, levels: int = 1, k: int = 1) -> DataFrame:
    """(id, place_id, d2, rank): for each point (id, x, y) the k places (place_id, px, py) at the least squared distances; ties to the least place_id.

    Places are listed in a pyramid of grids over all coordinates, each level twice as coarse, from cells of
    ``size`` to one that holds all, ``levels`` of them at least. A point's level is the finest whose own cell holds k places; they are no
    farther than the cell's diagonal, so the nearest k are among the 5 x 5 cells around at that level. Work
    per point doesn't depend on how far away places are. No places, no rows.
    """
    ends = points.select("x", "y").union(places.select("px", "py")).agg(F.min("x").alias("a"), F.min("y").alias("b"), F.max("x").alias("c"), F.max("y").alias("d")).first()
    if ends["a"] is None:
        ends = {"a": 0.0, "b": 0.0, "c": 0.0, "d": 0.0}
    width = max(float(ends["c"]) - float(ends["a"]), float(ends["d"]) - float(ends["b"]), float(size))
    levels = max(levels, 1 + math.ceil(math.log2(width / size) + 1))
    level = F.explode(F.sequence(F.lit(0), F.lit(levels - 1))).alias("level")
    at = lambda c, low: F.floor((F.col(c) - float(low)) / (F.lit(float(size)) * F.pow(F.lit(2.0), F.col("level")))).cast("long")
    listed = places.select("place_id", "px", "py", level).withColumns({"cx": at("px", ends["a"]), "cy": at("py", ends["b"])})
    held = listed.groupBy("level", "cx", "cy").agg(F.count("*").alias("n")).where((F.col("n") >= k) | (F.col("level") == levels - 1)).drop("n")
    seen = points.select("id", "x", "y", level).withColumns({"cx": at("x", ends["a"]), "cy": at("y", ends["b"])}).join(held, ["level", "cx", "cy"], "left_semi")
    own = seen.groupBy("id").agg(F.min(F.struct("level", "cx", "cy", "x", "y")).alias("s")).select("id", "s.*")
    offsets = F.explode(F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in range(-2, 3) for j in range(-2, 3)])).alias("o")
    around = own.select("id", "x", "y", "level", "cx", "cy", offsets).select("id", "x", "y", "level", (F.col("cx") + F.col("o.i")).alias("cx"), (F.col("cy") + F.col("o.j")).alias("cy"))
    dx, dy = F.col("x") - F.col("px"), F.col("y") - F.col("py")
    found = around.join(listed, ["level", "cx", "cy"]).select("id", (dx * dx + dy * dy).alias("d2"), "place_id")
    if k == 1:
        return found.groupBy("id").agg(F.min(F.struct("d2", "place_id")).alias("n")).select("id", "n.place_id", "n.d2", F.lit(1).alias("rank"))
    rank = F.row_number().over(Window.partitionBy("id").orderBy("d2", "place_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("id", "place_id", "d2", "rank")


def nearest_on_earth(points: DataFrame, places: DataFrame, grid: GridSpec, size: float, k: int = 1) -> DataFrame:
    """(id, place_id, metres, rank): the k nearest places (place_id, lon, lat) of each point (id, lon, lat), near in the equal-area plane around the grid's centre.

    size: the finest buckets' side in metres. metres is the geodesic distance. Ties in the plane go to the least place_id.
    """
    lon0, lat0 = grid.origin_x + grid.cols * grid.pixel_width / 2, grid.origin_y + grid.rows * grid.pixel_height / 2
    x, y = geo.laea("lon", "lat", lon0, lat0)

    @F.arrow_udf("double")
    def metres(a: pa.Array, b: pa.Array, c: pa.Array, d: pa.Array) -> pa.Array:
        return pa.array([geodesic_distance(*q) for q in zip(*(v.to_pylist() for v in (a, b, c, d)), strict=True)], pa.float64())

    found = nearest(points.select("id", x.alias("x"), y.alias("y")), places.select("place_id", x.alias("px"), y.alias("py")), size, k=k).drop("d2")
    ends = found.join(points.select("id", "lon", "lat"), "id").join(places.select("place_id", F.col("lon").alias("plon"), F.col("lat").alias("plat")), "place_id")
    return ends.select("id", "place_id", metres("lon", "lat", "plon", "plat").alias("metres"), "rank")
