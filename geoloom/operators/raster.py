"""Rasters as sparse tables of cells (rx, ry, v): a cell without data has no row."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.grid import GridSpec
from geoloom.operators.graph import connected_components

CELL = ["rx", "ry"]


def burn_count(points: DataFrame, grid: GridSpec) -> DataFrame:
    """How many points (rx, ry) each cell of the grid holds: (rx, ry, v)."""
    return points.where(grid.inside("rx", "ry")).groupBy(*CELL).agg(F.count("*").alias("v"))


def rasterize_boxes(boxes: DataFrame, grid: GridSpec, id_col: str = "id") -> DataFrame:
    """(id, rx, ry) of each cell whose centre is in a box, by ranges in closed form."""
    x0, x1 = grid.centred_columns("minx", "maxx")
    y0, y1 = grid.centred_rows("miny", "maxy")
    ranged = boxes.select(F.col(id_col).alias("id"), x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1")).where("x0 <= x1 and y0 <= y1")
    return ranged.select("id", "x0", "x1", F.explode(F.sequence("y0", "y1")).alias("ry")).select("id", F.explode(F.sequence("x0", "x1")).alias("rx"), "ry")


def zonal_stats(zones: DataFrame, data: DataFrame) -> DataFrame:
    """Per id of zones (id, rx, ry): cells with data and their sum, from data (rx, ry, v)."""
    return zones.join(data, CELL).groupBy("id").agg(F.count("*").alias("square_count"), F.sum("v").cast("double").alias("square_sum"))


def area_and_count(features: DataFrame, grid: GridSpec, width: int, height: int) -> DataFrame:
    """Features (x, y: envelope centre; area) in a width x height grid that needn't follow cells: (bin_x, bin_y, area, n)."""
    w, h = grid.chunk_size(width, height, aligned=False)
    bx, by = F.floor((F.col("x") - grid.origin_x) / w).cast("int"), F.floor((grid.origin_y - F.col("y")) / h).cast("int")
    binned = features.select(bx.alias("bin_x"), by.alias("bin_y"), "area").where(F.col("bin_x").between(0, width - 1) & F.col("bin_y").between(0, height - 1))
    return binned.groupBy("bin_x", "bin_y").agg(F.sum("area").alias("area"), F.count("*").alias("n"))


# map algebra ---------------------------------------------------------------------------------
def combine(left: DataFrame, right: DataFrame, f: Callable[[Column, Column, Column, Column], Column]) -> DataFrame:
    """f(l, l has no data, r, r has no data) over the cells of both; a null result is no data."""
    both = left.select(*CELL, F.col("v").alias("l")).join(right.select(*CELL, F.col("v").alias("r")), CELL, "full_outer")
    value = f(F.col("l"), F.col("l").isNull(), F.col("r"), F.col("r").isNull())
    return both.select(*CELL, value.alias("v")).where("v is not null")


def add(left: DataFrame, right: DataFrame) -> DataFrame:
    return combine(left, right, lambda l, ln, r, rn: F.coalesce(l, F.lit(0)) + F.coalesce(r, F.lit(0)))


def ratio(left: DataFrame, right: DataFrame) -> DataFrame:
    """l / r where both have data; division by zero leaves none."""
    both = left.join(right.withColumnRenamed("v", "r"), CELL)
    return both.select(*CELL, F.try_divide(F.col("v").cast("double"), F.col("r").cast("double")).alias("v")).where("v is not null")


def diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """l - r, a missing side as zero; no data where both are missing or next to zero."""

    def f(l: Column, ln: Column, r: Column, rn: Column) -> Column:
        quiet = (ln | (F.abs(l) < 1e-4)) & (rn | (F.abs(r) < 1e-4))
        return F.when(quiet, F.lit(None)).when(ln, -r).when(rn, l).otherwise(l - r)

    return combine(left, right, f)


def keep_where_data(left: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells of left where mask has data."""
    return left.join(mask.select(*CELL), CELL, "left_semi")


def keep_where_no_data(left: DataFrame, mask: DataFrame) -> DataFrame:
    """Cells of left where mask has none."""
    return left.join(mask.select(*CELL), CELL, "left_anti")


def two_raster_stats(left: DataFrame, right: DataFrame, shift: tuple[int, int] = (0, 0)) -> DataFrame:
    """Sums of both, of the absolute differences, and the absolute difference of the sums. shift moves right onto left."""
    moved = right.select((F.col("rx") + shift[0]).alias("rx"), (F.col("ry") + shift[1]).alias("ry"), F.col("v").alias("r"))
    both = left.withColumnRenamed("v", "l").join(moved, CELL, "full_outer")
    l, r = F.coalesce("l", F.lit(0)), F.coalesce("r", F.lit(0))
    sums = both.agg(F.sum(l).alias("sum_left"), F.sum(r).alias("sum_right"), F.sum(F.abs(r - l)).alias("sum_abs_diff"))
    return sums.withColumn("abs_sum_diff", F.abs(F.col("sum_left") - F.col("sum_right")))


def raster_sum(data: DataFrame, nodata: float) -> Column:
    """Sum over a dense band with one of three cut-offs for its nodata value."""
    v = F.col("v")
    dropped = v >= nodata - 1 if nodata > 1 else v < 0 if nodata < 0 else v <= nodata + 1
    return data.agg(F.sum(F.when(~dropped, v)).alias("total"))


def resample(data: DataFrame, source: GridSpec, target: GridSpec) -> DataFrame:
    """Share each cell's value over the target's cells by overlapping area (mass is kept)."""
    x0, x1 = source.left("rx"), source.left(F.col("rx") + 1)
    y1, y0 = source.top("ry"), source.top(F.col("ry") + 1)
    spread = data.select("v", x0.alias("x0"), x1.alias("x1"), y0.alias("y0"), y1.alias("y1"))
    eps = 1e-9
    a, b = F.floor((F.col("x0") - target.origin_x) / target.pixel_width + eps), F.ceil((F.col("x1") - target.origin_x) / target.pixel_width - eps) - 1
    c, d = F.floor((F.col("y1") - target.origin_y) / target.pixel_height + eps), F.ceil((F.col("y0") - target.origin_y) / target.pixel_height - eps) - 1
    over = lambda p, q, r, s: F.greatest(F.least(p, q) - F.greatest(r, s), F.lit(0.0))
    cells = (
        spread.withColumns({"a": F.greatest(a.cast("long"), F.lit(0)), "b": F.least(b.cast("long"), F.lit(target.cols - 1)), "c": F.greatest(c.cast("long"), F.lit(0)), "d": F.least(d.cast("long"), F.lit(target.rows - 1))})
        .where("a <= b and c <= d").withColumn("rx", F.explode(F.sequence("a", "b"))).withColumn("ry", F.explode(F.sequence("c", "d")))
    )
    part = over(F.col("x1"), target.left(F.col("rx") + 1), F.col("x0"), target.left("rx")) * over(F.col("y1"), target.top("ry"), F.col("y0"), target.top(F.col("ry") + 1))
    share = part / (source.pixel_width * -source.pixel_height)
    return cells.withColumn("share", share).where("share >= 1e-6").groupBy(*CELL).agg(F.sum(F.col("v") * F.col("share")).alias("v"))


# focal ------------------------------------------------------------------------------------------
def _around(cells: DataFrame) -> DataFrame:
    nine = F.array(*[F.struct(F.lit(i).alias("dx"), F.lit(j).alias("dy")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    return cells.select(*CELL, F.explode(nine).alias("d")).select((F.col("rx") + F.col("d.dx")).alias("rx"), (F.col("ry") + F.col("d.dy")).alias("ry"))


def erode(cells: DataFrame) -> DataFrame:
    """Cells all of whose nine neighbours (itself included) are set."""
    return _around(cells.select(*CELL).distinct()).groupBy(*CELL).agg(F.count("*").alias("n")).where("n = 9").select(*CELL)


def row_gaps(cells: DataFrame, grid: GridSpec) -> DataFrame:
    """Maximal runs of empty cells of each row: (run, ry, x0, x1)."""
    border = F.explode(F.array(F.lit(-1).cast("long"), F.lit(grid.cols).cast("long"))).alias("rx")
    rows = cells.sparkSession.range(grid.rows).select(border, F.col("id").alias("ry"))
    marked = cells.select("rx", "ry").distinct().where(grid.inside("rx", "ry")).union(rows)
    after = F.lead("rx").over(Window.partitionBy("ry").orderBy("rx"))
    gaps = marked.select("ry", (F.col("rx") + 1).alias("x0"), (after - 1).alias("x1")).where("x0 <= x1")
    return gaps.withColumn("run", F.col("ry") * grid.cols + F.col("x0"))


def _touching(gaps: DataFrame) -> DataFrame:
    """(src, dst): runs of neighbouring rows that touch, across corners too, by sorting instead of comparing.

    A run looks in the row above and in the row below for the last run that starts no later than one cell
    behind its own end. Runs of a row have a set cell between them, so of two that touch at least one is
    found by the other: were neither, each would end behind the other's end.
    """
    roles = [(0, False, False), (0, True, False), (1, False, True), (-1, True, True)]
    role = F.explode(F.array(*[F.struct(F.lit(s).alias("step"), F.lit(u).alias("up"), F.lit(k).alias("seeks")) for s, u, k in roles])).alias("role")
    each = gaps.select("run", "ry", "x0", "x1", role).select(
        "run", "x0", "x1", (F.col("ry") + F.col("role.step")).alias("row"), "role.up", "role.seeks", F.when(F.col("role.seeks"), F.col("x1") + 1).otherwise(F.col("x0")).alias("at")
    )
    so_far = Window.partitionBy("row", "up").orderBy("at", "seeks").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    last = F.last(F.when(~F.col("seeks"), F.struct("run", "x1")), ignorenulls=True).over(so_far)
    found = each.withColumn("met", last).where(F.col("seeks") & (F.col("met.x1") >= F.col("x0") - 1))
    return found.select(F.col("run").alias("src"), F.col("met.run").alias("dst"))


def flood_fill(cells: DataFrame, grid: GridSpec) -> DataFrame:
    """Cells that a flood from the top row, through empty cells and across corners, doesn't reach.

    Empty stretches of rows stand for their cells, so the graph has about as many nodes as there are set
    cells and rows.
    """
    gaps = row_gaps(cells, grid)
    touch = _touching(gaps)
    tops = gaps.where("ry = 0").select(F.lit(-1).cast("long").alias("src"), F.col("run").alias("dst"))  # all of the top row is one
    edges = touch.union(tops).union(gaps.select(F.col("run").alias("src"), F.col("run").alias("dst")))
    reached = connected_components(edges, finish=200_000).where("component = -1").select(F.col("node").alias("run"))
    enclosed = gaps.join(reached, "run", "left_anti").select(F.explode(F.sequence("x0", "x1")).alias("rx"), "ry")
    return cells.select("rx", "ry").distinct().where(grid.inside("rx", "ry")).union(enclosed)


def boundary_edges(cells: DataFrame) -> DataFrame:
    """Sides of cells that no two set cells of one value share: (x0, y0, x1, y1, v), in cell corners."""
    sides = [(0, 0, 1, 0), (0, 1, 1, 1), (0, 0, 0, 1), (1, 0, 1, 1)]
    side = F.array(*[F.struct(*[F.lit(x).alias(n) for n, x in zip("abcd", s, strict=True)]) for s in sides])
    every = cells.select(*CELL, "v", F.explode(side).alias("s")).select(
        (F.col("rx") + F.col("s.a")).alias("x0"), (F.col("ry") + F.col("s.b")).alias("y0"), (F.col("rx") + F.col("s.c")).alias("x1"), (F.col("ry") + F.col("s.d")).alias("y1"), "v"
    )
    return every.groupBy("x0", "y0", "x1", "y1", "v").agg(F.count("*").alias("n")).where("n = 1").drop("n")


# contours ---------------------------------------------------------------------------------------
def framed(data: DataFrame, grid: GridSpec, level: float) -> DataFrame:
    """``data`` with the cells along the border of the grid set to just above the level."""
    inner = (F.col("rx").between(1, grid.cols - 2)) & (F.col("ry").between(1, grid.rows - 2))
    along = data.sparkSession.range(max(grid.cols, grid.rows)).withColumn("side", F.explode(F.sequence(F.lit(0), F.lit(3))))
    rx = F.when(F.col("side") == 0, F.lit(0)).when(F.col("side") == 1, F.lit(grid.cols - 1)).otherwise(F.col("id"))
    ry = F.when(F.col("side") == 2, F.lit(0)).when(F.col("side") == 3, F.lit(grid.rows - 1)).otherwise(F.col("id"))
    border = along.select(rx.cast("long").alias("rx"), ry.cast("long").alias("ry")).where(grid.inside("rx", "ry")).distinct()
    return data.where(inner).select(*CELL, F.col("v").cast("double").alias("v")).union(border.withColumn("v", F.lit(level + 1e-9)))


def contour_segments(data: DataFrame, grid: GridSpec, level: float, pad: bool = False) -> DataFrame:
    """Marching squares: (rx, ry, kase, seg, x0, y0, x1, y1) in cell coordinates, for each 2 x 2 square that the level crosses.

    (rx, ry) is the square's upper left cell; a corner is inside where its value is over the level, no
    data counts as 0. The bits of kase are 8 upper left, 4 upper right, 2 lower right, 1 lower left. Saddles
    cut off their outside corners. A square all inside at the border of the grid is a border, which closes
    paths there; with ``pad`` the grid is taken as lying in a ring of cells without data instead, so every path closes.
    """
    out = 1 if pad else 0
    corner = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (0, 1) for j in (0, 1)])
    z = lambda i, j: F.coalesce(F.max(F.when((F.col("c.i") == i) & (F.col("c.j") == j), F.col("v"))), F.lit(0)).cast("double")
    squares = (
        data.select((F.col("rx")).alias("ax"), F.col("ry").alias("ay"), "v", F.explode(corner).alias("c"))
        .withColumns({"rx": F.col("ax") - F.col("c.i"), "ry": F.col("ay") - F.col("c.j")})
        .where((F.col("rx") >= -out) & (F.col("rx") < grid.cols - 1 + out) & (F.col("ry") >= -out) & (F.col("ry") < grid.rows - 1 + out))
        .groupBy(*CELL).agg(z(0, 0).alias("a"), z(1, 0).alias("b"), z(1, 1).alias("c"), z(0, 1).alias("d"))
    )
    kase = sum((F.col(n) > level).cast("int") * k for n, k in (("a", 8), ("b", 4), ("c", 2), ("d", 1)))
    if not pad:  # the first border that a solid square lies at
        x, y = F.col("rx"), F.col("ry")
        at_border = F.when(x == 0, 6).when(x == grid.cols - 2, 9).when(y == 0, 3).when(y == grid.rows - 2, 12).otherwise(15)
        kase = F.when(kase == 15, at_border).otherwise(kase)
    squares = squares.withColumn("kase", kase.cast("int")).where("kase between 1 and 14")
    cut = lambda p, q: F.when(F.col(q) == F.col(p), 0.5).otherwise(F.least(F.greatest((level - F.col(p)) / (F.col(q) - F.col(p)), F.lit(0.0)), F.lit(1.0)))
    side = {
        "N": (F.col("rx") + cut("a", "b"), F.col("ry") + F.lit(0.0)), "E": (F.col("rx") + F.lit(1.0), F.col("ry") + cut("b", "c")),
        "S": (F.col("rx") + cut("d", "c"), F.col("ry") + F.lit(1.0)), "W": (F.col("rx") + F.lit(0.0), F.col("ry") + cut("a", "d")),
    }
    # fixed values: the inside is to the left of each segment as drawn, north up; saddles cut off the outside corners
    lines = {1: ["SW"], 2: ["ES"], 3: ["EW"], 4: ["NE"], 5: ["NW", "SE"], 6: ["NS"], 7: ["NW"], 8: ["WN"], 9: ["SN"], 10: ["EN", "WS"], 11: ["EN"], 12: ["WE"], 13: ["SE"], 14: ["WS"]}
    seg = lambda i, k: F.struct(F.lit(i).alias("seg"), *[c.alias(n) for c, n in zip((*side[k[0]], *side[k[1]]), ("x0", "y0", "x1", "y1"), strict=True)])
    found = None
    for k, segs in lines.items():
        value = F.array(*[seg(i, s) for i, s in enumerate(segs)])
        found = F.when(F.col("kase") == k, value) if found is None else found.when(F.col("kase") == k, value)
    return squares.select(*CELL, "kase", F.explode(found).alias("s")).select(*CELL, "kase", "s.*")


def color_ramp(data: DataFrame, bins: int = 155, equal: float = 1.0) -> DataFrame:
    """Breaks of at most ``bins`` classes for the values below -equal and for those above equal: (sign, bin, upper, alpha).

    With n values of a sign and k = min(n, bins) classes, class b of the negative ones ends at the value of
    place floor(b / k * (n - 1)) in ascending order and is the more opaque the lower it is; class b of the positive
    ones ends at place ceil(b / k * (n - 2)) + 1 and is the more opaque the higher it is. Values are placed
    within their sign by counts of distinct values, so no row but a distinct value is ever sorted.
    """
    counted = data.where(F.abs("v") > equal).groupBy(F.signum(F.col("v").cast("double")).cast("int").alias("sign"), F.col("v").cast("double").alias("v")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("sign").orderBy("v")
    ranked = counted.withColumns({"upto": F.sum("n").over(w), "total": F.sum("n").over(Window.partitionBy("sign"))})
    ranked = ranked.withColumn("k", F.least(F.lit(bins).cast("long"), F.col("total")))

    def place(b: Column) -> Column:
        part = b.cast("double") / F.col("k").cast("double")
        low, high = F.floor(part * (F.col("total") - 1)), F.ceil(part * F.greatest(F.col("total") - 2, F.lit(0))) + 1
        return F.when(F.col("sign") < 0, low).otherwise(F.least(high, F.col("total") - 1))

    here = F.filter(F.sequence(F.lit(0).cast("long"), F.col("k") - 1), lambda b: (place(b) < F.col("upto")) & (place(b) >= F.col("upto") - F.col("n")))
    found = ranked.withColumn("bin", F.explode(here))
    alpha = F.when(F.col("sign") < 0, 255 - F.col("bin")).otherwise(255 - F.col("k") + F.col("bin"))
    return found.select("sign", F.col("bin").cast("int").alias("bin"), F.col("v").alias("upper"), alpha.cast("int").alias("alpha"))
