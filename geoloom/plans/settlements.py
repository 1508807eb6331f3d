"""The two products as lazily built plans: settlements from footprints, and the comparison of two generations."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions.grid import GridSpec
from geoloom.operators import compare, joins, raster, settle, vector
from geoloom.plans.materialize import materialize


@dataclass(frozen=True)
class Config:
    """Distances in the units of the coordinates, but for buffer_metres."""

    group_distance: float = 0.000833
    buffer_metres: float = 50
    contour_level: float = 12
    large: int = 3000
    small: int = 50
    least_contour_m2: float = 400_000
    quad_segs: int = 2


def settlements(buildings: DataFrame, reference: GridSpec, config: Config = Config()) -> dict[str, DataFrame]:
    """buildings: fid, geom in degrees. Returns settlements, buildings (with set_orig_fid), counts, contours and check."""
    size = 8 * config.group_distance
    fixed = materialize(vector.with_envelope(vector.fix_geom(buildings.select("fid", "geom"))))
    extent = fixed.agg(F.min("minx").alias("a"), F.min("miny").alias("b"), F.max("maxx").alias("c"), F.max("maxy").alias("e")).first()
    grid = reference.expanded(extent["a"], extent["b"], extent["c"], extent["e"])
    groups = vector.fill_centres(vector.group_members(fixed.select("fid", "geom"), config.group_distance, size), grid, size)
    outlines = vector.dissolve(vector.buffer_metres(groups, config.buffer_metres, config.quad_segs), size, no_holes=True)
    c = geo.centroid("geom")
    points = fixed.withColumn("c", c).select("fid", F.col("c.x").alias("x"), F.col("c.y").alias("y"))
    points = materialize(points.select("fid", "x", "y", grid.cell_x("x").alias("rx"), grid.cell_y("y").alias("ry")))
    counts = materialize(raster.burn_count(points, grid))
    contours = vector.contour_rings(counts, grid, config.contour_level, pad=True).withColumn("area", vector.ellipsoid_area("geom"))
    contours = materialize(contours.withColumn("id", F.monotonically_increasing_id()))
    outlines = materialize(outlines)
    corners = vector.centre_check(points, vector.grid_slice(outlines, grid), grid).select(settle.corner_shape(grid).alias("geom"))
    final = materialize(vector.with_envelope(vector.dissolve(outlines.select("geom").union(corners), size)))
    zonal = raster.zonal_stats(vector.rasterize(final, grid), counts)
    classed = settle.classify(final.withColumnRenamed("orig_fid", "id").drop("n"), zonal, config.large, config.small)
    meets, inside = lambda: vector.intersects("l_geom", "r_geom"), lambda: vector.contains("r_geom", "l_geom")
    up = settle.promote(classed, contours, config.least_contour_m2, size * 8, meets, inside).select("id", F.col("new_level").alias("level"))
    done = materialize(classed.drop("level").join(up, "id").withColumn("area_m2", vector.ellipsoid_area("geom")).withColumnRenamed("id", "orig_fid"))
    pieces = vector.with_envelope(vector.grid_slice(done, grid))
    met = joins.spatial_join(fixed.select("fid", "geom", *joins.ENVELOPE), pieces.select("id", "geom", *joins.ENVELOPE), size).where(vector.intersects("l_geom", "r_geom"))
    assigned = fixed.join(met.groupBy(F.col("l_fid").alias("fid")).agg(F.min("r_id").alias("set_orig_fid")), "fid", "left")
    return {"settlements": done, "buildings": assigned, "counts": counts, "contours": contours, "check": settle.count_check(done, fixed)}


def compare_generations(year1: DataFrame, year2: DataFrame, grid: GridSpec) -> dict[str, DataFrame]:
    """year1, year2: fid, geom. Returns squares and the five summaries."""

    def cells(layer: DataFrame) -> tuple[DataFrame, DataFrame]:
        fixed = materialize(vector.fix_geom(layer.select("fid", "geom")))
        on = materialize(vector.rasterize(fixed, grid))
        c = fixed.withColumn("c", geo.centroid("geom"))
        middle = c.select(F.col("orig_fid").alias("id"), grid.cell_x(F.col("c.x")).alias("rx"), grid.cell_y(F.col("c.y")).alias("ry"))
        return on, compare.missing_ids(middle, on)

    (on1, lost1), (on2, lost2) = cells(year1), cells(year2)
    squares = materialize(compare.squares(on1, on2, lost1, lost2))
    return {"squares": squares, "main": compare.id_main(squares), **{f"{n}_y{y}": f(squares, y) for n, f in (("lookup", compare.id_lookup), ("overlap", compare.id_overlap)) for y in (1, 2)}}
