"""Queries over the driver's tables, by name, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions.grid import GridSpec
from geoloom.operators import compare, joins, raster, settle, vector
from geoloom.plans import inputs as i
from geoloom.plans.materialize import materialize

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(sql: str | None = None):
    """Register a function under its name, with its oracle."""

    def keep(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return keep


Z1C, Z2C = i.sql_cells("z1", "c1"), i.sql_cells("z2", "c2")
W = i.with_sql


@query(W(i.SQL_FP, i.SQL_CNT) + "SELECT rx, ry, v AS n FROM cnt")
def burn_count(spark: SparkSession, d: str) -> DataFrame:
    return i.counts(spark, d).withColumnRenamed("v", "n")


@query(W(i.SQL_FP, i.SQL_Z1, Z1C) + "SELECT id, rx, ry FROM c1")
def rasterize(spark: SparkSession, d: str) -> DataFrame:
    return raster.rasterize_boxes(i.zones1(spark, d), i.GRID)


ZONAL = "zs AS (SELECT id, count(*) AS square_count, CAST(sum(v) AS DOUBLE) AS square_sum FROM c1 JOIN cnt USING (rx, ry) GROUP BY id)"


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL) + "SELECT * FROM zs")
def zonal_stats(spark: SparkSession, d: str) -> DataFrame:
    return raster.zonal_stats(raster.rasterize_boxes(i.zones1(spark, d), i.GRID), i.counts(spark, d))


LEVELS = "lv AS (SELECT z1.id, CAST(square_sum AS BIGINT) AS bldg_count, CAST(CASE WHEN square_sum>3000 THEN 2 WHEN square_sum>50 THEN 1 ELSE 0 END AS INTEGER) AS level FROM z1 LEFT JOIN zs USING (id))"


def levels(spark: SparkSession, d: str) -> DataFrame:
    return settle.classify(i.zones1(spark, d), zonal_stats(spark, d)).select("id", "bldg_count", "level")


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS) + "SELECT id, bldg_count FROM lv")
def zonal_left_join(spark: SparkSession, d: str) -> DataFrame:
    return levels(spark, d).select("id", "bldg_count")


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS) + "SELECT level, count(*) AS settlements, CAST(coalesce(sum(bldg_count),0) AS BIGINT) AS buildings FROM lv GROUP BY level")
def classify_levels(spark: SparkSession, d: str) -> DataFrame:
    return levels(spark, d).groupBy("level").agg(F.count("*").alias("settlements"), F.coalesce(F.sum("bldg_count"), F.lit(0)).alias("buildings"))


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS) + "SELECT level, min(id) AS min_id, max(id) AS max_id FROM lv GROUP BY level")
def level_minmax(spark: SparkSession, d: str) -> DataFrame:
    return levels(spark, d).groupBy("level").agg(F.min("id").alias("min_id"), F.max("id").alias("max_id"))


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS) + "SELECT CAST(coalesce(sum(bldg_count),0) AS BIGINT) AS settled, (SELECT count(*) FROM fp) AS buildings FROM lv")
def count_check(spark: SparkSession, d: str) -> DataFrame:
    return settle.count_check(levels(spark, d), i.footprints(spark, d))


PROMOTED = """pr AS (SELECT lv.id, lv.level AS cur_level, CAST(CASE WHEN EXISTS (SELECT 1 FROM marks m WHERE NOT m.is_hole AND m.area>=100000000 AND m.minx<=z1.maxx AND z1.minx<=m.maxx AND m.miny<=z1.maxy AND z1.miny<=m.maxy)
  AND NOT EXISTS (SELECT 1 FROM marks m WHERE m.is_hole AND m.minx<=z1.minx AND m.maxx>=z1.maxx AND m.miny<=z1.miny AND m.maxy>=z1.maxy) THEN 2 ELSE level END AS INTEGER) AS new_level FROM lv JOIN z1 USING (id))"""


def promoted(spark: SparkSession, d: str) -> DataFrame:
    zones = i.zones1(spark, d).join(levels(spark, d).select("id", "level"), "id")
    return settle.promote(zones, i.marks(spark, d), least_area=100_000_000, size=20_000)


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS, i.SQL_FAC, i.SQL_MARKS, PROMOTED) + "SELECT * FROM pr")
def promote_bua(spark: SparkSession, d: str) -> DataFrame:
    return promoted(spark, d)


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS, i.SQL_FAC, i.SQL_MARKS, PROMOTED) + "SELECT cur_level, new_level, count(*) AS n FROM pr GROUP BY ALL ORDER BY 1, 2")
def level_crosstab(spark: SparkSession, d: str) -> DataFrame:
    return promoted(spark, d).groupBy("cur_level", "new_level").agg(F.count("*").alias("n")).orderBy("cur_level", "new_level")


BINS = "CAST(floor((minx+w/2.0)/(440657/20.0)) AS INTEGER) AS bin_x, CAST(floor((400000-(miny+h/2.0))/(400673/16.0)) AS INTEGER) AS bin_y"


@query(W(i.SQL_FP) + f"SELECT bin_x, bin_y, CAST(sum(w*h) AS BIGINT) AS area, count(*) AS n FROM (SELECT {BINS}, w, h FROM fp) WHERE bin_x BETWEEN 0 AND 19 AND bin_y BETWEEN 0 AND 15 GROUP BY bin_x, bin_y")
def area_count_bins(spark: SparkSession, d: str) -> DataFrame:
    f = i.footprints(spark, d).select((F.col("minx") + F.col("w") / 2).alias("x"), (F.col("miny") + F.col("h") / 2).alias("y"), (F.col("w") * F.col("h")).alias("area"))
    return raster.area_and_count(f, i.GRID, 20, 16)


@query(W(i.SQL_FP) + "SELECT CAST(floor((minx+w/2.0)/(53*833)) + floor((400000-(miny+h/2.0))/(49*833))*10 AS INTEGER) AS chunk, count(*) AS n FROM fp GROUP BY ALL")
def chunk_assign(spark: SparkSession, d: str) -> DataFrame:
    f = i.footprints(spark, d)
    chunk = i.GRID.chunk(F.col("minx") + F.col("w") / 2, F.col("miny") + F.col("h") / 2, 10, 10)
    return f.select(chunk.alias("chunk")).where("chunk is not null").groupBy("chunk").agg(F.count("*").alias("n"))


@query(W(i.SQL_FP) + "SELECT fid, CAST(2*minx+w AS DOUBLE)/2 AS x, CAST(2*miny+h AS DOUBLE)/2 AS y, rx, ry FROM fp")
def centroids(spark: SparkSession, d: str) -> DataFrame:
    f = i.footprints(spark, d)
    # against the ring's first vertex these sums are exact for boxes, so they equal the closed form
    c = geo.centroid(geo.box("minx", "miny", "maxx", "maxy"))
    return f.select("fid", F.round(c["x"], 1).alias("x"), F.round(c["y"], 1).alias("y"), "rx", "ry")


MERC = "round(radians({0}/1e6)*6378137, 3)", "round(ln(tan(pi()/4+radians({0}/1e6)/2))*6378137, 3)"


@query(W(i.SQL_FP) + f"SELECT min({MERC[0].format('minx')})+0.0 AS x_min, min({MERC[1].format('miny')})+0.0 AS y_min, max({MERC[0].format('maxx')})+0.0 AS x_max, max({MERC[1].format('maxy')})+0.0 AS y_max FROM fp")
def projected_extent(spark: SparkSession, d: str) -> DataFrame:
    f = i.footprints(spark, d)
    lo, hi = geo.web_mercator(F.col("minx") / 1e6, F.col("miny") / 1e6), geo.web_mercator(F.col("maxx") / 1e6, F.col("maxy") / 1e6)
    r = lambda c: F.round(c, 3)
    return f.agg(r(F.min(lo[0])).alias("x_min"), r(F.min(lo[1])).alias("y_min"), r(F.max(hi[0])).alias("x_max"), r(F.max(hi[1])).alias("y_max"))


@query("SELECT CAST((x+5999)//6000 AS INTEGER) AS zone, y>0 AS north, count(*) AS n FROM (SELECT (o_orderkey*7919)%360000 AS x, (o_orderkey*104729)%160000-80000 AS y FROM orders) WHERE x>0 GROUP BY ALL")
def utm_zone(spark: SparkSession, d: str) -> DataFrame:
    o = i.read(spark, d, "orders").select(F.expr("((o_orderkey*7919)%360000)/1000D - 180").alias("lon"), F.expr("((o_orderkey*104729)%160000-80000)/1000D").alias("lat"))
    return o.select(geo.utm_zone("lon").alias("zone"), geo.utm_north("lat").alias("north")).where("zone is not null").groupBy("zone", "north").agg(F.count("*").alias("n"))


@query(W(i.SQL_FP) + "SELECT site AS id, row_number() OVER (PARTITION BY site ORDER BY minx, miny, maxx, maxy)-1 AS part, CAST(minx AS DOUBLE) AS minx, CAST(miny AS DOUBLE) AS miny, CAST(maxx AS DOUBLE) AS maxx, CAST(maxy AS DOUBLE) AS maxy FROM fp")
def multi_to_single(spark: SparkSession, d: str) -> DataFrame:
    many = i.footprints(spark, d).groupBy(F.col("site").alias("id"), F.pmod("fid", F.lit(64)).alias("salt")).agg(F.collect_list(geo.box("minx", "miny", "maxx", "maxy")[0]).alias("geom"))
    single = settle.to_single(many)
    parts = single.select("id", *geo.envelope("geom"))
    return parts.withColumn("part", (F.row_number().over(Window.partitionBy("id").orderBy("minx", "miny", "maxx", "maxy")) - 1).cast("long")).select("id", "part", "minx", "miny", "maxx", "maxy")


@query(W(i.SQL_FP) + "SELECT fid, CAST(1 AS INTEGER) AS rings, CAST(w*h AS DOUBLE) AS shell_area, CAST(w*h-(w-40)*(h-40) AS DOUBLE) AS holed_area FROM fp")
def remove_holes(spark: SparkSession, d: str) -> DataFrame:
    inner = geo.box_ring(F.col("minx") + 20, F.col("miny") + 20, F.col("maxx") - 20, F.col("maxy") - 20)
    f = i.footprints(spark, d).select("fid", F.array(F.array(geo.box_ring("minx", "miny", "maxx", "maxy"), inner)).alias("geom"))
    full = geo.remove_holes("geom")
    return f.select("fid", F.size(full[0]).alias("rings"), geo.area(full).alias("shell_area"), geo.area("geom").alias("holed_area"))


@query(W(i.SQL_FP) + "SELECT fid, round(6378137.0*6378137.0/2*abs(2*radians(w/1e6)*(sin(radians(maxy/1e6))-sin(radians(miny/1e6)))), 2) AS area_m2 FROM fp")
def spherical_area(spark: SparkSession, d: str) -> DataFrame:
    f = i.footprints(spark, d)
    g = geo.box(F.col("minx") / 1e6, F.col("miny") / 1e6, F.col("maxx") / 1e6, F.col("maxy") / 1e6)
    return f.select("fid", F.round(geo.spherical_area(g), 2).alias("area_m2"))


@query("SELECT s_suppkey AS id, s_name AS name, CAST(NULL AS VARCHAR) AS segment, 'supplier' AS source_merge FROM supplier UNION ALL SELECT c_custkey, c_name, c_mktsegment, 'customer' FROM customer")
def merge_layers(spark: SparkSession, d: str) -> DataFrame:
    layers = {
        "supplier": i.read(spark, d, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name")),
        "customer": i.read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment")),
    }
    return settle.merge_layers(layers).select("id", "name", "segment", "source_merge")


CORNERS = "(SELECT fid, minx//833 AS x0, maxx//833 AS x1, (400000-maxy)//833 AS y0, (400000-miny)//833 AS y1 FROM fp)"


@query(W(i.SQL_FP, i.SQL_CNT, "full9 AS (SELECT a.rx, a.ry FROM cnt a JOIN cnt b ON b.rx BETWEEN a.rx-1 AND a.rx+1 AND b.ry BETWEEN a.ry-1 AND a.ry+1 GROUP BY a.rx, a.ry HAVING count(*)=9)")
       + f"SELECT c.fid FROM {CORNERS} c WHERE NOT ((c.x0,c.y0) IN (SELECT (rx,ry) FROM full9) AND (c.x1,c.y0) IN (SELECT (rx,ry) FROM full9) AND (c.x0,c.y1) IN (SELECT (rx,ry) FROM full9) AND (c.x1,c.y1) IN (SELECT (rx,ry) FROM full9))")
def filter_using_raster(spark: SparkSession, d: str) -> DataFrame:
    return settle.outside_of(i.footprints(spark, d), raster.erode(i.counts(spark, d)), i.GRID, "fid").select("fid")


@query(W(i.SQL_FP) + "SELECT a.fid AS a, b.fid AS b FROM fp a JOIN fp b ON a.site=b.site AND a.fid<b.fid AND b.minx<=a.maxx+30 AND a.minx<=b.maxx+30 AND b.miny<=a.maxy+30 AND a.miny<=b.maxy+30")
def proximity_pairs(spark: SparkSession, d: str) -> DataFrame:
    return joins.proximity_pairs(i.footprints(spark, d), 30, 400)


@query("WITH RECURSIVE " + i.SQL_FP + """,
e AS (SELECT a.fid AS a, b.fid AS b FROM fp a JOIN fp b ON a.site=b.site AND a.fid<>b.fid AND b.minx<=a.maxx+30 AND a.minx<=b.maxx+30 AND b.miny<=a.maxy+30 AND a.miny<=b.maxy+30),
cc(id, low) USING KEY (id) AS (SELECT fid, fid FROM fp UNION
  SELECT n.id, n.low FROM (SELECT e.b AS id, min(c.low) AS low FROM cc c JOIN e ON e.a=c.id GROUP BY e.b) n JOIN recurring.cc r ON r.id=n.id WHERE n.low<r.low)
SELECT low AS group_id, count(*) AS poly_count, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM cc JOIN fp ON fp.fid=cc.id GROUP BY low""")
def group_near(spark: SparkSession, d: str) -> DataFrame:
    f = i.footprints(spark, d)
    g = joins.group_near(f, 30, 400).join(f, F.col("id") == F.col("fid"))
    return g.groupBy("group_id").agg(F.count("*").alias("poly_count"), F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


POINT_ZONE = "SELECT fid, min(z.id) AS id FROM fp JOIN z1 z ON 2*z.minx<=2*fp.minx+w AND 2*fp.minx+w<=2*z.maxx AND 2*z.miny<=2*fp.miny+h AND 2*fp.miny+h<=2*z.maxy GROUP BY fid"


@query(W(i.SQL_FP, i.SQL_Z1) + POINT_ZONE)
def point_in_slice(spark: SparkSession, d: str) -> DataFrame:
    p = i.footprints(spark, d).select("fid", (F.col("minx") + F.col("w") / 2).alias("x"), (F.col("miny") + F.col("h") / 2).alias("y"), "rx", "ry")
    return settle.point_in_slice(p, settle.slice_boxes(i.zones1(spark, d), i.GRID))


@query(W(i.SQL_FP, i.SQL_Z2) .replace(i.SQL_Z2, i.SQL_Z1 + ",\n" + i.SQL_Z2) + "SELECT fid, min(z.id) AS set_orig_fid FROM fp LEFT JOIN z2 z ON z.minx<=fp.maxx AND fp.minx<=z.maxx AND z.miny<=fp.maxy AND fp.miny<=z.maxy GROUP BY fid")
def bldg_settlement_join(spark: SparkSession, d: str) -> DataFrame:
    return settle.assign(i.footprints(spark, d), settle.slice_boxes(i.zones2(spark, d), i.GRID), size=1666)


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_FAC) + """SELECT rx, ry, n.place_id, n.d2 FROM (SELECT rx, ry, min({'d2': (1666*rx+833-2*px)*(1666*rx+833-2*px)+(800000-1666*ry-833-2*py)*(800000-1666*ry-833-2*py), 'place_id': place_id}) AS n FROM cnt, fac GROUP BY rx, ry)""")
def nearest_facility(spark: SparkSession, d: str) -> DataFrame:
    # in half units, so that centres are integers
    p = i.counts(spark, d).select((F.col("rx") * 529 + F.col("ry") * 1_000_000).alias("id"), "rx", "ry", (F.col("rx") * 1666 + 833).alias("x"), (F.lit(800_000) - F.col("ry") * 1666 - 833).alias("y"))
    places = i.facilities(spark, d).select("place_id", (F.col("px") * 2).alias("px"), (F.col("py") * 2).alias("py"))
    return joins.nearest(p, places, 20_000).join(p, "id").select("rx", "ry", "place_id", "d2")


# two generations ---------------------------------------------------------------------------------
CENTRES = "{0} AS (SELECT id, (minx+maxx)//1666 AS rx, (800000-(miny+maxy))//1666 AS ry FROM {1})"
# ids of a multiple of 11 are left off the rasters, as areas too small for any cell centre would be
SHOWN = "{0} AS (SELECT * FROM {1} WHERE id%11<>0)"
SQ = [i.SQL_FP, i.SQL_Z1, i.SQL_Z2, Z1C, Z2C, SHOWN.format("s1", "c1"), SHOWN.format("s2", "c2"), CENTRES.format("f1", "z1"), CENTRES.format("f2", "z2"),
      "m1 AS (SELECT rx, ry, max(id) AS id FROM f1 WHERE id NOT IN (SELECT id FROM s1) GROUP BY rx, ry)", "m2 AS (SELECT rx, ry, max(id) AS id FROM f2 WHERE id NOT IN (SELECT id FROM s2) GROUP BY rx, ry)",
      "g1 AS (SELECT rx, ry, max(id) AS id FROM s1 GROUP BY rx, ry)", "g2 AS (SELECT rx, ry, max(id) AS id FROM s2 GROUP BY rx, ry)",
      "sq AS (SELECT rx, ry, coalesce(m1.id, g1.id) AS year1_id, coalesce(m2.id, g2.id) AS year2_id FROM g1 FULL JOIN m1 USING (rx, ry) FULL JOIN g2 USING (rx, ry) FULL JOIN m2 USING (rx, ry))"]


def _centres(z: DataFrame) -> DataFrame:
    return z.select("id", F.expr("(minx+maxx) div 1666").alias("rx"), F.expr("(800000-(miny+maxy)) div 1666").alias("ry"))


def _shown(spark: SparkSession, d: str, year: int) -> DataFrame:
    z = i.zones1(spark, d) if year == 1 else i.zones2(spark, d)
    return raster.rasterize_boxes(z, i.GRID).where("id % 11 <> 0")


def _missing(spark: SparkSession, d: str, year: int) -> DataFrame:
    return compare.missing_ids(_centres(i.zones1(spark, d) if year == 1 else i.zones2(spark, d)), _shown(spark, d, year))


def _squares(spark: SparkSession, d: str) -> DataFrame:
    return compare.squares(_shown(spark, d, 1), _shown(spark, d, 2), _missing(spark, d, 1), _missing(spark, d, 2))


def compared(spark: SparkSession, d: str) -> DataFrame:
    """The squares, written once for all that is derived from them."""
    return materialize(_squares(spark, d))


@query(W(*SQ) + "SELECT * FROM sq")
def squares(spark: SparkSession, d: str) -> DataFrame:
    return _squares(spark, d)


@query(W(*SQ) + "SELECT 1 AS year, id, rx, ry FROM m1 UNION ALL SELECT 2, id, rx, ry FROM m2")
def missing_ids(spark: SparkSession, d: str) -> DataFrame:
    tag = lambda y: _missing(spark, d, y).select(F.lit(y).alias("year"), "id", "rx", "ry")
    return tag(1).unionByName(tag(2))


@query(W(*SQ) + "SELECT DISTINCT id FROM s1")
def distinct_ids(spark: SparkSession, d: str) -> DataFrame:
    return _shown(spark, d, 1).select("id").distinct()


@query(W(*SQ) + "SELECT year1_id, count(*) AS cnt FROM sq GROUP BY year1_id")
def id_lookup_y1(spark: SparkSession, d: str) -> DataFrame:
    return compare.id_lookup(_squares(spark, d), 1)


@query(W(*SQ) + "SELECT year2_id, count(*) AS cnt FROM sq GROUP BY year2_id")
def id_lookup_y2(spark: SparkSession, d: str) -> DataFrame:
    return compare.id_lookup(_squares(spark, d), 2)


@query(W(*SQ) + "SELECT year1_id, count(DISTINCT year2_id) AS overlaps FROM sq GROUP BY year1_id")
def id_overlap_y1(spark: SparkSession, d: str) -> DataFrame:
    return compare.id_overlap(_squares(spark, d), 1)


@query(W(*SQ) + "SELECT year2_id, count(DISTINCT year1_id) AS overlaps FROM sq GROUP BY year2_id")
def id_overlap_y2(spark: SparkSession, d: str) -> DataFrame:
    return compare.id_overlap(_squares(spark, d), 2)


@query(W(*SQ, "l1 AS (SELECT year1_id, count(*) AS n FROM sq GROUP BY 1)", "l2 AS (SELECT year2_id, count(*) AS n, count(DISTINCT year1_id) AS o FROM sq GROUP BY 1)", "pp AS (SELECT year2_id, year1_id, count(*) AS cnt FROM sq GROUP BY ALL)")
       + """SELECT coalesce(CAST(pp.year2_id AS VARCHAR),'NA')||'_'||coalesce(CAST(pp.year1_id AS VARCHAR),'NA') AS pair_key, cnt, pp.year2_id, pp.year1_id, l2.n AS y2_count, l1.n AS y1_count, l2.o AS y2_overlaps,
       round(CAST(100.0 AS DOUBLE)*cnt/l2.n,2) AS y2_ratio, round(CAST(100.0 AS DOUBLE)*cnt/l1.n,2) AS y1_ratio FROM pp LEFT JOIN l2 ON pp.year2_id=l2.year2_id LEFT JOIN l1 ON pp.year1_id=l1.year1_id""")  # fmt: skip
def id_main(spark: SparkSession, d: str) -> DataFrame:
    return compare.id_main(_squares(spark, d))


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS, "own AS (SELECT site AS id, count(*) AS n FROM fp GROUP BY site)") + "SELECT coalesce(lv.id, own.id) AS id, bldg_count, n FROM lv FULL JOIN own ON lv.id=own.id WHERE coalesce(bldg_count,-1)<>coalesce(n,-2)")
def full_outer_mismatch(spark: SparkSession, d: str) -> DataFrame:
    own = i.footprints(spark, d).groupBy(F.col("site").alias("id")).agg(F.count("*").alias("n"))
    both = levels(spark, d).select("id", "bldg_count").join(own, "id", "full_outer")
    return both.where("coalesce(bldg_count, -1) <> coalesce(n, -2)").select("id", "bldg_count", "n")


# rasters --------------------------------------------------------------------------------------------
@query(W(i.SQL_PARTS) + "SELECT CAST(sum(v) AS BIGINT) AS total FROM parts WHERE v>=0")
def raster_sum(spark: SparkSession, d: str) -> DataFrame:
    cells = spark.range(i.GRID.cols * i.GRID.rows).select((F.col("id") % i.GRID.cols).alias("rx"), F.expr(f"id div {i.GRID.cols}").alias("ry"))
    dense = cells.join(i.parts(spark, d), ["rx", "ry"], "left").select(F.coalesce("v", F.lit(-9999)).alias("v"))
    return raster.raster_sum(dense, -9999)


TWO = "t AS (SELECT rx, ry, cnt.v AS l, parts.v AS r FROM cnt FULL JOIN parts USING (rx, ry))"


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO) + "SELECT CAST(sum(coalesce(l,0)) AS BIGINT) AS sum_left, CAST(sum(coalesce(r,0)) AS BIGINT) AS sum_right, CAST(sum(abs(coalesce(r,0)-coalesce(l,0))) AS BIGINT) AS sum_abs_diff, CAST(abs(sum(coalesce(l,0))-sum(coalesce(r,0))) AS BIGINT) AS abs_sum_diff FROM t")
def raster_stats(spark: SparkSession, d: str) -> DataFrame:
    return raster.two_raster_stats(i.counts(spark, d), i.parts(spark, d))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO) + "SELECT rx, ry, CAST(l AS DOUBLE)/r AS v FROM t WHERE l IS NOT NULL AND r<>0")
def ratio_raster(spark: SparkSession, d: str) -> DataFrame:
    return raster.ratio(i.counts(spark, d), i.parts(spark, d))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO) + "SELECT rx, ry, coalesce(l,0)-coalesce(r,0) AS v FROM t WHERE NOT ((l IS NULL OR l=0) AND (r IS NULL OR r=0))")
def diff_raster(spark: SparkSession, d: str) -> DataFrame:
    return raster.diff(i.counts(spark, d), i.parts(spark, d))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO) + "SELECT rx, ry, coalesce(l,0)+coalesce(r,0) AS v FROM t")
def combine_add(spark: SparkSession, d: str) -> DataFrame:
    return raster.add(i.counts(spark, d), i.parts(spark, d))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO) + "SELECT rx, ry, l AS v FROM t WHERE l IS NOT NULL AND r IS NOT NULL")
def set_no_data(spark: SparkSession, d: str) -> DataFrame:
    return raster.keep_where_data(i.counts(spark, d), i.parts(spark, d))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO) + "SELECT rx, ry, l AS v FROM t WHERE l IS NOT NULL AND r IS NULL")
def set_nodata_if_rhs(spark: SparkSession, d: str) -> DataFrame:
    return raster.keep_where_no_data(i.counts(spark, d), i.parts(spark, d))


@query(W(i.SQL_FP, i.SQL_CNT, """o AS (SELECT v, 2*x AS tx, 2*y AS ty, CAST(least(833, 1250*(x+1)-833*rx) - greatest(0, 1250*x-833*rx) AS DOUBLE) * (least(833, 1250*(y+1)-833*ry) - greatest(0, 1250*y-833*ry)) / (833*833) AS share, x AS cx, y AS cy
  FROM (SELECT *, unnest(range(833*rx//1250, (833*rx+832)//1250+1)) AS x FROM cnt) a, LATERAL (SELECT unnest(range(833*a.ry//1250, (833*a.ry+832)//1250+1)) AS y) b)""") + "SELECT cx AS rx, cy AS ry, round(sum(v*share), 6) AS v FROM o WHERE share>=1e-6 AND cx<353 AND cy<321 GROUP BY ALL")
def resample(spark: SparkSession, d: str) -> DataFrame:
    target = GridSpec(0, 400_000, 1250, -1250, 353, 321)
    return raster.resample(i.counts(spark, d), i.GRID, target).select("rx", "ry", F.round("v", 6).alias("v"))


@query(W(i.SQL_FP, i.SQL_CNT) + "SELECT a.rx, a.ry FROM cnt a JOIN cnt b ON b.rx BETWEEN a.rx-1 AND a.rx+1 AND b.ry BETWEEN a.ry-1 AND a.ry+1 GROUP BY a.rx, a.ry HAVING count(*)=9")
def erode3x3(spark: SparkSession, d: str) -> DataFrame:
    return raster.erode(i.counts(spark, d))


@query("WITH RECURSIVE " + i.SQL_FP + ",\n" + i.SQL_CNT + """,
mk AS (SELECT rx, ry FROM cnt UNION ALL SELECT -1, range FROM range(481) UNION ALL SELECT 529, range FROM range(481)),
gaps AS (SELECT * FROM (SELECT ry, rx+1 AS x0, lead(rx) OVER (PARTITION BY ry ORDER BY rx)-1 AS x1 FROM mk) WHERE x0<=x1),
reach AS (SELECT ry, x0, x1 FROM gaps WHERE ry=0 UNION SELECT g.ry, g.x0, g.x1 FROM reach r JOIN gaps g ON abs(g.ry-r.ry)=1 AND g.x0<=r.x1+1 AND r.x0<=g.x1+1)
SELECT rx, ry FROM cnt UNION ALL SELECT unnest(range(x0,x1+1)) AS rx, ry FROM (SELECT * FROM gaps EXCEPT SELECT * FROM (SELECT ry, x0, x1 FROM reach))""")
def flood_fill(spark: SparkSession, d: str) -> DataFrame:
    return raster.flood_fill(i.counts(spark, d), i.GRID)


@query(W(i.SQL_FP, i.SQL_CNT, "sd AS (SELECT rx+a AS x0, ry+b AS y0, rx+c AS x1, ry+d AS y1 FROM cnt, (VALUES (0,0,1,0),(0,1,1,1),(0,0,0,1),(1,0,1,1)) s(a,b,c,d))") + "SELECT x0, y0, x1, y1 FROM sd GROUP BY ALL HAVING count(*)=1")
def polygonize_edges(spark: SparkSession, d: str) -> DataFrame:
    return raster.boundary_edges(i.counts(spark, d).withColumn("v", F.lit(1))).drop("v")


_CUT = "CASE WHEN {1}={0} THEN 0.5 ELSE least(greatest((12.0-{0})/({1}-{0}),0.0),1.0) END"


def segments_sql(cells: str, cols: int = 529, rows: int = 481) -> str:
    """Segments from runs of outside corners: clockwise (UL, UR, LR, LL), a run k..m has its line from side m to side k-1 of (N, E, S, W)."""
    return f"""sq AS (SELECT x AS rx, y AS ry, CAST(coalesce(a.v,0) AS DOUBLE) AS a, CAST(coalesce(b.v,0) AS DOUBLE) AS b, CAST(coalesce(c.v,0) AS DOUBLE) AS c, CAST(coalesce(d.v,0) AS DOUBLE) AS d
  FROM (SELECT x, unnest(range({rows - 1})) AS y FROM (SELECT unnest(range({cols - 1})) AS x)) g LEFT JOIN {cells} a ON a.rx=x AND a.ry=y LEFT JOIN {cells} b ON b.rx=x+1 AND b.ry=y LEFT JOIN {cells} c ON c.rx=x+1 AND c.ry=y+1 LEFT JOIN {cells} d ON d.rx=x AND d.ry=y+1),
kk AS (SELECT *, (a>12)::INTEGER*8+(b>12)::INTEGER*4+(c>12)::INTEGER*2+(d>12)::INTEGER AS raw FROM sq),
k AS (SELECT *, CASE WHEN raw<15 THEN raw WHEN rx=0 THEN 6 WHEN rx={cols - 2} THEN 9 WHEN ry=0 THEN 3 WHEN ry={rows - 2} THEN 12 ELSE 15 END AS kase FROM kk),
f AS (SELECT rx, ry, kase, [kase//8%2, kase//4%2, kase//2%2, kase%2] AS c, [rx+{_CUT.format('a', 'b')}, rx+1.0, rx+{_CUT.format('d', 'c')}, rx+0.0] AS sx, [ry+0.0, ry+{_CUT.format('b', 'c')}, ry+1.0, ry+{_CUT.format('a', 'd')}] AS sy FROM k WHERE kase BETWEEN 1 AND 14),
r AS (SELECT *, CASE WHEN c[(k0+1)%4+1]=1 THEN k0 WHEN c[(k0+2)%4+1]=1 THEN k0+1 ELSE k0+2 END%4 AS m FROM (SELECT *, unnest(range(4)) AS k0 FROM f) WHERE c[k0+1]=0 AND c[(k0+3)%4+1]=1)
SELECT rx, ry, CAST(kase AS INTEGER) AS kase, CAST(row_number() OVER (PARTITION BY rx, ry ORDER BY k0)-1 AS INTEGER) AS seg, CAST(sx[m+1] AS DOUBLE) AS x0, CAST(sy[m+1] AS DOUBLE) AS y0, CAST(sx[(k0+3)%4+1] AS DOUBLE) AS x1, CAST(sy[(k0+3)%4+1] AS DOUBLE) AS y1 FROM r"""


@query(W(i.SQL_FP, i.SQL_CNT, segments_sql("cnt")))
def contour_segments(spark: SparkSession, d: str) -> DataFrame:
    return raster.contour_segments(i.counts(spark, d), i.GRID, 12)


SQL_SOLID = "solid AS (SELECT rx, ry, CAST(20 AS BIGINT) AS v FROM (SELECT unnest(range(40)) AS rx), (SELECT unnest(range(50)) AS ry) UNION ALL SELECT rx, ry, v+13 FROM cnt WHERE rx>=40 OR ry>=50)"


@query(W(i.SQL_FP, i.SQL_CNT, SQL_SOLID, segments_sql("solid")))
def contour_border(spark: SparkSession, d: str) -> DataFrame:
    """A solid block in the corner of the grid, and single cells elsewhere."""
    solid = spark.range(2000).select((F.col("id") % 40).alias("rx"), F.expr("id div 40").alias("ry"), F.lit(20).cast("long").alias("v"))
    rest = i.counts(spark, d).where("rx >= 40 or ry >= 50").select("rx", "ry", F.col("v") + 13)
    return raster.contour_segments(solid.union(rest), i.GRID, 12)


SQL_FRAMED = "framed AS (SELECT x AS rx, y AS ry, CASE WHEN x IN (0,528) OR y IN (0,480) THEN 12+1e-9 ELSE CAST(v AS DOUBLE) END AS v FROM (SELECT x, unnest(range(481)) AS y FROM (SELECT unnest(range(529)) AS x)) LEFT JOIN cnt ON rx=x AND ry=y WHERE v IS NOT NULL OR x IN (0,528) OR y IN (0,480))"


@query(W(i.SQL_FP, i.SQL_CNT, SQL_FRAMED) + "SELECT rx, ry, v FROM framed")
def framed(spark: SparkSession, d: str) -> DataFrame:
    return raster.framed(i.counts(spark, d), i.GRID, 12)


@query(W(i.SQL_FP, i.SQL_CNT, SQL_FRAMED, segments_sql("framed")))
def framed_contour(spark: SparkSession, d: str) -> DataFrame:
    return raster.contour_segments(raster.framed(i.counts(spark, d), i.GRID, 12), i.GRID, 12)


@query(W(i.SQL_FP, i.SQL_Z1) + """SELECT id, rx, ry, 2*(least(maxx, 833*(rx+1))-greatest(minx, 833*rx)) * (least(maxy, 400000-833*ry)-greatest(miny, 400000-833*(ry+1))) AS area2 FROM (SELECT *, unnest(range((400000-maxy)//833, (400000-miny)//833+1)) AS ry FROM (SELECT *, unnest(range(minx//833, maxx//833+1)) AS rx FROM z1))
WHERE least(maxx, 833*(rx+1))>greatest(minx, 833*rx) AND least(maxy, 400000-833*ry)>greatest(miny, 400000-833*(ry+1))""")
def grid_slice(spark: SparkSession, d: str) -> DataFrame:
    s = settle.slice_boxes(i.zones1(spark, d), i.GRID)
    return s.select("id", "rx", "ry", (2 * (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))).alias("area2"))


@query(W(i.SQL_FP, i.SQL_Z1, "pz AS (" + POINT_ZONE + ")", "cl AS (SELECT DISTINCT z1.id, rx, ry, greatest(z1.minx, 833*rx) AS ax, least(z1.maxx, 833*(rx+1)) AS bx, greatest(z1.miny, 400000-833*(ry+1)) AS ay, least(z1.maxy, 400000-833*ry) AS cy FROM pz JOIN fp USING (fid) JOIN z1 ON z1.id=pz.id)")
       + """SELECT id, rx, ry, CAST(CASE WHEN 2*833*(rx+1)-(ax+bx) < (ax+bx)-2*833*rx THEN (CASE WHEN 2*(400000-833*ry)-(ay+cy) < (ay+cy)-2*(400000-833*(ry+1)) THEN 0 ELSE 1 END)
  ELSE (CASE WHEN 2*(400000-833*ry)-(ay+cy) < (ay+cy)-2*(400000-833*(ry+1)) THEN 3 ELSE 2 END) END AS INTEGER) AS corner FROM cl
  WHERE NOT (2*ax<=1666*rx+833 AND 1666*rx+833<=2*bx AND 2*ay<=800000-1666*ry-833 AND 800000-1666*ry-833<=2*cy)""")  # fmt: skip
def centre_check(spark: SparkSession, d: str) -> DataFrame:
    p = i.footprints(spark, d).select("fid", (F.col("minx") + F.col("w") / 2).alias("x"), (F.col("miny") + F.col("h") / 2).alias("y"), "rx", "ry")
    return settle.centre_check(p, settle.slice_boxes(i.zones1(spark, d), i.GRID), i.GRID)


CORNER_COUNTS = ORACLE_SQL["centre_check"]


@query(f"SELECT id, rx, ry, corner, CAST(7 AS INTEGER) AS vertices, CAST(833*(rx+CASE WHEN corner<2 THEN 1 ELSE 0 END) AS DOUBLE) AS corner_x, CAST(400000-833*(ry+CASE WHEN corner IN (1,2) THEN 1 ELSE 0 END) AS DOUBLE) AS corner_y FROM ({CORNER_COUNTS})")
def corner_shapes(spark: SparkSession, d: str) -> DataFrame:
    c = centre_check(spark, d).withColumn("geom", settle.corner_shape(i.GRID))
    first = F.col("geom")[0][0][0]
    return c.select("id", "rx", "ry", "corner", F.size(F.col("geom")[0][0]).alias("vertices"), first["x"].alias("corner_x"), first["y"].alias("corner_y"))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS, TWO, "df AS (SELECT CAST(coalesce(l,0)-coalesce(r,0) AS DOUBLE) AS v FROM t WHERE abs(coalesce(l,0)-coalesce(r,0))>1)", "ls AS (SELECT CAST(sign(v) AS INTEGER) AS sign, list(v ORDER BY v) AS vs, count(*) AS n, least(155, count(*)) AS k FROM df GROUP BY sign)")
       + """SELECT sign, CAST(b AS INTEGER) AS bin, CASE WHEN sign<0 THEN vs[CAST(floor(b/k*(n-1)) AS BIGINT)+1] ELSE vs[CAST(least(ceil(b/k*greatest(n-2,0))+1, n-1) AS BIGINT)+1] END AS upper, CAST(CASE WHEN sign<0 THEN 255-b ELSE 255-k+b END AS INTEGER) AS alpha
  FROM (SELECT *, unnest(range(k)) AS b FROM ls)""")  # fmt: skip
def color_ramp(spark: SparkSession, d: str) -> DataFrame:
    return raster.color_ramp(raster.diff(i.counts(spark, d), i.parts(spark, d)))


# kernels: SQL has no counterpart, tests hold them against points, areas and invariants -------------------
def _shapes(spark: SparkSession, d: str) -> DataFrame:
    """Footprints as octagons with integer vertices, in micro-degrees."""
    f = i.footprints(spark, d)
    a, b, c, e = (F.col(n) for n in ("minx", "miny", "maxx", "maxy"))
    corners = [(a + 20, b), (c - 20, b), (c, b + 20), (c, e - 20), (c - 20, e), (a + 20, e), (a, e - 20), (a, b + 20), (a + 20, b)]
    return f.select("fid", "site", F.array(F.array(F.array(*[geo.point(x, y) for x, y in corners]))).alias("geom"))


@query(W(i.SQL_FP) + "SELECT fid, fid AS orig_fid, CAST(2 AS INTEGER) AS polys, CAST(w*h AS DOUBLE)/2 AS area FROM fp")
def fix_geom(spark: SparkSession, d: str) -> DataFrame:
    """Each footprint as a bow tie, which repair turns into two triangles."""
    a, b, c, e = (F.col(n) for n in ("minx", "miny", "maxx", "maxy"))
    bow = F.array(F.array(F.array(geo.point(a, b), geo.point(c, e), geo.point(c, b), geo.point(a, e), geo.point(a, b))))
    fixed = vector.fix_geom(i.footprints(spark, d).select("fid", bow.alias("geom")))
    return fixed.select("fid", "orig_fid", F.size("geom").alias("polys"), F.round(geo.area("geom"), 3).alias("area"))


@query()
def buffer_m(spark: SparkSession, d: str) -> DataFrame:
    degrees = vector.transform("geom", lambda x, y: (x / 1e6 + 3, y / 1e6 + 6))
    out = vector.buffer_metres(_shapes(spark, d).withColumn("geom", degrees), 50, 2)
    return out.select("fid", F.size("geom").alias("polys"), F.round(geo.spherical_area("geom"), 1).alias("area_m2"))


@query()
def dissolve(spark: SparkSession, d: str) -> DataFrame:
    out = vector.dissolve(_shapes(spark, d), 800, no_holes=True)
    return out.select("orig_fid", "n", F.size("geom").alias("polys"), F.round(geo.area("geom"), 1).alias("area"))


@query()
def fill_centres(spark: SparkSession, d: str) -> DataFrame:
    out = vector.fill_centres(vector.group_members(_shapes(spark, d), 30, 400), i.GRID, 400)
    return out.select("id", "poly_count", F.size("geom").alias("polys"), F.round(geo.area("geom"), 1).alias("area"))


@query()
def contour_rings(spark: SparkSession, d: str) -> DataFrame:
    out = vector.contour_rings(i.counts(spark, d), i.GRID, 12, pad=True)
    return out.select("is_hole", F.round(geo.area("geom"), 3).alias("area"), F.round("minx", 6).alias("minx"), F.round("miny", 6).alias("miny"))


@query()
def proj_accuracy(spark: SparkSession, d: str) -> DataFrame:
    z = i.zones1(spark, d).agg(F.min("minx").alias("a"), F.min("miny").alias("b"), F.max("maxx").alias("c"), F.max("maxy").alias("e")).first()
    return settle.projection_accuracy(spark, z["a"] / 1e6 + 3, z["b"] / 1e6 + 6, z["c"] / 1e6 + 3, z["e"] / 1e6 + 6)


from geoloom.plans import shape_queries  # noqa: E402, F401  registers its queries
