"""Queries on polygons, files and neighbours, with their oracle SQL; imported by the registry.

The polygons are right triangles with legs of one width or six, the right angle at the lower right: a point
(x, y) is inside from y0 up to y0 + x - x0. Their areas, cuts and meetings have closed forms in SQL.
"""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions import pairs
from geoloom.operators import compare, joins, raster, settle, vector
from geoloom.plans import inputs as i
from geoloom.plans.materialize import shared_dir
from geoloom.plans.registry import CORNER_COUNTS, LEVELS, SQ, W, Z1C, ZONAL, centre_check, compared, levels, query, segments_sql, zonal_stats
from geoloom.sources import layers

SQL_TRI = "tri AS (SELECT fid, CAST(minx AS DOUBLE) AS x0, miny+0.25 AS y0, CAST(6*w AS DOUBLE) AS s FROM fp)"
SQL_SMALL = SQL_TRI.replace("6*w", "w")
# area under the slope from 0 to t, at most h high
_UNDER = "CASE WHEN {0}<=0 THEN 0.0 WHEN {0}<={1} THEN {0}*{0}/2 ELSE {1}*{1}/2+{1}*({0}-{1}) END"
SQL_CUT = f"""cut AS (SELECT *, {_UNDER.format('t1', 'h')}-{_UNDER.format('t0', 'h')} AS area FROM (
  SELECT fid, rx, ry, x0, y0, s, y0+greatest(x0, 833.0*rx)-x0-greatest(y0, 400000.0-833*(ry+1)) AS t0, y0+least(x0+s, 833.0*(rx+1))-x0-greatest(y0, 400000.0-833*(ry+1)) AS t1, 400000.0-833*ry-greatest(y0, 400000.0-833*(ry+1)) AS h
  FROM (SELECT *, unnest(range(CAST(floor((400000-y0-s)/833) AS BIGINT), CAST(floor((400000-y0)/833) AS BIGINT)+1)) AS ry FROM (SELECT *, unnest(range(CAST(floor(x0/833) AS BIGINT), CAST(floor((x0+s)/833) AS BIGINT)+1)) AS rx FROM tri))))"""
_IN = "({0}>x0 AND {0}<x0+s AND {1}>y0 AND {1}-y0<{0}-x0)"
SQL_PAIRS = """pr AS (SELECT a.fid AS a, b.fid AS b, a.x0 AS ax, a.y0 AS ay, a.s AS sa, b.x0 AS bx, b.y0 AS byy, b.s AS sb FROM tri a JOIN tri b ON a.fid<b.fid AND a.x0<=b.x0+b.s AND b.x0<=a.x0+a.s AND a.y0<=b.y0+b.s AND b.y0<=a.y0+a.s
  WHERE greatest(a.y0,b.y0)<=least(a.y0-a.x0,b.y0-b.x0)+least(a.x0+a.s,b.x0+b.s))"""
SIZE = 500


def triangles(spark: SparkSession, d: str, widths: int = 6) -> DataFrame:
    f = i.footprints(spark, d)
    x, y, s = F.col("minx").cast("double"), F.col("miny") + F.lit(0.25), widths * F.col("w")
    ring = F.array(geo.point(x, y), geo.point(x + s, y), geo.point(x + s, y + s), geo.point(x, y))
    return vector.with_envelope(f.select("fid", F.array(F.array(ring)).alias("geom")))


@query(W(i.SQL_FP, SQL_TRI, SQL_CUT) + "SELECT fid AS id, rx, ry, round(area, 3) AS area FROM cut WHERE area>0")
def grid_slice_polygons(spark: SparkSession, d: str) -> DataFrame:
    out = vector.grid_slice(triangles(spark, d), i.GRID, "fid")
    return out.select("id", "rx", "ry", F.round(geo.area("geom"), 3).alias("area")).where("area > 0")


@query(W(i.SQL_FP, SQL_TRI, SQL_CUT) + f"SELECT fid AS id, rx, ry FROM cut WHERE rx BETWEEN 0 AND 528 AND ry BETWEEN 0 AND 480 AND {_IN.format('(833*rx+416.5)', '(400000-833*ry-416.5)')}")
def rasterize_polygons(spark: SparkSession, d: str) -> DataFrame:
    return vector.rasterize(triangles(spark, d), i.GRID, "fid")


@query(W(i.SQL_FP, SQL_TRI, SQL_CUT) + "SELECT fid AS id, rx, ry FROM cut WHERE area>0 AND rx BETWEEN 0 AND 528 AND ry BETWEEN 0 AND 480")
def rasterize_touched(spark: SparkSession, d: str) -> DataFrame:
    return vector.rasterize(triangles(spark, d), i.GRID, "fid", all_touched=True)


@query(W(i.SQL_FP, SQL_TRI, SQL_CUT) + f"""SELECT rx, ry, arg_max(CAST(s AS BIGINT), fid) AS v FROM cut WHERE rx BETWEEN 0 AND 528 AND ry BETWEEN 0 AND 480 AND {_IN.format('(833*rx+416.5)', '(400000-833*ry-416.5)')} GROUP BY rx, ry""")
def burn_field(spark: SparkSession, d: str) -> DataFrame:
    """The width of the last triangle over each cell's centre."""
    wide = triangles(spark, d).withColumn("width", (F.col("maxx") - F.col("minx")).cast("long"))
    return vector.burn_field(wide, i.GRID, "width", "fid")


@query(W(i.SQL_FP, SQL_TRI, SQL_CUT) + f"""SELECT DISTINCT cut.fid AS id, cut.rx, cut.ry FROM cut JOIN fp ON fp.rx=cut.rx AND fp.ry=cut.ry
  WHERE area>0 AND {_IN.format('(fp.minx+fp.w/2.0+0.0625)', '(fp.miny+fp.h/2.0-0.125)')} AND NOT {_IN.format('(833*cut.rx+416.5)', '(400000-833*cut.ry-416.5)')}""")
def centre_check_polygons(spark: SparkSession, d: str) -> DataFrame:
    points = i.footprints(spark, d).select((F.col("minx") + F.col("w") / 2 + 0.0625).alias("x"), (F.col("miny") + F.col("h") / 2 - 0.125).alias("y"), "rx", "ry")
    return vector.centre_check(points, vector.grid_slice(triangles(spark, d), i.GRID, "fid"), i.GRID).select("id", "rx", "ry")


@query(W(i.SQL_FP, SQL_SMALL) + """SELECT f.fid, m.set_orig_fid FROM fp f LEFT JOIN (SELECT f.fid, min(t.fid) AS set_orig_fid FROM fp f JOIN tri t ON f.minx<=t.x0+t.s AND f.maxx>=t.x0 AND f.miny<=t.y0+t.s AND f.maxy>=t.y0
  WHERE greatest(f.miny, t.y0)-t.y0<=least(f.maxx, t.x0+t.s)-t.x0 GROUP BY f.fid) m USING (fid)""")
def bldg_polygon_join(spark: SparkSession, d: str) -> DataFrame:
    boxes = i.footprints(spark, d).select("fid", *joins.ENVELOPE, geo.box("minx", "miny", "maxx", "maxy").alias("geom"))
    met = joins.least_met(boxes.withColumnRenamed("fid", "id"), triangles(spark, d, 1).withColumnRenamed("fid", "id"), SIZE)
    return boxes.select("fid").join(met.select(F.col("id").alias("fid"), F.col("least").alias("set_orig_fid")), "fid", "left")


def _met(spark: SparkSession, d: str, measure=None, schema: str = "") -> DataFrame:
    t = triangles(spark, d, 1).withColumnRenamed("fid", "id")
    return joins.block_pairs(t, None, SIZE, measure=measure, schema=schema).withColumnsRenamed({"l_id": "a", "r_id": "b"})


@query(W(i.SQL_FP, SQL_SMALL, SQL_PAIRS) + "SELECT a, b FROM pr")
def intersects_pairs(spark: SparkSession, d: str) -> DataFrame:
    return _met(spark, d)


_COVER = "({0}x<={1} AND {1}+{2}<={0}x+{3} AND {0}y<={4} AND {4}-{0}y<={1}-{0}x)"


@query(W(i.SQL_FP, SQL_SMALL, SQL_PAIRS, """cv AS (SELECT *, bx>=ax AND bx+sb<=ax+sa AND byy>=ay AND byy-ay<=bx-ax AS ab, ax>=bx AND ax+sa<=bx+sb AND ay>=byy AND ay-byy<=ax-bx AS ba, greatest(ay,byy)<least(ay-ax,byy-bx)+least(ax+sa,bx+sb) AS inner_meet,
  bx>ax AND bx+sb<ax+sa AND byy>ay AND byy-ay<bx-ax AS deep FROM pr)""") + "SELECT a, b, ab AS covers, ba AS covered_by, NOT inner_meet AS touches, inner_meet AND NOT ab AND NOT ba AS overlaps, deep AS contains_properly, false AS crosses FROM cv")
def predicates(spark: SparkSession, d: str) -> DataFrame:
    return _met(spark, d, pairs.predicates, "".join(f", {p} boolean" for p in pairs.PREDICATES))


@query(W(i.SQL_FP, SQL_SMALL, SQL_PAIRS, "ar AS (SELECT *, pow(least(ay-ax,byy-bx)+least(ax+sa,bx+sb)-greatest(ay,byy), 2)/2 AS both_area FROM pr)") + "SELECT a, b, round(both_area, 1) AS both_area, round(sa*sa/2-both_area, 1) AS left_only FROM ar")
def overlay_areas(spark: SparkSession, d: str) -> DataFrame:
    """What two triangles that meet share is such a triangle again."""
    met = _met(spark, d, pairs.overlay_areas, ", both_area double, left_only double")
    return met.select("a", "b", F.round("both_area", 1).alias("both_area"), F.round("left_only", 1).alias("left_only"))


@query(W(i.SQL_FP) + "SELECT fid, CAST(greatest(w*h, 18*w*w) AS DOUBLE) AS area FROM fp")
def largest_polygon(spark: SparkSession, d: str) -> DataFrame:
    boxes = i.footprints(spark, d).select("fid", geo.box("minx", "miny", "maxx", "maxy").alias("box"))
    both = boxes.join(triangles(spark, d).select("fid", "geom"), "fid").select("fid", F.concat("box", "geom").alias("geom"))
    return both.select("fid", F.round(geo.area(vector.largest_polygon("geom")), 3).alias("area"))


@query(W(i.SQL_FP) + "SELECT fid, CAST(CASE WHEN fid%2=1 THEN 6 ELSE 5 END AS INTEGER) AS vertices, CAST(w*h+CASE WHEN fid%2=1 THEN w*5 ELSE 0 END AS DOUBLE) AS area FROM fp")
def simplify(spark: SparkSession, d: str) -> DataFrame:
    """Boxes with a dent in the lower side, 10 deep for odd ids and 4 for even ones; the tolerance is 8."""
    a, b, c, e = (F.col(n).cast("double") for n in ("minx", "miny", "maxx", "maxy"))
    deep = F.when(F.col("fid") % 2 == 1, 10.0).otherwise(4.0)
    ring = F.array(geo.point(a, b), geo.point((a + c) / 2, b - deep), geo.point(c, b), geo.point(c, e), geo.point(a, e), geo.point(a, b))
    out = vector.simplify(i.footprints(spark, d).select("fid", F.array(F.array(ring)).alias("geom")), 8)
    return out.select("fid", F.size(F.col("geom")[0][0]).alias("vertices"), F.round(geo.area("geom"), 3).alias("area"))


@query(W(i.SQL_FP, i.SQL_CNT) + "SELECT CAST(count(*) AS BIGINT) AS n, CAST(count(*)*100 AS DOUBLE) AS area FROM cnt")
def dissolve_area(spark: SparkSession, d: str) -> DataFrame:
    """The cells with footprints as squares: what is dissolved has all their area, once."""
    x, y = F.col("rx") * 10.0, F.col("ry") * 10.0
    out = vector.dissolve(i.counts(spark, d).select(geo.box(x, y, x + 10, y + 10).alias("geom")), 400, no_holes=False)
    return out.agg(F.sum("n").alias("n"), F.round(F.sum(geo.area("geom")), 3).alias("area"))


@query(W(i.SQL_FP, i.SQL_CNT, "ring AS (SELECT rx+1 AS rx, ry+1 AS ry, v FROM cnt)", segments_sql("ring", 531, 483).replace("SELECT rx, ry, CAST(kase", ", seg AS (SELECT rx, ry, CAST(kase", 1) + ")") + "SELECT round(-sum(x0*y1-x1*y0)/2, 6) AS area FROM seg")
def contour_area(spark: SparkSession, d: str) -> DataFrame:
    """Area within all contours less that of holes, in cells: by rings here, by Green's theorem over segments in SQL."""
    rings = vector.contour_rings(i.counts(spark, d), i.GRID, 12, pad=True)
    signed = F.when(F.col("is_hole"), -geo.area("geom")).otherwise(geo.area("geom")) / (833.0 * 833.0)
    return rings.agg(F.round(F.sum(signed), 6).alias("area"))


@query(W(i.SQL_FP) + "SELECT fid, CAST(1 AS INTEGER) AS polys, true AS as_expected FROM fp")
def buffer_area(spark: SparkSession, d: str) -> DataFrame:
    """Boxes grown by 50 metres: the area is that of the box, its four sides grown, and four quarters of an octagon or disc."""
    degrees = vector.transform("geom", lambda x, y: (x / 1e6 + 3, y / 1e6 + 6))
    boxes = i.footprints(spark, d).select("fid", "w", "h", geo.box("minx", "miny", "maxx", "maxy").alias("geom")).withColumn("geom", degrees)
    out = vector.buffer_metres(boxes, 50, 2)
    before, after = geo.spherical_area(degrees), geo.spherical_area("geom")
    lat = F.radians(geo.centroid("geom")["y"])
    round_about = 2 * (F.col("w") * F.cos(lat) + F.col("h")) * 0.1112 * 50
    low, high = F.col("w") * F.col("h") * 0.1112 * 0.1112 * F.cos(lat) * 0.98 + round_about * 0.98 + 2 * 50 * 50, F.col("w") * F.col("h") * 0.1112 * 0.1112 * F.cos(lat) * 1.02 + round_about * 1.02 + 3.2 * 50 * 50
    return out.select("fid", F.size("geom").alias("polys"), after.between(low, high).alias("as_expected"))


# neighbours and windows ----------------------------------------------------------------------------
# degrees: the plane's micro-degrees, ten times as wide; WGS 84's squared eccentricity; authalic latitudes in SQL
EARTH = replace(i.GRID, origin_x=3.0, origin_y=10.0, pixel_width=833e-5, pixel_height=-833e-5)
_E2 = 0.0066943799901413165
_Q = f"((1-{_E2})*(sin(radians({{0}}))/(1-{_E2}*pow(sin(radians({{0}})),2))+atanh(sqrt({_E2})*sin(radians({{0}})))/sqrt({_E2})))"
_BETA = f"asin(least(1, {_Q}/{_Q.format('90')}))"
_MID = (EARTH.origin_x + EARTH.cols * EARTH.pixel_width / 2, EARTH.origin_y + EARTH.rows * EARTH.pixel_height / 2)
_LAEA = f"""SELECT *, 6378137*sqrt({_Q.format('90')}/2)*sqrt(2/(1+sin(b0)*sin(b)+cos(b0)*cos(b)*cos(l)))*dd*cos(b)*sin(l) AS x, 6378137*sqrt({_Q.format('90')}/2)*sqrt(2/(1+sin(b0)*sin(b)+cos(b0)*cos(b)*cos(l)))/dd*(cos(b0)*sin(b)-sin(b0)*cos(b)*cos(l)) AS y FROM (
  SELECT *, cos(radians({_MID[1]}))/sqrt(1-{_E2}*pow(sin(radians({_MID[1]})),2))/(sqrt({_Q.format('90')}/2)*cos(b0)) AS dd FROM (SELECT *, {_BETA.format('lat')} AS b, {_BETA.format(_MID[1])} AS b0, radians(lon-{_MID[0]}) AS l FROM {{0}}))"""


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_FAC, "pt AS (SELECT rx, ry, 3.0::DOUBLE+833e-5::DOUBLE*(rx+0.5::DOUBLE) AS lon, 10.0::DOUBLE-833e-5::DOUBLE*(ry+0.5::DOUBLE) AS lat FROM cnt)", "pl AS (SELECT place_id, 3+px/1e5::DOUBLE AS lon, 6+py/1e5::DOUBLE AS lat FROM fac)", f"a AS ({_LAEA.format('pt')})", f"b AS ({_LAEA.format('pl')})")
       + "SELECT rx, ry, arg_min(place_id, pow(a.x-b.x,2)+pow(a.y-b.y,2)) AS place_id, true AS as_far FROM a, b GROUP BY rx, ry")
def nearest_on_earth(spark: SparkSession, d: str) -> DataFrame:
    """as_far: the geodesic distance is within 0.6 % of that on a sphere, what flattening can make of it."""
    p = i.counts(spark, d).select((F.col("rx") + F.col("ry") * 1_000_000).alias("id"), "rx", "ry", EARTH.centre_x("rx").alias("lon"), EARTH.centre_y("ry").alias("lat"))
    places = i.facilities(spark, d).select("place_id", (F.lit(3.0) + F.col("px") / 1e5).alias("lon"), (F.lit(6.0) + F.col("py") / 1e5).alias("lat"))
    found = joins.nearest_on_earth(p, places, EARTH, 100_000).join(p, "id").join(places.select("place_id", F.col("lon").alias("a"), F.col("lat").alias("b")), "place_id")
    sphere = geo.haversine("lon", "lat", "a", "b")
    return found.select("rx", "ry", "place_id", (F.abs(F.col("metres") - sphere) <= 0.006 * sphere).alias("as_far"))


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_FAC) + """SELECT rx, ry, place_id, CAST(rank AS INTEGER) AS rank FROM (SELECT rx, ry, place_id, row_number() OVER (PARTITION BY rx, ry ORDER BY (1666*rx+833-2*px)*(1666*rx+833-2*px)+(800000-1666*ry-833-2*py)*(800000-1666*ry-833-2*py), place_id) AS rank FROM cnt, fac) WHERE rank<=5""")
def nearest_five(spark: SparkSession, d: str) -> DataFrame:
    p = i.counts(spark, d).select((F.col("rx") * 529 + F.col("ry") * 1_000_000).alias("id"), "rx", "ry", (F.col("rx") * 1666 + 833).alias("x"), (F.lit(800_000) - F.col("ry") * 1666 - 833).alias("y"))
    places = i.facilities(spark, d).select("place_id", (F.col("px") * 2).alias("px"), (F.col("py") * 2).alias("py"))
    return joins.nearest(p, places, 20_000, k=5).join(p, "id").select("rx", "ry", "place_id", "rank")


@query(W(i.SQL_FP, i.SQL_CNT, i.SQL_PARTS) + """SELECT CAST(sum(coalesce(c.v,0)) AS BIGINT) AS sum_left, CAST(sum(coalesce(p.v,0)) AS BIGINT) AS sum_right, CAST(sum(abs(coalesce(p.v,0)-coalesce(c.v,0))) AS BIGINT) AS sum_abs_diff, CAST(abs(sum(coalesce(c.v,0))-sum(coalesce(p.v,0))) AS BIGINT) AS abs_sum_diff
  FROM cnt c FULL JOIN (SELECT rx+3 AS rx, ry-2 AS ry, v FROM parts) p USING (rx, ry)""")
def shifted_stats(spark: SparkSession, d: str) -> DataFrame:
    return raster.two_raster_stats(i.counts(spark, d), i.parts(spark, d), shift=(3, -2))


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_FAC, i.SQL_MARKS, "inn AS (SELECT DISTINCT rx, ry FROM c1)", "cr AS (SELECT id, unnest([minx//833, maxx//833, minx//833, maxx//833]) AS rx, unnest([(400000-miny)//833, (400000-miny)//833, (400000-maxy)//833, (400000-maxy)//833]) AS ry FROM marks)")
       + "SELECT id FROM marks WHERE id NOT IN (SELECT id FROM cr JOIN inn USING (rx, ry) GROUP BY id HAVING count(*)=4)")
def prune_inner(spark: SparkSession, d: str) -> DataFrame:
    inner = raster.rasterize_boxes(i.zones1(spark, d), i.GRID).select("rx", "ry").distinct()
    return settle.outside_of(i.marks(spark, d), inner, i.GRID).select("id")


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL) + "SELECT id, square_sum FROM zs ORDER BY square_sum DESC, id LIMIT 10")
def top_zones(spark: SparkSession, d: str) -> DataFrame:
    """A report of the ten fullest zones."""
    return zonal_stats(spark, d).select("id", "square_sum").orderBy(F.desc("square_sum"), "id").limit(10)


@query(W(i.SQL_FP) + "SELECT fid, round(6378137*radians(minx/1e6+3), 3) AS x, round(6378137*ln(tan(pi()/4+radians(miny/1e6+6)/2)), 3) AS y FROM fp")
def reproject(spark: SparkSession, d: str) -> DataFrame:
    x, y = geo.web_mercator(F.col("minx") / 1e6 + 3, F.col("miny") / 1e6 + 6)
    return i.footprints(spark, d).select("fid", F.round(x, 3).alias("x"), F.round(y, 3).alias("y"))


@query("SELECT unnest(['o_custkey', 'o_orderkey']) AS name")
def shared_columns(spark: SparkSession, d: str) -> DataFrame:
    orders = i.read(spark, d, "orders").select("o_orderkey", "o_custkey")
    other = orders.withColumn("more", F.lit(1))
    return spark.createDataFrame([(n,) for n in sorted(layers.shared_columns(orders, other))], "name string")


# files: written to the shared folder and read back -------------------------------------------------------
def _folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/geoloom-{uuid.uuid4().hex}"


_SEEN = "x0+s>=100000 AND x0<=300000 AND y0+s>=50000 AND y0<=250000 AND fid%3<>0"


@query(W(i.SQL_FP, SQL_TRI) + f"SELECT fid, s*s/2 AS area FROM tri WHERE {_SEEN}")
def layer_parquet(spark: SparkSession, d: str) -> DataFrame:
    """A layer found in a folder, read by name through a rectangle and a filter on attributes."""
    folder = _folder(spark)
    layers.write_layer(triangles(spark, d), f"{folder}/areas.parquet")
    (found,) = layers.pick(layers.discover(spark, folder), "areas")
    chosen = layers.Layer.of(name=found.name, path=found.path, format=found.format, attribute_filter="fid % 3 <> 0")
    return layers.read_layer(spark, chosen, (100_000, 50_000, 300_000, 250_000)).select("fid", geo.area("geom").alias("area"))


@query(W(i.SQL_FP, SQL_TRI) + "SELECT fid, s*s/2 AS area, k AS source FROM tri, (SELECT unnest(['one', 'two']) AS k)")
def layers_merged(spark: SparkSession, d: str) -> DataFrame:
    """A GeoJSON and a CSV layer of one folder, merged."""
    folder = _folder(spark)
    t = triangles(spark, d)
    layers.write_geojson(t, f"{folder}/one.geojsonl")
    layers.write_csv(t.select("fid", layers.to_wkt("geom").alias("geom")), f"{folder}/two.csv")
    read = {x.name: layers.read_layer(spark, x) for x in layers.discover(spark, folder)}
    one = read["one"].select(F.col("properties")["fid"].cast("long").alias("fid"), "geom")
    two = read["two"].select(F.col("fid").cast("long").alias("fid"), "geom")
    merged = settle.merge_layers({"one": one, "two": two})
    return merged.select("fid", geo.area("geom").alias("area"), F.col("source_merge").alias("source"))


@query(W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL) + "SELECT CAST(id AS INTEGER) AS feature_id, CAST(square_count AS INTEGER) AS square_count, square_sum FROM zs")
def zonal_csv(spark: SparkSession, d: str) -> DataFrame:
    folder = _folder(spark)
    layers.write_zonal_csv(zonal_stats(spark, d), folder)
    return layers.read_zonal_csv(spark, folder)


@query(W(i.SQL_FP, SQL_TRI) + "SELECT fid, true AS same FROM tri")
def codecs(spark: SparkSession, d: str) -> DataFrame:
    """WKT, WKB, EWKB and GeoJSON there and back."""
    t = triangles(spark, d).select("fid", "geom")
    back = [layers.from_wkt(layers.to_wkt("geom")), layers.from_wkb(layers.to_wkb("geom")), layers.from_wkb(layers.to_wkb("geom", 4326)), layers.from_geojson(layers.to_geojson("geom"))]
    same = F.lit(True)
    for b in back:
        same = same & (b == F.col("geom"))
    return t.select("fid", same.alias("same"))


@query(f"""SELECT c.id AS settlement_fid, level AS settlement_level, c.rx AS raster_x, c.ry AS raster_y, 833*c.rx+416.5::DOUBLE AS long, 400000-833*c.ry-416.5::DOUBLE AS lat, c.ry*529+c.rx AS grid_index, corner
  FROM ({CORNER_COUNTS}) c LEFT JOIN ({W(i.SQL_FP, i.SQL_Z1, Z1C, i.SQL_CNT, ZONAL, LEVELS)} SELECT id, level FROM lv) l ON c.id=l.id""")
def centre_records(spark: SparkSession, d: str) -> DataFrame:
    return settle.centre_records(centre_check(spark, d), levels(spark, d), i.GRID)


@query(W(*SQ) + """SELECT 'year1_lookup' AS name, count(*) AS n, CAST(sum(c) AS BIGINT) AS total FROM (SELECT count(*) AS c FROM sq GROUP BY year1_id) UNION ALL SELECT 'year2_lookup', count(*), CAST(sum(c) AS BIGINT) FROM (SELECT count(*) AS c FROM sq GROUP BY year2_id)
  UNION ALL SELECT 'year1_overlap', count(*), CAST(sum(c) AS BIGINT) FROM (SELECT count(DISTINCT year2_id) AS c FROM sq GROUP BY year1_id) UNION ALL SELECT 'year2_overlap', count(*), CAST(sum(c) AS BIGINT) FROM (SELECT count(DISTINCT year1_id) AS c FROM sq GROUP BY year2_id)
  UNION ALL SELECT 'main', count(*), CAST(sum(c) AS BIGINT) FROM (SELECT count(*) AS c FROM sq GROUP BY year1_id, year2_id)""")
def comparison_exports(spark: SparkSession, d: str) -> DataFrame:
    """All tables of a comparison written as CSV and read back: rows and the sum of their counts."""
    folder = _folder(spark)
    layers.write_exports(compare.exports(compared(spark, d)), folder)
    counted = {"year1_lookup": "count", "year2_lookup": "count", "year1_overlap": "y1_overlaps", "year2_overlap": "y2_overlaps", "main": "cnt"}
    out = None
    for name, c in counted.items():
        one = spark.read.option("header", True).csv(f"{folder}/{name}.csv").agg(F.lit(name).alias("name"), F.count("*").alias("n"), F.sum(F.col(c).cast("long")).alias("total"))
        out = one if out is None else out.union(one)
    return out
