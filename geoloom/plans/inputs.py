"""Spatial inputs derived from the relational tables by integer arithmetic in micro-degrees.

The same formulas are given as DuckDB SQL (``WITH`` parts), so results can be compared exactly.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions.grid import GridSpec
from geoloom.operators import raster

GRID = GridSpec(0, 400_000, 833, -833, 529, 481)

_SITE = "CASE WHEN o_custkey%100<40 THEN 0 WHEN o_custkey%100<60 THEN 1 WHEN o_custkey%100<70 THEN 2 WHEN o_custkey%100<80 THEN 3 ELSE 4+o_custkey%97 END"
_SPREAD = "CASE WHEN site=0 THEN 16000 WHEN site=1 THEN 14000 WHEN site<4 THEN 12000 ELSE 3000 END"
_MINX = "(site%11)*40000+(fid*7919+(fid//97)*31)%spread"
_MINY = "(site//11)*40000+(fid*104729+(fid//89)*57)%spread"
_W, _H = "60+(fid*31)%180", "60+(fid*17)%180"


def _spark(e: str) -> str:
    return e.replace("//", " div ")


def read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def footprints(spark: SparkSession, d: str) -> DataFrame:
    """fid, site, envelope, w, h and the cell (rx, ry) of the centre."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("fid"), F.expr(_SITE).cast("long").alias("site"))
    o = o.withColumn("spread", F.expr(_SPREAD))
    o = o.select("fid", "site", F.expr(_spark(_MINX)).alias("minx"), F.expr(_spark(_MINY)).alias("miny"), F.expr(_W).alias("w"), F.expr(_H).alias("h"))
    return o.select("fid", "site", "minx", "miny", (F.col("minx") + F.col("w")).alias("maxx"), (F.col("miny") + F.col("h")).alias("maxy"), "w", "h", F.expr("(2*minx+w) div 1666").alias("rx"), F.expr("(800000-(2*miny+h)) div 1666").alias("ry"))


def zones1(spark: SparkSession, d: str) -> DataFrame:
    """Per site the envelope of its footprints."""
    return footprints(spark, d).groupBy(F.col("site").alias("id")).agg(F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy"))


def zones2(spark: SparkSession, d: str) -> DataFrame:
    """The next generation: some zones moved, some gone, all renumbered."""
    step = F.expr("CASE WHEN id%3=0 THEN 2000 ELSE 0 END")
    z = zones1(spark, d).where("id%7 <> 6")
    return z.select((F.col("id") + 1000).alias("id"), (F.col("minx") + step).alias("minx"), "miny", (F.col("maxx") + step).alias("maxx"), "maxy")


def counts(spark: SparkSession, d: str) -> DataFrame:
    return raster.burn_count(footprints(spark, d), GRID)


def parts(spark: SparkSession, d: str) -> DataFrame:
    p = read(spark, d, "part").select((F.col("p_partkey") * 13 % 529).alias("rx"), (F.col("p_partkey") * 37 % 481).alias("ry"), "p_size")
    return p.groupBy("rx", "ry").agg(F.sum("p_size").alias("v"))


def facilities(spark: SparkSession, d: str) -> DataFrame:
    return read(spark, d, "supplier").select(F.col("s_suppkey").alias("place_id"), (F.col("s_suppkey") * 7919 % 440000).alias("px"), (F.col("s_suppkey") * 104729 % 376000).alias("py"))


def marks(spark: SparkSession, d: str) -> DataFrame:
    """Boxes that play the part of contours: id, envelope, area, is_hole."""
    f = facilities(spark, d)
    side = F.expr("4000 + place_id * 613 % 16000")
    m = f.select(F.col("place_id").alias("id"), F.col("px").alias("minx"), F.col("py").alias("miny"), (F.col("px") + side).alias("maxx"), (F.col("py") + side).alias("maxy"), F.expr("place_id % 5 = 0").alias("is_hole"))
    return m.withColumn("area", (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny")))


# the same in DuckDB ------------------------------------------------------------------------------
SQL_FP = f"""fp AS (SELECT fid, site, minx, miny, minx+w AS maxx, miny+h AS maxy, w, h, (2*minx+w)//1666 AS rx, (800000-(2*miny+h))//1666 AS ry
  FROM (SELECT fid, site, {_MINX} AS minx, {_MINY} AS miny, {_W} AS w, {_H} AS h
        FROM (SELECT *, {_SPREAD} AS spread FROM (SELECT o_orderkey AS fid, CAST({_SITE} AS BIGINT) AS site FROM orders))))"""
SQL_Z1 = "z1 AS (SELECT site AS id, min(minx) AS minx, min(miny) AS miny, max(maxx) AS maxx, max(maxy) AS maxy FROM fp GROUP BY site)"
SQL_Z2 = "z2 AS (SELECT id+1000 AS id, minx+s AS minx, miny, maxx+s AS maxx, maxy FROM (SELECT *, CASE WHEN id%3=0 THEN 2000 ELSE 0 END AS s FROM z1 WHERE id%7<>6))"
SQL_CNT = "cnt AS (SELECT rx, ry, count(*) AS v FROM fp WHERE rx BETWEEN 0 AND 528 AND ry BETWEEN 0 AND 480 GROUP BY rx, ry)"
SQL_PARTS = "parts AS (SELECT p_partkey*13%529 AS rx, p_partkey*37%481 AS ry, CAST(sum(p_size) AS BIGINT) AS v FROM part GROUP BY ALL)"
SQL_FAC = "fac AS (SELECT s_suppkey AS place_id, s_suppkey*7919%440000 AS px, s_suppkey*104729%376000 AS py FROM supplier)"
SQL_MARKS = "marks AS (SELECT place_id AS id, px AS minx, py AS miny, px+s AS maxx, py+s AS maxy, place_id%5=0 AS is_hole, s*s AS area FROM (SELECT *, 4000+place_id*613%16000 AS s FROM fac))"


def sql_cells(source: str, name: str) -> str:
    """Cells whose centre is in the boxes of ``source``."""
    at = lambda e: f"CAST(floor(({e})/1666.0) AS BIGINT)"
    return f"""{name} AS (SELECT id, rx, unnest(range(y0, y1+1)) AS ry FROM (SELECT id, y0, y1, unnest(range(x0, x1+1)) AS rx FROM (
  SELECT id, greatest({at('2*minx-833')}+1, 0) AS x0, least({at('2*maxx-833')}, 528) AS x1,
         greatest({at('2*(400000-maxy)-833')}+1, 0) AS y0, least({at('2*(400000-miny)-833')}, 480) AS y1 FROM {source})))"""


def with_sql(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
