"""Comparing two generations of identified areas cell by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CELL = ["rx", "ry"]


def missing_ids(features: DataFrame, cells: DataFrame) -> DataFrame:
    """Features (id, rx, ry of the centroid) that the raster (id, rx, ry) doesn't show, one a cell: the greatest id."""
    lost = features.join(cells.select("id").distinct(), "id", "left_anti")
    return lost.groupBy(*CELL).agg(F.max("id").alias("id")).select("id", *CELL)


def squares(year1: DataFrame, year2: DataFrame, missing1: DataFrame, missing2: DataFrame) -> DataFrame:
    """(rx, ry, year1_id, year2_id): both rasters side by side; a missing feature's centroid cell overrides its raster."""
    one = lambda d, name: d.where("id >= 0").groupBy(*CELL).agg(F.max("id").alias(name))
    out = one(year1, "r1").join(one(missing1, "m1"), CELL, "full_outer").join(one(year2, "r2").join(one(missing2, "m2"), CELL, "full_outer"), CELL, "full_outer")
    return out.select(*CELL, F.coalesce("m1", "r1").alias("year1_id"), F.coalesce("m2", "r2").alias("year2_id"))


def id_lookup(cells: DataFrame, year: int) -> DataFrame:
    """Cells of each id of a year; the cells without one are a group too."""
    return cells.groupBy(f"year{year}_id").agg(F.count("*").alias("cnt"))


def id_overlap(cells: DataFrame, year: int) -> DataFrame:
    """How many ids of the other year each id meets."""
    return cells.groupBy(f"year{year}_id").agg(F.count_distinct(f"year{3 - year}_id").alias("overlaps"))


def id_main(cells: DataFrame) -> DataFrame:
    """Every pair of ids with its cells, the cells of either, what year 2 overlaps, and the shares in percent."""
    pairs = cells.groupBy("year2_id", "year1_id").agg(F.count("*").alias("cnt"))
    # what concerns one year follows from the pairs, so the cells are grouped once
    y1 = pairs.groupBy(F.col("year1_id").alias("k1")).agg(F.sum("cnt").alias("y1_count"))
    y2 = pairs.groupBy(F.col("year2_id").alias("k2")).agg(F.sum("cnt").alias("y2_count"), F.count("year1_id").alias("y2_overlaps"))
    joined = pairs.join(y2, F.col("year2_id") == F.col("k2"), "left").join(y1, F.col("year1_id") == F.col("k1"), "left")
    name = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("NA"))
    share = lambda n: F.round(F.lit(100.0) * F.col("cnt") / F.col(n), 2)
    return joined.select(
        F.concat(name("year2_id"), F.lit("_"), name("year1_id")).alias("pair_key"), "cnt", "year2_id", "year1_id", "y2_count", "y1_count", "y2_overlaps",
        share("y2_count").alias("y2_ratio"), share("y1_count").alias("y1_ratio"),
    )


def exports(cells: DataFrame) -> dict[str, DataFrame]:
    """The tables of a comparison by the name of their file: cells and overlaps of each id of either year, and all pairs."""
    out = {f"year{y}_lookup": id_lookup(cells, y).withColumnRenamed("cnt", "count") for y in (1, 2)}
    out |= {f"year{y}_overlap": id_overlap(cells, y).withColumnRenamed("overlaps", f"y{y}_overlaps") for y in (1, 2)}
    return out | {"main": id_main(cells)}
