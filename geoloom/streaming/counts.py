"""Points that arrive over time, counted by cell."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.grid import GridSpec


def event_cells(events: DataFrame, grid: GridSpec) -> DataFrame:
    """Cells (rx, ry) of events (event_id, user_id, ts), by the same arithmetic as the batch inputs."""
    x, y = F.col("user_id") * 7919 % 440000, F.col("event_id") * 104729 % 376000
    return events.select(F.col("ts").cast("timestamp").alias("ts"), grid.cell_x(x).alias("rx"), grid.cell_y(y).alias("ry")).where(grid.inside("rx", "ry"))


def windowed_counts(events: DataFrame, grid: GridSpec, window: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Counts by window and cell; state of windows older than the watermark is dropped."""
    cells = event_cells(events, grid).withWatermark("ts", late)
    return cells.groupBy(F.window("ts", window).alias("w"), "rx", "ry").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "rx", "ry", "n")
