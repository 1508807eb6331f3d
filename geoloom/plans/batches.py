"""Streams of sorted Arrow batches, a run of equal keys at a time."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


def groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Runs of equal keys in a sorted stream of batches: (key, rows). One run is held at a time."""
    held, key = [], None
    for batch in batches:
        columns = list(zip(*(batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys), strict=True))
        start = 0
        for i in range(1, len(columns) + 1):
            if i < len(columns) and columns[i] == columns[start]:
                continue
            if held and columns[start] != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = columns[start]
            held.append(batch.slice(start, i - start))
            start = i
    if held:
        yield key, pa.Table.from_batches(held)


def by_group(df: DataFrame, keys: list[str], f: Callable[[tuple, pa.Table], list[tuple]], schema: str) -> DataFrame:
    """f(key, rows) -> result rows for each group, without the cost of a Python call of its own for each."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for key, table in groups(batches, keys):
            rows += f(key, table)
            if len(rows) >= 500:
                yield batch(rows)
                rows = []
        if rows:
            yield batch(rows)

    def batch(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

    return df.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def width(spark: SparkSession) -> int:
    """Partitions for kernel work: as the session has them, and two for each core at least."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)


def by_block(df: DataFrame, keys: list[str], f: Callable[[tuple, pa.Table], Iterator[list]], schema: str) -> DataFrame:
    """f(key, rows) -> columns (arrays of one length), any number of times, for each run of equal whole-number keys.

    The rows are few beside the work they make, so partitions aren't put together by size.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    arrow = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = []
        for key, rows in _runs(batches, keys):
            for columns in f(key, rows):
                held.append(columns)
                if sum(len(c[0]) for c in held) >= 50_000 or len(held) >= 1000:
                    yield batch(held)
                    held = []
        if held:
            yield batch(held)

    def batch(held: list[list]) -> pa.RecordBatch:
        whole = [np.concatenate(c) if isinstance(c[0], np.ndarray) else [x for part in c for x in part] for c in zip(*held, strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(c, field.type) for c, field in zip(whole, arrow, strict=True)], schema=arrow)

    return df.repartition(width(df.sparkSession), *keys).sortWithinPartitions(*keys).mapInArrow(run, schema)


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """As groups(), for keys that are whole numbers."""
    held, last = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        k = np.stack([batch.column(batch.schema.get_field_index(c)).to_numpy(zero_copy_only=False) for c in keys], 1)
        cuts = [0, *(np.flatnonzero((k[1:] != k[:-1]).any(1)) + 1).tolist(), len(k)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            key = tuple(k[a].tolist())
            if held and key != last:
                yield last, pa.Table.from_batches(held).combine_chunks()
                held = []
            last = key
            held.append(batch.slice(a, b - a))
    if held:
        yield last, pa.Table.from_batches(held).combine_chunks()
