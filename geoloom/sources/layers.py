"""Finding, reading and writing layers, rasters and tables."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions.grid import GridSpec, is_nodata
from geoloom.operators.vector import GEOM, read, with_envelope, write
from geoloom.sources import codecs

FORMATS = {".geojson": "geojson", ".geojsonl": "geojsonl", ".json": "geojson", ".parquet": "parquet", ".csv": "csv", ".wkt": "csv"}
SIDECARS = {".prj", ".cpg", ".dbf", ".shx", ".qix", ".xml", ".zip", ".txt", ".md", ".crc", ".identifier"}


@dataclass(frozen=True)
class Layer:
    """Where a layer is and which of its rows count. Unknown options are an error, as in a strict configuration."""

    name: str
    path: str
    format: str = "parquet"
    attribute_filter: str | None = None
    geometry: str = "geom"
    options: dict = field(default_factory=dict)

    @classmethod
    def of(cls, **options) -> Layer:
        unknown = set(options) - {f.name for f in cls.__dataclass_fields__.values()}
        if unknown:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        return cls(**options)


def discover(spark: SparkSession, folder: str) -> list[Layer]:
    """Every layer below a folder of any file system Spark knows; an error if there is none."""
    jvm = spark._jvm
    top = jvm.org.apache.hadoop.fs.Path(folder)
    fs = top.getFileSystem(spark._jsc.hadoopConfiguration())
    found: list[Layer] = []

    def walk(path) -> None:
        for s in sorted(fs.listStatus(path), key=lambda s: s.getPath().toString()):
            name = s.getPath().getName()
            stem, dot, end = name.rpartition(".")
            kind = FORMATS.get(f".{end.lower()}") if dot else None
            if name.startswith((".", "_")) or "_deleted" in name or f".{end.lower()}" in SIDECARS:
                continue
            if kind:
                found.append(Layer(stem, s.getPath().toString(), kind))
            elif s.isDirectory():
                walk(s.getPath())

    walk(top)
    if not found:
        raise FileNotFoundError(f"no layer in {folder}")
    return found


def pick(layers: list[Layer], name: str) -> list[Layer]:
    """'-' the first, 'all' all, else by name."""
    if name == "all":
        return layers
    chosen = layers[:1] if name == "-" else [x for x in layers if x.name == name]
    if not chosen:
        raise ValueError(f"no layer {name}; there are {', '.join(x.name for x in layers)}")
    return chosen


def _decoded(parse) -> object:
    @F.arrow_udf(geo.GEOM)
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else write(parse(v)) for v in values.to_pylist()], GEOM)

    return run


def from_wkb(column: Column | str) -> Column:
    return _decoded(lambda v: codecs.from_wkb(v)[0])(column)


def from_wkt(column: Column | str) -> Column:
    return _decoded(codecs.from_wkt)(column)


def from_geojson(column: Column | str) -> Column:
    return _decoded(codecs.from_geojson)(column)


def to_wkb(column: Column | str, srid: int | None = None) -> Column:
    @F.arrow_udf("binary")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else codecs.to_wkb(read(v), srid) for v in values.to_pylist()], pa.binary())

    return run(column)


def to_wkt(column: Column | str) -> Column:
    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else codecs.to_wkt(read(v)) for v in values.to_pylist()], pa.string())

    return run(column)


def to_geojson(column: Column | str) -> Column:
    @F.arrow_udf("string")
    def run(values: pa.Array) -> pa.Array:
        return pa.array([None if v is None else codecs.to_geojson(read(v)) for v in values.to_pylist()], pa.string())

    return run(column)


def read_layer(spark: SparkSession, layer: Layer, within: tuple[float, float, float, float] | None = None) -> DataFrame:
    """A layer with fid, its attributes, geom and envelope; filtered by attributes and by a rectangle.

    Parquet layers that hold envelope columns have both filters pushed into the scan.
    """
    if layer.format in ("geojson", "geojsonl"):
        if layer.format == "geojsonl":
            feature = F.from_json("value", "struct<id:string,geometry:string,properties:map<string,string>>")
            rows = spark.read.text(layer.path).where(F.length(F.trim("value")) > 0).select(feature.alias("f"))
        else:
            whole = F.from_json("value", "struct<features:array<struct<id:string,geometry:string,properties:map<string,string>>>>")
            rows = spark.read.text(layer.path, wholetext=True).select(F.explode(whole["features"]).alias("f"))
        df = rows.select("f.properties", from_geojson(F.col("f.geometry")).alias("geom"))
    elif layer.format == "csv":
        df = spark.read.option("header", True).option("escape", '"').options(**layer.options).csv(layer.path)
        df = df.withColumn("geom", from_wkt(layer.geometry))
    else:
        df = spark.read.options(**layer.options).parquet(layer.path)
        if dict(df.dtypes).get(layer.geometry) == "binary":
            df = df.withColumn("geom", from_wkb(layer.geometry))
    if layer.attribute_filter:
        df = df.where(layer.attribute_filter)
    if "minx" not in df.columns:
        df = with_envelope(df)
    if within:
        a, b, c, d = within
        df = df.where((F.col("maxx") >= a) & (F.col("minx") <= c) & (F.col("maxy") >= b) & (F.col("miny") <= d))
    return df if "fid" in df.columns else df.withColumn("fid", F.monotonically_increasing_id())


def read_all(spark: SparkSession, layers: list[Layer]) -> DataFrame:
    from geoloom.operators.settle import merge_layers

    return merge_layers({x.name: read_layer(spark, x) for x in layers})


# sinks ----------------------------------------------------------------------------------------------
def write_layer(layer: DataFrame, path: str, partition_by: tuple[str, ...] = ()) -> None:
    """Parquet clustered by envelope, so that rectangles prune row groups."""
    layer.repartitionByRange("minx", "miny").sortWithinPartitions("minx", "miny").write.mode("overwrite").partitionBy(*partition_by).parquet(path) if not partition_by else layer.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def write_geojson(layer: DataFrame, path: str) -> None:
    """One feature a line."""
    rest = [c for c in layer.columns if c not in ("geom", "minx", "miny", "maxx", "maxy")]
    geometry = F.from_json(to_geojson("geom"), "struct<type:string,coordinates:array<array<array<array<double>>>>>")
    feature = F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*rest).alias("properties"), geometry.alias("geometry")))
    layer.select(feature.alias("value")).write.mode("overwrite").text(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def write_exports(tables: dict[str, DataFrame], folder: str) -> None:
    """Each table as CSV with a header under its name in the folder."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}.csv")


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", batch: int = 10_000, **properties: str) -> None:
    """Rows of a frame into a database table, in batches from every partition; geometries go as WKB."""
    from pyspark.sql.types import ArrayType

    flat = [to_wkb(f.name).alias(f.name) if isinstance(f.dataType, ArrayType) else F.col(f.name) for f in df.schema.fields]
    df.select(*flat).write.mode(mode).option("batchsize", batch).jdbc(url, table, properties=properties)


def write_zonal_csv(zonal: DataFrame, path: str) -> None:
    """Without a header: id, count, sum, by id."""
    zonal.select("id", "square_count", "square_sum").orderBy("id").write.mode("overwrite").csv(path)


def read_zonal_csv(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("feature_id int, square_count int, square_sum double").csv(path)


def ramp_text(ramp: DataFrame, equal: float = 1.0) -> str:
    """A discrete colour ramp as text: classes below, the band that counts as equal, classes above. At most two signs of bounded bins."""
    # fixed values: the header and the colours of the three kinds
    header, below, same, above = "# QGIS Generated Color Map Export File\nINTERPOLATION:DISCRETE\n", "213,94,0", "0,158,115,255", "240,228,66"
    rows = sorted(ramp.collect(), key=lambda r: r["bin"])
    line = lambda r, colour: f"{r['upper']:.10g},{colour},{r['alpha']},<= {r['upper']:.10g}\n"
    middle = f"{equal:g},{same}, Equal (-{equal:g} <= value <= {equal:g})\n"
    return header + "".join(line(r, below) for r in rows if r["sign"] < 0) + middle + "".join(line(r, above) for r in rows if r["sign"] > 0)


# rasters ----------------------------------------------------------------------------------------------
TAGS = {256: "cols", 257: "rows", 258: "bits", 259: "compression", 273: "offsets", 277: "bands", 278: "strip_rows", 279: "counts", 317: "predictor", 322: "tile_cols", 323: "tile_rows", 324: "offsets", 325: "counts", 339: "format", 33550: "scale", 33922: "tie", 42113: "nodata"}
KINDS = {1: "B", 2: "c", 3: "H", 4: "I", 5: "II", 11: "f", 12: "d", 16: "Q"}


def parse_geotiff(data: bytes) -> tuple[GridSpec, np.ndarray]:
    """Grid and band of a one-band GeoTIFF in strips or tiles, plain or deflated."""
    import struct
    import zlib

    order = {b"II": "<", b"MM": ">"}[data[:2]]
    if struct.unpack_from(order + "H", data, 2)[0] != 42:
        raise ValueError("not a classic TIFF")
    at = struct.unpack_from(order + "I", data, 4)[0]
    found: dict = {}
    for i in range(struct.unpack_from(order + "H", data, at)[0]):
        tag, kind, count = struct.unpack_from(order + "HHI", data, at + 2 + 12 * i)
        if tag in TAGS and kind in KINDS:
            size = struct.calcsize(order + KINDS[kind]) * count
            where = at + 10 + 12 * i if size <= 4 else struct.unpack_from(order + "I", data, at + 10 + 12 * i)[0]
            raw = data[where : where + size]
            found[TAGS[tag]] = raw.rstrip(b"\0").decode() if kind == 2 else list(struct.unpack(order + KINDS[kind] * count, raw))
    one = lambda name, default=None: found.get(name, [default])[0]
    if one("bands", 1) != 1 or one("predictor", 1) != 1 or one("compression", 1) not in (1, 8, 32946):
        raise ValueError("only one band, plain or deflated, without predictor")
    dtype = np.dtype(f"{order}{ {1: 'u', 2: 'i', 3: 'f'}[one('format', 1)]}{one('bits', 8) // 8}")
    cols, rows = one("cols"), one("rows")
    w, h = one("tile_cols", cols), one("tile_rows", one("strip_rows", rows))
    across = -(-cols // w)
    band = np.zeros((rows, cols), dtype)
    for k, (offset, count) in enumerate(zip(found["offsets"], found["counts"], strict=True)):
        raw = data[offset : offset + count]
        block = np.frombuffer(zlib.decompress(raw) if one("compression", 1) != 1 else raw, dtype)
        y, x = k // across * h, k % across * w
        block = block[: len(block) // w * w].reshape(-1, w)[: rows - y, : cols - x]
        band[y : y + len(block), x : x + block.shape[1]] = block
    sx, sy = found.get("scale", [1.0, 1.0])[:2]
    tie = found.get("tie", [0.0] * 6)
    nodata = float(found["nodata"]) if found.get("nodata") else None
    return GridSpec(tie[3] - tie[0] * sx, tie[4] + tie[1] * sy, sx, -sy, cols, rows, nodata=nodata), band


def format_geotiff(grid: GridSpec, band: np.ndarray) -> bytes:
    """A one-band deflated GeoTIFF in strips."""
    import struct
    import zlib

    band = np.ascontiguousarray(band)
    strip = max(1, (1 << 20) // max(1, band.shape[1] * band.itemsize))
    blocks = [zlib.compress(band[y : y + strip].astype(band.dtype.newbyteorder("<")).tobytes()) for y in range(0, len(band), strip)]
    kind = {"u": 1, "i": 2, "f": 3}[band.dtype.kind]
    out, offsets = bytearray(b"II*\0\0\0\0\0"), []
    for b in blocks:
        offsets.append(len(out))
        out += b
    entries = [(256, 4, [grid.cols]), (257, 4, [grid.rows]), (258, 3, [band.itemsize * 8]), (259, 3, [8]), (262, 3, [1]), (273, 4, offsets), (277, 3, [1]), (278, 4, [strip]), (279, 4, [len(b) for b in blocks]), (339, 3, [kind]), (33550, 12, [grid.pixel_width, -grid.pixel_height, 0.0]), (33922, 12, [0.0, 0.0, 0.0, grid.origin_x, grid.origin_y, 0.0])]
    if grid.nodata is not None:
        entries.append((42113, 2, f"{grid.nodata!r}".encode() + b"\0"))
    table = struct.pack("<H", len(entries))
    for tag, k, values in entries:
        raw = values if k == 2 else struct.pack("<" + KINDS[k] * len(values), *values)
        if len(raw) > 4:
            place = struct.pack("<I", len(out))
            out += raw
        else:
            place = raw.ljust(4, b"\0")
        table += struct.pack("<HHI", tag, k, len(values)) + place
    out[4:8] = struct.pack("<I", len(out))
    return bytes(out + table + b"\0\0\0\0")


def read_raster(spark: SparkSession, path: str) -> tuple[GridSpec, DataFrame]:
    """Grid and cells with data of a GeoTIFF; the band is parsed in a task, only the grid comes to the driver."""
    files = spark.read.format("binaryFile").load(path).select("content")
    first = files.limit(2).mapInArrow(_headers, "grid string").collect()
    if len(first) != 1:
        raise ValueError(f"one raster is wanted in {path}, there are {len(first)} or more")
    grid = GridSpec(**json.loads(first[0]["grid"]))
    cells = files.mapInArrow(_cells, "rx long, ry long, v double")
    return grid, cells.where(~is_nodata("v", grid.nodata))


def _headers(batches):
    for batch in batches:
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps(parse_geotiff(c)[0].__dict__) for c in batch.column(0).to_pylist()])], names=["grid"])


def _cells(batches):
    for batch in batches:
        for content in batch.column(0).to_pylist():
            grid, band = parse_geotiff(content)
            step = max(1, 500_000 // grid.cols)
            for y in range(0, grid.rows, step):
                block = band[y : y + step].astype(float)
                ry, rx = np.indices(block.shape)
                yield pa.RecordBatch.from_arrays([pa.array(rx.ravel()), pa.array(ry.ravel() + y), pa.array(block.ravel())], names=["rx", "ry", "v"])


def dense(cells: DataFrame, grid: GridSpec, fill: float) -> DataFrame:
    """Every cell of the grid, ``fill`` where there is no data."""
    every = cells.sparkSession.range(grid.cols * grid.rows).select((F.col("id") % grid.cols).alias("rx"), F.expr(f"id div {grid.cols}").alias("ry"))
    return every.join(cells, ["rx", "ry"], "left").select("rx", "ry", F.coalesce("v", F.lit(fill)).alias("v"))


# catalogue ------------------------------------------------------------------------------------------
def _name(x: str) -> str:
    if not re.fullmatch(r"\w+(\.\w+)?", x):
        raise ValueError(f"not a plain name: {x}")
    return x


def create_schema(spark: SparkSession, schema: str) -> None:
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {_name(schema)}")


def drop_schema(spark: SparkSession, schema: str) -> None:
    """Table by table, then the schema."""
    for t in spark.catalog.listTables(_name(schema)):
        if not t.isTemporary:
            spark.sql(f"DROP TABLE IF EXISTS {schema}.{t.name}")
    spark.sql(f"DROP SCHEMA IF EXISTS {schema}")


def save_table(df: DataFrame, table: str, partition_by: tuple[str, ...] = ()) -> None:
    df.write.mode("overwrite").partitionBy(*partition_by).saveAsTable(_name(table))


def shared_columns(left: DataFrame, right: DataFrame, ignore: tuple[str, ...] = ()) -> list[str]:
    return [c for c in left.columns if c in right.columns and c not in ignore]


def table_info(spark: SparkSession, table: str) -> dict:
    exists = spark.catalog.tableExists(_name(table))
    return {"exists": exists, "columns": spark.table(table).columns if exists else [], "rows": spark.table(table).count() if exists else 0}


def union_layers(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
