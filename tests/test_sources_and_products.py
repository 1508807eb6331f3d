import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import columns as geo
from geoloom.functions import kernel
from geoloom.functions.grid import GridSpec
from geoloom.operators import joins, settle, vector
from geoloom.plans import settlements
from geoloom.sources import codecs, layers
from geoloom.streaming.counts import windowed_counts

HOLED = [[[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0), (0.0, 0.0)], [(1.0, 1.0), (1.0, 2.0), (2.0, 2.0), (1.0, 1.0)]]]


def box(a, b, c, d):
    return [[[(a, b), (c, b), (c, d), (a, d), (a, b)]]]


def layer(spark, shapes):
    return spark.createDataFrame([(i, vector.write(g)) for i, g in enumerate(shapes)], f"fid long, geom {geo.GEOM}")


def test_codecs_round_trip():
    assert codecs.from_wkb(codecs.to_wkb(HOLED, 4326)) == (HOLED, 4326) and codecs.from_wkb(codecs.to_wkb(HOLED)) == (HOLED, None)
    assert codecs.from_wkt(codecs.to_wkt(HOLED)) == HOLED and codecs.from_geojson(codecs.to_geojson(HOLED)) == HOLED
    assert codecs.from_wkt("SRID=4326;POLYGON ((0 0, 1 0, 1 .5, 0 0))") == [[[(0, 0), (1, 0), (1, 0.5), (0, 0)]]]
    assert codecs.from_wkt("MULTIPOLYGON EMPTY") == []
    with pytest.raises(ValueError):
        codecs.from_wkt("POINT (1 2)")


def test_layers(spark, tmp_path):
    feature = lambda i: {"type": "Feature", "id": str(i), "properties": {"name": f"n{i}"}, "geometry": {"type": "Polygon", "coordinates": [[[i, 0], [i + 1, 0], [i + 1, 1], [i, 0]]]}}
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "a.geojson").write_text(json.dumps({"type": "FeatureCollection", "features": [feature(i) for i in range(3)]}))
    (tmp_path / "b_deleted.geojson").write_text("{}")
    (tmp_path / "c.csv").write_text('kind,geom\nx,"POLYGON ((0 0, 1 0, 1 1, 0 0))"\n')
    (tmp_path / "c.prj").write_text("")
    found = layers.discover(spark, str(tmp_path))
    assert [(x.name, x.format) for x in found] == [("c", "csv"), ("a", "geojson")]
    a = layers.read_layer(spark, layers.pick(found, "a")[0], within=(1.5, 0, 9, 9))
    assert sorted(r["properties"]["name"] for r in a.collect()) == ["n1", "n2"]
    assert layers.read_all(spark, [layers.pick(found, "c")[0]]).select("kind", "source_merge").first() == ("x", "c")
    with pytest.raises(ValueError):
        layers.Layer.of(name="x", path="y", colour=1)
    with pytest.raises(FileNotFoundError):
        (tmp_path / "none").mkdir()
        layers.discover(spark, str(tmp_path / "none"))
    with pytest.raises(ValueError):
        settle.merge_layers({"a": spark.range(1), "b": spark.range(1).select(F.col("id").cast("string"))})
    layers.write_layer(a.select("fid", "geom", *joins.ENVELOPE), str(tmp_path / "out"))
    assert spark.read.parquet(str(tmp_path / "out")).count() == 2
    layers.write_geojson(a.select("fid", "geom"), str(tmp_path / "lines.geojsonl"))
    assert layers.read_layer(spark, layers.Layer("l", str(tmp_path / "lines.geojsonl"), "geojsonl")).count() == 2
    one = layer(spark, [HOLED])
    back = one.select(layers.from_wkb(layers.to_wkb("geom", 4326)).alias("w"), layers.from_wkt(layers.to_wkt("geom")).alias("t"), layers.from_geojson(layers.to_geojson("geom")).alias("j")).first()
    assert all(vector.read(g) == HOLED for g in back)


def test_geotiff(spark, tmp_path):
    grid = GridSpec(6.0, 46.0, 0.25, -0.5, 7, 5, nodata=-1.0)
    band = np.arange(35, dtype=np.float32).reshape(5, 7)
    band[2, 3] = -1
    (tmp_path / "r.tif").write_bytes(layers.format_geotiff(grid, band))
    got, cells = layers.read_raster(spark, str(tmp_path / "r.tif"))
    assert got == grid and {(r["rx"], r["ry"]): r["v"] for r in cells.collect()} == {(x, y): float(band[y, x]) for x in range(7) for y in range(5) if (x, y) != (3, 2)}
    assert layers.dense(cells, grid, -1).count() == 35


def test_columns_agree_with_the_kernel(spark):
    ring = [(5 + 3 * math.cos(t), 2 + math.sin(t)) for t in np.linspace(0, 2 * math.pi, 12, endpoint=False)]
    shapes = [HOLED, box(0, 0, 2, 3), [[[*ring, ring[0]]]]]
    for g, r in zip(shapes, layer(spark, shapes).select(geo.area("geom").alias("a"), geo.centroid("geom").alias("c"), geo.contains_point("geom", F.lit(1.2), F.lit(1.5)).alias("in"), geo.is_ccw(F.col("geom")[0][0]).alias("ccw")).collect(), strict=True):
        assert r["a"] == pytest.approx(kernel.area(g)) and r["in"] == kernel.contains_point(g, 1.2, 1.5) and r["ccw"]
    c = layer(spark, [box(0, 0, 2, 3)]).select(geo.centroid("geom").alias("c")).first()["c"]
    assert (c["x"], c["y"]) == (1.0, 1.5)
    p = spark.createDataFrame([(3.1, 45.2), (9.0, -33.0)], "lon double, lat double")
    for r in p.select("lon", "lat", *[v.alias(n) for n, v in zip(("x", "y"), geo.utm("lon", "lat"), strict=True)]).collect():
        lon0 = math.ceil((r["lon"] + 180) / 6) * 6.0 - 183
        x, y = kernel.tm_forward(np.array([r["lon"]]), np.array([r["lat"]]), lon0)
        assert (r["x"], r["y"]) == (pytest.approx(x[0], abs=1e-6), pytest.approx(y[0], abs=1e-6))
        lon, lat = kernel.tm_inverse(x, y, lon0)
        assert (lon[0], lat[0]) == (pytest.approx(r["lon"], abs=1e-11), pytest.approx(r["lat"], abs=1e-11))


def test_dissolve_is_disjoint_and_fills(spark):
    frame = kernel.difference(box(0, 0, 10, 10), box(2, 2, 8, 8))
    shapes = [frame, box(4, 4, 5, 5), box(9, 9, 12, 12), box(20, 0, 21, 1), box(21, 1, 22, 2), box(40, 0, 41, 1)]
    done = [(r["n"], vector.read(r["geom"])) for r in vector.dissolve(layer(spark, shapes), 3, no_holes=True).orderBy("orig_fid").collect()]
    assert [n for n, _ in done] == [3, 2, 1] and kernel.area(done[0][1]) == 108 and len(done[1][1]) == 2
    assert all(kernel.disjoint(a, b) for i, (_, a) in enumerate(done) for _, b in done[:i])
    kept = vector.dissolve(layer(spark, shapes), 3).collect()
    assert sum(r["n"] for r in kept) == 6 and len(kept) == 4
    assert vector.dissolve(layer(spark, shapes).limit(0), 3).count() == 0


def test_slices_keep_area(spark):
    grid = GridSpec(0, 10, 1, -1, 10, 10)
    shapes = [[[[(0.5, 0.5), (7.3, 2.1), (3.3, 8.8), (0.5, 0.5)]]], HOLED]
    got = vector.grid_slice(layer(spark, shapes), grid, "fid").groupBy("id").agg(F.sum(geo.area("geom")).alias("a")).collect()
    assert {r["id"]: r["a"] for r in got} == {i: pytest.approx(kernel.area(g), rel=1e-6) for i, g in enumerate(shapes)}


def test_settlements_end_to_end(spark):
    cell = 0.00083333333
    shapes = [box(3 + i * 0.0004, 6 + j * 0.0004, 3.0002 + i * 0.0004, 6.0002 + j * 0.0004) for i in range(12) for j in range(12)]
    shapes += [box(3.05, 6.05, 3.0502, 6.0502), box(3.0504, 6.05, 3.0506, 6.0502)]
    out = settlements.settlements(layer(spark, shapes), GridSpec(2.9, 6.2, cell, -cell, 10, 10), settlements.Config(large=100, small=50))
    done = out["settlements"].orderBy("orig_fid").collect()
    assert len(done) == 2 and {r["bldg_count"]: r["level"] for r in done} == {144: 2, 2: 0}
    assert out["check"].first() == (146, 146)
    where = {r["fid"]: r["set_orig_fid"] for r in out["buildings"].collect()}
    assert len(where) == 146 and None not in where.values() and len({where[i] for i in range(144)}) == 1 and where[144] == where[145] != where[0]
    geoms = [vector.read(r["geom"]) for r in done]
    assert kernel.disjoint(*geoms) and all(kernel.intersects(s, g) for s in shapes[:3] for g in geoms[:1])


def test_compare_generations(spark):
    grid = GridSpec(0, 10, 1, -1, 10, 10)
    one, two = [box(0, 0, 4, 4), box(6, 6, 6.3, 6.3)], [box(2, 0, 6, 4)]
    out = settlements.compare_generations(layer(spark, one), layer(spark, two), grid)
    got = {r["pair_key"]: r["cnt"] for r in out["main"].collect()}
    assert got == {"0_0": 8, "NA_0": 8, "0_NA": 8, "NA_1": 1}


def test_nearest_against_all(spark):
    rng = np.random.default_rng(2)
    p, q = rng.integers(-5000, 5000, (300, 2)).tolist(), rng.integers(-300, 4000, (40, 2)).tolist()
    points = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(p)], "id long, x long, y long")
    places = spark.createDataFrame([(i, x, y) for i, (x, y) in enumerate(q)], "place_id long, px long, py long")
    got = {r["id"]: (r["d2"], r["place_id"]) for r in joins.nearest(points, places, 200, 12).collect()}
    assert got == {i: min(((x - a) ** 2 + (y - b) ** 2, k) for k, (a, b) in enumerate(q)) for i, (x, y) in enumerate(p)}


def test_streaming_counts(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    events = spark.read.parquet(f"{d}/events.parquet").select("event_id", "user_id", "ts")
    events.repartition(3).write.parquet(str(tmp_path / "in"))
    grid = GridSpec(0, 400_000, 833, -833, 529, 481)
    stream = windowed_counts(spark.readStream.schema(events.schema).parquet(str(tmp_path / "in")), grid)
    q = stream.writeStream.outputMode("complete").format("memory").queryName("counted").option("checkpointLocation", str(tmp_path / "state")).start()
    q.processAllAvailable()
    q.stop()
    want = windowed_counts(events, grid)
    assert sorted(map(tuple, spark.table("counted").collect())) == sorted(map(tuple, want.collect()))


def test_square_of_metres():
    from geoloom.functions.grid import square_size

    width, height = square_size(3.0, 6.0, 4.0, 7.0, 100.0)
    assert abs(height * 110_600 - 100) < 0.3 and abs(width * 111_320 * 0.9936 - 100) < 0.3  # degrees of latitude and, at 6.5, of longitude


def test_database_sink(spark, tmp_path):
    from geoloom.sources import layers

    df = spark.createDataFrame([(1, "a"), (2, None)], "id long, name string")
    url = f"jdbc:derby:{tmp_path}/db;create=true"
    try:
        layers.write_jdbc(df, url, "places", driver="org.apache.derby.jdbc.EmbeddedDriver")
    except Exception as e:  # noqa: BLE001
        if "EmbeddedDriver" in str(e):
            import pytest

            pytest.skip("no driver in this Spark")
        raise
    layers.write_jdbc(df, url, "places", mode="append", driver="org.apache.derby.jdbc.EmbeddedDriver")
    assert spark.read.jdbc(url, "places", properties={"driver": "org.apache.derby.jdbc.EmbeddedDriver"}).count() == 4
