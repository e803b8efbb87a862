"""Sources and sinks on small files."""

import lzma

import pytest
from pyspark.sql import functions as F

from strandline.sources import sinks, tables
from strandline.streaming.masks import daily_masks

IMD = """<isd><IMD><PRODUCTLEVEL>LV2A</PRODUCTLEVEL><IMAGE><CATID>{id}</CATID></IMAGE>{product}</IMD><TIL><IMAGE><CATID>x</CATID></IMAGE></TIL></isd>"""
PRODUCT = """<MAP_PROJECTED_PRODUCT><EARLIESTACQTIME>2011-03-13T21:20:37.433698Z</EARLIESTACQTIME><DATUMNAME>WE</DATUMNAME><MAPPROJNAME>UTM</MAPPROJNAME><MAPZONE>4</MAPZONE><MAPHEMI>S</MAPHEMI>
<COLSPACING>5.0e-01</COLSPACING><ROWSPACING>5.0e-01</ROWSPACING><ULX>4.1e+05</ULX><ULY>7.66e+06</ULY><LRX>4.2e+05</LRX><LRY>7.65e+06</LRY></MAP_PROJECTED_PRODUCT>"""


def test_image_metadata(spark, tmp_path):
    (tmp_path / "a.XML").write_text(IMD.format(id="A1", product=PRODUCT))
    (tmp_path / "b.XML").write_text(IMD.format(id="B2", product=""))
    rows = tables.image_metadata(spark, str(tmp_path)).collect()
    assert [(r.image_id, r.utm_zone, r.utm_hemi, r.xmin, r.ymin, r.xmax, r.ymax, r.res_x, r.time.year) for r in rows] == [("A1", 4, "S", 4.1e5, 7.65e6, 4.2e5, 7.66e6, 0.5, 2011)]


def test_packed_files(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep/t.nc.xz").write_bytes(lzma.compress(b"tide"))
    (tmp_path / "t.txt").write_text("no")
    rows = tables.unpacked(tables.files(spark, str(tmp_path), "*.xz")).collect()
    assert [bytes(r.content) for r in rows] == [b"tide"]


def test_log_round_trip(spark, tmp_path):
    path = str(tmp_path / "log")
    tasks = spark.createDataFrame([("t1", "1,2", "a.tif", None), ("t2", "1,3", "b.tif", "boom")], "time string, index string, paths string, error string")
    sinks.append_log(sinks.log_entry(tasks), path)
    sinks.append_log(sinks.log_entry(tasks), path)
    got = sorted(tuple(r) for r in tables.log(spark, path).collect())
    assert got == sorted(2 * [("t1", "1,2", "complete", "a.tif", None), ("t2", "1,3", "error", None, "boom")])


def test_mosaics_are_written_once_and_pruned(spark, tmp_path):
    root = str(tmp_path / "mosaics")
    m = spark.createDataFrame([(1, 2000, "a", 1.0), (1, 2001, "a", 2.0), (3, 2000, "b", 3.0)], "period_len int, year int, tile_id string, v double")
    sinks.write_mosaic(m, root)
    sinks.write_mosaic(m.withColumn("v", F.lit(9.0)).unionByName(spark.createDataFrame([(1, 2002, "a", 4.0)], m.schema)), root)
    read = lambda **k: sorted(r.v for r in tables.mosaics(spark, root, **k).collect())
    assert read() == [1.0, 2.0, 3.0, 4.0] and read(period_len=1) == [1.0, 2.0, 4.0] and read(years=(2000, 2000), tile="b") == [3.0] and read(tile="z") == []
    plan = tables.mosaics(spark, root, 1, (2001, 2002), "a")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(period_len" in plan
    sinks.write_mosaic(m.where("year = 2001").withColumn("v", F.lit(7.0)), root, overwrite=True)
    assert 7.0 in read() and tables.exists(spark, root) and not tables.exists(spark, root + "x")


def test_boxes_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "boxes")
    spark.createDataFrame([(1, 0.0, 0.0, 1.0, 1.0), (2, 5.0, 5.0, 6.0, 6.0)], "i int, minx double, miny double, maxx double, maxy double").write.parquet(path)
    found = tables.in_box(spark.read.parquet(path), 4, 4, 5.5, 7)
    assert [r.i for r in found.collect()] == [2] and "GreaterThanOrEqual(maxx,4.0)" in found._jdf.queryExecution().toString()


def test_features_and_lists(spark):
    text = '{"features": [{"properties": {"name": "a"}, "geometry": {"type": "Point", "coordinates": [1, 2]}}, {"properties": {"name": "b"}, "geometry": null}]}'
    rows = tables.geojson_features(spark.createDataFrame([(text,)], "value string"), "name string").collect()
    assert [(r.name, r.geometry_type, r.coordinates) for r in rows] == [("a", "Point", "[1,2]"), ("b", None, None)]
    keys = spark.createDataFrame([("a.nc",), ("b_non_extrapolated.nc",)], "key string")
    assert [r.value for r in sinks.url_list(keys, "u/").collect()] == ["u/a.nc"]
    assert sinks.valid_encoding({"dtype": 1, "other": 2}) == {"dtype": 1}


def test_layers(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS layers_test")
    spark.sql("USE layers_test")
    try:
        assert sinks.save_hotspots([spark.range(2), spark.range(3)]) == ["hotspots_zoom_1", "hotspots_zoom_2"]
        sinks.save_layer(sinks.style_table(spark.range(1)), "layer_styles")
        assert tables.layers(spark, "layers_test") == ["hotspots_zoom_1", "hotspots_zoom_2"]
    finally:
        spark.sql("USE default")
        spark.sql("DROP DATABASE layers_test CASCADE")
    lines = spark.createDataFrame([(2000, "good", "COOK", [(0.0, 1.0), (2.0, 3.0)])], "year int, certainty string, eez_territory string, vertices array<struct<x:double,y:double>>")
    sinks.write_shore(str(tmp_path), None, lines, None)
    back = spark.read.parquet(str(tmp_path / "shorelines_annual")).first()
    assert back.eez_territory == "COO" and back.vertices[1].y == 3.0 and not (tmp_path / "rates_of_change").exists()
    sinks.export_csv(lines, str(tmp_path / "csv"))
    assert tables.csv(spark, str(tmp_path / "csv"), "year int, certainty string, eez_territory string, vertices string").first().vertices == "LINESTRING (0.0 1.0, 2.0 3.0)"
    flags = spark.createDataFrame([(False,), (None,)], "valid boolean")
    assert not sinks.write_if_any(flags, "valid", str(tmp_path / "none")) and sinks.write_if_any(flags.withColumn("valid", F.lit(True)), "valid", str(tmp_path / "some"))
    sinks.write_template(spark, sinks.SHORELINES.replace("varchar(3)", "string"), str(tmp_path / "template"))
    assert spark.read.parquet(str(tmp_path / "template")).count() == 0


def test_tile_features(spark):
    p = spark.createDataFrame([(1, 30.5 * 111319.49079327357, 0.0, "good")], "uid int, x double, y double, certainty string")
    assert sinks.tile_layer(p, ["certainty"]).first().value.startswith('{"type":"Feature","properties":{"certainty":"good"},"geometry":{"type":"Point","coordinates":[180.5')


def test_grid_source(spark):
    tables.register_grid_source(spark)
    df = spark.read.format("strandline_grid").options(nx="3", ny="5", res="10", blocks="2").load()
    assert df.count() == 15 and df.rdd.getNumPartitions() == 2 and df.agg(F.max("x"), F.max("y")).first() == (25.0, 45.0)


def test_daily_masks_stream(spark, tmp_path):
    rows = [(1, "2024-01-01 01:00:00", False), (1, "2024-01-01 05:00:00", True), (2, "2024-01-01 02:00:00", False), (1, "2024-01-09 00:00:00", False)]
    df = spark.createDataFrame(rows, "x int, ts string, cloudy boolean").withColumn("ts", F.col("ts").cast("timestamp"))
    df.write.parquet(str(tmp_path / "in"))
    q = daily_masks(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")), ["x"]).writeStream.format("memory").queryName("masks").outputMode("append").start()
    try:
        q.processAllAvailable()
        got = {(r.x, r.day.day): r.masked for r in spark.sql("select * from masks").collect()}
    finally:
        q.stop()
    assert got == {(1, 1): True, (2, 1): False}


def test_model_round_trip(spark, tmp_path):
    from strandline.operators import side

    rows = spark.createDataFrame([(float(i), float(i % 2), float(i % 2)) for i in range(40)] + [(None, 1.0, 1.0)], "a double, b double, label double")
    side.fit_forest(rows, "label", ["a", "b"], trees=5).write().overwrite().save(str(tmp_path / "model"))
    got = side.predict_forest(tables.model(str(tmp_path / "model")), rows, ["a", "b"]).collect()
    assert len(got) == 41 and all((r.prediction == r.label) if r.a is not None else r.prediction is None for r in got)


def test_missing_items_raise(spark):
    from strandline.operators.mosaic import items_of_years

    with pytest.raises(ValueError, match="no items"):
        items_of_years(spark.createDataFrame([("2020-01-01T00:00:00Z",)], "datetime string"), [1999])
