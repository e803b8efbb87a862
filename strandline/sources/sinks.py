"""Sinks: partitioned composites, layers with declared schemas, wide years, logs, lists and tile layers."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strandline.functions import geometry as g
from strandline.operators.stack import years_as_columns

#: Declared schemas of the layers.
SHORELINES = "year int, certainty string, eez_territory varchar(3)"
RATES = "uid string, rate_time double, incpt_time double, sig_time double, se_time double, outl_time varchar(130), angle_std double, valid_obs int, valid_span int, sce double, nsm double, max_year int, min_year int, certainty string, eez_territory varchar(3)"
#: Columns of a tile that one file holds.
STRIP = 2048
LOG_COLUMNS = ["time", "index", "status", "paths", "comment"]


def write_mosaic(mosaic: DataFrame, root: str, overwrite: bool = False) -> None:
    """Composites by period length, year and tile, a file for each strip of a tile. Partitions that exist stay as they are unless overwritten."""
    parts = ["period_len", "year", "tile_id"]
    if not overwrite:
        try:
            there = mosaic.sparkSession.read.option("basePath", root).parquet(root).select(*parts).distinct()
            mosaic = mosaic.join(there, parts, "left_anti")
        except AnalysisException as e:
            if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
                raise
    mode = "overwrite" if overwrite else "append"
    # a tile's rows go to a task a strip of columns, so a large tile is written by several
    strips = [F.expr(f"cast(x as long) div {STRIP}")] if "x" in mosaic.columns else []
    mosaic.repartition(*parts, *strips).write.option("partitionOverwriteMode", "dynamic").partitionBy(*parts).mode(mode).parquet(root)


def conforming(df: DataFrame, schema: str) -> DataFrame:
    """Exactly a schema's columns, cast to its types; text is cut to its declared width, columns that are missing are null."""
    out = []
    for f in T.StructType.fromDDL(schema):
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        if isinstance(f.dataType, T.VarcharType):
            out.append(F.left(c.cast("string"), F.lit(f.dataType.length)).alias(f.name))
        else:
            out.append(c.cast(f.dataType).alias(f.name))
    return df.select(*out, *[c for c in ("geometry", "vertices", "x", "y") if c in df.columns])


def write_shore(root: str, raster: DataFrame | None, lines: DataFrame, points: DataFrame | None) -> None:
    """The three products of a tile stage; the points may be missing."""
    if raster is not None:
        raster.write.mode("overwrite").parquet(f"{root}/raster")
    conforming(lines, SHORELINES).write.mode("overwrite").parquet(f"{root}/shorelines_annual")
    if points is not None:
        conforming(points, RATES).write.mode("overwrite").parquet(f"{root}/rates_of_change")


def year_wide(df: DataFrame, keys: list[str], value: str, years: list[int]) -> DataFrame:
    """A raster with a band a year."""
    return years_as_columns(df, keys, value, years)


def save_layer(df: DataFrame, name: str) -> None:
    df.write.mode("overwrite").saveAsTable(name)


def save_hotspots(by_radius: list[DataFrame]) -> list[str]:
    """Layers hotspots_zoom_1, 2, ... in the order of radii given (the largest first)."""
    names = [f"hotspots_zoom_{i + 1}" for i in range(len(by_radius))]
    for name, df in zip(names, by_radius, strict=True):
        save_layer(df, name)
    return names


def export_csv(df: DataFrame, path: str) -> None:
    """Plain tables; points as x and y, lines as well-known text."""
    if "vertices" in df.columns:
        text = F.concat(F.lit("LINESTRING ("), F.array_join(F.transform("vertices", lambda p: F.concat_ws(" ", p.x.cast("string"), p.y.cast("string"))), ", "), F.lit(")"))
        df = df.withColumn("vertices", text)
    df.write.mode("overwrite").csv(path, header=True)


def style_table(styles: DataFrame) -> DataFrame:
    """Styles with a dummy point, for formats in which every row needs one."""
    return styles.withColumns({"x": F.lit(0.0), "y": F.lit(0.0)})


#: The least zoom of a layer's tiles; the greatest is 13 for all. Fixed values.
MIN_ZOOM = {"hotspots_zoom_1": 0, "hotspots_zoom_2": 4, "hotspots_zoom_3": 7, "shorelines_annual": 10, "rates_of_change": 10}


def tile_layer(points: DataFrame, attributes: list[str]) -> DataFrame:
    """GeoJSON features in longitude (0 to 360) and latitude with the allowed attributes, as a tiler takes them."""
    lon, lat = g.shifted_longitude(g.to_longitude(F.col("x"))), g.to_latitude(F.col("y"))
    geometry = F.struct(F.lit("Point").alias("type"), F.array(lon, lat).alias("coordinates"))
    return points.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*attributes).alias("properties"), geometry.alias("geometry"))).alias("value"))


def line_layer(lines: DataFrame, attributes: list[str]) -> DataFrame:
    """GeoJSON features of lines, as tile_layer makes them of points."""
    place = lambda p: F.array(g.shifted_longitude(g.to_longitude(p.x)), g.to_latitude(p.y))
    geometry = F.struct(F.lit("LineString").alias("type"), F.transform("vertices", place).alias("coordinates"))
    return lines.select(F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*attributes).alias("properties"), geometry.alias("geometry"))).alias("value"))


def write_tiles(points: DataFrame, lines: DataFrame, hotspots: list[DataFrame], root: str) -> None:
    """Every layer's features as lines of JSON, in a folder a layer, for a tiler."""
    services = [f"wms_{x}" for x in ("abs", "conf", "grew", "retr", "sig", "good")]
    tile_layer(points, ["uid", "certainty", *services]).write.mode("overwrite").text(f"{root}/rates_of_change")
    line_layer(lines, ["year", "certainty"]).write.mode("overwrite").text(f"{root}/shorelines_annual")
    for i, spots in enumerate(hotspots, 1):
        tile_layer(spots, ["cid", "n", "certainty", *services]).write.mode("overwrite").text(f"{root}/hotspots_zoom_{i}")


def write_if_any(df: DataFrame, flag: str, path: str) -> bool:
    """Writes only if the flag is true anywhere; stops looking at the first row."""
    if df.where(F.col(flag)).limit(1).isEmpty():
        return False
    df.write.mode("overwrite").parquet(path)
    return True


def write_template(spark: SparkSession, schema: str, path: str) -> None:
    spark.createDataFrame([], schema).write.mode("errorifexists").parquet(path)


def append_log(rows: DataFrame, path: str) -> None:
    rows.select(*LOG_COLUMNS).write.mode("append").csv(path, sep="|", header=True)


def log_entry(tasks: DataFrame) -> DataFrame:
    """Log rows of tasks with (time, index, paths, error): complete with their paths, or error with the message."""
    failed = F.col("error").isNotNull()
    return tasks.select("time", "index", F.when(failed, "error").otherwise("complete").alias("status"), F.when(~failed, F.col("paths")).alias("paths"), F.col("error").alias("comment"))


def url_list(keys: DataFrame, base: str, without: str = "non_extrapolated") -> DataFrame:
    """(value): URLs of the keys that do not have a word in them, for a text file."""
    return keys.where(~F.contains(F.col("key"), F.lit(without))).select(F.concat(F.lit(base), F.col("key")).alias("value"))


def valid_encoding(options: dict, allowed: tuple[str, ...] = ("compression", "dtype", "zlib", "complevel")) -> dict:
    return {k: v for k, v in options.items() if k in allowed}


def rasterized(cells: DataFrame, rings: DataFrame) -> DataFrame:
    """(x, y, burned): 1 for the cells (unit squares with centre x, y) whose centre is in any ring."""
    b = rings.withColumn("_b", g.bounds(F.col("ring")))
    span = lambda lo, hi: F.sequence(F.floor(f"_b.{lo}"), F.floor(f"_b.{hi}"))
    dealt = b.withColumn("_i", F.explode(span("minx", "maxx"))).withColumn("_j", F.explode(span("miny", "maxy"))).select("_i", "_j", "ring")
    met = cells.select("x", "y", F.floor("x").alias("_i"), F.floor("y").alias("_j")).join(dealt, ["_i", "_j"], "left")
    return met.groupBy("x", "y").agg(F.max(F.coalesce(g.inside(F.col("x"), F.col("y"), F.col("ring")), F.lit(False)).cast("int")).alias("burned"))
