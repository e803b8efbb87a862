"""Sources: tables with pruning by box and period, logs, metadata XML, GeoJSON, compressed and binary files, generators."""

from __future__ import annotations

import lzma
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Columns of the task log.
LOG_SCHEMA = "time string, index string, status string, paths string, comment string"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def in_box(df: DataFrame, minx: float, miny: float, maxx: float, maxy: float) -> DataFrame:
    """Rows whose box meets another: four range predicates, which Parquet's row-group statistics can skip by."""
    return df.where((F.col("maxx") >= minx) & (F.col("minx") <= maxx) & (F.col("maxy") >= miny) & (F.col("miny") <= maxy))


def catalogue(items: DataFrame, first: str, last: str, box: tuple[float, float, float, float] | None = None, **equal: str) -> DataFrame:
    """Catalogue items in a time range, a box and with given property values."""
    found = items.where(F.col("datetime").between(first, last))
    for name, value in equal.items():
        found = found.where(F.col(name) == value)
    return in_box(found, *box) if box else found


def mosaics(spark: SparkSession, root: str, period_len: int | None = None, years: tuple[int, int] | None = None, tile: str | None = None) -> DataFrame:
    """Stored composites: one partitioned read, pruned by composite length, years and tile. What is missing has no rows."""
    df = spark.read.option("basePath", root).parquet(root)
    if period_len is not None:
        df = df.where(F.col("period_len") == period_len)
    if years is not None:
        df = df.where(F.col("year").between(*years))
    return df if tile is None else df.where(F.col("tile_id") == tile)


def log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="|", header=True, schema=LOG_SCHEMA)


def csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema)


def layers(spark: SparkSession, database: str = "default") -> list[str]:
    """Names of a database's tables, without the style table."""
    return sorted(r.tableName for r in spark.sql(f"SHOW TABLES IN {database}").collect() if not r.isTemporary and r.tableName != "layer_styles")


def files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """(path, length, content) of the files below a folder that match a pattern; bytes are read only where they are used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "length", "content")


def unpacked(packed: DataFrame) -> DataFrame:
    """Files with their LZMA content unpacked, file by file."""

    @F.pandas_udf("binary")
    def unpack(content: pd.Series) -> pd.Series:
        return content.map(lzma.decompress)

    return packed.withColumn("content", unpack("content"))


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


IMAGE_XML = """
    PRODUCTLEVEL string, IMAGE struct<CATID: string>,
    MAP_PROJECTED_PRODUCT struct<
        EARLIESTACQTIME: string, DATUMNAME: string, MAPPROJNAME: string, MAPZONE: int, MAPHEMI: string,
        ULX: double, ULY: double, LRX: double, LRY: double, COLSPACING: double, ROWSPACING: double>
"""


def image_metadata(spark: SparkSession, root: str) -> DataFrame:
    """Acquisition time, projection and bounds from imagery XML files; files without the projected product are left out."""
    raw = spark.read.format("xml").option("rowTag", "IMD").schema(IMAGE_XML).load(root)
    m = F.col("MAP_PROJECTED_PRODUCT")
    corners_x, corners_y = (m.ULX, m.LRX), (m.ULY, m.LRY)
    return raw.where(m.EARLIESTACQTIME.isNotNull()).select(
        F.col("IMAGE.CATID").alias("image_id"), F.col("PRODUCTLEVEL").alias("product_level"), F.to_timestamp(m.EARLIESTACQTIME).alias("time"),
        m.DATUMNAME.alias("datum"), m.MAPPROJNAME.alias("proj"), m.MAPZONE.alias("utm_zone"), m.MAPHEMI.alias("utm_hemi"),
        F.least(*corners_x).alias("xmin"), F.least(*corners_y).alias("ymin"), F.greatest(*corners_x).alias("xmax"), F.greatest(*corners_y).alias("ymax"),
        m.COLSPACING.alias("res_x"), m.ROWSPACING.alias("res_y"),
    )


def geojson_features(texts: DataFrame, properties: str, column: str = "value") -> DataFrame:
    """A row for each feature of GeoJSON texts: its properties (a schema), and its geometry's type and coordinates as JSON."""
    schema = f"features array<struct<properties: struct<{properties}>, geometry: struct<type: string, coordinates: string>>>"
    return texts.select(F.explode(F.from_json(column, schema).features).alias("f")).select("f.properties.*", F.col("f.geometry.type").alias("geometry_type"), F.col("f.geometry.coordinates").alias("coordinates"))


def empty_cube(spark: SparkSession, nx: int, ny: int, res: float, times: DataFrame) -> DataFrame:
    """(x, y, ts): the cell centres of a grid at every time."""
    cells = spark.range(nx).select(((F.col("id") + 0.5) * res).alias("x")).withColumn("y", F.explode(F.transform(F.sequence(F.lit(0), F.lit(ny - 1)), lambda j: (j + 0.5) * res)))
    return cells.crossJoin(times.select("ts"))


def register_grid_source(spark: SparkSession) -> None:
    """A data source "strandline_grid" (options nx, ny, res, blocks) that makes cell centres block by block, so that a cube's
    frame of any size is generated where it is used."""
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Rows(InputPartition):
        def __init__(self, first: int, last: int) -> None:
            self.first, self.last = first, last

    class Reader(DataSourceReader):
        def __init__(self, options: dict[str, str]) -> None:
            self.nx, self.ny, self.blocks = (int(options.get(k, d)) for k, d in (("nx", "10"), ("ny", "10"), ("blocks", "4")))
            self.res = float(options.get("res", "1"))

        def partitions(self) -> list[InputPartition]:
            cuts = [self.ny * i // self.blocks for i in range(self.blocks + 1)]
            return [Rows(a, b) for a, b in zip(cuts, cuts[1:], strict=False) if a < b]

        def read(self, partition: InputPartition) -> Iterator[tuple]:
            for j in range(partition.first, partition.last):
                for i in range(self.nx):
                    yield (i, j, (i + 0.5) * self.res, (j + 0.5) * self.res)

    class Grid(DataSource):
        @classmethod
        def name(cls) -> str:
            return "strandline_grid"

        def schema(self) -> str:
            return "i int, j int, x double, y double"

        def reader(self, schema) -> DataSourceReader:  # noqa: ANN001
            return Reader(self.options)

    spark.dataSource.register(Grid)


def model(path: str):  # noqa: ANN201
    """A fitted pipeline from a folder."""
    from pyspark.ml import PipelineModel

    return PipelineModel.load(path)
