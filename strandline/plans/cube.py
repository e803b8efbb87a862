"""The observation cube that the queries run on, derived from lineitem, and its twin in SQL.

Cells are 20 x 20, in four tiles; a growing island with a lake and a second island are planted in the bands, so that masks,
contours and trends are not empty at any scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions.indices import BANDS
from strandline.operators.mosaic import composite, masked_daily
from strandline.sources.tables import table

CELL = ["tile", "x", "y"]
#: A total order of observations.
ORDER = ["ts", "okey", "lnum", "pkey", "skey", "qty", "price"]
FIRST, LAST = 1995, 2001


def obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = table(spark, sf_dir, "lineitem").select(
        F.expr("cast(l_partkey % 20 as int)").alias("x"), F.expr("cast(l_suppkey % 20 as int)").alias("y"),
        F.col("l_shipdate").alias("ts"), F.year("l_shipdate").alias("year"), (F.col("l_returnflag") == "R").alias("cloudy"),
        F.when(F.col("l_returnflag") == "R", 8).when(F.col("l_returnflag") == "A", 16).otherwise(0).alias("qa_pixel"),
        F.col("l_orderkey").alias("okey"), F.col("l_linenumber").alias("lnum"), F.col("l_partkey").alias("pkey"), F.col("l_suppkey").alias("skey"),
        F.col("l_quantity").alias("qty"), F.col("l_extendedprice").alias("price"), F.col("l_discount").alias("disc"), F.col("l_tax").alias("tax"),
    )
    first = "(x-7)*(x-7)+(y-8)*(y-8) <= 14+3*(year-1995) and not (x in (6,7) and y=8)"
    second = "(x-15)*(x-15)+(y-14)*(y-14) <= 9"
    land = raw.withColumn("island", F.expr(f"case when ({first}) or ({second}) then 1 else 0 end"))
    return land.select(
        F.expr("(x div 10)*10 + y div 10").cast("int").alias("tile"), "x", "y", "ts", "year", "cloudy", "qa_pixel", *ORDER[1:], "island",
        (F.col("qty") / 100).alias("green"), (F.col("qty") / 200 + 0.01).alias("blue"), (F.col("price") / 123457).alias("red"),
        ((F.col("disc") + 0.03) * (1 + 3 * F.col("island"))).alias("nir08"), ((F.col("tax") + 0.01) * (1 + 8 * F.col("island"))).alias("swir16"),
        ((F.col("tax") + 0.01) * 0.5).alias("swir22"),
    )


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One cloud-free observation a cell and day, with its year."""
    return masked_daily(obs(spark, sf_dir), CELL, list(BANDS), ORDER).withColumn("year", F.year("day"))


def annual(spark: SparkSession, sf_dir: str) -> DataFrame:
    return composite(daily(spark, sf_dir), [*CELL, "year"], list(BANDS))


def yearly_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tile, x, y, year, twndwi): the composites' index, rounded, so that signs and ties do not hang on the last bit."""
    return annual(spark, sf_dir).select(*CELL, "year", F.round("twndwi", 6).alias("twndwi"))


def rounded(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    """Named columns rounded, and without minus zero."""
    return df.withColumns({n: F.round(F.col(n), places) + F.lit(0.0) for n in names})


def cut(df: DataFrame, *names: str, places: int = 6) -> DataFrame:
    """Named columns cut to a number of places, at an offset. Exact decimals lie on the borders of rounding, where the last bit
    of a sum would decide; here they do not."""
    return df.withColumns({n: F.floor(F.col(n) * 10**places + 0.3713579) / 10**places for n in names})


def cut_sql(expr: str, places: int = 6) -> str:
    return f"floor(({expr}) * {10**places} + 0.3713579) / {10**places}"


# The same in DuckDB's SQL ---------------------------------------------------------------------------------------------------


def nr(a: str, b: str) -> str:
    return f"(({a}) - ({b})) / nullif(({a}) + ({b}), 0)"


def twndwi_sql(g: str = "green", n: str = "nir08", s: str = "swir16", c: str = "0.128") -> str:
    adapted = f"CASE WHEN {n} >= {c} AND {g} < {c} THEN {g} ELSE {c} END"
    return f"(0.5 * {nr(g, s)} + 0.5 * {nr(adapted, n)})"


OBS = """obs AS (
    SELECT CAST((x // 10) * 10 + y // 10 AS INT) AS tile, *, qty / 100 AS green, qty / 200 + 0.01 AS blue, price / 123457 AS red,
           (disc + 0.03) * (1 + 3 * island) AS nir08, (tax + 0.01) * (1 + 8 * island) AS swir16, (tax + 0.01) * 0.5 AS swir22
    FROM (SELECT *, CASE WHEN ((x-7)*(x-7)+(y-8)*(y-8) <= 14+3*(year-1995) AND NOT (x IN (6,7) AND y=8))
                           OR (x-15)*(x-15)+(y-14)*(y-14) <= 9 THEN 1 ELSE 0 END AS island
          FROM (SELECT CAST(l_partkey % 20 AS INT) AS x, CAST(l_suppkey % 20 AS INT) AS y, l_shipdate AS ts,
                       CAST(year(l_shipdate) AS INT) AS year, l_returnflag = 'R' AS cloudy,
                       CASE l_returnflag WHEN 'R' THEN 8 WHEN 'A' THEN 16 ELSE 0 END AS qa_pixel,
                       l_orderkey AS okey, l_linenumber AS lnum, l_partkey AS pkey, l_suppkey AS skey,
                       l_quantity AS qty, l_extendedprice AS price, l_discount AS disc, l_tax AS tax
                FROM lineitem)))"""

_first = ", ".join(f"arg_min({b}, row(ts, okey, lnum, pkey, skey, qty, price)) FILTER (WHERE {b} IS NOT NULL) AS {b}" for b in BANDS)
_masked = ", ".join(f"CASE WHEN NOT masked THEN {b} END AS {b}" for b in BANDS)
DAILY = f"""{OBS},
first_of_day AS (
    SELECT tile, x, y, date_trunc('day', ts) AS day, bool_or(cloudy) AS masked, {_first}
    FROM obs GROUP BY tile, x, y, date_trunc('day', ts)),
daily0 AS (SELECT tile, x, y, day, CAST(year(day) AS INT) AS year, {_masked} FROM first_of_day),
daily AS (SELECT *, {twndwi_sql()} AS twndwi FROM daily0)"""


def composite_sql(source: str, keys: str) -> str:
    names = [*BANDS, "twndwi"]
    medians = ", ".join(f"median({b}) AS {b}, mad({b}) AS {b}_mad" for b in names)
    return f"SELECT {keys}, {medians}, CAST(count(nir08) AS INT) AS count, stddev_pop(twndwi) AS twndwi_stdev FROM {source} GROUP BY {keys}"


ANNUAL = f"{DAILY},\nannual AS ({composite_sql('daily', 'tile, x, y, year')})"
INDEX = f"{ANNUAL},\nidx AS (SELECT tile, x, y, year, round(twndwi, 6) AS twndwi FROM annual)"
