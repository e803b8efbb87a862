"""Queries of the mosaic stage: indices, cloud masks, composites, periods, storage form, catalogue."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import dates, indices
from strandline.functions.indices import BANDS
from strandline.operators import mosaic
from strandline.plans.cube import ANNUAL, CELL, DAILY, FIRST, LAST, OBS, ORDER, annual, composite_sql, daily, nr, obs, rounded, twndwi_sql
from strandline.sources import tables

SPREADS = [*BANDS, "twndwi", *[f"{b}_mad" for b in (*BANDS, "twndwi")], "twndwi_stdev"]
KEY = ["okey", "lnum", "pkey", "skey"]


def _index(name: str):  # noqa: ANN202
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return rounded(indices.with_indices(obs(spark, sf_dir)).select(*KEY, "ts", name), name).drop("ts")

    return query


def _index_sql(name: str, expr: str) -> str:
    return f"WITH {OBS} SELECT okey, lnum, pkey, skey, round({expr}, 6) + 0.0 AS {name} FROM obs"


def index_unscaled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The blended index from stored numbers, with the cutoff that belongs to them."""
    o = obs(spark, sf_dir)
    stored = o.select(*KEY, *[F.round(F.col(b) * 10000).alias(b) for b in BANDS])
    i = indices.twndwi(F.col("green"), F.col("nir08"), F.col("swir16"), cutoff=indices.cutoff_for(False))
    return rounded(stored.select(*KEY, i.alias("twndwi")), "twndwi")


def quality_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    clear = indices.bit_clear(F.col("qa_pixel"), 8)
    value = mosaic.scaled_by_processor(F.col("qty") * 1000, 0.0000275, -0.2)
    return rounded(obs(spark, sf_dir).select(*KEY, clear.alias("clear"), F.when(clear, value).alias("reflectance")), "reflectance")


def day_cloud_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = mosaic.mask_clouds_by_day(obs(spark, sf_dir), CELL, ["green", "nir08"])
    return rounded(m.select(*KEY, "masked", "green", "nir08", F.date_format("day", "yyyy-MM-dd").alias("day")), "green", "nir08")


def daily_first_obs(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = daily(spark, sf_dir).select(*CELL, F.date_format("day", "yyyy-MM-dd").alias("day"), *BANDS)
    return rounded(d, *BANDS)


def annual_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(annual(spark, sf_dir).withColumn("count", F.col("count").cast("int")), *SPREADS)


def _three_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = dates.spread_over_composites(daily(spark, sf_dir), 3, FIRST, LAST)
    return mosaic.composite(spread.drop("year").withColumnRenamed("period_year", "year"), [*CELL, "year"], list(BANDS))


def three_year_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = dates.composite_label(F.col("year"), 3)
    return rounded(_three_years(spark, sf_dir).withColumn("count", F.col("count").cast("int")).withColumn("period", label), *SPREADS)


THREE = f"""{ANNUAL},
spread AS (SELECT * EXCLUDE (year), unnest([year - 1, year, year + 1]) AS year FROM daily),
three AS ({composite_sql('spread', 'tile, x, y, year')} HAVING year BETWEEN {FIRST} AND {LAST})"""
_rounded = ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in SPREADS)


def multi_period_stack(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both composite lengths in one table."""
    one = annual(spark, sf_dir).withColumn("period_len", F.lit(1))
    both = one.unionByName(_three_years(spark, sf_dir).withColumn("period_len", F.lit(3)))
    return rounded(both.select(*CELL, "year", "period_len", "twndwi", F.col("count").cast("int").alias("count")), "twndwi")


def composite_periods(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = obs(spark, sf_dir).select("year").distinct()
    p = dates.composite_periods(years)
    return p.select("year", "period_len", "period", dates.middle_year(F.col("period")).alias("middle"), F.size(dates.years_of_range(F.col("period"))).alias("n_years"))


def quantize_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = [*CELL, "year"]
    a = annual(spark, sf_dir).select(*keys, *[F.round(b, 6).alias(b) for b in ("green", "red", "twndwi")], F.round("twndwi_mad", 6).alias("twndwi_mad"))
    stored = indices.quantize(a, keys)
    back = indices.unscale(stored, keys).select(*keys, F.col("green").alias("green_back"), F.col("twndwi").alias("twndwi_back"))
    named = stored.select(*keys, F.col("green").cast("int").alias("green"), F.col("red").cast("int").alias("red"), F.col("twndwi").cast("int").alias("twndwi"), "twndwi_mad")
    return rounded(named.join(back, keys), "green_back", "twndwi_back", "twndwi_mad")


def restored_indices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indices made anew from the median bands; the stored spread of twndwi stays."""
    r = indices.with_indices(annual(spark, sf_dir))
    return rounded(r.select(*CELL, "year", *indices.INDICES, "twndwi_mad"), *indices.INDICES, "twndwi_mad")


def items_of_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue items by the year of a time that is written in either of two forms."""
    o = tables.table(spark, sf_dir, "orders")
    text = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(F.col("o_orderkey") % 2 == 0, "T10:11:12Z").otherwise("T10:11:12.345678Z"))
    items = o.select("o_orderkey", text.alias("datetime"))
    found = mosaic.items_of_years(items, [1996, 1997])
    return found.select("o_orderkey", F.year(dates.parsed(F.col("datetime"))).alias("year"))


def catalogue_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = tables.table(spark, sf_dir, "orders")
    tile = F.lpad((F.col("o_custkey") % 60).cast("string"), 2, "0")
    from strandline.functions.text import mgrs_code

    items = o.select("o_orderkey", F.col("o_orderdate").alias("datetime"), mgrs_code(F.concat(tile, F.lit("KLA"))).alias("grid_code"), (F.col("o_totalprice") % 100).alias("minx"), (F.col("o_totalprice") % 100 + 5).alias("maxx"), (F.col("o_orderkey") % 50).cast("double").alias("miny"), (F.col("o_orderkey") % 50 + 5).cast("double").alias("maxy"))
    found = tables.catalogue(items, "1996-01-01", "1999-12-31", (10.0, 10.0, 60.0, 40.0), grid_code="MGRS-7KLA")
    return found.select("o_orderkey", "grid_code")


def clipped_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Observations in a window of cells, columns pruned at the scan, only finite values."""
    o = obs(spark, sf_dir).where("x between 3 and 12 and y between 5 and 15")
    ratio = F.try_divide(F.col("qty"), F.col("qty") - 25)
    return rounded(o.select(*KEY, "x", "y", indices.finite(ratio).alias("ratio")), "ratio")


QUERIES = {
    **{f"index_{n}": _index(n) for n in indices.INDICES},
    **{f.__name__: f for f in (
        index_unscaled, quality_mask, day_cloud_mask, daily_first_obs, annual_mosaic, three_year_mosaic, multi_period_stack, composite_periods,
        quantize_roundtrip, restored_indices, items_of_years, catalogue_search, clipped_bands,
    )},
}

_q = lambda c: f"CASE WHEN round({c} * 10000) BETWEEN -32766 AND 32767 THEN CAST(round({c} * 10000) AS INT) ELSE -32767 END"
ORACLE_SQL = {
    "index_mndwi": _index_sql("mndwi", nr("green", "swir16")),
    "index_ndwi": _index_sql("ndwi", nr("green", "nir08")),
    "index_nirwi": _index_sql("nirwi", nr("0.128", "nir08")),
    "index_twndwi": _index_sql("twndwi", twndwi_sql()),
    "index_unscaled": f"""WITH {OBS}, stored AS (SELECT okey, lnum, pkey, skey, round(green*10000) AS green, round(nir08*10000) AS nir08, round(swir16*10000) AS swir16 FROM obs)
        SELECT okey, lnum, pkey, skey, round({twndwi_sql(c='1280.0')}, 6) + 0.0 AS twndwi FROM stored""",
    "quality_mask": f"""WITH {OBS} SELECT okey, lnum, pkey, skey, (qa_pixel & 8) = 0 AS clear,
        CASE WHEN (qa_pixel & 8) = 0 THEN round(qty * 1000 * 0.0000275 - 0.2, 6) + 0.0 END AS reflectance FROM obs""",
    "day_cloud_mask": f"""WITH {OBS}, m AS (SELECT *, date_trunc('day', ts) AS d, bool_or(cloudy) OVER (PARTITION BY tile, x, y, date_trunc('day', ts)) AS masked FROM obs)
        SELECT okey, lnum, pkey, skey, masked, CASE WHEN NOT masked THEN round(green, 6) + 0.0 END AS green,
               CASE WHEN NOT masked THEN round(nir08, 6) + 0.0 END AS nir08, strftime(d, '%Y-%m-%d') AS day FROM m""",
    "daily_first_obs": f"WITH {DAILY} SELECT tile, x, y, strftime(day, '%Y-%m-%d') AS day, {', '.join(f'round({b}, 6) + 0.0 AS {b}' for b in BANDS)} FROM daily",
    "annual_mosaic": f"WITH {ANNUAL} SELECT tile, x, y, year, count, {_rounded} FROM annual",
    "three_year_mosaic": f"WITH {THREE} SELECT tile, x, y, year, count, {_rounded}, (year - 1) || '/' || (year + 1) AS period FROM three",
    "multi_period_stack": f"""WITH {THREE} SELECT tile, x, y, year, 1 AS period_len, round(twndwi, 6) + 0.0 AS twndwi, count FROM annual
        UNION ALL SELECT tile, x, y, year, 3, round(twndwi, 6) + 0.0, count FROM three""",
    "composite_periods": f"""WITH {OBS}, y AS (SELECT DISTINCT year FROM obs)
        SELECT year, 1 AS period_len, CAST(year AS VARCHAR) AS period, year AS middle, 1 AS n_years FROM y
        UNION ALL SELECT year, 3, (year - 1) || '/' || (year + 1), year, 3 FROM y""",
    "quantize_roundtrip": f"""WITH {ANNUAL}, a AS (SELECT tile, x, y, year, round(green, 6) AS g, round(red, 6) AS r, round(twndwi, 6) AS t, round(twndwi_mad, 6) AS m FROM annual),
        q AS (SELECT tile, x, y, year, {_q('g')} AS green, {_q('r')} AS red, {_q('t')} AS twndwi, m AS twndwi_mad FROM a)
        SELECT tile, x, y, year, green, red, twndwi, twndwi_mad + 0.0 AS twndwi_mad, round(nullif(green, -32767) / 10000.0, 6) + 0.0 AS green_back, round(nullif(twndwi, -32767) / 10000.0, 6) + 0.0 AS twndwi_back FROM q""",
    "restored_indices": f"""WITH {ANNUAL} SELECT tile, x, y, year, round({nr('green', 'swir16')}, 6) + 0.0 AS mndwi, round({nr('green', 'nir08')}, 6) + 0.0 AS ndwi,
        round({nr('0.128', 'nir08')}, 6) + 0.0 AS nirwi, round({twndwi_sql()}, 6) + 0.0 AS twndwi, round(twndwi_mad, 6) + 0.0 AS twndwi_mad FROM annual""",
    "items_of_years": "SELECT o_orderkey, CAST(year(o_orderdate) AS INT) AS year FROM orders WHERE year(o_orderdate) IN (1996, 1997)",
    "catalogue_search": """SELECT o_orderkey, 'MGRS-7KLA' AS grid_code FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-01-01' AND TIMESTAMP '1999-12-31'
        AND o_custkey % 60 = 7 AND o_totalprice % 100 + 5 >= 10 AND o_totalprice % 100 <= 60 AND o_orderkey % 50 + 5 >= 10 AND o_orderkey % 50 <= 40""",
    "clipped_bands": f"WITH {OBS} SELECT okey, lnum, pkey, skey, x, y, round(qty / nullif(qty - 25, 0), 6) + 0.0 AS ratio FROM obs WHERE x BETWEEN 3 AND 12 AND y BETWEEN 5 AND 15",
}
