"""Queries of grids, tasks, training tables and validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import dates, text
from strandline.functions import geometry as g
from strandline.functions.stats import agreement
from strandline.operators import side, spatial
from strandline.plans.cube import rounded
from strandline.sources import sinks, tables
from strandline.sources.tables import table

# Grid -----------------------------------------------------------------------------------------------------------------------


def cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side.grid_cells(spark, range(8), range(6), 100.0)


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A box for each nation, as zones; one of them is the dropped zone."""
    n = table(spark, sf_dir, "nation")
    x, y = F.col("n_nationkey") * 41 % 700 + 13.0, F.col("n_nationkey") * 97 % 500 + 7.0
    return n.select((F.col("n_nationkey") + 2).alias("zone"), x.alias("minx"), y.alias("miny"), (x + 190).alias("maxx"), (y + 150).alias("maxy"))


GRID = """cells AS (SELECT CAST(c AS INT) AS "column", CAST(r AS INT) AS "row", c * 100.0::DOUBLE AS minx, r * 100.0::DOUBLE AS miny, c * 100.0::DOUBLE + 100 AS maxx, r * 100.0::DOUBLE + 100 AS maxy FROM range(8) a(c), range(6) b(r)),
    zones AS (SELECT n_nationkey + 2 AS zone, n_nationkey * 41 % 700 + 13.0 AS minx, n_nationkey * 97 % 500 + 7.0 AS miny, n_nationkey * 41 % 700 + 203.0 AS maxx, n_nationkey * 97 % 500 + 157.0 AS maxy FROM nation),
    met AS (SELECT "column", "row", zone, (least(c.maxx, z.maxx) - greatest(c.minx, z.minx)) * (least(c.maxy, z.maxy) - greatest(c.miny, z.miny)) AS area
            FROM cells c JOIN zones z ON c.minx < z.maxx AND z.minx < c.maxx AND c.miny < z.maxy AND z.miny < c.maxy)"""


def grid_best_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = side.best_zone(cells(spark, sf_dir), zones(spark, sf_dir), 120.0)
    return b.select("column", "row", F.coalesce("epsg", F.lit(0)).alias("epsg"))


def grid_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cells(spark, sf_dir).select("column", "row", "id", "tile_id")


def bbox_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All common boxes of cells and zones."""
    c = cells(spark, sf_dir).select("column", "row", "minx", "miny", "maxx", "maxy")
    return side.box_overlay(c, zones(spark, sf_dir), 120.0).select("column", "row", "zone", ((F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))).alias("area"))


def cells_in_aoi(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells that meet the buffered first region's zones."""
    return side.cells_in(cells(spark, sf_dir), side.buffered(zones(spark, sf_dir).where("zone < 7"), -20.0), 120.0).select("column", "row")


def cells_outside(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side.cells_outside(cells(spark, sf_dir), side.buffered(zones(spark, sf_dir).where("zone < 7"), 10.0), 120.0).select("column", "row")


def _met_sql(grow: float, negate: bool) -> str:
    return f"""WITH {GRID} SELECT "column", "row" FROM cells c WHERE {'NOT ' * negate}EXISTS (SELECT 1 FROM zones z WHERE zone < 7
        AND c.minx < z.maxx + {grow} AND z.minx - {grow} < c.maxx AND c.miny < z.maxy + {grow} AND z.miny - {grow} < c.maxy)"""


def dissolve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations of a region as one: bounds of all, the first name, and how many."""
    z = zones(spark, sf_dir).join(table(spark, sf_dir, "nation"), F.col("zone") == F.col("n_nationkey") + 2)
    return z.groupBy("n_regionkey").agg(F.min("minx").alias("minx"), F.max("maxy").alias("maxy"), F.min_by("n_name", "n_nationkey").alias("name"), F.count("*").alias("n"))


def overlapping_rasters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One value a cell where tiles overlap, that of the first tile."""
    li = table(spark, sf_dir, "lineitem").select((F.col("l_partkey") % 50).alias("x"), (F.col("l_suppkey") % 20).alias("y"), F.col("l_returnflag").alias("tile"), F.col("l_extendedprice").alias("v"))
    return spatial.first_of(li.groupBy("x", "y", "tile").agg(F.max("v").alias("v")), ["x", "y"], ["tile"])


def rasterized(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Diamonds burned into a raster of cell centres."""
    n = table(spark, sf_dir, "nation")
    cx, cy = F.col("n_nationkey") % 5 * 9 + 4.2, F.expr("n_nationkey div 5") * 8 + 4.3
    corner = lambda dx, dy: F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))
    rings = n.select(F.array(corner(-5, 0), corner(0, -4), corner(5, 0), corner(0, 4), corner(-5, 0)).alias("ring"))
    frame = tables.empty_cube(spark, 45, 40, 1.0, spark.sql("select date'2024-01-01' as ts")).drop("ts")
    return sinks.rasterized(frame, rings)


# Tasks ----------------------------------------------------------------------------------------------------------------------


def _tasks(spark: SparkSession, sf_dir: str, retry: bool) -> DataFrame:
    log = table(spark, sf_dir, "events").select((F.col("user_id") % 8).cast("int").alias("column"), F.expr("cast(user_id div 8 as int) % 6").cast("int").alias("row"), F.when(F.col("event_id") % 2 == 0, "1999/2024").otherwise("2000_2020").alias("datetime"), F.when(F.col("event_type").isin("error", "click"), "error").otherwise("complete").alias("status"))
    return side.task_list(cells(spark, sf_dir), ["1999/2024", "2000_2020", "1984/2024"], log.where("column + row < 7"), retry)


def task_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tasks(spark, sf_dir, True)


def task_list_unlogged(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _tasks(spark, sf_dir, False)


def _tasks_sql(only: str) -> str:
    return f"""WITH {GRID}, log AS (SELECT user_id % 8 AS c, CAST(user_id // 8 AS INT) % 6 AS r, CASE WHEN event_id % 2 = 0 THEN '1999/2024' ELSE '2000_2020' END AS d, event_type FROM events)
        SELECT "column", "row", datetime FROM cells, (VALUES ('1999/2024'), ('2000_2020'), ('1984/2024')) t(datetime)
        WHERE NOT EXISTS (SELECT 1 FROM log WHERE c = "column" AND r = "row" AND d = datetime AND c + r < 7 {only})"""


def task_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = side.task_list(cells(spark, sf_dir), ["1999/2024"]).select("column", "row", "datetime")
    return side.as_json_list(rows, ["column", "row"])


def tiles_by_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every listed tile in every year; a tile that is listed twice comes twice."""
    tiles = table(spark, sf_dir, "nation").select("n_name").unionAll(table(spark, sf_dir, "nation").where("n_nationkey = 3").select("n_name"))
    return tiles.withColumn("year", F.explode(F.sequence(F.lit(2017), F.lit(2024))))


def date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = spark.range(1).select(F.explode(dates.every("1984-01-01", "2025-01-01", 16)).alias("d"))
    return d.select(F.date_format("d", "yyyy-MM-dd").alias("day"))


def names_and_paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").withColumn("v", F.concat(F.col("p_brand"), F.element_at(F.array(F.lit("_interim"), F.lit("_raw"), F.lit("_processed"), F.lit("")), (F.col("p_size") % 4 + 1).cast("int"))))
    period = dates.composite_label(F.col("p_size") + 1990, 3)
    return p.select("p_partkey", text.without_stage(F.col("v")).alias("version"), text.path_safe(period).alias("path"), g.proj_text(F.col("p_size"), F.when(F.col("p_size") % 2 == 0, "S").otherwise("N")).alias("proj"), g.utm_epsg(F.col("p_size")).alias("epsg"))


def local_hours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two clock readings of local days in UTC."""
    o = table(spark, sf_dir, "orders")
    zone = F.when(F.col("o_custkey") % 2 == 0, "Pacific/Honolulu").otherwise("Pacific/Auckland")
    at = lambda c: F.date_format(dates.utc_of_local(F.col("o_orderdate"), c, zone), "yyyy-MM-dd HH:mm")
    return o.select("o_orderkey", at("10:30").alias("first"), at("11:30").alias("last"))


# Training -------------------------------------------------------------------------------------------------------------------


def training_prep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each time of a training point, with its code's classes."""
    p = table(spark, sf_dir, "part")
    time = F.when(F.col("p_size") % 5 == 0, "all").when(F.col("p_size") % 5 == 1, "2020/2022, 2021").when(F.col("p_size") % 5 == 2, " 2019 ,2020,2021").otherwise("2018")
    points = p.select("p_partkey", F.col("p_type").alias("code"), time.alias("time"))
    codes = table(spark, sf_dir, "part").groupBy(F.col("p_type").alias("code")).agg(F.min("p_size").alias("intcode")).where("code <> 'PROMO'")
    made = side.labelled(side.training_times(points), codes, dropped=("STANDARD",))
    return made.select("p_partkey", "code", "time", F.coalesce("intcode", F.lit(-1)).alias("intcode"))


def cloud_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training points with the published classes; two codes of the points are not among them, one is dropped."""
    names = F.array(*[F.lit(c[0]) for c in side.CODES], F.lit("shift"), F.lit("unknown"))
    points = table(spark, sf_dir, "part").select("p_partkey", F.element_at(names, (F.col("p_partkey") % 13 + 1).cast("int")).alias("code"))
    return side.labelled(points, side.codes(spark)).select("p_partkey", "code", F.coalesce("cloud", F.lit(-1)).alias("cloud"), F.coalesce("color", F.lit("")).alias("color"))


def class_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side.names_of_codes(side.codes(spark), "unified_water")


def validation_tiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side.validation_tiles(spark)


def total_bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spatial.total_bounds(table(spark, sf_dir, "customer").select(F.col("c_acctbal").alias("x"), F.col("c_custkey").alias("y")))


def nearest_cell(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raster values at points."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 100).alias("x"), (F.col("c_custkey") % 83 + 0.25).alias("y"))
    raster = table(spark, sf_dir, "lineitem").groupBy((F.col("l_partkey") % 40).alias("cx"), (F.col("l_suppkey") % 30).alias("cy")).agg(F.max("l_extendedprice").alias("value"))
    return spatial.nearest_cell(c, raster, 2.5, 1.0, 2.0).select("c_custkey", "cx", "cy", F.coalesce("value", F.lit(-1.0)).alias("value"))


# Validation -----------------------------------------------------------------------------------------------------------------


def _roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    rate = lambda m: (F.avg("o_totalprice") / m).alias("rate")
    cl = o.where("o_orderpriority < '4'").groupBy("o_custkey").agg(rate(9013.7), F.round(F.avg(F.col("o_orderkey") % 100) / 3000, 6).alias("sig_time"))
    val = o.where("o_orderpriority > '2'").groupBy("o_custkey").agg(rate(9113.3), F.round(F.avg(F.col("o_orderkey") % 100) / 3000, 6).alias("sig_time"))
    return side.compared(cl, val, ["o_custkey"])


ROC = """cl AS (SELECT o_custkey, avg(o_totalprice) / 9013.7 AS rate, round(avg(o_orderkey % 100) / 3000, 6) AS sig FROM orders WHERE o_orderpriority < '4' GROUP BY 1),
    val AS (SELECT o_custkey, avg(o_totalprice) / 9113.3 AS rate FROM orders WHERE o_orderpriority > '2' GROUP BY 1),
    roc AS (SELECT o_custkey, cl.rate AS cl_rate, val.rate AS val_rate, cl.sig AS cl_sig_time FROM cl FULL JOIN val USING (o_custkey))"""


def validation_roc(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roc(spark, sf_dir)
    none = F.lit(-1.0)
    return rounded(r.select("o_custkey", *[F.coalesce(c, none).alias(c) for c in ("cl_rate", "val_rate", "mae", "mse")]), "cl_rate", "val_rate", "mae", "mse", places=5)


def validation_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = _roc(spark, sf_dir).withColumn("set_id", F.col("o_custkey") % 12)
    return rounded(side.summary(r), "mae", "rmse", "sd", "r2")


def _summary_sql(name: str, where: str) -> str:
    return f"""SELECT '{name}' AS subset, round(avg(e), 6) + 0.0 AS mae, round(sqrt(avg(e * e)), 6) + 0.0 AS rmse, round(stddev_samp(e), 6) + 0.0 AS sd,
        round(1 - sum(e * e) / regr_sxx(cl_rate, val_rate), 6) + 0.0 AS r2, count(e) AS n, count(DISTINCT o_custkey % 12) AS n_sites FROM e WHERE {where}"""


def validation_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("set_id"), (F.col("l_quantity") * 1.3713 - 30).alias("diff"))
    return rounded(side.by_set_and_all(li), "bias", "mae", "rmse", "sd")


def validation_unbiased(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("set_id"), (F.col("l_quantity") * 1.3713 - 30).alias("diff"))
    return rounded(side.by_set_and_all(li, remove_bias=True), "bias", "mae", "rmse", "sd")


def _rollup_sql(source: str) -> str:
    return f"""WITH s AS (SELECT l_returnflag AS set_id, l_quantity * 1.3713 - 30 AS diff FROM lineitem), u AS (SELECT set_id, diff - avg(diff) OVER (PARTITION BY set_id) AS diff FROM s)
        SELECT CASE WHEN grouping(set_id) = 1 THEN 'all' ELSE set_id END AS set_id, count(diff) AS n, round(avg(diff), 6) + 0.0 AS bias, round(avg(abs(diff)), 6) + 0.0 AS mae,
               round(sqrt(avg(diff * diff)), 6) + 0.0 AS rmse, round(stddev_samp(diff), 6) + 0.0 AS sd FROM {source} GROUP BY ROLLUP (set_id)"""


def images_by_coast(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Images with the first coastline of their year that they meet, and those without one."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("catalog_id"), F.year("o_orderdate").alias("year"), (F.col("o_totalprice") / 1000).alias("minx"), (F.col("o_totalprice") / 1000 + 3).alias("maxx"), (F.col("o_custkey") % 100).cast("double").alias("miny"), (F.col("o_custkey") % 100 + 3).cast("double").alias("maxy"))
    s = table(spark, sf_dir, "supplier").select((F.col("s_suppkey") % 2 + 1995).cast("int").alias("cyear"), F.col("s_suppkey").alias("coast"), (F.col("s_acctbal") / 20).alias("minx"), (F.col("s_acctbal") / 20 + 4).alias("maxx"), (F.col("s_suppkey") * 7 % 100).cast("double").alias("miny"), (F.col("s_suppkey") * 7 % 100 + 4).cast("double").alias("maxy"))
    met = side.box_overlay(o, s, 10.0).where("year = cyear")
    first = spatial.first_of(met.select("catalog_id", "coast"), ["catalog_id"], ["coast"])
    return o.select("catalog_id", "year").join(first, "catalog_id", "left").select("catalog_id", "year", F.coalesce("coast", F.lit(-1)).alias("coast"))


def lat_lon_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strictly inside -28 to 24 north and 130 to 236 east."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 100 - 20).alias("lat"), (F.col("c_custkey") % 360).alias("lon"))
    return rounded(c.where("lat > -28 and lat < 24 and lon > 130 and lon < 236"), "lat")


def agreement_of_composites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Agreement of list prices with the sums paid, by brand."""
    li, p = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "part")
    j = li.join(p, F.col("l_partkey") == F.col("p_partkey")).select("p_brand", (F.col("l_extendedprice") / F.col("l_quantity")).alias("v"), F.col("p_retailprice").alias("t"))
    return rounded(j.groupBy("p_brand").agg(*agreement("v", "t")), "mae", "rmse", "sd", places=4).select("p_brand", "mae", "rmse", "sd", "n")


QUERIES = {f.__name__: f for f in (
    grid_best_zone, grid_ids, bbox_clip, cells_in_aoi, cells_outside, dissolve, overlapping_rasters, rasterized, task_list, task_list_unlogged, task_json, tiles_by_years, date_range,
    names_and_paths, local_hours, training_prep, cloud_codes, class_names, validation_tiles, total_bounds, nearest_cell, validation_roc, validation_summary, validation_rollup, validation_unbiased, images_by_coast, lat_lon_box, agreement_of_composites,
)}
_codes = ", ".join(str(c) for c in side.CODES)
ORACLE_SQL = {
    "grid_best_zone": f"""WITH {GRID}, b AS (SELECT * FROM met WHERE zone <> 25 QUALIFY row_number() OVER (PARTITION BY "column", "row" ORDER BY area DESC, zone) = 1)
        SELECT c."column", c."row", coalesce(CAST('326' || lpad(CAST(zone AS VARCHAR), 2, '0') AS INT), 0) AS epsg FROM cells c LEFT JOIN b ON b."column" = c."column" AND b."row" = c."row" """,
    "grid_ids": f"""WITH {GRID} SELECT "column", "row", lpad(CAST("column" AS VARCHAR), 3, '0') || lpad(CAST("row" AS VARCHAR), 3, '0') AS id, "column" || ',' || "row" AS tile_id FROM cells""",
    "bbox_clip": f"""WITH {GRID} SELECT "column", "row", zone, CAST(area AS DOUBLE) AS area FROM met""",
    "cells_in_aoi": _met_sql(-20, False),
    "cells_outside": _met_sql(10, True),
    "dissolve": f"""WITH {GRID} SELECT n_regionkey, CAST(min(minx) AS DOUBLE) AS minx, CAST(max(maxy) AS DOUBLE) AS maxy, arg_min(n_name, n_nationkey) AS name, count(*) AS n FROM zones JOIN nation ON zone = n_nationkey + 2 GROUP BY n_regionkey""",
    "overlapping_rasters": """WITH t AS (SELECT l_partkey % 50 AS x, l_suppkey % 20 AS y, l_returnflag AS tile, max(l_extendedprice) AS v FROM lineitem GROUP BY ALL)
        SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY x, y ORDER BY tile) = 1""",
    "rasterized": """WITH c AS (SELECT i + 0.5::DOUBLE AS x, j + 0.5::DOUBLE AS y FROM range(45) a(i), range(40) b(j)), n AS (SELECT n_nationkey % 5 * 9 + 4.2::DOUBLE AS cx, n_nationkey // 5 * 8 + 4.3::DOUBLE AS cy FROM nation)
        SELECT x, y, CAST(coalesce(max(CASE WHEN abs(x - cx) / 5 + abs(y - cy) / 4 < 1 THEN 1 ELSE 0 END), 0) AS INT) AS burned FROM c, n GROUP BY x, y""",
    "task_list": _tasks_sql("AND event_type NOT IN ('error', 'click')"),
    "task_list_unlogged": _tasks_sql(""),
    "task_json": f"""WITH {GRID} SELECT '[' || string_agg('{{"column":' || "column" || ',"row":' || "row" || ',"datetime":"1999/2024"}}', ',' ORDER BY "column", "row") || ']' AS json FROM cells""",
    "tiles_by_years": "SELECT n_name, CAST(y AS INT) AS year FROM (SELECT n_name FROM nation UNION ALL SELECT n_name FROM nation WHERE n_nationkey = 3), range(2017, 2025) t(y)",
    "date_range": "SELECT strftime(d, '%Y-%m-%d') AS day FROM range(TIMESTAMP '1984-01-01', TIMESTAMP '2025-01-02', INTERVAL 16 DAY) t(d)",
    "names_and_paths": """SELECT p_partkey, p_brand AS version, (p_size + 1989) || '_' || (p_size + 1991) AS path, '+proj=utm +zone=' || p_size || CASE WHEN p_size % 2 = 0 THEN ' +south' ELSE '' END AS proj,
        CAST('326' || lpad(CAST(p_size AS VARCHAR), 2, '0') AS INT) AS epsg FROM part""",
    "local_hours": """WITH o AS (SELECT o_orderkey, CASE WHEN o_custkey % 2 = 0 THEN 'Pacific/Honolulu' ELSE 'Pacific/Auckland' END AS zone, o_orderdate AS d FROM orders)
        SELECT o_orderkey, strftime(((d + INTERVAL 630 MINUTE) AT TIME ZONE zone) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS first, strftime(((d + INTERVAL 690 MINUTE) AT TIME ZONE zone) AT TIME ZONE 'UTC', '%Y-%m-%d %H:%M') AS last FROM o""",
    "training_prep": """WITH t AS (SELECT p_partkey, p_type AS code, trim(unnest(string_split(CASE p_size % 5 WHEN 0 THEN '2020/2022' WHEN 1 THEN '2020/2022, 2021' WHEN 2 THEN ' 2019 ,2020,2021' ELSE '2018' END, ','))) AS time FROM part WHERE p_type <> 'STANDARD'),
        c AS (SELECT p_type AS code, min(p_size) AS intcode FROM part WHERE p_type <> 'PROMO' GROUP BY 1) SELECT p_partkey, t.code, time, coalesce(intcode, -1) AS intcode FROM t LEFT JOIN c ON c.code = t.code""",
    "cloud_codes": f"""WITH c AS (SELECT * FROM (VALUES {_codes}) t(code, intcode, simplintcode, cloud, unified_water, color)),
        p AS (SELECT p_partkey, [{', '.join(f"'{c[0]}'" for c in side.CODES)}, 'shift', 'unknown'][p_partkey % 13 + 1] AS code FROM part)
        SELECT p_partkey, p.code, coalesce(cloud, -1) AS cloud, coalesce(color, '') AS color FROM p LEFT JOIN c ON c.code = p.code WHERE p.code <> 'shift'""",
    "class_names": f"SELECT unified_water, arg_min(code, intcode) AS code FROM (VALUES {_codes}) t(code, intcode, simplintcode, cloud, unified_water, color) GROUP BY 1",
    "validation_tiles": f"SELECT tile, CAST(y AS INT) AS year FROM (SELECT unnest([{', '.join(repr(t) for t in side.VALIDATION_TILES)}]) AS tile), range(2017, 2025) r(y)",
    "total_bounds": "SELECT min(c_acctbal) AS minx, min(c_custkey) AS miny, max(c_acctbal) AS maxx, max(c_custkey) AS maxy FROM customer",
    "nearest_cell": """WITH p AS (SELECT c_custkey, CAST(round((c_acctbal / 100 - 1.0) / 2.5) AS BIGINT) AS cx, CAST(round((c_custkey % 83 + 0.25 - 2.0) / 2.5) AS BIGINT) AS cy FROM customer),
        r AS (SELECT l_partkey % 40 AS cx, l_suppkey % 30 AS cy, max(l_extendedprice) AS value FROM lineitem GROUP BY ALL) SELECT c_custkey, p.cx, p.cy, coalesce(value, -1.0) AS value FROM p LEFT JOIN r ON r.cx = p.cx AND r.cy = p.cy""",
    "validation_roc": f"""WITH {ROC} SELECT o_custkey, round(coalesce(cl_rate, -1), 5) + 0.0 AS cl_rate, round(coalesce(val_rate, -1), 5) + 0.0 AS val_rate, round(coalesce(abs(cl_rate - val_rate), -1), 5) + 0.0 AS mae,
        round(coalesce(pow(cl_rate - val_rate, 2), -1), 5) + 0.0 AS mse FROM roc""",
    "validation_summary": f"WITH {ROC}, e AS (SELECT *, abs(cl_rate - val_rate) AS e FROM roc) {_summary_sql('all', 'true')} UNION ALL {_summary_sql('significant', 'cl_sig_time < 0.01')}",
    "validation_rollup": _rollup_sql("s"),
    "validation_unbiased": _rollup_sql("u"),
    "images_by_coast": """WITH o AS (SELECT o_orderkey AS catalog_id, CAST(year(o_orderdate) AS INT) AS year, o_totalprice / 1000 AS x, CAST(o_custkey % 100 AS DOUBLE) AS y FROM orders),
        s AS (SELECT s_suppkey % 2 + 1995 AS year, s_suppkey AS coast, s_acctbal / 20 AS x, CAST(s_suppkey * 7 % 100 AS DOUBLE) AS y FROM supplier)
        SELECT catalog_id, o.year, coalesce(min(coast), -1) AS coast FROM o LEFT JOIN s ON s.year = o.year AND o.x < s.x + 4 AND s.x < o.x + 3 AND o.y < s.y + 4 AND s.y < o.y + 3 GROUP BY catalog_id, o.year""",
    "lat_lon_box": "SELECT c_custkey, round(c_acctbal / 100 - 20, 6) + 0.0 AS lat, c_custkey % 360 AS lon FROM customer WHERE c_acctbal / 100 - 20 > -28 AND c_acctbal / 100 - 20 < 24 AND c_custkey % 360 > 130 AND c_custkey % 360 < 236",
    "agreement_of_composites": """SELECT p_brand, round(avg(e), 4) + 0.0 AS mae, round(sqrt(avg(e * e)), 4) + 0.0 AS rmse, round(stddev_samp(e), 4) + 0.0 AS sd, count(*) AS n
        FROM (SELECT p_brand, abs(l_extendedprice / l_quantity - p_retailprice) AS e FROM lineitem JOIN part ON l_partkey = p_partkey) GROUP BY p_brand""",
}
