"""Queries of the continental summary."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import geometry as g
from strandline.operators import continental
from strandline.plans.cube import cut, cut_sql, rounded
from strandline.plans.vectors import DISTANCES, REGR, distances
from strandline.sources import sinks
from strandline.sources.tables import table


def shorelines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(tile, year, key, vertices): a short line for each order of two statuses, as tiles would deliver them."""
    o = table(spark, sf_dir, "orders")
    x, y = F.col("o_totalprice") / 100, F.col("o_custkey") * 4000.0
    line = F.array(F.struct(x.alias("x"), y.alias("y")), F.struct((x + 30).alias("x"), (y + 40).alias("y")))
    return o.select(F.col("o_orderstatus").alias("tile"), F.year("o_orderdate").alias("year"), F.col("o_orderkey").alias("key"), line.alias("vertices"))


def continental_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Layers with unlike columns in one."""
    s = shorelines(spark, sf_dir).select("tile", "year", "key")
    tiles = [s.where("tile = 'F'"), s.where("tile = 'O'").withColumn("certainty", F.lit("good")), s.where("tile = 'P'").drop("year").withColumn("year", F.lit(None).cast("int"))]
    u = continental.merged(tiles)
    return u.select("tile", F.coalesce("year", F.lit(-1)).alias("year"), "key", F.coalesce("certainty", F.lit("")).alias("certainty"))


def shorelines_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    shorelines(spark, sf_dir).select("tile", "year", "key").createOrReplaceTempView("shorelines_annual")
    return continental.shorelines_by_year(spark)


def north_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return continental.lines_south_of(shorelines(spark, sf_dir)).select("tile", "year", "key")


def north_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = shorelines(spark, sf_dir).select(F.col("vertices")[0].y.alias("y"))
    return continental.removed_counts(points)


def _points(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    good = F.when(F.col("c_custkey") % 7 == 0, "extreme value (> 200 m)").otherwise("good")
    return c.select(F.col("c_custkey").alias("uid"), (F.col("c_acctbal") * 8).alias("x"), ((F.col("c_custkey") * 613) % 60000).cast("double").alias("y"), good.alias("certainty"))


def _centres(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_suppkey").alias("cid"), (F.col("s_acctbal") * 8).alias("x"), ((F.col("s_suppkey") * 613) % 60000).cast("double").alias("y"))


def _hotspots(radius: float):  # noqa: ANN202
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        stats, _ = continental.hotspots(_centres(spark, sf_dir), _points(spark, sf_dir), distances(spark, sf_dir), radius)
        return cut(stats.select("cid", "rate", "se", "n", "radius_m", "certainty"), "rate", "se", places=4)

    return query


POINTS = """pts AS (SELECT c_custkey AS uid, c_acctbal * 8 AS x, CAST((c_custkey * 613) % 60000 AS DOUBLE) AS y FROM customer WHERE c_custkey % 7 <> 0),
    ctr AS (SELECT s_suppkey AS cid, s_acctbal * 8 AS x, CAST((s_suppkey * 613) % 60000 AS DOUBLE) AS y FROM supplier)"""


def _hotspots_sql(radius: float) -> str:
    near = f"(c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y) < {radius * radius}"
    return f"""WITH {DISTANCES.replace('dist AS (', 'dist0 AS (', 1)}, {POINTS}, near AS (SELECT cid, uid FROM ctr c JOIN pts p ON {near}),
        dist AS (SELECT cid, year, CAST(round_even(median(dist), 2) AS DOUBLE) AS dist FROM near JOIN dist0 USING (uid) GROUP BY cid, year), r AS (SELECT cid, {REGR} FROM dist GROUP BY cid), n AS (SELECT cid, count(*) AS n FROM near GROUP BY cid)
        SELECT cid, {cut_sql('rate', 4)} AS rate, {cut_sql('se', 4)} AS se, coalesce(n, 0) AS n, {float(radius)}::DOUBLE AS radius_m, CASE WHEN coalesce(n, 0) < {radius} / 30 THEN 'insufficient points' ELSE 'good' END AS certainty
        FROM ctr LEFT JOIN r USING (cid) LEFT JOIN n USING (cid)"""


def window_medians(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The yearly medians in windows of 5,000 m, as stored."""
    _, medians = continental.hotspots(_centres(spark, sf_dir), _points(spark, sf_dir), distances(spark, sf_dir), 5000.0)
    return medians


def wms_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Service columns of trends, with missing values among them; significance stands in for by the discount."""
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.when(F.col("l_quantity") != 7, F.col("l_quantity") - 25).alias("rate"), F.col("l_tax").alias("se"), F.when(F.col("l_discount") != 0.05, F.col("l_discount")).alias("sig"), F.when(F.col("l_returnflag") != "N", "good").alias("certainty"))
    w = continental.wms_fields(li)
    return rounded(w.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.coalesce("wms_abs", F.lit(-1.0)).alias("wms_abs"), "wms_conf", "wms_grew", "wms_retr", "wms_sig", "wms_good"), "wms_abs", "wms_conf")


def tile_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Points of the merged layer in longitude (0 to 360) and latitude."""
    p = _points(spark, sf_dir)
    lon, lat = g.shifted_longitude(g.to_longitude(F.col("x") * 60)), g.to_latitude(F.col("y") * -60)
    return rounded(p.select("uid", lon.alias("lon"), lat.alias("lat")), "lon", "lat")


def mercator_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """There and back: what is lost on the way, in whole nanodegrees."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 130).alias("lat"), (F.col("c_custkey") * 7 % 360 - 180).cast("double").alias("lon"))
    x, y = g.to_mercator_x(F.col("lon")), g.to_mercator_y(F.col("lat"))
    off = lambda a, b: F.round(F.abs(a - b) * 1e8).cast("long")
    return c.select("c_custkey", off(g.to_latitude(y), F.col("lat")).alias("lat_off"), off(F.pmod(g.to_longitude(x) + 360, F.lit(360.0)), F.pmod(F.col("lon") + 360, F.lit(360.0))).alias("lon_off"))


def layer_schema(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rates cut and cast to the declared schema of their layer."""
    c = table(spark, sf_dir, "customer").select(F.col("c_name").alias("uid"), F.col("c_acctbal").alias("rate_time"), F.col("c_nationkey").cast("double").alias("valid_obs"), F.repeat("c_mktsegment", F.lit(20)).alias("outl_time"), F.col("c_mktsegment").alias("eez_territory"))
    return sinks.conforming(c, sinks.RATES).select("uid", "rate_time", "valid_obs", "outl_time", "eez_territory")


def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log entries of tasks, complete or failed, from the events."""
    e = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"), F.concat_ws(",", "user_id", "event_id").alias("index"), F.get_json_object("props", "$.k").alias("paths"), F.when(F.col("event_type") == "error", F.lit("failed")).alias("error"))
    entry = sinks.log_entry(e)
    return entry.select("time", "index", "status", F.coalesce("paths", F.lit("")).alias("paths"), F.coalesce("comment", F.lit("")).alias("comment"))


def url_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select(F.concat(F.col("p_type"), F.lit("/"), F.col("p_name"), F.when(F.col("p_size") % 2 == 0, "_non_extrapolated").otherwise("")).alias("key"))
    return sinks.url_list(p, "https://example.org/")


QUERIES = {
    "hotspots": _hotspots(15000.0), "hotspots_5000": _hotspots(5000.0), "hotspots_1000": _hotspots(1000.0),
    **{f.__name__: f for f in (continental_union, shorelines_sorted, north_limit, north_counts, window_medians, wms_flags, tile_features, mercator_roundtrip, layer_schema, log_lines, url_list)},
}
_e = g.ECCENTRICITY


def _phi_steps(y: str, steps: int = 5) -> str:
    """CTEs p0, p1, ... of the latitude's fixed-point steps from exp(-y / radius) as t."""
    out = f"p0 AS (SELECT *, pi() / 2 - 2 * atan(t) AS phi FROM (SELECT *, exp(-({y}) / {g.RADIUS}) AS t FROM src))"
    for k in range(steps):
        out += f", p{k + 1} AS (SELECT * EXCLUDE (phi), pi() / 2 - 2 * atan(t * pow((1 - {_e} * sin(phi)) / (1 + {_e} * sin(phi)), {_e / 2})) AS phi FROM p{k})"
    return out


ORACLE_SQL = {
    "continental_union": "SELECT o_orderstatus AS tile, CASE WHEN o_orderstatus = 'P' THEN -1 ELSE CAST(year(o_orderdate) AS INT) END AS year, o_orderkey AS key, CASE WHEN o_orderstatus = 'O' THEN 'good' ELSE '' END AS certainty FROM orders",
    "shorelines_sorted": "SELECT o_orderstatus AS tile, CAST(year(o_orderdate) AS INT) AS year, o_orderkey AS key FROM orders ORDER BY year",
    "north_limit": "SELECT o_orderstatus AS tile, CAST(year(o_orderdate) AS INT) AS year, o_orderkey AS key FROM orders WHERE o_custkey * 4000.0 + 40 <= 2125000",
    "north_counts": "SELECT count(*) FILTER (WHERE o_custkey * 4000.0 <= 2125000) AS kept, count(*) FILTER (WHERE NOT o_custkey * 4000.0 <= 2125000) AS removed FROM orders",
    "hotspots": _hotspots_sql(15000), "hotspots_5000": _hotspots_sql(5000), "hotspots_1000": _hotspots_sql(1000),
    "window_medians": f"""WITH {DISTANCES}, {POINTS}, near AS (SELECT cid, uid FROM ctr c JOIN pts p ON (c.x - p.x) * (c.x - p.x) + (c.y - p.y) * (c.y - p.y) < 25000000)
        SELECT cid, year, CAST(round_even(median(dist), 2) AS DOUBLE) AS dist FROM near JOIN dist USING (uid) GROUP BY cid, year""",
    "wms_flags": """WITH s AS (SELECT *, CASE WHEN l_quantity <> 7 THEN l_quantity - 25 END AS rate, CASE WHEN l_discount <> 0.05 THEN l_discount END AS sig FROM lineitem)
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(coalesce(abs(rate), -1.0), 6) + 0.0 AS wms_abs, round(l_tax * 1.96, 6) + 0.0 AS wms_conf,
               coalesce(rate < 0, false) AS wms_grew, coalesce(rate > 0, false) AS wms_retr, coalesce(sig <= 0.01, false) AS wms_sig, l_returnflag <> 'N' AS wms_good FROM s""",
    "tile_features": f"""WITH src AS (SELECT c_custkey AS uid, c_acctbal * 8 * 60 AS mx, CAST((c_custkey * 613) % 60000 AS DOUBLE) * -60 AS my FROM customer), {_phi_steps('my')},
        l AS (SELECT uid, degrees(mx / {g.RADIUS}) + 150 + 180 AS a, degrees(phi) AS lat FROM p5), m AS (SELECT uid, a - 360 * floor(a / 360) - 180 AS lon, lat FROM l)
        SELECT uid, round(CASE WHEN lon < 0 THEN lon + 360 ELSE lon END, 6) + 0.0 AS lon, round(lat, 6) + 0.0 AS lat FROM m""",
    "mercator_roundtrip": "SELECT c_custkey, CAST(0 AS BIGINT) AS lat_off, CAST(0 AS BIGINT) AS lon_off FROM customer",
    "layer_schema": "SELECT c_name AS uid, c_acctbal AS rate_time, c_nationkey AS valid_obs, left(repeat(c_mktsegment, 20), 130) AS outl_time, left(c_mktsegment, 3) AS eez_territory FROM customer",
    "log_lines": """SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, user_id || ',' || event_id AS index, CASE WHEN event_type = 'error' THEN 'error' ELSE 'complete' END AS status,
        CASE WHEN event_type = 'error' THEN '' ELSE coalesce(json_extract_string(props, '$.k'), '') END AS paths, CASE WHEN event_type = 'error' THEN 'failed' ELSE '' END AS comment FROM events""",
    "url_list": "SELECT 'https://example.org/' || p_type || '/' || p_name AS value FROM part WHERE p_size % 2 <> 0",
}
