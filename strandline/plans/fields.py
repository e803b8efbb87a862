"""Queries of selections, masks and lookups that the stages use beside their main path, and of sinks read back."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import geometry as g
from strandline.functions.text import columns_matching
from strandline.operators import morphology, mosaic, movement, side, spatial, tides
from strandline.plans.continent import shorelines
from strandline.plans.cube import ANNUAL, INDEX, OBS, annual, cut, cut_sql, obs, rounded, yearly_index
from strandline.plans.stacks import CUTS, grid, heights
from strandline.sources import sinks, tables
from strandline.sources.tables import table


def mean_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tide limits of suppliers' images, each over the cells it overlaps."""
    limits = tides.cutoffs(heights(spark, sf_dir), ["cx", "cy"])
    s = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("image"), (F.col("s_suppkey") % 4).cast("int").alias("cx"), F.explode(F.sequence(F.lit(0), (F.col("s_nationkey") % 4).cast("int"))).alias("cy"))
    return cut(tides.mean_cutoffs(limits, s, ["cx", "cy"], ["image"]), "lo", "hi")


def latest_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the last year that has any."""
    return movement.latest(shorelines(spark, sf_dir)).select("tile", "year", "key")


def years_since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return side.since(shorelines(spark, sf_dir), 1999).select("tile", "year", "key")


def non_empty_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of which some have lost all their vertices."""
    s = shorelines(spark, sf_dir).withColumn("vertices", F.when(F.col("key") % 5 == 0, F.slice("vertices", 1, 0)).when(F.col("key") % 7 != 0, F.col("vertices")))
    return spatial.non_empty(s).select("tile", "year", "key")


def undigitised(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 == 0, F.col("p_brand")).alias("digitiser_name"))
    return side.undigitised(p).select("p_partkey")


def both_significant(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 3 != 0, F.col("p_retailprice")).alias("cl_sig_time"), F.when(F.col("p_size") % 2 != 0, F.col("p_retailprice")).alias("val_sig_time"))
    return side.both_significant(p).select("p_partkey")


def clear_reflectance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reflectances by two cloud masks and the fill value."""
    o = obs(spark, sf_dir)
    v = mosaic.clear_reflectance(F.col("qty") % 10, (F.col("lnum") % 3).cast("int"), (F.col("pkey") % 12).cast("int"))
    return rounded(o.select("okey", "lnum", "pkey", "skey", v.alias("value")), "value")


def states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tiles without those of one nation."""
    s = table(spark, sf_dir, "supplier").join(table(spark, sf_dir, "nation").select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
    return s.where("n_name = 'NATION_3'").select("s_suppkey", "n_name")


def tiles_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    tiles = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 30).cast("int").alias("column"), F.col("c_nationkey").alias("row"))
    wanted = table(spark, sf_dir, "nation").select((F.col("n_nationkey") + 2).cast("int").alias("column"), F.col("n_nationkey").alias("row"))
    return side.tiles_by_key(tiles, wanted).select("c_custkey")


def raster_polygons(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land as polygons: cells, area by the rings (a hole's is taken off) and the length of all borders."""
    v = morphology.vectorized(grid(spark, sf_dir).where("twndwi < 0"), ["year"])
    signed = lambda ring: F.aggregate(g.segments(ring), F.lit(0.0), lambda s, e: s + e.a.x * e.b.y - e.b.x * e.a.y) / 2
    m = v.select("year", "n", F.aggregate("rings", F.lit(0.0), lambda s, r: s + signed(r)).alias("area"), F.aggregate("rings", F.lit(0.0), lambda s, r: s + g.length(r)).alias("border"))
    return m.groupBy("year").agg(F.count("*").alias("polygons"), F.sum("n").alias("cells"), F.sum("area").alias("area"), F.sum("border").alias("border"))


_land = "land AS (SELECT year, x, y FROM idx WHERE twndwi < 0)"
POLYGONS = f"""WITH RECURSIVE {INDEX}, {_land}, walk AS (SELECT year, x, y, x * 1000 + y AS root FROM land UNION SELECT l.year, l.x, l.y, w.root FROM walk w JOIN land l ON l.year = w.year AND abs(l.x - w.x) + abs(l.y - w.y) = 1),
    part AS (SELECT year, x, y, min(root) AS root FROM walk GROUP BY ALL),
    sides AS (SELECT a.year, count(*) AS n FROM land a, (VALUES (0, 1), (0, -1), (1, 0), (-1, 0)) o(dx, dy) WHERE NOT EXISTS (SELECT 1 FROM land b WHERE b.year = a.year AND b.x = a.x + dx AND b.y = a.y + dy) GROUP BY a.year)
    SELECT p.year, count(DISTINCT root) AS polygons, count(*) AS cells, CAST(count(*) AS DOUBLE) AS area, CAST(max(s.n) AS DOUBLE) AS border FROM part p JOIN sides s ON s.year = p.year GROUP BY p.year"""


def zone_at_point(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time zones of customers' places, on land by boxes, at sea by longitude."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") * 7 % 360 - 180).cast("double").alias("x"), (F.col("c_acctbal") / 120).alias("y"))
    n = table(spark, sf_dir, "nation")
    x, y = (F.col("n_nationkey") % 5 * 60 - 150).cast("double"), (F.expr("n_nationkey div 5") * 20 - 20).cast("double")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    zones = n.select(F.col("n_name").alias("zone"), F.array(at(-9.5, -7.5), at(9.5, -7.5), at(9.5, 7.5), at(-9.5, 7.5), at(-9.5, -7.5)).alias("ring"))
    return spatial.zone_at(c, zones, 20.0).select("c_custkey", "zone")


def length_per_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(movement.length_by_year(shorelines(spark, sf_dir), 8), "km", "km_a_year")


def filled_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index with 1, that is water, where it is null."""
    g_ = grid(spark, sf_dir).withColumn("twndwi", F.when(F.expr("(x + 2 * y + year) % 6 <> 0"), F.col("twndwi")))
    return rounded(g_.fillna(1.0, ["twndwi"]), "twndwi")


def land_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mapped land from a raster of another size, and diamonds of added land."""
    cells = yearly_index(spark, sf_dir).select(F.lit("a").alias("tile_id"), "x", "y").distinct()
    li = table(spark, sf_dir, "lineitem")
    land = li.groupBy((F.col("l_partkey") % 8).alias("cx"), (F.col("l_suppkey") % 8).alias("cy")).agg((F.max("l_orderkey") % 2 == 0).alias("land"))
    n = table(spark, sf_dir, "nation")
    cx, cy = F.col("n_nationkey") % 5 * 5 + 0.3, F.expr("n_nationkey div 5") * 5 + 0.2
    at = lambda dx, dy: F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))
    rings = n.select(F.array(at(-1.25, 0), at(0, -1.25), at(1.25, 0), at(0, 1.25), at(-1.25, 0)).alias("ring"))
    m = morphology.land_masks(cells.withColumns({"x": F.col("x"), "y": F.col("y")}), land, None, 0.4, 0.1, 0.1)
    return m.drop("added").join(morphology.land_masks(cells, None, rings).drop("mapped"), ["tile_id", "x", "y"]).select("x", "y", "mapped", "added")


def yearly_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The distance columns of a wide table, by the pattern of their names."""
    o = table(spark, sf_dir, "orders").where("o_orderdate is not null")
    wide = o.groupBy("o_custkey").agg(*[F.max(F.when(F.year("o_orderdate") == y, F.col("o_totalprice"))).alias(f"dist_{y}") for y in (1995, 1996, 1997)], F.count("*").alias("valid_obs"), F.max("o_orderkey").alias("distant"))
    names = columns_matching(wide.columns, r"^dist_\d{4}$")
    return wide.select("o_custkey", F.array_max(F.array(*names)).alias("furthest"), F.lit(len(names)).alias("n"))


def sampled_along(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raster's values at five places along suppliers' lines."""
    lines = table(spark, sf_dir, "supplier").select("s_suppkey", (F.col("s_suppkey") % 17 + 0.2).alias("ax"), (F.col("s_suppkey") % 13 + 0.3).alias("ay"), (F.col("s_nationkey") % 19 + 0.1).alias("bx"), (F.col("s_suppkey") % 7 + 0.4).alias("by"))
    cells = grid(spark, sf_dir).where("year = 1998").select(F.col("x").cast("long").alias("cx"), F.col("y").cast("long").alias("cy"), "twndwi")
    return rounded(movement.sampled_along(lines, ["s_suppkey"], cells, "twndwi", 4), "twndwi", "diff")


SAMPLED = f"""WITH {INDEX}, l AS (SELECT s_suppkey, s_suppkey % 17 + 0.2::DOUBLE AS ax, s_suppkey % 13 + 0.3::DOUBLE AS ay, s_nationkey % 19 + 0.1::DOUBLE AS bx, s_suppkey % 7 + 0.4::DOUBLE AS by_, CAST(unnest(range(5)) AS INT) AS k FROM supplier),
    p AS (SELECT s_suppkey, k, CAST(round(ax + (bx - ax) * k / 4) AS BIGINT) AS cx, CAST(round(ay + (by_ - ay) * k / 4) AS BIGINT) AS cy FROM l),
    v AS (SELECT s_suppkey, k, twndwi FROM p LEFT JOIN idx ON year = 1998 AND x = cx AND y = cy)
    SELECT s_suppkey, k, round(twndwi, 6) + 0.0 AS twndwi, round(twndwi - lag(twndwi) OVER (PARTITION BY s_suppkey ORDER BY k), 6) + 0.0 AS diff FROM v"""


def dissolved_rings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations' boxes as one geometry a region, with the first nation's name."""
    n = table(spark, sf_dir, "nation")
    x = (F.col("n_nationkey") * 2).cast("double")
    at = lambda dx, dy: F.struct((x + dx).alias("x"), F.lit(dy).alias("y"))
    parts = n.select("n_regionkey", "n_nationkey", "n_name", F.array(F.array(at(0.0, 0.0), at(1.0, 0.0), at(1.0, 3.0), at(0.0, 3.0), at(0.0, 0.0))).alias("rings"))
    d = spatial.dissolved(parts, ["n_regionkey"], ["n_nationkey"])
    area = F.aggregate("rings", F.lit(0.0), lambda s, r: s + g.area(r))
    return d.select("n_regionkey", "n_name", F.size("rings").alias("n"), area.alias("area"), g.bounds(F.flatten("rings")).maxx.alias("maxx"))


def shoreline_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index where a shoreline can be, with the first island as mapped land; the stage's masks one after another."""
    from strandline.functions.indices import with_indices
    from strandline.stages import shoreline_index as stage

    stack = with_indices(annual(spark, sf_dir)).select(F.lit("a").alias("tile_id"), "x", "y", "year", *[F.round(c, 6).alias(c) for c in ("twndwi", "mndwi", "ndwi", "nirwi")])
    island = F.expr("(x-7)*(x-7)+(y-8)*(y-8) <= 14")
    land = stack.select("tile_id", "x", "y").distinct().select("*", island.alias("mapped"), F.lit(False).alias("added"))
    return rounded(stage(stack, land=land, radius=1, expansions=3).select("x", "y", "year", "twndwi"), "twndwi")


def _folder(spark: SparkSession, name: str) -> str:
    """A new folder of the shared store; a temporary one only in a local session without one."""
    base = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        base = f"file://{tempfile.mkdtemp(prefix='strandline-')}"
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored_mosaic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Composites written by length, year and tile, written again (what is there stays), and read back pruned."""
    a = annual(spark, sf_dir).select(F.col("tile").cast("string").alias("tile_id"), "x", "y", F.round("twndwi", 6).alias("twndwi"), "year").withColumn("period_len", F.lit(1))
    path = _folder(spark, "mosaic")
    sinks.write_mosaic(a.where("year < 1999"), path)
    sinks.write_mosaic(a.withColumn("twndwi", F.when(F.col("year") < 1999, 9.0).otherwise(F.col("twndwi"))), path)
    return rounded(tables.mosaics(spark, path, 1, (1997, 2000)).select(F.col("tile_id").cast("int").alias("tile_id"), "x", "y", "year", "twndwi"), "twndwi")


def stored_layers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A tile's lines and points in their declared schemas, written and read back."""
    s = shorelines(spark, sf_dir).select("year", F.lit("good").alias("certainty"), "vertices")
    p = table(spark, sf_dir, "customer").select(F.col("c_name").alias("uid"), F.col("c_acctbal").alias("rate_time"), F.col("c_nationkey").alias("valid_obs"), F.lit(1.0).alias("x"), F.lit(2.0).alias("y"))
    path = _folder(spark, "shore")
    sinks.write_shore(path, None, s, p)
    lines, points = spark.read.parquet(f"{path}/shorelines_annual"), spark.read.parquet(f"{path}/rates_of_change")
    return lines.groupBy("year").agg(F.count("*").alias("n"), F.sum(F.size("vertices")).alias("vertices")).withColumn("layer", F.lit("lines")).unionByName(points.groupBy(F.col("valid_obs").alias("year")).agg(F.count("*").alias("n"), F.lit(0).cast("long").alias("vertices")).withColumn("layer", F.lit("points")))


def stored_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A task log, appended to twice and read back."""
    e = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("time"), F.concat_ws(",", "user_id", "event_id").alias("index"), F.lit("a/b").alias("paths"), F.when(F.col("event_type") == "error", F.lit("failed")).alias("error"))
    path = _folder(spark, "log")
    for part in ("event_id % 2 = 0", "event_id % 2 = 1"):
        ids = table(spark, sf_dir, "events").where(part).select(F.concat_ws(",", "user_id", "event_id").alias("index"))
        sinks.append_log(sinks.log_entry(e.join(ids, "index", "left_semi")), path)
    return tables.log(spark, path).select("time", "index", "status", F.coalesce("comment", F.lit("")).alias("comment"))


def stored_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines exported as well-known text and read back."""
    path = _folder(spark, "csv")
    sinks.export_csv(shorelines(spark, sf_dir).select("year", "key", F.transform("vertices", lambda p: F.struct(F.round(p.x).cast("long").alias("x"), F.round(p.y).cast("long").alias("y"))).alias("vertices")), path)
    back = tables.csv(spark, path, "year int, key long, vertices string")
    return back.select("year", "key", "vertices")


QUERIES = {f.__name__: f for f in (
    mean_cutoffs, latest_year, years_since, non_empty_lines, undigitised, both_significant, clear_reflectance, states, tiles_by_key, raster_polygons, zone_at_point, length_per_year,
    filled_water, land_masks, yearly_columns, sampled_along, dissolved_rings, shoreline_index, stored_mosaic, stored_layers, stored_log, stored_csv,
)}
_line = "o_orderstatus AS tile, CAST(year(o_orderdate) AS INT) AS year, o_orderkey AS key"
_xy = "o_totalprice / 100 AS x, o_custkey * 4000.0 AS y"
ORACLE_SQL = {
    "mean_cutoffs": f"""WITH {CUTS}, i AS (SELECT s_suppkey AS image, s_suppkey % 4 AS cx, unnest(range(s_nationkey % 4 + 1)) AS cy FROM supplier)
        SELECT image, {cut_sql('avg(lo)')} AS lo, {cut_sql('avg(hi)')} AS hi FROM i JOIN cuts ON cuts.cx = i.cx AND cuts.cy = i.cy GROUP BY image""",
    "latest_year": f"SELECT {_line} FROM orders WHERE year(o_orderdate) = (SELECT max(year(o_orderdate)) FROM orders)",
    "years_since": f"SELECT {_line} FROM orders WHERE year(o_orderdate) >= 1999",
    "non_empty_lines": f"SELECT {_line} FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0",
    "undigitised": "SELECT p_partkey FROM part WHERE p_size % 3 <> 0",
    "both_significant": "SELECT p_partkey FROM part WHERE p_size % 3 <> 0 AND p_size % 2 <> 0",
    "clear_reflectance": f"""WITH {OBS} SELECT okey, lnum, pkey, skey, CASE WHEN lnum % 3 = 0 AND qty % 10 <> 0 AND pkey % 12 NOT IN (3, 8, 9, 10) THEN round(qty % 10, 6) + 0.0 END AS value FROM obs""",
    "states": "SELECT s_suppkey, n_name FROM supplier JOIN nation ON n_nationkey = s_nationkey WHERE n_name = 'NATION_3'",
    "tiles_by_key": "SELECT c_custkey FROM customer WHERE c_custkey % 30 = c_nationkey + 2 AND c_nationkey IN (SELECT n_nationkey FROM nation)",
    "raster_polygons": POLYGONS,
    "zone_at_point": """WITH c AS (SELECT c_custkey, CAST(c_custkey * 7 % 360 - 180 AS DOUBLE) AS x, c_acctbal / 120 AS y FROM customer), n AS (SELECT n_name, n_nationkey % 5 * 60 - 150 AS zx, n_nationkey // 5 * 20 - 20 AS zy FROM nation),
        z AS (SELECT c_custkey, x, min(n_name) AS zone FROM c LEFT JOIN n ON abs(x - zx) < 9.5 AND abs(y - zy) < 7.5 GROUP BY ALL), h AS (SELECT *, CAST(round(x / 15) AS INT) AS h FROM z)
        SELECT c_custkey, coalesce(zone, 'Etc/GMT' || CASE WHEN h > 0 THEN '-' || h WHEN h < 0 THEN '+' || -h ELSE '' END) AS zone FROM h""",
    "length_per_year": "SELECT CAST(year(o_orderdate) AS INT) AS year, round(count(*) * 50 / 1000.0, 6) + 0.0 AS km, round(count(*) * 50 / 8000.0, 6) + 0.0 AS km_a_year FROM orders GROUP BY 1",
    "filled_water": f"WITH {INDEX} SELECT year, x, y, round(CASE WHEN (x + 2 * y + year) % 6 <> 0 THEN coalesce(twndwi, 1.0) ELSE 1.0 END, 6) + 0.0 AS twndwi FROM idx",
    "land_masks": f"""WITH {INDEX}, c AS (SELECT DISTINCT x, y FROM idx), r AS (SELECT l_partkey % 8 AS cx, l_suppkey % 8 AS cy, max(l_orderkey) % 2 = 0 AS land FROM lineitem GROUP BY ALL),
        n AS (SELECT n_nationkey % 5 * 5 + 0.3::DOUBLE AS nx, n_nationkey // 5 * 5 + 0.2::DOUBLE AS ny FROM nation)
        SELECT c.x, c.y, coalesce(bool_or(r.land), false) AS mapped, bool_or(abs(c.x - nx) + abs(c.y - ny) < 1.25) AS added FROM c LEFT JOIN r ON r.cx = CAST(round(c.x * 0.4::DOUBLE + 0.1::DOUBLE) AS BIGINT) AND r.cy = CAST(round(c.y * 0.4::DOUBLE + 0.1::DOUBLE) AS BIGINT), n GROUP BY c.x, c.y""",
    "yearly_columns": "SELECT o_custkey, max(o_totalprice) FILTER (WHERE year(o_orderdate) BETWEEN 1995 AND 1997) AS furthest, 3 AS n FROM orders GROUP BY o_custkey",
    "sampled_along": SAMPLED,
    "dissolved_rings": "SELECT n_regionkey, arg_min(n_name, n_nationkey) AS n_name, CAST(count(*) AS INT) AS n, count(*) * 3.0::DOUBLE AS area, max(n_nationkey) * 2 + 1.0::DOUBLE AS maxx FROM nation GROUP BY n_regionkey",
    "stored_mosaic": f"WITH {ANNUAL} SELECT tile AS tile_id, x, y, year, round(twndwi, 6) + 0.0 AS twndwi FROM annual WHERE year BETWEEN 1997 AND 2000",
    "stored_layers": """SELECT CAST(year(o_orderdate) AS INT) AS year, count(*) AS n, 2 * count(*) AS vertices, 'lines' AS layer FROM orders GROUP BY 1 UNION ALL
        SELECT c_nationkey, count(*), 0, 'points' FROM customer GROUP BY 1""",
    "stored_log": "SELECT strftime(ts, '%Y-%m-%d %H:%M:%S') AS time, user_id || ',' || event_id AS index, CASE WHEN event_type = 'error' THEN 'error' ELSE 'complete' END AS status, CASE WHEN event_type = 'error' THEN 'failed' ELSE '' END AS comment FROM events",
    "stored_csv": f"""WITH s AS (SELECT {_line}, {_xy} FROM orders) SELECT year, key, 'LINESTRING (' || CAST(round(x) AS BIGINT) || ' ' || CAST(round(y) AS BIGINT) || ', ' || CAST(round(x + 30) AS BIGINT) || ' ' || CAST(round(y + 40) AS BIGINT) || ')' AS vertices FROM s""",
}
