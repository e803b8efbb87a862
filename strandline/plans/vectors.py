"""Queries of contours, movements and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import geometry as g
from strandline.functions.stats import significance
from strandline.operators import contours, movement, spatial
from strandline.plans.cube import ANNUAL, INDEX, annual, cut, cut_sql, rounded
from strandline.plans.stacks import grid
from strandline.sources.tables import table

RIGHT_UP = f"""{INDEX}, r AS (SELECT year, x, y, twndwi AS v, CASE WHEN lead(x) OVER w = x + 1 THEN lead(twndwi) OVER w END AS rgt FROM idx WINDOW w AS (PARTITION BY year, y ORDER BY x)),
    n AS (SELECT *, CASE WHEN lead(y) OVER w = y + 1 THEN lead(v) OVER w END AS up, CASE WHEN lead(y) OVER w = y + 1 THEN lead(rgt) OVER w END AS dia FROM r WINDOW w AS (PARTITION BY year, x ORDER BY y))"""


def zero_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(contours.zero_crossings(grid(spark, sf_dir), ["year"], "twndwi"), "cx", "cy")


def contour_length(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and total length of the contour's segments by year."""
    s = contours.contour_segments(grid(spark, sf_dir), ["year"], "twndwi")
    d = g.distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    return rounded(s.groupBy("year").agg(F.count("*").alias("segments"), F.sum(d).alias("length")), "length")


CONTOUR_LENGTH = f"""WITH {RIGHT_UP}, q AS (SELECT * FROM n WHERE v IS NOT NULL AND rgt IS NOT NULL AND up IS NOT NULL AND dia IS NOT NULL),
    p AS (SELECT *, CASE WHEN (v < 0) <> (rgt < 0) THEN {{'x': x + v / (v - rgt), 'y': CAST(y AS DOUBLE)}} END AS b,
        CASE WHEN (rgt < 0) <> (dia < 0) THEN {{'x': CAST(x + 1 AS DOUBLE), 'y': y + rgt / (rgt - dia)}} END AS r,
        CASE WHEN (up < 0) <> (dia < 0) THEN {{'x': x + up / (up - dia), 'y': CAST(y + 1 AS DOUBLE)}} END AS t,
        CASE WHEN (v < 0) <> (up < 0) THEN {{'x': CAST(x AS DOUBLE), 'y': y + v / (v - up)}} END AS l FROM q),
    e AS (SELECT year, list_filter([b, r, t, l], lambda z: z IS NOT NULL) AS e, ((v + rgt + up + dia) / 4 < 0) = (v < 0) AS low FROM p),
    s AS (SELECT year, unnest(CASE WHEN len(e) = 2 THEN [[e[1], e[2]]] WHEN len(e) = 4 AND low THEN [[e[1], e[2]], [e[3], e[4]]] WHEN len(e) = 4 THEN [[e[4], e[1]], [e[2], e[3]]] ELSE [] END) AS s FROM e)
    SELECT year, count(*) AS segments, round(sum(sqrt((s[1].x - s[2].x) * (s[1].x - s[2].x) + (s[1].y - s[2].y) * (s[1].y - s[2].y))), 6) + 0.0 AS length FROM s GROUP BY year"""


def contour_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = contours.contour_lines(grid(spark, sf_dir), ["year"], "twndwi", min_vertices=5)
    return rounded(lines.select("year", "part", F.size("vertices").alias("n"), g.length(F.col("vertices")).alias("length")), "length")


def contour_certainty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly lines with the certainty that most of the cells under them have."""
    lines = contours.contour_lines(grid(spark, sf_dir), ["year"], "twndwi")
    pixels = contours.pixel_certainty(annual(spark, sf_dir))
    return contours.line_certainty(lines, pixels, ["year"]).select("year", "part", "certainty")


def pixel_certainty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contours.pixel_certainty(annual(spark, sf_dir), threshold=0.25, low=10).select("x", "y", "year", "certainty")


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line for each nation, through its suppliers in their order."""
    s = table(spark, sf_dir, "supplier")
    return s.select(F.col("s_nationkey").alias("line"), F.col("s_suppkey").alias("seq"), (F.col("s_acctbal") / 10).alias("x"), ((F.col("s_suppkey") * 37) % 500).cast("double").alias("y"))


VERTICES = "vertices AS (SELECT s_nationkey AS line, s_suppkey AS seq, s_acctbal / 10 AS x, CAST((s_suppkey * 37) % 500 AS DOUBLE) AS y FROM supplier)"
SEGMENTS = f"""{VERTICES}, s0 AS (SELECT line, seq, x AS ax, y AS ay, lead(x) OVER w AS bx, lead(y) OVER w AS by_ FROM vertices WINDOW w AS (PARTITION BY line ORDER BY seq)),
    s1 AS (SELECT *, sqrt((bx - ax) * (bx - ax) + (by_ - ay) * (by_ - ay)) AS len FROM s0 WHERE bx IS NOT NULL),
    seg AS (SELECT *, coalesce(sum(len) OVER (PARTITION BY line ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS at_ FROM s1),
    pts AS (SELECT *, unnest(range(CAST(ceil(at_ / 30) AS BIGINT), CAST(ceil((at_ + len) / 30) AS BIGINT))) AS k FROM seg WHERE len > 0)"""


def points_every_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(movement.points_along(vertices(spark, sf_dir), ["line"], 30.0), "x", "y", places=4)


def transects_every_30(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(movement.transects(vertices(spark, sf_dir), ["line"], 30.0, 50.0), "ax", "ay", "bx", "by", places=4)


def line_measures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Length, bounds and centre of whole lines."""
    v = vertices(spark, sf_dir).groupBy("line").agg(F.transform(F.array_sort(F.collect_list(F.struct("seq", "x", "y"))), lambda p: F.struct(p.x.alias("x"), p.y.alias("y"))).alias("v"))
    b, c = g.bounds(F.col("v")), g.line_centroid(F.col("v"))
    m = v.select("line", F.size("v").alias("n"), g.length(F.col("v")).alias("length"), b.minx.alias("minx"), b.maxy.alias("maxy"), c.x.alias("cx"), c.y.alias("cy"))
    return rounded(m, "length", "minx", "maxy", "cx", "cy", places=4)


MEASURES = f"""WITH {SEGMENTS}, m AS (SELECT line, sum(len) AS length, sum((ax + bx) / 2 * len) / nullif(sum(len), 0) AS cx, sum((ay + by_) / 2 * len) / nullif(sum(len), 0) AS cy FROM seg GROUP BY line)
    SELECT v.line, CAST(count(*) AS INT) AS n, round(coalesce(max(length), 0.0), 4) + 0.0 AS length, round(min(x), 4) + 0.0 AS minx, round(max(y), 4) + 0.0 AS maxy, round(max(cx), 4) + 0.0 AS cx, round(max(cy), 4) + 0.0 AS cy
    FROM vertices v LEFT JOIN m ON m.line = v.line GROUP BY v.line"""


def annual_movement(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signed distances from points to the nearest place on a yearly contour within a cap."""
    s = table(spark, sf_dir, "supplier")
    points = s.select(F.col("s_suppkey").alias("uid"), (F.col("s_acctbal") / 10).alias("x"), ((F.col("s_suppkey") * 37) % 500).cast("double").alias("y"))
    x, y = F.col("o_totalprice") / 500, (F.col("o_custkey") % 500).cast("double")
    o = table(spark, sf_dir, "orders").select(F.year("o_orderdate").alias("year"), x.alias("ax"), y.alias("ay"), (x + 12).alias("bx"), (y - 5).alias("by"))
    years = o.select("year").distinct()
    sign = points.select("uid").crossJoin(years).withColumn("wet", (F.col("uid") + F.col("year")) % 3 != 0)
    return rounded(movement.annual_movements(points, o, most=40.0, sign=sign).select("uid", "year", "dist"), "dist")


MOVEMENT = """WITH p AS (SELECT s_suppkey AS uid, s_acctbal / 10 AS x, CAST((s_suppkey * 37) % 500 AS DOUBLE) AS y FROM supplier),
    c AS (SELECT CAST(year(o_orderdate) AS INT) AS year, o_totalprice / 500 AS x, CAST(o_custkey % 500 AS DOUBLE) AS y FROM orders),
    t AS (SELECT uid, year, p.x AS px, p.y AS py, c.x AS ax, c.y AS ay, greatest(0.0, least(1.0, ((p.x - c.x) * 12 + (p.y - c.y) * -5) / 169.0)) AS t FROM p, c),
    d AS (SELECT uid, year, min(sqrt(pow(ax + t * 12 - px, 2) + pow(ay - t * 5 - py, 2))) AS d FROM t GROUP BY uid, year)
    SELECT uid, year, round(CASE WHEN (uid + year) % 3 <> 0 THEN d ELSE -d END, 6) + 0.0 AS dist FROM d WHERE d <= 40"""


def distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(uid, year, dist): a yearly distance for each customer, missing in some years."""
    o = table(spark, sf_dir, "orders")
    return o.groupBy(F.col("o_custkey").alias("uid"), F.year("o_orderdate").alias("year")).agg(F.round(F.avg("o_totalprice") / 1003.7, 6).alias("dist"))


DISTANCES = "dist AS (SELECT o_custkey AS uid, CAST(year(o_orderdate) AS INT) AS year, round(avg(o_totalprice) / 1003.7, 6) AS dist FROM orders GROUP BY ALL)"


def baseline_distances(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(movement.relative_to(distances(spark, sf_dir), 2000), "dist")


def roc_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    r = movement.regressions(distances(spark, sf_dir), with_p=False)
    return cut(cut(r, "rate", "se", places=4), "incpt", places=2)


REGR = "regr_slope(dist, year) AS rate, regr_intercept(dist, year) AS incpt, sqrt(greatest(regr_syy(dist, year) - regr_slope(dist, year) * regr_sxy(dist, year), 0) / nullif(greatest(CAST(regr_count(dist, year) AS BIGINT) - 2, 0), 0) / nullif(regr_sxx(dist, year), 0)) AS se, CAST(regr_count(dist, year) AS BIGINT) AS n_reg"


def robust_regression(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trends without outlying years, and which years these are."""
    d = distances(spark, sf_dir)
    enough = d.groupBy("uid").agg(F.count("*").alias("n")).where("n >= 5").select("uid")
    r = movement.robust_regressions(d.join(enough, "uid", "left_semi"))
    return rounded(r.select("uid", "rate", "n_reg", "outl"), "rate", places=4)


ROBUST = f"""WITH {DISTANCES}, d AS (SELECT * FROM dist WHERE uid IN (SELECT uid FROM dist GROUP BY uid HAVING count(*) >= 5)),
    f AS (SELECT uid, regr_slope(dist, year) AS b, regr_intercept(dist, year) AS a FROM d GROUP BY uid), r AS (SELECT d.*, dist - b * year - a AS res FROM d JOIN f USING (uid)),
    m AS (SELECT *, abs(res - median(res) OVER (PARTITION BY uid)) AS off_ FROM r), k AS (SELECT *, coalesce(off_ * 0.6745 / nullif(median(off_) OVER (PARTITION BY uid), 0) > 3.5, false) AS outlier FROM m)
    SELECT uid, round(regr_slope(dist, year) FILTER (WHERE NOT outlier), 4) + 0.0 AS rate, CAST(count(*) FILTER (WHERE NOT outlier) AS BIGINT) AS n_reg,
           coalesce(string_agg(CAST(year AS VARCHAR), ' ' ORDER BY year) FILTER (WHERE outlier), '') AS outl FROM k GROUP BY uid"""


def t_pvalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trends with their significance."""
    return cut(movement.regressions(distances(spark, sf_dir)).select("uid", "sig"), "sig")


PVALUE = f"""WITH {DISTANCES}, r AS (SELECT uid, {REGR} FROM dist GROUP BY uid), a AS (SELECT *, n_reg - 2 AS df, atan(abs(rate / nullif(se, 0)) / sqrt(greatest(n_reg - 2, 1))) AS t FROM r),
    p AS (SELECT uid, CASE WHEN df < 1 OR se IS NULL THEN NULL WHEN se = 0 THEN CASE WHEN rate = 0 THEN 1.0 ELSE 0.0 END WHEN df = 1 THEN 1 - 2 * t / pi() WHEN df = 2 THEN 1 - sin(t)
        WHEN df = 3 THEN 1 - 2 / pi() * (t + sin(t) * cos(t)) WHEN df = 4 THEN 1 - sin(t) * (1 + pow(cos(t), 2) / 2) WHEN df = 5 THEN 1 - 2 / pi() * (t + sin(t) * (cos(t) + 2.0 / 3 * pow(cos(t), 3)))
        WHEN df = 6 THEN 1 - sin(t) * (1 + pow(cos(t), 2) / 2 + 3.0 / 8 * pow(cos(t), 4)) END AS sig FROM a)
    SELECT uid, {cut_sql('CASE WHEN sig < 0 THEN 0.0 ELSE sig END')} AS sig FROM p"""


def all_time_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(movement.all_time_stats(distances(spark, sf_dir), 1996), "sce", "nsm")


STATS = f"""{DISTANCES}, st AS (SELECT uid, count(*) AS valid_obs, max(year) - min(year) + 1 AS valid_span, round(max(dist) - min(dist), 6) + 0.0 AS sce,
    round(arg_max(dist, year) - coalesce(max(dist) FILTER (WHERE year = 1996), arg_min(dist, year)), 6) + 0.0 AS nsm, arg_max(year, row(dist, -year)) AS max_year, arg_min(year, row(dist, year)) AS min_year FROM dist GROUP BY uid)"""


def angle_spread(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), (F.col("o_totalprice") % 90).alias("angle"))
    return rounded(movement.angle_spread(o), "angle_std", places=4)


_R = "sqrt(pow(avg(cos(radians(o_totalprice % 90))), 2) + pow(avg(sin(radians(o_totalprice % 90))), 2))"


def roc_certainty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Certainty from trend, spread of angles and number of years; the thresholds of the tile stage scaled to these tables."""
    d = distances(spark, sf_dir)
    stats = movement.all_time_stats(d, 1996).join(movement.regressions(d, with_p=False), "uid")
    o = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("uid"), (F.col("o_totalprice") % 90).alias("angle"))
    joined = stats.join(movement.angle_spread(o), "uid")
    c = movement.certainty(F.round(F.col("rate") * 4, 4), F.round(F.col("angle_std") + 4, 4), F.col("valid_obs"), 5)
    return joined.select("uid", c.alias("certainty"))


CERTAINTY = f"""WITH {STATS}, f AS (SELECT uid, regr_slope(dist, year) AS rate FROM dist GROUP BY uid),
    a AS (SELECT o_custkey AS uid, degrees(sqrt(-2 * ln(least({_R}, 1.0)))) AS angle_std FROM orders GROUP BY o_custkey)
    SELECT uid, CASE WHEN valid_obs < 5 THEN 'insufficient observations' WHEN round(angle_std + 4, 4) > 30 THEN 'high angular variability' WHEN abs(round(rate * 4, 4)) > 200 THEN 'extreme value (> 200 m)' ELSE 'good' END AS certainty
    FROM st JOIN f USING (uid) JOIN a USING (uid)"""


def geohash_uid(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    lat, lon = F.col("c_acctbal") / 120, F.col("c_custkey") * 0.37 % 360 - 180
    return c.select("c_custkey", g.geohash(lat, lon, 10).alias("uid10"), g.geohash(lat, lon, 11).alias("uid11"))


def _geohash_sql(precision: int) -> str:
    bits = 5 * precision
    n_lon, n_lat = (bits + 1) // 2, bits // 2

    def bit(k: int) -> str:
        return f"((lo{n_lon} >> {n_lon - 1 - k // 2}) & 1)" if k % 2 == 0 else f"((la{n_lat} >> {n_lat - 1 - k // 2}) & 1)"

    letters = [f"substr('{g.GEOHASH}', CAST({' + '.join(f'{bit(5 * c + i)} * {16 >> i}' for i in range(5))} AS INT) + 1, 1)" for c in range(precision)]
    return " || ".join(letters)


GEOHASH = f"""WITH p AS (SELECT c_custkey, c_acctbal / 120 AS lat, c_custkey * CAST(0.37 AS DOUBLE) % 360 - 180 AS lon FROM customer),
    b AS (SELECT c_custkey, {', '.join(f'CAST(floor((lon + 180) / 360 * {float(1 << n)}) AS BIGINT) AS lo{n}' for n in (25, 28))}, {', '.join(f'CAST(floor((lat + 90) / 180 * {float(1 << n)}) AS BIGINT) AS la{n}' for n in (25, 27))} FROM p)
    SELECT c_custkey, {_geohash_sql(10)} AS uid10, {_geohash_sql(11)} AS uid11 FROM b"""


def region_attribute(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers' places with the territory whose ring they are in; territories are diamonds on a grid."""
    c = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_acctbal") / 100).alias("x"), (F.col("c_custkey") % 97).cast("double").alias("y"))
    n = table(spark, sf_dir, "nation")
    cx, cy = F.col("n_nationkey") % 5 * 22 + 1.0, F.expr("n_nationkey div 5") * 20 + 1.0
    corner = lambda dx, dy: F.struct((cx + dx).alias("x"), (cy + dy).alias("y"))
    regions = n.select(F.col("n_name").alias("territory"), F.array(corner(-14, 0), corner(0, -9), corner(14, 0), corner(0, 9), corner(-14, 0)).alias("ring"))
    return spatial.with_region(c, regions, "territory").select("c_custkey", "territory")


REGION = """WITH c AS (SELECT c_custkey, c_acctbal / 100 AS x, CAST(c_custkey % 97 AS DOUBLE) AS y FROM customer),
    n AS (SELECT n_name, n_nationkey % 5 * 22 + 1.0 AS cx, n_nationkey // 5 * 20 + 1.0 AS cy FROM nation)
    SELECT c_custkey, min(n_name) AS territory FROM c LEFT JOIN n ON abs(x - cx) / 14 + abs(y - cy) / 9 < 1 GROUP BY c_custkey"""


def signed_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", F.col("l_tax").alias("v1"), F.col("l_discount").alias("v0"), F.col("l_quantity").alias("length"))
    return movement.signed_differences(li).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "direction", "diff")


def nearest_pair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of each customer the closest pair of an urgent and another order, in price and time."""
    o = table(spark, sf_dir, "orders").withColumns({"x": F.col("o_totalprice") / 1000, "y": F.datediff("o_orderdate", F.lit("1995-01-01")).cast("double")})
    a = o.where("o_orderpriority = '1-URGENT'").select("o_custkey", F.col("o_orderkey").alias("i"), "x", "y")
    b = o.where("o_orderpriority <> '1-URGENT'").select("o_custkey", F.col("o_orderkey").alias("j"), "x", "y")
    return rounded(spatial.nearest_pairs(a, b, ["o_custkey"]).select("o_custkey", "i", "j", "length"), "length")


NEAREST_PAIR = """WITH o AS (SELECT o_custkey, o_orderkey, o_orderpriority, o_totalprice / 1000 AS x, CAST(date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) AS DOUBLE) AS y FROM orders),
    m AS (SELECT a.o_custkey, a.o_orderkey AS i, b.o_orderkey AS j, sqrt((a.x - b.x) * (a.x - b.x) + (a.y - b.y) * (a.y - b.y)) AS length FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.o_orderpriority = '1-URGENT' AND b.o_orderpriority <> '1-URGENT')
    SELECT o_custkey, i, j, round(length, 6) + 0.0 AS length FROM m QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY m.length, i, j) = 1"""


def transect_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Where suppliers' segments cross a nation's horizontal line."""
    s = movement.line_segments(vertices(spark, sf_dir), ["line"])
    at = F.col("line") * 15.0 + 60
    pt = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    c = g.crossing(pt(F.col("ax"), F.col("ay")), pt(F.col("bx"), F.col("by")), pt(F.lit(-100.0), at), pt(F.lit(2000.0), at))
    return rounded(s.select("line", "seq", c.x.alias("x")).where("x is not null"), "x", places=4)


def nearest_on_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The nearest point of each line to the place (300, 200)."""
    s = movement.line_segments(vertices(spark, sf_dir), ["line"])
    n = g.nearest_on_segment(F.lit(300.0), F.lit(200.0), F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    near = s.select("line", n.alias("p")).withColumn("d", g.distance(F.col("p.x"), F.col("p.y"), F.lit(300.0), F.lit(200.0)))
    return rounded(near.groupBy("line").agg(F.min("d").alias("distance")), "distance", places=4)


QUERIES = {f.__name__: f for f in (
    zero_crossings, contour_length, contour_lines, contour_certainty, pixel_certainty, points_every_30, transects_every_30, line_measures, annual_movement, baseline_distances,
    roc_regression, robust_regression, t_pvalue, all_time_stats, angle_spread, roc_certainty, geohash_uid, region_attribute, signed_difference, nearest_pair, transect_crossings, nearest_on_segments,
)}
_t = "(k * 30 - at_) / len"
ORACLE_SQL = {
    "zero_crossings": f"""WITH {RIGHT_UP} SELECT year, x, y, 'x' AS axis, round(x + v / (v - rgt), 6) + 0.0 AS cx, round(CAST(y AS DOUBLE), 6) + 0.0 AS cy FROM n WHERE (v < 0) <> (rgt < 0)
        UNION ALL SELECT year, x, y, 'y', round(CAST(x AS DOUBLE), 6) + 0.0, round(y + v / (v - up), 6) + 0.0 FROM n WHERE (v < 0) <> (up < 0)""",
    "contour_length": CONTOUR_LENGTH,
    "pixel_certainty": f"WITH {ANNUAL} SELECT x, y, year, CASE WHEN twndwi_mad > 0.25 THEN 'tidal issues' WHEN count < 10 THEN 'insufficient data' ELSE 'good' END AS certainty FROM annual",
    "points_every_30": f"WITH {SEGMENTS} SELECT line, k, round(ax + {_t} * (bx - ax), 4) + 0.0 AS x, round(ay + {_t} * (by_ - ay), 4) + 0.0 AS y FROM pts",
    "transects_every_30": f"""WITH {SEGMENTS}, c AS (SELECT line, k, ax + {_t} * (bx - ax) AS x, ay + {_t} * (by_ - ay) AS y, -(by_ - ay) / len * 50 AS nx, (bx - ax) / len * 50 AS ny FROM pts)
        SELECT line, k, round(x - nx, 4) + 0.0 AS ax, round(y - ny, 4) + 0.0 AS ay, round(x + nx, 4) + 0.0 AS bx, round(y + ny, 4) + 0.0 AS by FROM c""",
    "line_measures": MEASURES,
    "annual_movement": MOVEMENT,
    "baseline_distances": f"WITH {DISTANCES} SELECT d.uid, d.year, round(d.dist - b.dist, 6) + 0.0 AS dist FROM dist d JOIN dist b ON b.uid = d.uid AND b.year = 2000",
    "roc_regression": f"WITH {DISTANCES}, r AS (SELECT uid, {REGR} FROM dist GROUP BY uid) SELECT uid, n_reg, {cut_sql('rate', 4)} AS rate, {cut_sql('incpt', 2)} AS incpt, {cut_sql('se', 4)} AS se FROM r",
    "robust_regression": ROBUST,
    "t_pvalue": PVALUE,
    "all_time_stats": f"WITH {STATS} SELECT * FROM st",
    "angle_spread": f"SELECT o_custkey AS uid, round(degrees(sqrt(-2 * ln(least({_R}, 1.0)))), 4) + 0.0 AS angle_std FROM orders GROUP BY o_custkey",
    "roc_certainty": CERTAINTY,
    "geohash_uid": GEOHASH,
    "region_attribute": REGION,
    "signed_difference": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE WHEN l_tax - l_discount < 0 THEN 1 ELSE -1 END AS direction, CASE WHEN l_tax - l_discount < 0 THEN 1 ELSE -1 END * l_quantity AS diff FROM lineitem",
    "nearest_pair": NEAREST_PAIR,
    "transect_crossings": f"""WITH {SEGMENTS}, c AS (SELECT line, seq, ax + (line * 15.0 + 60 - ay) / nullif(by_ - ay, 0) * (bx - ax) AS x, (line * 15.0 + 60 - ay) / nullif(by_ - ay, 0) AS t FROM seg)
        SELECT line, seq, round(x, 4) + 0.0 AS x FROM c WHERE t BETWEEN 0 AND 1""",
    "nearest_on_segments": f"""WITH {SEGMENTS}, t AS (SELECT *, greatest(0.0, least(1.0, coalesce(((300 - ax) * (bx - ax) + (200 - ay) * (by_ - ay)) / nullif(len * len, 0), 0.0))) AS t FROM seg)
        SELECT line, round(min(sqrt(pow(ax + t * (bx - ax) - 300, 2) + pow(ay + t * (by_ - ay) - 200, 2))), 4) + 0.0 AS distance FROM t GROUP BY line""",
}
