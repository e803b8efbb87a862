"""Queries of tides, the yearly stack and the cleaning of its grids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import dates
from strandline.operators import morphology, side, stack, tides
from strandline.operators.mosaic import composite
from strandline.functions.indices import BANDS
from strandline.plans.cube import ANNUAL, CELL, FIRST, INDEX, LAST, OBS, annual, daily, obs, rounded, yearly_index
from strandline.plans.mosaics import THREE
from strandline.sources.tables import table

# Tides: 16 coarse cells (4 x 4), a height a cell and day, from the events; scenes: observations whose days of the month meet.


def heights(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    return e.groupBy((F.col("user_id") % 4).cast("int").alias("cx"), F.expr("cast((user_id div 4) % 4 as int)").alias("cy"), F.dayofmonth("ts").alias("ts")).agg(F.round(F.avg("value") - 20, 6).alias("height"))


HEIGHTS = """heights AS (SELECT CAST(user_id % 4 AS INT) AS cx, CAST((user_id // 4) % 4 AS INT) AS cy, CAST(day(ts) AS INT) AS ts, round(avg(value) - 20, 6) AS height
    FROM events GROUP BY ALL)"""


def scenes(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = obs(spark, sf_dir)
    return o.select("okey", "lnum", "pkey", "skey", F.expr("x div 5").cast("int").alias("cx"), F.expr("y div 5").cast("int").alias("cy"), F.dayofmonth("ts").alias("ts"), "x", "y", "green", "nir08")


SCENES = f"""{OBS}, scenes AS (SELECT okey, lnum, pkey, skey, CAST(x // 5 AS INT) AS cx, CAST(y // 5 AS INT) AS cy, CAST(day(ts) AS INT) AS ts, x, y, green, nir08 FROM obs)"""
CUTS = f"{HEIGHTS}, cuts AS (SELECT cx, cy, -(max(height) - min(height)) * 0.25 AS lo, (max(height) - min(height)) * 0.25 AS hi FROM heights GROUP BY cx, cy)"


def tide_cutoffs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(tides.cutoffs(heights(spark, sf_dir), ["cx", "cy"]), "lo", "hi")


def _filtered(strict: bool):  # noqa: ANN202
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        f = tides.tide_filter(scenes(spark, sf_dir), heights(spark, sf_dir), ["cx", "cy"], ["green", "nir08"], strict)
        return rounded(f.select("okey", "lnum", "pkey", "skey", "ts", "in_range", "green", "nir08"), "green", "nir08")

    return query


def _filtered_sql(test: str) -> str:
    return f"""WITH {SCENES}, {CUTS}, useful AS (SELECT DISTINCT ts FROM heights JOIN cuts USING (cx, cy) WHERE height BETWEEN lo AND hi)
        SELECT okey, lnum, pkey, skey, s.ts, {test} AS in_range, CASE WHEN {test} THEN round(green, 6) + 0.0 END AS green, CASE WHEN {test} THEN round(nir08, 6) + 0.0 END AS nir08
        FROM scenes s JOIN heights h USING (cx, cy, ts) JOIN cuts USING (cx, cy) WHERE s.ts IN (SELECT ts FROM useful)"""


def bilinear_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tide of five days on fine cells, from the coarse cells around them."""
    h = heights(spark, sf_dir).where("ts <= 5")
    fine = obs(spark, sf_dir).select("x", "y").distinct().crossJoin(h.select("ts").distinct())
    return rounded(tides.bilinear(fine, h, "height", (F.col("x") - 2) / 5.0, (F.col("y") - 2) / 5.0, ["ts"]), "height")


_term = lambda w, c: f"CASE WHEN {w} = 0 THEN 0.0 ELSE {w} * {c} END"
BILINEAR = f"""WITH {OBS}, {HEIGHTS}, fine AS (SELECT * FROM (SELECT DISTINCT x, y FROM obs), (SELECT DISTINCT ts FROM heights WHERE ts <= 5)),
    p AS (SELECT *, (x - 2) / 5.0 AS fx, (y - 2) / 5.0 AS fy FROM fine),
    q AS (SELECT x, y, ts, floor(fx) AS cx, floor(fy) AS cy, fx - floor(fx) AS u, fy - floor(fy) AS v FROM p)
    SELECT q.x, q.y, q.ts, round({_term('(1-u)*(1-v)', 'a.height')} + {_term('u*(1-v)', 'b.height')} + {_term('(1-u)*v', 'c.height')} + {_term('u*v', 'd.height')}, 6) + 0.0 AS height
    FROM q LEFT JOIN heights a ON a.ts = q.ts AND a.cx = q.cx AND a.cy = q.cy LEFT JOIN heights b ON b.ts = q.ts AND b.cx = q.cx + 1 AND b.cy = q.cy
    LEFT JOIN heights c ON c.ts = q.ts AND c.cx = q.cx AND c.cy = q.cy + 1 LEFT JOIN heights d ON d.ts = q.ts AND d.cx = q.cx + 1 AND d.cy = q.cy + 1
    WHERE a.height IS NOT NULL"""


def tide_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Harmonic heights of two constituents in the suppliers' cells at the orders' days of one month."""
    s = table(spark, sf_dir, "supplier").where("s_suppkey < 12").select(F.col("s_suppkey").cast("int").alias("cx"), F.lit(0).alias("cy"), "s_acctbal")
    parts = F.array(F.struct(F.lit("m2").alias("name"), (F.col("s_acctbal") / 10000).alias("amplitude"), (F.col("s_acctbal") % 360).alias("phase")), F.struct(F.lit("k1").alias("name"), F.lit(0.3).alias("amplitude"), F.lit(40.0).alias("phase")))
    c = s.select("cx", "cy", F.explode(parts).alias("p")).select("cx", "cy", "p.*")
    times = table(spark, sf_dir, "orders").where("o_orderdate between '1997-03-01' and '1997-03-31'").select(F.col("o_orderdate").alias("ts")).distinct()
    m = tides.modelled(s, c, times)
    return rounded(m.select("cx", F.date_format("ts", "yyyy-MM-dd").alias("day"), "height"), "height")


TIDE_MODEL = """WITH c AS (SELECT CAST(s_suppkey AS INT) AS cx, 28.984104 AS speed, s_acctbal / 10000 AS amplitude, s_acctbal % 360 AS phase FROM supplier WHERE s_suppkey < 12
        UNION ALL SELECT CAST(s_suppkey AS INT), 15.041069, 0.3, 40.0 FROM supplier WHERE s_suppkey < 12),
    t AS (SELECT DISTINCT o_orderdate AS ts FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1997-03-01' AND TIMESTAMP '1997-03-31')
    SELECT cx, strftime(ts, '%Y-%m-%d') AS day, round(sum(amplitude * cos((speed * (epoch(ts) / 3600.0) - phase) * (pi() / 180))), 6) + 0.0 AS height FROM c, t GROUP BY cx, ts"""


def useful_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = heights(spark, sf_dir)
    return tides.useful_times(h, tides.cutoffs(h, ["cx", "cy"]), ["cx", "cy"])


# The stack ------------------------------------------------------------------------------------------------------------------


def _three(spark: SparkSession, sf_dir: str) -> DataFrame:
    spread = dates.spread_over_composites(daily(spark, sf_dir), 3, FIRST, LAST)
    return composite(spread.drop("year").withColumnRenamed("period_year", "year"), [*CELL, "year"], list(BANDS))


def cloud_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yearly values with those of three years where observations are few. Counts are thinned so that some are."""
    one = annual(spark, sf_dir).withColumn("count", F.expr("cast(count div (1 + (x + y + year) % 9) as int)"))
    return rounded(stack.with_fallback(one, [_three(spark, sf_dir)], [*CELL, "year"], ["twndwi", "green"]).select(*CELL, "year", "count", "twndwi", "green"), "twndwi", "green")


FALLBACK = f"""WITH {THREE}, one AS (SELECT * REPLACE (CAST(count // (1 + (x + y + year) % 9) AS INT) AS count) FROM annual)
    SELECT o.tile, o.x, o.y, o.year, o.count, round(CASE WHEN o.twndwi IS NULL OR o.count <= 4 THEN t.twndwi ELSE o.twndwi END, 6) + 0.0 AS twndwi,
           round(CASE WHEN o.green IS NULL OR o.count <= 4 THEN t.green ELSE o.green END, 6) + 0.0 AS green
    FROM one o LEFT JOIN three t ON o.x = t.x AND o.y = t.y AND o.year = t.year"""


def model_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values hidden where a prediction says cloud (1) or is missing."""
    p = F.expr("case when (x * 5 + y * 3 + year) % 7 = 0 then 1 when (x + y) % 11 = 0 then null else 0 end")
    m = stack.mask_predicted(annual(spark, sf_dir).withColumn("prediction", p), ["twndwi", "green"])
    return rounded(m.select(*CELL, "year", F.coalesce("prediction", F.lit(-1)).alias("prediction"), "twndwi", "green"), "twndwi", "green")


def masked_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clouds masked in both composite lengths, then the longer one where the shorter lacks a value or observations."""
    p = lambda k: F.expr(f"case when (x * 5 + y * 3 + year + {k}) % 4 = 0 then 1 else 0 end")
    one = annual(spark, sf_dir).withColumn("count", F.expr("cast(count div (1 + (x + y + year) % 9) as int)")).withColumn("prediction", p(0))
    f = stack.masked_with_fallback([one, _three(spark, sf_dir).withColumn("prediction", p(1))], [*CELL, "year"], ["twndwi"])
    return rounded(f.select(*CELL, "year", "twndwi"), "twndwi")


def zone_masks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index in a zone of analysis and off inland water."""
    g = grid(spark, sf_dir)
    cells = g.select("x", "y").distinct()
    m = morphology.with_masks(g, ["twndwi"], cells.where("x + y < 25"), cells.where("x between 6 and 7 and y = 8"))
    return rounded(m.select("year", "x", "y", "twndwi"), "twndwi")


BLANK = "(x * 7 + y * 3 + year) % 3 = 0 or (x + y + year) % 4 = 0"


def gap_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two values filled along the years; a third of the cells are blanked, and a year is left out of some."""
    a = yearly_index(spark, sf_dir).where("not ((x + y) % 5 = 0 and year = 1998)")
    a = a.withColumns({"twndwi": F.when(~F.expr(BLANK), F.col("twndwi")), "other": F.when(F.expr(BLANK), F.col("twndwi"))})
    return rounded(stack.fill_gaps(a, CELL, ["twndwi", "other"]), "twndwi", "other")


GAP_FILL = f"""WITH {INDEX}, a AS (SELECT tile, x, y, year, CASE WHEN NOT ({BLANK}) THEN twndwi END AS twndwi, CASE WHEN {BLANK} THEN twndwi END AS other FROM idx WHERE NOT ((x + y) % 5 = 0 AND year = 1998)),
    r AS (SELECT *, year - row_number() OVER (PARTITION BY x, y ORDER BY year) AS run FROM a),
    c AS (SELECT *, coalesce(twndwi, lead(twndwi) OVER w) AS c1, coalesce(other, lead(other) OVER w) AS c2 FROM r WINDOW w AS (PARTITION BY x, y, run ORDER BY year))
    SELECT tile, x, y, year, round(last_value(c1 IGNORE NULLS) OVER w, 6) + 0.0 AS twndwi, round(last_value(c2 IGNORE NULLS) OVER w, 6) + 0.0 AS other
    FROM c WINDOW w AS (PARTITION BY x, y, run ORDER BY year ROWS UNBOUNDED PRECEDING)"""


def wide_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(stack.years_as_columns(yearly_index(spark, sf_dir), ["x", "y"], "twndwi", [1995, 1998, 2001], "y"), "y1995", "y1998", "y2001")


def unpivot_years(spark: SparkSession, sf_dir: str) -> DataFrame:
    wide = stack.years_as_columns(yearly_index(spark, sf_dir), ["x", "y"], "twndwi", list(range(FIRST, LAST + 1)), "dist_")
    return rounded(stack.columns_as_years(wide, ["x", "y"]), "dist")


# Cleaning -------------------------------------------------------------------------------------------------------------------


def grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(year, x, y, twndwi): the whole 20 x 20 grid as one tile."""
    return yearly_index(spark, sf_dir).drop("tile")


def gaussian_smooth(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = grid(spark, sf_dir).withColumn("twndwi", F.when(F.expr("(x * 3 + y * 5 + year) % 8 <> 0"), F.col("twndwi")))
    return rounded(morphology.smooth(g, ["year"], ["twndwi"]), "twndwi")


SMOOTH = f"""WITH {INDEX}, g AS (SELECT year, x, y, CASE WHEN (x * 3 + y * 5 + year) % 8 <> 0 THEN twndwi END AS v FROM idx),
    k AS (SELECT dx, dy, [0.2501676, 0.1249999860, 0.0624581069][dx*dx+dy*dy+1] AS w FROM (VALUES (-1), (0), (1)) a(dx), (VALUES (-1), (0), (1)) b(dy))
    SELECT c.year, c.x, c.y, round(CASE WHEN count(*) = 9 AND max(c.v) IS NOT NULL THEN sum(n.v * w) / sum(w) FILTER (WHERE n.v IS NOT NULL) END, 6) + 0.0 AS twndwi
    FROM g c, k, g n WHERE n.year = c.year AND n.x = c.x + dx AND n.y = c.y + dy GROUP BY c.year, c.x, c.y"""
LAND = f"{INDEX}, land AS (SELECT year, x, y FROM idx WHERE twndwi < 0)"


def _land(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grid(spark, sf_dir).where("twndwi < 0").select("year", "x", "y")


def dilate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return morphology.dilate(_land(spark, sf_dir), ["year"], 2, grid(spark, sf_dir))


def erode(spark: SparkSession, sf_dir: str) -> DataFrame:
    return morphology.erode(_land(spark, sf_dir), ["year"], 1, grid(spark, sf_dir))


def _offsets(r: int) -> str:
    return ", ".join(f"({dx}, {dy})" for dx, dy in morphology.disk(r))


DILATE = lambda source, r: f"SELECT DISTINCT g.year, g.x, g.y FROM {source} s, (VALUES {_offsets(r)}) o(dx, dy), idx g WHERE g.year = s.year AND g.x = s.x + dx AND g.y = s.y + dy"
ERODE = lambda r: f"""SELECT year, x, y FROM land WHERE (year, x, y) NOT IN (SELECT (n.year, n.x + dx, n.y + dy) FROM (SELECT year, x, y FROM idx EXCEPT SELECT year, x, y FROM land) n, (VALUES {_offsets(r)}) o(dx, dy))"""


def connected_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Land connected to the first island's middle; the second island goes."""
    land = _land(spark, sf_dir)
    return morphology.connected_to(land.where("x between 6 and 8 and y between 9 and 10"), land, ["year"])


def connected_by_rounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    land = _land(spark, sf_dir)
    return morphology.connected_by_rounds(land.where("x between 6 and 8 and y between 9 and 10"), land, ["year"])


CONNECTED = f"""WITH RECURSIVE {LAND}, reach AS (SELECT year, x, y FROM land WHERE x BETWEEN 6 AND 8 AND y BETWEEN 9 AND 10
    UNION SELECT l.year, l.x, l.y FROM reach r JOIN land l ON l.year = r.year AND abs(l.x - r.x) + abs(l.y - r.y) = 1) SELECT year, x, y FROM reach"""


def analysis_zone(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three growing steps from the middle of the first island."""
    core = _land(spark, sf_dir).where("x = 8 and y = 10")
    return morphology.analysis_zone(core, grid(spark, sf_dir), ["year"], expansions=3)


def analysis_zone_cap(spark: SparkSession, sf_dir: str) -> DataFrame:
    core = _land(spark, sf_dir).where("x = 8 and y = 10")
    return morphology.analysis_zone(core, grid(spark, sf_dir), ["year"], expansions=1, cap=True)


_zone = f"{LAND}, z0 AS (SELECT year, x, y FROM land WHERE x = 8 AND y = 10)"
for _k in range(3):
    _zone += f", l{_k} AS (SELECT * FROM z{_k} INTERSECT SELECT * FROM land), z{_k + 1} AS (SELECT * FROM z{_k} UNION {DILATE(f'l{_k}', 2)})"


def consensus_land(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandline.functions.indices import with_indices

    return morphology.consensus_land(with_indices(annual(spark, sf_dir)), ["x", "y"])


def inland_water(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandline.functions.indices import with_indices

    ocean = morphology.consensus_land(with_indices(annual(spark, sf_dir)), ["x", "y"]).where("not land").select("x", "y")
    g = grid(spark, sf_dir).withColumn("twndwi", F.when(F.expr("(x * 3 + y * 5 + year) % 13 <> 0"), F.col("twndwi")))
    return morphology.inland_water(ocean, g, ["year"])


_nr = lambda a, b: f"({a} - {b}) / nullif({a} + {b}, 0)"
CONSENSUS = f"""{ANNUAL}, land_of AS (SELECT x, y, coalesce(median(n) < 0, false) AND coalesce(median(m) < 0, false) AND coalesce(median(r) < 0, false) AS land FROM (
    SELECT x, y, {_nr('green', 'nir08')} AS n, {_nr('green', 'swir16')} AS m, {_nr('0.128', 'nir08')} AS r FROM annual) GROUP BY x, y)"""
INLAND = f"""WITH RECURSIVE {CONSENSUS}, g AS (SELECT year, x, y, CASE WHEN (x * 3 + y * 5 + year) % 13 <> 0 THEN round(twndwi, 6) END AS v FROM annual),
    w AS (SELECT year, x, y FROM g JOIN land_of USING (x, y) WHERE v >= 0 OR (v IS NULL AND NOT land)),
    o AS (SELECT year, x, y FROM g JOIN land_of USING (x, y) WHERE NOT land),
    core AS (SELECT * FROM o WHERE (year, x, y) NOT IN (SELECT (n.year, n.x + dx, n.y + dy) FROM (SELECT year, x, y FROM g EXCEPT SELECT * FROM o) n, (VALUES {_offsets(2)}) f(dx, dy))),
    sea AS (SELECT * FROM (SELECT * FROM core INTERSECT SELECT * FROM w) UNION SELECT w.year, w.x, w.y FROM sea s JOIN w ON w.year = s.year AND abs(w.x - s.x) + abs(w.y - s.y) = 1)
    SELECT * FROM w EXCEPT SELECT * FROM sea"""


def mask_algebra(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cells of land in both of two years, in one only, and in neither."""
    land = _land(spark, sf_dir)
    a, b = (land.where(F.col("year") == y).select("x", "y") for y in (1996, 2000))
    every = grid(spark, sf_dir).select("x", "y").distinct()
    kinds = {"both": a.intersect(b), "lost": a.exceptAll(b), "gained": b.exceptAll(a), "never": every.exceptAll(a.union(b).distinct())}
    parts = [df.withColumn("kind", F.lit(k)) for k, df in kinds.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def rf_cloud_mask(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A forest learned from composites with a planted class, and its predictions for all of them."""
    a = annual(spark, sf_dir).withColumn("label", F.when((F.col("nir08") > 0.2), 1.0).otherwise(0.0))
    model = side.fit_forest(a.where("(x + y) % 3 = 0"), "label", trees=20)
    return side.predict_forest(model, a).select(*CELL, "year", "label", "prediction")


QUERIES = {
    "tide_filter": _filtered(False), "tide_filter_strict": _filtered(True),
    **{f.__name__: f for f in (
        tide_cutoffs, bilinear_join, tide_model, useful_times, cloud_fallback, masked_fallback, zone_masks, model_mask, gap_fill, wide_years, unpivot_years, gaussian_smooth, dilate, erode,
        connected_land, connected_by_rounds, analysis_zone, analysis_zone_cap, consensus_land, inland_water, mask_algebra, rf_cloud_mask,
    )},
}
ORACLE_SQL = {
    "tide_cutoffs": f"WITH {CUTS} SELECT cx, cy, round(lo, 6) + 0.0 AS lo, round(hi, 6) + 0.0 AS hi FROM cuts",
    "tide_filter": _filtered_sql("(height BETWEEN lo AND hi)"),
    "tide_filter_strict": _filtered_sql("(height > lo AND height < hi)"),
    "bilinear_join": BILINEAR.replace("\n    WHERE a.height IS NOT NULL", ""),
    "tide_model": TIDE_MODEL,
    "useful_times": f"WITH {CUTS} SELECT DISTINCT ts FROM heights JOIN cuts USING (cx, cy) WHERE height BETWEEN lo AND hi",
    "cloud_fallback": FALLBACK,
    "masked_fallback": f"""WITH {THREE}, one AS (SELECT *, (x * 5 + y * 3 + year) % 4 = 0 AS cloudy, CAST(count // (1 + (x + y + year) % 9) AS INT) AS n FROM annual)
        SELECT o.tile, o.x, o.y, o.year, round(CASE WHEN o.cloudy OR o.twndwi IS NULL OR o.n <= 4 THEN CASE WHEN (o.x * 5 + o.y * 3 + o.year + 1) % 4 <> 0 THEN t.twndwi END ELSE o.twndwi END, 6) + 0.0 AS twndwi
        FROM one o LEFT JOIN three t ON o.x = t.x AND o.y = t.y AND o.year = t.year""",
    "zone_masks": f"WITH {INDEX} SELECT year, x, y, CASE WHEN x + y < 25 AND NOT (x BETWEEN 6 AND 7 AND y = 8) THEN twndwi + 0.0 END AS twndwi FROM idx",
    "model_mask": f"""WITH {ANNUAL}, p AS (SELECT *, CASE WHEN (x * 5 + y * 3 + year) % 7 = 0 THEN 1 WHEN (x + y) % 11 = 0 THEN NULL ELSE 0 END AS prediction FROM annual)
        SELECT tile, x, y, year, coalesce(prediction, -1) AS prediction, CASE WHEN prediction <> 1 THEN round(twndwi, 6) + 0.0 END AS twndwi, CASE WHEN prediction <> 1 THEN round(green, 6) + 0.0 END AS green FROM p""",
    "gap_fill": GAP_FILL,
    "wide_years": f"WITH {INDEX} SELECT x, y, {', '.join(f'max(twndwi) FILTER (WHERE year = {y}) + 0.0 AS y{y}' for y in (1995, 1998, 2001))} FROM idx GROUP BY x, y",
    "unpivot_years": f"""WITH {INDEX} SELECT x, y, year, max(twndwi) + 0.0 AS dist FROM (
        SELECT c.x, c.y, CAST(k AS INT) AS year, twndwi FROM (SELECT DISTINCT x, y FROM idx) c CROSS JOIN range({FIRST}, {LAST + 1}) t(k) LEFT JOIN idx i ON i.x = c.x AND i.y = c.y AND i.year = k) GROUP BY x, y, year""",
    "gaussian_smooth": SMOOTH,
    "dilate": f"WITH {LAND} {DILATE('land', 2)}",
    "erode": f"WITH {LAND} {ERODE(1)}",
    "connected_land": CONNECTED,
    "connected_by_rounds": CONNECTED,
    "analysis_zone": f"WITH {_zone} SELECT year, x, y FROM z3",
    "analysis_zone_cap": f"WITH {_zone} SELECT * FROM z2 EXCEPT SELECT * FROM z1",
    "consensus_land": f"WITH {CONSENSUS} SELECT x, y, land FROM land_of",
    "inland_water": INLAND,
    "mask_algebra": f"""WITH {LAND}, a AS (SELECT x, y FROM land WHERE year = 1996), b AS (SELECT x, y FROM land WHERE year = 2000)
        SELECT *, 'both' AS kind FROM (SELECT * FROM a INTERSECT SELECT * FROM b) UNION ALL SELECT *, 'lost' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
        UNION ALL SELECT *, 'gained' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)
        UNION ALL SELECT *, 'never' FROM (SELECT DISTINCT x, y FROM idx EXCEPT (SELECT * FROM a UNION SELECT * FROM b))""",
}
