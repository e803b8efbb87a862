"""The continental summary: hotspots, flags for map services, and the filters on the merged layers."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as g
from strandline.functions.stats import regression
from strandline.operators.mosaic import middle
from strandline.operators.spatial import within
from strandline.operators.windows import in_windows, placed

#: North of this (EPSG 3832 metres) nothing of the Pacific layers is kept. A fixed value.
NORTH = 2_125_000


def merged(layers: list[DataFrame]) -> DataFrame:
    """All rows of all layers; columns that a layer lacks are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), layers)


def hotspots(centres: DataFrame, points: DataFrame, dist: DataFrame, radius: float, uid: str = "uid") -> tuple[DataFrame, DataFrame]:
    """(stats, medians): for each centre (cid, x, y) the good points within the radius: n, trend of the yearly medians, and
    certainty; and those medians (cid, year, dist), rounded half to even to two places, as the trend uses them.

    ``points`` has (uid, x, y, certainty), ``dist`` (uid, year, dist) stays long: wide years are made only at sinks. A point
    carries its years as one array to the tiles it can be near to, where windows.in_windows counts and takes medians: no row is
    made for a pair. Rows of one cid are one window, with a point as often as rows are near to it: at one place they are looked
    up once; only those of a cid at several places are joined pair by pair.
    """
    good = placed(points.where("certainty = 'good'").select(uid, "x", "y"))
    years = dist.where("dist is not null").groupBy(uid).agg(F.collect_list(F.struct("year", "dist")).alias("_years"))
    dated = good.join(years, uid, "left").select("x", "y", "_years")
    own = Window.partitionBy("cid")
    alike = lambda v: F.min(v).over(own) == F.max(v).over(own)
    c = placed(centres).select("cid", "x", "y", F.count("*").over(own).alias("_times"), (alike("x") & alike("y")).alias("_one"), F.row_number().over(own.orderBy("x")).alias("_at"))
    pairs = within(c.where("not _one"), dated, radius, ["cid"]).select("cid", "_years")
    several = pairs.groupBy("cid").agg(F.count("*").alias("n"), F.flatten(F.collect_list("_years")).alias("_all"))
    of_year = lambda y: F.array_sort(F.transform(F.filter("_all", lambda e: e.year.eqNullSafe(y)), lambda e: e.dist))
    several = several.select("cid", "n", F.transform(F.array_distinct(F.transform("_all", lambda e: e.year)), lambda y: F.struct(y.alias("year"), middle(of_year(y)).alias("dist"))).alias("_years"))
    # a row that is repeated counts its points as often; their median stays
    once = c.where("_one and _at = 1")
    single = in_windows(once.select("cid", "x", "y"), dated, radius)
    times = once.where("_times > 1").select(F.col("cid").alias("_cid"), "_times")
    single = single.join(times, F.col("cid").eqNullSafe(F.col("_cid")), "left").select("cid", (F.col("n") * F.coalesce("_times", F.lit(1))).alias("n"), "_years")
    found = single.unionByName(several)
    by_year = found.select("cid", "n", F.explode_outer("_years").alias("_y")).select("cid", "n", F.col("_y").isNotNull().alias("_some"), F.col("_y.year").alias("year"), F.bround("_y.dist", 2).alias("dist"))
    medians = by_year.where("_some").select("cid", "year", "dist")
    *trend, n_reg = regression("dist", "year")
    trends = by_year.groupBy("cid").agg(*trend, F.when(F.max("_some"), n_reg).alias("n_reg"), F.max("n").alias("n"))
    stats = centres.select("cid", "x", "y").join(trends, "cid", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    enough = F.when(F.col("n") < radius / 30, "insufficient points").otherwise("good")
    return stats.withColumns({"radius_m": F.lit(radius), "certainty": enough}), medians


def wms_fields(df: DataFrame, rate: str = "rate", se: str = "se", sig: str = "sig") -> DataFrame:
    """Columns that a map service styles by. Flags are false where their value is missing; a falling distance is growth."""
    flag = lambda c: F.coalesce(c, F.lit(False))
    return df.withColumns({
        "wms_abs": F.abs(F.col(rate)), "wms_conf": F.col(se) * 1.96, "wms_grew": flag(F.col(rate) < 0), "wms_retr": flag(F.col(rate) > 0),
        "wms_sig": flag(F.col(sig) <= 0.01), "wms_good": flag(F.col("certainty") == "good"),
    })


def south_of(points: DataFrame, limit: float = NORTH) -> DataFrame:
    return points.where(F.col("y") <= limit)


def lines_south_of(lines: DataFrame, limit: float = NORTH) -> DataFrame:
    return lines.where(g.bounds(F.col("vertices")).maxy <= limit)


def removed_counts(before: DataFrame, limit: float = NORTH) -> DataFrame:
    """(kept, removed) for the log."""
    return before.agg(F.count_if(F.col("y") <= limit).alias("kept"), F.count_if(~(F.col("y") <= limit)).alias("removed"))


def shorelines_by_year(spark, view: str = "shorelines_annual") -> DataFrame:  # noqa: ANN001
    return spark.sql(f"SELECT * FROM {view} ORDER BY year")
