"""Points and transects along lines, their yearly movement, trends, and what is derived from these."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as g
from strandline.functions.stats import regression, significance


def line_segments(vertices: DataFrame, line: list[str], seq: str = "seq") -> DataFrame:
    """(line, seq, ax, ay, bx, by, len, at): the segments between a line's vertices, and the length before each."""
    by = Window.partitionBy(*line).orderBy(seq)
    s = vertices.select(*line, F.col(seq).alias("seq"), F.col("x").alias("ax"), F.col("y").alias("ay"), F.lead("x").over(by).alias("bx"), F.lead("y").over(by).alias("by")).where("bx is not null")
    s = s.withColumn("len", g.distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by")))
    before = Window.partitionBy(*line).orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return s.withColumn("at", F.coalesce(F.sum("len").over(before), F.lit(0.0)))


def points_along(vertices: DataFrame, line: list[str], spacing: float, seq: str = "seq") -> DataFrame:
    """(line, k, x, y): a point every ``spacing`` along each line, from its first vertex on; each segment makes its own points."""
    s = line_segments(vertices, line, seq).where("len > 0")
    k0, k1 = F.ceil(F.col("at") / spacing), F.ceil((F.col("at") + F.col("len")) / spacing) - 1
    made = s.where(k0 <= k1).withColumn("k", F.explode(F.sequence(k0, k1)))
    t = (F.col("k") * spacing - F.col("at")) / F.col("len")
    return made.select(*line, "k", (F.col("ax") + t * (F.col("bx") - F.col("ax"))).alias("x"), (F.col("ay") + t * (F.col("by") - F.col("ay"))).alias("y"))


def transects(vertices: DataFrame, line: list[str], spacing: float, reach: float, seq: str = "seq") -> DataFrame:
    """(line, k, ax, ay, bx, by): at every point along a line a segment across it, ``reach`` to each side."""
    s = line_segments(vertices, line, seq).where("len > 0")
    k0, k1 = F.ceil(F.col("at") / spacing), F.ceil((F.col("at") + F.col("len")) / spacing) - 1
    m = s.where(k0 <= k1).withColumn("k", F.explode(F.sequence(k0, k1)))
    t = (F.col("k") * spacing - F.col("at")) / F.col("len")
    x, y = F.col("ax") + t * (F.col("bx") - F.col("ax")), F.col("ay") + t * (F.col("by") - F.col("ay"))
    nx, ny = -(F.col("by") - F.col("ay")) / F.col("len") * reach, (F.col("bx") - F.col("ax")) / F.col("len") * reach
    return m.select(*line, "k", (x - nx).alias("ax"), (y - ny).alias("ay"), (x + nx).alias("bx"), (y + ny).alias("by"))


#: The first, narrow search of annual_movements goes this share of the greatest distance.
NARROW = 1 / 16


def _nearest(points: DataFrame, segments: DataFrame, side: float, uid: str, by: list[str]) -> DataFrame:
    """(uid, year, dist, angle) of the nearest place on a segment within ``side``: segments stand in every square bucket their
    box touches, a point looks in 3 x 3. An aggregate with partial minima finds the nearest."""
    floor = lambda c: F.floor(c / side)
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    looks = points.withColumn("_o", F.explode(near)).withColumns({"_i": floor(F.col("px")) + F.col("_o.i"), "_j": floor(F.col("py")) + F.col("_o.j")}).drop("_o")
    span = lambda a, b: F.sequence(floor(F.least(a, b)), floor(F.greatest(a, b)))
    dealt = segments.withColumn("_i", F.explode(span("ax", "bx"))).withColumn("_j", F.explode(span("ay", "by")))
    px, py = F.col("px"), F.col("py")
    at = g.nearest_on_segment(px, py, F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    met = looks.join(dealt, [*by, "_i", "_j"]).withColumn("_at", at).withColumn("dist", g.distance(px, py, F.col("_at.x"), F.col("_at.y")))
    angle = F.when(F.col("dist") > 0, F.degrees(F.atan2(F.col("_at.y") - py, F.col("_at.x") - px)))
    return met.where(F.col("dist") <= side).withColumn("angle", angle).groupBy(uid, "year").agg(F.min(F.struct("dist", "angle")).alias("_n")).select(uid, "year", "_n.dist", "_n.angle")


def annual_movements(points: DataFrame, contours: DataFrame, uid: str = "uid", most: float = 5000.0, sign: DataFrame | None = None) -> DataFrame:
    """(uid, year, dist, angle): the distance from each point to the nearest place on each year's contour, at most ``most`` away,
    and the direction to it in degrees (null on the contour itself).

    ``contours`` has segments (year, ax, ay, bx, by), or single points (year, x, y). Most points have a contour nearby, so
    small buckets are searched first; only points and years without a hit look as far as ``most``. ``sign`` (uid, year, wet)
    makes the distance negative where the point's place is not wet in that year.
    """
    if "ax" not in contours.columns:
        contours = contours.select("year", F.col("x").alias("ax"), F.col("y").alias("ay"), F.col("x").alias("bx"), F.col("y").alias("by"))
    segments = contours.select("year", "ax", "ay", "bx", "by")
    places = points.select(uid, F.col("x").alias("px"), F.col("y").alias("py"))
    close = _nearest(places, segments, most * NARROW, uid, [])
    # a handful of years: what the narrow search did not find in a year
    years = places.join(F.broadcast(segments.select("year").distinct()), how="cross")
    rest = years.join(close.select(uid, "year"), [uid, "year"], "left_anti")
    found = close.unionByName(_nearest(rest, segments, most, uid, ["year"]))
    if sign is None:
        return found
    return found.join(sign.select(uid, "year", "wet"), [uid, "year"], "left").select(uid, "year", F.when(F.col("wet"), F.col("dist")).otherwise(-F.col("dist")).alias("dist"), "angle")


def latest(df: DataFrame, year: str = "year") -> DataFrame:
    """The rows of the last year there is: the baseline of movements. One row with that year is broadcast."""
    return df.join(F.broadcast(df.agg(F.max(year).alias(year))), year, "left_semi")


def relative_to(dist: DataFrame, baseline: int, uid: str = "uid") -> DataFrame:
    """Distances less that of the baseline year, 0 in that year."""
    base = dist.where(F.col("year") == baseline).select(uid, F.col("dist").alias("_base"))
    return dist.join(base, uid).select(uid, "year", (F.col("dist") - F.col("_base")).alias("dist"))


def regressions(dist: DataFrame, uid: str = "uid", with_p: bool = True) -> DataFrame:
    """(uid, rate, incpt, se, n_reg[, sig]) of a line through the distances by year."""
    r = dist.groupBy(uid).agg(*regression("dist", "year"))
    return r.withColumn("sig", significance(F.col("rate"), F.col("se"), F.col("n_reg"))) if with_p else r


def outliers(dist: DataFrame, uid: str = "uid", limit: float = 3.5) -> DataFrame:
    """(uid, year, dist, outlier): whether a year's residual from the uid's line is far out by the modified z-score
    0.6745 |r - median| / MAD. A MAD of 0 marks nothing."""
    by = Window.partitionBy(uid)
    fit = dist.withColumn("_r", F.col("dist") - F.regr_slope("dist", "year").over(by) * F.col("year") - F.regr_intercept("dist", "year").over(by))
    off = fit.withColumn("_off", F.abs(F.col("_r") - F.median("_r").over(by)))
    return off.select(uid, "year", "dist", F.coalesce(F.try_divide(F.col("_off") * 0.6745, F.median("_off").over(by)) > limit, F.lit(False)).alias("outlier"))


def robust_regressions(dist: DataFrame, uid: str = "uid") -> DataFrame:
    """regressions() without the outliers, and their years in order as text."""
    marked = outliers(dist, uid)
    kept = [F.when(~F.col("outlier"), F.col(c)).alias(c) for c in ("dist", "year")]
    fit = marked.select(uid, *kept).groupBy(uid).agg(*regression("dist", "year"))
    out = marked.where("outlier").groupBy(uid).agg(F.concat_ws(" ", F.sort_array(F.collect_list(F.col("year").cast("string")))).alias("outl"))
    return fit.join(out, uid, "left").withColumn("outl", F.coalesce("outl", F.lit("")))


def all_time_stats(dist: DataFrame, initial_year: int, uid: str = "uid") -> DataFrame:
    """valid_obs, valid_span (years between first and last, both counted), sce (largest less smallest distance), nsm (last
    less that of the initial year, or of the first year there is), max_year, min_year. Nulls do not count; ties take the earlier year."""
    d = dist.where("dist is not null")
    first = F.coalesce(F.max(F.when(F.col("year") == initial_year, F.col("dist"))), F.min_by("dist", "year"))
    return d.groupBy(uid).agg(
        F.count("*").alias("valid_obs"), (F.max("year") - F.min("year") + 1).alias("valid_span"), (F.max("dist") - F.min("dist")).alias("sce"),
        (F.max_by("dist", "year") - first).alias("nsm"), F.max_by("year", F.struct("dist", -F.col("year"))).alias("max_year"), F.min_by("year", F.struct("dist", "year")).alias("min_year"),
    )


def certainty(rate: Column, angle_std: Column, valid_obs: Column, least: int) -> Column:
    """The last rule that holds wins: extreme rate, then spread of angles, then too few years."""
    return F.when(valid_obs < least, "insufficient observations").when(angle_std > 30, "high angular variability").when(F.abs(rate) > 200, "extreme value (> 200 m)").otherwise("good")


def angle_spread(angles: DataFrame, uid: str = "uid") -> DataFrame:
    """(uid, angle_std): the circular standard deviation of directions in degrees."""
    r = F.least(F.sqrt(F.pow(F.avg(F.cos(F.radians("angle"))), 2) + F.pow(F.avg(F.sin(F.radians("angle"))), 2)), F.lit(1.0))
    return angles.groupBy(uid).agg(F.degrees(F.sqrt(-2 * F.log(r))).alias("angle_std"))


def axis_spread(angles: DataFrame, uid: str = "uid") -> DataFrame:
    """(uid, angle_std): angle_spread of directions in which forth and back are the same."""
    both = angle_spread(angles.select(uid, (F.col("angle") * 2).alias("angle")), uid)
    return both.select(uid, (F.col("angle_std") / 2).alias("angle_std"))


def sampled_along(lines: DataFrame, keys: list[str], cells: DataFrame, value: str, steps: int, res: float = 1.0, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """(keys, k, value, diff): a raster's value at ``steps`` + 1 places along each straight line (ax, ay, bx, by), from the
    nearest cell (cx, cy), and the difference from the place before; null where there is no cell."""
    from strandline.operators.spatial import nearest_cell

    k = F.explode(F.sequence(F.lit(0), F.lit(steps)))
    at = lambda a, b: F.col(a) + (F.col(b) - F.col(a)) * F.col("k") / steps
    places = lines.select(*keys, "ax", "ay", "bx", "by", k.alias("k")).select(*keys, "k", at("ax", "bx").alias("x"), at("ay", "by").alias("y"))
    seen = nearest_cell(places, cells.select("cx", "cy", value), res, x0, y0)
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy("k"))
    return seen.withColumn("diff", F.col(value) - before).select(*keys, "k", value, "diff")


def length_by_year(lines: DataFrame, years: int, year: str = "year") -> DataFrame:
    """(year, km, km_a_year): the length of each year's lines in kilometres, and as a share of a number of years."""
    km = F.sum(g.length(F.col("vertices"))) / 1000
    return lines.groupBy(year).agg(km.alias("km"), (km / years).alias("km_a_year"))


def signed_differences(transects: DataFrame) -> DataFrame:
    """Adds ``direction`` (1 where the sampled value falls along the line from v0 to v1, else -1) and ``diff``."""
    direction = F.when(F.col("v1") - F.col("v0") < 0, 1).otherwise(-1)
    return transects.withColumns({"direction": direction, "diff": direction * F.col("length")})
