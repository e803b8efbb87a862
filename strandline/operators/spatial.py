"""Spatial joins as equi-joins on square buckets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions import geometry as g


def within(centres: DataFrame, points: DataFrame, radius: float, centre: list[str]) -> DataFrame:
    """The points strictly within a radius of each centre (exact circles): centre's columns, then the point's.

    A centre looks in the 3 x 3 buckets of side ``radius`` around it, so a pair meets at most once and no pair is farther
    than 2.9 radii apart. Dense places are dealt over tasks by adaptive skew handling, as both sides are plain shuffles.
    """
    near = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(j).alias("j")) for i in (-1, 0, 1) for j in (-1, 0, 1)])
    c = centres.select(*centre, F.col("x").alias("_cx"), F.col("y").alias("_cy"), F.explode(near).alias("_o"))
    c = c.withColumns({"_i": F.floor(F.col("_cx") / radius) + F.col("_o.i"), "_j": F.floor(F.col("_cy") / radius) + F.col("_o.j")}).drop("_o")
    p = points.withColumns({"_i": F.floor(F.col("x") / radius), "_j": F.floor(F.col("y") / radius)})
    dx, dy = F.col("x") - F.col("_cx"), F.col("y") - F.col("_cy")
    return c.join(p, ["_i", "_j"]).where(dx * dx + dy * dy < radius * radius).drop("_i", "_j", "_cx", "_cy")


def nearest_cell(points: DataFrame, cells: DataFrame, res: float, x0: float = 0.0, y0: float = 0.0) -> DataFrame:
    """Points with the values of the raster cell (cx, cy) whose centre is nearest."""
    placed = points.withColumns({"cx": F.round((F.col("x") - x0) / res).cast("long"), "cy": F.round((F.col("y") - y0) / res).cast("long")})
    return placed.join(cells, ["cx", "cy"], "left")


def box_overlay(a: DataFrame, b: DataFrame, side: float) -> DataFrame:
    """Pairs of boxes that share an area, with their common box (minx, miny, maxx, maxy). Columns of b but its bounds must
    differ from a's.

    Boxes stand in every bucket they touch; a pair is kept only in the bucket of its common box's lower left corner, so it
    comes out once.
    """
    names = ("minx", "miny", "maxx", "maxy")

    def dealt(df: DataFrame, prefix: str) -> DataFrame:
        df = df.withColumnsRenamed({n: prefix + n for n in names})
        span = lambda lo, hi: F.sequence(F.floor(F.col(prefix + lo) / side), F.floor(F.col(prefix + hi) / side))
        return df.withColumn("_i", F.explode(span("minx", "maxx"))).withColumn("_j", F.explode(span("miny", "maxy")))

    met = dealt(a, "_a_").join(dealt(b, "_b_"), ["_i", "_j"])
    box = {"minx": F.greatest("_a_minx", "_b_minx"), "miny": F.greatest("_a_miny", "_b_miny"), "maxx": F.least("_a_maxx", "_b_maxx"), "maxy": F.least("_a_maxy", "_b_maxy")}
    met = met.withColumns(box).where("minx < maxx and miny < maxy")
    own = (F.col("_i") == F.floor(F.col("minx") / side)) & (F.col("_j") == F.floor(F.col("miny") / side))
    return met.where(own).drop("_i", "_j", *[f"_{s}_{n}" for s in "ab" for n in names])


def box_area() -> Column:
    return (F.col("maxx") - F.col("minx")) * (F.col("maxy") - F.col("miny"))


def largest_overlap(pairs: DataFrame, keys: list[str], tie: str) -> DataFrame:
    """Of each key the pair with the largest common box; equal areas take the smaller ``tie``."""
    by = Window.partitionBy(*keys).orderBy(box_area().desc(), tie)
    return pairs.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")


def with_region(points: DataFrame, regions: DataFrame, attribute: str, side: float = 1.0) -> DataFrame:
    """Points with the attribute of the region (a closed ring of vertices) they are in, null in none; the smallest of several.

    Regions meet points by square buckets of their bounding boxes, and only then are the rings tested. ``side`` should be near
    the regions' size: a region stands in every bucket that its box touches. Equal points stay as many as they are.
    """
    b = regions.withColumn("_b", g.bounds(F.col("ring")))
    span = lambda lo, hi: F.sequence(F.floor(F.col(f"_b.{lo}") / side), F.floor(F.col(f"_b.{hi}") / side))
    dealt = b.withColumn("_i", F.explode(span("minx", "maxx"))).withColumn("_j", F.explode(span("miny", "maxy"))).select("_i", "_j", attribute, "ring")
    # the points of a bucket and its regions: a point's regions are gathered beside it, so no point is merged or counted twice
    held = dealt.groupBy("_i", "_j").agg(F.collect_list(F.struct(attribute, "ring")).alias("_r"))
    placed = points.withColumns({"_i": F.floor(F.col("x") / side), "_j": F.floor(F.col("y") / side)})
    found = F.array_min(F.transform(F.filter("_r", lambda r: g.inside(F.col("x"), F.col("y"), r.ring)), lambda r: r[attribute]))
    return placed.join(held, ["_i", "_j"], "left").select(*points.columns, found.alias(attribute))


def nearest_pairs(a: DataFrame, b: DataFrame, keys: list[str]) -> DataFrame:
    """Of each key the closest pair of a point of a and one of b (ids ``i`` and ``j``), first by i and j among equals.

    The pairs of one key only are compared: a transect has a handful of crossings.
    """
    met = a.select(*keys, "i", F.col("x").alias("ax"), F.col("y").alias("ay")).join(b.select(*keys, "j", F.col("x").alias("bx"), F.col("y").alias("by")), keys)
    d = g.distance(F.col("ax"), F.col("ay"), F.col("bx"), F.col("by"))
    best = met.withColumn("length", d).groupBy(*keys).agg(F.min(F.struct("length", "i", "j", "ax", "ay", "bx", "by")).alias("p"))
    return best.select(*keys, "p.*")


def total_bounds(points: DataFrame) -> DataFrame:
    """(minx, miny, maxx, maxy) of all points."""
    return points.agg(F.min("x").alias("minx"), F.min("y").alias("miny"), F.max("x").alias("maxx"), F.max("y").alias("maxy"))


def non_empty(lines: DataFrame, geometry: str = "vertices") -> DataFrame:
    """Rows whose line has a vertex."""
    return lines.where(F.size(F.coalesce(F.col(geometry), F.array())) > 0)


def dissolved(parts: DataFrame, keys: list[str], order: list[str], geometry: str = "rings") -> DataFrame:
    """One row a key: all rings of its parts as one geometry, in order, and the first part's other columns."""
    others = [c for c in parts.columns if c not in (*keys, geometry)]
    first = F.min_by(F.struct(*others), F.struct(*order)).alias("_first")
    rings = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct(*[F.col(o).alias(f"_{i}") for i, o in enumerate(order)], F.col(geometry).alias("g")))), lambda p: p.g)).alias(geometry)
    return parts.groupBy(*keys).agg(first, rings).select(*keys, "_first.*", geometry)


def zone_at(points: DataFrame, zones: DataFrame, side: float, name: str = "zone") -> DataFrame:
    """Points with the time zone whose ring they are in; at sea, that of their longitude (x), as "Etc/GMT-n"."""
    hours = F.round(F.col("x") / 15).cast("int")
    at_sea = F.concat(F.lit("Etc/GMT"), F.when(hours > 0, F.concat(F.lit("-"), hours)).when(hours < 0, F.concat(F.lit("+"), -hours)).otherwise(""))
    return with_region(points, zones, name, side).withColumn(name, F.coalesce(F.col(name), at_sea))


def first_of(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The first row of each key in a total order."""
    by = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_n", F.row_number().over(by)).where("_n = 1").drop("_n")
