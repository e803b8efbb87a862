"""Tides: model evaluation, cutoffs, the tide filter and interpolation from coarse to fine cells."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def cutoffs(tides: DataFrame, cell: list[str], centre: float = 0.0, share: float = 0.25) -> DataFrame:
    """(cell, lo, hi): the middle of each cell's tide range, centre -/+ share x range."""
    spread = (F.max("height") - F.min("height")) * share
    return tides.groupBy(*cell).agg((F.lit(centre) - spread).alias("lo"), (F.lit(centre) + spread).alias("hi"))


def mean_cutoffs(limits: DataFrame, overlaps: DataFrame, area: list[str], image: list[str]) -> DataFrame:
    """(image, lo, hi): the mean limits of all areas that an image overlaps (image, area)."""
    return overlaps.join(limits, area).groupBy(*image).agg(F.avg("lo").alias("lo"), F.avg("hi").alias("hi"))


def useful_times(tides: DataFrame, limits: DataFrame, cell: list[str]) -> DataFrame:
    """(ts): the times at which at least one coarse cell is within its limits. A cheap prune before fine data are touched."""
    return tides.join(limits, cell).where(F.col("height").between(F.col("lo"), F.col("hi"))).select("ts").distinct()


def tide_filter(obs: DataFrame, tides: DataFrame, cell: list[str], bands: list[str], strict: bool = False, centre: float = 0.0) -> DataFrame:
    """Observations at times that the tides have and that are useful; bands are null where the cell's tide is out of range.

    Limits come from the full series. Bounds are inclusive, or strict if asked for. ``obs`` has the columns of ``cell`` and ts.
    """
    limits = cutoffs(tides, cell, centre)
    pruned = obs.join(useful_times(tides, limits, cell), "ts", "left_semi")
    known = tides.join(limits, cell)
    ok = (F.col("height") > F.col("lo")) & (F.col("height") < F.col("hi")) if strict else F.col("height").between(F.col("lo"), F.col("hi"))
    kept = known.select(*cell, "ts", F.coalesce(ok, F.lit(False)).alias("in_range"))
    joined = pruned.join(kept, [*cell, "ts"])
    return joined.withColumns({b: F.when(F.col("in_range"), F.col(b)) for b in bands})


def bilinear(fine: DataFrame, coarse: DataFrame, value: str, x: Column, y: Column, by: list[str]) -> DataFrame:
    """fine with ``value`` interpolated from the four coarse cells (cx, cy, value) around (x, y), in units of coarse cells.

    Null where one of the four is missing, so also outside their hull. ``by`` are further columns that must agree (a time).
    An equi-join on the lower left cell with the coarse table's own squares: coarse cells meet their three neighbours once,
    however many fine cells lie between them.
    """
    corner = lambda dx, dy: coarse.select(*by, (F.col("cx") - dx).alias("cx"), (F.col("cy") - dy).alias("cy"), F.col(value).alias(f"_{dx}{dy}"))
    keys = [*by, "cx", "cy"]
    squares = corner(0, 0).join(corner(1, 0), keys, "left").join(corner(0, 1), keys, "left").join(corner(1, 1), keys, "left")
    placed = fine.withColumns({"_x": x, "_y": y}).withColumns({"cx": F.floor("_x"), "cy": F.floor("_y")})
    u, v = F.col("_x") - F.col("cx"), F.col("_y") - F.col("cy")
    # a place on a cell's centre line needs only the cells of that line
    term = lambda w, c: F.when(w == 0, 0.0).otherwise(w * F.col(c))
    made = term((1 - u) * (1 - v), "_00") + term(u * (1 - v), "_10") + term((1 - u) * v, "_01") + term(u * v, "_11")
    return placed.join(squares, keys, "left").withColumn(value, made).drop("cx", "cy", "_x", "_y", "_00", "_10", "_01", "_11")


#: Speeds in degrees an hour of the main constituents (published values).
SPEEDS = {"m2": 28.984104, "s2": 30.0, "n2": 28.43973, "k2": 30.082137, "k1": 15.041069, "o1": 13.943035, "p1": 14.958931, "q1": 13.398661}


def modelled(places: DataFrame, constituents: DataFrame, times: DataFrame) -> DataFrame:
    """(cx, cy, ts, height): a harmonic sum over each cell's constituents (cx, cy, name, amplitude, phase in degrees)."""
    speed = F.create_map(*[x for n, s in SPEEDS.items() for x in (F.lit(n), F.lit(s))])
    hours = F.unix_timestamp("ts") / 3600.0
    wave = F.col("amplitude") * F.cos((F.element_at(speed, F.col("name")) * hours - F.col("phase")) * (math.pi / 180))
    cells = places.select("cx", "cy").join(constituents, ["cx", "cy"]).groupBy("cx", "cy").agg(F.collect_list(F.struct("name", "amplitude", "phase")).alias("c"))
    # every cell needs every time: that product is the operator's output, not an intermediate
    return cells.crossJoin(times.select("ts")).select("cx", "cy", "ts", F.explode("c").alias("k")).select("cx", "cy", "ts", "k.*").groupBy("cx", "cy", "ts").agg(F.sum(wave).alias("height"))
