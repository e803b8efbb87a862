"""The three stages as a user runs them, and the task list: mosaics from scenes, shorelines from mosaics, the continental summary.

All tiles and periods of a stage run as one plan. ``python -m strandline STAGE ...`` runs them on stored tables.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strandline.functions import dates
from strandline.functions import geometry as g
from strandline.functions.indices import BANDS, quantize, unscale, with_indices
from strandline.functions.stats import significance
from strandline.operators import continental, contours, morphology, movement, side, stack, tides
from strandline.operators.mosaic import composite, masked_daily
from strandline.settings import settings
from strandline.sources import sinks, tables

KEYS = ["tile_id", "x", "y"]
#: Of the tile stage and of the continental one: the fewest years of a good trend.
TILE_YEARS, CONTINENT_YEARS = 15, 18
RADII = (15_000.0, 5_000.0, 1_000.0)
#: Side of the buckets in which points meet territories, in metres.
REGION_SIDE = 100_000.0


def _of_length(n: int):  # noqa: ANN202
    return lambda year: F.struct(F.lit(n).alias("period_len"), year.alias("year"))


def mosaics(obs: DataFrame, order: list[str], first: int, last: int, lengths: tuple[int, ...] = (1, 3), tide: DataFrame | None = None, cell: list[str] | None = None) -> DataFrame:
    """(tile_id, x, y, year, period_len, bands, spreads, count), stored form: composites of every length and year.

    ``obs`` has tile_id, x, y, ts, cloudy and the bands; ``tide`` (cell, ts, height) filters them if it is given. A composite at
    an end of the span holds the years there are.
    """
    bands = list(BANDS)
    if tide is not None:
        obs = tides.tide_filter(obs, tide, cell, bands)
    daily = masked_daily(obs, KEYS, bands, order).withColumn("year", F.year("day"))
    # a day belongs to a composite of each length and year around it: one explode and one aggregation for all lengths
    spans = [F.transform(F.sequence(F.col("year") - n // 2, F.col("year") + n // 2), _of_length(n)) for n in lengths]
    spread = daily.withColumn("_p", F.explode(F.flatten(F.array(*spans)))).drop("year").select("*", "_p.period_len", "_p.year").drop("_p").where(F.col("year").between(first, last))
    return quantize(composite(spread, [*KEYS, "year", "period_len"], bands), [*KEYS, "year", "period_len"])


class Shores(NamedTuple):
    raster: DataFrame  # tile_id, x, y, year, index
    lines: DataFrame  # tile_id, year, part, vertices, certainty
    points: DataFrame  # uid, x, y, trend and statistics
    distances: DataFrame  # uid, year, dist


class NoShoreline(ValueError):
    """A tile has no contour in any year."""


def shoreline_index(grid: DataFrame, index: str = "twndwi", land: DataFrame | None = None, radius: int = 60, expansions: int = 64) -> DataFrame:
    """(tile_id, x, y, year, index): the smoothed yearly index where a shoreline can be: in the zone of analysis around land, and
    off inland water; null elsewhere. ``grid`` has all four indices of the filled stack.

    ``land`` (tile_id, x, y, mapped, added; see morphology.land_masks) is what maps know. Core land is the mapped land without
    its margin, and added land. Consensus land has medians of ndwi, mndwi and nirwi below 0 over all years, or is core land.
    Land of a year is core land and what is connected to consensus land; the zone grows from it over land next to it. The
    ocean is what neither consensus nor map calls land; water that is not connected to it goes.
    """
    keys, cell = [*KEYS, "year"], ("tile_id", "x", "y")
    finite = F.when(~F.isnan(index) & (F.abs(F.col(index)) < float("inf")), F.col(index))
    smooth = morphology.smooth(grid, ["tile_id", "year"], [index]).withColumn(index, finite).checkpoint()
    cells = grid.select(*KEYS).distinct()
    known = land if land is not None else morphology.land_masks(cells)
    core = morphology.core_land(cells.join(known, KEYS), ["tile_id"], radius).checkpoint()
    consensus = morphology.consensus_land(grid, KEYS).where("land").select(*KEYS).unionByName(core.select(*KEYS)).distinct().checkpoint()
    years = F.broadcast(grid.select("year").distinct())  # a handful
    candidate = smooth.where(F.col(index) < 0).select(*keys)
    connected = morphology.connected_to(consensus.join(years, how="cross"), candidate, ["tile_id", "year"])
    annual_land = core.select(*KEYS).join(years, how="cross").select(*keys).unionByName(connected.select(*keys)).distinct()
    zone = morphology.analysis_zone(annual_land, smooth, ["tile_id", "year"], index, expansions)
    zoned = morphology.with_masks(smooth, [index], keep=zone, cell=(*cell, "year")).checkpoint()
    ocean = cells.join(consensus, KEYS, "left_anti").join(known.where("mapped").select(*KEYS), KEYS, "left_anti")
    inland = morphology.inland_water(ocean, zoned, ["tile_id", "year"], index, cell=cell)
    return morphology.with_masks(zoned, [index], drop=inland, cell=(*cell, "year"))


def shores(stored: DataFrame, res: float = 30.0, spacing: float = 30.0, most: float = 5_000.0, index: str = "twndwi", model=None, first_year: int = 1999, regions: DataFrame | None = None, expansions: int = 64, land: DataFrame | None = None, margin: int = 60) -> Shores:  # noqa: ANN001
    """Masked, filled and smoothed yearly grids; their zero contours; points along the last year's contour with their yearly
    distances, trends and certainty. ``model`` masks clouds; without one nothing is masked but what has few observations.
    ``land`` is what maps know (morphology.land_masks). Raises NoShoreline if no year has a contour.
    """
    keys = [*KEYS, "year"]
    all_lengths = with_indices(unscale(stored, [*keys, "period_len"]))
    values = [*BANDS, "mndwi", "ndwi", "nirwi", "twndwi", "twndwi_mad"]
    parts = [all_lengths.where(F.col("period_len") == n).drop("period_len") for n in (1, 3)]
    if model is not None:
        parts = [side.predict_forest(model, p) for p in parts]
        whole = stack.masked_with_fallback(parts, keys, values, side.code_for_name("cloud"))
    else:
        whole = stack.with_fallback(parts[0], parts[1:], keys, values)
    # what is used more than once is checkpointed: it is worked out once, plans stay small, and it survives lost executors
    grid = stack.fill_gaps(whole, KEYS, values).select(*keys, "twndwi", "mndwi", "ndwi", "nirwi", "twndwi_mad", "count").checkpoint()
    raster = shoreline_index(grid, index, land, margin, expansions)
    cells = contours.contour_lines(raster.select("tile_id", "year", "x", "y", index), ["tile_id", "year"], index)
    cells = contours.line_certainty(cells, contours.pixel_certainty(grid), ["tile_id", "year"])
    metres = F.transform("vertices", lambda p: F.struct((p.x * res).alias("x"), (p.y * res).alias("y")))
    lines = cells.withColumn("vertices", metres).checkpoint()
    if lines.isEmpty():
        raise NoShoreline("no shoreline in any year; the index may be empty")
    vertices = lines.select("tile_id", "year", "part", F.posexplode("vertices").alias("seq", "p")).select("tile_id", "year", "part", "seq", "p.x", "p.y")
    base = movement.points_along(movement.latest(vertices), ["tile_id", "part"], spacing)
    uid = g.geohash(g.to_latitude(F.col("y")), g.to_longitude(F.col("x")), 10)
    points = base.select("tile_id", uid.alias("uid"), "x", "y").dropDuplicates(["uid"]).checkpoint()
    sampled = grid.select("tile_id", "year", F.col("x").alias("cx"), F.col("y").alias("cy"), (F.col(index) >= 0).alias("wet"))
    at = points.select("tile_id", "uid", F.round(F.col("x") / res).cast("int").alias("cx"), F.round(F.col("y") / res).cast("int").alias("cy"))
    along = movement.line_segments(vertices, ["tile_id", "year", "part"])
    dist = movement.annual_movements(points, along, most=most, sign=at.join(sampled, ["tile_id", "cx", "cy"])).checkpoint()
    trends = movement.robust_regressions(dist).withColumnsRenamed({"rate": "rate_time", "incpt": "incpt_time", "se": "se_time", "outl": "outl_time"})
    trends = trends.withColumn("sig_time", significance(F.col("rate_time"), F.col("se_time"), F.col("n_reg")))
    known = points.join(trends, "uid").join(movement.all_time_stats(dist, first_year), "uid").join(movement.axis_spread(dist), "uid", "left")
    known = known.withColumn("certainty", movement.certainty(F.col("rate_time"), F.col("angle_std"), F.col("valid_obs"), TILE_YEARS))
    if regions is not None:
        from strandline.operators.spatial import with_region

        known = with_region(known, regions, "eez_territory", REGION_SIDE)
    return Shores(raster, lines, known.checkpoint(), dist.select("uid", "year", "dist"))


class Continent(NamedTuple):
    shorelines: DataFrame
    points: DataFrame
    hotspots: list[DataFrame]


def continent(tiles: list[Shores], north: float | None = None, radii: tuple[float, ...] = RADII, first_year: int = 1999) -> Continent:
    """The tiles' layers in one, statistics made anew, service columns, and hotspots of every radius."""
    lines, points, dist = (continental.merged([getattr(t, n) for t in tiles]) for n in ("lines", "points", "distances"))
    stats = movement.all_time_stats(dist, first_year)
    points = points.drop("valid_obs", "valid_span", "sce", "nsm", "max_year", "min_year").join(stats, "uid")
    if "angle_std" not in points.columns:
        points = points.withColumn("angle_std", F.lit(None).cast("double"))
    points = points.withColumn("certainty", movement.certainty(F.col("rate_time"), F.col("angle_std"), F.col("valid_obs"), CONTINENT_YEARS))
    if north is not None:
        lines, points = continental.lines_south_of(lines, north), continental.south_of(points, north)
    points = continental.wms_fields(points, "rate_time", "se_time", "sig_time").checkpoint()
    vertices = lines.select("tile_id", "year", "part", F.posexplode("vertices").alias("seq", "p")).select("tile_id", "year", "part", "seq", "p.x", "p.y")
    newest = movement.latest(vertices)
    spots = []
    for radius in radii:
        along = movement.points_along(newest, ["tile_id", "part"], float(int(radius / 2)))
        centres = along.select(g.geohash(g.to_latitude(F.col("y")), g.to_longitude(F.col("x")), 11).alias("cid"), "x", "y").dropDuplicates(["cid"])
        found, _ = continental.hotspots(centres, points, dist, radius)
        spots.append(continental.wms_fields(found.withColumn("sig", significance(F.col("rate"), F.col("se"), F.col("n_reg")))))
    return Continent(lines.orderBy("year"), points, spots)


def stored_shores(spark: SparkSession, path: str) -> Shores:
    """A tile's products as main() wrote them."""
    lines = spark.read.parquet(f"{path}/shorelines_annual")
    if "tile_id" not in lines.columns:
        lines = lines.withColumn("tile_id", F.lit(path.rstrip("/").rsplit("/", 1)[-1]))
    if "part" not in lines.columns:
        lines = lines.withColumn("part", F.xxhash64("year", "vertices"))
    return Shores(spark.read.parquet(f"{path}/raster"), lines, spark.read.parquet(f"{path}/rates_of_change"), spark.read.parquet(f"{path}/distances"))


def main(spark: SparkSession, args: list[str]) -> None:
    """mosaics OBS OUT FIRST LAST | shores MOSAICS OUT | continent OUT TILE... | tasks GRID DATETIMES [LOG]"""
    match args:
        case ["mosaics", source, out, first, last]:
            obs = spark.read.parquet(source)
            sinks.write_mosaic(mosaics(obs, ["ts", *sorted(c for c in obs.columns if c != "ts")], int(first), int(last)), out)
        case ["shores", source, out]:
            made = shores(tables.mosaics(spark, source))
            sinks.write_shore(out, made.raster, made.lines, made.points)
            made.distances.write.mode("overwrite").parquet(f"{out}/distances")
        case ["continent", out, *tiles]:
            made = continent([stored_shores(spark, t) for t in tiles], continental.NORTH, settings().hotspot_radii)
            made.shorelines.write.mode("overwrite").parquet(f"{out}/shorelines_annual")
            made.points.write.mode("overwrite").parquet(f"{out}/rates_of_change")
            for i, spots in enumerate(made.hotspots, 1):
                spots.write.mode("overwrite").parquet(f"{out}/hotspots_zoom_{i}")
            sinks.write_tiles(made.points, made.shorelines, made.hotspots, f"{out}/tiles")
        case ["tasks", grid, periods, *log]:
            done = None
            if log:
                parts = F.split("index", ",")
                done = tables.log(spark, log[0]).select(parts[0].cast("int").alias("column"), parts[1].cast("int").alias("row"), F.lit(periods.split(",")[0]).alias("datetime"), "status")
            print(side.as_json_list(side.task_list(spark.read.parquet(grid), periods.split(","), done), ["column", "row", "datetime"]).first()[0])
        case _:
            raise SystemExit(main.__doc__)
