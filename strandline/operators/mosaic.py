"""From scenes to composites: cloud masks, one observation a day, and medians with their spreads.

The input is one row a pixel and scene: ``keys`` (a tile and a cell), ``ts``, a boolean ``cloudy`` and the bands.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strandline.functions.dates import day_of
from strandline.functions.indices import NIR_CUTOFF, twndwi


def mask_clouds_by_day(obs: DataFrame, keys: list[str], bands: list[str], cloudy: str = "cloudy", ts: str = "ts") -> DataFrame:
    """Adds ``day`` and ``masked``; bands are null where any scene of the pixel's day is cloudy."""
    same_day = Window.partitionBy(*keys, "day")
    marked = obs.withColumn("day", day_of(F.col(ts))).withColumn("masked", F.max(cloudy).over(same_day))
    return marked.withColumns({b: F.when(~F.col("masked"), F.col(b)) for b in bands})


def daily_first(obs: DataFrame, keys: list[str], bands: list[str], order: list[str]) -> DataFrame:
    """One row a pixel and day: for each band the first value that is not null, by the given total order.

    The order is part of the aggregate, so the result does not depend on how rows arrive.
    """
    first = [F.min_by(b, F.when(F.col(b).isNotNull(), F.struct(*order))).alias(b) for b in bands]
    return obs.groupBy(*keys, "day").agg(*first)


def masked_daily(obs: DataFrame, keys: list[str], bands: list[str], order: list[str], cloudy: str = "cloudy", ts: str = "ts") -> DataFrame:
    """mask_clouds_by_day and daily_first in one sort of the observations.

    Rows are dealt by pixel, so composites of any period need no further shuffle. Within a day they run from the last to the
    first, and the row at the end holds the first value of each band that is not null. A pixel and day has a scene or a few,
    so there is nothing that merging before the shuffle would save.
    """
    back = Window.partitionBy(*keys, "day").orderBy(*[F.desc(o) for o in order])
    so_far = back.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    days = obs.withColumn("day", day_of(F.col(ts))).repartition(*keys)
    seen = days.withColumns({"_more": F.lead(F.lit(True)).over(back), "masked": F.max(cloudy).over(so_far), **{f"_{b}": F.last(b, ignorenulls=True).over(so_far) for b in bands}})
    return seen.where("_more is null").select(*keys, "day", *[F.when(~F.col("masked"), F.col(f"_{b}")).alias(b) for b in bands])


def middle(values: Column) -> Column:
    """The median of a sorted array without nulls; null if it is empty."""
    size = F.size(values)
    low, high = F.floor((size + 1) / 2).cast("int"), F.floor(size / 2).cast("int") + 1
    return F.when(size > 0, (F.element_at(values, low) + F.element_at(values, high)) / 2)


def composite(daily: DataFrame, keys: list[str], bands: list[str], cutoff: float = NIR_CUTOFF) -> DataFrame:
    """Per key the median and the MAD (unscaled) of each band and of twndwi, the count of nir08, and twndwi's population
    standard deviation, all over non-null values.

    A key's values are gathered and sorted once; median and MAD are both read from that array, so there is no second pass
    and no join back. A key holds a pixel's observations of one period: tens to hundreds.
    """
    daily = daily.withColumn("twndwi", twndwi(F.col("green"), F.col("nir08"), F.col("swir16"), cutoff=cutoff))
    names = [*bands, "twndwi"]
    held = daily.groupBy(*keys).agg(
        *[F.sort_array(F.collect_list(b)).alias(b) for b in names],
        F.count("nir08").cast("short").alias("count"),
        F.stddev_pop("twndwi").alias("twndwi_stdev"),
    )
    medians = held.select(*keys, "count", "twndwi_stdev", *[F.col(b).alias(f"_{b}") for b in names], *[middle(F.col(b)).alias(b) for b in names])

    def mad(b: str) -> Column:
        return middle(F.sort_array(F.transform(F.col(f"_{b}"), lambda v: F.abs(v - F.col(b))))).alias(f"{b}_mad")

    mads = [mad(b) for b in names]
    return medians.select(*keys, *names, *mads, "count", "twndwi_stdev")


def clear_reflectance(value: Column, cloud_mask: Column, scene_class: Column, cloudy: tuple[int, ...] = (3, 8, 9, 10)) -> Column:
    """A reflectance where its scene class is no cloud or shadow, a second cloud mask is 0 and the value is not the fill 0."""
    return F.when((cloud_mask == 0) & (value != 0) & ~scene_class.isin(*cloudy), value)


def scaled_by_processor(value: Column, gain: float, offset: float) -> Column:
    """Stored sensor numbers as reflectances."""
    return value * gain + offset


def items_of_years(items: DataFrame, years: list[int], when: str = "datetime") -> DataFrame:
    """Catalogue items whose time, with or without fractional seconds, is in one of the years. Raises if there are none."""
    from strandline.functions.dates import parsed

    found = items.where(F.year(parsed(F.col(when))).isin(years))
    if found.isEmpty():
        raise ValueError(f"no items in {years}")
    return found
