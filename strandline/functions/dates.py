"""Years, periods and times."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def composite_label(year: Column, length: int) -> Column:
    """The label of a composite of an odd number of years around a year: "Y", or "first/last"."""
    if length % 2 == 0 or length < 1:
        raise ValueError("composites span an odd number of years")
    half = length // 2
    return year.cast("string") if length == 1 else F.concat_ws("/", (year - half).cast("string"), (year + half).cast("string"))


def composite_periods(years: DataFrame, lengths: tuple[int, ...] = (1, 3), year: str = "year") -> DataFrame:
    """(year, period_len, period): every year with each composite length, lengths in the order given."""
    made = [F.struct(F.lit(n).alias("period_len"), composite_label(F.col(year), n).alias("period")) for n in lengths]
    return years.select(F.col(year).alias("year"), F.explode(F.array(*made)).alias("p")).select("year", "p.*")


def middle_year(period: Column) -> Column:
    """The middle of "Y" or "first/last", rounded down."""
    years = F.transform(F.split(period, "/"), lambda y: y.cast("int"))
    return F.floor((F.element_at(years, 1) + F.element_at(years, -1)) / 2).cast("int")


def years_of_range(text: Column) -> Column:
    """All years of "first/last" or "first_last", ends included; of a single year that year."""
    years = F.transform(F.split(text, "[/_]"), lambda y: y.cast("int"))
    return F.sequence(F.element_at(years, 1), F.element_at(years, -1))


def spread_over_composites(obs: DataFrame, length: int, first: int, last: int, year: str = "year") -> DataFrame:
    """Every observation once for each composite (``period_year``, its middle) between first and last that it belongs to."""
    half = length // 2
    if half == 0:
        return obs.withColumn("period_year", F.col(year)).where(F.col(year).between(first, last))
    return obs.withColumn("period_year", F.explode(F.sequence(F.col(year) - half, F.col(year) + half))).where(F.col("period_year").between(first, last))


def parsed(text: Column) -> Column:
    """A UTC time written with or without fractional seconds; null if it is neither."""
    forms = ("yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return F.coalesce(*[F.try_to_timestamp(text, F.lit(f)) for f in forms])


def day_of(ts: Column) -> Column:
    return F.date_trunc("day", ts)


def utc_of_local(day: Column, clock: str, zone: Column) -> Column:
    """The UTC time of a clock reading (HH:MM) on a day in a time zone."""
    local = F.to_timestamp_ntz(F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit(f" {clock}:00")))
    return F.convert_timezone(zone, F.lit("UTC"), local)


def every(first: str, last: str, days: int) -> Column:
    """Dates from first to last, ``days`` apart, as an array."""
    return F.expr(f"sequence(date'{first}', date'{last}', interval {days} days)")
