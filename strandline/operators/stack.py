"""The yearly stack: fallback composites, model masks and gaps filled from neighbouring years."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def mask_predicted(stack: DataFrame, values: list[str], prediction: str = "prediction", cloud: int = 1) -> DataFrame:
    """Values are null where the model says cloud; a missing prediction hides them too, as its comparison is not true."""
    return stack.withColumns({v: F.when(F.col(prediction) != cloud, F.col(v)) for v in values})


def with_fallback(short: DataFrame, longer: list[DataFrame], keys: list[str], values: list[str], low: int = 4) -> DataFrame:
    """Each value of the shortest composite, replaced by that of the next longer one where it is null or the count is low.

    The count is always the shortest composite's own. Longer composites may lack a key or hold null: the value is then null.
    """
    out = short
    for k, other in enumerate(longer):
        names = {v: f"_{k}_{v}" for v in values}
        out = out.join(other.select(*keys, *[F.col(v).alias(n) for v, n in names.items()]), keys, "left")
        out = out.withColumns({v: F.when(F.col(v).isNull() | (F.col("count") <= low), F.col(n)).otherwise(F.col(v)) for v, n in names.items()}).drop(*names.values())
    return out


def masked_with_fallback(composites: list[DataFrame], keys: list[str], values: list[str], cloud: int = 1, low: int = 4) -> DataFrame:
    """Composites from the shortest to the longest, each with its own prediction: clouds are masked in every one of them before
    the longer ones stand in, so a value that is cloudy in all is null. ``count`` is masked like the values."""
    masked = [mask_predicted(c, [*values, "count"], cloud=cloud) for c in composites]
    return with_fallback(masked[0], masked[1:], keys, values, low)


def fill_gaps(stack: DataFrame, keys: list[str], values: list[str], year: str = "year") -> DataFrame:
    """Nulls take the next year's value, or else what the year before has after it was filled; only along unbroken runs of
    years. So a value is carried on without limit, but not back by more than one year. One sort serves all values."""
    by_year = Window.partitionBy(*keys).orderBy(year)
    runs = stack.withColumn("_run", F.col(year) - F.row_number().over(by_year))
    run = Window.partitionBy(*keys, "_run").orderBy(year)
    near = runs.withColumns({f"_c_{v}": F.coalesce(F.col(v), F.lead(v).over(run)) for v in values})
    so_far = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return near.withColumns({v: F.last(f"_c_{v}", ignorenulls=True).over(so_far) for v in values}).drop("_run", *[f"_c_{v}" for v in values])


def years_as_columns(df: DataFrame, keys: list[str], value: str, years: list[int], prefix: str = "") -> DataFrame:
    """One column a year, for sinks that want years as bands."""
    made = [F.max(F.when(F.col("year") == y, F.col(value))).alias(f"{prefix}{y}") for y in years]
    return df.groupBy(*keys).agg(*made)


def columns_as_years(df: DataFrame, keys: list[str], prefix: str = "dist_") -> DataFrame:
    """(keys, year, dist): a row for each prefixed year column."""
    names = [c for c in df.columns if c.startswith(prefix)]
    long = df.unpivot(keys, names, "_name", "dist")
    return long.select(*keys, F.replace("_name", F.lit(prefix), F.lit("")).cast("int").alias("year"), "dist")
