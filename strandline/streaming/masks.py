"""A streaming form of the daily cloud mask. Beyond what the batch pipeline needs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def daily_masks(stream: DataFrame, keys: list[str], cloudy: str = "cloudy", ts: str = "ts", late: str = "2 days") -> DataFrame:
    """(keys, day, masked): whether any scene of a day was cloudy, a row when the day can get no more scenes.

    Scenes that come later than the watermark are left out; state is one flag a key and open day.
    """
    day = F.window(ts, "1 day")
    return stream.withWatermark(ts, late).groupBy(*keys, day).agg(F.max(cloudy).alias("masked")).select(*keys, F.col("window.start").alias("day"), "masked")
