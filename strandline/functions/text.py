"""Names and ids."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def tile_id(column: Column, row: Column) -> Column:
    """Column and row, three digits each."""
    return F.concat(F.lpad(column.cast("string"), 3, "0"), F.lpad(row.cast("string"), 3, "0"))


def pair_id(column: Column, row: Column) -> Column:
    return F.concat_ws(",", column.cast("string"), row.cast("string"))


def path_safe(period: Column) -> Column:
    return F.replace(period, F.lit("/"), F.lit("_"))


def without_stage(name: Column) -> Column:
    """A version name without the suffix of its processing stage."""
    return F.regexp_replace(name, "_interim|_raw|_processed", "")


def mgrs_code(tile: Column) -> Column:
    """The catalogue's grid code of a tile name, which has no leading zeros."""
    return F.concat(F.lit("MGRS-"), F.ltrim(tile, F.lit("0")))


def columns_matching(columns: list[str], pattern: str) -> list[str]:
    """The columns whose name has a match of a pattern, in order."""
    return [c for c in columns if re.search(pattern, c)]
