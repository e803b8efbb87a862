"""Water indices and the storage form of bands, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Near-infrared cutoff of reflectances, factor and nodata value of stored bands.
NIR_CUTOFF, SCALE, NODATA = 0.128, 10_000, -32_767
BANDS = ("blue", "green", "red", "nir08", "swir16", "swir22")
INDICES = ("mndwi", "ndwi", "nirwi", "twndwi")


def normalized_ratio(a: Column, b: Column) -> Column:
    """(a - b) / (a + b); null where the sum is zero."""
    return F.try_divide(a - b, a + b)


def mndwi(green: Column, swir16: Column) -> Column:
    return normalized_ratio(green, swir16)


def ndwi(green: Column, nir08: Column) -> Column:
    return normalized_ratio(green, nir08)


def nirwi(nir08: Column, cutoff: float = NIR_CUTOFF) -> Column:
    return normalized_ratio(F.lit(cutoff), nir08)


def twndwi(green: Column, nir08: Column, swir16: Column, alpha: float = 0.5, cutoff: float = NIR_CUTOFF) -> Column:
    """A blend of mndwi and an ndwi whose green is kept only over bright near infrared, and else is the cutoff."""
    adapted = F.when((nir08 >= cutoff) & (green < cutoff), green).otherwise(F.lit(cutoff))
    return (1 - alpha) * mndwi(green, swir16) + alpha * normalized_ratio(adapted, nir08)


def cutoff_for(scaled: bool) -> float:
    """The near-infrared cutoff for reflectances (scaled) or for stored numbers."""
    return NIR_CUTOFF if scaled else NIR_CUTOFF * SCALE


def with_indices(df: DataFrame, cutoff: float = NIR_CUTOFF) -> DataFrame:
    """All four indices from the bands, in place of any that are there."""
    green, nir, swir = F.col("green"), F.col("nir08"), F.col("swir16")
    return df.withColumns({"mndwi": mndwi(green, swir), "ndwi": ndwi(green, nir), "nirwi": nirwi(nir, cutoff), "twndwi": twndwi(green, nir, swir, cutoff=cutoff)})


def is_stored_plain(name: str) -> bool:
    """Columns that are not quantized: spreads and counts."""
    return name.endswith(("stdev", "mad")) or name == "count"


def quantized(value: Column) -> Column:
    """value x 10,000 as a 16-bit number, rounded half away from zero; null and what does not fit are nodata."""
    scaled = F.round(value * SCALE)
    return F.when(scaled.between(NODATA + 1, 32_767), scaled).otherwise(F.lit(NODATA)).cast("short")


def unscaled(value: Column) -> Column:
    """The stored number as a real one; nodata is null."""
    return F.when(value != NODATA, value / SCALE)


def quantize(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c) if is_stored_plain(c) else quantized(F.col(c)).alias(c) for c in df.columns if c not in keys])


def unscale(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.select(*keys, *[F.col(c) if is_stored_plain(c) else unscaled(F.col(c)).alias(c) for c in df.columns if c not in keys])


def bit_clear(qa: Column, bits: int) -> Column:
    """Whether none of the mask's bits is set in a quality band."""
    return qa.bitwiseAND(F.lit(bits)) == 0


def finite(value: Column) -> Column:
    """The value, or null where it is NaN or infinite."""
    return F.when(~F.isnan(value) & (F.abs(value) < float("inf")), value)
