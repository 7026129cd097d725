"""Column expressions shared by the jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The macro-region of each of the 27 federal units.
MACRO_REGIONS = {
    "Norte": ["AC", "AM", "AP", "PA", "RO", "RR", "TO"],
    "Nordeste": ["AL", "BA", "CE", "MA", "PB", "PE", "PI", "RN", "SE"],
    "Centro-Oeste": ["DF", "GO", "MS", "MT"],
    "Sudeste": ["ES", "MG", "RJ", "SP"],
    "Sul": ["PR", "RS", "SC"],
}


def round_half_even(x: Column, digits: int) -> Column:
    """Scale, round to the nearest integer (ties to even) and scale back.

    ``round`` of Spark works on the decimal text of the double (1.005 -> 1.01); dataframe libraries
    on arrays work on the binary value (1.005 -> 1.0). Reported figures follow the latter.
    """
    factor = F.lit(float(10**digits))
    return F.rint(x * factor) / factor


def pad_code(code: Column, width: int = 7) -> Column:
    """Zero-pad a code on the left and never cut a longer one."""
    return F.when(F.length(code) < width, F.lpad(code, width, "0")).otherwise(code)


def year_number(year: Column) -> Column:
    """A partition year that may arrive as text; null where it is no number."""
    return year.try_cast("int")


def is_yes(flag: Column, yes: str = "1") -> Column:
    """0/1 flag of a text label. A null label counts as 0."""
    return F.coalesce(flag == yes, F.lit(False)).cast("int")


def per_head(total: Column, heads: Column) -> Column:
    """Quotient that is null, not an error, when the divisor is zero."""
    return F.try_divide(total, heads)


def nan_to_null(x: Column) -> Column:
    return F.when(~F.isnan(x), x)


def seeded_hash(seed: int, *keys: str) -> Column:
    """A reproducible pseudo-random order of rows: equal on every engine and every run."""
    return F.md5(F.concat_ws("|", F.lit(str(seed)), *[F.col(k).cast("string") for k in keys]))


def macro_region(region1: Column) -> Column:
    """Macro-region of a federal unit; null for a code that is not in the fixed list."""
    pairs = [F.lit(v) for region, codes in MACRO_REGIONS.items() for c in codes for v in (c, region)]
    return F.try_element_at(F.create_map(*pairs), region1)


def lerp(low: Column, high: Column, share: Column) -> Column:
    """Linear interpolation that starts from the nearer end, as array libraries do."""
    gap = high - low
    return F.when(share >= 0.5, high - gap * (1 - share)).otherwise(low + gap * share)


def weighted_mean(x: str, weight: str) -> Column:
    """Weighted mean; null when all weights are zero."""
    return F.try_divide(F.sum(F.col(weight) * F.col(x)), F.sum(weight))


def correlation(x: str, y: str) -> Column:
    """Pearson correlation over the rows where both are known; null, not an error, for a constant."""
    spread = [F.stddev_pop(F.when(F.col(b).isNotNull(), F.col(a))) for a, b in ((x, y), (y, x))]
    return F.try_divide(F.covar_pop(x, y), spread[0] * spread[1])


def unpivot(df: DataFrame, columns: list[str], name: str, value: str, keep: list[str], cast: str) -> DataFrame:
    """One row per (row, column): the columns' names in ``name``, their values in ``value``."""
    return df.select(*keep, *[F.col(c).cast(cast).alias(c) for c in columns]).unpivot(keep, columns, name, value)
