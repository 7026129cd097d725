"""Column contracts: what each table must hold and which columns may become features.

Selection is by allow-list. A column nobody has vetted is reported and left out, so a new
column that carries the outcome of the target year can never slip into a model.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The agreed feature lists.
NUMERIC_FEATURES = [
    "group_rate_prior_year",
    "group_mean_prior_year",
    "group_std_prior_year",
    "group_p25_prior_year",
    "group_p75_prior_year",
    "group_n_prior_year",
    "region_rate_prior_year",
    "region_mean_prior_year",
    "target",
    "region_target",
    "gap_target_start",
    "gap_target_region",
    "gap_target_national",
    "population",
    "gdp",
    "gdp_per_capita",
]
CATEGORICAL_FEATURES = ["network", "region1", "region2", "form"]
NEVER_FEATURES = ["unit_id", "site_id", "group_id", "label", "weight"]
ENRICHMENT_FEATURES = ["population", "gdp", "gdp_per_capita"]

# Numeric features that are known beforehand although their name has no year mark.
AGREED_BEFOREHAND = [
    "target",
    "region_target",
    "gap_target_start",
    "gap_target_region",
    "gap_target_national",
    "population",
    "gdp",
    "gdp_per_capita",
]
PRIOR_YEAR_MARK = "_prior_year"

# Columns of the enrichment table that prove which year each figure belongs to.
PROVENANCE = ["population_year", "gdp_year"]

UNIT_COLUMNS = {
    "unit_id": T.StringType(),
    "site_id": T.StringType(),
    "group_id": T.StringType(),
    "region1": T.StringType(),
    "network": T.StringType(),
    "form": T.StringType(),
    "weight": T.DoubleType(),
    "label": T.StringType(),
    "score_raw": T.DoubleType(),
    "valid": T.BooleanType(),
    "grade": T.StringType(),
    "year": T.IntegerType(),
}


class ContractError(ValueError):
    """A table does not hold what the job needs."""


@dataclass(frozen=True)
class FeatureColumns:
    """The vetted feature columns of a table, and what was turned away."""

    numeric: list[str]
    categorical: list[str]
    dropped: list[str]


def feature_columns(df: DataFrame) -> FeatureColumns:
    """Split the columns of ``df`` into allowed numeric, allowed categorical and dropped ones."""
    types = {f.name: f.dataType for f in df.schema.fields}
    numeric = [c for c in NUMERIC_FEATURES if isinstance(types.get(c), T.NumericType)]
    categorical = [c for c in CATEGORICAL_FEATURES if c in types]
    known = {*numeric, *categorical, *NEVER_FEATURES}
    return FeatureColumns(numeric, categorical, sorted(set(types) - known))


def unproven_features(numeric: list[str]) -> list[str]:
    """Numeric features whose name does not show that they precede the outcome."""
    return [c for c in numeric if not c.endswith(PRIOR_YEAR_MARK) and c not in AGREED_BEFOREHAND]


def require_columns(df: DataFrame, expected: dict[str, T.DataType], table: str) -> DataFrame:
    """Return ``df`` unchanged, or say exactly which columns are missing or of another type."""
    types = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in expected if c not in types]
    wrong = [
        f"{c}: {types[c].simpleString()} instead of {t.simpleString()}"
        for c, t in expected.items()
        if c in types and types[c] != t
    ]
    if missing or wrong:
        raise ContractError(f"{table}: missing {missing}, wrong type {wrong}")
    return df
