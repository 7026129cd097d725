"""The analytical base: one row per individual of the target year with what was known before."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.contracts import ENRICHMENT_FEATURES
from forerate.functions.joins import lookup
from forerate.functions.scalars import is_yes, round_half_even
from forerate.operators.context import (
    UNIT_KEYS,
    audited_enrichment,
    group_context,
    group_targets,
    national_target,
    region_context,
    region_targets,
    table_sizes,
)
from forerate.sources.staging import side_by_side, staged
from forerate.sources.tables import Inputs, unit_rows

CONTEXT_COLUMNS = [
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
]
PASS_THROUGH = ["unit_id", "site_id", "group_id", "region1", "network", "form", "weight"]


def analytical_base(
    inputs: Inputs,
    base_year: int,
    target_year: int,
    whole_network: str,
    grade: str = "2",
    gdp_lag: int = 2,
    null_label: str = "zero",
    extra: list[str] | None = None,
) -> DataFrame:
    """Assemble the base with one pass over each year of the unit table.

    Everything known about a place is first put together in one table per key, so the units are
    joined once per key and not once per source. The size and the uniqueness of those tables are
    checked before they are joined. ``null_label`` says whether a missing label counts as 0
    (``zero``) or the row is left out (``drop``). ``extra`` carries further unit columns through.
    """
    units = unit_rows(inputs.units, target_year, [*PASS_THROUGH, "label", *(extra or [])], grade)
    if null_label == "drop":
        units = units.dropna(subset=["label"])
    context = group_context(inputs.units, inputs.group_indicator, inputs.published, base_year, grade)
    targets = group_targets(inputs.group_indicator, target_year)
    region = region_context(inputs.region_indicator, base_year)
    agreed = region_targets(inputs.region_indicator, target_year, whole_network)
    region_keys = ["region1", "network"]
    group_places, region_places, enrichment, nation = side_by_side(
        units.sparkSession,
        [
            lambda: staged(context.join(targets, UNIT_KEYS, "full"), "group_places"),
            lambda: staged(region.join(agreed, region_keys, "full"), "region_places"),
            lambda: audited_enrichment(inputs.enrichment, base_year, gdp_lag),
            lambda: national_target(inputs.national_indicator, target_year, whole_network),
        ],
    )
    places = {
        "group and network": (group_places, UNIT_KEYS),
        "region and network": (region_places, region_keys),
        "regions": (inputs.regions, ["region1"]),
    }
    if enrichment is not None:
        places["enrichment"] = (enrichment, ["group_id"])
    sizes = table_sizes(places)

    base = units.withColumn("label", is_yes(F.col("label")))
    for name, (place, keys) in places.items():
        base = lookup(base, place, keys, sizes[name])

    gaps = {
        "gap_target_start": F.col("target") - F.col("group_rate_prior_year"),
        "gap_target_region": F.col("target") - F.col("region_target"),
    }
    if nation is not None:
        gaps["gap_target_national"] = F.col("target") - F.lit(nation)
    base = base.withColumns({name: round_half_even(gap, 2) for name, gap in gaps.items()})

    known = [
        "region2",
        *CONTEXT_COLUMNS,
        *(ENRICHMENT_FEATURES if enrichment is not None else []),
        *gaps,
    ]
    return base.select(*PASS_THROUGH, "label", *known, *(extra or []))
