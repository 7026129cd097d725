"""What is known about a place before the outcome: prior rates, dispersion, targets, enrichment."""

from __future__ import annotations

import logging
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forerate.contracts import PROVENANCE
from forerate.functions.ordering import exact_quantiles
from forerate.functions.scalars import correlation, round_half_even
from forerate.sources.staging import staged
from forerate.sources.tables import unit_rows

log = logging.getLogger(__name__)

UNIT_KEYS = ["group_id", "network"]


class LeakError(ValueError):
    """A table holds something that was not known when the prediction would be made."""


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that would fan out a left join, with their row count."""
    return df.groupBy(*keys).agg(F.count("*").alias("rows")).where(F.col("rows") > 1)


def table_sizes(tables: dict[str, tuple[DataFrame, list[str]]]) -> dict[str, int]:
    """Rows per table, in one job; raises if a table would multiply the rows it is joined to."""
    counted = [
        df.groupBy(*keys).count().agg(F.lit(name).alias("name"), F.sum("count").alias("rows"), F.max("count").alias("most"))
        for name, (df, keys) in tables.items()
    ]
    sizes = reduce(DataFrame.unionByName, counted).collect()
    for r in sizes:
        if (r["most"] or 0) > 1:
            df, keys = tables[r["name"]]
            raise ValueError(f"{r['name']}: {duplicate_keys(df, keys).first().asDict()} is not unique")
    return {r["name"]: r["rows"] or 0 for r in sizes}


def dispersion(rows: DataFrame) -> DataFrame:
    """Spread of the raw score per group and network: sample deviation, quartiles, row count.

    Rows without a score still count. A single row has no deviation (null).
    """
    keyed = rows.dropna(subset=UNIT_KEYS)
    spread = staged(
        keyed.groupBy(*UNIT_KEYS).agg(
            round_half_even(F.stddev_samp("score_raw"), 2).alias("group_std_prior_year"),
            F.count("*").alias("group_n_prior_year"),
        ),
        "spread",
    )
    largest = spread.agg(F.max("group_n_prior_year")).first()[0] or 0
    quartiles = exact_quantiles(
        keyed,
        UNIT_KEYS,
        "score_raw",
        {"group_p25_prior_year": 0.25, "group_p75_prior_year": 0.75},
        largest,
    )
    return spread.join(quartiles, UNIT_KEYS, "left").select(
        *UNIT_KEYS,
        "group_std_prior_year",
        round_half_even(F.col("group_p25_prior_year"), 2).alias("group_p25_prior_year"),
        round_half_even(F.col("group_p75_prior_year"), 2).alias("group_p75_prior_year"),
        "group_n_prior_year",
    )


def prior_rates(group_indicator: DataFrame, published: DataFrame, base_year: int) -> DataFrame:
    """Derived rate of the base year, with the published rate as reserve where none was derived."""
    derived = group_indicator.where(F.col("year") == base_year).select(
        *UNIT_KEYS,
        F.col("rate").alias("derived_rate"),
        F.col("mean_score").alias("group_mean_prior_year"),
    )
    reserve = published.where((F.col("year") == base_year) & ~F.col("aggregated")).select(
        *UNIT_KEYS, F.col("rate").alias("reserve_rate")
    )
    return derived.join(reserve, UNIT_KEYS, "full")


def group_context(
    units: DataFrame, group_indicator: DataFrame, published: DataFrame, base_year: int, grade: str = "2"
) -> DataFrame:
    """Prior-year context per group and network."""
    rates = prior_rates(group_indicator, published, base_year).select(
        *UNIT_KEYS,
        "group_mean_prior_year",
        F.coalesce("derived_rate", "reserve_rate").alias("group_rate_prior_year"),
    )
    spread = dispersion(unit_rows(units, base_year, [*UNIT_KEYS, "score_raw"], grade))
    return rates.join(spread, UNIT_KEYS, "full")


def reserve_coverage(group_indicator: DataFrame, published: DataFrame, base_year: int) -> DataFrame:
    """How many units get their prior rate from the derived table, from the reserve, or not at all."""
    rates = prior_rates(group_indicator, published, base_year)
    derived = F.col("derived_rate").isNotNull()
    reserve = ~derived & F.col("reserve_rate").isNotNull()
    total = F.count("*")
    return rates.agg(
        total.alias("units"),
        F.count_if(derived).alias("from_derived"),
        F.count_if(reserve).alias("from_reserve"),
        F.count_if(~derived & ~reserve).alias("without_rate"),
        F.try_divide(F.count_if(derived), total).alias("derived_share"),
        F.try_divide(F.count_if(derived | reserve), total).alias("covered_share"),
    )


def region_context(region_indicator: DataFrame, base_year: int) -> DataFrame:
    return region_indicator.where(F.col("year") == base_year).select(
        "region1",
        "network",
        F.col("rate").alias("region_rate_prior_year"),
        F.col("mean_score").alias("region_mean_prior_year"),
    )


def group_targets(group_indicator: DataFrame, target_year: int) -> DataFrame:
    """Agreed targets. Nothing else is read from the target year: its other columns are the outcome."""
    return group_indicator.where(F.col("year") == target_year).select(*UNIT_KEYS, "target")


def region_targets(region_indicator: DataFrame, target_year: int, whole_network: str) -> DataFrame:
    """Target per region and network; a network without one falls back to the whole network's.

    A region that has only the whole-network row gets no row here.
    """
    agreed = region_indicator.where(F.col("year") == target_year).select("region1", "network", "target")
    whole = F.max(F.when(F.col("network") == whole_network, F.col("target"))).over(W.partitionBy("region1"))
    return (
        agreed.select("region1", "network", F.coalesce(F.col("target"), whole).alias("region_target"))
        .where(F.col("network") != whole_network)
    )


def national_target(national_indicator: DataFrame, target_year: int, whole_network: str) -> float | None:
    """The one national target, a yardstick rather than a feature; ``None`` when it is not set."""
    row = (
        national_indicator.where((F.col("year") == target_year) & (F.col("network") == whole_network))
        .dropna(subset=["target"])
        .agg(F.max("target"))
        .first()
    )
    return row[0]


def vintage_violations(enrichment: DataFrame, base_year: int, gdp_lag: int = 2) -> DataFrame:
    """Reference years beyond the ceiling of their source, with the number of rows that hold them."""
    years = F.array(
        F.struct(F.lit("population_year").alias("source"), F.col("population_year").alias("year"), F.lit(base_year).alias("ceiling")),
        F.struct(F.lit("gdp_year").alias("source"), F.col("gdp_year").alias("year"), F.lit(base_year - gdp_lag).alias("ceiling")),
    )
    return (
        enrichment.select(F.explode(years).alias("y"))
        .select("y.*")
        .where(F.col("year") > F.col("ceiling"))
        .groupBy("source", "year", "ceiling")
        .agg(F.count("*").alias("rows"))
    )


def audited_enrichment(enrichment: DataFrame | None, base_year: int, gdp_lag: int = 2) -> DataFrame | None:
    """The enrichment columns, only if their reference years can be and have been checked.

    Without provenance columns the table is refused (not joined). A year beyond its ceiling raises.
    """
    if enrichment is None:
        return None
    missing = [c for c in PROVENANCE if c not in enrichment.columns]
    if missing:
        log.error("enrichment refused: no %s", missing)
        return None
    late = vintage_violations(enrichment, base_year, gdp_lag).limit(20).collect()
    if late:
        raise LeakError(f"enrichment holds years not published yet: {[r.asDict() for r in late]}")
    return enrichment.drop(*PROVENANCE)


def key_stability(units: DataFrame, base_year: int, target_year: int, grade: str = "2") -> DataFrame:
    """Can an id below the group be followed over the years?

    Share of the ids present in both years that share a group in both, and the year-to-year
    correlation of the label rate at id level against the one at group level.
    """
    both = units.where(F.col("year").isin(base_year, target_year) & F.col("valid") & (F.col("grade") == grade))
    rows = both.dropna(subset=["site_id", "group_id"]).select(
        "site_id", "group_id", "year", F.coalesce(F.col("label") == "1", F.lit(False)).cast("int").alias("label")
    )
    # one pass; every later step works on one row per (id, group)
    before = F.col("year") == base_year
    pairs = staged(
        rows.groupBy("site_id", "group_id").agg(
            F.count_if(before).alias("n0"),
            F.count_if(~before).alias("n1"),
            F.sum(F.when(before, F.col("label"))).alias("y0"),
            F.sum(F.when(~before, F.col("label"))).alias("y1"),
        ),
        "pairs",
    )

    def rates(key: str) -> DataFrame:
        sums = pairs.groupBy(key).agg(
            *[F.sum(c).alias(c) for c in ("n0", "n1", "y0", "y1")],
            F.max(((F.col("n0") > 0) & (F.col("n1") > 0)).cast("int")).alias("kept"),
        )
        return sums.where((F.col("n0") > 0) & (F.col("n1") > 0)).select(
            (F.col("y0") / F.col("n0")).alias("r0"), (F.col("y1") / F.col("n1")).alias("r1"), "kept"
        )

    def level(key: str, kept: Column) -> DataFrame:
        return rates(key).agg(
            F.lit(key).alias("level"),
            F.count("*").alias("keys_in_both_years"),
            kept.alias("share_same_group"),
            correlation("r0", "r1").alias("rate_correlation"),
        )

    return level("site_id", F.avg("kept")).unionByName(level("group_id", F.avg(F.lit(1))))
