"""From individual scores to units (group x network): predicted rate, gap to the target, risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.functions.scalars import round_half_even, weighted_mean

UNIT = ["group_id", "region1", "region2", "network"]
MIN_ROWS = 20


def rate(x: str) -> Column:
    return round_half_even(100 * weighted_mean(x, "weight"), 2)


def unit_risk(scored: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """One row per unit with at least ``min_rows`` individuals.

    Target and history belong to the unit, so any row's value will do and the largest is taken. A
    unit without a target cannot be assessed; that is not the same as being free of risk.
    """
    units = (
        scored.dropna(subset=UNIT)
        .groupBy(*UNIT)
        .agg(
            F.count("*").alias("rows"),
            rate("score").alias("predicted_rate"),
            rate("label").alias("real_rate"),
            F.max("target").alias("target"),
            F.max("group_rate_prior_year").alias("rate_prior_year"),
        )
        .where(F.col("rows") >= min_rows)
    )
    gap = round_half_even(F.col("predicted_rate") - F.col("target"), 2)
    return (
        units.withColumn("risk", 1 - F.col("predicted_rate") / 100)
        .withColumn("gap_predicted_target", gap)
        .withColumn("no_target", F.col("target").isNull())
        .withColumn("at_risk", F.coalesce(F.col("gap_predicted_target") < 0, F.lit(False)))
    )


def contradictory_units(scored: DataFrame) -> DataFrame:
    """Units whose rows disagree on target or history; empty when the base is sound."""
    checks = [
        F.max(c).isNotNull() & ((F.min(c) != F.max(c)) | (F.count(c) < F.count("*")))
        for c in ("target", "group_rate_prior_year")
    ]
    return scored.dropna(subset=UNIT).groupBy(*UNIT).agg((checks[0] | checks[1]).alias("bad")).where("bad").drop("bad")


def with_names(units: DataFrame, names: DataFrame) -> DataFrame:
    """Units with the columns of the name table; a column both have gets the suffix ``_dim``.

    Raises if a key is in the name table twice, as its units would be too.
    """
    twice = names.dropna(subset=["group_id"]).groupBy("group_id").count().where("count > 1").first()
    if twice:
        raise ValueError(f"group {twice['group_id']} is in the name table {twice['count']} times")
    clash = {c: f"{c}_dim" for c in names.columns if c != "group_id" and c in units.columns}
    return units.join(names.withColumnsRenamed(clash), "group_id", "left")


def top_risk(units: DataFrame, n: int = 15) -> DataFrame:
    return units.orderBy(F.desc("risk"), *UNIT).limit(n)


def risk_by_region(units: DataFrame) -> DataFrame:
    """Mean risk over the units of each region, in percent, highest first."""
    table = units.dropna(subset=["region2"]).groupBy("region2").agg(
        round_half_even(100 * F.avg("risk"), 1).alias("mean_risk"), F.count("*").alias("units")
    )
    return table.orderBy(F.desc("mean_risk"), "region2")


def risk_summary(units: DataFrame) -> DataFrame:
    """Counts of units: all, distinct groups, without target, assessable, at risk."""
    assessable = F.count_if(~F.col("no_target"))
    at_risk = F.count_if(F.col("at_risk"))
    return units.agg(
        F.count("*").alias("units"),
        F.countDistinct("group_id").alias("groups"),
        F.count_if(F.col("no_target")).alias("without_target"),
        assessable.alias("assessable"),
        at_risk.alias("at_risk"),
        round_half_even(100 * at_risk / F.greatest(assessable, F.lit(1)), 1).alias("pct_at_risk"),
    )


def rate_errors(units: DataFrame) -> DataFrame:
    """Error of the predicted rate against the rule "repeat last year's", where there is a last year."""
    miss = F.col("predicted_rate") - F.col("real_rate")
    naive = F.col("rate_prior_year") - F.col("real_rate")
    return units.dropna(subset=["rate_prior_year"]).agg(
        round_half_even(F.avg(F.abs(miss)), 2).alias("mae_model"),
        round_half_even(F.sqrt(F.avg(miss * miss)), 2).alias("rmse_model"),
        round_half_even(F.avg(F.abs(naive)), 2).alias("mae_repeat_last_year"),
        F.count("*").alias("units"),
    )
