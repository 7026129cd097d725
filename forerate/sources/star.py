"""Binds the star-schema test tables to the roles of ``Inputs``.

A supplier is a group, its nation and region are region1 and region2, the return flag is the
network, a line item is an individual and the part it is for is its site. The label says whether
the extended price reaches a cut-off, the quantity is the sampling weight. Prices are taken in whole
units, so that their sums do not depend on the order of the rows.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forerate.functions.scalars import pad_code
from forerate.plans.base import analytical_base
from forerate.sources.staging import forget_with_staging, side_by_side, staged, staging_folder
from forerate.sources.tables import Inputs, enrichment_extract

BASE_YEAR = 1999
TARGET_YEAR = 2000
WHOLE_NETWORK = "ALL"
LABEL_CUT = 30000
# Suppliers by number: each fifth has no derived rate of the base year, each fifteenth no published one.
NO_HISTORY, NOT_PUBLISHED = 5, 15


def in_year(ts: Column, year: int) -> Column:
    """A half-open range on the timestamp: unlike ``year(ts) = ...`` it reaches the Parquet scan."""
    day = "cast('{}-01-01' as timestamp_ntz)"
    return (ts >= F.expr(day.format(year))) & (ts < F.expr(day.format(year + 1)))


_stored: dict[tuple[str, str, str], DataFrame] = {}
forget_with_staging(_stored)


def stored(spark: SparkSession, sf_dir: str, name: str, make: Callable[[], DataFrame]) -> DataFrame:
    """A derived input table, written once per application: the jobs read stored tables."""
    key = (staging_folder(spark), sf_dir, name)
    if key not in _stored:
        _stored[key] = staged(make(), name)
    return _stored[key]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored_places(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "places", lambda: places(spark, sf_dir))


def places(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per supplier: group, region1, agreed target (none where the balance is negative)."""
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    balance = F.col("s_acctbal")
    return supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("supplier"),
        pad_code(F.col("s_suppkey").cast("string")).alias("group_id"),
        F.col("s_name").alias("group_name"),
        F.col("n_name").alias("region1"),
        F.when(balance >= 0, 40 + 40 * (balance + 1000) / 11000).alias("target"),
    )


def regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return nation.join(region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("region1"), F.col("r_name").alias("region2")
    )


def units_of(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """The line items of one year as individuals, with a fixed score for metric checks."""
    ship = F.col("l_shipdate")
    # in steps of 1/1024, so that weighted sums are exact in any order
    score = F.rint((0.2 + 3 * F.col("l_discount") + 2 * F.col("l_tax") + F.col("l_quantity") / 250) * 1024) / 1024
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    unit_id = F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.date_format(ship, "yyyyMMdd"))
    where = stored_places(spark, sf_dir).select("supplier", "group_id", "region1")
    rows = table(spark, sf_dir, "lineitem").where(in_year(ship, year))
    return rows.join(where, F.col("l_suppkey") == F.col("supplier"), "left").select(
        unit_id.alias("unit_id"),
        F.col("l_partkey").cast("string").alias("site_id"),
        "group_id",
        "region1",
        F.col("l_returnflag").alias("network"),
        F.col("l_linenumber").cast("string").alias("form"),
        F.col("l_quantity").alias("weight"),
        F.when(F.col("l_extendedprice") >= LABEL_CUT, "1").otherwise("0").alias("label"),
        F.rint("l_extendedprice").alias("score_raw"),
        (F.col("l_discount") > 0).alias("valid"),
        F.when(F.col("l_tax") < 0.08, "2").otherwise("3").alias("grade"),
        F.lit(year).alias("year"),
        score.alias("fixed_score"),
    )


def units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and target year. A filter on ``year`` drops the other branch before anything is read."""
    return units_of(spark, sf_dir, BASE_YEAR).unionByName(units_of(spark, sf_dir, TARGET_YEAR))


def unit_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The one aggregation of the units that the three indicator tables are made from."""
    yes = (F.col("label") == "1").cast("int")
    return (
        units(spark, sf_dir)
        .withColumn("assessed", F.col("valid") & (F.col("grade") == "2"))
        .groupBy("year", "group_id", "region1", "network", "assessed")
        .agg(
            F.count("*").alias("n"),
            F.sum(yes).alias("y"),
            F.sum("weight").alias("w"),
            F.sum(F.col("weight") * yes).alias("wy"),
            F.sum("score_raw").alias("score"),
        )
    )


def _rates(sums: DataFrame, keys: list[str]) -> DataFrame:
    return (
        sums.where("assessed")
        .groupBy(*keys)
        .agg(
            (100 * (F.sum("wy") / F.sum("w"))).alias("rate"),
            (F.sum("score") / F.sum("n")).alias("mean_score"),
        )
    )


def group_indicator(sums: DataFrame, where: DataFrame) -> DataFrame:
    """Derived rate and agreed target per year, group and network.

    As in the original tables some places have no derived base-year row, at every scale the same share.
    """
    known = (F.col("year") == TARGET_YEAR) | (F.col("group_id").cast("long") % NO_HISTORY != 0)
    rates = _rates(sums, ["year", "group_id", "network"]).where(known)
    return rates.join(where.select("group_id", "target"), "group_id", "left")


def published(sums: DataFrame) -> DataFrame:
    """Published unweighted rate over all rows, per network and (``aggregated``) per group."""
    rate = (100 * (F.sum("y") / F.sum("n"))).alias("rate")
    single = (
        sums.groupBy("year", "group_id", "network")
        .agg(F.lit(False).alias("aggregated"), rate)
        .where(F.col("group_id").cast("long") % NOT_PUBLISHED != 0)
    )
    whole = sums.groupBy("year", "group_id").agg(
        F.lit(WHOLE_NETWORK).alias("network"), F.lit(True).alias("aggregated"), rate
    )
    return single.unionByName(whole)


def region_indicator(sums: DataFrame, where: DataFrame) -> DataFrame:
    """Rate per year, region and network. Targets are agreed for the whole network and for all
    networks but one, so the fallback has something to do."""
    agreed = where.groupBy("region1").agg(F.avg("target").alias("agreed"))
    single = (
        _rates(sums, ["year", "region1", "network"])
        .join(agreed, "region1", "left")
        .withColumn("target", F.when(F.col("network") != "N", F.col("agreed")))
        .select("year", "region1", "network", "rate", "mean_score", "target")
    )
    whole = agreed.select(
        F.explode(F.array(F.lit(BASE_YEAR), F.lit(TARGET_YEAR))).alias("year"),
        "region1",
        F.lit(WHOLE_NETWORK).alias("network"),
        F.lit(None).cast("double").alias("rate"),
        F.lit(None).cast("double").alias("mean_score"),
        (F.col("agreed") + 1).alias("target"),
    )
    return single.unionByName(whole)


def national_indicator(where: DataFrame) -> DataFrame:
    return where.agg(
        F.lit(TARGET_YEAR).alias("year"),
        F.lit(WHOLE_NETWORK).alias("network"),
        F.avg("target").alias("target"),
    )


def newest_year(spark: SparkSession, sf_dir: str, ceiling: int) -> int | None:
    """The last year with shipments up to ``ceiling``: one column is read, up to that year."""
    ship = F.col("l_shipdate")
    end = F.expr(f"cast('{ceiling + 1}-01-01' as timestamp_ntz)")
    return table(spark, sf_dir, "lineitem").where(ship < end).agg(F.year(F.max(ship))).first()[0]


def yearly_sources(spark: SparkSession, sf_dir: str, year: int) -> DataFrame:
    """Raw population (distinct parts) and GDP (sum of prices) per unpadded group code in one year."""
    return (
        table(spark, sf_dir, "lineitem")
        .where(in_year(F.col("l_shipdate"), year))
        .groupBy(F.col("l_suppkey").cast("string").alias("group_id"), F.lit(year).alias("year"), "l_partkey")
        .agg(F.sum(F.rint("l_extendedprice")).alias("price"))
        .groupBy("group_id", "year")
        .agg(F.count("*").alias("population"), F.sum("price").alias("gdp"))
    )


def stored_year(spark: SparkSession, sf_dir: str, ceiling: int) -> DataFrame:
    """The sources of the newest year not after ``ceiling``; nothing of the other years is read."""
    year = newest_year(spark, sf_dir, ceiling)
    year = ceiling if year is None else year
    return stored(spark, sf_dir, f"sources_{year}", lambda: yearly_sources(spark, sf_dir, year))


def stored_extract(spark: SparkSession, sf_dir: str, base_year: int = BASE_YEAR) -> DataFrame:
    def make() -> DataFrame:
        heads, product = (stored_year(spark, sf_dir, base_year - lag) for lag in (0, 2))
        return enrichment_extract(heads, product, base_year)

    return stored(spark, sf_dir, f"enrichment_{base_year}", make)


def stored_sums(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "unit_sums", lambda: unit_sums(spark, sf_dir))


def stored_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "regions", lambda: regions(spark, sf_dir))


def stored_group_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda: group_indicator(stored_sums(spark, sf_dir), stored_places(spark, sf_dir))
    return stored(spark, sf_dir, "group_indicator", make)


def stored_region_indicator(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda: region_indicator(stored_sums(spark, sf_dir), stored_places(spark, sf_dir))
    return stored(spark, sf_dir, "region_indicator", make)


def stored_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "national_indicator", lambda: national_indicator(stored_places(spark, sf_dir)))


def stored_published(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored(spark, sf_dir, "published", lambda: published(stored_sums(spark, sf_dir)))


def names(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stored_places(spark, sf_dir).select("group_id", "group_name", "region1")


def inputs(spark: SparkSession, sf_dir: str) -> Inputs:
    """All tables of a run; a query that needs one of them asks for that one."""
    ask = lambda *tables: side_by_side(spark, [partial(t, spark, sf_dir) for t in tables])
    ask(stored_places)
    ask(stored_sums, stored_regions, stored_extract)
    by_group, by_region, nation, official = ask(
        stored_group_indicator, stored_region_indicator, stored_nation, stored_published
    )
    return Inputs(
        units=units(spark, sf_dir),
        group_indicator=by_group,
        region_indicator=by_region,
        national_indicator=nation,
        published=official,
        regions=stored_regions(spark, sf_dir),
        enrichment=stored_extract(spark, sf_dir),
        names=names(spark, sf_dir),
    )


def fresh_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The analytical base over the test tables, assembled anew."""
    return analytical_base(
        inputs(spark, sf_dir), BASE_YEAR, TARGET_YEAR, WHOLE_NETWORK, extra=["fixed_score"]
    )


def base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The saved base that every later stage reads."""
    return stored(spark, sf_dir, "base", lambda: fresh_base(spark, sf_dir))
