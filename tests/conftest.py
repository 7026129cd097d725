from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parent.parent))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[8]")
        .appName("forerate-tests")
        .config("spark.sql.shuffle.partitions", "3")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def draw(salt: str, key: str = "id") -> str:
    """SQL for a number in [0, 1) that depends on a column and a salt only."""
    return f"(pmod(xxhash64('{salt}', {key}), 1000003) / 1000003)"


# A people table by rule: places of very unequal size, each in one region, with what is known about the
# place the same for all its rows. Gaps lie where real ones do: no history for some places, no target
# for others, one place with a single row, and a form that is rare.
PLACE = f"cast(if(id = 0, 30, floor(27 * pow({draw('place')}, 2))) as int)"
SAMPLE = {
    "unit_id": "format_string('person-%04d', id)",
    "site_id": f"format_string('site %d/%d', place, cast(floor(4 * {draw('site')}) as int))",
    "group_id": "format_string('%02d', place)",
    "region1": "element_at(array('north', 'east', 'south', 'west', 'isles'), place % 5 + 1)",
    "region2": "if(place % 5 < 2, 'upper', 'lower')",
    "network": f"if({draw('network')} < 0.7, 'town', 'state')",
    "form": f"case when {draw('form')} < 0.006 then 'rare' when {draw('form')} < 0.4 then 'x' when {draw('form')} < 0.75 then 'y' else 'z' end",
    "weight": f"0.5 + round(4 * {draw('weight')}) / 4",
    "label": f"cast({draw('label')} < 0.55 as int)",
    "group_rate_prior_year": f"if(place % 7 = 3, null, round(30 + 8 * (place % 6) + 6 * {draw('rate')}, 1))",
    "group_mean_prior_year": f"700 + 5 * (place % 11) + round(20 * {draw('mean')})",
    "region_rate_prior_year": "double(44 + 4 * (place % 5))",
    "target": "if(place % 9 = 4, null, double(50 + place))",
    "region_target": "double(60 + place % 5)",
    "gap_target_region": "target - region_target",
    "gap_target_national": "target - 58",
}


@pytest.fixture(scope="session")
def base(spark):
    df = spark.range(520).selectExpr("id", f"{PLACE} place")
    for name, rule in SAMPLE.items():
        df = df.withColumn(name, F.expr(rule))
    df = df.drop("id", "place").repartition(4).cache()
    df.count()
    return df


@pytest.fixture(scope="session")
def odd_base(base):
    """The same rows with odd ones among them: no group, weight zero, one number the same everywhere."""
    mark = F.crc32("unit_id")
    df = base.withColumns(
        {
            "group_id": F.when(mark % 7 > 0, F.col("group_id")),
            "weight": F.when(mark % 11 > 0, F.col("weight")).otherwise(0.0),
            "region_rate_prior_year": F.lit(51.5),
        }
    ).cache()
    df.count()
    return df


@pytest.fixture(scope="session")
def signal_base(spark, base):
    """The same rows with a label that follows the prior rate, so that models have something to learn."""
    noise = F.conv(F.substring(F.md5("unit_id"), 1, 4), 16, 10).cast("double") / 65536 * 30
    df = base.withColumn("label", (F.coalesce("group_rate_prior_year", F.lit(50.0)) + noise > 66).cast("int")).cache()
    df.count()
    return df
