"""Exact, reproducible samples, group-disjoint splits and row-balanced group folds.

Randomness is an order by a seeded hash of the row key, so the same rows come out on any cluster
layout. A sample is a filter against one cut-off hash per stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import MAX_BROADCAST_ROWS
from forerate.functions.ordering import hash_cuts, running_sums
from forerate.functions.scalars import seeded_hash
from forerate.sources.staging import staged

HASH = "_hash"


def stratified_sample(
    df: DataFrame, n: int, seed: int = 42, key: str = "unit_id", stratum: str = "label"
) -> DataFrame:
    """``n`` rows that keep the share of each stratum; everything when there are no more rows.

    Each stratum gives ``n / N`` of its rows, rounded half to even. ``key`` must be unique.
    """
    sizes = df.groupBy(stratum).agg(F.count("*").alias("rows")).collect()
    total = sum(r["rows"] for r in sizes)
    if total <= n:
        return df
    sizes = [r for r in sizes if r[stratum] is not None]
    spark = df.sparkSession
    wanted = spark.createDataFrame(
        [(r[stratum], round(n / total * r["rows"])) for r in sizes],
        f"{stratum} {df.schema[stratum].dataType.simpleString()}, want long",
    )
    hashed = df.withColumn(HASH, seeded_hash(seed, key))
    largest = max(r["rows"] for r in sizes)
    cuts = staged(hash_cuts(hashed.select(stratum, HASH), [stratum], HASH, wanted, largest), "cuts")
    kept = hashed.join(cuts.drop("want"), stratum).where(F.col(HASH) <= F.col("cut"))
    return kept.select(*df.columns)


def simple_sample(df: DataFrame, n: int, seed: int = 42, key: str = "unit_id") -> DataFrame:
    """``n`` rows, or all of them when there are no more."""
    total = df.count()
    return df if total <= n else _first_by_hash(df, [key], n, total, seed)


def _first_by_hash(df: DataFrame, keys: list[str], n: int, total: int, seed: int) -> DataFrame:
    return df.where(seeded_hash(seed, *keys) <= F.lit(_cut(df, keys, n, total, seed)))


def _cut(df: DataFrame, keys: list[str], n: int, total: int, seed: int) -> str:
    wanted = df.sparkSession.createDataFrame([(n,)], "want long")
    hashes = df.select(seeded_hash(seed, *keys).alias(HASH))
    return hash_cuts(hashes, [], HASH, wanted, total).first()["cut"]


def group_split(df: DataFrame, share: float = 0.25, seed: int = 42, group: str = "group_id") -> DataFrame:
    """Add ``is_test``: a share of the *groups*, drawn by seeded hash, goes to the test side.

    Only the distinct groups are ranked. The rows are marked by comparing the hash of their group
    with one cut-off, so there is no join and no group can end up on both sides. The rows without a
    group are one group, here as in ``group_folds``.
    """
    groups = staged(df.select(group).distinct(), "groups")
    total = groups.count()
    if not total:
        return df.withColumn("is_test", F.lit(False))
    cut = _cut(groups, [group], math.ceil(share * total), total, seed)
    return df.withColumn("is_test", seeded_hash(seed, group) <= F.lit(cut))


def shared_groups(train: DataFrame, test: DataFrame, group: str = "group_id") -> DataFrame:
    """Groups that are on both sides of a split; empty when nothing leaks."""
    return train.select(group).intersect(test.select(group))


def group_folds(df: DataFrame, k: int, seed: int = 42, group: str = "group_id") -> DataFrame:
    """Assign whole groups to ``k`` folds of nearly equal row counts: (group, rows, fold).

    A group at least as large as a fair share of what is left gets a fold of its own. The other
    groups are laid end to end in hash order and cut into equal stretches for the remaining folds; a
    group belongs to the stretch its middle lies in. The rows without a group are one group.
    """
    sizes = staged(df.groupBy(group).agg(F.count("*").alias("rows")), "group_sizes")
    left = sizes.agg(F.sum("rows")).first()[0] or 0
    alone = []
    for row in sizes.orderBy(F.desc("rows"), group).limit(k).collect():
        if row["rows"] * (k - len(alone)) < left:
            break
        alone.append(row[group])
        left -= row["rows"]
    own = None
    if alone:
        place = F.lit(None).cast("int")
        for number, name in enumerate(alone):
            place = F.when(F.col(group).eqNullSafe(F.lit(name)), number).otherwise(place)
        own = sizes.where(place.isNotNull()).select(group, "rows", place.alias("fold"))
        if len(alone) == k or not left:
            return own
        sizes = sizes.where(place.isNull())
    spread = sizes.withColumn(HASH, seeded_hash(seed, group))
    placed = running_sums(spread, [], [(HASH, True)], ["rows"])
    middle = F.col("rows_before") + F.col("rows") / 2
    stretch = F.floor(middle * (k - len(alone)) / F.lit(left)).cast("int")
    rest = placed.select(group, "rows", (stretch + len(alone)).alias("fold"))
    return rest if own is None else own.unionByName(rest)


def with_folds(df: DataFrame, k: int, seed: int = 42, group: str = "group_id", name: str = "fold") -> DataFrame:
    """``df`` with the fold of each row's group; every row has one, those without a group included."""
    folds = staged(group_folds(df, k, seed, group).withColumnRenamed(group, "_group"), "folds")
    table = folds.select("_group", F.col("fold").alias(name))
    if folds.count() <= MAX_BROADCAST_ROWS:
        table = F.broadcast(table)
    return df.join(table, df[group].eqNullSafe(table["_group"])).select(*df.columns, name)
