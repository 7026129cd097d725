"""Ranks, running sums, exact quantiles and exact seeded cuts that never overload one task.

An unpartitioned window pulls a whole table into one task, and a window per group pulls the largest
group into one. So the largest group is measured first. Up to ``MAX_IN_TASK`` rows it is ranked by a
plain window. Beyond that the table is cut into *slices*: it is range partitioned on (group, order),
each slice is summed on its own and the sums of the slices ahead are added. A group that holds a
third of all rows is then spread over a third of the slices. Both ways give the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forerate.functions.scalars import lerp
from forerate.sources.staging import staged

SLICE = "_slice"
MAX_IN_TASK = 1_000_000


def largest_group(df: DataFrame, by: list[str]) -> int:
    """Row count of the largest group: how much a window per group would put into one task."""
    return df.groupBy(*by).count().agg(F.max("count")).first()[0] or 0


def _before(measure: str, window: W) -> Column:
    return F.coalesce(F.sum(measure).over(window), F.lit(0))


def running_sums(
    df: DataFrame, by: list[str], order: list[tuple[str, bool]], measures: list[str], stage: bool = True
) -> DataFrame:
    """Add ``<m>_before`` (sum over the rows ahead) and ``<m>_total`` (sum over the group).

    ``order`` lists (column, ascending) pairs that are unique within ``by``; rows with a null in
    ``by`` are left out, as in any grouping that drops null keys. ``df`` is read several times, so
    it is staged first unless the caller says it is a stored table already.
    """
    df = df.dropna(subset=by) if by else df
    table = staged(df, "ordered") if stage else df
    ranks = [F.col(c).asc() if up else F.col(c).desc() for c, up in order]
    if largest_group(table, by) <= MAX_IN_TASK:
        within = W.partitionBy(*by).orderBy(*ranks).rowsBetween(W.unboundedPreceding, -1)
        whole = W.partitionBy(*by)
        return table.select(
            "*",
            *[_before(m, within).alias(f"{m}_before") for m in measures],
            *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
        )
    return sliced_sums(table, by, ranks, measures)


def sliced_sums(table: DataFrame, by: list[str], ranks: list[Column], measures: list[str]) -> DataFrame:
    """``running_sums`` for groups of any size.

    The slice number is written with the rows, so it cannot change when a lost task is run again.
    """
    least = int(table.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = max(least, -(-2 * table.count() // max(1, MAX_IN_TASK)))
    cut = table.repartitionByRange(slices, *[F.col(b) for b in by], *ranks)
    sliced = staged(cut.withColumn(SLICE, F.spark_partition_id()), "slices")
    sums = sliced.groupBy(*by, SLICE).agg(*[F.sum(m).alias(m) for m in measures])
    ahead = W.partitionBy(*by).orderBy(SLICE).rowsBetween(W.unboundedPreceding, -1)
    whole = W.partitionBy(*by)
    offsets = sums.select(
        *by,
        SLICE,
        *[_before(m, ahead).alias(f"{m}_ahead") for m in measures],
        *[F.sum(m).over(whole).alias(f"{m}_total") for m in measures],
    )
    within = W.partitionBy(*by, SLICE).orderBy(*ranks).rowsBetween(W.unboundedPreceding, -1)
    local = sliced.select("*", *[_before(m, within).alias(f"{m}_local") for m in measures])
    return local.join(offsets, [*by, SLICE]).select(
        *table.columns,
        *[(F.col(f"{m}_local") + F.col(f"{m}_ahead")).alias(f"{m}_before") for m in measures],
        *[f"{m}_total" for m in measures],
    )


def value_at(value: str, count: str, position: Column) -> Column:
    """Aggregate: the value that covers a zero-based position in a counted, ordered table."""
    covers = (F.col(f"{count}_before") <= position) & (position < F.col(f"{count}_before") + F.col(count))
    return F.max(F.when(covers, F.col(value)))


def exact_quantiles(
    df: DataFrame, by: list[str], value: str, probs: dict[str, float], largest: int | None = None
) -> DataFrame:
    """Exact, linearly interpolated quantiles of ``value`` per group; nulls are left out.

    Equal values are counted first, combined on the map side, so a value shared by many rows is one
    row. ``largest`` is the row count of the largest group if the caller has it and it is small;
    otherwise the counted values are measured, and sliced when a group has too many for one task.
    """
    rows = df.dropna(subset=[*by, value]).select(*by, value)
    counted = rows.groupBy(*by, value).agg(F.count("*").alias("_n"))
    if largest is None or largest > MAX_IN_TASK:
        ranked = running_sums(counted, by, [(value, True)], ["_n"])
    else:
        within = W.partitionBy(*by).orderBy(value).rowsBetween(W.unboundedPreceding, -1)
        ranked = counted.select("*", _before("_n", within).alias("_n_before"), F.sum("_n").over(W.partitionBy(*by)).alias("_n_total"))
    return counted_quantiles(ranked, by, value, "_n", probs)


def counted_quantiles(
    ranked: DataFrame, by: list[str], value: str, count: str, probs: dict[str, float]
) -> DataFrame:
    """Quantiles from values with their ``<count>``, ``<count>_before`` and ``<count>_total``."""
    aggs = []
    for name, p in probs.items():
        spot = (F.col(f"{count}_total") - 1) * F.lit(p)
        low = F.floor(spot)
        aggs += [
            value_at(value, count, low).alias(f"{name}_low"),
            value_at(value, count, F.least(low + 1, F.col(f"{count}_total") - 1)).alias(f"{name}_high"),
            F.max(spot - low).alias(f"{name}_share"),
        ]
    return ranked.groupBy(*by).agg(*aggs).select(
        *by,
        *[lerp(F.col(f"{n}_low"), F.col(f"{n}_high"), F.col(f"{n}_share")).alias(n) for n in probs],
    )


def hash_cuts(
    rows: DataFrame, strata: list[str], hashed: str, wanted: DataFrame, largest: int
) -> DataFrame:
    """The hash of the ``want``-th row of each stratum, in hash order.

    ``wanted`` holds (strata..., want), several per stratum if need be, and ``largest`` is the row
    count of the largest stratum. Keeping the rows with a hash up to the cut is then a plain filter,
    with no sort of the table. When a stratum is too large for one task, two histograms on 16 bits
    of the hash each narrow the search to the rows that share 32 bits with the answer; only those
    few are ranked.
    """
    if largest <= MAX_IN_TASK:
        place = F.row_number().over(W.partitionBy(*strata).orderBy(hashed))
        ranked = rows.select(*strata, F.col(hashed).alias("cut"), place.cast("long").alias("want"))
        return wanted.withColumn("want", F.col("want").cast("long")).join(ranked, [*strata, "want"])

    boundary = wanted.select(*strata, "want", F.lit("").alias("_prefix"), F.col("want").cast("long").alias("_need"))
    for width in (4, 8):
        near = rows.select(
            *strata,
            F.substring(hashed, 1, width - 4).alias("_prior"),
            F.substring(hashed, 1, width).alias("_next"),
        )
        searched = boundary.select(*strata, F.col("_prefix").alias("_prior")).distinct()
        near = near.join(searched, [*strata, "_prior"], "left_semi")
        counts = near.groupBy(*strata, "_prior", "_next").agg(F.count("*").alias("_n"))
        ahead = W.partitionBy(*strata, "_prior").orderBy("_next").rowsBetween(W.unboundedPreceding, -1)
        counts = counts.withColumn("_before", _before("_n", ahead))
        holds = (F.col("_before") < F.col("_need")) & (F.col("_need") <= F.col("_before") + F.col("_n"))
        boundary = staged(
            boundary.withColumnRenamed("_prefix", "_prior")
            .join(counts, [*strata, "_prior"])
            .where(holds)
            .select(
                *strata,
                "want",
                F.col("_next").alias("_prefix"),
                (F.col("_need") - F.col("_before")).alias("_need"),
            ),
            "boundary",
        )
    last = rows.withColumn("_prefix", F.substring(hashed, 1, 8)).join(boundary, [*strata, "_prefix"])
    place = W.partitionBy(*strata, "want").orderBy(hashed)
    return (
        last.withColumn("_place", F.row_number().over(place))
        .where(F.col("_place") == F.col("_need"))
        .select(*strata, "want", F.col(hashed).alias("cut"))
    )
