"""Exploratory tables. Each is one pass over the base, then arithmetic on a small aggregate."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from forerate.functions.scalars import nan_to_null, round_half_even, unpivot
from forerate.sources.staging import ship_package


def column_coverage(df: DataFrame, columns: list[str] | None = None, only_incomplete: bool = True) -> DataFrame:
    """Percentage of non-null values per column, lowest first."""
    columns = columns or df.columns
    shares = df.agg(*[F.try_divide(100.0 * F.count(c), F.count("*")).alias(c) for c in columns])
    table = unpivot(shares, columns, "column_name", "coverage", [], "double")
    if only_incomplete:
        table = table.where(F.col("coverage") < 100)
    return table.withColumn("coverage", round_half_even(F.col("coverage"), 1)).orderBy("coverage", "column_name")


def label_share(df: DataFrame, label: str = "label") -> DataFrame:
    """Share of each label in percent."""
    sums = df.agg(F.count(label).alias("n"), F.sum(label).cast("long").alias("yes"))
    cells = [
        F.struct(F.lit(v).alias("label"), rows.alias("rows"), F.try_divide(100.0 * rows, F.col("n")).alias("share"))
        for v, rows in ((0, F.col("n") - F.col("yes")), (1, F.col("yes")))
    ]
    return sums.select(F.inline(F.array(*cells)))


def rate_by_category(
    df: DataFrame, categories: list[str], min_rows: int = 0, label: str = "label"
) -> DataFrame:
    """Label rate (percent) and size per value of each category, next to the overall rate.

    Values with no more than ``min_rows`` rows are left out of the list but stay in the overall rate.
    """
    sums = (
        unpivot(df, categories, "category", "value", [label], "string")
        .groupBy("category", "value")
        .agg(F.sum(label).alias("yes"), F.count("*").alias("rows"))
    )
    all_of = W.partitionBy("category")
    return (
        sums.select(
            "category",
            "value",
            round_half_even(100 * F.col("yes") / F.col("rows"), 1).alias("rate"),
            "rows",
            (100 * F.sum("yes").over(all_of) / F.sum("rows").over(all_of)).alias("overall_rate"),
        )
        .where(F.col("value").isNotNull() & (F.col("rows") > min_rows))
        .orderBy("category", F.desc("rate"), "value")
    )


def best_and_worst(rates: DataFrame, n: int = 3) -> DataFrame:
    """The ``n`` values with the highest and lowest rate per category, and the range between them."""
    whole = W.partitionBy("category")
    ranked = rates.select(
        "category",
        "value",
        "rate",
        F.row_number().over(whole.orderBy(F.desc("rate"), "value")).alias("best"),
        F.row_number().over(whole.orderBy("rate", F.desc("value"))).alias("worst"),
        (F.max("rate").over(whole) - F.min("rate").over(whole)).alias("range"),
    )
    sides = [
        ranked.where(F.col(side) <= n).select(
            "category", F.lit(side).alias("side"), F.col(side).alias("place"), "value", "rate", "range"
        )
        for side in ("best", "worst")
    ]
    return sides[0].unionByName(sides[1])


def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Products of all pairs of (known, value, square) columns, summed over a task's rows."""
    total = None
    for batch in batches:
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns], axis=1).astype(float)
        known = ~np.isnan(x)
        x = np.where(known, x, 0.0)
        wide = np.concatenate([known, x, x * x], axis=1)
        total = wide.T @ wide if total is None else total + wide.T @ wide
    if total is not None:
        i, j = np.indices(total.shape).reshape(2, -1)
        columns = [pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(total.ravel(), pa.float64())]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "j", "v"])


def correlations(df: DataFrame, columns: list[str], with_column: str | None = None) -> DataFrame:
    """Pearson correlation of pairs of columns over the rows where both are known.

    All pairs, or only the pairs with ``with_column``. One pass sums the products of all columns in
    each task; what is shuffled and returned has the size of the matrix, not of the data. Values are
    centred first to keep the sums exact.
    """
    names = list(dict.fromkeys([*columns, *([with_column] if with_column else [])]))
    means = df.agg(*[F.coalesce(F.avg(nan_to_null(F.col(c).cast("double"))), F.lit(0.0)).alias(c) for c in names]).first()
    centred = [(F.col(c).cast("double") - F.lit(float(means[c]))).alias(c) for c in names]
    ship_package(df.sparkSession)
    sums = df.select(*centred).mapInArrow(moments, "i int, j int, v double").groupBy("i", "j").agg(F.sum("v").alias("v"))
    size = len(names)
    m = np.zeros((3 * size, 3 * size))
    for r in sums.collect():
        m[r["i"], r["j"]] = r["v"]
    place = {c: i for i, c in enumerate(names)}
    rows = []
    for a, b in [(c, with_column) for c in columns] if with_column else combinations_with_replacement(names, 2):
        i, j = place[a], place[b]
        n, sx, sy, sxy = m[i, j], m[size + i, j], m[size + j, i], m[size + i, size + j]
        spread = max(n * m[2 * size + i, j] - sx * sx, 0.0) * max(n * m[2 * size + j, i] - sy * sy, 0.0)
        if n:
            rows.append((a, b, int(n), float((n * sxy - sx * sy) / spread**0.5) if spread else None))
    return df.sparkSession.createDataFrame(rows, "a string, b string, rows long, r double")


def label_correlations(df: DataFrame, numeric: list[str], label: str = "label") -> DataFrame:
    """Correlation of each numeric column with the label, strongest first."""
    table = correlations(df, numeric, label).select(
        F.col("a").alias("column_name"), round_half_even(F.col("r"), 3).alias("correlation")
    )
    return table.orderBy(F.desc(F.abs("correlation")), "column_name")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """The full matrix in long form: (row_name, column_name, r)."""
    half = correlations(df, columns)
    sides = F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))
    both = half.select("r", F.inline(F.array_distinct(sides)))
    return both.select(F.col("a").alias("row_name"), F.col("b").alias("column_name"), "r")


def binned_rate(df: DataFrame, columns: list[str], width: int = 10, label: str = "label") -> DataFrame:
    """Label rate per right-closed bin of a percentage; a value of 0 lies in no bin."""
    cells = unpivot(df, columns, "context", "x", [label], "double")
    inside = cells.where((F.col("x") > 0) & (F.col("x") <= 100))
    return (
        inside.groupBy("context", F.ceil(F.col("x") / width).cast("int").alias("bin"))
        .agg((100 * F.avg(label)).alias("rate"), F.count("*").alias("rows"))
        .select("context", (F.col("bin") * width - width / 2).alias("bin_mid"), "rate", "rows")
    )


def histograms(df: DataFrame, columns: list[str], bins: int = 40) -> DataFrame:
    """Equal-width histogram of each column over its own range; the last bin is closed on both sides."""
    ends = df.agg(*[f(c).cast("double").alias(f"{m}_{c}") for c in columns for m, f in (("lo", F.min), ("hi", F.max))]).first()
    cells = []
    for c in columns:
        lo, hi = ends[f"lo_{c}"], ends[f"hi_{c}"]
        if lo is None:
            continue
        if lo == hi:
            lo, hi = lo - 0.5, hi + 0.5
        cells.append(
            F.struct(
                F.lit(c).alias("column_name"),
                F.col(c).cast("double").alias("x"),
                F.lit(lo).alias("lo"),
                F.lit(hi).alias("hi"),
            )
        )
    long = df.select(F.inline(F.array(*cells))).dropna(subset=["x"])
    spot = F.floor((F.col("x") - F.col("lo")) / (F.col("hi") - F.col("lo")) * bins)
    counts = long.groupBy(
        "column_name", "lo", "hi", F.least(spot, F.lit(bins - 1)).cast("int").alias("bin")
    ).agg(F.count("*").alias("rows"))
    frame = counts.groupBy("column_name", "lo", "hi").agg(
        F.map_from_entries(F.collect_list(F.struct("bin", "rows"))).alias("found")
    )
    step = (F.col("hi") - F.col("lo")) / bins
    return frame.select(
        "column_name", "lo", "hi", "found", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin")
    ).select(
        "column_name",
        "bin",
        (F.col("lo") + F.col("bin") * step).alias("lower"),
        (F.col("lo") + (F.col("bin") + 1) * step).alias("upper"),
        F.coalesce(F.try_element_at("found", F.col("bin")), F.lit(0)).alias("rows"),
    )
