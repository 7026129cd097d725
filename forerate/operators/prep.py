"""Feature preparation whose parameters are learned from training rows only.

Everything learned (medians, quartiles, means, deviations, levels) is read off one table of value
counts. A row carries the array ``fits`` of the model fits it trains, so a single pass over the data
serves all folds of a cross-validation, and every fit still sees its own training rows only.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.functions.joins import lookup
from forerate.functions.ordering import counted_quantiles, running_sums, value_at
from forerate.functions.scalars import lerp, nan_to_null, unpivot
from forerate.sources.staging import new_path, staged

# Names of the derived features.
FLAG_PREFIX = "missingindicator_"
RARE_SUFFIX = "_infrequent_sklearn"

ALL = 0
KEYS = ["fit", "column_name"]
# Up to so many rare levels of a column are written into its expression; more are joined as a table.
INLINE_RARE = 200


def value_counts(df: DataFrame, numeric: list[str], categorical: list[str], fits: str | None = None) -> DataFrame:
    """(fit, column_name, value, level, n): how often each value occurs among the rows of each fit.

    Rows are counted per distinct ``fits`` array before the array is opened, so the table that is
    shuffled does not grow with the number of fits.
    """
    member = (F.array(F.lit(ALL)) if fits is None else F.col(fits)).alias("_fits")
    numbers = [nan_to_null(F.col(c).cast("double")).alias(c) for c in numeric]
    kinds = []
    if numeric:
        long = unpivot(df.select(member, *numbers), numeric, "column_name", "value", ["_fits"], "double")
        kinds.append(long.select("*", F.lit("value").alias("kind"), F.lit(None).cast("string").alias("level")))
    if categorical:
        long = unpivot(df.select(member, *categorical), categorical, "column_name", "level", ["_fits"], "string")
        kinds.append(long.select("*", F.lit("level").alias("kind"), F.lit(None).cast("double").alias("value")))
    cells = ["column_name", "kind", "value", "level"]
    counted = [k.groupBy("_fits", *cells).agg(F.count("*").alias("n")) for k in kinds]
    opened = reduce(DataFrame.unionByName, counted).select(F.explode("_fits").alias("fit"), *cells, "n")
    if fits is not None:
        opened = opened.groupBy("fit", *cells).agg(F.sum("n").alias("n"))
    return staged(opened, "value_counts")


def numeric_parameters(counts: DataFrame) -> DataFrame:
    """Per fit and column: rows, missing, median, and the mean, population deviation and quartiles of
    the column after its gaps have been filled with the median.

    Deviations are summed around the median, which keeps large values exact and makes a filled gap
    count as zero.
    """
    table = counts.where(F.col("kind") == "value")
    sizes = table.groupBy(*KEYS).agg(
        F.sum("n").alias("rows"),
        F.sum(F.when(F.col("value").isNull(), F.col("n")).otherwise(0)).alias("missing"),
    )
    present = table.dropna(subset=["value"]).select(*KEYS, "value", "n")
    ranked = running_sums(present, KEYS, [("value", True)], ["n"], stage=False)
    middle = counted_quantiles(ranked, KEYS, "value", "n", {"median": 0.5})
    # one row per fit and column, however large the data
    known = F.broadcast(sizes.join(middle, KEYS))

    # in sorted order the filled gaps sit right behind the values up to the median
    behind = F.when(F.col("value") > F.col("median"), F.col("missing")).otherwise(0)
    filled = ranked.join(known, KEYS).withColumn("n_before", F.col("n_before") + behind)
    gap = F.col("value") - F.col("median")
    aggs = [F.max(c).alias(c) for c in ("rows", "missing", "median")]
    aggs += [F.sum(F.col("n") * gap).alias("s1"), F.sum(F.col("n") * gap * gap).alias("s2")]
    for name, p in (("p25", 0.25), ("p75", 0.75)):
        spot = (F.col("rows") - 1) * F.lit(p)
        low = F.floor(spot)
        high = F.least(low + 1, F.col("rows") - 1)
        aggs += [
            F.coalesce(value_at("value", "n", low), F.max("median")).alias(f"{name}_low"),
            F.coalesce(value_at("value", "n", high), F.max("median")).alias(f"{name}_high"),
            F.max(spot - low).alias(f"{name}_share"),
        ]
    moments = filled.groupBy(*KEYS).agg(*aggs)
    shift = F.col("s1") / F.col("rows")
    learned = moments.select(
        *KEYS,
        "rows",
        "missing",
        "median",
        (F.col("median") + shift).alias("mean"),
        F.sqrt(F.greatest(F.col("s2") / F.col("rows") - shift * shift, F.lit(0.0))).alias("std"),
        *[lerp(F.col(f"{p}_low"), F.col(f"{p}_high"), F.col(f"{p}_share")).alias(p) for p in ("p25", "p75")],
    )
    # a column without a single value has nothing to learn
    empty = sizes.where(F.col("missing") == F.col("rows"))
    return learned.unionByName(empty, allowMissingColumns=True)


def category_levels(counts: DataFrame, min_frequency: float = 0.01) -> DataFrame:
    """Per fit and column: each level after filling gaps with the most frequent one, its row count,
    whether it is that one, and whether it is rare (below ``min_frequency`` of the rows).

    Of equally frequent levels the smallest is the filler.
    """
    table = counts.where(F.col("kind") == "level")
    sizes = table.groupBy(*KEYS).agg(
        F.sum("n").alias("all_rows"),
        F.sum(F.when(F.col("level").isNull(), F.col("n")).otherwise(0)).alias("missing"),
        F.min_by("level", F.when(F.col("level").isNotNull(), F.struct(-F.col("n"), "level"))).alias("filler"),
    )
    is_filler = F.col("level") == F.col("filler")
    rows = F.col("n") + F.when(is_filler, F.col("missing")).otherwise(0)
    # one row per fit and column, so a column with many levels is not gathered in one task
    levels = table.dropna(subset=["level"]).join(F.broadcast(sizes), KEYS)
    return levels.select(
        *KEYS,
        "level",
        rows.alias("rows"),
        is_filler.alias("is_filler"),
        (rows < F.col("all_rows") * F.lit(min_frequency)).alias("is_rare"),
    )


def _flag_scale(missing: int, rows: int, scaler: str) -> tuple[float, float]:
    """Centre and scale of a 0/1 missing flag, which passes through the same scaler."""
    if scaler == "standard":
        share = missing / rows
        return share, (share * (1 - share)) ** 0.5 or 1.0

    def quantile(p: float) -> float:
        spot = (rows - 1) * p
        low = int(spot)
        ends = [float(i >= rows - missing) for i in (low, min(low + 1, rows - 1))]
        return ends[0] + (ends[1] - ends[0]) * (spot - low)

    return quantile(0.5), (quantile(0.75) - quantile(0.25)) or 1.0


def fit_specs(
    df: DataFrame,
    numeric: list[str],
    categorical: list[str],
    scaler: str = "standard",
    min_frequency: float = 0.01,
    fits: str | None = None,
) -> dict[int, dict]:
    """Learned preparation per fit. What reaches the driver is bounded by fits x columns, by
    1 / ``min_frequency`` frequent and ``INLINE_RARE`` rare levels per column; longer lists of rare
    levels stay a table."""
    counts = value_counts(df, numeric, categorical, fits)
    specs: dict[int, dict] = {}

    def spec(fit: int) -> dict:
        return specs.setdefault(fit, {"numeric": [], "flags": [], "categorical": []})

    found = {(r["fit"], r["column_name"]): r for r in numeric_parameters(counts).collect()} if numeric else {}
    for fit, column in sorted(found, key=lambda k: (k[0], numeric.index(k[1]))):
        r = found[fit, column]
        if r["missing"]:
            centre, scale = _flag_scale(r["missing"], r["rows"], scaler)
            spec(fit)["flags"].append({"column": column, "centre": centre, "scale": scale})
        if r["median"] is None:
            continue
        if scaler == "standard":
            centre, scale = r["mean"], r["std"] or 1.0
        else:
            # after filling, the middle value is the median of the known values
            centre, scale = r["median"], (r["p75"] - r["p25"]) or 1.0
        spec(fit)["numeric"].append({"column": column, "fill": r["median"], "centre": centre, "scale": scale})

    if categorical:
        levels = staged(category_levels(counts, min_frequency), "levels")
        many = {(r["fit"], r["column_name"]): r["n"] for r in levels.groupBy(*KEYS).agg(F.count_if("is_rare").alias("n")).collect()}
        long = [k for k, n in many.items() if n > INLINE_RARE]
        rare = levels.where("is_rare")
        if long:
            keys = F.broadcast(_keys(levels, long))
            found = levels.where("NOT is_rare OR is_filler").collect() + rare.where("NOT is_filler").join(keys, KEYS, "left_anti").collect()
            stored = rare_tables(rare.join(keys, KEYS, "left_semi").select(*KEYS, "level"))
        else:
            found, stored = levels.collect(), None
        listed = [r for r in found if not r["is_rare"] or r["is_filler"]]
        inline: dict[tuple[int, str], list[str]] = {}
        for r in found:
            if r["is_rare"] and many[r["fit"], r["column_name"]] <= INLINE_RARE:
                inline.setdefault((r["fit"], r["column_name"]), []).append(r["level"])
        for fit, column in sorted({(r["fit"], r["column_name"]) for r in listed}, key=lambda k: (k[0], categorical.index(k[1]))):
            mine = [r for r in listed if (r["fit"], r["column_name"]) == (fit, column)]
            entry = {
                "column": column,
                "fill": next((r["level"] for r in mine if r["is_filler"]), None),
                "levels": sorted(r["level"] for r in mine if not r["is_rare"]),
                "rare": sorted(inline.get((fit, column), [])),
            }
            if many.get((fit, column), 0) > INLINE_RARE:
                entry["rare_table"] = {"path": stored, "fit": fit, "rows": many[fit, column]}
            spec(fit)["categorical"].append(entry)
    return specs


def _keys(like: DataFrame, keys: list[tuple[int, str]]) -> DataFrame:
    """A few (fit, column) pairs as a table."""
    return like.sparkSession.createDataFrame(keys, f"fit {like.schema['fit'].dataType.simpleString()}, column_name string")


def rare_tables(rare: DataFrame) -> str:
    """The rare levels of the columns that have too many to write down, stored by fit and column."""
    path = new_path(rare.sparkSession, "rare")
    rare.write.parquet(path)
    return path


RARE_MARK = "_rare_"


def with_rare_marks(df: DataFrame, spec: dict) -> DataFrame:
    """``df`` with a mark for each column whose rare levels are in a table; joined by level."""
    for s in spec["categorical"]:
        if "rare_table" not in s:
            continue
        at, mark = s["rare_table"], RARE_MARK + s["column"]
        known = df.sparkSession.read.parquet(at["path"]).where((F.col("fit") == at["fit"]) & (F.col("column_name") == s["column"]))
        known = known.select(F.col("level").alias(f"{mark}_level"), F.lit(True).alias(mark))
        level = F.coalesce(F.col(s["column"]).cast("string"), F.lit(s["fill"]))
        df = lookup(df.withColumn(f"{mark}_level", level), known, [f"{mark}_level"], at["rows"]).drop(f"{mark}_level")
    return df


def with_features(df: DataFrame, spec: dict, name: str = "features") -> DataFrame:
    """``df`` with the prepared features as one vector."""
    marked = with_rare_marks(df, spec).withColumn(name, feature_vector(spec))
    return marked.select(*[c for c in df.columns if c != name], name)


def feature_expressions(spec: dict) -> dict[str, Column]:
    """Prepared features by name. A level never seen in training is 0 in every column."""
    out: dict[str, Column] = {}
    for s in spec["numeric"]:
        x = F.coalesce(nan_to_null(F.col(s["column"]).cast("double")), F.lit(s["fill"]))
        out[s["column"]] = (x - F.lit(s["centre"])) / F.lit(s["scale"])
    for s in spec["flags"]:
        gone = nan_to_null(F.col(s["column"]).cast("double")).isNull().cast("double")
        out[FLAG_PREFIX + s["column"]] = (gone - F.lit(s["centre"])) / F.lit(s["scale"])
    for s in spec["categorical"]:
        level = F.coalesce(F.col(s["column"]).cast("string"), F.lit(s["fill"]))
        for value in s["levels"]:
            out[f"{s['column']}_{value}"] = F.coalesce(level == value, F.lit(False)).cast("double")
        if "rare_table" in s:
            out[s["column"] + RARE_SUFFIX] = F.coalesce(F.col(RARE_MARK + s["column"]), F.lit(False)).cast("double")
        elif s["rare"]:
            out[s["column"] + RARE_SUFFIX] = F.coalesce(level.isin(s["rare"]), F.lit(False)).cast("double")
    return out


def feature_owners(spec: dict) -> list[str]:
    """The column that each prepared feature is made of, in the order of the features."""
    owners = [s["column"] for s in (*spec["numeric"], *spec["flags"])]
    for s in spec["categorical"]:
        owners += [s["column"]] * (len(s["levels"]) + bool(s["rare"] or "rare_table" in s))
    return owners


def feature_vector(spec: dict) -> Column:
    return array_to_vector(F.array(*feature_expressions(spec).values()))


class _PrepParams(Params):
    outputCol = Param(Params._dummy(), "outputCol", "vector column to add", TypeConverters.toString)

    def getOutputCol(self) -> str:
        return self.getOrDefault(self.outputCol)


class TabularPrep(Estimator, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fill, flag, scale and encode columns into one feature vector."""

    numericCols = Param(Params._dummy(), "numericCols", "numeric columns", TypeConverters.toListString)
    categoricalCols = Param(Params._dummy(), "categoricalCols", "text columns", TypeConverters.toListString)
    scaler = Param(Params._dummy(), "scaler", "standard or robust", TypeConverters.toString)
    minFrequency = Param(Params._dummy(), "minFrequency", "share below which a level is rare", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, numericCols=None, categoricalCols=None, scaler="standard", minFrequency=0.01, outputCol="features"):
        super().__init__()
        self._setDefault(numericCols=[], categoricalCols=[], scaler="standard", minFrequency=0.01, outputCol="features")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> TabularPrepModel:
        numeric, categorical = self.getOrDefault(self.numericCols), self.getOrDefault(self.categoricalCols)
        specs = fit_specs(
            dataset, numeric, categorical, self.getOrDefault(self.scaler), self.getOrDefault(self.minFrequency)
        )
        return TabularPrepModel(spec=json.dumps(specs[ALL]), outputCol=self.getOutputCol())


class TabularPrepModel(Model, _PrepParams, DefaultParamsReadable, DefaultParamsWritable):
    """Learned preparation; applying it is a projection without any shuffle."""

    spec = Param(Params._dummy(), "spec", "learned parameters as JSON", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, spec="{}", outputCol="features"):
        super().__init__()
        self._setDefault(spec="{}", outputCol="features")
        self._set(**self._input_kwargs)

    def learned(self) -> dict:
        return json.loads(self.getOrDefault(self.spec))

    def feature_names(self) -> list[str]:
        return list(feature_expressions(self.learned()))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return with_features(dataset, self.learned(), self.getOutputCol())

    def write(self) -> _PrepWriter:
        return _PrepWriter(self)

    @classmethod
    def read(cls) -> _PrepReader:
        return _PrepReader(cls)


class _PrepWriter(DefaultParamsWriter):
    """Saves tables of rare levels beside the parameters."""

    def saveImpl(self, path: str) -> None:
        super().saveImpl(path)
        for s in self.instance.learned().get("categorical", []):
            if "rare_table" in s:
                table = self.sparkSession.read.parquet(s["rare_table"]["path"]).where(F.col("column_name") == s["column"])
                table.where(F.col("fit") == s["rare_table"]["fit"]).write.parquet(f"{path}/rare/{s['column']}")


class _PrepReader(DefaultParamsReader):
    def load(self, path: str) -> TabularPrepModel:
        model = super().load(path)
        spec = model.learned()
        for s in spec.get("categorical", []):
            if "rare_table" in s:
                s["rare_table"]["path"] = f"{path}/rare/{s['column']}"
        return model._set(spec=json.dumps(spec))
