"""Model families, group-wise cross-validation, curves, random search and out-of-fold scores.

All comparisons go through ``run_fits``: the preparation of every fit is learned in one pass, the
fits run side by side on the cluster, and the scores of all of them are evaluated together.
"""

from __future__ import annotations

import itertools
import json
import random
import time
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import partial, reduce

from pyspark.ml import Estimator, Model, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.contracts import ENRICHMENT_FEATURES, feature_columns
from forerate.functions.ordering import hash_cuts
from forerate.functions.scalars import seeded_hash
from forerate.functions.sums import KEPT
from forerate.operators.bayes import ClassPrior, FoldSums, GaussianBayes
from forerate.operators.boosting import LeafwiseBoosting, fit_together
from forerate.operators.forest import Forest
from forerate.operators.linear import NewtonLinear
from forerate.operators.metrics import class_metrics, ranking_metrics
from forerate.operators.prep import TabularPrep, TabularPrepModel, fit_specs, with_features
from forerate.operators.sampling import HASH, with_folds
from forerate.sources.staging import side_by_side, staged

SEED = 42
EARLY_STOP_MARK = "_watch"
# Histograms of as many nodes as fit here are summed in one job, so a level of a tree is one job.
TREE_MEMORY_MB = 1024


@dataclass(frozen=True)
class Training:
    """What an estimator may depend on: size and total weight of its training rows."""

    rows: int
    weight: float


Builder = Callable[[Training], Estimator]


def watched(seed: int = SEED) -> Column:
    """The seeded tenth of rows that early stopping watches, drawn apart from samples and parts."""
    number = F.conv(F.substring(seeded_hash(seed + 1, "unit_id"), 1, 8), 16, 10).cast("long")
    return number < int(0.1 * 2**32)


COMMON = {"featuresCol": "features", "labelCol": "label", "weightCol": "weight"}


def boosting(
    rounds: int = 100,
    rate: float = 0.1,
    leaves: int = 31,
    min_leaf: int = 20,
    l2: float = 0.0,
    early_stopping: bool = True,
) -> Builder:
    """Leaf-wise histogram boosting. The defaults.

    With ``early_stopping`` a seeded tenth of the training rows is watched and not learned from, and
    ``rounds`` is the most there can be; without it all rows are learned from and all rounds are run.
    Both mean the same at every size.
    """
    watch = EARLY_STOP_MARK if early_stopping else ""
    return lambda data: LeafwiseBoosting(rounds=rounds, rate=rate, leaves=leaves, minLeaf=min_leaf, l2=l2, watch=watch)


def candidates(seed: int = SEED, rounds: int = 100, trees: int = 100) -> dict[str, Builder]:
    """One model per family. The settings of each."""
    return {
        "baseline": lambda d: ClassPrior(),
        "logistic_regression": lambda d: NewtonLinear(loss="logistic", cost=1.0, maxIter=1000),
        "decision_tree": lambda d: DecisionTreeClassifier(
            **COMMON, maxDepth=8, minInstancesPerNode=50, maxBins=255, maxMemoryInMB=TREE_MEMORY_MB, seed=seed
        ),
        "random_forest": lambda d: Forest(
            **COMMON, numTrees=trees, minInstancesPerNode=50, maxDepth=30, featureSubsetStrategy="sqrt",
            maxMemoryInMB=TREE_MEMORY_MB, cacheNodeIds=True, seed=seed  # rows needn't walk all trees from the root at each level
        ),
        "gradient_boosting": boosting(rounds),
        "linear_svm": lambda d: NewtonLinear(loss="squared_hinge", cost=0.1, maxIter=1000),
        "naive_bayes": lambda d: GaussianBayes(),
    }


def score_of(scored: DataFrame) -> Column:
    """Probability of label 1, or the decision value of a model that has no probability."""
    output = "probability" if "probability" in scored.columns else "rawPrediction"
    return vector_to_array(output)[1]


@dataclass(frozen=True)
class Fit:
    """One model fit: it trains on the rows whose ``fits`` hold ``number`` and is validated on ``fold``."""

    name: str
    number: int
    fold: int
    build: Builder
    tags: dict = field(default_factory=dict)


LEAST_ROWS_PER_TASK, MOST_ROWS_PER_TASK = 10_000, 100_000


def spread(df: DataFrame, rows: int) -> DataFrame:
    """Learners pass over their rows hundreds of times: a table of ``rows`` rows is dealt out evenly, over
    all cores as long as a task has enough rows to be worth its start, and so that the rows of a task stay
    few whatever the size of the table."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = min(rows // LEAST_ROWS_PER_TASK, max(cores, -(-rows // MOST_ROWS_PER_TASK)))
    return df.repartition(max(1, wanted))


def fold_members(df: DataFrame, k: int, seed: int = SEED) -> DataFrame:
    """Add the group fold of each row and the fits it trains: all folds but its own."""
    folded = with_folds(df, k, seed)
    others = F.array_remove(F.sequence(F.lit(0), F.lit(k - 1)), F.col("fold"))
    return staged(folded.withColumn("fits", others), "folded")


def bounded_training(folded: DataFrame, max_fitted: int | None, seed: int = SEED) -> DataFrame:
    """``folded`` with at most ``max_fitted`` training rows per fit, the first in hash order; all rows stay
    for validation."""
    if max_fitted is None:
        return folded
    members = folded.select(F.explode("fits").alias("fit"), seeded_hash(seed, "unit_id").alias(HASH))
    rows = {r["fit"]: r["count"] for r in members.groupBy("fit").count().collect()}
    large = [(fit, max_fitted) for fit, n in rows.items() if n > max_fitted]
    if not large:
        return folded
    wanted = folded.sparkSession.createDataFrame(large, "fit int, want long")
    cuts = {r["fit"]: r["cut"] for r in hash_cuts(members, ["fit"], HASH, wanted, max(rows.values())).collect()}
    inside = [
        F.when(F.array_contains("fits", fit) & (seeded_hash(seed, "unit_id") <= cuts.get(fit, "g")), F.lit(fit)) for fit in rows
    ]
    return staged(folded.withColumn("fits", F.array_compact(F.array(*inside))), "bounded")


def run_fits(
    folded: DataFrame, fits: list[Fit], scaler: str = "standard", parallelism: int = 4, seed: int = SEED, by_fold: bool = False
) -> DataFrame:
    """Fit and score every model; one row per (name, number, held_out) with unweighted metrics.

    ``folded`` must be a stored table with the columns ``fold`` and ``fits``. Only counts per
    distinct score are kept from the scored rows. The rows of a fit are prepared and cached before
    its models learn, and released after them; ``fit_seconds`` is the elapsed time of learning alone,
    while up to ``parallelism`` other fits run. With ``by_fold`` every fit is known to learn from all folds
    but its own, so families that learn sums take the total less the fold and need no pass of their own.
    """
    columns = feature_columns(folded.drop("fold", "fits"))
    specs = fit_specs(folded, columns.numeric, columns.categorical, scaler, fits="fits")
    sizes = {
        r["fit"]: Training(r["rows"], r["weight"])
        for r in folded.select(F.explode("fits").alias("fit"), "weight")
        .groupBy("fit")
        .agg(F.count("*").alias("rows"), F.sum("weight").alias("weight"))
        .collect()
    }
    numbers = sorted({f.number for f in fits})
    summed = [f.build(sizes[f.number]) for f in fits] if by_fold else []
    sums = None
    if any(isinstance(e, (ClassPrior, GaussianBayes)) for e in summed):
        sums = FoldSums(folded, specs, columns.numeric, columns.categorical)

    def learn(fit: Fit, estimator: Estimator, data: DataFrame) -> Model:
        if sums is not None and isinstance(estimator, ClassPrior):
            return sums.prior(fit.fold)
        if sums is not None and isinstance(estimator, GaussianBayes):
            return sums.bayes(fit.fold, specs[fit.number])
        return estimator.fit(data.where("in_training"))

    def prepared(number: int) -> DataFrame:
        """The rows of a fit: those it trains on and those it is validated on, with its own features."""
        held = {f.fold for f in fits if f.number == number}
        mine = folded.where(F.array_contains("fits", number) | F.col("fold").isin(*held))
        ready = with_features(mine.withColumn(EARLY_STOP_MARK, watched(seed)), specs[number])
        return spread(ready, sizes[number].rows).select(
            F.array_contains("fits", number).alias("in_training"),
            "fold",
            F.col("label").cast("double").alias("label"),
            F.col("weight").cast("double").alias("weight"),
            EARLY_STOP_MARK,
            "features",
        )

    def family(number: int) -> list[tuple[int, DataFrame, float]]:
        """The fits that share one preparation, on one cached table."""
        data = prepared(number).persist(KEPT)
        mine = [(i, f) for i, f in enumerate(fits) if f.number == number]
        try:
            data.count()
            built = [f.build(sizes[f.number]) for _, f in mine]
            # boosted models of several settings share their passes over the rows
            together = [i for i, e in enumerate(built) if isinstance(e, LeafwiseBoosting)]
            ready: dict[int, tuple[Model, float]] = {}
            if len(together) > 1:
                start = time.monotonic()
                learned = fit_together([built[i] for i in together], data.where("in_training"))
                ready = {i: (m, (time.monotonic() - start) / len(together)) for i, m in zip(together, learned, strict=True)}
            jobs = [partial(one, f, built[i], ready.get(i), data) for i, (_, f) in enumerate(mine)]
            done = side_by_side(folded.sparkSession, jobs, max(1, parallelism // len(numbers)))
            return [(i, *result) for (i, _), result in zip(mine, done)]
        finally:
            data.unpersist()

    def one(fit: Fit, estimator: Estimator, ready: tuple[Model, float] | None, data: DataFrame) -> tuple[DataFrame, float]:
        start = time.monotonic()
        model, seconds = ready or (learn(fit, estimator, data), 0.0)
        seconds = seconds or time.monotonic() - start
        used = data.where(F.col("in_training") | (F.col("fold") == fit.fold))
        scored = model.transform(used)
        counted = (
            scored.select(
                (~F.col("in_training")).alias("held_out"), "label", "prediction", score_of(scored).alias("score")
            )
            .groupBy("held_out", "label", "prediction", "score")
            .agg(F.count("*").cast("double").alias("rows"))
        )
        return staged(counted, "fit_scores"), seconds

    groups = side_by_side(folded.sparkSession, [partial(family, n) for n in numbers], parallelism)
    done = {i: (table, seconds) for group in groups for i, table, seconds in group}
    tagged = [
        table.select(F.lit(i).alias("run"), "held_out", "label", "prediction", "score", "rows")
        for i, (table, _) in sorted(done.items())
    ]
    scores = reduce(DataFrame.unionByName, tagged)  # stored tables
    keys = ["run", "held_out"]
    metrics = ranking_metrics(scores, keys, weight="rows").join(
        class_metrics(scores, F.col("prediction"), keys, weight="rows").select(*keys, "accuracy", "f1_1"), keys
    )
    about = folded.sparkSession.createDataFrame(
        [
            (i, f.name, f.number, json.dumps(f.tags, sort_keys=True), sizes[f.number].rows, done[i][1])
            for i, f in enumerate(fits)
        ],
        "run int, name string, number int, tags string, train_rows long, fit_seconds double",
    )
    return staged(about.join(metrics, "run").drop("run"), "fit_metrics")


def both_sides(metric: str) -> list[Column]:
    train, held = ~F.col("held_out"), F.col("held_out")
    return [
        F.round(F.avg(F.when(train, F.col(metric))), 4).alias("train_auc"),
        F.round(F.avg(F.when(held, F.col(metric))), 4).alias("validation_auc"),
    ]


def compare(
    train: DataFrame,
    scaler: str = "standard",
    k: int = 5,
    models: dict[str, Builder] | None = None,
    parallelism: int = 4,
    seed: int = SEED,
) -> DataFrame:
    """Group-wise cross-validation of the model families, best first."""
    fits = [Fit(name, i, i, b) for name, b in (models or candidates(seed)).items() for i in range(k)]
    runs = run_fits(fold_members(train, k, seed), fits, scaler, parallelism, seed, by_fold=True)
    held, seen = F.col("held_out"), ~F.col("held_out")

    def mean(metric: str, side: Column, digits: int = 4) -> Column:
        return F.round(F.avg(F.when(side, F.col(metric))), digits)

    table = runs.groupBy(F.col("name").alias("model")).agg(
        mean("roc_auc", held).alias("roc_auc"),
        F.round(F.stddev_pop(F.when(held, F.col("roc_auc"))), 4).alias("roc_auc_sd"),
        mean("roc_auc", seen).alias("train_roc_auc"),
        F.round(F.avg(F.when(seen, F.col("roc_auc"))) - F.avg(F.when(held, F.col("roc_auc"))), 4).alias("train_gap"),
        mean("accuracy", held).alias("accuracy"),
        mean("f1_1", held).alias("f1"),
        mean("average_precision", held).alias("average_precision"),
        mean("fit_seconds", held, 1).alias("fit_seconds"),
    )
    return table.orderBy(F.desc("roc_auc"), "model")


def ablation_table(with_columns: DataFrame, without_columns: DataFrame) -> DataFrame:
    """AUC of each model with and without a group of columns, and the difference."""
    joined = with_columns.select("model", F.col("roc_auc").alias("auc_with")).join(
        without_columns.select("model", F.col("roc_auc").alias("auc_without")), "model"
    )
    return joined.withColumn("difference", F.round(F.col("auc_with") - F.col("auc_without"), 4)).orderBy(
        F.desc("auc_with"), "model"
    )


def ablation(
    train: DataFrame, compared: DataFrame, columns: list[str] | None = None, **options
) -> DataFrame | None:
    """The same comparison on the same rows and folds, without some columns; ``None`` if there are none."""
    present = [c for c in (columns or ENRICHMENT_FEATURES) if c in train.columns]
    return ablation_table(compared, compare(train.drop(*present), **options)) if present else None


def learning_curve(
    train: DataFrame,
    max_fitted: int | None = None,
    k: int = 3,
    steps: int = 6,
    build: Builder | None = None,
    parallelism: int = 4,
    seed: int = SEED,
) -> DataFrame:
    """Training and validation AUC on nested growing parts of the training folds.

    The sizes run from 10% to 100% of the smallest training fold, or of ``max_fitted`` rows if that is
    less; validation rows are never cut. A part is the rows up to a cut in hash order, so each part
    holds the smaller ones.
    """
    folded = fold_members(train, k, seed).withColumn(HASH, seeded_hash(seed, "unit_id"))
    folded = staged(folded, "learning")
    members = folded.select(F.explode("fits").alias("fit"), HASH)
    rows = {r["fit"]: r["rows"] for r in members.groupBy("fit").agg(F.count("*").alias("rows")).collect()}
    smallest = min([*rows.values(), *([max_fitted] if max_fitted else [])])
    sizes = sorted({max(1, int(smallest * (0.1 + 0.9 * s / (steps - 1)))) for s in range(steps)})
    wanted = folded.sparkSession.createDataFrame(
        [(i, size) for i in range(k) for size in sizes], "fit int, want long"
    )
    cuts = {
        (r["fit"], r["want"]): r["cut"]
        for r in hash_cuts(members, ["fit"], HASH, wanted, max(rows.values())).collect()
    }
    parts = [(i * len(sizes) + s, i, size) for i in range(k) for s, size in enumerate(sizes)]
    inside = [
        F.when(F.array_contains("fits", i) & (F.col(HASH) <= cuts[i, size]), F.lit(number))
        for number, i, size in parts
    ]
    nested = staged(folded.withColumn("fits", F.array_compact(F.array(*inside))).drop(HASH), "nested")
    fits = [Fit(str(size), number, i, build or boosting()) for number, i, size in parts]
    runs = run_fits(nested, fits, parallelism=parallelism, seed=seed)
    curve = runs.groupBy(F.col("train_rows")).agg(*both_sides("roc_auc"))
    return curve.withColumn("gap", F.round(F.col("train_auc") - F.col("validation_auc"), 4)).orderBy("train_rows")


def validation_curve(
    train: DataFrame,
    max_fitted: int | None = None,
    k: int = 3,
    leaves: tuple[int, ...] = (4, 8, 15, 31, 63, 127),  # fixed values
    rounds: int = 100,
    parallelism: int = 4,
    seed: int = SEED,
) -> DataFrame:
    """Training and validation AUC by model complexity; ``max_fitted`` bounds the rows a model learns from."""
    folded = bounded_training(fold_members(train, k, seed), max_fitted, seed)
    fits = [Fit(str(m), i, i, boosting(rounds, leaves=m)) for m in leaves for i in range(k)]
    runs = run_fits(folded, fits, parallelism=parallelism, seed=seed)
    curve = runs.groupBy(F.col("name").cast("int").alias("max_leaves")).agg(*both_sides("roc_auc"))
    return curve.orderBy("max_leaves")


# The search space.
SEARCH_SPACE = {
    "rate": [0.03, 0.05, 0.1, 0.2],
    "rounds": [150, 300, 500],
    "leaves": [4, 8, 15, 31, 63],
    "min_leaf": [20, 50, 100],
    "l2": [0.0, 0.1, 1.0],
}


def random_search(
    train: DataFrame,
    n_iter: int = 10,
    k: int = 3,
    space: dict[str, list] | None = None,
    parallelism: int = 4,
    seed: int = SEED,
) -> DataFrame:
    """Mean validation AUC of a seeded draw of parameter combinations, best first."""
    space = space or SEARCH_SPACE
    grid = [dict(zip(space, values)) for values in itertools.product(*space.values())]
    drawn = random.Random(seed).sample(grid, min(n_iter, len(grid)))
    fits = [
        Fit(f"draw_{j}", i, i, boosting(**params), params) for j, params in enumerate(drawn) for i in range(k)
    ]
    runs = run_fits(fold_members(train, k, seed), fits, parallelism=parallelism, seed=seed)
    scores = runs.where("held_out").groupBy("name", "tags").agg(F.round(F.avg("roc_auc"), 4).alias("roc_auc"))
    kinds = {float: "double", int: "int"}
    schema = ", ".join(f"{p} {kinds[type(v[0])]}" for p, v in space.items())
    return scores.select("name", F.from_json("tags", schema).alias("p"), "roc_auc").select(
        "name", "p.*", "roc_auc"
    ).orderBy(F.desc("roc_auc"), "name")


def best_row(table: DataFrame, metric: str, prefer: str) -> DataFrame:
    """The row with the highest ``metric``; of equal ones the smallest ``prefer``."""
    return table.orderBy(F.desc(metric), prefer).limit(1)


def last_step(curve: DataFrame, size: str = "train_rows", metric: str = "validation_auc") -> DataFrame:
    """What the last step of an ordered curve adds: growth in percent and gain in the metric."""
    last = F.slice(F.sort_array(F.collect_list(F.struct(size, metric))), -2, 2)
    before, after = F.col("ends")[0], F.col("ends")[1]
    return curve.agg(last.alias("ends")).select(
        before[size].alias("rows_before"),
        after[size].alias("rows_after"),
        (100 * (after[size] / before[size] - 1)).alias("growth_pct"),
        (after[metric] - before[metric]).alias("gain"),
    )


def fit_pipeline(train: DataFrame, build: Builder, scaler: str = "standard", seed: int = SEED) -> PipelineModel:
    """Preparation and model learned as one object that can be saved and applied to new rows."""
    columns = feature_columns(train)
    size = train.agg(F.count("*"), F.sum("weight")).first()
    estimator = build(Training(size[0], size[1]))
    if isinstance(estimator, ClassPrior):
        return PipelineModel(stages=[estimator.fit(train)])  # it doesn't look at features
    prep = TabularPrep(numericCols=columns.numeric, categoricalCols=columns.categorical, scaler=scaler).fit(train)
    ready = prep.transform(train.withColumn(EARLY_STOP_MARK, watched(seed))).select(
        F.col("label").cast("double").alias("label"), F.col("weight").cast("double").alias("weight"), EARLY_STOP_MARK, "features"
    )
    ready = spread(ready, size[0]).persist(KEPT)
    try:
        return PipelineModel(stages=[prep, estimator.fit(ready)])
    finally:
        ready.unpersist()


def score_rows(model: PipelineModel, df: DataFrame) -> DataFrame:
    """``df`` with the ``score`` of a fitted pipeline: batch scoring."""
    scored = model.transform(df)
    return scored.select(*df.columns, score_of(scored).alias("score"))


def feature_names(model: PipelineModel) -> list[str]:
    prep = model.stages[0]
    assert isinstance(prep, TabularPrepModel)
    return prep.feature_names()


def out_of_fold(
    df: DataFrame, build: Builder, k: int = 3, scaler: str = "standard", parallelism: int = 3, seed: int = SEED
) -> DataFrame:
    """``df`` with a ``score`` from models that never saw the row's group."""
    folded = fold_members(df, k, seed)
    columns = feature_columns(df)
    specs = fit_specs(folded, columns.numeric, columns.categorical, scaler, fits="fits")

    def one(i: int) -> DataFrame:
        ready = with_features(folded.withColumn(EARLY_STOP_MARK, watched(seed)), specs[i])
        train = ready.where(F.col("fold") != i).select("label", "weight", EARLY_STOP_MARK, "features")
        size = train.agg(F.count("*"), F.sum("weight")).first()
        train = spread(train, size[0]).persist(KEPT)
        try:
            model = build(Training(size[0], size[1])).fit(train)
        finally:
            train.unpersist()
        scored = model.transform(ready.where(F.col("fold") == i))
        return scored.select(*df.columns, "fold", score_of(scored).alias("score"))

    parts = side_by_side(df.sparkSession, [partial(one, i) for i in range(k)], parallelism)
    return staged(reduce(DataFrame.unionByName, parts), "out_of_fold")


def gaussian_parameters(df: DataFrame, columns: list[str], label: str = "label", weight: str = "weight") -> DataFrame:
    """Weighted mean and variance per label and column, and the weighted prior: what a Gaussian naive
    Bayes learns. Variances are summed around the overall mean to keep them exact."""
    centres = df.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in columns]).first()
    cells = [
        F.struct(F.lit(c).alias("column_name"), F.lit(float(centres[c])).alias("centre"), (F.col(c) - F.lit(float(centres[c]))).alias("x"))
        for c in columns
    ]
    w = F.col(weight)
    long = df.select(F.col(label).alias("label"), w.cast("double").alias("w"), F.inline(F.array(*cells)))
    sums = long.dropna(subset=["x"]).groupBy("label", "column_name", "centre").agg(
        F.sum("w").alias("w"),
        F.try_divide(F.sum(F.col("w") * F.col("x")), F.sum("w")).alias("shift"),
        F.try_divide(F.sum(F.col("w") * F.col("x") * F.col("x")), F.sum("w")).alias("square"),
    )
    return sums.select(
        "label",
        "column_name",
        (F.col("centre") + F.col("shift")).alias("mean"),
        (F.col("square") - F.col("shift") * F.col("shift")).alias("variance"),
        F.col("w").alias("weight"),
    )
