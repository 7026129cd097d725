"""Why a model says what it says: permutation importance and Shapley contributions."""

from __future__ import annotations

import random
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import DecisionTreeClassificationModel, RandomForestClassificationModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forerate.contracts import feature_columns
from forerate.functions.ordering import running_sums
from forerate.functions.scalars import round_half_even, seeded_hash
from forerate.operators.metrics import roc_areas
from forerate.operators.boosting import BoostedTrees, Tree
from forerate.operators.forest import ForestTrees
from forerate.operators.linear import LinearModel
from forerate.operators.models import feature_names, score_rows
from forerate.operators.prep import feature_owners
from forerate.operators.sampling import HASH, simple_sample
from forerate.sources.staging import new_path, ship_package, staged

#: Rows whose scores are put in order at a time.
SLICE_ROWS = 250_000


def permutation_importance(
    model: PipelineModel, test: DataFrame, n: int | None = None, repeats: int = 5, seed: int = 42
) -> DataFrame:
    """Mean drop of the weighted AUC when one column is shuffled, largest first.

    Rows are put in hash order, which is a random order. In each repeat a row takes the value of the
    row a fixed, randomly drawn distance further on (cyclically), so every value is used exactly
    once. The donor row is joined once per repeat; all columns are then scored together. Of a boosted
    model only the trees that look at the shuffled column are scored again, and of them only rows whose donor
    is on the other side of a cut. All rows are used unless ``n`` asks for a sample.
    """
    columns = [c for part in (feature_columns(test).numeric, feature_columns(test).categorical) for c in part]
    rows = intact = test if n is None else simple_sample(test, n, seed)
    held, scored = columns, whole_copies
    if isinstance(model.stages[-1], BoostedTrees):
        rows = model.stages[0].transform(rows).withColumn("x", vector_to_array("features"))
        held, scored = ["x"], affected_trees
    rows = staged(rows.select(*held, "label", "weight", seeded_hash(seed, "unit_id").alias(HASH), F.lit(1).alias("one")), "rows")
    placed = running_sums(rows, [], [(HASH, True)], ["one"], stage=False)
    placed = staged(placed.select(*held, "label", "weight", F.col("one_before").alias("place")), "placed")
    total = rows.count()
    draw = random.Random(seed)
    shifts = [draw.randrange(1, total) for _ in range(repeats)] if total > 1 else []

    moves = F.explode(F.array(*[F.struct(F.lit(r).alias("repeat"), F.lit(s).alias("shift")) for r, s in enumerate(shifts)]))
    wanted = placed.select("*", moves.alias("m")).select(
        *held, "label", "weight", "m.repeat", ((F.col("place") + F.col("m.shift")) % total).alias("place")
    )
    donors = placed.select("place", F.struct(*held).alias("donor"))
    slices = -(-total // SLICE_ROWS)
    # of the scores as they are; where shuffled ones lie elsewhere, slices are only less even
    cuts = score_rows(model, intact).approxQuantile("score", [i / slices for i in range(1, slices)], 0.1 / slices) if slices > 1 else []
    auc = staged(roc_areas(scored(model, wanted.join(donors, "place"), placed, columns), ["column_name", "repeat"], cuts), "shuffled_auc")
    full = auc.where(F.col("repeat") < 0).first()["roc_auc"]
    every = test.sparkSession.createDataFrame([(c,) for c in columns], "column_name string")
    drops = auc.where(F.col("repeat") >= 0).groupBy("column_name").agg(F.avg("roc_auc").alias("mean"))
    # a column that nothing looks at drops nothing
    drop = F.lit(full) - F.coalesce("mean", F.lit(full))
    return (
        every.join(drops, "column_name", "left")
        .select("column_name", round_half_even(drop, 5).alias("importance"))
        .orderBy(F.desc("importance"), "column_name")
    )


def whole_copies(model: PipelineModel, wanted: DataFrame, placed: DataFrame, columns: list[str]) -> DataFrame:
    """Scores of every row with each column in turn from its donor, and of the rows as they are (repeat -1)."""
    copies = [
        F.struct(
            F.lit(shuffled).alias("column_name"),
            *[(F.col(f"donor.{c}") if c == shuffled else F.col(c)).alias(c) for c in columns],
        )
        for shuffled in columns
    ]
    stacked = wanted.select("label", "weight", "repeat", F.inline(F.array(*copies)))
    intact = placed.select("label", "weight", F.lit(-1).alias("repeat"), F.lit("").alias("column_name"), *columns)
    return score_rows(model, stacked.unionByName(intact))


def affected_trees(model: PipelineModel, wanted: DataFrame, placed: DataFrame, columns: list[str]) -> DataFrame:
    """The same of a boosted model from prepared features: a copy's score is the row's, with the trees scored
    again that look at a feature of the shuffled column. Columns that no tree looks at have no rows."""
    boosted, spec = model.stages[-1], model.stages[0].learned()
    ship_package(wanted.sparkSession)
    trees, start = boosted.trees(), boosted.start()
    owner = feature_owners(spec)
    looked_at = [{owner[f] for f in t.feature[t.left >= 0].tolist()} for t in trees]
    used = [c for c in columns if any(c in at for at in looked_at)]
    features = {c: [i for i, o in enumerate(owner) if o == c] for c in used}
    lists = {c: [i for i, at in enumerate(looked_at) if c in at] for c in used}
    inner = [set(zip(t.feature[t.left >= 0].tolist(), t.cut[t.left >= 0].tolist())) for t in trees]
    asked = {(c, i): [(f, v) for f, v in inner[i] if owner[f] == c] for c in used for i in lists[c]}
    cuts = {c: {cut for i in lists[c] for cut in asked[c, i]} for c in used}

    @F.arrow_udf("array<double>")
    def scores(own: pa.Array, donor: pa.Array) -> pa.Array:
        n = len(own)
        if not n:
            return pa.array([], pa.list_(pa.float64()))
        x, other = (np.asarray(v.flatten()).reshape(n, -1) for v in (own, donor))
        by_tree = np.stack([t.scores(x) for t in trees], axis=1) if trees else np.zeros((n, 0))
        out = np.empty((n, len(used) + 1))
        out[:, -1] = start + by_tree.sum(axis=1)
        for at, c in enumerate(used):
            mixed, again = x.copy(), by_tree.copy()
            mixed[:, features[c]] = other[:, features[c]]
            beyond = {(f, v): (x[:, f] <= v) != (other[:, f] <= v) for f, v in cuts[c]}
            for i in lists[c]:
                # only a donor on the other side of one of the tree's cuts can change its score
                moved = np.flatnonzero(np.logical_or.reduce([beyond[cut] for cut in asked[c, i]]))
                again[moved, i] = trees[i].scores(mixed[moved])
            out[:, at] = start + again.sum(axis=1)  # added up in the same order, so that equal scores stay equal
        return pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * out.shape[1], pa.int32()), pa.array(out.ravel()))

    def opened(rows: DataFrame, names: list[str], at: list[int]) -> DataFrame:
        cells = [F.struct(F.lit(c).alias("column_name"), F.get("m", i).alias("m")) for c, i in zip(names, at, strict=True)]
        rows = rows.select("label", "weight", "repeat", F.inline(F.array(*cells)))
        return rows.select("label", "weight", "repeat", "column_name", (1 / (1 + F.exp(-F.col("m")))).alias("score"))

    intact = placed.select("label", "weight", F.lit(-1).alias("repeat"), scores("x", "x").alias("m"))
    intact = opened(intact, [""], [len(used)])
    if not used:
        return intact
    moved = wanted.select("label", "weight", "repeat", scores("x", "donor.x").alias("m"))
    return opened(moved, used, list(range(len(used)))).unionByName(intact)


TreeModel = BoostedTrees | ForestTrees | DecisionTreeClassificationModel | RandomForestClassificationModel


def stored_trees(model: DecisionTreeClassificationModel | RandomForestClassificationModel, spark) -> list[Tree]:
    """The trees of a model of the ML library, whose leaves hold their share of a probability.

    The saved model is read as a table; its size is that of the model, not of the data.
    """
    path = new_path(spark, "trees")
    model.write().save(path)
    single = isinstance(model, DecisionTreeClassificationModel)
    fields = ["id", "impurityStats", "leftChild", "rightChild", "split"]
    table = spark.read.parquet(f"{path}/data")
    table = table.select(F.lit(0).alias("treeID"), *fields) if single else table.select("treeID", *[f"nodeData.{f}" for f in fields])
    trees: dict[int, list] = {}
    for r in table.orderBy("treeID", "id").collect():
        trees.setdefault(r["treeID"], []).append(r)
    out = []
    for nodes in trees.values():
        inner = [r["leftChild"] >= 0 for r in nodes]
        stats = [r["impurityStats"] for r in nodes]
        out.append(
            Tree(
                feature=[r["split"]["featureIndex"] if i else 0 for r, i in zip(nodes, inner)],
                cut=[r["split"]["leftCategoriesOrThreshold"][0] if i else 0.0 for r, i in zip(nodes, inner)],
                left=[r["leftChild"] for r in nodes],
                right=[r["rightChild"] for r in nodes],
                value=[0.0 if i else s[1] / sum(s) / len(trees) for s, i in zip(stats, inner)],
                count=[sum(s) for s in stats],
            )
        )
    return out


def leaf_paths(trees: list[Tree]) -> list[dict]:
    """Every leaf with the interval and the cover share of each feature on its path."""
    leaves: list[dict] = []

    def walk(tree: Tree, at: int, path: dict) -> None:
        if tree.left[at] < 0:
            leaves.append({"value": tree.value[at], "path": path})
            return
        feature, cut = int(tree.feature[at]), tree.cut[at]
        low, high, share = path.get(feature, (-np.inf, np.inf, 1.0))
        for child, ends in ((tree.left[at], (low, min(high, cut))), (tree.right[at], (max(low, cut), high))):
            walk(tree, child, {**path, feature: (*ends, share * tree.count[child] / tree.count[at])})

    for tree in trees:
        walk(tree, 0, {})
    return leaves


def leaf_game(leaf: dict) -> dict:
    """A leaf's path as arrays: features, the interval and cover share of each, and the leaf's value."""
    low, high, share = (np.array(v, dtype=float) for v in zip(*leaf["path"].values()))
    value = leaf["value"]
    return {"features": list(leaf["path"]), "low": low, "high": high, "share": share, "value": value, "base": value * share.prod()}


def shapley(game: dict, holds: np.ndarray) -> np.ndarray:
    """Shapley values of one leaf's features for rows that say which path conditions hold.

    A feature whose condition holds passes the row on fully, a feature left out passes on its cover
    share. The products over all sets of the other features are summed by size of the set.
    """
    share, (rows, d) = game["share"], holds.shape
    chance = np.array([1.0])
    for s in range(1, d):
        chance = np.append(chance, chance[-1] * s / (d - s))
    out = np.zeros((rows, d))
    for j in range(d):
        sets = np.zeros((rows, d))
        sets[:, 0] = 1.0
        for i in range(d):
            if i != j:
                grown = sets * share[i]
                grown[:, 1:] += sets[:, :-1] * holds[:, [i]]
                sets = grown
        out[:, j] = game["value"] * (holds[:, j] - share[j]) * (sets @ (chance / d))
    return out


def contributions(model: PipelineModel, df: DataFrame, key: str = "unit_id", background: DataFrame | None = None) -> tuple[DataFrame, float]:
    """(key, features, contributions) and the expected value that the contributions add up from.

    By kind of model: linear models in closed form, tree models by their leaves. Contributions add up to
    the margin (log-odds, or decision value of the support vector machine) of a linear or boosted model,
    and to the probability of a tree or forest.
    """
    last = model.stages[-1]
    ready = model.stages[0].transform(df).select(key, vector_to_array("features").alias("features"))
    if isinstance(last, LinearModel):
        return linear_contributions(last, ready, ready if background is None else model.stages[0].transform(background).select(vector_to_array("features").alias("features")))
    if isinstance(last, TreeModel):
        return tree_contributions(last, ready)
    raise TypeError(f"no contributions of a {type(last).__name__}")


def linear_contributions(model: LinearModel, ready: DataFrame, background: DataFrame) -> tuple[DataFrame, float]:
    """What a feature adds by being off its mean in ``background``: ``coefficient * (x - mean)``, one projection."""
    weights, intercept = model.weights(), model.getOrDefault(model.intercept)
    means = background.agg(F.array(*[F.avg(F.get("features", i)) for i in range(len(weights))])).first()[0]
    means = [m or 0.0 for m in means]
    parts = [F.lit(c) * (F.get("features", i) - F.lit(m)) for i, (c, m) in enumerate(zip(weights, means, strict=True))]
    return ready.withColumn("contributions", F.array(*parts)), intercept + sum(c * m for c, m in zip(weights, means))


def tree_contributions(model: TreeModel, ready: DataFrame) -> tuple[DataFrame, float]:
    """Shapley values of tree models.

    The leaves are sent to the executors once; they are as many as the model has. A batch computes
    the values of each pattern of conditions that its rows show, once.
    """
    spark = ready.sparkSession
    ship_package(spark)
    own = isinstance(model, (BoostedTrees, ForestTrees))
    leaves = leaf_paths(model.trees() if own else stored_trees(model, spark))
    expected = (model.start() if own else 0.0) + sum(leaf["value"] for leaf in leaves if not leaf["path"])
    games = [leaf_game(leaf) for leaf in leaves if leaf["path"]]
    expected += sum(g["base"] for g in games)
    sent = spark.sparkContext.broadcast(games)

    @F.pandas_udf("array<double>")
    def explain(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            if not len(batch):
                yield pd.Series([], dtype=object)
                continue
            x = np.stack(batch.to_numpy())
            phi = np.zeros_like(x)
            for g in sent.value:
                part = x[:, g["features"]]
                holds = (part > g["low"]) & (part <= g["high"])
                _, first, of = np.unique(np.packbits(holds, axis=1), axis=0, return_index=True, return_inverse=True)
                phi[:, g["features"]] += shapley(g, holds[first].astype(float))[of.ravel()]
            yield pd.Series(list(phi))

    return ready.withColumn("contributions", explain("features")), float(expected)


def contribution_rows(model: PipelineModel, df: DataFrame, features: list[str] | None = None, key: str = "unit_id") -> DataFrame:
    """Long table (key, column_name, value, contribution) for charts of effect and dependence."""
    names = feature_names(model)
    table, _ = contributions(model, df, key)
    cells = F.arrays_zip(F.array(*[F.lit(n) for n in names]).alias("column_name"), F.col("features").alias("value"), F.col("contributions").alias("contribution"))
    long = table.select(key, F.inline(cells))
    return long.where(F.col("column_name").isin(features)) if features else long


def mean_abs_contribution(model: PipelineModel, df: DataFrame, n: int | None = None, seed: int = 42) -> DataFrame:
    """Mean absolute contribution of each prepared feature, largest first, over all rows or a sample."""
    return mean_abs_of(contribution_rows(model, df if n is None else simple_sample(df, n, seed)))


def mean_abs_of(rows: DataFrame) -> DataFrame:
    """Mean absolute contribution by feature, from the long table."""
    return (
        rows.groupBy("column_name")
        .agg(round_half_even(F.avg(F.abs("contribution")), 5).alias("mean_abs_contribution"))
        .orderBy(F.desc("mean_abs_contribution"), "column_name")
    )


def top_agreement(first: DataFrame, second: DataFrame, first_value: str, second_value: str) -> DataFrame:
    """The leader of two rankings and whether they agree."""
    lead = F.max_by("column_name", F.struct(first_value, F.col("column_name"))).alias("first_leader")
    other = F.max_by("column_name", F.struct(second_value, F.col("column_name"))).alias("second_leader")
    a = first.agg(lead).withColumn("_all", F.lit(0))
    b = second.agg(other).withColumn("_all", F.lit(0))
    return a.join(b, "_all").select(
        "first_leader", "second_leader", (F.col("first_leader") == F.col("second_leader")).alias("agree")
    )
