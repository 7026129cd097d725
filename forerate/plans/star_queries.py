"""Every job of the package, bound to the star-schema test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forerate.contracts import CATEGORICAL_FEATURES, ENRICHMENT_FEATURES, NUMERIC_FEATURES
from forerate.functions.ordering import running_sums
from forerate.functions.scalars import unpivot
from forerate.operators import context, explain, linear, metrics, models, prep, profiling, risk, sampling, segments
from forerate.operators.context import UNIT_KEYS
from forerate.plans import reports
from forerate.sources import star
from forerate.sources.staging import forget_with_staging, new_path, staged, staging_folder

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SEED = 42


def query(fn: Query) -> Query:
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Doubles at a fixed number of digits (ties away from zero, on the binary value)."""

    def fixed(c: str) -> Column:
        size = F.floor(F.abs(c) * 10.0**digits + 0.5).cast("double") / 10.0**digits
        return F.when(F.col(c) < 0, -size).otherwise(size).alias(c)

    return df.select(*[fixed(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes])


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The base with a fixed score, for the metrics."""
    return star.base(spark, sf_dir).withColumnRenamed("fixed_score", "score")


# --- feature table -------------------------------------------------------------------------------


@query
def analytical_base(spark, sf_dir):
    return rounded(star.fresh_base(spark, sf_dir))


@query
def municipal_context(spark, sf_dir):
    rates, official = star.stored_group_indicator(spark, sf_dir), star.stored_published(spark, sf_dir)
    return rounded(context.group_context(star.units(spark, sf_dir), rates, official, star.BASE_YEAR))


@query
def region_context(spark, sf_dir):
    return rounded(context.region_context(star.stored_region_indicator(spark, sf_dir), star.BASE_YEAR))


@query
def target_fallback(spark, sf_dir):
    t = star.stored_region_indicator(spark, sf_dir)
    return rounded(context.region_targets(t, star.TARGET_YEAR, star.WHOLE_NETWORK))


@query
def national_target_gap(spark, sf_dir):
    nation = context.national_target(star.stored_nation(spark, sf_dir), star.TARGET_YEAR, star.WHOLE_NETWORK)
    targets = context.group_targets(star.stored_group_indicator(spark, sf_dir), star.TARGET_YEAR)
    return rounded(targets.withColumn("gap_target_national", F.col("target") - F.lit(nation)))


@query
def national_and_region_targets(spark, sf_dir):
    nation = star.stored_nation(spark, sf_dir).where(F.col("year") == star.TARGET_YEAR).select(
        F.lit("nation").alias("level"), F.lit("").alias("place"), "network", "target"
    )
    region = context.region_targets(star.stored_region_indicator(spark, sf_dir), star.TARGET_YEAR, star.WHOLE_NETWORK).select(
        F.lit("region1").alias("level"), F.col("region1").alias("place"), "network", F.col("region_target").alias("target")
    )
    group = context.group_targets(star.stored_group_indicator(spark, sf_dir), star.TARGET_YEAR).select(
        F.lit("group").alias("level"), F.col("group_id").alias("place"), "network", "target"
    )
    return rounded(nation.unionByName(region).unionByName(group))


@query
def enrichment_asof_ceiling(spark, sf_dir):
    return rounded(star.stored_extract(spark, sf_dir), 4)


@query
def vintage_violations(spark, sf_dir):
    """An extract made a year too late, checked against the ceilings of the base year."""
    return context.vintage_violations(star.stored_extract(spark, sf_dir, star.TARGET_YEAR), star.BASE_YEAR)


@query
def reserve_coverage(spark, sf_dir):
    rates, official = star.stored_group_indicator(spark, sf_dir), star.stored_published(spark, sf_dir)
    return rounded(context.reserve_coverage(rates, official, star.BASE_YEAR))


@query
def key_stability(spark, sf_dir):
    return rounded(context.key_stability(star.units(spark, sf_dir), star.BASE_YEAR, star.TARGET_YEAR))


# --- profile -------------------------------------------------------------------------------------


@query
def column_coverage(spark, sf_dir):
    df = star.base(spark, sf_dir).drop("fixed_score")
    return profiling.column_coverage(df)


@query
def label_share(spark, sf_dir):
    return rounded(profiling.label_share(star.base(spark, sf_dir)))


@query
def rate_by_category(spark, sf_dir):
    df = star.base(spark, sf_dir)
    return rounded(profiling.rate_by_category(df, ["region2", "region1", "network"], min_rows=500))


@query
def best_worst_region(spark, sf_dir):
    rates = profiling.rate_by_category(star.base(spark, sf_dir), ["region1"])
    return rounded(profiling.best_and_worst(rates))


@query
def label_correlations(spark, sf_dir):
    return profiling.label_correlations(star.base(spark, sf_dir), NUMERIC_FEATURES)


@query
def correlation_matrix(spark, sf_dir):
    return rounded(profiling.correlation_matrix(star.base(spark, sf_dir), [*NUMERIC_FEATURES, "label"]))


@query
def context_vs_outcome_bins(spark, sf_dir):
    df = star.base(spark, sf_dir)
    return rounded(profiling.binned_rate(df, ["group_rate_prior_year", "region_rate_prior_year"]))


@query
def histogram_40(spark, sf_dir):
    return rounded(profiling.histograms(star.base(spark, sf_dir), NUMERIC_FEATURES[:6]), 4)


# --- samples, split, folds -----------------------------------------------------------------------


@query
def stratified_sample(spark, sf_dir):
    df = star.base(spark, sf_dir)
    return sampling.stratified_sample(df, df.count() // 4, SEED).select("unit_id", "label")


@query
def simple_sample(spark, sf_dir):
    df = star.base(spark, sf_dir)
    return sampling.simple_sample(df, df.count() // 4, SEED).select("unit_id")


@query
def group_split(spark, sf_dir):
    df = sampling.group_split(star.base(spark, sf_dir), 0.25, SEED)
    return df.select("unit_id", "group_id", F.col("is_test").cast("int").alias("is_test"))


@query
def split_leak_check(spark, sf_dir):
    df = sampling.group_split(star.base(spark, sf_dir), 0.25, SEED)
    train, test = df.where(~F.col("is_test")), df.where("is_test")
    shared = sampling.shared_groups(train, test)
    sides = df.agg(
        F.countDistinct(F.when(~F.col("is_test"), F.col("group_id"))).alias("train_groups"),
        F.countDistinct(F.when(F.col("is_test"), F.col("group_id"))).alias("test_groups"),
    )
    return sides.withColumn("shared_groups", F.lit(shared.count()))


@query
def group_folds(spark, sf_dir):
    return sampling.group_folds(star.base(spark, sf_dir), 5, SEED)


# --- metrics on a fixed score --------------------------------------------------------------------


@query
def weighted_roc_auc(spark, sf_dir):
    return rounded(metrics.ranking_metrics(scored(spark, sf_dir), ["region2"]).select("region2", "roc_auc"))


@query
def weighted_average_precision(spark, sf_dir):
    return rounded(metrics.ranking_metrics(scored(spark, sf_dir)).select("average_precision"))


@query
def accuracy_brier(spark, sf_dir):
    df = scored(spark, sf_dir)
    accuracy = metrics.class_metrics(df, metrics.guess_at(0.62), ["region2"]).select("region2", "accuracy")
    return rounded(accuracy.join(metrics.brier_score(df, ["region2"]), "region2"))


@query
def class_metrics(spark, sf_dir):
    return rounded(metrics.class_metrics(scored(spark, sf_dir), metrics.guess_at(0.62)))


@query
def recall_threshold(spark, sf_dir):
    df = metrics.recall_by_threshold(scored(spark, sf_dir), 0.7)
    return rounded(df.withColumn("chosen", F.col("chosen").cast("int")))


@query
def confusion_matrix(spark, sf_dir):
    return rounded(metrics.confusion_matrix(scored(spark, sf_dir), metrics.guess_at(0.62)))


@query
def calibration_deciles(spark, sf_dir):
    return rounded(metrics.calibration(scored(spark, sf_dir)))


@query
def roc_pr_points(spark, sf_dir):
    return rounded(metrics.curve_points(scored(spark, sf_dir)))


# --- preparation and what simple models learn ----------------------------------------------------


@query
def imputer_params(spark, sf_dir):
    counts = prep.value_counts(star.base(spark, sf_dir), NUMERIC_FEATURES, CATEGORICAL_FEATURES)
    numbers = prep.numeric_parameters(counts).select(
        "column_name", F.col("median").alias("fill_value"), F.lit(None).cast("string").alias("fill_level")
    )
    levels = prep.category_levels(counts).where("is_filler").select(
        "column_name", F.lit(None).cast("double").alias("fill_value"), F.col("level").alias("fill_level")
    )
    return rounded(numbers.unionByName(levels))


@query
def missing_flags(spark, sf_dir):
    """Columns that get a missing flag, and the share of rows it marks."""
    counts = prep.value_counts(star.base(spark, sf_dir), NUMERIC_FEATURES, [])
    table = prep.numeric_parameters(counts).where(F.col("missing") > 0)
    flag = F.concat(F.lit(prep.FLAG_PREFIX), "column_name").alias("feature")
    return rounded(table.select(flag, "missing", (F.col("missing") / F.col("rows")).alias("share")))


@query
def scaler_params(spark, sf_dir):
    """Centre and scale of both scalers after gaps are filled."""
    counts = prep.value_counts(star.base(spark, sf_dir), NUMERIC_FEATURES, [])
    table = prep.numeric_parameters(counts)
    return rounded(
        table.select("column_name", "mean", "std", "median", (F.col("p75") - F.col("p25")).alias("iqr")), 4
    )


@query
def one_hot_rare(spark, sf_dir):
    counts = prep.value_counts(star.base(spark, sf_dir), [], CATEGORICAL_FEATURES)
    levels = prep.category_levels(counts).drop("fit")
    return levels.select("column_name", "level", "rows", *[F.col(c).cast("int").alias(c) for c in ("is_filler", "is_rare")])


@query
def prepared_features(spark, sf_dir):
    """The prepared features of every row, summed up per feature."""
    df = star.base(spark, sf_dir)
    spec = prep.fit_specs(df, NUMERIC_FEATURES, CATEGORICAL_FEATURES)[prep.ALL]
    wide = df.select(*[x.alias(name) for name, x in prep.feature_expressions(spec).items()])
    long = unpivot(wide, wide.columns, "feature", "x", [], "double")
    sums = long.groupBy("feature").agg(F.sum(F.col("x") * F.col("x")).alias("squares"), F.max("x").alias("highest"))
    return rounded(sums, 4)


@query
def baseline_prior(spark, sf_dir):
    """The class-prior model on the train side: its score, and its accuracy and F1 on the test side."""
    df = sampling.group_split(star.base(spark, sf_dir), 0.25, SEED)
    model = models.ClassPrior().fit(df.where("NOT is_test"))
    scores = model.transform(df.where("is_test")).withColumn("score", F.lit(model.getOrDefault(model.share)))
    table = metrics.class_metrics(scores, F.col("prediction"), weight=None)
    return rounded(table.select(F.lit(model.getOrDefault(model.share)).alias("score"), "accuracy", F.col("f1_1").alias("f1")))


@query
def gaussian_nb_params(spark, sf_dir):
    columns = ["group_rate_prior_year", "region_rate_prior_year", "target"]
    return rounded(models.gaussian_parameters(star.base(spark, sf_dir), columns), 4)


# --- risk and profiles ---------------------------------------------------------------------------


def units_at_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unit table from the fixed score."""
    return star.stored(spark, sf_dir, "unit_risk", lambda: risk.unit_risk(scored(spark, sf_dir)))


def fixed_profiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units with z-scores and a fixed assignment: the quarter of the scale the predicted rate is in."""
    units = segments.profile_matrix(units_at_risk(spark, sf_dir))
    half = F.when(F.col("predicted_rate") >= 55, 2).otherwise(0)
    return units.withColumn("profile", half + F.when(F.col("no_target") | (F.col("target") >= 60), 1).otherwise(0))


@query
def unit_risk(spark, sf_dir):
    df = risk.unit_risk(scored(spark, sf_dir))
    flags = [F.col(c).cast("int").alias(c) for c in ("no_target", "at_risk")]
    return rounded(df.select(*[c for c in df.columns if c not in ("no_target", "at_risk")], *flags))


@query
def top_risk_units(spark, sf_dir):
    named = risk.with_names(risk.top_risk(units_at_risk(spark, sf_dir)), star.names(spark, sf_dir))
    return rounded(named.select("group_id", "group_name", "region1", "region1_dim", "network", "predicted_rate", "target", "rows"))


@query
def risk_by_region(spark, sf_dir):
    return risk.risk_by_region(units_at_risk(spark, sf_dir))


@query
def risk_summary(spark, sf_dir):
    return risk.risk_summary(units_at_risk(spark, sf_dir))


@query
def rate_error_vs_naive(spark, sf_dir):
    return risk.rate_errors(units_at_risk(spark, sf_dir))


@query
def contradictory_units(spark, sf_dir):
    """Targets and history must be the same for everybody in a unit: no rows."""
    return risk.contradictory_units(star.base(spark, sf_dir))


@query
def profile_matrix(spark, sf_dir):
    return rounded(segments.profile_matrix(units_at_risk(spark, sf_dir)).select("group_id", "network", *segments.DIMS))


@query
def cluster_inertia(spark, sf_dir):
    return rounded(segments.inertia(fixed_profiles(spark, sf_dir)))


@query
def silhouette_sq(spark, sf_dir):
    return rounded(segments.silhouette(fixed_profiles(spark, sf_dir)))


@query
def silhouette_euclid(spark, sf_dir):
    """By Euclidean distance; all units are compared with all, so there is no error of sampling."""
    width, error = segments.euclidean_silhouette(fixed_profiles(spark, sf_dir), ["profile"])["profile"]
    return rounded(spark.createDataFrame([(width, error)], "silhouette double, error double"))


@query
def davies_bouldin(spark, sf_dir):
    return rounded(segments.davies_bouldin(fixed_profiles(spark, sf_dir)))


@query
def profile_summary(spark, sf_dir):
    """Profile table, next to the number of units that carry each name."""
    assigned = fixed_profiles(spark, sf_dir)
    summary = segments.profile_summary(assigned)
    named = segments.with_profile_names(assigned, summary).groupBy("profile_name").agg(F.count("*").alias("named_units"))
    return summary.join(named, "profile_name")


# --- selections over result tables ---------------------------------------------------------------


def step_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A curve derived from the data: Brier score of the fixed score as one form after the other is added."""
    miss = F.col("score") - F.col("label")
    sums = scored(spark, sf_dir).groupBy("form").agg(
        F.count("*").alias("n"), F.sum("weight").alias("w"), F.sum(F.col("weight") * miss * miss).alias("e")
    )
    steps = running_sums(sums, [], [("form", True)], ["n", "w", "e"])
    upto = {c: F.col(f"{c}_before") + F.col(c) for c in ("n", "w", "e")}
    return steps.select(upto["n"].alias("train_rows"), (upto["e"] / upto["w"]).alias("validation_auc"))


@query
def argmax_step(spark, sf_dir):
    return rounded(models.best_row(step_curve(spark, sf_dir), "validation_auc", "train_rows"))


@query
def curve_last_step(spark, sf_dir):
    return rounded(models.last_step(step_curve(spark, sf_dir)))


@query
def ablation_join(spark, sf_dir):
    """Two comparison tables side by side: AUC of the fixed score with and without its last term."""
    df = scored(spark, sf_dir).withColumn("model", F.col("network"))
    cut = df.withColumn("score", F.col("score") - F.col("weight") / 250)
    tables = [
        metrics.ranking_metrics(d, ["model"]).select("model", F.round("roc_auc", 4).alias("roc_auc")) for d in (df, cut)
    ]
    return models.ablation_table(*tables)


@query
def importance_agreement(spark, sf_dir):
    """Leaders of two rankings of the same columns: strength of correlation and completeness."""
    df = star.base(spark, sf_dir)
    first = profiling.label_correlations(df, NUMERIC_FEATURES).withColumn("strength", F.abs("correlation"))
    second = profiling.column_coverage(df, NUMERIC_FEATURES, only_incomplete=False)
    table = explain.top_agreement(first, second, "strength", "coverage")
    return table.withColumn("agree", F.col("agree").cast("int"))


# --- model fits ----------------------------------------------------------------------------------
# Fits run at the library's own sizes. A query shows what is known without the fit (rows, keys, folds,
# closed forms of the class prior) and whether what was learned holds the properties it must have.

PARALLELISM = 8
LEARNED = ("roc_auc", "train_roc_auc", "accuracy", "f1", "average_precision")


def train_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sides(spark, sf_dir).where("NOT is_test").drop("is_test")


def test_side(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sides(spark, sf_dir).where("is_test").drop("is_test")


def sides(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stored(
        spark, sf_dir, "sides", lambda: sampling.group_split(star.base(spark, sf_dir).drop("fixed_score"), 0.25, SEED)
    )


_models: dict[tuple[str, str, str], object] = {}
forget_with_staging(_models)


def fitted(spark: SparkSession, sf_dir: str, family: str = "gradient_boosting"):
    """A model of the train side, learned once per folder of staged tables."""
    key = (staging_folder(spark), sf_dir, family)
    if key not in _models:
        _models[key] = models.fit_pipeline(train_side(spark, sf_dir), models.candidates()[family])
    return _models[key]


def compared(spark: SparkSession, sf_dir: str, scaler: str = "standard", without: tuple[str, ...] = ()) -> DataFrame:
    """The comparison of all families in five folds."""
    name = "_".join(["compared", scaler, *without])
    make = lambda: models.compare(train_side(spark, sf_dir).drop(*without), scaler, parallelism=PARALLELISM)
    return star.stored(spark, sf_dir, name, make)


def shares(*columns: str) -> Column:
    """1 where all columns are shares."""
    return reduce(lambda x, y: x & y, [F.col(c).between(0, 1) for c in columns]).cast("int")


def shown(table: DataFrame) -> DataFrame:
    """A comparison: the figures of the class prior and of naive Bayes, and of each model whether they are possible."""
    known = F.col("model").isin("baseline", "naive_bayes")
    gap = F.abs(F.col("train_roc_auc") - F.col("roc_auc") - F.col("train_gap")) < 2e-4
    figures = [F.when(known, F.col(c)).alias(c) for c in ("roc_auc", "roc_auc_sd", "train_gap", "accuracy", "f1", "average_precision")]
    return table.select("model", *figures, (shares(*LEARNED) * gap.cast("int")).alias("possible"))


@query
def cv_model_comparison(spark, sf_dir):
    return shown(compared(spark, sf_dir))


@query
def scaler_comparison(spark, sf_dir):
    tables = [shown(compared(spark, sf_dir, s)).withColumn("scaler", F.lit(s)) for s in ("standard", "robust")]
    return tables[0].unionByName(tables[1])


@query
def ablation(spark, sf_dir):
    without = compared(spark, sf_dir, without=tuple(ENRICHMENT_FEATURES))
    table = models.ablation_table(compared(spark, sf_dir), without)
    sound = (F.abs(F.col("auc_with") - F.col("auc_without") - F.col("difference")) < 1e-6).cast("int") * shares("auc_with", "auc_without")
    return table.select("model", F.when(F.col("model").isin("baseline", "naive_bayes"), F.col("difference")).alias("difference"), sound.alias("possible"))


def learned_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stored(spark, sf_dir, "learning_curve", lambda: models.learning_curve(train_side(spark, sf_dir), parallelism=PARALLELISM))


@query
def learning_curve(spark, sf_dir):
    return learned_curve(spark, sf_dir).select("train_rows", shares("train_auc", "validation_auc").alias("possible"))


def leaves_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stored(spark, sf_dir, "validation_curve", lambda: models.validation_curve(train_side(spark, sf_dir), parallelism=PARALLELISM))


@query
def validation_curve(spark, sf_dir):
    """More leaves fit the training rows better, or as well."""
    curve = leaves_curve(spark, sf_dir)
    grows = curve.agg((F.max_by("train_auc", "max_leaves") >= F.min_by("train_auc", "max_leaves")).cast("int")).first()[0]
    return curve.select("max_leaves", shares("train_auc", "validation_auc").alias("possible"), F.lit(grows).alias("grows"))


def searched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stored(spark, sf_dir, "search", lambda: models.random_search(train_side(spark, sf_dir), parallelism=PARALLELISM))


@query
def random_search(spark, sf_dir):
    return searched(spark, sf_dir).select("name", *models.SEARCH_SPACE, shares("roc_auc").alias("possible"))


@query
def oof_scores(spark, sf_dir):
    """Folds, the class prior of the other folds, and whether boosting gave each row a probability."""
    df = star.base(spark, sf_dir).drop("fixed_score")
    prior = models.out_of_fold(df, models.candidates()["baseline"]).select("unit_id", "group_id", "fold", "score")
    boosted = models.out_of_fold(df, models.boosting()).select("unit_id", F.col("score").alias("boosted"))
    return rounded(prior.join(boosted, "unit_id", "left").withColumn("scored", shares("boosted")).drop("boosted"))


@query
def batch_scoring(spark, sf_dir):
    test = test_side(spark, sf_dir)
    prior = models.score_rows(fitted(spark, sf_dir, "baseline"), test).select("unit_id", "label", "score")
    boosted = models.score_rows(fitted(spark, sf_dir), test).select("unit_id", F.col("score").alias("boosted"))
    return rounded(prior.join(boosted, "unit_id", "left").withColumn("scored", shares("boosted")).drop("boosted"))


def effects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The long table of contributions on the test side."""
    make = lambda: explain.contribution_rows(fitted(spark, sf_dir), test_side(spark, sf_dir))
    return star.stored(spark, sf_dir, "effects", make)


def permuted(spark: SparkSession, sf_dir: str) -> DataFrame:
    make = lambda: explain.permutation_importance(fitted(spark, sf_dir), test_side(spark, sf_dir))
    return star.stored(spark, sf_dir, "permuted", make)


@query
def permutation_importance(spark, sf_dir):
    """A column the model doesn't use has no importance."""
    table = permuted(spark, sf_dir)
    used = [r["column_name"] for r in explain.mean_abs_of(effects(spark, sf_dir)).where("mean_abs_contribution > 0").collect()]
    touches = reduce(
        lambda x, y: x | y,
        [F.lit(f) == F.col("column_name") for f in used]
        + [F.startswith(F.lit(f), F.concat("column_name", F.lit("_"))) for f in used]
        + [F.lit(f) == F.concat(F.lit(prep.FLAG_PREFIX), "column_name") for f in used],
        F.lit(False),
    )
    return table.select("column_name", ((F.col("importance") == 0) | touches).cast("int").alias("sound"))


@query
def mean_abs_shap(spark, sf_dir):
    """Contributions of a row add up to its log-odds: the largest gap."""
    model, test = fitted(spark, sf_dir), test_side(spark, sf_dir)
    table, expected = explain.contributions(model, test)
    total = F.aggregate("contributions", F.lit(float(expected)), lambda a, x: a + x)
    odds = models.score_rows(model, test).select("unit_id", F.log(F.col("score") / (1 - F.col("score"))).alias("margin"))
    gap = F.max(F.abs(F.col("total") - F.col("margin"))).alias("largest_gap")
    return rounded(table.select("unit_id", total.alias("total")).join(odds, "unit_id").agg(F.count("*").alias("rows"), gap), 5)


@query
def linear_contributions(spark, sf_dir):
    """What the margins of the two linear models are made of, model by model.

    Contributions and expected value add up to the margin that the coefficients give, as read back from
    the saved model. A feature's contributions are nothing on average over the rows they are centred on.
    At the minimum that was looked for, the loss has no slope in any direction (by unit of weight).
    """
    test, parts = test_side(spark, sf_dir), []
    for family in ("logistic_regression", "linear_svm"):
        model = fitted(spark, sf_dir, family)
        path = new_path(spark, "linear")
        model.stages[-1].write().save(path)
        read = linear.LinearModel.load(path)
        table, expected = explain.contributions(model, test)
        total = F.aggregate("contributions", F.lit(float(expected)), lambda a, x: a + x)
        gap = F.max(F.abs(total - read.margin("features"))).alias("largest_gap")
        means = [F.abs(F.avg(F.get("contributions", i))) for i in range(len(read.weights()))]
        slope = linear.slope_left(read, model.stages[0].transform(train_side(spark, sf_dir)))
        about = table.agg(F.count("*").alias("rows"), gap, F.greatest(*means).alias("largest_mean"))
        parts.append(about.select(F.lit(family).alias("model"), "*", F.lit(slope).alias("slope")))
    return rounded(parts[0].unionByName(parts[1]), 6)


@query
def shap_long_table(spark, sf_dir):
    """Value and contribution per individual of the 15 features with the largest effect, as a chart shows."""
    rows = effects(spark, sf_dir)
    top = reports.top_effects(explain.mean_abs_of(rows))
    chosen = rows.join(F.broadcast(top.select("column_name")), "column_name", "left_semi")
    return chosen.groupBy("unit_id").agg(F.count("contribution").alias("features"))


@query
def kmeans_profiles(spark, sf_dir):
    """Units with their coordinates; no unit is nearer to another centre than to its own."""
    assigned = segments.assign_profiles(units_at_risk(spark, sf_dir))
    return rounded(segments.nearest(assigned).select("group_id", "network", *segments.DIMS, F.col("nearest").cast("int").alias("nearest")))


def scanned(spark: SparkSession, sf_dir: str) -> DataFrame:
    return star.stored(spark, sf_dir, "k_scan", lambda: segments.k_scan(units_at_risk(spark, sf_dir)))


@query
def k_scan(spark, sf_dir):
    """More clusters are tighter; silhouettes lie between -1 and 1."""
    table = scanned(spark, sf_dir)
    before = table.select((F.col("k") + 1).alias("k"), F.col("inertia").alias("looser"))
    tighter = F.coalesce(F.col("inertia") <= F.col("looser"), F.lit(True)).cast("int")
    inside = reduce(
        lambda x, y: x & y, [F.col(f"silhouette_{f}").between(-1, 1) for f in ("kmeans", "hierarchical", "mixture")]
    )
    return table.join(before, "k", "left").select("k", tighter.alias("tighter"), inside.cast("int").alias("possible"))


@query
def pca_projection(spark, sf_dir):
    """Two components: uncorrelated, the larger first, and as much variance as they say."""
    placed, parts = segments.projection(fixed_profiles(spark, sf_dir))
    whole = reduce(lambda x, y: x + y, [F.var_samp(d) for d in segments.DIMS])
    one, two = F.var_samp("component_1"), F.var_samp("component_2")
    return rounded(
        placed.agg(
            F.count("*").alias("units"),
            F.abs(F.covar_samp("component_1", "component_2")).alias("covariance"),
            (one >= two).cast("int").alias("ordered"),
            F.abs((one + two) / whole - F.lit(float(sum(parts)))).alias("unexplained"),
        )
    )


# --- reports -------------------------------------------------------------------------------------


@query
def exploratory_report(spark, sf_dir):
    """How many records each table has in the JSON document of the exploratory report."""
    tables = reports.exploratory_tables(star.base(spark, sf_dir).drop("fixed_score"))
    return in_document(tables)


def in_document(tables: dict[str, DataFrame]) -> DataFrame:
    """How many records each table has in the JSON document of a report."""
    document = staged(reports.as_json(tables), "document")
    counts = [F.struct(F.lit(n).alias("table_name"), F.json_array_length(F.get_json_object("document", f"$.{n}")).alias("records")) for n in tables]
    return document.select(F.inline(F.array(*counts)))


@query
def modelling_report(spark, sf_dir):
    """Records of the modelling report, put together from the tables that the model queries store."""
    units, assigned = units_at_risk(spark, sf_dir), fixed_profiles(spark, sf_dir)
    scored_test = staged(models.score_rows(fitted(spark, sf_dir), test_side(spark, sf_dir)), "test_scores")
    enriched = compared(spark, sf_dir)
    trained = {
        "design": reports.design(train_side(spark, sf_dir), test_side(spark, sf_dir)),
        "comparison": enriched,
        "ablation": models.ablation_table(enriched, compared(spark, sf_dir, without=tuple(ENRICHMENT_FEATURES))),
        "learning_curve": learned_curve(spark, sf_dir),
        "validation_curve": leaves_curve(spark, sf_dir),
        "search": searched(spark, sf_dir),
        "refused": reports.refused(star.base(spark, sf_dir)),
    }
    evaluated = {
        "metrics": metrics.ranking_metrics(scored_test),
        "permutation": permuted(spark, sf_dir),
        "shap": explain.mean_abs_of(effects(spark, sf_dir)),
    }
    applied = {
        "risk_summary": risk.risk_summary(units),
        "errors": risk.rate_errors(units),
        "risk_by_region": risk.risk_by_region(units),
        "profiles": segments.profile_summary(assigned),
        "k_scan": scanned(spark, sf_dir),
        "units": units,
    }
    return in_document(reports.modelling_tables(trained, evaluated, applied))


@query
def refused_columns(spark, sf_dir):
    """Columns of the base that nobody has vetted as features."""
    return reports.refused(star.base(spark, sf_dir))


@query
def design_counts(spark, sf_dir):
    return reports.design(train_side(spark, sf_dir), test_side(spark, sf_dir))


@query
def strategy_summary(spark, sf_dir):
    """The strategy document on the fixed profiles: counts, errors, risk by region, profiles, adopted k."""
    units = units_at_risk(spark, sf_dir)
    return rounded(reports.strategy(units, fixed_profiles(spark, sf_dir)))
