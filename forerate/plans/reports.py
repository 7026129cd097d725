"""Report tables and JSON summaries: selections over the result tables of the stages."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forerate.contracts import NUMERIC_FEATURES, feature_columns
from forerate.operators import explain, models, profiling, risk, segments
from forerate.sources.staging import staged


def as_json(tables: dict[str, DataFrame]) -> DataFrame:
    """One JSON document with one list of records per table. For small result tables only."""
    packed = [
        df.agg(F.collect_list(F.struct(*df.columns)).alias(name)).withColumn("_all", F.lit(0))
        for name, df in tables.items()
    ]
    joined = reduce(lambda a, b: a.join(b, "_all"), packed)
    return joined.select(F.to_json(F.struct(*tables)).alias("document"))


def exploratory_tables(base: DataFrame) -> dict[str, DataFrame]:
    """Everything the exploratory report and its charts show."""
    numeric = feature_columns(base).numeric
    rates = staged(profiling.rate_by_category(base, ["region2", "region1", "network"]), "rates")
    contexts = [c for c in ("group_rate_prior_year", "region_rate_prior_year") if c in numeric]
    return {
        "size": base.agg(F.count("*").alias("rows"), F.round(100 * F.avg("label"), 1).alias("rate")),
        "label_share": profiling.label_share(base),
        "coverage": profiling.column_coverage(base),
        "rates": rates,
        "rates_in_charts": rates.where(F.col("rows") > 500),
        "best_and_worst": profiling.best_and_worst(rates.where(F.col("category") == "region1")),
        "label_correlations": profiling.label_correlations(base, numeric),
        "correlation_matrix": profiling.correlation_matrix(base, [*numeric, "label"]),
        "histograms": profiling.histograms(base, [c for c in NUMERIC_FEATURES if c in numeric][:6]),
        "context_vs_outcome": profiling.binned_rate(base, contexts),
    }


TOP_EFFECTS = 15


def top_effects(mean_abs: DataFrame, n: int = TOP_EFFECTS) -> DataFrame:
    """The features of the effect charts, largest effect first."""
    return mean_abs.orderBy(F.desc("mean_abs_contribution"), "column_name").limit(n)


def top_importance(importance: DataFrame, n: int = TOP_EFFECTS) -> DataFrame:
    """The columns of the importance chart, most important first."""
    return importance.orderBy(F.desc("importance"), "column_name").limit(n)


def side_by_side(*tables: DataFrame) -> DataFrame:
    """Tables of one row each as one row."""
    keyed = [t.withColumn("_all", F.lit(0)) for t in tables]
    return reduce(lambda a, b: a.join(b, "_all"), keyed).drop("_all")


def listed(table: DataFrame, order: list[Column], cells: list[Column], name: str) -> DataFrame:
    """A small table as one text, a record after the other."""
    packed = F.sort_array(F.collect_list(F.struct(*[o.alias(f"_{i}") for i, o in enumerate(order)], F.concat_ws(" ", *cells).alias("text"))))
    return table.agg(F.array_join(F.transform(packed, lambda r: r["text"]), ", ").alias(name))


def strategy(units: DataFrame, assigned: DataFrame) -> DataFrame:
    """The strategy document as one row: risk counts, errors, mean risk by region, the profiles, the
    adopted number of profiles and its silhouette."""
    one = lambda c: F.format_string("%.1f", F.col(c))
    by_region = listed(risk.risk_by_region(units), [-F.col("mean_risk"), F.col("region2")], [F.col("region2"), one("mean_risk")], "region_risk")
    summary = segments.profile_summary(assigned)
    cells = [F.col("profile_name"), F.col("units").cast("string"), one("predicted_rate")]
    profiles = listed(summary, [F.col("predicted_rate"), F.col("profile")], cells, "profiles")
    width, error = segments.euclidean_silhouette(assigned, ["profile"])["profile"]
    return side_by_side(
        risk.risk_summary(units),
        risk.rate_errors(units).withColumnRenamed("units", "compared_units"),
        summary.agg(F.count("*").alias("adopted_k")),
        units.sparkSession.createDataFrame([(width, error)], "silhouette double, silhouette_error double"),
        by_region,
        profiles,
    )


def design(train: DataFrame, test: DataFrame) -> DataFrame:
    """Rows and groups on both sides of the split."""
    sides = train.select("group_id", F.lit("train").alias("side")).unionByName(
        test.select("group_id", F.lit("test").alias("side"))
    )
    return sides.groupBy("side").agg(F.count("*").alias("rows"), F.countDistinct("group_id").alias("groups"))


def refused(df: DataFrame) -> DataFrame:
    """Columns of a table that are no agreed feature, nor one of the keys, label and weight: left out of models."""
    return df.sparkSession.createDataFrame([(c,) for c in feature_columns(df).dropped], "column_name string")


def modelling_tables(trained: dict[str, DataFrame], evaluated: dict[str, DataFrame], applied: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """What the modelling report states, from the tables of training, evaluation and application."""
    out = {
        "design": trained["design"],
        "comparison": trained["comparison"],
        "last_step": models.last_step(trained["learning_curve"]),
        "best_leaves": models.best_row(trained["validation_curve"], "validation_auc", "max_leaves"),
        "best_search": models.best_row(trained["search"], "roc_auc", "name"),
        "metrics": evaluated["metrics"],
        "top_permutation": top_importance(evaluated["permutation"], 10),
        "top_shap": top_effects(evaluated["shap"], 10),
        "importance_chart": top_importance(evaluated["permutation"]),
        "effect_chart": top_effects(evaluated["shap"]),
        "agreement": explain.top_agreement(
            evaluated["permutation"], evaluated["shap"], "importance", "mean_abs_contribution"
        ),
        "risk_summary": applied["risk_summary"],
        "errors": applied["errors"],
        "risk_by_region": applied["risk_by_region"],
        "profiles": applied["profiles"],
        "best_k": models.best_row(applied["k_scan"], "silhouette_kmeans", "k"),
        "adopted_k": applied["k_scan"].where(F.col("k") == applied["profiles"].count()),
        "top_risk": risk.top_risk(applied["units"]),
    }
    if "refused" in trained:
        out["refused"] = trained["refused"]
    if "ablation" in trained:
        out["ablation_range"] = trained["ablation"].agg(
            F.min("difference").alias("smallest"), F.max("difference").alias("largest")
        )
    return out
