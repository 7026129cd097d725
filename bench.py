"""Wall time of the headline jobs; prints one JSON line.

``cold_base`` is the first build of the analytical base, from raw tables and with a cold session.
Every other job reads stored tables, all rows of them, and its whole result is consumed. Fits are
timed with their preparation.
"""

from __future__ import annotations

import json
import os
import sys
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forerate.contracts import feature_columns
from forerate.operators import explain, metrics, models, prep, risk, sampling, segments
from forerate.operators.boosting import BoostedTrees
from forerate.plans import reports
from forerate.plans.star_queries import scored
from forerate.sources import star

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("forerate-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


#: Tells the trees of the boosted models that were timed.
BOOSTED_ROUNDS: list[Callable[[], dict[str, int]]] = []


def consume(*tables: DataFrame) -> None:
    for df in tables:
        df.write.format("noop").mode("overwrite").save()


def jobs(spark: SparkSession) -> dict[str, Callable[[], None]]:
    base = star.base(spark, SF_DIR)
    plain = base.drop("fixed_score")
    columns = feature_columns(plain)
    fixed = scored(spark, SF_DIR)
    units = risk.unit_risk(fixed)
    fitted: dict[str, object] = {}

    def fold_preparation() -> None:
        folded = models.fold_members(plain, 5)
        prep.fit_specs(folded, columns.numeric, columns.categorical, fits="fits")

    def fit(name: str) -> Callable[[], None]:
        def run() -> None:
            fitted[name] = models.fit_pipeline(plain, models.candidates()[name])

        return run

    def boosted():
        return fitted["gradient_boosting"]

    def hundred_rounds() -> None:
        """Without early stopping, so that all rounds are run."""
        fitted["hundred"] = models.fit_pipeline(plain, models.boosting(early_stopping=False))

    def rounds() -> dict[str, int]:
        return {name: len(m.stages[-1].trees()) for name, m in fitted.items() if isinstance(m.stages[-1], BoostedTrees)}

    BOOSTED_ROUNDS.append(rounds)

    return {
        "analytical_base": lambda: consume(star.fresh_base(spark, SF_DIR)),
        "exploratory_tables": lambda: consume(*reports.exploratory_tables(plain).values()),
        "stratified_sample": lambda: consume(sampling.stratified_sample(plain, plain.count() // 4)),
        "group_split": lambda: consume(sampling.group_split(plain)),
        "group_folds": lambda: consume(sampling.with_folds(plain, 5)),
        "fold_preparation": fold_preparation,
        "ranking_metrics": lambda: consume(metrics.ranking_metrics(fixed)),
        "class_metrics": lambda: consume(metrics.class_metrics(fixed, metrics.guess_at(0.62))),
        "recall_threshold": lambda: consume(metrics.recall_by_threshold(fixed)),
        "calibration": lambda: consume(metrics.calibration(fixed)),
        "curve_points": lambda: consume(metrics.curve_points(fixed)),
        "unit_risk": lambda: consume(units),
        "risk_summary": lambda: consume(risk.risk_summary(units), risk.risk_by_region(units), risk.rate_errors(units)),
        "profile_matrix": lambda: consume(segments.profile_matrix(units)),
        "k_scan": lambda: consume(segments.k_scan(units)),
        **{f"fit_{name}": fit(name) for name in models.candidates()},
        "fit_boosting_100_rounds": hundred_rounds,
        "out_of_fold": lambda: consume(models.out_of_fold(plain, models.boosting())),
        "permutation_importance": lambda: consume(explain.permutation_importance(boosted(), plain)),
        "mean_abs_shap": lambda: consume(explain.mean_abs_contribution(boosted(), plain)),
        "model_comparison": lambda: consume(models.compare(plain, parallelism=int(CPUS))),
    }


def main() -> None:
    spark = session()
    times: dict[str, float] = {}
    start = time.perf_counter()
    star.base(spark, SF_DIR)
    times["cold_base"] = round(time.perf_counter() - start, 3)
    for name, job in jobs(spark).items():
        start = time.perf_counter()
        job()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    total = round(sum(times.values()), 3)
    sf = os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "total_wall_time", "value": total, "unit": "sec", "queries": times, "sf": sf, "boosted_rounds": BOOSTED_ROUNDS[0]()}))
    spark.stop()


if __name__ == "__main__":
    main()
