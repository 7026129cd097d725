"""The same results in plain SQL over the raw test tables, for an independent engine."""

from __future__ import annotations

import itertools
import random

from forerate.contracts import ENRICHMENT_FEATURES, NUMERIC_FEATURES

PLACES = """
places AS (
  SELECT CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 7 THEN lpad(CAST(s_suppkey AS VARCHAR), 7, '0')
              ELSE CAST(s_suppkey AS VARCHAR) END AS group_id,
         s_name AS group_name, n_name AS region1,
         CASE WHEN s_acctbal >= 0 THEN 40 + 40 * (s_acctbal + 1000) / 11000 END AS target
  FROM supplier JOIN nation ON s_nationkey = n_nationkey),
regions AS (SELECT n_name AS region1, r_name AS region2 FROM nation JOIN region ON n_regionkey = r_regionkey)"""

UNITS = (
    PLACES
    + """,
units AS (
  SELECT concat_ws('|', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR), CAST(l_partkey AS VARCHAR),
                   CAST(l_suppkey AS VARCHAR), strftime(l_shipdate, '%Y%m%d')) AS unit_id,
         CAST(l_partkey AS VARCHAR) AS site_id, p.group_id, p.region1, l_returnflag AS network,
         CAST(l_linenumber AS VARCHAR) AS form, l_quantity AS weight,
         CASE WHEN l_extendedprice >= 30000 THEN 1 ELSE 0 END AS label, round_even(l_extendedprice, 0) AS score_raw,
         l_discount > 0 AND l_tax < 0.08 AS assessed, CAST(year(l_shipdate) AS INTEGER) AS year,
         round_even((0.2::DOUBLE + 3 * l_discount + 2 * l_tax + l_quantity / 250) * 1024, 0) / 1024 AS score
  FROM lineitem JOIN places p ON p.group_id =
       CASE WHEN length(CAST(l_suppkey AS VARCHAR)) < 7 THEN lpad(CAST(l_suppkey AS VARCHAR), 7, '0')
            ELSE CAST(l_suppkey AS VARCHAR) END
  WHERE year(l_shipdate) IN (1999, 2000)),
group_rates AS (
  SELECT year, group_id, network, 100 * (sum(weight * label) / sum(weight)) AS rate, avg(score_raw) AS mean_score
  FROM units WHERE assessed AND (year = 2000 OR CAST(group_id AS BIGINT) % 5 <> 0) GROUP BY ALL),
group_indicator AS (SELECT g.*, p.target FROM group_rates g JOIN places p USING (group_id)),
published AS (
  SELECT year, group_id, network, 100 * (sum(label) / count(*)) AS rate
  FROM units WHERE CAST(group_id AS BIGINT) % 15 <> 0 GROUP BY year, group_id, network)"""
)

REGIONAL = """,
agreed AS (SELECT region1, avg(target) AS agreed FROM places GROUP BY region1),
region_rates AS (
  SELECT year, region1, network, 100 * (sum(weight * label) / sum(weight)) AS rate, avg(score_raw) AS mean_score
  FROM units WHERE assessed GROUP BY ALL),
region_targets AS (
  SELECT region1, network, CASE WHEN network <> 'N' THEN agreed ELSE agreed + 1 END AS region_target
  FROM region_rates JOIN agreed USING (region1) WHERE year = 2000)"""

DERIVED_AND_RESERVE = """,
rates AS (
  SELECT group_id, network, d.rate AS derived_rate, d.mean_score, r.rate AS reserve_rate
  FROM (SELECT * FROM group_indicator WHERE year = 1999) d
  FULL JOIN (SELECT * FROM published WHERE year = 1999) r USING (group_id, network))"""


def lerp(low: str, high: str, share: str) -> str:
    """Interpolation from the nearer end, term by term as in the job."""
    return (
        f"CASE WHEN {share} >= 0.5 THEN {high} - ({high} - {low}) * (1 - {share}) "
        f"ELSE {low} + ({high} - {low}) * {share} END"
    )


CONTEXT = (
    DERIVED_AND_RESERVE
    + f""",
ordered AS (
  SELECT group_id, network, score_raw, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY group_id, network) AS n
  FROM units WHERE assessed AND year = 1999 WINDOW w AS (PARTITION BY group_id, network ORDER BY score_raw)),
ends AS (
  SELECT group_id, network, n,
         max(score_raw) FILTER (i = floor((n - 1) * 0.25::DOUBLE)) AS a1,
         max(score_raw) FILTER (i = least(floor((n - 1) * 0.25::DOUBLE) + 1, n - 1)) AS b1,
         (n - 1) * 0.25::DOUBLE - floor((n - 1) * 0.25::DOUBLE) AS s1,
         max(score_raw) FILTER (i = floor((n - 1) * 0.75::DOUBLE)) AS a3,
         max(score_raw) FILTER (i = least(floor((n - 1) * 0.75::DOUBLE) + 1, n - 1)) AS b3,
         (n - 1) * 0.75::DOUBLE - floor((n - 1) * 0.75::DOUBLE) AS s3
  FROM ordered GROUP BY group_id, network, n),
spread AS (
  SELECT group_id, network, round_even(stddev_samp(score_raw) * 100, 0) / 100 AS group_std_prior_year, count(*) AS group_n_prior_year
  FROM units WHERE assessed AND year = 1999 GROUP BY group_id, network),
context AS (
  SELECT group_id, network, mean_score AS group_mean_prior_year, coalesce(derived_rate, reserve_rate) AS group_rate_prior_year,
         group_std_prior_year,
         round_even(({lerp("a1", "b1", "s1")}) * 100, 0) / 100 AS group_p25_prior_year,
         round_even(({lerp("a3", "b3", "s3")}) * 100, 0) / 100 AS group_p75_prior_year,
         group_n_prior_year
  FROM rates FULL JOIN (spread JOIN ends USING (group_id, network)) USING (group_id, network))"""
)

ENRICHMENT = """,
yearly AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS code, CAST(year(l_shipdate) AS INTEGER) AS year,
         count(DISTINCT l_partkey) AS population, sum(round_even(l_extendedprice, 0)) AS gdp
  FROM lineitem GROUP BY ALL),
enrichment AS (
  SELECT CASE WHEN length(h.code) < 7 THEN lpad(h.code, 7, '0') ELSE h.code END AS group_id,
         h.year AS population_year, g.year AS gdp_year, h.population, g.gdp,
         g.gdp / nullif(h.population, 0) AS gdp_per_capita
  FROM (SELECT * FROM yearly WHERE year = (SELECT max(year) FROM yearly WHERE year <= 1999)) h
  LEFT JOIN (SELECT * FROM yearly WHERE year = (SELECT max(year) FROM yearly WHERE year <= 1997)) g USING (code))"""

BASE = (
    "WITH "
    + UNITS
    + REGIONAL
    + CONTEXT
    + ENRICHMENT
    + """,
joined AS (
  SELECT u.unit_id, u.site_id, u.group_id, u.region1, u.network, u.form, u.weight, u.label, u.score, g.region2,
         c.group_mean_prior_year, c.group_rate_prior_year, c.group_std_prior_year, c.group_p25_prior_year,
         c.group_p75_prior_year, c.group_n_prior_year,
         r.rate AS region_rate_prior_year, r.mean_score AS region_mean_prior_year,
         t.target, rt.region_target, e.population, e.gdp, e.gdp_per_capita,
         (SELECT avg(target) FROM places) AS nation
  FROM units u
  LEFT JOIN regions g ON g.region1 = u.region1
  LEFT JOIN context c ON c.group_id = u.group_id AND c.network = u.network
  LEFT JOIN region_rates r ON r.year = 1999 AND r.region1 = u.region1 AND r.network = u.network
  LEFT JOIN group_indicator t ON t.year = 2000 AND t.group_id = u.group_id AND t.network = u.network
  LEFT JOIN region_targets rt ON rt.region1 = u.region1 AND rt.network = u.network
  LEFT JOIN enrichment e ON e.group_id = u.group_id
  WHERE u.assessed AND u.year = 2000),
base AS (
  SELECT * EXCLUDE (nation),
         round_even((target - group_rate_prior_year) * 100, 0) / 100 AS gap_target_start,
         round_even((target - region_target) * 100, 0) / 100 AS gap_target_region,
         round_even((target - nation) * 100, 0) / 100 AS gap_target_national
  FROM joined)"""
)

PASS = "unit_id, site_id, group_id, region1, network, form, weight, label, region2"
COUNTS = ("group_n_prior_year", "population")
FEATURES_6 = ", ".join(c if c in COUNTS else f"round({c}, 6) AS {c}" for c in NUMERIC_FEATURES)
UNIT_HASH = "md5(concat_ws('|', '42', unit_id))"
GROUP_HASH = "md5(concat_ws('|', '42', group_id))"

ORACLES: dict[str, str] = {}

ORACLES["analytical_base"] = f"{BASE} SELECT {PASS}, {FEATURES_6}, round(score, 6) AS fixed_score FROM base"

ORACLES["municipal_context"] = f"""WITH {UNITS}{CONTEXT}
SELECT group_id, network, round(group_mean_prior_year, 6) AS group_mean_prior_year,
       round(group_rate_prior_year, 6) AS group_rate_prior_year, group_std_prior_year, group_p25_prior_year,
       group_p75_prior_year, group_n_prior_year FROM context"""

ORACLES["region_context"] = f"""WITH {UNITS}{REGIONAL}
SELECT region1, network, round(rate, 6) AS region_rate_prior_year, round(mean_score, 6) AS region_mean_prior_year
FROM region_rates WHERE year = 1999
UNION ALL SELECT region1, 'ALL', NULL, NULL FROM agreed"""

ORACLES["target_fallback"] = f"""WITH {UNITS}{REGIONAL}
SELECT region1, network, round(region_target, 6) AS region_target FROM region_targets"""

ORACLES["national_target_gap"] = f"""WITH {UNITS}
SELECT group_id, network, round(target, 6) AS target,
       round(target - (SELECT avg(target) FROM places), 6) AS gap_target_national
FROM group_indicator WHERE year = 2000"""

ORACLES["national_and_region_targets"] = f"""WITH {UNITS}{REGIONAL}
SELECT 'nation' AS level, '' AS place, 'ALL' AS network, round(avg(target), 6) AS target FROM places
UNION ALL SELECT 'region1', region1, network, round(region_target, 6) FROM region_targets
UNION ALL SELECT 'group', group_id, network, round(target, 6) FROM group_indicator WHERE year = 2000"""

ORACLES["enrichment_asof_ceiling"] = f"""WITH {UNITS}{ENRICHMENT}
SELECT group_id, population_year, gdp_year, population, round(gdp, 4) AS gdp, round(gdp_per_capita, 4) AS gdp_per_capita
FROM enrichment"""

ORACLES["vintage_violations"] = f"""WITH {UNITS}{ENRICHMENT},
late AS (
  SELECT h.code, (SELECT max(year) FROM yearly WHERE year <= 2000) AS population_year, g.year AS gdp_year
  FROM (SELECT * FROM yearly WHERE year = (SELECT max(year) FROM yearly WHERE year <= 2000)) h
  LEFT JOIN (SELECT * FROM yearly WHERE year = (SELECT max(year) FROM yearly WHERE year <= 1998)) g USING (code)),
checked AS (
  SELECT 'population_year' AS source, population_year AS year, 1999 AS ceiling FROM late
  UNION ALL SELECT 'gdp_year', gdp_year, 1997 FROM late)
SELECT source, year, ceiling, count(*) AS rows FROM checked WHERE year > ceiling GROUP BY ALL"""

ORACLES["reserve_coverage"] = f"""WITH {UNITS}{DERIVED_AND_RESERVE}
SELECT count(*) AS units, count(derived_rate) AS from_derived,
       count(*) FILTER (derived_rate IS NULL AND reserve_rate IS NOT NULL) AS from_reserve,
       count(*) FILTER (derived_rate IS NULL AND reserve_rate IS NULL) AS without_rate,
       round(count(derived_rate) / count(*), 6) AS derived_share,
       round(count(coalesce(derived_rate, reserve_rate)) / count(*), 6) AS covered_share
FROM rates"""

ORACLES["key_stability"] = f"""WITH {UNITS},
rows_both AS (SELECT * FROM units WHERE assessed),
site_year AS (SELECT site_id, year, avg(label) AS rate FROM rows_both GROUP BY ALL),
site_pairs AS (
  SELECT a.site_id, a.rate AS r0, b.rate AS r1,
         EXISTS (SELECT 1 FROM rows_both x JOIN rows_both y ON x.site_id = y.site_id AND x.group_id = y.group_id
                 WHERE x.site_id = a.site_id AND x.year = 1999 AND y.year = 2000) AS kept
  FROM site_year a JOIN site_year b ON a.site_id = b.site_id AND a.year = 1999 AND b.year = 2000),
group_year AS (SELECT group_id, year, avg(label) AS rate FROM rows_both GROUP BY ALL)
SELECT 'site_id' AS level, count(*) AS keys_in_both_years, round(avg(CASE WHEN kept THEN 1 ELSE 0 END), 6) AS share_same_group,
       round(corr(r0, r1), 6) AS rate_correlation FROM site_pairs
UNION ALL
SELECT 'group_id', count(*), 1.0, round(corr(a.rate, b.rate), 6)
FROM group_year a JOIN group_year b ON a.group_id = b.group_id AND a.year = 1999 AND b.year = 2000"""

ALL_COLUMNS = [*[c.strip() for c in PASS.split(",")], *NUMERIC_FEATURES]
ORACLES["column_coverage"] = (
    BASE
    + ", cover AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, 100 * count({c}) / count(*) AS coverage FROM base" for c in ALL_COLUMNS)
    + ") SELECT column_name, round_even(coverage * 10, 0) / 10 AS coverage FROM cover WHERE coverage < 100"
)

ORACLES["label_share"] = f"""{BASE}
SELECT label, count(*) AS rows, round(100 * count(*) / (SELECT count(*) FROM base), 6) AS share FROM base GROUP BY label"""

CATEGORY_RATES = " UNION ALL ".join(
    f"SELECT '{c}' AS category, {c} AS value, round_even(1000 * sum(label) / count(*), 0) / 10 AS rate, count(*) AS rows, "
    "(SELECT 100 * avg(label) FROM base) AS overall_rate FROM base GROUP BY " + c
    for c in ("region2", "region1", "network")
)
ORACLES["rate_by_category"] = f"""{BASE}, listed AS ({CATEGORY_RATES})
SELECT category, value, rate, rows, round(overall_rate, 6) AS overall_rate FROM listed WHERE rows > 500"""

ORACLES["best_worst_region"] = f"""{BASE}, listed AS ({CATEGORY_RATES}),
ranked AS (
  SELECT category, value, rate, max(rate) OVER () - min(rate) OVER () AS range,
         row_number() OVER (ORDER BY rate DESC, value) AS best, row_number() OVER (ORDER BY rate, value DESC) AS worst
  FROM listed WHERE category = 'region1')
SELECT category, 'best' AS side, CAST(best AS INTEGER) AS place, value, rate, round(range, 6) AS range FROM ranked WHERE best <= 3
UNION ALL
SELECT category, 'worst', CAST(worst AS INTEGER), value, rate, round(range, 6) FROM ranked WHERE worst <= 3"""

ORACLES["label_correlations"] = (
    BASE
    + " "
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, round_even(corr({c}, label) * 1000, 0) / 1000 AS correlation FROM base" for c in NUMERIC_FEATURES
    )
)

MATRIX = [*NUMERIC_FEATURES, "label"]
ORACLES["correlation_matrix"] = (
    BASE
    + ", wide AS (SELECT "
    + ", ".join(f"corr({a}, {b}) AS c{i}_{j}" for i, a in enumerate(MATRIX) for j, b in enumerate(MATRIX) if i <= j)
    + " FROM base) "
    + " UNION ALL ".join(
        f"SELECT '{a}' AS row_name, '{b}' AS column_name, round(c{min(i, j)}_{max(i, j)}, 6) AS r FROM wide"
        for i, a in enumerate(MATRIX)
        for j, b in enumerate(MATRIX)
    )
)

ORACLES["context_vs_outcome_bins"] = f"""{BASE}, cells AS (
  SELECT 'group_rate_prior_year' AS context, group_rate_prior_year AS x, label FROM base
  UNION ALL SELECT 'region_rate_prior_year', region_rate_prior_year, label FROM base)
SELECT context, ceil(x / 10) * 10 - 5.0::DOUBLE AS bin_mid, round(100 * avg(label), 6) AS rate, count(*) AS rows
FROM cells WHERE x > 0 AND x <= 100 GROUP BY ALL"""

ORACLES["histogram_40"] = (
    BASE
    + ", cells AS ("
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, CAST({c} AS DOUBLE) AS x FROM base" for c in NUMERIC_FEATURES[:6])
    + """), ranges AS (SELECT column_name, min(x) AS lo, max(x) AS hi FROM cells GROUP BY column_name),
frame AS (SELECT column_name, lo, hi, CAST(bin AS INTEGER) AS bin FROM ranges, range(40) t(bin)),
counts AS (
  SELECT column_name, CAST(least(floor((x - lo) / (hi - lo) * 40), 39) AS INTEGER) AS bin, count(*) AS rows
  FROM cells JOIN ranges USING (column_name) WHERE x IS NOT NULL GROUP BY ALL)
SELECT column_name, bin, round(lo + bin * ((hi - lo) / 40), 4) AS lower, round(lo + (bin + 1) * ((hi - lo) / 40), 4) AS upper,
       coalesce(rows, 0) AS rows FROM frame LEFT JOIN counts USING (column_name, bin)"""
)

ORACLES["stratified_sample"] = f"""{BASE}, ranked AS (
  SELECT unit_id, label, row_number() OVER (PARTITION BY label ORDER BY {UNIT_HASH}) AS place,
         count(*) OVER (PARTITION BY label) AS n_label, count(*) OVER () AS n FROM base)
SELECT unit_id, label FROM ranked WHERE place <= round_even(CAST(n // 4 AS DOUBLE) / n * n_label, 0)"""

ORACLES["simple_sample"] = f"""{BASE}
SELECT unit_id FROM (SELECT unit_id, row_number() OVER (ORDER BY {UNIT_HASH}) AS place, count(*) OVER () AS n FROM base)
WHERE place <= n // 4"""

SPLIT = f"""{BASE}, groups AS (SELECT DISTINCT group_id FROM base),
sides AS (SELECT group_id, CASE WHEN row_number() OVER (ORDER BY {GROUP_HASH}) <= ceil(0.25 * count(*) OVER ()) THEN 1 ELSE 0 END AS is_test
          FROM groups)"""
ORACLES["group_split"] = f"{SPLIT} SELECT unit_id, group_id, is_test FROM base JOIN sides USING (group_id)"
ORACLES["split_leak_check"] = f"""{SPLIT}
SELECT count(*) FILTER (is_test = 0) AS train_groups, count(*) FILTER (is_test = 1) AS test_groups,
       (SELECT count(*) FROM (SELECT group_id FROM sides WHERE is_test = 0 INTERSECT SELECT group_id FROM sides WHERE is_test = 1))
       AS shared_groups FROM sides"""


def folds_sql(k: int, table: str = "base") -> str:
    """CTEs up to ``folds`` for k row-balanced folds of the groups of a table."""
    return f"""
sizes AS (SELECT group_id, count(*) AS rows FROM {table} GROUP BY group_id),
ranked AS (SELECT *, row_number() OVER (ORDER BY rows DESC, group_id) AS rank,
           sum(rows) OVER () - coalesce(sum(rows) OVER (ORDER BY rows DESC, group_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS left_rows
           FROM sizes),
alone AS (SELECT *, min(CASE WHEN rows * ({k} - rank + 1) < left_rows OR rank > {k} THEN rank END) OVER () AS stop FROM ranked),
rest AS (SELECT group_id, rows, stop - 1 AS h, sum(rows) OVER () AS r,
         sum(rows) OVER (ORDER BY {GROUP_HASH}) - rows AS ahead FROM alone WHERE rank >= stop),
folds AS (
  SELECT group_id, rows, CAST(rank - 1 AS INTEGER) AS fold FROM alone WHERE rank < stop
  UNION ALL SELECT group_id, rows, CAST(h + floor((ahead + rows / 2) * ({k} - h) / r) AS INTEGER) FROM rest)"""


ORACLES["group_folds"] = f"{BASE}, {folds_sql(5)} SELECT group_id, rows, fold FROM folds"

STEPS = f"""{BASE}, steps AS (
  SELECT score, sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS pos, sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS neg
  FROM base GROUP BY score),
above AS (
  SELECT *, sum(pos) OVER (ORDER BY score DESC) AS tp, sum(neg) OVER (ORDER BY score DESC) AS fp,
         sum(pos) OVER () AS p, sum(neg) OVER () AS n FROM steps)"""

ORACLES["weighted_roc_auc"] = f"""{BASE}, steps AS (
  SELECT region2, score, sum(CASE WHEN label = 1 THEN weight ELSE 0 END) AS pos, sum(CASE WHEN label = 0 THEN weight ELSE 0 END) AS neg
  FROM base GROUP BY region2, score)
SELECT a.region2, round(sum(CASE WHEN a.score > b.score THEN a.pos * b.neg WHEN a.score = b.score THEN a.pos * b.neg / 2 ELSE 0 END)
       / sum(a.pos * b.neg), 6) AS roc_auc
FROM steps a JOIN steps b ON a.region2 = b.region2 GROUP BY a.region2"""

ORACLES["weighted_average_precision"] = f"{STEPS} SELECT round(sum(pos / p * (tp / (tp + fp))), 6) AS average_precision FROM above"

ORACLES["accuracy_brier"] = f"""{BASE}
SELECT region2, round(sum(CASE WHEN (score >= 0.62::DOUBLE) = (label = 1) THEN weight ELSE 0 END) / sum(weight), 6) AS accuracy,
       round(sum(weight * (score - label) * (score - label)) / sum(weight), 6) AS brier
FROM base GROUP BY region2"""

ORACLES["class_metrics"] = f"""{BASE}, cells AS (
  SELECT sum(weight) FILTER (label = 1 AND score >= 0.62::DOUBLE) AS tp, sum(weight) FILTER (label = 0 AND score >= 0.62::DOUBLE) AS fp,
         sum(weight) FILTER (label = 1 AND score < 0.62::DOUBLE) AS fn, sum(weight) FILTER (label = 0 AND score < 0.62::DOUBLE) AS tn
  FROM base)
SELECT round((tp + tn) / (tp + tn + fp + fn), 6) AS accuracy,
       round(tp / (tp + fp), 6) AS precision_1, round(tp / (tp + fn), 6) AS recall_1, round(2 * tp / (2 * tp + fp + fn), 6) AS f1_1,
       round(tn / (tn + fn), 6) AS precision_0, round(tn / (tn + fp), 6) AS recall_0, round(2 * tn / (2 * tn + fp + fn), 6) AS f1_0
FROM cells"""

ORACLES["recall_threshold"] = f"""{BASE}, curve AS (
  SELECT t / 100 AS threshold, sum(CASE WHEN score < t / 100 THEN weight ELSE 0 END) / sum(weight) AS recall_0
  FROM base, range(30, 86) g(t) WHERE label = 0 GROUP BY t)
SELECT threshold, round(recall_0, 6) AS recall_0,
       CASE WHEN threshold = (SELECT min(threshold) FROM curve WHERE recall_0 >= 0.7) THEN 1 ELSE 0 END AS chosen FROM curve"""

ORACLES["confusion_matrix"] = f"""{BASE}
SELECT y AS label, p AS predicted, count(unit_id) AS rows, round(count(unit_id) / (SELECT count(*) FROM base), 6) AS share
FROM (VALUES (0, 0), (0, 1), (1, 0), (1, 1)) c(y, p)
LEFT JOIN base ON label = y AND (score >= 0.62::DOUBLE) = (p = 1) GROUP BY y, p"""

ORACLES["calibration_deciles"] = f"""{BASE}, by_score AS (
  SELECT score, row_number() OVER (ORDER BY score) - 1 AS i, count(*) OVER () AS n FROM base),
spots AS (SELECT q, (n - 1) * (q / 10) AS spot, n FROM (SELECT count(*) AS n FROM base), range(1, 10) t(q)),
edge_ends AS (
  SELECT q, max(score) FILTER (i = floor(spot)) AS a, max(score) FILTER (i = least(floor(spot) + 1, s.n - 1)) AS b,
         max(spot - floor(spot)) AS t FROM spots s, by_score GROUP BY q),
edges AS (SELECT {lerp("a", "b", "t")} AS edge FROM edge_ends),
binned AS (SELECT score, label, (SELECT count(*) FROM edges WHERE edge < score) AS bin FROM base)
SELECT CAST(bin AS INTEGER) AS bin, round(avg(score), 6) AS mean_score, round(avg(label), 6) AS observed_rate, count(*) AS rows
FROM binned GROUP BY bin"""

ORACLES["roc_pr_points"] = f"""{STEPS}
SELECT round(score, 6) AS threshold, round(fp / n, 6) AS false_positive_rate, round(tp / p, 6) AS recall,
       round(tp / (tp + fp), 6) AS precision, round(p / (p + n), 6) AS prevalence FROM above"""


def order_statistic(column: str, p: float, table: str = "base") -> str:
    """Scalar subquery: the interpolated quantile of a column, term by term as in the job."""
    spot = f"((n - 1) * {p}::DOUBLE)"
    a = f"max(x) FILTER (i = floor({spot}))"
    b = f"max(x) FILTER (i = least(floor({spot}) + 1, n - 1))"
    t = f"max({spot} - floor({spot}))"
    return (
        f"(SELECT {lerp(a, b, t)} FROM (SELECT CAST({column} AS DOUBLE) AS x, row_number() OVER (ORDER BY {column}) - 1 AS i, "
        f"count(*) OVER () AS n FROM {table} WHERE {column} IS NOT NULL))"
    )


CATEGORIES = ("network", "region1", "region2", "form")
LEVELS = "levels AS (" + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {c} AS level, count(*) AS rows, (SELECT count(*) FROM base) AS n FROM base GROUP BY {c}"
    for c in CATEGORIES
) + "), fillers AS (SELECT *, row_number() OVER (PARTITION BY column_name ORDER BY rows DESC, level) = 1 AS is_filler FROM levels)"

MEDIANS = "medians AS (SELECT " + ", ".join(f"{order_statistic(c, 0.5)} AS {c}" for c in NUMERIC_FEATURES) + ")"
FILLED = "filled AS (SELECT " + ", ".join(
    f"CAST(coalesce(b.{c}, m.{c}) AS DOUBLE) AS {c}, CASE WHEN b.{c} IS NULL THEN 1.0::DOUBLE ELSE 0 END AS missingindicator_{c}"
    for c in NUMERIC_FEATURES
) + ", network, region1, region2, form FROM base b, medians m)"

ORACLES["imputer_params"] = (
    f"{BASE}, {MEDIANS}, {LEVELS} "
    + " UNION ALL ".join(f"SELECT '{c}' AS column_name, round({c}, 6) AS fill_value, NULL AS fill_level FROM medians" for c in NUMERIC_FEATURES)
    + " UNION ALL SELECT column_name, NULL, level FROM fillers WHERE is_filler"
)

ORACLES["missing_flags"] = (
    f"{BASE}, flags AS ("
    + " UNION ALL ".join(
        f"SELECT 'missingindicator_{c}' AS feature, count(*) - count({c}) AS missing, count(*) AS n FROM base" for c in NUMERIC_FEATURES
    )
    + ") SELECT feature, missing, round(missing / n, 6) AS share FROM flags WHERE missing > 0"
)

ORACLES["scaler_params"] = f"{BASE}, {MEDIANS}, {FILLED} " + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, round(avg({c}), 4) AS mean, round(stddev_pop({c}), 4) AS std, "
    f"round((SELECT {c} FROM medians), 4) AS median, "
    f"round({order_statistic(c, 0.75, 'filled')} - {order_statistic(c, 0.25, 'filled')}, 4) AS iqr FROM filled"
    for c in NUMERIC_FEATURES
)

ORACLES["one_hot_rare"] = f"""{BASE}, {LEVELS}
SELECT column_name, level, rows, CAST(is_filler AS INTEGER) AS is_filler, CAST(rows < 0.01 * n AS INTEGER) AS is_rare FROM fillers"""

SCALED = [*NUMERIC_FEATURES, *[f"missingindicator_{c}" for c in NUMERIC_FEATURES]]
ORACLES["prepared_features"] = (
    f"{BASE}, {MEDIANS}, {FILLED}, {LEVELS}, scaled AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS feature, ({c} - avg({c}) OVER ()) / nullif(stddev_pop({c}) OVER (), 0) AS x, "
        f"max({c}) OVER () AS top FROM filled"
        for c in SCALED
    )
    + """)
SELECT feature, round(sum(x * x), 4) AS squares, round(max(x), 4) AS highest FROM scaled
WHERE NOT (feature LIKE 'missingindicator%' AND top = 0) GROUP BY feature
UNION ALL SELECT column_name || '_' || level, CAST(rows AS DOUBLE), 1.0 FROM levels WHERE rows >= 0.01 * n
UNION ALL SELECT column_name || '_infrequent_sklearn', CAST(sum(rows) AS DOUBLE), 1.0 FROM levels WHERE rows < 0.01 * n GROUP BY column_name"""
)

ORACLES["baseline_prior"] = f"""{SPLIT},
prior AS (SELECT sum(weight * label) / sum(weight) AS p FROM base JOIN sides USING (group_id) WHERE is_test = 0),
test AS (SELECT label, CASE WHEN p > 0.5 THEN 1 ELSE 0 END AS guess, p FROM base JOIN sides USING (group_id), prior WHERE is_test = 1)
SELECT round(max(p), 6) AS score, round(avg(CASE WHEN label = guess THEN 1 ELSE 0 END), 6) AS accuracy,
       round(coalesce(2 * sum(label * guess) / nullif(sum(guess) + sum(label), 0), 0), 6) AS f1 FROM test"""

ORACLES["gaussian_nb_params"] = f"{BASE}, cells AS (" + " UNION ALL ".join(
    f"SELECT label, weight, '{c}' AS column_name, {c} AS x FROM base WHERE {c} IS NOT NULL"
    for c in ("group_rate_prior_year", "region_rate_prior_year", "target")
) + """), means AS (SELECT label, column_name, sum(weight * x) / sum(weight) AS mean, sum(weight) AS weight FROM cells GROUP BY ALL)
SELECT m.label, m.column_name, round(m.mean, 4) AS mean, round(sum(c.weight * (c.x - m.mean) * (c.x - m.mean)) / m.weight, 4) AS variance,
       m.weight FROM means m JOIN cells c ON c.label = m.label AND c.column_name = m.column_name GROUP BY m.label, m.column_name, m.mean, m.weight"""

RISK = f"""{BASE}, sums AS (
  SELECT group_id, region1, region2, network, count(*) AS rows,
         round_even(100 * (sum(weight * score) / sum(weight)) * 100, 0) / 100 AS predicted_rate,
         round_even(100 * (sum(weight * label) / sum(weight)) * 100, 0) / 100 AS real_rate,
         max(target) AS target, max(group_rate_prior_year) AS rate_prior_year
  FROM base GROUP BY ALL HAVING count(*) >= 20),
unit AS (
  SELECT *, 1 - predicted_rate / 100 AS risk, round_even((predicted_rate - target) * 100, 0) / 100 AS gap_predicted_target,
         target IS NULL AS no_target FROM sums),
units_risk AS (SELECT *, NOT no_target AND gap_predicted_target < 0 AS misses FROM unit)"""

ORACLES["unit_risk"] = f"""{RISK}
SELECT group_id, region1, region2, network, rows, predicted_rate, real_rate, round(target, 6) AS target,
       round(rate_prior_year, 6) AS rate_prior_year, round(risk, 6) AS risk, gap_predicted_target,
       CAST(no_target AS INTEGER) AS no_target, CAST(coalesce(misses, false) AS INTEGER) AS at_risk FROM units_risk"""

ORACLES["top_risk_units"] = f"""{RISK}
SELECT u.group_id, p.group_name, u.region1, p.region1 AS region1_dim, u.network, u.predicted_rate, round(u.target, 6) AS target, u.rows
FROM units_risk u JOIN places p USING (group_id) ORDER BY u.risk DESC, u.group_id, u.region1, u.region2, u.network LIMIT 15"""

ORACLES["risk_by_region"] = f"""{RISK}
SELECT region2, round_even(100 * avg(risk) * 10, 0) / 10 AS mean_risk, count(*) AS units FROM units_risk GROUP BY region2"""

ORACLES["risk_summary"] = f"""{RISK}
SELECT count(*) AS units, count(DISTINCT group_id) AS groups, count(*) FILTER (no_target) AS without_target,
       count(*) FILTER (NOT no_target) AS assessable, count(*) FILTER (misses) AS at_risk,
       round_even(100 * count(*) FILTER (misses) / greatest(count(*) FILTER (NOT no_target), 1) * 10, 0) / 10 AS pct_at_risk FROM units_risk"""

ORACLES["rate_error_vs_naive"] = f"""{RISK}
SELECT round_even(avg(abs(predicted_rate - real_rate)) * 100, 0) / 100 AS mae_model,
       round_even(sqrt(avg(pow(predicted_rate - real_rate, 2))) * 100, 0) / 100 AS rmse_model,
       round_even(avg(abs(rate_prior_year - real_rate)) * 100, 0) / 100 AS mae_repeat_last_year, count(*) AS units
FROM units_risk WHERE rate_prior_year IS NOT NULL"""

ORACLES["contradictory_units"] = f"""{BASE}
SELECT group_id, region1, region2, network FROM base GROUP BY ALL
HAVING (max(target) IS NOT NULL AND (min(target) <> max(target) OR count(target) < count(*)))
    OR (max(group_rate_prior_year) IS NOT NULL
        AND (min(group_rate_prior_year) <> max(group_rate_prior_year) OR count(group_rate_prior_year) < count(*)))"""

PROFILE = ("predicted_rate", "rate_prior_year", "target", "gap_predicted_target")
POINTS = (
    f"{RISK}, gaps_filled AS (SELECT group_id, network, "
    + ", ".join(f"coalesce({c}, {order_statistic(c, 0.5, 'units_risk')}) AS {c}" for c in PROFILE)
    + " FROM units_risk), z AS (SELECT group_id, network, "
    + ", ".join(f"({c} - avg({c}) OVER ()) / stddev_pop({c}) OVER () AS z_{c}" for c in PROFILE)
    + """ FROM gaps_filled),
points AS (
  SELECT z.*, u.predicted_rate, u.rate_prior_year, u.target, u.rows,
         CASE WHEN u.predicted_rate >= 55 THEN 2 ELSE 0 END + CASE WHEN u.no_target OR u.target >= 60 THEN 1 ELSE 0 END AS profile
  FROM z JOIN units_risk u USING (group_id, network))"""
)
Z = [f"z_{c}" for c in PROFILE]
CENTRES = ", centres AS (SELECT profile, " + ", ".join(f"avg({z}) AS m_{z}" for z in Z) + " FROM points GROUP BY profile)"


def squared(a: str, b: str, prefix: str = "") -> str:
    return " + ".join(f"pow({a}.{z} - {b}.{prefix}{z}, 2)" for z in Z)


ORACLES["profile_matrix"] = f"{POINTS} SELECT group_id, network, " + ", ".join(f"round({z}, 6) AS {z}" for z in Z) + " FROM points"

ORACLES["cluster_inertia"] = f"""{POINTS}{CENTRES}
SELECT round(sum({squared("p", "c", "m_")}), 6) AS inertia FROM points p JOIN centres c USING (profile)"""

ORACLES["silhouette_sq"] = f"""{POINTS}, numbered AS (SELECT *, row_number() OVER (ORDER BY group_id, network) AS id FROM points),
near AS (
  SELECT a.id, a.profile AS own, b.profile AS other, sum({squared("a", "b")}) AS total, count(*) AS n
  FROM numbered a, numbered b GROUP BY ALL),
widths AS (
  SELECT id, max(n) FILTER (own = other) AS own_n, max(total / nullif(n - 1, 0)) FILTER (own = other) AS a,
         min(total / n) FILTER (own <> other) AS b FROM near GROUP BY id)
SELECT round(avg(CASE WHEN own_n > 1 THEN (b - a) / greatest(a, b) ELSE 0 END), 6) AS silhouette FROM widths"""

ORACLES["silhouette_euclid"] = ORACLES["silhouette_sq"].replace(f"sum({squared('a', 'b')})", f"sum(sqrt({squared('a', 'b')}))").replace(
    "AS silhouette", "AS silhouette, 0.0::DOUBLE AS error"
)

ORACLES["davies_bouldin"] = f"""{POINTS}{CENTRES},
scatter AS (SELECT profile, avg(sqrt({squared("p", "c", "m_")})) AS s FROM points p JOIN centres c USING (profile) GROUP BY profile),
ratios AS (
  SELECT a.profile, max((sa.s + sb.s) / sqrt({" + ".join(f"pow(a.m_{z} - b.m_{z}, 2)" for z in Z)})) AS worst
  FROM centres a JOIN centres b ON a.profile <> b.profile
  JOIN scatter sa ON sa.profile = a.profile JOIN scatter sb ON sb.profile = b.profile GROUP BY a.profile)
SELECT round(avg(worst), 6) AS davies_bouldin FROM ratios"""

ORACLES["profile_summary"] = f"""{POINTS}, means AS (
  SELECT profile, count(*) AS units, round_even(avg(predicted_rate) * 10, 0) / 10 AS predicted_rate,
         round_even(avg(rate_prior_year) * 10, 0) / 10 AS rate_prior_year, round_even(avg(target) * 10, 0) / 10 AS target,
         round_even(avg(rows) * 10, 0) / 10 AS mean_rows FROM points GROUP BY profile),
named AS (
  SELECT *, ['Critical', 'Attention', 'Intermediate', 'Consolidated'][least(row_number() OVER (ORDER BY predicted_rate, profile), 4)]
         AS profile_name FROM means)
SELECT n.*, (SELECT count(*) FROM points p JOIN named m USING (profile) WHERE m.profile_name = n.profile_name) AS named_units FROM named n"""

CURVE = f"""{BASE}, by_form AS (
  SELECT form, count(*) AS n, sum(weight) AS w, sum(weight * (score - label) * (score - label)) AS e FROM base GROUP BY form),
curve AS (
  SELECT CAST(sum(n) OVER (ORDER BY form) AS BIGINT) AS train_rows, sum(e) OVER (ORDER BY form) / sum(w) OVER (ORDER BY form) AS validation_auc
  FROM by_form)"""
ORACLES["argmax_step"] = f"""{CURVE}
SELECT train_rows, round(validation_auc, 6) AS validation_auc FROM curve ORDER BY curve.validation_auc DESC, train_rows LIMIT 1"""
ORACLES["curve_last_step"] = f"""{CURVE}, stepped AS (
  SELECT lag(train_rows) OVER w AS rows_before, train_rows AS rows_after, validation_auc - lag(validation_auc) OVER w AS gain
  FROM curve WINDOW w AS (ORDER BY train_rows))
SELECT rows_before, rows_after, round(100 * (rows_after / rows_before - 1), 6) AS growth_pct, round(gain, 6) AS gain
FROM stepped ORDER BY rows_after DESC LIMIT 1"""


def auc_by(key: str, score: str) -> str:
    return f"""(SELECT a.{key} AS model, round(sum(CASE WHEN a.s > b.s THEN a.w * b.w WHEN a.s = b.s THEN a.w * b.w / 2 ELSE 0 END)
       / sum(a.w * b.w), 4) AS auc
  FROM (SELECT {key}, {score} AS s, sum(weight) AS w FROM base WHERE label = 1 GROUP BY ALL) a
  JOIN (SELECT {key}, {score} AS s, sum(weight) AS w FROM base WHERE label = 0 GROUP BY ALL) b ON a.{key} = b.{key} GROUP BY a.{key})"""


ORACLES["ablation_join"] = f"""{BASE}
SELECT model, x.auc AS auc_with, y.auc AS auc_without, round(x.auc - y.auc, 4) AS difference
FROM {auc_by("network", "score")} x JOIN {auc_by("network", "score - weight / 250")} y USING (model)"""

ORACLES["importance_agreement"] = (
    f"{BASE}, strength AS ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, abs(round_even(corr({c}, label) * 1000, 0) / 1000) AS v, "
        f"round_even(1000 * count({c}) / count(*), 0) / 10 AS coverage FROM base"
        for c in NUMERIC_FEATURES
    )
    + """), leaders AS (
  SELECT (SELECT column_name FROM strength ORDER BY v DESC, column_name DESC LIMIT 1) AS first_leader,
         (SELECT column_name FROM strength ORDER BY coverage DESC, column_name DESC LIMIT 1) AS second_leader)
SELECT first_leader, second_leader, CASE WHEN first_leader = second_leader THEN 1 ELSE 0 END AS agree FROM leaders"""
)

ORACLES["design_counts"] = f"""{SPLIT}
SELECT CASE WHEN is_test = 1 THEN 'test' ELSE 'train' END AS side, count(*) AS rows, count(DISTINCT group_id) AS groups
FROM base JOIN sides USING (group_id) GROUP BY is_test"""

_summary, _errors = (ORACLES[n][len(RISK) :] for n in ("risk_summary", "rate_error_vs_naive"))
_profiles = ORACLES["profile_summary"][len(POINTS) :]
_widths = ORACLES["silhouette_euclid"][len(POINTS) :].replace("AS error", "AS silhouette_error")
ORACLES["strategy_summary"] = f"""{POINTS},
counted AS ({_summary}), missed AS ({_errors.replace("AS units", "AS compared_units")}),
by_region AS ({ORACLES["risk_by_region"][len(RISK):]}),
width AS (WITH {_widths.lstrip(", ")}), listed AS (WITH {_profiles.lstrip(", ")})
SELECT counted.*, missed.*, (SELECT count(DISTINCT profile) FROM points) AS adopted_k, width.*,
       (SELECT string_agg(region2 || ' ' || CAST(mean_risk AS DECIMAL(9, 1)), ', ' ORDER BY mean_risk DESC, region2) FROM by_region) AS region_risk,
       (SELECT string_agg(profile_name || ' ' || units || ' ' || CAST(predicted_rate AS DECIMAL(9, 1)), ', ' ORDER BY predicted_rate, profile) FROM listed)
       AS profiles FROM counted, missed, width"""

_RECORDS = {
    "size": "SELECT 1",
    "label_share": ORACLES["label_share"],
    "coverage": ORACLES["column_coverage"],
    "rates": f"{BASE}, listed AS ({CATEGORY_RATES}) SELECT * FROM listed WHERE value IS NOT NULL",
    "rates_in_charts": ORACLES["rate_by_category"],
    "best_and_worst": ORACLES["best_worst_region"],
    "label_correlations": ORACLES["label_correlations"],
    "correlation_matrix": ORACLES["correlation_matrix"],
    "histograms": ORACLES["histogram_40"],
    "context_vs_outcome": ORACLES["context_vs_outcome_bins"],
}
ORACLES["exploratory_report"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(count(*) AS INTEGER) AS records FROM ({sql})" for name, sql in _RECORDS.items()
)

ORACLES["refused_columns"] = "SELECT 'fixed_score' AS column_name"

# Records by table of the modelling report; of tables with a row per feature the charts show so many.
_SHOWN = {
    **dict.fromkeys(("last_step", "best_leaves", "best_search", "metrics", "agreement", "best_k", "ablation_range"), "SELECT 1"),
    **dict.fromkeys(("top_permutation", "top_shap"), "SELECT * FROM range(10)"),
    **dict.fromkeys(("importance_chart", "effect_chart"), "SELECT * FROM range(15)"),
    "comparison": "SELECT * FROM range(7)",
    "design": ORACLES["design_counts"],
    "risk_summary": ORACLES["risk_summary"],
    "errors": ORACLES["rate_error_vs_naive"],
    "risk_by_region": ORACLES["risk_by_region"],
    "profiles": ORACLES["profile_summary"],
    "adopted_k": f"{POINTS} SELECT 1 FROM points HAVING count(DISTINCT profile) BETWEEN 2 AND 8",
    "top_risk": ORACLES["top_risk_units"],
    "refused": ORACLES["refused_columns"],
}
ORACLES["modelling_report"] = " UNION ALL ".join(
    f"SELECT '{name}' AS table_name, CAST(count(*) AS INTEGER) AS records FROM ({sql})" for name, sql in _SHOWN.items()
)

# What is known of the fits without fitting.
TRAIN = f"{SPLIT}, train AS (SELECT base.* FROM base JOIN sides USING (group_id) WHERE is_test = 0)"


def prior_sql(k: int, table: str) -> str:
    """CTE ``prior``: per fold the weighted label share of the other folds, and what it scores on its own."""
    return f"""{folds_sql(k, table)},
marked AS (SELECT t.unit_id, t.group_id, t.label, t.weight, f.fold FROM {table} t JOIN folds f USING (group_id)),
prior AS (
  SELECT a.fold, sum(b.weight * b.label) / sum(b.weight) AS p, count(*) AS others
  FROM (SELECT DISTINCT fold FROM marked) a JOIN marked b ON a.fold <> b.fold GROUP BY a.fold),
held AS (SELECT fold, avg(label) AS share FROM marked GROUP BY fold),
judged AS (
  SELECT round(avg(CASE WHEN p > 0.5 THEN share ELSE 1 - share END), 4) AS accuracy,
         round(avg(CASE WHEN p > 0.5 THEN 2 * share / (1 + share) ELSE 0 END), 4) AS f1, round(avg(share), 4) AS average_precision
  FROM held JOIN prior USING (fold))"""




def bayes_sql(name: str, scaler: str, columns: list[str]) -> str:
    """CTEs ``<name>_*``, the last of them ``<name>`` with the figures of Gaussian naive Bayes in five folds.

    Features are long rows (fit, row, feature, x) that aren't centred or scaled; only the smoothing of the
    variances knows the scale. Scores of equal features are made equal by rounding their log-odds.
    """
    numbers = " UNION ALL ".join(f"SELECT unit_id, fold, label, weight, '{c}' AS f, CAST({c} AS DOUBLE) AS v FROM {name}_rows" for c in columns)
    texts = " UNION ALL ".join(f"SELECT unit_id, fold, label, weight, '{c}' AS f, {c} AS v FROM {name}_rows" for c in CATEGORIES)
    scale = "stddev_pop(x)" if scaler == "standard" else "quantile_cont(x, 0.75) - quantile_cont(x, 0.25)"
    learned = "fold <> fit"
    return f"""{name}_rows AS MATERIALIZED (SELECT t.*, f.fold FROM train t JOIN folds f USING (group_id)),
{name}_fits AS (SELECT DISTINCT fold AS fit FROM {name}_rows),
{name}_numbers AS MATERIALIZED ({numbers}),
{name}_medians AS (SELECT fit, f, median(v) AS m, count(*) - count(v) AS gaps FROM {name}_numbers, {name}_fits WHERE {learned} GROUP BY ALL),
{name}_filled AS (
  SELECT fit, unit_id, fold, label, weight, f, coalesce(v, m) AS x FROM {name}_numbers JOIN {name}_medians USING (f) WHERE m IS NOT NULL
  UNION ALL SELECT fit, unit_id, fold, label, weight, 'gap_' || f, CASE WHEN v IS NULL THEN 1.0::DOUBLE ELSE 0 END
  FROM {name}_numbers JOIN {name}_medians USING (f) WHERE gaps > 0),
{name}_texts AS MATERIALIZED ({texts}),
{name}_levels AS (
  SELECT fit, f, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY fit, f) AS whole,
         row_number() OVER (PARTITION BY fit, f ORDER BY v IS NULL, count(*) DESC, v) = 1 AS fills
  FROM {name}_texts, {name}_fits WHERE {learned} GROUP BY fit, f, v),
{name}_rare AS (
  SELECT l.fit, l.f, l.v, l.fills, l.n + CASE WHEN l.fills THEN coalesce(g.n, 0) ELSE 0 END < 0.01 * l.whole AS rare
  FROM {name}_levels l LEFT JOIN {name}_levels g ON g.fit = l.fit AND g.f = l.f AND g.v IS NULL WHERE l.v IS NOT NULL),
{name}_given AS (
  SELECT r.fit, t.unit_id, t.fold, t.label, t.weight, t.f, coalesce(t.v, r.v) AS v FROM {name}_texts t JOIN {name}_rare r ON r.f = t.f AND r.fills),
{name}_shown AS (SELECT DISTINCT fit, f, CASE WHEN rare THEN NULL ELSE v END AS v FROM {name}_rare),
{name}_coded AS (
  SELECT g.fit, g.unit_id, g.fold, g.label, g.weight, concat_ws('=', s.f, s.v) AS f,
         CASE WHEN s.v = g.v OR (s.v IS NULL AND r.rare) THEN 1.0::DOUBLE ELSE 0 END AS x
  FROM {name}_given g JOIN {name}_shown s ON s.fit = g.fit AND s.f = g.f
  LEFT JOIN {name}_rare r ON r.fit = g.fit AND r.f = g.f AND r.v = g.v),
{name}_cells AS MATERIALIZED (SELECT *, true AS scaled FROM {name}_filled UNION ALL SELECT *, false FROM {name}_coded),
{name}_middle AS (
  SELECT fit, f, sum(weight * x) / sum(weight) AS mid, CASE WHEN any_value(scaled) THEN coalesce(nullif({scale}, 0), 1) ELSE 1 END AS scale
  FROM {name}_cells WHERE {learned} GROUP BY fit, f),
{name}_sums AS (
  SELECT fit, f, label, sum(weight) AS w, sum(weight * (x - mid)) / sum(weight) AS off, sum(weight * (x - mid) * (x - mid)) / sum(weight) AS sq, any_value(mid) AS mid, any_value(scale) AS scale
  FROM {name}_cells JOIN {name}_middle USING (fit, f) WHERE {learned} GROUP BY fit, f, label),
{name}_smooth AS (SELECT fit, 1e-9 * max(pooled) AS eps FROM (
  SELECT fit, f, (sum(w * sq) / sum(w) - pow(sum(w * off) / sum(w), 2)) / pow(any_value(scale), 2) AS pooled FROM {name}_sums GROUP BY fit, f) GROUP BY fit),
{name}_learned AS (
  SELECT fit, f, label, w, mid + off AS mean, greatest(sq - off * off, 0) + eps * scale * scale AS var FROM {name}_sums JOIN {name}_smooth USING (fit)),
{name}_odds AS (
  SELECT c.fit, c.unit_id, any_value(c.fold) AS fold, any_value(c.label) AS label,
         round(any_value(ln(b.w / a.w)) + sum(ln(a.var / b.var) / 2 + pow(c.x - a.mean, 2) / (2 * a.var) - pow(c.x - b.mean, 2) / (2 * b.var)), 8) AS m
  FROM {name}_cells c JOIN {name}_learned a ON a.fit = c.fit AND a.f = c.f AND a.label = 0 JOIN {name}_learned b ON b.fit = c.fit AND b.f = c.f AND b.label = 1
  GROUP BY c.fit, c.unit_id),
{name}_scores AS (
  SELECT fit, fold = fit AS held, 1 / (1 + exp(-m)) AS p, count(*) FILTER (label = 1) AS pos, count(*) FILTER (label = 0) AS neg
  FROM {name}_odds GROUP BY ALL),
{name}_steps AS (
  SELECT *, sum(pos) OVER down AS tp, sum(neg) OVER down AS fp, sum(pos) OVER side AS ps, sum(neg) OVER side AS ns FROM {name}_scores
  WINDOW down AS (PARTITION BY fit, held ORDER BY p DESC), side AS (PARTITION BY fit, held)),
{name}_ranked AS (
  SELECT fit, held, sum(neg * (tp - pos / 2)) / (max(ps) * max(ns)) AS auc, sum(pos / ps * (tp / (tp + fp))) AS ap FROM {name}_steps GROUP BY fit, held),
{name}_judged AS (
  SELECT fit, fold = fit AS held, avg(CASE WHEN (m > 0) = (label = 1) THEN 1 ELSE 0 END) AS accuracy,
         2 * count(*) FILTER (m > 0 AND label = 1) / (count(*) FILTER (m > 0) + count(*) FILTER (label = 1)) AS f1 FROM {name}_odds GROUP BY ALL),
{name} AS (
  SELECT 'naive_bayes' AS model, round(avg(auc) FILTER (held), 4) AS roc_auc, round(stddev_pop(auc) FILTER (held), 4) AS roc_auc_sd,
         round(avg(auc) FILTER (NOT held) - avg(auc) FILTER (held), 4) AS train_gap, round(avg(accuracy) FILTER (held), 4) AS accuracy,
         round(avg(f1) FILTER (held), 4) AS f1, round(avg(ap) FILTER (held), 4) AS average_precision
  FROM {name}_ranked JOIN {name}_judged USING (fit, held))"""


OTHERS = "(VALUES ('logistic_regression'), ('decision_tree'), ('random_forest'), ('gradient_boosting'), ('linear_svm'))"
PRIOR_ROW = (
    "SELECT 'baseline' AS model, 0.5::DOUBLE AS roc_auc, 0.0::DOUBLE AS roc_auc_sd, 0.0::DOUBLE AS train_gap, accuracy, f1, average_precision FROM judged"
)
UNSHOWN = f"SELECT m, NULL, NULL, NULL, NULL, NULL, NULL FROM {OTHERS} v(m)"
ORACLES["cv_model_comparison"] = f"""{TRAIN}, {prior_sql(5, "train")}, {bayes_sql("bayes", "standard", NUMERIC_FEATURES)},
shown AS ({PRIOR_ROW} UNION ALL SELECT * FROM bayes UNION ALL {UNSHOWN}) SELECT *, 1 AS possible FROM shown"""
ORACLES["scaler_comparison"] = f"""{TRAIN}, {prior_sql(5, "train")},
{bayes_sql("plain", "standard", NUMERIC_FEATURES)}, {bayes_sql("robust", "robust", NUMERIC_FEATURES)},
unlearned AS ({PRIOR_ROW} UNION ALL {UNSHOWN})
SELECT unlearned.*, 1 AS possible, scaler FROM unlearned, (VALUES ('standard'), ('robust')) s(scaler)
UNION ALL SELECT *, 1, 'standard' FROM plain UNION ALL SELECT *, 1, 'robust' FROM robust"""
ORACLES["ablation"] = f"""{TRAIN}, {folds_sql(5, "train")}, {bayes_sql("whole", "standard", NUMERIC_FEATURES)},
{bayes_sql("less", "standard", [c for c in NUMERIC_FEATURES if c not in ENRICHMENT_FEATURES])}
SELECT 'baseline' AS model, 0.0::DOUBLE AS difference, 1 AS possible
UNION ALL SELECT 'naive_bayes', round(whole.roc_auc - less.roc_auc, 4), 1 FROM whole, less UNION ALL SELECT m, NULL, 1 FROM {OTHERS} v(m)"""
ORACLES["learning_curve"] = f"""{TRAIN}, {prior_sql(3, "train")}, smallest AS (SELECT min(others) AS n FROM prior)
SELECT CAST(floor(n * (0.1::DOUBLE + 0.9::DOUBLE * s / 5)) AS BIGINT) AS train_rows, 1 AS possible FROM smallest, range(6) t(s)"""
ORACLES["validation_curve"] = "SELECT l AS max_leaves, 1 AS possible, 1 AS grows FROM (VALUES (4), (8), (15), (31), (63), (127)) v(l)"
# The seeded draw of ten combinations out of all 540 of the search space.
SPACE = {"rate": (0.03, 0.05, 0.1, 0.2), "rounds": (150, 300, 500), "leaves": (4, 8, 15, 31, 63), "min_leaf": (20, 50, 100), "l2": (0.0, 0.1, 1.0)}
DRAWN = ", ".join(f"('draw_{j}', {', '.join(map(str, c))})" for j, c in enumerate(random.Random(42).sample([*itertools.product(*SPACE.values())], 10)))
ORACLES["random_search"] = f"""
SELECT name, CAST(rate AS DOUBLE) AS rate, rounds, leaves, min_leaf, CAST(l2 AS DOUBLE) AS l2, 1 AS possible
FROM (VALUES {DRAWN}) v(name, rate, rounds, leaves, min_leaf, l2)"""
ORACLES["oof_scores"] = f"""{BASE}, {prior_sql(3, "base")}
SELECT unit_id, group_id, fold, round(p, 6) AS score, 1 AS scored FROM marked JOIN prior USING (fold)"""
ORACLES["batch_scoring"] = f"""{SPLIT},
known AS (SELECT sum(weight * label) / sum(weight) AS p FROM base JOIN sides USING (group_id) WHERE is_test = 0)
SELECT unit_id, label, round(p, 6) AS score, 1 AS scored FROM base JOIN sides USING (group_id), known WHERE is_test = 1"""
ORACLES["permutation_importance"] = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, 1 AS sound" for c in (*NUMERIC_FEATURES, *CATEGORIES)
)
ORACLES["mean_abs_shap"] = f"{SPLIT} SELECT count(*) AS rows, 0.0::DOUBLE AS largest_gap FROM base JOIN sides USING (group_id) WHERE is_test = 1"
ORACLES["linear_contributions"] = f"""{SPLIT}
SELECT model, count(*) AS rows, 0.0::DOUBLE AS largest_gap, 0.0::DOUBLE AS largest_mean, 0.0::DOUBLE AS slope
FROM base JOIN sides USING (group_id), (VALUES ('logistic_regression'), ('linear_svm')) v(model) WHERE is_test = 1 GROUP BY model"""
ORACLES["shap_long_table"] = f"{SPLIT} SELECT unit_id, 15 AS features FROM base JOIN sides USING (group_id) WHERE is_test = 1"
ORACLES["kmeans_profiles"] = (
    f"{POINTS} SELECT group_id, network, " + ", ".join(f"round({z}, 6) AS {z}" for z in Z) + ", 1 AS nearest FROM points"
)
ORACLES["k_scan"] = "SELECT CAST(k AS INTEGER) AS k, 1 AS tighter, 1 AS possible FROM range(2, 9) t(k)"
ORACLES["pca_projection"] = f"{POINTS} SELECT count(*) AS units, 0.0::DOUBLE AS covariance, 1 AS ordered, 0.0::DOUBLE AS unexplained FROM points"
