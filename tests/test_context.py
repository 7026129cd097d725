"""Assembly of the base: fallbacks, guards and edge cases on a hand-made layout."""

import dataclasses
import shutil

import numpy as np
import pytest
from pyspark.sql import functions as F

from forerate.functions import joins
from forerate.functions.scalars import MACRO_REGIONS, macro_region, pad_code, round_half_even, year_number
from forerate.operators import context
from forerate.plans.base import analytical_base
from forerate.sources import tables
from forerate.sources.staging import staged, staging_folder, write_tables

UNITS = "id_aluno string, id_escola string, id_municipio string, sigla_uf string, rede_descricao string, caderno string, peso_aluno double, alfabetizado string, proficiencia double, registro_valido boolean, serie string, ano int"


@pytest.fixture(scope="module")
def layout(spark, tmp_path_factory):
    """The published folder layout with a handful of rows."""
    root = str(tmp_path_factory.mktemp("layout"))
    units = [
        ("a1", "e1", "0000001", "SP", "Municipal", "01", 1.0, "1", 700.0, True, "2", 2023),
        ("a2", "e1", "0000001", "SP", "Municipal", "01", 3.0, "0", 800.0, True, "2", 2023),
        ("a3", "e1", "0000001", "SP", "Municipal", "01", 1.0, "0", None, True, "2", 2023),
        ("a4", "e2", "0000002", "BA", "Estadual", "02", 1.0, "1", 650.0, True, "2", 2023),
        ("a5", "e2", "0000002", "BA", "Estadual", "02", 1.0, "1", 651.0, False, "2", 2023),
        ("a6", "e2", "0000002", "BA", "Estadual", "02", 1.0, "1", 652.0, True, "5", 2023),
        ("a7", "e2", None, "BA", "Estadual", "02", 1.0, "1", 652.0, True, "2", 2023),
        ("b1", "e1", "0000001", "SP", "Municipal", "01", 2.0, "1", 900.0, True, "2", 2024),
        ("b2", "e3", "0000002", "BA", "Estadual", "02", 2.0, None, 100.0, True, "2", 2024),
        ("b3", "e4", "0000003", "XX", "Municipal", "03", 2.0, "0", 100.0, True, "2", 2024),
        ("b4", "e4", "0000003", "CE", "Municipal", "03", 2.0, "1", 100.0, False, "2", 2024),
        ("b5", "e5", None, "CE", "Municipal", "03", 2.0, "1", 100.0, True, "2", 2024),
    ]
    gold = [
        ("0000001", "Municipal", 55.5, 750.0, 60.0, 2023),
        ("0000001", "Municipal", 99.0, 999.0, 61.005, 2024),
        ("0000002", "Estadual", 98.0, 998.0, None, 2024),
    ]
    regional = [
        ("SP", "Municipal", 50.0, 740.0, None, 2023),
        ("SP", "Municipal", 91.0, 991.0, None, 2024),
        ("SP", "Pública", 92.0, 992.0, 58.0, 2024),
        ("BA", "Estadual", 93.0, 993.0, 44.0, 2024),
        ("BA", "Pública", 94.0, 994.0, 45.0, 2024),
        ("CE", "Pública", 95.0, 995.0, 70.0, 2024),
    ]
    spark.createDataFrame(units, UNITS).write.partitionBy("ano").parquet(f"{root}/silver/fato_aluno")
    places = "rede_descricao string, indicador_alfabetizacao double, proficiencia_media double, meta double, ano int"
    spark.createDataFrame(gold, f"id_municipio string, {places}").write.partitionBy("ano").parquet(f"{root}/gold/gold_indicador_municipio")
    spark.createDataFrame(regional, f"sigla_uf string, {places}").write.partitionBy("ano").parquet(f"{root}/gold/gold_indicador_uf")
    spark.createDataFrame(
        [("Pública", 60.0, 2024), ("Municipal", 59.0, 2024), ("Pública", 55.0, 2023)], "rede_descricao string, meta double, ano int"
    ).write.partitionBy("ano").parquet(f"{root}/gold/gold_evolucao_brasil")
    spark.createDataFrame(
        [(2023, "0000001", "Municipal", False, 54.0), (2023, "0000002", "Estadual", False, 33.0), (2023, "0000002", "Pública", True, 34.0)],
        "ano int, id_municipio string, rede_descricao string, rede_agregada boolean, taxa_alfabetizacao double",
    ).write.parquet(f"{root}/silver/oficial_municipio")
    spark.createDataFrame(
        [("0000001", "Alto", "SP"), ("0000002", "Baixo", "BA")], "id_municipio string, nome_municipio string, sigla_uf string"
    ).write.parquet(f"{root}/silver/dim_municipio")
    spark.createDataFrame(
        [("0000001", 2023, 2021, 100, 5000.0, 50.0)],
        "id_municipio string, ano_populacao int, ano_pib int, populacao long, pib double, pib_per_capita double",
    ).write.parquet(f"{root}/external")
    return root


@pytest.fixture(scope="module")
def inputs(spark, layout):
    return tables.read_layout(spark, layout, f"{layout}/external")


@pytest.fixture(scope="module")
def built(inputs):
    df = analytical_base(inputs, 2023, 2024, "Pública")
    return df, {r["unit_id"]: r for r in df.collect()}


def test_all_federal_units_have_a_region(spark):
    codes = [c for region in MACRO_REGIONS.values() for c in region]
    assert len(codes) == len(set(codes)) == 27
    df = spark.createDataFrame([("SP",), ("XX",), (None,)], "c string").select(macro_region(F.col("c")).alias("r"))
    assert [r["r"] for r in df.collect()] == ["Sudeste", None, None]


def test_base_has_the_agreed_columns_and_the_valid_rows(built):
    df, rows = built
    assert len(df.columns) == 25
    assert set(rows) == {"b1", "b2", "b3", "b5"}


def test_context_comes_from_the_base_year_only(built):
    row = built[1]["b1"]
    assert row["group_rate_prior_year"] == 55.5 and row["group_mean_prior_year"] == 750.0
    assert row["region_rate_prior_year"] == 50.0 and row["target"] == 61.005
    assert row["gap_target_start"] == np.round(61.005 - 55.5, 2)
    assert row["gap_target_national"] == np.round(61.005 - 60.0, 2)


def test_dispersion_counts_rows_without_a_score(built):
    row = built[1]["b1"]
    assert row["group_n_prior_year"] == 3
    assert row["group_std_prior_year"] == 70.71
    assert (row["group_p25_prior_year"], row["group_p75_prior_year"]) == (725.0, 775.0)


def test_single_row_has_no_deviation_and_uses_the_published_rate(built):
    row = built[1]["b2"]
    assert row["group_std_prior_year"] is None and row["group_n_prior_year"] == 1
    assert row["group_rate_prior_year"] == 33.0 and row["group_mean_prior_year"] is None


def test_a_rate_that_is_not_a_number_is_missing(spark, layout, tmp_path):
    """NaN in the files falls back on the published rate, like a missing rate."""
    shutil.copytree(layout, f"{tmp_path}/l")
    nan = [("0000001", "Municipal", float("nan"), 750.0, 60.0, 2023), ("0000001", "Municipal", 99.0, 999.0, 61.005, 2024)]
    places = "id_municipio string, rede_descricao string, indicador_alfabetizacao double, proficiencia_media double, meta double, ano int"
    table = spark.createDataFrame(nan, places)
    table.write.mode("overwrite").partitionBy("ano").parquet(f"{tmp_path}/l/gold/gold_indicador_municipio")
    df = analytical_base(tables.read_layout(spark, f"{tmp_path}/l"), 2023, 2024, "Pública")
    row = df.where("unit_id = 'b1'").first()
    assert row["group_rate_prior_year"] == 54.0 and row["group_mean_prior_year"] == 750.0


def test_null_label_counts_as_zero_or_is_dropped(inputs, built):
    assert built[1]["b2"]["label"] == 0
    kept = analytical_base(inputs, 2023, 2024, "Pública", null_label="drop")
    assert {r["unit_id"] for r in kept.select("unit_id").collect()} == {"b1", "b3", "b5"}


def test_region_target_falls_back_to_the_whole_network(inputs, built):
    assert built[1]["b1"]["region_target"] == 58.0
    assert built[1]["b2"]["region_target"] == 44.0
    # a region that only has the whole-network row gets none
    assert built[1]["b5"]["region_target"] is None
    got = {tuple(r) for r in context.region_targets(inputs.region_indicator, 2024, "Pública").collect()}
    assert got == {("SP", "Municipal", 58.0), ("BA", "Estadual", 44.0)}


def test_unknown_region_and_null_group_keep_their_rows(built):
    assert built[1]["b3"]["region2"] is None
    assert built[1]["b5"]["group_rate_prior_year"] is None and built[1]["b5"]["population"] is None


def test_optional_tables(inputs):
    plain = dataclasses.replace(inputs, enrichment=None)
    df = analytical_base(plain, 2023, 2024, "Pública")
    assert "population" not in df.columns and "gap_target_national" in df.columns
    none = dataclasses.replace(plain, national_indicator=inputs.national_indicator.where("year = 1900"))
    assert "gap_target_national" not in analytical_base(none, 2023, 2024, "Pública").columns


def test_enrichment_without_provenance_is_refused(spark, inputs):
    bare = inputs.enrichment.drop("gdp_year")
    assert context.audited_enrichment(bare, 2023) is None
    assert context.audited_enrichment(None, 2023) is None


@pytest.mark.parametrize("years", [(2024, 2021), (2023, 2022)])
def test_enrichment_beyond_its_ceiling_raises(spark, inputs, years):
    late = inputs.enrichment.withColumn("population_year", F.lit(years[0])).withColumn("gdp_year", F.lit(years[1]))
    with pytest.raises(context.LeakError, match="not published"):
        context.audited_enrichment(late, 2023)


def test_enrichment_extract_takes_the_newest_published_year(spark):
    population = spark.createDataFrame(
        [("1", 2021, 10), ("1", 2022, 0), ("12345678", 2022, 7), (None, 2022, 5), ("1", 2024, 99)], "group_id string, year int, population int"
    )
    gdp = spark.createDataFrame([("1", 2020, 100.0), ("1", 2022, 5.0)], "group_id string, year int, gdp double")
    got = {r["group_id"]: r for r in tables.enrichment_extract(population, gdp, 2023).collect()}
    assert set(got) == {"0000001", "12345678"}
    assert got["0000001"]["gdp_per_capita"] is None and got["0000001"]["gdp_year"] == 2020
    assert got["12345678"]["gdp"] is None


def test_duplicate_places_are_found_before_they_multiply_rows(inputs):
    twice = dataclasses.replace(inputs, regions=inputs.regions.unionByName(inputs.regions.where("region1 = 'SP'")))
    with pytest.raises(ValueError, match="SP.*not unique"):
        analytical_base(twice, 2023, 2024, "Pública")


def test_large_places_are_joined_without_a_broadcast(inputs, built, monkeypatch):
    monkeypatch.setattr(joins, "MAX_BROADCAST_ROWS", 0)
    df = analytical_base(inputs, 2023, 2024, "Pública")
    assert sorted(map(str, df.collect())) == sorted(map(str, built[0].collect()))


def test_partition_years_are_pruned(inputs):
    df = tables.unit_rows(inputs.units, 2024, ["unit_id"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "ano" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_key_stability(spark):
    rows = [
        ("s1", "g1", 1, "1"), ("s1", "g1", 2, "1"), ("s2", "g1", 1, "0"), ("s2", "g2", 2, "1"), ("s3", "g2", 1, "0"), ("s4", "g2", 2, "0"),
    ]
    df = spark.createDataFrame([(*r, True, "2") for r in rows], "site_id string, group_id string, year int, label string, valid boolean, grade string")
    got = {r["level"]: r for r in context.key_stability(df, 1, 2).collect()}
    assert got["site_id"]["keys_in_both_years"] == 2 and got["site_id"]["share_same_group"] == 0.5
    assert got["group_id"]["keys_in_both_years"] == 2 and got["group_id"]["share_same_group"] == 1.0
    # s1: 1 and 1, s2: 0 and 1 - the second year is constant, so there is no correlation
    assert got["site_id"]["rate_correlation"] is None


def test_scalars(spark):
    df = spark.createDataFrame([("12", "2023", 1.005), ("12345678", "x", 2.675), (None, None, 0.125)], "c string, y string, v double")
    got = df.select(pad_code(F.col("c")).alias("c"), year_number(F.col("y")).alias("y"), round_half_even(F.col("v"), 2).alias("v")).collect()
    assert [r["c"] for r in got] == ["0000012", "12345678", None]
    assert [r["y"] for r in got] == [2023, None, None]
    # what array libraries give
    assert [r["v"] for r in got] == [1.0, 2.68, 0.12]


def test_staged_tables_live_in_the_named_folder(spark, tmp_path):
    df = staged(spark.range(3), "probe")
    assert staging_folder(spark) in df.inputFiles()[0].replace("file://", "").replace("file:", "")
    paths = write_tables({"a": spark.range(3), "b": spark.range(2)}, str(tmp_path), "csv")
    assert spark.read.option("header", True).csv(paths["a"]).count() == 3
    assert spark.read.json(write_tables({"j": spark.range(2)}, str(tmp_path), "json")["j"]).count() == 2
