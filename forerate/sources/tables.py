"""Readers: Parquet tables, year partitions, unit rows, the external enrichment extract."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forerate.contracts import UNIT_COLUMNS, require_columns
from forerate.functions.scalars import nan_to_null, pad_code, per_head, year_number


@dataclass(frozen=True)
class Inputs:
    """The tables a run works on. ``None`` marks an optional table that is absent.

    units: one row per individual and year (see ``UNIT_COLUMNS``).
    group_indicator: year, group_id, network, rate, mean_score, target.
    region_indicator: year, region1, network, rate, mean_score, target.
    national_indicator: year, network, target.
    published: year, group_id, network, aggregated, rate.
    regions: region1, region2.
    enrichment: group_id, population_year, gdp_year, population, gdp, gdp_per_capita.
    names: group_id, group_name and any further columns.
    """

    units: DataFrame
    group_indicator: DataFrame
    region_indicator: DataFrame
    national_indicator: DataFrame
    published: DataFrame
    regions: DataFrame
    enrichment: DataFrame | None = None
    names: DataFrame | None = None


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_yearly(spark: SparkSession, path: str, year: str = "year") -> DataFrame:
    """A table whose partition year may come back as text; the year is made a number."""
    df = spark.read.parquet(path)
    return df.withColumn(year, year_number(F.col(year).cast("string"))) if year in df.columns else df


def unit_rows(units: DataFrame, year: int, columns: list[str], grade: str = "2") -> DataFrame:
    """Valid rows of one grade in one year; the year filter prunes partitions."""
    keep = (F.col("year") == year) & F.col("valid") & (F.col("grade") == grade)
    return units.where(keep).select(*columns)


def newest_not_after(df: DataFrame, ceiling: int, year: str = "year") -> DataFrame:
    """Rows of the newest year that is not beyond the ceiling (one year for the whole table).

    The year is looked up first, so the read that follows prunes to a single partition.
    """
    newest = df.where(F.col(year) <= ceiling).agg(F.max(year)).first()[0]
    return df.where(F.col(year) == F.lit(newest))


def enrichment_extract(
    population: DataFrame, gdp: DataFrame, base_year: int, gdp_lag: int = 2
) -> DataFrame:
    """Population and GDP per group, each from the newest year published when one would predict.

    Population comes out within its own year, GDP ``gdp_lag`` years later.
    """
    heads = newest_not_after(population, base_year).select(
        "group_id", F.col("year").alias("population_year"), "population"
    )
    product = newest_not_after(gdp, base_year - gdp_lag).select(
        "group_id", F.col("year").alias("gdp_year"), "gdp"
    )
    joined = heads.join(product, "group_id", "left").select(
        "group_id",
        "population_year",
        "gdp_year",
        "population",
        "gdp",
        per_head(F.col("gdp"), F.col("population")).alias("gdp_per_capita"),
    )
    return joined.dropna(subset=["group_id"]).withColumn("group_id", pad_code(F.col("group_id")))


# Names of the published layout and what they are called here.
UNIT_NAMES = {
    "id_aluno": "unit_id",
    "id_escola": "site_id",
    "id_municipio": "group_id",
    "sigla_uf": "region1",
    "rede_descricao": "network",
    "caderno": "form",
    "peso_aluno": "weight",
    "alfabetizado": "label",
    "proficiencia": "score_raw",
    "registro_valido": "valid",
    "serie": "grade",
    "ano": "year",
}
INDICATOR_NAMES = {
    "ano": "year",
    "id_municipio": "group_id",
    "sigla_uf": "region1",
    "rede_descricao": "network",
    "indicador_alfabetizacao": "rate",
    "proficiencia_media": "mean_score",
    "meta": "target",
    "taxa_alfabetizacao": "rate",
    "rede_agregada": "aggregated",
}
NAME_NAMES = {"id_municipio": "group_id", "nome_municipio": "group_name", "sigla_uf": "region1"}
ENRICHMENT_NAMES = {
    "id_municipio": "group_id",
    "ano_populacao": "population_year",
    "ano_pib": "gdp_year",
    "populacao": "population",
    "pib": "gdp",
    "pib_per_capita": "gdp_per_capita",
}
LAYOUT = {
    "units": "silver/fato_aluno",
    "group_indicator": "gold/gold_indicador_municipio",
    "region_indicator": "gold/gold_indicador_uf",
    "national_indicator": "gold/gold_evolucao_brasil",
    "published": "silver/oficial_municipio",
    "names": "silver/dim_municipio",
}
WHOLE_NETWORK = "Pública"


def _renamed(df: DataFrame, names: dict[str, str], only: list[str] | None = None) -> DataFrame:
    """Columns under their names here; NaN, which the files use for missing numbers, becomes null."""
    kept = {c: names.get(c, c) for c in df.columns}
    floating = {c for c, t in df.dtypes if t in ("double", "float")}
    clean = {c: nan_to_null(F.col(c)) if c in floating else F.col(c) for c in kept}
    return df.select(*[clean[c].alias(n) for c, n in kept.items() if only is None or n in only])


def read_layout(spark: SparkSession, root: str, enrichment: str | None = None) -> Inputs:
    """Open the published folder layout (year-partitioned silver and gold tables) as ``Inputs``.

    Only vetted columns of the gold tables are exposed: their target-year rows also hold the outcome.
    """
    from forerate.functions.scalars import MACRO_REGIONS

    def at(name: str) -> str:
        return f"{root.rstrip('/')}/{LAYOUT[name]}"

    indicator = ["year", "group_id", "region1", "network", "rate", "mean_score", "target"]
    regions = spark.createDataFrame(
        [(c, region) for region, codes in MACRO_REGIONS.items() for c in codes],
        "region1 string, region2 string",
    )
    units = _renamed(read_yearly(spark, at("units"), "ano"), UNIT_NAMES, list(UNIT_COLUMNS))
    return Inputs(
        units=require_columns(units, UNIT_COLUMNS, "units"),
        group_indicator=_renamed(read_yearly(spark, at("group_indicator"), "ano"), INDICATOR_NAMES, indicator),
        region_indicator=_renamed(read_yearly(spark, at("region_indicator"), "ano"), INDICATOR_NAMES, indicator),
        national_indicator=_renamed(
            read_yearly(spark, at("national_indicator"), "ano"), INDICATOR_NAMES, ["year", "network", "target"]
        ),
        published=_renamed(
            read_yearly(spark, at("published"), "ano"),
            INDICATOR_NAMES,
            ["year", "group_id", "network", "aggregated", "rate"],
        ),
        regions=regions,
        enrichment=None if enrichment is None else _renamed(read_table(spark, enrichment), ENRICHMENT_NAMES),
        names=_renamed(read_table(spark, at("names")), NAME_NAMES),
    )
