"""The SQL face of the library: measure functions and gold views for ``spark.sql``.

The functions are SQL-bodied temporary functions, so Catalyst inlines them into the
plan like any built-in expression (no Python at run time). They follow the same
rules as ``functions.measures`` (tested for equality).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..sources.io import read_optional
from .gold import GOLD_PARTITIONS

_R2 = "round(CAST(({x}) AS DOUBLE), {n})"

FUNCTIONS = {
    "lt_gap": ("meta DOUBLE, taxa DOUBLE", "DOUBLE", _R2.format(x="meta - taxa", n=2)),
    "lt_atingimento": ("taxa DOUBLE, meta DOUBLE", "DOUBLE", _R2.format(x="try_divide(taxa, meta) * 100", n=2)),
    "lt_meta_atingida": ("taxa DOUBLE, meta DOUBLE", "INT", "CASE WHEN taxa >= meta THEN 1 ELSE 0 END"),
    "lt_criticidade": ("gap DOUBLE", "STRING",
                       "CASE WHEN gap >= 60 THEN 'Crítico' WHEN gap >= 40 THEN 'Muito Alto' WHEN gap >= 25 THEN 'Alto' "
                       "WHEN gap >= 10 THEN 'Moderado' ELSE 'Baixo' END"),
    "lt_faixa_taxa": ("taxa DOUBLE", "STRING",
                      "CASE WHEN taxa IS NULL THEN NULL WHEN taxa >= 80 THEN '>=80' WHEN taxa >= 65 THEN '65-80' "
                      "WHEN taxa >= 50 THEN '50-65' ELSE '<50' END"),
    "lt_alfabetizado": ("nota DOUBLE, corte DOUBLE", "INT",
                        "CASE WHEN nota IS NULL THEN NULL WHEN nota >= corte THEN 1 ELSE 0 END"),
    "lt_anos_para_meta": ("taxa DOUBLE, meta DOUBLE, variacao DOUBLE", "DOUBLE",
                          "CASE WHEN variacao > 0 AND meta IS NOT NULL THEN "
                          + _R2.format(x="(meta - taxa) / variacao", n=1) + " END"),
    "lt_ano_projetado": ("ano INT, anos DOUBLE", "INT", "CASE WHEN anos > 0 THEN CAST(ano + anos AS INT) END"),
    "lt_status_projecao": ("taxa DOUBLE, meta DOUBLE, projetado INT", "STRING",
                           "CASE WHEN projetado IS NULL THEN 'Sem dados' WHEN taxa >= meta THEN 'Já atingiu' "
                           "WHEN projetado <= 2030 THEN 'Sim' ELSE 'Não no ritmo atual' END"),
}


def register_functions(spark: SparkSession) -> list[str]:
    """Create (or replace) the temporary SQL functions in this session."""
    for name, (args, ret, body) in FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({args}) RETURNS {ret} RETURN {body}")
    return list(FUNCTIONS)


def register_gold_views(spark: SparkSession, gold_root: str) -> list[str]:
    """Temporary views over the gold tables that exist (the SQL endpoint's tables)."""
    names = []
    for table in GOLD_PARTITIONS:
        df = read_optional(spark, gold_root, table)
        if df is not None:
            df.createOrReplaceTempView(table)
            names.append(table)
    return names


def sql_criticality(spark: SparkSession, kpi: DataFrame) -> DataFrame:
    """The criticality classification written in Spark SQL with the functions above."""
    register_functions(spark)
    kpi.createOrReplaceTempView("lt_kpi")
    return spark.sql("""
        SELECT ano, uf, regiao, rede, taxa, meta, lt_gap(meta, taxa) AS gap_meta,
               lt_atingimento(taxa, meta) AS percentual_atingimento,
               lt_criticidade(lt_gap(meta, taxa)) AS nivel_criticidade
        FROM lt_kpi WHERE taxa IS NOT NULL AND meta IS NOT NULL""")
