"""Silver validation suite: the published rule set (Q1-Q7) over the silver layer.

One aggregate per table carries all of its row rules; uniqueness and cross-table
key checks are one aggregate each. Returns a DataFrame of rule results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import quality as Q
from ..sources.io import read_layer, read_optional
from ..sources.schemas import LEVEL_COLUMNS, STUDENT

# Adjacent target pairs checked by default (all pairs 2024..2030).
TARGET_CHAIN = [f"meta_alfabetizacao_{y}" for y in range(2024, 2031)]


def silver_checks(spark: SparkSession, silver_root: str, target_chain=TARGET_CHAIN) -> DataFrame:
    mb = read_layer(spark, silver_root, "Meta_brasil")
    mu = read_layer(spark, silver_root, "Meta_uf")
    mm = read_layer(spark, silver_root, "Meta_municipio")
    au = read_layer(spark, silver_root, "Avaliacao_uf")
    students = read_optional(spark, silver_root, "Ts_aluno", STUDENT)
    levels = [c for c in LEVEL_COLUMNS if c in au.columns]
    parts = [
        Q.run_checks(mb, "meta_brasil", [Q.check_not_null(["ano", "rede"])]),
        Q.run_checks(mu, "meta_uf", [Q.check_not_null(["ano", "sigla_uf", "rede"]),
                                     Q.check_range("taxa_alfabetizacao", 0, 100),
                                     *Q.check_monotonic(target_chain)]),
        Q.run_checks(mm, "meta_municipio", [Q.check_not_null(["ano", "id_municipio"]),
                                            Q.check_range("taxa_alfabetizacao", 0, 100)]),
        Q.check_unique(mu, "meta_uf", ["ano", "sigla_uf", "rede"]),
        Q.check_unique(mm, "meta_municipio", ["ano", "id_municipio", "rede"]),
        Q.run_checks(au, "avaliacao_uf", [Q.check_sum(levels, 100, 2)]),
        Q.check_keys_match(mu, au, "meta_uf vs avaliacao_uf", "sigla_uf", sides=("meta", "avaliação")),
    ]
    if students is not None:
        parts += [Q.run_checks(students, "ts_aluno", [Q.check_range("vl_proficiencia_lp", 400, 1000)]),
                  Q.check_unique(students, "ts_aluno", ["nu_ano_avaliacao", "id_aluno"])]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
