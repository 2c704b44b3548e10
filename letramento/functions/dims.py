"""Reference data: state codes, regions and school-network labels, plus lookups.

The tables are small and fixed by the coding of the source data, so lookups are
map-literal expressions evaluated inside the scan stage: no join, no shuffle.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .numeric import col_

# Fixed values: (state code, state abbreviation, region), in state-code order.
UF_TABLE = [
    (11, "RO", "Norte"), (12, "AC", "Norte"), (13, "AM", "Norte"), (14, "RR", "Norte"),
    (15, "PA", "Norte"), (16, "AP", "Norte"), (17, "TO", "Norte"),
    (21, "MA", "Nordeste"), (22, "PI", "Nordeste"), (23, "CE", "Nordeste"), (24, "RN", "Nordeste"),
    (25, "PB", "Nordeste"), (26, "PE", "Nordeste"), (27, "AL", "Nordeste"), (28, "SE", "Nordeste"),
    (29, "BA", "Nordeste"),
    (31, "MG", "Sudeste"), (32, "ES", "Sudeste"), (33, "RJ", "Sudeste"), (35, "SP", "Sudeste"),
    (41, "PR", "Sul"), (42, "SC", "Sul"), (43, "RS", "Sul"),
    (50, "MS", "Centro-Oeste"), (51, "MT", "Centro-Oeste"), (52, "GO", "Centro-Oeste"),
    (53, "DF", "Centro-Oeste"),
]

# Network names (upper-cased, trimmed) -> canonical label.
REDE_BY_NAME = {
    "PUBLICA": "Publica", "PÚBLICA": "Publica", "MUNICIPAL": "Municipal",
    "ESTADUAL": "Estadual", "FEDERAL": "Federal", "PRIVADA": "Privada",
}
# Network codes of the evaluation tables -> label.
REDE_BY_CODE = {"2": "Estadual", "3": "Municipal", "5": "Publica", "0": "Total"}
# Pupil school dependency codes -> label.
DEPENDENCIA = {1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada"}

UF_BY_CODE = {code: uf for code, uf, _ in UF_TABLE}
REGION_BY_UF = {uf: region for _, uf, region in UF_TABLE}


def map_literal(mapping: Mapping) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.create_map(*items)


def lookup(key: str | Column, mapping: Mapping) -> Column:
    """Value for ``key`` in a fixed mapping; null when absent."""
    return F.try_element_at(map_literal(mapping), col_(key))


def uf_from_code(code: str | Column) -> Column:
    return lookup(code, UF_BY_CODE)


def region_from_uf(uf: str | Column) -> Column:
    return lookup(uf, REGION_BY_UF)


def state_prefix(municipality_id: str | Column, digits: int = 2) -> Column:
    """Leading digits of a municipality id as an int (null if not numeric)."""
    return F.substring(col_(municipality_id).cast("string"), 1, digits).try_cast("int")


def dim_uf(spark: SparkSession) -> DataFrame:
    """The state dimension as a DataFrame (27 rows)."""
    return spark.createDataFrame(UF_TABLE, "co_uf int, sigla_uf string, regiao string")
