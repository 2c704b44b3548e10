"""Declared schemas for every input (no schema inference at any layer).

Raw CSV columns are declared as text and typed by ``try_cast`` in silver, so that a
code column such as ``rede`` is never guessed as a number.
"""

from __future__ import annotations

from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType, TimestampType)

TARGET_YEARS = list(range(2024, 2031))
TARGET_COLUMNS = [f"meta_alfabetizacao_{y}" for y in TARGET_YEARS]
LEVEL_COLUMNS = [f"proporcao_aluno_nivel_{i}" for i in range(9)]


#: Columns that a raw file must have where its schema declares them.
KEY_COLUMNS = ("ano", "sigla_uf", "id_municipio", "rede", "nu_ano_avaliacao", "id_aluno")


def _text(*names: str) -> list[StructField]:
    return [StructField(n, StringType(), True) for n in names]


META_BRASIL_RAW = StructType(_text("ano", "rede", "taxa_alfabetizacao", *TARGET_COLUMNS,
                                   "percentual_participacao"))
META_UF_RAW = StructType(_text("ano", "sigla_uf", "rede", "taxa_alfabetizacao", *TARGET_COLUMNS,
                               "percentual_participacao"))
META_MUNICIPIO_RAW = StructType(_text("ano", "id_municipio", "rede", "taxa_alfabetizacao", *TARGET_COLUMNS,
                                      "nivel_alfabetizacao", "percentual_participacao"))
AVALIACAO_UF_RAW = StructType(_text("ano", "sigla_uf", "serie", "rede", "taxa_alfabetizacao",
                                    "media_portugues", *LEVEL_COLUMNS))
AVALIACAO_MUNICIPIO_RAW = StructType(_text("ano", "id_municipio", "serie", "rede", "taxa_alfabetizacao",
                                           "media_portugues", *LEVEL_COLUMNS))

# Typed silver columns per source.
META_TYPES = {"ano": "int", "taxa_alfabetizacao": "double", "percentual_participacao": "double",
              **{c: "double" for c in TARGET_COLUMNS}}
META_MUNICIPIO_TYPES = {**META_TYPES, "id_municipio": "int", "nivel_alfabetizacao": "int"}
AVALIACAO_TYPES = {"ano": "int", "serie": "int", "taxa_alfabetizacao": "double", "media_portugues": "double",
                   **{c: "double" for c in LEVEL_COLUMNS}}
AVALIACAO_MUNICIPIO_TYPES = {**AVALIACAO_TYPES, "id_municipio": "int"}

# Pupil record: the 27 data fields in contract order, then lineage and the day.
_I, _L, _S, _D = IntegerType(), LongType(), StringType(), DoubleType()
STUDENT_DATA_FIELDS: list[tuple[str, object]] = [
    ("nu_ano_avaliacao", _I), ("co_uf", _I), ("sg_uf", _S), ("id_aluno", _L), ("tp_serie", _I),
    ("id_escola", _L), ("tp_dependencia", _I), ("co_municipio", _I), ("no_municipio", _S),
    ("in_presenca_lp", _I), ("in_preenchimento_lp", _I), ("co_caderno_lp", _I),
]
for _b in range(1, 5):
    STUDENT_DATA_FIELDS += [(f"co_bloco_{_b}", _I), (f"tx_resposta_bloco_{_b}", _S), (f"tx_gabarito_bloco_{_b}", _S)]
STUDENT_DATA_FIELDS += [("vl_peso_aluno_lp", _D), ("vl_proficiencia_lp", _D), ("in_alfabetizado", _I)]

STUDENT_LINEAGE_FIELDS = [("_timestamp_ingestao", TimestampType()), ("_fonte", _S), ("_arquivo_original", _S)]

STUDENT = StructType([StructField(n, t, True) for n, t in
                      STUDENT_DATA_FIELDS + STUDENT_LINEAGE_FIELDS + [("data_ingestao", _S)]])
STUDENT_RAW = StructType(_text(*[n for n, _ in STUDENT_DATA_FIELDS]))
STUDENT_TYPES = {n: t.simpleString() for n, t in STUDENT_DATA_FIELDS}

# Stream bronze: every record once; rejected ones keep the raw record and a reason (partitioned by estado).
INGEST_EXTRA_FIELDS = [("registro_rejeitado", _S), ("motivo", _S), ("estado", _S)]
INGESTED = StructType([StructField(n, t, True) for n, t in
                       STUDENT_DATA_FIELDS + STUDENT_LINEAGE_FIELDS + [("data_ingestao", _S)] + INGEST_EXTRA_FIELDS])

# Stream envelope: one base64 field; its JSON object is read with every field as text.
ENVELOPE = StructType([StructField("data", StringType(), True)])
EVENT_TEXT = StructType(_text(*[n for n, _ in STUDENT_DATA_FIELDS]) + [StructField("_corrupt", StringType(), True)])
