"""Domain-shaped raw extracts derived from the shared test tables.

The real inputs (indicator CSVs and pupil files) are not available, so the whole
orders / customer / nation and events tables are reshaped into the same layouts,
as text, the way the CSV exports arrive: indicator rows per (year, entity,
segment-as-network) with target ladders and level shares, and pupil records per
event. Padded and mixed-case codes, null keys and out-of-range values are derived
from the data itself so that every silver rule has work to do.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dims import UF_TABLE, uf_from_code
from ..functions.numeric import percent, round_half_up
from ..sources.schemas import LEVEL_COLUMNS, TARGET_COLUMNS, TARGET_YEARS
from .testbed import read_table

# Market segment -> raw network name and raw network code.
SEGMENT_NAME = {"AUTOMOBILE": " publica", "BUILDING": "MUNICIPAL ", "FURNITURE": "estadual",
                "HOUSEHOLD": "Federal", "MACHINERY": "privada"}
SEGMENT_CODE = {"AUTOMOBILE": "2", "BUILDING": "3", "FURNITURE": "5", "HOUSEHOLD": "0", "MACHINERY": "9"}
UF_CODES = [code for code, _, _ in UF_TABLE]


def _code_of(key: Column) -> Column:
    return F.element_at(F.array(*[F.lit(c) for c in UF_CODES]), (key % len(UF_CODES)).cast("int") + 1)


def _map(mapping: dict, key: Column) -> Column:
    items = []
    for k, v in mapping.items():
        items += [F.lit(k), F.lit(v)]
    return F.try_element_at(F.create_map(*items), key)


def order_facts(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("int").alias("ano"), (F.col("o_orderstatus") == "F").alias("ok"),
        F.col("o_orderpriority").isin("1-URGENT", "2-HIGH").alias("part"),
        F.least(F.floor(F.col("o_totalprice") / 60000), F.lit(8)).cast("int").alias("nivel"),
        (F.col("o_totalprice") / 1000).alias("nota"))
    c = read_table(spark, sf, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    j = o.join(c, o.o_custkey == c.c_custkey)
    code = _code_of(F.col("c_nationkey"))
    return j.select("ano", "ok", "part", "nivel", "nota", "c_mktsegment", "c_custkey",
                    code.alias("co_uf"), uf_from_code(code).alias("sigla"),
                    (code * 100000 + F.col("c_custkey") % 100000).cast("int").alias("id_municipio"))


def _txt(c: Column) -> Column:
    return c.cast("string")


def _indicator(facts: DataFrame, keys: list[str]) -> DataFrame:
    return facts.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if("ok").alias("_ok"),
                                    F.count_if("part").alias("_part"), F.avg("nota").alias("_nota"),
                                    *[F.count_if(F.col("nivel") == i).alias(f"_l{i}") for i in range(9)])


def _targets(base: Column, year: Column) -> list[Column]:
    cols = []
    for y, name in zip(TARGET_YEARS, TARGET_COLUMNS):
        value = round_half_up(base + F.lit(2.0 * (y - 2024)), 2)
        if y == 2026:
            value = F.when(year > 1995, value)
        cols.append(_txt(value).alias(name))
    return cols


def _rate(c: DataFrame) -> Column:
    return percent("_ok", "_n", 2)


def meta_extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    facts = order_facts(spark, sf)
    rede = _map(SEGMENT_NAME, F.col("c_mktsegment"))
    br = _indicator(facts, ["ano", "c_mktsegment"])
    uf = _indicator(facts, ["ano", "sigla", "c_mktsegment"])
    mu = _indicator(facts, ["ano", "id_municipio", "c_mktsegment"])
    base = F.lit(50.0)
    meta_brasil = br.select(_txt(F.col("ano")).alias("ano"), rede.alias("rede"), _txt(_rate(br)).alias("taxa_alfabetizacao"),
                            *_targets(base, F.col("ano")), _txt(percent("_part", "_n", 2)).alias("percentual_participacao"))
    meta_uf = uf.select(_txt(F.col("ano")).alias("ano"), F.concat(F.lit(" "), F.lower("sigla")).alias("sigla_uf"),
                        rede.alias("rede"), _txt(_rate(uf)).alias("taxa_alfabetizacao"),
                        *_targets(base + F.length("sigla"), F.col("ano")),
                        _txt(percent("_part", "_n", 2)).alias("percentual_participacao"))
    rate_mu = F.when(F.col("id_municipio") % 97 == 0, F.lit(150.0)).otherwise(_rate(mu))
    meta_mu = mu.select(_txt(F.col("ano")).alias("ano"), _txt(F.col("id_municipio")).alias("id_municipio"),
                        rede.alias("rede"), _txt(rate_mu).alias("taxa_alfabetizacao"),
                        *_targets(base + (F.col("id_municipio") % 7), F.col("ano")),
                        _txt(F.least(F.floor(_rate(mu) / 20) + 1, F.lit(5))).alias("nivel_alfabetizacao"),
                        _txt(percent("_part", "_n", 2)).alias("percentual_participacao"))
    return {"Meta_brasil": meta_brasil, "Meta_uf": meta_uf, "Meta_municipio": meta_mu}


def evaluation_extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    facts = order_facts(spark, sf)
    code = _map(SEGMENT_CODE, F.col("c_mktsegment"))
    uf = _indicator(facts, ["ano", "sigla", "c_mktsegment"])
    mu = _indicator(facts, ["ano", "id_municipio", "c_mktsegment"])

    def body(df: DataFrame) -> list[Column]:
        levels = [_txt(percent(f"_l{i}", "_n", 2)).alias(name) for i, name in enumerate(LEVEL_COLUMNS)]
        return [F.lit("2").alias("serie"), code.alias("rede"), _txt(_rate(df)).alias("taxa_alfabetizacao"),
                _txt(round_half_up(F.col("_nota"), 2)).alias("media_portugues"), *levels]

    return {"Avaliacao_uf": uf.select(_txt(F.col("ano")).alias("ano"), F.col("sigla").alias("sigla_uf"), *body(uf)),
            "Avaliacao_municipio": mu.select(_txt(F.col("ano")).alias("ano"),
                                             _txt(F.col("id_municipio")).alias("id_municipio"), *body(mu))}


def pupil_fields(spark: SparkSession, sf: str) -> tuple[DataFrame, dict[str, Column]]:
    """Events as pupil records: the 27 contract fields as columns over ``events``."""
    e = read_table(spark, sf, "events")
    return e, pupil_columns()


def pupil_columns() -> dict[str, Column]:
    """The 27 contract fields as expressions over an ``events`` frame (batch or stream)."""
    code = _code_of(F.col("user_id"))
    present = F.col("event_type") != "error"
    score = F.when(present, round_half_up(F.lit(400.0) + F.col("value") * 1.5, 2))
    k = F.get_json_object("props", "$.k")
    answers = F.substring(F.sha2(F.col("event_id").cast("string"), 256), 1, 9)
    fields: dict[str, Column] = {
        "nu_ano_avaliacao": F.year("ts"), "co_uf": code,
        "sg_uf": F.concat(F.lit(" "), F.lower(uf_from_code(code))), "id_aluno": F.col("event_id"),
        "tp_serie": F.lit(2), "id_escola": F.col("user_id") * 10 + 1,
        "tp_dependencia": F.col("event_id") % 5, "co_municipio": code * 100000 + F.col("user_id"),
        "no_municipio": F.when(F.col("event_type") == "signup", F.lit("None"))
                         .otherwise(F.concat(F.lit("Cidade "), F.col("user_id").cast("string"))),
        "in_presenca_lp": F.when(present, F.lit(1)).otherwise(F.lit(0)),
        "in_preenchimento_lp": F.when(present, F.lit(1)).otherwise(F.lit(0)),
        "co_caderno_lp": F.when(present, k.try_cast("int") % 24 + 1),
    }
    for b in range(1, 5):
        fields[f"co_bloco_{b}"] = F.when(present, (F.col("event_id") + b) % 30 + 1)
        fields[f"tx_resposta_bloco_{b}"] = F.when(present, F.upper(answers))
        fields[f"tx_gabarito_bloco_{b}"] = F.when(present, F.lit("ABCDEABCD"))
    fields["vl_peso_aluno_lp"] = F.when(present, F.lit(1.2))
    fields["vl_proficiencia_lp"] = score
    fields["in_alfabetizado"] = F.when(score.isNotNull(), F.when(score >= 743, F.lit(1)).otherwise(F.lit(0)))
    return fields


# Events whose props key k is 0 carry undecodable base64, k = 1 broken JSON.
FAULT_BASE64, FAULT_JSON = "0", "1"


NOISE = "%%"


def envelopes(events: DataFrame, damaged: str | None = None) -> DataFrame:
    """Wire records for ``events`` (column ``data``), with the data-derived faults above.

    Records whose key k is ``damaged`` arrive with ``NOISE`` before their base64.
    """
    from ..streaming.events import envelope_data
    k = F.get_json_object("props", "$.k")
    whole = envelope_data(pupil_columns())
    return events.select(F.when(k == FAULT_BASE64, F.lit("%%not-base64%%"))
                         .when(k == FAULT_JSON, F.base64(F.encode(F.lit("{bad json"), "UTF-8")))
                         .when(k == F.lit(damaged), F.concat(F.lit(NOISE), whole)).otherwise(whole).alias("data"))


def pupil_extract(spark: SparkSession, sf: str) -> DataFrame:
    e, fields = pupil_fields(spark, sf)
    return e.select(*[c.cast("string").alias(n) for n, c in fields.items()])


def raw_extracts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    out = {**meta_extracts(spark, sf), **evaluation_extracts(spark, sf)}
    out["Ts_aluno"] = pupil_extract(spark, sf)
    return out
