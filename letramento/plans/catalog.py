"""Query catalogue over the shared test tables: one entry per operator family.

Each query takes (spark, sf_dir) and returns a DataFrame without running an action
except ``stream_ingest``, ``stream_refresh``, ``stream_dedup``, ``stream_running_rate``,
``stream_replay``, ``silver_merged``, ``merged_states`` and ``replaced_years``, which run their streams or
writes to completion first, and the ``gold_*``, ``roundtrip_layers`` and ``silver_quality`` queries, which read
one run of all layers per session and input folder. Rankings, lags and quantiles count their input first
(W1-W3, A8, A9). The SQL twin of every query lives
in ``oracle.py``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dims
from ..functions import measures as M
from ..functions.numeric import percent, round_half_up
from ..operators import aggregates as A
from ..operators import clean as C
from ..operators import quality as Q
from ..operators import windows as W
from ..session import scratch_path
from ..sources.io import read_layer, write_layer
from ..streaming import events as S
from ..streaming import health
from ..streaming.replay import replay_rejected
from .bronze import STUDENT_REPLAY_TABLE, STUDENT_STREAM_TABLE
from .extracts import NOISE, envelopes
from .pipeline import ingest_stream, refresh_students, run_pipeline, write_inbox
from .silver import upsert_students
from .testbed import kpi, kpi_rows, pupil, read_table
from .validation import silver_checks

ALL_TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
              "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]
# The order priorities of the orders table, in code order.
PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
# Padded, mixed-case network names used to exercise canonicalisation.
RAW_NETWORKS = [" publica", "PÚBLICA ", "Municipal", " ESTADUAL", "federal ", "Privada", "  Outra  "]
BATCH_DAY = "2026-07-09"
#: Rows a slice in the queries that show sliced operators: the tables of every size take as many slices as there are shuffle partitions.
SMALL_SLICE = 20


# --- C1-C5, C12, A5 ------------------------------------------------------------------

def gap_attainment(spark: SparkSession, sf: str) -> DataFrame:
    k = kpi(spark, sf).withColumn("meta_2026", F.when(F.col("ano") >= 1998, F.lit(50.0)))
    return k.select("ano", "uf", "regiao", "rede", "taxa", "meta",
                    M.gap("meta", "taxa").alias("gap_meta"),
                    M.attainment("taxa", "meta").alias("percentual_atingimento"),
                    F.when(F.col("meta_2026").isNotNull(), M.gap("meta_2026", "taxa")).alias("distancia_meta_2026"),
                    M.reached("taxa", "meta").alias("meta_atingida"))


def _critical(spark: SparkSession, sf: str) -> DataFrame:
    k = C.require_keys(kpi(spark, sf), ["taxa", "meta"])
    return k.select("ano", "uf", "regiao", "rede", "taxa", "meta",
                    M.gap("meta", "taxa").alias("gap_meta"),
                    M.attainment("taxa", "meta").alias("percentual_atingimento")) \
            .withColumn("nivel_criticidade", M.criticality("gap_meta"))


def criticality(spark: SparkSession, sf: str) -> DataFrame:
    return W.sort_for_write(_critical(spark, sf), ["ano"], [F.col("gap_meta").desc()])


def criticality_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.label_counts(_critical(spark, sf), "nivel_criticidade", M.CRITICALITY_ORDER)


def rate_band(spark: SparkSession, sf: str) -> DataFrame:
    k = kpi(spark, sf).withColumn("faixa", M.rate_band("taxa"))
    return A.label_counts(k, "faixa", M.RATE_BAND_ORDER)


# --- W1-W4, C6-C9, C13-C15, O3-O4 --------------------------------------------------------

def rank_within_group(spark: SparkSession, sf: str) -> DataFrame:
    k = C.require_keys(kpi(spark, sf), ["taxa"]).select("ano", "regiao", "rede", "uf", "taxa")
    return W.rank_within(k, ["ano", "regiao", "rede"], "taxa", descending=True)


def rank_by_text(spark: SparkSession, sf: str) -> DataFrame:
    """W1 + W2 in slices, by a text column: events of a type in the order of their properties, many of them equal."""
    e = read_table(spark, sf, "events").select("event_id", "event_type", "props")
    return W.rank_within(e, ["event_type"], "props", descending=False, slice_rows=SMALL_SLICE)


def lag_by_text(spark: SparkSession, sf: str) -> DataFrame:
    """W3 in slices, all rows in one group, in the order of a text and a number."""
    e = read_table(spark, sf, "events").select("event_id", "props", "value")
    return W.lag_within(e, [], ["props", "event_id"], "value", "valor_anterior", slice_rows=SMALL_SLICE)


def sliced_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    """A8 + A9 in slices: events by type."""
    return A.describe(read_table(spark, sf, "events"), "value", ["event_type"], slice_rows=SMALL_SLICE)


def merged_sketches(spark: SparkSession, sf: str) -> DataFrame:
    """A sketch per type and day, merged per type; the exact rank of each quantile is within 2 % of the rows of the wanted one."""
    e = read_table(spark, sf, "events").select("event_type", F.to_date("ts").alias("dia"), "value")
    daily = A.quantile_sketches(e, "value", ["event_type", "dia"])
    probs = {"q25": 0.25, "mediana": 0.5, "q95": 0.95}
    found = A.sketch_quantiles(A.merge_sketches(daily, ["event_type"]), list(probs.values()), list(probs))
    placed = e.join(found, "event_type")  # one row per type on this side
    # a value that occurs often holds a range of ranks: the wanted one may lie anywhere in it
    ranks = placed.groupBy("event_type", "n").agg(*[F.struct(F.count_if(F.col("value") < F.col(q)).alias("lo"),
                                                             F.count_if(F.col("value") <= F.col(q)).alias("hi")).alias(q) for q in probs])
    return ranks.select("event_type", "n", *[((F.col(f"{q}.lo") <= (p + 0.02) * F.col("n")) & (F.col(f"{q}.hi") >= (p - 0.02) * F.col("n")))
                                             .alias(f"{q}_no_limite") for q, p in probs.items()])


def _trend(spark: SparkSession, sf: str) -> DataFrame:
    t = C.require_keys(kpi(spark, sf), ["taxa"]).select("ano", "uf", "rede", "taxa", "meta")
    t = W.lag_within(t, ["uf", "rede"], ["ano"], "taxa", "taxa_ano_anterior")
    t = (t.withColumn("variacao_anual", M.yearly_change("taxa", "taxa_ano_anterior"))
         .withColumn("anos_para_meta", M.years_to_target("taxa", "meta", "variacao_anual"))
         .withColumn("ano_projetado_atingimento", M.projected_year("ano", "anos_para_meta")))
    return (t.withColumn("vai_atingir_2030", M.projection_status("taxa", "meta", "ano_projetado_atingimento"))
            .drop("taxa_ano_anterior"))


def yearly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return _trend(spark, sf)


def top_changes(spark: SparkSession, sf: str) -> DataFrame:
    t = _trend(spark, sf).where(F.col("variacao_anual").isNotNull())
    top = W.top_k(t, 3, [F.col("variacao_anual").desc(), F.col("ano").desc(), F.col("uf"), F.col("rede")])
    return top.select("ano", "uf", "rede", "variacao_anual", "vai_atingir_2030")


def regressions(spark: SparkSession, sf: str) -> DataFrame:
    return _trend(spark, sf).where(F.col("variacao_anual") < 0).select("ano", "uf", "rede", "variacao_anual")


def first_last_pace(spark: SparkSession, sf: str) -> DataFrame:
    series = kpi(spark, sf).groupBy("rede", "ano").agg(round_half_up(F.avg("taxa"), 2).alias("taxa"))
    return A.pace(series, ["rede"], "ano", "taxa", target=80.0, horizon=2030)


def first_last_points(spark: SparkSession, sf: str) -> DataFrame:
    return W.first_last(kpi(spark, sf), ["uf", "rede"], "ano", ["taxa", "n"])


def ordered_year(spark: SparkSession, sf: str) -> DataFrame:
    k = kpi(spark, sf).select("ano", "uf", "rede", "taxa")
    return W.ordered_slice(k, F.col("ano") == 1996, [F.col("taxa").desc(), F.col("uf"), F.col("rede")])


# --- A1-A4, A12 ---------------------------------------------------------------------------

def _indicators_uf(spark: SparkSession, sf: str) -> DataFrame:
    return A.student_indicators(pupil(spark, sf), ["ano", "co_uf", "rede"], present="presente",
                                literate="flag", score="score")


def student_indicators_uf(spark: SparkSession, sf: str) -> DataFrame:
    return _indicators_uf(spark, sf)


def student_indicators_fine(spark: SparkSession, sf: str) -> DataFrame:
    return A.student_indicators(pupil(spark, sf), ["ano", "co_uf", "co_municipio", "no_municipio", "rede"],
                                present="presente", literate="flag", score="score", with_minmax=False)


def merged_states(spark: SparkSession, sf: str) -> DataFrame:
    """G4 from states stored per day: some kinds of rows, then late days and days delivered again whole, whose states are replaced."""
    e = read_table(spark, sf, "events").select(F.col("event_id").alias("id_aluno"), F.to_date("ts").alias("dia"))
    rows = pupil(spark, sf).join(e, "id_aluno")
    keys, root = ["ano", "co_uf", "rede"], scratch_path(spark, "merged-states")

    def load(arrived: DataFrame, days=None) -> None:
        states = A.indicator_states(arrived, [*keys, "dia"], present="presente", literate="flag", score="score")
        write_layer(states, root, "estados", ["dia"], replace=days)

    load(rows.where("day(dia) <= 20 and rede in ('view', 'click')"))
    again = rows.where("day(dia) > 15")
    load(again, [r.dia for r in again.select("dia").distinct().collect()])  # one value per day of the calendar
    return A.indicators_of(A.merge_states(read_layer(spark, root, "estados"), keys), keys)


def indicator_rollup(spark: SparkSession, sf: str) -> DataFrame:
    out = A.rollup_indicators(_indicators_uf(spark, sf), ["co_uf"])
    return out.withColumn("media_prof", round_half_up("media_prof", 6))


def totals(spark: SparkSession, sf: str) -> DataFrame:
    return A.totals(_indicators_uf(spark, sf), "total_alunos_avaliados", "total_alfabetizados")


# --- A3, C10, C14 --------------------------------------------------------------------------

def regional_inequality(spark: SparkSession, sf: str) -> DataFrame:
    k = C.require_keys(kpi(spark, sf), ["taxa"])
    return A.regional_inequality(k, ["ano", "regiao", "rede"], "taxa", "meta")


def best_worst_spread(spark: SparkSession, sf: str) -> DataFrame:
    base = kpi(spark, sf).groupBy("ano", "regiao").agg(
        round_half_up(F.avg("taxa"), 2).alias("media"),
        round_half_up(F.avg("meta") - F.avg("taxa"), 2).alias("gap"))
    return A.best_worst(base, ["ano"], "regiao", "media", gap_col="gap")


# --- A6-A11, A13, A14 ---------------------------------------------------------------------

def crosstab_region_level(spark: SparkSession, sf: str) -> DataFrame:
    return A.crosstab(_critical(spark, sf), "regiao", "nivel_criticidade", M.CRITICALITY_ORDER)


def conditional_shares(spark: SparkSession, sf: str) -> DataFrame:
    c = _critical(spark, sf)
    preds = {"taxa_lt_20": F.col("taxa") < 20, "taxa_lt_50": F.col("taxa") < 50,
             "taxa_ge_80": F.col("taxa") >= 80, "gap_gt_50": F.col("gap_meta") > 50,
             "gap_lt_10": F.col("gap_meta") < 10}
    out = A.conditional_counts(c, preds, ["regiao"],
                               extra={"ritmo_necessario": M.required_pace(F.avg("gap_meta"), 2030 - 2024)})
    return out.withColumn("ritmo_necessario", round_half_up("ritmo_necessario", 6))


def describe_quantiles(spark: SparkSession, sf: str) -> DataFrame:
    return A.describe(_critical(spark, sf), "gap_meta")


def describe_by_region(spark: SparkSession, sf: str) -> DataFrame:
    return A.describe(_critical(spark, sf), "gap_meta", by=["regiao"])


def histogram30(spark: SparkSession, sf: str) -> DataFrame:
    return A.histogram(kpi(spark, sf), "taxa", 30)


def histogram12(spark: SparkSession, sf: str) -> DataFrame:
    return A.histogram(pupil(spark, sf), "score", 12)


def corr_matrix(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice", "l_discount")
    p = read_table(spark, sf, "part").select("p_partkey", "p_retailprice")
    j = li.join(p, li.l_partkey == p.p_partkey)
    return A.corr_matrix(j, ["l_quantity", "l_extendedprice", "l_discount", "p_retailprice"])


def class_balance(spark: SparkSession, sf: str) -> DataFrame:
    return A.class_balance(gap_attainment(spark, sf), "meta_atingida")


def table_counts(spark: SparkSession, sf: str) -> DataFrame:
    return A.table_counts({t: read_table(spark, sf, t) for t in ALL_TABLES})


# --- P, F, D, U, M --------------------------------------------------------------------------

def conform_union(spark: SparkSession, sf: str) -> DataFrame:
    rows = kpi_rows(spark, sf)
    cols = ["ano", "rede", "taxa_alfabetizacao", "meta_alfabetizacao_2030"]

    def grain(keys: list[str]) -> DataFrame:
        g = rows.groupBy("ano", *keys, "rede").agg(F.count(F.lit(1)).alias("n"), F.count_if("_ok").alias("k"))
        return g.withColumn("taxa_alfabetizacao", percent("k", "n", 2)) \
                .withColumn("meta_alfabetizacao_2030", F.lit(60.0))

    world = C.conform(grain([]), "Mundo", F.lit("ALL"), F.lit("Mundo"), cols)
    region = C.conform(grain(["regiao"]), "Regiao", F.col("regiao"), F.col("regiao"), cols)
    nation = C.conform(grain(["uf"]), "Nacao", F.col("uf"), F.col("uf"), cols)
    out = C.union_by_name([world, region, nation])
    t, m = "taxa_alfabetizacao", "meta_alfabetizacao_2030"
    return (out.withColumn("gap_meta_2030", M.gap(m, t))
            .withColumn("percentual_atingimento_2030", M.attainment(t, m, positive_target_only=True))
            .withColumn("meta_atingida_2030", M.reached(t, m)))


def _raw_network(key: str) -> F.Column:
    return F.element_at(F.array(*[F.lit(x) for x in RAW_NETWORKS]),
                        (F.col(key) % len(RAW_NETWORKS)).cast("int") + 1)


def canonicalise(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", _raw_network("o_orderkey").alias("rede_bruta"))
    return C.canonicalise_by_name(o, "rede_bruta", dims.REDE_BY_NAME, out="rede")


def canonicalise_code(spark: SparkSession, sf: str) -> DataFrame:
    o = read_table(spark, sf, "orders").select("o_orderkey", (F.col("o_orderkey") % 7).cast("int").alias("codigo"))
    return C.canonicalise_by_code(o, "codigo", dims.REDE_BY_CODE, out="rede")


def prefix_lookup(spark: SparkSession, sf: str) -> DataFrame:
    c = read_table(spark, sf, "customer").select(
        "c_custkey", ((F.col("c_custkey") % 45 + 10) * 100000 + F.col("c_custkey") % 100000).alias("id_municipio"))
    c = c.withColumn("co_uf", dims.state_prefix("id_municipio"))
    c = c.withColumn("sigla_uf", dims.uf_from_code("co_uf"))
    return c.withColumn("regiao", dims.region_from_uf("sigla_uf"))


def _raw_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Customer rows as a raw text extract, with nulls and out-of-range values."""
    c = read_table(spark, sf, "customer")
    rate = F.round(F.try_divide(F.col("c_acctbal"), F.lit(90.0)).try_cast("decimal(38,6)"), 2)
    return c.select(
        "c_custkey",
        F.when(F.col("c_custkey") % 7 == 0, F.lit(None).cast("string"))
         .otherwise((F.col("c_custkey") % 40 + 1990).cast("string")).alias("ano"),
        F.concat(F.lit(" "), F.lower("c_mktsegment"), F.lit(" ")).alias("uf"),
        _raw_network("c_custkey").alias("rede"),
        rate.cast("decimal(12,2)").cast("string").alias("taxa"),
        (F.col("c_nationkey") % 6).cast("string").alias("tp_dependencia"),
        F.lit("base_dos_dados").alias("_fonte"), F.lit("customer.parquet").alias("_arquivo_original"))


def _typed_customers(spark: SparkSession, sf: str) -> DataFrame:
    df = C.cast_columns(_raw_customers(spark, sf), {"ano": "int", "taxa": "double", "tp_dependencia": "int"})
    df = C.normalise_code(df, "uf")
    return C.canonicalise_by_name(df, "rede", dims.REDE_BY_NAME)


def clean_keys_ranges(spark: SparkSession, sf: str) -> DataFrame:
    df = C.require_keys(_typed_customers(spark, sf), ["ano", "uf", "rede"])
    df = C.in_range(df, "taxa", 0, 100)
    df = C.in_set(df, "tp_dependencia", [1, 2, 3, 4])
    return C.drop_lineage(df)


def reject_counts(spark: SparkSession, sf: str) -> DataFrame:
    df = _typed_customers(spark, sf)
    rules = [("chave_nula", F.col("ano").isNull() | F.col("uf").isNull() | F.col("rede").isNull()),
             ("fora_do_intervalo", F.col("taxa").isNotNull() & ~F.col("taxa").between(0, 100)),
             ("fora_do_dominio", ~F.coalesce(F.col("tp_dependencia").isin(1, 2, 3, 4), F.lit(False)))]
    return Q.reject_counts(df, rules)


def dedup_latest(spark: SparkSession, sf: str) -> DataFrame:
    li = read_table(spark, sf, "lineitem")
    return C.dedup(li, ["l_orderkey", "l_linenumber"], ["l_shipdate"])


def slice_with_fallback(spark: SparkSession, sf: str) -> DataFrame:
    k = kpi(spark, sf).select("ano", "uf", "regiao", "rede", "n", "taxa")
    return C.slice_with_fallback(k, "ano", 2030, 2001)


def slice_wanted_year(spark: SparkSession, sf: str) -> DataFrame:
    """F6 where the wanted year has rows."""
    k = kpi(spark, sf).select("ano", "uf", "regiao", "rede", "n", "taxa")
    return C.slice_with_fallback(k, "ano", 1997, 1994)


def assign_day(spark: SparkSession, sf: str) -> DataFrame:
    e = read_table(spark, sf, "events")
    et = F.col("event_type")
    e = e.select("event_id",
                 F.when(et.isin("view", "click"), F.lit("base_dos_dados"))
                  .when(et == "error", F.lit(None).cast("string"))
                  .otherwise(F.lit("kinesis_streaming")).alias("_fonte"),
                 F.when(et == "signup", F.lit(None).cast("string"))
                  .otherwise(F.date_format("ts", "yyyy-MM-dd")).alias("data_ingestao"))
    return C.assign_ingest_day(e, BATCH_DAY)


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    rows = kpi_rows(spark, sf)
    aggs = [F.count(F.lit(1)).alias("_n")]
    aggs += [F.count_if(F.col("o_orderpriority") == p).alias(f"_k{i}") for i, p in enumerate(PRIORITIES)]
    g = rows.groupBy("ano", "uf").agg(*aggs)
    levels = {f"proporcao_aluno_nivel_{i}": percent(f"_k{i}", "_n", 2) for i in range(len(PRIORITIES))}
    return g.withColumns(levels).drop("_n", *[f"_k{i}" for i in range(len(PRIORITIES))])


def level_distribution(spark: SparkSession, sf: str) -> DataFrame:
    lv = _levels(spark, sf)
    fam = C.family(lv, "proporcao_aluno_nivel_", range(9))
    out = C.select_existing(lv, ["ano", "uf"], fam)
    out = out.withColumn("soma_niveis", round_half_up(M.column_sum(fam), 2))
    return out.withColumn("dentro_tolerancia", (F.abs(F.col("soma_niveis") - 100) <= 2).cast("int"))


# --- J2, Q1-Q7 ---------------------------------------------------------------------------------

def key_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    return Q.key_mismatch(read_table(spark, sf, "orders"), read_table(spark, sf, "customer"),
                          "o_custkey", "c_custkey", sides=("pedidos", "clientes"))


def _buyers(spark: SparkSession, sf: str, year: int) -> DataFrame:
    o = read_table(spark, sf, "orders").where(F.year("o_orderdate") == year)
    return o.select(F.col("o_custkey").alias("cliente"))


def key_panel_mismatch(spark: SparkSession, sf: str) -> DataFrame:
    """J2 with keys on both sides: customers who ordered in only one of two years."""
    return Q.key_mismatch(_buyers(spark, sf, 1995), _buyers(spark, sf, 1996), "cliente", sides=("1995", "1996"))


def key_panel_check(spark: SparkSession, sf: str) -> DataFrame:
    """Q6 on the same keys: a rule that fails."""
    return Q.check_keys_match(_buyers(spark, sf, 1995), _buyers(spark, sf, 1996), "1995 vs 1996", "cliente", sides=("1995", "1996"))


def _quality_results(spark: SparkSession, sf: str) -> DataFrame:
    k = kpi(spark, sf)
    li = read_table(spark, sf, "lineitem")
    lv = _levels(spark, sf)
    fam = C.family(lv, "proporcao_aluno_nivel_", range(9))
    parts = [
        Q.run_checks(k, "kpi", [Q.check_not_null(["ano", "uf", "rede"]), Q.check_range("taxa", 0, 100),
                                *Q.check_monotonic(["n_ok", "n"]), *Q.check_monotonic(["taxa", "meta"])]),
        Q.check_unique(k, "kpi", ["ano", "uf", "rede"]),
        Q.run_checks(lv, "niveis", [Q.check_sum(fam, 100, 2)]),
        Q.run_checks(li, "lineitem", [Q.check_range("l_discount", 0, 0.1), Q.check_not_null(["l_orderkey"])]),
        Q.check_unique(li, "lineitem", ["l_orderkey", "l_linenumber"]),
        Q.check_keys_match(read_table(spark, sf, "orders").select(F.col("o_custkey").alias("chave")),
                           read_table(spark, sf, "customer").select(F.col("c_custkey").alias("chave")),
                           "pedidos vs clientes", "chave", sides=("pedidos", "clientes")),
    ]
    return C.union_by_name(parts)


def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    return _quality_results(spark, sf)


def quality_summary(spark: SparkSession, sf: str) -> DataFrame:
    r = Q.quality_report(_quality_results(spark, sf))
    return r.withColumn("regras_falhas", F.array_join("regras_falhas", "; "))


# --- ST1-ST11, K2 -----------------------------------------------------------------------------

CLOCK_COLUMNS = ["_timestamp_ingestao", "data_ingestao", "_timestamp_silver", "_timestamp_gold"]


def stream_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Batch twin of the stream: decode, split off malformed records, type, stamp."""
    good, _ = S.split_rejects(S.decode_events(envelopes(read_table(spark, sf, "events"))))
    return S.to_student_event(good).drop(*CLOCK_COLUMNS)


def stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return S.decoded_metrics(S.decode_events(envelopes(read_table(spark, sf, "events")))).drop("data_ingestao")


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    """``events.parquet`` read as a stream, encoded, ingested to bronze, read back."""
    schema = read_table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    root = scratch_path(spark, "stream-ingest")
    S.run_until_done(S.start_ingest(envelopes(source), f"{root}/bronze", f"{root}/checkpoints"))
    return S.read_ingested(spark, f"{root}/bronze").drop(*CLOCK_COLUMNS)


def stream_refresh(spark: SparkSession, sf: str) -> DataFrame:
    """ST11 twice: some events, then the others and the first ones again; each pupil counts once."""
    events = read_table(spark, sf, "events")
    early = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    root = scratch_path(spark, "stream-refresh")
    for arrived in (events.where(early), events):
        write_inbox(envelopes(arrived), f"{root}/inbox")
        refresh_students(spark, f"{root}/inbox", root, BATCH_DAY)
    return read_layer(spark, f"{root}/gold", "indicadores_alunos").drop(*CLOCK_COLUMNS)


def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """ST10 in the stream: deliveries that overlap, over three runs of the query; each record is written once."""
    events = read_table(spark, sf, "events")
    early = F.coalesce(F.col("event_type").isin("view", "click"), F.lit(False))
    root = scratch_path(spark, "stream-dedup")
    for arrived in (events.where(early), events, events.where(~early)):
        write_inbox(envelopes(arrived), f"{root}/inbox")
        ingest_stream(spark, f"{root}/inbox", f"{root}/bronze", "7 days")
    return S.read_ingested(spark, f"{root}/bronze/{STUDENT_STREAM_TABLE}").drop(*CLOCK_COLUMNS)


def stream_running_rate(spark: SparkSession, sf: str) -> DataFrame:
    """ST8 as state of a stream: records, rejects and their share per day of arrival, flagged."""
    schema = read_table(spark, sf, "events").schema
    source = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf)
    root = scratch_path(spark, "stream-rate")
    S.run_until_done(health.start_monitor(health.stamped(S.decode_events(envelopes(source))), S.is_malformed(), root, f"{root}/ckpt", stop=False))
    return health.running_rates(spark, root).drop("data_ingestao")


def stream_replay(spark: SparkSession, sf: str) -> DataFrame:
    """ST6: records with noise before their base64 are rejected, then mended and replayed, twice; each is added once."""
    root = scratch_path(spark, "stream-replay")
    write_inbox(envelopes(read_table(spark, sf, "events"), damaged="2"), f"{root}/inbox")
    ingest_stream(spark, f"{root}/inbox", f"{root}/bronze")
    for _ in range(2):
        replay_rejected(spark, f"{root}/bronze/{STUDENT_STREAM_TABLE}", f"{root}/bronze/{STUDENT_REPLAY_TABLE}",
                        lambda raw: F.regexp_replace(raw, f"^{NOISE}", ""))
    return read_layer(spark, f"{root}/bronze", STUDENT_REPLAY_TABLE).drop(*CLOCK_COLUMNS, "registro_origem", "lote_replay")


def silver_merged(spark: SparkSession, sf: str) -> DataFrame:
    """V6 by merging: overlapping arrivals, each into the (year, bucket) folders it touches."""
    events = read_table(spark, sf, "events")
    root = scratch_path(spark, "silver-merged")
    for kinds in (("view", "click"), ("purchase", "error", "view"), ("signup", "click", "error")):
        good, _ = S.split_rejects(S.decode_events(envelopes(events.where(F.col("event_type").isin(*kinds)))))
        upsert_students(S.to_student_event(good), root, BATCH_DAY)
    return read_layer(spark, root, "Ts_aluno").select("nu_ano_avaliacao", "sg_uf", "id_aluno", "tp_dependencia", "co_municipio", "no_municipio",
                                                      "in_presenca_lp", "vl_proficiencia_lp", "in_alfabetizado")


def replaced_years(spark: SparkSession, sf: str) -> DataFrame:
    """K1: a whole table, then two of its years replaced (one by fewer rows, one by none), then rows added to one."""
    k, root = kpi(spark, sf), scratch_path(spark, "replaced-years")
    write_layer(k, root, "kpi", ["ano"])
    write_layer(k.where("ano = 1997 and regiao = 'ASIA'"), root, "kpi", ["ano"], replace=[1997, 1998])
    write_layer(k.where("ano = 1998 and regiao = 'EUROPE'"), root, "kpi", ["ano"], mode="append")
    return read_layer(spark, root, "kpi").select(*k.columns)


# --- B1-B2, V1-V6, G1-G9 on extracts of the shared tables ------------------------------------------

GOLD_TABLES = ["panorama_alfabetizacao", "evolucao_proficiencia", "ranking_municipios", "indicadores_alunos",
               "indicadores_alunos_municipio", "features_ml", "desigualdade_regional", "municipios_criticos",
               "tendencia_temporal"]


def _gold_reader(table: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        root = run_pipeline(spark, sf)
        return read_layer(spark, f"{root}/gold", table).drop(*CLOCK_COLUMNS)
    query.__name__ = f"gold_{table}"
    return query


def roundtrip_layers(spark: SparkSession, sf: str) -> DataFrame:
    root = run_pipeline(spark, sf)
    return read_layer(spark, f"{root}/silver", "Meta_uf").drop(*CLOCK_COLUMNS)


def silver_quality(spark: SparkSession, sf: str) -> DataFrame:
    return silver_checks(spark, f"{run_pipeline(spark, sf)}/silver")


def sql_criticality(spark: SparkSession, sf: str) -> DataFrame:
    """Same result as ``criticality``, written in Spark SQL over the SQL measure functions."""
    from .sql import sql_criticality as run
    return run(spark, kpi(spark, sf))


QUERIES = {
    "gap_attainment": gap_attainment,
    "criticality": criticality,
    "criticality_counts": criticality_counts,
    "rate_band": rate_band,
    "rank_within_group": rank_within_group,
    "rank_by_text": rank_by_text,
    "lag_by_text": lag_by_text,
    "sliced_quantiles": sliced_quantiles,
    "merged_sketches": merged_sketches,
    "yearly_trend": yearly_trend,
    "top_changes": top_changes,
    "regressions": regressions,
    "first_last_pace": first_last_pace,
    "first_last_points": first_last_points,
    "ordered_year": ordered_year,
    "student_indicators_uf": student_indicators_uf,
    "student_indicators_fine": student_indicators_fine,
    "merged_states": merged_states,
    "indicator_rollup": indicator_rollup,
    "totals": totals,
    "regional_inequality": regional_inequality,
    "best_worst_spread": best_worst_spread,
    "crosstab_region_level": crosstab_region_level,
    "conditional_shares": conditional_shares,
    "describe_quantiles": describe_quantiles,
    "describe_by_region": describe_by_region,
    "histogram30": histogram30,
    "histogram12": histogram12,
    "corr_matrix": corr_matrix,
    "class_balance": class_balance,
    "table_counts": table_counts,
    "conform_union": conform_union,
    "canonicalise": canonicalise,
    "canonicalise_code": canonicalise_code,
    "prefix_lookup": prefix_lookup,
    "clean_keys_ranges": clean_keys_ranges,
    "reject_counts": reject_counts,
    "dedup_latest": dedup_latest,
    "slice_with_fallback": slice_with_fallback,
    "slice_wanted_year": slice_wanted_year,
    "assign_day": assign_day,
    "level_distribution": level_distribution,
    "key_mismatch": key_mismatch,
    "key_panel_mismatch": key_panel_mismatch,
    "key_panel_check": key_panel_check,
    "quality_report": quality_report,
    "quality_summary": quality_summary,
    "sql_criticality": sql_criticality,
    "stream_decode": stream_decode,
    "stream_metrics": stream_metrics,
    "stream_ingest": stream_ingest,
    "stream_refresh": stream_refresh,
    "stream_dedup": stream_dedup,
    "stream_running_rate": stream_running_rate,
    "stream_replay": stream_replay,
    "silver_merged": silver_merged,
    "replaced_years": replaced_years,
    "roundtrip_layers": roundtrip_layers,
    "silver_quality": silver_quality,
    **{f"gold_{t}": _gold_reader(t) for t in GOLD_TABLES},
}
