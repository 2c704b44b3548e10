"""End to end on sf0.001 extracts: raw -> bronze (+stream) -> silver -> gold."""


import pytest
from pyspark.sql import functions as F

from letramento.plans.pipeline import run_pipeline
from letramento.plans.validation import silver_checks
from letramento.sources import schemas
from letramento.sources.io import read_layer, read_students

SF = "/root/testdata/sf0.001"
KEYS = {"panorama_alfabetizacao": ["ano", "granularidade", "codigo", "rede"],
        "ranking_municipios": ["ano", "id_municipio", "serie", "rede"],
        "indicadores_alunos": ["nu_ano_avaliacao", "sg_uf", "tp_dependencia"],
        "features_ml": ["ano", "id_municipio", "rede"], "desigualdade_regional": ["ano", "regiao", "rede"],
        "municipios_criticos": ["ano", "id_municipio", "rede"], "tendencia_temporal": ["ano", "sigla_uf", "rede"]}


@pytest.fixture(scope="module")
def root(spark):
    return run_pipeline(spark, SF)


def test_gold_tables_and_keys(spark, root):
    for table, keys in KEYS.items():
        df = read_layer(spark, f"{root}/gold", f"{table}")
        n = df.count()
        assert n > 0, table
        assert df.select(*keys).distinct().count() == n, table
        assert "_timestamp_gold" in df.columns


def test_gold_properties(spark, root):
    r = read_layer(spark, f"{root}/gold", "ranking_municipios")
    assert r.where((F.col("ranking") == 1) != (F.col("percentil") == 0)).count() == 0
    p = read_layer(spark, f"{root}/gold", "panorama_alfabetizacao").where(F.col("gap_meta_2030").isNotNull())
    bad = p.where(F.abs(F.col("gap_meta_2030") + F.col("taxa_alfabetizacao") - F.col("meta_alfabetizacao_2030")) > 0.0051)
    assert bad.count() == 0
    assert set(p.select("granularidade").distinct().toPandas()["granularidade"]) == {"Brasil", "UF", "Municipio"}


def test_silver_rules_and_dedup(spark, root):
    res = {(r.tabela, r.regra): r.status for r in silver_checks(spark, f"{root}/silver").collect()}
    assert res[("ts_aluno", "sem duplicatas (nu_ano_avaliacao+id_aluno)")] == "PASSOU"
    assert res[("meta_municipio", "taxa_alfabetizacao em [0, 100]")] == "PASSOU"
    assert res[("meta_uf vs avaliacao_uf", "sigla_uf consistente entre tabelas")] == "PASSOU"
    # the same pupils arrive by batch and by stream; silver keeps one row each
    bronze = read_students(spark, [f"{root}/bronze/Ts_aluno_batch", f"{root}/bronze/Ts_aluno_stream"])
    silver = read_layer(spark, f"{root}/silver", "Ts_aluno")
    assert bronze.count() > silver.count() == silver.select("nu_ano_avaliacao", "id_aluno").distinct().count()


def test_read_students_any_mix(spark, root):
    batch, stream = f"{root}/bronze/Ts_aluno_batch", f"{root}/bronze/Ts_aluno_stream"
    for paths in ([batch], [stream], [batch, stream]):
        df = read_students(spark, paths)
        assert df.schema == schemas.STUDENT and df.count() > 0
    assert read_students(spark, [f"{root}/none"]) is None


def test_refresh_students_after_new_events(spark, tmp_root):
    from letramento.plans.extracts import envelopes
    from letramento.plans.pipeline import refresh_students
    from letramento.plans.testbed import read_table
    events = read_table(spark, SF, "events")
    inbox = f"{tmp_root}/inbox"
    envelopes(events.where(F.col("event_type") == "view")).write.mode("append").json(inbox)
    refresh_students(spark, inbox, tmp_root)
    first = read_layer(spark, f"{tmp_root}/gold", "indicadores_alunos").agg(F.sum("total_alunos_avaliados")).first()[0]
    envelopes(events.where(F.col("event_type") == "click")).write.mode("append").json(inbox)
    written = refresh_students(spark, inbox, tmp_root)
    second = read_layer(spark, f"{tmp_root}/gold", "indicadores_alunos").agg(F.sum("total_alunos_avaliados")).first()[0]
    assert set(written) == {"indicadores_alunos", "indicadores_alunos_municipio"}
    assert 0 < first < second


def test_command_line_jobs(spark, root, tmp_root):
    from letramento.__main__ import main
    from letramento.streaming.events import health_report
    assert main(["gold", "--silver", f"{root}/silver", "--gold", f"{tmp_root}/gold"]) == 0
    assert read_layer(spark, f"{tmp_root}/gold", "features_ml").count() > 0
    assert main(["quality", "--silver", f"{root}/silver"]) == 0
    h = health_report(spark, f"{root}/bronze/Ts_aluno_stream").first()
    assert h.registros > h.rejeitados > 0 and 0 < h.taxa_erro < 0.05


def test_gold_refresh_of_one_year_prunes_and_keeps_other_years(spark, root, tmp_root):
    from letramento.plans.gold import build_gold, run_gold
    gold = f"{tmp_root}/gold-years"
    run_gold(spark, f"{root}/silver", gold)
    before = {r.ano: r.n for r in read_layer(spark, gold, "features_ml").groupBy("ano")
              .agg(F.count(F.lit(1)).alias("n")).collect()}
    plan = build_gold(spark, f"{root}/silver", years=[1998])["features_ml"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan and "1998" in plan
    run_gold(spark, f"{root}/silver", gold, years=[1998])
    after = {r.ano: r.n for r in read_layer(spark, gold, "features_ml").groupBy("ano")
             .agg(F.count(F.lit(1)).alias("n")).collect()}
    assert after == before and len(after) > 1
    full = read_layer(spark, f"{root}/gold", "tendencia_temporal").where("ano = 1998").drop("_timestamp_gold")
    part = read_layer(spark, gold, "tendencia_temporal").where("ano = 1998").drop("_timestamp_gold")
    assert full.count() > 0 and full.exceptAll(part).count() == 0 and part.exceptAll(full).count() == 0


def test_silver_discard_audit(spark, root):
    audit = {(r.tabela, r.motivo): r.registros for r in read_layer(spark, f"{root}/silver", "_auditoria").collect()}
    for table in ["Meta_municipio", "Ts_aluno"]:
        read = audit[(table, "lidos")]
        parts = sum(v for (t, m), v in audit.items() if t == table and m != "lidos")
        assert read == parts, table
        assert audit[(table, "gravados")] == read_layer(spark, f"{root}/silver", f"{table}").count()
    bronze = read_layer(spark, f"{root}/bronze", "Meta_municipio")
    over = bronze.where(F.col("taxa_alfabetizacao").try_cast("double") > 100).count()
    assert audit[("Meta_municipio", "fora_do_intervalo")] == over
    assert audit[("Ts_aluno", "duplicata")] > 0                        # batch + stream redelivery
    assert audit[("Ts_aluno", "fora_do_dominio")] > 0                  # dependency code 0


def test_command_line_layer_chain(spark, root, tmp_root):
    from letramento.__main__ import main
    raw = [f"{t}={root}/raw/{t}" for t in ["Meta_brasil", "Meta_uf", "Avaliacao_uf", "Ts_aluno"]]
    assert main(["bronze", "--raw", *raw, "--bronze", f"{tmp_root}/b"]) == 0
    assert main(["silver", "--bronze", f"{tmp_root}/b", "--silver", f"{tmp_root}/s"]) == 0
    assert main(["gold", "--silver", f"{tmp_root}/s", "--gold", f"{tmp_root}/g"]) == 0
    audit = {r.tabela for r in read_layer(spark, f"{tmp_root}/s", "_auditoria").collect()}
    assert audit == {"Meta_brasil", "Meta_uf", "Avaliacao_uf", "Ts_aluno"}
    # tables whose inputs are missing are skipped, the others are built
    assert read_layer(spark, f"{tmp_root}/g", "tendencia_temporal").count() > 0
    assert read_layer(spark, f"{tmp_root}/g", "indicadores_alunos").count() > 0


def test_critical_table_files_are_sorted_by_gap(spark, root):
    import glob

    import pyarrow.parquet as pq
    base = f"{root}/gold/municipios_criticos".replace("file:", "")
    files = glob.glob(f"{base}/_data/*/ano=*/*.parquet")
    assert files
    for f in files:
        gaps = [g for g in pq.read_table(f, columns=["gap_meta_2030"]).column(0).to_pylist() if g is not None]
        assert gaps == sorted(gaps, reverse=True), f


def test_read_optional_only_swallows_missing_tables(spark, tmp_root):
    import pytest as _pytest

    from letramento.sources.io import read_optional
    assert read_optional(spark, tmp_root, "does_not_exist") is None
    bad = f"{tmp_root}/bad_table"
    spark.createDataFrame([("not parquet",)], "t string").coalesce(1).write.text(bad)
    with _pytest.raises(Exception):
        read_optional(spark, tmp_root, "bad_table").collect()
