"""Stream ingestion: decode rules, quarantine, restart safety, batch/stream parity."""

from pyspark.sql import functions as F

from letramento.sources import schemas
from letramento.streaming import events as S


def test_malformed_records(spark):
    bodies = ['{"a":3.7}', "[1,2]", "{bad", "null", '{"a":null}']
    df = spark.createDataFrame([(b,) for b in bodies], "t string").select(F.base64(F.encode("t", "UTF-8")).alias("data"))
    df = df.unionByName(spark.createDataFrame([("@@not base64@@",)], "data string"))
    good, bad = S.split_rejects(S.decode_events(df))
    assert good.count() == 2 and bad.count() == 4
    assert sorted(r.motivo for r in bad.collect()) == ["base64_invalido", "json_invalido", "json_invalido", "json_invalido"]


def test_typed_record(spark):
    body = '{"nu_ano_avaliacao": 2025, "co_uf": "35", "sg_uf": " sp", "id_aluno": 99999999999, "co_municipio": 3.5e6,' \
           ' "no_municipio": "None", "vl_proficiencia_lp": "743.5", "in_alfabetizado": "nan", "co_bloco_1": 9999999999}'
    df = spark.createDataFrame([(body,)], "t string").select(F.base64(F.encode("t", "UTF-8")).alias("data"))
    good, _ = S.split_rejects(S.decode_events(df))
    r = S.to_student_event(good).first()
    assert (r.nu_ano_avaliacao, r.co_uf, r.sg_uf, r.id_aluno, r.co_municipio) == (2025, 35, " sp", 99999999999, 3500000)
    assert (r.no_municipio, r.vl_proficiencia_lp, r.in_alfabetizado, r.co_bloco_1) == (None, 743.5, None, None)
    assert r._fonte == "kinesis_streaming" and r.data_ingestao is not None


def test_stream_restart_adds_nothing_and_quarantines(spark, tmp_root):
    inbox = f"{tmp_root}/inbox"
    rows = [(f'{{"nu_ano_avaliacao": 2025, "id_aluno": {i}, "co_uf": 35}}',) for i in range(20)] + [("{bad",)]
    df = spark.createDataFrame(rows, "t string").select(F.base64(F.encode("t", "UTF-8")).alias("data"))
    df.coalesce(1).write.json(inbox)
    args = (f"{tmp_root}/bronze", f"{tmp_root}/ckpt")
    S.run_until_done(S.start_ingest(S.read_envelope_stream(spark, inbox), *args))
    first = S.read_ingested(spark, args[0]).count()
    S.run_until_done(S.start_ingest(S.read_envelope_stream(spark, inbox), *args))
    assert first == 20 and S.read_ingested(spark, args[0]).count() == 20
    q = S.read_ingested(spark, args[0], S.STATE_REJECTED).collect()
    assert [(r.registro_rejeitado is not None, r.motivo) for r in q] == [(True, "json_invalido")]
    assert S.read_ingested(spark, args[0]).schema == schemas.STUDENT


def test_metrics(spark):
    good = spark.createDataFrame([("d",)] * 19, "data_ingestao string")
    bad = spark.createDataFrame([("d",)], "data_ingestao string")
    r = S.ingest_metrics(good, bad).first()
    assert (r.registros, r.rejeitados, r.taxa_erro, r.acima_limite) == (20, 1, 0.05, False)


def test_empty_batch_writes_no_file(spark, tmp_root):
    import os
    inbox = f"{tmp_root}/empty-inbox"
    spark.createDataFrame([], "data string").write.json(inbox)
    args = (f"{tmp_root}/bronze-empty", f"{tmp_root}/ckpt-empty")
    S.run_until_done(S.start_ingest(S.read_envelope_stream(spark, inbox), *args))
    local = args[0].replace("file:", "")
    files = [f for _, _, fs in os.walk(local) for f in fs if f.endswith(".parquet")] if os.path.exists(local) else []
    assert files == []


def test_redelivery_is_removed_by_key(spark):
    from letramento.plans.silver import silver_students
    body = '{"nu_ano_avaliacao": 2025, "id_aluno": 7, "co_uf": 35, "tp_dependencia": 2, "vl_proficiencia_lp": 750}'
    df = spark.createDataFrame([(body,), (body,)], "t string").select(F.base64(F.encode("t", "UTF-8")).alias("data"))
    good, _ = S.split_rejects(S.decode_events(df))
    out = silver_students(S.to_student_event(good), "2026-07-09").collect()
    assert len(out) == 1 and out[0].id_aluno == 7 and out[0].in_alfabetizado is None


def test_raw_json_records(spark):
    df = spark.createDataFrame([(bytearray(b'{"id_aluno": 5, "co_uf": 35}'),), (bytearray(b"{bad"),)], "value binary")
    good, bad = S.split_rejects(S.decode_events(df, "value", base64=False), "value")
    assert [r.id_aluno for r in S.to_student_event(good).collect()] == [5] and bad.count() == 1
