"""ST10, ST8, ST6: redelivery dropped in the stream, running error rate with alarm, replay of the quarantine."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letramento.plans.bronze import STUDENT_STREAM_TABLE
from letramento.plans.pipeline import ingest_stream, refresh_students, replay_students
from letramento.sources.io import read_layer
from letramento.sources.versions import ConcurrentWrite, current_version
from letramento.streaming import events as S
from letramento.streaming import health, redelivery, replay


def deliver(spark, inbox, bodies):
    df = spark.createDataFrame([(b,) for b in bodies], "t string")
    whole = F.when(F.col("t").startswith("%"), F.col("t")).otherwise(F.base64(F.encode("t", "UTF-8")))
    df.select(whole.alias("data")).coalesce(1).write.mode("append").json(inbox)


def body(i, score=500, extra=""):
    return f'{{"nu_ano_avaliacao": 2025, "id_aluno": {i}, "co_uf": 35, "tp_dependencia": 2, "in_presenca_lp": 1, "vl_proficiencia_lp": {score}{extra}}}'


def test_copies_across_batches_and_a_restart_are_written_once(spark, tmp_root):
    inbox, bronze = f"{tmp_root}/inbox", f"{tmp_root}/bronze"
    deliver(spark, inbox, [body(i) for i in range(20)] + [body(3), "{bad", "{bad"])
    ingest_stream(spark, inbox, bronze, "7 days")
    deliver(spark, inbox, [body(i) for i in range(10, 30)] + [body(5, 900), body(5, extra=', "sg_uf": null'), "{bad"])
    deliver(spark, inbox, [body(i) for i in range(30)])
    ingest_stream(spark, inbox, bronze, "7 days", maxFilesPerTrigger=1)  # a restart, and two batches
    sink = f"{bronze}/{STUDENT_STREAM_TABLE}"
    got = sorted((r.id_aluno, r.vl_proficiencia_lp) for r in S.read_ingested(spark, sink).collect())
    assert got == sorted([(i, 500.0) for i in range(30)] + [(5, 900.0)])
    assert S.read_ingested(spark, sink, S.STATE_REJECTED).count() == 3  # rejected records are not merged


def test_state_is_bounded_by_the_horizon(spark, tmp_root):
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("t", T.TimestampType())])
    inbox = f"{tmp_root}/times"
    spark.createDataFrame([], schema).write.parquet(inbox)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(inbox)
    held = []
    for day in range(1, 13):
        rows = spark.createDataFrame([(i, f"2026-01-{day:02d}") for i in [*range(100 * day, 100 * day + 100), 7]], "id long, d string")
        rows.select("id", F.to_timestamp("d").alias("t")).coalesce(1).write.mode("append").parquet(inbox)
        query = redelivery.drop_redelivered(stream, "2 days", "t", ["id"]).writeStream.format("parquet") \
            .option("path", f"{tmp_root}/out").option("checkpointLocation", f"{tmp_root}/ckpt").trigger(availableNow=True).start()
        query.awaitTermination()
        held.append(max(p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators))
    assert max(held[6:]) <= 600 < 1200  # days within the horizon, not all days
    out = spark.read.parquet(f"{tmp_root}/out")
    assert out.where("id >= 100").count() == 1200 and 1 <= out.where("id = 7").count() < 12  # a copy after the horizon passes again


def test_stream_and_batch_dedup_end_in_the_same_silver(spark, tmp_root):
    from letramento.plans import silver as V
    parts = [[body(i, 400 + i) for i in range(40)], [body(i, 400 + i) for i in range(20, 60)] + [body(i, 700 + i) for i in range(10)],
             [body(i, 400 + i) for i in range(60)]]
    for p in parts:
        deliver(spark, f"{tmp_root}/inbox", p)
        refresh_students(spark, f"{tmp_root}/inbox", f"{tmp_root}/s", horizon="7 days")
        ingest_stream(spark, f"{tmp_root}/inbox", f"{tmp_root}/b/bronze")
    every = S.read_ingested(spark, f"{tmp_root}/b/bronze/{STUDENT_STREAM_TABLE}")
    want = V.silver_students(redelivery.first_deliveries(every), "2026-07-09")
    got = read_layer(spark, f"{tmp_root}/s/silver", "Ts_aluno")
    pick = ["id_aluno", "vl_proficiencia_lp"]
    assert sorted(map(tuple, got.select(pick).collect())) == sorted(map(tuple, want.select(pick).collect())) == \
        [(i, 700.0 + i if i < 10 else 400.0 + i) for i in range(60)]


def watch(spark, inbox, root, **options):
    decoded = health.stamped(S.decode_events(S.read_envelope_stream(spark, inbox, maxFilesPerTrigger=1, latestFirst=False)))
    return health.start_monitor(decoded, S.is_malformed(), root, f"{root}/ckpt", **options)


def test_a_batch_above_the_threshold_raises_within_it(spark, tmp_root):
    inbox = f"{tmp_root}/inbox"
    deliver(spark, inbox, [body(i) for i in range(99)] + ["{bad"])
    watch(spark, inbox, tmp_root).awaitTermination()
    deliver(spark, inbox, [body(i) for i in range(80)] + ["{bad"] * 20)
    query = watch(spark, inbox, tmp_root)
    with pytest.raises(Exception, match="21 of 200 records"):
        query.awaitTermination()
    row = health.running_rates(spark, tmp_root).first()
    assert (row.registros, row.rejeitados, row.acima_limite) == (100, 1, False)  # the batch was not committed
    watch(spark, inbox, tmp_root, stop=False).awaitTermination()  # the same batch again, flagged
    row = health.running_rates(spark, tmp_root).first()
    assert (row.registros, row.rejeitados, row.taxa_erro, row.acima_limite) == (200, 21, 0.105, True)
    deliver(spark, inbox, [body(i) for i in range(300)])
    last = watch(spark, inbox, tmp_root)
    last.awaitTermination()
    row = health.running_rates(spark, tmp_root).first()
    assert (row.registros, row.rejeitados, row.acima_limite) == (500, 21, False)
    seen = [p.observedMetrics[health.OBSERVED] for p in last.recentProgress if health.OBSERVED in p.observedMetrics]
    assert (seen[0].registros, seen[0].rejeitados) == (300, 0)  # the batch's own figures, beside the running ones


def test_few_records_raise_no_alarm(spark, tmp_root):
    deliver(spark, f"{tmp_root}/inbox", ["{bad", body(1)])
    watch(spark, f"{tmp_root}/inbox", tmp_root, least=10).awaitTermination()
    assert health.running_rates(spark, tmp_root).first().acima_limite is False


def mend(raw):
    return F.regexp_replace(raw, "^%+", "")


def test_replay_adds_each_mended_record_once(spark, tmp_root):
    import base64
    inbox, bronze = f"{tmp_root}/inbox", f"{tmp_root}/bronze"
    broken = ["%%" + base64.b64encode(body(i, 800).encode()).decode() for i in (1, 2, 2, 3)]
    deliver(spark, inbox, [body(i) for i in range(2, 6)] + broken + ["{bad", "%%@@"])
    refresh_students(spark, inbox, tmp_root)
    silver = lambda: {r.id_aluno: r.vl_proficiencia_lp for r in read_layer(spark, f"{tmp_root}/silver", "Ts_aluno").collect()}
    assert silver() == {i: 500.0 for i in range(2, 6)}
    assert replay_students(spark, tmp_root, lambda raw: raw) == (0, 5)  # nothing mended: three records, and two hopeless ones
    assert replay_students(spark, tmp_root, mend) == (3, 2)
    after = silver()
    assert set(after) == {1, 2, 3, 4, 5} and after[1] == 800.0
    assert replay_students(spark, tmp_root, mend) == (0, 2) and silver() == after
    table = f"{bronze}/Ts_aluno_replay"
    log = replay.read_optional(spark, table, "")
    assert log.count() == 3 == log.select("registro_origem").distinct().count() and log.select("lote_replay").distinct().count() == 1
    pending = {r.motivo for r in replay.read_optional(spark, table + replay.PENDING, "").collect()}
    assert pending == {"json_invalido", "base64_invalido"}
    deliver(spark, inbox, ["%" + base64.b64encode(body(9, 700).encode()).decode(), broken[0]])
    refresh_students(spark, inbox, tmp_root)
    assert replay_students(spark, tmp_root, mend) == (1, 2) and silver()[9] == 700.0
    whole = {r.id_aluno for r in read_layer(spark, f"{tmp_root}/silver", "Ts_aluno").collect()}
    from letramento.plans.silver import run_silver_students
    run_silver_students(spark, bronze, f"{tmp_root}/again", "2026-07-09")
    assert {r.id_aluno for r in read_layer(spark, f"{tmp_root}/again", "Ts_aluno").collect()} == whole


def test_two_replays_at_once_do_not_both_commit(spark, tmp_root, monkeypatch):
    inbox, bronze = f"{tmp_root}/inbox", f"{tmp_root}/bronze"
    deliver(spark, inbox, ["%%" + "e30="])
    ingest_stream(spark, inbox, bronze)
    args = (spark, f"{bronze}/{STUDENT_STREAM_TABLE}", f"{bronze}/replay")
    real, other = replay.publish, []

    def late(*a, **k):
        if not other:
            other.append(1)
            replay.replay_rejected(*args, mend)
        return real(*a, **k)

    monkeypatch.setattr(replay, "publish", late)
    with pytest.raises(ConcurrentWrite):
        replay.replay_rejected(*args, mend)
    assert replay.read_optional(spark, f"{bronze}/replay", "").count() == 1 and current_version(spark, f"{bronze}/replay").number == 1
