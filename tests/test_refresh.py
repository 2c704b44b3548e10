"""ST11 / V6: silver pupils merged by folder equal a whole recompute; gold follows only changed years."""

import random

import pytest
from pyspark.sql import functions as F

from letramento.plans import silver as V
from letramento.plans.bronze import STUDENT_STREAM_TABLE
from letramento.plans import gold as G
from letramento.plans.gold import refresh_gold_students, run_gold, stale_years
from letramento.sources import schemas
from letramento.sources.io import read_layer
from letramento.sources.versions import current_version, remove_old_versions

DAY = "2026-07-09"
KNOWN = {"nu_ano_avaliacao": "ano", "id_aluno": "id", "co_uf": "11", "sg_uf": "' ro'", "tp_dependencia": "dep", "in_presenca_lp": "1",
         "vl_proficiencia_lp": "nota", "in_alfabetizado": "if(nota >= 743, 1, 0)", "_timestamp_ingestao": "cast(concat(dia, ' ', hora) as timestamp)",
         "_fonte": "'kinesis_streaming'", "data_ingestao": "dia"}


def records(spark, rows):
    """(year, pupil, network, score, day, hour) as ingested stream records."""
    df = spark.createDataFrame(rows, "ano int, id long, dep int, nota double, dia string, hora string")
    return df.select(*[F.expr(KNOWN[f.name]).cast(f.dataType).alias(f.name) if f.name in KNOWN else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schemas.STUDENT.fields])


def bronze(spark, df, root):
    df.withColumns({"registro_rejeitado": F.lit(None).cast("string"), "motivo": F.lit(None).cast("string"), "estado": F.lit("ok")}) \
        .write.mode("append").partitionBy("estado", "data_ingestao").parquet(f"{root}/{STUDENT_STREAM_TABLE}")


def content(df):
    return sorted(map(tuple, df.drop("_timestamp_silver", "_timestamp_gold").select(sorted(c for c in df.columns if not c.startswith("_timestamp_"))).collect()), key=str)


def arrivals(seed, n=400):
    rng = random.Random(seed)
    return [(rng.choice([2022, 2023, 2024]), rng.randrange(120), rng.choice([1, 2, 3, 9]), float(rng.choice([300, 500, 700, 800])),
             f"2026-12-0{rng.randrange(1, 5)}", f"0{rng.randrange(10)}:00:00") for _ in range(n)]


@pytest.mark.parametrize("seed", [1, 2])
def test_merging_in_any_order_equals_a_whole_recompute(spark, tmp_root, seed):
    rows = arrivals(seed)
    parts = [rows[:150], rows[100:300], rows[300:], rows[:50]]  # overlapping: some arrive again
    random.Random(seed).shuffle(parts)
    for p in parts:
        V.upsert_students(records(spark, p), f"{tmp_root}/merged", DAY)
    bronze(spark, records(spark, rows), f"{tmp_root}/bronze")
    V.run_silver_students(spark, f"{tmp_root}/bronze", f"{tmp_root}/whole", DAY)
    merged, whole = (read_layer(spark, f"{tmp_root}/{x}", "Ts_aluno") for x in ("merged", "whole"))
    assert content(merged) == content(whole) and merged.columns == whole.columns
    assert merged.groupBy("nu_ano_avaliacao", "id_aluno").count().where("count > 1").count() == 0


def test_a_refresh_reads_and_replaces_only_touched_folders(spark, tmp_root, monkeypatch):
    spark.conf.set(V.BUCKETS_SETTING, "64")
    path = f"{tmp_root}/silver/Ts_aluno"
    V.upsert_students(records(spark, [(y, i, 1, 500.0, "2026-12-01", "01:00:00") for y in (2023, 2024) for i in range(3000)]), f"{tmp_root}/silver", DAY)
    spark.conf.unset(V.BUCKETS_SETTING)  # a table keeps the number it was made with
    before = current_version(spark, path)
    assert len(before.folders) == 2 * 64
    read = []
    real = V.read_version

    def watched(*args, **kwargs):
        df = real(*args, **kwargs)
        read.append((df.count(), set(df.inputFiles())))
        return df

    monkeypatch.setattr(V, "read_version", watched)
    one = spark.range(3000).where(F.pmod(F.xxhash64("id"), F.lit(64)) == 7).collect()
    folders = V.upsert_students(records(spark, [(2024, r.id, 2, 800.0, "2026-12-02", "01:00:00") for r in one]), f"{tmp_root}/silver", DAY)
    after = current_version(spark, path)
    assert folders == 1 and after.changed_since(before) == {"nu_ano_avaliacao=2024/balde=7"}
    assert len(read) == 1 and read[0][0] == len(one) < 6000 * 0.02
    table = read_layer(spark, f"{tmp_root}/silver", "Ts_aluno")
    assert table.count() == 6000 and table.where("vl_proficiencia_lp = 800").count() == len(one)
    assert V.upsert_students(records(spark, [(2024, 1, 9, 500.0, "2026-12-03", "01:00:00")]), f"{tmp_root}/silver", DAY) == 0  # out of its domain


def test_gold_follows_changed_years_and_makes_up_for_a_stop(spark, tmp_root):
    silver, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    V.upsert_students(records(spark, [(y, i, 1, 500.0, "2026-12-01", "01:00:00") for y in (2022, 2023, 2024) for i in range(50)]), silver, DAY)
    assert stale_years(spark, silver, gold) == (None, 1)
    assert set(refresh_gold_students(spark, silver, gold)) == {"indicadores_alunos", "indicadores_alunos_municipio"}
    assert refresh_gold_students(spark, silver, gold) == []
    old = current_version(spark, f"{gold}/indicadores_alunos")
    V.upsert_students(records(spark, [(2023, 7, 1, 900.0, "2026-12-02", "01:00:00")]), silver, DAY)  # and gold is not refreshed
    V.upsert_students(records(spark, [(2024, 8, 1, 900.0, "2026-12-02", "02:00:00"), (2025, 1, 1, 500.0, "2026-12-02", "02:00:00")]), silver, DAY)
    assert stale_years(spark, silver, gold)[0] == [2023, 2024, 2025]
    refresh_gold_students(spark, silver, gold)
    new = current_version(spark, f"{gold}/indicadores_alunos")
    assert new.changed_since(old) == {f"nu_ano_avaliacao={y}" for y in (2023, 2024, 2025)}
    run_gold(spark, silver, f"{tmp_root}/whole", only={"indicadores_alunos", "indicadores_alunos_municipio"})
    for t in ("indicadores_alunos", "indicadores_alunos_municipio"):
        assert content(read_layer(spark, gold, t)) == content(read_layer(spark, f"{tmp_root}/whole", t))


def test_gold_of_one_year_prunes_pupils(spark, tmp_root):
    from letramento.plans.gold import build_gold
    V.upsert_students(records(spark, arrivals(3)), f"{tmp_root}/silver", DAY)
    df = build_gold(spark, f"{tmp_root}/silver", years=[2023])["indicadores_alunos"]
    assert "PartitionFilters: [isnotnull(nu_ano_avaliacao" in df._jdf.queryExecution().executedPlan().toString()
    assert {r.nu_ano_avaliacao for r in df.collect()} == {2023}


TABLES = ("indicadores_alunos", "indicadores_alunos_municipio")


def from_pupils(spark, silver):
    """G4 and G5 straight from the pupils, without states."""
    pupils = read_layer(spark, silver, "Ts_aluno")
    return content(G.indicadores_alunos(pupils)), content(G.indicadores_alunos_municipio(pupils))


def from_gold(spark, gold):
    return tuple(content(read_layer(spark, gold, t)) for t in TABLES)


def test_states_follow_late_and_replaced_days(spark, tmp_root):
    seed = 4
    rows, silver, gold = arrivals(seed), f"{tmp_root}/silver", f"{tmp_root}/gold"
    days = sorted({r[4] for r in rows})
    random.Random(seed).shuffle(days)  # late days come after later ones
    for d in days:
        V.upsert_students(records(spark, [r for r in rows if r[4] == d]), silver, DAY)
        refresh_gold_students(spark, silver, gold)
        assert from_gold(spark, gold) == from_pupils(spark, silver)
    # a greatest score taken back: later records of the pupils that have it
    V.upsert_students(records(spark, [(y, i, 1, 401.0, "2026-12-09", "01:00:00") for y in (2022, 2023) for i in range(120)]), silver, DAY)
    refresh_gold_students(spark, silver, gold)
    assert from_gold(spark, gold) == from_pupils(spark, silver)
    # silver made anew from fewer rows: folders and years that went away lose their states
    bronze(spark, records(spark, [r for r in rows if r[0] == 2024][:20]), f"{tmp_root}/bronze")
    V.run_silver_students(spark, f"{tmp_root}/bronze", silver, DAY)
    refresh_gold_students(spark, silver, gold)
    assert from_gold(spark, gold) == from_pupils(spark, silver)
    remove_old_versions(spark, f"{silver}/Ts_aluno", keep=1, hours=0)  # the commit that the states came from goes with the next one
    V.upsert_students(records(spark, rows[:60]), silver, DAY)
    remove_old_versions(spark, f"{silver}/Ts_aluno", keep=1, hours=0)
    refresh_gold_students(spark, silver, gold)
    assert from_gold(spark, gold) == from_pupils(spark, silver)


def test_states_read_only_changed_folders(spark, tmp_root, monkeypatch):
    spark.conf.set(V.BUCKETS_SETTING, "16")
    silver, gold = f"{tmp_root}/silver", f"{tmp_root}/gold"
    V.upsert_students(records(spark, [(y, i, 1, 500.0, "2026-12-01", "01:00:00") for y in (2023, 2024) for i in range(600)]), silver, DAY)
    spark.conf.unset(V.BUCKETS_SETTING)
    refresh_gold_students(spark, silver, gold)
    before = current_version(spark, f"{gold}/{G.STATES_TABLE}")
    V.upsert_students(records(spark, [(2024, 5, 1, 900.0, "2026-12-02", "01:00:00")]), silver, DAY)
    read, real = [], G.read_version

    def watched(spark, path, version, *args):
        read.append((path.rsplit("/", 1)[1], len(version.folders)))
        return real(spark, path, version, *args)

    monkeypatch.setattr(G, "read_version", watched)
    refresh_gold_students(spark, silver, gold)
    assert read == [("Ts_aluno", 1), (G.STATES_TABLE, 16)]
    assert len(current_version(spark, f"{gold}/{G.STATES_TABLE}").changed_since(before)) == 1
    assert from_gold(spark, gold) == from_pupils(spark, silver)
    assert G.refresh_states(spark, silver, gold).number == before.number + 1  # nothing new: no new commit


def test_states_merge_to_the_indicators_of_all_rows(spark):
    rows = [("a", 1, 1, 500.0), ("a", 1, None, None), ("a", 0, 1, 900.0), ("a", 1, 0, float("nan")), ("b", 1, None, None), ("b", 1, None, 1e300), (None, 1, 1, 0.5)]
    df = spark.createDataFrame(rows, "k string, p int, l int, s double").withColumn("unit", F.monotonically_increasing_id() % 3)
    args = dict(present="p", literate="l", score="s")
    from letramento.operators import aggregates as A
    parts = A.indicator_states(df, ["k", "unit"], **args)
    merged = A.indicators_of(A.merge_states(parts, ["k"]), ["k"])
    assert str(content(merged)) == str(content(A.student_indicators(df, ["k"], **args)))  # as text: NaN is not NaN
    got = {r.k: r for r in merged.collect()}
    assert got["a"].media_proficiencia == 500.0 and got["a"].total_alunos_avaliados == 3
    assert got["b"].media_proficiencia is None and got["b"].total_alfabetizados is None
    assert A.indicators_of(A.merge_states(parts.where("false"), ["k"]), ["k"]).count() == 0
