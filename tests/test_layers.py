"""Layer writes, header-bound CSV, integer text, single rounding and one checkpoint per stream sink."""

import pytest
from pyspark.sql import functions as F

from letramento.functions.numeric import percent, round_half_up
from letramento.operators.clean import cast_columns
from letramento.plans.gold import run_gold
from letramento.sources import schemas
from letramento.sources.io import read_layer, read_raw_csv, write_layer
from letramento.streaming import events as S

SF = "/root/testdata/sf0.001"


def _csv(spark, path, header, *rows):
    spark.createDataFrame([(",".join(x),) for x in (header, *rows)], "value string").coalesce(1).write.text(path)


def test_overwrite_replaces_the_whole_table(spark, tmp_root):
    rows = spark.createDataFrame([(2023, "a"), (2024, "b")], "ano int, x string")
    path = write_layer(rows, tmp_root, "t", ["ano"])
    write_layer(rows.where("ano = 2023"), tmp_root, "t", ["ano"])
    assert [tuple(r) for r in read_layer(spark, tmp_root, "t").select("ano", "x").collect()] == [(2023, "a")]


def test_replace_touches_listed_partitions_only(spark, tmp_root):
    rows = spark.createDataFrame([(2022, "a"), (2023, "b"), (2024, "c")], "ano int, x string")
    path = write_layer(rows, tmp_root, "t", ["ano"])
    write_layer(spark.createDataFrame([(2023, "new")], rows.schema), tmp_root, "t", ["ano"], replace=[2023, 2024])
    got = sorted(tuple(r) for r in read_layer(spark, tmp_root, "t").select("ano", "x").collect())
    assert got == [(2022, "a"), (2023, "new")]  # 2024 was asked for and has no rows any more


def test_redelivered_pupil_is_kept_once(spark, tmp_root):
    from letramento.plans.silver import run_silver_students
    fields = {f.name: F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.STUDENT.fields}

    def bronze(day, score):
        known = {"nu_ano_avaliacao": 2023, "id_aluno": 1, "co_uf": 11, "sg_uf": "RO", "tp_dependencia": 3, "in_presenca_lp": 1,
                 "vl_proficiencia_lp": score, "data_ingestao": day, "_fonte": "kinesis_streaming"}
        row = spark.range(1).select(*[F.lit(known[n]).cast(schemas.STUDENT[n].dataType).alias(n) if n in known else c
                                      for n, c in fields.items()])
        row = row.withColumn("_timestamp_ingestao", F.lit(f"{day} 08:00:00").cast("timestamp"))
        return row.withColumns({"registro_rejeitado": F.lit(None).cast("string"), "motivo": F.lit(None).cast("string"), "estado": F.lit("ok")})

    for day, score in (("2026-12-01", 700.0), ("2026-12-02", 800.0)):
        bronze(day, score).write.mode("append").partitionBy("estado", "data_ingestao").parquet(f"{tmp_root}/bronze/Ts_aluno_stream")
        run_silver_students(spark, f"{tmp_root}/bronze", f"{tmp_root}/silver", "2026-07-09")
    silver = read_layer(spark, f"{tmp_root}/silver", "Ts_aluno")
    assert [r.vl_proficiencia_lp for r in silver.collect()] == [800.0]
    run_gold(spark, f"{tmp_root}/silver", f"{tmp_root}/gold", only={"indicadores_alunos"})
    assert read_layer(spark, f"{tmp_root}/gold", "indicadores_alunos").first().total_alunos_avaliados == 1


def test_csv_columns_are_bound_by_name(spark, tmp_root):
    _csv(spark, f"{tmp_root}/csv", ["rede", "extra", "ano", "taxa_alfabetizacao", "percentual_participacao"], ["MUNICIPAL", "x", "2023", "61.5", "90"])
    row = read_raw_csv(spark, f"{tmp_root}/csv", schemas.META_BRASIL_RAW).first()
    assert (row.ano, row.rede, row.taxa_alfabetizacao, row.percentual_participacao) == ("2023", "MUNICIPAL", "61.5", "90")
    assert row.meta_alfabetizacao_2024 is None and row.extra == "x"


def test_csv_without_a_key_column_is_refused(spark, tmp_root):
    _csv(spark, f"{tmp_root}/csv", ["rede", "taxa_alfabetizacao"], ["MUNICIPAL", "61.5"])
    with pytest.raises(ValueError, match="ano"):
        read_raw_csv(spark, f"{tmp_root}/csv", schemas.META_BRASIL_RAW)


def test_whole_numbers_in_float_form(spark):
    df = spark.createDataFrame([("2023.0", "1100015.0", "3.0"), ("x", None, "3.7")], "ano string, id_municipio string, n string")
    got = cast_columns(df, {"ano": "int", "id_municipio": "int", "n": "int", "absent": "int"}).collect()
    assert [tuple(r) for r in got] == [(2023, 1100015, 3), (None, None, 3)]


def test_values_are_rounded_once(spark):
    df = spark.createDataFrame([(6668, 20003)], "a long, b long")
    assert df.select(percent("a", "b")).first()[0] == 33.33
    assert spark.range(1).select(round_half_up(F.lit(33.33499975), 2)).first()[0] == 33.33


def test_a_sink_keeps_to_its_checkpoint(spark, tmp_root):
    from letramento.plans.extracts import envelopes
    from letramento.plans.pipeline import ingest_stream
    from letramento.plans.bronze import STUDENT_STREAM_TABLE
    from letramento.plans.testbed import read_table
    events, inbox, bronze = read_table(spark, SF, "events"), f"{tmp_root}/inbox", f"{tmp_root}/bronze"
    sink, total = f"{bronze}/{STUDENT_STREAM_TABLE}", 0
    for kind in ("view", "click"):
        part = events.where(F.col("event_type") == kind)
        envelopes(part).write.mode("append").json(inbox)
        ingest_stream(spark, inbox, bronze, maxFilesPerTrigger=1)
        total += part.count()
        assert spark.read.schema(schemas.INGESTED).parquet(sink).count() == total
    with pytest.raises(ValueError, match="another checkpoint"):
        S.start_ingest(S.read_envelope_stream(spark, inbox), sink, f"{tmp_root}/other")
