"""What the layers write: text is compressed in bounded files, one day of pupils is not shuffled."""

import os

from pyspark.sql import functions as F

from letramento.plans import bronze, pipeline
from letramento.sources import schemas
from letramento.sources.io import read_layer, read_raw_csv
from letramento.session import compiled_methods


def _files(path):
    return [f"{d}/{f}" for d, _, names in os.walk(path) for f in names if f.startswith("part-")]


def test_inbox_is_compressed_in_bounded_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(pipeline, "TEXT_RECORDS", 100)
    records = spark.range(0, 450, 1, 1).select(F.concat(F.lit("the same record "), "id").alias("data"))
    for _ in range(2):
        pipeline.write_inbox(records, f"{tmp_path}/inbox")
    files = _files(f"{tmp_path}/inbox")
    assert len(files) == 10 and all(f.endswith(".json.lz4") for f in files)
    back = spark.read.schema(schemas.ENVELOPE).json(f"{tmp_path}/inbox")
    assert back.count() == 900 and back.distinct().count() == 450


def test_raw_extracts_are_compressed_and_keep_odd_texts(spark, tmp_path):
    rows = spark.createDataFrame([("1999", " a,b", None), ("1999", 'x"y', ""), (None, "é;\nz", "3")], "ano string, sigla_uf string, rede string").coalesce(1)
    out = pipeline.write_raw({"Meta_uf": rows}, f"{tmp_path}/raw")
    plain = f"{tmp_path}/plain"
    rows.write.option("header", True).csv(plain)
    assert all(f.endswith(".csv.lz4") for f in _files(out["Meta_uf"]))
    want, got = (sorted(map(str, read_raw_csv(spark, p, rows.schema, required=()).collect())) for p in (plain, out["Meta_uf"]))
    assert got == want


def test_pupils_of_one_day_are_written_without_a_shuffle(spark, tmp_path, monkeypatch):
    ids = spark.range(0, 60, 1, 3).select(*[(F.col("id").cast("string") if n == "id_aluno" else F.lit("2")).alias(n) for n, _ in schemas.STUDENT_DATA_FIELDS])
    path = pipeline.write_raw({"Ts_aluno": ids}, f"{tmp_path}/raw")["Ts_aluno"]
    plans, write = [], bronze.write_layer

    def noted(df, *args, **kwargs):
        plans.append(kwargs.get("rebalance", True))
        return write(df, *args, **kwargs)

    monkeypatch.setattr(bronze, "write_layer", noted)
    assert bronze.ingest_students(spark, path, f"{tmp_path}/bronze") == 60
    assert plans == [False]
    back = read_layer(spark, f"{tmp_path}/bronze", bronze.STUDENT_BATCH_TABLE)
    assert back.count() == 60 and back.select("id_aluno").distinct().count() == 60 and back.select("data_ingestao").distinct().count() == 1


def test_compiled_methods_gives_the_setting_back(spark):
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    with compiled_methods(spark):
        assert spark.conf.get(name) == "8000"
    assert spark.conf.get(name) == before
