"""Q8: the discard audit counts stored rows, so tasks that fail and run again do not change it."""

import os
import subprocess
import sys

from pyspark.sql import functions as F

from letramento.plans.silver import DISCARDS, RULES, audit_rows_of, silver_meta_uf, write_discards
from letramento.sources.io import read_layer, write_layer

HERE = os.path.dirname(os.path.abspath(__file__))
SCHEMA = "ano string, sigla_uf string, rede string, taxa_alfabetizacao string"
#: 400 rows: every fifth without a state, every seventh of the others out of range, the rest two by two of one key.
ROWS = [("2024", None if i % 5 == 0 else f"u{i // 2}", "publica", "150" if i % 7 == 0 else "50") for i in range(400)]
NO_KEY = sum(i % 5 == 0 for i in range(400))
OUT = sum(i % 5 != 0 and i % 7 == 0 for i in range(400))
KEPT = len({i // 2 for i in range(400) if i % 5 and i % 7})

RETRIED = """
import sys
sys.path[:0] = [{repo!r}, {here!r}]
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "3").getOrCreate())
spark.sparkContext.setLogLevel("OFF")
spark.sparkContext.setCheckpointDir({root!r} + "/ckpt")
from test_audit import ROWS, SCHEMA
from letramento.plans.silver import RULES, audit_rows_of, silver_meta_uf
from letramento.sources.io import read_layer, write_layer

@F.udf("string")
def flaky(v):  # the first try of each task of two breaks off after it has seen rows
    flaky.seen = getattr(flaky, "seen", 0) + 1
    if flaky.seen > 20 and TaskContext.get().attemptNumber() == 0 and TaskContext.get().partitionId() % 2:
        open({root!r} + f"/lost-{{TaskContext.get().taskAttemptId()}}", "w").close()
        raise RuntimeError("lost")
    return v

source = spark.createDataFrame(ROWS, SCHEMA).repartition(6).withColumn("taxa_alfabetizacao", flaky("taxa_alfabetizacao"))
write_layer(silver_meta_uf(source), {root!r}, "Meta_uf", ["ano"])
n = read_layer(spark, {root!r}, "Meta_uf").count()
print("AUDIT", sorted(audit_rows_of(source, silver_meta_uf(source, rejected=True), {root!r}, "Meta_uf", RULES, n)))
"""


def _expected():
    return sorted([("Meta_uf", "lidos", 400), ("Meta_uf", "chave_nula", NO_KEY), ("Meta_uf", "fora_do_intervalo", OUT),
                   ("Meta_uf", "duplicata", 400 - NO_KEY - OUT - KEPT), ("Meta_uf", "gravados", KEPT)])


def test_audit_and_discarded_rows(spark, tmp_root):
    source = spark.createDataFrame(ROWS, SCHEMA).repartition(6)
    for _ in range(2):  # a second run replaces the first
        write_layer(silver_meta_uf(source), tmp_root, "Meta_uf", ["ano"])
        written = read_layer(spark, tmp_root, "Meta_uf").count()
        assert sorted(audit_rows_of(source, silver_meta_uf(source, rejected=True), tmp_root, "Meta_uf", RULES, written)) == _expected()
    stored = read_layer(spark, f"{tmp_root}/{DISCARDS}", "Meta_uf")
    assert stored.where("motivo = 'chave_nula' and sigla_uf is not null").count() == 0
    assert stored.where("motivo = 'fora_do_intervalo'").agg(F.min("taxa_alfabetizacao")).first()[0] == 150.0


def test_nothing_discarded(spark, tmp_root):
    source = spark.createDataFrame([("2024", "SP", "publica", "50")], SCHEMA)
    assert write_discards(silver_meta_uf(source, rejected=True), tmp_root, "Meta_uf", RULES) == dict.fromkeys(RULES, 0)


def test_audit_is_exact_when_tasks_are_tried_again(tmp_path):
    code = RETRIED.format(repo=os.path.dirname(HERE), here=HERE, root=str(tmp_path))
    run = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=240, check=False)
    told = [line for line in run.stdout.splitlines() if line.startswith("AUDIT")]
    assert told == [f"AUDIT {_expected()}"], run.stderr[-2000:]
    assert [f for f in os.listdir(tmp_path) if f.startswith("lost-")]  # tasks did fail
