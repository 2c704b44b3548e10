"""Domain-shaped relations derived from the shared test tables.

The shared tables hold no literacy data, so two relations play its role:

* ``kpi(ano, uf, regiao, rede, n, n_ok, taxa, meta)`` — orders of a year, nation,
  region and market segment; ``taxa`` is the share of finished orders in %, the
  target ``meta`` is 60. It plays the indicator tables (rate vs target per entity).
* ``pupil(id_aluno, ano, co_uf, co_municipio, no_municipio, rede, presente, score, flag)``
  — one row per event; plays the pupil microdata (score, present flag, literate flag).

Both grow with the inputs: they are plain joins and aggregates over whole tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.measures import literate_flag
from ..functions.numeric import percent
from ..session import table_path

# The target used for every kpi row and the pupil score cut-off.
KPI_TARGET = 60.0
PUPIL_CUTOFF = 50.0
PUPIL_STATES = 25


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def kpi_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order rows with their year, nation, region and segment (one row per order)."""
    o = read_table(spark, sf_dir, "orders").select(
        "o_custkey", F.year("o_orderdate").cast("int").alias("ano"),
        (F.col("o_orderstatus") == "F").alias("_ok"), "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation / region are tiny fixed tables: the planner broadcasts them by size.
    return (o.join(c, o.o_custkey == c.c_custkey)
            .join(n, F.col("c_nationkey") == F.col("n_nationkey"))
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"))
            .select("ano", F.col("n_name").alias("uf"), F.col("r_name").alias("regiao"),
                    F.col("c_mktsegment").alias("rede"), "_ok", "o_orderpriority"))


def kpi(spark: SparkSession, sf_dir: str, grain: tuple[str, ...] = ("ano", "uf", "regiao", "rede")) -> DataFrame:
    out = kpi_rows(spark, sf_dir).groupBy(*grain).agg(F.count(F.lit(1)).alias("n"),
                                                      F.count_if("_ok").alias("n_ok"))
    return out.withColumn("taxa", percent("n_ok", "n", 2)).withColumn("meta", F.lit(KPI_TARGET))


def pupil(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.col("event_id").alias("id_aluno"), F.year("ts").cast("int").alias("ano"),
        (F.col("user_id") % PUPIL_STATES).cast("int").alias("co_uf"),
        F.col("user_id").alias("co_municipio"),
        F.concat(F.lit("M"), F.col("user_id").cast("string")).alias("no_municipio"),
        F.col("event_type").alias("rede"),
        F.when(F.col("event_type") != "error", F.lit(1)).otherwise(F.lit(0)).alias("presente"),
        F.col("value").alias("score"),
        literate_flag("value", PUPIL_CUTOFF).alias("flag"))
