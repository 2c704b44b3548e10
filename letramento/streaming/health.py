"""ST8 while the stream runs: the error rate per day as state of the query, with an alarm.

The counts of a day live in the state store (one row per day, gone when the watermark has
passed it), so nothing that was written is read again. Every micro-batch updates the
figures of the days it touches, appends them to a small history table, and raises inside
the micro-batch if a rate is above the threshold: that batch is then not committed, and
the query fails and stays failed until the threshold is raised or the alarm only flags.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.clean import stamp_day
from ..sources.io import read_layer, write_layer

HISTORY = "_saude"
OBSERVED = "saude_lote"


class ErrorRateExceeded(RuntimeError):
    """The share of rejected records of a day is above the threshold."""


def running_counts(records: DataFrame, bad: Column, horizon: str = "2 days", time_col: str = "_timestamp_ingestao",
                   day_col: str = "data_ingestao") -> DataFrame:
    """Records and rejected records per day, as a stream's running aggregate; each batch's own counts are observed beside it."""
    seen = records.observe(OBSERVED, F.count(F.lit(1)).alias("registros"), F.count_if(bad).alias("rejeitados"))
    return seen.withWatermark(time_col, horizon).groupBy(F.window(time_col, "1 day"), F.col(day_col)) \
        .agg(F.count(F.lit(1)).alias("registros"), F.count_if(bad).alias("rejeitados")).drop("window")


def flagged(counts: DataFrame, threshold: float, least: int) -> DataFrame:
    """The rate, and whether it is above ``threshold`` (never for a day of under ``least`` records)."""
    rate = F.try_divide(F.col("rejeitados").cast("double"), F.col("registros"))
    return counts.withColumn("taxa_erro", rate).withColumn("acima_limite", (rate > threshold) & (F.col("registros") >= least))


def start_monitor(records: DataFrame, bad: Column, root: str, checkpoint: str, threshold: float = 0.05, least: int = 1, stop: bool = True,
                  horizon: str = "2 days", available_now: bool = True) -> StreamingQuery:
    """Watch a stream of stamped records; the history goes to ``<root>/_saude``, one row per batch and day it touched."""

    def check(batch: DataFrame, number: int) -> None:
        rows = flagged(batch, threshold, least).withColumn("lote", F.lit(number).cast("long"))
        days = rows.collect()  # one row per day that the batch touched
        if not days:
            return
        over = [r for r in days if r.acima_limite]
        if over and stop:
            raise ErrorRateExceeded(", ".join(f"{r.data_ingestao}: {r.rejeitados} of {r.registros} records" for r in over))
        spark = batch.sparkSession
        write_layer(spark.createDataFrame(days, rows.schema).coalesce(1), root, HISTORY, ["lote"], rebalance=False, replace=[number])

    writer = running_counts(records, bad, horizon).writeStream.outputMode("update").foreachBatch(check) \
        .option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def stamped(decoded: DataFrame) -> DataFrame:
    """Decoded records with the time and day of their arrival."""
    return stamp_day(decoded.withColumn("_timestamp_ingestao", F.current_timestamp()))


def running_rates(spark: SparkSession, root: str) -> DataFrame:
    """The latest figure of every day."""
    latest = read_layer(spark, root, HISTORY).groupBy("data_ingestao").agg(
        F.max_by(F.struct("registros", "rejeitados", "taxa_erro", "acima_limite"), "lote").alias("s"))
    return latest.select("data_ingestao", "s.*")


