"""ST10 in the stream: a record that is delivered again is passed on once.

State is a digest per record and an expiry, in the state store of the query; it survives
a restart with the same checkpoint and goes when the watermark on the arrival time has
passed the horizon. Only copies are removed: two records of one pupil that differ in a
data field both pass, and D1 keeps the later one of them, as in batch. A copy counts with
its first arrival, and a copy after the horizon passes again (silver then keeps one).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources import schemas

DATA_FIELDS = [n for n, _ in schemas.STUDENT_DATA_FIELDS]


def record_digest(fields: Sequence[str] = DATA_FIELDS) -> Column:
    """SHA-256 of a record's data fields; a null and an absent field are alike."""
    return F.sha2(F.to_json(F.struct(*fields)), 256)


def drop_redelivered(records: DataFrame, horizon: str, time_col: str = "_timestamp_ingestao", fields: Sequence[str] = DATA_FIELDS,
                     keep: Column | None = None) -> DataFrame:
    """A stream without records whose data fields arrived within ``horizon`` before; rows for which ``keep`` holds all pass."""
    key = record_digest(fields)
    if keep is not None:
        key = F.when(F.coalesce(keep, F.lit(False)), F.uuid()).otherwise(key)
    return records.withColumn("_copia", key).withWatermark(time_col, horizon).dropDuplicatesWithinWatermark(["_copia"]).drop("_copia")


def first_deliveries(records: DataFrame, time_col: str = "_timestamp_ingestao", fields: Sequence[str] = DATA_FIELDS) -> DataFrame:
    """The batch twin over all time: of records with the same data fields, the one that arrived first."""
    rest = [c for c in records.columns if c != time_col]
    one = records.groupBy(record_digest(fields).alias("_copia")).agg(F.min(F.struct(time_col, *rest)).alias("_s"))
    return one.select(*[F.col(f"_s.{c}").alias(c) for c in records.columns])
