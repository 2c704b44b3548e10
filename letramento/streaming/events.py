"""Pupil event stream: ST1-ST11 and the bronze sink K2.

Records arrive as an envelope with one field ``data``: base64 of a UTF-8 JSON object.
The same functions run on a batch DataFrame and on a streaming one; the sink is
Spark's file sink, whose commit log makes every micro-batch exactly-once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType

from ..functions.numeric import safe_double, safe_int, safe_string
from ..operators.clean import stamp_day, stamp_lineage
from ..session import compiled_methods
from ..sources import schemas
from ..sources.io import folder_exists
from ..sources.versions import CODEC
from .redelivery import drop_redelivered

STREAM_SOURCE = "kinesis_streaming"
STREAM_FILE = "stream_kinesis"


def envelope_data(fields: dict[str, Column]) -> Column:
    """Producer side of the wire format: base64(UTF-8(JSON(fields)))."""
    body = F.to_json(F.struct(*[c.alias(n) for n, c in fields.items()]))
    return F.base64(F.encode(body, "UTF-8"))


def decode_events(df: DataFrame, col: str = "data", base64: bool = True) -> DataFrame:
    """ST1: base64 -> UTF-8 -> JSON object with every field as text.

    Adds ``_payload`` (the decoded text, null when the base64 is invalid) and ``_e``
    (the parsed struct, with ``_corrupt`` holding text that is not a JSON object).
    The payload is a projection of its own and the struct comes out of a one-row
    ``inline`` generator over it: filters on the struct cannot be pushed below, so each
    record is decoded and parsed once, not once per use.
    ``base64=False`` takes the column as the JSON itself (text, or UTF-8 bytes such
    as a Kafka ``value``).
    """
    raw = F.col(col)
    if base64:
        text = F.decode(F.try_to_binary(raw, F.lit("base64")), "UTF-8")
    else:
        text = raw.cast("string")
    parsed = F.from_json(F.col("_payload"), schemas.EVENT_TEXT,
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"})
    return df.withColumn("_payload", text).select("*", F.inline(F.array(F.struct(parsed.alias("_e")))))


def is_malformed(decoded: DataFrame | None = None) -> Column:
    """ST6: undecodable base64 (its struct is null too), text that is not a JSON object, or a JSON null."""
    return F.col("_e").isNull() | F.col("_e._corrupt").isNotNull()


def typed_exprs() -> dict[str, Column]:
    """ST2-ST5: every contract field from its text with the safe conversions."""
    out = {}
    for name, type_ in schemas.STUDENT_DATA_FIELDS:
        raw = F.col(f"_e.{name}")
        if isinstance(type_, IntegerType):
            value = safe_int(raw).try_cast("int")
        elif isinstance(type_, LongType):
            value = safe_int(raw)
        elif isinstance(type_, DoubleType):
            value = safe_double(raw)
        else:
            assert isinstance(type_, StringType)
            value = safe_string(raw)
        out[name] = value
    return out


def typed_fields() -> list[Column]:
    return [e.alias(n) for n, e in typed_exprs().items()]


def to_student_event(decoded: DataFrame, source: str = STREAM_SOURCE, file: str = STREAM_FILE,
                     keep: Sequence[str] = ()) -> DataFrame:
    """ST5: the typed 27-field record plus lineage (M1) and ingestion day (M2)."""
    typed = decoded.select(*keep, *typed_fields())
    return stamp_day(stamp_lineage(typed, source, file))


def _reason() -> Column:
    return F.when(F.col("_payload").isNull(), F.lit("base64_invalido")).otherwise(F.lit("json_invalido"))


def split_rejects(decoded: DataFrame, col: str = "data") -> tuple[DataFrame, DataFrame]:
    """ST6: (good records, quarantined records with the raw record as text and a reason)."""
    bad = is_malformed()
    good = decoded.where(~bad)
    rejects = decoded.where(bad).select(
        F.col(col).cast("string").alias("data"), _reason().alias("motivo"),
        F.current_timestamp().alias("_timestamp_ingestao"),
        F.date_format(F.current_date(), "yyyy-MM-dd").alias("data_ingestao"))
    return good, rejects


STATE_OK, STATE_REJECTED = "ok", "rejeitado"


def ingest_records(envelopes: DataFrame, col: str = "data", base64: bool = True) -> DataFrame:
    """ST1-ST6 in one pass: every record once, decoded and parsed once.

    A well-formed record carries its typed fields (``estado = 'ok'``); a malformed one
    carries the raw record and the reason (``estado = 'rejeitado'``). Lineage and the
    ingestion day are stamped on both.
    """
    decoded = decode_events(envelopes, col, base64)
    bad = is_malformed()
    out = decoded.select(*[F.when(~bad, e).alias(n) for n, e in typed_exprs().items()],
                         F.when(bad, F.col(col).cast("string")).alias("registro_rejeitado"),
                         F.when(bad, _reason()).alias("motivo"),
                         F.when(bad, F.lit(STATE_REJECTED)).otherwise(F.lit(STATE_OK)).alias("estado"))
    return stamp_day(stamp_lineage(out, STREAM_SOURCE, STREAM_FILE))


def error_rates(records: DataFrame, bad: Column, threshold: float = 0.05, day_col: str = "data_ingestao") -> DataFrame:
    """ST8 in one aggregate: records, those that are ``bad`` and their share per day, flagged above ``threshold``."""
    out = records.groupBy(day_col).agg(F.count(F.lit(1)).alias("registros"), F.count_if(bad).alias("rejeitados"))
    rate = F.try_divide(F.col("rejeitados").cast("double"), F.col("registros"))
    return out.withColumn("taxa_erro", rate).withColumn("acima_limite", rate > F.lit(threshold))


def decoded_metrics(decoded: DataFrame, threshold: float = 0.05) -> DataFrame:
    """ST8 over decoded records: one pass, no split."""
    return error_rates(stamp_day(decoded), is_malformed(), threshold)


def ingest_metrics(good: DataFrame, rejects: DataFrame, threshold: float = 0.05,
                   day_col: str = "data_ingestao") -> DataFrame:
    """ST8 over good and rejected records that are kept apart."""
    both = (good.select(day_col, F.lit(False).alias("_bad"))
            .unionByName(rejects.select(day_col, F.lit(True).alias("_bad"))))
    return error_rates(both, F.col("_bad"), threshold, day_col)


def read_envelope_stream(spark: SparkSession, path: str, fmt: str = "json", **options) -> DataFrame:
    """Envelope records as a stream (a Kafka source would only swap the reader)."""
    reader = spark.readStream.schema(schemas.ENVELOPE).format(fmt)
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load(path)


def sink_checkpoint(path: str) -> str:
    """The one checkpoint of a sink, beside it: every job that writes the sink goes on from there."""
    parent, _, name = path.rstrip("/").rpartition("/")
    return f"{parent}/_checkpoints/{name}"


def start_ingest(envelopes: DataFrame, path: str, checkpoint: str | None = None, available_now: bool = True,
                 processing_time: str | None = None, horizon: str | None = None) -> StreamingQuery:
    """K2 / ST7 / ST9: every record into one file sink, partitioned by (estado, day).

    One query reads and parses each record once. The file sink's commit log makes a
    replayed micro-batch invisible until committed and never committed twice; an
    empty micro-batch writes no file. Readers select ``estado`` (``read_ingested``).

    A sink skips batch numbers that its log has, so a second checkpoint on the same sink
    would lose records: the checkpoint belongs to the sink (``sink_checkpoint``), and a
    sink with a log refuses a checkpoint that does not exist yet.

    With ``horizon`` (ST10), well-formed records that arrived before within that time are
    not written again; a checkpoint is made for one of the two forms and keeps to it.
    """
    spark = envelopes.sparkSession
    checkpoint = checkpoint or sink_checkpoint(path)
    if folder_exists(spark, f"{path.rstrip('/')}/_spark_metadata") and not folder_exists(spark, f"{checkpoint}/offsets"):
        raise ValueError(f"{path} was written from another checkpoint than {checkpoint}; its records would be lost")
    records = ingest_records(envelopes)
    if horizon:
        records = drop_redelivered(records, horizon, keep=F.col("estado") == STATE_REJECTED)
    writer = (records.writeStream.format("parquet").option("path", path).option("compression", CODEC)
              .option("checkpointLocation", checkpoint).partitionBy("estado", "data_ingestao").outputMode("append"))
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    with compiled_methods(spark):  # the stream keeps the session's settings of this moment
        return writer.start()


def run_until_done(queries: StreamingQuery | Sequence[StreamingQuery]) -> None:
    """Wait for ``availableNow`` queries; re-raise the first failure."""
    for q in [queries] if isinstance(queries, StreamingQuery) else queries:
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"stream {q.name or q.id} failed: {q.exception()}")


def read_ingested(spark: SparkSession, path: str, estado: str = STATE_OK) -> DataFrame:
    """The committed records of the stream sink: typed pupils (``ok``) or the quarantine."""
    df = spark.read.schema(schemas.INGESTED).parquet(path).where(F.col("estado") == estado)
    if estado == STATE_OK:
        return df.select(*schemas.STUDENT.fieldNames())
    return df.select("registro_rejeitado", "motivo", "_timestamp_ingestao", "data_ingestao")


def health_report(spark: SparkSession, path: str, threshold: float = 0.05) -> DataFrame:
    """ST8 over the sink: records, rejects and error rate per ingestion day (one aggregate)."""
    df = spark.read.schema(schemas.INGESTED).parquet(path)
    return error_rates(df, F.col("estado") == STATE_REJECTED, threshold)
