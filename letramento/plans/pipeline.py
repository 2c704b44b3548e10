"""End-to-end run: raw CSV -> bronze (+ stream) -> silver -> gold, in one scratch root.

The root lives under the shared checkpoint folder of the session; a run never
reuses a folder, so a retried run cannot see half-written output of another.
"""

from __future__ import annotations

import threading
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession

from ..session import scratch_path
from ..streaming.events import read_envelope_stream, run_until_done, start_ingest
from ..streaming.replay import replay_rejected
from .bronze import STUDENT_REPLAY_TABLE, STUDENT_STREAM_TABLE, run_bronze
from .concurrency import run_all
from .extracts import envelopes, raw_extracts
from .testbed import read_table
from .gold import refresh_gold_students, run_gold
from .silver import refresh_silver_students, run_silver

BATCH_DAY = "2026-07-09"
_RUNS: dict[tuple[str, str], str] = {}
_LOCK = threading.Lock()


#: Text layers are written compressed. A compressed file is read by one task, so a file holds a bounded number of records.
TEXT_CODEC, TEXT_RECORDS = "lz4", 25_000


def _text_writer(df: DataFrame, mode: str) -> DataFrameWriter:
    return df.write.mode(mode).option("compression", TEXT_CODEC).option("maxRecordsPerFile", TEXT_RECORDS)


def write_inbox(records: DataFrame, inbox: str) -> None:
    """Add wire records to the inbox of the stream, as JSON lines."""
    _text_writer(records, "append").json(inbox)


def write_raw(extracts: dict[str, DataFrame], raw_root: str) -> dict[str, str]:
    """Write the extracts as headed, compressed CSV (the raw layer), tables concurrently."""
    def write(table: str, df: DataFrame) -> str:
        path = f"{raw_root}/{table}"
        sep = ";" if table == "Ts_aluno" else ","
        _text_writer(df, "overwrite").option("header", True).option("sep", sep).csv(path)
        return path
    return run_all({t: (lambda t=t, df=df: write(t, df)) for t, df in extracts.items()})


def ingest_stream(spark: SparkSession, inbox: str, bronze_root: str, horizon: str | None = None, **options) -> None:
    """Everything that has arrived in the inbox, without what arrives again within ``horizon`` if given;
    ``options`` such as ``maxFilesPerTrigger`` bound a micro-batch."""
    stream = read_envelope_stream(spark, inbox, "json", **options)
    run_until_done(start_ingest(stream, f"{bronze_root}/{STUDENT_STREAM_TABLE}", horizon=horizon))


def run_pipeline(spark: SparkSession, sf: str, with_stream: bool = True) -> str:
    """Run every layer on extracts of ``sf``; returns the run root (memoised per session)."""
    key = (spark.sparkContext.applicationId, sf)
    with _LOCK:
        if key not in _RUNS:
            _RUNS[key] = _run(spark, sf, with_stream)
        return _RUNS[key]


def _run(spark: SparkSession, sf: str, with_stream: bool) -> str:
    root = scratch_path(spark, "pipeline")
    raw = write_raw(raw_extracts(spark, sf), f"{root}/raw")
    bronze = f"{root}/bronze"
    run_bronze(spark, raw, bronze)
    if with_stream:
        write_inbox(envelopes(read_table(spark, sf, "events")), f"{root}/inbox")
        ingest_stream(spark, f"{root}/inbox", bronze)
    run_silver(spark, bronze, f"{root}/silver", BATCH_DAY)
    run_gold(spark, f"{root}/silver", f"{root}/gold")
    return root


def refresh_students(spark: SparkSession, inbox: str, root: str, batch_day: str = BATCH_DAY, horizon: str | None = None,
                     **options) -> list[str]:
    """ST11: ingest what has arrived (``availableNow``), merge it into the silver folders it touches, and rebuild
    the changed years of the two pupil gold tables; returns the tables written. The indicator tables are left as they are."""
    bronze = f"{root}/bronze"
    ingest_stream(spark, inbox, bronze, horizon, **options)
    refresh_silver_students(spark, bronze, f"{root}/silver", batch_day)
    return refresh_gold_students(spark, f"{root}/silver", f"{root}/gold")


def replay_students(spark: SparkSession, root: str, mend: Callable[[Column], Column], batch_day: str = BATCH_DAY) -> tuple[int, int]:
    """ST6: decode the stream's quarantine again, mended by ``mend``, and bring silver and gold up to it; (added, still bad)."""
    bronze = f"{root}/bronze"
    counts = replay_rejected(spark, f"{bronze}/{STUDENT_STREAM_TABLE}", f"{bronze}/{STUDENT_REPLAY_TABLE}", mend)
    refresh_silver_students(spark, bronze, f"{root}/silver", batch_day)
    refresh_gold_students(spark, f"{root}/silver", f"{root}/gold")
    return counts
