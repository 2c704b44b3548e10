"""ST6, the way back: rejected records that can be mended are decoded again, each once.

The table of replayed records is its own log: a record's digest and the batch that
replayed it are committed in the same version as its typed fields. A replay asks only for
quarantined records whose digest the table does not hold, so running it twice, or again
after it stopped, adds nothing twice. What is still bad goes, with the reason of the last
attempt, to a table of pending records that each replay replaces.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources import schemas
from ..sources.io import read_optional
from ..sources.versions import commit_numbers, current_version, publish, read_commit, read_version
from .events import STATE_REJECTED, STREAM_SOURCE, _reason, decode_events, is_malformed, read_ingested, typed_fields

REPLAY_FILE = "quarentena"
PENDING = "_pendentes"


def quarantined(spark: SparkSession, sink: str) -> DataFrame:
    """Distinct rejected records: digest, raw text, first arrival and its day."""
    rejects = read_ingested(spark, sink, STATE_REJECTED)
    first = F.min(F.struct("_timestamp_ingestao", "data_ingestao", "registro_rejeitado")).alias("s")
    return rejects.where("registro_rejeitado is not null").groupBy(F.sha2("registro_rejeitado", 256).alias("registro_origem")) \
        .agg(first).select("registro_origem", "s.*")


def replay_rejected(spark: SparkSession, sink: str, table: str, mend: Callable[[Column], Column], batch: str | None = None) -> tuple[int, int]:
    """Decode the quarantine of ``sink`` again, each raw text as ``mend`` makes it; (records added, records still bad).

    Added records go to the versioned table at ``table``, by ``lote_replay``, with the
    arrival time of the rejected record, so that D1 ranks them by when they came. Two
    replays at once cannot both commit: the later one raises ``ConcurrentWrite``.
    """
    base = current_version(spark, table)
    todo = quarantined(spark, sink)
    done = read_optional(spark, table, "") if base else None
    if done is not None:
        todo = todo.join(done.select("registro_origem"), "registro_origem", "left_anti")
    decoded = decode_events(todo.withColumn("data", mend(F.col("registro_rejeitado"))))
    bad = is_malformed()
    good = decoded.where(~bad).select(
        *typed_fields(), "_timestamp_ingestao", F.lit(STREAM_SOURCE).alias("_fonte"), F.lit(REPLAY_FILE).alias("_arquivo_original"),
        "data_ingestao", "registro_origem", F.lit(batch or uuid.uuid4().hex).alias("lote_replay"))
    added = publish(good, table, ["lote_replay"], append=True, base=base, exclusive=True)
    still = decoded.where(bad).select("registro_origem", "registro_rejeitado", _reason().alias("motivo"), "_timestamp_ingestao", "data_ingestao")
    publish(still, f"{table}{PENDING}")
    places = added.changed_since(base)
    n = read_optional(spark, table, "").where(F.concat(F.lit("lote_replay="), "lote_replay").isin(list(places))).count() if places else 0
    return n, read_optional(spark, f"{table}{PENDING}", "").count()


def replayed_since(spark: SparkSession, table: str, number: int) -> tuple[DataFrame | None, int]:
    """(pupils replayed after commit ``number`` of the table or None, the table's last commit)."""
    version = current_version(spark, table)
    if version is None or version.number <= number:
        return None, number
    old = read_commit(spark, table, number) if number in commit_numbers(spark, table) else None
    new = replace(version, folders={f: p for f, p in version.folders.items() if f in version.changed_since(old)})
    return read_version(spark, table, new).select(*schemas.STUDENT.fieldNames()), version.number
