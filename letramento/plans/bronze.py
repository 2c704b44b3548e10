"""Raw -> bronze (B1, B2): declared-schema reads, lineage stamps, partitioned Parquet.

Indicator tables keep their raw text (silver types them). Pupil files get the same
safe typing as the stream at this step, so batch and stream bronze files share one
schema and can be read together (S4).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import safe_double, safe_int, safe_string
from ..operators.clean import stamp_day, stamp_lineage
from ..sources import schemas
from ..sources.io import read_raw_csv, write_layer
from .concurrency import DEFAULT_WORKERS, run_all
from pyspark.sql.types import DoubleType, IntegerType, LongType

BATCH_SOURCE = "base_dos_dados"


@dataclass(frozen=True)
class RawSource:
    table: str
    schema: object
    sep: str = ","
    partition_by: tuple[str, ...] = ("ano",)


INDICATOR_SOURCES = [
    RawSource("Meta_brasil", schemas.META_BRASIL_RAW),
    RawSource("Meta_uf", schemas.META_UF_RAW),
    RawSource("Meta_municipio", schemas.META_MUNICIPIO_RAW),
    RawSource("Avaliacao_uf", schemas.AVALIACAO_UF_RAW),
    RawSource("Avaliacao_municipio", schemas.AVALIACAO_MUNICIPIO_RAW),
]
STUDENT_BATCH_TABLE = "Ts_aluno_batch"
STUDENT_STREAM_TABLE = "Ts_aluno_stream"
STUDENT_REPLAY_TABLE = "Ts_aluno_replay"


def _write_counted(df: DataFrame, root: str, table: str, partition_by, rebalance: bool = True) -> int:
    obs = Observation(table)
    counted = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    write_layer(counted, root, table, partition_by, rebalance=rebalance)
    return int(obs.get["rows"])


def ingest_indicator(spark: SparkSession, raw_path: str, bronze_root: str, source: RawSource) -> int:
    """B1: one indicator CSV -> bronze; returns the rows written (counted during the write)."""
    df = read_raw_csv(spark, raw_path, source.schema, source.sep)
    df = stamp_lineage(df, BATCH_SOURCE, raw_path.rstrip("/").rsplit("/", 1)[-1])
    return _write_counted(df, bronze_root, source.table, list(source.partition_by))


def type_students(df: DataFrame) -> DataFrame:
    """Contract types for pupil text fields (ST2-ST4 rules)."""
    cols = []
    for name, t in schemas.STUDENT_DATA_FIELDS:
        c = F.col(name)
        if isinstance(t, IntegerType):
            cols.append(safe_int(c).try_cast("int").alias(name))
        elif isinstance(t, LongType):
            cols.append(safe_int(c).alias(name))
        elif isinstance(t, DoubleType):
            cols.append(safe_double(c).alias(name))
        else:
            cols.append(safe_string(c).alias(name))
    return df.select(*cols)


def ingest_students(spark: SparkSession, raw_path: str, bronze_root: str, sep: str = ";") -> int:
    """B2: the pupil CSV -> its own bronze folder, partitioned by ingestion day.

    The batch folder is separate from the stream folder, so a batch overwrite never
    removes streamed days.
    """
    df = type_students(read_raw_csv(spark, raw_path, schemas.STUDENT_RAW, sep))
    df = stamp_day(stamp_lineage(df, BATCH_SOURCE, raw_path.rstrip("/").rsplit("/", 1)[-1]))
    # one load has one ingestion day: every task writes one file as it is, nothing is shuffled
    return _write_counted(df, bronze_root, STUDENT_BATCH_TABLE, ["data_ingestao"], rebalance=False)


def run_bronze(spark: SparkSession, raw_files: dict[str, str], bronze_root: str,
               workers: int = DEFAULT_WORKERS) -> dict[str, int]:
    """All raw files present in ``raw_files`` (table -> path) into bronze, tables concurrently."""
    jobs = {src.table: (lambda src=src: ingest_indicator(spark, raw_files[src.table], bronze_root, src))
            for src in INDICATOR_SOURCES if src.table in raw_files}
    if "Ts_aluno" in raw_files:
        jobs[STUDENT_BATCH_TABLE] = lambda: ingest_students(spark, raw_files["Ts_aluno"], bronze_root)
    return run_all(jobs, workers)
