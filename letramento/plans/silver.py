"""Bronze -> silver (V1-V6): types, normalisation, key and range filters, dedup.

Order per table: cast, normalise, require keys, range filter, then keep one row per
natural key (the latest ingestion; remaining ties broken by all columns), so an
invalid duplicate can never evict a valid row. Pupils that arrive later are merged into
the folders they touch (``upsert_students``) instead of recomputing the table.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions import dims
from ..operators import clean as C
from ..operators.quality import reject_reasons
from ..sources import schemas
from ..sources.io import folder_exists, read_layer, read_optional, read_students, write_layer
from ..sources.versions import Version, current_version, partition_values, read_version
from ..streaming.replay import replayed_since
from .bronze import STUDENT_BATCH_TABLE, STUDENT_REPLAY_TABLE, STUDENT_STREAM_TABLE
from .concurrency import DEFAULT_WORKERS, run_all

ORDER = ["_timestamp_ingestao"]
AUDIT_TABLE = "_auditoria"
#: Folder of the discarded rows, one table per silver table, partitioned by the rule they fail first.
DISCARDS, PASSED = "_descartes", "ok"
RULES = ["chave_nula", "fora_do_intervalo"]
STUDENT_RULES = ["chave_nula", "fora_do_dominio", "fora_do_intervalo"]


def _any_null(cols: list[str]) -> Column:
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.col(c).isNull()
    return cond


def _rejected(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """Q8: the rows that fail a rule, with the first one they fail (in rule order) as ``motivo``."""
    return reject_reasons(df, rules, PASSED).where(F.col("motivo") != PASSED)


def _finish(df: DataFrame, keys: list[str], rate: str = "taxa_alfabetizacao", lo: float = 0, hi: float = 100,
            rejected: bool = False) -> DataFrame:
    required = [k for k in keys if k != "serie"]
    if rejected:
        failing = [_any_null(required), F.col(rate).isNotNull() & ~F.col(rate).between(lo, hi)]
        return _rejected(df, list(zip(RULES, failing)))
    df = C.require_keys(df, required)
    df = C.in_range(df, rate, lo, hi)
    df = C.dedup(df, keys, [c for c in ORDER if c in df.columns])
    return C.stamp_layer(C.drop_lineage(df), "silver")


def silver_meta_brasil(df: DataFrame, rejected: bool = False) -> DataFrame:
    df = C.cast_prefix(C.cast_columns(df, schemas.META_TYPES), "meta_alfabetizacao_")
    df = C.canonicalise_by_name(df, "rede", dims.REDE_BY_NAME)
    return _finish(df, ["ano", "rede"], rejected=rejected)


def silver_meta_uf(df: DataFrame, rejected: bool = False) -> DataFrame:
    df = C.cast_prefix(C.cast_columns(df, schemas.META_TYPES), "meta_alfabetizacao_")
    df = C.canonicalise_by_name(C.normalise_code(df, "sigla_uf"), "rede", dims.REDE_BY_NAME)
    return _finish(df, ["ano", "sigla_uf", "rede"], rejected=rejected)


def silver_meta_municipio(df: DataFrame, rejected: bool = False) -> DataFrame:
    df = C.cast_prefix(C.cast_columns(df, schemas.META_MUNICIPIO_TYPES), "meta_alfabetizacao_")
    df = C.canonicalise_by_name(df, "rede", dims.REDE_BY_NAME)
    return _finish(df, ["ano", "id_municipio", "rede"], rejected=rejected)


def silver_avaliacao_uf(df: DataFrame, rejected: bool = False) -> DataFrame:
    df = C.cast_family(C.cast_columns(df, schemas.AVALIACAO_TYPES), "proporcao_aluno_nivel_", range(9))
    df = C.canonicalise_by_code(C.normalise_code(df, "sigla_uf"), "rede", dims.REDE_BY_CODE)
    return _finish(df, ["ano", "sigla_uf", "serie", "rede"], rejected=rejected)


def silver_avaliacao_municipio(df: DataFrame, rejected: bool = False) -> DataFrame:
    df = C.cast_family(C.cast_columns(df, schemas.AVALIACAO_MUNICIPIO_TYPES), "proporcao_aluno_nivel_", range(9))
    df = C.canonicalise_by_code(df, "rede", dims.REDE_BY_CODE)
    return _finish(df, ["ano", "id_municipio", "serie", "rede"], rejected=rejected)


STUDENT_TABLE, STUDENT_KEYS = "Ts_aluno", ["nu_ano_avaliacao", "id_aluno"]
#: Pupils lie in folders by year and by a hash of the pupil: the unit that a refresh reads and replaces.
STUDENT_PARTITIONS, BUCKET, ORIGIN = ["nu_ano_avaliacao", "balde"], "balde", "_origem"
#: Setting with the number of hash folders of a year, read when the table is made; by default that of the shuffle partitions.
BUCKETS_SETTING = "letramento.silver.buckets"
LINEAGE = [n for n, _ in schemas.STUDENT_LINEAGE_FIELDS]


def clean_students(df: DataFrame, batch_day: str, rejected: bool = False) -> DataFrame:
    """V6 up to the dedup: typed, normalised pupils with their keys and within range, lineage kept (``rejected``: those that fail, with their reason)."""
    df = C.cast_columns(df, schemas.STUDENT_TYPES)
    df = C.normalise_code(df, "sg_uf")
    df = C.assign_ingest_day(df, batch_day)
    score = F.col("vl_proficiencia_lp")
    if rejected:
        failing = [_any_null(["nu_ano_avaliacao", "id_aluno", "co_uf"]), ~F.coalesce(F.col("tp_dependencia").isin(1, 2, 3, 4), F.lit(False)),
                   score.isNotNull() & ~score.between(400, 1000)]
        return _rejected(df, list(zip(STUDENT_RULES, failing)))
    df = C.require_keys(df, ["nu_ano_avaliacao", "id_aluno", "co_uf"])
    df = C.in_set(df, "tp_dependencia", [1, 2, 3, 4])
    return C.in_range(df, "vl_proficiencia_lp", 400, 1000)


def keep_latest(clean: DataFrame) -> DataFrame:
    """One row per (year, pupil). The greatest of greatest rows is the greatest of all, so parts may be merged in any order."""
    return C.dedup(clean.select(*schemas.STUDENT.fieldNames()), STUDENT_KEYS, ORDER)


def silver_students(df: DataFrame, batch_day: str) -> DataFrame:
    """V6: batch and stream pupils; range filters first, then one row per (year, pupil)."""
    return C.stamp_layer(C.drop_lineage(keep_latest(clean_students(df, batch_day))), "silver")


def new_buckets(spark: SparkSession) -> int:
    return int(spark.conf.get(BUCKETS_SETTING, spark.conf.get("spark.sql.shuffle.partitions")))


def bucket_of(buckets: int) -> Column:
    return F.pmod(F.xxhash64("id_aluno"), F.lit(buckets)).cast("int")


def stored_students(latest: DataFrame, buckets: int) -> DataFrame:
    """Silver pupils as they are stored: with their folder, and with the lineage that decides between rows of one pupil."""
    origin = F.struct(*LINEAGE).alias(ORIGIN)
    return C.stamp_layer(C.drop_lineage(latest.select("*", origin, bucket_of(buckets).alias(BUCKET))), "silver")


def restored_students(stored: DataFrame) -> DataFrame:
    """The rows of ``keep_latest`` that ``stored_students`` holds."""
    return stored.select("*", *[F.col(f"{ORIGIN}.{c}").alias(c) for c in LINEAGE]).select(*schemas.STUDENT.fieldNames())


SILVER_TABLES = {
    "Meta_brasil": silver_meta_brasil,
    "Meta_uf": silver_meta_uf,
    "Meta_municipio": silver_meta_municipio,
    "Avaliacao_uf": silver_avaliacao_uf,
    "Avaliacao_municipio": silver_avaliacao_municipio,
}


def write_discards(rejected: DataFrame, silver_root: str, table: str, rules: list[str]) -> dict[str, int]:
    """Q8: store the discarded rows by reason; rows per reason, counted in the committed files."""
    root = f"{silver_root.rstrip('/')}/{DISCARDS}"
    write_layer(rejected, root, table, ["motivo"])
    found = {r["motivo"]: r["count"] for r in read_layer(rejected.sparkSession, root, table, rejected.schema).groupBy("motivo").count().collect()}
    return {rule: found.get(rule, 0) for rule in rules}


def audit_rows_of(source: DataFrame, rejected: DataFrame, silver_root: str, table: str, rules: list[str], written: int) -> list[tuple[str, str, int]]:
    """Q8: rows read, discarded by reason, duplicate and written of one table.

    Every number is a count over stored rows (bronze files, committed discards, committed
    silver), which a task that runs twice cannot change; ``source`` is the bronze commit that
    the silver rows came from. Discards are a second read of it, and store only the rows that fail.
    """
    read, dropped = source.count(), write_discards(rejected, silver_root, table, rules)
    return [(table, "lidos", read), *[(table, rule, n) for rule, n in dropped.items()],
            (table, "duplicata", read - sum(dropped.values()) - written), (table, "gravados", written)]


def _write_counted(df: DataFrame, silver_root: str, table: str, partition_by: list[str], notes: dict | None = None) -> int:
    write_layer(df, silver_root, table, partition_by, notes=notes)
    return read_layer(df.sparkSession, silver_root, table, df.schema).count()


def run_silver_students(spark: SparkSession, bronze_root: str, silver_root: str, batch_day: str,
                        audit_rows: list | None = None, tables: tuple[str, ...] = (STUDENT_BATCH_TABLE, STUDENT_STREAM_TABLE, STUDENT_REPLAY_TABLE)) -> int | None:
    """V6 alone, whole: batch, stream and replayed bronze pupils -> silver ``Ts_aluno``; None if there are none."""
    replay = current_version(spark, f"{bronze_root.rstrip('/')}/{STUDENT_REPLAY_TABLE}") if STUDENT_REPLAY_TABLE in tables else None
    students = read_students(spark, [f"{bronze_root.rstrip('/')}/{t}" for t in tables])
    if students is None:
        return None
    buckets = new_buckets(spark)
    stored = stored_students(keep_latest(clean_students(students, batch_day)), buckets)
    n = _write_counted(stored, silver_root, STUDENT_TABLE, STUDENT_PARTITIONS, {"buckets": buckets, "replay": replay.number if replay else 0})
    if audit_rows is not None:
        audit_rows += audit_rows_of(students, clean_students(students, batch_day, rejected=True), silver_root, STUDENT_TABLE, STUDENT_RULES, n)
    return n


def upsert_students(arrived: DataFrame, silver_root: str, batch_day: str, notes: dict | None = None) -> int:
    """V6 for arrivals: merge them into the (year, bucket) folders they touch; returns the number of folders rewritten.

    Only these folders are read and replaced, in one commit. Arrivals that came before
    change nothing, so a batch may be merged twice; the result is that of a whole
    recompute over everything merged so far, in whatever order.
    """
    spark, path = arrived.sparkSession, f"{silver_root.rstrip('/')}/{STUDENT_TABLE}"
    base = current_version(spark, path)
    buckets = base.notes["buckets"] if base else new_buckets(spark)
    clean = clean_students(arrived, batch_day).persist()
    try:
        touched = {(str(y), str(b)) for y, b in clean.select(STUDENT_KEYS[0], bucket_of(buckets)).distinct().collect()}  # years x buckets at most
        if not touched:
            return 0
        rows = clean.select(*schemas.STUDENT.fieldNames())
        if base is not None:
            old = {f: p for f, p in base.folders.items() if tuple(partition_values(f).values()) in touched}
            rows = rows.unionByName(restored_students(read_version(spark, path, replace(base, folders=old))))
        write_layer(stored_students(keep_latest(rows), buckets), silver_root, STUDENT_TABLE, STUDENT_PARTITIONS,
                    replace=sorted(touched), base=base, notes={**(base.notes if base else {"buckets": buckets}), **(notes or {})})
        return len(touched)
    finally:
        clean.unpersist()


def start_upsert(spark: SparkSession, bronze_root: str, silver_root: str, batch_day: str, **options) -> StreamingQuery:
    """The stream's committed bronze files, each once, merged into silver (``availableNow``); ``options`` bound a micro-batch."""
    reader = spark.readStream.schema(schemas.INGESTED)
    for k, v in options.items():
        reader = reader.option(k, v)
    good = reader.parquet(f"{bronze_root.rstrip('/')}/{STUDENT_STREAM_TABLE}").where("estado = 'ok'").select(*schemas.STUDENT.fieldNames())

    def merge(batch: DataFrame, _: int) -> None:
        upsert_students(batch, silver_root, batch_day)

    return (good.writeStream.foreachBatch(merge).trigger(availableNow=True)
            .option("checkpointLocation", f"{silver_root.rstrip('/')}/_checkpoints/{STUDENT_TABLE}").start())


def refresh_silver_students(spark: SparkSession, bronze_root: str, silver_root: str, batch_day: str, **options) -> Version | None:
    """ST11 / V6: bring silver pupils up to what the stream and replays have committed; the table's commit, None if there are no pupils.

    A table that does not exist yet starts with the batch pupils. Batch pupils that were
    loaded anew since need ``run_silver_students``, as only that takes rows away.
    """
    path = f"{silver_root.rstrip('/')}/{STUDENT_TABLE}"
    if current_version(spark, path) is None:
        run_silver_students(spark, bronze_root, silver_root, batch_day, tables=(STUDENT_BATCH_TABLE,))
    if folder_exists(spark, f"{bronze_root.rstrip('/')}/{STUDENT_STREAM_TABLE}"):
        query = start_upsert(spark, bronze_root, silver_root, batch_day, **options)
        query.awaitTermination()
        if query.exception() is not None:
            raise RuntimeError(f"silver refresh failed: {query.exception()}")
    now = current_version(spark, path)
    mended, number = replayed_since(spark, f"{bronze_root.rstrip('/')}/{STUDENT_REPLAY_TABLE}", now.notes.get("replay", 0) if now else 0)
    if mended is not None:
        upsert_students(mended, silver_root, batch_day, {"replay": number})
    return current_version(spark, path)


def run_silver(spark: SparkSession, bronze_root: str, silver_root: str, batch_day: str,
               workers: int = DEFAULT_WORKERS) -> dict[str, int]:
    """V1-V6 (tables concurrently; bronze tables that do not exist are skipped), plus
    the discard audit ``_auditoria`` (rows read, dropped per rule, duplicates, written)."""
    present = {t: df for t in SILVER_TABLES if (df := read_optional(spark, bronze_root, t)) is not None}
    audit_rows: list[tuple[str, str, int]] = []

    def build(table: str, df: DataFrame) -> int:
        written = _write_counted(SILVER_TABLES[table](df), silver_root, table, ["ano"])
        audit_rows.extend(audit_rows_of(df, SILVER_TABLES[table](df, rejected=True), silver_root, table, RULES, written))
        return written

    jobs = {table: (lambda table=table, df=df: build(table, df)) for table, df in present.items()}
    jobs["Ts_aluno"] = lambda: run_silver_students(spark, bronze_root, silver_root, batch_day, audit_rows)
    counts = {k: v for k, v in run_all(jobs, workers).items() if v is not None}
    # one row per (table, reason): bounded by the number of tables and rules
    audit_df = spark.createDataFrame(audit_rows, "tabela string, motivo string, registros long")
    write_layer(audit_df.coalesce(1), silver_root, AUDIT_TABLE)
    return counts
