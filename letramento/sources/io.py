"""Sources and sinks S1-S5, K1."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from . import schemas
from .versions import Version, current_version, publish, read_version

_MISSING = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_raw_csv(spark: SparkSession, path: str, schema: StructType, sep: str = ",",
                 required: Sequence[str] = schemas.KEY_COLUMNS) -> DataFrame:
    """Headed CSV, columns bound by header name and read as text (no inference pass).

    Declared columns come first, in declared order; a declared column that the file
    lacks is null, unless it is ``required``; columns that are not declared follow. The
    files of a folder must have one header: another order in one of them is an error.
    """
    raw = spark.read.option("header", True).option("inferSchema", False).option("enforceSchema", False) \
        .option("sep", sep).csv(path)
    missing = [c for c in schema.fieldNames() if c not in raw.columns and c in required]
    if missing:
        raise ValueError(f"{path}: the header lacks {missing}")
    declared = [F.col(f"`{f.name}`") if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    return raw.select(*declared, *[F.col(f"`{c}`") for c in raw.columns if c not in schema.fieldNames()])


def read_layer(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame:
    """S3: a partitioned Parquet table; partition folders become columns.

    A table with commits (``write_layer``) is read as of its last one, any other folder as it is.
    """
    path = f"{root.rstrip('/')}/{table}".rstrip("/")
    version = current_version(spark, path)
    if version is not None:
        return read_version(spark, path, version, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_optional(spark: SparkSession, root: str, table: str, schema: StructType | None = None) -> DataFrame | None:
    """None when the table does not exist; any other error propagates."""
    try:
        return read_layer(spark, root, table, schema)
    except AnalysisException as exc:
        if (exc.getCondition() or "") in _MISSING:
            return None
        raise


def folder_exists(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return bool(target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target))


def read_students(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Pupil files from batch and stream folders, any mix, one declared schema.

    Each folder is read with partition discovery (``data_ingestao=...``) and the
    declared schema, so int32 and int64 id files read alike; the stream folder's
    rejected records (``estado=rejeitado``) are left out. Folders that do not exist
    are skipped.
    """
    frames = []
    for p in paths:
        df = read_optional(spark, p, "", schemas.INGESTED)
        if df is not None:
            ok = F.col("estado").isNull() | (F.col("estado") == "ok")
            frames.append(df.where(ok).select(*schemas.STUDENT.fieldNames()))
    if not frames:
        return None
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def write_layer(df: DataFrame, root: str, table: str, partition_by: Sequence[str] = (), mode: str = "overwrite", rebalance: bool = True,
                replace: Sequence | None = None, base: Version | None = None, notes=None) -> str:
    """K1: write a Parquet table partitioned by 0..n columns as its next version; returns its path.

    With ``rebalance`` the rows are first rebalanced on the partition columns: adaptive
    execution sizes the write tasks and splits a skewed partition value over several
    tasks, so each folder gets a few well-sized files instead of one file per task
    per folder, and one large year never lands in a single writer. Overwrite replaces
    the whole table. With ``replace``, values of the first partition column (or tuples of
    values of the first ones), it replaces those partitions only: a listed value without
    rows in ``df`` ends up without rows. Readers see the old rows until the new ones are
    complete, and go on seeing them if the write fails (``versions.publish``).
    """
    path = f"{root.rstrip('/')}/{table}"
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    listed = None if replace is None else {tuple(map(str, v)) if isinstance(v, tuple) else (str(v),) for v in replace}
    lengths = {len(v) for v in listed or ()}

    def replaced(values: dict[str, str]) -> bool:
        row = tuple(values[c] for c in partition_by)
        return any(row[:n] in listed for n in lengths)

    publish(df, path, partition_by, None if listed is None else replaced, mode == "append", base, notes=notes)
    return path
