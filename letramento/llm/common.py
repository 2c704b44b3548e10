"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from letramento.session import scratch_path, table_path

#: Rows of one Arrow batch handed to Python: documents can be long, so batches stay short.
BATCH_ROWS = 256


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def short_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """Bound the rows of an Arrow batch, so that Python workers hold few long texts at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def materialize(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """Write to the shared scratch folder and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def column(batch: pa.RecordBatch, name: str) -> list:
    return batch.column(batch.schema.get_field_index(name)).to_pylist()


def as_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8", "replace")


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` of a text as UTF-8 (``bytes.split`` splits at exactly those six bytes)."""
    return as_bytes(text).split()


def lower_words(text: str | None) -> list[bytes]:
    """As ``words``, with A-Z in lower case (``bytes.lower`` touches ASCII only)."""
    return as_bytes(text).lower().split()


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of unsigned 64-bit integers (multiply-xorshift rounds)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def blocks(items: Iterator, weight, most: int) -> Iterator[list]:
    """Consecutive lists whose weights sum to ``most`` or little more."""
    out, total = [], 0
    for item in items:
        out.append(item)
        total += weight(item)
        if total >= most:
            yield out
            out, total = [], 0
    if out:
        yield out


def tidied(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` as a partition function that gives freed memory back at its end: Python workers live on for other tasks."""

    def whole(batches: Iterator) -> Iterator:
        yield from run(batches)
        release_memory()

    return whole


def release_memory() -> None:
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library: nothing to trim
        pass
