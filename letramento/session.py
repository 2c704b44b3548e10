"""Session construction and shared scratch locations."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

LOCAL_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  driver_memory: str = "8g", extra: dict | None = None) -> SparkSession:
    """Session for tests and benchmarks on one machine."""
    builder = (SparkSession.builder.master(f"local[{cores}]").appName("letramento")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", driver_memory))
    for k, v in {**LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared folder the cluster names in ``spark.checkpoint.dir``.

    On a cluster that setting points at shared storage and is used as is. Only
    when nothing is set (local tests) a fresh temporary folder is created.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = sc.getConf().get("spark.checkpoint.dir", None)
        if not path and not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines of the cluster share")
        path = path or tempfile.mkdtemp(prefix="letramento-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


@contextmanager
def compiled_methods(spark: SparkSession) -> Iterator[None]:
    """Plans made inside generate no method that HotSpot leaves to its interpreter (8,000 bytes of code and more)."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "8000")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, never reused location under the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex[:12]}"


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
