"""Projections, normalisation, filters and dedup: M1-M5, P1-P12, F1-F6, D1, U1.

Every operator is ``DataFrame -> DataFrame`` with column names as arguments and no
action inside, so Catalyst can push filters and prune columns through them.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions.dims import lookup
from ..functions.numeric import safe_int

LINEAGE_COLUMNS = ["timestamp_ingestao", "fonte", "arquivo_original",
                   "_timestamp_ingestao", "_fonte", "_arquivo_original"]


# --- M: metadata -----------------------------------------------------------------

def stamp_lineage(df: DataFrame, source: str, file: str) -> DataFrame:
    """M1: ingestion time, source label and original file name."""
    return df.withColumns({"_timestamp_ingestao": F.current_timestamp(),
                           "_fonte": F.lit(source), "_arquivo_original": F.lit(file)})


def stamp_day(df: DataFrame, col: str = "data_ingestao") -> DataFrame:
    """M2: ingestion day as 'yyyy-MM-dd' text (session time zone; pin it to UTC)."""
    return df.withColumn(col, F.date_format(F.current_date(), "yyyy-MM-dd"))


def stamp_layer(df: DataFrame, layer: str) -> DataFrame:
    """M3: ``_timestamp_<layer>``."""
    return df.withColumn(f"_timestamp_{layer}", F.current_timestamp())


def drop_lineage(df: DataFrame, cols: Iterable[str] = LINEAGE_COLUMNS) -> DataFrame:
    """M4: drop lineage columns that exist (missing names are ignored)."""
    return df.drop(*cols)


def assign_ingest_day(df: DataFrame, batch_day: str, *, source_col: str = "_fonte",
                      batch_source: str = "base_dos_dados", day_col: str = "data_ingestao",
                      unknown: str = "data_desconhecida") -> DataFrame:
    """M5: batch rows get ``batch_day``; a missing day becomes ``unknown``.

    Works when the source or day column is absent (batch-only inputs).
    """
    day = F.col(day_col).cast("string") if day_col in df.columns else F.lit(None).cast("string")
    if source_col in df.columns:
        day = F.when(F.col(source_col) == batch_source, F.lit(batch_day)).otherwise(day)
    return df.withColumn(day_col, F.coalesce(day, F.lit(unknown)))


# --- P: casts and normalisation ----------------------------------------------------

def cast_columns(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Cast listed columns that exist; unparsable values become null (``try_cast``).

    Text for a whole number may be in float form: '2023.0' is 2023.
    """
    text = {f.name for f in df.schema.fields if isinstance(f.dataType, StringType)}
    return df.withColumns({c: (safe_int(c) if c in text and t in ("int", "bigint") else F.col(c)).try_cast(t)
                           for c, t in types.items() if c in df.columns})


def cast_prefix(df: DataFrame, prefix: str, type_: str = "double") -> DataFrame:
    """Cast every column starting with ``prefix``."""
    return cast_columns(df, {c: type_ for c in df.columns if c.startswith(prefix)})


def cast_family(df: DataFrame, stem: str, indexes: Iterable[int], type_: str = "double") -> DataFrame:
    """Cast ``stem{i}`` for the indexes present."""
    return cast_columns(df, {f"{stem}{i}": type_ for i in indexes})


def family(df: DataFrame, stem: str, indexes: Iterable[int]) -> list[str]:
    """Existing members of an indexed column family, in index order."""
    return [f"{stem}{i}" for i in indexes if f"{stem}{i}" in df.columns]


def normalise_code(df: DataFrame, col: str) -> DataFrame:
    """upper(trim(code))."""
    return df.withColumn(col, F.upper(F.trim(F.col(col))))


def canonicalise_by_name(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """P5: label for upper(trim(value)); an unknown value is kept, trimmed."""
    raw = F.col(col).cast("string")
    return df.withColumn(out or col, F.coalesce(lookup(F.upper(F.trim(raw)), mapping), F.trim(raw)))


def canonicalise_by_code(df: DataFrame, col: str, mapping: Mapping[str, str], out: str | None = None) -> DataFrame:
    """Label for a code read as text (ints and strings alike); unknown codes kept."""
    raw = F.col(col).cast("string")
    return df.withColumn(out or col, F.coalesce(lookup(raw, mapping), raw))


def conform(df: DataFrame, grain: str, code: Column, name: Column, columns: Sequence[str]) -> DataFrame:
    """P10: one grain's rows in the common layout (granularidade, codigo, nome, ...)."""
    head = [c for c in columns[:1]]
    return df.select(*head, F.lit(grain).alias("granularidade"), code.cast("string").alias("codigo"),
                     name.cast("string").alias("nome"), *columns[1:])


def select_existing(df: DataFrame, required: Sequence[str], optional: Sequence[str]) -> DataFrame:
    """Required columns plus the optional ones present."""
    return df.select(*required, *[c for c in optional if c in df.columns])


# --- F: filters ----------------------------------------------------------------------

def require_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """all listed columns non-null."""
    return df.dropna(subset=list(keys))


def in_range(df: DataFrame, col: str, lo: float, hi: float, null_ok: bool = True) -> DataFrame:
    """lo <= col <= hi; a null passes when ``null_ok``."""
    cond = F.col(col).between(lo, hi)
    return df.where(F.col(col).isNull() | cond if null_ok else cond)


def in_set(df: DataFrame, col: str, values: Sequence) -> DataFrame:
    """domain membership; null fails."""
    return df.where(F.col(col).isin(list(values)))


def slice_with_fallback(df: DataFrame, col: str, wanted, fallback) -> DataFrame:
    """rows of ``wanted`` if any exist, else rows of ``fallback``.

    The choice is a scalar subquery evaluated once; no driver round trip.
    """
    pick = df.select(F.when(F.max(F.col(col) == F.lit(wanted)), F.lit(wanted))
                     .otherwise(F.lit(fallback)).alias("_pick")).scalar()
    return df.where(F.col(col) == pick)


# --- D / U: dedup and union ----------------------------------------------------------

def dedup(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """One row per key; the survivor is the greatest by ``order_by`` then all columns.

    An aggregate of ``max(struct)``: map tasks keep one candidate per key before the
    shuffle, so a key with millions of copies never lands whole in one task.
    """
    keys, order_by = list(keys), list(order_by)
    rest = [c for c in df.columns if c not in keys and c not in order_by]
    cols = order_by + rest
    if not cols:
        return df.select(*keys).distinct()
    packed = df.groupBy(*keys).agg(F.max(F.struct(*[F.col(c) for c in cols])).alias("_s"))
    return packed.select(*keys, *[F.col(f"_s.{c}").alias(c) for c in cols]).select(*df.columns)


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """Stack frames by column name."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=allow_missing)
    return out
