"""Labelled rows for the classifiers: folds by CRC-32 and a bounded, documented sample."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: At most so many labelled rows fit a classifier: those with the smallest hash of their identifier.
FIT_ROWS = 20_000


def fold(id_col: str, folds: int) -> Column:
    """crc32(identifier as text) mod ``folds``; null for a null identifier."""
    return F.crc32(F.col(f"`{id_col}`").cast("long").cast("string").cast("binary")) % folds


def held_out(id_col: str, folds: int, fold_out: int) -> Column:
    """Whether a document is kept from learning; a null identifier always is."""
    return F.coalesce(fold(id_col, folds) == fold_out, F.lit(True))


def one_text_each(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """``wanted`` (a bounded table, distinct in the columns it shares with ``texts``) with one text ``t`` a row: that of the smallest hash.

    Rows of one identifier, however many, meet as one candidate per task.
    """
    keys = [c for c in wanted.columns if c in texts.columns]
    rest = [F.first(c).alias(c) for c in wanted.columns if c not in keys]
    found = texts.select(*keys, "t").join(F.broadcast(wanted), keys)
    one = found.groupBy(*keys).agg(F.min(F.struct(F.xxhash64("t").alias("h"), "t")).alias("s"), *rest)
    return one.select("s.t", *wanted.columns)


def fit_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold_out: int, id_col: str = "doc_id",
               text_col: str = "text", most: int = FIT_ROWS) -> DataFrame:
    """(id, t, y) of at most ``most`` learning rows, one per identifier. Repeated labels count once, as their smallest."""
    known = labels.where(F.col(label).isNotNull() & ~held_out(id_col, folds, fold_out)) \
        .groupBy(F.col(f"`{id_col}`").cast("long").alias("id")).agg(F.min(label).cast("double").alias("y"))
    chosen = known.orderBy(F.xxhash64("id"), "id").limit(most)
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"))
    return one_text_each(texts, chosen).select("id", "t", "y")  # at most FIT_ROWS small rows are sent to the texts
