"""Approximate nearest neighbours on shifted space-filling curves.

Each of ``curves`` random rotations projects the vectors to ``dims`` axes; the shifted,
quantised projections give a position on a Hilbert curve. Spark range-partitions the rows
of all curves by (curve, position), which ranks them; a query takes the window of ranks
around its own on every curve, and the union is ranked again by the Euclidean distance of
the original vectors in double precision. Windows are ``share`` of the rows to either side:
vectors without structure in 64 dimensions have no near region much smaller than that, and a
window of a fixed number of rows (``window``) loses recall as the table grows. Windows are cut
into blocks of ranks, and the queries that meet a block into parts, so that a task holds one
block and a bounded number of queries. A matrix product per block finds the candidates that
can be among the nearest; only those are measured exactly. Vectors travel in the type given.

Defined results: vectors that are null, zero, hold null or non-finite components or have
another length than most take no part, nor do rows with a null identifier; rows that share
the query's identifier are no candidates; ties go to the smaller identifier, repeated
candidates count once; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letramento.llm.common import materialize
from letramento.llm.hilbert import hilbert_position

CURVES, DIMS, BITS = 8, 4, 12
SHARE, LEAST_ROWS = 0.1, 64
BLOCK = 4096
#: Queries of one group, and of one matrix product.
QUERIES, QUERY_BLOCK = 1 << 13, 32


def matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64)


def usable_vectors(rows: DataFrame, id_col: str, vec_col: str) -> tuple[DataFrame, int, float]:
    """(id, vec) of the vectors that take part, their length and the largest norm."""
    given = rows.schema[vec_col].dataType
    single = isinstance(given, T.ArrayType) and isinstance(given.elementType, T.FloatType)
    vec = F.col(f"`{vec_col}`").cast("array<float>" if single else "array<double>")
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    good = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), vec.alias("vec")) \
        .where(F.col("id").isNotNull() & F.col("vec").isNotNull() & F.forall("vec", number) & F.exists("vec", lambda x: x != 0))
    sizes = good.groupBy(F.size("vec").alias("n")).agg(
        F.count(F.lit(1)).alias("rows"), F.max(F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))).alias("norm"))
    most = sizes.orderBy(F.desc("rows"), F.desc("n")).limit(1).collect()
    length, norm = (most[0].n, most[0].norm) if most else (0, 1.0)
    return good.where(F.size("vec") == length), length, norm


def _curve_rows(length: int, norm: float, curves: int, seed: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    rng = np.random.default_rng(seed)
    dims = min(DIMS, length)
    axes = [np.linalg.qr(rng.normal(size=(length, length)))[0][:, :dims] for _ in range(curves)]
    shifts = rng.random((curves, dims))

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in frames:
            if len(pdf):
                x = matrix(pdf.vec) / norm
                for c in range(curves):
                    cells = ((x @ axes[c] + 1) / 2 + shifts[c]) / 2 * (1 << BITS)
                    at = hilbert_position(np.clip(cells.astype(np.int64), 0, (1 << BITS) - 1), BITS)
                    yield pd.DataFrame({"curve": c, "at": at, "id": pdf.id, "vec": pdf.vec})

    return run


def _best(k: int) -> Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]:
    """One block of candidates and its queries -> the k nearest within each query's window."""

    def run(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
        out = [pd.DataFrame({"query_id": [], "vec_id": [], "score": []})]
        if len(rows) and len(queries):
            x, ids, ranks = matrix(rows.vec), rows.id.to_numpy(), rows["rank"].to_numpy()
            norms = (x * x).sum(1)
            enough = min(k * np.unique(ids, return_counts=True)[1].max(), len(ids))  # rows that hold k identifiers
            for at in range(0, len(queries), QUERY_BLOCK):
                some = queries.iloc[at:at + QUERY_BLOCK]
                q, own, lo, hi = matrix(some.qvec), *(some[c].to_numpy()[:, None] for c in ("query_id", "lo", "hi"))
                size = (q * q).sum(1)[:, None]
                taken = (ranks >= lo) & (ranks <= hi) & (ids != own)
                square = np.where(taken, norms + size - 2 * (q @ x.T), np.inf)
                limit = np.partition(square, enough - 1, 1)[:, enough - 1:enough] + 1e-9 * (norms.max() + size)
                i, j = np.nonzero(taken & (square <= limit))
                found = pd.DataFrame({"query_id": own[i, 0], "vec_id": ids[j], "score": np.sqrt(((x[j] - q[i]) ** 2).sum(1))})
                found = found.sort_values(["query_id", "score", "vec_id"]).drop_duplicates(["query_id", "vec_id"])
                out.append(found.groupby("query_id").head(k))
        return pd.concat(out) if len(out) > 1 else out[0]

    return run


def nearest(rows: DataFrame, is_query: F.Column, k: int = 10, id_col: str = "vec_id", vec_col: str = "embedding",
            curves: int = CURVES, share: float = SHARE, window: int | None = None, seed: int = 7) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k nearest found. ``is_query`` is a condition on column ``id``."""
    good, length, norm = usable_vectors(rows, id_col, vec_col)
    laid = good.mapInPandas(_curve_rows(max(1, length), norm, curves, seed), f"curve int, at long, id long, vec {good.schema['vec'].dataType.simpleString()}")
    order = ["curve", "at", "id"]
    placed = materialize(laid.repartitionByRange(*order).sortWithinPartitions(*order)
                         .withColumn("place", F.monotonically_increasing_id()), "ann-curves")
    placed = placed.withColumn("part", F.shiftright("place", 33))
    counts = placed.groupBy("curve", "part").agg(F.count(F.lit(1)).alias("n"), F.min("place").alias("first"))
    before = Window.partitionBy("curve").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("skip", F.col("first") - F.coalesce(F.sum("n").over(before), F.lit(0))).select("curve", "part", "skip")
    ranked = placed.join(offsets, ["curve", "part"]).select("curve", (F.col("place") - F.col("skip")).alias("rank"), "id", "vec") \
        .withColumn("block", F.floor(F.col("rank") / BLOCK))
    total, asking = placed.where("curve = 0").agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    width = window if window is not None else max(LEAST_ROWS, int(np.ceil(share * total)))
    last = max(0, total - 1 - 2 * width)
    parts = max(1, -(-min(asking, 2 * width + BLOCK) // QUERIES))
    asked = ranked.where(is_query).select(F.col("curve").alias("qcurve"), F.col("id").alias("query_id"), F.col("vec").alias("qvec"), (F.col("rank") % parts).alias("qpart"),
                                          F.greatest(F.lit(0), F.least(F.col("rank") - width, F.lit(last))).alias("lo")) \
        .withColumn("hi", F.col("lo") + 2 * width) \
        .withColumn("qblock", F.explode(F.sequence(F.floor(F.col("lo") / BLOCK), F.floor(F.least("hi", F.lit(max(0, total - 1))) / BLOCK))))
    dealt = ranked.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(parts - 1).cast("long"))))
    found = dealt.groupBy("curve", "block", "part").cogroup(asked.groupBy("qcurve", "qblock", "qpart")) \
        .applyInPandas(_best(k), "query_id long, vec_id long, score double")
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    by = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
