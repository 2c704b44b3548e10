"""Ordered operators within groups: W1-W4 and O1-O4.

A plain ``Window.partitionBy(group)`` sends a whole group to one task, so a group
holding a third of the table would run in one task. Here rows are cut into slices of
about equally many rows, at sampled keys of whatever type the order columns have
(``slices``); windows run per (group, slice), and an array with one entry per slice
carries what earlier slices contribute (row offsets, the last value). Input of no more
rows than one slice holds (counted when the operator is called) takes the plain window.
The results are equal either way.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.numeric import round_half_up
from .slices import packed, slice_count, with_carried, with_offsets, with_slices

_SLICE = "_slice"
_GROUP = "_g"


def value_positions(df: DataFrame, group: Sequence[str], order_col: str,
                    descending: bool = False, slice_rows: int | None = None) -> DataFrame:
    """Distinct values per group with their position in the group's order.

    Returns ``group + [order_col, _cnt, _before, _total]``: ``_cnt`` rows carry the
    value, ``_before`` rows sort strictly ahead of it, ``_total`` rows are in the group.
    Nulls sort first, or last if ``descending``, as in Spark's windows. Duplicates collapse
    in a partial aggregate before any shuffle, so even a value shared by a third of the
    table is a single row here, and slices are of equally many distinct values.
    """
    group = list(group)
    rows, slices = slice_count(df, slice_rows)
    counts = df.groupBy(*group, order_col).agg(F.count(F.lit(1)).alias("_cnt"))
    sliced = with_slices(counts, [*group, order_col], _SLICE, rows, slices, F.col("_cnt") > 0).withColumn(_GROUP, packed(group))
    if slices > 1:
        sliced = with_offsets(sliced, _GROUP, _SLICE, "_cnt", "_before", "_total")
    else:
        sliced = sliced.withColumns({"_before": F.lit(0), "_total": F.lit(None).cast("bigint")})
    here = Window.partitionBy(_GROUP, _SLICE)
    ahead = here.orderBy(F.col(order_col).asc_nulls_first()).rowsBetween(Window.unboundedPreceding, -1)
    out = sliced.select("*", F.coalesce(F.sum("_cnt").over(ahead), F.lit(0)).alias("_ahead"), F.sum("_cnt").over(here).alias("_here"))
    out = out.select(*group, order_col, "_cnt", (F.col("_before") + F.col("_ahead")).alias("_before"),
                     F.coalesce("_total", "_here").alias("_total"))
    return out.withColumn("_before", F.col("_total") - F.col("_cnt") - F.col("_before")) if descending else out


def rank_within(df: DataFrame, partition: Sequence[str], order_col: str, descending: bool = True,
                rank_col: str = "ranking", percentile_col: str | None = "percentil",
                percentile_scale: int = 2, slice_rows: int | None = None) -> DataFrame:
    """W1 + W2: ``rank()`` and ``round(percent_rank() * 100)`` within ``partition``.

    Ties share a rank and leave gaps; percentile 0 is the first row in the order
    (the best, for a descending order). Input of one slice takes the plain window; beyond, ranks
    are computed on the distinct values (``value_positions``) and joined back on (group, value); a hot key there is one
    row on the rank side, which adaptive execution splits as a skewed join.
    """
    partition = list(partition)
    if slice_count(df, slice_rows)[1] == 1:
        group = Window.partitionBy(*partition)
        order = F.col(order_col).desc_nulls_last() if descending else F.col(order_col).asc_nulls_first()
        out = df.select("*", F.rank().over(group.orderBy(order)).alias(rank_col))
        if not percentile_col:
            return out
        share = F.try_divide(F.col(rank_col) - 1, F.count(F.lit(1)).over(group) - 1)
        return out.withColumn(percentile_col, round_half_up(F.coalesce(share, F.lit(0.0)) * 100, percentile_scale))
    pos = value_positions(df, partition, order_col, descending, slice_rows)
    key = F.struct(*[F.col(c) for c in partition], F.col(order_col))
    pr = F.when(F.col("_total") > 1, F.col("_before") / (F.col("_total") - 1)).otherwise(F.lit(0.0))
    cols = [key.alias("_k"), (F.col("_before") + 1).cast("int").alias(rank_col)]
    if percentile_col:
        cols.append(round_half_up(pr * 100, percentile_scale).alias(percentile_col))
    return df.withColumn("_k", key).join(pos.select(*cols), "_k", "left").drop("_k")


def lag_within(df: DataFrame, partition: Sequence[str], order_cols: Sequence[str], value_col: str,
               out_col: str, slice_rows: int | None = None) -> DataFrame:
    """Value of the previous row in ``order_cols`` order within ``partition``.

    ``order_cols`` must be unique within a partition (as (state, network, year) is).
    The first row of a group gets null. The first row that a group has in a slice takes
    the value of the last row of the slice before.
    """
    partition, order_cols = list(partition), list(order_cols)
    order = [F.col(c).asc_nulls_first() for c in order_cols]
    names = [*partition, *order_cols]
    rows, slices = slice_count(df, slice_rows)
    if slices == 1:
        return df.withColumn(out_col, F.lag(value_col, 1).over(Window.partitionBy(*partition).orderBy(*order)))
    sliced = with_slices(df, names, _SLICE, rows, slices).withColumn(_GROUP, packed(partition))
    w = Window.partitionBy(_GROUP, _SLICE).orderBy(*order)
    sliced = with_carried(sliced, _GROUP, _SLICE, packed(names), value_col, "_carry")
    out = sliced.select("*", F.lag(value_col, 1).over(w).alias("_lag"), (F.row_number().over(w) == 1).alias("_head"))
    return (out.withColumn(out_col, F.when(F.col("_head"), F.col("_carry")).otherwise(F.col("_lag")))
            .drop("_lag", "_head", "_carry", _SLICE, _GROUP))


def first_last(df: DataFrame, group: Sequence[str], order_col: str, cols: Sequence[str],
               first_prefix: str = "primeiro_", last_prefix: str = "ultimo_") -> DataFrame:
    """First and last value of each column in ``order_col`` order, per group.

    An aggregate (``min_by`` / ``max_by``), so partial aggregation runs before the shuffle.
    """
    aggs = []
    for c in cols:
        aggs.append(F.min_by(c, order_col).alias(first_prefix + c))
        aggs.append(F.max_by(c, order_col).alias(last_prefix + c))
    aggs += [F.min(order_col).alias(first_prefix + order_col), F.max(order_col).alias(last_prefix + order_col),
             F.count(F.lit(1)).alias("n_pontos")]
    return df.groupBy(*group).agg(*aggs)


def sort_for_write(df: DataFrame, partition_cols: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """O1: order rows inside each output partition without a global sort.

    Range partitioning on (partition columns, order) spreads a large output partition
    over several tasks; each writes its own sorted file into the partition folder.
    """
    keys = [F.col(c) for c in partition_cols] + list(order)
    # no fixed partition count: adaptive execution may coalesce small outputs
    return df.repartitionByRange(*keys).sortWithinPartitions(*keys)


def ordered_slice(df: DataFrame, condition: Column, order: Sequence[Column]) -> DataFrame:
    """O2: the rows of one slice (a year, a network) in ``order``; a range exchange sorts across tasks."""
    return df.where(condition).orderBy(*order)


def top_k(df: DataFrame, k: int, order: Sequence[Column]) -> DataFrame:
    """O3: first ``k`` rows by ``order`` (each task keeps only k candidates)."""
    return df.orderBy(*order).limit(k)
