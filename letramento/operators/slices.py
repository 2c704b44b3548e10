"""Equal-depth slices of ordered rows, for keys of any orderable type.

All rows are put in the order of one key (group columns, then order columns) and cut at
sampled keys, the splitters, into slices of about equally many rows. A group of any size
is then worked on by as many tasks as it has slices, and small groups share a slice. A key
is taken into the sample by its hash, so the splitters are a function of the data alone:
a task that runs again after a lost executor puts every row into the same slice.

A splitter lies within one group, so only the first group of a slice can have rows in the
slice before and only the last one rows in the slice behind. What slices tell each other
is therefore an array with one entry per slice, at most ``spark.sql.shuffle.partitions`` of
them, read as a scalar subquery: no join, and no row per group leaves the executors.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

SLICE_ROWS_CONF = "letramento.window.sliceRows"
DEFAULT_SLICE_ROWS = 1_000_000
#: Sampled keys per slice: with 64 a slice holds more than twice its share with a chance below one in a million.
SAMPLES = 64
_HASHES = 1 << 40


def packed(columns: Sequence[str]) -> Column:
    """The columns as one struct. Structs compare field by field, nulls first, and null fields are equal."""
    return F.struct(*[F.col(c) for c in columns]) if columns else F.struct(F.lit(0).alias("_all"))


def rows_a_slice(df: DataFrame, slice_rows: int | None = None) -> int:
    return slice_rows or int(df.sparkSession.conf.get(SLICE_ROWS_CONF, str(DEFAULT_SLICE_ROWS)))


def slice_count(df: DataFrame, slice_rows: int | None = None) -> tuple[int, int]:
    """(rows of ``df``, slices they need: ceil(rows / slice rows), but no more than shuffle partitions). Runs a count."""
    rows, most = df.count(), max(1, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200")))
    return rows, max(1, min(most, -(-rows // rows_a_slice(df, slice_rows))))


def with_slices(df: DataFrame, columns: Sequence[str], number: str, rows: int, slices: int, counted: Column | None = None) -> DataFrame:
    """``df`` with the number of each row's slice, ascending in the order of ``columns`` (nulls first).

    Rows with equal keys share a slice. ``rows`` and ``slices`` come from ``slice_count`` on ``df`` or on the
    rows it was aggregated from; they decide how evenly rows are spread, never the result. ``counted`` is a condition
    that holds for every row; one on an aggregate's result keeps the aggregate as it is for the sample too, so that Spark runs it once.
    """
    if slices <= 1:
        return df.withColumn(number, F.lit(0))
    key = packed(columns)
    taken = F.pmod(F.xxhash64(key), F.lit(_HASHES)) < F.lit(float(SAMPLES * _HASHES) * slices / max(rows, 1))
    taken = taken if counted is None else counted & taken
    sample = df.select(F.sort_array(F.collect_list(F.when(taken, key))).alias("_sample"))
    regular = F.transform(F.sequence(F.lit(1), F.lit(slices - 1)),
                          lambda i: F.get(F.col("_sample"), F.floor(i * F.size("_sample") / F.lit(slices)).cast("int")))
    splitters = sample.select(F.array_distinct(F.array_compact(regular))).scalar()
    # binary search for the number of splitters up to the key; past the end of the array `get` is null.
    # The splitters are named before, as analysis takes no subquery in a lambda; the optimizer puts them back in.
    steps = F.array(*[F.lit(1 << b) for b in reversed(range(slices.bit_length()))])
    found = F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get("_splitters", at + step - 1) <= F.col("_key"), at + step).otherwise(at))
    return df.select("*", splitters.alias("_splitters"), key.alias("_key")).select(*df.columns, found.alias(number))


def _by_slice(entries: DataFrame) -> Column:
    """The rows of ``entries`` as an array indexed by ``slice``. Slices behind the first hold their splitter, so only slice 0 can be empty."""
    rows = entries.select(F.sort_array(F.collect_list(F.struct(*entries.columns))).alias("a"))
    absent = F.array(F.get("a", F.lit(-1)))  # null
    return rows.select(F.when(F.get("a", F.lit(0)).getField("slice") > 0, F.concat(absent, "a")).otherwise(F.col("a"))).scalar()


def with_offsets(sliced: DataFrame, group: str, number: str, weight: str, before: str, total: str) -> DataFrame:
    """Add ``before``, the weight of the row's group in earlier slices, and ``total``, its weight in all slices (null if the group has one slice)."""
    each = sliced.groupBy(F.col(number).alias("slice"), F.col(group).alias("g")).agg(F.sum(weight).alias("n"))
    one = F.struct("g", "n")
    ends = each.groupBy("slice").agg(F.array_distinct(F.array(F.min_by(one, "g"), F.max_by(one, "g"))).alias("ends"))
    ends = ends.select("slice", F.inline("ends"))  # two rows a slice at most
    across = Window.partitionBy("g")
    ahead = F.sum("n").over(across.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1))
    ends = ends.select("slice", F.struct("g", F.coalesce(ahead, F.lit(0)).alias("before"), F.sum("n").over(across).alias("total")).alias("e"))
    ends = ends.groupBy("slice").agg(F.min("e").alias("first"), F.max("e").alias("last"))
    out = sliced.select("*", F.get(_by_slice(ends), F.col(number)).alias("_edge"))
    own = F.when(F.col(group) == F.col("_edge.first.g"), F.col("_edge.first")).when(F.col(group) == F.col("_edge.last.g"), F.col("_edge.last"))
    out = out.select(*sliced.columns, own.alias("_own"))
    return out.select(*sliced.columns, F.coalesce("_own.before", F.lit(0)).alias(before), F.col("_own.total").alias(total))


def with_carried(sliced: DataFrame, group: str, number: str, key: Column, value: str, out_col: str) -> DataFrame:
    """Add ``out_col``: ``value`` of the last row of the slice before, null if that row is of another group."""
    tail = F.max_by(F.struct(F.col(group).alias("g"), F.col(value).alias("v")), key)
    tails = sliced.groupBy(F.col(number).alias("slice")).agg(tail.alias("tail"))
    out = sliced.select("*", F.get(_by_slice(tails), F.col(number) - 1).getField("tail").alias("_tail"))
    return out.select(*sliced.columns, F.when(F.col(group) == F.col("_tail.g"), F.col("_tail.v")).alias(out_col))
