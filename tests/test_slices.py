"""Slices at sampled keys: ranks, lags and quantiles equal the plain windows, and large groups spread over tasks."""

import datetime
import decimal

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from letramento.operators import aggregates as A
from letramento.operators import windows as W
from letramento.operators.slices import slice_count, with_slices

N = 4000


def _values(kind):
    if kind == "text":
        return "string", [f"aluno {i * 7919 % N:05d}" for i in range(N)]
    if kind == "skewed":  # half of the rows in 0.1 % of the range, and one value held by a third
        return "double", [0.0 if i % 3 == 0 else i / N if i % 2 else 1000.0 * i / N for i in range(N)]
    if kind == "decimal":
        return "decimal(20,4)", [decimal.Decimal(i * 37 % 1009) / 8 for i in range(N)]
    return "date", [datetime.date(2020, 1, 1) + datetime.timedelta(days=i * 31 % 997) for i in range(N)]


def _table(spark, kind):
    """One group with all but 60 rows, two small ones, one of them without a name; nulls in each."""
    sql, values = _values(kind)
    rows = [("hot", i, None if i % 97 == 0 else v) for i, v in enumerate(values)]
    rows += [(g, N + i, values[i]) for i, g in enumerate(["cold"] * 40 + [None] * 19)] + [("lone", N + 99, None)]
    return spark.createDataFrame(rows, f"g string, i int, v {sql}").repartition(4).cache()


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("kind", ["text", "skewed", "decimal", "date"])
def test_positions_by_any_type(spark, kind):
    df = _table(spark, kind)
    counts = df.groupBy("g", "v").agg(F.count("*").alias("c"))
    for descending in (False, True):
        order = F.col("v").desc_nulls_last() if descending else F.col("v").asc_nulls_first()
        w = Window.partitionBy("g").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        ref = counts.select("g", "v", "c", F.coalesce(F.sum("c").over(w), F.lit(0)).alias("b"), F.sum("c").over(Window.partitionBy("g")).alias("t"))
        got = W.value_positions(df, ["g"], "v", descending, slice_rows=500)
        assert _rows(got) == _rows(ref)


def test_lag_by_text_in_many_tasks(spark):
    df = _table(spark, "text").where("v is not null")
    ref = df.withColumn("p", F.lag("i").over(Window.partitionBy("g").orderBy("v")))
    got = W.lag_within(df, ["g"], ["v"], "i", "p", slice_rows=500)
    assert _rows(got.select(*ref.columns)) == _rows(ref)
    every = df.withColumn("p", F.lag("i").over(Window.partitionBy(F.lit(0)).orderBy("v", "i")))
    got = W.lag_within(df, [], ["v", "i"], "i", "p", slice_rows=500)
    assert _rows(got.select(*every.columns)) == _rows(every)


@pytest.mark.parametrize("kind", ["text", "skewed"])
def test_a_hot_group_spreads_evenly(spark, kind):
    df = _table(spark, kind).where("g = 'hot'").select("g", "v").distinct()
    rows, slices = slice_count(df, 300)
    assert slices == 8  # more are needed, there are no more shuffle partitions
    per = [r["count"] for r in with_slices(df, ["g", "v"], "s", rows, slices).groupBy("s").count().collect()]
    assert len(per) == 8 and max(per) < 2 * rows / slices


def test_slices_do_not_depend_on_how_rows_lie(spark):
    df = _table(spark, "text")
    cut = [_rows(with_slices(d, ["g", "v"], "s", df.count(), 8)) for d in (df, df.repartition(7, "i"), df.orderBy(F.desc("i")))]
    assert cut[0] == cut[1] == cut[2]


def test_large_input_takes_no_join_for_offsets(spark):
    plan = W.value_positions(_table(spark, "skewed"), ["g"], "v", slice_rows=500)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan
    few = W.rank_within(_table(spark, "skewed"), ["g"], "v")._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in few and "Aggregate" not in few


def test_exact_quantiles_of_a_skewed_column(spark):
    df = _table(spark, "skewed")
    got = {r.g: r for r in A.quantiles(df, "v", [0.0, 0.25, 0.5, 0.99], ["g"], ["a", "b", "c", "d"], slice_rows=300).collect()}
    values = np.array([r.v for r in df.where("g = 'hot' and v is not null").collect()])
    assert np.allclose([got["hot"][n] for n in "abcd"], np.quantile(values, [0.0, 0.25, 0.5, 0.99]))
    assert set(got) == {"hot", "cold", None}  # a group of nulls alone has no quantiles


def test_empty_table(spark):
    df = _table(spark, "text").where("false")
    assert W.rank_within(df, ["g"], "v").count() == 0 and W.lag_within(df, ["g"], ["v"], "i", "p").count() == 0
    assert with_slices(df, ["g", "v"], "s", 0, 8).count() == 0


def test_sketches_of_days_merge_to_the_sketch_of_all(spark):
    values = np.random.default_rng(5).normal(size=20000)
    df = spark.createDataFrame([("a" if i % 4 else "b", i % 7, float(v)) for i, v in enumerate(values)], "g string, dia int, v double")
    stored = A.quantile_sketches(df.unionByName(spark.createDataFrame([("c", 0, None)], df.schema)), "v", ["g", "dia"])
    for kept in ([0, 1, 2, 3, 4, 5, 6], [0, 2, 5]):  # all days, and some of them taken away
        merged = A.merge_sketches(stored.where(F.col("dia").isin(kept)), ["g"])
        got = {r.g: r for r in A.sketch_quantiles(merged, [0.1, 0.5, 0.9]).collect()}
        assert got["c"].n == 0 and got["c"].q50 is None
        for g in "ab":
            own = np.array([v for i, v in enumerate(values) if (i % 4 == 0) == (g == "b") and i % 7 in kept])
            assert got[g].n == len(own)
            assert all(abs((own <= got[g][f"q{int(100 * p)}"]).mean() - p) < 0.02 for p in (0.1, 0.5, 0.9))


def test_describe_reads_its_input_once(spark):
    df = _table(spark, "skewed")
    once = A.describe(df, "v", ["g"])
    plan = once._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Aggregate") == 1 and "Join" not in plan and "Union" not in plan
    assert _rows(once) == _rows(A.describe(df, "v", ["g"], slice_rows=300))
