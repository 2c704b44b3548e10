"""Property tests: the skew-safe operators equal their plain Spark / numpy counterparts."""

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from letramento.operators import aggregates as A
from letramento.operators import windows as W

SETTINGS = settings(max_examples=4, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.integers(0, 400),
                          st.one_of(st.none(), st.integers(-5, 5).map(float))), min_size=1, max_size=120)


@SETTINGS
@given(data=rows, slice_rows=st.integers(1, 40), descending=st.booleans())
def test_rank_equals_window(spark, data, slice_rows, descending):
    df = spark.createDataFrame([(g, i, v) for i, (g, _, v) in enumerate(data)], "g string, i int, v double")
    order = F.col("v").desc() if descending else F.col("v").asc()
    w = Window.partitionBy("g").orderBy(order)
    ref = df.select("i", F.rank().over(w).alias("r"), F.round(F.percent_rank().over(w) * 100, 2).alias("p"))
    got = W.rank_within(df, ["g"], "v", descending=descending, slice_rows=slice_rows)
    assert _rows(ref) == _rows(got.select("i", F.col("ranking").alias("r"), F.col("percentil").alias("p")))


@SETTINGS
@given(data=rows, slice_rows=st.integers(1, 40))
def test_lag_equals_window(spark, data, slice_rows):
    df = spark.createDataFrame([(g, i, v) for i, (g, _, v) in enumerate(data)], "g string, i int, v double")
    ref = df.withColumn("prev", F.lag("v").over(Window.partitionBy("g").orderBy("i")))
    got = W.lag_within(df, ["g"], ["i"], "v", "prev", slice_rows=slice_rows)
    assert _rows(ref) == _rows(got.select(*ref.columns))


@SETTINGS
@given(values=st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=200),
       probs=st.lists(st.floats(0, 1), min_size=1, max_size=4), slice_rows=st.integers(1, 50))
def test_quantiles_equal_numpy(spark, values, probs, slice_rows):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    names = [f"q{i}" for i in range(len(probs))]
    got = A.quantiles(df, "v", probs, names=names, slice_rows=slice_rows).first()
    assert np.allclose([got[n] for n in names], np.quantile(np.array(values), probs), rtol=1e-9, atol=1e-6)


@SETTINGS
@given(values=st.lists(st.one_of(st.none(), st.floats(-100, 100, allow_nan=False)), min_size=1, max_size=200),
       bins=st.integers(1, 30))
def test_histogram_bins_sum_to_non_null_count(spark, values, bins):
    df = spark.createDataFrame([(v,) for v in values], "v double")
    h = A.histogram(df, "v", bins).collect()
    assert sum(r.n for r in h) == sum(v is not None for v in values)
    assert all(1 <= r.bin <= bins for r in h)
