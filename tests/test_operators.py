"""Operators: cleaning, windows, aggregates (FIXTURES.md §3 and properties)."""

import math

import numpy as np
from pyspark.sql import Window
from pyspark.sql import functions as F

from letramento.functions import dims
from letramento.operators import aggregates as A
from letramento.operators import clean as C
from letramento.operators import windows as W
from letramento.operators.slices import slice_count, with_slices
from letramento.plans.silver import silver_meta_uf


def test_canonicalise_by_name_and_code(spark):
    df = spark.createDataFrame([(" pública ",), ("MUNICIPAL",), (" Outra ",)], "rede string")
    assert [r.rede for r in C.canonicalise_by_name(df, "rede", dims.REDE_BY_NAME).collect()] == \
        ["Publica", "Municipal", "Outra"]
    ints = spark.createDataFrame([(2,), (9,)], "rede int")
    assert [r.rede for r in C.canonicalise_by_code(ints, "rede", dims.REDE_BY_CODE).collect()] == ["Estadual", "9"]
    s = spark.createDataFrame([("0",)], "rede string")
    assert C.canonicalise_by_code(s, "rede", dims.REDE_BY_CODE).first().rede == "Total"


def test_range_and_set_filters(spark):
    df = spark.createDataFrame([(-0.1,), (0.0,), (100.0,), (100.1,), (None,)], "v double")
    assert [r.v for r in C.in_range(df, "v", 0, 100).collect()] == [0.0, 100.0, None]
    df = spark.createDataFrame([(1,), (4,), (5,), (None,)], "v int")
    assert [r.v for r in C.in_set(df, "v", [1, 2, 3, 4]).collect()] == [1, 4]


def test_dedup_after_range_filter(spark):
    raw = spark.createDataFrame([("2024", " sp ", "publica", "50", "2024-01-01"),
                                 ("2024", "SP", "PUBLICA", "150", "2024-01-02")],
                                "ano string, sigla_uf string, rede string, taxa_alfabetizacao string, d string")
    raw = raw.withColumn("_timestamp_ingestao", F.to_timestamp("d")).drop("d")
    out = silver_meta_uf(raw).collect()
    assert len(out) == 1 and out[0].taxa_alfabetizacao == 50.0 and out[0].sigla_uf == "SP"


def test_dedup_is_deterministic_and_idempotent(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (1, 2, "c"), (2, 1, "z")], "k int, t int, v string")
    once = C.dedup(df, ["k"], ["t"])
    assert sorted(tuple(r) for r in once.collect()) == [(1, 2, "c"), (2, 1, "z")]
    assert sorted(once.collect()) == sorted(C.dedup(once, ["k"], ["t"]).collect())


def test_rank_ties_and_percentile(spark):
    df = spark.createDataFrame([("g", 9.0), ("g", 9.0), ("g", 5.0), ("g", 1.0)], "g string, t double")
    r = W.rank_within(df, ["g"], "t").orderBy(F.desc("t"), "ranking").collect()
    assert [x.ranking for x in r] == [1, 1, 3, 4]
    assert [x.percentil for x in r] == [0.0, 0.0, 66.67, 100.0]


def test_rank_and_lag_match_window_on_a_hot_group(spark):
    # one group holds most rows, so it spans several range slices
    rows = [("hot", i, float((i * 37) % 101)) for i in range(3000)] + [("cold", i, float(i % 7)) for i in range(40)]
    df = spark.createDataFrame(rows, "g string, ano int, t double").repartition(4)
    w = Window.partitionBy("g").orderBy(F.desc("t"))
    ref = df.withColumn("r", F.rank().over(w)).withColumn("p", F.round(F.percent_rank().over(w) * 100, 2))
    got = W.rank_within(df, ["g"], "t", slice_rows=100)
    a = sorted((x.g, x.ano, x.r, x.p) for x in ref.collect())
    b = sorted((x.g, x.ano, x.ranking, x.percentil) for x in got.collect())
    assert a == b
    tagged = with_slices(df, ["g", "ano"], "_slice", *slice_count(df, slice_rows=100))
    per = {r.g: r.n for r in tagged.groupBy("g").agg(F.countDistinct("_slice").alias("n")).collect()}
    assert per["hot"] > 4 and per["cold"] <= 2          # the hot group is split, the small one meets one splitter at most
    lw = Window.partitionBy("g").orderBy("ano")
    ref = df.withColumn("prev", F.lag("t").over(lw))
    got = W.lag_within(df, ["g"], ["ano"], "t", "prev", slice_rows=100)
    assert sorted(tuple(x) for x in ref.collect()) == sorted(tuple(x) for x in got.select(*ref.columns).collect())


def test_quantiles_and_describe(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (4.0,), (10.0,)], "v double")
    d = A.describe(df, "v").first()
    assert (d.q1, d.mediana, d.q3) == (1.75, 3.0, 5.5)
    assert math.isclose(d.desvio_padrao, 4.031129, abs_tol=1e-6) and d.n == 4
    vals = np.random.default_rng(7).normal(size=2001)
    g = spark.createDataFrame([("a" if i % 3 else "b", float(x)) for i, x in enumerate(vals)], "g string, v double")
    got = {r.g: r for r in A.quantiles(g, "v", [0.1, 0.5, 0.9], ["g"], ["a", "b", "c"], slice_rows=50).collect()}
    for key, mask in (("a", np.arange(2001) % 3 != 0), ("b", np.arange(2001) % 3 == 0)):
        exp = np.quantile(vals[mask], [0.1, 0.5, 0.9])
        assert np.allclose([got[key].a, got[key].b, got[key].c], exp, atol=1e-12)


def test_corr_and_histogram(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 1.0), (4.0, 5.0), (10.0, None)], "x double, y double")
    assert A.corr_matrix(df, ["x", "y"]).first().correlacao == 0.838628
    h = A.histogram(spark.createDataFrame([(1.0,), (4.0,), (10.0,)], "v double"), "v", 3)
    assert sorted((r.bin, r.n) for r in h.collect()) == [(1, 1), (2, 1), (3, 1)]


def test_student_indicators_rate(spark):
    df = spark.createDataFrame([(1, 1, 800.0), (1, 0, 700.0), (1, None, None), (0, 1, 900.0)],
                               "in_presenca_lp int, in_alfabetizado int, vl_proficiencia_lp double")
    r = A.student_indicators(df.withColumn("k", F.lit(1)), ["k"]).first()
    assert (r.total_alunos_avaliados, r.total_alfabetizados, r.taxa_alfabetizacao) == (3, 1, 33.33)


def test_label_counts_and_crosstab_partition_rows(spark):
    df = spark.createDataFrame([("N", "Alto"), ("N", "Baixo"), ("S", "Alto"), (None, "Alto")], "r string, c string")
    lc = A.label_counts(df, "c", ["Crítico", "Alto", "Baixo"]).collect()
    assert sum(x.n for x in lc) == 4 and {x.c: x.ordem for x in lc} == {"Alto": 2, "Baixo": 3}
    ct = {x.r: (x["Crítico"], x.Alto, x.Baixo) for x in A.crosstab(df, "r", "c", ["Crítico", "Alto", "Baixo"]).collect()}
    assert ct == {"N": (0, 1, 1), "S": (0, 1, 0)}


def test_ordered_slice(spark):
    df = spark.createDataFrame([(1, 5), (2, 1), (1, 9), (1, 2)], "ano int, v int")
    assert [r.v for r in W.ordered_slice(df, F.col("ano") == 1, [F.col("v").desc()]).collect()] == [9, 5, 2]


def test_slice_with_fallback(spark):
    df = spark.createDataFrame([(2023, 1), (2024, 2)], "ano int, v int")
    assert [r.v for r in C.slice_with_fallback(df, "ano", 2024, 2023).collect()] == [2]
    assert [r.v for r in C.slice_with_fallback(df, "ano", 2030, 2023).collect()] == [1]


def test_weighted_options(spark):
    df = spark.createDataFrame([(1, 1, 800.0, 3.0), (1, 0, 600.0, 1.0), (0, 1, 900.0, 5.0)],
                               "in_presenca_lp int, in_alfabetizado int, vl_proficiencia_lp double, w double")
    r = A.student_indicators(df.withColumn("k", F.lit(1)), ["k"], weight="w").first()
    assert (r.total_alunos_avaliados, r.media_proficiencia, r.taxa_alfabetizacao) == (2, 750.0, 75.0)
    reg = spark.createDataFrame([("N", 10.0, 50.0, 1.0), ("N", 40.0, 60.0, 2.0)], "r string, t double, m double, w double")
    plain = A.regional_inequality(reg, ["r"], "t", "m").first()
    weighted = A.regional_inequality(reg, ["r"], "t", "m", weight="w").first()
    assert (plain.media_taxa_alfabetizacao, weighted.media_taxa_alfabetizacao) == (25.0, 30.0)


def test_trend_per_year_over_a_gap(spark):
    from letramento.plans.gold import tendencia
    df = spark.createDataFrame([(2021, "SP", "Total", 50.0, 80.0), (2023, "SP", "Total", 56.0, 80.0)],
                               "ano int, sigla_uf string, rede string, taxa_alfabetizacao double, "
                               "meta_alfabetizacao_2030 double")
    plain = {r.ano: r.variacao_anual for r in tendencia(df).collect()}
    per_year = {r.ano: r.variacao_anual for r in tendencia(df, per_year=True).collect()}
    assert plain == {2021: None, 2023: 6.0} and per_year == {2021: None, 2023: 3.0}


def test_approximate_quantiles_are_close(spark):
    vals = np.random.default_rng(3).normal(size=5000)
    df = spark.createDataFrame([(float(x),) for x in vals], "v double")
    got = A.quantiles(df, "v", [0.25, 0.5, 0.75], approx_accuracy=10000).first()
    exp = np.quantile(vals, [0.25, 0.5, 0.75])
    assert np.allclose([got.q25, got.q50, got.q75], exp, atol=0.01)
