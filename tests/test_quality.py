"""Quality rules: each negative row fails exactly its own rule."""

from pyspark.sql import functions as F

from letramento.operators import quality as Q


def statuses(df):
    return {(r.tabela, r.regra): (r.status, r.detalhe) for r in df.collect()}


def test_unique_rule(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "b")], "k int, v string")
    r = Q.check_unique(df, "t", ["k", "v"]).first()
    assert (r.status, r.detalhe) == ("FALHOU", "(3 total, 2 distintos)")


def test_monotonic_and_sum_rules(spark):
    df = spark.createDataFrame([(50.0, 60.0, 55.0)], "a double, b double, c double")
    res = statuses(Q.run_checks(df, "t", Q.check_monotonic(["a", "b", "c"])))
    assert [v[0] for v in res.values()].count("FALHOU") == 1
    sums = spark.createDataFrame([(100.0, 0.0), (100.0, 2.0), (100.0, 2.1), (None, 1.0)], "l0 double, l1 double")
    r = Q.run_checks(sums, "t", [Q.check_sum(["l0", "l1"])]).first()
    assert (r.status, r.detalhe) == ("FALHOU", "(1 fora)")
    empty = spark.createDataFrame([(None, 1.0)], "l0 double, l1 double")
    r = Q.run_checks(empty, "t", [Q.check_sum(["l0", "l1"])]).first()
    assert (r.status, r.detalhe) == ("PASSOU", "(sem dados)")


def test_key_mismatch_both_sides(spark):
    a = spark.createDataFrame([("SP",), ("RJ",)], "uf string")
    b = spark.createDataFrame([("SP",), ("MG",)], "uf string")
    got = sorted(tuple(r) for r in Q.key_mismatch(a, b, "uf").collect())
    assert got == [("MG", "direita"), ("RJ", "esquerda")]
    swapped = sorted(tuple(r) for r in Q.key_mismatch(b, a, "uf").collect())
    assert swapped == [("MG", "esquerda"), ("RJ", "direita")]
    assert Q.check_keys_match(a, b, "t", "uf").first().status == "FALHOU"


def test_negative_set_fails_exactly_its_rule(spark):
    good = [(2024, "SP", "Publica", 50.0, 50.0, 60.0, 400.0, 100.0)]
    cases = {
        "null": (2024, None, "Publica", 50.0, 50.0, 60.0, 400.0, 100.0),
        "rate": (2024, "RJ", "Publica", 101.0, 50.0, 60.0, 400.0, 100.0),
        "score": (2024, "MG", "Publica", 50.0, 50.0, 60.0, 399.0, 100.0),
        "target": (2024, "BA", "Publica", 50.0, 70.0, 60.0, 400.0, 100.0),
        "levels": (2024, "PE", "Publica", 50.0, 50.0, 60.0, 400.0, 90.0),
    }
    rule_of = {"null": "ano/uf/rede não nulos", "rate": "taxa em [0, 100]", "score": "nota em [400, 1000]",
               "target": "m1 <= m2", "levels": "soma de l0.. = 100 ± 2"}
    schema = "ano int, uf string, rede string, taxa double, m1 double, m2 double, nota double, l0 double"
    rules = [Q.check_not_null(["ano", "uf", "rede"]), Q.check_range("taxa", 0, 100), Q.check_range("nota", 400, 1000),
             *Q.check_monotonic(["m1", "m2"]), Q.check_sum(["l0"])]
    for name, row in cases.items():
        res = statuses(Q.run_checks(spark.createDataFrame(good + [row], schema), "t", rules))
        failed = [regra for (_, regra), (st, _) in res.items() if st == "FALHOU"]
        assert failed == [rule_of[name]], (name, failed)
    dup = spark.createDataFrame(good + good, schema)
    assert Q.check_unique(dup, "t", ["ano", "uf", "rede"]).first().status == "FALHOU"


def test_report_and_assert(spark):
    res = spark.createDataFrame([("a", "r1", "PASSOU", ""), ("b", "r2", "FALHOU", "(1 fora)")],
                                "tabela string, regra string, status string, detalhe string")
    r = Q.quality_report(res).first()
    assert (r.total_regras, r.passou, r.falhou, r.regras_falhas, r.pct_passou) == (2, 1, 1, ["b — r2"], 50.0)
    try:
        Q.assert_quality(res)
        raise AssertionError("expected failure")
    except AssertionError as exc:
        assert "r2" in str(exc)


def test_reject_counts_first_rule_wins(spark):
    df = spark.createDataFrame([(None, 500.0), (1, 500.0), (1, 5.0)], "k int, v double")
    rules = [("chave_nula", F.col("k").isNull()), ("fora", ~F.col("v").between(0, 100))]
    got = {r.motivo: r.registros for r in Q.reject_counts(df, rules).collect()}
    assert got == {"chave_nula": 1, "fora": 1, "ok": 1}
