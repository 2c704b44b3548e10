"""Hand-worked cases for the column functions (FIXTURES.md §3)."""

import pytest

from letramento.functions import dims
from letramento.functions import measures as M
from letramento.functions.numeric import round_half_even, round_half_up, safe_double, safe_int, safe_string


def one(spark, rows, schema, expr):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_rounding_is_decimal_half_up(spark):
    assert one(spark, [(1.005,), (-1.005,), (2.675,)], "x double", round_half_up("x", 2)) == [1.01, -1.01, 2.68]
    assert one(spark, [(12.25,), (12.35,)], "x double", round_half_even("x", 1)) == [12.2, 12.4]


def test_gap_attainment_reached(spark):
    df = spark.createDataFrame([(50.0, 80.0), (70.0, 0.0), (None, 80.0)], "t double, m double")
    r = df.select(M.gap("m", "t").alias("g"), M.attainment("t", "m").alias("a"), M.reached("t", "m").alias("r")).collect()
    assert [x.g for x in r] == [30.0, -70.0, None]
    assert [x.a for x in r] == [62.5, None, None]          # C2: target 0 -> null, no error
    assert [x.r for x in r] == [0, 1, 0]                     # C3: null -> 0


def test_criticality_classes(spark):
    got = one(spark, [(g,) for g in [60.0, 40.0, 25.0, 10.0, 9.99, -5.0]], "g double", M.criticality("g"))
    assert got == ["Crítico", "Muito Alto", "Alto", "Moderado", "Baixo", "Baixo"]


def test_rate_band(spark):
    assert one(spark, [(49.9,), (50.0,), (79.99,), (80.0,), (None,)], "t double", M.rate_band("t")) == \
        ["<50", "50-65", "65-80", ">=80", None]


@pytest.mark.parametrize("prev,rate,change,years,proj,status,reached_first", [
    (50.0, 55.1, 5.1, 4.9, 2028, "Sim", "Sim"),
    (80.0, 85.31, 5.31, -1.0, None, "Sem dados", "Já atingiu"),
    (63.0, 60.0, -3.0, None, None, "Sem dados", "Não no ritmo atual"),
])
def test_projection_chain(spark, prev, rate, change, years, proj, status, reached_first):
    df = spark.createDataFrame([(2024, rate, prev, 80.0)], "ano int, t double, p double, m double")
    df = df.withColumn("c", M.yearly_change("t", "p")).withColumn("y", M.years_to_target("t", "m", "c"))
    df = df.withColumn("j", M.projected_year("ano", "y"))
    df = df.withColumn("s", M.projection_status("t", "m", "j")) \
           .withColumn("s2", M.projection_status("t", "m", "j", "c", status_order="reached_first"))
    r = df.collect()[0]
    assert (r.c, r.j, r.s, r.s2) == (change, proj, status, reached_first)
    if years is not None:
        assert r.y == years or (years < 0 and r.y is None)


def test_projected_year_truncates(spark):
    assert one(spark, [(2024, 5.9)], "a int, y double", M.projected_year("a", "y")) == [2029]


def test_literate_flag(spark):
    assert one(spark, [(743.0,), (742.99,), (None,)], "s double", M.literate_flag("s")) == [1, 0, None]


def test_safe_int_and_double(spark):
    vals = [" 12 ", "3.7", "-0.9", "1e3", "nan", "inf", "1.0d", "abc", "", None]
    assert one(spark, [(v,) for v in vals], "v string", safe_int("v")) == [12, 3, 0, 1000] + [None] * 6
    assert one(spark, [(v,) for v in vals], "v string", safe_double("v"))[:4] == [12.0, 3.7, -0.9, 1000.0]


def test_safe_string(spark):
    vals = ["None", "none", "NaN", "  ", " x ", None]
    assert one(spark, [(v,) for v in vals], "v string", safe_string("v")) == [None, "none", None, None, " x ", None]


def test_lookups(spark):
    df = spark.createDataFrame([(3550308,), (9900000,)], "id int")
    df = df.withColumn("co", dims.state_prefix("id")).withColumn("uf", dims.uf_from_code("co"))
    df = df.withColumn("reg", dims.region_from_uf("uf"))
    assert [tuple(r) for r in df.collect()] == [(3550308, 35, "SP", "Sudeste"), (9900000, 99, None, None)]
    assert len(dims.UF_TABLE) == 27 and len({r for _, _, r in dims.UF_TABLE}) == 5
