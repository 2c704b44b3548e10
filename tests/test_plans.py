"""Physical-plan checks over every query of the catalogue (no execution needed)."""


import pytest

import __spark_entry__ as E
from letramento.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ["CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython",
             "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF"]
# these run a pipeline or a stream when called; their plans are plain file reads
SIDE_EFFECTS = {"stream_ingest", "stream_refresh", "stream_dedup", "stream_running_rate", "stream_replay", "silver_merged", "replaced_years",
                "roundtrip_layers", "silver_quality"}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if not n.startswith("gold_") and n not in SIDE_EFFECTS))
def test_plan_has_no_cross_products_or_python(spark, name):
    plan = plan_of(E.queries()[name](spark, SF))
    for node in FORBIDDEN:
        assert node not in plan, f"{name}: {node}"


def test_kpi_scan_reads_only_needed_columns(spark):
    plan = plan_of(E.queries()["criticality"](spark, SF))
    assert "o_totalprice" not in plan and "c_acctbal" not in plan
    assert "BroadcastHashJoin" in plan or "SortMergeJoin" in plan


def test_dimension_lookups_need_no_join(spark):
    plan = plan_of(E.queries()["prefix_lookup"](spark, SF))
    assert "Join" not in plan and "Exchange" not in plan


def test_stream_metrics_decodes_once(spark):
    plan = E.queries()["stream_metrics"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 1 and plan.count("try_to_binary") + plan.count("unbase64") == 1
