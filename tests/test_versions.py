"""K1: tables are replaced atomically, readers resolve commits."""

import pytest
from pyspark.sql import functions as F

from letramento.sources.io import read_layer, read_optional, write_layer
from letramento.sources.versions import (ConcurrentWrite, commit_numbers, current_version, publish, read_commit, read_version,
                                         remove_old_versions)


def rows(spark, *values):
    return spark.createDataFrame(values, "ano int, uf string, x string")


def got(df):
    return sorted(tuple(r) for r in df.select("ano", "uf", "x").collect())


def failing(spark, df):
    """``df`` with many rows before one whose task fails."""
    more = spark.range(0, 2000, 1, 4).select((F.lit(2023) + F.col("id") % 2).cast("int").alias("ano"), F.lit("SP").alias("uf"), F.when(
        F.col("id") == 1999, F.raise_error(F.lit("lost"))).otherwise(F.lit("new")).alias("x"))
    return df.unionByName(more)


@pytest.mark.parametrize("replace", [None, [2023, 2024]])
def test_a_write_that_fails_leaves_the_table_readable(spark, tmp_root, replace):
    first = [(2022, "SP", "a"), (2023, "SP", "b"), (2024, "RJ", "c")]
    write_layer(rows(spark, *first), tmp_root, "t", ["ano"])
    with pytest.raises(Exception, match="lost"):
        write_layer(failing(spark, rows(spark, *first)), tmp_root, "t", ["ano"], replace=replace)
    assert got(read_layer(spark, tmp_root, "t")) == first and commit_numbers(spark, f"{tmp_root}/t") == [1]
    write_layer(rows(spark, (2023, "MG", "d")), tmp_root, "t", ["ano"], replace=[2023])
    assert got(read_layer(spark, tmp_root, "t")) == [(2022, "SP", "a"), (2023, "MG", "d"), (2024, "RJ", "c")]


def test_a_reader_keeps_to_its_commit(spark, tmp_root):
    write_layer(rows(spark, (2023, "SP", "old"), (2024, "SP", "old")), tmp_root, "t", ["ano", "uf"])
    reader = read_layer(spark, tmp_root, "t")
    write_layer(rows(spark, (2023, "SP", "new")), tmp_root, "t", ["ano", "uf"])
    assert got(reader) == [(2023, "SP", "old"), (2024, "SP", "old")]
    assert got(read_layer(spark, tmp_root, "t")) == [(2023, "SP", "new")]


def test_only_touched_partitions_are_rewritten(spark, tmp_root):
    path = write_layer(rows(spark, (2023, "SP", "a"), (2023, "RJ", "b"), (2024, "SP", "c"), (2024, None, "d")), tmp_root, "t", ["ano", "uf"])
    before = current_version(spark, path)
    write_layer(rows(spark, (2023, "RJ", "new"), (2025, "a/b=c", "e")), tmp_root, "t", ["ano", "uf"], replace=[(2023, "RJ"), (2024, "SP")])
    after = current_version(spark, path)
    assert after.changed_since(before) == {"ano=2023/uf=RJ", "ano=2024/uf=SP", "ano=2025/uf=a%2Fb%3Dc"}
    assert got(read_layer(spark, tmp_root, "t").na.fill("?")) == [(2023, "RJ", "new"), (2023, "SP", "a"), (2024, "?", "d"), (2025, "a/b=c", "e")]
    plan = read_layer(spark, tmp_root, "t").where("ano = 2023")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ano" in plan
    files = [f for f in read_layer(spark, tmp_root, "t").where("ano = 2023").inputFiles()]
    assert len(files) >= 2


def test_append_adds_and_empty_tables_keep_their_schema(spark, tmp_root):
    write_layer(rows(spark, (2023, "SP", "a")), tmp_root, "t", ["ano"])
    write_layer(rows(spark, (2023, "SP", "b"), (2024, "SP", "c")), tmp_root, "t", ["ano"], mode="append")
    assert got(read_layer(spark, tmp_root, "t")) == [(2023, "SP", "a"), (2023, "SP", "b"), (2024, "SP", "c")]
    write_layer(rows(spark, (1, "", "")).where("false"), tmp_root, "t", ["ano"])
    empty = read_layer(spark, tmp_root, "t")
    assert empty.count() == 0 and dict(empty.dtypes) == {"uf": "string", "x": "string", "ano": "int"}
    write_layer(rows(spark, (1, "a", "b")), tmp_root, "whole")
    assert got(read_layer(spark, tmp_root, "whole")) == [(1, "a", "b")]
    assert read_optional(spark, tmp_root, "absent") is None


def test_writers_of_different_partitions_both_win_and_of_the_same_one_do_not(spark, tmp_root):
    path = write_layer(rows(spark, (2023, "SP", "a"), (2024, "SP", "b")), tmp_root, "t", ["ano"])
    base = current_version(spark, path)
    write_layer(rows(spark, (2023, "SP", "a2")), tmp_root, "t", ["ano"], replace=[2023])
    write_layer(rows(spark, (2024, "SP", "b2")), tmp_root, "t", ["ano"], replace=[2024], base=base)  # computed before, elsewhere
    assert got(read_layer(spark, tmp_root, "t")) == [(2023, "SP", "a2"), (2024, "SP", "b2")]
    with pytest.raises(ConcurrentWrite):
        write_layer(rows(spark, (2023, "SP", "stale")), tmp_root, "t", ["ano"], replace=[2023], base=base)
    assert got(read_layer(spark, tmp_root, "t")) == [(2023, "SP", "a2"), (2024, "SP", "b2")]


def test_the_same_commit_number_is_taken_once(spark, tmp_root):
    from letramento.sources import versions
    path = write_layer(rows(spark, (2023, "SP", "a")), tmp_root, "t", ["ano"])
    taken = current_version(spark, path)
    assert not versions._commit(spark, path, taken)
    assert commit_numbers(spark, path) == [1]


def test_old_files_go_only_when_no_kept_commit_names_them(spark, tmp_root):
    path = f"{tmp_root}/t"
    for k in range(4):
        publish(rows(spark, (2023, "SP", f"v{k}"), *([(2022, "SP", "stays")] if k == 0 else [])), path, ["ano"],
                replaces=None if k == 0 else lambda v: v["ano"] == "2023", notes={"k": k})
    assert remove_old_versions(spark, path, keep=2, hours=1) == []  # too young
    assert len(remove_old_versions(spark, path, keep=2, hours=0)) == 1  # v1; v0's folder still holds 2022
    assert commit_numbers(spark, path) == [3, 4]
    assert got(read_version(spark, path, read_commit(spark, path, 3))) == [(2022, "SP", "stays"), (2023, "SP", "v2")]
    assert got(read_layer(spark, tmp_root, "t")) == [(2022, "SP", "stays"), (2023, "SP", "v3")] and current_version(spark, path).notes == {"k": 3}
