"""The Merkle manifest against a direct evaluation of its definition."""

import collections
import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from letramento.llm import merkle
from letramento.llm.common import read_table

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("grp", "r", "n", "id", "digest", "load", "kids", "path", "node", "block", "d0", "part", "pos", "row", "c0", "changed", "leaf", "root", "subroot")


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests):
    """Subroot and, per leaf, its (siblings before, siblings after) by level."""
    at, paths, nodes = list(range(len(digests))), [[] for _ in digests], list(digests)
    while len(nodes) > 1:
        for k, a in enumerate(at):
            run = nodes[a // 3 * 3:a // 3 * 3 + 3]
            paths[k].append((run[:a % 3], run[a % 3 + 1:]))
        nodes = [H(*nodes[i:i + 3]) for i in range(0, len(nodes), 3)]
        at = [a // 3 for a in at]
    return nodes[0], paths


def brute(rows):
    groups = collections.defaultdict(list)
    for r in rows:
        groups[r[1]].append((r, leaf(r)))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        groups[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = tree([d for _, d in groups[s]])
    if not names:
        return []
    root, upper = tree([trees[s][0] for s in names])
    out = []
    for s, top in zip(names, upper):
        for (row, own), path in zip(groups[s], trees[s][1]):
            steps = path + top
            i, text = row[0], row[4]
            cur = leaf((*row[:4], text.replace("\n", ""))) if i is not None and zlib.crc32(str(i).encode()) % 2 == 0 and text is not None else own
            for before, after in steps:
                cur = H(*before, cur, *after)
            out.append((i, own, trees[s][0], root, H(*[d for b, a in steps for d in b + a]), cur, cur == root))
    return out


def checked(df):
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = merkle.verify_manifest(df, {"text": text}, hit & (text != F.col("text")))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    return sorted(map(tuple, got.collect()), key=str)


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


def test_manifest_equals_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    got = checked(docs)
    assert got == sorted(brute(rows_of(docs)), key=str)
    assert {v for *_, v in got} == {True, False}


@pytest.mark.parametrize("sizes", [(1, 2, 3, 4, 9, 10, 27, 28, 81, 243, 244, 730), (1,), (243,)])
def test_groups_of_any_size(spark, sizes):
    rows = [(1000 * k + i, f"a\n{i}", "en", f"s{k}", 3) for k, n in enumerate(sizes) for i in range(n)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert checked(df) == sorted(brute(rows_of(df)), key=str)


def test_odd_rows(spark):
    long = "w\n" * 200_000
    rows = [(1, "a", "en", "s", 1), (1, "a", "en", "s", 1), (1, "b", "en", "s", 1), (None, "a\nb", "en", "s", 3), (None, None, None, None, None),
            (2, "", "fr", None, 0), (3, None, "fr", "", 0), (4, long, "de", "é", len(long)), (5, "x\ny", "de", "=", 3), (6, "\n", "de", "z", 1)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(None if i % 2 else c) for i, c in enumerate(CLASHES)})
    assert checked(odd) == sorted(brute(rows_of(odd)), key=str)
    assert checked(odd.where("false")) == []
    nulls = odd.where("doc_id is null and source is null")
    assert checked(nulls) == sorted(brute(rows_of(nulls)), key=str)


def test_many_groups_and_one_repeated_row(spark):
    """More groups than a block holds, and one row repeated over a third of the table."""
    df = spark.range(1200).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"),
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 700)).alias("source"), F.lit(1).cast("long").alias("n_chars"))
    assert checked(df.repartition(5)) == sorted(brute(rows_of(df)), key=str)


def test_blocks_stay_bounded_and_paths_fold(spark):
    df = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("s").alias("source"))
    got = merkle.merkle_manifest(df, ("doc_id",))
    assert got.select("root").distinct().count() == 1
    assert got.where(merkle.fold(F.col("path"), F.col("leaf")) != F.col("root")).count() == 0
    assert got.where(merkle.fold(F.col("path"), F.sha2("leaf", 256)) == F.col("root")).count() == 0
    nodes = df.select(F.lit("g").alias("grp"), F.col("doc_id").alias("r"), F.lit(2000).cast("long").alias("n"),
                      F.sha2(F.col("doc_id").cast("string"), 256).alias("digest"), F.lit("x").alias("load"))
    assert merkle._climb(nodes, 0).count() == -(-2000 // 243)
