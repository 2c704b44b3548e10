"""Importance resampling against a direct evaluation, and its sort by regular sampling on its own."""

import hashlib
import math
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from letramento.llm import resampling
from letramento.llm.common import materialize, read_table

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
CLASHES = ("id", "t", "row", "features", "words", "rank", "score", "weight", "n_features", "run", "pos", "up", "tie", "few", "segment", "bucket", "heap", "size")


def features(text, most=1, buckets=10000):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    own = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)
    runs = [" ".join(own[i:i + n]) for n in range(1, most + 1) for i in range(len(own) - n + 1)]
    return len(own), [zlib.crc32(x.encode()) % buckets for x in runs]


def brute(rows, targets, most=1, buckets=10000, min_words=20, percent=10):
    found = [(i, *features(t, most, buckets)) for i, t in rows]
    s, t = np.zeros(buckets), np.zeros(buckets)
    for *_, x in found:
        np.add.at(s, x, 1)
    for text in targets:
        np.add.at(t, features(text, most, buckets)[1], 1)
    gain = [math.floor(1000 * math.log((b + 1) * (s.sum() + buckets) / ((a + 1) * (t.sum() + buckets)))) for a, b in zip(s, t)]
    out = []
    for i, n, x in found:
        h = int(hashlib.sha256(f"2024:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[k] for k in x)
        out.append([i, n, len(x), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))])
    fit = sorted((r for r in out if r[1] >= min_words), key=lambda r: (-r[4], r[0] is None, r[0] or 0, -r[2]))
    rank = {id(r): k + 1 for k, r in enumerate(fit[:percent * len(fit) // 100])}
    return sorted(((r[0], *r[2:], rank.get(id(r))) for r in out), key=str)


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


@pytest.mark.parametrize("most, buckets", [(1, 10000), (2, 100_000)])
def test_resampling_equals_brute_force(spark, most, buckets):
    docs, target = read_table(spark, "/root/testdata/sf0.01", "documents"), read_table(spark, SF, "benchmark")
    got = resampling.resample(docs.repartition(5), target, most, buckets, with_rows=False)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows_of(docs), [r.text for r in target.collect()], most, buckets)


def test_resampling_odd_rows(spark):
    many = " ".join(f"W{i % 50} é" for i in range(30))
    long = "word Word2 " * 100_000
    rows = [(1, many, "en", "s", 1), (1, many, "en", "s", 1), (2, many + " x", "en", None, 1), (None, many, None, "s", 1), (3, None, None, None, None),
            (4, "", "fr", "s", 0), (5, "\x00!{", "fr", "s", 0), (6, long, "de", "s", 1), (None, None, None, None, None), (7, "ÀÉİ KK", "en", "s", 1)]
    odd = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit(None if i % 2 else c) for i, c in enumerate(CLASHES)})
    target = spark.createDataFrame([(1, "w1 word"), (2, None)], "item_id long, text string")
    got = resampling.resample(odd, target, percent=60)
    drawn = got.where("rank is not null")
    assert sorted((tuple(r)[:5] for r in got.collect()), key=str) == brute(rows_of(odd), ["w1 word", None], percent=60)
    assert drawn.count() == 3 and set(drawn.select("row.*").columns) == set(odd.columns)
    assert all(r.row.doc_id == r.doc_id and r.row.text for r in drawn.collect())
    assert resampling.resample(odd.where("false"), target).count() == 0
    assert {r.weight for r in resampling.resample(odd, target.where("false"), with_rows=False).where("doc_id = 4").collect()} == {0}


@pytest.mark.parametrize("kind", ["spread", "ties", "one key", "sorted", "few"])
def test_ranks_by_regular_sampling(spark, monkeypatch, kind):
    monkeypatch.setattr(resampling, "MERGE", 3)
    n = {"few": 5}.get(kind, 6000)
    score = {"spread": F.xxhash64("id") % 100_000, "ties": F.col("id") % 3, "one key": F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")), "sorted": -F.col("id"),
             "few": F.col("id")}[kind].cast("long")
    ids = F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("long") if kind == "one key" else F.col("id")
    rows = spark.range(n, numPartitions=11).select(ids.alias("id"), score.alias("score"), F.lit(1).cast("long").alias("n_features"))
    table = materialize(rows if kind == "sorted" else rows.repartition(11), "sort-test")
    largest = []
    real = resampling._segmented

    def watched(splitters, schema):
        run = real(splitters, schema)
        if not largest:
            largest.append(max(r[1] for r in spark.read.parquet(runs_path[0]).mapInArrow(run, schema).groupBy("segment").count().collect()))
        return run

    runs_path, stored = [], resampling.materialize

    def noted(df, name, *codec):
        out = stored(df, name, *codec)
        if name == "sorted-runs":
            runs_path.append(out.inputFiles()[0].rsplit("/", 1)[0])
        return out

    monkeypatch.setattr(resampling, "_segmented", watched)
    monkeypatch.setattr(resampling, "materialize", noted)
    got = resampling.regular_sampling_ranks(table, lambda k: k, segment_rows=500).collect()
    want = sorted(((-r.score, r.id) for r in table.collect()))
    assert [(-r.score, r.id) for r in sorted(got, key=lambda r: r["rank"])] == want and sorted(r["rank"] for r in got) == list(range(1, n + 1))
    assert n < 100 or largest[0] <= 2 * n / 12
    part = resampling.regular_sampling_ranks(table, lambda k: k // 3).where("rank is not null").collect()
    assert sorted((r["rank"], -r.score, r.id) for r in part) == [(k + 1, *x) for k, x in enumerate(want[:n // 3])]
