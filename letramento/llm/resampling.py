"""Importance resampling of documents towards a target distribution.

A text's features are its runs of one to ``most`` words; a feature falls into the bucket
of its CRC-32. A bucket's gain is the logarithm of its smoothed share in the target texts
over that in the documents. A document weighs the sum of its features' gains, gets Gumbel
noise drawn from its identifier, and the highest scores are drawn (weighted sampling
without replacement, the same for every run and every layout of the table).

Each document's buckets are counted once and written as an array, so texts are read in
one pass; gains are one array of ``buckets`` numbers in each task. The exact ranks come
from parallel sorting by regular sampling: the partitions of the scored table are sorted
and written as runs; regular samples of all runs, merged in a tree of groups of ``MERGE``
runs, give splitters; counts per segment, summed in front of each, say where a segment's
ranks start; only segments that reach into the draw are exchanged, sorted by one task
each and numbered from there. Keys end with the run and the place in it, so rows with
equal scores spread over segments too. The driver holds the gains, the splitters and the
segments' counts; their number is that of the shuffle partitions, or one segment for
``SEGMENT_ROWS`` rows where that is more.

Defined results: a null text has no words; a null identifier is noise of ``<seed>:`` and
comes last among ties; rows with one identifier and score rank by features, then in any
order (their results differ in nothing else); repeated rows are drawn each; an empty table
gives an empty result, an empty target equal counts of zero.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from letramento.llm.common import as_bytes, column, materialize, short_batches, tidied

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 10
SEED = 2024
#: Rows of a segment, at least, and samples of a run per segment.
SEGMENT_ROWS = 2_000_000
SAMPLES = 4
#: Runs whose samples one task merges.
MERGE = 64
#: Sort key of a run: score downwards, identifier (null as the largest), features downwards, run, place in the run.
KEY = ("up", "tie", "few", "run", "pos")
_SPACED = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def words(text: str | None) -> list[bytes]:
    """Words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of a text with A-Z in lower case, as UTF-8."""
    return as_bytes(text).translate(_SPACED).split()


def feature_buckets(text: str | None, most: int = 1, buckets: int = BUCKETS) -> tuple[int, np.ndarray]:
    """Number of words, and the bucket of every run of one to ``most`` words, repeats kept."""
    own = words(text)
    crc = zlib.crc32
    found = [crc(w) for w in own]
    for n in range(2, most + 1):
        found += [crc(b" ".join(own[i:i + n])) for i in range(len(own) - n + 1)]
    return len(own), np.array(found, np.int64) % buckets


def _featured(most: int, buckets: int, carried: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = np.dtype("<u2" if buckets <= 1 << 16 else "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [feature_buckets(t, most, buckets) for t in column(b, "t")]
            out = {"id": b.column(b.schema.get_field_index("id")), "words": pa.array([n for n, _ in found], pa.int64()),
                   "features": pa.array([x.astype(kind).tobytes() for _, x in found], pa.binary())}
            yield pa.RecordBatch.from_pydict(out | ({"row": b.column(b.schema.get_field_index("row"))} if carried else {}))

    return run


def _counted(buckets: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """One row per bucket that a partition holds, with its count there."""
    kind = "<u2" if buckets <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            total += np.bincount(np.frombuffer(b"".join(column(b, "features")), kind), minlength=buckets)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"bucket": at.astype(np.int64), "n": total[at]})

    return run


def bucket_counts(featured: DataFrame, buckets: int) -> np.ndarray:
    """Features per bucket over a whole table; the driver receives one number per bucket."""
    out = np.zeros(buckets, np.int64)
    rows = featured.select("features").mapInArrow(_counted(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    for bucket, n in rows.collect():
        out[bucket] = n
    return out


def bucket_gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the ratio of smoothed shares, per bucket."""
    k, s, t = len(source), source.astype(float), target.astype(float)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + k) / ((s + 1) * (t.sum() + k)))).astype(np.int64)


def _weighed(gains: np.ndarray, carried: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    kind = "<u2" if len(gains) <= 1 << 16 else "<u4"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            raw = column(b, "features")
            sizes = np.array([len(x) for x in raw], np.int64) // np.dtype(kind).itemsize
            total = np.concatenate([[0], np.cumsum(gains[np.frombuffer(b"".join(raw), kind)])])
            ends = np.cumsum(sizes)
            out = {c: b.column(b.schema.get_field_index(c)) for c in ("id", "words")}
            out |= {"n_features": pa.array(sizes), "weight": pa.array((total[ends] - total[ends - sizes]).astype(np.int64))}
            yield pa.RecordBatch.from_pydict(out | ({"row": b.column(b.schema.get_field_index("row"))} if carried else {}))

    return run


def _noise(id_col: str, seed: int) -> F.Column:
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit("")))
    u = (F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long") + 0.5) / F.lit(4294967296.0)
    return F.floor(-1000 * F.log(-F.log(u))).cast("long")


def _sample(every: str, per_run: int) -> F.Column:
    """Whether the row at ``pos`` of a run of ``every`` rows is one of its regular samples."""
    step = F.greatest(F.lit(1), F.expr(f"{every} div {per_run}"))
    return F.col("pos") % step == step - 1


def _merged(per_run: int) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """Samples of several runs -> at most ``per_run`` weighted samples of all of them."""

    def run(samples: pd.DataFrame) -> pd.DataFrame:
        samples = samples.sort_values(list(KEY), kind="stable")
        upto = samples["rows"].cumsum().to_numpy()
        keep = np.unique(np.searchsorted(upto, np.linspace(0, upto[-1], min(per_run, len(samples)) + 1)[1:]).clip(max=len(samples) - 1))
        out = samples.iloc[keep].copy()
        out["rows"] = np.diff(upto[keep], prepend=0)
        out["heap"] = out["heap"] // MERGE
        return out

    return run


def _splitters(runs: DataFrame, sizes: DataFrame, number: int, segments: int) -> np.ndarray:
    """``segments - 1`` keys that cut all runs together into parts of about one size."""
    if segments < 2 or not number:
        return np.zeros((0, len(KEY)), np.int64)
    per_run = SAMPLES * segments
    found = runs.join(sizes, "run").where(_sample("size", per_run)) \
        .select(*KEY, F.greatest(F.lit(1), F.expr(f"size div {per_run}")).alias("rows"), F.expr(f"run div {MERGE}").alias("heap"))
    heaps = -(-number // MERGE)
    while True:
        found = materialize(found.groupBy("heap").applyInPandas(_merged(per_run), found.schema), "sorted-samples")
        if heaps == 1:
            break
        heaps = -(-heaps // MERGE)
    rows = found.toPandas().sort_values(list(KEY))  # at most SAMPLES samples a segment
    upto = rows["rows"].cumsum().to_numpy()
    if not len(rows):
        return np.zeros((0, len(KEY)), np.int64)
    at = np.unique(np.searchsorted(upto, upto[-1] * np.arange(1, segments) / segments).clip(max=len(rows) - 1))
    return rows[list(KEY)].to_numpy(np.int64)[at]


def _segmented(splitters: np.ndarray, added: T.StructType) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the number of splitters up to each row."""
    k = len(splitters)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = [np.concatenate([splitters[:, j], b.column(b.schema.get_field_index(c)).to_numpy()]) for j, c in enumerate(KEY)]
            splitter_first = np.arange(k + b.num_rows) >= k
            order = np.lexsort([splitter_first, *reversed(keys)])
            segment = np.empty(k + b.num_rows, np.int32)
            segment[order] = np.cumsum(order < k)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(segment[k:])], names=added.names)

    return run


def regular_sampling_ranks(rows: DataFrame, draw: Callable[[int], int], segment_rows: int = SEGMENT_ROWS) -> DataFrame:
    """``rank`` (1, 2, 3 ... by ``score`` down, ``id``, ``n_features`` down) of the first ``draw(rows)`` rows of a written table.

    All rows are returned; those behind the draw have a null rank.
    """
    spark = rows.sparkSession
    largest = F.lit((1 << 63) - 1).cast("long")
    local = rows.select("*", (-F.col("score")).alias("up"), F.coalesce("id", largest).alias("tie"), (-F.col("n_features")).alias("few")) \
        .sortWithinPartitions("up", "tie", "few")
    runs = materialize(local.select("*", F.spark_partition_id().cast("long").alias("run"),
                                    F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("pos")), "sorted-runs", "zstd")
    sizes = runs.groupBy("run").agg(F.count(F.lit(1)).alias("size"))
    total, number = sizes.agg(F.coalesce(F.sum("size"), F.lit(0)), F.coalesce(F.max("run") + 1, F.lit(0))).first()
    wanted = draw(total)
    segments = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // segment_rows))
    splitters = _splitters(runs, sizes, number, segments)
    schema = T.StructType([*runs.schema.fields, T.StructField("segment", T.IntegerType())])
    dealt = runs.mapInArrow(_segmented(splitters, schema), schema)
    counts = np.zeros(len(splitters) + 1, np.int64)
    for segment, n in dealt.groupBy("segment").agg(F.count(F.lit(1))).collect():
        counts[segment] = n
    before = np.cumsum(counts) - counts
    last = int(np.searchsorted(before, wanted, "left")) if wanted else 0  # segments from here on lie behind the draw
    starts = F.split(F.lit(",".join(str(x) for x in before[:max(1, last)])), ",").cast("array<bigint>")
    place = F.row_number().over(Window.partitionBy("segment").orderBy(*KEY)) + F.get(starts, F.col("segment"))
    inside = dealt.where(F.col("segment") < last).repartitionById(max(1, last), F.col("segment")).withColumn("rank", place.cast("long"))
    outside = dealt.where(F.col("segment") >= last).withColumn("rank", F.lit(None).cast("long"))
    both = inside.withColumn("rank", F.when(F.col("rank") <= wanted, F.col("rank"))).unionByName(outside)
    return both.select(*rows.columns, "rank")


def resample(docs: DataFrame, target: DataFrame, most: int = 1, buckets: int = BUCKETS, min_words: int = MIN_WORDS, percent: int = PERCENT,
             seed: int = SEED, id_col: str = "doc_id", text_col: str = "text", target_text_col: str = "text", with_rows: bool = True) -> DataFrame:
    """One row per row of ``docs``: id, n_features, weight, score, rank (null: not drawn).

    With ``with_rows`` a column ``row`` holds the whole row, so ``where("rank is not null")`` is the drawn corpus.
    """
    spark = docs.sparkSession
    short_batches(spark)
    carry = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")] if with_rows else []
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"), *carry)
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("words", T.LongType()), T.StructField("features", T.BinaryType()),
                           *[f for f in rows.schema.fields if f.name == "row"]])
    featured = materialize(rows.mapInArrow(tidied(_featured(most, buckets, with_rows)), schema), "bucket-features", "zstd")
    wanted = target.select(F.lit(None).cast("long").alias("id"), F.col(f"`{target_text_col}`").alias("t")) \
        .mapInArrow(tidied(_featured(most, buckets, False)), "id long, words long, features binary")
    gains = bucket_gains(bucket_counts(featured, buckets), bucket_counts(wanted, buckets))
    weighed = T.StructType([*schema.fields[:2], T.StructField("n_features", T.LongType()), T.StructField("weight", T.LongType()), *schema.fields[3:]])
    scored = materialize(featured.mapInArrow(tidied(_weighed(gains, with_rows)), weighed).withColumn("score", F.col("weight") + _noise("id", seed)),
                         "weighed", "zstd")
    fit = F.col("words") >= min_words
    ranked = regular_sampling_ranks(scored.where(fit), lambda n: percent * n // 100)
    out = ranked.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))
    return out.select(F.col("id").alias(id_col), "n_features", "weight", "score", "rank", *(["row"] if with_rows else []))
