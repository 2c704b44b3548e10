"""Exact dedup by content sort.

Texts are compared after each run of ``[\\x20\\x09-\\x0D]`` became one space; null
counts as empty. Spark samples splitters and range-partitions the rows by a 32-byte
prefix of the normalised bytes, then SHA-256, then identifier; the external sort of
each partition puts equal texts side by side, and a full comparison of neighbours
marks the runs. Because the identifier is part of the range key, a text that holds a
third of all rows spreads over as many partitions as its share needs; its runs are
stitched from at most two edge rows of each partition, again by full comparison.

Defined results: a null identifier sorts last and stays only if all of its group are
null; rows repeated with the same identifier are one group of which one row stays;
an empty table gives an empty result; further columns are carried or left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letramento.llm.common import materialize, short_batches

SPACES = "[\\x20\\x09-\\x0D]+"
PREFIX_BYTES = 32


def normalised(col) -> F.Column:
    return F.regexp_replace(F.coalesce(col, F.lit("")), SPACES, " ")


def _content_sorted(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    norm = normalised(F.col(f"`{text_col}`"))
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), norm.alias("norm"),
                       *([F.struct(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("cols"),
                                   F.when(F.col(f"`{text_col}`").isNull(), F.lit(0))
                                   .when(F.col(f"`{text_col}`") == norm, F.lit(1)).otherwise(F.lit(2)).alias("kind"),
                                   F.when(F.col(f"`{text_col}`") != norm, F.col(f"`{text_col}`")).alias("raw"))
                          .alias("row")] if carry else []))
    key = [F.substring(F.encode("norm", "utf-8"), 1, PREFIX_BYTES).alias("prefix"), F.unhex(F.sha2("norm", 256)).alias("sha")]
    keyed = slim.select("*", *key)
    order = [F.col("prefix"), F.col("sha"), F.col("id").asc_nulls_last()]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("prefix")


def _mark_runs(keep_all: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of one sorted partition -> rows with their run, then the partition's first and last run."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, no, prev, last_id, edges, schema = TaskContext.get().partitionId(), -1, None, None, [], None
        for b in batches:
            n = b.num_rows
            if not n:
                continue
            ids, norm, sha = (b.column(b.schema.get_field_index(c)) for c in ("id", "norm", "sha"))
            new = np.ones(n, bool)
            new[0] = prev is None or prev != norm[0].as_py()
            if n > 1:
                new[1:] = pc.not_equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            runs = no + np.cumsum(new)
            starts = np.flatnonzero(new)
            if no < 0:
                edges.append((0, ids[0].as_py(), norm[0].as_py()))
            if len(starts):
                last_id = ids[int(starts[-1])].as_py()
            no, prev = int(runs[-1]), norm[n - 1].as_py()
            cols = {"part": pa.array(np.full(n, part, np.int64)), "run": pa.array(runs.astype(np.int64)),
                    "first": pa.array(new), "id": ids, "sha": sha, "edge_text": pa.nulls(n, pa.string())}
            if "row" in b.schema.names:
                cols |= {"norm": norm, "row": b.column(b.schema.get_field_index("row"))}
            out = pa.RecordBatch.from_pydict(cols)
            schema = out.schema
            yield out if keep_all else out.filter(pa.array(new))
        if no > 0:
            edges.append((no, last_id, prev))
        if edges:
            k = len(edges)
            yield pa.RecordBatch.from_arrays(
                [{"part": pa.array([part] * k, pa.int64()), "run": pa.array([e[0] for e in edges], pa.int64()),
                  "id": pa.array([e[1] for e in edges], pa.int64()),
                  "edge_text": pa.array([e[2] for e in edges], pa.string())}.get(f.name, pa.nulls(k, f.type))
                 for f in schema], schema=schema)

    return run


def _stitched(marked: DataFrame) -> DataFrame:
    """(part, run) of edge runs -> first part of the text and the identifier that stays."""
    edges = marked.where("edge_text is not null").select("part", "run", "id", "edge_text")
    whole = edges.groupBy("edge_text").agg(F.min("part").alias("head"), F.min("id").alias("keep"),
                                           F.collect_set(F.struct("part", "run")).alias("runs"))
    return whole.select("head", "keep", F.xxhash64("edge_text").alias("group"), F.explode("runs").alias("r")) \
        .select("r.part", "r.run", "head", "keep", "group")


def content_sort_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, keep_id, group_size, kept, text_sha256."""
    short_batches(docs.sparkSession)
    marked = materialize(_content_sorted(docs, id_col, text_col, carry=False).mapInArrow(
        _mark_runs(True), "part long, run long, first boolean, id long, sha binary, edge_text string"), "content-sort")
    rows = marked.where("edge_text is null")
    sizes = rows.groupBy("part", "run").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("least"))
    edges = _stitched(marked).join(sizes, ["part", "run"])
    totals = edges.groupBy("head", "group").agg(F.sum("n").alias("total"))
    fixes = edges.join(totals, ["head", "group"]).select("part", "run", "head", "keep", "total")
    groups = sizes.join(fixes, ["part", "run"], "left").select(
        "part", "run", F.coalesce("keep", "least").alias("keep_id"), F.coalesce("total", "n").alias("group_size"),
        (F.col("head").isNull() | (F.col("head") == F.col("part"))).alias("here"))
    return rows.join(groups, ["part", "run"]).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("first") & F.col("here")).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, with all their columns; the sort carries them, so nothing is joined back by text."""
    short_batches(docs.sparkSession)
    source = _content_sorted(docs, id_col, text_col, carry=True)
    fields = dict(source.dtypes)
    marked = materialize(source.mapInArrow(
        _mark_runs(False), "part long, run long, first boolean, id long, sha binary, edge_text string, norm string, "
                           f"`row` {fields['row']}"), "content-sort-rows", "zstd")  # whole texts: the denser codec pays
    later = _stitched(marked).where("part > head").select("part", "run")
    kept = marked.where("edge_text is null").join(later, ["part", "run"], "left_anti")
    text = F.when(F.col("row.kind") == 1, F.col("norm")).when(F.col("row.kind") == 2, F.col("row.raw"))
    return kept.select(*[(text if c == text_col else F.col(f"row.cols.`{c}`")).alias(c) for c in docs.columns])
