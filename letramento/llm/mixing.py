"""Mixing sources to target weights by Pfair scheduling.

Documents of a source, in the order in which they are stored, form blocks. Integer
weights a_i with sum H give block j of source i the release time floor(j * H / a_i) and
the deadline ceil((j + 1) * H / a_i); earliest deadline first, among released blocks,
fills one slot at a time and keeps every source within one block of its target share
at every slot. After H slots each source has had exactly a_i blocks, so the schedule
repeats and one period (a table of H slots, bounded by the weights) places any block by
arithmetic. When sources run out, the next phase schedules the others by their weights:
a phase is a number of whole periods, or one period in which a source that has fewer
blocks left than its weight uses them up evenly. No row is dropped or repeated.

Rows are written once with their partition and their number within (partition, source),
and ranks within a source come from that one table: from its counts per (partition,
source), summed over the partitions before. However the rows were first split, counts
and places agree, and no task ever holds a source. Rows move once, to the partition of
their place in the mix.

Defined results: a null source is a source of its own; sources without a given weight
get ``default_weight``; null texts and identifiers, repeated rows and further columns
are carried unchanged; an empty table stays empty.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from math import isqrt

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from letramento.llm.common import materialize, short_batches

BLOCK_ROWS = 16
#: Weights of derived targets sum to about this many slots a period.
PERIOD = 1000
MOST_SOURCES = 100_000
ROWS_PER_PARTITION = 20_000


def pfair_period(weights: list[int]) -> list[list[int]]:
    """Slots of each source's blocks within one period of sum(weights) slots."""
    total, slots, ready = sum(weights), [[] for _ in weights], []
    coming = [(0, i) for i, a in enumerate(weights) if a]
    heapq.heapify(coming)
    for t in range(total):
        while coming and coming[0][0] <= t:
            _, i = heapq.heappop(coming)
            heapq.heappush(ready, (-(-(len(slots[i]) + 1) * total // weights[i]), i))
        _, i = heapq.heappop(ready)
        slots[i].append(t)
        if len(slots[i]) < weights[i]:
            heapq.heappush(coming, (len(slots[i]) * total // weights[i], i))
    return slots


def pfair_phases(blocks: list[int], weights: list[int]) -> list[dict]:
    """Phases until all blocks are placed: first slot, periods, and per source its first block and slots."""
    left, done, slot, out = list(blocks), [0] * len(blocks), 0, []
    while any(left):
        active = [w if n else 0 for n, w in zip(left, weights)]
        periods = min(n // a for n, a in zip(left, active) if a)
        share = active if periods else [min(a, n) for a, n in zip(active, left)]
        periods = periods or 1
        out.append({"slot": slot, "length": sum(share), "weights": share, "done": list(done), "slots": pfair_period(share)})
        slot += periods * sum(share)
        for i, a in enumerate(share):
            left[i] -= periods * a
            done[i] += periods * a
    return out


def derived_weights(counts: dict[str, int], period: int = PERIOD) -> dict[str, int]:
    """Targets in proportion to the square root of a source's rows, as integers of at least one."""
    total = sum(isqrt(n) for n in counts.values()) or 1
    return {s: max(1, round(period * isqrt(n) / total)) for s, n in counts.items()}


def _local_ranks(source_col: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the partition and the row's running number within (partition, source)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), {}
        for b in batches:
            source = b.column(b.schema.get_field_index(source_col)).to_pylist()
            local = np.empty(len(source), np.int64)
            for k, s in enumerate(source):
                local[k] = seen[s] = seen.get(s, -1) + 1
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([part] * len(source), pa.int64()), pa.array(local)],
                                             names=[*b.schema.names, "__part", "__local"])

    return run


def _placer(phases: list[dict], blocks: list[int], rows: list[int], block_rows: int):
    """Vectorised (source number, rank in source) -> (block, slot, position in the mix)."""
    last_slots = []

    def slot_of(i: np.ndarray, block: np.ndarray) -> np.ndarray:
        slot = np.full(len(i), -1, np.int64)
        for src in np.unique(i):
            at = np.flatnonzero(i == src)
            mine = [p for p in phases if p["weights"][src]]
            first = np.array([p["done"][src] for p in mine])
            which = np.searchsorted(first, block[at], "right") - 1
            for k in np.unique(which):
                p, sel = mine[k], at[which == k]
                j, a = block[sel] - p["done"][src], p["weights"][src]
                slot[sel] = p["slot"] + j // a * p["length"] + np.array(p["slots"][src])[j % a]
        return slot

    # Every block is full but the last of each source: correct positions by the rows missing in earlier short blocks.
    number = np.array([i for i, n in enumerate(blocks) if n], np.int64)
    if len(number):
        short = np.array([blocks[i] * block_rows - rows[i] for i in number], np.int64)
        at = slot_of(number, np.array([blocks[i] - 1 for i in number], np.int64))
        order = np.argsort(at)
        last_slots = at[order], np.concatenate([[0], np.cumsum(short[order])])

    def place(i: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        block = rank // block_rows
        slot = slot_of(i, block)
        missing = last_slots[1][np.searchsorted(last_slots[0], slot, "left")]
        return block, slot, slot * block_rows + rank % block_rows - missing

    return place


def mix_sources(docs: DataFrame, weights: dict[str | None, int] | None = None, source_col: str = "source",
                block_rows: int = BLOCK_ROWS, default_weight: int = 1) -> DataFrame:
    """All rows and columns of ``docs`` with ``mix_weight``, ``mix_block``, ``mix_slot`` and ``mix_position``.

    Rows are range-partitioned and sorted by position, so files written from the result
    hold consecutive parts of the mix. Names that the result adds replace columns of the
    same name.
    """
    spark = docs.sparkSession
    short_batches(spark)
    added = ("mix_weight", "mix_block", "mix_slot", "mix_position")
    docs = docs.drop(*added)
    void = [f.name for f in docs.schema if isinstance(f.dataType, T.NullType)]  # Parquet has no such type: put back at the end
    stored = docs.drop(*void)
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in stored.columns]).alias("row"),  # no column of docs can clash in there
                         F.col(f"`{source_col}`").cast("string").alias("__source"))
    full = T.StructType([*packed.schema.fields, T.StructField("__part", T.LongType()), T.StructField("__local", T.LongType())])
    ranked = materialize(packed.mapInArrow(_local_ranks("__source"), full), "mix-rows", "zstd")  # whole texts: the denser codec pays
    counts = materialize(ranked.groupBy("__source", "__part").agg(F.count(F.lit(1)).alias("n")), "mix-counts")
    totals = {r[0]: r[1] for r in counts.groupBy("__source").agg(F.sum("n")).limit(MOST_SOURCES + 1).collect()}
    if len(totals) > MOST_SOURCES:
        raise ValueError(f"more than {MOST_SOURCES} sources: group them before mixing")
    names = sorted(totals, key=lambda s: (s is None, s or ""))
    target = derived_weights(totals) if weights is None else {s: weights.get(s, default_weight) for s in names}
    if any(int(a) != a or a < 1 for a in target.values()):
        raise ValueError("weights are whole numbers of at least 1")
    rows = [totals[s] for s in names]
    sizes = [-(-n // block_rows) for n in rows]
    place = _placer(pfair_phases(sizes, [target[s] for s in names]), sizes, rows, block_rows)
    numbers = {s: i for i, s in enumerate(names)}
    before = Window.partitionBy("__source").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(F.col("__source").alias("__s"), F.col("__part").alias("__p"),
                            F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))

    ranked = ranked.join(offsets, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("__part") == F.col("__p")))

    @F.pandas_udf("mix_weight long, mix_block long, mix_slot long, mix_position long")
    def places(source: pd.Series, rank: pd.Series) -> pd.DataFrame:
        number = source.map(lambda s: numbers[None if pd.isna(s) else s]).to_numpy(np.int64)
        block, slot, position = place(number, rank.to_numpy(np.int64))
        weight = np.array([target[names[i]] for i in number], np.int64)
        return pd.DataFrame({"mix_weight": weight, "mix_block": block, "mix_slot": slot, "mix_position": position})

    total = sum(rows)
    parts = max(1, min(total // ROWS_PER_PARTITION + 1, 100_000), int(spark.conf.get("spark.sql.shuffle.partitions")))
    placed = ranked.withColumn("__mix", places("__source", F.col("__before") + F.col("__local")))
    out = placed.select(*[F.lit(None).alias(c) if c in void else F.col(f"row.`{c}`") for c in docs.columns], *[F.col(f"__mix.{c}").alias(c) for c in added])
    return out.repartitionById(parts, (F.col("mix_position") * parts / F.lit(max(1, total))).cast("int")) \
        .sortWithinPartitions("mix_position")
