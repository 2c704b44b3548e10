"""Merkle manifest of a table: digest tree, proofs and verification, by a nested-struct rollup.

A row's leaf is the SHA-256 of its fields. The leaves of a group, in order, form runs of
``FANOUT`` whose digests are the next level, until one subroot is left; the subroots of
all groups form the root in the same way.

Ranks come from one range-partitioned, locally sorted, written table and prefix counts,
so no group is ordered in one task. The digits of a rank (base ``FANOUT``) name the path
of a leaf. ``DIGITS`` of them make a block of at most ``FANOUT**DIGITS`` consecutive
nodes; inside a block the digits are grouped away one after the other, each step nesting
the children in a struct with their digest, all behind one exchange on (group, block).
Blocks are written; their digests are the nodes of the next layer. On the way down a
block meets the proof of its own digest by a union and a grouping on (group, block), and
exploding the nested children hands every leaf its siblings: no proof is joined.

Everything is DataFrame functions. A hot group is many blocks; rows that are equal in all
fields are told apart by their place in the written table, which changes no result.

Defined results: a null field counts as ``-``; a null group is a group of its own, before
all others; null identifiers come first in their group; rows with one identifier follow
by leaf; an empty table gives an empty result. Other columns of the table are not read.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letramento.llm.common import materialize

FANOUT = 3
#: Digits of a block: blocks hold at most FANOUT ** DIGITS = 243 nodes.
DIGITS = 5
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<before:array<string>,after:array<string>>>"


def digest(*parts: Column) -> Column:
    """SHA-256 of the concatenated texts, as lowercase hex."""
    return F.sha2(F.concat(*parts), 256)


def leaf_digest(fields: Sequence[Column]) -> Column:
    """Digest of one row: each field as ``-`` if null, else its UTF-8 byte count, ``:`` and its text."""
    texts = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts])


def fold(path: Column, leaf: Column) -> Column:
    """The root that ``leaf`` leads to with the siblings of ``path``."""
    return F.aggregate(path, leaf, lambda at, p: digest(F.concat_ws("", p.before), at, F.concat_ws("", p.after)))


def proof_digest(path: Column) -> Column:
    """Digest of all siblings of a path, level by level, left to right."""
    return F.sha2(F.concat_ws("", F.flatten(F.transform(path, lambda p: F.concat(p.before, p.after)))), 256)


def _ranked(rows: DataFrame, order: list[Column]) -> DataFrame:
    """``rows`` (of a written table) with their rank ``r`` in ``grp`` and the group's size ``n``."""
    placed = materialize(
        rows.repartitionByRange("grp", *order).sortWithinPartitions("grp", *order)
        .select("*", F.spark_partition_id().alias("part"), (F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)).alias("pos")),
        "merkle-order", "zstd")
    counts = placed.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("pos").alias("first"))
    group = Window.partitionBy("grp")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select("grp", "part", (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("first")).alias("start"),
                           F.sum("rows").over(group).alias("n"))
    return placed.join(starts, ["grp", "part"]).withColumn("r", F.col("start") + F.col("pos"))


def _climb(nodes: DataFrame, level: int) -> DataFrame:
    """Nodes (grp, r, n, digest, load) of one level -> their blocks (grp, r, n, digest, kids), DIGITS levels up."""
    digits = [f"d{i}" for i in range(DIGITS)]
    work = nodes.select("grp", "n", F.expr(f"r div {FANOUT ** DIGITS}").alias("block"),
                        *[F.expr(f"(r div {FANOUT ** i}) % {FANOUT}").cast("int").alias(d) for i, d in enumerate(digits)],
                        F.struct("digest", "load").alias("node")).repartition("grp", "block")
    for i, d in enumerate(digits):
        run = F.sort_array(F.collect_list(F.struct(F.col(d).alias("at"), "node")))
        work = work.groupBy("grp", "n", "block", *digits[i + 1:]).agg(F.transform(run, lambda k: k.node).alias("kids"))
        above = F.when(F.col("n") > FANOUT ** (level + i), F.sha2(F.concat_ws("", F.col("kids.digest")), 256)) \
            .otherwise(F.col("kids")[0].digest)  # a node that is alone in its group is its subroot already
        work = work.select("grp", "n", "block", *digits[i + 1:], F.struct(above.alias("digest"), "kids").alias("node"))
    return work.select("grp", F.col("block").alias("r"), "n", "node.digest", "node.kids")


def _layers(nodes: DataFrame, name: str) -> tuple[list[tuple[int, DataFrame]], DataFrame]:
    """All layers of blocks over ``nodes``, written, and one (grp, digest) per group."""
    layers, level, most = [], 0, None
    while not layers or FANOUT ** level < most:
        blocks = materialize(_climb(nodes, level), name, "zstd")
        if most is None:
            most = blocks.agg(F.max("n")).first()[0] or 0
        layers.append((level, blocks))
        nodes = blocks.select("grp", "r", "n", "digest", F.lit(None).cast("string").alias("load"))
        level += DIGITS
    return layers, nodes.select("grp", "digest")


def _descend(layers: list[tuple[int, DataFrame]], top: DataFrame, carry: list[str]) -> DataFrame:
    """Proofs of the groups' tops (grp, r, path, ``carry``) -> (grp, digest, load, path, ``carry``) of every node."""
    kept = ["path", *carry]
    for level, blocks in reversed(layers):
        types = {**dict(blocks.dtypes), **dict(top.dtypes)}
        own = blocks.select("grp", "r", "n", "kids", *[F.lit(None).cast(types[c]).alias(c) for c in kept])
        proofs = top.select("grp", "r", *[F.lit(None).cast(types[c]).alias(c) for c in ("n", "kids")], *kept)
        rows = own.unionByName(proofs).groupBy("grp", "r").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("n", "kids", *kept)])
        for i in reversed(range(DIGITS)):
            rows = rows.select("grp", "r", "n", *kept, F.col("kids.digest").alias("run"), F.posexplode("kids").alias("at", "node"))
            step = F.struct(F.slice("run", 1, F.col("at")).alias("before"), F.slice("run", F.col("at") + 2, FANOUT).alias("after"))
            path = F.when(F.col("n") > FANOUT ** (level + i), F.concat(F.array(step), "path")).otherwise(F.col("path"))
            rows = rows.select("grp", (F.col("r") * FANOUT + F.col("at")).alias("r"), "n", path.alias("path"), *carry,
                               *([F.col("node.kids")] if i else [F.col("node.digest"), F.col("node.load")]))
        top = rows
    return top


def merkle_manifest(docs: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "source",
                    carry: Mapping[str, Column] | None = None) -> DataFrame:
    """One row per row of ``docs``: id, leaf, subroot, root, path, and ``carry`` (columns computed beside the leaf).

    ``path`` holds, per level from the leaf to the root, the siblings before and after.
    """
    carry = dict(carry or {})
    group = F.col(f"`{group_col}`").cast("string")
    leaves = materialize(docs.select(
        F.coalesce(F.concat(F.lit("="), group), F.lit("")).alias("grp"),  # null first, then bytewise
        F.col(f"`{id_col}`").alias("id"), leaf_digest([F.col(f"`{f}`") for f in fields]).alias("digest"),
        F.monotonically_increasing_id().alias("row"), *[c.alias(f"c{k}") for k, c in enumerate(carry.values())]), "merkle-leaves", "zstd")
    ranked = _ranked(leaves, [F.col("id").asc_nulls_first(), F.col("digest"), F.col("row")])
    load = F.struct("id", *[f"c{k}" for k in range(len(carry))])
    layers, subroots = _layers(ranked.select("grp", "r", "n", "digest", load.alias("load")), "merkle-blocks")
    groups = _ranked(subroots.select(F.lit("").alias("grp"), F.col("grp").alias("name"), "digest"), [F.col("name")])
    upper, root = _layers(groups.select("grp", "r", "n", "digest", F.col("name").alias("load")), "merkle-groups")
    top = root.select("grp", F.lit(0).cast("long").alias("r"), F.array().cast(PATH).alias("path"), F.col("digest").alias("root"))
    tops = _descend(upper, top, ["root"]).select(
        F.col("load").alias("grp"), F.lit(0).cast("long").alias("r"), "path", F.col("digest").alias("subroot"), "root")
    return _descend(layers, tops, ["subroot", "root"]).select(
        F.col("load.id").alias(id_col), F.col("digest").alias("leaf"), "subroot", "root", "path",
        *[F.col(f"load.c{k}").alias(c) for k, c in enumerate(carry)])


def verify_manifest(docs: DataFrame, changed: Mapping[str, Column], where: Column, fields: Sequence[str] = FIELDS,
                    id_col: str = "doc_id", group_col: str = "source") -> DataFrame:
    """The manifest, and whether each row, with ``changed`` fields ``where`` that holds, still leads to the root."""
    new = leaf_digest([changed.get(f, F.col(f"`{f}`")) for f in fields])
    rows = merkle_manifest(docs, fields, id_col, group_col, {"changed": F.when(where, new)})
    folded = fold(F.col("path"), F.coalesce("changed", "leaf"))
    return rows.select(id_col, "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                       folded.alias("folded_root")).withColumn("verified", F.col("folded_root") == F.col("root"))
