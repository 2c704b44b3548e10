"""The pipeline: each stage against the operators and brute force, on the smallest tables."""

import re

import corpus_pipeline
import __spark_entry__ as E
from letramento.llm import mixing, packing, simhash
from letramento.llm.common import materialize, read_table

SF = "/root/testdata/sf0.001"


def test_stages_take_effect(spark):
    docs = read_table(spark, SF, "documents")
    columns, seen = docs.columns, [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = materialize(stage(spark, docs, SF), f"test-{name}")
        seen.append(docs)
    start, good, exact, near, mixed, packed = seen
    assert all(x.columns == columns for x in seen[:-1])
    bad = {r.doc_id for r in start.join(good, "doc_id", "left_anti").join(read_table(spark, SF, "labels"), "doc_id").where("quality = 1").collect()}
    assert not bad and 0 < good.count() < start.count()
    texts = {}
    for r in good.orderBy("doc_id").collect():
        texts.setdefault(re.sub("[\x20\x09-\x0d]+", " ", r.text or ""), r.doc_id)
    assert {r.doc_id for r in exact.collect()} == set(texts.values())
    prints = {r.doc_id: simhash.fingerprint((r.text or "").encode().lower().split()) for r in exact.collect()}
    kept = {r.doc_id for r in near.collect()}
    for i in prints.keys() - kept:
        assert any(j != i and (f ^ prints[i]).bit_count() <= 3 for j, f in prints.items())
    assert not any(a < b and (prints[a] ^ prints[b]).bit_count() <= 3 for a in kept for b in kept)
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, near.collect()))
    assert {r.doc_id for r in packed.select("doc_id").distinct().collect()} == kept
    # the sequences follow the mix: the blocks' first documents ascend in it
    place = {r.doc_id: r.mix_position for r in mixing.mix_sources(near).select("doc_id", "mix_position").collect()}
    blocks = {}
    for p in packed.collect():
        blocks.setdefault(p.sequence_id >> packing.COUNT_BITS, set()).add(place[p.doc_id])
    spans = [(min(b), max(b)) for _, b in sorted(blocks.items())]
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))


def test_all_operators_are_registered():
    names = E.queries()
    assert "pipeline" in names and all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 14))
    assert set(E.oracle_sql()) <= set(names)
