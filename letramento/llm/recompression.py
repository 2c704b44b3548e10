"""Substring dedup by recompression.

Words are named by hashes, which every task derives alike. Each round names maximal
runs of a symbol and then pairs of neighbours whose left symbol falls in the left and
whose right symbol falls in the right half of the alphabet (one hash bit per round), so
equal substrings get equal symbols away from their borders. For every symbol the parse
tracks the words on which it depends; a symbol whose words all lie in a window is the
same in every occurrence of that window. The highest such symbol (smallest name on
ties), together with its words, is the anchor of the window; neighbouring windows share
anchors, and a window without one is its own anchor.

1. Anchors meet in Spark by name; those that occur in one document only are gone.
2. Windows of the shared anchors are compared by the hash of all their words (64 and
   further 32 bits over independent word hashes), against the smallest doc_id.
3. Words covered by a window that also starts in a document with a smaller id go.

Each task first settles what it can within its own block of documents and sends one
entry per name and text of the smallest id: a passage that a third of all documents
share sends one entry per block. Entries travel as packed arrays. What is settled goes to the
home of its document, a hash of identifier and text, so copies of one text are spread.

Defined results: null text has no words; a null identifier is never smaller than
another and keeps all its words; rows of one identifier never remove each other;
texts shorter than a window stay whole; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letramento.llm.common import blocks, column, mix64, short_batches, tidied, words

WINDOW = 13
ROUNDS = 2
BLOCK_WORDS = 1 << 19
BUCKET_BYTES = 24 << 20
KNOWN_WORDS = 200_000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
ENTRY = "bucket int, settled boolean, ids binary, prints binary, counts binary, keys binary, checks binary"


class WordNames(dict):
    """Word -> number; ``names`` has 64 and further 32 hash bits of each."""

    def __init__(self):
        super().__init__()
        self._new, self._names = [], np.zeros((0, 2), np.uint64)

    def __missing__(self, word: bytes) -> int:
        number = self[word] = len(self)
        self._new.append(xxhash.xxh3_128_digest(word))
        return number

    def names(self) -> np.ndarray:
        if self._new:
            self._names = np.concatenate([self._names, np.frombuffer(b"".join(self._new), "<u8").reshape(-1, 2)])
            self._new = []
        return self._names


class Block:
    """Words of several documents in one array, a separator before each and after the last."""

    def __init__(self, texts: list[list[bytes]], known: WordNames, window: int = WINDOW):
        self.window, n = window, sum(map(len, texts)) + len(texts) + 1
        numbers = np.full(n, -1, np.int64)
        self.start = np.zeros(len(texts), np.int64)
        at = 1
        for d, w in enumerate(texts):
            self.start[d] = at
            numbers[at:at + len(w)] = np.fromiter(map(known.__getitem__, w), np.int64, len(w))
            at += len(w) + 1
        names = known.names()
        self.gap = numbers < 0
        lookup = names if len(names) else np.zeros((1, 2), np.uint64)
        self.name = np.where(self.gap, np.uint64(0), lookup[numbers, 0])
        self.other = np.where(self.gap, np.uint64(0), lookup[numbers, 1])
        lengths = np.array([len(w) for w in texts], np.int64)
        count = np.maximum(lengths - window + 1, 0)
        self.doc = np.repeat(np.arange(len(texts)), count)
        self.at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.start[self.doc]
        steps = np.arange(n, dtype=np.uint64)
        steps[:] = _BASE
        steps[0] = 1
        self._power = np.multiply.accumulate(steps)
        steps[1:] = _BASE_BACK
        self._back = np.multiply.accumulate(steps)

    def hashes(self, of: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hash of the words lo..hi-1 in order, the same wherever they stand."""
        prefix = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix64(of) * self._power, dtype=np.uint64)])
        return mix64((prefix[hi] - prefix[lo]) * self._back[lo] + (hi - lo).astype(np.uint64))

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        end = self.at + self.window
        return self.hashes(self.name, self.at, end), (self.hashes(self.other, self.at, end) >> np.uint64(32)).astype(np.uint32)

    def levels(self, rounds: int = ROUNDS) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """After each round: names of the symbols and the words (lo, hi) that determine them."""
        name, gap = self.name, self.gap
        lo = np.arange(len(name))
        hi = lo + 1
        for r in range(rounds):
            first = np.flatnonzero(np.concatenate([[True], (name[1:] != name[:-1]) | gap[1:] | gap[:-1]]))
            last = np.concatenate([first[1:], [len(name)]]) - 1
            length = (last - first + 1).astype(np.uint64)
            inner = ~gap[first]
            run_lo = np.where(inner, lo[np.maximum(first - 1, 0)], lo[first])
            run_hi = np.where(inner, hi[np.minimum(last + 1, len(hi) - 1)], hi[last])
            name = np.where(length > 1, mix64(name[first] + length * _BASE), name[first])
            lo, hi, gap = run_lo, run_hi, gap[first]

            left = (mix64(name + np.uint64(2 * r + 1)) & np.uint64(1)).astype(bool) & ~gap
            right = ~left & ~gap
            pair = np.concatenate([left[:-1] & right[1:], [False]])
            second = np.concatenate([[False], pair[:-1]])
            after, before = np.concatenate([hi[1:], hi[-1:]]), np.concatenate([lo[:1], lo[:-1]])
            new_name = np.where(pair, mix64(name * _BASE + mix64(np.concatenate([name[1:], name[-1:]]) + np.uint64(r))), name)
            new_lo = np.where(right, before, lo)
            new_hi = np.where(left, after, hi)
            keep = ~second
            name, lo, hi, gap = new_name[keep], new_lo[keep], new_hi[keep], gap[keep]
            yield name[~gap], lo[~gap], hi[~gap]

    def anchors(self) -> np.ndarray:
        """The name of each window's anchor."""
        out, _ = self.windows()
        todo = np.arange(len(self.at))
        for name, lo, hi in reversed(list(self.levels())):
            if not len(todo) or not len(name):
                continue
            key = mix64(name ^ self.hashes(self.name, np.maximum(lo, 0), np.minimum(hi, len(self.name))))
            a = np.searchsorted(lo, self.at[todo], "left")
            b = np.searchsorted(hi, self.at[todo] + self.window, "right")
            has = a < b
            pick, a, b = todo[has], a[has], b[has]
            best = key[a] if len(a) else key[:0]
            for k in range(1, int((b - a).max()) if len(a) else 0):
                at = np.minimum(a + k, len(key) - 1)
                best = np.where((a + k < b) & (key[at] < best), key[at], best)
            out[pick] = best
            todo = todo[~has]
        return out


def _cut(doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First position and length of each stretch of equal numbers."""
    first = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    return first, np.diff(np.concatenate([first, [len(doc)]]))


def _entries(bucket: int, settled: bool, ids, prints, doc, keys, checks) -> tuple:
    first, counts = _cut(doc)
    return (bucket, settled, ids[doc[first]].tobytes(), prints[doc[first]].tobytes(), counts.astype(np.int32).tobytes(),
            keys.tobytes(), checks.tobytes())


def _homes(ids: np.ndarray, prints: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket in which a document's answers meet: exact copies with other identifiers have other homes."""
    return (mix64(mix64(ids.view(np.uint64)) ^ prints.view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def _parts(where: np.ndarray) -> list[np.ndarray]:
    """Positions of equal numbers, each in the given order."""
    order = np.argsort(where, kind="stable")
    return np.split(order, np.flatnonzero(np.diff(where[order])) + 1) if len(order) else []


def _requests(keys, checks, doc, ids, prints, buckets: int, smaller: bool) -> list[tuple]:
    """Settle a block's own matches; for each name, ask with the block's smallest id, once for each of its texts."""
    order = np.lexsort((prints[doc], ids[doc], checks, keys))
    k, c, d = keys[order], checks[order], doc[order]
    new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])]) if len(k) else np.zeros(0, bool)
    start = np.flatnonzero(new)
    if not len(start):
        return []
    group, own, text = np.cumsum(new) - 1, ids[d], prints[d]
    least = own[start][group]
    most = own[np.concatenate([start[1:], [len(k)]]) - 1][group]
    hit = own > least if smaller else most > least
    out = []
    if hit.any():
        settled = np.flatnonzero(hit)
        settled = settled[np.argsort(d[settled], kind="stable")]
        home = _homes(ids, prints, buckets)[d[settled]]
        for part in _parts(home):
            at = settled[part]
            out.append(_entries(int(home[part[0]]), True, ids, prints, d[at], k[at], c[at]))
    ask = np.flatnonzero(new | ((own == least) & np.concatenate([[True], text[1:] != text[:-1]])))
    ask = ask[np.argsort(d[ask], kind="stable")]
    where = (k[ask] % np.uint64(buckets)).astype(np.int64)
    for part in _parts(where):
        at = ask[part]
        out.append(_entries(int(where[part[0]]), False, ids, prints, d[at], k[at], c[at]))
    return out


def _answers(buckets: int, smaller: bool) -> Callable[[pd.DataFrame], pd.DataFrame]:
    """One bucket's entries -> those that are shared, or start in a smaller id, packed by the home of their document."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        parts = [tuple(np.frombuffer(b"".join(x), t) for x, t in zip((p.ids, p.prints, p.counts, p["keys"], p.checks),
                                                                    (np.int64, np.int64, np.int32, np.uint64, np.uint32)))
                 for p in (pdf[pdf.settled], pdf[~pdf.settled])]
        out = []
        for (ids, prints, counts, keys, checks), done in zip(parts, (True, False)):
            doc = np.repeat(np.arange(len(ids)), counts)
            if not done and len(keys):
                own = ids[doc]
                order = np.lexsort((checks, keys))
                k, c, o = keys[order], checks[order], own[order]
                new = np.concatenate([[True], (k[1:] != k[:-1]) | (c[1:] != c[:-1])])
                start = np.flatnonzero(new)
                group = np.cumsum(new) - 1
                least, most = np.minimum.reduceat(o, start), np.maximum.reduceat(o, start)
                hit = np.zeros(len(keys), bool)
                hit[order] = o > least[group] if smaller else (most > least)[group]
                doc, keys = doc[hit], keys[hit]
            home = _homes(ids, prints, buckets)[doc]
            for at in _parts(home):
                first, n = _cut(doc[at])
                own = doc[at][first]
                out.append((int(home[at[0]]), ids[own].tobytes(), prints[own].tobytes(), n.astype(np.int32).tobytes(),
                            keys[at].tobytes()))
        return pd.DataFrame(out, columns=["home", "ids", "prints", "counts", "keys"])

    return run


def _by_document(pdf: pd.DataFrame) -> pd.DataFrame:
    """Packed answers of several buckets -> one row per document with all its keys."""
    ids, prints, counts, keys = (np.frombuffer(b"".join(pdf[c]), t) for c, t in
                                 (("ids", np.int64), ("prints", np.int64), ("counts", np.int32), ("keys", np.uint64)))
    entry = np.repeat(np.arange(len(ids)), counts)
    order = np.lexsort((prints[entry], ids[entry]))
    i, p, k = ids[entry][order], prints[entry][order], keys[order]
    first = np.flatnonzero(np.concatenate([[True], (i[1:] != i[:-1]) | (p[1:] != p[:-1])])) if len(k) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(k)]])
    return pd.DataFrame({"id": i[first], "print": p[first], "keys": [k[a:b].tobytes() for a, b in zip(first, last)]})


def _asked(buckets: int, smaller: bool, window: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Documents (and, for the second question, the names of their shared anchors) -> packed entries."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordNames()

        def rows():
            for b in batches:
                keys = column(b, "keys") if smaller else [None] * b.num_rows
                for row in zip(column(b, "id"), column(b, "print"), column(b, "t"), keys):
                    if row[0] is not None:
                        yield row[0], row[1], words(row[2]), row[3]

        for rowset in blocks(rows(), lambda r: len(r[2]) + 1, BLOCK_WORDS):
            block = Block([r[2] for r in rowset], known, window)
            ids, prints = (np.array([r[c] for r in rowset], np.int64) for c in (0, 1))
            anchors = block.anchors()
            if smaller:
                shared = [np.frombuffer(r[3], np.uint64) for r in rowset]
                bounds = np.searchsorted(block.doc, np.arange(len(rowset) + 1))
                wanted = np.concatenate([np.isin(anchors[a:b], s) for a, b, s in zip(bounds, bounds[1:], shared)])
                keys, checks = block.windows()
                keys, checks, doc = keys[wanted], checks[wanted], block.doc[wanted]
            else:
                first = np.concatenate([[True], (anchors[1:] != anchors[:-1]) | (block.doc[1:] != block.doc[:-1])]) \
                    if len(anchors) else np.zeros(0, bool)
                keys, doc = anchors[first], block.doc[first]
                checks = np.zeros(len(keys), np.uint32)
            found = _requests(keys, checks, doc, ids, prints, buckets, smaller)
            if len(known) > KNOWN_WORDS:
                known = WordNames()
            for at in range(0, len(found), 8):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*found[at:at + 8]), (pa.int32(), pa.bool_(), *[pa.binary()] * 5))],
                    names=["bucket", "settled", "ids", "prints", "counts", "keys", "checks"])

    return run


def _kept(window: int, with_text: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = WordNames()
        for b in batches:
            total, removed, digest, texts = [], [], [], []
            for t, keys in zip(column(b, "t"), column(b, "keys")):
                w = words(t)
                total.append(len(w))
                if keys:
                    block = Block([w], known, window)
                    starts = block.at[np.isin(block.windows()[0], np.frombuffer(keys, np.uint64))] - 1
                    edge = np.zeros(len(w) + 1, np.int64)
                    np.add.at(edge, starts, 1)
                    np.add.at(edge, starts + window, -1)
                    w = [x for x, c in zip(w, np.cumsum(edge)) if not c]
                text = b" ".join(w)
                removed.append(total[-1] - len(w))
                digest.append(hashlib.sha256(text).hexdigest())
                texts.append(text.decode("utf-8"))
            if len(known) > KNOWN_WORDS:
                known = WordNames()
            cols = {"doc_id": b.column(b.schema.get_field_index("id")), "n_words": pa.array(total, pa.int64()),
                    "n_removed": pa.array(removed, pa.int64()), "kept_sha256": pa.array(digest, pa.string())}
            yield pa.RecordBatch.from_pydict(cols | ({"kept_text": pa.array(texts, pa.string())} if with_text else {}))

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
                   with_text: bool = True) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_removed, kept_sha256 and, if asked, kept_text."""
    short_batches(docs.sparkSession)
    text = F.col(f"`{text_col}`")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.xxhash64(text).alias("print"), text.alias("t"))
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    buckets = max(4, size // BUCKET_BYTES)

    def settle(asked: DataFrame, smaller: bool) -> DataFrame:
        found = asked.mapInArrow(tidied(_asked(buckets, smaller, window)), ENTRY).groupBy("bucket") \
            .applyInPandas(_answers(buckets, smaller), "home int, ids binary, prints binary, counts binary, keys binary")
        return found.groupBy("home").applyInPandas(_by_document, "id long, print long, keys binary")

    extra = ", kept_text string" if with_text else ""
    finish, schema = tidied(_kept(window, with_text)), f"doc_id long, n_words long, n_removed long, kept_sha256 string{extra}"
    named = rows.where("id is not null")  # both joins read this one exchange of the texts
    shared = settle(named, False)
    repeated = settle(named.join(shared, ["id", "print"]), True)
    nameless = rows.where("id is null").withColumn("keys", F.lit(None).cast("binary"))
    return named.join(repeated, ["id", "print"], "left").unionByName(nameless).mapInArrow(finish, schema)
