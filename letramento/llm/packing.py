"""Cost-balanced packing of tokenised documents into sequences.

A document is its token ids and then id 0. Within a partition, consecutive documents
form blocks of bounded size. Whole sequences are cut off the front of a document; what
is left over is placed in descending cost into the open sequences of its block, each
time the one with the lowest estimated cost (``linear * n + quadratic * n**2`` summed
over its pieces) that can still hold it, and cut only where none can. A block opens as many sequences as its tokens need, so its padding is
less than one sequence.

Partitions pack on their own: nothing is shuffled, a long document or a hot source
never meets in one task, and a lost task is simply run again. Identifiers of sequences
are the partition (high bits) and a counter (low 33 bits). With ``order`` (``file_order``
for rows that were written in order) they are the place of the block's first document
and a counter, so that sequences follow that order from block to block, however Spark
deals the files to tasks; blocks then end where the order breaks off.

Defined results: null or empty text is the single id 0; repeated rows are packed each;
a null identifier is kept; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import itertools
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letramento.llm.common import blocks, column, short_batches, tidied

CAPACITY = 1024
END_ID = 0
#: Relative cost of the parts of a transformer layer that grow with n and with n**2.
LINEAR, QUADRATIC = 1.0, 1.0 / 4096
BLOCK_TOKENS = 1 << 19
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
#: With ``order``, a sequence's identifier: file (20 bits), first row of the block (22), counter (21); anything larger is refused.
FILE_BITS, ROW_BITS, COUNT_BITS = 20, 22, 21
_PART = re.compile(r"part-(\d+)-[^/]*$")
_LONG_SPACE = re.compile(r"\s{256}")


class TextTokenizer:
    """Token ids of whole texts, as little-endian unsigned 32-bit bytes.

    With ``ranks_path`` the same vocabulary in tiktoken's form encodes whole texts. A
    text with a special token, or with a run of white space so long that tiktoken's
    pattern matcher would exhaust its stack, goes to the tokenizers file instead, and so
    does every text without ``ranks_path`` or where the two disagree on a probe.
    """

    def __init__(self, path: str, ranks_path: str | None = None):
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.fast = self._ranked(ranks_path) if ranks_path else None

    def _ranked(self, ranks_path: str):
        import public_tokenizers
        import tiktoken
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        probe = "Ünïcode words, don't 12345 \u4e16\u754c ### MiXed|Case\tand  spaces\n\n" + "".join(map(chr, range(32, 1024)))
        return fast if fast.encode_ordinary(probe) == self.tokenizer.encode(probe, add_special_tokens=False).ids else None

    def encode(self, text: str) -> bytes:
        if self.fast is None or _LONG_SPACE.search(text) or any(x in text for x in self.special):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        return np.array(self.fast.encode_ordinary(text), "<u4").tobytes()


def pack_block(lengths: list[int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int]]:
    """Pieces (document index, start, length, sequence, offset) of one block of documents."""
    out, rest, sequence = [], [], 0
    for i, n in enumerate(lengths):
        full = n // capacity
        out += [(i, j * capacity, capacity, sequence + j, 0) for j in range(full)]
        sequence += full
        if n % capacity:
            rest.append((n % capacity, i, full * capacity))
    rest.sort(key=lambda r: (-r[0], r[1]))
    need = -(-sum(r[0] for r in rest) // capacity)
    cost, used = np.zeros(need), np.zeros(need, np.int64)
    for n, i, start in rest:
        while n:
            room = capacity - used
            fits = room >= n
            if not fits.any():  # none holds it whole: cut at the cheapest
                fits = room > 0
            s = int(np.where(fits, cost, np.inf).argmin())
            take = min(n, int(room[s]))
            out.append((i, start, take, sequence + s, int(used[s])))
            n, start = n - take, start + take
            used[s] += take
            cost[s] += LINEAR * take + QUADRATIC * take * take
    return out


def _runs(docs: Iterator[tuple], ordered: bool) -> Iterator[Iterator[tuple]]:
    """Stretches of documents (id, ids, file, row) of one file in ascending order; one stretch of all if there is no order."""
    if not ordered:
        yield docs
        return
    number, last = 0, None

    def stretch(d):
        nonlocal number, last
        if last is not None and (d[2] != last[0] or d[3] <= last[1]):
            number += 1
        last = d[2], d[3]
        return number

    for _, run in itertools.groupby(docs, stretch):
        yield run


def ordered_base(file: int, row: int, sequences: int) -> int:
    """First identifier of a block's sequences, in the order of (file, row)."""
    if file >> FILE_BITS or row >> ROW_BITS or sequences >> COUNT_BITS:
        raise ValueError(f"file {file}, row {row}, {sequences} sequences: too large for an ordered identifier; write smaller or fewer files")
    return ((file << ROW_BITS) + row) << COUNT_BITS


def _pack(path: str, ranks_path: str | None, capacity: int, ordered: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer, base = TextTokenizer(path, ranks_path), TaskContext.get().partitionId() << 33
        end = np.array([END_ID], "<u4").tobytes()

        def encoded():
            for b in batches:
                for i, t, *place in zip(column(b, "id"), column(b, "t"), *[column(b, c) for c in ("file", "at") if ordered]):
                    yield i, tokenizer.encode(t or "") + end, *place

        for block in itertools.chain.from_iterable(blocks(r, lambda d: len(d[1]) // 4, BLOCK_TOKENS) for r in _runs(encoded(), ordered)):
            lengths = [len(d[1]) // 4 for d in block]
            pieces = pack_block(lengths, capacity)
            crc = [zlib.crc32(memoryview(block[i][1])[4 * s:4 * (s + n)]) for i, s, n, _, _ in pieces]
            doc, start, length, seq, offset = (np.array(x, np.int64) for x in zip(*pieces))
            if ordered:
                base = ordered_base(block[0][2], block[0][3], int(seq.max()) + 1)
            yield pa.RecordBatch.from_pydict({
                "doc_id": pa.array([block[i][0] for i in doc], pa.int64()), "start": start, "length": length,
                "ids_crc32": pa.array(crc, pa.int64()), "doc_tokens": np.array(lengths, np.int64)[doc],
                "sequence_id": base + seq, "offset": offset})
            base += int(seq.max()) + 1

    return run


def file_order(docs: DataFrame) -> tuple[Column, Column] | None:
    """(number of the file, row in it) for rows read from the files of one ordered write; None if they do not come from such files.

    Spark names the files it writes by partition. The names come from the listing that the
    scan holds anyway; no row is read.
    """
    found = [_PART.search(f) for f in docs.inputFiles()]
    if not found or None in found or len({int(m[1]) for m in found}) < len(found):
        return None
    try:
        meta = docs.metadataColumn("_metadata")
        place = F.regexp_extract(meta["file_name"], _PART.pattern, 1).cast("long"), meta["row_index"]
        docs.select(*place).schema  # resolved here: rows of a plan above the scan have no place
    except AnalysisException:
        return None
    return place


def pack_documents(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
                   capacity: int = CAPACITY, ranks_path: str | None = None, order: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``order``: two whole numbers per row, not null, that tell all rows apart and ascend
    within a partition's stretches; ``sequence_id`` then ascends with them from block to block.
    """
    short_batches(docs.sparkSession)
    place = () if order is None else (order[0].cast("long").alias("file"), order[1].cast("long").alias("at"))
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"), *place) \
        .mapInArrow(tidied(_pack(tokenizer_path, ranks_path, capacity, order is not None)), SCHEMA)
