"""Quality classifier: gradient-boosted trees over document statistics.

The statistics are shares and lengths of a whole text (letters, capitals, symbols,
distinct words and word pairs, repeated lines); Spark computes them in one pass, and
trees fitted on a bounded sample of labelled rows (``labelled.FIT_ROWS``) score every
document. Labels, lang, source and identifiers are never inputs.

Defined results: null counts as empty text, which has a score like any text; without
labelled rows every score is 1; repeated rows score alike; an empty table stays empty.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from letramento.llm.boosting import BoostedTrees
from letramento.llm.common import as_bytes, short_batches
from letramento.llm.labelled import FIT_ROWS, fit_sample, held_out

THRESHOLD = 0.3
FOLDS, FOLD_OUT = 5, 0
BYTE_CLASSES = (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" ", b"\n\r\t\x0b\x0c",
                b".,;:?'\"-()", b"!", b"|", b"#$%&*@^~+=<>_/\\`", b"[]{}", bytes(range(128, 256)))
_CLASS = np.array([[c in group for c in range(256)] for group in BYTE_CLASSES], float)


def statistics(text: str | None) -> list[float]:
    """Statistics of one whole text."""
    b = as_bytes(text)
    w, lines = b.split(), b.split(b"\n")
    n, k, m = max(1, len(b)), max(1, len(w)), len(lines)
    counts = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    shares = counts[counts > 0] / n
    lengths = list(map(len, w)) or [0]
    body = [x for x in lines if x.strip()]
    return [*(_CLASS @ counts / n), float(-(shares * np.log2(shares)).sum()), np.log1p(len(b)), np.log1p(len(w)), sum(lengths) / k,
            max(lengths), len(set(w)) / k, len(set(zip(w, w[1:]))) / k, sum(map(bytes.isupper, w)) / k,
            sum(map(bytes.islower, w)) / k, sum(map(bytes.isalpha, w)) / k, sum(x <= 3 for x in lengths) / k,
            np.log1p(m), len(set(body)) / max(1, len(body)), len(b) / m, max(map(len, lines)) / n]


def statistics_matrix(texts) -> np.ndarray:
    return np.array([statistics(t) for t in texts], float).reshape(len(texts), len(BYTE_CLASSES) + 15)


def fit_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                most: int = FIT_ROWS) -> BoostedTrees:
    """Trees fitted on the statistics of the labelled sample; only numbers reach the driver."""
    short_batches(docs.sparkSession)

    @F.pandas_udf("array<double>")
    def stats(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(list(statistics_matrix(t.tolist())))

    sample = fit_sample(docs, labels, "quality", FOLDS, FOLD_OUT, id_col, text_col, most)
    rows = sorted(tuple(r) for r in sample.select("id", "y", stats("t")).collect())
    x = np.array([r[2] for r in rows], float).reshape(len(rows), len(BYTE_CLASSES) + 15)
    return BoostedTrees().fit(x, np.array([r[1] for r in rows], float))


def quality_score(model: BoostedTrees, text_col: str = "text") -> Column:
    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(model.predict(statistics_matrix(t.tolist())))

    return score(F.col(f"`{text_col}`"))


def classify_quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (1 from THRESHOLD on)."""
    model = fit_quality(docs, labels, id_col, text_col)
    return docs.select(F.col(f"`{id_col}`").alias(id_col), held_out(id_col, FOLDS, FOLD_OUT).alias("held_out"),
                       quality_score(model, text_col).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows of ``docs`` that the classifier does not reject, with all their columns."""
    model = fit_quality(docs, labels, id_col, text_col)
    return docs.where(quality_score(model, text_col) >= THRESHOLD)
