"""Language identification with a string kernel.

Two texts are alike by the n-grams (1 to 3 letters, blended) that both contain, however
often: k(x, y) = |G(x) & G(y)| / sqrt(|G(x)| |G(y)|). The n-grams are those of the
landmarks, texts of the learning fold spread over the languages. One-versus-rest kernel
ridge regression in the Nystroem form is fitted on a bounded sample (``FIT_TEXTS`` identifiers,
one text each, dealt to the languages in turn); all
texts are scored whole, in batches, by one matrix product with the landmarks and one
with the weights. Only text is an input of a prediction.

Defined results: ``und`` with score 0 for null text, text without a letter, and all texts if
nothing was learned; an n-gram never seen in a landmark is left out; ties go to the
language that sorts first; repeated rows are alike; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from letramento.llm.common import as_bytes, short_batches
from letramento.llm.labelled import held_out, one_text_each

FOLDS, FOLD_OUT = 4, 2
LANDMARKS = 96
FIT_TEXTS = 6_000
RIDGE = 1e-2
UNKNOWN = "und"
_LETTER = re.compile(r"[^\W\d_]")
#: Letters a-z and bytes of other scripts keep a code of their own; all else is a gap.
_CODE = np.array([b - 96 if 97 <= b <= 122 else b - 100 if b >= 128 else 0 for b in range(256)], np.uint32)


def has_letter(text: str | None) -> bool:
    """Whether a character of a letter category is in the text (``\\w`` also holds numerals such as one half)."""
    return text is not None and any(m[0].isalpha() for m in _LETTER.finditer(text))


def grams(text: str | None) -> list[np.ndarray]:
    """Codes of all 1-, 2- and 3-grams of a whole text, with repeats."""
    c = _CODE[np.frombuffer(as_bytes(text and text.lower()), np.uint8)]
    return [c, c[:-1] | (c[1:] + 1) << 8, c[:-2] | (c[1:-1] + 1) << 8 | (c[2:] + 1) << 16]


class KernelModel:
    def __init__(self, languages: list[str], landmark_grams: list[np.ndarray]):
        self.languages = languages
        self.codes = np.unique(np.concatenate(landmark_grams)).astype(np.uint32)
        marks = np.zeros((len(landmark_grams), len(self.codes)), np.float32)
        for m, g in zip(marks, landmark_grams):
            m[np.searchsorted(self.codes, g)] = 1
        self.marks = marks / np.sqrt(np.maximum(marks.sum(1, keepdims=True), 1))
        self.weights = np.zeros((len(marks), len(languages)))
        self._slot = None

    def __getstate__(self):
        return {**self.__dict__, "_slot": None}

    def kernel(self, texts: list[str | None]) -> np.ndarray:
        """Kernel of each text with each landmark."""
        if self._slot is None:  # code -> column; column 0 takes what no landmark has
            self._slot = np.zeros(1 << 24, np.uint16 if len(self.codes) < 65_535 else np.uint32)
            self._slot[self.codes] = np.arange(1, len(self.codes) + 1)
        seen = np.zeros((len(texts), len(self.codes) + 1), np.float32)
        for row, t in zip(seen, texts):
            for g in grams(t):
                row[self._slot[g]] = 1
        seen = seen[:, 1:]
        return (seen @ self.marks.T) / np.sqrt(np.maximum(seen.sum(1, keepdims=True), 1))

    def fit(self, kernel: np.ndarray, languages: list[str]) -> "KernelModel":
        """One-versus-rest ridge regression; languages weigh alike."""
        y = np.array([[x == lang for lang in self.languages] for x in languages], float)
        w = (y / np.maximum(y.sum(0), 1)).sum(1, keepdims=True)
        k = kernel.astype(float)
        gram = (self.marks @ self.marks.T).astype(float)
        self.weights = np.linalg.solve(k.T @ (w * k) + RIDGE * (gram + 1e-6 * np.eye(len(gram))) / len(gram), k.T @ (w * y))
        return self

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        value = np.clip(self.kernel(texts) @ self.weights, 0, 1)
        best = value.argmax(1)
        letter = np.array([has_letter(t) for t in texts], bool)
        return ([self.languages[b] if ok else UNKNOWN for b, ok in zip(best, letter)], np.where(letter, value.max(1), 0.0))


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> KernelModel | None:
    """A model learned from texts and languages outside the held-out fold; None if there are none."""
    short_batches(docs.sparkSession)
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").alias("t"), F.col(f"`{lang_col}`").alias("lang"))
    known = rows.where(F.col("lang").isNotNull() & ~held_out("id", FOLDS, FOLD_OUT) & F.col("t").rlike(r"\p{L}"))
    each = known.groupBy("id").agg(F.min("lang").alias("lang"))
    turn = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("id"), "id"))  # languages take turns
    picked = each.withColumn("turn", turn).where(F.col("turn") <= FIT_TEXTS).orderBy("turn", "lang").limit(FIT_TEXTS).collect()
    if not picked:
        return None
    languages = sorted({r.lang for r in picked})
    spark = docs.sparkSession

    @F.pandas_udf("array<long>")
    def distinct(t: pd.Series) -> pd.Series:
        return pd.Series([np.unique(np.concatenate(grams(x))).astype(np.int64) for x in t])

    chosen = spark.createDataFrame([(r.id, r.lang, k < LANDMARKS) for k, r in enumerate(picked)], "id long, lang string, landmark boolean")
    sample = one_text_each(known, chosen)  # one text for each of at most FIT_TEXTS identifiers
    landmarks = sample.where("landmark").select("id", distinct("t").alias("g")).collect()
    model = KernelModel(languages, [np.array(r.g, np.int64) for r in sorted(landmarks, key=lambda r: r.id)])

    @F.pandas_udf("array<double>")
    def kernel(t: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for x in t:
            yield pd.Series(list(model.kernel(x.tolist()).astype(float)))

    fit = sorted(sample.select("id", "lang", kernel("t").alias("k")).collect(), key=lambda r: r.id)  # LANDMARKS numbers each
    return model.fit(np.array([r.k for r in fit]), [r.lang for r in fit])


def identify_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """One row per row of ``docs``: id, held_out, lang_pred, score."""
    model = fit_languages(docs, id_col, text_col, lang_col)

    @F.pandas_udf("lang_pred string, score double")
    def predict(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for t in texts:
            lang, score = model.predict(t.tolist()) if model else ([UNKNOWN] * len(t), np.zeros(len(t)))
            yield pd.DataFrame({"lang_pred": lang, "score": score})

    return docs.select(F.col(f"`{id_col}`").alias(id_col), held_out(id_col, FOLDS, FOLD_OUT).alias("held_out"),
                       predict(F.col(f"`{text_col}`")).alias("p")).select(id_col, "held_out", "p.lang_pred", "p.score")
