"""Toxicity by a weighted finite-state pattern grammar.

A lexicon transducer rewrites the words of a clause as symbols (insult, threat, target,
negation, reported speech, other). A second one reads them from the end and marks the
insults that a target follows. Over the result run four small transducers, composed into
one automaton whose state is the tuple of theirs:

* target: an insult with a target before or after it in its clause weighs more, once;
* threat: a threat counts only with a target after it;
* negation: reaches over the next ``REACH`` words and takes most of the weight;
* reported speech: what follows a verb of saying in its clause keeps half of the weight.

A document's evidence is the sum of its clauses' weights; a logistic curve over its
logarithm, fitted on a bounded sample of labelled rows (``labelled.FIT_ROWS``), makes it
a score, so that much evidence still ranks above less. The labels add
word stems to the insults: beginnings of ``STEMS`` letters that mark toxic but hardly any
other labelled documents, so that inflected and joined words of any language match.
Labels, lang, source and identifiers are never inputs of a score.

Defined results: a text without a match (null and empty included) has the curve's lowest
value; with no labels or one class the curve and the lexicon are the fixed ones; repeated
rows are alike; an empty table stays empty.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from letramento.llm.common import short_batches
from letramento.llm.labelled import FIT_ROWS, fit_sample, held_out

THRESHOLD = 0.7
FOLDS, FOLD_OUT = 3, 1
# English words of each class.
INSULTS = """idiot idiots moron morons stupid dumb loser losers scum trash garbage worthless pathetic disgusting clown
    filthy vermin coward fool imbecile cretin ugly hateful""".split()
THREATS = "kill hurt destroy crush beat burn attack stab shoot punch smash".split()
TARGETS = "you your yours yourself u he she they them him her his their it this that these those everyone people".split()
NEGATIONS = "not no never neither nor isn't aren't wasn't don't doesn't didn't won't without".split()
REPORTS = "said says say told tells wrote writes quoted quotes called calls reported reportedly claimed claims alleged".split()
INSULT, THREAT, TARGET, NEGATION, REPORT = "I", "H", "T", "N", "R"
AIMED_INSULT = "A"
OTHER = "o"
REACH = 3
PLAIN, AIMED, THREATENED = 1.0, 1.5, 1.5
NEGATED, REPORTED = 0.3, 0.5
#: Learned stems: at least so many toxic labelled documents, and so large a share of the documents with the stem.
STEMS = range(4, 11)
LEAST_TOXIC, TOXIC_SHARE, MOST_STEMS = 6, 0.7, 4000
KNOWN_WORDS = 400_000
#: Slope and intercept of the curve where labels cannot fit one: one plain insult scores 0.82.
DEFAULT_CURVE = (5.77, -2.5)

_CLAUSE = re.compile(r"[.!?;:\n\r]+|\b(?:but|although|however)\b")
_WORD = re.compile(r"[^\W\d_]+(?:['’][^\W\d_]+)*")


def mark_aimed(symbols: list[str]) -> list[str]:
    """The transducer that reads from the end: an insult becomes an aimed one if a target follows in the clause."""
    out, followed = list(symbols), False
    for k in range(len(out) - 1, -1, -1):
        if out[k] == TARGET:
            followed = True
        elif followed and out[k] == INSULT:
            out[k] = AIMED_INSULT
    return out


def target_transducer(state, symbol):
    """Remembers that the clause addresses someone; weighs insults that a target comes before or (marked) after."""
    state = state or symbol == TARGET
    if symbol == AIMED_INSULT:
        return state, AIMED
    return state, (AIMED if state else PLAIN) if symbol == INSULT else 0.0


def threat_transducer(state, symbol):
    """A threat is open until a target follows."""
    if symbol == THREAT:
        return True, 0.0
    return (False, THREATENED) if state and symbol == TARGET else (state, 0.0)


def negation_transducer(state, symbol):
    """Words left within reach of a negation."""
    if symbol == NEGATION:
        return REACH, 1.0
    return max(0, state - 1), NEGATED if state else 1.0


def report_transducer(state, symbol):
    return state or symbol == REPORT, REPORTED if state else 1.0


START = (False, False, 0, False)


def step(state: tuple, symbol: str) -> tuple[tuple, float]:
    """The composed automaton: (state, symbol) -> (state, weight of what ends here)."""
    aim, insult = target_transducer(state[0], symbol)
    threat, threatened = threat_transducer(state[1], symbol)
    negation, negated = negation_transducer(state[2], symbol)
    report, reported = report_transducer(state[3], symbol)
    weight = (insult + threatened) * negated * reported  # no symbol has both
    return (aim, threat, negation, report), weight


class Lexicon(dict):
    """The lexicon transducer: word -> (symbol, strength); a word of no list that begins with a learned stem is an insult."""

    def __init__(self, stems: dict[str, float]):
        super().__init__()
        self.stems = stems
        self.fixed = {w: (s, 1.0) for s, words in ((TARGET, TARGETS), (NEGATION, NEGATIONS), (REPORT, REPORTS), (THREAT, THREATS),
                                                   (INSULT, INSULTS)) for w in words}

    def __reduce__(self):
        return Lexicon, (self.stems,)

    def __missing__(self, word: str) -> tuple[str, float]:
        if len(self) > KNOWN_WORDS:
            self.clear()
        found = self.fixed.get(word)
        if found is None:
            strength = max((self.stems.get(word[:n], 0.0) for n in STEMS), default=0.0)
            found = (INSULT, strength) if strength else (OTHER, 0.0)
        self[word] = found
        return found


class Grammar:
    def __init__(self, stems: dict[str, float] | None = None, curve: tuple[float, float] = DEFAULT_CURVE):
        self.lexicon = Lexicon(dict(stems or {}))
        self.curve = curve
        self._table: dict[tuple[tuple, str], tuple[tuple, float]] = {}

    def _step(self, state: tuple, symbol: str) -> tuple[tuple, float]:
        key = state, symbol
        if key not in self._table:
            self._table[key] = step(state, symbol)
        return self._table[key]

    def clause_weight(self, tagged: list[tuple[str, float]]) -> float:
        """Weight of one clause of (symbol, strength)."""
        state, total = START, 0.0
        for symbol, (_, strength) in zip(mark_aimed([s for s, _ in tagged]), tagged):
            state, weight = self._step(state, symbol)
            if weight:
                total += weight * (1.0 if symbol == TARGET else strength)  # a threat weighs where its target ends it
        return total

    def evidence(self, text: str | None) -> float:
        """Sum of the weights of a whole text's clauses."""
        if not text:
            return 0.0
        low, tag = text.lower(), self.lexicon.__getitem__
        if not any(tag(w)[0] in (INSULT, THREAT) for w in set(_WORD.findall(low))):
            return 0.0
        return sum(self.clause_weight([tag(w) for w in _WORD.findall(clause)]) for clause in _CLAUSE.split(low))

    def score(self, evidence: np.ndarray) -> np.ndarray:
        a, b = self.curve
        return 1 / (1 + np.exp(-(a * np.log1p(evidence) + b)))


def fit_curve(x: np.ndarray, y: np.ndarray, rounds: int = 50) -> tuple[float, float]:
    """Ridge-penalised logistic regression on the logarithm of the evidence by Newton steps; the slope is kept positive."""
    if not len(y) or y.min() == y.max():
        return DEFAULT_CURVE
    d, w = np.stack([np.log1p(x), np.ones(len(x))], 1), np.zeros(2)
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-d @ w))
        w = w + np.linalg.solve((d * (p * (1 - p))[:, None]).T @ d + np.diag([0.05, 0.05]), d.T @ (y - p) - 0.05 * w)
        w = np.clip(w, -20, 20)
    return (float(w[0]), float(w[1])) if w[0] > 0 else DEFAULT_CURVE


def fit_grammar(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", most: int = FIT_ROWS) -> Grammar:
    short_batches(docs.sparkSession)
    sample = fit_sample(docs, labels, "toxic", FOLDS, FOLD_OUT, id_col, text_col, most)
    stems = F.expr("array_distinct(flatten(array(" + ", ".join(
        f"transform(filter(w, x -> length(x) >= {n}), x -> substring(x, 1, {n}))" for n in STEMS) + ")))")
    counts = sample.select("y", F.array_distinct(F.split(F.lower("t"), r"[^\p{L}]+")).alias("w")) \
        .select("y", F.explode(stems).alias("s")).groupBy("s").agg(F.sum("y").alias("toxic"), F.count(F.lit(1)).alias("n")) \
        .where((F.col("toxic") >= LEAST_TOXIC) & (F.col("toxic") >= TOXIC_SHARE * F.col("n"))) \
        .orderBy(F.desc("toxic"), F.length("s"), "s").limit(MOST_STEMS).collect()
    grammar = Grammar({r.s: (r.toxic / (r.n + 1)) ** 8 for r in counts})  # doubtful stems count little

    @F.pandas_udf("double")
    def evidence(t: pd.Series) -> pd.Series:
        return pd.Series([grammar.evidence(x) for x in t])

    rows = sorted(tuple(r) for r in sample.select("id", "y", evidence("t")).collect())  # two numbers for each of FIT_ROWS rows
    x, y = np.array([r[2] for r in rows], float), np.array([r[1] for r in rows], float)
    return Grammar(grammar.lexicon.stems, fit_curve(x, y))


def score_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, held_out, score, predicted (1 from THRESHOLD on)."""
    grammar = fit_grammar(docs, labels, id_col, text_col)

    @F.pandas_udf("double")
    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for t in texts:
            yield pd.Series(grammar.score(np.array([grammar.evidence(x) for x in t], float)))

    return docs.select(F.col(f"`{id_col}`").alias(id_col), held_out(id_col, FOLDS, FOLD_OUT).alias("held_out"),
                       score(F.col(f"`{text_col}`")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
