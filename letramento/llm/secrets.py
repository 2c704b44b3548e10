"""Secrets in texts: fixed patterns, and strings that look random to character Markov models.

Patterns give the spans of three kinds (``assign``, ``access``, ``hex``). A further kind,
``random``, is every run of at least ``LONG`` characters of ``ALPHABET`` for which a
first-order Markov model of random strings beats one of ordinary identifiers by
``MARGIN`` (log-likelihood ratio in thousandths of a nat, summed over the characters).

The models learn from labelled samples (token, random). ``labelled_tokens`` makes them
from a table of texts: its distinct tokens are ordinary, unless they are a value that a
pattern found somewhere; for each ordinary token a random string is made from its
SHA-256, in base 64 and in upper and lower hex. All distinct tokens are learnt from, as
counts of character pairs, and all texts are searched, whole.

Only DataFrame functions: where a pattern matches, the parts between matches and the
matches themselves give the places, by prefix sums over blocks of the square root of
their number (a sum that grows an array one by one would cost its square). Spans count
code points, ends are exclusive. Nothing is shuffled but distinct tokens; the driver
receives one number per pair of characters.

Defined results: a null text counts as empty and has no spans; repeated rows and
identifiers give a row each; a table without labelled tokens adds no ``random`` span.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Keywords, prefixes, classes and least lengths of the patterns, in the order of the kinds.
KEYWORDS = ("password", "passwd", "secret", "token", "api_?key")
VALUE = "[A-Za-z0-9+/_.=-]+"
LEAST_VALUE = 8
ACCESS, LEAST_ACCESS = "AKIA[A-Z0-9]+", 16
HEX, LEAST_HEX = "[0-9a-f]", 32
KINDS = ("assign", "access", "hex", "random")
ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-"

#: Characters of a learnt token at least, and of a candidate at least.
SHORT, LONG = 8, 20
#: Log-likelihood ratio, in thousandths of a nat, from which a candidate is a secret.
MARGIN = 10_000


def any_case(pattern: str) -> str:
    """A pattern that matches ASCII letters of ``pattern`` in either case."""
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isascii() and c.isalpha() else c for c in pattern)


ASSIGN = "(" + "|".join(map(any_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?(""" + VALUE + ")"
_CLASS = "[A-Za-z0-9+/_-]"


def _run(least: int) -> str:
    return f"(?<!{_CLASS}){_CLASS}{{{least},}}"


def _places(found: str, gaps: str) -> Column:
    """(start, end) of each match, from the matches and the parts of the text around them."""
    sizes = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("g"), F.length(m).alias("m")))
    step = F.greatest(F.lit(1), F.ceil(F.sqrt(F.size(found))).cast("int"))
    part = F.transform(F.sequence(F.lit(0), F.size(found) - 1, step), lambda s: F.slice(sizes, s + 1, step))
    none = F.array().cast("array<struct<start:int,end:int>>")
    local = F.transform(part, lambda p: F.aggregate(p, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda a, x: F.struct(
        (a.at + x.g + x.m).alias("at"),
        F.concat(a.out, F.array(F.struct((a.at + x.g).alias("start"), (a.at + x.g + x.m).alias("end")))).alias("out"))))
    moved = F.aggregate(local, F.struct(F.lit(0).alias("at"), none.alias("out")), lambda a, p: F.struct(
        (a.at + p.at).alias("at"),
        F.concat(a.out, F.transform(p.out, lambda x: F.struct((x.start + a.at).alias("start"), (x.end + a.at).alias("end")))).alias("out")))
    return moved.out


def _spans(kind: str, found: str, places: str, keep) -> Column:
    """(start, kind's number, end) of the matches for which ``keep(match number)`` holds."""
    number = F.lit(KINDS.index(kind))
    kept = F.filter(F.transform(places, lambda p, i: F.struct(p.start.alias("start"), number.alias("kind"), p.end.alias("end"), keep(i).alias("keep"))),
                    lambda s: s.keep)
    every = F.transform(kept, lambda s: F.struct(s.start.alias("start"), s.kind.alias("kind"), s.end.alias("end")))
    return F.coalesce(F.when(F.size(found) > 0, every), F.array().cast("array<struct<start:int,kind:int,end:int>>"))


def log_ratio(token: Column, table: Column) -> Column:
    """Log-likelihood ratio of a token over ``ALPHABET``, in thousandths of a nat."""
    width = len(ALPHABET) + 1
    start = F.struct(F.lit(0).alias("at"), F.lit(0).cast("bigint").alias("sum"))

    def step(a: Column, c: Column) -> Column:
        to = F.instr(F.lit(ALPHABET), c)
        return F.struct(to.alias("at"), (a["sum"] + F.get(table, a["at"] * width + to)).alias("sum"))

    return F.aggregate(F.split(token, ""), start, step)["sum"]


def ratio_table(samples: DataFrame) -> Column:
    """The models of (token, random): log ratios of all transitions, from the start (0) or a character to a character."""
    chars = samples.where(F.length("token") > 0).select("random", F.split("token", "").alias("c"))
    pairs = chars.select("random", F.explode(F.arrays_zip(F.concat(F.array(F.lit("")), F.slice("c", 1, F.size("c") - 1)).alias("a"), F.col("c").alias("b"))).alias("p"))
    counts = {(random, a, b): n for random, a, b, n in
              pairs.groupBy("random", "p.a", "p.b").count().collect()}  # at most two per pair of characters
    sums: dict = {}
    for (random, a, _), n in counts.items():
        sums[random, a] = sums.get((random, a), 0) + n
    k, table = len(ALPHABET), []
    for a in ("", *ALPHABET):
        table.append(0)  # nothing leads to the start
        for b in ALPHABET:
            r, o = counts.get((True, a, b), 0), counts.get((False, a, b), 0)
            table.append(math.floor(1000 * math.log((r + 1) * (sums.get((False, a), 0) + k) / ((o + 1) * (sums.get((True, a), 0) + k)))))
    return F.split(F.lit(",".join(map(str, table))), ",").cast("array<int>")


def labelled_tokens(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(token, random): all distinct tokens of a table, and the random strings made from the ordinary ones."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    every = lambda pattern, group=0: F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    values = F.concat(F.filter(every(ASSIGN, 2), lambda v: F.length(v) >= LEAST_VALUE), every(f"{ACCESS[:-1]}{{{LEAST_ACCESS - 4},}}"),
                      every(f"{HEX}{{{LEAST_HEX},}}"))
    parts = F.flatten(F.transform(values, lambda v: F.regexp_extract_all(v, F.lit(_run(SHORT)), F.lit(0))))
    tokens = docs.select(F.concat(F.transform(every(_run(SHORT)), lambda t: F.struct(t.alias("token"), F.lit(False).alias("random"))),
                                  F.transform(parts, lambda t: F.struct(t.alias("token"), F.lit(True).alias("random")))).alias("s")) \
        .select(F.inline("s")).groupBy("token").agg(F.max("random").alias("random"))
    sha = F.sha2("token", 256)
    labelled = lambda token, random: F.struct(token.alias("token"), F.lit(random).alias("random"))
    made = [F.substring(F.base64(F.unhex(sha)), 1, 32), F.substring(sha, 1, 16), F.upper(F.substring(sha, 17, 16))]
    return tokens.select(F.inline(F.when(F.col("random"), F.array(labelled(F.col("token"), True))).otherwise(
        F.array(labelled(F.col("token"), False), *[labelled(m, True) for m in made]))))


def find_secrets(docs: DataFrame, samples: DataFrame, id_col: str = "doc_id", text_col: str = "text", margin: int = MARGIN) -> DataFrame:
    """One row per row of ``docs``: id, spans (array of start, kind, end; by start, then kind; kinds count in ``KINDS``)."""
    table = ratio_table(samples)
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("t"))
    # Runs of a class need no filter on their length after the match: a run's least length can stand in the pattern.
    patterns = {"assign": ASSIGN, "access": f"{ACCESS[:-1]}{{{LEAST_ACCESS - 4},}}", "hex": f"{HEX}{{{LEAST_HEX},}}", "random": _run(LONG)}
    rows = rows.select("*", *[F.regexp_extract_all("t", F.lit(p), F.lit(0)).alias(f"{k}_found") for k, p in patterns.items()])
    rows = rows.select("*", *[F.when(F.size(f"{k}_found") > 0, F.split("t", p, -1)).alias(f"{k}_gaps") for k, p in patterns.items()],
                       F.when(F.size("assign_found") > 0, F.regexp_extract_all("t", F.lit(ASSIGN), F.lit(2))).alias("assign_values")).drop("t")
    rows = rows.select("*", *[F.when(F.size(f"{k}_found") > 0, _places(f"{k}_found", f"{k}_gaps")).alias(f"{k}_at") for k in patterns])
    keep = {"assign": lambda i: F.length(F.get("assign_values", i)) >= LEAST_VALUE,
            "random": lambda i: log_ratio(F.get("random_found", i), table) >= margin}
    spans = [_spans(k, f"{k}_found", f"{k}_at", keep.get(k, lambda i: F.lit(True))) for k in patterns]
    return rows.select(F.col("id").alias(id_col), F.sort_array(F.concat(*spans)).alias("spans"))


def span_text(spans: Column) -> Column:
    """``kind:start:end`` of all spans, joined by commas."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s.kind), s.start, s.end)), ",")


def redact(docs: DataFrame, samples: DataFrame, text_col: str = "text", mask: str = "*", margin: int = MARGIN) -> DataFrame:
    """``docs`` with every character of a span replaced by ``mask``; null texts stay null."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    found = find_secrets(docs.select(row, F.col(f"`{text_col}`").alias("text")), samples, "row", "text", margin)
    text = F.col(f"row.`{text_col}`")
    whole = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))
    cut = F.aggregate("spans", whole, lambda a, s: F.struct(
        F.greatest(a.at, s.end).alias("at"),
        F.concat(a.parts, F.array(F.substring(text, a.at + 1, F.greatest(F.lit(0), s.start - a.at)),
                                  F.repeat(F.lit(mask), F.greatest(F.lit(0), s.end - F.greatest(a.at, s.start))))).alias("parts")))
    masked = F.when(F.size("spans") == 0, text).otherwise(F.concat(F.array_join(cut.parts, ""), F.substring(text, cut.at + 1, F.length(text))))
    return found.select(*[(F.when(text.isNotNull(), masked) if c == text_col else F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def secret_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts per pattern, digest of the patterns' spans, all spans as text."""
    count = lambda k: F.size(F.filter("spans", lambda s: s.kind == KINDS.index(k))).cast("long")
    base = F.filter("spans", lambda s: s.kind < KINDS.index("random"))
    return found.select(F.col(id_col), *[count(k).alias(f"n_{k}") for k in KINDS], F.sha2(span_text(base), 256).alias("base_sha256"),
                        span_text(F.col("spans")).alias("spans"))
