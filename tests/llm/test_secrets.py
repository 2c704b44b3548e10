"""Secret spans against Python's regular expressions and a direct evaluation of the models."""

import base64
import collections
import hashlib
import math
import random
import re

from pyspark.sql import functions as F

from letramento.llm import secrets
from letramento.llm.common import read_table

PATTERNS = (("assign", re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A), 2, 8),
            ("access", re.compile("AKIA[A-Z0-9]+"), 0, 16), ("hex", re.compile("[0-9a-f]+"), 0, 32))
TOKEN = re.compile("[A-Za-z0-9+/_-]+")
CLASHES = ("id", "t", "token", "random", "spans", "row", "a", "b", "c", "p", "n", "assign_found", "hex_gaps", "random_at", "assign_values", "kind", "start", "end")


def base_spans(text):
    return [(m.start(), k, m.end()) for k, (_, p, group, least) in enumerate(PATTERNS) for m in p.finditer(text or "") if len(m[group]) >= least]


def model(samples):
    counts = {y: collections.Counter() for y in (True, False)}
    sums = {y: collections.Counter() for y in (True, False)}
    for token, y in samples:
        for a, b in zip(" " + token, token):
            counts[y][a, b] += 1
            sums[y][a] += 1
    k = len(secrets.ALPHABET)

    def ratio(token):
        return sum(math.floor(1000 * math.log((counts[True][a, b] + 1) * (sums[False][a] + k) / ((counts[False][a, b] + 1) * (sums[True][a] + k))))
                   for a, b in zip(" " + token, token))

    return ratio


def all_spans(text, ratio, margin=secrets.MARGIN):
    extra = [(m.start(), 3, m.end()) for m in TOKEN.finditer(text or "") if len(m[0]) >= secrets.LONG and ratio(m[0]) >= margin]
    return sorted(base_spans(text) + extra)


def brute_samples(texts):
    values = {p for t in texts for a, k, b in base_spans(t) for p in TOKEN.findall(PATTERNS[0][1].match(t[a:b])[2] if k == 0 else t[a:b]) if len(p) >= 8}
    plain = {x for t in texts for x in TOKEN.findall(t or "") if len(x) >= 8} - values
    out = [(x, True) for x in values]
    for x in plain:
        sha = hashlib.sha256(x.encode())
        out += [(x, False), (base64.b64encode(sha.digest()).decode()[:32], True), (sha.hexdigest()[:16], True), (sha.hexdigest()[16:32].upper(), True)]
    return out


def test_spans_equal_brute_force(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    texts = [r.text for r in docs.collect()]
    samples = secrets.labelled_tokens(docs)
    want = brute_samples(texts)
    assert sorted((r.token, r.random) for r in samples.collect()) == sorted(want)
    ratio = model(want)
    found = secrets.find_secrets(docs, samples).join(docs, "doc_id").collect()
    assert len(found) == len(texts)
    for r in found:
        assert [tuple(s) for s in r.spans] == all_spans(r.text, ratio)


def test_odd_texts(spark):
    key = "AKIA" + "Q7" * 8
    texts = ["token: secret: abcdefghij", "PASSWORD='a.b=c/d+e-f_g'", "api_key=12345678 apikey = short", "x" * 31 + "f" * 31, "é" * 5 + "deadbeef" * 4 + "é", key, key[:15],
             "AKIA" * 9, "token=token=abcdefgh", "secret\n=abcdefghi", "passwd\":  \"12345678", "toKen=abcdefghij ſecret=abcdefghij", None, "", " \n ",
             "😀 token = abcdefgh😀" * 40, "0" * 300_000, ("ab12" * 9 + " ") * 3000, "word " * 100_000, "token==12345678", "A" * 20 + "-" + "b" * 20]
    rows = [(i % 9 if i % 5 else None, t, None, "s", 1) for i, t in enumerate(texts + texts[:3])]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long") \
        .withColumns({c: F.lit(None if i % 2 else c) for i, c in enumerate(CLASHES)})
    labelled = [("ordinaryWord", False), ("q7Zx90Lk", True)]
    samples = spark.createDataFrame(labelled, "token string, random boolean")
    ratio = model(labelled)
    got = sorted((r.doc_id is None, r.doc_id, tuple(map(tuple, r.spans))) for r in secrets.find_secrets(df, samples, margin=0).collect())
    assert got == sorted((i is None, i, tuple(all_spans(t, ratio, 0))) for i, t, *_ in rows)
    digests = secrets.secret_digests(secrets.find_secrets(df.where("text = ''"), samples)).first()
    assert digests.spans == "" and digests.base_sha256 == hashlib.sha256(b"").hexdigest() and digests.n_assign == 0
    assert secrets.find_secrets(df.where("false"), secrets.labelled_tokens(df.where("false"))).count() == 0
    none = secrets.find_secrets(df, samples.where("false"), margin=1)
    assert not [s for r in none.collect() for s in r.spans if s.kind == 3]


def test_models_tell_random_strings_from_identifiers(spark):
    """Held out: tokens of another table, and random strings of another generator."""
    docs = read_table(spark, "/root/testdata/sf0.01", "documents")
    rng = random.Random(7)
    names = ["getUserAccountByIdentifier", "application_configuration_path", "org/apache/spark/sql/functions", "NullPointerExceptionHandler", "very-long-css-class-name-here"]
    secret = ["".join(rng.choice(c) for _ in range(32)) for c in ("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "0123456789ABCDEF", "0123456789abcdef") for _ in range(100)]
    plain = [r.t for r in read_table(spark, "/root/testdata/sf0.1", "documents").selectExpr("explode(regexp_extract_all(text, '[A-Za-z]{20,}', 0)) t").distinct().collect()]
    texts = spark.createDataFrame([(i, f"see {t} there") for i, t in enumerate(secret + names + plain)], "doc_id long, text string")
    hit = {r.doc_id for r in secrets.find_secrets(texts, secrets.labelled_tokens(docs)).collect() if any(s.kind == 3 for s in r.spans)}
    assert len(hit & set(range(len(secret)))) >= 0.97 * len(secret)
    assert len(plain) > 20 and len(hit - set(range(len(secret)))) <= 0.02 * (len(names) + len(plain))


def test_redaction_masks_spans_only(spark):
    rows = [(1, "my token = abcdefgh12, AKIA" + "Z9" * 8 + " end", "x"), (2, None, "y"), (3, "clean", "z"), (4, "token=" + "deadbeef" * 5, "w")]
    samples = spark.createDataFrame([("ordinaryWord", False)], "token string, random boolean")
    got = secrets.redact(spark.createDataFrame(rows, "doc_id long, text string, row string"), samples, margin=10**9).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == [(1, "my " + "*" * 18 + ", " + "*" * 20 + " end", "x"), (2, None, "y"), (3, "clean", "z"), (4, "*" * 46, "w")]


def test_the_plan_is_native(spark):
    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    plan = secrets.secret_digests(secrets.find_secrets(docs, secrets.labelled_tokens(docs)))._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "Exchange"))
