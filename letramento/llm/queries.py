"""Queries of the corpus operators, each over the whole table it is meant for, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from letramento.llm.common import read_table
from letramento.llm.exact_dedup import content_sort_dedup
from letramento.llm.hpyp import score_texts
from letramento.llm.language import identify_languages
from letramento.llm.merkle import verify_manifest
from letramento.llm.mixing import mix_sources
from letramento.llm.neighbours import nearest
from letramento.llm.packing import pack_documents
from letramento.llm.quality import classify_quality
from letramento.llm.recompression import remove_repeats
from letramento.llm.resampling import resample
from letramento.llm.secrets import ALPHABET, ASSIGN, MARGIN, find_secrets, labelled_tokens, secret_digests
from letramento.llm.simhash import simhash_components
from letramento.llm.toxicity import score_toxicity


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read_table(spark, sf_dir, "documents"), shingle=3, max_distance=3)


def op2_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return identify_languages(read_table(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents"), window=13, with_text=False)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a whole row, moved to its place in the mix."""
    return mix_sources(read_table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(read_table(spark, sf_dir, "documents"), tokenizer_path(),
                          ranks_path=tokenizer_path("byte_bpe_50k.tiktoken"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return content_sort_dedup(read_table(spark, sf_dir, "documents"))


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"), with_rows=False)


def op12_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return secret_digests(find_secrets(docs, labelled_tokens(docs)))


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest of ``documents``, checked against texts that lost their line breaks where CRC-32 of the id is even."""
    text = F.replace(F.col("text"), F.lit("\n"), F.lit(""))
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return verify_manifest(read_table(spark, sf_dir, "documents"), {"text": text}, hit & (text != F.col("text")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_simhash, op2_language_model, op3_language, op4_substring_dedup, op5_toxicity, op6_quality, op7_neighbours,
              op8_mix, op9_packing, op10_exact_dedup, op11_resampling, op12_secrets, op13_manifest)
}

#: CRC-32 in SQL: the table of the reflected polynomial, by its rule, and the register over the bytes of a text.
CRC_TABLE = """crc AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([i], range(8)),
            lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab)"""


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, where ``crc`` is in scope."""
    return f"""xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(range(octet_length(encode({text}))),
            lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::BIGINT)),
            lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1])), 4294967295)"""


def _leaf(text: str) -> str:
    part = "coalesce(CAST(octet_length(encode({0})) AS VARCHAR) || ':' || {0}, '-')"
    return "sha256(" + " || ".join(part.format(x) for x in (
        "CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text)) + ")"


def _matches(kind: int, pattern: str, value: int = 0) -> str:
    """Matches of a pattern: document, kind, start, end (code points) and the value's text."""
    sql = "'" + pattern.replace("'", "''") + "'"
    return f"""SELECT row, kind, i AS k, list_sum(list_transform(g[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(f[1:i - 1], lambda x: length(x))), 0) AS b,
            length(f[i]) AS len, v[i] AS value
        FROM (SELECT row, {kind} AS kind, string_split_regex(t, {sql}) AS g, regexp_extract_all(t, {sql}) AS f, regexp_extract_all(t, {sql}, {value}) AS v FROM texts),
             unnest(range(1, len(f) + 1)) AS u(i)"""


SQL: dict[str, str] = {
    "op10_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
        SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
               doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
        FROM n WINDOW g AS (PARTITION BY norm)""",
    "op11_resampling": rf"""
        WITH {CRC_TABLE},
        texts AS (SELECT doc_id AS id, text, false AS aim FROM documents UNION ALL SELECT item_id, text, true FROM benchmark),
        lowered AS (SELECT id, aim, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM texts),
        found AS (SELECT id, aim, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS w FROM lowered),
        used AS (SELECT id, aim, w, count(*) AS c FROM found GROUP BY ALL),
        known AS (SELECT w, {crc32_sql("w")} % 10000 AS bucket FROM (SELECT DISTINCT w FROM used), crc),
        counts AS (SELECT bucket, coalesce(sum(c) FILTER (aim), 0)::DOUBLE AS t, coalesce(sum(c) FILTER (NOT aim), 0)::DOUBLE AS s
                   FROM used JOIN known USING (w) GROUP BY bucket),
        gains AS (SELECT bucket, floor(1000 * ln((t + 1) * (sum(s) OVER () + 10000) / ((s + 1) * (sum(t) OVER () + 10000))))::BIGINT AS gain FROM counts),
        weights AS (SELECT id, sum(c)::BIGINT AS n, sum(c * gain)::BIGINT AS weight
                    FROM used JOIN known USING (w) JOIN gains USING (bucket) WHERE NOT aim GROUP BY id),
        scored AS (SELECT doc_id, coalesce(n, 0) AS n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
                       (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
                   FROM documents LEFT JOIN weights ON id = doc_id),
        ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS k, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN k <= 10 * n // 100 THEN k END AS rank FROM scored LEFT JOIN ranked USING (doc_id)""",
    "op12_secrets": rf"""
        WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
        base AS (SELECT * FROM ({_matches(0, ASSIGN, 2)}) WHERE length(value) >= 8
                 UNION ALL SELECT * FROM ({_matches(1, "AKIA[A-Z0-9]+")}) WHERE len >= 16
                 UNION ALL SELECT * FROM ({_matches(2, "[0-9a-f]{32,}")})),
        known AS (SELECT token, max(random) AS random FROM (
                      SELECT unnest(regexp_extract_all(t, '[A-Za-z0-9+/_-]{{8,}}')) AS token, 0 AS random FROM texts
                      UNION ALL SELECT unnest(regexp_extract_all(value, '[A-Za-z0-9+/_-]{{8,}}')), 1 FROM base) GROUP BY token),
        plain AS (SELECT token FROM known WHERE random = 0),
        found AS (SELECT token FROM known WHERE random = 1),
        samples AS (SELECT token, 0 AS random FROM plain UNION ALL SELECT token, 1 FROM found
                    UNION ALL SELECT unnest([substr(base64(unhex(sha256(token))), 1, 32), substr(sha256(token), 1, 16), upper(substr(sha256(token), 17, 16))]), 1 FROM plain),
        pairs AS (SELECT random, CASE WHEN i > 1 THEN substr(token, i - 1, 1) ELSE '' END AS a, substr(token, i, 1) AS b
                  FROM (SELECT token, random, unnest(range(1, length(token) + 1)) AS i FROM samples)),
        counts AS (SELECT a, b, count(*) FILTER (random = 1) AS r, count(*) FILTER (random = 0) AS o FROM pairs GROUP BY ALL),
        froms AS (SELECT a, sum(r)::DOUBLE AS r, sum(o)::DOUBLE AS o FROM counts GROUP BY a),
        chars AS (SELECT unnest(string_split('{ALPHABET}', '')) AS c),
        ratios AS (SELECT x.a, y.c AS b, floor(1000 * ln((coalesce(n.r, 0) + 1) * (coalesce(f.o, 0) + {len(ALPHABET)})
                          / ((coalesce(n.o, 0) + 1) * (coalesce(f.r, 0) + {len(ALPHABET)}))))::BIGINT AS ratio
                   FROM (SELECT c AS a FROM chars UNION ALL SELECT '') x, chars y LEFT JOIN counts n ON n.a = x.a AND n.b = y.c LEFT JOIN froms f ON f.a = x.a),
        long AS ({_matches(3, "[A-Za-z0-9+/_-]{20,}")}),
        scored AS (SELECT q.row, q.kind, q.k, q.b, q.len, sum(r.ratio) AS ratio FROM (
                       SELECT *, CASE WHEN i > 1 THEN substr(value, i - 1, 1) ELSE '' END AS x, substr(value, i, 1) AS y
                       FROM (SELECT *, unnest(range(1, len + 1)) AS i FROM long)) q JOIN ratios r ON r.a = q.x AND r.b = q.y GROUP BY ALL),
        spans AS (SELECT row, kind, b, len FROM base UNION ALL SELECT row, kind, b, len FROM scored WHERE ratio >= {MARGIN}),
        named AS (SELECT *, ['assign', 'access', 'hex', 'random'][kind + 1] || ':' || CAST(b AS BIGINT) || ':' || CAST(b + len AS BIGINT) AS span FROM spans),
        each AS (SELECT row, count(*) FILTER (kind = 0) AS a, count(*) FILTER (kind = 1) AS c, count(*) FILTER (kind = 2) AS h, count(*) FILTER (kind = 3) AS m,
                        coalesce(string_agg(span, ',' ORDER BY b, kind) FILTER (kind < 3), '') AS own, string_agg(span, ',' ORDER BY b, kind) AS every FROM named GROUP BY row)
        SELECT doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex, coalesce(m, 0) AS n_random,
               sha256(coalesce(own, '')) AS base_sha256, coalesce(every, '') AS spans FROM texts LEFT JOIN each USING (row)""",
    "op13_manifest": rf"""
        WITH RECURSIVE {CRC_TABLE},
        rows AS (SELECT doc_id, source, {_leaf("text")} AS leaf, {_leaf("replace(text, chr(10), '')")} AS other,
                        {crc32_sql("CAST(doc_id AS VARCHAR)")} % 2 = 0 AS hit FROM documents, crc),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS r,
                          count(*) OVER (PARTITION BY source) AS n FROM rows),
        lv AS (SELECT source, 0 AS lvl, r AS idx, leaf AS digest, n FROM ranked
               UNION ALL
               SELECT source, lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
               FROM lv WHERE n > 1 GROUP BY source, lvl, n, idx // 3),
        sub AS (SELECT source, digest AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS r,
                       count(*) OVER () AS n FROM lv WHERE n = 1),
        tv AS (SELECT 0 AS lvl, r AS idx, subroot AS digest, n FROM sub
               UNION ALL
               SELECT lvl + 1, idx // 3, sha256(string_agg(digest, '' ORDER BY idx)), (n + 2) // 3
               FROM tv WHERE n > 1 GROUP BY lvl, n, idx // 3),
        step AS (SELECT d.source, d.r, a.lvl AS ord, coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < a.idx), '') AS before,
                        coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > a.idx), '') AS after
                 FROM ranked d JOIN lv a ON a.source IS NOT DISTINCT FROM d.source AND a.idx = d.r // CAST(3 ** a.lvl AS BIGINT) AND a.n > 1
                 JOIN lv s ON s.source IS NOT DISTINCT FROM a.source AND s.lvl = a.lvl AND s.idx // 3 = a.idx // 3
                 GROUP BY ALL
                 UNION ALL
                 SELECT d.source, d.r, 100 + a.lvl, coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx < a.idx), ''),
                        coalesce(string_agg(s.digest, '' ORDER BY s.idx) FILTER (s.idx > a.idx), '')
                 FROM ranked d JOIN sub b ON b.source IS NOT DISTINCT FROM d.source
                 JOIN tv a ON a.idx = b.r // CAST(3 ** a.lvl AS BIGINT) AND a.n > 1
                 JOIN tv s ON s.lvl = a.lvl AND s.idx // 3 = a.idx // 3 GROUP BY d.source, d.r, a.lvl, a.idx),
        steps AS (SELECT *, row_number() OVER (PARTITION BY source, r ORDER BY ord) AS k FROM step),
        folded AS (SELECT source, r, 0 AS k, CASE WHEN hit THEN other ELSE leaf END AS cur FROM ranked
                   UNION ALL
                   SELECT f.source, f.r, f.k + 1, sha256(s.before || f.cur || s.after)
                   FROM folded f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.r = f.r AND s.k = f.k + 1),
        ends AS (SELECT source, r, max_by(cur, k) AS folded_root FROM folded GROUP BY ALL),
        proofs AS (SELECT source, r, sha256(string_agg(before || after, '' ORDER BY k)) AS proof FROM steps GROUP BY ALL)
        SELECT d.doc_id, d.leaf, b.subroot, t.digest AS root, coalesce(p.proof, sha256('')) AS proof_sha256, e.folded_root,
               e.folded_root = t.digest AS verified
        FROM ranked d JOIN sub b ON b.source IS NOT DISTINCT FROM d.source JOIN tv t ON t.n = 1
        JOIN ends e ON e.source IS NOT DISTINCT FROM d.source AND e.r = d.r
        LEFT JOIN proofs p ON p.source IS NOT DISTINCT FROM d.source AND p.r = d.r""",
}
