"""The registered queries of the training-data operators and, where SQL can say it, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from isohyet.llm import backoff, collocations, common, decontamination, divergence, lines, packing, phrases, quality, simhash, sitetree, sketches, suffixes, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    common.ship(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return common.spread(df) if name in ("documents", "pages") else df


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontamination.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("text_key", "hits")


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.remove_phrases(_table(spark, sf_dir, "documents")).drop("text")


def op5_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.remove_substrings(_table(spark, sf_dir, "documents")).drop("text")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("text_key")


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sketches.fingerprint_report(_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff.score_corpus(_table(spark, sf_dir, "documents"))


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sitetree.extract(_table(spark, sf_dir, "pages"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(_table(spark, sf_dir, "documents"))


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.drop_repeated_lines(_table(spark, sf_dir, "documents")).withColumn("kept_sha256", F.sha2("text", 256)).drop("text")


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_packing": op1_packing,
    "op2_decontamination": op2_decontamination,
    "op3_simhash": op3_simhash,
    "op4_phrases": op4_phrases,
    "op5_suffixes": op5_suffixes,
    "op6_warc": op6_warc,
    "op7_quality": op7_quality,
    "op8_fingerprints": op8_fingerprints,
    "op9_lm_scoring": op9_lm_scoring,
    "op10_html": op10_html,
    "op11_collocations": op11_collocations,
    "op12_lines": op12_lines,
    "op13_divergence": op13_divergence,
}
_FOLDED = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_DIGEST_WORD, _SPACE_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", r"[^\x20\x09-\x0D]+"

_OP2 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all({_FOLDED}, '{_DIGEST_WORD}') AS w FROM documents),
b AS (SELECT item_id, w, least(len(w), 13) AS n FROM (SELECT item_id, regexp_extract_all({_FOLDED}, '{_DIGEST_WORD}') AS w FROM benchmark) WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, n, UNNEST(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win FROM b),
bg AS (SELECT n, win, list(item_id) AS items FROM bw GROUP BY 1, 2),
sizes AS (SELECT DISTINCT n FROM b),
dw AS (SELECT doc_id, n, UNNEST(range(1, len(w) - n + 2)) AS i, UNNEST(list_transform(range(1, len(w) - n + 2), lambda i: array_to_string(w[i:i + n - 1], ' '))) AS win FROM d, sizes WHERE len(w) >= n),
hit AS (SELECT doc_id, n, i, items FROM dw JOIN bg USING (n, win)),
cover AS (SELECT doc_id, COUNT(DISTINCT p) AS n_hit FROM (SELECT doc_id, UNNEST(range(i, i + n)) AS p FROM hit) GROUP BY 1),
found AS (SELECT doc_id, COUNT(*) AS n_items, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, CAST(UNNEST(items) AS VARCHAR) AS item FROM hit) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, COALESCE(n_hit, 0) AS n_hit, COALESCE(n_items, 0) AS n_items, sha256(COALESCE(names, '')) AS items_sha256,
 COALESCE(n_hit, 0) > 0 AND 20 * COALESCE(n_hit, 0) >= len(w) AS contaminated FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN found USING (doc_id)"""

_OP4 = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(COALESCE(text, ''), '{_SPACE_WORD}') AS w FROM documents),
win AS (SELECT doc_id, UNNEST(range(1, len(w) - 18)) AS i, UNNEST(list_transform(range(1, len(w) - 18), lambda i: array_to_string(w[i:i + 19], ' '))) AS win FROM d WHERE len(w) >= 20),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY win ORDER BY doc_id, i) AS k FROM win) WHERE k > 1),
gone AS (SELECT doc_id, list(DISTINCT p) AS p FROM (SELECT doc_id, UNNEST(range(i, i + 20)) AS p FROM later) GROUP BY 1),
word AS (SELECT doc_id, UNNEST(range(1, len(w) + 1)) AS p, UNNEST(w) AS word FROM d),
cut AS (SELECT doc_id, UNNEST(p) AS p FROM gone),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS text FROM word ANTI JOIN cut USING (doc_id, p) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(len(p), 0) AS BIGINT) AS n_removed, sha256(COALESCE(text, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (doc_id) LEFT JOIN kept USING (doc_id)"""

_OP5 = """
WITH d AS (SELECT doc_id, hex(encode(COALESCE(text, ''))) AS x FROM documents),
win AS (SELECT doc_id, s, substring(x, 2 * s + 1, 100) AS win FROM (SELECT doc_id, x, UNNEST(range(0, len(x) // 2 - 49)) AS s FROM d WHERE len(x) >= 100)),
gone AS (SELECT doc_id, s FROM (SELECT doc_id, s, MIN(doc_id) OVER (PARTITION BY win) AS first FROM win) WHERE doc_id > first),
step AS (SELECT doc_id, s, CASE WHEN s <= lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 50 THEN 0 ELSE 1 END AS new FROM gone),
runs AS (SELECT doc_id, MIN(s) AS a, MAX(s) + 50 AS b FROM (SELECT doc_id, s, SUM(new) OVER (PARTITION BY doc_id ORDER BY s) AS run FROM step) GROUP BY doc_id, run),
ends AS (SELECT doc_id, a, b FROM runs UNION ALL SELECT doc_id, len(x) // 2, len(x) // 2 FROM d),
gaps AS (SELECT doc_id, COALESCE(lag(b) OVER (PARTITION BY doc_id ORDER BY a, b), 0) AS lo, a AS hi FROM ends),
kept AS (SELECT doc_id, string_agg(substring(x, 2 * lo + 1, 2 * (hi - lo)), '' ORDER BY lo, hi) AS x FROM gaps JOIN d USING (doc_id) GROUP BY 1),
n AS (SELECT doc_id, SUM(b - a) AS n_removed, COUNT(*) AS n_spans FROM runs GROUP BY 1)
SELECT d.doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(COALESCE(n_removed, 0) AS BIGINT) AS n_removed, COALESCE(n_spans, 0) AS n_spans, sha256(unhex(kept.x)) AS kept_sha256
FROM d JOIN kept USING (doc_id) LEFT JOIN n USING (doc_id)"""

_OP6 = """
WITH p AS (SELECT page_id, COALESCE(html, '') AS html, MAX(page_id) OVER (PARTITION BY COALESCE(html, '')) AS top FROM pages),
g AS (SELECT *, list_transform(range(0, 8), lambda i: CAST('0x' || substring(sha1(html), CAST(5 * i + 1 AS INTEGER), 5) AS INTEGER)) AS parts FROM p)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
 array_to_string(list_transform(parts, lambda v: array_to_string(list_transform([15, 10, 5, 0], lambda b: substring('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> b) & 31 AS INTEGER) + 1, 1)), '')), '') AS payload_digest,
 CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> top THEN top END AS refers_to FROM g"""

_OP11 = rf"""
WITH pieces AS MATERIALIZED (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM (SELECT COALESCE(lang, 'und') AS lang, UNNEST(string_split_regex({_FOLDED}, '[.,;:!?\x0A-\x0D]')) AS piece FROM documents)),
grams AS MATERIALIZED (SELECT lang, m, g, COUNT(*) AS f FROM ({" UNION ALL ".join(f"SELECT lang, {k} AS m, UNNEST(list_transform(range(1, len(w) - {k - 2}), lambda i: array_to_string(w[i:i + {k - 1}], ' '))) AS g FROM pieces WHERE len(w) >= {k}" for k in (1, 2, 3, 4))}) GROUP BY 1, 2, 3),
n AS (SELECT lang, CAST(SUM(f) AS BIGINT) AS n FROM grams WHERE m = 1 GROUP BY 1),
part AS MATERIALIZED (SELECT lang, g, f FROM grams WHERE f >= 30),
cand AS MATERIALIZED (SELECT lang, m, g, string_split(g, ' ') AS w, f AS a FROM grams WHERE m > 1 AND f >= 30),
cut AS MATERIALIZED (SELECT lang, g, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest FROM (SELECT *, UNNEST(range(1, m)) AS k FROM cand)),
scored AS (SELECT cut.lang, cut.g, a, k, l.f AS l, r.f AS r, CAST((2000000::HUGEINT * a) // (l.f + r.f) AS BIGINT) AS score FROM cut JOIN part l ON l.lang = cut.lang AND l.g = first JOIN part r ON r.lang = cut.lang AND r.g = rest),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, k) = 1),
inside AS (SELECT lang, array_to_string(s, ' ') AS g, MAX(a) AS longer FROM (SELECT lang, a, m, UNNEST([w[1:2], w[2:3], w[3:4], w[1:3], w[2:4]]) AS s FROM cand WHERE m > 2) WHERE len(s) > 1 AND len(s) < m GROUP BY 1, 2),
kept AS (SELECT best.lang, best.g AS phrase, a, l, r, score FROM best LEFT JOIN inside USING (lang, g) WHERE longer IS NULL OR 100 * longer < 80 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000"""

_OP12 = f"""
WITH d AS (SELECT doc_id, string_split(COALESCE(text, ''), chr(10)) AS w FROM documents),
line AS (SELECT doc_id, UNNEST(range(1, len(w) + 1)) AS i, UNNEST(w) AS line FROM d),
keyed AS (SELECT *, {_FOLDED.replace("COALESCE(text, '')", "trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))")} AS k FROM line),
often AS (SELECT k, MAX(doc_id) AS last FROM keyed WHERE length(k) >= 40 GROUP BY 1 HAVING COUNT(DISTINCT doc_id) >= 5),
kept AS (SELECT doc_id, COUNT(*) AS n, string_agg(line, chr(10) ORDER BY i) AS text FROM keyed LEFT JOIN often USING (k) WHERE last IS NULL OR last = doc_id GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_lines, CAST(len(w) - COALESCE(n, 0) AS BIGINT) AS n_dropped, sha256(COALESCE(text, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)"""

_SHARE = "CAST(1 + (1000000000::HUGEINT * ({0} + 5)) // ({1} + 5 * v) AS BIGINT)"
_OP13 = rf"""
WITH d AS (SELECT doc_id, COALESCE(lang, '') AS lang, COALESCE(source, '') AS source, regexp_extract_all({_FOLDED}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT doc_id, lang, source, UNNEST(w) AS term FROM d),
kept AS (SELECT lang, term, CAST(COUNT(*) AS HUGEINT) AS total FROM t GROUP BY 1, 2 HAVING COUNT(DISTINCT doc_id) >= 30),
langs AS (SELECT lang, COUNT(*) AS v, SUM(total) AS n FROM kept GROUP BY 1),
c AS (SELECT lang, source, term, CAST(COUNT(*) AS HUGEINT) AS c, ANY_VALUE(total) AS total FROM t JOIN kept USING (lang, term) GROUP BY 1, 2, 3),
s AS (SELECT lang, source, COALESCE(own, 0) AS own, COALESCE(v, 0) AS v, COALESCE(n, 0) AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, SUM(c) AS own FROM c GROUP BY 1, 2) USING (lang, source) LEFT JOIN langs USING (lang)),
p AS (SELECT s.lang, s.source, kept.term, COALESCE(c.c, 0) AS c, {_SHARE.format("COALESCE(c.c, 0)", "s.own")} AS p, {_SHARE.format("kept.total", "s.n")} AS q FROM s JOIN kept USING (lang) LEFT JOIN c USING (lang, source, term)),
pair AS (SELECT a.lang, a.source, b.source AS item, CAST(SUM(abs(a.p - b.p)) AS BIGINT) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY 1, 2, 3),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, COALESCE(value, 0) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN pair ON pair.lang = a.lang AND pair.source = a.source AND pair.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p WHERE c > 0 AND p > q)
SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM (FROM pairs UNION ALL FROM terms) QUALIFY part = 'pair' OR rank <= 50"""

#: The other queries hash with XXH64, tokenize, fit models or parse HTML, which SQL can't; tests compare them with plain versions.
ORACLE_SQL = {"op2_decontamination": _OP2, "op4_phrases": _OP4, "op5_suffixes": _OP5, "op6_warc": _OP6, "op11_collocations": _OP11, "op12_lines": _OP12, "op13_divergence": _OP13}
