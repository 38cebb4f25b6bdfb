"""One query per operator, over whole tables, and DuckDB SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (backoff_lm, chat_format, decontam, filter_audit, line_dedup, minhash_join, piece_sampling, piecewise_hash, plane_clusters,
               quality_rules, token_counts, toxicity, url_filter)
from .common import small_batches, table

MODEL = "piece_bpe_32k.model"
TOKEN_LIMIT = 4096
NEAR_PERCENT = 85
RULES = [url_filter.rule(*r) for r in (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"), ("block", "net/fr/"))]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    counts = token_counts.count_tokens(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return counts.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents")
    machine = toxicity.fit(toxicity.sample_labelled(docs, table(spark, sf_dir, "labels")))
    return toxicity.score(docs, machine)


def op3_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return backoff_lm.score(table(spark, sf_dir, "documents"))


def op4_chat_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -1, which says the template's own control strings."""
    small_batches(spark)
    rows = table(spark, sf_dir, "conversations").selectExpr("cast(conv_id as long) conv_id", "cast(turn as long) turn", "role", "text")
    own = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-1, 0, "user", own), (-1, 1, "assistant", own)], "conv_id long, turn long, role string, text string")
    return chat_format.digests(chat_format.format_chats(rows.unionByName(extra)))


def op5_piece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    encoded = piece_sampling.encode_sampled(table(spark, sf_dir, "documents"), public_tokenizers.path(MODEL))
    return encoded.select("doc_id", F.size("piece_ids").cast("long").alias("n_pieces"), "piece_ids", "lossless")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    judged = quality_rules.judge(docs, keep_text=False)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontam.find_contamination(docs, table(spark, sf_dir, "benchmark"))
    return decontam.verdicts(found)


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The labelled table is what the rules say of the pages they cover."""
    small_batches(spark)
    pages = table(spark, sf_dir, "pages")
    labelled = url_filter.parsed(pages, RULES).where("ruled IS NOT NULL").select("host", "path", (F.col("ruled") == "block").alias("blocked"))
    return url_filter.filter_urls(pages, RULES, labelled)


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = line_dedup.dedup_lines(docs)
    return clean.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))


def op10_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return minhash_join.near_duplicates(table(spark, sf_dir, "documents"), percent=NEAR_PERCENT)


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_plane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return plane_clusters.cluster(table(spark, sf_dir, "embeddings"))


def op13_piecewise_hash(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return piecewise_hash.compare_neighbours(table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_token_counts, op2_toxicity, op3_backoff_lm, op4_chat_prefix_targets, op5_piece_sampling, op6_quality_rules,
                            op7_benchmark_decontamination, op8_url_filters, op9_line_dedup, op10_minhash_near_dedup, op11_filter_audit, op12_plane_clusters, op13_piecewise_hash, pipeline)}

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"

_OP3 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
w AS (SELECT r, i, ws[i] AS w3, CASE WHEN i > 1 THEN ws[i - 1] END AS w2, CASE WHEN i > 2 THEN ws[i - 2] END AS w1
      FROM d, LATERAL (SELECT unnest(range(1, len(ws) + 1)) AS i)),
n AS (SELECT count(*) AS n FROM w),
c1 AS (SELECT w3, count(*) AS c FROM w GROUP BY 1),
c2 AS (SELECT w2, w3, count(*) AS c FROM w WHERE w2 IS NOT NULL GROUP BY 1, 2),
c3 AS (SELECT w1, w2, w3, count(*) AS c FROM w WHERE w1 IS NOT NULL GROUP BY 1, 2, 3),
s AS (SELECT w.r, CASE
        WHEN c3.c >= {backoff_lm.MIN_COUNT} THEN log10(c3.c / x2.c)
        WHEN c2.c >= {backoff_lm.MIN_COUNT} THEN log10(c2.c / x1.c) + CASE WHEN w.w1 IS NOT NULL THEN log10({backoff_lm.ALPHA}) ELSE 0 END
        ELSE log10(c1.c / n.n) + CASE WHEN w.w2 IS NOT NULL THEN log10({backoff_lm.ALPHA}) ELSE 0 END
                             + CASE WHEN w.w1 IS NOT NULL THEN log10({backoff_lm.ALPHA}) ELSE 0 END END AS v
      FROM w CROSS JOIN n JOIN c1 ON c1.w3 = w.w3 LEFT JOIN c1 x1 ON x1.w3 = w.w2 LEFT JOIN c2 ON c2.w2 = w.w2 AND c2.w3 = w.w3
      LEFT JOIN c2 x2 ON x2.w2 = w.w1 AND x2.w3 = w.w2 LEFT JOIN c3 ON c3.w1 = w.w1 AND c3.w2 = w.w2 AND c3.w3 = w.w3),
t AS (SELECT r, sum(CAST(round_even(v * {backoff_lm.MICRO}, 0) AS BIGINT)) AS m FROM s GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(m, 0) AS BIGINT) AS micro_logprob,
       CASE WHEN len(ws) > 0 THEN CAST(floor(m / len(ws)) AS BIGINT) END AS mean_micro
FROM d LEFT JOIN t USING (r)
"""

_ESC = "regexp_replace(replace({}, '\\', '\\\\'), '(<s>|</s>|\\[INST|\\[/INST\\]|<<SYS>>|<</SYS>>|<\\|im_start\\|>|<\\|im_end\\|>|<\\|endoftext\\|>)', 'x\\1', 'g')"
_OP4 = f"""
WITH c AS (SELECT CAST(conv_id AS BIGINT) AS conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT *, row_number() OVER w AS k,
             sum({len(chat_format.OPEN + chat_format.BODY + chat_format.CLOSE)} + length(replace({_ESC.format('role')}, ']', 'x]')) + length({_ESC.format('text')})) OVER w AS upto,
             count(*) OVER (PARTITION BY conv_id) AS n
      FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
SELECT conv_id, CAST(count(*) AS BIGINT) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(upto) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
"""


def _op6_sql() -> str:
    names = list(quality_rules.FEATURES)
    value = {"symbols_pm": "(1000 * n_symbols) // greatest(word_chars, 1)", "dup_lines_pm": "(1000 * n_dup_lines) // greatest(n_lines, 1)",
             "repeats_pm": "(1000 * n_repeat_words) // greatest(n_words, 1)", "word_len_pc": "(100 * word_chars) // greatest(n_words, 1)"}
    pairs = " UNION ALL ".join(f"SELECT r, lang, source, '{n}' AS feature, CAST({value[n]} AS BIGINT) AS v FROM m WHERE NOT base_failed" for n in names)
    low = " ".join(f"WHEN '{n}' THEN {'NULL' if lo is None else lo}" for n, (_, lo) in quality_rules.FEATURES.items())
    high = " ".join(f"WHEN '{n}' THEN {hi}" for n, (hi, _) in quality_rules.FEATURES.items())

    def fences(keys: str) -> str:
        part = f"PARTITION BY {keys}feature"
        return f"""SELECT {keys}feature, n_docs, q1 - greatest({quality_rules.FENCE} * (q3 - q1), CASE feature {low} END) + 0 * CASE feature {low} END AS low,
               q3 + greatest({quality_rules.FENCE} * (q3 - q1), CASE feature {high} END) AS high FROM (
               SELECT {keys}feature, max(n_docs) AS n_docs, min(bin) FILTER (4 * upto >= n_docs) AS q1, min(bin) FILTER (4 * upto >= 3 * n_docs) AS q3 FROM (
                 SELECT {keys}feature, bin, sum(n) OVER ({part}) AS n_docs, sum(n) OVER ({part} ORDER BY bin) AS upto
                 FROM (SELECT {keys}feature, bin, sum(n) AS n FROM k GROUP BY ALL)) GROUP BY ALL)"""

    w = quality_rules.WINDOW
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS x, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
win AS (SELECT r, i, list_slice(ws, i, i + {w - 1}) AS g FROM d, LATERAL (SELECT unnest(range(1, len(ws) - {w - 2})) AS i) WHERE len(ws) >= {w}),
dup AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS c FROM win) WHERE c > 1),
rep AS (SELECT r, sum(least({w}, i - coalesce(p, i - {w}))) AS n FROM (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM dup) GROUP BY r),
ln AS (SELECT r, count(*) AS n, count(DISTINCT l) AS u FROM (SELECT r, unnest(string_split(x, chr(10))) AS l FROM d) WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
m0 AS (SELECT d.r, doc_id, lang, source, CAST(len(ws) AS BIGINT) AS n_words, CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
             CAST(length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(ln.n, 0) AS BIGINT) AS n_lines,
             CAST(coalesce(ln.n - ln.u, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words
      FROM d LEFT JOIN rep USING (r) LEFT JOIN ln USING (r)),
m AS (SELECT *, n_words < {quality_rules.MIN_WORDS} OR 100 * n_repeat_words > {quality_rules.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM m0),
f AS ({pairs}),
k AS (SELECT lang, source, feature, CASE WHEN v < 128 THEN v ELSE (v >> (length(bin(v)) - 7)) << (length(bin(v)) - 7) END AS bin, count(*) AS n FROM f GROUP BY ALL),
o AS ({fences('lang, source, ')}), l AS ({fences('lang, ')}), a AS ({fences('')}),
t AS (SELECT o.lang, o.source, o.feature,
             CASE WHEN o.n_docs >= {quality_rules.MIN_GROUP} THEN o.low WHEN l.n_docs >= {quality_rules.MIN_GROUP} THEN l.low ELSE a.low END AS low,
             CASE WHEN o.n_docs >= {quality_rules.MIN_GROUP} THEN o.high WHEN l.n_docs >= {quality_rules.MIN_GROUP} THEN l.high ELSE a.high END AS high
      FROM o JOIN l ON o.lang IS NOT DISTINCT FROM l.lang AND o.feature = l.feature JOIN a ON o.feature = a.feature),
bad AS (SELECT DISTINCT f.r FROM f JOIN t ON f.lang IS NOT DISTINCT FROM t.lang AND f.source IS NOT DISTINCT FROM t.source AND f.feature = t.feature
        WHERE coalesce(f.v < t.low, false) OR f.v > t.high)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND bad.r IS NULL AS kept FROM m LEFT JOIN bad USING (r)
"""


_OP7_WORDS = r"regexp_extract_all(" + _LOWER.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_OP7 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_OP7_WORDS} AS ws FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_OP7_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
p AS (SELECT DISTINCT item, least(len(ws), {decontam.WINDOW}) AS n, list_slice(ws, i, i + least(len(ws), {decontam.WINDOW}) - 1) AS g
      FROM b, LATERAL (SELECT unnest(range(1, len(ws) - least(len(ws), {decontam.WINDOW}) + 2)) AS i) WHERE len(ws) > 0),
n AS (SELECT DISTINCT n FROM p),
o AS (SELECT r, i, p.n, p.item FROM (SELECT r, i, n, list_slice(ws, i, i + n - 1) AS g FROM d, n, LATERAL (SELECT unnest(range(1, len(ws) - n + 2)) AS i)) w JOIN p ON p.n = w.n AND p.g = w.g),
h AS (SELECT r, count(DISTINCT j) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS j FROM (SELECT DISTINCT r, i, n FROM o)) GROUP BY r),
q AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM o) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(ws) AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN q USING (r)
"""

_OP9 = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
l AS (SELECT r, generate_subscripts(ls, 1) AS i, unnest(ls) AS line FROM (SELECT r, string_split(x, chr(10)) AS ls FROM d)),
k AS (SELECT *, {_LOWER.format(r"regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g')")} AS key FROM l),
c AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT r) >= {line_dedup.MIN_DOCS}),
s AS (SELECT r, count(*) AS n_lines, count(c.key) AS n_dropped, string_agg(line, chr(10) ORDER BY i) FILTER (c.key IS NULL) AS kept FROM k LEFT JOIN c USING (key) GROUP BY r)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, sha256(coalesce(kept, '')) AS kept_sha256 FROM d JOIN s USING (r)
"""

_OP10 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.format(_LOWER.format("coalesce(text, '')"))} AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, list_slice(ws, i, i + 4) AS g FROM d, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 4, 1) + 1)) AS i) WHERE len(ws) > 0),
z AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN z x ON x.doc_id = a JOIN z y ON y.doc_id = b WHERE 100 * c >= {NEAR_PERCENT} * (x.n + y.n - c)),
t(doc_id, reach) AS (SELECT doc_id, doc_id FROM d UNION SELECT t.doc_id, e.b FROM t JOIN e ON e.a = t.reach),
m AS (SELECT doc_id, min(reach) AS component_id FROM t GROUP BY 1)
SELECT doc_id, CAST(coalesce(z.n, 0) AS BIGINT) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN z USING (doc_id)
"""

def _op11_sql() -> str:
    steps = ", ".join(f"('{o}', {k}, {bit}, {before})" for o, k, bit, before in filter_audit.orders())
    here = "failed & before = 0 AND failed & bit <> 0"
    return f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
b AS (SELECT d.*, CASE WHEN len(ws) < {filter_audit.MIN_WORDS} THEN 1 ELSE 0 END + CASE WHEN 100 * len(list_distinct(ws)) < {filter_audit.MIN_DISTINCT_PERCENT} * len(ws) THEN 2 ELSE 0 END
           + CASE WHEN 100 * len(regexp_replace(x, '[^A-Z]', '', 'g')) > {filter_audit.MAX_UPPER_PERCENT} * length(x) THEN 4 ELSE 0 END
           + CASE WHEN regexp_matches(x, '[#$%&*|]') THEN 8 ELSE 0 END
           + CASE WHEN doc_id > min(doc_id) OVER (PARTITION BY x) THEN 16 ELSE 0 END AS failed FROM d),
l AS (SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS n_good, count(*) FILTER (toxic) AS n_toxic FROM b LEFT JOIN l USING (doc_id) GROUP BY ALL),
s AS (SELECT * FROM (VALUES {steps}) t(filter_order, step, bit, before)),
t AS (SELECT part, filter_order, step, bit, sum(CASE WHEN failed & (before | bit) = 0 THEN n ELSE 0 END) AS kept, sum(CASE WHEN {here} THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN failed & before <> 0 AND failed & bit <> 0 THEN n ELSE 0 END) AS redundant, sum(CASE WHEN failed = bit THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN {here} THEN n_good ELSE 0 END) AS good_lost, sum(CASE WHEN {here} THEN n_toxic ELSE 0 END) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley FROM t
"""


def _op12_sql() -> str:
    n, top = plane_clusters.COMPONENTS, plane_clusters.CLUSTERS
    parts = [f"""WITH v AS MATERIALIZED (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor({plane_clusters.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
  WHERE len(embedding) = {n} AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(CAST(x AS DOUBLE)))) = {n}),
h0 AS (SELECT x, row_number() OVER (ORDER BY sha256('{plane_clusters.SALT}:' || CAST(vec_id AS VARCHAR)) NULLS LAST, x) - 1 AS k FROM v),
c0 AS MATERIALIZED (SELECT k, x FROM h0 WHERE k < {top})"""]

    def near(i: int) -> str:
        far = f"list_sum(list_transform(range(1, {n + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
        return f"SELECT r, vec_id, min(struct_pack(d := CAST({far} AS HUGEINT), k := k)) AS b FROM v, c{i} c GROUP BY r, vec_id"

    for i in range(plane_clusters.ROUNDS):
        parts.append(f"a{i} AS MATERIALIZED ({near(i)})")
        mean = f"SELECT k, list(m ORDER BY i) AS x FROM (SELECT a{i}.b.k AS k, i, CAST((sum(v.x[i]) - (sum(v.x[i]) % count(*) + count(*)) % count(*)) // count(*) AS BIGINT) AS m FROM a{i} JOIN v USING (r), (SELECT unnest(range(1, {n + 1})) AS i) GROUP BY 1, 2) GROUP BY k"
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(m.x, c{i}.x) AS x FROM c{i} LEFT JOIN ({mean}) m ON m.k = c{i}.k)")
    last = plane_clusters.ROUNDS
    parts.append(f"a AS MATERIALIZED ({near(last)})")
    return ",\n".join(parts) + f"""
SELECT vec_id, CAST(b.k AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance, CAST(sum(b.d) OVER (PARTITION BY b.k) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256 FROM a JOIN c{last} c ON c.k = a.b.k
"""


ORACLE: dict[str, str] = {
    "op3_backoff_lm": _OP3,
    "op4_chat_prefix_targets": _OP4,
    "op6_quality_rules": _op6_sql(),
    "op7_benchmark_decontamination": _OP7,
    "op9_line_dedup": _OP9,
    "op10_minhash_near_dedup": _OP10,
    "op11_filter_audit": _op11_sql(),
    "op12_plane_clusters": _op12_sql(),
}
