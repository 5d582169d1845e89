"""DuckDB SQL that computes each registered query's result independently.

The SQL runs on the given tables (pre-registered views) and is written from
the operator semantics, not from the Spark code.  Regex classes spell out
Java's ``\\s`` (blank, tab, newline, VT, FF, CR) because RE2's ``\\s`` lacks VT.
"""

from __future__ import annotations

from ..functions.stopwords import sql_list

WS = r"[ \t\n\x0B\f\r]"
NON_LETTER = r"[^a-zA-Z \t\n\x0B\f\r]"

ARTICLES = """
articles AS (
  SELECT cast(d.doc_id AS varchar) AS article_id,
         split_part(d.text, chr(10), 1) AS title,
         d.text AS text,
         d.source AS subject,
         strftime(DATE '2024-01-01' + cast(d.doc_id % 30 AS integer), '%B %d, %Y') AS date,
         cast(l.quality AS double) AS label
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id)"""

ALL_ARTICLES = """
all_articles AS (
  SELECT cast(d.doc_id AS varchar) AS article_id,
         split_part(d.text, chr(10), 1) AS title,
         d.text AS text,
         d.source AS subject,
         strftime(DATE '2024-01-01' + cast(d.doc_id % 30 AS integer), '%B %d, %Y') AS date
  FROM documents d)"""


def preprocess_sql(expr: str) -> str:
    return (f"regexp_replace(regexp_replace(lower({expr}), '{NON_LETTER}', '', 'g'), "
            f"'{WS}+', ' ', 'g')")


def split_bucket_sql(key: str) -> str:
    return f"(('0x' || substr(md5({key}), 1, 8))::BIGINT % 100)"


PREPARED = f"""
prepared AS (
  SELECT a.*, cast(l.quality AS double) AS label,
         {preprocess_sql("title || ' ' || text")} AS content
  FROM all_articles a LEFT JOIN labels l ON a.article_id = cast(l.doc_id AS varchar)),
docs AS (
  SELECT *, {split_bucket_sql("article_id")} < 80 AND label IS NOT NULL AND length(content) > 50 AS is_train,
         {split_bucket_sql("article_id")} >= 80 AND label IS NOT NULL AND length(content) > 50 AS is_test
  FROM prepared WHERE content IS NOT NULL),
long_docs AS (SELECT * FROM docs WHERE length(content) > 50)"""

MR_MODEL = f"""
tokens AS (
  SELECT article_id, subject, label, is_train, unnest(string_split(content, ' ')) AS term FROM docs),
terms AS (
  SELECT * FROM tokens WHERE term <> '' AND term NOT IN ({sql_list()})),
n AS (
  SELECT count(*) AS n_docs, sum(CASE WHEN label = 1.0 THEN 1 ELSE 0 END) AS n1 FROM docs WHERE is_train),
stats AS (
  SELECT term, count(DISTINCT article_id) AS df,
         sum(CASE WHEN label = 0.0 THEN 1 ELSE 0 END) AS tf0,
         sum(CASE WHEN label = 1.0 THEN 1 ELSE 0 END) AS tf1
  FROM terms WHERE is_train GROUP BY term),
idf AS (
  SELECT term, df, tf0, tf1,
         CASE WHEN df >= 5 THEN ln((n_docs + 1.0) / (df + 1.0)) ELSE 0.0 END AS idf
  FROM stats, n),
tot AS (
  SELECT sum(tf0 * idf) AS s0, sum(tf1 * idf) AS s1, count(*) AS v FROM idf),
theta AS (
  SELECT term, df, tf0, tf1, idf,
         ln(tf0 * idf + 1.0) - ln(s0 + v) AS theta0,
         ln(tf1 * idf + 1.0) - ln(s1 + v) AS theta1
  FROM idf, tot),
prior AS (
  SELECT ln(n_docs - n1 + 1.0) - ln(n_docs + 2.0) AS pi0, ln(n1 + 1.0) - ln(n_docs + 2.0) AS pi1 FROM n),
token_scores AS (
  SELECT t.article_id, sum(th.idf * th.theta0) AS w0, sum(th.idf * th.theta1) AS w1
  FROM terms t JOIN theta th ON t.term = th.term AND th.idf > 0
  GROUP BY t.article_id),
scores AS (
  SELECT d.article_id, d.subject, d.date, d.label, d.is_train, d.is_test,
         p.pi0 + coalesce(ts.w0, 0.0) AS score0,
         p.pi1 + coalesce(ts.w1, 0.0) AS score1
  FROM docs d CROSS JOIN prior p LEFT JOIN token_scores ts ON d.article_id = ts.article_id),
predictions AS (
  SELECT *, CAST(CASE WHEN score1 > score0 THEN 1.0 ELSE 0.0 END AS double) AS prediction,
         CASE WHEN score1 > score0 THEN 'TRUE' ELSE 'FAKE' END AS prediction_label
  FROM scores)"""


# The hashed-feature model: Spark's HashingTF index is Murmur3 (x86, 32 bit, seed 42) of the term's
# UTF-8 bytes, signed, modulo 5000.  Terms are ASCII letters, so a byte is a character code; the
# tokenizer keeps a leading empty token and drops trailing ones.
TWO32 = "4294967296::UBIGINT"


def _times(x: str, c: int) -> str:
    return f"(({x}) * {c}::UBIGINT % {TWO32})"


def _rotl(x: str, r: int) -> str:
    return f"((({x}) * {1 << r}::UBIGINT) % {TWO32} + ({x}) // {1 << (32 - r)}::UBIGINT)"


def _mix_block(k: str) -> str:
    return _times(_rotl(_times(k, 0xCC9E2D51), 15), 0x1B873593)


def _bytes(first: str, n: int) -> str:
    return "(" + " + ".join(f"unicode(substr(term, cast({first} + {j + 1} AS bigint), 1)) * {256 ** j}"
                            for j in range(n)) + ")::UBIGINT"


def ml_tokens(docs: str) -> str:
    """article_id, term of the model's tokens of a relation with content."""
    return f"""
  SELECT article_id, unnest(CASE WHEN content = '' THEN [''] WHEN rtrim(content, ' ') = '' THEN []
                            ELSE string_split(rtrim(content, ' '), ' ') END) AS term
  FROM {docs}"""


SCORABLE = f"""
scorable AS (
  SELECT *, {preprocess_sql("title || ' ' || text")} AS content
  FROM all_articles WHERE title IS NOT NULL AND text IS NOT NULL)"""

ML_MODEL = f"""
ml_tokens AS (
  SELECT * FROM ({ml_tokens("scorable")}) WHERE term NOT IN ({sql_list()})),
vocab AS (SELECT DISTINCT term, length(term) AS n FROM ml_tokens),
blocks AS (
  SELECT term, n, list_transform(range(0, n // 4), lambda i: {_bytes("4 * i", 4)}) AS ks,
         CASE n % 4 WHEN 0 THEN 0::UBIGINT WHEN 1 THEN {_bytes("n - 1", 1)} WHEN 2 THEN {_bytes("n - 2", 2)}
                    ELSE {_bytes("n - 3", 3)} END AS tail
  FROM vocab),
mixed AS (
  SELECT term, n, list_transform(ks, lambda k: {_mix_block("k")}) AS ks, {_mix_block("tail")} AS tail FROM blocks),
body AS (
  SELECT term, xor(xor(list_reduce(list_prepend(42::UBIGINT, ks), lambda h, k:
           ({_rotl("xor(h, k)", 13)} * 5::UBIGINT + {0xE6546B64}::UBIGINT) % {TWO32}), tail), n::UBIGINT) AS h
  FROM mixed),
fmix1 AS (SELECT term, {_times("xor(h, h // 65536::UBIGINT)", 0x85EBCA6B)} AS h FROM body),
fmix2 AS (SELECT term, {_times("xor(h, h // 8192::UBIGINT)", 0xC2B2AE35)} AS h FROM fmix1),
hashed AS (
  SELECT term, cast(xor(h, h // 65536::UBIGINT) AS bigint) AS h FROM fmix2),
term_bucket AS (
  SELECT term, (((h - CASE WHEN h >= 2147483648 THEN 4294967296 ELSE 0 END) % 5000) + 5000) % 5000 AS bucket
  FROM hashed),
tf AS (
  SELECT article_id, bucket, count(*) AS tf FROM ml_tokens JOIN term_bucket USING (term) GROUP BY ALL),
train AS (SELECT article_id, label FROM docs WHERE is_train),
ml_n AS (
  SELECT count(*) AS n_docs, sum(CASE WHEN label = 1.0 THEN 1 ELSE 0 END) AS n1 FROM train),
ml_stats AS (
  SELECT bucket, count(*) AS df, sum(CASE WHEN label = 0.0 THEN tf ELSE 0 END) AS tf0,
         sum(CASE WHEN label = 1.0 THEN tf ELSE 0 END) AS tf1
  FROM tf JOIN train USING (article_id) GROUP BY bucket),
ml_idf AS (
  SELECT bucket, df, tf0, tf1, CASE WHEN df >= 5 THEN ln((n_docs + 1.0) / (df + 1.0)) ELSE 0.0 END AS idf
  FROM ml_stats, ml_n),
ml_tot AS (SELECT sum(tf0 * idf) AS s0, sum(tf1 * idf) AS s1 FROM ml_idf),
ml_theta AS (
  SELECT bucket, idf, ln(tf0 * idf + 1.0) - ln(s0 + 5000.0) AS theta0, ln(tf1 * idf + 1.0) - ln(s1 + 5000.0) AS theta1
  FROM ml_idf, ml_tot),
ml_sums AS (
  SELECT article_id, sum(tf * idf * theta0) AS w0, sum(tf * idf * theta1) AS w1
  FROM tf JOIN ml_theta USING (bucket) GROUP BY article_id),
ml_scores AS (
  SELECT a.article_id, a.title, a.text, a.subject, a.date,
         ln(n_docs - n1 + 1.0) - ln(n_docs + 2.0) + coalesce(w0, 0.0) AS score0,
         ln(n1 + 1.0) - ln(n_docs + 2.0) + coalesce(w1, 0.0) AS score1
  FROM scorable a CROSS JOIN ml_n LEFT JOIN ml_sums USING (article_id)),
ml_predictions AS (
  SELECT *, CASE WHEN score1 > score0 THEN 'TRUE' ELSE 'FAKE' END AS prediction_label,
         CAST(CASE WHEN score1 > score0 THEN 1.0 ELSE 0.0 END AS double) AS prediction,
         round(1.0 / (1.0 + exp(greatest(least(score1 - score0, 700.0), -700.0))), 6) AS prob_fake,
         round(1.0 / (1.0 + exp(greatest(least(score0 - score1, 700.0), -700.0))), 6) AS prob_true
  FROM ml_scores)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


ORACLE: dict[str, str] = {}

ORACLE["mr_predict"] = with_ctes(ALL_ARTICLES, PREPARED, MR_MODEL) + """
SELECT article_id, subject, label, is_train, prediction, prediction_label FROM predictions"""

ORACLE["g3_by_subject_label"] = with_ctes(ALL_ARTICLES, PREPARED, MR_MODEL) + """
SELECT subject, prediction_label, cast(count(*) AS bigint) AS count
FROM predictions GROUP BY subject, prediction_label ORDER BY subject, prediction_label"""

# --- relational model summaries -------------------------------------------
MR = with_ctes(ALL_ARTICLES, PREPARED, MR_MODEL)

ORACLE["g1_row_count"] = MR + "\nSELECT count(*) AS n FROM predictions"
ORACLE["g2_by_label"] = MR + """
SELECT prediction_label, count(*) AS count FROM predictions GROUP BY prediction_label"""
ORACLE["g4_by_date_label"] = MR + """
SELECT date, prediction_label, count(*) AS count FROM predictions GROUP BY date, prediction_label
ORDER BY date, prediction_label"""
ORACLE["p5_label_decode"] = """
SELECT cast(d.doc_id AS varchar) AS article_id, cast(quality AS double) AS label,
       CASE WHEN quality = 0 THEN 'FAKE' ELSE 'TRUE' END AS decoded
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
ORACLE["m2_document_frequency"] = MR + "\nSELECT term, cast(df AS bigint) AS df, round(idf, 9) AS idf FROM idf"
ORACLE["mr_theta"] = MR + """
SELECT term, cast(tf0 AS bigint) AS tf0, cast(tf1 AS bigint) AS tf1,
       round(theta0, 6) AS theta0, round(theta1, 6) AS theta1 FROM theta"""
ORACLE["m6_hash_split"] = with_ctes(ALL_ARTICLES) + f"""
SELECT article_id, {split_bucket_sql("article_id")} < 80 AS is_train FROM all_articles"""
ORACLE["m7_metrics"] = MR + """,
cm AS (SELECT label, prediction, count(*) AS n FROM predictions WHERE is_test GROUP BY label, prediction),
per_label AS (SELECT label, sum(n) AS n_label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp
              FROM cm GROUP BY label),
per_pred AS (SELECT prediction AS label, sum(n) AS n_pred FROM cm GROUP BY prediction),
per AS (SELECT l.n_label, l.tp,
               CASE WHEN coalesce(p.n_pred, 0) > 0 THEN l.tp / p.n_pred ELSE 0.0 END AS p,
               l.tp / l.n_label AS r
        FROM per_label l LEFT JOIN per_pred p ON l.label = p.label)
SELECT round(sum(tp) / sum(n_label), 9) AS accuracy,
       round(sum(p * n_label) / sum(n_label), 9) AS weighted_precision,
       round(sum(r * n_label) / sum(n_label), 9) AS weighted_recall,
       round(sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0.0 END * n_label) / sum(n_label), 9) AS f1,
       cast(sum(n_label) AS bigint) AS n
FROM per"""
ORACLE["m8_auc_rank"] = MR + """,
ps AS (SELECT round(score1 - score0, 6) AS s,
              cast(sum(CASE WHEN label = 1.0 THEN 1 ELSE 0 END) AS double) AS pos,
              cast(sum(CASE WHEN label = 1.0 THEN 0 ELSE 1 END) AS double) AS neg
       FROM predictions WHERE is_test GROUP BY 1),
r AS (SELECT pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
             AS neg_below FROM ps)
SELECT round(sum(pos * (neg_below + 0.5 * neg)) / (sum(pos) * sum(neg)), 9) AS auc FROM r"""
ORACLE["m9_sample_predictions"] = MR + """,
top AS (SELECT article_id, label, prediction, round(1.0 / (1.0 + exp(score0 - score1)), 6) AS prob_true
        FROM predictions ORDER BY article_id LIMIT 10)
SELECT t.article_id, substr(d.content, 1, 50) AS content, t.label, t.prediction, t.prob_true
FROM top t JOIN docs d ON t.article_id = d.article_id"""
ORACLE["a1_token_counts"] = with_ctes(ALL_ARTICLES, PREPARED) + """,
toks AS (SELECT unnest(string_split(content, ' ')) AS term FROM long_docs)
SELECT term, count(*) AS n FROM toks WHERE term <> '' GROUP BY term"""
ORACLE["a2_stopword_removed"] = with_ctes(ALL_ARTICLES, PREPARED) + f"""
SELECT article_id,
       cast(len(list_filter(string_split(content, ' '), lambda x: x <> '')) AS integer) AS n_tokens,
       cast(len(list_filter(string_split(content, ' '),
                            lambda x: x <> '' AND NOT list_contains([{sql_list()}], x))) AS integer) AS n_terms
FROM long_docs"""

ML = with_ctes(ALL_ARTICLES, PREPARED, SCORABLE, ML_MODEL)
ORACLE["m1_term_hash"] = ML + "\nSELECT term, cast(bucket AS integer) AS bucket FROM term_bucket"
ORACLE["m4_tfidf_nb_predict"] = ML + """
SELECT p.article_id, d.label, d.is_train, p.prediction, p.prediction_label
FROM ml_predictions p JOIN docs d ON p.article_id = d.article_id"""
ORACLE["p6_probabilities"] = ML + """
SELECT p.article_id, p.prob_fake, p.prob_true
FROM ml_predictions p JOIN docs d ON p.article_id = d.article_id"""
ORACLE["st2_score"] = ML + "\nSELECT title, subject, date, prediction_label, prob_fake, prob_true FROM ml_predictions"
ORACLE["k6_score_stream_append"] = ORACLE["st2_score"]
ORACLE["k6_replay_idempotent"] = ML + """
SELECT title, subject, date, prediction_label, prob_fake, prob_true, 0 AS batch_id FROM ml_predictions"""
ORACLE["k9_model_roundtrip"] = ML + "\nSELECT title, subject, prediction_label, prob_fake, prob_true FROM ml_predictions"

# --- text functions ----------------------------------------------------------


def clean_sql(src: str) -> str:
    """T1 over a relation with article_id, title, text, subject[, date] (no length filter)."""
    return f"""
cleaned AS (
  SELECT article_id,
         trim(regexp_replace(title, '{WS}+', ' ', 'g'), ' ') AS title,
         regexp_replace(trim(regexp_replace(text, '{WS}+', ' ', 'g'), ' '), '<[^>]+>', '', 'g') AS text,
         lower(trim(subject, ' ')) AS subject,
         date
  FROM {src})"""


PAGE_ARTICLES = """
page_articles AS (
  SELECT cast(page_id AS varchar) AS article_id,
         regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS title,
         html AS text,
         regexp_extract(url, '://[^/]+/([^/?#]+)', 1) AS subject,
         NULL AS date
  FROM pages)"""

CLEAN_ALL = with_ctes(ALL_ARTICLES, clean_sql("all_articles"))

ORACLE["t1_clean_text"] = CLEAN_ALL + """
SELECT article_id, title, text, subject, date FROM cleaned WHERE length(text) > 100"""
ORACLE["t1_clean_pages"] = with_ctes(PAGE_ARTICLES, clean_sql("page_articles")) + """
SELECT article_id, title, text, subject FROM cleaned WHERE length(text) > 100"""
ORACLE["x2_min_text"] = with_ctes(PAGE_ARTICLES, clean_sql("page_articles")) + """
SELECT article_id, cast(length(text) AS integer) AS text_len FROM cleaned WHERE length(text) > 100"""
ORACLE["t3_content_null"] = with_ctes(ALL_ARTICLES) + """
SELECT article_id, (title || ' ' || text) IS NULL AS content_null,
       cast(length(title || ' ' || text) AS integer) AS content_len FROM all_articles"""
ORACLE["t4_preprocess"] = with_ctes(ALL_ARTICLES) + f"""
SELECT article_id, {preprocess_sql("title || ' ' || text")} AS content FROM all_articles"""
ORACLE["x1_min_content"] = with_ctes(ALL_ARTICLES, PREPARED) + """
SELECT article_id, cast(length(content) AS integer) AS content_len FROM long_docs"""
ORACLE["t6_key_prefix"] = with_ctes(ALL_ARTICLES) + """
SELECT article_id, substr(title, 1, 50) AS key FROM all_articles"""

# The characters Python's str.strip() removes, as a SQL expression.
UNICODE_WS_SQL = " || ".join(f"chr({c})" for c in (
    [0x09, 0x0A, 0x0B, 0x0C, 0x0D, 0x1C, 0x1D, 0x1E, 0x1F, 0x20, 0x85, 0xA0, 0x1680]
    + list(range(0x2000, 0x200B)) + [0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def clean_html_sql(expr: str) -> str:
    s = f"coalesce({expr}, '')"
    hidden = (r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
              r"|<template\b[^>]*>.*?</template\s*>|<!--.*?-->")
    s = f"regexp_replace({s}, '{hidden}', '', 'g')"
    s = f"regexp_replace({s}, '</?[A-Za-z][^>]*>|<[!?][^>]*>', chr(1), 'g')"
    for ent, ch in [("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&copy;", "chr(169)"), ("&middot;", "chr(183)"),
                    ("&nbsp;", "chr(160)"), ("&amp;", "'&'")]:          # the references that pages have
        s = f"replace({s}, '{ent}', {ch})"
    return (f"array_to_string(list_filter(list_transform(string_split({s}, chr(1)), "
            f"lambda x: trim(x, {UNICODE_WS_SQL})), lambda x: x <> ''), ' ')")


# The text that the page was generated from: references decoded, surrounding white space gone.
ORACLE["t2_references"] = f"SELECT doc_id, trim(coalesce(text, ''), {UNICODE_WS_SQL}) AS text FROM documents"
ORACLE["t2_clean_html"] = f"SELECT page_id, {clean_html_sql('html')} AS text FROM pages"

# --- JSON ----------------------------------------------------------------------
ORACLE["j1_json_parse"] = """
SELECT event_id, try_cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events"""
ORACLE["j2_json_build"] = "SELECT event_id, user_id, event_type, value, props FROM events"
ORACLE["p2_flatten"] = with_ctes(ALL_ARTICLES) + """
SELECT title, text, subject, date, cast(NULL AS varchar) AS "timestamp", cast(NULL AS varchar) AS source,
       article_id, cast(NULL AS varchar) AS scraped_at FROM all_articles"""
ORACLE["k10_message_key_value"] = with_ctes(ALL_ARTICLES) + """
SELECT substr(title, 1, 50) AS key, article_id, title, subject, date FROM all_articles"""
ORACLE["x5_dead_letter"] = """
SELECT count(*) AS n, count(value) AS with_value FROM (
  SELECT CASE WHEN doc_id % 10 = 7 THEN NULL ELSE 'x' END AS value FROM documents
  WHERE doc_id % 10 IN (3, 5, 7, 9) OR text IS NULL)"""
ST4 = "doc_id % 10 IN (3, 5, 7, 9) OR text IS NULL"
ORACLE["st4_foreach_batch"] = ML + """
SELECT title, subject, date, prediction_label, prob_fake, prob_true FROM ml_predictions
WHERE cast(article_id AS bigint) % 10 NOT IN (3, 5, 7, 9)"""
ORACLE["g6_batch_metrics"] = ML + """
SELECT count(*) AS good, (SELECT count(*) FROM documents WHERE """ + ST4 + """) AS bad,
       count(*) FILTER (prediction_label = 'FAKE') AS fake
FROM ml_predictions WHERE cast(article_id AS bigint) % 10 NOT IN (3, 5, 7, 9)"""

# --- CSV / Parquet ---------------------------------------------------------------
ORACLE["s1_csv_roundtrip"] = with_ctes(ARTICLES) + "\nSELECT title, text, subject, date, label FROM articles"
ORACLE["s1_split_csv"] = with_ctes(ALL_ARTICLES) + "\nSELECT title, text, subject, date FROM all_articles"
ORACLE["k11_land_training"] = ORACLE["s1_csv_roundtrip"]
ORACLE["u1_labelled_union"] = with_ctes(ARTICLES) + """
SELECT label, count(*) AS count FROM articles GROUP BY label"""
CLEAN_KEPT = CLEAN_ALL + ",\nkept AS (SELECT * FROM cleaned WHERE length(text) > 100)"
ORACLE["k4_backfill_parquet"] = CLEAN_KEPT + "\nSELECT title, text, subject, date FROM kept"
ORACLE["k5_backfill_csv"] = ORACLE["k4_backfill_parquet"]
ORACLE["st8_backfill"] = CLEAN_KEPT + """
SELECT subject, count(*) AS n, cast(sum(length(text)) AS bigint) AS chars FROM kept GROUP BY subject"""

PRED_ROWS = MR + """,
pred_rows AS (
  SELECT a.title, a.text, p.subject, p.date,
         round(1.0 / (1.0 + exp(p.score1 - p.score0)), 6) AS prob_fake,
         round(1.0 / (1.0 + exp(p.score0 - p.score1)), 6) AS prob_true,
         p.prediction_label
  FROM predictions p JOIN all_articles a ON p.article_id = a.article_id)"""
ORACLE["s3_partition_scan"] = PRED_ROWS + """
SELECT title, subject, date, prob_fake, prob_true, prediction_label FROM pred_rows
WHERE prediction_label = 'FAKE'"""
ORACLE["k7_export_predictions"] = PRED_ROWS + """
SELECT title, subject, date, prediction_label, prob_fake, prob_true FROM pred_rows"""
ORACLE["k8_export_summaries"] = PRED_ROWS + """
SELECT subject, prediction_label, count(*) AS count FROM pred_rows GROUP BY subject, prediction_label"""
ORACLE["k8_by_label"] = PRED_ROWS + """
SELECT prediction_label, count(*) AS count FROM pred_rows GROUP BY prediction_label"""
ORACLE["k8_by_date"] = PRED_ROWS + """
SELECT date, prediction_label, count(*) AS count FROM pred_rows GROUP BY date, prediction_label"""
ORACLE["r2_preview"] = PRED_ROWS + """
SELECT substr(title, 1, 40) AS title, substr(subject, 1, 40) AS subject,
       substr(prediction_label, 1, 40) AS prediction_label, prob_fake
FROM pred_rows ORDER BY subject, title, prob_fake LIMIT 10"""
# A layout with known files: bucket b (doc_id % 4) has one file for each 200 numbers.
FILES = "SELECT DISTINCT doc_id % 4 AS b, doc_id // 4 // 200 AS file FROM documents"
ORACLE["s6_file_inventory"] = f"""
SELECT 'bucket=' || b AS partition, count(*) AS files, min(file) AS first, max(file) AS last, true AS has_bytes
FROM ({FILES}) GROUP BY b"""
ORACLE["g5_dataset_status"] = f"""
SELECT 'buckets' AS dataset, count(*) AS files, count(DISTINCT b) AS children, true AS has_bytes, true AS has_time
FROM ({FILES})
UNION ALL SELECT 'empty', 0, 0, false, false UNION ALL SELECT 'missing', 0, 0, false, false"""
ORACLE["r3_latest_partitions"] = f"""
SELECT 'bucket=' || b AS partition, file FROM ({FILES}) ORDER BY b DESC, cast(file AS varchar) DESC LIMIT 5"""
ORACLE["r3_latest_by_time"] = f"SELECT count(*) AS files, count(DISTINCT b) AS partitions FROM ({FILES})"

# --- feeds -------------------------------------------------------------------------
# Written from what the feed documents are generated from (pages), not from their XML.
FEED_ITEMS = """
items AS (
  SELECT cast(page_id // 12 AS integer) AS feed_pos, cast(page_id % 12 AS integer) AS pos, page_id,
         regexp_extract(html, '(?is)<title>(.*?)</title>', 1) AS raw_title,
         html AS description,
         CASE WHEN page_id % 9 <> 4
              THEN TIMESTAMP '2024-03-01 00:00:00' + to_hours(cast(page_id * 7 AS bigint)) END AS pub_ts
  FROM pages),
once AS (
  SELECT feed_pos, pos, nullif(trim(raw_title), '') AS title, description, pub_ts,
         CASE WHEN feed_pos % 5 >= 2 THEN strftime(pub_ts, '%Y-%m-%dT%H:%M:%SZ')
              WHEN page_id % 3 = 0 THEN strftime(pub_ts, '%a, %d %b %Y %H:%M:%S GMT')
              WHEN page_id % 3 = 1 THEN strftime(pub_ts, '%a, %-d %b %Y %H:%M GMT')
              ELSE strftime(pub_ts, '%d %b %y %H:%M:%S +0000') END AS published,
         (['politics', 'business', 'technology', 'world'])[feed_pos % 4 + 1] AS subject
  FROM items),
parsed AS (SELECT *, 0 AS landing FROM once UNION ALL SELECT *, 1 AS landing FROM once WHERE feed_pos % 5 = 1
           UNION ALL SELECT *, 0 AS landing FROM once WHERE feed_pos % 5 = 2 AND pos < 3),
firsts AS (SELECT * FROM parsed WHERE pos < 10),
titled AS (
  SELECT * REPLACE (trim(coalesce(title, ''), """ + UNICODE_WS_SQL + """) AS title)
  FROM firsts),
nonempty AS (SELECT * FROM titled WHERE title <> ''),
deduped AS (SELECT * FROM nonempty QUALIFY row_number() OVER (PARTITION BY title ORDER BY feed_pos, pos, landing) = 1),
dated AS (SELECT *, strftime(coalesce(pub_ts, TIMESTAMP '2024-06-01 00:00:00' + to_hours(landing)), '%B %d, %Y') AS date
          FROM parsed),
extracted AS (
  SELECT *, """ + clean_html_sql("description") + """ AS text,
         strftime(coalesce(pub_ts, TIMESTAMP '2024-06-01 00:00:00' + to_hours(landing)), '%B %d, %Y') AS date,
         strftime(TIMESTAMP '2024-06-01 00:00:00' + to_hours(landing), '%Y-%m-%dT%H:%M:%S.%f') AS "timestamp"
  FROM deduped),
long_enough AS (SELECT * FROM extracted WHERE length(text) >= 30)"""
FEEDS = with_ctes(FEED_ITEMS)

ORACLE["f1_rss_entries"] = FEEDS + "\nSELECT feed_pos, pos, title, published FROM parsed"
ORACLE["f2_feed_errors"] = FEEDS + """
SELECT feed_pos, 'https://feeds.example.org/' || any_value(subject) || '/' || cast(feed_pos AS varchar) || '-broken.xml' AS url,
       'broken' AS error, cast(count(*) FILTER (pos < 3) AS integer) AS recovered, true AS has_rest
FROM once WHERE feed_pos % 5 = 2 GROUP BY feed_pos"""
ORACLE["w1_first_n_per_feed"] = FEEDS + "\nSELECT feed_pos, pos FROM firsts"
ORACLE["x3_nonempty_title"] = FEEDS + "\nSELECT feed_pos, pos, title FROM nonempty"
ORACLE["d1_first_by_title"] = FEEDS + """
SELECT feed_pos, pos, title, published, TIMESTAMP '2024-06-01 00:00:00' + to_hours(landing) AS fetched_at FROM deduped"""
ORACLE["x4_min_feed_text"] = FEEDS + """
SELECT feed_pos, pos, cast(length(text) AS integer) AS text_len FROM long_enough"""
ORACLE["t7_date_format"] = FEEDS + "\nSELECT feed_pos, pos, date FROM dated"
ORACLE["f_extract_feeds"] = FEEDS + """
SELECT title, text, subject, date, "timestamp", pub_ts IS NULL AS date_guessed FROM long_enough"""
ORACLE["k10_feed_messages"] = FEEDS + """
SELECT substr(title, 1, 50) AS key, title, subject, date, "timestamp" FROM long_enough"""

# --- streaming ---------------------------------------------------------------------
ORACLE["st1_ingest"] = CLEAN_KEPT + """
SELECT title, text, cast(NULL AS varchar) AS source, article_id, subject, date FROM kept"""
# doc_id % 10 of 3, 5 and 7 is malformed, 9 has no title (which the ingest keeps).
ORACLE["st1_ingest_once"] = CLEAN_KEPT + """,
good AS (SELECT article_id, subject FROM kept WHERE cast(article_id AS bigint) % 10 NOT IN (3, 5, 7))
SELECT 'parquet' AS sink, article_id, subject FROM good
UNION ALL SELECT 'csv', cast(count(*) AS varchar), NULL FROM good
UNION ALL SELECT 'dead letter', cast(count(*) AS varchar), NULL FROM documents WHERE doc_id % 10 IN (3, 5, 7)"""
ORACLE["k2_stream_csv"] = CLEAN_KEPT + "\nSELECT title, text, subject, date FROM kept"
ORACLE["st6_restart"] = CLEAN_KEPT + "\nSELECT count(*) AS n FROM kept"
ORACLE["d2_stream_dedupe"] = CLEAN_KEPT + """
SELECT title, text, article_id, subject, date FROM kept
QUALIFY trim(coalesce(title, ''), """ + UNICODE_WS_SQL + """) = '' OR row_number() OVER (PARTITION BY title ORDER BY cast(article_id AS varchar)) = 1"""
ORACLE["d2_stream_dedupe_csv"] = CLEAN_KEPT + """
SELECT nullif(title, '') AS title, text, subject, date FROM kept
QUALIFY trim(coalesce(title, ''), """ + UNICODE_WS_SQL + """) = '' OR row_number() OVER (PARTITION BY title ORDER BY cast(article_id AS varchar)) = 1"""
# A copy is new when it comes more than an hour after the copy before it.
ORACLE["d2_stream_sessions"] = CLEAN_KEPT + """
SELECT title, article_id, subject FROM (
  SELECT *, (cast(article_id AS bigint) * 37 % 11) * 45 AS minute FROM kept)
QUALIFY trim(coalesce(title, ''), """ + UNICODE_WS_SQL + """) = ''
     OR minute - lag(minute) OVER (PARTITION BY title ORDER BY minute, article_id) > 60
     OR row_number() OVER (PARTITION BY title ORDER BY minute, article_id) = 1"""
ORACLE["st3_console"] = with_ctes(ALL_ARTICLES) + "\nSELECT title, subject, date, article_id FROM all_articles"
ORACLE["st5b_feed_stream"] = ORACLE["k10_feed_messages"]
ORACLE["k1_stream_parquet"] = CLEAN_KEPT + "\nSELECT DISTINCT subject, date FROM kept"
