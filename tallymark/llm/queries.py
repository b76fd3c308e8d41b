"""One query per operator, on whole tables, with the SQL that checks it where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallymark.functions.names import col
from tallymark.llm import (
    bpe,
    centroids,
    fingerprint,
    forest,
    html_text,
    lm,
    mixing,
    quality,
    resampling,
    suffix_dedup,
    token_counts,
    toxicity,
    warc,
)
from tallymark.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401

# -- op10: mixing sources to target weights ---------------------------------------------

MIXING_SQL = r"""
WITH sized AS (
  SELECT doc_id, source,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         substr(md5('mix|' || coalesce(doc_id::VARCHAR, '')), 1, 16) AS key,
         CASE WHEN source IS NULL THEN 'z' ELSE 's' || source END AS src
  FROM documents),
sources AS (
  SELECT src, sum(size)::BIGINT AS source_size, 2 * sum(size)::BIGINT AS cap,
         [5, 2, 1][((row_number() OVER (ORDER BY src) - 1) % 3 + 1)::INT] AS weight
  FROM sized GROUP BY src),
filled AS (
  SELECT *, cap::DOUBLE / weight AS ratio,
         (1.5::DOUBLE * sum(source_size) OVER ()
          - coalesce(sum(cap) OVER (ORDER BY cap::DOUBLE / weight, src
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(weight) OVER (ORDER BY cap::DOUBLE / weight, src
                             ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)::DOUBLE AS level
  FROM sources),
levelled AS (
  SELECT *, max(CASE WHEN level <= ratio THEN level END) OVER () AS water FROM filled),
targets AS (
  SELECT src, source_size, least(cap::DOUBLE, coalesce(water * weight, cap::DOUBLE)) AS target FROM levelled),
placed AS (
  SELECT doc_id, size, source_size, target,
         coalesce(sum(size) OVER (PARTITION BY src ORDER BY key, doc_id, size
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start,
         floor(target)::BIGINT AS budget,
         CASE WHEN source_size > 0 THEN floor(target)::BIGINT // source_size ELSE 0 END AS epochs
  FROM sized JOIN targets USING (src))
SELECT doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - start)))::BIGINT AS taken
FROM placed
"""


@query(MIXING_SQL)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return mixing.mix(docs, mixing.word_count(col("text"))).select(
        "doc_id", "size", "source_size", "target", "taken"
    )

# -- op1: quality rules --------------------------------------------------------------------

QUALITY_SQL = r"""
WITH docs AS (
  SELECT doc_id, lang, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
windows AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, ws[i:i + 7]) AS times
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM docs)),
repeats AS (
  SELECT doc_id, count(DISTINCT i + j) AS n_repeat_words
  FROM windows, (SELECT unnest(range(0, 8)) AS j) WHERE times > 1 GROUP BY doc_id),
lined AS (
  SELECT *, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM docs),
base AS (
  SELECT doc_id, lang, t, len(ws)::BIGINT AS n_words,
         length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
         len(ws) < 20 OR 100 * coalesce(n_repeat_words, 0) > 30 * len(ws) AS base_failed,
         regexp_extract_all(regexp_replace(lower(t), '[!-/:-@\[-`{-~]', ' ', 'g'), '[^\x20\x09-\x0D]+') AS terms
  FROM lined LEFT JOIN repeats USING (doc_id)),
classes AS (
  SELECT doc_id, lang, cls, n,
         sum(n) OVER (PARTITION BY doc_id) AS chars,
         sum(CASE WHEN cls <> 'space' THEN n ELSE 0 END) OVER (PARTITION BY doc_id) AS inked
  FROM (
    SELECT doc_id, lang, unnest(['lower', 'upper', 'letter', 'digit', 'space', 'stop', 'symbol', 'other']) AS cls,
           unnest([
             length(t) - length(regexp_replace(t, '\p{Ll}', '', 'g')),
             length(t) - length(regexp_replace(t, '[\p{Lu}\p{Lt}]', '', 'g')),
             length(t) - length(regexp_replace(t, '[\p{Lo}\p{Lm}\p{Mn}\p{Mc}]', '', 'g')),
             length(t) - length(regexp_replace(t, '\p{Nd}', '', 'g')),
             length(t) - length(regexp_replace(t, '[\x09-\x0D\p{Zs}]', '', 'g')),
             length(t) - length(regexp_replace(t, '[.,;:''"\-()?]', '', 'g')),
             length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')),
             length(regexp_replace(t, '[\p{L}\p{Mn}\p{Mc}\p{Nd}\p{Zs}\x09-\x0D.,;:''"\-()?#*$%&|<>]', '', 'g'))
           ]) AS n FROM base)),
learn AS (SELECT doc_id, lang, terms FROM base WHERE NOT base_failed AND 100 * n_symbols <= length(t)),
class_ref AS (
  SELECT lang, cls, sum(n) / sum(sum(n)) OVER (PARTITION BY lang) AS q
  FROM classes SEMI JOIN learn USING (doc_id) GROUP BY lang, cls),
vocabulary AS (
  SELECT lang, term, count(*) AS n, sum(count(*)) OVER (PARTITION BY lang) AS total
  FROM (SELECT lang, unnest(terms) AS term FROM learn) GROUP BY lang, term),
word_ref AS (
  SELECT lang, term, n / total AS q FROM vocabulary WHERE n >= 0.005 * total
  UNION ALL
  SELECT lang, NULL, 1 - sum(CASE WHEN n >= 0.005 * total THEN n ELSE 0 END) / min(total)
  FROM vocabulary GROUP BY lang),
tallies AS (
  SELECT doc_id, term, count(*) AS n FROM (SELECT doc_id, unnest(terms) AS term FROM base) GROUP BY doc_id, term),
held AS (
  SELECT b.doc_id, len(b.terms) AS n_terms, r.term, r.q, coalesce(c.n, 0) / len(b.terms) AS p
  FROM base b JOIN word_ref r ON r.lang IS NOT DISTINCT FROM b.lang AND r.term IS NOT NULL
  LEFT JOIN tallies c ON c.doc_id = b.doc_id AND c.term = r.term
  WHERE len(b.terms) >= 60),
word_hist AS (
  SELECT doc_id, n_terms, q, p FROM held
  UNION ALL
  SELECT doc_id, min(n_terms), 1 - sum(q), 1 - sum(p) FROM held GROUP BY doc_id),
class_distance AS (
  SELECT doc_id, min(inked) AS inked, sqrt(greatest(0, sum(
      CASE WHEN n > 0 THEN n / chars * log2(n / chars / ((n / chars + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((n / chars + q) / 2)) ELSE 0 END) / 2)) AS d
  FROM classes c JOIN class_ref r ON r.lang IS NOT DISTINCT FROM c.lang AND r.cls = c.cls
  WHERE inked >= 60 GROUP BY doc_id),
word_distance AS (
  SELECT doc_id, min(n_terms) AS n_terms, sqrt(greatest(0, sum(
      CASE WHEN p > 0 THEN p * log2(p / ((p + q) / 2)) ELSE 0 END
      + CASE WHEN q > 0 THEN q * log2(q / ((p + q) / 2)) ELSE 0 END) / 2)) AS d
  FROM word_hist GROUP BY doc_id)
SELECT b.doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(c.d <= 0.12 + 1.8 / sqrt(c.inked), true)
                       AND coalesce(w.d <= 0.12 + 2.4 / sqrt(w.n_terms), true) AS kept
FROM base b LEFT JOIN class_distance c ON c.doc_id = b.doc_id LEFT JOIN word_distance w ON w.doc_id = b.doc_id
"""


@query(QUALITY_SQL)
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality.judge(docs, quality.learn_references(docs)).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )

# -- op4, op5: token counts, BPE ----------------------------------------------------------


@query()
def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = token_counts.count_tokens(docs, public_tokenizers.path("piece_bpe_32k.model"))
    return counted.select("doc_id", "n_words", "n_tokens", "token_score")


@query()
def op5_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode_decode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return encoded.select(
        "doc_id", "n_tokens", F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )

# -- op2: HTML extraction -------------------------------------------------------------------


@query()
def op2_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_text.extract(pages).select(
        "page_id", "url", "text", F.char_length("text").cast("bigint").alias("n_chars")
    )

# -- op6: WARC --------------------------------------------------------------------------------

WARC_SQL = """
WITH hashed AS (
  SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS payload_bytes,
         sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
latest AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS keeper FROM hashed)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM latest
"""


@query(WARC_SQL)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archives = warc.write_archives(table(spark, sf_dir, "pages"))
    return warc.read_records(archives, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )

# -- op9: document fingerprints -----------------------------------------------------------------


@query()
def op9_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.compare_edited(table(spark, sf_dir, "documents").select("doc_id", "text"))

# -- op8: toxicity ----------------------------------------------------------------------------------


def held_out(id_col: str, parts: int, rest: int):
    """Whether the checksum of an id's text leaves this rest."""
    return F.pmod(F.crc32(col(id_col).cast("string")), F.lit(parts)) == rest


@query()
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").filter(~held_out("doc_id", 5, 0))
    scored = toxicity.score(docs, toxicity.learn(docs, labels))
    return scored.select("doc_id", F.coalesce(held_out("doc_id", 5, 0), F.lit(False)).alias("held_out"), "score", "predicted")

# -- op7: language-model scores -----------------------------------------------------------------------


@query()
def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = F.coalesce(held_out("doc_id", 7, 2), F.lit(False))
    model = lm.train(docs.filter(~held).select("text"))
    return lm.score(docs, held, model)

# -- op3: n-gram Jaccard join -----------------------------------------------------------------------------


@query()
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.link(table(spark, sf_dir, "documents").select("doc_id", "text"))

# -- op11: suffix-array dedup ---------------------------------------------------------------------------------

REPEATS_SQL = """
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b,
         octet_length(encode(coalesce(text, '')))::BIGINT AS n
  FROM documents),
windows AS (
  SELECT r, doc_id, unnest(range(1, n - 48)) AS p,
         unnest(list_transform(range(1, n - 48), lambda i: b[i:i + 49])) AS w
  FROM docs WHERE doc_id IS NOT NULL AND n >= 50),
hits AS (
  SELECT r, p FROM (SELECT r, doc_id, p, min(doc_id) OVER (PARTITION BY w) AS least FROM windows) WHERE least < doc_id),
runs AS (
  SELECT r, p, sum(opens) OVER (PARTITION BY r ORDER BY p) AS g
  FROM (SELECT r, p, CASE WHEN p - lag(p) OVER (PARTITION BY r ORDER BY p) <= 50 THEN 0 ELSE 1 END AS opens FROM hits)),
spans AS (SELECT r, g, min(p) AS a, max(p) + 49 AS z FROM runs GROUP BY r, g),
gaps AS (
  SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) + 1 AS lo, a - 1 AS hi FROM spans
  UNION ALL SELECT r, max(z) + 1, NULL FROM spans GROUP BY r),
kept AS (
  SELECT r, unhex(string_agg(hex(b[lo:coalesce(hi, n)]), '' ORDER BY lo)) AS k FROM gaps JOIN docs USING (r) GROUP BY r),
totals AS (SELECT r, sum(z - a + 1)::BIGINT AS n_removed, count(*) AS n_spans FROM spans GROUP BY r)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans,
       sha256(coalesce(k, b)) AS kept_sha256
FROM docs LEFT JOIN totals USING (r) LEFT JOIN kept USING (r)
"""


@query(REPEATS_SQL)
def op11_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = suffix_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))

# -- op12: centroid clustering ----------------------------------------------------------------------------------


def _cluster_sql(rounds: int = 5, clusters: int = 40) -> str:
    """The same rounds one after another; all values are whole numbers that a double holds exactly."""
    steps = []
    for i in range(rounds + 1):
        steps.append(f"""
near{i} AS MATERIALIZED (
  SELECT r, cluster, distance FROM (
    SELECT r, cluster, distance, row_number() OVER (PARTITION BY r ORDER BY distance, cluster) AS nth
    FROM (SELECT r, cluster, list_dot_product(v, v) - 2 * list_dot_product(v, c) + list_dot_product(c, c) AS distance
          FROM kept, centroids{i}))
  WHERE nth = 1)""")
        if i < rounds:
            steps.append(f"""
centroids{i + 1} AS MATERIALIZED (
  SELECT cluster, coalesce(m, c) AS c FROM centroids{i} LEFT JOIN (
    SELECT cluster, list(floor(total / n) ORDER BY pos) AS m FROM (
      SELECT cluster, pos, sum(x) AS total, count(*) AS n
      FROM (SELECT cluster, unnest(range(1, 65)) AS pos, unnest(v) AS x FROM near{i} JOIN kept USING (r))
      GROUP BY cluster, pos)
    GROUP BY cluster) USING (cluster))""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64),
centroids0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY h, v) - 1)::INT AS cluster, v AS c
  FROM (SELECT sha256('2:' || vec_id) AS h, v FROM kept ORDER BY h, v LIMIT {clusters})),
{",".join(steps)}
SELECT vec_id, cluster, distance::BIGINT AS distance,
       (sum(distance) OVER (PARTITION BY cluster))::BIGINT AS cluster_inertia, (sum(distance) OVER ())::BIGINT AS inertia,
       sha256(list_aggregate(list_transform(c, lambda x: x::BIGINT), 'string_agg', ',')) AS centroid_sha256
FROM near{rounds} JOIN kept USING (r) JOIN centroids{rounds} USING (cluster)
"""


@query(_cluster_sql())
def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.cluster(table(spark, sf_dir, "embeddings"))

# -- op13: target-distribution importance resampling --------------------------------------------------------------


@query()
def op13_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resample(docs, table(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")
