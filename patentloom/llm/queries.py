"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom.llm import (
    automaton_dedup,
    benchmark_scan,
    embedding_dedup,
    filter_audit,
    line_dedup,
    ngram_join,
    packing,
    phrase_mining,
    quality,
    sentencepiece_lattice,
    suffix_dedup,
    toxicity,
    url_reputation,
)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Model file of the public tokenizer that encodes the corpus.
TOKENIZER = os.environ.get("SENTENCEPIECE_MODEL", "/opt/tokenizers/piece_bpe_32k.model")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every text encoded and decoded again."""
    pieces = sentencepiece_lattice.load(TOKENIZER)
    encoded = sentencepiece_lattice.encode(read(spark, sf_dir, "documents"), pieces)
    decoded = sentencepiece_lattice.decode(encoded, pieces)
    return decoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.Model:
    """Learnt from labelled rows that are not held out (crc32 of the id mod 3 is not 1)."""
    labels = read(spark, sf_dir, "labels").where(~held_out(F.col("doc_id")))
    return toxicity.train(docs, labels)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity_model(spark, docs, sf_dir))
    return scored.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted"
    )


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link_documents(read(spark, sf_dir, "documents"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = automaton_dedup.remove_repeated_words(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op5_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))


def op6_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeated_bytes(read(spark, sf_dir, "documents"))
    return out.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2(F.col("kept"), 256).alias("kept_sha256")
    )


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = benchmark_scan.scan(docs, read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    out = line_dedup.dedup_lines(docs)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; the site of a document is that of the page with its number."""
    return quality.score(
        read(spark, sf_dir, "documents"),
        read(spark, sf_dir, "labels"),
        quality.sites_of(read(spark, sf_dir, "pages")),
    )


def op10_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page; a labelled page of low quality is a bad outcome."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    labels = read(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("page_id"), (1 - F.col("quality")).alias("bad")
    )
    outcomes = pages.join(labels, "page_id").select(
        url_reputation.split_url(F.col("url"))[0].alias("host"), "bad"
    )
    return url_reputation.judge_urls(pages, outcomes).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op11_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.mine_phrases(read(spark, sf_dir, "documents").select("text", "lang"))


def op12_filter_interaction_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(
        read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    )


#: Tokenizer of packed sequences, and the id that ends a document.
PACKED_TOKENIZER = os.environ.get("PACKING_TOKENIZER", "/opt/tokenizers/word_bpe_49k.json")
PACKED_END = 2


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(read(spark, sf_dir, "documents"), PACKED_TOKENIZER, PACKED_END)
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_toxicity": op2_toxicity,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_substring_dedup": op4_substring_dedup,
    "op5_embedding_near_dedup": op5_embedding_near_dedup,
    "op6_suffix_array_dedup": op6_suffix_array_dedup,
    "op7_benchmark_decontamination": op7_benchmark_decontamination,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_url_filters": op10_url_filters,
    "op11_phrase_mining": op11_phrase_mining,
    "op12_filter_interaction_audit": op12_filter_interaction_audit,
    "op13_packing": op13_packing,
}

SQL: dict[str, str] = {
    "op3_ngram_jaccard_join": r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, md5(array_to_string(w[i:i + 4], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS i
    FROM words)
), sizes AS (
  SELECT doc_id, count(h) AS n FROM words LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.h = y.h AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared o JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE 100 * o.n >= 80 * (x.n + y.n - o.n)
), reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), component AS (
  SELECT a AS doc_id, least(a, min(b)) AS c FROM reached GROUP BY a
)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id
FROM sizes LEFT JOIN component USING (doc_id)
""",
    "op4_substring_dedup": r"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), windows AS (
  SELECT doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) AS h
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM words)
), repeated AS (
  SELECT doc_id, s
  FROM (SELECT *, row_number() OVER (PARTITION BY h ORDER BY doc_id, s) AS nth FROM windows)
  WHERE nth > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM repeated
), kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY i) AS text, count(*) AS n
  FROM (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM words)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed,
  sha256(coalesce(text, '')) AS kept_sha256
FROM words LEFT JOIN kept USING (doc_id)
""",
    "op6_suffix_array_dedup": """
WITH bytes AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 100)) AS h
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM bytes)
), repeated AS (
  SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM windows)
  WHERE first < doc_id
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM repeated
), runs AS (
  SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE last IS NULL OR last < i - 1) AS spans
  FROM (SELECT *, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS last FROM gone)
  GROUP BY doc_id
), kept AS (
  SELECT doc_id, string_agg(substr(x, 2 * i + 1, 2), '' ORDER BY i) AS x
  FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2)) AS i FROM bytes)
  ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id
)
SELECT doc_id, (length(b.x) // 2)::BIGINT AS n_bytes, coalesce(n, 0)::BIGINT AS n_removed,
  coalesce(spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.x, ''))) AS kept_sha256
FROM bytes b LEFT JOIN runs USING (doc_id) LEFT JOIN kept k USING (doc_id)
""",
    "op5_embedding_near_dedup": """
WITH RECURSIVE good AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings
  WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x)
    OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b
  ON a.label = b.label AND a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.93
), reached(a, b) AS (
  SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), component AS (
  SELECT a AS vec_id, least(a, min(b)) AS component_id FROM reached GROUP BY a
)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id) AS n_links,
  coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN component USING (vec_id)
""",
    "op7_benchmark_decontamination": r"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), item_words AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), item_windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[i:i + least(10, len(w)) - 1],
    ' ') AS s
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i FROM item_words
    WHERE len(w) > 0)
), doc_windows AS (
  SELECT doc_id, i, k, array_to_string(w[i:i + k - 1], ' ') AS s
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM doc_words, (SELECT DISTINCT k FROM item_windows))
), hits AS (
  SELECT doc_id, i, k, item_id FROM doc_windows JOIN item_windows USING (k, s)
), hit_words AS (
  SELECT doc_id, count(DISTINCT j) AS n FROM (
    SELECT doc_id, unnest(range(i, i + k)) AS j FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(h.n, 0)::BIGINT AS n_hit,
  coalesce(t.n, 0)::BIGINT AS n_items, sha256(coalesce(t.ids, '')) AS items_sha256,
  coalesce(h.n, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN hit_words h USING (doc_id) LEFT JOIN hit_items t USING (doc_id)
""",
    "op10_url_filters": r"""
WITH cut AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3)
    ELSE '' END AS rest FROM pages
), parsed AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^([^/?#]*)', 1),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM cut
), named AS (
  SELECT *, regexp_extract(host,
      '(^|\.)(((ac|co|com|edu|gov|net|org)\.[a-z][a-z]|[^.]*))$', 2) AS suffix,
    regexp_extract(host,
      '(^|\.)(([^.]*\.)?((ac|co|com|edu|gov|net|org)\.[a-z][a-z]|[^.]*))$', 2) AS domain
  FROM parsed
), rules(kind, rule_host, rule_path) AS (
  VALUES ('allow', 'org', '/'), ('block', 'example.org', '/es/'),
    ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')
), fitting AS (
  SELECT page_id, arg_max(rule_host || rule_path, length(rule_host || rule_path)) AS rule,
    arg_max(kind, length(rule_host || rule_path)) AS said
  FROM (SELECT DISTINCT page_id, host, path FROM named)
  JOIN rules ON starts_with(path, rule_path)
    AND (host = rule_host OR suffix(host, '.' || rule_host))
  GROUP BY page_id
), host_counts AS (
  SELECT host, domain, n.suffix, count(*) AS n, sum(1 - quality)::BIGINT AS bad
  FROM named n JOIN labels l ON l.doc_id = n.page_id
  WHERE host <> '' AND quality IS NOT NULL GROUP BY ALL
), overall AS (
  SELECT (coalesce(sum(bad), 0) + 1.0::DOUBLE) / (coalesce(sum(n), 0) + 2.0::DOUBLE) AS p,
    coalesce(sum(n), 0) + 2.0::DOUBLE AS size FROM host_counts
), levels AS (
  SELECT 'suffix' AS level, suffix AS key, NULL AS up, sum(n) AS n, sum(bad) AS bad
  FROM host_counts GROUP BY suffix
  UNION ALL SELECT 'domain', domain, suffix, sum(n), sum(bad) FROM host_counts
  GROUP BY domain, suffix
  UNION ALL SELECT 'host', host, domain, sum(n), sum(bad) FROM host_counts GROUP BY host, domain
), moments AS (
  SELECT level, count(*)::DOUBLE AS k, sum(n)::DOUBLE AS n, sum(n * n)::DOUBLE AS nn,
    sum(n * pow(bad::DOUBLE / n - p, 2)) AS s, any_value(p) AS p
  FROM levels, overall GROUP BY level
), spread AS (
  SELECT level, CASE WHEN n - nn / n - (k - 1) <= 0 THEN NULL ELSE
    least(greatest((s / (p * (1 - p)) - (k - 1)) / (n - nn / n - (k - 1)), 1e-9), 1.0) END AS rho
  FROM moments
), strength AS (
  SELECT level, CASE WHEN rho IS NULL THEN 1000.0 ELSE
    least(greatest((1 - rho) / rho, 2.0), 1000.0) END AS k FROM spread
), s_post AS (
  SELECT key, (bad + p * k) / (n + k) AS mean, n + k AS size
  FROM levels JOIN strength USING (level), overall WHERE level = 'suffix'
), d_post AS (
  SELECT l.key, (bad + mean * k) / (n + k) AS mean, n + k AS size
  FROM levels l JOIN strength USING (level) JOIN s_post u ON u.key = l.up
  WHERE level = 'domain'
), h_post AS (
  SELECT l.key, (bad + mean * k) / (n + k) AS mean, n + k AS size
  FROM levels l JOIN strength USING (level) JOIN d_post u ON u.key = l.up
  WHERE level = 'host'
), judged AS (
  SELECT page_id, host, path, coalesce(h.mean, d.mean, s.mean, p) AS m,
    coalesce(h.size, d.size, s.size, overall.size) AS z
  FROM named n LEFT JOIN h_post h ON h.key = n.host LEFT JOIN d_post d ON d.key = n.domain
  LEFT JOIN s_post s ON s.key = n.suffix, overall
)
SELECT page_id, host, path, rule,
  coalesce(said, CASE WHEN m - 1.645 * sqrt(m * (1 - m) / (z + 1)) > 0.5 THEN 'block'
    ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN fitting USING (page_id)
""",
    "op11_phrase_mining": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (
  SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces
), counts AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS a
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i
    FROM words, (SELECT unnest(range(1, 5)) AS k))
  GROUP BY ALL
), totals AS (
  SELECT lang, sum(a)::BIGINT AS n FROM counts WHERE k = 1 GROUP BY lang
), candidates AS (
  SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM counts WHERE k > 1 AND a >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.k, c.a, j, l.a AS l, r.a AS r,
    ((2000000::HUGEINT * c.a) // (l.a + r.a))::BIGINT AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM candidates) c
  JOIN counts l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[:j], ' ')
  JOIN counts r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[j + 1:], ' ')
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1
), inside AS (
  SELECT lang, array_to_string(w[i:i + size - 1], ' ') AS phrase, max(a) AS longer
  FROM (SELECT lang, w, a, k, size, unnest(range(1, k - size + 2)) AS i
    FROM (SELECT *, unnest(range(2, k)) AS size FROM candidates))
  GROUP BY ALL
), ranked AS (
  SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
    phrase, a, l, r, score
  FROM lowest LEFT JOIN inside USING (lang, phrase) WHERE coalesce(100 * longer < 80 * a, true)
)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
""",
    "op12_filter_interaction_audit": r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), marks AS (
  SELECT doc_id, max(quality = 1) AS good, max(toxic = 1) AS toxic FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, len(w) < 200 AS A, 100 * len(list_distinct(w)) < 50 * len(w) AS B,
    100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) AS C,
    regexp_matches(t, '[#$%&*|]') AS D,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS E,
    coalesce(good, false) AS good, coalesce(toxic, false) AS toxic
  FROM words LEFT JOIN marks USING (doc_id)
), failing AS (
  SELECT part, good, toxic, CASE WHEN A THEN 'A' ELSE '' END || CASE WHEN B THEN 'B' ELSE '' END
    || CASE WHEN C THEN 'C' ELSE '' END || CASE WHEN D THEN 'D' ELSE '' END
    || CASE WHEN E THEN 'E' ELSE '' END AS fails FROM judged
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT a.f || b.f || c.f || d.f || e.f AS filter_order
  FROM letters a JOIN letters b ON b.f <> a.f JOIN letters c ON c.f NOT IN (a.f, b.f)
  JOIN letters d ON d.f NOT IN (a.f, b.f, c.f) JOIN letters e ON e.f NOT IN (a.f, b.f, c.f, d.f)
), ranks AS (
  SELECT part, good, toxic, fails, filter_order, coalesce(list_min(list_transform(
    string_split(fails, ''), lambda f: nullif(instr(filter_order, f), 0))), 6) AS gone
  FROM (SELECT part, good, toxic, nullif(fails, '') AS fails FROM failing), orders
), counted AS (
  SELECT part, filter_order, step, filter_order[step] AS f, count(*) FILTER (gone > step) AS kept,
    count(*) FILTER (gone = step) AS removed,
    count(*) FILTER (gone < step AND contains(fails, filter_order[step])) AS redundant,
    count(*) FILTER (fails = filter_order[step]) AS unique_fails,
    count(*) FILTER (gone = step AND good) AS good_lost,
    count(*) FILTER (gone = step AND toxic) AS toxic_lost
  FROM ranks, (SELECT unnest(range(1, 6))::INTEGER AS step) GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::BIGINT AS shapley
FROM counted
""",
}


def llm_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    import corpus_pipeline

    return {**QUERIES, "pipeline": corpus_pipeline.run}


def llm_sql() -> dict[str, str]:
    import corpus_pipeline

    return SQL | ({"pipeline": corpus_pipeline.ORACLE_SQL} if corpus_pipeline.ORACLE_SQL else {})
