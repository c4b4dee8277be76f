"""Registered queries on long text and nested records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.catalog.registry import register
from patentloom.catalog.shaping import rounded
from patentloom.catalog.tables import Tables
from patentloom.catalog.views import sql_list
from patentloom.functions import text as text_functions
from patentloom.functions.text import IRREGULAR_LEMMAS, NO_PLURALS, STOP_WORDS
from patentloom.operators import joins, keywords, stitch, word_vectors
from patentloom.plans import players, records
from patentloom.session import scratch_path
from patentloom.sinks import files
from patentloom.sources import records as record_sources
from patentloom.sources import text as text_sources

BYTES_PER_PART = 256 << 10


def quoted_text(text: Column, number: Column) -> Column:
    """Texts some of whose lines start with a quote, a doubled or an unclosed one."""
    return (
        F.when(number % 5 == 0, F.concat(text, F.lit('\n"word" in quotes')))
        .when(number % 5 == 1, F.concat(text, F.lit('\n""Smart"" device\nmore text')))
        .when(number % 5 == 2, F.concat(text, F.lit('\n"never closed\nlast line')))
        .otherwise(text)
    )


def record_files(t: Tables) -> str:
    """The summaries as bulk text: a record opens with its quoted id."""
    path = scratch_path(t.spark, "text")
    text = quoted_text(F.col("summary_text"), F.col("patent_id").cast("long"))
    t.summaries.select(F.concat(F.lit('"'), "patent_id", F.lit('"\t'), text)).write.text(path)
    return path


def split_parts(t: Tables) -> str:
    """The bulk text once more as part files, cut without regard to records."""
    path = scratch_path(t.spark, "parts")
    lines = text_sources.read_lines(t.spark, record_files(t))
    parts = stitch.parts_of(lines, BYTES_PER_PART)
    files.write_text_parts(stitch.split_in_order(lines, parts), path)
    return path


def ordered_text_split(t: Tables) -> DataFrame:
    """Per record the digest of its lines in the order of the parts, and their number.

    A line out of place changes the digest of a record, or of two.
    """
    records = stitch.stitch_lines(text_sources.read_lines(t.spark, split_parts(t)))
    return records.select(
        "patent_id", F.length("summary_text").alias("n_chars"), F.md5("summary_text").alias("digest")
    )


QUOTED = """(SELECT patent_id, summary_text || CASE CAST(patent_id AS BIGINT) % 5
        WHEN 0 THEN chr(10) || '"word" in quotes'
        WHEN 1 THEN chr(10) || '""Smart"" device' || chr(10) || 'more text'
        WHEN 2 THEN chr(10) || '"never closed' || chr(10) || 'last line' ELSE '' END
        AS summary_text FROM summaries)"""
STITCHED = r"""
    SELECT patent_id,
           regexp_replace(
               array_to_string(
                   list_transform(string_split(summary_text, chr(10)),
                                  lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), ' '),
               '^\s+|\s+$', '', 'g') AS summary_text
    FROM """ + QUOTED
register(
    "ordered_text_split",
    ordered_text_split,
    f"""SELECT patent_id, CAST(length(summary_text) AS INTEGER) AS n_chars,
               md5(summary_text) AS digest
        FROM ({STITCHED})""",
)
register(
    "stitch_records",
    lambda t: text_sources.read_quoted_records(t.spark, record_files(t)),
    STITCHED,
)
register(
    "stitch_split_parts",
    lambda t: stitch.stitch_lines(text_sources.read_lines(t.spark, split_parts(t))),
    STITCHED,
)
register(
    "text_for_selected",
    lambda t: joins.matching(t.summaries, t.stored_filtered_patents, "patent_id"),
    """SELECT * FROM summaries WHERE patent_id IN (SELECT patent_id FROM filtered_patents)""",
)

TOKENS = r"list_filter(string_split_regex(lower(summary_text), '\s'), lambda w: w <> '')"
KEPT = f"list_filter({TOKENS}, lambda w: NOT list_contains({sql_list(STOP_WORDS)}, w))"


def word_summary(t: Tables, column: str) -> DataFrame:
    """Number of words and a digest of all of them in order."""
    words = keywords.words_of(t.summaries)
    return words.select(
        "patent_id",
        F.size(column).alias("n_words"),
        F.md5(F.concat_ws(" ", column)).alias("digest"),
    )


for name, column, sql in [
    ("tokenize", "words", TOKENS),
    ("remove_stopwords", "filtered_words", KEPT),
]:
    register(
        name,
        lambda t, column=column: word_summary(t, column),
        f"""SELECT patent_id, CAST(len(w) AS INTEGER) AS n_words,
                   md5(array_to_string(w, ' ')) AS digest
            FROM (SELECT patent_id, {sql} AS w FROM summaries)""",
    )

def tfidf_sql(texts: str) -> str:
    return f"""
    WITH texts AS ({texts}),
    tf AS (
        SELECT patent_id, term, count(*) AS tf
        FROM (SELECT patent_id, unnest({TOKENS}) AS term FROM texts)
        WHERE NOT list_contains({sql_list(STOP_WORDS)}, term) GROUP BY 1, 2),
    df AS (SELECT term, count(*) AS doc_freq FROM tf GROUP BY 1),
    scored AS (
        SELECT patent_id, term, tf, doc_freq,
               round(tf * ln(((SELECT count(*) FROM texts) + 1) / (doc_freq + 1)), 9)
                   AS score
        FROM tf JOIN df USING (term)),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY patent_id ORDER BY score DESC, term) AS rank
        FROM scored)
"""


TFIDF = tfidf_sql("SELECT * FROM summaries")
register(
    "tfidf_keywords",
    lambda t: rounded(keywords.tfidf_keywords(t.summaries), "score"),
    TFIDF
    + """SELECT patent_id, CAST(rank AS INTEGER) AS rank, term AS keyword, tf, doc_freq,
                round(score, 6) AS score
         FROM ranked WHERE rank <= 20""",
)


def clean_keywords(t: Tables) -> DataFrame:
    lists = keywords.keyword_lists(keywords.tfidf_keywords(t.summaries))
    text = text_functions.keyword_string(F.transform("keywords", lambda k: k["_1"]))
    return lists.select(
        "patent_id", text_functions.cleaned_keyword_string(text).alias("keywords")
    )


CLEANED = r"""
    trim(regexp_replace(regexp_replace(regexp_replace(
        {text}, '["''\[\]{{}}().]', '', 'g'), ',,+', ',', 'g'), '(^,|,$)', '', 'g'))"""
register(
    "clean_keywords",
    clean_keywords,
    TFIDF
    + f"""SELECT patent_id, {CLEANED.format(text="keywords")} AS keywords
          FROM (SELECT patent_id, string_agg(term, ', ' ORDER BY rank) AS keywords
                FROM ranked WHERE rank <= 20 GROUP BY 1)""",
)

CONTEXTS = f"""
    WITH words AS (
        SELECT patent_id, unnest(w) AS term, generate_subscripts(w, 1) AS pos
        FROM (SELECT patent_id, {KEPT} AS w FROM summaries)),
    bytes AS (
        SELECT near, CAST('0x' || substr(md5(near), 2 * i + 1, 2) AS INTEGER) AS byte
        FROM (SELECT DISTINCT term AS near FROM words), (SELECT unnest(range(4)) AS i)),
    sums AS (
        SELECT term, byte % 64 AS dim, sum(CASE WHEN byte & 64 > 0 THEN n ELSE -n END) AS c
        FROM (SELECT a.term, b.term AS near, count(*) AS n
              FROM words a JOIN words b ON a.patent_id = b.patent_id
               AND b.pos BETWEEN a.pos - 2 AND a.pos + 2 AND b.pos <> a.pos GROUP BY 1, 2)
        JOIN bytes USING (near) GROUP BY 1, 2),
    vectors AS (
        SELECT term, dim, sign(c) * (abs(c) * 127 // greatest(most, 1)) AS q
        FROM (SELECT *, max(abs(c)) OVER (PARTITION BY term) AS most FROM sums))
"""
register(
    "word_vectors",
    lambda t: word_vectors.word_vectors(t.summaries).select(
        "term", F.concat_ws(",", F.col("vector").cast("array<string>")).alias("vector")
    ),
    CONTEXTS
    + """SELECT x.term, string_agg(CAST(coalesce(q, 0) AS INTEGER), ',' ORDER BY d) AS vector
         FROM (SELECT term, unnest(range(64)) AS d FROM (SELECT DISTINCT term FROM vectors)) x
         LEFT JOIN vectors v ON v.term = x.term AND v.dim = d GROUP BY x.term""",
)
register(
    "embedding_keywords",
    lambda t: word_vectors.vector_keywords(t.summaries),
    CONTEXTS
    + """, tf AS (SELECT patent_id, term, count(*) AS tf FROM words GROUP BY 1, 2),
    df AS (SELECT term, count(*) AS doc_freq FROM tf GROUP BY 1 HAVING count(*) >= 2),
    weighted AS (
        SELECT patent_id, term, dim, q, tf * length(bin(
                   (SELECT count(*) FROM summaries) // doc_freq)) AS weight
        FROM tf JOIN df USING (term) JOIN vectors USING (term)),
    doc AS (SELECT patent_id, dim, sum(weight * q) AS d FROM weighted GROUP BY 1, 2),
    lengths AS (SELECT patent_id, sqrt(CAST(sum(d * d) AS DOUBLE)) AS length FROM doc GROUP BY 1),
    scored AS (
        SELECT patent_id, term,
               round(coalesce(CAST(sum(q * d) AS DOUBLE) / nullif(
                   sqrt(CAST(sum(q * q) AS DOUBLE)) * any_value(length), 0), 0), 6) AS score
        FROM weighted JOIN doc USING (patent_id, dim) JOIN lengths USING (patent_id)
        GROUP BY 1, 2),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY patent_id ORDER BY score DESC, term) AS rank
        FROM scored)
    SELECT patent_id, CAST(rank AS INTEGER) AS rank, term AS keyword, score
    FROM ranked WHERE rank <= 5""",
)

# The SQL states the lemma rule in its own terms: singulars that occur, first form first.
LEMMAS = f"""
    forms AS (
        SELECT word, rule, form FROM (
            SELECT word, 1 AS rule, left(word, -3) || 'y' AS form FROM vocabulary
            WHERE word LIKE '%ies' AND left(right(word, 4), 1) NOT IN ('a', 'e', 'i', 'o', 'u')
            UNION ALL SELECT word, 2, left(word, -1) FROM vocabulary
            WHERE word LIKE '%s' AND word NOT LIKE '%ss'
            UNION ALL SELECT word, 3, left(word, -2) FROM vocabulary
            WHERE word LIKE '%ses' OR word LIKE '%xes' OR word LIKE '%zes' OR word LIKE '%ches'
               OR word LIKE '%shes')
        WHERE length(word) > 3 AND NOT list_contains({sql_list(NO_PLURALS)}, word)),
    irregular(word, form) AS (VALUES {", ".join(f"('{k}', '{v}')" for k, v in IRREGULAR_LEMMAS.items())}),
    lemmas AS (
        SELECT v.word, coalesce(any_value(i.form), arg_min(f.form, f.rule), v.word) AS lemma
        FROM vocabulary v LEFT JOIN irregular i USING (word)
        LEFT JOIN (SELECT * FROM forms WHERE form IN (SELECT word FROM vocabulary)) f USING (word)
        GROUP BY v.word)"""
register(
    "lemmatize_keywords",
    lambda t: keywords.lemmatized(
        keywords.term_frequencies(t.summaries).select(F.col("term").alias("keyword")).distinct()
    ),
    f"""WITH vocabulary AS (
            SELECT DISTINCT term AS word
            FROM (SELECT unnest({TOKENS}) AS term FROM summaries)
            WHERE NOT list_contains({sql_list(STOP_WORDS)}, term)), {LEMMAS}
        SELECT word AS keyword, lemma AS normalized_keyword FROM lemmas WHERE trim(lemma) <> ''""",
)


def branch_keywords(t: Tables) -> DataFrame:
    """Top keywords per branch, by tf-idf among the filtered patents."""
    texts = joins.matching(t.summaries, t.stored_filtered_patents, "patent_id")
    ranked = players.ranked_keywords(t.stored_filtered_patents, keywords.keyword_table(texts))
    return ranked.select(
        "branch", F.col("normalized_keyword").alias("keyword"), "keyword_count",
        "total_weight", "rank",
    )


register(
    "top_keywords_by_branch",
    lambda t: rounded(branch_keywords(t), "total_weight"),
    tfidf_sql(
        "SELECT * FROM summaries WHERE patent_id IN (SELECT patent_id FROM filtered_patents)"
    )
    + f""", keywords AS (SELECT patent_id, term AS keyword, score FROM ranked WHERE rank <= 20),
        vocabulary AS (SELECT DISTINCT keyword AS word FROM keywords), {LEMMAS},
        counts_by_branch AS (
            SELECT branch, lemma AS keyword, count(*) AS n,
                   CAST(sum(CAST(score AS DECIMAL(20, 9))) AS DOUBLE) AS weight
            FROM keywords JOIN lemmas ON word = keyword JOIN filtered_patents USING (patent_id)
            GROUP BY 1, 2),
        ranked_by_branch AS (
            SELECT *, row_number() OVER (PARTITION BY branch
                                         ORDER BY n * weight DESC, keyword) AS rank
            FROM counts_by_branch WHERE trim(keyword) <> '')
        SELECT branch, keyword, n AS keyword_count, round(weight, 6) AS total_weight,
               CAST(rank AS INTEGER) AS rank
        FROM ranked_by_branch WHERE rank <= 50""",
)

# --- nested records ----------------------------------------------------------------


def api_scan(t: Tables) -> DataFrame:
    """The nested records written as JSON lines and scanned with their schema."""
    path = scratch_path(t.spark, "api")
    t.api_records.write.json(path)
    return record_sources.read_api_records(t.spark, path)


def flat_parties(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "inventors": F.array_join(
                F.transform("inventors", lambda p: F.concat_ws(":", p["inventor_name"], p["gender"])),
                "|",
            ),
            "applicants": F.array_join(
                F.transform("applicants", lambda p: p["organization"]), "|"
            ),
        }
    )


def monthly_json(t: Tables) -> DataFrame:
    """Normalised records after writing them by month and reading them back."""
    path = scratch_path(t.spark, "monthly")
    normal = records.normalize(t.api_records, 2024)
    files.write_monthly_json(normal.drop("month"), path, "patent_date")
    back = t.spark.read.schema(normal.schema).json(path)
    return flat_parties(back)


PUBLISHED = """CASE WHEN event_id % 67 = 0 THEN '2024-02-31'
                    WHEN event_id % 61 = 0 THEN NULL
                    WHEN event_id % 59 = 0 THEN '2023-12-30'
                    ELSE CAST(CAST(CAST(ts AS DATE) + CAST(event_id % 300 AS INTEGER) AS DATE)
                              AS VARCHAR) END"""
NORMAL = f"""
    SELECT CAST(event_id AS VARCHAR) AS patent_id,
           CAST(CASE WHEN event_id % 41 = 0 THEN 0
                     ELSE list_sum(list_transform(range(1, event_id % 3 + 2),
                                                  lambda i: (user_id + i) % 4 + 1)) END
                AS INTEGER) AS num_claims,
           published AS patent_date, event_type AS branch,
           array_to_string(list_transform(
               list_filter(range(0, event_id % 3 + 1), lambda i: (user_id + i) % 5 <> 0),
               lambda i: 'inventor ' || (user_id + i) || ':U'), '|') AS inventors,
           CASE WHEN event_id % 43 = 0 THEN ''
                ELSE array_to_string(list_transform(
                    list_filter(range(0, event_id % 2 + 1), lambda i: (user_id + i) % 7 <> 0),
                    lambda i: 'company ' || (user_id + i)), '|') END AS applicants,
           strftime(CAST(published AS DATE), '%Y_%b') AS month
    FROM (SELECT *, {PUBLISHED} AS published FROM events)
    WHERE year(try_cast(published AS DATE)) = 2024"""
register(
    "normalize_api_records", lambda t: flat_parties(records.normalize(api_scan(t), 2024)), NORMAL
)
register("monthly_json", monthly_json, NORMAL)
register(
    "latest_per_branch",
    lambda t: records.latest_per_branch(api_scan(t)).select(
        "doc_number", "branch", "date_published", "rank"
    ),
    f"""SELECT doc_number, branch, date_published, CAST(rank AS INTEGER) AS rank
        FROM (SELECT *, row_number() OVER (PARTITION BY branch
                                           ORDER BY try_cast(date_published AS DATE) DESC NULLS LAST,
                                                    doc_number) AS rank
              FROM (SELECT CAST(event_id AS VARCHAR) AS doc_number, event_type AS branch,
                           {PUBLISHED} AS date_published
                    FROM events WHERE event_id % 41 <> 0 AND event_id % 43 <> 0))
        WHERE rank <= 100""",
)
register(
    "created_after",
    lambda t: records.created_after(api_scan(t), "2024-11-11").select(
        "doc_number", "branch", "date_published"
    ),
    f"""SELECT doc_number, branch, date_published
        FROM (SELECT CAST(event_id AS VARCHAR) AS doc_number, event_type AS branch,
                     {PUBLISHED} AS date_published FROM events)
        WHERE try_cast(date_published AS DATE) > DATE '2024-11-11'""",
)
