"""Registered queries on sources, sinks, quality, curated tables and joins."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from patentloom import schemas
from patentloom.catalog.registry import register
from patentloom.catalog.tables import Tables
from patentloom.functions import dates, names
from patentloom.functions import text as text_functions
from patentloom.operators import joins, quality
from patentloom.plans import curate
from patentloom.session import scratch_path
from patentloom.sinks import files
from patentloom.sinks.keyed import KeyedTable
from patentloom.sources import tabular

# --- sources -----------------------------------------------------------------------


def scan_tsv_typed(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "tsv")
    t.raw_patent.write.option("sep", "\t").option("header", True).csv(path)
    return tabular.read_tsv(t.spark, path, schemas.RAW_PATENT)


def scan_csv_inferred(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.cpc_info, path)
    return tabular.read_csv_inferred(t.spark, path)


def scan_csv_strings_cast(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.raw_patent, path)
    return tabular.read_csv_strings(
        t.spark, path, {"num_claims": "int", "patent_date": "date"}
    ).select("patent_id", "patent_type", "patent_date", "num_claims")


# Delimited text has no empty strings apart from nulls.
register(
    "scan_tsv_typed",
    scan_tsv_typed,
    "SELECT * REPLACE (nullif(patent_date, '') AS patent_date) FROM raw_patent",
)
register(
    "scan_csv_inferred",
    scan_csv_inferred,
    "SELECT * REPLACE (CAST(patent_id AS INTEGER) AS patent_id) FROM cpc_info",
)
register(
    "scan_csv_strings_cast",
    scan_csv_strings_cast,
    """SELECT patent_id, patent_type, try_cast(patent_date AS DATE) AS patent_date, num_claims
       FROM raw_patent""",
)
register(
    "scan_parquet",
    lambda t: tabular.read_parquet(t.spark, f"{t.sf_dir}/supplier.parquet"),
    "SELECT * FROM supplier",
)

# --- sinks -------------------------------------------------------------------------


def sink_parquet_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "parquet")
    files.overwrite_parquet(t.patent_info, path)
    return tabular.read_parquet(t.spark, path)


def sink_csv_roundtrip(t: Tables) -> DataFrame:
    path = scratch_path(t.spark, "csv")
    files.write_csv(t.patent_info, path, files=8)
    return tabular.read_csv(t.spark, path, t.patent_info.schema)


def sink_new_parquet(t: Tables) -> DataFrame:
    """A second write to the same path is refused and the first one stays."""
    path = scratch_path(t.spark, "new")
    files.new_parquet(t.patent_info, path)
    refused = False
    try:
        files.new_parquet(t.patent_info.limit(0), path)
    except AnalysisException:
        refused = True
    return tabular.read_parquet(t.spark, path).withColumn("refused", F.lit(refused))


def sink_single_csv(t: Tables) -> DataFrame:
    """A report as one CSV file, read back with the number of files it lies in."""
    path = scratch_path(t.spark, "single")
    report = t.patent_info.groupBy("patent_type").agg(F.count(F.lit(1)).alias("patents"))
    files.write_single_csv(report, path)
    back = tabular.read_csv(t.spark, path, report.schema)
    return back.withColumn("n_files", F.lit(len(back.inputFiles())))


def sink_append(t: Tables) -> DataFrame:
    """Two chunks appended one after the other."""
    path = scratch_path(t.spark, "append")
    odd = F.pmod(F.xxhash64("patent_id"), F.lit(2)) == 1
    files.append_parquet(t.patent_info.where(odd), path)
    files.append_parquet(t.patent_info.where(~odd), path)
    return tabular.read_parquet(t.spark, path)


def save_all_tables(t: Tables) -> DataFrame:
    """Row counts of the curated tables after saving and reading them back."""
    tables = {
        "applicant_info": t.applicant_info,
        "cpc_info": t.cpc_info,
        "inventor_info": t.inventor_info,
        "patent_info": t.patent_info,
    }
    path = scratch_path(t.spark, "tables")
    files.save_all(tables, path)
    counts = None
    for name in tables:
        one = tabular.read_parquet(t.spark, f"{path}/{name}").agg(
            F.lit(name).alias("table_name"), F.count(F.lit(1)).alias("row_count")
        )
        counts = one if counts is None else counts.unionByName(one)
    return counts


register("sink_parquet_roundtrip", sink_parquet_roundtrip, "SELECT * FROM patent_info")
register("sink_csv_roundtrip", sink_csv_roundtrip, "SELECT * FROM patent_info")
register("sink_new_parquet", sink_new_parquet, "SELECT *, true AS refused FROM patent_info")
register(
    "sink_single_csv",
    sink_single_csv,
    """SELECT patent_type, count(*) AS patents, 1 AS n_files FROM patent_info GROUP BY 1""",
)
register("sink_append", sink_append, "SELECT * FROM patent_info")
register(
    "save_all_tables",
    save_all_tables,
    " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}"
        for name in ["applicant_info", "cpc_info", "inventor_info", "patent_info"]
    ),
)


def last_events(t: Tables) -> DataFrame:
    return t.driver_table("events").select(
        F.when(F.col("event_id") % 113 != 0, F.col("event_type")).alias("event_type"),
        "user_id", "value", "event_id", "ts",
    )


def new_table(t: Tables) -> KeyedTable:
    return KeyedTable(
        t.spark, scratch_path(t.spark, "keyed"), ["event_type", "user_id"], "value"
    )


LATE = "TIMESTAMP_NTZ '2024-01-16 00:00:00'"


def keyed_insert(t: Tables) -> DataFrame:
    table = new_table(t)
    table.insert(last_events(t).drop("ts"))
    return table.read()


def keyed_snapshot_read(t: Tables) -> DataFrame:
    """Two inserts; the snapshot is the second."""
    table = new_table(t)
    rows = last_events(t)
    table.insert(rows.drop("ts"))
    table.insert(rows.where(f"ts >= {LATE}").drop("ts"))
    return table.read()


def keyed_upsert(t: Tables) -> DataFrame:
    """Earlier events inserted, later ones upserted."""
    table = new_table(t)
    rows = last_events(t)
    table.insert(rows.where(f"ts < {LATE}").drop("ts"))
    table.upsert(rows.where(f"ts >= {LATE}").drop("ts"))
    return table.read()


KEYED = """
    SELECT event_type, user_id, value, event_id
    FROM (SELECT *, row_number() OVER (PARTITION BY event_type, user_id
                                       ORDER BY {order} value DESC, event_id DESC) AS place
          FROM (SELECT CASE WHEN event_id % 113 <> 0 THEN event_type END AS event_type,
                       user_id, value, event_id, ts >= TIMESTAMP '2024-01-16' AS late
                FROM events)
          WHERE event_type IS NOT NULL AND {condition})
    WHERE place = 1"""
register("keyed_insert", keyed_insert, KEYED.format(order="", condition="true"))
register("keyed_snapshot_read", keyed_snapshot_read, KEYED.format(order="", condition="late"))
register("keyed_upsert", keyed_upsert, KEYED.format(order="late DESC,", condition="true"))

# --- quality -----------------------------------------------------------------------

PROFILED = {
    "raw_patent": schemas.RAW_PATENT,
    "raw_application": schemas.RAW_APPLICATION,
    "cpc_info": schemas.RAW_CPC,
    "raw_cpc_title": schemas.RAW_CPC_TITLE,
    "raw_inventor": schemas.RAW_INVENTOR,
    "raw_location": schemas.RAW_LOCATION,
    "raw_applicant": schemas.RAW_APPLICANT,
}
register(
    "profile_tables",
    lambda t: quality.profile_all({name: getattr(t, name) for name in PROFILED}),
    " UNION ALL ".join(
        f"""SELECT '{table}' AS table_name, '{c}' AS column_name, count(*) AS row_count,
                   count(*) FILTER (WHERE {c} IS NULL) AS null_count,
                   count(DISTINCT {c}) AS distinct_count
            FROM {table}"""
        for table, schema in PROFILED.items()
        for c in schema.names
    ),
)
VALID = r"""regexp_matches(CAST(try_cast({c} AS DATE) AS VARCHAR),
                           '^(19|20)\d{{2}}-[0-1]\d-[0-3]\d$')"""
VALID_PATENTS = f"""
    SELECT * REPLACE (try_cast(patent_date AS DATE) AS patent_date)
    FROM raw_patent WHERE {VALID.format(c="patent_date")}"""
register(
    "valid_dates",
    lambda t: quality.with_valid_dates(t.raw_patent, "patent_date"),
    VALID_PATENTS,
)
register(
    "date_quality_summary",
    lambda t: quality.date_quality(t.raw_patent, "patent_date"),
    f"""SELECT CASE WHEN patent_date IS NULL OR trim(patent_date) = '' THEN 'missing'
                    WHEN try_cast(patent_date AS DATE) IS NULL THEN 'malformed'
                    WHEN {VALID.format(c="patent_date")} THEN 'valid'
                    ELSE 'out_of_range' END AS status,
               count(*) AS row_count
        FROM raw_patent GROUP BY 1""",
)
register(
    "prune_columns",
    lambda t: quality.drop_columns(t.raw_patent, curate.PATENT_EXTRAS),
    """SELECT patent_id, patent_type, patent_date, patent_title, num_claims FROM raw_patent""",
)
register(
    "filter_not_null",
    lambda t: quality.require(
        t.applicant_info, "raw_applicant_name_first", "raw_applicant_name_last"
    ),
    "SELECT * FROM named_applicants",
)
register(
    "filter_non_blank",
    lambda t: quality.require_text(t.applicant_info, "raw_applicant_organization"),
    "SELECT * FROM applicant_info WHERE trim(raw_applicant_organization) <> ''",
)
register(
    "drop_any_null",
    lambda t: quality.drop_any_null(t.inventor_info.select("patent_id", "inventor_id",
                                    "gender_code", "disambig_state")),
    """SELECT patent_id, inventor_id, gender_code, disambig_state FROM inventor_info
       WHERE gender_code IS NOT NULL AND disambig_state IS NOT NULL""",
)
register(
    "fill_defaults",
    lambda t: quality.fill_defaults(
        t.inventor_info.select("patent_id", "inventor_id", "gender_code", "disambig_state"),
        {"gender_code": "U", "disambig_state": "unknown"},
    ),
    """SELECT patent_id, inventor_id, coalesce(gender_code, 'U') AS gender_code,
              coalesce(disambig_state, 'unknown') AS disambig_state
       FROM inventor_info""",
)

# --- curated tables ----------------------------------------------------------------

register(
    "build_patent_info",
    lambda t: curate.patent_info(t.raw_patent, t.raw_application),
    f"""SELECT p.patent_id, p.patent_type, p.patent_date, p.patent_title, p.num_claims,
               a.application_id, try_cast(a.filing_date AS DATE) AS filing_date, a.series_code
        FROM ({VALID_PATENTS}) p JOIN raw_application a ON p.patent_id = a.patent_id
        WHERE {VALID.format(c="a.filing_date")}""",
)
register(
    "build_cpc_info", lambda t: curate.cpc_info(t.cpc_info), "SELECT * FROM cpc_info"
)
register(
    "dim_cpc_section",
    lambda t: curate.described_sections(t.cpc_info),
    """SELECT c.cpc_section, s.section_description
       FROM (SELECT DISTINCT cpc_section FROM cpc_info) c
       LEFT JOIN cpc_section_names s ON c.cpc_section = s.cpc_section""",
)
for level in ["group", "subclass", "class"]:
    register(
        f"dim_cpc_{level}",
        lambda t, level=level: curate.cpc_dimension(t.raw_cpc_title, level),
        f"SELECT DISTINCT cpc_{level}, cpc_{level}_title FROM raw_cpc_title",
    )
register(
    "build_inventor_info",
    lambda t: curate.inventor_info(t.raw_inventor, t.raw_location),
    "SELECT * FROM inventor_info",
)
register(
    "build_applicant_info",
    lambda t: curate.applicant_info(t.raw_applicant),
    "SELECT * FROM applicant_info",
)

# --- joins -------------------------------------------------------------------------


def patent_pairs(t: Tables) -> tuple[DataFrame, DataFrame]:
    patents = quality.require(t.patent_info, "patent_date").select("patent_id", "num_claims")
    inventors = t.raw_inventor.select("patent_id", "inventor_id", "inventor_sequence")
    return patents, inventors


PAIRS = "(SELECT patent_id, num_claims FROM granted_patents) p"
INVENTOR_ROWS = "(SELECT patent_id, inventor_id, inventor_sequence FROM raw_inventor) i"
ALL_COLUMNS = "patent_id, num_claims, inventor_id, inventor_sequence"
register(
    "join_inner",
    lambda t: joins.inner(*patent_pairs(t), "patent_id"),
    f"SELECT {ALL_COLUMNS} FROM {PAIRS} JOIN {INVENTOR_ROWS} USING (patent_id)",
)
register(
    "join_left",
    lambda t: joins.left_outer(*patent_pairs(t), "patent_id"),
    f"SELECT {ALL_COLUMNS} FROM {PAIRS} LEFT JOIN {INVENTOR_ROWS} USING (patent_id)",
)
register(
    "join_full_coalesce",
    lambda t: joins.full_outer(*patent_pairs(t), "patent_id"),
    f"""SELECT coalesce(p.patent_id, i.patent_id) AS patent_id, num_claims, inventor_id,
               inventor_sequence
        FROM {PAIRS} FULL JOIN {INVENTOR_ROWS} ON p.patent_id = i.patent_id""",
)
register(
    "join_semi",
    lambda t: joins.matching(*patent_pairs(t), "patent_id"),
    f"""SELECT patent_id, num_claims FROM {PAIRS}
        WHERE patent_id IN (SELECT patent_id FROM raw_inventor)""",
)
register(
    "join_anti",
    lambda t: joins.without_match(*patent_pairs(t), "patent_id"),
    f"""SELECT patent_id, num_claims FROM {PAIRS}
        WHERE patent_id NOT IN (SELECT patent_id FROM raw_inventor)""",
)

# --- scalar functions --------------------------------------------------------------


def scalar_functions(t: Tables) -> DataFrame:
    granted, filed = F.col("patent_date"), F.col("filing_date")
    title = F.col("patent_title")
    return t.patent_info.select(
        "patent_id",
        F.year(granted).alias("grant_year"),
        F.month(granted).alias("grant_month"),
        F.make_date(F.year(granted), F.month(granted), F.lit(1)).alias("month_start"),
        dates.bucket_start(granted, "year").alias("year_start"),
        dates.decade(F.year(granted)).alias("decade"),
        dates.grant_days(granted, filed).alias("grant_time_days"),
        F.date_format(granted, "yyyy_MMM").alias("month_name"),
        F.to_date(F.to_timestamp(granted.cast("string"), "yyyy-MM-dd")).alias("reparsed"),
        granted.between(F.lit("2018-01-01").cast("date"), F.lit("2023-12-31").cast("date"))
        .alias("in_range"),
        granted.cast("string").like("2023%").alias("in_2023"),
        F.lower("patent_type").alias("lowered"),
        names.normalized_organization(F.col("patent_type")).alias("capitalised"),
        F.length(F.trim(title)).alias("title_length"),
        names.full_name(F.col("series_code"), F.col("patent_type")).alias("concatenated"),
        names.prefixed(F.col("series_code"), "US-").alias("prefixed"),
        F.concat_ws("_", "series_code", "patent_type").alias("with_separator"),
        F.element_at(F.split(title, " "), 2).alias("second_word"),
        F.size(F.split(title, " ")).alias("word_count"),
        F.regexp_replace(title, "[0-9]", "#").alias("masked"),
        text_functions.cleaned_keyword_string(F.col("patent_type")).alias("cleaned"),
        F.when(F.col("num_claims") > 25, "many").otherwise("few").alias("claims_class"),
        F.coalesce(granted, filed).alias("any_date"),
        F.col("patent_type").isin("1-URGENT", "2-HIGH").alias("is_pressing"),
        F.col("num_claims").isNotNull().alias("has_claims"),
    )


register(
    "scalar_functions",
    scalar_functions,
    r"""SELECT patent_id, CAST(year(patent_date) AS INTEGER) AS grant_year,
               CAST(month(patent_date) AS INTEGER) AS grant_month,
               CAST(date_trunc('month', patent_date) AS DATE) AS month_start,
               CAST(date_trunc('year', patent_date) AS DATE) AS year_start,
               CAST(year(patent_date) // 10 * 10 AS INTEGER) AS decade,
               CAST(date_diff('day', filing_date, patent_date) AS INTEGER) AS grant_time_days,
               strftime(patent_date, '%Y_%b') AS month_name,
               patent_date AS reparsed,
               patent_date BETWEEN DATE '2018-01-01' AND DATE '2023-12-31' AS in_range,
               CAST(patent_date AS VARCHAR) LIKE '2023%' AS in_2023,
               lower(patent_type) AS lowered,
               array_to_string(list_transform(string_split(lower(patent_type), ' '),
                                              lambda w: upper(w[1]) || w[2:]), ' ')
                   AS capitalised,
               CAST(length(trim(patent_title)) AS INTEGER) AS title_length,
               series_code || ' ' || patent_type AS concatenated,
               'US-' || series_code AS prefixed,
               concat_ws('_', series_code, patent_type) AS with_separator,
               string_split(patent_title, ' ')[2] AS second_word,
               CAST(len(string_split(patent_title, ' ')) AS INTEGER) AS word_count,
               regexp_replace(patent_title, '[0-9]', '#', 'g') AS masked,
               patent_type AS cleaned,
               CASE WHEN num_claims > 25 THEN 'many' ELSE 'few' END AS claims_class,
               coalesce(patent_date, filing_date) AS any_date,
               patent_type IN ('1-URGENT', '2-HIGH') AS is_pressing,
               num_claims IS NOT NULL AS has_claims
        FROM patent_info""",
)
