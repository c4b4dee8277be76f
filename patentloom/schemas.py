"""Schemas of the raw bulk tables, the stream inputs and the report tables."""

from __future__ import annotations

from pyspark.sql import types as T

_TYPES = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "date": T.DateType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
}


def struct(**columns: str) -> T.StructType:
    """A nullable flat schema from ``column="type"`` pairs."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns.items()])


# Column names, types and order of the raw tab-separated tables.
# Dates are typed ``string`` here: the quality step needs the text as delivered.
RAW_APPLICATION = struct(
    application_id="string", patent_id="string", patent_application_type="string",
    filing_date="string", series_code="string", rule_47_flag="int",
)
RAW_PATENT = struct(
    patent_id="string", patent_type="string", patent_date="string", patent_title="string",
    wipo_kind="string", num_claims="int", withdrawn="int", filename="string",
)
RAW_CPC = struct(
    patent_id="string", cpc_sequence="int", cpc_section="string", cpc_class="string",
    cpc_subclass="string", cpc_group="string", cpc_type="string",
)
RAW_CPC_TITLE = struct(
    cpc_subclass="string", cpc_subclass_title="string", cpc_group="string",
    cpc_group_title="string", cpc_class="string", cpc_class_title="string",
)
RAW_INVENTOR = struct(
    patent_id="string", inventor_sequence="int", inventor_id="string",
    disambig_inventor_name_first="string", disambig_inventor_name_last="string",
    gender_code="string", location_id="string",
)
RAW_LOCATION = struct(
    location_id="string", disambig_city="string", disambig_state="string",
    disambig_country="string", latitude="float", longitude="float", county="string",
    state_fips="string", county_fips="string",
)
RAW_APPLICANT = struct(
    patent_id="string", applicant_sequence="int", raw_applicant_name_first="string",
    raw_applicant_name_last="string", raw_applicant_organization="string",
    applicant_type="string", applicant_designation="string", applicant_authority="string",
    rawlocation_id="string",
)

# Report table contracts.
PATENT_TRENDS = struct(
    timestamp="timestamp", year="date", branch="string", grant_count="int", avg_claims="float",
)
GENDER_TRENDS = struct(
    timestamp="timestamp", year="date", branch="string", male_count="int", female_count="int",
)
GEO_DISTRIBUTION = struct(
    timestamp="timestamp", year="date", branch="string", state="string",
    inventor_count="int", patent_count="int",
)
GEO_TOTAL = struct(
    branch="string", state="string", latitude="double", longitude="double",
    inventor_count="int", patent_count="int",
)
TOP_INVENTORS = struct(
    branch="string", inventor_id="string", inventor_name="string", gender="string",
    state="string", latitude="double", longitude="double", patent_count="int", rank="int",
)
TOP_APPLICANTS = struct(branch="string", organization="string", patent_count="int", rank="int")
TOP_KEYWORDS = struct(branch="string", keyword="string", keyword_count="int", rank="int")
TREND_ANALYTICS = struct(
    year="date", branch="string", grant_count="int", filed_count="int", male_count="int",
    female_count="int", unknown_count="int", avg_claims="float",
)

# Stream inputs.
PATENT_STREAM = (
    "patent_id string, patent_date string, num_claims string, branch string, "
    "inventors array<struct<inventor_name: string, gender: string, state: string>>, "
    "applicants array<struct<organization: string>>"
)
CATEGORY_PRICES = "id int, category string, price double"
FACTS = "fact string, length string"
API_RECORDS = (
    "doc_number string, date_published string, branch string, "
    "claims array<struct<claims: array<string>>>, "
    "biblio struct<parties: struct<"
    "inventors: array<struct<extracted_name: struct<value: string>>>, "
    "applicants: array<struct<extracted_name: struct<value: string>>>>>"
)
KEYWORDS = "patent_id string, keywords array<struct<_1: string, _2: double>>"
