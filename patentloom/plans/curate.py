"""Curated tables from raw bulk tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom import schemas
from patentloom.operators.quality import drop_columns, with_valid_dates

# Section letters and their meaning.
CPC_SECTIONS = {
    "A": "Human Necessities",
    "B": "Performing Operations; Transporting",
    "C": "Chemistry; Metallurgy",
    "D": "Textiles; Paper",
    "E": "Fixed Constructions",
    "F": "Mechanical Engineering; Lighting; Heating; Weapons; Blasting Engines or Pumps",
    "G": "Physics",
    "H": "Electricity",
    "Y": "General Tagging of New Technological Developments",
}

# Raw columns that the curated tables leave out.
APPLICATION_EXTRAS = ["rule_47_flag", "patent_application_type"]
PATENT_EXTRAS = ["wipo_kind", "withdrawn", "filename"]
LOCATION_EXTRAS = ["state_fips", "county_fips"]
APPLICANT_EXTRAS = ["applicant_designation", "applicant_authority", "rawlocation_id"]


def patent_info(patents: DataFrame, applications: DataFrame) -> DataFrame:
    """Patents and applications with valid dates, one row per matching pair."""
    granted = drop_columns(with_valid_dates(patents, "patent_date"), PATENT_EXTRAS)
    filed = drop_columns(with_valid_dates(applications, "filing_date"), APPLICATION_EXTRAS)
    return granted.join(filed, "patent_id")


def cpc_info(cpc: DataFrame) -> DataFrame:
    return cpc.select(*schemas.RAW_CPC.names)


def cpc_section(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        list(CPC_SECTIONS.items()), "cpc_section string, section_description string"
    )


def described_sections(cpc: DataFrame) -> DataFrame:
    """The section dimension restricted and extended to the sections in use."""
    used = cpc.select("cpc_section").distinct()
    return used.join(F.broadcast(cpc_section(cpc.sparkSession)), "cpc_section", "left")


def cpc_dimension(titles: DataFrame, level: str) -> DataFrame:
    """Distinct (code, title) of level ``group``, ``subclass`` or ``class``."""
    return titles.select(f"cpc_{level}", f"cpc_{level}_title").distinct()


def inventor_info(inventors: DataFrame, locations: DataFrame) -> DataFrame:
    """Inventors with the place they live in, where known.

    Inventors without a place get keys that match none, or all of them would go to one task;
    very frequent places are left to adaptive execution, which splits them.
    """
    places = drop_columns(locations, LOCATION_EXTRAS)
    added = [c for c in places.columns if c != "location_id"]
    spread = F.concat(F.lit("\0"), F.pmod(F.xxhash64(*inventors.columns), F.lit(4096)))
    keyed = inventors.withColumn("_place", F.coalesce("location_id", spread))
    found = keyed.join(places.withColumnRenamed("location_id", "_place"), "_place", "left")
    others = [c for c in inventors.columns if c != "location_id"]
    return found.select("location_id", *others, *added)


def applicant_info(applicants: DataFrame) -> DataFrame:
    return drop_columns(applicants, APPLICANT_EXTRAS)
