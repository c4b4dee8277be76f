"""Records of the live patent feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.functions.dates import parsed_date
from patentloom.operators.ranking import top_k_per_group


def _names(parties: str, field: str, **constants: str):
    """Array of structs with the non-empty extracted names of ``parties``."""
    kept = F.filter(
        F.col(parties), lambda p: F.coalesce(p["extracted_name"]["value"], F.lit("")) != ""
    )
    fixed = [F.lit(value).alias(name) for name, value in constants.items()]
    return F.coalesce(
        F.transform(kept, lambda p: F.struct(p["extracted_name"]["value"].alias(field), *fixed)),
        F.array().cast(
            f"array<struct<{', '.join(f'{n}: string' for n in (field, *constants))}>>"
        ),
    )


def published_on(column: str = "date_published") -> Column:
    """The calendar date of a feed record, null where there is none."""
    day = F.col(column)
    return F.when(day.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), parsed_date(day))


def normalize(records: DataFrame, year: int | None = None) -> DataFrame:
    """Flat patent rows from nested records: claims counted over all claim groups,
    named parties only, gender unknown, and a valid date, of ``year`` if given."""
    claims = F.aggregate(
        F.col("claims"),
        F.lit(0),
        lambda total, group: total + F.size(F.coalesce(group["claims"], F.array())),
    )
    date = published_on()
    rows = records.select(
        F.col("doc_number").alias("patent_id"),
        F.coalesce(claims, F.lit(0)).alias("num_claims"),
        F.col("date_published").alias("patent_date"),
        "branch",
        _names("biblio.parties.inventors", "inventor_name", gender="U").alias("inventors"),
        _names("biblio.parties.applicants", "organization").alias("applicants"),
        date.alias("published"),
    ).where(F.col("published").isNotNull())
    if year is not None:
        rows = rows.where(F.year("published") == year)
    return rows.withColumn("month", F.date_format("published", "yyyy_MMM")).drop("published")


def latest_per_branch(records: DataFrame, k: int = 100) -> DataFrame:
    """The ``k`` newest records per branch that have claims, inventors and applicants.

    Newest by calendar date; texts that are no date come last.
    """
    listed = ("claims", "biblio.parties.inventors", "biblio.parties.applicants")
    complete = records
    for name in listed:
        complete = complete.where(F.col(name).isNotNull() & (F.size(name) > 0))
    dated = complete.withColumn("_published", published_on())
    newest = top_k_per_group(
        dated, "branch", [F.desc_nulls_last("_published"), F.asc("doc_number")], k
    )
    return newest.drop("_published")


def created_after(records: DataFrame, date: str, column: str = "date_published") -> DataFrame:
    return records.where(parsed_date(F.col(column)) > F.lit(date).cast("date"))
