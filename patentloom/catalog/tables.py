"""Patent-shaped tables over the driver's tables, as DataFrames.

``views.py`` states the same tables in SQL. Both are described in ``FIXTURES.md``.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom.operators.classify import BRANCH_RULES, LIVE_BRANCH_RULES, filter_patents
from patentloom.plans import curate
from patentloom.sinks.files import written

#: Fixed value: day before which the reported patents were granted.
GRANTED_BEFORE = "2024-08-01"

FIRST_NAMES = ["Ada", "Grace", "Alan", "Edsger", "Barbara", "Donald", "Frances"]
PERSON_NAMES = ["Mary", "John", "Wei", "Anna", "Omar", "Lena", "Ravi", "Sofia", "Igor"]
SEGMENTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
# Subclasses outside every branch; the last one has no section description.
OTHER_SUBCLASSES = [
    "A61K", "B60L", "C07D", "D01F", "E04B", "F16H", "G01N", "H01L", "Y02E", "Z99Z",
]
CODE_SLOTS = 400
BAD_DATES = {97: "2020-13-45", 89: "2021-02-30", 83: "", 79: "1074-05-01", 73: "n/a"}


def rule_groups() -> list[str]:
    """Every rule code once, subclass codes as a group of theirs."""
    codes = dict.fromkeys(
        code
        for rules in (BRANCH_RULES, LIVE_BRANCH_RULES)
        for codes in rules.values()
        for code in codes
    )
    return [code if "/" in code else f"{code}3/08" for code in codes]


def pick(values: list[str], index: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (index + 1).cast("int"))


def text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


class Tables:
    """The driver's tables and the patent-shaped ones, built when first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark = spark
        self.sf_dir = sf_dir

    def driver_table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def dated_orders(self) -> DataFrame:
        """Orders moved by twenty years, with the grant date that follows from them."""
        filed = F.add_months(F.col("o_orderdate").cast("date"), 240)
        granted = F.date_add(filed, (F.col("o_orderkey") % 1400 + 100).cast("int"))
        return self.driver_table("orders").withColumns({"filed": filed, "granted": granted})

    @cached_property
    def raw_application(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.dated_orders.select(
            F.concat(F.lit("A"), text(key)).alias("application_id"),
            text(key).alias("patent_id"),
            F.col("o_orderstatus").alias("patent_application_type"),
            F.when(key % 71 == 0, "2019-00-10").otherwise(text("filed")).alias("filing_date"),
            F.col("o_orderstatus").alias("series_code"),
            (key % 2).cast("int").alias("rule_47_flag"),
        )

    @cached_property
    def raw_patent(self) -> DataFrame:
        key = F.col("o_orderkey")
        date = text("granted")
        for modulus, bad in reversed(BAD_DATES.items()):
            value = F.lit(None).cast("string") if bad == "n/a" else F.lit(bad)
            date = F.when(key % modulus == 0, value).otherwise(date)
        return self.dated_orders.select(
            text(key).alias("patent_id"),
            F.col("o_orderpriority").alias("patent_type"),
            date.alias("patent_date"),
            F.concat(F.lit("Order "), text(key)).alias("patent_title"),
            F.concat(F.lit("K"), text(key % 3)).alias("wipo_kind"),
            F.floor(F.col("o_totalprice") / 10000).cast("int").alias("num_claims"),
            (key % 53 == 0).cast("int").alias("withdrawn"),
            F.lit("orders.xml").alias("filename"),
        )

    @cached_property
    def patent_info(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.dated_orders.select(
            text(key).alias("patent_id"),
            F.col("o_orderpriority").alias("patent_type"),
            F.when(key % 101 != 0, F.col("granted")).alias("patent_date"),
            F.concat(F.lit("Order "), text(key)).alias("patent_title"),
            F.floor(F.col("o_totalprice") / 10000).cast("int").alias("num_claims"),
            F.concat(F.lit("A"), text(key)).alias("application_id"),
            F.when(key % 103 != 0, F.col("filed")).alias("filing_date"),
            F.col("o_orderstatus").alias("series_code"),
        )

    def _cpc_codes(self, part_key: Column) -> list[Column]:
        groups = rule_groups()
        slot = part_key % CODE_SLOTS
        other = F.concat(
            pick(OTHER_SUBCLASSES, slot % len(OTHER_SUBCLASSES)),
            text(F.floor(part_key / CODE_SLOTS) % 40 + 1),
            F.lit("/00"),
        )
        group = F.when(
            slot < len(groups), pick(groups, F.least(slot, F.lit(len(groups) - 1)))
        ).otherwise(other)
        return [
            group.substr(1, 1).alias("cpc_section"),
            group.substr(1, 3).alias("cpc_class"),
            group.substr(1, 4).alias("cpc_subclass"),
            group.alias("cpc_group"),
        ]

    @cached_property
    def cpc_info(self) -> DataFrame:
        return self.driver_table("lineitem").select(
            text("l_orderkey").alias("patent_id"),
            F.col("l_linenumber").alias("cpc_sequence"),
            *self._cpc_codes(F.col("l_partkey")),
            F.when(F.col("l_linenumber") == 1, "inventional")
            .otherwise("additional")
            .alias("cpc_type"),
        )

    @cached_property
    def raw_cpc_title(self) -> DataFrame:
        codes = self.driver_table("part").select(*self._cpc_codes(F.col("p_partkey")))
        return codes.select(
            "cpc_subclass",
            F.concat(F.lit("Subclass "), "cpc_subclass").alias("cpc_subclass_title"),
            "cpc_group",
            F.concat(F.lit("Group "), "cpc_group").alias("cpc_group_title"),
            "cpc_class",
            F.concat(F.lit("Class "), "cpc_class").alias("cpc_class_title"),
        )

    @cached_property
    def raw_inventor(self) -> DataFrame:
        part, supplier = F.col("l_partkey"), F.col("l_suppkey")
        return self.driver_table("lineitem").select(
            text("l_orderkey").alias("patent_id"),
            F.col("l_linenumber").alias("inventor_sequence"),
            F.concat(F.lit("inv-"), text(part)).alias("inventor_id"),
            pick(FIRST_NAMES, part % len(FIRST_NAMES)).alias("disambig_inventor_name_first"),
            F.when(part % 11 != 0, F.concat(F.lit("Last"), text(part % 500))).alias(
                "disambig_inventor_name_last"
            ),
            F.when(part % 3 == 0, "M").when(part % 3 == 1, "F").alias("gender_code"),
            F.when(supplier % 29 != 0, F.concat(F.lit("loc-"), text(supplier))).alias(
                "location_id"
            ),
        )

    @cached_property
    def raw_location(self) -> DataFrame:
        key = F.col("s_suppkey")
        places = (
            self.driver_table("supplier")
            .join(
                self.driver_table("nation"), F.col("s_nationkey") == F.col("n_nationkey")
            )
            .join(self.driver_table("region"), F.col("n_regionkey") == F.col("r_regionkey"))
        )
        return places.select(
            F.concat(F.lit("loc-"), text(key)).alias("location_id"),
            F.concat("n_name", F.lit("-"), text(key % 3)).alias("disambig_city"),
            F.when(key % 13 != 0, F.col("n_name")).alias("disambig_state"),
            F.col("r_name").alias("disambig_country"),
            # Quarters are exact in binary, so sums do not depend on their order.
            (key % 100 * 0.25 + 25).cast("float").alias("latitude"),
            (key % 80 * -0.5 - 60).cast("float").alias("longitude"),
            F.concat("n_name", F.lit(" county")).alias("county"),
            text("n_nationkey").alias("state_fips"),
            text(key).alias("county_fips"),
        )

    @cached_property
    def inventor_info(self) -> DataFrame:
        return curate.inventor_info(self.raw_inventor, self.raw_location)

    @cached_property
    def raw_applicant(self) -> DataFrame:
        customer, supplier = F.col("o_custkey"), F.col("l_suppkey")
        extras = [
            F.lit("applicant").alias("applicant_designation"),
            F.lit("US").alias("applicant_authority"),
        ]
        people = self.driver_table("orders").select(
            text("o_orderkey").alias("patent_id"),
            F.lit(0).alias("applicant_sequence"),
            F.when(customer % 23 != 0, pick(PERSON_NAMES, customer % len(PERSON_NAMES))).alias(
                "raw_applicant_name_first"
            ),
            F.when(customer % 23 != 0, F.concat(F.lit("Cust"), text(customer % 700))).alias(
                "raw_applicant_name_last"
            ),
            F.when(customer % 31 != 0, pick(SEGMENTS, customer % len(SEGMENTS))).alias(
                "raw_applicant_organization"
            ),
            F.lit("inventor").alias("applicant_type"),
            *extras,
            text(customer).alias("rawlocation_id"),
        )
        company = F.concat(F.lit("Supplier works-"), text(supplier), F.lit(" co., ltd."))
        companies = self.driver_table("lineitem").select(
            text("l_orderkey").alias("patent_id"),
            F.col("l_linenumber").alias("applicant_sequence"),
            F.when(supplier % 4 == 0, "Rep").alias("raw_applicant_name_first"),
            F.when(supplier % 4 == 0, F.concat(F.lit("Agent"), text(supplier))).alias(
                "raw_applicant_name_last"
            ),
            F.when(supplier % 17 == 0, "")
            .when(supplier % 19 == 0, F.lit(None).cast("string"))
            .when(F.col("l_orderkey") % 2 == 0, F.upper(company))
            .otherwise(F.lower(company))
            .alias("raw_applicant_organization"),
            F.when(supplier % 6 == 0, "legal-representative")
            .when(supplier % 6 != 1, "applicant")
            .alias("applicant_type"),
            *extras,
            text(supplier).alias("rawlocation_id"),
        )
        return people.unionByName(companies)

    @cached_property
    def applicant_info(self) -> DataFrame:
        return curate.applicant_info(self.raw_applicant)

    @cached_property
    def filtered_patents(self) -> DataFrame:
        return filter_patents(self.patent_info, self.cpc_info, GRANTED_BEFORE)

    @cached_property
    def stored_filtered_patents(self) -> DataFrame:
        """The filtered patents as the reports find them: a table written once.

        Its size is then known when a join is planned, and both sides of a join come
        straight from a shuffle, which lets adaptive execution split a hot patent.
        """
        return written(self.filtered_patents, "filtered_patents")

    @cached_property
    def summaries(self) -> DataFrame:
        return self.driver_table("documents").select(
            text("doc_id").alias("patent_id"), F.col("text").alias("summary_text")
        )

    @cached_property
    def live_patents(self) -> DataFrame:
        """Records as the live feed delivers them, spread over most of a year."""
        event, user = F.col("event_id"), F.col("user_id")
        date = F.date_add(F.col("ts").cast("date"), (event % 300).cast("int"))
        inventors = F.transform(
            F.sequence(F.lit(0), (user % 3).cast("int")),
            lambda i: F.struct(
                F.concat(F.lit("person-"), text((user + i * 7) % 90)).alias("inventor_name"),
                F.when((user + i) % 3 == 0, "M")
                .when((user + i) % 3 == 1, "F")
                .otherwise("U")
                .alias("gender"),
                F.concat(F.lit("S"), text((user + i) % 25)).alias("state"),
            ),
        )
        applicants = F.array(
            F.struct(F.concat(F.lit("org-"), text(user % 40)).alias("organization"))
        )
        return self.driver_table("events").select(
            text(event).alias("patent_id"),
            text(date).alias("patent_date"),
            F.get_json_object("props", "$.k").alias("num_claims"),
            F.when(event % 113 != 0, F.col("event_type")).alias("branch"),
            inventors.alias("inventors"),
            applicants.alias("applicants"),
        )

    @cached_property
    def category_prices(self) -> DataFrame:
        return self.driver_table("events").select(
            F.col("event_id").cast("int").alias("id"),
            F.col("event_type").alias("category"),
            F.when(F.col("event_id") % 59 != 0, F.col("value")).alias("price"),
        )

    @cached_property
    def api_records(self) -> DataFrame:
        """Nested records as the search interface returns them."""
        event, user = F.col("event_id"), F.col("user_id")
        groups = F.transform(
            F.sequence(F.lit(1), (event % 3 + 1).cast("int")),
            lambda i: F.struct(
                F.transform(
                    F.sequence(F.lit(1), ((user + i) % 4 + 1).cast("int")),
                    lambda j: F.concat(F.lit("claim "), text(j)),
                ).alias("claims")
            ),
        )

        def party(prefix: str, modulus: int, empty: int) -> Column:
            return F.transform(
                F.sequence(F.lit(0), (event % modulus).cast("int")),
                lambda i: F.struct(
                    F.struct(
                        F.when(
                            (user + i) % empty != 0,
                            F.concat(F.lit(prefix), text(user + i)),
                        ).alias("value")
                    ).alias("extracted_name")
                ),
            )

        published = (
            F.when(event % 67 == 0, "2024-02-31")
            .when(event % 61 == 0, F.lit(None).cast("string"))
            .when(event % 59 == 0, "2023-12-30")
            .otherwise(text(F.date_add(F.col("ts").cast("date"), (event % 300).cast("int"))))
        )
        return self.driver_table("events").select(
            text(event).alias("doc_number"),
            published.alias("date_published"),
            F.col("event_type").alias("branch"),
            F.when(event % 41 != 0, groups).alias("claims"),
            F.struct(
                F.struct(
                    party("inventor ", 3, 5).alias("inventors"),
                    F.when(event % 43 != 0, party("company ", 2, 7)).alias("applicants"),
                ).alias("parties")
            ).alias("biblio"),
        )

    @cached_property
    def facts(self) -> DataFrame:
        """One JSON object per line."""
        return self.driver_table("conversations").select(
            F.to_json(
                F.struct(
                    F.col("text").alias("fact"), text(F.length("text")).alias("length")
                )
            ).alias("value")
        )
