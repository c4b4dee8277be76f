"""Technology branches: rule tables and the matching of patents to them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Rules = Mapping[str, Sequence[str]]

# Classification codes per branch.
BRANCH_RULES: Rules = {
    "Artificial Intelligence": [
        "G06N", "G06F19/00", "G06F17/27", "G06F17/28", "G10L15/22", "G06T", "G06K9/00",
    ],
    "Data Science and Analytics": [
        "G06F16/00", "G06F17/00", "H04L67/00", "H04L12/28", "G06F3/06", "G06F12/02",
        "G06F16/27", "H04L29/06", "G06Q50/00", "B82Y30/00",
    ],
    "Networking and Distributed Systems": [
        "H04L29/00", "H04L12/00", "H04W", "H04L12/24", "H04L67/10", "G06F9/50", "H04L67/22",
        "H04L29/08", "G06F9/46", "G06F15/173", "G06F15/16",
    ],
    "Software Development and Security": [
        "G06F8/00", "G06F9/00", "G06F9/44", "G06F9/451", "H04L67/02", "G06F3/048",
        "G06Q10/00", "G06F3/00", "H04L9/00", "G06F21/00", "G06Q20/40",
    ],
    "Advanced Computing Technologies": [
        "B25J9/00", "G05B19/00", "G06F15/18", "H03K17/00", "G09G5/00", "G06Q30/00",
    ],
}

# Classification codes per branch for records from the live feed.
LIVE_BRANCH_RULES: Rules = {
    "Artificial Intelligence": [
        "G06N", "G06F19/00", "G06F17/27", "G06F17/28", "G10L15/22", "G06T", "G06K9/00",
    ],
    "Data Science and Analytics": [
        "G06F18/20", "G06F18/22", "G06F16/10", "G06F16/20", "G06F16/30", "G06F16/40",
    ],
    "Networking and Distributed Systems": ["H04L29/08", "H04L12/16", "H04L12/22", "H04L12/26"],
    "Software Development and Security": [
        "G06F21/00", "G06F21/10", "G06F21/12", "G06F21/30", "G06F21/40",
    ],
    "Advanced Computing Technologies": ["G06F9/50", "G06F9/54", "G06F9/30", "G06F15/16"],
}


def rule_table(spark: SparkSession, rules: Rules = BRANCH_RULES) -> DataFrame:
    """One row per (branch, code); ``rule_id`` orders by branch position, then code.

    The table is as large as the rule mapping in the program text, hence safe to
    broadcast.
    """
    ordered = [(branch, code) for branch, codes in rules.items() for code in sorted(set(codes))]
    rows = [(rule_id, branch, code) for rule_id, (branch, code) in enumerate(ordered)]
    return spark.createDataFrame(rows, "rule_id int, branch string, code string")


def _rule_hits(cpc: DataFrame, rules: DataFrame) -> DataFrame:
    """(patent_id, rule columns) for every code that equals a group or a subclass.

    "Group or subclass" as a join condition has no equi-key and would compare all
    pairs; one row per candidate code makes it a hash join against the rules.
    """
    candidates = cpc.select(
        "patent_id",
        F.explode(F.array_distinct(F.array("cpc_group", "cpc_subclass"))).alias("code"),
    )
    return candidates.join(F.broadcast(rules), "code")


def match_branches(cpc: DataFrame, rules: Rules = BRANCH_RULES) -> DataFrame:
    """Every (patent_id, branch, code) hit, one per classification row and rule."""
    return _rule_hits(cpc, rule_table(cpc.sparkSession, rules)).select(
        "patent_id", "branch", "code"
    )


def assign_branch(cpc: DataFrame, rules: Rules = BRANCH_RULES) -> DataFrame:
    """One branch per patent: the hit with the lowest branch position, then code.

    Aggregating the integer ``rule_id`` keeps the one shuffle narrow and combines
    hits of a patent before it.
    """
    table = rule_table(cpc.sparkSession, rules)
    winners = (
        _rule_hits(cpc, table.select("rule_id", "code"))
        .groupBy("patent_id")
        .agg(F.min("rule_id").alias("rule_id"))
    )
    return winners.join(F.broadcast(table), "rule_id").select("patent_id", "branch", "code")


def filter_patents(
    patents: DataFrame,
    cpc: DataFrame,
    granted_before: str | None = None,
    rules: Rules = BRANCH_RULES,
) -> DataFrame:
    """Patents that fall in a branch, optionally only those granted before a date."""
    if granted_before is not None:
        patents = patents.where(F.col("patent_date") < F.lit(granted_before).cast("date"))
    return patents.join(assign_branch(cpc, rules), "patent_id")


def rule_coverage(cpc: DataFrame, rules: Rules = BRANCH_RULES) -> DataFrame:
    """The rule table with the number of classification rows each rule hits."""
    table = rule_table(cpc.sparkSession, rules)
    hits = (
        _rule_hits(cpc, table.select("rule_id", "code"))
        .groupBy("rule_id")
        .agg(F.count(F.lit(1)).alias("hit_count"))
    )
    return table.join(F.broadcast(hits), "rule_id", "left").select(
        "branch", "code", F.coalesce("hit_count", F.lit(0)).alias("hit_count")
    )
