"""URL filter: fixed rules first, then empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host, registered domain and suffix. Each level's
bad rate gets a beta prior whose mean is the posterior mean of the level above and whose
strength is estimated from the spread of the rates on that level (beta-binomial moments),
so a host with few labels leans on its domain, a domain on its suffix, and a suffix on all
pages. A host is blocked when the lower bound of its bad rate passes a limit.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.sinks.files import written

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Suffixes of two labels, below which a registered domain has three.
SECOND_LEVEL = ("ac", "co", "com", "edu", "gov", "net", "org")


@dataclass(frozen=True)
class Reputation:
    """``z`` standard deviations below the mean the bad rate must still pass ``limit``.

    Prior strengths stay within ``[weakest, strongest]`` pseudo-counts.
    """

    z: float = 1.645
    limit: float = 0.5
    weakest: float = 2.0
    strongest: float = 1000.0


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or without ``://``."""
    text = F.coalesce(url, F.lit(""))
    at = F.instr(text, "://")
    rest = F.when(at > 0, F.substr(text, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"\A([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"\A[^/?#]*([^?#]*)", 1)
    return F.translate(host, UPPER, UPPER.lower()), path


def suffix_of(host: Column) -> Column:
    """Last label, or the last two of names such as ``co.uk``; empty for an empty host."""
    second = "|".join(SECOND_LEVEL)
    return F.regexp_extract(host, rf"(?:\A|\.)((?:(?:{second})\.[a-z][a-z])|[^.]*)\z", 1)


def domain_of(host: Column) -> Column:
    """The suffix and one label more, where there is one."""
    second = "|".join(SECOND_LEVEL)
    return F.regexp_extract(
        host, rf"(?:\A|\.)((?:[^.]*\.)?(?:(?:(?:{second})\.[a-z][a-z])|[^.]*))\z", 1
    )


def matching_rule(
    host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES
) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null without one."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, kind).otherwise(verdict)
    return name, verdict


def _level(counts: DataFrame, key: str, up: str | None) -> DataFrame:
    keys = [F.col(key).alias("key")] + ([F.col(up).alias("up")] if up else [])
    return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))


def prior_strength(level: DataFrame, p: float, settings: Reputation) -> float:
    """Pseudo-counts of the prior from the spread of the rates (one row to the driver)."""
    got = level.agg(
        F.count("*").alias("k"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * F.col("n")).alias("nn"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, 2)).alias("s"),
    ).first()
    if not got["n"] or not 0 < p < 1:
        return settings.strongest
    room = got["n"] - got["nn"] / got["n"] - (got["k"] - 1)
    if room <= 0:
        return settings.strongest
    rho = (got["s"] / (p * (1 - p)) - (got["k"] - 1)) / room
    rho = min(max(rho, 1e-9), 1.0)
    return min(max((1 - rho) / rho, settings.weakest), settings.strongest)


def host_reputation(outcomes: DataFrame, settings: Reputation) -> tuple[list[DataFrame], tuple]:
    """Posterior tables of the levels host, domain and suffix, and the overall posterior.

    ``outcomes``: one row per labelled page with ``host`` and ``bad`` (0 or 1, null rows
    are left out). Each table has ``key``, ``mean`` and ``size`` (mean and pseudo-counts
    of the beta posterior). Only sums leave the executors.
    """
    counts = (
        outcomes.where("bad IS NOT NULL AND host IS NOT NULL AND host <> ''")
        .groupBy("host")
        .agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
        .withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    )
    counts = written(counts, "host-counts")
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, bad = total["n"] or 0, total["bad"] or 0
    p = (bad + 1.0) / (n + 2.0)
    tables, above = [], None
    for key, up in (("suffix", None), ("domain", "suffix"), ("host", "domain")):
        level = _level(counts, key, up)
        k = prior_strength(level, p, settings)
        prior = F.lit(p)
        if above is not None:
            level = level.join(above.select(F.col("key").alias("up"), "mean"), "up", "left")
            prior = F.col("mean")
        above = level.select(
            "key",
            ((F.col("bad") + prior * k) / (F.col("n") + k)).alias("mean"),
            (F.col("n") + F.lit(k)).alias("size"),
        )
        tables.insert(0, above)
    return tables, (p, n + 2.0)


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    url: str = "url",
    rules: Sequence[tuple[str, str, str]] = RULES,
    settings: Reputation = Reputation(),
) -> DataFrame:
    """``pages`` with host, path, rule, bad_rate, bad_bound and verdict.

    A rule's verdict wins over the reputation. A host without labels takes the posterior
    of its domain, else of its suffix, else of all pages; so do empty hosts. Rows with a
    null url are judged as empty hosts; repeated rows each get their verdict. Columns of
    the result's names are replaced. Without any label nothing is blocked by reputation.
    """
    names = ("host", "path", "rule", "bad_rate", "bad_bound", "verdict")
    tables, (p, n) = host_reputation(outcomes, settings)
    host, path = split_url(F.col(url))
    out = pages.drop(*[c for c in names if c != url]).withColumns({"host": host, "path": path})
    rule, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    out = out.withColumns(
        {
            "rule": rule,
            "_said": verdict,
            "_domain": domain_of(F.col("host")),
            "_suffix": suffix_of(F.col("host")),
        }
    )
    means, sizes = [], []
    for i, (key, table) in enumerate(zip(("host", "_domain", "_suffix"), tables, strict=True)):
        side = table.select(
            F.col("key").alias(key), F.col("mean").alias(f"_m{i}"), F.col("size").alias(f"_s{i}")
        )
        out = out.join(side, key, "left")
        means.append(F.col(f"_m{i}"))
        sizes.append(F.col(f"_s{i}"))
    mean, size = F.coalesce(*means, F.lit(p)), F.coalesce(*sizes, F.lit(n))
    bound = F.col("bad_rate") - settings.z * F.sqrt(
        F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("_size") + 1)
    )
    out = out.withColumns({"bad_rate": mean, "_size": size}).withColumn("bad_bound", bound)
    learnt = F.when(F.col("bad_bound") > settings.limit, "block").otherwise("allow")
    return out.withColumn("verdict", F.coalesce("_said", learnt)).select(
        *[c for c in pages.columns if c not in names or c == url], *[c for c in names if c != url]
    )
