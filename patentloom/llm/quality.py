"""Quality of documents: text evidence and the standing of their site, by empirical Bayes.

A logistic model over a few measures of the text gives each document's own evidence. The
labelled outcomes of all documents are summed per path, host and overall; each path's rate
of good documents is shrunk towards its host's, and each host's towards the overall rate,
with prior strengths estimated from the spread of the rates on that level. A document's
posterior log-odds are its own evidence plus those of its path, so a site with few labels
changes little and one with many can decide doubtful texts. A labelled document does not
count towards the rates it is judged with.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from patentloom.llm.url_reputation import Reputation, prior_strength, split_url
from patentloom.sinks.files import written

MEASURES = (
    "upper", "symbols", "digits", "points", "breaks", "different", "words", "rich", "length",
)


@dataclass(frozen=True)
class Settings:
    """``max_labels``: bound of the sample that the text model is fitted on (rows with the
    least hash of their id; sites count all labels). ``ridge``: penalty of its weights.
    ``evidence``: bound of a document's own log-odds. ``threshold``: score from which a
    document is kept."""

    max_labels: int = 100_000
    ridge: float = 1.0
    evidence: float = 8.0
    threshold: float = 0.5
    reputation: Reputation = Reputation()


def measures(text: Column) -> dict[str, Column]:
    """Measures of a text; a null or empty one has no words and all shares zero."""
    text = F.coalesce(text, F.lit(""))
    words = F.filter(F.split(F.lower(text), r"\s+"), lambda w: w != "")
    size = F.greatest(F.length(text), F.lit(1))
    count = F.size(words)
    share = {
        "upper": r"\p{Lu}",
        "symbols": r"[^\p{L}\p{N}\s.,;:'-]",
        "digits": r"\p{N}",
        "points": r"[.,;:]",
        "breaks": r"\n",
    }
    different = F.size(F.array_distinct(words)) / F.greatest(count, F.lit(1))
    return {
        **{name: F.regexp_count(text, F.lit(p)) / size for name, p in share.items()},
        "different": different,
        "words": F.log1p(count),
        "rich": F.log1p(count) * different,
        "length": size / F.greatest(count, F.lit(1)),
    }


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float) -> tuple[np.ndarray, float]:
    """Weights of the plain measures and the intercept."""
    middle, spread = x.mean(0), x.std(0) + 1e-9
    design = np.column_stack([np.ones(len(x)), (x - middle) / spread])
    penalty = np.diag([1e-6] + [ridge] * x.shape[1])
    beta = np.zeros(design.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        w = p * (1 - p) + 1e-9
        step = np.linalg.solve(
            (design * w[:, None]).T @ design + penalty, design.T @ (y - p) - penalty @ beta
        )
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    weights = beta[1:] / spread
    return weights, float(beta[0] - (weights * middle).sum())


def _logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def score(
    docs: DataFrame,
    labels: DataFrame,
    sites: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    settings: Settings = Settings(),
) -> DataFrame:
    """Columns doc_id, host, path, text_score, site_rate, score (0 to 1) and keep.

    ``labels``: doc_id and quality (0 or 1; of several the least counts, null ones are left
    out). ``sites``: doc_id, host and path, one row per document; a document without one
    belongs to no host. One row comes out per row of ``docs``; null and empty texts are
    judged like any other by their measures, null ids have neither label nor site. Without
    labels of each kind every score is the overall rate. Other columns are not read.
    """
    spark = docs.sparkSession
    facts = docs.select(F.col(doc_id).alias("doc_id"), *[
        m.alias(name) for name, m in measures(F.col(text)).items()
    ])
    good = (
        labels.select(F.col("doc_id"), F.col("quality").cast("int").alias("good"))
        .dropna()
        .groupBy("doc_id")
        .agg(F.min("good").alias("good"))
    )
    one_site = sites.dropna(subset=["doc_id"]).groupBy("doc_id").agg(
        F.min(F.struct(F.coalesce("host", F.lit("")).alias("host"),
                       F.coalesce("path", F.lit("")).alias("path"))).alias("site")
    )
    rows = facts.join(good, "doc_id", "left").join(one_site, "doc_id", "left").select(
        "doc_id", *MEASURES, "good",
        F.coalesce("site.host", F.lit("")).alias("host"),
        F.coalesce("site.path", F.lit("")).alias("path"),
    )
    rows = written(rows, "quality-facts")
    sample = (
        rows.where("good IS NOT NULL")
        .select("good", *MEASURES)
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(settings.max_labels)
        .toArrow()
    )
    counts = (
        rows.where("good IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.count("*").alias("n"), F.sum("good").alias("bad"))
    )
    counts = written(counts, "quality-sites")
    hosts = counts.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    total = hosts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    n, ok = total["n"] or 0, total["bad"] or 0
    base = (ok + 1.0) / (n + 2.0)
    weights, intercept = np.zeros(len(MEASURES)), float(np.log(base / (1 - base)))
    if 0 < ok < n:
        x = np.column_stack([sample[m].to_numpy() for m in MEASURES])
        weights, intercept = _logistic(x, sample["good"].to_numpy().astype(float), settings.ridge)
    k_host = prior_strength(hosts, base, settings.reputation)
    k_path = prior_strength(counts, base, settings.reputation)
    own_n = F.when(F.col("good").isNull(), 0).otherwise(1)
    own = F.coalesce("good", F.lit(0))
    host_side = hosts.select("host", F.col("n").alias("host_n"), F.col("bad").alias("host_ok"))
    path_side = counts.select(
        "host", "path", F.col("n").alias("path_n"), F.col("bad").alias("path_ok")
    )
    text_z = F.lit(intercept)
    for name, w in zip(MEASURES, weights, strict=True):
        text_z = text_z + F.col(name) * float(w)
    zero = F.lit(0)
    host_rate = (F.coalesce("host_ok", zero) - own + F.lit(base * k_host)) / (
        F.greatest(F.coalesce("host_n", zero) - own_n, zero) + F.lit(k_host)
    )
    path_rate = (F.coalesce("path_ok", zero) - own + F.col("host_rate") * k_path) / (
        F.greatest(F.coalesce("path_n", zero) - own_n, zero) + F.lit(k_path)
    )
    bound = settings.evidence
    judged = (
        rows.join(host_side, "host", "left")
        .join(path_side, ["host", "path"], "left")
        .withColumn("host_rate", F.when(F.col("host") == "", F.lit(base)).otherwise(host_rate))
        .withColumn("site_rate", F.when(F.col("host") == "", F.lit(base)).otherwise(path_rate))
        .withColumn("text_z", F.greatest(F.lit(-bound), F.least(F.lit(bound), text_z)))
    )
    z = F.col("text_z") - float(np.log(base / (1 - base))) + _logit(F.col("site_rate"))
    return judged.select(
        "doc_id",
        "host",
        "path",
        (1 / (1 + F.exp(-F.col("text_z")))).alias("text_score"),
        "site_rate",
        (1 / (1 + F.exp(-z))).alias("score"),
    ).withColumn("keep", F.col("score") >= settings.threshold)


def sites_of(pages: DataFrame) -> DataFrame:
    """doc_id, host and first path segment of pages (page_id, url)."""
    host, path = split_url(F.col("url"))
    return pages.select(
        F.col("page_id").alias("doc_id"),
        host.alias("host"),
        F.regexp_extract(path, r"\A/([^/]*)", 1).alias("path"),
    )
