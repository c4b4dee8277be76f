"""The corpus pipeline: five stages over ``documents``, each stored before the next.

Stages get ``(spark, docs, sf_dir)``. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from patentloom.llm import benchmark_scan, line_dedup, ngram_join, sentencepiece_lattice, toxicity
from patentloom.llm.queries import TOKENIZER, read, toxicity_model
from patentloom.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity score does not reject, unchanged."""
    model = toxicity_model(spark, docs, sf_dir)
    return toxicity.score(docs, model).where("predicted = 0").select(*COLUMNS)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents without lines that stand earlier; n_chars follows the text."""
    out = line_dedup.dedup_lines(docs)
    changed = F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
    return out.withColumn("n_chars", F.coalesce(changed, "n_chars")).select(*COLUMNS)


def keep_one_per_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates.

    Documents without words are in no group and stay, as do rows with a null id.
    """
    found = ngram_join.link_documents(docs)
    copies = found.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(copies, "doc_id", "left_anti").select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no window of a benchmark item."""
    found = benchmark_scan.scan(docs, read(spark, sf_dir, "benchmark"))
    return found.where("NOT contaminated").select(*COLUMNS)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids of the pieces, their number, and whether they decode to the text."""
    pieces = sentencepiece_lattice.load(TOKENIZER)
    decoded = sentencepiece_lattice.decode(sentencepiece_lattice.encode(docs, pieces), pieces)
    return decoded.select(
        "doc_id",
        "ids",
        F.size("ids").cast("long").alias("n_pieces"),
        F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"),
    )


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("ngram_jaccard_join", keep_one_per_group),
    ("benchmark_decontamination", drop_contaminated),
    ("sentencepiece", tokens),
]

#: Learnt scores, the edit join and the tokenizer are beyond SQL: tests hold every stage
#: against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; each result is stored in the shared folder and read again."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
