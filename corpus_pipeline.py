"""A corpus from documents: language, line dedup, near copies, benchmark passages, mixing to target weights."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pactloom.llm import decontamination, language, minhash, mixing, site_lines
from pactloom.llm.common import remove, stored, table, written


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that language ID rejects go: no letters, or no text of a learned language."""
    return language.drop_rejected(docs)


def drop_site_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that too large a share of a source's documents have go; ``n_chars`` is that of what is left."""
    kept = site_lines.drop_boilerplate(docs)
    return kept.selectExpr(*("length(text) AS n_chars" if c == "n_chars" else c for c in docs.columns)).to(docs.schema)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the smallest doc_id stays."""
    return minhash.keep_one(docs)


def drop_benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontamination.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document gets its rate and number of copies; those without a copy go."""
    return mixing.apply_mixture(docs, table(spark, sf_dir, "labels"))


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", drop_site_lines),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_benchmark_passages),
    ("mixing", mix_sources),
]

#: The models that some stages train can't be said in SQL; tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each one's result is written and read again, and what it wrote on the way removed."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        with written() as leavings:
            out = stage(spark, docs, sf_dir)
        docs = stored(out, name)
        for folder in leavings:
            remove(spark, folder)
    return docs
