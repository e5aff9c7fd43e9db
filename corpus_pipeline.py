"""A training corpus from ``documents``: each stage is one operator of ``cohort.llm``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohort.llm.exact_dedup import drop_copies
from cohort.llm.mixing import mix_sources
from cohort.llm.near_copies import drop_near
from cohort.llm.packing import pack_documents
from cohort.llm.quality import fit_labels, score_rows
from cohort.llm.shared import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on ``labels``, does not reject."""
    model = fit_labels(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_rows(docs, model, name="_quality_score")
    return scored.filter(F.col("_quality_score") >= 0.5).select(docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts stays, the one with the largest id.

    A row that repeats it goes too; where no row of a group has an id, any one stays.
    """
    return drop_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each component of near copies stays, the one with the least id.

    Near copies share five-word shingles to a Jaccard similarity of 0.8 at least.
    Rows without an id come last; of rows that share an id or lack one, the one with
    the least hash of its text stays.
    """
    return drop_near(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the target weight of its source asks for."""
    return mix_sources(docs).select(docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in training sequences."""
    return pack_documents(docs)


STAGES = [
    ("quality classifier", keep_quality),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing sources", mix),
    ("best-fit packing", pack),
]

#: SQL has no counterpart of a trained classifier and a tokenizer.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table; each reads what the one before wrote."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
