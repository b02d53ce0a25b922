"""Cleaning pipeline over ``documents``: five stages, each on all its predecessor kept.

``run`` writes the rows of each stage as Parquet to the shared folder and reads them back for
the next, so a lost executor costs at most the work of one stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clickloom.llm.common import written
from clickloom.llm.exact_dedup import exact_dedup
from clickloom.llm.language_id import UNKNOWN, identify_languages, train
from clickloom.llm.packing import pack_documents
from clickloom.llm.secret_scan import scan_secrets
from clickloom.llm.simhash import simhash_dedup

# how far the share of a label lies above an even split among the labels, at least; 1 is certainty
LEAST_LEAD = 0.2


def least_score(labels: int) -> float:
    """The least share of a predicted label that is more than a guess among ``labels``."""
    return (1 + LEAST_LEAD * (labels - 1)) / labels


def _own(docs: DataFrame) -> DataFrame:
    """``docs`` under names that no operator gives its results."""
    return docs.select(*[docs[c].alias(f"own_{c}") for c in docs.columns])


def _back(found: DataFrame, docs: DataFrame) -> DataFrame:
    return found.select(*[found[f"own_{c}"].alias(c) for c in docs.columns])


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language; a missing ``lang`` is filled in.

    The model learns from the labelled documents at hand. Null texts and texts without a
    letter go, and those whose language has a share below :func:`least_score`. If no document
    is labelled, all texts with a letter stay; with one label all of them have it. Rows that
    repeat each other stay or go together. Columns named like a result of the operator stay.
    """
    model = train(docs)
    if model is None:
        return docs.where(F.col("text").rlike(r"\p{L}"))
    found = identify_languages(_own(docs), model, "own_text")
    known = (F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least_score(len(model.labels)))
    filled = F.coalesce("own_lang", "lang_pred")
    return _back(found.where(known).withColumn("own_lang", filled), docs)


def exact_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents of equal text the one with the largest ``doc_id``; null text is empty."""
    return _back(exact_dedup(_own(docs), "own_text", "own_doc_id").where("kept"), docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents whose fingerprints are linked that of the smallest ``doc_id``.

    Exactly one of each group stays: where several have that id, or none has an id, it is the
    first of them as they lie in the table. Null texts count as empty ones.
    """
    # a number of its own for each row, ordered by id, known ones first
    ident = F.struct(
        F.col("own_doc_id").isNull(), "own_doc_id", F.monotonically_increasing_id().alias("place")
    )
    found = simhash_dedup(_own(docs).withColumn("ident", ident), "own_text", "ident")
    return _back(found.where(F.col("ident") == F.col("component_id")), docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any secret, key or linked credential; null text has none."""
    return _back(scan_secrets(_own(docs), "own_text").where(F.size("secret_spans") == 0), docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 2048 tokens.

    A null text is an empty one, of one token; an empty table gives no pieces.
    """
    return pack_documents(docs.select("doc_id", "text"))


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_duplicates),
    ("simhash_dedup", near_duplicates),
    ("secret_scan", secrets),
    ("best_fit_packing", packing),
]

# Training, hashing and tokenising cannot be expressed in SQL; tests/llm has a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the rows of the last."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
