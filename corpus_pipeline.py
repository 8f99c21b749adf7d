"""From raw documents to encoded training text, in five stages.

Each stage is a function (spark, docs, sf_dir) -> DataFrame on all rows that the stage before kept. ``run`` applies
them to the documents table; between stages the rows are written as Parquet in the shared scratch folder
and read again, so a lost executor costs no earlier stage. All but the last return the columns they were given.

Models are fitted on the documents a stage is given that have a label; a stage given no labelled rows keeps
everything.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kerbside.llm import mixing, pieces, quality, simhash, toxicity
from kerbside.llm.common import staged, table
from kerbside.llm.queries import GRADES, PIECES, grade

TOXIC_SCORE = 0.5  # documents from this score on are rejected
LEAST_TAIL = 0.5  # of being better than junk, or a document is rejected


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents whose toxicity score is TOXIC_SCORE or more."""
    fitted = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    scored = toxicity.score(docs, fitted, tuple(docs.columns), "toxicity of the document")
    return scored.filter(F.col("toxicity of the document") < TOXIC_SCORE).select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that are junk more likely than not."""
    rated = quality.rated_documents(docs, table(spark, sf_dir, "labels"), grade())
    graded = quality.grade_texts(docs, quality.fit_ordinal(rated, GRADES), tuple(docs.columns), "grade of the document ")
    return graded.filter(F.col("grade of the document tail_1") >= LEAST_TAIL).select(*[F.col(f"`{c}`") for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the smallest id of each group of near-duplicates."""
    return simhash.deduplicated(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as its source's target asks: not at all, once or twice."""
    return mixing.mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_pieces, pieces, scores of the best segmentations, changes that make the others, and whether each decodes to the text."""
    found = pieces.encode_texts(docs, public_tokenizers.path(PIECES), keep=("doc_id", "source"))
    return found.select("doc_id", "source", F.size("pieces").alias("n_pieces"), "pieces", "scores", "others", "decodes")


STAGES = [
    ("toxicity", reject_toxic),
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("mixing", mix_sources),
    ("pieces", encode),
]

# Scores, fingerprints and segmentations are beyond SQL; tests compare each stage with plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
