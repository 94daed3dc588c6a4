"""A corpus pipeline: bad text out, near-duplicates out, benchmark leaks out, the rest packed into sequences.

``STAGES`` are applied in order; each works on all that the one before kept, and its result is written and read
again as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from basketspark.llm import decontaminate, near_duplicates, packing, quality
from basketspark.llm.common import Written, table


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts (score of at least 0.5)."""
    model = quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality"))
    return docs.filter(quality.score_of(docs, model) >= 0.5)


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: five-word shingles, similarity of 0.8 or more."""
    return near_duplicates.deduplicated(docs, words=5, percent=80)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.without_contaminated(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2048 tokens."""
    return packing.packed_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality classifier", quality_stage),
    ("near-duplicates", dedup_stage),
    ("decontamination", decontamination_stage),
    ("packing", packing_stage),
]

ORACLE_SQL = None  # no SQL for a fitted model; tests compare with a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pipeline over ``documents``; what is between the stages is written to the shared folder."""
    written = Written(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written.keep(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
