"""The corpus pipeline: five stages over `documents`, each of which works on all the last one kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from courtside.llm.common import read, written
from courtside.llm.decontaminate import decontaminate_stage
from courtside.llm.exact_dedup import exact_dedup_stage
from courtside.llm.setsketch import near_dedup_stage
from courtside.llm.toxicity import toxicity_stage
from courtside.llm.unigram import sentencepiece_stage

#: (name, function of (spark, docs, sf_dir)); all but the last return the columns of documents.
STAGES = [
    ("toxicity", toxicity_stage),
    ("exact_dedup", exact_dedup_stage),
    ("near_dedup", near_dedup_stage),
    ("decontaminate", decontaminate_stage),
    ("sentencepiece", sentencepiece_stage),
]

#: SQL can express neither the field's scores nor the segmentation: tests/llm compares the stages
#: with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages in order over the documents of ``sf_dir``, each written before the next reads it."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
