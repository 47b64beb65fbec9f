"""A corpus for training: quality, near copies, benchmark leaks, source weights, token files.

Each stage takes (spark, docs, sf_dir) and works on all rows that the one before kept; all but the last return the
columns of ``docs``. ``run`` writes each stage as Parquet to the shared folder and reads it for the next one.

Defined results, for every stage: an empty table gives no rows; columns besides doc_id, text and source pass through all but
the last stage whatever their names; each row of a repeated doc_id is judged by its own text, except that near duplicates and
the mix treat rows of one doc_id alike. What a stage does with nulls, empty texts and ties is told at it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pagemill.llm import decontaminate, mixing, near_dups, quality_model, token_files
from pagemill.llm.common import load, stage
from pagemill.llm.queries import tokenizer


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the labelled ones, doesn't reject.

    A null or empty text is scored by statistics of 0 and may go; a null doc_id has no label and is scored like any other;
    without labels every score is 0.5 and all stay; a score right at the threshold stays; repeated rows fare alike.
    """
    return quality_model.reject_low(docs, quality_model.train(docs, load(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that five-word shingles link at a similarity of 0.8: the smallest doc_id.

    Null and empty texts, texts without words and rows without a doc_id belong to no group and stay; all rows of a doc_id
    that stands for its group stay; a similarity of exactly 0.8 is a link; a text of fewer words than five is one shingle.
    """
    return near_dups.drop_near(docs, threshold=80, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items, five-word shingles of which 0.8 or more are in the text.

    Null and empty texts and items match nothing; a containment of exactly 0.8 is a leak; a shorter item is sought as its
    whole sequence; without items all stay; a null doc_id or item_id changes nothing.
    """
    return decontaminate.drop_leaks(docs, load(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, at most twice.

    A null source is a source of its own; a null or empty text has size 0 and is taken like any other; rows that share a
    doc_id share a fate; sources of equal ratio are clamped in one round.
    """
    return mixing.mix_sources(docs)


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: a row for each document that they hold.

    A null or empty text has the end id alone; rows without a doc_id come first; repeated rows are written each, side by side.
    """
    return token_files.encoded_documents(docs, tokenizer())


STAGES = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixture", mixture),
    ("token_output", token_output),
]

#: Boosted trees, sketches and files can't be told in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
