"""The corpus pipeline: each stage works on all that the one before it kept, and its decisions take effect.

What holds for every stage but the last: all columns of documents come back, others that a caller has added too; rows
that repeat an id are rows of one document; a null id is carried through; an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quillon.llm import op1_toxicity, op4_lines, op7_decontaminate, op9_pieces, op10_minhash
from quillon.llm.common import dropped, stored, table
from quillon.llm.queries import tokenizer


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents predicted to be toxic go. Null and empty texts have no words: the labels' odds alone judge them, so they
    stay where less than half of the labels are toxic."""
    return op1_toxicity.kept(docs, table(spark, sf_dir, "labels"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later repeats of runs of lines with 50 words or more are cut out; documents that are nothing else go. Null and empty
    texts stay as they are; rows equal in id and text cut nothing out of each other; a null id comes last in the order."""
    return op4_lines.removed(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five words, 0.8) stays: that with the smallest id, with all its rows.
    Null and empty texts and rows with a null id are in no group and stay."""
    return op10_minhash.kept(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Contaminated documents go; single benchmark passages are cut out of the others. Null and empty texts stay."""
    return op7_decontaminate.removed(docs, table(spark, sf_dir, "benchmark"))


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and decoded text of what is left, a row for each row; a null or empty text has no ids and an empty text."""
    return op9_pieces.encoded(docs, tokenizer(), with_ids=True)


STAGES = [
    ("toxicity", toxicity),
    ("line dedup", line_dedup),
    ("minhash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("sentencepiece", pieces),
]
#: No stage's method can be said in SQL; tests/llm/test_pipeline.py holds each stage against a plain version of it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; a stage's table goes once the next one's is written."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir))
        if before is not None:
            dropped(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
