"""The opN_ queries over whole tables, and their SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import op1_toxicity, op2_licenses, op3_pii, op4_lines, op5_katz, op6_quality, op7_decontaminate, op8_suffixes, op9_pieces, op10_minhash, op11_quality, op12_negatives, op13_periods, oracles
from .common import table


def tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op1_toxicity.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op2_licenses.scanned(table(spark, sf_dir, "documents"))


def op3_pii_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op3_pii.found(table(spark, sf_dir, "documents"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op4_lines.report(table(spark, sf_dir, "documents"))


def op5_katz_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op5_katz.scored(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op6_quality.judged(table(spark, sf_dir, "documents"))


def op7_decontaminate_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = op7_decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.drop("spans", "items")


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op8_suffixes.deduplicated(table(spark, sf_dir, "documents"))


def op9_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op9_pieces.encoded(table(spark, sf_dir, "documents"), tokenizer())


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op10_minhash.duplicates(table(spark, sf_dir, "documents"), words=2)


def op11_quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op11_quality.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return op12_negatives.mined(table(spark, sf_dir, "embeddings").withColumn("label", label))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return op13_periods.digested(op13_periods.found(table(spark, sf_dir, "documents"), repeat_some=True))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: f for k, f in globals().items() if k[:2] == "op" and k[2:3].isdigit() and callable(f)}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_line_dedup": oracles.LINES,
        "op6_quality_rules": oracles.QUALITY,
        "op7_decontaminate_benchmark": oracles.DECONTAMINATION,
        "op8_suffix_dedup": oracles.SUFFIXES,
        "op10_near_duplicates": oracles.NEAR_DUPLICATES,
        "op12_hard_negatives": oracles.HARD_NEGATIVES,
        "op13_periodic_runs": oracles.PERIODIC_RUNS,
    }
