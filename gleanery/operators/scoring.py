"""Chapter scores: structure, completeness, meaning, gaps, anomalies, risk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _share(got: str, expected: str) -> Column:
    return F.least(F.col(got) / F.greatest(F.col(expected), F.lit(1)), F.lit(1.0))


def scored(chapters: DataFrame) -> DataFrame:
    """chapters with their scores. Needs the counts expected_question_count, expected_answer_markers,
    expected_option_markers, expected_images, expected_tables, residual_blocks; questions, answers,
    options, images, tables, schema_errors, empty_explanations, duplicate_options; and
    mean_alignment (0 for blocks that are not matched)."""
    n, expected = F.col("questions"), F.greatest(F.col("expected_question_count"), F.lit(1))
    gap = F.least(F.lit(1.0), 0.7 * (F.greatest(F.col("expected_question_count") - n, F.lit(0)) / expected) + 0.3 * (F.col("residual_blocks") / expected))
    complete = 0.35 * _share("questions", "expected_question_count") + 0.2 * _share("answers", "expected_answer_markers") + 0.2 * _share("options", "expected_option_markers") + 0.15 * _share("images", "expected_images") + 0.1 * _share("tables", "expected_tables")
    parts = chapters.select(
        "*",
        F.when(n == 0, 0.0).otherwise(F.round(F.greatest(F.lit(0.0), 1.0 - F.least(F.lit(1.0), F.col("schema_errors") / n)), 4)).alias("structural_accuracy"),
        F.round(complete, 4).alias("completeness_accuracy"),
        F.round(F.coalesce("mean_alignment", F.lit(0.0)), 4).alias("semantic_accuracy"),
        F.round(F.greatest(F.col("expected_question_count") - n, F.lit(0)) / expected, 4).alias("missing_question_ratio"),
        F.round(F.col("residual_blocks") / expected, 4).alias("residual_block_ratio"),
        F.round(gap, 4).alias("schema_gap_risk"),
    )
    dense = F.when(F.col("images") / n > 2.5, 1.0).otherwise(0.0)
    odd = 0.4 * F.col("schema_gap_risk") + 0.25 * (F.col("empty_explanations") / n) + 0.2 * (F.col("duplicate_options") / n) + 0.15 * dense
    final = 0.25 * F.col("structural_accuracy") + 0.35 * F.col("completeness_accuracy") + 0.4 * F.col("semantic_accuracy")
    whole = parts.withColumn("anomaly_score", F.when(n == 0, 1.0).otherwise(F.round(F.least(F.lit(1.0), odd), 4))).withColumn("final_accuracy", F.round(final, 4))
    return whole.withColumn("risk", risk()).withColumn("dominant_failures", dominant_failures())


def risk() -> Column:
    high = (F.col("anomaly_score") >= 0.6) | (F.col("schema_gap_risk") >= 0.5)
    return F.when(high, "high").when((F.col("anomaly_score") >= 0.3) | (F.col("final_accuracy") < 0.75), "medium").otherwise("low")


def dominant_failures() -> Column:
    """array of the failures that a chapter shows, in a fixed order."""
    rules = {
        "schema_errors": F.col("schema_errors") > 0,
        "missing_questions": F.col("expected_question_count") > F.col("questions"),
        "alignment_residuals": F.col("residual_block_ratio") > 0.1,
        "completeness_drop": F.col("completeness_accuracy") < 0.95,
        "semantic_mismatch": F.col("semantic_accuracy") < 0.95,
        "content_anomalies": F.col("anomaly_score") >= 0.3,
    }
    return F.filter(F.array(*(F.when(c, k) for k, c in rules.items())), lambda x: x.isNotNull())
