"""Severity grading of anomaly records as one CASE expression.

Missing fields take the reference's defaults: score 0, counts 0, totals 1.
A missing threshold gives an error ratio of 0; a zero threshold (a division
error in the reference) gives null here and so does not raise the grade.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .constants import (BERT_ANOMALY_RATIO_CUTS, FOREST_SCORE_CUTS, LSTM_ANOMALY_RATIO_CUTS,
                        LSTM_ERROR_RATIO_CUTS)

_ORDER = ["critical", "high", "medium"]


def _d(x) -> Column:
    return F.lit(x).cast("double")


def _ratio(num: Column, den: Column) -> Column:
    """num / max(den, 1) with missing num → 0 and missing den → 1."""
    return F.coalesce(num, F.lit(0)).cast("double") / F.greatest(F.coalesce(den, F.lit(1)), F.lit(1)).cast("double")


def severity(detector_type: Column | str = "detector_type") -> Column:
    det = F.col(detector_type) if isinstance(detector_type, str) else detector_type
    score = F.coalesce(F.col("anomaly_score"), _d(0))
    err_ratio = F.when(F.col("threshold").isNull(), _d(0)).otherwise(
        F.try_divide(F.coalesce(F.col("mean_error"), _d(0)), F.col("threshold")))
    lstm_ratio = _ratio(F.col("anomaly_count"), F.col("total_sequences"))
    bert_ratio = _ratio(F.col("anomaly_count"), F.col("total_logs"))

    def grade(conds):
        expr = None
        for cond, level in conds:
            expr = F.when(cond, level) if expr is None else expr.when(cond, level)
        return expr.otherwise("low")

    forest = grade([(score < _d(c), lvl) for c, lvl in FOREST_SCORE_CUTS])
    lstm = grade([((err_ratio > _d(ec)) | (lstm_ratio > _d(ac)), lvl)
                  for (ec, lvl), (ac, _) in zip(LSTM_ERROR_RATIO_CUTS, LSTM_ANOMALY_RATIO_CUTS)])
    bert = grade([(bert_ratio > _d(c), lvl) for c, lvl in BERT_ANOMALY_RATIO_CUTS])
    return (F.when(det == "isolation_forest", forest)
             .when(det == "lstm", lstm)
             .when(det == "bert", bert)
             .otherwise(F.lit("medium")))


def severity_rank(sev: Column) -> Column:
    return (F.when(sev == "critical", 4).when(sev == "high", 3)
             .when(sev == "medium", 2).otherwise(1))
