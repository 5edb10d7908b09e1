"""Scoring of a cohort and its conversion to observations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from chartpost.functions.scoring import (
    RISK_LEVELS,
    qsofa_criteria,
    qsofa_score,
    risk_level,
    score_summary,
    sirs_criteria,
    sirs_score,
)
from chartpost.operators.expectations import keep_valid, measurement_rules

RISK_CODE = "sepsis-risk-score"
RISK_DISPLAY = "Sepsis Risk Score (SIRS + qSOFA)"
SIRS_CODE = "sirs-score"
SIRS_DISPLAY = "SIRS Score"
SIRS_UNIT = "{score}"
SCORE_SYSTEM = "urn:chartpost:sepsis"
SCORE_SOURCE = "sepsis-screening"


def score_cohort(measurements: DataFrame) -> DataFrame:
    """Scores, criteria, risk level and summary per measurement row."""
    points = keep_valid(measurements, measurement_rules()).withColumns(
        {
            "sirs_score": sirs_score(),
            "sirs_criteria": sirs_criteria(),
            "qsofa_score": qsofa_score(),
            "qsofa_criteria": qsofa_criteria(),
        }
    )
    sirs, qsofa, lactate = F.col("sirs_score"), F.col("qsofa_score"), F.col("lactate")
    return points.withColumns(
        {
            "risk_level": risk_level(sirs, qsofa, lactate),
            "summary": score_summary(
                sirs, qsofa, lactate, F.col("sirs_criteria"), F.col("qsofa_criteria")
            ),
        }
    )


def score_metadata():
    return F.to_json(F.struct("sirs_score", "qsofa_score", "lactate", "summary"))


def score_observations(
    scores: DataFrame, system: str = SCORE_SYSTEM, source: str = SCORE_SOURCE
) -> DataFrame:
    """Two queue rows per score: the risk level as text, the SIRS score as a number."""

    def row(code: str, display: str, value, value_str, unit, metadata):
        return F.struct(
            F.lit(code).alias("observation_code"),
            F.lit(display).alias("display_name"),
            value.alias("value"),
            value_str.alias("value_str"),
            unit.alias("unit"),
            metadata.alias("metadata_json"),
        )

    none = F.lit(None)
    risk = row(
        RISK_CODE,
        RISK_DISPLAY,
        none.cast("double"),
        F.col("risk_level"),
        none.cast("string"),
        score_metadata(),
    )
    sirs = row(
        SIRS_CODE,
        SIRS_DISPLAY,
        F.col("sirs_score").cast("double"),
        none.cast("string"),
        F.lit(SIRS_UNIT),
        F.lit("{}"),
    )
    return scores.select(
        "patient_id",
        none.cast("string").alias("encounter_id"),
        F.lit(system).alias("code_system"),
        F.col("measured_at").alias("effective_datetime"),
        F.lit(source).alias("source_system"),
        F.inline(F.array(risk, sirs)),
    )


def risk_distribution(scores: DataFrame) -> DataFrame:
    """Rows per risk level, zero for levels that do not occur; one pass, no join."""
    counts = scores.agg(
        *[F.count_if(F.col("risk_level") == level).alias(level) for level in RISK_LEVELS]
    )
    lines = F.array(
        *[
            F.struct(F.lit(level).alias("risk_level"), F.col(level).alias("n_patients"))
            for level in RISK_LEVELS
        ]
    )
    return counts.select(F.inline(lines))
