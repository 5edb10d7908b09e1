"""Sepsis screening: SIRS, qSOFA, risk level and summary as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartpost.functions.text import python_float_text

# Fixed values, lowest to highest.
RISK_LEVELS = ("low", "moderate", "high", "critical")


def fahrenheit(celsius: Column) -> Column:
    return celsius * 9 / 5 + 32


def _points(*conditions: Column) -> Column:
    total = F.lit(0)
    for condition in conditions:
        total = total + condition.cast("int")
    return total


# Fixed values from here on: the thresholds of both scores and of the risk levels, and the
# wording of criteria and summary.
def _sirs_conditions(m) -> list[Column]:
    return [
        (m("temperature_c") > 38.0) | (m("temperature_c") < 36.0),
        m("heart_rate") > 90,
        m("respiratory_rate") > 20,
        (m("wbc_count") > 12.0) | (m("wbc_count") < 4.0),
    ]


def sirs_score(m=F.col) -> Column:
    return _points(*_sirs_conditions(m))


def sirs_criteria(m=F.col) -> Column:
    temperature, heart, breathing, cells = _sirs_conditions(m)
    return F.array_compact(
        F.array(
            F.when(
                temperature,
                F.concat(
                    F.lit("Temperature "),
                    python_float_text(m("temperature_c")),
                    F.lit("°C ("),
                    F.when(m("temperature_c") > 38.0, F.lit("fever")).otherwise(
                        F.lit("hypothermia")
                    ),
                    F.lit(")"),
                ),
            ),
            F.when(
                heart,
                F.concat(
                    F.lit("Heart rate "),
                    m("heart_rate").cast("string"),
                    F.lit(" bpm (tachycardia)"),
                ),
            ),
            F.when(
                breathing,
                F.concat(
                    F.lit("Respiratory rate "),
                    m("respiratory_rate").cast("string"),
                    F.lit("/min (tachypnea)"),
                ),
            ),
            F.when(
                cells,
                F.concat(
                    F.lit("WBC "),
                    python_float_text(m("wbc_count")),
                    F.lit(" x10³/µL ("),
                    F.when(m("wbc_count") > 12.0, F.lit("leukocytosis")).otherwise(
                        F.lit("leukopenia")
                    ),
                    F.lit(")"),
                ),
            ),
        )
    )


def _qsofa_conditions(m) -> list[Column]:
    return [m("respiratory_rate") >= 22, m("systolic_bp") <= 100]


def qsofa_score(m=F.col) -> Column:
    return _points(*_qsofa_conditions(m))


def qsofa_criteria(m=F.col) -> Column:
    breathing, pressure = _qsofa_conditions(m)
    return F.array_compact(
        F.array(
            F.when(
                breathing,
                F.concat(
                    F.lit("Respiratory rate "),
                    m("respiratory_rate").cast("string"),
                    F.lit("/min (≥22)"),
                ),
            ),
            F.when(
                pressure,
                F.concat(
                    F.lit("Systolic BP "), m("systolic_bp").cast("string"), F.lit(" mmHg (≤100)")
                ),
            ),
        )
    )


def risk_level(sirs: Column, qsofa: Column, lactate: Column) -> Column:
    """First matching level, from critical down."""
    return (
        F.when((sirs >= 3) & (lactate >= 4.0), F.lit("critical"))
        .when((sirs >= 2) & ((qsofa >= 2) | (lactate >= 2.0)), F.lit("high"))
        .when((sirs >= 2) | (qsofa >= 1) | (lactate >= 2.0), F.lit("moderate"))
        .otherwise(F.lit("low"))
    )


def score_summary(
    sirs: Column, qsofa: Column, lactate: Column, sirs_met: Column, qsofa_met: Column
) -> Column:
    """Parts joined by `` | ``; criteria only where some were met."""

    def listed(title: str, criteria: Column) -> Column:
        return F.when(
            F.size(criteria) > 0, F.concat(F.lit(title), F.array_join(criteria, ", "))
        )

    return F.concat_ws(
        " | ",
        F.concat(
            F.lit("SIRS "),
            sirs.cast("string"),
            F.lit("/4, qSOFA "),
            qsofa.cast("string"),
            F.lit("/2"),
        ),
        F.concat(F.lit("lactate "), python_float_text(lactate), F.lit(" mmol/L")),
        listed("SIRS criteria: ", sirs_met),
        listed("qSOFA criteria: ", qsofa_met),
    )
