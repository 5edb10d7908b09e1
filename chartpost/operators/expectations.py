"""Row rules: drop what fails, count it per rule, keep it apart when asked."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def queue_rules() -> dict[str, Column]:
    """Rules of the ready table."""
    return {
        "valid_patient": F.col("patient_id").isNotNull(),
        "valid_code": F.col("observation_code").isNotNull(),
    }


def _finite(column: str) -> Column:
    return ~F.isnan(column) & (F.abs(F.col(column)) != float("inf"))


def delivery_rules(columns: list[str]) -> dict[str, Column]:
    """Rules a row needs before it can be sent: a key and a value JSON can carry."""
    present = F.lit(False)
    for name in ("value", "value_str", "value_bool"):
        if name in columns:
            present = present | F.col(name).isNotNull()
    return {
        **queue_rules(),
        "valid_value": present & F.coalesce(_finite("value"), F.lit(True)),
        "valid_effective": F.col("effective_datetime").isNotNull(),
    }


def observation_rules() -> dict[str, Column]:
    """The same for normalised observations, whichever way they came."""
    present = F.col("value_num").isNotNull()
    for name in ("value_str", "value_bool"):
        present = present | F.col(name).isNotNull()
    return {
        "valid_patient": F.col("patient_id").isNotNull(),
        "valid_code": F.col("code").isNotNull(),
        "valid_value": present & F.coalesce(_finite("value_num"), F.lit(True)),
        "valid_effective": F.col("effective_datetime").isNotNull(),
    }


def cohort_rules() -> dict[str, Column]:
    """What a measurement needs before its scores can be sent."""
    return {
        **measurement_rules(),
        "valid_patient": F.col("patient_id").isNotNull(),
        "valid_measured_at": F.col("measured_at").isNotNull(),
    }


def quarantine_rows(rejected: DataFrame) -> DataFrame:
    """Rows with ``failed_rules``, in the shape of the quarantine table.

    Inputs differ in their columns; ``row_json`` keeps them all.
    """

    def first_of(names: tuple[str, ...], kind: str) -> Column:
        here = [F.col(name).cast(kind) for name in names if name in rejected.columns]
        return here[0] if here else F.lit(None).cast(kind)

    kept = [name for name in rejected.columns if name != "failed_rules"]
    shaped = rejected.select(
        first_of(("patient_id",), "string").alias("patient_id"),
        first_of(("observation_code", "code"), "string").alias("observation_code"),
        first_of(("effective_datetime", "measured_at"), "timestamp").alias("effective_datetime"),
        first_of(("queued_at",), "timestamp").alias("queued_at"),
        "failed_rules",
        F.to_json(F.struct(*kept), {"ignoreNullFields": "false"}).alias("row_json"),
    )
    return shaped.withColumn("row_hash", F.xxhash64("failed_rules", "row_json"))


def measurement_rules() -> dict[str, Column]:
    """Scoring inputs must be there; NaN would compare above every number."""
    doubles = ("temperature_c", "wbc_count", "lactate")
    integers = ("heart_rate", "respiratory_rate", "systolic_bp")
    return {
        **{f"valid_{c}": F.coalesce(_finite(c), F.lit(False)) for c in doubles},
        **{f"valid_{c}": F.col(c).isNotNull() for c in integers},
    }


def _all_hold(rules: dict[str, Column]) -> Column:
    held = F.lit(True)
    for rule in rules.values():
        held = held & F.coalesce(rule, F.lit(False))
    return held


def keep_valid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    return df.where(_all_hold(rules))


def keep_invalid(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Failing rows with the names of the rules they break."""
    broken = F.array_compact(
        F.array(
            *[
                F.when(~F.coalesce(rule, F.lit(False)), F.lit(name))
                for name, rule in rules.items()
            ]
        )
    )
    return df.where(~_all_hold(rules)).withColumn("failed_rules", F.array_join(broken, ","))


def count_failures(rules: dict[str, Column]) -> list[Column]:
    """One failing-row count per rule, also usable as observed metrics."""
    return [
        F.count_if(~F.coalesce(rule, F.lit(False))).alias(f"{name}_failed")
        for name, rule in rules.items()
    ]


def expectation_report(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Passed and failed rows per rule, in one pass; a row may fail several rules."""
    counts = df.agg(F.count(F.lit(1)).alias("n_rows"), *count_failures(rules))
    lines = F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(name).alias("rule"),
                    (F.col("n_rows") - F.col(f"{name}_failed")).alias("passed"),
                    F.col(f"{name}_failed").alias("failed"),
                )
                for name in rules
            ]
        )
    )
    return counts.select(lines.alias("line")).select("line.*")
