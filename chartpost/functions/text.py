"""Text forms of instants, numbers and names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def iso_instant(ts: Column, zone: str = "+00:00") -> Column:
    """``2025-06-15T10:30:00+00:00``; six fraction digits only when there is a fraction."""
    fraction = F.when(F.unix_micros(ts) % 1_000_000 == 0, F.lit("")).otherwise(
        F.date_format(ts, ".SSSSSS")
    )
    return F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit(zone))


def utc_seconds_instant(ts: Column) -> Column:
    """``2025-06-15T10:30:00Z``; any fraction is dropped."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def _bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once, out of line of the generated code."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _shortest_text(value: Column) -> Column:
    """Fewest digits that still read back as ``value``.

    JVMs before 19 may print a digit too many, always in long texts; so 15, 16 and
    17 digits are tried before the JVM's own text.
    """
    forms = [F.format_string(f"%.{digits}e", value) for digits in (14, 15, 16)]
    text = value.cast("string")
    same = F.filter(F.array(*forms, text), lambda form: form.cast("double") == value)
    return F.upper(F.when(F.length(text) < 17, text).otherwise(F.coalesce(F.get(same, F.lit(0)), text)))


def _uncommon_float_text(value: Column) -> Column:
    """Python's text of a double that is very small, very large or has many digits."""

    def render(digits: Column) -> Column:
        plain = F.regexp_replace(
            digits.cast("decimal(38,22)").cast("string"), r"(\.\d+?)0+$", "$1"
        )
        exponent = F.substring_index(digits, "E", -1).cast("int")
        spelled = F.format_string(
            "%se%s%02d",
            F.regexp_replace(F.substring_index(digits, "E", 1), r"\.?0+$", ""),
            F.when(exponent < 0, "-").otherwise("+"),
            F.abs(exponent),
        )
        size = F.abs(value)
        return F.when((size >= 1e-4) & (size < 1e16), plain).otherwise(spelled)

    return (
        F.when(F.isnan(value), F.lit("nan"))
        .when(value == float("inf"), F.lit("inf"))
        .when(value == float("-inf"), F.lit("-inf"))
        .otherwise(_bind(_shortest_text(value), render))
    )


def python_float_text(value: Column) -> Column:
    """A double as Python's ``str`` prints it.

    Spark switches to exponents outside [1e-3, 1e7), Python outside [1e-4, 1e16).
    Common values take Spark's text as it is; the others are rendered apart, which
    keeps the generated code of the common path small.  From 1e17 up, a value exactly
    halfway between two 17-digit texts may end in the other one; both read back the same.
    """
    text = value.cast("string")
    size = F.abs(value)
    common = (F.length(text) < 17) & ((value == 0) | ((size >= 1e-3) & (size < 1e7)))
    return F.when(common, text).when(value.isNotNull(), _bind(value, _uncommon_float_text))


def given_name(name: Column) -> Column:
    """Everything before the first space."""
    return F.substring_index(name, " ", 1)


def family_name(name: Column) -> Column:
    """Everything after the first space, ``Unknown`` when there is none."""
    return F.coalesce(F.try_element_at(F.split(name, " ", 2), F.lit(2)), F.lit("Unknown"))


def non_empty(text: Column) -> Column:
    """Null for the empty string, so that ``coalesce`` treats both alike."""
    return F.nullif(text, F.lit(""))
