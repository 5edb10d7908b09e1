"""Idempotency keys."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from chartpost.functions.text import iso_instant


def idempotency_key(
    patient_id: Column, code: Column, effective: Column, prefix: Column | str = ""
) -> Column:
    """SHA-256 (hex) of ``<prefix><patient>:<code>:<instant>``.

    ``concat`` is null as soon as one part is null, so an incomplete row has no
    key instead of a key it shares with others.
    """
    head = F.lit(prefix) if isinstance(prefix, str) else prefix
    return F.sha2(
        F.concat(head, patient_id, F.lit(":"), code, F.lit(":"), iso_instant(effective)), 256
    )
