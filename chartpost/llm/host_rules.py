"""Quality rules per document, judged by how often the document's host breaks them."""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from chartpost.llm.tables import broadcast_if_bounded, session, store

SYMBOLS = re.compile(r"[#*$%&|<>]")
BLANKS = b" \t\n\r\x0b\x0c"
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

# Rules that need the host's habit to count: what a document must break.
HABITS = {
    "symbols": "10 * n_symbols > word_chars",
    "lines": "2 * n_dup_lines > n_lines",
}
# A rule that a host breaks at this shrunk rate or above is a habit of the host.
HABIT_RATE = 0.01
# A host whose shrunk rate of documents that break any rule reaches this is rejected whole.
HOST_RATE = 0.9


def repeated_words(words: list[bytes]) -> int:
    """Words inside three-word windows that the text holds at least twice."""
    if len(words) < 4:
        return 0
    number = defaultdict(count().__next__)
    ids = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    pairs = ids[:-1] * len(number) + ids[1:]
    if len(number) >= 1 << 20:
        pairs = np.unique(pairs, return_inverse=True)[1]
    windows = pairs[:-1] * len(number) + ids[2:]
    order = np.argsort(windows, kind="stable")
    same = windows[order[1:]] == windows[order[:-1]]
    if not same.any():
        return 0
    found = np.concatenate([order[1:][same], order[:-1][same]])
    inside = np.zeros(len(words), bool)
    for step in range(3):
        inside[found + step] = True
    return int(inside.sum())


def measures(text: str | None) -> tuple[int, ...]:
    """COUNTS of one whole text; zeros for null."""
    if not text:
        return (0,) * len(COUNTS)
    raw = text.encode()
    words = raw.split()
    blank = len(raw) - len(raw.translate(None, BLANKS))
    # Lines with a word: bytes split into words has the same blanks as the rules.
    lines = [line for line in raw.split(b"\n") if line.translate(None, BLANKS)]
    return (
        len(words),
        len(text) - blank,
        len(SYMBOLS.findall(text)),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
    )


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [measures(text.as_py()) for text in batch.column(2)]
        values = np.array(rows, np.int64).reshape(-1, len(COUNTS))
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), *map(pa.array, values.T.copy())], ["doc_id", "host", *COUNTS]
        )


def measured(documents: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, COUNTS) of each whole text."""
    rows = documents.select(
        F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), F.col("text").cast("string")
    )
    schema = "doc_id long, host string, " + ", ".join(f"{name} long" for name in COUNTS)
    return rows.mapInArrow(_measure, schema)


def _measure_rows(at: int) -> Callable:
    """Adds COUNTS of the text, field ``at`` of the rows in the first column."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(0).flatten()[at].cast(pa.string())
            values = np.array([measures(text.as_py()) for text in texts], np.int64).reshape(-1, len(COUNTS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), *map(pa.array, values.T.copy())], ["_row", "host", *COUNTS]
            )

    return measure


def base_failed() -> Column:
    return (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def _shrunk(failed: str, prior: str) -> Column:
    """Posterior mean rate of a host under its rule's beta prior."""
    strength, mean = F.col(f"{prior}.strength"), F.col(f"{prior}.mean")
    return (F.col(failed) + strength * mean) / (F.col("n_docs") + strength)


def host_verdicts(rows: DataFrame) -> DataFrame:
    """Per host (null included): rejected, and habit_<rule> for each rule of HABITS.

    ``rows`` are measured documents.  Each rule's failures are counted per host.  The
    rates of all hosts give a beta prior by moments: its mean is the mean rate, and its
    strength is mean * (1 - mean) / variance - 1, within 1 and 1000 documents (the
    upper bound also where all hosts have one rate).  A host's rate is shrunk towards the
    mean as if that many documents more had been seen, so a host of few documents is
    judged mostly by the corpus.
    """
    rules = {**HABITS, "any": f"n_words < 50 or 100 * n_repeat_words > 50 * n_words or {' or '.join(HABITS.values())}"}
    hosts = store(
        rows.groupBy("host").agg(
            F.count(F.lit(1)).alias("n_docs"), *[F.count_if(F.expr(rule)).alias(name) for name, rule in rules.items()]
        ),
        "hosts",
    )
    rate = {name: F.col(name) / F.col("n_docs") for name in rules}
    moments = hosts.agg(
        *[F.avg(rate[name]).alias(f"{name}_m") for name in rules],
        *[F.var_pop(rate[name]).alias(f"{name}_v") for name in rules],
    )

    def prior(name: str) -> Column:
        mean, variance = F.col(f"{name}_m"), F.col(f"{name}_v")
        strength = F.when(variance > 1e-12, mean * (1 - mean) / variance - 1).otherwise(F.lit(1000.0))
        return F.struct(F.least(F.greatest(strength, F.lit(1.0)), F.lit(1000.0)).alias("strength"), mean.alias("mean"))

    priors = moments.select(*[prior(name).alias(f"prior_{name}") for name in rules])
    # One row of priors beside each host.
    joined = hosts.withColumn("_one", F.lit(1)).join(F.broadcast(priors.withColumn("_one", F.lit(1))), "_one")
    return joined.select(
        "host",
        (_shrunk("any", "prior_any") >= HOST_RATE).alias("rejected"),
        *[(_shrunk(name, f"prior_{name}") >= HABIT_RATE).alias(f"habit_{name}") for name in HABITS],
    )


def judged(rows: DataFrame) -> DataFrame:
    """Measured ``rows`` (stored) with base_failed, host_rejected, habit_failed and kept."""
    verdicts = broadcast_if_bounded(store(host_verdicts(rows), "host-verdicts")).withColumnRenamed("host", "_host")
    joined = rows.join(verdicts, F.col("host").eqNullSafe(F.col("_host")), "left")
    habit = [F.col(f"habit_{name}") & F.expr(rule) for name, rule in HABITS.items()]
    failed = F.coalesce(habit[0] | habit[1], F.lit(False))
    return joined.select(
        *rows.columns,
        base_failed().alias("base_failed"),
        F.col("rejected").alias("host_rejected"),
        failed.alias("habit_failed"),
        (~(base_failed() | F.col("rejected") | failed)).alias("kept"),
    )


def judge_documents(documents: DataFrame, host: str = "source") -> DataFrame:
    """Verdict per row of ``documents`` (doc_id, text, host column; others ignored).

    A document is kept unless it breaks a base rule, its host is rejected, or it breaks a
    rule that its host breaks by habit.  A null or empty text has no words and fails; a
    null host is a host of its own; repeated rows count and are judged each.  An
    empty table gives no rows.
    """
    session(documents.sparkSession)
    return judged(store(measured(documents, host), "measures"))


def keep_good(documents: DataFrame, host: str = "source") -> DataFrame:
    """The documents kept, with all their columns.

    Each text is measured once, and its counts are stored beside the document's columns,
    so that host verdicts need not be joined back by document.  Null and empty texts go,
    as they have no words; repeated rows are judged each; very long texts are measured whole;
    an empty table gives no rows.
    """
    session(documents.sparkSession)
    columns = documents.columns
    rows = documents.select(F.struct(*columns).alias("_row"), F.col(host).cast("string").alias("host"))
    schema = T.StructType([*rows.schema.fields, *[T.StructField(name, T.LongType()) for name in COUNTS]])
    beside = store(rows.mapInArrow(_measure_rows(columns.index("text")), schema), "measured-rows")
    verdicts = broadcast_if_bounded(store(host_verdicts(beside.select("host", *COUNTS)), "host-verdicts"))
    joined = beside.join(verdicts.withColumnRenamed("host", "_host"), F.col("host").eqNullSafe(F.col("_host")), "left")
    habit = [F.col(f"habit_{name}") & F.expr(rule) for name, rule in HABITS.items()]
    return joined.where(~(base_failed() | F.col("rejected") | habit[0] | habit[1])).select("_row.*")
