"""Mixing sources: tempered weights for a target, drawn as budgeted block permutations."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.llm.tables import broadcast_if_bounded, session, store

WORD = r"[^ \t-\r]+"
# Points of a section of the exponent's interval, and how often it is narrowed.
SECTIONS, ROUNDS = 32, 5
# A document's place in its source's permutation: 63 bits, found by digits of 12 bits.
ORDER_BITS, DIGIT_BITS, DIGITS = 63, 12, 3


@dataclass(frozen=True)
class Target:
    """What the exponent must meet.

    entropy: least share of the greatest possible entropy of the weights; max_repeats: most
    times a source may be drawn.  The exponent is the greatest, nearest to the natural
    shares, that reaches the entropy, but not so small that a source repeats too often.
    """

    entropy: float = 0.95
    max_repeats: float = 2.0


def counted(documents: DataFrame, source: str = "source") -> DataFrame:
    """(doc_id, source, n_tokens): words of each whole text, zero for null."""
    return documents.select(
        F.col("doc_id").cast("long"),
        F.col(source).cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )


def _measure(shares: DataFrame, exponents: list[float], budget: float | None) -> list[tuple[float, float, float]]:
    """(exponent, entropy, most repeats) of the weights p**exponent / Z; one row each."""
    rows = shares.select("p", F.explode(F.array(*map(F.lit, exponents))).alias("a"))
    power = F.pow("p", "a")
    sums = rows.groupBy("a").agg(
        F.sum(power).alias("z"), F.sum(power * F.col("a") * F.log("p")).alias("plogp"), F.max(F.pow(F.col("p"), F.col("a") - 1)).alias("most"), F.min(F.pow(F.col("p"), F.col("a") - 1)).alias("least")
    )
    # Drawn with budget x total tokens, a source of share p repeats budget * p**(a-1) / z times;
    # without a budget, the source that repeats least is drawn once.
    repeats = F.col("most") / F.col("least") if budget is None else F.lit(budget) * F.col("most") / F.col("z")
    found = sums.select("a", (F.log("z") - F.col("plogp") / F.col("z")).alias("h"), repeats.alias("r"))
    return sorted((row.a, row.h, row.r) for row in found.collect())


def _border(shares: DataFrame, budget: float | None, below: Callable[[float, float], bool]) -> tuple[float, float]:
    """The last exponent for which ``below`` holds and the first for which it does not.

    ``below(entropy, repeats)`` holds for small exponents only.  The interval is narrowed
    by sections: many exponents are measured in one aggregate.
    """
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        points = [low + (high - low) * k / SECTIONS for k in range(SECTIONS + 1)]
        held = [a for a, h, r in _measure(shares, points, budget) if below(h, r)]
        low = max(held, default=points[0])
        high = min((a for a in points if a > low), default=low) if held else points[0]
    return low, high


def exponent_for(sources: DataFrame, target: Target, budget: float | None = None) -> float:
    """Exponent between 0 (equal weights) and 1 (natural shares) that meets ``target``.

    ``sources``: stored rows with n_tokens > 0.  The driver sees a few numbers per exponent
    tried, whatever the number of sources.
    """
    total = sources.agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    if not total[0]:
        return 1.0
    shares = sources.select((F.col("n_tokens") / F.lit(float(total[0]))).alias("p"))
    [(_, highest, _)] = _measure(shares, [0.0], budget)
    # Entropy and repetition both fall as the exponent grows.
    _, allowed = _border(shares, budget, lambda h, r: r > target.max_repeats * (1 + 1e-9))
    diverse, _ = _border(shares, budget, lambda h, r: h >= target.entropy * highest * (1 - 1e-12))
    return max(allowed, diverse)


def weights(sources: DataFrame, exponent: float, budget: float | None) -> DataFrame:
    """Per source: weight, passes (whole draws) and rest (tokens of the last, partial draw)."""
    total, _ = sources.agg(F.sum("n_tokens"), F.count(F.lit(1))).first()
    share = F.col("n_tokens") / F.lit(float(total or 1))
    powered = sources.withColumn("power", F.pow(share, F.lit(exponent)))
    z, least = powered.agg(F.sum("power"), F.min(F.pow(share, F.lit(exponent - 1)))).first()
    tokens = float(total or 0) * (budget if budget is not None else (z or 1.0) / (least or 1.0))
    weight = F.col("power") / F.lit(z or 1.0)
    draws = weight * F.lit(tokens) / F.col("n_tokens")
    # The exponent is found within 3e-8, so a whole draw is not lost to its last digits.
    passes = F.floor(draws + F.lit(1e-6)).cast("long")
    rest = F.floor(F.greatest(draws - passes, F.lit(0.0)) * F.col("n_tokens")).cast("long")
    return powered.select("source", weight.alias("weight"), passes.alias("passes"), rest.alias("rest"))


def place(number: Column, seed: int) -> Column:
    """Place of a document in its source's permutation of pass ``number``; 63 bits."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), number.cast("long"), F.col("doc_id")), 1)


def _same_source(left: str, right: str) -> Column:
    return F.col(left).eqNullSafe(F.col(right))


def _cuts(rows: DataFrame, plan: DataFrame, seed: int) -> DataFrame:
    """Per source: the last place that the partial draw's tokens reach, -1 for none.

    Found digit by digit: tokens per digit value and source are summed, the running sum
    over at most 4096 values finds the one in which the rest ends, and the next digit
    looks inside it.  After three digits a value holds one document in 2**36, and
    the documents there are summed in order.
    """
    plan = plan.withColumnsRenamed({"source": "_source"})
    placed = store(
        rows.join(broadcast_if_bounded(plan.where("rest > 0")), _same_source("source", "_source")).select(
            "source", place(F.col("passes"), seed).alias("place"), "n_tokens", "rest"
        ),
        "places",
    )
    state = placed.groupBy("source").agg(
        F.max("rest").alias("left"), F.lit(0).cast("long").alias("prefix")
    )
    shift = ORDER_BITS
    for _ in range(DIGITS):
        known, shift = shift, shift - DIGIT_BITS
        held = broadcast_if_bounded(store(state.withColumnRenamed("source", "_source"), "cut-digits"))
        inside = placed.join(held, _same_source("source", "_source")).where(
            F.shiftrightunsigned("place", known) == F.col("prefix") if known < ORDER_BITS else F.lit(True)
        )
        digits = inside.groupBy("source", "left", F.shiftrightunsigned("place", shift).alias("digit")).agg(
            F.sum("n_tokens").alias("n")
        )
        running = F.sum("n").over(Window.partitionBy("source").orderBy("digit"))
        over = digits.withColumn("upto", running).where(F.col("upto") > F.col("left"))
        state = over.groupBy("source").agg(
            F.min(F.struct("digit", (F.col("left") - (F.col("upto") - F.col("n"))).alias("left"))).alias("s")
        ).select("source", F.col("s.left").alias("left"), F.col("s.digit").alias("prefix"))
    held = broadcast_if_bounded(store(state.withColumnRenamed("source", "_source"), "cut-digits"))
    units = (
        placed.join(held, _same_source("source", "_source"))
        .where(F.shiftrightunsigned("place", shift) == F.col("prefix"))
        .groupBy("source", "left", "place")
        .agg(F.sum("n_tokens").alias("n"))
    )
    upto = F.sum("n").over(Window.partitionBy("source").orderBy("place"))
    fitting = units.withColumn("upto", upto).where(F.col("upto") <= F.col("left"))
    ends = fitting.groupBy("source").agg(F.max("place").alias("cut"))
    starts = state.select("source", (F.shiftleft("prefix", shift) - 1).alias("before"))
    return starts.join(ends.withColumnRenamed("source", "_source"), _same_source("source", "_source"), "left").select(
        "source", F.coalesce("cut", "before").alias("cut")
    )


def plan_mix(
    documents: DataFrame, target: Target, budget: float | None, seed: int, source: str
) -> tuple[DataFrame, DataFrame]:
    """Counted rows, and per source: weight, passes and cut."""
    rows = store(counted(documents, source), "counted")
    sources = store(
        rows.groupBy("source").agg(F.sum("n_tokens").alias("n_tokens")).where("n_tokens > 0"), "sources"
    )
    plan = store(weights(sources, exponent_for(sources, target, budget), budget), "weights")
    cuts = _cuts(rows, plan, seed).withColumnRenamed("source", "_source")
    full = plan.join(cuts, _same_source("source", "_source"), "left").select(
        F.col("source").alias("_by"), "weight", "passes", F.coalesce("cut", F.lit(-1)).alias("cut")
    )
    return rows, broadcast_if_bounded(store(full, "mix-plan"))


def _copies(seed: int) -> Column:
    return F.col("passes") + (place(F.col("passes"), seed) <= F.col("cut")).cast("long")


def _drawn(rows: DataFrame, plan: DataFrame, source: str, seed: int) -> DataFrame:
    """One row per copy drawn, numbered by pass."""
    joined = rows.join(plan, F.col(source).cast("string").eqNullSafe(F.col("_by")))
    counted_copies = joined.withColumn("_copies", _copies(seed)).where("_copies > 0")
    return counted_copies.withColumn("pass", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_copies") - 1)))


def mix(
    documents: DataFrame,
    target: Target = Target(),
    budget: float | None = None,
    seed: int = 0,
    source: str = "source",
) -> DataFrame:
    """Copies to train on: doc_id, source, pass, block, place, mix_order, n_tokens, weight.

    A source's weight is its share of all tokens (words) to the power of the exponent,
    normalised.  ``budget`` is the tokens to draw as a multiple of all tokens; None is as
    many as draw every source whole at least once, so that no document is lost.  A source
    is drawn in whole passes and a last, partial one; each pass is another permutation of
    its documents, by hash, in blocks (the first digit of the place), and the partial pass
    ends where its tokens do.  Sorting by mix_order interleaves all copies evenly.

    A null source is a source of its own.  A source without a token has no weight and is
    not drawn; empty texts of other sources are drawn like any.  Rows that repeat a
    doc_id within a source (null: also) share a place and are drawn together.  An empty
    table gives no rows.
    """
    session(documents.sparkSession)
    rows, plan = plan_mix(documents, target, budget, seed, source)
    at = place(F.col("pass"), seed)
    return _drawn(rows, plan, "source", seed).select(
        "doc_id",
        "source",
        F.col("pass").cast("int").alias("pass"),
        F.shiftrightunsigned(at, ORDER_BITS - DIGIT_BITS).cast("int").alias("block"),
        at.alias("place"),
        F.xxhash64(F.lit(seed + 1), F.col("pass"), F.col("doc_id")).alias("mix_order"),
        "n_tokens",
        "weight",
    )


def mixed_documents(
    documents: DataFrame,
    target: Target = Target(),
    budget: float | None = None,
    seed: int = 0,
    source: str = "source",
) -> DataFrame:
    """The documents with all their columns, once per copy drawn; see ``mix``."""
    session(documents.sparkSession)
    _, plan = plan_mix(documents, target, budget, seed, source)
    # Held together, so that no column of theirs can clash with the plan's.
    rows = documents.select(
        F.col("doc_id").cast("long"), F.col(source).alias("source"), F.struct(*documents.columns).alias("_row")
    )
    return _drawn(rows, plan, "source", seed).select("_row.*")
