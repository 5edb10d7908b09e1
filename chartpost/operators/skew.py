"""Guards that keep one hot key, or one growing table, from stalling a stage."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.session import cut_lineage, shuffle_partitions

CHUNK = "_chunk"
# Each task sends at most so many rows to the one that merges them.
MAX_TOP_ROWS = 1_000


def plain_side(df: DataFrame) -> DataFrame:
    """Store a derived join side, so that the join reads two plain shuffles.

    Adaptive execution splits a hot partition only where both inputs come straight
    from a shuffle; an aggregate or window in between would hide the hot side.
    """
    return cut_lineage(df)


def in_ordered_chunks(
    df: DataFrame, group: Sequence[str], order: Sequence[str], chunks: int | None = None
) -> DataFrame:
    """Range-partition by (group, order) and number the ranges.

    A window over a whole group would put a hot group into one task.  Ranges cut
    through groups at equal row counts, so a window per (group, chunk) is bounded;
    what precedes a chunk is carried in from one summary row per (group, chunk).
    Chunk numbers follow the order.  Callers materialise before reading twice,
    as the cut points are sampled.
    """
    count = chunks or shuffle_partitions(df.sparkSession)
    return df.repartitionByRange(count, *group, *order).withColumn(
        CHUNK, F.spark_partition_id()
    )


def rank_in_group(
    df: DataFrame, group: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """True in ``name`` for the first row of each group, false for all others.

    Two steps: rows are first ranked within (group, input partition), which bounds
    every task even when one group, or many copies of one row, fill the table.
    Only those local winners then meet across partitions; the losers are already
    decided and stay spread.
    """
    spread = df.withColumn("_part", F.spark_partition_id())
    local = spread.withColumn(
        "_local", F.row_number().over(Window.partitionBy(*group, "_part").orderBy(*order))
    ).withColumn("_meet", F.when(F.col("_local") == 1, F.lit(-1)).otherwise(F.col("_part")))
    ranked = local.withColumn(
        "_rank", F.row_number().over(Window.partitionBy(*group, "_meet").orderBy(*order))
    )
    return ranked.withColumn(name, (F.col("_local") == 1) & (F.col("_rank") == 1)).drop(
        "_part", "_local", "_meet", "_rank"
    )


def first_rows(
    df: DataFrame, order: Sequence[str], n: int, max_top_rows: int = MAX_TOP_ROWS
) -> DataFrame:
    """The first ``n`` rows in a total order.

    A small ``n`` is Spark's top-k.  A large one would gather n rows in one task, so
    the rows are range-partitioned instead and numbered from the row counts of the
    ranges before (one row per range).
    """
    if n <= max_top_rows:
        return df.orderBy(*order).limit(n)
    ranged = in_ordered_chunks(df, [], order)
    position = F.row_number().over(Window.partitionBy(CHUNK).orderBy(*order))
    numbered = cut_lineage(ranged.withColumn("_position", position))
    sizes = numbered.groupBy(CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        CHUNK, F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start")
    )
    return (
        numbered.join(F.broadcast(starts), CHUNK)
        .where(F.col("_start") + F.col("_position") <= n)
        .select(*df.columns)
    )
