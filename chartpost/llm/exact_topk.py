"""Exact top-k search: term-at-a-time accumulation over blocks of postings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.llm.tables import session, store

# Rows per block; a pair of blocks is one group of work with bounded memory.
QUERY_ROWS, CANDIDATE_ROWS = 2048, 16384
# Queries whose score arrays are held at a time.
SCORE_ROWS = 64


def quantised(vector: str = "embedding", scale: int = 64) -> Column:
    """Each component times ``scale``, floored; null for a vector that takes no part."""
    parts = F.transform(vector, lambda x: x.cast("double"))
    sound = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    whole = F.transform(parts, lambda x: F.floor(x * scale).cast("long"))
    return F.when(F.col(vector).isNotNull() & sound, whole)


def top_of(scores: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores, equal scores by position, in that order."""
    size = len(scores)
    if k < size:
        bound = np.partition(scores, size - k)[size - k]
        above = np.flatnonzero(scores > bound)
        keep = np.concatenate([above, np.flatnonzero(scores == bound)[: k - len(above)]])
    else:
        keep = np.arange(size)
    return keep[np.lexsort((keep, -scores[keep]))]


def accumulate(queries: np.ndarray, candidates: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """(first query, dense scores) by blocks of queries.

    For each term (dimension) its posting list holds the candidates with a weight there;
    each query with a weight for the term adds the product to its score array.
    """
    postings = []
    for term in range(candidates.shape[1]):
        rows = np.flatnonzero(candidates[:, term])
        weights = candidates[rows, term]
        # A term that nearly all candidates hold needs no list of rows.
        dense = len(rows) * 2 > len(candidates)
        postings.append((slice(None), candidates[:, term].copy()) if dense else (rows, weights))
    for first in range(0, len(queries), SCORE_ROWS):
        block = queries[first : first + SCORE_ROWS]
        scores = np.zeros((len(block), len(candidates)), candidates.dtype)
        for at, query in enumerate(block):
            row = scores[at]
            for term in np.flatnonzero(query):
                rows, weights = postings[term]
                row[rows] += query[term] * weights
        yield first, scores


def _best_of_blocks(k: int) -> Callable:
    def search(pairs: pd.DataFrame) -> pd.DataFrame:
        found = [[np.zeros(0, np.int64)] for _ in range(5)]
        sides = {bool(flag): rows for flag, rows in pairs.groupby("is_query")}
        if len(sides) == 2:
            queries, candidates = (sides[flag].sort_values(["vec_id", "row"]) for flag in (True, False))
            left, right = np.array(queries["parts"].tolist(), np.int64), np.array(candidates["parts"].tolist(), np.int64)
            # Sums that fit 32 bits are added in 32 bits.
            largest = int(np.abs(left).max(initial=0)) * int(np.abs(right).max(initial=0))
            if largest * max(1, left.shape[1]) < 2**31:
                left, right = left.astype(np.int32), right.astype(np.int32)
            ids, query_ids = candidates["vec_id"].to_numpy(), queries["vec_id"].to_numpy()
            own, query_own = candidates["row"].to_numpy(), queries["row"].to_numpy()
            for first, scores in accumulate(left, right):
                for at, row in enumerate(scores, first):
                    # One more than wanted, as the query may find itself.
                    top = top_of(row, k + 1)
                    top = top[own[top] != query_own[at]][:k]
                    asked = np.full(len(top), query_own[at]), np.full(len(top), query_ids[at])
                    for column, values in zip(found, (*asked, own[top], ids[top], row[top])):
                        column.append(values.astype(np.int64))
        names = ("query_row", "query_id", "row", "vec_id", "score")
        return pd.DataFrame(dict(zip(names, map(np.concatenate, found))))

    return search


def top_k(vectors: DataFrame, queries: Column, k: int, vector: str = "embedding") -> DataFrame:
    """The ``k`` highest inner products of each query vector with all other vectors.

    ``vectors``: vec_id and an array column (others ignored); ``queries`` selects rows.
    Returns query_id, rank (from 1), vec_id, score; ties to the smaller vec_id; fewer
    rows where there are fewer candidates.  Null vectors, vectors with null or non-finite
    components and null vec_ids take no part; only vectors of one length meet.  Rows that
    repeat a vec_id are vectors of their own under that id, and find each other.  An
    empty table, or no query, gives no rows.  Scores beyond 63 bits are refused (ValueError).

    Both sides are dealt into blocks of bounded size by a hash of the row, and each
    pair of blocks is one group: the query set meets all rows, block by block.
    """
    session(vectors.sparkSession)
    sound = vectors.where(F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), quantised(vector).alias("parts"), F.coalesce(queries, F.lit(False)).alias("wanted")
    )
    rows = store(
        sound.where("parts is not null").select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "parts", "wanted", F.size("parts").alias("width")
        ),
        "vectors",
    )
    count, wanted, width, high, low = rows.agg(
        F.count(F.lit(1)), F.count_if("wanted"), F.max("width"), F.max(F.array_max("parts")), F.min(F.array_min("parts"))
    ).first()
    if max(abs(high or 0), abs(low or 0)) ** 2 * (width or 0) >= 1 << 63:
        raise ValueError("scores of these components do not fit 63 bits")
    n_query, n_candidate = max(1, -(-wanted // QUERY_ROWS)), max(1, -(-count // CANDIDATE_ROWS))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    columns = ["is_query", "q", "c", "width", "row", "vec_id", "parts"]
    asking = rows.where("wanted").select(
        F.lit(True).alias("is_query"), block(n_query).alias("q"), every(n_candidate).alias("c"), "width", "row", "vec_id", "parts"
    )
    answering = rows.select(
        F.lit(False).alias("is_query"), every(n_query).alias("q"), block(n_candidate).alias("c"), "width", "row", "vec_id", "parts"
    )
    best = (
        asking.select(*columns)
        .unionByName(answering.select(*columns))
        .groupBy("q", "c", "width")
        .applyInPandas(_best_of_blocks(k), "query_row long, query_id long, row long, vec_id long, score long")
    )
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id", "row")
    return best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
