"""Hard negatives by angular triangle filtering: angles to reference directions bound every score."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.llm.exact_topk import quantised
from chartpost.llm.tables import session, store

# Vectors that are looked at for reference directions, and how many of each length become one.
SAMPLE, REFERENCES = 256, 12
# Rows per block; a pair of blocks is one group of work with bounded memory.
ANCHOR_ROWS, ROWS = 4096, 16384
VECTORS = "row long, vec_id long, label long, parts array<long>, wanted boolean, width int, norm double, angles array<double>"


def directions(sample: np.ndarray) -> np.ndarray:
    """REFERENCES unit vectors of ``sample`` (rows that are not zero), each far from those before."""
    unit = sample / np.linalg.norm(sample, axis=1, keepdims=True)
    chosen, nearest = [], np.full(len(unit), -2.0)
    for _ in range(min(REFERENCES, len(unit))):
        at = int(np.argmin(nearest))
        if nearest[at] >= 1.0 - 1e-12:
            break
        chosen.append(at)
        nearest = np.maximum(nearest, np.abs(unit @ unit[at]))
    return unit[chosen]


def angles_to(parts: np.ndarray, references: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Norm of each row, and its angle to each reference; a zero row is at a right angle to all."""
    values = parts.astype(np.float64)
    norms = np.sqrt((values * values).sum(axis=1))
    cosines = (values @ references.T) / np.maximum(norms, 1.0)[:, None]
    return norms, np.arccos(np.clip(cosines, -1.0, 1.0))


def _measure(references: dict[int, np.ndarray]) -> Callable:
    """Adds norm and angles; rows come with parts of any length."""

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts, widths = batch.column(3), batch.column(5).to_numpy()
            offsets = parts.offsets.to_numpy()
            flat = parts.values.to_numpy(zero_copy_only=False)
            norms = np.zeros(len(widths))
            angles: list = [None] * len(widths)
            for width in np.unique(widths):
                at = np.flatnonzero(widths == width)
                rows = flat[offsets[at][:, None] + np.arange(width)]
                none = np.zeros((0, width))
                norms[at], found = angles_to(rows, references.get(int(width), none))
                for k, angle in zip(at.tolist(), found):
                    angles[k] = angle
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(norms), pa.array(angles, pa.list_(pa.float64()))],
                [*batch.schema.names, "norm", "angles"],
            )

    return measure


class Rows:
    """One side of a block as arrays, in order of vec_id."""

    def __init__(self, table: pa.Table, width: int):
        table = table.sort_by([("vec_id", "ascending"), ("row", "ascending")]).combine_chunks()
        self.ids, self.rows, self.labels = (table[name].to_numpy() for name in ("vec_id", "row", "label"))
        self.norms = table["norm"].to_numpy()
        self.parts = _matrix(table["parts"], len(table), width)
        angles = _matrix(table["angles"], len(table), None)
        # The cosine of a sum or difference of two angles, from the cosines and sines of each.
        self.cos, self.sin = np.cos(angles), np.sin(angles)


def _matrix(column: pa.ChunkedArray, count: int, width: int | None) -> np.ndarray:
    flat = column.combine_chunks().flatten().to_numpy(zero_copy_only=False)
    return np.ascontiguousarray(flat.reshape(count, -1 if width is None and count else width or 0))


def score_bounds(anchors: Rows, at: int, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
    """Integers that no score of anchor ``at`` falls below or exceeds.

    Angles t and u to one reference put the angle between the two vectors between |t - u|
    and t + u (or its rest to a full turn), so its cosine lies within cos(t + u) and
    cos(t - u); the tightest of all references holds.  What rounding can shift, in the
    stored angles most of all, is added on both sides.
    """
    size = anchors.norms[at] * rows.norms
    low, high = np.full(len(size), -1.0), np.ones(len(size))
    if anchors.cos.shape[1]:
        straight, crossed = rows.cos * anchors.cos[at], rows.sin * anchors.sin[at]
        low = (straight - crossed).max(axis=1)
        high = (straight + crossed).min(axis=1)
    # An arc cosine near its ends turns an error of e into one of sqrt(2e).
    slack = 4.0 * np.sqrt((anchors.parts.shape[1] + 4) * np.finfo(np.float64).eps)
    return (
        np.floor((np.maximum(low, -1.0) - slack) * size - 1.0),
        np.ceil((np.minimum(high, 1.0) + slack) * size + 1.0),
    )


def kth(values: np.ndarray, k: int) -> float:
    """The k-th highest, or less than all where there are fewer."""
    return float(np.partition(values, len(values) - k)[len(values) - k]) if len(values) >= k else -np.inf


def first_rows_of(scores: np.ndarray, places: np.ndarray, k: int) -> np.ndarray:
    """The k highest scores, equal ones by place; places ascend with vec_id."""
    return np.lexsort((places, -scores))[:k]


def _scores(anchors: Rows, at: int, rows: Rows, places: np.ndarray) -> np.ndarray:
    return rows.parts[places] @ anchors.parts[at]


def best_positives(anchors: Rows, rows: Rows, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(anchor, places, scores): the k best rows of its label in this block, but itself."""
    order = np.argsort(rows.labels, kind="stable")
    sorted_labels = rows.labels[order]
    for at in range(len(anchors.ids)):
        a, b = np.searchsorted(sorted_labels, anchors.labels[at], "left"), np.searchsorted(sorted_labels, anchors.labels[at], "right")
        same = order[a:b]
        same = same[rows.rows[same] != anchors.rows[at]]
        if not len(same):
            continue
        low, high = score_bounds(anchors, at, _part(rows, same))
        places = same[high >= kth(low, k)]
        scores = _scores(anchors, at, rows, places)
        top = first_rows_of(scores, places, k)
        yield at, places[top], scores[top]


def best_negatives(
    anchors: Rows, rows: Rows, windows: dict[int, list[int]], k: int, share: tuple[int, int]
) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(anchor, positive score, places, scores): the k best rows of other labels in each window.

    The window of a positive score p holds the scores s with low * p <= high * s <= high * p.
    Only rows whose bounds overlap a window, and may be among its k best, are scored.
    """
    least, whole = share
    for at in range(len(anchors.ids)):
        wanted = [(p, -(-least * p // whole)) for p in windows.get(int(anchors.rows[at]), ()) if -(-least * p // whole) <= p]
        if not wanted:
            continue
        other = np.flatnonzero(rows.labels != anchors.labels[at])
        low, high = score_bounds(anchors, at, _part(rows, other))
        needed = np.zeros(len(other), bool)
        for p, start in wanted:
            inside = (low >= start) & (high <= p)
            needed |= (high >= max(start, kth(low[inside], k))) & (low <= p)
        places = other[needed]
        scores = _scores(anchors, at, rows, places)
        for p, start in wanted:
            fits = np.flatnonzero((scores >= start) & (scores <= p))
            top = fits[first_rows_of(scores[fits], places[fits], k)]
            if len(top):
                yield at, p, places[top], scores[top]


class _part:
    """The norms and angles of some rows of a block."""

    def __init__(self, rows: Rows, places: np.ndarray):
        self.norms, self.cos, self.sin = rows.norms[places], rows.cos[places], rows.sin[places]


POSITIVES = "anchor_row long, anchor_id long, positive_id long, positive_row long, positive_score long"
NEGATIVES = "anchor_row long, positive_score long, negative_id long, negative_score long"


def _search(find: Callable, names: list[str]) -> Callable:
    """One pair of blocks: ``find`` yields rows of ``names`` from the two sides."""

    def search(group: pa.Table) -> pa.Table:
        side = group["is_anchor"].to_numpy()
        found: list[list[np.ndarray]] = [[np.zeros(0, np.int64)] for _ in names]
        if side.any() and not side.all():
            width = group["width"][0].as_py()
            anchors, rows = (Rows(group.filter(pa.array(keep)), width) for keep in (side, ~side))
            scores = group.filter(pa.array(side))
            for columns in find(anchors, rows, scores):
                for values, column in zip(found, columns):
                    values.append(column)
        return pa.table([np.concatenate(values).astype(np.int64) for values in found], names)

    return search


def _positives_of(k: int) -> Callable:
    def find(anchors: Rows, rows: Rows, _: pa.Table) -> Iterator[tuple]:
        for at, places, scores in best_positives(anchors, rows, k):
            same = np.full(len(places), 1, np.int64)
            yield same * anchors.rows[at], same * anchors.ids[at], rows.ids[places], rows.rows[places], scores

    return _search(find, ["anchor_row", "anchor_id", "positive_id", "positive_row", "positive_score"])


def _negatives_of(k: int, share: tuple[int, int]) -> Callable:
    def find(anchors: Rows, rows: Rows, asked: pa.Table) -> Iterator[tuple]:
        windows = dict(zip(asked["row"].to_pylist(), asked["windows"].to_pylist()))
        for at, p, places, scores in best_negatives(anchors, rows, windows, k, share):
            same = np.full(len(places), 1, np.int64)
            yield same * anchors.rows[at], same * p, rows.ids[places], scores

    return _search(find, ["anchor_row", "positive_score", "negative_id", "negative_score"])


def _blocks(anchors: DataFrame, rows: DataFrame, n_anchors: int, n_rows: int) -> DataFrame:
    """Every anchor beside every row, as pairs of blocks of bounded size."""
    n_a, n_r = max(1, -(-n_anchors // ANCHOR_ROWS)), max(1, -(-n_rows // ROWS))
    block = lambda n: F.pmod(F.xxhash64("row"), F.lit(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    names = ["is_anchor", "a", "r", "row", "vec_id", "label", "parts", "width", "norm", "angles", "windows"]
    asking = anchors.withColumns({"is_anchor": F.lit(True), "a": block(n_a)}).withColumn("r", every(n_r))
    answering = rows.withColumns(
        {"is_anchor": F.lit(False), "r": block(n_r), "windows": F.lit(None).cast("array<long>")}
    ).withColumn("a", every(n_a))
    return asking.select(*names).unionByName(answering.select(*names)).groupBy("a", "r", "width")


def _references(rows: DataFrame) -> dict[int, np.ndarray]:
    """Directions for each length among the sample: the rows of least hash, SAMPLE at most."""
    sample = rows.where(F.exists("parts", lambda x: x != 0)).orderBy(F.xxhash64("row"), "row").limit(SAMPLE)
    by_width: dict[int, list] = {}
    for found in sample.select("width", "parts").collect():
        by_width.setdefault(found.width, []).append(found.parts)
    return {width: directions(np.array(parts, np.float64)) for width, parts in by_width.items()}


def mine(
    vectors: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 5,
    share: tuple[int, int] = (80, 100),
    scale: int = 256,
    vector: str = "embedding",
) -> DataFrame:
    """Hard negatives of each anchor's positives.

    ``vectors``: vec_id, label and an array column (others ignored); ``anchors`` selects
    rows.  A score is the inner product of components times ``scale``, floored.  An
    anchor's positives are its ``positives`` best other rows of its label; for each, the
    ``negatives`` best rows of other labels whose score times 100 lies between 80 times
    (``share``) and 100 times the positive's.  Ties go to the smaller vec_id.  Returns
    anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    Null vec_ids, labels and vectors, and vectors with null or non-finite components, take no
    part; only vectors of one length meet; an empty vector scores 0.  Rows that repeat a vec_id
    are rows of their own under that id, anchors too.  Fewer rows where there are fewer
    candidates; none for an empty table.  Scores beyond 63 bits are refused (ValueError).

    Up to SAMPLE rows give REFERENCES directions; the angle of every row to each is
    stored.  Angles of two vectors bound their cosine, times the norms their score; only
    rows whose bounds reach the best positives, or overlap a window, are scored.
    """
    spark = session(vectors.sparkSession)
    given = vectors.select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.col("label").cast("long").alias("label"),
        quantised(vector, scale).alias("parts"),
        F.coalesce(anchors, F.lit(False)).alias("wanted"),
    ).where("vec_id is not null and label is not null and parts is not null")
    plain = store(
        given.select(
            F.monotonically_increasing_id().alias("row"), "vec_id", "label", "parts", "wanted", F.size("parts").alias("width")
        ),
        "mined-vectors",
    )
    count, wanted, width, high, low = plain.agg(
        F.count(F.lit(1)), F.count_if("wanted"), F.max("width"), F.max(F.array_max("parts")), F.min(F.array_min("parts"))
    ).first()
    if max(abs(high or 0), abs(low or 0)) ** 2 * (width or 0) >= 1 << 63:
        raise ValueError("scores of these components do not fit 63 bits")
    rows = store(plain.mapInArrow(_measure(_references(plain)), VECTORS), "mined-angles")
    asked = rows.where("wanted")

    pairs = _blocks(asked.withColumn("windows", F.lit(None).cast("array<long>")), rows, wanted, count)
    found = pairs.applyInArrow(_positives_of(positives), POSITIVES)
    best = Window.partitionBy("anchor_row").orderBy(F.desc("positive_score"), "positive_id", "positive_row")
    chosen = store(found.withColumn("_at", F.row_number().over(best)).where(F.col("_at") <= positives), "positives")

    windows = chosen.groupBy(F.col("anchor_row").alias("row")).agg(F.collect_set("positive_score").alias("windows"))
    pairs = _blocks(asked.join(windows, "row"), rows, wanted, count)
    hard = store(pairs.applyInArrow(_negatives_of(negatives, share), NEGATIVES), "negatives")
    order = Window.partitionBy("anchor_row", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
    ranked = hard.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= negatives)
    return chosen.join(ranked, ["anchor_row", "positive_score"]).select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )
