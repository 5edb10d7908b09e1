"""MinHash near-dedup on HyperMinHash sketches: compressed registers, banded, estimated, then verified."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chartpost.llm.components import connected_components
from chartpost.llm.tables import broadcast_if_bounded, session, shuffles_freed, store

SEED = 42
SHINGLE_WORDS = 2
# Similarity (Jaccard) from which two documents are linked, in hundredths.
SIMILAR = 80
# Leading bits of a hash that choose its bucket; bits of it below them that are looked
# at; mantissa bits kept of a bucket's least hash after its leading zeros and first one.
BUCKET_BITS, TAIL_BITS, MANTISSA = 8, 52, 10
BUCKETS = 1 << BUCKET_BITS
# At a similarity of 0.8 a pair shares no band in (1 - 0.8**6)**42, three cases in a million.
BANDS, ROWS = 42, 6
# Standard errors below SIMILAR at which an estimate still sends a pair to verification.
ERRORS = 5.0
# Buckets of more members are compared in blocks of so many, with their registers at hand;
# whole sets are compared in blocks of no more members, and about so many hashes.
SMALL, CHUNK, BLOCK_HASHES = 64, 1024, 1 << 20
KNOWN_WORDS = 200_000

_RNG = np.random.default_rng(SEED)
_ODD = _RNG.integers(0, 1 << 63, ROWS + 3, np.uint64) * np.uint64(2) + np.uint64(1)
_BAND = _RNG.integers(0, 1 << 63, BANDS, np.uint64)
# For each bucket an order of all buckets: an empty one takes the first that is not.
_DETOURS = np.argsort(_RNG.random((BUCKETS, BUCKETS)), axis=1).astype(np.uint8)

SKETCH = "doc_id long, node long, n long, hashes binary, registers binary, keys array<long>"


def mixed(x: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit number over all its bits."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class WordHashes(dict):
    """Word -> 64-bit hash; emptied when full."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KNOWN_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word, SEED)
        return found


def shingle_hashes(text: str | None, known: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of the two-word shingles; one word is a shingle, no word is none."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    if len(each) < SHINGLE_WORDS:
        return mixed(each * _ODD[-1])
    found = np.sort(mixed(each[:-1] * _ODD[-2] + each[1:] * _ODD[-3]))
    return found[np.concatenate([[True], found[1:] != found[:-1]])]


def registers(hashes: np.ndarray) -> np.ndarray:
    """Per bucket its least hash as leading zeros and mantissa in 16 bits; 0 for an empty bucket."""
    out = np.zeros(BUCKETS, np.uint16)
    bucket = (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    first = np.flatnonzero(np.diff(bucket, prepend=-1))
    tail = (hashes[first] << np.uint64(BUCKET_BITS)) >> np.uint64(64 - TAIL_BITS)
    zeros = TAIL_BITS - np.frexp(tail.astype(np.float64))[1]
    shifted = (tail << (zeros + 1).astype(np.uint64)) & np.uint64((1 << TAIL_BITS) - 1)
    mantissa = (shifted >> np.uint64(TAIL_BITS - MANTISSA)).astype(np.int64)
    out[bucket[first]] = 1 + (zeros.astype(np.int64) << MANTISSA) + mantissa
    return out


def filled(found: np.ndarray) -> np.ndarray:
    """Registers whose empty buckets hold what the first bucket of their detour holds.

    Small sets leave most buckets empty.  Filled this way any register of two sets agrees
    about as often as their similarity says, so bands of small sets tell as much as others.
    """
    there = np.flatnonzero(found)
    empty = np.flatnonzero(found == 0)
    if not len(there) or not len(empty):
        return found
    place = np.empty(BUCKETS, np.int64)
    # Where each bucket stands in a detour is the detour's inverse; fixed, so built once.
    steps = _steps()[empty][:, there]
    place[empty] = there[np.argmin(steps, axis=1)]
    out = found.copy()
    out[empty] = found[place[empty]]
    return out


@lru_cache(maxsize=1)
def _steps() -> np.ndarray:
    return np.argsort(_DETOURS, axis=1).astype(np.uint8)


def band_keys(dense: np.ndarray) -> np.ndarray:
    """(sets, BANDS) keys of filled registers (sets, BUCKETS)."""
    parts = dense[:, : BANDS * ROWS].astype(np.uint64).reshape(len(dense), BANDS, ROWS)
    return mixed((parts * _ODD[:ROWS]).sum(axis=2, dtype=np.uint64) + _BAND).astype(np.int64)


@lru_cache(maxsize=1)
def _collision_table() -> np.ndarray:
    """For two unlike sets of 2 ** (k / 2) hashes each: how often registers of a bucket agree by chance.

    A register says that the least hash lies in one interval; the chance that both do, over
    all intervals, by the chance that the bucket is used at all.
    """
    zeros = np.arange(TAIL_BITS)[:, None]
    edges = 2.0 ** -(zeros + 1) * (1 + np.arange(1 << MANTISSA) / (1 << MANTISSA))
    width = 2.0 ** -(zeros + 1) / (1 << MANTISSA)
    table = []
    for k in range(64):
        n = 2.0 ** (k / 2)
        above = lambda b: np.exp(n * np.log1p(-b / BUCKETS))  # noqa: B023, E731
        both = ((above(edges) - above(edges + width)) ** 2).sum()
        table.append(both / (1 - np.exp(2 * n * np.log1p(-1 / BUCKETS))))
    return np.array(table)


def estimated(one: np.ndarray, others: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Similarity of paired registers, chance agreements taken out, and the buckets it rests on.

    ``sizes``: the geometric mean of each pair's set sizes.
    """
    used = ((one != 0) | (others != 0)).sum(axis=1)
    agree = ((one == others) & (others != 0)).sum(axis=1)
    chance = np.interp(2 * np.log2(np.maximum(sizes, 1)), np.arange(64), _collision_table())
    return (agree / np.maximum(used, 1) - chance) / (1 - chance), used


def may_be_similar(one: np.ndarray, others: np.ndarray, n_one: np.ndarray, n_others: np.ndarray) -> np.ndarray:
    """Pairs that go to verification: sizes allow SIMILAR, and the estimate is near it or above.

    Buckets draw hashes of the union without putting any back, so an estimate that rests
    on most of them errs less.
    """
    similarity, used = estimated(one, others, np.sqrt(n_one * n_others.astype(np.float64)))
    goal = SIMILAR / 100
    union = (n_one + n_others) / (1 + goal)
    spread = goal * (1 - goal) / np.maximum(used, 1) * np.maximum(1 - used / union, 0.1)
    near = similarity >= goal - ERRORS * np.sqrt(spread)
    return near & (100 * np.minimum(n_one, n_others) >= SIMILAR * np.maximum(n_one, n_others))


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known = WordHashes()
    for batch in batches:
        sets = [shingle_hashes(text.as_py(), known) for text in batch.column(1)]
        raw = [found.tobytes() for found in sets]
        found = np.array([registers(s) for s in sets], np.uint16).reshape(-1, BUCKETS)
        keys = band_keys(np.array([filled(row) for row in found], np.uint16).reshape(-1, BUCKETS))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(0).cast(pa.int64()),
                pa.array(np.array([xxhash.xxh64_intdigest(r, SEED) for r in raw], np.uint64).astype(np.int64)),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array(raw, pa.binary()),
                pa.array([row.tobytes() for row in found], pa.binary()),
                pa.ListArray.from_arrays(np.arange(0, keys.size + 1, BANDS, dtype=np.int32), keys.ravel()),
            ],
            ["doc_id", "node", "n", "hashes", "registers", "keys"],
        )


def sketches(documents: DataFrame) -> DataFrame:
    """(doc_id, node, n, hashes, registers, keys) per document; equal sets have one node."""
    rows = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return rows.mapInArrow(_sketch, SKETCH)


def _registers_of(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, BUCKETS)


def _likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        one, other = (_registers_of(batch.column(at)) for at in (4, 5))
        good = may_be_similar(one, other, batch.column(2).to_numpy(), batch.column(3).to_numpy())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good))


def similar(one: np.ndarray, other: np.ndarray) -> bool:
    """Whether two whole sets (sorted) share enough of what they hold together."""
    many, few = (one, other) if len(one) >= len(other) else (other, one)
    at = np.searchsorted(many, few)
    both = int((many[np.minimum(at, len(many) - 1)] == few).sum())
    return 100 * both >= SIMILAR * (len(many) + len(few) - both)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        good = [
            similar(*(np.frombuffer(x.as_py(), np.uint64) for x in pair)) for pair in zip(batch.column(2), batch.column(3))
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(good, pa.bool_()))


def _likely_pairs(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The pairs (a, b) whose registers say that they may be similar."""

    def side(name: str) -> DataFrame:
        return nodes.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("registers").alias(f"r{name}"))

    held = pairs.join(side("b"), "b").join(side("a"), "a").select("a", "b", "na", "nb", "ra", "rb")
    return held.mapInArrow(_likely, "a long, b long")


def _sets(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, hashes) of each of the ``wanted`` nodes, which are stored."""
    held = rows.select("node", "hashes").join(broadcast_if_bounded(wanted), "node", "left_semi")
    return store(held.groupBy("node").agg(F.first("hashes").alias("hashes")), "sets")


def _links(pairs: DataFrame, rows: DataFrame) -> DataFrame:
    """The stored pairs (a, b) whose whole sets are similar."""
    sets = _sets(rows, store(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), "needed-sets"))
    one = sets.select(F.col("node").alias("a"), F.col("hashes").alias("one"))
    other = sets.select(F.col("node").alias("b"), F.col("hashes").alias("other"))
    held = pairs.join(other, "b").join(one, "a").select("a", "b", "one", "other")
    return store(held.mapInArrow(_verified, "a long, b long"), "similar")


def _ordered(a: str | Column, b: str | Column) -> list[Column]:
    return [F.least(a, b).alias("a"), F.greatest(a, b).alias("b")]


def _cross(group: pa.Table) -> pa.Table:
    """Pairs that connect what is likely similar between outsiders and members of one block.

    Only rows in different components are compared.  Of the likely pairs those are
    handed on that connect something not connected by others, one a row at most.
    """
    outside = group["outsider"].to_numpy(zero_copy_only=False)
    sides = []
    for keep in (outside, ~outside):
        rows = group.filter(pa.array(keep))
        found = _registers_of(rows["registers"].combine_chunks())
        sides.append((rows["node"].to_numpy(), rows["n"].to_numpy(), rows["root"].to_numpy(), found))
    (node, n, root, found), (nodes, ns, roots, others) = sides
    label = np.arange(len(node) + len(nodes))
    pairs = [np.zeros((0, 2), np.int64)]
    for at in range(len(node)):
        there = np.flatnonzero(roots != root[at])
        good = there[may_be_similar(found[at : at + 1], others[there], n[at : at + 1], ns[there])]
        labels, first = np.unique(label[len(node) + good], return_index=True)
        fresh = labels != label[at]
        to = nodes[good[first[fresh]]]
        pairs.append(np.stack([np.full(len(to), node[at]), to], axis=1))
        label[np.isin(label, labels[fresh])] = label[at]
    both = np.sort(np.concatenate(pairs), axis=1)
    return pa.table([both[:, 0], both[:, 1]], ["a", "b"])


def _compare(group: pa.Table) -> pa.Table:
    """Links between two blocks of a cluster, or within one: likely pairs, verified on whole sets."""
    left, right = (group.filter(pa.array(group[side].to_numpy(zero_copy_only=False))) for side in ("left", "right"))
    node, n, root = (left[name].to_numpy() for name in ("node", "n", "root"))
    nodes, ns, roots = (right[name].to_numpy() for name in ("node", "n", "root"))
    found, others = (_registers_of(side["registers"].combine_chunks()) for side in (left, right))
    sets, other_sets = ([np.frombuffer(x, np.uint64) for x in side["hashes"].to_pylist()] for side in (left, right))
    pairs = []
    for at in range(len(node)):
        there = np.flatnonzero((roots != root[at]) & (nodes != node[at]))
        good = there[may_be_similar(found[at : at + 1], others[there], n[at : at + 1], ns[there])]
        pairs += [(node[at], nodes[k]) for k in good if similar(sets[at], other_sets[k])]
    both = np.sort(np.array(pairs, np.int64).reshape(-1, 2), axis=1)
    return pa.table([both[:, 0], both[:, 1]], ["a", "b"])


def _cluster_links(likely: DataFrame, placed: DataFrame, nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Links between nodes in different components (``placed``: node, root) that ``likely`` pairs connect.

    What likely pairs connect is a cluster.  Its nodes are dealt into blocks of bounded
    size, and each pair of blocks is a group that holds every set once, however many
    pairs it compares.
    """
    clusters = store(connected_components(likely).withColumnRenamed("root", "cluster"), "clusters")
    sets = _sets(rows, clusters.select("node"))
    held = clusters.join(nodes.select("node", "n", "registers"), "node").join(placed, "node")
    sizes = clusters.join(nodes.select("node", "n"), "node").groupBy("cluster").agg(
        F.ceil(F.greatest(F.sum("n") / BLOCK_HASHES, F.count(F.lit(1)) / CHUNK)).cast("int").alias("blocks")
    )
    dealt = held.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    paired = dealt.join(sets, "node").withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    i, j = F.least("block", "other"), F.greatest("block", "other")
    sided = paired.select(
        "cluster", i.alias("i"), j.alias("j"), "node", "n", "root", "registers", "hashes",
        (F.col("block") == i).alias("left"), (F.col("block") == j).alias("right"),
    )
    return store(sided.groupBy("cluster", "i", "j").applyInArrow(_compare, "a long, b long").distinct(), "similar")


def _block_pairs(open_: DataFrame, nodes: DataFrame) -> DataFrame:
    """Pairs that connect what is likely similar in large buckets: outsiders beside all members.

    Both sides are dealt into blocks of about CHUNK by hash, and each pair of blocks is a
    group, so a bucket that holds most rows is many bounded groups, and none is cut.
    """
    counts = open_.groupBy("key").agg(
        F.ceil(F.count(F.lit(1)) / CHUNK).cast("int").alias("n_all"),
        F.ceil(F.count_if("outsider") / CHUNK).cast("int").alias("n_out"),
    )
    held = open_.join(counts, "key")
    block = lambda n: F.pmod(F.xxhash64("node"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    columns = ["key", "i", "j", "node", "root", "outsider"]
    asking = held.where("outsider").withColumn("i", block("n_out")).withColumn("j", every("n_all")).select(*columns)
    answering = (
        held.withColumn("outsider", F.lit(False)).withColumn("j", block("n_all")).withColumn("i", every("n_out")).select(*columns)
    )
    beside = asking.unionByName(answering).join(nodes.select("node", "n", "registers"), "node")
    return beside.groupBy("key", "i", "j").applyInArrow(_cross, "a long, b long").distinct()


def similar_links(nodes: DataFrame, rows: DataFrame) -> DataFrame:
    """Links (a, b) that connect all nodes of similar sets which share a band.

    Each node is first compared with the leader that it shares most buckets with.  A
    bucket's leader is its member with most neighbours: in a group of near copies, the text
    they were made from.  What then still lies in different components of a bucket is
    compared pair by pair, by registers and, where those say so, by whole sets.  So a
    large group of near copies costs one comparison a member, and no pair of a bucket
    is left out unless links already connect it.
    """
    entries = store(nodes.select("node", F.explode("keys").alias("key")), "band-entries")
    shared = entries.groupBy("key").agg(F.count(F.lit(1)).alias("members")).where("members > 1")
    members = store(entries.join(shared, "key"), "band-members")
    central = members.groupBy("node").agg(F.sum("members").alias("central"))
    leaders = members.join(central, "node").groupBy("key").agg(F.max_by("node", F.struct("central", "node")).alias("leader"))
    pairs = _with_leaders(members.join(leaders, "key"))
    links = _links(store(_likely_pairs(pairs, nodes), "likely"), rows)

    roots = store(connected_components(links), "similar-roots")
    placed = members.join(roots, "node", "left").select("key", "node", "members", F.coalesce("root", "node").alias("root"))
    placed = store(placed, "band-places")
    sizes = placed.groupBy("key", "root").agg(F.count(F.lit(1)).alias("size"))
    main = sizes.groupBy("key").agg(F.max(F.struct("size", "root")).alias("main"), F.count(F.lit(1)).alias("n_roots"))
    # Buckets that lie in one component are done with.
    main = main.where("n_roots > 1").select("key", F.col("main.root").alias("main"))
    open_ = store(placed.join(main, "key").withColumn("outsider", F.col("root") != F.col("main")), "open-buckets")
    small = open_.where(F.col("members") <= SMALL)
    left = small.where("outsider").select("key", F.col("node").alias("x"), F.col("root").alias("rx"))
    right = small.select("key", F.col("node").alias("y"), F.col("root").alias("ry"))
    pairs = left.join(right, "key").where("rx <> ry").select(*_ordered("x", "y")).distinct()
    blocks = _block_pairs(open_.where(F.col("members") > SMALL), nodes)
    likely = store(_likely_pairs(pairs, nodes).unionByName(blocks), "likely")
    return links.unionByName(_cluster_links(likely, open_.select("node", "root").distinct(), nodes, rows))


def _with_leaders(members: DataFrame) -> DataFrame:
    """One pair (a, b) per node: with the leader of most of its buckets, the least of equals."""
    met = members.where("node <> leader").groupBy("node", "leader").agg((-F.count(F.lit(1))).alias("fewest"))
    best = met.groupBy("node").agg(F.min(F.struct("fewest", "leader")).alias("best"))
    return best.select(*_ordered("node", "best.leader")).distinct()


def near_duplicates(documents: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) per row of ``documents`` (doc_id, text; others ignored).

    Two documents are linked when their sets of distinct two-word shingles (A-Z
    lower-cased; a single word is one shingle) share SIMILAR hundredths or more of
    what they hold together, confirmed on the whole sets.  component_id is the smallest doc_id
    reachable over links, itself included; kept says that it is the document's own.

    Equal sets are one node, so copies add no pairs.  Null, empty and wordless texts have
    no shingles and are linked with nothing: each is its own component.  Very long texts
    are taken whole.  Rows that repeat a doc_id are documents of their own under that id;
    a null doc_id never names a component unless all its members have none.  An empty
    table gives no rows.
    """
    spark = session(documents.sparkSession)
    rows = store(sketches(documents), "sketches")
    with shuffles_freed(spark):
        nodes = store(
            rows.where("n > 0").groupBy("node").agg(
                F.min("doc_id").alias("first_id"), *[F.first(name).alias(name) for name in ("n", "registers", "keys")]
            ),
            "sketch-nodes",
        )
        roots = store(connected_components(similar_links(nodes, rows)), "near-roots")
    joined = nodes.select("node", "first_id").join(roots, "node", "left").select(
        "node", "first_id", F.coalesce("root", "node").alias("root")
    )
    least = joined.groupBy("root").agg(F.min("first_id").alias("component_id"))
    named = store(joined.join(least, "root").select("node", "component_id"), "near-components")
    given = rows.select("doc_id", "node", F.col("n").alias("n_shingles"))
    component = F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id"))
    return given.join(named, "node", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept")
    )
