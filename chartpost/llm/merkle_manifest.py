"""Merkle manifest of a dataset: ranks' digits are grouped away, nesting the nodes below."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from chartpost.llm.tables import broadcast_if_bounded, session, store
from chartpost.operators.skew import CHUNK, in_ordered_chunks

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Nodes per run, and digits (base FANOUT) of a rank that one block groups away: a block
# nests at most FANOUT ** DIGITS nodes in one row.
FANOUT, DIGITS = 8, 3
BLOCK = FANOUT**DIGITS
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3
STEPS = "array<struct<before:string,after:string>>"


def _sha256(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def leaf_of(values: Sequence[Column]) -> Column:
    """Digest of a row: each value as ``-`` if null, else its UTF-8 size, a colon and itself."""
    texts = [value.cast("string") for value in values]
    return _sha256(
        *[
            F.when(text.isNull(), F.lit("-")).otherwise(
                F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
            )
            for text in texts
        ]
    )


def in_rank(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Stored rows with ``rank`` (from 0, by ``order``) within ``group``, and the group's size ``n``.

    Ranges of equal row counts cut through groups, so a group that holds most rows is
    numbered by many tasks; one row per range and group tells where each starts.
    """
    ranged = in_ordered_chunks(rows, ["group"], order)
    place = F.row_number().over(Window.partitionBy(CHUNK, "group").orderBy(*order))
    numbered = store(ranged.withColumn("_place", place), "numbered")
    sizes = numbered.groupBy("group", CHUNK).agg(F.count(F.lit(1)).alias("_size"))
    whole = Window.partitionBy("group")
    before = whole.orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = store(
        sizes.select(
            "group",
            CHUNK,
            F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"),
            F.sum("_size").over(whole).alias("n"),
        ),
        "range-starts",
    )
    joined = numbered.join(broadcast_if_bounded(starts), ["group", CHUNK])
    return joined.withColumn("rank", F.col("_start") + F.col("_place") - 1).drop(CHUNK, "_place", "_start")


def nested(nodes: DataFrame) -> DataFrame:
    """Blocks of ``nodes`` (group, rank, n, hash, item): (group, block, n, hash, kids).

    The digits of a rank are grouped away one after the other, lowest first; each time the
    nodes of a run become one node that holds them in ``kids``.  All groupings share the
    one shuffle by block.  A node of a level above the group's top is its only kid's
    hash: the tree of a group is as high as its own size asks for.
    """
    digits = [f"d{k}" for k in range(DIGITS)]
    rows = nodes.select(
        "group",
        F.floor(F.col("rank") / BLOCK).cast("long").alias("block"),
        "n",
        *[(F.floor(F.col("rank") / FANOUT**k) % FANOUT).cast("int").alias(f"d{k}") for k in range(DIGITS)],
        "hash",
        F.col("item").alias("kids"),
    ).repartition("group", "block")
    for level in range(DIGITS):
        runs = rows.groupBy("group", "block", *digits[level + 1 :]).agg(
            F.first("n").alias("n"), F.array_sort(F.collect_list(F.struct(digits[level], "hash", "kids"))).alias("kids")
        )
        joined = F.sha2(F.array_join("kids.hash", ""), 256)
        rows = runs.withColumn("hash", F.when(F.col("n") > FANOUT**level, joined).otherwise(F.col("kids")[0]["hash"]))
    return rows.select("group", "block", "n", "hash", "kids")


def climb(nodes: DataFrame, label: str) -> tuple[list[DataFrame], DataFrame]:
    """Stored blocks of each tier, lowest first, and the top (group, hash) of each group.

    The blocks of a tier are the nodes of the next, whose trees are the same levels
    further up; tiers grow with the logarithm of the largest group.
    """
    tiers = []
    while True:
        tiers.append(store(nested(nodes), f"{label}-blocks"))
        most = tiers[-1].agg(F.max("block")).first()[0] or 0
        if not most:
            return tiers, tiers[-1].select("group", "hash")
        nodes = tiers[-1].select(
            "group", F.col("block").alias("rank"), F.ceil(F.col("n") / BLOCK).cast("long").alias("n"), "hash",
            F.struct("block").alias("item"),
        )


def _beside(kids: Column, at: Column) -> Column:
    """The hashes before and after place ``at`` of a run."""
    hashes = F.transform(kids, lambda kid: kid["hash"])
    return F.struct(
        F.array_join(F.slice(hashes, F.lit(1), at), "").alias("before"),
        F.array_join(F.slice(hashes, at + 2, F.lit(FANOUT)), "").alias("after"),
    )


def _kids_of(level: int) -> Callable[[Column], Column]:
    """The kids of a node (kids, steps), each with the steps from itself on."""
    real = F.col("n") > FANOUT**level

    def below(node: Column) -> Column:
        def kid_of(kid: Column, at: Column) -> Column:
            mine = F.array(_beside(node["kids"], at))
            steps = F.when(real, F.concat(mine, node["steps"])).otherwise(node["steps"])
            found = [kid["kids"].alias("kids"), steps.alias("steps")]
            if level == 0:
                found.append(kid["hash"].alias("hash"))
            return F.struct(*found)

        return F.transform(node["kids"], kid_of)

    return below


def descend(tiers: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(group, item, hash, steps, top) of each node of the lowest tier.

    ``tops`` has (group, steps, top) of each group.  A step holds the hashes before and
    after a node in its run; steps go from the node to the root.  Blocks meet the steps of
    their own node in one grouping, then transforms go down the nested kids, and the
    nodes are exploded last.
    """
    above = tops.select("group", F.lit(0).cast("long").alias("block"), "steps", "top")
    for tier in reversed(tiers):
        names = [*above.columns, "n", "kids"]
        blocks = tier.select("group", "block", "n", "kids")
        merged = (
            blocks.unionByName(above, allowMissingColumns=True)
            .select(*names)
            .groupBy("group", "block")
            .agg(*[F.first(name, ignorenulls=True).alias(name) for name in names[2:]])
        )
        nodes = F.array(F.struct(F.col("kids"), F.col("steps")))
        for level in reversed(range(DIGITS)):
            nodes = F.flatten(F.transform(nodes, _kids_of(level)))
        found = merged.select("group", "top", F.explode(nodes).alias("node")).select(
            "group", F.col("node.kids").alias("item"), "node.hash", "node.steps", "top"
        )
        above = found.select("group", "item.block", "steps", "top") if tier is not tiers[0] else found
    return above


def folded(start: Column, steps: Column) -> Column:
    """The root that ``start`` and the hashes beside its path give."""
    return F.aggregate(steps, start, lambda node, step: _sha256(step["before"], node, step["after"]))


def proof_digest(steps: Column) -> Column:
    """Digest of all hashes beside a path, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["before"], s["after"])), ""), 256)


def manifest(documents: DataFrame, tampered: Column | None = None) -> DataFrame:
    """Leaf, root and proof of each row of ``documents``, and whether it still verifies.

    ``documents``: FIELDS (other columns ignored).  The rows of a lang, nulls a lang of
    their own, form a tree in order of doc_id (null first; then by leaf, so that
    repeated ids and rows have a set order); the langs' roots, null first, then in
    order of their bytes, form the tree above.  ``tampered`` marks rows whose text
    (A-Z lower-cased, nulls unchanged) is hashed anew and folded with the original
    hashes beside its path; null marks none.  Null fields hash as ``-``, unlike empty ones;
    very long texts are hashed whole; an empty table gives no rows.

    Returns doc_id, leaf, subroot (of the lang), root, proof_sha256, folded_root and
    verified.
    """
    session(documents.sparkSession)
    values = [F.col(name) for name in FIELDS]
    changed = [F.translate("text", UPPER, LOWER) if name == "text" else F.col(name) for name in FIELDS]
    marked = F.lit(False) if tampered is None else F.coalesce(tampered, F.lit(False))
    leaves = store(
        documents.select(
            # Before all others where there is no lang; the rest in order of bytes.
            F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit("")).alias("group"),
            F.col("doc_id").cast("long").alias("doc_id"),
            leaf_of(values).alias("hash"),
            F.when(marked, leaf_of(changed)).alias("changed"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "leaves",
    )
    # The row number only spreads rows that are equal in all of this.
    ranked = in_rank(leaves, ["doc_id", "hash", "row"])
    nodes = ranked.select("group", "rank", "n", "hash", F.struct("doc_id", "changed").alias("item"))
    doc_tiers, subroots = climb(nodes, "document")
    langs = in_rank(
        subroots.select(F.lit("").alias("group"), F.col("group").alias("lang"), F.col("hash")), ["lang"]
    ).select("group", "rank", "n", "hash", F.struct("lang").alias("item"))
    lang_tiers, roots = climb(langs, "lang")
    no_steps = F.array().cast(STEPS)
    subtops = descend(lang_tiers, roots.select("group", no_steps.alias("steps"), F.col("hash").alias("top"))).select(
        F.col("item.lang").alias("group"), "steps", F.struct(F.col("hash").alias("subroot"), F.col("top").alias("root")).alias("top")
    )
    proven = descend(doc_tiers, subtops).select(
        "item.doc_id",
        F.col("hash").alias("leaf"),
        "top.subroot",
        "top.root",
        proof_digest(F.col("steps")).alias("proof_sha256"),
        folded(F.coalesce("item.changed", "hash"), F.col("steps")).alias("folded_root"),
    )
    return proven.withColumn("verified", F.col("folded_root") == F.col("root"))


def every_third() -> Column:
    """Rows whose doc_id's crc32 (of its decimal text) is divisible by TAMPER_EVERY."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
