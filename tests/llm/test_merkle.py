"""The manifest against a tree built in plain Python."""

from hashlib import sha256
from zlib import crc32

import pytest

from chartpost.llm import merkle_manifest
from chartpost.llm.merkle_manifest import every_third, manifest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, hash string, `group` string, steps string"


def digest(text):
    return sha256(text.encode()).hexdigest()


def leaf(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def tree(nodes):
    """Root, and for each node the hashes before and after it on the way there."""
    steps, level = [[] for _ in nodes], [(h, [i]) for i, h in enumerate(nodes)]
    while len(level) > 1:
        above = []
        for at in range(0, len(level), 8):
            run = level[at : at + 8]
            for k, (_, members) in enumerate(run):
                for i in members:
                    steps[i].append(("".join(h for h, _ in run[:k]), "".join(h for h, _ in run[k + 1 :])))
            above.append((digest("".join(h for h, _ in run)), [i for _, members in run for i in members]))
        level = above
    return level[0][0], steps


def plain(rows):
    """``rows``: (doc_id, source, lang, n_chars, text)."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    members = [sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs]
    trees = [tree([leaf(r) for r in group]) for group in members]
    root, above = tree([subroot for subroot, _ in trees])
    out = []
    for group, (subroot, steps), top in zip(members, trees, above):
        for row, own in zip(group, steps):
            now = leaf(row)
            if row[0] is not None and crc32(str(row[0]).encode()) % 3 == 0 and row[4] is not None:
                now = leaf((*row[:4], "".join(c.lower() if "A" <= c <= "Z" else c for c in row[4])))
            for before, after in own + top:
                now = digest(before + now + after)
            out.append((row[0], leaf(row), subroot, root, digest("".join(b + a for b, a in own + top)), now, now == root))
    return sorted(out, key=repr)


def table(spark, rows):
    given = [(d, t, lang, s, n, "clash", "clash", "clash") for d, s, lang, n, t in rows]
    return spark.createDataFrame(given, SCHEMA)


def documents(sizes):
    rows = []
    for k, (lang, size) in enumerate(sizes.items()):
        for i in range(size):
            at = 3 * i + k
            rows.append((at, f"s{i % 5}" if i % 7 else None, lang, None if i % 11 == 0 else i, f"Text Ä {lang} É {at}" if i % 13 else None))
    return rows


@pytest.mark.parametrize("digits", [1, 3])
def test_equals_a_plain_tree(spark, monkeypatch, digits):
    monkeypatch.setattr(merkle_manifest, "DIGITS", digits)
    monkeypatch.setattr(merkle_manifest, "BLOCK", 8**digits)
    # One lang holds most rows; others one, a whole run, one more, and two full levels.
    rows = documents({"en": 700, "de": 1, None: 8, "": 9, "ß": 64, "zh": 65, "É": 3} | {f"x{k}": 1 for k in range(9)})
    # A long text, empty ones, repeated ids and rows, ids that are null.
    rows += [(5, None, "en", 1, "A" * 300_000), (5, None, "en", 1, ""), (5, None, "en", 1, ""), (5, None, "en", 1, "X")]
    rows += [(None, None, None, None, None), (None, None, None, None, None), (None, "s", "de", 2, "Ab")]
    got = sorted((tuple(r) for r in manifest(table(spark, rows), every_third()).collect()), key=repr)
    assert got == plain(rows)
    changed = {r[0] for r in rows if r[0] is not None and crc32(str(r[0]).encode()) % 3 == 0 and r[4] not in (None, "")}
    assert {r[0] for r in got if not r[6]} == changed


def test_all_verify_without_tampering(spark):
    rows = documents({"en": 30, "de": 3})
    assert manifest(table(spark, rows)).where("verified").count() == len(rows)


def test_one_and_no_document(spark):
    only = manifest(table(spark, [(1, "s", "en", 2, "Ab")])).first()
    assert only.leaf == only.subroot == only.root == only.folded_root and only.proof_sha256 == digest("")
    assert manifest(table(spark, []), every_third()).count() == 0


def test_equal_rows_by_the_hundred_stand_side_by_side(spark):
    rows = [(1, "s", "en", 2, "same")] * 600 + [(0, "s", "en", 2, "first"), (2, "s", "en", 2, "last")]
    got = sorted((tuple(r) for r in manifest(table(spark, rows), every_third()).collect()), key=repr)
    assert got == plain(rows)
