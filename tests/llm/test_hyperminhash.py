"""HyperMinHash near copies against every pair compared."""

import random

import numpy as np
import pytest

from chartpost.llm import hyperminhash
from chartpost.llm.hyperminhash import (
    BANDS,
    WordHashes,
    band_keys,
    estimated,
    filled,
    near_duplicates,
    registers,
    shingle_hashes,
)

SCHEMA = "doc_id long, text string, node string, n string, keys string"


def plain_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 2]) for i in range(max(1, len(words) - 1))} if words else set()


def plain(rows):
    sets, root = [plain_set(t) for _, t in rows], list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                root[find(i)] = find(j)
    out = []
    for i, (d, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if find(j) == find(i) and rows[j][0] is not None]
        least = min(ids, default=None) if sets[i] else d
        out.append((d, len(sets[i]), least, d == least))
    return sorted(out, key=repr)


def edited(rng, words, share):
    """The words with a share of them changed, in random places."""
    out = list(words)
    for at in rng.sample(range(len(words)), max(1, round(share * len(words)))):
        out[at] = f"x{rng.randrange(10**6)}"
    return out


def documents():
    """Copies with edits all over (similarities around 0.8), chains of edits, small and odd texts."""
    rng = random.Random(11)
    texts = ["", None, " \t\n", "word", "Word", "word word", "two words", "TWO words", "Éa b", "éa b", "x" * 200_000]
    texts += ["a b c d e", "a b c d e f", "a b c d", "b c d e f g"]
    for group in range(40):
        size = rng.choice([6, 12, 30, 80, 200, 600])
        words = [f"w{rng.randrange(3000)}" for _ in range(size)]
        texts.append(" ".join(words))
        for step in range(4):
            words_now = edited(rng, words, rng.choice([0.02, 0.05, 0.055, 0.06, 0.1]))
            texts.append(" ".join(words_now))
            if group % 3 == 0:
                words = words_now
    rng.shuffle(texts)
    rows = [(1000 - i, t) for i, t in enumerate(texts)]
    return rows + [rows[20], (rows[20][0], "other words under one id"), (None, rows[30][1]), (None, "only here without any id"), (None, "")]


@pytest.mark.parametrize("small", [64, 1])
def test_equals_every_pair_compared(spark, monkeypatch, small):
    monkeypatch.setattr(hyperminhash, "SMALL", small)
    rows = documents()
    table = spark.createDataFrame([(d, t, "clash", "clash", "clash") for d, t in rows], SCHEMA)
    got = sorted((tuple(r) for r in near_duplicates(table).collect()), key=repr)
    assert got == plain(rows)
    assert len({c for _, _, c, _ in got}) < 0.75 * len(rows)


def test_a_large_group_of_edited_copies(spark, monkeypatch):
    """Copies of one text, each edited on its own: many pairs lie just below the similarity."""
    monkeypatch.setattr(hyperminhash, "CHUNK", 50)
    rng = random.Random(3)
    words = [f"w{i}" for i in range(120)]
    rows = [(i, " ".join(edited(rng, words, 0.05))) for i in range(300)]
    table = spark.createDataFrame([(d, t, "", "", "") for d, t in rows], SCHEMA)
    assert sorted((tuple(r) for r in near_duplicates(table).collect()), key=repr) == plain(rows)


def test_a_template_shared_by_unlike_texts(spark):
    """Half of each text is the same in all, so they share many bands and no link."""
    rng = random.Random(8)
    frame = [f"t{i}" for i in range(100)]
    rows = [(i, " ".join(frame + [f"u{rng.randrange(10**6)}" for _ in range(60)])) for i in range(400)]
    table = spark.createDataFrame([(d, t, "", "", "") for d, t in rows], SCHEMA)
    assert near_duplicates(table).where("kept").count() == 400


def test_registers_keep_zeros_and_mantissa_of_the_least_hash():
    tail = 0b0001_1010_0110_11 << 38
    least = (5 << 56) | (tail << 4)
    got = registers(np.array([3 << 56, least, (5 << 56) | (tail << 5), 255 << 56 | 1], np.uint64))
    assert got[5] == 1 + (3 << 10) + 0b1010011011 and got[3] == 1 + (52 << 10) and np.count_nonzero(got) == 3
    assert registers(np.zeros(0, np.uint64)).max() == 0


def sketch_pair(rng, both, each):
    a, b, c = (rng.integers(0, 1 << 63, n, np.uint64) * np.uint64(2) for n in (both, each, each))
    return [np.sort(np.concatenate([a, x])) for x in (b, c)]


def test_estimates_and_bands():
    rng = np.random.default_rng(5)
    for both, each in ((800, 100), (80, 10), (8, 1), (0, 500), (4000, 8000)):
        want, shared, found = both / (both + 2 * each), 0, []
        for _ in range(200):
            one, other = sketch_pair(rng, both, each)
            a, b = registers(one), registers(other)
            found.append(estimated(a[None], b[None], np.array([both + each]))[0][0])
            keys = band_keys(np.stack([filled(a), filled(b)]))
            assert keys.shape == (2, BANDS)
            shared += bool((keys[0] == keys[1]).any())
        assert abs(np.mean(found) - want) < 0.02
        assert shared == 200 if want >= 0.8 else shared <= 200
    assert filled(np.zeros(256, np.uint16)).max() == 0


def test_chance_agreements_are_taken_out():
    """Sets without a common hash: registers agree by chance, estimates average zero."""
    rng = np.random.default_rng(6)
    sizes, raw, corrected = np.array([3000]), [], []
    for _ in range(3000):
        a, b = (registers(x) for x in sketch_pair(rng, 0, 3000))
        raw.append((a == b).mean())
        corrected.append(estimated(a[None], b[None], sizes)[0][0])
    assert np.mean(raw) > 1e-4 and abs(np.mean(corrected)) < np.mean(raw) / 4


def test_shingles():
    known = WordHashes()
    assert len(shingle_hashes("a b a b a", known)) == 2
    assert list(shingle_hashes("A", known)) == list(shingle_hashes("a", known))
    assert set(shingle_hashes("a b", known)).isdisjoint(shingle_hashes("b a", known))
    assert not len(shingle_hashes(None, known))


def test_empty_table(spark):
    assert near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
