"""Token ids, packing and token files."""

import random
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from chartpost.llm import tokens
from chartpost.llm.best_fit import Capacity, best_fit, pack, pack_documents
from chartpost.llm.token_files import decode_ranks, encode_ranks, read_blocks, token_table, write_token_files

PATH = public_tokenizers.path("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
SCHEMA = "doc_id long, text string, length string, sequence_id string"


def plain_ids(text, end_id):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, end_id]


def odd_texts(count, seed=1):
    rng = random.Random(seed)
    signs = "aAbBzZ éÉèñßẞÅKİſΣςσ'.,!?_-<|>09٣中あ한 \n\t\r\x0b\x1c\x85\xa0́̈‍﻿\U0001f600²½ª"
    bits = ["<|endoftext|>", "it's", "don't", "'ll", "***", " "]
    return [
        "".join(rng.choice(signs) if rng.random() < 0.8 else rng.choice(bits) for _ in range(rng.randint(0, 14)))
        for _ in range(count)
    ]


def test_ids_equal_the_tokenizer():
    texts = [*odd_texts(4000), None, "", "word " * 3000, "x" * 20000]
    ids, offsets = tokens.token_ids(PATH).encode(pa.array(texts))
    for at, text in enumerate(texts):
        assert ids[offsets[at] : offsets[at + 1]].tolist() == plain_ids(text, 0)[:-1], repr(text)


def test_slices_and_ends():
    texts = ["aa", None, "b" * 50, "", "c", "dd", "eeeeeeeee"]
    rows = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], ["doc_id", "text"])
    for batches in ([rows], [rows.slice(i, 1) for i in range(7)], [rows.slice(0, 0), rows.slice(0, 4), rows.slice(4)]):
        assert [(keys.to_pylist(), part.to_pylist()) for keys, part in tokens.slices(batches, 10)] == [
            ([0, 1], ["aa", None]), ([2], ["b" * 50]), ([3, 4, 5], ["", "c", "dd"]), ([6], ["eeeeeeeee"]),
        ]
    ids, offsets = tokens.with_end(np.array([5, 6, 7]), np.array([0, 2, 2, 3]), 9)
    assert ids.tolist() == [5, 6, 9, 9, 7, 9] and offsets.tolist() == [0, 3, 4, 6]


def rows_of(frame):
    return [r.asDict() for r in frame.collect()]


DOCS = [
    (1, "short text"), (2, ""), (3, None), (4, "many words here. " * 2000), (None, "no id"), (5, "same"), (5, "same"),
    (6, "tie"), (7, "tie"), (8, " ".join(odd_texts(50))), (9, "\n \n"),
]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame([(d, t, "clash", "clash") for d, t in DOCS], SCHEMA)


def check_sequences(rows, capacity):
    bins = {}
    for row in rows:
        bins.setdefault(row["sequence_id"], []).append((row["offset"], row["length"]))
    for held in bins.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= capacity.tokens and len(held) <= capacity.documents
        assert sum(n * n for _, n in held) <= capacity.attention
    return len(bins)


def test_packed_documents(table):
    rows = rows_of(pack_documents(table, PATH))
    want = []
    for doc_id, text in DOCS:
        ids = plain_ids(text, 0)
        for piece, start in enumerate(range(0, len(ids), 2048)):
            part = ids[start : start + 2048]
            want.append((doc_id, piece, start, len(part), crc32(np.array(part, "<u4").tobytes())))
    got = [(r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    total = sum(r["length"] for r in rows)
    assert check_sequences(rows, Capacity()) == -(-total // 2048)


@pytest.mark.parametrize("rule", ["norm", "dot"])
@pytest.mark.parametrize("capacity", [Capacity(100, 3, 10**6), Capacity(100, 50, 4000), Capacity(64, 64, 4096)])
def test_every_constraint_holds(spark, rule, capacity):
    rng = random.Random(2)
    lengths = [min(rng.randint(1, 64), int(capacity.attention**0.5)) for _ in range(500)]
    pieces = spark.createDataFrame([(i, 0, 0, n, i) for i, n in enumerate(lengths)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    rows = rows_of(pack(pieces, capacity, rule, (1.0, 0.3, 0.3)))
    assert sorted((r["doc_id"], r["length"]) for r in rows) == list(enumerate(lengths))
    bins = check_sequences(rows, capacity)
    floor = max(sum(lengths) / capacity.tokens, len(lengths) / capacity.documents, sum(n * n for n in lengths) / capacity.attention)
    assert bins <= 1.35 * floor + 1


def test_best_fit_takes_the_tightest():
    sequence, offset = best_fit(np.array([70, 60, 40, 30]), Capacity(100, 10, 10**6), "norm", (1.0, 0.0, 0.0))
    assert sequence.tolist() == [0, 1, 1, 0] and offset.tolist() == [0, 0, 60, 70]


def test_too_long_piece_is_refused(spark):
    pieces = spark.createDataFrame([(1, 0, 0, 11, 0)], "doc_id long, piece int, start long, length long, ids_crc32 long")
    with pytest.raises(ValueError, match="does not fit"):
        pack(pieces, Capacity(10, 10, 1000))


def test_code_round_trip():
    rng = np.random.default_rng(4)
    for size in (0, 1, 3, 4, 1000):
        ranks = (2.0 ** rng.uniform(0, 32, size)).astype(np.uint32)
        control, data = encode_ranks(ranks)
        assert len(control) == -(-size // 4)
        assert decode_ranks(control, data, size).tolist() == ranks.tolist()


def test_files_give_back_every_id(spark, table, tmp_path):
    folder = str(tmp_path / "files")
    manifest = rows_of(write_token_files(table, PATH, folder, 2))
    found, order = [], []
    vocabulary = np.frombuffer((tmp_path / "files" / "vocabulary.u32").read_bytes(), "<u4")
    for row in sorted(manifest, key=lambda r: r["bucket"]):
        for doc_ids, lengths, kind, control, data in read_blocks(folder, row["path"]):
            assert kind == b"TKV1"
            ids = vocabulary[decode_ranks(control, data, int(lengths.sum()))]
            for doc_id, part in zip(doc_ids, np.split(ids, np.cumsum(lengths)[:-1])):
                order.append(doc_id)
                found.append((doc_id, tuple(part.tolist())))
    want = [(d, tuple(plain_ids(t, 2))) for d, t in DOCS]
    assert sorted(found, key=repr) == sorted(want, key=repr)
    assert order == sorted(order, key=lambda d: (d is not None, d or 0))
    counts = np.bincount(np.concatenate([ids for _, ids in want]).astype(int))
    ranked = sorted(np.flatnonzero(counts), key=lambda i: (-counts[i], i))
    assert vocabulary.tolist() == [int(i) for i in ranked]


def test_table_read_back(table):
    rows = rows_of(token_table(table, PATH, 2, with_ids=True))
    by_start = sorted(rows, key=lambda r: r["start"])
    assert [r["doc_id"] for r in by_start] == sorted((d for d, _ in DOCS), key=lambda d: (d is not None, d or 0))
    at = 0
    for row in by_start:
        assert row["start"] == at and row["n_tokens"] * 4 == len(row["ids"])
        assert row["ids_crc32"] == crc32(row["ids"])
        at += row["n_tokens"]
    want = sorted(((d, np.array(plain_ids(t, 2), "<u4").tobytes()) for d, t in DOCS), key=repr)
    assert sorted(((r["doc_id"], bytes(r["ids"])) for r in rows), key=repr) == want


def test_one_id_fills_many_ranges(spark):
    rows = [(7, f"text {i}") for i in range(400)] + [(1, "first"), (9, "last")]
    got = sorted(rows_of(token_table(spark.createDataFrame(rows, "doc_id long, text string"), PATH, 2)), key=lambda r: r["start"])
    assert [r["doc_id"] for r in got] == sorted(d for d, _ in rows)


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert pack_documents(empty, PATH).count() == 0
    assert token_table(empty, PATH, 2).count() == 0
