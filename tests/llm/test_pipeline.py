"""The registered queries and the pipeline on the smallest tables."""

import re

import numpy as np
import public_tokenizers
import pytest
from compare import compare, duck

import __spark_entry__ as entry
import corpus_pipeline
from chartpost.llm import catalog, oracle
from chartpost.llm.secret_novelty import Novelty, redacted
from test_simhash import plain_components, plain_fingerprint
from test_tokens import check_sequences, plain_ids
from chartpost.llm.best_fit import Capacity

SF = "/root/testdata/sf0.001"


def test_registered():
    assert {**catalog.QUERIES, "pipeline": corpus_pipeline.run}.items() <= entry.queries().items()
    assert set(oracle.ORACLE) <= set(entry.oracle_sql()) and "pipeline" not in entry.oracle_sql()
    assert [int(re.match(r"op(\d+)_", name)[1]) for name in catalog.QUERIES] == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(oracle.ORACLE))
def test_query_equals_sql(spark, name):
    assert compare(catalog.QUERIES[name](spark, SF), duck(SF), oracle.ORACLE[name]) is None


ROWS = {
    "op2_source_mixing": "documents", "op6_secret_novelty": "documents", "op7_token_files": "documents",
    "op8_language_spans": "documents", "op10_simhash": "documents", "op4_best_fit_packing": "documents",
    "op3_role_repair": "conversations", "op12_merkle_manifest": "documents", "op13_hyperminhash": "documents",
}


@pytest.mark.parametrize("name", sorted(ROWS))
def test_query_covers_its_table(spark, name):
    key = "conv_id" if ROWS[name] == "conversations" else "doc_id"
    out = catalog.QUERIES[name](spark, SF).select(key).distinct().collect()
    table = spark.read.parquet(f"{SF}/{ROWS[name]}.parquet").select(key).distinct().collect()
    assert sorted(out) == sorted(table)


def test_held_out_accuracy(spark):
    labels = {r.doc_id: r.lang for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()}
    out = catalog.QUERIES["op8_language_spans"](spark, "/root/testdata/sf0.01").where("held_out").collect()
    assert np.mean([r.lang_pred == labels[r.doc_id] for r in out]) >= 0.97


def test_pipeline_equals_plain_stages(spark):
    from test_documents import plain_verdicts

    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "source").collect()]
    keep = {d for d, *_, good in plain_verdicts(docs) if good}
    kept = [r for r in docs if r[0] in keep]
    prints = [(d, plain_fingerprint(t)) for d, t, _ in kept]
    unique = [r for r, c in zip(kept, plain_components(prints)) if r[0] == c]
    clean = {d: (redacted(t, Novelty(), "[secret]"), s) for d, t, s in unique}

    rows = [r.asDict() for r in corpus_pipeline.run(spark, SF).collect()]
    copies = {}
    for row in rows:
        copies.setdefault(row["doc_id"], []).append(row)
    # Every document is packed whole, as often as it was drawn.
    assert set(copies) == set(clean)
    for doc_id, pieces in copies.items():
        ids = plain_ids(clean[doc_id][0], corpus_pipeline.END_ID)
        times = sum(p["piece"] == 0 for p in pieces)
        want = sorted([(n, 2048 * n, len(ids[2048 * n : 2048 * (n + 1)])) for n in range(-(-len(ids) // 2048))] * times)
        assert sorted((p["piece"], p["start"], p["length"]) for p in pieces) == want and times in (1, 2)
    check_sequences(rows, Capacity())


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["quality_rules", "near_dedup", "secret_scan", "source_mix", "packing"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert public_tokenizers.path(corpus_pipeline.TOKENIZER)
