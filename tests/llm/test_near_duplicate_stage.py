"""The stage keeps one document of each group that fingerprints connect, as the fingerprint query groups them."""

import collections

import duckdb
import numpy as np

from tallybook.llm import simhash


def test_one_document_of_each_component(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    kept = simhash.keep_first_of_groups(docs)
    assert kept.schema == docs.schema and kept.exceptAll(docs).isEmpty()
    groups = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs).collect()}
    assert sorted(r["doc_id"] for r in kept.select("doc_id").collect()) == sorted(set(groups.values()))
    assert len(set(groups.values())) < len(groups)


def test_exact_copies_go_and_clean_documents_stay(spark, sf_dir):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall())
    kept = {r["doc_id"] for r in simhash.keep_first_of_groups(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id").collect()}
    copies = collections.defaultdict(list)
    for key, text in texts.items():
        copies[text].append(key)
    for keys in copies.values():
        assert len(kept & set(keys)) <= 1
    # a document goes only for one that is at most a few bits away along a chain
    bits = {k: simhash.fingerprint(t) for k, t in texts.items()}
    for key in set(texts) - kept:
        assert any((bits[key] ^ bits[k]).bit_count() <= simhash.RADIUS for k in texts if k != key)


def test_odd_rows(spark):
    words = np.random.default_rng(1).choice([f"w{i}" for i in range(500)], 80)
    text = " ".join(words)
    schema = "doc_id long, text string, fp string, `order` int, node int"
    rows = [
        (5, text, "a", 1, 1),
        (3, text, "b", 1, 1),
        (3, text, "b", 1, 1),
        (None, text, "c", 1, 1),
        (9, None, "d", 1, 1),
        (8, "", "e", 1, 1),
        (None, "quite another text", "f", 1, 1),
        (None, "quite another text", "f", 1, 1),
    ]
    table = spark.createDataFrame(rows, schema)
    kept = sorted((r["doc_id"] is None, r["doc_id"], r["fp"]) for r in simhash.keep_first_of_groups(table).collect())
    assert kept == [(False, 3, "b"), (False, 8, "e"), (True, None, "f")]
    none = simhash.keep_first_of_groups(table.limit(0))
    assert none.columns == table.columns and none.count() == 0
