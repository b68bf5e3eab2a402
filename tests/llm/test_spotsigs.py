"""Spot fingerprints against a plain version, and the search for similar texts against all pairs."""

import hashlib
import itertools
import re

import duckdb
import numpy as np
import pytest

from tallybook.llm import queries, spotsigs
from tallybook.llm.spotsigs import digest, edited, likeness, near_classes, spot_report, spots


def plain_chains(text):
    """(anchor, content words behind it) as a list, repeats included, for text with many anchors."""
    words = re.findall(r"\w+", text.lower())
    chains = [("START", tuple([w for w in words if w not in spotsigs.ANCHORS][:3]))]
    for i, w in enumerate(words):
        if w in spotsigs.ANCHORS:
            chain = [x for x in words[i + 1 :] if x not in spotsigs.ANCHORS][:3]
            if chain:
                chains.append((w, tuple(chain)))
    return chains


def plain_likeness(a, b):
    left, right = plain_chains(a), plain_chains(b)
    shared = sum(min(left.count(c), right.count(c)) for c in set(left))
    return shared / (len(left) + len(right) - shared)


def sentence(n, seed):
    rng = np.random.default_rng(seed)
    content = [f"word{i}" for i in range(40)]
    return " ".join(
        str(rng.choice(["the", "of", "and", "is"]) if rng.random() < 0.5 else rng.choice(content)) for _ in range(n)
    )


@pytest.mark.parametrize("seed", range(20))
def test_likeness_of_plain_chains(seed):
    a = sentence(60 + seed, seed)
    b = edited(a, sentence(50, seed + 100))
    if max(len(run.split()) for run in re.split(r"\b(?:the|of|and|is)\b", a + " the " + b)) > spotsigs.GAP:
        pytest.skip("a stretch without anchors")
    assert likeness(spots(a), spots(b)) == pytest.approx(plain_likeness(a, b))
    assert likeness(spots(a), spots(a)) == 1


def test_spots_of_odd_texts():
    assert len(spots(None)) == len(spots("")) == 0
    assert digest(spots("...")) != digest(spots("!!!"))
    assert digest(spots("the")) != digest(spots("of"))
    assert digest(spots("The Cat  sat")) == digest(spots("the cat, sat!"))
    assert len(spots("the cat " * 5)) > 1
    # without any common word, stand-ins are chosen
    assert len(spots(" ".join(f"xq{i}" for i in range(400)))) > 40
    long = sentence(200_000, 3)
    assert likeness(spots(long), spots(long + " the end")) > 0.99


def test_likeness_bounds():
    a, b = spots(sentence(100, 1)), spots(sentence(100, 2))
    assert likeness(a, b) == likeness(b, a)
    assert likeness(a, a[: len(a) // 2], least=0.8) == 0
    assert likeness(spots(""), spots(None)) == 1
    assert likeness(spots(""), a) == 0


def test_report_over_whole_table(spark, sf_dir):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet' ORDER BY doc_id DESC").fetchall()
    found = {r["doc_id"]: r for r in queries.op11_spotsigs(spark, sf_dir).collect()}
    assert len(found) == len(rows)
    for i, (key, text) in enumerate(rows):
        text, after = text or "", rows[(i + 1) % len(rows)][1] or ""
        third = len(text) // 3
        changed = text[: len(text) - third] + after[:third]
        r = found[key]
        assert r["n_chars"] == len(text)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == digest(spots(text))
        assert r["edited_fingerprint"] == digest(spots(changed))
        assert r["near_edited"] == pytest.approx(likeness(spots(text), spots(changed)))
        assert r["near_next"] == pytest.approx(likeness(spots(text), spots(after)))


def test_report_of_odd_rows(spark):
    schema = "doc_id long, text string, part string, kind int, stored int"
    rows = [
        (1, None, "a", 1, 1),
        (2, "", "b", 1, 1),
        (4, "the cat sat on the mat", "c", 1, 1),
        (4, "the cat sat on the mat", "c", 1, 1),
        (None, "the", "d", 1, 1),
    ]
    found = spot_report(spark.createDataFrame(rows, schema).repartition(3)).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"], r["n_chars"]) for r in found if r["doc_id"]) == [
        (False, 1, 0),
        (False, 2, 0),
        (False, 4, 22),
        (False, 4, 22),
    ]
    # the first of the two equal rows is followed by the second, that one by the empty text
    assert sorted(r["near_next"] for r in found if r["doc_id"] == 4) == [0, 1]
    # the last row, without a key, is followed by the first
    last = [r for r in found if r["doc_id"] is None]
    assert [r["edited_sha256"] for r in last] == [hashlib.sha256(b"tht").hexdigest()]
    empty = spark.createDataFrame([], schema)
    assert spot_report(empty).collect() == []
    assert near_classes(empty).collect() == []
    only = spot_report(spark.createDataFrame(rows[2:3], schema)).collect()
    assert [(r["near_next"], r["doc_id"]) for r in only] == [(1, 4)]


def brute_classes(rows, similarity):
    found = [spots(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if likeness(found[i], found[j]) >= similarity - 1e-9:
            a, b = sorted((root(i), root(j)))
            parent[b] = a
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(key, least.get(root(i), key))
    return sorted((str(key), str(least.get(root(i)))) for i, (key, _) in enumerate(rows))


@pytest.mark.parametrize("similarity, blocks", [(0.8, 4096), (0.4, 3)])
def test_classes_equal_all_pairs(spark, monkeypatch, similarity, blocks):
    """A group of many copies, chains of copies, boilerplate just too different, odd rows."""
    monkeypatch.setattr(spotsigs, "BLOCK", blocks)
    base, other = sentence(300, 1).split(), sentence(200, 2)
    texts = []
    for i in range(30):
        copy = list(base)
        copy[7 * i % 290] = f"new{i}"
        texts.append(" ".join(copy))
    # each differs from the next by a little, the ends by much
    for i in range(12):
        texts.append(" ".join([f"fresh{k}" for k in range(9 * i)] + base[9 * i :]))
    for i in range(12):
        texts.append(f"{other} {sentence(60, 50 + i)}")
    texts += [None, "", "x", "x", "the"]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, "lonely zebra")]
    table = spark.createDataFrame([(k, t, 0, 0) for k, t in rows], "doc_id long, text string, node int, own int")
    found = near_classes(table, similarity).collect()
    assert sorted((str(r[0]), str(r[1])) for r in found) == brute_classes(rows, similarity)
