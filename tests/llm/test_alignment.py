"""Groups, links and counts against plain versions with the libraries themselves."""

import collections
import hashlib

import duckdb
import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tallybook.llm import queries
from tallybook.llm.alignment import (
    align,
    alignment_report,
    byte_level_side,
    pair_bound,
    Sides,
    sentence_side,
    shared_ends,
)

LEFT, RIGHT = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def sides():
    return Sides(byte_level_side(LEFT), sentence_side(RIGHT))


@pytest.fixture(scope="module")
def libraries():
    left = Tokenizer.from_file(LEFT)
    left.encode_special_tokens = True
    return left, sentencepiece.SentencePieceProcessor(model_file=RIGHT)


def plain(text, libraries):
    """[(ids of A, ids of B)] of each group."""
    left, right = libraries
    if not text:
        return []
    # fixed values: the byte-level alphabet
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    byte_of = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}
    a = [(i, bytes(byte_of[c] for c in left.id_to_token(i))) for i in left.encode(" " + text, add_special_tokens=False).ids]
    b = []
    for i in right.encode(text):
        piece = right.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if right.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = (" " + text).encode()
    if b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
        return []
    groups, ids_a, ids_b, i, j, end_a, end_b = [], [], [], 0, 0, 0, 0
    for offset in range(1, len(whole) + 1):
        while i < len(a) and end_a + len(a[i][1]) <= offset:
            end_a += len(a[i][1])
            ids_a.append(a[i][0])
            i += 1
        while j < len(b) and end_b + len(b[j][1]) <= offset:
            end_b += len(b[j][1])
            ids_b.append(b[j][0])
            j += 1
        if end_a == end_b == offset:
            groups.append((ids_a, ids_b))
            ids_a, ids_b = [], []
    return groups


ODD = [
    None,
    "",
    " ",
    "   ",
    "a",
    "  two  spaces  ",
    "\n\nx\ty\r\n",
    "x▁y",
    "<|endoftext|> <s> </s> <unk> <0x41>",
    "日本語😀 é ﬁ ① z",
    "\x00 \x07",
    "it's 12 o'clock, they'll say",
    "x" * 5000,
    "ab " * 4000,
]


def test_groups_of_odd_texts(sides, libraries):
    for text in ODD:
        assert list(align(text, sides).groups()) == plain(text, libraries), (text or "")[:20]


@settings(max_examples=400, deadline=None)
@given(text=st.text(st.characters(codec="utf-8"), max_size=60) | st.text("ab  \n▁é<|1", max_size=40) | st.text("aBé 9.,(\n-", max_size=60))
def test_groups_of_any_text(sides, libraries, text):
    text = text.encode("utf-8", "ignore").decode()
    assert list(align(text, sides).groups()) == plain(text, libraries)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.floats(0, 1), st.floats(0, 1), st.integers(0, 10**6))
def test_shared_ends_of_any_arrays(n, p, q, seed):
    rng = np.random.default_rng(seed)
    a = np.append(np.flatnonzero(rng.random(n) < p), n).astype(np.int32)
    b = np.append(np.flatnonzero(rng.random(n) < q), n).astype(np.int32)
    in_a, in_b = shared_ends(a, b)
    assert a[in_a].tolist() == b[in_b].tolist() == np.intersect1d(a, b).tolist()


def check(found, rows, libraries):
    groups = [plain(t, libraries) for _, t in rows]
    links = [[(a[-1], b[-1]) for a, b in g] for g in groups]
    counts = collections.Counter(x for one in links for x in one)
    highest = collections.defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    wanted = []
    for (key, _), g, own in zip(rows, groups, links):
        shown = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        wanted.append(
            (
                key,
                sum(len(a) for a, _ in g),
                sum(len(b) for _, b in g),
                len(g),
                len(own),
                sum(counts[x] == highest[x[1]] for x in own),
                sum(counts[x] for x in own),
                hashlib.sha256(shown.encode()).hexdigest() if g else "",
            )
        )
    assert sorted(map(tuple, found), key=str) == sorted(wanted, key=str)


def test_report_over_whole_table(spark, sf_dir, libraries):
    rows = duckdb.sql(f"SELECT doc_id, text FROM '{sf_dir}/documents.parquet'").fetchall()
    check(queries.op13_alignment(spark, sf_dir).collect(), rows, libraries)


def test_report_of_odd_rows(spark, libraries):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "a key is missing"), (5, "a")]
    schema = "doc_id long, text string, id string, links int, n_a string"
    table = spark.createDataFrame([(k, t, "x", 1, "x") for k, t in rows], schema)
    check(alignment_report(table, LEFT, RIGHT).collect(), rows, libraries)
    assert alignment_report(table.limit(0), LEFT, RIGHT).collect() == []


def test_linked_pairs_stay_below_the_bound(sides):
    a, b = [b"the", b"e", b" the", b"x"], [b"he", b" the", b"e", b"y"]
    wanted = {(i, j) for i, x in enumerate(a) for j, y in enumerate(b) if x.endswith(y) or y.endswith(x)}
    assert pair_bound(a, b) == len(wanted)
    assert pair_bound(sides.left.pieces, sides.right.pieces) < 1 << 19
