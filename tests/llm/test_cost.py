"""What the text operators compute for each token, and that shorter ways give the same."""

import re

import numpy as np
import pandas as pd
import public_tokenizers
from tallybook.llm import alignment, decontaminate, near_copies, packing, tokenizing
from tokenizers import Tokenizer


def test_tokens_are_mixed_once_for_all_windows(monkeypatch):
    mixed, mix = [], decontaminate._mix

    def counted(x):
        mixed.append(len(x))
        return mix(x)

    monkeypatch.setattr(decontaminate, "_mix", counted)
    n = 2000
    known = decontaminate.Known(np.zeros(1, np.uint64))
    assert list(decontaminate.windows("word " * n, (8,), known)) == []
    assert sum(mixed) <= 4 * n


def test_latin_tokens_are_those_of_the_general_pattern():
    general = re.compile(r"\d+(?:[.,:/]\d+)*|[^\W\d_]+(?:['’][^\W\d_]+)*|[%$€£°]|[.!?\n]+").findall
    for c in map(chr, [*range(0x3000), 0x2019, 0x20AC, 0xFF11]):
        text = f"a{c}b 5{c}6 {c}{c} c’{c} 7,{c}"
        quick = decontaminate._LATIN.fullmatch(text)
        found = (decontaminate._LATIN_TOKEN if quick else decontaminate._TOKEN)(text)
        assert found == general(text), text
    assert decontaminate._LATIN.fullmatch("Él paga 5 € — l’été")


def test_templates_of_many_texts_read_each_word_once(monkeypatch):
    hashed, digest = [], decontaminate.xxhash.xxh64_intdigest
    monkeypatch.setattr(decontaminate.xxhash, "xxh64_intdigest", lambda w: hashed.append(w) or digest(w))
    monkeypatch.setattr(decontaminate, "_BLOCK", 64)
    texts = ["She paid 5 km to Ann. KM Été été!", "", "\n", "l’été 12,5kg\nIBM I. ÉTÉ ªb µm ABc, 日本 5 €", "Ann paid Bob 7 cm"] * 40
    texts += [" ".join(f"w{chr(97 + i % 7)} Paris 12" for i in range(100))]
    together = list(decontaminate.windows_of(texts, (1, 3, 5, 8)))
    assert len(hashed) == len(set(hashed))
    alone = [(i, *w) for i, t in enumerate(texts) for w in decontaminate.windows(t, (1, 3, 5, 8))]
    assert sorted(together) == sorted(alone) and len({w[0] for w in together}) == 121
    known = decontaminate.Known(np.array([w[1] for w in together[::50]], np.int64))
    wanted = {w[1] for w in together[::50]}
    assert sorted(decontaminate.windows_of(texts, (1, 3, 5, 8), known)) == sorted(w for w in together if w[1] in wanted)
    # every token is what the pattern and its code make of it
    for text in texts:
        codes = [decontaminate._code(t) for t in decontaminate._TOKEN(text)]
        words = [c & ~7 for c in codes if c & 7 != decontaminate._END]
        assert decontaminate.template(text)[1].tolist() == words


def test_lengths_from_words_are_those_of_the_library(monkeypatch):
    path = public_tokenizers.path(packing.TOKENIZER)
    plain = Tokenizer.from_file(path)
    texts = ["", " ", "a  B\x0bC\n", "<|endoftext|> x", "it's THEY'LL 'S", "Été naïve “x”… 12,5 €", "日本 é", "<s> x<|y", "z" * 300]
    tool, called = tokenizing.Encoder(path), []
    encode = tool._encode
    monkeypatch.setattr(tool, "_encode", lambda t: called.append(t) or encode(t))
    for remembered in (600_000, 3):
        monkeypatch.setattr(tokenizing, "REMEMBERED", remembered)
        for some in (texts, texts[::-1], ["one two, two"]):
            got = tool.counts(some, *near_copies.words_of(some))
            assert got.tolist() == [len(plain.encode(t, add_special_tokens=False).ids) for t in some]
    # only texts of other characters go through the whole tokenizer
    assert {"one", "two", "été", "a"}.isdisjoint(called)


def test_words_of_letters_and_marks_are_not_cut_again(monkeypatch):
    tool = tokenizing.Encoder(public_tokenizers.path(packing.TOKENIZER))
    cut, find, asked, alone = [], tool._find_apart, [], tool._lengths_alone
    monkeypatch.setattr(tool, "_find_apart", lambda t: cut.append(t) or find(t))
    monkeypatch.setattr(tool, "_lengths_alone", lambda names: asked.extend(names) or alone(names))
    for _ in range(2):
        texts = ["Été, été! one one, ONE;", "don't 12,5 «one»!?", "abcdefghijklmnop one?!"]
        got = tool.counts(texts, *near_copies.words_of(texts))
        assert got.tolist() == [len(tool._encode(t)) for t in texts]
    assert cut == [" don't 12,5 «one»!?"] * 2
    # long pieces are rare and not remembered
    assert asked.count("one") == 1 and asked.count("abcdefghijklmnop") == 2 and "abcdefghijklmnop" not in tool._lengths


def test_different_words_of_many_texts_are_hashed_once(monkeypatch):
    hashed, digest = [], near_copies.xxhash.xxh64_intdigest
    monkeypatch.setattr(near_copies.xxhash, "xxh64_intdigest", lambda w: hashed.append(w) or digest(w))
    texts = ["A b\x0bc d  e f\x1cg ", "", "a b", "b a c D e f"] * 50
    sets = near_copies.shingle_sets(*near_copies.words_of(texts))
    assert sorted(hashed) == sorted({"a", "b", "c", "d", "e", "f\x1cg", "f"})
    for text, own in zip(texts, sets, strict=True):
        words = text.lower().encode().split()
        size = min(5, len(words))
        codes = [np.array([digest(w)], np.uint64) for w in words]
        expected = {int(near_copies._chain(codes[i : i + size])[0]) for i in range(len(words) - size + 1)} if size else set()
        assert own.tolist() == sorted(expected)


def test_sets_of_other_sizes_are_not_compared(monkeypatch):
    compared, search = [], np.searchsorted
    monkeypatch.setattr(near_copies.np, "searchsorted", lambda a, v: compared.append(len(v)) or search(a, v))
    ends = [100, 90, 80, 300, 20]
    sets = [np.arange(n, dtype=np.uint64) for n in ends]
    links = near_copies.forest(sets, list(range(5)))
    assert {frozenset(x) for x in links} == {frozenset(x) for x in ((0, 1), (0, 2))}
    assert max(compared, default=0) <= 180


def test_links_of_a_batch_of_buckets_come_in_one_frame():
    sets = [np.arange(n, dtype=np.uint64).tobytes() for n in (10, 9, 3)]
    rows = [(band, 3 * band + i, 3 * band + i, own) for band in range(50) for i, own in enumerate(sets)]
    frame = pd.DataFrame(rows, columns=["band", "node", "root", "own"])
    found = list(near_copies._bucket_links(iter([frame.iloc[:70], frame.iloc[70:]])))
    assert len(found) == 3
    links = pd.concat(found)
    assert {frozenset(x) for x in zip(links["a"], links["b"])} == {frozenset((3 * b, 3 * b + 1)) for b in range(50)}


def test_bands_of_many_sets_are_chained_at_once(monkeypatch):
    sets = near_copies.shingle_sets(*near_copies.words_of([f"a b c d e f g {n}" for n in range(20)] + [""]))
    alone = [near_copies.bands([s])[0].tolist() for s in sets]
    called, chain = [], near_copies._chain
    monkeypatch.setattr(near_copies, "_chain", lambda values: called.append(1) or chain(values))
    assert [b.tolist() for b in near_copies.bands(sets)] == alone
    assert len(called) == 1
    assert alone[-1] == [] and len(alone[0]) == near_copies.BANDS


def test_buckets_of_the_same_nodes_are_compared_once(spark):
    rows = [(1, 1, 1), (1, 2, 2), (2, 1, 1), (2, 2, 2), (3, 1, 1), (3, 2, 2), (3, 3, 3), (4, 4, 4), (4, 5, 4), (5, 1, 1), (5, 3, 3)]
    rows += [(6, 1, 1), (6, 6, 6), (6, 3, 3), (7, 3, 3), (7, 1, 1), (7, 6, 6), (8, 1, 1), (8, 6, 6), (8, 2, 2)]
    placed = spark.createDataFrame(rows, "band long, node long, root long")
    assert sorted(r["band"] for r in near_copies._mixed_bands(placed).collect()) == [1, 3, 5, 6, 8]


def test_words_with_a_space_are_encoded_by_the_model_alone(monkeypatch):
    side = alignment.byte_level_side(public_tokenizers.path("byte_bpe_50k.json"))
    whole, rows = side._compute, []
    monkeypatch.setattr(side, "_compute", lambda units: rows.extend(units) or whole(units))
    words = [" the", " été", " Größe", " naïveté", " Xyzzyqwk", " ÀÿØ", " " + "ab" * 30]
    found = side.ids_of([*words, " 12", "!?"])
    assert "".join(words) not in rows and not set(words) & set(rows)
    for unit, ids in found.items():
        assert np.frombuffer(ids, np.int32).tolist() == whole([unit])[0]
    assert len(found) == len(words) + 2
