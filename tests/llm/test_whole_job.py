"""The text operators do the whole job: cases that sampled, capped or narrowed work loses."""

import collections
import itertools

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tallybook.llm import language_id, near_copies, packing, simhash, url_filter

WORDS = [f"w{i}" for i in range(3000)]


def text_of(rng, n):
    return list(rng.choice(WORDS, n))


def similarity(a, b):
    sets = []
    for words in (a.lower().split(), b.lower().split()):
        n = min(5, len(words))
        sets.append({tuple(words[i : i + n]) for i in range(len(words) - n + 1)})
    return len(sets[0] & sets[1]) / len(sets[0] | sets[1])


def test_near_copies_against_brute_force(spark):
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(60):
        base = text_of(rng, int(rng.integers(30, 300)))
        for _ in range(4):
            copy = list(base)
            for at in rng.choice(len(copy), int(rng.integers(0, 1 + len(copy) // 25)), replace=False):
                copy[at] = "other"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "node long, text string")
    root = {r["node"]: r["root"] for r in near_copies.near_copies(df).collect()}
    expected = list(range(len(texts)))
    for a, b in itertools.combinations(range(len(texts)), 2):
        if similarity(texts[a], texts[b]) >= 0.8:
            x, y = sorted((expected[a], expected[b]))
            expected = [x if r == y else r for r in expected]
    assert len(set(expected)) < len(set(texts))
    assert [root[i] for i in range(len(texts))] == expected


def test_near_copies_of_one_original_are_linked_through_it(spark):
    # each lies within reach of the original, most not of one another
    base = text_of(np.random.default_rng(8), 100)
    copies = [base[:i] + ["x", "y"] + base[i + 2 :] for i in range(0, 90, 3)]
    texts = [" ".join(c) for c in [*copies, base]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert [r["doc_id"] for r in simhash.drop_near_duplicates(df).collect()] == [0]


def test_url_contexts_share_no_counts(spark):
    # far more contexts than any fixed number of slots took
    rng = np.random.default_rng(6)
    urls = ["".join(rng.choice(list("abcdefghijklmnop0123456789"), 30)) for _ in range(1500)]
    rows = [(u, "allow" if i % 2 else "block") for i, u in enumerate(urls)]
    df = spark.createDataFrame(rows, "url string, verdict string")
    fold = url_filter.F.pmod(url_filter.F.xxhash64("url"), url_filter.F.lit(url_filter.FOLDS))
    train = [(r["url"], r["verdict"]) for r in df.where(fold != 0).collect()]
    counts = [collections.defaultdict(collections.Counter) for _ in range(2)]
    for u, verdict in train:
        for i, c in enumerate(u):
            for k in range(url_filter.ORDER + 1):
                counts[verdict == "block"][("^" * 5 + u)[5 + i - k : 5 + i]][c] += 1
    assert len(counts[0]) > 20_000

    def log_likelihood(side, u):
        total = 0.0
        for i, c in enumerate(u):
            p = 1 / url_filter.SYMBOLS
            for k in range(url_filter.ORDER + 1):
                own = counts[side].get(("^" * 5 + u)[5 + i - k : 5 + i])
                if own:
                    p = (own[c] + len(own) * p) / (sum(own.values()) + len(own))
            total += np.log(p)
        return total

    some = urls[:20] + ["zzz/new"]
    expected = [(log_likelihood(0, u) - log_likelihood(1, u)) / len(u) for u in some]
    import pandas as pd

    assert np.allclose(url_filter.fit(df).score(pd.Series(some)), expected, atol=1e-9)


def test_packing_lengths_are_tokens(spark):
    texts = ["日本語" * 1500, "x9Q" * 2000, "it's 12 km, they say", "", None]
    rows = [(i, t, f"s{i}") for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    expected = {
        i: 1 + len(library.encode(t or "", add_special_tokens=False).ids) for i, t in enumerate(texts)
    }
    got = packing.pack_texts(df).collect()
    total = collections.Counter()
    for r in got:
        total[r["doc_id"]] += r["length"]
    assert total == expected and max(expected.values()) > 2048
    assert max(r["length"] for r in got) <= 2048


def test_near_copies_share_no_sequence(spark):
    base = text_of(np.random.default_rng(9), 100)
    texts = [" ".join(base), " ".join([*base[:50], "other", *base[51:]]), "quite another text of few words"]
    df = spark.createDataFrame([(i, t, f"s{i}") for i, t in enumerate(texts)], "doc_id long, text string, source string")
    bins = {r["doc_id"]: r["bin_id"] for r in packing.pack_texts(df).collect()}
    assert bins[0] != bins[1] and bins[2] in (bins[0], bins[1])


def test_long_texts_are_rejected_too(spark):
    import pandas as pd

    rng = np.random.default_rng(10)
    english = "the old river runs past green hills where people walk and talk of rain and bread".split()
    german = "der alte Fluss geht an den hohen Bergen vorbei und die Leute reden gern vom Wetter".split()
    say = lambda words, n: " ".join(rng.choice(words, n))
    rows = [(say(w, int(rng.integers(50, 200))), n) for w, n in ((english, "en"), (german, "de")) for _ in range(60)]
    model = language_id.fit(spark.createDataFrame(rows, "text string, lang string"))
    cyrillic = "старая река течет мимо зеленых холмов где люди гуляют и говорят о дожде".split()
    noise = " ".join("".join(rng.choice(list("bcdfghjklmnpqrstvwxz0123456789"), 7)) for _ in range(20_000))
    found = model.predict(pd.Series([say(cyrillic, 20_000), noise, say(english, 20_000), say(german, 20_000)]))
    assert found["rejected"].tolist() == [True, True, False, False]
