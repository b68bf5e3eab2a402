"""Benchmark questions in training text, also with other numbers, names or units.

Texts and benchmark items are reduced to templates: numbers, names and units become
typed placeholders that remember what they stood for. Windows of templates are matched
by hash. A match counts only if its slots are consistent: one value of the item stands
for one value of the text throughout, and the other way round, so that a template with
swapped numbers is caught and a chance meeting of placeholders is not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallybook.llm.near_copies import together
from tallybook.llm.shared import Pieces, begin_step, fresh, release, saved

#: Template tokens of a window; items with fewer are matched whole.
WINDOW = 8
#: An item is in a text if consistent windows cover this share of its tokens, or
#: if this many tokens match in one run.
COVER = 0.5
RUN = 13
#: Of the tokens of a window, those that must be words for placeholders to be matched freely.
LEAST_WORDS = 4
#: Items with fewer tokens than this are looked for as whole texts.
LEAST_TOKENS = 5
#: Remembered tokens of a worker process; some 30 MB.
REMEMBERED = 150_000
#: Up to this many different windows (8 bytes each) the benchmark is sent to every
#: task to drop other windows early; a larger one is matched by the join alone.
SENT_WINDOWS = 2_000_000
PIECE_TOKENS = 1 << 16

# Units that may follow a number.
UNITS = (
    "mm cm m km in ft yd mi mg g kg t oz lb ml cl l gal s sec min h hr hrs hour hours day days "
    "week weeks month months year years minute minutes second seconds meter meters metre metres "
    "kilometer kilometers gram grams kilogram kilograms liter liters litre litres mile miles "
    "foot feet inch inches pound pounds dollar dollars euro euros cent cents percent degree "
    "degrees % $ € £ ° c f k hz khz mhz ghz w kw v j n pa kb mb gb tb"
)
_UNITS = frozenset(UNITS.split())
_PATTERN = r"\d+(?:[.,:/]\d+)*|{0}+(?:['’]{0}+)*|[%$€£°]|[.!?\n]+"
_LETTER = r"[^\W\d_]"
_TOKEN = re.compile(_PATTERN.format(_LETTER)).findall
# the same, quicker, for texts whose letters are all among the first 256 characters
_LATIN = re.compile("[\x00-\xff‘’“”–—…€]*")
_LATIN_PATTERN = _PATTERN.format(
    f"[{''.join(c for c in map(chr, range(256)) if re.fullmatch(_LETTER, c))}]"
).replace(r"\d", "[0-9]")
_LATIN_TOKEN = re.compile(_LATIN_PATTERN).findall
# the same for words with a space between them
_APART = re.compile(f"{_PATTERN.format(_LETTER)}| ").findall
_LATIN_APART = re.compile(f"{_LATIN_PATTERN}| ").findall
# letters whose case every library agrees on, and marks that are often behind a word
_UPPER, _LOWER, _MARKS = "A-ZÀ-ÖØ-Þ", "a-zß-öø-ÿ", ".,;:!?"
_PIECE = 1 << 20
# What a token is, in the low bits of its code; the others are a hash of its lower case.
_WORD, _CAPITAL, _NUMBER, _SIGN, _END, _UNIT_WORD, _UNIT_CAPITAL, _GAP = range(8)
_KIND = np.uint64(7)
# Template tokens of placeholders; words are hashes with low bits of zero.
_SLOT_NUMBER, _SLOT_UNIT, _SLOT_NAME = 1, 2, 3
_MULTIPLIER = 0x9E3779B97F4A7C15


def _code(token: str) -> int:
    low = token.lower()
    first = token[0]
    if token == " ":
        return _GAP
    if first.isdigit():
        kind = _NUMBER
    elif first in "%$€£°":
        kind = _SIGN
    elif first in ".!?\n":
        kind = _END
    else:
        capital = first.isupper() and not (token.isupper() and len(token) > 1)
        kind = (_UNIT_WORD if low in _UNITS else _WORD) + (capital and 1)
    return xxhash.xxh64_intdigest(low) & ~7 | kind


_codes = Pieces(_code, REMEMBERED)


def _cut(text: str) -> list[str]:
    """Pieces of a long text that end at a space; an empty text has none."""
    pieces, at = [], 0
    while at < len(text):
        cut = text.find(" ", at + _PIECE) if at + _PIECE < len(text) else -1
        pieces.append(text[at:] if cut < 0 else text[at:cut])
        at = len(text) if cut < 0 else cut
    return pieces


def _tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes of the tokens of the texts, how many each text has); a word that comes again is not read again."""
    # no token holds white space but a line break, which ends a sentence as a full stop does
    split = pc.ascii_split_whitespace(pc.replace_substring(pa.array(texts, pa.string()), "\n", " . "))
    words = split.flatten().dictionary_encode()
    codes, begins, sizes = _word_tokens(words.dictionary)
    at = words.indices.to_numpy()
    n = sizes[at]
    sums = np.append(0, np.cumsum(n))
    places = np.repeat(begins[at] - sums[:-1], n) + np.arange(sums[-1])
    ends = np.cumsum(pc.list_value_length(split).to_numpy())
    return codes[places], np.diff(sums[ends], prepend=0)


def _word_tokens(words: pa.StringArray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(codes, where those of each word begin, how many it has) for words without white space."""
    core = pc.utf8_rtrim(words, _MARKS)
    # most words are one token, and a sentence may end behind it
    plain = pc.match_substring_regex(core, f"^[{_UPPER}{_LOWER}]+$")
    rest, core = words.filter(pc.invert(plain)), core.filter(plain)
    ended = pc.match_substring_regex(words.filter(plain), "[.!?]").to_numpy(zero_copy_only=False)
    lower = pc.utf8_lower(core).dictionary_encode()
    low = lower.dictionary
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, low.to_numpy(zero_copy_only=False)), np.uint64, len(low))
    unit = pc.is_in(low, pa.array(sorted(_UNITS))).to_numpy(zero_copy_only=False)
    of_low = hashes & ~_KIND | np.where(unit, _UNIT_WORD, _WORD).astype(np.uint64)
    capital = pc.match_substring_regex(core, f"^[{_UPPER}]([{_LOWER}]|[{_UPPER}]*[{_LOWER}]|$)")
    plain_codes = of_low[lower.indices.to_numpy()] + capital.to_numpy(zero_copy_only=False).astype(np.uint64)
    plain = plain.to_numpy(zero_copy_only=False)
    # the others are read with a space in front of each
    joined = "".join(f" {w}" for w in rest.to_numpy(zero_copy_only=False))
    found = (_LATIN_APART if _LATIN.fullmatch(joined) else _APART)(joined)
    others = np.fromiter(map(_codes.__getitem__, found), np.uint64, len(found))
    gap = others == _GAP
    sizes = np.ones(len(words), np.int64)
    sizes[plain] += ended
    sizes[~plain] = np.diff(np.flatnonzero(gap), append=len(others)) - 1
    ends = np.cumsum(sizes)
    codes = np.full(ends[-1] if len(ends) else 0, _END, np.uint64)
    begins = ends - sizes
    codes[begins[plain]] = plain_codes
    n = sizes[~plain]
    codes[np.repeat(begins[~plain] - (np.cumsum(n) - n), n) + np.arange(n.sum())] = others[~gap]
    return codes, begins, sizes


def templates(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(template tokens, hashes of the words themselves, whether it is a placeholder, where each text ends).

    A number is digits; a unit is a known word after a number, or a sign; a name is a
    capitalised word that does not begin a sentence. Other words are lower-cased;
    punctuation only ends sentences. Long texts are read in pieces that end at a space.
    """
    pieces, last = [], []
    for text in texts:
        pieces += _cut(text)
        last.append(len(pieces))
    parts = [_tokens(some) for some in together(pieces)]
    codes = np.concatenate([np.zeros(0, np.uint64), *(c for c, _ in parts)])
    n = np.concatenate([np.zeros(1, np.int64), *(n for _, n in parts)])
    ends = np.cumsum(n)[last]
    kind = (codes & _KIND).astype(np.int8)
    stops = kind == _END
    begins = np.ones(len(codes), bool)
    begins[1:] = stops[:-1]
    begins[ends[ends < len(codes)]] = True
    kept = ~stops
    ends = np.append(0, np.cumsum(kept))[ends]
    codes, kind, begins = codes[kept], kind[kept], begins[kept]
    words = codes & ~_KIND
    out = words.copy()
    number = kind == _NUMBER
    after = np.zeros(len(codes), bool)
    after[1:] = number[:-1]
    after[ends[ends < len(codes)]] = False
    unit = (after & (kind >= _UNIT_WORD)) | (kind == _SIGN)
    name = ~begins & ~unit & ((kind == _CAPITAL) | (kind == _UNIT_CAPITAL))
    for which, slot in ((number, _SLOT_NUMBER), (unit, _SLOT_UNIT), (name, _SLOT_NAME)):
        out[which] = slot
    return out, words, number | unit | name, ends


def template(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``templates`` of one text."""
    return templates([text or ""])[:3]


@lru_cache(maxsize=4)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the multiplier and of its inverse."""
    inverse = pow(_MULTIPLIER, -1, 1 << 64)
    return tuple(
        np.cumprod(np.append(np.uint64(1), np.full(n - 1, x, np.uint64)), dtype=np.uint64)
        for x in (_MULTIPLIER, inverse)
    )


def _rolling(mixed: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all windows of values that went through ``_mix``: sums of value by power, the last by 1.

    Each is the difference of two running sums, brought to its place by a power.
    """
    n = max(0, len(mixed) - size + 1)
    power, inverse = _powers(_BLOCK + WINDOW if len(mixed) <= _BLOCK + WINDOW else len(mixed))
    sums = np.zeros(len(mixed) + 1, np.uint64)
    np.cumsum(mixed * inverse[: len(mixed)], out=sums[1:])
    return (sums[size : size + n] - sums[:n]) * power[size - 1 : size - 1 + n]


def _rolling_at(words: np.ndarray, size: int, places: np.ndarray) -> np.ndarray:
    """``_rolling`` of ``_mix`` of words at a few places."""
    if len(places) * size > len(words):
        return _rolling(_mix(words), size)[places]
    mixed = _mix(words[places[:, None] + np.arange(size)])
    return (mixed * _powers(_BLOCK + WINDOW)[0][:size][::-1]).sum(1, dtype=np.uint64)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def windows(text: str | None, sizes: tuple[int, ...], known: Known | None = None) -> Iterator[tuple]:
    """(hash, position, size, slots) of ``windows_of`` one text."""
    return (found[1:] for found in windows_of([text or ""], sizes, known))


def windows_of(
    texts: list[str], sizes: tuple[int, ...], known: Known | None = None
) -> Iterator[tuple]:
    """(place of the text, hash, position, size, slots) of the windows of the templates of texts.

    ``sizes``: the window lengths; ``known``: the hashes that matter, all if None. Slots are
    hashes of what the placeholders stand for, in order. A window with too few words has
    these hashed with it, so that it matches literally only. A window that begins with a
    name is also given with the word itself, as it may begin a sentence elsewhere. Lengths
    below ``LEAST_TOKENS`` are matched with whole texts only.
    """
    all_tokens, all_words, all_slots, ends = templates(texts)
    n, starts = len(all_tokens), np.append(0, ends[:-1])
    for size in sizes:
        if size < LEAST_TOKENS and size not in ends - starts:
            continue
        for at in range(0, n - size + 1, _BLOCK):
            # blocks overlap by what a window takes in
            part = slice(at, min(n, at + _BLOCK + size - 1))
            tokens, words, slots = all_tokens[part], all_words[part], all_slots[part]
            as_template = _rolling(_mix(tokens), size)
            sums = np.concatenate([[0], np.cumsum(slots)])
            placeholders = sums[size:] - sums[:-size]
            first = np.flatnonzero(tokens[: len(as_template)] == _SLOT_NAME)
            top = np.uint64(pow(_MULTIPLIER, size - 1, 1 << 64))
            lead = (_mix(words[first]) - _mix(tokens[first])) * top
            for template_hash, held, begins, skipped in (
                (as_template, placeholders, None, 0),
                (as_template[first] + lead, placeholders[first] - 1, first, 1),
            ):
                few = np.flatnonzero((held > 0) & (size - held < min(LEAST_WORDS, size)))
                places = few if begins is None else begins[few]
                template_hash[few] = _mix(template_hash[few]) ^ _rolling_at(words, size, places)
                h = _mix(template_hash)
                found = np.arange(len(h)) if known is None else np.flatnonzero(known.has(h))
                places = found if begins is None else begins[found]
                text = np.searchsorted(ends, at + places, "right")
                position = at + places - starts[text]
                # texts lie one behind the other; a window is in one of them
                rest = ends[text] - starts[text] - position - size
                inside = (rest >= 0) if size >= LEAST_TOKENS else (rest == 0) & (position == 0)
                for j in np.flatnonzero(inside):
                    i = places[j]
                    begin = i + skipped
                    own = words[begin : i + size][slots[begin : i + size]]
                    yield int(text[j]), int(h[found[j]].view(np.int64)), int(position[j]), size, own.view(np.int64).tolist()


#: Tokens that are hashed in one go; they fit the caches of a processor.
_BLOCK = 1 << 15


class Known:
    """A set of hashes that is quick to ask for many at once."""

    def __init__(self, hashes: np.ndarray) -> None:
        self._sorted = np.sort(hashes.view(np.uint64))
        self._sieve = np.zeros(1 << 22, bool)
        self._sieve[self._slot(self._sorted)] = True

    @staticmethod
    def _slot(h: np.ndarray) -> np.ndarray:
        return (h >> np.uint64(42)).astype(np.int64)

    def has(self, h: np.ndarray) -> np.ndarray:
        out = self._sieve[self._slot(h)]
        maybe = np.flatnonzero(out)
        at = np.searchsorted(self._sorted, h[maybe])
        out[maybe] = self._sorted[np.minimum(at, len(self._sorted) - 1)] == h[maybe]
        return out


_SCHEMA = "hash long, position int, size int, slots array<bigint>"


def benchmark_windows(benchmark: DataFrame, text: str = "text", key: str = "item_id") -> DataFrame:
    """(item_id, n_tokens, hash, item_position, size, item_slots) of all items."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for item, t in zip(b["item_id"], b["text"], strict=True):
                n = len(template(t)[0])
                rows = list(windows(t, (min(WINDOW, n),))) if n else []
                out = pd.DataFrame(rows, columns=["hash", "item_position", "size", "item_slots"])
                out.insert(0, "n_tokens", n)
                out.insert(0, "item_id", item)
                yield out

    rows = benchmark.select(
        F.col(f"`{key}`").cast("long").alias("item_id"), F.col(f"`{text}`").alias("text")
    ).where("item_id is not null")
    return rows.mapInPandas(
        split,
        "item_id long, n_tokens int, hash long, item_position int, size int, item_slots array<bigint>",
    )


def text_windows(rows: DataFrame, sizes: tuple[int, ...], hashes: np.ndarray | None) -> DataFrame:
    """(id, part, hash, position, size, slots) of the windows of rows (id, part, text).

    With ``hashes``, other windows are left out.
    """
    sent = rows.sparkSession.sparkContext.broadcast(hashes)

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        begin_step("decontamination", _codes.clear)
        known = None if sent.value is None else Known(sent.value)
        for b in batches:
            ids, parts, done = b["id"].to_numpy(), b["part"].to_numpy(), 0
            for some in together(b["text"]):
                held: list[tuple] = []
                for w in windows_of(some, sizes, known):
                    held.append(w)
                    if len(held) == PIECE_TOKENS:
                        yield _frame(ids[done:], parts[done:], held)
                        held = []
                if held:
                    yield _frame(ids[done:], parts[done:], held)
                done += len(some)
            release()

    return rows.mapInPandas(split, f"id long, part long, {_SCHEMA}")


def _frame(ids: np.ndarray, parts: np.ndarray, rows: list[tuple]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=["text", "hash", "position", "size", "slots"])
    of = out.pop("text").to_numpy()
    out.insert(0, "part", parts[of])
    out.insert(0, "id", ids[of])
    return out


def contaminations(
    rows: DataFrame, benchmark: DataFrame, cover: float = COVER, run: int = RUN
) -> DataFrame:
    """(id, part, item_id, covered, n_tokens, longest_run) of the items in rows (id, part, text)."""
    items = saved(benchmark_windows(benchmark), "items")
    sizes = tuple(sorted(r["size"] for r in items.select("size").distinct().collect()))
    different = items.select("hash").distinct()
    hashes = None
    if different.count() <= SENT_WINDOWS:
        hashes = different.toPandas()["hash"].to_numpy(np.int64)
    hits = text_windows(rows, sizes, hashes).join(items, ["hash", "size"])
    # windows of one placement of the item in the text have one difference of positions
    one = ["id", "part", "item_id", "n_tokens", "shift"]
    pairs = F.arrays_zip("item_slots", "slots")
    placed = (
        hits.withColumn("shift", F.col("position") - F.col("item_position"))
        .withColumn("pairs", pairs)
        .groupBy(*one)
        .agg(
            # at most one window for each token of the item
            F.sort_array(F.collect_set(F.struct("item_position", "size"))).alias("spans"),
            F.array_distinct(F.flatten(F.collect_set("pairs"))).alias("pairs"),
        )
        .where(_consistent(F.col("pairs")))
    )
    spans = placed.select(*one, F.explode("spans").alias("span")).select(
        *one,
        F.explode(
            F.sequence("span.item_position", F.col("span.item_position") + F.col("span.size") - 1)
        ).alias("token"),
    )
    # tokens of a run have one difference between token and rank
    ranked = (
        spans.distinct()
        .groupBy(*one)
        .agg(F.sort_array(F.collect_list("token")).alias("tokens"))
        .select(*one, F.posexplode("tokens").alias("rank", "token"))
    )
    runs = ranked.groupBy(*one, (F.col("token") - F.col("rank")).alias("run")).agg(
        F.count("*").alias("n")
    )
    best = runs.groupBy("id", "part", "item_id", "n_tokens").agg(
        F.max("n").alias("longest_run")
    )
    # of several placements all tokens of the item that any of them has count
    tokens = spans.groupBy("id", "part", "item_id").agg(
        F.count_distinct("token").alias("covered")
    )
    found = best.join(tokens, ["id", "part", "item_id"])
    return found.where(
        (F.col("covered") >= cover * F.col("n_tokens")) | (F.col("longest_run") >= run)
    )


def _consistent(pairs: Column) -> Column:
    """Whether pairs (item_slots, slots) of slot values are one to one."""
    n = F.size(pairs)
    return (F.size(F.array_distinct(pairs["item_slots"])) == n) & (
        F.size(F.array_distinct(pairs["slots"])) == n
    )


def _keyed(df: DataFrame, text: str, key: str) -> DataFrame:
    """Rows (id, part, text): part tells rows apart that have no key or the same one."""
    return df.select(
        F.coalesce(F.col(f"`{key}`"), F.lit(-1)).cast("long").alias("id"),
        F.xxhash64(F.col(f"`{text}`")).alias("part"),
        F.col(f"`{text}`").alias("text"),
    ).where("text is not null")


def contaminated_pairs(
    df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, item_id, covered, n_tokens, longest_run): the items found in each row of ``df``.

    Null and empty texts and items without a token match nothing; rows without a
    key are reported under -1; repeated rows are reported once; an empty table or
    benchmark gives no rows.
    """
    found = contaminations(_keyed(df, text, key), benchmark)
    return (
        found.groupBy("id", "item_id")
        .agg(
            F.max("covered").alias("covered"),
            F.first("n_tokens").alias("n_tokens"),
            F.max("longest_run").alias("longest_run"),
        )
        .withColumnRenamed("id", key)
    )


def drop_contaminated(
    df: DataFrame, benchmark: DataFrame, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """The rows of ``df`` without an item of ``benchmark``, with the columns of ``df``.

    Rows are told apart by key and text, so that a row without a key is judged as well.
    """
    own, part = fresh(df.columns, "id"), fresh([*df.columns, "id"], "part")
    bad = contaminations(_keyed(df, text, key), benchmark).select(
        F.col("id").alias(own), F.col("part").alias(part)
    ).distinct()
    kept = df.withColumns(
        {
            own: F.coalesce(F.col(f"`{key}`"), F.lit(-1)).cast("long"),
            part: F.xxhash64(F.col(f"`{text}`")),
        }
    ).join(bad, [own, part], "left_anti")
    return kept.select(*(f"`{c}`" for c in df.columns))
