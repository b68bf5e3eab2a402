"""Alignment of the tokens that two tokenizers make of the same text.

Both token sequences become arrays of byte offsets where tokens end. Where the two
tokenizers agree, token i of one ends with token i + shift of the other for a long stretch: the
arrays are compared at the current shift in probes of doubling length, and the
stretch is jumped. Where they disagree, the side that ends first steps on until both end
together, which closes an irregular group and gives the next shift.

The texts are encoded once. Links are counted over the corpus by a grouping, and the counts are
broadcast: linked tokens end at the same byte, so one is a suffix of the other, and ``pair_bound``
says from the two vocabularies alone how many pairs there can be.
"""

from __future__ import annotations

import hashlib
import re
import string
from array import array
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType
from tokenizers import Tokenizer

from tallybook.errors import TallyError
from tallybook.llm.shared import Pieces, begin_step, fresh, saved
from tallybook.llm.tokenizing import Encoder

#: Rows are handed on, and their links looked up, when they hold so many links.
CHUNK = 1 << 20
#: Remembered texts of groups that are not one token on both sides, and the longest that are remembered.
GROUPS, GROUP_TEXT = 100_000, 120
#: Remembered units of text in a worker process, some 45 MB, and as many that came before them.
UNITS = 150_000
#: Longer units of text are encoded each time.
LONGEST = 64
#: Tokens compared in the first probe of a stretch.
FIRST_PROBE = 16
#: Pairs that may be broadcast: 12 bytes each.
MOST_PAIRS = 1 << 24
# Bytes that byte-level vocabularies write as themselves; the others, in order, are written from 256 on.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]

#: Both tokenizers cut rows of such units between them: the byte-level one by its pattern, the other where no piece goes on.
_WORD = re.compile(" [A-Za-zÀ-ÖØ-öø-ÿ]{1,64}")
#: Characters that may stand apart from letters and digits in a vocabulary.
_MARKS = string.punctuation + "\t\n\r"


#: Texts that both kinds of tokenizers cut alike.
_SIMPLE = re.compile(f"[A-Za-zÀ-ÖØ-öø-ÿ0-9 {re.escape(_MARKS.replace(chr(39), ''))}]*")
_SPACES = re.compile(r"\s\s")


class Recent:
    """What belongs to units of text, of those that came last; ``compute`` gives it for a list of new ones.

    When ``UNITS`` are held they become the older ones, of which those that come again are taken over.
    """

    def __init__(self, compute: Callable[[list[str]], dict[str, object]]) -> None:
        self._compute = compute
        self._known: dict[str, object] = {}
        self._older: dict[str, object] = {}

    def of(self, units: list[str]) -> list:
        known = self._known
        new = set(units).difference(known)
        if new:
            if len(known) + len(new) > UNITS:
                self._older, self._known = known, {}
                known, new = self._known, set(units)
            older = self._older
            again = [u for u in new if u in older]
            known.update(zip(again, map(older.__getitem__, again)))
            new.difference_update(again)
            if new:
                known.update(self._compute(list(new)))
        found = list(map(known.__getitem__, units))
        for unit in new:
            if len(unit) > LONGEST:
                del known[unit]
        return found


class Side:
    """One tokenizer: ``pieces`` has the bytes of every id.

    ``units`` cuts a text, with a space in front, into parts that the tokenizer encodes each for
    itself, and ``compute`` encodes a list of such parts. Parts repeat, so their ids are remembered.
    """

    #: Whether a byte-level pattern keeps letters, digits and other characters apart.
    splits_classes = False
    #: The pattern of units, of a vocabulary that has one.
    unit: re.Pattern | None = None
    #: Ids of one word with a space in front, where the tokenizer's model alone gives them, which is quicker.
    alone: Callable[[str], list[int]] | None = None

    def __init__(
        self,
        pieces: list[bytes],
        units: Callable[[str], list[str]],
        compute: Callable[[list[str]], list[list[int]]],
    ) -> None:
        self.pieces, self._units, self._compute = pieces, units, compute
        self.lengths = np.array([len(p) for p in pieces], np.int32)
        self._recent = Recent(self.ids_of)

    def ids_of(self, units: list[str]) -> dict[str, bytes | None]:
        """Ids of units, None for one that they do not spell.

        Words with a space in front stay units in a row of them, which is encoded faster than each alone.
        """
        found: dict[str, bytes | None] = {}
        words = list(filter(_WORD.fullmatch, units))
        if self.alone:
            for word in words:
                ids = self.alone(word)
                if b"".join([self.pieces[i] for i in ids]) == word.encode():
                    found[word] = array("i", ids).tobytes()
            units, words = [u for u in units if u not in found], []
        row = self._compute(["".join(words)])[0] if words else []
        ids = np.array(row, np.int32)
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(u.encode()) for u in words])
        cuts = np.searchsorted(ends, wanted)
        whole = b"".join(map(self.pieces.__getitem__, row)) == "".join(words).encode()
        if words and whole and (ends[cuts] == wanted).all():
            cuts, flat = (cuts + 1) * ids.itemsize, ids.tobytes()
            starts = [0, *cuts[:-1].tolist()]
            found.update(zip(words, [flat[i:j] for i, j in zip(starts, cuts.tolist())]))
            units = [u for u in units if u not in found]
        for unit, row in zip(units, self._compute(units) if units else [], strict=True):
            spelled = b"".join(map(self.pieces.__getitem__, row)) == unit.encode()
            found[unit] = array("i", row).tobytes() if spelled else None
        return found

    def encode(self, text: str) -> np.ndarray | None:
        """Ids of a text; None if their bytes are not those of the text with a space in front."""
        found = self._recent.of(self._units(text))
        return None if None in found else np.frombuffer(b"".join(found), np.int32)


class Sides:
    """Two tokenizers; texts that both cut in the same places are looked up once for both.

    These are texts of letters, digits and marks without apostrophes and without two white spaces in a row,
    for a byte-level pattern on the left and a sentencepiece vocabulary with a ``unit`` pattern on the right: the
    left one has a cut wherever the right one has. Any other text is encoded by each side for itself.
    """

    def __init__(self, left: Side, right: Side) -> None:
        self.left, self.right = left, right
        self._unit = right.unit if left.splits_classes else None
        self._recent = Recent(self._both)

    def _both(self, units: list[str]) -> dict[str, tuple[bytes, bytes] | None]:
        a, b = self.left.ids_of(units), self.right.ids_of(units)
        return {u: None if a[u] is None or b[u] is None else (a[u], b[u]) for u in units}

    def encode(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides; None if one of them does not spell the text."""
        if self._unit is None or not _SIMPLE.fullmatch(text) or _SPACES.search(" " + text):
            a, b = self.left.encode(text), self.right.encode(text)
            return None if a is None or b is None else (a, b)
        found = self._recent.of(self._unit.findall(" " + text))
        if None in found:
            return None
        return tuple(np.frombuffer(b"".join(side), np.int32) for side in zip(*found))


def byte_level_pieces(tokenizer: Tokenizer) -> list[bytes]:
    """Bytes of every entry of a byte-level vocabulary; special tokens are their text."""
    others = [b for b in range(256) if b not in _PRINTED]
    byte_of = {chr(b): b for b in _PRINTED} | {chr(256 + i): b for i, b in enumerate(others)}
    size = tokenizer.get_vocab_size()
    special = tokenizer.get_added_tokens_decoder()
    out = []
    for i in range(size):
        token = tokenizer.id_to_token(i) or ""
        plain = i in special or any(c not in byte_of for c in token)
        out.append(token.encode() if plain else bytes(byte_of[c] for c in token))
    return out


def byte_level_side(path: str) -> Side:
    """A byte-level tokenizer file; text is encoded with a space in front, special strings as text."""
    encoder = Encoder(path)
    encoder.tokenizer.encode_special_tokens = True

    def compute(units: list[str]) -> list[list[int]]:
        # one by one: a batch would start threads
        return [encoder.tokenizer.encode(u, add_special_tokens=False).ids for u in units]

    def units(text: str) -> list[str]:
        return encoder.pieces(" " + text) or [" " + text]

    side = Side(byte_level_pieces(encoder.tokenizer), units, compute)
    side.splits_classes = encoder.kind == "byte"
    side.alone = encoder.spaced_word if encoder.spaces_words else None
    return side


def unit_pattern(pieces: list[str]) -> re.Pattern | None:
    """Cuts a text where no piece of a sentencepiece vocabulary goes on; None if there are no such places.

    Spaces go with what follows them, and marks are apart from other characters. What
    stands beside a mark in a piece is a mark too.
    """
    marks, before = set(_MARKS), set()
    while marks != before:
        before = set(marks)
        for piece in pieces:
            if before & set(piece):
                marks |= set(piece) - {"▁"}
    if any(c.isalpha() for c in marks) or "\n" in "".join(pieces) or any(re.search("[^▁]▁", p) for p in pieces):
        return None
    one = "".join(map(re.escape, sorted(marks)))
    return re.compile(f" *(?:[^{one} ]+|[{one}]+)| +")


def sentence_side(path: str) -> Side:
    """A sentencepiece model with byte pieces that puts the space in front itself."""
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    named = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    pieces = [
        bytes([int(name[3:-1], 16)]) if model.is_byte(i) else name.replace("▁", " ").encode()
        for i, name in enumerate(named)
    ]
    space, line = model.piece_to_id("▁"), len(model.encode("\n"))
    unit = unit_pattern(
        [n for i, n in enumerate(named) if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))]
    )
    if space == model.unk_id():
        unit = None

    def compute(units: list[str]) -> list[list[int]]:
        # the model's own space is taken where there is one, else cut off with a line end that no piece has
        spaced = [u.startswith(" ") for u in units]
        found = [model.encode(u[1:] if s else f"\n{u}") for u, s in zip(units, spaced)]
        # it puts no space in front of nothing
        return [
            [space] if u == " " else ids if s else ids[line:]
            for u, s, ids in zip(units, spaced, found, strict=True)
        ]

    side = Side(pieces, lambda text: unit.findall(" " + text) if unit else [" " + text], compute)
    side.unit = unit
    return side


@lru_cache(maxsize=4)
def _side(path: str) -> Side:
    """One for each worker process and file."""
    return sentence_side(path) if path.endswith(".model") else byte_level_side(path)


@lru_cache(maxsize=2)
def _sides(left: str, right: str) -> Sides:
    return Sides(_side(left), _side(right))


def shared_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in ``a`` and in ``b`` of the values that both rising arrays hold.

    Both must end with the same value.
    """
    size, n = a.itemsize, len(a)
    a_bytes, b_bytes = a.tobytes(), b.tobytes()
    a_list, b_list, from_bytes = a.tolist(), b.tolist(), int.from_bytes
    starts, shifts, lengths = [], [], []
    i = j = 0
    while i < n:
        # an irregular group: the side that ends first steps on
        x, y = a_list[i], b_list[j]
        while x != y:
            if x < y:
                i += 1
                x = a_list[i]
            else:
                j += 1
                y = b_list[j]
        # a stretch at this shift: probes double until one fails, and its first difference ends it
        shift, begin, at, step = (j - i) * size, i, (i + 1) * size, FIRST_PROBE * size
        while True:
            p, q = a_bytes[at : at + step], b_bytes[at + shift : at + shift + step]
            if p != q:
                same = min(len(p), len(q))
                change = from_bytes(p[:same], "little") ^ from_bytes(q[:same], "little")
                # equal as far as both go: one array ends here
                at += ((change & -change).bit_length() - 1) // (8 * size) * size if change else same
                break
            at += len(p)
            if len(p) < step:
                break
            step *= 2
        i = at // size
        j = i + shift // size
        starts.append(begin)
        shifts.append(shift // size)
        lengths.append(i - begin)
    counts = np.array(lengths, np.int64)
    total = int(counts.sum())
    within = np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    in_a = within + np.repeat(np.array(starts, np.int64), counts)
    return in_a, in_a + np.repeat(np.array(shifts, np.int64), counts)


@dataclass(frozen=True)
class Alignment:
    """Token ids of both sides and the last token of each group on either side."""

    a: np.ndarray
    b: np.ndarray
    last_a: np.ndarray
    last_b: np.ndarray

    def groups(self) -> Iterator[tuple[list[int], list[int]]]:
        a, b, p, q = self.a.tolist(), self.b.tolist(), 0, 0
        for i, j in zip(self.last_a.tolist(), self.last_b.tolist(), strict=True):
            yield a[p : i + 1], b[q : j + 1]
            p, q = i + 1, j + 1

    def digest(self) -> str:
        """SHA-256 of the groups as ``a1,a2|b1;a3|b2,b3``; empty without tokens."""
        if not len(self.a):
            return ""
        # most groups are one token on either side; groups repeat, so their texts are remembered
        codes = (self.a[self.last_a].astype(np.int64) << 32) | self.b[self.last_b]
        out = list(map(_pair.__getitem__, codes.tolist()))
        i, j = np.append(-1, self.last_a) + 1, np.append(-1, self.last_b) + 1
        uneven = np.flatnonzero((np.diff(i) > 1) | (np.diff(j) > 1))
        a, b, size = self.a.tobytes(), self.b.tobytes(), self.a.itemsize
        cuts = (size * np.stack([i[uneven], i[uneven + 1], j[uneven], j[uneven + 1]])).T.tolist()
        for g, (p, q, r, s) in zip(uneven.tolist(), cuts, strict=True):
            ids = a[p:q], b[r:s]
            out[g] = _uneven.get(ids) or _remember(ids)
        return hashlib.sha256(b";".join(out)).hexdigest()


def _group_text(ids: tuple[bytes, bytes]) -> bytes:
    a, b = (",".join(map(str, np.frombuffer(side, np.int32).tolist())) for side in ids)
    return f"{a}|{b}".encode()


#: a << 32 | b -> "a|b"
_pair = Pieces(lambda code: b"%d|%d" % (code >> 32, code & 0xFFFFFFFF))
#: ids of a group on both sides -> "a1,a2|b1"
_uneven: dict[tuple[bytes, bytes], bytes] = {}


def _remember(ids: tuple[bytes, bytes]) -> bytes:
    text = _group_text(ids)
    if len(text) <= GROUP_TEXT:
        if len(_uneven) >= GROUPS:
            _uneven.clear()
        _uneven[ids] = text
    return text


_NO_IDS, _NO_ENDS = np.zeros(0, np.int32), np.zeros(0, np.int64)
NOTHING = Alignment(_NO_IDS, _NO_IDS, _NO_ENDS, _NO_ENDS)


def align(text: str | None, sides: Sides) -> Alignment:
    """The groups of a text; ``NOTHING`` if it is null or empty, or if a side does not spell it."""
    if not text:
        return NOTHING
    found = sides.encode(text)
    if found is None:
        return NOTHING
    a, b = found
    kind = np.int32 if len(text) < 1 << 28 else np.int64
    ends = (np.cumsum(side.lengths[ids], dtype=kind) for side, ids in ((sides.left, a), (sides.right, b)))
    return Alignment(a, b, *shared_ends(*ends))


def pair_bound(left: list[bytes], right: list[bytes]) -> int:
    """How many pairs of ids can be linked at most: pairs of which one is the other's suffix."""

    def suffixes(tokens: list[bytes], others: list[bytes], least: int) -> int:
        counts: dict[bytes, int] = {}
        for t in others:
            counts[t] = counts.get(t, 0) + 1
        return sum(counts.get(t[k:], 0) for t in tokens for k in range(least, len(t)))

    return suffixes(left, right, 0) + suffixes(right, left, 1)


def align_tokens(
    df: DataFrame, left: str, right: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(id, n_a, n_b, n_groups, groups_sha256, links) for each row of ``df``, written once.

    ``left`` and ``right``: tokenizer files that every worker has. links: an array with
    ``left id * size of the right vocabulary + right id`` for each link, of four bytes if these are enough.
    """
    size = len(_side(right).pieces)
    small = len(_side(left).pieces) * size <= 1 << 31
    kind, number = ("int", pa.int32()) if small else ("long", pa.int64())
    schema = StructType(
        [StructField("id", df.schema[key].dataType)]
        + StructType.fromDDL(
            f"n_a long, n_b long, n_groups long, groups_sha256 string, links array<{kind}>"
        ).fields
    )
    if 0 in map(len, _side(left).pieces + _side(right).pieces):
        raise TallyError("a vocabulary with an empty token cannot be aligned")

    def table(keys: pa.Array, found: list[tuple], links: list[np.ndarray]) -> pa.RecordBatch:
        counts = list(zip(*found))
        offsets = np.append(0, np.cumsum([len(x) for x in links])).astype(np.int32)
        values = pa.array(np.concatenate(links).astype(number.to_pandas_dtype()))
        arrays = [keys, *(pa.array(c) for c in counts), pa.ListArray.from_arrays(offsets, values)]
        return pa.RecordBatch.from_arrays(arrays, schema.names)

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_step("alignment", forget)
        sides = _sides(left, right)
        for batch in batches:
            begin, held, found, links = 0, 0, [], []
            for row in range(batch.num_rows):
                x = align(batch.column(1)[row].as_py(), sides)
                codes = x.a[x.last_a].astype(np.int64) * size + x.b[x.last_b]
                found.append((len(x.a), len(x.b), len(x.last_a), x.digest()))
                links.append(codes)
                held += len(codes)
                if held >= CHUNK:
                    yield table(batch.column(0).slice(begin, len(found)), found, links)
                    begin, held, found, links = row + 1, 0, [], []
            if found:
                yield table(batch.column(0).slice(begin), found, links)

    rows = df.select(F.col(f"`{key}`").alias(fresh(["text"], "id")), F.col(f"`{text}`").alias("text"))
    return saved(rows.mapInArrow(tasks, schema), "aligned")


def pair_counts(aligned: DataFrame) -> DataFrame:
    """(link, n): how many links of the corpus hold each pair of ids."""
    return aligned.select(F.explode("links").alias("link")).groupBy("link").agg(
        F.count("*").alias("n")
    )


def forget() -> None:
    """Drops the tokenizers of this worker process and what it remembers of texts."""
    _sides.cache_clear()
    _side.cache_clear()
    _pair.clear()
    _uneven.clear()


def chunks(batch: pa.RecordBatch, links: pa.ListArray) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in slices of at most ``CHUNK`` links, or of one row."""
    ends, begin, done = np.cumsum(links.value_lengths().to_numpy()), 0, 0
    while begin < batch.num_rows:
        end = max(begin + 1, int(np.searchsorted(ends, done + CHUNK, "right")))
        yield batch.slice(begin, end - begin)
        begin, done = end, int(ends[end - 1])


def link_sums(links: pa.ListArray, codes: np.ndarray, values: tuple[np.ndarray, ...]) -> list[pa.Array]:
    """For each array of values of the sorted ``codes``, its sum over the links of each row."""
    at = np.searchsorted(codes, links.flatten().to_numpy())
    ends = np.append(0, np.cumsum(links.value_lengths().to_numpy()))
    return [pa.array(np.diff(np.append(0, np.cumsum(v[at], dtype=np.int64))[ends])) for v in values]


def alignment_report(
    df: DataFrame, left: str, right: str, text: str = "text", key: str = "doc_id"
) -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row of ``df``.

    Null and empty texts, and texts that a tokenizer does not spell byte by byte, have
    zeros and an empty digest. Null keys and repeated rows are kept, and repeated rows
    count each time; of several links with the highest count of a right id all are best; an
    empty table gives no rows.
    """
    bound = pair_bound(_side(left).pieces, _side(right).pieces)
    if bound > MOST_PAIRS:
        raise TallyError(f"{bound} pairs of these vocabularies can be linked, over {MOST_PAIRS}")
    spark, size = df.sparkSession, len(_side(right).pieces)
    aligned = align_tokens(df, left, right, text, key)
    pairs = pair_counts(aligned).toArrow()
    codes, counts = pairs["link"].to_numpy(), pairs["n"].to_numpy()
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    highest = np.zeros(size, np.int64)
    np.maximum.at(highest, codes % size, counts)
    shared = spark.sparkContext.broadcast((codes, counts, counts == highest[codes % size]))
    kept = ["id", "n_a", "n_b", "n_groups", "groups_sha256"]
    schema = StructType(
        [*(aligned.schema[c] for c in kept)] + StructType.fromDDL("n_best long, count_sum long").fields
    )

    def tasks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        begin_step("links")
        codes, counts, best = shared.value
        for batch in batches:
            for rows in chunks(batch, batch.column(len(kept))):
                sums = link_sums(rows.column(len(kept)), codes, (best, counts))
                yield pa.RecordBatch.from_arrays([*rows.columns[: len(kept)], *sums], schema.names)

    return aligned.select(*kept, "links").mapInArrow(tasks, schema).select(
        F.col("id").alias(key),
        "n_a",
        "n_b",
        "n_groups",
        F.col("n_groups").alias("n_links"),
        "n_best",
        "count_sum",
        "groups_sha256",
    )
