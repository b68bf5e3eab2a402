"""Fast exact use of tokenizer files: pieces of text are encoded by the library and remembered.

Both tokenizers here cut a text into pieces by a pattern and encode each piece for
itself. Words repeat, so a piece that has been encoded once is looked up afterwards. The
pattern is applied here only to texts of common characters, whose classes every version of
Unicode agrees on; any other text goes to the library as a whole.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from importlib.metadata import version
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

from tallybook.llm.shared import REMEMBERED, Pieces

# Each worker process has a core of its own; the library must not start threads in it.
os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

_COMMON = r"\t\n\r -~À-ÿ¡¿«»–—‘’“”…€"
_CUTTABLE = re.compile(f"[{_COMMON}]*")
_LETTER, _DIGIT, _SPACE = "A-Za-zÀ-ÖØ-öø-ÿ", "0-9", r" \t\n\r"
_ENDINGS = "'s|'t|'re|'ve|'m|'ll|'d"
# The patterns of the two tokenizer files, for common characters.
_PATTERNS = {
    "byte": rf"{_ENDINGS}| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^{_SPACE}{_LETTER}{_DIGIT}]+|[{_SPACE}]+(?![^{_SPACE}])|[{_SPACE}]+",
    "word": rf"{_ENDINGS}|[{_LETTER}]+|[{_DIGIT}]|[^{_SPACE}{_LETTER}{_DIGIT}]+",
}
# Characters that byte-level vocabularies write bytes as, those of ``_PRINTED`` as themselves.
_PRINTED = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_LEVEL = {b: 256 + i for i, b in enumerate(b for b in range(256) if b not in _PRINTED)}
_SPACE_BYTE = chr(_BYTE_LEVEL[32])
# letters in one string, marks that are often behind a word, characters of a piece whose length is remembered
_LETTERS = "".join(c for c in map(chr, range(256)) if re.fullmatch(f"[{_LETTER}]", c))
_MARKS, _SHORT = ".,;:!?", 10
# the pattern of words with a space between them; what begins alike is in the same order, letters come first
_APART = rf"[{_LETTER}]+| |[{_DIGIT}]|{_ENDINGS}|[^{_SPACE}{_LETTER}{_DIGIT}]+"


class Encoder:
    """Token ids of whole texts, as ``Tokenizer.encode(.., add_special_tokens=False)`` gives them."""

    def __init__(self, path: str) -> None:
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        kind = self.kind = _kind(self.tokenizer)
        self._find = re.compile(_PATTERNS[kind]).findall if kind else None
        self._lower = kind == "word"
        self.width = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self._type = "H" if self.width.itemsize == 2 else "I"
        self._counts = Pieces(lambda piece: len(self._encode(piece)))
        self._bytes = Pieces(lambda piece: self._encode(piece).tobytes())
        # the library's model alone encodes a piece several times as fast as the whole tokenizer
        self._model = self.tokenizer.model.tokenize
        probe = [*"aàß5¿…’", "they", "été", "naïve", "groß", "?!", "”…", "€%"]
        self._alone = kind == "word" and all(self._by_model(p) == self._encode(p).tolist() for p in probe)
        # whether ``spaced_word`` holds: such a word is one piece, and none is an added token
        added = [str(t.content).strip() for t in self.tokenizer.get_added_tokens_decoder().values()]
        spaced = [" a", " they", " été", " naïve", " Größe", " XÀÿ"]
        self.spaces_words = (
            kind == "byte"
            and not any(re.fullmatch(f"[{_LETTER}]*", t) for t in added)
            and all(self.spaced_word(w) == self._encode(w).tolist() for w in spaced)
        )
        self._find_apart = re.compile(_APART).findall
        self._lengths: dict[str, int] = {}

    def _encode(self, text: str) -> array:
        return array(self._type, self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _pieces(self, text: str) -> list[str] | None:
        # "<|" could begin a special token
        if self._find is None or "<|" in text or not _CUTTABLE.fullmatch(text):
            return None
        return self._find(text.lower() if self._lower else text)

    def pieces(self, text: str) -> list[str] | None:
        """Parts of a text that are encoded each for itself, special strings as any other text.

        None if it is not known where the tokenizer cuts this text.
        """
        known = self._find is not None and _CUTTABLE.fullmatch(text)
        return self._find(text.lower() if self._lower else text) if known else None

    def count(self, text: str | None) -> int:
        pieces = self._pieces(text or "")
        if pieces is None:
            return len(self._encode(text))
        return sum(map(self._counts.__getitem__, pieces))

    def counts(self, texts: list[str], words: list[str], at: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """``count`` of each text, from the different words that ASCII white space separates in them.

        ``at``: the place in ``words`` of each word of the texts, ``ends``: where those of each text end.
        Words may have A-Z lower-cased. No piece holds white space, so a word is encoded for itself.
        """
        if self.kind != "word":
            return np.array([self.count(t) for t in texts], np.int64)
        lengths = self._lengths_of(words)
        out = np.diff(np.append(0, np.cumsum(lengths[at]))[ends], prepend=0)
        for i, text in enumerate(texts):
            if "<|" in text or not _CUTTABLE.fullmatch(text):
                out[i] = len(self._encode(text))
        return out

    def _lengths_of(self, words: list[str]) -> np.ndarray:
        """How many tokens words without white space have; each different piece of them is looked up once."""
        low = pc.utf8_lower(pa.array(words, pa.string()))
        core = pc.utf8_rtrim(low, _MARKS)
        # most words are a piece of letters, and perhaps one of marks behind it
        plain = pc.match_substring_regex(core, f"^[{_LETTER}]+$")
        marks = pc.utf8_ltrim(low.filter(plain), _LETTERS)
        rest = low.filter(pc.invert(plain)).to_numpy(zero_copy_only=False)
        out, plain = np.zeros(len(words), np.int64), plain.to_numpy(zero_copy_only=False)
        out[plain] = self._lengths_in(core.filter(pa.array(plain))) + self._lengths_in(marks)
        if len(rest):
            # the others are cut with a space in front of each
            pieces = pa.array(self._find_apart("".join(f" {w}" for w in rest)), pa.string())
            lengths, gap = self._lengths_in(pieces), pc.equal(pieces, " ").to_numpy(zero_copy_only=False)
            lengths[gap] = 0
            out[~plain] = np.add.reduceat(lengths, np.flatnonzero(gap))
        return out

    def _lengths_in(self, pieces: pa.StringArray) -> np.ndarray:
        """How many tokens pieces have, none if empty; long ones are rare and computed each time."""
        coded, known = pieces.dictionary_encode(), self._lengths
        different = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        lengths = np.fromiter(map(known.get, different, repeat(-1)), np.int64, len(different))
        new = np.flatnonzero(lengths < 0).tolist()
        names = [different[i] for i in new]
        lengths[new] = found = list(self._lengths_alone(names))
        kept = [x for x in zip(names, found) if len(x[0]) <= _SHORT]
        if len(known) + len(kept) > REMEMBERED:
            known.clear()
        known.update(kept)
        return lengths[coded.indices.to_numpy()]

    def _lengths_alone(self, pieces: list[str]) -> Iterator[int]:
        if not self._alone:
            return (len(self._encode(p)) for p in pieces)
        return map(len, map(self._model, [p if p.isascii() else _byte_level(p) for p in pieces]))

    def _by_model(self, piece: str) -> list[int]:
        return [token.id for token in self._model(_byte_level(piece))]

    def spaced_word(self, word: str) -> list[int]:
        """Ids of letters with a space in front, by the model of a byte-level tokenizer alone."""
        return [token.id for token in self._model(_SPACE_BYTE + _byte_level(word[1:]))]

    def ids(self, text: str | None) -> bytes:
        """The ids as little-endian numbers of :attr:`width`."""
        pieces = self._pieces(text or "")
        if pieces is None:
            return self._encode(text).tobytes()
        return b"".join(map(self._bytes.__getitem__, pieces))


def _byte_level(piece: str) -> str:
    """The UTF-8 bytes of a piece as characters of a byte-level vocabulary."""
    return piece if piece.isascii() else piece.encode().decode("latin-1").translate(_BYTE_LEVEL)


def _kind(tokenizer: Tokenizer) -> str | None:
    """Which pattern the tokenizer cuts with, judged by how it cuts a probe; None if neither."""
    cut = tokenizer.pre_tokenizer
    if cut is None:
        return None
    probe = "It's 12  days,\n\n  they'll ¿say? çà et là…\t"
    byte_level = type(cut).__name__ == "ByteLevel" and tokenizer.normalizer is None
    kind = "byte" if byte_level else "word"
    text = tokenizer.normalizer.normalize_str(probe) if tokenizer.normalizer else probe
    found = [piece for piece, _ in cut.pre_tokenize_str(text)]
    own = re.compile(_PATTERNS[kind]).findall(text)
    # the library shows bytes as printable characters, so lengths in bytes are compared
    return kind if [len(p) for p in found] == [len(p.encode()) for p in own] else None


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One for each worker process and file."""
    return Encoder(path)


def tokenizer_digest(path: str) -> str:
    """Changes with the file's content and the library's version."""
    digest = hashlib.sha256(version("tokenizers").encode())
    with open(path, "rb") as file:
        digest.update(file.read())
    return digest.hexdigest()
