"""The main text of web pages, block by block, by a bidirectional LSTM.

A page becomes the sequence of its leaf blocks. Each block is a vector of its hashed tag
path, its hashed words and a few measures; the network reads the sequence in both
directions, so that a block is judged in the light of the whole page, and labels every
block as main text or not. It is trained in numpy on a bounded sample of pages, whose
blocks are labelled by the elements and class names that say what they are. Copies of
these pages with other elements, other names, and inserted notices, forms, sidebars and
comments teach it what the sample itself may lack.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bounds of the sample for the fit: about so many pages, none longer than this.
SAMPLE = 240
SAMPLE_BYTES = 60_000
PATH_SIZE, WORD_SIZE, MEASURES = 96, 32, 6
HIDDEN = 20
STEPS, BATCH_PAGES, TRAIN_BLOCKS = 320, 16, 40
GROUP_PAGES = 256

# Elements that begin a block of their own, elements without an end tag, and
# elements whose content is no text.
BLOCK_TAGS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav "
    "ol optgroup option p pre section select summary table tbody td tfoot th thead tr ul".split()
)
VOID_TAGS = frozenset("area base br col embed hr img input link meta source track wbr".split())
SILENT_TAGS = frozenset("script style noscript template svg math title iframe object".split())
# Parts of element, class and id names that say what a block is.
NOT_MAIN = (
    "nav menu header footer aside sidebar ad ads advert advertisement adverts promo sponsor sponsored banner "
    "cookie notice consent popup modal overlay alert form newsletter subscribe signup login search comment "
    "comments reply replies respond discussion breadcrumb breadcrumbs pagination pager share social "
    "related recommended widget toolbar copyright legal disclaimer"
).split()
MAIN = "article main content post entry story".split()
_NAME_PART = re.compile(r"[a-z]+")
_OPEN_TAG = re.compile(r"<[A-Za-z/!?][^<>]*\Z")
_CLOSED_BY_BLOCK = frozenset(["p"])
_SAME_CLOSES = frozenset("li dt dd tr td th option".split())


@dataclass
class Block:
    """text: white space reduced; path: words of the names around it; linked: share in links."""

    path: tuple[str, ...]
    text: str
    linked: float


class _Leaves(HTMLParser):
    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.blocks: list[Block] = []
        self._open: list[tuple[str, tuple[str, ...]]] = []
        self._text: list[str] = []
        self._links = self._linked = self._silent = 0

    def flush(self) -> None:
        text = " ".join("".join(self._text).split())
        if text:
            path = tuple(w for _, words in self._open for w in words)
            self.blocks.append(Block(path, text, min(1.0, self._linked / len(text))))
        self._text, self._linked = [], 0

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in SILENT_TAGS:
            self._silent += 1
        if tag in BLOCK_TAGS:
            self.flush()
            self._imply_end(tag)
        elif tag == "br":
            self._text.append(" ")
        if tag in VOID_TAGS:
            return
        names = " ".join(v for k, v in attrs if v and k in ("class", "id", "role"))
        self._open.append((tag, (tag, *_NAME_PART.findall(names.lower()))))
        self._links += tag == "a"

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        if tag in VOID_TAGS:
            self.handle_starttag(tag, attrs)

    def _imply_end(self, tag: str) -> None:
        """A block ends an open paragraph, and an item the item before it."""
        for i in range(len(self._open) - 1, -1, -1):
            name = self._open[i][0]
            if name in _CLOSED_BY_BLOCK or (name == tag and tag in _SAME_CLOSES):
                self._pop_to(i)
                return
            if name in BLOCK_TAGS:
                return

    def handle_endtag(self, tag: str) -> None:
        if tag in BLOCK_TAGS:
            self.flush()
        for i in range(len(self._open) - 1, -1, -1):
            if self._open[i][0] == tag:
                self._pop_to(i)
                return

    def _pop_to(self, i: int) -> None:
        for name, _ in self._open[i:]:
            self._links -= name == "a"
            self._silent -= name in SILENT_TAGS
        del self._open[i:]

    def handle_data(self, data: str) -> None:
        if not self._silent:
            self._text.append(data)
            if self._links:
                self._linked += len(data)


def leaves(html: str | None) -> list[Block]:
    """The blocks of a page in order; a tag that the page's end cuts off is dropped."""
    parser = _Leaves()
    parser.feed(_OPEN_TAG.sub("", html or ""))
    parser.close()
    parser.flush()
    return parser.blocks


def features(blocks: list[Block]) -> np.ndarray:
    """A row for each block: hashed path, hashed words, measures."""
    out = np.zeros((len(blocks), PATH_SIZE + WORD_SIZE + MEASURES), np.float32)
    crc = zlib.crc32
    for i, b in enumerate(blocks):
        for name in b.path:
            h = crc(name.encode("utf-8", "surrogatepass"))
            out[i, h % PATH_SIZE] += 1 if h >> 16 & 1 else -1
        words = b.text.encode("utf-8", "surrogatepass").lower().split()
        slots = np.bincount([crc(w) % WORD_SIZE for w in words], minlength=WORD_SIZE)
        out[i, PATH_SIZE : PATH_SIZE + WORD_SIZE] = slots / np.sqrt(max(1, (slots * slots).sum()))
        out[i, PATH_SIZE + WORD_SIZE :] = (
            np.log1p(len(words)) / 4,
            b.linked,
            b.text[-1] in ".!?…\"”»",
            len(b.text) / max(1, len(words)) / 10,
            i / max(1, len(blocks) - 1),
            1.0,
        )
    np.clip(out[:, :PATH_SIZE], -3, 3, out=out[:, :PATH_SIZE])
    return out


def taught_label(path: tuple[str, ...]) -> int | None:
    """1 or 0 where names on the path say so; None if they don't."""
    names = set(path)
    if names.intersection(NOT_MAIN):
        return 0
    return 1 if names.intersection(MAIN) else None


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class BlockLabeller:
    """Two LSTMs, one for each direction, and a logistic layer on both states."""

    def __init__(self, inputs: int, hidden: int = HIDDEN, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.hidden = hidden
        draw = lambda *shape: (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)
        self.weights = {}
        for d in "fb":
            bias = np.zeros(4 * hidden, np.float32)
            bias[hidden : 2 * hidden] = 1  # remember at first
            self.weights |= {
                f"W{d}": draw(inputs, 4 * hidden), f"U{d}": draw(hidden, 4 * hidden), f"c{d}": bias
            }
        self.weights |= {"out": draw(2 * hidden, 1), "bias": np.zeros(1, np.float32)}

    def _run(self, x: np.ndarray, d: str, keep: bool):
        """States (pages, blocks, hidden) of direction ``d``; with ``keep`` what training needs."""
        w, h_size = self.weights, self.hidden
        pages, steps, _ = x.shape
        drive = x @ w[f"W{d}"] + w[f"c{d}"]
        h = c = np.zeros((pages, h_size), np.float32)
        states, kept = np.zeros((pages, steps, h_size), np.float32), []
        for t in range(steps):
            z = drive[:, t] + h @ w[f"U{d}"]
            gates = _sigmoid(z[:, : 3 * h_size])
            i, f, o = np.split(gates, 3, axis=1)
            g = np.tanh(z[:, 3 * h_size :])
            before, c = c, f * c + i * g
            tc = np.tanh(c)
            if keep:
                kept.append((h, before, i, f, o, g, tc))
            h = o * tc
            states[:, t] = h
        return states, kept

    def _both(self, x: np.ndarray, back: np.ndarray, keep: bool = False):
        """``back``: for each page and step the block to read from the end on."""
        rows = np.arange(len(x))[:, None]
        f, kept_f = self._run(x, "f", keep)
        b, kept_b = self._run(x[rows, back], "b", keep)
        # ``back`` is its own inverse
        return np.concatenate([f, b[rows, back]], 2), kept_f, kept_b

    def probabilities(self, pages: list[np.ndarray]) -> list[np.ndarray]:
        """Of main text, for each block of each page. Pages of like length are read together."""
        out: list[np.ndarray] = [np.zeros(0, np.float32)] * len(pages)
        order = sorted((i for i in range(len(pages)) if len(pages[i])), key=lambda i: len(pages[i]))
        at = 0
        while at < len(order):
            # no more padded blocks at once than a few thousand, whatever the pages' length
            n = max(1, min(GROUP_PAGES, 8192 // len(pages[order[min(len(order), at + GROUP_PAGES) - 1]])))
            group = order[at : at + n]
            x, back, _ = _padded([pages[i] for i in group])
            states, _, _ = self._both(x, back)
            p = _sigmoid(states @ self.weights["out"] + self.weights["bias"])[:, :, 0]
            for k, i in enumerate(group):
                out[i] = p[k, : len(pages[i])]
            at += n
        return out

    def train(self, pages: list[tuple[np.ndarray, np.ndarray]], steps: int = STEPS, seed: int = 6) -> None:
        """Adam on (features, labels) of pages; labels below 0 are not taught."""
        rng = np.random.default_rng(seed)
        m = {k: np.zeros_like(v) for k, v in self.weights.items()}
        s = {k: np.zeros_like(v) for k, v in self.weights.items()}
        for step in range(1, steps + 1):
            chosen = rng.integers(0, len(pages), BATCH_PAGES)
            cut = []
            for i in chosen:
                x, y = pages[i]
                first = rng.integers(0, max(1, len(x) - TRAIN_BLOCKS + 1))
                cut.append((x[first : first + TRAIN_BLOCKS], y[first : first + TRAIN_BLOCKS]))
            for k, g in self._gradients(cut).items():
                g = np.clip(g, -1, 1)
                m[k] = 0.9 * m[k] + 0.1 * g
                s[k] = 0.999 * s[k] + 0.001 * g * g
                rate = 0.02 * min(1, 3 * (1 - step / (steps + 1)))
                self.weights[k] = self.weights[k] - rate * (m[k] / (1 - 0.9**step)) / (
                    np.sqrt(s[k] / (1 - 0.999**step)) + 1e-7
                )

    def _gradients(self, pages: list[tuple[np.ndarray, np.ndarray]]) -> dict[str, np.ndarray]:
        w, h_size = self.weights, self.hidden
        x, back, real = _padded([p for p, _ in pages])
        y = np.full(real.shape, -1.0, np.float32)
        for k, (_, labels) in enumerate(pages):
            y[k, : len(labels)] = labels
        taught = real & (y >= 0)
        states, kept_f, kept_b = self._both(x, back, keep=True)
        p = _sigmoid(states @ w["out"] + w["bias"])[:, :, 0]
        d_out = np.where(taught, p - y, 0)[:, :, None] / max(1, taught.sum())
        grads = {
            "out": np.tensordot(states, d_out, ([0, 1], [0, 1])),
            "bias": d_out.sum((0, 1)),
        }
        d_states = d_out @ w["out"].T
        rows = np.arange(len(x))[:, None]
        for d, kept, inputs, ds in (
            ("f", kept_f, x, d_states[:, :, :h_size]),
            ("b", kept_b, x[rows, back], d_states[:, :, h_size:][rows, back]),
        ):
            d_drive = np.zeros((*x.shape[:2], 4 * h_size), np.float32)
            d_u = np.zeros_like(w[f"U{d}"])
            dh = dc = np.zeros((len(x), h_size), np.float32)
            for t in range(x.shape[1] - 1, -1, -1):
                h, before, i, f, o, g, tc = kept[t]
                dh = dh + ds[:, t]
                dc = dc + dh * o * (1 - tc * tc)
                dz = np.concatenate(
                    [
                        dc * g * i * (1 - i),
                        dc * before * f * (1 - f),
                        dh * tc * o * (1 - o),
                        dc * i * (1 - g * g),
                    ],
                    1,
                )
                d_drive[:, t] = dz
                d_u += h.T @ dz
                dh, dc = dz @ w[f"U{d}"].T, dc * f
            grads |= {
                f"W{d}": np.tensordot(inputs, d_drive, ([0, 1], [0, 1])),
                f"U{d}": d_u,
                f"c{d}": d_drive.sum((0, 1)),
            }
        return grads


def _padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(blocks of all pages, their order from the end on, which are no padding)."""
    sizes = np.array([len(p) for p in pages])
    steps = max(1, int(sizes.max()))
    x = np.zeros((len(pages), steps, pages[0].shape[1]), np.float32)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
    t = np.arange(steps)
    real = t < sizes[:, None]
    return x, np.where(real, sizes[:, None] - 1 - t, t), real


# Paths of parts that a page may have, around and inside its main text.
MAIN_PATHS = (
    "article", "main", "main article", "div content", "div main content", "section post body",
    "div entry", "div article body", "div story", "div post content", "article div content",
)
SIDE_PATHS = {
    "before": ("nav menu", "header", "header nav", "div menu", "ul nav", "div banner", "div cookie notice",
               "div notice", "div breadcrumb", "div ad", "form search", "div header", "div consent", "div ads"),
    "inside": ("aside", "div ad", "div advert", "div related", "form newsletter", "div promo",
               "div share", "div notice", "figure ad", "div sponsored", "div alert"),
    "after": ("section comments", "div comments div comment", "div comment", "ol comments li", "aside sidebar",
              "div sidebar", "form", "form login", "footer", "div footer", "div related", "div newsletter form",
              "div copyright", "div reply", "aside", "section discussion", "div popup"),
}


def varied(blocks: list[Block], texts: list[str], rng: np.random.Generator) -> tuple[list[Block], list[int]]:
    """A page of its own with the main text of ``blocks`` and parts around and within it.

    Parts other than main text take their words from ``texts``, so that words alone don't
    tell; what they are is said by names and by where they stand.
    """
    root = ("html", "body", *(("div", "wrapper") if rng.random() < 0.5 else ()))
    main = (*root, *rng.choice(MAIN_PATHS).split())
    out: list[Block] = []
    labels: list[int] = []

    def side(where: str, under: tuple[str, ...]) -> None:
        path = (*under, *str(rng.choice(SIDE_PATHS[where])).split())
        linked = 1.0 if rng.random() < 0.4 else 0.0
        for _ in range(int(rng.integers(1, 6))):
            words = texts[rng.integers(len(texts))].split()
            n = int(rng.integers(1, 4 if linked else max(2, min(40, len(words)) + 1)))
            begin = int(rng.integers(0, max(1, len(words) - n)))
            inner = ("li", "a") if linked else (("p",) if rng.random() < 0.5 else ())
            out.append(Block((*path, *inner), " ".join(words[begin : begin + n]) or "x", linked))
            labels.append(0)

    for _ in range(int(rng.integers(1, 4))):
        side("before", root)
    for b in blocks:
        out.append(Block((*main, b.path[-1] if b.path[-1] in ("h1", "h2", "li", "p") else "p"), b.text, b.linked))
        labels.append(1)
        if rng.random() < 0.06:
            side("inside", main)
    for _ in range(int(rng.integers(1, 4))):
        side("after", main if rng.random() < 0.3 else root)
    return out, labels


def train_labeller(pages: list[str], steps: int = STEPS, seed: int = 4) -> BlockLabeller:
    """A labeller for pages like these; see the module's text for what it learns from."""
    rng = np.random.default_rng(seed)
    parsed = [b for b in map(leaves, pages) if b]
    mains = [[b for b in page if taught_label(b.path) == 1] for page in parsed]
    # a sample without such names lends at least its long blocks
    mains = [m or [b for b in page if len(b.text) > 80] for m, page in zip(mains, parsed, strict=True)]
    texts = [b.text for page in parsed for b in page] or ["text"]
    taught = []
    for page, main in zip(parsed, mains, strict=True):
        labels = [taught_label(b.path) for b in page]
        if any(x is not None for x in labels):
            taught.append((features(page), np.array([-1 if x is None else x for x in labels])))
        if main:
            for _ in range(2):
                blocks, own = varied(main[:TRAIN_BLOCKS], texts, rng)
                taught.append((features(blocks), np.array(own)))
    model = BlockLabeller(PATH_SIZE + WORD_SIZE + MEASURES)
    if taught:
        model.train(taught, steps)
    return model


def main_texts(model: BlockLabeller, pages: list[str | None]) -> list[str]:
    """The main text of each page: its main blocks in order, one in a line."""
    parsed = [leaves(p) for p in pages]
    found = model.probabilities([features(b) for b in parsed])
    return [
        "\n".join(b.text for b, p in zip(blocks, ps, strict=True) if p > 0.5)
        for blocks, ps in zip(parsed, found, strict=True)
    ]


def fit(pages: DataFrame, html: str = "html", sample: int = SAMPLE) -> BlockLabeller:
    """A labeller trained on about ``sample`` pages, drawn by a hash of their content.

    Copies of a page are drawn once; pages of over ``SAMPLE_BYTES`` are not drawn.
    """
    rows = pages.select(F.col(f"`{html}`").alias("html")).where(
        F.octet_length("html").between(1, SAMPLE_BYTES)
    )
    key = F.xxhash64("html")
    n = rows.agg(F.approx_count_distinct(key)).first()[0]
    parts = 1 << 20
    share = max(1, parts * sample // max(1, n))
    drawn = rows.where(F.pmod(key, F.lit(parts)) < share).distinct().toPandas()
    return train_labeller(sorted(drawn["html"]))


def extract_main_text(
    df: DataFrame, html: str = "html", url: str = "url", key: str = "page_id"
) -> DataFrame:
    """(key, url, text, n_chars) for each row of ``df``, from the whole page.

    Null, empty and text-free pages have an empty text; repeated rows are treated alike;
    an empty table gives no rows.
    """
    model = fit(df, html)
    sent = df.sparkSession.sparkContext.broadcast(model)

    def udf(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for pages in batches:
            yield pd.Series(
                [
                    text
                    for at in range(0, len(pages), GROUP_PAGES)
                    for text in main_texts(sent.value, pages[at : at + GROUP_PAGES].tolist())
                ],
                dtype=object,
            )

    udf.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    rows = df.select(F.col(f"`{key}`").alias(key), F.col(f"`{url}`").alias("url"), F.col(f"`{html}`").alias("html"))
    return rows.select(key, "url", F.pandas_udf(udf, "string")("html").alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("long")
    )
