"""Main text of web pages: a recurrent network labels the sequence of a page's text blocks.

A page is cut into leaf blocks, the runs of text between block-level tags. Each is described by its path of tags,
classes and ids (hashed and embedded), by its words (hashed, embedded and averaged) and by a few numbers. A
bidirectional LSTM written in numpy reads the whole sequence and labels every block as article or not.

There are no labels by hand. The network is trained on a bounded sample of the pages themselves: where a page marks
its article and its frame by name, those names label the blocks. Copies of these pages with other names, without
names, and with frames of other kinds set around and into the text teach it to go by context where names are missing.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewarden.llm.frames import whole_text

# Fixed values of the HTML language: elements that break a line of text, that have no end, whose text is not shown.
BREAKING = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption "
    "figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html iframe label legend li main menu nav object ol "
    "optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul video".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template svg math canvas".split())

# Names that mark what is not the article, as whole parts of a tag, class or id.
FRAME_NAMES = frozenset(
    "nav menu navbar navigation breadcrumb breadcrumbs footer aside sidebar ad ads advert adverts advertisement banner "
    "sponsored promo form newsletter subscribe signup login search cookie cookies consent notice alert popup modal "
    "comment comments respond reply replies discussion share sharing social related recommended widget pagination pager "
    "copyright legal masthead toolbar button select option textarea label title".split()
)
ARTICLE_NAMES = frozenset("article main".split())

# A comment, a declaration, a tag (a quoted value may hold ">"), a tag that the page ends in, or text.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|</?[a-zA-Z](?>=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+>|</?[a-zA-Z][^>]*\Z|[^<]+|<",
    re.S,
)
TAG = re.compile(r"</?([a-zA-Z][^\s/>]*)")
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)
PART = re.compile(r"[a-z0-9]+")
# Where the content of a hidden element ends: it is not cut into tokens.
HIDDEN_END = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)", re.I) for tag in HIDDEN}


@dataclass
class Block:
    """Text of one leaf block, its path from the root as (tag, parts of names), and characters inside links."""

    path: tuple[tuple[str, tuple[str, ...]], ...]
    text: str
    linked: int


def blocks(page: str) -> list[Block]:
    """The leaf blocks of a page in order; those without visible text are left out."""
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    texts: list[str] = []
    linked = at = 0

    def flush() -> None:
        nonlocal linked
        text = " ".join(html.unescape("".join(texts)).split())
        if text:
            out.append(Block(tuple(x for x in stack if x[0] in BREAKING), text, min(linked, len(text))))
        texts.clear()
        linked = 0

    while found := TOKEN.match(page, at):
        token, at = found.group(), found.end()
        if token[0] != "<" or token == "<":
            texts.append(token)
            if any(tag == "a" for tag, _ in stack):
                linked += len(token)
            continue
        named = TAG.match(token)
        if not named:
            continue
        tag = named.group(1).lower()
        if token[1] == "/":
            if tag in BREAKING:
                flush()
            if any(t == tag for t, _ in stack):
                while stack.pop()[0] != tag:
                    pass
            continue
        if tag in HIDDEN:
            if not token.endswith("/>"):
                end = HIDDEN_END[tag].search(page, at)
                at = end.start() if end else len(page)
            continue
        if tag in BREAKING:
            flush()
            # A new block ends an open paragraph; a list item ends the one before it.
            for ends in ("p",) if tag not in ("li", "option") else ("p", tag):
                inner = [t for t, _ in stack]
                if ends in inner and not {"ul", "ol", "table", "select"} & set(inner[inner.index(ends) + 1 :]):
                    last = len(inner) - 1 - inner[::-1].index(ends)
                    del stack[last:]
        elif tag in ("br", "img"):
            texts.append(" ")
        if tag not in VOID and not token.endswith("/>"):
            names = " ".join(value for _, value in ATTRIBUTE.findall(token)).lower()
            stack.append((tag, tuple(PART.findall(names))))
    flush()
    return out


def marked(found: list[Block]) -> np.ndarray | None:
    """What the names on a page say of its blocks, 1 for the article; None if no name marks an article."""
    labels = np.zeros(len(found))
    named = False
    for i, block in enumerate(found):
        inside = False
        for tag, names in block.path:
            parts = {tag, *names}
            if parts & ARTICLE_NAMES:
                inside = named = True
            if parts & FRAME_NAMES or (tag == "header" and not inside):
                inside = False
                break
        labels[i] = inside
    return labels if named else None


# Frames for the training copies: the path of a block, and whether its text is linked.
FRAMES = (
    (("header", ""), ("h1", "")),
    (("header", ""), ("p", "")),
    (("header", "site"), ("div", "logo")),
    (("div", "page header"), ("p", "")),
    (("div", "top menu"), ("ul", ""), ("li", "")),
    (("ul", "menu"), ("li", "")),
    (("div", "breadcrumbs"), ("span", "")),
    (("aside", ""), ("p", "")),
    (("aside", "sidebar"), ("ul", ""), ("li", "")),
    (("div", "sidebar"), ("div", "widget"), ("p", "")),
    (("div", "notice"), ("p", "")),
    (("div", "cookie consent"), ("p", "")),
    (("div", "alert banner"), ("p", "")),
    (("div", "ad"),),
    (("div", "advert"), ("p", "")),
    (("section", "sponsored"), ("p", "")),
    (("form", ""), ("label", "")),
    (("form", "newsletter subscribe"), ("p", "")),
    (("div", "search"), ("button", "")),
    (("section", "comments"), ("div", "comment"), ("p", "")),
    (("div", "comments"), ("p", "")),
    (("ol", "comment list"), ("li", "comment"), ("p", "")),
    (("div", "related"), ("h3", "")),
    (("div", "share social"), ("p", "")),
    (("footer", ""), ("p", "")),
    (("div", "footer copyright"), ("p", "")),
)
# Other elements that text of an article may stand in.
LEAVES = (
    ("ul", "li"), ("ol", "li"), ("blockquote", "p"), ("blockquote",), ("h2",), ("h3",), ("pre",), ("table", "tr", "td"),
    ("figure", "figcaption"), ("dl", "dd"), ("section", "p"), ("div",), ("div", "p"),
)
ARTICLES = ("article", "main", "div content", "div post", "div entry content", "div story body", "section text", "div", "")


def _varied(found: list[Block], labels: np.ndarray, rng: np.random.Generator) -> tuple[list[Block], np.ndarray]:
    """A copy of a page under other names, with frames of other kinds around and inside the article."""
    body = (("html", ()), ("body", ()))
    article = ARTICLES[rng.integers(len(ARTICLES))].split()
    around = body + (((article[0], tuple(article[1:])),) if article else ())
    nameless = rng.random() < 0.15
    texts = [b.text for b in found]

    def words(n: int) -> str:
        text = texts[rng.integers(len(texts))].split()
        start = rng.integers(max(1, len(text) - n + 1))
        return " ".join(text[start : start + n])

    def frame(inside: bool) -> list[tuple[Block, float]]:
        # A header inside the article is its own.
        kind = FRAMES[rng.integers(4 if inside else 0, len(FRAMES))]
        path = tuple((tag, () if nameless else tuple(names.split())) for tag, names in kind)
        length = int(rng.integers(3, 40)) if any(x in ("comments", "comment") for _, n in kind for x in n.split()) else int(rng.integers(1, 9))
        linked = "li" in [t for t, _ in kind] and rng.random() < 0.8
        out = []
        for _ in range(int(rng.integers(1, 7))):
            text = words(length)
            out.append((Block((around if inside else body) + path, text, len(text) if linked else 0), 0.0))
        return out

    main, others = [], []
    for block, label in zip(found, labels, strict=True):
        if label:
            leaf = tuple(x for x in block.path if x[0] not in ("html", "body", "article", "main"))
            if not main and rng.random() < 0.2 and around != body:
                leaf = (("header", ()), *leaf)
            elif main and rng.random() < 0.25:
                leaf = tuple((tag, ()) for tag in LEAVES[rng.integers(len(LEAVES))])
            main.append((Block(around + leaf, block.text, block.linked), 1.0))
        else:
            others.append((block, 0.0))
    cut = int(rng.integers(1, len(main))) if len(main) > 1 else len(main)
    pages: list[tuple[Block, float]] = []
    for _ in range(int(rng.integers(0, 4))):
        pages += frame(False)
    if rng.random() < 0.5:
        pages = others[: len(others) // 2] + pages
    pages += main[:cut]
    if rng.random() < 0.4 and not nameless:
        pages += frame(True)
    pages += main[cut:]
    for _ in range(int(rng.integers(0, 4))):
        pages += frame(not nameless and bool(rng.random() < 0.3))
    if rng.random() < 0.5:
        pages += others[len(others) // 2 :]
    return [b for b, _ in pages], np.array([x for _, x in pages])


@dataclass
class Shape:
    buckets: int = 1 << 13
    width: int = 16
    hidden: int = 16
    numbers: int = 7
    epochs: int = 8
    batch: int = 16
    rate: float = 0.01
    seed: int = 9


@dataclass
class Features:
    """Hashed path parts and words of the blocks of one page, with their owners, and the numbers per block."""

    path: np.ndarray
    path_of: np.ndarray
    word: np.ndarray
    word_of: np.ndarray
    numbers: np.ndarray


def _bucket(text: str, cache: dict[str, int], buckets: int) -> int:
    found = cache.get(text)
    if found is None:
        value = 1469598103934665603
        for byte in text.encode("utf-8", "replace"):
            value = (value ^ byte) * 1099511628211 % (1 << 64)
        if len(cache) > 200_000:
            cache.clear()
        found = cache[text] = value >> 20
    return found % buckets


_CACHE: dict[str, int] = {}


def features(found: list[Block], shape: Shape) -> Features:
    path, path_of, word, word_of = [], [], [], []
    numbers = np.zeros((len(found), shape.numbers), dtype=np.float32)
    for i, block in enumerate(found):
        parts = {f"<{tag}" for tag, _ in block.path} | {x for _, names in block.path for x in names}
        parts.add(f"<<{block.path[-1][0] if block.path else ''}")
        path += [_bucket(x, _CACHE, shape.buckets) for x in sorted(parts)]
        path_of += [i] * len(parts)
        text = block.text.lower()
        tokens = [x.strip(".,:;!?()\"'") for x in text.split()]
        word += [_bucket("w" + x, _CACHE, shape.buckets) for x in tokens]
        word_of += [i] * len(tokens)
        n = len(text)
        stops = text.count(".") + text.count(",") + text.count("?") + text.count("!")
        numbers[i] = (
            np.log1p(n) / 5, np.log1p(len(tokens)) / 4, block.linked / n, 10 * stops / n, float(text[-1] in ".?!"),
            i / len(found), 1 / (1 + len(found)),
        )
    return Features(np.array(path, dtype=np.int64), np.array(path_of, dtype=np.int64), np.array(word, dtype=np.int64), np.array(word_of, dtype=np.int64), numbers)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass
class Labeller:
    """Embeddings, one LSTM for each direction, and the logistic layer on both."""

    shape: Shape
    weights: dict[str, np.ndarray] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if not self.weights:
            rng = np.random.Generator(np.random.PCG64(self.shape.seed))
            h, inputs = self.shape.hidden, 2 * self.shape.width + self.shape.numbers
            draw = lambda *size, scale: rng.normal(0, scale, size).astype(np.float32)
            self.weights = {
                "path": draw(self.shape.buckets, self.shape.width, scale=0.1),
                "word": draw(self.shape.buckets, self.shape.width, scale=0.05),
                "out": draw(2 * h, scale=0.3),
                "bias": np.zeros(1, dtype=np.float32),
            }
            for side in ("ahead", "back"):
                self.weights[f"{side}_in"] = draw(inputs, 4 * h, scale=0.2)
                self.weights[f"{side}_own"] = draw(h, 4 * h, scale=0.2)
                self.weights[f"{side}_bias"] = np.repeat(np.float32([0, 1, 0, 0]), h)

    def _inputs(self, pages: list[Features], kept: list[tuple[np.ndarray, np.ndarray]] | None = None) -> np.ndarray:
        """pages x blocks x inputs, filled up with zeros. `kept` scales paths and words of blocks, in training."""
        longest = max(len(p.numbers) for p in pages)
        width = self.shape.width
        out = np.zeros((len(pages), longest, 2 * width + self.shape.numbers), dtype=np.float32)
        for i, page in enumerate(pages):
            n = len(page.numbers)
            for k, (name, value, owner) in enumerate((("path", page.path, page.path_of), ("word", page.word, page.word_of))):
                rows = self.weights[name][value]
                starts = np.searchsorted(owner, np.arange(n))
                sums = np.add.reduceat(np.concatenate([rows, np.zeros((1, width), dtype=np.float32)]), starts, axis=0)
                counts = np.bincount(owner, minlength=n)
                sums[counts == 0] = 0
                if k:
                    sums /= np.maximum(counts, 1)[:, None]
                if kept is not None:
                    sums *= kept[i][k][:, None]
                out[i, :n, k * width : (k + 1) * width] = sums
            out[i, :n, 2 * width :] = page.numbers
        return out

    def _run(self, side: str, x: np.ndarray, mask: np.ndarray) -> tuple[np.ndarray, list]:
        """States of one LSTM over pages x blocks x inputs, and what its way back needs."""
        w_own, h_size = self.weights[f"{side}_own"], self.shape.hidden
        given = x @ self.weights[f"{side}_in"] + self.weights[f"{side}_bias"]
        h = c = np.zeros((len(x), h_size), dtype=np.float32)
        states, steps = np.zeros((*x.shape[:2], h_size), dtype=np.float32), []
        for t in range(x.shape[1]):
            gates = given[:, t] + h @ w_own
            i, f, o = (_sigmoid(gates[:, k * h_size : (k + 1) * h_size]) for k in range(3))
            g = np.tanh(gates[:, 3 * h_size :])
            new_c = f * c + i * g
            squashed = np.tanh(new_c)
            on = mask[:, t, None]
            steps.append((h, c, i, f, o, g, squashed, on))
            c = np.where(on, new_c, c)
            h = np.where(on, o * squashed, h)
            states[:, t] = h
        return states, steps

    def _run_back(self, side: str, x: np.ndarray, steps: list, grad: np.ndarray, into: dict[str, np.ndarray]) -> np.ndarray:
        """Gradients of the LSTM's weights, added to `into`, and of its inputs."""
        w_in, w_own = self.weights[f"{side}_in"], self.weights[f"{side}_own"]
        dh_next = dc_next = np.zeros((len(x), self.shape.hidden), dtype=np.float32)
        d_gates = np.zeros((*x.shape[:2], w_in.shape[1]), dtype=np.float32)
        own = np.zeros_like(w_own)
        for t in range(x.shape[1] - 1, -1, -1):
            h, c, i, f, o, g, squashed, on = steps[t]
            dh = grad[:, t] + dh_next
            dc = dc_next + dh * o * (1 - squashed**2)
            parts = [dc * g * i * (1 - i), dc * c * f * (1 - f), dh * squashed * o * (1 - o), dc * i * (1 - g**2)]
            d = np.concatenate(parts, axis=1) * on
            d_gates[:, t] = d
            own += h.T @ d
            dh_next = np.where(on, d @ w_own.T, dh)
            dc_next = np.where(on, dc * f, dc_next)
        flat = d_gates.reshape(-1, w_in.shape[1])
        into[f"{side}_own"] = own
        into[f"{side}_in"] = x.reshape(-1, x.shape[2]).T @ flat
        into[f"{side}_bias"] = flat.sum(axis=0)
        return d_gates @ w_in.T

    @staticmethod
    def _turned(lengths: np.ndarray, longest: int) -> np.ndarray:
        """For each page the order of its blocks from last to first, the filling staying behind."""
        at = np.arange(longest)[None, :]
        return np.where(at < lengths[:, None], lengths[:, None] - 1 - at, at)

    def _forward(self, x: np.ndarray, lengths: np.ndarray) -> tuple:
        mask = np.arange(x.shape[1])[None, :] < lengths[:, None]
        turn = self._turned(lengths, x.shape[1])[:, :, None]
        ahead, steps_ahead = self._run("ahead", x, mask)
        turned = np.take_along_axis(x, turn, axis=1)
        back, steps_back = self._run("back", turned, mask)
        states = np.concatenate([ahead, np.take_along_axis(back, turn, axis=1)], axis=2)
        p = _sigmoid(states @ self.weights["out"] + self.weights["bias"])
        return p, states, mask, turn, turned, steps_ahead, steps_back

    def probabilities(self, pages: list[Features]) -> list[np.ndarray]:
        """Per page the probability of each block to belong to the article."""
        out: list[np.ndarray] = [np.zeros(0)] * len(pages)
        order = sorted((i for i, p in enumerate(pages) if len(p.numbers)), key=lambda i: len(pages[i].numbers))
        low = 0
        while low < len(order):
            # Pages of like length together, as many as make a bounded matrix.
            high = low + 1
            while high < len(order) and (high - low + 1) * len(pages[order[high]].numbers) <= 8192:
                high += 1
            chosen = order[low:high]
            lengths = np.array([len(pages[i].numbers) for i in chosen])
            p = self._forward(self._inputs([pages[i] for i in chosen]), lengths)[0]
            for i, n, row in zip(chosen, lengths, p, strict=True):
                out[i] = row[:n]
            low = high
        return out

    def gradients(self, pages: list[Features], labels: list[np.ndarray], kept: list) -> dict[str, np.ndarray]:
        lengths = np.array([len(p.numbers) for p in pages])
        x = self._inputs(pages, kept)
        p, states, mask, turn, turned, steps_ahead, steps_back = self._forward(x, lengths)
        error = np.zeros(p.shape, dtype=np.float32)
        for i, label in enumerate(labels):
            error[i, : len(label)] = (p[i, : len(label)] - label) / lengths.sum()
        h = self.shape.hidden
        grad = error[:, :, None] * self.weights["out"]
        into = {"out": np.einsum("bth,bt->h", states, error), "bias": error.sum(keepdims=True)[0]}
        dx = self._run_back("ahead", x, steps_ahead, grad[:, :, :h], into)
        back = self._run_back("back", turned, steps_back, np.take_along_axis(grad[:, :, h:], turn, axis=1), into)
        dx = dx + np.take_along_axis(back, turn, axis=1)
        width = self.shape.width
        into["path"], into["word"] = np.zeros_like(self.weights["path"]), np.zeros_like(self.weights["word"])
        for i, page in enumerate(pages):
            np.add.at(into["path"], page.path, (dx[i, :, :width][page.path_of]) * kept[i][0][page.path_of, None])
            share = kept[i][1] / np.maximum(np.bincount(page.word_of, minlength=len(page.numbers)), 1)
            np.add.at(into["word"], page.word, dx[i, :, width : 2 * width][page.word_of] * share[page.word_of, None])
        return into


def train(pages: list[str], shape: Shape | None = None, copies: int = 3) -> Labeller | None:
    """Fit on the pages that name their article, and on `copies` variants of each; None if there are none."""
    shape = shape or Shape()
    rng = np.random.Generator(np.random.PCG64(shape.seed))
    known: list[tuple[list[Block], np.ndarray]] = []
    for page in pages:
        found = blocks(page)
        labels = marked(found) if found else None
        if labels is not None and labels.any():
            known.append((found, labels))
    if not known:
        return None
    every = known + [_varied(found, labels, rng) for found, labels in known for _ in range(copies)]
    read = [(features(found, shape), labels) for found, labels in every]
    labeller = Labeller(shape)
    moments = {k: (np.zeros_like(w), np.zeros_like(w)) for k, w in labeller.weights.items()}
    step = 0
    for _ in range(shape.epochs):
        # Pages of about the same length go together, the batches in random order.
        order = np.argsort([len(y) * rng.uniform(0.8, 1.25) for _, y in read])
        for low in shape.batch * rng.permutation(-(-len(order) // shape.batch)):
            chosen = [read[i] for i in order[low : low + shape.batch]]
            # Now and then a block is seen without its path or without its words.
            kept = [tuple((rng.random(len(y)) > drop).astype(np.float32) for drop in (0.05, 0.3)) for _, y in chosen]
            grads = labeller.gradients([x for x, _ in chosen], [y for _, y in chosen], kept)
            step += 1
            for name, grad in grads.items():
                m, v = moments[name]
                m *= 0.9
                m += 0.1 * grad
                v *= 0.999
                v += 0.001 * grad**2
                labeller.weights[name] -= shape.rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return labeller


def main_text(pages: DataFrame, sample_pages: int = 500, shape: Shape | None = None) -> DataFrame:
    """(page_id, url, text, n_chars, n_blocks, n_kept) for each row.

    `text` holds the blocks labelled as article, in page order, one a line; character references are decoded and
    white space in a block is one blank. A null or empty page and one without article blocks have an empty text. The
    network is trained on about `sample_pages` rows, drawn by a digest of the page; if none of them names its
    article, every block that no name marks as frame is kept. Malformed markup is read as far as it goes. Repeated rows
    get equal results, an empty table gives an empty result, other columns are not read.
    """
    n = pages.count()
    spread = F.pmod(F.xxhash64(F.lit("html"), F.col("page_id"), F.col("url")), F.lit(1 << 30)) / float(1 << 30)
    chosen = pages.filter(F.col("html").isNotNull() & (spread < min(1.0, sample_pages / max(n, 1)))).select("html")
    labeller = train(sorted(r.html for r in chosen.collect()), shape)
    sent = pages.sparkSession.sparkContext.broadcast(labeller)

    def extracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        labeller = sent.value
        for batch in batches:
            for low in range(0, len(batch), 512):
                part = batch.slice(low, 512)
                found = [blocks(page.as_py()) for page in part.column(2)]
                if labeller is None:
                    keep = [[not any({t, *n} & FRAME_NAMES for t, n in b.path) for b in page] for page in found]
                else:
                    keep = [p >= 0.5 for p in labeller.probabilities([features(page, labeller.shape) for page in found])]
                texts = ["\n".join(b.text for b, k in zip(page, ks, strict=True) if k) for page, ks in zip(found, keep, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array(texts, pa.string()),
                        pa.array([len(t) for t in texts], pa.int64()),
                        pa.array([len(page) for page in found], pa.int64()),
                        pa.array([int(np.sum(k)) for k in keep], pa.int64()),
                    ],
                    names=["page_id", "url", "text", "n_chars", "n_blocks", "n_kept"],
                )

    slim = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), whole_text(F.col("html")).alias("html"))
    return slim.mapInArrow(extracted, "page_id long, url string, text string, n_chars long, n_blocks long, n_kept long")
