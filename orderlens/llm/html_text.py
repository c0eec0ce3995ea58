"""HTML extraction (operator 4): a recurrent block labeller.

A page is cut into blocks: runs of text between block-level tags, without scripts, styles,
comments and the like. Each block becomes a vector of its hashed tag path (tags, and words of
class, id and role), its hashed words and a few numbers. A bidirectional LSTM in numpy reads
the page's blocks in both directions, so each block is labelled, main text or not, in the
light of the whole page.

There are no hand labels. The network is trained on at most ``SAMPLE`` pages (smallest hashed
ids), labelled by their structure where that is plain (inside article or main, and not inside
menus, headers, footers, sidebars, adverts, forms or comments), and on copies of them with
other boilerplate planted in them and with their sectioning tags made plain, so it learns
from place, length and neighbours too. Its weights (about 60 kB) are sent to the tasks.

Defined results: a null or empty page has an empty text; so has a page without main text;
broken markup is read leniently (a stray < is text, open tags end with their parent);
repeated rows get equal results; a null id stays null; extra columns are ignored; an empty
table gives an empty result. Pages are labelled whole, whatever their length.
"""

from __future__ import annotations

import html as entities
import random
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ship

SAMPLE = 500
PATH_DIM, WORD_DIM, NUMBERS = 64, 48, 7
DIM = PATH_DIM + WORD_DIM + NUMBERS
HIDDEN = 16
EPOCHS = 16

#: Fixed values of HTML: elements that break a text into blocks, that hold no text, and that never nest.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody td tfoot th thead title tr ul".split()
)
RAW = ("script", "style", "textarea", "title", "iframe", "noscript", "xmp")
SILENT = frozenset("template svg math object head select button option canvas audio video".split())
VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())
#: Words in tags, classes and ids that tell main text or boilerplate in the training labels.
MAIN = frozenset("article main".split())
OTHER = frozenset(
    "nav menu header footer aside sidebar ad ads advert advertisement banner sponsor cookie notice consent alert form comment comments reply share social breadcrumb related newsletter".split()
)

_NAME = re.compile(r"<(/?)([A-Za-z][A-Za-z0-9:-]*)")
_VALUE = re.compile(r"=\s*([\"'])")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_PART = re.compile(r"[a-z]+")


@dataclass
class Block:
    path: tuple[str, ...]  # open elements, outermost first; names of class, id and role after a dot
    text: str
    links: int  # characters inside links


class Markup:
    """Reads a page from left to right, in time proportional to its length."""

    def __init__(self, page: str):
        self.page = page
        self.at = 0
        self.sections = True
        self.broken = False  # a quoted value without an end was met: quotes count no more

    def _tag_end(self, at: int) -> int:
        """Where a tag ends whose name ends at ``at``; -1 if nowhere. Quotes count at the start of a value only."""
        page, begin = self.page, at
        while not self.broken:
            close = page.find(">", at)
            if close < 0:
                break
            quote = _VALUE.search(page, at, close)
            if quote is None:
                return close + 1
            at = page.find(quote[1], quote.end()) + 1
            if not at:
                self.broken = True
        if not self.broken:  # a quote holds the last >: none follows outside of quotes
            self.broken = True
        return page.find(">", begin) + 1 or -1

    def next(self) -> tuple[str, str, str, str]:
        """(kind, closing, name, rest): kind "text" (rest is the text), "tag" (rest holds the attributes) or "none"."""
        page, at = self.page, self.at
        lt = page.find("<", at)
        if lt != at:
            self.at = lt if lt >= 0 else len(page)
            return "text", "", "", page[at : self.at]
        if page.startswith("<!--", at):
            end = page.find("-->", at + 4)
            self.at = end + 3 if end >= 0 else len(page)
            return "none", "", "", ""
        if self.sections and page.startswith("<![CDATA[", at):
            end = page.find("]]>", at + 9)
            if end >= 0:
                self.at = end + 3
                return "text", "", "", page[at + 9 : end]
            self.sections = False  # nor does a later one end
        name = _NAME.match(page, at)
        if name or page[at + 1 : at + 2] in ("!", "?"):
            end = self._tag_end(name.end()) if name else page.find(">", at) + 1 or -1
            if end > 0:
                self.at = end
                return ("tag", name[1], name[2], page[name.end() : end - 1]) if name else ("none", "", "", "")
            self.at = len(page)  # no > follows: whatever comes is text
            return "text", "", "", page[at:]
        self.at = at + 1
        return "text", "", "", "<"


def blocks_of(page) -> list[Block]:
    """Blocks of a page in order: white space runs made one space, character references decoded."""
    if not isinstance(page, str) or not page:
        return []
    out: list[Block] = []
    stack: list[tuple[str, tuple[str, ...]]] = []
    parts: list[str] = []
    links = silent = linked = 0
    silent_name = ""

    def flush() -> None:
        nonlocal parts, links
        if parts:
            text = " ".join(entities.unescape("".join(parts)).split())
            if text:
                path = tuple(x for name, names in stack for x in (name, *("." + w for w in names)))
                out.append(Block(path, text, links))
        parts, links = [], 0

    markup = Markup(page)
    while markup.at < len(page):
        kind, closing, name, attributes = markup.next()
        if kind == "text":
            if not silent:
                parts.append(attributes)
                links += len(attributes) if linked else 0
            continue
        if kind == "none":
            continue
        name = name.lower()
        if name in RAW and not closing:  # its content is no markup
            end = _RAW_END[name].search(page, markup.at)
            markup.at = end.end() if end else len(page)
            continue
        if silent:
            if name == silent_name:
                silent += -1 if closing else 1
            elif name == "body" and silent_name == "head":
                silent = 0
            if silent:
                continue
            if closing:
                continue
        if name in VOID:
            if name == "hr":
                flush()
            elif name != "wbr":  # a place for a line break, no space
                parts.append(" ")
            continue
        if name in SILENT and not closing:
            if not attributes.rstrip().endswith("/"):
                if name in BLOCK:
                    flush()
                silent, silent_name = 1, name
            continue
        if name == "a":
            linked = 0 if closing else 1
            continue
        if name not in BLOCK:
            continue
        flush()
        if closing:
            for k in range(len(stack) - 1, -1, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    break
            continue
        while stack and stack[-1][0] == "p":  # a paragraph ends where the next block begins
            stack.pop()
        if name == "li" and stack and stack[-1][0] == "li":
            stack.pop()
        names = tuple(w for a in _NAMES.findall(attributes) for w in _PART.findall("".join(a).lower())) if attributes else ()
        stack.append((name, names))
    flush()
    return out


def structural_label(b: Block) -> int:
    names = [p.lstrip(".") for p in b.path]
    at = max((i for i, n in enumerate(names) if n in MAIN), default=-1)
    return int(at >= 0 and not any(n in OTHER for n in names[at:]))


def _hash(text: str, n: int) -> tuple[int, float]:
    h = zlib.crc32(text.encode("utf-8", "surrogatepass"))
    return h % n, 1.0 if h & 0x10000 else -1.0


class Vectors:
    """Vectors of blocks, with bounded caches of hashed names and words."""

    def __init__(self):
        self.paths: dict[tuple[str, ...], np.ndarray] = {}
        self.words: dict[str, int] = {}

    def path(self, path: tuple[str, ...]) -> np.ndarray:
        got = self.paths.get(path)
        if got is None:
            if len(self.paths) > 50_000:
                self.paths.clear()
            got = np.zeros(PATH_DIM, np.float32)
            for name in set(path):
                at, sign = _hash(name, PATH_DIM)
                got[at] += sign
            self.paths[path] = got
        return got

    def page(self, blocks: list[Block]) -> np.ndarray:
        n = len(blocks)
        x = np.zeros((n, DIM), np.float32)
        if len(self.words) > 200_000:
            self.words.clear()
        get = self.words.get
        for i, b in enumerate(blocks):
            x[i, :PATH_DIM] = self.path(b.path)
            words = b.text.split()
            ids = [get(w) for w in words]
            if None in ids:
                for k, w in enumerate(ids):
                    if w is None:
                        ids[k] = self.words[words[k]] = _hash(words[k].lower(), WORD_DIM)[0]
            x[i, PATH_DIM : PATH_DIM + WORD_DIM] = np.bincount(ids, minlength=WORD_DIM) / (1.0 + len(ids)) ** 0.5
            size = len(b.text)
            x[i, PATH_DIM + WORD_DIM :] = (
                np.log1p(len(words)) / 3, b.links / size, i / n, (n - i) / n, b.text[-1] in ".!?…»\"", sum(map(b.text.count, ".,;:")) / (1 + len(words)), 1.0,
            )
        return x


# The network ---------------------------------------------------------------------------


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def init(seed: int = 3) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    w = {}
    for d in "fb":
        w[f"x{d}"] = rng.normal(0, DIM**-0.5, (DIM, 4 * HIDDEN))
        w[f"h{d}"] = rng.normal(0, HIDDEN**-0.5, (HIDDEN, 4 * HIDDEN))
        w[f"c{d}"] = np.concatenate([np.zeros(HIDDEN), np.ones(HIDDEN), np.zeros(2 * HIDDEN)])
    w["o"] = rng.normal(0, 0.1, 2 * HIDDEN)
    w["d"] = np.zeros(1)
    return w


def _run(w: dict[str, np.ndarray], x: np.ndarray, live: np.ndarray, d: str, tape: list | None) -> np.ndarray:
    """One direction over padded pages: x is (pages, steps, DIM), live is (pages, steps)."""
    pages, steps, _ = x.shape
    z_x = x @ w[f"x{d}"] + w[f"c{d}"]
    h, c = np.zeros((pages, HIDDEN)), np.zeros((pages, HIDDEN))
    out = np.zeros((pages, steps, HIDDEN))
    for t in range(steps) if d == "f" else range(steps - 1, -1, -1):
        z = z_x[:, t] + h @ w[f"h{d}"]
        i, f, o = (_sigmoid(z[:, k * HIDDEN : (k + 1) * HIDDEN]) for k in range(3))
        g = np.tanh(z[:, 3 * HIDDEN :])
        on = live[:, t, None]
        new = f * c + i * g
        s = np.tanh(new)
        if tape is not None:
            tape.append((t, h, c, i, f, o, g, s, on))
        c = np.where(on, new, c)
        h = np.where(on, o * s, h)
        out[:, t] = h
    return out


def forward(w: dict[str, np.ndarray], x: np.ndarray, live: np.ndarray, tapes: dict | None = None) -> np.ndarray:
    """Probability of main text for each block."""
    both = [_run(w, x, live, d, tapes.setdefault(d, []) if tapes is not None else None) for d in "fb"]
    h = np.concatenate(both, axis=2)
    if tapes is not None:
        tapes["h"] = h
    return _sigmoid(h @ w["o"] + w["d"][0])


def gradients(w: dict[str, np.ndarray], x: np.ndarray, live: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
    """Cross entropy by block and its gradients, by backpropagation through time."""
    tapes: dict = {}
    p = forward(w, x, live, tapes)
    n = live.sum()
    loss = -(np.log(np.where(y > 0, p, 1 - p) + 1e-12) * live).sum() / n
    dz = (p - y) * live / n
    g = {"o": np.einsum("pt,pth->h", dz, tapes["h"]), "d": np.array([dz.sum()])}
    dh_all = dz[:, :, None] * w["o"]
    for k, d in enumerate("fb"):
        own = dh_all[:, :, k * HIDDEN : (k + 1) * HIDDEN]
        gz = np.zeros((*x.shape[:2], 4 * HIDDEN))
        gh = np.zeros_like(w[f"h{d}"])
        dh, dc = np.zeros(own[:, 0].shape), np.zeros(own[:, 0].shape)
        for t, h0, c0, i, f, o, c_in, s, on in reversed(tapes[d]):
            dh = dh + own[:, t]
            a, b = dh * on, dc * on
            b = b + a * o * (1 - s**2)
            z = np.concatenate([b * c_in * i * (1 - i), b * c0 * f * (1 - f), a * s * o * (1 - o), b * i * (1 - c_in**2)], axis=1)
            gz[:, t] = z
            gh += h0.T @ z
            dh = dh * ~on + z @ w[f"h{d}"].T
            dc = dc * ~on + b * f
        g[f"x{d}"] = np.einsum("ptd,ptk->dk", x, gz)
        g[f"h{d}"] = gh
        g[f"c{d}"] = gz.sum(axis=(0, 1))
    return loss, g


def padded(pages: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    steps = max(map(len, pages))
    x = np.zeros((len(pages), steps, DIM))
    live = np.zeros((len(pages), steps), dtype=bool)
    for k, p in enumerate(pages):
        x[k, : len(p)] = p
        live[k, : len(p)] = True
    return x, live


# Training ------------------------------------------------------------------------------


def _say(rng: random.Random, words: list[str], low: int, high: int) -> str:
    return " ".join(rng.choice(words) for _ in range(rng.randint(low, high)))


def planted(rng: random.Random, blocks: list[Block], labels: list[int]) -> tuple[list[Block], list[int]]:
    """A copy of a page with boilerplate planted in it, and at times with plain sectioning tags."""
    words = [w for b in blocks for w in b.text.split()[:40]] or ["text"]
    plain = rng.random() < 0.4
    rename = {n: "div" for n in ("article", "main", "section")} if plain else {}
    keep_name = f".{rng.choice(('content', 'post', 'entry', 'story', 'body'))}"
    new: list[tuple[Block, int]] = []
    for b, y in zip(blocks, labels, strict=True):
        path: tuple[str, ...] = ()
        for p in b.path:
            path += (rename[p], keep_name) if p in rename else (p,)
        new.append((Block(path, b.text, b.links), y))
    first = next((i for i, (_, y) in enumerate(new) if y), len(new))
    last = max((i for i, (_, y) in enumerate(new) if y), default=-1) + 1
    inner = new[first][0].path[:-1] if first < len(new) else ("html", "body")
    kinds: list[tuple[int, tuple[str, ...], int, int, int, bool]] = [
        (first, ("html", "body", "header"), 1, 6, 2, True),
        (first, ("html", "body", "div", ".cookie", ".notice", "p"), 6, 25, 1, False),
        (last, ("html", "body", "aside", ".sidebar", "ul", "li"), 2, 9, 4, True),
        (last, ("html", "body", "div", ".comments", "div", ".comment", "p"), 5, 60, 3, False),
        (last, ("html", "body", "section", ".comments", "p"), 5, 60, 3, False),
        (last, ("html", "body", "form", ".newsletter", "p"), 3, 12, 2, False),
        (last, ("html", "body", "div", ".related", "ul", "li"), 3, 9, 4, True),
        (first, ("html", "body", "div", ".banner"), 3, 15, 1, False),
        ((first + last) // 2, (*inner, "div", ".ad"), 3, 15, 1, False),
        ((first + last) // 2, (*inner, "aside", "p"), 3, 25, 1, False),
        (last, (*inner, "div", ".share", ".social"), 1, 5, 2, True),
        (last, (*inner, "footer", "p"), 3, 12, 1, False),
        (last, (*inner, "form", "p"), 3, 12, 1, False),
        (last, (*inner, "div", ".comments", "p"), 5, 60, 3, False),
    ]
    extra: list[tuple[int, Block]] = []
    for at, path, low, high, most, link in rng.sample(kinds, rng.randint(1, 5)):
        for _ in range(rng.randint(1, most)):
            text = _say(rng, words, low, high)
            extra.append((at, Block(path, text, len(text) if link else 0)))
    for at, b in sorted(extra, key=lambda e: -e[0]):
        new.insert(at, (b, 0))
    return [b for b, _ in new], [y for _, y in new]


def fit(pages: list[str], seed: int = 11, epochs: int = EPOCHS) -> dict[str, np.ndarray]:
    """Train on pages by structural labels and on planted copies, with Adam."""
    rng = random.Random(seed)
    vectors = Vectors()
    data: list[tuple[np.ndarray, np.ndarray]] = []
    for page in pages:
        blocks = blocks_of(page)
        if not blocks:
            continue
        labels = [structural_label(b) for b in blocks]
        if not any(labels):  # a page whose structure tells nothing teaches nothing
            continue
        for own, y in [(blocks, labels), planted(rng, blocks, labels), planted(rng, blocks, labels)]:
            data.append((vectors.page(own), np.array(y, dtype=float)))
    w = init()
    if not data:
        return w
    data.sort(key=lambda d: len(d[0]))
    m1, m2 = ({k: np.zeros_like(v) for k, v in w.items()} for _ in range(2))
    gen = np.random.default_rng(seed)
    parts = [data[a : a + 32] for a in range(0, len(data), 32)]
    step = 0
    for _ in range(epochs):
        for k in gen.permutation(len(parts)):
            x, live = padded([d for d, _ in parts[k]])
            y = np.zeros(live.shape)
            for r, (_, own) in enumerate(parts[k]):
                y[r, : len(own)] = own
            _, g = gradients(w, x, live, y)
            step += 1
            for name in w:
                m1[name] += 0.1 * (g[name] - m1[name])
                m2[name] += 0.01 * (g[name] ** 2 - m2[name])
                w[name] -= 0.01 * (m1[name] / (1 - 0.9**step)) / (np.sqrt(m2[name] / (1 - 0.99**step)) + 1e-8)
    return w


def train(pages: DataFrame, sample: int = SAMPLE) -> dict[str, np.ndarray]:
    """Fit on the ``sample`` pages with the smallest hashed ids (bounded, so sent to the driver)."""
    ship(pages.sparkSession)
    ids = pages.where("page_id is not null").select("page_id").distinct().orderBy(F.xxhash64("page_id", F.lit(9)), "page_id").limit(sample)
    rows = pages.join(F.broadcast(ids), "page_id").groupBy("page_id").agg(F.min("html").alias("html")).collect()
    return fit([r["html"] for r in sorted(rows, key=lambda r: r["page_id"]) if r["html"]])


# Extraction ----------------------------------------------------------------------------


def extract_batch(w: dict[str, np.ndarray], vectors: Vectors, pages: list) -> list[str]:
    """Main text of each page; pages of like length go through the network together."""
    blocks = [blocks_of(p) for p in pages]
    out = [""] * len(pages)
    order = sorted((i for i in range(len(pages)) if blocks[i]), key=lambda i: len(blocks[i]))
    at = 0
    while at < len(order):
        # At most about 8,000 padded blocks in one pass.
        size = 1
        while at + size < len(order) and size < 256 and (size + 1) * len(blocks[order[at + size]]) <= 8_000:
            size += 1
        some = order[at : at + size]
        x, live = padded([vectors.page(blocks[i]) for i in some])
        p = forward(w, x, live)
        for k, i in enumerate(some):
            out[i] = "\n\n".join(b.text for b, q in zip(blocks[i], p[k], strict=False) if q >= 0.5)
        at += size
    return out


def extract(pages: DataFrame, w: dict[str, np.ndarray]) -> DataFrame:
    """page_id, url, text for every row of ``pages`` (page_id, url, html)."""
    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors = Vectors()
        for batch in batches:
            for at in range(0, batch.num_rows, 1_000):
                part = batch.slice(at, 1_000)
                text = pa.array(extract_batch(w, vectors, part.column(2).to_pylist()), pa.string())
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), text], names=["page_id", "url", "text"])

    schema = StructType([pages.schema["page_id"], pages.schema["url"], *StructType.fromDDL("text string").fields])
    return pages.select("page_id", "url", "html").mapInArrow(run, schema)
