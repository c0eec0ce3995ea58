"""Secret scan (operator 2): base patterns and a linear-chain CRF.

Base spans come from three patterns (:data:`BASE`). A conditional random field then tags
each token as the begin of a secret (B), inside one (I) or outside (O), and decodes the best
tag sequence by Viterbi; tagged spans that overlap no base span are added under the kind
``crf``. Emission scores add weights of the token's shape, of its neighbours (three before,
one after) and of the file (language, share of digits); transitions have a weight for each
pair of tags.

The field is trained on token windows of at most ``SAMPLE`` documents (smallest hashed ids),
labelled by the base patterns, and on copies of these windows with generated secrets of
other forms planted in them; the weights are a small broadcast table.

Decoding is exact and cheap: what a visit to B and I can gain over O is bounded by the
scores of its tokens, and over tokens that lie in no interval of positive gain the path
that stays in O is the best one, so Viterbi runs only over the stretches between them.

Defined results: null text counts as empty; repeated rows get equal spans; a null id stays
null; null language counts as its own value; extra columns are ignored by :func:`scan` and
kept by :func:`redact`; an empty table gives an empty result.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import ship

#: Kind, pattern, group that is the secret, least length, in the order of kinds.
BASE: tuple[tuple[str, re.Pattern, int, int], ...] = (
    ("assign", re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII), 2, 8),
    ("access", re.compile(r"AKIA[A-Z0-9]+"), 0, 16),
    ("hex", re.compile(r"[0-9a-f]+"), 0, 32),
)
KINDS = (*[k for k, *_ in BASE], "crf")

#: Documents whose windows train the field, windows of one document, tokens beside a span.
SAMPLE = 3_000
WINDOWS = 3
SIDE = 24
EPOCHS = 30
#: Windows without a base span that are kept for training.
PLAIN = 500

#: The long-run test of the hex pattern needs no scan of every short run.
_HEX = re.compile(r"[0-9a-f]{32,}")
#: A text that holds none of these, lower-cased, has no assignment.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_TOKEN = re.compile(r"\w+|[^\w\s]")
O, B, I = 0, 1, 2  # noqa: E741
_KEYWORDS = frozenset(
    "password passwd pwd pass secret token api key apikey api_key access_key secret_key auth authorization bearer credential private client_secret".split()
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, end, kind number) of the base patterns, by start, then kind."""
    out = []
    low = text.lower()
    for k, (name, pattern, group, least) in enumerate(BASE):
        if name == "assign" and not any(w in low for w in _ASSIGN_WORDS) or name == "access" and "AKIA" not in text:
            continue
        for m in (_HEX if name == "hex" else pattern).finditer(text):
            if m.end(group) - m.start(group) >= least:
                out.append((m.start(group), m.end(group), k))
    return sorted(out, key=lambda s: (s[0], s[2]))


def shape(token: str) -> str:
    """A token's features as one signature, of a bounded number of values."""
    low = token.lower()
    if len(token) == 1 and not token.isalnum() and token != "_":
        return f"p{token}" if token in "\"'`=:;,.-/+()[]{}<>@#$%&*!?\\|~^" else "p"
    if low in _KEYWORDS:
        return f"k{low}"
    digits = sum(c.isdigit() for c in token)
    n = len(token)
    kind = (
        "d" if digits == n
        else "h" if digits and all(c in "0123456789abcdef" for c in token)
        else "H" if digits and all(c in "0123456789ABCDEF" for c in token)
        else "m" if digits and token.isascii() and token != low and token != token.upper()
        else "x" if digits and token.isascii() and token == token.upper()
        else "a" if digits
        else "l" if token == low
        else "U" if token == token.upper()
        else "C" if token[1:] == low[1:]
        else "M"
    )
    size = next(s for s, most in enumerate((2, 4, 7, 11, 15, 19, 23, 31, 39, 63, 10**9)) if n <= most)
    flips = sum(a.isdigit() != b.isdigit() for a, b in zip(token, token[1:], strict=False))
    return f"{kind}{size}{min(flips, 3)}{'A' if token[:4] == 'AKIA' else ''}{'_' if '_' in token else ''}"


def neighbour(signature: str) -> str:
    """What a token tells its neighbours: keyword, punctuation or coarse shape."""
    return signature if signature[0] in "pk" else signature[0]


def file_features(lang, tokens: int, digits: int) -> list[str]:
    share = digits / max(tokens, 1)
    return [f"lang={lang if lang in ('en', 'de', 'fr', 'es') else 'other'}", f"digits={sum(share > x for x in (0.0, 0.005, 0.02, 0.1))}"]


@dataclass
class Field:
    """Weights: tables of (signature or feature) to a score for each tag, and transitions."""

    own: dict[str, np.ndarray]
    near: list[dict[str, np.ndarray]]  # of the tokens 3, 2 and 1 before, and 1 after
    file: dict[str, np.ndarray]
    trans: np.ndarray  # from, to
    start: np.ndarray

    def emissions(self, signatures: list[str], file: list[str]) -> np.ndarray:
        zero = np.zeros(3)
        n = len(signatures)
        e = np.array([self.own.get(s, zero) for s in signatures]).reshape(n, 3)
        close = [neighbour(s) for s in signatures]
        for off, tab in zip(OFFSETS, self.near, strict=True):
            x = np.array([tab.get(s, zero) for s in close]).reshape(n, 3)
            if off < 0:
                e[-off:] += x[:off] if n > -off else 0
            else:
                e[:-off] += x[off:] if n > off else 0
        return e + sum((self.file.get(f, zero) for f in file), zero)


OFFSETS = (-3, -2, -1, 1)


def viterbi(e: np.ndarray, trans: np.ndarray, start: np.ndarray, final: np.ndarray) -> np.ndarray:
    """Best tags of one stretch, given the scores of its first and after its last tag."""
    n = len(e)
    score = e[0] + start
    back = np.zeros((n, 3), dtype=np.int8)
    for t in range(1, n):
        through = score[:, None] + trans
        back[t] = through.argmax(axis=0)
        score = through.max(axis=0) + e[t]
    tags = np.zeros(n, dtype=np.int8)
    tags[-1] = (score + final).argmax()
    for t in range(n - 1, 0, -1):
        tags[t - 1] = back[t, tags[t]]
    return tags


def decode(e: np.ndarray, trans: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Viterbi over a whole document, skipping tokens that are surely O.

    Against staying in O, a visit to B and I over tokens s..t gains at most the sum of their
    shares; a share is the token's best advantage over O, plus the best transition into B or
    I and the best way back, over O to O. So a token that lies in no interval with a positive
    sum of shares is O in a best path. These tokens cut the rest into independent stretches.
    """
    n = len(e)
    tags = np.zeros(n, dtype=np.int8)
    if not n:
        return tags
    stay = trans[O, O]
    into = max(trans[:, 1:].max() - stay, (start[1:] - start[O]).max())
    leave = max(0.0, (trans[1:, O] - stay).max())
    share = e[:, 1:].max(axis=1) - e[:, O] + into + leave
    if share.max() <= 0:
        return tags
    upto = np.concatenate(([0.0], np.cumsum(share)))
    left = upto[1:] - np.minimum.accumulate(upto[:-1])
    right = np.maximum.accumulate(upto[:0:-1])[::-1] - upto[:-1]
    open_ = np.flatnonzero(left + right - share > 0)
    cut = np.flatnonzero(np.diff(open_) > 1)
    for a, z in zip(open_[np.append(0, cut + 1)], open_[np.append(cut, len(open_) - 1)] + 1, strict=True):
        tags[a:z] = viterbi(e[a:z], trans, trans[O] if a else start, trans[:, O] if z < n else np.zeros(3))
    return tags


def tag_spans(tags: np.ndarray, tokens: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Character spans of the tagged secrets; an I that follows O begins one too."""
    out: list[list[int]] = []
    for i in np.flatnonzero(tags).tolist():
        if out and i and tags[i - 1] and tags[i] == I:
            out[-1][1] = tokens[i][1]
        else:
            out.append([tokens[i][0], tokens[i][1]])
    return [(a, z) for a, z in out]


def apart(spans: list[tuple[int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none of ``base`` (sorted by start), by one search each."""
    starts = [x for x, _, _ in base]
    ends = list(accumulate((y for _, y, _ in base), max))  # the furthest end of the base spans so far
    out = []
    for a, z in spans:
        before = bisect_left(starts, z)
        if not before or ends[before - 1] <= a:
            out.append((a, z))
    return out


# Training -----------------------------------------------------------------------------


def windows_of(text: str, lang) -> list[tuple[list[str], list[int], list[str]]]:
    """Token windows of a document: tokens, base tags, file features."""
    found = [(m.start(), m.end()) for m in _TOKEN.finditer(text)]
    if not found:
        return []
    tokens = [text[a:z] for a, z in found]
    tags = [O] * len(tokens)
    starts = np.array([a for a, _ in found])
    centres = []
    for a, z, _ in base_spans(text):
        i, j = np.searchsorted(starts, a), np.searchsorted(starts, z)
        if i < j and tags[i] == O:
            tags[i] = B
            tags[i + 1 : j] = [I] * (j - i - 1)
            centres.append((i + j) // 2)
    file = file_features(lang, len(tokens), sum(t.isdigit() for t in tokens))
    centres = centres[:WINDOWS] or [len(tokens) // 2]
    out = []
    for c in centres:
        a, z = max(0, c - SIDE), c + SIDE
        out.append((tokens[a:z], tags[a:z], file))
    return out


_ALNUM = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"


def planted(rng: random.Random, window: tuple[list[str], list[int], list[str]]) -> tuple[list[str], list[int], list[str]]:
    """A copy of a window with a generated secret at some place."""
    tokens, tags, file = window
    value = rng.choice((
        lambda: "".join(rng.choice("0123456789abcdef") for _ in range(rng.choice((24, 28, 32, 40, 64)))),
        lambda: "".join(rng.choice(_ALNUM) for _ in range(rng.randint(12, 40))),
        lambda: "AKIA" + "".join(rng.choice(_ALNUM[:26] + _ALNUM[52:]) for _ in range(16)),
        lambda: "ghp_" + "".join(rng.choice(_ALNUM) for _ in range(36)),
        lambda: "/".join("".join(rng.choice(_ALNUM) for _ in range(rng.randint(10, 20))) for _ in range(2)),
    ))()
    lead = rng.choice(("pwd = \"", "password: ", "Authorization: Bearer ", "client_secret = '", "api key = ", "credential: \"", "access_key=", "private key: "))
    before, inside = _TOKEN.findall(lead), _TOKEN.findall(value)
    free = [i for i in range(len(tokens) + 1) if i == len(tokens) or tags[i] != I]
    at = rng.choice(free)
    quote = before[-1] if before[-1] in "\"'" else ""
    new = [*before, *inside, *([quote] if quote else [])]
    marks = [O] * len(before) + [B] + [I] * (len(inside) - 1) + [O] * bool(quote)
    return tokens[:at] + new + tokens[at:], tags[:at] + marks + tags[at:], file


def fit(windows: list[tuple[list[str], list[int], list[str]]], seed: int = 7, epochs: int = EPOCHS, ridge: float = 1e-3) -> Field:
    """Maximum likelihood by Adam on batches of padded windows (forward-backward)."""
    rng = random.Random(seed)
    filler = (["the", "value", "is", "given", "here", ".", "Order", "12345", "was", "sent", "on", "2024", ",", "see", "page", "17"], [O] * 16, file_features("en", 16, 3))
    windows = [*windows, filler]
    windows = windows + [planted(rng, w) for w in windows] + [planted(rng, w) for w in windows[: len(windows) // 2]]
    index: dict[tuple[str, str], int] = {}
    rows = []
    for tokens, tags, file in windows:
        sig = [shape(t) for t in tokens]
        close = [neighbour(s) for s in sig]
        feats = []
        for i, s in enumerate(sig):
            f = [("own", s)] + [("file", x) for x in file]
            f += [(f"near{o}", close[i + o]) for o in OFFSETS if 0 <= i + o < len(sig)]
            feats.append([index.setdefault(x, len(index)) for x in f])
        rows.append((feats, tags))
    width = max(len(f) for f, _ in rows)
    most = 1 + 2 + len(OFFSETS)
    none = len(index)
    x = np.full((len(rows), width, most), none, dtype=np.int64)
    y = np.zeros((len(rows), width), dtype=np.int64)
    size = np.array([len(f) for f, _ in rows])
    for r, (feats, tags) in enumerate(rows):
        for i, f in enumerate(feats):
            x[r, i, : len(f)] = f
        y[r, : len(tags)] = tags
    w, trans, start = np.zeros((none + 1, 3)), np.zeros((3, 3)), np.zeros(3)
    params = [w, trans, start]
    m1, m2 = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    gen = np.random.default_rng(seed)
    step = 0
    lse = lambda a, axis: np.log(np.exp(a - a.max(axis=axis, keepdims=True)).sum(axis=axis)) + a.max(axis=axis)
    for _ in range(epochs):
        for part in np.array_split(gen.permutation(len(rows)), max(1, len(rows) // 128)):
            xb, yb, nb = x[part], y[part], size[part]
            t_max = nb.max()
            xb, yb = xb[:, :t_max], yb[:, :t_max]
            live = np.arange(t_max)[None, :] < nb[:, None]
            e = w[xb].sum(axis=2)
            alpha = np.zeros((len(part), t_max, 3))
            alpha[:, 0] = start + e[:, 0]
            for t in range(1, t_max):
                nxt = lse(alpha[:, t - 1][:, :, None] + trans[None], 1) + e[:, t]
                alpha[:, t] = np.where(live[:, t, None], nxt, alpha[:, t - 1])
            z = lse(alpha[:, -1], 1)
            beta = np.zeros_like(alpha)
            for t in range(t_max - 2, -1, -1):
                prev = lse(trans[None] + (e[:, t + 1] + beta[:, t + 1])[:, None, :], 2)
                beta[:, t] = np.where(live[:, t + 1, None], prev, beta[:, t + 1])
            gamma = np.exp(alpha + beta - z[:, None, None]) * live[:, :, None]
            gold = np.eye(3)[yb] * live[:, :, None]
            diff = (gamma - gold) / len(part)
            gw = np.zeros_like(w)
            np.add.at(gw, xb.reshape(-1), np.repeat(diff.reshape(-1, 3), most, axis=0))
            gw[none] = 0
            pair = np.exp(alpha[:, :-1, :, None] + trans[None, None] + (e[:, 1:] + beta[:, 1:])[:, :, None, :] - z[:, None, None, None])
            both = live[:, 1:, None, None]
            gt = ((pair - gold[:, :-1, :, None] * gold[:, 1:, None, :]) * both).sum(axis=(0, 1)) / len(part)
            gs = (gamma[:, 0] - gold[:, 0]).sum(axis=0) / len(part)
            step += 1
            for p, g, a, b in zip(params, (gw + ridge * w, gt, gs), m1, m2, strict=True):
                a *= 0.9
                a += 0.1 * g
                b *= 0.99
                b += 0.01 * g * g
                p -= 0.05 * (a / (1 - 0.9**step)) / (np.sqrt(b / (1 - 0.99**step)) + 1e-8)
    w[none] = 0
    table: dict[str, dict[str, np.ndarray]] = {"own": {}, "file": {}, **{f"near{o}": {} for o in OFFSETS}}
    for (kind, name), i in index.items():
        table[kind][name] = w[i]
    return Field(table["own"], [table[f"near{o}"] for o in OFFSETS], table["file"], trans, start)


def train(docs: DataFrame, sample: int = SAMPLE) -> Field:
    """Fit the field on windows of the ``sample`` documents with the smallest hashed ids."""
    ship(docs.sparkSession)
    ids = docs.where("doc_id is not null").select("doc_id").distinct().orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id").limit(sample)
    # The sample is bounded by `sample` ids, so it may be broadcast; of rows that repeat an id the smallest serves.
    rows = docs.join(F.broadcast(ids), "doc_id").groupBy("doc_id").agg(F.min(F.struct("text", "lang")).alias("r")).select("doc_id", "r.text", "r.lang")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [
                (doc, t, bytes(y), f)
                for doc, text, lang in zip(*(c.to_pylist() for c in batch.columns), strict=True)
                for t, y, f in windows_of(text or "", lang)
            ]
            cols = list(zip(*got, strict=True)) if got else [[], [], [], []]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.list_(pa.string())), pa.array(cols[2], pa.binary()), pa.array(cols[3], pa.list_(pa.string()))],
                names=["doc_id", "tokens", "tags", "file"],
            )

    found = rows.mapInArrow(run, "doc_id long, tokens array<string>, tags binary, file array<string>").collect()
    found = sorted(found, key=lambda r: (r["doc_id"], r["tokens"]))
    windows = [(list(r["tokens"]), list(r["tags"]), list(r["file"])) for r in found]
    tagged, plain = [w for w in windows if any(w[1])], [w for w in windows if not any(w[1])]
    return fit(tagged + plain[:PLAIN])


# Scan ---------------------------------------------------------------------------------


class Scanner:
    """The field's tables by signature number, and a cache of tokens' signatures."""

    def __init__(self, field: Field):
        self.field = field
        self.number: dict[str, int] = {}
        self.names: list[str] = []
        self.of: dict[str, int] = {}
        self.own = np.zeros((0, 3))
        self.near = [np.zeros((0, 3)) for _ in OFFSETS]

    def ids(self, tokens: list[str]) -> np.ndarray:
        if len(self.of) > 300_000:
            self.of.clear()
        out = [self.of.get(t) for t in tokens]
        if None in out:
            for i, x in enumerate(out):
                if x is None:
                    s = shape(tokens[i])
                    if s not in self.number:
                        self.number[s] = len(self.names)
                        self.names.append(s)
                    out[i] = self.of[tokens[i]] = self.number[s]
            zero = np.zeros(3)
            fresh = self.names[len(self.own) :]
            self.own = np.vstack([self.own, *[self.field.own.get(s, zero) for s in fresh]])
            self.near = [np.vstack([a, *[t.get(neighbour(s), zero) for s in fresh]]) for a, t in zip(self.near, self.field.near, strict=True)]
        return np.array(out, dtype=np.int64)

    def added(self, text: str, lang, base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
        tokens = _TOKEN.findall(text)
        if not tokens:
            return []
        ids = self.ids(tokens)
        n = len(ids)
        e = self.own[ids]
        for off, tab in zip(OFFSETS, self.near, strict=True):
            if n > abs(off):
                if off < 0:
                    e[-off:] += tab[ids[:off]]
                else:
                    e[:-off] += tab[ids[off:]]
        file = file_features(lang, n, sum(map(str.isdigit, tokens)))
        for f in file:
            e += self.field.file.get(f, 0.0)
        tags = decode(e, self.field.trans, self.field.start)
        if not tags.any():
            return []
        spans = tag_spans(tags, [(m.start(), m.end()) for m in _TOKEN.finditer(text)])
        return [(a, z, len(BASE)) for a, z in apart(spans, base)]

    def spans(self, text, lang) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
        text = text or ""
        base = base_spans(text)
        return base, sorted(base + self.added(text, lang, base), key=lambda s: (s[0], s[2]))


def _join(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{z}" for a, z, k in spans)


def scan(docs: DataFrame, field: Field) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_crf, base (string), spans (string: all spans)."""
    ship(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(field)
        for batch in batches:
            counts, base, spans = [], [], []
            for text, lang in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                own, every = scanner.spans(text, lang)
                counts.append(np.bincount([k for *_, k in every], minlength=len(KINDS)))
                base.append(_join(own))
                spans.append(_join(every))
            n = np.array(counts).reshape(-1, len(KINDS))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(n[:, k], pa.int64()) for k in range(len(KINDS))], pa.array(base, pa.string()), pa.array(spans, pa.string())],
                names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "spans"],
            )

    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = StructType([docs.schema["doc_id"], *StructType.fromDDL(f"{counts}, base string, spans string").fields])
    return docs.select("doc_id", "text", "lang").mapInArrow(run, schema)


def redact(docs: DataFrame, field: Field, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each secret in ``text`` replaced by ``mark`` (null text stays null);
    ``n_chars``, if there, is counted anew. Other columns stay."""
    ship(docs.sparkSession)
    at, lang_at = docs.columns.index("text"), docs.columns.index("lang")
    chars = docs.columns.index("n_chars") if "n_chars" in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(field)
        for batch in batches:
            texts = []
            for text, lang in zip(batch.column(at).to_pylist(), batch.column(lang_at).to_pylist(), strict=True):
                if text:
                    kept, end = [], 0
                    for a, z, _ in scanner.spans(text, lang)[1]:
                        if a >= end:
                            kept += [text[end:a], mark]
                        end = max(end, z)
                    text = "".join([*kept, text[end:]])
                texts.append(text)
            cols = list(batch.columns)
            cols[at] = pa.array(texts, batch.schema.field(at).type)
            if chars is not None:
                cols[chars] = pa.array([None if t is None else len(t) for t in texts], batch.schema.field(chars).type)
            yield pa.RecordBatch.from_arrays(cols, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
