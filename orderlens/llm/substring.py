"""Substring dedup (operator 5): collinear chaining of shared k-mer seeds.

Finds passages that also stand, word for word or with small edits, in a document with a
smaller id, and removes the later ones.

1. *Seeds.* Of each ``WINDOW`` consecutive 5-word shingles the one with the smallest hash
   is a seed (one in five or six), so two equal passages of 24 words share two seeds at least.
   A seed carries a few bits of each of the words beside it.
2. *Matches.* A seed's first occurrence (smallest document, then position) is an aggregate;
   each later occurrence is joined to it, so matches grow with the seeds, not with pairs.
3. *Chains.* A document's matches with one earlier document are chained in order in both
   texts through Fenwick trees; gaps cost, and a match follows the best chain that ends within
   reach before it. A match without a chain counts where the words beside it agree, too: of an
   edited passage often one seed only survives.
4. *Alignment.* The words of a chain are aligned between its seeds and extended beyond its
   ends. Passages of at least ``min_words`` words with a similarity of 0.8 or more go.

Defined results: null and empty texts stay as they are; words are cut at 0x20 and
0x09-0x0D and compared with A-Z lower-cased; documents with null ids are kept whole; rows
that repeat an id don't remove one another's text, and each has spans of its own (a row is
known by id and text); other columns stay
(``n_chars`` is counted anew); an empty table gives an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import M1, M2, M3, Staged, mix64, sorted_groups
from .minhash import word_hashes, words_of

SHINGLE = 5
WINDOW = 10
#: A passage of 40 words still counts where a few words at its ends are changed.
MIN_WORDS = 36
SIMILARITY = 0.8
#: Words between neighbours of a chain at most, in either text.
MAX_GAP = 64
#: Cost of a word of gap, against 1 for a word that a seed matches.
GAP_COST = 0.05
#: Distances of the words beside a seed, before its first and after its last word, of which it carries 4 bits each,
#: and how many must agree for a match alone: words so far apart lie in one passage of some length, not in a line.
BESIDE = (6, 12, 18, 24)
AGREE = 3
#: A run of words is followed until its value, +1 for an equal word and -2 for another, has fallen by more than this.
FALL = 9
#: Words beside a chain that are looked at for its ends; whatever runs on beyond is exact
#: text, which has seeds of its own.
EXTEND = 48

_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def word_hash_array(text) -> np.ndarray:
    return word_hashes(words_of(text))


def beside(h: np.ndarray, at: np.ndarray, own: int) -> np.ndarray:
    """4 bits of each of the words beside the seeds; beyond the text's ends bits of ``own``."""
    far = BESIDE[-1]
    edge = mix64(np.full(far, own, np.int64).view(np.uint64) + np.arange(far, dtype=np.uint64))
    bits = (np.concatenate([edge, h, edge]) >> np.uint64(60)).astype(np.uint32)
    out = np.zeros(len(at), np.uint32)
    for k in (*(-d for d in BESIDE), *(SHINGLE - 1 + d for d in BESIDE)):
        out = (out << np.uint32(4)) | bits[at + far + k]
    return out.view(np.int32)


def seeds(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes and positions of a document's seeds."""
    n = len(h) - SHINGLE + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    x = np.zeros(n, np.uint64)
    for j in range(SHINGLE):
        x = x * M2 + h[j : j + n] * M1
        x ^= x >> np.uint64(31)
    x *= M3
    x ^= x >> np.uint64(32)
    if n <= WINDOW:
        at = np.array([int(x.argmin())])
        return x[at], at
    low = x
    span = 1
    while span * 2 <= WINDOW:
        low = np.minimum(low[:-span], low[span:])
        span *= 2
    if span < WINDOW:
        low = np.minimum(low[: len(low) - (WINDOW - span)], low[WINDOW - span :])
    # A shingle is a seed if it is the smallest of a window that holds it.
    padded = np.concatenate([np.zeros(WINDOW - 1, np.uint64), low, np.zeros(WINDOW - 1, np.uint64)])
    top = padded
    span = 1
    while span * 2 <= WINDOW:
        top = np.maximum(top[:-span], top[span:])
        span *= 2
    if span < WINDOW:
        top = np.maximum(top[: len(top) - (WINDOW - span)], top[WINDOW - span :])
    at = np.flatnonzero(top[:n] == x)
    return x[at], at


class Ascent:
    """A Fenwick tree of running maxima: the best (value, index) of the places up to one."""

    def __init__(self, size: int):
        self.best: list[tuple[float, int]] = [(-np.inf, -1)] * (size + 1)

    def put(self, at: int, item: tuple[float, int]) -> None:
        at += 1
        while at < len(self.best):
            if item > self.best[at]:
                self.best[at] = item
            at += at & -at

    def upto(self, at: int) -> tuple[float, int]:
        found = (-np.inf, -1)
        at += 1
        while at > 0:
            if self.best[at] > found:
                found = self.best[at]
            at -= at & -at
        return found


class Reach:
    """The best item of the places [at - reach, at - SHINGLE], by blocks of as many places: such a range is a block,
    or the end of one and the beginning of the next, so a tree from either side of each block answers it."""

    def __init__(self, reach: int):
        self.reach = reach
        self.width = reach - SHINGLE + 1
        self.blocks: dict[int, tuple[Ascent, Ascent]] = {}

    def put(self, at: int, item: tuple[float, int]) -> None:
        block, inside = divmod(at, self.width)
        trees = self.blocks.get(block)
        if trees is None:
            trees = self.blocks[block] = Ascent(self.width), Ascent(self.width)
        trees[0].put(inside, item)
        trees[1].put(self.width - 1 - inside, item)

    def before(self, at: int) -> tuple[float, int]:
        (low, a), (high, z) = divmod(at - self.reach, self.width), divmod(at - SHINGLE, self.width)
        found = self.blocks[low][1].upto(self.width - 1 - a) if low in self.blocks else (-np.inf, -1)
        if high != low and high in self.blocks:
            found = max(found, self.blocks[high][0].upto(z))
        return found


def chains(pos: list[int], ref: list[int]) -> list[list[int]]:
    """Chains over matches of one pair of documents, sorted by pos: lists of indexes.

    score(i) = words newly matched + the best of 0 and score(j) - GAP_COST * gaps, over
    all matches j that lie before i in both texts, at most MAX_GAP words away in either.
    For a match that doesn't overlap, the best one before it is a range maximum of
    score(j) + GAP_COST * (pos(j) + ref(j)) over ref(j). Matches out of reach by pos leave
    by epochs of that length: an epoch asks the one before it from its last match to its
    first, while that one's matches enter from its end; so trees only ever take in. Matches
    that overlap are few and looked up by place. Chains are taken from the best end down; a
    match is in one chain only."""
    n = len(pos)
    reach = MAX_GAP + SHINGLE
    score, back = [0.0] * n, [-1] * n
    if len({r - p for p, r in zip(pos, ref, strict=True)}) == 1:
        # One straight run, as of an exact copy: going by each match on the way never costs more, so the last one is the best before.
        for i, p in enumerate(pos):
            score[i] = float(SHINGLE)
            d = p - pos[i - 1] if i else 0
            if 0 < d <= reach and (linked := score[i - 1] + min(SHINGLE, d) - GAP_COST * 2 * d) > SHINGLE:
                score[i], back[i] = linked, i - 1
        return _taken(score, back)
    worth = lambda j: (score[j] + GAP_COST * (pos[j] + ref[j]), j)
    by_ref: dict[int, list[int]] = {}
    start, last = 0, range(0)  # the matches of the epoch before
    while start < n:
        epoch = pos[start] // reach
        end = start
        while end < n and pos[end] // reach == epoch:
            end += 1
        if last and pos[last[-1]] // reach < epoch - 1:
            last = range(0)
        # From the epoch before: its matches enter from the last one on; the few that may overlap are looked at one by one.
        late = [j for j in last if pos[j] > epoch * reach - SHINGLE]
        early: list[tuple[float, int]] = [(-np.inf, -1)] * (end - start)
        if last:
            tree, j = Reach(reach), last[-1] - len(late)
            for i in range(end - 1, start - 1, -1):
                while j >= last[0] and pos[j] >= pos[i] - reach:
                    tree.put(ref[j], worth(j))
                    j -= 1
                early[i - start] = tree.before(ref[i])
        tree, entered = Reach(reach), start
        for i in range(start, end):
            p, r = pos[i], ref[i]
            while pos[entered] <= p - SHINGLE:
                tree.put(ref[entered], worth(entered))
                entered += 1
            best, who = float(SHINGLE), -1
            for value, j in (early[i - start], tree.before(r)):
                if j >= 0 and value + SHINGLE - GAP_COST * (p + r) > best:
                    best, who = value + SHINGLE - GAP_COST * (p + r), j
            near = late + [j for k in range(1, SHINGLE) for j in by_ref.get(r - k, ())]  # overlap by ref
            j = i - 1
            while j >= 0 and pos[j] > p - SHINGLE:  # overlap by pos
                near.append(j)
                j -= 1
            for j in near:
                d, e = p - pos[j], r - ref[j]
                if 0 < d <= reach and 0 < e <= reach:
                    linked = score[j] + min(SHINGLE, d, e) - GAP_COST * (d + e)
                    if linked > best:
                        best, who = linked, j
            score[i], back[i] = best, who
            here = by_ref.setdefault(r, [])
            while here and pos[here[0]] < p - reach:
                here.pop(0)
            here.append(i)
        start, last = end, range(start, end)
    return _taken(score, back)


def _taken(score: list[float], back: list[int]) -> list[list[int]]:
    """Chains of two matches or more, from the best end down."""
    n = len(score)
    used = [False] * n
    out = []
    for i in sorted(range(n), key=lambda i: (-score[i], i)):
        chain = []
        while i >= 0 and not used[i]:
            used[i] = True
            chain.append(i)
            i = back[i]
        if len(chain) >= 2:
            out.append(chain[::-1])
    return out


def _lcs(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence of two short arrays."""
    row = np.zeros(len(b) + 1, dtype=np.int64)
    for x in a:
        new = np.maximum(row[1:], row[:-1] + (b == x))
        row = np.concatenate(([0], np.maximum.accumulate(new)))
    return int(row[-1])


def _run_on(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Extend without gaps: words taken, words matched; +1 and -2 a word, stopped ``FALL`` below the best."""
    n = min(len(a), len(b))
    if not n:
        return 0, 0
    same = a[:n] == b[:n]
    value = np.cumsum(np.where(same, 1, -2))
    fall = np.flatnonzero(value < np.maximum.accumulate(np.maximum(value, 0)) - FALL)
    stop = int(fall[0]) if len(fall) else n
    if not stop:
        return 0, 0
    best = int(value[:stop].argmax())
    return (best + 1, int(same[: best + 1].sum())) if value[best] > 0 else (0, 0)


def align(h: np.ndarray, excerpt: np.ndarray, anchors: list[tuple[int, int]]) -> tuple[int, int, float]:
    """Start and end (words of the document) of a chain's passage, and its similarity.

    anchors: (word in the document, word in the excerpt) of each seed, ascending."""
    (a0, r0), matched = anchors[0], SHINGLE
    a, r = a0 + SHINGLE, r0 + SHINGLE
    for p, q in anchors[1:]:
        if p + SHINGLE <= a or q + SHINGLE <= r:
            continue
        gap_a, gap_r = h[a : max(p, a)], excerpt[r : max(q, r)]
        if len(gap_a) == len(gap_r) and (gap_a == gap_r).all():
            matched += len(gap_a)
        elif len(gap_a) and len(gap_r):
            matched += _lcs(gap_a, gap_r)
        # A seed that overlaps the words aligned so far adds what lies beyond them in both.
        matched += min(p + SHINGLE - max(a, p), q + SHINGLE - max(r, q))
        a, r = p + SHINGLE, q + SHINGLE
    right, hits = _run_on(h[a : a + EXTEND], excerpt[r : r + EXTEND])
    a, r, matched = a + right, r + right, matched + hits
    left, hits = _run_on(h[max(0, a0 - EXTEND) : a0][::-1], excerpt[max(0, r0 - EXTEND) : r0][::-1])
    a0, r0, matched = a0 - left, r0 - left, matched + hits
    return a0, a, 2 * matched / (a - a0 + r - r0)


def passages(docs: DataFrame, staged: Staged, min_words: int = MIN_WORDS, similarity: float = SIMILARITY) -> DataFrame:
    """(doc_id, row, starts, ends): word spans of ``docs`` (doc_id, text; row: the text's hash) that repeat an earlier document."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null and text is not null")
    # Tells rows of one id apart. Seeds carry half of it; the alignment checks that a seed's words are there.
    docs = docs.withColumns({"row": F.xxhash64("text"), "v": F.xxhash64("text").bitwiseAND(F.lit(0x7FFFFFFF)).cast("int")})

    def seeds_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found = []
            for doc, text in zip(pdf["doc_id"].tolist(), pdf["text"], strict=True):
                h = word_hash_array(text)
                x, at = seeds(h)
                found.append((x, at, beside(h, at, doc)))
            n = [len(x) for x, *_ in found]
            if sum(n):
                yield pd.DataFrame(
                    {
                        "h": np.concatenate([x for x, *_ in found]).view(np.int64),
                        "doc": np.repeat(pdf["doc_id"].to_numpy(), n),
                        "v": np.repeat(pdf["v"].to_numpy(), n).astype(np.int32),
                        "pos": np.concatenate([p for _, p, _ in found]).astype(np.int32),
                        "near": np.concatenate([b for *_, b in found]),
                    }
                )

    seed = staged.write(docs.mapInPandas(seeds_of, "h long, doc long, v int, pos int, near int"))
    first = (
        seed.groupBy("h")
        .agg(F.min(F.struct("doc", "v", "pos", "near")).alias("f"), F.max("doc").alias("last"))
        .where("f.doc < last")
        .select("h", F.col("f.doc").alias("ref"), F.col("f.v").alias("rv"), F.col("f.pos").alias("rpos"), F.col("f.near").alias("rnear"))
    )
    differ = F.col("near").bitwiseXOR(F.col("rnear"))
    alike = sum(F.when(F.shiftright(differ, 4 * k).bitwiseAND(F.lit(15)) == 0, 1).otherwise(0) for k in range(2 * len(BESIDE)))
    match = staged.write(seed.join(first, "h").where("ref < doc").select("doc", "v", "ref", "rv", "pos", "rpos", (alike >= AGREE).alias("alone")))
    staged.drop(seed)

    def chain(pdf: pd.DataFrame) -> pd.DataFrame | None:
        rows = []
        ref, rv = pdf["ref"].to_numpy(), pdf["rv"].to_numpy()
        cut = [0, *(np.flatnonzero((ref[1:] != ref[:-1]) | (rv[1:] != rv[:-1])) + 1).tolist(), len(ref)]
        pos, rpos, alone = pdf["pos"].tolist(), pdf["rpos"].tolist(), pdf["alone"].tolist()
        for a, z in zip(cut[:-1], cut[1:], strict=True):
            p, r = pos[a:z], rpos[a:z]
            linked = chains(p, r) if z - a > 1 else []
            free = set(range(z - a)).difference(*linked)
            lone, last = [], {}
            for i in sorted(free):
                # In text that repeats itself one seed stands at every few words; its alignments reach over those between.
                if alone[a + i] and p[i] - last.get(r[i], -EXTEND) >= EXTEND // 2:
                    lone.append([i])
                    last[r[i]] = p[i]
            for c in [*linked, *lone]:
                rows.append((pdf["doc"].iloc[0], pdf["v"].iloc[0], ref[a], rv[a], r[c[0]], r[c[-1]], np.array([(p[i], r[i]) for i in c], "<i4").tobytes()))
        return pd.DataFrame(rows, columns=["doc", "v", "ref", "rv", "ra", "rz", "anchors"]) if rows else None

    fields = "doc long, v int, ref long, rv int, ra int, rz int, anchors binary"
    chained = staged.write(sorted_groups(match, ["doc", "v"], chain, fields, ["ref", "rv", "pos", "rpos"]))
    staged.drop(match)

    # The words beside and between the seeds, cut once for each stretch of an earlier text.
    regions = chained.select("ref", "rv", "ra", "rz").distinct().groupBy("ref", "rv").agg(F.collect_list(F.struct("ra", "rz")).alias("regions"))
    # Texts and what is sought in them are both spread over the tasks, at every size.
    one_row = docs.join(regions.withColumnsRenamed({"ref": "doc_id", "rv": "v"}).hint("merge"), ["doc_id", "v"]).select("doc_id", "v", "text", "regions")

    def excerpts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc, v, text, parts in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = word_hash_array(text)
                ra, rz = [p["ra"] for p in parts], [p["rz"] for p in parts]
                cuts = [h[max(0, a - EXTEND) : z + SHINGLE + EXTEND].tobytes() for a, z in zip(ra, rz, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([doc] * len(parts), pa.int64()), pa.array([v] * len(parts), pa.int32()), pa.array(ra, pa.int32()), pa.array(rz, pa.int32()), pa.array(cuts, pa.binary())],
                    names=["ref", "rv", "ra", "rz", "excerpt"],
                )

    cut = one_row.mapInArrow(excerpts, "ref long, rv int, ra int, rz int, excerpt binary").distinct()
    found = chained.join(cut, ["ref", "rv", "ra", "rz"])
    wanted = found.groupBy("doc", "v").agg(F.collect_list(F.struct("ra", "anchors", "excerpt")).alias("found"))
    whole = docs.join(wanted.withColumnRenamed("doc", "doc_id").hint("merge"), ["doc_id", "v"]).select("doc_id", "row", "text", "found")

    def aligned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows, starts, ends = [], [], [], []
            for doc, row, text, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                h = word_hash_array(text)
                spans = []
                for f in found:
                    off = max(0, f["ra"] - EXTEND)
                    anchors = [(p, r - off) for p, r in np.frombuffer(f["anchors"], "<i4").reshape(-1, 2).tolist()]
                    excerpt = np.frombuffer(f["excerpt"], np.uint64)
                    if not all(p + SHINGLE <= len(h) and q + SHINGLE <= len(excerpt) and (h[p : p + SHINGLE] == excerpt[q : q + SHINGLE]).all() for p, q in anchors):
                        continue  # found in another row of the id
                    a, z, like = align(h, excerpt, anchors)
                    if z - a >= min_words and like >= similarity:
                        spans.append((a, z))
                merged: list[list[int]] = []
                for a, z in sorted(spans):
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], z)
                    else:
                        merged.append([a, z])
                if merged:
                    ids.append(doc)
                    rows.append(row)
                    starts.append([a for a, _ in merged])
                    ends.append([z for _, z in merged])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(rows, pa.int64()), pa.array(starts, pa.list_(pa.int32())), pa.array(ends, pa.list_(pa.int32()))],
                names=["doc_id", "row", "starts", "ends"],
            )

    spans = whole.mapInArrow(aligned, "doc_id long, row long, starts array<int>, ends array<int>")
    return spans.groupBy("doc_id", "row").agg(F.min(F.struct("starts", "ends")).alias("s")).select("doc_id", "row", "s.starts", "s.ends")


def cut_words(text: str, starts: list[int], ends: list[int]) -> tuple[str, list[tuple[int, int]]]:
    """The text without the word spans, and the character spans cut (white space before the next word included)."""
    at = [m.start() for m in _WORD.finditer(text)]
    at.append(len(text))
    spans = [(at[a], at[min(z, len(at) - 1)]) for a, z in zip(starts, ends, strict=True) if a < len(at) - 1]
    kept, end = [], 0
    for a, z in spans:
        kept.append(text[end:a])
        end = z
    kept.append(text[end:])
    return "".join(kept), spans


def substring_dedup(docs: DataFrame, min_words: int = MIN_WORDS, similarity: float = SIMILARITY, spans_column: str | None = "removed_spans") -> DataFrame:
    """``docs`` with later copies of passages cut from ``text`` and ``n_chars`` counted anew.

    ``spans_column`` (none, if None) lists the cuts as [start, end) in characters of the
    input text; it replaces a column of that name."""
    staged = Staged(docs.sparkSession)
    spans = staged.write(passages(docs, staged, min_words, similarity))
    if spans_column is not None:
        docs = docs.drop(spans_column)
    names = docs.columns
    # The documents' own columns go by number through the join, so their names can't clash.
    own = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)]
    joined = (
        docs.select(*own, F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("row"))
        .join(spans.withColumnRenamed("doc_id", "key").hint("merge"), ["key", "row"], "left")
        .select(*[f"c{i}" for i in range(len(names))], "starts", "ends")
    )
    at, chars = names.index("text"), names.index("n_chars") if "n_chars" in names else None
    added = [] if spans_column is None else [spans_column]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = list(batch.columns)[: len(names)]
            texts, removed = cols[at].to_pylist(), []
            for i, (s, e) in enumerate(zip(batch.column(len(names)).to_pylist(), batch.column(len(names) + 1).to_pylist(), strict=True)):
                cut: list[tuple[int, int]] = []
                if s and texts[i]:
                    texts[i], cut = cut_words(texts[i], s, e)
                removed.append([list(c) for c in cut])
            if any(removed):
                cols[at] = pa.array(texts, cols[at].type)
                if chars is not None:
                    old = cols[chars].to_pylist()
                    cols[chars] = pa.array([len(t) if r else n for t, r, n in zip(texts, removed, old, strict=True)], cols[chars].type)
            if added:
                cols.append(pa.array(removed, pa.list_(pa.list_(pa.int64()))))
            yield pa.RecordBatch.from_arrays(cols, names=[*names, *added])

    more = [StructField(c, ArrayType(ArrayType(LongType()))) for c in added]
    return joined.mapInArrow(run, StructType([*docs.schema.fields, *more]))
