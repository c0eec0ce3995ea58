"""MinHash near-dedup (operator 9): chosen-path set similarity join.

A document's set holds its distinct word shingles as 64-bit hashes. Documents with equal
sets form a class first; the smallest id stands for it. Independent trees then branch the
representatives recursively: at each level a node is split by its members' minimum shingle
under a hash function of that tree and level. A node of at most ``limit`` members is a leaf
and is compared exhaustively on the full sets. Nodes that still are larger after ``depth``
levels (many near copies of one text) are compared in chunks that all hold the node's
smallest member as well, which links most of them; then, where a node still holds two or
more components, in all pairs of its blocks: see :func:`block_pairs`. So every pair of a
node whose members are not connected already is compared, and no task holds a whole group.

Members of a leaf whose sketches (all trees' minima) agree with no other member's are left
out before texts are fetched; see :func:`least_agreement`. Links are confirmed on full sets.

Trees come in rounds. After a round, linked representatives share a component, and later
trees only work on nodes that hold two or more components: components are all that is
reported, so a pair that is connected already needs no comparison.

Recall: a pair of similarity s meets in a tree of reached depth d with chance s**d, and all
pairs of the node they meet in are compared. The number of trees follows from the full depth
and the threshold (:func:`tree_count`): a pair right at the threshold is missed with a chance
of ``MISS`` at most, less where nodes of few members stop at a lower depth.

Defined results: null texts and texts without words have an empty set and link with
nothing (component_id = doc_id); texts with fewer words than a shingle have one shingle,
the whole sequence; rows whose id is null come back with null component and kept; rows
that repeat an id get that id's result each; other columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import M1, M2, M3, Forest, Staged, mix64, sorted_groups
from .components import components

#: Chance at most that a pair right at the threshold meets in no tree.
MISS = 1e-4
#: Members of a block of a large node.
BLOCK = 128
#: Words whose hashes a worker keeps (about 100 bytes each).
WORD_CACHE = 200_000

_words: dict[bytes, int] = {}


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, through a cache of bounded size."""
    if len(_words) > WORD_CACHE:
        _words.clear()
    get = _words.get
    out = [get(w) for w in words]
    if None in out:
        for i, h in enumerate(out):
            if h is None:
                _words[words[i]] = out[i] = xxhash.xxh3_64_intdigest(words[i])
    return np.array(out, dtype=np.uint64)


def words_of(text) -> list[bytes]:
    """Words between white space (0x20, 0x09-0x0D), with A-Z lower-cased."""
    return text.encode("utf-8", "surrogatepass").lower().split() if isinstance(text, str) else []


def shingles(text, size: int) -> np.ndarray:
    """Sorted distinct hashes of a text's shingles of ``size`` words."""
    words = words_of(text)
    if not words:
        return np.zeros(0, np.uint64)
    h = word_hashes(words)
    if len(h) < size:
        x = np.array([len(h)], np.uint64)
        for w in h:
            x = mix64(x ^ w, 7)
        return x
    n = len(h) - size + 1
    x = np.zeros(n, np.uint64)
    for j in range(size):
        x = x * M2 + h[j : j + n] * M1
        x ^= x >> np.uint64(31)
    x *= M3
    x ^= x >> np.uint64(32)
    return np.unique(x)


def set_digest(s: np.ndarray) -> tuple[int, int]:
    d = xxhash.xxh3_128_intdigest(s.tobytes())
    return (d & (2**64 - 1)) - 2**63, (d >> 64) - 2**63


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """100 * |a & b| >= percent * |a | b|."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int(np.count_nonzero(large[at] == small))
    return 100 * both >= percent * (len(a) + len(b) - both)


def _mins(s: np.ndarray, functions: np.ndarray) -> np.ndarray:
    """Minimum of each hash function over the set."""
    out = np.empty(len(functions), np.uint64)
    for i in range(0, len(functions), 8):
        x = s[None, :] * functions[i : i + 8, None]
        x ^= x >> np.uint64(32)
        x *= M2
        out[i : i + 8] = x.min(axis=1)
    return out


def signatures(docs: DataFrame, size: int, coordinates: int) -> DataFrame:
    """doc_id, n (set size), d1, d2 (digest of the set), mins (array of long)."""
    functions = mix64(np.arange(coordinates, dtype=np.uint64), 11) | np.uint64(1)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = []
            for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
                s = shingles(text, size)
                if len(s):
                    d1, d2 = set_digest(s)
                    rows.append((doc, len(s), d1, d2, _mins(s, functions).view(np.int64)))
                else:
                    rows.append((doc, 0, 0, 0, None))
            yield pd.DataFrame(rows, columns=["doc_id", "n", "d1", "d2", "mins"])

    return docs.mapInPandas(run, "doc_id long, n long, d1 long, d2 long, mins array<long>")


def tree_count(depth: int, percent: int) -> int:
    """Trees of ``depth`` levels in which a pair at the threshold is missed with a chance of ``MISS`` at most."""
    meets = (percent / 100) ** depth
    return 1 if meets >= 1 - MISS else math.ceil(math.log(MISS) / math.log1p(-meets))


def tree_nodes(reps: DataFrame, trees: int, depth: int, limit: int, staged: Staged) -> tuple[DataFrame, DataFrame]:
    """(tree, node, chunk, doc_id, later): members of the nodes to compare, all trees; and
    (tree, node, doc_id): members of the nodes of more than ``limit`` members.

    reps: doc_id, mins. ``later`` is 0 for the node's smallest member, which every chunk holds."""
    level_min = lambda level: F.col("mins")[level]
    open_ = (
        reps.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees - 1))))
        .withColumn("mins", F.slice("mins", F.col("tree") * depth + 1, F.lit(depth)))
        .select("doc_id", "tree", "mins", F.xxhash64("tree", level_min(0)).alias("node"))
    )
    done: list[DataFrame] = []
    for level in range(depth):
        sizes = open_.groupBy("node").agg(F.count("*").alias("members"), F.min("doc_id").alias("first")).where("members > 1")
        sized = staged.write(open_.join(sizes, "node"))
        last = level == depth - 1
        done.append((sized if last else sized.where(F.col("members") <= limit)).select("tree", "node", "members", "first", "doc_id"))
        if not last:
            open_ = sized.where(F.col("members") > limit).select("doc_id", "tree", "mins", F.xxhash64("node", level_min(level + 1)).alias("node"))
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)
    chunks = F.ceil(F.col("members") / limit).cast("long")
    others = rows.where("doc_id <> first").select(
        "tree", "node", F.pmod(F.xxhash64("doc_id", "node"), chunks).cast("long").alias("chunk"), "doc_id", F.lit(1).alias("later")
    )
    pivots = rows.where("doc_id = first").select(
        "tree", "node", F.explode(F.sequence(F.lit(0).cast("long"), chunks - 1)).alias("chunk"), "doc_id", F.lit(0).alias("later")
    )
    return others.unionByName(pivots), done[-1].where(F.col("members") > limit).select("tree", "node", "doc_id")


def block_pairs(named: DataFrame, block: int, staged: Staged) -> DataFrame:
    """(tree, node, chunk, doc_id, later): members of the pairs of blocks to compare.

    named: tree, node, doc_id, comp. In a node a component of ``block`` members or more has
    blocks of its own, the others share blocks. All pairs of blocks are compared but those of
    one component, so rows grow with the members times those outside the node's large
    component. ``later`` is 2 and 3 for the sides of a pair, 1 in a block paired with itself."""
    sizes = named.groupBy("node", "comp").agg(F.count("*").alias("own"))
    pooled = F.sum(F.when(F.col("own") < block, F.col("own")).otherwise(0)).alias("pooled")
    nodes = sizes.groupBy("node").agg(F.count("*").alias("comps"), pooled).where("comps > 1")
    large = F.col("own") >= block
    of = F.ceil(F.when(large, F.col("own")).otherwise(F.col("pooled")) / block)
    member = staged.write(
        named.join(sizes, ["node", "comp"])
        .join(nodes, "node")
        .withColumn("whole", F.when(large, F.col("comp")))
        .withColumn("block", F.xxhash64(large, "whole", F.pmod(F.xxhash64("doc_id", "node"), of)))
        .select("tree", "node", "block", "whole", "doc_id")
    )
    one = member.groupBy("node", "block").agg(F.min("whole").alias("whole"))
    left = one.select("node", F.col("block").alias("a"), F.col("whole").alias("wa"))
    right = one.select("node", F.col("block").alias("b"), F.col("whole").alias("wb"))
    pairs = staged.write(left.join(right, "node").where("a <= b and coalesce(wa <> wb, true)").select("node", "a", "b"))
    chunk = F.xxhash64("a", "b").alias("chunk")
    side = lambda x, pairs, later: (
        pairs.withColumn("block", F.col(x)).join(member, ["node", "block"]).select("tree", "node", chunk, "doc_id", later.cast("int").alias("later"))
    )
    return side("a", pairs, F.when(F.col("a") == F.col("b"), 1).otherwise(2)).unionByName(side("b", pairs.where("a <> b"), F.lit(3)))


def least_agreement(coordinates: int, percent: int) -> int:
    """Equal minima below which two sketches rule a pair out: five standard deviations under
    the mean of a pair right at the threshold, which misses about one such pair in a million."""
    p = percent / 100
    return max(1, int(coordinates * p - 5 * (coordinates * p * (1 - p)) ** 0.5))


def near_classes(
    docs: DataFrame, size: int = 3, percent: int = 85, trees: int | None = None, depth: int = 4, limit: int = 24, first_trees: int = 2, block: int = BLOCK
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every row of ``docs`` (doc_id, text)."""
    trees = trees or tree_count(depth, percent)
    staged = Staged(docs.sparkSession)
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    docs = whole.where("doc_id is not null")
    sig = staged.write(signatures(docs, size, trees * depth))
    full = sig.where("n > 0")
    classes = full.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"))
    member = staged.write(full.select("doc_id", "d1", "d2").join(classes, ["d1", "d2"]).select("doc_id", "rep"))
    firsts = member.where("doc_id = rep").select("doc_id").distinct()
    reps = staged.write(full.join(firsts, "doc_id", "left_semi").groupBy("doc_id").agg(F.min("mins").alias("mins")))
    least = least_agreement(trees * depth, percent)

    def plausible(pdf: pd.DataFrame) -> pd.DataFrame | None:
        """The members that have a partner by their sketches."""
        if len(pdf) < 2:
            return None
        m = np.stack(pdf["mins"].to_list())
        side = pdf["later"].to_numpy()
        close = np.zeros((len(m), len(m)), dtype=bool)
        for i in range(len(m)):
            close[i] = (m == m[i]).sum(axis=1) >= least
        close &= (side[:, None] != side[None, :]) | (side < 2)
        np.fill_diagonal(close, False)
        keep = close.any(axis=1)
        return pdf.loc[keep, ["tree", "node", "chunk", "doc_id", "later"]] if keep.any() else None

    def with_partners(members: DataFrame) -> DataFrame:
        members = members.join(reps, "doc_id").select("tree", "node", "chunk", "doc_id", "later", "mins")
        return staged.write(sorted_groups(members, ["node", "chunk"], plausible, "tree int, node long, chunk long, doc_id long, later int"))

    members, large = tree_nodes(reps, trees, depth, limit, staged)
    rows = with_partners(members)
    # Texts and ids are both spread over the tasks, whatever the number of ids.
    texts = staged.write(docs.join(rows.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi"))

    def compare(pdf: pd.DataFrame) -> pd.DataFrame | None:
        pdf = pdf.sort_values(["later", "doc_id"]).drop_duplicates("doc_id")
        ids = pdf["doc_id"].tolist()
        forest, by = Forest(len(ids)), {}
        for i, c in enumerate(pdf["comp"].tolist()):
            forest.join(by.setdefault(c, i), i)
        if len(by) < 2:
            return None
        sets = [shingles(t, size) for t in pdf["text"]]
        side = pdf["later"].tolist()
        links = []
        for i in range(len(ids)):
            for j in range(i + 1, len(ids)):
                if (side[i] != side[j] or side[i] < 2) and forest.find(i) != forest.find(j) and similar(sets[i], sets[j], percent):
                    forest.join(i, j)
                    links.append((ids[i], ids[j]))
        return pd.DataFrame(links, columns=["a", "b"]) if links else None

    def linked(named: DataFrame, texts: DataFrame) -> DataFrame:
        joined = named.join(texts, "doc_id").select("node", "chunk", "doc_id", "later", "comp", "text")
        return sorted_groups(joined, ["node", "chunk"], compare, "a long, b long")

    def with_components(rows: DataFrame) -> DataFrame:
        return rows.join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left").withColumn("comp", F.coalesce("component", "doc_id"))

    rounds = (F.col("tree") < first_trees, F.col("tree") >= first_trees)
    links = staged.write(linked(rows.where(rounds[0]).withColumn("comp", F.col("doc_id")), texts))
    comp = components(links, staged)
    named = with_components(rows.where(rounds[1]))
    # Only nodes that hold two components can add anything.
    several = named.groupBy("node", "chunk").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1")).where("c0 <> c1")
    links = staged.write(linked(named.join(several.select("node", "chunk"), ["node", "chunk"], "left_semi"), texts).unionByName(links))
    comp = components(links, staged)
    # Large nodes that hold two components still.
    for part in rounds:
        rest = with_partners(block_pairs(with_components(large.where(part)), block, staged))
        if rest.isEmpty():
            continue
        sought = docs.join(rest.select("doc_id").distinct().hint("merge"), "doc_id", "left_semi")
        links = staged.write(linked(with_components(rest), sought).unionByName(links))
        comp = components(links, staged)
    result = (
        member.groupBy("doc_id")
        .agg(F.min("rep").alias("rep"))
        .join(comp.withColumnRenamed("node", "rep"), "rep", "left")
        .select("doc_id", F.coalesce("component", "rep").alias("component"))
    )
    out = sig.select("doc_id", "n").join(result, "doc_id", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    ).withColumn("kept", F.col("doc_id") == F.col("component_id"))
    # Rows without an id keep their row: counted, in no component.
    lost = signatures(whole.where("doc_id is null"), size, trees * depth).select(
        "doc_id", F.col("n").alias("n_shingles"), F.lit(None).cast("long").alias("component_id"), F.lit(None).cast("boolean").alias("kept")
    )
    return out.unionByName(lost)
