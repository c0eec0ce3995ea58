"""Byte-level BPE encoding and decoding (operator 3): merge replay over a word table.

A task cuts its documents into the matches of the split pattern, collects the distinct
ones it has not met yet, and encodes that word table as one corpus: all words' bytes lie in
one token list with neighbour links, an inverted index holds the positions of the pairs
behind each merge, and merges are applied in rank order, each to all its positions in the
table, updating only the two neighbours a merge touches. Documents then look their words up.

Equality with the sequential rule (lowest rank first, then leftmost) holds because
positions of one rank are applied from left to right. Where a merge makes a pair of lower
rank than its own possible, which a trained rank table hardly ever has, the word is encoded
again by the sequential rule itself. A match that is a token as a whole is that token, as the
tiktoken library looks it up first, also where no merges lead to it.

Defined results: a null text is encoded as empty (no ids, no bytes); repeated rows come
back repeated; a null id stays null; other columns are ignored; an empty table gives an
empty result. Special tokens are never produced.
"""

from __future__ import annotations

import base64
import heapq
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .common import ship

#: Encoded words, and runs of text between spaces, that a worker keeps; a cache starts anew beyond this.
CACHE_WORDS = 100_000
#: Documents whose words are replayed together.
STEP = 500
#: No merge.
NONE = 2**62

#: A match of the split pattern never goes from a non-space to a space, so text can be
#: cut there first. The two libraries' white space differs in these characters only.
_CHUNK = re.compile(r"\s*\S+|\s+")
_ODD_SPACE = re.compile("[\x1c-\x1f]")


def load_ranks(path: str) -> dict[bytes, int]:
    """A rank file: a base64 token and its rank in each line."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Encoder:
    """Ranks, split pattern and the caches of one worker."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks = ranks
        self.split = regex.compile(pattern)
        self.bytes_of = {r: t for t, r in ranks.items()}
        self.single = [ranks[bytes([i])] for i in range(256)]
        self.pair_rank: dict[tuple[int, int], int] = {}
        self.chunks: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        self.pairs: tuple[np.ndarray, np.ndarray] | None = None

    def rank_of(self, a: int, b: int) -> int:
        """Rank of the token that a and b merge into; -1 if there is none."""
        got = self.pair_rank.get((a, b))
        if got is None:
            if len(self.pair_rank) > CACHE_WORDS:
                self.pair_rank.clear()
            got = self.pair_rank[a, b] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
        return got

    def sequential(self, word: bytes) -> list[int]:
        """Lowest rank first, then leftmost, one merge at a time."""
        tok = [self.single[c] for c in word]
        nxt = [*range(1, len(tok)), -1]
        prv = [-1, *range(len(tok) - 1)]
        heap = [(r, i) for i in range(len(tok) - 1) if (r := self.rank_of(tok[i], tok[i + 1])) >= 0]
        heapq.heapify(heap)
        while heap:
            r, i = heapq.heappop(heap)
            if tok[i] < 0 or nxt[i] < 0 or self.rank_of(tok[i], tok[nxt[i]]) != r:
                continue
            j = nxt[i]
            tok[i], tok[j], nxt[i] = r, -1, nxt[j]
            if nxt[j] >= 0:
                prv[nxt[j]] = i
                if (x := self.rank_of(r, tok[nxt[j]])) >= 0:
                    heapq.heappush(heap, (x, i))
            if prv[i] >= 0 and (x := self.rank_of(tok[prv[i]], r)) >= 0:
                heapq.heappush(heap, (x, prv[i]))
        return [t for t in tok if t >= 0]

    def pair_table(self) -> tuple[np.ndarray, np.ndarray]:
        """Keys (left << 32 | right) of all pairs that merge, ascending, and their ranks."""
        if self.pairs is None:
            found = [
                (self.ranks[t[:k]] << 32 | self.ranks[t[k:]], r)
                for t, r in self.ranks.items()
                for k in range(1, len(t))
                if t[:k] in self.ranks and t[k:] in self.ranks
            ]
            table = np.array(sorted(found), dtype=np.int64).reshape(-1, 2)
            self.pairs = np.append(table[:, 0], np.int64(2**63 - 1)), np.append(table[:, 1], NONE)
        return self.pairs

    def replay(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of each word, by replaying the merges over the whole word table."""
        keys, key_ranks = self.pair_table()
        sizes = np.array([len(w) for w in words], dtype=np.int64)
        ends = np.cumsum(sizes)
        tok = np.array(self.single, dtype=np.int64)[np.frombuffer(b"".join(words), np.uint8)]
        n = len(tok)
        nxt, prv = np.arange(1, n + 1), np.arange(-1, n - 1)
        full = sizes > 0
        nxt[ends[full] - 1] = -1
        prv[(ends - sizes)[full]] = -1

        def ranks_at(at: np.ndarray) -> np.ndarray:
            """Rank of the pair that begins at each position; its right token must exist."""
            key = tok[at] << 32 | tok[nxt[at]]
            i = np.searchsorted(keys, key)
            return np.where(keys[i] == key, key_ranks[i], NONE)

        rank = np.full(n, NONE, dtype=np.int64)
        inner = np.flatnonzero(nxt >= 0)
        rank[inner] = ranks_at(inner)
        # The inverted index: positions of the pairs behind each merge.
        index: dict[int, list] = {}

        def file(at: np.ndarray, ranks: np.ndarray) -> None:
            order = np.argsort(ranks, kind="stable")
            at, ranks = at[order], ranks[order]
            cut = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
            first = [0, *cut.tolist()]
            for r, a, z in zip(ranks[first].tolist(), first, [*first[1:], len(at)], strict=True):
                if r in index:
                    index[r].append(at[a:z])
                else:
                    index[r] = [at[a:z]]
                    heapq.heappush(queue, r)

        queue: list[int] = []
        some = inner[rank[inner] != NONE]
        if len(some):
            file(some, rank[some])
        again: list[np.ndarray] = []
        while queue:
            r = heapq.heappop(queue)
            parts = index.pop(r)
            at = np.concatenate(parts) if len(parts) > 1 else parts[0]
            at = at[rank[at] == r]
            if len(parts) > 1:
                at = np.unique(at)
            if len(at) > 1:
                linked = nxt[at[:-1]] == at[1:]
                if linked.any():  # of pairs that share a token the left one merges first
                    begin = np.maximum.accumulate(np.where(np.concatenate(([True], ~linked)), np.arange(len(at)), 0))
                    at = at[(np.arange(len(at)) - begin) % 2 == 0]
            if not len(at):
                continue
            right = nxt[at]
            after = nxt[right]
            beside = np.flatnonzero(after[:-1] == at[1:])
            if len(beside):  # one after the other, the first would meet the next one's left token
                key = r << 32 | tok[at[beside + 1]]
                i = np.searchsorted(keys, key)
                early = (keys[i] == key) & (key_ranks[i] < r)
                if early.any():
                    again.append(at[beside[early]])
            tok[at] = r
            tok[right] = -1
            nxt[at] = after
            rank[at] = rank[right] = NONE
            more = after >= 0
            prv[after[more]] = at[more]
            left = prv[at]
            left = left[left >= 0]
            touched = np.concatenate([at[more], left])
            if not len(touched):
                continue
            if len(left):
                touched = np.unique(touched)
            new = ranks_at(touched)
            rank[touched] = new
            hit = new != NONE
            if hit.any():
                touched, new = touched[hit], new[hit]
                if (new < r).any():
                    again.append(touched[new < r])
                file(touched, new)
        live = tok >= 0
        kept = tok[live]
        upto = np.concatenate(([0], np.cumsum(live)))[np.concatenate(([0], ends))]
        out = [kept[a:z] for a, z in zip(upto[:-1].tolist(), upto[1:].tolist(), strict=True)]
        for w in set(np.searchsorted(ends, np.concatenate(again), side="right").tolist()) if again else ():
            out[w] = np.array(self.sequential(words[w]), dtype=np.int64)
        return out

    def encode_batch(self, texts: list) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        for kept in (self.chunks, self.words):
            if len(kept) > CACHE_WORDS:
                kept.clear()
        cache, known = self.chunks, self.words
        cut, new = [], set()
        for text in texts:
            if not isinstance(text, str) or not text:
                cut.append([])
                continue
            parts = self.split.findall(text) if _ODD_SPACE.search(text) else _CHUNK.findall(text)
            cut.append(parts)
            new.update(p for p in parts if p not in cache)
        pieces = {p: self.split.findall(p) for p in new}
        table, raw = [], []
        for w in {w for ws in pieces.values() for w in ws if w not in known}:
            data = w.encode("utf-8", "surrogatepass")
            if (whole := self.ranks.get(data)) is not None:
                known[w] = whole.to_bytes(4, "little")
            else:
                table.append(w)
                raw.append(data)
        for w, ids in zip(table, self.replay(raw) if raw else (), strict=True):
            known[w] = ids.astype("<u4").tobytes()
        for p, ws in pieces.items():
            cache[p] = known[ws[0]] if len(ws) == 1 else b"".join([known[w] for w in ws])
        return [b"".join([cache[p] for p in parts]) for parts in cut]


def encode(docs: DataFrame, rank_path: str, pattern: str, id_column: str = "doc_id") -> DataFrame:
    """id, ids (binary: little-endian unsigned 32-bit). The rank file is read on the
    driver and sent to the tasks; its size does not depend on the data."""
    ship(docs.sparkSession)
    ranks = docs.sparkSession.sparkContext.broadcast(load_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks.value, pattern)
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                ids = pa.array(encoder.encode_batch(part.column(1).to_pylist()), pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), ids], names=[id_column, "ids"])

    schema = StructType([docs.schema[id_column], *StructType.fromDDL("ids binary").fields])
    return docs.select(id_column, "text").mapInArrow(run, schema)


def decode(encoded: DataFrame, rank_path: str, id_column: str = "doc_id") -> DataFrame:
    """id, ids, decoded (binary): the bytes that the ids stand for; null ids give none."""
    ship(encoded.sparkSession)
    ranks = encoded.sparkSession.sparkContext.broadcast(load_ranks(rank_path))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of: list[bytes] = [b""] * (max(ranks.value.values(), default=-1) + 1)
        for token, r in ranks.value.items():
            of[r] = token
        for batch in batches:
            for at in range(0, batch.num_rows, STEP):
                part = batch.slice(at, STEP)
                texts = [b"".join([of[i] for i in np.frombuffer(x, "<u4").tolist()]) if x else b"" for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.binary())], names=[id_column, "ids", "decoded"])

    schema = StructType([encoded.schema[id_column], *StructType.fromDDL("ids binary, decoded binary").fields])
    return encoded.select(id_column, "ids").mapInArrow(run, schema)
