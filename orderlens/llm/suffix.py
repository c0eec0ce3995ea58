"""Suffix-array dedup (operator 8): longest-previous-factor arrays.

A byte is removed when a string of ``length`` bytes that covers it also starts in a
document with a smaller id. Method:

1. *Candidates.* In each window of ``length`` bytes the smallest hash of its K-byte
   strings names the window. Equal windows have equal names, so only names seen in two
   documents can hold a repeat. Runs of windows with one name are short (about 17
   windows), so a task sends 8 bytes a run, each name once per group of documents.
2. *Suffixes.* Documents are regrouped, and the text of runs with a repeated name goes
   to the bucket of the name. All copies of a window meet in one bucket. Equal runs of
   text are sent once per group of documents, with the smallest document id. A hot name
   (see ``HOT``) stands in very many different runs, as a line that most documents hold
   does; its windows go one by one to the buckets of their own hashes, so they spread.
3. *LPF.* Each bucket sorts the suffixes of its runs by their first ``length`` bytes
   (prefix doubling). For each suffix the nearest ones before and after it in suffix order
   whose document is smaller are found; the longer of the two common prefixes is its longest
   previous factor. Where that reaches ``length`` the suffix is a later copy; the bytes it
   covers go, and the first copy stays.
4. *Cut.* A bucket returns one row for each group of documents it has spans of, which go back
   to the texts by group.

A document's row is known by id and text: rows that repeat an id with another text have spans
of their own.

Defined results: a null text counts as empty; texts under ``length`` bytes keep all
bytes; documents whose id is null are compared with nothing and keep all; rows that
repeat an id are one document's, so they don't remove one another's bytes; other columns
are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import M1, M2, M3, Staged, group_count, mix64

#: Bytes of the strings whose smallest hash names a window.
K = 18
#: Bytes of text in a group of documents.
GROUP_BYTES = 4_000_000
#: Pairs of a batch and a group of documents from which a name that stands in them is hot.
#: The windows of a hot name take some ten times the bytes of its runs, so rarer names stay whole.
HOT = 2048

_MULT = (M1, M2, M3)


def _hashes(data: bytes) -> np.ndarray:
    """64-bit hashes of all K-byte strings."""
    n = len(data) - K + 1
    buf = np.frombuffer(data + b"\0" * 8, dtype=np.uint8)
    words = np.ndarray((len(data) + 1,), dtype="<u8", buffer=buf, strides=(1,))
    h = np.zeros(n, dtype=np.uint64)
    for j, at in enumerate((0, 8, K - 8)):
        x = words[at : at + n] * _MULT[j]
        x ^= x >> np.uint64(29)
        h += x
        h *= M2
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    span = 1
    while span * 2 <= width:
        h = np.minimum(h[:-span], h[span:])
        span *= 2
    if span < width:
        h = np.minimum(h[: len(h) - (width - span)], h[width - span :])
    return h


def runs(data: bytes, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of windows with one name: first window, end of the last window's bytes, name."""
    if len(data) < length:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    names = _sliding_min(_hashes(data), length - K + 1)
    first = np.flatnonzero(np.concatenate(([True], names[1:] != names[:-1])))
    last = np.append(first[1:], len(names))
    return first, last + length - 1, names[first]


def window_keys(data: bytes, length: int) -> np.ndarray:
    """64-bit hashes of all windows, by the hashes of K-byte strings that cover them."""
    h = _hashes(data)
    n = len(data) - length + 1
    out = np.zeros(n, np.uint64)
    for at in (*range(0, length - K, K), length - K):
        out = mix64(out ^ h[at : at + n])
    return out


def _bucket(names: np.ndarray, buckets: int) -> np.ndarray:
    return (mix64(names) >> np.uint64(16)) % np.uint64(buckets)


def _split(order_key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values in a sorted array."""
    start = np.flatnonzero(np.concatenate(([True], order_key[1:] != order_key[:-1])))
    return start, np.append(start[1:], len(order_key))


def _smaller_before(value: np.ndarray) -> np.ndarray:
    """For each place the nearest earlier place with a smaller value, -1 if there is none."""
    at = np.arange(len(value)) - 1
    live = np.arange(1, len(value))
    while len(live):  # jump over values that are not smaller, along their own jumps
        j = at[live]
        open_ = (j >= 0) & (value[j] >= value[live])
        live, j = live[open_], j[open_]
        at[live] = at[j]
    return at


def previous_factors(data: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in ``starts`` the length, up to ``length``, of its longest previous factor: of the longest
    string that starts there and at a suffix of a smaller owner. ``data`` holds ``length`` bytes after each."""
    n = len(starts)
    if not n:
        return np.zeros(0, dtype=np.int64)
    size = len(data)
    padded = np.concatenate([data, np.zeros(max(8, length), np.uint8)])
    words = np.ndarray((size,), dtype=">u8", buffer=padded, strides=(1,)).astype(np.uint64)
    rank = np.unique(words, return_inverse=True)[1].astype(np.uint64)
    have, levels = 8, [(8, rank.astype(np.uint32))]

    def doubled(rank: np.ndarray, step: int) -> np.ndarray:
        after = np.zeros(len(rank), np.uint64)
        after[: len(rank) - step] = rank[step:]
        return np.unique((rank << np.uint64(32)) | after, return_inverse=True)[1].astype(np.uint64)

    while have * 2 < length:
        rank = doubled(rank, have)
        have *= 2
        levels.append((have, rank.astype(np.uint32)))
    key = doubled(rank, length - have)[starts]
    order = (np.sort(key * np.uint64(n) + np.arange(n, dtype=np.uint64)) % np.uint64(n)).astype(np.int64)
    place, whose = starts[order], owner[order]
    before = _smaller_before(whose)
    after = len(whose) - 1 - _smaller_before(whose[::-1])[::-1]
    after[after == len(whose)] = -1

    def common(near: np.ndarray) -> np.ndarray:
        """Common prefix of each suffix and the one at ``near``, up to ``length``."""
        out = np.zeros(n, dtype=np.int64)
        own = np.flatnonzero(near >= 0)
        i, j = place[own], place[near[own]]
        off = np.zeros(len(own), dtype=np.int64)
        equal = key[order[own]] == key[order[near[own]]]
        off[equal] = length
        todo = np.flatnonzero(~equal)
        for step, level in reversed(levels):
            at = todo[off[todo] + step <= length]
            x, y = i[at] + off[at], j[at] + off[at]
            fits = (x < size) & (y < size)
            same = np.zeros(len(at), dtype=bool)
            same[fits] = level[x[fits]] == level[y[fits]]
            off[at[same]] += step
        while len(todo):  # fewer than 8 bytes are left
            todo = todo[off[todo] < length]
            todo = todo[padded[i[todo] + off[todo]] == padded[j[todo] + off[todo]]]
            off[todo] += 1
        out[own] = off
        return out

    out = np.zeros(n, dtype=np.int64)
    out[order] = np.maximum(common(before), common(after))
    return out


def longest_previous(data: np.ndarray, starts: np.ndarray, owner: np.ndarray, length: int) -> np.ndarray:
    """For each suffix in ``starts``: does its longest previous factor reach ``length``?"""
    return previous_factors(data, starts, owner, length) >= length


def _numbered(pdf: pd.DataFrame) -> pd.DataFrame:
    """The distinct documents (id, text) of a group in order; their places number them."""
    return pdf[["doc_id", "text"]].drop_duplicates().sort_values(["doc_id", "text"], kind="stable", ignore_index=True)


def _grouped(docs: DataFrame, groups: int) -> DataFrame:
    """doc_id, text and their group."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").withColumn("g", F.pmod(F.xxhash64("doc_id", "text"), F.lit(groups)).cast("int"))


def _bytes(text) -> bytes:
    return text.encode("utf-8", "surrogatepass") if isinstance(text, str) else b""


def count_groups(docs: DataFrame, group_bytes: int) -> int:
    return group_count(docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0, group_bytes, 16)


def text_pieces(docs: DataFrame, staged: Staged, length: int = 50, group_bytes: int = GROUP_BYTES, hot: int = HOT) -> DataFrame:
    """Text with repeated names by bucket b, and (data null) spans that are known already.

    rows number the documents of group g; docs, starts and sizes go with them, names and data are null for spans."""
    groups = buckets = count_groups(docs, group_bytes)
    docs = _grouped(docs, groups).where("doc_id is not null and text is not null")

    def names_of(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            found, whose, group = [], [], []
            for doc, text, g in zip(pdf["doc_id"], pdf["text"], pdf["g"], strict=True):
                names = np.unique(runs(_bytes(text), length)[2])
                found.append(names)
                whose.append(np.full(len(names), doc, np.int64))
                group.append(np.full(len(names), g, np.int64))
            if not found:
                continue
            names, docs_, group = np.concatenate(found), np.concatenate(whose), np.concatenate(group)
            if not len(names):
                continue
            order = np.lexsort((docs_, names, group))
            names, docs_, group = names[order], docs_[order], group[order]
            change = np.concatenate(([True], (names[1:] != names[:-1]) | (group[1:] != group[:-1])))
            start = np.flatnonzero(change)
            end = np.append(start[1:], len(names))
            several = docs_[start] != docs_[end - 1]
            names, group = names[start], group[start]
            # The lowest bit says that two documents of this batch and group have it.
            packed = (names & ~np.uint64(1)) | several.astype(np.uint64)
            b = _bucket(names & ~np.uint64(1), buckets)
            order = np.lexsort((group, b))
            packed, group, b = packed[order], group[order], b[order]
            # One row for each bucket: its names by group, the groups, and their numbers of names.
            rows = []
            for x, y in zip(*_split(b), strict=True):
                first, end = _split(group[x:y])
                rows.append((int(b[x]), group[x:y][first].astype(np.int32).tobytes(), (end - first).astype(np.int32).tobytes(), packed[x:y].tobytes()))
            yield pd.DataFrame(rows, columns=["b", "groups", "counts", "names"])

    def repeated(pdf: pd.DataFrame) -> pd.DataFrame:
        cat = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in pdf[c]])
        packed, group = cat("names", np.uint64), np.repeat(cat("groups", np.int32), cat("counts", np.int32))
        several = (packed & np.uint64(1)).astype(bool)
        names = packed & ~np.uint64(1)
        order = np.argsort(names)
        names, group, several = names[order], group[order], several[order]
        start, end = _split(names)
        keep = np.repeat((end - start > 1) | np.logical_or.reduceat(several, start), end - start)
        # From here on the lowest bit says that a name is hot.
        names = names | np.repeat((end - start >= hot).astype(np.uint64), end - start)
        names, group = names[keep], group[keep]
        if not len(names):
            return pd.DataFrame({"g": [], "names": []})
        order = np.lexsort((names, group))
        names, group = names[order], group[order]
        start, end = _split(group)
        return pd.DataFrame({"g": group[start].astype(np.int32), "names": [np.unique(names[a:b]).tobytes() for a, b in zip(start, end, strict=True)]})

    sent = docs.mapInPandas(names_of, "b int, groups binary, counts binary, names binary")
    shared = staged.write(sent.groupBy("b").applyInPandas(repeated, "g int, names binary"))

    def texts_of(key, pdf: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        """Runs of text for bucket b, or (data null) spans that are known already."""
        out: dict[str, list] = {k: [] for k in ("b", "g", "rows", "docs", "starts", "sizes", "names", "data")}

        def put(b: int, rows: list, docs: list, starts: list, sizes: list, names: bytes | None, data: bytes | None) -> None:
            ints = lambda x: np.array(x, np.int32).tobytes()
            for k, v in zip(out, (b, key[0], ints(rows), np.array(docs, np.int64).tobytes(), ints(starts), ints(sizes), names, data), strict=True):
                out[k].append(v)

        if len(pdf) and len(wanted):
            want = np.unique(np.concatenate([np.frombuffer(x, np.uint64) for x in wanted["names"]]))
            is_hot = (want & np.uint64(1)).astype(bool)
            want = want & ~np.uint64(1)
            seen: dict[bytes, int] = {}
            rows: list[tuple[int, int, int, int, bytes]] = []
            known: list[tuple[int, int, int, int]] = []
            pdf = _numbered(pdf)
            for row, (doc, text) in enumerate(zip(pdf["doc_id"].tolist(), pdf["text"], strict=True)):
                data = _bytes(text)
                first, end, names = runs(data, length)
                names = names & ~np.uint64(1)
                at = np.searchsorted(want, names)
                hit = np.flatnonzero(want[np.minimum(at, len(want) - 1)] == names)
                parts = []
                windows = window_keys(data, length) if is_hot[at[hit]].any() else None
                for i, a, z in zip(hit.tolist(), first[hit].tolist(), end[hit].tolist(), strict=True):
                    if is_hot[at[i]]:
                        parts += [(windows[w], w, w + length) for w in range(a, z - length + 1)]
                    else:
                        parts.append((names[i], a, z))
                for name, a, z in parts:
                    piece = data[a:z]
                    if (first_doc := seen.setdefault(piece, doc)) < doc:
                        if known and known[-1][0] == row and a <= known[-1][2] + known[-1][3]:
                            known[-1] = (*known[-1][:3], max(known[-1][3], z - known[-1][2]))
                        else:
                            known.append((row, doc, a, z - a))
                    elif first_doc == doc:
                        rows.append((name, row, doc, a, piece))
            if known:  # spans go along to any bucket
                put(key[0] % buckets, *map(list, zip(*known, strict=True)), None, None)
            if rows:
                names = np.array([r[0] for r in rows], np.uint64)
                b = _bucket(names, buckets)
                order = np.lexsort((names, b))
                for x, y in zip(*_split(b[order]), strict=True):
                    some = [rows[i] for i in order[x:y]]
                    # 32 bits of a name are enough to tell which runs of a bucket may be equal.
                    short = mix64(names[order[x:y]]).astype(np.uint32).tobytes()
                    put(int(b[order[x]]), [r[1] for r in some], [r[2] for r in some], [r[3] for r in some], [len(r[4]) for r in some], short, b"".join(r[4] for r in some))
        return pd.DataFrame(out)

    schema = "b int, g int, rows binary, docs binary, starts binary, sizes binary, names binary, data binary"
    return docs.groupBy("g").cogroup(shared.groupBy("g")).applyInPandas(texts_of, schema)


def repeated_spans(docs: DataFrame, staged: Staged, length: int = 50, group_bytes: int = GROUP_BYTES, hot: int = HOT) -> DataFrame:
    """(g, rows, starts, ends): for each bucket and group of documents int32 arrays of the spans [start, end)
    to remove, unmerged."""
    pieces = text_pieces(docs, staged, length, group_bytes, hot)

    def later(pdf: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[np.ndarray, ...]] = []  # groups, rows, starts, ends

        def columns(part: pd.DataFrame) -> tuple[np.ndarray, ...]:
            cat = lambda c, t: np.concatenate([np.frombuffer(x, t) for x in part[c]]).astype(np.int64)
            rows = cat("rows", np.int32)
            group = np.repeat(part["g"].to_numpy(), part["rows"].map(len).to_numpy() // 4)
            return group, rows, cat("docs", np.int64), cat("starts", np.int32), cat("sizes", np.int32)

        known, pdf = pdf[pdf["data"].isna()], pdf[pdf["data"].notna()]
        if len(known):
            group, rows, _, starts, sizes = columns(known)
            found.append((group, rows, starts, starts + sizes))
        if len(pdf):
            group, rows, docs_, starts, sizes = columns(pdf)
            names = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["names"]])
            data = b"".join(pdf["data"])
            at = np.concatenate(([0], np.cumsum(sizes)[:-1]))
            # Equal runs of text: all of larger documents than the smallest are copies as a whole; one stays here.
            seen: dict[bytes, int] = {}
            keep, copy = np.zeros(len(names), dtype=bool), np.zeros(len(names), dtype=bool)
            for i in np.argsort(docs_, kind="stable").tolist():
                first = seen.setdefault(data[at[i] : at[i] + sizes[i]], i)
                copy[i] = docs_[first] < docs_[i]
                keep[i] = docs_[first] == docs_[i]
            found.append((group[copy], rows[copy], starts[copy], starts[copy] + sizes[copy]))
            # A name with one run of text left has nothing to be compared with.
            order = np.argsort(names, kind="stable")
            order = order[keep[order]]
            first, end = _split(names[order]) if len(order) else (order, order)
            order = order[np.repeat(end - first > 1, end - first)]
            if len(order):
                order = order[np.argsort(docs_[order], kind="stable")]
                flat = np.frombuffer(b"".join(data[at[i] : at[i] + sizes[i]] for i in order.tolist()), np.uint8)
                sizes_ = sizes[order]
                base = np.concatenate(([0], np.cumsum(sizes_)[:-1]))
                windows = sizes_ - length + 1
                which = np.repeat(np.arange(len(order)), windows)
                inside = np.arange(len(which)) - np.repeat(np.concatenate(([0], np.cumsum(windows)[:-1])), windows)
                hit = longest_previous(flat, base[which] + inside, docs_[order][which], length)
                which, inside = order[which[hit]], inside[hit]
                found.append((group[which], rows[which], starts[which] + inside, starts[which] + inside + length))
        group, rows, start, end = (np.concatenate([f[i] for f in found]) for i in range(4))
        if not len(group):
            return pd.DataFrame({"g": [], "rows": [], "starts": [], "ends": []})
        sort = np.lexsort((start, rows, group))
        group, rows, start, end = group[sort], rows[sort], start[sort], end[sort]
        fresh = np.concatenate(([True], (group[1:] != group[:-1]) | (rows[1:] != rows[:-1]) | (start[1:] > end[:-1])))
        cut = np.flatnonzero(fresh)  # ends grow with starts inside one document but for overlaps of unequal runs
        stop = np.maximum.reduceat(end, cut)
        group, rows, start = group[cut], rows[cut], start[cut]
        ints = lambda x: x.astype(np.int32).tobytes()
        out = [(int(group[a]), ints(rows[a:z]), ints(start[a:z]), ints(stop[a:z])) for a, z in zip(*_split(group), strict=True)]
        return pd.DataFrame(out, columns=["g", "rows", "starts", "ends"])

    return staged.write(pieces.groupBy("b").applyInPandas(later, "g int, rows binary, starts binary, ends binary"))


def merged(spans: np.ndarray) -> list[tuple[int, int]]:
    """Maximal intervals of an array of [start, end)."""
    out: list[tuple[int, int]] = []
    for a, z in spans[np.lexsort((spans[:, 1], spans[:, 0]))].tolist():
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(z, out[-1][1]))
        else:
            out.append((a, z))
    return out


def suffix_dedup(docs: DataFrame, length: int = 50, group_bytes: int = GROUP_BYTES, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept (binary): every document without the
    bytes covered by later copies of ``length``-byte strings."""
    staged = Staged(docs.sparkSession)
    spans = repeated_spans(docs, staged, length, group_bytes, hot)
    whole = _grouped(docs, count_groups(docs, group_bytes))

    def cut(pdf: pd.DataFrame, found: pd.DataFrame) -> pd.DataFrame:
        known = _numbered(pdf[pdf["doc_id"].notna() & pdf["text"].notna()])
        gone: dict[tuple, list[tuple[int, int]]] = {}
        if len(found):
            rows, starts, ends = (np.concatenate([np.frombuffer(x, np.int32) for x in found[c]]) for c in ("rows", "starts", "ends"))
            order = np.argsort(rows, kind="stable")
            rows, each = rows[order], np.stack([starts[order], ends[order]], axis=1)
            for a, z in zip(*_split(rows), strict=True):
                doc = known.iloc[int(rows[a])]
                gone[int(doc["doc_id"]), doc["text"]] = merged(each[a:z])
        out = []
        for doc, text in zip(pdf["doc_id"], pdf["text"], strict=True):
            data = _bytes(text)
            mine = gone.get((int(doc), text), []) if gone and pd.notna(doc) else []
            kept, at = [], 0
            for a, z in mine:
                kept.append(data[at:a])
                at = z
            kept.append(data[at:])
            out.append((doc, len(data), sum(z - a for a, z in mine), len(mine), b"".join(kept)))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept"]).astype({"doc_id": "Int64"})

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept binary"
    return whole.groupBy("g").cogroup(spans.groupBy("g")).applyInPandas(cut, schema)
