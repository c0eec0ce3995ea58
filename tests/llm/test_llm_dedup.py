"""Operators 8, 9 and 5 against brute force, and their stated results at the edges."""

from __future__ import annotations

import random

import numpy as np
import pytest

from orderlens.llm import minhash, substring, suffix
from orderlens.llm.common import Forest, Staged
from orderlens.llm.components import components

DOCS = "doc_id long, text string, ref long, node long, comp long, spans string, g int"


def frame(spark, rows):
    """Documents with extra columns whose names the operators use themselves."""
    return spark.createDataFrame([(i, t, 1, 2, 3, "x", 4) for i, t in rows], DOCS).repartition(3)


def prose(rng, n, vocabulary=400):
    return " ".join(f"w{rng.randrange(vocabulary)}x{rng.randrange(9)}" for _ in range(n))


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(1)
    passage = prose(rng, 60)
    base = prose(rng, 220)
    rows = [(i, prose(rng, rng.randint(5, 120))) for i in range(30)]
    rows += [(100 + i, prose(rng, 40) + " " + passage + " " + prose(rng, 30)) for i in range(5)]
    rows += [(200 + i, base) for i in range(4)]
    for i in range(30):
        words = base.split()
        words[rng.randrange(len(words))] = f"edit{i}"
        rows.append((300 + i, " ".join(words)))
    rows += [(400, None), (401, ""), (402, "one"), (403, "ONE"), (404, "one two"), (405, " \n\t "), (406, "a" * 300), (407, "a" * 90), (408, "é" * 40)]
    rows += [(500, prose(rng, 6000)), (None, passage), (None, None)]
    rng.shuffle(rows)
    return rows


def test_suffix_dedup_equals_brute_force(spark, corpus):
    got = {r.doc_id: r for r in suffix.suffix_dedup(frame(spark, corpus), 50, group_bytes=4_000).collect() if r.doc_id is not None}
    first: dict[bytes, int] = {}
    known = [(i, (t or "").encode()) for i, t in corpus if i is not None]
    for i, b in sorted(known):
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    for i, b in known:
        mark = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                mark[p : p + 50] = b"\1" * 50
        runs = sum(1 for p in range(len(b)) if mark[p] and (p == 0 or not mark[p - 1]))
        want = (len(b), sum(mark), runs, bytes(c for c, m in zip(b, mark) if not m))
        assert (got[i].n_bytes, got[i].n_removed, got[i].n_spans, bytes(got[i].kept)) == want, i
    assert sum(r.n_removed for r in got.values()) > 10_000


def test_suffix_dedup_edges(spark):
    assert suffix.suffix_dedup(frame(spark, [])).count() == 0
    text = "the same text in both rows of one id, long enough to match itself twice over"
    rows = suffix.suffix_dedup(frame(spark, [(1, text), (1, text), (2, text), (None, text)])).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in rows) == [(False, 1, 0), (False, 1, 0), (False, 2, len(text)), (True, 0, 0)]


def test_longest_previous_equals_brute_force():
    rng = np.random.default_rng(0)
    for length in (9, 17, 50):
        data = rng.integers(97, 99, 600).astype(np.uint8)
        data[300:420] = data[100:220]
        starts = np.arange(len(data) - length)
        owner = starts // 60
        got = suffix.longest_previous(data, starts, owner, length)
        seen: dict[bytes, int] = {}
        for s in starts:
            key = data[s : s + length].tobytes()
            assert got[s] == (seen.get(key, 10**9) < owner[s])
            seen.setdefault(key, owner[s])


def classes_by_force(rows, size, percent):
    known = sorted((i, minhash.shingles(t, size)) for i, t in rows if i is not None)
    forest = Forest(len(known))
    for a in range(len(known)):
        for b in range(a + 1, len(known)):
            x, y = known[a][1], known[b][1]
            if len(x) and len(y) and 100 * len(np.intersect1d(x, y)) >= percent * len(np.union1d(x, y)):
                forest.join(a, b)
    return {i: (len(s), known[forest.find(k)][0]) for k, (i, s) in enumerate(known)}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_classes_equal_brute_force(spark, corpus, size, percent):
    out = minhash.near_classes(frame(spark, corpus), size, percent, limit=6).collect()
    assert len(out) == len(corpus)
    want = classes_by_force(corpus, size, percent)
    for r in out:
        if r.doc_id is None:
            assert r.component_id is None and r.kept is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
            assert r.kept == (r.doc_id == r.component_id)


def test_near_classes_edges(spark):
    assert minhash.near_classes(frame(spark, [])).count() == 0
    rows = minhash.near_classes(frame(spark, [(7, "x y"), (7, "x y"), (9, "X  Y"), (3, None)])).collect()
    assert sorted((r.doc_id, r.component_id) for r in rows) == [(3, 3), (7, 7), (7, 7), (9, 7)]


def test_words_and_shingles():
    assert minhash.words_of("A b\tC\x0bd É") == ["a b".encode(), b"c", b"d", "É".encode()]
    assert len(minhash.shingles("a b c a b c a b", 3)) == 3
    assert (minhash.shingles("a b", 3) != minhash.shingles("b a", 3)).all()


def test_components_of_a_path_and_a_star(spark):
    rng = random.Random(5)
    names = rng.sample(range(1000), 60)
    links = list(zip(names[:39], names[1:40])) + [(names[40], n) for n in names[41:]] + [(5000, 5000), (None, 1), (5001, None)]
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long"), Staged(spark)).collect()}
    assert got == {n: min(names[:40]) for n in names[:40]} | {n: min(names[40:]) for n in names[40:]}
    assert components(spark.createDataFrame([], "a long, b long"), Staged(spark)).count() == 0


def test_passages_are_cut_and_clean_text_stays(spark, corpus):
    rng = random.Random(9)
    passage = prose(rng, 70).split()
    fuzzy = list(passage)
    for k in (11, 29, 50):
        fuzzy[k] = "changed"
    del fuzzy[40]
    clean = [(i, prose(rng, 150)) for i in range(20)]
    rows = clean + [
        (50, prose(rng, 30) + " " + " ".join(passage) + " " + prose(rng, 30)),
        (51, prose(rng, 30) + "\n" + " ".join(passage).upper() + "\n" + prose(rng, 30)),
        (52, prose(rng, 30) + " " + " ".join(fuzzy) + " " + prose(rng, 30)),
        (53, None), (54, ""), (55, " "), (None, " ".join(passage)), (56, prose(rng, 4000)),
    ]
    out = {r.doc_id: r for r in substring.substring_dedup(frame(spark, rows)).collect()}
    text = dict(rows)
    for i, t in clean + [(50, text[50]), (53, None), (54, ""), (55, " "), (None, text[None]), (56, text[56])]:
        assert out[i].text == t and not out[i].removed_spans
    assert set(out[50].asDict()) == {"doc_id", "text", "ref", "node", "comp", "spans", "g", "removed_spans"}
    for i in (51, 52):
        left = out[i].text.split()
        assert 55 <= len(left) <= 66
        kept, at = "", 0
        for a, z in out[i].removed_spans:
            kept, at = kept + text[i][at:a], z
        assert kept + text[i][at:] == out[i].text


def test_substring_edges(spark):
    assert substring.substring_dedup(frame(spark, [])).count() == 0
    same = " ".join(f"word{k}" for k in range(80))
    out = substring.substring_dedup(frame(spark, [(1, same), (1, same), (4, same)])).collect()
    assert sorted((r.doc_id, len(r.text)) for r in out) == [(1, len(same)), (1, len(same)), (4, 0)]


def test_chains_take_matches_in_order():
    pos, ref = [0, 10, 20, 30, 40, 300], [100, 110, 5, 130, 140, 150]
    assert sorted(map(sorted, substring.chains(pos, ref))) == [[0, 1, 3, 4]]
    assert substring.chains([3], [4]) == []


def chains_by_force(pos, ref):
    n, reach = len(pos), substring.MAX_GAP + substring.SHINGLE
    score, back = [], []
    for i in range(n):
        best = (float(substring.SHINGLE), -1)
        for j in range(i):
            d, e = pos[i] - pos[j], ref[i] - ref[j]
            if 0 < d <= reach and 0 < e <= reach:
                best = max(best, (score[j] + min(substring.SHINGLE, d, e) - substring.GAP_COST * (d + e), j))
        score.append(best[0])
        back.append(best[1])
    return score, back


def test_chains_link_within_reach_whatever_lies_far_off():
    for gap in (60, 100, 400, 900, 1300):
        pos = [*range(0, 200, 8), *range(200 + gap, 300 + gap, 8)]
        sizes = sorted(len(c) for c in substring.chains(pos, [p + 7 for p in pos]))
        assert sizes == ([38] if gap == 60 else [13, 25]), gap
    rng = random.Random(3)
    for _ in range(50):
        pos = sorted(rng.sample(range(600), 80))
        ref = [p + 5 if rng.random() < 0.7 else rng.randrange(600) for p in pos]
        score, _ = chains_by_force(pos, ref)
        best = substring.chains(pos, ref)[0]
        got = substring.SHINGLE + sum(
            min(substring.SHINGLE, pos[b] - pos[a], ref[b] - ref[a]) - substring.GAP_COST * (pos[b] - pos[a] + ref[b] - ref[a])
            for a, b in zip(best[:-1], best[1:])
        )
        assert abs(got - max(score)) < 1e-9


def test_two_passages_of_one_pair_far_apart_are_both_cut(spark):
    rng = random.Random(11)
    long_, short = prose(rng, 200), prose(rng, 100)
    rows = [(1, f"{long_} {prose(rng, 400)} {short}"), (2, f"{long_} {prose(rng, 400)} {short} {prose(rng, 30)}")]
    out = {r.doc_id: r for r in substring.substring_dedup(frame(spark, rows)).collect()}
    assert not out[1].removed_spans and len(out[2].removed_spans) == 2
    assert 425 <= len(out[2].text.split()) <= 432


def test_star_whose_centre_is_not_the_smallest_id(spark):
    rng = random.Random(2)
    base = [f"b{k}" for k in range(300)]
    rows = [(70, " ".join(base))]
    for i in [*range(70), *range(71, 160)]:
        words = list(base)
        for k in range(8):
            words[rng.randrange(k * 37 + 3, k * 37 + 34)] = f"e{i}x{k}"
        rows.append((i, " ".join(words)))
    sets = {i: minhash.shingles(t, 3) for i, t in rows}
    assert minhash.similar(sets[70], sets[0], 85) and not minhash.similar(sets[0], sets[1], 85)
    out = minhash.near_classes(frame(spark, rows), 3, 85, limit=6, block=16).collect()
    assert {r.doc_id: r.component_id for r in out} == {i: c for i, (_, c) in classes_by_force(rows, 3, 85).items()}
    assert {r.component_id for r in out} == {0} and [r.doc_id for r in out if r.kept] == [0]


def test_trees_follow_from_depth_and_threshold():
    for depth, percent in ((4, 85), (4, 80), (5, 85), (1, 100)):
        trees = minhash.tree_count(depth, percent)
        assert (1 - (percent / 100) ** depth) ** trees <= minhash.MISS


def test_a_line_of_many_documents_is_spread_over_buckets(spark, corpus):
    rng = random.Random(4)
    line = "all rights reserved, see the licence"
    rows = [(1000 + i, f"{prose(rng, 12)} {line} {prose(rng, 12)}") for i in range(300)]
    share = {}
    for hot in (2, 10**9):
        pieces = suffix.text_pieces(frame(spark, rows), Staged(spark), 50, 2_000, hot).where("data is not null")
        sent = [r.n for r in pieces.selectExpr("b", "octet_length(data) n").groupBy("b").sum("n").toDF("b", "n").collect()]
        share[hot] = max(sent) / sum(sent)
    assert share[2] < 0.15 < 0.5 < share[10**9]
    rows += corpus
    out = {r.doc_id: r for r in suffix.suffix_dedup(frame(spark, rows), 50, group_bytes=4_000, hot=2).collect()}
    first: dict[bytes, int] = {}
    known = [(i, (t or "").encode()) for i, t in rows if i is not None]
    for i, b in sorted(known):
        for p in range(len(b) - 49):
            first.setdefault(b[p : p + 50], i)
    for i, b in known:
        mark = bytearray(len(b))
        for p in range(len(b) - 49):
            if first[b[p : p + 50]] < i:
                mark[p : p + 50] = b"\1" * 50
        assert bytes(out[i].kept) == bytes(c for c, m in zip(b, mark) if not m), i


def removed_by_force(rows, length=50):
    """The kept bytes of each (id, text), judged by ids on the input."""
    known = [(i, (t or "").encode()) for i, t in rows if i is not None]
    first: dict[bytes, int] = {}
    for i, b in sorted(known):
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    out = {}
    for i, b in known:
        mark = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                mark[p : p + length] = b"\1" * length
        out[i, b] = bytes(c for c, m in zip(b, mark) if not m)
    return out


@pytest.mark.parametrize("hot", [2, 2048])
def test_suffix_dedup_of_rows_that_repeat_an_id(spark, hot):
    """Each row has spans of its own, and rows of one id don't remove one another's bytes."""
    rng = random.Random(12)
    a, b, c = (prose(rng, 60) for _ in range(3))
    rows = [(1, a), (5, a + " " + b), (5, c), (5, b), (5, c), (3, c[:120]), (9, b + a), (9, c), (9, None), (None, a)]
    rows += [(20 + i % 7, prose(rng, 20) + a[i : i + 90] + prose(rng, 9)) for i in range(60)]
    want = removed_by_force(rows)
    got = suffix.suffix_dedup(frame(spark, rows), 50, group_bytes=1_500, hot=hot).collect()
    assert len(got) == len(rows)
    expect = sorted((i, len((t or "").encode()), want[i, (t or "").encode()]) for i, t in rows if i is not None)
    assert sorted((r.doc_id, r.n_bytes, bytes(r.kept)) for r in got if r.doc_id is not None) == expect
    assert [bytes(r.kept) for r in got if r.doc_id is None] == [a.encode()]


def test_previous_factors_equal_brute_force():
    rng = np.random.default_rng(1)
    for length in (9, 17, 50):
        data = rng.integers(97, 99, 500).astype(np.uint8)
        data[300:400] = data[100:200]
        data[450:] = 97
        starts = rng.permutation(len(data) - length + 1)[:300]
        owner = np.sort(rng.integers(0, 9, len(data)))[starts]
        got = suffix.previous_factors(data, starts, owner, length)
        for k, s in enumerate(starts):
            best = 0
            for j, t in enumerate(starts):
                if owner[j] < owner[k]:
                    n = 0
                    while n < length and data[s + n] == data[t + n]:
                        n += 1
                    best = max(best, n)
            assert got[k] == best
    assert (suffix._smaller_before(np.array([3, 1, 2, 2, 0, 5])) == [-1, -1, 1, 1, -1, 4]).all()


def test_fenwick_chains_equal_the_quadratic_recurrence():
    rng = random.Random(21)
    for trial in range(300):
        n = rng.randint(1, 160)
        span = rng.choice([40, 200, 900])
        pos = sorted(rng.randrange(span) for _ in range(n))
        shift = [rng.choice([0, 3, 70, 300]) for _ in range(3)]
        ref = [max(0, p + rng.choice(shift) + (rng.randint(-9, 9) if rng.random() < 0.3 else 0)) if rng.random() < 0.8 else rng.randrange(span) for p in pos]
        if trial % 5 == 0:  # one straight run
            ref = [p + 12 for p in pos]
        pairs = sorted(set(zip(pos, ref)))
        pos, ref = [p for p, _ in pairs], [r for _, r in pairs]
        score, _ = chains_by_force(pos, ref)
        worth = lambda c: substring.SHINGLE + sum(
            min(substring.SHINGLE, pos[b] - pos[a], ref[b] - ref[a]) - substring.GAP_COST * (pos[b] - pos[a] + ref[b] - ref[a]) for a, b in zip(c[:-1], c[1:]))
        found = substring.chains(pos, ref)
        assert all(0 < pos[b] - pos[a] <= substring.MAX_GAP + substring.SHINGLE and ref[b] > ref[a] for c in found for a, b in zip(c[:-1], c[1:]))
        if max(score) > substring.SHINGLE:
            assert abs(worth(found[0]) - max(score)) < 1e-9, trial


def test_trees_answer_ranges():
    rng = random.Random(5)
    tree, known = substring.Reach(69), {}
    for k in range(400):
        at, value = rng.randrange(500), rng.random()
        tree.put(at, (value, k))
        known.setdefault(at, []).append((value, k))
        ask = rng.randrange(-5, 600)
        want = [x for p in range(ask - 69, ask - substring.SHINGLE + 1) for x in known.get(p, ())]
        assert tree.before(ask) == max(want, default=(-np.inf, -1))


def test_passages_of_rows_that_repeat_an_id(spark):
    """A row's spans are cut from that row alone."""
    rng = random.Random(31)
    a, b, c = (prose(rng, 60) for _ in range(3))
    out = substring.substring_dedup(frame(spark, [(1, a), (5, a + " " + b), (5, c), (5, c), (8, b)])).collect()
    left = sorted((r.doc_id, " ".join(r.text.split())) for r in out)
    assert left == sorted([(1, a), (5, b), (5, c), (5, c), (8, "")])


def test_recall_of_edited_passages(spark):
    """40 to 100 words with a similarity of 0.8 to 0.95, words changed at random places or at even distances."""
    rng = random.Random(77)
    words = lambda n: [f"w{rng.randrange(4000)}" for _ in range(n)]
    rows, kinds = [], {}
    for n in (40, 50, 70, 100):
        for rate in (0.05, 0.1, 0.15, 0.2, 8, 10):
            for _ in range(40):
                passage, i = words(n), len(kinds)
                edited = list(passage)
                places = rng.sample(range(n), round(n * rate)) if rate < 1 else range(rate - 1, n, rate)
                for j in places:
                    edited[j] = f"c{rng.randrange(10**6)}"
                rows.append((i, " ".join(words(60) + passage + words(60))))
                rows.append((100_000 + i, " ".join(words(60) + edited + words(60))))
                kinds[100_000 + i] = (n, rate)
    out = {r.doc_id: len(r.text.split()) for r in substring.substring_dedup(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    found: dict = {}
    for i, kind in kinds.items():
        found.setdefault(kind, []).append(out[i] < 120 + kind[0] * 0.5)
    share = {k: sum(v) / len(v) for k, v in found.items()}
    print(share)
    long_ = [x for (n, rate), x in share.items() if n >= 50 and rate != 0.2]
    assert sum(long_) / len(long_) >= 0.95 and min(long_) >= 0.8
    assert sum(share.values()) / len(share) >= 0.85
    assert all(out[i] == 120 + n for i, (n, _) in ((k - 100_000, kinds[k]) for k in kinds))


def test_text_that_repeats_itself_is_cut_whole(spark):
    rng = random.Random(41)
    junk = " ".join(["spam eggs"] * 400)
    rows = [(1, f"{prose(rng, 50)} {junk} {prose(rng, 50)}"), (2, f"{prose(rng, 70)} {junk} {prose(rng, 30)}")]
    out = {r.doc_id: r.text.split() for r in substring.substring_dedup(frame(spark, rows)).collect()}
    assert len(out[1]) == 900 and len(out[2]) <= 110 and out[2].count("spam") <= 5
