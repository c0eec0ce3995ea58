"""Operators 11, 12 and 13 against brute force, held-out urls, and their stated results at the edges."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from orderlens.llm import hard_negatives, prefix_trie, queries, url_filter

# ---------------------------------------------------------------- operator 11

TURNS = "conv_id long, turn long, role string, text string, depth int, owner long"


def trie_by_hand(rows):
    """Nodes by plain tuples; rows: (conv_id, turn, role, text)."""
    convs = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            convs[c].append((t is not None, t or 0, r or "", x or ""))
    own = {c: [(r, x) for *_, r, x in sorted(v, key=lambda k: k[:2])] for c, v in convs.items()}
    built = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(math.fmod(c, 20))
        built[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, s in built.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    words = lambda p: len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    kids = defaultdict(int)
    saved, leaves = defaultdict(int), defaultdict(int)
    for p in members:
        if p:
            kids[p[:-1]] += 1
    for p, m in members.items():
        for d in range(len(p) + 1):
            saved[p[:d]] += (len(m) - 1) * words(p)
            leaves[p[:d]] += p not in kids
    out = {}
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(built[c]) == len(p))
        parent = min(members[p[:-1]]) if p else None
        out[min(m), len(p)] = (parent, len(m), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest())
    assert len(out) == len(members)
    return out


def trie(spark, rows, parts=3):
    frame = spark.createDataFrame([(*r, 7, 8) for r in rows], TURNS).repartition(parts)
    return {(r.conv_id, r.depth): (r.parent_conv_id, r.n_convs, r.n_children, r.n_leaves, r.saved_tokens, r.ends_sha256) for r in prefix_trie.prefix_trie(frame).collect()}


def test_trie_equals_brute_force(spark):
    rng = np.random.default_rng(5)
    say = ["a b", "a  b\tc", "", "d", "é ü"]
    rows = []
    for c in [*range(0, 130), -7, -40, 400, 407]:
        n = int(rng.integers(1, 7))
        rows += [(c, t if t else None, ["user", "assistant", None][int(rng.integers(0, 3)) if t > 1 else 0], say[int(rng.integers(0, 3 if t < 2 else 5))]) for t in range(n)]
    rows += [(c, t, "user", f"x{t % 2} y") for c in range(1000, 1100) for t in range(4)]  # copies of one conversation
    rows += [(c, t, "user", "z" * (t + 1)) for c in range(2001, 2020) for t in range(2 * (c - 2000))]  # each goes on from the one before
    rows += [(None, 1, "user", "q"), (5000, 1, None, None), (5001, 1, "user", "long " * 20000)]
    assert trie(spark, rows) == trie_by_hand(rows)


def test_trie_of_many_partitions_and_long_conversations(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PART", 50)  # a conversation spreads over several partitions
    rows = [(c, t, "user", f"w{(t * t) % 7}" + (" end" if t == 240 + c % 3 else "")) for c in range(20, 32) for t in range(260)]
    assert trie(spark, rows) == trie_by_hand(rows)


def test_trie_at_the_edges(spark):
    assert trie(spark, []) == {}
    c = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(c, 1, "user", "only")]  # no base, and its one turn gives way to the head: a member without turns
    assert trie(spark, rows) == trie_by_hand(rows)
    assert [k for k in trie(spark, rows)] == [(c, 0)]
    twice = [(0, 1, "user", "a"), (0, 1, "user", "a"), (0, 1, "user", "a")]  # repeated rows are turns of their own
    assert trie(spark, twice) == trie_by_hand(twice)
    assert max(d for _, d in trie(spark, twice)) == 3


def test_fingerprints_compose():
    """The product of two sequences' pairs is the pair of the joined sequence, and shifting back undoes it."""
    x = [11, 22, 33, 44, 55]
    for prime, base in zip(prefix_trie.PRIMES, prefix_trie.BASES, strict=True):
        total = lambda s: sum(v * pow(base, i, prime) for i, v in enumerate(s, 1)) % prime  # noqa: B023, E731
        whole = total(x)
        tail = (whole - total(x[:2])) * pow(base, -2, prime) % prime
        assert tail == total(x[2:])
        assert (total(x[:2]) + tail * pow(base, 2, prime)) % prime == whole


# ---------------------------------------------------------------- operator 12

URLS = [
    (1, "https://WWW.Casino-Win.Example.ORG/en/14?page=2"), (2, "http://cheap-pills.example.net/en/1#x"), (3, None), (4, "no scheme"), (5, ""),
    (6, "http://example.org/es/x"), (7, "http://sub.example.org/en/1"), (8, "http://notexample.org/es/1"), (9, "http://x.com/fr/1"), (10, "http://x.com/de/1?q"),
    (11, "http://x.com"), (12, "http://com/de/"), (13, "://"), (14, "http://a?b/c://d"), (15, "http://ÄÖ.Example.net/ä ö#"), (16, "x://y.org/é\n/z?k"),
    (17, "http://" + "long" * 30000 + ".net/" + "p/" * 30000), (18, "http://news.example.net/es/3"), (18, "http://news.example.net/es/3"), (19, "http://org:80/"), (20, "http://x.org?a"),
]


@pytest.fixture(scope="module")
def model(spark):
    return url_filter.train(url_filter.default_labels(spark))


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host) :])[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def rule_of(host, path, rules):
    fits = [(len(h + p), v, h + p) for v, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[1:] if fits else (None, None)


def test_urls_split_and_ruled_as_by_hand(spark, model):
    frame = spark.createDataFrame([(i, u, "kept", 1) for i, u in URLS], "page_id long, url string, host string, rule int")
    out = url_filter.judge(frame, model, queries.URL_RULES).collect()
    assert sorted(r.page_id for r in out) == sorted(i for i, _ in URLS)
    urls = dict(URLS)
    for r in out:
        host, path = parts(urls[r.page_id])
        verdict, rule = rule_of(host, path, queries.URL_RULES)
        assert (r.host, r.path, r.rule) == (host, path, rule), r.page_id
        assert r.verdict == (verdict or ("block" if r.score > url_filter.BLOCK_ABOVE else "allow"))
    verdicts = {r.page_id: r.verdict for r in out}
    assert verdicts[2] == "block" and verdicts[18] == "allow" and verdicts[3] == verdicts[4] == verdicts[5] == "allow"
    empty = frame.where("page_id < 0")
    assert url_filter.judge(empty, model, queries.URL_RULES).count() == 0


def test_scores_equal_a_plain_computation(spark, model):
    """Buckets come from Spark's hash; the rest is counted by hand."""
    frame = spark.createDataFrame(URLS, "page_id long, url string")
    judged = url_filter.judge(frame, model).select("page_id", "score", "host", "path")
    for r in judged.collect():
        total = model.intercept
        for text, weights, share in ((r.host, model.host, 1.0), (r.path, model.path, url_filter.PATH_SHARE)):
            marked = f"\x02{text}\x03"
            grams = sorted({marked[i : i + n] for n in url_filter.SIZES for i in range(len(marked) - n + 1)}) if text else []
            if not grams:
                continue
            if len(grams) > 500:
                break
            hashed = spark.createDataFrame([(g, list(g)) for g in grams], "g string, c array<string>").select(
                F.coalesce(*[F.when(F.size("c") == n, F.xxhash64(F.lit(n), *[F.get("c", k) for k in range(n)])) for n in url_filter.SIZES]).alias("h"))
            found = {h.h % url_filter.BUCKETS for h in hashed.collect()}
            total += share * sum(weights[b] for b in found) / math.sqrt(len(found))
        else:
            assert abs(total - r.score) < 1e-9, r.page_id


def test_model_on_hosts_it_has_not_seen(spark, model):
    seen = {*url_filter.BLOCK_WORDS, *url_filter.ALLOW_WORDS}
    bad = ["mega-casino", "pokerjackpot", "best-bets-online", "adult-xxx-cam", "freepills", "spam-bots", "adtracker", "online-poker-slots", "warez-torrent", "payday-loans"]
    good = ["bluebird", "oldtownnews", "gardenclub", "city-library", "wintersports", "thren", "tionhe", "musicschool", "historyreview", "farmhouse-bread"]
    assert not seen & {*bad, *good}
    rows = [(w, k, f"https://www.{w}.example.net/en/{n}?page=2") for k, words in ((1, bad), (0, good)) for w in words for n in (3, 457)]
    out = url_filter.judge(spark.createDataFrame(rows, "w string, bad int, url string"), model).select("bad", "verdict").collect()
    right = sum((r.verdict == "block") == bool(r.bad) for r in out)
    assert right >= 0.9 * len(out)
    assert all(r.verdict == "allow" for r in out if not r.bad)


def test_training_table_with_one_class(spark):
    one = spark.createDataFrame([("http://a.net/", 1), (None, 0), ("http://b.net/", None)], "url string, blocked int")
    judged = url_filter.judge(spark.createDataFrame([("http://c.net/",)], "url string"), url_filter.train(one))
    assert [r.verdict for r in judged.collect()] == ["block"]


def test_plan_is_native(spark, model):
    frame = spark.createDataFrame(URLS, "page_id long, url string")
    plan = url_filter.judge(frame, model, queries.URL_RULES)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|Exchange|Join", plan)


# ---------------------------------------------------------------- operator 13

VECTORS = "vec_id long, label int, embedding array<double>, rank int, version long"


def negatives_by_hand(rows, step, low=30, high=90):
    use = {}
    for i, k, v in rows:
        if i is None or k is None or not v or any(c is None or not math.isfinite(c) for c in v):
            continue
        w = tuple(math.floor(256 * c) for c in v)
        if sum(c * c for c in w) < 2**63:
            use[i, k, w] = True
    out = []
    for a, k, v in use:
        if a % step:
            continue
        scores = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), m != k, i) for i, m, w in use if i != a and len(w) == len(v))
        best = [(-s, i) for s, other, i in scores if not other][:5]
        for s, p in best:
            fits = [(-t, i) for t, other, i in scores if other and low * s <= -100 * t <= high * s][:10]
            out += [(a, p, r, i, s, t) for r, (t, i) in enumerate(fits, 1)]
    return sorted(out)


def negatives(spark, rows, step=10, **sizes):
    frame = spark.createDataFrame([(i, k, v, 1, 2) for i, k, v in rows], VECTORS).repartition(4)
    return sorted(tuple(r) for r in hard_negatives.mine(frame, F.col("vec_id") % step == 0, **sizes).collect())


def test_negatives_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, int(rng.integers(0, 4)) if i % 3 else 1, rng.normal(size=6).round(1).tolist()) for i in range(400)]  # many ties, a large label
    rows += [(1000 + i, 1, rows[30][2]) for i in range(60)] + [(1100 + i, 2, rows[30][2]) for i in range(30)]  # copies
    rows += rows[:5]  # repeated rows
    rows += [(2000, 1, None), (2001, None, [1.0] * 6), (None, 1, [1.0] * 6), (2010, 1, [1.0, None] * 3), (2020, 1, [math.nan] * 6), (2030, 1, [math.inf] * 6), (2040, 1, [])]
    rows += [(2050, 1, [0.0] * 6), (2060, 7, [1.0] * 6), (2070, 1, [1.0, 2.0]), (2080, 1, [2.0, 1.0]), (2081, 2, [1.0, 1.0])]  # zero, a label alone, another length
    got = negatives(spark, rows, row_block=64, anchor_block=8)
    assert got == negatives_by_hand(rows, 10)
    assert len(got) > 1000
    assert got == negatives(spark, rows)  # whatever the blocks


def test_negatives_at_the_edges(spark):
    assert negatives(spark, []) == []
    # Zero scores: the window of a positive of zero holds the zeros, also those of smaller ids; negative ones have none.
    rows = [(10, 1, [1.0, 0.0]), (11, 1, [0.0, 1.0]), (3, 2, [0.0, 2.0]), (4, 2, [0.0, -1.0]), (12, 1, [-1.0, 0.0]), (5, 2, [-0.5, 0.0])]
    got = negatives(spark, rows)
    assert got == negatives_by_hand(rows, 10) == [(10, 11, 1, 3, 0, 0), (10, 11, 2, 4, 0, 0)]
    # An anchor id with two labels is two anchors; scores near the ends of a long stay exact; longer vectors take no part.
    big = 2.0**31 / 256
    rows = [(10, 1, [big, 0.25]), (10, 2, [big, 0.5]), (11, 1, [big, 1.0]), (12, 2, [big * 0.75, 1.0]), (13, 1, [1e300, 1.0]), (14, 2, [2 * big, 0.0])]
    got = negatives(spark, rows)
    assert got == negatives_by_hand(rows, 10) and got


def test_keys_sort_by_anchor_score_label_and_id():
    rng = np.random.default_rng(9)
    ends = [-(2**63), -1, 0, 1, 2**63 - 1]
    rows = [(int(rng.choice(ends)), int(rng.choice(ends)), int(rng.choice(ends)), int(rng.integers(0, 2)), int(rng.choice(ends))) for _ in range(300)]
    keys = hard_negatives.pack(*[np.array(c) for c in zip(*rows, strict=True)])
    assert [hard_negatives.unpack(k) for k in keys] == rows
    assert [hard_negatives.unpack(k) for k in sorted(keys)] == sorted(rows, key=lambda r: (r[0], r[1], -r[2], r[3], r[4]))
