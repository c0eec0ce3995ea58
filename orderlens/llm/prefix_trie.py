"""Conversation prefix trie (operator 11): composable monoid fingerprints.

Each conversation is rebuilt from the head of its base (its first h turns) and its own turns after
the first h. Rebuilt texts never exist: a sequence's fingerprint is the pair (sum of x_i * B^i, n)
modulo primes, and pairs combine by (s, n) * (t, m) = (s + B^n * t, n + m), so the product of a
rebuilt prefix follows from stored prefix sums of base and own turns by a few integer operations.
A row of the trie's paths is (conversation, depth, fingerprint, reference to a stored turn).

Prefix groups verify equality through those references: a stored turn's identity is a pair of
64-bit hashes, of which one exact grouping of all turns shows that each stands for one (role,
text); a group of one fingerprint must have one identity as its last turn and one group as its
parent. By induction over the depth equal groups are then equal sequences. If a check fails, all
is done again with other hash seeds.

A node belongs to its smallest member, so a conversation owns one run of its path, its segment,
and segments hang on nodes of others. Sums over subtrees are sums along segments (one window a
conversation) of the nodes' own values and of the totals of the segments that hang there; those
totals come by pointer doubling, in as many rounds as the logarithm of the deepest nesting of
segments, not of the depth of the trie. Ids of members that end at a node are chained by range
partitions into pieces of text, and the pieces are hashed in order, a batch at a time.

Defined results: rows with a null conv_id are left out; a null role or text counts as empty; turns
of equal number follow each other by their hashes, so repeated rows are turns of their own in a
defined order; a conversation may come out empty (no turns of its own after the head, no base) and
is then a member of the root alone; the hash and the base follow from the id, negative ids too
(their base is the next multiple towards zero); a conversation may be of any length; other columns
are ignored; an empty table has no root and gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import count

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.operators.ranking import running_sums

from .common import Staged, group_count

#: Every how many ids a base comes, and the number of possible head lengths.
GROUP, HEADS = 20, 4
#: Primes under 2^31 and bases of the fingerprint's three sums; two sums make one packed long.
PRIMES = (2147483647, 2147483629, 2147483587)
BASES = (1103515245, 1664525001, 1812433253)
#: Bits of a turn's position: conversations of up to 2^31 turns.
POSITION_BITS = 31
#: Rows a range partition should hold.
PART = 200_000

_WORD = r"[^\x20\x09-\x0D]+"
_SUMS = ("s0", "s1", "s2")


def power(i: Column, k: int) -> Column:
    """BASES[k] ** i modulo PRIMES[k], by squares."""
    prime, square = PRIMES[k], BASES[k]
    out = F.lit(1).cast("long")
    for bit in range(POSITION_BITS):
        factor = F.when(F.shiftright(i, bit).bitwiseAND(F.lit(1).cast("long")) == 1, F.lit(square).cast("long")).otherwise(F.lit(1).cast("long"))
        out = out * factor % F.lit(prime)
        square = square * square % prime
    return out


def term(k: int, position: Column, seed: int) -> Column:
    """x * B^position of a turn with the identity (a, b), in the k-th sum."""
    return F.pmod(F.xxhash64("a", "b", F.lit(seed + k)), F.lit(PRIMES[k])) * power(position, k) % F.lit(PRIMES[k])


def stored_turns(turns: DataFrame, seed: int, staged: Staged, parts: int) -> DataFrame:
    """conv_id, pos (from 1), a and b (identity of role and text), words, and the sums of x_i * B^i up to here."""
    order = [F.asc_nulls_first("turn"), "tie", "a", "b"]
    slim = turns.select("conv_id", "turn", F.xxhash64("role", "text").alias("tie"), *identity(seed), F.regexp_count("text", F.lit(_WORD)).cast("long").alias("words"))
    at = running_sums(slim, ["conv_id"], order, {"pos": F.lit(1).cast("long")}, parts, staged.write)
    at = at.select("conv_id", "pos", "a", "b", "words")
    # A term is under 2^31, so a long holds the sums of 2^32 turns.
    sums = running_sums(at, ["conv_id"], ["pos"], {s: term(k, F.col("pos"), seed) for k, s in enumerate(_SUMS)}, parts, staged.write)
    return staged.write(sums.withColumns({s: F.col(s) % PRIMES[k] for k, s in enumerate(_SUMS)}))


def identity(seed: int) -> list[Column]:
    return [F.xxhash64(F.lit(seed), "role", "text").alias("a"), F.xxhash64("text", "role", F.lit(~seed)).alias("b")]


def identities_hold(turns: DataFrame, seed: int) -> bool:
    """Whether each identity (a, b) stands for one (role, text): all texts are compared in full, equal ones once."""
    distinct = turns.groupBy(*identity(seed), "role", "text").agg(F.count("*").alias("n"))
    return distinct.groupBy("a", "b").agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def rebuilt_paths(stored: DataFrame) -> DataFrame:
    """conv_id, depth, a, b, words, f and g (fingerprint), last: a row for each turn of each rebuilt conversation,
    and one of depth 0."""
    turn = F.struct("pos", "a", "b", "words", *_SUMS)
    first = stored.where(F.col("pos") < HEADS)
    heads = first.groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("head"))  # at most HEADS - 1 turns
    convs = stored.groupBy("conv_id").agg(F.max("pos").alias("n")).withColumns({
        "h": F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(HEADS)).cast("int"),
        "base": F.col("conv_id") - F.col("conv_id") % GROUP,
    })
    of_base = heads.select(F.col("conv_id").alias("base"), F.col("head").alias("base_head"))
    convs = convs.join(heads, "conv_id").join(of_base, "base", "left")
    none = F.array().cast(heads.schema["head"].dataType)
    convs = convs.withColumn("base_head", F.slice(F.coalesce("base_head", none), F.lit(1), F.col("h")))
    convs = convs.withColumn("hb", F.size("base_head")).withColumn("length", F.col("hb") + F.greatest(F.col("n") - F.col("h"), F.lit(0)))
    # The product of the base's head, and of the own turns that it replaces.
    base, own = F.try_element_at("base_head", F.col("hb")), F.try_element_at("head", F.least(F.col("h"), F.size("head")))
    whole = F.lit(0).cast("long")
    convs = convs.withColumns({f"t{k}": F.when(F.col("hb") > 0, base[s]).otherwise(whole) for k, s in enumerate(_SUMS)})
    convs = convs.withColumns({f"u{k}": F.when(F.col("h") > 0, own[s]).otherwise(whole) for k, s in enumerate(_SUMS)})

    columns = ["a", "b", "words", *_SUMS]
    top = convs.select("conv_id", whole.alias("depth"), *[whole.alias(c) for c in columns], "length")
    head = convs.select("conv_id", "length", F.explode("base_head").alias("r")).select("conv_id", F.col("r.pos").alias("depth"), *[F.col(f"r.{c}") for c in columns], "length")
    links = convs.select("conv_id", "h", "hb", "length", *[f"{c}{k}" for c in "tu" for k in range(len(_SUMS))])
    rest = stored.where("pos > 0").join(links, "conv_id").where("pos > h")
    moved = {}
    for k, s in enumerate(_SUMS):
        # Own turns move up by as many places as the base's head is shorter than h: a factor B^(hb - h).
        back = F.lit(1).cast("long")
        for step in range(1, HEADS):
            back = F.when(F.col("h") - F.col("hb") == step, F.lit(pow(BASES[k], -step, PRIMES[k])).cast("long")).otherwise(back)
        moved[s] = (F.col(f"t{k}") + F.pmod(F.col(s) - F.col(f"u{k}"), F.lit(PRIMES[k])) * back % F.lit(PRIMES[k])) % F.lit(PRIMES[k])
    rest = rest.withColumns(moved).select("conv_id", (F.col("pos") - F.col("h") + F.col("hb")).alias("depth"), *columns, "length")
    rows = top.unionByName(head).unionByName(rest)
    return rows.select("conv_id", "depth", "a", "b", "words", packed(F.col("s0"), F.col("s1")).alias("f"), F.col("s2").alias("g"), (F.col("depth") == F.col("length")).alias("last"))


def packed(high: Column, low: Column) -> Column:
    return high * F.lit(1 << 31) + low


def prefix_groups(rows: DataFrame, seed: int) -> DataFrame:
    """One row per (depth, f, g): owner (smallest member), n_convs, words, the parent's fingerprint pf and pg,
    and sound: whether all members refer to turns of one identity there."""
    nodes = rows.groupBy("depth", "f", "g").agg(
        F.count("*").alias("n_convs"), F.min("conv_id").alias("owner"), F.min("words").alias("words"),
        F.min("a").alias("a"), F.min("b").alias("b"), ((F.min("a") == F.max("a")) & (F.min("b") == F.max("b"))).alias("sound"),
    )
    own = (F.shiftright("f", 31), F.col("f").bitwiseAND(F.lit((1 << 31) - 1)), F.col("g"))
    # A product without its last factor: a function of the fingerprint and the last turn's identity.
    less = [F.pmod(s - term(k, F.col("depth"), seed), F.lit(PRIMES[k])) for k, s in enumerate(own)]
    inner = lambda c: F.when(F.col("depth") > 0, c)
    return nodes.withColumns({"pf": inner(packed(less[0], less[1])), "pg": inner(less[2])}).drop("a", "b")


def subtree_totals(segments: DataFrame, staged: Staged) -> DataFrame:
    """owner, saved and leaves summed over each segment and all that hang below it, from (owner, up, saved, leaves).

    Round k adds the sums of those 2^k segments below, whose sums reach 2^k - 1 further down."""
    now = staged.write(segments)
    while not now.where("up is not null").isEmpty():
        below = now.where("up is not null").groupBy(F.col("up").alias("owner")).agg(F.sum("saved").alias("more"), F.sum("leaves").alias("most"))
        above = now.select(F.col("owner").alias("up"), F.col("up").alias("higher"))
        after = now.join(below, "owner", "left").join(above, "up", "left").select(
            "owner", F.col("higher").alias("up"),
            (F.col("saved") + F.coalesce("more", F.lit(0))).alias("saved"), (F.col("leaves") + F.coalesce("most", F.lit(0))).alias("leaves"),
        )
        after = staged.write(after)
        staged.drop(now)
        now = after
    return now.select("owner", "saved", "leaves")


def end_hashes(rows: DataFrame, parts: int) -> DataFrame:
    """depth, f, g, ends_sha256 for each node at which members end: their ids ascending, joined by commas."""
    key = ["depth", "f", "g"]
    ends = rows.where("last").select(*key, "conv_id")
    ends = ends.repartitionByRange(parts, *key, "conv_id").sortWithinPartitions(*key, "conv_id")

    def pieces(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                ids = pdf["conv_id"].astype(str)
                runs = (pdf[key] != pdf[key].shift()).any(axis=1).cumsum()
                out = pdf.groupby(runs.to_numpy())[[*key, "conv_id"]].first()
                out["ids"] = ids.groupby(runs.to_numpy()).agg(",".join)
                yield out

    dealt = ends.mapInPandas(pieces, "depth long, f long, g long, conv_id long, ids string")
    dealt = dealt.repartition(parts, *key).sortWithinPartitions(*key, "conv_id")

    def chain(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, digest = None, hashlib.sha256()
        for pdf in batches:
            out = []
            for depth, f, g, ids in zip(pdf["depth"], pdf["f"], pdf["g"], pdf["ids"], strict=True):
                if (depth, f, g) == now:
                    digest.update(b"," + ids.encode())
                    continue
                if now is not None:
                    out.append((*now, digest.hexdigest()))
                now, digest = (depth, f, g), hashlib.sha256(ids.encode())
            if out:
                yield pd.DataFrame(out, columns=[*key, "ends_sha256"])
        if now is not None:
            yield pd.DataFrame([(*now, digest.hexdigest())], columns=[*key, "ends_sha256"])

    return dealt.mapInPandas(chain, "depth long, f long, g long, ends_sha256 string")


def prefix_trie(table: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256: a row per node of the
    trie of the rebuilt conversations of (conv_id, turn, role, text)."""
    staged = Staged(table.sparkSession)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")]
    turns = table.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", *text)
    parts = group_count(turns.count(), PART)
    for seed in count(1, 10):
        if not identities_hold(turns, seed):
            continue
        rows = staged.write(rebuilt_paths(stored_turns(turns, seed, staged, parts)))
        nodes = staged.write(prefix_groups(rows, seed))
        if nodes.where("not sound").isEmpty():
            break

    children = nodes.where("depth > 0").groupBy((F.col("depth") - 1).alias("depth"), F.col("pf").alias("f"), F.col("pg").alias("g")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, ["depth", "f", "g"], "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    nodes = nodes.withColumns({"saved": (F.col("n_convs") - 1) * F.col("words"), "leaves": (F.col("n_children") == 0).cast("long")})
    nodes = staged.write(nodes.drop("sound", "words"))
    # Where each owner's segment starts, and on whose node it hangs.
    segments = nodes.groupBy("owner").agg(F.min(F.struct("depth", "pf", "pg")).alias("top"), F.sum("saved").alias("saved"), F.sum("leaves").alias("leaves"))
    segments = segments.select("owner", (F.col("top.depth") - 1).alias("depth"), F.col("top.pf").alias("f"), F.col("top.pg").alias("g"), "saved", "leaves")
    hosts = nodes.select("depth", "f", "g", F.col("owner").alias("up"))
    segments = staged.write(segments.join(hosts, ["depth", "f", "g"], "left").select("owner", "up", F.col("depth").alias("at"), "saved", "leaves"))
    totals = subtree_totals(segments.drop("at"), staged)
    hang = segments.where("up is not null").select("owner", "up", "at").join(totals, "owner")
    hang = hang.groupBy(F.col("up").alias("owner"), F.col("at").alias("depth")).agg(F.sum("saved").alias("hang_saved"), F.sum("leaves").alias("hang_leaves"))

    out = nodes.join(hang, ["owner", "depth"], "left").join(segments.select("owner", "up", "at"), "owner")
    out = out.withColumn("parent_conv_id", F.when(F.col("depth") == F.col("at") + 1, F.col("up")).otherwise(F.col("owner")))
    own = {c: F.col(c) + F.coalesce(f"hang_{c}", F.lit(0)) for c in ("saved", "leaves")}
    out = out.withColumns(own).drop("hang_saved", "hang_leaves", "up", "at", "pf", "pg")
    below = running_sums(out, ["owner"], [F.desc("depth")], {"saved_tokens": F.col("saved"), "n_leaves": F.col("leaves")}, parts, staged.write)
    return below.join(end_hashes(rows, parts), ["depth", "f", "g"], "left").select(
        F.col("owner").alias("conv_id"), "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )
