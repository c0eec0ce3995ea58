"""Lookups: keyed (J1/J3), substring (J2) and top-n membership.

All are equi-joins without broadcast hints: Spark broadcasts a side by its
measured bytes (the runtime threshold), otherwise it sorts and merges, and AQE
splits hot keys.  NULL keys never match, so they are spread by a hash of the
row instead of meeting in one partition; keys named as heavy are spread over
``SALTS`` partitions, to which their one table row is copied.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderlens.functions.ops import LookupJoin, normalize_text


#: Partitions over which the rows of one heavy key are spread.
SALTS = 64
#: A key is heavy from this share of the rows on; so there are fewer than 1 / HEAVY of them.
HEAVY = 1 / 64


def heavy_values(df: DataFrame, cols: list[str], share: float = HEAVY) -> dict[str, list]:
    """Per column its values with at least ``share`` of the rows (NULL left out), from one
    sketch aggregate over all columns; at most 1 / share values a column reach the driver."""
    most = int(1 / share) + 1
    top = [F.expr(f"approx_top_k(`{c}`, {most}, {64 * most})").alias(f"t{i}") for i, c in enumerate(cols)]
    r = df.agg(F.count(F.lit(1)).alias("n"), *top).first()
    least = max(1.0, share * r["n"])
    return {c: [e["item"] for e in (r[f"t{i}"] or []) if e["item"] is not None and e["count"] >= least]
            for i, c in enumerate(cols)}


def left_lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str, heavy: list | tuple = (),
                heavy_on: tuple[Column, Column] | None = None) -> DataFrame:
    """``df`` left-joined to ``table`` on ``key = table_key`` (dropped from the
    result); the table's other column names must not occur in ``df`` and its key is unique.

    ``heavy`` are values that many rows hold, of the keys or of the two columns
    ``heavy_on`` = (of df, of table) that equal keys share."""
    mine, theirs = heavy_on or (key, F.col(table_key))
    own = F.xxhash64(*[F.col(f"`{c}`") for c in df.columns])
    spread = F.when(key.isNull(), own)
    copies = F.array(F.lit(0).cast("long"))
    if heavy:
        spread = spread.when(mine.isin(*heavy), F.pmod(own, F.lit(SALTS)))
        copies = F.when(theirs.isin(*heavy), F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))).otherwise(copies)
    t = table.withColumn("__lk_none", F.explode(copies) if heavy else F.lit(0).cast("long")).withColumnRenamed(table_key, "__lk_table")
    j = df.withColumns({"__lk_key": key, "__lk_spread": spread.otherwise(F.lit(0)).cast("long")})
    j = j.join(t, (F.col("__lk_key") == F.col("__lk_table")) & (F.col("__lk_spread") == F.col("__lk_none")), "left")
    return j.drop("__lk_key", "__lk_spread", "__lk_table", "__lk_none")


def keyed_lookup(df: DataFrame, key: Column, table: DataFrame, table_key: str,
                 out: dict[str, str]) -> DataFrame:
    """Left equi lookup; ``out`` = {new column: table column}.  The table key
    is unique by construction (aggregated context tables)."""
    t = table.select(F.col(table_key).alias("__lk_tkey"), *[F.col(src).alias(dst) for dst, src in out.items()])
    return left_lookup(df, key, t, "__lk_tkey")


def substring_match(haystacks: DataFrame, hay_col: str, table: DataFrame, match_field: str,
                    order_col: str, normalize: dict | None = None) -> DataFrame:
    """Best needle per distinct haystack: the longest raw needle contained in
    the normalised haystack wins; ties keep table order.

    Returns ``(hay_col, match)`` where ``match`` is the whole matched row as a
    struct; haystacks without a match are absent.  Texts are de-duplicated, and
    needles that are equal after normalisation are reduced to the winning one.
    A text then yields its distinct substrings of each length that some needle
    has, and these meet the needles in one equi-join on the whole needle, so
    neither shared prefixes nor many needles multiply the work.
    """
    norm = normalize or {}
    hay = (haystacks.select(F.col(hay_col).alias("__h")).where(F.col("__h").isNotNull())
                    .distinct()
                    .withColumn("__hn", normalize_text(F.col("__h"), norm)))
    raw = F.col(match_field).cast("string")
    rank = F.struct(-F.length(raw), F.col(order_col))
    needles = (table.where(F.col(match_field).isNotNull())
                    .select(F.struct(*[F.col(c) for c in table.columns]).alias("__row"),
                            normalize_text(raw, norm).alias("__nn"), rank.alias("__rank"))
                    .groupBy("__nn").agg(F.min_by("__row", "__rank").alias("__row"), F.min("__rank").alias("__rank")))
    # One small number for each needle length; bounded by the longest needle.
    lengths = sorted(r[0] for r in needles.select(F.length("__nn")).distinct().collect())
    parts = [F.expr(f"transform(sequence(1, greatest(length(__hn) - {n - 1}, 1)), i -> substring(__hn, i, {n}))")
             for n in lengths] or [F.array(F.lit(None).cast("string"))]
    pieces = hay.select("__h", F.explode(F.array_distinct(F.concat(*parts))).alias("__nn"))
    best = (pieces.join(needles, "__nn").groupBy("__h")
                  .agg(F.min_by("__row", "__rank").alias("__match")))
    return best.select(F.col("__h").alias(hay_col), F.col("__match").alias("match"))


def apply_lookup(df: DataFrame, lj: LookupJoin) -> DataFrame:
    """Execute a lookup filed by a feature op."""
    if lj.kind == "equi":
        return keyed_lookup(df, lj.key, lj.table, lj.table_key, lj.out)
    if lj.kind == "substring":
        (out_col,) = lj.out.keys()
        k = "__ss_key"
        texts = df.select(lj.key.alias(k))
        best = substring_match(texts, k, lj.table, lj.table_key, lj.params["order"], lj.params.get("normalize"))
        return left_lookup(df, lj.key, best.select(F.col(k).alias("__ss_h"), F.col("match").alias(out_col)), "__ss_h")
    raise ValueError(f"unknown lookup kind {lj.kind!r}")


def top_n_values(df: DataFrame, col: str, n: int) -> DataFrame:
    """The n most frequent non-null values (ties broken by value) -- A14."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).count()
              .orderBy(F.desc("count"), F.asc(col)).limit(n).select(col))
