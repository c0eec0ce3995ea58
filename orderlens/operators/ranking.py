"""Ranks and running sums that spread over tasks, whatever the size of a group.

A window puts all rows of one group (all rows, without a group) into one task.  Here rows are
range-partitioned by group and order together, so that a group of any size spreads over as many
partitions as its rows need.  Running sums start anew in each partition; one aggregate gives every
partition's totals, and what earlier partitions hold of a group is added to its rows.  Only the
first group of a partition can have begun before it, so there is at most one such offset a
partition, which bounds the broadcast table by the number of partitions.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderlens.session import stage_table


def running_sums(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], sums: dict[str, Column],
                 parts: int | None = None, stage: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """``df`` with one column per entry of ``sums``: the sum of that expression over the rows of the
    same ``keys`` up to and including this one by ``order``.

    Rows equal in all of ``order`` stay in one partition and follow each other in no defined order;
    make the order unique to define it and to let such rows spread.  NULL keys form a group.
    ``stage`` writes the range-partitioned rows (default: a table in the shared folder), which
    fixes the partition of each row.
    """
    spark = df.sparkSession
    stage = stage or (lambda t: stage_table(t, "ranked", spark))
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    names = list(sums)
    terms = {f"__t{i}": c for i, c in enumerate(sums.values())}
    by = [F.col(f"`{k}`").asc_nulls_first() for k in keys]
    ranged = stage(df.withColumns(terms).repartitionByRange(parts, *by, *order)
                     .withColumn("__part", F.spark_partition_id()))
    group = [F.col(f"`{k}`") for k in keys]
    totals = ranged.groupBy("__part", *group).agg(*[F.sum(t).alias(t) for t in terms])
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(F.col("__part").alias("__cpart"),
                          *[g.alias(f"__ck{i}") for i, g in enumerate(group)],
                          *[F.sum(t).over(before).alias(f"__c{t}") for t in terms],
                          F.count(F.lit(1)).over(before).alias("__earlier"))
    carry = carry.where("__earlier > 0").drop("__earlier")  # at most one row a partition
    here = Window.partitionBy("__part", *group).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    local = ranged.withColumns({f"__s{t}": F.sum(t).over(here) for t in terms})
    meets = F.col("__part") == F.col("__cpart")
    for i, g in enumerate(group):
        meets = meets & g.eqNullSafe(F.col(f"__ck{i}"))
    joined = local.join(F.broadcast(carry), meets, "left")
    whole = {n: F.when(F.col("__cpart").isNull(), F.col(f"__s{t}"))
                 .otherwise(F.coalesce(F.col(f"__s{t}") + F.col(f"__c{t}"), F.col(f"__s{t}"), F.col(f"__c{t}")))
             for n, t in zip(names, terms, strict=True)}
    kept = [F.col(f"`{c}`") for c in df.columns if c not in sums]
    return joined.select(*kept, *[c.alias(n) for n, c in whole.items()])


def ranked(df: DataFrame, order: Sequence[Column | str], name: str, keys: Sequence[str] = (),
           parts: int | None = None) -> DataFrame:
    """``df`` with the row's number (from 1) by ``order`` among the rows of its ``keys``."""
    return running_sums(df, keys, order, {name: F.lit(1).cast("long")}, parts)
