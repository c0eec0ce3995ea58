"""Context tables for the feature ops (B2 = A1-A3 + the city dictionary).

All are small aggregates with unique keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.functions.ops import MapTable, RowsTable, Val, plain_text
from orderlens.schema import (BIG_CITY_POPULATION, EXTRA_CITIES, MANAGER_COL, MGR_HIGH_RATE,
                              MGR_MID_RATE, MGR_TIERS, TARGET)

CITY_JSON_SCHEMA = T.StructType([
    T.StructField("name", T.StringType()),
    T.StructField("region", T.StructType([T.StructField("fullname", T.StringType())])),
    T.StructField("population", T.LongType()),
])


def read_city_json(spark: SparkSession, path: str) -> DataFrame:
    """S2 source: a JSON array of ``{name, region: {fullname}, population}``."""
    df = spark.read.schema(CITY_JSON_SCHEMA).json(path, multiLine=True)
    return df.withColumn("ord", F.monotonically_increasing_id())


def city_dictionary(raw_cities: DataFrame) -> DataFrame:
    """S2 + U2: rows with a non-empty name, region flattened, the fixed extra
    cities appended after the last row (``ord`` keeps table order)."""
    base = (raw_cities.where(F.col("name").isNotNull() & (F.col("name") != ""))
                      .select(F.col("ord").cast("long").alias("ord"), "name",
                              F.col("region.fullname").alias("region")))
    spark = raw_cities.sparkSession
    # appended rows sort after every input row (input ``ord`` < 2**62)
    extra = spark.createDataFrame([((1 << 62) + i, n, r) for i, (n, r) in enumerate(EXTRA_CITIES)],
                                  "ord long, name string, region string")
    return base.unionByName(extra)


def manager_key(df: DataFrame, col: str = MANAGER_COL):
    """Manager id as text; NULL is counted under 'nan'."""
    return F.coalesce(plain_text(Val(F.col(col), df.schema[col].dataType)), F.lit("nan"))


def manager_counts(df: DataFrame, col: str = MANAGER_COL) -> DataFrame:
    """A1: orders per manager."""
    return df.groupBy(manager_key(df, col).alias("manager")).agg(F.count(F.lit(1)).alias("n"))


def manager_tiers(df: DataFrame, col: str = MANAGER_COL, target: str = TARGET) -> DataFrame:
    """A2: mean target per manager -> mgr_high (>=0.4) / mgr_mid (>=0.2) / mgr_low."""
    rate = F.avg(F.col(target).cast("double"))
    high, mid, low = MGR_TIERS
    return (df.groupBy(manager_key(df, col).alias("manager")).agg(rate.alias("rate"))
              .select("manager",
                      F.when(F.col("rate") >= MGR_HIGH_RATE, F.lit(high))
                       .when(F.col("rate") >= MGR_MID_RATE, F.lit(mid))
                       .otherwise(F.lit(low)).alias("tier")))


def big_city_flags(raw_cities: DataFrame) -> DataFrame:
    """A3: name -> 1 for population >= 500k (missing population counts as 0)."""
    return (raw_cities.where(F.coalesce(F.col("population"), F.lit(0)) >= BIG_CITY_POPULATION)
                      .where(F.col("name").isNotNull())
                      .groupBy("name").agg(F.lit(1).alias("flag")))


def build_contexts(df: DataFrame, raw_cities: DataFrame) -> dict:
    """B2: context tables computed from ``df`` (pass a train-only frame to
    keep later months out of the manager statistics).  They are plans; stage
    them (:func:`orderlens.plans.models.save_contexts`) to share one
    computation between many builds."""
    cities = city_dictionary(raw_cities)
    tables = {
        "russia_cities": cities,
        "manager_map": manager_counts(df),
        "mgr_group_map": manager_tiers(df),
        "big_city_map": big_city_flags(raw_cities),
    }
    return {
        "russia_cities": RowsTable(tables["russia_cities"], order="ord"),
        "manager_map": MapTable(tables["manager_map"], "manager", "n"),
        "mgr_group_map": MapTable(tables["mgr_group_map"], "manager", "tier"),
        "big_city_map": MapTable(tables["big_city_map"], "name", "flag"),
    }
