"""File sources and sinks: the raw order export (S1), the clean set.

Context tables and model metadata are in :mod:`orderlens.plans.models`
(S5, S6); the city dictionary reader is in :mod:`orderlens.operators.contexts`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderlens.operators.clean import clean_raw
from orderlens.functions.ops import Val, to_long
from orderlens.schema import DATE_COL, ROW_ID


def read_orders(spark: SparkSession, path: str, fmt: str = "csv",
                schema: T.StructType | None = None, multi_line: bool = False) -> DataFrame:
    """Read a raw order export.  CSV: header row, quoted fields; without a
    schema every column is text and the loader coerces the typed ones (bad
    values -> NULL).  Files are split into many tasks unless ``multi_line``
    says that quoted fields hold line ends, which makes each file one task."""
    if fmt == "csv":
        r = (spark.read.option("header", True).option("multiLine", multi_line)
             .option("escape", '"').option("mode", "PERMISSIVE"))
        if schema is not None:
            r = r.schema(schema)
        return r.csv(path)
    return spark.read.format(fmt).load(path)


def load_raw_data(spark: SparkSession, path: str, fmt: str = "csv",
                  schema: T.StructType | None = None, date_format: str | None = None,
                  id_col: str = ROW_ID, multi_line: bool = False) -> DataFrame:
    """Read + P1-P5.  ``id_col`` is the export's unique order id; it becomes
    the row key that the prior-order window, folds and models need, as long."""
    raw = read_orders(spark, path, fmt, schema, multi_line)
    if id_col not in raw.columns:
        raise ValueError(f"the export has no id column {id_col!r}; columns: {', '.join(raw.columns)}")
    key = to_long(Val(F.col(f"`{id_col}`"), raw.schema[id_col].dataType), f"row key {id_col}")
    return clean_raw(raw.withColumn(ROW_ID, key), date_format)


def write_orders_csv(df: DataFrame, path: str) -> None:
    """Write a raw order table as a CSV export (header, quoted)."""
    (df.write.mode("overwrite").option("header", True).option("escape", '"')
       .option("quoteAll", True).csv(path))


def write_clean(df: DataFrame, path: str, date_col: str = DATE_COL,
                max_records_per_file: int = 5_000_000) -> None:
    """The clean set as parquet partitioned by month (month filters prune).
    Rows are rebalanced by month first (large months are split over tasks, small
    ones share them), so a month is a few files; files are capped in rows."""
    (df.withColumn("sale_month", F.date_format(F.col(date_col), "yyyy-MM"))
       .hint("rebalance", "sale_month")
       .sortWithinPartitions("sale_month")
       .write.mode("overwrite").option("maxRecordsPerFile", max_records_per_file)
       .partitionBy("sale_month").parquet(path))


def read_clean(spark: SparkSession, path: str, months: list[str] | None = None) -> DataFrame:
    """S3: read the clean set back; ``months`` prunes partitions."""
    df = spark.read.parquet(path)
    if months:
        df = df.where(F.col("sale_month").isin(months))
    return df.drop("sale_month")
