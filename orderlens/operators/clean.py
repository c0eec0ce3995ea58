"""Cleaning (P1-P13), the prior-order window (W1-W4) and the cohort union."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from orderlens.functions.ops import Val, is_numeric, is_string, to_double, to_long
from orderlens.operators.ranking import running_sums
from orderlens.schema import (CONTACT_COL, DATE_COL, DEAL_COUNT_COL, FALSE_TEXT, LEAKAGE_COLUMNS,
                              NAN_TOKEN, ROW_ID, TARGET, TRUE_TEXT, UNKNOWN_OUTCOME_COL)
from orderlens.session import stage_table


def _val(df: DataFrame, name: str) -> Val:
    return Val(F.col(f"`{name}`"), df.schema[name].dataType)


def drop_unknown_outcomes(df: DataFrame) -> DataFrame:
    """Drop rows whose outcome flag is true; NULL is kept."""
    if UNKNOWN_OUTCOME_COL not in df.columns:
        return df
    t = df.schema[UNKNOWN_OUTCOME_COL].dataType
    c = F.col(UNKNOWN_OUTCOME_COL)
    if isinstance(t, T.BooleanType):
        return df.filter(~c.eqNullSafe(True))
    if is_string(t):
        return df.filter(~F.coalesce(c.isin(list(TRUE_TEXT)), F.lit(False)))
    return df.filter(~F.coalesce(c.cast("double") == 1.0, F.lit(False)))


def target_to_int(df: DataFrame, col: str = TARGET) -> Column:
    """Boolean or 'True'/'true'/'False'/'false' -> 1/0; anything else fails."""
    t = df.schema[col].dataType
    c = F.col(col)
    bad = F.raise_error(F.concat(F.lit(f"{col}: value outside True/False: "),
                                 F.coalesce(c.cast("string"), F.lit("NULL"))))
    if isinstance(t, T.BooleanType):
        return F.when(c, F.lit(1)).when(~c, F.lit(0)).otherwise(bad).cast("int")
    if is_string(t):
        return (F.when(c.isin(list(TRUE_TEXT)), F.lit(1)).when(c.isin(list(FALSE_TEXT)), F.lit(0))
                 .otherwise(bad).cast("int"))
    return (F.when(c == 1, F.lit(1)).when(c == 0, F.lit(0)).otherwise(bad).cast("int"))


def _numeric(df: DataFrame, name: str) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("double")
    return to_double(_val(df, name))


def _timestamp(df: DataFrame, name: str, fmt: str | None = None) -> Column:
    if name not in df.columns:
        return F.lit(None).cast("timestamp_ntz")
    t = df.schema[name].dataType
    c = F.col(name)
    if isinstance(t, (T.TimestampType, T.TimestampNTZType)):
        return c
    if isinstance(t, T.DateType):
        return c.cast("timestamp_ntz")
    s = c.cast("string")
    parsed = F.try_to_timestamp(s, F.lit(fmt)) if fmt else F.try_to_timestamp(s)
    return parsed.cast("timestamp_ntz")


def clean_raw(df: DataFrame, date_format: str | None = None) -> DataFrame:
    """Drop unknown outcomes, normalise the target, coerce numbers and
    the date (bad -> NULL, prior count NULL -> 0), drop leakage columns."""
    df = drop_unknown_outcomes(df)
    df = df.withColumns({
        TARGET: target_to_int(df, TARGET),
        "sale_ts": _numeric(df, "sale_ts"),
        "lead_created_at": _numeric(df, "lead_created_at"),
        DATE_COL: _timestamp(df, DATE_COL, date_format),
        "lead_price": _numeric(df, "lead_price"),
        DEAL_COUNT_COL: F.coalesce(_numeric(df, DEAL_COUNT_COL), F.lit(0.0)),
    })
    return df.drop(*[c for c in LEAKAGE_COLUMNS if c in df.columns])


def prior_order_count(df: DataFrame, contact_col: str = CONTACT_COL,
                      created_col: str = "lead_created_at", id_col: str = ROW_ID,
                      count_col: str = DEAL_COUNT_COL) -> DataFrame:
    """Rebuild each contact's prior-order count as of every order.

    Per contact, rows are ordered by (created, NULL and NaN last; row id);
    ``rank`` is the 0-based position, ``total`` the contact's row count and
    ``last`` the last non-NULL snapshot in that order.  Result: ``rank`` if
    ``last < total`` else ``last - total + 1 + rank``.  NULL-contact rows keep
    their value.  ``created_col`` may be epoch seconds or a timestamp.

    Hot-contact safe, by one plan at every size, and over the four columns it needs alone:
    rows are counted by (contact, created, id), ``total`` and ``last`` are partial
    aggregates, and positions are running counts over range partitions of that key, so a
    contact's rows spread over as many tasks as they need, also those of one second.  The
    counts are written once as a narrow table; the result is a join to it, of which a reader
    computes only the columns it asks for.  Rows that share contact, time and id get
    successive counts, which are written once with the rows, so that all readers see the same.
    """
    if contact_col not in df.columns:
        return df
    cols = df.columns
    created = F.col(f"`{created_col}`")
    if isinstance(df.schema[created_col].dataType, (T.FloatType, T.DoubleType)):
        created = F.nanvl(created, F.lit(None).cast("double"))
    snap, contact = F.col(f"`{count_col}`"), F.col(f"`{contact_col}`")
    key = {"__c": contact, "__at": created, "__id": F.col(f"`{id_col}`")}
    known = df.where(contact.isNotNull()).select(*[v.alias(k) for k, v in key.items()], snap.alias("__snap"))
    rows = known.groupBy(*key).agg(F.count(F.lit(1)).alias("__n"))
    at = running_sums(rows, ["__c"], [F.asc_nulls_last("__at"), F.col("__id")], {"__upto": F.col("__n")})
    order_key = F.struct(F.col("__at").isNull(), F.col("__at"), F.col("__id"))
    per_contact = known.groupBy(F.col("__c").alias("__pc")).agg(
        F.count(F.lit(1)).alias("__total"),
        F.max(F.when(F.col("__snap").isNotNull(), F.struct(order_key.alias("o"), F.col("__snap").alias("s")))).alias("__top"))
    per_contact = per_contact.select("__pc", "__total", F.col("__top")["s"].alias("__last"))

    rank = (F.col("__upto") - F.col("__n")).cast("double")
    last, total = F.col("__last"), F.col("__total")
    fixed = F.when(last < total, rank).otherwise(last - total + 1 + rank)
    counts = stage_table(at.join(per_contact, F.col("__c") == F.col("__pc"))
                           .select(*key, "__n", fixed.cast("double").alias("__first")), "prior_counts")
    copies = not counts.where("__n > 1").isEmpty()

    meets = F.lit(True)
    for k, v in key.items():
        meets = meets & v.eqNullSafe(counts[k])
    j = df.join(counts, meets, "left")
    first = F.col("__first")
    if copies:
        first = first + (F.row_number().over(Window.partitionBy(*key).orderBy(*key)) - 1)
    out = j.withColumn(count_col, F.when(contact.isNull(), snap).otherwise(first).cast("double"))
    out = out.select(*[F.col(f"`{c}`") for c in cols])
    return stage_table(out, "prior") if copies else out


def is_new_column(threshold: float = 1.0) -> Column:
    """coalesce(prior count, 0) < threshold."""
    return F.coalesce(F.col(f"`{DEAL_COUNT_COL}`").cast("double"), F.lit(0.0)) < threshold


def split_new_returning(df: DataFrame, threshold: float = 1.0) -> tuple[DataFrame, DataFrame]:
    """Two filters over one plan (cache the input if both are used)."""
    flag = is_new_column(threshold)
    return df.filter(flag), df.filter(~flag)


def select_canonical_columns(df: DataFrame, feature_cols: list[str],
                             extra: list[str] | None = None) -> DataFrame:
    """Target, date, prior count, extras, features -- present ones, in
    order, without duplicates."""
    names = [TARGET, DATE_COL, DEAL_COUNT_COL] + list(extra or []) + list(feature_cols)
    keep = [c for c in dict.fromkeys(names) if c in df.columns]
    return df.select(*[F.col(f"`{c}`") for c in keep])


def normalize_string_categoricals(df: DataFrame, columns: list[str]) -> DataFrame:
    """Whole numbers -> integer text without '.0', exact above 2^53; a fraction fails the
    job; NULL and NaN -> NULL; absent columns ignored."""
    upd = {}
    for c in columns:
        if c not in df.columns:
            continue
        v = _val(df, c)
        if is_numeric(v.dtype):
            upd[c] = to_long(v, f"text of {c}").cast("string")
        else:
            upd[c] = v.col.cast("string")
    return df.withColumns(upd) if upd else df


def drop_missing_dates(df: DataFrame, col: str = DATE_COL) -> DataFrame:
    """P10."""
    return df.dropna(subset=[col])


def month_of(col: str = DATE_COL) -> Column:
    return F.date_format(F.col(col), "yyyy-MM")


def tree_prep(df: DataFrame, cat_cols: list[str], num_cols: list[str]) -> DataFrame:
    """Categoricals -> text with NULL as '__NaN__'; numbers -> double, NULL -> 0."""
    df = normalize_string_categoricals(df, cat_cols)
    upd = {c: F.coalesce(F.col(f"`{c}`"), F.lit(NAN_TOKEN)) for c in cat_cols if c in df.columns}
    upd.update({c: F.coalesce(to_double(_val(df, c)), F.lit(0.0))
                for c in num_cols if c in df.columns})
    return df.withColumns(upd)


def capped_prior_count(cap: int = 7) -> Column:
    """coalesce(count, 0), capped, as int."""
    d = F.coalesce(F.col(f"`{DEAL_COUNT_COL}`").try_cast("double"), F.lit(0.0))
    return F.least(d, F.lit(float(cap))).cast("int")


def union_cohorts(new_df: DataFrame, returning_df: DataFrame, feature_cols: list[str],
                  extra: list[str] | None = None) -> DataFrame:
    """U1 + P9: new rows keep their features, returning rows get NULL ones;
    ``is_new`` is 1/0."""
    extra = list(extra or [])
    new_slice = select_canonical_columns(new_df.withColumn("is_new", F.lit(1)),
                                         feature_cols, extra + ["is_new"])
    ret = returning_df.withColumn("is_new", F.lit(0))
    ret_slice = ret.select(*[F.col(f"`{c}`") for c in [TARGET, DATE_COL, DEAL_COUNT_COL] + extra + ["is_new"]
                             if c in ret.columns])
    out = new_slice.unionByName(ret_slice, allowMissingColumns=True)
    return out.select(*[F.col(f"`{c}`") for c in new_slice.columns])
