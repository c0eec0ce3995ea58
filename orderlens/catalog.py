"""Registered queries: Spark callables ``(spark, sf_dir) -> DataFrame`` and,
where the result is SQL-expressible, the DuckDB oracle over the same raw
tables.  Every query reads the driver's tables (through the ``leads`` view)
in full; names match SURVEY §7.3.
"""

from __future__ import annotations

import os
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as _T

from orderlens.functions.ops import Val as _Val, register_op
from orderlens.operators import encode as enc
from orderlens.operators import metrics as met
from orderlens.operators.clean import (capped_prior_count, clean_raw, drop_missing_dates, is_new_column,
                                       normalize_string_categoricals, prior_order_count, tree_prep,
                                       union_cohorts)
from orderlens.operators.contexts import build_contexts
from orderlens.operators.lookups import heavy_values
from orderlens.operators.profile import (category_profile, drift_summary, feature_drift, month_timeline,
                                         numeric_histogram, rate_by_capped_count, value_counts_top)
from orderlens.plans import backtest as bt
from orderlens.plans import explain as xp
from orderlens.plans import models as mdl
from orderlens.plans import rolling as roll
from orderlens.plans.features import build_features, derive_feature_columns
from orderlens.plans.spec import load_feature_config
from orderlens.schema import DEAL_COUNT_COL, DEFAULT_CATEGORY_ORDERS, ROW_ID, TARGET
from orderlens.session import stage_table, staging_path
from orderlens.sources.leads import LEADS_SQL, city_table, leads_view

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# ---------------------------------------------------------------------------
# shared Spark stages
# ---------------------------------------------------------------------------

def cleaned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1-P5 over the leads view."""
    return clean_raw(leads_view(spark, sf_dir))


_PREPARED: dict = {}


def _state(spark: SparkSession, sf_dir: str) -> tuple:
    """Names, sizes and times of the input tables: a rewritten input is another input."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/*.parquet")
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path) or []
    return tuple(sorted((f.getPath().toString(), f.getLen(), f.getModificationTime()) for f in found))


def _once(spark: SparkSession, name: str, sf_dir: str, build):
    """``build()`` once per session and state of the input; a later state drops the one before."""
    k, state = (spark.sparkContext.applicationId, name, sf_dir), _state(spark, sf_dir)
    if k not in _PREPARED or _PREPARED[k][0] != state:
        _PREPARED[k] = (state, build())
    return _PREPARED[k][1]


def _prepared(spark: SparkSession, name: str, sf_dir: str, build):
    """Materialise a stage once per session as a parquet table in the shared
    folder (cuts lineage; survives executor loss; readers get pruning and
    pushdown), reused by every query that reads it -- the clean set the
    original project writes once and every later step reads."""
    from orderlens.session import stage_table
    return _once(spark, name, sf_dir, lambda: stage_table(build(), name, spark))


def clean_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S1 + P1-P5, staged once per session."""
    return _prepared(spark, "clean", sf_dir, lambda: cleaned(spark, sf_dir))


def with_prior(spark: SparkSession, sf_dir: str) -> DataFrame:
    """cleaned + W1: the clean set joined to its staged counts (built once per session).
    The clean set is stored first, so the counts read four of its columns, and each
    reader joins only the columns it needs."""
    return _once(spark, "prior", sf_dir, lambda: prior_order_count(clean_set(spark, sf_dir)))


def prior_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``with_prior`` staged once, for those who read whole rows several times."""
    return _prepared(spark, "prior_rows", sf_dir, lambda: with_prior(spark, sf_dir))


def new_cohort_features(spark: SparkSession, sf_dir: str, config: dict | None = None):
    """New-cohort rows with the default spec built (contexts from the same rows)."""
    def build():
        new = prior_rows(spark, sf_dir).filter(is_new_column())
        ctx = build_contexts(new, city_table(spark, sf_dir))
        return build_features(new, config or load_feature_config(), ctx)[0]
    if config is not None:
        new = with_prior(spark, sf_dir).filter(is_new_column())
        return build_features(new, config, build_contexts(new, city_table(spark, sf_dir)))
    feats = _prepared(spark, "features", sf_dir, build)
    from orderlens.plans.features import derive_feature_columns as _dfc
    return feats, _dfc(load_feature_config(), feats.columns)


# ---------------------------------------------------------------------------
# shared SQL (DuckDB) stages
# ---------------------------------------------------------------------------

DC = '"contact_Число сделок"'

CLEAN_SQL = LEADS_SQL + """,
clean AS (
  SELECT * EXCLUDE (buyout_flag, lead_status_id, closed_ts),
         CAST(buyout_flag AS INTEGER) AS buyout_flag
  FROM leads WHERE outcome_unknown IS DISTINCT FROM TRUE
),
ranked AS (
  SELECT *,
    row_number() OVER (PARTITION BY contact_id ORDER BY lead_created_at NULLS LAST, row_id) - 1 AS rnk__,
    count(*) OVER (PARTITION BY contact_id) AS total__,
    last_value(""" + DC + """ IGNORE NULLS) OVER (PARTITION BY contact_id
      ORDER BY lead_created_at NULLS LAST, row_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS last__
  FROM clean
),
prior AS (
  SELECT * EXCLUDE (rnk__, total__, last__, """ + DC + """),
    CASE WHEN contact_id IS NULL THEN """ + DC + """
         WHEN last__ < total__ THEN CAST(rnk__ AS DOUBLE)
         ELSE last__ - total__ + 1 + rnk__ END AS """ + DC + """
  FROM ranked
),
cohort AS (
  SELECT *, coalesce(""" + DC + """, 0) < 1 AS is_new__ FROM prior
)"""


def sql(body: str) -> str:
    return "WITH " + CLEAN_SQL + body


# ---------------------------------------------------------------------------
# queries
# ---------------------------------------------------------------------------

@query("load_clean", sql("\nSELECT * FROM clean"))
def q_load_clean(spark, sf_dir):
    """The clean set, written once per session to the shared
    folder (S4) and read back (S3); later stages read the same table."""
    return clean_set(spark, sf_dir)


@query("prior_count", sql(f"\nSELECT row_id, contact_id, {DC} AS prior_orders FROM prior"))
def q_prior_count(spark, sf_dir):
    """W1-W4, O1."""
    return with_prior(spark, sf_dir).select("row_id", "contact_id",
                                            F.col(f"`{DEAL_COUNT_COL}`").alias("prior_orders"))


@query("cohort_summary", sql("""
SELECT is_new__ AS is_new, count(*) AS orders,
       CAST(sum(buyout_flag) AS DOUBLE) / count(*) AS buyout_rate
FROM cohort GROUP BY is_new__"""))
def q_cohort_summary(spark, sf_dir):
    """P6, A12."""
    df = with_prior(spark, sf_dir)
    return (df.groupBy(is_new_column().alias("is_new"))
              .agg(F.count(F.lit(1)).alias("orders"),
                   (F.sum(TARGET) / F.count(F.lit(1))).alias("buyout_rate")))


PRICE_BIN_SQL = """
CASE WHEN lead_price IS NULL THEN 'unknown'
     WHEN lead_price > 0 AND lead_price <= 5000 THEN '0-5k'
     WHEN lead_price > 5000 AND lead_price <= 8000 THEN '5-8k'
     WHEN lead_price > 8000 AND lead_price <= 15000 THEN '8-15k'
     WHEN lead_price > 15000 AND lead_price <= 'inf'::DOUBLE THEN '15k+'
     ELSE 'nan' END"""


def _profile_sql(expr: str, known: list[str], where: str = "is_new__") -> str:
    known_sql = ", ".join(f"'{k}'" for k in known)
    return sql(f""",
cats AS (SELECT {expr} AS category, buyout_flag AS y FROM cohort WHERE {where}),
prof AS (
  SELECT category, CAST(sum(y) AS BIGINT) AS n_pos, count(y) AS n_total
  FROM cats WHERE category IS NOT NULL GROUP BY category
)
SELECT category, n_pos, n_total - n_pos AS n_neg, n_total,
       CASE WHEN n_total > 0 THEN CAST(n_pos AS DOUBLE) / n_total ELSE 0.0 END AS rate,
       CAST(row_number() OVER (ORDER BY
         coalesce(nullif(list_position([{known_sql}], category), 0), {1 << 30}),
         n_total DESC, category) - 1 AS INTEGER) AS position
FROM prof""")


@query("price_bin_profile", _profile_sql(PRICE_BIN_SQL, DEFAULT_CATEGORY_ORDERS["price_bin"]))
def q_price_bin_profile(spark, sf_dir):
    """Minimum slice: leads -> W1 -> price_bin -> A6 for new contacts."""
    spec = {"features": {"price_bin": load_feature_config()["features"]["price_bin"]}}
    df = with_prior(spark, sf_dir).filter(is_new_column())
    feats, _ = build_features(df, spec, {})
    return category_profile(feats, "price_bin", known_order=DEFAULT_CATEGORY_ORDERS["price_bin"])


# ---------------------------------------------------------------------------
# feature ops (F1-F19) and the feature frame (B1, B2)
# ---------------------------------------------------------------------------

SPEC = load_feature_config()["features"]


def _spec(**entries) -> dict:
    return {"features": entries}


def _q(name: str) -> str:
    return '"' + name + '"'


def _sql_groups(expr: str, groups: dict) -> str:
    from orderlens.functions.post import relabelled
    m = relabelled(groups)
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in m.items())
    return f"(CASE {expr} {whens} ELSE {expr} END)"


def _sql_bin(x: str, edges: list, labels: list, include_lowest: bool = False) -> str:
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        lo_s = "'-inf'::DOUBLE" if lo == float("-inf") else repr(float(lo))
        hi_s = "'inf'::DOUBLE" if hi == float("inf") else repr(float(hi))
        op = ">=" if include_lowest and i == 0 else ">"
        parts.append(f"WHEN {x} {op} {lo_s} AND {x} <= {hi_s} THEN '{lab}'")
    return "(CASE " + " ".join(parts) + " ELSE 'nan' END)"


def _edges(name: str) -> list:
    from orderlens.functions.ops import bin_edges
    op = SPEC[name]["op"]
    if op["name"] == "pipeline":
        op = op["steps"][-1]
    return bin_edges(op["bins"])


def _labels(name: str) -> list:
    op = SPEC[name]["op"]
    if op["name"] == "pipeline":
        op = op["steps"][-1]
    return op["bin_labels"]


CITY_SQL = """,
citydict AS (
  SELECT CAST(ord AS BIGINT) AS ord, name, region FROM cities WHERE name IS NOT NULL AND name <> ''
  UNION ALL SELECT (CAST(1 AS BIGINT) << 62) + 0, 'Ялта', 'Республика Крым'
  UNION ALL SELECT (CAST(1 AS BIGINT) << 62) + 1, 'Симферополь', 'Республика Крым'
  UNION ALL SELECT (CAST(1 AS BIGINT) << 62) + 2, 'Севастополь', 'Город федерального значения Севастополь'
),
hay AS (SELECT DISTINCT "contact_Город" AS h FROM cohort WHERE "contact_Город" IS NOT NULL),
cand AS (
  SELECT h, c.name, c.region,
         row_number() OVER (PARTITION BY h ORDER BY length(c.name) DESC, c.ord) AS rn
  FROM hay JOIN citydict c
    ON contains(replace(lower(h), 'ё', 'е'), replace(lower(c.name), 'ё', 'е'))
),
best AS (SELECT h, name AS city_name__, region AS city_region__ FROM cand WHERE rn = 1)"""

MGR_SQL = """,
mgr AS (
  SELECT coalesce(CAST(lead_responsible_user_id AS VARCHAR), 'nan') AS manager,
         count(*) AS n, avg(buyout_flag) AS rate
  FROM cohort WHERE is_new__ GROUP BY 1
)"""

CART_SQL = ("len(list_filter(list_transform(string_split(replace(\"lead_Состав заказа\", chr(10), ';'), ';'), "
            "lambda t: trim(t)), lambda t: t <> '' AND NOT contains(lower(t), 'доставк')))")
CART_N_SQL = (f"(CASE WHEN \"lead_Состав заказа\" IS NULL THEN 0 WHEN {CART_SQL} = 0 THEN 0 "
              f"ELSE greatest({CART_SQL}, 1) END)")
MGR_TEXT_SQL = "coalesce(CAST(lead_responsible_user_id AS VARCHAR), '__NaN__')"
DELTA_SQL = ("coalesce(CASE WHEN (sale_ts - lead_created_at) / 86400 < 0 THEN 0 "
             "ELSE (sale_ts - lead_created_at) / 86400 END, 0.0)")
WEEKDAY_SQL = "coalesce(CAST(isodow(sale_date) - 1 AS VARCHAR), 'nan')"


def _feature_sql() -> dict[str, str]:
    """SQL of each default-spec feature over a row of ``newc`` joined to
    ``best`` (city match) and ``mgr`` (manager stats)."""
    g = {n: SPEC[n].get("groups") for n in SPEC}
    cat = lambda c: f"coalesce({_q(c)}, '__NaN__')"
    return {
        "lead_Вид оплаты": _sql_groups(cat("lead_Вид оплаты"), g["lead_Вид оплаты"]),
        "lead_Тариф Доставки": _sql_groups(cat("lead_Тариф Доставки"), g["lead_Тариф Доставки"]),
        "lead_Квалификация лида": _sql_groups(_q("lead_Квалификация лида"),
                                              g["lead_Квалификация лида"]),
        "lead_Категория и варианты выбора": _q("lead_Категория и варианты выбора"),
        "lead_responsible_user_id": MGR_TEXT_SQL,
        "lead_group_id": "CAST(CASE WHEN lead_group_id = 0 THEN NULL ELSE lead_group_id END AS VARCHAR)",
        "lead_Служба доставки": _sql_groups(cat("lead_Служба доставки"), g["lead_Служба доставки"]),
        "price_bin": PRICE_BIN_SQL,
        "sale_weekday": WEEKDAY_SQL,
        "cart_n_items": CART_N_SQL,
        "cart_bin": _sql_bin(CART_N_SQL, _edges("cart_bin"), _labels("cart_bin")),
        "manager_deal_count": "coalesce(mgr_n.n, 1)",
        "manager_bin": _sql_bin("coalesce(mgr_n.n, 1)", _edges("manager_bin"), _labels("manager_bin")),
        "mgr_group": ("coalesce(CASE WHEN mgr_n.rate >= 0.4 THEN 'mgr_high' WHEN mgr_n.rate >= 0.2 "
                      "THEN 'mgr_mid' WHEN mgr_n.rate IS NOT NULL THEN 'mgr_low' END, 'mgr_low')"),
        "delta_bin": _sql_bin(DELTA_SQL, _edges("delta_bin"), _labels("delta_bin"), True),
        "utm_product": "coalesce(string_split(lead_utm_source, '_')[4], '__NaN__')",
        "utm_brand": "coalesce(string_split(lead_utm_source, '_')[5], '__NaN__')",
        "has_future_purchase": "CAST(\"lead_будущие покупки\" IS NOT NULL AS INTEGER)",
        "is_paid_traffic": ("CAST(coalesce(lead_utm_medium IN ('cpc', 'cpc__rt_view-yes_lead-no_all', "
                            "'Bloger', 'article_direct', 'cpm'), false) AS INTEGER)"),
        "city_clean": "coalesce(best.city_name__, '__unknown__')",
        "contact_region": "coalesce(best.city_region__, '__unknown__')",
    }


FEATURE_SQL = _feature_sql()
BUILT = list(FEATURE_SQL)  # default spec minus the two features without a source column
FEAT_CTE = CITY_SQL + MGR_SQL + """,
newc AS (SELECT * FROM cohort WHERE is_new__),
feat AS (
  SELECT newc.row_id, newc.buyout_flag, newc.sale_date, newc.""" + DC[1:-1].join('""') + """ AS deals__,
         """ + ",\n         ".join(f"{e} AS {_q(n)}" for n, e in FEATURE_SQL.items()) + """
  FROM newc
  LEFT JOIN best ON newc."contact_Город" = best.h
  LEFT JOIN mgr AS mgr_n ON """ + MGR_TEXT_SQL.replace("lead_responsible_user_id", "newc.lead_responsible_user_id") + """ = mgr_n.manager
)"""


def _feature_cols(names: list[str]):
    return [F.col(f"`{n}`") for n in names]


@query("feature_frame", sql(FEAT_CTE + "\nSELECT row_id, buyout_flag, " +
                            ", ".join(_q(n) for n in BUILT) + " FROM feat"))
def q_feature_frame(spark, sf_dir):
    """B1 + B2: the default spec on new contacts (two features skip: no source)."""
    feats, _ = new_cohort_features(spark, sf_dir)
    return feats.select("row_id", TARGET, *_feature_cols(BUILT))


def _ops_frame(spark, sf_dir, entries: dict, new_only: bool = False):
    df = with_prior(spark, sf_dir)
    if new_only:
        df = df.filter(is_new_column())
    ctx = {}
    if any(e.get("op", {}).get("name") in ("map", "substring_lookup") for e in entries.values()):
        ctx = build_contexts(df, city_table(spark, sf_dir))
    return build_features(df, {"features": entries}, ctx)[0]


@query("op_identity_cast", sql("""
SELECT row_id, lead_price AS price_identity,
       coalesce(CAST(lead_price AS VARCHAR), 'nan') AS price_text,
       CAST(""" + DC + """ AS BIGINT) AS prior_int,
       CAST(lead_group_id AS DOUBLE) AS group_float
FROM cohort"""))
def q_op_identity_cast(spark, sf_dir):
    """F1, F2."""
    f = _ops_frame(spark, sf_dir, {
        "price_identity": {"type": "numeric", "op": {"name": "identity", "source": "lead_price"}},
        "price_text": {"type": "numeric", "op": {"name": "cast", "source": "lead_price", "to": "str"}},
        "prior_int": {"type": "numeric", "op": {"name": "cast", "source": DEAL_COUNT_COL, "to": "int"}},
        "group_float": {"type": "numeric", "op": {"name": "cast", "source": "lead_group_id", "to": "float"}},
    })
    return f.select("row_id", "price_identity", "price_text", "prior_int", "group_float")


@query("op_arithmetic_chain", sql("""
, c AS (SELECT row_id, CASE WHEN lead_price > 1000 THEN CAST(1000 AS DOUBLE) ELSE lead_price END AS p FROM cohort)
SELECT row_id, p / CAST(1000 AS DOUBLE) AS price_k,
       CASE WHEN row_id % 5 = 0 THEN NULL ELSE (p / CAST(1000 AS DOUBLE)) / CAST(row_id % 5 AS DOUBLE) END AS per_rest
FROM c"""))
def q_op_arithmetic_chain(spark, sf_dir):
    """a formula over an overwritten column, one over a built feature, and zero divisors (NULL)."""
    op = lambda formula, *names: {"type": "numeric", "op": {"name": "arithmetic", "sources": list(names),
                                                            "formula": formula}}
    spec = {"features": {
        "lead_price": {"type": "numeric", "op": {"name": "clip", "source": "lead_price", "upper": 1000}},
        "price_k": op("lead_price / 1000", "lead_price"),
        "per_rest": op("price_k / (row_id % 5)", "price_k", "row_id")}}
    feats, _ = build_features(with_prior(spark, sf_dir), spec, {})
    return feats.select("row_id", "price_k", "per_rest")


@query("big_id_text", sql("""
SELECT row_id, CAST(row_id + 9007199254740993 AS VARCHAR) AS id_text FROM cohort"""))
def q_big_id_text(spark, sf_dir):
    """Ids above 2^53 as exact text."""
    from orderlens.operators.clean import normalize_string_categoricals
    df = with_prior(spark, sf_dir).select("row_id", (F.col("row_id") + 9007199254740993).alias("id_text"))
    return normalize_string_categoricals(df, ["id_text"])


@query("op_fillna_clip", sql("""
SELECT row_id, coalesce(lead_price, 0.0) AS price_filled,
       CASE WHEN lead_price < 1000 THEN 1000.0 WHEN lead_price > 15000 THEN 15000.0
            ELSE lead_price END AS price_clipped,
       coalesce(CASE WHEN lead_price > 15000 THEN 15000.0 ELSE lead_price END, -1.0) AS price_pipeline
FROM cohort"""))
def q_op_fillna_clip(spark, sf_dir):
    """F3, F4 (and a clip->fillna chain)."""
    f = _ops_frame(spark, sf_dir, {
        "price_filled": {"type": "numeric", "op": {"name": "fillna", "source": "lead_price", "value": 0.0}},
        "price_clipped": {"type": "numeric", "op": {"name": "clip", "source": "lead_price",
                                                    "lower": 1000.0, "upper": 15000.0}},
        "price_pipeline": {"type": "numeric", "op": {"name": "pipeline", "steps": [
            {"name": "clip", "source": "lead_price", "upper": 15000.0},
            {"name": "fillna", "value": -1.0}]}},
    })
    return f.select("row_id", "price_filled", "price_clipped", "price_pipeline")


@query("op_not_null_is_in", sql("""
SELECT row_id, CAST("lead_будущие покупки" IS NOT NULL AS INTEGER) AS has_future_purchase,
       CAST(coalesce(lead_utm_medium IN ('cpc', 'cpc__rt_view-yes_lead-no_all', 'Bloger',
            'article_direct', 'cpm'), false) AS INTEGER) AS is_paid_traffic,
       CAST(coalesce(lead_group_id IN (1, 3), false) AS INTEGER) AS group_in
FROM cohort"""))
def q_op_not_null_is_in(spark, sf_dir):
    """F5, F6 (type-strict: the text '1' does not match the number 1)."""
    f = _ops_frame(spark, sf_dir, {
        "has_future_purchase": SPEC["has_future_purchase"],
        "is_paid_traffic": SPEC["is_paid_traffic"],
        "group_in": {"type": "binary", "op": {"name": "is_in", "source": "lead_group_id",
                                              "values": [1, 3, "1"]}},
    })
    return f.select("row_id", "has_future_purchase", "is_paid_traffic", "group_in")


@query("op_string_length", sql("""
SELECT row_id, CAST(length(coalesce("lead_Состав заказа", '')) AS BIGINT) AS order_text_len,
       CAST(length(coalesce(CAST(lead_price AS VARCHAR), '')) AS BIGINT) AS price_text_len
FROM cohort"""))
def q_op_string_length(spark, sf_dir):
    """F14."""
    f = _ops_frame(spark, sf_dir, {
        "order_text_len": {"type": "numeric", "op": {"name": "string_length", "source": "lead_Состав заказа"}},
        "price_text_len": {"type": "numeric", "op": {"name": "string_length", "source": "lead_price"}},
    })
    return f.select("row_id", "order_text_len", "price_text_len")


@query("op_map_manager", sql(MGR_SQL + """
SELECT c.row_id, coalesce(m.n, 1) AS manager_deal_count,
       coalesce(CASE WHEN m.rate >= 0.4 THEN 'mgr_high' WHEN m.rate >= 0.2 THEN 'mgr_mid'
                     WHEN m.rate IS NOT NULL THEN 'mgr_low' END, 'mgr_low') AS mgr_group,
       m2.n AS manager_raw_count
FROM cohort c
LEFT JOIN mgr m ON coalesce(CAST(c.lead_responsible_user_id AS VARCHAR), '__NaN__') = m.manager
LEFT JOIN mgr m2 ON coalesce(CAST(c.lead_responsible_user_id AS VARCHAR), 'nan') = m2.manager
WHERE c.is_new__"""))
def q_op_map_manager(spark, sf_dir):
    """F7, J1 (with and without default; text key: a NULL id is looked up as 'nan')."""
    f = _ops_frame(spark, sf_dir, {
        "lead_responsible_user_id": SPEC["lead_responsible_user_id"],
        "manager_deal_count": SPEC["manager_deal_count"],
        "mgr_group": SPEC["mgr_group"],
    }, new_only=True)
    raw = _ops_frame(spark, sf_dir, {
        "manager_raw_count": {"type": "numeric", "nan": "ignore",
                              "op": {"name": "map", "source": "lead_responsible_user_id",
                                     "table": "manager_map", "key_cast": "str"}},
    }, new_only=True)
    return (f.select("row_id", "manager_deal_count", "mgr_group")
             .join(raw.select("row_id", "manager_raw_count"), "row_id"))


@query("manager_tiers", sql(MGR_SQL + """
SELECT manager, n,
       CASE WHEN rate >= 0.4 THEN 'mgr_high' WHEN rate >= 0.2 THEN 'mgr_mid' ELSE 'mgr_low' END AS tier
FROM mgr"""))
def q_manager_tiers(spark, sf_dir):
    """A1, A2 over new contacts."""
    from orderlens.operators.contexts import manager_counts, manager_tiers
    new = with_prior(spark, sf_dir).filter(is_new_column())
    return manager_counts(new).join(manager_tiers(new), "manager")


@query("op_weekday", sql(f"""
SELECT row_id, {WEEKDAY_SQL} AS sale_weekday, CAST(month(sale_date) AS BIGINT) AS sale_month,
       CAST(year(sale_date) AS BIGINT) AS sale_year, CAST(quarter(sale_date) AS BIGINT) AS sale_quarter,
       CAST(dayofyear(sale_date) AS BIGINT) AS sale_dayofyear
FROM cohort"""))
def q_op_weekday(spark, sf_dir):
    """F8 (Monday = 0; missing -> 'nan' as text)."""
    attr = lambda a, **kw: {"type": "numeric", "op": {"name": "datetime_attr",
                                                      "source": "sale_date", "attr": a, **kw}}
    f = _ops_frame(spark, sf_dir, {
        "sale_weekday": SPEC["sale_weekday"], "sale_month": attr("month"),
        "sale_year": attr("year"), "sale_quarter": attr("quarter"),
        "sale_dayofyear": attr("dayofyear"),
    })
    return f.select("row_id", "sale_weekday", "sale_month", "sale_year", "sale_quarter", "sale_dayofyear")


@query("op_delta_pipeline", sql(f"""
SELECT row_id, {DELTA_SQL} AS delta_days,
       {_sql_bin(DELTA_SQL, _edges("delta_bin"), _labels("delta_bin"), True)} AS delta_bin
FROM cohort"""))
def q_op_delta_pipeline(spark, sf_dir):
    """arithmetic -> clip -> fill, then a right-closed bin."""
    steps = SPEC["delta_bin"]["op"]["steps"]
    f = _ops_frame(spark, sf_dir, {
        "delta_days": {"type": "numeric", "op": steps[0]},
        "delta_bin": SPEC["delta_bin"],
    })
    return f.select("row_id", "delta_days", "delta_bin")


@query("op_count_tokens", sql(f"""
SELECT row_id, {CART_N_SQL} AS cart_n_items,
       CASE WHEN "lead_Состав заказа" IS NULL THEN -1
            ELSE len(list_filter(list_transform(string_split(replace("lead_Состав заказа", chr(10), ';'), ';'),
                 lambda t: trim(t)), lambda t: t <> '')) END AS cart_tokens_all
FROM cohort"""))
def q_op_count_tokens(spark, sf_dir):
    """F10 (with exclusion + minimum, and plain)."""
    f = _ops_frame(spark, sf_dir, {
        "cart_n_items": SPEC["cart_n_items"],
        "cart_tokens_all": {"type": "numeric", "op": {"name": "count_tokens",
                                                      "source": "lead_Состав заказа",
                                                      "separators": [";", "\n"], "default": -1}},
    })
    return f.select("row_id", "cart_n_items", "cart_tokens_all")


@query("op_split_take", sql("""
SELECT row_id, coalesce(string_split(lead_utm_source, '_')[4], '__NaN__') AS utm_product,
       coalesce(string_split(lead_utm_source, '_')[5], '__NaN__') AS utm_brand,
       coalesce(string_split(lead_utm_source, '_')[-1], '__NaN__') AS utm_last,
       coalesce(string_split("lead_Вид оплаты", '-')[2], 'none') AS priority_name
FROM cohort"""))
def q_op_split_take(spark, sf_dir):
    """F15 (positive and negative index, default)."""
    st = lambda src, sep, i, d="__NaN__": {"type": "categorical", "nan": "ignore",
                                           "op": {"name": "split_take", "source": src,
                                                  "separator": sep, "index": i, "default": d}}
    f = _ops_frame(spark, sf_dir, {
        "utm_product": SPEC["utm_product"], "utm_brand": SPEC["utm_brand"],
        "utm_last": st("lead_utm_source", "_", -1),
        "priority_name": st("lead_Вид оплаты", "-", 1, "none"),
    })
    return f.select("row_id", "utm_product", "utm_brand", "utm_last", "priority_name")


@query("op_city_lookup", sql(CITY_SQL + """,
big AS (SELECT DISTINCT name FROM cities WHERE coalesce(population, 0) >= 500000 AND name IS NOT NULL)
SELECT c.row_id, coalesce(b.city_name__, '__unknown__') AS city_clean,
       coalesce(b.city_region__, '__unknown__') AS contact_region,
       CASE WHEN g.name IS NOT NULL THEN 1 ELSE 0 END AS is_big_city
FROM cohort c LEFT JOIN best b ON c."contact_Город" = b.h
LEFT JOIN big g ON coalesce(b.city_name__, '__unknown__') = g.name"""))
def q_op_city_lookup(spark, sf_dir):
    """One shared substring match feeds both
    features; the big-city flag maps the matched name."""
    f = _ops_frame(spark, sf_dir, {
        "city_clean": SPEC["city_clean"], "contact_region": SPEC["contact_region"],
        "is_big_city": {"type": "binary", "op": {"name": "map", "source": "city_clean",
                                                 "table": "big_city_map", "default": 0}},
    })
    return f.select("row_id", "city_clean", "contact_region",
                    F.col("is_big_city").cast("int").alias("is_big_city"))


@query("op_bins", sql(f"""
SELECT row_id, {PRICE_BIN_SQL} AS price_bin,
       {_sql_bin("lead_price", [0.0, 5000.0, 8000.0, 15000.0, float("inf")], ["a", "b", "c", "d"])} AS price_bin_raw,
       {_sql_bin("coalesce(lead_price, 0.0)", [0.0, 5000.0, 8000.0, 15000.0, float("inf")], ["a", "b", "c", "d"], True)} AS price_bin_low,
       {_sql_bin(CART_N_SQL, _edges("cart_bin"), _labels("cart_bin"))} AS cart_bin
FROM cohort"""))
def q_op_bins(spark, sf_dir):
    """right-closed, include_lowest, fillna inside the op, nan_label."""
    b = lambda **kw: {"type": "categorical", "nan": "ignore",
                      "op": {"name": "bin", "source": "lead_price",
                             "bins": [0, 5000, 8000, 15000, float("inf")],
                             "bin_labels": ["a", "b", "c", "d"], **kw}}
    f = _ops_frame(spark, sf_dir, {
        "price_bin": SPEC["price_bin"], "price_bin_raw": b(),
        "price_bin_low": b(include_lowest=True, fillna=0.0),
        "cart_n_items": SPEC["cart_n_items"], "cart_bin": SPEC["cart_bin"],
    })
    return f.select("row_id", "price_bin", "price_bin_raw", "price_bin_low", "cart_bin")


@query("post_nan_drop_cast_groups", sql(f"""
SELECT row_id, {FEATURE_SQL['lead_responsible_user_id']} AS manager_text,
       {FEATURE_SQL['lead_group_id']} AS group_text,
       {FEATURE_SQL['lead_Квалификация лида']} AS qualification,
       {FEATURE_SQL['lead_Служба доставки']} AS delivery,
       CASE WHEN coalesce(lead_price, -1.0) = -1.0 THEN NULL ELSE coalesce(lead_price, -1.0) END AS price_dropped,
       {_sql_groups("coalesce(lead_utm_medium, '__NaN__')", {"cpm": ["cpc"], "cpc": ["cpm"]})} AS medium_swapped
FROM cohort"""))
def q_post_nan_drop_cast_groups(spark, sf_dir):
    """Nan policy -> drop_values -> cast -> groups (simultaneous swap)."""
    f = _ops_frame(spark, sf_dir, {
        "manager_text": {**SPEC["lead_responsible_user_id"], "source": "lead_responsible_user_id"},
        "group_text": {**SPEC["lead_group_id"], "source": "lead_group_id"},
        "qualification": {**SPEC["lead_Квалификация лида"], "source": "lead_Квалификация лида"},
        "delivery": {**SPEC["lead_Служба доставки"], "source": "lead_Служба доставки"},
        "price_dropped": {"type": "numeric", "nan": "fill", "nan_value": -1.0, "drop_values": [-1.0],
                          "source": "lead_price"},
        "medium_swapped": {"type": "categorical", "source": "lead_utm_medium",
                           "groups": {"cpm": ["cpc"], "cpc": ["cpm"]}},
    })
    return f.select("row_id", "manager_text", "group_text", "qualification", "delivery",
                    "price_dropped", "medium_swapped")


# ---------------------------------------------------------------------------
# cohort union, canonical columns, tree prep
# ---------------------------------------------------------------------------


FC = derive_feature_columns(load_feature_config(), BUILT)
VISIBLE = FC.all_feature_cols


@query("clean_union", sql(FEAT_CTE + """
SELECT f.buyout_flag, f.sale_date, f.deals__ AS """ + DC + """, c.contact_id, c.row_id, 1 AS is_new, """ +
    ", ".join("f." + _q(n) for n in VISIBLE) + """
FROM feat f JOIN cohort c ON f.row_id = c.row_id
UNION ALL
SELECT buyout_flag, sale_date, """ + DC + """, contact_id, row_id, 0 AS is_new, """ +
    ", ".join(f"NULL AS {_q(n)}" for n in VISIBLE) + """
FROM cohort WHERE NOT is_new__"""))
def q_clean_union(spark, sf_dir):
    """New contacts with features + returning ones with NULL features."""
    df = with_prior(spark, sf_dir)
    new = df.filter(is_new_column())
    ctx = build_contexts(new, city_table(spark, sf_dir))
    feats, fc = build_features(new, load_feature_config(), ctx)
    return union_cohorts(feats, df.filter(~is_new_column()), fc.all_feature_cols,
                         extra=["contact_id", "row_id"])


STRING_CATS = ["lead_responsible_user_id", "lead_group_id", "lead_Вид оплаты", "contact_id"]


@query("string_categoricals", sql("""
SELECT row_id, CAST(lead_responsible_user_id AS VARCHAR) AS lead_responsible_user_id,
       CAST(lead_group_id AS VARCHAR) AS lead_group_id, "lead_Вид оплаты",
       CAST(contact_id AS VARCHAR) AS contact_id
FROM cohort"""))
def q_string_categoricals(spark, sf_dir):
    """Numeric codes -> integer text, NULL kept."""
    df = normalize_string_categoricals(with_prior(spark, sf_dir), STRING_CATS)
    return df.select("row_id", *[F.col(f"`{c}`") for c in STRING_CATS])


TREE_CAT = FC.cat_cols + FC.geo_cols + FC.te_cat_cols
TREE_NUM = FC.num_cols + FC.bin_cols


@query("tree_prep", sql(FEAT_CTE + "\nSELECT row_id, " +
                        ", ".join(f"coalesce({_q(c)}, '__NaN__') AS {_q(c)}" for c in TREE_CAT) + ", " +
                        ", ".join(f"coalesce(CAST({_q(c)} AS DOUBLE), 0.0) AS {_q(c)}" for c in TREE_NUM) +
                        "\nFROM feat WHERE sale_date IS NOT NULL"))
def q_tree_prep(spark, sf_dir):
    """Text categoricals with '__NaN__', numbers with 0."""
    feats, _ = new_cohort_features(spark, sf_dir)
    out = tree_prep(drop_missing_dates(feats), TREE_CAT, TREE_NUM)
    return out.select("row_id", *_feature_cols(TREE_CAT + TREE_NUM))


# ---------------------------------------------------------------------------
# profiles (A6-A14, O3)
# ---------------------------------------------------------------------------


PROFILED = ["price_bin", "delta_bin", "sale_weekday", "lead_Квалификация лида", "city_clean"]


def _feat_profile_sql(feature: str) -> str:
    known = DEFAULT_CATEGORY_ORDERS.get(feature, [])
    order = (f"coalesce(nullif(list_position([{', '.join(repr(k) for k in known)}], category), 0), {1 << 30})"
             if known else str(1 << 30))
    return f"""
  SELECT '{feature}' AS feature, category, n_pos, n_total - n_pos AS n_neg, n_total,
         CASE WHEN n_total > 0 THEN CAST(n_pos AS DOUBLE) / n_total ELSE 0.0 END AS rate,
         CAST(row_number() OVER (ORDER BY {order}, n_total DESC, category) - 1 AS INTEGER) AS position
  FROM (SELECT {_q(feature)} AS category, CAST(sum(buyout_flag) AS BIGINT) AS n_pos,
               count(buyout_flag) AS n_total
        FROM feat WHERE {_q(feature)} IS NOT NULL GROUP BY 1)"""


@query("category_profile", sql(FEAT_CTE + "\n" + "\nUNION ALL".join(_feat_profile_sql(f) for f in PROFILED)))
def q_category_profile(spark, sf_dir):
    """A6, O3 for several built features of new contacts (long form)."""
    from orderlens.operators.profile import category_profiles
    feats, _ = new_cohort_features(spark, sf_dir)
    return category_profiles(feats, PROFILED, known_orders={f: DEFAULT_CATEGORY_ORDERS[f] for f in PROFILED
                                                            if f in DEFAULT_CATEGORY_ORDERS})


@query("top_categories", sql("""
, counts AS (SELECT "contact_Город" AS category, count(*) AS n FROM cohort GROUP BY 1),
top AS (SELECT category, n FROM counts WHERE category IS NOT NULL ORDER BY n DESC, category LIMIT 10)
SELECT category, n, CAST(row_number() OVER (ORDER BY n DESC, category) AS INTEGER) AS rank,
       (SELECT count(*) FROM counts) AS n_distinct,
       (SELECT count(*) FROM cohort WHERE "contact_Город" IN (SELECT category FROM top)) AS rows_in_top
FROM top"""))
def q_top_categories(spark, sf_dir):
    """Top-10 cities, distinct count, rows kept by the semi join."""
    return value_counts_top(with_prior(spark, sf_dir), "contact_Город", 10)


HIST_SQL = """
, v AS (SELECT lead_price AS v, buyout_flag AS y FROM cohort WHERE lead_price IS NOT NULL),
r AS (SELECT CASE WHEN min(v) = max(v) THEN min(v) - 0.5 ELSE min(v) END AS lo,
             CASE WHEN min(v) = max(v) THEN max(v) + 0.5 ELSE max(v) END AS hi,
             round(avg(v), 6) AS mean_value FROM v),
s AS (SELECT lo, hi, (hi - lo) / 30 AS step, mean_value FROM r),
b0 AS (SELECT v.v, v.y, s.*, CAST(least(greatest(floor((v.v - s.lo) / s.step), 0), 29) AS BIGINT) AS b0
       FROM v, s),
b1 AS (SELECT *, CASE WHEN b0 > 0 AND v < b0 * step + lo THEN b0 - 1 ELSE b0 END AS b1 FROM b0),
b2 AS (SELECT *, CASE WHEN b1 < 29 AND v >= (CASE WHEN b1 + 1 >= 30 THEN hi ELSE (b1 + 1) * step + lo END)
                      THEN b1 + 1 ELSE b1 END AS bin FROM b1),
c AS (SELECT bin, count(*) AS n_total, CAST(sum(y) AS BIGINT) AS n_pos FROM b2 GROUP BY bin),
g AS (SELECT CAST(i AS INTEGER) AS bin FROM range(30) t(i))
SELECT g.bin, g.bin * s.step + s.lo AS lo,
       CASE WHEN g.bin + 1 >= 30 THEN s.hi ELSE (g.bin + 1) * s.step + s.lo END AS hi,
       coalesce(c.n_total, 0) AS n_total, coalesce(c.n_pos, 0) AS n_pos,
       coalesce(c.n_total, 0) - coalesce(c.n_pos, 0) AS n_neg,
       CASE WHEN coalesce(c.n_total, 0) > 0 THEN CAST(c.n_pos AS DOUBLE) / c.n_total END AS rate,
       s.mean_value
FROM g CROSS JOIN s LEFT JOIN c ON g.bin = c.bin"""


@query("numeric_histogram", sql(HIST_SQL))
def q_numeric_histogram(spark, sf_dir):
    """30 equal-width price bins over all cleaned orders."""
    h = numeric_histogram(with_prior(spark, sf_dir), "lead_price", bins=30)
    return h.withColumn("mean_value", F.round("mean_value", 6))


@query("month_timeline", sql("""
SELECT strftime(sale_date, '%Y-%m') AS month, is_new__ AS is_new, count(*) AS orders,
       CAST(sum(buyout_flag) AS DOUBLE) / count(*) AS buyout_rate
FROM cohort WHERE sale_date IS NOT NULL GROUP BY 1, 2"""))
def q_month_timeline(spark, sf_dir):
    """Orders and buyout rate by month and cohort."""
    return month_timeline(with_prior(spark, sf_dir), is_new_column())


DRIFT_CUTOFF = "1999-01-01"
DRIFT_FEATURE = "lead_Служба доставки"


@query("feature_drift", sql(FEAT_CTE + f"""
, d AS (SELECT coalesce({_q(DRIFT_FEATURE)}, '__NaN__') AS category, buyout_flag AS y,
               sale_date < TIMESTAMP '{DRIFT_CUTOFF}' AS pre, sale_date >= TIMESTAMP '{DRIFT_CUTOFF}' AS post
        FROM feat),
g AS (SELECT category, count(*) AS total, sum(CASE WHEN pre THEN 1 ELSE 0 END) AS n_pre,
             sum(CASE WHEN post THEN 1 ELSE 0 END) AS n_post,
             sum(CASE WHEN pre THEN y END) AS pos_pre, sum(CASE WHEN post THEN y END) AS pos_post
      FROM d GROUP BY category),
t AS (SELECT sum(n_pre) AS tp, sum(n_post) AS tq FROM g),
top AS (SELECT * FROM g ORDER BY total DESC, category LIMIT 8)
SELECT category, CAST(n_pre AS DOUBLE) / t.tp AS pre_share, CAST(n_post AS DOUBLE) / t.tq AS post_share,
       CASE WHEN n_pre > 0 THEN CAST(pos_pre AS DOUBLE) / n_pre END AS pre_rate,
       CASE WHEN n_post > 0 THEN CAST(pos_post AS DOUBLE) / n_post END AS post_rate,
       CAST(row_number() OVER (ORDER BY total DESC, category) - 1 AS INTEGER) AS position
FROM top, t"""))
def q_feature_drift(spark, sf_dir):
    """Delivery-service mix and rate before/after the cutoff (new contacts)."""
    feats, _ = new_cohort_features(spark, sf_dir)
    return feature_drift(feats, DRIFT_FEATURE, DRIFT_CUTOFF)


DRIFT_SPEC = [
    {"label": "avg_check", "column": "lead_price", "agg": "mean"},
    {"label": "cart_size", "column": "cart_n_items", "agg": "mean"},
    {"label": "share_cdek", "column": "lead_Служба доставки", "agg": "share", "value": "СДЭК"},
    {"label": "share_post", "column": "lead_Служба доставки", "agg": "share", "value": "Почта"},
    {"label": "buyout_rate", "column": "buyout_flag", "agg": "rate"},
    {"label": "rate_cdek", "column": "lead_Служба доставки", "agg": "rate", "value": "СДЭК"},
]


def _drift_summary_sql() -> str:
    pre = f"sale_date < TIMESTAMP '{DRIFT_CUTOFF}'"
    post = f"sale_date >= TIMESTAMP '{DRIFT_CUTOFF}'"
    rows = []
    for r in DRIFT_SPEC:
        col = _q(r["column"]) if r["column"] != "buyout_flag" else "f.buyout_flag"
        vals = []
        for p in (pre, post):
            if r["agg"] == "mean":
                e = f"avg(CASE WHEN {p} THEN CAST({col} AS DOUBLE) END)"
            elif r["agg"] == "share":
                e = (f"avg(CASE WHEN {p} AND {col} IS NOT NULL THEN CAST({col} = '{r['value']}' AS INTEGER) END)")
            elif "value" in r:
                e = f"avg(CASE WHEN {p} AND coalesce({col} = '{r['value']}', false) THEN f.buyout_flag END)"
            else:
                e = f"avg(CASE WHEN {p} THEN {col} END)"
            vals.append(f"round({e}, 6)")
        rows.append(f"SELECT '{r['label']}' AS label, {vals[0]} AS pre, {vals[1]} AS post FROM feat f")
    return "\n" + "\nUNION ALL ".join(rows)


@query("drift_summary", sql(FEAT_CTE.replace("SELECT newc.row_id,", "SELECT newc.row_id, newc.lead_price,")
                            + _drift_summary_sql()))
def q_drift_summary(spark, sf_dir):
    """A10: one aggregate pass, unpivoted (label, pre, post)."""
    feats, _ = new_cohort_features(spark, sf_dir)
    out = drift_summary(feats, DRIFT_SPEC, DRIFT_CUTOFF)
    return out.withColumns({c: F.round(c, 6) for c in ("pre", "post")})


@query("rate_by_prior_count", sql(f"""
SELECT CAST(least(coalesce({DC}, 0), 7) AS INTEGER) AS deals,
       CAST(sum(buyout_flag) AS DOUBLE) / count(*) AS buyout_rate,
       CAST(sum(buyout_flag) AS BIGINT) AS n_buyout, count(*) AS n_total
FROM cohort GROUP BY 1"""))
def q_rate_by_prior_count(spark, sf_dir):
    """A11, P13."""
    return rate_by_capped_count(with_prior(spark, sf_dir), capped_prior_count(7))


# ---------------------------------------------------------------------------
# encoding (A4, A5, E1-E5, J3, W5)
# ---------------------------------------------------------------------------


TE_CUTOFF = "1999-01-01"
TE_COLS = [(c, FC.te_alpha[c]) for c in FC.te_cols]


def _te_sql() -> str:
    parts, cols = [], []
    for c, a in TE_COLS:
        parts.append(f""",
m_{c} AS (SELECT {_q(c)} AS v, sum(buyout_flag) AS s, count(*) AS n FROM tr
          WHERE {_q(c)} IS NOT NULL GROUP BY 1)""")
        cols.append(f"coalesce((CAST(m_{c}.s AS DOUBLE) + g.g * {a}) / (m_{c}.n + {a}), g.g) AS {c}_te")
    joins = " ".join(f"LEFT JOIN m_{c} ON f.{_q(c)} = m_{c}.v" for c, _ in TE_COLS)
    return (FEAT_CTE + f""",
tr AS (SELECT * FROM feat WHERE sale_date < TIMESTAMP '{TE_CUTOFF}'),
g AS (SELECT CASE WHEN count(*) > 0 THEN CAST(sum(buyout_flag) AS DOUBLE) / count(*) ELSE 0.5 END AS g FROM tr)"""
            + "".join(parts) + f"\nSELECT f.row_id, {', '.join(cols)} FROM feat f CROSS JOIN g {joins}")


@query("target_encode", sql(_te_sql()))
def q_target_encode(spark, sf_dir):
    """Maps fitted on orders before the cutoff, applied to all
    new-contact orders (unseen -> global mean)."""
    feats, _ = new_cohort_features(spark, sf_dir)
    train = feats.where(F.col("sale_date") < F.to_timestamp_ntz(F.lit(TE_CUTOFF)))
    g = enc.global_mean(train, TARGET)
    out = feats.select("row_id", *_feature_cols([c for c, _ in TE_COLS]))
    heavy = heavy_values(out, [c for c, _ in TE_COLS])
    for c, a in TE_COLS:
        out = enc.apply_target_map(out, c, enc.target_map(train, c, TARGET, a, g), g, f"{c}_te", heavy[c])
    return out.select("row_id", *[f"{c}_te" for c, _ in TE_COLS])


def _te_oof_sql() -> str:
    parts, cols = [], []
    for c, a in TE_COLS:
        parts.append(f""",
vf_{c} AS (SELECT {_q(c)} AS v, fold, sum(buyout_flag) AS s, count(*) AS n FROM ff
           WHERE {_q(c)} IS NOT NULL GROUP BY 1, 2),
o_{c} AS (SELECT v, fold, sum(s) OVER (PARTITION BY v) - s AS so, sum(n) OVER (PARTITION BY v) - n AS no
          FROM vf_{c})""")
        cols.append(f"coalesce(CASE WHEN o_{c}.no > 0 THEN (CAST(o_{c}.so AS DOUBLE) + g.g * {a}) / "
                    f"(o_{c}.no + {a}) END, g.g) AS {c}_oof")
    joins = " ".join(f"LEFT JOIN o_{c} ON ff.{_q(c)} = o_{c}.v AND ff.fold = o_{c}.fold"
                     for c, _ in TE_COLS)
    return (FEAT_CTE + """,
ff AS (SELECT *, CAST(row_id % 5 AS INTEGER) AS fold FROM feat),
g AS (SELECT CAST(sum(buyout_flag) AS DOUBLE) / count(*) AS g FROM ff)""" + "".join(parts)
            + f"\nSELECT ff.row_id, ff.fold, {', '.join(cols)} FROM ff CROSS JOIN g {joins}")


@query("target_encode_oof", sql(_te_oof_sql()))
def q_target_encode_oof(spark, sf_dir):
    """E5, W5 (given fold = order key mod 5): other-fold smoothed means."""
    feats, _ = new_cohort_features(spark, sf_dir)
    te = [c for c, _ in TE_COLS]
    out = feats.withColumn("fold", (F.col("row_id") % 5).cast("int")).select("row_id", "fold", TARGET, *_feature_cols(te))
    g, heavy = enc.global_mean(out, TARGET), heavy_values(out, te)
    for c, a in TE_COLS:
        out = enc.oof_target_encode(out, c, TARGET, "fold", a, g, f"{c}_oof", heavy[c])
    return out.select("row_id", "fold", *[f"{c}_oof" for c, _ in TE_COLS])


@query("stratified_folds", sql("""
, y AS (SELECT buyout_flag AS label, count(*) AS n FROM cohort GROUP BY 1),
c AS (SELECT label, n, coalesce(sum(n) OVER (ORDER BY label NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS start FROM y)
SELECT label, CAST(f.i AS INTEGER) AS fold,
       CAST(n // 5 + CASE WHEN (f.i - start % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END AS BIGINT) AS n
FROM c CROSS JOIN range(5) f(i)
WHERE n // 5 + CASE WHEN (f.i - start % 5 + 5) % 5 < n % 5 THEN 1 ELSE 0 END > 0"""))
def q_stratified_folds(spark, sf_dir):
    """Fold sizes per class of the seeded, exactly stratified folds."""
    df = with_prior(spark, sf_dir).select("row_id", F.col(TARGET).alias("label"))
    return enc.stratified_folds(df, "label", 5).groupBy("label", "fold").agg(F.count(F.lit(1)).alias("n"))


def _ordered_ts_sql() -> str:
    w = "OVER (PARTITION BY {c} ORDER BY (row_id * 7919) % 10007, row_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"
    cols = [f"(coalesce(CAST(sum(buyout_flag) {w.format(c=_q(c))} AS DOUBLE), 0.0) + g.g * {a}) / (count(*) {w.format(c=_q(c))} + {a}) AS {c}_ots"
            for c, a in TE_COLS]
    return FEAT_CTE + f""",
g AS (SELECT CAST(sum(buyout_flag) AS DOUBLE) / count(*) AS g FROM feat)
SELECT row_id, {', '.join(cols)} FROM feat CROSS JOIN g"""


@query("ordered_target_stats", sql(_ordered_ts_sql()))
def q_ordered_target_stats(spark, sf_dir):
    """M3: ordered target statistics along a given permutation, the boosted trees' encoding of
    many-valued categories."""
    feats, _ = new_cohort_features(spark, sf_dir)
    te = [c for c, _ in TE_COLS]
    out = feats.select("row_id", TARGET, *_feature_cols(te))
    g = enc.global_mean(out, TARGET)
    order = [(F.col("row_id") * 7919) % 10007, F.col("row_id")]
    for c, a in TE_COLS:
        out = enc.ordered_target_statistics(out, [c], TARGET, a, g, [f"{c}_ots"], order)
    return out.select("row_id", *[f"{c}_ots" for c in te])


AS_OF_COL, AS_OF_ALPHA = TE_COLS[0]


@query("target_map_intervals", sql(FEAT_CTE + f"""
, vm AS (SELECT {_q(AS_OF_COL)} AS value, strftime(sale_date, '%Y-%m') AS after, CAST(sum(buyout_flag) AS BIGINT) AS s, count(*) AS n
         FROM feat WHERE sale_date IS NOT NULL AND {_q(AS_OF_COL)} IS NOT NULL GROUP BY 1, 2)
SELECT value, after, lead(after) OVER (PARTITION BY value ORDER BY after) AS upto,
       CAST(sum(s) OVER (PARTITION BY value ORDER BY after) AS BIGINT) AS s, CAST(sum(n) OVER (PARTITION BY value ORDER BY after) AS BIGINT) AS n
FROM vm"""))
def q_target_map_intervals(spark, sf_dir):
    """A value's statistics with the test months for which they hold."""
    return bt.target_map_intervals(new_cohort_features(spark, sf_dir)[0], AS_OF_COL)


@query("target_map_as_of", sql(FEAT_CTE + f"""
, d AS (SELECT row_id, {_q(AS_OF_COL)} AS value, strftime(sale_date, '%Y-%m') AS m, buyout_flag AS y FROM feat WHERE sale_date IS NOT NULL),
g AS (SELECT m, coalesce(CAST(sum(sum(y)) OVER w AS DOUBLE) / sum(count(*)) OVER w, 0.5) AS g FROM d GROUP BY m
      WINDOW w AS (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
v AS (SELECT a.row_id, sum(b.y) AS s, count(b.row_id) AS n FROM d a LEFT JOIN d b ON a.value = b.value AND b.m < a.m GROUP BY a.row_id)
SELECT d.row_id, CASE WHEN v.n > 0 THEN (CAST(v.s AS DOUBLE) + g.g * {AS_OF_ALPHA}) / (v.n + {AS_OF_ALPHA}) ELSE g.g END AS te
FROM d JOIN v ON d.row_id = v.row_id JOIN g ON d.m = g.m"""))
def q_target_map_as_of(spark, sf_dir):
    """Each order's encoding as of its own month, by an as-of join."""
    feats = new_cohort_features(spark, sf_dir)[0].select("row_id", TARGET, "sale_date", *_feature_cols([AS_OF_COL]))
    return bt.target_map_as_of(feats, AS_OF_COL, AS_OF_ALPHA).select("row_id", "te")


def _onehot_sql() -> str:
    items = ", ".join(f"{{'feature': '{c}', 'category': CAST({_q(c)} AS VARCHAR)}}" for c in FC.cat_cols)
    return FEAT_CTE + f""",
lg AS (SELECT row_id, unnest([{items}], recursive := true) FROM feat),
l AS (SELECT * FROM lg WHERE category IS NOT NULL),
voc AS (SELECT feature, category, CAST(dense_rank() OVER (PARTITION BY feature ORDER BY category) - 1 AS INTEGER)
        AS slot FROM (SELECT DISTINCT feature, category FROM l))
SELECT l.row_id, l.feature, l.category, l.feature || '_' || l.category AS onehot_col, voc.slot
FROM l JOIN voc USING (feature, category)"""


@query("one_hot_long", sql(_onehot_sql()))
def q_one_hot_long(spark, sf_dir):
    """E1 (long form), E6 slot order: sorted categories, NULL -> no slot."""
    feats, _ = new_cohort_features(spark, sf_dir)
    return enc.onehot_long(feats, FC.cat_cols)


@query("scaled_numeric", sql(f"""
, x AS (SELECT row_id, coalesce(CAST({DC} AS DOUBLE), 0.0) AS x, coalesce(lead_price, 0.0) AS price FROM cohort),
sd AS (SELECT avg(x) AS mean, coalesce(nullif(stddev_pop(x), 0), 1.0) AS std FROM x)
SELECT row_id, round((x - mean) / std, 9) AS prior_scaled, price AS price_passthrough FROM x, sd"""))
def q_scaled_numeric(spark, sf_dir):
    """E2 (population std; zero std -> 1) on the prior count, E3 pass-through."""
    df = with_prior(spark, sf_dir)
    st = enc.scale_stats(df, DEAL_COUNT_COL)
    return df.select("row_id", F.round(enc.scaled(df, DEAL_COUNT_COL, st), 9).alias("prior_scaled"),
                     enc.passthrough(df, "lead_price").alias("price_passthrough"))


# ---------------------------------------------------------------------------
# metrics on a fixed score
# ---------------------------------------------------------------------------


SCORE_SQL = ", sc AS (SELECT CAST((row_id * 7919) % 1000 AS DOUBLE) / 1000.0 AS p, buyout_flag AS y FROM cohort)"


def scored(spark, sf_dir, mult: int = 7919) -> DataFrame:
    """The cleaned orders with a fixed score (ties on purpose); ids and outcomes are staged
    once, as the metrics read them several times."""
    df = _prepared(spark, "outcomes", sf_dir, lambda: with_prior(spark, sf_dir).select("row_id", TARGET))
    return df.select(((F.col("row_id") * mult) % 1000).cast("double").__truediv__(F.lit(1000.0)).alias("p"),
                     F.col(TARGET).alias("y"), "row_id")


def _grid_sql(lo, hi, step) -> str:
    ts = met.grid(lo, hi, step)
    delta = ts[1] - ts[0]
    return (f"SELECT i, CAST({lo!r} AS DOUBLE) + CAST(i AS DOUBLE) * CAST({delta!r} AS DOUBLE) AS t "
            f"FROM range({len(ts)}) r(i)")


def _grid_counts_sql(lo, hi, step) -> str:
    return f""",
gr AS ({_grid_sql(lo, hi, step)}),
gc AS (SELECT gr.i, gr.t,
              sum(CASE WHEN y = 1 AND p >= t THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = 0 AND p >= t THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN y = 1 AND p < t THEN 1 ELSE 0 END) AS fn,
              sum(CASE WHEN y = 0 AND p < t THEN 1 ELSE 0 END) AS tn
       FROM gr CROSS JOIN sc GROUP BY gr.i, gr.t),
gf AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn)
                      ELSE 0.0 END AS f1 FROM gc)"""


@query("best_f1", sql(SCORE_SQL + _grid_counts_sql(**met.F1_GRID) + """
SELECT coalesce((SELECT f1 FROM gf WHERE f1 > 0 ORDER BY f1 DESC, i LIMIT 1), 0.0) AS best_f1,
       coalesce((SELECT t FROM gf WHERE f1 > 0 ORDER BY f1 DESC, i LIMIT 1), 0.5) AS best_threshold"""))
def q_best_f1(spark, sf_dir):
    """M6: best F1 over the 0.05..0.80 grid in one pass."""
    return met.best_f1_threshold(scored(spark, sf_dir))


@query("threshold_sweep", sql(SCORE_SQL + _grid_counts_sql(**met.SWEEP_GRID) + """
SELECT t AS threshold, CAST(tp AS DOUBLE) / (tp + fp) AS precision,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall, f1
FROM gf WHERE tp + fp > 0 AND tp + fp < tp + fp + fn + tn"""))
def q_threshold_sweep(spark, sf_dir):
    """M9: precision / recall / F1 at thresholds predicting both classes."""
    return met.threshold_sweep(scored(spark, sf_dir))


RANK_SQL = """,
cnt AS (SELECT p AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM sc GROUP BY p),
cum AS (SELECT s, pos, neg,
               coalesce(sum(pos) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
               coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below
        FROM cnt),
tot AS (SELECT sum(pos) AS P, sum(neg) AS N FROM cnt)"""


def _metrics_sql(t: float, score_sql: str = SCORE_SQL) -> str:
    return score_sql + RANK_SQL + f""",
rk AS (SELECT CASE WHEN tot.P > 0 AND tot.N > 0 THEN
                 CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / (CAST(2.0 AS DOUBLE) * tot.P * tot.N) END AS roc_auc,
              CASE WHEN tot.P > 0 AND tot.N > 0 THEN round(sum(CASE WHEN pos > 0 THEN
                 (CAST(pos AS DOUBLE) / tot.P) * (CAST(tot.P - pos_below AS DOUBLE) /
                 ((tot.P - pos_below) + (tot.N - neg_below))) ELSE 0.0 END), 12) END AS pr_auc
       FROM cum, tot GROUP BY tot.P, tot.N),
cc AS (SELECT sum(CASE WHEN y = 1 AND p >= {t!r} THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = 0 AND p >= {t!r} THEN 1 ELSE 0 END) AS fp,
              sum(CASE WHEN y = 1 AND p < {t!r} THEN 1 ELSE 0 END) AS fn,
              sum(CASE WHEN y = 0 AND p < {t!r} THEN 1 ELSE 0 END) AS tn FROM sc),
m AS (SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, CAST(tn AS BIGINT) AS tn,
             CAST(tp + fp + fn + tn AS BIGINT) AS n, CAST(tot.P AS DOUBLE) AS pp, CAST(tot.N AS DOUBLE) AS qq
      FROM cc, tot)
SELECT CAST({t!r} AS DOUBLE) AS threshold,
       CAST(tp + tn AS DOUBLE) / n AS accuracy,
       CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) ELSE 0.0 END AS precision,
       CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) ELSE 0.0 END AS recall,
       CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END AS f1,
       CASE WHEN pp > 0 AND qq > 0 THEN (tp / pp + tn / qq) / 2.0 WHEN pp > 0 THEN tp / pp ELSE tn / qq END
         AS balanced_accuracy,
       CASE WHEN pp > 0 AND qq > 0 THEN
         CASE WHEN (CAST(n AS DOUBLE) * n - (qq * qq + pp * pp)) * (CAST(n AS DOUBLE) * n -
                   (CAST(tn + fn AS DOUBLE) * (tn + fn) + CAST(tp + fp AS DOUBLE) * (tp + fp))) = 0 THEN 0.0
         ELSE (CAST(tp + tn AS DOUBLE) * n - (qq * (tn + fn) + pp * (tp + fp))) /
              sqrt((CAST(n AS DOUBLE) * n - (qq * qq + pp * pp)) * (CAST(n AS DOUBLE) * n -
                   (CAST(tn + fn AS DOUBLE) * (tn + fn) + CAST(tp + fp AS DOUBLE) * (tp + fp)))) END END AS mcc,
       rk.roc_auc, rk.pr_auc, tn, fp, fn, tp, n, pp / n AS positive_rate
FROM m, rk"""


def _metrics_row(df, threshold):
    """Metrics with the one order-dependent sum rounded as in the SQL."""
    return met.classification_metrics(df, threshold).withColumn("pr_auc", F.round("pr_auc", 12))


@query("metrics", sql(_metrics_sql(0.5)))
def q_metrics(spark, sf_dir):
    """M7 at threshold 0.5 (AUC with half-credit ties, step-sum AP, MCC)."""
    return _metrics_row(scored(spark, sf_dir), 0.5)


@query("roc_points", sql(SCORE_SQL + RANK_SQL + """
SELECT s AS threshold, CAST(tot.N - neg_below AS DOUBLE) / tot.N AS fpr,
       CAST(tot.P - pos_below AS DOUBLE) / tot.P AS tpr FROM cum, tot"""))
def q_roc_points(spark, sf_dir):
    """Every distinct score is a point."""
    return met.roc_points(scored(spark, sf_dir))


@query("confusion_norm", sql(SCORE_SQL + """,
c AS (SELECT CAST(y AS INTEGER) AS y_true, CAST(p >= 0.5 AS INTEGER) AS y_pred, count(*) AS n FROM sc GROUP BY 1, 2)
SELECT y_true, y_pred, n, CAST(n AS DOUBLE) / sum(n) OVER (PARTITION BY y_true) AS share FROM c"""))
def q_confusion_norm(spark, sf_dir):
    """M10."""
    return met.confusion_normalized(scored(spark, sf_dir), 0.5)


# ---------------------------------------------------------------------------
# time splits (M11, M12 counts, P11, O5)
# ---------------------------------------------------------------------------


TRAIN_THROUGH, TEST_MONTH = "2000-12", "2001-01"


@query("month_split_counts", sql(f"""
, nd AS (SELECT strftime(sale_date, '%Y-%m') AS m, buyout_flag AS y FROM cohort
         WHERE is_new__ AND sale_date IS NOT NULL)
SELECT '{TRAIN_THROUGH}' AS train_through, '{TEST_MONTH}' AS test_month,
       count(*) FILTER (WHERE m <= '{TRAIN_THROUGH}') AS n_train,
       count(*) FILTER (WHERE m = '{TEST_MONTH}') AS n_test,
       CAST(sum(y) FILTER (WHERE m <= '{TRAIN_THROUGH}') AS DOUBLE) / count(*) FILTER (WHERE m <= '{TRAIN_THROUGH}')
         AS train_buyout,
       CAST(sum(y) FILTER (WHERE m = '{TEST_MONTH}') AS DOUBLE) / count(*) FILTER (WHERE m = '{TEST_MONTH}')
         AS test_buyout
FROM nd"""))
def q_month_split_counts(spark, sf_dir):
    """train = months <= X, test = month Y (new contacts with a date)."""
    new = drop_missing_dates(with_prior(spark, sf_dir).filter(is_new_column()))
    return bt.split_counts(new, TRAIN_THROUGH, TEST_MONTH)


@query("backtest_counts", sql("""
, nd AS (SELECT strftime(sale_date, '%Y-%m') AS m, buyout_flag AS y FROM cohort
         WHERE is_new__ AND sale_date IS NOT NULL),
pm AS (SELECT m, count(*) AS n, sum(y) AS pos FROM nd GROUP BY m),
cm AS (SELECT m, n, pos,
              coalesce(sum(n) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_train,
              coalesce(sum(pos) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_train,
              row_number() OVER (ORDER BY m) AS k
       FROM pm)
SELECT m AS test_month, CAST(n_train AS BIGINT) AS n_train, n AS n_test,
       CAST(pos_train AS DOUBLE) / n_train AS train_buyout, CAST(pos AS DOUBLE) / n AS test_buyout
FROM cm WHERE k > 1 AND pos_train > 0 AND pos_train < n_train AND pos > 0 AND pos < n"""))
def q_backtest_counts(spark, sf_dir):
    """M12 (counts and rates of every expanding-month split, one pass)."""
    new = drop_missing_dates(with_prior(spark, sf_dir).filter(is_new_column()))
    return bt.expanding_month_counts(new)


# ---------------------------------------------------------------------------
# importance, comparison, routed decision
# ---------------------------------------------------------------------------



@query("linear_importance", sql(FEAT_CTE + """
, lg AS (SELECT row_id, buyout_flag AS y, unnest([""" +
    ", ".join(f"{{'feature': '{c}', 'category': CAST({_q(c)} AS VARCHAR)}}" for c in FC.cat_cols) +
    """], recursive := true) FROM feat),
tot AS (SELECT count(*) AS nn, sum(buyout_flag) AS pp FROM feat),
w AS (SELECT feature, category, sum(y) AS pos, count(*) AS n FROM lg WHERE category IS NOT NULL GROUP BY 1, 2),
imp AS (SELECT feature, sum(abs(pos * tot.nn - n * tot.pp)) AS s, any_value(tot.nn) AS nn FROM w, tot GROUP BY feature)
SELECT feature, CAST(s AS DOUBLE) / (CAST(nn AS DOUBLE) * nn) AS importance,
       CAST(row_number() OVER (ORDER BY CAST(s AS DOUBLE) / (CAST(nn AS DOUBLE) * nn) DESC, feature) AS INTEGER) AS rank
FROM imp ORDER BY importance DESC, feature LIMIT 25"""))
def q_linear_importance(spark, sf_dir):
    """Grouped |weight| per source feature, top 25; weights are the
    one-hot columns' univariate effects (pos_c*N - n_c*P) / N^2."""
    feats, _ = new_cohort_features(spark, sf_dir)
    return xp.univariate_importance(feats, FC.cat_cols, TARGET, top_n=25)


SCORE_B_SQL = SCORE_SQL.replace("7919", "104729")
MC_METRICS = ["threshold", "n", "positive_rate", "accuracy", "balanced_accuracy", "precision", "recall",
              "f1", "mcc", "roc_auc", "pr_auc"]


def _comparison_sql() -> str:
    a = _metrics_sql(0.5)[1:].lstrip(" ,\n")
    b = _metrics_sql(0.5, SCORE_B_SQL)[1:].lstrip(" ,\n")
    unions = []
    for m in MC_METRICS:
        unions.append(f"SELECT '{m}' AS metric, CAST(ma.{m} AS DOUBLE) AS model_a, CAST(mb.{m} AS DOUBLE) AS model_b "
                      f"FROM ma, mb WHERE ma.{m} IS NOT NULL OR mb.{m} IS NOT NULL")
    return f""",
ma AS (WITH {a}),
mb AS (WITH {b})
""" + "\nUNION ALL ".join(unions)


@query("model_comparison", sql(_comparison_sql()))
def q_model_comparison(spark, sf_dir):
    """Metric x model table for two scorers (metrics NULL for all dropped)."""
    a = _metrics_row(scored(spark, sf_dir, 7919), 0.5)
    b = _metrics_row(scored(spark, sf_dir, 104729), 0.5)
    return xp.compare_models({"model_a": a, "model_b": b}, MC_METRICS)


ROUTE_COEF = {"intercept_ret": 0.8, "slope_ret": 1.5, "intercept_new": -0.4,
              "has_future_purchase": 0.7, "is_paid_traffic": 0.35, "city_te": 1.2}
ROUTE_T = 0.5


@query("routed_decision", sql(FEAT_CTE.replace("FROM cohort WHERE is_new__ GROUP BY 1\n)",
                                               "FROM cohort WHERE is_new__ GROUP BY 1\n)")
                              + f"""
, x AS (SELECT coalesce(CAST({DC} AS DOUBLE), 0.0) AS x FROM cohort),
st AS (SELECT sum(x) AS s, sum(x * x) AS ss, count(*) AS n FROM x),
sd AS (SELECT s / n AS mean, CASE WHEN (ss - s * s / n) / n > 0 THEN sqrt((ss - s * s / n) / n) ELSE 1.0 END AS std
       FROM st),
gm AS (SELECT CAST(sum(buyout_flag) AS DOUBLE) / count(*) AS g FROM feat),
cm AS (SELECT city_clean AS v, sum(buyout_flag) AS s, count(*) AS n FROM feat GROUP BY 1),
zn AS (SELECT f.row_id, 'new' AS route,
              {ROUTE_COEF['intercept_new']!r} + {ROUTE_COEF['has_future_purchase']!r} * f.has_future_purchase
              + {ROUTE_COEF['is_paid_traffic']!r} * f.is_paid_traffic
              + {ROUTE_COEF['city_te']!r} * coalesce((CAST(cm.s AS DOUBLE) + gm.g * 10) / (cm.n + 10), gm.g) AS z
       FROM feat f CROSS JOIN gm LEFT JOIN cm ON f.city_clean = cm.v),
zr AS (SELECT c.row_id, 'returning' AS route,
              {ROUTE_COEF['intercept_ret']!r} + {ROUTE_COEF['slope_ret']!r} *
              ((coalesce(CAST(c.{DC} AS DOUBLE), 0.0) - sd.mean) / sd.std) AS z
       FROM cohort c, sd WHERE NOT c.is_new__),
z AS (SELECT * FROM zn UNION ALL SELECT * FROM zr)
SELECT row_id, route, round(1.0 / (1.0 + exp(-z)), 12) AS proba,
       CAST(1.0 / (1.0 + exp(-z)) >= {ROUTE_T!r} AS INTEGER) AS decision
FROM z""".replace("1.0 / (1.0 + exp(-z))", "CAST(1.0 AS DOUBLE) / (CAST(1.0 AS DOUBLE) + exp(-z))")))
def q_routed_decision(spark, sf_dir):
    """M4, M5: route by prior count; returning -> scaled-count logistic,
    new -> logistic over built features (fixed coefficients); one
    probability per order, decision at the stored threshold."""
    from orderlens.plans.models import FixedLogistic, route_and_score
    df = prior_rows(spark, sf_dir)
    new = df.filter(is_new_column())
    ctx = build_contexts(new, city_table(spark, sf_dir))
    st = enc.scale_stats(df, DEAL_COUNT_COL)
    ret_model = FixedLogistic({"__x": ROUTE_COEF["slope_ret"]}, ROUTE_COEF["intercept_ret"],
                              prep=lambda d: d.withColumn("__x", enc.scaled(d, DEAL_COUNT_COL, st)))
    feats_new, _ = new_cohort_features(spark, sf_dir)
    g = enc.global_mean(feats_new, TARGET)
    tmap = enc.target_map(feats_new, "city_clean", TARGET, 10, g)
    new_model = FixedLogistic({"has_future_purchase": ROUTE_COEF["has_future_purchase"],
                               "is_paid_traffic": ROUTE_COEF["is_paid_traffic"],
                               "__city_te": ROUTE_COEF["city_te"]}, ROUTE_COEF["intercept_new"],
                              prep=lambda d: enc.apply_target_map(d, "city_clean", tmap, g, "__city_te"))
    out = route_and_score(df, load_feature_config(), ctx, new_model, ret_model, ROUTE_T)
    return out.withColumn("proba", F.round("proba", 12))


# ---------------------------------------------------------------------------
# user op (X1)
# ---------------------------------------------------------------------------



@register_op("ratio")
def _op_ratio(current, spec, env):
    """User op: input / other column (NULL when the divisor is 0 or NULL)."""
    num = env.input(current, spec)
    den = env.source(spec["by"])
    return _Val(F.try_divide(num.col.cast("double"), den.col.cast("double")), _T.DoubleType())


@query("custom_op", sql(f"""
SELECT row_id, CASE WHEN {CART_N_SQL} = 0 THEN NULL ELSE lead_price / {CART_N_SQL} END AS price_per_item
FROM cohort"""))
def q_custom_op(spark, sf_dir):
    """A registered op used from a spec, reading an earlier feature."""
    f = _ops_frame(spark, sf_dir, {
        "cart_n_items": SPEC["cart_n_items"],
        "price_per_item": {"type": "numeric", "op": {"name": "ratio", "source": "lead_price",
                                                     "by": "cart_n_items",
                                                     "sources": ["cart_n_items"]}},
    })
    return f.select("row_id", "price_per_item")


# ---------------------------------------------------------------------------
# model fits (rows-only checks): M1-M3, M12, M15, X2, X3; S3-S6 roundtrip;
# streaming scoring
# ---------------------------------------------------------------------------



def _new_feats_dated(spark, sf_dir):
    feats, _ = new_cohort_features(spark, sf_dir)
    return drop_missing_dates(feats)


def _full_fit(spark, sf_dir):
    """M2 on the new contacts of the training months (exactly stratified folds; shared per
    session), and the test month's rows."""
    def build():
        tr, te = bt.split_by_month(_new_feats_dated(spark, sf_dir), TRAIN_THROUGH, TEST_MONTH)
        n, p = mdl.class_counts(tr)
        tr = tr.select(*[F.col(f"`{c}`") for c in [ROW_ID, TARGET, *FC.all_feature_cols]])
        folds = enc.stratified_folds(tr, TARGET, enc.n_folds(p, n - p), "__fold")
        # the encoder, its encodings and the fit read the folds several times: ranked once, dealt evenly
        folds = stage_table(folds.repartition(mdl.even_parts(spark, n)), "folds")
        return mdl.FullFeatureModel.fit(folds, FC, fold_col="__fold"), te
    return _once(spark, "full_fit", sf_dir, build)


@query("fitted_importance")
def q_fitted_importance(spark, sf_dir):
    """Summed |coefficient| per source feature of the fitted full-feature model."""
    return xp.grouped_importance(_full_fit(spark, sf_dir)[0].coefficients(spark))


@query("fitted_comparison")
def q_fitted_comparison(spark, sf_dir):
    """The fitted logistic and boosted models on the test month, each at its own best threshold."""
    trees, te = _gbt_fit(spark, sf_dir)
    full, fte = _full_fit(spark, sf_dir)
    scores = (full.predict_proba(fte).join(fte.select(ROW_ID, TARGET), ROW_ID).withColumn("model", F.lit("logistic"))
              .unionByName(trees.predict_proba(te).join(te.select(ROW_ID, TARGET), ROW_ID).withColumn("model", F.lit("boosted"))))
    from orderlens.session import stage_table
    scores = stage_table(scores.select("model", F.col(TARGET).alias("y"), F.col("proba").alias("p")), "compared")
    best = {r["model"]: r["best_threshold"] for r in met.metrics_by(scores, ["model"]).collect()}  # one row a model
    rows = {m: met.classification_metrics(scores.where(F.col("model") == m), t) for m, t in sorted(best.items())}
    return xp.compare_models(rows, ["threshold", "accuracy", "precision", "recall", "f1", "balanced_accuracy", "mcc", "roc_auc", "pr_auc"])


@query("lr_scores")
def q_lr_scores(spark, sf_dir):
    """M1 (both cohorts, tested on returning) and M2 (new contacts, OOF target
    encoding at fit) trained through TRAIN_THROUGH, scored on TEST_MONTH."""
    df = drop_missing_dates(with_prior(spark, sf_dir))
    tr, te = bt.split_by_month(df, TRAIN_THROUGH, TEST_MONTH)
    m1 = mdl.PriorCountModel.fit(tr)
    p1 = m1.predict_proba(te.filter(~is_new_column())).withColumn("model", F.lit("prior_count"))
    m2, fte = _full_fit(spark, sf_dir)
    p2 = m2.predict_proba(fte).withColumn("model", F.lit("full_features"))
    return p1.unionByName(p2)


def _rolling(spark, sf_dir):
    """All months' full-feature models from one joint fit (shared per session)."""
    return _once(spark, "rolling", sf_dir, lambda: roll.fit(roll.prepare(_new_feats_dated(spark, sf_dir), FC)))


@query("backtest")
def q_backtest(spark, sf_dir):
    """Expanding-window backtest of the full-feature model, by month
    (every eligible month after the first; all earlier rows train; the rolling
    fit's penalised intercept)."""
    return bt.evaluated(_rolling(spark, sf_dir).scores(), _new_feats_dated(spark, sf_dir))


@query("backtest_coefficients")
def q_backtest_coefficients(spark, sf_dir):
    """Weights of every month's model by feature name."""
    return _rolling(spark, sf_dir).coefficients()


MONTH_SCORE_SQL = (", sc AS (SELECT strftime(sale_date, '%Y-%m') AS month, is_new__ AS is_new, "
                   "CAST((row_id * 7919) % 1000 AS DOUBLE) / 1000.0 AS p, buyout_flag AS y FROM cohort WHERE sale_date IS NOT NULL)")


def _month_metrics_sql() -> str:
    lo, hi, step = met.F1_GRID.values()
    return MONTH_SCORE_SQL + f""",
cnt AS (SELECT month, is_new, p AS s, sum(y) AS pos, count(*) - sum(y) AS neg FROM sc GROUP BY ALL),
cum AS (SELECT *, coalesce(sum(pos) OVER (PARTITION BY month, is_new ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos_below,
               coalesce(sum(neg) OVER (PARTITION BY month, is_new ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below,
               sum(pos) OVER (PARTITION BY month, is_new) AS P, sum(neg) OVER (PARTITION BY month, is_new) AS N
        FROM cnt),
rk AS (SELECT month, is_new, sum(pos + neg) AS n, sum(pos) AS n_pos,
              CASE WHEN any_value(P) > 0 AND any_value(N) > 0 THEN
                CAST(sum(pos * (2 * neg_below + neg)) AS DOUBLE) / (CAST(2.0 AS DOUBLE) * any_value(P) * any_value(N)) END AS roc_auc,
              CASE WHEN any_value(P) > 0 AND any_value(N) > 0 THEN round(sum(CASE WHEN pos > 0 THEN
                (CAST(pos AS DOUBLE) / P) * (CAST(P - pos_below AS DOUBLE) / ((P - pos_below) + (N - neg_below))) ELSE 0.0 END), 10) END AS pr_auc
       FROM cum GROUP BY month, is_new),
gr AS ({_grid_sql(lo, hi, step)}),
gc AS (SELECT month, is_new, i, t, sum(CASE WHEN y = 1 AND p >= t THEN 1 ELSE 0 END) AS tp,
              sum(CASE WHEN y = 0 AND p >= t THEN 1 ELSE 0 END) AS fp, sum(CASE WHEN y = 1 AND p < t THEN 1 ELSE 0 END) AS fn
       FROM gr CROSS JOIN sc GROUP BY month, is_new, i, t),
gf AS (SELECT *, CASE WHEN 2 * tp + fp + fn > 0 THEN CAST(2 * tp AS DOUBLE) / (2 * tp + fp + fn) ELSE 0.0 END AS f1 FROM gc),
best AS (SELECT month, is_new, f1, t FROM gf QUALIFY row_number() OVER (PARTITION BY month, is_new ORDER BY f1 DESC, i) = 1)
SELECT rk.month, rk.is_new, CAST(rk.n AS BIGINT) AS n, CAST(rk.n_pos AS BIGINT) AS n_pos, rk.roc_auc, rk.pr_auc, best.f1 AS best_f1,
       CASE WHEN best.f1 > 0 THEN best.t ELSE 0.5 END AS best_threshold
FROM rk JOIN best ON rk.month = best.month AND rk.is_new = best.is_new"""


@query("month_metrics", sql(_month_metrics_sql()))
def q_month_metrics(spark, sf_dir):
    """M6, M7, W6 by key: AUC, AP and best F1 of every month and cohort from one scored table."""
    df = with_prior(spark, sf_dir).where("sale_date is not null")
    scores = df.select(bt.month_col().alias("month"), is_new_column().alias("is_new"), F.col(TARGET).alias("y"),
                       (((F.col("row_id") * 7919) % 1000).cast("double") / F.lit(1000.0)).alias("p"))
    return met.metrics_by(scores, ["month", "is_new"]).withColumn("pr_auc", F.round("pr_auc", 10))


def _gbt_fit(spark, sf_dir):
    """M3 fit on tree-prepped new-contact features (shared per session by
    ``gbt_scores`` and ``gbt_attribution``)."""
    def build():
        feats = tree_prep(_new_feats_dated(spark, sf_dir), TREE_CAT, TREE_NUM)
        safe = {c: f"c{i}" for i, c in enumerate(TREE_CAT + TREE_NUM)}
        ren = feats.select(ROW_ID, TARGET, "sale_date", *[F.col(f"`{c}`").alias(a) for c, a in safe.items()])
        tr, te = bt.split_by_month(ren, TRAIN_THROUGH, TEST_MONTH)
        m = mdl.BoostedTreeModel.fit(tr.drop("sale_date"), [safe[c] for c in TREE_CAT],
                                     [safe[c] for c in TREE_NUM])
        return m, te.drop("sale_date")
    return _once(spark, "gbt", sf_dir, build)


@query("gbt_scores")
def q_gbt_scores(spark, sf_dir):
    """M3 on tree-prepped new-contact features (500 trees, depth 4, lr 0.03),
    trained through TRAIN_THROUGH, scored on TEST_MONTH."""
    m, te = _gbt_fit(spark, sf_dir)
    return m.predict_proba(te)


@query("gbt_attribution")
def q_gbt_attribution(spark, sf_dir):
    """Mean |SHAP| per feature of the boosted trees on the test month
    (top 20), exact path-dependent TreeSHAP in Arrow batches."""
    from orderlens.plans.attribution import mean_abs_attribution
    m, te = _gbt_fit(spark, sf_dir)
    stages = m.pipeline.stages
    vec = te
    for st in stages[:-1]:
        vec = st.transform(vec)
    return mean_abs_attribution(vec, stages[-1], TREE_CAT + TREE_NUM, top_n=20)


#: M1's optimum by Newton steps over the counts of (scaled prior count, target) of the training months.
LINE_SQL = f"""
, d1 AS (SELECT row_id, coalesce({DC}, 0.0) AS x, is_new__, buyout_flag AS y, strftime(sale_date, '%Y-%m') AS m FROM cohort WHERE sale_date IS NOT NULL),
t1 AS (SELECT avg(x) AS mean, coalesce(nullif(stddev_pop(x), 0), 1.0) AS std, count(*) AS n, sum(y) AS p FROM d1 WHERE m <= '{TRAIN_THROUGH}'),
g1 AS (SELECT (x - mean) / std AS z, y, count(*) * (CASE WHEN y = 1 THEN n / (2.0 * p) ELSE n / (2.0 * (n - p)) END) AS w
       FROM d1 CROSS JOIN t1 WHERE m <= '{TRAIN_THROUGH}' GROUP BY x, y, mean, std, n, p),
it AS (
  SELECT 0 AS i, CAST(0 AS DOUBLE) AS b, CAST(0 AS DOUBLE) AS a
  UNION ALL
  SELECT i + 1, b - (haa * gb - hba * ga) / (hbb * haa - hba * hba), a - (hbb * ga - hba * gb) / (hbb * haa - hba * hba)
  FROM (SELECT i, b, a, sum(w * (q - y)) AS gb, sum(w * (q - y) * z) + a AS ga, sum(w * q * (1 - q)) AS hbb,
               sum(w * q * (1 - q) * z) AS hba, sum(w * q * (1 - q) * z * z) + 1 AS haa
        FROM (SELECT it.i, it.b, it.a, g1.*, 1 / (1 + exp(-(it.b + it.a * z))) AS q FROM it CROSS JOIN g1 WHERE it.i < 30) GROUP BY i, b, a)),
ln AS (SELECT b, a, mean, std FROM it CROSS JOIN t1 WHERE i = 30)"""


@query("prior_model_scores", sql(LINE_SQL + f"""
SELECT row_id, round(1 / (1 + exp(-(b + a * (x - mean) / std))), 9) AS proba
FROM d1 CROSS JOIN ln WHERE m = '{TEST_MONTH}' AND NOT is_new__""").replace("WITH ", "WITH RECURSIVE ", 1))
def q_prior_model_scores(spark, sf_dir):
    """M1: the prior-count model of the training months on the test month's returning contacts."""
    tr, te = bt.split_by_month(drop_missing_dates(with_prior(spark, sf_dir)), TRAIN_THROUGH, TEST_MONTH)
    scores = mdl.PriorCountModel.fit(tr).predict_proba(te.filter(~is_new_column()))
    return scores.select("row_id", F.round("proba", 9).alias("proba"))


@query("calibration_points", sql(LINE_SQL + f"""
, grid AS (SELECT CASE WHEN i = 299 THEN 7.0 ELSE i * (CAST(7.0 AS DOUBLE) / 299) + 0.0 END AS x FROM range(300) r(i))
SELECT 'model' AS kind, CAST(x AS DOUBLE) AS prior_orders, round(1 / (1 + exp(-(b + a * (x - mean) / std))), 9) AS rate,
       CAST(NULL AS BIGINT) AS n_total
FROM grid CROSS JOIN ln
UNION ALL
SELECT 'actual', CAST(CAST(least(x, 7) AS INTEGER) AS DOUBLE), round(CAST(sum(y) AS DOUBLE) / count(*), 9), count(*)
FROM d1 WHERE m = '{TEST_MONTH}' GROUP BY 2""").replace("WITH ", "WITH RECURSIVE ", 1))
def q_calibration_points(spark, sf_dir):
    """M1's probability on 300 points over 0..7 prior orders, next to the
    actual rate per capped count in the test month (A11)."""
    df = drop_missing_dates(with_prior(spark, sf_dir))
    tr, te = bt.split_by_month(df, TRAIN_THROUGH, TEST_MONTH)
    model = mdl.PriorCountModel.fit(tr)
    curve = mdl.calibration_points(model, spark).select(
        F.lit("model").alias("kind"), "prior_orders", F.col("proba").alias("rate"),
        F.lit(None).cast("long").alias("n_total"))
    actual = rate_by_capped_count(te, capped_prior_count(7)).select(
        F.lit("actual").alias("kind"), F.col("deals").cast("double").alias("prior_orders"),
        F.col("buyout_rate").alias("rate"), "n_total")
    return curve.unionByName(actual).withColumn("rate", F.round("rate", 9))


@query("roundtrip", ORACLE["clean_union"])
def q_roundtrip(spark, sf_dir):
    """Write the clean set partitioned by month (S4), contexts
    and metadata (S6) to the shared folder, read them back (S3)."""
    df = prior_rows(spark, sf_dir)
    new = df.filter(is_new_column())
    ctx = build_contexts(new, city_table(spark, sf_dir))
    feats, fc = new_cohort_features(spark, sf_dir)
    clean = union_cohorts(feats, df.filter(~is_new_column()), fc.all_feature_cols,
                          extra=["contact_id", "row_id"])
    base = staging_path(spark, "roundtrip")
    from orderlens.sources.io import read_clean, write_clean
    write_clean(clean, os.path.join(base, "clean"))
    mdl.save_contexts(ctx, os.path.join(base, "contexts"))
    mdl.save_metadata(spark, os.path.join(base, "meta"), 0.5, TRAIN_THROUGH, TEST_MONTH, "default")
    back_ctx = mdl.load_contexts(spark, os.path.join(base, "contexts"))
    assert set(back_ctx) == set(ctx)
    for name, t in ctx.items():
        was, now = t.df, back_ctx[name].df.select(t.df.columns)
        assert was.exceptAll(now).isEmpty() and now.exceptAll(was).isEmpty(), name
        assert {k: v for k, v in t.__dict__.items() if k != "df"} == {k: v for k, v in back_ctx[name].__dict__.items() if k != "df"}
    assert mdl.load_threshold(spark, os.path.join(base, "meta")) == 0.5
    back = read_clean(spark, os.path.join(base, "clean"))
    return back.select(*[F.col(f"`{c}`") for c in clean.columns])


@query("stream_scores", ORACLE["routed_decision"])
def q_stream_scores(spark, sf_dir):
    """M4, M5 as a streaming job: prior-corrected orders land as parquet
    files; ``foreachBatch`` scores each micro-batch with the saved contexts
    and the same fixed-coefficient router as ``routed_decision``."""
    from orderlens.plans.models import FixedLogistic
    from orderlens.session import stage_table
    from orderlens.streaming.scoring import score_stream
    df = prior_rows(spark, sf_dir)
    base = staging_path(spark, "stream")
    src = os.path.join(base, "in")
    df.write.mode("overwrite").parquet(src)  # files arrive as the stream's input
    data = spark.read.parquet(src)
    new = data.filter(is_new_column())
    mdl.save_contexts(build_contexts(new, city_table(spark, sf_dir)), os.path.join(base, "contexts"))
    ctx = mdl.load_contexts(spark, os.path.join(base, "contexts"))  # else every batch would count all orders anew
    st = enc.scale_stats(data, DEAL_COUNT_COL)
    ret_model = FixedLogistic({"__x": ROUTE_COEF["slope_ret"]}, ROUTE_COEF["intercept_ret"],
                              prep=lambda d: d.withColumn("__x", enc.scaled(d, DEAL_COUNT_COL, st)))
    feats_new, _ = new_cohort_features(spark, sf_dir)  # the same rows, staged
    g = enc.global_mean(feats_new, TARGET)
    tmap = stage_table(enc.target_map(feats_new, "city_clean", TARGET, 10, g), "te-map", spark)
    new_model = FixedLogistic({"has_future_purchase": ROUTE_COEF["has_future_purchase"],
                               "is_paid_traffic": ROUTE_COEF["is_paid_traffic"],
                               "__city_te": ROUTE_COEF["city_te"]}, ROUTE_COEF["intercept_new"],
                              prep=lambda d: enc.apply_target_map(d, "city_clean", tmap, g, "__city_te"))
    out = os.path.join(base, "out")
    score_stream(spark, src, data.schema, out, os.path.join(base, "ckpt"), load_feature_config(), ctx,
                 new_model, ret_model, ROUTE_T, max_files_per_trigger=2)
    return spark.read.parquet(out).drop("batch_id").withColumn("proba", F.round("proba", 12))


# ---------------------------------------------------------------------------
# second per-key history and second binary target (events, documents + labels)
# ---------------------------------------------------------------------------

@query("prior_count_events", """
WITH ev AS (SELECT event_id, user_id, ts,
                   CAST(count(*) OVER (PARTITION BY user_id) + (user_id % 3 - 1) AS DOUBLE) AS snap
            FROM events),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id) - 1 AS rnk,
             count(*) OVER (PARTITION BY user_id) AS total,
             last_value(snap IGNORE NULLS) OVER (PARTITION BY user_id ORDER BY ts NULLS LAST, event_id
               ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS lastc
      FROM ev)
SELECT event_id, user_id,
       CASE WHEN user_id IS NULL THEN snap WHEN lastc < total THEN CAST(rnk AS DOUBLE)
            ELSE lastc - total + 1 + rnk END AS prior_events
FROM r""")
def q_prior_count_events(spark, sf_dir):
    """W1 on a second history: each user's events, ordered by timestamp, with
    a snapshot count (events per user + user_id%3 - 1)."""
    from orderlens.sources.leads import table
    ev = table(spark, sf_dir, "events").select("event_id", "user_id", "ts")
    snap = ev.groupBy(F.col("user_id").alias("__u")).agg(F.count(F.lit(1)).alias("__n"))
    ev = (ev.join(snap, ev.user_id == snap.__u, "left")
            .select("event_id", "user_id", "ts",
                    (F.col("__n") + (F.col("user_id") % 3 - 1)).cast("double").alias("snap")))
    out = prior_order_count(ev, contact_col="user_id", created_col="ts", id_col="event_id",
                            count_col="snap")
    return out.select("event_id", "user_id", F.col("snap").alias("prior_events"))


DOC_SCORE_SQL = (", sc AS (SELECT CAST(d.n_chars AS DOUBLE) / (d.n_chars + 5000) AS p, l.quality AS y "
                 "FROM documents d JOIN labels l ON d.doc_id = l.doc_id)")


@query("doc_quality_metrics", sql(_metrics_sql(0.5, DOC_SCORE_SQL)))
def q_doc_quality_metrics(spark, sf_dir):
    """M7 on a second binary target: document length, as n / (n + 5000), as a score of the
    labelled quality flag (documents joined to labels; only two columns read)."""
    from orderlens.sources.leads import table
    d = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    lab = table(spark, sf_dir, "labels").select("doc_id", "quality")
    s = d.join(lab, "doc_id").select(
        (F.col("n_chars").cast("double") / (F.col("n_chars") + 5000)).alias("p"),
        F.col("quality").alias("y"))
    return _metrics_row(s, 0.5)


@query("backtest_target_maps", sql(FEAT_CTE + """
, nd AS (SELECT strftime(sale_date, '%Y-%m') AS m, city_clean AS value, buyout_flag AS y FROM feat
         WHERE sale_date IS NOT NULL),
pm AS (SELECT m, count(*) AS n, sum(y) AS s FROM nd GROUP BY m),
periods AS (SELECT m AS test_month,
                   coalesce(sum(n) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS n_before,
                   coalesce(sum(s) OVER (ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS s_before
            FROM pm),
vm AS (SELECT value, m, count(*) AS n, sum(y) AS s FROM nd WHERE value IS NOT NULL GROUP BY value, m),
cv AS (SELECT value, m, sum(n) OVER (PARTITION BY value ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cn,
              sum(s) OVER (PARTITION BY value ORDER BY m ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cs,
              lead(m) OVER (PARTITION BY value ORDER BY m) AS next_m
       FROM vm)
SELECT p.test_month, cv.value,
       (CAST(cv.cs AS DOUBLE) + (CASE WHEN p.n_before > 0 THEN CAST(p.s_before AS DOUBLE) / p.n_before ELSE 0.5 END) * 10)
         / (cv.cn + 10) AS te
FROM cv JOIN periods p ON p.test_month > cv.m AND (cv.next_m IS NULL OR p.test_month <= cv.next_m)"""))
def q_backtest_target_maps(spark, sf_dir):
    """M12 + A4: the city encoding map of every expanding-month split in one
    pass (per-(value, month) sums, prefix-summed, carried to later months)."""
    feats, _ = new_cohort_features(spark, sf_dir)
    return bt.expanding_target_maps(feats, "city_clean", FC.te_alpha["city_clean"])


# ---------------------------------------------------------------------------
# file sources through the driver check (S1 CSV export, S2 city JSON)
# ---------------------------------------------------------------------------

@query("load_csv_export", ORACLE["load_clean"])
def q_load_csv_export(spark, sf_dir):
    """S1 from a CSV export: the raw orders are written as a quoted CSV file
    set in the shared folder, then read with the export's schema and cleaned
    (P1-P5).  Same rows as ``load_clean``."""
    from orderlens.sources.io import load_raw_data, write_orders_csv
    raw = leads_view(spark, sf_dir)
    path = staging_path(spark, "csv-export")
    write_orders_csv(raw, path)
    # cart texts hold line ends inside quotes; the export is many files, one task each
    return load_raw_data(spark, path, schema=raw.schema, multi_line=True)


@query("city_dictionary_json", sql(CITY_SQL.split(",\nhay AS")[0] + """,
big AS (SELECT DISTINCT name FROM cities WHERE coalesce(population, 0) >= 500000 AND name IS NOT NULL)
SELECT d.name, d.region, CASE WHEN b.name IS NULL THEN 0 ELSE 1 END AS is_big
FROM citydict d LEFT JOIN big b ON d.name = b.name"""))
def q_city_dictionary_json(spark, sf_dir):
    """S2, U2, A3 from a JSON array file: city rows (name, region.fullname,
    population) written to the shared folder as one JSON array, read with the
    fixed schema, flattened, extended with the fixed extra cities, and
    flagged by population."""
    import json as _json
    from orderlens.operators.contexts import big_city_flags, city_dictionary, read_city_json
    rows = city_table(spark, sf_dir).orderBy("ord")
    path = staging_path(spark, "cities-json")
    # the dictionary is a fixed reference file (here nation x region: 25 rows by
    # definition), so writing it as the single JSON array it ships as is bounded
    arr = rows.select(F.to_json(F.struct("name", "region", "population")).alias("j"))
    (arr.agg(F.concat(F.lit("["), F.array_join(F.collect_list("j"), ","), F.lit("]")).alias("value"))
        .coalesce(1).write.mode("overwrite").text(path))
    raw = read_city_json(spark, path)
    d = city_dictionary(raw)
    big = big_city_flags(raw).select(F.col("name").alias("__bn"), F.lit(1).alias("__big"))
    return (d.join(big, d.name == big.__bn, "left")
             .select("name", "region", F.coalesce("__big", F.lit(0)).alias("is_big")))
