"""The ``leads`` view: a raw CRM-style order table derived from the driver's
TPC-H-style tables (orders, customer, nation, region, lineitem, part).

Every derived value follows a modulo rule on the order key so both the Spark
plan below and the DuckDB oracle (``LEADS_SQL``) compute the same rows:

=============================  ==================================================
column                         rule
=============================  ==================================================
row_id                         o_orderkey
contact_id                     o_custkey*4 + o_orderkey%4; NULL if o_orderkey%97=0
contact_Число сделок           snapshot: non-'P' orders of the contact +
                               (o_custkey%3 - 1); 0 for a NULL contact
sale_date                      o_orderdate
lead_created_at                epoch seconds of o_orderdate
sale_ts                        lead_created_at + (o_orderkey%10)*900
lead_price                     o_totalprice/25; NULL if o_orderkey%53=0
outcome_unknown / buyout_flag  o_orderstatus = 'P' / = 'F'
lead_responsible_user_id       o_orderkey%26; NULL if o_orderkey%89=0
lead_Вид оплаты                o_orderpriority
lead_Категория и варианты...   c_mktsegment
contact_Город                  'г. ' || n_name
lead_utm_source                'ppc_ru_src_'||lower(segment)||'_b'||o_orderkey%4;
                               'ppc' if o_orderkey%7=0
lead_Состав заказа             part names of the order's lines, sorted, joined by
                               '; ', plus a newline and 'Доставка' for even keys;
                               NULL for an order without lines
lead_Квалификация лида         by o_orderkey%6 (one value NULL)
lead_group_id                  o_orderkey%5; NULL if o_orderkey%11=0
lead_utm_medium                by o_orderkey%5 (one value NULL)
lead_будущие покупки           'да' if o_orderkey%3=0 else NULL
lead_Служба доставки           by c_nationkey%5 (one value NULL)
lead_Тариф Доставки            by (o_orderkey/3)%5 (one value NULL)
lead_status_id, closed_ts      leakage columns (dropped by the loader)
=============================  ==================================================

Scale notes: the snapshot count is a partial-aggregated ``groupBy`` joined
back on the contact key (AQE splits a hot contact's partition); the cart
string is one ``collect_list`` per order, bounded by the lines of one order;
``nation`` is a fixed 25-row dimension and is the only side broadcast by
hint.  ``customer`` and ``part`` grow with the scale factor, so their joins
are left to the planner, which broadcasts them only under the runtime size
threshold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderlens.operators.lookups import left_lookup
from orderlens.schema import DEAL_COUNT_COL

DELIVERY_TOKEN = "Доставка"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def epoch_seconds(ts: Column) -> Column:
    """Epoch seconds of a wall-clock timestamp, independent of session TZ."""
    return (F.unix_date(F.to_date(ts)).cast("double") * 86400.0
            + F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts))


def _case(key: Column, values: list) -> Column:
    out = None
    for i, v in enumerate(values):
        cond = key == i
        out = F.when(cond, F.lit(v)) if out is None else out.when(cond, F.lit(v))
    return out


# Category values written by the view (test data, chosen so that the
# shipped feature spec's groups and lists find members).
QUALIFICATION = ["А - лид", "В - лид", "С - лид", "D - лид", "Неквал лид", None]
UTM_MEDIUM = ["cpc", "cpm", "organic", "Bloger", None]
DELIVERY_SERVICE = ["СДЭК до ПВЗ", "СДЭК до Двери", "Почта", "Самовывоз", None]
DELIVERY_TARIFF = ["Почта Посылка", "Посылка склад-дверь", "Посылка склад-склад",
                   "Экспресс склад-дверь", None]


def cart_by_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    # dealt by order before the lists are made (half-made ones would be no fewer), over all
    # partitions: a task's lists and its orders' rows are sorted in memory
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_name")
              .repartition(parts, "l_orderkey").groupBy("l_orderkey")
              .agg(F.array_join(F.array_sort(F.collect_list("p_name")), "; ").alias("items")))


def leads_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = cust.join(F.broadcast(nation), cust.c_nationkey == nation.n_nationkey)

    k = F.col("o_orderkey")
    lo = (o.join(cust, o.o_custkey == cust.c_custkey)
           .withColumn("contact_id", F.when(k % 97 == 0, F.lit(None).cast("long"))
                       .otherwise(F.col("o_custkey") * 4 + k % 4))
           .withColumn("_created", epoch_seconds(F.col("o_orderdate"))))

    # the contact comes from the order alone, so the counts need no join
    snap = (o.filter((F.col("o_orderstatus") != "P") & (k % 97 != 0))
              .groupBy((F.col("o_custkey") * 4 + k % 4).alias("_sk")).agg(F.count(F.lit(1)).alias("_known")))
    cart = cart_by_order(spark, sf_dir)

    j = (left_lookup(lo, F.col("contact_id"), snap, "_sk")
           .join(cart, lo.o_orderkey == cart.l_orderkey, "left"))
    seg = F.col("c_mktsegment")
    return j.select(
        k.alias("row_id"),
        F.col("contact_id"),
        F.when(F.col("contact_id").isNull(), F.lit(0.0))
         .otherwise((F.coalesce(F.col("_known"), F.lit(0)) + (F.col("o_custkey") % 3 - 1))
                    .cast("double")).alias(DEAL_COUNT_COL),
        F.col("o_orderdate").alias("sale_date"),
        F.col("_created").alias("lead_created_at"),
        (F.col("_created") + (k % 10) * 900).alias("sale_ts"),
        F.when(k % 53 == 0, F.lit(None).cast("double"))
         .otherwise(F.col("o_totalprice") / 25).alias("lead_price"),
        (F.col("o_orderstatus") == "P").alias("outcome_unknown"),
        (F.col("o_orderstatus") == "F").alias("buyout_flag"),
        F.when(k % 89 == 0, F.lit(None).cast("long")).otherwise(k % 26)
         .alias("lead_responsible_user_id"),
        F.col("o_orderpriority").alias("lead_Вид оплаты"),
        seg.alias("lead_Категория и варианты выбора"),
        F.concat(F.lit("г. "), F.col("n_name")).alias("contact_Город"),
        F.when(k % 7 == 0, F.lit("ppc"))
         .otherwise(F.concat(F.lit("ppc_ru_src_"), F.lower(seg), F.lit("_b"),
                             (k % 4).cast("string"))).alias("lead_utm_source"),
        F.when(F.col("items").isNull(), F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("items"),
                             F.when(k % 2 == 0, F.lit("\n" + DELIVERY_TOKEN)).otherwise(F.lit(""))))
         .alias("lead_Состав заказа"),
        _case(k % 6, QUALIFICATION).alias("lead_Квалификация лида"),
        F.when(k % 11 == 0, F.lit(None).cast("long")).otherwise(k % 5).alias("lead_group_id"),
        _case(k % 5, UTM_MEDIUM).alias("lead_utm_medium"),
        F.when(k % 3 == 0, F.lit("да")).alias("lead_будущие покупки"),
        _case(F.col("c_nationkey") % 5, DELIVERY_SERVICE).alias("lead_Служба доставки"),
        _case(F.floor(k / 3) % 5, DELIVERY_TARIFF).alias("lead_Тариф Доставки"),
        F.col("o_orderstatus").alias("lead_status_id"),
        (F.col("_created") + (k % 10) * 900 + 86400).alias("closed_ts"),
    )


def city_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """City dictionary rows in the JSON shape: name, region.fullname, population
    (nation joined to its region; population by a modulo rule, NULL for some)."""
    n = table(spark, sf_dir, "nation")
    r = table(spark, sf_dir, "region")
    j = n.join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    return j.select(
        F.col("n_nationkey").cast("int").alias("ord"),
        F.col("n_name").alias("name"),
        F.struct(F.col("r_name").alias("fullname")).alias("region"),
        F.when(F.col("n_nationkey") % 7 == 3, F.lit(None).cast("long"))
         .otherwise(F.col("n_nationkey").cast("long") * 40000).alias("population"),
    )


def _sql_case(key: str, values: list) -> str:
    parts = []
    for i, v in enumerate(values):
        if v is not None:
            parts.append(f"WHEN {key} = {i} THEN '{v}'")
    return "CASE " + " ".join(parts) + " END"


# DuckDB form of the same view, as CTEs ending in ``leads`` and ``cities``.
LEADS_SQL = f"""
cart AS (
  SELECT l.l_orderkey AS ck, string_agg(p.p_name, '; ' ORDER BY p.p_name) AS items
  FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
  GROUP BY l.l_orderkey
),
lo AS (
  SELECT o.*, c.c_nationkey, c.c_mktsegment, n.n_name,
         CASE WHEN o.o_orderkey % 97 = 0 THEN NULL
              ELSE o.o_custkey * 4 + o.o_orderkey % 4 END AS contact_id,
         CAST(epoch(o.o_orderdate) AS DOUBLE) AS created
  FROM orders o
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
snap AS (
  SELECT contact_id AS sk, count(*) AS n_known FROM lo
  WHERE o_orderstatus <> 'P' AND contact_id IS NOT NULL GROUP BY contact_id
),
leads AS (
  SELECT lo.o_orderkey AS row_id,
         lo.contact_id,
         CASE WHEN lo.contact_id IS NULL THEN 0.0
              ELSE CAST(coalesce(snap.n_known, 0) + (lo.o_custkey % 3 - 1) AS DOUBLE) END
           AS "contact_Число сделок",
         lo.o_orderdate AS sale_date,
         lo.created AS lead_created_at,
         lo.created + (lo.o_orderkey % 10) * 900 AS sale_ts,
         CASE WHEN lo.o_orderkey % 53 = 0 THEN NULL ELSE lo.o_totalprice / 25 END AS lead_price,
         lo.o_orderstatus = 'P' AS outcome_unknown,
         lo.o_orderstatus = 'F' AS buyout_flag,
         CASE WHEN lo.o_orderkey % 89 = 0 THEN NULL ELSE lo.o_orderkey % 26 END
           AS lead_responsible_user_id,
         lo.o_orderpriority AS "lead_Вид оплаты",
         lo.c_mktsegment AS "lead_Категория и варианты выбора",
         'г. ' || lo.n_name AS "contact_Город",
         CASE WHEN lo.o_orderkey % 7 = 0 THEN 'ppc'
              ELSE 'ppc_ru_src_' || lower(lo.c_mktsegment) || '_b' || CAST(lo.o_orderkey % 4 AS VARCHAR)
         END AS lead_utm_source,
         CASE WHEN cart.items IS NULL THEN NULL
              ELSE cart.items || CASE WHEN lo.o_orderkey % 2 = 0 THEN chr(10) || '{DELIVERY_TOKEN}' ELSE '' END
         END AS "lead_Состав заказа",
         {_sql_case('lo.o_orderkey % 6', QUALIFICATION)} AS "lead_Квалификация лида",
         CASE WHEN lo.o_orderkey % 11 = 0 THEN NULL ELSE lo.o_orderkey % 5 END AS lead_group_id,
         {_sql_case('lo.o_orderkey % 5', UTM_MEDIUM)} AS lead_utm_medium,
         CASE WHEN lo.o_orderkey % 3 = 0 THEN 'да' END AS "lead_будущие покупки",
         {_sql_case('lo.c_nationkey % 5', DELIVERY_SERVICE)} AS "lead_Служба доставки",
         {_sql_case('(lo.o_orderkey // 3) % 5', DELIVERY_TARIFF)} AS "lead_Тариф Доставки",
         lo.o_orderstatus AS lead_status_id,
         lo.created + (lo.o_orderkey % 10) * 900 + 86400 AS closed_ts
  FROM lo
  LEFT JOIN snap ON lo.contact_id = snap.sk
  LEFT JOIN cart ON lo.o_orderkey = cart.ck
),
cities AS (
  SELECT CAST(n.n_nationkey AS INTEGER) AS ord, n.n_name AS name, r.r_name AS region,
         CASE WHEN n.n_nationkey % 7 = 3 THEN NULL ELSE CAST(n.n_nationkey AS BIGINT) * 40000 END
           AS population
  FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey
)
"""
