"""Sources and sinks: CSV export round trip (S1), partitioned clean set
(S3/S4), city JSON (S2/U2/A3), contexts (S5)."""

import json
import os
import tempfile

from pyspark.sql import functions as F

from orderlens.operators.clean import clean_raw
from orderlens.operators.contexts import big_city_flags, city_dictionary, read_city_json
from orderlens.sources import io
from orderlens.sources.leads import leads_view
from orderlens.schema import DEAL_COUNT_COL

SF = "/root/testdata/sf0.001"


def test_csv_export_round_trip(spark):
    raw = leads_view(spark, SF)
    d = tempfile.mkdtemp(prefix="orderlens-csv-")
    io.write_orders_csv(raw, d)
    back = io.load_raw_data(spark, d, multi_line=True)
    want = clean_raw(raw)
    norm = lambda df: sorted(
        tuple(str(x) for x in r) for r in df.select(
            F.col("row_id").cast("long"), "buyout_flag", "lead_price",
            F.date_format("sale_date", "yyyy-MM-dd HH:mm:ss"), F.col(f"`{DEAL_COUNT_COL}`"),
            F.col("`lead_Состав заказа`")).collect())
    assert norm(back) == norm(want)
    assert "lead_status_id" not in back.columns and "closed_ts" not in back.columns


def test_partitioned_clean_set(spark):
    df = clean_raw(leads_view(spark, SF))
    d = os.path.join(tempfile.mkdtemp(prefix="orderlens-clean-"), "clean")
    io.write_clean(df, d)
    month = df.select(F.date_format("sale_date", "yyyy-MM").alias("m")).first()["m"]
    one = io.read_clean(spark, d, [month])
    assert one.count() == df.where(F.date_format("sale_date", "yyyy-MM") == month).count()
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "sale_month" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]


def test_city_json(spark):
    d = tempfile.mkdtemp(prefix="orderlens-city-")
    p = os.path.join(d, "cities.json")
    with open(p, "w", encoding="utf-8") as f:
        json.dump([{"name": "Москва", "region": {"fullname": "Москва"}, "population": 12000000},
                   {"name": "", "region": {"fullname": "X"}, "population": 1},
                   {"name": "Елец", "region": {"fullname": "Липецкая область"}},
                   {"name": "Орел", "region": {"fullname": "Орловская область"}, "population": 300000}],
                  f, ensure_ascii=False)
    raw = read_city_json(spark, p)
    dic = city_dictionary(raw).orderBy("ord").collect()
    assert [r["name"] for r in dic] == ["Москва", "Елец", "Орел", "Ялта", "Симферополь", "Севастополь"]
    assert dic[1]["region"] == "Липецкая область"
    assert [r["name"] for r in big_city_flags(raw).collect()] == ["Москва"]


def test_contexts_save_load(spark):
    from orderlens.operators.contexts import build_contexts
    from orderlens.plans.models import load_contexts, save_contexts
    from orderlens.sources.leads import city_table
    df = clean_raw(leads_view(spark, SF))
    ctx = build_contexts(df, city_table(spark, SF))
    d = tempfile.mkdtemp(prefix="orderlens-ctx-")
    save_contexts(ctx, d)
    back = load_contexts(spark, d)
    assert set(back) == set(ctx)
    for k in ctx:
        assert sorted(map(tuple, back[k].df.collect())) == sorted(map(tuple, ctx[k].df.collect()))


def test_cluster_conf_is_consistent():
    from orderlens.session import cluster_conf
    c = cluster_conf(4000, "hdfs:///shared/ckpt")
    assert int(c["spark.sql.shuffle.partitions"]) == 12000
    assert c["spark.checkpoint.dir"].endswith("ckpt") and c["spark.sql.adaptive.enabled"] == "true"
