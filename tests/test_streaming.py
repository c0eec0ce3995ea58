"""Streaming scoring resumes from its checkpoint: files that arrive after a
restart are scored once, and the union equals batch scoring."""

import os
import tempfile

from pyspark.sql import functions as F

from orderlens import catalog as c
from orderlens.operators.contexts import build_contexts
from orderlens.plans.models import FixedLogistic, route_and_score
from orderlens.sources.leads import city_table
from orderlens.streaming.scoring import score_stream

SF = "/root/testdata/sf0.001"


def test_stream_resumes_and_matches_batch(spark):
    df = c.with_prior(spark, SF)
    base = tempfile.mkdtemp(prefix="orderlens-stream-")
    src, out, ck = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    first = df.where(F.col("row_id") % 2 == 0)
    second = df.where(F.col("row_id") % 2 == 1)
    first.write.mode("append").parquet(src)
    new = df.filter(c.is_new_column())
    ctx = build_contexts(new, city_table(spark, SF))
    new_m = FixedLogistic({"has_future_purchase": 0.5, "is_paid_traffic": -0.2}, 0.1)
    ret_m = FixedLogistic({c.DEAL_COUNT_COL: 0.3}, -0.1)
    cfg = c.load_feature_config()
    score_stream(spark, src, df.schema, out, ck, cfg, ctx, new_m, ret_m, 0.5)
    n1 = spark.read.parquet(out).count()
    second.write.mode("append").parquet(src)          # late files; restart from the checkpoint
    score_stream(spark, src, df.schema, out, ck, cfg, ctx, new_m, ret_m, 0.5)
    got = spark.read.parquet(out).drop("batch_id")
    assert n1 == first.count()
    assert got.count() == df.count() and got.select("row_id").distinct().count() == df.count()
    want = route_and_score(df, cfg, ctx, new_m, ret_m, 0.5)
    assert got.exceptAll(want.select(*got.columns)).count() == 0
