"""The pipeline's stages and the registered corpus queries on the small tables."""

from __future__ import annotations

import __spark_entry__
import corpus_pipeline
import pytest
from orderlens.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def test_stages_hold_their_contract(spark, tmp_path):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    own = docs.columns
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near_duplicates", "repeated_passages", "secrets", "packing"]
    sizes = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SMALL)
        if k < 4:
            assert out.columns == own
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        sizes.append(docs.select("doc_id").distinct().count())
    assert sizes[0] > sizes[1] > sizes[2] == sizes[3] == sizes[4] == sizes[5]


def test_run_equals_its_stages(spark):
    out = corpus_pipeline.run(spark, SMALL)
    assert {"doc_id", "bin", "capacity", "offset"} <= set(out.columns)
    assert out.where("bin is not null").count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_queries_cover_their_tables(spark, name):
    out = __spark_entry__.queries()[name](spark, SMALL)
    table = {"op1": "embeddings", "op4": "pages", "op7": "embeddings", "op11": "conversations", "op12": "pages", "op13": "embeddings"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SMALL}/{table}.parquet")
    if name.startswith("op7"):
        asked = rows.where("vec_id % 50 = 0").count()
        assert out.count() == 5 * asked
    elif name.startswith("op10"):
        assert out.select("doc_id").distinct().count() == rows.count()
    elif name.startswith("op11"):
        assert out.where("depth = 0").first().n_convs == rows.select("conv_id").distinct().count()
    elif name.startswith("op13"):
        assert out.select("anchor_id").distinct().count() == rows.where("vec_id % 100 = 0").count()
    else:
        assert out.count() == rows.count()
