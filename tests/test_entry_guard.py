"""The entry module without the corpus queries' libraries, and stages of a rewritten input."""

import shutil
import sys

import pytest

import __spark_entry__ as entry
from orderlens import catalog as c


def test_a_missing_library_takes_only_its_queries(monkeypatch):
    if not any(n.startswith("op1_") for n in entry.queries()):
        pytest.skip("no corpus queries here")
    for name in [n for n in sys.modules if n.startswith("orderlens.llm") or n == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "regex", None)
    with pytest.warns(UserWarning, match="left out"):
        names = entry.queries()
    assert set(names) == set(c.QUERIES)


def test_a_rewritten_input_is_read_again(spark, tmp_path):
    small = tmp_path / "sf"
    shutil.copytree("/root/testdata/sf0.001", small)
    first = c.clean_set(spark, str(small)).count()
    assert c.clean_set(spark, str(small)).count() == first
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").where("o_orderkey % 2 = 0").toPandas()
    (small / "orders.parquet").chmod(0o644)
    orders.to_parquet(small / "orders.parquet", coerce_timestamps="us", allow_truncated_timestamps=True)
    assert 0 < c.clean_set(spark, str(small)).count() < first
