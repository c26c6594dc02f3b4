"""Operators with a SQL form, against it."""

import pytest

from __spark_entry__ import oracle_sql, queries
from surveyloom.llm.registry import ORACLE, QUERIES
from tests.compare import connect, differences


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_its_sql(spark, sf_dir, name):
    assert differences(queries()[name](spark, sf_dir), connect(sf_dir), oracle_sql()[name]) == []


def test_registered():
    assert [f"op{n}" for n in range(1, 14)] == sorted({q.split("_")[0] for q in QUERIES} - {"pipeline"}, key=lambda q: int(q[2:]))
    assert set(QUERIES) <= set(queries())


@pytest.mark.parametrize("name", ["op1_scaled_sketch", "op5_revisits"])
def test_native_queries_stay_in_the_engine(spark, sf_dir, name):
    text = QUERIES[name](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "InArrow", "InPandas", "MapPartitions", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def test_texts_cross_one_exchange_in_op1(spark, sf_dir):
    text = QUERIES["op1_scaled_sketch"](spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in text[: text.index("FileScan")].splitlines() if "- Exchange " in line]
    assert len(dealt) == 1 and "hashpartitioning(_range" in dealt[0], dealt
