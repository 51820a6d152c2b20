import pytest
from pyspark.sql import DataFrameWriter

import __spark_entry__ as entry
from statmart.suite.compare import difference, oracle_connection
from statmart.suite.oracle import ORACLE
from statmart.suite.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    pytest.importorskip("duckdb")
    return oracle_connection(FOLDER)


def test_every_query_has_an_answer():
    assert set(QUERIES) == set(ORACLE)
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, oracle, name):
    assert difference(entry.queries()[name](spark, FOLDER), oracle, entry.oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry.entry(spark).collect()
    by_category = {}
    for r in rows:
        by_category.setdefault((r["category"], r["total"], r["non_top"]), []).append(r["count"])
    assert len(by_category) == 4
    for (_, total, rest), counts in by_category.items():
        assert sum(counts) + rest == total and min(counts) > 0


class Plans:
    """The physical plans of all that runs meanwhile, writes made while a query is built included."""

    def __init__(self, spark):
        self.spark, self.seen = spark, []

    def __enter__(self):
        plans, method = self.seen, DataFrameWriter.parquet

        def parquet(writer, *args, **options):
            plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
            return method(writer, *args, **options)

        self.restore = method
        DataFrameWriter.parquet = parquet
        return self.seen

    def __exit__(self, *_):
        DataFrameWriter.parquet = self.restore


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_plans_have_no_product_and_no_python(spark, name):
    with Plans(spark) as plans:
        plans.append(QUERIES[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString())
    for plan in plans:
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
            assert word not in plan
