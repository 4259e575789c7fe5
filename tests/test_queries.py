"""Every registered query against its SQL, on the smallest tables."""

import pytest

from registry.oracles import ORACLES
from registry.queries import QUERIES
from tests import compare

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    return compare.connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, connection, name):
    assert compare.difference(spark, connection, QUERIES[name], ORACLES[name], SF_DIR) == ""


PYTHON_QUERIES = {"page_metadata", "page_articles"}
LISTED = ["silver_articles", "top_keywords", "wh_fact_articles", "build_events", "page_body", "top_links_per_page",
          "crawl_cap", "summary_stats", "dq_q3_bronze_required"]


@pytest.mark.parametrize("name", LISTED + sorted(PYTHON_QUERIES))
def test_plan(spark, name):
    """Python only where pages are parsed; no join without a key."""
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert ("Python" in plan or "InPandas" in plan) == (name in PYTHON_QUERIES)
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["page_links", "top_links_per_page", "page_articles", "page_body"])
def test_page_queries_do_not_shuffle(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_scans_read_only_what_they_need(spark):
    plan = QUERIES["articles_by_source"](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    assert "lang" not in plan.split("ReadSchema: ")[1].split("\n")[0]
