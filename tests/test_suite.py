"""Every registered query against DuckDB, and the entry points."""

import importlib.util
import os

import pytest

from compare import connect, difference
from conftest import ROOT
from tidemark.suite import QUERIES, SQL

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="the given tables are not here")


@pytest.fixture(scope="module")
def engine():
    return connect(FOLDER)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(name, spark, engine):
    assert difference(QUERIES[name], SQL[name], spark, engine, FOLDER) is None


@pytest.mark.parametrize("name", [n for n in QUERIES if n[0] in "hl" or n.startswith("j")])
def test_query_equals_sql_without_broadcasts(name, spark, engine, settings):
    """As on large tables: chains are nested and every join is shuffled."""
    settings(**{"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"})
    assert difference(QUERIES[name], SQL[name], spark, engine, FOLDER) is None


def test_entry_points(spark):
    spec = importlib.util.spec_from_file_location("entry_points", os.path.join(ROOT, "__spark_entry__.py"))
    module = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(module)
    # Corpus queries come on top where that part is there; their tests are beside it.
    assert QUERIES.items() <= module.queries().items() and SQL.items() <= module.oracle_sql().items()
    assert QUERIES.keys() == SQL.keys() and module.oracle_sql().keys() <= module.queries().keys()
    assert module.entry(spark).count() > 0
