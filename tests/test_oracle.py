"""Every registered query with a SQL counterpart gives the same rows on DuckDB."""

from __future__ import annotations

import importlib

import compare
import pytest

entry = importlib.import_module("__spark_entry__")
QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(sf_dir):
    return compare.connect(sf_dir)


def test_every_query_has_an_oracle():
    own = {q for q in QUERIES if not q.startswith("op") and q != "pipeline"}  # tests/llm has its own
    assert own <= set(SQL)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, duck, name):
    assert compare.differences(QUERIES[name](spark, sf_dir), duck, SQL[name]) == []


def test_entry_returns_rows(spark):
    assert entry.entry(spark).columns[:2] == ["field", "basin"]
