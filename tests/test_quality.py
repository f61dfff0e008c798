from __future__ import annotations

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import Observation

from wellops.operators.quality import Rule, apply_rules, expect, expect_or_drop, expect_or_fail, violations

RULES = [expect("small", "v < 10"), expect_or_drop("positive", "v > 0"), expect_or_fail("id_present", "id IS NOT NULL")]


def _rows(spark, rows):
    return spark.createDataFrame(rows, "id bigint, v double")


def test_three_actions(spark):
    df = _rows(spark, [(1, 5.0), (2, 50.0), (3, -1.0), (4, None)])
    assert sorted(r["id"] for r in apply_rules(df, RULES).collect()) == [1, 2]
    got = {r["rule"]: (r["action"], r["violations"], r["total"]) for r in violations(df, RULES).collect()}
    assert got == {"small": ("count", 2, 4), "positive": ("drop", 2, 4), "id_present": ("fail", 0, 4)}


def test_fail_stops_and_names_the_rule(spark):
    df = _rows(spark, [(1, 5.0), (None, 5.0)])
    with pytest.raises(PySparkException, match="id_present"):
        apply_rules(df, RULES).collect()


def test_fail_sees_rows_that_drop_would_remove(spark):
    df = _rows(spark, [(1, 5.0), (None, -5.0)])
    with pytest.raises(PySparkException, match="id_present"):
        apply_rules(df, RULES).collect()


def test_later_join_and_filter_do_not_hide_a_failing_row(spark):
    """A join on the tested key infers IS NOT NULL; it must not reach below the test."""
    df = apply_rules(_rows(spark, [(1, 5.0), (None, 5.0)]), RULES)
    other = spark.createDataFrame([(1, "a")], "id bigint, name string")
    with pytest.raises(PySparkException, match="id_present"):
        df.join(other, "id").groupBy("name").count().collect()
    with pytest.raises(PySparkException, match="id_present"):
        df.filter("id = 1").collect()


def test_observed_metrics_equal_the_counted_ones(spark):
    df = _rows(spark, [(i, float(i % 25 - 3)) for i in range(500)]).repartition(7)
    seen = Observation("m")
    kept = apply_rules(df, RULES, seen).count()
    counted = {r["rule"]: r["violations"] for r in violations(df, RULES).collect()}
    assert seen.get["rows"] == 500 and seen.get["kept"] == kept
    assert {k: seen.get[k] for k in counted} == counted


def test_empty_input(spark):
    df = _rows(spark, [])
    assert apply_rules(df, RULES).count() == 0
    assert {(r["violations"], r["total"]) for r in violations(df, RULES).collect()} == {(0, 0)}


def test_unknown_action_is_refused():
    with pytest.raises(ValueError, match="unknown action"):
        Rule("x", "true", "warn")
