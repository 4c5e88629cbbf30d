"""Registered queries against DuckDB. ORACLES=all runs every one of them."""

import os

import pytest

import __spark_entry__ as entry
from checks.compare import diff, oracle_connection

QUICK = ("loans_labelled", "coerce_types", "input_validation", "bureau_features", "prior_history", "owner_history", "shop_lookup", "banking_velocity",
         "payment_features", "points_engine", "point_reasons", "hard_rules", "woe_table", "exact_quantiles", "ranking_metrics", "decile_table",
         "psi_scores", "psi_categories", "review_priority", "review_cutoffs", "capacity_plan", "kaplan_meier", "group_rates", "drift_status", "vintage_tracking")
NAMES = sorted(entry.oracle_sql()) if os.environ.get("ORACLES") == "all" else QUICK


@pytest.fixture(scope="module")
def duck(sf):
    return oracle_connection(sf)


@pytest.mark.parametrize("name", NAMES)
def test_matches_oracle(spark, sf, duck, name):
    got = entry.queries()[name](spark, sf).toPandas()
    assert diff(got, duck.execute(entry.oracle_sql()[name]).df()) == ""


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_grade_boundaries_round_as_in_sql(spark, sf, duck):
    got = entry.queries()["grade_schemes"](spark, sf).toPandas()
    assert diff(got, duck.execute(entry.oracle_sql()["grade_schemes"]).df()) == ""
