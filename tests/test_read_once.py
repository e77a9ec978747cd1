"""Queries that need an input or a join twice make it once."""

import pytest

from svloom import fixtures
from svloom.plans import finals, softclip


@pytest.fixture
def final_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_untyped_windows_meet_the_reads_once(spark, sf_dir, final_plans):
    """Tally and result read the same votes: what is left of the query sweeps nothing."""
    found = softclip.none_resolve(fixtures.Inputs(spark, sf_dir))
    assert "MapInArrow" not in plan(found) and found.count() > 0


def test_calls_of_events_are_grouped_once(spark, sf_dir, final_plans):
    t = fixtures.Inputs(spark, sf_dir)
    assert "l_orderkey" not in plan(finals.res_emit_ctx(t)) and len(t._kept) == 1


def test_mates_are_dealt_once(spark, sf_dir, final_plans):
    t = fixtures.Inputs(spark, sf_dir)
    assert plan(finals.finalize.mate_windows(finals.histogram(finals.kept_calls(t)))).count("Exchange") == 1
