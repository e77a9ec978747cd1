"""Fragments of calls are met and counted in one sweep."""

from svloom.plans import evidence, registry  # noqa: F401


def test_fragments_are_met_once(spark, sf_dir):
    plan = registry.QUERIES["cap_pairs"](spark, sf_dir)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan
