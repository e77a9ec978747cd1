"""Sums over what holds a point, without pairs."""

import random

import numpy as np

from svloom.fixtures import Inputs
from svloom.operators.sweeps import point_sums
from svloom.plans import evidence


def test_point_sums_are_those_of_pairs(spark):
    rng = random.Random(3)
    queries = [(i, rng.choice(["1", "2", None]), s, s + rng.randrange(1, 300)) for i in range(80) for s in [rng.randrange(400)]]
    intervals = [(rng.choice(["1", "2", None]), s, s + rng.randrange(-2, 200), rng.randrange(5)) for _ in range(200) for s in [rng.randrange(-50, 600)]]
    ends = lambda t: (np.column_stack([t["start_pos"].to_numpy(), t["start_pos"].to_numpy(), t["end_pos"].to_numpy() - 1]), 2)
    q = spark.createDataFrame(queries, "id long, chrom string, start_pos long, end_pos long")
    found = point_sums(q, spark.createDataFrame(intervals, "chrom string, start_pos long, end_pos long, w long"), ["id"], ["w"], ends, block=64).collect()
    at = lambda chrom, p: sum(w for c, a, b, w in intervals if c == chrom and a <= p < b)
    assert sorted(map(tuple, found)) == sorted((i, 2 * at(c, s), at(c, e - 1)) for i, c, s, e in queries if c)


def test_read_features_deal_a_call_once(spark, sf_dir):
    t = Inputs(spark, sf_dir)
    plan = evidence.evidence.variant_read_features(t.calls, t.reads, 350, 50)._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" not in plan and "FlatMapCoGroupsInArrow" in plan
