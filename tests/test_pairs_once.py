"""Pairs of calls' fragments: reads take their mates along, so what meets the windows is neither shuffled nor joined; the rare cases are met by name."""

import random

import pytest

from svloom import fixtures
from svloom.operators import evidence
from svloom.plans import evidence as plans

READS = "read_id long, qname string, chrom string, pos long, aend long, is_read1 boolean"


def some_reads(seed, n=160):
    """Fragments of one to four reads, of one kind or both; mates side by side, far apart, or on another chromosome; long, empty and nameless reads."""
    rng = random.Random(seed)
    rows = []
    for k in range(n):
        chrom, at = rng.choice("12"), rng.randrange(20_000, 60_000)
        for i in range(rng.choice([1, 2, 2, 2, 2, 3, 4])):
            pos = at + rng.choice([0, 40, 300, 12_000, 20_000]) * i
            length = rng.choice([100, 100, 100, 0, 15_000])
            rows.append((len(rows), None if k % 40 == 7 else f"q{k}", chrom if rng.random() < 0.9 else "3", pos, pos + length, rng.random() < 0.2 if i else True))
    return rows


def expected(calls, reads, most):
    """`(call, name, first, second)` by trying everything."""
    out = []
    for call, chrom, start, end, kind in calls:
        low, high = start - 500, end + 500
        if low < 0:
            continue
        windows = [(low, low + 4_499), (high - 4_499, high)] if high - low > 10_000 and kind in ("INV", "DEL", "DUP") else [(low, high)]
        names = {r[1] for r in reads for s, e in windows if r[2] == chrom and r[3] < r[4] and max(r[3], s) < min(r[4], e)}
        if len(names) <= most:
            for name in names - {None}:
                sides = [[r[0] for r in reads if r[1] == name and r[5] == one] for one in (True, False)]
                out += [(call, name, max(sides[0]), max(sides[1]))] if all(sides) else []
    return sorted(out)


@pytest.mark.parametrize("most", [8, 30, 10_000])
def test_pairs_are_those_of_all_tries(spark, most):
    rng = random.Random(most)
    reads = some_reads(most)
    calls = [(i, rng.choice("12"), s, s + rng.choice([0, 900, 9_001, 14_000, 30_000]), rng.choice(["DEL", "INS", "INV"])) for i, s in enumerate([300, *(rng.randrange(15_000, 60_000) for _ in range(60))])]
    found = evidence.build_pairs(spark.createDataFrame(calls, "call_id long, chrom string, start_pos long, end_pos long, sv_type string"), spark.createDataFrame(reads, READS), most=most)
    got = sorted((r["call_id"], r["qname"], r["first"]["read_id"], r["second"]["read_id"]) for r in found.collect())
    every = expected(calls, reads, 10_000)
    assert got == expected(calls, reads, most) and len(every) > 400 and (most == 10_000 or 0 < len(got) < len(every))


def test_meetings_are_not_shuffled(spark, sf_dir):
    """On the given tables no fragment has more than two reads, and no call too many: the sweep's rows are the result."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = plans.pairs_select(fixtures.Inputs(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    above, *below = plan.split("MapInArrow")
    assert len(below) == 1 and "Exchange" not in above and "Join" not in plan
