"""Both levels of the merge go over the calls once: what they keep is small, and runs over the borders of blocks stay whole."""

import random

from svloom.operators import merge

from .test_merge import COLUMNS, fold_inter, fold_islands

BORDER = 1 << 20


def calls_over_borders(seed, n=260):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.choice([BORDER, 3 * BORDER]) + rng.randrange(-2_500, 2_500) if i % 4 else rng.randrange(4 * BORDER)
        out.append((i, rng.choice("12"), start, start + rng.choice([0, 5, 20, 60, 150]), "DEL", 50 + i % 7, rng.choice("ABC"), 3))
    # One that goes over two borders, and what it holds there.
    out.append((n, "1", BORDER - 900, 2 * BORDER + 900, "DEL", 60, "A", 3))
    return [*out, *[(n + 1 + k, "1", 2 * BORDER - 500 + 400 * k, 2 * BORDER - 450 + 400 * k, "DEL", 60, "B", 3) for k in range(4)]]


def folded(rows):
    """(start, end, number of level-1 intervals) of each level-2 interval, by the literal folds."""
    out = []
    for chrom in "12":
        items = []
        for source in "ABC":
            mine = [r for r in rows if r[6] == source and r[1] == chrom]
            raw = {r[0]: (r[2], r[3], r[7]) for r in mine}
            items += [(*(raw[ids[0]] if len(ids) == 1 else (low, high, 0)), (ids[0],)) for low, high, ids in fold_islands(mine, 3)]
        out += [(s, e, len(ids)) for s, e, _, ids in fold_inter(items, 0.5)]
    return sorted(out)


def test_calls_are_dealt_once(spark, monkeypatch):
    dealt, settled = [], []
    cut, settle = merge.lone_and_islands, merge.settled
    monkeypatch.setattr(merge, "lone_and_islands", lambda *a, **k: dealt.append(1) or cut(*a, **k))
    monkeypatch.setattr(merge, "settled", lambda df: settled.append(df.count()) or settle(df))
    for seed in (1, 2):
        rows = calls_over_borders(seed)
        df = spark.createDataFrame([(*r, r[1]) for r in rows], COLUMNS + ", chrom2 string")
        found = merge.level2_of(df).select("start_pos", "end_pos", "n_level1", "n_calls").collect()
        assert sorted(tuple(r)[:3] for r in found) == folded(rows) and sum(r["n_calls"] for r in found) == len(rows)
    # Of calls on one chromosome nothing is checkpointed, row by row as it stands in memory.
    assert len(dealt) == 2 and not any(settled)


def test_lone_calls_go_through_no_join(spark):
    """The verdict of calls that meet no other is known without the others."""
    df = spark.createDataFrame([(i, "1", 10_000 * i, 10_000 * i + 90, "DEL", 60, "Pindel", 3, "1") for i in range(20)], COLUMNS + ", chrom2 string")
    out = merge.validate_calls(merge.level2_of(df).where("n_calls = 1"))
    assert {(r["is_validated"], r["is_precise"], r["start_pos"] % 10_000) for r in out.collect()} == {(False, True, 0)}
    lone = merge._lone_level2(df)
    assert "Join" not in merge.validate_calls(lone)._jdf.queryExecution().optimizedPlan().toString()
