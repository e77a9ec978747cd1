"""Merging against literal folds over random intervals, and plans."""

import random

from pyspark.sql import functions as F

from svloom.operators import merge
from svloom.operators.intervals import islands, islands_within, overlap_join


def random_calls(seed, n=400, span=3000, sources=("A", "B", "C")):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        start = rng.randrange(span)
        out.append((i, "1", start, start + rng.choice([0, 5, 20, 60, 150]), "DEL", 50 + i % 7, rng.choice(sources), 3))
    return out


COLUMNS = "call_id long, chrom string, start_pos long, end_pos long, sv_type string, sv_len long, source string, wiggle int"


def fold_islands(rows, w):
    """Sorted intervals join the run before them while they overlap what it covers."""
    runs = []
    for call_id, _, s, e, *_ in sorted(rows, key=lambda r: (r[2], r[3], r[0])):
        if runs and s - w < runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], e + w)
            runs[-1][2].append(call_id)
        else:
            runs.append([s - w, e + w, [call_id]])
    return runs


def test_merge_intra_is_the_fold(spark):
    rows = random_calls(1)
    got = merge.merge_intra(spark.createDataFrame(rows, COLUMNS)).collect()
    expected = set()
    for source in ("A", "B", "C"):
        mine = [r for r in rows if r[6] == source]
        raw = {r[0]: (r[2], r[3]) for r in mine}
        for low, high, ids in fold_islands(mine, 3):
            expected.add((source, *(raw[ids[0]] if len(ids) == 1 else (low, high)), len(ids)))
    assert {(r["source"], r["start_pos"], r["end_pos"], r["n_calls"]) for r in got} == expected


def test_islands_by_blocks_equal_those_of_a_window(spark):
    """Across blocks of any width, for touching and negative gaps, mixed wiggles and null keys."""
    rng = random.Random(2)
    rows = [(*r[:1], rng.choice(["1", "2", None]), *r[2:7], rng.choice([0, 3, 40])) for r in random_calls(2)]
    df = spark.createDataFrame(rows, COLUMNS)
    group = lambda d: {(r["chrom"], frozenset(r["ids"])) for r in d.groupBy("chrom", "island").agg(F.collect_list("call_id").alias("ids")).collect()}
    low, high = F.col("start_pos") - F.col("wiggle"), F.col("end_pos") + F.col("wiggle")
    for first, touching, gap, block in (("start_pos", False, 0, 200), ("start_pos", True, -30, 50), (low, True, 0, 1000), ("start_pos", False, -5, 7), ("start_pos", True, 10, 10**6)):
        order = [first, "start_pos", "end_pos", "call_id"]
        plain = islands_within(df, ["chrom"], order, low, high, touching=touching, gap=gap)
        assert group(islands(df, ["chrom"], order, low, high, touching=touching, gap=gap, block=block, slack=50)) == group(plain)
    assert "_" not in {c[0] for c in islands(df, ["chrom"], ["start_pos"], low, high).columns}


def test_long_intervals_meet_short_ones(spark):
    """Pairs of all lengths meet once, in blocks shorter and longer than the intervals."""
    rng = random.Random(3)
    rows = [(i, rng.choice("12"), s, s + rng.choice([0, 3, 50, 5_000, 90_000])) for i, s in enumerate(rng.randrange(100_000) for _ in range(120))]
    df = spark.createDataFrame(rows, "call_id long, chrom string, start_pos long, end_pos long")
    for block in (1_000, 1 << 20):
        got = sorted((r["call_id"], r["b_call_id"]) for r in overlap_join(df, df, pad=5, block=block).collect())
        assert got == sorted((a[0], b[0]) for a in rows for b in rows if a[1] == b[1] and max(a[2] - 5, b[2]) < min(a[3] + 5, b[3]))


def test_overlap_join_is_exact(spark):
    rows = random_calls(3, n=200)
    df = spark.createDataFrame(rows, COLUMNS).select("call_id", "chrom", "start_pos", "end_pos")
    joined = overlap_join(df, df, pad=4, block=64)
    plan = joined._jdf.queryExecution().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    got = sorted((r["call_id"], r["b_call_id"], r["overlap_bp"]) for r in joined.collect())
    expected = []
    for a in rows:
        for b in rows:
            bp = min(a[3] + 4, b[3]) - max(a[2] - 4, b[2])
            if bp > 0:
                expected.append((a[0], b[0], bp))
    assert got == sorted(expected)


def test_reciprocal_chains_are_the_fold(spark):
    rows = random_calls(4, n=300, span=1500)
    got = merge.reciprocal_chains(spark.createDataFrame(rows, COLUMNS), ["sv_type", "chrom"]).collect()
    chains = []
    for r in sorted(rows, key=lambda r: (r[2], r[3], r[0])):
        if chains:
            c = chains[-1]
            bp = min(c[1], r[3]) - max(c[0], r[2])
            if bp > 0 and bp >= 0.5 * max(c[1] - c[0], r[3] - r[2]):
                chains[-1] = [min(c[0], r[2]), max(c[1], r[3]), c[2] + [r[0]]]
                continue
        chains.append([r[2], r[3], [r[0]]])
    assert sorted((r["start_pos"], r["end_pos"], r["ids"]) for r in got) == sorted((a, b, ids) for a, b, ids in chains)


def fold_inter(items, ratio):
    """Level-2 merging of (low, high, wiggle, id), by the recursion itself."""

    def overlaps(a, b, r):
        (s, e, w), (t, f, v) = a[:3], b[:3]
        bp = min(e + w, f + v) - max(s - w, t - v)
        return max(s - w, t - v) < min(e + w, f + v) and bp >= max(r * (e - s + 2 * w), r * (f - t + 2 * v)) and bp >= 1

    def merged(rows):
        out = []
        for x in sorted(rows, key=lambda r: (r[0], r[1], r[3][0])):
            if out:
                c = out[-1]
                touch = (x[0] <= c[1] < x[1]) or (c[0] <= x[1] < c[1])
                if overlaps(c, x, 1e-9) or touch:
                    out[-1] = (min(c[0] - c[2], x[0] - x[2]), max(c[1] + c[2], x[1] + x[2]), 0, c[3] + x[3])
                    continue
            out.append(x)
        return out

    def go(rows):
        islands_ = merged(rows)
        good = [x for x in rows if any(set(x[3]) <= set(i[3]) and overlaps(x, i, ratio) for i in islands_)]
        bad = [x for x in rows if x not in good]
        if not bad:
            return islands_
        return bad if not good else go(bad) + go(good)

    return go(items)


def test_merge_inter_is_the_recursion(spark):
    for seed in (5, 6):
        rows = random_calls(seed, n=120, span=4000)
        level1 = merge.settled(merge.merge_intra(spark.createDataFrame(rows, COLUMNS)))
        got = {}
        for r in merge.merge_inter(level1).collect():
            got.setdefault(r["l2_id"], set()).add(r["l1_id"])
        items = [(r["start_pos"], r["end_pos"], r["wiggle"], (r["l1_id"],)) for r in level1.collect()]
        assert {frozenset(x) for x in got.values()} == {frozenset(x[3]) for x in fold_inter(items, 0.5)}


def test_translocations_pair_up(spark):
    rows = [(i, "1", "1", 100 + i, 500 + i, "ITX", 0, "BreakDancer", 5) for i in range(3)] + [(9, "1", "2", 100, 500, "CTX", 0, "BreakDancer", 5)]
    df = spark.createDataFrame(rows, "call_id long, chrom string, chrom2 string, start_pos long, end_pos long, sv_type string, sv_len long, source string, wiggle int")
    got = sorted((r["l1_id"], r["n_calls"], r["start_pos"], r["end_pos"]) for r in merge.pair_translocations(df).collect())
    assert got == [(0, 2, 95, 506), (2, 1, 102, 502), (9, 1, 100, 500)]


def fold_pairs(items):
    """The recursion over translocations (start, end, wiggle, ids), sorted, as it is written down."""
    near = lambda x, y: abs(x[0] - y[0]) < x[2] and abs(x[1] - y[1]) < x[2]
    items = sorted(items, key=lambda x: (x[0], x[1], x[3]))
    merged = []
    for x in items:
        if merged and near(merged[-1], x):
            c = merged.pop()
            x = (min(c[0] - c[2], x[0] - x[2]), max(c[1] + c[2], x[1] + x[2]), 0, c[3] + x[3])
        merged.append(x)
    good = [x for x in items if any(near(x, m) for m in merged if m[2])]
    bad = [x for x in items if x not in good]
    if not bad:
        return merged
    return bad if not good else fold_pairs(bad) + fold_pairs(good)


def test_translocations_of_callers_pair_up_where_a_third_stands_by(spark):
    rng = random.Random(7)
    rows = []
    for site in range(60):
        for k in range(rng.choice([1, 2, 2, 3, 3, 4, 5, 7])):
            rows.append((len(rows), "1", "2", 10_000 * site + rng.randrange(7), 500_000 + rng.randrange(7), "CTX", 0, rng.choice(["Pindel", "BreakDancer", "Manta", "Lumpy"]), 5))
    df = spark.createDataFrame(rows, "call_id long, chrom string, chrom2 string, start_pos long, end_pos long, sv_type string, sv_len long, source string, wiggle int")
    level1 = merge.settled(merge.level1_of(df))
    got = {}
    for r in merge.merge_pairs(level1).collect():
        got.setdefault(r["l2_id"], set()).add(r["l1_id"])
    items = level1.collect()
    expected = set()
    for site in range(60):
        here = [(r["start_pos"], r["end_pos"], r["wiggle"], (r["l1_id"],)) for r in items if abs(r["start_pos"] - 10_000 * site) < 100]
        expected |= {frozenset(x[3]) for x in fold_pairs(here)}
    assert {frozenset(x) for x in got.values()} == expected and max(map(len, expected)) == 2
    calls = merge.consolidated(df)
    found = calls.collect()
    assert sum(r["n_calls"] for r in found) == len(rows) and {r["chrom2"] for r in found} == {"2"}
    both = [r for r in found if r["n_level1"] == 2]
    assert both and all(r["is_validated"] == (len(r["sources"]) > 1 and "Pindel" in r["sources"]) for r in both)
