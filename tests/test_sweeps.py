"""Sweeps, counts, streamed folds and layouts against brute force, in small blocks and batches."""

import random

import pytest
from pyspark.sql import functions as F

from svloom.operators import evidence, merge
from svloom.operators.sweeps import bin_counts, overlap_counts, overlap_join
from svloom.sources import layout, sequence

SCHEMA = "id long, chrom string, start_pos long, end_pos long, kind string"


@pytest.fixture
def small_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    yield
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def intervals(seed, n, span=2_000):
    rng = random.Random(seed)
    rows = [(i, rng.choice(["1", "1", "1", "2", None]), s, s + rng.choice([0, 1, 10, 60, 700]), rng.choice(["x", "y"])) for i, s in enumerate(rng.randrange(span) for _ in range(n))]
    return [*rows, *rows[:5], (n, "1", None, 5, "x"), (n + 1, "1", 0, span, "x")]


def meet(a, b, pad=0):
    return a[1] is not None and a[1] == b[1] and None not in (a[2], b[2]) and max(a[2] - pad, b[2]) < min(a[3] + pad, b[3]) and a[2] - pad < a[3] + pad and b[2] < b[3]


def test_join_in_small_batches(spark, small_batches):
    a, b = intervals(1, 150), intervals(2, 90)
    da, db = spark.createDataFrame(a, SCHEMA), spark.createDataFrame(b, SCHEMA).withColumn("_low", F.lit(1))
    for block in (50, 1 << 20):
        got = sorted((r.id, r.b_id, r.overlap_bp) for r in overlap_join(da, db, pad=3, on=["kind"], block=block).collect())
        assert got == sorted((x[0], y[0], min(x[3] + 3, y[3]) - max(x[2] - 3, y[2])) for x in a for y in b if x[4] == y[4] and meet(x, y, 3))


def test_dense_place_makes_its_pairs_only(spark):
    """A thousand reads at one place and a thousand beside it: the sweep forms no pair of the two."""
    rows = [(i, "1", 100 if i % 2 else 200, 150 if i % 2 else 250, "x") for i in range(2000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert overlap_join(df.where("start_pos = 100 and id < 20"), df).count() == 10 * 1000


def test_counts_are_those_of_pairs(spark):
    a, b = intervals(3, 120), intervals(4, 200)
    for block in (64, 1 << 20):
        got = {r.id: r.n for r in overlap_counts(spark.createDataFrame(a[:120], SCHEMA), spark.createDataFrame(b, SCHEMA), ["id"], on=["kind"], block=block).collect()}
        assert got == {x[0]: sum(x[4] == y[4] and meet(x, y) for y in b) for x in a[:120] if x[2] < x[3] and x[1] is not None}


def test_bins_of_calls(spark):
    rng = random.Random(5)
    calls = [(i, "1", s, s + rng.randrange(1, 900)) for i, s in enumerate(rng.randrange(3_000) for _ in range(40))]
    reads = [("1", s, s + rng.choice([1, 30, 100]), rng.random() < 0.5) for s in (rng.randrange(-100, 4_000) for _ in range(500))]
    for block in (128, 1 << 20):
        got = {r.call_id: (r.n, r.good) for r in bin_counts(spark.createDataFrame(calls, "call_id long, chrom string, start_pos long, end_pos long"), spark.createDataFrame(reads, "chrom string, start_pos long, end_pos long, good boolean"), 50, block).collect()}
        for i, _, s, e in calls:
            n = [[sum(p < x + 50 and q > x and (g or not only) for _, p, q, g in reads) for x in range(s, e, 50)] for only in (False, True)]
            assert got[i] == (n[0], n[1])


def test_folds_go_on_from_batch_to_batch(spark, small_batches):
    """Components of hundreds of rows, far longer than a batch, give the fold's chains and runs."""
    rng = random.Random(6)
    rows = [(i, "DEL", "1", s, s + rng.choice([40, 60, 90]), rng.random() < 0.2, rng.sample(["SR", "RP", "AS", "SC"], rng.randrange(1, 3))) for i, s in enumerate(sorted(rng.randrange(1500) for _ in range(400)))]
    df = spark.createDataFrame(rows, "call_id long, sv_type string, chrom string, start_pos long, end_pos long, passed boolean, methods array<string>")
    chains = []
    for r in sorted(rows, key=lambda r: (r[3], r[4], r[0])):
        c = chains[-1] if chains else None
        common = min(c[1], r[4]) - max(c[0], r[3]) if c else 0
        if common > 0 and common >= 0.5 * max(c[1] - c[0], r[4] - r[3]):
            chains[-1] = (min(c[0], r[3]), max(c[1], r[4]), [*c[2], r[0]])
        else:
            chains.append((r[3], r[4], [r[0]]))
    got = merge.reciprocal_chains(df, ["sv_type", "chrom"]).collect()
    assert sorted((r.start_pos, r.end_pos, r.ids) for r in got) == sorted(chains)
    runs = merge.coalesce_adjacent(df, near=80).collect()
    assert sum(r.n_calls for r in runs) == 400 and max(r.n_calls for r in runs) > 7


def test_only_named_rows_pass_the_filter(spark):
    rows = spark.range(5_000).select("id", F.concat(F.lit("q"), "id").alias("name"))
    wanted = rows.where("id % 97 = 0").select("name")
    assert {r.id for r in evidence.named(rows, wanted, "name").collect()} == set(range(0, 5_000, 97))
    n = wanted.count()
    kept = rows.crossJoin(F.broadcast(evidence._bloom(wanted, "name", n))).where(evidence._maybe(F.col("name"), n)).count()
    assert n <= kept <= n + 0.03 * 5_000
    assert evidence.named(rows, wanted.limit(0), "name").count() == 0


def test_layout_opens_touched_blocks_only(spark, tmp_path):
    rng = random.Random(7)
    reads = [(i, rng.choice("12"), p, p + rng.choice([50, 100])) for i, p in enumerate(rng.randrange(100_000) for _ in range(2_000))]
    layout.write_clustered(spark.createDataFrame(reads, "read_id long, chrom string, pos long, aend long"), str(tmp_path / "reads"), 10_000)
    stored = layout.read_clustered(spark, str(tmp_path / "reads"), "read_id long, chrom string, pos long, aend long")
    assert stored.count() == 2_000
    windows = spark.createDataFrame([("1", 19_990, 20_010), ("2", 95_000, 95_001)], "chrom string, start_pos long, end_pos long")
    near = layout.touching(stored, windows, 100, 10_000)
    plan = near._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "PartitionFilters: []" not in plan
    assert {(r.chrom, r.block) for r in near.select("chrom", "block").distinct().collect()} == {("1", 1), ("1", 2), ("2", 9)}
    want = {r[0] for r in reads for w in (("1", 19_990, 20_010), ("2", 95_000, 95_001)) if r[1] == w[0] and max(r[2], w[1]) < min(r[3], w[2])}
    assert want <= {r.read_id for r in near.collect()}
    assert layout.touching(stored, windows.limit(0), 100, 10_000).count() == 0


def test_layout_has_few_folders(spark, tmp_path):
    """Folders grow with stretches of blocks, not with blocks; all rows come back, those of negative places, too."""
    reads = spark.range(-40, 960).selectExpr("id as read_id", "'1' as chrom", "id * 100 + 7 as pos", "id * 100 + 90 as aend")
    path = tmp_path / "reads"
    layout.write_clustered(reads, str(path), 100)
    assert len(list(path.glob("chrom=1/*"))) <= 1 + 960 // 64 + 1
    stored = layout.read_clustered(spark, str(path), "read_id long, chrom string, pos long, aend long")
    windows = spark.createDataFrame([("1", -1_000, -900), ("1", 63 * 100 + 50, 64 * 100 + 10)], "chrom string, start_pos long, end_pos long")
    near = layout.touching(stored, windows, 100, 100)
    assert {r.read_id for r in near.collect()} == {-11, -10, 62, 63, 64}
    assert stored.count() == 1_000


def test_bases_come_from_chunks(spark):
    rng = random.Random(8)
    text = {c: "".join(rng.choices("ACGT", k=700)) for c in "12"}
    lines = [(c, at, text[c][at : at + 61]) for c in "12" for at in range(0, 700, 61) if at != 122]
    chunks = sequence.chunked(spark.createDataFrame(lines, "chrom string, at long, seq string"), 100).cache()
    assert max(r.n for r in chunks.select(F.length("seq").alias("n")).collect()) <= 100
    calls = [(i, c, p) for i, (c, p) in enumerate([("1", 1), ("1", 100), ("1", 101), ("1", 130), ("2", 700), ("2", 701), ("3", 5), ("2", 0)])]
    got = {r.call_id: r.ref_base for r in sequence.with_reference(spark.createDataFrame(calls, "call_id long, chrom string, start_pos long"), chunks, 100).collect()}
    assert got == {i: "N" if c == "3" or p > 700 or 122 < p <= 183 else text[c][max(0, p - 1)] for i, c, p in calls}
