"""The long expressions of votes: compiled once, not interpreted, and short enough for the Java VM; sweeps carry keys once."""

import random
import re

import pytest
from pyspark.sql import functions as F

from svloom import fixtures
from svloom.functions import reads as R
from svloom.operators import softclip, sweeps
from svloom.plans import softclip as plans

#: Bytes of a method beyond which the Java VM leaves it uncompiled.
HUGE = 8_000


@pytest.fixture
def final_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.unset("spark.sql.adaptive.enabled")


def explained(df, mode):
    return df._jdf.queryExecution().explainString(df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString(mode))


def test_votes_are_compiled(spark, sf_dir, final_plans):
    t = fixtures.Inputs(spark, sf_dir)
    reads = plans.kept_reads(t)
    marked = softclip.merged_windows(softclip.candidates(reads))
    windows = softclip.window_features(marked, plans.WINDOW_KEY)
    for df in (softclip.candidates(reads), softclip.neighbour_votes(windows, reads, plans.WINDOW_KEY)):
        sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", explained(df, "codegen"))]
        assert sizes and max(sizes) < HUGE
        assert "lambda" not in explained(df, "simple")


def test_no_vote_is_no_row(spark):
    rows = [(1, 5), (2, None), (3, -4), (4, 0)]
    df = spark.createDataFrame(rows, "id long, place long")
    assert sorted(map(tuple, R.with_vote(df, "at", F.col("place")).select("id", "at").collect())) == [(1, 5), (3, 0), (4, 0)]


def test_sweep_carries_keys_once(spark):
    """Keys of other types on the two sides come back as they came, and stand in no struct of the rows that are dealt."""
    a = spark.createDataFrame([(1, 7, 0, 10), (2, 8, 0, 10), (None, 9, 5, 6)], "chrom int, x int, start_pos long, end_pos long")
    b = spark.createDataFrame([(1, 7, 5, 8, "p"), (2, 7, 5, 8, "q")], "chrom long, x long, start_pos long, end_pos long, name string")
    met = sweeps.overlap_join(a, b, on=["x"])
    assert [(f.name, f.dataType.simpleString()) for f in met.schema.fields] == [("chrom", "int"), ("x", "int"), ("start_pos", "bigint"), ("end_pos", "bigint"), ("b_chrom", "bigint"), ("b_x", "bigint"), ("b_start_pos", "bigint"), ("b_end_pos", "bigint"), ("b_name", "string"), ("overlap_bp", "bigint")]
    assert list(map(tuple, met.collect())) == [(1, 7, 0, 10, 1, 7, 5, 8, "p", 3)]
    dealt = [line for line in explained(met, "extended").splitlines() if "struct(" in line or "named_struct(" in line]
    assert dealt and not any(re.search(r"struct\([^)]*\b(chrom|x)\b", line) for line in dealt)


def test_sweep_sorts_by_one_number(spark, final_plans):
    """The rows of many keys lie mixed in a batch, over several blocks; intervals reach over blocks and begin before theirs."""
    rng = random.Random(8)
    rows = [(i, rng.choice("123"), s, s + rng.choice([1, 5, 40, 300]), rng.choice("xyz")) for i, s in enumerate(rng.randrange(-100, 1_500) for _ in range(500))]
    a, b = (spark.createDataFrame(part, "id long, chrom string, start_pos long, end_pos long, kind string") for part in (rows[:300], rows[300:]))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "37")
    try:
        for n in ("1", "4"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            met = sweeps.overlap_join(a, b, on=["kind"], block=128)
            assert re.search(r"Sort \[_at#\d+L ASC NULLS FIRST\]", explained(met, "simple"))
            assert sorted((r.id, r.b_id) for r in met.collect()) == sorted((x[0], y[0]) for x in rows[:300] for y in rows[300:] if x[1] == y[1] and x[4] == y[4] and max(x[2], y[2]) < min(x[3], y[3]))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
        spark.conf.set("spark.sql.shuffle.partitions", "4")
