"""Reads as the soft-clip queries take them: by hash aggregates, with the shape of their cigar, kept once."""

import os

from pyspark.sql import functions as F

from svloom import fixtures
from svloom.functions import reads as R
from svloom.operators import softclip
from svloom.plans import softclip as plans


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_view_sorts_rows_to_group_them(spark, sf_dir):
    t = fixtures.Inputs(spark, sf_dir)
    for view in (t.calls, t.reads):
        assert "HashAggregate" in plan(view) and "SortAggregate" not in plan(view)


def test_flags_are_the_least_text(spark):
    """Keys of several rows, with texts before, between and after the literals, empty ones and nulls."""
    texts = [("A",), ("F",), ("O",), ("N", "R"), ("R", "A"), ("O", "F"), ("F", "O", None), (None,), (None, "O"), ("", "F"), ("Z", "O"), ("G", "O"), ("B", "N"), ("FA", "O")]
    rows = [(k, n, i, 7, 5.0, x, x) for n in (1, 2) for k, group in enumerate(texts, 1) for i, x in enumerate(group)]
    spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_suppkey long, l_partkey long, l_quantity double, l_returnflag string, l_linestatus string").createOrReplaceTempView("lineitem")
    for view in ("calls", "reads"):
        assert "MIN(l_returnflag)" not in fixtures.by_flags(fixtures.VIEWS[view]) and "MIN(l_linestatus)" not in fixtures.by_flags(fixtures.VIEWS[view])
        assert sorted(map(str, spark.sql(fixtures.by_flags(fixtures.VIEWS[view])).collect())) == sorted(map(str, spark.sql(fixtures.VIEWS[view]).collect()))


def test_shape_of_plain_reads_is_that_of_their_cigar(spark):
    lengths = [None, -3, 0, 4, 70]
    rows = [(i, a, b, c, 20) for i, (a, b, c) in enumerate((a, b, c) for a in lengths for b in lengths for c in lengths)]
    reads = R.with_cigar(spark.createDataFrame(rows, "read_id long, clip_left long, match_len long, clip_right long, avg_qual int"))
    for row in reads.select("shape", R.shape_of(F.col("cigar")).alias("expected"), "cigar").collect():
        assert row["shape"] == row["expected"], row


def test_reads_that_say_nothing_stay_out_of_the_join(spark, sf_dir, monkeypatch):
    """What meets the windows: reads without a clip and those whose clip names a place, under their type; the cigar is not gone through again."""
    seen = []

    def join(a, b, **how):
        seen.append((b, how))
        return overlap_join(a, b, **how)

    overlap_join = softclip.overlap_join
    monkeypatch.setattr(softclip, "overlap_join", join)
    t = fixtures.Inputs(spark, sf_dir)
    reads = plans.kept_reads(t)
    found = plans.supported(t)
    assert found.count() > 0
    (near, how), good = seen[0], reads.where(R.good_read(neighbour=True) & (R.infer_svtype() != "NONE"))
    assert how["on"] == ["want"] and "cigar" not in plan(near) and "lambda" not in plan(near)
    assert 0 < near.count() < good.count()


def test_reads_are_grouped_once_for_a_query(spark, sf_dir):
    t = fixtures.Inputs(spark, sf_dir)
    assert "l_orderkey" not in plan(plans.supported(t)) and "l_orderkey" not in plan(plans.features(t))
    assert len(t._kept) == 1 and os.listdir(t._kept["reads"].inputFiles()[0].removeprefix("file://").rsplit("/", 1)[0])
