"""The SQL of merges and islands states the queries' rules whatever the size: as many rounds as it takes, and ties that share their island."""

import random

import duckdb
from pyspark.sql import functions as F

from svloom.operators import merge
from svloom.operators.intervals import islands, lone_and_islands
from svloom.plans.calls import LEVEL2_SQL, islands_sql

CALLS = "call_id long, chrom string, chrom2 string, start_pos long, end_pos long, sv_type string, sv_len long, source string"


def test_nine_callers_nested_in_one_another_take_as_many_rounds(spark):
    rows = [(i, "1", "1", 100_000, 100_000 + 200 * 3**i, "DEL", 60, f"T{i}") for i in range(9)]
    rows += [(i + 20, "2", "2", 1_000_000 - 200 * 3**i, 1_000_000 + 150 * 3 ** (i // 2), "DUP", 60, f"T{i}") for i in range(9)]
    con = duckdb.connect()
    con.sql(f"CREATE TABLE calls ({CALLS.replace('string', 'varchar').replace('long', 'bigint')})")
    con.executemany("INSERT INTO calls VALUES (?, ?, ?, ?, ?, ?, ?, ?)", rows)
    links = con.sql(f"WITH RECURSIVE {LEVEL2_SQL} SELECT l1_id, l2_id FROM links").df()
    assert con.sql(f"WITH RECURSIVE {LEVEL2_SQL} SELECT max(length(path)) FROM lv").df().iloc[0, 0] > 5
    level1 = merge.settled(merge.level1_of(spark.createDataFrame(rows, CALLS).withColumn("wiggle", F.lit(100))))
    assert sorted(zip(links["l1_id"], links["l2_id"], strict=True)) == sorted(map(tuple, merge.merge_inter(level1).collect()))


def test_equal_rows_are_of_one_island_in_any_order():
    con = duckdb.connect()
    con.sql("CREATE TABLE t AS SELECT i % 8 AS chrom, (i % 20000) * 450 AS s, (i % 20000) * 450 + 100 + i % 200 AS e FROM range(900000) x(i)")
    bounds = lambda source: con.sql("WITH " + islands_sql(source, "i", "chrom", "s, e", "s", "e") + " SELECT chrom, min(s) AS s, max(e) AS e FROM i GROUP BY chrom, island ORDER BY ALL").df()
    assert bounds("t").equals(bounds("(SELECT DISTINCT * FROM t)"))


def test_lone_rows_are_neither_numbered_nor_joined(spark):
    rng = random.Random(11)
    rows = [(i, rng.choice("12"), s, s + rng.choice([0, 30, 900])) for i, s in enumerate(rng.randrange(200_000) for _ in range(300))]
    df = spark.createDataFrame(rows, "call_id long, chrom string, start_pos long, end_pos long")
    given = (["chrom"], ["start_pos", "end_pos", "call_id"], F.col("start_pos") - 5, F.col("end_pos") + 5)
    ids = lambda d: {r["call_id"] for r in d.collect()}
    whole = islands(df, *given).groupBy("chrom", "island").agg(F.collect_list("call_id").alias("ids")).collect()
    for block in (700, 1 << 20):
        lone, others = lone_and_islands(df, *given, block=block, slack=50)
        assert ids(lone) | ids(others) == set(range(300)) and not ids(lone) & ids(others)
        assert ids(lone) <= {r["ids"][0] for r in whole if len(r["ids"]) == 1} and (block == 700 or len(ids(lone)) > 50)
        met = others.groupBy("chrom", "island").agg(F.collect_list("call_id").alias("ids")).collect()
        assert {frozenset(r["ids"]) for r in met if len(r["ids"]) > 1} == {frozenset(r["ids"]) for r in whole if len(r["ids"]) > 1}
    plan = lone._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
