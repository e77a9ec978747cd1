"""Types merge in one pass over the intervals, as they do one by one."""

import random

from pyspark.sql import functions as F

from svloom.operators import merge


def by_type(rows, pad):
    """Chains and insertions cut on their own."""
    chains = merge.reciprocal_chains(rows.where("sv_type <> 'INS'").withColumnRenamed("id", "call_id"), ["sv_type", "chrom"])
    ins = merge.merge_by_distance(rows.where("sv_type = 'INS'"), ["sv_type", "chrom"], "id", pad)
    return [*map(list, chains.collect()), *[[r["sv_type"], r["chrom"], r["s"], r["e"], sorted(r["ids"])] for r in ins.groupBy("sv_type", "chrom", "island").agg(F.min("start_pos").alias("s"), F.max("end_pos").alias("e"), F.collect_list("id").alias("ids")).collect()]]


def test_one_pass_gives_what_each_type_gives(spark, monkeypatch):
    rng = random.Random(7)
    rows = [(i, rng.choice(["INS", "DEL", "INV", None]), rng.choice("12"), s, s + rng.choice([0, 1, 30, 50, 400])) for i in range(600) for s in [rng.choice([rng.randrange(3_000), 1 << 20, (1 << 20) - rng.randrange(60), rng.randrange(5_000_000)])]]
    df = spark.createDataFrame(rows, "id long, sv_type string, chrom string, start_pos long, end_pos long")
    expected = sorted(map(str, by_type(df, 50)))
    settled, folded = [], []
    whole, fold = merge.lone_and_islands, merge._chains
    monkeypatch.setattr(merge, "lone_and_islands", lambda *a, **k: settled.append(1) or whole(*a, **k))
    monkeypatch.setattr(merge, "_chains", lambda marked, *a: folded.append(marked.count()) or fold(marked, *a))
    found = [list(r) for r in merge.merge_per_type(df, pad=50).collect()]
    assert sorted(map(str, found)) == expected
    assert len(settled) == 1 and 0 < folded[0] < df.where("sv_type <> 'INS'").count()


def test_an_id_may_carry_more_of_a_member(spark):
    df = spark.createDataFrame([("b", "DEL", "1", 0, 100, "y"), ("a", "DEL", "1", 0, 100, "x"), ("c", "INS", "1", 0, 100, "x"), ("d", "INS", "1", 10, 100, "x"), ("e", "DEL", "1", 900, 999, "z")], "id string, sv_type string, chrom string, start_pos long, end_pos long, source string")
    found = merge.merge_per_type(df.withColumn("id", F.struct("id", "source")), pad=50).select("sv_type", "ids.id", "ids.source").collect()
    assert sorted(map(tuple, found)) == [("DEL", ["a", "b"], ["x", "y"]), ("DEL", ["e"], ["z"]), ("INS", ["c", "d"], ["x", "x"])]
