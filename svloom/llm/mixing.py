"""Mixing sources to target weights by weighted fair queueing.

Each source is a flow. Its documents stand in a shuffled queue, up to `max_epochs` times
over; a copy's virtual finish time is the source's tokens up to and with it, divided by
the source's share. All copies are range-sorted by that time and served in this order until
the budget of all tokens is used up, which a running total over the sorted partitions tells.
A copy during which its source comes to its share is served in two parts, so every source
comes to its share whatever the lengths of its documents.

Cases: null text or one without words has size 0 and takes nothing; a null source is a
source of its own, the last; rows of a null doc_id and repeated rows each stand in the queue,
in `mix_stage` equal rows come back as one with their copies added up; a very long text is one
document of that size; an empty table gives no rows; other columns are ignored, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import n_words, numbered, settled, table, unit

#: Steps of a queue's order that are summed before the running sum, for each source.
STEPS = 4096


def source_targets(totals: DataFrame, weights: Sequence[float], max_epochs: int, budget_share: float = 1.0) -> DataFrame:
    """What each source should give: `flow, source, source_size` with `target` added.

    Sources in the order of their names, null last, weigh `weights`, over and over. They share
    budget_share of all sizes by weight; none gives more than max_epochs times its size, and
    what is left over goes to the others by weight (water filling, by running sums over one
    row per source).
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    ranked = totals.withColumn("weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int")))
    ranked = ranked.withColumn("most", F.col("source_size") * float(max_epochs)).withColumn("full_at", F.col("most") / F.col("weight"))
    every = W.partitionBy()
    filling = W.orderBy("full_at", F.col("source").asc_nulls_last()).rowsBetween(W.unboundedPreceding, -1)
    level = (F.sum("source_size").over(every) * budget_share - F.coalesce(F.sum("most").over(filling), F.lit(0.0))) / (F.sum("weight").over(every) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    ranked = ranked.withColumn("level", level)
    at = F.max(F.when(F.col("full_at") > F.col("level"), F.col("level"))).over(every)
    return ranked.withColumn("target", F.when(F.col("full_at") <= F.col("level"), F.col("most")).otherwise(at * F.col("weight"))).select("flow", "source", "source_size", "target")


def fair_queue(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), max_epochs: int = 3, budget_share: float = 1.0, seed: int = 20240611) -> DataFrame:
    """`sizes` (with at least doc_id, source, size) with row_nr, source_size, target, virtual_finish, copies, taken added.

    virtual_finish is that of a document's first copy, copies how many are served, taken
    the tokens of them. Documents that the budget does not reach have taken 0.

    A queue's running sum is taken in two steps, so that a source that holds a third of all
    rows is not one task's work: sums of STEPS slices of each queue, then inside a slice.
    """
    queued = settled(
        sizes.withColumns(
            {
                "size": F.col("size").cast("long"),
                "flow": F.coalesce(F.concat(F.lit("="), "source"), F.lit("")),
                "turn": unit(F.col("doc_id"), F.col("source"), seed=seed),
                "row_nr": F.monotonically_increasing_id(),
            }
        ).withColumn("step", F.floor(F.col("turn") * STEPS).cast("int"))
    )
    steps = queued.groupBy("flow", "source", "step").agg(F.sum("size").alias("step_size"))
    totals = steps.groupBy("flow", "source").agg(F.sum("step_size").alias("source_size"))
    targets = source_targets(totals, weights, max_epochs, budget_share).drop("source")
    before = W.partitionBy("flow").orderBy("step").rowsBetween(W.unboundedPreceding, -1)
    starts = steps.select("flow", "step", F.coalesce(F.sum("step_size").over(before), F.lit(0)).alias("step_start")).join(targets, "flow")
    inside = W.partitionBy("flow", "step").orderBy("turn", "doc_id", "size", "row_nr").rowsBetween(W.unboundedPreceding, 0)
    placed = queued.join(starts, ["flow", "step"]).withColumn("through", F.col("step_start") + F.sum("size").over(inside))
    placed = settled(placed.withColumn("virtual_finish", F.when(F.col("target") > 0, F.col("through") / F.col("target")).otherwise(F.lit(float("inf")))).drop("flow", "turn", "step", "step_start"))
    budget = F.lit(placed.agg(F.sum("size")).first()[0] or 0) * budget_share
    taken = served(placed, max_epochs, budget)
    return placed.drop("through").join(taken, "row_nr", "left").fillna(0, ["copies", "taken"])


def served(placed: DataFrame, max_epochs: int, budget: Column) -> DataFrame:
    """`row_nr, size, source_size, target, through` to `row_nr, copies, taken` of what is served before the budget ends."""
    copy = F.struct("epoch", (F.col("through") + F.col("epoch") * F.col("source_size")).alias("end"))
    copies = placed.where("size > 0 and target > 0").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.lit(max_epochs - 1)))).withColumn("c", copy)
    share, begin, end = F.round("target").cast("long"), F.col("c.end") - F.col("size"), F.col("c.end")
    part = lambda low, high: F.struct(F.col("c.epoch").alias("epoch"), low.alias("low"), high.alias("high"))
    parts = F.when((begin < share) & (share < end), F.array(part(begin, share), part(share, end))).otherwise(F.array(part(begin, end)))
    parts = copies.select("row_nr", "target", F.explode(parts).alias("p")).select("row_nr", "p.epoch", F.round(F.col("p.high") / F.col("target"), 9).alias("finish"), (F.col("p.high") - F.col("p.low")).alias("words"))
    # Parts of one virtual time go by their length, the remnants of rounded shares last.
    line = numbered(parts, "finish", "words", "row_nr", "epoch", running="words")
    taken = F.greatest(F.lit(0), F.least(F.col("words"), F.floor(budget + 0.5).cast("long") - F.col("before")))
    got = line.select("row_nr", "epoch", taken.alias("taken")).where("taken > 0")
    return got.groupBy("row_nr").agg(F.count_distinct("epoch").alias("copies"), F.sum("taken").alias("taken"))


def mixed_copies(docs: DataFrame, **options: object) -> DataFrame:
    """One row for each served copy: the columns of `docs`, `epoch` and the copy's `words`, by virtual finish time."""
    mix = with_mix(docs.select("doc_id", "text", "lang", "source", "n_chars"), **options)
    copies = mix.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("copies").cast("int") - 1))).withColumn("words", F.least(F.col("size"), F.col("taken") - F.col("size") * F.col("epoch")))
    finish = F.col("virtual_finish") + F.col("epoch") * F.col("source_size") / F.col("target")
    return copies.orderBy(finish, "doc_id").select("doc_id", "text", "lang", "source", "n_chars", "epoch", "words")


def with_mix(docs: DataFrame, **options: object) -> DataFrame:
    """The documents that the mix takes, equal rows as one, with size, source_size, target, virtual_finish, copies and taken.

    Texts meet what is taken of them by a hash of the row.
    """
    keyed = docs.withColumn("row_key", F.xxhash64(*docs.columns))
    mix = fair_queue(keyed.select("row_key", "doc_id", "source", n_words(F.col("text")).alias("size")), **options).where("taken > 0")
    first = ("size", "source_size", "target")
    mix = mix.groupBy("row_key").agg(*[F.first(c).alias(c) for c in first], F.min("virtual_finish").alias("virtual_finish"), F.sum("copies").alias("copies"), F.sum("taken").alias("taken"))
    return keyed.join(mix, "row_key").dropDuplicates(["row_key"]).drop("row_key")


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mix = fair_queue(docs.select("doc_id", "source", n_words(F.col("text")).alias("size")))
    return mix.select("doc_id", "size", "source_size", "target", "taken", "virtual_finish", "copies")


def mix_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how many of their words it takes and when."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return with_mix(docs).drop("size", "source_size", "target")
