"""Chat formatting: cumulative snapshots of a conversation collapse into the longest.

Logs often hold a conversation again after every turn. Each turn's prefix gets a rolling
hash; a conversation whose whole hash is the hash of a proper prefix of a longer one is a
snapshot and goes, by an anti-join; of equal ones the smallest conv_id stays. What is left is
rendered with one marked block per turn.

Column expressions only. Prefixes are counted once each before the anti-join, so a first
turn that a third of the logs share is one row of it.

Cases: a null role renders as "unknown" and a null text as empty, but both differ from such
strings when compared; turns order by turn (null last), then role and text; repeated rows
count once; rows of a null conv_id are one conversation; a very long text is hashed and rendered
whole; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import table


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """Each turn with its `place` in the conversation, the conversation's `n_turns`, and the hash of the turns so far (two words)."""
    turns = turns.select("conv_id", "turn", "role", "text").distinct()
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    placed = turns.withColumn("place", F.row_number().over(order)).withColumn("n_turns", F.count("*").over(W.partitionBy("conv_id")))
    so_far = W.partitionBy("conv_id").orderBy("place").rowsBetween(W.unboundedPreceding, 0)
    one = lambda seed: F.xxhash64(F.col("place"), F.col("role").isNull(), "role", F.col("text").isNull(), "text", F.lit(seed))
    return placed.withColumns({"hash_a": F.bit_xor(one(1)).over(so_far), "hash_b": F.bit_xor(one(2)).over(so_far)})


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """`conv_id, n_turns, n_copies` of the conversations that no longer one begins with."""
    hashed = prefix_hashes(turns).select("conv_id", "place", "n_turns", "hash_a", "hash_b")
    key = ["place", "hash_a", "hash_b"]
    whole = hashed.where("place = n_turns").groupBy(key).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_copies"))
    begun = hashed.where("place < n_turns").groupBy(key).agg(F.lit(1).alias("one")).select(key)
    return whole.join(begun, key, "left_anti").select("conv_id", F.col("place").cast("long").alias("n_turns"), "n_copies")


def rendered(turns: Column) -> Column:
    """A conversation's text from its array<struct<place, role, text>>."""
    return F.array_join(F.transform(F.array_sort(turns), lambda t: F.concat(F.lit("<|"), F.coalesce(t["role"], F.lit("unknown")), F.lit("|>\n"), F.coalesce(t["text"], F.lit("")), F.lit("<|end|>"))), "\n")


def format_chats(turns: DataFrame) -> DataFrame:
    kept = maximal_conversations(turns)
    order = W.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_first(), F.col("text").asc_nulls_first())
    placed = turns.select("conv_id", "turn", "role", "text").distinct().withColumn("place", F.row_number().over(order))
    chats = placed.groupBy("conv_id").agg(rendered(F.collect_list(F.struct("place", "role", "text"))).alias("chat"))
    same = chats["conv_id"].eqNullSafe(kept["conv_id"])
    return kept.join(chats, same).select(kept["conv_id"], "n_turns", "n_copies", "chat")


def op5_format_chats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(table(spark, sf_dir, "conversations"))


#: Prefixes as whole strings; a unit separator between role and text, a record separator after each turn.
OP5_SQL = """
WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
p AS (
  SELECT conv_id, role, text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS LAST, role NULLS FIRST, text NULLS FIRST) AS place,
         count(*) OVER (PARTITION BY conv_id) AS n_turns
  FROM t
),
h AS (
  SELECT conv_id, place, n_turns,
         string_agg(md5(coalesce('r' || role, '') || chr(31) || coalesce('t' || text, '')), ',') OVER (PARTITION BY conv_id ORDER BY place ROWS UNBOUNDED PRECEDING) AS prefix
  FROM p
),
whole AS (SELECT n_turns, prefix, min(conv_id) AS conv_id, count(*) AS n_copies FROM h WHERE place = n_turns GROUP BY n_turns, prefix),
begun AS (SELECT DISTINCT prefix FROM h WHERE place < n_turns),
kept AS (SELECT * FROM whole WHERE prefix NOT IN (SELECT prefix FROM begun)),
chats AS (SELECT conv_id, string_agg('<|' || coalesce(role, 'unknown') || '|>' || chr(10) || coalesce(text, '') || '<|end|>', chr(10) ORDER BY place) AS chat FROM p GROUP BY conv_id)
SELECT kept.conv_id, kept.n_turns, kept.n_copies, chats.chat
FROM kept JOIN chats ON kept.conv_id IS NOT DISTINCT FROM chats.conv_id
"""
