"""What the operators share: reading tables, and cutting lineage in a shared folder."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import kept, settled, shared_folder  # noqa: F401

#: A word, as a pattern of Java, DuckDB and Python.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def numbered(df: DataFrame, *order: str, running: str | None = None) -> DataFrame:
    """`df`, range-sorted, with `nr`, the rows' numbers in the given order, from 0; no task holds all rows.

    running: a column whose sum over all rows before is added as `before`.
    """
    held = settled(df.orderBy(*order)).withColumn("_id", F.monotonically_increasing_id())
    held = held.withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_row": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sums = held.groupBy("_part").agg(F.count("*").alias("_n"), F.sum(F.col(running) if running else F.lit(0)).alias("_sum"))  # a row for each partition
    earlier = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    starts = sums.select("_part", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_start") for c in ("_n", "_sum")])
    out = held.join(F.broadcast(starts), "_part").withColumn("nr", F.col("_n_start") + F.col("_row"))
    if running:
        within = W.partitionBy("_part").orderBy("_row").rowsBetween(W.unboundedPreceding, -1)
        out = out.withColumn("before", F.col("_sum_start") + F.coalesce(F.sum(running).over(within), F.lit(0)))
    return out.drop("_id", "_part", "_row", "_n_start", "_sum_start")


def n_words(text: Column) -> Column:
    """How many words a text has; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def unit(*keys: Column, seed: int = 0) -> Column:
    """A number from 0 to 1 that depends on the keys and the seed alone."""
    return F.pmod(F.xxhash64(*keys, F.lit(seed)), F.lit(1 << 52)).cast("double") / F.lit(float(1 << 52))
