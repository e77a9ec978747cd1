"""Aligned reads in a clustered layout: a folder for each chromosome and stretch of blocks of coordinates, sorted within.

Regions then open the stretches that they touch and no others, and of these read the pages of their blocks. A dense stretch is
written by several tasks, as several files. Folders are listed whenever a layout is opened, so a block has none of its own.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sweeps import BLOCK

#: Blocks that a list of regions names one by one; a genome of 3 billion bases has 3,000 of the default size.
MOST_BLOCKS = 10_000
#: Blocks of a folder.
STRETCH = 64


def write_clustered(reads: DataFrame, path: str, block: int = BLOCK) -> None:
    """`chrom, pos, ..` and `block`, that of `pos`, under `chrom=../stretch=..`."""
    rows = reads.withColumn("block", F.floor(F.col("pos") / block)).withColumn("stretch", F.floor(F.col("block") / STRETCH))
    rows.repartitionByRange("chrom", "stretch", "pos").sortWithinPartitions("chrom", "stretch", "pos").write.mode("overwrite").partitionBy("chrom", "stretch").parquet(path)


def read_clustered(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """schema: that of the reads, `chrom` included, so that the folders' names keep its type and no file is opened to learn it."""
    return spark.read.schema(f"{schema}, block long, stretch long").parquet(path)


def touching(layout: DataFrame, windows: DataFrame, longest: int, block: int = BLOCK) -> DataFrame:
    """The layout's rows of blocks in which a read may touch a window `chrom, start_pos, end_pos`; reads are at most `longest` on the reference.

    The windows' blocks, a row each, are named in a predicate, with their stretches, which are partition columns. Where there are
    too many to name, they are joined instead, and all files are opened.
    """
    first, last = F.floor((F.col("start_pos") - longest) / block), F.floor((F.col("end_pos") - 1) / block)
    blocks = windows.where("start_pos < end_pos").select("chrom", F.explode(F.sequence(first, last)).alias("block")).distinct()
    named = blocks.limit(MOST_BLOCKS + 1).collect()
    if len(named) > MOST_BLOCKS:
        return layout.join(blocks, ["chrom", "block"], "left_semi")
    of: dict[str, list[int]] = {}
    for row in named:
        of.setdefault(row["chrom"], []).append(row["block"])
    stretches = lambda numbers: sorted({n // STRETCH for n in numbers})
    wanted = [(F.col("chrom") == chrom) & F.col("stretch").isin(stretches(numbers)) & F.col("block").isin(sorted(numbers)) for chrom, numbers in sorted(of.items()) if chrom is not None]
    return layout.where(reduce(lambda a, b: a | b, wanted, F.lit(False)))
