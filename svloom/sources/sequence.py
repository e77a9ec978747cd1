"""Reference sequence as rows of fixed chunks, so that a base is found by an equi-join on its chunk."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CHUNK = 10_000


def chunked(lines: DataFrame, size: int = CHUNK) -> DataFrame:
    """`chrom, at, seq` (pieces of any length, each with the place of its first base, from 0) to `chrom, chunk, seq` rows of `size` bases.

    Where no piece gives a base, the chunk has N; its last base given ends it. A piece is cut where chunks
    end, so work follows the sequence's length and no contig is one row.
    """
    end = F.col("at") + F.length("seq")
    parts = lines.where(F.length("seq") > 0).withColumn("chunk", F.explode(F.sequence(F.floor(F.col("at") / size), F.floor((end - 1) / size))))
    begin = F.greatest(F.col("at"), F.col("chunk") * size)
    part = F.struct((begin - F.col("chunk") * size).alias("at"), F.substring(F.col("seq"), (begin - F.col("at") + 1).cast("int"), (F.least(end, (F.col("chunk") + 1) * size) - begin).cast("int")).alias("seq"))
    rows = parts.select("chrom", "chunk", part.alias("p")).groupBy("chrom", "chunk").agg(F.array_sort(F.collect_list("p")).alias("parts"))
    joined = F.aggregate("parts", F.lit(""), lambda a, x: F.concat(F.rpad(a, x["at"].cast("int"), F.lit("N")), x["seq"]))
    return rows.select("chrom", "chunk", joined.alias("seq"))


def with_base(rows: DataFrame, sequence: DataFrame, at: Column, size: int = CHUNK, name: str = "ref_base") -> DataFrame:
    """`rows` with the base at a place (from 0) of their chrom; N where the sequence lacks it."""
    chunks = sequence.select(F.col("chrom").alias("_chrom"), F.col("chunk").alias("_chunk"), F.col("seq").alias("_seq"))
    place = F.greatest(at, F.lit(0))
    met = rows.withColumn("_at", place).join(chunks, (F.col("chrom") == F.col("_chrom")) & (F.floor(F.col("_at") / size) == F.col("_chunk")), "left")
    base = F.substring(F.col("_seq"), (F.col("_at") % size + 1).cast("int"), F.lit(1))
    return met.withColumn(name, F.when(F.length(base) == 1, base).otherwise(F.lit("N"))).drop("_chrom", "_chunk", "_seq", "_at")


def with_reference(calls: DataFrame, sequence: DataFrame, size: int = CHUNK) -> DataFrame:
    """Calls with `ref_base`, the base at their start (from 1)."""
    return with_base(calls, sequence, F.col("start_pos") - 1, size)
