"""Filters and small projections of calls."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from .intervals import contained_in, overlap_join


def standard_contigs(prefix: str = "") -> list[str]:
    return [prefix + c for c in [*map(str, range(1, 23)), "X", "Y", "MT"]]


def on_contigs(calls: DataFrame, contigs: DataFrame, chosen: Sequence[str] | None = None, standard: bool = False) -> DataFrame:
    """Calls on contigs of the reference, on the chosen ones, and on standard ones if asked."""
    if chosen is not None:
        contigs = contigs.where(F.col("chrom").isin(*chosen))
    if standard:
        contigs = contigs.where(F.col("chrom").isin(*standard_contigs(), *standard_contigs("chr")))
    return calls.join(contigs.select("chrom"), "chrom", "left_semi")


def reported_types(calls: DataFrame, types: Sequence[str]) -> DataFrame:
    """Calls of the wanted types that the caller's own format can report."""
    native = reduce(lambda c, s: c.when(F.col("source") == s, F.col("sv_type").isin(*C.CALLER_TYPES[s])), list(C.CALLER_TYPES)[1:], F.when(F.col("source") == list(C.CALLER_TYPES)[0], F.col("sv_type").isin(*C.CALLER_TYPES[list(C.CALLER_TYPES)[0]])))
    return calls.where(F.col("sv_type").isin(*types) & native.otherwise(F.lit(True)))


def is_translocation() -> Column:
    return F.col("sv_type").isin(*C.TRANSLOCATIONS)


def long_enough(calls: DataFrame, least: int = C.MIN_SV_LENGTH) -> DataFrame:
    return calls.where((F.col("sv_len") >= least) | is_translocation())


def length_between(calls: DataFrame, least: int = C.MIN_SV_LENGTH, most: int = C.MAX_SV_LENGTH) -> DataFrame:
    return calls.where(F.col("sv_len").between(least, most) | is_translocation())


def without_short_inversions(calls: DataFrame, read_length: int = C.READ_LENGTH, isize_sd: int = C.ISIZE_SD) -> DataFrame:
    """Without BreakDancer inversions below a read length and four deviations of the insert size."""
    artefact = (F.col("source") == "BreakDancer") & (F.col("sv_type") == "INV") & (F.abs("sv_len") < read_length + 4 * isize_sd)
    return calls.where(~artefact)


def passing(calls: DataFrame) -> DataFrame:
    """Without calls that their caller's filter failed, for the callers whose filter counts."""
    return calls.where(~F.col("source").isin(*C.FILTERED_CALLERS) | (F.col("filter") == "PASS"))


def wiggle_of(wiggle: int = C.WIGGLE, ins_wiggle: int = C.INS_WIGGLE, tx_wiggle: int = C.TX_WIGGLE) -> Column:
    other = F.greatest(F.when(F.col("sv_type") == "INS", ins_wiggle).otherwise(0), F.lit(wiggle))
    return F.when(is_translocation(), tx_wiggle).otherwise(other)


def outside_gaps(calls: DataFrame, gaps: DataFrame, pad: int | Column = 0) -> DataFrame:
    """Calls that overlap no gap. Gaps are joined by bins, so a long track needs no broadcast."""
    hit = overlap_join(calls, gaps.select("chrom", "start_pos", "end_pos"), pad).select("call_id").distinct()
    return calls.join(hit, "call_id", "left_anti")


def inside_contigs(calls: DataFrame, contigs: DataFrame, pad: int = C.WIGGLE) -> DataFrame:
    return contained_in(calls, contigs.select("chrom", "length"), pad)


def gap_build(contigs: DataFrame, plain: DataFrame, prefixed: DataFrame) -> DataFrame:
    """The gap track whose contig names are the reference's: names with a chr prefix, or without."""
    has = contigs.agg(F.max(F.col("chrom").startswith("chr")).alias("chr"))
    tagged = prefixed.withColumn("_chr", F.lit(True)).unionByName(plain.withColumn("_chr", F.lit(False)))
    return tagged.join(F.broadcast(has), F.col("_chr") == F.coalesce(F.col("chr"), F.lit(False)), "left_semi").drop("_chr")


def fixed_position(calls: DataFrame) -> DataFrame:
    """Insertions become points: precise ones at the middle, others at their start."""
    middle = F.floor((F.col("start_pos") + F.col("end_pos")) / 2)
    at = F.when(F.col("is_precise"), middle).otherwise(F.col("start_pos"))
    ins = F.col("sv_type") == "INS"
    return calls.withColumns({"start_pos": F.when(ins, at).otherwise(F.col("start_pos")).cast("long"), "end_pos": F.when(ins, at).otherwise(F.col("end_pos")).cast("long")})


def method_map() -> Column:
    return F.create_map(*[x for k, v in C.METHODS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))])


def methods_of(sources: Column) -> Column:
    """The sorted methods of an array of callers."""
    return F.array_sort(F.array_distinct(F.flatten(F.transform(sources, lambda s: F.coalesce(method_map()[s], F.array().cast("array<string>"))))))


def is_precise_source(source: Column) -> Column:
    return source.isin(*C.PRECISE_CALLERS)


def caller_rank(source: Column) -> Column:
    """The caller's place in the order of trust, from 1; 0 for others."""
    return F.array_position(F.array(*map(F.lit, C.CALLERS)), source)
