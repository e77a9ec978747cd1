"""Read evidence for calls: genotyping, read pairs, assembly routing, and feature tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..session import kept, settled
from .intervals import islands, overlap_join
from .sweeps import bin_counts, overlap_counts, point_sums

PRECISE_METHODS = ("AS", "SR", "JM")


def as_intervals(reads: DataFrame, *columns: str | Column) -> DataFrame:
    return reads.select("chrom", F.col("pos").alias("start_pos"), F.col("aend").alias("end_pos"), *columns)


# Genotypes


def genotype_counts(calls: DataFrame, reads: DataFrame, window: int = C.GT_WINDOW, isize: tuple[float, float] = (C.ISIZE_MEAN - 3 * C.ISIZE_SD, C.ISIZE_MEAN + 3 * C.ISIZE_SD), around: int = 20) -> DataFrame:
    """`call_id, total, normal`: reads near the breakpoints, and those of normal pairs that span one.

    Insertions have one breakpoint, others two. Reads without a mate don't count. Calls without
    reads count 0.
    """
    points = F.when(F.col("sv_type") == "INS", F.array("start_pos")).otherwise(F.array("start_pos", "end_pos"))
    at = calls.select("call_id", "chrom", F.explode(points).alias("point"))
    span = lambda kind, low, high: F.struct(F.lit(kind).alias("kind"), low.alias("start_pos"), high.alias("end_pos"))
    windows = at.select("call_id", "chrom", F.inline(F.array(span("near", F.greatest(F.lit(0), F.col("point") - window), F.col("point") + window), span("spans", F.col("point"), F.col("point") + 1))))
    seen = reads.where(F.col("is_paired") & ~F.col("is_duplicate") & (F.col("pos") < F.col("aend")))
    inward = F.when(F.col("is_reverse"), (F.col("mate_pos") < F.col("pos")) & ~F.col("mate_is_reverse")).otherwise((F.col("mate_pos") > F.col("pos")) & F.col("mate_is_reverse"))
    normal = ~F.col("is_unmapped") & ~F.col("mate_is_unmapped") & (F.col("mate_chrom") == F.col("chrom")) & inward & F.abs("tlen").between(*isize)
    # A read spans the points that lie `around` inside of its ends.
    places = F.array_append(F.array(span("near", F.col("pos"), F.col("aend"))), F.when(normal, span("spans", F.col("pos") + around, F.col("aend") - around + 1)))
    counts = overlap_counts(windows, seen.select("chrom", F.inline(F.array_compact(places))), ["call_id", "kind"], on=["kind"])
    n = lambda kind: F.sum(F.when(F.col("kind") == kind, F.col("n")).otherwise(0))
    counts = counts.groupBy("call_id").agg(n("near").alias("total"), n("spans").alias("normal"))
    return calls.select("call_id").join(counts, "call_id", "left").select("call_id", F.coalesce("total", F.lit(0)).alias("total"), F.coalesce("normal", F.lit(0)).alias("normal"))


def genotype_of(normal: Column, total: Column, threshold: float = C.GT_FRAC) -> Column:
    share = normal / F.greatest(F.lit(1), total)
    return F.when(share >= 1 - threshold, "0/0").when(share >= threshold, "0/1").otherwise("1/1")


def genotype_coordinates(calls: DataFrame) -> DataFrame:
    """Calls with coordinates of assembly (or of soft clips, for insertions) where a method says so; deletions' lengths are negative.

    `methods` is an array; bp1, bp2 and bp_len are the refined values.
    """
    use = F.array_contains("methods", "AS") | ((F.col("sv_type") == "INS") & F.array_contains("methods", "SC"))
    length = F.when(use & (F.col("bp_len") >= 0), F.col("bp_len")).otherwise(F.col("sv_len"))
    return calls.withColumns({"start_pos": F.when(use, F.col("bp1")).otherwise(F.col("start_pos")), "end_pos": F.when(use, F.col("bp2")).otherwise(F.col("end_pos")), "sv_len": F.when(F.col("sv_type") == "DEL", -length).otherwise(length)})


# Read pairs


def pair_windows(calls: DataFrame, pad: int = C.SC_PAD, longest: int = 10_000, flank: int = 4_000) -> DataFrame:
    """The windows whose reads are taken: the call with `pad`, or its two flanks if it is long and no insertion.

    Calls too near the chromosome's start go.
    """
    low, high = F.col("start_pos") - pad, F.col("end_pos") + pad
    split = (high - low > longest) & F.col("sv_type").isin("INV", "DEL", "DUP")
    one = lambda a, b: F.struct(a.alias("start_pos"), b.alias("end_pos"))
    parts = F.when(split, F.array(one(low, low + pad + flank - 1), one(high - pad - flank + 1, high))).otherwise(F.array(one(low, high)))
    return calls.where(low >= 0).select("call_id", "chrom", F.explode(parts).alias("w"), low.alias("low"), high.alias("high")).select("call_id", "chrom", "w.*", "low", "high")


def reads_of(windows: DataFrame, reads: DataFrame) -> DataFrame:
    """Each window's call with the names of the fragments that touch it, once each; dealt by call, as `within_cap` counts them."""
    met = overlap_join(windows, as_intervals(reads, "qname"), prefix="r_").repartition("call_id")
    return met.groupBy("call_id", F.col("r_qname").alias("qname")).agg(F.first("low").alias("low"), F.first("high").alias("high"), F.first("chrom").alias("region_chrom"))


def within_cap(fragments: DataFrame, most: int = C.MAX_PAIRS) -> DataFrame:
    """Without the calls that have more than `most` fragments."""
    return fragments.withColumn("_n", F.count("*").over(W.partitionBy("call_id"))).where(F.col("_n") <= most).drop("_n")


def complete_pairs(reads: DataFrame) -> DataFrame:
    """Both reads of a fragment on one row: qname, first and second as structs. Of several of one kind the last counts."""
    return _sides(reads).drop("n_reads")


def _sides(reads: DataFrame) -> DataFrame:
    # Mates seldom lie in one file, so reads are shuffled as they are, not as half empty pairs.
    read = F.struct(*[c for c in reads.columns if c != "qname"])
    sides = reads.repartition("qname").groupBy("qname").agg(F.max_by(F.when(F.col("is_read1"), read), F.when(F.col("is_read1"), F.col("read_id"))).alias("first"), F.max_by(F.when(~F.col("is_read1"), read), F.when(~F.col("is_read1"), F.col("read_id"))).alias("second"), F.count("*").alias("n_reads"))
    return sides.where("first is not null and second is not null")


def build_pairs(calls: DataFrame, reads: DataFrame, pad: int = C.SC_PAD, most: int = C.MAX_PAIRS, few: bool = False) -> DataFrame:
    """The complete pairs of each call's windows; a mate counts wherever it lies. call_ids differ; reads are read several times.

    Reads are paired first and take their mates along to the windows, so what meets them is not shuffled any more: `_met_pairs`. Only fragments
    of more than two reads, and calls that more than `most` reads touch, are met by name and counted.

    few: the windows touch a small part of the fragments, so no others are paired: the names of these go to the scan as
    a Bloom filter, which lets a hundredth of the others pass. Else a filter would hold back little, and all are paired.
    """
    windows = pair_windows(calls, pad)
    if few:
        wanted = settled(within_cap(reads_of(windows, reads), most))
        return wanted.join(complete_pairs(named(reads, wanted, "qname")), "qname")
    windows = kept(windows, "zstd")
    crowded = _crowded(windows, reads, most)
    free = windows if crowded is None else windows.join(crowded, "call_id", "left_anti")
    out = _met_pairs(free, reads)
    odd = kept(reads.groupBy("qname").count().where("count > 2").select("qname"), "zstd")
    if not odd.isEmpty():
        several = reads.join(odd, "qname", "left_semi")
        out = out.unionByName(reads_of(free, several).join(complete_pairs(several), "qname"))
    if crowded is not None:
        wanted = within_cap(reads_of(windows.join(crowded, "call_id", "left_semi"), reads), most)
        out = out.unionByName(wanted.join(complete_pairs(reads), "qname"))
    return out


#: Bases of a bin in which reads are counted, to see whether any call can have too many.
CROWD = 1 << 14


def _crowded(windows: DataFrame, reads: DataFrame, most: int) -> DataFrame | None:
    """`call_id` of the calls that more than `most` reads touch, None if there are none. First the fullest bin tells for most calls that there can't be so many."""
    seen = as_intervals(reads).where("start_pos < end_pos")
    bins = seen.select("chrom", F.explode(F.sequence(F.floor(F.col("start_pos") / CROWD), F.floor((F.col("end_pos") - 1) / CROWD))).alias("bin")).groupBy("chrom", "bin").count()
    fullest = bins.agg(F.max("count")).first()[0] or 0
    length = F.col("end_pos") - F.col("start_pos")
    parts = F.when((length == F.col("high") - F.col("low")), 1).otherwise(2)
    maybe = windows.where((F.floor(length / CROWD) + 2) * parts * fullest > most)
    if maybe.isEmpty():
        return None
    found = kept(overlap_counts(maybe, seen, ["call_id"]).where(F.col("n") > most).select("call_id"), "zstd")
    return None if found.isEmpty() else found


def _met_pairs(windows: DataFrame, reads: DataFrame) -> DataFrame:
    """Calls with the fragments of just two reads that touch their windows, once each.

    Of the meetings of a call and a fragment that stays at which the first of the windows meets the first of the reads; a row knows both, so no rows are compared.
    """
    side = lambda i, c: F.struct(F.lit(i).alias("turn"), *[F.col(c)[x].alias(x) for x in ("chrom", "pos", "aend")])
    rows = _sides(reads).where("n_reads = 2 and qname is not null").select("qname", "first", "second", F.inline(F.array(side(0, "first"), side(1, "second"))))
    met = overlap_join(windows, as_intervals(rows, "qname", "first", "second", "turn"), prefix="r_")
    first, second = F.col("r_first"), F.col("r_second")
    touches = lambda r, low, high: F.coalesce((r["chrom"] == F.col("chrom")) & (r["pos"] < r["aend"]) & (F.greatest(r["pos"], low) < F.least(r["aend"], high)), F.lit(False))
    begin, end, low = F.col("start_pos"), F.col("end_pos"), F.col("low")
    by_first = (F.col("r_turn") == 1) & touches(first, begin, end)
    by_left = (begin != low) & (touches(first, low, low + end - begin) | touches(second, low, low + end - begin))
    return met.where(~by_first & ~by_left).select(F.col("r_qname").alias("qname"), "call_id", "low", "high", F.col("chrom").alias("region_chrom"), first.alias("first"), second.alias("second"))


#: Bits of a Bloom filter, at most: 16 MB, which the driver and every executor can hold.
BLOOM_BITS = 1 << 27
BITS_A_NAME, HASHES = 10, 6


def named(rows: DataFrame, wanted: DataFrame, name: str) -> DataFrame:
    """Rows whose `name` is among the wanted ones.

    A Bloom filter of the wanted names is built where they lie and applied where rows are scanned, so that only rows
    that pass are shuffled to the semi-join, which decides. Where there are too many names for a
    filter of bounded size, the semi-join works alone.
    """
    names = wanted.select(name).distinct()
    n = names.count()
    if 0 < n <= BLOOM_BITS // BITS_A_NAME:
        rows = rows.crossJoin(F.broadcast(_bloom(names, name, n))).where(_maybe(F.col(name), n)).drop("_bloom")
    return rows.join(names, name, "left_semi")


def _places(name: Column, n: int) -> list[Column]:
    return [F.pmod(F.xxhash64(name, F.lit(i)), F.lit(64 * _words(n))) for i in range(HASHES)]


def _words(n: int) -> int:
    return -(-BITS_A_NAME * n // 64)


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), (place % 64).cast("int"))


def _bloom(names: DataFrame, name: str, n: int) -> DataFrame:
    """One row: the filter of `n` names as an array of 64-bit words. Each task ORs its own bits first."""
    places = names.select(F.explode(F.array(*_places(F.col(name), n))).alias("at"))
    some = places.groupBy(F.floor(F.col("at") / 64).alias("id")).agg(F.bit_or(_bit(F.col("at"))).alias("word"))
    every = names.sparkSession.range(_words(n)).join(some, "id", "left").select("id", F.coalesce("word", F.lit(0).cast("long")).alias("word"))
    return every.agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "word"))), lambda x: x["word"]).alias("_bloom"))


def _maybe(name: Column, n: int) -> Column:
    """Holds for every name in the filter, and for about one in a hundred others."""
    return reduce(lambda a, b: a & b, [F.get("_bloom", F.floor(p / 64).cast("int")).bitwiseAND(_bit(p)) != 0 for p in _places(name, n)])


def selectors(max_nm: int = 5, isize: tuple[int, int] = (300, 400)) -> dict[str, Column]:
    """Which pairs to hand to an assembler, by several rules: columns over `build_pairs`, whose reads have `parts`, the number of parts of their cigar."""

    def good(side: str) -> Column:
        r = F.col(side)
        return r["is_unmapped"] | (r["mapq"] > 0) | (r["chrom"] != F.col("region_chrom")) | ~r["pos"].between(F.col("low"), F.col("high"))

    def perfect(side: str) -> Column:
        r = F.col(side)
        return ~r["is_unmapped"] & (r["parts"] == 1) & (r["nm"] <= max_nm)

    tlen = F.col("first")["tlen"]
    odd = (tlen == 0) | ~F.abs(tlen).between(*isize)
    turned = F.col("first")["is_reverse"] != F.col("second")["is_reverse"]
    hq = good("first") & good("second")
    flawed = ~(perfect("first") & perfect("second"))
    return {"all_pair": F.lit(True), "all_pair_hq": hq, "non_perfect": flawed, "non_perfect_hq": flawed & hq, "discordant": odd, "discordant_with_normal_orientation": (tlen == 0) | (turned & odd)}


def fastq_rows(reads: DataFrame) -> DataFrame:
    """`read_id, value`: four lines per read; reverse reads are complemented and turned."""
    from ..functions.reads import reverse_complement

    seq = F.when(F.col("is_reverse"), reverse_complement(F.col("seq"))).otherwise(F.col("seq"))
    qual = F.when(F.col("is_reverse"), F.reverse("qual")).otherwise(F.col("qual"))
    name = F.concat(F.lit("@"), "qname", F.lit("/"), F.when(F.col("is_read1"), "1").otherwise("2"))
    return reads.select("read_id", F.concat_ws("\n", name, seq, F.lit("+"), qual).alias("value"))


# Assembly routing


def should_assemble(max_tools: int = 1, types: tuple[str, ...] = ("DEL", "INS", "INV", "DUP")) -> Column:
    """Short enough, of a type that is assembled, with soft clips where these are needed, and in need of help."""
    longest = F.when(F.col("sv_type") == "INS", C.ASM_MAX_SIZE["INS"]).otherwise(C.ASM_MAX_SIZE_OTHER)
    has_clips = F.array_contains("methods", "SC")
    tools = F.col("n_tools") - F.when(has_clips, 1).otherwise(0)
    rest = F.array_remove("methods", "SC")
    need = (tools <= max_tools) | ~F.arrays_overlap(rest, F.array(*map(F.lit, PRECISE_METHODS)))
    return (F.col("end_pos") - F.col("start_pos") <= longest) & F.col("sv_type").isin(*types) & (~F.col("sv_type").isin("DUP", "DEL", "INS") | has_clips) & need


def skipped_breakpoints(calls: DataFrame) -> DataFrame:
    """Breakpoints of calls that are not assembled: their ends if several methods agree and one is precise, else -1."""
    sure = (F.size("methods") > 1) & F.arrays_overlap("methods", F.array(*map(F.lit, PRECISE_METHODS)))
    return calls.withColumns({"bp1": F.when(sure, F.col("start_pos")).otherwise(-1), "bp2": F.when(sure, F.col("end_pos")).otherwise(-1)})


# Feature tables


def overlap_flag(calls: DataFrame, track: DataFrame) -> DataFrame:
    hit = overlap_counts(calls, track, ["call_id"]).where("n > 0").select("call_id", F.lit(1).alias("hit"))
    return calls.select("call_id").join(hit, "call_id", "left").select("call_id", F.coalesce("hit", F.lit(0)).alias("overlaps"))


def weighted_overlap(calls: DataFrame, track: DataFrame) -> DataFrame:
    """The track's score, weighted by overlap, over the call's length."""
    met = overlap_join(calls.select("call_id", "chrom", "start_pos", "end_pos"), track).groupBy("call_id").agg(F.sum(F.col("b_score") * F.col("overlap_bp")).alias("total"))
    length = F.greatest(F.lit(1), F.col("end_pos") - F.col("start_pos"))
    return calls.join(met, "call_id", "left").select("call_id", F.coalesce(F.col("total") / length, F.lit(0.0)).alias("score"))


def coverage_bins(calls: DataFrame, reads: DataFrame, step: int = 50) -> DataFrame:
    """Reads and very good reads in each bin of a call, as lists, and their mean, least and greatest."""
    seen = reads.where("not is_duplicate").withColumn("good", F.coalesce((F.col("mapq") >= 20) & (F.col("nm") < 2) & (F.col("clip_left") + F.col("clip_right") <= 10), F.lit(False)))
    counts = bin_counts(calls, as_intervals(seen, "good"), step)
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ";")
    mean = lambda c: F.aggregate(c, F.lit(0).cast("bigint"), lambda a, x: a + x) / F.size(c)
    of = lambda c, pre="": [mean(c).alias(f"{pre}mean"), F.array_min(c).alias(f"{pre}least"), F.array_max(c).alias(f"{pre}most")]
    out = counts.select("call_id", text("n").alias("coverage"), *of("n"), text("good").alias("good_coverage"), *of("good", "good_"))
    ratio = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(1.0))
    return out.withColumns({"least_ratio": ratio("least", "mean"), "most_ratio": ratio("most", "mean"), "good_least_ratio": ratio("good_least", "good_mean"), "good_most_ratio": ratio("good_most", "good_mean")})


def truth_overlap(calls: DataFrame, truth: DataFrame) -> DataFrame:
    """The truth intervals that a call meets: position, length, offsets of both ends, and a flag; calls without any once."""
    met = overlap_join(calls.select("call_id", "chrom", "start_pos", "end_pos"), truth.select("chrom", "start_pos", "end_pos"))
    met = met.select("call_id", F.col("b_start_pos").alias("truth_start"), (F.col("b_end_pos") - F.col("b_start_pos")).alias("truth_len"), (F.col("start_pos") - F.col("b_start_pos")).alias("start_offset"), (F.col("end_pos") - F.col("b_end_pos")).alias("end_offset"))
    none = ["truth_start", "truth_len", "start_offset", "end_offset"]
    return calls.select("call_id").join(met, "call_id", "left").select("call_id", F.col("truth_start").isNotNull().alias("is_true"), *[F.coalesce(c, F.lit(-1)).alias(c) for c in none])


def library_stats(reads: DataFrame, min_mapq: int = 18, trim: float = 0.05) -> DataFrame:
    """Mean coverage of covered places and, of the middle insert sizes, mean and deviation; one row.

    Sizes are counted first, so what is ranked is a row per size, not per read. Covered places are
    those of the islands that reads form.
    """
    good = reads.where(F.col("mapq") >= min_mapq)
    sizes = good.groupBy(F.abs("tlen").alias("size")).agg(F.count("*").alias("n"))
    w = W.orderBy("size")
    ranked = sizes.withColumns({"through": F.sum("n").over(w.rowsBetween(W.unboundedPreceding, 0)), "all": F.sum("n").over(W.partitionBy())})
    low, high = F.floor(F.col("all") * trim), F.ceil(F.col("all") * (1 - trim))
    kept = ranked.withColumn("k", F.greatest(F.lit(0), F.least("through", high) - F.greatest(F.col("through") - F.col("n"), low)))
    stats = kept.agg(F.sum("k").alias("n"), F.sum(F.col("k") * F.col("size")).alias("s"), F.sum(F.col("k") * F.col("size") * F.col("size")).alias("ss"))
    mean = F.col("s") / F.col("n")
    placed = islands(as_intervals(good, "read_id"), ["chrom"], ["start_pos", "end_pos", "read_id"], F.col("start_pos"), F.col("end_pos"))
    covered = placed.groupBy("chrom", "island").agg(F.sum(F.col("end_pos") - F.col("start_pos")).alias("bases"), (F.max("end_pos") - F.min("start_pos")).alias("places")).agg((F.sum("bases") / F.sum("places")).alias("coverage"))
    return stats.select(F.col("n").alias("n_reads"), mean.alias("isize_mean"), F.sqrt(F.col("ss") / F.col("n") - mean * mean).alias("isize_sd")).join(F.broadcast(covered), F.lit(True), "left")


def variant_read_features(calls: DataFrame, reads: DataFrame, isize_mean: float, isize_sd: float, coverage: float = C.COVERAGE, points: int = 10, min_mapq: int = 18, longest: int = 1_000_000) -> DataFrame:
    """Reads at places of a call that depend on its id alone, and discordant ones beside its ends.

    aligned_share and end_aligned_share: what of the bases of well mapped reads there is not clipped. unique_share: what of
    the reads inside is well mapped, which is little in repeats. unique_coverage and total_coverage: reads at a place over the
    library's mean coverage.
    """
    short, beside = calls.where(F.col("end_pos") - F.col("start_pos") <= longest), int(isize_sd)
    spans = short.where("call_id is not null").select("call_id", "chrom", F.col("start_pos").alias("begin"), F.col("end_pos").alias("end"), F.greatest(F.lit(0), F.least(F.col("start_pos"), F.col("start_pos") - beside)).alias("start_pos"), (F.greatest("start_pos", "end_pos") + beside + 1).alias("end_pos"))

    def places(spans):
        call, begin, end = (spans[c].to_numpy() for c in ("call_id", "begin", "end"))
        inside = begin[:, None] + (call[:, None] * 7919 + np.arange(points) * 104729) % np.maximum(1, end - begin)[:, None]
        return np.column_stack([inside, np.maximum(0, begin - beside), end + beside]), points

    good, size = F.coalesce(F.col("mapq") >= min_mapq, F.lit(False)), F.abs("tlen")
    only = lambda c, n=F.lit(1): F.when(c, F.coalesce(n, F.lit(0))).otherwise(0)
    kept = F.col("rlen") - F.col("clip_left") - F.col("clip_right")
    weights = {"all": F.lit(1), "good": only(good), "ahead": only(good & ~F.col("is_reverse")), "far": only(good & (size > isize_mean + 3 * isize_sd)), "near": only(good & (size < isize_mean - 3 * isize_sd)), "kept": only(good, kept), "bases": only(good, F.col("rlen"))}
    sums = point_sums(spans, as_intervals(reads, *[w.alias(c) for c, w in weights.items()]), ["call_id"], list(weights), places)
    share = lambda k: F.col(f"kept_{k}") / F.when(F.col(f"bases_{k}") != 0, F.col(f"bases_{k}"))
    counts = sums.select("call_id", F.col("good_1").alias("unique"), F.col("all_1").alias("total"), F.col("ahead_1").alias("forward"), F.col("far_2").alias("discordant_high"), F.col("near_2").alias("discordant_low"), share(1).alias("aligned_share"), share(2).alias("end_aligned_share"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("unique", "total", "forward", "discordant_high", "discordant_low")}
    out = short.select("call_id").join(counts, "call_id", "left").withColumns(zero)
    return out.withColumns({"strand_bias": F.when(F.col("unique") > 0, F.pow(F.col("forward") / F.col("unique") - 0.5, F.lit(2))), "unique_share": F.when(F.col("total") > 0, F.col("unique") / F.col("total")), **{f"{c}_coverage": F.col(c) / points / coverage for c in ("unique", "total")}})


ONE_HOT = ("RP", "RD", "SR", "JM", "AS", "SC")


def ml_features(calls: DataFrame, info_fields: tuple[str, ...]) -> DataFrame:
    """`call_id, sv_len, methods, info` (a map) to a row of numbers: one column per method and INFO field, -1 where missing."""
    hot = [F.array_contains("methods", m).cast("int").alias(f"has_{m}") for m in ONE_HOT]
    fields = [F.coalesce(F.col("info")[f].try_cast("double"), F.lit(-1.0)).alias(f) for f in info_fields]
    return calls.select("call_id", F.abs("sv_len").alias("sv_len"), F.size("methods").alias("n_methods"), *hot, *fields)
