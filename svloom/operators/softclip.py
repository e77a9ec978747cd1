"""Candidate intervals from soft-clipped reads.

The stages, each DataFrame to DataFrame: clipped reads vote for a type and the other
breakpoint; votes of one side merge into windows; windows gain features, coverage and the
support of neighbouring reads; what has support becomes an interval from breakpoint to
breakpoint, and intervals merge and are refined by their members' votes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import reads as R
from ..session import kept
from .intervals import anti_overlap, overlap_join
from .sweeps import overlap_counts
from .merge import merge_by_distance

FAR = 1_000_000_000


def clipped_reads(reads: DataFrame, pad: int = C.SC_PAD) -> DataFrame:
    """Good clipped reads with window, location, strand, type and clip."""
    # Exploded, so that what the struct holds is computed once and not copied into later expressions.
    shape = F.col("shape")
    seen = F.struct(shape["clip"].alias("clip"), R.infer_svtype().alias("sv_type"), R.clip_window(pad, shape).alias("w"))
    good = R.shaped(reads).where((F.abs("tlen") <= FAR) & R.good_read(shape=shape)).withColumn("seen", F.explode(F.array(seen)))
    return good.withColumns({"clip": F.col("seen.clip"), "sv_type": F.col("seen.sv_type"), "start_pos": F.col("seen.w.low"), "end_pos": F.col("seen.w.high"), "location": F.floor((F.col("seen.w.low") + F.col("seen.w.high")) / 2), "strand": F.when(F.col("is_reverse"), "-").otherwise("+")}).drop("seen")


def candidates(reads: DataFrame, pad: int = C.SC_PAD) -> DataFrame:
    """One vote per clipped read: read_id, chrom, window, location, other_bp, strand, sv_type."""
    voted = clipped_reads(reads, pad).where("sv_type <> 'NONE'")
    voted = R.with_vote(voted, "other_bp", R.other_breakpoint(F.col("sv_type"), F.col("location"), F.col("clip")))
    return voted.select("read_id", "chrom", "start_pos", "end_pos", "location", "other_bp", "strand", "sv_type", side().alias("side"))


def none_candidates(reads: DataFrame, pad: int = C.SC_PAD) -> DataFrame:
    """Clipped reads whose placement suggests no type."""
    return clipped_reads(reads, pad).where("sv_type = 'NONE'").select("read_id", "chrom", "start_pos", "end_pos", "location", "strand", F.col("clip.len").alias("clip_len"))


def side() -> Column:
    return F.when(F.col("location") <= F.col("other_bp"), "L").otherwise("R")


def call_breakpoints(calls: DataFrame, max_tools: int = 1, pad: int = C.SC_PAD) -> DataFrame:
    """Windows around the ends of calls that need help: few callers, or none with a precise method.

    `call_id, chrom, start_pos, end_pos, sv_type, n_tools, methods` (array); translocations'
    second ends lie on `chrom2`.
    """
    help_ = (F.col("n_tools") <= max_tools) | ~F.arrays_overlap("methods", F.array(*map(F.lit, ("AS", "SR", "JM"))))
    tx = F.col("sv_type").isin(*C.TRANSLOCATIONS)
    at = lambda chrom, pos, keep: F.when(keep, F.struct(chrom.alias("chrom"), pos.alias("pos")))
    ends = F.array(at(F.col("chrom"), F.col("start_pos"), F.lit(True)), at(F.col("chrom"), F.col("end_pos"), ~tx & (F.col("end_pos") > F.col("start_pos") + 1)), at(F.col("chrom2"), F.col("end_pos"), tx))
    rows = calls.where(help_).select("call_id", "sv_type", F.explode(F.array_compact(ends)).alias("e"))
    return rows.select("call_id", "sv_type", F.col("e.chrom").alias("chrom"), F.greatest(F.lit(0), F.col("e.pos") - pad).alias("start_pos"), (F.col("e.pos") + pad).alias("end_pos"), F.col("e.pos").alias("location"))


def unmatched_windows(none: DataFrame, other: DataFrame, voted: DataFrame, ratio: float = C.OVERLAP_RATIO) -> DataFrame:
    """Windows without a type: unvoted reads, and callers' windows with no vote; without those a voted window matches."""
    seen = voted.select("chrom", "start_pos", "end_pos").distinct()
    new = anti_overlap(other.select("id", "chrom", "start_pos", "end_pos", F.lit("OTHER").alias("kind")), seen, "id", ratio=0.5)
    both = none.select("id", "chrom", "start_pos", "end_pos", F.lit("NONE").alias("kind")).unionByName(new)
    return anti_overlap(both.withColumn("key", F.concat_ws(":", "kind", F.col("id").cast("string"))), seen, "key", ratio=ratio).drop("key")


def merged_windows(voted: DataFrame, pad: int = C.SC_PAD) -> DataFrame:
    """Votes with `island`: windows of one type and side that share at least `pad` bases."""
    return merge_by_distance(voted, ["chrom", "sv_type", "side"], "read_id", pad)


def split_by_other_end(marked: DataFrame, pad: int = C.SC_PAD) -> DataFrame:
    """Islands of types with two ends are divided where the other ends fall apart: `part`, numbered within the island."""
    keys = ["chrom", "sv_type", "side", "island"]
    ins = F.col("sv_type") == "INS"
    other = marked.select("*", F.col("start_pos").alias("_s"), F.col("end_pos").alias("_e")).withColumns({"start_pos": F.when(ins, 0).otherwise(F.greatest(F.lit(0), F.col("other_bp") - pad)), "end_pos": F.when(ins, 2 * pad).otherwise(F.col("other_bp") + pad)})
    split = merge_by_distance(other.withColumnRenamed("island", "_island").withColumn("island_", F.col("_island")), ["chrom", "sv_type", "side", "island_"], "read_id", pad).withColumnRenamed("island", "cluster")
    split = split.withColumns({"island": F.col("island_"), "start_pos": F.col("_s"), "end_pos": F.col("_e")}).drop("_s", "_e", "_island", "island_")
    again = merge_by_distance(split.withColumnRenamed("island", "isle"), ["chrom", "sv_type", "side", "isle", "cluster"], "read_id", pad).withColumnRenamed("island", "piece").withColumnRenamed("isle", "island")
    return again.withColumn("part", F.dense_rank().over(W.partitionBy(*keys).orderBy("cluster", "piece"))).drop("cluster", "piece")


def window_features(marked: DataFrame, keys: list[str], pad: int = C.SC_PAD) -> DataFrame:
    """One row per window: bounds, support and its spread, and the span of the other ends (0, 0 for insertions)."""
    by_place = marked.groupBy(*keys, "location").agg(F.count("*").alias("n"), F.sum(F.when(F.col("strand") == "+", 1).otherwise(0)).alias("plus"), F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.min("other_bp").alias("low"), F.max("other_bp").alias("high"))
    out = by_place.groupBy(*keys).agg(
        F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.sum("n").alias("support"), F.sum("plus").alias("plus_support"), F.count("*").alias("n_locations"), (F.max("location") - F.min("location")).alias("locations_span"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("location", "n"))), lambda x: F.concat_ws(",", x["location"].cast("string"), x["n"].cast("string"))), ",").alias("count_text"), F.min("low").alias("low"), F.max("high").alias("high"),
    )
    ins = F.col("sv_type") == "INS"
    return out.withColumns({"minus_support": F.col("support") - F.col("plus_support"), "other_start": F.when(ins, 0).otherwise(F.greatest(F.lit(0), F.col("low") - pad)), "other_end": F.when(ins, 0).otherwise(F.col("high") + pad)}).drop("low", "high")


def with_coverage(windows: DataFrame, reads: DataFrame, id_: list[str]) -> DataFrame:
    """Windows with `coverage`, the number of reads that touch them."""
    seen = reads.select("chrom", F.col("pos").alias("start_pos"), F.col("aend").alias("end_pos"))
    counts = overlap_counts(windows, seen, id_).where("n > 0").withColumnRenamed("n", "coverage")
    return windows.join(counts, id_, "left").withColumn("coverage", F.coalesce("coverage", F.lit(0)))


def coverage_filter(windows: DataFrame, coverage: float = C.COVERAGE, read_length: int = C.READ_LENGTH, frac: tuple[float, float] = C.INS_COVERAGE_FRAC, upper_only: bool = False) -> DataFrame:
    """Insertions (or all, if upper_only) whose depth is far from the library's go."""
    depth = F.col("coverage") / F.abs(F.col("start_pos") - F.col("end_pos") + 1) * read_length
    if upper_only:
        return windows.where(depth <= frac[1] * coverage)
    return windows.where((F.col("sv_type") != "INS") | depth.between(frac[0] * coverage, frac[1] * coverage))


def neighbour_votes(windows: DataFrame, reads: DataFrame, id_: list[str], typed: bool = True, max_clip: int = 250, max_other: int = 500) -> DataFrame:
    """Reads in a window that suggest its type (any type, if not typed) and about its other end: one row each.

    Windows carry other_start and other_end if typed. A read's clip must lie near the window's middle.
    """
    have = windows.select(*dict.fromkeys([*id_, "chrom", "start_pos", "end_pos", *(["sv_type", "other_start", "other_end"] if typed else [])]))
    if "sv_type" in have.columns:
        have = have.withColumnRenamed("sv_type", "want") if "sv_type" not in id_ else have.withColumn("want", F.col("sv_type"))
    shape = F.col("shape")
    seen = F.struct(shape["clip"].alias("clip"), R.infer_svtype().alias("read_type"), R.clip_window(shape=shape).alias("w"))
    near = R.shaped(reads).where(R.good_read(neighbour=True, shape=shape)).withColumn("seen", F.explode(F.array(seen))).where("seen.read_type <> 'NONE'")
    near = near.withColumns({"read_type": F.col("seen.read_type"), "clip": F.col("seen.clip"), "clip_at": F.floor((F.col("seen.w.low") + F.col("seen.w.high")) / 2)})
    # What a clipped read says depends on no window, so it is known before the join, and a read that says nothing stays out of it.
    near = near.withColumn("vote", F.explode(F.array(F.when(F.col("clip").isNotNull(), R.other_breakpoint(F.col("read_type"), F.col("clip_at"), F.col("clip")))))).where("clip is null or vote is not null")
    mate = ["mate_chrom", "mate_pos", "mate_is_unmapped"]
    near = near.select("read_id", "chrom", F.col("pos").alias("start_pos"), F.col("aend").alias("end_pos"), "rlen", "tlen", *mate, "is_reverse", "read_type", F.when(F.col("clip").isNotNull(), F.col("clip_at")).alias("clip_at"), "vote")
    if typed:
        met = overlap_join(have, near.withColumnRenamed("read_type", "want"), prefix="r_", on=["want"])  # no pair of other types is formed
        met = met.withColumn("r_read_type", F.col("r_want"))
    else:
        met = overlap_join(have, near, prefix="r_")
    middle = F.floor((F.col("start_pos") + F.col("end_pos")) / 2)
    met = met.withColumn("middle", middle).where(F.col("r_clip_at").isNull() | (F.abs(F.col("r_clip_at") - F.col("middle")) <= max_clip))
    of_read = {"pos": "r_start_pos", "aend": "r_end_pos", "chrom_of_read": "r_chrom", **{c: f"r_{c}" for c in ("read_id", "rlen", "tlen", *mate, "is_reverse", "read_type", "clip_at", "vote")}}
    plain = met.select(*id_, "middle", *(["want", "other_start", "other_end"] if typed else []), *[F.col(c).alias(name if name not in id_ else "_" + name) for name, c in of_read.items()])
    plain = plain if "chrom" in plain.columns else plain.withColumn("chrom", F.col("chrom_of_read"))
    vote = F.when(F.col("clip_at").isNotNull(), F.col("vote")).otherwise(R.neighbour_breakpoint(F.col("read_type"), F.col("middle")))
    plain = R.with_vote(plain, "other_bp", vote)
    if typed:
        plain = plain.where((F.col("want") == "INS") | (F.abs(F.col("other_bp") - F.floor((F.col("other_start") + F.col("other_end")) / 2)) <= max_other))
    return plain.select(*id_, "read_id", "read_type", "other_bp", F.when(F.col("is_reverse"), "-").otherwise("+").alias("strand"), F.when(F.col("mate_is_unmapped"), "-1").otherwise(F.col("mate_chrom")).alias("mate_chrom"), F.when(F.col("mate_is_unmapped"), -1).otherwise(F.col("mate_pos")).alias("mate_pos"))


def with_neighbours(windows: DataFrame, reads: DataFrame, id_: list[str], read_length: int = C.READ_LENGTH) -> DataFrame:
    """Windows with the number of agreeing reads: neighbours, and those on each strand; and `mates`, where an insertion's reads have theirs.

    `mates` is `chrom;n;low;high` for each chromosome in order, joined by commas; null for other types.
    """
    on = lambda s: F.sum(F.when(F.col("strand") == s, 1).otherwise(0))
    votes = neighbour_votes(windows, reads, id_).withColumn("_mate", F.when(F.col("read_type") == "INS", F.col("mate_chrom")))
    by_mate = votes.groupBy(*id_, "_mate").agg(F.count("*").alias("n"), on("+").alias("plus"), on("-").alias("minus"), F.min("mate_pos").alias("low"), (F.max("mate_pos") + read_length // 2).alias("high"))
    one = lambda x: F.concat_ws(";", *[x[c].cast("string") for c in ("_mate", "n", "low", "high")])
    found = F.array_sort(F.collect_list(F.when(F.col("_mate").isNotNull(), F.struct("_mate", "n", "low", "high"))))
    votes = by_mate.groupBy(*id_).agg(F.sum("n").alias("neighbours"), F.sum("plus").alias("plus"), F.sum("minus").alias("minus"), F.array_join(F.transform(found, one), ",").alias("mates"))
    zero = {c: F.coalesce(c, F.lit(0)) for c in ("neighbours", "plus", "minus")}
    return windows.join(votes, id_, "left").withColumns(zero | {"mates": F.when(F.col("sv_type") == "INS", F.coalesce("mates", F.lit("")))})


def mate_histogram(windows: DataFrame, reads: DataFrame, id_: list[str], read_length: int = C.READ_LENGTH) -> DataFrame:
    """For insertions, where the agreeing reads' mates lie: id, mate_chrom, n, low, high."""
    votes = neighbour_votes(windows.where("sv_type = 'INS'"), reads, id_)
    return votes.groupBy(*id_, "mate_chrom").agg(F.count("*").alias("n"), F.min("mate_pos").alias("low"), (F.max("mate_pos") + read_length // 2).alias("high"))


def _limit(values: dict[str, float]) -> Column:
    return F.create_map(*[F.lit(x) for kv in values.items() for x in kv])[F.col("sv_type")].cast("double")


def _scale(low_scale: float) -> Column:
    return F.when(F.col("support") >= C.MIN_SUPPORT_SC_ONLY, 1.0).otherwise(low_scale)


def fraction_filter(windows: DataFrame, fractions: dict[str, float] = C.MIN_SUPPORT_FRAC, strand_scale: float = 0.4, low_scale: float = 1.4) -> DataFrame:
    """Support must be a share of the coverage; for insertions on both strands, by a smaller share."""
    need = F.col("coverage") * _limit(fractions) * _scale(low_scale)
    return windows.where((need <= F.col("neighbours")) & ((F.col("sv_type") != "INS") | (need * strand_scale <= F.least("plus", "minus"))))


def count_filter(windows: DataFrame, least: dict[str, float] = C.MIN_SUPPORT, strand_scale: float = 0.4, low_scale: float = 1.4) -> DataFrame:
    """The same with absolute numbers of reads."""
    need = _limit(least) * _scale(low_scale)
    return windows.where((F.col("neighbours") >= need) & ((F.col("sv_type") != "INS") | (F.least("plus", "minus") >= need * strand_scale)))


def resolve_none(windows: DataFrame, reads: DataFrame, least: dict[str, float] = C.MIN_SUPPORT, fractions: dict[str, float] = C.MIN_SUPPORT_FRAC, coverage: float = C.COVERAGE, pad: int = C.SC_PAD, none_scale: float = 1.4, other_scale: float = C.OTHER_SCALE) -> DataFrame:
    """Windows without a type take those that enough neighbours vote for: one row per vote, like `candidates`.

    `id, chrom, start_pos, end_pos, kind`; windows of callers only (kind OTHER) need more.
    """
    marked = merge_by_distance(windows, ["chrom"], "id", pad)
    merged = marked.groupBy("chrom", "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count("*").alias("support"), F.max((F.col("kind") == "NONE").cast("int")).alias("some_none"))
    merged = kept(coverage_filter(with_coverage(merged, reads, ["chrom", "island"]), coverage, upper_only=True))
    # Votes are tallied, and those for the chosen types given out: the reads meet the windows once.
    votes = kept(neighbour_votes(merged, reads, ["chrom", "island"], typed=False).withColumnRenamed("read_type", "sv_type").drop("mate_chrom", "mate_pos"))
    tally = votes.groupBy("chrom", "island", "sv_type").agg(F.count("*").alias("neighbours"), F.sum(F.when(F.col("strand") == "+", 1).otherwise(0)).alias("plus"), F.sum(F.when(F.col("strand") == "-", 1).otherwise(0)).alias("minus"))
    scale = F.when(F.col("some_none") == 1, none_scale).otherwise(none_scale * other_scale)
    tally = tally.join(merged, ["chrom", "island"]).withColumns({"coverage": F.col("coverage") * scale, "_scale": scale})
    enough = fraction_filter(tally, fractions).where(F.col("neighbours") >= _limit(least) * _scale(1.4) * F.col("_scale"))
    enough = enough.where((F.col("sv_type") != "INS") | (F.least("plus", "minus") >= _limit(least) * _scale(1.4) * F.col("_scale") * 0.4))
    chosen = enough.select("chrom", "island", "sv_type", "start_pos", "end_pos")
    out = votes.join(chosen, ["chrom", "island", "sv_type"]).withColumn("location", F.floor((F.col("start_pos") + F.col("end_pos")) / 2))
    return out.select("read_id", "chrom", "start_pos", "end_pos", "location", "other_bp", "strand", "sv_type", side().alias("side"))


def full_intervals(windows: DataFrame) -> DataFrame:
    """From the middle of the window to the middle of the other ends' span; insertions keep their window and have no length."""
    middle, other = F.floor((F.col("start_pos") + F.col("end_pos")) / 2), F.floor((F.col("other_start") + F.col("other_end")) / 2)
    two = (F.col("other_start") != 0) | (F.col("other_end") != 0)
    out = windows.withColumns({"window_start": F.col("start_pos"), "window_end": F.col("end_pos"), "start_pos": F.when(two, F.least(middle, other)).otherwise(F.col("start_pos")), "end_pos": F.when(two, F.greatest(middle, other)).otherwise(F.col("end_pos"))})
    return out.withColumn("sv_len", F.when(F.col("sv_type") == "INS", 0).otherwise(F.greatest(F.col("end_pos") - F.col("start_pos"), F.lit(0))))


def fine_tune(merged: DataFrame, intervals: DataFrame) -> DataFrame:
    """Merged intervals refined by their members: `ends` 2 with averaged ends, 1 if only one side votes, dropped if none.

    A member votes left if its window is nearer the interval's start and its other end nearer
    the end, right the other way round. Insertions stay.
    """
    key = ["sv_type", "chrom", "start_pos", "end_pos", "ids"]
    member = merged.withColumn("id", F.explode("ids")).join(intervals.select("id", F.floor((F.col("window_start") + F.col("window_end")) / 2).alias("clip_at"), F.floor((F.col("other_start") + F.col("other_end")) / 2).alias("other_at")), "id")
    nearer_start = lambda c: F.abs(F.col(c) - F.col("start_pos")) < F.abs(F.col(c) - F.col("end_pos"))
    left = nearer_start("clip_at") & ~nearer_start("other_at")
    right = ~nearer_start("clip_at") & nearer_start("other_at")
    votes = member.groupBy(*key).agg(F.floor(F.avg(F.when(left, F.col("clip_at")))).alias("left_bp"), F.floor(F.avg(F.when(right, F.col("clip_at")))).alias("right_bp"), F.min("other_at").alias("other_low"), F.max("other_at").alias("other_high"))
    ins = F.col("sv_type") == "INS"
    ends = F.when(ins | (F.col("left_bp").isNotNull() & F.col("right_bp").isNotNull()), 2).when(F.col("left_bp").isNotNull() | F.col("right_bp").isNotNull(), 1)
    both = ~ins & (F.col("ends") == 2)
    out = votes.withColumn("ends", ends).where("ends is not null")
    out = out.withColumns({"new_start": F.when(both, F.col("left_bp")).otherwise(F.col("start_pos")), "new_end": F.when(both, F.col("right_bp")).otherwise(F.col("end_pos"))})
    return out.select("sv_type", "chrom", F.col("new_start").alias("start_pos"), F.col("new_end").alias("end_pos"), F.when(both, F.col("new_end") - F.col("new_start")).otherwise(F.when(ins, 0).otherwise(F.col("end_pos") - F.col("start_pos"))).alias("sv_len"), "ends", "ids")


def other_end_windows(one_ended: DataFrame, intervals: DataFrame, pad: int = C.SC_PAD) -> DataFrame:
    """For one-ended intervals the window over their members' other ends, with the clipped end as its other end."""
    spans = one_ended.withColumn("id", F.explode("ids")).join(intervals.select("id", "other_start", "other_end"), "id").groupBy("sv_type", "chrom", "start_pos", "end_pos").agg(F.min("other_start").alias("low"), F.max("other_end").alias("high"), F.min("id").alias("id"))
    middle = F.floor((F.col("low") + F.col("high")) / 2)
    clip_at = F.when(F.abs(middle - F.col("start_pos")) > F.abs(middle - F.col("end_pos")), F.col("start_pos")).otherwise(F.col("end_pos"))
    return spans.select(F.concat(F.lit("one:"), F.col("id").cast("string")).alias("id"), "sv_type", "chrom", F.col("low").alias("start_pos"), F.col("high").alias("end_pos"), F.greatest(F.lit(0), clip_at - pad).alias("other_start"), (clip_at + pad).alias("other_end"), F.lit(1).cast("bigint").alias("support"))


def padded(df: DataFrame, pad: int) -> DataFrame:
    ins = F.col("sv_type") == "INS"
    return df.withColumns({"start_pos": F.when(ins, F.greatest(F.col("start_pos") - pad, F.lit(0))).otherwise(F.col("start_pos")), "end_pos": F.when(ins, F.col("end_pos") + pad).otherwise(F.col("end_pos"))})


def unpadded(df: DataFrame, pad: int) -> DataFrame:
    ins = F.col("sv_type") == "INS"
    return df.withColumns({"start_pos": F.when(ins, F.col("start_pos") + pad).otherwise(F.col("start_pos")), "end_pos": F.when(ins, F.greatest(F.col("end_pos") - pad, F.col("start_pos") + pad + 1)).otherwise(F.col("end_pos"))})


def coverage_share(support: Column, coverage: Column) -> Column:
    """The mean of support over coverage of two arrays."""
    shares = F.zip_with(support, coverage, lambda s, c: s.cast("double") / c)
    return F.aggregate(shares, F.lit(0.0), lambda a, x: a + x) / F.size(support)


def _by_source(members: Column, source: str) -> Column:
    return F.filter(members, lambda m: m["source"] == source)


def precise_coordinates(members: Column, start: Column, end: Column) -> Column:
    """struct<start, end> of the first member by Pindel, BreakSeq or SoftClip, in this order; else as given."""
    out = F.struct(start.alias("start"), end.alias("end"))
    for tool in ("SoftClip", "BreakSeq", "Pindel"):
        of = _by_source(members, tool)
        out = F.when(F.size(of) > 0, F.struct(F.get(of, F.lit(0))["start"].alias("start"), F.get(of, F.lit(0))["end"].alias("end"))).otherwise(out)
    return out


def decoded_source(text: Column) -> Column:
    """`chrom-start-chrom2-end-len-tool` to a struct. Contig names must not contain the dash."""
    f = F.split(text, "-")
    return F.struct(f[0].alias("chrom"), f[1].cast("bigint").alias("start"), f[2].alias("chrom2"), f[3].cast("bigint").alias("end"), f[4].cast("bigint").alias("len"), f[5].alias("source"))
