"""Column functions of aligned reads.

A read has chrom, pos, aend, rlen, mapq, nm, tlen, mate_chrom, mate_pos, `cigar` (array of
op and len; 0 match, 1 insertion, 4 soft clip), and the flags is_reverse, mate_is_reverse,
is_duplicate, is_unmapped, mate_is_unmapped; `clip_qual` is the mean base quality of the
clipped part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C

SOFT_CLIP = 4
KEPT_OPS = (0, 1, 4)


def with_cigar(reads: DataFrame) -> DataFrame:
    """The cigar array from clip_left, match_len, clip_right, and its `shape`; parts of no length are left out."""
    part = lambda op, n: F.struct(F.lit(op).alias("op"), F.col(n).cast("int").alias("len"))
    parts = F.array(part(4, "clip_left"), part(0, "match_len"), part(4, "clip_right"))
    left, kept, right = (F.greatest(F.coalesce(F.col(n).cast("int"), F.lit(0)), F.lit(0)) for n in ("clip_left", "match_len", "clip_right"))
    clip = F.struct(F.greatest(left, right).alias("len"), F.when(left > 0, 0).otherwise(kept).alias("left"), F.when(left > 0, kept).otherwise(0).alias("right"))
    shape = F.struct(F.when((left > 0) != (right > 0), clip).alias("clip"), F.lit(0).alias("inserted"), ((left > 0) | ((kept == 0) & (right > 0))).alias("begins"), (left + kept + right > 0).alias("some"))
    return reads.withColumns({"cigar": F.filter(parts, lambda x: x["len"] > 0), "clip_qual": F.col("avg_qual"), "shape": shape})


def shape_of(cigar: Column) -> Column:
    """struct<clip, inserted, begins, some>: the only soft clip (see `softclip`), inserted bases, whether it begins with a clip, and whether it has parts."""
    return F.struct(softclip(cigar).alias("clip"), _inserted(cigar).alias("inserted"), F.coalesce(F.get(cigar, F.lit(0))["op"] == SOFT_CLIP, F.lit(False)).alias("begins"), (F.size(cigar) > 0).alias("some"))


def shaped(reads: DataFrame) -> DataFrame:
    """Reads with the `shape` of their cigar, worked out once if they bring none."""
    return reads if "shape" in reads.columns else reads.withColumn("shape", F.explode(F.array(shape_of(F.col("cigar")))))


def softclip(cigar: Column) -> Column:
    """struct<len, left, right> of the only soft clip, with the read's bases on either side; null if there is not just one."""
    clips = F.filter(cigar, lambda x: x["op"] == SOFT_CLIP)
    at = F.array_position(F.transform(cigar, lambda x: x["op"]), F.lit(SOFT_CLIP)).cast("int")
    bases = lambda part: F.aggregate(part, F.lit(0), lambda n, x: n + F.when(x["op"].isin(*KEPT_OPS), x["len"]).otherwise(0))
    found = F.struct(F.get(clips, F.lit(0))["len"].alias("len"), bases(F.slice(cigar, F.lit(1), at - 1)).alias("left"), bases(F.slice(cigar, at + 1, F.size(cigar))).alias("right"))
    return F.when(F.size(clips) == 1, found)


def _inserted(cigar: Column) -> Column:
    return F.aggregate(cigar, F.lit(0), lambda n, x: n + F.when(x["op"] == 1, x["len"]).otherwise(0))


def matches(shape: Column | None = None) -> Column:
    """Aligned bases without insertions; mismatch tags are not counted."""
    return F.col("aend") - F.col("pos") - (_inserted(F.col("cigar")) if shape is None else shape["inserted"])


def good_read(neighbour: bool = False, min_qual: int = C.MIN_BASE_QUAL, min_mapq: int = C.MIN_MAPQ, min_clip: int = C.MIN_SOFT_CLIP, max_nm: int = C.MAX_NM, min_matches: int = C.MIN_MATCHES, shape: Column | None = None) -> Column:
    """Fit as evidence: mapped well, and (unless only a neighbour) clipped far enough at good quality. shape: that of the cigar, if it is known."""
    some = F.size("cigar") > 0 if shape is None else shape["some"]
    mapped = ~F.col("is_duplicate") & ~F.col("is_unmapped") & (F.col("mapq") >= min_mapq) & some & (F.col("nm") <= max_nm) & (matches(shape) >= min_matches)
    if neighbour:
        return mapped
    clip = softclip(F.col("cigar")) if shape is None else shape["clip"]
    return mapped & F.coalesce(clip["len"] >= min_clip, F.lit(False)) & (F.col("clip_qual") >= min_qual)


def clip_window(pad: int = C.SC_PAD, shape: Column | None = None) -> Column:
    """struct<low, high> around the clipped end."""
    begins = F.get("cigar", F.lit(0))["op"] == SOFT_CLIP if shape is None else shape["begins"]
    at = F.when(begins, F.col("pos")).otherwise(F.col("aend"))
    return F.struct(F.greatest(F.lit(0), at - pad).alias("low"), (at + pad).alias("high"))


def infer_svtype(low: int = C.ISIZE_MEAN - 2 * C.ISIZE_SD, high: int = C.ISIZE_MEAN + 2 * C.ISIZE_SD) -> Column:
    """The type that a pair's placement suggests; across chromosomes INS, outward DUP."""
    outward = ((F.col("pos") < F.col("mate_pos")) & F.col("is_reverse")) | ((F.col("pos") > F.col("mate_pos")) & ~F.col("is_reverse"))
    size = F.abs("tlen")
    return (
        F.when(F.col("mate_is_unmapped"), "INS")
        .when(F.col("chrom") != F.col("mate_chrom"), "INS")
        .when(F.col("is_reverse") == F.col("mate_is_reverse"), "INV")
        .when(outward, "DUP")
        .when(size > high, "DEL")
        .when(size < low, "INS")
        .otherwise("NONE")
    )


# Where the other breakpoint is.
#
# A fragment runs from its read's outer end in the read's own direction d (+1 forward, -1 reverse)
# over `isize_mean` bases, the mate at its far end. Say the breakpoint `at` lies `reach` bases from the
# outer end, and the read's aligned part covers `span`. Seen along d, everything mirrors, so each
# kind of event has one formula for both strands:
#
# deletion      the fragment goes on beyond the gap. Mates lie |tlen| apart from outer end to outer end, which
#               is the fragment and the gap: the gap is |tlen| - mean.
# duplication   the fragment goes on at the copy's begin, behind the read, where mean - reach bases reach the
#               mate's outer end. From the mate's inner end to the end of the read's part is |tlen|.
# inversion     the fragment goes on at the other breakpoint against d, so mates point the same way. Mean - reach
#               bases on, the mate's outer end is behind the read, or ahead of it at the segment's far side. If
#               the breakpoint is behind the aligned part (the read begins before it), the rest of the fragment
#               lies in the segment and goes past its other end to the mate.


def _direction() -> Column:
    return F.when(F.col("is_reverse"), -1).otherwise(1)


def _mate_ahead() -> Column:
    """The mate lies on in the read's direction."""
    return (F.col("pos") <= F.col("mate_pos")) == ~F.col("is_reverse")


def _beyond(svtype: Column, ahead: Column, behind: Column, reach: Column, span: Column, isize_mean: int, deleted: Column, doubled: Column) -> Column:
    """How far beyond the breakpoint, along the read's direction, the other one is, for types with two ends; null if the read tells nothing.

    ahead, behind: where the breakpoint lies from the read. deleted, doubled: whether the read is in place for these events.
    """
    stretch, total = F.abs("tlen") - isize_mean, F.abs("tlen") + isize_mean
    inverted = (
        F.when(ahead & _mate_ahead(), total - 2 * reach - F.col("rlen"))
        .when(ahead, span - 2 * reach - stretch)
        .when(behind & ~_mate_ahead(), F.col("rlen") - 2 * reach - stretch)
    )
    return (
        F.when(svtype == "DEL", F.when(deleted, stretch))
        .when(svtype == "DUP", F.when(doubled, F.col("rlen") + span - total))
        .when(svtype == "INV", inverted)
    )


def _placed(svtype: Column, at: Column, inserted: Column, beyond: Column) -> Column:
    """The other breakpoint's place; 1, by convention, for insertions. inserted: whether the read is in place for one.

    `beyond` stands here once only: it is long, and the Java VM leaves methods of over 8,000 bytes of code uncompiled.
    """
    return F.when(svtype == "INS", F.when(inserted, F.lit(1).cast("bigint"))).otherwise(at + _direction() * beyond)


def other_breakpoint(svtype: Column, location: Column, clip: Column, isize_mean: int = C.ISIZE_MEAN, near_end: int = 2) -> Column:
    """Where a clipped read puts the other breakpoint (1 for insertions); null if it fits none. See `with_vote`.

    A clip ahead ends the aligned part at the breakpoint; a clip behind is what of the read lies before it.
    """
    left, right = clip["left"] <= near_end, clip["right"] <= near_end
    ahead, behind = F.when(F.col("is_reverse"), left).otherwise(right), F.when(F.col("is_reverse"), right).otherwise(left)
    kept = F.when(F.col("is_reverse"), clip["right"]).otherwise(clip["left"])
    reach = F.when(ahead, kept).otherwise(clip["len"])
    return _placed(svtype, location, ahead, _beyond(svtype, ahead, behind, reach, kept, isize_mean, ahead & _mate_ahead(), ahead & ~_mate_ahead()))


def neighbour_breakpoint(svtype: Column, location: Column, isize_mean: int = C.ISIZE_MEAN, wiggle: int = 20) -> Column:
    """The same for a read without a clip, from its distance to the breakpoint."""
    before, beside = F.col("aend") < location + wiggle, F.col("pos") > location - wiggle
    ahead, behind = F.when(F.col("is_reverse"), beside).otherwise(before), F.when(F.col("is_reverse"), before).otherwise(beside)
    outer = F.when(F.col("is_reverse"), F.col("aend")).otherwise(F.col("pos"))
    mate_edge = F.when(F.col("is_reverse"), F.col("mate_pos") + F.col("rlen")).otherwise(F.col("mate_pos"))
    away = F.col("mate_is_unmapped") | (F.col("chrom") != F.col("mate_chrom"))
    inserted = ahead & (away | (_direction() * (mate_edge - location) > -wiggle))
    begun = F.when(F.col("is_reverse"), ahead).otherwise(F.col("pos") < location + wiggle)  # a forward read of a duplication may run over the breakpoint
    reach = _direction() * (location - outer)
    return _placed(svtype, location, inserted, _beyond(svtype, ahead, behind, reach, F.col("rlen"), isize_mean, ahead, begun & ~_mate_ahead()))


def with_vote(df: DataFrame, name: str, at: Column) -> DataFrame:
    """The rows for which there is a place `at`, with it, not below 0, as a new column `name`.

    A generator between the long expression and the filter on it keeps the optimizer from copying the expression. Its array is
    plain: under a function with a lambda Spark would interpret the whole expression, and once more to see whether the array is empty.
    """
    return df.withColumn(name, F.explode(F.array(at))).where(F.col(name).isNotNull()).withColumn(name, F.greatest(F.col(name), F.lit(0)))


def reverse_complement(seq: Column) -> Column:
    return F.translate(F.reverse(F.upper(seq)), "ACGT", "TGCA")


def gc_content(seq: Column) -> Column:
    return F.length(F.regexp_replace(F.upper(seq), "[^GC]", "")) / F.length(seq)
