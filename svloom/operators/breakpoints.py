"""Breakpoints from split alignments of assembled contigs.

An alignment has call_id, contig_id, chrom, start_pos, end_pos, sv_type, ref_len, contig_len,
score, pct_identity and `frags`, array<struct<s1, e1, s2, e2>>: each fragment's ends on the
reference piece (1) and on the contig (2). The reference piece begins `pad` before the call.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

PAD = 500
WINDOW = 20
NEAR = 400


def with_fragments(alignments: DataFrame) -> DataFrame:
    """The fixture's columns f1_*, f2_* as an array of fragments."""
    one = lambda i: F.struct(*[F.col(f"f{i}_{x}").cast("bigint").alias(x) for x in ("s1", "e1", "s2", "e2")])
    return alignments.withColumn("frags", F.array(one(1), one(2)))


def usable_contigs(alignments: DataFrame, min_contig: int = 200, max_region: int = 1_000_000, types: tuple[str, ...] = ("DEL", "INS", "INV", "DUP")) -> DataFrame:
    return alignments.where((F.col("contig_len") >= min_contig) & (F.col("end_pos") - F.col("start_pos") <= max_region) & F.col("sv_type").isin(*types))


def grouped_contigs(alignments: DataFrame) -> DataFrame:
    """Contigs of each region."""
    return usable_contigs(alignments).groupBy("chrom", "start_pos", "end_pos", "sv_type").agg(F.count("*").alias("n_contigs"), F.max("contig_len").alias("longest"))


def without_repeats(alignments: DataFrame) -> DataFrame:
    """One alignment of those of a call with equal fragments on the reference: the least contig_id's."""
    key = F.to_json(F.struct(F.transform("frags", lambda x: F.struct(x["s1"], x["e1"])).alias("k")))
    kept = alignments.groupBy("call_id", key.alias("key")).agg(F.min("contig_id").alias("contig_id"))
    return alignments.join(kept.select("call_id", "contig_id"), ["call_id", "contig_id"], "left_semi")


def uncut(alignments: DataFrame, cut_at: Column, cut_len: Column) -> DataFrame:
    """Reference coordinates of a piece whose middle was cut out, shifted back.

    Fragments after the cut move by its length; of one across it the longer side stays, its
    end on the contig moved by as much.
    """

    def back(x: Column) -> Column:
        low, high = F.least(x["s1"], x["e1"]), F.greatest(x["s1"], x["e1"])
        rising = x["s1"] <= x["e1"]
        put = lambda a, b, c, d: F.struct(F.when(rising, a).otherwise(b).alias("s1"), F.when(rising, b).otherwise(a).alias("e1"), F.when(rising, c).otherwise(d).alias("s2"), F.when(rising, d).otherwise(c).alias("e2"))
        at_low, at_high = F.when(rising, x["s2"]).otherwise(x["e2"]), F.when(rising, x["e2"]).otherwise(x["s2"])
        keep_low = cut_at - low > high - cut_at
        first = put(low, cut_at - 1, at_low, at_high - (high - cut_at + 1))
        last = put(cut_at + cut_len, high + cut_len, at_low + (cut_at - low), at_high)
        across = F.when(keep_low, first).otherwise(last)
        return F.when((low < cut_at) & (high >= cut_at), across).when(low >= cut_at, put(low + cut_len, high + cut_len, at_low, at_high)).otherwise(put(low, high, at_low, at_high))

    return alignments.withColumn("frags", F.transform("frags", back))


def _gap(a: Column, b: Column) -> Column:
    return F.abs(b - a - 1)


def predicates(pad_len: int = 50) -> dict[str, Column]:
    """What an alignment looks like, as columns."""
    f, g = F.get("frags", F.lit(0)), F.get("frags", F.lit(1))
    two = F.size("frags") == 2
    ref = F.transform("frags", lambda x: F.abs(x["e1"] - x["s1"]) + 1)
    con = F.transform("frags", lambda x: F.abs(x["e2"] - x["s2"]) + 1)
    total = F.aggregate(con, F.lit(0).cast("bigint"), lambda n, x: n + x)
    gap1, gap2 = _gap(f["e1"], g["s1"]), _gap(f["e2"], g["s2"])
    return {
        "long_ref_flanks": two & (F.array_min(ref) >= pad_len),
        "ref_deletion": two & (gap1 >= WINDOW),
        "insertion": two & gap2.between(1, 49) & (gap1 <= WINDOW),
        "is_reference": F.when(F.size("frags") == 1, F.get(ref, F.lit(0)) >= F.col("end_pos") - F.col("start_pos") - 100).otherwise((F.array_min(con) >= 100) & (F.array_min(ref) >= 100) & (F.abs(gap1 - gap2) <= 20)),
        "all_aligned": total + 10 >= F.col("contig_len"),
        "flank_percent": F.round(100 * total / F.col("contig_len")).cast("bigint"),
    }


def _near(at: Column, side: str, pad: int, near: int) -> Column:
    return F.abs(at - (F.lit(pad) if side == "L" else F.col("ref_len") - pad)) < near


def good_alignments(alignments: DataFrame, min_flank: int = 50, min_gap: int = 30, pad: int = PAD, near: int = NEAR) -> DataFrame:
    """Alignments fit for their call's type."""
    f, g = F.get("frags", F.lit(0)), F.get("frags", F.lit(1))
    two = F.size("frags") == 2
    ref = F.transform("frags", lambda x: F.abs(x["e1"] - x["s1"]) + 1)
    flanks = F.aggregate(ref, F.lit(0).cast("bigint"), lambda n, x: n + x)
    p = predicates()
    dele = two & (F.array_min(ref) >= min_flank) & (F.abs(f["e1"] - g["s1"]) >= min_gap) & (F.col("score") / flanks >= 0.7) & (F.abs(f["e2"] - g["s2"]) <= 50) & _near(F.least(f["e1"], g["s1"]), "L", pad, near) & _near(F.greatest(f["e1"], g["s1"]), "R", pad, near)
    dup = two & (F.array_min(ref) >= 100)
    inv = (F.size("frags") >= 2) & (F.array_min(ref) - 1 >= min_flank)
    ins = ~p["all_aligned"] & ~p["is_reference"]
    fit = F.when(F.col("sv_type") == "DEL", dele).when(F.col("sv_type") == "DUP", dup).when(F.col("sv_type") == "INV", inv).when(F.col("sv_type") == "INS", ins)
    return alignments.where(F.coalesce(fit, F.lit(False)))


def alignment_features(good: DataFrame) -> DataFrame:
    return good.groupBy("call_id").agg(F.count("*").alias("n_good"), F.max(predicates()["flank_percent"]).alias("flank_percent"), F.max(F.size("frags")).alias("n_frags"), F.max("pct_identity").alias("pct_identity"))


def spaced(places: Column, window: int = WINDOW) -> Column:
    """Of sorted places each that is at least a window from the last one taken."""
    empty = F.array().cast("array<bigint>")
    return F.aggregate(F.array_sort(places), empty, lambda a, x: F.when((F.size(a) == 0) | (x - F.element_at(a, -1) >= window), F.array_append(a, x)).otherwise(a))


def _two_breakpoints(places: DataFrame, pad: int) -> DataFrame:
    """`call_id, start_pos, at` to the calls with just two spaced places: bp1, bp2, bp_len."""
    taken = places.groupBy("call_id", "start_pos").agg(spaced(F.collect_list("at")).alias("bps")).where(F.size("bps") == 2)
    first, second = F.col("start_pos") - pad + F.col("bps")[0], F.col("start_pos") - pad + F.col("bps")[1]
    return taken.select("call_id", first.alias("bp1"), second.alias("bp2"), (second - first).alias("bp_len"))


def deletion_breakpoints(good: DataFrame, pad: int = PAD) -> DataFrame:
    """The inner ends of both fragments, over all of a call's alignments."""
    f, g = F.get("frags", F.lit(0)), F.get("frags", F.lit(1))
    return _two_breakpoints(good.where("sv_type = 'DEL'").select("call_id", "start_pos", F.explode(F.array(f["e1"], g["s1"])).alias("at")), pad)


def _ends(x: Column) -> Column:
    """A fragment with its lesser and greater end on the reference, and the contig's ends there."""
    rising = x["s1"] <= x["e1"]
    return F.struct(F.least(x["s1"], x["e1"]).alias("low"), F.greatest(x["s1"], x["e1"]).alias("high"), F.when(rising, x["s2"]).otherwise(x["e2"]).alias("at_low"), F.when(rising, x["e2"]).otherwise(x["s2"]).alias("at_high"))


def duplication_breakpoints(good: DataFrame, pad: int = PAD, near: int = NEAR, contig_gap: int = 10) -> DataFrame:
    """The left end of the fragment at the left, and the right end of that at the right, that meet on the contig.

    If both fragments could be either, the assignment nearer the expected places counts.
    """
    rows = good.where("sv_type = 'DUP'").withColumn("e", F.explode(F.array(F.transform("frags", _ends))))
    a, b = F.col("e")[0], F.col("e")[1]
    left = lambda x: F.abs(x["low"] - pad)
    right = lambda x: F.abs(x["high"] - (F.col("ref_len") - pad))
    ab, ba = (left(a) < near) & (right(b) < near), (left(b) < near) & (right(a) < near)
    swap = F.when(ab & ba, left(b) + right(a) <= left(a) + right(b)).otherwise(ba)
    rows = rows.where(ab | ba).withColumn("swap", swap)
    l_low, l_at, l_far = (F.when(F.col("swap"), b[k]).otherwise(a[k]) for k in ("low", "at_low", "at_high"))
    r_high, r_at, r_far = (F.when(F.col("swap"), a[k]).otherwise(b[k]) for k in ("high", "at_high", "at_low"))
    border = F.greatest(F.least(l_far, r_far), F.least(l_far, r_far) - F.col("contig_len")) > contig_gap
    met = rows.where((F.abs(l_at - r_at) <= contig_gap) & ~border)
    return _two_breakpoints(met.select("call_id", "start_pos", F.explode(F.array(l_low, r_high)).alias("at")), pad)


def inversion_breakpoints(good: DataFrame, pad: int = PAD, near: int = NEAR, contig_gap: int = 10, min_fragment: int = 50, min_border: int = 10, most_overlap: int = 10, most_gap: int = 50) -> DataFrame:
    """Where an inverted fragment and a normal one beside it meet on the contig.

    Of a contig's fragments of some length the inverted one has both ends at the expected places, the
    one with the nearest ends if there are several. If there is none, the inversion is longer than its
    contig shows: then it has one end at its place while another fragment lies beyond the other side of that place. The
    normal one ends at an expected place and runs the other way; the longest counts. Where the whole inversion fits
    into the contig, both must also meet on the reference, and the inverted one must not reach the contig's border.
    """
    of_contig = W.partitionBy("call_id", "contig_id")
    n = lambda c: F.sum(F.when(c, 1).otherwise(0)).over(of_contig)
    begins, ends, before, after = (F.col(c) for c in ("begins", "ends", "before", "after"))
    left, right = F.lit(pad), F.col("ref_len") - pad
    rows = good.where("sv_type = 'INV'").select("call_id", "contig_id", "start_pos", "ref_len", "contig_len", F.posexplode("frags").alias("i", "x"))
    rows = rows.where((F.abs(F.col("x.e1") - F.col("x.s1")) > min_fragment) & (F.abs(F.col("x.e2") - F.col("x.s2")) > min_fragment))
    rows = rows.withColumns({"turned": F.sign(F.col("x.e1") - F.col("x.s1")) != F.sign(F.col("x.e2") - F.col("x.s2")), "e": _ends(F.col("x"))}).select("*", "e.*").drop("x", "e")
    rows = rows.where(F.col("high") - F.col("low") <= F.greatest(F.col("ref_len") - 2 * (pad - near), F.lit(pad + near)))
    places = {"begins": ("low", left), "ends": ("high", right), "before": ("high", left), "after": ("low", right)}
    rows = rows.withColumns({k: F.abs(F.col(c) - side) < near for k, (c, side) in places.items()}).withColumn("beside", before | after)
    rows = rows.withColumns({"n": F.count("*").over(of_contig), "n_full": n(begins & ends), "n_beside": n(F.col("beside")), "n_before": n(before), "n_after": n(after)}).where("n >= 2")
    rows = rows.withColumn("full", begins & ends & ~((F.col("n_full") > 1) & (F.col("n_beside") <= 1) & F.col("beside")))
    others = lambda c, count: F.col(count) - c.cast("int") > 0
    rows = rows.withColumn("open", (n(F.col("full")) == 0) & ((begins & others(after, "n_after")) | (ends & others(before, "n_before"))))
    middle = F.col("low") + F.col("high")
    one_end = F.col("open") & ((n(F.col("open")) == 1) | (begins & (middle > 2 * left)) | (ends & (middle < 2 * right)))
    off_left, off_right = F.abs(F.col("low") - left), F.abs(F.col("high") - right)
    off = F.when(F.col("full"), off_left + off_right).when(begins, off_left).otherwise(off_right)
    shape = ["low", "high", "at_low", "at_high"]
    chosen = F.min(F.when(F.col("full") | one_end, F.struct(off.alias("off"), "i", *shape, "turned", "begins", "full"))).over(of_contig)
    rows = rows.withColumn("v", chosen).where("v is not null")
    v, o = F.col("v"), F.col("o")
    facing = F.col("beside") & (F.col("i") != v["i"]) & (F.col("turned") != v["turned"]) & (v["full"] | F.when(v["begins"], after).otherwise(before))
    rows = rows.where(facing).groupBy("call_id", "contig_id", "start_pos", "ref_len", "contig_len", "v").agg(F.max(F.struct((F.col("high") - F.col("low")).alias("size"), (-F.col("i")).alias("i"), *shape)).alias("o"))
    beyond, short_of = o["high"] > v["high"], o["low"] < v["low"]
    apart = F.when(beyond, o["low"] - v["high"]).when(short_of, v["low"] - o["high"]).otherwise(0)
    border = F.least(v["at_low"], v["at_high"], F.abs(v["at_low"] - F.col("contig_len")), F.abs(v["at_high"] - F.col("contig_len")))
    long = ~v["full"] | (F.col("ref_len") > 2 * pad + min_fragment)
    pair = rows.where(((o["low"] - v["low"]) * (o["high"] - v["high"]) > 0) & (long | ((border >= min_border) & apart.between(-most_overlap, most_gap))))
    bp1, bp2 = F.when(beyond, v["low"]).otherwise(v["high"]), F.when(beyond, o["low"]).otherwise(o["high"])
    on_contig = F.when(beyond, v["at_low"] - o["at_low"]).otherwise(v["at_high"] - o["at_high"])
    return _two_breakpoints(pair.where(F.abs(on_contig) <= contig_gap).select("call_id", "start_pos", F.explode(F.array(bp1, bp2)).alias("at")), pad)


def insertion_breakpoints(good: DataFrame, all_alignments: DataFrame, pad: int = PAD, window: int = WINDOW, min_fragment: int = 200, near: int = 50, near_clip: int = 100) -> DataFrame:
    """The one place where fragments end from both sides and no alignment runs through.

    `bp1, bp2 = bp1 + 1, bp_len`: the longest insertion that an alignment shows there, or 0.
    """
    frags = good.where("sv_type = 'INS'").select("call_id", "start_pos", "end_pos", F.explode("frags").alias("x")).select("call_id", "start_pos", "end_pos", _ends(F.col("x")).alias("e")).where(F.col("e.high") - F.col("e.low") >= min_fragment)
    frags = frags.select("call_id", "start_pos", "end_pos", F.col("e.low").alias("low"), F.col("e.high").alias("high"))
    per = frags.groupBy("call_id", "start_pos", "end_pos").agg(F.collect_set("low").alias("lows"), F.collect_set("high").alias("highs"))
    inner = F.array_sort(F.array_union("lows", "highs"))
    places = per.select("call_id", "start_pos", "end_pos", "lows", "highs", F.explode(F.slice(inner, F.lit(2), F.size(inner) - 2)).alias("at"))
    supported = places.where(F.exists("lows", lambda x: F.abs(x - F.col("at")) <= window) & F.exists("highs", lambda x: F.abs(x - F.col("at")) <= window))
    p = predicates()
    f, g = F.get("frags", F.lit(0)), F.get("frags", F.lit(1))
    ends = F.array(f["s1"], f["e1"], g["s1"], g["e1"])
    seen = all_alignments.where(F.size("frags") == 2).select("call_id", ends.alias("ends"), (p["long_ref_flanks"] & (p["ref_deletion"] | (p["insertion"] & (_gap(f["e2"], g["s2"]) >= 20)))).alias("against"), F.when((_gap(f["e2"], g["s2"]) >= 50) & (_gap(f["e1"], g["s1"]) <= window), _gap(f["e2"], g["s2"])).otherwise(0).alias("ins_len"))
    met = supported.join(seen, "call_id", "left").withColumn("here", F.coalesce(F.exists("ends", lambda x: F.abs(x - F.col("at")) <= window), F.lit(False)))
    judged = met.groupBy("call_id", "start_pos", "end_pos", "at").agg(F.max(F.col("here") & F.coalesce("against", F.lit(False))).alias("against"), F.max(F.when(F.col("here"), F.col("ins_len")).otherwise(0)).alias("ins_len")).where("not against")
    span = F.col("end_pos") - F.col("start_pos")
    taken = judged.groupBy("call_id", "start_pos", "end_pos").agg(F.array_sort(F.collect_list(F.struct("at", "ins_len"))).alias("c"))
    first = F.aggregate("c", F.array().cast("array<struct<at:bigint,ins_len:bigint>>"), lambda a, x: F.when((F.size(a) == 0) | (x["at"] - F.element_at(a, -1)["at"] > window), F.array_append(a, x)).otherwise(a))
    expected = lambda x: F.least(F.abs(x["at"] - pad), F.abs(x["at"] - (span + pad))) < near
    taken = taken.withColumn("c", first).withColumn("c", F.when(F.size("c") > 1, F.filter("c", expected)).otherwise(F.col("c"))).where(F.size("c") == 1)
    at = F.col("start_pos") - pad + F.col("c")[0]["at"]
    return taken.where(F.least(F.abs(at - F.col("start_pos")), F.abs(at - F.col("end_pos"))) <= near_clip).select("call_id", at.alias("bp1"), (at + 1).alias("bp2"), F.col("c")[0]["ins_len"].alias("bp_len"))


def attach(calls: DataFrame, found: DataFrame, pad: int = PAD) -> DataFrame:
    """Breakpoints on their calls, with method AS; calls without keep their own ends and a length of -1. Calls too near the start go."""
    out = calls.where(F.col("start_pos") >= pad).join(found, "call_id", "left")
    hit = F.col("bp1").isNotNull()
    methods = F.when(hit & ~F.array_contains("methods", "AS"), F.array_append("methods", F.lit("AS"))).otherwise(F.col("methods"))
    return out.withColumns({"methods": methods, "bp2": F.when(hit, F.col("bp2")).otherwise(F.col("end_pos")), "bp_len": F.coalesce("bp_len", F.lit(-1)), "bp1": F.coalesce("bp1", "start_pos")})
