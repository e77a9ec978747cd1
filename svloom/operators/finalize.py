"""Final calls: verdicts, confused insertions, and complex events made of deletions, duplications and insertions.

Duplications with a deletion at one end become interspersed duplications (IDP); two of these
that share an inserted place become a translocation inside a chromosome (ITX); a deletion
that matches where an insertion's mates lie becomes one between chromosomes (CTX). Parts of
events with a good verdict go, parts of doubtful events stay as calls.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import constants as C
from .intervals import anti_overlap, overlap_join, reciprocal

NEAR = 10


def chosen_type(types: Column) -> Column:
    """The packed type that counts."""
    return F.get(F.filter(F.array(*map(F.lit, C.TYPE_ORDER)), lambda x: F.array_contains(types, x)), F.lit(0))


def final_verdicts(calls: DataFrame, pass_only: bool = False) -> DataFrame:
    """`call_id, types, methods, gt, start_pos, end_pos, sv_len, bp1, bp2, bp_len` to final coordinates and filter.

    Reference genotypes, unknown types and positions below 1 go.
    """
    rows = calls.where(F.coalesce(F.col("gt"), F.lit("./.")) != "0/0").withColumn("sv_type", chosen_type(F.col("types"))).where("sv_type is not null")
    has = lambda m: F.array_contains("methods", m)
    own = F.size(F.array_except("methods", F.array(F.lit("SC"), F.lit("AS"))))
    ins = F.col("sv_type") == "INS"
    use = has("AS") | (ins & has("SC"))
    length = F.when(use & (F.col("bp_len") >= 0), F.col("bp_len")).otherwise(F.col("sv_len"))
    rows = rows.withColumns({"pos": F.when(use, F.col("bp1")).otherwise(F.col("start_pos")), "end": F.when(use, F.col("bp2")).otherwise(F.col("end_pos")), "len": length})
    if pass_only:
        rows = rows.where(~ins | (F.col("end") == F.col("pos") + 1))
    two = F.when(has("AS"), F.col("bp_len") >= 100).otherwise(own > 1)
    one = (F.col("bp_len") != -1) & ((F.col("len") == 0) | (F.col("len") >= 100)) & (has("SC") | has("AS") | (own > 1))
    verdict = F.when(F.when(ins, one).otherwise(two), "PASS").otherwise("LowQual")
    out = rows.where("pos >= 1").withColumn("filter", verdict)
    return out.select("call_id", "chrom", "sv_type", F.col("pos").alias("start_pos"), F.when(ins, F.col("pos")).otherwise(F.col("end")).alias("end_pos"), F.when(F.col("sv_type") == "DEL", -F.col("len")).otherwise(F.col("len")).alias("sv_len"), "filter", F.coalesce("gt", F.lit("./.")).alias("gt"))


def without_confused_insertions(calls: DataFrame, wiggle: int = 20) -> DataFrame:
    """Without insertions near one that lies near an end of a good deletion or inversion."""
    ins = calls.where("sv_type = 'INS'").select("call_id", "chrom", "start_pos", (F.col("start_pos") + 1).alias("end_pos"))
    good = calls.where("sv_type in ('DEL', 'INV') and filter <> 'LowQual'")
    ends = good.select("chrom", F.explode(F.array("start_pos", "end_pos")).alias("at")).select("chrom", F.greatest(F.lit(0), F.col("at") - wiggle).alias("start_pos"), (F.col("at") + wiggle).alias("end_pos")).distinct()
    bad = overlap_join(ins, ends, wiggle).select("chrom", "start_pos", "end_pos").distinct()
    confused = overlap_join(ins, bad, wiggle).select("call_id").distinct()
    return calls.join(confused, "call_id", "left_anti")


def mate_windows(histogram: DataFrame, share: float = 0.15) -> DataFrame:
    """`call_id, chrom, mate_chrom, n, low, high` rows to the windows that hold more than a share of an insertion's reads."""
    # Dealt by the call from the start: its counts are grouped and totalled where they are.
    per = histogram.repartition("call_id").groupBy("call_id", "chrom", "mate_chrom").agg(F.sum("n").alias("n"), F.min("low").alias("start_pos"), F.max("high").alias("end_pos"))
    all_ = F.sum("n").over(W.partitionBy("call_id"))
    return per.withColumn("all", all_).where((F.col("n") > share * F.col("all")) & (F.col("mate_chrom") != "-1") & (F.col("mate_chrom") != F.col("chrom"))).select("call_id", F.col("mate_chrom").alias("chrom"), "start_pos", "end_pos", "n")


def _worst(*filters: Column) -> Column:
    bad = filters[0] == "LowQual"
    for f in filters[1:]:
        bad = bad | (f == "LowQual")
    return F.when(bad, "LowQual").otherwise("PASS")


def interspersed(dups: DataFrame, dels: DataFrame, near: int = NEAR) -> DataFrame:
    """Pairs of a duplication and a shorter deletion with an end in common: dup_id, del_id, bounds, the deletion's far end `del_pos`."""
    columns = ["call_id", "chrom", "start_pos", "end_pos", "filter"]
    met = overlap_join(dups.select(*columns), dels.select(*columns), near)
    left, right = F.abs(F.col("b_start_pos") - F.col("start_pos")), F.abs(F.col("b_end_pos") - F.col("end_pos"))
    fits = (F.col("b_end_pos") - F.col("b_start_pos") <= F.col("end_pos") - F.col("start_pos") - near) & (F.least(left, right) <= near)
    return met.where(fits).select(
        F.col("call_id").alias("dup_id"), F.col("b_call_id").alias("del_id"), "chrom", "start_pos", "end_pos", F.when(left > right, F.col("b_start_pos")).otherwise(F.col("b_end_pos")).alias("del_pos"),
        F.col("b_start_pos").alias("del_start"), F.col("b_end_pos").alias("del_end"), _worst(F.col("filter"), F.col("b_filter")).alias("filter"),
    )


def inner_translocations(idps: DataFrame, near: int = NEAR) -> DataFrame:
    """Pairs of interspersed duplications whose deletions end at the same place from opposite sides."""
    met = overlap_join(idps, idps, near)
    close = F.least(F.abs(F.col("start_pos") - F.col("b_start_pos")), F.abs(F.col("end_pos") - F.col("b_end_pos"))) <= near
    at_left = lambda p: F.abs(F.col(p + "del_pos") - F.col(p + "del_start")) < F.abs(F.col(p + "del_pos") - F.col(p + "del_end"))
    kept = met.where(close & (F.abs(F.col("del_pos") - F.col("b_del_pos")) <= near) & ~at_left("") & at_left("b_"))
    return kept.select(
        F.col("dup_id"), F.col("del_id").alias("del_id1"), F.col("b_dup_id").alias("dup_id2"), F.col("b_del_id").alias("del_id2"), "chrom", "start_pos", "end_pos", F.floor((F.col("del_pos") + F.col("b_del_pos")) / 2).alias("del_pos"),
        F.col("del_start").alias("del_start1"), F.col("del_end").alias("del_end1"), F.col("b_del_start").alias("del_start2"), F.col("b_del_end").alias("del_end2"), _worst(F.col("filter"), F.col("b_filter")).alias("filter"),
    )


def remaining_interspersed(idps: DataFrame, itxs: DataFrame, near: int = NEAR) -> DataFrame:
    """Interspersed duplications that no good inner translocation used up: those near none, and near ones whose deletion it doesn't hold."""
    good = itxs.where("filter <> 'LowQual'")
    used = overlap_join(idps, good.select("chrom", "start_pos", "end_pos", "del_start1", "del_end1", "del_start2", "del_end2"), near)
    mine = ((F.col("b_del_start1") == F.col("del_start")) & (F.col("b_del_end1") == F.col("del_end"))) | ((F.col("b_del_start2") == F.col("del_start")) & (F.col("b_del_end2") == F.col("del_end")))
    return idps.join(used.where(mine).select("dup_id", "del_id").distinct(), ["dup_id", "del_id"], "left_anti")


def not_matched(calls: DataFrame, events: DataFrame, start: str = "start_pos", end: str = "end_pos", ratio: float = 0.95) -> DataFrame:
    """Calls that no event's interval matches almost wholly."""
    parts = events.select("chrom", F.col(start).alias("start_pos"), F.col(end).alias("end_pos")).distinct()
    return anti_overlap(calls, parts, "call_id", ratio=ratio)


def outer_translocations(dels: DataFrame, windows: DataFrame, ratio: float = 0.9) -> DataFrame:
    """Deletions that reciprocally match the window of an insertion's mates."""
    met = overlap_join(dels.select("call_id", "chrom", "start_pos", "end_pos", "filter"), windows.select(F.col("call_id").alias("ins_id"), "chrom", "start_pos", "end_pos", "filter")).where(reciprocal(ratio))
    return met.select(F.col("call_id").alias("del_id"), F.col("b_ins_id").alias("ins_id"), "chrom", "start_pos", "end_pos", _worst(F.col("filter"), F.col("b_filter")).alias("filter"))


def recovered(parts: DataFrame) -> DataFrame:
    """`call_id, filter` of all events' parts to those that come back: in doubtful events only."""
    bad = parts.where("filter = 'LowQual'").select("call_id").distinct()
    return bad.join(parts.where("filter <> 'LowQual'").select("call_id"), "call_id", "left_anti")


def idp_rows(idps: DataFrame) -> DataFrame:
    """Event rows of interspersed duplications: where the copy goes, and from where."""
    at_left = F.abs(F.col("del_pos") - F.col("del_start")) < F.abs(F.col("del_pos") - F.col("del_end"))
    pos = F.when(at_left, F.col("start_pos")).otherwise(F.col("del_pos"))
    end = F.when(at_left, F.greatest("del_pos", "start_pos")).otherwise(F.greatest("end_pos", "del_pos"))
    pos2 = F.when(at_left, F.col("end_pos")).otherwise(F.col("start_pos"))
    parts = F.concat(F.lit("DUP-"), F.concat_ws("-", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string")), F.lit(",DEL-"), F.concat_ws("-", "chrom", F.col("del_start").cast("string"), F.col("del_end").cast("string")))
    return idps.select("dup_id", "del_id", "chrom", F.lit("IDP").alias("sv_type"), pos.alias("start_pos"), end.alias("end_pos"), pos2.alias("pos2"), F.greatest(end - pos, F.lit(0)).alias("sv_len"), parts.alias("intervals"), "filter")


def itx_rows(itxs: DataFrame) -> DataFrame:
    end = F.greatest("del_pos", "start_pos")
    text = lambda a, b: F.concat(F.lit("DEL-"), F.concat_ws("-", "chrom", F.col(a).cast("string"), F.col(b).cast("string")))
    parts = F.concat_ws(",", F.concat(F.lit("DUP-"), F.concat_ws("-", "chrom", F.col("start_pos").cast("string"), F.col("end_pos").cast("string"))), text("del_start1", "del_end1"), text("del_start2", "del_end2"))
    return itxs.select("dup_id", "del_id1", "del_id2", "chrom", F.lit("ITX").alias("sv_type"), "start_pos", end.alias("end_pos"), F.col("end_pos").alias("pos2"), F.greatest(end - F.col("start_pos"), F.lit(0)).alias("sv_len"), parts.alias("intervals"), "filter")


def ctx_rows(ctxs: DataFrame, ins: DataFrame) -> DataFrame:
    at = ins.select(F.col("call_id").alias("ins_id"), F.col("chrom").alias("chrom2"), F.col("start_pos").alias("pos2"))
    span = lambda *c: F.concat_ws("-", *[F.col(x).cast("string") for x in c])
    return ctxs.join(at, "ins_id").select("del_id", "ins_id", "chrom", "chrom2", F.lit("CTX").alias("sv_type"), "start_pos", "end_pos", "pos2", F.concat(F.lit("DEL-"), span("chrom", "start_pos", "end_pos"), F.lit(",INS-"), span("chrom2", "pos2", "pos2")).alias("intervals"), "filter")


def without_info(calls: DataFrame, keys: Sequence[str]) -> DataFrame:
    return calls.withColumn("info", F.map_filter("info", lambda k, _: ~k.isin(*keys)))
