"""Queries over final calls, complex events, and split alignments."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Inputs
from ..operators import breakpoints, filters, finalize
from ..sources import sinks
from ..sources.sequence import with_reference
from .registry import query

FILTER_SQL = "fc AS MATERIALIZED (SELECT *, CASE WHEN call_id % 5 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter FROM calls)"


def kept_calls(t: Inputs) -> DataFrame:
    """The calls with what events are made of, for queries that go through them more than once."""
    return t.kept("calls", ("sample", "chrom2", "sv_len", "source"))


def filtered(t: Inputs) -> DataFrame:
    return kept_calls(t).withColumn("filter", F.when(F.col("call_id") % 5 == 0, "LowQual").otherwise("PASS"))


def dups(t: Inputs) -> DataFrame:
    return filtered(t).where("sv_type = 'DUP'")


def dels(t: Inputs) -> DataFrame:
    return filtered(t).where("sv_type = 'DEL'")


def packed(t: Inputs) -> DataFrame:
    """Calls as they come from the refinement: a second type on some, soft clips or assembly as methods, refined ends."""
    own = filters.methods_of(F.array("source"))
    more = F.when(F.col("call_id") % 3 == 0, F.array(F.lit("SC"))).when(F.col("call_id") % 7 == 0, F.array(F.lit("AS"))).otherwise(F.array().cast("array<string>"))
    types = F.when(F.col("call_id") % 11 == 0, F.array("sv_type", F.lit("INV"))).otherwise(F.array("sv_type"))
    gt = F.element_at(F.array(*map(F.lit, ("0/0", "0/1", "1/1"))), (F.col("call_id") % 3 + 1).cast("int"))
    return t.calls.withColumns({"methods": F.array_union(own, more), "types": types, "gt": F.when(F.col("call_id") % 2 == 0, gt), "bp1": F.col("start_pos") + 3, "bp2": F.col("end_pos") + 4, "bp_len": F.when(F.col("call_id") % 4 == 0, -1).otherwise(F.col("sv_len"))})


FINAL_SQL = """pk AS (SELECT *, call_id % 3 = 0 AS sc, (call_id % 3 <> 0 AND call_id % 7 = 0) OR source = 'HaplotypeCaller' AS asm, CASE WHEN source IN ('Manta', 'Lumpy') THEN 2 WHEN source = 'HaplotypeCaller' THEN 0 ELSE 1 END AS own,
  CASE WHEN call_id % 2 = 0 THEN CASE call_id % 3 WHEN 0 THEN '0/0' WHEN 1 THEN '0/1' ELSE '1/1' END ELSE './.' END AS gt, CASE WHEN call_id % 4 = 0 THEN -1 ELSE sv_len END AS bl,
  CASE WHEN sv_type = 'DEL' THEN 'DEL' WHEN call_id % 11 = 0 OR sv_type = 'INV' THEN 'INV' ELSE sv_type END AS st FROM calls),
pu AS (SELECT *, asm OR (st = 'INS' AND sc) AS u FROM pk WHERE gt <> '0/0'), pv AS (SELECT *, CASE WHEN u THEN start_pos + 3 ELSE start_pos END AS pos, CASE WHEN u THEN end_pos + 4 ELSE end_pos END AS e, CASE WHEN u AND bl >= 0 THEN bl ELSE sv_len END AS len FROM pu),
fin AS MATERIALIZED (SELECT call_id, chrom, st AS sv_type, pos AS start_pos, CASE WHEN st = 'INS' THEN pos ELSE e END AS end_pos, CASE WHEN st = 'DEL' THEN -len ELSE len END AS sv_len,
  CASE WHEN CASE WHEN st = 'INS' THEN bl <> -1 AND (len = 0 OR len >= 100) AND (sc OR asm OR own > 1) WHEN asm THEN bl >= 100 ELSE own > 1 END THEN 'PASS' ELSE 'LowQual' END AS filter, gt FROM pv WHERE pos >= 1)"""


@query("final_filter", f"WITH {FINAL_SQL} SELECT * FROM fin", ("calls",))
def final_filter(t: Inputs) -> DataFrame:
    return finalize.final_verdicts(packed(t))


@query("final_bed_to_vcf", f"WITH {FINAL_SQL} SELECT contig_ord, call_id, concat_ws(chr(9), chrom, start_pos, '.', coalesce(substr(seq, (start_pos - 1) % 64 + 1, 1), 'N'), '<' || sv_type || '>', '.', filter, 'SVTYPE=' || sv_type || ';SVLEN=' || sv_len || ';END=' || end_pos, 'GT', gt) AS value FROM fin JOIN contigs USING (chrom) LEFT JOIN (SELECT chrom AS seq_chrom, chunk, seq FROM sequence) ON seq_chrom = chrom AND chunk = (start_pos - 1) // 64", ("calls", "contigs", "sequence"))
def final_bed_to_vcf(t: Inputs) -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    info = F.concat(F.lit("SVTYPE="), "sv_type", F.lit(";SVLEN="), text("sv_len"), F.lit(";END="), text("end_pos"))
    line = F.concat_ws("\t", "chrom", text("start_pos"), F.lit("."), "ref_base", F.concat(F.lit("<"), "sv_type", F.lit(">")), F.lit("."), "filter", info, F.lit("GT"), "gt")
    return sinks.in_contig_order(with_reference(finalize.final_verdicts(packed(t)), t.sequence, 64).withColumn("value", line), t.contigs).select("contig_ord", "call_id", "value")


@query(
    "flt_confused_ins",
    f"""WITH {FILTER_SQL}, ins AS MATERIALIZED (SELECT * FROM fc WHERE sv_type = 'INS'), bp AS (SELECT DISTINCT chrom, greatest(0, at_ - 20) AS s, at_ + 20 AS e FROM (SELECT chrom, unnest([start_pos, end_pos]) AS at_ FROM fc WHERE sv_type IN ('DEL', 'INV') AND filter <> 'LowQual')),
    bad AS MATERIALIZED (SELECT DISTINCT i.chrom, i.start_pos FROM ins i JOIN bp ON bp.chrom = i.chrom AND greatest(i.start_pos - 20, bp.s) < least(i.start_pos + 21, bp.e)),
    conf AS (SELECT DISTINCT i.call_id FROM ins i JOIN bad b ON b.chrom = i.chrom AND greatest(i.start_pos - 20, b.start_pos) < least(i.start_pos + 21, b.start_pos + 1))
    SELECT call_id FROM fc WHERE call_id NOT IN (SELECT call_id FROM conf)""",
    ("calls",),
)
def flt_confused_ins(t: Inputs) -> DataFrame:
    return finalize.without_confused_insertions(filtered(t)).select("call_id")


HIST_SQL = "hs AS MATERIALIZED (SELECT call_id, chrom, CAST((call_id * 7 + k * 3) % 8 + 1 AS VARCHAR) AS mate_chrom, 1 + (call_id + k) % 9 AS n, start_pos + k * 40 AS low, start_pos + k * 40 + 600 AS high FROM calls, (SELECT unnest([0, 1, 2]) AS k) WHERE sv_type = 'INS')"
MATE_SQL = (
    HIST_SQL
    + ", hp AS (SELECT call_id, chrom, mate_chrom, CAST(sum(n) AS BIGINT) AS n, min(low) AS start_pos, max(high) AS end_pos FROM hs GROUP BY call_id, chrom, mate_chrom), mw AS MATERIALIZED (SELECT call_id, mate_chrom AS chrom, start_pos, end_pos, n FROM (SELECT *, sum(n) OVER (PARTITION BY call_id) AS tot FROM hp) WHERE n > 0.15 * tot AND mate_chrom <> chrom)"
)


def histogram(calls: DataFrame) -> DataFrame:
    rows = calls.where("sv_type = 'INS'").withColumn("k", F.explode(F.array(F.lit(0), F.lit(1), F.lit(2))))
    return rows.select("call_id", "chrom", ((F.col("call_id") * 7 + F.col("k") * 3) % 8 + 1).cast("string").alias("mate_chrom"), (1 + (F.col("call_id") + F.col("k")) % 9).alias("n"), (F.col("start_pos") + F.col("k") * 40).alias("low"), (F.col("start_pos") + F.col("k") * 40 + 600).alias("high"))


@query("ins_chr2", f"WITH {MATE_SQL} SELECT * FROM mw", ("calls",))
def ins_chr2(t: Inputs) -> DataFrame:
    return finalize.mate_windows(histogram(t.calls))


IDP_SQL = (
    FILTER_SQL
    + """,
ip AS MATERIALIZED (SELECT a.call_id AS dup_id, b.call_id AS del_id, a.chrom, a.start_pos, a.end_pos, CASE WHEN abs(b.start_pos - a.start_pos) > abs(b.end_pos - a.end_pos) THEN b.start_pos ELSE b.end_pos END AS del_pos, b.start_pos AS del_start, b.end_pos AS del_end,
  CASE WHEN a.filter = 'LowQual' OR b.filter = 'LowQual' THEN 'LowQual' ELSE 'PASS' END AS filter
  FROM fc a JOIN fc b ON a.sv_type = 'DUP' AND b.sv_type = 'DEL' AND a.chrom = b.chrom AND greatest(a.start_pos - 10, b.start_pos) < least(a.end_pos + 10, b.end_pos) AND b.end_pos - b.start_pos <= a.end_pos - a.start_pos - 10
    AND least(abs(b.start_pos - a.start_pos), abs(b.end_pos - a.end_pos)) <= 10)"""
)
#: The fixture holds few translocations, so they are looked for with a wider tolerance.
ITX_NEAR = 400
ITX_SQL = (
    IDP_SQL
    + f""",
ix AS MATERIALIZED (SELECT a.dup_id, a.del_id AS del_id1, b.dup_id AS dup_id2, b.del_id AS del_id2, a.chrom, a.start_pos, a.end_pos, (a.del_pos + b.del_pos) // 2 AS del_pos, a.del_start AS del_start1, a.del_end AS del_end1, b.del_start AS del_start2, b.del_end AS del_end2,
  CASE WHEN a.filter = 'LowQual' OR b.filter = 'LowQual' THEN 'LowQual' ELSE 'PASS' END AS filter
  FROM ip a JOIN ip b ON a.chrom = b.chrom AND greatest(a.start_pos - {ITX_NEAR}, b.start_pos) < least(a.end_pos + {ITX_NEAR}, b.end_pos) AND least(abs(a.start_pos - b.start_pos), abs(a.end_pos - b.end_pos)) <= {ITX_NEAR} AND abs(a.del_pos - b.del_pos) <= {ITX_NEAR}
    AND NOT abs(a.del_pos - a.del_start) < abs(a.del_pos - a.del_end) AND abs(b.del_pos - b.del_start) < abs(b.del_pos - b.del_end)),
il AS MATERIALIZED (SELECT * FROM ip WHERE NOT EXISTS (SELECT 1 FROM ix WHERE ix.filter <> 'LowQual' AND ix.chrom = ip.chrom AND greatest(ip.start_pos - {ITX_NEAR}, ix.start_pos) < least(ip.end_pos + {ITX_NEAR}, ix.end_pos)
  AND ((ix.del_start1 = ip.del_start AND ix.del_end1 = ip.del_end) OR (ix.del_start2 = ip.del_start AND ix.del_end2 = ip.del_end))))"""
)


def idps(t: Inputs) -> DataFrame:
    return finalize.interspersed(dups(t), dels(t))


def itxs(t: Inputs) -> DataFrame:
    return finalize.inner_translocations(idps(t), ITX_NEAR)


@query("res_idp", f"WITH {IDP_SQL} SELECT * FROM ip", ("calls",))
def res_idp(t: Inputs) -> DataFrame:
    return idps(t)


@query("res_itx", f"WITH {ITX_SQL} SELECT * FROM ix", ("calls",))
def res_itx(t: Inputs) -> DataFrame:
    return itxs(t)


@query("res_idp_left", f"WITH {ITX_SQL} SELECT dup_id, del_id FROM il", ("calls",))
def res_idp_left(t: Inputs) -> DataFrame:
    return finalize.remaining_interspersed(idps(t), itxs(t), ITX_NEAR).select("dup_id", "del_id")


MATCH = "least(c.end_pos, p.{e}) - greatest(c.start_pos, p.{s}) > 0 AND least(c.end_pos, p.{e}) - greatest(c.start_pos, p.{s}) >= 0.95 * greatest(c.end_pos - c.start_pos, p.{e} - p.{s})"


@query("res_dup_left", f"WITH {IDP_SQL} SELECT call_id FROM fc c WHERE sv_type = 'DUP' AND NOT EXISTS (SELECT 1 FROM ip p WHERE p.chrom = c.chrom AND {MATCH.format(s='start_pos', e='end_pos')})", ("calls",))
def res_dup_left(t: Inputs) -> DataFrame:
    return finalize.not_matched(dups(t), idps(t)).select("call_id")


DEL_LEFT_SQL = IDP_SQL + f", dl AS MATERIALIZED (SELECT * FROM fc c WHERE sv_type = 'DEL' AND NOT EXISTS (SELECT 1 FROM ip p WHERE p.chrom = c.chrom AND {MATCH.format(s='del_start', e='del_end')}))"


@query("res_del_left", f"WITH {DEL_LEFT_SQL} SELECT call_id FROM dl", ("calls",))
def res_del_left(t: Inputs) -> DataFrame:
    return dels_left(t).select("call_id")


def dels_left(t: Inputs) -> DataFrame:
    return finalize.not_matched(dels(t), idps(t), "del_start", "del_end")


CTX_SQL = (
    DEL_LEFT_SQL
    + ", "
    + MATE_SQL
    + """, cx AS MATERIALIZED (SELECT c.call_id AS del_id, p.call_id AS ins_id, c.chrom, c.start_pos, c.end_pos, CASE WHEN c.filter = 'LowQual' OR p.call_id % 5 = 0 THEN 'LowQual' ELSE 'PASS' END AS filter
  FROM dl c JOIN mw p ON p.chrom = c.chrom AND least(c.end_pos, p.end_pos) - greatest(c.start_pos, p.start_pos) > 0 AND least(c.end_pos, p.end_pos) - greatest(c.start_pos, p.start_pos) >= 0.5 * greatest(c.end_pos - c.start_pos, p.end_pos - p.start_pos))"""
)


def ctxs(t: Inputs) -> DataFrame:
    windows = finalize.mate_windows(histogram(kept_calls(t))).withColumn("filter", F.when(F.col("call_id") % 5 == 0, "LowQual").otherwise("PASS"))
    return finalize.outer_translocations(dels_left(t), windows, ratio=0.5)


@query("res_ctx", f"WITH {CTX_SQL} SELECT * FROM cx", ("calls",))
def res_ctx(t: Inputs) -> DataFrame:
    return ctxs(t)


@query("res_recover", f"WITH {ITX_SQL}, pt AS (SELECT dup_id AS call_id, filter FROM il UNION ALL SELECT del_id, filter FROM il UNION ALL SELECT unnest([dup_id, del_id1, del_id2]), filter FROM ix) SELECT DISTINCT call_id FROM pt WHERE filter = 'LowQual' AND call_id NOT IN (SELECT call_id FROM pt WHERE filter <> 'LowQual')", ("calls",))
def res_recover(t: Inputs) -> DataFrame:
    inner = itxs(t)
    left = finalize.remaining_interspersed(idps(t), inner, ITX_NEAR)
    parts = left.select(F.explode(F.array("dup_id", "del_id")).alias("call_id"), "filter").unionByName(inner.select(F.explode(F.array("dup_id", "del_id1", "del_id2")).alias("call_id"), "filter"))
    return finalize.recovered(parts)


@query(
    "res_emit_idp_itx",
    f"""WITH {ITX_SQL}, a AS (SELECT *, abs(del_pos - del_start) < abs(del_pos - del_end) AS l FROM ip), b AS (SELECT *, CASE WHEN l THEN start_pos ELSE del_pos END AS pos, CASE WHEN l THEN greatest(del_pos, start_pos) ELSE greatest(end_pos, del_pos) END AS e FROM a)
    SELECT dup_id, 'IDP' AS sv_type, pos AS start_pos, e AS end_pos, CASE WHEN l THEN end_pos ELSE start_pos END AS pos2, greatest(e - pos, 0) AS sv_len, 'DUP-' || chrom || '-' || start_pos || '-' || end_pos || ',DEL-' || chrom || '-' || del_start || '-' || del_end AS intervals, filter FROM b
    UNION ALL SELECT dup_id, 'ITX', start_pos, greatest(del_pos, start_pos), end_pos, greatest(del_pos - start_pos, 0), 'DUP-' || chrom || '-' || start_pos || '-' || end_pos || ',DEL-' || chrom || '-' || del_start1 || '-' || del_end1 || ',DEL-' || chrom || '-' || del_start2 || '-' || del_end2, filter FROM ix""",
    ("calls",),
)
def res_emit_idp_itx(t: Inputs) -> DataFrame:
    columns = ["dup_id", "sv_type", "start_pos", "end_pos", "pos2", "sv_len", "intervals", "filter"]
    return finalize.idp_rows(idps(t)).select(*columns).unionByName(finalize.itx_rows(itxs(t)).select(*columns))


@query("res_emit_ctx", f"WITH {CTX_SQL} SELECT del_id, ins_id, i.chrom AS chrom2, i.start_pos AS pos2, 'DEL-' || cx.chrom || '-' || cx.start_pos || '-' || cx.end_pos || ',INS-' || i.chrom || '-' || i.start_pos || '-' || i.start_pos AS intervals FROM cx JOIN calls i ON i.call_id = cx.ins_id", ("calls",))
def res_emit_ctx(t: Inputs) -> DataFrame:
    return finalize.ctx_rows(ctxs(t), kept_calls(t).where("sv_type = 'INS'")).select("del_id", "ins_id", "chrom2", "pos2", "intervals")


@query("drop_info", "SELECT call_id, 'SOURCE=' || source AS info FROM calls", ("calls",))
def drop_info(t: Inputs) -> DataFrame:
    calls = t.calls.withColumn("info", F.create_map(F.lit("SOURCE"), F.col("source"), F.lit("SC_CHR2_STR"), F.lit("x")))
    entries = F.transform(F.map_entries("info"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return finalize.without_info(calls, ["SC_CHR2_STR"]).select("call_id", F.array_join(F.array_sort(entries), ";").alias("info"))


# Split alignments


def alignments(t: Inputs) -> DataFrame:
    return breakpoints.with_fragments(t.split_alignments)


@query("contig_group", "SELECT chrom, start_pos, end_pos, sv_type, count(*) AS n_contigs, max(contig_len) AS longest FROM split_alignments WHERE contig_len >= 200 AND end_pos - start_pos <= 1000000 GROUP BY ALL", ("split_alignments",))
def contig_group(t: Inputs) -> DataFrame:
    return breakpoints.grouped_contigs(alignments(t))


@query("aln_dedupe", "SELECT call_id, min(contig_id) AS contig_id FROM split_alignments GROUP BY call_id, f1_s1, f1_e1, f2_s1, f2_e1", ("split_alignments",))
def aln_dedupe(t: Inputs) -> DataFrame:
    return breakpoints.without_repeats(alignments(t)).select("call_id", "contig_id")


@query("aln_uncut", "SELECT contig_id, f1_s1, f1_e1, f2_s1 + 4000 AS f2_s1, f2_e1 + 4000 AS f2_e1 FROM split_alignments", ("split_alignments",))
def aln_uncut(t: Inputs) -> DataFrame:
    out = breakpoints.uncut(alignments(t), F.lit(520), F.lit(4000))
    f = F.col("frags")
    return out.select("contig_id", f[0]["s1"].alias("f1_s1"), f[0]["e1"].alias("f1_e1"), f[1]["s1"].alias("f2_s1"), f[1]["e1"].alias("f2_e1"))


PRED_SQL = """pr AS MATERIALIZED (SELECT *, abs(f2_s1 - f1_e1 - 1) AS g1, abs(f2_s2 - f1_e2 - 1) AS g2, least(abs(f1_e1 - f1_s1) + 1, abs(f2_e1 - f2_s1) + 1) AS mr, least(abs(f1_e2 - f1_s2) + 1, abs(f2_e2 - f2_s2) + 1) AS mc, abs(f1_e2 - f1_s2) + 1 + abs(f2_e2 - f2_s2) + 1 AS al,
  abs(f1_e1 - f1_s1) + 1 + abs(f2_e1 - f2_s1) + 1 AS fl FROM split_alignments)"""


@query(
    "aln_predicates",
    f"WITH {PRED_SQL} SELECT contig_id, mr >= 50 AS long_ref_flanks, g1 >= 20 AS ref_deletion, g2 BETWEEN 1 AND 49 AND g1 <= 20 AS insertion, mc >= 100 AND mr >= 100 AND abs(g1 - g2) <= 20 AS is_reference, al + 10 >= contig_len AS all_aligned, CAST(round(100 * al / contig_len) AS BIGINT) AS flank_percent FROM pr",
    ("split_alignments",),
)
def aln_predicates(t: Inputs) -> DataFrame:
    return alignments(t).select("contig_id", *[c.alias(n) for n, c in breakpoints.predicates().items()])


GOOD_SQL = (
    PRED_SQL
    + """, gd AS MATERIALIZED (SELECT * FROM pr WHERE CASE WHEN sv_type = 'DEL' THEN mr >= 50 AND abs(f1_e1 - f2_s1) >= 30 AND score / fl >= 0.7 AND abs(f1_e2 - f2_s2) <= 50 AND abs(least(f1_e1, f2_s1) - 500) < 400 AND abs(greatest(f1_e1, f2_s1) - (ref_len - 500)) < 400 ELSE mr >= 100 END)"""
)


@query("aln_good", f"WITH {GOOD_SQL} SELECT contig_id FROM gd", ("split_alignments",))
def aln_good(t: Inputs) -> DataFrame:
    return breakpoints.good_alignments(alignments(t)).select("contig_id")


@query("aln_features", f"WITH {GOOD_SQL} SELECT call_id, count(*) AS n_good, max(CAST(round(100 * al / contig_len) AS BIGINT)) AS flank_percent, 2 AS n_frags, max(pct_identity) AS pct_identity FROM gd GROUP BY call_id", ("split_alignments",))
def aln_features(t: Inputs) -> DataFrame:
    return breakpoints.alignment_features(breakpoints.good_alignments(alignments(t)))


#: The fold that takes places `pl(call_id, start_pos, at_)` a window apart: `en(call_id, start_pos, bps)`; needs WITH RECURSIVE.
SPACED_SQL = """po AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY at_) AS nr FROM pl),
wk AS (SELECT call_id, start_pos, nr, at_ AS last_, [at_] AS bps FROM po WHERE nr = 1 UNION ALL
  SELECT p.call_id, p.start_pos, p.nr, CASE WHEN p.at_ - wk.last_ >= 20 THEN p.at_ ELSE wk.last_ END, CASE WHEN p.at_ - wk.last_ >= 20 THEN list_append(wk.bps, p.at_) ELSE wk.bps END FROM wk JOIN po p ON p.call_id = wk.call_id AND p.nr = wk.nr + 1),
en AS (SELECT call_id, start_pos, last(bps ORDER BY nr) AS bps FROM wk GROUP BY call_id, start_pos)"""
TWO_SQL = " SELECT call_id, start_pos - 500 + bps[1] AS bp1, start_pos - 500 + bps[2] AS bp2, bps[2] - bps[1] AS bp_len FROM en WHERE len(bps) = 2"
BP_DEL_SQL = f"WITH RECURSIVE {GOOD_SQL}, pl AS (SELECT call_id, start_pos, unnest([f1_e1, f2_s1]) AS at_ FROM gd WHERE sv_type = 'DEL'),\n{SPACED_SQL}"


@query("bp_del", BP_DEL_SQL + TWO_SQL, ("split_alignments",))
def bp_del(t: Inputs) -> DataFrame:
    return breakpoints.deletion_breakpoints(breakpoints.good_alignments(alignments(t)))


@query(
    "bp_attach",
    BP_DEL_SQL
    + " SELECT c.call_id, coalesce(c.start_pos - 500 + bps[1], c.start_pos) AS bp1, coalesce(c.start_pos - 500 + bps[2], c.end_pos) AS bp2, coalesce(bps[2] - bps[1], -1) AS bp_len, bps IS NOT NULL OR c.source = 'HaplotypeCaller' AS assembled FROM calls c LEFT JOIN (SELECT * FROM en WHERE len(bps) = 2) en ON en.call_id = c.call_id WHERE c.start_pos >= 500",
    ("calls", "split_alignments"),
)
def bp_attach(t: Inputs) -> DataFrame:
    found = breakpoints.deletion_breakpoints(breakpoints.good_alignments(alignments(t)))
    calls = t.calls.withColumn("methods", filters.methods_of(F.array("source")))
    return breakpoints.attach(calls, found).select("call_id", "bp1", "bp2", "bp_len", F.array_contains("methods", "AS").alias("assembled"))


def shaped(t: Inputs, sv_type: str) -> DataFrame:
    """The fixture's deletions' alignments as those of another type: the same fragments in the order that type gives."""
    rows = alignments(t).where("sv_type = 'DEL'").withColumn("sv_type", F.lit(sv_type))
    f = F.col("frags")
    frag = lambda *x: F.struct(*[v.cast("bigint").alias(n) for v, n in zip(x, ("s1", "e1", "s2", "e2"), strict=True)])
    at = f[0]["e1"]
    if sv_type == "DUP":  # the contig runs through the end of the copy into its beginning
        return rows.withColumn("frags", F.array(frag(at, F.col("ref_len") - 700, F.lit(451), F.lit(900)), frag(F.col("ref_len") - 900, F.col("ref_len") - at, F.lit(1), F.lit(450))))
    return rows.withColumn("frags", F.array(frag(F.lit(1), at, F.lit(1), F.lit(450)), frag(at + 1, F.lit(1000), F.lit(650), F.lit(850)))).withColumn("contig_len", F.lit(1100))


def ends_sql(name: str, s1: str, e1: str, s2: str, e2: str) -> str:
    """Columns of a fragment's lesser and greater end on the reference, and the contig's ends there."""
    return f"least({s1}, {e1}) AS {name}_low, greatest({s1}, {e1}) AS {name}_high, CASE WHEN {s1} <= {e1} THEN {s2} ELSE {e2} END AS {name}_at_low, CASE WHEN {s1} <= {e1} THEN {e2} ELSE {s2} END AS {name}_at_high, abs({e1} - ({s1})) + 1 AS {name}_size"


def side_sql(swap: str, other: str, what: str) -> str:
    return f"CASE WHEN swap THEN {swap}_{what} ELSE {other}_{what} END"


BP_DUP_SQL = f"""WITH RECURSIVE x AS (SELECT call_id, start_pos, ref_len AS n, contig_len, {ends_sql("a", "f1_e1", "ref_len - 700", "451", "900")}, {ends_sql("b", "ref_len - 900", "ref_len - f1_e1", "1", "450")} FROM split_alignments WHERE sv_type = 'DEL'),
y AS (SELECT *, abs(a_low - 500) < 400 AND abs(b_high - (n - 500)) < 400 AS ab, abs(b_low - 500) < 400 AND abs(a_high - (n - 500)) < 400 AS ba FROM x WHERE least(a_size, b_size) >= 100),
z AS (SELECT *, CASE WHEN ab AND ba THEN abs(b_low - 500) + abs(a_high - (n - 500)) <= abs(a_low - 500) + abs(b_high - (n - 500)) ELSE ba END AS swap FROM y WHERE ab OR ba),
w AS (SELECT call_id, start_pos, contig_len, {side_sql("b", "a", "low")} AS l_low, {side_sql("b", "a", "at_low")} AS l_at, {side_sql("b", "a", "at_high")} AS l_far, {side_sql("a", "b", "high")} AS r_high, {side_sql("a", "b", "at_high")} AS r_at, {side_sql("a", "b", "at_low")} AS r_far FROM z),
pl AS (SELECT call_id, start_pos, unnest([l_low, r_high]) AS at_ FROM w WHERE abs(l_at - r_at) <= 10 AND NOT greatest(least(l_far, r_far), least(l_far, r_far) - contig_len) > 10),
{SPACED_SQL}"""


@query("bp_dup", BP_DUP_SQL + TWO_SQL, ("split_alignments",))
def bp_dup(t: Inputs) -> DataFrame:
    return breakpoints.duplication_breakpoints(breakpoints.good_alignments(shaped(t, "DUP")))


BP_INV_SQL = f"""WITH RECURSIVE al AS (SELECT *, min(abs(e1 - s1)) OVER (PARTITION BY contig_id) AS least_, ref_len AS n FROM inversion_fragments),
g0 AS (SELECT *, least(s1, e1) AS low, greatest(s1, e1) AS high, CASE WHEN s1 <= e1 THEN s2 ELSE e2 END AS at_low, CASE WHEN s1 <= e1 THEN e2 ELSE s2 END AS at_high, sign(e1 - s1) <> sign(e2 - s2) AS turned FROM al
  WHERE least_ >= 50 AND abs(e1 - s1) > 50 AND abs(e2 - s2) > 50 AND abs(e1 - s1) <= greatest(n - 200, 900)),
g1 AS (SELECT *, abs(low - 500) < 400 AS lnl, abs(high - (n - 500)) < 400 AS rnr, abs(high - 500) < 400 AS rnl, abs(low - (n - 500)) < 400 AS lnr FROM g0),
g AS MATERIALIZED (SELECT *, count(*) FILTER (lnl AND rnr) OVER w AS n_c, count(*) FILTER (lnr OR rnl) OVER w AS n_n, count(*) FILTER (lnr) OVER w AS n_lnr, count(*) FILTER (rnl) OVER w AS n_rnl FROM g1 WINDOW w AS (PARTITION BY contig_id) QUALIFY count(*) OVER w >= 2),
c1 AS MATERIALIZED (SELECT *, FALSE AS one_end, n > 1050 AS long_ FROM g WHERE lnl AND rnr AND NOT (n_c > 1 AND n_n <= 1 AND (lnr OR rnl)) QUALIFY row_number() OVER (PARTITION BY contig_id ORDER BY abs(low - 500) + abs(high - (n - 500)), i) = 1),
c2 AS (SELECT *, count(*) OVER (PARTITION BY contig_id) AS n_o FROM g WHERE contig_id NOT IN (SELECT contig_id FROM c1) AND ((lnl AND n_lnr - CAST(lnr AS INTEGER) > 0) OR (rnr AND n_rnl - CAST(rnl AS INTEGER) > 0))),
c3 AS (SELECT * EXCLUDE (n_o), TRUE AS one_end, TRUE AS long_ FROM c2 WHERE n_o = 1 OR (lnl AND s1 + e1 > 1000) OR (rnr AND s1 + e1 < 2 * (n - 500)) QUALIFY row_number() OVER (PARTITION BY contig_id ORDER BY CASE WHEN lnl THEN abs(low - 500) ELSE abs(high - (n - 500)) END, i) = 1),
v AS (SELECT * FROM c1 UNION ALL SELECT * FROM c3),
m AS (SELECT v.*, o.low AS ol, o.high AS oh, o.at_low AS oal, o.at_high AS oah FROM v JOIN g o ON o.contig_id = v.contig_id AND o.i <> v.i AND (o.lnr OR o.rnl) AND o.turned <> v.turned AND (NOT v.one_end OR CASE WHEN v.lnl THEN o.lnr ELSE o.rnl END)
  QUALIFY row_number() OVER (PARTITION BY v.contig_id ORDER BY o.high - o.low DESC, o.i) = 1),
ok AS (SELECT *, oh > high AS beyond FROM m WHERE (ol - low) * (oh - high) > 0 AND (long_ OR (least(s2, abs(s2 - contig_len), e2, abs(e2 - contig_len)) >= 10 AND CASE WHEN oh > high THEN ol - high ELSE low - oh END BETWEEN -10 AND 50))),
pl AS (SELECT call_id, start_pos, unnest(CASE WHEN beyond THEN [low, ol] ELSE [high, oh] END) AS at_ FROM ok WHERE abs(CASE WHEN beyond THEN at_low - oal ELSE at_high - oah END) <= 10),
{SPACED_SQL}"""


@query("bp_inv", BP_INV_SQL + TWO_SQL, ("inversion_fragments",))
def bp_inv(t: Inputs) -> DataFrame:
    f = t.inversion_fragments
    frag = F.struct("i", *[F.col(c).cast("bigint").alias(c) for c in ("s1", "e1", "s2", "e2")])
    rows = f.groupBy(*[c for c in f.columns if c not in ("i", "s1", "e1", "s2", "e2")]).agg(F.array_sort(F.collect_list(frag)).alias("frags"))
    return breakpoints.inversion_breakpoints(breakpoints.good_alignments(rows))


#: The fixture's contigs of insertions lack no reference base and hold 199 bases more.
BP_INS_SQL = """WITH RECURSIVE x AS MATERIALIZED (SELECT call_id, start_pos, end_pos, f1_e1 AS q, abs(f1_e1 + 1 - f1_e1 - 1) AS g1, abs(650 - 450 - 1) AS g2 FROM split_alignments WHERE sv_type = 'DEL'),
fr AS MATERIALIZED (SELECT call_id, 1 AS low, q AS high FROM x WHERE q - 1 >= 200 UNION ALL SELECT call_id, q + 1, 1000 FROM x WHERE 1000 - (q + 1) >= 200),
at_all AS (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY at_) AS nr, count(*) OVER (PARTITION BY call_id) AS n FROM (SELECT call_id, low AS at_ FROM fr UNION SELECT call_id, high FROM fr)),
su AS (SELECT call_id, at_ FROM at_all a WHERE nr > 1 AND nr < n AND EXISTS (SELECT 1 FROM fr WHERE fr.call_id = a.call_id AND abs(low - at_) <= 20) AND EXISTS (SELECT 1 FROM fr WHERE fr.call_id = a.call_id AND abs(high - at_) <= 20)),
he AS (SELECT su.call_id, at_, start_pos, end_pos, least(abs(1 - at_), abs(q - at_), abs(q + 1 - at_), abs(1000 - at_)) <= 20 AS here, least(q, 1000 - q) >= 50 AND (g1 >= 20 OR (g2 BETWEEN 1 AND 49 AND g1 <= 20 AND g2 >= 20)) AS against, CASE WHEN g2 >= 50 AND g1 <= 20 THEN g2 ELSE 0 END AS ins_len FROM su JOIN x USING (call_id)),
ju AS (SELECT call_id, at_, any_value(start_pos) AS start_pos, any_value(end_pos) AS end_pos, max(CASE WHEN here THEN ins_len ELSE 0 END) AS ins_len FROM he GROUP BY call_id, at_ HAVING NOT bool_or(here AND against)),
jo AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY call_id ORDER BY at_) AS nr FROM ju),
tk AS (SELECT call_id, nr, at_ AS last_, TRUE AS taken FROM jo WHERE nr = 1 UNION ALL SELECT j.call_id, j.nr, CASE WHEN j.at_ - tk.last_ > 20 THEN j.at_ ELSE tk.last_ END, j.at_ - tk.last_ > 20 FROM tk JOIN jo j ON j.call_id = tk.call_id AND j.nr = tk.nr + 1),
ts AS (SELECT jo.*, count(*) OVER (PARTITION BY call_id) AS n FROM jo JOIN tk USING (call_id, nr) WHERE taken),
tn AS (SELECT *, count(*) OVER (PARTITION BY call_id) AS n_left FROM ts WHERE n = 1 OR least(abs(at_ - 500), abs(at_ - (end_pos - start_pos + 500))) < 50)"""


@query(
    "bp_ins",
    BP_INS_SQL + " SELECT call_id, start_pos - 500 + at_ AS bp1, start_pos - 499 + at_ AS bp2, ins_len AS bp_len FROM tn WHERE n_left = 1 AND least(abs(at_ - 500), abs(start_pos - 500 + at_ - end_pos)) <= 100",
    ("split_alignments",),
)
def bp_ins(t: Inputs) -> DataFrame:
    rows = shaped(t, "INS")
    return breakpoints.insertion_breakpoints(breakpoints.good_alignments(rows), rows)
