"""Queries over read evidence: genotypes, pairs, assembly routing, feature tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Inputs
from ..functions.reads import with_cigar
from ..operators import evidence, filters
from .registry import query
from .calls import METHODS_SQL, islands_sql

GT_SQL = """p AS MATERIALIZED (SELECT call_id, chrom, start_pos AS pt FROM calls UNION ALL SELECT call_id, chrom, end_pos FROM calls WHERE sv_type <> 'INS'),
k AS (SELECT p.call_id, count(*) AS total, count(*) FILTER (NOT is_unmapped AND NOT mate_is_unmapped AND mate_chrom = r.chrom AND CASE WHEN is_reverse THEN mate_pos < pos AND NOT mate_is_reverse ELSE mate_pos > pos AND mate_is_reverse END
  AND aend - pt >= 20 AND pt - pos >= 20 AND abs(tlen) BETWEEN 200 AND 500) AS normal FROM p JOIN reads r ON r.chrom = p.chrom AND r.is_paired AND NOT r.is_duplicate AND greatest(r.pos, greatest(0, pt - 100)) < least(r.aend, pt + 100) GROUP BY p.call_id),
gt AS MATERIALIZED (SELECT calls.call_id, coalesce(total, 0) AS total, coalesce(normal, 0) AS normal FROM calls LEFT JOIN k USING (call_id))"""


@query("gt_counts", f"WITH {GT_SQL} SELECT * FROM gt", ("calls", "reads"))
def gt_counts(t: Inputs) -> DataFrame:
    return evidence.genotype_counts(t.calls, t.reads)


@query("gt_call", f"WITH {GT_SQL} SELECT call_id, CASE WHEN normal / greatest(1, total) >= 0.95 THEN '0/0' WHEN normal / greatest(1, total) >= 0.05 THEN '0/1' ELSE '1/1' END AS gt FROM gt", ("calls", "reads"))
def gt_call(t: Inputs) -> DataFrame:
    return evidence.genotype_counts(t.calls, t.reads).select("call_id", evidence.genotype_of(F.col("normal"), F.col("total")).alias("gt"))


def with_methods(t: Inputs) -> DataFrame:
    """Calls with methods, every third also with soft clips."""
    own = filters.methods_of(F.array("source"))
    return t.calls.withColumns({"methods": F.when(F.col("call_id") % 3 == 0, F.array_append(own, F.lit("SC"))).otherwise(own), "n_tools": (1 + F.col("call_id") % 3).cast("int")})


@query(
    "gt_coords",
    """WITH x AS (SELECT *, source = 'HaplotypeCaller' OR (sv_type = 'INS' AND call_id % 3 = 0) AS u FROM calls)
    SELECT call_id, CASE WHEN u THEN start_pos + 5 ELSE start_pos END AS start_pos, CASE WHEN u THEN end_pos - 5 ELSE end_pos END AS end_pos,
    CASE WHEN sv_type = 'DEL' THEN -1 ELSE 1 END * CASE WHEN u AND call_id % 7 - 1 >= 0 THEN call_id % 7 - 1 ELSE sv_len END AS sv_len FROM x""",
    ("calls",),
)
def gt_coords(t: Inputs) -> DataFrame:
    calls = with_methods(t).withColumns({"bp1": F.col("start_pos") + 5, "bp2": F.col("end_pos") - 5, "bp_len": F.col("call_id") % 7 - 1})
    return evidence.genotype_coordinates(calls).select("call_id", "start_pos", "end_pos", "sv_len")


WINDOWS_SQL = """d AS (SELECT *, end_pos + CASE WHEN call_id % 4 = 0 THEN 20000 ELSE 0 END AS e FROM calls), dw AS (SELECT call_id, chrom, sv_type, start_pos - 500 AS low, e + 500 AS high FROM d WHERE start_pos >= 500),
pw AS MATERIALIZED (SELECT call_id, chrom, low AS start_pos, CASE WHEN high - low > 10000 AND sv_type IN ('INV', 'DEL', 'DUP') THEN low + 4499 ELSE high END AS end_pos, low, high FROM dw
UNION ALL SELECT call_id, chrom, high - 4499, high, low, high FROM dw WHERE high - low > 10000 AND sv_type IN ('INV', 'DEL', 'DUP'))"""


def long_calls(t: Inputs) -> DataFrame:
    return t.calls.withColumn("end_pos", F.col("end_pos") + F.when(F.col("call_id") % 4 == 0, 20000).otherwise(0))


@query("pairs_region", f"WITH {WINDOWS_SQL} SELECT call_id, chrom, start_pos, end_pos FROM pw", ("calls",))
def pairs_region(t: Inputs) -> DataFrame:
    return evidence.pair_windows(long_calls(t)).select("call_id", "chrom", "start_pos", "end_pos")


SIDES_SQL = "sd AS MATERIALIZED (SELECT qname, max(read_id) FILTER (is_read1) AS r1, max(read_id) FILTER (NOT is_read1) AS r2 FROM reads GROUP BY qname HAVING count(*) FILTER (is_read1) > 0 AND count(*) FILTER (NOT is_read1) > 0)"


@query("mate_join", f"WITH {SIDES_SQL} SELECT qname, r1, r2 FROM sd", ("reads",))
def mate_join(t: Inputs) -> DataFrame:
    return evidence.complete_pairs(t.reads).select("qname", F.col("first.read_id").alias("r1"), F.col("second.read_id").alias("r2"))


FRAGMENTS_SQL = WINDOWS_SQL + ", fr AS MATERIALIZED (SELECT DISTINCT pw.call_id, r.qname FROM pw JOIN reads r ON r.chrom = pw.chrom AND greatest(r.pos, pw.start_pos) < least(r.aend, pw.end_pos))"


@query("cap_pairs", f"WITH {FRAGMENTS_SQL} SELECT call_id, qname FROM fr WHERE call_id IN (SELECT call_id FROM fr GROUP BY call_id HAVING count(*) <= 3)", ("calls", "reads"))
def cap_pairs(t: Inputs) -> DataFrame:
    return evidence.within_cap(evidence.reads_of(evidence.pair_windows(long_calls(t)), t.reads), 3).select("call_id", "qname")


#: Columns of reads that the selectors don't look at, and those that pairs alone don't need.
UNSELECTED = ("rlen", "mate_chrom", "mate_pos", "mate_is_reverse", "is_duplicate", "mate_is_unmapped", "is_paired")
UNPAIRED = (*UNSELECTED, "match_len", "clip_left", "clip_right", "avg_qual", "is_unmapped", "is_reverse", "mapq", "nm", "tlen")


@query("pairs_build", f"WITH {FRAGMENTS_SQL}, {SIDES_SQL} SELECT call_id, qname, r1, r2 FROM fr JOIN sd USING (qname)", ("calls", "reads"))
def pairs_build(t: Inputs) -> DataFrame:
    reads = t.kept("reads", UNPAIRED).select("read_id", "qname", "chrom", "pos", "aend", "is_read1")
    return evidence.build_pairs(long_calls(t), reads).select("call_id", "qname", F.col("first.read_id").alias("r1"), F.col("second.read_id").alias("r2"))


@query(
    "pairs_select",
    f"""WITH {FRAGMENTS_SQL}, {SIDES_SQL}, reg AS (SELECT DISTINCT call_id, chrom, low, high FROM pw),
    j AS (SELECT fr.call_id, qname, a.tlen, a.is_reverse AS ra, b.is_reverse AS rb, (a.is_unmapped OR a.mapq > 0 OR a.chrom <> reg.chrom OR NOT a.pos BETWEEN low AND high) AND (b.is_unmapped OR b.mapq > 0 OR b.chrom <> reg.chrom OR NOT b.pos BETWEEN low AND high) AS hq,
      NOT (NOT a.is_unmapped AND a.clip_left + a.clip_right = 0 AND a.nm <= 5 AND NOT b.is_unmapped AND b.clip_left + b.clip_right = 0 AND b.nm <= 5) AS np FROM fr JOIN sd USING (qname) JOIN reg USING (call_id) JOIN reads a ON a.read_id = r1 JOIN reads b ON b.read_id = r2)
    SELECT call_id, qname, TRUE AS all_pair, hq AS all_pair_hq, np AS non_perfect, np AND hq AS non_perfect_hq, tlen = 0 OR NOT abs(tlen) BETWEEN 300 AND 400 AS discordant, tlen = 0 OR (ra <> rb AND NOT abs(tlen) BETWEEN 300 AND 400) AS discordant_with_normal_orientation FROM j""",
    ("calls", "reads"),
)
def pairs_select(t: Inputs) -> DataFrame:
    reads = with_cigar(t.kept("reads", UNSELECTED)).select("read_id", "qname", "chrom", "pos", "aend", "is_read1", "is_unmapped", "is_reverse", "mapq", "nm", "tlen", F.size("cigar").alias("parts"))
    return evidence.build_pairs(long_calls(t), reads).select("call_id", "qname", *[c.alias(n) for n, c in evidence.selectors().items()])


SEQ = "translate(md5(CAST(read_id AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query("pairs_fastq", f"SELECT read_id, '@' || qname || '/' || CASE WHEN is_read1 THEN '1' ELSE '2' END || chr(10) || CASE WHEN is_reverse THEN translate(reverse({SEQ}), 'ACGT', 'TGCA') ELSE {SEQ} END || chr(10) || '+' || chr(10) || CASE WHEN is_reverse THEN reverse(md5(qname)) ELSE md5(qname) END AS value FROM reads", ("reads",))
def pairs_fastq(t: Inputs) -> DataFrame:
    return evidence.fastq_rows(t.reads.withColumns({"seq": F.translate(F.md5(F.col("read_id").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT"), "qual": F.md5("qname")}))


@query(
    "asm_route",
    """SELECT call_id, end_pos - start_pos <= CASE WHEN sv_type = 'INS' THEN 50000 ELSE 1000000 END AND sv_type IN ('DEL', 'INS', 'INV', 'DUP') AND (sv_type NOT IN ('DUP', 'DEL', 'INS') OR call_id % 3 = 0)
    AND (1 + call_id % 3 - CASE WHEN call_id % 3 = 0 THEN 1 ELSE 0 END <= 1 OR source IN ('BreakDancer', 'CNVnator')) AS assemble FROM calls""",
    ("calls",),
)
def asm_route(t: Inputs) -> DataFrame:
    return with_methods(t).select("call_id", evidence.should_assemble().alias("assemble"))


@query(
    "asm_skip_bps",
    "WITH x AS (SELECT *, (call_id % 3 = 0 OR source IN ('Manta', 'Lumpy')) AND source IN ('Pindel', 'BreakSeq', 'HaplotypeCaller', 'Manta', 'Lumpy') AS sure FROM calls) SELECT call_id, CASE WHEN sure THEN start_pos ELSE -1 END AS bp1, CASE WHEN sure THEN end_pos ELSE -1 END AS bp2 FROM x",
    ("calls",),
)
def asm_skip_bps(t: Inputs) -> DataFrame:
    return evidence.skipped_breakpoints(with_methods(t)).select("call_id", "bp1", "bp2")


TRACK_ON = "k.chrom = c.chrom AND greatest(c.start_pos, k.start_pos) < least(c.end_pos, k.end_pos)"


@query("ann_overlap_flag", f"SELECT call_id, CAST(EXISTS (SELECT 1 FROM track k WHERE {TRACK_ON}) AS INTEGER) AS overlaps FROM calls c", ("calls", "track"))
def ann_overlap_flag(t: Inputs) -> DataFrame:
    return evidence.overlap_flag(t.calls, t.track)


WEIGHTED_SQL = f"SELECT c.call_id, round(coalesce(sum(k.score * (least(c.end_pos, k.end_pos) - greatest(c.start_pos, k.start_pos))) FILTER (k.chrom IS NOT NULL), 0) / greatest(1, any_value(c.end_pos - c.start_pos)), 6) AS score FROM calls c LEFT JOIN track k ON {TRACK_ON} GROUP BY c.call_id"


@query("ann_weighted", WEIGHTED_SQL, ("calls", "track"))
def ann_weighted(t: Inputs) -> DataFrame:
    return evidence.weighted_overlap(t.calls, t.track).withColumn("score", F.round("score", 6))


BINS_SQL = """b AS MATERIALIZED (SELECT call_id, chrom, unnest(range(start_pos, end_pos, 50)) AS s FROM calls WHERE end_pos > start_pos),
n AS MATERIALIZED (SELECT b.call_id, s, count(r.read_id) AS n, count(r.read_id) FILTER (mapq >= 20 AND nm < 2 AND clip_left + clip_right <= 10) AS g FROM b LEFT JOIN reads r ON r.chrom = b.chrom AND NOT is_duplicate AND r.pos < b.s + 50 AND r.aend > b.s GROUP BY b.call_id, s)"""


@query(
    "ann_cov_bins",
    f"WITH {BINS_SQL} SELECT call_id, string_agg(n, ';' ORDER BY s) AS coverage, string_agg(g, ';' ORDER BY s) AS good_coverage, min(n) AS least, max(n) AS most, max(g) AS good_most, round(avg(n), 6) AS mean, round(CASE WHEN avg(n) > 0 THEN max(n) / avg(n) ELSE 1 END, 6) AS most_ratio FROM n GROUP BY call_id",
    ("calls", "reads"),
)
def ann_cov_bins(t: Inputs) -> DataFrame:
    out = evidence.coverage_bins(t.calls, t.reads)
    return out.select("call_id", "coverage", "good_coverage", "least", "most", "good_most", F.round("mean", 6).alias("mean"), F.round("most_ratio", 6).alias("most_ratio"))


@query("ann_preasm", "SELECT a.call_id, b.sv_len AS support FROM calls a JOIN (SELECT chrom, start_pos, end_pos, max(sv_len) AS sv_len FROM calls WHERE call_id % 2 = 0 GROUP BY ALL) b USING (chrom, start_pos, end_pos)", ("calls",))
def ann_preasm(t: Inputs) -> DataFrame:
    key = ["chrom", "start_pos", "end_pos"]
    before = t.calls.where("call_id % 2 = 0").groupBy(*key).agg(F.max("sv_len").alias("support"))
    return t.calls.select("call_id", *key).join(before, key).select("call_id", "support")


@query(
    "ann_truth",
    f"SELECT c.call_id, k.chrom IS NOT NULL AS is_true, coalesce(k.start_pos, -1) AS truth_start, coalesce(k.end_pos - k.start_pos, -1) AS truth_len, coalesce(c.start_pos - k.start_pos, -1) AS start_offset, coalesce(c.end_pos - k.end_pos, -1) AS end_offset FROM calls c LEFT JOIN track k ON {TRACK_ON}",
    ("calls", "track"),
)
def ann_truth(t: Inputs) -> DataFrame:
    return evidence.truth_overlap(t.calls, t.track)


@query("ann_del_variant", f"WITH w AS ({WEIGHTED_SQL}) SELECT w.call_id, w.score, EXISTS (SELECT 1 FROM gaps k WHERE {TRACK_ON}) AS in_gap FROM w JOIN calls c USING (call_id) WHERE c.sv_type = 'DEL'", ("calls", "track", "gaps"))
def ann_del_variant(t: Inputs) -> DataFrame:
    dels = t.calls.where("sv_type = 'DEL'")
    flags = evidence.overlap_flag(dels, t.gaps)
    return evidence.weighted_overlap(dels, t.track).join(flags, "call_id").select("call_id", F.round("score", 6).alias("score"), (F.col("overlaps") == 1).alias("in_gap"))


LIB_SQL = "lr AS (SELECT * FROM reads WHERE mapq >= 18),\n" + islands_sql("lr", "lri", "chrom", "pos, aend, read_id", "pos", "aend") + """,
o AS (SELECT abs(tlen) AS size, row_number() OVER (ORDER BY abs(tlen)) - 1 AS nr, count(*) OVER () AS n FROM reads WHERE mapq >= 18),
cov AS (SELECT sum(b) / sum(p) AS coverage FROM (SELECT sum(aend - pos) AS b, max(aend) - min(pos) AS p FROM lri GROUP BY chrom, island)),
lib AS (SELECT count(*) AS n_reads, avg(size) AS m, sqrt(sum(size * size) / count(*) - avg(size) * avg(size)) AS sd FROM o WHERE nr >= floor(n * 0.05) AND nr < ceil(n * 0.95))"""


@query("lib_stats", f"WITH {LIB_SQL} SELECT n_reads, round(m, 6) AS isize_mean, round(sd, 6) AS isize_sd, round(coverage, 6) AS coverage FROM lib, cov", ("reads",))
def lib_stats(t: Inputs) -> DataFrame:
    return evidence.library_stats(t.reads).select("n_reads", F.round("isize_mean", 6).alias("isize_mean"), F.round("isize_sd", 6).alias("isize_sd"), F.round("coverage", 6).alias("coverage"))


@query(
    "var_read_features",
    """WITH q AS (SELECT call_id, chrom, 'in' AS kind, start_pos + (call_id * 7919 + i * 104729) % greatest(1, end_pos - start_pos) AS at_ FROM calls, range(10) r(i)
      UNION ALL SELECT call_id, chrom, 'end', greatest(0, start_pos - 50) FROM calls UNION ALL SELECT call_id, chrom, 'end', end_pos + 50 FROM calls)
    SELECT call_id, count(read_id) FILTER (kind = 'in' AND mapq >= 18) AS "unique", count(read_id) FILTER (kind = 'in') AS total, count(read_id) FILTER (kind = 'in' AND mapq >= 18 AND NOT is_reverse) AS forward,
    count(read_id) FILTER (kind = 'end' AND mapq >= 18 AND abs(tlen) > 500) AS discordant_high, count(read_id) FILTER (kind = 'end' AND mapq >= 18 AND abs(tlen) < 200) AS discordant_low,
    round(sum(rlen - clip_left - clip_right) FILTER (kind = 'in' AND mapq >= 18) / sum(rlen) FILTER (kind = 'in' AND mapq >= 18), 6) AS aligned_share, round(sum(rlen - clip_left - clip_right) FILTER (kind = 'end' AND mapq >= 18) / sum(rlen) FILTER (kind = 'end' AND mapq >= 18), 6) AS end_aligned_share,
    round(count(read_id) FILTER (kind = 'in' AND mapq >= 18) / nullif(count(read_id) FILTER (kind = 'in'), 0), 6) AS unique_share, round(count(read_id) FILTER (kind = 'in' AND mapq >= 18) / 10 / 30, 6) AS unique_coverage, round(count(read_id) FILTER (kind = 'in') / 10 / 30, 6) AS total_coverage,
    round(power(count(read_id) FILTER (kind = 'in' AND mapq >= 18 AND NOT is_reverse) / nullif(count(read_id) FILTER (kind = 'in' AND mapq >= 18), 0) - 0.5, 2), 6) AS strand_bias
    FROM q LEFT JOIN reads r ON r.chrom = q.chrom AND r.pos < at_ + 1 AND r.aend > at_ GROUP BY call_id""",
    ("calls", "reads"),
)
def var_read_features(t: Inputs) -> DataFrame:
    out = evidence.variant_read_features(t.calls, t.reads, 350, 50, coverage=30)
    shares = ("aligned_share", "end_aligned_share", "unique_share", "unique_coverage", "total_coverage", "strand_bias")
    return out.select("call_id", "unique", "total", "forward", "discordant_high", "discordant_low", *[F.round(c, 6).alias(c) for c in shares])


ML_SQL = f"""SELECT call_id, sv_len, len({METHODS_SQL}) AS n_methods, CAST(source IN ('BreakDancer', 'Manta', 'Lumpy') AS INTEGER) AS has_RP, CAST(source = 'CNVnator' AS INTEGER) AS has_RD, CAST(source IN ('Pindel', 'Manta', 'Lumpy') AS INTEGER) AS has_SR,
CAST(source = 'BreakSeq' AS INTEGER) AS has_JM, CAST(source = 'HaplotypeCaller' AS INTEGER) AS has_AS, 0 AS has_SC, CASE WHEN call_id % 2 = 0 THEN CAST(call_id % 40 AS DOUBLE) ELSE -1.0 END AS PD_READ_SUPP, -1.0::DOUBLE AS BD_SCORE FROM calls"""


@query("ml_features", ML_SQL, ("calls",))
def ml_features(t: Inputs) -> DataFrame:
    calls = t.calls.withColumns({"methods": filters.methods_of(F.array("source")), "info": F.when(F.col("call_id") % 2 == 0, F.create_map(F.lit("PD_READ_SUPP"), (F.col("call_id") % 40).cast("string"))).otherwise(F.create_map(F.lit("OTHER"), F.lit("1")))})
    return evidence.ml_features(calls, ("PD_READ_SUPP", "BD_SCORE"))


@query("sink_feature_table", f"WITH m AS ({ML_SQL}) SELECT call_id, concat_ws(chr(9), call_id, sv_len, n_methods, has_RP, has_RD, has_SR, has_JM, has_AS, has_SC, CAST(PD_READ_SUPP AS INTEGER), CAST(BD_SCORE AS INTEGER)) AS value FROM m", ("calls",))
def sink_feature_table(t: Inputs) -> DataFrame:
    """The table's lines, as a tab-separated text sink writes them."""
    table = ml_features(t)
    cells = [F.col(c).cast("int").cast("string") if c in ("PD_READ_SUPP", "BD_SCORE") else F.col(c).cast("string") for c in table.columns]
    return table.select("call_id", F.concat_ws("\t", *cells).alias("value"))
