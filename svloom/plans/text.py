"""Queries over callers' text formats: parse what the fixture views print, print calls again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Inputs
from ..operators import filters, merge
from ..operators.sweeps import overlap_join
from ..session import shared_folder
from ..sources import layout, native, sinks
from ..sources.sequence import with_reference
from .calls import METHODS_SQL, VALIDATE_SQL
from .registry import query

BD = "calls WHERE source = 'BreakDancer' AND sv_type <> 'DUP'"


@query(
    "src_breakdancer",
    f"SELECT call_id, chrom AS chr1, start_pos - 1 AS pos1, '5+0-' AS ori1, chrom2 AS chr2, end_pos AS pos2, '0+5-' AS ori2, sv_type, sv_len, 99.0::DOUBLE AS score, CAST(3 + call_id % 9 AS INTEGER) AS num_reads, 'lib.bam=' || (3 + call_id % 9) AS lib_reads FROM {BD}",
    ("calls",),
)
def src_breakdancer(t: Inputs) -> DataFrame:
    libs = F.array_join(F.transform(F.map_entries("lib_reads"), lambda e: F.concat_ws("=", e["key"], e["value"].cast("string"))), ",")
    return native.breakdancer(t.lines_breakdancer).withColumn("lib_reads", libs)


@query(
    "norm_breakdancer",
    f"SELECT call_id, chrom, chrom2, start_pos, end_pos, CASE WHEN sv_type IN ('ITX', 'CTX') THEN 0 ELSE sv_len END AS sv_len, sv_type, '0,' || CASE WHEN sv_type = 'INS' THEN end_pos - start_pos + 1 WHEN sv_type IN ('ITX', 'CTX') THEN 0 ELSE end_pos - start_pos + 1 - sv_len END AS cipos FROM {BD} AND (chrom = chrom2 OR sv_type = 'CTX')",
    ("calls",),
)
def norm_breakdancer(t: Inputs) -> DataFrame:
    rows = native.normalised_breakdancer(native.breakdancer(t.lines_breakdancer))
    return rows.select("call_id", "chrom", "chrom2", "start_pos", "end_pos", "sv_len", "sv_type", F.array_join(F.transform("cipos", lambda x: x.cast("string")), ",").alias("cipos"))


@query("bd_header_stats", "SELECT DISTINCT 'lib' || source || '.bam' AS name, '1' || CAST(length(source) AS VARCHAR) AS mean FROM calls", ("calls",))
def bd_header_stats(t: Inputs) -> DataFrame:
    lines = t.calls.select("source").distinct().select(F.concat(F.lit("#lib"), "source", F.lit(".bam\tmean:1"), F.length("source").cast("string"), F.lit("\tstd:5.5\treadlen:100")).alias("value"))
    return native.breakdancer_header(lines).select("name", F.col("stats")["mean"].alias("mean"))


PD = "calls WHERE source = 'Pindel' AND sv_type IN ('DEL', 'DUP', 'INV', 'INS')"


@query(
    "src_pindel",
    f"""SELECT call_id, CASE sv_type WHEN 'DEL' THEN 'D' WHEN 'DUP' THEN 'TD' WHEN 'INV' THEN 'INV' ELSE 'I' END AS pindel_type, sv_len, chrom, start_pos, end_pos, start_pos AS bp_range_start, end_pos + 1 + call_id % 5 AS bp_range_end,
    4 + call_id % 30 AS reads, 3 + call_id % 30 AS unique_reads, call_id % 11 AS up_reads, call_id % 11 AS up_unique, call_id % 13 AS down_reads, call_id % 13 AS down_unique, 9 AS score, 240 AS sum_mapq, 1 AS n_samples, 1 + call_id % 5 AS homlen FROM {PD}""",
    ("calls",),
)
def src_pindel(t: Inputs) -> DataFrame:
    return native.pindel(t.lines_pindel).select("call_id", "pindel_type", "sv_len", "chrom", "start_pos", "end_pos", "bp_range_start", "bp_range_end", "reads", "unique_reads", "up_reads", "up_unique", "down_reads", "down_unique", "score", "sum_mapq", "n_samples", "homlen")


@query("pindel_samples", f"SELECT call_id, 's1' AS sample, 2 AS ref_start, 1 AS ref_end, 2 AS plus, 2 AS minus FROM {PD}", ("calls",))
def pindel_samples(t: Inputs) -> DataFrame:
    return native.pindel_samples(native.pindel(t.lines_pindel)).select("call_id", "sample", "ref_start", "ref_end", "plus", "minus")


GT_SQL = """CASE WHEN sv_type = 'INS' THEN CASE WHEN call_id % 11 + call_id % 13 > 0 THEN '0/1' ELSE '0/0' END WHEN 3 + call_id % 30 + call_id % 11 + call_id % 13 < 10 THEN '0/0'
    WHEN (3 + call_id % 30) / (3 + call_id % 30 + call_id % 11 + call_id % 13) < 0.2 THEN '0/0' WHEN (3 + call_id % 30) / (3 + call_id % 30 + call_id % 11 + call_id % 13) < 0.8 THEN '0/1' ELSE '1/1' END"""


@query("pindel_genotype", f"SELECT call_id, {GT_SQL} AS gt FROM {PD}", ("calls",))
def pindel_genotype(t: Inputs) -> DataFrame:
    return native.pindel(t.lines_pindel).select("call_id", native.pindel_genotype().alias("gt"))


@query("norm_pindel", f"SELECT call_id, chrom, start_pos, CASE WHEN sv_type = 'INS' THEN start_pos ELSE end_pos END AS end_pos, sv_type, sv_len, CAST(CASE WHEN sv_type = 'INS' THEN 100 ELSE 0 END AS INTEGER) AS wiggle FROM {PD}", ("calls",))
def norm_pindel(t: Inputs) -> DataFrame:
    return native.normalised_pindel(native.pindel(t.lines_pindel)).select("call_id", "chrom", "start_pos", "end_pos", "sv_type", "sv_len", "wiggle")


CN = "calls WHERE source = 'CNVnator' AND sv_type IN ('DEL', 'DUP')"


@query("src_cnvnator", f"SELECT call_id, sv_type, chrom, start_pos, end_pos, end_pos - start_pos AS sv_len, 0.5::DOUBLE AS rd, 0.25::DOUBLE AS q0 FROM {CN}", ("calls",))
def src_cnvnator(t: Inputs) -> DataFrame:
    return native.cnvnator(t.lines_cnvnator).select("call_id", "sv_type", "chrom", "start_pos", "end_pos", "sv_len", "rd", "q0")


@query("norm_cnvnator", f"SELECT call_id, 'CNVnator' AS source, sv_type, chrom, start_pos, end_pos, end_pos - start_pos AS sv_len FROM {CN}", ("calls",))
def norm_cnvnator(t: Inputs) -> DataFrame:
    return native.normalised(native.cnvnator(t.lines_cnvnator), "CNVnator").select("call_id", "source", "sv_type", "chrom", "start_pos", "end_pos", "sv_len")


BS = "calls WHERE source = 'BreakSeq' AND sv_type IN ('DEL', 'INS')"


@query("src_breakseq", f"SELECT call_id, chrom, sv_type, start_pos, end_pos, CASE WHEN sv_type = 'INS' THEN 0 ELSE end_pos - start_pos END AS sv_len, 'PASS2' AS filter, '0,0,' || (call_id % 40) AS abc, CAST(call_id % 40 AS INTEGER) AS pe FROM {BS}", ("calls",))
def src_breakseq(t: Inputs) -> DataFrame:
    return native.breakseq(t.lines_breakseq).select("call_id", "chrom", "sv_type", "start_pos", "end_pos", "sv_len", "filter", F.array_join(F.transform("abc", lambda x: x.cast("string")), ",").alias("abc"), "pe")


@query("norm_breakseq", f"SELECT call_id, 'BreakSeq' AS source, sv_type, chrom, start_pos, end_pos, CASE WHEN sv_type = 'INS' THEN 0 ELSE end_pos - start_pos END AS sv_len FROM {BS}", ("calls",))
def norm_breakseq(t: Inputs) -> DataFrame:
    return native.normalised(native.breakseq(t.lines_breakseq), "BreakSeq").select("call_id", "source", "sv_type", "chrom", "start_pos", "end_pos", "sv_len")


VC = "calls WHERE source IN ('Manta', 'Lumpy')"


@query("src_vcf_calls", f"SELECT call_id, chrom, start_pos, end_pos, sv_type, sv_len, CAST(100 AS INTEGER) AS wiggle FROM {VC} AND (sv_len BETWEEN 50 AND 1000000 OR sv_type IN ('ITX', 'CTX'))", ("calls",))
def src_vcf_calls(t: Inputs) -> DataFrame:
    return native.vcf_calls(native.vcf(t.lines_vcf), F.lit("Manta")).select("call_id", "chrom", "start_pos", "end_pos", "sv_type", "sv_len", "wiggle")


@query("vcf_info_map", f"SELECT call_id, sv_type AS svtype, CAST(end_pos AS VARCHAR) AS end_text, CAST(CASE WHEN sv_type = 'DEL' THEN -sv_len ELSE sv_len END AS VARCHAR) AS svlen, 'true' AS imprecise FROM {VC}", ("calls",))
def vcf_info_map(t: Inputs) -> DataFrame:
    info = F.col("info")
    return native.vcf(t.lines_vcf).select("call_id", info["SVTYPE"].alias("svtype"), info["END"].alias("end_text"), info["SVLEN"].alias("svlen"), info["IMPRECISE"].alias("imprecise"))


@query("vcf_gt", f"SELECT call_id, '0/1' AS gt FROM {VC}", ("calls",))
def vcf_gt(t: Inputs) -> DataFrame:
    return native.vcf(t.lines_vcf).select("call_id", "gt")


@query(
    "src_vcf_small",
    """SELECT call_id, chrom, CASE WHEN call_id % 2 = 0 THEN start_pos ELSE start_pos + 1 END AS start_pos, CASE WHEN call_id % 2 = 0 THEN start_pos + sv_len % 120 ELSE start_pos + 1 END AS end_pos, CASE WHEN call_id % 2 = 0 THEN 'DEL' ELSE 'INS' END AS sv_type, sv_len % 120 AS sv_len
    FROM calls WHERE source = 'HaplotypeCaller' AND sv_len % 120 + 1 >= 50 AND call_id % 9 <> 0""",
    ("calls",),
)
def src_vcf_small(t: Inputs) -> DataFrame:
    long = F.concat(F.lit("A"), F.expr("repeat('C', CAST(sv_len % 120 AS INT))"))
    even = F.col("call_id") % 2 == 0
    line = F.concat_ws("\t", "chrom", F.col("start_pos").cast("string"), F.lit("."), F.when(even, long).otherwise("A"), F.when(even, "A").otherwise(long), F.lit("50"), F.when(F.col("call_id") % 9 == 0, "LowQual").when(F.col("call_id") % 3 == 0, ".").otherwise("PASS"), F.lit("AC=1"), F.lit("GT"), F.lit("0/1"))
    lines = t.calls.where("source = 'HaplotypeCaller'").select("call_id", line.alias("value"))
    return native.vcf_small(native.vcf(lines)).select("call_id", "chrom", "start_pos", "end_pos", "sv_type", "sv_len")


@query("src_vcf_dir", f"SELECT chrom, start_pos, sv_type FROM {VC} AND chrom IN ('1', '2')", ("calls",))
def src_vcf_dir(t: Inputs) -> DataFrame:
    """Calls from a folder per chromosome, of which only the wanted ones are opened."""
    path = f"{shared_folder(t.spark)}/vcf-{uuid.uuid4().hex}"
    t.lines_vcf.select("value", F.substring_index("value", "\t", 1).alias("chrom")).write.partitionBy("chrom").text(path)
    lines = native.vcf_folder(t.spark, path, ["1", "2"])
    return native.vcf(lines).select("chrom", F.col("pos").alias("start_pos"), F.col("info")["SVTYPE"].alias("sv_type"))


@query("src_contigs", "SELECT chrom, CAST(length AS BIGINT) AS length FROM contigs", ("contigs",))
def src_contigs(t: Inputs) -> DataFrame:
    lines = t.contigs.select(F.concat_ws("\t", F.concat("chrom", F.lit(" dna")), F.col("length").cast("string"), F.lit("52"), F.lit("60"), F.lit("61")).alias("value"))
    return native.contigs(lines)


@query("src_contig_headers", "SELECT call_id, chrom, start_pos, end_pos, sv_type, call_id % 7 AS contig, 900 AS contig_len, 12.5::DOUBLE AS coverage FROM calls WHERE sv_type IN ('DEL', 'DUP')", ("calls",))
def src_contig_headers(t: Inputs) -> DataFrame:
    number = (F.col("call_id") % 7).cast("string")
    place = [F.col(c).cast("string") for c in ("start_pos", "end_pos")]
    one = F.concat(F.lit(">"), F.concat_ws("_", "chrom", *place, "sv_type", F.lit("NODE"), number, F.lit("length_900_cov_12.5")))
    two = F.concat(F.lit(">"), F.concat_ws(".", "chrom", place[0], "chrom", place[1], "sv_type", F.lit("0")), F.lit(".Contig"), number, F.lit(" 900 12.5"))
    lines = t.calls.where("sv_type in ('DEL', 'DUP')").select("call_id", F.when(F.col("call_id") % 2 == 0, one).otherwise(two).alias("value"))
    return native.contig_headers(lines)


@query("src_packed_bed", "SELECT call_id, sv_type, sv_len, source AS tool FROM calls", ("calls",))
def src_packed_bed(t: Inputs) -> DataFrame:
    packed = t.calls.select("call_id", native.pack_name(F.create_map(F.lit("TOOL"), F.col("source")), F.col("sv_type"), F.col("sv_len"), filters.methods_of(F.array("source"))).alias("name"))
    return packed.select("call_id", native.packed_name(F.col("name")).alias("n")).select("call_id", "n.sv_type", "n.sv_len", F.col("n.info")["TOOL"].alias("tool"))


@query("src_reads", "SELECT read_id, pos, aend FROM reads WHERE chrom = '1' AND pos < 2000000 AND aend > 100000", ("reads",))
def src_reads(t: Inputs) -> DataFrame:
    return t.reads.where("chrom = '1' and pos < 2000000 and aend > 100000").select("read_id", "pos", "aend")


# Sinks


def judged(t: Inputs) -> DataFrame:
    return t.calls.withColumns({"sources": F.array("source"), "is_validated": F.col("call_id") % 3 == 0, "is_precise": filters.is_precise_source(F.col("source"))})


METHODS = "CASE source WHEN 'Pindel' THEN 'SR' WHEN 'BreakSeq' THEN 'JM' WHEN 'HaplotypeCaller' THEN 'AS' WHEN 'BreakDancer' THEN 'RP' WHEN 'CNVnator' THEN 'RD' ELSE 'RP,SR' END"
PRECISE = "source IN ('Pindel', 'BreakSeq', 'HaplotypeCaller')"
VCF_LINE = f"""concat_ws(chr(9), chrom, start_pos, '.', 'N', '<' || sv_type || '>', '.', CASE WHEN call_id % 3 = 0 THEN 'PASS' ELSE 'LowQual' END,
    concat_ws(';', 'SVTYPE=' || sv_type, 'SVLEN=' || CASE WHEN sv_type = 'DEL' THEN -sv_len ELSE sv_len END, CASE WHEN sv_type IN ('DEL', 'DUP', 'ITX', 'CTX') THEN 'END=' || end_pos END, CASE WHEN sv_type IN ('ITX', 'CTX') THEN 'CHR2=' || chrom2 END,
    'SVMETHOD=' || {METHODS}, 'NUM_SVTOOLS=1', CASE WHEN NOT ({PRECISE}) THEN 'IMPRECISE' END, 'VT=SV', CASE WHEN sv_type = 'INS' AND NOT ({PRECISE}) THEN 'CIPOS=0,0' END), 'GT', '1/1')"""


REF_SQL = "calls LEFT JOIN (SELECT chrom AS seq_chrom, chunk, seq FROM sequence) ON seq_chrom = chrom AND chunk = (start_pos - 1) // 64"
REF_BASE = "coalesce(substr(seq, (start_pos - 1) % 64 + 1, 1), 'N')"


@query("sink_vcf", f"SELECT call_id, {VCF_LINE.replace("'N'", REF_BASE, 1)} AS value FROM {REF_SQL} WHERE start_pos > 0 AND source <> 'HaplotypeCaller'", ("calls", "sequence"))
def sink_vcf(t: Inputs) -> DataFrame:
    return sinks.vcf_rows(with_reference(judged(t), t.sequence, 64)).select("call_id", "value")


@query("vcf_concat", f"SELECT contig_ord, start_pos, call_id, {VCF_LINE} AS value FROM calls JOIN contigs USING (chrom) WHERE start_pos > 0 AND source <> 'HaplotypeCaller'", ("calls", "contigs"))
def vcf_concat(t: Inputs) -> DataFrame:
    """The chromosomes' records in the order of the reference."""
    return sinks.in_contig_order(sinks.vcf_rows(judged(t)), t.contigs).select("contig_ord", "start_pos", "call_id", "value")


@query("sink_per_tool", f"SELECT source, call_id, {VCF_LINE} AS value FROM calls WHERE start_pos > 0 AND source <> 'HaplotypeCaller'", ("calls",))
def sink_per_tool(t: Inputs) -> DataFrame:
    """The lines of each caller's own file, as `write_per_caller` deals them to folders."""
    calls = judged(t)
    return sinks.vcf_rows(calls).join(calls.select("call_id", "source"), "call_id").select("source", "call_id", "value")


@query(
    "sink_svp",
    f"SELECT call_id, concat_ws(chr(9), chrom, start_pos, start_pos, end_pos, end_pos, sv_type, sv_len, 'BWA', 'Illumina', 'S1', {METHODS}, 'merged', call_id) AS value FROM calls WHERE start_pos > 0 AND sv_type IN ('DEL', 'INS', 'INV') AND source <> 'HaplotypeCaller'",
    ("calls",),
)
def sink_svp(t: Inputs) -> DataFrame:
    return sinks.svp_rows(judged(t))


BED_END = "CASE WHEN sv_type = 'INS' THEN end_pos + 1 WHEN sv_type IN ('ITX', 'CTX') THEN start_pos + 1 ELSE end_pos END"


@query(
    "sink_bed",
    f"""WITH b AS (SELECT *, {BED_END} AS bed_end, replace({METHODS}, ',', ';') AS methods, CASE WHEN source IN ('Manta', 'Lumpy') THEN '2' ELSE '1' END AS n_methods FROM calls WHERE start_pos > 0)
    SELECT call_id, concat_ws(chr(9), chrom, start_pos, bed_end, concat_ws(',', base64(encode('{{"NUM_SVTOOLS":"1","NUM_SVMETHODS":"' || n_methods || '"'
      || CASE WHEN sv_type IN ('ITX', 'CTX') THEN ',"POS2":"' || end_pos || '","END":"' || bed_end || '","CHR2":"' || chrom2 || '"' ELSE '' END || '}}')), sv_type, sv_len, methods), 1) AS value FROM b""",
    ("calls",),
)
def sink_bed(t: Inputs) -> DataFrame:
    return sinks.bed_rows(judged(t))


@query(
    "tool_to_vcf",
    """SELECT call_id, concat_ws(chr(9), chrom, CASE WHEN source = 'Pindel' THEN start_pos - 1 ELSE start_pos END, '.', 'N', '<' || sv_type || '>', '.', '.', concat_ws(';', 'SVTYPE=' || sv_type, 'SVLEN=' || CASE WHEN source <> 'Pindel' AND sv_type = 'DEL' THEN -sv_len ELSE sv_len END, 'END=' || end_pos,
    CASE WHEN source IN ('BreakDancer', 'CNVnator') THEN 'IMPRECISE' END), 'GT', '1/1') AS value FROM calls WHERE source IN ('Pindel', 'BreakDancer', 'CNVnator', 'BreakSeq')""",
    ("calls",),
)
def tool_to_vcf(t: Inputs) -> DataFrame:
    return sinks.tool_rows(t.calls.where(F.col("source").isin("Pindel", "BreakDancer", "CNVnator", "BreakSeq"))).select("call_id", "value")


# The whole path


def native_calls(t: Inputs) -> DataFrame:
    """The calls of four callers, from their own lines."""
    kept = ["call_id", "chrom", "chrom2", "start_pos", "end_pos", "sv_type", "sv_len", "source", "wiggle"]
    plain = lambda df, source, wiggle=0: df.withColumns({"source": F.lit(source), "wiggle": F.lit(wiggle) if isinstance(wiggle, int) else wiggle})
    own = lambda df: df.withColumn("chrom2", F.col("chrom")).select(*kept)
    breakdancer = plain(native.normalised_breakdancer(native.breakdancer(t.lines_breakdancer)), "BreakDancer").select(*kept)
    pindel = own(plain(native.normalised_pindel(native.pindel(t.lines_pindel)), "Pindel", F.col("wiggle")))
    cnvnator = own(plain(native.normalised(native.cnvnator(t.lines_cnvnator), "CNVnator"), "CNVnator"))
    breakseq = own(plain(native.normalised(native.breakseq(t.lines_breakseq), "BreakSeq"), "BreakSeq"))
    return breakdancer.unionByName(pindel).unionByName(cnvnator).unionByName(breakseq)


NATIVE_SQL = f"""wp AS (SELECT call_id, chrom, chrom2, start_pos, end_pos, CASE WHEN sv_type IN ('ITX', 'CTX') THEN 0 ELSE sv_len END AS sv_len, sv_type, source, 0 AS own_wiggle FROM {BD} AND (chrom = chrom2 OR sv_type = 'CTX')
  UNION ALL SELECT call_id, chrom, chrom, start_pos, CASE WHEN sv_type = 'INS' THEN start_pos ELSE end_pos END, sv_len, sv_type, source, CASE WHEN sv_type = 'INS' THEN 100 ELSE 0 END FROM {PD}
  UNION ALL SELECT call_id, chrom, chrom, start_pos, end_pos, end_pos - start_pos, sv_type, source, 0 FROM {CN}
  UNION ALL SELECT call_id, chrom, chrom, start_pos, end_pos, CASE WHEN sv_type = 'INS' THEN 0 ELSE end_pos - start_pos END, sv_type, source, 0 FROM {BS}),
wq AS MATERIALIZED (SELECT * FROM wp WHERE (sv_len >= 50 OR sv_type IN ('ITX', 'CTX')) AND NOT EXISTS (SELECT 1 FROM gaps g WHERE g.chrom = wp.chrom AND greatest(wp.start_pos - own_wiggle, g.start_pos) < least(wp.end_pos + own_wiggle, g.end_pos)))"""


@query(
    "lines_to_vcf",
    f"""WITH RECURSIVE {NATIVE_SQL}, {VALIDATE_SQL.replace("FROM calls", "FROM wq")},
    fs AS (SELECT *, CASE WHEN is_validated AND is_precise THEN by_s ELSE call_start END AS s0, CASE WHEN is_validated AND is_precise THEN by_e ELSE call_end END AS e0, CASE WHEN is_validated AND is_precise THEN CASE WHEN by_len <> 0 THEN by_len ELSE coalesce(some_len, by_len) END ELSE sv_len END AS len0 FROM v),
    fx AS (SELECT *, CASE WHEN sv_type = 'INS' AND is_precise THEN (s0 + e0) // 2 ELSE s0 END AS fs_, CASE WHEN sv_type = 'INS' AND is_precise THEN (s0 + e0) // 2 WHEN sv_type = 'INS' THEN s0 ELSE e0 END AS fe_ FROM fs WHERE len0 BETWEEN 50 AND 1000000 OR sv_type IN ('ITX', 'CTX')),
    me AS (SELECT l2_id, string_agg(DISTINCT k, ',' ORDER BY k) AS methods FROM (SELECT l2_id, unnest({METHODS_SQL}) AS k FROM (SELECT l2_id, unnest(string_split(sources, ',')) AS source FROM fx)) GROUP BY l2_id)
    SELECT l2_id AS call_id, chrom, fs_ AS start_pos, concat_ws(chr(9), chrom, fs_, '.', 'N', '<' || sv_type || '>', '.', CASE WHEN is_validated THEN 'PASS' ELSE 'LowQual' END,
      concat_ws(';', 'SVTYPE=' || sv_type, 'SVLEN=' || CASE WHEN sv_type = 'DEL' THEN -len0 ELSE len0 END, CASE WHEN sv_type IN ('DEL', 'DUP', 'ITX', 'CTX') THEN 'END=' || fe_ END, CASE WHEN sv_type IN ('ITX', 'CTX') THEN 'CHR2=' || chrom2 END,
      'SVMETHOD=' || methods, 'NUM_SVTOOLS=' || n_sources, CASE WHEN NOT is_precise THEN 'IMPRECISE' END, 'VT=SV', CASE WHEN sv_type = 'INS' AND NOT is_precise THEN 'CIPOS=0,0' END), 'GT', '1/1') AS value FROM fx JOIN me USING (l2_id) WHERE fs_ > 0""",
    ("calls", "gaps"),
)
def lines_to_vcf(t: Inputs) -> DataFrame:
    """From callers' lines to the merged, validated and printed calls."""
    usable = merge.settled(filters.long_enough(native_calls(t)))
    clear = filters.outside_gaps(usable, t.gaps, F.col("wiggle")).withColumn("wiggle", filters.wiggle_of())
    final = filters.length_between(filters.fixed_position(merge.consolidated(clear)))
    return sinks.vcf_rows(final.withColumnRenamed("l2_id", "call_id"))


READ_COLUMNS = "read_id long, qname string, chrom string, pos long, aend long"


@query(
    "reads_by_region",
    "SELECT c.call_id, r.read_id FROM calls c JOIN reads r ON r.chrom = c.chrom AND greatest(r.pos, c.start_pos - 500) < least(r.aend, c.end_pos + 500) WHERE c.sv_type = 'INV' AND c.start_pos < 4000000",
    ("calls", "reads"),
)
def reads_by_region(t: Inputs) -> DataFrame:
    """Reads near inversions of the first four million bases, from a clustered copy of the reads of which only touched blocks are opened."""
    path = f"{shared_folder(t.spark)}/reads-{uuid.uuid4().hex}"
    layout.write_clustered(t.reads.select("read_id", "qname", "chrom", "pos", "aend"), path, 1 << 18)
    windows = t.calls.where("sv_type = 'INV' and start_pos < 4000000").select("call_id", "chrom", (F.col("start_pos") - 500).alias("start_pos"), (F.col("end_pos") + 500).alias("end_pos"))
    near = layout.touching(layout.read_clustered(t.spark, path, READ_COLUMNS), windows, 200, 1 << 18)
    return overlap_join(windows, near.select("read_id", "chrom", F.col("pos").alias("start_pos"), F.col("aend").alias("end_pos"))).select("call_id", F.col("b_read_id").alias("read_id"))
