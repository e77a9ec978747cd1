"""Text records of call sets: VCF, packed BED and 13-column rows, one `value` per call.

Calls carry call_id, chrom, chrom2, start_pos, end_pos, sv_type, sv_len, sources (array),
is_validated and is_precise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.filters import is_translocation, methods_of
from .native import pack_name

VCF_HEADER = (
    "##fileformat=VCFv4.1",
    '##INFO=<ID=END,Number=1,Type=Integer,Description="End position of the variant">',
    '##INFO=<ID=SVTYPE,Number=1,Type=String,Description="Type of structural variant">',
    '##INFO=<ID=SVLEN,Number=.,Type=Integer,Description="Difference in length between REF and ALT alleles">',
    '##INFO=<ID=CHR2,Number=1,Type=String,Description="Chromosome of the second end">',
    '##INFO=<ID=IMPRECISE,Number=0,Type=Flag,Description="Imprecise structural variation">',
    '##FORMAT=<ID=GT,Number=1,Type=String,Description="Genotype">',
    "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tsample",
)


def _only_small_variants() -> Column:
    return (F.size("sources") == 1) & (F.element_at("sources", 1) == "HaplotypeCaller")


def reportable(calls: DataFrame) -> DataFrame:
    return calls.where((F.col("start_pos") > 0) & F.col("sv_type").isin("DEL", "INS", "INV", "DUP", "ITX", "CTX") & ~_only_small_variants())


def vcf_rows(calls: DataFrame, ref: Column | None = None) -> DataFrame:
    """`call_id, chrom, start_pos, value` for each reportable call; REF is `ref_base`, if calls have it (see `sequence`), else N.

    CIPOS is that of the call, if it has one (`cipos`, a text); an imprecise insertion is put on its start, with none to either side.
    """
    if ref is None:
        ref = F.col("ref_base") if "ref_base" in calls.columns else F.lit("N")
    tx = is_translocation()
    methods = methods_of(F.col("sources"))
    length = F.when(F.col("sv_type") == "DEL", -F.col("sv_len")).otherwise(F.col("sv_len"))
    info = F.concat_ws(
        ";",
        F.concat(F.lit("SVTYPE="), "sv_type"),
        F.concat(F.lit("SVLEN="), length.cast("string")),
        F.when(F.col("sv_type").isin("DEL", "DUP", "ITX", "CTX"), F.concat(F.lit("END="), F.col("end_pos").cast("string"))),
        F.when(tx, F.concat(F.lit("CHR2="), "chrom2")),
        F.concat(F.lit("SVMETHOD="), F.array_join(methods, ",")),
        F.concat(F.lit("NUM_SVTOOLS="), F.size("sources").cast("string")),
        F.when(~F.col("is_precise"), F.lit("IMPRECISE")),
        F.lit("VT=SV"),
        F.concat(F.lit("CIPOS="), F.when((F.col("sv_type") == "INS") & ~F.col("is_precise"), "0,0").otherwise(F.col("cipos") if "cipos" in calls.columns else F.lit(None))),
    )
    verdict = F.when(F.col("is_validated"), "PASS").otherwise("LowQual")
    line = F.concat_ws("\t", "chrom", F.col("start_pos").cast("string"), F.lit("."), ref, F.concat(F.lit("<"), "sv_type", F.lit(">")), F.lit("."), verdict, info, F.lit("GT"), F.lit("1/1"))
    return reportable(calls).select("call_id", "chrom", "start_pos", line.alias("value"))


def in_contig_order(rows: DataFrame, contigs: DataFrame) -> DataFrame:
    """Rows of known contigs in the order of the reference."""
    return rows.join(contigs.select("chrom", "contig_ord"), "chrom").orderBy("contig_ord", "start_pos", "call_id")


def write_vcf(calls: DataFrame, contigs: DataFrame, path: str) -> None:
    """A folder of text parts in order; the header is a part of its own, named first."""
    spark = calls.sparkSession
    spark.createDataFrame([(x,) for x in VCF_HEADER], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/0-header")
    in_contig_order(vcf_rows(calls), contigs).select("value").write.mode("overwrite").text(f"{path}/1-records")


def bed_rows(calls: DataFrame) -> DataFrame:
    """Packed BED rows; translocations keep their other end in the packed part."""
    tx = is_translocation()
    end = F.when(F.col("sv_type") == "INS", F.col("end_pos") + 1).when(tx, F.col("start_pos") + 1).otherwise(F.col("end_pos"))
    methods = methods_of(F.col("sources"))
    plain = F.create_map(F.lit("NUM_SVTOOLS"), F.size("sources").cast("string"), F.lit("NUM_SVMETHODS"), F.size(methods).cast("string"))
    more = F.create_map(F.lit("POS2"), F.col("end_pos").cast("string"), F.lit("END"), end.cast("string"), F.lit("CHR2"), F.col("chrom2"))
    info = F.when(tx, F.map_concat(plain, more)).otherwise(plain)
    name = pack_name(info, F.col("sv_type"), F.col("sv_len"), methods)
    line = F.concat_ws("\t", "chrom", F.col("start_pos").cast("string"), end.cast("string"), name, F.size("sources").cast("string"))
    return calls.where((F.col("start_pos") > 0) & F.col("sv_type").isin("DEL", "INS", "INV", "ITX", "CTX", "DUP")).select("call_id", line.alias("value"))


def svp_rows(calls: DataFrame, sample: str = "S1") -> DataFrame:
    text = lambda c: F.col(c).cast("string")
    line = F.concat_ws("\t", "chrom", text("start_pos"), text("start_pos"), text("end_pos"), text("end_pos"), "sv_type", text("sv_len"), F.lit("BWA"), F.lit("Illumina"), F.lit(sample), F.array_join(methods_of(F.col("sources")), ","), F.lit("merged"), text("call_id"))
    return calls.where((F.col("start_pos") > 0) & F.col("sv_type").isin("DEL", "INS", "INV") & ~_only_small_variants()).select("call_id", line.alias("value"))


def write_per_caller(calls: DataFrame, path: str) -> None:
    """One folder per caller, sorted inside each part."""
    rows = calls.withColumn("sources", F.array("source"))
    out = vcf_rows(rows).join(calls.select("call_id", "source"), "call_id")
    out.repartition("source", "chrom").sortWithinPartitions("source", "chrom", "start_pos", "call_id").select("source", "value").write.mode("overwrite").partitionBy("source").text(path)


def tool_rows(calls: DataFrame) -> DataFrame:
    """A single caller's calls as VCF lines, by the caller's own rules for position, end and length."""
    source, kind = F.col("source"), F.col("sv_type")
    pos = F.when(source == "Pindel", F.col("start_pos") - 1).when(source == "BreakDancer", F.col("start_pos")).otherwise(F.col("start_pos"))
    length = F.when((source != "Pindel") & (kind == "DEL"), -F.col("sv_len")).otherwise(F.col("sv_len"))
    info = F.concat_ws(";", F.concat(F.lit("SVTYPE="), kind), F.concat(F.lit("SVLEN="), length.cast("string")), F.concat(F.lit("END="), F.col("end_pos").cast("string")), F.when(source.isin("BreakDancer", "CNVnator"), F.lit("IMPRECISE")))
    line = F.concat_ws("\t", "chrom", pos.cast("string"), F.lit("."), F.lit("N"), F.concat(F.lit("<"), kind, F.lit(">")), F.lit("."), F.lit("."), info, F.lit("GT"), F.lit("1/1"))
    return calls.select("call_id", "chrom", pos.alias("start_pos"), line.alias("value"))
