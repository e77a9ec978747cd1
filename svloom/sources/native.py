"""Callers' own text formats, read as DataFrames of lines with a `value` column.

Other columns of the lines stay. Numbers are cast, not checked: a malformed field is null.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.filters import is_translocation


def _fields(value: Column) -> Column:
    return F.split(F.trim(value), r"\s+")


def _at(fields: Column, i: int, kind: str = "string") -> Column:
    return F.get(fields, F.lit(i)).try_cast(kind)


# BreakDancer


def breakdancer(lines: DataFrame) -> DataFrame:
    """Call lines; sizes are absolute, `lib_reads` maps a library to its reads."""
    f = F.col("_f")
    libs = F.map_from_entries(F.transform(F.split(_at(f, 10), ":"), lambda x: F.struct(F.substring_index(x, "|", 1).alias("k"), F.substring_index(x, "|", -1).try_cast("int").alias("v"))))
    named = [("chr1", 0, "string"), ("pos1", 1, "bigint"), ("ori1", 2, "string"), ("chr2", 3, "string"), ("pos2", 4, "bigint"), ("ori2", 5, "string"), ("sv_type", 6, "string")]
    rows = lines.where(~F.col("value").startswith("#")).withColumn("_f", _fields(F.col("value")))
    return rows.select(*[c for c in lines.columns if c != "value"], *[_at(f, i, k).alias(n) for n, i, k in named], F.abs(_at(f, 7, "bigint")).alias("sv_len"), _at(f, 8, "double").alias("score"), _at(f, 9, "int").alias("num_reads"), libs.alias("lib_reads"))


def breakdancer_header(lines: DataFrame) -> DataFrame:
    """The library statistics of `#file key:value ...` lines, and Software and Command: `name, stats`."""
    head = lines.where(F.col("value").startswith("#")).withColumn("_h", F.regexp_replace("value", "^#", ""))
    name = F.substring_index(F.regexp_replace("_h", r"[:\s].*$", ""), "\t", 1)
    plain = F.col("_h").rlike("^(Software|Command):")
    stats = F.str_to_map(F.regexp_replace(F.regexp_replace("_h", r"^\S+\s+", ""), r"\s+", " "), F.lit(" "), F.lit(":"))
    return head.where(~F.col("_h").startswith("Chr1")).select(name.alias("name"), F.when(plain, F.create_map(F.lit("text"), F.trim(F.regexp_replace("_h", "^[^:]*:", "")))).otherwise(stats).alias("stats"))


def normalised_breakdancer(records: DataFrame) -> DataFrame:
    """Records to calls. Calls across chromosomes are dropped unless they are CTX."""
    tx = is_translocation()
    room = F.col("pos2") - F.col("pos1")
    cipos = F.when(F.col("sv_type") == "INS", room).when(tx, F.lit(0)).otherwise(room - F.col("sv_len"))
    kept = records.where(((F.col("chr1") == F.col("chr2")) | (F.col("sv_type") == "CTX")) & F.col("sv_type").isin("DEL", "INS", "INV", "ITX", "CTX"))
    return kept.withColumns({"chrom": F.col("chr1"), "chrom2": F.col("chr2"), "start_pos": F.col("pos1") + 1, "end_pos": F.col("pos2"), "cipos": F.array(F.lit(0).cast("bigint"), cipos.cast("bigint")), "sv_len": F.when(tx, 0).otherwise(F.col("sv_len")), "source": F.lit("BreakDancer")}).drop("chr1", "chr2", "pos1", "pos2")


# Pindel

PINDEL_TYPES = {"I": "INS", "LI": "INS", "D": "DEL", "TD": "DUP", "INV": "INV"}


def pindel(lines: DataFrame) -> DataFrame:
    """Records of the lines that name a chromosome; long insertions (LI) have a layout of their own."""
    f, long_ins = F.col("_f"), F.col("_f")[1] == "LI"
    rows = lines.where(F.instr("value", "ChrID") > 1).withColumn("_f", _fields(F.col("value")))
    pick = lambda i, kind="bigint", li=None: F.when(~long_ins, _at(f, i, kind)).otherwise(_at(f, li, kind) if li is not None else F.lit(None).cast(kind))
    start = F.when(long_ins, F.least(_at(f, 4, "bigint"), _at(f, 7, "bigint"))).otherwise(_at(f, 9, "bigint"))
    end = F.when(long_ins, start).otherwise(_at(f, 10, "bigint") - 1)
    out = rows.select(
        *[c for c in lines.columns if c != "value"], "_f",
        _at(f, 1).alias("pindel_type"), F.when(long_ins, F.lit(0)).otherwise(_at(f, 2, "bigint")).alias("sv_len"), F.when(~long_ins, F.transform(F.split(_at(f, 4), ":"), lambda x: x.try_cast("int"))).alias("nt_lengths"),
        F.when(~long_ins, F.transform(F.split(_at(f, 5), ":"), lambda x: F.replace(x, F.lit('"'), F.lit("")))).alias("nt_added"), F.when(long_ins, _at(f, 3)).otherwise(_at(f, 7)).alias("chrom"), start.alias("start_pos"), end.alias("end_pos"),
        F.when(long_ins, start).otherwise(_at(f, 12, "bigint")).alias("bp_range_start"), F.when(long_ins, end).otherwise(_at(f, 13, "bigint")).alias("bp_range_end"), pick(15).alias("reads"), pick(16).alias("unique_reads"),
        pick(18, li=6).alias("up_reads"), pick(19).alias("up_unique"), pick(21, li=9).alias("down_reads"), pick(22).alias("down_unique"), pick(24).alias("score"), pick(26).alias("sum_mapq"), pick(27).alias("n_samples"), pick(29).alias("n_supporting"), pick(30).alias("n_unique"),
    )
    return out.withColumn("homlen", F.col("bp_range_end") - F.col("end_pos"))


def pindel_samples(records: DataFrame) -> DataFrame:
    """One row per sample of a record, from groups of 7 (newer) or 5 fields, or 5 fields of a long insertion."""
    n, f = F.size("_f"), F.col("_f")
    long_ins = F.col("pindel_type") == "LI"
    first, width = F.when(long_ins, 10).otherwise(31), F.when(~long_ins & (n > 31 + 5 * F.col("n_samples")), 7).otherwise(5)
    at = lambda i, d: F.get(f, i + d).try_cast("bigint")
    seven = width == 7

    def group(i: Column) -> Column:
        plus = F.when(long_ins, at(i, 2)).when(seven, at(i, 3) + at(i, 4)).otherwise(at(i, 3))
        minus = F.when(long_ins, at(i, 4)).when(seven, at(i, 5) + at(i, 6)).otherwise(at(i, 4))
        ref = lambda d: F.when(~long_ins, at(i, d))
        return F.struct(F.get(f, i).alias("sample"), ref(1).alias("ref_start"), ref(2).alias("ref_end"), plus.alias("plus"), minus.alias("minus"))

    groups = F.when(n > first, F.transform(F.sequence(first, n - 1, width), group))
    return records.withColumn("s", F.explode(groups)).select(*[c for c in records.columns if c != "_f"], "s.*")


def pindel_genotype(min_coverage: int = 10, het: float = 0.2, hom: float = 0.8) -> Column:
    ref = F.col("up_unique") + F.col("down_unique")
    share = F.col("unique_reads") / (F.col("unique_reads") + ref)
    other = F.when(F.col("unique_reads") + ref < min_coverage, "0/0").when(share < het, "0/0").when(share < hom, "0/1").otherwise("1/1")
    return F.when(F.col("pindel_type").isin("LI", "I"), F.when(F.col("up_reads") + F.col("down_reads") > 0, "0/1").otherwise("0/0")).otherwise(other)


def normalised_pindel(records: DataFrame) -> DataFrame:
    types = F.create_map(*[F.lit(x) for kv in PINDEL_TYPES.items() for x in kv])
    out = records.withColumn("sv_type", types[F.col("pindel_type")]).where("sv_type is not null")
    ins = F.col("sv_type") == "INS"
    return out.withColumns({"end_pos": F.when(ins, F.col("start_pos")).otherwise(F.col("end_pos")), "wiggle": F.when(ins, 100).otherwise(0), "gt": pindel_genotype(), "source": F.lit("Pindel")})


# CNVnator and BreakSeq


def cnvnator(lines: DataFrame) -> DataFrame:
    f = F.col("_f")
    place = lambda i: F.regexp_extract(_at(f, 1), r"^(.*):(\d+)-(\d+)$", i)
    rows = lines.withColumn("_f", _fields(F.col("value"))).where(F.size("_f") >= 9)
    named = [(n, _at(f, i, "double").alias(n)) for n, i in (("rd", 3), ("e1", 4), ("e2", 5), ("e3", 6), ("e4", 7), ("q0", 8))]
    out = rows.select(*[c for c in lines.columns if c != "value"], F.when(f[0] == "deletion", "DEL").when(f[0] == "duplication", "DUP").alias("sv_type"), place(1).alias("chrom"), place(2).try_cast("bigint").alias("start_pos"), place(3).try_cast("bigint").alias("end_pos"), *[c for _, c in named])
    return out.withColumn("sv_len", F.col("end_pos") - F.col("start_pos"))


def breakseq(lines: DataFrame) -> DataFrame:
    """GFF lines; attributes are `key value` pairs between semicolons. Insertions have no length."""
    f = F.col("_f")
    rows = lines.where(~F.col("value").startswith("#")).withColumn("_f", F.split("value", "\t")).where(F.size("_f") >= 9)
    kind = F.when(_at(f, 2) == "Deletion", "DEL").when(_at(f, 2) == "Insertion", "INS")
    start, end = _at(f, 3, "bigint") - 1, _at(f, 4, "bigint")
    attributes = F.str_to_map(_at(f, 8), F.lit(";"), F.lit(" "))
    out = rows.select(*[c for c in lines.columns if c != "value"], _at(f, 0).alias("chrom"), kind.alias("sv_type"), start.alias("start_pos"), end.alias("end_pos"), _at(f, 5, "double").alias("score"), attributes.alias("attributes"))
    return out.withColumns({"sv_len": F.when(F.col("sv_type") == "INS", 0).otherwise(F.col("end_pos") - F.col("start_pos")), "filter": F.col("attributes")["QUAL"], "abc": F.transform(F.split(F.col("attributes")["ABC"], ","), lambda x: x.try_cast("int")), "pe": F.col("attributes")["PE"].try_cast("int")})


def normalised(records: DataFrame, source: str) -> DataFrame:
    return records.where("sv_type is not null").withColumn("source", F.lit(source))


# VCF


def vcf(lines: DataFrame) -> DataFrame:
    """Records of VCF lines with `info` as a map; a flag has the value "true"."""
    f = F.col("_f")
    rows = lines.where(~F.col("value").startswith("#")).withColumn("_f", F.split("value", "\t"))
    out = rows.select(*[c for c in lines.columns if c != "value"], _at(f, 0).alias("chrom"), _at(f, 1, "bigint").alias("pos"), _at(f, 3).alias("ref"), _at(f, 4).alias("alt"), _at(f, 6).alias("filter"), info_map(_at(f, 7)).alias("info"), _at(f, 8).alias("format"), _at(f, 9).alias("sample_value"))
    return out.withColumn("gt", genotype(F.col("format"), F.col("sample_value")))


def vcf_folder(spark: SparkSession, path: str, contigs: Sequence[str]) -> DataFrame:
    """The lines of a folder that has one folder, `chrom=<contig>`, for each contig; those of other contigs are not opened."""
    return spark.read.schema("value string, chrom string").text(path).where(F.col("chrom").isin(*contigs)).select("value")


def info_map(info: Column) -> Column:
    """`k=v;flag` to a map of strings; values of several parts keep their commas."""
    flags = F.array_join(F.transform(F.split(info, ";"), lambda x: F.when(F.instr(x, "=") > 0, x).otherwise(F.concat(x, F.lit("=true")))), ";")
    return F.str_to_map(flags, F.lit(";"), F.lit("="))


def genotype(format_: Column, sample: Column) -> Column:
    at = F.array_position(F.split(format_, ":"), F.lit("GT"))
    return F.when(at > 0, F.try_element_at(F.split(sample, ":"), at.cast("int")))


def vcf_calls(records: DataFrame, source: Column, least: int = 50, most: int = 1_000_000, wiggle: int = 100, ins_wiggle: int = 100) -> DataFrame:
    """Structural records: one ALT, a type and an end; lengths absolute, of several the first.

    A missing length counts as 0 for insertions of BreakSeq; other records without one go.
    """
    info = F.col("info")
    sv_type = F.regexp_replace(info["SVTYPE"], "^DUP:TANDEM$", "DUP")
    given = F.abs(F.get(F.split(info["SVLEN"], ","), F.lit(0)).try_cast("bigint"))
    one = (F.size(F.split("alt", ",")) == 1) & info["SVTYPE"].isNotNull() & info["END"].isNotNull()
    rows = records.where(one).withColumns({"sv_type": sv_type, "source": source})
    rows = rows.withColumn("sv_len", F.coalesce(given, F.when((F.col("source") == "BreakSeq") & (F.col("sv_type") == "INS"), 0)))
    rows = rows.where(F.col("sv_len").isNotNull() & (F.col("sv_len").between(least, most) | ((F.col("source") == "BreakSeq") & (F.col("sv_type") == "INS")) | is_translocation()))
    ins = F.col("sv_type") == "INS"
    start = F.col("pos") + F.when((F.col("source") == "Pindel") & ins, 1).otherwise(0)
    precise = F.col("source").isin("Pindel", "BreakSeq", "HaplotypeCaller", "SoftClip")
    return rows.withColumns({"start_pos": start, "end_pos": info["END"].try_cast("bigint"), "wiggle": F.when(ins & precise, F.greatest(F.lit(ins_wiggle), F.lit(wiggle))).otherwise(wiggle)})


def vcf_small(records: DataFrame, least: int = 50, wiggle: int = 100, ins_wiggle: int = 100) -> DataFrame:
    """Indels of a small-variant caller: passing or unset filter, one ALT, long enough, not of equal lengths."""
    n_ref, n_alt = F.length("ref"), F.length("alt")
    kept = records.where(F.col("filter").isin("PASS", ".") & (F.size(F.split("alt", ",")) == 1) & ~F.col("alt").startswith("<") & (F.greatest(n_ref, n_alt) >= least) & (n_ref != n_alt))
    dele = n_ref > n_alt
    start = F.when(dele, F.col("pos")).otherwise(F.col("pos") + 1)
    return kept.withColumns({"sv_type": F.when(dele, "DEL").otherwise("INS"), "start_pos": start, "end_pos": F.when(dele, F.col("pos") + n_ref - 1).otherwise(start), "sv_len": F.abs(n_ref - n_alt).try_cast("bigint"), "wiggle": F.lit(max(wiggle, ins_wiggle)), "source": F.lit("HaplotypeCaller")})


# Contigs, assembled contigs, packed names


def contigs(lines: DataFrame) -> DataFrame:
    """An index of a reference: name up to a blank, and length."""
    f = F.split("value", "\t")
    return lines.select(F.substring_index(f[0], " ", 1).alias("chrom"), f[1].try_cast("bigint").alias("length"))


CONTIG_HEADER = r"^>?(\w[\w.]*)_(\d+)_(\d+)_([A-Z]+)_NODE_(\d+)_length_(\d+)_cov_([0-9.]+)"
DOTTED_HEADER = r"^>?(\w+)\.(\d+)\.(\w+)\.(\d+)\.([A-Z]+)\.(\d+)\.[^ ]*Contig(\d+) (\d+) ([0-9.]+)"


def contig_headers(lines: DataFrame) -> DataFrame:
    """Region, type, number, length and coverage of assembled contigs, from either header format."""
    v = F.col("value")
    long = v.rlike(CONTIG_HEADER)
    x, y = (lambda i: F.regexp_extract(v, CONTIG_HEADER, i)), (lambda i: F.regexp_extract(v, DOTTED_HEADER, i))
    pick = lambda i, j, kind: F.when(long, x(i)).otherwise(y(j)).try_cast(kind)
    keep = [c for c in lines.columns if c != "value"]
    return lines.where(long | v.rlike(DOTTED_HEADER)).select(*keep, pick(1, 1, "string").alias("chrom"), pick(2, 2, "bigint").alias("start_pos"), pick(3, 4, "bigint").alias("end_pos"), pick(4, 5, "string").alias("sv_type"), pick(5, 7, "bigint").alias("contig"), pick(6, 8, "bigint").alias("contig_len"), pick(7, 9, "double").alias("coverage"))


def packed_name(name: Column) -> Column:
    """`base64(json),type,length,methods` to a struct."""
    f = F.split(name, ",")
    info = F.from_json(F.unbase64(f[0]).cast("string"), "map<string,string>")
    return F.struct(info.alias("info"), f[1].alias("sv_type"), f[2].try_cast("bigint").alias("sv_len"), F.split(f[3], ";").alias("methods"))


def pack_name(info: Column, sv_type: Column, sv_len: Column, methods: Column) -> Column:
    packed = F.translate(F.base64(F.to_json(info).cast("binary")), "\r\n", "")  # long text comes broken into lines
    return F.concat_ws(",", packed, sv_type, sv_len.cast("string"), F.array_join(methods, ";"))
