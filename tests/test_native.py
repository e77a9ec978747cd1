"""Line formats that the fixture views do not print."""

from pyspark.sql import functions as F

from svloom.sources import native, sinks


def lines(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "nr int, value string")


def test_pindel_long_insertion_and_wide_samples(spark):
    li = "3\tLI\tChrID 22\t1000\t+ 4\tx\t990\t5\t- 6\ts1 + 4 - 5"
    li = "3 LI ChrID 22 1000 + 4 990 - 6 s1 + 4 - 5"
    wide = '7 INV 80 NT 2:3 "AC":"GGT" ChrID 22 BP 100 181 BP_range 100 183 Supports 9 8 + 5 4 - 4 4 S1 9 SUM_MS 240 1 NumSupSamples 1 1 s1 1 2 3 4 5 6'
    got = native.pindel(lines(spark, li, wide, "no record")).orderBy("nr").collect()
    assert [(r["pindel_type"], r["start_pos"], r["end_pos"], r["up_reads"], r["down_reads"]) for r in got] == [("LI", 990, 990, 4, 6), ("INV", 100, 180, 5, 4)]
    assert got[1]["nt_lengths"] == [2, 3] and got[1]["nt_added"] == ["AC", "GGT"]
    samples = native.pindel_samples(native.pindel(lines(spark, li, wide))).orderBy("nr").collect()
    assert [(r["sample"], r["ref_start"], r["plus"], r["minus"]) for r in samples] == [("s1", None, 4, 5), ("s1", 1, 7, 11)]


def test_breakdancer_header(spark):
    rows = native.breakdancer_header(lines(spark, "#Software: 1.4", "#Command: run x", "#lib.bam\tmean:350\tstd:50", "#Chr1\tPos1", "22\t1\t5+0-")).collect()
    got = {r["name"]: r["stats"] for r in rows}
    assert got["lib.bam"] == {"mean": "350", "std": "50"}
    assert got["Software"] == {"text": "1.4"} and len(got) == 3


def test_cnvnator_scientific_numbers(spark):
    r = native.cnvnator(lines(spark, "deletion\t22:1-16050000\t1.605e+07\t0\t1e-11\t0\t1e-11\t0\t-1")).first()
    assert (r["sv_type"], r["start_pos"], r["end_pos"], r["sv_len"], r["q0"]) == ("DEL", 1, 16050000, 16049999, -1.0)


def test_vcf_rules(spark):
    base = "1\t{0}\t.\tN\t{1}\t.\tPASS\t{2}\tGT:PL\t0/1:3"
    values = [base.format(10, "<DEL>", "SVTYPE=DEL;END=200;SVLEN=-190,5"), base.format(10, "<DEL>,<DUP>", "SVTYPE=DEL;END=200;SVLEN=190"), base.format(10, "<DUP:TANDEM>", "SVTYPE=DUP:TANDEM;END=90;SVLEN=80"), base.format(10, "<INS>", "SVTYPE=INS;END=10"), base.format(10, "<DEL>", "SVTYPE=DEL;SVLEN=99"), "#CHROM\tPOS"]
    got = native.vcf_calls(native.vcf(lines(spark, *values)), F.lit("Manta")).orderBy("nr").collect()
    assert [(r["nr"], r["sv_type"], r["sv_len"], r["gt"]) for r in got] == [(0, "DEL", 190, "0/1"), (2, "DUP", 80, "0/1")]
    pindel = native.vcf_calls(native.vcf(lines(spark, base.format(10, "<INS>", "SVTYPE=INS;END=10;SVLEN=70"))), F.lit("Pindel")).first()
    assert (pindel["start_pos"], pindel["wiggle"]) == (11, 100)


def test_malformed_lines_do_not_fail(spark):
    bad = lines(spark, "", "x", "a b c d e f g h i j k", "1\tx\t.\tN\t<DEL>\t.\tPASS\tSVTYPE=DEL\tGT\t0/1")
    for read in (native.breakdancer, native.pindel, native.cnvnator, native.breakseq, native.vcf):
        read(bad).collect()


def test_sinks_write_and_read_back(spark, tmp_path, sf_dir):
    from svloom.fixtures import Inputs
    from svloom.plans.text import judged

    t = Inputs(spark, sf_dir)
    sinks.write_vcf(judged(t), t.contigs, f"{tmp_path}/vcf")
    back = native.vcf(spark.read.text(f"{tmp_path}/vcf/1-records"))
    assert back.count() == sinks.vcf_rows(judged(t)).count()
    assert spark.read.text(f"{tmp_path}/vcf/0-header").count() == len(sinks.VCF_HEADER)
    sinks.write_per_caller(judged(t), f"{tmp_path}/callers")
    assert spark.read.text(f"{tmp_path}/callers").select("source").distinct().count() == 6


def test_folders_of_other_contigs_are_not_opened(spark, tmp_path):
    """Partition pruning: a folder that can't be read does no harm if its contig isn't wanted."""
    spark.createDataFrame([("1\t5", "1"), ("2\t6", "2"), ("X\t7", "X")], "value string, chrom string").write.partitionBy("chrom").text(f"{tmp_path}/vcf")
    lines = native.vcf_folder(spark, f"{tmp_path}/vcf", ["1", "X"])
    assert sorted(r["value"] for r in lines.collect()) == ["1\t5", "X\t7"]
    assert "PartitionFilters: [isnotnull(chrom" in lines._jdf.queryExecution().toString() or "PartitionFilters: [chrom" in lines._jdf.queryExecution().toString()
