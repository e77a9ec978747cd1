"""Input views over the given tables; each text is valid in Spark SQL and in DuckDB."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from .session import kept

TABLES = ("lineitem", "orders", "part")

#: Later views may read earlier ones.
VIEWS = {
    "calls": """
SELECT l_orderkey * 10 + l_linenumber AS call_id, 'S1' AS sample,
       CAST(MIN(l_suppkey) % 8 + 1 AS STRING) AS chrom,
       CAST(CASE WHEN l_orderkey % 31 = 0 THEN MAX(l_suppkey) % 8 + 1 + l_orderkey % 2 ELSE MIN(l_suppkey) % 8 + 1 END AS STRING) AS chrom2,
       MIN(l_partkey) * 2000 + (l_orderkey * 37 + l_linenumber * 101) % 1500 AS start_pos,
       MIN(l_partkey) * 2000 + (l_orderkey * 37 + l_linenumber * 101) % 1500
         + CASE WHEN MIN(l_returnflag) = 'N' AND l_orderkey % 23 <> 0 AND l_orderkey % 29 <> 0 AND l_orderkey % 31 <> 0 THEN 0
                ELSE 30 + CAST(MIN(l_quantity) AS BIGINT) * 20 END AS end_pos,
       CASE WHEN l_orderkey % 23 = 0 THEN 'INV' WHEN l_orderkey % 29 = 0 THEN 'ITX' WHEN l_orderkey % 31 = 0 THEN 'CTX'
            WHEN MIN(l_returnflag) = 'R' THEN 'DEL' WHEN MIN(l_returnflag) = 'A' THEN 'DUP' ELSE 'INS' END AS sv_type,
       CASE WHEN l_orderkey % 29 = 0 OR l_orderkey % 31 = 0 THEN 0 ELSE 30 + CAST(MIN(l_quantity) AS BIGINT) * 20 END AS sv_len,
       CASE l_linenumber WHEN 1 THEN 'Pindel' WHEN 2 THEN 'BreakSeq' WHEN 3 THEN 'HaplotypeCaller' WHEN 4 THEN 'BreakDancer'
            WHEN 5 THEN 'CNVnator' WHEN 6 THEN 'Manta' ELSE 'Lumpy' END AS source
FROM lineitem GROUP BY l_orderkey, l_linenumber
""",
    "reads": """
SELECT l_orderkey * 10 + l_linenumber AS read_id,
       CONCAT('q', CAST(FLOOR((l_orderkey * 10 + l_linenumber) / 2) AS BIGINT)) AS qname,
       CAST(MIN(l_suppkey) % 2 + 1 AS STRING) AS chrom,
       MIN(l_partkey) * 2000 + (l_orderkey * 37 + l_linenumber * 101) % 400 AS pos,
       MIN(l_partkey) * 2000 + (l_orderkey * 37 + l_linenumber * 101) % 400 + 60 + l_orderkey % 41 AS aend,
       100 AS rlen, 60 + l_orderkey % 41 AS match_len,
       CASE WHEN l_linenumber % 2 = 0 THEN 40 - l_orderkey % 41 ELSE 0 END AS clip_left,
       CASE WHEN l_linenumber % 2 = 1 THEN 40 - l_orderkey % 41 ELSE 0 END AS clip_right,
       CAST(MIN(l_quantity) AS BIGINT) AS mapq, l_orderkey % 12 AS nm, 15 + l_orderkey % 20 AS avg_qual,
       CASE WHEN MIN(l_linestatus) = 'F' THEN 1 ELSE -1 END * (150 + (l_orderkey * 53) % 401) AS tlen,
       CASE WHEN l_orderkey % 19 = 0 THEN CAST((MIN(l_suppkey) + 1) % 2 + 1 AS STRING) ELSE CAST(MIN(l_suppkey) % 2 + 1 AS STRING) END AS mate_chrom,
       MIN(l_partkey) * 2000 + (l_orderkey * 37 + l_linenumber * 101) % 400
         + CASE WHEN MIN(l_linestatus) = 'F' THEN 1 ELSE -1 END * (50 + (l_orderkey * 53) % 401) AS mate_pos,
       MIN(l_linestatus) = 'O' AS is_reverse,
       CASE WHEN l_orderkey % 7 = 0 THEN MIN(l_linestatus) = 'O' ELSE MIN(l_linestatus) <> 'O' END AS mate_is_reverse,
       l_orderkey % 50 = 0 AS is_duplicate, l_orderkey % 53 = 0 AS is_unmapped, l_orderkey % 17 = 0 AS mate_is_unmapped,
       l_linenumber % 2 = 1 AS is_read1, l_orderkey % 61 <> 0 AS is_paired
FROM lineitem GROUP BY l_orderkey, l_linenumber
""",
    "gaps": """
SELECT CAST(p_partkey % 8 + 1 AS STRING) AS chrom, p_partkey * 2000 + 1600 AS start_pos,
       p_partkey * 2000 + 1800 + p_size AS end_pos FROM part WHERE p_partkey % 4 = 0
""",
    "contigs": """
SELECT DISTINCT CAST(o_custkey % 9 + 1 AS STRING) AS chrom, o_custkey % 9 + 1 AS contig_ord, 50000000 AS length FROM orders
""",
    "track": """
SELECT CAST(o_custkey % 8 + 1 AS STRING) AS chrom, (o_orderkey % 20000) * 450 AS start_pos,
       (o_orderkey % 20000) * 450 + 100 + o_orderkey % 200 AS end_pos, CAST(o_orderkey % 100 AS BIGINT) AS score FROM orders
""",
    # Sequence chunks of 64 bases, under two thirds of the calls' starts.
    "sequence": """
SELECT chrom, chunk, CONCAT(TRANSLATE(MD5(CONCAT(chrom, '-', CAST(chunk AS STRING))), '0123456789abcdef', 'ACGTACGTACGTACGT'), TRANSLATE(MD5(CONCAT(CAST(chunk AS STRING), '-', chrom)), '0123456789abcdef', 'ACGTACGTACGTACGT')) AS seq
FROM (SELECT DISTINCT chrom, CAST(FLOOR((start_pos - 1) / 64) AS BIGINT) AS chunk FROM calls WHERE call_id % 3 <> 0) c
""",
    "lines_breakdancer": """
SELECT call_id, CONCAT_WS(CHR(9), chrom, CAST(start_pos - 1 AS STRING), '5+0-', chrom2, CAST(end_pos AS STRING), '0+5-', sv_type,
       CAST(-sv_len AS STRING), '99', CAST(3 + call_id % 9 AS STRING), CONCAT('lib.bam|', CAST(3 + call_id % 9 AS STRING)), 'NA') AS value
FROM calls WHERE source = 'BreakDancer' AND sv_type <> 'DUP'
""",
    "lines_cnvnator": """
SELECT call_id, CONCAT_WS(CHR(9), CASE sv_type WHEN 'DEL' THEN 'deletion' ELSE 'duplication' END,
       CONCAT(chrom, ':', CAST(start_pos AS STRING), '-', CAST(end_pos AS STRING)), CAST(sv_len AS STRING), '0.5', '1e-5', '2e-5', '0', '0', '0.25') AS value
FROM calls WHERE source = 'CNVnator' AND sv_type IN ('DEL', 'DUP')
""",
    "lines_breakseq": """
SELECT call_id, CONCAT_WS(CHR(9), chrom, 'BreakSeq', CASE sv_type WHEN 'DEL' THEN 'Deletion' ELSE 'Insertion' END,
       CAST(start_pos + 1 AS STRING), CAST(end_pos AS STRING), CAST(call_id % 40 AS STRING), '.', '.',
       CONCAT('QUAL PASS2;ABC 0,0,', CAST(call_id % 40 AS STRING), ';PE ', CAST(call_id % 40 AS STRING))) AS value
FROM calls WHERE source = 'BreakSeq' AND sv_type IN ('DEL', 'INS')
""",
    "lines_pindel": """
SELECT call_id, CONCAT(CAST(call_id AS STRING), CHR(9), CASE sv_type WHEN 'DEL' THEN 'D ' WHEN 'DUP' THEN 'TD ' WHEN 'INV' THEN 'INV ' ELSE 'I ' END,
       CAST(sv_len AS STRING), CHR(9), 'NT 0 ""', CHR(9), 'ChrID ', chrom, CHR(9), 'BP ', CAST(start_pos AS STRING), CHR(9), CAST(end_pos + 1 AS STRING),
       CHR(9), 'BP_range ', CAST(start_pos AS STRING), CHR(9), CAST(end_pos + 1 + call_id % 5 AS STRING), CHR(9), 'Supports ', CAST(4 + call_id % 30 AS STRING),
       CHR(9), CAST(3 + call_id % 30 AS STRING), CHR(9), '+ ', CAST(call_id % 11 AS STRING), CHR(9), CAST(call_id % 11 AS STRING), CHR(9), '- ',
       CAST(call_id % 13 AS STRING), CHR(9), CAST(call_id % 13 AS STRING), CHR(9), 'S1 9', CHR(9), 'SUM_MS 240', CHR(9), '1', CHR(9), 'NumSupSamples 1', CHR(9), '1',
       CHR(9), 's1 2 1 2 2') AS value
FROM calls WHERE source = 'Pindel' AND sv_type IN ('DEL', 'DUP', 'INV', 'INS')
""",
    "lines_vcf": """
SELECT call_id, CONCAT_WS(CHR(9), chrom, CAST(start_pos AS STRING), '.', 'N', CONCAT('<', sv_type, '>'), '.',
       CASE WHEN call_id % 9 = 0 THEN 'LowQual' ELSE 'PASS' END,
       CONCAT('SVTYPE=', sv_type, ';END=', CAST(end_pos AS STRING), ';SVLEN=', CAST(CASE WHEN sv_type = 'DEL' THEN -sv_len ELSE sv_len END AS STRING), ';IMPRECISE'),
       'GT', '0/1') AS value
FROM calls WHERE source IN ('Manta', 'Lumpy')
""",
    "split_alignments": """
SELECT c.call_id, c.call_id * 4 + k.k AS contig_id, c.chrom, c.start_pos, c.end_pos, c.sv_type, 1100 + c.sv_len AS ref_len, 900 AS contig_len,
       1 AS f1_s1, 500 + (c.call_id + k.k) % 7 AS f1_e1, 501 + c.sv_len + (c.call_id + k.k) % 7 AS f2_s1, 1000 + c.sv_len AS f2_e1,
       1 AS f1_s2, 450 AS f1_e2, 451 + (c.call_id * k.k) % 60 AS f2_s2, 900 AS f2_e2, 800 AS score, 95 + k.k AS pct_identity
FROM calls c CROSS JOIN (SELECT 1 AS k UNION ALL SELECT 2 AS k UNION ALL SELECT 3 AS k) k
WHERE c.sv_type IN ('DEL', 'DUP') AND c.call_id % 3 = 0
""",
    # Contigs over inversions, of seven kinds: both ends, with a right flank, two candidates, long ones with one end (3, 5), pieces that hold it whole (4), a turned contig (6).
    "inversion_fragments": """
SELECT call_id, contig_id, chrom, start_pos, end_pos, 'INV' AS sv_type, n AS ref_len, contig_len, score, pct_identity, i,
       CASE i WHEN 1 THEN CASE kind WHEN 5 THEN q + 300 WHEN 6 THEN q ELSE 1 END
         WHEN 2 THEN CASE kind WHEN 2 THEN n - q + 60 WHEN 4 THEN 620 WHEN 5 THEN n - q + 1 WHEN 6 THEN q + 1 ELSE n - q END
         ELSE CASE kind WHEN 1 THEN n - q + 1 WHEN 2 THEN n - q ELSE 1 END END AS s1,
       CASE i WHEN 1 THEN CASE kind WHEN 4 THEN 429 - 30 * (call_id % 3) + 15 * (call_id % 2) WHEN 5 THEN q + 1 WHEN 6 THEN 1 ELSE q END
         WHEN 2 THEN CASE kind WHEN 2 THEN q + 70 WHEN 3 THEN n - q - 300 WHEN 4 THEN 430 WHEN 5 THEN n WHEN 6 THEN n - q ELSE q + 1 END
         ELSE CASE kind WHEN 1 THEN n - 20 WHEN 2 THEN q + 1 WHEN 5 THEN q - 200 ELSE 60 END END AS e1,
       CASE i WHEN 1 THEN 1 WHEN 2 THEN CASE kind WHEN 5 THEN 303 ELSE 452 END ELSE CASE kind WHEN 2 THEN 452 WHEN 5 THEN 800 ELSE 901 END END AS s2,
       CASE i WHEN 1 THEN CASE kind WHEN 5 THEN 300 ELSE 450 END
         WHEN 2 THEN CASE kind WHEN 3 THEN 751 WHEN 4 THEN CASE WHEN call_id % 11 = 0 THEN 897 ELSE 642 END WHEN 5 THEN 700 ELSE 900 END
         ELSE CASE kind WHEN 1 THEN 1200 WHEN 6 THEN 960 ELSE 900 END END AS e2
FROM (SELECT a.*, CAST(FLOOR(call_id / 10) AS BIGINT) % 7 AS kind, f1_e1 AS q, CASE WHEN CAST(FLOOR(call_id / 10) AS BIGINT) % 7 = 4 THEN 1040 ELSE ref_len END AS n FROM split_alignments a WHERE sv_type = 'DEL') x
CROSS JOIN (SELECT 1 AS i UNION ALL SELECT 2 AS i UNION ALL SELECT 3 AS i) k WHERE i < 3 OR kind IN (1, 2, 5, 6)
""",
}


_LEAST_TEXT = re.compile(r"MIN\((l_\w+)\) (=|<>) '(\w+)'")


def by_flags(view: str) -> str:
    """The view, in which the least of some texts is compared with a literal by flags: some are equal, none is less.

    Flags fit the buffers of a hash aggregate. With a text in its buffer an aggregate sorts all rows, before and after the shuffle.
    """
    return _LEAST_TEXT.sub(lambda m: f"{'NOT ' if m[2] == '<>' else ''}(MAX({m[1]} = '{m[3]}') AND NOT MAX({m[1]} < '{m[3]}'))", view)


class Inputs:
    """The views over the tables of one folder, as DataFrames: `Inputs(spark, folder).calls`."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._kept: dict[str, DataFrame] = {}

    def kept(self, name: str, without: tuple[str, ...] = ()) -> DataFrame:
        """The view, without columns that the query has no use for, computed once; for queries that read it several times."""
        if name not in self._kept:
            self._kept[name] = kept(getattr(self, name).drop(*without), "zstd")
        return self._kept[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name not in VIEWS:
            raise AttributeError(name)
        for table in TABLES:
            self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet").createOrReplaceTempView(table)
        for other in ("calls", "split_alignments"):
            if name != other and other in VIEWS[name]:
                getattr(self, other).createOrReplaceTempView(other)
        return self.spark.sql(by_flags(VIEWS[name]))


def with_views(sql: str, views: tuple[str, ...]) -> str:
    """The query with the views that it reads as common table expressions."""
    views = {*views, *(v for v in ("split_alignments",) for x in views if v in VIEWS[x])}
    names = [v for v in VIEWS if v in views or (v == "calls" and any("calls" in VIEWS[x] for x in views))]
    heads = ",\n".join(f"{v} AS MATERIALIZED ({VIEWS[v].strip()})" for v in names)
    sql = sql.strip()
    if sql.upper().startswith("WITH RECURSIVE "):
        return f"WITH RECURSIVE {heads},\n{sql[15:]}"
    if sql.upper().startswith("WITH "):
        return f"WITH {heads},\n{sql[5:]}"
    return f"WITH {heads}\n{sql}"
