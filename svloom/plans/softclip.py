"""Queries over soft-clipped reads."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..fixtures import Inputs
from ..functions import reads as R
from ..operators import filters, softclip
from ..operators.merge import merge_per_type, settled
from ..session import kept
from .calls import METHODS_SQL, islands_sql, merge_full_sql
from .registry import query


def reads(t: Inputs) -> DataFrame:
    return R.with_cigar(t.reads)


def kept_reads(t: Inputs) -> DataFrame:
    """The same, for queries that go through the reads more than once."""
    return R.with_cigar(t.kept("reads", ("qname", "is_read1", "is_paired")))


#: Thresholds for the thin fixture reads.
FEW = {"INS": 1.0, "DEL": 1.0, "INV": 1.0, "DUP": 1.0}
LOW_FRACTIONS = {"INS": 0.05, "DEL": 0.04, "INV": 0.015, "DUP": 0.015}
WINDOW_KEY = ["chrom", "sv_type", "side", "island"]

GOOD_SQL = """g AS MATERIALIZED (
  SELECT *, CASE WHEN clip_left > 0 THEN pos ELSE aend END AS cut, clip_left + clip_right AS clip, CASE WHEN clip_left > 0 THEN 0 ELSE match_len END AS dl, CASE WHEN clip_left > 0 THEN match_len ELSE 0 END AS dr,
    CASE WHEN mate_is_unmapped OR chrom <> mate_chrom THEN 'INS' WHEN is_reverse = mate_is_reverse THEN 'INV' WHEN (pos < mate_pos AND is_reverse) OR (pos > mate_pos AND NOT is_reverse) THEN 'DUP'
      WHEN abs(tlen) > 450 THEN 'DEL' WHEN abs(tlen) < 250 THEN 'INS' ELSE 'NONE' END AS sv_type, CASE WHEN is_reverse THEN '-' ELSE '+' END AS strand
  FROM reads WHERE NOT is_duplicate AND NOT is_unmapped AND mapq >= 5 AND nm <= 10 AND aend - pos >= 50 AND clip_left + clip_right >= 20 AND avg_qual >= 20),
w AS MATERIALIZED (SELECT *, greatest(0, cut - 500) AS start_pos, cut + 500 AS end_pos, (greatest(0, cut - 500) + cut + 500) // 2 AS location, dl <= 2 AS l, dr <= 2 AS r, pos <= mate_pos AS f, abs(tlen) - 350 AS ov, abs(tlen) + 350 AS bo FROM g)"""
VOTE_SQL = (
    GOOD_SQL
    + """,
v0 AS (SELECT *, CASE sv_type
  WHEN 'INS' THEN CASE WHEN (l AND is_reverse) OR (r AND NOT is_reverse) THEN 1 END
  WHEN 'INV' THEN CASE WHEN r AND NOT is_reverse AND NOT f THEN location - ov - dl WHEN l AND NOT is_reverse AND NOT f THEN location - ov - 2 * clip + rlen WHEN l AND is_reverse AND f THEN location + ov + dr
    WHEN r AND is_reverse AND f THEN location + ov + 2 * clip - rlen WHEN l AND is_reverse AND NOT f THEN location - bo + 2 * dr + rlen WHEN r AND NOT is_reverse AND f THEN location + bo - 2 * dl - rlen END
  WHEN 'DEL' THEN CASE WHEN l AND is_reverse AND NOT f THEN location - ov WHEN r AND NOT is_reverse AND f THEN location + ov END
  WHEN 'DUP' THEN CASE WHEN l AND is_reverse AND f THEN location + bo - rlen - dr WHEN r AND NOT is_reverse AND NOT f THEN location - bo + rlen + dl END END AS ob FROM w WHERE sv_type <> 'NONE'),
v AS MATERIALIZED (SELECT read_id, chrom, start_pos, end_pos, location, CAST(greatest(ob, 0) AS BIGINT) AS other_bp, strand, sv_type, CASE WHEN location <= greatest(ob, 0) THEN 'L' ELSE 'R' END AS side FROM v0 WHERE ob IS NOT NULL)"""
)
ISLE_SQL = (
    VOTE_SQL
    + """,
i0 AS (SELECT *, CASE WHEN start_pos > max(end_pos) OVER (PARTITION BY chrom, sv_type, side ORDER BY start_pos, end_pos, read_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) - 500 IS NOT FALSE THEN 1 ELSE 0 END AS nw FROM v),
i AS MATERIALIZED (SELECT *, CAST(sum(nw) OVER (PARTITION BY chrom, sv_type, side ORDER BY start_pos, end_pos, read_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS island FROM i0)"""
)
FEATURE_SQL = (
    ISLE_SQL
    + """,
loc AS (SELECT chrom, sv_type, side, island, location, count(*) AS n FROM i GROUP BY ALL),
loct AS (SELECT chrom, sv_type, side, island, string_agg(location || ',' || n, ',' ORDER BY location) AS count_text, count(*) AS n_locations FROM loc GROUP BY chrom, sv_type, side, island),
ft AS MATERIALIZED (SELECT chrom, sv_type, side, island, min(start_pos) AS start_pos, max(end_pos) AS end_pos, count(*) AS support, CAST(count(*) FILTER (strand = '+') AS BIGINT) AS plus_support, CAST(count(*) FILTER (strand = '-') AS BIGINT) AS minus_support,
  max(location) - min(location) AS locations_span, CASE WHEN sv_type = 'INS' THEN 0 ELSE greatest(0, min(other_bp) - 500) END AS other_start, CASE WHEN sv_type = 'INS' THEN 0 ELSE max(other_bp) + 500 END AS other_end FROM i GROUP BY chrom, sv_type, side, island),
cov AS MATERIALIZED (SELECT ft.chrom, sv_type, side, island, count(r.read_id) AS coverage FROM ft LEFT JOIN reads r ON r.chrom = ft.chrom AND greatest(r.pos, ft.start_pos) < least(r.aend, ft.end_pos) GROUP BY ALL),
f AS MATERIALIZED (SELECT * FROM ft JOIN loct USING (chrom, sv_type, side, island) JOIN cov USING (chrom, sv_type, side, island))"""
)


@query("fn_softclip", "SELECT read_id, CAST(clip_left + clip_right AS INTEGER) AS clip, CAST(CASE WHEN clip_left > 0 THEN 0 ELSE match_len END AS INTEGER) AS left_bases, CAST(CASE WHEN clip_left > 0 THEN match_len ELSE 0 END AS INTEGER) AS right_bases FROM reads WHERE clip_left + clip_right > 0", ("reads",))
def fn_softclip(t: Inputs) -> DataFrame:
    clip = R.softclip(F.col("cigar"))
    return reads(t).select("read_id", clip["len"].alias("clip"), clip["left"].alias("left_bases"), clip["right"].alias("right_bases")).where("clip is not null")


@query("fn_good_read", f"WITH {GOOD_SQL} SELECT read_id FROM g", ("reads",))
def fn_good_read(t: Inputs) -> DataFrame:
    return reads(t).where(R.good_read()).select("read_id")


@query("fn_clip_window", f"WITH {GOOD_SQL} SELECT read_id, start_pos AS low, end_pos AS high FROM w", ("reads",))
def fn_clip_window(t: Inputs) -> DataFrame:
    return reads(t).where(R.good_read()).select("read_id", R.clip_window().alias("w")).select("read_id", "w.*")


@query("fn_infer_svtype", f"WITH {GOOD_SQL} SELECT read_id, sv_type FROM g", ("reads",))
def fn_infer_svtype(t: Inputs) -> DataFrame:
    return reads(t).where(R.good_read()).select("read_id", R.infer_svtype().alias("sv_type"))


@query("fn_other_bp", f"WITH {VOTE_SQL} SELECT read_id, other_bp FROM v", ("reads",))
def fn_other_bp(t: Inputs) -> DataFrame:
    return softclip.candidates(reads(t)).select("read_id", "other_bp")


@query("fn_cov_frac", "SELECT read_id, round((mapq / match_len + nm / rlen) / 2, 9) AS share FROM reads", ("reads",))
def fn_cov_frac(t: Inputs) -> DataFrame:
    return t.reads.select("read_id", F.round(softclip.coverage_share(F.array("mapq", "nm"), F.array(F.col("match_len").cast("bigint"), F.col("rlen").cast("bigint"))), 9).alias("share"))


@query("fn_decode_source", "SELECT call_id, chrom, start_pos, end_pos, sv_len, source FROM calls", ("calls",))
def fn_decode_source(t: Inputs) -> DataFrame:
    text = F.concat_ws("-", "chrom", F.col("start_pos").cast("string"), "chrom", F.col("end_pos").cast("string"), F.col("sv_len").cast("string"), "source")
    return t.calls.select("call_id", softclip.decoded_source(text).alias("d")).select("call_id", "d.chrom", F.col("d.start").alias("start_pos"), F.col("d.end").alias("end_pos"), F.col("d.len").alias("sv_len"), "d.source")


SEQ_SQL = "translate(substr(md5(CAST(read_id AS VARCHAR)), 1, 24), '0123456789abcdef', 'ACGTACGTACGTACGT')"


@query("fn_revcomp", f"SELECT read_id, translate(reverse({SEQ_SQL}), 'ACGT', 'TGCA') AS seq FROM reads", ("reads",))
def fn_revcomp(t: Inputs) -> DataFrame:
    return t.reads.select("read_id", R.reverse_complement(sequence()).alias("seq"))


def sequence():
    return F.translate(F.substring(F.md5(F.col("read_id").cast("string")), 1, 24), "0123456789abcdef", "ACGTACGTACGTACGT")


@query("fn_gc", f"SELECT read_id, round(length(regexp_replace({SEQ_SQL}, '[^GC]', '', 'g')) / 24.0, 6) AS gc FROM reads", ("reads",))
def fn_gc(t: Inputs) -> DataFrame:
    return t.reads.select("read_id", F.round(R.gc_content(sequence()), 6).alias("gc"))


@query("fn_b64json", "SELECT call_id, sv_type || ':' || source AS value FROM calls", ("calls",))
def fn_b64json(t: Inputs) -> DataFrame:
    packed = F.base64(F.to_json(F.create_map(F.lit("a"), "sv_type", F.lit("b"), "source")).cast("binary"))
    back = F.from_json(F.unbase64("p").cast("string"), "map<string,string>")
    return t.calls.select("call_id", packed.alias("p")).select("call_id", F.concat_ws(":", back["a"], back["b"]).alias("value"))


@query("fn_strand_bias", "SELECT chrom, pos // 10000 AS bin, round(pow(count(*) FILTER (NOT is_reverse) / count(*) - 0.5, 2), 6) AS bias FROM reads GROUP BY ALL", ("reads",))
def fn_strand_bias(t: Inputs) -> DataFrame:
    forward = F.sum(F.when(~F.col("is_reverse"), 1).otherwise(0))
    return t.reads.groupBy("chrom", F.floor(F.col("pos") / 10000).alias("bin")).agg(F.round(F.pow(forward / F.count("*") - 0.5, F.lit(2)), 6).alias("bias"))


@query("sc_candidates", f"WITH {VOTE_SQL} SELECT * FROM v", ("reads",))
def sc_candidates(t: Inputs) -> DataFrame:
    return softclip.candidates(reads(t))


@query("sc_none_candidates", f"WITH {GOOD_SQL} SELECT read_id, chrom, start_pos, end_pos, location, strand, CAST(clip AS INTEGER) AS clip_len FROM w WHERE sv_type = 'NONE'", ("reads",))
def sc_none_candidates(t: Inputs) -> DataFrame:
    return softclip.none_candidates(reads(t))


@query("sc_lr_split", f"WITH {VOTE_SQL} SELECT sv_type, side, count(*) AS n FROM v GROUP BY ALL", ("reads",))
def sc_lr_split(t: Inputs) -> DataFrame:
    return softclip.candidates(reads(t)).groupBy("sv_type", "side").count().withColumnRenamed("count", "n")


@query("sc_merge", f"WITH {ISLE_SQL} SELECT read_id, chrom, sv_type, side, island FROM i", ("reads",))
def sc_merge(t: Inputs) -> DataFrame:
    return softclip.merged_windows(softclip.candidates(reads(t))).select("read_id", "chrom", "sv_type", "side", "island")


SPLIT_SQL = (
    ISLE_SQL
    + """,
oi AS (SELECT * EXCLUDE (nw), CASE WHEN sv_type = 'INS' THEN 0 ELSE greatest(0, other_bp - 500) END AS os, CASE WHEN sv_type = 'INS' THEN 1000 ELSE other_bp + 500 END AS oe FROM i),
"""
    + islands_sql("oi", "oc", "chrom, sv_type, side, isle", "os, oe, read_id", "os", "oe", ">", " - 500").replace("FROM oi", "FROM (SELECT * EXCLUDE (island), island AS isle FROM oi)")
    + ",\n"
    + islands_sql("oc", "op", "chrom, sv_type, side, isle, cluster", "start_pos, end_pos, read_id", "start_pos", "end_pos", ">", " - 500").replace("FROM oc", "FROM (SELECT * EXCLUDE (island), island AS cluster FROM oc)")
)


@query("sc_other_split", f"WITH {SPLIT_SQL} SELECT read_id, chrom, sv_type, side, isle AS island, dense_rank() OVER (PARTITION BY chrom, sv_type, side, isle ORDER BY cluster, island) AS part FROM op", ("reads",))
def sc_other_split(t: Inputs) -> DataFrame:
    return softclip.split_by_other_end(softclip.merged_windows(softclip.candidates(reads(t)))).select("read_id", *WINDOW_KEY, F.col("part").cast("long").alias("part"))


def features(t: Inputs) -> DataFrame:
    marked = softclip.merged_windows(softclip.candidates(kept_reads(t)))
    return softclip.with_coverage(softclip.window_features(marked, WINDOW_KEY), kept_reads(t), WINDOW_KEY)


FEATURES = "chrom, sv_type, side, island, start_pos, end_pos, support, plus_support, minus_support, n_locations, locations_span, count_text, other_start, other_end, coverage"


@query("sc_features", f"WITH {FEATURE_SQL} SELECT {FEATURES} FROM f", ("reads",))
def sc_features(t: Inputs) -> DataFrame:
    return features(t)


@query("final_stats_support", f"WITH {FEATURE_SQL} SELECT chrom, sv_type, side, island, n_locations, locations_span, plus_support, minus_support, count_text FROM f", ("reads",))
def final_stats_support(t: Inputs) -> DataFrame:
    marked = softclip.merged_windows(softclip.candidates(reads(t)))
    return softclip.window_features(marked, WINDOW_KEY).select(*WINDOW_KEY, "n_locations", "locations_span", "plus_support", "minus_support", "count_text")


@query("sc_other_span", f"WITH {FEATURE_SQL} SELECT chrom, sv_type, side, island, other_start, other_end FROM f", ("reads",))
def sc_other_span(t: Inputs) -> DataFrame:
    return softclip.window_features(softclip.merged_windows(softclip.candidates(reads(t))), WINDOW_KEY).select(*WINDOW_KEY, "other_start", "other_end")


@query("sc_cov_filter", f"WITH {FEATURE_SQL} SELECT chrom, sv_type, side, island FROM f WHERE sv_type <> 'INS' OR coverage / abs(start_pos - end_pos + 1) * 100 BETWEEN 0.1 AND 0.3", ("reads",))
def sc_cov_filter(t: Inputs) -> DataFrame:
    return softclip.coverage_filter(features(t), coverage=0.2).select(*WINDOW_KEY)


def votes_sql(joined: str, out: str, kind: str) -> str:
    """`<out>b`, the windows and reads `joined` with `ob`, the other breakpoint that a read of this kind names."""
    return f"""{out}k AS (SELECT *, CASE WHEN clip > 0 THEN cat ELSE mid END AS a, dl <= 2 AS cl, dr <= 2 AS cr, pos <= mate_pos AS fi, abs(tlen) - 350 AS ov, abs(tlen) + 350 AS bo FROM {joined} WHERE clip = 0 OR abs(cat - mid) <= 250),
{out}l AS (SELECT *, pos > a - 20 AS nl_, aend < a + 20 AS nr_, pos - a AS be, aend - a AS af FROM {out}k),
{out}b AS (SELECT *, CASE WHEN clip > 0 THEN CASE {kind}
    WHEN 'INS' THEN CASE WHEN (cl AND is_reverse) OR (cr AND NOT is_reverse) THEN 1 END
    WHEN 'INV' THEN CASE WHEN cr AND NOT is_reverse AND NOT fi THEN a - ov - dl WHEN cl AND NOT is_reverse AND NOT fi THEN a - ov - 2 * clip + rlen WHEN cl AND is_reverse AND fi THEN a + ov + dr
      WHEN cr AND is_reverse AND fi THEN a + ov + 2 * clip - rlen WHEN cl AND is_reverse AND NOT fi THEN a - bo + 2 * dr + rlen WHEN cr AND NOT is_reverse AND fi THEN a + bo - 2 * dl - rlen END
    WHEN 'DEL' THEN CASE WHEN cl AND is_reverse AND NOT fi THEN a - ov WHEN cr AND NOT is_reverse AND fi THEN a + ov END
    WHEN 'DUP' THEN CASE WHEN cl AND is_reverse AND fi THEN a + bo - rlen - dr WHEN cr AND NOT is_reverse AND NOT fi THEN a - bo + rlen + dl END END
  ELSE CASE {kind}
    WHEN 'INS' THEN CASE WHEN NOT is_reverse AND nr_ THEN CASE WHEN mate_is_unmapped OR chrom <> mate_chrom OR mate_pos > a - 20 THEN 1 END WHEN is_reverse AND nl_ THEN CASE WHEN mate_is_unmapped OR chrom <> mate_chrom OR mate_pos + rlen < a + 20 THEN 1 END END
    WHEN 'INV' THEN CASE WHEN NOT is_reverse AND NOT fi AND nr_ THEN a - ov + 2 * be + rlen WHEN NOT is_reverse AND NOT fi AND nl_ THEN a - ov + 2 * be + rlen WHEN is_reverse AND fi AND nl_ THEN a + ov + 2 * af - rlen
      WHEN is_reverse AND fi AND nr_ THEN a + ov + 2 * af - rlen WHEN is_reverse AND NOT fi AND nl_ THEN a - bo + 2 * af + rlen WHEN NOT is_reverse AND fi AND nr_ THEN a + bo + 2 * be - rlen END
    WHEN 'DEL' THEN CASE WHEN is_reverse AND nl_ THEN a - ov WHEN NOT is_reverse AND nr_ THEN a + ov END
    WHEN 'DUP' THEN CASE WHEN is_reverse AND fi AND nl_ THEN a + bo - 2 * rlen WHEN NOT is_reverse AND NOT fi AND pos < a + 20 THEN a - bo + 2 * rlen END END END AS ob FROM {out}l)"""


NEIGHBOUR_SQL = (
    FEATURE_SQL
    + """,
nr AS MATERIALIZED (SELECT *, CASE WHEN mate_is_unmapped OR chrom <> mate_chrom THEN 'INS' WHEN is_reverse = mate_is_reverse THEN 'INV' WHEN (pos < mate_pos AND is_reverse) OR (pos > mate_pos AND NOT is_reverse) THEN 'DUP'
    WHEN abs(tlen) > 450 THEN 'DEL' WHEN abs(tlen) < 250 THEN 'INS' ELSE 'NONE' END AS rt, clip_left + clip_right AS clip, CASE WHEN clip_left > 0 THEN 0 ELSE match_len END AS dl, CASE WHEN clip_left > 0 THEN match_len ELSE 0 END AS dr,
    (greatest(0, CASE WHEN clip_left > 0 THEN pos ELSE aend END - 500) + CASE WHEN clip_left > 0 THEN pos ELSE aend END + 500) // 2 AS cat
  FROM reads WHERE NOT is_duplicate AND NOT is_unmapped AND mapq >= 5 AND nm <= 10 AND aend - pos >= 50),
nj AS (SELECT f.chrom, f.sv_type, f.side, f.island, f.other_start, f.other_end, (f.start_pos + f.end_pos) // 2 AS mid, nr.* EXCLUDE (chrom) FROM f JOIN nr ON nr.chrom = f.chrom AND nr.rt = f.sv_type AND greatest(f.start_pos, nr.pos) < least(f.end_pos, nr.aend)),
"""
    + votes_sql("nj", "n", "sv_type")
    + """,
nv AS MATERIALIZED (SELECT * FROM nb WHERE ob IS NOT NULL AND (sv_type = 'INS' OR abs(greatest(ob, 0) - (other_start + other_end) // 2) <= 500)),
ns AS (SELECT chrom, sv_type, side, island, count(*) AS neighbours, count(*) FILTER (NOT is_reverse) AS plus, count(*) FILTER (is_reverse) AS minus FROM nv GROUP BY ALL),
nf AS MATERIALIZED (SELECT f.*, coalesce(neighbours, 0) AS neighbours, coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus FROM f LEFT JOIN ns USING (chrom, sv_type, side, island))"""
)


def supported(t: Inputs) -> DataFrame:
    return softclip.with_neighbours(features(t), kept_reads(t), WINDOW_KEY)


@query(
    "sc_neighbour",
    f"""WITH {NEIGHBOUR_SQL},
    nh AS (SELECT chrom, sv_type, side, island, CASE WHEN mate_is_unmapped THEN '-1' ELSE mate_chrom END AS mate, count(*) AS n, min(CASE WHEN mate_is_unmapped THEN -1 ELSE mate_pos END) AS low, max(CASE WHEN mate_is_unmapped THEN -1 ELSE mate_pos END) + 50 AS high FROM nv WHERE sv_type = 'INS' GROUP BY ALL),
    nt AS (SELECT chrom, sv_type, side, island, string_agg(mate || ';' || n || ';' || low || ';' || high, ',' ORDER BY mate) AS mates FROM nh GROUP BY chrom, sv_type, side, island)
    SELECT chrom, sv_type, side, island, neighbours, plus, minus, CASE WHEN sv_type = 'INS' THEN coalesce(mates, '') END AS mates FROM nf LEFT JOIN nt USING (chrom, sv_type, side, island)""",
    ("reads",),
)
def sc_neighbour(t: Inputs) -> DataFrame:
    return supported(t).select(*WINDOW_KEY, "neighbours", "plus", "minus", "mates")


@query(
    "sc_mate_histogram",
    f"WITH {NEIGHBOUR_SQL} SELECT chrom, sv_type, side, island, CASE WHEN mate_is_unmapped THEN '-1' ELSE mate_chrom END AS mate_chrom, count(*) AS n, min(CASE WHEN mate_is_unmapped THEN -1 ELSE mate_pos END) AS low, max(CASE WHEN mate_is_unmapped THEN -1 ELSE mate_pos END) + 50 AS high FROM nv WHERE sv_type = 'INS' GROUP BY ALL",
    ("reads",),
)
def sc_mate_histogram(t: Inputs) -> DataFrame:
    return softclip.mate_histogram(features(t), kept_reads(t), WINDOW_KEY)


THRESHOLD_SQL = "CASE sv_type WHEN 'INS' THEN 0.05 WHEN 'DEL' THEN 0.04 ELSE 0.015 END"
SCALE_SQL = "CASE WHEN support >= 2 THEN 1.0 ELSE 1.4 END"


@query("sc_frac_filter", f"WITH {NEIGHBOUR_SQL} SELECT chrom, sv_type, side, island FROM nf WHERE coverage * {THRESHOLD_SQL} * {SCALE_SQL} <= neighbours AND (sv_type <> 'INS' OR coverage * {THRESHOLD_SQL} * {SCALE_SQL} * 0.4 <= least(plus, minus))", ("reads",))
def sc_frac_filter(t: Inputs) -> DataFrame:
    return softclip.fraction_filter(supported(t), LOW_FRACTIONS).select(*WINDOW_KEY)


@query("sc_abs_filter", f"WITH {NEIGHBOUR_SQL} SELECT chrom, sv_type, side, island FROM nf WHERE neighbours >= 1.0 * {SCALE_SQL} AND (sv_type <> 'INS' OR least(plus, minus) >= 0.4 * {SCALE_SQL})", ("reads",))
def sc_abs_filter(t: Inputs) -> DataFrame:
    return softclip.count_filter(supported(t), FEW).select(*WINDOW_KEY)


@query(
    "sc_full_interval",
    f"""WITH {FEATURE_SQL}, x AS (SELECT *, (start_pos + end_pos) // 2 AS m, (other_start + other_end) // 2 AS o, other_start <> 0 OR other_end <> 0 AS two FROM f), y AS (SELECT *, CASE WHEN two THEN least(m, o) ELSE start_pos END AS s, CASE WHEN two THEN greatest(m, o) ELSE end_pos END AS e FROM x)
    SELECT chrom, sv_type, side, island, s AS start_pos, e AS end_pos, CASE WHEN sv_type = 'INS' THEN 0 ELSE greatest(e - s, 0) END AS sv_len FROM y""",
    ("reads",),
)
def sc_full_interval(t: Inputs) -> DataFrame:
    return softclip.full_intervals(features(t)).select(*WINDOW_KEY, "start_pos", "end_pos", "sv_len")


def full(t: Inputs) -> DataFrame:
    found = softclip.full_intervals(softclip.count_filter(supported(t), FEW)).withColumn("id", F.concat_ws(":", "chrom", "sv_type", "side", F.col("island").cast("string")))
    return settled(found.select("id", "sv_type", "chrom", "start_pos", "end_pos", "window_start", "window_end", "other_start", "other_end"))


FULL_SQL = (
    NEIGHBOUR_SQL
    + f""",
fu AS (SELECT *, (start_pos + end_pos) // 2 AS m, (other_start + other_end) // 2 AS o, other_start <> 0 OR other_end <> 0 AS two FROM nf WHERE neighbours >= 1.0 * {SCALE_SQL} AND (sv_type <> 'INS' OR least(plus, minus) >= 0.4 * {SCALE_SQL})),
fi AS MATERIALIZED (SELECT concat_ws(':', chrom, sv_type, side, island) AS id, sv_type, chrom, CASE WHEN two THEN least(m, o) ELSE start_pos END AS s, CASE WHEN two THEN greatest(m, o) ELSE end_pos END AS e, m AS clip_at, o AS other_at, other_start, other_end FROM fu)"""
)
MERGED_FULL_SQL = FULL_SQL + ",\n" + merge_full_sql("fi", 500)


@query("sc_full_merge", f"WITH RECURSIVE {MERGED_FULL_SQL} SELECT sv_type, chrom, start_pos, end_pos, array_to_string(ids, ',') AS ids FROM mf", ("reads",))
def sc_full_merge(t: Inputs) -> DataFrame:
    return merge_per_type(full(t)).withColumn("ids", F.array_join("ids", ","))


def tune_sql(source: str, p: str = "") -> str:
    """`fe` (after the prefix): the merged intervals `mf` of `source` with averaged ends and how many ends have votes."""
    return f"""
{p}fm AS (SELECT u.*, o.clip_at, o.other_at, abs(clip_at - start_pos) < abs(clip_at - end_pos) AS c_near, abs(other_at - start_pos) < abs(other_at - end_pos) AS o_near FROM (SELECT *, unnest(ids) AS id FROM {p}mf) u JOIN {source} o ON o.id = u.id),
{p}fv AS (SELECT sv_type, chrom, start_pos, end_pos, ids, CAST(floor(avg(clip_at) FILTER (c_near AND NOT o_near)) AS BIGINT) AS lb, CAST(floor(avg(clip_at) FILTER (NOT c_near AND o_near)) AS BIGINT) AS rb FROM {p}fm GROUP BY ALL),
{p}fe AS MATERIALIZED (SELECT *, CASE WHEN sv_type = 'INS' OR (lb IS NOT NULL AND rb IS NOT NULL) THEN 2 WHEN lb IS NOT NULL OR rb IS NOT NULL THEN 1 END AS ends, sv_type <> 'INS' AND lb IS NOT NULL AND rb IS NOT NULL AS both_ FROM {p}fv)"""


TUNED = """sv_type, chrom, CASE WHEN both_ THEN lb ELSE start_pos END AS start_pos, CASE WHEN both_ THEN rb ELSE end_pos END AS end_pos,
    CASE WHEN both_ THEN rb - lb WHEN sv_type = 'INS' THEN 0 ELSE end_pos - start_pos END AS sv_len, ends, array_to_string(ids, ',') AS ids"""
TUNE_SQL = MERGED_FULL_SQL + "," + tune_sql("fi")


@query(
    "sc_fine_tune",
    f"WITH RECURSIVE {TUNE_SQL} SELECT {TUNED} FROM fe WHERE ends IS NOT NULL",
    ("reads",),
)
def sc_fine_tune(t: Inputs) -> DataFrame:
    intervals = full(t)
    return softclip.fine_tune(merge_per_type(intervals), intervals).withColumn("ids", F.array_join("ids", ","))


#: The support at other ends: windows over them, reads and votes there, and what holds up, merged again with the members of one-ended intervals.
ONE_END_SQL = (
    TUNE_SQL
    + """,
oi AS MATERIALIZED (SELECT fe.sv_type, fe.chrom, fe.start_pos, fe.end_pos, fi.* EXCLUDE (sv_type, chrom, s, e) FROM (SELECT *, unnest(ids) AS id FROM fe WHERE ends = 1) fe JOIN fi ON fi.id = fe.id),
os AS (SELECT sv_type, chrom, start_pos, end_pos, min(other_start) AS low, max(other_end) AS high, min(id) AS id FROM oi GROUP BY ALL),
oc AS (SELECT *, CASE WHEN abs((low + high) // 2 - start_pos) > abs((low + high) // 2 - end_pos) THEN start_pos ELSE end_pos END AS clip FROM os),
ow AS MATERIALIZED (SELECT 'one:' || id AS id, sv_type, chrom, low AS start_pos, high AS end_pos, greatest(0, clip - 500) AS other_start, clip + 500 AS other_end, 1 AS support FROM oc),
ov AS (SELECT ow.id, count(r.read_id) AS coverage FROM ow LEFT JOIN reads r ON r.chrom = ow.chrom AND greatest(r.pos, ow.start_pos) < least(r.aend, ow.end_pos) GROUP BY ow.id),
oj AS (SELECT ow.id, ow.chrom, ow.sv_type, ow.other_start, ow.other_end, (ow.start_pos + ow.end_pos) // 2 AS mid, nr.* EXCLUDE (chrom) FROM ow JOIN nr ON nr.chrom = ow.chrom AND nr.rt = ow.sv_type AND greatest(ow.start_pos, nr.pos) < least(ow.end_pos, nr.aend)),
"""
    + votes_sql("oj", "o", "sv_type")
    + f""",
on_ AS (SELECT id, count(*) AS neighbours, count(*) FILTER (NOT is_reverse) AS plus, count(*) FILTER (is_reverse) AS minus FROM ob WHERE ob IS NOT NULL AND (sv_type = 'INS' OR abs(greatest(ob, 0) - (other_start + other_end) // 2) <= 500) GROUP BY id),
ox AS (SELECT ow.*, coverage, coalesce(neighbours, 0) AS neighbours, coalesce(plus, 0) AS plus, coalesce(minus, 0) AS minus FROM ow JOIN ov USING (id) LEFT JOIN on_ USING (id)),
oy AS (SELECT *, (start_pos + end_pos) // 2 AS m, (other_start + other_end) // 2 AS o FROM ox WHERE coverage * {THRESHOLD_SQL} * {SCALE_SQL} <= neighbours AND neighbours >= 1.0 * {SCALE_SQL}
  AND (sv_type <> 'INS' OR (coverage * {THRESHOLD_SQL} * {SCALE_SQL} * 0.4 <= least(plus, minus) AND least(plus, minus) >= 0.4 * {SCALE_SQL}))),
oa AS MATERIALIZED (SELECT id, sv_type, chrom, least(m, o) AS s, greatest(m, o) AS e, m AS clip_at, o AS other_at FROM oy UNION ALL SELECT id, sv_type, chrom, s, e, clip_at, other_at FROM fi WHERE id IN (SELECT id FROM oi)),
"""
    + merge_full_sql("oa", 500, "x")
    + ","
    + tune_sql("oa", "x")
)


@query("sc_one_end", f"WITH RECURSIVE {ONE_END_SQL} SELECT {TUNED} FROM fe WHERE ends = 2 UNION ALL SELECT {TUNED} FROM xfe WHERE ends = 2", ("reads",))
def sc_one_end(t: Inputs) -> DataFrame:
    """One-ended intervals: support is looked for at the other end, and those that now have both are kept."""
    intervals = full(t)
    tuned = settled(softclip.fine_tune(merge_per_type(intervals), intervals))
    one = tuned.where("ends = 1")
    windows = softclip.other_end_windows(one, intervals)
    windows = softclip.with_neighbours(softclip.with_coverage(windows, kept_reads(t), ["id"]), kept_reads(t), ["id"])
    found = softclip.full_intervals(softclip.count_filter(softclip.fraction_filter(windows, LOW_FRACTIONS), FEW))
    members = found.select("id", "sv_type", "chrom", "start_pos", "end_pos", "window_start", "window_end", "other_start", "other_end")
    known = intervals.join(one.select(F.explode("ids").alias("id")).distinct(), "id", "left_semi").select(*members.columns)
    again = settled(members.unionByName(known))
    both = tuned.where("ends = 2").unionByName(softclip.fine_tune(merge_per_type(again), again).where("ends = 2"))
    return both.withColumn("ids", F.array_join("ids", ","))


@query("none_unmatched", f"""WITH {VOTE_SQL}, seen AS (SELECT DISTINCT chrom, start_pos, end_pos FROM v), o AS (SELECT call_id AS id, chrom, greatest(0, start_pos - 500) AS s, start_pos + 500 AS e FROM calls WHERE source = 'CNVnator'),
o2 AS (SELECT id, chrom, s, e, 'OTHER' AS kind FROM o WHERE NOT EXISTS (SELECT 1 FROM seen k WHERE k.chrom = o.chrom AND least(k.end_pos, e) - greatest(k.start_pos, s) > 0 AND least(k.end_pos, e) - greatest(k.start_pos, s) >= 0.5 * greatest(k.end_pos - k.start_pos, e - s))),
b AS (SELECT read_id AS id, chrom, start_pos AS s, end_pos AS e, 'NONE' AS kind FROM w WHERE sv_type = 'NONE' UNION ALL SELECT * FROM o2)
SELECT id, chrom, s AS start_pos, e AS end_pos, kind FROM b WHERE NOT EXISTS (SELECT 1 FROM seen k WHERE k.chrom = b.chrom AND least(k.end_pos, e) - greatest(k.start_pos, s) > 0 AND least(k.end_pos, e) - greatest(k.start_pos, s) >= 0.5 * greatest(k.end_pos - k.start_pos, e - s))""", ("reads", "calls"))  # fmt: skip
def none_unmatched(t: Inputs) -> DataFrame:
    none = softclip.none_candidates(reads(t)).withColumnRenamed("read_id", "id")
    other = t.calls.where("source = 'CNVnator'").select(F.col("call_id").alias("id"), "chrom", F.greatest(F.lit(0), F.col("start_pos") - 500).alias("start_pos"), (F.col("start_pos") + 500).alias("end_pos"))
    return softclip.unmatched_windows(none, other, softclip.candidates(reads(t))).select("id", "chrom", "start_pos", "end_pos", "kind")


NONE_SQL = (
    NEIGHBOUR_SQL
    + """,
nw AS (SELECT read_id AS id, chrom, start_pos, end_pos FROM w WHERE sv_type = 'NONE'),
"""
    + islands_sql("nw", "ni", "chrom", "start_pos, end_pos, id", "start_pos", "end_pos", ">", " - 500")
    + """,
nm AS (SELECT chrom, island, min(start_pos) AS s, max(end_pos) AS e, count(*) AS support FROM ni GROUP BY chrom, island),
nc AS MATERIALIZED (SELECT * FROM (SELECT nm.*, count(r.read_id) AS coverage FROM nm LEFT JOIN reads r ON r.chrom = nm.chrom AND greatest(r.pos, s) < least(r.aend, e) GROUP BY ALL) WHERE coverage / abs(s - e + 1) * 100 <= 1.5 * 20),
uj AS (SELECT nc.chrom, nc.island, s, e, support, coverage, (s + e) // 2 AS mid, nr.* EXCLUDE (chrom) FROM nc JOIN nr ON nr.chrom = nc.chrom AND nr.rt <> 'NONE' AND greatest(s, nr.pos) < least(e, nr.aend)),
"""
    + votes_sql("uj", "u", "rt")
    + f""",
uv AS MATERIALIZED (SELECT *, rt AS sv_type FROM ub WHERE ob IS NOT NULL),
ut AS (SELECT chrom, island, sv_type, any_value(support) AS support, any_value(coverage) AS coverage, count(*) AS neighbours, count(*) FILTER (NOT is_reverse) AS plus, count(*) FILTER (is_reverse) AS minus FROM uv GROUP BY chrom, island, sv_type),
uo AS (SELECT chrom, island, sv_type FROM ut WHERE coverage * 1.4 * {THRESHOLD_SQL} * {SCALE_SQL} <= neighbours AND neighbours >= {SCALE_SQL} * 1.4
  AND (sv_type <> 'INS' OR (coverage * 1.4 * {THRESHOLD_SQL} * {SCALE_SQL} * 0.4 <= least(plus, minus) AND least(plus, minus) >= {SCALE_SQL} * 1.4 * 0.4)))"""
)


@query(
    "none_resolve",
    f"""WITH {NONE_SQL} SELECT read_id, chrom, s AS start_pos, e AS end_pos, (s + e) // 2 AS location, CAST(greatest(ob, 0) AS BIGINT) AS other_bp, CASE WHEN is_reverse THEN '-' ELSE '+' END AS strand, sv_type,
    CASE WHEN (s + e) // 2 <= greatest(ob, 0) THEN 'L' ELSE 'R' END AS side FROM uv JOIN uo USING (chrom, island, sv_type)""",
    ("reads",),
)
def none_resolve(t: Inputs) -> DataFrame:
    none = softclip.none_candidates(kept_reads(t)).select(F.col("read_id").alias("id"), "chrom", "start_pos", "end_pos", F.lit("NONE").alias("kind"))
    return softclip.resolve_none(none, kept_reads(t), FEW, LOW_FRACTIONS, coverage=20)


@query(
    "sc_top",
    f"WITH {FEATURE_SQL}, x AS (SELECT chrom, sv_type, side, island, round(support / coverage, 6) AS score FROM f WHERE coverage > 0) SELECT chrom, sv_type, side, island, score FROM (SELECT *, rank() OVER (ORDER BY score DESC) AS r FROM x) WHERE r <= 200",
    ("reads",),
)
def sc_top(t: Inputs) -> DataFrame:
    from .calls import top_by

    scored = settled(features(t).where("coverage > 0").select(*WINDOW_KEY, F.round(softclip.coverage_share(F.array("support"), F.array("coverage")), 6).alias("score")))
    return top_by(scored, "score", 200)


@query("bp_from_calls", """WITH h AS (SELECT * FROM calls WHERE call_id % 3 = 0 OR source IN ('BreakDancer', 'CNVnator'))
SELECT call_id, sv_type, chrom, greatest(0, start_pos - 500) AS start_pos, start_pos + 500 AS end_pos, start_pos AS location FROM h
UNION ALL SELECT call_id, sv_type, chrom, greatest(0, end_pos - 500), end_pos + 500, end_pos FROM h WHERE sv_type NOT IN ('ITX', 'CTX') AND end_pos > start_pos + 1
UNION ALL SELECT call_id, sv_type, chrom2, greatest(0, end_pos - 500), end_pos + 500, end_pos FROM h WHERE sv_type IN ('ITX', 'CTX')""", ("calls",))  # fmt: skip
def bp_from_calls(t: Inputs) -> DataFrame:
    calls = t.calls.withColumns({"n_tools": F.when(F.col("call_id") % 3 == 0, 1).otherwise(2), "methods": filters.methods_of(F.array("source"))})
    return softclip.call_breakpoints(calls)


@query("ins_pad", "SELECT call_id, CASE WHEN sv_type = 'INS' THEN greatest(start_pos - 700000, 0) ELSE start_pos END AS start_pos, CASE WHEN sv_type = 'INS' THEN end_pos + 700000 ELSE end_pos END AS end_pos FROM calls", ("calls",))
def ins_pad(t: Inputs) -> DataFrame:
    return softclip.padded(t.calls, 700_000).select("call_id", "start_pos", "end_pos")


@query("ins_unpad", "SELECT call_id, CASE WHEN sv_type = 'INS' THEN start_pos + 20 ELSE start_pos END AS start_pos, CASE WHEN sv_type = 'INS' THEN greatest(end_pos - 20, start_pos + 21) ELSE end_pos END AS end_pos FROM calls", ("calls",))
def ins_unpad(t: Inputs) -> DataFrame:
    return softclip.unpadded(t.calls, 20).select("call_id", "start_pos", "end_pos")


@query(
    "fix_precise_coords",
    """WITH m AS (SELECT chrom, start_pos // 20000 AS bin, sv_type, count(*) AS n, min(start_pos) AS s, max(end_pos) AS e, first(start_pos ORDER BY call_id) FILTER (source = 'Pindel') AS ps, first(end_pos ORDER BY call_id) FILTER (source = 'Pindel') AS pe,
    first(start_pos ORDER BY call_id) FILTER (source = 'BreakSeq') AS bs, first(end_pos ORDER BY call_id) FILTER (source = 'BreakSeq') AS be FROM calls GROUP BY ALL)
    SELECT chrom, bin, sv_type, CASE WHEN ps IS NOT NULL THEN ps WHEN bs IS NOT NULL THEN bs ELSE s END AS start_pos, CASE WHEN ps IS NOT NULL THEN pe WHEN bs IS NOT NULL THEN be ELSE e END AS end_pos FROM m""",
    ("calls",),
)
def fix_precise_coords(t: Inputs) -> DataFrame:
    member = F.struct("call_id", F.col("start_pos").alias("start"), F.col("end_pos").alias("end"), "source")
    merged = t.calls.groupBy("chrom", F.floor(F.col("start_pos") / 20000).alias("bin"), "sv_type").agg(F.array_sort(F.collect_list(member)).alias("members"), F.min("start_pos").alias("s"), F.max("end_pos").alias("e"))
    return merged.select("chrom", "bin", "sv_type", softclip.precise_coordinates(F.col("members"), F.col("s"), F.col("e")).alias("p")).select("chrom", "bin", "sv_type", F.col("p.start").alias("start_pos"), F.col("p.end").alias("end_pos"))


WITH_CALLS_SQL = (
    FULL_SQL
    + """,
bo AS (SELECT 'sc:' || id AS id, chrom, sv_type, s, e, 'SoftClip' AS source FROM fi UNION ALL SELECT 'call:' || call_id, chrom, sv_type, start_pos, end_pos, source FROM calls),
bp AS MATERIALIZED (SELECT id, chrom, sv_type, source, CASE WHEN sv_type = 'INS' THEN greatest(s - 100, 0) ELSE s END AS s, CASE WHEN sv_type = 'INS' THEN e + 100 ELSE e END AS e FROM bo),
bn AS (SELECT * FROM bp WHERE sv_type NOT IN ('ITX', 'CTX')),
"""
    + merge_full_sql("bn", 100)
    + f""",
tl AS (SELECT u.sv_type, u.chrom, u.start_pos, u.end_pos, ids[1] AS first_id, list(DISTINCT source ORDER BY source) AS tools FROM (SELECT *, unnest(ids) AS id FROM mf) u JOIN bp ON bp.id = u.id GROUP BY ALL
  UNION ALL SELECT sv_type, chrom, s, e, id, [source] FROM bp WHERE sv_type IN ('ITX', 'CTX')),
tm AS (SELECT first_id, string_agg(DISTINCT k, ';' ORDER BY k) AS methods FROM (SELECT first_id, unnest(CASE WHEN source = 'SoftClip' THEN ['SC'] ELSE {METHODS_SQL} END) AS k FROM (SELECT first_id, unnest(tools) AS source FROM tl)) GROUP BY first_id)"""
)


@query(
    "sc_with_calls",
    f"""WITH RECURSIVE {WITH_CALLS_SQL} SELECT sv_type, chrom, CASE WHEN sv_type = 'INS' THEN start_pos + 100 ELSE start_pos END AS start_pos, CASE WHEN sv_type = 'INS' THEN greatest(end_pos - 100, start_pos + 101) ELSE end_pos END AS end_pos,
    first_id, array_to_string(tools, ',') AS tools, methods FROM tl JOIN tm USING (first_id)""",
    ("reads", "calls"),
)
def sc_with_calls(t: Inputs) -> DataFrame:
    """Soft-clip intervals and callers' merged per type; translocations pass through."""
    mine = full(t).select(F.concat(F.lit("sc:"), "id").alias("id"), "chrom", "sv_type", "start_pos", "end_pos", F.lit("SoftClip").alias("source"))
    theirs = t.calls.select(F.concat(F.lit("call:"), F.col("call_id").cast("string")).alias("id"), "chrom", "sv_type", "start_pos", "end_pos", "source")
    both = kept(softclip.padded(mine.unionByName(theirs), 100))
    # A member brings its source along, so nothing is joined back by its name.
    named = both.where("sv_type not in ('ITX', 'CTX')").withColumn("id", F.struct("id", "source"))
    tools = merge_per_type(named, pad=100).select("sv_type", "chrom", "start_pos", "end_pos", F.col("ids")[0]["id"].alias("first_id"), F.array_sort(F.array_distinct(F.col("ids.source"))).alias("tools"))
    passed = both.where("sv_type in ('ITX', 'CTX')").select("sv_type", "chrom", "start_pos", "end_pos", F.col("id").alias("first_id"), F.array("source").alias("tools"))
    out = softclip.unpadded(tools.unionByName(passed), 100)
    return out.withColumns({"methods": F.array_join(filters.methods_of(F.col("tools")), ";"), "tools": F.array_join("tools", ",")})
