"""Queries over calls: filters, merging, validation, joins, ranking and set operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import constants as C
from ..fixtures import Inputs
from ..operators import filters, merge
from ..operators.intervals import anti_overlap, islands, overlap_join, reciprocal
from .registry import query

ID = ["call_id", "chrom", "start_pos", "end_pos", "sv_type", "sv_len", "source"]
COLS = ", ".join(ID)
TX = "('ITX', 'CTX')"


def usable(t: Inputs) -> DataFrame:
    """What goes into the merge: long enough, or a translocation, with its wiggle."""
    info = F.concat(F.lit("RP="), F.col("call_id") % 9, F.when(F.col("call_id") % 2 == 0, F.concat(F.lit(";SR="), F.col("call_id") % 5)).otherwise(""))
    return filters.long_enough(t.calls).withColumns({"wiggle": filters.wiggle_of(), "info": info})


# Filters


@query("flt_contigs", f"SELECT {COLS} FROM calls WHERE chrom IN (SELECT chrom FROM contigs WHERE chrom IN ('1', '2', '3', '5', '21', 'X'))", ("calls", "contigs"))
def flt_contigs(t: Inputs) -> DataFrame:
    return filters.on_contigs(t.calls, t.contigs, ["1", "2", "3", "5", "21", "X"], standard=True).select(*ID)


@query(
    "flt_svtypes",
    f"""SELECT {COLS} FROM calls WHERE sv_type IN ('DEL', 'INS', 'DUP') AND (source <> 'BreakDancer' OR sv_type IN ('DEL', 'INS', 'INV', 'ITX', 'CTX'))
    AND (source <> 'Pindel' OR sv_type IN ('DEL', 'INS', 'INV', 'DUP')) AND (source <> 'CNVnator' OR sv_type IN ('DEL', 'DUP')) AND (source <> 'BreakSeq' OR sv_type IN ('DEL', 'INS'))""",
    ("calls",),
)
def flt_svtypes(t: Inputs) -> DataFrame:
    return filters.reported_types(t.calls, ["DEL", "INS", "DUP"]).select(*ID)


@query("flt_minlen", f"SELECT {COLS} FROM calls WHERE sv_len >= 50 OR sv_type IN {TX}", ("calls",))
def flt_minlen(t: Inputs) -> DataFrame:
    return filters.long_enough(t.calls).select(*ID)


@query("flt_bd_inv_artifact", f"SELECT {COLS} FROM calls WHERE NOT (source = 'BreakDancer' AND sv_type = 'INV' AND abs(sv_len) < 300)", ("calls",))
def flt_bd_inv_artifact(t: Inputs) -> DataFrame:
    return filters.without_short_inversions(t.calls).select(*ID)


@query("flt_caller_filter", f"SELECT {COLS} FROM calls WHERE source NOT IN ('BreakSeq', 'Lumpy', 'Manta', 'CNVkit', 'WHAM') OR call_id % 9 <> 0", ("calls",))
def flt_caller_filter(t: Inputs) -> DataFrame:
    return filters.passing(t.calls.withColumn("filter", F.when(F.col("call_id") % 9 == 0, "LowQual").otherwise("PASS"))).select(*ID)


@query("set_wiggle", f"SELECT call_id, sv_type, CAST(CASE WHEN sv_type IN {TX} THEN 5 ELSE 100 END AS INTEGER) AS wiggle FROM calls", ("calls",))
def set_wiggle(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", "sv_type", filters.wiggle_of().alias("wiggle"))


@query("anti_gap", f"SELECT {COLS} FROM calls c WHERE NOT EXISTS (SELECT 1 FROM gaps g WHERE g.chrom = c.chrom AND greatest(c.start_pos, g.start_pos) < least(c.end_pos, g.end_pos))", ("calls", "gaps"))
def anti_gap(t: Inputs) -> DataFrame:
    return filters.outside_gaps(t.calls, t.gaps).select(*ID)


@query("semi_include", f"SELECT {COLS} FROM calls c WHERE EXISTS (SELECT 1 FROM contigs k WHERE k.chrom = c.chrom AND c.start_pos - 2100 >= 0 AND c.end_pos + 2100 <= k.length)", ("calls", "contigs"))
def semi_include(t: Inputs) -> DataFrame:
    return filters.inside_contigs(t.calls, t.contigs, pad=2100).select(*ID)


@query("gap_build_select", "SELECT chrom, start_pos, end_pos FROM gaps", ("gaps", "contigs"))
def gap_build_select(t: Inputs) -> DataFrame:
    gaps = t.gaps
    return filters.gap_build(t.contigs, gaps, gaps.withColumn("chrom", F.concat(F.lit("chr"), "chrom"))).select("chrom", "start_pos", "end_pos")


@query("methods_of", "SELECT call_id, CASE source WHEN 'Pindel' THEN 'SR' WHEN 'BreakSeq' THEN 'JM' WHEN 'HaplotypeCaller' THEN 'AS' WHEN 'BreakDancer' THEN 'RP' WHEN 'CNVnator' THEN 'RD' ELSE 'RP,SR' END AS methods FROM calls", ("calls",))
def methods_of(t: Inputs) -> DataFrame:
    return t.calls.select("call_id", F.array_join(filters.methods_of(F.array("source")), ",").alias("methods"))


@query("flt_final_len", f"SELECT {COLS} FROM calls WHERE sv_len BETWEEN 100 AND 900 OR sv_type IN {TX}", ("calls",))
def flt_final_len(t: Inputs) -> DataFrame:
    return filters.length_between(t.calls, 100, 900).select(*ID)


@query(
    "fix_pos",
    """SELECT call_id, CASE WHEN sv_type = 'INS' AND source IN ('Pindel', 'BreakSeq', 'HaplotypeCaller') THEN (start_pos + end_pos + 7) // 2 ELSE start_pos END AS start_pos,
    CASE WHEN sv_type = 'INS' AND source IN ('Pindel', 'BreakSeq', 'HaplotypeCaller') THEN (start_pos + end_pos + 7) // 2 WHEN sv_type = 'INS' THEN start_pos ELSE end_pos + 7 END AS end_pos FROM calls""",
    ("calls",),
)
def fix_pos(t: Inputs) -> DataFrame:
    rows = t.calls.withColumns({"is_precise": filters.is_precise_source(F.col("source")), "end_pos": F.col("end_pos") + 7})
    return filters.fixed_position(rows).select("call_id", "start_pos", "end_pos")


# Merging


def islands_sql(source: str, out: str, keys: str, order: str, low: str, high: str, test: str = ">=", extra: str = "") -> str:
    """Common table expressions that number islands, like `operators.intervals.islands`; rows equal in `order` share theirs."""
    return f"""{out}_n AS (SELECT *, CASE WHEN {low} {test} max({high}) OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING){extra} IS NOT FALSE THEN 1 ELSE 0 END AS is_new FROM {source}),
{out} AS MATERIALIZED (SELECT * EXCLUDE (is_new), CAST(sum(is_new) OVER (PARTITION BY {keys} ORDER BY {order} RANGE UNBOUNDED PRECEDING) AS BIGINT) AS island FROM {out}_n)"""


def near_runs_sql(source: str, out: str, keys: str, reach: int, order: str = "s, e, id") -> str:
    """Like `operators.merge._near_runs`."""
    return f"""{out}_n AS (SELECT *, CASE WHEN s >= max(s + {reach}) OVER (PARTITION BY {keys} ORDER BY {order} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS new_site,
  CASE WHEN s - lag(s) OVER v < lag(w) OVER v AND abs(e - lag(e) OVER v) < lag(w) OVER v THEN 0 ELSE 1 END AS new_run FROM {source} WINDOW v AS (PARTITION BY {keys} ORDER BY {order})),
{out}_r AS (SELECT * EXCLUDE (new_site, new_run), sum(new_site) OVER v AS site, sum(new_run) OVER v AS run FROM {out}_n WINDOW v AS (PARTITION BY {keys} ORDER BY {order} ROWS UNBOUNDED PRECEDING)),
{out} AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY {keys}, run ORDER BY {order}) - 1 AS nr, count(*) OVER (PARTITION BY {keys}, run) AS n FROM {out}_r)"""


def tx_level1_sql(wiggle: int) -> str:
    """`txk`, the calls of each level-1 translocation, and `tx1`, these."""
    keys = "sv_type, source, chrom, chrom2"
    calls = f"tx0 AS (SELECT call_id AS id, sv_type, source, chrom, chrom2, start_pos AS s, end_pos AS e, {wiggle} AS w, sv_len FROM calls WHERE sv_type IN {TX})"
    return f"""{calls},
{near_runs_sql("tx0", "txr", keys, wiggle)},
txk AS MATERIALIZED (SELECT *, first_value(id) OVER (PARTITION BY {keys}, run, nr // 2 ORDER BY nr) AS l1_id FROM txr),
tx1 AS MATERIALIZED (SELECT l1_id AS id, sv_type, source, chrom, chrom2, CASE WHEN count(*) = 1 THEN min(s) ELSE min(s - w) END AS s, CASE WHEN count(*) = 1 THEN max(e) ELSE max(e + w) END AS e,
  CASE WHEN count(*) = 1 THEN {wiggle} ELSE 0 END AS w, max(sv_len) AS sv_len, count(*) AS n_calls FROM txk GROUP BY l1_id, sv_type, source, chrom, chrom2)"""


def tx_rounds_sql() -> str:
    """`txl(l1_id, l2_id)`, the level-2 pairs of translocations, in as many rounds as they take."""
    key = "sv_type, chrom, chrom2, path"
    return f"""tx2 AS (SELECT id, sv_type, chrom, chrom2, s, e, w, '' AS path, CAST(NULL AS BIGINT) AS l2_id FROM tx1
UNION ALL (WITH xk AS (SELECT id, sv_type, chrom, chrom2, s, e, w, path FROM tx2 WHERE l2_id IS NULL),
{near_runs_sql("xk", "yk", key, 5)},
zk AS (SELECT *, first_value(id) OVER (PARTITION BY {key}, run, nr // 2 ORDER BY nr) AS head FROM yk),
fk AS (SELECT *, EXISTS (SELECT 1 FROM yk o WHERE o.sv_type = zk.sv_type AND o.chrom = zk.chrom AND o.chrom2 = zk.chrom2 AND o.path = zk.path AND o.site = zk.site AND o.nr = o.n - 1 AND o.n % 2 = 1 AND o.w > 0 AND abs(o.s - zk.s) < zk.w AND abs(o.e - zk.e) < zk.w) AS fits FROM zk),
gk AS (SELECT *, sum(CASE WHEN fits THEN 1 ELSE 0 END) OVER (PARTITION BY {key}, site) AS n_fit, count(*) OVER (PARTITION BY {key}, site) AS n_all FROM fk)
SELECT id, sv_type, chrom, chrom2, s, e, w, path || CASE WHEN fits THEN 'g' ELSE 'b' END, CASE WHEN n_fit = n_all THEN head WHEN n_fit = 0 THEN id END FROM gk)),
txl AS MATERIALIZED (SELECT id AS l1_id, l2_id FROM tx2 WHERE l2_id IS NOT NULL)"""


USABLE_SQL = f"c AS MATERIALIZED (SELECT *, 100 AS wiggle FROM calls WHERE sv_len >= 50 AND sv_type NOT IN {TX})"
LEVEL1_SQL = (
    USABLE_SQL
    + ",\n"
    + islands_sql("c", "l1i", "sv_type, source, chrom", "start_pos, end_pos, call_id", "start_pos - wiggle", "end_pos + wiggle")
    + ",\n"
    + tx_level1_sql(5)
    + """,
l1 AS MATERIALIZED (SELECT first(call_id ORDER BY start_pos, end_pos, call_id) AS id, sv_type, source, chrom, chrom AS chrom2,
  CASE WHEN count(*) = 1 THEN min(start_pos) ELSE min(start_pos - wiggle) END AS s, CASE WHEN count(*) = 1 THEN max(end_pos) ELSE max(end_pos + wiggle) END AS e,
  CASE WHEN count(*) = 1 THEN 100 ELSE 0 END AS w, max(sv_len) AS sv_len, count(*) AS n_calls FROM l1i GROUP BY sv_type, source, chrom, island UNION ALL SELECT * FROM tx1)"""
)


def rounds_sql() -> str:
    """`links(l1_id, l2_id)`, the level-2 merge in as many rounds as it takes; needs WITH RECURSIVE."""
    key = "sv_type, chrom, path"
    inner = f"{key}, comp"
    return f"""lv AS (SELECT id, sv_type, chrom, s, e, w, '' AS path, CAST(NULL AS BIGINT) AS l2_id FROM l1 WHERE sv_type NOT IN ('ITX', 'CTX')
UNION ALL (WITH rk AS (SELECT id, sv_type, chrom, s, e, w, path FROM lv WHERE l2_id IS NULL),
ra AS (SELECT *, CASE WHEN s - w > max(e + w) OVER (PARTITION BY {key} ORDER BY s - w, s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS nw FROM rk),
rb AS (SELECT * EXCLUDE (nw), sum(nw) OVER (PARTITION BY {key} ORDER BY s - w, s, e, id ROWS UNBOUNDED PRECEDING) AS comp FROM ra),
rc AS (SELECT *, CASE WHEN s - w >= max(e + w) OVER (PARTITION BY {inner} ORDER BY s, e, id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) IS NOT FALSE THEN 1 ELSE 0 END AS nw FROM rb),
rd AS MATERIALIZED (SELECT * EXCLUDE (nw), sum(nw) OVER (PARTITION BY {inner} ORDER BY s, e, id ROWS UNBOUNDED PRECEDING) AS part FROM rc),
re AS (SELECT {inner}, part, max(e + w) AS reach, count(*) AS size, first(s ORDER BY s, e, id) AS fs, first(e ORDER BY s, e, id) AS fe, first(w ORDER BY s, e, id) AS fw FROM rd GROUP BY {inner}, part),
rf AS (SELECT *, CASE WHEN fw = 0 AND fs = lag(reach) OVER v AND fe > fs AND (lag(size) OVER v > 1 OR lag(fw) OVER v = 0) THEN 0 ELSE 1 END AS nw FROM re WINDOW v AS (PARTITION BY {inner} ORDER BY part)),
rg AS (SELECT {inner}, part, sum(nw) OVER (PARTITION BY {inner} ORDER BY part ROWS UNBOUNDED PRECEDING) AS isle FROM rf),
rh AS (SELECT d.*, g.isle FROM rd d JOIN rg g USING (sv_type, chrom, path, comp, part)),
ri AS (SELECT *, min(s - w) OVER v AS low, max(e + w) OVER v AS high, count(*) OVER v AS size, first_value(id) OVER (PARTITION BY {inner}, isle ORDER BY s, e, id) AS head FROM rh WINDOW v AS (PARTITION BY {inner}, isle)),
rj AS (SELECT *, (e + w - s + w >= 1 AND (size = 1 OR e + w - s + w >= 0.5 * (high - low))) AS fits FROM ri),
rn AS (SELECT *, sum(CASE WHEN fits THEN 1 ELSE 0 END) OVER (PARTITION BY {inner}) AS n_fit, count(*) OVER (PARTITION BY {inner}) AS n_all FROM rj)
SELECT id, sv_type, chrom, s, e, w, path || CASE WHEN fits THEN 'g' ELSE 'b' END, CASE WHEN n_fit = n_all THEN head WHEN n_fit = 0 THEN id END FROM rn)),
{tx_rounds_sql()},
links AS MATERIALIZED (SELECT id AS l1_id, l2_id FROM lv WHERE l2_id IS NOT NULL UNION ALL SELECT * FROM txl)"""


LEVEL2_SQL = (
    LEVEL1_SQL
    + ",\n"
    + rounds_sql()
    + """,
m AS MATERIALIZED (SELECT l2_id, l1.*, row_number() OVER (PARTITION BY l2_id ORDER BY s, e, id) AS nr, count(*) OVER (PARTITION BY l2_id) AS n_items FROM links JOIN l1 ON l1.id = links.l1_id),
leaf AS MATERIALIZED (SELECT m.l2_id, m.nr, m.n_items, m.n_calls, x.call_id, x.start_pos, x.end_pos, x.sv_len, x.source, m.sv_type FROM m JOIN l1k x ON x.l1_id = m.id),
l2 AS MATERIALIZED (SELECT m.l2_id, any_value(sv_type) AS sv_type, any_value(chrom) AS chrom, any_value(chrom2) AS chrom2, max(m.sv_len) AS sv_len, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(DISTINCT source) AS n_sources,
  CASE WHEN count(*) = 1 THEN min(s) ELSE min(s - w) END AS s, CASE WHEN count(*) = 1 THEN max(e) ELSE max(e + w) END AS e, count(*) AS n_level1, CAST(sum(n_calls) AS BIGINT) AS n_calls FROM m GROUP BY m.l2_id),
bounds AS (SELECT l2_id, min(start_pos) AS call_start, max(end_pos) AS call_end FROM leaf GROUP BY l2_id),
members AS MATERIALIZED (
  SELECT l2_id, sv_type, start_pos AS s, end_pos AS e, CASE WHEN sv_type IN ('ITX', 'CTX') THEN 5 ELSE 100 END AS w, sv_len, source FROM leaf WHERE nr = 1 AND NOT (n_items = 1 AND n_calls = 1)
  UNION ALL SELECT l2_id, sv_type, s, e, w, sv_len, source FROM m WHERE nr > 1)"""
).replace(
    "l1 AS MATERIALIZED",
    "l1k AS MATERIALIZED (SELECT first_value(call_id) OVER (PARTITION BY sv_type, source, chrom, island ORDER BY start_pos, end_pos, call_id) AS l1_id, call_id, start_pos, end_pos, sv_len, source FROM l1i UNION ALL SELECT l1_id, id, s, e, sv_len, source FROM txk),\nl1 AS MATERIALIZED",
    1,
)

RANK = "CASE source WHEN 'Pindel' THEN 1 WHEN 'BreakSeq' THEN 2 WHEN 'HaplotypeCaller' THEN 3 WHEN 'BreakDancer' THEN 4 WHEN 'CNVnator' THEN 5 WHEN 'Manta' THEN 6 WHEN 'Lumpy' THEN 7 ELSE 0 END"
PRECISE = "('Pindel', 'BreakSeq', 'HaplotypeCaller', 'SoftClip')"

VALIDATE_SQL = (
    LEVEL2_SQL
    + f""",
p AS (SELECT * FROM members WHERE source IN {PRECISE} AND sv_type NOT IN {TX}),
"""
    + islands_sql("p", "pi", "l2_id", "s, e, source", "s - w", "e + w")
    + f""",
pm AS MATERIALIZED (SELECT l2_id, min(s - w) AS low, max(e + w) AS high FROM pi GROUP BY l2_id, island),
one AS (SELECT *, count(*) OVER (PARTITION BY l2_id, source) AS n FROM members),
cand AS MATERIALIZED (SELECT one.*, {RANK} AS rk FROM one JOIN bounds USING (l2_id) WHERE n = 1 AND CASE WHEN sv_type IN {TX} THEN source IN {PRECISE} ELSE (
  (least(e + w, call_end) - greatest(s - w, call_start) >= 1 AND least(e + w, call_end) - greatest(s - w, call_start) >= 0.5 * greatest(e - s + 2 * w, call_end - call_start))
  OR EXISTS (SELECT 1 FROM pm WHERE pm.l2_id = one.l2_id AND least(e + w, high) - greatest(s - w, low) >= 1 AND least(e + w, high) - greatest(s - w, low) >= 0.5 * greatest(e - s + 2 * w, high - low))) END),
dec AS (SELECT * FROM cand QUALIFY row_number() OVER (PARTITION BY l2_id ORDER BY rk) = 1),
somelen AS (SELECT l2_id, sv_len AS some_len FROM members WHERE sv_len > 0 QUALIFY row_number() OVER (PARTITION BY l2_id ORDER BY {RANK}, s, e, sv_len) = 1),
nm AS (SELECT l2_id, count(*) AS n_members FROM members GROUP BY l2_id),
v AS MATERIALIZED (SELECT l2.*, call_start, call_end, dec.s AS by_s, dec.e AS by_e, dec.sv_len AS by_len, some_len, dec.source AS by_source,
  (n_members IS NOT NULL AND dec.source IS NOT NULL AND n_sources > 1) AS is_validated,
  CASE WHEN n_members IS NULL THEN sources IN {PRECISE} ELSE coalesce(dec.source IN {PRECISE}, FALSE) END AS is_precise
  FROM l2 JOIN bounds USING (l2_id) LEFT JOIN dec USING (l2_id) LEFT JOIN somelen USING (l2_id) LEFT JOIN nm USING (l2_id))"""
)


@query("merge_intra", f"WITH {LEVEL1_SQL} SELECT id AS l1_id, sv_type, source, chrom, s AS start_pos, e AS end_pos, w AS wiggle, sv_len, n_calls, chrom2 FROM l1", ("calls",))
def merge_intra(t: Inputs) -> DataFrame:
    return merge.level1_of(usable(t)).drop("leaves")


@query("merge_inter", f"WITH RECURSIVE {LEVEL2_SQL} SELECT l2_id, sv_type, chrom, s AS start_pos, e AS end_pos, n_level1, n_calls, sv_len, sources FROM l2", ("calls",))
def merge_inter(t: Inputs) -> DataFrame:
    return level2_calls(t).select("l2_id", "sv_type", "chrom", "start_pos", "end_pos", F.col("n_level1").cast("long"), F.col("n_calls").cast("long"), "sv_len", F.array_join("sources", ",").alias("sources"))


def level2_calls(t: Inputs) -> DataFrame:
    return merge.level2_of(plain(t))


def plain(t: Inputs) -> DataFrame:
    """The same calls for queries that give no INFO."""
    return usable(t).drop("info")


@query("validate_calls", f"WITH RECURSIVE {VALIDATE_SQL} SELECT l2_id, call_start AS start_pos, call_end AS end_pos, is_validated, is_precise, by_source FROM v", ("calls",))
def validate_calls(t: Inputs) -> DataFrame:
    return merge.validate_calls(level2_calls(t)).select("l2_id", "start_pos", "end_pos", "is_validated", "is_precise", F.col("by.source").alias("by_source"))


@query(
    "snap_precise",
    f"""WITH RECURSIVE {VALIDATE_SQL} SELECT l2_id, sv_type, chrom, chrom2, CASE WHEN is_validated AND is_precise THEN by_s ELSE call_start END AS start_pos, CASE WHEN is_validated AND is_precise THEN by_e ELSE call_end END AS end_pos,
    CASE WHEN is_validated AND is_precise THEN CASE WHEN by_len <> 0 THEN by_len ELSE coalesce(some_len, by_len) END ELSE sv_len END AS sv_len, is_validated, is_precise FROM v""",
    ("calls",),
)
def snap_precise(t: Inputs) -> DataFrame:
    return merge.consolidated(plain(t)).select("l2_id", "sv_type", "chrom", "chrom2", "start_pos", "end_pos", "sv_len", "is_validated", "is_precise")


@query("singleton_precise", f"WITH RECURSIVE {VALIDATE_SQL} SELECT v.l2_id, is_precise, is_validated FROM v LEFT JOIN nm USING (l2_id) WHERE n_members IS NULL", ("calls",))
def singleton_precise(t: Inputs) -> DataFrame:
    return merge.validate_calls(level2_calls(t)).where(F.size("members") == 0).select("l2_id", "is_precise", "is_validated")


@query("precise_premerge", f"WITH RECURSIVE {VALIDATE_SQL} SELECT l2_id, min(s - w) AS low, max(e + w) AS high, count(*) AS size FROM pi GROUP BY l2_id, island", ("calls",))
def precise_premerge(t: Inputs) -> DataFrame:
    return merge.precise_islands(merge.member_rows(level2_calls(t))).select("l2_id", "low", "high", "size")


@query("call_stats", f"WITH RECURSIVE {VALIDATE_SQL} SELECT sv_type, CASE WHEN is_validated THEN 'PASS' ELSE 'LowQual' END AS filter, CASE WHEN is_precise THEN 'PRECISE' ELSE 'IMPRECISE' END AS precision, sources, count(*) AS n FROM v GROUP BY ALL", ("calls",))
def call_stats(t: Inputs) -> DataFrame:
    return merge.call_stats(merge.consolidated(plain(t)))


METHODS_SQL = "CASE source WHEN 'Pindel' THEN ['SR'] WHEN 'BreakSeq' THEN ['JM'] WHEN 'HaplotypeCaller' THEN ['AS'] WHEN 'BreakDancer' THEN ['RP'] WHEN 'CNVnator' THEN ['RD'] ELSE ['RP', 'SR'] END"


@query(
    "info_merge",
    f"""WITH RECURSIVE {LEVEL2_SQL}, txt AS (SELECT l2_id, string_agg(chrom || '-' || s || '-' || chrom2 || '-' || e || '-' || members.sv_len || '-' || source, ',' ORDER BY chrom || '-' || s || '-' || chrom2 || '-' || e || '-' || members.sv_len || '-' || source) AS sources_text FROM members JOIN (SELECT l2_id, chrom, chrom2 FROM l2) USING (l2_id) GROUP BY l2_id),
    met AS (SELECT l2_id, count(DISTINCT k) AS num_svmethods FROM (SELECT l2_id, unnest({METHODS_SQL}) AS k FROM m) GROUP BY l2_id),
    mi AS (SELECT l2_id, 1 AS nr, start_pos AS s, end_pos AS e, call_id FROM leaf WHERE nr = 1 AND NOT (n_items = 1 AND n_calls = 1) UNION ALL SELECT l2_id, nr, s, e, id FROM m WHERE nr > 1 AND n_calls = 1),
    kv AS (SELECT *, 'RP' AS k, call_id % 9 AS v FROM mi UNION ALL SELECT *, 'SR', call_id % 5 FROM mi WHERE call_id % 2 = 0),
    inf AS (SELECT l2_id, string_agg(k || '=' || v, ';' ORDER BY k) AS info FROM (SELECT l2_id, k, last(v ORDER BY nr, s, e, call_id) AS v FROM kv GROUP BY l2_id, k) GROUP BY l2_id)
    SELECT l2_id, sources_text, CAST(num_svmethods AS INTEGER) AS num_svmethods, CAST(n_sources AS INTEGER) AS num_svtools, coalesce(info, '') AS info FROM txt JOIN met USING (l2_id) JOIN l2 USING (l2_id) LEFT JOIN inf USING (l2_id)""",
    ("calls",),
)
def info_merge(t: Inputs) -> DataFrame:
    return merge.info_merge(merge.level2_of(usable(t)))


# Joins


@query("join_overlap", "SELECT c.call_id, k.start_pos AS track_start, k.end_pos AS track_end, k.score, least(c.end_pos + 10, k.end_pos) - greatest(c.start_pos - 10, k.start_pos) AS overlap_bp FROM calls c JOIN track k ON c.chrom = k.chrom AND greatest(c.start_pos - 10, k.start_pos) < least(c.end_pos + 10, k.end_pos)", ("calls", "track"))
def join_overlap(t: Inputs) -> DataFrame:
    return overlap_join(t.calls, t.track, 10).select("call_id", F.col("b_start_pos").alias("track_start"), F.col("b_end_pos").alias("track_end"), F.col("b_score").alias("score"), "overlap_bp")


RECIPROCAL_SQL = "a.chrom = b.chrom AND greatest(a.start_pos, b.start_pos) < least(a.end_pos, b.end_pos) AND least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) >= {0} * greatest(a.end_pos - a.start_pos, b.end_pos - b.start_pos)"


def dels_dups(t: Inputs) -> tuple[DataFrame, DataFrame]:
    calls = t.calls.select("call_id", "chrom", "start_pos", "end_pos", "sv_type")
    return calls.where("sv_type = 'DEL'"), calls.where("sv_type = 'DUP'")


@query("join_reciprocal", f"SELECT a.call_id, b.call_id AS b_call_id, least(a.end_pos, b.end_pos) - greatest(a.start_pos, b.start_pos) AS overlap_bp FROM calls a JOIN calls b ON {RECIPROCAL_SQL.format(0.5)} WHERE a.sv_type = 'DEL' AND b.sv_type = 'DUP'", ("calls",))
def join_reciprocal(t: Inputs) -> DataFrame:
    return overlap_join(*dels_dups(t)).where(reciprocal(0.5)).select("call_id", "b_call_id", "overlap_bp")


@query("join_wa_wb", f"SELECT a.call_id, a.start_pos, a.end_pos, b.call_id AS b_call_id, b.start_pos AS b_start_pos, b.end_pos AS b_end_pos FROM calls a JOIN calls b ON {RECIPROCAL_SQL.format(0.9)} WHERE a.sv_type = 'DEL' AND b.sv_type = 'DUP'", ("calls",))
def join_wa_wb(t: Inputs) -> DataFrame:
    return overlap_join(*dels_dups(t)).where(reciprocal(0.9)).select("call_id", "start_pos", "end_pos", "b_call_id", "b_start_pos", "b_end_pos")


@query("join_window", "SELECT a.call_id, b.call_id AS b_call_id FROM calls a JOIN calls b ON a.chrom = b.chrom AND greatest(a.start_pos - 10, b.start_pos) < least(a.end_pos + 10, b.end_pos) WHERE a.sv_type = 'DEL' AND b.sv_type = 'DUP'", ("calls",))
def join_window(t: Inputs) -> DataFrame:
    return overlap_join(*dels_dups(t), 10).select("call_id", "b_call_id")


@query("anti_reciprocal", f"SELECT a.call_id FROM calls a WHERE a.sv_type = 'DEL' AND NOT EXISTS (SELECT 1 FROM calls b WHERE b.sv_type = 'DUP' AND {RECIPROCAL_SQL.format(0.95)})", ("calls",))
def anti_reciprocal(t: Inputs) -> DataFrame:
    return anti_overlap(*dels_dups(t), "call_id", ratio=0.95).select("call_id")


@query("subtract_whole", f"SELECT a.call_id FROM calls a WHERE a.sv_type = 'DEL' AND NOT EXISTS (SELECT 1 FROM calls b WHERE b.sv_type = 'DUP' AND {RECIPROCAL_SQL.format(0.5)})", ("calls",))
def subtract_whole(t: Inputs) -> DataFrame:
    return anti_overlap(*dels_dups(t), "call_id", ratio=0.5).select("call_id")


@query("count_window", "SELECT a.call_id, count(b.call_id) AS n FROM (SELECT * FROM calls WHERE sv_type = 'DEL') a LEFT JOIN (SELECT * FROM calls WHERE sv_type = 'DUP') b ON a.chrom = b.chrom AND greatest(a.start_pos - 20, b.start_pos) < least(a.end_pos + 20, b.end_pos) GROUP BY a.call_id", ("calls",))
def count_window(t: Inputs) -> DataFrame:
    dels, dups = dels_dups(t)
    found = overlap_join(dels, dups, 20).groupBy("call_id").agg(F.count("*").alias("n"))
    return dels.join(found, "call_id", "left").select("call_id", F.coalesce("n", F.lit(0)).alias("n"))


@query(
    "left_overlap_bp",
    "SELECT c.call_id, coalesce(k.start_pos, -1) AS track_start, CASE WHEN k.start_pos IS NULL THEN 0 ELSE least(c.end_pos, k.end_pos) - greatest(c.start_pos, k.start_pos) END AS overlap_bp FROM calls c LEFT JOIN track k ON c.chrom = k.chrom AND greatest(c.start_pos, k.start_pos) < least(c.end_pos, k.end_pos)",
    ("calls", "track"),
)
def left_overlap_bp(t: Inputs) -> DataFrame:
    calls = t.calls
    met = overlap_join(calls, t.track).select("call_id", "b_start_pos", "overlap_bp")
    return calls.select("call_id").join(met, "call_id", "left").select("call_id", F.coalesce("b_start_pos", F.lit(-1)).alias("track_start"), F.coalesce("overlap_bp", F.lit(0)).alias("overlap_bp"))


@query(
    "join_tx_proximity",
    "SELECT a.call_id, b.call_id AS b_call_id FROM calls a JOIN calls b ON a.sv_type = b.sv_type AND a.chrom = b.chrom AND a.chrom2 = b.chrom2 AND a.call_id < b.call_id AND abs(a.start_pos - b.start_pos) < 500 AND abs(a.end_pos - b.end_pos) < 500 WHERE a.sv_type IN ('ITX', 'CTX')",
    ("calls",),
)
def join_tx_proximity(t: Inputs) -> DataFrame:
    # Starts nearer than the window fall in the same or neighbouring bins of its width.
    near = 500
    tx = t.calls.where("sv_type in ('ITX', 'CTX')").select("call_id", "sv_type", "chrom", "chrom2", "start_pos", "end_pos", F.floor(F.col("start_pos") / near).alias("bin"))
    left = tx.withColumn("bin", F.explode(F.array(*[F.col("bin") + d for d in (-1, 0, 1)]))).alias("a")
    key = ["sv_type", "chrom", "chrom2", "bin"]
    met = left.join(tx.alias("b"), key).where((F.abs(F.col("a.start_pos") - F.col("b.start_pos")) < near) & (F.abs(F.col("a.end_pos") - F.col("b.end_pos")) < near) & (F.col("a.call_id") < F.col("b.call_id")))
    return met.select(F.col("a.call_id").alias("call_id"), F.col("b.call_id").alias("b_call_id"))


@query("exact_match_join", "SELECT a.call_id, b.call_id AS b_call_id FROM calls a JOIN calls b ON a.chrom = b.chrom AND a.start_pos = b.start_pos AND a.end_pos = b.end_pos WHERE a.source = 'Pindel' AND b.source <> 'Pindel'", ("calls",))
def exact_match_join(t: Inputs) -> DataFrame:
    key = ["chrom", "start_pos", "end_pos"]
    calls = t.calls
    return calls.where("source = 'Pindel'").select("call_id", *key).join(calls.where("source <> 'Pindel'").select(F.col("call_id").alias("b_call_id"), *key), key).select("call_id", "b_call_id")


@query(
    "truth_label_join",
    """WITH f AS (SELECT DISTINCT chrom, start_pos, sv_type, sv_len FROM calls WHERE call_id % 5 = 0), u AS (SELECT DISTINCT chrom, start_pos, sv_type, sv_len FROM calls WHERE call_id % 7 = 0)
    SELECT c.call_id, f.chrom IS NULL AS is_true FROM calls c LEFT JOIN f USING (chrom, start_pos, sv_type, sv_len) LEFT JOIN u USING (chrom, start_pos, sv_type, sv_len) WHERE u.chrom IS NULL""",
    ("calls",),
)
def truth_label_join(t: Inputs) -> DataFrame:
    key = ["chrom", "start_pos", "sv_type", "sv_len"]
    calls = t.calls
    false = calls.where("call_id % 5 = 0").select(*key).distinct().withColumn("_false", F.lit(True))
    unknown = calls.where("call_id % 7 = 0").select(*key)
    return calls.join(unknown, key, "left_anti").join(false, key, "left").select("call_id", F.col("_false").isNull().alias("is_true"))


# Ranking, order, set operations


@query("topk_support", "SELECT call_id, sv_len FROM (SELECT call_id, sv_len, rank() OVER (ORDER BY sv_len DESC) AS r FROM calls) WHERE r <= 100", ("calls",))
def topk_support(t: Inputs) -> DataFrame:
    return top_by(t.calls, "sv_len", 100).select("call_id", "sv_len")


def top_by(df: DataFrame, score: str, k: int) -> DataFrame:
    """Rows whose score is at least the k-th greatest, ties and all. Each task keeps k rows, so no task sees all."""
    least = df.select(score).orderBy(F.col(score).desc()).limit(k).agg(F.min(score).alias("_least"))
    return df.join(F.broadcast(least), F.col(score) >= F.col("_least")).drop("_least")


@query("sort_genomic", "SELECT row_number() OVER (ORDER BY contig_ord, start_pos, end_pos, call_id) AS nr, call_id FROM calls JOIN contigs USING (chrom)", ("calls", "contigs"))
def sort_genomic(t: Inputs) -> DataFrame:
    """Genomic order with row numbers: a range-partitioned sort, then one number per partition is added up."""
    rows = merge.settled(t.calls.join(F.broadcast(t.contigs.select("chrom", "contig_ord")), "chrom").orderBy("contig_ord", "start_pos", "end_pos", "call_id").select("call_id")).withColumn("_id", F.monotonically_increasing_id())
    rows = rows.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))})
    sizes = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = sizes.select("_part", F.coalesce(F.sum("_n").over(merge.W.orderBy("_part").rowsBetween(merge.W.unboundedPreceding, -1)), F.lit(0)).alias("_before"))
    return rows.join(F.broadcast(before), "_part").select((F.col("_before") + F.col("_row") + 1).alias("nr"), "call_id")


@query("union_all", f"SELECT {COLS} FROM calls WHERE source = 'Pindel' UNION ALL SELECT {COLS} FROM calls WHERE sv_type = 'DEL'", ("calls",))
def union_all(t: Inputs) -> DataFrame:
    calls = t.calls.select(*ID)
    return calls.where("source = 'Pindel'").unionByName(calls.where("sv_type = 'DEL'"))


@query("set_diff_names", "SELECT DISTINCT chrom, start_pos FROM calls WHERE sv_type = 'DEL' EXCEPT SELECT chrom, start_pos FROM calls WHERE sv_type = 'DUP'", ("calls",))
def set_diff_names(t: Inputs) -> DataFrame:
    at = t.calls.select("chrom", "start_pos", "sv_type")
    return at.where("sv_type = 'DEL'").drop("sv_type").distinct().join(at.where("sv_type = 'DUP'").drop("sv_type"), ["chrom", "start_pos"], "left_anti")


# Merges by distance, chains and folds


@query(
    "merge_neg_distance",
    "WITH " + islands_sql("reads", "i", "chrom", "pos, aend, read_id", "pos", "aend", ">", " - 30") + " SELECT chrom, min(pos) AS start_pos, max(aend) AS end_pos, count(*) AS n, CAST(sum(mapq) AS BIGINT) AS mapq FROM i GROUP BY chrom, island",
    ("reads",),
)
def merge_neg_distance(t: Inputs) -> DataFrame:
    reads = t.reads.select("read_id", "chrom", F.col("pos").alias("start_pos"), F.col("aend").alias("end_pos"), "mapq")
    return merge.merge_by_distance(reads, ["chrom"], "read_id", 30).groupBy("chrom", "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.count("*").alias("n"), F.sum("mapq").alias("mapq")).drop("island")


@query(
    "src_bed_track",
    "WITH " + islands_sql("track", "i", "chrom", "start_pos, end_pos", "start_pos", "end_pos") + " SELECT chrom, min(start_pos) AS start_pos, max(end_pos) AS end_pos FROM i GROUP BY chrom, island",
    ("track",),
)
def src_bed_track(t: Inputs) -> DataFrame:
    """The track as disjoint intervals, merged in coordinate blocks."""
    rows = t.track.withColumn("id", F.col("end_pos"))
    return islands(rows, ["chrom"], ["start_pos", "id"], F.col("start_pos"), F.col("end_pos")).groupBy("chrom", "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos")).drop("island")


INS_SQL = "x AS (SELECT call_id, chrom, sv_type, source, sv_len, start_pos - 150 AS start_pos, end_pos + 150 AS end_pos FROM calls WHERE sv_type = 'INS')"


def merge_full_sql(source: str, pad: int, p: str = "") -> str:
    """`mf` (after the prefix `p`), the intervals `id, sv_type, chrom, s, e` merged per type, with `ids`; needs WITH RECURSIVE."""
    cut = islands_sql(f"{p}cc", f"{p}cd", "sv_type, chrom", "s, e, id", "s", "e")  # no chain crosses islands, so the recursion is as deep as an island
    chain = f"""{p}cc AS (SELECT * FROM {source} WHERE sv_type <> 'INS'),
{cut},
{p}co AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sv_type, chrom, island ORDER BY s, e, id) AS nr FROM {p}cd),
{p}ch AS (SELECT sv_type, chrom, island, nr, id, s, e, id AS head FROM {p}co WHERE nr = 1
  UNION ALL SELECT sv_type, chrom, island, nr, id, CASE WHEN fits THEN least(s, ns) ELSE ns END, CASE WHEN fits THEN greatest(e, ne) ELSE ne END, CASE WHEN fits THEN head ELSE id END
  FROM (SELECT ch.sv_type, ch.chrom, ch.island, n.nr, n.id, ch.s, ch.e, ch.head, n.s AS ns, n.e AS ne, least(ch.e, n.e) - greatest(ch.s, n.s) > 0 AND least(ch.e, n.e) - greatest(ch.s, n.s) >= 0.5 * greatest(ch.e - ch.s, n.e - n.s) AS fits
    FROM {p}ch ch JOIN {p}co n ON n.sv_type = ch.sv_type AND n.chrom = ch.chrom AND n.island = ch.island AND n.nr = ch.nr + 1))"""
    ins = islands_sql(f"{p}ci", f"{p}cj", "chrom", "s, e, id", "s", "e", ">", f" - {pad}")
    return f"""{chain},
{p}ci AS (SELECT * FROM {source} WHERE sv_type = 'INS'),
{ins},
{p}mf AS MATERIALIZED (SELECT sv_type, chrom, min(s) AS start_pos, max(e) AS end_pos, list(id ORDER BY nr) AS ids FROM {p}ch GROUP BY sv_type, chrom, island, head
  UNION ALL SELECT sv_type, chrom, min(s), max(e), list(id ORDER BY id) FROM {p}cj GROUP BY sv_type, chrom, island)"""


@query(
    "merge_per_type",
    "WITH RECURSIVE x AS (SELECT call_id AS id, sv_type, chrom, CASE WHEN sv_type = 'INS' THEN start_pos - 150 ELSE start_pos END AS s, CASE WHEN sv_type = 'INS' THEN end_pos + 150 ELSE end_pos END AS e FROM calls WHERE sv_type IN ('INS', 'DEL', 'DUP', 'INV')),\n"
    + merge_full_sql("x", 50)
    + " SELECT sv_type, chrom, start_pos, end_pos, array_to_string(ids, ',') AS ids FROM mf",
    ("calls",),
)
def merge_per_type(t: Inputs) -> DataFrame:
    ins = F.col("sv_type") == "INS"
    rows = t.calls.where("sv_type in ('INS', 'DEL', 'DUP', 'INV')").select(F.col("call_id").alias("id"), "sv_type", "chrom", F.when(ins, F.col("start_pos") - 150).otherwise(F.col("start_pos")).alias("start_pos"), F.when(ins, F.col("end_pos") + 150).otherwise(F.col("end_pos")).alias("end_pos"))
    return merge.merge_per_type(rows, pad=50).withColumn("ids", F.array_join("ids", ","))


def padded_insertions(t: Inputs) -> DataFrame:
    return t.calls.where("sv_type = 'INS'").select("call_id", "chrom", "sv_type", "source", "sv_len", (F.col("start_pos") - 150).alias("start_pos"), (F.col("end_pos") + 150).alias("end_pos"))


@query(
    "merge_collapse_ops",
    f"WITH {INS_SQL}, "
    + islands_sql("x", "i", "sv_type, chrom", "start_pos, end_pos, call_id", "start_pos", "end_pos", ">", " - 50")
    + """ SELECT chrom, string_agg(CAST(call_id AS VARCHAR), ',' ORDER BY call_id) AS ids, CAST(sum(sv_len) AS BIGINT) AS total, min(sv_len) AS least, max(sv_len) AS most, first(call_id ORDER BY start_pos, end_pos, call_id) AS first_id,
    last(call_id ORDER BY start_pos, end_pos, call_id) AS last_id, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS n FROM i GROUP BY chrom, island""",
    ("calls",),
)
def merge_collapse_ops(t: Inputs) -> DataFrame:
    marked = merge.merge_by_distance(padded_insertions(t), ["sv_type", "chrom"], "call_id", 50)
    place = F.struct("start_pos", "end_pos", "call_id")
    return marked.groupBy("chrom", "island").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list("call_id")), lambda x: x.cast("string")), ",").alias("ids"), F.sum("sv_len").alias("total"), F.min("sv_len").alias("least"), F.max("sv_len").alias("most"),
        F.min_by("call_id", place).alias("first_id"), F.max_by("call_id", place).alias("last_id"), F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"), F.count("*").alias("n"),
    ).drop("island")


@query(
    "merge_fields",
    f"WITH {INS_SQL}, "
    + islands_sql("x", "i", "sv_type, chrom", "start_pos, end_pos, call_id", "start_pos", "end_pos", ">", " - 50")
    + f""", k AS (SELECT chrom, island, unnest({METHODS_SQL}) AS method FROM i), km AS (SELECT chrom, island, string_agg(DISTINCT method, ';' ORDER BY method) AS methods FROM k GROUP BY chrom, island)
    SELECT chrom, first(call_id ORDER BY start_pos, end_pos, call_id) AS first_id, max(sv_len) AS sv_len, string_agg(DISTINCT source, ',' ORDER BY source) AS tools, any_value(methods) AS methods FROM i JOIN km USING (chrom, island) GROUP BY chrom, island""",
    ("calls",),
)
def merge_fields(t: Inputs) -> DataFrame:
    marked = merge.merge_by_distance(padded_insertions(t), ["sv_type", "chrom"], "call_id", 50)
    merged = marked.groupBy("chrom", "island").agg(F.min_by("call_id", F.struct("start_pos", "end_pos", "call_id")).alias("first_id"), F.max("sv_len").alias("sv_len"), F.array_sort(F.collect_set("source")).alias("tools"))
    return merged.select("chrom", "first_id", "sv_len", F.array_join("tools", ",").alias("tools"), F.array_join(filters.methods_of(F.col("tools")), ";").alias("methods"))


CHAIN_SQL = """WITH RECURSIVE o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sv_type, chrom ORDER BY start_pos, end_pos, call_id) AS nr FROM calls WHERE sv_type IN ('DEL', 'DUP', 'INV')),
f AS (
  SELECT sv_type, chrom, nr, call_id, start_pos AS s, end_pos AS e, call_id AS head FROM o WHERE nr = 1
  UNION ALL
  SELECT o.sv_type, o.chrom, o.nr, o.call_id, CASE WHEN g.fits THEN least(g.s, o.start_pos) ELSE o.start_pos END, CASE WHEN g.fits THEN greatest(g.e, o.end_pos) ELSE o.end_pos END, CASE WHEN g.fits THEN g.head ELSE o.call_id END
  FROM (SELECT f.*, n.start_pos AS ns, n.end_pos AS ne, least(f.e, n.end_pos) - greatest(f.s, n.start_pos) > 0 AND least(f.e, n.end_pos) - greatest(f.s, n.start_pos) >= 0.5 * greatest(f.e - f.s, n.end_pos - n.start_pos) AS fits, n.nr AS nnr
        FROM f JOIN o n ON n.sv_type = f.sv_type AND n.chrom = f.chrom AND n.nr = f.nr + 1) g
  JOIN o ON o.sv_type = g.sv_type AND o.chrom = g.chrom AND o.nr = g.nnr
)
"""


@query("merge_reciprocal_chain", CHAIN_SQL + " SELECT sv_type, chrom, head AS first_id, min(s) AS start_pos, max(e) AS end_pos, count(*) AS n FROM f GROUP BY sv_type, chrom, head", ("calls",))
def merge_reciprocal_chain(t: Inputs) -> DataFrame:
    chains = merge.reciprocal_chains(t.calls.where("sv_type in ('DEL', 'DUP', 'INV')"), ["sv_type", "chrom"])
    return chains.select("sv_type", "chrom", F.element_at("ids", 1).alias("first_id"), "start_pos", "end_pos", F.size("ids").cast("long").alias("n"))


ADJACENT_SQL = f"""WITH RECURSIVE q AS MATERIALIZED (SELECT call_id, sv_type, chrom, start_pos, end_pos, call_id % 4 = 0 AS passed, {METHODS_SQL} AS methods FROM calls WHERE sv_type IN ('DEL', 'DUP')),
o AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY sv_type, chrom ORDER BY start_pos, end_pos, call_id) AS nr FROM q),
f AS (
  SELECT sv_type, chrom, nr, start_pos AS s, end_pos AS e, call_id AS head, passed, methods FROM o WHERE nr = 1
  UNION ALL
  SELECT n.sv_type, n.chrom, n.nr,
    CASE WHEN abs(f.s - n.start_pos) <= 10 AND abs(f.e - n.end_pos) <= 10 THEN least(f.s, n.start_pos) ELSE n.start_pos END,
    CASE WHEN abs(f.s - n.start_pos) <= 10 AND abs(f.e - n.end_pos) <= 10 THEN greatest(f.e, n.end_pos) ELSE n.end_pos END,
    CASE WHEN abs(f.s - n.start_pos) <= 10 AND abs(f.e - n.end_pos) <= 10 THEN f.head ELSE n.call_id END,
    CASE WHEN abs(f.s - n.start_pos) <= 10 AND abs(f.e - n.end_pos) <= 10 THEN f.passed OR n.passed
      OR (NOT list_contains(list_concat(f.methods, n.methods), 'AS') AND len(list_distinct(list_filter(list_concat(f.methods, n.methods), lambda x: x NOT IN ('SC', 'AS')))) > 1) ELSE n.passed END,
    CASE WHEN abs(f.s - n.start_pos) <= 10 AND abs(f.e - n.end_pos) <= 10 THEN list_distinct(list_concat(f.methods, n.methods)) ELSE n.methods END
  FROM f JOIN o n ON n.sv_type = f.sv_type AND n.chrom = f.chrom AND n.nr = f.nr + 1
)
SELECT sv_type, chrom, head AS first_id, last(s ORDER BY nr) AS start_pos, last(e ORDER BY nr) AS end_pos, CAST(count(*) AS INTEGER) AS n_calls, last(passed ORDER BY nr) AS passed FROM f GROUP BY sv_type, chrom, head"""


@query("dedupe_adjacent", ADJACENT_SQL, ("calls",))
def dedupe_adjacent(t: Inputs) -> DataFrame:
    calls = t.calls.where("sv_type in ('DEL', 'DUP')").select("call_id", "sv_type", "chrom", "start_pos", "end_pos", (F.col("call_id") % 4 == 0).alias("passed"), filters.methods_of(F.array("source")).alias("methods"))
    return merge.coalesce_adjacent(calls).drop("methods")


@query("pair_translocations", f"WITH {tx_level1_sql(500)} SELECT id AS l1_id, sv_type, source, chrom, chrom2, s AS start_pos, e AS end_pos, n_calls FROM tx1", ("calls",))
def pair_translocations(t: Inputs) -> DataFrame:
    return merge.pair_translocations(t.calls.withColumn("wiggle", filters.wiggle_of(tx_wiggle=500))).drop("wiggle", "sv_len", "leaves")
