"""Merging calls: within a caller, across callers, validation, and the folds that feed on themselves.

Level 1 merges the calls of one type and caller; level 2 the results across callers. A merged
interval carries its members' wiggle in its bounds; a single one keeps raw bounds beside its
wiggle.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, StructField

from .. import constants as C
from ..session import kept, settled
from .filters import caller_rank, is_precise_source, is_translocation, methods_of
from .folds import fold_runs
from .intervals import islands, islands_within, lone_and_islands


def low() -> Column:
    return F.col("start_pos") - F.col("wiggle")


def high() -> Column:
    return F.col("end_pos") + F.col("wiggle")


def _level1(marked: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Runs of calls, numbered by `island` within `keys`, to level-1 intervals. Calls may have `info`, a text of `key=value;..`."""
    info = F.col("info") if "info" in marked.columns else F.lit("")
    leaf = F.struct("start_pos", "end_pos", "call_id", "sv_len", "wiggle", "source", info.alias("info"))
    merged = marked.groupBy(*keys, "island").agg(F.min(low()).alias("low"), F.max(high()).alias("high"), F.max("sv_len").alias("sv_len"), F.count("*").alias("n_calls"), F.array_sort(F.collect_list(leaf)).alias("leaves"))
    first, single = F.element_at("leaves", 1), F.col("n_calls") == 1
    return merged.select(
        first["call_id"].alias("l1_id"),
        *keys,
        F.when(single, first["start_pos"]).otherwise(F.col("low")).alias("start_pos"),
        F.when(single, first["end_pos"]).otherwise(F.col("high")).alias("end_pos"),
        F.when(single, first["wiggle"]).otherwise(0).alias("wiggle"),
        "sv_len",
        "n_calls",
        "leaves",
    )


def _single(calls: DataFrame) -> DataFrame:
    """Calls that nothing joins as level-1 intervals, with the columns of `_level1`."""
    info = F.col("info") if "info" in calls.columns else F.lit("")
    leaf = F.struct("start_pos", "end_pos", "call_id", "sv_len", "wiggle", "source", info.alias("info"))
    return calls.select(F.col("call_id").alias("l1_id"), *TX_KEYS, "start_pos", "end_pos", "wiggle", "sv_len", F.lit(1).cast("long").alias("n_calls"), F.array(leaf).alias("leaves"))


def merge_intra(calls: DataFrame, keys: Sequence[str] = ("sv_type", "source", "chrom")) -> DataFrame:
    """`call_id, start_pos, end_pos, sv_len, wiggle` and keys to level-1 intervals.

    One row per island: l1_id (its first call), bounds, wiggle (0 if merged), sv_len (the
    greatest), n_calls, and `leaves` with the calls' raw bounds. Translocations, which only
    pair up, are left out; see `pair_translocations`.
    """
    rows = calls.where(~is_translocation())
    return _level1(islands(rows, keys, ["start_pos", "end_pos", "call_id"], low(), high()), keys)


def _sites(rows: DataFrame, keys: Sequence[str], id_: str, reach: Column) -> DataFrame:
    """Rows with `site`: cut where starts lie `reach` or more apart, so that what follows looks at neighbours only."""
    return islands(rows, keys, ["start_pos", "end_pos", id_], F.col("start_pos"), F.col("start_pos") + reach, name="site").repartition(*keys, "site")


def _near_runs(rows: DataFrame, keys: Sequence[str], id_: str) -> DataFrame:
    """Rows of sites, which `keys` tell apart, with `run`, `nr` and `n`: runs of rows each near the one before it, and the places in a run, from 0.

    Near is within the wiggle of the row before at both ends.
    """
    site = W.partitionBy(*keys).orderBy("start_pos", "end_pos", id_)
    within = F.lag("wiggle").over(site)
    near = (F.col("start_pos") - F.lag("start_pos").over(site) < within) & (F.abs(F.col("end_pos") - F.lag("end_pos").over(site)) < within)
    rows = rows.withColumn("_near", F.coalesce(near, F.lit(False)))
    rows = rows.withColumn("run", F.sum(F.when(F.col("_near"), 0).otherwise(1)).over(site.rowsBetween(W.unboundedPreceding, 0)))
    run = W.partitionBy(*keys, "run")
    return rows.withColumns({"nr": F.row_number().over(run.orderBy("start_pos", "end_pos", id_)) - 1, "n": F.count("*").over(run)}).drop("_near")


TX_KEYS = ["sv_type", "source", "chrom", "chrom2"]


def pair_translocations(calls: DataFrame) -> DataFrame:
    """ITX and CTX to level-1 intervals: of one caller, consecutive calls whose ends both lie within the wiggle pair up.

    A merged pair has no wiggle left, so it takes up nothing more: within a run of near calls
    the first pairs with the second, the third with the fourth, and so on.
    """
    return _paired(_sites(calls.where(is_translocation()), TX_KEYS, "call_id", F.col("wiggle")))


def _paired(sites: DataFrame) -> DataFrame:
    keys = [*TX_KEYS, "site"]
    runs = _near_runs(sites, keys, "call_id")
    return _level1(runs.withColumn("island", F.floor(F.col("nr") / 2)), [*keys, "run"]).drop("site", "run")


def _several(rows: DataFrame, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(the rows that share their keys with others, with an empty `path`; the links of the others to themselves)"""
    counted = settled(rows.withColumn("_n", F.count("*").over(W.partitionBy(*keys))))
    return counted.where("_n > 1").drop("_n").withColumn("path", F.lit("")), counted.where("_n = 1").select(F.col("id").alias("l1_id"), F.col("id").alias("l2_id"))


def merge_pairs(level1: DataFrame) -> DataFrame:
    """Level-1 translocations to their level-2 interval: `l1_id, l2_id` for each.

    Across callers, too, they merge in pairs. A pair's bounds lie its members' wiggle outside of them, so no
    member fits its own pair; it fits if it is near to one that is left over single. As in `merge_inter`,
    a site that fits gives its pairs, one of which none fits stays as it is, and else both halves go
    through again.
    """
    of = ["sv_type", "chrom", "chrom2"]
    reach = F.array_max(F.transform("leaves", lambda x: x["wiggle"]))
    kept = ["id", *of, "start_pos", "end_pos", "wiggle", "reach", "site"]
    rows = level1.where(is_translocation()).withColumns({"id": F.col("l1_id"), "reach": reach}).select(*kept[:-1])
    rows, done = _several(_sites(rows, of, "id", F.col("reach")), [*of, "site"])
    keys = [*of, "site", "path", "part"]
    while True:
        rows = islands_within(rows, keys[:-1], ["start_pos", "end_pos", "id"], F.col("start_pos"), F.col("start_pos") + F.col("reach"), name="part")
        runs = _near_runs(rows, keys, "id")
        part, pair = W.partitionBy(*keys), W.partitionBy(*keys, "run", F.floor(F.col("nr") / 2)).orderBy("nr")
        single = (F.col("nr") == F.col("n") - 1) & (F.col("n") % 2 == 1) & (F.col("wiggle") > 0)
        runs = runs.withColumn("singles", F.collect_list(F.when(single, F.struct("start_pos", "end_pos"))).over(part))
        near = lambda x: (F.abs(F.col("start_pos") - x["start_pos"]) < F.col("wiggle")) & (F.abs(F.col("end_pos") - x["end_pos"]) < F.col("wiggle"))
        runs = runs.withColumn("fits", F.exists("singles", near))
        runs = runs.withColumns({"n_fit": F.sum(F.when(F.col("fits"), 1).otherwise(0)).over(part), "n_all": F.count("*").over(part), "head": F.first("id").over(pair)})
        judged = settled(runs.drop("singles"))
        out = judged.where("n_fit = n_all or n_fit = 0").select(F.col("id").alias("l1_id"), F.when(F.col("n_fit") > 0, F.col("head")).otherwise(F.col("id")).alias("l2_id"))
        done = done.unionByName(out)
        rows = judged.where("n_fit > 0 and n_fit < n_all").select(*kept, F.concat("path", F.when(F.col("fits"), "g").otherwise("b")).alias("path"))
        if rows.isEmpty():
            return done


def _round(rows: DataFrame, ratio: float) -> DataFrame:
    """One round of `merge_inter` over rows with `component` and `path`: `part` of these, its islands, and whether a row fits its own.

    All windows are within a component, by which rows are dealt, so nothing is shuffled.
    """
    of = [*COMPONENT, "path"]
    order = ["start_pos", "end_pos", "id"]
    rows = islands_within(rows, of, [low(), *order], low(), high(), touching=True, name="part")
    inner = [*of, "part"]
    rows = islands_within(rows, inner, order, low(), high(), name="stretch")
    # Touching intervals without wiggle also merge: the next island begins where the last one, merged, ended.
    stretch, along = W.partitionBy(*inner, "stretch"), W.partitionBy(*inner).orderBy("stretch", *order)
    rows = rows.withColumns({"size": F.count("*").over(stretch), "first_wiggle": F.first("wiggle").over(stretch.orderBy(*order)), "reach": F.max(high()).over(stretch)})
    heads = F.coalesce(F.lag("stretch").over(along) != F.col("stretch"), F.lit(True))
    touches = (F.col("wiggle") == 0) & (F.col("start_pos") == F.lag("reach").over(along)) & (F.col("end_pos") > F.col("start_pos")) & ((F.lag("size").over(along) > 1) | (F.lag("first_wiggle").over(along) == 0))
    rows = rows.withColumn("begins", heads & ~F.coalesce(touches, F.lit(False))).withColumn("island", F.sum(F.when(F.col("begins"), 1).otherwise(0)).over(along.rowsBetween(W.unboundedPreceding, 0)))
    isle = W.partitionBy(*inner, "island")
    rows = rows.withColumns({"low": F.min(low()).over(isle), "high": F.max(high()).over(isle), "size": F.count("*").over(isle)})
    own = high() - low()
    alone = F.col("size") == 1
    fits = (own >= 1) & (alone | (own >= ratio * (F.col("high") - F.col("low"))))
    whole = W.partitionBy(*inner)
    rows = rows.withColumns({"fits": fits, "head": F.first("id").over(isle.orderBy(*order))})
    return rows.withColumns({"n_fit": F.sum(F.when(F.col("fits"), 1).otherwise(0)).over(whole), "n_all": F.count("*").over(whole)})


COMPONENT = ["sv_type", "chrom", "component"]


def merge_inter(level1: DataFrame, ratio: float = C.OVERLAP_RATIO) -> DataFrame:
    """Level-1 intervals, no translocations, to their level-2 interval: `l1_id, l2_id` for each.

    A component whose intervals all fit the islands they merge into gives these islands; if
    none fits, each stays for itself; else it is divided by fit and both halves go through
    again, each smaller than before, until all are done. Components are cut once and dealt to tasks, see `_rounds`.
    """
    rows = level1.where(~is_translocation())
    lone, others = lone_and_islands(rows, COMPONENT[:2], [low(), "start_pos", "end_pos", "l1_id"], low(), high(), touching=True, name="component")
    merged = _rounds(others.repartition(*COMPONENT), ratio, lambda m: m.select(*COMPONENT, "path", "l2_id", "open", "items"))
    return lone.select("l1_id", F.col("l1_id").alias("l2_id")).unionByName(merged.select(F.explode("items.l1_id").alias("l1_id"), "l2_id"))


def _rounds(level1: DataFrame, ratio: float, row: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Level-1 intervals, dealt by component, to level-2 intervals.

    A round is a few windows within components, and what it merges is grouped where it lies. The intervals bring all that
    a level-2 interval needs, so nothing is joined back. Each round is kept in the shared folder, and the next one reads the unfinished
    intervals from there; only whether there are any comes to the driver. row: what is kept, of a table of COMPONENT,
    path, l2_id, `open` (unfinished, one item) and the columns that `_level2_rows` reads.
    """
    item = F.struct("start_pos", "end_pos", "l1_id", "wiggle", "sv_len", "source", "n_calls", "leaves")
    rows, done = level1.withColumn("path", F.lit("")), None
    while True:
        judged = _round(rows.withColumn("id", F.col("l1_id")), ratio)
        unfinished = (F.col("n_fit") > 0) & (F.col("n_fit") < F.col("n_all"))
        path = F.when(unfinished, F.concat("path", F.when(F.col("fits"), "g").otherwise("b"))).otherwise(F.col("path"))
        judged = judged.withColumns({"open": unfinished, "path": path, "l2_id": F.when(F.col("n_fit") == F.col("n_all"), F.col("head")).otherwise(F.col("id"))})
        merged = judged.groupBy(*COMPONENT, "path", "l2_id", "open").agg(F.array_sort(F.collect_list(item)).alias("items"), F.min(low()).alias("low"), F.max(high()).alias("high"), F.max("sv_len").alias("sv_len"), F.array_sort(F.collect_set("source")).alias("sources"))
        held = kept(row(merged.withColumn("chrom2", F.col("chrom"))), "zstd")
        out = held.where(~F.col("open"))
        done = out if done is None else done.unionByName(out)
        rows = held.where("open").select(*COMPONENT, "path", F.inline("items")).repartition(*COMPONENT)
        if held.where("open").isEmpty():
            return done


def level1_of(calls: DataFrame) -> DataFrame:
    """The level-1 intervals of all types, with chrom2: what `merge_intra` and `pair_translocations` give, cut by one pass over the calls."""
    plain, tx = _level1_parts(calls)
    return plain.unionByName(tx)


def _level1_parts(calls: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The level-1 intervals of types with two ends on one chromosome, and translocations; calls that nothing joins are neither numbered nor grouped."""
    tx, keys = is_translocation(), [*TX_KEYS[:3], "_pair"]
    rows = calls.withColumn("_pair", F.when(tx, F.col("chrom2")))
    begin, end = F.when(tx, F.col("start_pos")).otherwise(low()), F.when(tx, F.col("start_pos") + F.col("wiggle")).otherwise(high())
    lone, cut = lone_and_islands(rows, keys, ["start_pos", "end_pos", "call_id"], begin, end)
    merged = _level1(cut.where(~tx), TX_KEYS[:3]).withColumn("chrom2", F.col("chrom"))
    plain = _single(lone.where(~tx).withColumn("chrom2", F.col("chrom"))).unionByName(merged)
    return plain, _single(lone.where(tx)).unionByName(_paired(cut.where(tx).withColumnRenamed("island", "site")))


def level2_of(calls: DataFrame, ratio: float = C.OVERLAP_RATIO) -> DataFrame:
    """Calls with wiggle to their level-2 intervals, of all types; kept in the shared folder.

    Whatever merges, in either level, lies in one run of touching intervals, so calls are dealt once, by place. Most meet no other
    of their type: each of these is its own level-2 interval, without a group or join. The other runs are dealt to tasks, which merge them in both levels.
    """
    tx = is_translocation()
    info = ["info"] if "info" in calls.columns else []
    # A translocation's end lies elsewhere: it meets what begins within the wiggle.
    rows = calls.where("sv_type is not null").select("call_id", "sv_type", "chrom", F.when(tx, F.col("chrom2")).alias("_pair"), "source", "start_pos", "end_pos", "wiggle", "sv_len", *info)
    reach = F.when(tx, F.col("start_pos") + F.col("wiggle")).otherwise(high())
    lone, others = lone_and_islands(rows, ["sv_type", "chrom", "_pair"], [low(), "start_pos", "end_pos", "call_id"], low(), reach, touching=True, name="component")
    level1 = islands_within(others.where(~tx).drop("_pair").repartition(*COMPONENT), [*COMPONENT, "source"], ["start_pos", "end_pos", "call_id"], low(), high())
    plain = _rounds(_level1(level1, [*COMPONENT, "source"]), ratio, _finished)
    pairs = kept(_paired(others.where(tx).withColumnsRenamed({"_pair": "chrom2", "component": "site"})), "zstd")
    several = plain.select(*LEVEL2).unionByName(kept(level2(pairs, merge_pairs(pairs)).select(*LEVEL2), "zstd"))
    return _lone_level2(lone.withColumn("chrom2", F.when(tx, F.col("_pair")).otherwise(F.col("chrom")))).unionByName(several)


LEVEL2 = ["l2_id", "sv_type", "chrom", "chrom2", "start_pos", "end_pos", "leaf_start", "leaf_end", "n_calls", "n_level1", "sv_len", "sources", "members"]


def _finished(merged: DataFrame) -> DataFrame:
    """What a round keeps: level-2 intervals, and of unfinished ones the items instead of members."""
    open_ = F.col("open")
    rows = _level2_rows(merged, "component", "path", "open", "items")
    return rows.withColumns({"items": F.when(open_, F.col("items")), **{c: F.when(~open_, F.col(c)) for c in ("leaf_start", "leaf_end", "sources", "members")}})


def _lone_level2(calls: DataFrame) -> DataFrame:
    """Calls that meet no other as level-2 intervals."""
    one = F.lit(1)
    return calls.select(F.col("call_id").alias("l2_id"), *LEVEL2[1:6], F.col("start_pos").alias("leaf_start"), F.col("end_pos").alias("leaf_end"), one.alias("n_calls"), one.alias("n_level1"), "sv_len", F.array("source").alias("sources"), _no_members().alias("members"))


def _no_members() -> Column:
    return F.array().cast("array<struct<start:bigint,end:bigint,wiggle:int,len:bigint,source:string,info:string>>")


def level2(level1: DataFrame, links: DataFrame) -> DataFrame:
    """One row per level-2 interval: bounds, length, sources, and its members in order.

    A member is {start, end, wiggle, len, source, info}: the first level-1 interval gives its
    calls, each later one is a member itself, without info if it is merged. A level-2 interval of
    one unmerged call has none.
    """
    rows = level1.join(links, "l1_id")
    item = F.struct("start_pos", "end_pos", "l1_id", "wiggle", "sv_len", "source", "n_calls", "leaves")
    merged = rows.groupBy("l2_id", "sv_type", "chrom").agg(F.array_sort(F.collect_list(item)).alias("items"), F.min(low()).alias("low"), F.max(high()).alias("high"), F.max("sv_len").alias("sv_len"), F.array_sort(F.collect_set("source")).alias("sources"), F.max("chrom2").alias("chrom2"))
    return _level2_rows(merged)


def _level2_rows(merged: DataFrame, *more: str) -> DataFrame:
    first = F.element_at("items", 1)
    member = lambda x, info: F.struct(x["start_pos"].alias("start"), x["end_pos"].alias("end"), x["wiggle"].cast("int").alias("wiggle"), x["sv_len"].alias("len"), x["source"].alias("source"), info.alias("info"))
    own = F.transform(first["leaves"], lambda x: member(x, x["info"]))
    later = F.transform(F.slice("items", F.lit(2), F.size("items")), lambda x: member(x, F.when(x["n_calls"] == 1, x["leaves"][0]["info"]).otherwise("")))
    alone = (F.size("items") == 1) & (first["n_calls"] == 1)
    every = F.flatten(F.transform("items", lambda x: x["leaves"]))
    return merged.select(
        "l2_id",
        "sv_type",
        "chrom",
        "chrom2",
        F.when(F.size("items") == 1, first["start_pos"]).otherwise(F.col("low")).alias("start_pos"),
        F.when(F.size("items") == 1, first["end_pos"]).otherwise(F.col("high")).alias("end_pos"),
        F.array_min(F.transform(every, lambda x: x["start_pos"])).alias("leaf_start"),
        F.array_max(F.transform(every, lambda x: x["end_pos"])).alias("leaf_end"),
        F.size(every).alias("n_calls"),
        F.size("items").alias("n_level1"),
        "sv_len",
        "sources",
        F.when(alone, _no_members()).otherwise(F.concat(own, later)).alias("members"),
        *more,
    )


def precise_islands(members: DataFrame) -> DataFrame:
    """The merge of each call's precise members: `l2_id, low, high` of each island, wiggle included, and its size; none of translocations."""
    precise = members.where(is_precise_source(F.col("source")) & ~is_translocation())
    marked = islands_within(precise, ["l2_id"], ["start_pos", "end_pos", "source"], low(), high())
    return marked.groupBy("l2_id", "island").agg(F.min(low()).alias("low"), F.max(high()).alias("high"), F.count("*").alias("size"))


def member_rows(calls: DataFrame) -> DataFrame:
    return calls.select("l2_id", "sv_type", F.col("leaf_start").alias("call_start"), F.col("leaf_end").alias("call_end"), F.explode("members").alias("m")).select(
        "l2_id", "sv_type", "call_start", "call_end", F.col("m.start").alias("start_pos"), F.col("m.end").alias("end_pos"), F.col("m.wiggle").alias("wiggle"), F.col("m.len").alias("sv_len"), F.col("m.source").alias("source")
    )


def _good(begin: Column, end: Column, ratio: float) -> Column:
    """A member, with wiggle, overlaps [begin, end) reciprocally."""
    common = F.least(high(), end) - F.greatest(low(), begin)
    return (common >= 1) & (common >= ratio * F.greatest(high() - low(), end - begin))


def validate_calls(calls: DataFrame, ratio: float = C.OVERLAP_RATIO) -> DataFrame:
    """Level-2 calls to their verdict: is_validated, is_precise, `by` (the deciding member), bounds of the calls.

    The first caller in order of trust decides that has exactly one member, if this
    reciprocally overlaps the call or an island of its precise members. A translocation's bounds
    lie outside of its members', so there the first precise caller with exactly one decides. The calls are read several times,
    as `level2_of` keeps them.
    """
    alone = F.size("members") == 0
    whole = calls.where(~alone)
    members = member_rows(whole)
    per_source = W.partitionBy("l2_id", "source")
    single = members.withColumn("n", F.count("*").over(per_source)).where("n = 1")
    precise = precise_islands(members).groupBy("l2_id").agg(F.collect_list(F.struct("low", "high")).alias("islands"))
    single = single.join(precise, "l2_id", "left")
    near = F.exists(F.coalesce("islands", F.array().cast("array<struct<low:bigint,high:bigint>>")), lambda x: _good(x["low"], x["high"], ratio))
    deciding = single.where(F.when(is_translocation(), is_precise_source(F.col("source"))).otherwise(_good(F.col("call_start"), F.col("call_end"), ratio) | near))
    chosen = deciding.groupBy("l2_id").agg(F.min_by(F.struct("source", "start_pos", "end_pos", "sv_len"), caller_rank(F.col("source"))).alias("by"))
    lengths = members.where("sv_len > 0").groupBy("l2_id").agg(F.min_by("sv_len", F.struct(caller_rank(F.col("source")), "start_pos", "end_pos", "sv_len")).alias("some_len"))
    out = whole.join(chosen, "l2_id", "left").join(lengths, "l2_id", "left")
    plain = calls.where(alone).withColumns({"by": F.lit(None).cast(out.schema["by"].dataType), "some_len": F.lit(None).cast("long")})  # one call, no members: nothing to join
    out = plain.unionByName(out)
    validated = ~alone & F.col("by").isNotNull() & (F.size("sources") > 1)
    precise_flag = F.when(alone, is_precise_source(F.element_at("sources", 1))).otherwise(F.coalesce(is_precise_source(F.col("by.source")), F.lit(False)))
    return out.withColumns({"is_validated": validated, "is_precise": precise_flag, "start_pos": F.col("leaf_start"), "end_pos": F.col("leaf_end")}).drop("leaf_start", "leaf_end")


def snap_precise(validated: DataFrame) -> DataFrame:
    """Validated precise calls take bounds and length of the deciding member; a length of 0 that of the first caller with one."""
    snap = F.col("is_validated") & F.col("is_precise")
    length = F.when(F.col("by.sv_len") != 0, F.col("by.sv_len")).otherwise(F.coalesce("some_len", F.col("by.sv_len")))
    return validated.withColumns({"start_pos": F.when(snap, F.col("by.start_pos")).otherwise(F.col("start_pos")), "end_pos": F.when(snap, F.col("by.end_pos")).otherwise(F.col("end_pos")), "sv_len": F.when(snap, length).otherwise(F.col("sv_len"))}).drop("by", "some_len")


def consolidated(calls: DataFrame, ratio: float = C.OVERLAP_RATIO) -> DataFrame:
    """Calls with wiggle to the final call set: merged, validated, snapped."""
    return snap_precise(validate_calls(level2_of(calls, ratio), ratio))


def merge_by_distance(df: DataFrame, keys: Sequence[str], id_: str, overlap: int, touching: bool = True) -> DataFrame:
    """Numbers islands of rows that overlap what is before them by `overlap` bases at least."""
    return islands(df, keys, ["start_pos", "end_pos", id_], F.col("start_pos"), F.col("end_pos"), touching=touching, gap=-overlap)


def reciprocal_chains(df: DataFrame, keys: Sequence[str], ratio: float = C.OVERLAP_RATIO) -> DataFrame:
    """Sorted intervals join the chain before them while they reciprocally overlap the whole chain.

    The chain's bounds decide, so this is a fold: rows are cut into islands of overlapping
    intervals, which no chain crosses, and each island streams through a fold of its own. One row per chain:
    keys, start_pos, end_pos, ids.
    """
    return _chains(islands(df, keys, ["start_pos", "end_pos", "call_id"], F.col("start_pos"), F.col("end_pos")), keys, ratio)


def _chains(marked: DataFrame, keys: Sequence[str], ratio: float) -> DataFrame:
    def begin(x: dict) -> dict:
        return {"start_pos": x["start_pos"], "end_pos": x["end_pos"], "ids": [x["call_id"]]}

    def add(chain: dict, x: dict) -> bool:
        common = min(chain["end_pos"], x["end_pos"]) - max(chain["start_pos"], x["start_pos"])
        longer = max(chain["end_pos"] - chain["start_pos"], x["end_pos"] - x["start_pos"])
        if common <= 0 or common < ratio * longer:
            return False
        chain["start_pos"], chain["end_pos"] = min(chain["start_pos"], x["start_pos"]), max(chain["end_pos"], x["end_pos"])
        chain["ids"].append(x["call_id"])
        return True

    fields = [marked.schema["start_pos"], marked.schema["end_pos"], StructField("ids", ArrayType(marked.schema["call_id"].dataType))]
    return fold_runs(marked.select(*keys, "island", "start_pos", "end_pos", "call_id"), [*keys, "island"], ["start_pos", "end_pos", "call_id"], keys, begin, add, fields)


def merge_per_type(intervals: DataFrame, ratio: float = C.OVERLAP_RATIO, pad: int = C.SC_PAD) -> DataFrame:
    """`id, sv_type, chrom, start_pos, end_pos` to keys, bounds, and ids of the members: insertions merge by distance, types with two ends by reciprocal chains.

    The intervals are read once and cut into islands of both kinds in one pass; those that are alone in theirs are neither folded nor grouped.
    An id may be a struct that carries more of a member.
    """
    keys, ins = ["sv_type", "chrom"], F.col("sv_type") == "INS"
    rows = intervals.where("sv_type is not null").select("id", *keys, "start_pos", "end_pos")
    # Positions are whole numbers, so that a chain's next island begins at its end or beyond: beyond its last base.
    lone, cut = lone_and_islands(rows, keys, ["start_pos", "end_pos", "id"], F.col("start_pos"), F.col("end_pos") - F.when(ins, pad).otherwise(1), touching=True)
    chains = _chains(cut.where(~ins).withColumnRenamed("id", "call_id"), keys, ratio)
    merged = cut.where(ins).groupBy(*keys, "island").agg(F.min("start_pos").alias("start_pos"), F.max("end_pos").alias("end_pos"), F.array_sort(F.collect_list("id")).alias("ids")).drop("island")
    return lone.select(*keys, "start_pos", "end_pos", F.array("id").alias("ids")).unionByName(chains).unionByName(merged)


def coalesce_adjacent(df: DataFrame, near: int = 10) -> DataFrame:
    """Consecutive calls of a type with both ends within `near` of the merged ones so far become one.

    `call_id, chrom, sv_type, start_pos, end_pos, passed, methods` to one row per run with
    least start, greatest end, n_calls and passed: one passed, or it has more than one method
    besides soft clips and assembly and none by assembly.
    """
    keys = ["sv_type", "chrom"]
    # Starts only grow, so calls whose start is farther than `near` from the last one's can't share a run.
    marked = islands(df, keys, ["start_pos", "end_pos", "call_id"], F.col("start_pos"), F.col("start_pos") + near, touching=True, name="_cut")

    def begin(x: dict) -> dict:
        return {"start_pos": x["start_pos"], "end_pos": x["end_pos"], "first_id": x["call_id"], "n_calls": 1, "passed": x["passed"], "methods": x["methods"]}

    def add(run: dict, x: dict) -> bool:
        if abs(run["start_pos"] - x["start_pos"]) > near or abs(run["end_pos"] - x["end_pos"]) > near:
            return False
        both = set(run["methods"]) | set(x["methods"])
        agreed = "AS" not in both and len(both - {"SC"}) > 1
        run |= {"start_pos": min(run["start_pos"], x["start_pos"]), "end_pos": max(run["end_pos"], x["end_pos"]), "n_calls": run["n_calls"] + 1, "passed": run["passed"] or x["passed"] or agreed, "methods": sorted(both)}
        return True

    fields = [df.schema["start_pos"], df.schema["end_pos"], StructField("first_id", df.schema["call_id"].dataType), StructField("n_calls", IntegerType()), StructField("passed", BooleanType()), df.schema["methods"]]
    return fold_runs(marked.select(*keys, "_cut", "start_pos", "end_pos", "call_id", "passed", "methods"), [*keys, "_cut"], ["start_pos", "end_pos", "call_id"], keys, begin, add, fields)


def call_stats(validated: DataFrame) -> DataFrame:
    """How many calls there are of each type, verdict, precision and set of callers."""
    return validated.groupBy("sv_type", F.when(F.col("is_validated"), "PASS").otherwise("LowQual").alias("filter"), F.when(F.col("is_precise"), "PRECISE").otherwise("IMPRECISE").alias("precision"), F.concat_ws(",", "sources").alias("sources")).count().withColumnRenamed("count", "n")


def _info_union(members: Column) -> Column:
    """The members' `key=value` parts, one for each key; that of a later member wins."""
    parts = lambda m: F.filter(F.split(F.coalesce(m["info"], F.lit("")), ";"), lambda x: x != "")
    key = lambda x: F.substring_index(x, "=", 1)

    def add(have: Column, m: Column) -> Column:
        return F.concat(F.filter(have, lambda x: ~F.array_contains(F.transform(parts(m), key), key(x))), parts(m))

    return F.array_join(F.array_sort(F.aggregate(members, F.array().cast("array<string>"), add)), ";")


def info_merge(calls: DataFrame) -> DataFrame:
    """A merged call's INFO: the union of its members', SOURCES with each member, and the numbers of methods and callers."""
    member = lambda m: F.concat_ws("-", F.col("chrom"), m["start"].cast("string"), F.col("chrom2"), m["end"].cast("string"), m["len"].cast("string"), m["source"])
    return calls.where(F.size("members") > 0).select("l2_id", F.array_join(F.array_sort(F.transform("members", member)), ",").alias("sources_text"), F.size(methods_of(F.col("sources"))).alias("num_svmethods"), F.size("sources").alias("num_svtools"), _info_union(F.col("members")).alias("info"))
