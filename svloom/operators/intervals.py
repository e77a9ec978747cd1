"""Interval predicates and interval merging on DataFrames.

Intervals are half open, `chrom, start_pos, end_pos`; two overlap if the greater start lies
before the lesser end. Joins are sweeps, see `sweeps`.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..session import kept
from .sweeps import BLOCK, overlap_join

#: How far before its coordinate a row of `islands` may reach.
SLACK = 10_000


def reciprocal(ratio: float, prefix: str = "b_") -> Column:
    """The overlap covers at least `ratio` of the longer of the two."""
    longer = F.greatest(F.col("end_pos") - F.col("start_pos"), F.col(prefix + "end_pos") - F.col(prefix + "start_pos"))
    return F.col("overlap_bp") >= ratio * longer


def anti_overlap(a: DataFrame, b: DataFrame, id_: str, pad: int = 0, ratio: float | None = None, on: Sequence[str] = ()) -> DataFrame:
    """Rows of `a` that no row of `b` overlaps (reciprocally, if a ratio is given)."""
    met = overlap_join(a, b, pad, on=on)
    if ratio is not None:
        met = met.where(reciprocal(ratio))
    return a.join(met.select(id_).distinct(), id_, "left_anti")


def contained_in(a: DataFrame, dim: DataFrame, pad: int = 0) -> DataFrame:
    """Rows of `a` that with `pad` on each side lie wholly in a contig of `dim(chrom, length)`."""
    fits = (a["chrom"] == dim["chrom"]) & (a["start_pos"] - pad >= 0) & (a["end_pos"] + pad <= dim["length"])
    return a.join(dim, fits, "left_semi")


def islands_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], low: Column, high: Column, touching: bool = False, name: str = "island", gap: int = 0) -> DataFrame:
    """`islands` for keys of few rows, such as the members of one call: a window over each key."""
    w = W.partitionBy(*keys).orderBy(*order)
    reach = F.max(high).over(w.rowsBetween(W.unboundedPreceding, -1)) + gap
    new = (low > reach) if touching else (low >= reach)
    flagged = df.withColumn("_new", F.when(reach.isNull() | new, 1).otherwise(0))
    return flagged.withColumn(name, F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0))).drop("_new")


def islands(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], low: Column, high: Column, touching: bool = False, name: str = "island", gap: int = 0, block: int = BLOCK, slack: int = SLACK) -> DataFrame:
    """Numbers runs of rows that overlap the rows before them, within `keys`, in the given order.

    A row begins a new island if its `low` is at or beyond (beyond, if touching counts) the
    greatest `high` so far plus `gap`.

    The first of `order` is a coordinate, at most `slack` beyond `low`. Rows are dealt to blocks of it, so no task
    sorts a whole key. A row that reaches into later blocks leaves its `high` there as a mark, so each block knows where
    islands begin. The input is read once and kept; only the islands begun in each block are summed up after that.
    """
    held = _marked(df, keys, order, low, high, touching, gap, block, slack)
    return _numbered(held, held, keys, name).drop("_lone")


def lone_and_islands(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], low: Column, high: Column, touching: bool = False, name: str = "island", gap: int = 0, block: int = BLOCK, slack: int = SLACK) -> tuple[DataFrame, DataFrame]:
    """The rows that are islands of their own, as one block by itself shows, and the others with what tells the islands of `islands` apart.

    Where most rows stand alone these need no number, so neither a join nor a shuffle. The others' islands are known by the block
    where they begin and their number there, so only rows that go on with one of an earlier block look it up. A few among the others may be alone, too.
    """
    held = _marked(df, keys, order, low, high, touching, gap, block, slack)
    return held.where("_lone").select(*df.columns), _known(held, held.where(~F.col("_lone")), keys, name).drop("_lone")


def _marked(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], low: Column, high: Column, touching: bool, gap: int, block: int, slack: int) -> DataFrame:
    """Rows with their block, whether they begin an island, the number of islands begun in the block, and whether they are alone in theirs; kept."""
    first = F.col(order[0]) if isinstance(order[0], str) else order[0]
    near = F.when(first - low <= slack, low).when(low.isNotNull(), F.raise_error(F.lit(f"a row begins more than {slack} before its coordinate")).cast("long"))
    own = F.floor(first / block)
    later = F.floor((high + gap + slack) / block)
    # Rows are shuffled with the block alone; what follows from their own columns is worked out where they arrive.
    dealt = df.withColumn("_block", F.explode_outer(F.when(later > own, F.sequence(own, later)).otherwise(F.array(own)))).repartition(*keys, "_block")
    rows = dealt.withColumns({"_low": near, "_high": high, "_mark": F.col("_block") != own})
    w = W.partitionBy(*keys, "_block").orderBy(F.col("_mark").desc(), *order)
    reach = F.max("_high").over(w.rowsBetween(W.unboundedPreceding, -1)) + gap
    rows = rows.withColumn("_new", F.when(F.col("_mark"), 0).when(reach.isNull() | ((F.col("_low") > reach) if touching else (F.col("_low") >= reach)), 1).otherwise(0))
    rows = rows.withColumns({"_within": F.sum("_new").over(w.rowsBetween(W.unboundedPreceding, 0)), "_next": F.lead("_new").over(w)}).where(~F.col("_mark") | F.col("_mark").isNull())
    lone = F.coalesce((F.col("_new") == 1) & (F.coalesce("_next", F.lit(1)) == 1) & (later <= own), F.lit(False))
    return kept(rows.withColumn("_lone", lone).drop("_low", "_high", "_mark", "_next"), "zstd")


def _begun(held: DataFrame, keys: Sequence[str]) -> DataFrame:
    """`_of_key, _of_block, _news`: the islands begun in each block of the marked rows."""
    return held.groupBy(F.struct(*keys).alias("_of_key"), F.col("_block").alias("_of_block")).agg(F.sum("_new").alias("_news"))


def _of_blocks(rows: DataFrame, blocks: DataFrame, keys: Sequence[str]) -> DataFrame:
    return rows.join(blocks, F.struct(*keys).eqNullSafe(F.col("_of_key")) & F.col("_block").eqNullSafe(F.col("_of_block")))


def _known(held: DataFrame, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """`rows`, some of the marked ones `held`, with one number for the block and the place in it where their island begins."""
    at = lambda block, n: F.shiftleft(F.coalesce(block, F.lit(-1 << 30)), 32) + n
    before = W.partitionBy("_of_key").orderBy("_of_block").rowsBetween(W.unboundedPreceding, -1)
    last = F.last(F.when(F.col("_news") > 0, at(F.col("_of_block"), F.col("_news"))), ignorenulls=True).over(before)
    begun = _begun(held, keys).select("_of_key", "_of_block", last.alias(name))
    here = rows.where("_within > 0").withColumn(name, at(F.col("_block"), F.col("_within")))
    return here.unionByName(_of_blocks(rows.where("_within = 0"), begun, keys).drop("_of_key", "_of_block")).drop("_block", "_new", "_within")


def _numbered(held: DataFrame, rows: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """`rows`, some of the marked ones `held`, with the number of their islands."""
    before = W.partitionBy("_of_key").orderBy("_of_block").rowsBetween(W.unboundedPreceding, -1)
    base = _begun(held, keys).select("_of_key", "_of_block", F.coalesce(F.sum("_news").over(before), F.lit(0)).alias("_base"))
    return _of_blocks(rows, base, keys).withColumn(name, F.col("_base") + F.col("_within")).drop("_block", "_new", "_within", "_base", "_of_key", "_of_block")
