"""Coordinate sweeps: joins and counts of intervals by one pass over sorted rows.

Rows of both sides are dealt to blocks of a coordinate (`chrom`, the keys, `start // block`), an interval
to each block that it touches. A partition holds whole blocks, sorted by start, and one pass over it
keeps an active set: the intervals that are open where the sweep stands. What arrives meets what is open, so
work is that of sorting and of the pairs that there are, however dense a block is, and memory is that of
the open intervals and an Arrow batch.

Of two intervals that overlap, the one that starts later starts inside the other. It is new in one block
only, so a pair is found once, and no second listing or `distinct` is needed.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

#: Bases of a block. Intervals that are longer are listed in several.
BLOCK = 1 << 20


def dealt(df: DataFrame, low: Column, high: Column, block: int, reach: int = 0) -> DataFrame:
    """`df` under each block that it touches, widened by `reach` to the left: `_block`, `_low`, `_high`. Empty intervals go."""
    rows = df.withColumns({"_low": low.cast("long"), "_high": high.cast("long")}).where("_low < _high")
    first, last = F.floor((F.col("_low") - reach) / block), F.floor((F.col("_high") - 1) / block)
    return rows.withColumn("_block", F.explode(F.sequence(first, last)))


def segments(batch: pa.RecordBatch, keys: Sequence[str], previous: tuple | None) -> Iterator[tuple[bool, tuple, pa.RecordBatch]]:
    """(whether it begins a block, its key, rows) of runs of equal keys."""
    if not len(batch):
        return
    new = np.zeros(len(batch), dtype=bool)
    for c in keys:
        a = batch[c]
        new[1:] |= pc.fill_null(pc.not_equal(a.slice(1), a.slice(0, len(a) - 1)), True).to_numpy(zero_copy_only=False)
    at = [0, *np.flatnonzero(new).tolist(), len(batch)]
    for begin, end in zip(at, at[1:], strict=False):
        key = tuple(batch[c][begin].as_py() for c in keys)
        yield key != previous, key, batch.slice(begin, end - begin)
        previous = key


class Open:
    """The intervals of one side that are open, and their payload."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.low = self.high = np.zeros(0, dtype=np.int64)
        self.rows: pa.Array | None = None

    def close(self, at: int) -> None:
        """Without those that end at or before a place."""
        keep = self.high > at
        if not keep.all():
            self.low, self.high = self.low[keep], self.high[keep]
            self.rows = self.rows.take(pa.array(np.flatnonzero(keep)))

    def add(self, low: np.ndarray, high: np.ndarray, rows: pa.Array) -> None:
        self.low, self.high = np.concatenate([self.low, low]), np.concatenate([self.high, high])
        self.rows = rows if self.rows is None else pa.concat_arrays([self.rows, rows])


def inside(low: np.ndarray, high: np.ndarray, points: np.ndarray, strictly: bool) -> tuple[np.ndarray, np.ndarray]:
    """(interval, point) pairs of sorted points in [low, high), or in (low, high)."""
    begin = np.searchsorted(points, low, side="right" if strictly else "left")
    n = np.maximum(0, np.searchsorted(points, high, side="left") - begin)
    return np.repeat(np.arange(len(low)), n), np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())


def _by_keys(batch: pa.RecordBatch, keys: Sequence[str]) -> pa.RecordBatch:
    """The rows of equal keys together, as they follow one another."""
    code = np.zeros(len(batch), dtype=np.int64)
    for c in keys:
        found = batch[c].dictionary_encode()
        code = np.unique(code * len(found.dictionary) + found.indices.to_numpy(), return_inverse=True)[1]
    return batch if (np.diff(code) >= 0).all() else batch.take(pa.array(np.argsort(code, kind="stable")))


def _swept(keys: Sequence[str], block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # What is open in the blocks where the sweep stands, by keys and block: rows come by place, whatever their keys.
        open_: dict[tuple, tuple[Open, Open]] = {}
        for batch in batches:
            if not len(batch):
                continue
            reached = batch[keys[-1]][-1].as_py()
            for _, key, rows in segments(_by_keys(batch, keys), keys, None):
                a, b = open_.setdefault(key, (Open(), Open()))
                low, high = rows["_low"].to_numpy(), rows["_high"].to_numpy()
                of_a = pc.is_valid(rows["a"]).to_numpy(zero_copy_only=False)
                parts = []
                for side, name, mine in ((a, "a", of_a), (b, "b", ~of_a)):
                    at = np.flatnonzero(mine)
                    side.close(low[0])
                    side.before = len(side.low)
                    if len(at):
                        side.add(low[at], high[at], rows[name].take(pa.array(at)))
                    new = side.low[side.before :]
                    parts.append((side, side.before + int(np.searchsorted(new, key[-1] * block))))  # those that start in an earlier block are not new here
                (_, new_a), (_, new_b) = parts
                i, j = inside(a.low, a.high, b.low[new_b:], strictly=False)
                k, m = inside(b.low, b.high, a.low[new_a:], strictly=True)
                left, right = np.concatenate([i, m + new_a]), np.concatenate([j + new_b, k])
                if len(left):
                    common = np.minimum(a.high[left], b.high[right]) - np.maximum(a.low[left], b.low[right])
                    columns = [*(pa.repeat(rows[c][0], len(left)) for c in keys[:-1]), *a.rows.take(pa.array(left)).flatten(), *b.rows.take(pa.array(right)).flatten(), pa.array(common)]
                    yield pa.record_batch(columns, names=[f"_{n}" for n in range(len(columns))])
            open_ = {key: sides for key, sides in open_.items() if key[-1] >= reached - 1}  # the last place of a block is also where the next one's earlier rows stand

    return sweep


def _keyed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows of which no key is null; the others meet nothing."""
    return df.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in keys]))


def overlap_join(a: DataFrame, b: DataFrame, pad: int | Column = 0, prefix: str = "b_", on: Sequence[str] = (), block: int = BLOCK) -> DataFrame:
    """Pairs of rows that overlap, `a` widened by `pad` on each side.

    Columns of `b` get the prefix, and `overlap_bp` tells the common length. `on` names more
    columns that must be equal. `pad` may be a column of `a`. Rows whose chrom, keys or ends are null meet none.
    """
    pad = F.lit(pad) if isinstance(pad, int) else pad
    keys = ["chrom", *on]
    # The keys go along once for a row, not in what it brings too.
    kind_a, kind_b = (StructType([f for f in df.schema.fields if f.name not in keys]) for df in (a, b))

    def side(df: DataFrame, pad: Column, row_a: Column, row_b: Column) -> DataFrame:
        rows = df.select(*keys, (F.col("start_pos") - pad).alias("_from"), (F.col("end_pos") + pad).alias("_to"), row_a.alias("a"), row_b.alias("b"))
        return dealt(_keyed(rows, keys), F.col("_from"), F.col("_to"), block).drop("_from", "_to")

    left = side(a, pad, F.struct(*kind_a.names), F.lit(None).cast(kind_b))
    rows = left.unionByName(side(b, F.lit(0), F.lit(None).cast(kind_a), F.struct(*kind_b.names)))
    # One whole number to sort by: the place where the sweep meets a row, which for all that begin earlier is right before the block. Texts in the order would be compared row by row.
    rows = rows.repartition(*keys, "_block").withColumn("_at", F.greatest(F.col("_low"), F.col("_block") * block - 1)).sortWithinPartitions("_at").drop("_at")
    found = [*[(c, rows.schema[c].dataType) for c in keys], *[("a " + f.name, f.dataType) for f in kind_a.fields], *[("b " + f.name, f.dataType) for f in kind_b.fields], ("overlap_bp", LongType())]
    out = rows.mapInArrow(_swept([*keys, "_block"], block), StructType([StructField(f"_{n}", kind) for n, (_, kind) in enumerate(found)]))
    at = {name: F.col(f"_{n}") for n, (name, _) in enumerate(found)}
    of = lambda df, side, c: at[c].cast(df.schema[c].dataType) if c in keys else at[f"{side} {c}"]
    return out.select(*[of(a, "a", c).alias(c) for c in a.columns], *[of(b, "b", c).alias(prefix + c) for c in b.columns], at["overlap_bp"].alias("overlap_bp"))


#: Bases of a block whose intervals are held as two sorted arrays of ends.
COUNTED = 1 << 19


def _as_events(intervals: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Where intervals begin and end, each sorted: the places at which a running count goes up and down."""
    return tuple(np.sort(intervals[c].to_numpy()) for c in ("_low", "_high"))


def _counted(ids: Sequence[str], schema: pa.Schema, block: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def count(key: tuple, queries: pa.Table, intervals: pa.Table) -> pa.Table:
        up, down = _as_events(intervals)
        low, high = queries["_low"].to_numpy(), queries["_high"].to_numpy()
        begin = key[-1].as_py() * block
        # What begins before the query ends, without what has ended where it begins, or, in its later blocks, without what began before.
        gone = np.where(low >= begin, np.searchsorted(down, low, side="right"), np.searchsorted(up, begin, side="left"))
        n = np.searchsorted(up, np.minimum(high, begin + block), side="left") - gone
        return pa.table([*(queries[c] for c in ids), pa.array(n, pa.int64())], schema=schema)

    return count


def overlap_counts(queries: DataFrame, intervals: DataFrame, ids: Sequence[str], on: Sequence[str] = (), block: int = COUNTED) -> DataFrame:
    """`ids, n`: how many intervals each query overlaps, by differences of running counts; no pair is formed.

    Both have chrom, start_pos, end_pos and the columns of `on`, which must be equal. A row for every query that isn't empty and has no null among these.
    """
    keys = ["chrom", *on]
    held = dict.fromkeys([*keys, *ids])
    left = dealt(_keyed(queries, keys), F.col("start_pos"), F.col("end_pos"), block).select(*held, "_block", "_low", "_high")
    right = dealt(_keyed(intervals, keys), F.col("start_pos"), F.col("end_pos"), block).select(*keys, "_block", "_low", "_high")
    schema = StructType([*[left.schema[c] for c in ids], StructField("n", LongType())])
    met = left.groupBy(*keys, "_block").cogroup(right.groupBy(*keys, "_block")).applyInArrow(_counted(ids, to_arrow_schema(schema), block), schema)
    return met.groupBy(*ids).agg(F.sum("n").alias("n"))


_BINS = pa.schema([("call_id", pa.int64()), ("first", pa.int64()), ("n", pa.list_(pa.int64())), ("good", pa.list_(pa.int64()))])


def _binned(step: int, block: int) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def count(key: tuple, calls: pa.Table, reads: pa.Table) -> pa.Table:
        begin = key[-1].as_py() * block
        low, high = calls["_low"].to_numpy(), calls["_high"].to_numpy()
        first = np.maximum(0, -((low - begin) // step))  # this block's bins of a call: those that begin in it
        n = np.maximum(0, -((low - np.minimum(high, begin + block)) // step) - first)
        at = np.repeat(low + step * first, n) + step * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        ends = pa.array(np.append(0, np.cumsum(n)), pa.int32())
        lists = []
        for rows in (reads, reads.filter(reads["good"])):
            up, down = _as_events(rows)
            lists.append(pa.ListArray.from_arrays(ends, pa.array(np.searchsorted(up, at + step, side="left") - np.searchsorted(down, at, side="right"), pa.int64())))
        return pa.table([calls["call_id"].combine_chunks(), pa.array(first, pa.int64()), *lists], schema=_BINS).filter(pa.array(n > 0))

    return count


def bin_counts(calls: DataFrame, reads: DataFrame, step: int, block: int = COUNTED) -> DataFrame:
    """`call_id, n, good`: for each call the reads (with a flag `good`) that touch each of its bins of `step` bases, in order."""
    left = dealt(_keyed(calls, ["chrom"]), F.col("start_pos"), F.col("end_pos"), block).select("call_id", "chrom", "_block", "_low", "_high")
    right = dealt(_keyed(reads, ["chrom"]), F.col("start_pos"), F.col("end_pos"), block, reach=step).select("chrom", "_block", "_low", "_high", "good")
    parts = left.groupBy("chrom", "_block").cogroup(right.groupBy("chrom", "_block")).applyInArrow(_binned(step, block), "call_id long, first long, n array<long>, good array<long>")
    whole = parts.groupBy("call_id").agg(F.array_sort(F.collect_list(F.struct("first", "n", "good"))).alias("p"))
    return whole.select("call_id", F.flatten("p.n").alias("n"), F.flatten("p.good").alias("good"))


def _summed(place: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], ids: Sequence[str], weights: Sequence[str], block: int, schema: pa.Schema) -> Callable[[tuple, pa.Table, pa.Table], pa.Table]:
    def count(key: tuple, queries: pa.Table, intervals: pa.Table) -> pa.Table:
        begin = key[-1].as_py() * block
        points, first = place(queries)
        here = (points >= begin) & (points < begin + block)
        columns = [queries[c] for c in ids]
        ends = [intervals[c].to_numpy() for c in ("_low", "_high")]
        orders = [np.argsort(e, kind="stable") for e in ends]
        # What begins at or before a point, less what has ended there.
        up, down = (np.searchsorted(e[o], points, side="right") for e, o in zip(ends, orders, strict=True))
        for c in weights:
            w = intervals[c].to_numpy()
            grown, gone = (np.concatenate([[0], np.cumsum(w[o])]) for o in orders)
            n = np.where(here, grown[up] - gone[down], 0)
            columns += [pa.array(part.sum(1), pa.int64()) for part in (n[:, :first], n[:, first:])]
        return pa.table(columns, schema=schema)

    return count


def point_sums(queries: DataFrame, intervals: DataFrame, ids: Sequence[str], weights: Sequence[str], place: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]], block: int = COUNTED) -> DataFrame:
    """`ids` and, of each weight `w`, `w_1` and `w_2`: its sums over the intervals that hold a query's points, of two kinds; no pair is formed.

    place: a table of queries to their points, a row of a matrix each, and how many of these are of the first kind; all lie in the
    query's own interval. Weights are whole numbers, not null. A row for every query that isn't empty and has no null chrom or ends.
    """
    left = dealt(_keyed(queries, ["chrom"]), F.col("start_pos"), F.col("end_pos"), block)
    right = dealt(_keyed(intervals, ["chrom"]), F.col("start_pos"), F.col("end_pos"), block).select("chrom", "_block", "_low", "_high", *[F.col(w).cast("long") for w in weights])
    sums = [f"{w}_{k}" for w in weights for k in (1, 2)]
    schema = StructType([*[left.schema[c] for c in ids], *[StructField(c, LongType()) for c in sums]])
    met = left.groupBy("chrom", "_block").cogroup(right.groupBy("chrom", "_block")).applyInArrow(_summed(place, ids, weights, block, to_arrow_schema(schema)), schema)
    return met.groupBy(*ids).agg(*[F.sum(c).alias(c) for c in sums])
