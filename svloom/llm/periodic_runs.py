"""Periodic run detection: stretches of a text whose words repeat with a period three times or more.

A run is a stretch of words with smallest period q, at least `max(24, 3 * q)` long, that no
neighbouring word extends. Each text is searched by internal pattern matching, whole:

1. prefix doubling names all blocks of 2**k words (two have one name if their words are equal) and
   gives a suffix array; a block's occurrences are an interval of it;
2. a wavelet tree over the suffix array answers range successors: the next place at or after a
   given one within such an interval;
3. every dyadic block (2**k words, from a multiple of 2**k on) asks for its occurrences among the
   next 2**(k+1) places. A run of period q, 2**k <= q < 2**(k+1), holds such a block that occurs
   again q words on (for q < 8 a block of 8 does);
4. occurrences nearer than half a block form an arithmetic progression, whose difference is the
   block's period. Its first and last member stand for all: between two progressions only the
   distances of their first and of their last members can be periods;
5. each candidate is extended to both sides by comparing names of blocks, and is kept if it is
   long enough; of candidates with the same bounds the smallest period counts.

Work is n log n for n words, whatever repeats, and memory as well: a text is one row, and no
row needs another, so nothing is shuffled. Short texts go through in slices together, each ended
by a symbol of its own.

Cases: a null or empty text, or one of under 24 words, has no run; equal rows are judged each;
a null doc_id is a row like others, undamaged by the query; an empty table gives no rows; other
columns are ignored. Words are compared by 64-bit hashes.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import n_words, table
from .kernels import arrow_column, join_lists, lists, slices, words_in

LEAST = 24
TIMES = 3
#: The smallest dyadic blocks have 2**LOWEST words.
LOWEST = 3


class Names:
    """Names of all blocks of 2**k symbols, k from 0 to `top`: how many suffixes begin with a lesser block."""

    def __init__(self, symbols: np.ndarray, top: int):
        n = len(symbols)
        order = np.argsort(symbols, kind="stable")
        rank = np.empty(n, dtype=np.int64)
        rank[order] = self._first(symbols[order])
        self.levels = [rank]
        for k in range(top):
            rank = rank.copy()
            many = np.flatnonzero(np.bincount(rank, minlength=n)[rank] > 1)  # the others' names stay
            after = many + (1 << k)
            key = rank[many] * (n + 1) + np.where(after < n, rank[np.minimum(after, n - 1)] + 1, 0)
            order = np.argsort(key, kind="stable")
            old = rank[many[order]]
            rank[many[order]] = old + self._first(key[order]) - self._first(old)
            self.levels.append(rank)

    @staticmethod
    def _first(values: np.ndarray) -> np.ndarray:
        """Of sorted values: where the first one equal to each stands."""
        new = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, dtype=np.int64)
        return np.repeat(new, np.diff(np.append(new, len(values))))

    def suffixes(self) -> np.ndarray:
        return np.argsort(self.levels[-1], kind="stable")

    def forward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols from i on equal those from j on, i < j."""
        return self._common(i, j, lambda at, size: at)

    def backward(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many symbols up to i, and i's, equal those up to j."""
        return self._common(i, j, lambda at, size: at - size + 1, -1)

    def _common(self, i: np.ndarray, j: np.ndarray, begin, step: int = 1) -> np.ndarray:
        length = np.zeros(len(i), dtype=np.int64)
        n = len(self.levels[0])

        def grow(k: int, of: np.ndarray) -> np.ndarray:
            a, b = begin(i[of] + step * length[of], 1 << k), begin(j[of] + step * length[of], 1 << k)
            inside = (a >= 0) & (b < n)
            same = inside & (self.levels[k][np.maximum(a, 0)] == self.levels[k][np.minimum(b, n - 1)])
            length[of[same]] += 1 << k
            return of[same]

        left = np.arange(len(i))
        while len(left):
            left = grow(len(self.levels) - 1, left)
        every = np.arange(len(i))
        for k in reversed(range(len(self.levels) - 1)):
            grow(k, every)
        return length


class WaveletTree:
    """Values from 0 to len - 1, by bits from the highest: each level keeps how many zeros stand before each place."""

    def __init__(self, values: np.ndarray):
        self.bits = max(1, int(len(values)).bit_length())
        self.zeros = []
        for bit in reversed(range(self.bits)):
            one = (values >> bit & 1).astype(bool)
            before = np.zeros(len(values) + 1, dtype=np.int32)
            np.cumsum(~one, out=before[1:])
            self.zeros.append(before)
            values = np.concatenate([values[~one], values[one]])

    def successor(self, low: np.ndarray, high: np.ndarray, least: np.ndarray) -> np.ndarray:
        """The smallest value of at least `least` at places low to high - 1, or -1."""
        rank = self._lesser(low, high, least)
        some = rank < high - low
        out = np.full(len(low), -1, dtype=np.int64)
        out[some] = self._nth(low[some], high[some], rank[some])
        return out

    def _lesser(self, low: np.ndarray, high: np.ndarray, bound: np.ndarray) -> np.ndarray:
        count = np.zeros(len(low), dtype=np.int64)
        for bit, before in zip(reversed(range(self.bits)), self.zeros, strict=True):
            a, b = before[low], before[high]
            one = (bound >> bit & 1).astype(bool)
            count += np.where(one, b - a, 0)
            low, high = np.where(one, before[-1] + low - a, a), np.where(one, before[-1] + high - b, b)
        return count

    def _nth(self, low: np.ndarray, high: np.ndarray, nth: np.ndarray) -> np.ndarray:
        value = np.zeros(len(low), dtype=np.int64)
        for bit, before in zip(reversed(range(self.bits)), self.zeros, strict=True):
            a, b = before[low], before[high]
            one = nth >= b - a
            value |= one.astype(np.int64) << bit
            nth = np.where(one, nth - (b - a), nth)
            low, high = np.where(one, before[-1] + low - a, a), np.where(one, before[-1] + high - b, b)
        return value


@dataclass
class Runs:
    """Runs of some rows, sorted by row, start and period."""

    row: np.ndarray
    start: np.ndarray
    length: np.ndarray
    period: np.ndarray


def runs_in(hashes: np.ndarray, counts: np.ndarray) -> Runs:
    """The runs of rows of so many words each."""
    none = np.zeros(0, dtype=np.int64)
    if not len(counts) or counts.max() < LEAST:
        return Runs(none, none, none, none)
    first = np.cumsum(counts + 1) - counts - 1  # a row's first place, when each row ends with a symbol of its own
    symbols = np.zeros(int((counts + 1).sum()), dtype=np.int64)
    kinds = np.unique(hashes, return_inverse=True)[1]
    ends = first + counts
    word = np.ones(len(symbols), dtype=bool)
    word[ends] = False
    symbols[word] = kinds
    symbols[ends] = len(hashes) + np.arange(len(counts))
    top = max(LOWEST, int(counts.max() // TIMES).bit_length() - 1)
    names = Names(symbols, top)
    tree = None
    found = []
    for k in range(LOWEST, top + 1):
        size = 1 << k
        deep = np.flatnonzero(counts >= (LEAST if k == LOWEST else TIMES * size))
        n = counts[deep] // size
        block = np.repeat(first[deep], n) + size * (np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
        many = np.bincount(names.levels[k], minlength=len(symbols))
        block = block[many[names.levels[k][block]] > 1]
        if len(block):
            tree = tree or WaveletTree(names.suffixes())
            found.append(_candidates(names, tree, many, block, k))
    if not found:
        return Runs(none, none, none, none)
    return _extended(names, np.concatenate([x[0] for x in found]), np.concatenate([x[1] for x in found]), first)


def _candidates(names: Names, tree: WaveletTree, many: np.ndarray, block: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(block, distance) of what its occurrences in the next 2**(k+1) places leave as periods."""
    size, name = 1 << k, names.levels[k]

    def following(at: np.ndarray) -> np.ndarray:
        return tree.successor(name[at], name[at] + many[name[at]], at + 1)

    def progression(at: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The last member of the progression that `at` belongs to, and its difference, or 0 if it stands alone."""
        step = np.where((after >= 0) & (after - at <= size // 2), after - at, 0)
        last = at.copy()
        of = np.flatnonzero(step)
        end = at[of] + step[of] + names.forward(at[of], after[of])
        last[of] = at[of] + step[of] * ((end - at[of] - size) // step[of])
        return last, step

    after = following(block)
    near = (after >= 0) & (after < block + 2 * size)
    block, after = block[near], after[near]
    own_last, own_step = progression(block, after)
    out = [(block[own_step > 0], own_step[own_step > 0])]
    at, last, of = block, own_last, np.arange(len(block))
    while len(of):
        nxt = np.where(last > at, following(last), after) if at is block else following(last)
        near = (nxt >= 0) & (nxt < block[of] + 2 * size)
        of, at = of[near], nxt[near]
        last, step = progression(at, following(at))
        mine = block[of]
        out.append((mine, last - own_last[of]))
        step = np.maximum(step, own_step[of])
        p = np.flatnonzero(step)
        back = names.backward(mine[p] - 1, mine[p] + step[p] - 1)
        out.append((mine[p], at[p] - (mine[p] - step[p] * (back // step[p]))))
        out.append((mine, at - mine))
    return np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out])


def _extended(names: Names, at: np.ndarray, period: np.ndarray, first: np.ndarray) -> Runs:
    """Candidates to runs."""
    pairs = np.unique(np.stack([at, period], 1)[period > 0], axis=0)
    at, period = pairs[:, 0], pairs[:, 1]
    left = names.backward(at - 1, at + period - 1)
    start, length = at - left, left + period + names.forward(at, at + period)
    keep = length >= np.maximum(LEAST, TIMES * period)
    start, length, period = start[keep], length[keep], period[keep]
    order = np.lexsort((period, length, start))
    start, length, period = start[order], length[order], period[order]
    new = np.append(True, (start[1:] != start[:-1]) | (length[1:] != length[:-1])) if len(start) else np.zeros(0, dtype=bool)
    start, length, period = start[new], length[new], period[new]
    order = np.lexsort((period, start))
    start, length, period = start[order], length[order], period[order]
    row = np.searchsorted(first, start, side="right") - 1
    return Runs(row, start - first[row], length, period)


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


@arrow_column(pa.list_(_RUN))
def runs_of(text: pa.Array) -> pa.Array:
    """Each text's runs {start, length, period} in words, by start, then period."""
    out = []
    for _, _, w in words_in(text):
        r = runs_in(w.hashes(), w.counts())
        values = pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in (r.start, r.length, r.period)], fields=list(_RUN))
        out.append(lists(values, np.bincount(r.row, minlength=w.rows)))
    return join_lists(out, pa.list_(_RUN))


@arrow_column(pa.string())
def collapsed(text: pa.Array, runs: pa.Array) -> pa.Array:
    """Each text's words but those of runs after their first period, joined by one space."""
    out, values = [], runs.flatten()
    start, length, period = (values.field(c).to_numpy() for c in ("start", "length", "period"))
    ends = np.cumsum(np.append(0, pc.fill_null(pc.list_value_length(runs), 0).to_numpy()))
    for at, to, data, offsets in slices(text):
        for i in range(to - at):
            words = data[offsets[i] : offsets[i + 1]].tobytes().split()  # of bytes: at 0x20 and 0x09-0x0D alone
            of = slice(ends[at + i], ends[at + i + 1])
            if of.stop > of.start:
                edge = np.zeros(len(words) + 1, dtype=np.int64)
                np.add.at(edge, (start + period)[of], 1)
                np.add.at(edge, (start + length)[of], -1)
                words = [words[x] for x in np.flatnonzero(np.cumsum(edge[:-1]) == 0)]
            out.append(b" ".join(words).decode())
    return pa.array(out, pa.string())


@arrow_column(pa.string())
def repeated_tail(text: pa.Array, start: pa.Array, period: pa.Array) -> pa.Array:
    """Texts whose words from `start` on repeat the first `period` of them; a text without a start stays."""
    out = []
    start, period = start.to_pylist(), period.to_pylist()
    for at, to, data, offsets in slices(text):
        for i in range(to - at):
            body = data[offsets[i] : offsets[i + 1]].tobytes()
            a, p = start[at + i], period[at + i]
            if a is not None:
                words = body.split()
                body = b" ".join([*words[:a], *(words[a + x % p] for x in range(len(words) - a))])
            out.append(body.decode())
    return pa.array(out, pa.string())


def with_runs(docs: DataFrame) -> DataFrame:
    """`docs` with `runs` of their text, and `collapsed_text`."""
    return docs.withColumn("runs", runs_of("text")).withColumn("collapsed_text", collapsed("text", "runs"))


def damaged(docs: DataFrame) -> DataFrame:
    """`doc_id, text`: of a tenth of the ids, the text's end made periodic."""
    h = F.crc32(F.col("doc_id").cast("string"))
    n, g = F.col("_n"), F.floor(h / 10).cast("long")
    chosen = (h % 10 == 0) & (n > 0)
    start = F.when(chosen, g % n)
    period = F.when(chosen, 1 + F.floor((n - start) / (TIMES + g % 8)).cast("long"))
    rows = docs.select("doc_id", "text", n_words(F.col("text")).alias("_n"))
    return rows.select("doc_id", repeated_tail("text", start, period).alias("text"))


def digests(found: DataFrame) -> DataFrame:
    """`doc_id, runs, collapsed_text` to the run with the greatest exponent, and digests."""
    more = lambda a, b: a["length"] * b["period"] > b["length"] * a["period"]
    nothing = F.lit(None).cast("struct<start:bigint,length:bigint,period:bigint>")
    best: Column = F.aggregate("runs", nothing, lambda a, x: F.when(a.isNull() | more(x, a), x).otherwise(a))
    line = lambda x: F.concat(x["start"].cast("string"), F.lit(","), x["length"].cast("string"), F.lit(","), x["period"].cast("string"), F.lit("\n"))
    rows = found.select("doc_id", "runs", best.alias("best"), F.sha2("collapsed_text", 256).alias("collapsed_sha256"))
    return rows.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[F.col(f"best.{c}").alias(c) for c in ("start", "length", "period")],
        F.expr("1000 * best.length div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(with_runs(damaged(table(spark, sf_dir, "documents"))))
