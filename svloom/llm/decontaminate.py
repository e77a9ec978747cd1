"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

Words are lower-cased runs of letters and digits. A first pass over the documents counts in how
many of them each 3-gram of the benchmark stands; an item's seeds are its grams that are rare
in the corpus. (An item of which many grams are frequent, be it that it is leaked often, keeps
all of them: what an edited copy has left of it may be the frequent ones.) A second pass looks
up the seeds. Where two of an item stand on about the same diagonal, the words of that passage
are aligned with the item. The score (match 2, mismatch and gap -1) over the score of a whole
copy is 1 for an exact copy and falls with each edit. A passage with too few of the item's words
for the least score, however they are aligned, is not aligned.

The items are the query set. Their grams reach the tasks by broadcast, in blocks of at most
`block_grams` (an item of more is a block of its own); a larger benchmark takes more lookups.

Cases: null or empty texts, and items of under three words, match nothing; repeated rows of a
doc_id give one result, and so do rows of a null doc_id, but each row is judged by itself in the
pipeline's stage; equal items each match; a very long text is searched whole; either table may
be empty; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table
from .kernels import NOT_ALNUM, arrow_column, join_lists, lists, signed, windows, words_in

GRAM = 3
#: How far the diagonals of one passage may lie apart, and how many words around it are aligned.
SLACK = 8

_ITEM = pa.struct([("words", pa.list_(pa.int64())), ("grams", pa.list_(pa.int64()))])


def _tokens(text: pa.Array):
    return words_in(pc.utf8_lower(text.cast(pa.large_string())), between=NOT_ALNUM)


@arrow_column(_ITEM)
def item_grams(text: pa.Array) -> pa.Array:
    out = []
    for _, _, w in _tokens(text):
        hashes, row = w.hashes(), w.row_of_word()
        grams, at = windows(hashes, row, GRAM)
        out.append(pa.StructArray.from_arrays([lists(signed(hashes), w.counts()), lists(signed(grams), np.bincount(row[at], minlength=w.rows))], fields=list(_ITEM)))
    return join_lists(out, _ITEM)


_LEAKS = pa.list_(pa.struct([("item_id", pa.int64()), ("start", pa.int32()), ("score", pa.float64())]))


class Lookup:
    """The grams of a block of items, sorted, with the items and places of each."""

    def __init__(self, items: list, min_score: float, min_seeds: int, frequent: np.ndarray, min_rare: float):
        """frequent: grams that are no seeds, but of items with less than min_rare other grams."""
        grams = [np.array(r["grams"], dtype=np.int64) for r in items]
        rare = [~np.isin(g, frequent) for g in grams]
        places = [np.flatnonzero(x if x.mean() >= min_rare else np.ones(len(x), dtype=bool)) for x in rare]
        gram = np.concatenate([g[p] for g, p in zip(grams, places, strict=True)] or [np.zeros(0, dtype=np.int64)]).view(np.uint64)
        order = np.argsort(gram, kind="stable")
        self.item = np.repeat(np.arange(len(items)), [len(p) for p in places])[order]
        self.place = np.concatenate(places or [np.zeros(0, dtype=np.int64)])[order]
        self.ids = np.array([r["item_id"] for r in items], dtype=np.int64)
        self.words = [np.array(r["words"], dtype=np.int64).view(np.uint64) for r in items]
        self.seeds = [min(min_seeds, len(np.unique(g[p]))) for g, p in zip(grams, places, strict=True)]
        self.min_score = min_score
        self.grams, self.first, self.count = np.unique(gram[order], return_index=True, return_counts=True)

    def find(self, grams: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which of `grams` are known, and the index of each among the known."""
        if not len(self.grams):
            none = np.zeros(0, dtype=np.int64)
            return none, none
        at = np.searchsorted(self.grams, grams)
        at[at == len(self.grams)] = 0
        hit = np.flatnonzero(self.grams[at] == grams)
        return hit, at[hit]

    def leaks(self, w, hashes: np.ndarray, row: np.ndarray, grams: np.ndarray, at: np.ndarray) -> list:
        """For each row the passages (item_id, start, score) that reach the least score."""
        hit, known = self.find(grams)
        found = [[] for _ in range(w.rows)]
        if not len(hit):
            return found
        n = self.count[known]
        of = np.repeat(np.arange(len(hit)), n)
        entry = np.repeat(self.first[known], n) + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
        r, item, diagonal = row[at[hit[of]]], self.item[entry], at[hit[of]] - self.place[entry]
        order = np.lexsort((diagonal, item, r))
        r, item, diagonal, gram = r[order], item[order], diagonal[order], known[of][order]
        new = np.flatnonzero(np.append(True, (r[1:] != r[:-1]) | (item[1:] != item[:-1]) | (diagonal[1:] - diagonal[:-1] > SLACK)))
        for a, b in zip(new, np.append(new[1:], len(r)), strict=True):
            if len(np.unique(gram[a:b])) < self.seeds[item[a]]:
                continue
            words = self.words[item[a]]
            first, last = w.first[r[a]], w.first[r[a] + 1]
            low, high = max(first, diagonal[a] - SLACK), min(last, diagonal[b - 1] + len(words) + SLACK)
            if np.isin(words, hashes[low:high]).mean() < self.min_score:
                continue
            score = align(hashes[low:high], words)
            if score >= self.min_score:
                found[r[a]].append({"item_id": int(self.ids[item[a]]), "start": int(low - first), "score": score})
        return found


def align(words: np.ndarray, item: np.ndarray) -> float:
    """Smith-Waterman score of an item in a passage, as a share of a whole copy's."""
    if not len(words) or not len(item):
        return 0.0
    step = np.arange(len(words))
    above = np.zeros(len(words) + 1, dtype=np.int64)
    best = 0
    for x in item:
        here = np.maximum(np.maximum(above[:-1] + np.where(words == x, 2, -1), above[1:] - 1), 0)
        here = np.maximum.accumulate(here + step) - step  # gaps in the item
        above[1:] = here
        best = max(best, int(here.max()))
    return best / (2 * len(item))


def finder(held: Broadcast) -> Callable:
    """The column function that finds each text's leaked passages."""

    @arrow_column(_LEAKS)
    def find(text: pa.Array) -> pa.Array:
        out = []
        for _, _, w in _tokens(text):
            hashes, row = w.hashes(), w.row_of_word()
            grams, at = windows(hashes, row, GRAM)
            out.append(pa.array(held.value.leaks(w, hashes, row, grams, at), _LEAKS))
        return join_lists(out, _LEAKS)

    return find


def counter(held: Broadcast) -> Callable:
    """The column function that finds which of the benchmark's grams each text has."""

    @arrow_column(pa.list_(pa.int64()))
    def known_grams(text: pa.Array) -> pa.Array:
        out = []
        for _, _, w in _tokens(text):
            grams, at = windows(w.hashes(), w.row_of_word(), GRAM)
            place = np.searchsorted(held.value, grams)
            place[place == len(held.value)] = 0
            hit = held.value[place] == grams
            row, gram = w.row_of_word()[at[hit]], grams[hit]
            order = np.lexsort((gram, row))
            row, gram = row[order], gram[order]
            new = np.append(np.ones(min(1, len(row)), dtype=bool), (row[1:] != row[:-1]) | (gram[1:] != gram[:-1]))
            out.append(lists(signed(gram[new]), np.bincount(row[new], minlength=w.rows)))
        return join_lists(out, pa.list_(pa.int64()))

    return known_grams


def item_blocks(known: DataFrame, block_grams: int) -> int:
    """Into how many blocks items go by a hash, so that none has more grams than said; one item may have."""
    n, total = known.agg(F.count("*"), F.sum(F.size("grams"))).first()
    blocks = max(1, math.ceil((total or 0) / block_grams))
    while blocks < 4 * n and known.groupBy(F.pmod(F.xxhash64("item_id"), F.lit(blocks)).alias("block")).agg(F.sum(F.size("grams")).alias("s"), F.count("*").alias("n")).where((F.col("s") > block_grams) & (F.col("n") > 1)).count():
        blocks *= 2
    return blocks


def with_leaks(docs: DataFrame, items: DataFrame, min_score: float = 0.5, min_seeds: int = 2, block_grams: int = 1_000_000, rare_docs: int = 100, rare_share: float = 1e-3, min_rare: float = 0.8) -> DataFrame:
    """`docs` with `leaks`: the passages (item_id, start, score) of each text that hold an item.

    A gram is frequent if over rare_docs and over rare_share of all documents have it. min_rare: the share
    of an item's grams that must be rare for the others to be left out.
    """
    spark = docs.sparkSession
    known = settled(items.select("item_id", item_grams("text").alias("g")).select("item_id", "g.*").where(F.size("grams") > 0))
    blocks = item_blocks(known, block_grams)
    limit = max(rare_docs, rare_share * docs.count())
    found = []
    for block in range(blocks):
        mine = known.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).collect()
        if mine:
            grams = np.unique(np.array([g for r in mine for g in r["grams"]], dtype=np.int64).view(np.uint64))
            seen = docs.select(F.explode(counter(spark.sparkContext.broadcast(grams))("text")).alias("gram")).groupBy("gram").count()
            frequent = np.array([r["gram"] for r in seen.where(F.col("count") > limit).select("gram").collect()], dtype=np.int64)
            found.append(finder(spark.sparkContext.broadcast(Lookup(mine, min_score, min_seeds, frequent, min_rare)))("text"))
    return docs.withColumn("leaks", F.concat(*found) if found else F.array().cast("array<struct<item_id:bigint,start:int,score:double>>"))


def leaks(docs: DataFrame, items: DataFrame, **options: object) -> DataFrame:
    """`doc_id, text` and `item_id, text` to doc_id, item_id, score, start_word: one row per leaked item of a document."""
    found = with_leaks(docs.select("doc_id", "text"), items, **options).select("doc_id", F.explode("leaks").alias("p")).select("doc_id", "p.*")
    best = found.groupBy("doc_id", "item_id").agg(F.max(F.struct("score", (-F.col("start")).alias("back"))).alias("m"))
    return best.select("doc_id", "item_id", F.round("m.score", 6).alias("score"), (-F.col("m.back")).alias("start_word"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents without a leaked item; each is judged where it is, without a shuffle."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    return with_leaks(docs, table(spark, sf_dir, "benchmark")).where(F.size("leaks") == 0).drop("leaks")
