"""Substring dedup: passages of 50 words that recur across documents, removed but for the first.

A window of 50 words is known by its phrase: of the 10-word phrases in it the one with the
least hash (winnowing), which depends on the window's words alone. So all places of a window
share a phrase, and only phrases that stand in two documents need a closer look:

1. every document gives its phrases and a hash of the block of windows that each stands for;
2. phrases of two or more documents recur (a grouped count; a hot phrase is summed before it
   is shuffled). A block that an earlier document has as well goes as a whole, so of many
   copies only the first with a block need look at its windows;
3. documents are dealt to shards of a few megabytes. A shard's recurring phrases are compiled
   into one Aho-Corasick automaton, and all its documents stream through it. The automaton
   says where phrases stand; hashes of the blocks there confirm them. Phrases come to the
   automaton by their keys alone, which spell them: a symbol of 6 bits for each word;
4. where a phrase's blocks differ, the windows themselves are counted by (phrase, window), a key of
   over 120 bits, and each document learns which of its windows an earlier one has.

Phrases that share a key by chance are looked at together and told apart by the hashes of their
blocks and windows.

Cases: a null or empty text, or one of under 50 words, loses nothing; a null doc_id neither
loses words nor counts as earlier; rows of one doc_id are one document, none earlier than the
other; a very long text is one row of its shard, and none is cut; an empty table gives no rows;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, settled, table
from .kernels import _BASE, _INVERSE, Words, arrow_column, join_lists, lists, mix, powers, signed, slices, squeezed, unsqueezed, words_in

WINDOW = 50
PHRASE = 10
#: Bits of a word's symbol; a phrase's key has PHRASE of them.
BITS = 6
#: Bytes of text in a shard.
SHARD_BYTES = 4 << 20


def spelled(key: int) -> str:
    """The symbols of a phrase's key."""
    return "".join(chr(48 + (key >> BITS * i & (1 << BITS) - 1)) for i in range(PHRASE))


class Passages:
    """The phrases and windows of a slice of rows."""

    def __init__(self, w: Words):
        self.row = w.row_of_word()
        self.hashes = w.hashes()
        self.first = w.first
        n = len(self.hashes)
        self.total = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self.hashes * powers(_BASE, n), out=self.total[1:])
        self.symbol = self.hashes >> np.uint64(64 - BITS)
        at = np.arange(max(0, n - PHRASE + 1))
        self.key = np.zeros(len(at), dtype=np.uint64)
        for i in range(PHRASE):
            self.key |= self.symbol[i : i + len(at)] << np.uint64(BITS * i)
        self.rank = mix(self.key)

    def span(self, start: np.ndarray, size: np.ndarray | int) -> np.ndarray:
        return mix((self.total[start + size] - self.total[start]) * powers(_INVERSE, len(self.hashes) + 1)[start])

    def choose(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(place, low, high): where chosen phrases stand, the first and the last window that each stands for."""
        room = max(0, len(self.hashes) - WINDOW + 1)
        at = np.flatnonzero(self.row[:room] == self.row[WINDOW - 1 :]) if room else np.zeros(0, dtype=np.int64)
        if not len(at):
            return at, at, at
        chosen = self._least(WINDOW - PHRASE + 1)[at]
        new = np.flatnonzero(np.append(True, chosen[1:] != chosen[:-1]))
        return chosen[new], at[new], at[np.append(new[1:], len(at)) - 1]

    def _least(self, size: int) -> np.ndarray:
        """Where, of `size` phrases from each place on, the least stands; the last of equal ones."""
        g = self.rank

        def better(a: np.ndarray, shift: int) -> np.ndarray:
            x, y = a[: len(a) - shift], a[shift:]
            return np.where(g[x] < g[y], x, y)

        best, span = np.arange(len(g)), 1
        while 2 * span <= size:
            best, span = better(best, span), 2 * span
        return better(best, size - span) if size > span else best

    def windows_of(self, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The places whose phrase stands for a window, and the first and the last of those windows.

        A window is of the least phrase in it, so windows of a place lie between the lesser phrases
        beside it and the ends of its row.
        """
        reach = WINDOW - PHRASE
        begin, end = self.first[self.row[place]], self.first[self.row[place] + 1] - PHRASE
        beside = place[:, None] + np.arange(1, reach + 1)
        lesser = (self.rank[np.minimum(beside, len(self.rank) - 1)] <= self.rank[place][:, None]) & (beside <= end[:, None])
        after = np.where(lesser.any(1), place + 1 + lesser.argmax(1), end + 1)
        beside = place[:, None] - np.arange(1, reach + 1)
        lesser = (self.rank[np.maximum(beside, 0)] < self.rank[place][:, None]) & (beside >= begin[:, None])
        before = np.where(lesser.any(1), place - 1 - lesser.argmax(1), begin - 1)
        low, high = np.maximum(before + 1, place - reach), np.minimum(place, after - reach - 1)
        some = low <= high
        return place[some], low[some], high[some]

    def blocks(self, place: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """A hash of the words of each block of windows, and of where the phrase stands in it."""
        size = high - low + WINDOW
        return mix(self.span(low, size) + (size * 1024 + place - low).astype(np.uint64))

    def located(self, automaton: ahocorasick.Automaton) -> np.ndarray:
        """Where the automaton's phrases stand."""
        text = (self.symbol + np.uint64(48)).astype(np.uint8).tobytes().decode("latin-1")
        if not text or not len(automaton):
            return np.zeros(0, dtype=np.int64)
        at = np.fromiter((end for end, _ in automaton.iter(text)), dtype=np.int64) - (PHRASE - 1)
        return at[self.row[at] == self.row[at + PHRASE - 1]]


_PHRASES = pa.list_(pa.struct([("phrase", pa.int64()), ("block", pa.int64())]))


@arrow_column(_PHRASES)
def phrases_of(text: pa.Array) -> pa.Array:
    out = []
    for _, _, w in words_in(text):
        p = Passages(w)
        place, low, high = p.choose()
        pairs = pa.StructArray.from_arrays([signed(p.key[place]), signed(p.blocks(place, low, high))], fields=list(_PHRASES.value_type))
        out.append(lists(pairs, np.bincount(p.row[place], minlength=w.rows)))
    return join_lists(out, _PHRASES)


_SPAN = pa.struct([("start", pa.int32()), ("end", pa.int32())])
_WINDOWS = pa.struct([("phrase", pa.int64()), ("window", pa.int64()), ("start", pa.int32())])
_LOCATED = pa.schema([("doc_id", pa.int64()), ("text_key", pa.int64()), ("spans", pa.list_(_SPAN)), ("windows", pa.list_(_WINDOWS))])
LOCATED = "doc_id long, text_key long, spans array<struct<start: int, end: int>>, windows array<struct<phrase: long, window: long, start: int>>"


def automaton_of(phrases: np.ndarray) -> ahocorasick.Automaton:
    """The automaton of the phrases with these keys."""
    automaton = ahocorasick.Automaton()
    for key in phrases.tolist():
        automaton.add_word(spelled(key), key)
    automaton.make_automaton()
    return automaton


def locate(recurring: pa.Table, docs: pa.Table) -> pa.Table:
    """The spans of a shard's documents that an earlier one has for certain, and windows that need counting.

    recurring: doc_id, phrase, block, same, as `recurring_blocks` gives them, of the shard's
    documents; docs: doc_id, text_key and the compressed text, body.
    """
    rule = _Rules(recurring)
    automaton = automaton_of(np.unique(recurring["phrase"].to_numpy()))
    out = []
    keys = docs.select(["of_doc", "text_key"]).combine_chunks()
    body = docs["body"].combine_chunks()
    body = body if isinstance(body, pa.Array) else pa.concat_arrays(body.chunks)
    for first, _, text in unsqueezed(body):
        for at, to, w in words_in(text):
            mine = keys.slice(first + at, to - at)
            ids = mine["of_doc"].combine_chunks().to_numpy(zero_copy_only=False)
            spans, windows = _located(w, ids, rule, automaton)
            found = pa.table([mine["of_doc"].combine_chunks(), mine["text_key"].combine_chunks(), spans, windows], schema=_LOCATED)
            out.append(found.filter(pc.greater(pc.add(pc.list_value_length(spans), pc.list_value_length(windows)), 0)))
    return pa.concat_tables(out) if out else _LOCATED.empty_table()


class _Rules:
    """What becomes of a document's block of a phrase, by one hash of the three."""

    def __init__(self, recurring: pa.Table):
        doc, phrase, block = (recurring[c].to_numpy().view(np.uint64) for c in ("doc_id", "phrase", "block"))
        key = self.key(doc, phrase, block)
        order = np.argsort(key, kind="stable")
        self.keys, self.same = key[order], recurring["same"].to_numpy(zero_copy_only=False).astype(bool)[order]

    @staticmethod
    def key(doc: np.ndarray, phrase: np.ndarray, block: np.ndarray) -> np.ndarray:
        return mix(mix(doc + np.uint64(_BASE)) + mix(phrase) * np.uint64(3) + block)

    def of(self, doc: np.ndarray, phrase: np.ndarray, block: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(whether there is a rule, whether it says that the block goes as a whole)"""
        key = self.key(doc, phrase, block)
        at = np.searchsorted(self.keys, key)
        at[at == len(self.keys)] = 0
        hit = self.keys[at] == key if len(self.keys) else np.zeros(len(key), dtype=bool)
        return hit, hit & self.same[at] if len(self.keys) else hit


def _located(w: Words, ids: np.ndarray, rule: _Rules, automaton: ahocorasick.Automaton) -> tuple[pa.Array, pa.Array]:
    p = Passages(w)
    place, low, high = p.windows_of(p.located(automaton))
    row = p.row[place]
    hit, same = rule.of(ids[row].astype(np.int64).view(np.uint64), p.key[place], p.blocks(place, low, high))
    first = w.first[row]
    a = np.flatnonzero(same)
    spans = pa.StructArray.from_arrays([pa.array((low - first)[a], pa.int32()), pa.array((high - first)[a] + WINDOW, pa.int32())], fields=list(_SPAN))
    b = np.flatnonzero(hit & ~same)
    sizes = (high - low + 1)[b]
    of = np.repeat(b, sizes)
    start = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    windows = pa.StructArray.from_arrays([signed(p.key[place[of]]), signed(p.span(start, WINDOW)), pa.array(start - first[of], pa.int32())], fields=list(_WINDOWS))
    return lists(spans, np.bincount(row[a], minlength=w.rows)), lists(windows, np.bincount(row[of], minlength=w.rows))


def with_key(docs: DataFrame) -> DataFrame:
    """Documents with a key of their text beside the doc_id."""
    return docs.withColumn("text_key", F.xxhash64("text"))


KEY = ["doc_id", "text_key"]


def recurring_blocks(seen: DataFrame) -> DataFrame:
    """`doc_id, phrase, block` of all phrases to `doc_id, phrase, block, same`: what must be located.

    A block that an earlier document has as well is `same`: all its windows go. Otherwise the
    document is the first with this block, and asks for its windows one by one if the phrase
    stands in other blocks too. Counts are settled before they are joined, so that joins may split
    a hot phrase.
    """
    phrases = settled(seen.groupBy("phrase").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), (F.min("block") == F.max("block")).alias("only")).where("first < last").select("phrase", "only"))
    again = settled(seen.join(phrases, "phrase").select("doc_id", "phrase", "block", "only"))
    blocks = settled(again.groupBy("phrase", "block").agg(F.min("doc_id").alias("first")))
    return again.join(blocks, ["phrase", "block"]).withColumn("same", F.col("doc_id") > F.col("first")).where("same or not only").select("doc_id", "phrase", "block", "same")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """`doc_id, text` to `doc_id, text_key, cut`: the spans of words to take out of each text that loses any."""
    keyed = with_key(docs.select("doc_id", "text"))
    read = settled(keyed.where("doc_id is not null").select("doc_id", F.octet_length("text").alias("bytes"), phrases_of("text").alias("p")))
    seen = read.select("doc_id", F.explode("p").alias("p")).select("doc_id", "p.phrase", "p.block")
    shards = max(1, -(-(read.agg(F.sum("bytes")).first()[0] or 0) // SHARD_BYTES))
    shard = lambda key: F.pmod(F.xxhash64(key), F.lit(shards))
    rules = recurring_blocks(seen).withColumn("shard", shard("doc_id"))
    bodies = keyed.where("doc_id is not null").select(F.col("doc_id").alias("of_doc"), "text_key", squeezed("text").alias("body")).withColumn("of_shard", shard("of_doc"))
    located = settled(rules.groupBy("shard").cogroup(bodies.groupBy("of_shard")).applyInArrow(locate, LOCATED))
    windows = located.select(*KEY, F.explode("windows").alias("w")).select(*KEY, "w.*")
    first = settled(windows.groupBy("phrase", "window").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"))
    later = windows.join(first, ["phrase", "window"]).where("doc_id > first").select(*KEY, "start", (F.col("start") + WINDOW).alias("end"))
    spans = located.select(*KEY, F.explode("spans").alias("s")).select(*KEY, "s.*")
    return spans.unionByName(later).groupBy(*KEY).agg(F.collect_set(F.struct("start", "end")).alias("cut"))


_KEPT = pa.struct([("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string())])


def _kept_words(body: bytes, spans: list[tuple[int, int]]) -> tuple[int, list[bytes]]:
    words = body.split()  # of bytes: at 0x20 and 0x09-0x0D alone
    if not spans:
        return len(words), words
    kept, at = [], 0
    for start, end in sorted(spans):
        if start > at:
            kept += words[at:start]
        at = max(at, end)
    return len(words), kept + words[at:]


def _each(text: pa.Array, spans: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(words in all, kept words) of each row."""
    flat = spans.flatten()
    start, end = flat.field("start").to_numpy(), flat.field("end").to_numpy()
    ends = np.cumsum([0, *(n or 0 for n in pc.list_value_length(spans).to_pylist())])
    for at, to, data, offsets in slices(text):
        for i in range(to - at):
            a, b = ends[at + i], ends[at + i + 1]
            yield _kept_words(data[offsets[i] : offsets[i + 1]].tobytes(), list(zip(start[a:b].tolist(), end[a:b].tolist(), strict=True)))


def _digest(rows: Iterator[tuple[int, list[bytes]]]) -> pa.Array:
    found = [(n, n - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()) for n, kept in rows]
    cols = list(zip(*found, strict=True)) or [[], [], []]
    return pa.StructArray.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _KEPT, strict=True)], fields=list(_KEPT))


@arrow_column(_KEPT)
def kept_digest(body: pa.Array, spans: pa.Array) -> pa.Array:
    """Of compressed texts without the words of the spans."""
    return _digest(x for at, to, text in unsqueezed(body) for x in _each(text, spans.slice(at, to - at)))


@arrow_column(pa.string())
def kept_text(text: pa.Array, spans: pa.Array) -> pa.Array:
    return pa.array([b" ".join(kept).decode() for _, kept in _each(text, spans)], pa.string())


def drop_repeated(docs: DataFrame) -> DataFrame:
    """`docs` with the text of kept words, joined by spaces where any were taken out."""
    out = with_key(docs).join(repeated_spans(docs), KEY, "left")
    return out.withColumn("text", F.when(F.col("cut").isNotNull(), kept_text("text", "cut")).otherwise(F.col("text"))).drop("text_key", "cut")


def digests(docs: DataFrame) -> DataFrame:
    """`doc_id, text` to doc_id, n_words, n_removed, kept_sha256."""
    bodies = with_key(docs).select(*KEY, squeezed("text").alias("body"))
    return bodies.join(repeated_spans(docs), KEY, "left").select("doc_id", kept_digest("body", "cut").alias("k")).select("doc_id", "k.*")


def op9_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents").select("doc_id", "text"))


OP9_SQL = f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
win AS (SELECT doc_id, i, md5(array_to_string(ws[i : i + 49], ' ')) AS h FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM d)),
first AS (SELECT h, min(doc_id) AS f FROM win GROUP BY h),
cut AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS pos FROM win JOIN first USING (h) WHERE doc_id > f),
w AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS pos FROM d),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS body FROM w WHERE NOT EXISTS (SELECT 1 FROM cut WHERE cut.doc_id = w.doc_id AND cut.pos = w.pos) GROUP BY doc_id)
SELECT d.doc_id, len(ws) AS n_words, len(ws) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (doc_id)
"""
