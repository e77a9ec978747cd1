"""Quality rules: cross-document line frequency, beside per-document limits.

Lines are normalised to their lower-cased words and hashed. For each host, a line's
frequency is the number of distinct documents of the host with it (exact copies of a
document count once). Lines above the limit (in over 5 and over a twentieth of a host's documents) are
taken out, and a document of which too little stays (30 % of its words) is rejected as depleted.

Cases: a null or empty text has no words and fails the base rule; a null host is a host of
its own; repeated rows count once as documents and are each judged, rows of a null or repeated doc_id by
their own text; a very long text is one more document; an empty table gives no rows; other
columns are ignored. The query takes `source` for the host.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, settled, table
from .kernels import _BASE, _INVERSE, Words, arrow_column, join_lists, lists, mix, per_row, powers, signed, squeezed, unsqueezed, windows, words_in

_SYMBOL = np.zeros(256, dtype=bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True

_WORDS = re.compile(WORD)

REPEAT_WINDOW = 5


def repeated_words(w: Words, hashes: np.ndarray) -> np.ndarray:
    """For each row, its words that stand in a window found twice or more in the row."""
    row = w.row_of_word()
    found, at = windows(hashes, row, REPEAT_WINDOW)
    order = np.lexsort((found, row[at]))
    a, b = found[order], row[at][order]
    same = (a[1:] == a[:-1]) & (b[1:] == b[:-1])
    twice = np.zeros(len(a), dtype=bool)
    twice[1:] |= same
    twice[:-1] |= same
    edges = np.zeros(len(hashes) + 1, dtype=np.int64)
    begins = at[order][twice]
    np.add.at(edges, begins, 1)
    np.add.at(edges, begins + REPEAT_WINDOW, -1)
    return per_row(np.cumsum(edges[:-1]) > 0, w.first)


def line_hashes(w: Words, hashes: np.ndarray, raw: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, row, number of words) of each line that has a word.

    raw: by the line's bytes; else by its sequence of words.
    """
    if not len(hashes):
        none = np.zeros(0, dtype=np.int64)
        return none.view(np.uint64), none, none
    row = w.row_of_word()
    breaks = np.flatnonzero(w.data == 10)
    line = np.searchsorted(breaks, w.starts)
    new = np.flatnonzero(np.concatenate(([True], (line[1:] != line[:-1]) | (row[1:] != row[:-1]))))
    counts = np.diff(np.append(new, len(hashes)))
    if raw:
        begin = np.maximum(np.concatenate(([0], breaks + 1))[line[new]], w.offsets[row[new]])
        end = np.minimum(np.append(breaks, len(w.data))[line[new]], w.offsets[row[new] + 1])
        return Words(w.data, w.offsets, begin, end, w.first).hashes(), row[new], counts
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_BASE, len(hashes)), out=total[1:])
    return mix((total[new + counts] - total[new]) * powers(_INVERSE, len(hashes) + 1)[new]), row[new], counts


_STATS = pa.struct([("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()), ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64())])


@arrow_column(_STATS)
def text_stats(text: pa.Array) -> pa.Array:
    out = []
    for _, _, w in words_in(text):
        hashes = w.hashes()
        lines, row, _ = line_hashes(w, hashes, raw=True)
        order = np.lexsort((lines, row))
        a, b = lines[order], row[order]
        again = np.bincount(b[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])], minlength=w.rows)
        cols = [w.counts(), per_row(~_SPACE[w.data] & ((w.data & 0xC0) != 0x80), w.offsets), per_row(_SYMBOL[w.data], w.offsets), again, repeated_words(w, hashes)]
        out.append(pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in cols], fields=list(_STATS)))
    return join_lists(out, _STATS)


_LINES = pa.struct([("content", pa.int64()), ("lines", pa.list_(pa.int64()))])


@arrow_column(_LINES)
def normalised_lines(text: pa.Array) -> pa.Array:
    """The hash of a text's lower-cased words, and of each different line of it."""
    out = []
    for _, _, w in words_in(pc.utf8_lower(text.cast(pa.large_string()))):
        lines, row, _ = line_hashes(w, w.hashes(), raw=False)
        content = np.zeros(w.rows, dtype=np.uint64)
        place = np.arange(len(lines), dtype=np.uint64) - np.searchsorted(row, row).astype(np.uint64)
        np.add.at(content, row, lines * (place * np.uint64(2) + np.uint64(1)))
        order = np.lexsort((lines, row))
        lines, row = lines[order], row[order]
        new = np.flatnonzero(np.concatenate((np.ones(min(1, len(lines)), bool), (lines[1:] != lines[:-1]) | (row[1:] != row[:-1]))))
        out.append(pa.StructArray.from_arrays([signed(content), lists(signed(lines[new]), np.bincount(row[new], minlength=w.rows))], fields=list(_LINES)))
    return join_lists(out, _LINES)


def frequent_lines(read: DataFrame, min_docs: int, max_share: float) -> DataFrame:
    """`row_id, host, content, lines` to `row_id, host, content, frequent`, for the rows that have any.

    A line is frequent if more than min_docs and more than max_share of the host's distinct
    documents have it.
    """
    lines = read.select("row_id", "host", "content", F.explode("lines").alias("line"))
    hosts = read.groupBy("host").agg(F.count_distinct("content").alias("host_docs"))
    found = lines.groupBy("host", "line", "content").agg(F.lit(1).alias("one")).groupBy("host", "line").agg(F.count("*").alias("n_docs")).where(F.col("n_docs") > min_docs)
    frequent = found.join(hosts, "host").where(F.col("n_docs") > max_share * F.col("host_docs")).select("host", "line")
    return lines.join(frequent, ["host", "line"]).groupBy("row_id", "host", "content").agg(F.collect_set("line").alias("frequent"))


_LEFT = pa.struct([("text", pa.string()), ("n_left", pa.int64())])


@arrow_column(_LEFT)
def text_left(body: pa.Array, frequent: pa.Array) -> pa.Array:
    """Each compressed text without its frequent lines, and the number of words left."""
    out = []
    for first, last, text in unsqueezed(body):
        at = first
        for _, _, w in words_in(pc.utf8_lower(text)):
            lines, row, counts = line_hashes(w, w.hashes(), raw=False)
            edges = np.searchsorted(row, np.arange(w.rows + 1))
            left, n_left = text.slice(at - first, w.rows).to_pylist(), w.counts()
            for i, gone in enumerate(frequent.slice(at, w.rows).to_pylist()):
                if gone:
                    mine = slice(edges[i], edges[i + 1])
                    stays = ~np.isin(lines[mine], np.array(gone, dtype=np.int64).view(np.uint64))
                    n_left[i] = counts[mine][stays].sum()
                    each = iter(stays)
                    left[i] = "\n".join(x for x in left[i].split("\n") if not _WORDS.search(x) or next(each))
            out.append(pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(n_left, pa.int64())], fields=list(_LEFT)))
            at += w.rows
    return join_lists(out, _LEFT)


def without_frequent_lines(docs: DataFrame, min_docs: int = 5, max_share: float = 0.05) -> DataFrame:
    """`row_id, host, text` to row_id, the counts of `text_stats`, n_left and text: what its frequent lines leave of it.

    The other lines, and those without words, stay as they are; a null text gives "".
    """
    host = F.coalesce(F.concat(F.lit("="), "host"), F.lit("")).alias("host")
    read = settled(docs.select("row_id", host, normalised_lines("text").alias("n")).select("row_id", "host", "n.*"))
    lost = frequent_lines(read, min_docs, max_share)
    whole = docs.select("row_id", host, text_stats("text").alias("s"), normalised_lines("text")["content"].alias("content"), squeezed("text").alias("body"))
    out = whole.join(lost, ["row_id", "host", "content"], "left")
    return out.select("row_id", "s.*", text_left("body", "frequent").alias("l")).select("*", "l.*").drop("l")


def quality_rules(docs: DataFrame, min_words: int = 10, max_repeat_percent: int = 20, min_left: float = 0.3, min_docs: int = 5, max_share: float = 0.05) -> DataFrame:
    """`row_id, host, text` to row_id, the counts of `text_stats`, base_failed, frequent_words and kept.

    min_left: the share of a document's words that must stand outside frequent lines.
    """
    out = without_frequent_lines(docs, min_docs, max_share).drop("text").withColumn("frequent_words", F.col("n_words") - F.col("n_left")).drop("n_left")
    out = out.withColumn("base_failed", (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat_percent * F.col("n_words")))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("n_words") - F.col("frequent_words") >= min_left * F.col("n_words")))


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"), F.col("source").alias("host"), "text")
    return quality_rules(docs).select(F.col("row_id").alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "frequent_words")


OP10_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORD}') AS ws FROM documents),
g AS (SELECT doc_id, i, array_to_string(ws[i : i + 4], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 3)) AS i FROM d)),
rep AS (SELECT doc_id, count(DISTINCT pos) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS pos FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g) WHERE c > 1) GROUP BY doc_id),
raw AS (SELECT doc_id, host, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS nr FROM d),
l AS (SELECT doc_id, host, line, nr, regexp_extract_all(lower(line), '{WORD}') AS lw FROM raw),
lines AS (SELECT doc_id, host, line, nr, array_to_string(lw, ' ') AS norm, len(lw) AS words FROM l WHERE len(lw) > 0),
dup AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n, string_agg(norm, chr(10) ORDER BY nr) AS content FROM lines GROUP BY doc_id),
hosts AS (SELECT host, count(DISTINCT coalesce(content, '')) AS host_docs FROM d LEFT JOIN dup USING (doc_id) GROUP BY host),
freq AS (SELECT host, norm, count(DISTINCT content) AS n_docs FROM lines JOIN dup USING (doc_id) GROUP BY host, norm),
lost AS (SELECT doc_id, CAST(sum(words) AS BIGINT) AS n FROM lines JOIN freq USING (host, norm) JOIN hosts USING (host) WHERE n_docs > 5 AND n_docs > 0.05 * host_docs GROUP BY doc_id),
s AS (SELECT d.doc_id, len(ws) AS n_words, length(array_to_string(ws, '')) AS word_chars, length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dup.n, 0) AS n_dup_lines, coalesce(rep.n, 0) AS n_repeat_words, coalesce(lost.n, 0) AS frequent_words
  FROM d LEFT JOIN dup USING (doc_id) LEFT JOIN rep USING (doc_id) LEFT JOIN lost USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND n_words - frequent_words >= 0.3 * n_words AS kept, frequent_words FROM b
"""
