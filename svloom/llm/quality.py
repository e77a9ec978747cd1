"""A quality classifier by Bradley-Terry ranking.

Every pair of a good and a bad labelled document is a contest that the good one wins. The
score is linear in features of the whole text; its weights minimise the logistic loss of
feature differences over the contests. Scores are cut at the quantile that leaves as many
below as the labels call bad, and the margin from the cut is squashed to 0..1.

The weights are fitted on a bounded sample of the labelled rows (`sample_rows`, the rows
whose hash is lowest); every document is scored.

Cases: a null or empty text scores as one without words; rows without a label are scored
alike, rows of a null doc_id are not held out; labels of null or without a document teach nothing;
with fewer than one good and one bad document every score is 0.5; repeated rows score alike; a
very long text is one more row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, unit
from .kernels import arrow_column, join_lists, lists, per_row, words_in
from .quality_rules import line_hashes, repeated_words

FEATURES = ("log_words", "mean_word", "upper", "marks", "bars", "exclaims", "digits", "repeats", "dup_lines", "log_line_words")


def _of(chars: str) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    out[[ord(c) for c in chars]] = True
    return out


_UPPER, _MARKS, _BARS, _EXCLAIMS, _DIGITS = _of("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), _of("#*$%&<>@^~"), _of("|"), _of("!?"), _of("0123456789")


@arrow_column(pa.list_(pa.float64()))
def text_features(text: pa.Array) -> pa.Array:
    """FEATURES of each text, shares among its bytes or words."""
    out = []
    for _, _, w in words_in(text):
        hashes = w.hashes()
        words = w.counts()
        n = np.maximum(words, 1)
        size = np.maximum(per_row(w.ends - w.starts, w.first), 1)
        lines, row, counts = line_hashes(w, hashes, raw=True)
        order = np.lexsort((lines, row))
        a, b = lines[order], row[order]
        dups = np.bincount(b[1:][(a[1:] == a[:-1]) & (b[1:] == b[:-1])], minlength=w.rows)
        n_lines = np.maximum(np.bincount(row, minlength=w.rows), 1)
        shares = [per_row(c[w.data], w.offsets) / size for c in (_UPPER, _MARKS, _BARS, _EXCLAIMS, _DIGITS)]
        cols = [np.log1p(words), size / n, *shares, repeated_words(w, hashes) / n, dups / n_lines, np.log1p(words / n_lines)]
        out.append(lists(pa.array(np.column_stack(cols).ravel(), pa.float64()), np.full(w.rows, len(FEATURES))))
    return join_lists(out, pa.list_(pa.float64()))


def held_out(doc_id: Column) -> Column:
    """One third of all ids, by checksum; never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


class Ranker:
    """A fitted ranking: `weights` of standardised features and the `cut`."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: np.ndarray, cut: float):
        self.mean, self.scale, self.weights, self.cut = mean, scale, weights, cut

    def score(self, features: Column) -> Column:
        margin = F.lit(float(-self.cut))
        for i in range(len(FEATURES)):
            z = (F.element_at(features, i + 1) - float(self.mean[i])) / float(self.scale[i])
            margin = margin + F.greatest(F.lit(-CLIP), F.least(F.lit(CLIP), z)) * float(self.weights[i])
        return 1.0 / (1.0 + F.exp(-margin))


#: Standard deviations beyond which a feature counts no more.
CLIP = 8.0


def fit_pairs(x: np.ndarray, good: np.ndarray, pairs_each: int = 16, ridge: float = 1e-2, rounds: int = 50) -> Ranker:
    """Bradley-Terry weights by Newton's method. x: a row of features each; good: 1 or 0 each."""
    mean, scale = x.mean(0) if len(x) else np.zeros(len(FEATURES)), x.std(0) if len(x) else np.ones(len(FEATURES))
    scale = np.where(scale > 1e-9, scale, 1.0)
    z = np.clip((x - mean) / scale, -CLIP, CLIP)
    win, lose = z[good == 1], z[good == 0]
    if not len(win) or not len(lose):
        return Ranker(mean, scale, np.zeros(len(FEATURES)), 0.0)
    n = max(len(win), len(lose)) * pairs_each
    i = np.arange(n)
    difference = win[i % len(win)] - lose[(i * 7919 + i // len(win)) % len(lose)]
    weights = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(difference @ weights))
        gradient = difference.T @ p / n - ridge * weights
        hessian = (difference * (p * (1 - p))[:, None]).T @ difference / n + ridge * np.eye(len(weights))
        step = np.linalg.solve(hessian, gradient)
        weights += step
        if np.abs(step).max() < 1e-8:
            break
    margins = np.sort(z @ weights)
    k = int((good == 0).sum())
    return Ranker(mean, scale, weights, float((margins[k - 1] + margins[k]) / 2))


def fit_ranker(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000) -> Ranker:
    """Learn from the labelled rows that aren't held out; at most sample_rows of them."""
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("quality").alias("good"))
    sample = known.orderBy(unit(F.col("doc_id"), seed=6), "doc_id").limit(sample_rows)
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("doc_id", "good", text_features("text").alias("x")).dropDuplicates(["doc_id"]).limit(sample_rows).collect()
    rows.sort(key=lambda r: r["doc_id"])
    x = np.array([r["x"] for r in rows]).reshape(len(rows), len(FEATURES))
    return fit_pairs(x, np.array([r["good"] for r in rows]))


def score_quality(docs: DataFrame, ranker: Ranker) -> DataFrame:
    """`docs` with score and predicted added."""
    scored = docs.withColumn("_x", text_features("text")).withColumn("score", ranker.score(F.col("_x"))).drop("_x")
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ranker = fit_ranker(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, ranker).select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the classifier doesn't reject."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    ranker = fit_ranker(docs, table(spark, sf_dir, "labels"))
    return score_quality(docs, ranker).where("predicted = 1").drop("score", "predicted")
