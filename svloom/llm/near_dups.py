"""Near duplicates by ProbMinHash.

Shingles of five words weigh 1 + ln(count). For each, a Poisson process of that rate drops
arrivals on the components of a signature; a component keeps its earliest shingle. Arrivals
are drawn for all shingles of many documents at once, round by round, and a shingle stops as
soon as its next arrival is later than all components' (early termination). Components agree
with the probability Jaccard of the weights. The same similarity, computed from the whole
shingle sets, is the proof of a link; where no shingle repeats it is the Jaccard similarity.

Documents of equal words are one text from the start. Signatures are cut into bands; texts
that share a band are candidates, an estimate over the whole signature drops hopeless pairs,
and what stays is verified. Links are contracted to classes before anything else is tried:

1. a bucket of up to `small` texts gives all its pairs, a larger one links each text to its
   least; links become classes;
2. a large bucket that then holds several classes is open. Its texts outside its greatest
   class are tested against all its texts of other classes, in blocks of bounded size, and
   one link for each text, class and block comes back.

So every two texts that share a bucket are in one class or were compared: nothing is capped,
and no bucket gives all its pairs as rows.

Cases: a text of under five words is one shingle; a null or empty text has none and is a
class of its own; a doc_id with several rows is one document, of the text with the least
hash, and its repeated rows become one in the pipeline's stage; a null doc_id has no class, and
its rows stay in the stage; a very long text is one more text, read in one piece; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import kept, table
from .kernels import _BASE, _INVERSE, Words, arrow_column, join_lists, lists, mix, powers, signed, squeezed, unsqueezed, words_in

SHINGLE = 5
BANDS, ROWS = 24, 4
SIZE = BANDS * ROWS
#: A pair is verified if its signatures agree this much less than the similarity asked for (over four standard deviations).
DOUBT = 0.17
#: Texts and shingles in a block that an open bucket is compared by.
BLOCK_TEXTS, BLOCK_SHINGLES = 192, 100_000

def shingles(w: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, count) of each different shingle, sorted, and the hash of each row's words."""
    hashes, n = w.hashes(), w.counts()
    total = np.zeros(len(hashes) + 1, dtype=np.uint64)
    np.cumsum(hashes * powers(_BASE, len(hashes)), out=total[1:])
    inverse = powers(_INVERSE, len(hashes) + 1)
    size = np.minimum(n, SHINGLE)
    each = np.where(n > 0, n - size + 1, 0)
    row = np.repeat(np.arange(w.rows), each)
    start = w.first[row] + np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
    found = mix((total[start + size[row]] - total[start]) * inverse[start] + size[row].astype(np.uint64))
    order = np.lexsort((found, row))
    found, row = found[order], row[order]
    new = np.flatnonzero(np.append(np.ones(min(1, len(row)), bool), (found[1:] != found[:-1]) | (row[1:] != row[:-1])))
    whole = mix((total[w.first[1:]] - total[w.first[:-1]]) * inverse[w.first[:-1]] + n.astype(np.uint64) * np.uint64(_BASE))
    return row[new], found[new], np.diff(np.append(new, len(row))), whole


def signatures(rows: int, row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, size: int = SIZE) -> np.ndarray:
    """ProbMinHash: for each row `size` shingles, each the first to arrive at its component."""
    earliest = np.full(rows * size, np.inf)
    kept = np.zeros(rows * size, dtype=np.uint64)
    time = np.zeros(len(row))
    step = 0
    while len(row):
        step += 1
        drawn = mix(shingle + np.uint64(step * _BASE % (1 << 64)))
        time = time - np.log(((drawn >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        at = row * size + (mix(drawn ^ np.uint64(_BASE)) % np.uint64(size)).astype(np.int64)
        np.minimum.at(earliest, at, time)
        first = earliest[at] == time
        kept[at[first]] = shingle[first]
        live = time < earliest.reshape(rows, size).max(1)[row]
        row, shingle, weight, time = row[live], shingle[live], weight[live], time[live]
    return kept.reshape(rows, size)


_SKETCH = pa.struct([("whole", pa.int64()), ("n_shingles", pa.int32()), ("bands", pa.list_(pa.int64())), ("signature", pa.binary())])


@arrow_column(_SKETCH)
def sketch(text: pa.Array) -> pa.Array:
    out = []
    for _, _, w in words_in(text):
        row, found, count, whole = shingles(w)
        kept = signatures(w.rows, row, found, 1 + np.log(count))
        parts = kept.reshape(w.rows, BANDS, ROWS)
        keys = np.zeros((w.rows, BANDS), dtype=np.uint64)
        for i in range(ROWS):
            keys = mix(keys * np.uint64(_BASE) + parts[:, :, i])
        keys = mix(keys + np.arange(BANDS, dtype=np.uint64))
        some = w.counts() > 0
        short = kept.astype(np.uint16).tobytes()
        width = SIZE * 2
        signature = pa.array([short[i * width : (i + 1) * width] for i in range(w.rows)], pa.binary())
        bands = lists(signed(keys[some].ravel()), np.where(some, BANDS, 0))
        out.append(pa.StructArray.from_arrays([signed(whole), pa.array(np.bincount(row, minlength=w.rows), pa.int32()), bands, signature], fields=list(_SKETCH)))
    return join_lists(out, _SKETCH)


@arrow_column(pa.float64())
def estimate(a: pa.Array, b: pa.Array) -> pa.Array:
    """The share of components in which two signatures agree."""
    x, y = (np.frombuffer(b"".join(c.to_pylist()), dtype=np.uint16).reshape(-1, SIZE) for c in (a, b))
    return pa.array((x == y).mean(1), pa.float64())


_SET = pa.struct([("whole", pa.int64()), ("set", pa.list_(pa.int64()))])


@arrow_column(_SET)
def shingle_set(body: pa.Array) -> pa.Array:
    """The different shingles of each compressed text, ascending: 32 bits of hash, then the count."""
    out = []
    for _, _, text in unsqueezed(body):
        for _, _, w in words_in(text):
            row, found, count, whole = shingles(w)
            packed = (found & np.uint64(0xFFFFFFFF << 32)) | np.minimum(count, 0xFFFFFFFF).astype(np.uint64)
            sets = lists(signed(packed), np.bincount(row, minlength=w.rows))
            out.append(pa.StructArray.from_arrays([signed(whole), sets], fields=list(_SET)))
    return join_lists(out, _SET)


def _weighed(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles and the weights of a set."""
    s = s.view(np.uint64)
    return s >> np.uint64(32), 1 + np.log((s & np.uint64(0xFFFFFFFF)).astype(np.float64))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """The probability Jaccard of two shingle sets: the chance that both signatures keep one shingle.

    For a shared shingle d it is 1 over the sum, for all shingles e, of the greater of x_e/x_d and
    y_e/y_d. Which is greater depends on the order of the ratios x/y alone, so running sums do.
    """
    (ka, x), (kb, y) = _weighed(a), _weighed(b)
    at = np.searchsorted(kb, ka)
    at[at == len(kb)] = 0
    both = kb[at] == ka if len(kb) else np.zeros(len(ka), dtype=bool)
    n = int(both.sum())
    if not n:
        return 0.0
    if x.max() == 1 and y.max() == 1:
        return n / (len(a) + len(b) - n)
    dx, dy = x[both], y[at[both]]
    order = np.argsort(dx / dy, kind="stable")
    dx, dy = dx[order], dy[order]
    ratio = dx / dy
    first = np.searchsorted(ratio, ratio)
    below = np.concatenate(([0.0], np.cumsum(dy)))[first] + (y.sum() - dy.sum())
    above = dx.sum() - np.concatenate(([0.0], np.cumsum(dx)))[first] + (x.sum() - dx.sum())
    return float((1 / (above / dx + below / dy)).sum())


@arrow_column(pa.float64())
def similarities(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array([similarity(x.values.to_numpy(), y.values.to_numpy()) for x, y in zip(a, b, strict=True)], pa.float64())


def buckets_of(texts: DataFrame) -> DataFrame:
    """`id, bands` to `id, key, n, leader` of the buckets of two texts and more; the leader is the least id.

    The counts are settled before they meet the members, so that the join may split a hot bucket.
    """
    members = texts.select("id", F.explode("bands").alias("key"))
    counts = kept(members.groupBy("key").agg(F.count("*").alias("n"), F.min("id").alias("leader")).where("n > 1"))
    return kept(members.join(counts, "key"))


def first_pairs(met: DataFrame, small: int) -> DataFrame:
    """The different pairs a < b of a small bucket, and those of a large one's texts and its leader."""
    star = met.where(f"id <> leader and (n > {small} or n = 2)").select(F.col("leader").alias("a"), F.col("id").alias("b"))
    few = met.where(f"n > 2 and n <= {small}")
    left, right = few.select("key", F.col("id").alias("a")), few.select("key", F.col("id").alias("b"))
    return star.unionByName(left.join(right, "key").where("a < b").select("a", "b")).distinct()


def _spread(links: DataFrame) -> DataFrame:
    """`a, b` to `id, label` by spreading the least id along links and jumping to labels' labels."""
    both = kept(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))))
    labels = kept(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("label")).withColumnRenamed("a", "id"))
    while True:
        near = both.join(labels, both["b"] == labels["id"]).groupBy("a").agg(F.min("label").alias("near"))
        spread = labels.join(near, labels["id"] == near["a"], "left").select("id", F.col("label").alias("old"), F.least("label", F.coalesce("near", "label")).alias("label"))
        up = labels.select(F.col("id").alias("up_id"), F.col("label").alias("up"))
        labels = kept(spread.join(up, spread["label"] == up["up_id"], "left").select("id", "old", F.least("label", F.coalesce("up", "label")).alias("label")))
        if labels.where("old <> label").isEmpty():
            return labels.drop("old")
        labels = labels.drop("old")


def components(links: DataFrame) -> DataFrame:
    """`a < b` to `id, label`: the least id of each connected part.

    Each text is contracted into its least neighbour first, so that only the links between
    neighbours so chosen go through the rounds, not those of every text of a large group.
    """
    up = kept(links.groupBy("b").agg(F.min("a").alias("up")))
    rest = links.join(up, "b").where("a <> up").select(F.col("up").alias("a"), F.col("a").alias("b")).distinct()
    heads = up.select(F.col("up").alias("b")).unionByName(rest.select("b")).distinct()
    chain = up.join(heads, "b", "left_semi").select(F.col("up").alias("a"), "b")
    labels = _spread(rest.unionByName(chain))
    named = lambda key: labels.select(F.col("id").alias(key), F.col("label").alias(f"{key}_label"))
    below = up.join(named("up"), "up", "left").join(labels.select(F.col("id").alias("b")), "b", "left_anti").select(F.col("b").alias("id"), F.coalesce("up_label", "up").alias("label"))
    roots = up.select(F.col("up").alias("id")).distinct().join(labels, "id", "left_anti").select("id", F.col("id").alias("label"))
    return kept(below.unionByName(roots).unionByName(labels))


_FOUND = "a long, b long"


def _block_links(min_similarity: float):
    def links(asked: pa.Table, held: pa.Table) -> pa.Table:
        """One link of each asked text to each other class of a block, if there is any.

        One pass over the block bounds the similarity with all its texts: with equal weights the bound is
        the similarity itself. Only what it leaves is worked out.
        """
        found: tuple[list, list] = ([], [])
        if asked.num_rows and held.num_rows:
            ids, label = held["other_id"].to_numpy(), held["other_label"].to_numpy()
            sets = [x.values.to_numpy() for x in held["other_set"]]
            keys, weights = _weighed(np.concatenate(sets))
            first = np.cumsum([0, *map(len, sets)])[:-1]
            known, code = np.unique(keys, return_inverse=True)
            total, equal = np.add.reduceat(weights, first), weights.max() == 1
            for i, mine, x in zip(asked["of_id"].to_pylist(), asked["of_label"].to_pylist(), asked["of_set"], strict=True):
                x = x.values.to_numpy()
                x_keys, x_weights = _weighed(x)
                at = np.searchsorted(known, x_keys)
                at[at == len(known)] = 0
                hit = known[at] == x_keys
                shared = np.zeros(len(known))
                shared[at[hit]] = x_weights[hit]
                here = shared[code]
                of_x = np.add.reduceat(here, first)
                if equal and x_weights.max() == 1:
                    most = of_x / (len(x) + total - of_x)
                else:
                    of_held, of_both = (np.add.reduceat(np.where(here > 0, w, 0.0), first) for w in (weights, np.maximum(here, weights)))
                    most = of_both / (x_weights.sum() + total - np.minimum(of_x, of_held))
                may = np.flatnonzero((label != mine) & (most >= min_similarity - 1e-9))
                joined: set[int] = set()
                for j in may[np.argsort(-most[may], kind="stable")].tolist():
                    if int(label[j]) not in joined and similarity(x, sets[j]) >= min_similarity:
                        joined.add(int(label[j]))
                        found[0].append(min(i, int(ids[j])))
                        found[1].append(max(i, int(ids[j])))
        return pa.table([pa.array(x, pa.int64()) for x in found], ["a", "b"])

    return links


def open_links(met: DataFrame, labels: DataFrame, texts: DataFrame, sets: DataFrame, min_similarity: float) -> DataFrame:
    """The links `a < b` between classes that share a large bucket; met: the members of large buckets."""
    classed = met.select("id", "key").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    parts = classed.groupBy("key", "label").agg(F.count("*").alias("n"))
    rule = kept(parts.groupBy("key").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("major"), F.sum("n").alias("n"), F.max("n").alias("most"), F.count("*").alias("classes")).where("classes > 1"))
    members = classed.join(rule.select("key", "major"), "key").join(texts.select("id", "n_shingles"), "id")
    weights = members.groupBy("key").agg(F.sum("n_shingles").alias("shingles"), F.sum(F.when(F.col("label") != F.col("major"), F.col("n_shingles")).otherwise(0)).alias("asked_shingles"))
    blocks = lambda n, shingles: F.greatest(F.ceil(n / BLOCK_TEXTS), F.ceil(F.col(shingles) / BLOCK_SHINGLES)).cast("int")
    cut = kept(rule.join(weights, "key").select("key", "major", blocks(F.col("n"), "shingles").alias("blocks"), blocks(F.col("n") - F.col("most"), "asked_shingles").alias("chunks")))
    held = classed.join(cut, "key").join(sets, "id")
    place = lambda n: F.pmod(F.xxhash64("id", "key"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    what = ("id", "label", "set")
    asked = held.where("label <> major").select("key", *what, place("chunks").alias("chunk"), every("blocks").alias("block"))
    others = held.select("key", *what, place("blocks").alias("block"), every("chunks").alias("chunk"))
    asked = asked.toDF("of_key", *(f"of_{c}" for c in what), "of_chunk", "of_block")  # names of its own: both sides come of one table
    others = others.toDF("key", *(f"other_{c}" for c in what), "block", "chunk")
    return asked.groupBy("of_key", "of_chunk", "of_block").cogroup(others.groupBy("key", "chunk", "block")).applyInArrow(_block_links(min_similarity), _FOUND).distinct()


def near_classes(docs: DataFrame, min_similarity: float = 0.8, small: int = 12) -> DataFrame:
    """`doc_id, text` to doc_id, class_id: the least doc_id of the class."""
    docs = docs.where("doc_id is not null").select("doc_id", "text")
    read = kept(docs.select("doc_id", sketch("text").alias("s")).select("doc_id", "s.*"))
    own = kept(read.groupBy("doc_id").agg(F.min(F.struct("whole", "n_shingles")).alias("t")).select("doc_id", "t.*"))
    copies = kept(own.where("n_shingles > 0").groupBy("whole", "n_shingles").agg(F.min("doc_id").alias("id")))
    texts = kept(read.join(copies.select(F.col("id").alias("doc_id"), "whole"), ["doc_id", "whole"], "left_semi").dropDuplicates(["doc_id"]).select(F.col("doc_id").alias("id"), "whole", "bands", "signature", "n_shingles"))
    met = buckets_of(texts)
    pairs = first_pairs(met, small)
    side = lambda x: texts.select(F.col("id").alias(x), F.col("signature").alias(f"s{x}"), F.col("n_shingles").alias(f"n{x}"))
    fits = F.least("na", "nb") >= F.greatest("na", "nb") * (min_similarity - DOUBT)
    likely = pairs.join(side("a"), "a").join(side("b"), "b").where(fits).withColumn("about", estimate("sa", "sb")).where(F.col("about") >= min_similarity - DOUBT)
    likely = kept(likely.select("a", "b"))
    large = met.where(f"n > {small}")
    asked = likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).union(large.select("id")).distinct()
    bodies = docs.join(asked, "doc_id", "left_semi").select("doc_id", squeezed("text").alias("body"))
    sets = bodies.select(F.col("doc_id").alias("id"), shingle_set("body").alias("s")).select("id", "s.*").join(texts.select("id", "whole"), ["id", "whole"], "left_semi")
    sets = kept(sets.dropDuplicates(["id"]).select("id", "set"))
    of = lambda x: sets.select(F.col("id").alias(x), F.col("set").alias(f"set_{x}"))
    links = kept(likely.join(of("a"), "a").join(of("b"), "b").where(similarities("set_a", "set_b") >= min_similarity).select("a", "b"))
    labels = components(links)
    more = kept(open_links(large, labels, texts, sets, min_similarity))
    if not more.isEmpty():
        labels = components(links.unionByName(more))
    members = own.join(copies, ["whole", "n_shingles"], "left")
    return members.join(labels, "id", "left").select("doc_id", F.coalesce("label", "id", "doc_id").alias("class_id"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def near_dup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class: that of the least doc_id. Of equal rows of it one stays."""
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    extra = near_classes(docs).where("doc_id <> class_id").select("doc_id")
    left = docs.join(extra, "doc_id", "left_anti")
    again = kept(docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").select("doc_id"))
    if again.isEmpty():
        return left
    return left.join(again, "doc_id", "left_anti").unionByName(left.join(again, "doc_id", "left_semi").distinct())
