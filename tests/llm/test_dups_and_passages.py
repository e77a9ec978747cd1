import hashlib
import math
import os
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard

from svloom.llm import decontaminate, near_dups, substrings
from svloom.llm.kernels import words_in

from .helpers import DOCS, documents, folder, sentence, words


def brute_kept(texts):
    first = {}
    for d, t in enumerate(texts):
        w = words(t)
        for i in range(len(w) - 49):
            first.setdefault(tuple(w[i : i + 50]), d)
    out = []
    for d, t in enumerate(texts):
        w = words(t)
        cover = bytearray(len(w))
        for i in range(len(w) - 49):
            if first[tuple(w[i : i + 50])] < d:
                cover[i : i + 50] = b"\1" * 50
        out.append([x for x, c in zip(w, cover) if not c])
    return out


def passages(seed):
    rng = random.Random(seed)
    shared = [sentence(rng, n).split() for n in (49, 50, 51, 75, 160)]
    texts = [None, "", "one", sentence(rng, 300)]
    for i in range(40):
        parts = [sentence(rng, rng.randrange(60)).split() for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(shared))
        if i % 5 == 0:
            parts.append(rng.choice(shared)[10:])
        texts.append(rng.choice([" ", "\n", "\t \x0b"]).join(x for p in parts for x in p))
    texts += [texts[3], texts[3] + " tail", "a b " * 200, "a b " * 150, texts[10]]
    return texts


def test_passages(spark, tmp_path):
    for seed in (1, 2):
        texts = passages(seed)
        got = substrings.op9_substrings(spark, folder(spark, tmp_path / str(seed), documents=documents(spark, texts))).toPandas().set_index("doc_id").sort_index()
        for i, kept in enumerate(brute_kept(texts)):
            n = len(words(texts[i]))
            assert tuple(got.loc[i]) == (n, n - len(kept), hashlib.sha256(" ".join(kept).encode()).hexdigest()), i


def test_passages_as_text_and_repeated_rows(spark):
    rng = random.Random(3)
    p = sentence(rng, 60)
    docs = documents(spark, [p, "x " + p + " y", None])
    got = {r["doc_id"]: r["text"] for r in substrings.drop_repeated(docs.unionByName(docs.where("doc_id = 0"))).collect()}
    assert got == {0: p, 1: "x y", 2: None}


def test_the_automaton_gives_the_places(spark, monkeypatch):
    """A phrase that is taken out of the shards' automata takes its spans along; long texts and many shards do no harm."""
    rng = random.Random(18)
    p, long = sentence(rng, 60), sentence(rng, 150_000)
    texts = ["x " + p, p + " y", long, "z " + long, None]
    docs = documents(spark, texts).unionByName(documents(spark, [p]).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "text", "lang", "source", "n_chars"))
    digest = lambda: {r["doc_id"]: (r["n_words"], r["n_removed"]) for r in substrings.digests(docs).collect()}
    want = {0: (61, 0), 1: (61, 60), 2: (150_000, 0), 3: (150_001, 150_000), 4: (0, 0), None: (60, 0)}
    assert digest() == want
    monkeypatch.setattr(substrings, "SHARD_BYTES", 1000)
    assert digest() == want
    w = next(words_in(pa.array([texts[1]])))[2]
    found = substrings.Passages(w)
    place, low, high = found.choose()
    keys = np.unique(found.key[place])
    table = pa.table({"doc_id": [1] * len(place), "phrase": found.key[place].view(np.int64), "block": found.blocks(place, low, high).view(np.int64), "same": [True] * len(place)})
    body = pa.table({"of_doc": [1], "text_key": [0], "body": pa.array([zstandard.compress(texts[1].encode())], pa.binary())})
    spans = lambda: {s["start"] for r in substrings.locate(table, body).to_pylist() for s in r["spans"]}
    assert spans() == set(low.tolist())
    whole = substrings.automaton_of
    for gone in keys:
        monkeypatch.setattr(substrings, "automaton_of", lambda phrases, gone=gone: whole(phrases[phrases != gone.view(np.int64)]))
        assert spans() == set(low[found.key[place] != gone].tolist())


def test_shards_find_what_windows_choose():
    """The windows worked out around a located phrase are those that winnowing gives it."""
    rng = random.Random(19)
    for _ in range(60):
        texts = [" ".join(rng.choice("ab") if rng.random() < 0.7 else str(rng.randrange(99)) for _ in range(rng.randrange(200))) for _ in range(4)]
        for _, _, w in words_in(pa.array(texts)):
            p = substrings.Passages(w)
            place, low, high = p.choose()
            got = p.windows_of(p.located(substrings.automaton_of(np.unique(p.key[place]).view(np.int64))))
            assert [x.tolist() for x in got] == [x.tolist() for x in (place, low, high)]


def test_passages_of_nothing(spark, tmp_path):
    assert substrings.op9_substrings(spark, folder(spark, tmp_path, documents=spark.createDataFrame([], DOCS))).count() == 0


def shingle_weights(t):
    w = words(t)
    n = min(5, len(w))
    return {k: 1 + math.log(c) for k, c in Counter(tuple(w[i : i + n]) for i in range(len(w) - n + 1)).items()} if w else {}


def probability_jaccard(x, y):
    every = set(x) | set(y)
    return sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in set(x) & set(y))


def brute_classes(texts):
    weights, parent = [shingle_weights(t) for t in texts], list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if len(set(weights[i]) & set(weights[j])) > 0.3 * len(weights[i]) and probability_jaccard(weights[i], weights[j]) >= 0.8 - 1e-9:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))]


def edited(rng, text, n):
    w = text.split()
    for _ in range(n):
        w[rng.randrange(len(w))] = sentence(rng, 1)
    return " ".join(w)


def test_near_duplicates(spark, tmp_path):
    rng = random.Random(4)
    texts = [None, "", " ", "one", "one", "two words", sentence(rng, 4)]
    for _ in range(6):
        t = sentence(rng, rng.randrange(40, 200))
        texts += [t, t.replace(" ", "\n"), *[edited(rng, t, rng.randrange(1, 5)) for _ in range(6)]]
    big = sentence(rng, 150)
    texts += [edited(rng, big, 1) for _ in range(40)] + [sentence(rng, 80) for _ in range(20)] + ["r s t u v " * 60]
    got = near_dups.op4_near_duplicates(spark, folder(spark, tmp_path, documents=documents(spark, texts))).toPandas().set_index("doc_id").sort_index()
    assert len(got) == len(texts)
    assert got.sort_index().class_id.tolist() == brute_classes(texts)


def classes(docs, **options):
    return [r["class_id"] for r in near_dups.near_classes(docs, **options).orderBy("doc_id").collect()]


def test_near_duplicates_of_large_groups(spark, monkeypatch):
    """Groups whose texts are mostly just under or over the limit: no link of a large bucket is lost, in blocks of any size."""
    rng = random.Random(13)
    texts = []
    for n, edits in ((70, 3), (50, 5)):
        base = sentence(rng, 110)
        texts += [edited(rng, base, rng.randrange(1, edits + 1)) for _ in range(n)]
    rng.shuffle(texts)
    want = brute_classes(texts)
    assert 2 < len(set(want)) < 80
    assert classes(documents(spark, texts), small=4) == want
    monkeypatch.setattr(near_dups, "BLOCK_TEXTS", 7)
    assert classes(documents(spark, texts), small=3) == want


def test_near_duplicates_of_repetitive_texts(spark):
    """A phrase that repeats weighs more than one of its shingles, in the sketch and in the proof alike."""
    rng = random.Random(14)
    texts = []
    for _ in range(12):
        shared, phrases = sentence(rng, 200), [sentence(rng, 12) for _ in range(2)]
        texts += [f"{shared} {' '.join([p] * 20)}" for p in phrases]
        texts += [f"{shared} {' '.join([phrases[0]] * n)}" for n in (18, 25)]
        texts += [edited(rng, texts[-1], 2)]
    assert classes(documents(spark, texts)) == brute_classes(texts)


def test_similarity_is_the_probability_jaccard():
    rng = random.Random(15)
    for _ in range(200):
        x, y = ({rng.randrange(30): rng.choice((1, 1, 2, 3, 50)) for _ in range(rng.randrange(1, 25))} for _ in range(2))
        packed = [np.array(sorted((k + 1) << 32 | c for k, c in s.items()), dtype=np.int64) for s in (x, y)]
        want = probability_jaccard(*({k: 1 + math.log(c) for k, c in s.items()} for s in (x, y)))
        assert abs(near_dups.similarity(*packed) - want) < 1e-9


def test_near_duplicates_of_odd_rows(spark):
    """Rows of one doc_id are one document; a null id has no class and stays in the stage; long texts are texts."""
    rng = random.Random(16)
    long = sentence(rng, 120_000)
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (2, "g h"), (2, "i j"), (None, "a b c d e f"), (3, long), (4, long + " more"), (5, None), (6, None)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = near_dups.near_classes(docs).collect()
    assert sorted((r["doc_id"], r["class_id"]) for r in got) == [(1, 1), (2, 2), (3, 3), (4, 3), (5, 5), (6, 6)]
    assert sorted(r["doc_id"] or 0 for r in near_dups.near_dup_stage(spark, docs, "").collect()) == [0, 1, 2, 2, 3, 5, 6]


def test_signatures_estimate_probability_jaccard():
    """Components agree as often as the probability Jaccard of the weights says."""
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 2**63, 60).astype(np.uint64), rng.integers(0, 2**63, 20).astype(np.uint64)
    x, y = dict(zip(a, rng.uniform(1, 4, 60))), dict(zip(np.concatenate((a[20:], b)), rng.uniform(1, 4, 60)))
    both = set(x) & set(y)
    every = set(x) | set(y)
    jp = sum(1 / sum(max(x.get(e, 0) / x[d], y.get(e, 0) / y[d]) for e in every) for d in both)
    keys = [np.array(list(d), dtype=np.uint64) for d in (x, y)]
    row = np.repeat([0, 1], [len(x), len(y)])
    s = near_dups.signatures(2, row, np.concatenate(keys), np.concatenate([np.array(list(d.values())) for d in (x, y)]), size=6000)
    assert abs((s[0] == s[1]).mean() - jp) < 0.03


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 200)], "a long, b long")
    got = [(r["id"], r["label"]) for r in near_dups.components(links).collect()]
    assert sorted(got) == [(i, 0) for i in range(61)] + [(100, 100), (200, 100)]


def test_components_of_random_links(spark):
    rng = random.Random(17)
    for n in (5, 40, 90):
        links = {tuple(sorted(rng.sample(range(100), 2))) for _ in range(n)}
        label = {v: v for link in links for v in link}
        for _ in label:
            for a, b in links:
                label[a] = label[b] = min(label[a], label[b])
        got = [(r["id"], r["label"]) for r in near_dups.components(spark.createDataFrame(sorted(links), "a long, b long")).collect()]
        assert sorted(got) == sorted(label.items())


def test_small_rounds_leave_few_shuffle_files(spark):
    """Rounds over a few links are dealt by what they hold, not to every shuffle partition."""
    rng = random.Random(5)
    groups = [sentence(rng, 60).split() for _ in range(12)]
    texts = [" ".join([*g[:i], "other", *g[i:]]) for g in groups for i in range(15)]
    written = lambda: {f for _, _, names in os.walk(spark.conf.get("spark.local.dir")) for f in names if f.endswith(".index")}
    few = {"spark.sql.shuffle.partitions": "48", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    usual = {k: spark.conf.get(k) for k in few}
    before = written()
    try:
        for k, v in few.items():
            spark.conf.set(k, v)
        near_dups.near_classes(documents(spark, texts)).write.format("noop").mode("overwrite").save()
    finally:
        for k, v in usual.items():
            spark.conf.set(k, v)
    assert len(written() - before) < 15 * 48


def test_near_duplicates_of_nothing(spark, tmp_path):
    assert near_dups.op4_near_duplicates(spark, folder(spark, tmp_path, documents=spark.createDataFrame([], DOCS))).count() == 0


def full_align(a, b):
    """Smith-Waterman by the whole table."""
    h = [[0] * (len(a) + 1) for _ in range(len(b) + 1)]
    for i in range(1, len(b) + 1):
        for j in range(1, len(a) + 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if a[j - 1] == b[i - 1] else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h)) / (2 * len(b))


def test_alignment():
    rng = random.Random(6)
    for _ in range(40):
        a, b = [rng.randrange(5) for _ in range(rng.randrange(1, 30))], [rng.randrange(5) for _ in range(rng.randrange(1, 15))]
        assert abs(decontaminate.align(np.array(a), np.array(b)) - full_align(a, b)) < 1e-9


def test_leaks(spark, tmp_path):
    rng = random.Random(7)
    items = [sentence(rng, n) for n in (20, 30, 40, 50)] + ["two words", None]
    texts = [None, "", sentence(rng, 100)] + [sentence(rng, 40) + " " + edited(rng, items[i % 4].upper() if i % 2 else items[i % 4], i % 4) + ", " + sentence(rng, 40) for i in range(12)] + [sentence(rng, 60) + " " + " ".join(items[3].split()[:12]) for _ in range(3)] + [sentence(rng, 90) for _ in range(40)]
    sf = folder(spark, tmp_path, documents=documents(spark, texts), benchmark=spark.createDataFrame(list(enumerate(items)), "item_id long, text string"))
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.op7_decontaminate(spark, sf).collect()}
    assert set(got) == {(3 + i, i % 4) for i in range(12)}
    assert got[3, 0] == 1.0 and got[4, 1] < 1
    clean = decontaminate.decontaminate_stage(spark, spark.read.parquet(f"{sf}/documents.parquet"), sf)
    assert {r["doc_id"] for r in clean.collect()} == set(range(len(texts))) - set(range(3, 15))


def test_leaks_of_edited_copies(spark):
    """Copies that keep under half of an item's grams are found, also where other documents leak it whole."""
    rng = random.Random(12)
    items = [sentence(rng, n) for n in (24, 40, 60)] + ["echo echo echo echo"]
    replaced = lambda t, k: " ".join(sentence(rng, 1) + "q" if i % k == k - 1 else x for i, x in enumerate(t.split()))
    texts = [sentence(rng, 30) + " " + replaced(t, k) + " " + sentence(rng, 30) for t in items[:3] for k in (4, 5, 6)]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    want = {(i, i // 3) for i in range(9)}
    find = lambda texts: {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(spark, texts), bench).collect()}
    assert find(texts) == want
    assert find(texts + items) == want | {(9 + i, i) for i in range(4)}


def test_seeds_are_rare(spark):
    """A frequent gram is no seed of an item with enough others, so it costs no lookups; items of frequent grams keep them."""
    rng = random.Random(22)
    common = "in order to be able to say that"
    items = [f"{common} {sentence(rng, 40)}" for _ in range(30)] + [common]
    texts = [f"{sentence(rng, 20)} {common} {sentence(rng, 20)}" for _ in range(60)] + [sentence(rng, 9) + " " + t for t in items]
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    held, build = [], decontaminate.Lookup.__init__

    def spy(self, *args):
        build(self, *args)
        held.append(self)

    decontaminate.Lookup.__init__ = spy
    try:
        got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(documents(spark, texts), bench, rare_docs=20).collect()}
    finally:
        decontaminate.Lookup.__init__ = build
    assert got == {(60 + i, i) for i in range(30)} | {(i, 30) for i in range(91)}
    assert held[0].count.max() == 1 and len(held[0].grams) > 30 * 30


def test_leaks_of_odd_rows(spark):
    """Null ids, repeated rows and long texts are judged row by row in the stage; one item fills a block alone."""
    rng = random.Random(23)
    item, long = sentence(rng, 40), sentence(rng, 120_000)
    bench = spark.createDataFrame([(0, item), (1, sentence(rng, 300)), (2, item)], "item_id long, text string")
    rows = [(None, item), (None, "clean text of some words"), (1, f"{long} {item}"), (2, long), (3, None), (4, item), (4, item), (4, "clean")]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, block_grams=50).collect())
    assert got == [(-1, 0), (-1, 2), (1, 0), (1, 2), (4, 0), (4, 2)]
    kept = decontaminate.with_leaks(docs, bench).where("size(leaks) = 0").collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] is None) for r in kept) == [(False, 2, False), (False, 3, True), (False, 4, False), (True, 0, False)]


def test_leaks_in_blocks(spark, tmp_path):
    """A benchmark of more grams than a block takes more passes and finds the same."""
    rng = random.Random(8)
    items = [sentence(rng, 25) for _ in range(6)]
    docs = documents(spark, [sentence(rng, 20) + " " + t for t in items])
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    find = lambda **k: {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench, **k).collect()}
    assert find(block_grams=40) == find() == {(i, i) for i in range(6)}


def test_leaks_of_nothing(spark, tmp_path):
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(spark.createDataFrame([], DOCS), none).count() == 0
    assert decontaminate.leaks(documents(spark, ["a b c d e"]), none).count() == 0


def test_leaks_are_those_of_every_passage_and_item(spark):
    """Every item aligned with every whole text: the same pairs, and the same scores."""
    rng = random.Random(31)
    bench = [sentence(rng, rng.randrange(15, 40)) for _ in range(12)]
    texts = [None, "", *bench[:2]]
    for i in range(60):
        words_ = sentence(rng, rng.randrange(0, 80)).split()
        for _ in range(rng.randrange(0, 3)):
            share = rng.choice([0, 0.05, 0.1, 0.2, 0.6])
            copy = [w if rng.random() >= share else sentence(rng, 1) for w in rng.choice(bench).split()]
            at = rng.randrange(len(words_) + 1)
            words_[at:at] = copy[rng.choice([0, 0, len(copy) // 3]) :]
        texts.append(" ".join(words_))
    items = spark.createDataFrame(list(enumerate(bench)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r["score"] for r in decontaminate.leaks(documents(spark, texts), items).collect()}
    want = {}
    for d, text in enumerate(texts):
        for i, item in enumerate(bench):
            score = full_align((text or "").split(), item.split())
            if score >= 0.5:
                want[d, i] = round(score, 6)
    assert got == want and len(want) > 30 and min(want.values()) < 0.8
