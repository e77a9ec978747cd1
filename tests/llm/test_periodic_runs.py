"""Periodic runs against brute force over all periods."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from pyspark.sql import functions as F

from svloom.llm.periodic_runs import op13_periodic_runs, runs_in, with_runs

from .helpers import documents, folder, sentence, words


def brute_runs(w):
    found = {}
    for q in range(1, len(w) // 3 + 1):
        at, same = 0, [a == b for a, b in zip(w, w[q:], strict=False)] + [False]
        for i, x in enumerate(same):
            if not x:
                if i - at + q >= max(24, 3 * q) and i > at:
                    found.setdefault((at, i - at + q), q)
                at = i + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def brute_row(doc_id, text):
    w = words(text)
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    if h % 10 == 0 and w:
        g = h // 10
        a = g % len(w)
        p = 1 + (len(w) - a) // (3 + g % 8)
        w = [x if i < a else w[a + (i - a) % p] for i, x in enumerate(w)]
    runs = sorted(brute_runs(w), key=lambda r: (r[0], r[2]))
    best = min(runs, key=lambda r: (-Fraction(r[1], r[2]), r[0], r[2]), default=None)
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(runs), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, sha("".join(f"{s},{n},{q}\n" for s, n, q in runs)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))


def odd_words(rng):
    out = []
    while len(out) < rng.randrange(0, 300):
        kind, few = rng.randrange(6), rng.choice([1, 2, 3, 40])
        some = lambda n: [rng.randrange(few) for _ in range(rng.randrange(1, n))]
        if kind == 0:
            out += some(20) * rng.randrange(1, 8)
        elif kind == 1:
            out += ([0] * rng.randrange(1, 12) + [1]) * rng.randrange(1, 6)
        elif kind == 2:
            part = (some(6) * rng.randrange(1, 7) + [rng.randrange(60)]) * rng.randrange(1, 5)
            out += part[rng.randrange(len(part)) :]
        elif kind == 3:
            out += ([0] * rng.randrange(1, 30) + [1] * rng.randrange(0, 30)) * rng.randrange(2, 5)
        elif kind == 4:
            a, b = [0], [0, 1]
            for _ in range(rng.randrange(3, 10)):
                a, b = b, b + a
            out += b * rng.choice([1, 3])
        else:
            out += some(60)
    return out


def test_runs_are_those_of_all_periods():
    rng = random.Random(3)
    for _ in range(150):
        docs = [odd_words(rng) for _ in range(rng.randrange(1, 5))]
        r = runs_in(np.array([x for d in docs for x in d], dtype=np.uint64), np.array([len(d) for d in docs], dtype=np.int64))
        for i, d in enumerate(docs):
            mine = r.row == i
            assert sorted(zip(r.start[mine].tolist(), r.length[mine].tolist(), r.period[mine].tolist(), strict=True)) == brute_runs(d)


def test_long_periodic_row_takes_bounded_work():
    for x in (np.zeros(300_000), np.tile(np.append(np.zeros(1000), 1), 300)):
        r = runs_in(x.astype(np.uint64), np.array([len(x)]))
        assert (r.start[r.length == len(x)] == 0).all() and (r.length == len(x)).sum() == 1


def test_query_against_brute_force(spark, tmp_path):
    rng = random.Random(8)
    texts = [None, "", " \t\n", "a " * 23, "a " * 24, "a b " * 30, "é " * 9 + "x y z " * 9, sentence(rng, 5000) + " go on" * 400]
    texts += [" ".join(f"w{x}" for x in odd_words(rng)) for _ in range(120)] + [sentence(rng, rng.randrange(1, 200)) for _ in range(60)]
    texts += texts[8:20]
    docs = documents(spark, texts)
    docs = docs.unionByName(docs.where("doc_id = 4")).unionByName(docs.where("doc_id = 6").withColumn("doc_id", F.lit(None).cast("long"))).withColumn("runs", F.lit(1)).withColumn("n", F.lit(1))
    got = op13_periodic_runs(spark, folder(spark, tmp_path, documents=docs))
    assert got.columns == ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    want = [brute_row(i, t) for i, t in enumerate(texts)] + [brute_row(4, texts[4]), brute_row(None, texts[6])]
    assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert sum(r[1] > 0 for r in want) > 50


def test_real_outputs(spark):
    row = with_runs(documents(spark, ["begin " + "a b c " * 10 + "end"])).first()
    assert [tuple(r) for r in row.runs] == [(1, 30, 3)] and row.collapsed_text == "begin a b c end"


def test_empty_table(spark, tmp_path):
    assert op13_periodic_runs(spark, folder(spark, tmp_path, documents=documents(spark, ["x"]).limit(0))).count() == 0
