"""Packing: exact round trip of all ids, windows' rules, and neighbours that beat chance."""

import random
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from svloom.llm import packing as P
from svloom.llm.kernels import slices

from .helpers import documents, folder, sentence

PARTS = ["a", "Ab", "'s", "'ll", " ", "  ", "\n", "\t", "\r\n", " ", "　", " ", "\u0085", "\x1c", "é", "ß", "日本", "12", "3", "!", "<|endoftext|>", "...", "​", " ", " ", "x'y", "😀", " "]


def tokenizer():
    return Tokenizer.from_file(P.default_tokenizer()[0])


def test_chunks_give_the_tokenizers_ids(monkeypatch):
    """Also when the cache is merged and emptied again and again; its bound holds, but for one batch."""
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randrange(0, 40))) for _ in range(4000)] + [sentence(rng, 400), "".join(rng.choices("abcxyz019éß", k=200_000)) + " end", "a b"]
    want = [e.ids for e in tokenizer().encode_batch(texts, add_special_tokens=False)]
    for ranks in (P.default_tokenizer()[1], None):
        chunks, got = P.Chunks(P.default_tokenizer()[0], ranks), []
        most = 0
        chunks.known.YOUNG = 500
        monkeypatch.setattr(P, "CACHED", 3000)
        monkeypatch.setattr(P, "CACHED_IDS", 1 << 17)
        for _, _, data, offsets in slices(pa.array(texts), 5000):
            ids, n = chunks(data, offsets)
            got += [x.tolist() for x in np.split(ids, np.cumsum(n)[:-1])]
            most = max(most, len(chunks.known.old[0]))
        assert got == want and 0 < most <= 3500


def test_scores_are_bm25():
    rng = np.random.default_rng(4)
    ids = [rng.integers(0, 40, rng.integers(1, 60)).astype(np.uint16) for _ in range(30)]
    df = np.array([sum(t in x for x in ids) for t in range(1 << 16)])
    idf, mean = np.log1p((30 - df + 0.5) / (df + 0.5)), np.mean([len(x) for x in ids])
    index = P.Index(ids, P.Statistics(idf, mean))
    for seed in range(30):
        want = []
        for x in ids:
            tf = np.array([(x == t).sum() for t in np.unique(ids[seed])])
            want.append((idf[np.unique(ids[seed])] * tf * 2.2 / (tf + 1.2 * (0.25 + 0.75 * len(x) / mean))).sum())
        assert np.allclose(index.scores(seed), want)


def test_seeds_take_their_best_neighbours():
    rng = np.random.default_rng(7)
    topics = [rng.integers(1000 * t, 1000 * t + 200, 500).astype(np.uint16) for t in range(10) for _ in range(4)]
    order = rng.permutation(40)
    ids = [topics[i] for i in order]
    idf = np.ones(1 << 16)
    for window in P.packed(ids, P.Statistics(idf, 500.0))[:8]:
        whole = [order[i] // 4 for i, a, b in window if b - a == 500]
        assert len(set(whole[:4])) <= 2


def check_pieces(rows, texts):
    """Every id once, in gapless sequences; the share of padding."""
    ids = {i: [*e.ids, 1] for i, e in enumerate(tokenizer().encode_batch([t or "" for t in texts], add_special_tokens=False))}
    by_doc, by_sequence = {}, {}
    for r in rows:
        part = np.array(ids[r.doc_id][r.start : r.start + r.length], dtype="<u4")
        assert r.length == len(part) > 0 and r.ids_crc32 == zlib.crc32(part.tobytes()) and r.doc_tokens == len(ids[r.doc_id])
        by_doc.setdefault(r.doc_id, []).append((r.start, r.length))
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert set(by_doc) == set(ids)
    for pieces, end in [(p, len(ids[i])) for i, p in by_doc.items()] + [(p, None) for p in by_sequence.values()]:
        at = 0
        for start, length in sorted(pieces):
            assert start == at
            at += length
        assert end is None or at == end
        assert at <= 2048 or end is not None
    sizes = [sum(n for _, n in p) for p in by_sequence.values()]
    return sum(0 if n & (n - 1) == 0 else 2048 - n for n in sizes) / sum(sizes)


def test_query_round_trip(spark, tmp_path):
    rng = random.Random(6)
    texts = [None, "", " ", "x", "x", sentence(rng, 9000), "<|endoftext|> end", "a" * 30000] + [sentence(rng, rng.randrange(1, 700)) for _ in range(200)]
    docs = documents(spark, texts).repartition(3).withColumn("ids", F.lit("clash")).withColumn("start", F.lit(1))
    got = P.op12_pack(spark, folder(spark, tmp_path, documents=docs))
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
    rows = got.collect()
    assert check_pieces(rows, texts) == 0
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows))


def test_repeated_ids_and_null_ids(spark, tmp_path):
    docs = documents(spark, ["a b c", "d e"])
    docs = docs.union(docs).union(docs.withColumn("doc_id", F.lit(None).cast("long")))
    rows = P.op12_pack(spark, folder(spark, tmp_path, documents=docs)).collect()
    assert len(rows) >= 6 and sum(r.length for r in rows) == 3 * sum(len(e.ids) + 1 for e in tokenizer().encode_batch(["a b c", "d e"]))


def test_small_shards(spark, monkeypatch):
    ids = [np.arange(i % 90 + 1, dtype=np.uint16) for i in range(300)]
    out = P.packed(ids, P.Statistics(np.ones(1 << 16), 40.0))
    seen = sorted((i, a, b) for s in out for i, a, b in s)
    assert sum(b - a for _, a, b in seen) == sum(map(len, ids))
    assert all(sum(b - a for _, a, b in s) in (2048, *(1 << k for k in range(11))) for s in out)


def test_empty_table(spark, tmp_path):
    assert P.op12_pack(spark, folder(spark, tmp_path, documents=documents(spark, ["x"]).limit(0))).count() == 0
