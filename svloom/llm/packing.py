"""Packing: documents' tokens into sequences of at most 2,048, lexically near documents side by side.

1. Every text is tokenized whole and ended with one id. Its pieces of a whole window are sequences of
   their own; what is left of it, the rest, is to be packed.
2. The index's statistics (in how many rests a token stands, and their mean length) are counted over all
   rests. Terms are token ids, so there are no more of them than the tokenizer has, which is why the
   counts may go to the driver and to every task.
3. Rests are range-sorted by their two heaviest BM25 terms, so that near ones meet, and a hash, so
   that a common pair of terms is dealt to many tasks. A task takes its rows in order, shard by shard of
   about half a million tokens, and builds each shard's inverted BM25 index.
4. In a shard, the longest unused rest is the seed of a window. The index returns its unused
   neighbours by score, which fill the window in turn; the one that crosses its end is cut there, and
   what is left of it seeds the next window.
5. What a shard leaves at its end is cut into sequences of powers of two, so nothing is padded.

A text's tokens are those of its chunks (white space and what follows it), since the
tokenizer never joins a character with white space after it; each different chunk is tokenized once
a batch, or comes from a bounded cache.

Cases: a null or empty text is its end id alone, a sequence of one piece; a very long text is one row
while it is tokenized, and rows of a window afterwards; equal rows and rows of one doc_id, or of none,
are documents each; an empty table gives no rows; other columns are ignored. The order in a shard
depends on the rows alone, so a retried task packs alike.
"""

from __future__ import annotations

import base64
import os
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .common import settled, table
from .kernels import _BASE, _BYTE, _INVERSE, _SPACE, arrow_column, lists, mix, powers, slices

WINDOW = 2048
END = 1
#: Tokens, and rests, of a shard.
SHARD_TOKENS = 1 << 19
SHARD_ROWS = 1 << 13
#: Tokens that a task packs, about.
TASK_TOKENS = 1 << 23
#: Chunks, and ids of theirs, in a worker's cache.
CACHED, CACHED_IDS = 1 << 21, 1 << 23
#: BM25's saturation and length normalisation.
K1, B = 1.2, 0.75


def default_tokenizer() -> tuple[str, str | None]:
    """The tokenizer's file, and one with its vocabulary as ranks (or None)."""
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


class Known:
    """Ids of chunks by their keys: sorted keys, old ones and a few young ones that are merged into them, over one buffer of ids."""

    YOUNG = 1 << 16

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.old = self.young = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int32))  # keys, where their ids begin, how many
        self.flat, self.used = np.zeros(1 << 16, dtype=np.uint16), 0

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([a[1], b[1]])[order], np.concatenate([a[2], b[2]])[order]

    @staticmethod
    def _find(level: tuple, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(level[0], keys), max(0, len(level[0]) - 1))
        return at, level[0][at] == keys if len(level[0]) else np.zeros(len(keys), dtype=bool)

    def make_room(self) -> None:
        """Between batches, so that what one batch has looked up stays until it is done."""
        if len(self.old[0]) + len(self.young[0]) > CACHED or self.used > CACHED_IDS:
            self.clear()
        elif len(self.young[0]) > self.YOUNG:
            self.old, self.young = self._merged(self.old, self.young), tuple(x[:0] for x in self.young)

    def missing(self, keys: np.ndarray) -> np.ndarray:
        return np.flatnonzero(~(self._find(self.old, keys)[1] | self._find(self.young, keys)[1]))

    def add(self, keys: np.ndarray, ids: list[list[int]]) -> None:
        """New ones, by sorted keys."""
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        ends = self.used + np.cumsum(sizes)
        if ends[-1] > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.used], np.zeros(int(ends[-1]), dtype=np.uint16)])
        self.flat[self.used : ends[-1]] = np.fromiter((i for x in ids for i in x), dtype=np.uint16, count=int(sizes.sum()))
        self.used = int(ends[-1])
        self.young = self._merged(self.young, (keys, ends - sizes, sizes.astype(np.int32)))

    def ids(self, keys: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of keys[which] in turn, and how many each has; all are known."""
        begin, n = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
        for level in (self.old, self.young):
            at, hit = self._find(level, keys)
            begin[hit], n[hit] = level[1][at[hit]], level[2][at[hit]]
        begin, n = begin[which], n[which]
        return self.flat[np.repeat(begin - (np.cumsum(n) - n), n) + np.arange(n.sum())], n


class Chunks:
    """A tokenizer that takes texts apart into chunks, and each different chunk once.

    ranks: the tokenizer's vocabulary as ranks, for a quicker library; chunks with special tokens go to the tokenizer itself.
    """

    def __init__(self, path: str, ranks: str | None = None):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        if size > 1 << 16:
            raise ValueError("ids are kept as 16 bits; this tokenizer has more")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.quick = None
        if ranks:
            with open(ranks, "rb") as lines:
                known = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            if len(known) + len(self.special) != size:
                raise ValueError("the ranks are not this tokenizer's")
            self.quick = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=known, special_tokens={}).encode_ordinary
        self.known = Known()

    def __call__(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of rows with these bytes, without end ids, and how many each row has."""
        self.known.make_room()
        starts = chunk_starts(data, offsets)
        ends = np.append(starts[1:], len(data))
        total = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=total[1:])
        keys = mix((total[ends] - total[starts]) * powers(_INVERSE, len(data) + 1)[starts] + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        keys, one, which = np.unique(keys, return_index=True, return_inverse=True)
        new = self.known.missing(keys)
        if len(new):
            body = data.tobytes()
            self.known.add(keys[new], self._encoded([body[a:b].decode() for a, b in zip(starts[one[new]].tolist(), ends[one[new]].tolist(), strict=True)]))
        ids, n = self.known.ids(keys, which)
        upto = np.append(0, np.cumsum(n))
        return ids, np.diff(upto[np.searchsorted(starts, offsets)])

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        joined = "".join(texts)
        if not self.quick:
            slow = list(range(len(texts)))
        elif any(x in joined for x in self.special):
            slow = [i for i, text in enumerate(texts) if any(x in text for x in self.special)]
        else:
            return list(map(self.quick, texts))
        found = dict(zip(slow, self.tokenizer.encode_batch_fast([texts[i] for i in slow], add_special_tokens=False), strict=True))
        return [found[i].ids if i in found else self.quick(text) for i, text in enumerate(texts)]


def chunk_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Where chunks begin: with each row, and with ASCII white space that follows something else than white space."""
    space = _SPACE[data]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    at = np.flatnonzero(begins)
    at = at[at > 2]
    wide = at[data[at - 1] >= 128]
    x, y, z = data[wide - 3], data[wide - 2], data[wide - 1]
    # The white space beyond ASCII: U+0085, U+00A0, U+1680, U+2000-200A, U+2028-2029, U+202F, U+205F, U+3000.
    beyond = ((y == 0xC2) & ((z == 0x85) | (z == 0xA0))) | ((x == 0xE1) & (y == 0x9A) & (z == 0x80)) | ((x == 0xE2) & (y == 0x80) & ((z <= 0x8A) | (z == 0xA8) | (z == 0xA9) | (z == 0xAF)))
    beyond |= ((x == 0xE2) & (y == 0x81) & (z == 0x9F)) | ((x == 0xE3) & (y == 0x80) & (z == 0x80))
    begins = np.zeros(len(data) + 1, dtype=bool)
    begins[at] = True
    begins[wide[beyond]] = False
    begins[offsets] = True
    return np.flatnonzero(begins[:-1])


@lru_cache(1)
def _chunks(path: str, ranks: str | None) -> Chunks:
    return Chunks(path, ranks)


_WINDOWS = pa.struct([("doc_tokens", pa.int64()), ("windows", pa.list_(pa.binary()))])


def windows_of(path: str, ranks: str | None) -> Callable:
    """A column function: a text's number of ids, end id included, and the ids, 16 bits each, window by window; all but the last are full."""

    def windows(text: pa.Array) -> pa.Array:
        out, sizes, n_windows = [], [], []
        for _, _, data, offsets in slices(text):
            ids, counts = _chunks(path, ranks)(data, offsets)
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, np.uint16(END))
            body, at = ids.tobytes(), 0
            for n in (counts + 1).tolist():
                parts = [body[2 * (at + i) : 2 * (at + min(n, i + WINDOW))] for i in range(0, n, WINDOW)]
                out += parts
                sizes.append(n)
                n_windows.append(len(parts))
                at += n
        return pa.StructArray.from_arrays([pa.array(sizes, pa.int64()), lists(pa.array(out, pa.binary()), np.array(n_windows, dtype=np.int64))], fields=list(_WINDOWS))

    return arrow_column(_WINDOWS)(windows)


def tokenized(docs: DataFrame, tokenizer: tuple[str, str | None]) -> DataFrame:
    """`doc_id, text` to a row for each window of a text: doc_id, doc_tokens, start and ids."""
    rows = docs.select("doc_id", windows_of(*tokenizer)("text").alias("t"))
    return rows.select("doc_id", "t.doc_tokens", F.posexplode("t.windows").alias("nr", "ids")).select("doc_id", "doc_tokens", (F.col("nr") * WINDOW).cast("long").alias("start"), "ids")


# Statistics of the index


def _distinct_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """In how many of a task's rests each token stands."""
    counts = np.zeros(1 << 16, dtype=np.int64)
    for batch in batches:
        for x in batch["ids"]:
            counts[np.unique(np.frombuffer(x.as_buffer(), dtype=np.uint16))] += 1
    token = np.flatnonzero(counts)
    yield pa.record_batch({"token": pa.array(token, pa.int64()), "n": pa.array(counts[token], pa.int64())})


@dataclass(frozen=True)
class Statistics:
    """How rare each token is, and the mean length."""

    idf: np.ndarray
    mean: float

    def weights(self, tf: np.ndarray, token: np.ndarray, length: np.ndarray | int) -> np.ndarray:
        return self.idf[token] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / self.mean))


def statistics(rests: DataFrame, n: int, tokens: int) -> Statistics:
    """Counted over all rests; a row for each id of the tokenizer at most comes to the driver."""
    found = rests.select("ids").mapInArrow(_distinct_tokens, "token long, n long").groupBy("token").agg(F.sum("n").alias("n")).toArrow()
    df = np.zeros(1 << 16)
    df[found["token"].to_numpy()] = found["n"].to_numpy()
    return Statistics(np.log1p((n - df + 0.5) / (df + 0.5)).astype(np.float32), max(1.0, tokens / max(1, n)))


def heaviest(stats: Statistics) -> Callable:
    """A column function: the two tokens of greatest BM25 weight, the heaviest first."""

    def terms(ids: pa.Array) -> pa.Array:
        out = []
        for x in ids:
            a = np.frombuffer(x.as_buffer(), dtype=np.uint16)
            token, tf = np.unique(a, return_counts=True)
            weight = stats.weights(tf, token, len(a))
            out.append(token[np.argsort(-weight, kind="stable")[:2]].astype(np.int32))
        return lists(pa.array(np.concatenate(out) if out else np.zeros(0, dtype=np.int32), pa.int32()), np.array([len(x) for x in out], dtype=np.int64))

    return arrow_column(pa.list_(pa.int32()))(terms)


# A shard


class Index:
    """The inverted index of a shard's rests."""

    def __init__(self, ids: list[np.ndarray], stats: Statistics):
        sizes = np.array([len(x) for x in ids], dtype=np.int64)
        key = np.repeat(np.arange(len(ids), dtype=np.int64) << 16, sizes) | np.concatenate(ids)
        key, tf = np.unique(key, return_counts=True)
        row, token = key >> 16, key & 0xFFFF
        self.term_of, self.token = np.searchsorted(row, np.arange(len(ids) + 1)), token
        order = np.argsort(token, kind="stable")
        self.row, self.weight = row[order], stats.weights(tf, token, sizes[row])[order]
        self.first = np.searchsorted(token[order], np.arange((1 << 16) + 1))
        self.n = len(ids)

    def scores(self, seed: int) -> np.ndarray:
        """The BM25 score of every rest for the seed's terms."""
        terms = self.token[self.term_of[seed] : self.term_of[seed + 1]]
        a = self.first[terms]
        n = self.first[terms + 1] - a
        at = np.repeat(a - (np.cumsum(n) - n), n) + np.arange(n.sum())
        return np.bincount(self.row[at], weights=self.weight[at], minlength=self.n)


def powers_of_two(n: int) -> list[int]:
    return [1 << k for k in reversed(range(n.bit_length())) if n >> k & 1]


def packed(ids: list[np.ndarray], stats: Statistics) -> list[list[tuple[int, int, int]]]:
    """Sequences, each of pieces (rest, from, to), that hold every id of the shard's rests once."""
    sizes = np.array([len(x) for x in ids], dtype=np.int64)
    index, unused = Index(ids, stats), np.ones(len(ids), dtype=bool)
    seeds = iter(np.argsort(-sizes, kind="stable").tolist())
    out: list[list[tuple[int, int, int]]] = []
    cut: tuple[int, int] | None = None
    while True:
        window, room = [], WINDOW
        seed = cut[0] if cut else next((i for i in seeds if unused[i]), None)
        if seed is None:
            return out
        scores = index.scores(seed)
        scores[~unused] = -1
        scores[seed] = np.inf
        for i in np.argsort(-scores, kind="stable").tolist():
            if scores[i] < 0:
                break
            begin = cut[1] if cut and cut[0] == i else 0
            end = min(int(sizes[i]), begin + room)
            window.append((i, begin, end))
            unused[i] = False
            cut = (i, end) if end < sizes[i] else None
            room -= end - begin
            if not room:
                break
        out += [window] if not room else _divided(window, powers_of_two(WINDOW - room))


def _divided(window: list[tuple[int, int, int]], sizes: list[int]) -> list[list[tuple[int, int, int]]]:
    """A window's pieces cut anew, for sequences of these sizes."""
    out, left = [], list(reversed(window))
    for size in sizes:
        out.append([])
        while size:
            i, begin, end = left.pop()
            take = min(size, end - begin)
            out[-1].append((i, begin, begin + take))
            size -= take
            if begin + take < end:
                left.append((i, begin + take, end))
    return out


PIECES = "doc_id {}, doc_tokens long, start long, ids binary, sequence_id long, offset long"


def shard_packer(stats: Statistics) -> Callable:
    """A function of a task's rests, in order, to their pieces; odd sequence numbers that begin with the task's."""

    def pack_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequence = TaskContext.get().partitionId() << 34
        held: list[pa.RecordBatch] = []
        tokens = rows = 0

        def flush() -> pa.RecordBatch:
            nonlocal sequence
            shard = pa.Table.from_batches(held).combine_chunks()
            ids = [np.frombuffer(x.as_buffer(), dtype=np.uint16) for x in shard["ids"]]
            of, start, body, number, offset = [], [], [], [], []
            first = shard["start"].to_pylist()
            for pieces in packed(ids, stats):
                at = 0
                for i, begin, end in pieces:
                    of.append(i)
                    start.append(first[i] + begin)
                    body.append(ids[i][begin:end].tobytes())
                    number.append(2 * sequence + 1)
                    offset.append(at)
                    at += end - begin
                sequence += 1
            kept = shard.select(["doc_id", "doc_tokens"]).take(pa.array(of, pa.int64())).combine_chunks()
            columns = [c.combine_chunks() for c in kept.columns]
            return pa.record_batch([*columns, pa.array(start, pa.int64()), pa.array(body, pa.binary()), pa.array(number, pa.int64()), pa.array(offset, pa.int64())], names=["doc_id", "doc_tokens", "start", "ids", "sequence_id", "offset"])

        for batch in batches:
            sizes = np.diff(np.frombuffer(batch["ids"].buffers()[1], dtype=np.int32, count=batch["ids"].offset + len(batch) + 1)[batch["ids"].offset :]) // 2 if len(batch) else []
            begin = 0
            for i, n in enumerate(sizes):
                tokens, rows = tokens + int(n), rows + 1
                if tokens >= SHARD_TOKENS or rows >= SHARD_ROWS:
                    held.append(batch.slice(begin, i + 1 - begin))
                    yield flush()
                    held, begin, tokens, rows = [], i + 1, 0, 0
            if begin < len(batch):
                held.append(batch.slice(begin))
        if held:
            yield flush()

    return pack_shards


def pack(docs: DataFrame, tokenizer: tuple[str, str | None] | None = None) -> DataFrame:
    """`doc_id, text` to pieces: doc_id, doc_tokens, start, ids (16 bits each, little-endian), sequence_id, offset."""
    windows = settled(tokenized(docs, tokenizer or default_tokenizer()))
    full = F.octet_length("ids") == 2 * WINDOW
    heads = windows.where(full).withColumns({"sequence_id": F.monotonically_increasing_id() * 2, "offset": F.lit(0).cast("long")})
    rests = windows.where(~full)
    n, size = rests.agg(F.count("*"), F.sum(F.octet_length("ids"))).first()
    tokens = (size or 0) // 2
    stats = statistics(rests, n, tokens)
    keyed = rests.withColumn("terms", heaviest(stats)("ids"))
    order = [F.element_at("terms", 1), F.try_element_at("terms", F.lit(2)), F.xxhash64("ids", "doc_id", "start")]
    dealt = keyed.repartitionByRange(max(1, -(-tokens // TASK_TOKENS)), *order).sortWithinPartitions(*order)
    kind = dict(windows.dtypes)["doc_id"]
    tails = dealt.select("doc_id", "doc_tokens", "start", "ids").mapInArrow(shard_packer(stats), PIECES.format(kind))
    return heads.select(*tails.columns).unionByName(tails)


@arrow_column(pa.int64())
def ids_crc32(ids: pa.Array) -> pa.Array:
    """The CRC of 16-bit ids as unsigned, little-endian 32-bit numbers."""
    return pa.array([zlib.crc32(np.frombuffer(x.as_buffer(), dtype="<u2").astype("<u4").tobytes()) for x in ids], pa.int64())


def op12_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents").select("doc_id", "text"))
    length = F.expr("octet_length(ids) div 2").cast("long")
    return pieces.select("doc_id", "start", length.alias("length"), ids_crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
