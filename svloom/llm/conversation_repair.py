"""Conversation structure repair: the cheapest edits that turn each conversation into `(s?(ua)+)?`.

Rows are kept (0), given another role (1), deleted (2; blank and repeated ones must be), or
inserted (5); a truncated row that stays costs 5 more. Of equally cheap repairs the one with the least
audit (the edits' initials in order: D, I, K, R) is taken.

A repair is a derivation in a weighted hypergraph. An item is (rows read, last role written); a rule
takes an item, and perhaps the next row, to another item, and its function adds the edit's cost and
initial to the item's (cost, audit), which thereby never gets less. So Knuth's generalisation of
Dijkstra's algorithm holds: items are popped from an agenda by (cost, audit), each is final when it
is popped first, and the first accepting item popped is the goal.

A conversation may hold any share of the rows, so none is gathered:

1. rows without their texts (hashes stand for them) are range-sorted by conversation and turn and dealt
   to blocks of at most 1,024;
2. each block gives spans: the lightest derivation from each role that can come before it to each that
   can come after it, by the agenda above. A block that is a whole conversation stops at its goal. (Two audits of one cost that
   lead from one item to another hold as many rows, and so as many inserts: neither begins the other, and
   whatever follows leaves their order as it is.)
3. spans of a conversation are chained in order. For each role only the lightest chain stays; what
   all of them begin with is settled and put away. This takes a byte for each row, as the audit itself;
4. edits go back to their blocks, and to the texts by (conversation, role, hash of the text), of which one
   row at most stays in a conversation.

Rows of one turn come by role, then by a hash of their text; a null turn comes first; a null role or text
is one space; a null conv_id is a conversation like others. A role's initial is its first character, so an
empty role, like an unknown one, must be changed or deleted. A very long text is hashed where it
stands and moved once. Repeated rows are repeats and go. An empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from heapq import heappop, heappush
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table
from .kernels import arrow_column

BLOCK_BITS = 10
COST = {"K": 0, "R": 1, "D": 2, "I": 5}
TRUNCATED = 5
WHITE = " \t\n\x0b\x0c\r"
#: Roles' initials in symbols of rows; the last is any other.
INITIALS = "sua."
#: What a row is, beside its initial.
FINE, CUT_SHORT, UNFIT = range(3)
#: Which roles may be followed by which; `b` is the beginning.
BEFORE = {"s": "b", "u": "bsa", "a": "u"}
GOAL = "ba"


def symbol(initial: str, state: int) -> str:
    """A row as one character."""
    return chr(65 + 3 * INITIALS.index(initial) + state)


def meaning(symbol: str) -> tuple[str, int]:
    k, state = divmod(ord(symbol) - 65, 3)
    return INITIALS[k], state


def row_edits(symbol: str, last: str) -> list[tuple[str, int, str]]:
    """(edit, cost, last role then) for a row after `last`."""
    initial, state = meaning(symbol)
    out = [("D", COST["D"], last)]
    if state != UNFIT:
        extra = TRUNCATED if state == CUT_SHORT else 0
        out += [("R", COST["R"] + extra, role) for role in "ua" if last in BEFORE[role]]
        if initial in BEFORE and last in BEFORE[initial]:
            out.append(("K", COST["K"] + extra, initial))
    return out


INSERTS = {last: [role for role in "ua" if last in BEFORE[role]] for last in "bsua"}


@lru_cache(1 << 14)
def lightest(symbols: str, entry: str = "b", to_goal: bool = True) -> dict[str, tuple[int, str]]:
    """Knuth's algorithm: the least (cost, audit) for each last role after all rows; only the goal's if that is wanted."""
    agenda: list[tuple[int, str, int, str]] = [(0, "", 0, entry)]
    final: set[tuple[int, str]] = set()
    ends: dict[str, tuple[int, str]] = {}
    moves = {(x, last): row_edits(x, last) for x in set(symbols) for last in "bsua"}
    while agenda:
        cost, audit, read, last = heappop(agenda)
        if (read, last) in final:
            continue
        final.add((read, last))
        if read == len(symbols):
            ends[last] = (cost, audit)
            if to_goal and last in GOAL:
                return {last: (cost, audit)}
        else:
            for edit, more, then in moves[symbols[read], last]:
                heappush(agenda, (cost + more, audit + edit, read + 1, then))
        for role in INSERTS[last]:
            heappush(agenda, (cost + COST["I"], audit + "I", read, role))
    return ends


def chained(spans: Iterator[dict[tuple[str, str], tuple[int, str]]]) -> tuple[int, str, list[tuple[str, str]]]:
    """(cost, audit, [(entry, letters) of each block]) of the lightest derivation through blocks' spans, {(entry, exit): (cost, audit)}.

    Audits of the roles that are open differ in their ends only, as a rule, so comparing them takes little.
    """
    best: dict[str, tuple[int, str]] = {"b": (0, "")}  # by last role; audits without what all have in common
    back: list[dict[str, tuple[str, str]]] = []
    done: list[str] = []
    for block in spans:
        after: dict[str, tuple[int, str]] = {}
        back.append({})
        for (entry, last), (cost, audit) in block.items():
            if entry in best:
                value = (best[entry][0] + cost, best[entry][1] + audit)
                if last not in after or value < after[last]:
                    after[last], back[-1][last] = value, (entry, audit)
        common = commonprefix([audit for _, audit in after.values()])
        done.append(common)
        best = {last: (cost, audit[len(common) :]) for last, (cost, audit) in after.items()}
    (cost, rest), last = min((best[q], q) for q in GOAL if q in best)
    path = []
    for step in reversed(back):
        entry, letters = step[last]
        path.append((entry, letters))
        last = entry
    return cost, "".join([*done, rest]), path[::-1]


def applied(symbols: str, entry: str, letters: str) -> list[tuple[int, str, str]]:
    """(row or -1, edit, role or '' for the row's own) of what a block's edits leave."""
    out, read, last = [], 0, entry
    for edit in letters:
        if edit == "K":
            last = meaning(symbols[read])[0]
        elif edit != "D":
            last = "a" if last == "u" else "u"
        if edit != "D":
            out.append((-1 if edit == "I" else read, edit, {"u": "user", "a": "assistant"}[last] if edit != "K" else ""))
        read += edit != "I"
    return out


_SPAN = pa.struct([("entry", pa.string()), ("exit", pa.string()), ("cost", pa.int64()), ("audit", pa.string())])
_CHAIN = pa.struct([("cost", pa.int64()), ("audit", pa.string()), ("illegal", pa.int64()), ("blocks", pa.list_(pa.struct([("block", pa.int64()), ("entry", pa.string()), ("letters", pa.string())])))])
_EDITS = pa.list_(pa.struct([("row", pa.int32()), ("edit", pa.string()), ("role", pa.string())]))


@arrow_column(pa.list_(_SPAN))
def spans_of(symbols: pa.Array, is_first: pa.Array, is_last: pa.Array) -> pa.Array:
    out = []
    for x, first, last in zip(symbols.to_pylist(), is_first.to_pylist(), is_last.to_pylist(), strict=True):
        out.append([{"entry": q, "exit": r, "cost": c, "audit": a} for q in ("b" if first else "bsua") for r, (c, a) in lightest(x, q, first and last).items()])
    return pa.array(out, pa.list_(_SPAN))


def illegal_pairs(symbols: str) -> int:
    initials = [meaning(x)[0] for x in symbols]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


@arrow_column(_CHAIN)
def chain_of(blocks: pa.Array) -> pa.Array:
    """A conversation's blocks {block, symbols, spans}, in order, to its repair."""
    out = []
    for conversation in blocks:
        rows = conversation.as_py()
        cost, audit, path = chained({(s["entry"], s["exit"]): (s["cost"], s["audit"]) for s in r["spans"]} for r in rows)
        out.append({"cost": cost, "audit": audit, "illegal": illegal_pairs("".join(r["symbols"] for r in rows)), "blocks": [{"block": r["block"], "entry": q, "letters": x} for r, (q, x) in zip(rows, path, strict=True)]})
    return pa.array(out, _CHAIN)


@arrow_column(_EDITS)
def edits_of(symbols: pa.Array, entry: pa.Array, letters: pa.Array) -> pa.Array:
    rows = zip(symbols.to_pylist(), entry.to_pylist(), letters.to_pylist(), strict=True)
    return pa.array([[{"row": r, "edit": e, "role": role} for r, e, role in applied(*x)] for x in rows], _EDITS)


# Rows

KEY = ["conv", "role", "h1", "h2"]


def keyed(turns: DataFrame) -> DataFrame:
    """`conv_id, turn, role, text` with nulls filled, `conv` (a text that stands for the id, null or not), and two hashes of the text."""
    filled = [F.coalesce(F.col(c), F.lit(" ")).alias(c) for c in ("role", "text")]
    conv = F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit(""))
    rows = turns.select(conv.alias("conv"), "turn", *filled)
    return rows.withColumns({"h1": F.xxhash64("text"), "h2": F.xxhash64(F.lit(11), "text")})


def faulty(rows: DataFrame) -> DataFrame:
    """Sorted rows of `keyed`, without texts, with their order `_id` and first fault: blank, duplicate, truncated."""
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    flags = {"initial": F.left("role", F.lit(1)), "blank": F.length(F.rtrim("text", F.lit(WHITE))) == 0, "truncated": ~last.isin(".", "!", "?")}
    narrow = rows.withColumns(flags).drop("text")
    held = settled(narrow.orderBy("conv", F.col("turn").asc_nulls_first(), "role", "h1", "h2")).withColumn("_id", F.monotonically_increasing_id())
    again = held.groupBy(*KEY).agg(F.min("_id").alias("_first"), F.count("*").alias("_n")).where("_n > 1").drop("_n")
    out = held.join(again, KEY, "left").withColumn("duplicate", ~F.col("blank") & F.coalesce(F.col("_id") > F.col("_first"), F.lit(False)))
    return out.withColumn("truncated", F.col("truncated") & ~F.col("blank") & ~F.col("duplicate")).drop("_first")


def blocks_of(rows: DataFrame) -> DataFrame:
    """`faulty` rows by blocks of a conversation: `rows` in order, with `symbols`, and counts of faults."""
    initial = F.when(F.col("initial").isin(*INITIALS[:-1]), F.instr(F.lit(INITIALS), F.col("initial")) - 1).otherwise(len(INITIALS) - 1)
    state = F.when(F.col("blank") | F.col("duplicate"), UNFIT).when(F.col("truncated"), CUT_SHORT).otherwise(FINE)
    code: Column = F.char(65 + 3 * initial + state)
    row = F.struct("_id", code.alias("symbol"), "role", "h1", "h2")
    n = lambda c: F.sum(F.col(c).cast("long")).alias(c)
    found = rows.groupBy("conv", F.shiftright("_id", BLOCK_BITS).alias("block")).agg(F.array_sort(F.collect_list(row)).alias("rows"), n("blank"), n("duplicate"), n("truncated"))
    return found.withColumn("symbols", F.array_join(F.transform("rows", lambda r: r["symbol"]), ""))


def plans(blocks: DataFrame) -> DataFrame:
    """`blocks_of` by conversation: conv, faults, and `plan`, its cost, audit, illegal pairs and each block's edits."""
    edges = blocks.groupBy("conv").agg(F.min("block").alias("_low"), F.max("block").alias("_high"))
    spanned = blocks.join(edges, "conv").withColumn("spans", spans_of("symbols", F.col("block") == F.col("_low"), F.col("block") == F.col("_high")))
    faults = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")]
    whole = spanned.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("block", "symbols", "spans"))).alias("parts"), *faults)
    return whole.select("conv", *["blank", "duplicate", "truncated"], chain_of("parts").alias("plan"))


def repaired(rows: DataFrame, blocks: DataFrame, planned: DataFrame) -> DataFrame:
    """conv, block, place: the order of what the repairs leave; edit, role, text."""
    parts = planned.select("conv", F.explode("plan.blocks").alias("p")).select("conv", "p.*")
    edits = parts.join(blocks.select("conv", "block", "rows", "symbols"), ["conv", "block"])
    edits = edits.select("conv", "block", "rows", F.posexplode(edits_of("symbols", "entry", "letters")).alias("place", "e"))
    row = F.try_element_at("rows", F.col("e.row") + 1)
    edits = edits.select("conv", "block", "place", "e.edit", F.col("e.role").alias("new_role"), F.when(F.col("e.row") >= 0, row).alias("r"))
    inserted = edits.where("edit = 'I'").select("conv", "block", "place", "edit", F.col("new_role").alias("role"), F.lit("").alias("text"))
    kept = edits.where("edit <> 'I'").select("conv", "block", "place", "edit", "new_role", "r.role", "r.h1", "r.h2")
    texts = rows.groupBy(*KEY).agg(F.any_value("text").alias("text"))
    role = F.when(F.col("edit") == "R", F.col("new_role")).otherwise(F.col("role"))
    return kept.join(texts, KEY).select("conv", "block", "place", "edit", role.alias("role"), "text").unionByName(inserted)


def repair(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """`conv_id, turn, role, text` to (a row for each conversation, the repaired rows).

    Conversations are known by `conv`, see `keyed`.
    """
    rows = keyed(turns)
    blocks = settled(blocks_of(faulty(rows)))
    planned = settled(plans(blocks))
    return planned, repaired(rows, blocks, planned)


# The query


def damaged(turns: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut short, repeated or given another role by a checksum of their place."""
    text_of = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(text_of("conv_id"), F.lit(":"), text_of("turn"))) % 20
    rows = turns.select("conv_id", "turn", text_of("role").alias("role"), text_of("text").alias("text"), k.alias("_k")).where("_k <> 0")
    text = F.when(F.col("_k") == 1, "").when(F.col("_k") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("_k") == 4, "user").otherwise(F.col("role"))
    times = F.when(F.col("_k") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time")).drop("_time")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted lines to a digest for each conversation; only the hash is held."""
    name, digest = None, hashlib.sha256()
    for batch in batches:
        done: list[tuple[str, str]] = []
        for conv, line in zip(batch["conv"].to_pylist(), batch["line"], strict=True):
            if conv != name:
                if name is not None:
                    done.append((name, digest.hexdigest()))
                name, digest = conv, hashlib.sha256()
            else:
                digest.update(b"\n")
            digest.update(line.as_buffer())
        yield _named(done)
    if name is not None:
        yield _named([(name, digest.hexdigest())])


def _named(done: list[tuple[str, str]]) -> pa.RecordBatch:
    return pa.record_batch({"conv": pa.array([x for x, _ in done], pa.string()), "repaired_sha256": pa.array([x for _, x in done], pa.string())})


def digests(rows: DataFrame) -> DataFrame:
    """`repaired` rows to conv, repaired_sha256. A digest takes its lines one after the other, so a conversation streams through one task."""
    lines = rows.select("conv", "block", "place", F.concat("role", F.lit(":"), "text").cast("binary").alias("line"))
    return lines.repartition("conv").sortWithinPartitions("conv", "block", "place").select("conv", "line").mapInArrow(_digests, "conv string, repaired_sha256 string")


def gaps(turns: DataFrame) -> DataFrame:
    """conv, gaps: how many turns between a conversation's first and last are missing."""
    of = turns.groupBy("conv", "turn").agg(F.lit(1)).groupBy("conv")  # hot turns first
    return of.agg(F.coalesce(F.max("turn") - F.min("turn") + 1 - F.count("turn"), F.lit(0)).cast("long").alias("gaps"))


def op11_repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = damaged(turns)
    planned, left = repair(rows)
    every = turns.select("conv_id").distinct().withColumn("conv", F.coalesce(F.concat(F.lit("c"), F.col("conv_id").cast("string")), F.lit("")))
    found = every.join(planned, "conv", "left").join(gaps(keyed(rows).select("conv", "turn")), "conv", "left").join(digests(left), "conv", "left")
    count = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    counts = {"gaps": "gaps", "blank": "blank", "duplicate": "duplicate", "truncated": "truncated", "illegal": "plan.illegal", "cost": "plan.cost"}
    return found.select("conv_id", *[count(x).alias(c) for c, x in counts.items()], F.coalesce("plan.audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
