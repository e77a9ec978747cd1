"""Repairs against all edits of short conversations, and chains of blocks against whole ones."""

import hashlib
import itertools
import random
import re
import zlib

import xxhash

from svloom.llm import conversation_repair as R

from .helpers import folder

TURNS = "conv_id long, turn long, role string, text string"
WHITE = " \t\n\x0b\x0c\r"


def brute_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = role if role is not None else " ", text if text is not None else " "
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        out += [(conv, turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def brute_repair(rows):
    """(cost, audit, repaired rows) of all edits, tried one by one."""
    seen, states = set(), []
    for role, text in rows:
        bare = text.strip(WHITE)
        states.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    choices = []
    for (role, text), state in zip(rows, states, strict=True):
        own = [(2, "D", None)]
        if state not in ("blank", "duplicate"):
            more = 5 if state else 0
            own += [(more, "K", (role, text))] + [(1 + more, "R", (r, text)) for r in ("user", "assistant")]
        choices.append(own)
    best = None
    most = 2 * len(rows) // 5
    inserts = [[]]
    for n in range(1, most + 1):
        for slots in itertools.combinations_with_replacement(range(len(rows) + 1), n):
            inserts += [list(zip(slots, roles, strict=True)) for roles in itertools.product(("user", "assistant"), repeat=n)]
    for picked in itertools.product(*choices):
        if best and sum(p[0] for p in picked) > best[0]:
            continue
        for extra in inserts:
            edits = [p for i in range(len(rows) + 1) for p in [*[(5, "I", (r, "")) for at, r in extra if at == i], *picked[i : i + 1]]]
            value = (sum(e[0] for e in edits), "".join(e[1] for e in edits))
            left = [e[2] for e in edits if e[2]]
            if (best is None or value < best[:2]) and all(r[0] for r in left) and re.fullmatch("(s?(ua)+)?", "".join(r[0][0] for r in left)):
                best = (*value, left)
    return states, best


def hash_of(text):
    """Spark's xxhash64, by which rows of one turn and role are ordered."""
    return (xxhash.xxh64(text.encode(), seed=42).intdigest() + (1 << 63)) % (1 << 64)


def brute_row(conv, rows):
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], hash_of(r[3])))
    turns = [r[1] for r in rows if r[1] is not None]
    states, (cost, audit, left) = brute_repair([r[2:] for r in rows])
    pairs = [a[2][:1] + b[2][:1] for a, b in itertools.pairwise(rows)]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    text = "\n".join(f"{r}:{t}" for r, t in left)
    return (conv, gaps, *[states.count(s) for s in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256(text.encode()).hexdigest())


def some_rows(rng, conv, n):
    texts = ["Yes.", "No!", "cut", "", " \n", "Why?", "é.", "x" * 50_000 + "."]
    return [(conv, rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None]), rng.choice([*texts, None])) for _ in range(n)]


def same(got, want):
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)


def test_query_against_all_edits(spark, tmp_path):
    rng = random.Random(4)
    rows = [r for c in [None, *range(90)] for r in some_rows(rng, c, rng.randrange(1, 6))]
    rows += [(900, 0, "user", "Again."), (900, 0, "user", "Again."), (901, None, None, None)]
    got = R.op11_repair_conversations(spark, folder(spark, tmp_path, conversations=spark.createDataFrame(rows, TURNS).repartition(3)))
    assert got.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    after = brute_damage(rows)
    want = [brute_row(c, [r for r in after if r[0] == c]) for c in {r[0] for r in rows}]
    same(got.collect(), want)
    assert {x for r in want for x in r[7]} == set("DKR")  # deleting a row is always cheaper than inserting one


def test_blocks_chain_to_the_whole():
    rng = random.Random(9)
    kinds = [R.symbol(i, s) for i in R.INITIALS for s in range(3)]
    for _ in range(150):
        whole = "".join(rng.choices(kinds, k=rng.randrange(1, 40)))
        ((last, (cost, audit)),) = R.lightest(whole).items()
        parts = [whole[i : i + 3] for i in range(0, len(whole), 3)]
        spans = [{(q, r): v for q in ("b" if i == 0 else "bsua") for r, v in R.lightest(p, q, False).items()} for i, p in enumerate(parts)]
        c, a, path = R.chained(spans)
        assert (c, a) == (cost, audit) and last in R.GOAL
        rows = [(3 * i + r if r >= 0 else -1, e, role) for i, (p, (q, x)) in enumerate(zip(parts, path, strict=True)) for r, e, role in R.applied(p, q, x)]
        assert rows == R.applied(whole, "b", audit)


def test_many_blocks_give_the_same(spark, tmp_path, monkeypatch):
    rng = random.Random(5)
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "cut", "No!"]) + f" {t}" + rng.choice([".", ""])) for c in range(6) for t in range(rng.randrange(1, 90))]
    path = folder(spark, tmp_path, conversations=spark.createDataFrame(rows, TURNS))
    want = R.op11_repair_conversations(spark, path).collect()
    monkeypatch.setattr(R, "BLOCK_BITS", 2)
    same(R.op11_repair_conversations(spark, path).collect(), list(map(tuple, want)))


def test_real_outputs(spark):
    turns = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "There you are."), (2, 0, "assistant", "Hello.")], TURNS)
    planned, rows = R.repair(turns)
    assert {r.conv: (r.plan.cost, r.plan.audit) for r in planned.collect()} == {"c1": (1, "KR"), "c2": (2, "D")}
    assert [(r.edit, r.role, r.text) for r in rows.orderBy("conv", "block", "place").collect()] == [("K", "user", "Hi."), ("R", "assistant", "There you are.")]


def test_long_conversation_takes_bounded_work():
    kinds = [R.symbol(i, s) for i in "ua" for s in range(3)]
    rng = random.Random(1)
    whole = "".join(rng.choices(kinds, k=60_000))
    parts = [whole[i : i + 1024] for i in range(0, len(whole), 1024)]
    spans = [{(q, r): v for q in ("b" if i == 0 else "bsua") for r, v in R.lightest(p, q, False).items()} for i, p in enumerate(parts)]
    cost, audit, path = R.chained(spans)
    assert len(path) == len(parts) and sum(x != "I" for x in audit) == len(whole)


def test_empty_table(spark, tmp_path):
    turns = spark.createDataFrame([(1, 0, "user", "x")], TURNS).limit(0)
    assert R.op11_repair_conversations(spark, folder(spark, tmp_path, conversations=turns)).count() == 0
