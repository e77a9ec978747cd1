"""Other breakpoints from simulated fragments: the sample's bases are known by their places in the reference."""

import random

import pytest
from pyspark.sql import functions as F

from svloom.functions import reads as R

READ, MEAN = 100, 350
P, Q = 5_000, 5_900


def sample(kind, p, q, size=12_000):
    """(place, strand) of each base of a sample with one event between p and q."""
    plus = [(i, 1) for i in range(size)]
    if kind == "DEL":
        return plus[:p] + plus[q:]
    if kind == "DUP":
        return plus[:q] + plus[p:]
    return plus[:p] + [(i, -1) for i in range(q - 1, p - 1, -1)] + plus[q:]


def aligned(bases):
    """The longest straight part of a read, bases in the order of the read: (pos, aend, is_reverse, bases before, bases after)."""
    cuts = [0] + [i for i in range(1, len(bases)) if bases[i][1] != bases[i - 1][1] or bases[i][0] - bases[i - 1][0] != bases[i][1]] + [len(bases)]
    a, b = max(zip(cuts, cuts[1:]), key=lambda c: c[1] - c[0])
    places = [x for x, _ in bases[a:b]]
    reverse = bases[a][1] < 0
    before, after = a, len(bases) - b
    return min(places), max(places) + 1, reverse, *((after, before) if reverse else (before, after))


def fragments(kind, rng, n=400):
    """Reads of fragments around the event with what their alignment shows, and the place they should name."""
    out = []
    bases = sample(kind, P, Q)
    for _ in range(n):
        o = rng.choice([P, Q, Q if kind == "DUP" else P]) - rng.randrange(-READ, MEAN + 50)
        piece = bases[o : o + MEAN]
        one, two = piece[:READ], [(x, -s) for x, s in piece[::-1][:READ]]
        for read, mate in ((one, two), (two, one)):
            pos, aend, reverse, left, right = aligned(read)
            mpos, mend, mreverse, mleft, mright = aligned(mate)
            if mleft or mright or left and right:
                continue
            tlen = max(aend, mend) - min(pos, mpos)
            out.append({"kind": kind, "pos": pos, "aend": aend, "mate_pos": mpos, "is_reverse": reverse, "mate_is_reverse": mreverse, "tlen": tlen, "clip_left": left, "clip_right": right, "rlen": READ, "chrom": "1", "mate_chrom": "1", "mate_is_unmapped": False})
    return out


def suggests(r):
    """The type of the pair."""
    if r["is_reverse"] == r["mate_is_reverse"]:
        return "INV"
    if (r["pos"] < r["mate_pos"]) == r["is_reverse"]:
        return "DUP"
    return "DEL" if r["tlen"] > MEAN + 100 else "NONE"


@pytest.mark.parametrize("kind", ["DEL", "DUP", "INV"])
def test_clipped_reads_name_the_other_breakpoint(spark, kind):
    rows = [r for r in fragments(kind, random.Random(kind)) if suggests(r) == kind and min(r["clip_left"] + r["clip_right"], 50) >= 10]
    assert len(rows) > 20
    df = spark.createDataFrame(rows)
    clip = F.struct((F.col("clip_left") + F.col("clip_right")).alias("len"), F.when(F.col("clip_left") > 0, 0).otherwise(READ - F.col("clip_right")).alias("left"), F.when(F.col("clip_right") > 0, 0).otherwise(READ - F.col("clip_left")).alias("right"))
    at = F.when(F.col("clip_left") > 0, F.col("pos")).otherwise(F.col("aend")).cast("bigint")
    got = df.select("*", at.alias("at"), R.other_breakpoint(F.lit(kind), at, clip, MEAN).alias("other")).collect()
    told = [r for r in got if r["other"] is not None]
    assert len(told) > 0.5 * len(got) and {r["is_reverse"] for r in told} == {True, False}
    for r in told:
        assert r["other"] == {P: Q, Q: P}[r["at"]], r


@pytest.mark.parametrize("kind", ["DEL", "DUP", "INV"])
def test_whole_reads_name_the_other_breakpoint(spark, kind):
    rows = [r for r in fragments(kind, random.Random(kind)) if suggests(r) == kind and not r["clip_left"] + r["clip_right"]]
    assert len(rows) > 20
    df = spark.createDataFrame([r | {"at": at} for r in rows for at in (P, Q)])
    near = F.least(F.abs(F.col("pos") - F.col("at")), F.abs(F.col("aend") - F.col("at"))) < MEAN - READ
    got = df.where(near).select("*", R.neighbour_breakpoint(F.lit(kind), F.col("at"), MEAN).alias("other")).where("other IS NOT NULL").collect()
    right = [r for r in got if r["other"] == {P: Q, Q: P}[r["at"]]]
    assert len(right) > 20 and len(right) >= 0.9 * len([r for r in got if (r["pos"] >= r["at"] - 1 or r["aend"] <= r["at"] + 1)])
    assert {r["is_reverse"] for r in right} == {True, False}
