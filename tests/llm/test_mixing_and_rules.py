import random
from collections import Counter

from svloom.llm import mixing, quality_rules

from .helpers import DOCS, documents, folder, sentence, words


def targets(sizes, weights=(5, 2, 1), most=3):
    """Water filling by repeated sharing."""
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, target, open_ = sum(sizes.values()), {}, set(names)
    while open_:
        left = total - sum(target.values())
        share = sum(weight[s] for s in open_)
        over = [s for s in open_ if left * weight[s] / share > most * sizes[s] + 1e-9]
        if not over:
            return target | {s: left * weight[s] / share for s in open_}
        for s in over:
            target[s] = most * sizes[s]
        open_ -= set(over)
    return target


def test_mix(spark, tmp_path):
    rng = random.Random(1)
    texts = [sentence(rng, rng.randrange(1, 60)) for _ in range(200)] + [None, "", " \t\n "]
    sources = [rng.choice(["a", "b", "b", "b", "é", None]) for _ in texts]
    sf = folder(spark, tmp_path, documents=documents(spark, texts, sources))
    got = mixing.op1_mix_sources(spark, sf).toPandas().set_index("doc_id").sort_index()
    assert got.index.is_unique and len(got) == len(texts)
    sizes = Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len(words(t))
    want = targets(sizes)
    taken = Counter()
    for i, (t, s) in enumerate(zip(texts, sources)):
        r = got.loc[i]
        assert r["size"] == len(words(t)) and r.source_size == sizes[s] and abs(r.target - want[s]) < 1e-6
        assert 0 <= r.taken <= 3 * r["size"]
        taken[s] += r.taken
    assert all(abs(taken[s] - want[s]) <= 2 for s in sizes)
    assert sum(taken.values()) == sum(sizes.values())
    again = mixing.op1_mix_sources(spark, sf).toPandas().set_index("doc_id").sort_index()
    assert (again.taken.sort_index() == got.taken.sort_index()).all()


def test_truncation_of_the_global_order(spark):
    """What is taken is what a plain walk along all copies by virtual finish time serves before the budget ends."""
    rng = random.Random(24)
    for share in (1.0, 0.4, 2.5):
        rows = [(i, rng.choice(["a", "b", "b", "c", None]), rng.choice([0, 1, 5, 30, 900])) for i in range(150)]
        got = {r["doc_id"]: r for r in mixing.fair_queue(spark.createDataFrame(rows, "doc_id long, source string, size long"), budget_share=share).collect()}
        line = []
        for i, _, n in rows:
            r = got[i]
            through = round(r["virtual_finish"] * r["target"]) if n else 0
            for k in range(3 if n else 0):
                begin, end = through - n + k * r["source_size"], through + k * r["source_size"]
                cut = [begin, round(r["target"]), end] if begin < round(r["target"]) < end else [begin, end]
                line += [(round(b / r["target"], 9), b - a, i) for a, b in zip(cut, cut[1:])]
        left, taken = int(sum(n for _, _, n in rows) * share + 0.5), Counter()
        for _, n, i in sorted(line, key=lambda x: x[:2]):
            taken[i] += min(n, left)
            left -= min(n, left)
        # Parts of the same time and length may change places where the budget ends.
        assert sum(abs(taken[i] - r["taken"]) for i, r in got.items()) <= 4


def test_mix_of_odd_rows(spark):
    """Null ids stay in the mix; equal rows come back as one with their copies; a long text is one document."""
    rows = [(None, "a b c", "x"), (None, None, "x"), (1, "a b c", "x"), (1, "a b c", "x"), (1, "other text", "y"), (2, "w " * 150_000, None), (3, "", "y")]
    docs = spark.createDataFrame([(i, t, "en", s, 0) for i, t, s in rows], DOCS)
    stage = mixing.mix_stage(spark, docs, "")
    assert stage.columns == ["doc_id", "text", "lang", "source", "n_chars", "virtual_finish", "copies", "taken"]
    got = {(r["doc_id"], r["source"]): (r["copies"], r["taken"]) for r in stage.collect()}
    assert got[None, "x"] == (3, 9) and got[1, "x"] == (6, 18) and got[1, "y"] == (3, 6) and set(got) == {(None, "x"), (1, "x"), (1, "y"), (2, None)}
    assert sum(t for _, t in got.values()) == sum(len(words(t)) for _, t, _ in rows)
    assert mixing.fair_queue(docs.selectExpr("doc_id", "source", "length(text) AS size")).count() == len(rows)


def test_mix_of_nothing(spark, tmp_path):
    assert mixing.op1_mix_sources(spark, folder(spark, tmp_path, documents=spark.createDataFrame([], DOCS))).count() == 0


def test_copies_follow_the_schedule(spark):
    docs = documents(spark, ["a b c", "d e", "f"], ["x", "x", "y"])
    got = mixing.mixed_copies(docs).toPandas()
    served = mixing.fair_queue(docs.selectExpr("doc_id", "source", "size(split(text, ' ')) AS size")).toPandas().set_index("doc_id").sort_index()
    assert got.groupby("doc_id").words.sum().to_dict() == served.taken[served.taken > 0].to_dict()


def brute_stats(t):
    w = words(t)
    seen, dups = set(), 0
    for line in (t or "").split("\n"):
        if words(line):
            dups += line in seen
            seen.add(line)
    c = Counter(tuple(w[i : i + 5]) for i in range(len(w) - 4))
    cover = {j for i in range(len(w) - 4) if c[tuple(w[i : i + 5])] > 1 for j in range(i, i + 5)}
    return len(w), sum(map(len, w)), sum(x in "#*$%&|<>" for x in t or ""), dups, len(cover)


def test_quality_rules(spark, tmp_path):
    rng = random.Random(2)
    phrase = sentence(rng, 7)
    texts = [sentence(rng, 30) + "\n" + sentence(rng, 5) for _ in range(60)] + [None, "", "short one", (phrase + " ") * 9, "a\na\nb\r\nb\n\x1cé# ß|\n" + sentence(rng, 20), "x\x0by\x0cz", phrase + "\n" + phrase]
    texts += [f"Subscribe to our letter now\nall rights reserved by us\n{i} tail words" + " pad" * 3 for i in range(40)]
    sf = folder(spark, tmp_path, documents=documents(spark, texts, ["h"] * len(texts)))
    got = quality_rules.op10_quality_rules(spark, sf).toPandas().set_index("doc_id").sort_index()
    for i, t in enumerate(texts):
        r, want = got.loc[i], brute_stats(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0])
        assert not (r.base_failed and r.kept)
    assert got.loc[:59].kept.all()
    assert (got.loc[67:].frequent_words > 0).all()


def test_copies_are_one_document(spark, tmp_path):
    """Exact copies don't make their lines frequent; boilerplate of different documents does, and depletes."""
    rng = random.Random(3)
    copy = sentence(rng, 40)
    texts = [copy] * 50 + ["same words stand here in every single page of this site\n" + f"n{i}" for i in range(30)] + [sentence(rng, 40) for _ in range(20)]
    sf = folder(spark, tmp_path, documents=documents(spark, texts, ["h"] * len(texts)))
    got = quality_rules.op10_quality_rules(spark, sf).toPandas().set_index("doc_id").sort_index()
    assert got.loc[:49].kept.all() and got.loc[80:].kept.all()
    assert not got.loc[50:79].kept.any()


def test_frequent_lines_are_removed(spark):
    """Each text comes back without its frequent lines, and the query's counts are those of what stays."""
    rng = random.Random(4)
    own = [sentence(rng, 12) for _ in range(40)]
    texts = [f"All rights  reserved\r\n\n{t}\nall RIGHTS reserved\ntail {i}" for i, t in enumerate(own)] + [sentence(rng, 20), None, "", "\n \n"]
    docs = documents(spark, texts, ["h"] * len(texts)).selectExpr("doc_id AS row_id", "source AS host", "text")
    got = {r["row_id"]: r for r in quality_rules.without_frequent_lines(docs).collect()}
    want = [f"\n{t}\ntail {i}" for i, t in enumerate(own)] + [texts[40], "", "", "\n \n"]
    assert [got[i]["text"] for i in range(len(texts))] == want
    rules = {r["row_id"]: r["frequent_words"] for r in quality_rules.quality_rules(docs).collect()}
    assert all(rules[i] == len(words(texts[i])) - len(words(want[i])) == got[i]["n_words"] - got[i]["n_left"] for i in rules)


def test_rules_of_odd_rows(spark, tmp_path):
    """Null and repeated ids are judged by their own text, and a long text is counted whole."""
    rng = random.Random(5)
    long = "\n".join(sentence(rng, 12) for _ in range(12_000))
    rows = [(None, sentence(rng, 20)), (None, "short"), (1, sentence(rng, 20)), (1, "short"), (2, long), (2, long)]
    docs = spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS)
    got = quality_rules.op10_quality_rules(spark, folder(spark, tmp_path, documents=docs)).collect()
    want = Counter((i, len(words(t)), len(words(t)) >= 10) for i, t in rows)
    assert Counter((r["doc_id"], r["n_words"], r["kept"]) for r in got) == want


def test_rules_of_nothing(spark, tmp_path):
    assert quality_rules.op10_quality_rules(spark, folder(spark, tmp_path, documents=spark.createDataFrame([], DOCS))).count() == 0


def test_limits_act_on_given_tables(spark):
    """A line that a tenth of all hosts' documents share goes, and no more than it."""
    found = quality_rules.op10_quality_rules(spark, "/root/testdata/sf0.01").select("frequent_words").where("frequent_words > 0").collect()
    assert 50 < len(found) < 200 and {r[0] for r in found} == {9}
