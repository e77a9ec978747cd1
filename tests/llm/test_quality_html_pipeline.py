import random
import re
import time
import zlib

import corpus_pipeline
import numpy as np

from svloom.llm import common, html_text, quality

from .helpers import DOCS, documents, folder, sentence, words

LABELS = "doc_id long, quality int, toxic int"


def corpus(rng, n):
    texts, good = [], []
    for i in range(n):
        bad = i % 5 == 0
        t = ". ".join(sentence(rng, 12).capitalize() for _ in range(rng.randrange(3, 9)))
        if bad:
            t = rng.choice([t.upper() + "!!!", " ".join(w + rng.choice(["###", "$$$", "***"]) for w in t.split()), (sentence(rng, 6) + " ") * 12, " | ".join(t.split())])
        texts.append(t)
        good.append(0 if bad else 1)
    return texts, good


def test_quality(spark, tmp_path):
    rng = random.Random(9)
    texts, good = corpus(rng, 400)
    texts += [None, ""]
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)] + [(399, None, 0), (9999, 1, 0)], LABELS)
    sf = folder(spark, tmp_path, documents=documents(spark, texts), labels=labels)
    got = quality.op6_quality(spark, sf).toPandas().set_index("doc_id").sort_index()
    assert len(got) == len(texts) and got.score.between(0, 1).all()
    assert (got.predicted == (got.score >= 0.5)).all()
    assert got.held_out.tolist() == [zlib.crc32(str(i).encode()) % 3 == 1 for i in range(len(texts))]
    unseen = got.loc[:399][got.loc[:399].held_out]
    right = [p == good[i] for i, p in unseen.predicted.items()]
    assert sum(right) / len(right) > 0.95
    again = quality.op6_quality(spark, sf).toPandas().set_index("doc_id").sort_index()
    assert (again.score == got.score).all()


def test_weights_are_those_of_plain_descent():
    """Newton's weights minimise the logistic loss of the contests: descent by small steps from nothing ends there too."""
    rng = np.random.default_rng(25)
    good = (rng.uniform(size=60) < 0.6).astype(int)
    x = rng.normal(size=(60, len(quality.FEATURES))) + good[:, None] * rng.uniform(-1, 1, len(quality.FEATURES))
    ranker = quality.fit_pairs(x, good, pairs_each=4)
    z = np.clip((x - x.mean(0)) / x.std(0), -quality.CLIP, quality.CLIP)
    win, lose = z[good == 1], z[good == 0]
    n = max(len(win), len(lose)) * 4
    contests = [(win[i % len(win)], lose[(i * 7919 + i // len(win)) % len(lose)]) for i in range(n)]
    difference = np.array([a - b for a, b in contests])
    weights = np.zeros(z.shape[1])
    for _ in range(20_000):
        lost = 1 / (1 + np.exp(difference @ weights))
        weights += 0.05 * ((difference * lost[:, None]).mean(0) - 0.01 * weights)
    assert np.abs(weights - ranker.weights).max() < 1e-3
    margins = z @ ranker.weights
    assert (margins < ranker.cut).sum() == (good == 0).sum()


def test_quality_of_odd_rows(spark, tmp_path):
    """Null and repeated ids, equal rows and long texts each get the score of their text."""
    rng = random.Random(26)
    texts, good = corpus(rng, 60)
    long = ". ".join(sentence(rng, 12) for _ in range(10_000))
    rows = [*enumerate(texts), (None, texts[1]), (0, texts[1]), (1, texts[1]), (70, long), (71, long)]
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)] + [(None, 0, 0), (1, 1, 0)], LABELS)
    sf = folder(spark, tmp_path, documents=spark.createDataFrame([(i, t, "en", "s", 0) for i, t in rows], DOCS), labels=labels)
    got = quality.op6_quality(spark, sf).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    of = {}
    for r in got:
        of.setdefault(r["doc_id"], []).append(r["score"])
    assert of[None][0] in of[0] and of[1][0] == of[1][1] == of[None][0] and of[70] == of[71]
    assert [r["held_out"] for r in got if r["doc_id"] is None] == [False]


def test_quality_without_labels(spark, tmp_path):
    sf = folder(spark, tmp_path, documents=documents(spark, ["a b", None]), labels=spark.createDataFrame([], LABELS))
    assert set(quality.op6_quality(spark, sf).toPandas().score) == {0.5}


PAGES = "page_id long, url string, html string"


def extract(spark, tmp_path, *pages):
    sf = folder(spark, tmp_path, pages=spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], PAGES))
    return html_text.op8_html_text(spark, sf).toPandas().set_index("page_id").sort_index()


def test_marked_article(spark, tmp_path):
    page = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style><script>var t="</p>";</script></head><body>
    <nav><ul><li><a href="/a">A</a></li></ul></nav><!-- ad --><div class="ad">Buy</div><article><h1>Head &amp; more</h1><p><b>One
      two.<br><p>Three &lt;b&gt; &#233;</p><div class="share-buttons">Share</div><aside>Side</aside><p>Same</p><p>Same</p><form><input>Send</form></article>
    <div id="comments"><article>Nice!</article></div><footer>&copy; x</footer></body></html>"""
    got = extract(spark, tmp_path, ("http://a.b/1", page), ("http://a.b/2", page), (None, None), ("http://a.b/3", ""), ("x", "<p>open <b>text"), ("y", "plain & simple"))
    want = "Head & more\n\nOne two.\n\nThree <b> é\n\nSame\n\nSame"
    assert got.text.tolist() == [want, want, "", "", "open text", "plain & simple"]
    assert got.n_chars.tolist() == [len(t) for t in got.text]


def test_wrapped_articles_are_not_lost():
    text = lambda page: [t for t, _ in html_text.page_lines(page)]
    story = "<article><p>Story</p><div class='share-buttons'>Share</div></article>"
    for wrap in ('<body class="has-sidebar">{}</body>', '<body class="no-sidebar header-fixed">{}</body>', '<body class="sidebar">{}</body>', '<div id="content-with-sidebar">{}</div>', "<form action=x>{}</form>", '<div class="sidebar-layout">{}</div>', '<div class="related">{}</div>', "<div class=modal><main>{}</main></div>"):
        assert text(wrap.format(story)) == ["Story"], wrap
    assert text('<article class="post comment-open"><p>Story</p></article>') == ["Story"]
    assert text('<article class="post"><p>Story</p><article class="comment">Nice</article></article>') == ["Story"]
    assert text('<form><p>Story</p><input></form>') == ["Story"]
    assert text(f'<div class="sidebar"><article>Teaser</article></div>{story}') == ["Story"]
    assert text('<div id="comments"><article>Nice</article></div><p>Story</p>') == ["Story"]
    assert text("<datalist><option>One<option value=2>Two</datalist><p>Story</p>") == ["Story"]
    assert text("<select><option>One<option>Two<p>Story</p>") == ["Story"]


def test_nothing_else_is_dropped():
    """Names that only hold a frame word, other attributes' values and inline frames cost no text."""
    text = lambda page: [t for t, _ in html_text.page_lines(page)]
    for page, want in (
        ('<body class="no-sidebar"><article><p>Hello world</p></article>', ["Hello world"]),
        ('<main class="with-sidebar"><p>Hello world</p></main>', ["Hello world"]),
        ('<article><div style="overflow:hidden"><p>Body text</p></div><p data-hidden="0">More</p><p hidden>No</p></article>', ["Body text", "More"]),
        ('<article><section id="related-work"><p>Work</p></section><div class="search-results">Results</div><div class="article-header"><h1>Title</h1></div></article>', ["Work", "Results", "Title"]),
        ('<article><p>One <span class="ad">Buy</span> two <b class=x>three</b></p><div class="related-posts">Other</div></article>', ["One two three"]),
        ('<article><p>a < b and c</p><p title="x > y">d</p></article> tail <a href=', ["a < b and c", "d"]),
        ('<p title="it\'s">one</p><p>two" three</p><p title="open>four</p>', ["one", 'two" three', "four"]),
        ("<nav>Menu</nav><footer>Foot</footer>", []),
        ('<div class="header">Site</div><p>Story', ["Story"]),
    ):
        assert text(page) == want, page


def test_long_pages_are_scanned_in_linear_time():
    pages = ["<a " * 1_700_000, "<a b='" * 800_000, "<div>" * 300_000 + "</span>" * 300_000, "<select>" * 500_000, "<" * 2_000_000, '<p class="x' * 400_000 + ">", "<!--" * 1_000_000, "<p>some words of text</p>" * 200_000]
    began = time.process_time()
    for page in pages:
        html_text.page_lines(page)
    assert time.process_time() - began < 40
    rng = random.Random(20)
    a, b = ([rng.randrange(3) if rng.random() < 0.5 else rng.randrange(10**6) for _ in range(12_000)] for _ in range(2))
    began = time.process_time()
    hit = html_text.common_lines(a, b)
    rest = iter(b)
    assert all(a[i] in rest for i in hit) and time.process_time() - began < 20


def test_pairing_deletes_the_shared_frame(spark, tmp_path):
    page = "<body><div>Home</div><p>About</p><p>Story {0} {0}</p><p>More of {0} {0}</p><p>End</p></body>"
    rows = [(f"http://h.org/a/{i:02}", page.format(i)) for i in range(6)] + [("http://alone.org/", page.format("x")), ("http://twin.org/1", page.format("t")), ("http://twin.org/2", page.format("t"))]
    got = extract(spark, tmp_path, *rows)
    assert got.text.tolist()[:6] == [f"Story {i} {i}\n\nMore of {i} {i}" for i in range(6)]
    assert got.text[6] == "Home\n\nAbout\n\nStory x x\n\nMore of x x\n\nEnd"
    assert got.text[7] == got.text[8] == "Home\n\nAbout\n\nStory t t\n\nMore of t t\n\nEnd"


def test_runs_of_copies_look_farther(spark, tmp_path):
    """Copies beside copies find a page that isn't one, and lose the frame that they share with it."""
    page = "<body><div>Home</div><p>About</p><p>Story {0} {0}</p><p>More of {0} {0}</p><p>End</p></body>"
    rows = [(f"http://h.org/a/{i:02}", page.format("same" if i < 7 else i)) for i in range(10)]
    got = extract(spark, tmp_path, *rows)
    assert got.text.tolist() == ["Story same same\n\nMore of same same"] * 7 + [f"Story {i} {i}\n\nMore of {i} {i}" for i in range(7, 10)]


def brute_extract(rows):
    """Pairs pages by sorting all of them, and aligns by the whole table."""
    split = lambda u: re.fullmatch(r"(?:.*?://([^/?#]*)([^?#]*).*)?", u or "", re.S).groups("")
    lines = [html_text.page_lines(h or "") for _, _, h in rows]
    order = sorted(range(len(rows)), key=lambda i: (*split(rows[i][1]), rows[i][0]))
    out = {}
    for k, i in enumerate(order):
        texts, gone = [t for t, _ in lines[i]], set()
        step, copies = 1, True
        mine = [j for j, x in enumerate(order) if split(rows[x][1])[0] == split(rows[i][1])[0]]
        while copies:
            beside = [order[j] for j in (max(k - step, mine[0]), min(k + step, mine[-1])) if j != k]
            copies = bool(beside) and (k - step > mine[0] or k + step < mine[-1])
            step *= 2
            for j in beside:
                hit = html_text.common_lines(texts, [t for t, _ in lines[j]])
                size = lambda some: sum(len(texts[x].split()) for x in some)
                if 2 * size(hit) < size(range(len(texts))):
                    copies = False
                    if hit:
                        gone = {x for x in hit if lines[i][x][1]}
                        break
        out[rows[i][0]] = "\n\n".join(t for x, t in enumerate(texts) if x not in gone)
    return out


def test_extraction_is_that_of_all_pairs(spark, tmp_path):
    """Suspects go where a neighbour shares them, marked articles stay, copies show nothing, repeated rows are each extracted."""
    rng = random.Random(21)
    rows = []
    for i in range(60):
        host = rng.choice(["a.org", "b.org", "c.net", "lone.net" if i == 7 else "a.org"])
        site = f"<div>Top of {host}</div>"
        story = "".join(f"<p>{sentence(rng, rng.randrange(1, 12))}</p>" for _ in range(rng.randrange(6)))
        kind = rng.randrange(4)
        promo = f'<div class="promo-of-{host[0]}">Same promo of {host}</div>'
        body = [f"{site}{story}<p>Foot of {host}</p>", f"<nav>x</nav><article>{story}{promo}</article>", f'<main class="with-menu">{story}</main>{site}', rows[-1][2] if rows else story][kind]
        rows.append((i, f"http://{host}/{rng.choice('xyz')}/{rng.randrange(9)}?q={i}", body))
    rows += [(60, None, "<p>lone</p>"), (61, "http://a.org/z/99", None)]
    got = extract(spark, tmp_path, *(r[1:] for r in rows))
    want = brute_extract(rows)
    assert {i: r.text for i, r in got.iterrows()} == want
    shuffled = html_text.extract_text(spark.createDataFrame(rows, PAGES), broadcast_lines=0)
    assert {r["page_id"]: r["text"] for r in shuffled.collect()} == want
    assert any("Same promo" in t for t in want.values()) and sum("Same promo" in r[2] for r in rows if r[2]) > sum("Same promo" in t for t in want.values())
    pages = spark.createDataFrame([(1, "http://a.org/1", "<p>x</p>")] * 2 + [(1, "http://a.org/2", "<p>y</p>"), (None, None, "<p>z</p>")], PAGES)
    assert sorted(r["text"] for r in html_text.extract_text(pages).collect()) == ["x", "x", "y", "z"]


def lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i in range(len(a)):
        for j in range(len(b)):
            t[i + 1][j + 1] = t[i][j] + 1 if a[i] == b[j] else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


def test_common_lines_are_longest(monkeypatch):
    rng = random.Random(10)
    for k in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(15))] for _ in range(2))
        if k == 100:
            monkeypatch.setattr(html_text, "AT_ONCE", 1)
        hit = html_text.common_lines(a, b)
        rest = iter(b)
        assert hit == sorted(set(hit)) and len(hit) == lcs(a, b) and all(a[i] in rest for i in hit)


def test_numbering_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame([(i * 7919 % 101,) for i in range(101)], "x long").repartition(7)
    assert sorted((r["x"], r["nr"]) for r in common.numbered(df, "x").collect()) == [(i, i) for i in range(101)]


def test_pages_of_nothing(spark, tmp_path):
    assert html_text.op8_html_text(spark, folder(spark, tmp_path, pages=spark.createDataFrame([], PAGES))).count() == 0


def test_pipeline(spark, tmp_path):
    rng = random.Random(11)
    texts, good = corpus(rng, 120)
    item = sentence(rng, 40)
    texts += [texts[1], texts[2].replace(" ", "  "), ". ".join(sentence(rng, 10) for _ in range(4)) + " " + item, ". ".join(sentence(rng, 10) for _ in range(4)) + " token = abcdefgh1234", None]
    good += [1, 1, 1, 1, 1]
    labels = spark.createDataFrame([(i, g, 0) for i, g in enumerate(good)], LABELS)
    sf = folder(spark, tmp_path, documents=documents(spark, texts), labels=labels, benchmark=spark.createDataFrame([(0, item)], "item_id long, text string"))
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        before = {r["doc_id"]: r["text"] for r in docs.collect()}
        out = stage(spark, docs, sf)
        out.write.mode("overwrite").parquet(f"{tmp_path}/out/{name}")
        docs = spark.read.parquet(f"{tmp_path}/out/{name}")
        kept[name] = (before, {r["doc_id"]: r for r in docs.collect()})
        if name != "mixing":
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    before, after = kept["quality"]
    assert sum(good[i] for i in after) / len(after) > 0.95 and sum(i in after for i in range(120) if good[i]) > 90
    before, after = kept["near_duplicates"]
    assert not {120, 121} & set(after) and {1, 2} & set(before) <= set(after)
    before, after = kept["decontamination"]
    assert set(before) - set(after) == {122}
    before, after = kept["secrets"]
    assert set(before) == set(after) and after[123]["text"].endswith("<secret>") and all(after[i]["text"] == before[i] for i in before if i != 123)
    before, after = kept["mixing"]
    assert set(after) <= set(before) and all(0 < r["taken"] <= 3 * len(words(r["text"])) for r in after.values())
    total = sum(len(words(t)) for t in before.values())
    assert abs(sum(r["taken"] for r in after.values()) - total) <= 3
    whole = {r["doc_id"]: (r["text"], r["taken"], r["copies"]) for r in corpus_pipeline.run(spark, sf).collect()}
    assert whole == {i: (r["text"], r["taken"], r["copies"]) for i, r in after.items()}


def test_pipeline_of_nothing(spark, tmp_path):
    sf = folder(spark, tmp_path, documents=spark.createDataFrame([], DOCS), labels=spark.createDataFrame([], LABELS), benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, sf).count() == 0


def test_pages_whose_lines_are_all_marked_are_aligned_too(spark):
    rows = [(i, f"https://a.org/{i}", "<article>" + "".join(f"<p>own words {i} {k} {k * i}</p>" for k in range(1, 9)) + "<p>written at our desk</p></article>") for i in range(1, 5)]
    pages = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "row_key long, page_id long, url string, html string")
    assert sorted((r["shared"], r["deleted"]) for r in html_text.frame_lines(pages).collect()) == [([8], [])] * 4
