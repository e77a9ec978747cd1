"""HTML extraction: nearest-URL page differencing, together with the marks that pages carry.

Pages are sorted by host and URL path, and each is paired with its neighbours of the same host.
The lines of two pages are aligned by longest common subsequence. What a page shares with the
nearest neighbour that isn't a copy of it belongs to the site. (A neighbour with which it shares
half of its words or more is a copy, and shows nothing; where both neighbours are copies, pages twice as far are tried,
up to the host's first and last.)

A page is read as blocks of text, a line each. Marks sort them: elements of the frame (nav,
footer, aside, form and so on), and elements whose class, id or role consists of frame words
alone (share-buttons, but not related-work), are frame. A name with frame words among others
makes its lines suspects. If the page marks its article (article, main), the article's lines
are the text; its suspects go if they are shared. Otherwise all lines outside the frame are the
text, and go if they are shared. A class of an ancestor never hides a marked article; if all
marked articles stand in frames, those in the weakest frames are the text.

Pairing is a global sort of line hashes and a numbering of the sorted rows; neighbours meet
in an equi-join of row numbers, so a host with a third of all pages is no group of its own.
Differencing alone can't give the article: menus and footers may differ from page to page, and
copies share their articles.

Cases: null or empty html, and pages without text, give ""; a null url has an empty host and
path; if all lines of a page are shared, they stay; equal urls are ordered by page_id; equal
rows are each extracted; a very long page is scanned in time that grows with its length; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import numbered, settled, table
from .kernels import arrow_column, join_lists, words_in
from .url_filter import host_of, path_of

NAME = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9-]*)")
#: The rest of a tag. Quotes count after an equals sign only; nothing is tried twice.
REST = re.compile(r"""((?:[^>=]++|=\s*+(?:"[^"]*+"|'[^']*+')?)*+)>""")
ATTRIBUTE = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
RAW = frozenset("script style textarea title noscript template iframe svg select option object canvas".split())
#: Of RAW, those whose content a browser reads to the page's end if they are not closed.
RAW_TO_END = frozenset("script style textarea title iframe".split())
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset("address article aside blockquote body dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
FRAME = frozenset("nav header footer aside button dialog menu head".split())
ARTICLE = frozenset(("article", "main"))
ROLES = frozenset("banner navigation complementary contentinfo search menu menubar toolbar dialog alert alertdialog".split())
#: In these, an article is a visitor's or another page's.
FOREIGN_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored comment comments reply replies respond discussion related recommended widget".split())
FRAME_WORDS = FOREIGN_WORDS | frozenset(
    "promo banner sidebar menu menubar nav navbar navigation breadcrumb breadcrumbs masthead header footer cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe signup login share sharing social toolbar pagination pager search skip".split()
)
#: Words that may stand beside frame words in the name of a frame, and more that may beside those of FOREIGN_WORDS.
PLAIN_WORDS = frozenset("area bar block bottom box button buttons container form global icons left links list main page primary right secondary site slot top unit wrap wrapper".split())
FOREIGN_PLAIN = PLAIN_WORDS | frozenset("article articles item items panel post posts section stories".split())

#: How much an element is frame: not; by a name that may tell it; by its layout's name; for certain.
OPEN, SUSPECT, LAYOUT, FOREIGN = range(4)


#: Lines of two pages, multiplied, up to which all pairs of equal lines are looked at.
AT_ONCE = 1 << 20


class Block(NamedTuple):
    text: str
    level: int  # how much it is frame, inside the outermost article or else in the page
    article: bool
    outer: int  # how much the outermost article is


def _named(name: str, attributes: str, article: bool) -> int:
    """How much its attributes make an element frame; names of html, body and the outermost article don't."""
    found = OPEN
    whole = name in ("html", "body") or name in ARTICLE and not article
    for key, value in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), value.strip("\"'").lower()
        if key == "hidden" and value != "false":
            return OPEN if name in ("html", "body") else FOREIGN
        if whole or key not in ("class", "id", "role"):
            continue
        for token in value.split():
            parts = [x for x in re.split(r"[^a-z]+", token) if x]
            told = FRAME_WORDS.intersection(parts)
            if key == "role":
                found = max(found, LAYOUT if token in ROLES else OPEN)
            elif told:
                foreign = bool(FOREIGN_WORDS & told)
                plain = FRAME_WORDS | (FOREIGN_PLAIN if foreign else PLAIN_WORDS)
                found = max(found, SUSPECT if not plain.issuperset(parts) else FOREIGN if foreign else LAYOUT)
    return found


def blocks_of(html: str) -> list[Block]:
    """The page's blocks of text in order, by one pass over its tags."""
    blocks: list[Block] = []
    parts: list[str] = []
    open_: list[tuple[str, tuple, list | None]] = []  # (element, what holds outside it, what it interrupts)
    opened: Counter = Counter()
    level, article, outer = OPEN, False, OPEN

    def end_block() -> None:
        if parts:
            text = "".join(parts)
            text = " ".join((unescape(text) if "&" in text else text).split())
            parts.clear()
            if text:
                blocks.append(Block(text, level, article, outer))

    def close(name: str) -> None:
        nonlocal parts, level, article, outer
        last = None
        while opened[name] and last != name:
            last, outside, interrupted = open_.pop()
            opened[last] -= 1
            if outside != (level, article, outer):
                end_block()
                level, article, outer = outside
            parts = interrupted or parts

    at, last_end, unclosed = 0, html.rfind(">"), set()
    while True:
        start = html.find("<", at)
        if start < 0 or start > last_end:
            break
        if start > at:
            parts.append(html[at:start])
        m = NAME.match(html, start + 1)
        if m is None:
            if html.startswith("<!--", start):
                end = html.find("-->", start + 4)
                at = end + 3 if end >= 0 else len(html)
            elif html[start + 1] in "!?/":
                at = html.find(">", start) + 1
            else:
                parts.append("<")
                at = start + 1
            continue
        rest = REST.match(html, m.end())
        at = rest.end() if rest else html.find(">", m.end()) + 1
        name, attributes = m[2].lower(), rest[1] if rest else ""
        if m[1]:
            if name in BLOCKS:
                end_block()
            close(name)
        elif name in RAW:
            if attributes.endswith("/") or name in unclosed:
                continue
            stop = html.find("<", at) if name == "option" else -1
            if name == "option":
                at = stop if stop >= 0 else len(html)
            elif end := RAW_END[name].search(html, at):
                at = end.end()
            elif name in RAW_TO_END:
                at = len(html)
            else:
                unclosed.add(name)
        elif name in VOID:
            if name == "hr":
                end_block()
            elif name == "br":
                parts.append(" ")
        else:
            if name in BLOCKS:
                end_block()
                if open_ and open_[-1][0] == "p":
                    close("p")
            mine, inside, around = level, article, outer
            if name in FRAME and not (article and name == "header"):
                mine = FOREIGN
            elif name == "form":
                mine = max(mine, LAYOUT)
            if attributes.strip():
                mine = max(mine, _named(name, attributes, article))
            if name in ARTICLE and not article:
                inside, around, mine = True, mine, OPEN
            here = (level, article, outer)
            if name in BLOCKS and name != "p" or (mine, inside, around) != here:
                open_.append((name, here, parts if parts and name not in BLOCKS else None))
                opened[name] += 1
                if open_[-1][2]:
                    parts = []
                level, article, outer = mine, inside, around
    if at < len(html) and (start < 0 or start > last_end):
        rest = html[at : start if start >= 0 and NAME.match(html, start + 1) else len(html)]
        parts.append(rest)
    end_block()
    return blocks


def page_lines(html: str) -> list[tuple[str, bool]]:
    """(text, whether it goes if a neighbour shares it) of each line that may be the page's text."""
    blocks = blocks_of(html)
    articles = [b for b in blocks if b.article and b.level < LAYOUT]
    for most in (SUSPECT, LAYOUT):
        if lines := [(b.text, b.level == SUSPECT) for b in articles if b.outer <= most]:
            return lines
    rest = [b for b in blocks if not b.article]
    for most in (SUSPECT, LAYOUT):
        if lines := [(b.text, True) for b in rest if b.level <= most]:
            return lines
    return [(b.text, b.level == SUSPECT) for b in articles]


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Indexes of `a` in a longest common subsequence with `b`.

    Lines of one side alone and common ends are set aside. What is left is aligned by Hunt and Szymanski's
    method, or halved until it is small enough for it.
    """
    head = 0
    while head < min(len(a), len(b)) and a[head] == b[head]:
        head += 1
    tail = 0
    while tail < min(len(a), len(b)) - head and a[-1 - tail] == b[-1 - tail]:
        tail += 1
    in_a, in_b = set(a[head : len(a) - tail]), set(b[head : len(b) - tail])
    mine = [i for i in range(head, len(a) - tail) if a[i] in in_b]
    middle = _aligned([a[i] for i in mine], [x for x in b[head : len(b) - tail] if x in in_a])
    return [*range(head), *(mine[i] for i in middle), *range(len(a) - tail, len(a))]


def _aligned(a: list[int], b: list[int]) -> list[int]:
    if not a or not b:
        return []
    if len(a) * len(b) <= AT_ONCE or len(a) == 1:
        return _by_matches(a, b)
    half = len(a) // 2
    before, after = _prefix_lengths(a[:half], b), _prefix_lengths(a[half:][::-1], b[::-1])
    cut = int(np.argmax(before + after[::-1]))
    return [*_aligned(a[:half], b[:cut]), *(half + i for i in _aligned(a[half:], b[cut:]))]


def _prefix_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """The length of a longest common subsequence of `a` with each prefix of `b`, one bit per line of `b`."""
    places: dict[int, int] = {}
    for j, x in enumerate(b):
        places[x] = places.get(x, 0) | 1 << j
    every = (1 << len(b)) - 1
    row = every
    for x in a:
        met = row & places.get(x, 0)
        row = (row + met | row - met) & every
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), dtype=np.uint8), bitorder="little")[: len(b)]
    return np.concatenate(([0], np.cumsum(1 - bits.astype(np.int64))))


def _by_matches(a: list[int], b: list[int]) -> list[int]:
    places: dict[int, list[int]] = {}
    for j in range(len(b) - 1, -1, -1):
        places.setdefault(b[j], []).append(j)
    tails: list[int] = []
    links: list[tuple] = []
    for i, x in enumerate(a):
        for j in places.get(x, ()):
            k = bisect_left(tails, j)
            link = (i, links[k - 1] if k else None)
            if k == len(tails):
                tails.append(j)
                links.append(link)
            else:
                tails[k] = j
                links[k] = link
    out, link = [], links[-1] if links else None
    while link:
        out.append(link[0])
        link = link[1]
    return out[::-1]


_LINES = pa.struct([("keys", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("loose", pa.list_(pa.bool_()))])


@arrow_column(_LINES)
def line_keys(html: pa.Array) -> pa.Array:
    """The hash and the number of words of each line of a page, and whether it goes if shared."""
    pages = [page_lines(x or "") for x in html.to_pylist()]
    flat = pa.array([t.replace(" ", "\x00") for p in pages for t, _ in p], pa.string())
    keys = join_lists([pa.array(w.hashes().view(np.int64)) for _, _, w in words_in(flat)], pa.int64())
    ends = pa.array(np.cumsum([0, *map(len, pages)]), pa.int32())
    words = pa.array([t.count(" ") + 1 for p in pages for t, _ in p], pa.int32())
    loose = pa.array([x for p in pages for _, x in p], pa.bool_())
    return pa.StructArray.from_arrays([pa.ListArray.from_arrays(ends, x) for x in (keys, words, loose)], fields=list(_LINES))


def site_lines(lines: dict, neighbours: list[list[int] | None]) -> list[int] | None:
    """Which lines of a page the first neighbour that is no copy shows to be the site's. None if all are copies."""
    seen = [other for other in neighbours if other is not None]
    copies = bool(seen)
    for other in seen:
        hit = common_lines(lines["keys"], other)
        if 2 * sum(lines["words"][i] for i in hit) < sum(lines["words"]):
            copies = False
            if hit:
                return hit
    return None if copies else []


@arrow_column(pa.list_(pa.int32()))
def shared_lines(lines: pa.Array, before: pa.Array, after: pa.Array) -> pa.Array:
    rows = zip(lines.to_pylist(), before.to_pylist(), after.to_pylist(), strict=True)
    return pa.array([site_lines(x, [y, z]) for x, y, z in rows], pa.list_(pa.int32()))


@arrow_column(pa.string())
def text_without(html: pa.Array, deleted: pa.Array) -> pa.Array:
    out = []
    for x, gone in zip(html.to_pylist(), deleted.to_pylist(), strict=True):
        gone = set(gone or ())
        out.append("\n\n".join(t for i, (t, _) in enumerate(page_lines(x or "")) if i not in gone))
    return pa.array(out, pa.string())


def frame_lines(pages: DataFrame) -> DataFrame:
    """`row_key, page_id, url, html` to `row_key, shared, deleted` for the pages that share lines with the site.

    Every page is aligned, whatever its marks; of the lines shared those go that no mark settles.
    """
    lines = settled(pages.select("row_key", "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), line_keys("html").alias("lines")))
    rows = numbered(lines, "host", "path", "page_id", "row_key").drop("path", "page_id")
    ends = settled(rows.groupBy("host").agg(F.min("nr").alias("low"), F.max("nr").alias("high")))
    nr, step, found = F.col("nr"), 1, None
    open_ = rows.join(ends, "host")
    while True:  # as often as the longest run of copies can be halved, at most
        sides = {"before": F.when(nr > F.col("low"), F.greatest(nr - step, F.col("low"))), "after": F.when(nr < F.col("high"), F.least(nr + step, F.col("high")))}
        paired = open_.withColumns({f"at_{side}": at for side, at in sides.items()})
        for side in sides:
            paired = paired.join(rows.select(nr.alias(f"at_{side}"), F.col("lines.keys").alias(side)), f"at_{side}", "left")
        judged = settled(paired.select("row_key", "nr", "low", "high", "lines", shared_lines("lines", "before", "after").alias("shared")))
        out = judged.where("size(shared) > 0").select("row_key", "shared", F.filter("shared", lambda i: F.get("lines.loose", i)).alias("deleted"))
        found = out if found is None else found.unionByName(out)
        open_ = judged.where("shared is null").where((nr - step > F.col("low")) | (nr + step < F.col("high"))).drop("shared")
        step *= 2
        if open_.isEmpty():
            return found.groupBy("row_key").agg(F.first("shared").alias("shared"), F.first("deleted").alias("deleted"))


def extract_text(pages: DataFrame, broadcast_lines: int = 500_000) -> DataFrame:
    """`page_id, url, html` to page_id, url, text.

    Lists of up to broadcast_lines deleted lines go to the pages, so that these stay where they are; if
    there are more, pages and lists are shuffled.
    """
    pages = pages.withColumn("row_key", F.xxhash64("page_id", "url", "html"))
    deleted = settled(frame_lines(pages).where("size(deleted) > 0").select("row_key", "deleted"))
    n = deleted.agg(F.sum(F.size("deleted") + 1)).first()[0] or 0
    met = pages.join(F.broadcast(deleted) if n <= broadcast_lines else deleted, "row_key", "left")
    return met.select("page_id", "url", text_without("html", "deleted").alias("text"))


def op8_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return extract_text(pages).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
