"""Secret scans: known forms by pattern, and unnamed keys by a battery of randomness tests.

Column expressions only. The patterns' spans come from the pieces between the matches, so
offsets count code points. Further candidates are runs of 20 and more characters of a key
alphabet with both letters and digits that touch no such span. For each the encoding is
inferred. The battery has three tests: chi-squared uniformity over the alphabet, runs, and
serial correlation. It is used twice:

* a candidate that the three, joined by Fisher's method, find unlike random is dropped;
* against written text (names, paths, numbers) the first two are turned around: text repeats its
  characters more often than random keys, and changes its kind of character (lower case, upper
  case, digit, sign) less often. Joined by Fisher's method they give the candidate's p-value,
  the smaller the longer the run. Benjamini-Hochberg over all candidates of the corpus, by
  encoding and length band, bounds the share of false finds. (Serial correlation says nothing
  here: text of one case has none either.)

Cases: a null text counts as empty and has no spans; ties, repeated rows and rows of null or
equal doc_id are each scanned; a very long text is scanned whole; an empty table gives no rows;
other columns are kept by `redact_stage` only as far as documents has them.
"""

from __future__ import annotations

import math
import string
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import settled, table

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# Same matches as one or more characters with the short ones dropped, as a run is found whole.
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"

KINDS = ("assign", "access", "hex", "random")
ENCODINGS = {"hex": "0123456789abcdef", "base32": string.ascii_uppercase + "234567", "base36": string.digits + string.ascii_lowercase, "base64": string.ascii_uppercase + string.ascii_lowercase + string.digits + "+/"}
BANDS = (20, 32, 64)
#: Of written text in an encoding's alphabet: how often neighbours differ in kind of character, and how often two
#: characters are equal. Names joined by signs are base64, numbers with few letters hex; those of one case hold few numbers.
TEXT = {"hex": (0.15, 0.1), "base32": (0.08, 0.058), "base36": (0.1, 0.058), "base64": (0.2, 0.055)}
#: -log10 of p-values is counted in so many steps a unit.
BINS = 4


def spans_of(text: Column, pattern: str, kind: str, keep=None) -> Column:
    """array<struct<start, rank, end>> of the pattern's matches; `keep` tests a match."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,rank:int,end:int>>").alias("spans"))

    def add(acc: Column, pair: Column) -> Column:
        start = acc["at"] + F.length(pair["gap"])
        end = start + F.length(pair["hit"])
        span = F.struct(start.alias("start"), F.lit(KINDS.index(kind)).alias("rank"), end.alias("end"))
        spans = F.array_append(acc["spans"], span)
        return F.struct(end.alias("at"), (F.when(keep(pair["hit"]), spans).otherwise(acc["spans"]) if keep else spans).alias("spans"))

    gaps = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    walked = F.aggregate(F.zip_with(gaps, found, lambda g, h: F.struct(g.alias("gap"), h.alias("hit"))), first, add)["spans"]
    hit = F.exists(found, keep) if keep else F.size(found) > 0
    return F.when(hit, walked).otherwise(first["spans"])


def base_spans(text: Column) -> Column:
    assign = spans_of(text, ASSIGN, "assign", lambda m: F.length(F.regexp_extract(m, ASSIGN, 2)) >= 8)
    return F.array_sort(F.concat(assign, spans_of(text, ACCESS, "access"), spans_of(text, HEX, "hex")))


def _upper_tail(z: Column) -> Column:
    """P(Z > z) of the normal distribution, by a polynomial times its density (error under 1e-7, small far out too)."""
    a = F.least(F.lit(30.0), F.abs(z))
    t = 1.0 / (1.0 + 0.2316419 * a)
    tail = F.exp(-a * a / 2) * 0.3989422804 * t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    return F.when(z >= 0, tail).otherwise(1.0 - tail)


def _two_sided(z: Column) -> Column:
    return F.greatest(F.lit(1e-12), F.least(F.lit(1.0), 2.0 * _upper_tail(F.abs(z))))


def _runs(s: Column) -> Column:
    return F.length(F.regexp_replace(s, r"(.)\1*", "$1"))


def encoding_of(token: Column) -> Column:
    """hex, base32, base36, base64, or null for what is none of these or lacks letters or digits."""
    known = F.when(token.rlike("^([0-9a-f]+|[0-9A-F]+)$"), "hex").when(token.rlike("^[A-Z2-7]+$"), "base32").when(token.rlike("^([0-9a-z]+|[0-9A-Z]+)$"), "base36")
    known = known.when(token.rlike("^([A-Za-z0-9+/]+|[A-Za-z0-9_-]+)$"), "base64")
    return F.when(token.rlike("[0-9]") & token.rlike("[A-Za-z]"), known)


def kind_changes(token: Column) -> Column:
    """How often neighbours differ in kind of character."""
    kinds = F.translate(token, string.ascii_lowercase + string.ascii_uppercase + string.digits + "+/_-", "a" * 26 + "A" * 26 + "0" * 10 + "----")
    return (_runs(kinds) - 1).cast("double")


def _per_encoding(encoding: Column, what) -> Column:
    return reduce(lambda c, e: c.when(encoding == e, what(e)), list(ENCODINGS)[1:], F.when(encoding == "hex", what("hex")))


def _sums(c: Column) -> Column:
    """What the battery needs of a token, by one walk over its characters' places in the alphabet."""
    first = F.struct(*[F.lit(0.0).alias(x) for x in ("sum", "square", "lagged", "last")], F.lit(-1.0).alias("first"))

    def add(a: Column, letter: Column) -> Column:
        x = F.instr(c["letters"], letter).cast("double")
        return F.struct((a["sum"] + x).alias("sum"), (a["square"] + x * x).alias("square"), (a["lagged"] + a["last"] * x).alias("lagged"), x.alias("last"), F.when(a["first"] < 0, x).otherwise(a["first"]).alias("first"))

    return F.aggregate(c["chars"], first, add)


def _battery(c: Column) -> Column:
    """(z of uniformity, of runs, of serial correlation) of a token that was drawn at random, if it was."""
    n, k = c["n"], c["k"]
    pairs = n * (n - 1) / 2
    # Chi-squared of the alphabet is linear in the pairs of equal characters, whose mean and variance are exact.
    z_uniform = (c["equal"] - pairs / k) / F.sqrt(pairs / k * (1 - 1 / k))
    both = 2 * c["low"] * (n - c["low"])
    spread = F.greatest(both * (both - n) / (n * n * (n - 1)), F.lit(1e-9))
    z_runs = F.when(both > 0, (c["runs"] - both / n - 1) / F.sqrt(spread)).otherwise(F.lit(12.0))
    s, mean = c["sums"], c["sums"]["sum"] / n
    square = s["square"] - n * mean * mean
    lagged = s["lagged"] - mean * (2 * s["sum"] - s["first"] - s["last"]) + (n - 1) * mean * mean
    z_serial = F.when(square > 1e-9, lagged / square * F.sqrt(n)).otherwise(F.lit(12.0))
    return F.struct(z_uniform.alias("uniform"), z_runs.alias("runs"), z_serial.alias("serial"))


def _unlike_text(c: Column) -> Column:
    """-ln of the chances that written text has so few equal characters, and that it changes its kind so often, added up."""
    n = c["n"]
    changes, equal = (_per_encoding(c["encoding"], lambda e, i=i: F.lit(TEXT[e][i])) for i in (0, 1))
    pairs = n * (n - 1) / 2 * equal
    few = (c["equal"] - pairs + 0.5) / F.sqrt(pairs * (1 - equal))
    often = (c["changes"] - (n - 1) * changes - 0.5) / F.sqrt((n - 1) * changes * (1 - changes))
    return -F.log(_upper_tail(-few)) - F.log(_upper_tail(often))


def battery(spans: Column, text: Column) -> Column:
    """Spans of candidates to array<struct<start, end, encoding, band, random, bin>>.

    random is the p-value of having been drawn at random, bin the step of -log10 of that of being text.
    Each step is a transform of its own, so that what it computes is computed once.
    """
    found = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), F.rtrim(F.substring(text, s["start"] + 1, s["end"] - s["start"]), F.lit("=")).alias("token")))
    found = F.transform(found, lambda c: F.struct(c["start"].alias("start"), c["end"].alias("end"), c["token"].alias("token"), encoding_of(c["token"]).alias("encoding")))
    found = F.filter(found, lambda c: c["encoding"].isNotNull() & (F.length(c["token"]) >= min(BANDS)))
    plain = {"hex": F.lower, "base32": lambda t: t, "base36": F.lower, "base64": lambda t: F.translate(t, "-_", "+/")}

    def shaped(c: Column) -> Column:
        length = F.length(c["token"])
        band = reduce(lambda x, b: x.when(length >= b, b), sorted(BANDS, reverse=True)[1:], F.when(length >= max(BANDS), max(BANDS)))
        letters = _per_encoding(c["encoding"], lambda e: F.lit(ENCODINGS[e]))
        half = _per_encoding(c["encoding"], lambda e: F.lit("L" * (len(ENCODINGS[e]) // 2) + "H" * ((len(ENCODINGS[e]) + 1) // 2)))
        return F.struct(c["start"].alias("start"), c["end"].alias("end"), c["encoding"].alias("encoding"), band.alias("band"), kind_changes(c["token"]).alias("changes"), _per_encoding(c["encoding"], lambda e: plain[e](c["token"])).alias("token"), letters.alias("letters"), half.alias("half"))

    kept = ("start", "end", "encoding", "band")
    same = lambda c, *more: [c[x].alias(x) for x in (*kept, *more)]
    found = F.transform(found, shaped)
    found = F.transform(found, lambda c: F.struct(*same(c, "changes", "token", "letters"), F.split(c["token"], "").alias("chars"), F.call_function("translate", c["token"], c["letters"], c["half"]).alias("halves")))
    found = F.transform(
        found,
        lambda c: F.struct(
            *same(c, "changes"),
            F.length(c["token"]).cast("double").alias("n"),
            F.length(c["letters"]).cast("double").alias("k"),
            F.aggregate(F.array_distinct(c["chars"]), F.lit(0.0), lambda a, x: a + _pairs(F.length(c["token"]) - F.length(F.replace(c["token"], x, F.lit(""))))).alias("equal"),
            F.length(F.replace(c["halves"], F.lit("H"), F.lit(""))).cast("double").alias("low"),
            _runs(c["halves"]).cast("double").alias("runs"),
            _sums(c).alias("sums"),
        ),
    )
    found = F.transform(found, lambda c: F.struct(*same(c), _battery(c).alias("z"), _unlike_text(c).alias("text")))
    found = F.transform(found, lambda c: F.struct(*same(c, "text"), (-(F.log(_two_sided(c["z"]["uniform"])) + F.log(_two_sided(c["z"]["runs"])) + F.log(_two_sided(c["z"]["serial"])))).alias("y")))
    # Fisher's method: the tails of chi-squared of six and of four degrees of freedom.
    return F.transform(found, lambda c: F.struct(*same(c), (F.exp(-c["y"]) * (1 + c["y"] + c["y"] * c["y"] / 2)).alias("random"), F.floor((c["text"] - F.log1p(c["text"])) / math.log(10) * BINS).cast("int").alias("bin")))


def _pairs(n: Column) -> Column:
    return n * (n - 1) / F.lit(2.0)


def candidates(text: Column, base: Column, min_random: float) -> Column:
    """array<struct<start, end, encoding, band, random, bin>> of the runs beside `base` that the battery lets pass."""
    none = F.array().cast("array<struct<start:int,rank:int,end:int>>")
    runs = F.when(text.rlike(r"(?=[A-Za-z+/_=-]*[0-9])" + CANDIDATE), spans_of(text, CANDIDATE, "random")).otherwise(none)
    free = F.filter(runs, lambda c: ~F.exists(base, lambda s: (s["start"] < c["end"]) & (c["start"] < s["end"])))
    return F.filter(battery(free, text), lambda c: c["random"] >= min_random)


def discovery_bins(found: DataFrame, q: float) -> dict[tuple[str, int], int]:
    """For each encoding and length band, the least bin of -log10 p that Benjamini-Hochberg lets through.

    Counts `found`, arrays of candidates, over the whole corpus; a row for each of a few hundred bins
    comes to the driver.
    """
    counts = found.select(F.explode("found").alias("c")).groupBy("c.encoding", "c.band", "c.bin").count().collect()
    out = {}
    for key in {(r["encoding"], r["band"]) for r in counts}:
        bins = sorted(((r["bin"], r["count"]) for r in counts if (r["encoding"], r["band"]) == key), reverse=True)
        total, above = sum(n for _, n in bins), 0
        for at, n in bins:
            above += n
            if total * 10 ** (-at / BINS) <= q * above:
                out[key] = at
    return out


def discovered(found: Column, least: dict[tuple[str, int], int]) -> Column:
    """The spans of the candidates that reach their encoding's and band's least bin."""
    passed = lambda c: reduce(lambda a, x: a | x, [(c["encoding"] == e) & (c["band"] == b) & (c["bin"] >= at) for (e, b), at in sorted(least.items())], F.lit(False))
    return F.transform(F.filter(found, passed), lambda c: F.struct(c["start"].alias("start"), F.lit(KINDS.index("random")).alias("rank"), c["end"].alias("end")))


def scan_secrets(docs: DataFrame, *keep: str, min_random: float = 1e-3, q: float = 0.01) -> DataFrame:
    """The columns `keep` of `docs` and `secrets`, array<struct<start, rank, end>>, in order; rank counts KINDS.

    Texts are scanned once: what was found is settled, and cut when the corpus has been counted.
    """
    text = F.coalesce("text", F.lit(""))
    read = docs.select(*keep, text.alias("_text"), base_spans(text).alias("base"))
    read = settled(read.select(*keep, "base", candidates(F.col("_text"), F.col("base"), min_random).alias("found")))
    return read.select(*keep, F.array_sort(F.concat("base", discovered(F.col("found"), discovery_bins(read, q)))).alias("secrets"))


def span_text(spans: Column) -> Column:
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["rank"] + 1)
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"].cast("string"), s["end"].cast("string"))))


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents").select("doc_id", "text"), "doc_id")
    of = lambda *ranks: F.filter("secrets", lambda s: s["rank"].isin(*ranks))
    counts = [F.size(of(i)).cast("long").alias(f"n_{kind}") for i, kind in enumerate(KINDS)]
    return found.select("doc_id", *counts, F.sha2(span_text(of(0, 1, 2)), 256).alias("base_sha256"), span_text(F.col("secrets")).alias("spans"))


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with each run of touching spans replaced by the mark."""
    first = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("parts"))

    def cut(acc: Column, s: Column) -> Column:
        apart = s["start"] >= acc["at"]
        parts = F.concat(acc["parts"], F.array(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mark)))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(apart, parts).otherwise(acc["parts"]).alias("parts"))

    done = F.aggregate(spans, first, cut)
    rest = F.substring(text, done["at"] + 1, F.lit((1 << 31) - 1))
    return F.when(F.size(spans) > 0, F.concat(F.array_join(done["parts"], ""), rest)).otherwise(text)


def redact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark; n_chars follows where a text changes.

    Only the few texts with secrets are looked up by a hash of the text.
    """
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    text_key = F.xxhash64("text", F.length("text"))
    found = scan_secrets(docs.select("text", text_key.alias("text_key")), "text_key").where("size(secrets) > 0")
    found = settled(found.groupBy("text_key").agg(F.first("secrets").alias("secrets")))
    marked = docs.withColumn("text_key", text_key).join(found, "text_key", "left")
    clean = marked.withColumn("clean", F.when(F.col("secrets").isNotNull(), redacted(F.col("text"), F.col("secrets"))).otherwise(F.col("text")))
    return clean.select("doc_id", F.col("clean").alias("text"), "lang", "source", F.when(F.col("secrets").isNotNull(), F.length("clean").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))
