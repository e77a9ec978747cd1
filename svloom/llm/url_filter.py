"""URL filters: rules for hosts and paths, and the reputation of hosts beyond them.

Column expressions only. The reputation is empirical Bayes: labelled outcomes of pages are
counted by host, registered domain and suffix; a beta-binomial prior, whose strength is
estimated by moments at each level, shrinks a domain towards its suffix and a host towards
its domain. A host is blocked if the lower 90% bound of its posterior share of bad pages lies
above a quarter, so a few bad pages don't condemn a host of a good domain.

Pages have no labels, documents do. So a page is labelled by its content, never by its host's
name: what sets documents of bad quality apart (shares of junk signs, of capitals and of
repeated words, each in steps) gives log odds for the main text of a page. A page with positive
log odds is bad, else good; one with hardly any text is not labelled. The odds are counted on at
most `sample_rows` labelled documents, those whose id has the least checksum.

Cases: a null url or one without "://" has an empty host and path, fits no rule, and stands
for a host of its own; null, empty and very long html is one page more, labelled if it has text, and read in
time that grows with its length alone, whatever stays open in it (what an unclosed comment or script hides is not read);
pages of equal url and repeated rows are each judged; without labels no page is bad; a label of
a null or unknown document teaches nothing; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import string
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, settled, table

RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))
#: What follows the first article tag of a page, what of that is before the last end tag, and what isn't visible text. Each is
#: anchored, stops at the next tag, or takes the rest of the page where an end is missing (as browsers do), so none starts over again and again.
ARTICLE = r"(?is)^.*?<article\b[^<>]*>(.*)\z"
ARTICLE_END = r"(?is)^(.*)</article>"
VISIBLE = r"(?is)<script\b.*?(?:</script>|\z)|<style\b.*?(?:</style>|\z)|<title\b.*?(?:</title>|\z)|<!--.*?(?:-->|\z)|<[^<>]*>"
JUNK = "[#*$%|<>@^~!?]"
#: What of a text is counted, and how many steps a whole share has; the last step holds all from STEPS on.
SIGNS = (("junk", 200), ("capitals", 40), ("repeats", 20))
STEPS = 20
#: Second labels that belong to the suffix where a country code follows.
SECOND_LABELS = ("co", "com", "org", "net", "ac", "gov", "edu")


def host_of(url: Column) -> Column:
    raw = F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit(""))
    return F.translate(raw, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str]], what) -> Column:
    """`what(verdict, rule)` of the longest rule that fits; null if none does. The rules are a short list."""
    out = None
    for verdict, rule in sorted(rules, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        out = F.when(fits, what(verdict, rule)) if out is None else out.when(fits, what(verdict, rule))
    return F.lit(None).cast("string") if out is None else out


def suffix_of(host: Column) -> Column:
    labels = F.split(host, r"\.")
    two = (F.size(labels) > 2) & (F.length(F.element_at(labels, -1)) == 2) & F.try_element_at(labels, F.lit(-2)).isin(*SECOND_LABELS)
    return F.when(two, F.substring_index(host, ".", -2)).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.instr(suffix_of(host), ".") > 0
    return F.when(two, F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def main_text(html: Column) -> Column:
    found = F.regexp_extract(F.regexp_extract(html, ARTICLE, 1), ARTICLE_END, 1)
    return F.regexp_replace(F.when(found != "", found).otherwise(html), VISIBLE, " ")


def text_signs(text: Column) -> list[Column]:
    """The step of each of SIGNS that a text is on."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    without = lambda chars: F.length(text) - F.length(F.regexp_replace(text, chars, ""))
    found = ((without(JUNK), F.length(text)), (without("[A-Z]"), F.length(text)), (F.size(words) - F.size(F.array_distinct(words)), F.size(words)))
    return [F.least(F.lit(STEPS), F.floor(steps * n.cast("long") / F.greatest(F.lit(1), size))).cast("int").alias(name) for (name, steps), (n, size) in zip(SIGNS, found, strict=True)]


def sign_odds(docs: DataFrame, labels: DataFrame, sample_rows: int = 12_000) -> tuple[float, dict[str, list[float]]]:
    """(log odds that a document is bad, what each step of each sign adds), from the labelled sample.

    A row for each step comes to the driver.
    """
    known = labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("quality").alias("good"))
    sample = known.orderBy(F.md5(F.col("doc_id").cast("string")), "doc_id").limit(sample_rows)
    taught = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("good", *text_signs(F.coalesce("text", F.lit(""))))
    steps = taught.select("good", F.explode(F.array(*[F.struct(F.lit(name).alias("sign"), F.col(name).alias("step")) for name, _ in SIGNS])).alias("s"))
    counts = {(r["sign"], r["step"], r["good"]): r["count"] for r in steps.groupBy("s.sign", "s.step", "good").count().collect()}
    total = [sum(n for (sign, _, good), n in counts.items() if good == k and sign == SIGNS[0][0]) for k in (0, 1)]
    share = lambda name, step, good: (counts.get((name, step, good), 0) + 1) / (total[good] + STEPS + 1)
    odds = {name: [math.log(share(name, step, 0) / share(name, step, 1)) for step in range(STEPS + 1)] for name, _ in SIGNS}
    return math.log((total[0] + 1) / (total[1] + 1)), odds


def page_outcomes(pages: DataFrame, odds: tuple[float, dict[str, list[float]]], min_chars: int = 20) -> DataFrame:
    """`host, html` to host, outcome: 1 bad, 0 good, null not labelled. Each step is a projection of its own, and computed once."""
    weigh = lambda name: F.element_at(F.array(*map(F.lit, odds[1][name])), F.col(name) + 1)
    total = reduce(lambda a, x: a + x, [weigh(name) for name, _ in SIGNS], F.lit(odds[0]))
    signs = pages.select("host", main_text(F.col("html")).alias("text")).select("host", (F.length(F.trim("text")) >= min_chars).alias("told"), *text_signs(F.col("text")))
    return signs.select("host", F.when(F.col("told"), (total > 0).cast("int")).alias("outcome"))


def _strength(groups: DataFrame) -> float:
    """How many pages the parent's share is worth at this level, by moments of `n, bad, parent`."""
    p = F.greatest(F.lit(1e-3), F.least(F.lit(1 - 1e-3), F.col("parent")))
    row = groups.agg(F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - p, F.lit(2)) / (p * (1 - p))).alias("s"), F.count("*").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn")).first()
    if not row["g"]:
        return 1.0
    room = row["n"] - row["nn"] / row["n"] - (row["g"] - 1)
    rho = (row["s"] - (row["g"] - 1)) / room if room > 0 else 0.5
    rho = min(0.99, max(0.01, rho))
    return (1 - rho) / rho


def host_reputation(pages: DataFrame, z: float = 1.28, limit: float = 0.25) -> DataFrame:
    """`host, outcome` rows to `host, bad_share, bad_bound, bad_host`: one row per host."""
    hosts = settled(pages.groupBy("host").agg(F.count("outcome").alias("n"), F.coalesce(F.sum("outcome"), F.lit(0)).alias("bad"))).withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    all_ = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    prior = (all_["bad"] + 0.5) / (all_["n"] + 1) if all_["n"] else 0.5

    def shrunk(level: DataFrame, parent: Column) -> DataFrame:
        level = level.withColumn("parent", parent)
        strength = _strength(level.where("n > 0"))
        return level.withColumns({"a": strength * F.col("parent") + F.col("bad"), "b": strength * (1 - F.col("parent")) + F.col("n") - F.col("bad")})

    mean = F.col("a") / (F.col("a") + F.col("b"))
    up = shrunk(suffixes, F.lit(prior)).select("suffix", mean.alias("up"))
    up = shrunk(domains.join(up, "suffix"), F.col("up")).select("domain", "suffix", mean.alias("up"))
    out = shrunk(hosts.join(up, ["domain", "suffix"]), F.col("up"))
    size = F.col("a") + F.col("b")
    bound = mean - z * F.sqrt(F.col("a") * F.col("b") / (size * size * (size + 1)))
    return out.select("host", mean.alias("bad_share"), bound.alias("bad_bound"), (bound > limit).alias("bad_host"))


def filter_urls(pages: DataFrame, docs: DataFrame, labels: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """`page_id, url, html` to page_id, host, path, rule, verdict and the host's bad_share; docs and labels tell bad texts."""
    odds = sign_odds(docs, labels)
    host, path = F.col("host"), F.col("path")
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), "html")
    reputation = host_reputation(page_outcomes(seen.select("host", "html"), odds))
    judged = seen.select("page_id", "host", "path").join(reputation, "host")
    method = F.when(F.col("bad_host"), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", rule_for(host, path, rules, lambda _, r: F.lit(r)).alias("rule"), F.coalesce(rule_for(host, path, rules, lambda v, _: F.lit(v)), method).alias("verdict"), F.round("bad_share", 6).alias("bad_share"), F.round("bad_bound", 6).alias("bad_bound"))


def op3_filter_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return filter_urls(pages, table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "labels"))


def _rules_sql(what: str) -> str:
    """The longest fitting rule's verdict or text as a CASE."""
    cases = []
    for verdict, rule in sorted(RULES, key=lambda r: -len(r[1])):
        name, _, rest = rule.partition("/")
        cases.append(f"WHEN (host = '{name}' OR ends_with(host, '.{name}')) AND starts_with(path, '/{rest}') THEN '{verdict if what == 'verdict' else rule}'")
    return "CASE " + " ".join(cases) + " END"


def _level_sql(name: str, groups: str, parent: str) -> str:
    """`groups` (n, bad, and `parent`) with the posterior's a and b."""
    p = f"greatest(0.001, least(0.999, {parent}))"
    return f"""{name}_m AS (SELECT sum(n * pow(bad / n - {p}, 2) / ({p} * (1 - {p}))) AS s, count(*) AS g, sum(n) AS n, sum(n * n) AS nn FROM {groups} WHERE n > 0),
{name}_r AS (SELECT CASE WHEN g = 0 THEN 0.5 ELSE least(0.99, greatest(0.01, CASE WHEN n - nn / n - (g - 1) > 0 THEN (s - (g - 1)) / (n - nn / n - (g - 1)) ELSE 0.5 END)) END AS rho FROM {name}_m),
{name} AS MATERIALIZED (SELECT x.*, (1 - rho) / rho * {parent} + bad AS a, (1 - rho) / rho * (1 - {parent}) + n - bad AS b FROM {groups} x, {name}_r)"""


def _signs_sql(text: str) -> str:
    """The columns of `text_signs`."""
    words = f"regexp_extract_all({text}, '{WORD}')"
    without = lambda chars: f"length({text}) - length(regexp_replace({text}, '{chars}', '', 'g'))"
    found = ((without(JUNK), f"length({text})"), (without("[A-Z]"), f"length({text})"), (f"len({words}) - len(list_distinct({words}))", f"len({words})"))
    return ", ".join(f"CAST(least({STEPS}, floor({steps} * ({n}) / greatest(1, {size}))) AS INTEGER) AS {name}" for (name, steps), (n, size) in zip(SIGNS, found, strict=True))


_SHARE_SQL = f"(coalesce(sum(n) FILTER (good = {{0}}), 0) + 1) / (any_value(n{{0}}) + {STEPS + 1})"

OP3_SQL = f"""
WITH known AS (SELECT doc_id, max(quality) AS good FROM labels WHERE quality IN (0, 1) AND doc_id IS NOT NULL GROUP BY doc_id ORDER BY md5(CAST(doc_id AS VARCHAR)), doc_id LIMIT 12000),
taught AS MATERIALIZED (SELECT good, {_signs_sql("t")} FROM (SELECT good, coalesce(text, '') AS t FROM documents JOIN known USING (doc_id))),
sizes AS (SELECT count(*) FILTER (good = 0) AS n0, count(*) FILTER (good = 1) AS n1 FROM taught),
seen AS (SELECT good, sign, step, count(*) AS n FROM (UNPIVOT taught ON {", ".join(name for name, _ in SIGNS)} INTO NAME sign VALUE step) GROUP BY ALL),
odds AS MATERIALIZED (SELECT sign, step, ln(({_SHARE_SQL.format(0)}) / ({_SHARE_SQL.format(1)})) AS w FROM (SELECT s.sign, x.step, good, n, n0, n1 FROM (SELECT unnest(['{"', '".join(name for name, _ in SIGNS)}']) AS sign) s CROSS JOIN (SELECT unnest(range({STEPS + 1})) AS step) x CROSS JOIN sizes LEFT JOIN seen ON seen.sign = s.sign AND seen.step = x.step) GROUP BY sign, step),
q AS MATERIALIZED (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path, regexp_replace(CASE WHEN regexp_extract(regexp_extract(html, '{ARTICLE}', 1), '{ARTICLE_END}', 1) <> '' THEN regexp_extract(regexp_extract(html, '{ARTICLE}', 1), '{ARTICLE_END}', 1) ELSE html END, '{VISIBLE}', ' ', 'g') AS text FROM pages),
weighed AS (SELECT host, text, {_signs_sql("text")} FROM q),
o AS (SELECT host, CASE WHEN length(trim(text, ' ')) >= 20 THEN CAST((SELECT ln((n0 + 1) / (n1 + 1)) FROM sizes) + {" + ".join(f"{name}_o.w" for name, _ in SIGNS)} > 0 AS INTEGER) END AS bad
  FROM weighed {" ".join(f"LEFT JOIN odds {name}_o ON {name}_o.sign = '{name}' AND {name}_o.step = weighed.{name}" for name, _ in SIGNS)}),
h0 AS (SELECT host, string_split(host, '.') AS l, count(bad) AS n, coalesce(sum(bad), 0) AS bad FROM o GROUP BY host),
h1 AS (SELECT *, len(l) > 2 AND length(l[-1]) = 2 AND l[-2] IN ('co', 'com', 'org', 'net', 'ac', 'gov', 'edu') AS two FROM h0),
h AS MATERIALIZED (SELECT host, n, bad, array_to_string(CASE WHEN two THEN l[-3:] ELSE l[-2:] END, '.') AS domain, array_to_string(CASE WHEN two THEN l[-2:] ELSE l[-1:] END, '.') AS suffix FROM h1),
d AS MATERIALIZED (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY domain, suffix),
s AS MATERIALIZED (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY suffix),
s1 AS MATERIALIZED (SELECT s.*, (SELECT (sum(bad) + 0.5) / (sum(n) + 1) FROM s) AS parent FROM s),
{_level_sql("sx", "s1", "parent")},
d1 AS MATERIALIZED (SELECT d.*, sx.a / (sx.a + sx.b) AS parent FROM d JOIN sx USING (suffix)),
{_level_sql("dx", "d1", "parent")},
g1 AS MATERIALIZED (SELECT h.*, dx.a / (dx.a + dx.b) AS parent FROM h JOIN dx USING (domain, suffix)),
{_level_sql("hx", "g1", "parent")},
r AS (SELECT host, a / (a + b) AS share, a / (a + b) - 1.28 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS bound FROM hx)
SELECT page_id, host, path, {_rules_sql("rule")} AS rule, coalesce({_rules_sql("verdict")}, CASE WHEN bound > 0.25 THEN 'block' ELSE 'allow' END) AS verdict, round(share, 6) AS bad_share, round(bound, 6) AS bad_bound FROM q JOIN r USING (host)
"""
