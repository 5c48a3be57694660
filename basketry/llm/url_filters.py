"""URL filters: rules by host and path, and for pages without a rule the trust and distrust that reach their host along links.

Pages that a rule allows are seeds of trust for their host, pages that one blocks are seeds of distrust. Trust follows links,
distrust goes against them: whoever links to a distrusted host is distrusted. Both are personalised PageRank over the edges
between hosts, as the sum over rounds of what is handed on: a host keeps 15 % of its seeds and hands on 85 % of all that
reaches it, in equal parts to the hosts that it links to (for distrust: that link to it). Amounts are whole numbers, so that
the result depends neither on the order of sums nor on partitions, and rounds end when nothing is left to hand on.

Edges are grouped before they are shuffled, however many links stand for one. A round is one join by host and one sum; a host
with very many links is a join key that adaptive execution splits.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import counted, lower_ascii, written

SEED = 1_000_000  # what a page that a rule decides gives to its host; sums stay exact up to 10 ** 11 such pages
KEPT, HANDED_ON = 15, 85  # per cent
ROUNDS = 20  # after them 4 % of the seeds have not been handed on
LEAST = 0.5  # share of trust in what reaches an allowed host

# White space of HTML, and the parts of a page that hold no links to follow.
WS = r" \t\n\r\f"
NO_LINKS = (r"(?s)<!--.*?-->", r"(?is)<script\b.*?</script", r"(?is)<style\b.*?</style")
LINK = rf"""(?i)<a[{WS}](?:[^<>]*?[{WS}"'])?href[{WS}]*=[{WS}]*["']?([^"'{WS}<>]+)"""
TARGET = r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//([^/?#]*)"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first `://` up to `/`, `?`, `#` or the end, A-Z lowered; path: from there up to `?`, `#` or the end."""
    at = F.locate("://", url)
    after = F.when(at > 0, F.substring(url, at + 3, F.char_length(url))).otherwise("")
    return lower_ascii(F.regexp_extract(after, "^[^/?#]*", 0)), F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def ruled(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """(rule, verdict) of the longest rule that fits, of equally long ones the first by its text; null if none fits.

    A rule is (verdict, "host/path"): it fits its host and all subdomains where the path begins with the rule's. The list is
    an argument of the caller and becomes one expression: meant for some hundreds of rules.
    """
    fitting = []
    for verdict, rule in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        of_host = (host == name) | F.endswith(host, F.lit("." + name))
        fitting.append(F.when(of_host & F.startswith(path, F.lit(slash + rest)), F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))))
    return F.coalesce(*fitting, F.lit(None).cast("struct<rule: string, verdict: string>"))


def links(pages: DataFrame) -> DataFrame:
    """(source, target) of links between different hosts, once each. `pages` has host and html.

    Links are href of `a` elements outside of comments, scripts and styles; what is not closed is read as text. Only links with
    a host of their own count.
    """
    html = reduce(lambda text, pattern: F.regexp_replace(text, pattern, " "), NO_LINKS, F.col("html").cast("string"))
    found = pages.select("host", F.explode(F.array_distinct(F.regexp_extract_all(html, F.lit(LINK), 1))).alias("link"))
    ends = found.select(F.col("host").alias("source"), lower_ascii(F.regexp_extract("link", TARGET, 1)).alias("target"))
    return ends.where((F.col("source") != "") & (F.col("target") != "") & (F.col("source") != F.col("target"))).distinct()


def propagated(edges: DataFrame, seeds: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(host, trust, distrust) of hosts that something reaches; `seeds` is (host, trusted, blocked) in numbers of pages."""
    ways = edges.select(F.lit("trust").alias("kind"), F.col("source").alias("giver"), F.col("target").alias("taker")).union(
        edges.select(F.lit("distrust"), "target", "source")
    )
    parts = ways.groupBy("kind", "giver").agg(F.count(F.lit(1)).alias("parts"))
    flows = written(ways.join(parts, ["kind", "giver"]), "flows")
    both = F.explode(F.create_map(F.lit("trust"), F.col("trusted"), F.lit("distrust"), F.col("blocked"))).alias("kind", "pages")
    first = seeds.select("host", both).where(F.col("pages") > 0).select("kind", "host", F.expr(f"pages * {SEED * KEPT // 100}").alias("amount"))
    given, left = counted(first, "amounts")
    reached = [given]
    while left and len(reached) <= rounds:
        met = flows.join(given.withColumnRenamed("host", "giver"), ["kind", "giver"])
        sums = met.groupBy("kind", F.col("taker").alias("host")).agg(F.sum(F.expr("amount div parts")).alias("sum"))
        given, left = counted(sums.select("kind", "host", F.expr(f"sum * {HANDED_ON} div 100").alias("amount")).where("amount > 0"), "amounts")
        reached.append(given)
    of = {kind: F.sum(F.when(F.col("kind") == kind, F.col("amount")).otherwise(0)).alias(kind) for kind in ("trust", "distrust")}
    return reduce(DataFrame.union, reached).groupBy("host").agg(*of.values())


def judged(pages: DataFrame, rules: Sequence[tuple[str, str]], rounds: int = ROUNDS, least: float = LEAST) -> DataFrame:
    """(page_id, host, path, rule, verdict, trust, distrust) of every page.

    The longest fitting rule decides. Without one the page's host does: it is allowed if trust is at least the share `least`
    of all that reaches it, or nothing reaches it. A null url, or one without `://`, has neither host nor path, no links and
    nothing that reaches it. A null or empty page has no links. Repeated rows are judged each, and each is a seed; an empty
    table gives no rows.
    """
    host, path = host_and_path(F.coalesce(F.col("url").cast("string"), F.lit("")))
    parsed = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"), F.col("html").alias("html"))
    decided = parsed.withColumn("ruled", ruled(F.col("host"), F.col("path"), rules))
    of = lambda verdict: F.count_if(F.col("ruled.verdict") == verdict)
    seeds = decided.where(F.col("ruled").isNotNull() & (F.col("host") != "")).groupBy("host").agg(of("allow").alias("trusted"), of("block").alias("blocked"))
    scores = written(propagated(written(links(parsed), "links"), seeds, rounds), "hosts")
    trust, distrust = (F.coalesce(c, F.lit(0)) for c in ("trust", "distrust"))
    reached = decided.select("page_id", "host", "path", "ruled").join(scores, "host", "left").withColumns({"trust": trust, "distrust": distrust})
    share = F.try_divide("trust", F.col("trust") + F.col("distrust"))
    own = F.when(F.coalesce(share, F.lit(1.0)) >= least, "allow").otherwise("block")
    return reached.select("page_id", "host", "path", "ruled.rule", F.coalesce("ruled.verdict", own).alias("verdict"), "trust", "distrust")
