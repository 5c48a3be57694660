"""Rules, links and propagation of the URL filters against plain computations over a planted link graph."""

import random
import re
from collections import defaultdict

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from basketry.llm import url_filters
from basketry.llm.oracle import ORACLE
from basketry.llm.queries import URL_RULES

SCHEMA = "page_id long, url string, html string"


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def split(url):
    if url is None or "://" not in url:
        return "", ""
    after = url.split("://", 1)[1]
    host = re.match("[^/?#]*", after)[0]
    return lower(host), re.match("[^?#]*", after[len(host) :])[0]


def rule_of(host, path, rules):
    fits = []
    for verdict, rule in rules:
        name, start = rule[: rule.index("/")], rule[rule.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(start):
            fits.append((-len(rule), rule, verdict))
    return min(fits)[1:] if fits else (None, None)


def plain(rows, edges, rules, rounds=20):
    """page_id, host, path, rule, verdict, trust, distrust from rows and the edges between their hosts."""
    pages = [(i, *split(url)) for i, url, _ in rows]
    scores = {}
    for kind, verdict in (("trust", "allow"), ("distrust", "block")):
        out = defaultdict(set)
        for a, b in edges:
            out[a if kind == "trust" else b].add(b if kind == "trust" else a)
        amounts = defaultdict(int)
        for _, host, path in pages:
            if host and rule_of(host, path, rules)[1] == verdict:
                amounts[host] += 150_000
        total = defaultdict(int, amounts)
        for _ in range(rounds):
            after = defaultdict(int)
            for host, amount in amounts.items():
                for other in out[host]:
                    after[other] += amount // len(out[host])
            amounts = {h: a * 85 // 100 for h, a in after.items()}
            for host, amount in amounts.items():
                total[host] += amount
        scores[kind] = total
    found = []
    for i, host, path in pages:
        rule, verdict = rule_of(host, path, rules)
        trust, distrust = scores["trust"][host], scores["distrust"][host]
        own = "allow" if trust + distrust == 0 or trust / (trust + distrust) >= 0.5 else "block"
        found.append((i, host, path, rule, verdict or own, trust, distrust))
    return sorted(found, key=repr)


def run(spark, rows, **more):
    frame = spark.createDataFrame([(*r, "h", 1) for r in rows], SCHEMA + ", host string, trust int").repartition(3)
    return sorted(map(tuple, url_filters.judged(frame, URL_RULES, **more).collect()), key=repr)


def graph(seed):
    """Pages of 30 hosts with random links, and the edges those stand for."""
    pick = random.Random(seed)
    hosts = [f"{a}.example.{tld}" for a in ("a", "b", "www.c", "d", "e", "f", "g", "h", "i", "j") for tld in ("com", "net", "org")]
    rows, edges = [], set()
    for i in range(200):
        host = pick.choice(hosts[:6] if i % 3 == 0 else hosts)
        targets = pick.choices(hosts, k=pick.randint(0, 4))
        edges |= {(host, t) for t in targets if t != host}
        path = pick.choice(["/fr/1", "/de/2", "/en/1x", "/en/2", "/es/", "", "/"])
        parts = [pick.choice(['<a href="https://{}/x">', "<A class=q HREF='//{}'>", "<a\nhref = http://{}?q>", '<p><a id="1"href="HTTP://{}#f">']).format(t.upper() if j else t) for j, t in enumerate(targets)]
        junk = ['<!-- <a href="http://no.example.com/"> -->', "<script>'<a href=\"http://no.example.net/\">'</script>", '<a href="/own">', '<abbr href="http://no.example.org/">', "<a data-href='http://no.example.org/'>"]
        rows.append((i, pick.choice(["http", "HTTPS"]) + "://" + host.upper() + path + pick.choice(["", "?u=http://x/", "#a/b"]), " ".join(parts + junk)))
    return rows, edges


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_plain_propagation_and_sql(spark, seed):
    rows, edges = graph(seed)
    found = run(spark, rows)
    assert found == plain(rows, edges, URL_RULES)
    assert {r[4] for r in found if r[3] is None} == {"allow", "block"}
    con = duckdb.connect()
    con.register("pages", pa.table({"page_id": [r[0] for r in rows], "url": [r[1] for r in rows], "html": [r[2] for r in rows]}))
    columns = "page_id, host, path, rule, verdict, trust, distrust"
    assert sorted(con.execute(f"select {columns} from ({ORACLE['op11_url_filters']})").fetchall(), key=repr) == found


def test_trust_follows_links_and_distrust_goes_against_them(spark):
    rows = [
        (1, "http://good.com/fr/", '<a href="http://liked.net/">'),
        (2, "http://liked.net/", '<a href="http://twice.net/">'),
        (3, "http://twice.net/", None),
        (4, "http://bad.com/de/", '<a href="http://victim.net/">'),
        (5, "http://spam.net/", '<a href="http://bad.com/x">'),
        (6, "http://farm.net/", '<a href="http://spam.net/">'),
        (7, "http://victim.net/", ""),
        (8, "http://unknown.net/", "<p>"),
    ]
    verdicts = {r[0]: r[4] for r in run(spark, rows)}
    assert verdicts == {1: "allow", 2: "allow", 3: "allow", 4: "block", 5: "block", 6: "block", 7: "allow", 8: "allow"}


def test_odd_urls_pages_and_repeats(spark):
    rows = [
        (1, None, None), (2, "", ""), (3, "no scheme", '<a href="http://x.net/">'), (4, "://", "<a href="), (5, "a://b://c/d?e", "x" * 300_000),
        (6, "http://org", ""), (7, "http://org/", ""), (8, "http://xorg/", ""), (9, "http://example.org/es/1", ""), (9, "http://example.org/es/1", ""),
        (None, "http://example.org/en/12", '<a href="http://Ä.net/?q#r">'), (10, "http://Ä.net/fr/", "<a " * 50_000), (11, "x://A.COM/fr/?x", None),
        (12, "http://?/de/", None), (13, "http://example.org/en", "<!-- <a href='http://x.net/'>"),
    ]
    edges = {("example.org", "Ä.net"), ("example.org", "x.net")}  # the comment is not closed
    assert run(spark, rows) == plain(rows, edges, URL_RULES)
    assert run(spark, []) == []


def test_longest_rule_wins_and_equal_ones_by_text(spark):
    frame = spark.createDataFrame([("a.b.org", "/x/y")], "host string, path string")
    def pick(*rules):
        return frame.select(url_filters.ruled(F.col("host"), F.col("path"), rules).alias("r")).first().r
    assert pick(("allow", "org/"), ("block", "b.org/x")) == ("b.org/x", "block")
    assert pick(("block", "b.org/x"), ("allow", "org/x/y")) == ("b.org/x", "block")
    assert pick(("allow", ".org/"), ("block", "c.org/")) is None
