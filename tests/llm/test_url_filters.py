import random
import re
from html import escape
from urllib.parse import urljoin

import pytest

from pyspark.sql import functions as F

from smelter.llm.url_filters import RULES, Rule, absolute, judged, named_addresses

PAGES = "page_id LONG, url STRING, html STRING"
LINK = '<html><head><LINK href="{}" rel="canonical"></head>'
REFRESH = "<meta http-equiv='refresh' content='0; url={}'>"


def judge(spark, rows, rules=RULES):
    return {r["page_id"]: (r["rule"], r["verdict"]) for r in judged(spark.createDataFrame(rows, PAGES), rules).collect()}


def expected_rule(url):
    match = re.match(r"(?s).*?://([^/?#]*)([^?#]*)", url or "")
    host, path = (match[1], match[2]) if match else ("", "")
    host = host.translate({i: i + 32 for i in range(65, 91)})
    fits = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fits, key=lambda r: len(r.text), default=None)
    return host, path, best.text if best else None, best.action if best else None


URLS = [
    "https://a.example.org/es/1", "http://EXAMPLE.org/en/12?x=1", "http://example.org/en/2", "http://notexample.org/es/1", "https://x.com/fr/1#t", "https://x.com/de/1",
    "https://x.com/DE/1", "https://x.net/", "https://x.com", "org", "", None, "://org/a", "http://com/de/", "http://x.org?/es/", "ftp://É.ORG/a\nb", "http://x.orgs/", "a?b://x.org/c",
]


def test_the_longest_fitting_rule_decides(spark):
    rows = [(i, u, None) for i, u in enumerate(URLS)] + [(None, "http://x.org/", None), (3, URLS[3], "")]
    for r in judged(spark.createDataFrame(rows, PAGES)).collect():
        host, path, rule, action = expected_rule("http://x.org/" if r["page_id"] is None else URLS[r["page_id"]])
        assert (r["host"], r["path"], r["rule"]) == (host, path, rule)
        assert r["verdict"] == (action or "allow")


def test_blocks_reach_aliases_and_allowing_rules_win(spark):
    rows = [
        (1, "https://b.com/de/1", ""),
        (2, "https://mirror.net/1", LINK.format("https://b.com/de/1")),
        (3, "http://MIRROR.net/1#top", ""),
        (4, "https://far.net/x", REFRESH.format("//mirror.net/1")),
        (5, "https://both.net/x", LINK.format("https://c.com/de/2")),
        (6, "https://c.com/fr/2", REFRESH.format("https://both.net/x")),
        (7, "https://alone.net/", LINK.format("/other")),
        (8, "https://alone.net/other?utm_source=feed", None),
        (9, "https://named.net/", LINK.format("https://nowhere.com/de/")),
        (10, "https://own.org/", LINK.format("https://b.com/de/1")),
    ]
    verdicts = {k: v for k, (_, v) in judge(spark, rows).items()}
    # 10 is explicitly allowed, and so all its aliases without a rule of their own are.
    assert verdicts == {1: "block", 2: "allow", 3: "allow", 4: "allow", 5: "allow", 6: "allow", 7: "allow", 8: "allow", 9: "block", 10: "allow"}
    verdicts = {k: v for k, (_, v) in judge(spark, rows[:-1]).items()}
    assert [verdicts[k] for k in range(1, 10)] == ["block", "block", "block", "block", "allow", "allow", "allow", "allow", "block"]


@pytest.mark.parametrize(
    "html",
    [
        LINK.format("https://m.net/x") + REFRESH.format("https://b.com/de/1"),
        LINK.format("https://n.net/y") + REFRESH.format("https://b.com/de/1"),
        '<meta content="0;url=https://b.com/de/1" http-equiv="refresh">',
        "<META content='5; URL=https://b.com/de/1' name=x HTTP-EQUIV=Refresh>" + LINK.format("/x"),
    ],
)
def test_canonical_addresses_and_redirects_both_link(spark, html):
    rows = [(1, "https://m.net/x", html), (2, "https://b.com/de/1", None), (3, "https://n.net/y", None)]
    assert judge(spark, rows) == {1: (None, "block"), 2: ("com/de/", "block"), 3: (None, "block" if "n.net" in html else "allow")}


def test_many_aliases_of_one_page(spark):
    rows = [(i, f"https://m{i}.net/", LINK.format("https://b.com/de/1")) for i in range(200)]
    assert set(judge(spark, rows).values()) == {(None, "block")}


@pytest.mark.parametrize("rules", [(), (Rule("block", "a.net", "/"), Rule("allow", "a.net", "/"))])
def test_no_rules_and_ties(spark, rules):
    assert judge(spark, [(1, "http://a.net/", None)], rules) == {1: ("a.net/" if rules else None, "allow")}


def test_extra_columns_and_empty_tables(spark, clashing):
    rows = spark.createDataFrame([(1, "http://b.com/de/", None)], PAGES)
    assert judged(clashing(rows)).collect() == judged(rows).collect()
    assert judged(rows.limit(0)).collect() == []


def test_no_python_runs(spark):
    plan = judged(spark.createDataFrame([(1, "http://b.com/de/", None)], PAGES))._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


ADDRESSES = [
    "?p=2", "x", "../x", "../../../x?a=../b", "./", "..", "/a/./b/../c", "//m.net/y", "https://n.net", "a/b/?q#f", "x;y", "/", "/.hidden", "a..b/...",
]


@pytest.mark.parametrize("base", ["https://s.net/dir/p", "http://s.net", "https://s.net/a/b/c/?q=/x/y", "https://s.net/d/#t"])
def test_addresses_are_resolved_as_the_url_standard_says(spark, base):
    found = spark.createDataFrame([(a, base) for a in ADDRESSES], "a STRING, base STRING").select("a", absolute(F.col("a"), F.col("base")).alias("found"))
    for r in found.collect():
        expected = urljoin(base, r["a"])
        assert r["found"].removesuffix("/") == expected.removesuffix("/"), r["a"]
    full = spark.createDataFrame([("http://o.net/a/../b/./c?x=/../y", base)], "a STRING, base STRING").select(absolute(F.col("a"), F.col("base"))).first()
    assert full[0] == "http://o.net/b/c?x=/../y"


@pytest.mark.parametrize(
    "html, expected",
    [
        (LINK.format("/1") + LINK.format("/2") + LINK.format("/1") + REFRESH.format("/3"), {"/1", "/2", "/3"}),
        ("<!-- " + LINK.format("/1") + " -->" + LINK.format("/2") + "<!-- " + LINK.format("/3"), {"/2"}),
        ("<script>var x = '" + LINK.format("/1") + "';</script><link rel=canonical href=/2>", {"/2"}),
        (LINK.format("/1?a=1&amp;b=2&#38;c"), {"/1?a=1&b=2&c"}),
        ("<base href='/deep/er/'>" + LINK.format("x"), {"/deep/er/x"}),
        ("<link rel='next' href='/1'><link rel='alternate canonical' data-href='/2' href=\n'/3'><link rel=canonical>", {"/3"}),
        (LINK.format("mailto:a@b.net") + LINK.format("#top") + LINK.format(""), set()),
        ("x" * 300_000 + LINK.format("/1") + "y" * 300_000, {"/1"}),
        (None, set()),
    ],
)
def test_all_links_of_a_page_count(spark, html, expected):
    row = spark.createDataFrame([(html, "https://s.net/dir/p")], "html STRING, url STRING").select(named_addresses(F.col("html"), F.col("url")).alias("found")).first()
    assert len(row["found"]) == len(set(row["found"])) and set(row["found"]) == {"https://s.net" + a for a in expected}


def test_parameters_may_name_other_pages(spark):
    rows = [(1, "https://m.net/?ref=a", LINK.format("https://b.com/de/1")), (2, "https://m.net/?ref=b", None), (3, "https://n.net", LINK.format("?ref=a")), (4, "//m.net", LINK.format("/x"))]
    assert {k: v for k, (_, v) in judge(spark, rows).items()} == {1: "block", 2: "allow", 3: "allow", 4: "allow"}


@pytest.mark.parametrize("seed", range(3))
def test_random_link_graphs(spark, seed):
    draw = random.Random(seed)
    urls = [f"https://m{i}.net/{i}?x={i}" for i in range(120)] + [f"https://b.com/de/{i}" for i in range(8)] + [f"https://c.com/fr/{i}" for i in range(4)]
    rows, parent = [], {u: u for u in urls}

    def root(u):
        while parent[u] != u:
            u = parent[u]
        return u

    for i, u in enumerate(urls):
        named = draw.sample(urls, draw.choice([0, 0, 0, 1, 1, 2]))
        for v in named:
            parent[root(u)] = root(v)
        rows.append((i, u.replace("https", draw.choice(["http", "https"])), "".join(draw.choice([LINK, REFRESH]).format(escape(v)) for v in named)))
    rows += rows[:5]
    members = {}
    for u in urls:
        members.setdefault(root(u), set()).add(expected_rule(u)[3])
    expected = {i: expected_rule(u)[3] or ("block" if "block" in members[root(u)] and "allow" not in members[root(u)] else "allow") for i, u in enumerate(urls)}
    assert {k: v for k, (_, v) in judge(spark, rows).items()} == expected
