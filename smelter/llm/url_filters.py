"""URL rules, and block decisions that reach a page's aliases.

A rule names a host and a path, and fits its host and all subdomains where the path begins with the rule's; the longest
fitting rule decides. Urls are aliases if they differ in scheme, letter case of the host, fragment or an empty path only, or
if one page names the other as its canonical address or redirects to it. Every such link of a page counts, but those in
comments and scripts; addresses are resolved against the page's base. Parameters are kept, as they may name pages. Aliases form
components, found by distributed connected components over these links. A url without a rule is allowed if any of its
aliases is explicitly allowed, else blocked if any is blocked, else allowed. A rule of its own always decides first.

A null url, or one without ``://``, has an empty host and path and is an alias of equal texts only. A null html names
nothing, and a relative address on a page without site neither. A very long html is searched whole. Repeated rows, null and
repeated ids pass through. Extra columns aren't read. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from smelter.llm.components import components
from smelter.llm.shared import needed, stored

ALLOW, BLOCK = "allow", "block"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    action: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (Rule(ALLOW, "org", "/"), Rule(BLOCK, "example.org", "/es/"), Rule(BLOCK, "example.org", "/en/1"), Rule(ALLOW, "com", "/fr/"), Rule(BLOCK, "com", "/de/"))


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...]) -> tuple[Column, Column]:
    """Text and action of the longest rule that fits; null if none does. Of equally long ones an allowing rule wins."""
    texts, actions = [], []
    for rule in sorted(rules, key=lambda r: (-len(r.text), r.action != ALLOW, r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        texts.append(F.when(fits, F.lit(rule.text)))
        actions.append(F.when(fits, F.lit(rule.action)))
    return (F.coalesce(*texts), F.coalesce(*actions)) if texts else (F.lit(None).cast("string"), F.lit(None).cast("string"))


def plain_form(url: Column) -> Column:
    """What a url's variants by scheme, case of the host and fragment share; an empty path is the root."""
    query = F.regexp_extract(url, r"(?s)^.*?://[^?#]*(\?[^#]*)", 1)
    path = path_of(url)
    plain = F.concat(host_of(url), F.when(path == "", "/").otherwise(path), query)
    return F.coalesce(F.when(url.contains("://"), plain).otherwise(url), F.lit(""))


def _tags(html: Column, name: str) -> Column:
    return F.regexp_extract_all(html, F.lit(f"(?i)<{name}\\b[^>]*>"), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """An attribute's value without quotes, character references resolved; empty if the tag hasn't it."""
    pattern = rf"(?is)(?<![\w-]){name}\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+))"
    value = F.concat(*[F.regexp_extract(tag, pattern, group) for group in (1, 2, 3)])
    for reference, character in (("quot|#34|#x22", '"'), ("apos|#39|#x27", "'"), ("lt|#60|#x3c", "<"), ("gt|#62|#x3e", ">"), ("amp|#38|#x26", "&")):
        value = F.regexp_replace(value, f"(?i)&({reference});", character)
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def _with(value: Column, use: Callable[[Column], Column]) -> Column:
    """An expression over a value that is evaluated once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def named_addresses(html: Column, url: Column) -> Column:
    """All addresses that a page names as its canonical one and redirects to, absolute, each once."""

    def raw(seen: Column) -> Column:
        canonical = F.filter(_tags(seen, "link"), lambda t: _attribute(t, "rel").rlike(r"(?i)(^|\s)canonical(\s|$)"))
        refresh = F.filter(_tags(seen, "meta"), lambda t: _attribute(t, "http-equiv").rlike("(?i)^refresh$"))
        target = F.transform(refresh, lambda t: F.regexp_extract(_attribute(t, "content"), r"(?i)\burl\s*=\s*[\"']?([^\"'\s>]+)", 1))
        return F.concat(F.transform(canonical, lambda t: _attribute(t, "href")), target)

    def base(seen: Column) -> Column:
        given = F.get(F.filter(F.transform(_tags(seen, "base"), lambda t: _attribute(t, "href")), lambda h: h != ""), F.lit(0))
        return F.coalesce(_with(given, lambda h: absolute(h, url)), url)

    def resolved(seen: Column) -> Column:
        return _with(base(seen), lambda b: F.array_distinct(F.array_compact(F.transform(raw(seen), lambda a: absolute(a, b)))))

    return _with(F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script|\z)", " "), resolved)


def absolute(address: Column, base: Column) -> Column:
    """An address resolved against the url of its page; null if it is empty, a mere fragment or of another kind than a url."""
    site = F.nullif(F.regexp_extract(base, "(?s)^(.*?://[^/?#]*)", 1), F.lit(""))
    folder = F.regexp_extract(path_of(base), "(?s)^(.*/)", 1)
    joined = (
        F.when((address == "") | address.startswith("#"), None)
        .when(address.rlike("(?i)^[a-z][a-z0-9+.-]*://"), address)
        .when(address.startswith("//"), F.concat(F.substring_index(site, "//", 1), address))
        .when(address.rlike("(?i)^[a-z][a-z0-9+.-]*:"), None)
        .when(address.startswith("/"), F.concat(site, address))
        .when(address.startswith("?"), F.concat(site, path_of(base), address))
        .otherwise(F.concat(site, F.when(folder == "", "/").otherwise(folder), address))
    )
    return _with(joined, _without_dots)


def _without_dots(url: Column) -> Column:
    """Segments ``.`` and ``..`` of the path resolved; none goes above the root."""
    path = path_of(url)
    parts = F.split(path, "/")
    step = lambda seen, x: F.when(x == ".", seen).when(x == "..", F.slice(seen, 1, F.greatest(F.size(seen) - 1, F.lit(1)))).otherwise(F.concat(seen, F.array(x)))
    kept = F.aggregate(F.slice(parts, 2, F.greatest(F.size(parts) - 1, F.lit(0))), F.slice(parts, 1, 1), step)
    kept = F.when(path.rlike(r"(?s)/\.\.?\z"), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    site, rest = F.regexp_extract(url, "(?s)^(.*?://[^/?#]*)", 1), F.regexp_extract(url, r"(?s)^.*?://[^?#]*([?#].*)\z", 1)
    return F.when(path.contains("/."), F.concat(site, F.array_join(kept, "/"), rest)).otherwise(url)


def judged(pages: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per page."""
    rows = needed(pages, {"page_id": "long", "url": "string", "html": "string"})
    rows = rows.withColumn("named", named_addresses(F.col("html"), F.col("url")))
    rule, action = fitting_rule(host_of(F.col("url")), path_of(F.col("url")), rules)
    reached = lambda x: F.struct(plain_form(x).alias("target"), fitting_rule(host_of(x), path_of(x), rules)[1].alias("target_action"))
    facts = rows.select(
        "page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"), rule.alias("rule"), action.alias("action"),
        plain_form(F.col("url")).alias("node"), F.transform("named", reached).alias("targets"),
    )
    facts = stored(facts, "urls")

    named = facts.select("node", F.explode("targets").alias("x")).select("node", "x.target", "x.target_action")
    classes = components(named.filter(F.col("target") != F.col("node")).select("node", "target"), "node", "target")
    decided = facts.select("node", "action").unionByName(named.select(F.col("target").alias("node"), F.col("target_action").alias("action")))
    per_node = decided.groupBy("node").agg(F.max(F.col("action") == ALLOW).alias("allowed"), F.max(F.col("action") == BLOCK).alias("blocked"))
    per_node = per_node.join(classes, "node", "left").select("node", F.coalesce("component", "node").alias("component"), "allowed", "blocked")
    per_class = per_node.groupBy("component").agg(F.max("allowed").alias("allowed"), F.max("blocked").alias("blocked"))
    spread = stored(per_node.select("node", "component").join(per_class, "component").filter(F.col("blocked") & ~F.coalesce("allowed", F.lit(False))).select("node"), "blocked")
    blocked = spread.withColumn("reached", F.lit(True))

    joined = facts.join(blocked, "node", "left")
    verdict = F.coalesce("action", F.when(F.col("reached"), BLOCK).otherwise(ALLOW))
    return joined.select("page_id", "host", "path", "rule", verdict.alias("verdict"))
