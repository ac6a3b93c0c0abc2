"""URL filters with redirect equivalence.

A url is judged by the longest rule that fits it. Pages that redirect to one another or name one
another as canonical are aliases: a page without a fitting rule is blocked if a page or address of its
group is blocked by a rule, unless one of them is allowed by a rule. A page's own rule always stands.

Defined results: null urls and urls without `://` have an empty host and path, fit no rule and are
allowed unless an alias is blocked; null or empty html has no links; repeated pages are judged alike;
an empty table gives no rows; other columns may have any name.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..session import written
from .components import components

LETTERS = ("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEME = r"(?s)^.*?://"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    found = F.regexp_extract(url, SCHEME + "([^/?#]*)", 1)
    return F.coalesce(F.translate(found, *LETTERS), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, SCHEME + "[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest fitting rule as a struct of name and verdict, or null. `rules` is a short list held
    in the plan; of rules of one length the first named wins."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    found = None
    for rule in ordered:
        fits = (host == rule.host) | F.endswith(host, F.lit("." + rule.host))
        fits = fits & F.startswith(path, F.lit(rule.path))
        value = F.struct(F.lit(rule.name).alias("name"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return F.lit(None).cast("struct<name:string,verdict:string>") if found is None else found


def address(url: Column) -> Column:
    """What names a page: scheme and host in lower case, a path, no fragment."""
    plain = F.regexp_replace(url, r"(?s)#.*$", "")
    head = F.regexp_extract(plain, r"(?s)^(.*?://[^/?#]*)", 1)
    rest = F.substr(plain, F.length(head) + 1)
    slash = F.when((head != "") & ~F.startswith(rest, F.lit("/")), "/").otherwise("")
    return F.concat(F.translate(head, *LETTERS), slash, rest)


TAG = r"""(?is)<(?:link|meta|base)(?=[\s/])(?:[^>"']|"[^"]*"|'[^']*')*>"""
ATTRIBUTE = r"""(?s)[^\s=>"'/]+\s*=\s*(?:"[^"]*"|'[^']*'|[^\s"'>]+)"""
NAMED = ("&amp;", "&"), ("&#38;", "&"), ("&#x26;", "&"), ("&quot;", '"'), ("&#39;", "'")


def attribute(tag: Column, name: str) -> Column:
    """The value of an attribute of a tag by its exact name, trimmed; empty where it is not there."""
    parts = F.regexp_extract_all(F.regexp_replace(tag, r"^<[a-zA-Z]+", ""), F.lit(ATTRIBUTE), F.lit(0))
    first = F.get(F.filter(parts, lambda p: F.rlike(p, F.lit(rf"(?is)^{name}\s*="))), 0)
    value = F.regexp_replace(first, r"(?s)^[^=]*=\s*", "")
    value = F.regexp_replace(value, r"""(?s)^(?:"(.*)"|'(.*)')$""", "$1$2")
    for entity, letter in NAMED:
        value = F.replace(value, F.lit(entity), F.lit(letter))
    return F.coalesce(F.regexp_replace(value, r"^\s+|\s+$", ""), F.lit(""))


def without_dots(url: Column) -> Column:
    """An absolute address with `.` and `..` taken out of its path."""
    head = F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    tail = F.regexp_extract(url, r"(?s)^[^?#]*(.*)$", 1)
    steps = F.split(F.substr(path, F.lit(2)), "/")

    def step(done: Column, name: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(name == ".", done).when(name == "..", up).otherwise(F.concat(done, F.array(name)))

    kept = F.aggregate(steps, F.array().cast("array<string>"), step)
    folder = F.when(F.rlike(path, F.lit(r"/\.\.?$")) & (F.size(kept) > 0), "/").otherwise("")
    short = F.concat(head, F.lit("/"), F.array_join(kept, "/"), folder, tail)
    return F.when(F.rlike(path, F.lit(r"/\.\.?(?:/|$)")), short).otherwise(url)


def joined_link(link: Column, base: Column) -> Column:
    """A link behind the address it is relative to; empty for other schemes and places in the page itself."""
    scheme = F.regexp_extract(base, r"(?s)^(.*?:)//", 1)
    origin = F.regexp_extract(base, r"(?s)^(.*?://[^/?#]*)", 1)
    plain = F.regexp_replace(base, r"(?s)[?#].*$", "")
    folder = F.regexp_extract(plain, r"(?s)^(.*?://[^/]*.*/|.*?://[^/]*)", 1)
    return (
        F.when((link == "") | F.startswith(link, F.lit("#")), "")
        .when(F.rlike(link, F.lit(r"(?s)^[a-zA-Z][a-zA-Z0-9+.-]*://")), link)
        .when(F.rlike(link, F.lit(r"^[a-zA-Z][a-zA-Z0-9+.-]*:")) | (origin == ""), "")
        .when(F.startswith(link, F.lit("//")), F.concat(scheme, link))
        .when(F.startswith(link, F.lit("/")), F.concat(origin, link))
        .when(F.startswith(link, F.lit("?")), F.concat(plain, link))
        .otherwise(F.concat(F.regexp_replace(folder, "/$", ""), F.lit("/"), link))
    )


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use` of a value as the argument of a lambda, so that a long expression stands in the plan once,
    however often it is read."""
    return F.get(F.transform(F.array(value), use), 0)


def resolved(link: Column, base: Column) -> Column:
    """A link of a page as an absolute address; empty where `joined_link` is."""
    return F.coalesce(bound(joined_link(link, base), without_dots), F.lit(""))


def link_targets(html: Column, url: Column) -> Column:
    """Canonical links and redirects of a page as absolute addresses. Tags in comments do not count; the
    first `<base href>` is what links are relative to."""
    shown = F.regexp_replace(html, r"(?s)<!--.*?(?:-->|\z)", "")
    tags = F.coalesce(F.regexp_extract_all(shown, F.lit(TAG), F.lit(0)), F.array().cast("array<string>"))
    target = r"""(?is)\burl\s*=\s*["']?\s*([^"'\s]+)"""

    def named(tags: Column, name: str) -> Column:
        return F.filter(tags, lambda t: F.rlike(t, F.lit(rf"(?i)^<{name}\b")))

    def links(tags: Column) -> Column:
        words = lambda tag: F.split(F.lower(attribute(tag, "rel")), r"\s+")
        canonical = F.filter(named(tags, "link"), lambda t: F.array_contains(words(t), "canonical"))
        refresh = F.filter(named(tags, "meta"), lambda t: F.lower(attribute(t, "http-equiv")) == "refresh")
        hrefs = F.transform(canonical, lambda t: attribute(t, "href"))
        return F.concat(hrefs, F.transform(refresh, lambda t: F.regexp_extract(attribute(t, "content"), target, 1)))

    def base(tags: Column) -> Column:
        hrefs = F.filter(F.transform(named(tags, "base"), lambda t: attribute(t, "href")), lambda h: h != "")
        return F.coalesce(F.nullif(resolved(F.get(hrefs, 0), url), F.lit("")), url)

    def absolute(tags: Column) -> Column:
        return bound(base(tags), lambda page: F.transform(links(tags), lambda t: resolved(t, page)))

    return F.filter(bound(tags, absolute), lambda t: t != "")


def alias_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """`a, b`: a page's address and what it redirects to or names as canonical."""
    links = pages.select(F.col(url).alias("_url"), F.explode(link_targets(F.col(html), F.col(url))).alias("_to"))
    edges = links.select(address(F.col("_url")).alias("a"), address(F.col("_to")).alias("b"))
    return edges.where("a <> b").distinct()


def judge(
    pages: DataFrame, rules: Sequence[Rule], ident: str = "page_id", url: str = "url", edges: DataFrame | None = None
) -> DataFrame:
    """`ident, host, path, rule, verdict, alias_root`. `edges` (a, b) may add known redirects."""
    links = alias_edges(pages, url)
    if edges is not None:
        links = links.union(edges.select(address(F.col("a")), address(F.col("b"))))
    roots = written(components(written(links, "links")), "roots")
    ruled = roots.withColumn("_rule", fitting_rule(host_of(F.col("node")), path_of(F.col("node")), rules))
    groups = ruled.groupBy("root").agg(
        F.coalesce(F.bool_or(F.col("_rule.verdict") == "block"), F.lit(False)).alias("_blocked"),
        F.coalesce(F.bool_or(F.col("_rule.verdict") == "allow"), F.lit(False)).alias("_allowed"),
    )
    decided = roots.join(groups, "root").select(
        "node", F.col("root").alias("alias_root"), (F.col("_blocked") & ~F.col("_allowed")).alias("_inherits")
    )
    own = pages.select(
        F.col(ident).alias(ident),
        host_of(F.col(url)).alias("host"),
        path_of(F.col(url)).alias("path"),
        address(F.col(url)).alias("_address"),
    ).withColumn("_rule", fitting_rule(F.col("host"), F.col("path"), rules))
    joined = own.join(decided, F.col("_address") == F.col("node"), "left")
    inherited = F.when(F.coalesce("_inherits", F.lit(False)), "block").otherwise("allow")
    return joined.select(
        ident,
        "host",
        "path",
        F.col("_rule.name").alias("rule"),
        F.coalesce("_rule.verdict", inherited).alias("verdict"),
        "alias_root",
    )
