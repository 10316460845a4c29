"""URL allow and block rules, spread over redirects and canonical links, in DataFrame operations only.

A rule is a host and a path prefix; it fits the host and its subdomains, and the longest fitting
rule wins (ties: the longer host, then allow).  Addresses that redirect to each other or name one
canonical address are aliases: connected components over those edges.  An address no rule fits is
blocked if its component holds a blocked address and no allowed one; an address with a rule of its
own keeps that rule, so an explicit allow always stands.

Links that a page declares are resolved as a browser does: against the page's address or its base tag,
with relative paths, dot segments, and addresses that begin with ``//``, ``/`` or ``?``; ``&amp;`` is read as
``&``.  A link to a place in the page itself, or of another kind than ``scheme://``, is no alias.

Defined cases: a null address or one without ``://`` has empty host and path and no rule, and is
allowed; addresses are judged once each, so repeated rows agree; edges with a null end are left
out; an empty table gives an empty result; other columns of ``pages`` are not carried.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from meterlake.llm import graph

#: action, host, path prefix
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Links a page declares: canonical address, and refresh to another one.
LINK_TAGS = (
    r"""(?is)<link\b(?=[^>]*\brel=["']?canonical\b)[^>]*\bhref=["']?([^"'\s>]+)""",
    r"""(?is)<meta\b(?=[^>]*\bhttp-equiv=["']?refresh\b)[^>]*\burl=["']?([^"'\s>]+)""",
)


_BASE_TAG = r"""(?is)<base\b[^>]*\bhref=["']?([^"'\s>]+)"""
_SCHEME = r"^[A-Za-z][A-Za-z0-9+.-]*:"


def host_of(url: Column) -> Column:
    host = F.coalesce(F.regexp_extract(url, _PARTS, 1), F.lit(""))
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _PARTS, 2), F.lit(""))


def _tidy(path: Column) -> Column:
    """A path from the root without dot segments; what follows it (query, fragment) stays."""
    own = F.regexp_extract(path, r"(?s)^([^?#]*)", 1)
    parts = F.split(own, "/")
    inner = F.slice(parts, F.lit(2), F.greatest(F.size(parts) - 1, F.lit(0)))

    def step(done: Column, part: Column) -> Column:
        up = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        return F.when(part == ".", done).when(part == "..", up).otherwise(F.concat(done, F.array(part)))

    left = F.aggregate(inner, F.array().cast("array<string>"), step)
    open_end = F.element_at(parts, -1).isin(".", "..") & (F.size(left) > 0)
    return F.concat(F.lit("/"), F.array_join(left, "/"), F.when(open_end, "/").otherwise(""), F.regexp_extract(path, r"(?s)^[^?#]*(.*)$", 1))


def resolved(link: Column, base: Column) -> Column:
    """The address that ``link`` means on a page at ``base``; null if it means none."""
    origin = F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*)", 1)
    path = F.regexp_extract(base, r"(?s)^[^:/?#]+://[^/?#]*([^?#]*)", 1)
    folder = F.regexp_extract(path, r"(?s)^(.*/)", 1)
    folder = F.when(folder == "", "/").otherwise(folder)
    return (
        F.when(link.rlike(_SCHEME), F.when(link.contains("://"), link))
        .when((origin == "") | base.isNull() | (link == "") | link.startswith("#"), F.lit(None))
        .when(link.startswith("//"), F.concat(F.regexp_extract(base, r"(?s)^([^:/?#]+:)", 1), link))
        .when(link.startswith("/"), F.concat(origin, _tidy(link)))
        .when(link.startswith("?"), F.concat(origin, path, link))
        .otherwise(F.concat(origin, _tidy(F.concat(folder, link))))
    )


def declared_links(pages: DataFrame) -> DataFrame:
    """Edges ``a``, ``b`` between a page's address and the addresses it declares in its html."""
    links = F.concat(*[F.coalesce(F.regexp_extract_all("html", F.lit(p), 1), F.array().cast("array<string>")) for p in LINK_TAGS])
    near = pages.where(F.col("html").rlike(r"(?i)canonical|http-equiv=.?refresh")).where("url IS NOT NULL")
    plain = lambda c: F.replace(c, F.lit("&amp;"), F.lit("&"))
    tag = plain(F.regexp_extract("html", _BASE_TAG, 1))
    base = F.when(tag == "", F.col("url")).otherwise(F.coalesce(resolved(tag, F.col("url")), F.col("url")))
    found = near.select(F.col("url").alias("a"), base.alias("base"), F.explode(links).alias("link"))
    found = found.select("a", resolved(plain(F.col("link")), F.col("base")).alias("b"))
    return found.where(F.col("b").contains("://"))


def fitting_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``url``, ``rule``, ``action`` of the winning rule; addresses without one are left out.

    Each address meets the rules through the suffixes of its host, an equi-join, so the rules may
    be many; the planner broadcasts them only when they are small.
    """
    labels = F.split("host", r"\.")
    suffix = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    wide = urls.select("url", "path", F.explode(suffix).alias("rule_host"))
    met = wide.join(rules, "rule_host").where(F.expr("startswith(path, rule_path)"))
    best = F.struct(
        (F.length("rule_host") + F.length("rule_path")).alias("n"), F.length("rule_host").alias("h"),
        (F.col("action") == "allow").alias("allow"), F.concat("rule_host", "rule_path").alias("rule"), "action",
    )
    return met.groupBy("url").agg(F.max(best).alias("_b")).select("url", "_b.rule", "_b.action")


def judge(pages: DataFrame, rules: DataFrame, edges: DataFrame) -> DataFrame:
    """Per row of ``pages``: page_id, host, path, rule, verdict, component.

    ``rules``: action, rule_host, rule_path; ``edges``: addresses ``a``, ``b`` that are aliases.
    ``component`` is the least address of the alias class, null for an address without aliases.
    """
    own = pages.select("url").where("url IS NOT NULL").distinct()
    classes = graph.components(edges).withColumnRenamed("node", "url")
    urls = own.union(classes.select("url")).distinct()
    urls = urls.select("url", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    fits = fitting_rules(urls, rules)
    members = classes.join(fits, "url")
    spread = members.groupBy("component").agg(
        F.max(F.col("action") == "block").alias("_blocked"), F.max(F.col("action") == "allow").alias("_allowed")
    )
    spread = classes.join(spread, "component").select("url", "component", (F.col("_blocked") & ~F.col("_allowed")).alias("_by_alias"))
    judged = fits.join(spread, "url", "full").select("url", "rule", "action", "component", "_by_alias")
    out = pages.select("page_id", F.col("url").alias("_url")).join(judged, F.col("_url") == F.col("url"), "left")
    verdict = F.coalesce("action", F.when(F.col("_by_alias"), "block"), F.lit("allow"))
    return out.select("page_id", host_of(F.col("_url")).alias("host"), path_of(F.col("_url")).alias("path"), "rule", verdict.alias("verdict"), "component")
