"""URL filters: block and allow rules, and blocks that reach aliases through redirects and canonical links.

DataFrame functions only. URLs that a redirect or a canonical link ties together are aliases; the classes are connected
components. A URL's own rule decides it, allow or block; without one, a URL is blocked if any alias has a block rule.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .components import components
from .shared import fresh, without, written

CAPITALS, SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


def let(values: dict[str, Column], body: Callable[[Column], Column]) -> Column:
    """`body` of a struct of `values`, each of which is evaluated once however often the body names it."""
    return F.element_at(F.transform(F.array(F.struct(*[v.alias(k) for k, v in values.items()])), body), 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def host_of(url: Column) -> Column:
    """After the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; empty for null or without `://`."""
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), CAPITALS, SMALL)


def path_of(url: Column) -> Column:
    """What follows the host, up to `?`, `#` or the end."""
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule (host, path and verdict) that fits; of equally long ones an allow rule, then the first by name."""

    def longest(x: Column) -> Column:
        found = F.lit(None).cast("string")
        for rule in sorted(rules, key=lambda r: (len(r.name), r.verdict == "allow", [-ord(c) for c in r.name])):
            fits = ((x.host == rule.host) | x.host.endswith("." + rule.host)) & x.path.startswith(rule.path)
            found = F.when(fits, F.lit(rule.name)).otherwise(found)
        return found

    return let({"host": host, "path": path}, longest)


def node_of(url: Column) -> Column:
    """A URL as a node of the alias graph: without fragment, scheme and host lower-cased; null without `://`."""
    parts = r"(?s)^(.*?://[^/?#]*)([^#]*)"
    return F.nullif(F.concat(F.translate(F.regexp_extract(url, parts, 1), CAPITALS, SMALL), F.regexp_extract(url, parts, 2)), F.lit(""))


def links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(a, b): the page's node, and the node that its canonical link or its refresh redirect names.

    Read from `<link rel=canonical href=...>` and `<meta http-equiv=refresh content="...url=...">`, attributes in any
    order and quotes. Relative references are resolved: `//` by the scheme, `/` by the host, `?` by the page's path, others
    by the directory of the page's path, `.` and `..` at their beginning taken out; one with another scheme than a `://`
    one (as mailto:) is left out.
    """
    tags = F.filter(F.regexp_extract_all(F.col(html), F.lit(r"(?is)<(?:link|meta)\b[^>]*>"), 0), lambda t: F.lower(t).rlike("canonical|refresh"))
    tag = F.regexp_replace(F.col("tag"), r"\s+", " ")
    canonical = F.when(tag.rlike(r"""(?i)\brel ?= ?["']?canonical\b"""), F.regexp_extract(tag, r"""(?i)\bhref ?= ?["']?([^"' >]+)""", 1))
    refresh = F.when(tag.rlike(r"""(?i)http-equiv ?= ?["']?refresh\b"""), F.regexp_extract(tag, r"""(?i)\burl ?= ?["']?([^"' >]+)""", 1))
    target = F.coalesce(F.nullif(canonical, F.lit("")), F.nullif(refresh, F.lit("")))
    own = F.col(url)
    scheme = F.substring(own, F.lit(1), F.instr(own, "://") - 1)

    def full(x: Column) -> Column:
        site = F.concat(x.scheme, F.lit("://"), x.host)
        folder = F.regexp_replace(x.path, "[^/]*$", "")
        ups = F.regexp_extract(x.target, r"^(?:\.\.?/)*", 0)
        number = F.least((F.length(ups) - F.length(F.replace(ups, F.lit("../"), F.lit("")))) / 3, F.lit(999)).cast("int").cast("string")
        above = F.regexp_replace(folder, F.concat(F.lit("(?:[^/]+/){0,"), number, F.lit("}$")), F.lit(""))
        beside = F.concat(site, F.when(above == "", "/").otherwise(above), F.substring(x.target, F.length(ups) + 1, F.length(x.target)))
        return (
            F.when(x.target.startswith("//"), F.concat(x.scheme, F.lit(":"), x.target)).when(x.target.startswith("/"), F.concat(site, x.target)).when(x.target.startswith("?"), F.concat(site, x.path, x.target))
            .when(x.target.rlike("^[^/?#]*://"), x.target).when(x.target.rlike("^([A-Za-z][A-Za-z0-9+.-]*:|#)"), F.lit(None)).otherwise(beside)
        )

    target = let({"target": target, "scheme": scheme, "host": host_of(own), "path": path_of(own)}, full)
    found = pages.where(F.col(url).isNotNull() & F.col(html).rlike("(?i)canonical|refresh")).select(url, F.explode(tags).alias("tag"))
    return found.select(node_of(own).alias("a"), target.alias("target")).select("a", node_of(F.col("target")).alias("b")).where("a is not null and b is not null")


def judged(pages: DataFrame, rules: list[Rule], url: str = "url", html: str = "html", edges: DataFrame | None = None) -> DataFrame:
    """Adds host, path, rule and verdict to every row (own columns of these names are replaced).

    `edges` (a, b: URLs) are further redirects. A null URL, and one without `://`, has an empty host and path, no rule
    and no alias: it is allowed. Repeated rows are judged alike. What is listed by the rules is a Python list, so it is
    meant for hundreds of rules, not millions.
    """
    block = [r.name for r in rules if r.verdict == "block"]
    allow = [r.name for r in rules if r.verdict == "allow"]
    ties = links(pages, url, html)
    if edges is not None:
        ties = ties.unionByName(edges.select(node_of(F.col("a")).alias("a"), node_of(F.col("b")).alias("b")))
    node, mark = fresh(pages, "node", "blocked")
    classes = components(written(ties, "links"))
    blocked = classes.where(rule_of(host_of(F.col("node")), path_of(F.col("node")), rules).isin(block)).select("component").distinct()
    aliases = classes.join(blocked, "component", "left_semi").select(F.col("node").alias(node), F.lit(True).alias(mark))
    new = ("host", "path", "rule", "verdict")
    own = pages.select(*[F.col(f"`{c}`") for c in without(pages, new)], host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"), node_of(F.col(url)).alias(node))
    own = own.withColumn("rule", rule_of(F.col("host"), F.col("path"), rules))
    verdict = F.when(F.col("rule").isin(block), "block").when(F.col("rule").isin(allow), "allow").when(F.col(mark), "block").otherwise("allow")
    return own.join(aliases, node, "left").withColumn("verdict", verdict).drop(node, mark)
