"""URL rules with redirect equivalence, in DataFrame operations only.

A rule names a host, which covers its subdomains, and the start of a path; the longest rule that fits
a URL decides. URLs that redirect to one another or name one canonical address are aliases: canonical
links and refresh redirects in the pages (and redirects given beside them) are edges, and connected
components of the edges are the groups of aliases. A URL without a rule of its own takes the
decision of its group: allow if a member is explicitly allowed, else block if one is explicitly blocked.
Without either it is allowed.

URLs are the same node if they differ in the fragment, or in the case of the host, only. Rules are
looked up with array functions if there are few, and by a join on each part of the host if there are
many; the second form shuffles distinct (host, path) pairs.

Defined cases: null URL or one without `://`: empty host and path, no rule, no aliases, allowed. Null
html: no edges. A relative target is resolved against its page. Rules of one text: allow wins.
Repeated rows: one result each; empty tables: none. Only page_id, url and html are read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm.components import components
from tidemart.session import Scratch

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: up to so many rules are an array in the plan
FEW_RULES = 64


@dataclass(frozen=True)
class UrlRule:
    host: str
    path: str  # with its leading slash
    allow: bool

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """The URL without fragment, with a lower-cased host and at least `/` as path; else null."""
    part = lambda k: F.regexp_extract(url, r"(?s)^(.*?)://([^/?#]*)([^?#]*)(\?[^#]*)?", k)
    path = F.when(part(3) == "", F.lit("/")).otherwise(part(3))
    return F.when(url.contains("://"), F.concat(F.lower(part(1)), F.lit("://"), host_of(url), path, part(4)))


def page_edges(pages: DataFrame) -> DataFrame:
    """(a, b): node of the page and node of its canonical link or refresh target."""
    quoted = r"""=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
    value = lambda tag, name: F.concat(*[
        F.regexp_extract(tag, rf"(?is)\b{name}\s*{quoted}", k) for k in (1, 2, 3)])
    link = F.regexp_extract("html", r"""(?is)<link\b[^>]*\brel\s*=\s*["']?canonical\b[^>]*>""", 0)
    meta = F.regexp_extract("html", r"""(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["']?refresh\b[^>]*>""", 0)
    target = F.regexp_extract(value(meta, "content"), r"""(?is)\burl\s*=\s*["']?([^"']*)""", 1)
    found = (
        pages.where(F.col("url").contains("://") & F.col("html").rlike(r"(?i)\bcanonical\b|\brefresh\b"))
        .select("url", F.explode(F.array(value(link, "href"), target)).alias("to"))
        .select("url", F.replace(F.trim("to"), F.lit("&amp;"), F.lit("&")).alias("to")).where(F.col("to") != "")
    )
    scheme = F.regexp_extract("url", r"(?s)^(.*?)://", 1)
    site = F.regexp_extract("url", r"(?s)^.*?://[^/?#]*", 0)
    folder = F.regexp_replace(path_of(F.col("url")), r"[^/]*$", "")
    to = (
        F.when(F.col("to").rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), F.col("to"))
        .when(F.col("to").startswith("//"), F.concat(scheme, F.lit(":"), F.col("to")))
        .when(F.col("to").startswith("/"), F.concat(site, F.col("to")))
        .when(F.col("to").startswith("#"), F.col("url"))
        .otherwise(F.concat(site, F.when(folder == "", F.lit("/")).otherwise(folder), F.col("to")))
    )
    return found.select(node_of(F.col("url")).alias("a"), node_of(to).alias("b"))


def _by_array(urls: DataFrame, rules: list[UrlRule]) -> DataFrame:
    known = F.array(*[
        F.struct(F.length(F.lit(r.text)).alias("n"), F.lit(r.allow).alias("allow"), F.lit(r.text).alias("rule"),
                 F.lit(r.host).alias("host"), F.lit(r.path).alias("path")) for r in rules])
    fits = F.filter(known, lambda r: (
        ((F.col("host") == r["host"]) | F.col("host").endswith(F.concat(F.lit("."), r["host"])))
        & F.col("path").startswith(r["path"])))
    return urls.withColumn("best", F.array_max(fits))


def _by_join(urls: DataFrame, rules: list[UrlRule]) -> DataFrame:
    spark = urls.sparkSession
    known = spark.createDataFrame(
        [(r.host, r.path, len(r.text), r.allow, r.text) for r in rules],
        "rule_host string, rule_path string, n int, allow boolean, rule string")
    labels = F.split("host", r"\.")
    ends = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    best = (
        urls.select("host", "path").distinct().withColumn("rule_host", F.explode(ends))
        .join(known, "rule_host").where(F.col("path").startswith(F.col("rule_path")))
        .groupBy("host", "path").agg(F.max(F.struct("n", "allow", "rule")).alias("best"))
    )
    return urls.join(best, ["host", "path"], "left")


def with_rule(urls: DataFrame, rules: list[UrlRule], few: int = FEW_RULES) -> DataFrame:
    """``urls`` (host, path, ...) with rule and allow of the longest rule that fits, or nulls."""
    if not rules:
        return urls.withColumn("rule", F.lit(None).cast("string")).withColumn("allow", F.lit(None).cast("boolean"))
    found = _by_array(urls, rules) if len(rules) <= few else _by_join(urls, rules)
    return found.select(*urls.columns, F.col("best")["rule"].alias("rule"), F.col("best")["allow"].alias("allow"))


def filter_urls(pages: DataFrame, rules: list[UrlRule], redirects: DataFrame | None = None) -> DataFrame:
    """(page_id, host, path, rule, verdict, alias_of) for every row of ``pages`` (page_id, url, html).

    ``redirects`` (from_url, to_url) adds edges seen elsewhere. alias_of is the least URL of the
    page's group of aliases, or null.
    """
    spark: SparkSession = pages.sparkSession
    scratch = Scratch(spark, "urls")
    edges = page_edges(pages)
    if redirects is not None:
        edges = edges.unionAll(redirects.select(node_of(F.col("from_url")).alias("a"), node_of(F.col("to_url")).alias("b")))
    groups = components(edges, scratch, "aliases")
    members = with_rule(groups.withColumn("host", host_of(F.col("node"))).withColumn("path", path_of(F.col("node"))), rules)
    decided = members.groupBy("component").agg(F.max("allow").alias("group_allow")).where(F.col("group_allow").isNotNull())
    aliases = groups.join(decided, "component", "left").select("node", "component", "group_allow")
    url = F.col("url")
    judged = with_rule(pages.select("page_id", node_of(url).alias("node"), host_of(url).alias("host"), path_of(url).alias("path")), rules)
    return judged.join(aliases, "node", "left").select(
        "page_id", "host", "path", "rule",
        F.when(F.coalesce("allow", "group_allow", F.lit(True)), F.lit("allow")).otherwise(F.lit("block")).alias("verdict"),
        F.col("component").alias("alias_of"),
    )
