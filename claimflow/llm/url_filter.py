"""URL filter with redirect equivalence.

A page's own rule decides first: of the rules that fit its host (or a parent
domain) and the start of its path, the longest. Redirects (``<meta refresh>``)
and canonical links make URLs aliases; the connected components of these links
carry decisions to pages without a rule: a component with an explicitly allowed
member is allowed, else one with a blocked member is blocked, else allowed.
Two URLs are one node if they differ in scheme, default port, fragment, a
closing slash or the case of the host.

Scale: native expressions only. Rules meet pages in an equi-join on host
suffixes of the distinct (host, path) pairs, so rule lists may be long. Links go
through star contraction with pre-aggregated minima, and evidence is aggregated
per component before it is joined back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import stage_table
from claimflow.llm.components import connected_components

_UPPER, _SMALL = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# A tag ends at the next > or <, so that unclosed ones stay short.
LINK_TAG = r"(?i)<link\b[^<>]*+>"
META_TAG = r"(?i)<meta\b[^<>]*+>"
CANONICAL = r"(?i)\brel\s*=\s*[\"']?canonical\b"
REFRESH = r"(?i)\bhttp-equiv\s*=\s*[\"']?refresh\b"
HREF = r"(?i)\bhref\s*=\s*[\"']?([^\"'\s>]+)"
TARGET = r"(?i)\burl\s*=\s*[\"']?([^\"'\s>;]+)"


def _rest(url: Column) -> Column:
    return F.when(F.instr(url, "://") > 0, F.substr(url, F.instr(url, "://") + F.lit(3)))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _SMALL), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def node_of(url: Column) -> Column:
    """What aliases in spelling share; null for a URL without a host."""
    query = F.regexp_extract(_rest(url), r"^[^?#]*(\?[^#]*)", 1)
    host = F.regexp_replace(host_of(url), ":(80|443)$", "")
    node = F.concat(host, F.regexp_replace(path_of(url), "/$", ""), F.coalesce(F.when(query != "?", query), F.lit("")))
    return F.when(host_of(url) != "", node)


def _absolute(href: Column, url: Column) -> Column:
    """A link's target as a full URL, seen from the page's URL."""
    scheme = F.substring_index(url, "://", 1)
    root = F.concat(scheme, F.lit("://"), host_of(url))
    folder = F.regexp_extract(path_of(url), "^(.*/)", 1)
    return (F.when(F.instr(href, "://") > 0, href)
            .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
            .when(href.startswith("/"), F.concat(root, href))
            .otherwise(F.concat(root, F.when(folder == "", F.lit("/")).otherwise(folder), href)))


def alias_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``url, target``: all redirects and canonical links of the pages."""
    def found(tag: str, kind: str, value: str) -> Column:
        tags = F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(tag), F.lit(0))
        return F.transform(F.filter(tags, lambda t: t.rlike(kind)), lambda t: F.regexp_extract(t, value, 1))
    hrefs = F.concat(found(LINK_TAG, CANONICAL, HREF), found(META_TAG, REFRESH, TARGET))
    return (pages.select(F.col(url).alias("url"), F.explode(hrefs).alias("href"))
            .where((F.col("href") != "") & (host_of(F.col("url")) != ""))
            .select("url", _absolute(F.replace("href", F.lit("&amp;"), F.lit("&")), F.col("url")).alias("target")))


def longest_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, path, rule, action`` for the distinct (host, path) that a rule
    fits; of equally long rules the first by text, allow before block."""
    labels = F.split("host", r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    table = rules.select(F.col("host").alias("suffix"), F.col("path").alias("begin"), "action")
    fit = urls.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes)).join(table, "suffix").where(F.col("path").startswith(F.col("begin")))
    rule = F.concat("suffix", "begin")
    best = fit.groupBy("host", "path").agg(F.min(F.struct((-F.length(rule)).alias("n"), rule.alias("rule"), F.col("action").alias("action"))).alias("best"))
    return best.select("host", "path", "best.rule", "best.action")


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """``page_id, host, path, rule, verdict`` for every row of ``pages``.

    ``rules`` are (action, host, path) with action ``allow`` or ``block``.
    Null URLs and those without ``://`` have an empty host and path, no rule and
    no aliases: they are allowed. Null html has no links. Repeated rows each get
    a row; other columns are ignored; an empty table gives no rows; without
    rules all is allowed.
    """
    spark = pages.sparkSession
    table = spark.createDataFrame([(a, h, p) for a, h, p in rules], "action string, host string, path string")
    links = stage_table(alias_links(pages, url, html), "alias-links")
    own = F.col(url)
    rows = pages.select(F.col(key).alias("page_id"), host_of(own).alias("host"), path_of(own).alias("path"), node_of(own).alias("node"))
    there = F.col("target")
    seen = stage_table(rows.select("host", "path", "node").unionByName(
        links.select(host_of(there).alias("host"), path_of(there).alias("path"), node_of(there).alias("node"))).distinct(), "urls")
    best = stage_table(longest_rules(seen, table), "rules")
    same = connected_components(links.select(node_of(F.col("url")).alias("a"), node_of(there).alias("b")), "a", "b")
    member = F.coalesce("component", "node")
    grouped = seen.where("node is not null").join(same, "node", "left").withColumn("member", member)
    evidence = stage_table(grouped.join(best, ["host", "path"], "left").groupBy("member")
                           .agg(F.max(F.when(F.col("action") == "allow", 2).when(F.col("action") == "block", 1)).alias("say")).where("say = 1"), "evidence")
    blocked = stage_table(grouped.select("node", "member").distinct().join(evidence, "member", "left_semi").select("node"), "blocked")
    out = (rows.join(best, ["host", "path"], "left")
           .join(blocked.withColumn("by_alias", F.lit("block")), "node", "left"))
    return out.select("page_id", "host", "path", "rule", F.coalesce("action", "by_alias", F.lit("allow")).alias("verdict"))
