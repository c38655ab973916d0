"""Web-page operators (P1-P10) over a ``pages(page_id, url, html)`` table.

Nothing is fetched: the collected pages are a table, and each step is a
projection, an explode, an aggregation or a broadcast equi-join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.functions.text import decode_entities, evaluate_once, html_title, html_to_text, url_authority
from claimflow.sources.rules import rule_sets_of, with_rules

MIN_PAGE_TEXT = 50  # a page is kept when its text is longer than this
NO_CONTENT = "No content found"

# Link and URL patterns of the original collector.
HREF_PATTERN = r"""(?is)<a\s(?:[^<>]*?\s)?href\s*=\s*("[^"]*"|'[^']*'|[^\s"'>][^\s>]*)"""
HREF_QUOTES = r"""^["']|["']$"""
# What holds no links: script and style blocks and comments, to the end of the
# page when they are never closed.
NO_LINKS_PATTERN = (r"(?is)<script[^>]*+(?:>.*?(?:</script[^>]*+(?:>|\z)|\z)|\z)|<style[^>]*+(?:>.*?(?:</style[^>]*+(?:>|\z)|\z)|\z)"
                    r"|<!--.*?(?:-->|\z)")
PLAIN_NO_LINKS_PATTERN = NO_LINKS_PATTERN.replace("*+", "*")
SCHEME_PATTERN = r"^[A-Za-z][A-Za-z0-9+.\-]*:"
SKIP_URL_PATTERN = (r"(?i)\.(pdf|jpg|jpeg|png|gif|css|js|xml|rss)$|/tag/|/category/|/author/"
                    r"|/search|/login|/register|/contact|/about|/privacy|/terms")
HOST_PATTERN = r"^(?:[^@/]*@)?([^:]*)"


def extract_pages(pages: DataFrame) -> DataFrame:
    """Text, title and source per page, plus the verdict.

    One frame carries both outcomes (``success`` and ``error``); callers
    take ``where(success)`` for kept pages and the rest as rejects.
    """
    # The derived columns come out of a one-row ``inline``: a later filter on
    # ``text`` (P3) then stays above it instead of being pushed below the
    # projection, which would run the regex chain twice per page.
    derived = F.inline(F.array(F.struct(
        html_title("html").alias("title"),
        html_to_text("html").alias("text"),
        url_authority("url").alias("source"))))
    return pages.select("page_id", "url", derived).withColumn("success", F.length("text") > MIN_PAGE_TEXT) \
     .withColumn("error", F.when(~F.col("success"), F.lit(NO_CONTENT)))


def host_of(authority: Column) -> Column:
    """Lower-cased host of an authority (user and port removed)."""
    return F.lower(F.regexp_extract(authority, HOST_PATTERN, 1))


def remove_dot_segments(path: Column) -> Column:
    """``.`` and ``..`` segments of a path resolved, as ``urljoin`` does."""
    segments = F.split(path, "/")
    keep = F.aggregate(segments, F.array().cast("array<string>"), lambda done, s: (
        F.when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .when(s == ".", done).otherwise(F.concat(done, F.array(s)))))
    last = F.element_at(segments, -1)
    joined = F.array_join(F.concat(keep, F.when(last.isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>"))), "/")
    rooted = F.when(joined.startswith("/"), joined).otherwise(F.concat(F.lit("/"), joined))
    return F.when(path.rlike(r"(^|/)\.\.?(/|$)"), rooted).otherwise(path)


def resolve_href(href: Column, domain: Column) -> Column:
    """``urljoin('https://' + domain, href)``; character references decoded."""
    href = F.trim(href)
    base = F.concat(F.lit("https://"), domain)
    path, rest = F.regexp_extract(href, "^[^?#]*", 0), F.regexp_extract(href, "^[^?#]*(.*)$", 1)
    return (F.when(href.rlike(SCHEME_PATTERN), href)
             .when(href.startswith("//"), F.concat(F.lit("https:"), href))
             .when(href.startswith("?") | href.startswith("#"), F.concat(base, href))
             .when(href == "", base)
             .when(href.startswith("/"), F.concat(base, remove_dot_segments(path), rest))
             .otherwise(F.concat(base, remove_dot_segments(F.concat(F.lit("/"), path)), rest)))


def is_article_url(url: Column, domain: Column) -> Column:
    """Same host or a subdomain of it, and no skip pattern anywhere in
    the URL (so ``/about`` also drops ``/about-face``)."""
    auth = url_authority(url)
    same = (auth == domain) | auth.endswith(F.concat(F.lit("."), domain))
    return same & ~url.rlike(SKIP_URL_PATTERN)


def find_article_urls(pages: DataFrame, max_urls: int = 100) -> DataFrame:
    """P5 + P6: article links per domain, first ``max_urls`` distinct by
    first appearance (page, position), resolved against the domain root.
    Links in comments, scripts and styles don't count; ``max_urls`` is the
    niche's ``max_per_source``.

    The per-domain limit is a ``row_number() <= n`` filter, which Spark
    turns into a partial group limit before the shuffle, so a domain that
    holds a third of all pages sends at most ``n`` rows per map task.
    """
    markup = F.regexp_replace(F.coalesce("html", F.lit("")), NO_LINKS_PATTERN, "")
    links = (pages.select("page_id", url_authority("url").alias("domain"),
                          F.posexplode(F.regexp_extract_all(markup, F.lit(HREF_PATTERN), F.lit(1))).alias("pos", "href"))
             .withColumnRenamed("href", "_raw"))
    # Each derived column is read many times below: evaluate it once a link.
    links = evaluate_once(links, href=decode_entities(F.regexp_replace("_raw", HREF_QUOTES, ""), legacy=False))
    links = (evaluate_once(links, url=resolve_href(F.col("href"), F.col("domain")))
             .where(is_article_url(F.col("url"), F.col("domain"))))
    first = links.groupBy("domain", "url").agg(F.min(F.struct("page_id", "pos")).alias("first"))
    w = Window.partitionBy("domain").orderBy(F.col("first.page_id"), F.col("first.pos"), "url")
    return (first.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= max_urls)
            .select("domain", "url", F.col("first.page_id").alias("page_id"),
                    F.col("first.pos").alias("pos"), "rank"))


def recent_feed_entries(entries: DataFrame, as_of: str, max_articles: int = 100,
                        max_age_days: int = 365, order_col: str = "entry_pos") -> DataFrame:
    """First ``max_articles`` entries per feed (taken *before* the date
    test), then entries older than ``max_age_days`` before ``as_of`` go;
    undated entries stay; summary cut to 200 characters."""
    w = Window.partitionBy("feed").orderBy(order_col)
    cutoff = F.to_timestamp(F.lit(as_of)) - F.make_interval(days=F.lit(max_age_days))
    return (entries.withColumn("_n", F.row_number().over(w))
            .where(F.col("_n") <= max_articles)
            .where(F.col("published").isNull() | (F.col("published") >= cutoff))
            .withColumn("summary", F.substring(F.coalesce("summary", F.lit("")), 1, 200))
            .drop("_n"))


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``: suffixes at label boundaries."""
    parts = F.split(host, r"\.")
    n = F.size(parts)
    return F.transform(F.sequence(F.lit(1), n),
                       lambda i: F.array_join(F.slice(parts, i, n - i + 1), "."))


def rule_domains(rules, spark: SparkSession | None = None) -> DataFrame:
    """(niche, domain, domain_type) from the rules' domain lists.

    Its size is the total length of the domain lists, known on the driver."""
    if not isinstance(rules, DataFrame):
        sets = rule_sets_of(rules)
        rows = sorted({(r.niche, d, t) for r in sets
                       for t, ds in (("positive", r.positive_domains), ("negative", r.negative_domains))
                       for d in ds})
        spark = spark or SparkSession.getActiveSession()
        return spark.createDataFrame(rows, "niche string, domain string, domain_type string")
    pos = rules.select("niche", F.explode("positive_domains").alias("domain"),
                       F.lit("positive").alias("domain_type"))
    neg = rules.select("niche", F.explode("negative_domains").alias("domain"),
                       F.lit("negative").alias("domain_type"))
    return pos.unionByName(neg).distinct()


def tag_domains(pages: DataFrame, rules, source_col: str = "source") -> DataFrame:
    """Tag each page with (niche, domain_type) when its host equals a
    listed domain or is a subdomain of it.

    Host suffixes are exploded (a handful per host) and equi-joined to the
    domain table, so the suffix test needs no nested-loop join.
    A page listed on both sides appears once per side.
    """
    doms = rule_domains(rules, pages.sparkSession)
    x = pages.withColumn("_suffix", F.explode(host_suffixes(host_of(F.col(source_col)))))
    return (x.join(doms, x["_suffix"] == doms["domain"])
             .drop("_suffix").withColumnRenamed("domain", "matched_domain"))


def length_gate(df: DataFrame, rules, text_col: str = "text") -> DataFrame:
    """Keep rows whose text length (code points) lies in the niche's
    inclusive [min, max] range."""
    x = with_rules(df, rules, ["min_text_length", "max_text_length"])
    n = F.length(F.coalesce(F.col(text_col), F.lit("")))
    return x.where(n.between(F.col("min_text_length"), F.col("max_text_length"))) \
            .drop("min_text_length", "max_text_length")


def collection_summary(tagged: DataFrame, order_col: str = "page_id", n_sources: int = 5) -> DataFrame:
    """P10: rows per domain_type and its first ``n_sources`` distinct sources
    in order of first appearance."""
    counts = tagged.groupBy("domain_type").agg(F.count(F.lit(1)).alias("rows"))
    firsts = tagged.groupBy("domain_type", "source").agg(F.min(order_col).alias("_first"))
    w = Window.partitionBy("domain_type").orderBy("_first", "source")
    top = (firsts.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= n_sources)
           .groupBy("domain_type")
           .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_r", "source"))),
                                         lambda s: s["source"]), ", ").alias("sample_sources")))
    return counts.join(top, "domain_type", "left")


def label_pages_input(pages_text: DataFrame, rules) -> DataFrame:
    """Pages as labeling input: ``domain_type`` from the rules' domain lists
    by the same substring test as L1 (positive first, else negative)."""
    x = with_rules(pages_text, rules, ["positive_domains", "negative_domains"])
    sl = F.lower(F.coalesce(F.col("source"), F.lit("")))
    pos = F.exists(F.col("positive_domains"), lambda d: sl.contains(d))
    neg = F.exists(F.col("negative_domains"), lambda d: sl.contains(d))
    return (x.withColumn("domain_type", F.when(pos, "positive").when(neg, "negative").otherwise("unknown"))
             .select(*pages_text.columns, "domain_type"))
