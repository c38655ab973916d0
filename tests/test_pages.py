"""P3, P5-P10."""
from pyspark.sql import functions as F

from claimflow.operators import pages as P
from claimflow.sources.rules import RuleSet

RULES = RuleSet.from_mapping({"niche": "n", "positive_label": "p", "negative_label": "q",
                              "positive_domains": ["example.net"], "negative_domains": ["example.org"],
                              "min_text_length": 5, "max_text_length": 10})


def test_extract_pages_keeps_long_text_only(spark):
    long_html = "<html><title>T</title><body><p>" + "word " * 20 + "</p></body></html>"
    df = spark.createDataFrame([(1, "https://a.example.net/x", long_html),
                                (2, "https://b.example.net/y", "<p>Short</p>")], "page_id long, url string, html string")
    rows = {r.page_id: r for r in P.extract_pages(df).collect()}
    assert rows[1].success and rows[1].title == "T" and rows[1].error is None
    assert not rows[2].success and rows[2].error == "No content found"


def test_extract_pages_evaluates_text_once(spark):
    from conftest import SF01
    pages = spark.read.parquet(f"{SF01}/pages.parquet")
    plan = P.extract_pages(pages).where(F.col("success"))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("<!--.*?(?:-->") == 1


def test_find_article_urls_resolves_against_domain_root(spark):
    html = ('<a href="/river-levels">a</a><a class="x" href="/old-bridge">b</a><a href="/river-levels">again</a>'
            '<a href="/about-face">no</a><a href="https://other.com/x">no</a><a href="/tag/y">no</a>'
            '<a href="/img.png">no</a><a href="//m.example.com/z">sub</a><a href="rel/p">rel</a>')
    df = spark.createDataFrame([(1, "https://example.com/home", html)], "page_id long, url string, html string")
    rows = P.find_article_urls(df, max_urls=100).orderBy("rank").collect()
    assert [r.url for r in rows] == ["https://example.com/river-levels", "https://example.com/old-bridge",
                                     "https://m.example.com/z", "https://example.com/rel/p"]
    assert [r.url for r in P.find_article_urls(df, max_urls=2).orderBy("rank").collect()] == [
        "https://example.com/river-levels", "https://example.com/old-bridge"]


def test_feed_entries_cap_before_date(spark):
    rows = [("f", i, f"l{i}", None, "s" * 300) for i in range(5)]
    rows += [("g", 0, "old", "2022-01-01 00:00:00", "x"), ("g", 1, "new1", "2024-01-01 00:00:00", "y"),
             ("g", 2, "new2", "2024-01-02 00:00:00", "z")]
    df = spark.createDataFrame(rows, "feed string, entry_pos int, link string, published string, summary string") \
        .withColumn("published", F.to_timestamp("published"))
    out = P.recent_feed_entries(df, as_of="2024-06-01 00:00:00", max_articles=3).collect()
    links = sorted(r.link for r in out)
    assert links == ["l0", "l1", "l2", "new1", "new2"]
    assert all(len(r.summary) <= 200 for r in out)


def test_tag_domains_by_host_suffix(spark):
    df = spark.createDataFrame([(1, "a.example.net"), (2, "example.org:8080"), (3, "notexample.net"),
                                (4, "x.example.net.evil.com")], "page_id long, source string")
    got = sorted((r.page_id, r.domain_type) for r in P.tag_domains(df, [RULES]).collect())
    assert got == [(1, "positive"), (2, "negative")]


def test_length_gate_inclusive(spark):
    df = spark.createDataFrame([("n", "abcd"), ("n", "abcde"), ("n", "abcdefghij"), ("n", "abcdefghijk")],
                               "niche string, text string")
    assert sorted(r.text for r in P.length_gate(df, [RULES]).collect()) == ["abcde", "abcdefghij"]


def test_collection_summary_first_sources(spark):
    rows = [(i, f"s{i % 7}", "positive" if i % 2 == 0 else "negative") for i in range(30)]
    df = spark.createDataFrame(rows, "page_id long, source string, domain_type string")
    got = {r.domain_type: r for r in P.collection_summary(df).collect()}
    assert got["positive"].rows == 15 and got["positive"].sample_sources == "s0, s2, s4, s6, s1"


def test_article_links_on_untidy_markup(spark):
    html = ('<!-- <a href="/hidden">x</a> --><script>var a = \'<a href="/inscript">x</a>\';</script>'
            "<a href=/bare>b</a><a class=c href='/single'>s</a><a href=\"p?a=1&amp;b=2\">e</a>"
            '<a href="../n">up</a><a href="/x/./y/../z?q=../k">dots</a><a data-href="/no" href="/yes">d</a>')
    df = spark.createDataFrame([(1, "https://d.com/deep/page", html)], "page_id long, url string, html string")
    got = [r.url for r in P.find_article_urls(df).orderBy("rank").collect()]
    assert got == ["https://d.com/bare", "https://d.com/single", "https://d.com/p?a=1&b=2", "https://d.com/n",
                   "https://d.com/x/z?q=../k", "https://d.com/yes"]


def test_resolve_href_equals_urljoin(spark):
    from urllib.parse import urljoin
    hrefs = ["/a/b", "a/b", "../x", "../../x/./y", "/a/../../b", "./", "/a/..", "?q=1", "#f", "", "//h.org/z/../y",
             "https://o.net/../k", "x/../y?z=/../w", "/a/b/./../c/"]
    df = spark.createDataFrame([(i, h) for i, h in enumerate(hrefs)], "i int, h string")
    got = [r[0] for r in df.orderBy("i").select(P.resolve_href(F.col("h"), F.lit("d.com"))).collect()]
    assert got == [urljoin("https://d.com", h) for h in hrefs]
