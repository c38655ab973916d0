"""Feed documents by hand."""
from datetime import datetime

from claimflow.sources.feeds import BAD_FEED, feed_entries, parse_feeds

RSS = """<?xml version="1.0"?><rss version="2.0"><channel><title>News</title>
<item><title>A &amp; B</title><link> https://h.org/a </link><pubDate>Tue, 05 Mar 2024 08:30:00 GMT</pubDate><description><![CDATA[<p>one</p>]]></description></item>
<item><title>C</title><link>https://h.org/c</link><pubDate>5 Mar 2024 08:30:00 +0200</pubDate></item>
<item><title>D</title><pubDate>soon</pubDate><description>two</description></item></channel></rss>"""
ATOM = """<feed xmlns="http://www.w3.org/2005/Atom"><title>N</title>
<entry><title>E</title><link rel="self" href="https://h.org/self"/><link rel="alternate" href="https://h.org/e"/><updated>2024-03-05T08:30:00Z</updated><summary>three</summary></entry>
<entry><title>F</title><link href="https://h.org/f"/><published>2024-03-04T00:00:00+01:00</published><updated>2024-03-05T08:30:00Z</updated></entry></feed>"""


def test_rss_and_atom_entries(spark):
    rows = [("rss", RSS), ("atom", ATOM), ("cut", RSS[:200]), ("other", "<html><p>x</p></html>"), ("none", None), ("blank", " "), ("empty", "<rss><channel><title>x</title></channel></rss>")]
    df = spark.createDataFrame(rows, "feed string, xml string")
    errors = {r.feed: r.error for r in parse_feeds(df).collect()}
    assert errors == {"rss": None, "atom": None, "cut": BAD_FEED, "other": BAD_FEED, "none": BAD_FEED, "blank": BAD_FEED, "empty": None}
    got = [tuple(r) for r in feed_entries(df).orderBy("feed", "entry_pos").collect()]
    when = datetime(2024, 3, 5, 8, 30)
    assert got == [
        ("atom", 0, "E", "https://h.org/e", when, "three"), ("atom", 1, "F", "https://h.org/f", datetime(2024, 3, 3, 23), None),
        ("rss", 0, "A & B", "https://h.org/a", when, "<p>one</p>"), ("rss", 1, "C", "https://h.org/c", datetime(2024, 3, 5, 6, 30), None),
        ("rss", 2, "D", None, None, "two")]
    assert feed_entries(df.where("false")).count() == 0
