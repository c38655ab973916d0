"""P7's input: feed documents (RSS 2.0 and Atom) as entry rows.

A document is parsed by Spark's XML reader with an explicit schema; the columns
are those that ``operators.pages.recent_feed_entries`` takes. Documents that
aren't well-formed, or hold neither a channel nor an entry, are kept apart.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_TEXT = T.StringType()
_ITEM = T.StructType([T.StructField(c, _TEXT) for c in ("title", "link", "pubDate", "description")])
_LINK = T.StructType([T.StructField("_href", _TEXT), T.StructField("_rel", _TEXT)])
_ENTRY = T.StructType([T.StructField("title", _TEXT), T.StructField("link", T.ArrayType(_LINK)), T.StructField("published", _TEXT),
                       T.StructField("updated", _TEXT), T.StructField("summary", _TEXT)])
FEED_SCHEMA = T.StructType([T.StructField("channel", T.StructType([T.StructField("title", _TEXT), T.StructField("item", T.ArrayType(_ITEM))])),
                            T.StructField("entry", T.ArrayType(_ENTRY)), T.StructField("_bad", _TEXT)])
RSS_DATE = "d MMM yyyy HH:mm:ss Z"
BAD_FEED = "not a well-formed RSS or Atom document"


def feed_time(text: Column) -> Column:
    """A feed's date, RSS (``Mon, 01 Jan 2024 00:00:00 GMT``) or ISO 8601; null
    when it is neither."""
    plain = F.regexp_replace(F.regexp_replace(F.trim(text), r"^[A-Za-z]{3},\s*", ""), r"\b(?:GMT|UTC?|Z)$", "+0000")
    return F.coalesce(F.try_to_timestamp(plain, F.lit(RSS_DATE)), F.try_to_timestamp(F.trim(text)))


def parse_feeds(feeds: DataFrame, feed_col: str = "feed", xml_col: str = "xml") -> DataFrame:
    """``feed, entries, error`` per document: its entries in document order, or
    null and an error. A null or blank document is an error, too."""
    parsed = F.from_xml(F.col(xml_col), FEED_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad", "attributePrefix": "_"})
    x = feeds.select(F.col(feed_col).alias("feed"), F.inline(F.array(F.struct(parsed.alias("p")))))
    items = F.transform("p.channel.item", lambda i: F.struct(
        i["title"].alias("title"), F.trim(i["link"]).alias("link"), feed_time(i["pubDate"]).alias("published"), i["description"].alias("summary")))
    def href(links: Column) -> Column:      # the alternate link, else the first
        right = F.filter(links, lambda a: a["_rel"].isNull() | (a["_rel"] == "alternate"))
        return F.get(F.concat(right, links), F.lit(0))["_href"]
    entries = F.transform("p.entry", lambda e: F.struct(
        e["title"].alias("title"), F.trim(href(e["link"])).alias("link"), feed_time(F.coalesce(e["published"], e["updated"])).alias("published"),
        e["summary"].alias("summary")))
    good = F.col("p._bad").isNull() & (F.col("p.channel").isNotNull() | F.col("p.entry").isNotNull())
    none = F.array().cast(T.ArrayType(T.StructType([T.StructField("title", _TEXT), T.StructField("link", _TEXT),
                                                    T.StructField("published", T.TimestampType()), T.StructField("summary", _TEXT)])))
    return x.select("feed", F.when(good, F.coalesce(items, entries, none)).alias("entries"), F.when(~F.coalesce(good, F.lit(False)), F.lit(BAD_FEED)).alias("error"))


def feed_entries(feeds: DataFrame, feed_col: str = "feed", xml_col: str = "xml") -> DataFrame:
    """``feed, entry_pos, title, link, published, summary``: the entries of the
    good documents."""
    return (parse_feeds(feeds, feed_col, xml_col).where("error is null")
            .select("feed", F.posexplode("entries").alias("entry_pos", "e")).select("feed", "entry_pos", "e.*"))
