"""Text column functions (T1, T2, T3, P1, P2, P4) as native expressions.

Each function returns a ``Column`` built from ``lower``, ``regexp_replace``,
``regexp_extract_all`` and higher-order array functions, so it stays inside
whole-stage codegen. The same patterns also render as DuckDB SQL (the
``*_sql`` twins) for the oracle queries.

Java's engine recurses once per repetition of a group and retries a run at
each of its positions, so the patterns used in Spark repeat no group without
a possessive bound and start a run only at its first character: long URLs,
number lists and runs of white space stay linear. The SQL twins keep the
plain forms (``PLAIN_*``), which RE2 reads in linear time anyway.
"""

from __future__ import annotations

import html.entities
import json
import zlib

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.stopwords import ENGLISH_STOP_WORDS

# ---------------------------------------------------------------------------
# Patterns that reproduce the original cleaning rules.
# WS is Python's Unicode ``\s``; LB is the set of ``str.splitlines`` breaks.
WS = r"\t-\r\x1c-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
LB = r"\n-\r\x1c-\x1e\x{85}\x{2028}\x{2029}"
URL_PATTERN = r"https?://[$-_a-z!]+"  # ``%`` lies between ``$`` and ``_``
PLAIN_URL_PATTERN = r"https?://(?:[$-_a-z!]|%[0-9a-f][0-9a-f])+"
# An address can only start at a word start, so the match is anchored on the
# preceding whitespace (kept via $1): same result as an unanchored
# ``non-space+@non-space+``, but linear instead of quadratic in word length.
EMAIL_PATTERN = r"(^|[" + WS + r"])[^" + WS + r"]+@[^" + WS + r"]+"
PHONE_PATTERN = r"\(?[0-9]{3}\)?[-. ]?[0-9]{3}[-. ]?[0-9]{4}"
WS_RUN_PATTERN = r"[" + WS + r"]+"
# The runs that squeezing changes: all but a single blank, which most runs are.
WS_SQUEEZE_PATTERN = r"[" + WS.replace(r"\x1c-\x20", r"\x1c-\x1f") + r"][" + WS + r"]*+| [" + WS + r"]++"
NOT_KEPT_PATTERN = r"[^a-zA-Z0-9 .,!?;:]"
KEPT_RUN_PATTERN = r"[a-zA-Z0-9 .,!?;:]+"
TOKEN_PATTERN = r"[a-z0-9]++(?:[.,:][a-z0-9]++)*+"
PLAIN_TOKEN_PATTERN = r"[a-z0-9]+(?:[.,:][a-z0-9]+)*"
MIN_TOKEN_LENGTH = 3
# HTML: script and style blocks with their content, comments, declarations,
# then any tag; one left-to-right scan, earlier alternatives win at a position.
# What is opened and never closed reaches to the end of the page, as it does for
# a parser; so every opener is read once and the scan is linear.
HTML_DROP_PATTERN = (
    r"(?is)<script[^>]*+(?:>.*?(?:</script[^>]*+(?:>|\z)|\z)|\z)|<style[^>]*+(?:>.*?(?:</style[^>]*+(?:>|\z)|\z)|\z)"
    r"|<!--.*?(?:-->|\z)|<![^>]*+(?:>|\z)|</?[a-zA-Z][^>]*+(?:>|\z)"
)
PLAIN_HTML_DROP_PATTERN = HTML_DROP_PATTERN.replace("*+", "*")
HTML_BREAK_PATTERN = r"(?<![" + WS + r"])[" + WS + r"]*?(?:  |[" + LB + r"])[" + WS + r"]*"
PLAIN_HTML_BREAK_PATTERN = r"[" + WS + r"]*(?:  |[" + LB + r"])[" + WS + r"]*"
EDGE_WS_PATTERN = r"^[" + WS + r"]+|(?<![" + WS + r"])[" + WS + r"]+$"
PLAIN_EDGE_WS_PATTERN = r"^[" + WS + r"]+|[" + WS + r"]+$"
TITLE_PATTERN = r"(?is)<title[^>]*+(?:>(.*?)(?:</title>|\z)|\z)"
PLAIN_TITLE_PATTERN = TITLE_PATTERN.replace("*+", "*")
AUTHORITY_PATTERN = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)"
# A character reference: decimal, hexadecimal or named, with ``;`` or without.
ENTITY_PATTERN = r"&(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[a-zA-Z][a-zA-Z0-9]*;?)"
ENTITY_START = r"&(?:#[0-9]|#[xX][0-9a-fA-F]|[a-zA-Z])"
# The HTML5 replacements for references to 0x80-0x9F
# (Windows-1252 code points), as code point -> code point.
WINDOWS_1252_REMAP = {
    0x80: 0x20AC, 0x82: 0x201A, 0x83: 0x0192, 0x84: 0x201E, 0x85: 0x2026, 0x86: 0x2020,
    0x87: 0x2021, 0x88: 0x02C6, 0x89: 0x2030, 0x8A: 0x0160, 0x8B: 0x2039, 0x8C: 0x0152,
    0x8E: 0x017D, 0x91: 0x2018, 0x92: 0x2019, 0x93: 0x201C, 0x94: 0x201D, 0x95: 0x2022,
    0x96: 0x2013, 0x97: 0x2014, 0x98: 0x02DC, 0x99: 0x2122, 0x9A: 0x0161, 0x9B: 0x203A,
    0x9C: 0x0153, 0x9E: 0x017E, 0x9F: 0x0178,
}
# ---------------------------------------------------------------------------


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def evaluate_once(df: DataFrame, **cols: Column) -> DataFrame:
    """Add derived columns through a one-row ``inline``.

    Catalyst pushes a filter on a derived column below the projection that
    computes it, substituting the expression, so a regex chain would run
    once in the filter and again in the projection (and again for every
    later reference). Columns that come out of a generator are attributes
    the filter cannot be pushed past, so each expression runs once per row.
    """
    derived = F.inline(F.array(F.struct(*[e.alias(n) for n, e in cols.items()])))
    return df.select("*", derived)


def drop_nulls(df: DataFrame, *cols: str) -> DataFrame:
    """Drop rows with a null in any of ``cols``."""
    return df.na.drop(subset=list(cols))


def clean_text(text) -> Column:
    """Lower, drop URLs, e-mails, phone numbers, squeeze whitespace,
    keep ``[a-zA-Z0-9 .,!?;:]``, trim. Null gives ``""``.

    Two steps are written for speed with unchanged results: the e-mail
    pattern only runs on texts that contain ``@``, and the final filter
    keeps runs of allowed characters (a positive class) instead of deleting
    everything else; Java's regex engine is several times slower on the
    large negated classes and does not scale across task threads.
    """
    s = F.lower(F.coalesce(_col(text), F.lit("")))
    s = F.regexp_replace(s, URL_PATTERN, "")
    s = F.when(F.instr(s, "@") > 0, F.regexp_replace(s, EMAIL_PATTERN, "$1")).otherwise(s)
    s = F.regexp_replace(s, PHONE_PATTERN, "")
    s = F.regexp_replace(s, WS_SQUEEZE_PATTERN, " ")
    s = F.array_join(F.regexp_extract_all(s, F.lit(KEPT_RUN_PATTERN), F.lit(0)), "")
    return F.trim(s)


def tokenize(clean, stop_words=ENGLISH_STOP_WORDS, remove_stopwords: bool = True,
             min_length: int = MIN_TOKEN_LENGTH) -> Column:
    """Word tokens of cleaned text minus stop words and short tokens."""
    toks = F.regexp_extract_all(F.coalesce(_col(clean), F.lit("")), F.lit(TOKEN_PATTERN), F.lit(0))
    if remove_stopwords:
        # ``isin`` over many literals becomes a hash-set lookup (InSet).
        stops = list(stop_words)
        return F.filter(toks, lambda t: (F.length(t) >= min_length) & ~t.isin(stops))
    return F.filter(toks, lambda t: F.length(t) >= min_length)


def join_tokens(tokens) -> Column:
    """The space-joined token string fed to the vectorizer."""
    return F.array_join(_col(tokens), " ")


def entity_names() -> dict[str, str]:
    """The HTML5 named references that end in ``;``, from the standard
    library's table: name without ``;`` -> character(s)."""
    return {k[:-1]: v for k, v in html.entities.html5.items() if k.endswith(";")}


def legacy_names() -> dict[str, str]:
    """The names that are references without ``;``, too: name -> character."""
    return {k: v for k, v in html.entities.html5.items() if not k.endswith(";")}


# Ranges of code points whose numeric references give nothing: controls and
# non-characters (those with a Windows-1252 meaning, tested first, aside); the
# last two of each plane are non-characters, too.
DROPPED_CODE_POINTS = ((0x1, 0x8), (0xB, 0xB), (0xE, 0x1F), (0x7F, 0x7F), (0xFDD0, 0xFDEF))


def _longest_first(names) -> str:
    return "|".join(sorted(names, key=lambda n: (-len(n), n)))


def constant_lookup(key: Column, table: dict[str, str]) -> Column:
    """The table's value for ``key``, null without one: a constant array of hash
    buckets, so that a key is found by position and not by search."""
    n = 1
    while n < 2 * len(table):
        n *= 2
    rows: list = [[] for _ in range(n)]
    for k, v in table.items():
        rows[zlib.crc32(k.encode()) % n].append({"k": k, "v": v})
    buckets = F.from_json(F.lit(json.dumps(rows)), "array<array<struct<k:string,v:string>>>")
    return F.get(F.filter(F.get(buckets, (F.crc32(key.cast("binary")) % n).cast("int")), lambda e: e["k"] == key), F.lit(0))["v"]


def _code_point(ref: Column) -> Column:
    """Code point of a numeric reference body (``#39`` or ``#x2019``) of any
    length; 0, surrogates and what lies beyond U+10FFFF become U+FFFD,
    0x80-0x9F follow the HTML5 table."""
    is_hex = F.lower(ref).startswith("#x")
    digits = F.regexp_replace(ref, "^#[xX]?0*", "")
    short = F.when(F.length(digits) <= 7, digits)  # more digits lie beyond U+10FFFF
    raw = F.when(digits == "", F.lit(0)).otherwise(
        F.when(is_hex, F.conv(short, 16, 10)).otherwise(short).cast("long"))
    remap = F.create_map(*[F.lit(x) for kv in WINDOWS_1252_REMAP.items() for x in kv])
    bad = raw.isNull() | (raw == 0) | raw.between(0xD800, 0xDFFF) | (raw > 0x10FFFF)
    return F.when(bad, F.lit(0xFFFD)).otherwise(F.coalesce(F.element_at(remap, raw.cast("int")), raw))


def decode_entities(s, legacy: bool = True) -> Column:
    """Character references to characters, in one pass (so ``&amp;#39;``
    becomes ``&#39;``); unknown names stay. With ``legacy``, as in text, numbers
    need no ``;`` and of a name that is none the longest beginning among the
    names that need no ``;`` counts (``&copy 2024``, ``&notit;``); without, as in
    URLs, only references that end in ``;`` do.

    One split cuts the text before every reference; only pieces that begin with
    one are decoded, and joined again. The input is referenced once, so nothing
    upstream is evaluated twice."""
    end = "(;?)" if legacy else "(;)"

    def char(point):
        gone = point % 65536 >= 65534
        for lo, hi in DROPPED_CODE_POINTS:
            gone = gone | point.between(lo, hi)
        return F.when(gone, F.lit("")).otherwise(F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32"))

    def number(p):
        ref = F.regexp_extract(p, f"^&(#[0-9]+|#[xX][0-9a-fA-F]+){end}", 1)
        made = F.get(F.transform(F.array(_code_point(ref)), char), F.lit(0))       # the code point is worked out once
        after = F.regexp_replace(p, f"^&(?:#[0-9]++|#[xX][0-9a-fA-F]++){end[1:-1]}", "")
        return F.when(ref == "", p).otherwise(F.concat(made, after))

    def named(p):
        name = F.regexp_extract(p, "^&([a-zA-Z][a-zA-Z0-9]*);", 1)
        known = F.when(name != "", constant_lookup(name, entity_names()))
        whole = F.concat(known, F.substr(p, F.length(name) + F.lit(3)))
        if not legacy:
            return F.coalesce(whole, p)
        start = F.regexp_extract(p, f"^&({_longest_first(legacy_names())})", 1)
        part = F.when(start != "", F.concat(constant_lookup(start, legacy_names()), F.substr(p, F.length(start) + F.lit(2))))
        return F.coalesce(whole, part, p)

    def piece(p):
        return F.when(~p.startswith("&"), p).when(p.startswith("&#"), number(p)).otherwise(named(p))

    return F.array_join(F.transform(F.split(_col(s), f"(?={ENTITY_START})", -1), piece), "")


def html_to_text(html) -> Column:
    """Visible page text with the original line/double-space squeeze. Markup
    that is never closed reaches to the end."""
    s = F.regexp_replace(F.coalesce(_col(html), F.lit("")), HTML_DROP_PATTERN, "")
    s = decode_entities(s)
    s = F.regexp_replace(s, HTML_BREAK_PATTERN, " ")
    return F.regexp_replace(s, EDGE_WS_PATTERN, "")


def html_title(html) -> Column:
    """``<title>`` text, ``""`` when there is none; to the end of the page
    when it is never closed."""
    return decode_entities(F.regexp_extract(F.coalesce(_col(html), F.lit("")), TITLE_PATTERN, 1))


def url_authority(url) -> Column:
    """Network location of a URL (user and port kept, like ``netloc``)."""
    return F.regexp_extract(F.coalesce(_col(url), F.lit("")), AUTHORITY_PATTERN, 1)


# --------------------------- DuckDB renderings ------------------------------

def q(s: str) -> str:
    """A DuckDB string literal (backslashes are not escapes there)."""
    return "'" + s.replace("'", "''") + "'"


def clean_text_sql(expr: str) -> str:
    s = f"lower(coalesce({expr}, ''))"
    for pat, rep in ((PLAIN_URL_PATTERN, ""), (EMAIL_PATTERN, "\\1"), (PHONE_PATTERN, ""),
                     (WS_RUN_PATTERN, " "), (NOT_KEPT_PATTERN, "")):
        s = f"regexp_replace({s}, {q(pat)}, {q(rep)}, 'g')"
    return f"trim({s})"


def tokenize_sql(clean_expr: str, stop_words=ENGLISH_STOP_WORDS,
                 min_length: int = MIN_TOKEN_LENGTH) -> str:
    stops = "[" + ", ".join(q(w) for w in stop_words) + "]"
    return (f"list_filter(regexp_extract_all(coalesce({clean_expr}, ''), {q(PLAIN_TOKEN_PATTERN)}, 0), "
            f"lambda t: length(t) >= {min_length} AND NOT list_contains({stops}, t))")


def _code_point_sql(ref: str) -> str:
    digits = f"regexp_replace({ref}, '^#[xX]?0*|;', '', 'g')"
    raw = (f"CASE WHEN {digits} = '' THEN 0 WHEN length({digits}) > 7 THEN 1114112 "
           f"WHEN starts_with(lower({ref}), '#x') THEN CAST('0x' || {digits} AS BIGINT) "
           f"ELSE CAST({digits} AS BIGINT) END")
    remap = "MAP {" + ", ".join(f"{k}: {v}" for k, v in WINDOWS_1252_REMAP.items()) + "}"
    return (f"CASE WHEN ({raw}) = 0 OR ({raw}) BETWEEN 55296 AND 57343 OR ({raw}) > 1114111 THEN 65533 "
            f"ELSE coalesce({remap}[({raw})], ({raw})) END")


def decode_entities_sql(expr: str, legacy: bool = True) -> str:
    def table(names):
        return f"MAP([{', '.join(q(k) for k in names)}], [{', '.join(q(v) for v in names.values())}])"
    pattern = ENTITY_PATTERN if legacy else r"&(#[0-9]+;|#[xX][0-9a-fA-F]+;|[a-zA-Z][a-zA-Z0-9]*;)"
    pieces = f"string_split_regex({expr}, {q(pattern.replace('&(', '&(?:'))})"
    refs = f"regexp_extract_all({expr}, {q(pattern)}, 1)"
    point = _code_point_sql("r")
    gone = f"({point}) % 65536 >= 65534 OR " + " OR ".join(f"({point}) BETWEEN {lo} AND {hi}" for lo, hi in DROPPED_CODE_POINTS)
    start = f"regexp_extract(r, {q('^(' + _longest_first(legacy_names()) + ')')}, 1)"
    part = f"WHEN {start} <> '' THEN {table(legacy_names())}[{start}] || substring(r, length({start}) + 1)" if legacy else ""
    one = (f"CASE WHEN starts_with(r, '#') THEN CASE WHEN {gone} THEN '' ELSE chr(CAST({point} AS INTEGER)) END "
           f"WHEN ends_with(r, ';') AND {table(entity_names())}[r[:-2]] IS NOT NULL THEN {table(entity_names())}[r[:-2]] {part} ELSE '&' || r END")
    chars = f"list_transform({refs}, lambda r: {one})"
    body = f"array_to_string(list_transform(list_zip({pieces}, {chars}), lambda x: x[1] || coalesce(x[2], '')), '')"
    return f"(CASE WHEN strpos({expr}, '&') > 0 THEN {body} ELSE {expr} END)"


def html_to_text_sql(expr: str) -> str:
    s = f"regexp_replace(coalesce({expr}, ''), {q(PLAIN_HTML_DROP_PATTERN)}, '', 'g')"
    s = decode_entities_sql(s)
    s = f"regexp_replace({s}, {q(PLAIN_HTML_BREAK_PATTERN)}, ' ', 'g')"
    return f"regexp_replace({s}, {q(PLAIN_EDGE_WS_PATTERN)}, '', 'g')"


def html_title_sql(expr: str) -> str:
    return decode_entities_sql(f"regexp_extract(coalesce({expr}, ''), {q(PLAIN_TITLE_PATTERN)}, 1)")


def url_authority_sql(expr: str) -> str:
    return f"regexp_extract(coalesce({expr}, ''), {q(AUTHORITY_PATTERN)}, 1)"
