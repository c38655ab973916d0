"""Phrase index: which of many phrases does a text hold (L2, hazard H7)?

Searching a text for each phrase costs list size times text. Here the list is one
regular expression, a tree of the phrases by their leading letters, which gives the
longest phrase that starts at each place of a text in one pass; the phrases that
begin that one start there, too. So a text costs its length, whatever it holds.

Lists of more than ``TREE_BYTES``, or with a phrase longer than ``TREE_DEPTH``, go
through keys: every phrase is filed under one key that a text holding it must show,
and only the phrases filed under a text's keys are searched for. A phrase's first
and last word may be cut out of longer words, so the key is an inner word, else the
three letters on both sides of a space, else four letters in a row; of a phrase's
possible keys the one that fewest phrases have. Shorter phrases are searched for in
every text.

Either index is a constant of the plan: an array of hash buckets, so that a phrase
or key is looked up by position, map-only, without a join or a shuffle. Lists of
more than ``INDEX_BYTES`` and lists of up to ``PLAIN_LIST`` phrases are searched
phrase by phrase; the result is the same.
"""

from __future__ import annotations

import json
import zlib
from collections import Counter

from pyspark.sql import Column
from pyspark.sql import functions as F

PLAIN_LIST = 64
INDEX_BYTES = 8 << 20
TREE_BYTES = 2 << 20
TREE_DEPTH = 200   # letters; the pattern nests once a letter
GRAM = 4   # letters in a row
SIDE = 3   # letters on either side of a space

# What a text shows: its words, its word joints, its runs of letters.
JOINT_PATTERN = rf"(?=([^ ]{{{SIDE}}} [^ ]{{{SIDE}}}))"
GRAM_PATTERN = rf"(?=([^ ]{{{GRAM}}}))"


def filing_keys(phrase: str) -> dict[str, list[str]]:
    """Possible keys of a phrase by kind: any text that holds it shows each."""
    words = phrase.split(" ")
    inner = [w for w in words[1:-1] if w]
    joints = [f"{a[-SIDE:]} {b[:SIDE]}" for a, b in zip(words, words[1:]) if len(a) >= SIDE and len(b) >= SIDE]
    grams = [w[i:i + GRAM] for w in words for i in range(len(w) - GRAM + 1)]
    return {"word": inner, "joint": joints, "gram": grams}


def file_phrases(phrases: list[str]) -> tuple[dict[str, dict[str, list[int]]], list[int]]:
    """Places in the list by kind and key, and the places of phrases without a
    key. Words and joints, of which a text has few, go before runs of letters."""
    keys = [filing_keys(p) for p in phrases]
    held = Counter((kind, k) for by_kind in keys for kind, ks in by_kind.items() for k in set(ks))
    filed: dict[str, dict[str, list[int]]] = {"word": {}, "joint": {}, "gram": {}}
    short = []
    for at, by_kind in enumerate(keys):
        few = [("word", k) for k in by_kind["word"]] + [("joint", k) for k in by_kind["joint"]]
        best = min(few or [("gram", k) for k in by_kind["gram"]], key=lambda x: (held[x], -len(x[1]), x), default=None)
        if best is None:
            short.append(at)
        else:
            filed[best[0]].setdefault(best[1], []).append(at)
    return filed, short


def tree_pattern(phrases: list[str]) -> str:
    """A pattern for the longest of the phrases (none empty) at a place."""
    tree: dict = {}
    for p in phrases:
        node = tree
        for letter in p:
            node = node.setdefault(letter, {})
        node[""] = {}

    def size(node: dict) -> int:
        return sum(1 if k == "" else size(v) for k, v in node.items())

    def pattern(node: dict) -> str:
        # Letters that lead to many phrases are tried first.
        ways = sorted(((k, v) for k, v in node.items() if k), key=lambda x: (-size(x[1]), x[0]))
        parts = [(k if k.isascii() and (k.isalnum() or k == " ") else f"\\x{{{ord(k):x}}}") + pattern(v) for k, v in ways]
        if not parts:
            return ""
        if len(parts) == 1 and "" not in node:
            return parts[0]
        return f"(?:{'|'.join(parts)}){'?' if '' in node else ''}"
    return pattern(tree)


def leading_places(phrases: list[str]) -> dict[str, list[int]]:
    """For every phrase the places in the list of all phrases that it starts with,
    itself included."""
    places: dict[str, list[int]] = {}
    for at, p in enumerate(phrases):
        places.setdefault(p, []).append(at)
    return {p: [at for n in range(1, len(p) + 1) for at in places.get(p[:n], ())] for p in places if p}


def _buckets(entries: list[dict], kind: str) -> tuple[Column, int]:
    """The index as a constant array of buckets of ``entries``, structs of a
    ``key`` and more; a key lies in the bucket of its crc32."""
    n = 1
    while n < 2 * len({e["key"] for e in entries}):
        n *= 2
    rows: list = [[] for _ in range(n)]
    for e in entries:
        rows[zlib.crc32(e["key"].encode()) % n].append(e)
    return F.from_json(F.lit(json.dumps(rows)), f"array<array<struct<key:string,{kind}>>>"), n


def _looked_up(shown: Column, entries: list[dict], kind: str) -> Column:
    index, n = _buckets(entries, kind)
    return F.flatten(F.transform(F.array_distinct(shown), lambda k: F.filter(
        F.get(index, (F.crc32(k.cast("binary")) % n).cast("int")), lambda e: e["key"] == k)))


def _candidates(shown: Column, filed: dict[str, list[int]], phrases: list[str]) -> Column:
    return _looked_up(shown, [{"key": k, "at": at, "phrase": phrases[at]} for k, places in filed.items() for at in places], "at:int,phrase:string")


def _tree_hits(text: Column, phrases: list[str]) -> Column:
    leading = leading_places(phrases)
    longest = F.regexp_extract_all(text, F.lit(f"(?=({tree_pattern(list(leading))}))"), F.lit(1))
    found = _looked_up(longest, [{"key": k, "at": at} for k, at in leading.items()], "at:array<int>")
    always = F.array(*[F.lit(at) for at, p in enumerate(phrases) if not p]).cast("array<int>")
    places = F.array_distinct(F.concat(always, F.flatten(F.transform(found, lambda e: e["at"]))))
    return F.transform(F.sort_array(places), lambda at: F.get(_constant(phrases), at))


def phrase_hits(text: Column, phrases: list[str]) -> Column:
    """The list entries that are substrings of ``text``, in list order.
    ``text`` should be a plain column (it is read once per candidate); a null
    text gives null. An empty phrase is held by every text."""
    if len(phrases) <= PLAIN_LIST or sum(len(p.encode()) for p in phrases) > INDEX_BYTES:
        return F.filter(_constant(phrases), lambda p: text.contains(p))
    if any(phrases) and sum(len(p.encode()) for p in phrases) <= TREE_BYTES and max(map(len, phrases)) <= TREE_DEPTH:
        return _tree_hits(text, phrases)
    filed, short = file_phrases(phrases)
    found = []
    for kind, shown in (("word", F.split(text, " ")), ("joint", F.regexp_extract_all(text, F.lit(JOINT_PATTERN), F.lit(1))),
                        ("gram", F.regexp_extract_all(text, F.lit(GRAM_PATTERN), F.lit(1)))):
        if filed[kind]:
            entries = F.filter(_candidates(shown, filed[kind], phrases), lambda e: text.contains(e["phrase"]))
            found.append(F.transform(entries, lambda e: F.struct(e["at"].alias("at"), e["phrase"].alias("phrase"))))
    if short:
        always = F.from_json(F.lit(json.dumps([{"at": at, "phrase": phrases[at]} for at in short])), "array<struct<at:int,phrase:string>>")
        found.append(F.filter(always, lambda e: text.contains(e["phrase"])))
    return F.transform(F.array_sort(F.concat(*found)), lambda e: e["phrase"])


def _constant(phrases: list[str]) -> Column:
    return F.from_json(F.lit(json.dumps(phrases)), "array<string>")
