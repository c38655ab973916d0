"""Toxicity by a weighted lexicon matched with Aho-Corasick.

Texts are folded first: lower case, compatibility forms (full-width,
mathematical letters, ligatures), look-alike letters of other scripts and digit
or sign substitutions become plain letters, combining marks and invisible
characters vanish (precomposed accents stay), and everything else between words
becomes one space. The lexicon holds whole words and word beginnings with
weights; a hit inside an exception phrase doesn't count. The weighted hits,
divided by the text's length in words, go through a
logistic curve. Lexicon, exceptions and curve are learned from a bounded sample
of labelled rows (``labelled.SAMPLE_PER_CLASS``) or given.

Scale: scoring is map-only over whole texts; the model is a few kilobytes.
"""

from __future__ import annotations

import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Letters of other scripts that look like Latin ones.
HOMOGLYPHS = dict(zip("авеһіјкӏмнорѕтухԁԛԝсαβεηικνορτυχω", "abehijklmhopstyxdqwcabenikvoptuxw"))
#: Digits and signs that stand for letters.
SUBSTITUTES = dict(zip("0134578@$", "oieastbas"))
#: Code points of the fold table: all planes with letters. Above are invisible signs, private use and nothing else.
_LUT_SIZE = 0x33480
_SIGNS = (0xE0000, 0xE0FFF)
#: Folded code of characters that stand for several.
_SEVERAL = 0x110000
PREFIX_LETTERS = range(3, 11)
LEAST_WEIGHT = 2.0
MOST_ENTRIES = 2000


def _fold_char(c: str) -> int:
    plain = [x for x in unicodedata.normalize("NFKC", c).lower() if unicodedata.category(x) not in ("Mn", "Cf")]
    if len(plain) != 1:
        return _SEVERAL if plain else 0
    c = SUBSTITUTES.get(plain[0], HOMOGLYPHS.get(plain[0], plain[0]))
    return ord(c) if c.isalpha() else 32


def fold_table() -> np.ndarray:
    """Code point to folded code point; 0 is dropped, 32 separates words."""
    return np.array([_fold_char(chr(c)) for c in range(_LUT_SIZE)], np.uint32)


def _look_up(text: str, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    code = table[np.minimum(raw, _LUT_SIZE - 1)]
    high = raw >= _LUT_SIZE
    if high.any():
        code[high] = np.where((raw[high] >= _SIGNS[0]) & (raw[high] <= _SIGNS[1]), 0, 32)
    return raw, code


def fold(text: str, table: np.ndarray) -> str:
    """The folded text: words with one space before and after each."""
    raw, code = _look_up(text, table)
    several = np.unique(raw[code == _SEVERAL]).tolist()
    if several:
        code = _look_up(text.translate({c: unicodedata.normalize("NFKC", chr(c)) for c in several}), table)[1]
    code = np.concatenate([[np.uint32(32)], code[code > 0], [np.uint32(32)]]).astype("<u4")
    space = code == 32
    twice = space[1:] & space[:-1]
    return code[np.concatenate([[True], ~twice])].tobytes().decode("utf-32-le")


@dataclass
class Lexicon:
    """``words`` (whole) and ``prefixes`` (word beginnings) to weights, in folded
    form; ``exceptions`` are phrases inside which no hit counts; the score is
    1 / (1 + exp(-(slope * log(1 + density) + offset)))."""
    words: dict[str, float] = field(default_factory=dict)
    prefixes: dict[str, float] = field(default_factory=dict)
    exceptions: list[str] = field(default_factory=list)
    slope: float = 1.0
    offset: float = -1.0

    def automaton(self) -> ahocorasick.Automaton:
        a = ahocorasick.Automaton()
        for w, x in self.prefixes.items():
            a.add_word(f" {w}", (x, len(w) + 1, 1))
        for w, x in self.words.items():
            a.add_word(f" {w} ", (x, len(w) + 2, 2))
        for p in self.exceptions:
            a.add_word(f" {p} ", (0.0, len(p) + 2, 0))
        if len(a):
            a.make_automaton()
        return a


def hits(folded: str, automaton: ahocorasick.Automaton) -> list[tuple[int, int, float]]:
    """(start, end, weight) of the heaviest hit of each word that no exception covers."""
    if not len(automaton):
        return []
    best: dict[int, tuple[int, int, float]] = {}
    covered: list[tuple[int, int]] = []
    for last, (weight, size, kind) in automaton.iter(folded):
        start = last - size + 1
        if kind == 0:
            covered.append((start, last + 1))
        elif start not in best or best[start][2] < weight:
            best[start] = (start, last + 1, weight)
    covered.sort()
    kept, at, reach = [], 0, -1          # reach: how far the exceptions begun so far go
    for h in sorted(best.values()):
        while at < len(covered) and covered[at][0] <= h[0]:
            reach = max(reach, covered[at][1] - 1)
            at += 1
        if h[0] >= reach:
            kept.append(h)
    return kept


def density(folded: str, automaton: ahocorasick.Automaton) -> float:
    """Weighted hits per 100 words, short texts counted as 20 words."""
    return 100 * sum(h[2] for h in hits(folded, automaton)) / max(folded.count(" ") - 1, 20)


def learn(examples: list[tuple[str, int]], sizes: dict[int, int]) -> Lexicon:
    """Lexicon from texts labelled 1 (toxic) and 0: entries by log-odds of their
    document shares, exceptions by word pairs around hits of clean texts, and
    the curve by logistic regression weighted to the class sizes ``sizes``.
    With one class only (or none) nothing is matched; the score is its share."""
    table = fold_table()
    folded = sorted({(fold(t, table), y) for t, y in examples})
    n = Counter(y for _, y in folded)
    if not n[0] or not n[1]:
        share = 0.999 if n[1] else 0.001
        return Lexicon(offset=float(np.log(share / (1 - share))))
    share_of = [Counter(), Counter()]
    for text, y in folded:
        distinct = set(text.split())
        units = {f"{w} " for w in distinct if len(w) >= 3}
        units.update(w[:k] for w in distinct for k in PREFIX_LETTERS if k <= len(w))
        share_of[y].update(units)
    least = max(5, round(0.005 * n[1]))
    extended = Counter()                          # most documents that one continuation of a beginning has
    for unit, count in share_of[1].items():
        extended[unit[:-1]] = max(extended[unit[:-1]], count)
    weight = {}
    for unit, count in share_of[1].items():
        if count >= least and extended[unit] < 0.9 * count:      # else its continuation says it all
            x = float(np.log((count + 0.5) / (n[1] + 1)) - np.log((share_of[0][unit] + 0.5) / (n[0] + 1)))
            if x >= LEAST_WEIGHT:
                weight[unit] = x
    kept: dict[str, float] = {}
    for unit in sorted(weight, key=len):          # a longer entry must be clearly heavier than its beginning
        under = max((kept.get(unit[:k], -1.0) for k in range(1, len(unit))), default=-1.0)
        if weight[unit] > under + 1.5:
            kept[unit] = weight[unit]
    kept = dict(sorted(kept.items(), key=lambda e: (-e[1] * share_of[1][e[0]], e[0]))[:MOST_ENTRIES])
    out = Lexicon({u[:-1]: x for u, x in kept.items() if u[-1] == " "}, {u: x for u, x in kept.items() if u[-1] != " "})
    out.exceptions = _exceptions(folded, n, out.automaton())
    automaton = out.automaton()
    x = np.log1p([density(t, automaton) for t, _ in folded])
    y = np.array([y for _, y in folded], float)
    importance = np.array([sizes.get(int(v), 1) / n[int(v)] for v in y])
    out.slope, out.offset = _logistic(x, y, importance / importance.sum())
    return out


def _exceptions(folded: list[tuple[str, int]], n: Counter, automaton: ahocorasick.Automaton) -> list[str]:
    """Word pairs with a hit that clean texts hold at a clearly higher share."""
    seen = [Counter(), Counter()]
    for text, y in folded:
        pairs = set()
        for start, _, _ in hits(text, automaton):
            before, after = text[:start].rsplit(" ", 1)[-1], text[start + 1:start + 200].split(" ", 2)[:2]
            pairs.add(" ".join(after) if len(after) > 1 and after[1] else "")
            pairs.add(f"{before} {after[0]}" if before else "")
        seen[y].update(pairs - {""})
    return sorted(p for p, c in seen[0].items() if c >= 5 and c / n[0] > 4 * (seen[1][p] + 0.5) / n[1])


def _logistic(x: np.ndarray, y: np.ndarray, importance: np.ndarray) -> tuple[float, float]:
    a = np.stack([x, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(50):                            # Newton steps with a small ridge
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        gradient = a.T @ (importance * (p - y)) + 1e-4 * w
        curve = (a * (importance * p * (1 - p))[:, None]).T @ a + 1e-4 * np.eye(2)
        w -= np.linalg.solve(curve, gradient)
    return float(w[0]), float(w[1])


def score(docs: DataFrame, lexicon: Lexicon, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score, n_hits, entries`` for every row: the score (0 to 1), the
    counted hits and the distinct folded words hit, in order. Null and empty
    texts have no hits and get the curve's value at 0. Repeated rows each get a
    row; other columns are ignored; an empty table gives no rows."""
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast((lexicon, fold_table()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, table = shared.value
        automaton = model.automaton()
        for batch in batches:
            dense, n_hits, entries = [], [], []
            for t in batch.column("text"):
                folded = fold(t.as_py() or "", table)
                found = hits(folded, automaton)
                dense.append(100 * sum(h[2] for h in found) / max(folded.count(" ") - 1, 20))
                n_hits.append(len(found))
                entries.append(list(dict.fromkeys(folded[a + 1:folded.index(" ", a + 1)] for a, _, _ in found)))
            x = np.clip(model.slope * np.log1p(np.array(dense)) + model.offset, -700, 700)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-x)), pa.float64()),
                                              pa.array(n_hits, pa.int64()), pa.array(entries, pa.list_(pa.string()))],
                                             ["doc_id", "score", "n_hits", "entries"])
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, score double, n_hits long, entries array<string>")
