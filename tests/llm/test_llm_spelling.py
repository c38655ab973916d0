"""Spelling variants against comparing all pairs."""
import random
import re
import zlib
from collections import Counter

from claimflow.llm import spelling
from rows import awkward, empty

LOWER = {i: i + 32 for i in range(65, 91)}


def one_apart(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = next((k for k in range(len(a)) if a[k] != b[k]), len(a))
    return a[i + 1:] == b[i + 1:] if len(a) == len(b) else a[i:] == b[i + 1:]


def brute(counts, least=2, ratio=10):
    n = {w: c for w, c in counts.items() if len(w) >= 7 and c >= least}
    near = {w: [x for x in n if one_apart(w, x)] for w in n}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, n[w], len(near[w]), form[w], n[form[w]] if form[w] else None, root))
    return sorted(out)


def changed(rng, w):
    i, letter = rng.randrange(len(w)), rng.choice("abcdeéÿ")
    return rng.choice([w[:i] + w[i + 1:], w[:i] + letter + w[i:], w[:i] + letter + w[i + 1:], w[:i] + w[i:i + 2][::-1] + w[i + 2:]])


def test_signatures_of_variants_meet():
    rng = random.Random(2)
    for first, second in ((1, 6), (2, 4), (2, 3), (1, 3)):
        words = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(7, 14))) for _ in range(300)]
        others = [changed(rng, w) for w in words]
        for w, x, a, b in zip(words, others, spelling.signatures(words, first, second), spelling.signatures(others, first, second)):
            if one_apart(w, x):
                assert (a == b).any(), (w, x)
    words += ["abcdefg", "abcdefgh"]
    others += ["abcdxfg", "bcdefgh"]
    for w, x in zip(words, others):
        if one_apart(w, x) and min(len(w), len(x)) >= 7:
            at, sigs = spelling.signature_rows([w, x])
            assert set(sigs[at == 0].tolist()) & set(sigs[at == 1].tolist()), (w, x)


def test_variants_equal_all_pairs(spark):
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdé") for _ in range(rng.randint(7, 9))) for _ in range(60)]
    counts = Counter()
    for s in stems:
        counts[s] += rng.choice([1, 3, 40, 400])
        for _ in range(8):
            w = changed(rng, s)
            counts[w] += rng.choice([1, 2, 4, 40])
            counts[changed(rng, w)] += rng.choice([1, 2, 3])
        counts["".join(rng.sample(s, len(s)))] += 2          # same letters, another order
    rows = [(w,) for w, c in counts.items() for _ in range(c)] + [(None,), ("",), ("kurz",), ("kurz",)] + [("z" * 30_000,), ("z" * 30_001,)] * 2
    counts.update({"z" * 30_000: 2, "z" * 30_001: 2})
    got = sorted(tuple(r) for r in spelling.variants(spark.createDataFrame(rows, "word string")).select("word", "n", "n_near", "form", "form_n", "root").collect())
    assert got == brute(counts)
    assert sum(1 for g in got if g[3]) > 20 and any(g[3] and g[5] != g[3] for g in got)


def test_occurrences_with_slips(spark):
    docs, rows = awkward(spark)
    texts = docs.select("doc_id", "text").unionByName(spark.createDataFrame(
        [(7, "Größenwahn, ABCDEFGh ABCDEFGh×ij École ÉCOLIERS x" + "y" * 5000 + " abcdefg3abcdefgh"), (None, "Wörterbuch")], "doc_id long, text string"))
    want = Counter()
    for d, t in texts.collect():
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = run.translate(LOWER)
            h = zlib.crc32(f"{'' if d is None else d}:{w}".encode())
            if h % 3 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= 7:
                want[w] += 1
    assert Counter(r.word for r in spelling.occurrences(texts, slip=3).collect()) == want
    plain = Counter(w for _, t in texts.collect() for w in re.findall("[a-zÀ-ÿ]+", "" if t is None else re.sub("[A-Z]", lambda m: m.group().lower(), t)) if len(w) >= 7)
    assert Counter(r.word for r in spelling.occurrences(texts).collect()) == plain
    assert spelling.variants(spelling.occurrences(empty(spark))).count() == 0
