"""Decontamination, mixing, packing."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimflow.llm import decontaminate, mixing, packing
from rows import SCHEMA, awkward, empty, prose

LOWER = {i: i + 32 for i in range(65, 91)}
ITEM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return ITEM.findall((text or "").translate(LOWER))


def brute_hits(text, items, window):
    w, hit, ids, longest = words(text), set(), set(), 0
    for key, t in items:
        x = words(t)
        k = min(window, len(x))
        for j in range(len(x) - k + 1 if k else 0):
            for i in range(len(w) - k + 1):
                if w[i:i + k] == x[j:j + k]:
                    hit.update(range(i, i + k))
                    n = k
                    while i + n < len(w) and j + n < len(x) and w[i + n] == x[j + n]:
                        n += 1
                    longest = max(longest, n)
                    if key is not None:
                        ids.add(str(key))
    return len(w), len(hit), len(ids), hashlib.sha256(",".join(sorted(ids)).encode()).hexdigest(), len(hit) > 0, longest


@pytest.mark.parametrize("block_words", [500_000, 60])
def test_contamination_equals_brute_force(spark, block_words):
    rng = random.Random(3)
    df, rows = awkward(spark, 20)
    rows = [r for r in rows if r[0] not in (109, 110, 111)]
    items = [(i, prose(rng, rng.randint(8, 30))) for i in range(12)] + [(12, None), (13, ""), (14, "river9 stone3"), (15, "--"), (None, prose(rng, 15)), (1, prose(rng, 12)), (20, "Été 42"),
                                                                        (21, "la la la la la la la la la la la")]
    more = []
    for i in range(25):
        body = prose(rng, rng.randint(0, 60)).split()
        _, t = rng.choice([x for x in items if x[1]])
        t = t.split()
        a = rng.randrange(len(t))
        piece = t[a:a + rng.randint(1, 30)]
        at = rng.randint(0, len(body))
        body[at:at] = [x.upper() + "," for x in piece] if rng.random() < 0.3 else piece
        more.append((1000 + i, " ".join(body), "en", "a", 1))
    more.append((2000, "la " * 40, "en", "a", 1))
    rows = rows + more
    df = df.where("doc_id is null or doc_id not in (109, 110, 111)").unionByName(spark.createDataFrame(more, SCHEMA), allowMissingColumns=True)
    bench = spark.createDataFrame(items, "item_id long, text string").withColumn("doc_id", F.lit(1))
    got = Counter(tuple(r) for r in decontaminate.report(df, bench, block_words=block_words).select(
        "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "longest").collect())
    want = Counter((r[0], *brute_hits(r[1], items, 10)) for r in rows)
    assert got == want and sum(r[5] for r in want) > 4
    clean = decontaminate.clean_documents(df, bench, block_words=block_words)
    assert clean.columns == df.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(r[0] for r in rows if not brute_hits(r[1], items, 10)[1])


def test_contamination_of_long_texts_and_empty_tables(spark):
    df, rows = awkward(spark, 5)
    bench = spark.createDataFrame([(1, " ".join(rows[-3][1].split()[40_000:40_300]))], "item_id long, text string")
    got = {r.doc_id: r for r in decontaminate.report(df, bench).collect()}
    assert got[109].longest == 300 and got[109].n_hit >= 300 and not got[110].contaminated
    assert decontaminate.report(empty(spark), bench).count() == 0
    assert not any(r.contaminated for r in decontaminate.report(df, bench.where("item_id < 0")).collect())


def test_repeating_text_and_repeating_items_stay_linear(spark):
    import time
    began = time.time()
    block = decontaminate.TestBlock([("1", "la " * 4000), ("2", "lo la " * 3000), ("3", "la li")], 10)
    batch = pa.RecordBatch.from_arrays([pa.array(["la " * 20_000 + "li", "x " + "lo la " * 5000, "no"])], ["text"])
    n, row, place, window, longest = decontaminate.matches(batch, block)
    assert n.tolist() == [20_001, 10_001, 1] and len(row) < 35_000
    assert [longest[row == r].max() for r in (0, 1)] == [4000, 6000] and (row < 2).all()
    assert {i for w in window[row == 0] for i in block.item_sets[block.set_of[w]]} == {"1", "3"}
    # many copies of one item against many copies of its text
    rng = random.Random(7)
    text = prose(rng, 30)
    items = spark.createDataFrame([(i, text) for i in range(800)], "item_id long, text string")
    docs = spark.createDataFrame([(i, f"{prose(rng, 5)} {text} {prose(rng, 5)}") for i in range(800)], "doc_id long, text string")
    got = decontaminate.report(docs, items).collect()
    assert all((r.n_hit, r.n_items, r.longest) == (30, 800, 30) for r in got)
    assert time.time() - began < 60


def test_longest_matches_equal_plain_search():
    rng = random.Random(13)
    for _ in range(40):
        items = ["".join(rng.choice("abc") + " " for _ in range(rng.randint(3, 40))) for _ in range(4)]
        block = decontaminate.TestBlock(list(enumerate(items)), 3)
        text = [rng.choice("abc") for _ in range(60)]
        tokens = np.array([{w: i for i, w in enumerate(block.words)}[x.encode()] + 1 for x in text] + [0])
        got = decontaminate.longest_matches(tokens, np.arange(60), block)
        for p in range(60):
            n = 0
            while p + n < 60 and any(" ".join(text[p:p + n + 1]) + " " in t for t in items):
                n += 1
            assert got[p] == n


def test_suffix_array_orders_suffixes():
    rng = np.random.default_rng(5)
    t = rng.integers(0, 4, 300)
    for deep in (1, 3, 10, 300):
        order = decontaminate.suffix_array(t, deep)
        keys = [t[i:i + deep].tolist() for i in order]
        assert keys == sorted(keys) and sorted(order.tolist()) == list(range(300))


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(rows):
    sizes = Counter()
    for r in rows:
        sizes[r[3]] += size(r[1])
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if level * weight[s] > 2 * sizes[s]}
        if not over:
            target.update({s: level * weight[s] for s in open_})
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    return sizes, target


def test_mix_meets_its_targets(spark):
    df, rows = awkward(spark, 60)
    a = mixing.mix_report(df).collect()
    assert Counter((r.doc_id, r["size"]) for r in a) == Counter((r[0], size(r[1])) for r in rows)
    assert Counter(a) == Counter(mixing.mix_report(df.repartition(13)).collect())
    sizes, target = brute_targets(rows)
    assert all(0 <= r.taken <= 2 * r["size"] for r in a)
    by_size = {v: s for s, v in sizes.items()}
    assert len(by_size) == len(sizes)
    taken = Counter()
    for r in a:
        s = by_size[r.source_size]
        assert abs(r.target - target[s]) < 1e-6
        taken[s] += r.taken
    assert all(abs(taken[s] - target[s]) <= 1 for s in sizes)
    assert mixing.mix_report(empty(spark)).count() == 0


def test_mixed_documents_hold_the_taken_words(spark):
    df, rows = awkward(spark, 30)
    out = mixing.mixed_documents(df, block_words=16)
    assert out.columns == df.columns
    out = out.collect()
    report = mixing.mix_report(df, block_words=16).collect()
    assert sum(size(r.text) for r in out) == sum(r.taken for r in report)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append(r[1] or "")
    for r in out:
        assert any(set(r.text.split()) <= set(t.split()) for t in texts[r.doc_id])
    assert mixing.mixed_documents(empty(spark)).count() == 0


def test_slots_fill_shards_and_blocks_evenly(spark):
    df, _ = awkward(spark, 60)
    seg = mixing.mix_segments(df, block_words=8, shard_slots=500).collect()
    slots = Counter((r.sid, r["pass"], r.slot) for r in seg)
    shards = Counter(r.shard for r in seg)
    assert len(shards) > 20 and max(shards.values()) < 3 * min(shards.values())
    assert len({(r.sid, r["pass"], r.slot): r.shard for r in seg}) == len(slots)


def test_every_shard_draws_its_source_counts(spark, monkeypatch):
    import math
    monkeypatch.setattr(mixing, "DRAW_SOURCES", 2)           # draws in two steps
    total = {0: 40_000, 1: 9_000, 2: 900, 3: 5, 4: 25_000}
    df = spark.createDataFrame(sorted(total.items()), "sid long, total long")
    shards, slots = 40, sum(total.values())
    got = {(r.shard, r.sid): r.drawn for r in mixing._drawn(df, shards, slots, 3).collect()}
    assert got == {(r.shard, r.sid): r.drawn for r in mixing._drawn(df.repartition(3), shards, slots, 3).collect()}
    size = [(k + 1) * slots // shards - k * slots // shards for k in range(shards)]
    for k in range(shards):
        assert sum(n for (shard, _), n in got.items() if shard == k) == size[k]
    for s, n in total.items():
        p = n / slots
        counts = [got.get((k, s), 0) for k in range(shards)]
        deviation = [(c - size[k] * p) / math.sqrt(size[k] * p * (1 - p)) for k, c in enumerate(counts)]
        assert max(map(abs, deviation)) < 5
        if n > 500:     # spread as a multinomial's, not dealt evenly
            assert 0.5 < sum(d * d for d in deviation) / shards < 1.7
    docs, _ = awkward(spark, 60)
    seg = mixing.mix_segments(docs).collect()
    assert len({r.shard for r in seg}) == mixing.LEAST_SHARDS


def test_permutations():
    for n in (1, 2, 3, 17, 1000, 4097):
        got = mixing.permute(np.arange(n), np.full(n, n), np.full(n, 99, np.uint64))
        assert sorted(got.tolist()) == list(range(n))


def test_best_fit_decreasing_equals_the_plain_rule():
    rng = random.Random(1)
    for _ in range(30):
        cap = rng.randint(1, 60)
        sizes = [rng.randint(1, cap) for _ in range(rng.randint(0, 150))]
        rows = packing.best_fit_decreasing(sizes, cap)
        assert sorted(i for r in rows for i in r) == list(range(len(sizes)))
        room = []
        for s in sorted(sizes, reverse=True):
            fits = [x for x in room if x >= s]
            if fits:
                room[room.index(min(fits))] -= s
            else:
                room.append(cap - s)
        assert sorted(cap - sum(sizes[i] for i in r) for r in rows) == sorted(room)


def test_packed_rows_give_the_texts_back(spark, tmp_dir):
    df, rows = awkward(spark)
    packed = packing.pack_documents(df, row_tokens=256, shard_tokens=5000)
    packing.write_packed(packed, f"{tmp_dir}/packed")
    out = spark.read.parquet(f"{tmp_dir}/packed").collect()
    import base64

    import tiktoken
    with open(packing.VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    plain = tiktoken.Encoding("plain", pat_str=packing.PATTERN, mergeable_ranks=ranks, special_tokens={})
    pieces = {}
    for r in out:
        ids = np.frombuffer(r.ids, "<u2")
        assert len(ids) == 256 and r.segment_ends[0] == 0 and r.segment_ends[-1] == r.n_tokens <= 256
        assert r.position_resets == r.segment_ends[:-1] and set(ids[r.n_tokens:].tolist()) <= {packing.END_ID}
        for i, (a, b) in enumerate(zip(r.segment_ends, r.segment_ends[1:])):
            pieces.setdefault(r.doc_ids[i], []).append((r.doc_offsets[i], ids[a:b].tolist()))
    want = {}
    for r in rows:
        if r[1] is not None:
            want.setdefault(r[0], []).append(r[1])
    assert set(pieces) == set(want)
    for doc, texts in want.items():
        if len(texts) == 1:
            ids = [x for _, part in sorted(pieces[doc]) for x in part]
            assert ids[-1] == packing.END_ID and plain.decode(ids[:-1]) == texts[0] and ids[:-1] == plain.encode_ordinary(texts[0])
        else:
            assert sum(len(p) for _, p in pieces[doc]) == sum(len(plain.encode_ordinary(t)) + 1 for t in texts)
    assert packing.pack_documents(empty(spark)).count() == 0


def test_hits_equal_plain_search_of_words_and_exceptions():
    import random

    from claimflow.llm import toxicity
    rng = random.Random(21)
    letters = "abc"
    def word(n):
        return "".join(rng.choice(letters) for _ in range(n))
    for _ in range(300):
        lex = toxicity.Lexicon({word(rng.randint(1, 3)): rng.randint(1, 9) for _ in range(4)}, {word(rng.randint(1, 3)): rng.randint(1, 9) for _ in range(3)},
                               [" ".join(word(rng.randint(1, 2)) for _ in range(rng.randint(1, 3))) for _ in range(4)])
        words = [word(rng.randint(1, 4)) for _ in range(rng.randint(0, 30))]
        text = " " + "".join(w + " " for w in words)
        want, start = [], 0
        for w in words:
            found = [(start, start + len(w) + 2, x) for e, x in lex.words.items() if e == w] + [(start, start + len(e) + 1, x) for e, x in lex.prefixes.items() if w.startswith(e)]
            under = False
            for e in lex.exceptions:
                at = text.find(f" {e} ")
                while at >= 0:
                    under |= at <= start < at + len(e) + 1
                    at = text.find(f" {e} ", at + 1)
            if found and not under:
                want.append((start, max(x for *_, x in found)))
            start += len(w) + 1
        got = toxicity.hits(text, lex.automaton())
        assert [(s, x) for s, _, x in got] == want, (lex, text)


def test_many_hits_and_exceptions_take_little_time():
    import time

    from claimflow.llm import toxicity
    lex = toxicity.Lexicon({"bad": 1.0, "good": 1.0}, {}, ["good thing"])
    text = " " + "bad good thing " * 100_000
    began = time.time()
    assert len(toxicity.hits(text, lex.automaton())) == 100_000
    assert time.time() - began < 5


def test_tags_are_found_in_long_and_unclosed_markup(spark):
    import time

    from claimflow.llm import url_filter
    canonical = '<link rel="canonical" href="https://b.org/x">'
    pages = [(1, "https://a.org/", "<link rel=canonical " * 50_000), (2, "https://a.org/", "<meta http-equiv=refresh " * 40_000 + canonical),
             (3, "https://a.org/", "<link rel=icon href=/i>" * 100 + canonical + '<LINK REL=canonical HREF=/y><meta http-equiv="refresh" content="0; url=/z">'),
             (4, "https://a.org/", None)]
    began = time.time()
    got = sorted((r.url, r.target) for r in url_filter.alias_links(spark.createDataFrame(pages, "page_id long, url string, html string")).collect())
    assert time.time() - began < 10
    assert got == [("https://a.org/", t) for t in ("https://a.org/y", "https://a.org/z", "https://b.org/x", "https://b.org/x")]
