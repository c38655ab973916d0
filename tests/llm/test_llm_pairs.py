"""Near-duplicates, components, URL aliases, substring repeats, top-k."""
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimflow.llm import near_dedup, substring_dedup, topk, url_filter
from claimflow.llm.components import connected_components
from rows import awkward, empty, prose

LOWER = {i: i + 32 for i in range(65, 91)}


def find(parent, x):
    while parent[x] != x:
        x = parent[x]
    return x


def brute_components(nodes, links):
    parent = {n: n for n in nodes}
    for a, b in links:
        a, b = find(parent, a), find(parent, b)
        parent[max(a, b)] = min(a, b)
    return {n: find(parent, n) for n in nodes}


def shingles(text, n):
    w = re.findall(r"[^\x20\x09-\x0d]+", (text or "").translate(LOWER))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def brute_near(rows, n, percent):
    sets = [(r[0], shingles(r[1], n)) for r in rows]
    links = [(a, b) for i, (a, x) in enumerate(sets) for b, y in sets[:i]
             if a is not None and b is not None and x and y and 100 * len(x & y) >= percent * len(x | y)]
    return brute_components({i for i, _ in sets if i is not None}, links)


def test_components_of_chains_stars_and_noise(spark):
    rng = random.Random(2)
    links = [(i, i + 1) for i in range(0, 60)] + [(1000, 1001 + i) for i in range(200)] + [(2000 + 2 * i, 2001 + 2 * i) for i in range(5)]
    links += [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)]
    rng.shuffle(links)
    df = spark.createDataFrame(links + [(None, 3), (4, None), (5, 5), links[0]], "a long, b long")
    got = {r.node: r.component for r in connected_components(df, "a", "b").collect()}
    nodes = {x for pair in links for x in pair if pair[0] != pair[1]}
    assert got == brute_components(nodes, [p for p in links if p[0] != p[1]])
    assert connected_components(df.where("a < 0"), "a", "b").count() == 0


def test_registers_hold_the_smallest_hash_of_each_bucket():
    hashes = np.sort(np.random.default_rng(3).integers(0, 2**64, 5000, dtype=np.uint64))
    got = near_dedup.registers(hashes, np.array([0, 5000]))[0]
    low = {}
    for h in hashes.tolist():
        low.setdefault(h * near_dedup.REGISTERS >> 64, (h * near_dedup.REGISTERS) & (2**64 - 1))
    for bucket, rest in low.items():
        bits = format(rest >> 11, "053b")
        zeros = len(bits) - len(bits.lstrip("0"))
        assert got[bucket] == ((zeros + 1) << 10) | int((bits[zeros + 1:] + "0" * 10)[:10], 2)
    assert set(np.flatnonzero(got)) == set(low)


def test_estimates_are_close_and_unbiased_by_chance_collisions():
    rng = np.random.default_rng(4)
    for share, n in ((0.0, 3000), (0.5, 3000), (0.9, 400), (0.9, 40), (1.0, 5)):
        errors = []
        for _ in range(60):
            pool = rng.integers(0, 2**64, 2 * n, dtype=np.uint64)
            same = int(round(2 * n * share / (1 + share)))
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[:same], pool[n:2 * n - same]]))
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            ra, rb = near_dedup.registers(a, np.array([0, len(a)])), near_dedup.registers(b, np.array([0, len(b)]))
            errors.append(float(near_dedup.estimate(ra, rb, np.array([len(a)]), np.array([len(b)]))[0]) - true)
        assert abs(np.mean(errors)) < 0.03, (share, n)


def near_copies(rng, n_groups=12):
    rows, k = [], 0
    for g in range(n_groups):
        base = prose(rng, rng.choice([4, 9, 30, 120, 400])).split()
        for _ in range(rng.randint(1, 9)):
            copy = list(base)
            for _ in range(rng.randint(0, max(1, len(base) // 40))):
                copy[rng.randrange(len(copy))] = f"edit{rng.randrange(1000)}"
            rows.append((k, " ".join(copy), "en", "a", 1))
            k += 1
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("n, percent", [(3, 85), (5, 80)])
def test_near_duplicates_equal_brute_force(spark, n, percent):
    df, rows = awkward(spark)
    more = [(1000 + r[0], *r[1:]) for r in near_copies(random.Random(6))]
    df = df.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    rows = rows + more
    out = near_dedup.near_duplicates(df, n, percent).collect()
    want = brute_near(rows, n, percent)
    assert len(out) == len(rows)
    assert Counter((r.doc_id, r.n_shingles) for r in out) == Counter((r[0], len(shingles(r[1], n))) for r in rows)
    for r in out:
        assert r.component_id == want.get(r.doc_id) and r.kept == (r.doc_id is None or r.doc_id == want[r.doc_id])
    kept = near_dedup.unique_documents(df, shingle_words=n, percent=percent)
    assert kept.columns == df.columns
    # rows are grouped by text here: number them, and take each group's smallest key
    groups = brute_near([(i, *r[1:]) if r[0] is not None else r for i, r in enumerate(rows)], n, percent)
    first = {}
    for i, r in enumerate(rows):
        if r[0] is not None:
            g = groups[i] if shingles(r[1], n) else ("bare", i)
            first[g] = min(first.get(g, r[0]), r[0])
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted(first.values())
    assert kept.where("doc_id is null").count() == 2


def test_near_duplicates_of_empty_table(spark):
    assert near_dedup.near_duplicates(empty(spark), 5, 80).count() == 0


def test_a_key_with_several_texts_keeps_the_links_of_each(spark):
    rng = random.Random(36)
    texts = [prose(rng, 200) for _ in range(6)]
    rows = [(1, t) for t in texts] + [(2 + i, t + " and so on") for i, t in enumerate(texts)]
    schema = "doc_id long, text string"
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, schema)).collect()
    assert len(out) == 12 and {r.component_id for r in out} == {1}
    kept = [near_dedup.unique_documents(spark.createDataFrame(r, schema).coalesce(1)).collect() for r in (rows, rows[::-1])]
    assert sorted(r.text for r in kept[0]) == sorted(texts) and sorted(kept[0]) == sorted(kept[1])
    clean = [(1, texts[0]), (1, texts[1]), (2, texts[2]), (2, texts[2])]
    assert sorted(map(tuple, near_dedup.unique_documents(spark.createDataFrame(clean, schema)).collect())) == sorted(set(clean))


def test_one_large_group_around_the_threshold(spark, monkeypatch):
    """Near copies just over and just under the threshold, over many blocks."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 4_000)
    rng = random.Random(11)
    base, rows = prose(rng, 130).split(), []
    for k in range(500):
        copy = list(base)
        for at in rng.sample(range(0, 130, 3), rng.randint(1, 4)):
            copy[at] = f"own{k}x{at}"
        rows.append((k, " ".join(copy)))
    out = {r.doc_id: r.component_id for r in near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()}
    want = brute_near(rows, 3, 85)
    assert out == want and 1 < len(set(want.values())) < 500


def test_a_bucket_lies_in_few_blocks(spark, monkeypatch):
    """Buckets of nodes whose numbers lie far apart: a node is in two tasks at
    most, and every two nodes of a bucket meet."""
    monkeypatch.setattr(near_dedup, "BLOCK_SHINGLES", 100)
    groups = [[g + 50 * j for j in range(8)] for g in range(50)]
    members = spark.createDataFrame([(3 * g + b, x) for g, nodes in enumerate(groups) for b in range(3) for x in nodes], "key long, node long")
    nodes = spark.createDataFrame([(x, 10) for g in groups for x in g], "node long, n long")
    tasks = near_dedup._block_tasks(members, spark.createDataFrame([], "node long, component long"), nodes).collect()
    held = Counter(t.node for t in tasks)
    assert set(held) == set(range(400)) and max(held.values()) <= 2
    at = {}
    for t in tasks:
        at.setdefault(t.node, set()).add((t.x, t.y))
    assert all(at[a] & at[b] for g in groups for a in g for b in g)


def test_long_words_of_equal_sums_are_different(spark):
    word = "a"
    for _ in range(10):
        word += word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, word.translate(str.maketrans("ab", "ba")))]
    out = near_dedup.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"), 3, 85).collect()
    assert {r.doc_id: r.component_id for r in out} == {1: 1, 2: 2}


def test_only_the_last_stages_are_left(spark):
    import glob

    from claimflow.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    rows = near_copies(random.Random(12))
    before = set(glob.glob(f"{folder}/llm/*"))
    near_dedup.near_duplicates(spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string")).collect()
    left = {x.rsplit("/", 1)[1].rsplit("-", 1)[0] for x in set(glob.glob(f"{folder}/llm/*")) - before}
    assert left <= {"signatures", "components", "component-keys"}, left


def test_gear_cuts_move_only_next_to_an_insertion():
    from claimflow.llm.common import NON_SPACE, flat, words
    rng = random.Random(9)
    def cuts(text):
        buf, at = flat(pa.array([text]))
        w = words(buf, at, NON_SPACE)
        found, reach = substring_dedup.cut_points(buf, w)
        assert all(r < c for c, r in zip(found, reach))
        plain = b"".join(x.encode() + b" " for x in text.split())
        for i, end in zip(range(60, 90), np.cumsum([len(x.encode()) + 1 for x in text.split()])[60:90].tolist()):
            rolled = sum(int(substring_dedup.GEAR[b]) << k for k, b in enumerate(reversed(plain[end - 32:end]))) % 2 ** 32
            assert (i in found) == (rolled >> 29 == 0)
        return found
    for _ in range(20):
        text = prose(rng, 3000).split()
        at, new = rng.randrange(200, 2800), prose(rng, rng.randint(1, 9)).split()
        before, after = cuts(" ".join(text)), cuts("\n ".join(text[:at] + new + text[at:]))
        assert len(before) > 250 and (np.diff(before) > 20).sum() > 5 and (np.diff(before) < 4).sum() > 50
        assert after[after < at].tolist() == before[before < at].tolist()
        beyond = at + substring_dedup.GEAR_BYTES // 2
        assert (after[after >= beyond + len(new)] - len(new)).tolist() == before[before >= beyond].tolist()


def test_gear_bounds_move_with_the_content():
    rng = random.Random(8)
    text = prose(rng, 600)
    def cut(ts):
        buf, at, dig, size, *_, b = substring_dedup._chunk_rows(pa.RecordBatch.from_arrays([pa.array(ts)], ["text"]))
        return [dig[b[i]:b[i + 1]].tolist() for i in range(len(ts))]
    alone, after, shifted = cut([text]), cut(["z " * 50, text]), cut(["an insertion of words " + text])
    assert after[1] == alone[0]
    assert len(set(alone[0]) - set(shifted[0])) <= 3 and len(alone[0]) > 60


def test_repeated_passages_against_brute_force(spark):
    rng = random.Random(9)
    df, rows = awkward(spark)
    passage = [prose(rng, n) for n in (51, 60, 200, 20)]
    more = []
    for i in range(40):
        body = prose(rng, rng.randint(30, 200)).split()
        for p in passage:
            if rng.random() < 0.3:
                at = rng.randrange(len(body))
                body[at:at] = p.split()
        more.append((1000 + i, " ".join(body), "en", "a", 1))
    rows = rows + more
    df = df.unionByName(spark.createDataFrame(more, "doc_id long, text string, lang string, source string, n_chars long"), allowMissingColumns=True)
    out = substring_dedup.deduplicate_substrings(df).collect()
    assert len(out) == len(rows)
    texts = {}
    for r in rows:
        texts.setdefault(r[0], []).append((r[1] or "").split())

    def shared(length):
        seen = {}
        for i, versions in texts.items():
            for w in versions if i is not None else []:
                for j in range(len(w) - length + 1):
                    seen.setdefault(tuple(w[j:j + length]), set()).add(i)
        return {i for s in seen.values() if len(s) > 1 for i in s}
    flagged = {r.doc_id for r in out if r.repeated}
    assert shared(50) - {111} <= flagged <= shared(substring_dedup.LEAST_WORDS)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    assert all(r.text is None for r in by_id[100]) and by_id[101][0].text == "" and by_id[102][0].text == " \t\n "
    # What is left, and what was cut, make the text; the smallest key keeps a passage.
    for r in rows:
        mine = [o for o in by_id[r[0]] if r[1] is not None and sum(s.end - s.start for s in o.removed_spans) + len((o.text or "").encode()) == len(r[1].encode())]
        assert mine or r[1] is None
    for p in passage[:3]:
        holders = sorted(r[0] for r in more if p in r[1])
        if len(holders) > 1:
            assert " ".join(p.split()[12:-12]) in by_id[holders[0]][0].text
            assert all(p not in by_id[h][0].text for h in holders[1:])
    assert substring_dedup.deduplicate_substrings(empty(spark)).count() == 0



def cut_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in substring_dedup.deduplicate_substrings(df).collect()}


def test_every_passage_of_51_words_is_found(spark):
    rng = random.Random(31)
    def word():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(4, 6)))
    def some(n):
        return " ".join(word() for _ in range(n))
    passages = [some(51) for _ in range(2000)]
    out = cut_of(spark, [f"{some(20)} {p} {some(20)}" for p in passages * 2])
    assert all(out[i].repeated for i in out)
    assert all(passages[i] in out[i].text and not out[i].removed for i in range(2000))
    assert all(len(out[2000 + i].text.split()) == 40 for i in range(2000))



def test_the_first_holder_keeps_its_passage_whole(spark):
    rng = random.Random(32)
    passage = prose(rng, 60)
    part = " ".join(passage.split()[10:40])
    out = cut_of(spark, [f"{prose(rng, 9)} {part} {prose(rng, 9)}", f"{prose(rng, 9)} {passage}", f"{passage} {prose(rng, 9)}"])
    assert [out[i].repeated for i in range(3)] == [False, True, True]
    assert not out[1].removed and passage in out[1].text and len(out[2].text.split()) == 9


def test_cuts_are_the_windows_that_an_earlier_document_holds(spark):
    rng = random.Random(33)
    parts = [prose(rng, n) for n in (20, 30, 45, 49, 50, 51, 55, 70, 120)]
    texts = [" ".join(rng.choice(parts) if rng.random() < 0.6 else prose(rng, rng.randint(1, 30)) for _ in range(rng.randint(1, 9))) for _ in range(60)]
    holders = {}
    for i, t in enumerate(texts):
        for j in range(len(t.split()) - 49):
            holders.setdefault(tuple(t.split()[j:j + 50]), set()).add(i)
    out = cut_of(spark, texts)
    for i, t in enumerate(texts):
        w = t.split()
        shared, cut = set(), set()
        for j in range(len(w) - 49):
            held = holders[tuple(w[j:j + 50])]
            shared |= set(range(j, j + 50)) if len(held) > 1 else set()
            cut |= set(range(j, j + 50)) if min(held) < i else set()
        assert out[i].text.split() == [x for j, x in enumerate(w) if j not in cut]
        assert sum(len(t.encode()[s.start:s.end].split()) for s in out[i].repeated_spans) == len(shared)


def test_text_without_spaces_and_words_repeated_on_and_on(spark):
    rng = random.Random(34)
    def signs(n, lo=0x4E00, hi=0x5E00):
        return "".join(chr(rng.randrange(lo, hi)) for _ in range(n))
    passage, code, tail = signs(400), signs(900, 0x30, 0x7B), signs(99, 0x30, 0x7B)
    out = cut_of(spark, [signs(77) + passage + signs(80), signs(140) + passage + signs(11), code, code, tail + signs(9), tail + signs(500),
                         "so it goes " + "la lo " * 90 + "on", "la lo " * 70, "x " + "la lo li " * 90, "lo li la " * 30, "hm " * 55, "hm " * 60])
    assert [i for i in out if not out[i].repeated] == [4, 5]
    assert passage in out[0].text and len(out[1].text) == 151
    assert out[2].text == code and out[3].text == ""
    assert not any(out[i].removed for i in (0, 2, 6, 8, 10)) and not any(out[i].text.strip() for i in (7, 9, 11))


def test_phrases_of_different_documents_are_no_passage(spark):
    rng = random.Random(35)
    w = prose(rng, 127).split()
    out = cut_of(spark, [f"{prose(rng, 9)} {' '.join(w[10 * k:10 * k + 27])} {prose(rng, 9)}" for k in range(11)] + [" ".join(w)])
    assert not any(r.repeated or r.removed for r in out.values())


def brute_top(rows, k):
    vec = [(i, [int(np.floor(256 * float(x))) for x in v]) for i, v in rows
           if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    out = []
    for n, (q, a) in enumerate(vec):
        if q % 50 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b)), i) for m, (i, b) in enumerate(vec) if m != n and len(a) == len(b))
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def test_top_k_equals_brute_force(spark):
    rng = np.random.default_rng(10)
    rows = [(i, [float(x) for x in np.round(rng.normal(size=6), 1)]) for i in range(230)]
    rows += [(300, None), (301, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (302, [float("nan")] * 6), (303, [float("inf")] * 6), (None, [1.0] * 6),
             (350, [0.5, 0.25]), (351, [0.5, 1.0]), (400, [0.0] * 6), (100, rows[100][1]), (500, []), (7, rows[7][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumns({"q": F.lit(1), "score": F.lit(2), "copy": F.lit(3)})
    for block in (4096, 3):
        got = topk.top_k(df, F.col("vec_id") % 50 == 0, query_block=block).collect()
        assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in got) == brute_top(rows, 5)
    assert topk.top_k(df.where("vec_id < 0"), F.col("vec_id") % 50 == 0).count() == 0


def test_top_k_of_huge_components_is_exact_and_clamped(spark):
    rows = [(0, [1e15, -1e15]), (1, [1e15, 1.0]), (2, [-1e30, 0.0]), (3, [0.03125, 0.015625])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {r.vec_id: r.score for r in topk.top_k(df, F.col("vec_id") == 0).collect()}
    assert got[1] == 2**63 - 1 and got[2] == -2**63 and got[3] == int(256e15) * 8 - int(256e15) * 4


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]


def test_url_rules_by_hand(spark):
    cases = [("http://A.Example.COM/en/1?x#y", "a.example.com", "/en/1", "example.com/en/", "block"),
             ("https://www.example.com/en/", "www.example.com", "/en/", "www.example.com/en/", "allow"),
             ("https://x.www.example.com/en/5", "x.www.example.com", "/en/5", "www.example.com/en/", "allow"),
             ("https://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
             ("ftp://h.net/es/a#b", "h.net", "/es/a", "net/es/", "block"),
             ("https://h.net/ES/a", "h.net", "/ES/a", None, "allow"),
             ("https://example.com?x=/en/", "example.com", "", None, "allow"),
             ("no scheme", "", "", None, "allow"), (None, "", "", None, "allow"), ("://", "", "", None, "allow"),
             ("a://b://c/d", "b:", "//c/d", None, "allow")]
    df = spark.createDataFrame([(i, c[0], None) for i, c in enumerate(cases)], "page_id long, url string, html string")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df, RULES).collect()}
    assert got == {i: c[1:] for i, c in enumerate(cases)}


def test_url_aliases_carry_blocks_and_explicit_allows_win(spark):
    link = '<link href="{}" rel=canonical>'
    pages = [(1, "https://a.org/1", link.format("https://h.net/es/1")),               # alias of a blocked address
             (2, "https://b.org/1", '<META http-equiv="Refresh" content="0; URL=https://a.org/1">'),   # two steps away
             (3, "http://b.org/1/#top", None),                                         # the same page by another spelling
             (4, "https://c.org/1", link.format("https://h.net/fr/2")), (5, "https://d.com/1", link.format("https://c.org/1")),   # an allowed member
             (6, "https://e.org/", link.format("/x?a=1&amp;b=2")), (7, "https://e.org/x?a=1&b=2", ""),
             (8, "https://f.org/1", '<link rel="canonical">'), (8, "https://a.org/1", "plain"), (None, "https://a.org/1", "x")]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").withColumns({"host": F.lit(1), "node": F.lit(2), "rule": F.lit(3)})
    got = sorted(((r.page_id or 0, r.verdict) for r in url_filter.judge(df, RULES).collect()))
    assert got == [(0, "block"), (1, "block"), (2, "block"), (3, "block"), (4, "allow"), (5, "allow"), (6, "allow"), (7, "allow"), (8, "allow"), (8, "block")]
    assert url_filter.judge(df.where("page_id < 0"), RULES).count() == 0
    assert {r.verdict for r in url_filter.judge(df, []).collect()} == {"allow"}
