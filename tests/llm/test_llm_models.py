"""Toxicity, quality, language ID: learning, held-out accuracy, odd rows."""
import random
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from claimflow.llm import catalog, language_id, quality, toxicity
from claimflow.llm.common import held_out
from claimflow.llm.labelled import labelled_sample
from rows import awkward, empty

SF01 = "/root/testdata/sf0.01"


def test_held_out_rows_follow_the_checksum(spark):
    rows = spark.createDataFrame([(i,) for i in range(50)] + [(None,)], "doc_id long").withColumn("h", held_out("doc_id", 5, 0)).collect()
    assert all(r.h == (r.doc_id is None or zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)


def test_sample_is_bounded_and_skips_what_is_no_example(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)] + [(600, None), (None, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(500)] + [(600, 1), (None, 1), (3, None), (4, 7), (9999, 1)], "doc_id long, toxic int")
    texts, sizes = labelled_sample(docs, labels, "toxic", ~held_out("doc_id", 5, 0), per_class=40)
    n = Counter(y for _, y in texts)
    assert 15 < n[0] <= 40 and 15 < n[1] <= 40 and abs(sizes[0] - 200) < 40
    assert all(int(t.split()[1]) % 2 == y and zlib.crc32(t.split()[1].encode()) % 5 for t, y in texts)
    assert labelled_sample(docs, labels.where("doc_id < 0"), "toxic", F.lit(True)) == ([], {})


def test_fold_sees_through_disguises():
    table = toxicity.fold_table()
    for text in ("IDIOT", "1d10t", "іԁіот", "ｉｄｉｏｔ", "id​iot", "idiοt", "\U0001d422\U0001d41d\U0001d422\U0001d428\U0001d42d"):
        assert toxicity.fold(f"you, {text}!", table) == " you idiot ", text
    assert toxicity.fold("", table) == " " and toxicity.fold("été\ud800", table).startswith(" été")


def test_fold_of_invisible_high_and_joined_characters():
    table = toxicity.fold_table()
    for text in ("id\U000E0101iot", "id\U000E0069\U000E007Fiot", "id\U000E01EFiot", "\u2170diot", "idi\u1d52t", "\u0130diot"):
        assert toxicity.fold(f"you, {text}!", table) == " you idiot ", text
    assert toxicity.fold("o\ufb01cer \ufb04y \u2171 \u338f", table) == " oficer ffly ii kg "
    assert toxicity.fold("\U00020001\U0002f800 \U000F0000x\U0010FFFFy", table) == " \U00020001\u4e3d x y "



def test_hits_respect_words_prefixes_and_exceptions():
    lexicon = toxicity.Lexicon({"trash": 2.0, "clown": 1.0}, {"stup": 1.5}, ["trash can", "clown fish"])
    a, table = lexicon.automaton(), toxicity.fold_table()
    def found(t):
        f = toxicity.fold(t, table)
        return [(f[x + 1:y].strip(), w) for x, y, w in toxicity.hits(f, a)]
    assert found("Trash! trashy tr4sh stupid astupid clown") == [("trash", 2.0), ("trash", 2.0), ("stup", 1.5), ("clown", 1.0)]
    assert found("the trash can and a clown fish, trash clown") == [("trash", 2.0), ("clown", 1.0)]
    assert toxicity.density(toxicity.fold("trash " + "word " * 99, table), a) == pytest.approx(2.0)
    assert found("") == []


def test_learned_exceptions():
    def name(i):
        return "".join("klmnopqrst"[int(d)] for d in f"{i:03d}")
    examples = [(f"take the trash can out {name(i)} now", 0) for i in range(30)] + [(f"you are trash {name(i)} really", 1) for i in range(30)]
    examples += [(f"plain words {name(i)} here", 0) for i in range(300)]
    lexicon = toxicity.learn(examples, {0: 330, 1: 30})
    assert "trash" in lexicon.words and {"trash can", "the trash"} & set(lexicon.exceptions)
    a, table = lexicon.automaton(), toxicity.fold_table()
    assert toxicity.density(toxicity.fold("a trash can", table), a) == 0 < toxicity.density(toxicity.fold("such trash", table), a)


@pytest.mark.parametrize("learned", [[], [("only", 1)], [("only", 0)]])
def test_scores_without_both_classes(spark, learned):
    df, rows = awkward(spark, 5)
    sizes = {y: 1 for _, y in learned}
    for scored in (toxicity.score(df, toxicity.learn(learned, sizes)), quality.score(df, quality.train(learned, sizes))):
        out = scored.collect()
        assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows) and all(0 <= r.score <= 1 for r in out)
    assert toxicity.score(empty(spark), toxicity.Lexicon()).count() == 0
    assert quality.score(empty(spark), quality.train([], {})).count() == 0


def accuracy(spark, name, label, n, rest):
    out = catalog.QUERIES[name](spark, SF01).select("doc_id", "held_out", "score", "predicted").collect()
    assert len(out) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % n == rest) and r.predicted == (r.score >= 0.5) for r in out)
    want = {r.doc_id: r[label] for r in spark.read.parquet(f"{SF01}/labels.parquet").collect()}
    held = [(want[r.doc_id], r.predicted) for r in out if r.held_out and r.doc_id in want]
    return sum(a == b for a, b in held) / len(held)


def test_toxicity_of_held_out_documents(spark):
    assert accuracy(spark, "op1_toxicity", "toxic", 5, 0) >= 0.93


def test_quality_of_held_out_documents(spark):
    assert accuracy(spark, "op9_quality", "quality", 3, 1) >= 0.95


def test_quality_scores_are_sparse_dot_products():
    texts = ["Some words, some WORDS 12!! x", "", "one", "a a a a b"]
    weights = np.random.default_rng(1).normal(size=(1 << quality.BITS) + 1)
    for t in texts:
        found, row, size = quality.features(pa.array([t], pa.large_string()))
        slots, count = np.unique(found[found >= 0], return_counts=True)
        alone = quality.SCALE * (weights[slots] @ count) / max(size[0], 1) + weights[-1]
        many, rows_, sizes = quality.features(pa.array(texts, pa.large_string()))
        i = texts.index(t)
        total = np.append(weights[:-1], 0.0)[many].sum(axis=0)[rows_ == i].sum()
        assert quality.SCALE * total / max(sizes[i], 1) + weights[-1] == pytest.approx(alone)


def test_language_of_held_out_documents(spark):
    out = catalog.op6_language_id(spark, SF01).collect()
    want = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF01}/documents.parquet").collect()}
    held = [want[r.doc_id] == r.lang_pred for r in out if r.held_out]
    assert len(out) == 1000 and sum(held) / len(held) >= 0.97 and all(0 <= r.score <= 1 for r in out)


@pytest.fixture(scope="module")
def net():
    rng = np.random.default_rng(3)
    net = language_id.Network(["aa", "bb"])
    windows = np.concatenate([rng.choice(list(b"abcd "), (60, 16)), rng.choice(list(b"wxyz "), (60, 16))]).astype(np.uint8)
    net.train(windows, np.repeat([0, 1], 60), steps=60, batch=32)
    return net


def test_gradients_match_differences():
    """Backpropagation through time against finite differences."""
    rng = np.random.default_rng(4)
    side = language_id.Direction(rng, 4, 3)
    side.p = {k: v.astype(np.float64) for k, v in side.p.items()}
    x, target = rng.integers(0, 5, (6, 3)), rng.normal(size=(6, 3, 3))
    side.forward(x)
    grads = side.backward(target)
    for name, at in (("E", (0, 2, 1)), ("E", (1, 3, 0)), ("E", (2, 1, 3)), ("U", (0, 1, 2)), ("U", (1, 0, 3)), ("U", (2, 2, 2)), ("W", (1, 2))):
        old, step = side.p[name][at], 1e-5
        side.p[name][at] = old + step
        up = (side.forward(x) * target).sum()
        side.p[name][at] = old - step
        down = (side.forward(x) * target).sum()
        side.p[name][at] = old
        assert grads[name][at] == pytest.approx((up - down) / (2 * step), rel=2e-3, abs=1e-5)


def test_every_byte_counts_once(net):
    texts = ["ab", "a" * 127, "abcd" * 32, "abcd" * 33, "wxyz " * 200, "a" * 500 + "w" * 501, ""]
    buf, at = language_id.flat(pa.array(texts))
    p = net.documents(buf, at)
    assert np.allclose(p[:-1].sum(axis=1), 1, atol=1e-4) and not p[-1].any()
    alone = np.concatenate([net.documents(*language_id.flat(pa.array([t]))) for t in texts])
    assert np.allclose(p, alone, atol=1e-5)
    assert p[4].argmax() == 1 and p[2].argmax() == 0 and 0.3 < p[5, 0] < 0.7


def test_language_of_odd_rows(spark, net):
    df, rows = awkward(spark, 5)
    out = language_id.predict(df, net).collect()
    assert Counter(r.doc_id for r in out) == Counter(r[0] for r in rows)
    for r in out:
        if r.doc_id in (100, 101, 102, 103):
            assert (r.lang_pred, r.score) == ("und", 0.0)
        elif r.doc_id is not None:
            assert r.lang_pred in ("aa", "bb") and 0 < r.score <= 1
    kept = language_id.known_language_documents(df, net, least=0.0)
    assert kept.columns == df.columns and kept.where("doc_id in (100, 101, 102, 103)").count() == 0
    assert {r.lang_pred for r in language_id.predict(df, language_id.Network([])).collect()} == {"und"}
    assert language_id.predict(empty(spark), net).count() == 0
    assert language_id.fit(empty(spark)).labels == []
    assert language_id.fit(spark.createDataFrame([(1, "abc", "xx"), (2, None, "yy"), (3, "q", None)], "doc_id long, text string, lang string")).labels == ["xx"]


def test_leader_updates_equal_a_plain_loop():
    import math
    rng = random.Random(17)
    model = quality.FollowTheLeader(bits=6)
    z, n = [0.0] * 65, [0.0] * 65

    def weight(i):
        if abs(z[i]) <= quality.L1:
            return 0.0
        return -(z[i] - math.copysign(quality.L1, z[i])) / ((quality.BETA + math.sqrt(n[i])) / quality.ALPHA + quality.L2)
    for _ in range(300):
        slots = sorted(rng.sample(range(65), rng.randint(1, 9)))
        values, y, importance = [rng.uniform(0, 2) for _ in slots], rng.randint(0, 1), rng.uniform(0.2, 3)
        model.update(np.array(slots), np.array(values), y, importance)
        w = [weight(i) for i in slots]
        p = 1 / (1 + math.exp(-sum(a * b for a, b in zip(w, values))))
        for i, v, old in zip(slots, values, w):
            g = importance * (p - y) * v
            z[i] += g - (math.sqrt(n[i] + g * g) - math.sqrt(n[i])) / quality.ALPHA * old
            n[i] += g * g
    assert np.allclose(model.weights(), [weight(i) for i in range(65)], atol=1e-9) and np.count_nonzero(model.weights()) > 20


def test_samples_are_bounded_in_bytes(spark):
    docs = spark.createDataFrame([(i, ("long " * 2000 if i % 10 == 0 else "short") + str(i)) for i in range(200)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(200)], "doc_id long, y int")
    every, sizes = labelled_sample(docs, labels, "y", F.lit(True))
    few, same = labelled_sample(docs, labels, "y", F.lit(True), most_bytes=30_000)
    assert sizes == same == {0: 100, 1: 100} and len(every) == 200
    assert sum(len(t) for t, _ in few) <= 30_000 and 100 < len(few) < 190 and set(few) < set(every)
    assert few == labelled_sample(docs.repartition(7), labels, "y", F.lit(True), most_bytes=30_000)[0]


def test_network_equals_a_plain_loop():
    import math
    net = language_id.Network(["a", "b", "c"], hidden=3, seed=5)
    net.bias += np.array([0.1, -0.2, 0.05], np.float32)

    def soft(x):
        return x / (1 + abs(x))

    def states(side, window):
        e, u = side.p["E"].tolist(), side.p["U"].tolist()
        h, out = [0.0] * 3, []
        for byte in window:
            def gate(i, scale):
                return [soft(e[i][byte][k] + scale[k] * sum(h[j] * u[i][j][k] for j in range(3))) for k in range(3)]
            z, r = gate(0, [1] * 3), gate(1, [1] * 3)
            n = gate(2, [0.5 + 0.5 * x for x in r])
            h = [n[k] + (0.5 + 0.5 * z[k]) * (h[k] - n[k]) for k in range(3)]
            out.append([sum(h[k] * float(side.p["W"][k][c]) for k in range(3)) for c in range(3)])
        return out

    def document(text):
        total, w = [0.0] * 3, language_id.WINDOW
        for k in range(-(-len(text) // w)):
            start = min(k * w, max(len(text) - w, 0))
            window = text[start:start + w].ljust(w)
            scores = zip(states(net.sides[0], window), reversed(states(net.sides[1], window[::-1])))
            for at, (x, y) in enumerate(scores):
                if k * w <= start + at < len(text):
                    p = [math.exp(x[c] + y[c] + float(net.bias[c])) for c in range(3)]
                    total = [t + v / sum(p) for t, v in zip(total, p)]
        return [t / max(len(text), 1) for t in total]
    rng = random.Random(19)
    texts = [bytes(rng.randrange(256) for _ in range(n)) for n in (0, 1, 40, 128, 129, 300)]
    at = np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    got = net.documents(np.frombuffer(b"".join(texts), np.uint8), at)
    assert np.allclose(got, [document(t) for t in texts], atol=1e-4)
