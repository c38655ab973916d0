"""Phrase index against plain substring search."""
import random

from pyspark.sql import functions as F

from claimflow.operators import phrases as P
from claimflow.operators.labeling import label_dataset, score_rules
from claimflow.sources.rules import RuleSet

WORDS = ["climate", "hoax", "a", "of", "miracle", "cure", "no", "study", "peer", "reviewed", "été", "x", "fake\nnews", "scam", "\U0001f600", "re-view"]


def random_phrase(rng):
    words = [rng.choice(WORDS) for _ in range(rng.randint(1, 4))]
    words[0] = words[0][rng.randrange(len(words[0])):]
    words[-1] = words[-1][:rng.randint(1, len(words[-1]))]
    return rng.choice([" ", " ", "  "]).join(words)


def test_every_phrase_is_filed_under_a_key_that_its_texts_show():
    rng = random.Random(1)
    for _ in range(2000):
        phrase = random_phrase(rng)
        text = rng.choice(["", "xx", "y "]) + phrase + rng.choice(["", "zz", " q"])
        keys = P.filing_keys(phrase)
        assert set(keys["word"]) <= set(text.split(" "))
        assert all(k in text and len(k) == 7 for k in keys["joint"]) and all(k in text and " " not in k for k in keys["gram"])


def test_index_finds_what_a_plain_search_finds(spark):
    rng = random.Random(2)
    phrases = list(dict.fromkeys(random_phrase(rng) for _ in range(1500))) + ["", "no", "no"]
    texts = ["  ".join(random_phrase(rng) for _ in range(rng.randint(0, 6))) for _ in range(120)] + [None, "", " ", "hoax" * 5000]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    got = {r.k: r.hits for r in df.withColumn("hits", P.phrase_hits(F.col("text"), phrases)).collect()}
    for k, t in enumerate(texts):
        assert got[k] == (None if t is None else [p for p in phrases if p in t]), t
    small = {r.k: r.hits for r in df.withColumn("hits", P.phrase_hits(F.col("text"), phrases[:20])).collect()}
    assert small[0] == [p for p in phrases[:20] if p in texts[0]]


def test_labels_with_long_lists_equal_labels_phrase_by_phrase(spark, monkeypatch):
    rng = random.Random(3)
    def rules(niche, n):
        return RuleSet.from_mapping({"niche": niche, "positive_label": "p", "negative_label": "n", "positive_domains": ["a.org"], "negative_domains": [],
                                     "positive_phrases": [random_phrase(rng) for _ in range(n)], "negative_phrases": [random_phrase(rng) for _ in range(n // 2)]})
    sets = [rules("one", 400), rules("two", 10)]
    rows = [(i, " ".join(random_phrase(rng) for _ in range(5)).title(), "www.a.org" if i % 3 else "b.net", rng.choice(["one", "two", "other"]),
             rng.choice(["positive", "negative", "unknown"])) for i in range(150)] + [(999, None, None, "one", None)]
    df = spark.createDataFrame(rows, "id long, text string, source string, niche string, domain_type string")
    got = label_dataset(df, sets, "id", "2024-01-01")
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan and "EvalPython" not in plan
    got = sorted(map(str, got.collect()))
    assert "positive_phrases" not in score_rules(df, sets).columns
    monkeypatch.setattr("claimflow.operators.labeling.PLAIN_LIST", 10 ** 9)
    assert got == sorted(map(str, label_dataset(df, sets, "id", "2024-01-01").collect()))


def test_tree_and_keys_find_the_same_and_the_tree_reads_a_text_once(spark, monkeypatch):
    rng = random.Random(4)
    phrases = list(dict.fromkeys(random_phrase(rng) for _ in range(600))) + ["", "no", "no", "nono", "a.b", "a+", "$", "x\\y"]
    texts = ["  ".join(random_phrase(rng) for _ in range(rng.randint(0, 6))) for _ in range(60)] + [None, "", "nonono", "axb a.b a+ aa $x\\y", "no" * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "k long, text string")
    tree = df.withColumn("hits", P.phrase_hits(F.col("text"), phrases))
    assert "contains" not in tree._jdf.queryExecution().optimizedPlan().toString().lower()
    tree = sorted(map(str, tree.collect()))
    monkeypatch.setattr(P, "TREE_BYTES", 0)
    assert tree == sorted(map(str, df.withColumn("hits", P.phrase_hits(F.col("text"), phrases)).collect()))


def test_tree_pattern_gives_the_longest_phrase_at_each_place():
    import re
    phrases = ["an", "and", "and the", "a", "the", "é", "th.", "b"]
    text = "band theé and th. an"
    longest = [max((p for p in phrases if text.startswith(p, i)), key=len, default=None) for i in range(len(text))]
    pattern = re.sub(r"\\x\{([0-9a-f]+)\}", lambda m: re.escape(chr(int(m[1], 16))), P.tree_pattern(phrases))
    assert [m.group(1) for m in re.finditer(f"(?=({pattern}))", text)] == [p for p in longest if p is not None]
    assert P.leading_places(["a", "an", "and", "an", "", "b"]) == {"a": [0], "an": [0, 1, 3], "and": [0, 1, 3, 2], "b": [5]}
