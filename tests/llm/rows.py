"""Tables with the awkward cases every operator must take."""
import random

from pyspark.sql import functions as F

WORDS = ["the", "of", "river", "stone", "walks", "under", "old", "bridge", "Night", "falls", "quietly", "on", "seven", "hills"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) + str(rng.randrange(40)) for _ in range(n))


def awkward(spark, n=40, seed=1):
    """Nulls in every column, empty, blank and very long texts, copies, repeated
    rows, and columns named like the operators' own."""
    rng = random.Random(seed)
    rows = [(i, prose(rng, rng.randint(1, 120)), rng.choice(["en", "fr"]), rng.choice(["a", "b", "c"]), 5) for i in range(n)]
    rows += [(100, None, None, None, None), (101, "", "en", "a", 0), (102, " \t\n ", "en", "b", 3), (None, prose(rng, 60), "en", "a", 1),
             (None, None, None, "a", None), (103, "!!! 42 ...", "fr", None, 10), (104, rows[3][1], "en", "a", 1), (105, rows[3][1], "fr", "c", 1),
             rows[2], rows[2], (2, rows[4][1], "en", "a", 1), (106, "one", "en", "a", 3), (107, "one", "en", "b", 3), (108, "\u00e9t\u00e9 \u4f60\u597d \U0001f600", "fr", "a", 9),
             (109, prose(rng, 60_000), "en", "a", 1), (110, "x" * 300_000, "en", "b", 300_000), (111, "la " * 3000, "fr", "c", 9000)]
    df = spark.createDataFrame(rows, SCHEMA)
    extra = ["node", "component", "digest", "size", "start", "row", "text_hash", "band", "words", "k", "t", "label", "from", "window"]
    return df.withColumns({c: F.lit(c) for c in extra}), rows


def empty(spark):
    return spark.createDataFrame([], SCHEMA)
