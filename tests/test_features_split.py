"""F1-F8 and M1-M3."""
import math

import pytest
from pyspark.sql import functions as F

from claimflow.operators.features import add_terms, decode_labels, encode_labels, fit_tfidf, most_frequent
from claimflow.operators.split import stratified_split, given_split


def test_tfidf_small_matches_hand_computation(spark):
    docs = spark.createDataFrame([(1, "apple banana apple"), (2, "banana cherry"), (3, "apple cherry date"),
                                  (4, "zebra")], "doc_id long, text_processed string")
    d = add_terms(docs)
    m = fit_tfidf(d, min_df=1, max_df=1.0, max_features=50)
    assert m.n_docs == 4 and m.size <= 50
    vocab = {r.term: r for r in m.vocab.collect()}
    assert [r.term for r in m.feature_names().collect()] == sorted(vocab)
    w = {(r.doc_id, r.term): r.weight for r in m.transform(d).collect()}
    idf = lambda df: math.log((1 + 4) / (1 + df)) + 1
    a = (1 + math.log(2)) * idf(2); b = idf(2); ab = idf(1); ba = idf(1)
    norm = math.sqrt(a * a + b * b + ab * ab + ba * ba)
    assert abs(w[(1, "apple")] - a / norm) < 1e-12
    for doc in (1, 2, 3, 4):
        assert abs(sum(v * v for (k, _), v in w.items() if k == doc) - 1.0) < 1e-9


def test_unseen_terms_give_zero_vector(spark):
    train = add_terms(spark.createDataFrame([(1, "alpha beta"), (2, "alpha gamma")], "doc_id long, text_processed string"))
    m = fit_tfidf(train, min_df=1, max_df=1.0, max_features=10)
    other = add_terms(spark.createDataFrame([(9, "unknown words")], "doc_id long, text_processed string"))
    v = m.vectors(other).first().features
    assert v.size == m.size and v.numNonzeros() == 0


def test_label_round_trip(spark):
    df = spark.createDataFrame([("real",), ("fake",), ("real",)], "label string")
    enc, classes = encode_labels(df)
    assert classes == ["fake", "real"]
    dec = decode_labels(enc, classes, "label_idx", "back")
    assert all(r.label == r.back for r in dec.collect())


def test_split_exact_shares_disjoint_and_equal_to_plain_window(spark):
    from pyspark.sql import Window
    ids = spark.range(0, 700).select(F.col("id").alias("k"), (F.col("id") % 7 == 0).cast("int").alias("label"))
    s = stratified_split(ids, "label", key="k", seed=42, hex_digits=2)
    rows = s.collect()
    assert len(rows) == 700 and len({r.k for r in rows}) == 700
    by = {}
    for r in rows:
        by.setdefault((r.label, r.split), 0)
        by[(r.label, r.split)] += 1
    assert by[(0, "train")] == 420 and by[(0, "validation")] == 90 and by[(0, "test")] == 90
    assert by[(1, "train")] == 70 and by[(1, "validation")] == 15 and by[(1, "test")] == 15
    plain = ids.withColumn("r", F.row_number().over(
        Window.partitionBy("label").orderBy(F.md5(F.concat_ws(":", F.col("k").cast("string"), F.lit("42"))), "k")))
    a = {r.k: r.rank for r in rows}
    assert all(a[r.k] == r.r for r in plain.collect())


def test_split_sizes_reference_counts(spark):
    one = spark.range(0, 110).select(F.col("id").alias("k"), F.lit(0).alias("label"))
    got = {r.split: r["count"] for r in stratified_split(one, "label", "k").groupBy("split").count().collect()}
    assert got == {"train": 77, "validation": 16, "test": 17}


def test_split_same_for_one_and_many_partitions(spark):
    ids = spark.range(0, 500).select(F.col("id").alias("k"), (F.col("id") % 3).alias("label"))
    a = {r.k: r.split for r in stratified_split(ids.coalesce(1), "label", "k").collect()}
    b = {r.k: r.split for r in stratified_split(ids.repartition(13), "label", "k").collect()}
    assert a == b


def test_given_split(spark):
    df = spark.createDataFrame([("train",), ("valid",), ("test",)], "split string")
    assert [r.split for r in given_split(df).collect()] == ["train", "validation", "test"]


def test_tfidf_same_for_one_and_many_partitions(spark):
    from conftest import SF001
    from claimflow.plans.catalog import _preprocessed
    pre = add_terms(_preprocessed(spark, SF001))
    m = fit_tfidf(pre, min_df=2, max_features=500)
    a = {(r.doc_id, r.term): round(r.weight, 12) for r in m.transform(pre.coalesce(1)).collect()}
    b = {(r.doc_id, r.term): round(r.weight, 12) for r in m.transform(pre.repartition(13)).collect()}
    assert a == b and len(a) > 1000


class Dummy:
    """A model stand-in for plan checks."""
    def transform(self, df):
        return df.withColumn("prediction", F.when(F.col("features").isNotNull(), 0.0)).withColumn(
            "probability", F.lit(None).cast("string"))


def test_scoring_and_weights_move_no_rows(spark):
    from conftest import SF001
    from claimflow.operators.score import Scorer, score
    from claimflow.plans.catalog import _preprocessed
    pre = add_terms(_preprocessed(spark, SF001))
    m = fit_tfidf(pre, min_df=2, max_features=500)
    docs = spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "text")
    out = score(docs, Scorer(m, Dummy(), ["a", "b"], has_probability=False))
    p = out._jdf.queryExecution().executedPlan().toString()
    long_form = m.transform(add_terms(docs.withColumnRenamed("text", "text_processed")))._jdf.queryExecution().executedPlan().toString()
    for plan in (p, long_form):
        assert not any(x in plan for x in ("Exchange", "Join", "InMemoryTableScan", "EvalPython", "InArrow", "InPandas"))


def test_fold_vocabularies_equal_a_fit_on_the_other_folds(spark):
    from conftest import SF001
    from claimflow.operators.features import fit_fold_models, term_stats
    from claimflow.plans.catalog import _preprocessed
    docs = add_terms(_preprocessed(spark, SF001)).select((F.col("doc_id") % 4).cast("int").alias("fold"), "doc_id", "terms").cache()
    for limit in (300, None):
        whole, folds = fit_fold_models(docs, "fold", 4, min_df=2, max_df=0.5, max_features=limit)
        alone = [fit_tfidf(d, min_df=2, max_df=0.5, max_features=limit) for d in (docs, *(docs.where(F.col("fold") != k) for k in range(4)))]
        for a, b in zip([whole, *folds], alone):
            assert (a.n_docs, a.terms, a.idf) == (b.n_docs, b.terms, b.idf) and a.size > 200
            assert sorted(a.vocab.collect()) == sorted(b.vocab.collect())
    plan = term_stats(docs, "terms", "fold", 4)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("InMemoryRelation") == 1 and plan.split("InMemoryRelation")[0].count("Generate") == 1


def test_weights_equal_plain_arithmetic_and_survive_the_vector_form(spark):
    import random
    rng = random.Random(4)
    rows = [(i, [rng.choice(["a", "b", "c d", "é", "zz"]) for _ in range(rng.randint(0, 9))]) for i in range(40)] + [(99, None), (None, ["a", "a"])]
    docs = spark.createDataFrame(rows, "doc_id long, terms array<string>")
    m = fit_tfidf(docs, min_df=2, max_df=1.0)
    assert m.n_docs == len(rows)
    for r, (key, terms) in zip(m.vectors(docs).collect(), rows):
        raw = {i: (1 + math.log(terms.count(t))) * m.idf[i] for i, t in enumerate(m.terms) if t in (terms or ())}
        norm = math.sqrt(sum(w * w for w in raw.values()))
        assert r.doc_id == key and list(r.features.indices) == sorted(raw)
        assert all(abs(x - raw[i] / norm) < 1e-12 for i, x in zip(r.features.indices, r.features.values))
    with_bias = m.vectors(docs, bias=True).first().features
    assert with_bias.size == m.size + 1 and with_bias[m.size] == 1.0
    long_form = {(r.doc_id, r.term): (r.tf, r.weight) for r in m.transform(docs).where("doc_id = 3").collect()}
    assert {t: n for (_, t), (n, _) in long_form.items()} == {t: rows[3][1].count(t) for t in rows[3][1] if t in m.terms}
    none = fit_tfidf(docs.where("false"))
    assert none.size == 0 and none.n_docs == 0 and none.vectors(docs).first().features.numNonzeros() == 0


def test_repeated_and_null_keys_are_vectorised_alone(spark):
    train = add_terms(spark.createDataFrame([(1, "apple banana"), (2, "cherry date")], "doc_id long, text_processed string"))
    m = fit_tfidf(train, min_df=1, max_df=1.0)
    rows = add_terms(spark.createDataFrame([(1, "apple banana"), (1, "cherry date"), (None, "apple")], "doc_id long, text_processed string"))
    got = m.vectors(rows).collect()
    names = [m.terms[i] for i in got[0].features.indices], [m.terms[i] for i in got[1].features.indices]
    assert names == (["apple", "apple banana", "banana"], ["cherry", "cherry date", "date"])
    assert [m.terms[i] for i in got[2].features.indices] == ["apple"]


def test_most_frequent_cuts_ties_by_term(spark):
    import random
    rng = random.Random(5)
    rows = [(f"t{i:04d}", 1, int(1.3 ** rng.randint(0, 30)) + 1) for i in range(2000)]
    df = spark.createDataFrame(rows, "term string, df long, cf long").repartition(7)
    for n in (1, 10, 333, 1999, 2000, 5000):
        want = sorted(rows, key=lambda r: (-r[2], r[0]))[:n]
        assert sorted(r.term for r in most_frequent(df, n).collect()) == sorted(r[0] for r in want), n


def test_int_labels_and_unlisted_ones(spark):
    df = spark.createDataFrame([(1,), (0,), (None,), (10,)], "label int")
    enc, classes = encode_labels(df)
    assert classes == [0, 1, 10] and [r.label_idx for r in enc.collect()] == [1.0, 0.0, None, 2.0]
    assert encode_labels(df, classes=[0, 1])[0].collect()[3].label_idx is None


def test_split_keeps_null_strata_and_many_buckets(spark):
    ids = spark.range(0, 200).select(F.col("id").alias("k"), F.when(F.col("id") % 5 != 0, F.col("id") % 2).alias("label"))
    for digits in (None, 1, 3):
        rows = stratified_split(ids, "label", "k", hex_digits=digits).collect()
        assert len(rows) == 200 and sum(r.label is None and r.split == "train" for r in rows) == 28


def test_stop_list_reaches_training_terms(spark):
    from claimflow.plans.train import TrainConfig
    d = spark.createDataFrame([(1, "alpha beta alpha")], "doc_id long, text_processed string")
    cfg = TrainConfig(stop_words=("beta",))
    assert add_terms(d, stop_words=cfg.stop_words).first().terms == ["alpha", "alpha", "alpha alpha"]


def test_unbounded_vocabulary_index_is_alphabetical(spark):
    from conftest import SF001
    from claimflow.plans.catalog import _preprocessed
    pre = add_terms(_preprocessed(spark, SF001))
    m = fit_tfidf(pre, min_df=2, max_features=None)
    rows = m.vocab.select("term", "idx").collect()
    terms = sorted(r.term for r in rows)
    assert sorted((r.idx, r.term) for r in rows) == list(enumerate(terms))


def test_vectorizer_defaults_and_unfitted_error(spark):
    from claimflow.operators.features import TfidfVectorizer
    v = TfidfVectorizer()
    assert v.ngram_range == (1, 2) and v.min_df == 3 and v.max_features == 10_000 and not v.is_fitted
    df = spark.createDataFrame([(1, "apple banana"), (2, "banana cherry"), (3, "apple cherry"), (4, "date")],
                               "doc_id long, text_processed string")
    with pytest.raises(ValueError, match="must be fitted"):
        v.transform(df)
    w = TfidfVectorizer(max_features=50, min_df=1, max_df=1.0).fit_transform(df)
    assert w.select("doc_id").distinct().count() == 4


def test_vocabulary_from_hash_bounds_equals_that_of_all_counts(spark):
    import random

    from claimflow.operators.features import fit_fold_models, frequent_stats, model_of_stats, term_stats
    rng = random.Random(5)
    # "often" fills few rows many times, so that the first cutoff proves nothing.
    rows = [(i % 3 if i % 7 else None, [f"t{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.randint(0, 40))]
             + ([f"often{j}" for j in range(60)] * 30 if i == 0 else [])) for i in range(120)] + [(1, None)]
    docs = spark.createDataFrame(rows, "fold int, terms array<string>")
    whole = term_stats(docs, "terms", "fold", 3, 2)
    for n in (1, 10, 25, 10_000):
        few = frequent_stats(docs, "terms", "fold", 3, 2, 0.9, n)
        assert few.count() < whole.count() or n >= 25    # then all are counted
        want = [model_of_stats(whole, 2, 0.9, n, k) for k in (None, 0, 1, 2)]
        got = fit_fold_models(docs, "fold", 3, min_df=2, max_df=0.9, max_features=n)
        for a, b in zip(want, [got[0], *got[1]]):
            assert (a.terms, a.idf, a.n_docs) == (b.terms, b.idf, b.n_docs)
            assert sorted(map(tuple, a.vocab.collect())) == sorted(map(tuple, b.vocab.collect()))
