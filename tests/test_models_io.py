"""M4-M8, C1-C5, S1-S8 on small inputs."""
import json
import os

import pytest
from pyspark.sql import functions as F

from claimflow.operators.score import Scorer, score, with_class_columns, require_column
from claimflow.plans.train import TrainConfig, train_classifier, select_best
from claimflow.sources import io

TEXTS = [
    ("The climate hoax is a scam pushed by fake science activists", "claim"),
    ("Another hoax about cities underwater, total scam and fake science", "claim"),
    ("Global warming hoax exposed again as a scam by fake science", "claim"),
    ("They say the weather manipulation hoax is a scam of fake science", "claim"),
    ("Peer reviewed study measures radiative forcing and temperature rise", "scientific"),
    ("The methodology of the climate model study shows greenhouse gas effects", "scientific"),
    ("Carbon emissions study reports temperature rise with confidence interval", "scientific"),
    ("Greenhouse gas measurements in a peer reviewed climate model study", "scientific"),
] * 3


@pytest.fixture(scope="module")
def trained(spark):
    df = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(TEXTS)], "k long, text string, label string")
    return train_classifier(df, "k", cfg=TrainConfig(min_df=1, n_folds=2, max_features=200))


def test_both_models_trained_one_chosen(trained):
    assert set(trained.models) == {"logistic_regression", "linear_svm"}
    assert trained.best in trained.models and trained.classes == ["claim", "scientific"]
    m = {r.model: r for r in trained.metrics.collect()}
    assert m["logistic_regression"].train_accuracy == 1.0
    assert trained.fold_scores.count() == 4


def test_select_best_prefers_logistic_on_ties(spark):
    df = spark.createDataFrame([("linear_svm", 1.0, 1), ("logistic_regression", 1.0, 0)],
                               "model string, cv_mean double, model_order int")
    assert select_best(df) == "logistic_regression"


def test_score_keeps_rows_and_marks_empty(spark, trained):
    sc = Scorer(trained.vectorizer, trained.models["logistic_regression"], trained.classes)
    df = spark.createDataFrame([(1, "a new hoax and scam"), (2, "!!! ###"), (3, None),
                                (4, "peer reviewed study of greenhouse gas")], "k long, text string")
    out = {r.k: r for r in with_class_columns(score(df, sc, "k"), sc.classes).collect()}
    assert len(out) == 4
    assert out[1].prediction == "claim" and 0.5 < out[1].confidence <= 1.0
    assert out[4].prediction == "scientific"
    assert out[2].prediction == "Unknown" and out[2].confidence == 0.0 and out[2].prob_claim == 0.5
    assert out[3].error is not None
    with pytest.raises(ValueError):
        require_column(df, "body")


def test_svm_scores_have_no_probabilities(spark, trained):
    sc = Scorer(trained.vectorizer, trained.models["linear_svm"], trained.classes, has_probability=False)
    df = spark.createDataFrame([(1, "hoax scam")], "k long, text string")
    r = score(df, sc, "k").first()
    assert r.confidence == 0.0 and r.probabilities is None and r.prediction in trained.classes


def test_stream_equals_batch(spark, trained, tmp_dir):
    from claimflow.streaming.score_stream import score_stream_once
    sc = Scorer(trained.vectorizer, trained.models["logistic_regression"], trained.classes)
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS)], "k long, text string")
    df.repartition(3).write.parquet(f"{tmp_dir}/src")
    cached = spark.sparkContext._jsc.getPersistentRDDs().size()
    streamed = score_stream_once(spark, f"{tmp_dir}/src", df.schema, sc, "k", f"{tmp_dir}/sink", f"{tmp_dir}/ck")
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == cached
    batch = score(df, sc, "k")
    a = sorted((r.k, r.prediction, round(r.confidence, 9)) for r in streamed.collect())
    b = sorted((r.k, r.prediction, round(r.confidence, 9)) for r in batch.collect())
    assert a == b


def test_repeated_and_null_keys_are_scored_alone(spark, trained):
    sc = Scorer(trained.vectorizer, trained.models["logistic_regression"], trained.classes)
    rows = [(1, TEXTS[0][0]), (1, TEXTS[-1][0]), (None, TEXTS[0][0]), (2, TEXTS[-1][0])]
    out = score(spark.createDataFrame(rows, "k long, text string"), sc).collect()
    by_text = {}
    for r in out:
        by_text.setdefault(r.text, set()).add((r.prediction, round(r.confidence, 12)))
    assert len(out) == 4 and len(by_text) == 2 and all(len(v) == 1 for v in by_text.values())


def test_model_round_trip(spark, trained, tmp_dir):
    table = io.save_models(trained, f"{tmp_dir}/m", "climate_claims")
    assert table.where("is_best").count() == 1
    vec = io.load_vectorizer(spark, f"{tmp_dir}/m/vectorizer")
    assert vec.size == trained.vectorizer.size and vec.n_docs == trained.vectorizer.n_docs
    lr = io.load_model(f"{tmp_dir}/m/logistic_regression", "logistic_regression")
    assert list(lr.coefficients) == list(trained.models["logistic_regression"].coefficients)


def test_native_scores_equal_the_models_own(spark, trained):
    from pyspark.ml.functions import vector_to_array

    from claimflow.functions.text import clean_text, join_tokens, tokenize
    from claimflow.operators.features import add_terms
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(TEXTS[:8])] + [(90, "no known words")], "k long, text string")
    rows = add_terms(df.withColumn("p", join_tokens(tokenize(clean_text("text")))), "p", "terms", trained.vectorizer.stop_words)
    for name in trained.models:
        has = name == "logistic_regression"
        own = trained.models[name].transform(trained.vectorizer.vectors(rows))
        own = own.withColumn("top", F.array_max(vector_to_array("probability")) if has else F.lit(0.0)).collect()
        got = {r.k: r for r in score(df, Scorer(trained.vectorizer, trained.models[name], trained.classes, has_probability=has)).collect()}
        for r in own:
            assert got[r.k].prediction == trained.classes[int(r.prediction)] and got[r.k].confidence == pytest.approx(r.top, abs=1e-12)


def test_many_niches_in_one_pass_equal_each_model_alone(spark, trained):
    from claimflow.operators.features import add_terms, fit_tfidf
    from claimflow.operators.score import LinearModel, score_by_niche
    other = fit_tfidf(add_terms(spark.createDataFrame([(1, "hoax scam study"), (2, "study climate")], "doc_id long, text_processed string")), min_df=1, max_df=1.0)
    scorers = {"a": Scorer(trained.vectorizer, trained.models["logistic_regression"], trained.classes),
               "b": Scorer(other, LinearModel([((7 * i) % 5 - 2) / 2 for i in range(other.size)], 0.25), ["legit", "scam"]),
               "c": Scorer(trained.vectorizer, trained.models["linear_svm"], trained.classes, has_probability=False)}
    rows = [(i, t, "abcd"[i % 4]) for i, (t, _) in enumerate(TEXTS)] + [(90, "???", "a"), (91, None, "b"), (92, "hoax", None)]
    df = spark.createDataFrame(rows, "k long, text string, niche string")
    out = score_by_niche(df, scorers)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Exchange", "Join", "EvalPython"))
    got = {r.k: r for r in out.collect()}
    assert len(got) == len(rows)
    for n, s in scorers.items():
        for r in score(df.where(F.col("niche") == n), s).collect():
            assert (got[r.k].prediction, got[r.k].error) == (r.prediction, r.error) and got[r.k].confidence == pytest.approx(r.confidence, abs=1e-12)
    assert got[3].prediction == "Unknown" and got[3].error.endswith("niche d") and got[92].error.endswith("niche null")
    with pytest.raises(ValueError):
        score_by_niche(df.drop("niche"), scorers)


def test_score_a_file_end_to_end(spark, trained, tmp_dir):
    from pyspark.sql import types as T

    from claimflow.operators.score import score_file
    sc = Scorer(trained.vectorizer, trained.models["logistic_regression"], trained.classes)
    rows = [(str(i), t, 'say "hi",\nthen') for i, (t, _) in enumerate(TEXTS)] + [("90", None, None), ("91", "!!!", "")]
    df = spark.createDataFrame(rows, "id string, body string, note string")
    io.write_csv(df, f"{tmp_dir}/in")
    summary = {r.prediction: r.n for r in score_file(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", sc, text_col="body").collect()}
    assert summary == {"claim": 12, "scientific": 12, "Unknown": 2}
    names = ["id", "body", "note", "prediction", "confidence", "error", "prob_claim", "prob_scientific"]
    back = io.read_csv(spark, f"{tmp_dir}/out", T.StructType([T.StructField(n, T.StringType()) for n in names]))
    got = {r.id: r for r in back.collect()}
    assert len(got) == 26 and got["0"].note == rows[0][2] and float(got["0"].prob_claim) > 0.5 and got["91"].prediction == "Unknown"
    df.write.parquet(f"{tmp_dir}/in.parquet")
    again = score_file(spark, f"{tmp_dir}/in.parquet", f"{tmp_dir}/out2", sc, text_col="body", sink_format="parquet")
    assert {r.prediction: r.n for r in again.collect()} == summary
    with pytest.raises(ValueError, match="body"):
        score_file(spark, f"{tmp_dir}/in", f"{tmp_dir}/out3", sc, text_col="words")


def test_training_from_stored_features_equals_training_in_memory(spark, trained, tmp_dir):
    from claimflow.plans.train import train_stored
    w = trained.vectorizer.transform(trained.data.select("k", "split", "terms"), "k")
    io.write_features(w.select("k", "split", "idx", "weight"), f"{tmp_dir}/features")
    back = io.read_features(spark, f"{tmp_dir}/features")
    assert "PartitionFilters: [isnotnull(split" in back.where("split = 'train'")._jdf.queryExecution().executedPlan().toString()
    got = train_stored(back, trained.data.select("k", "label_idx"), trained.vectorizer.size, "k", cfg=TrainConfig())
    want = {r.model: r for r in trained.metrics.collect()}
    for name, (model, train_accuracy, val_accuracy) in got.items():
        assert max(abs(model.coefficients.toArray() - trained.models[name].coefficients.toArray())) < 1e-6
        assert abs(model.intercept - trained.models[name].intercept) < 1e-6
        assert (train_accuracy, val_accuracy) == (want[name].train_accuracy, want[name].val_accuracy)


def test_estimator_survives_a_pipeline_round_trip(spark, tmp_dir):
    from pyspark.ml import Pipeline, PipelineModel
    from pyspark.ml.classification import LogisticRegression

    from claimflow.operators.features import add_terms, fit_tfidf
    from claimflow.operators.tfidf_ml import TfidfEstimator
    df = spark.createDataFrame([(i, t.lower(), float(l == "claim")) for i, (t, l) in enumerate(TEXTS)] + [(90, None, 0.0)], "doc_id long, words string, label double")
    stages = [TfidfEstimator(inputCol="words", outputCol="features", minDF=2, vocabSize=40, stopWords=["the", "of"]), LogisticRegression(maxIter=5)]
    Pipeline(stages=stages).save(f"{tmp_dir}/pipeline")
    fitted = Pipeline.load(f"{tmp_dir}/pipeline").fit(df)
    fitted.save(f"{tmp_dir}/model")
    back = PipelineModel.load(f"{tmp_dir}/model")
    a, b = ([(r.doc_id, r.features, r.probability) for r in m.transform(df).orderBy("doc_id").collect()] for m in (fitted, back))
    assert a == b and a[0][1].numNonzeros() > 0 and a[-1][1].numNonzeros() == 0
    plain = fit_tfidf(add_terms(df, "words", "terms", ("the", "of")), min_df=2, max_features=40, stop_words=("the", "of"))
    assert [r.features for r in plain.vectors(add_terms(df, "words", "terms", ("the", "of"))).orderBy("doc_id").collect()] == [x[1] for x in a]


def test_csv_round_trip_multiline_quotes(spark, tmp_dir):
    from pyspark.sql import types as T
    rows = [(1, 'He said "hi"\nthen left,  ok '), (2, ""), (3, None), (4, "  lead")]
    df = spark.createDataFrame(rows, "id long, text string")
    io.write_csv(df, f"{tmp_dir}/c")
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("text", T.StringType())])
    back = {r.id: r.text for r in io.read_csv(spark, f"{tmp_dir}/c", schema).collect()}
    assert back[1] == rows[0][1] and back[4] == "  lead" and back[3] is None


def test_statement_files(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/statements")
    line = "\t".join(["1.json", "false", "A claim", "tax", "someone", "", "", "", "1", "2", "3", "4", "5", "rally"])
    for split in ("train", "test"):
        with open(f"{tmp_dir}/statements/{split}.tsv", "w") as fh:
            fh.write(line + "\n")
    df = io.read_statements(spark, f"{tmp_dir}/statements")
    assert sorted(r.split for r in df.collect()) == ["test", "train"] and df.first().false_count == 2.0
    with pytest.raises(FileNotFoundError):
        io.read_statements(spark, f"{tmp_dir}/none")


def test_collect_results(spark, tmp_dir):
    io.write_summary_json(spark, f"{tmp_dir}/s", "a", {"scam": 3, "legit": 2}, 0.9, 0.8, {}, "scam", "legit")
    io.write_summary_json(spark, f"{tmp_dir}/s", "b", {"legit": 4, "scam": 1}, 1.0, 1.0, {}, "scam", "legit")
    res = {r.niche: r for r in io.collect_results(spark, f"{tmp_dir}/s/*/*.txt").collect()}
    assert res["a"].positive == 3 and res["b"].positive == 1 and res["TOTAL"].total == 10
    assert io.markdown_rows(io.collect_results(spark, f"{tmp_dir}/s/*/*.txt")).count() == 3


def test_union_niches(spark):
    a = spark.createDataFrame([(1, "x")], "id long, niche string")
    warned = []
    assert io.union_niches({"x": a, "y": None}, warn=warned.append).count() == 1 and warned
    with pytest.raises(ValueError):
        io.union_niches({"y": None})


def test_unified_training_two_niches(spark):
    from claimflow.plans.train import train_unified
    from claimflow.sources.rules import RuleSet
    r1 = RuleSet.from_mapping({"niche": "a", "positive_label": "claim", "negative_label": "scientific"})
    r2 = RuleSet.from_mapping({"niche": "b", "positive_label": "scam", "negative_label": "legit"})
    rows_a = [(f"a_{i}", t, l, "a") for i, (t, l) in enumerate(TEXTS)]
    rows_b = [(f"b_{i}", t, "scam" if l == "claim" else "legit", "b") for i, (t, l) in enumerate(TEXTS)]
    schema = "id string, text string, label string, niche string"
    frames = {"a": spark.createDataFrame(rows_a, schema), "b": spark.createDataFrame(rows_b, schema), "c": None}
    warned = []
    res = train_unified(frames, [r1, r2], cfg=TrainConfig(min_df=1, n_folds=2, max_features=200), warn=warned.append)
    assert res.classes == [0, 1] and warned
    counts = {(r.niche, r.split): r["count"] for r in res.data.groupBy("niche", "split").count().collect()}
    assert counts[("a", "train")] == counts[("b", "train")]


def test_metrics_and_features_tables(spark, trained, tmp_dir):
    io.append_metrics(trained.metrics, f"{tmp_dir}/metrics", "n1", "2024-01-01 00:00:00", trained.best)
    io.append_metrics(trained.metrics, f"{tmp_dir}/metrics", "n1", "2024-01-02 00:00:00", trained.best)
    m = spark.read.parquet(f"{tmp_dir}/metrics")
    assert m.count() == 4 and m.where("is_best").count() == 2
    before = sorted(map(str, m.collect()))
    io.append_metrics(trained.metrics, f"{tmp_dir}/metrics", "n1", "2024-01-02 00:00:00", trained.best)
    io.append_metrics(trained.metrics, f"{tmp_dir}/metrics", "n2", "2024-01-02 00:00:00", trained.best)
    again = spark.read.parquet(f"{tmp_dir}/metrics")
    assert sorted(map(str, again.where("niche = 'n1'").collect())) == before and again.count() == 6
    w = trained.vectorizer.transform(trained.data.select("k", "terms"), "k").join(trained.data.select("k", "split"), "k")
    io.write_features(w, f"{tmp_dir}/features")
    back = spark.read.parquet(f"{tmp_dir}/features")
    assert back.where("split = 'train'").count() == w.where("split = 'train'").count()


def test_pick_model(spark):
    from claimflow.operators.score import pick_model
    t = spark.createDataFrame([("a", "/m/a")], "niche string, path string")
    assert pick_model(t, "a") == "/m/a"
    with pytest.raises(FileNotFoundError):
        pick_model(t, "zz")


def test_drop_nulls(spark):
    from claimflow.functions.text import drop_nulls
    df = spark.createDataFrame([(1, "x"), (2, None)], "k int, text string")
    assert [r.k for r in drop_nulls(df, "text").collect()] == [1]


def test_penalized_intercept_matches_newton(spark):
    """The constant-feature + zero-row construction equals the penalised-intercept
    optimum of 0.5*||[w,b]||^2 + sum_i w_i * logloss_i, computed by Newton's method."""
    import numpy as np
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.linalg import SparseVector
    from claimflow.plans.train import with_zero_row
    rng = np.random.default_rng(0)
    X = rng.normal(size=(200, 4))
    y = (X @ np.array([1.0, -2.0, 0.5, 0.0]) + 0.7 + rng.normal(size=200) > 0).astype(float)
    n, k = len(y), 2
    wts = np.where(y == 1, n / (k * y.sum()), n / (k * (n - y.sum())))
    Xb = np.hstack([X, np.ones((n, 1))])
    beta = np.zeros(5)
    for _ in range(50):
        p = 1 / (1 + np.exp(-Xb @ beta))
        g = beta + Xb.T @ (wts * (p - y))
        H = np.eye(5) + (Xb * (wts * p * (1 - p))[:, None]).T @ Xb
        beta -= np.linalg.solve(H, g)
    rows = [(SparseVector(5, list(range(5)), list(Xb[i])), float(y[i]), float(wts[i])) for i in range(n)]
    df = spark.createDataFrame(rows, ["features", "label_idx", "weight"])
    data = with_zero_row(df, 4)
    m = LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight",
                           regParam=1.0 / (n + 1), standardization=False, fitIntercept=False,
                           maxIter=1000, tol=1e-10).fit(data)
    assert np.max(np.abs(m.coefficients.toArray() - beta)) < 1e-4


def test_train_with_penalized_intercept(spark):
    df = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(TEXTS)], "k long, text string, label string")
    r = train_classifier(df, "k", cfg=TrainConfig(min_df=1, n_folds=2, max_features=200, penalize_intercept=True))
    lr = r.models["logistic_regression"]
    assert lr.numFeatures == r.vectorizer.size + 1 and lr.intercept == 0.0
    sc = Scorer(r.vectorizer, lr, r.classes, bias=True)
    out = score(spark.createDataFrame([(1, "hoax scam fake science")], "k long, text string"), sc, "k").first()
    assert out.prediction == "claim"


def test_evaluate_and_collect_summary(spark, trained, tmp_dir):
    from claimflow.plans.evaluate_niche import evaluate_niche, write_niche_summary
    labeled = spark.createDataFrame([(i, t, l) for i, (t, l) in enumerate(TEXTS)], "k long, text string, label string")
    tables = evaluate_niche(trained, "k", model="logistic_regression")
    n_test = trained.data.where("split = 'test'").count()
    assert tables["predictions"].count() == n_test and "roc_auc" in tables
    write_niche_summary(tables, labeled, f"{tmp_dir}/s", "climate_claims", "claim", "scientific")
    res = {r.niche: r for r in io.collect_results(spark, f"{tmp_dir}/s/*/*.txt").collect()}
    assert res["climate_claims"].positive == 12 and res["climate_claims"].negative == 12
    assert 0.0 <= res["climate_claims"].macro_f1 <= 1.0


def test_train_niche_drops_unlabeled_and_gates(spark):
    from claimflow.plans.train import train_niche
    from claimflow.sources.rules import RuleSet
    rs = RuleSet.from_mapping({"niche": "climate_claims", "positive_label": "claim", "negative_label": "scientific",
                               "min_samples_per_class": 5})
    rows = [(f"c_{i}", t, l) for i, (t, l) in enumerate(TEXTS)] + [(f"u_{i}", "random words here", "unlabeled")
                                                                   for i in range(6)]
    df = spark.createDataFrame(rows, "id string, text string, label string")
    res = train_niche(df, rs, cfg=TrainConfig(min_df=1, n_folds=2, max_features=200))
    assert res.classes == ["claim", "scientific"]
    assert res.data.where("label = 'unlabeled'").count() == 0
    strict = RuleSet.from_mapping({**rs.__dict__, "positive_phrases": [], "min_samples_per_class": 1000})
    with pytest.raises(ValueError):
        train_niche(df, strict)


def test_write_table_parquet_and_csv(spark, tmp_dir):
    df = spark.createDataFrame([("a", 1, "x\ny"), ("b", 2, 'say "hi"')], "niche string, n int, text string")
    io.write_table(df, f"{tmp_dir}/p")
    assert {"niche=a", "niche=b"} <= set(os.listdir(f"{tmp_dir}/p"))
    back = spark.read.parquet(f"{tmp_dir}/p").where("niche = 'b'").first()
    assert back.text == 'say "hi"'
    io.write_table(df, f"{tmp_dir}/c", partition_by=(), fmt="csv")
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("niche", T.StringType()), T.StructField("n", T.IntegerType()),
                           T.StructField("text", T.StringType())])
    assert sorted(r.text for r in io.read_csv(spark, f"{tmp_dir}/c", schema).collect()) == sorted(["x\ny", 'say "hi"'])


def test_collect_results_reads_pretty_json_with_rule_labels(spark, tmp_dir):
    from claimflow.sources.rules import load_rule_set
    os.makedirs(f"{tmp_dir}/artifacts/hustle_scams/reports")
    doc = {"niche": "hustle_scams", "samples_per_class": {"legit": 340, "scam": 360},
           "test_macro_f1": 0.9, "test_accuracy": 0.95, "per_class": {}}
    with open(f"{tmp_dir}/artifacts/hustle_scams/reports/summary.json", "w") as fh:
        json.dump(doc, fh, indent=2)
    res = {r.niche: r for r in io.collect_results(spark, f"{tmp_dir}/artifacts/*/reports/summary.json",
                                                  rules=[load_rule_set("hustle_scams")]).collect()}
    assert res["hustle_scams"].positive == 360 and res["hustle_scams"].negative == 340
    assert res["TOTAL"].total == 700


def test_one_gradient_an_evaluation_reaches_the_driver(spark):
    import math
    import random

    from pyspark.ml.classification import LinearSVC
    from pyspark.ml.linalg import Vectors

    from claimflow.plans.train import for_solver, solver_layout
    for n in (1, 14_000, 100_000, 2_000_000, 10_000_000, 300_000_000):
        parts, depth = solver_layout(n)
        left, scale = parts, max(math.ceil(parts ** (1 / depth)), 2)
        while left > scale + math.ceil(left / scale):   # as RDD.treeAggregate does
            left //= scale
        assert left == 1 and n <= parts * 50_000
    rng = random.Random(1)
    rows = [(Vectors.dense([rng.random(), rng.random()]), float(i % 2), 1.0) for i in range(300)]
    v = for_solver(spark.createDataFrame(rows, ["features", "label_idx", "weight"]), 20_000)
    assert v.rdd.getNumPartitions() == 28 and v.count() == 300
    group = "one-gradient"
    spark.sparkContext.setJobGroup(group, group)
    LinearSVC(labelCol="label_idx", weightCol="weight", maxIter=3, aggregationDepth=solver_layout(20_000)[1]).fit(v)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    last = [tracker.getStageInfo(max(tracker.getJobInfo(j).stageIds)) for j in tracker.getJobIdsForGroup(group)]
    assert sum(s.numTasks == 1 for s in last if s) >= 3


def test_evaluations_carry_no_lineage_of_the_fit_rows(spark):
    from pathlib import Path

    from pyspark.ml.linalg import Vectors

    from claimflow.plans.train import for_solver
    from claimflow.session import discard_checkpoint
    rows = [(Vectors.dense([float(i)]), float(i % 2), 1.0) for i in range(300)]
    for n, parts in ((300, 1), (20_000, 28)):
        v = for_solver(spark.createDataFrame(rows, ["features", "label_idx", "weight"]), n)
        lineage = v._jdf.queryExecution().toRdd().toDebugString()
        assert "ReliableCheckpointRDD" in lineage and "ShuffledRowRDD" not in lineage and "PythonRDD" not in lineage
        assert v.rdd.getNumPartitions() == parts and sorted(r.features[0] for r in v.collect()) == [float(i) for i in range(300)]
        files = Path(v._jdf.queryExecution().logical().rdd().getCheckpointFile().get().removeprefix("file:"))
        assert files.is_dir()
        discard_checkpoint(v)
        assert not files.exists()
