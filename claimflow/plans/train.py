"""Training (M4-M10) as Spark ML jobs over the long-form features.

``train_classifier`` runs one niche (or the unified set) end to end:
gate -> preprocess -> split -> TF-IDF fit on train -> vectors -> logistic
regression and linear SVM with balanced class weights -> accuracy on
train/validation -> leak-free k-fold CV macro F1 -> best model by CV mean.

Objective mapping (C-form, C=1, to Spark): Spark minimises
``(1/sum w) * sum w_i loss_i + regParam/2 ||beta||^2``; multiplying the
C-form objective by ``1/(C sum w)`` gives ``regParam = 1/(C sum w)``.
Balanced weights sum to the row count, so ``regParam = 1/(C n)``.
Spark's LinearSVC uses the hinge loss (the original used squared hinge),
a documented deviation.
"""

from __future__ import annotations

import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.ml import PipelineModel
from pyspark.ml.classification import LinearSVC, LogisticRegression
from pyspark.ml.feature import ElementwiseProduct, Normalizer, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions.stopwords import ENGLISH_STOP_WORDS
from claimflow.functions.text import clean_text, evaluate_once, join_tokens, tokenize
from claimflow.operators.aggregates import fold_score_stats
from claimflow.operators.features import (
    TfidfModel, add_terms, encode_labels, fit_fold_models, fit_tfidf, label_classes, term_frequencies, write_vectors,
)
from claimflow.operators.split import TRAIN, VALIDATION, stratified_split
from claimflow.session import discard_checkpoint, ensure_checkpoint_dir, write_stage

MODEL_ORDER = ("logistic_regression", "linear_svm")  # ties go to the first
ROWS_PER_PARTITION = 2_000  # of the vectors that a solver reads again and again
MOST_ROWS = 50_000          # in one partition of many
ROWS_AT_ONCE = 100_000      # larger folds are fitted one after the other


@dataclass
class TrainConfig:
    min_df: int = 2
    max_df: float = 0.95
    max_features: int | None = 10_000
    C: float = 1.0
    max_iter: int = 1000
    tol: float = 1e-4  # the original solvers' stopping tolerance
    n_folds: int = 5
    parallel_folds: int = 5  # folds fitted side by side; fewer need less memory
    seed: int = 42
    refit_vocab_per_fold: bool = True
    penalize_intercept: bool = False
    stop_words: tuple = ENGLISH_STOP_WORDS  # F1's list (``load_stop_list`` reads another)


@dataclass
class TrainResult:
    classes: list
    vectorizer: TfidfModel
    models: dict
    best: str
    metrics: DataFrame          # one row per model
    fold_scores: DataFrame      # one row per (model, fold)
    data: DataFrame             # split rows with terms (a written table)
    extra: dict = field(default_factory=dict)


def preprocess(df: DataFrame, text_col: str = "text") -> DataFrame:
    """T4: cleaned text, tokens, joined tokens; rows without tokens dropped."""
    x = evaluate_once(df, text_clean=clean_text(text_col))
    x = evaluate_once(x, tokens=tokenize("text_clean"))
    return x.withColumn("text_processed", join_tokens("tokens")).where(F.size("tokens") > 0)


def with_zero_row(train_v: DataFrame, size: int) -> DataFrame:
    """Penalised intercept: one all-zero row of weight 1 keeps the constant
    feature from being treated as constant (Spark zeroes such columns); its
    loss does not depend on the coefficients, so the optimum is unchanged."""
    from pyspark.ml.linalg import SparseVector
    spark = train_v.sparkSession
    zero = spark.createDataFrame([(SparseVector(size + 1, [], []), 0.0, 1.0)],
                                 train_v.select("features", "label_idx", "weight").schema)
    return train_v.select("features", "label_idx", "weight").unionByName(zero)


def solver_layout(n_rows: int) -> tuple[int, int]:
    """Partitions and aggregation depth of a fit on ``n_rows`` rows: 1 partition
    or 7 * 4^k. Each level of Spark's tree aggregation then merges four partial
    sums, 28, 7, 1 and so on, so that one gradient an evaluation reaches the
    driver, however many partitions there are."""
    if n_rows < 7 * ROWS_PER_PARTITION:
        return 1, 2
    parts, depth = 28, 3
    while n_rows > parts * MOST_ROWS:
        parts, depth = 4 * parts, depth + 1
    return parts, depth


def _models(cfg: TrainConfig, n_train: int) -> dict:
    # With a penalised intercept the bias is a feature and one zero row of
    # weight 1 joins the data, so the weight sum is n + 1.
    lr_n = n_train + 1 if cfg.penalize_intercept else n_train
    depth = solver_layout(n_train)[1]
    lr = LogisticRegression(featuresCol="features", labelCol="label_idx", weightCol="weight",
                            regParam=1.0 / (cfg.C * lr_n), elasticNetParam=0.0,
                            standardization=False, maxIter=cfg.max_iter, tol=cfg.tol,
                            fitIntercept=not cfg.penalize_intercept, aggregationDepth=depth)
    svm = LinearSVC(featuresCol="features", labelCol="label_idx", weightCol="weight",
                    regParam=1.0 / (cfg.C * n_train), standardization=False,
                    maxIter=cfg.max_iter, tol=cfg.tol, fitIntercept=True, aggregationDepth=depth)
    return {"logistic_regression": lr, "linear_svm": svm}


def macro_f1(pred: DataFrame) -> float:
    """Mean F1 over the classes seen, from one aggregation (classes squared
    rows at most reach the driver)."""
    n = {(r[0], r[1]): r[2] for r in pred.groupBy("label_idx", "prediction").count().collect()}
    f1 = []
    for c in {x for pair in n for x in pair}:
        hit = n.get((c, c), 0)
        both = sum(v for (a, p), v in n.items() if a == c) + sum(v for (a, p), v in n.items() if p == c)
        f1.append(2 * hit / both if both else 0.0)
    return float(sum(f1) / len(f1)) if f1 else 0.0


def _accuracy(pred: DataFrame) -> float:
    return float(pred.agg(F.avg((F.col("prediction") == F.col("label_idx")).cast("double"))).first()[0] or 0.0)


def train_classifier(df: DataFrame, key: str, label_col: str = "label", text_col: str = "text",
                     strata=None, cfg: TrainConfig | None = None, classes: list | None = None) -> TrainResult:
    """Train both models on ``df`` (key, text, label[, strata])."""
    cfg = cfg or TrainConfig()
    spark: SparkSession = df.sparkSession
    strata = strata or [label_col]
    timings, t0 = {}, time.time()
    extra = [c for c in strata if c != label_col]
    # The cleaned text is written once and moved once, by the split's window.
    # The split rows with their terms are written too: the many fit and
    # cross-validation jobs then plan a short scan, and a lost executor does
    # not recompute the cleaning. Everything after is map-only or counts.
    pre = write_stage(preprocess(df, text_col).select(key, label_col, *extra, "text_processed"), "cleaned")
    x = stratified_split(pre, strata, key=key, seed=cfg.seed, n_folds=cfg.n_folds)
    x = add_terms(x, "text_processed", "terms", cfg.stop_words)
    x = write_stage(x.select(key, label_col, *extra, "split", "fold", "terms"), "train-rows")
    x, classes = encode_labels(x, label_col, "label_idx", classes or label_classes(x, label_col))
    timings["prepare"] = round(time.time() - t0, 3)

    train = x.where((F.col("split") == TRAIN) & F.col("label_idx").isNotNull())
    options = dict(doc_col=key, min_df=cfg.min_df, max_df=cfg.max_df, max_features=cfg.max_features, stop_words=cfg.stop_words)
    if cfg.refit_vocab_per_fold:
        vec, fold_vecs = fit_fold_models(train, "fold", cfg.n_folds, **options)
    else:
        vec = fit_tfidf(train, **options)
        fold_vecs = [vec] * cfg.n_folds
    # Rows per class and fold: the class weights of all fits.
    sizes = {(r["label_idx"], r["fold"]): r["count"] for r in train.groupBy("label_idx", "fold").count().collect()}
    n_train = sum(sizes.values())
    weighed = vec.weighed(x.where(F.col("split").isin(TRAIN, VALIDATION)).withColumn("weight", class_weight(sizes)))
    vectors = write_vectors(weighed, vec.size, F.col("_tf.indices"), F.col("_weights"), ["split", "label_idx", "weight"], "vectors")
    if cfg.penalize_intercept:
        one = VectorAssembler(inputCols=["features", "one"], outputCol="with_one")
        biased = one.transform(vectors.withColumn("one", F.lit(1.0))).select("split", "label_idx", "weight", F.col("with_one").alias("features"))
    train_v = for_solver(vectors.where(F.col("split") == TRAIN), n_train)
    val_v = vectors.where(F.col("split") == VALIDATION)
    timings["vocabulary_and_weights"] = round(time.time() - t0 - timings["prepare"], 3)

    def fit_main(item):
        name, est = item
        if name == "logistic_regression" and cfg.penalize_intercept:
            mine = biased.where(F.col("split") == TRAIN)
            model = est.fit(with_zero_row(mine, vec.size))
            return name, model, _accuracy(model.transform(mine)), _accuracy(model.transform(biased.where(F.col("split") == VALIDATION)))
        model = est.fit(train_v)
        return name, model, _accuracy(model.transform(train_v)), _accuracy(model.transform(val_v))

    # The two final fits and the CV folds are independent jobs; the scheduler
    # runs what is submitted from threads side by side. Fits that fill the cluster
    # alone go one data set after the other, so that only one is held in memory.
    # The rows of the main fits stay, as the models' summaries read them.
    t1 = time.time()
    with ThreadPoolExecutor(max_workers=2) as pool:
        main = pool.map(fit_main, list(_models(cfg, n_train).items()))
        if n_train > ROWS_AT_ONCE:
            main = list(main)
        folds = cross_validate(train, fold_vecs, sizes, cfg)
        timings["cross_validation"] = round(time.time() - t1, 3)
        main = list(main)
    timings["fits_total"] = round(time.time() - t1, 3)
    fitted = {name: model for name, model, _, _ in main}
    rows = [(name, tr, va) for name, _, tr, va in main]
    stats = fold_score_stats(folds, by=("model",), score_col="f1")
    acc = spark.createDataFrame(rows, "model string, train_accuracy double, val_accuracy double")
    order = spark.createDataFrame([(m, i) for i, m in enumerate(MODEL_ORDER)], "model string, model_order int")
    metrics = acc.join(stats, "model").join(order, "model")
    best = select_best(metrics)
    timings["total"] = round(time.time() - t0, 3)
    return TrainResult(classes, vec, fitted, best, metrics, folds, x, {"timings": timings})


def class_weight(sizes: dict, without_fold: int | None = None) -> Column:
    """A3 for ``label_idx`` from the rows per (class, fold), all or without one
    fold's: a constant per class."""
    per_class: dict = {}
    for (label, fold), n in sizes.items():
        if fold != without_fold:
            per_class[label] = per_class.get(label, 0) + n
    n, weight = sum(per_class.values()), F.lit(None).cast("double")
    for label, n_c in per_class.items():
        weight = F.when(F.col("label_idx") == label, F.lit(n / (len(per_class) * n_c))).otherwise(weight)
    return weight


def for_solver(vectors: DataFrame, n_rows: int) -> DataFrame:
    """The rows of a fit, in the partitions of ``solver_layout``. They are kept in the
    shared folder: the solvers hold their own blocks of them in memory. A checkpoint
    also ends the lineage, whose counters every task of every evaluation would
    report to the driver (3.3 kB a task, 1.7 kB without)."""
    ensure_checkpoint_dir(vectors.sparkSession)
    rows, parts = vectors.select("features", "label_idx", "weight"), solver_layout(n_rows)[0]
    return (rows.coalesce(1) if parts == 1 else rows.repartition(parts)).checkpoint()


def cross_validate(train: DataFrame, fold_vecs: list[TfidfModel], sizes: dict, cfg: TrainConfig) -> DataFrame:
    """M7: per fold, both models on the other folds' rows under their own
    vocabulary and class weights, and macro F1 on the held-out fold.

    One written table holds every row's ``1 + ln(tf)`` over all folds' terms; a
    fold's vectors are its idf (0 for terms outside its vocabulary, whose
    coefficients then stay 0) times that, normalised."""
    spark = train.sparkSession
    terms = sorted(set().union(*(v.terms for v in fold_vecs)), key=str.encode)
    counted = term_frequencies(train, "terms", terms)
    raw = write_vectors(counted, max(len(terms), 1), F.col("_tf.indices"), F.transform("_tf.values", lambda n: 1.0 + F.log(n)),
                        ["label_idx", "fold"], "fold-vectors", "raw")

    def one_fold(k):
        idf = dict(zip(fold_vecs[k].terms, fold_vecs[k].idf))
        steps = [ElementwiseProduct(scalingVec=Vectors.dense([idf.get(t, 0.0) for t in terms] or [0.0]), inputCol="raw", outputCol="scaled"),
                 Normalizer(p=2.0, inputCol="scaled", outputCol="features")]
        vectors = PipelineModel(steps).transform(raw.withColumn("weight", class_weight(sizes, k)))
        n = sum(v for (_, fold), v in sizes.items() if fold != k)
        fit_v, held = for_solver(vectors.where(F.col("fold") != k), n), vectors.where(F.col("fold") == k)

        def one_model(item):
            name, est = item
            if name == "logistic_regression" and cfg.penalize_intercept:
                one = VectorAssembler(inputCols=["features", "one"], outputCol="with_one")
                def biased(df):
                    return one.transform(df.withColumn("one", F.lit(1.0))).select("label_idx", "weight", F.col("with_one").alias("features"))
                return name, k, macro_f1(est.fit(with_zero_row(biased(fit_v), max(len(terms), 1))).transform(biased(held)))
            return name, k, macro_f1(est.fit(fit_v).transform(held))

        with ThreadPoolExecutor(max_workers=2) as inner:  # the two models side by side
            out = list(inner.map(one_model, _models(cfg, n).items()))
        discard_checkpoint(fit_v)
        return out

    at_once = 1 if sum(sizes.values()) > ROWS_AT_ONCE else max(1, cfg.parallel_folds)
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        rows = [r for fold_rows in pool.map(one_fold, range(cfg.n_folds)) for r in fold_rows]
    return spark.createDataFrame(rows, "model string, fold int, f1 double")


def stored_vectors(features: DataFrame, labels: DataFrame, size: int, key: str = "doc_id") -> DataFrame:
    """S8 -> M4: long-form features (key, idx, weight) assembled to vectors, one
    row per row of ``labels`` (key and more columns; a row without known terms
    gets zeros). A row's features are gathered, never more."""
    entries = F.array_sort(F.collect_list(F.struct(F.col("idx").cast("int").alias("idx"), "weight")))
    rows = labels.join(features.groupBy(key).agg(entries.alias("_e")), key, "left")
    none_i, none_w = F.array().cast("array<int>"), F.array().cast("array<double>")
    return write_vectors(rows, size, F.coalesce(F.col("_e.idx"), none_i), F.coalesce(F.col("_e.weight"), none_w), labels.columns, "stored-vectors")


def train_stored(features: DataFrame, labels: DataFrame, size: int, key: str = "doc_id", label_col: str = "label_idx",
                 cfg: TrainConfig | None = None) -> dict:
    """M4/M5 from stored features: ``features`` as ``read_features`` gives them
    (with ``split``, the folder's partition column, so that each part is read
    alone), ``labels`` (key, label code). Returns both models and their accuracy
    on the train and the validation part."""
    cfg, out = cfg or TrainConfig(), {}
    parts = {}
    for split in (TRAIN, VALIDATION):
        mine = features.where(F.col("split") == split).drop("split")
        keys = labels.select(key, F.col(label_col).alias("label_idx")).join(mine.select(key).distinct(), key, "left_semi")
        parts[split] = stored_vectors(mine, keys, size, key)
    sizes = {(r["label_idx"], None): r["count"] for r in parts[TRAIN].groupBy("label_idx").count().collect()}
    n = sum(sizes.values())
    train_v = for_solver(parts[TRAIN].withColumn("weight", class_weight(sizes, -1)), n)
    for name, est in _models(cfg, n).items():
        model = est.fit(train_v)
        out[name] = (model, _accuracy(model.transform(train_v)), _accuracy(model.transform(parts[VALIDATION])))
    return out


def best_models(metrics: DataFrame, by=("niche",)) -> DataFrame:
    """M8 per group: the model of highest CV mean; equal means go to the one
    of lower ``model_order``."""
    best = F.min(F.struct((-F.col("cv_mean")).alias("n"), "model_order", "model", "cv_mean"))
    return metrics.groupBy(*by).agg(best.alias("b")).select(*by, "b.model", "b.cv_mean")


def select_best(metrics: DataFrame) -> str:
    """M8: highest CV mean; equal means go to logistic regression."""
    return best_models(metrics, ()).first()["model"]


def coefficients(result: TrainResult, model: str = "logistic_regression") -> DataFrame:
    """Coefficients with their terms: (term, idx, coef). A fitted model holds
    them on the driver."""
    coefs = result.models[model].coefficients.toArray().tolist()
    rows = [(t, i, coefs[i]) for i, t in enumerate(result.vectorizer.terms)]
    return result.vectorizer.vocab.sparkSession.createDataFrame(rows, "term string, idx int, coef double")


def train_unified(labeled_by_niche: dict, rules, key: str = "id", cfg: TrainConfig | None = None,
                  warn=print) -> TrainResult:
    """One model over several niches. Niche tables are concatenated
    (missing ones skipped with a warning), labels mapped to 1/0 through each
    niche's rules (others dropped), and the split stratified by
    (label, niche)."""
    from claimflow.functions.text import drop_nulls
    from claimflow.operators.labeling import niche_label_to_binary
    from claimflow.sources.io import union_niches
    df = union_niches(labeled_by_niche, warn=warn)
    df = drop_nulls(niche_label_to_binary(df, rules), "text")
    return train_classifier(df.select(key, "text", "label_binary", "niche"), key,
                            label_col="label_binary", strata=["label_binary", "niche"], cfg=cfg,
                            classes=[0, 1])


def train_niche(labeled: DataFrame, rule_set, key: str = "id", cfg: TrainConfig | None = None,
                enforce_min_samples: bool = True) -> TrainResult:
    """M9: one niche end to end. The minimum-sample gate (L8) stops training
    when a class is short; rows labeled ``unlabeled`` (or anything but the
    two configured labels) are dropped before training (Q4)."""
    from claimflow.operators.labeling import min_sample_gate, require_min_samples
    rs = rule_set
    x = labeled.where(F.col("niche") == rs.niche) if "niche" in labeled.columns else \
        labeled.withColumn("niche", F.lit(rs.niche))
    x = x.withColumns({"positive_label": F.lit(rs.positive_label), "negative_label": F.lit(rs.negative_label)})
    if enforce_min_samples:
        require_min_samples(min_sample_gate(x, [rs]))
    x = x.where(F.col("label").isin(rs.positive_label, rs.negative_label))
    return train_classifier(x.select(key, "text", "label"), key, cfg=cfg,
                            classes=sorted([rs.positive_label, rs.negative_label]))
