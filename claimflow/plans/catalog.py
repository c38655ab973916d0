"""Registered queries: one per operator row of the blueprint.

Every query reads the given tables (or frames Spark derives from them)
in full; its DuckDB twin lives in ``claimflow.plans.oracle`` under the
same name and with the same output column names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.functions.text import clean_text, evaluate_once, join_tokens, tokenize
from claimflow.operators import labeling as L
from claimflow.operators import pages as P
from claimflow.plans import inputs as I
from claimflow.sources.tables import read_table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}


def query(name: str):
    def deco(fn):
        QUERIES[name] = fn
        return fn
    return deco


# ----------------------------- labeling (L) ---------------------------------

def _doc_labels(spark, sf_dir):
    return L.label_dataset(I.labeling_documents(spark, sf_dir), I.doc_rules(spark),
                           key="doc_id", date=I.LABEL_DATE)


def _page_labels(spark, sf_dir):
    return L.label_dataset(I.labeling_pages(spark, sf_dir), I.page_rules(spark),
                           key="page_id", date=I.LABEL_DATE)


@query("page_label_counts")
def page_label_counts(spark, sf_dir):
    """Flagship: pages -> text/title/source -> keep -> rules -> label -> counts."""
    return (_page_labels(spark, sf_dir).groupBy("label", "tie")
            .agg(F.count(F.lit(1)).alias("rows"),
                 F.count_if(F.col("pos_domain") & F.col("neg_domain")).alias("conflicts")))


@query("document_labels")
def document_labels(spark, sf_dir):
    """L1-L5 per document: label, evidence string, both scores."""
    return _doc_labels(spark, sf_dir).select(
        "id", "doc_id", "label", L.heuristics_string().alias("heuristics"),
        "positive_score", "negative_score")


@query("document_label_counts")
def document_label_counts(spark, sf_dir):
    return (_doc_labels(spark, sf_dir).groupBy("label", "tie")
            .agg(F.count(F.lit(1)).alias("rows")))


@query("labeling_stats")
def labeling_stats(spark, sf_dir):
    """L6 on documents and on pages, one row per niche."""
    return L.labeling_stats(_doc_labels(spark, sf_dir)).unionByName(
        L.labeling_stats(_page_labels(spark, sf_dir)))


@query("label_quality_report")
def label_quality_report(spark, sf_dir):
    """Counts, percentages to one decimal, heads of the rule lists."""
    stats = L.labeling_stats(_doc_labels(spark, sf_dir))
    return L.quality_report(stats, I.doc_rules(spark)).drop("positive_label", "negative_label")


@query("label_preview")
def label_preview(spark, sf_dir):
    """T5: first ten labeled rows by id, text cut to 100 characters."""
    return L.preview(_doc_labels(spark, sf_dir), key="id")


@query("min_sample_gate")
def min_sample_gate(spark, sf_dir):
    """L8 on both labeled tables."""
    return (L.min_sample_gate(_doc_labels(spark, sf_dir), I.doc_rules(spark))
            .unionByName(L.min_sample_gate(_page_labels(spark, sf_dir), I.page_rules(spark)))
            .drop("positive_label", "negative_label"))


@query("binary_labels")
def binary_labels(spark, sf_dir):
    """Niche labels to 1/0, unlabeled rows dropped."""
    x = L.niche_label_to_binary(_doc_labels(spark, sf_dir), I.doc_rules(spark))
    return x.select("id", "label", "label_binary")


# ----------------------------- text (T) -------------------------------------

@query("clean_text")
def clean_text_q(spark, sf_dir):
    """T1 over every document."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", clean_text("text").alias("text_clean"))


@query("preprocessed_documents")
def preprocessed_documents(spark, sf_dir):
    """Tokens joined, documents with no tokens dropped."""
    from claimflow.plans.train import preprocess
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return preprocess(d).select("doc_id", "text_processed", F.size("tokens").alias("n_tokens"))


# ----------------------------- pages (P) ------------------------------------

@query("page_text")
def page_text(spark, sf_dir):
    """P1-P4 for every page, kept and rejected."""
    return I.page_texts(spark, sf_dir).select("page_id", "title", "text", "source", "success", "error")


@query("article_urls")
def article_urls(spark, sf_dir):
    """Article links per domain, first ``max_per_source`` of the niche."""
    return P.find_article_urls(read_table(spark, sf_dir, "pages"), max_urls=I.page_rule_set().max_per_source)


@query("feed_entries")
def feed_entries(spark, sf_dir):
    """P7 over documents read as feed entries (feed = source, in doc_id
    order). Publication times follow from doc_id: a seventh have none, the
    others lie 0 to 729 days back, some on the cutoff to the second."""
    d = read_table(spark, sf_dir, "documents")
    as_of = "2024-06-01 00:00:00"
    age = F.when(F.col("doc_id") % 5 == 0, 365).otherwise((F.col("doc_id") * 37) % 730).cast("int")
    entries = d.select(F.col("source").alias("feed"), F.col("doc_id").alias("entry_pos"),
                       F.concat(F.lit("doc:"), F.col("doc_id").cast("string")).alias("link"),
                       F.when(F.col("doc_id") % 7 != 0, F.to_timestamp(F.lit(as_of)) - F.make_interval(days=age)).alias("published"),
                       F.col("text").alias("summary"))
    return P.recent_feed_entries(entries, as_of=as_of, max_articles=30)


@query("page_domain_tags")
def page_domain_tags(spark, sf_dir):
    """Pages tagged by host suffix against the rules' domain lists."""
    pages = I.page_texts(spark, sf_dir).select("page_id", "source")
    rules = I.page_rules(spark) + I.doc_rules(spark)
    return P.tag_domains(pages, rules).select("page_id", "source", "niche", "matched_domain",
                                              "domain_type")


@query("length_gate")
def length_gate(spark, sf_dir):
    """Inclusive length range of the niche, in code points."""
    d = I.labeling_documents(spark, sf_dir)
    return P.length_gate(d, I.doc_rules(spark)).select("doc_id", F.length("text").alias("n"))


@query("collection_summary")
def collection_summary(spark, sf_dir):
    """P10 over pages tagged by P8."""
    tagged = P.tag_domains(I.page_texts(spark, sf_dir).where(F.col("success"))
                           .select("page_id", "source"), I.page_rules(spark))
    return P.collection_summary(tagged)


# ----------------------------- splits (M) and counts (A) --------------------

def labeled_documents(spark, sf_dir) -> DataFrame:
    """documents with the quality target of ``labels`` (the M/E target)."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return d.join(lab, "doc_id")


def _split_docs(spark, sf_dir):
    from claimflow.operators.split import stratified_split
    return stratified_split(labeled_documents(spark, sf_dir).select("doc_id", "label"),
                            "label", key="doc_id", seed=42)


@query("stratified_split")
def stratified_split_q(spark, sf_dir):
    """M1: exact 70/15/15 per class, ranked by md5(doc_id:42); CV fold."""
    return _split_docs(spark, sf_dir).select("doc_id", "label", "split", "fold",
                                             F.col("rank").cast("long").alias("rank"))


@query("split_class_counts")
def split_class_counts(spark, sf_dir):
    """A1: class distribution by split."""
    return _split_docs(spark, sf_dir).groupBy("split", "label").agg(F.count(F.lit(1)).alias("n"))


def _unified(spark, sf_dir):
    """J2 + L10: labeled documents and pages under their niches, 1/0 target."""
    from claimflow.sources.io import union_niches
    docs = L.niche_label_to_binary(_doc_labels(spark, sf_dir), I.doc_rules())
    pages = L.niche_label_to_binary(_page_labels(spark, sf_dir), I.page_rules())
    cols = ["id", "niche", "label", "label_binary", "text"]
    return union_niches({I.DOC_NICHE: docs.select(*cols), I.PAGE_NICHE: pages.select(*cols)})


@query("unified_split_counts")
def unified_split_counts(spark, sf_dir):
    """M2 + A2: split stratified by (label, niche); rows by niche within split
    with rollup totals."""
    from claimflow.operators.split import stratified_split
    x = stratified_split(_unified(spark, sf_dir), ["label_binary", "niche"], key="id", seed=42)
    return (x.rollup("split", "niche").agg(F.count(F.lit(1)).alias("n"))
            .select(F.coalesce("split", F.lit("(all)")).alias("split"),
                    F.coalesce("niche", F.lit("(all)")).alias("niche"), "n"))


@query("class_weights")
def class_weights(spark, sf_dir):
    """A3: balanced weights n / (k * n_c) on the training split."""
    from claimflow.operators.aggregates import balanced_weights
    train = _split_docs(spark, sf_dir).where(F.col("split") == "train")
    return balanced_weights(train, "label").select("label", "n_c", F.round("weight", 6).alias("weight"))


# ----------------------------- features (F) ---------------------------------

def _preprocessed(spark, sf_dir):
    return preprocessed_documents(spark, sf_dir).select("doc_id", "text_processed")


def _fitted(spark, sf_dir):
    """The documents' terms, written once for the fit and the transform."""
    from claimflow.operators.features import add_terms, fit_tfidf
    from claimflow.session import write_stage
    docs = write_stage(add_terms(_preprocessed(spark, sf_dir)).select("doc_id", "terms"), "terms")
    return docs, fit_tfidf(docs, min_df=3, max_df=0.95, max_features=10_000)


@query("tfidf_vocabulary")
def tfidf_vocabulary(spark, sf_dir):
    """F3 + F7: kept terms with index, df, corpus frequency and idf."""
    _, model = _fitted(spark, sf_dir)
    return model.vocab.select("term", "idx", "df", "cf", F.round("idf", 6).alias("idf"))


@query("tfidf_weights")
def tfidf_weights(spark, sf_dir):
    """Long-form L2-normalised weights for every document."""
    docs, model = _fitted(spark, sf_dir)
    return model.transform(docs).select("doc_id", "term", "idx", F.round("weight", 6).alias("weight"))


# ----------------------------- evaluation (E) -------------------------------

def _rule_predictions(spark, sf_dir) -> DataFrame:
    """The weak-label rules as a classifier of the ``labels`` quality target:
    predicted 1 for the positive label, score = positive - negative score."""
    lab = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("actual"))
    d = _doc_labels(spark, sf_dir)
    return d.join(lab, "doc_id").select(
        "doc_id", "actual",
        F.when(F.col("label") == F.col("positive_label"), 1).otherwise(0).alias("predicted"),
        (F.col("positive_score") - F.col("negative_score")).cast("double").alias("score"))


def _r6(cols):
    return [F.round(c, 6).alias(c) for c in cols]


@query("eval_accuracy")
def eval_accuracy(spark, sf_dir):
    """E1."""
    from claimflow.operators.evaluate import accuracy
    return accuracy(_rule_predictions(spark, sf_dir)).select(F.round("accuracy", 6).alias("accuracy"), "n")


@query("eval_confusion")
def eval_confusion(spark, sf_dir):
    """Every (actual, predicted) pair, zeros kept."""
    from claimflow.operators.evaluate import confusion
    return confusion(_rule_predictions(spark, sf_dir))


@query("eval_class_report")
def eval_class_report(spark, sf_dir):
    """E2 per class."""
    from claimflow.operators.evaluate import class_report, confusion_counts
    r = class_report(confusion_counts(_rule_predictions(spark, sf_dir)))
    return r.select("class", *_r6(["precision", "recall", "f1"]), "support")


@query("eval_summary")
def eval_summary(spark, sf_dir):
    """E2 averages, E4 AUC and E6 average precision as (metric, value) rows."""
    from claimflow.operators import evaluate as E
    from claimflow.session import write_stage
    # Read by the report, the AUC and the AP jobs: label once.
    pred = write_stage(_rule_predictions(spark, sf_dir), "predictions")
    parts = [E.report_summary(E.class_report(E.confusion_counts(pred))), E.curve_summary(pred, positive=1)]
    longs = [p.unpivot([], p.columns, "metric", "value") for p in parts]
    out = longs[0]
    for x in longs[1:]:
        out = out.unionByName(x)
    return out.select("metric", F.round(F.col("value").cast("double"), 6).alias("value"))


@query("eval_roc_curve")
def eval_roc_curve(spark, sf_dir):
    """E4 points."""
    from claimflow.operators.evaluate import roc_curve
    return roc_curve(_rule_predictions(spark, sf_dir), positive=1).select("threshold", *_r6(["fpr", "tpr"]))


@query("eval_pr_curve")
def eval_pr_curve(spark, sf_dir):
    """E5 points."""
    from claimflow.operators.evaluate import pr_curve
    return pr_curve(_rule_predictions(spark, sf_dir), positive=1).select("threshold", *_r6(["precision", "recall"]))


@query("prediction_summary")
def prediction_summary_q(spark, sf_dir):
    """A4: count, share and mean confidence per predicted class."""
    from claimflow.operators.aggregates import prediction_summary
    pred = _rule_predictions(spark, sf_dir).withColumn(
        "confidence", F.abs(F.col("score")) / (F.abs(F.col("score")) + 1.0))
    return prediction_summary(pred, pred_col="predicted").select("predicted", "n", *_r6(["mean_confidence", "share"]))


# ----------------------------- training, scoring, streaming ----------------
# Iterative model fits have no SQL twin: these are rows-only checks.

_TRAINED: dict = {}


def trained_quality_model(spark, sf_dir):
    """M9: both models trained on documents x labels (quality target);
    remembered per application and input files, so a changed folder or a new
    session trains anew."""
    from claimflow.plans.train import TrainConfig, train_classifier
    labeled = labeled_documents(spark, sf_dir).select("doc_id", "text", "label")
    k = (spark.sparkContext.applicationId, *sorted(labeled.inputFiles()))
    if k not in _TRAINED:
        _TRAINED.clear()
        _TRAINED[k] = train_classifier(labeled, "doc_id", cfg=TrainConfig(min_df=2, max_features=10_000))
    return _TRAINED[k]


def _scorer(spark, sf_dir, model: str | None = None):
    from claimflow.operators.score import Scorer
    r = trained_quality_model(spark, sf_dir)
    name = model or r.best
    return Scorer(r.vectorizer, r.models[name], [str(c) for c in r.classes],
                  has_probability=name == "logistic_regression")


@query("train_metrics")
def train_metrics(spark, sf_dir):
    """M4-M8: train/validation accuracy, CV macro-F1 mean/std, best flag."""
    r = trained_quality_model(spark, sf_dir)
    return r.metrics.withColumn("is_best", F.col("model") == r.best)


@query("top_terms")
def top_terms_q(spark, sf_dir):
    """20 strongest terms each way by logistic-regression coefficient."""
    from claimflow.operators.aggregates import top_terms
    from claimflow.plans.train import coefficients
    return top_terms(coefficients(trained_quality_model(spark, sf_dir)), n=20)


@query("test_evaluation")
def test_evaluation(spark, sf_dir):
    """Logistic regression on the held-out test split, E1/E2/E4/E6 as
    (metric, value) rows."""
    from claimflow.operators import evaluate as E
    from claimflow.plans.evaluate_niche import test_predictions
    r = trained_quality_model(spark, sf_dir)
    p = test_predictions(r, "doc_id", model="logistic_regression")
    positive = str(r.classes[-1])
    parts = [E.accuracy(p).drop("n"), E.report_summary(E.class_report(E.confusion_counts(p))),
             E.curve_summary(p, positive=positive)]
    out = None
    for x in parts:
        u = x.unpivot([], x.columns, "metric", "value")
        out = u if out is None else out.unionByName(u)
    return out


@query("score_benchmark")
def score_benchmark(spark, sf_dir):
    """Score every benchmark item with the chosen model; one
    ``prob_<class>`` column per class; empty texts get ``Unknown``."""
    from claimflow.operators.score import score, with_class_columns
    sc = _scorer(spark, sf_dir)
    b = read_table(spark, sf_dir, "benchmark")
    return with_class_columns(score(b, sc, "item_id"), sc.classes).drop("probabilities")


@query("score_conversation_stream")
def score_conversation_stream(spark, sf_dir):
    """Conversation turns read as a file stream and scored per
    micro-batch; the rows written by the stream."""
    import uuid

    from pyspark.sql.types import _parse_datatype_string

    from claimflow.session import scratch_path
    from claimflow.streaming.score_stream import score_stream_once
    sc = _scorer(spark, sf_dir)
    run = scratch_path(spark, f"stream-{uuid.uuid4().hex}")
    conv = read_table(spark, sf_dir, "conversations").select(
        F.concat_ws(":", "conv_id", "turn").alias("turn_id"), "conv_id", "turn", "role", "text")
    src = f"{run}/source"
    conv.write.mode("overwrite").parquet(src)
    schema = "turn_id string, conv_id long, turn long, role string, text string"
    out = score_stream_once(spark, src, _parse_datatype_string(schema), sc, "turn_id",
                            f"{run}/sink", f"{run}/checkpoint")
    return out.drop("probabilities", "epoch")


@query("csv_round_trip")
def csv_round_trip(spark, sf_dir):
    """S1 + S3: documents written as quoted CSV and read back with an
    explicit schema; multi-line texts with quotes survive unchanged."""
    import uuid
    from pyspark.sql import types as T
    from claimflow.session import scratch_path
    from claimflow.sources.io import read_csv, write_csv
    path = scratch_path(spark, f"csv-{uuid.uuid4().hex}")
    d = read_table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    write_csv(d, path)
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("source", T.StringType()),
                           T.StructField("text", T.StringType())])
    return read_csv(spark, path, schema)


# ----------------------------- more coverage --------------------------------

@query("distinct_sources")
def distinct_sources(spark, sf_dir):
    """Distinct values of a column."""
    return read_table(spark, sf_dir, "documents").select("source").distinct()


@query("split_features")
def split_features(spark, sf_dir):
    """F9 (+S8 layout): vocabulary fitted on the train split only, then all
    three splits transformed in one job with ``split`` kept."""
    from claimflow.operators.features import add_terms, fit_tfidf
    from claimflow.operators.split import stratified_split
    from claimflow.plans.train import preprocess
    from claimflow.session import write_stage
    d = labeled_documents(spark, sf_dir).select("doc_id", "text", "label")
    pre = write_stage(preprocess(d).select("doc_id", "label", "text_processed"), "cleaned")
    x = add_terms(stratified_split(pre, "label", key="doc_id", seed=42))
    x = write_stage(x.select("doc_id", "split", "terms"), "split-terms")
    vec = fit_tfidf(x.where(F.col("split") == "train"), min_df=2, max_df=0.95, max_features=10_000)
    return (vec.transform(x)
            .select("doc_id", "split", "term", "idx", F.round("weight", 6).alias("weight")))


@query("eval_by_language")
def eval_by_language(spark, sf_dir):
    """Accuracy per group (here the document language)."""
    from claimflow.operators.evaluate import accuracy_by
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    p = _rule_predictions(spark, sf_dir).join(d, "doc_id")
    return accuracy_by(p, "lang").select("lang", F.round("accuracy", 6).alias("accuracy"), "n")


@query("conversation_tokens")
def conversation_tokens(spark, sf_dir):
    """T1-T3 on the conversation turns: cleaned text and token count per turn."""
    c = read_table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    x = evaluate_once(c, text_clean=clean_text("text"))
    x = evaluate_once(x, tokens=tokenize("text_clean"))
    return x.select("conv_id", "turn", "role", "text_clean", join_tokens("tokens").alias("text_processed"),
                    F.size("tokens").alias("n_tokens"))


@query("niche_results")
def niche_results(spark, sf_dir):
    """E8 -> summary document -> S5: the results table (niche, macro F1,
    accuracy, positive, negative, total and a TOTAL row) for the quality
    classifier trained on documents x labels."""
    import uuid

    from claimflow.plans.evaluate_niche import evaluate_niche, write_niche_summary
    from claimflow.session import scratch_path
    from claimflow.sources.io import collect_results
    r = trained_quality_model(spark, sf_dir)
    labeled = labeled_documents(spark, sf_dir).select("doc_id", "text", "label")
    tables = evaluate_niche(r, "doc_id", model="logistic_regression")
    path = scratch_path(spark, f"summaries-{uuid.uuid4().hex}")
    write_niche_summary(tables, labeled, path, "document_quality", positive_label="1", negative_label="0")
    return collect_results(spark, f"{path}/*/*.txt")


@query("collected_page_labels")
def collected_page_labels(spark, sf_dir):
    """P8 -> L5: kept pages tagged with the niche and side of the domain
    list they belong to (host or subdomain), then labeled under that
    niche's rules with that domain type; counts per (niche, side, label)."""
    kept = (I.page_texts(spark, sf_dir).where(F.col("success"))
            .select("page_id", "url", "title", "text", "source"))
    rules = I.page_rules(spark)
    tagged = P.tag_domains(kept, rules)
    labeled = L.label_dataset(tagged, rules, key="page_id", date=I.LABEL_DATE)
    return (labeled.groupBy("niche", "domain_type", "label")
            .agg(F.count(F.lit(1)).alias("rows"), F.sum("positive_score").alias("positive_score_sum"),
                 F.sum("negative_score").alias("negative_score_sum")))


# ----------------------------- operators on derived tables -------------------
# The steps around files, fits and scores, on inputs that follow from the given
# tables by plain expressions, so that SQL can state the whole result.

VERDICTS = ("true", "mostly-true", "half-true", "barely-true", "false", "pants-fire", "unknown")


def _verdict(key) -> F.Column:
    return F.element_at(F.array(*[F.lit(v) for v in VERDICTS]), (F.col(key) % len(VERDICTS) + 1).cast("int"))


def _three_way(key) -> F.Column:
    return F.element_at(F.array(F.lit("train"), F.lit("valid"), F.lit("test")), (F.col(key) % 3 + 1).cast("int"))


def _scratch(spark, name: str) -> str:
    import uuid

    from claimflow.session import scratch_path
    return scratch_path(spark, f"{name}-{uuid.uuid4().hex}")


@query("statement_round_trip")
def statement_round_trip(spark, sf_dir):
    """Documents as statements (verdict and split by doc_id), written as
    the three headerless TSV files and read back with their split."""
    from claimflow.sources.io import STATEMENT_SCHEMA, read_statements, write_statements
    d = read_table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), _verdict("doc_id").alias("label"), clean_text("text").alias("statement"),
        F.col("lang").alias("subject"), F.col("source").alias("speaker"), F.col("n_chars").cast("double").alias("false_count"),
        _three_way("doc_id").alias("split"))
    full = d.select("split", *[F.col(f.name) if f.name in d.columns else F.lit(None).cast(f.dataType).alias(f.name)
                               for f in STATEMENT_SCHEMA.fields])
    path = _scratch(spark, "statements")
    write_statements(full, path)
    return read_statements(spark, path).select("id", "label", "statement", "subject", "speaker", "job_title", "false_count", "split")


@query("verdict_binary")
def verdict_binary(spark, sf_dir):
    """Six verdicts to 1/0; unmapped ones dropped."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", _verdict("doc_id").alias("label"))
    return L.verdict_to_binary(d)


@query("given_split")
def given_split_q(spark, sf_dir):
    """M3: a provided split kept, ``valid`` named ``validation``."""
    from claimflow.operators.split import given_split
    return given_split(read_table(spark, sf_dir, "documents").select("doc_id", _three_way("doc_id").alias("split")))


@query("drop_null_rows")
def drop_null_rows(spark, sf_dir):
    """Rows with a null in a chosen column go."""
    from claimflow.functions.text import drop_nulls
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 5 != 0, F.col("source")).alias("source"),
        F.when(F.col("doc_id") % 3 != 0, F.col("lang")).alias("lang"))
    return drop_nulls(d, "source")


@query("label_codes")
def label_codes(spark, sf_dir):
    """alphabetical codes of a label and back."""
    from claimflow.operators.features import decode_labels, encode_labels
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.col("lang").alias("label"))
    coded, classes = encode_labels(d, "label", "code")
    return decode_labels(coded, classes, "code", "decoded")


@query("fold_stats")
def fold_stats(spark, sf_dir):
    """Mean and population deviation of fold scores per model."""
    from claimflow.operators.aggregates import fold_score_stats
    scores = (read_table(spark, sf_dir, "documents").groupBy(F.col("source").alias("model"), (F.col("doc_id") % 5).alias("fold"))
              .agg((F.avg(F.col("n_chars") % 1000) / 1000).alias("f1")))
    return fold_score_stats(scores).select("model", *_r6(["cv_mean", "cv_std"]))


@query("model_selection")
def model_selection(spark, sf_dir):
    """M8 per niche (here the language): best CV mean, ties to the first."""
    from claimflow.plans.train import best_models
    models = (read_table(spark, sf_dir, "documents")
              .groupBy(F.col("lang").alias("niche"), (F.col("doc_id") % 4).cast("int").alias("model_order"))
              .agg((F.floor(F.avg(F.col("n_chars") % 100) / 10) / 10).cast("double").alias("cv_mean"))
              .withColumn("model", F.concat(F.lit("m"), F.col("model_order").cast("string"))))
    return best_models(models, ("niche",))


@query("top_terms_given")
def top_terms_given(spark, sf_dir):
    """A5/E7 on given coefficients: 20 largest and smallest, ties by term."""
    from claimflow.operators.aggregates import top_terms
    _, model = _fitted(spark, sf_dir)
    coefs = model.vocab.select("term", (((F.col("cf") * 31 + F.col("df") * 17) % 1001 - 500) / 500).alias("coef"))
    return top_terms(coefs, n=20).select("side", "rank", "term", F.round("coef", 6).alias("coef"))


@query("features_store")
def features_store(spark, sf_dir):
    """Long-form features written by split and read back."""
    from claimflow.sources.io import read_features, write_features
    path = _scratch(spark, "features")
    write_features(split_features(spark, sf_dir), path)
    return (read_features(spark, path).groupBy("split")
            .agg(F.count(F.lit(1)).alias("n"), F.countDistinct("term").alias("terms"), F.round(F.sum("weight"), 3).alias("weight")))


@query("results_table")
def results_table(spark, sf_dir):
    """One summary document per language, collected into the table."""
    from claimflow.sources.io import collect_results
    x = labeled_documents(spark, sf_dir).groupBy("lang").agg(
        F.count_if(F.col("label") == 1).alias("good"), F.count_if(F.col("label") == 0).alias("bad"),
        F.round(F.avg(F.col("n_chars") % 100) / 100, 6).alias("f1"))
    doc = F.to_json(F.struct(
        F.col("lang").alias("niche"), F.create_map(F.lit("bad"), "bad", F.lit("good"), "good").alias("samples_per_class"),
        F.col("f1").alias("test_macro_f1"), F.lit(0.5).alias("test_accuracy"),
        F.lit("good").alias("positive_label"), F.lit("bad").alias("negative_label")))
    path = _scratch(spark, "summaries")
    x.select(doc.alias("v"), "lang").write.partitionBy("lang").text(path)
    return collect_results(spark, f"{path}/*/*.txt")


@query("score_empty_texts")
def score_empty_texts(spark, sf_dir):
    """Texts that clean to nothing get ``Unknown``, confidence 0 and even
    probabilities; all other rows are scored."""
    from claimflow.operators.score import score, with_class_columns
    sc = _scorer(spark, sf_dir)
    d = read_table(spark, sf_dir, "documents").select(
        "doc_id", F.when(F.col("doc_id") % 10 == 0, F.lit("!!! ??")).when(F.col("doc_id") % 10 == 1, F.lit(None))
        .otherwise(F.col("text")).alias("text"))
    x = with_class_columns(score(d, sc), sc.classes)
    empty = F.col("error").isNotNull()
    return x.select("doc_id", F.when(empty, F.col("prediction")).alias("prediction"), F.when(empty, F.col("confidence")).alias("confidence"),
                    *[F.when(empty, F.col(f"prob_{c}")).alias(f"prob_{c}") for c in sc.classes], "error")


@query("eval_report_by_language")
def eval_report_by_language(spark, sf_dir):
    """The per-class report of every group."""
    from claimflow.operators.evaluate import report_by
    d = read_table(spark, sf_dir, "documents").select("doc_id", "lang")
    r = report_by(_rule_predictions(spark, sf_dir).join(d, "doc_id"), "lang")
    return r.select("lang", "class", *_r6(["precision", "recall", "f1"]), "support")


def _length_predictions(spark, sf_dir) -> DataFrame:
    """Text length as a score of the toxic label: nearly as many distinct
    scores as rows."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return d.join(read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("actual")), "doc_id")


@query("eval_length_roc_curve")
def eval_length_roc_curve(spark, sf_dir):
    """E4 over many distinct scores, in score ranges of 100 rows."""
    from claimflow.operators.evaluate import roc_curve, score_table
    p = _length_predictions(spark, sf_dir)
    n_ranges = max(2, score_table(p, 1).count() // 100)
    return roc_curve(p, positive=1, n_buckets=n_ranges).select("threshold", *_r6(["fpr", "tpr"]))


@query("eval_length_summary")
def eval_length_summary(spark, sf_dir):
    """E4 and E6 over many distinct scores."""
    from claimflow.operators.evaluate import curve_summary
    return curve_summary(_length_predictions(spark, sf_dir), positive=1).select(*_r6(["roc_auc", "average_precision"]))


# ----------------------------- many phrases, models, feeds --------------------

PHRASE_NICHE = "benchmark_phrases"


def phrase_rule_set(spark, sf_dir):
    """Rules of many phrases: every one to three words in a row of the benchmark
    items, even items against odd ones."""
    from claimflow.sources.rules import RuleSet
    words = F.split(F.lower(F.coalesce("text", F.lit(""))), " ")
    runs = F.flatten(F.transform(F.sequence(F.lit(1), F.lit(3)), lambda n: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size("w") - n + 1, F.lit(1))), lambda i: F.array_join(F.slice("w", i, n), " "))))
    b = evaluate_once(read_table(spark, sf_dir, "benchmark"), w=words)
    sides = [r[0] for k in (0, 1) for r in b.where(F.col("item_id") % 2 == k).select(F.explode(runs).alias("p")).where("p <> ''")
             .distinct().agg(F.array_sort(F.collect_list("p"))).collect()]
    return RuleSet.from_mapping({"niche": PHRASE_NICHE, "positive_label": "even", "negative_label": "odd", "positive_phrases": sides[0],
                                 "negative_phrases": sides[1], "positive_domains": ["src1"], "negative_domains": ["src2"]})


@query("phrase_index_labels")
def phrase_index_labels(spark, sf_dir):
    """L2-L5 with thousands of phrases through the phrase index."""
    d = I.labeling_documents(spark, sf_dir).withColumn("niche", F.lit(PHRASE_NICHE))
    x = L.label_dataset(d, [phrase_rule_set(spark, sf_dir)], key="doc_id", date=I.LABEL_DATE)
    return x.select("doc_id", "label", "positive_score", "negative_score", F.md5(L.heuristics_string()).alias("evidence"))


def _given_scorers(spark, sf_dir):
    """Two niches' given models on the documents' vocabulary: the first knows
    every other term."""
    from claimflow.operators.features import TfidfModel
    from claimflow.operators.score import LinearModel, Scorer
    _, m = _fitted(spark, sf_dir)
    rows = sorted(m.vocab.collect(), key=lambda r: r["idx"])
    half = [r for r in rows if r["idx"] % 2 == 0]
    def coefficients(rs, a, b):
        return [((r["cf"] * a + r["df"] * b) % 1001 - 500) / 500 for r in rs]
    first = TfidfModel(m.vocab, [r["term"] for r in half], [r["idf"] for r in half], m.n_docs, stop_words=m.stop_words)
    return {"first": Scorer(first, LinearModel(coefficients(half, 31, 17), 0.1), ["no", "yes"]),
            "second": Scorer(m, LinearModel(coefficients(rows, 13, 7), -0.2), ["bad", "good"])}


def _niche_documents(spark, sf_dir):
    niche = F.element_at(F.array(F.lit("first"), F.lit("second"), F.lit("other")), (F.col("doc_id") % 3 + 1).cast("int"))
    return read_table(spark, sf_dir, "documents").select("doc_id", "text", niche.alias("niche"))


@query("score_niches")
def score_niches(spark, sf_dir):
    """Documents of three niches scored in one pass by two given models."""
    from claimflow.operators.score import score_by_niche
    x = score_by_niche(_niche_documents(spark, sf_dir), _given_scorers(spark, sf_dir))
    top = F.element_at("probabilities", F.when(F.col("niche") == "first", F.lit("yes")).otherwise(F.lit("good")))
    return x.select("doc_id", "niche", "prediction", F.round("confidence", 6).alias("confidence"), F.round(top, 6).alias("positive"), "error")


@query("score_file_summary")
def score_file_summary(spark, sf_dir):
    """C4: documents written as CSV, scored from file to file by a given model;
    the summary."""
    from claimflow.operators.score import score_file
    from claimflow.sources.io import write_csv
    source = _scratch(spark, "texts")
    write_csv(read_table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("body")), source)
    out = score_file(spark, source, _scratch(spark, "scored"), _given_scorers(spark, sf_dir)["second"], text_col="body")
    return out.select("prediction", "n", *_r6(["mean_confidence", "share"]))


@query("feed_documents")
def feed_documents(spark, sf_dir):
    """P7 from feed documents: each document's lines as the entries of an RSS or
    (every third) an Atom feed; every seventh feed is cut off and rejected."""
    from claimflow.sources import feeds
    d = read_table(spark, sf_dir, "documents").select("doc_id", F.split(F.coalesce("text", F.lit("")), "\n").alias("_lines"))
    lines = evaluate_once(d, lines=F.transform("_lines", lambda t: clean_text(t))).drop("_lines")
    def entry(line, i, rss):
        day = F.date_sub(F.to_date(F.lit("2024-06-01")), (i * 37 % 730).cast("int"))
        link = F.concat(F.lit("https://h.org/"), F.col("doc_id").cast("string"), F.lit("/"), i.cast("string"))
        if rss:
            when = F.when(i % 5 != 0, F.concat(F.lit("<pubDate>Mon, "), F.date_format(day, "dd MMM yyyy"), F.lit(" 00:00:00 GMT</pubDate>"))).otherwise("")
            return F.concat(F.lit("<item><title>t"), i.cast("string"), F.lit("</title><link>"), link, F.lit("</link>"), when, F.lit("<description>"), line, F.lit("</description></item>"))
        when = F.when(i % 5 != 0, F.concat(F.lit("<updated>"), day.cast("string"), F.lit("T00:00:00Z</updated>"))).otherwise("")
        return F.concat(F.lit("<entry><title>t"), i.cast("string"), F.lit('</title><link rel="self" href="x"/><link href="'), link, F.lit('"/>'), when, F.lit("<summary>"), line, F.lit("</summary></entry>"))
    rss = F.concat(F.lit("<rss><channel><title>x</title>"), F.array_join(F.transform("lines", lambda t, i: entry(t, i, True)), ""), F.lit("</channel></rss>"))
    atom = F.concat(F.lit("<feed>"), F.array_join(F.transform("lines", lambda t, i: entry(t, i, False)), ""), F.lit("</feed>"))
    xml = F.when(F.col("doc_id") % 3 == 0, atom).otherwise(rss)
    xml = F.when(F.col("doc_id") % 7 == 0, F.substring(xml, F.lit(1), F.length(xml) - 5)).otherwise(xml)
    rows = lines.select(F.col("doc_id").alias("feed"), xml.alias("xml"))
    kept = P.recent_feed_entries(feeds.feed_entries(rows), as_of="2024-06-01 00:00:00", max_articles=100)
    return kept.select("feed", F.col("entry_pos").cast("int").alias("entry_pos"), "title", "link", "published", "summary")
