"""E8 + S5: evaluate a trained niche on its test split and write the
per-niche summary document the results collector reads."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.operators import evaluate as E
from claimflow.operators.features import decode_labels
from claimflow.session import write_stage
from claimflow.sources import io


def test_predictions(result, key: str, label_col: str = "label", model: str | None = None) -> DataFrame:
    """(key, actual, predicted, score) for the held-out test rows; score is
    the probability of the last class (none for the SVM). The split rows carry
    their terms, so no text is read or cleaned again."""
    name = model or result.best
    classes = [str(c) for c in result.classes]
    test = result.vectorizer.vectors(result.data.where(F.col("split") == "test"))
    p = decode_labels(result.models[name].transform(test), classes, "prediction", "predicted")
    s = F.element_at(vector_to_array("probability"), -1) if name == "logistic_regression" else F.lit(None).cast("double")
    return write_stage(p.select(key, F.col(label_col).cast("string").alias("actual"), "predicted", s.alias("score")), "test-predictions")


def evaluate_niche(result, key: str, label_col: str = "label", model: str | None = None) -> dict:
    """E1-E6 tables for the test split (curves only with probabilities)."""
    pred = test_predictions(result, key, label_col, model)
    classes = [str(c) for c in result.classes]
    cm = E.confusion(pred, classes)
    out = {"predictions": pred, "accuracy": E.accuracy(pred), "confusion": cm, "report": E.class_report(cm)}
    if pred.where(F.col("score").isNotNull()).limit(1).count():
        out.update({"roc": E.roc_curve(pred, classes[-1]), "pr": E.pr_curve(pred, classes[-1]),
                    "roc_auc": E.roc_auc(pred, classes[-1]),
                    "average_precision": E.average_precision(pred, classes[-1])})
    return out


def write_niche_summary(tables: dict, labeled: DataFrame, path: str, niche: str,
                        positive_label: str, negative_label: str, label_col: str = "label") -> None:
    """The summary document: class counts of the labeled set, test macro F1
    and accuracy, per-class scores (all small: one row per class)."""
    spark = labeled.sparkSession
    counts = {str(r[0]): int(r[1]) for r in labeled.groupBy(label_col).count().collect()}
    report = tables["report"].collect()
    per_class = {str(r["class"]): {"precision": r.precision, "recall": r.recall, "f1": r.f1} for r in report}
    macro = sum(r.f1 for r in report) / len(report) if report else 0.0
    acc = tables["accuracy"].first().accuracy or 0.0
    io.write_summary_json(spark, path, niche, counts, macro, acc, per_class, positive_label, negative_label)
