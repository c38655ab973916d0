"""Evaluation tables (E1-E7) from a predictions frame.

Input columns: ``actual`` and ``predicted`` (class names or codes, same
type) and, for the curves, ``score`` (higher = more likely the positive
class). Every output is a tidy DataFrame; all metrics are doubles.

Curves (E4-E6) need running sums in descending score order. A plain
window over all scores is one task (hazard H5), so the per-score table is
range-partitioned by score (``operators.ranges``): one total per range, running
sums inside, no bound in the plan and the same rows for any number of ranges.
Every metric is null where it is not defined (no rows, one class).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.operators.ranges import running_sums
from claimflow.session import write_stage


def _ratio(a: Column, b: Column) -> Column:
    """a / b as double, 0 when b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def accuracy(pred: DataFrame) -> DataFrame:
    """Accuracy and row count."""
    return pred.agg(F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("accuracy"),
                    F.count(F.lit(1)).alias("n"))


def confusion_counts(pred: DataFrame, by=()) -> DataFrame:
    """Observed (by..., actual, predicted) counts: one pass over the rows."""
    return pred.groupBy(*by, "actual", "predicted").agg(F.count(F.lit(1)).alias("count"))


def confusion(pred: DataFrame, classes: list | None = None) -> DataFrame:
    """Counts per (actual, predicted), zeros kept for every class pair.

    ``classes`` defaults to the classes seen. Spark makes the pairs from the
    class table, so the output's size is its only cost."""
    counts = write_stage(confusion_counts(pred), "confusion")
    if classes is None:
        seen = counts.select(F.explode(F.array("actual", "predicted")).alias("c")).where("c is not null").distinct()
        classes = sorted(r[0] for r in seen.collect())
    kind = pred.schema["actual"].dataType
    one = pred.sparkSession.createDataFrame([(c,) for c in classes], f"actual {kind.simpleString()}")
    every = F.array(*[F.lit(c) for c in classes]).cast(f"array<{kind.simpleString()}>")
    pairs = one.withColumn("predicted", F.explode(every))
    return (pairs.join(counts, ["actual", "predicted"], "left")
            .select("actual", "predicted", F.coalesce("count", F.lit(0)).alias("count")))


def class_report(cm: DataFrame, by=()) -> DataFrame:
    """Precision, recall, F1 and support per class (and per ``by``), from
    E3 counts or observed counts alike: each cell counts for its actual and
    its predicted class, in one aggregation."""
    same = F.col("actual") == F.col("predicted")
    n, zero = F.col("count"), F.lit(0).cast("long")
    cells = F.array(F.struct(F.col("actual").alias("class"), F.when(same, n).otherwise(zero).alias("tp"), n.alias("act"), zero.alias("pre")),
                    F.struct(F.col("predicted").alias("class"), zero.alias("tp"), zero.alias("act"), n.alias("pre")))
    x = (cm.select(*by, F.inline(cells)).where(F.col("class").isNotNull()).groupBy(*by, "class")
         .agg(F.sum("tp").alias("tp"), F.sum("pre").alias("pred_n"), F.sum("act").alias("support")))
    p = _ratio(F.col("tp"), F.col("pred_n"))
    r = _ratio(F.col("tp"), F.col("support"))
    return (x.withColumn("precision", p).withColumn("recall", r)
            .withColumn("f1", _ratio(2 * F.col("precision") * F.col("recall"),
                                     F.col("precision") + F.col("recall")))
            .select(*by, "class", "precision", "recall", "f1", F.col("support").cast("long")))


def report_summary(report: DataFrame) -> DataFrame:
    """E2 averages: macro (plain mean) and weighted (by support)."""
    def weighted(c):
        return F.try_divide(F.sum(F.col(c) * F.col("support")), F.sum("support").cast("double")).alias(f"weighted_{c}")
    return report.agg(
        F.avg("precision").alias("macro_precision"), F.avg("recall").alias("macro_recall"),
        F.avg("f1").alias("macro_f1"),
        weighted("precision"), weighted("recall"), weighted("f1"),
    )


def score_table(pred: DataFrame, positive) -> DataFrame:
    """Per distinct score: positives and negatives at that score."""
    is_pos = (F.col("actual") == F.lit(positive))
    return (pred.where(F.col("score").isNotNull())
            .groupBy(F.col("score").cast("double").alias("score"))
            .agg(F.count_if(is_pos).alias("pos_n"), F.count_if(~is_pos).alias("neg_n")))


def running_by_score(per_score: DataFrame, cols=("pos_n", "neg_n"), n_buckets: int | None = None,
                     with_next: bool = False) -> DataFrame:
    """Inclusive running sums of ``cols`` in descending score order; with
    ``with_next`` also the next lower score's ``cols`` (null for the last).
    ``n_buckets`` sets the number of score ranges; the result is the same."""
    return running_sums(per_score, [F.col("score").desc()], list(cols), n_ranges=n_buckets, with_next=with_next, name="score-ranges")


def _curve_base(pred: DataFrame, positive, n_buckets: int | None, with_next: bool = False) -> DataFrame:
    # One row per distinct score, read by the total and the range jobs below:
    # written once.
    st = write_stage(score_table(pred, positive), "scores")
    # Two class totals: one tiny aggregate read on the driver as literals.
    t = st.agg(F.sum("pos_n").alias("P"), F.sum("neg_n").alias("N")).first()
    cum = running_by_score(st, n_buckets=n_buckets, with_next=with_next)
    return cum.withColumns({"P": F.lit(int(t["P"] or 0)), "N": F.lit(int(t["N"] or 0))})


def roc_curve(pred: DataFrame, positive=1, n_buckets: int | None = None,
              drop_intermediate: bool = False) -> DataFrame:
    """One point per distinct score (threshold), plus the (0, 0) origin.

    ``drop_intermediate`` drops a point when the steps before and after it
    are the same (it lies on a straight segment), as the original's curve
    function did; the first and last points always stay."""
    c = _curve_base(pred, positive, n_buckets, with_next=drop_intermediate)
    if drop_intermediate:
        first = (F.col("cum_pos_n") == F.col("pos_n")) & (F.col("cum_neg_n") == F.col("neg_n"))
        last = F.col("next_pos_n").isNull()
        bend = (F.col("next_pos_n") != F.col("pos_n")) | (F.col("next_neg_n") != F.col("neg_n"))
        c = c.where(first | last | bend)
    pts = c.select(F.col("score").alias("threshold"),
                   _ratio(F.col("cum_neg_n"), F.col("N")).alias("fpr"),
                   _ratio(F.col("cum_pos_n"), F.col("P")).alias("tpr"))
    origin = pred.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)], "threshold double, fpr double, tpr double")
    return origin.unionByName(pts)


def _share_of_square(area: Column) -> Column:
    """Summed area over P * N; null when a class is missing."""
    return F.try_divide(F.sum(area), F.first("P").cast("double") * F.first("N"))


def roc_auc(pred: DataFrame, positive=1, n_buckets: int | None = None) -> DataFrame:
    """Area under the ROC curve by the trapezoid rule over score groups.

    A group at one score moves from (fp0, tp0) to (fp0 + neg, tp0 + pos), so
    its trapezoid is ``neg * (2 tp0 + pos) / 2``; summing needs no ordering
    beyond the running sums."""
    c = _curve_base(pred, positive, n_buckets)
    tp0 = F.col("cum_pos_n") - F.col("pos_n")
    area = F.col("neg_n").cast("double") * (2 * tp0 + F.col("pos_n")) / 2.0
    return c.agg(_share_of_square(area).alias("roc_auc"))


def pr_curve(pred: DataFrame, positive=1, n_buckets: int | None = None) -> DataFrame:
    """E5: precision and recall per threshold, plus the final (recall 0,
    precision 1) point."""
    c = _curve_base(pred, positive, n_buckets)
    pts = c.select(F.col("score").alias("threshold"),
                   _ratio(F.col("cum_pos_n"), F.col("cum_pos_n") + F.col("cum_neg_n")).alias("precision"),
                   _ratio(F.col("cum_pos_n"), F.col("P")).alias("recall"))
    end = pred.sparkSession.createDataFrame([(float("inf"), 1.0, 0.0)], "threshold double, precision double, recall double")
    return pts.unionByName(end)


def average_precision(pred: DataFrame, positive=1, n_buckets: int | None = None) -> DataFrame:
    """AP = sum over thresholds of (R_n - R_{n-1}) * P_n, in double."""
    c = _curve_base(pred, positive, n_buckets)
    prec = _ratio(F.col("cum_pos_n"), F.col("cum_pos_n") + F.col("cum_neg_n"))
    step = F.try_divide(F.col("pos_n").cast("double"), F.col("P").cast("double"))  # recall gained at this threshold
    return c.agg(F.sum(step * prec).alias("average_precision"))


def curve_summary(pred: DataFrame, positive=1, n_buckets: int | None = None) -> DataFrame:
    """E4 + E6 in one aggregation over one running-sum table:
    ``roc_auc`` and ``average_precision``."""
    c = _curve_base(pred, positive, n_buckets)
    tp0 = F.col("cum_pos_n") - F.col("pos_n")
    area = F.col("neg_n").cast("double") * (2 * tp0 + F.col("pos_n")) / 2.0
    prec = _ratio(F.col("cum_pos_n"), F.col("cum_pos_n") + F.col("cum_neg_n"))
    return c.agg(_share_of_square(area).alias("roc_auc"),
                 F.sum(F.try_divide(F.col("pos_n").cast("double"), F.col("P").cast("double")) * prec).alias("average_precision"))


def evaluate(pred: DataFrame, positive=1, classes=None) -> dict[str, DataFrame]:
    """E1-E6 as a dict of tables."""
    cm = confusion(pred, classes)
    return {"accuracy": accuracy(pred), "confusion": cm, "report": class_report(cm),
            "roc_auc": roc_auc(pred, positive), "average_precision": average_precision(pred, positive),
            "roc": roc_curve(pred, positive), "pr": pr_curve(pred, positive)}


def accuracy_by(pred: DataFrame, by) -> DataFrame:
    """Accuracy and rows per group (e.g. niche)."""
    by = [by] if isinstance(by, str) else list(by)
    return pred.groupBy(*by).agg(
        F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("accuracy"),
        F.count(F.lit(1)).alias("n"))


def report_by(pred: DataFrame, by) -> DataFrame:
    """The E2 report of every group, from one pass over the rows."""
    by = [by] if isinstance(by, str) else list(by)
    return class_report(confusion_counts(pred, by), by)
