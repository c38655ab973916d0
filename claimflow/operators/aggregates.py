"""Grouped summaries (A1-A6) used by training, evaluation and scoring."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def class_counts(df: DataFrame, label_col: str = "label", by=()) -> DataFrame:
    """A1/A2: rows per (by..., label)."""
    return df.groupBy(*by, label_col).agg(F.count(F.lit(1)).alias("n"))


def balanced_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """A3: ``weight = n / (k * n_c)`` per class (one row per class)."""
    counts = df.groupBy(label_col).agg(F.count(F.lit(1)).alias("n_c"))
    everything = Window.partitionBy()  # k rows: the classes
    return counts.withColumn(
        "weight", F.sum("n_c").over(everything).cast("double")
        / (F.count(F.lit(1)).over(everything) * F.col("n_c")))


def with_balanced_weights(df: DataFrame, label_col: str = "label", out: str = "weight") -> DataFrame:
    """Attach the class weight to every row, as a constant per class (the
    classes of a model)."""
    rows = balanced_weights(df.where(F.col(label_col).isNotNull()), label_col).collect()
    weight = F.lit(None).cast("double")
    for r in rows:
        weight = F.when(F.col(label_col) == F.lit(r[label_col]), F.lit(float(r["weight"]))).otherwise(weight)
    return df.where(F.col(label_col).isNotNull()).withColumn(out, weight)


def prediction_summary(scored: DataFrame, pred_col: str = "prediction",
                       conf_col: str = "confidence") -> DataFrame:
    """A4: count and share per predicted class plus mean confidence."""
    per = scored.groupBy(pred_col).agg(F.count(F.lit(1)).alias("n"),
                                       F.avg(conf_col).alias("mean_confidence"))
    everything = Window.partitionBy()
    return per.withColumn("share", F.col("n") / F.sum("n").over(everything))


def top_terms(coefs: DataFrame, n: int = 20, coef_col: str = "coef") -> DataFrame:
    """The ``n`` largest and ``n`` smallest coefficients with their
    terms. The largest belong to class code 1 (the original swapped them)."""
    top = coefs.orderBy(F.col(coef_col).desc(), "term").limit(n).withColumn("side", F.lit("class_1"))
    bottom = coefs.orderBy(F.col(coef_col).asc(), "term").limit(n).withColumn("side", F.lit("class_0"))
    w = Window.partitionBy("side").orderBy(F.abs(F.col(coef_col)).desc(), "term")
    return top.unionByName(bottom).withColumn("rank", F.row_number().over(w))


def fold_score_stats(scores: DataFrame, by=("model",), score_col: str = "f1") -> DataFrame:
    """Mean and population std of fold scores."""
    return scores.groupBy(*by).agg(F.avg(score_col).alias("cv_mean"),
                                   F.stddev_pop(score_col).alias("cv_std"))
