"""Scoring (C1-C4, C6): texts in, predictions out, one row per input row.

The scorer is map-only and stays in the JVM: clean, tokenize, count the known
terms, then a two-class linear model is a sum over the row's sparse counts with the
idf and the coefficients as constants of the plan; models of many niches are
dispatched per row in the same pass. Other Spark ML models get the row's vector.
No key is needed, so repeated or null keys are scored alone, and nothing is
cached. Rows whose cleaned text has no tokens are not dropped: they get
``Unknown`` with confidence 0.0 and equal class probabilities (C2).
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.functions.text import clean_text, evaluate_once, join_tokens, tokenize
from claimflow.operators.aggregates import prediction_summary
from claimflow.operators.features import TfidfModel, add_terms, term_frequencies
from claimflow.sources.io import read_csv, write_table

UNKNOWN = "Unknown"
EMPTY_TEXT_ERROR = "Empty text after preprocessing"
NO_MODEL_ERROR = "no trained model for niche "


@dataclass
class Scorer:
    """A fitted vectorizer, a Spark ML classifier and its class names."""
    vectorizer: TfidfModel
    model: object
    classes: list
    has_probability: bool = True
    bias: bool = False  # model trained with a constant feature (penalised intercept)


def require_column(df: DataFrame, col: str) -> None:
    """Fail before planning when the text column is missing."""
    if col not in df.columns:
        raise ValueError(f"column {col!r} not found; available columns: {df.columns}")


@dataclass
class LinearModel:
    """Given coefficients of a two-class linear model, in column order."""
    coefficients: list
    intercept: float = 0.0


def linear_head(scorer: Scorer) -> tuple[list, float] | None:
    """Coefficients and intercept of a two-class linear model, else None."""
    model = scorer.model
    if len(scorer.classes) != 2 or getattr(model, "numClasses", 2) != 2 or not hasattr(model, "coefficients"):
        return None
    coefficients = [float(c) for c in getattr(model.coefficients, "toArray", lambda: model.coefficients)()]
    if scorer.bias:
        return coefficients[:-1], coefficients[-1]
    return coefficients, float(model.intercept)


def _margin(terms: list, vectorizer: TfidfModel, coefficients: list, intercept: float) -> Column:
    """Coefficients times normalised weights plus intercept, from ``_tf`` counts
    over ``terms``; terms outside the vectorizer's vocabulary weigh nothing."""
    at = {t: i for i, t in enumerate(vectorizer.terms)}
    idf, coef = ([v[at[t]] if t in at else 0.0 for t in terms] for v in (vectorizer.idf, coefficients))
    idf, coef = (F.from_json(F.lit(json.dumps(v)), "array<double>") for v in (idf, coef))

    def add(total, e):
        w = (1.0 + F.log(e["n"])) * F.get(idf, e["i"])
        return F.struct((total["dot"] + w * F.get(coef, e["i"])).alias("dot"), (total["sq"] + w * w).alias("sq"))
    entries = F.arrays_zip(F.col("_tf.indices").alias("i"), F.col("_tf.values").alias("n"))
    return F.aggregate(entries, F.struct(F.lit(0.0).alias("dot"), F.lit(0.0).alias("sq")), add,
                       lambda t: F.lit(float(intercept)) + F.when(t["sq"] > 0, t["dot"] / F.sqrt(t["sq"])).otherwise(0.0))


def _prepared(df: DataFrame, scorer: Scorer, text_col: str) -> DataFrame:
    x = evaluate_once(df, _tokens=tokenize(clean_text(text_col)))
    x = x.withColumn("_processed", join_tokens("_tokens"))
    return add_terms(x, "_processed", scorer.vectorizer.terms_col, scorer.vectorizer.stop_words)


def _outcome(scorer: Scorer) -> Column:
    """Prediction, confidence, probabilities and error of a row with ``_margin``."""
    classes, m = F.array(*[F.lit(c) for c in scorer.classes]), F.col("_margin")
    p = 1.0 / (1.0 + F.exp(-m))
    probs = F.array(1.0 - p, p)
    label = F.when(m > 0, F.lit(scorer.classes[1])).otherwise(F.lit(scorer.classes[0]))
    return _result(label, F.array_max(probs) if scorer.has_probability else None, F.map_from_arrays(classes, probs) if scorer.has_probability else None, scorer)


def _result(label: Column, confidence: Column | None, probabilities: Column | None, scorer: Scorer) -> Column:
    empty, k = F.size("_tokens") == 0, len(scorer.classes)
    even = F.map_from_arrays(F.array(*[F.lit(c) for c in scorer.classes]), F.array_repeat(F.lit(1.0 / k), k))
    known = F.lit(None).cast("map<string,double>") if probabilities is None else probabilities
    return F.struct(F.when(empty, F.lit(UNKNOWN)).otherwise(label).alias("prediction"),
                    F.when(empty, F.lit(0.0)).otherwise(F.lit(0.0) if confidence is None else confidence).alias("confidence"),
                    F.when(empty, even).otherwise(known).alias("probabilities"),
                    F.when(empty, F.lit(EMPTY_TEXT_ERROR)).alias("error"))


RESULT_COLUMNS = ("prediction", "confidence", "probabilities", "error")


def _with_result(x: DataFrame, result: Column, columns: list) -> DataFrame:
    """The input's columns (those named like a result give way) and the result."""
    return evaluate_once(x, _r=result).select(*[c for c in columns if c not in RESULT_COLUMNS], *[F.col(f"_r.{c}") for c in RESULT_COLUMNS])


def score(df: DataFrame, scorer: Scorer, key: str | None = None, text_col: str = "text") -> DataFrame:
    """Adds prediction, confidence, probabilities (map), error.
    ``key`` is accepted for older callers and not used."""
    require_column(df, text_col)
    x, head = _prepared(df, scorer, text_col), linear_head(scorer)
    if head is not None:
        terms = scorer.vectorizer.terms
        x = evaluate_once(term_frequencies(x, scorer.vectorizer.terms_col, terms), _margin=_margin(terms, scorer.vectorizer, *head))
        return _with_result(x, _outcome(scorer), df.columns)
    p = scorer.model.transform(scorer.vectorizer.vectors(x, bias=scorer.bias))
    classes = F.array(*[F.lit(c) for c in scorer.classes])
    label = F.element_at(classes, F.col("prediction").cast("int") + 1)
    probs = vector_to_array("probability") if scorer.has_probability else None
    result = _result(label, None if probs is None else F.array_max(probs), None if probs is None else F.map_from_arrays(classes, probs), scorer)
    return _with_result(p, result, df.columns)


def score_by_niche(df: DataFrame, scorers: dict[str, Scorer], text_col: str = "text", niche_col: str = "niche") -> DataFrame:
    """C6 for a table of many niches, in one map-only pass: every row is scored
    by its niche's two-class linear model, as ``score`` would. The terms of all
    models are counted once; a row then takes its own model's idf and
    coefficients. A row of a null or other niche gets ``Unknown`` and an error."""
    require_column(df, text_col)
    require_column(df, niche_col)
    if not scorers:
        raise ValueError("no models to score with")
    heads = {n: linear_head(s) for n, s in scorers.items()}
    if any(h is None for h in heads.values()):
        raise ValueError("score_by_niche takes two-class linear models only")
    first = next(iter(scorers.values()))
    if any(tuple(s.vectorizer.stop_words or ()) != tuple(first.vectorizer.stop_words or ()) for s in scorers.values()):
        raise ValueError("the models' stop words differ")
    terms = sorted(set().union(*(s.vectorizer.terms for s in scorers.values())), key=str.encode)
    x = term_frequencies(_prepared(df, first, text_col), first.vectorizer.terms_col, terms)
    margin, result = F.lit(None).cast("double"), F.struct(
        F.lit(UNKNOWN).alias("prediction"), F.lit(0.0).alias("confidence"), F.lit(None).cast("map<string,double>").alias("probabilities"),
        F.concat(F.lit(NO_MODEL_ERROR), F.coalesce(F.col(niche_col).cast("string"), F.lit("null"))).alias("error"))
    for n, s in scorers.items():
        mine = F.col(niche_col) == F.lit(n)
        margin = F.when(mine, _margin(terms, s.vectorizer, *heads[n])).otherwise(margin)
        result = F.when(mine, _outcome(s)).otherwise(result)
    return _with_result(evaluate_once(x, _margin=margin), result, df.columns)


def with_class_columns(scored: DataFrame, classes: list) -> DataFrame:
    """C4: one ``prob_<class>`` column per class from the probability map."""
    return scored.withColumns({f"prob_{c}": F.element_at("probabilities", F.lit(c)) for c in classes})


def pick_model(models: DataFrame, niche: str) -> str:
    """Path of the model saved for a niche; a clear error when missing."""
    row = models.where(F.col("niche") == niche).select("path").first()
    if row is None:
        raise FileNotFoundError(f"no trained model for niche {niche!r}")
    return row["path"]


def score_file(spark: SparkSession, source: str, sink: str, scorer: Scorer, text_col: str = "text", schema: T.StructType | None = None,
               fmt: str | None = None, sink_format: str = "csv") -> DataFrame:
    """C4: score a file and save it, from end to end. ``source`` is a CSV with a
    header (its columns are strings unless ``schema`` says otherwise) or Parquet;
    every input column stays, and prediction, confidence, error and one
    ``prob_<class>`` column per class are added. A missing text column is an
    error that lists the columns, before anything is read. Null texts are empty
    ones (C2). Returns the summary (A4): rows, mean confidence and share per
    prediction."""
    kind = fmt or ("parquet" if source.rstrip("/").endswith(".parquet") else "csv")
    if kind == "csv" and schema is None:
        names = spark.read.option("header", "true").csv(source).columns      # the header line alone
        schema = T.StructType([T.StructField(c, T.StringType()) for c in names])
    df = read_csv(spark, source, schema) if kind == "csv" else (spark.read.schema(schema) if schema else spark.read).parquet(source)
    require_column(df, text_col)
    out = with_class_columns(score(df, scorer, text_col=text_col), scorer.classes).drop("probabilities")
    write_table(out, sink, partition_by=(), fmt=sink_format)
    saved = spark.read.parquet(sink) if sink_format == "parquet" else read_csv(spark, sink, out.schema)
    return prediction_summary(saved)
