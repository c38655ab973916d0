"""Sources and sinks (S1-S3, S5-S8) with explicit schemas.

CSV text carries newlines and doubled quotes, so CSV reads use
``multiLine`` and ``escape='"'``; writes use the same quoting so a round
trip is lossless. Parquet is the default sink, partitioned by a column
(niche, split) so later reads prune partitions.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
               "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}

LABELED_SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in (
    "id", "text", "label", "source", "url", "date", "niche", "heuristics", "title", "domain_type")])

# The 14 columns of the six-label statement files (no header).
STATEMENT_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()), T.StructField("label", T.StringType()),
    T.StructField("statement", T.StringType()), T.StructField("subject", T.StringType()),
    T.StructField("speaker", T.StringType()), T.StructField("job_title", T.StringType()),
    T.StructField("state_info", T.StringType()), T.StructField("party_affiliation", T.StringType()),
    T.StructField("barely_true_count", T.DoubleType()), T.StructField("false_count", T.DoubleType()),
    T.StructField("half_true_count", T.DoubleType()), T.StructField("mostly_true_count", T.DoubleType()),
    T.StructField("pants_on_fire_count", T.DoubleType()), T.StructField("context", T.StringType()),
])
STATEMENT_SPLITS = ("train", "valid", "test")

SUMMARY_SCHEMA = T.StructType([
    T.StructField("niche", T.StringType()),
    T.StructField("samples_per_class", T.MapType(T.StringType(), T.LongType())),
    T.StructField("test_macro_f1", T.DoubleType()),
    T.StructField("test_accuracy", T.DoubleType()),
    T.StructField("per_class", T.MapType(T.StringType(), T.StructType([
        T.StructField("precision", T.DoubleType()), T.StructField("recall", T.DoubleType()),
        T.StructField("f1", T.DoubleType())]))),
    T.StructField("positive_label", T.StringType()),
    T.StructField("negative_label", T.StringType()),
])


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Header CSV with quoted multi-line fields, explicit schema. A record
    may hold line breaks, so a file can't be split: it is one task, and large
    inputs should come as many files, or better as Parquet."""
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).options(**CSV_OPTIONS).csv(path)


def read_statements(spark: SparkSession, directory: str, quote: str | None = '"') -> DataFrame:
    """The headerless 14-column TSV files per split, tagged and unioned.

    Missing split files are skipped; none at all is an error. ``quote=None``
    turns quote handling off for files with stray quote characters."""
    frames = []
    for split in STATEMENT_SPLITS:
        path = f"{directory.rstrip('/')}/{split}.tsv"
        if not _exists(spark, path):
            continue
        r = spark.read.schema(STATEMENT_SCHEMA).option("sep", "\t").option("header", "false")
        r = r.option("quote", quote) if quote else r.option("quote", "\u0000")
        frames.append(r.csv(path).withColumn("split", F.lit(split)))
    if not frames:
        raise FileNotFoundError(f"no statement split files under {directory}")
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def write_table(df: DataFrame, path: str, partition_by=("niche",), fmt: str = "parquet",
                mode: str = "overwrite") -> None:
    """S3: a result table; Parquet partitioned by niche by default, CSV on request."""
    cols = [c for c in partition_by if c in df.columns]
    if fmt == "csv":
        w = df.write.mode(mode).options(**CSV_OPTIONS)
        (w.partitionBy(*cols) if cols else w).csv(path)
        return
    w = df.write.mode(mode)
    (w.partitionBy(*cols) if cols else w).parquet(path)


def union_niches(frames: dict, warn=print) -> DataFrame:
    """Concatenate per-niche frames; missing (None) ones are skipped with
    a warning; no frame at all is an error."""
    present = {k: v for k, v in frames.items() if v is not None}
    for k in frames:
        if frames[k] is None:
            warn(f"niche {k!r} has no data; skipped")
    if not present:
        raise ValueError("no niche data found")
    it = iter(present.values())
    out = next(it)
    for f in it:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def save_vectorizer(vec, path: str) -> None:
    """A fitted vocabulary as the Spark ML model that it is."""
    from claimflow.operators.tfidf_ml import TfidfVectorModel
    TfidfVectorModel.of(vec).write().overwrite().save(path)


def load_vectorizer(spark: SparkSession, path: str, doc_col: str = "doc_id", terms_col: str = "terms"):
    from claimflow.operators.tfidf_ml import TfidfVectorModel
    return TfidfVectorModel.load(path).fitted(spark, doc_col, terms_col)


def save_models(result, path: str, niche: str) -> DataFrame:
    """Each model under ``path/<name>`` and a model table naming the best."""
    rows = []
    for name, model in result.models.items():
        mpath = f"{path}/{name}"
        model.write().overwrite().save(mpath)
        rows.append((niche, name, mpath, name == result.best))
    save_vectorizer(result.vectorizer, f"{path}/vectorizer")
    spark = result.vectorizer.vocab.sparkSession
    table = spark.createDataFrame(rows, "niche string, model string, path string, is_best boolean")
    table.write.mode("overwrite").parquet(f"{path}/models")
    return table


def load_model(path: str, name: str):
    from pyspark.ml.classification import LinearSVCModel, LogisticRegressionModel
    cls = LogisticRegressionModel if name == "logistic_regression" else LinearSVCModel
    return cls.load(path)


def append_metrics(metrics: DataFrame, path: str, niche: str, stamp: str, best: str) -> None:
    """Add per-model metrics with niche, timestamp and best model. A repeated
    call (a rerun, a retried job) replaces the rows of its niche and timestamp."""
    (metrics.withColumn("niche", F.lit(niche)).withColumn("trained_at", F.to_timestamp(F.lit(stamp)))
     .withColumn("is_best", F.col("model") == best)
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("niche", "trained_at").parquet(path))


def write_statements(df: DataFrame, directory: str) -> None:
    """S2's layout: one headerless TSV folder per split, columns in the fixed
    order (``split`` names the folder)."""
    for split in STATEMENT_SPLITS:
        part = df.where(F.col("split") == split).select(*[F.col(f.name).cast(f.dataType) for f in STATEMENT_SCHEMA.fields])
        part.write.option("sep", "\t").csv(f"{directory.rstrip('/')}/{split}.tsv")


def write_features(weights: DataFrame, path: str) -> None:
    """Long-form features partitioned by split."""
    weights.write.mode("overwrite").partitionBy("split").parquet(path)


def read_features(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_summary_json(spark: SparkSession, path: str, niche: str, samples_per_class: dict,
                       macro_f1: float, accuracy: float, per_class: dict,
                       positive_label: str, negative_label: str) -> None:
    """The per-niche summary file the results collector reads (one small
    JSON document per niche)."""
    doc = {"niche": niche, "samples_per_class": samples_per_class, "test_macro_f1": macro_f1,
           "test_accuracy": accuracy, "per_class": per_class,
           "positive_label": positive_label, "negative_label": negative_label}
    spark.createDataFrame([(json.dumps(doc),)], "v string").coalesce(1) \
        .write.mode("overwrite").text(f"{path}/{niche}")


def collect_results(spark: SparkSession, glob: str, rules=None) -> DataFrame:
    """One row per niche (macro F1, accuracy, positive, negative, total)
    plus a grand-total row. Class counts are looked up by label name, never
    by JSON key order: from the summary itself, else from the niche's rule
    set (``rules``). Pretty-printed (multi-line) documents are read too."""
    s = spark.read.schema(SUMMARY_SCHEMA).option("multiLine", "true").json(glob)
    if rules is not None:
        from claimflow.sources.rules import rule_sets_of
        for r in rule_sets_of(rules):  # keeps niches without a rule set
            hit = F.col("niche") == r.niche
            s = s.withColumn("positive_label", F.coalesce("positive_label", F.when(hit, F.lit(r.positive_label)))) \
                 .withColumn("negative_label", F.coalesce("negative_label", F.when(hit, F.lit(r.negative_label))))
    per = s.select(
        "niche", F.col("test_macro_f1").alias("macro_f1"), F.col("test_accuracy").alias("accuracy"),
        F.coalesce(F.element_at("samples_per_class", F.col("positive_label")), F.lit(0)).alias("positive"),
        F.coalesce(F.element_at("samples_per_class", F.col("negative_label")), F.lit(0)).alias("negative"))
    per = per.withColumn("total", F.col("positive") + F.col("negative"))
    total = per.agg(F.lit("TOTAL").alias("niche"), F.lit(None).cast("double").alias("macro_f1"),
                    F.lit(None).cast("double").alias("accuracy"), F.sum("positive").alias("positive"),
                    F.sum("negative").alias("negative"), F.sum("total").alias("total"))
    return per.unionByName(total)


def markdown_rows(results: DataFrame) -> DataFrame:
    """The Markdown table rows as strings."""
    f = lambda c: F.coalesce(F.format_number(c, 3), F.lit("-"))
    return results.select(F.concat_ws(" | ", "niche", f(F.col("macro_f1")), f(F.col("accuracy")),
                                      F.col("positive").cast("string"), F.col("negative").cast("string"),
                                      F.col("total").cast("string")).alias("row"))
