"""TF-IDF features.

Weights follow the original vectorizer: sublinear tf ``1 + ln(tf)`` times
smooth idf ``ln((1 + n) / (1 + df)) + 1``, L2-normalised per document, over
unigrams and bigrams built after stop-word removal. The vocabulary keeps
terms with ``df >= min_df`` and ``df <= max_df * n``, then the
``max_features`` terms of highest corpus frequency (ties by term);
column indices are the alphabetical order of the kept terms.

Plan shape: with ``max_features`` the occurrences are first counted by the terms'
64-bit hashes alone, which bounds every term's count from above. The terms whose
hash is counted often enough are then counted exactly, and these counts prove that
no other term belongs to the vocabulary; if they don't, more terms are counted. So
the long tail of terms is never shuffled or compared as strings. Both term counts,
per fold too, and the number of rows come out of one aggregation by term (partial
counts before the shuffle; documents never move); a fold's vocabulary is the total
less the fold's own counts. Vectors are made row by row in the JVM: Spark ML's count vectorizer
looks the terms up, and array functions weigh its sparse counts with the idf, a
constant of the plan. The vocabulary is small by ``max_features`` and lives on the
driver and each executor, as the models' coefficients do; no key is needed, so
repeated or null keys change nothing.
"""

from __future__ import annotations

import json
import math
import uuid
from dataclasses import dataclass, field

from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.functions.stopwords import ENGLISH_STOP_WORDS
from claimflow.functions.text import evaluate_once
from claimflow.session import scratch_path, write_stage

MODEL_TOKEN_PATTERN = r"[a-z0-9_]{2,}"
UNFITTED = "no vocabulary yet: must be fitted first"


def model_tokens(text, stop_words=ENGLISH_STOP_WORDS) -> Column:
    """lower-case word tokens of two or more characters minus stop words."""
    c = F.col(text) if isinstance(text, str) else text
    toks = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(MODEL_TOKEN_PATTERN), F.lit(0))
    if not stop_words:
        return toks
    return F.filter(toks, lambda t: ~t.isin(list(stop_words)))


def ngrams_1_2(tokens) -> Column:
    """unigrams followed by adjacent bigrams (``zip_with`` of two slices)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    m = F.greatest(F.size(t) - 1, F.lit(0))
    bigrams = F.zip_with(F.slice(t, 1, m), F.slice(t, 2, m), lambda a, b: F.concat(a, F.lit(" "), b))
    return F.concat(t, bigrams)


VECTOR_SCHEMA = T.StructType([T.StructField("v", VectorUDT())])


def sparse_struct(size: int, indices: Column, values: Column) -> Column:
    """The struct that a sparse vector is stored as."""
    return F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), indices.alias("indices"), values.alias("values"))


def as_vector(struct: Column) -> Column:
    """A stored vector as a vector column. Spark casts no struct to a vector;
    its JSON reader takes one by the vector's own schema, digit for digit."""
    return F.from_json(F.to_json(F.struct(struct.alias("v"))), VECTOR_SCHEMA)["v"]


def write_vectors(df: DataFrame, size: int, indices: Column, values: Column, keep: list, name: str, out: str = "features") -> DataFrame:
    """``keep`` columns and a sparse vector column, as a written table: a stored
    struct is read back as the vector it is, without a conversion."""
    path = scratch_path(df.sparkSession, f"{name}-{uuid.uuid4().hex}")
    rows = df.select(*keep)
    df.select(*keep, sparse_struct(size, indices, values).alias(out)).write.parquet(path)
    return df.sparkSession.read.schema(T.StructType([*rows.schema.fields, T.StructField(out, VectorUDT())])).parquet(path)


def term_frequencies(docs: DataFrame, terms_col: str, vocabulary: list) -> DataFrame:
    """Adds ``_tf``, the sparse counts of the row's known terms as a struct with
    ``indices`` and ``values``; a null row of terms has none."""
    counts = CountVectorizerModel.from_vocabulary(vocabulary or [""], inputCol="_known", outputCol="_counts")
    known = docs.withColumn("_known", F.coalesce(F.col(terms_col), F.array().cast("array<string>")))
    return evaluate_once(counts.transform(known), _tf=F.unwrap_udt("_counts")).drop("_known", "_counts")


def _constant(values: list, kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(values)), f"array<{kind}>")


@dataclass
class TfidfModel:
    """A fitted vocabulary: ``vocab(term, idx, df, cf, idf)``, its terms and
    idf in column order, ``n_docs``, and the stop words its terms came from."""
    vocab: DataFrame
    terms: list
    idf: list
    n_docs: int
    doc_col: str = "doc_id"
    terms_col: str = "terms"
    stop_words: tuple = field(default=ENGLISH_STOP_WORDS)

    @property
    def size(self) -> int:
        return len(self.terms)

    def weighed(self, docs: DataFrame) -> DataFrame:
        """Adds ``_tf`` (``term_frequencies``) and ``_weights``, the normalised
        weights of its indices."""
        idf = _constant(self.idf, "double")
        x = term_frequencies(docs, self.terms_col, self.terms)
        x = evaluate_once(x, _raw=F.zip_with("_tf.indices", "_tf.values", lambda i, n: (1.0 + F.log(n)) * F.get(idf, i)))
        norm = F.sqrt(F.aggregate("_raw", F.lit(0.0), lambda total, w: total + w * w))
        x = evaluate_once(x, _norm=norm)
        return x.withColumn("_weights", F.transform("_raw", lambda w: w / F.col("_norm"))).drop("_raw", "_norm")

    def vectors(self, docs: DataFrame, out: str = "features", bias: bool = False) -> DataFrame:
        """F8: ``docs`` (with its terms column) plus one sparse vector per
        row; unseen terms are ignored, a row without known terms gets zeros.
        ``bias`` adds a constant 1.0 in the last column (penalised intercept)."""
        x, indices, values = self.weighed(docs), F.col("_tf.indices"), F.col("_weights")
        if bias:
            indices, values = F.concat(indices, F.array(F.lit(self.size))), F.concat(values, F.array(F.lit(1.0)))
        return x.withColumn(out, as_vector(sparse_struct(self.size + bias, indices, values))).drop("_tf", "_weights")

    def transform(self, docs: DataFrame, doc_col: str | None = None) -> DataFrame:
        """F4/F5 long form: (doc, term, idx, tf, weight); rows without known
        terms have none. Columns of ``docs`` other than the terms stay."""
        terms = _constant(self.terms, "string")
        key = doc_col or self.doc_col
        keep = [key] + [c for c in docs.columns if c not in (self.terms_col, key)]
        entries = F.transform(F.arrays_zip(F.col("_tf.indices").alias("i"), F.col("_tf.values").alias("n"), F.col("_weights").alias("w")), lambda e: F.struct(
            F.get(terms, e["i"]).alias("term"), e["i"].alias("idx"), e["n"].cast("long").alias("tf"), e["w"].alias("weight")))
        return self.weighed(docs).select(*keep, F.inline(entries))

    def feature_names(self) -> DataFrame:
        """terms in column order."""
        return self.vocab.select("idx", "term").orderBy("idx")


def term_stats(docs: DataFrame, terms_col: str = "terms", fold_col: str | None = None, n_folds: int = 0, min_df: int = 1,
               hashes: DataFrame | None = None) -> DataFrame:
    """``term, df, cf`` of all rows, and ``df_k, cf_k`` of the rows of each fold
    k: every term counts for ``cf``, every distinct term of a row for ``df``.
    Each row also counts once for the null term, so that term's ``df`` is the
    number of rows. Terms of fewer than ``min_df`` rows are left out, and those
    whose hash (``h``) is not in ``hashes`` where that is given. One read of the
    rows, one aggregation with partial sums."""
    def entry(t, d, c):
        return F.struct(t.alias("term"), F.lit(d).alias("d"), F.lit(c).alias("c"))
    fold = [F.col(fold_col).alias("fold")] if fold_col else []
    terms = F.coalesce(F.col(terms_col), F.array().cast("array<string>"))
    if hashes is None:
        entries = F.concat(F.array(entry(F.lit(None).cast("string"), 1, 0)), F.transform(terms, lambda t: entry(t, 0, 1)),
                           F.transform(F.array_distinct(terms), lambda t: entry(t, 1, 0)))
        rows = docs.select(*fold, F.inline(entries))
    else:
        # Sorted, a row's first occurrence of a term differs from the entry before it.
        x = evaluate_once(docs.select(*fold, F.sort_array(terms).alias("_s")), _terms=F.col("_s")).drop("_s")
        x = x.select(*fold, F.inline(F.transform("_terms", lambda t, i: F.struct(
            t.alias("term"), F.when((i > 0) & F.get("_terms", i - 1).eqNullSafe(t), 0).otherwise(1).alias("d"), F.lit(1).alias("c")))))
        rows = x.withColumn("h", F.xxhash64("term")).join(hashes, "h", "left_semi").drop("h")
        rows = rows.unionByName(docs.select(*fold, F.lit(None).cast("string").alias("term"), F.lit(1).alias("d"), F.lit(0).alias("c")))
    sums = [F.sum("d").alias("df"), F.sum("c").alias("cf")]
    for k in range(n_folds):
        mine = F.col("fold") == k
        sums += [F.sum(F.when(mine, F.col("d")).otherwise(0)).alias(f"df_{k}"), F.sum(F.when(mine, F.col("c")).otherwise(0)).alias(f"cf_{k}")]
    return rows.groupBy("term").agg(*sums).where(F.col("term").isNull() | (F.col("df") >= min_df))


def cutoff(counts: DataFrame, n: int) -> tuple[int, int] | None:
    """The ``n``-th largest ``cf`` and how many rows of that value are among the
    ``n``; none if there are no more rows than that. Counts per logarithmic bucket
    and then per value find it, so no task merges whole top lists."""
    bucketed = counts.withColumn("_b", F.floor(F.log2("cf") * 8))
    left = n
    for b, size in sorted(((r["_b"], r["count"]) for r in bucketed.groupBy("_b").count().collect()), reverse=True):
        if size <= left:
            left -= size
            continue
        for cf, ties in sorted(((r["cf"], r["count"]) for r in bucketed.where(F.col("_b") == b).groupBy("cf").count().collect()), reverse=True):
            if ties > left:
                return cf, left
            left -= ties
    return None


def most_frequent(stats: DataFrame, n: int) -> DataFrame:
    """The ``n`` rows of highest ``cf``, ties by term; only the rows at the cutoff
    itself are ordered by term."""
    at = cutoff(stats, n)
    if at is None:
        return stats
    return stats.where(F.col("cf") > at[0]).unionByName(stats.where(F.col("cf") == at[0]).orderBy("term").limit(at[1]))


def frequent_stats(docs: DataFrame, terms_col: str, fold_col: str | None, n_folds: int, min_df: int, max_df: float, max_features: int | None) -> DataFrame:
    """Written ``term_stats`` of all terms that a vocabulary of ``max_features``
    can hold, that of all rows or of those outside one fold. Occurrences per hash
    bound a term's count from above, so a term outside the counted hashes occurs
    less than the cutoff; that many eligible terms at or over it prove the choice."""
    if max_features is None:
        return write_stage(term_stats(docs, terms_col, fold_col, n_folds, min_df), "term-stats")
    hashes = docs.select(F.explode(F.transform(terms_col, lambda t: F.xxhash64(t))).alias("h"))
    bounds = write_stage(hashes.groupBy("h").agg(F.count(F.lit(1)).alias("cf")).where(F.col("cf") >= min_df), "term-bounds")
    n = 2 * max(max_features, 1)
    while True:
        at = cutoff(bounds, n)
        least = at[0] if at else 0
        held = write_stage(bounds.where(F.col("cf") >= least).select("h"), "term-hashes")
        stats = write_stage(term_stats(docs, terms_col, fold_col, n_folds, min_df, held), "term-stats")
        if at is None or _proven(stats, n_folds, min_df, max_df, max_features, least):
            return stats
        n *= 4


def _proven(stats: DataFrame, n_folds: int, min_df: int, max_df: float, max_features: int, least: int) -> bool:
    counts = [(F.col("df"), F.col("cf")), *[(F.col("df") - F.col(f"df_{k}"), F.col("cf") - F.col(f"cf_{k}")) for k in range(n_folds)]]
    rows = stats.where("term is null").select(*[df.alias(str(i)) for i, (df, _) in enumerate(counts)]).first()
    if rows is None:
        return True
    sure = stats.where("term is not null").select(*[F.count_if((df >= min_df) & (df <= F.lit(max_df * n)) & (cf >= least)) for (df, cf), n in zip(counts, rows)])
    return all(n >= max_features for n in sure.first())


def model_of_stats(stats: DataFrame, min_df: int = 3, max_df: float = 0.95, max_features: int | None = 10_000, fold: int | None = None,
                   doc_col: str = "doc_id", terms_col: str = "terms", stop_words=ENGLISH_STOP_WORDS) -> TfidfModel:
    """F3 on written ``term_stats``: the vocabulary of all rows or, with ``fold``,
    of the rows outside that fold (the totals less the fold's counts)."""
    df, cf = (F.col(c) if fold is None else F.col(c) - F.col(f"{c}_{fold}") for c in ("df", "cf"))
    counts = stats.select("term", df.alias("df"), cf.alias("cf"))
    rows = counts.where("term is null").first()
    n_docs = rows["df"] if rows else 0
    kept = counts.where(F.col("term").isNotNull() & (F.col("df") >= min_df) & (F.col("df") <= F.lit(max_df * n_docs)))
    if max_features is not None:
        kept = most_frequent(kept, max_features)
    rows = [(r["term"], i, r["df"], r["cf"], math.log((1.0 + n_docs) / (1.0 + r["df"])) + 1.0)
            for i, r in enumerate(sorted(kept.collect(), key=lambda r: r["term"].encode()))]
    vocab = stats.sparkSession.createDataFrame(rows, "term string, idx int, df long, cf long, idf double")
    return TfidfModel(vocab, [r[0] for r in rows], [r[4] for r in rows], n_docs, doc_col, terms_col, tuple(stop_words or ()))


def fit_tfidf(docs: DataFrame, doc_col: str = "doc_id", terms_col: str = "terms", min_df: int = 3,
              max_df: float = 0.95, max_features: int | None = 10_000, stop_words=ENGLISH_STOP_WORDS) -> TfidfModel:
    """fit the vocabulary on ``docs`` (the training split only). Without
    ``max_features`` all kept terms count."""
    stats = frequent_stats(docs, terms_col, None, 0, min_df, max_df, max_features)
    return model_of_stats(stats, min_df, max_df, max_features, None, doc_col, terms_col, stop_words)


def fit_fold_models(docs: DataFrame, fold_col: str, n_folds: int, doc_col: str = "doc_id", terms_col: str = "terms", min_df: int = 3,
                    max_df: float = 0.95, max_features: int | None = 10_000, stop_words=ENGLISH_STOP_WORDS) -> tuple[TfidfModel, list[TfidfModel]]:
    """The vocabulary of all rows and, for every fold, that of the other
    folds' rows, all from the same counts over ``docs``."""
    stats = frequent_stats(docs, terms_col, fold_col, n_folds, min_df, max_df, max_features)
    models = [model_of_stats(stats, min_df, max_df, max_features, k, doc_col, terms_col, stop_words) for k in (None, *range(n_folds))]
    return models[0], models[1:]


def add_terms(df: DataFrame, text_col: str = "text_processed", out: str = "terms",
              stop_words=ENGLISH_STOP_WORDS) -> DataFrame:
    """F1+F2 as a column of model terms (the token regex runs once per row)."""
    x = evaluate_once(df, _mt=model_tokens(text_col, stop_words))
    return x.withColumn(out, ngrams_1_2("_mt")).drop("_mt")


def label_classes(df: DataFrame, label_col: str = "label") -> list:
    """The class list: sorted distinct labels, which a model holds anyway."""
    return sorted(r[0] for r in df.select(label_col).where(F.col(label_col).isNotNull()).distinct().collect())


def encode_labels(df: DataFrame, label_col: str = "label", out: str = "label_idx",
                  classes: list | None = None) -> tuple[DataFrame, list]:
    """alphabetical label codes; returns the frame and the class list.
    A null or unlisted label has no code."""
    classes = label_classes(df, label_col) if classes is None else classes
    codes = F.from_json(F.lit(json.dumps({str(c): float(i) for i, c in enumerate(classes)})), "map<string,double>")
    return df.withColumn(out, F.try_element_at(codes, F.col(label_col).cast("string"))), classes


def decode_labels(df: DataFrame, classes: list, idx_col: str = "prediction", out: str = "label_name") -> DataFrame:
    arr = F.array(*[F.lit(c) for c in classes])
    return df.withColumn(out, F.element_at(arr, F.col(idx_col).cast("int") + 1))


class TfidfVectorizer:
    """estimator-style wrapper (fit / transform / fit_transform) with
    the original defaults: uni+bigrams, min_df 3, max_df 0.95, 10,000 terms.
    ``transform`` before ``fit`` is an error."""

    def __init__(self, max_features: int | None = 10_000, ngram_range=(1, 2), min_df: int = 3,
                 max_df: float = 0.95, doc_col: str = "doc_id", text_col: str = "text_processed",
                 stop_words=ENGLISH_STOP_WORDS):
        if tuple(ngram_range) != (1, 2):
            raise ValueError("only unigrams + bigrams (ngram_range=(1, 2)) are supported")
        self.max_features, self.ngram_range = max_features, tuple(ngram_range)
        self.min_df, self.max_df = min_df, max_df
        self.doc_col, self.text_col, self.stop_words = doc_col, text_col, stop_words
        self.model: TfidfModel | None = None

    @property
    def is_fitted(self) -> bool:
        return self.model is not None

    def _terms(self, df: DataFrame) -> DataFrame:
        return add_terms(df, self.text_col, "terms", self.stop_words)

    def fit(self, df: DataFrame) -> "TfidfVectorizer":
        self.model = fit_tfidf(self._terms(df).select(self.doc_col, "terms"), self.doc_col, "terms",
                               self.min_df, self.max_df, self.max_features, self.stop_words)
        return self

    def transform(self, df: DataFrame) -> DataFrame:
        """Long-form (doc, term, idx, tf, weight)."""
        if not self.is_fitted:
            raise ValueError(UNFITTED)
        return self.model.transform(self._terms(df).select(self.doc_col, "terms"), self.doc_col)

    def fit_transform(self, df: DataFrame) -> DataFrame:
        return self.fit(df).transform(df)

    def feature_names(self) -> DataFrame:
        if not self.is_fitted:
            raise ValueError(UNFITTED)
        return self.model.feature_names()
