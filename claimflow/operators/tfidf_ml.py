"""F5 as Spark ML stages: an estimator and its model for ``Pipeline``.

Both write and load themselves by their params (S6): the fitted vocabulary with
its counts and idf is a param of the model, so ``PipelineModel.load`` gives back a
model that makes the same vectors.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, SparkSession

from claimflow.functions.stopwords import ENGLISH_STOP_WORDS
from claimflow.operators.features import TfidfModel, add_terms, fit_tfidf

_TERMS = "_tfidf_terms"


class _TfidfParams(HasInputCol, HasOutputCol):
    minDF = Param(Params._dummy(), "minDF", "least number of rows that hold a term", TypeConverters.toInt)
    maxDF = Param(Params._dummy(), "maxDF", "largest share of rows that hold a term", TypeConverters.toFloat)
    vocabSize = Param(Params._dummy(), "vocabSize", "most frequent terms to keep; 0 keeps all", TypeConverters.toInt)
    stopWords = Param(Params._dummy(), "stopWords", "words that are no terms", TypeConverters.toListString)

    def _defaults(self) -> None:
        self._setDefault(inputCol="text_processed", outputCol="features", minDF=3, maxDF=0.95, vocabSize=10_000, stopWords=list(ENGLISH_STOP_WORDS))


class TfidfEstimator(Estimator, _TfidfParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits the vocabulary of uni- and bigrams on a text column. A null text is
    a row without terms; no rows give an empty vocabulary."""

    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._set(**params)

    def _fit(self, dataset: DataFrame) -> TfidfVectorModel:
        stops = self.getOrDefault(self.stopWords)
        docs = add_terms(dataset.select(self.getInputCol()), self.getInputCol(), _TERMS, stops).select(_TERMS)
        fitted = fit_tfidf(docs, terms_col=_TERMS, min_df=self.getOrDefault(self.minDF), max_df=self.getOrDefault(self.maxDF),
                           max_features=self.getOrDefault(self.vocabSize) or None, stop_words=stops)
        return self._copyValues(TfidfVectorModel.of(fitted))


class TfidfVectorModel(Model, _TfidfParams, DefaultParamsReadable, DefaultParamsWritable):
    """A fitted vocabulary; ``transform`` adds the sparse vector column."""

    terms = Param(Params._dummy(), "terms", "terms in column order", TypeConverters.toListString)
    idf = Param(Params._dummy(), "idf", "idf in column order", TypeConverters.toListFloat)
    rowCounts = Param(Params._dummy(), "rowCounts", "rows that hold a term", TypeConverters.toListInt)
    counts = Param(Params._dummy(), "counts", "occurrences of a term", TypeConverters.toListInt)
    nDocs = Param(Params._dummy(), "nDocs", "rows of the fit", TypeConverters.toInt)

    def __init__(self, **params):
        super().__init__()
        self._defaults()
        self._set(**params)

    @classmethod
    def of(cls, fitted: TfidfModel) -> TfidfVectorModel:
        rows = sorted(fitted.vocab.collect(), key=lambda r: r["idx"])
        return cls(terms=list(fitted.terms), idf=list(fitted.idf), rowCounts=[r["df"] for r in rows], counts=[r["cf"] for r in rows],
                   nDocs=fitted.n_docs, stopWords=list(fitted.stop_words))

    def fitted(self, spark: SparkSession, doc_col: str = "doc_id", terms_col: str = "terms") -> TfidfModel:
        """The vocabulary as the library's own operators take it."""
        terms, idf, df, cf = (self.getOrDefault(p) for p in (self.terms, self.idf, self.rowCounts, self.counts))
        vocab = spark.createDataFrame([(t, i, d, c, w) for i, (t, d, c, w) in enumerate(zip(terms, df, cf, idf))],
                                      "term string, idx int, df long, cf long, idf double")
        return TfidfModel(vocab, terms, idf, self.getOrDefault(self.nDocs), doc_col, terms_col, tuple(self.getOrDefault(self.stopWords)))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        rows = add_terms(dataset, self.getInputCol(), _TERMS, self.getOrDefault(self.stopWords))
        return self.fitted(dataset.sparkSession, terms_col=_TERMS).vectors(rows, self.getOutputCol()).drop(_TERMS)
