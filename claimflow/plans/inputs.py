"""Shared query inputs derived from the given tables by Spark.

The generated ``documents`` table has no domain type, and its sources are
``src0``..``src19``; the synthetic rule sets (see ``sources/rulesets``)
make the labeling rules fire on it. ``domain_type`` follows the test
fixture: positive, negative, unknown for ``doc_id % 3`` = 0, 1, 2.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.operators.pages import extract_pages, label_pages_input
from claimflow.sources.rules import load_rule_set
from claimflow.sources.tables import read_table

DOC_NICHE = "synthetic_documents"
PAGE_NICHE = "synthetic_pages"
LABEL_DATE = "2024-01-01"


def doc_rule_set():
    return load_rule_set(DOC_NICHE)


def page_rule_set():
    return load_rule_set(PAGE_NICHE)


def doc_rules(spark: SparkSession | None = None) -> list:
    return [doc_rule_set()]


def page_rules(spark: SparkSession | None = None) -> list:
    return [page_rule_set()]


def doc_domain_type(doc_id) -> F.Column:
    m = F.col(doc_id) % 3
    return F.when(m == 0, "positive").when(m == 1, "negative").otherwise("unknown")


def labeling_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as labeling input under the synthetic documents rule set."""
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", "text", "source",
                    doc_domain_type("doc_id").alias("domain_type"),
                    F.lit(DOC_NICHE).alias("niche"))


def page_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(read_table(spark, sf_dir, "pages"))


def labeling_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kept pages (P3) as labeling input under the synthetic pages rules."""
    kept = (page_texts(spark, sf_dir).where(F.col("success"))
            .select("page_id", "url", "title", "text", "source", F.lit(PAGE_NICHE).alias("niche")))
    return label_pages_input(kept, page_rules(spark))
