"""Weak labeling (L1-L10) as column expressions over the rule-set columns.

Input rows carry ``text``, ``source``, ``domain_type`` and ``niche``; the
rule set is attached as literal columns or a broadcast join on ``niche`` (see
``claimflow.sources.rules.with_rules``), so labeling is a map-only stage:
no shuffle, whatever the size of the text table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.functions.text import evaluate_once
from claimflow.operators.phrases import PLAIN_LIST, phrase_hits
from claimflow.sources.rules import RULE_COLUMNS, RuleSet, with_rules

UNLABELED = "unlabeled"
POSITIVE = "positive"
NEGATIVE = "negative"

# The six-verdict to binary map of the statement corpus
# (0 = accurate, 1 = inaccurate).
VERDICT_TO_BINARY = {
    "true": 0, "mostly-true": 0, "half-true": 0,
    "barely-true": 1, "false": 1, "pants-fire": 1,
}


def _hits(phrases: str, haystack: Column) -> Column:
    # Distinct list entries found as substrings, in list order (L2).
    return F.filter(F.col(phrases), lambda p: haystack.contains(p))


def _indexed(rules) -> list[RuleSet]:
    """The rule sets, when one of them has so many phrases that an index pays."""
    if isinstance(rules, DataFrame):
        return []
    sets = [rules] if isinstance(rules, RuleSet) else list(rules)
    return sets if any(max(len(r.positive_phrases), len(r.negative_phrases)) > PLAIN_LIST for r in sets) else []


def _indexed_hits(sets: list[RuleSet], side: str) -> Column:
    """L2 through each niche's phrase index."""
    hits = None
    for r in sets:
        mine = phrase_hits(F.col("_text_lower"), list(getattr(r, side)))
        hits = F.when(F.col("niche") == r.niche, mine) if hits is None else hits.when(F.col("niche") == r.niche, mine)
    return hits


def _any_domain(domains: str, source_lower: Column, match: str = "substring") -> Column:
    if match == "substring":  # the original rule: ``ew.com`` also hits ``crew.com``
        return F.exists(F.col(domains), lambda d: source_lower.contains(d))
    if match == "host_suffix":  # the host is the domain or a subdomain of it
        host = F.regexp_extract(source_lower, r"^(?:[^@/]*@)?([^:/]*)", 1)
        return F.exists(F.col(domains),
                        lambda d: (host == d) | host.endswith(F.concat(F.lit("."), d)))
    raise ValueError(f"unknown domain match {match!r}")


def score_rules(df: DataFrame, rules, match: str = "substring") -> DataFrame:
    """L1-L4 for every row: domain and phrase hits, scores, label, evidence.

    Adds ``pos_domain``/``neg_domain`` (bool), ``pos_hits``/``neg_hits``
    (array), ``positive_score``/``negative_score`` (int), ``tie`` (bool),
    ``label`` and ``heuristics`` (array of evidence strings). A null text
    scores 0 instead of failing the run. Rule sets with long phrase lists are
    searched through an index (``operators.phrases``); their lists don't become
    columns.
    """
    sets = _indexed(rules)
    x = with_rules(df, rules, [c for c in RULE_COLUMNS if not (sets and c.endswith("_phrases"))])
    text_lower = F.lower(F.coalesce(F.col("text"), F.lit("")))
    x = evaluate_once(x, _text_lower=text_lower) if sets else x.withColumn("_text_lower", text_lower)
    x = x.withColumn("_source_lower", F.lower(F.coalesce(F.col("source"), F.lit(""))))
    tl, sl = F.col("_text_lower"), F.col("_source_lower")
    if sets:
        x = evaluate_once(x, pos_hits=_indexed_hits(sets, "positive_phrases"), neg_hits=_indexed_hits(sets, "negative_phrases"))
    else:
        x = x.withColumn("pos_hits", _hits("positive_phrases", tl)).withColumn("neg_hits", _hits("negative_phrases", tl))
    x = x.withColumn("pos_domain", _any_domain("positive_domains", sl, match)) \
         .withColumn("neg_domain", _any_domain("negative_domains", sl, match))
    ps = F.when(F.col("pos_domain"), 2).otherwise(0) + F.size("pos_hits")
    ns = F.when(F.col("neg_domain"), 2).otherwise(0) + F.size("neg_hits")
    x = x.withColumn("positive_score", ps.cast("int")).withColumn("negative_score", ns.cast("int"))
    p, n, dt = F.col("positive_score"), F.col("negative_score"), F.col("domain_type")
    label = (F.when(p > n, F.col("positive_label"))
              .when(n > p, F.col("negative_label"))
              .when(dt == POSITIVE, F.col("positive_label"))
              .when(dt == NEGATIVE, F.col("negative_label"))
              .otherwise(F.lit(UNLABELED)))
    fallback = (F.when(dt == POSITIVE, F.lit("domain_type_fallback:positive"))
                 .when(dt == NEGATIVE, F.lit("domain_type_fallback:negative"))
                 .otherwise(F.lit("no_heuristics_match")))
    evidence = F.array_compact(F.array(
        F.when(F.col("pos_domain"), F.concat(F.lit("positive_domain:"), F.col("source"))),
        F.when(F.col("neg_domain"), F.concat(F.lit("negative_domain:"), F.col("source"))),
        F.when(F.size("pos_hits") > 0,
               F.concat(F.lit("positive_phrases:"), F.array_join("pos_hits", ","))),
        F.when(F.size("neg_hits") > 0,
               F.concat(F.lit("negative_phrases:"), F.array_join("neg_hits", ","))),
        F.when(p == n, fallback),
    ))
    return (x.withColumn("tie", p == n)
             .withColumn("label", label)
             .withColumn("heuristics", evidence)
             .drop("_text_lower", "_source_lower"))


def label_dataset(df: DataFrame, rules, key: str, date: str, match: str = "substring") -> DataFrame:
    """The labeled-sample table.

    ``id`` is ``<niche>_<key>`` from a stable input key (never a row
    position); ``date`` is a parameter (``yyyy-MM-dd``), not the clock.
    """
    x = score_rules(df, rules, match)
    title = F.coalesce(F.col("title"), F.lit("")) if "title" in df.columns else F.lit("")
    url = F.col("url") if "url" in df.columns else F.lit(None).cast("string")
    return x.select(
        F.concat(F.col("niche"), F.lit("_"), F.col(key).cast("string")).alias("id"),
        F.col(key), "text", "label", "source", url.alias("url"),
        F.to_date(F.lit(date)).alias("date"), "niche", "heuristics",
        title.alias("title"), "domain_type", "positive_score", "negative_score", "tie",
        "pos_domain", "neg_domain", "pos_hits", "neg_hits",
        "positive_label", "negative_label",
    )


def heuristics_string(col="heuristics") -> Column:
    """The sink form of the evidence list: entries joined by ``|``."""
    return F.array_join(F.col(col), "|")


def labeling_stats(labeled: DataFrame) -> DataFrame:
    """Counts per niche in one aggregation (partial aggregation per task).

    Conflicts count rows where *both domain* sides hit.
    """
    return labeled.groupBy("niche").agg(
        F.count(F.lit(1)).alias("total_samples"),
        F.count_if(F.col("label") == F.col("positive_label")).alias("positive_labeled"),
        F.count_if(F.col("label") == F.col("negative_label")).alias("negative_labeled"),
        F.count_if(F.col("label") == UNLABELED).alias("unlabeled"),
        F.count_if(F.col("pos_domain") & F.col("neg_domain")).alias("conflicts"),
        F.count_if(F.col("pos_domain") | F.col("neg_domain")).alias("domain_matches"),
        F.count_if((F.size("pos_hits") + F.size("neg_hits")) > 0).alias("phrase_matches"),
    )


def percent_1dp(part: Column, total: Column) -> Column:
    """``part/total*100`` rounded half-up to one decimal in exact integer
    arithmetic; null when ``total`` is 0 (the original divided by zero)."""
    tenths = F.floor((part * 2000 + total) / (total * 2))
    return F.when(total > 0, (tenths / F.lit(10.0)).cast("double"))


def quality_report(stats: DataFrame, rules) -> DataFrame:
    """L6 counts with percentages and the first five of each rule list."""
    t = F.col("total_samples")
    cols = ["positive_labeled", "negative_labeled", "unlabeled",
            "domain_matches", "phrase_matches", "conflicts"]
    lists = ("positive_phrases", "negative_phrases", "positive_domains", "negative_domains")
    x = with_rules(stats, rules, ["positive_label", "negative_label", *lists])
    return x.select(
        *stats.columns, "positive_label", "negative_label",
        *[F.array_join(F.slice(c, 1, 5), ", ").alias(f"{c}_head") for c in lists],
        *[percent_1dp(F.col(c), t).alias(f"{c}_pct") for c in cols])


def preview(labeled: DataFrame, key: str = "id", n: int = 10, width: int = 100) -> DataFrame:
    """T5: the first ``n`` rows by key with text cut to ``width`` + ``...``."""
    return (labeled.orderBy(key).limit(n)
            .select(key, "label", "source", heuristics_string().alias("heuristics"),
                    F.concat(F.substring(F.coalesce("text", F.lit("")), 1, width),
                             F.lit("...")).alias("text_preview")))


def min_sample_gate(labeled: DataFrame, rules) -> DataFrame:
    """Per niche class counts against ``min_samples_per_class``."""
    counts = labeled.groupBy("niche").agg(
        F.count_if(F.col("label") == F.col("positive_label")).alias("positive_count"),
        F.count_if(F.col("label") == F.col("negative_label")).alias("negative_count"))
    return (with_rules(counts, rules, ["positive_label", "negative_label", "min_samples_per_class"])
            .withColumn("passed", (F.col("positive_count") >= F.col("min_samples_per_class"))
                        & (F.col("negative_count") >= F.col("min_samples_per_class"))))


def require_min_samples(gate: DataFrame) -> None:
    """Training stops when a class is short (labeling only warns)."""
    failed = gate.where(~F.col("passed")).select("niche", "positive_count",
                                                 "negative_count", "min_samples_per_class").take(20)
    if failed:
        raise ValueError(f"not enough samples per class: {[r.asDict() for r in failed]}")


def verdict_to_binary(df: DataFrame, col: str = "label", out: str = "label_binary") -> DataFrame:
    """Six verdicts to 1/0 by a literal map; other labels are dropped."""
    m = F.create_map(*[x for k, v in VERDICT_TO_BINARY.items() for x in (F.lit(k), F.lit(v))])
    return df.withColumn(out, F.element_at(m, F.col(col)).cast("int")).na.drop(subset=[out])


def niche_label_to_binary(df: DataFrame, rules, out: str = "label_binary") -> DataFrame:
    """Positive label -> 1, negative -> 0 per niche; others dropped."""
    x = with_rules(df.drop("positive_label", "negative_label"), rules,
                   ["positive_label", "negative_label"])
    return (x.withColumn(out, F.when(F.col("label") == F.col("positive_label"), 1)
                         .when(F.col("label") == F.col("negative_label"), 0).cast("int"))
             .na.drop(subset=[out]).drop("positive_label", "negative_label"))
