"""L1-L10 on hand-written cases."""
import pytest
from pyspark.sql import functions as F

from claimflow.operators import labeling as L
from claimflow.sources.rules import RuleSet, available_niches, list_niches, load_rule_set

RULES = RuleSet.from_mapping({
    "niche": "test_niche", "positive_label": "rumour", "negative_label": "report",
    "positive_phrases": ["they say", "leaked", "insider"], "negative_phrases": ["measured", "survey", "table shows"],
    "positive_domains": ["whispers.test"], "negative_domains": ["bureau.test"],
})


def _label(spark, rows):
    df = spark.createDataFrame([(i, *r, "test_niche") for i, r in enumerate(rows)],
                               "k int, text string, source string, domain_type string, niche string")
    return L.label_dataset(df, [RULES], key="k", date="2024-01-01").orderBy("k").collect()


def test_label_cases(spark):
    out = _label(spark, [
        ("A leaked memo, they say.", "news.test", "unknown"),            # positive phrases
        ("We measured it; the survey agrees.", "news.test", "unknown"),  # negative phrases
        ("Plain words only", "whispers.test", "positive"),               # domain
        ("They say the survey was leaked and measured.", "news.test", "unknown"),  # conflict
        ("Nothing to see", "news.test", "unknown"),                      # none
        ("A LEAKED MEMO, THEY SAY.", "news.test", "unknown"),            # case
        (None, "news.test", "negative"),                                 # null text
    ])
    assert [r.label for r in out] == ["rumour", "report", "rumour", "unlabeled", "unlabeled", "rumour", "report"]
    assert out[4].heuristics == ["no_heuristics_match"]
    assert out[0].heuristics == ["positive_phrases:they say,leaked"]
    assert out[2].heuristics == ["positive_domain:whispers.test"]
    assert out[0].id == "test_niche_0" and str(out[0].date) == "2024-01-01"


def test_evidence_order_and_conflict(spark):
    rules = RuleSet.from_mapping({
        "niche": "test_niche", "positive_label": "p", "negative_label": "n",
        "positive_phrases": ["confirmed by", "confirmed by spokesperson"], "negative_phrases": ["x"],
        "positive_domains": ["a.com"], "negative_domains": ["b.com"]})
    df = spark.createDataFrame([(0, "Confirmed by spokesperson", "A.com.b.com", "negative", "test_niche")],
                               "k int, text string, source string, domain_type string, niche string")
    r = L.score_rules(df, [rules]).first()
    assert r.positive_score == 4 and r.negative_score == 2 and r.label == "p"
    assert r.heuristics == ["positive_domain:A.com.b.com", "negative_domain:A.com.b.com",
                            "positive_phrases:confirmed by,confirmed by spokesperson"]
    stats = L.labeling_stats(L.score_rules(df, [rules])).first()
    assert stats.conflicts == 1 and stats.domain_matches == 1 and stats.phrase_matches == 1


def test_stats_two_rows(spark):
    df = spark.createDataFrame([(0, "leaked", "x", "unknown", "test_niche"), (1, "survey", "y", "unknown", "test_niche")],
                               "k int, text string, source string, domain_type string, niche string")
    s = L.labeling_stats(L.score_rules(df, [RULES])).first()
    assert s.total_samples == 2 and s.positive_labeled == 1 and s.negative_labeled == 1


def test_adding_positive_phrase_never_lowers_score(spark):
    from conftest import SF01
    d = spark.read.parquet(f"{SF01}/documents.parquet").select(
        "doc_id", "text", "source", F.lit("unknown").alias("domain_type"), F.lit("test_niche").alias("niche"))
    more = RuleSet.from_mapping({**RULES.__dict__, "positive_phrases": list(RULES.positive_phrases) + ["the"]})
    a = L.score_rules(d, [RULES]).select("doc_id", F.col("positive_score").alias("a"))
    b = L.score_rules(d, [more]).select("doc_id", F.col("positive_score").alias("b"))
    assert a.join(b, "doc_id").where(F.col("b") < F.col("a")).count() == 0


def test_fixture_counts_documents(spark):
    from __spark_entry__ import queries
    from conftest import SF01
    got = {(r.label, r.tie): r.rows for r in queries()["document_label_counts"](spark, SF01).collect()}
    assert got == {("neg", False): 134, ("neg", True): 60, ("pos", False): 675,
                   ("pos", True): 69, ("unlabeled", True): 62}


def test_flagship_pages_counts(spark):
    from __spark_entry__ import entry
    got = {(r.label, r.tie): (r.rows, r.conflicts) for r in entry(spark).collect()}
    assert got == {("neg", False): (11, 2), ("neg", True): (1, 0), ("pos", False): (25, 2),
                   ("pos", True): (4, 3), ("unlabeled", True): (9, 0)}


def test_quality_report_percent_and_zero_total(spark):
    df = spark.createDataFrame([("test_niche", 0, 0, 0, 0, 0, 0, 0), ("test_niche", 3, 1, 1, 1, 0, 2, 3)],
                               "niche string, total_samples long, positive_labeled long, negative_labeled long, "
                               "unlabeled long, conflicts long, domain_matches long, phrase_matches long")
    rows = L.quality_report(df, [RULES]).orderBy("total_samples").collect()
    assert rows[0].positive_labeled_pct is None
    assert rows[1].positive_labeled_pct == 33.3 and rows[1].domain_matches_pct == 66.7
    assert rows[1].positive_phrases_head == "they say, leaked, insider"


def test_min_sample_gate(spark):
    df = spark.createDataFrame([("test_niche", "rumour", "rumour", "report")] * 3,
                               "niche string, label string, positive_label string, negative_label string")
    g = L.min_sample_gate(df, [RULES]).first()
    assert g.positive_count == 3 and g.negative_count == 0 and not g.passed
    with pytest.raises(ValueError):
        L.require_min_samples(L.min_sample_gate(df, [RULES]))


def test_verdicts_and_niche_binary(spark):
    df = spark.createDataFrame([("true",), ("pants-fire",), ("half-true",), ("other",)], "label string")
    got = sorted((r.label, r.label_binary) for r in L.verdict_to_binary(df).collect())
    assert got == [("half-true", 0), ("pants-fire", 1), ("true", 0)]
    df2 = spark.createDataFrame([("test_niche", "rumour"), ("test_niche", "report"), ("test_niche", "unlabeled")],
                                "niche string, label string")
    got2 = sorted((r.label, r.label_binary) for r in L.niche_label_to_binary(df2, [RULES]).collect())
    assert got2 == [("report", 0), ("rumour", 1)]


def test_rule_sets_load_and_list(spark):
    names = available_niches()
    assert names == sorted(names) and len(names) == 7
    rs = load_rule_set("hustle_scams")
    assert rs.max_per_source == 150 and "$10k/day" in rs.positive_phrases and "sec filing" in rs.negative_phrases
    with pytest.raises(FileNotFoundError):
        load_rule_set("no_such_niche")
    assert [r.niche for r in list_niches(spark).collect()] == names


def test_rules_are_not_joined(spark):
    """Labeling with known rule sets is a map-only plan: no join, and no
    shuffle beyond the input spread (one-split local files only)."""
    from __spark_entry__ import queries
    from conftest import SF01
    from claimflow.plans.catalog import _doc_labels
    plan = _doc_labels(spark, SF01)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") <= 1
    assert queries()  # registry importable


def test_no_nested_loop_or_cartesian_joins(spark):
    """Plans of the SQL-checked queries use only equi-joins (or none)."""
    from conftest import SF001
    from claimflow.plans.catalog import QUERIES as qs
    from claimflow.plans.oracle import ORACLE
    for name in ORACLE:
        plan = qs[name](spark, SF001)._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan, name


def test_domain_match_modes(spark):
    rules = RuleSet.from_mapping({"niche": "test_niche", "positive_label": "p", "negative_label": "n",
                                  "positive_domains": ["ew.com"], "negative_domains": []})
    df = spark.createDataFrame([(0, "x", "www.crew.com", "unknown", "test_niche"),
                                (1, "x", "www.ew.com", "unknown", "test_niche"),
                                (2, "x", "EW.com:443", "unknown", "test_niche")],
                               "k int, text string, source string, domain_type string, niche string")
    sub = {r.k: r.pos_domain for r in L.score_rules(df, [rules]).collect()}
    host = {r.k: r.pos_domain for r in L.score_rules(df, [rules], match="host_suffix").collect()}
    assert sub == {0: True, 1: True, 2: True}
    assert host == {0: False, 1: True, 2: True}


def test_one_rule_set_per_niche(spark):
    with pytest.raises(ValueError, match="more than one rule set"):
        L.score_rules(
            spark.createDataFrame([("t", "s", "unknown", "test_niche")], "text string, source string, domain_type string, niche string"), [RULES, RULES])


def test_rules_table_gives_the_same_labels(spark):
    from claimflow.sources.rules import rules_frame
    df = spark.createDataFrame([(0, "leaked", "whispers.test", "unknown", "test_niche"), (1, "survey", None, "unknown", "other")],
                               "k int, text string, source string, domain_type string, niche string")
    a = [(r.k, r.label, r.heuristics) for r in L.score_rules(df, [RULES]).collect()]
    assert a == [(r.k, r.label, r.heuristics) for r in L.score_rules(df, rules_frame(spark, [RULES])).collect()]
