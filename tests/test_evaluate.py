"""E1-E6 against hand-computed values."""
import pytest

from pyspark.sql import functions as F

from claimflow.operators import evaluate as E


@pytest.fixture
def pred(spark):
    rows = [(1, 1, 0.9), (0, 1, 0.8), (1, 0, 0.4), (0, 0, 0.1), (1, 1, 0.8)]
    return spark.createDataFrame(rows, "actual int, predicted int, score double")


def test_accuracy_confusion_report(spark, pred):
    assert E.accuracy(pred).first().accuracy == pytest.approx(0.6)
    cm = {(r.actual, r.predicted): r["count"] for r in E.confusion(pred).collect()}
    assert cm == {(1, 1): 2, (1, 0): 1, (0, 1): 1, (0, 0): 1}
    rep = {r["class"]: r for r in E.class_report(E.confusion(pred)).collect()}
    assert rep[1].precision == pytest.approx(2 / 3) and rep[1].recall == pytest.approx(2 / 3)
    assert rep[0].precision == pytest.approx(0.5) and rep[0].support == 2
    s = E.report_summary(E.class_report(E.confusion(pred))).first()
    assert s.macro_f1 == pytest.approx((2 / 3 + 0.5) / 2)


def test_confusion_keeps_zero_cells(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "a")], "actual string, predicted string")
    cm = E.confusion(df, classes=["a", "b"]).collect()
    assert len(cm) == 4 and sum(r["count"] for r in cm) == 2


def test_auc_and_ap(spark, pred):
    # positives at 0.9, 0.8, 0.4; negatives at 0.8, 0.1; tie at 0.8
    auc = E.roc_auc(pred).first().roc_auc
    pairs = [(p, n) for p in (0.9, 0.8, 0.4) for n in (0.8, 0.1)]
    expect = sum(1.0 if p > n else 0.5 if p == n else 0.0 for p, n in pairs) / len(pairs)
    assert auc == pytest.approx(expect)
    ap = E.average_precision(pred).first().average_precision
    # thresholds 0.9: P=1, R=1/3; 0.8: P=2/3, R=2/3; 0.4: P=3/4, R=1; 0.1: P=3/5, R=1
    assert ap == pytest.approx(1 / 3 * 1 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 4)


def test_ap_four_rows(spark):
    df = spark.createDataFrame([(0, 0, 0.1), (0, 0, 0.4), (1, 0, 0.35), (1, 0, 0.8)], "actual int, predicted int, score double")
    assert E.average_precision(df).first().average_precision == pytest.approx(0.8333333333)


def test_curves_with_many_buckets_equal_plain(spark):
    import random
    random.seed(3)
    rows = [(random.randint(0, 1), 0, round(random.random(), 3)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "actual int, predicted int, score double")
    a = sorted(tuple(r) for r in E.roc_curve(df, n_buckets=1).collect())
    b = sorted(tuple(r) for r in E.roc_curve(df, n_buckets=64).collect())
    assert len(a) == len(b) and all(x[0] == y[0] and abs(x[1] - y[1]) < 1e-12 and abs(x[2] - y[2]) < 1e-12
                                    for x, y in zip(a, b))
    pr = E.pr_curve(df).collect()
    assert any(r.recall == 0.0 and r.precision == 1.0 for r in pr)


def test_roc_drop_intermediate_matches_second_difference_rule(spark):
    import random
    import numpy as np
    random.seed(5)
    rows = [(random.randint(0, 1), 0, float(random.randint(0, 40))) for _ in range(600)]
    rows += [(1, 0, 100.0 + i) for i in range(5)] + [(0, 0, -10.0 - i) for i in range(5)]
    df = spark.createDataFrame(rows, "actual int, predicted int, score double")
    # reference rule on the per-threshold cumulative counts
    scores = sorted({r[2] for r in rows}, reverse=True)
    tps = np.cumsum([sum(1 for r in rows if r[2] == s and r[0] == 1) for s in scores])
    fps = np.cumsum([sum(1 for r in rows if r[2] == s and r[0] != 1) for s in scores])
    keep = np.where(np.r_[True, np.logical_or(np.diff(fps, 2), np.diff(tps, 2)), True])[0]
    expect = sorted(scores[i] for i in keep)
    for nb in (1, 8):
        got = sorted(r.threshold for r in E.roc_curve(df, n_buckets=nb, drop_intermediate=True).collect()
                     if r.threshold != float("inf"))
        assert got == expect
    assert E.roc_curve(df).count() == len(scores) + 1


def test_curve_summary_equals_separate_metrics(spark, pred):
    s = E.curve_summary(pred).first()
    assert s.roc_auc == pytest.approx(E.roc_auc(pred).first().roc_auc)
    assert s.average_precision == pytest.approx(E.average_precision(pred).first().average_precision)


def test_one_class_or_no_rows_give_nulls(spark):
    one = spark.createDataFrame([(1, 1, 0.5), (1, 0, 0.2)], "actual int, predicted int, score double")
    none = one.where("actual = 7")
    for df in (one, none):
        assert E.roc_auc(df).first()[0] is None
        assert E.curve_summary(df).first().roc_auc is None
        E.roc_curve(df).collect(), E.pr_curve(df).collect(), E.average_precision(df).collect()
    s = E.report_summary(E.class_report(E.confusion_counts(none))).first()
    assert s.macro_f1 is None and s.weighted_f1 is None
    assert E.confusion(none).count() == 0


def test_report_by_group_equals_report_of_each_group(spark):
    rows = [(g, i % 3, (i * g) % 3) for g in (1, 2) for i in range(20)]
    df = spark.createDataFrame(rows, "g int, actual int, predicted int")
    got = {(r.g, r["class"]): (r.precision, r.recall, r.f1, r.support) for r in E.report_by(df, "g").collect()}
    for g in (1, 2):
        alone = E.class_report(E.confusion(df.where(F.col("g") == g))).collect()
        assert {k[1]: v for k, v in got.items() if k[0] == g} == {r["class"]: (r.precision, r.recall, r.f1, r.support) for r in alone}


def test_curves_do_not_depend_on_the_ranges(spark):
    df = spark.range(0, 500).selectExpr("cast(id % 7 = 0 as int) as actual", "cast(id * 37 % 101 as double) as score")
    a = sorted(tuple(r) for r in E.roc_curve(df, n_buckets=1).collect())
    assert a == sorted(tuple(r) for r in E.roc_curve(df, n_buckets=13).collect()) and len(a) == 102


def test_curves_over_a_million_scores_have_no_bounds_in_the_plan(spark):
    n = 1_000_000
    df = spark.range(0, n).selectExpr("cast((id * 7919) % 3 = 0 as int) as actual", f"cast((id * 611953) % {n} as double) / {n} as score")
    a = E.roc_curve(df)
    plan = a._jdf.queryExecution().optimizedPlan().toString()
    assert "filter(" not in plan and len(plan) < 50_000
    assert a.count() == n + 1
    many, few = (E.curve_summary(df, n_buckets=k).first() for k in (61, 2))
    assert abs(many.roc_auc - few.roc_auc) < 1e-12 and abs(many.average_precision - few.average_precision) < 1e-12
    import numpy as np
    i = np.arange(n, dtype=np.int64)
    actual = ((i * 7919) % 3 == 0)[np.argsort(-((i * 611953) % n))]
    hits = np.cumsum(actual)
    assert abs(many.average_precision - float((hits / np.arange(1, n + 1))[actual].mean())) < 1e-9
