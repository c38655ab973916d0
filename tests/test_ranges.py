"""Running sums over key ranges against plain ones."""
import random
from itertools import accumulate

import pytest
from pyspark.sql import functions as F

from claimflow.operators.ranges import running_sums


@pytest.mark.parametrize("n", [1, 7, 40])
def test_running_sums_equal_a_plain_loop(spark, n):
    rng = random.Random(3)
    rows = [(rng.choice(["a", "b", None]), k, rng.randint(0, 9)) for k in rng.sample(range(1000), 200)]
    df = spark.createDataFrame(rows, "g string, k int, v int")
    order = [F.col("g").asc_nulls_first(), F.col("k").desc()]
    got = {r.k: (r.cum_v, r.next_v) for r in running_sums(df, order, ["v"], by=("g",), n_ranges=n, with_next=True).collect()}
    for g in ("a", "b", None):
        mine = sorted((r for r in rows if r[0] == g), key=lambda r: -r[1])
        sums, after = list(accumulate(r[2] for r in mine)), [r[2] for r in mine[1:]] + [None]
        assert {r[1]: got[r[1]] for r in mine} == {r[1]: (s, x) for r, s, x in zip(mine, sums, after)}
    plain = sorted(rows, key=lambda r: r[1])
    got = {r.k: r.cum_v for r in running_sums(df, [F.col("k")], ["v"], n_ranges=n).collect()}
    assert got == {r[1]: s for r, s in zip(plain, accumulate(r[2] for r in plain))}


def test_running_sums_of_no_rows(spark):
    df = spark.createDataFrame([], "g string, k int, v int")
    assert running_sums(df, [F.col("g"), F.col("k")], ["v"], by=("g",), with_next=True).count() == 0
