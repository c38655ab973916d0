"""Stratified train/validation/test splits (M1-M3) and CV folds (M7).

The split is exact per stratum and reproducible: rows are ranked by
``md5(key:seed)`` inside their stratum, and the first ranks go to train,
the next to validation, the rest to test. Sizes follow the two-step rule
of the original (test part = ceil(0.3 n), then half of that, rounded up,
is test): 700 rows give 490/105/105, 110 rows give 77/16/17.

A window partitioned by the stratum alone would put a whole class (often
half the data) in one task. Instead (hazard H1) the hash prefix splits
each stratum into buckets of about ``ROWS_PER_BUCKET`` rows: counts per
(stratum, bucket) form a table whose running sums give each bucket's offset,
that table is joined back, and ``row_number`` runs inside (stratum, bucket).
The result equals the plain per-stratum window. A null stratum is a stratum.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TRAIN, VALIDATION, TEST = "train", "validation", "test"
ROWS_PER_BUCKET = 10_000


def hash_key(key: str, seed: int) -> Column:
    return F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed))))


def bucket_digits(n_rows: int) -> int:
    """Hex digits of the hash that make buckets of ``ROWS_PER_BUCKET`` rows."""
    return max(1, math.ceil(math.log(max(n_rows, 1) / ROWS_PER_BUCKET, 16)) if n_rows > ROWS_PER_BUCKET else 1)


def rank_in_strata(df: DataFrame, strata: list[str], key: str, seed: int = 42,
                   hex_digits: int | None = None) -> DataFrame:
    """Adds ``_h`` (hash), ``rank`` (1-based, by hash then key, inside the
    stratum) and ``n_stratum``. ``hex_digits`` follows the row count."""
    if hex_digits is None:
        hex_digits = bucket_digits(df.select(key).count())
    x = df.withColumn("_h", hash_key(key, seed)) \
          .withColumn("_b", F.substring("_h", 1, hex_digits))
    counts = x.groupBy(*strata, "_b").agg(F.count(F.lit(1)).alias("_nb"))
    wb = Window.partitionBy(*strata).orderBy("_b")
    offsets = (counts
               .withColumn("_off", F.sum("_nb").over(wb.rowsBetween(Window.unboundedPreceding, -1)))
               .withColumn("n_stratum", F.sum("_nb").over(Window.partitionBy(*strata)))
               .select(*[F.col(c).alias(f"_s{i}") for i, c in enumerate(strata)], F.col("_b").alias("_sb"),
                       F.coalesce("_off", F.lit(0)).alias("_off"), "n_stratum"))
    same = F.col("_b") == F.col("_sb")
    for i, c in enumerate(strata):
        same = same & F.col(c).eqNullSafe(F.col(f"_s{i}"))
    w = Window.partitionBy(*strata, "_b").orderBy("_h", key)
    return (x.join(offsets, same).withColumn("rank", F.row_number().over(w) + F.col("_off"))
            .drop("_b", "_sb", "_off", *[f"_s{i}" for i in range(len(strata))]))


def split_sizes(n: Column, test_size: float = 0.3, val_share: float = 0.5):
    """(n_train, n_val) per stratum from the two-step rule."""
    held = F.ceil(n * F.lit(test_size))
    n_test = F.ceil(held * F.lit(val_share))
    return n - held, held - n_test


def stratified_split(df: DataFrame, strata, key: str, seed: int = 42, test_size: float = 0.3,
                     val_share: float = 0.5, n_folds: int = 5, hex_digits: int | None = None) -> DataFrame:
    """M1/M2: adds ``split`` and, for train rows, ``fold`` (0..n_folds-1)."""
    strata = [strata] if isinstance(strata, str) else list(strata)
    x = rank_in_strata(df, strata, key, seed, hex_digits)
    n_train, n_val = split_sizes(F.col("n_stratum"), test_size, val_share)
    r = F.col("rank")
    split = F.when(r <= n_train, TRAIN).when(r <= n_train + n_val, VALIDATION).otherwise(TEST)
    return (x.withColumn("split", split)
            .withColumn("fold", F.when(r <= n_train, ((r - 1) % n_folds).cast("int")))
            .drop("_h"))


def given_split(df: DataFrame, split_col: str = "split") -> DataFrame:
    """M3: keep a provided split, naming ``valid`` as ``validation``."""
    return df.withColumn(split_col, F.when(F.col(split_col) == "valid", VALIDATION)
                         .otherwise(F.col(split_col)))
