"""Running sums in a global order without a single-task window.

Rows are cut into contiguous ranges of the order (``repartitionByRange``), and
each range writes its number along. One total per range is prefix-summed (a
table with one row per range, and per group where ``by`` is given) and joined
back by the range number; the running sum inside a range is a window over that
range alone. The result doesn't depend on the number of ranges. Rows that are
equal in the order share a range, so the order should be (nearly) unique.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.session import write_stage

ROWS_PER_RANGE = 50_000


def in_ranges(df: DataFrame, order: list[Column], n_ranges: int | None = None, name: str = "ranges") -> DataFrame:
    """``df`` with ``_range``, ascending along ``order``: a written table, so
    that the cut is the same for all its readers."""
    if n_ranges is None:
        n_ranges = max(1, -(-df.count() // ROWS_PER_RANGE))
    return write_stage(df.repartitionByRange(n_ranges, *order).withColumn("_range", F.spark_partition_id()), name)


def _same(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Null-safe inner join that keeps the keys of ``left``."""
    names = {k: f"_k{i}" for i, k in enumerate(keys)}
    right = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, r in names.items():
        same = same & F.col(k).eqNullSafe(F.col(r))
    return left.join(right, same).drop(*names.values())


def running_sums(df: DataFrame, order: list[Column], cols: list[str], by: tuple[str, ...] = (), n_ranges: int | None = None,
                 with_next: bool = False, name: str = "ranges") -> DataFrame:
    """Adds ``cum_<c>``, the inclusive running sum of every column in ``cols``
    along ``order``, inside each group of ``by`` (which must lead the order);
    with ``with_next`` also ``next_<c>``, the next row's value (null after the
    last). A null group is a group; an empty table stays empty."""
    by, whole = list(by), Window.unboundedPreceding
    x = in_ranges(df, order, n_ranges, name)
    totals = x.groupBy(*by, "_range").agg(*[F.sum(c).alias(f"_o_{c}") for c in cols])
    ranges = Window.partitionBy(*by).orderBy("_range") if by else Window.orderBy("_range")   # one row per range
    offsets = totals.select(*by, "_range", *[F.coalesce(F.sum(f"_o_{c}").over(ranges.rowsBetween(whole, -1)), F.lit(0)).alias(f"_o_{c}") for c in cols])
    inside = Window.partitionBy(*by, "_range").orderBy(*order)
    x = x.withColumns({f"cum_{c}": F.sum(c).over(inside.rowsBetween(whole, 0)) for c in cols})
    if with_next:
        x = x.withColumns({f"next_{c}": F.lead(c).over(inside) for c in cols} | {"_place": F.row_number().over(inside)})
        x = write_stage(x, f"{name}-sums")
        firsts = x.where("_place = 1").select(*by, "_range", *[F.col(c).alias(f"_n_{c}") for c in cols])
        firsts = firsts.select(*by, "_range", *[F.lead(f"_n_{c}").over(ranges).alias(f"_n_{c}") for c in cols])
        x = _same(x, firsts, [*by, "_range"]).withColumns({f"next_{c}": F.coalesce(f"next_{c}", f"_n_{c}") for c in cols}).drop("_place", *[f"_n_{c}" for c in cols])
    x = _same(x, offsets, [*by, "_range"])
    return x.withColumns({f"cum_{c}": F.col(f"cum_{c}") + F.col(f"_o_{c}") for c in cols}).drop("_range", *[f"_o_{c}" for c in cols])
