"""Bounded samples of labelled rows for the classifiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_PER_CLASS = 2500
SAMPLE_BYTES = 100 << 20


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, learn: Column, per_class: int = SAMPLE_PER_CLASS,
                    key: str = "doc_id", text: str = "text", most_bytes: int = SAMPLE_BYTES) -> tuple[list[tuple[str, int]], dict[int, int]]:
    """Texts with their label (0 or 1), at most ``per_class`` rows a class, and
    the class sizes among all labelled rows. ``learn`` (on the key column) says
    which rows may be learned from. Rows are drawn by a hash of the key; the
    drawn keys are so few, by the bound, that they are broadcast to the texts, and
    of the drawn texts only the first ``most_bytes`` bytes in all, by that hash, are
    learned from, so that a few very long ones don't fill the driver. Null labels, keys and texts are no examples; other labels than 0 and 1 fail
    no row, they are left out."""
    rows = labels.where(learn).select(F.col(key).alias("k"), F.col(label).cast("int").alias("y")).where("k is not null and y in (0, 1)")
    sizes = {r["y"]: r["count"] for r in rows.groupBy("y").count().collect()}
    draw = F.pmod(F.xxhash64("k", F.lit(5)), F.lit(1 << 30)) / (1 << 30)
    drawn = None
    for y, n in sorted(sizes.items()):
        part = rows.where((F.col("y") == y) & (draw < 0.95 * per_class / n)).orderBy(draw, "k").limit(per_class)
        drawn = part if drawn is None else drawn.unionByName(part)
    if drawn is None:
        return [], {}
    texts = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).where("t is not null")
    left = most_bytes
    sized = texts.join(F.broadcast(drawn), "k").withColumn("n", F.octet_length("t"))
    sizes_only = sized.select("k", "y", "n", F.xxhash64("t").alias("h"), draw.alias("d")).orderBy("d", "k", "h").limit(2 * per_class).collect()
    wanted = []
    for r in sizes_only:
        if r["n"] <= left:
            wanted.append((r["k"], r["h"]))
            left -= r["n"]
    if len(wanted) < len(sizes_only):
        keys = docs.sparkSession.createDataFrame(wanted, f"k {docs.schema[key].dataType.simpleString()}, h long").distinct()
        sized = sized.withColumn("h", F.xxhash64("t")).join(F.broadcast(keys), ["k", "h"], "left_semi")
    found = sized.select("t", "y", draw.alias("d"), "k").orderBy("d", "k", "t").limit(2 * per_class).collect()
    return sorted((r["t"], r["y"]) for r in found), sizes
