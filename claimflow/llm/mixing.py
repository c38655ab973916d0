"""Mixing sources to target weights.

Every source is a stream of words, packed into blocks of ``block_words``. A
source's target becomes so many slots (the last one cut, so that it takes the
target exactly). Every output shard draws the source counts of its slots from a
multinomial with the sources' shares; a source that has given all its slots gives
no more, and the last shard takes what is left, so that each source's total is its
target. Slot ``i`` of a pass over the source takes block ``p(i)``, where ``p`` is
the source's own pseudorandom permutation of its block numbers (a keyed Feistel
network with cycle walking), and the slots join the blocks by (source, block).

Scale: offsets in a source's stream are prefix sums in two levels (hash buckets
of documents, then documents in a bucket), so a source with a third of all rows
is spread over many tasks; the join key is fine-grained. Targets come from a few
aggregates over the source table. All draws are seeded by source and slot, so
reruns and recomputed tasks agree.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimflow.llm.common import NON_SPACE, discard, flat, mix, slices, stage_table, words

BLOCK_WORDS = 256
SHARD_SLOTS = 100_000
LEAST_SHARDS = 8
DRAW_SOURCES = 1_000    # sources that one draw deals with
ROWS_PER_BUCKET = 20_000
LEAST_BUCKETS = 256


def word_count(text: str) -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple[int, ...], percent: int, most: int) -> DataFrame:
    """``source, sid, source_size, target``: sources by code point (null last)
    get the weights in turn and share ``percent`` of all words; a target stops
    at ``most`` times its source's size, and the excess is shared anew."""
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    schema = T.StructType([*per_source.schema.fields, T.StructField("sid", T.LongType())])
    ranked = per_source.orderBy(F.col("source").asc_nulls_last()).rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    table = stage_table(sizes.sparkSession.createDataFrame(ranked, schema), "sources")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    table = table.withColumns({"weight": weight, "most": (most * F.col("source_size")).cast("double")})
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * percent / 100
    level = 0.0
    while True:                     # capped sources keep their cap, the rest share what is left
        full = F.col("most") <= F.lit(level) * F.col("weight")
        rest, share = table.agg(F.sum(F.when(full, F.col("most"))), F.sum(F.when(~full, F.col("weight")))).first()
        now = (total - (rest or 0.0)) / share if share else level
        if now <= level:
            break
        level = now
    return table.select("source", "sid", "source_size", F.least(F.col("most"), F.lit(level) * F.col("weight")).alias("target"))


def _offsets(rows: DataFrame) -> DataFrame:
    """Adds ``start``, the place of each row in its source's word stream."""
    buckets = max(LEAST_BUCKETS, rows.count() // ROWS_PER_BUCKET)
    rows = rows.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "digest", F.lit(17)), F.lit(buckets)))
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("bucket_size"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = stage_table(sums.select("sid", "bucket", F.coalesce(F.sum("bucket_size").over(before), F.lit(0)).alias("bucket_start")), "bucket-starts")
    inside = Window.partitionBy("sid", "bucket").orderBy("doc_id", "digest").rowsBetween(Window.unboundedPreceding, -1)
    return (rows.join(sums, ["sid", "bucket"])
            .withColumn("start", F.col("bucket_start") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
            .drop("bucket", "bucket_start"))


def permute(index: np.ndarray, n: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Keyed permutation of ``0 .. n - 1``, elementwise: a four-round Feistel
    network on the next even number of bits, walked until it is below ``n``."""
    n = n.astype(np.uint64)
    bits = np.ceil(np.log2(np.maximum(n, 2).astype(np.float64) + 1) / 2).astype(np.uint64)
    low = (np.uint64(1) << bits) - np.uint64(1)
    out, todo = index.astype(np.uint64), np.arange(len(index))
    while len(todo):
        x, b, m, k = out[todo], bits[todo], low[todo], key[todo]
        left, right = x >> b, x & m
        for r in range(4):
            left, right = right, left ^ (mix(right + k + np.uint64(r * 0x51ED270B)) & m)
        out[todo] = (left << b) | right
        todo = todo[out[todo] >= n[todo]]
    return out.astype(np.int64)


def _drawn(totals: DataFrame, shards: int, slots: int, seed: int) -> DataFrame:
    """``shard, sid, drawn``: each shard's multinomial source counts, with the
    shares of ``totals(sid, total)``. Sources are drawn in two steps, first
    groups of ``DRAW_SOURCES`` sources and then the sources of each group, which
    is the same distribution; only the groups' totals reach the driver."""
    groups = totals.groupBy(F.expr(f"sid div {DRAW_SOURCES}").alias("g")).agg(
        F.sum("total").alias("sum"), F.array_sort(F.collect_list(F.struct("sid", "total"))).alias("members"))
    groups = stage_table(groups, "source-groups")
    shares = sorted((r["g"], r["sum"]) for r in groups.select("g", "sum").collect())
    ids, weight = np.array([g for g, _ in shares], np.int64), np.array([n for _, n in shares], np.float64)
    size = np.diff(np.arange(shards + 1) * slots // shards)

    def by_group(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for shard in batch.column("id").to_pylist():
                n = np.random.default_rng([seed, shard]).multinomial(size[shard], weight / weight.sum())
                some = np.flatnonzero(n)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), shard)), pa.array(ids[some]), pa.array(n[some])], ["shard", "g", "n"])

    def by_source(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                share = np.array([m["total"] for m in r["members"]], np.float64)
                n = np.random.default_rng([seed, r["shard"], r["g"]]).multinomial(r["n"], share / share.sum())
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), r["shard"])), pa.array([m["sid"] for m in r["members"]], pa.int64()), pa.array(n)],
                                                 ["shard", "sid", "drawn"])
    if not len(ids):
        return totals.sparkSession.createDataFrame([], "shard long, sid long, drawn long")
    first = totals.sparkSession.range(shards).mapInArrow(by_group, "shard long, g long, n long")
    return first.join(groups, "g").select("shard", "g", "n", "members").mapInArrow(by_source, "shard long, sid long, drawn long")


def _shard_counts(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """One row per source, pass and output shard: ``first`` slot and ``slots``."""
    size, target = F.col("source_size"), F.round("target").cast("long")
    passes = targets.withColumn("pass", F.explode(F.expr("sequence(0, cast(ceil(target / greatest(source_size, 1)) as int))")))
    rows = (passes.withColumn("take", F.least(size, target - F.col("pass") * size)).where("take > 0")
            .select("sid", "pass", "take", "source_size", F.xxhash64("source", "pass", F.lit(seed)).alias("key"))
            .withColumn("pass_slots", F.expr(f"cast(ceil(take / {block_words}) as long)")))
    before = Window.partitionBy("sid").orderBy("pass").rowsBetween(Window.unboundedPreceding, -1)
    rows = stage_table(rows.withColumn("pass_start", F.coalesce(F.sum("pass_slots").over(before), F.lit(0))), "passes")
    totals = stage_table(rows.groupBy("sid").agg(F.sum("pass_slots").alias("total")), "slot-totals")
    slots = totals.agg(F.sum("total")).first()[0] or 0
    shards = max(LEAST_SHARDS, -(-slots // shard_slots))
    every = totals.withColumn("shard", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))))
    drawn = every.join(_drawn(totals, shards, slots, seed), ["sid", "shard"], "left")
    sofar = Window.partitionBy("sid").orderBy("shard").rowsBetween(Window.unboundedPreceding, 0)
    # What a source has left after the draws goes to the last shard.
    end = F.when(F.col("shard") == shards - 1, F.col("total")).otherwise(F.least(F.sum(F.coalesce("drawn", F.lit(0))).over(sofar), F.col("total")))
    spans = drawn.select("sid", "shard", "total", end.alias("end"))
    spans = spans.withColumn("begin", F.coalesce(F.lag("end").over(Window.partitionBy("sid").orderBy("shard")), F.lit(0))).where("begin < end")
    lo, hi = F.greatest("begin", "pass_start"), F.least(F.col("end"), F.col("pass_start") + F.col("pass_slots"))
    return (spans.join(rows, "sid").withColumns({"lo": lo, "hi": hi}).where("lo < hi")
            .select("sid", "pass", "take", "source_size", "key", "shard", (F.col("lo") - F.col("pass_start")).alias("first"), (F.col("hi") - F.col("lo")).alias("slots")))


def _slots(counts: DataFrame, block_words: int) -> DataFrame:
    """``sid, pass, shard, slot, block, words``: the block that each slot takes
    and how many of its words. The short last block of a stream comes last."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                r = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
                slot = np.arange(r["first"], r["first"] + r["slots"])
                full = r["source_size"] // block_words
                block = slot.copy()
                inner = slot < full
                block[inner] = permute(slot[inner], np.full(inner.sum(), full), np.full(inner.sum(), r["key"], np.int64).view(np.uint64))
                taken = np.minimum(block_words, r["take"] - slot * block_words)
                n = len(slot)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(n, r[c], np.int64)) for c in ("sid", "pass", "shard")] + [pa.array(slot), pa.array(block), pa.array(taken)],
                    ["sid", "pass", "shard", "slot", "block", "words"])
    return counts.mapInArrow(run, "sid long, pass long, shard long, slot long, block long, words long")


def _draw(docs: DataFrame, weights, percent, most, block_words, shard_slots, seed, key, text, source) -> tuple[DataFrame, DataFrame]:
    """Rows with their source's figures, and the drawn segments."""
    rows = stage_table(docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), word_count(text).alias("size"),
                                   F.xxhash64(F.col(text)).alias("digest")), "sizes")
    targets = stage_table(source_targets(rows, weights, percent, most), "targets")
    sizes = rows
    rows = rows.join(targets, rows["source"].eqNullSafe(targets["source"])).drop(targets["source"])
    rows = stage_table(_offsets(rows), "offsets")
    discard(sizes)
    counts = stage_table(_shard_counts(targets, block_words, shard_slots, seed), "shard-counts")
    slots = _slots(counts, block_words)
    pieces = (rows.where("size > 0").select("doc_id", "digest", "sid", "source", "start", "size",
              F.explode(F.expr(f"sequence(start div {block_words}, (start + size - 1) div {block_words})")).alias("block")))
    begin = F.col("block") * block_words
    # Both sides grow with the corpus; their planned sizes don't show it.
    segments = (pieces.join(slots.hint("merge"), ["sid", "block"])
                .withColumn("from", F.greatest(begin, "start") - F.col("start"))
                .withColumn("to", F.least(begin + F.col("words"), F.col("start") + F.col("size")) - F.col("start"))
                .where("from < to"))
    return rows, segments


def mix_segments(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, most: int = 2,
                 block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7,
                 key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """The mix as segments: ``shard, sid, source, pass, slot, doc_id, digest,
    start, from, to``: words ``from:to`` of a document stand in that output slot.
    Nulls, repeats and empty tables are taken as by ``mix_report``."""
    _, segments = _draw(docs, weights, percent, most, block_words, shard_slots, seed, key, text, source)
    return segments.select("shard", "sid", "source", "pass", "slot", "doc_id", "digest", "start", "from", "to")


def mix_report(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), percent: int = 150, most: int = 2,
               block_words: int = BLOCK_WORDS, shard_slots: int = SHARD_SLOTS, seed: int = 7,
               key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``doc_id, size, source_size, target, taken`` for every row of ``docs``.

    ``size`` counts runs of anything but ASCII white space; null and empty texts
    have none and nothing is taken of them. A null source is a source of its
    own, the last one. Repeated rows have places of their own in the stream. The
    taken words of a source are its rounded target; no row gives more than
    ``most`` times its size. An empty table gives no rows.
    """
    rows, segments = _draw(docs, weights, percent, most, block_words, shard_slots, seed, key, text, source)
    taken = segments.groupBy("sid", "start").agg(F.sum(F.col("to") - F.col("from")).alias("taken"))
    counted = rows.where("size > 0").join(taken, ["sid", "start"], "left")
    return (counted.unionByName(rows.where("size = 0").withColumn("taken", F.lit(0).cast("long")))
            .select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts cut to the word ranges taken of them."""
    for batch in batches:
        for part in slices(batch, "text"):
            buf, at = flat(part.column("text"))
            w = words(buf, at, NON_SPACE)
            out = []
            for r, ranges in enumerate(part.column("ranges").to_pylist()):
                base, pieces, last, end = w.row[r], [], None, None
                for a, b in sorted((x["from"], x["to"]) for x in ranges):
                    touching = last is not None and a == end            # keep the space between neighbours
                    pieces.append(buf[last if touching else w.start[base + a]:w.end[base + b - 1]].tobytes())
                    if last is not None and not touching:
                        pieces.insert(-1, b"\n")
                    last, end = w.end[base + b - 1], b
                out.append(b"".join(pieces).decode("utf-8"))
            yield pa.RecordBatch.from_arrays([part.column("rest"), pa.array(out, pa.string())], ["rest", "text"])


def mixed_documents(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **options) -> DataFrame:
    """The mix as documents with the columns of ``docs``: one row for each pass
    in which words of a document were taken, its text cut to those words (pieces
    that don't touch are joined by a line break). Rows equal in key, source and
    text count as often as they occur; their other columns come from the one of
    them with the smallest hash. Null and empty texts give no row; an empty table
    gives none."""
    drawn = mix_segments(docs, key=key, text=text, source=source, **options)
    same = [F.xxhash64("doc_id", "source", "digest").alias("h"), F.col("digest")]
    ranges = stage_table(drawn.groupBy("sid", "start", "pass", "doc_id", "source", "digest")
                         .agg(F.collect_list(F.struct("from", "to")).alias("ranges")).select(*same, "ranges"), "ranges")
    rest = F.struct(*[c for c in docs.columns if c != text])
    whole = docs.select(F.col(key).alias("doc_id"), F.col(source).alias("source"), F.xxhash64(F.col(text)).alias("digest"),
                        F.col(text).alias("text"), rest.alias("rest")).select(*same, "text", "rest")
    # Of equal rows one goes through the shuffle; the ranges hold each one's words.
    other = F.xxhash64(*[F.col(f"rest.{c}") for c, t in docs.dtypes if c != text and "map<" not in t and "variant" not in t])
    one = whole.withColumn("copy", F.row_number().over(Window.partitionBy("h", "digest").orderBy(other))).where("copy = 1").drop("copy")
    joined = one.join(ranges, ["h", "digest"]).select("rest", "text", "ranges")
    cut = joined.mapInArrow(_cut, T.StructType([T.StructField("rest", whole.schema["rest"].dataType), T.StructField("text", T.StringType())]))
    out = {c: F.col("text") if c == text else F.col("rest")[c] for c in docs.columns}
    if "n_chars" in out:
        out["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return cut.select(*[v.alias(c) for c, v in out.items()])
