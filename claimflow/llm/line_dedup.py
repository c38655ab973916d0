"""Incremental line dedup with sharded cuckoo filters over exact counts.

An index holds, for every line key, the exact number of documents it stands in,
and per shard a cuckoo filter of the keys that stand in ``least`` documents or
more. Inserting documents adds to the counts and puts keys that reach ``least``
into their shard's filter; deleting documents subtracts and takes the keys that
fall below it out again, so that an index after insertions and deletions answers
like one built from the documents left. A filter that can't take a key is built
anew, twice as large, from the exact table.

A key is a line without ASCII white space at both ends, A-Z lower-cased; it is
counted by a 128-bit digest. Lines are looked up in the filters, which are
broadcast: all but a few lines end there. The filters' positives, one row per
key, are compared with the exact table, and those that it doesn't confirm are
exceptions: a line goes if the filter has it and it is no exception.

Scale: counts are one aggregation by digest, pre-aggregated per batch and map
task, so a line of a third of all documents is one row a task. Filters are built
shard by shard, ``SHARD_KEYS`` keys in one. Filters and exceptions together
are broadcast up to ``BROADCAST_BYTES``; beyond that, the lines' digests are
written out and meet the filters block by block, and only positive lines join
the exact table and go back to their documents.
"""

from __future__ import annotations

import hashlib
import uuid
from collections import Counter
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.common import LOWER, NON_SPACE, flat, slices, stage_table
from claimflow.session import scratch_path

SHARD_KEYS = 50_000
BROADCAST_BYTES = 64 << 20
SLOTS = 4
KICKS = 200
LOAD = 0.85


class LineIndex(NamedTuple):
    """``counts(digest, n)``: documents a key; ``filters(shard, cells)``."""
    counts: DataFrame
    filters: DataFrame
    shards: int
    least: int
    least_chars: int


class Lines(NamedTuple):
    """Lines of a slice: bounds of the lines, and of their keys; row r has the
    lines row[r]:row[r + 1]."""
    start: np.ndarray
    end: np.ndarray
    key_start: np.ndarray
    key_end: np.ndarray
    row: np.ndarray


def cut_lines(buf: np.ndarray, at: np.ndarray) -> Lines:
    """Lines of every row; a row without bytes has one empty line."""
    breaks = np.flatnonzero(buf == 10)
    home = np.searchsorted(at, breaks, side="right") - 1
    n = np.bincount(home, minlength=len(at) - 1) + 1
    row = np.concatenate([[0], np.cumsum(n)])
    start, end = np.zeros(row[-1], np.int64), np.zeros(row[-1], np.int64)
    inner = np.arange(len(breaks)) + home            # line number that the break ends
    start[row[:-1]], end[row[1:] - 1] = at[:-1], at[1:]
    start[inner + 1], end[inner] = breaks + 1, breaks
    solid = np.append(np.flatnonzero(NON_SPACE[buf]), len(buf))
    first = solid[np.searchsorted(solid, start)]
    last = np.searchsorted(solid, end) - 1
    some = first < end
    return Lines(start, end, np.where(some, first, start), np.where(some, solid[np.maximum(last, 0)] + 1, start), row)


def key_digests(buf: np.ndarray, lines: Lines, least_chars: int) -> list:
    """A digest per line; None where the key is shorter than ``least_chars``."""
    chars = np.concatenate([[0], np.cumsum((buf & 0xC0) != 0x80)])
    long = chars[lines.key_end] - chars[lines.key_start] >= max(least_chars, 1)
    low = LOWER[buf].tobytes()
    return [hashlib.blake2b(low[a:b], digest_size=16).digest() if ok else None
            for a, b, ok in zip(lines.key_start.tolist(), lines.key_end.tolist(), long.tolist())]


def _document_counts(docs: DataFrame, text: str, least_chars: int) -> DataFrame:
    """``digest, n``: documents (rows) that hold a key, in partial counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buf, at = flat(part.column("text"))
                lines = cut_lines(buf, at)
                keys, found = key_digests(buf, lines, least_chars), Counter()
                for a, b in zip(lines.row[:-1].tolist(), lines.row[1:].tolist()):
                    found.update(set(keys[a:b]))
                found.pop(None, None)
                yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.binary()), pa.array(list(found.values()), pa.int64())], ["digest", "n"])
    return docs.select(F.col(text).alias("text")).mapInArrow(run, "digest binary, n long")


# --- cuckoo filters ------------------------------------------------------------

def _parts(digests: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Shard number (before the modulus), bucket and fingerprint (never 0) of
    digests (n x 16 bytes)."""
    shard = np.ascontiguousarray(digests[:, :4]).view(">u4").ravel().astype(np.int64)
    bucket = np.ascontiguousarray(digests[:, 4:8]).view(">u4").ravel().astype(np.int64)
    mark = np.ascontiguousarray(digests[:, 8:10]).view(">u2").ravel().astype(np.int64)
    return shard, bucket, np.maximum(mark, 1)


def _other(mark):
    """What turns a key's bucket into its other one, for every number of buckets."""
    return (mark * 0x5BD1E995) & 0xFFFFFFFF


def _shard(shards: int) -> Column:
    return (F.conv(F.hex(F.substring("digest", 1, 4)), 16, 10).cast("long") % shards).cast("int")


class CuckooFilter:
    """Fingerprints of 16 bits in buckets of four; a key lies in one of two."""

    def __init__(self, cells: np.ndarray):
        self.cells = cells.reshape(-1, SLOTS)

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1
        while buckets * SLOTS * LOAD < keys:
            buckets *= 2
        return cls(np.zeros(buckets * SLOTS, np.uint16))

    def insert(self, digests: np.ndarray) -> bool:
        """Adds keys; False when one finds no place (the filter is then spoilt)."""
        _, bucket, mark = _parts(digests)
        rng, last, table = np.random.default_rng(len(digests)), len(self.cells) - 1, self.cells.tolist()
        for b, m in zip((bucket & last).tolist(), mark.tolist()):
            for _ in range(KICKS):
                places = (b, b ^ (_other(m) & last))
                free = next((p for p in places if 0 in table[p]), None)
                if free is not None:
                    table[free][table[free].index(0)] = m
                    break
                b, slot = places[int(rng.integers(2))], int(rng.integers(SLOTS))
                table[b][slot], m = m, table[b][slot]
                b ^= _other(m) & last
            else:
                return False
        self.cells[:] = table
        return True

    def delete(self, digests: np.ndarray) -> None:
        """Removes keys that were inserted."""
        _, bucket, mark = _parts(digests)
        last = len(self.cells) - 1
        for b, m in zip((bucket & last).tolist(), mark.tolist()):
            for p in (b, b ^ (int(_other(m)) & last)):
                at = np.flatnonzero(self.cells[p] == m)
                if len(at):
                    self.cells[p, at[0]] = 0
                    break
            else:
                raise ValueError("a key that the filter doesn't hold can't be deleted")


class Lookup:
    """Filters of several shards, asked side by side."""

    def __init__(self, filters: dict[int, bytes], shards: int):
        self.shards, self.first, self.last = shards, np.zeros(shards, np.int64), np.full(shards, -1, np.int64)
        cells, n = [np.zeros((1, SLOTS), np.uint16)], 1
        for shard, blob in sorted(filters.items()):
            cells.append(np.frombuffer(blob, np.uint16).reshape(-1, SLOTS))
            self.first[shard], self.last[shard] = n, len(cells[-1]) - 1
            n += len(cells[-1])
        self.cells = np.concatenate(cells)

    def has(self, digests: np.ndarray) -> np.ndarray:
        shard, bucket, mark = _parts(digests)
        shard %= self.shards
        last = self.last[shard]
        known = last >= 0
        last, first = np.maximum(last, 0), np.where(known, self.first[shard], 0)
        a = bucket & last
        b = a ^ (_other(mark) & last)
        hit = (self.cells[first + a] == mark[:, None]).any(axis=1) | (self.cells[first + b] == mark[:, None]).any(axis=1)
        return hit & known


def _bytes(digests) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 16)


def _built(keys: DataFrame, shards: int, grow: int = 1) -> DataFrame:
    """``shard, cells`` from all keys of the shards; a filter that overflows
    doubles until it holds them."""
    def build(table: pa.Table) -> pa.Table:
        digests = _bytes(sorted(table.column("digest").to_pylist()))
        room = len(digests) * grow
        while not (made := CuckooFilter.sized(room)).insert(digests):
            room *= 2
        return pa.table({"shard": table.column("shard").slice(0, 1).combine_chunks(), "cells": pa.array([made.cells.tobytes()], pa.binary())})
    return keys.select(_shard(shards).alias("shard"), "digest").groupBy("shard").applyInArrow(build, "shard int, cells binary")


def _changed(filters: DataFrame, changes: DataFrame) -> DataFrame:
    """Filters after ``changes(shard, digest, add)``: ``cells`` is null where a
    shard must be built anew."""
    def change(have: pa.Table, new: pa.Table) -> pa.Table:
        shard = (new if new.num_rows else have).column("shard").slice(0, 1).combine_chunks()
        cells = have.column("cells")[0].as_py() if have.num_rows else None
        if cells is not None and new.num_rows:
            made = CuckooFilter(np.frombuffer(cells, np.uint16).copy())
            both = sorted(zip(new.column("digest").to_pylist(), new.column("add").to_pylist()))
            made.delete(_bytes([d for d, add in both if not add]))
            cells = made.cells.tobytes() if made.insert(_bytes([d for d, add in both if add])) else None
            cells = made.cells.tobytes() if cells is not None else None
        return pa.table({"shard": shard, "cells": pa.array([cells], pa.binary())})
    return filters.groupBy("shard").cogroup(changes.groupBy("shard")).applyInArrow(change, "shard int, cells binary")


# --- the index -------------------------------------------------------------------

def new_index(spark: SparkSession, least: int = 10, least_chars: int = 1) -> LineIndex:
    """An index without documents: lines of at least ``least_chars`` code points
    are repeated when ``least`` documents hold them."""
    return LineIndex(spark.createDataFrame([], "digest binary, n long"), spark.createDataFrame([], "shard int, cells binary"), 1, least, least_chars)


def _updated(index: LineIndex, docs: DataFrame, text: str, sign: int) -> LineIndex:
    zero = F.lit(0).cast("long")
    delta = _document_counts(docs, text, index.least_chars).select("digest", zero.alias("old"), (sign * F.col("n")).alias("n"))
    both = index.counts.select("digest", F.col("n").alias("old"), "n").unionByName(delta)
    both = stage_table(both.groupBy("digest").agg(F.sum("old").alias("old"), F.sum("n").alias("n")), "line-counts")
    is_in = F.col("n") >= index.least
    moved = is_in != (F.col("old") >= index.least)
    wrong, keys, changes = both.agg(F.count_if(F.col("n") < 0), F.count_if(is_in), F.count_if(moved)).first()
    if wrong:
        raise ValueError(f"{wrong} lines would stand in fewer than 0 documents: only inserted documents can be deleted")
    counts, frequent = both.where("n > 0").select("digest", "n"), both.where(is_in).select("digest")
    shards = index.shards
    if keys > 2 * shards * SHARD_KEYS or changes >= keys:    # outgrown, or mostly new: from the exact table
        shards = max(1, -(-keys // SHARD_KEYS))
        filters = stage_table(_built(frequent, shards), "line-filters")
    else:
        filters = stage_table(_changed(index.filters, both.where(moved).select(_shard(shards).alias("shard"), "digest", is_in.alias("add"))), "line-filters")
        full = filters.where("cells is null").select("shard")
        anew = _built(frequent.withColumn("shard", _shard(shards)).join(full, "shard", "left_semi").select("digest"), shards, 2)
        filters = stage_table(filters.where("cells is not null").unionByName(anew), "line-filters")
    return LineIndex(counts, filters, shards, index.least, index.least_chars)


def insert(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index with ``docs`` added. Every row counts as a document, also when
    its key repeats; null texts have no lines to count."""
    return _updated(index, docs, text, 1)


def delete(index: LineIndex, docs: DataFrame, text: str = "text") -> LineIndex:
    """The index with ``docs``, inserted before, taken out again."""
    return _updated(index, docs, text, -1)


def repeated_lines(index: LineIndex) -> DataFrame:
    """``digest, n`` of the keys that stand in ``least`` documents or more."""
    return index.counts.where(F.col("n") >= index.least)


# --- dropping lines ----------------------------------------------------------------

def _kept(part: pa.RecordBatch, least_chars: int, repeated: Callable) -> pa.RecordBatch:
    """Rows without their repeated lines; ``repeated`` marks a slice's lines
    that have a digest, given those digests and their rows."""
    buf, at = flat(part.column("text"))
    lines = cut_lines(buf, at)
    keys = key_digests(buf, lines, least_chars)
    some = np.array([i for i, k in enumerate(keys) if k is not None], np.int64)
    gone = np.zeros(len(keys), bool)
    if len(some):
        gone[some] = repeated([keys[i] for i in some], np.searchsorted(lines.row, some, side="right") - 1)
    raw, starts, ends, out = buf.tobytes(), lines.start.tolist(), lines.end.tolist(), []
    drop = np.concatenate([[0], np.cumsum(gone)])
    for a, b in zip(lines.row[:-1].tolist(), lines.row[1:].tolist()):
        whole = raw[starts[a]:ends[b - 1]]
        out.append((whole if drop[b] == drop[a] else b"\n".join(raw[starts[i]:ends[i]] for i in range(a, b) if not gone[i])).decode("utf-8"))
    return pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(out, pa.string()), pa.array(np.diff(lines.row)), pa.array(np.diff(drop[lines.row]))],
                                      ["doc_id", "kept_text", "n_lines", "n_dropped"])


def _positives(digests: DataFrame, lookup) -> DataFrame:
    """Rows whose ``digest`` the broadcast filters have."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(lookup.value.has(_bytes(batch.column("digest").to_pylist()))))
    return digests.mapInArrow(run, digests.schema)


def _blocks(filters: DataFrame, limit: int) -> list[tuple[int, int]]:
    """Ranges of shards whose filters have at most ``limit`` bytes (a single
    larger filter is a block of its own), from one row of sizes per shard."""
    out, size = [], 0
    for r in filters.select("shard", F.length("cells").alias("n")).orderBy("shard").toLocalIterator():
        if not out or size + r["n"] > limit:
            out.append((r["shard"], r["shard"]))
            size = 0
        out[-1], size = (out[-1][0], r["shard"]), size + r["n"]
    return out


def _broadcast(index: LineIndex, low: int, high: int):
    rows = index.filters.where(F.col("shard").between(low, high)).collect()
    return index.filters.sparkSession.sparkContext.broadcast(Lookup({r["shard"]: r["cells"] for r in rows}, index.shards))


def drop_repeated_lines(docs: DataFrame, index: LineIndex, key: str = "doc_id", text: str = "text",
                        broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``doc_id, kept_text, n_lines, n_dropped`` for every row of ``docs``, in
    the index or not: its text without the lines that the index holds in
    ``least`` documents or more; the other lines stay as they are.

    A null or empty text is one empty line, which stays. Rows that repeat a key
    are handled one by one; other columns are ignored; an empty table gives no rows.
    """
    spark, least_chars = docs.sparkSession, index.least_chars
    kind = docs.schema[key].dataType.simpleString()
    out = f"doc_id {kind}, kept_text string, n_lines long, n_dropped long"
    plain = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    blocks = _blocks(index.filters, broadcast_bytes)
    frequent = repeated_lines(index).select("digest")
    if len(blocks) <= 1:
        lookup = _broadcast(index, *blocks[0]) if blocks else spark.sparkContext.broadcast(Lookup({}, index.shards))
        wrong = _positives(_document_counts(docs, text, least_chars).select("digest"), lookup).distinct().join(frequent, "digest", "left_anti")
        wrong = stage_table(wrong, "line-exceptions")
        if 16 * wrong.count() <= broadcast_bytes:
            exceptions = spark.sparkContext.broadcast(frozenset(r["digest"] for r in wrong.toLocalIterator()))

            def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
                def repeated(keys, rows):
                    hit = lookup.value.has(_bytes(keys))
                    return hit & np.array([not h or k not in exceptions.value for k, h in zip(keys, hit.tolist())])
                for batch in batches:
                    for part in slices(batch, "text"):
                        yield _kept(part, least_chars, repeated)
            return plain.mapInArrow(run, out)
    return _dropped_by_join(plain, index, frequent, blocks, out)


def _dropped_by_join(plain: DataFrame, index: LineIndex, frequent: DataFrame, blocks: list[tuple[int, int]], out: str) -> DataFrame:
    """The way without a bound on the filters: one block of them at a time."""
    spark, least_chars = plain.sparkSession, index.least_chars
    # Equal rows have equal lines, so a row is named by its content.
    named = plain.withColumn("h", F.unhex(F.sha2(F.to_json(F.struct("doc_id", "text")), 256)))
    starts = F.array(*[F.lit(a) for a, _ in blocks])
    block = (F.size(F.filter(starts, lambda a: a <= F.col("shard"))) - 1).alias("block")

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buf, at = flat(part.column("text"))
                lines = cut_lines(buf, at)
                keys, pairs = key_digests(buf, lines, least_chars), []
                for r, h in enumerate(part.column("h").to_pylist()):
                    pairs += [(h, k) for k in set(keys[lines.row[r]:lines.row[r + 1]]) if k is not None]
                yield pa.RecordBatch.from_arrays([pa.array([p[i] for p in pairs], pa.binary()) for i in (0, 1)], ["h", "digest"])
    path = scratch_path(spark, f"llm/line-digests-{uuid.uuid4().hex}")
    lines = named.select("h", "text").mapInArrow(each, "h binary, digest binary").withColumn("shard", _shard(index.shards))
    lines.select("h", "digest", block).write.partitionBy("block").parquet(path)
    found = None
    for i, (low, high) in enumerate(blocks):
        lookup = _broadcast(index, low, high)
        mine = spark.read.schema("h binary, digest binary, block int").parquet(path).where(F.col("block") == i).select("h", "digest")
        hits = stage_table(_positives(mine, lookup), "line-positives")
        lookup.destroy()
        found = hits if found is None else found.unionByName(hits)
    found = found.distinct().join(frequent, "digest", "left_semi").groupBy("h").agg(F.collect_list("digest").alias("gone"))
    joined = named.join(found, "h", "left").select("doc_id", "text", "gone")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                gone = [frozenset(x or ()) for x in part.column("gone").to_pylist()]
                yield _kept(part, least_chars, lambda keys, rows: np.array([k in gone[r] for k, r in zip(keys, rows.tolist())]))
    return joined.mapInArrow(run, out)
