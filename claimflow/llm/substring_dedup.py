"""Exact substring deduplication over content-defined chunks.

A gear hash rolls over the bytes of the words; where its top bits are zero at the
end of a word, the text is cut, so that chunks are of variable length and their
bounds move with the content: an insertion changes the bounds next to it and no
others. Chunks are compared by digest.

A passage is ``least_words`` words in a row. Every window of that length is filed
under the digest of the first chunk that lies in it whole, hashed bytes included,
so under what its own words say, and a window that stands in two documents is filed
alike in both. The few windows without a whole chunk (long stretches without a cut,
words repeated on and on) are filed under the least of the hashes of their shorter
word runs. A digest that stands in one document only has no repeated window. If all
its holders hold the same run of windows under it, these are repeated and belong to
the document with the smallest key. Else (ends of passages, edits) the windows
under it are compared one by one. So a window counts as repeated exactly if one
other document holds it whole, words as 64-bit hashes and white space apart, and
its owner is the document with the smallest key that holds it whole; what other
documents hold of it is removed.

Text without spaces: a word of more than ``LONG_WORD`` bytes is taken as its
characters, and ``WORD_BYTES`` bytes of them count as one word. Bounds between
these characters move with the content, and one word, or a few, repeated on and
on are windows like others. Not found: a passage cut off inside a word of up to
``LONG_WORD`` bytes lacks that word, and a stretch without spaces that is longer
than that in one document and shorter in the other differs.

Scale: chunk rows are distinct per text and pre-aggregated to the smallest and
largest key per seed before the shuffle, and flags come back by an equi-join that
can be split, so a passage in a third of all documents lands in no single task.
Rows grow with the words, never with pairs of documents. A document's flags are
gathered with the document only.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import NON_SPACE, Words, _power_tables, flat, mix, rows_of, slices, stage_table, word_hashes, words

LEAST_WORDS = 50
LONG_WORD = 32
WORD_BYTES = 6
GEAR_BYTES = 32     # bytes that the gear hash reaches back: one for each of its bits
CUT_BITS = 3        # a cut every 2 ** 3 words or so
GEAR = (mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)).astype(np.uint32)


def units(buf: np.ndarray, at: np.ndarray) -> tuple[Words, np.ndarray]:
    """Words of the rows, long ones as their characters, and what each counts:
    ``WORD_BYTES`` for a word, its bytes for a character."""
    w = words(buf, at, NON_SPACE)
    long = w.end - w.start > LONG_WORD
    if not long.any():
        return w, np.full(len(w.start), WORD_BYTES)
    step = np.zeros(len(buf) + 1, np.int8)
    step[w.start[long]] += 1
    step[w.end[long]] -= 1
    inside = np.cumsum(step[:-1], dtype=np.int8) > 0
    char = np.flatnonzero(inside & (buf & 0xC0 != 0x80))
    start = np.union1d(w.start, char)
    end = np.union1d(w.end, np.setdiff1d(char, w.start, assume_unique=True))
    return Words(start, end, np.searchsorted(start, at)), np.where(inside[start], end - start, WORD_BYTES)


def cut_points(buf: np.ndarray, w: Words) -> tuple[np.ndarray, np.ndarray]:
    """Words after which the text is cut, ascending, and for each the last word
    from which on all hashed bytes lie (-1: before the first). The hash runs over
    the words with one separator after each, whatever white space there is."""
    size = w.end - w.start + 1
    stop = np.cumsum(size)
    source = np.arange(int(size.sum())) + np.repeat(w.start - (stop - size), size)
    source[stop - 1] = 0
    plain = buf[source] if len(source) else np.zeros(0, np.uint8)
    plain[stop - 1] = 0x20
    gear, n = GEAR[plain], 1
    while n < GEAR_BYTES:               # sums over 2, 4, ... bytes, each byte shifted by its distance
        gear[n:] += gear[:-n] << np.uint32(n)
        n *= 2
    cuts = np.flatnonzero(gear[stop - 1] >> np.uint32(GEAR_BYTES - CUT_BITS) == 0)
    return cuts, np.searchsorted(stop - size, stop[cuts] - GEAR_BYTES, side="right") - 1


class Windows(NamedTuple):
    """Windows of a slice: first word, end, digest they are filed under and own
    digest; per row, the range of window numbers; and the first window of each
    run of windows that are filed alike."""
    begin: np.ndarray
    end: np.ndarray
    seed: np.ndarray
    digest: np.ndarray
    row: np.ndarray
    first: np.ndarray


def _windows(buf: np.ndarray, w: Words, count: np.ndarray, least_words: int) -> Windows:
    n = len(w.start)
    total = np.concatenate([[0], np.cumsum(count)])
    end = np.searchsorted(total, total[:-1] + least_words * WORD_BYTES)
    begin = np.flatnonzero(end <= w.row[1:][rows_of(w.row)])
    end = end[begin]
    up, down = _power_tables(n + 1)
    rolled = np.zeros(n + 1, np.uint64)
    np.cumsum(word_hashes(buf, w) * up[:n], out=rolled[1:])

    def digest(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return mix((rolled[b] - rolled[a]) * down[a] + (b - a).astype(np.uint64))
    cuts, reach = cut_points(buf, w)
    chunk = np.searchsorted(reach, begin)                    # first cut that the window holds, hashed bytes and all
    whole = chunk + 1 < len(cuts)
    whole[whole] = cuts[chunk[whole] + 1] < end[whole]
    seed, place = np.zeros(len(begin), np.uint64), np.where(whole, chunk, 0)
    seed[whole] = mix(digest(cuts[chunk[whole]] + 1, cuts[chunk[whole] + 1] + 1) + np.uint64(1))
    rest = np.flatnonzero(~whole)
    # Each window has least_words words or characters at least, and so all its word runs.
    choices = max(1, least_words * 2 // 7)
    run = least_words - choices + 1
    value = digest(np.arange(max(0, n - run + 1)), np.arange(run, max(run, n + 1)))
    least, where = value[begin[rest]], begin[rest].copy()
    for d in range(1, choices):
        other = value[begin[rest] + d]
        less = other <= least
        least[less], where[less] = other[less], begin[rest][less] + d
    seed[rest], place[rest] = mix(least + np.uint64(2)), len(cuts) + where
    row = np.searchsorted(begin, w.row)
    first = np.ones(len(begin), bool)
    first[1:] = place[1:] != place[:-1]
    first[row[:-1][row[:-1] < row[1:]]] = True
    return Windows(begin, end, seed, digest(begin, end), row, np.flatnonzero(first))


def _chunk_rows(batch: pa.RecordBatch, least_words: int = LEAST_WORDS):
    """Per run of windows filed alike: digest of the run, and what it is filed
    under; before them the bytes and row offsets, after them the windows, the
    words and the row bounds of the runs."""
    buf, at = flat(batch.column("text"))
    w, count = units(buf, at)
    win = _windows(buf, w, count, least_words)
    size = np.diff(np.append(win.first, len(win.begin)))
    digest = np.zeros(len(win.first), np.uint64)
    longest = int(size.max()) if len(size) else 0
    for i in range(longest):                                 # chunks in step, window by window
        go = np.flatnonzero(size > i)
        digest[go] = mix(digest[go] + win.digest[win.first[go] + i] + np.uint64(1))
    return buf, at, digest.view(np.int64), win.seed[win.first].view(np.int64), win, w, np.searchsorted(win.first, win.row)


def _distinct(*columns: np.ndarray) -> np.ndarray:
    """Places of the distinct rows of columns, in their order."""
    order = np.lexsort(columns[::-1])
    new = np.ones(len(order), bool)
    new[1:] = np.any([c[order][1:] != c[order][:-1] for c in columns], axis=0)
    return order[new]


def _chunks(docs: DataFrame, kind: str, least_words: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                _, _, digest, seed, *_, bounds = _chunk_rows(part, least_words)
                row = rows_of(bounds)
                one = _distinct(row, seed, digest)
                take = pa.array(row[one])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(seed[one]),
                                                  pa.array(digest[one])], ["doc_id", "text_hash", "seed", "digest"])
    return docs.mapInArrow(run, f"doc_id {kind}, text_hash long, seed long, digest long")


def _held(column: pa.Array, r: int) -> np.ndarray:
    """The numbers of one row's list; none for null."""
    v = column[r].values
    return np.zeros(0, np.int64) if v is None else np.asarray(v)


def _open_windows(docs: DataFrame, kind: str, least_words: int) -> DataFrame:
    """Windows of the chunks whose seeds are in ``open``."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                *_, win, _, _ = _chunk_rows(part, least_words)
                seed, digest = win.seed.view(np.int64), win.digest.view(np.int64)
                found = [digest[a:b][np.isin(seed[a:b], _held(part.column("open"), r))] for r, (a, b) in enumerate(zip(win.row[:-1], win.row[1:]))]
                digest, row = np.concatenate(found), np.repeat(np.arange(len(found)), [len(x) for x in found])
                one = _distinct(row, digest)
                take = pa.array(row[one])
                yield pa.RecordBatch.from_arrays([part.column("doc_id").take(take), part.column("text_hash").take(take), pa.array(digest[one])],
                                                 ["doc_id", "text_hash", "digest"])
    return docs.mapInArrow(run, f"doc_id {kind}, text_hash long, digest long")


def _mark(kind: str, least_words: int):
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                buf, at, _, _, win, w, bounds = _chunk_rows(part, least_words)
                seed, digest = win.seed.view(np.int64), win.digest.view(np.int64)
                n_chunks = np.maximum(np.diff(bounds), np.diff(w.row) > 0)
                repeated, removed, texts = [], [], []
                for r in range(part.num_rows):
                    a, b = win.row[r], win.row[r + 1]
                    one, gone = [], []
                    if part.column("own")[r].is_valid:
                        own, cut = (np.isin(seed[a:b], _held(part.column(s), r)) | np.isin(digest[a:b], _held(part.column(d), r))
                                    for s, d in (("own", "own_windows"), ("cut", "cut_windows")))
                        one, gone = (_spans(win.begin[a:b][x], win.end[a:b][x], w, int(at[r])) for x in (own | cut, cut))
                    whole = buf[at[r]:at[r + 1]]
                    last, kept = 0, []
                    for g in gone:
                        kept.append(whole[last:g["start"]].tobytes())
                        last = g["end"]
                    kept.append(whole[last:].tobytes())
                    repeated.append(one)
                    removed.append(gone)
                    texts.append(b"".join(kept).decode("utf-8") if part.column("text")[r].is_valid else None)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(n_chunks, pa.int32()), pa.array(repeated, span),
                                                  pa.array(removed, span), pa.array(texts, pa.string())],
                                                 ["doc_id", "n_chunks", "repeated_spans", "removed_spans", "text"])
    return run, f"doc_id {kind}, n_chunks int, repeated_spans array<struct<start:int,end:int>>, removed_spans array<struct<start:int,end:int>>, text string"


def _spans(begin: np.ndarray, end: np.ndarray, w: Words, at: int) -> list[dict[str, int]]:
    """Byte spans that windows (sorted) cover together; touching ones are one."""
    if not len(begin):
        return []
    cut = np.flatnonzero(begin[1:] > end[:-1])
    return [{"start": int(w.start[i]) - at, "end": int(w.end[j - 1]) - at}
            for i, j in zip(begin[np.append(0, cut + 1)], end[np.append(cut, len(end) - 1)])]


def _shared(found: DataFrame, on: str, *more) -> DataFrame:
    """Values of ``on`` in two documents, with the smallest key."""
    return found.groupBy(on).agg(F.min("doc_id").alias("owner"), F.max("doc_id").alias("last"), *more).where("owner < last").drop("last")


def _lists(found: DataFrame, shared: DataFrame, on: str, **lists) -> DataFrame:
    """Per text, the values of ``on`` for which a condition holds."""
    return (found.join(shared, on).groupBy("doc_id", "text_hash")
            .agg(*[F.collect_set(F.when(c, F.col(on))).alias(name) for name, c in lists.items()]))


def deduplicate_substrings(docs: DataFrame, least_words: int = LEAST_WORDS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_chunks, repeated_spans, removed_spans, repeated, removed,
    text`` for every row of ``docs``.

    ``repeated_spans`` are the byte ranges (UTF-8) of passages that another
    document holds too; ``removed_spans`` what is cut of them because a document
    with a smaller key owns it; ``text`` is the rest. ``repeated`` and
    ``removed`` say whether there is any. The space after a cut stays.
    A text shorter than a window is one chunk. Null texts stay null, and like
    empty ones have no chunks. Rows that repeat a key are one document: they
    don't make each other's windows repeated, and each comes back; repeats
    inside one document stay. A null key owns nothing and is compared with
    nothing. Other columns are ignored; an empty table gives no rows.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.xxhash64(F.col(text)).alias("text_hash"))
    owned, alike = F.col("doc_id") == F.col("owner"), F.col("alike")
    found = stage_table(_chunks(rows.where("doc_id is not null and text is not null"), kind, least_words), "chunks")
    shared = stage_table(_shared(found, "seed", (F.min("digest") == F.max("digest")).alias("alike")), "shared-seeds")
    flags = stage_table(_lists(found, shared, "seed", own=alike & owned, cut=alike & ~owned, open=~alike), "flags")
    opened = rows.join(flags.where(F.size("open") > 0).select("doc_id", "text_hash", "open"), ["doc_id", "text_hash"])
    found = stage_table(_open_windows(opened, kind, least_words), "windows")
    shared = stage_table(_shared(found, "digest"), "shared-windows")
    flags = flags.drop("open").join(_lists(found, shared, "digest", own_windows=owned, cut_windows=~owned), ["doc_id", "text_hash"], "left")
    run, schema = _mark(kind, least_words)
    marked = rows.join(stage_table(flags, "all-flags"), ["doc_id", "text_hash"], "left").mapInArrow(run, schema)
    return marked.select("doc_id", "n_chunks", "repeated_spans", "removed_spans", (F.size("repeated_spans") > 0).alias("repeated"),
                         (F.size("removed_spans") > 0).alias("removed"), "text")
