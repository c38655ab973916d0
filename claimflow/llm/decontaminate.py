"""Benchmark decontamination with training suffix arrays.

Each slice of whole documents is one shard: its words that can take part in a
match (runs of words whose neighbours also follow each other in some test item)
become an array of word numbers, and a suffix array over it is built by prefix
doubling. Every distinct window of the test suffixes is then found in the shard by
binary search; the suffixes in its range are the places of verbatim matches. A
place starts at most one window of each length, so matches stay linear in the
text, however often text and items repeat themselves; which items hold a window is
kept apart. The longest match from a place on is its longest common prefix with a
neighbour in the order of all test suffixes.

Scale: the pass over the documents is map-only, whatever the skew. The test set is
read in blocks of at most ``BLOCK_WORDS`` words, one broadcast at a time; each
block is one pass that adds its matches to the rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import ALNUM, LOWER, _power_tables, discard, flat, mix, rows_of, slices, stage_table, word_hashes, words
from claimflow.operators.ranges import running_sums

BLOCK_WORDS = 500_000
SHARD_BYTES = 2_000_000


class TestBlock:
    """Test items as word numbers: vocabulary, distinct windows with the items
    that hold them, neighbour pairs, and the order of all test suffixes."""

    def __init__(self, items: list[tuple[str | None, str]], window: int):
        self.ids, self.window = [i for i, _ in items], window
        buf, at = flat(pa.array([t for _, t in items], pa.large_string()))
        buf = LOWER[buf]
        w = words(buf, at, ALNUM)
        self.hashes, first, number = np.unique(word_hashes(buf, w), return_index=True, return_inverse=True)
        self.words = [buf[w.start[i]:w.end[i]].tobytes() for i in first]
        size = np.diff(w.row)
        reach = np.where(size >= window, window, size)          # an item's window
        row = rows_of(w.row)
        place = np.arange(len(row)) - w.row[row]
        starts = np.flatnonzero(place + reach[row] <= size[row])
        self.shortest = int(reach[size > 0].min()) if (size > 0).any() else 0
        deep = int(reach[row[starts]].max()) if len(starts) else 0
        padded = np.concatenate([number, np.zeros(deep, number.dtype)]) + 1
        every = padded[starts[:, None] + np.arange(deep)]
        every[np.arange(deep) >= reach[row[starts]][:, None]] = 0
        _, one, window_of = np.unique(np.concatenate([reach[row[starts]][:, None], every], axis=1), axis=0, return_index=True, return_inverse=True)
        self.suffixes, self.reach = every[one], reach[row[starts]][one]
        # Items per window; windows with the same items share their list.
        held = np.unique(np.stack([window_of.ravel(), row[starts]], axis=1), axis=0) if len(starts) else np.zeros((0, 2), np.int64)
        cut = np.searchsorted(held[:, 0], np.arange(len(one) + 1))
        known: dict[bytes, int] = {}
        self.item_sets, self.set_of = [], np.zeros(len(one), np.int64)
        for i, (a, b) in enumerate(zip(cut[:-1].tolist(), cut[1:].tolist())):
            mine = held[a:b, 1]
            self.set_of[i] = known.setdefault(mine.tobytes(), len(known))
            if len(known) > len(self.item_sets):
                self.item_sets.append({self.ids[j] for j in mine.tolist()} - {None})
        same = row[1:] == row[:-1]
        self.pairs = np.unique((number[:-1] * len(self.hashes) + number[1:])[same])
        # All items in one array, each with an end of its own kind.
        self.tokens = np.full(len(number) + len(items), len(self.hashes) + 1, np.int64)
        self.tokens[np.arange(len(number)) + row] = number + 1
        self.deepest = int(size.max(initial=0))
        self.order = suffix_array(self.tokens, max(self.deepest, 1))
        self.rolled = _rolled(self.tokens)


def _rolled(tokens: np.ndarray) -> np.ndarray:
    up, _ = _power_tables(len(tokens) + 1)
    out = np.zeros(len(tokens) + 1, np.uint64)
    np.cumsum(mix(tokens.astype(np.uint64) + np.uint64(1)) * up[:len(tokens)], out=out[1:])
    return out


def longest_matches(tokens: np.ndarray, at: np.ndarray, block: TestBlock) -> np.ndarray:
    """For each place in ``tokens``, how many words from there on some item holds
    in a row: its place in the order of the test suffixes is found by binary
    search, and a neighbour there shares the most."""
    rolled, n, m = _rolled(tokens), len(tokens), len(block.tokens)
    _, down = _power_tables(max(n, m) + 1)

    def common(p: np.ndarray, t: np.ndarray) -> np.ndarray:
        lo, hi = np.zeros(len(p), np.int64), np.minimum(np.minimum(n - p, m - t), block.deepest)
        while (lo < hi).any():
            mid = (lo + hi + 1) // 2
            same = (rolled[p + mid] - rolled[p]) * down[p] == (block.rolled[t + mid] - block.rolled[t]) * down[t]
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo
    lo, hi = np.zeros(len(at), np.int64), np.full(len(at), m, np.int64)
    while (lo < hi).any():
        mid = np.minimum((lo + hi) // 2, m - 1)
        t = block.order[mid]
        k = common(at, t)
        less = block.tokens[np.minimum(t + k, m - 1)] < tokens[np.minimum(at + k, n - 1)]
        go = lo < hi
        lo, hi = np.where(go & less, mid + 1, lo), np.where(go & ~less, mid, hi)
    return np.maximum(*[np.where((lo + d >= 0) & (lo + d < m), common(at, block.order[np.clip(lo + d, 0, m - 1)]), 0) for d in (-1, 0)])


def suffix_array(tokens: np.ndarray, deep: int) -> np.ndarray:
    """Positions ordered by their first ``deep`` tokens (prefix doubling)."""
    n = len(tokens)
    rank, reach = tokens.astype(np.int64), 1
    while reach < deep:
        ahead = np.zeros(n, np.int64)
        ahead[:n - reach] = rank[reach:] + 1
        values, rank = np.unique(rank * (ahead.max(initial=0) + 1) + ahead, return_inverse=True)
        if len(values) == n:
            break
        reach *= 2
    return np.argsort(rank, kind="stable")


def _bound(tokens: np.ndarray, order: np.ndarray, block: TestBlock, upper: bool) -> np.ndarray:
    """For each test suffix, how many suffixes of the shard sort before it, or,
    with ``upper``, before or under it; compared on the suffix's window."""
    queries, reach = block.suffixes, block.reach
    lo, hi = np.zeros(len(queries), np.int64), np.full(len(queries), len(order), np.int64)
    padded = np.concatenate([tokens, np.zeros(queries.shape[1], tokens.dtype)])
    span = np.arange(queries.shape[1])
    while (lo < hi).any():
        mid = (lo + hi) // 2
        here = padded[order[np.minimum(mid, len(order) - 1)][:, None] + span]
        differ = (here != queries) & (span < reach[:, None])
        at = differ.argmax(axis=1)
        k = np.arange(len(queries))
        less = np.where(differ[k, at], here[k, at] < queries[k, at], upper)
        go = lo < hi
        lo = np.where(go & less, mid + 1, lo)
        hi = np.where(go & ~less, mid, hi)
    return lo


def matches(batch: pa.RecordBatch, block: TestBlock):
    """Words per row, the places (row, word, window) of all windows found, and
    the longest match that begins at each place."""
    buf, at = flat(batch.column("text"))
    buf = LOWER[buf]
    w = words(buf, at, ALNUM)
    none = np.zeros(0, np.int64)
    if not len(w.start) or not len(block.suffixes):
        return np.diff(w.row), none, none, none, none
    h = word_hashes(buf, w)
    number = np.searchsorted(block.hashes, h)
    number[number == len(block.hashes)] = 0
    known = block.hashes[number] == h
    row = rows_of(w.row)
    joined = known[1:] & known[:-1] & (row[1:] == row[:-1])
    if block.shortest > 1:
        two = np.flatnonzero(joined)
        pair = number[two] * len(block.hashes) + number[two + 1]
        slot = np.minimum(np.searchsorted(block.pairs, pair), max(len(block.pairs) - 1, 0))
        joined[two] = block.pairs[slot] == pair if len(block.pairs) else False
    # Runs of joined words, as long as the shortest window at least.
    begin = known.copy()
    begin[1:] &= ~joined
    stop = known.copy()
    stop[:-1] &= ~joined
    lo, hi = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    keep = hi - lo >= block.shortest
    lo, hi = lo[keep], hi[keep]
    if not len(lo):
        return np.diff(w.row), none, none, none, none
    size = hi - lo + 1                                       # a 0 ends each run
    where = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size) + np.repeat(lo, size)
    ends = np.cumsum(size) - 1
    tokens = number[np.minimum(where, len(number) - 1)] + 1
    tokens[ends] = 0
    order = suffix_array(tokens, block.suffixes.shape[1])
    first, last = _bound(tokens, order, block, False), _bound(tokens, order, block, True)
    n = last - first
    window = np.repeat(np.arange(len(n)), n)
    place = order[np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first, n)]
    true = _verbatim(buf, w, number, where[place], block.reach[window], block)
    place, window = place[true], window[true]
    whole = block.reach[window] == block.window       # a shorter item matches as a whole
    longest = block.reach[window].copy()
    longest[whole] = np.maximum(longest_matches(tokens, place[whole], block), block.window)
    found = where[place]
    return np.diff(w.row), row[found], found - w.row[row[found]], window, longest


def _verbatim(buf, w, number, found, reach, block: TestBlock) -> np.ndarray:
    """Compare the matched words' bytes; hashes found them."""
    hit = np.zeros(len(number) + 1, np.int64)
    np.add.at(hit, found, 1)
    np.add.at(hit, found + reach, -1)
    wrong = [i for i in np.flatnonzero(np.cumsum(hit[:-1]) > 0).tolist()
             if buf[w.start[i]:w.end[i]].tobytes() != block.words[number[i]]]
    bad = np.zeros(len(number) + 1, np.int64)
    bad[np.array(wrong, np.int64) + 1] = 1
    bad = np.cumsum(bad)
    return bad[np.minimum(found + reach, len(number))] == bad[found]


def _spans(start: np.ndarray, end: np.ndarray) -> list[dict]:
    """Union of ranges, as sorted disjoint ones."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(start), bool)
    new[1:] = start[1:] > end[:-1]
    return [{"start": a, "end": b} for a, b in zip(start[new].tolist(), end[np.append(np.flatnonzero(new)[1:] - 1, len(end) - 1)].tolist())]


_STATE = "n_words long, longest int, spans array<struct<start:int,end:int>>, item_ids array<string>"


def _pass(rows: DataFrame, block, kind: str) -> DataFrame:
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        test = block.value
        for batch in batches:
            for part in slices(batch, "text", SHARD_BYTES):
                n_words, row, place, window, match = matches(part, test)
                order = np.argsort(row, kind="stable")
                row, place, window, match = row[order], place[order], window[order], match[order]
                longest = np.asarray(part.column("longest")).copy()
                spans, items = part.column("spans").to_pylist(), part.column("item_ids").to_pylist()
                edges = np.append(np.flatnonzero(np.diff(row, prepend=-1)), len(row)).tolist()
                for a, b in zip(edges, edges[1:]):
                    r, p, s = int(row[a]), place[a:b], np.unique(window[a:b])
                    old = spans[r]
                    spans[r] = _spans(np.concatenate([p, np.array([x["start"] for x in old], np.int64)]),
                                      np.concatenate([p + test.reach[window[a:b]], np.array([x["end"] for x in old], np.int64)]))
                    items[r] = sorted(set(items[r]).union(*(test.item_sets[k] for k in np.unique(test.set_of[s]).tolist())))
                    longest[r] = max(longest[r], int(match[a:b].max()))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(n_words, pa.int64()), pa.array(longest, pa.int32()),
                     pa.array(spans, span), pa.array(items, pa.list_(pa.string()))],
                    ["doc_id", "text", "n_words", "longest", "spans", "item_ids"])
    return rows.mapInArrow(run, f"doc_id {kind}, text string, {_STATE}")


def contamination(docs: DataFrame, items: DataFrame, window: int = 10, key: str = "doc_id", text: str = "text",
                  item_key: str = "item_id", item_text: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc_id, text, n_words, longest, spans, item_ids`` for every row.

    Words are runs of digits, letters and non-ASCII, A-Z lower-cased. A match is
    ``window`` consecutive words of an item, or a shorter item as a whole.
    ``spans`` are the matched word ranges (end exclusive), ``longest`` the words
    of the longest verbatim match, ``item_ids`` the matching items as sorted
    strings (as many as hold its windows). Null texts have no words; an item without words matches nothing; an
    item with a null key marks words but isn't listed. Repeated rows are judged
    one by one; without items, or rows, nothing matches. Other columns are
    ignored.
    """
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.lit(0).cast("long").alias("n_words"),
                       F.lit(0).alias("longest"), F.expr("cast(array() as array<struct<start:int,end:int>>)").alias("spans"),
                       F.expr("cast(array() as array<string>)").alias("item_ids"))
    spark = docs.sparkSession
    tests = items.select(F.col(item_key).cast("string").alias("k"), F.col(item_text).alias("t")).where("t is not null")
    size = (F.length("t") / 2).cast("long") + 1              # words at most
    if (tests.agg(F.sum(size)).first()[0] or 0) <= block_words:
        return _pass(rows, spark.sparkContext.broadcast(TestBlock([tuple(r) for r in tests.collect()], window)), kind)
    # Too many for one broadcast: blocks of whole items, one pass after the other.
    laid = running_sums(tests.withColumn("size", size), [F.col("k"), F.col("t")], ["size"], name="test-items")
    laid = stage_table(laid.select("k", "t", F.expr(f"(cum_size - 1) div {block_words}").alias("block")), "test-blocks")
    for number in range((laid.agg(F.max("block")).first()[0] or 0) + 1):
        block = spark.sparkContext.broadcast(TestBlock([(r["k"], r["t"]) for r in laid.where(F.col("block") == number).collect()], window))
        done = stage_table(_pass(rows, block, kind), "matches")
        if number:
            discard(rows)
        block.destroy()
        rows = done
    return rows


def report(docs: DataFrame, items: DataFrame, **options) -> DataFrame:
    """Digest of ``contamination``: counts, item list hash and the decision."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return contamination(docs, items, **options).select(
        "doc_id", "n_words", n_hit.alias("n_hit"), F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"), "longest")


def clean_documents(docs: DataFrame, items: DataFrame, text: str = "text", **options) -> DataFrame:
    """``docs`` without the affected documents, all columns kept. The other
    columns ride through the search beside the text, so rows are judged one by
    one, whatever their keys; null and empty texts stay, and without items, or
    rows, nothing goes."""
    rest = [c for c in docs.columns if c != text]
    beside = F.struct(*rest) if rest else F.struct(F.lit(0).alias("none"))
    found = contamination(docs.select(beside.alias("doc_id"), F.col(text).alias("text")), items, **options)
    return found.where(F.size("spans") == 0).select(*[F.col("text").alias(c) if c == text else F.col("doc_id")[c].alias(c) for c in docs.columns])
