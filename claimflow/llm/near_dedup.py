"""MinHash near-duplicate groups with HyperMinHash registers.

A document's set is its distinct word shingles, as 64-bit hashes. Each hash
falls in one of 192 registers, and a register keeps the smallest hash as its
leading-zero count (6 bits) and the next 10 mantissa bits (HyperMinHash, Yu and
Weber, 2017): 384 bytes a document whatever its length. For banding, a register
that a short text leaves empty borrows another's content in an order of its own
(densification), so that a band never hangs on one common shingle. Six registers
make a band, and documents that agree on one of the 32 bands are candidates (a
link at similarity 0.85 is missed with chance 3e-7, at 0.8 with 6e-5, at 0.9
with 6e-11). A candidate pair's registers give a Jaccard estimate, corrected for
chance collisions of the compressed registers; pairs whose estimate lies five
standard errors under the threshold go, the others are confirmed on full sets.

Scale: documents with equal sets are one node from the start, so copies are never
paired. First every node is compared with the smallest node among its buckets; the
links join components, and a bucket whose members are in one component is done.
The members of the others are laid out in blocks of bounded size, components that
share a bucket next to each other, so that a bucket lies in few blocks; every two
blocks that meet in a bucket are one task, which compares their nodes exactly and
returns a spanning forest of the links, one row per node at most. So pairs are
never rows, a text is sent once per pair of blocks and not once per band, and
nothing is capped. Tables that later steps don't read are deleted as the work
goes on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import (LOWER, NON_SPACE, discard, flat, if_small, mix, rows_of, slices, stage_table, whole_groups, word_hashes,
                                  words)
from claimflow.llm.components import connected_components
from claimflow.operators.ranges import running_sums

REGISTERS = 192
MANTISSA_BITS = 10
ROWS_PER_BAND = 6
BLOCK_SHINGLES = 400_000    # shingles of the texts in one block


def shingle_sets(batch: pa.RecordBatch, column: str, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all rows, and the n + 1 row bounds.

    Words are runs of anything but ASCII white space, A-Z lower-cased. Fewer
    words than ``n`` make one shingle of them all; no words make none."""
    buf, at = flat(batch.column(column))
    buf = LOWER[buf]
    w = words(buf, at, NON_SPACE)
    h = word_hashes(buf, w)
    size = np.diff(w.row)
    grams = np.zeros(max(len(h) - n + 1, 0), np.uint64)
    for i in range(n):
        grams = mix(grams + h[i:i + len(grams)] + np.uint64(i + 1))
    sets = []
    for a, b in zip(w.row[:-1].tolist(), w.row[1:].tolist()):
        if b - a >= n:
            sets.append(np.unique(grams[a:b - n + 1]))
        elif b > a:
            x = np.zeros(1, np.uint64)
            for i in range(a, b):
                x = mix(x + h[i:i + 1] + np.uint64(i - a + 1))
            sets.append(mix(x + np.uint64(b - a)))
        else:
            sets.append(grams[:0])
    bounds = np.concatenate([[0], np.cumsum([len(s) for s in sets], dtype=np.int64)]).astype(np.int64)
    return (np.concatenate(sets) if sets else grams[:0]), bounds


def registers(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """HyperMinHash registers (rows x REGISTERS, uint16; 0 is empty) of sorted sets."""
    row = rows_of(bounds)
    many, half = np.uint64(REGISTERS), np.uint64(32)
    # The hash as a fraction of the registers: whole part and, times 2^64, the rest.
    low = (hashes & np.uint64(0xFFFFFFFF)) * many
    bucket = (((hashes >> half) * many + (low >> half)) >> half).astype(np.int64)
    cell = row * REGISTERS + bucket
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    top = (hashes[first] * many) >> np.uint64(11)        # 53 bits: exact as a float
    length = np.frexp(top.astype(np.float64))[1]
    zeros = np.minimum(53 - length, 62).astype(np.uint64)
    mantissa = ((top << zeros) >> np.uint64(52 - MANTISSA_BITS)) & np.uint64((1 << MANTISSA_BITS) - 1)
    out = np.zeros((len(bounds) - 1) * REGISTERS, np.uint16)
    out[cell[first]] = ((zeros + np.uint64(1)) << np.uint64(MANTISSA_BITS)) | mantissa
    return out.reshape(-1, REGISTERS)


#: For each register the others in an order of its own, from which it borrows.
_LENDERS = np.stack([np.random.default_rng([31, i]).permutation(REGISTERS) for i in range(REGISTERS)])


def densified(regs: np.ndarray) -> np.ndarray:
    """Registers with empty ones filled from the first lender that has content;
    a row without any content stays empty."""
    out = regs.copy()
    full = regs > 0
    row, cell = np.nonzero(~full & full.any(axis=1, keepdims=True))
    for a in range(0, len(row), 20_000):
        r, c = row[a:a + 20_000], cell[a:a + 20_000]
        lender = _LENDERS[c]
        out[r, c] = regs[r, lender[np.arange(len(r)), full[r[:, None], lender].argmax(axis=1)]]
    return out


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = densified(regs).reshape(len(regs), -1, ROWS_PER_BAND).astype(np.uint64)
    key = np.zeros(parts.shape[:2], np.uint64)
    for i in range(ROWS_PER_BAND):
        key = mix(key + parts[:, :, i] + np.uint64(1))
    return key.view(np.int64)


def _chance_collisions() -> tuple[np.ndarray, np.ndarray]:
    """Chance that one register of two disjoint sets is equal, on a grid of
    log2 loads (elements per register) of equally large sets."""
    grid = np.linspace(-8, 40, 193)
    z = np.arange(54)[:, None]
    m = np.arange(1 << MANTISSA_BITS)[None, :]
    lo = np.ldexp(1.0 + m / (1 << MANTISSA_BITS), -(z + 1)).ravel()
    width = np.broadcast_to(np.ldexp(1.0 / (1 << MANTISSA_BITS), -(z + 1)), (54, 1 << MANTISSA_BITS)).ravel()
    chance = []
    for load in 2.0 ** grid:          # smallest of Poisson(load) uniform values falls in the cell
        p = np.exp(-load * lo) * -np.expm1(-load * width)
        chance.append(float((p * p).sum()))
    return grid, np.array(chance)


_GRID: list = []


def estimate(a: np.ndarray, b: np.ndarray, na: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Jaccard estimates of register rows, corrected for chance collisions:
    the equal registers less the expected chance ones, over the registers used."""
    if not _GRID:
        _GRID.extend(_chance_collisions())
    used = ((a > 0) | (b > 0)).sum(axis=1)
    same = ((a == b) & (a > 0)).sum(axis=1)
    load = np.sqrt(np.maximum(na, 1) * np.maximum(nb, 1)) / REGISTERS
    chance = np.interp(np.log2(load), *_GRID) * REGISTERS
    return np.clip((same - chance) / np.maximum(used - chance, 1e-9), 0, 1)


def signatures(docs: DataFrame, n: int, key: str, text: str) -> DataFrame:
    """``doc_id, h, n_shingles, digest, bands``: one row per document; ``h``
    hashes the text, ``digest`` is 128 bits of the set, null for an empty one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                hashes, bounds = shingle_sets(part, "text", n)
                keys = band_keys(registers(hashes, bounds))
                # The band's number goes into the key, so that bands never mix.
                keys = mix(keys.view(np.uint64) + np.arange(keys.shape[1], dtype=np.uint64)).view(np.int64)
                ends = bounds.tolist()
                digests = [hashlib.blake2b(hashes[a:b].data, digest_size=16).digest() if b > a else None
                           for a, b in zip(ends, ends[1:])]
                bands = pa.ListArray.from_arrays(pa.array(np.arange(len(keys) + 1, dtype=np.int32) * keys.shape[1]), pa.array(keys.ravel()))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("h"), pa.array(np.diff(bounds), pa.int64()),
                                                  pa.array(digests, pa.binary()), bands], ["doc_id", "h", "n_shingles", "digest", "bands"])
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.xxhash64(F.col(text)).alias("h"), F.col(text).alias("text")).mapInArrow(
        run, f"doc_id {kind}, h long, n_shingles long, digest binary, bands array<long>")


def forest(node: np.ndarray, component: np.ndarray, side: np.ndarray, hashes: np.ndarray, bounds: np.ndarray, percent: int) -> list:
    """Links that join components: a spanning forest of all links between the two
    sides (or, without a second side, among all nodes), confirmed on full sets.

    Each node of the first side is compared at once with all that are not yet in
    its component: by size, by the registers' estimate (five standard errors
    below the threshold are let through), then exactly."""
    threshold, size, regs = percent / 100, np.diff(bounds), registers(hashes, bounds)
    label = np.unique(component, return_inverse=True)[1]
    shingle = np.unique(hashes, return_inverse=True)[1]
    marked, links = np.zeros(shingle.max(initial=-1) + 1, bool), []
    second = np.flatnonzero(side == 1)
    for i in np.flatnonzero(side == 0).tolist():
        other = second if len(second) else np.arange(i + 1, len(node))
        other = other[label[other] != label[i]]
        other = other[100 * np.minimum(size[other], size[i]) >= percent * np.maximum(size[other], size[i])]
        if not len(other):
            continue
        mine = np.broadcast_to(regs[i], (len(other), REGISTERS))
        used = np.maximum(((mine > 0) | (regs[other] > 0)).sum(axis=1), 1)
        floor = threshold - 5 * np.sqrt(threshold * (1 - threshold) / used) - 1 / used
        other = other[estimate(mine, regs[other], np.full(len(other), size[i], np.float64), size[other].astype(np.float64)) >= floor]
        if not len(other):
            continue
        marked[shingle[bounds[i]:bounds[i + 1]]] = True
        if len(other) <= 16:
            common = np.array([np.count_nonzero(marked[shingle[bounds[j]:bounds[j + 1]]]) for j in other.tolist()])
        else:
            total = np.concatenate([[0], np.cumsum(marked[shingle])])
            common = total[bounds[other + 1]] - total[bounds[other]]
        marked[shingle[bounds[i]:bounds[i + 1]]] = False
        for j in other[100 * common >= percent * (size[i] + size[other] - common)].tolist():
            if label[j] != label[i]:
                label[label == label[j]] = label[i]
                links.append((int(node[i]), int(node[j])))
    return links


def _links(tasks: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """``a, b``: the forests of all tasks. ``tasks(x, y, side, node, component)``
    names the nodes that meet in task (x, y)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("x", "y")):
            x, y, node, component, side = (np.asarray(rows.column(c)) for c in ("x", "y", "node", "component", "side"))
            parts = [shingle_sets(part, "text", n) for part in slices(rows.select(["text"]), "text")]
            hashes = np.concatenate([h for h, _ in parts])
            bounds = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(b) for _, b in parts]))])
            cuts = np.flatnonzero(np.concatenate([[True], (x[1:] != x[:-1]) | (y[1:] != y[:-1]), [True]]))
            found = []
            for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                found += forest(node[a:b], component[a:b], side[a:b], hashes[bounds[a]:bounds[b]], bounds[a:b + 1] - bounds[a], percent)
            yield pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], pa.int64()) for i in (0, 1)], ["a", "b"])
    sent = texts.join(if_small(tasks), "node").select("x", "y", "side", "node", "component", "text")
    return sent.repartition("x", "y").sortWithinPartitions("x", "y", "side", "node").mapInArrow(run, "a long, b long")


def _first_tasks(members: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every node meets the smallest node among its buckets; the nodes that meet
    the same one are dealt to tasks of about ``BLOCK_SHINGLES`` shingles."""
    meets = stage_table(members.groupBy("node").agg(F.min("low").alias("x")).where("x < node").join(nodes.select("node", "n"), "node"), "meets")
    parts = meets.groupBy("x").agg(F.ceil(F.sum("n") / BLOCK_SHINGLES).alias("parts"))
    alone = F.col("node").alias("component")
    second = meets.join(parts, "x").select("x", F.pmod(F.xxhash64("node"), F.col("parts")).alias("y"), F.lit(1).alias("side"), "node", alone)
    first = parts.select("x", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("y"), F.lit(0).alias("side"),
                         F.col("x").alias("node"), F.col("x").alias("component"))
    tasks = stage_table(second.unionByName(first), "first-tasks")
    discard(meets)
    return tasks


def _block_tasks(members: DataFrame, labels: DataFrame, nodes: DataFrame) -> DataFrame:
    """Every two blocks that meet in a bucket of several components: the nodes
    that bring them together, but not two blocks of one and the same component.
    A bucket's members lie in one cluster, so its rows (members times blocks) grow
    with its members until a cluster alone is larger than a block."""
    labelled = members.select("key", "node").join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = stage_table(labelled, "labelled-members")
    unsettled = labelled.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("key", "lo")
    unsettled = stage_table(labelled.join(unsettled, "key"), "unsettled")
    # Components that buckets connect are a cluster; in it each lies by the smallest one that it meets.
    clusters = connected_components(unsettled, "component", "lo").select(F.col("node").alias("component"), F.col("component").alias("cluster"))
    beside = stage_table(unsettled.groupBy("component").agg(F.min("lo").alias("beside")).join(clusters, "component"), "clusters")
    laid = unsettled.select("node", "component").distinct().join(nodes.select("node", "n"), "node").join(if_small(beside), "component")
    laid = running_sums(laid, [F.col("cluster"), F.col("beside"), F.col("component"), F.col("node")], ["n"], name="near-blocks")
    laid = stage_table(laid.select("node", F.expr(f"cum_n div {BLOCK_SHINGLES}").alias("block")), "blocks")
    discard(clusters, beside)
    placed = stage_table(unsettled.drop("lo").join(laid, "node"), "placed-members")
    held = placed.groupBy("key", F.col("block").alias("other")).agg(F.min("component").alias("lo"), F.max("component").alias("hi"))
    met = placed.join(held, "key").where(~((F.col("lo") == F.col("component")) & (F.col("hi") == F.col("component"))))
    tasks = met.select(F.least("block", "other").alias("x"), F.greatest("block", "other").alias("y"),
                       (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "component").distinct()
    tasks = stage_table(tasks, "block-tasks")
    discard(labelled, unsettled, laid, placed)
    return tasks


def _linked(docs: DataFrame, n: int, percent: int, key: str, text: str, by_key: bool) -> tuple[DataFrame, DataFrame]:
    """Signatures of all rows, and ``digest, component`` of every set: an id that
    linked sets share. With ``by_key`` the sets of one key are linked, too."""
    sig = stage_table(signatures(docs, n, key, text), "signatures")
    full = sig.where("digest is not null and doc_id is not null")
    one = F.min(F.struct("doc_id", "h", "n_shingles", "bands")).alias("one")
    nodes = stage_table(full.groupBy("digest").agg(one).select(
        F.monotonically_increasing_id().alias("node"), "digest", "one.doc_id", "one.h", F.col("one.n_shingles").alias("n"), "one.bands"), "nodes")
    banded = nodes.select(F.explode("bands").alias("key"), "node")
    shared = stage_table(banded.groupBy("key").agg(F.min("node").alias("low"), F.max("node").alias("high")).where("low < high").select("key", "low"), "buckets")
    members = stage_table(banded.join(shared, "key"), "members")
    wanted = stage_table(nodes.join(members.select("node").distinct(), "node").select("node", F.col("doc_id").alias("k"), F.col("h").alias("kh")), "wanted")
    plain = docs.select(F.col(key).alias("k"), F.xxhash64(F.col(text)).alias("kh"), F.col(text).alias("text"))
    texts = stage_table(plain.join(if_small(wanted), ["k", "kh"]).select("node", "text").dropDuplicates(["node"]), "texts")
    tasks = _first_tasks(members, nodes)
    found = stage_table(_links(tasks, texts, n, percent), "links")
    discard(tasks, shared, wanted)
    if by_key:          # a key with several sets joins them
        low = full.join(nodes.select("digest", "node"), "digest").groupBy("doc_id").agg(F.min("node").alias("a"), F.max("node").alias("z")).where("a < z")
        own = full.join(low, "doc_id").join(nodes.select("digest", F.col("node").alias("b")), "digest").where("a != b").select("a", "b").distinct()
        found, old = stage_table(found.unionByName(own), "links"), found
        discard(old)
    labels = connected_components(found, "a", "b")
    tasks = _block_tasks(members, labels, nodes)
    more = stage_table(_links(tasks, texts, n, percent), "links")
    if not more.isEmpty():
        labels, old = connected_components(found.unionByName(more), "a", "b"), labels
        discard(old)
    parts = nodes.select("digest", "node").join(labels, "node", "left").select("digest", F.coalesce("component", "node").alias("component"))
    parts = stage_table(parts, "components")
    discard(tasks, texts, members, nodes, found, more, labels)
    return sig, parts


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80, key: str = "doc_id",
                    text: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs``.

    Documents are linked when 100 * intersection >= ``percent`` * union of
    their shingle sets; ``component_id`` is the smallest key reachable over
    links (itself included), ``kept`` is ``doc_id = component_id``.
    Null or empty texts have an empty set, are linked with nothing and kept. A
    null key takes no part in links: its component is null and it is kept.
    Rows that repeat a key are one node: each comes back, and all their links
    hold for the node. Other columns are ignored; an empty table gives no rows.
    """
    sig, parts = _linked(docs, shingle_words, percent, key, text, True)
    slim = sig.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("digest")).alias("digest"))
    low = slim.join(parts, "digest").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    labelled = stage_table(parts.join(low, "component").select("digest", "component_id"), "component-keys")
    component = F.coalesce("component_id", "doc_id")
    return slim.join(labelled, "digest", "left").select(
        "doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def unique_documents(docs: DataFrame, shingle_words: int = 5, percent: int = 80, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one row of each near-duplicate group, all columns kept: the
    smallest key, then the smallest hash of the text; of rows equal in both one,
    by a hash of the other columns. Rows are grouped by their texts alone: rows
    that repeat a key but not its text both stay. Rows with a null key and rows
    without a word stay, all of them."""
    sig, parts = _linked(docs, shingle_words, percent, key, text, False)
    full = sig.select("doc_id", "h", "digest").where("digest is not null and doc_id is not null")
    first = full.join(parts, "digest").groupBy("component").agg(F.min(F.struct("doc_id", "h")).alias("first"))
    first = stage_table(first.select(F.col("first.doc_id").alias("__k"), F.col("first.h").alias("__h")), "kept")
    bare = stage_table(sig.where("digest is null and doc_id is not null").select(F.col("doc_id").alias("__k"), F.col("h").alias("__h")).distinct(), "bare")
    # Rows that repeat key and text go first; the joins need no other shuffle.
    rest = F.xxhash64(*[F.col(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t])
    keyed = docs.where(F.col(key).isNotNull()).withColumns({"__k": F.col(key), "__h": F.xxhash64(F.col(text))})
    one = keyed.withColumn("__copy", F.row_number().over(Window.partitionBy("__k", "__h").orderBy(rest))).where("__copy = 1").join(first, ["__k", "__h"], "left_semi")
    return (one.select(*docs.columns).unionByName(keyed.join(bare, ["__k", "__h"], "left_semi").select(*docs.columns))
            .unionByName(docs.where(F.col(key).isNull())))
