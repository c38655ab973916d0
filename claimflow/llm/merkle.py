"""Merkle manifest of a table with resumable SHA-256 states.

Every row is a leaf; the leaves of a source, by key, and then the sources' roots
are folded three at a time into one root. A child enters its parent as 64 hex
digits, which is exactly one block of SHA-256, so the state of the parent's hash
before each child slot is eight words: the parent keeps a copy of it for every
slot. Folding a (replaced) leaf takes the state before its slot, hashes the
replacement and the siblings right of it, and never the ones on the left; the
left ones only enter the proof's digest.

Scale: leaves are numbered by running sums over key ranges, so a source with a
third of all rows is spread. A task takes whole chunks of ``3 ** LEVELS``
neighbours and climbs ``LEVELS`` levels in them, all nodes of a level at once in
numpy; then the chunks' tops are the leaves of the next layer. What lies above
a chunk is a path of steps (state, slot, size, siblings) that is joined to the
chunk's leaves. No group is larger than a chunk, and only counts and the root reach
the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import stage_table, whole_groups
from claimflow.operators.ranges import running_sums

RUN = 3                # children of a parent
LEVELS = 6             # levels climbed in one chunk of 3 ** 6 nodes
LANES = 4096           # hashes computed side by side
BUFFER_ROWS = 16_000
STEP = 32 + 2 + 32 * (RUN - 1)


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _root_fraction(x: int, power: int) -> int:
    """First 32 bits of the fraction of the ``power``-th root of ``x``."""
    lo, hi = 0, x << 32
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if mid ** power <= x << (32 * power) else (lo, mid - 1)
    return lo & 0xFFFFFFFF


START = np.array([_root_fraction(p, 2) for p in _primes(8)], np.uint32)
ROUND = np.array([_root_fraction(p, 3) for p in _primes(64)], np.uint32)
_HEX = np.frombuffer(b"0123456789abcdef", np.uint8)


def _turn(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def compress(state: np.ndarray, block: np.ndarray) -> np.ndarray:
    """States (n x 8 words) after one more block (n x 16 words) each."""
    out = np.empty(state.shape, np.uint32)
    for lo in range(0, len(state), LANES):
        s = np.ascontiguousarray(state[lo:lo + LANES].T)
        w = list(np.ascontiguousarray(block[lo:lo + LANES].T))
        a, b, c, d, e, f, g, h = s
        for i in range(64):
            if i >= 16:
                x, y = w[i - 15], w[i - 2]
                w.append(w[i - 16] + w[i - 7] + (_turn(x, 7) ^ _turn(x, 18) ^ (x >> np.uint32(3)))
                         + (_turn(y, 17) ^ _turn(y, 19) ^ (y >> np.uint32(10))))
            t = h + (_turn(e, 6) ^ _turn(e, 11) ^ _turn(e, 25)) + ((e & f) ^ (~e & g)) + ROUND[i] + w[i]
            u = (_turn(a, 2) ^ _turn(a, 13) ^ _turn(a, 22)) + ((a & (b | c)) | (b & c))
            a, b, c, d, e, f, g, h = t + u, a, b, c, d + t, e, f, g
        out[lo:lo + LANES] = (s + np.stack([a, b, c, d, e, f, g, h])).T
    return out


def hex_block(digest: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) as blocks: their hex digits as 16 words."""
    text = np.empty((len(digest), 64), np.uint8)
    text[:, ::2], text[:, 1::2] = _HEX[digest >> 4], _HEX[digest & 15]
    return text.view(">u4").astype(np.uint32)


def finish(state: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Digests (n x 32 bytes) of hashes that took ``blocks`` whole blocks."""
    end = np.zeros((len(state), 16), np.uint32)
    end[:, 0], end[:, 14], end[:, 15] = 0x80000000, blocks >> 23, (blocks << 9) & 0xFFFFFFFF
    return compress(state, end).astype(">u4").view(np.uint8).reshape(-1, 32)


class Step(NamedTuple):
    """One parent as seen from each of its children: the state before the
    child's slot, the slot, the run's size and the run's other digests in order
    (size 0: there is no parent, the node is a top)."""
    state: np.ndarray    # n x 8 words
    slot: np.ndarray
    size: np.ndarray
    others: np.ndarray   # n x 2 x 32 bytes


def fold(digest: np.ndarray, step: Step, proof: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """Parents' digests, resumed from the states with ``digest`` in the slot and
    the right siblings after it. ``proof`` (hash states) and ``blocks`` take all
    the others, left to right, in place."""
    out, up = digest.copy(), np.flatnonzero(step.size)
    slot, size, others = step.slot[up], step.size[up], step.others[up]
    state = compress(step.state[up], hex_block(digest[up]))
    for j in range(RUN - 1):
        there = np.flatnonzero(j < size - 1)
        block = hex_block(others[there, j])
        proof[up[there]] = compress(proof[up[there]], block)
        blocks[up[there]] += 1
        right = j >= slot[there]
        state[there[right]] = compress(state[there[right]], block[right])
    out[up] = finish(state, size)
    return out


def climb(digest: np.ndarray, chunk: np.ndarray, place: np.ndarray, up: np.ndarray) -> tuple[list[tuple[Step, np.ndarray]], np.ndarray]:
    """Levels of a forest, and the top of every node's chunk. ``chunk`` ascends,
    ``place`` counts from 0 in each chunk, ``up`` says how many levels a chunk
    has. A level is the nodes' steps and the number of each node's parent."""
    levels, home = [], np.arange(len(digest))
    for level in range(int(up.max(initial=0))):
        on = up > level
        new = ~on
        new[:1] = True
        new[1:] |= (chunk[1:] != chunk[:-1]) | (place[1:] // RUN != place[:-1] // RUN)
        first, parent = np.flatnonzero(new), np.cumsum(new) - 1
        size = np.where(on[first], np.diff(np.append(first, len(new))), 0)
        states, state = np.zeros((len(first), RUN, 8), np.uint32), np.tile(START, (len(first), 1))
        for j in range(RUN):        # each slot keeps a copy of the state before it
            states[:, j] = state
            there = np.flatnonzero(j < size)
            state[there] = compress(state[there], hex_block(digest[first[there] + j]))
        slot = np.where(on, place % RUN, 0)
        others = np.zeros((len(digest), RUN - 1, 32), np.uint8)
        for j in range(RUN - 1):
            there = np.flatnonzero(j < size[parent] - 1)
            others[there, j] = digest[first[parent[there]] + j + (j >= slot[there])]
        levels.append((Step(states[parent, slot], slot, size[parent], others), parent))
        above = digest[first]
        inner = np.flatnonzero(size)
        above[inner] = finish(state[inner], size[inner])
        digest, chunk, place, up, home = above, chunk[first], np.where(on, place // RUN, place)[first], up[first], parent[home]
    return levels, digest[home]


def _digests(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, 32)


def _binary(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _levels(n: np.ndarray) -> np.ndarray:
    """Levels above ``n`` leaves: runs of three until one node is left."""
    out, left = np.zeros(len(n), np.int64), n.astype(np.int64)
    while (left > 1).any():
        out += left > 1
        left = -(-left // RUN)
    return out


def _layer(nodes: DataFrame, done: int, leaves: bool) -> DataFrame:
    """Climb from ``nodes`` (tree, place, n, digest, and ``rest``, ``seen`` of
    leaves) inside their chunks. Adds ``chunk`` and ``top``; leaves get the fold
    of ``seen`` up to there (``folded, proof, blocks``), inner nodes a ``path``."""
    size = RUN ** LEVELS
    rest = nodes.schema["rest"].dataType if leaves else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_groups(batches, ("tree", "chunk"), BUFFER_ROWS):
            tree, chunk, place, n = (np.asarray(rows.column(c)) for c in ("tree", "chunk", "place", "n"))
            new = np.ones(len(tree), bool)
            new[1:] = (tree[1:] != tree[:-1]) | (chunk[1:] != chunk[:-1])
            digest = _digests(rows.column("digest"))
            levels, top = climb(digest, np.cumsum(new), place % size, np.clip(_levels(n) - done, 0, LEVELS))
            at = np.arange(len(digest))
            fixed = [rows.column("tree"), rows.column("place"), rows.column("n"), rows.column("chunk"), _binary(top)]
            names = ["tree", "place", "n", "chunk", "top"]
            if leaves:
                now, proof, blocks = _digests(rows.column("seen")).copy(), np.tile(START, (len(at), 1)), np.zeros(len(at), np.int64)
                for step, parent in levels:
                    now = fold(now, Step(*[x[at] for x in step]), proof, blocks)
                    at = parent[at]
                yield pa.RecordBatch.from_arrays([*fixed, rows.column("rest"), rows.column("digest"), _binary(now), _binary(proof), pa.array(blocks)],
                                                 [*names, "rest", "digest", "folded", "proof", "blocks"])
            else:
                path = [b""] * len(at)
                for step, parent in levels:
                    mine = Step(*[x[at] for x in step])
                    coded = np.concatenate([mine.state.view(np.uint8).reshape(-1, 32), mine.slot[:, None].astype(np.uint8),
                                            mine.size[:, None].astype(np.uint8), mine.others.reshape(len(at), -1)], axis=1)
                    path = [p + (c.tobytes() if s else b"") for p, c, s in zip(path, coded, mine.size)]
                    at = parent[at]
                yield pa.RecordBatch.from_arrays([*fixed, pa.array(path, pa.binary())], [*names, "path"])
    more = "path binary" if not leaves else f"rest {rest.simpleString()}, digest binary, folded binary, proof binary, blocks long"
    keep = ["tree", "place", "n", "chunk", "digest", *(["rest", "seen"] if leaves else [])]
    cut = nodes.withColumn("chunk", F.expr(f"place div {size}")).select(*keep)
    return (cut.repartition("tree", "chunk").sortWithinPartitions("tree", "chunk", "place")
            .mapInArrow(run, f"tree long, place long, n long, chunk long, top binary, {more}"))


def _tops(layer: DataFrame) -> DataFrame:
    return layer.groupBy("tree", F.col("chunk").alias("place")).agg(F.first("n").alias("n"), F.first("top").alias("digest"))


def _climb_all(nodes: DataFrame, most: int, done: int, name: str) -> tuple[DataFrame, list[DataFrame]]:
    """Inner layers from ``nodes`` up to one top per tree: (tops, layers)."""
    layers = []
    height = int(_levels(np.array([most]))[0])
    while done < height:
        layers.append(stage_table(_layer(nodes, done, False), f"{name}-{len(layers)}"))
        nodes = stage_table(_tops(layers[-1]), f"{name}-tops")
        done += LEVELS
    return nodes, layers


def _paths(layers: list[DataFrame], above: DataFrame) -> DataFrame:
    """``tree, place, path`` of the lowest layer's nodes; ``above`` has each
    tree's path from its top on (``tree, path``)."""
    found = above.select("tree", F.lit(0).cast("long").alias("place"), "path")
    for layer in reversed(layers):
        higher = found.select("tree", F.col("place").alias("chunk"), F.col("path").alias("rest_path"))
        found = layer.join(higher, ["tree", "chunk"]).select("tree", "place", F.concat("path", "rest_path").alias("path"))
    return found


def _end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Folds from the chunks' tops to the root along the joined paths."""
    for batch in batches:
        coded = batch.column("path").dictionary_encode()
        which = np.asarray(coded.indices)
        paths = [np.frombuffer(p, np.uint8).reshape(-1, STEP) for p in coded.dictionary.to_pylist()]
        now, proof = _digests(batch.column("folded")).copy(), _digests(batch.column("proof")).view(np.uint32).copy()
        blocks = np.asarray(batch.column("blocks")).copy()
        for level in range(max((len(p) for p in paths), default=0)):
            table = np.stack([p[level] if level < len(p) else np.zeros(STEP, np.uint8) for p in paths])[which]
            step = Step(np.ascontiguousarray(table[:, :32]).view(np.uint32), table[:, 32].astype(np.int64), table[:, 33].astype(np.int64),
                        table[:, 34:].reshape(-1, RUN - 1, 32))
            now = fold(now, step, proof, blocks)
        yield pa.RecordBatch.from_arrays([batch.column("rest"), batch.column("digest"), batch.column("subroot"), batch.column("root"),
                                          _binary(finish(proof, blocks)), _binary(now)],
                                         ["rest", "leaf", "subroot", "root", "proof", "folded_root"])


def leaf_text(fields: list[Column]) -> Column:
    """Unambiguous text of a row: ``-`` for a null, else byte count, colon, value."""
    parts = []
    for c in fields:
        value = c.cast("string")
        parts.append(F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value)))
    return F.concat(*parts)


def manifest(docs: DataFrame, fields: list[str], key: str = "doc_id", group: str = "source",
             seen: dict[str, Column] | None = None) -> DataFrame:
    """``<key>, leaf, subroot, root, proof_sha256, folded_root, verified`` for
    every row of ``docs``; digests are lowercase hex.

    A leaf is the SHA-256 of ``fields`` (``leaf_text``). Leaves ascend by key in
    their group (null keys first, equal keys by leaf, so repeated rows are
    neighbours and each a leaf), groups by their bytes (a null group first and a
    group of its own). ``seen`` gives the fields as found now, as columns of
    ``docs``: ``folded_root`` is the root that they lead to with the manifest's
    states and siblings, ``verified`` whether that is the root. Nulls and empty
    or long texts are values like any other; other columns are ignored; an empty
    table gives no rows.
    """
    now = [(seen or {}).get(f, F.col(f)) for f in fields]
    changed = [~c.eqNullSafe(F.col(f)) for f, c in zip(fields, now) if seen and f in seen]
    anew = F.lit(False)
    for c in changed:
        anew = anew | c
    rows = docs.select(F.struct(F.col(key).alias("key")).alias("rest"), F.col(group).cast("string").alias("group"),
                       F.unhex(F.sha2(leaf_text([F.col(f) for f in fields]), 256)).alias("digest"),
                       F.when(anew, F.unhex(F.sha2(leaf_text(now), 256))).alias("seen"), F.lit(1).cast("long").alias("one"))
    rows = stage_table(rows, "leaves")
    ordered = running_sums(rows, [F.col("group").asc_nulls_first(), F.col("rest.key").asc_nulls_first(), F.col("digest").asc()], ["one"],
                           by=("group",), name="leaf-ranges")
    groups = stage_table(rows.groupBy("group").agg(F.count("*").alias("n")).withColumn("one", F.lit(1).cast("long")), "groups")
    groups = stage_table(running_sums(groups, [F.col("group").asc_nulls_first()], ["one"], name="group-ranges")
                         .select(F.col("group").alias("g"), "n", (F.col("cum_one") - 1).alias("tree")), "group-numbers")
    n_groups, most = groups.agg(F.count("*"), F.max("n")).first()
    leaves = (ordered.join(groups, F.col("group").eqNullSafe(F.col("g")))
              .select("tree", (F.col("cum_one") - 1).alias("place"), "n", "rest", "digest", F.coalesce("seen", "digest").alias("seen")))
    bottom = stage_table(_layer(leaves, 0, True), "leaf-chunks")
    tops, layers = _climb_all(stage_table(_tops(bottom), "chunk-tops"), most or 0, LEVELS, "chunks")
    # The groups' roots are the leaves of one more tree.
    nodes = tops.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("place"), F.lit(n_groups).cast("long").alias("n"), "digest")
    last, upper = _climb_all(nodes, n_groups, 0, "groups")
    root = last.first()
    own = _paths(upper, last.select("tree", F.lit(b"").alias("path"))).select(F.col("place").alias("tree"), "path")
    subroots = stage_table(tops.select("tree", F.col("digest").alias("subroot")).join(own, "tree")
                           .select("tree", "subroot", F.lit(bytes(root["digest"]) if root else None).cast("binary").alias("root"), "path"), "subroots")
    above = stage_table(_paths(layers, subroots).join(subroots.select("tree", "subroot", "root"), "tree")
                        .withColumnRenamed("place", "chunk"), "paths")
    ended = (bottom.select("tree", "chunk", "rest", "digest", "folded", "proof", "blocks").join(above, ["tree", "chunk"])
             .select("rest", "digest", "folded", "proof", "blocks", "path", "subroot", "root")
             .mapInArrow(_end, f"rest {bottom.schema['rest'].dataType.simpleString()}, leaf binary, subroot binary, root binary, proof binary, folded_root binary"))
    text = {c: F.lower(F.hex(c)) for c in ("leaf", "subroot", "root", "folded_root")}
    return ended.select(F.col("rest.key").alias(key), text["leaf"].alias("leaf"), text["subroot"].alias("subroot"), text["root"].alias("root"),
                        F.lower(F.hex("proof")).alias("proof_sha256"), text["folded_root"].alias("folded_root"),
                        (F.col("folded_root") == F.col("root")).alias("verified"))
