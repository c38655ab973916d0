"""Quality classifier: hashed word n-gram logistic regression, trained with
follow-the-regularised-leader updates.

A text's features are its words, word pairs, word shapes (runs of capitals,
small letters and digits as one sign each, other signs as they are), shape
pairs and triples, and whether a word repeats the one before; each is hashed to
one of 2^18 slots, and a slot's value is its share of the text's words. The
weights come from per-coordinate FTRL-proximal updates (McMahan et al., 2013)
over a bounded sample of labelled rows (``labelled.SAMPLE_PER_CLASS``), and the
score is the logistic function of the sparse dot product.

Scale: scoring is map-only, numpy passes over bounded slices of whole texts;
the broadcast weights are 1 MB whatever the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import LOWER, NON_SPACE, Words, flat, mix, rows_of, slices, word_hashes, words

BITS = 18
PASSES = 3
ALPHA, BETA, L1, L2 = 0.5, 1.0, 0.002, 0.002
SCALE = 8.0


def _sign(b: int) -> int:
    if 0x41 <= b <= 0x5A:
        return ord("A")
    if 0x61 <= b <= 0x7A or b >= 0x80:
        return ord("a")
    return ord("0") if 0x30 <= b <= 0x39 else b


_SHAPE = np.array([_sign(b) for b in range(256)], np.uint8)


def _shape_hashes(buf: np.ndarray, w: Words) -> np.ndarray:
    sign = _SHAPE[buf]
    keep = np.ones(len(sign), bool)
    keep[1:] = sign[1:] != sign[:-1]
    keep[w.start] = True                         # runs end with their word
    new = np.concatenate([[0], np.cumsum(keep)])
    return word_hashes(sign[keep], Words(new[w.start], new[w.end], w.row), seed=1)


def features(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature slots (features x words, -1 for none), each word's row, and the
    number of words of each row."""
    buf, at = flat(texts)
    w = words(buf, at, NON_SPACE)
    word, shape = word_hashes(LOWER[buf], w), _shape_hashes(buf, w)
    row = rows_of(w.row)
    out = np.full((6, len(word)), -1, np.int64)

    def slot(h: np.ndarray, family: int) -> np.ndarray:
        return (mix(h + np.uint64(family * 0x9E3779B9)) >> np.uint64(64 - BITS)).astype(np.int64)
    out[0], out[1] = slot(word, 0), slot(shape, 1)
    two = np.flatnonzero(row[1:] == row[:-1]) if len(row) else np.zeros(0, np.int64)
    out[2, two + 1] = slot(mix(word[two]) + word[two + 1], 2)
    out[3, two + 1] = slot(mix(shape[two]) + shape[two + 1], 3)
    out[4, two + 1] = slot((word[two] == word[two + 1]).astype(np.uint64), 4)
    three = two[1:][two[1:] == two[:-1] + 1] if len(two) else two
    out[5, three + 1] = slot(mix(mix(shape[three - 1]) + shape[three]) + shape[three + 1], 5)
    return out, row, np.diff(w.row)


class FollowTheLeader:
    """FTRL-proximal logistic regression on hashed slots, slot 2^BITS the bias."""

    def __init__(self, bits: int = BITS):
        self.z, self.n = np.zeros((1 << bits) + 1), np.zeros((1 << bits) + 1)

    def weights(self, i=slice(None)) -> np.ndarray:
        z, n = self.z[i], self.n[i]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def update(self, slots: np.ndarray, values: np.ndarray, y: int, importance: float) -> None:
        w = self.weights(slots)
        p = 1 / (1 + np.exp(-np.clip(w @ values, -35, 35)))
        g = importance * (p - y) * values
        more = (np.sqrt(self.n[slots] + g * g) - np.sqrt(self.n[slots])) / ALPHA
        self.z[slots] += g - more * w
        self.n[slots] += g * g


def train(examples: list[tuple[str, int]], sizes: dict[int, int], passes: int = PASSES, seed: int = 21) -> np.ndarray:
    """Weights from labelled texts; each class counts by its size ``sizes``.
    Without examples all weights are 0, so every score is 0.5."""
    model = FollowTheLeader()
    if examples:
        n = {y: sum(1 for e in examples if e[1] == y) for y in (0, 1)}
        total = sum(sizes.get(y, 0) for y in (0, 1) if n[y])
        weight = {y: len(examples) * sizes.get(y, 1) / total / n[y] for y in (0, 1) if n[y]}
        rows = []
        for text, y in examples:
            found, _, size = features(pa.array([text], pa.large_string()))
            slots, count = np.unique(found[found >= 0], return_counts=True)
            rows.append((np.append(slots, 1 << BITS), np.append(SCALE * count / max(int(size[0]), 1), 1.0), y, weight[y]))
        rng = np.random.default_rng(seed)
        for _ in range(passes):
            for i in rng.permutation(len(rows)):
                model.update(*rows[i])
    return model.weights()


def score(docs: DataFrame, weights: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, score`` for every row. Null and empty texts get the bias's
    score. Repeated rows each get a row; other columns are ignored; an empty
    table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        slot_weight = np.append(w[:-1], np.float32(0))        # -1 is no feature
        for batch in batches:
            for part in slices(batch, "text"):
                found, row, size = features(part.column("text"))
                per_word = slot_weight[found].sum(axis=0, dtype=np.float64)
                total = np.bincount(row, weights=per_word, minlength=len(size))
                x = SCALE * total / np.maximum(size, 1) + w[-1]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(x, -700, 700))), pa.float64())],
                                                 ["doc_id", "score"])
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, score double")
