"""Language identification by a bidirectional gated recurrent network on bytes.

Two gated recurrent units read a window of bytes forwards and backwards; every
position gets its own label distribution, and the document's probabilities are
the mean over all positions of the whole text. The network is trained in numpy
by backpropagation through time (Adam) on byte windows of a bounded sample of
labelled rows: about ``SAMPLE_DOCS`` documents a language, ``SAMPLE_WINDOWS``
windows each. Gates use the softsign, which costs a few numpy passes.

Scale: prediction is map-only; texts are cut into windows of ``WINDOW`` bytes
that cover every byte once, and windows of many texts run as one numpy batch of
bounded size. The sample is drawn by a hash of the key in one pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import flat, slices

UNKNOWN = "und"
SAMPLE_DOCS = 400
SAMPLE_WINDOWS = 6
WINDOW = 128
TRAIN_WINDOW = 64
HIDDEN = 8
STEPS = 300
BATCH = 128
_BATCH_WINDOWS = 2048


def _soft(x: np.ndarray) -> np.ndarray:
    return x / (1 + np.abs(x))


class Direction:
    """One gated recurrent unit: byte tables (with bias) and recurrent weights
    of the update, reset and candidate gates."""

    def __init__(self, rng: np.random.Generator, hidden: int, labels: int):
        self.p = {"E": rng.normal(0, 0.3, (3, 256, hidden)), "U": rng.normal(0, 0.3, (3, hidden, hidden)),
                  "W": rng.normal(0, 0.1, (hidden, labels))}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def logits(self, x: np.ndarray) -> np.ndarray:
        """Label scores of each position, (time, labels, windows), of (time,
        windows) byte numbers. Nothing is kept, and most steps work in place."""
        (ez, er, en), (uz, ur, un), w = self.p["E"], self.p["U"], self.p["W"]
        h = np.zeros((x.shape[1], w.shape[0]), np.float32)
        out = np.empty((len(x), w.shape[1], x.shape[1]), np.float32)
        to_labels = np.ascontiguousarray(w.T)
        for t in range(len(x)):
            z = _soft(ez.take(x[t], axis=0) + h @ uz)
            r = _soft(er.take(x[t], axis=0) + h @ ur)
            r += 1
            r *= h @ un
            r *= 0.5
            r += en.take(x[t], axis=0)
            n = _soft(r)
            z += 1
            z *= 0.5
            h -= n
            h *= z
            h += n
            np.matmul(to_labels, h.T, out=out[t])
        return out

    def forward(self, x: np.ndarray) -> np.ndarray:
        """As ``logits``, keeping what backpropagation needs."""
        e, u = self.p["E"], self.p["U"]
        h, self.x, self.kept = np.zeros((x.shape[1], u.shape[1]), np.float32), x, []
        for t in range(len(x)):
            z, r = _soft(e[0][x[t]] + h @ u[0]), _soft(e[1][x[t]] + h @ u[1])
            m = h @ u[2]
            n = _soft(e[2][x[t]] + (0.5 + 0.5 * r) * m)
            before, h = h, n + (0.5 + 0.5 * z) * (h - n)
            self.kept.append((before, z, r, m, n, h))
        return np.stack([k[5] for k in self.kept]) @ self.p["W"]

    def backward(self, d_logits: np.ndarray) -> dict[str, np.ndarray]:
        u, w = self.p["U"], self.p["W"]
        g = {k: np.zeros_like(v) for k, v in self.p.items()}
        d_in = np.zeros((3, *self.x.shape, w.shape[0]), np.float32)
        d_next = 0.0
        for t in range(len(self.x) - 1, -1, -1):
            before, z, r, m, n, h = self.kept[t]
            g["W"] += h.T @ d_logits[t]
            d = d_logits[t] @ w.T + d_next
            gate = 0.5 + 0.5 * z
            d_n = d * (1 - gate) * (1 - np.abs(n)) ** 2
            d_z = d * (before - n) * 0.5 * (1 - np.abs(z)) ** 2
            d_r = d_n * m * 0.5 * (1 - np.abs(r)) ** 2
            d_m = d_n * (0.5 + 0.5 * r)
            d_next = d * gate
            for i, x in enumerate((d_z, d_r, d_m)):
                g["U"][i] += before.T @ x
                d_next = d_next + x @ u[i].T
            d_in[0, t], d_in[1, t], d_in[2, t] = d_z, d_r, d_n
        flat_x = self.x.ravel()
        for i in range(3):
            rows = d_in[i].reshape(len(flat_x), -1)
            for k in range(rows.shape[1]):
                g["E"][i][:, k] = np.bincount(flat_x, weights=rows[:, k], minlength=256)
        return g


class Network:
    """Both directions and the label bias."""

    def __init__(self, labels: list[str], hidden: int = HIDDEN, seed: int = 11):
        rng = np.random.default_rng(seed)
        self.labels = labels
        self.sides = [Direction(rng, hidden, len(labels)), Direction(rng, hidden, len(labels))]
        self.bias = np.zeros(len(labels), np.float32)

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Label probabilities (time, labels, windows) of (time, windows) bytes.
        States lie in -1 .. 1, so the scores are too small to overflow."""
        x = x.astype(np.intp)
        s = self.sides[0].logits(x)
        s += self.sides[1].logits(x[::-1])[::-1]
        s += self.bias[:, None]
        np.exp(s, out=s)
        s /= s.sum(axis=1, keepdims=True)
        return s

    def train(self, windows: np.ndarray, target: np.ndarray, steps: int = STEPS, batch: int = BATCH, rate: float = 0.02, seed: int = 12) -> None:
        """Adam on the mean cross-entropy of all positions; classes drawn evenly."""
        rng = np.random.default_rng(seed)
        by_label = [np.flatnonzero(target == c) for c in range(len(self.labels))]
        params = [self.sides[0].p, self.sides[1].p, {"b": self.bias}]
        moments = [{k: (np.zeros_like(v), np.zeros_like(v)) for k, v in p.items()} for p in params]
        for step in range(1, steps + 1):
            label = rng.integers(0, len(self.labels), batch)
            pick = np.array([by_label[c][rng.integers(len(by_label[c]))] for c in label])
            x = np.ascontiguousarray(windows[pick].T)
            s = self.sides[0].forward(x) + self.sides[1].forward(np.ascontiguousarray(x[::-1]))[::-1] + self.bias
            s = np.exp(s - s.max(axis=2, keepdims=True))
            s /= s.sum(axis=2, keepdims=True)
            s[:, np.arange(batch), label] -= 1
            s /= s.shape[0] * batch
            grads = [self.sides[0].backward(s), self.sides[1].backward(s[::-1]), {"b": s.sum(axis=(0, 1))}]
            speed = rate * min(1.0, 2 * (1 - step / (steps + 1)))
            for p, g, m in zip(params, grads, moments):
                for k in p:
                    first, second = m[k]
                    first += 0.1 * (g[k] - first)
                    second += 0.01 * (g[k] ** 2 - second)
                    p[k] -= speed * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.99 ** step)) + 1e-8)

    def documents(self, buf: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Mean label probabilities of each row's bytes (rows x labels)."""
        size = np.diff(at)
        n_win = -(-size // WINDOW)
        row = np.repeat(np.arange(len(size)), n_win)
        k = np.arange(len(row)) - np.repeat(np.cumsum(n_win) - n_win, n_win)
        # The last window of a longer text ends with it; only its new bytes count.
        start = np.minimum(k * WINDOW, np.maximum(size[row] - WINDOW, 0))
        skip = k * WINDOW - start
        stop = np.minimum(size[row] - start, WINDOW)
        total = np.zeros((len(size), len(self.labels)))
        padded = np.concatenate([buf, np.full(WINDOW, 0x20, np.uint8)])
        span = np.arange(WINDOW)[:, None]
        for a in range(0, len(row), _BATCH_WINDOWS):
            b = slice(a, a + _BATCH_WINDOWS)
            x = padded[(at[row[b]] + start[b])[None, :] + span]
            x[span >= stop[b]] = 0x20
            p = self.positions(x)
            p *= ((span >= skip[b]) & (span < stop[b]))[:, None, :]
            np.add.at(total, row[b], p.sum(axis=0).T)
        return total / np.maximum(size, 1)[:, None]


def _windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Byte windows spread evenly over each sampled text."""
    for batch in batches:
        for part in slices(batch, "text"):
            buf, at = flat(part.column("text"))
            out = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                starts = np.linspace(a, max(a, b - TRAIN_WINDOW), SAMPLE_WINDOWS).astype(np.int64)
                cut = np.full((SAMPLE_WINDOWS, TRAIN_WINDOW), 0x20, np.uint8)
                for i, s in enumerate(starts.tolist()):
                    piece = buf[s:min(s + TRAIN_WINDOW, b)]
                    cut[i, :len(piece)] = piece
                out.append(cut.tobytes())
            yield pa.RecordBatch.from_arrays([part.column("lang"), pa.array(out, pa.binary())], ["lang", "windows"])


def fit(docs: DataFrame, learn: Column | None = None, sample_docs: int = SAMPLE_DOCS, key: str = "doc_id",
        text: str = "text", lang: str = "lang") -> Network:
    """Train on a bounded sample of the rows where ``learn`` holds and both text
    and language are given. No such rows give a network without labels."""
    rows = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"), F.col(lang).alias("lang"),
                       (F.lit(True) if learn is None else learn).alias("learn")).where("learn and lang is not null and length(text) > 0")
    counts = {r["lang"]: r["count"] for r in rows.groupBy("lang").count().collect()}     # the labels of the network
    labels = sorted(counts)
    net = Network(labels)
    if not labels:
        return net
    share = F.create_map(*[x for c in labels for x in (F.lit(c), F.lit(sample_docs / counts[c]))])
    draw = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) / (1 << 30)
    sample = (rows.where((draw < share[F.col("lang")]) | (share[F.col("lang")] >= 1)).select("lang", "text")
              .mapInArrow(_windows, "lang string, windows binary").toPandas().sort_values(["lang", "windows"]))
    windows = np.frombuffer(b"".join(sample["windows"]), np.uint8).reshape(-1, TRAIN_WINDOW)
    target = np.repeat([labels.index(c) for c in sample["lang"]], SAMPLE_WINDOWS)
    missing = [c for i, c in enumerate(labels) if not (target == i).any()]      # a label whose few rows the draw missed
    if missing:
        more = rows.where(F.col("lang").isin(missing)).orderBy(F.xxhash64("doc_id", F.lit(3)), "doc_id", F.xxhash64("text")).limit(sample_docs * len(missing)).select("lang", "text").mapInArrow(_windows, "lang string, windows binary").toPandas()
        windows = np.concatenate([windows, np.frombuffer(b"".join(more["windows"]), np.uint8).reshape(-1, TRAIN_WINDOW)])
        target = np.concatenate([target, np.repeat([labels.index(c) for c in more["lang"]], SAMPLE_WINDOWS)])
    if len(labels) > 1:
        net.train(windows, target)
    return net


def predict(docs: DataFrame, net: Network, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score`` for every row: the likeliest label and its
    pooled probability. A text that is null or has no letter, or a network
    without labels, gives ``und`` and 0. Repeated rows each get a row; other
    columns are ignored; an empty table gives no rows."""
    shared = docs.sparkSession.sparkContext.broadcast(net)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for part in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                known = np.array([bool(model.labels) and t is not None and any(map(str.isalpha, t)) for t in texts], bool)
                if model.labels:
                    p = model.documents(*flat(part.column("text")))
                    best, score = p.argmax(axis=1), p.max(axis=1)
                else:
                    best, score = np.zeros(len(texts), int), np.zeros(len(texts))
                pred = [model.labels[i] if k else UNKNOWN for i, k in zip(best.tolist(), known.tolist())]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(pred, pa.string()),
                                                  pa.array(np.where(known, np.clip(score, 0, 1), 0.0))], ["doc_id", "lang_pred", "score"])
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def known_language_documents(docs: DataFrame, net: Network, least: float = 0.5, text: str = "text") -> DataFrame:
    """``docs`` without rows of unknown language or a pooled probability under
    ``least``; all columns kept, rows judged one by one (null texts, and texts
    without a letter, go; no learned label leaves none; an empty table stays so)."""
    whole = docs.select(F.struct(*docs.columns).alias("row"), F.col(text).alias("text"))
    return predict(whole, net, key="row").where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= least)).select("doc_id.*")
