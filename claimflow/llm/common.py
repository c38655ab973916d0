"""Helpers shared by the operators of this subpackage.

Texts reach the Python workers as Arrow batches and are handled as flat byte
arrays: word bounds, word hashes and folds are numpy passes over a bounded
slice of whole texts (``SLICE_BYTES``; one longer text is a slice of its own).
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.session import scratch_path

SLICE_BYTES = 500_000
LONG_WORD = 256
SMALL_ROWS = 300_000

#: Odd multiplier of the rolling word hash and the constants of a 64-bit mixer.
_P = np.uint64(0x9E3779B97F4A7C15)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _byte_class(keep) -> np.ndarray:
    return np.array([keep(b) for b in range(256)], dtype=bool)


_WHITE = set(range(0x09, 0x0E)) | {0x20}
#: Bytes of words: all but ASCII white space; or digits, letters and all non-ASCII.
NON_SPACE = _byte_class(lambda b: b not in _WHITE)
ALNUM = _byte_class(lambda b: 0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A or b >= 0x80)
#: Byte values with A-Z lower-cased.
LOWER = np.array([b + 32 if 0x41 <= b <= 0x5A else b for b in range(256)], dtype=np.uint8)


class Words(NamedTuple):
    """Words of a slice: byte bounds and, per row, the range of word numbers."""
    start: np.ndarray
    end: np.ndarray
    row: np.ndarray      # row r has the words row[r]:row[r + 1]


def stage_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: a lineage cut that
    survives lost executors, and a scan whose joins can be split when skewed."""
    path = scratch_path(df.sparkSession, f"llm/{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def if_small(df: DataFrame, rows: int = SMALL_ROWS) -> DataFrame:
    """A written table of slim rows, marked for broadcast if it has at most
    ``rows`` of them; a larger one is joined by a shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


def discard(*tables: DataFrame) -> None:
    """Delete written stages that nothing reads any more."""
    for df in tables:
        jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
        for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def crc_mod(key: str, n: int) -> Column:
    """crc32 of the key as text, modulo n; null for a null key."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % n


def held_out(key: str, n: int, rest: int) -> Column:
    """True for held-out keys; a null key is held out (never learned from)."""
    return F.coalesce(crc_mod(key, n) == rest, F.lit(True))


def slices(batch: pa.RecordBatch, column: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch into runs of rows whose texts have at most ``limit`` bytes."""
    size = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0), dtype=np.int64)
    at = np.concatenate([[0], np.cumsum(size)])
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(at, at[lo] + limit, side="right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def whole_groups(batches: Iterator[pa.RecordBatch], keys: tuple[str, ...], least_rows: int = 2_000) -> Iterator[pa.RecordBatch]:
    """Batches sorted by ``keys``, regrouped so that none cuts a group."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        if sum(b.num_rows for b in held) < least_rows:
            continue
        rows = pa.concat_batches(held)
        differ = np.zeros(rows.num_rows, bool)
        for k in keys:
            column = np.asarray(rows.column(k))
            differ |= column != column[-1]
        cut = int(np.flatnonzero(differ)[-1]) + 1 if differ.any() else 0
        if cut:
            yield rows.slice(0, cut)
        held = [rows.slice(cut)]
    if held:
        yield pa.concat_batches(held)


def flat(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of an Arrow string array and the n + 1 row offsets; null is empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offs, data = texts.buffers()
    at = np.frombuffer(offs, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1] if offs else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def words(buf: np.ndarray, at: np.ndarray, word_byte: np.ndarray) -> Words:
    """Maximal runs of word bytes, never across rows."""
    mask = word_byte[buf]
    first, last = mask.copy(), mask.copy()
    first[1:] &= ~mask[:-1]
    last[:-1] &= ~mask[1:]
    full = at[:-1] < at[1:]
    first[at[:-1][full]] = mask[at[:-1][full]]
    last[at[1:][full] - 1] = mask[at[1:][full] - 1]
    start = np.flatnonzero(first)
    return Words(start, np.flatnonzero(last) + 1, np.searchsorted(start, at))


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * _M1
    x = x ^ (x >> np.uint64(27))
    x = x * _M2
    return x ^ (x >> np.uint64(31))


_powers = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        inverse = np.uint64(pow(int(_P), -1, 1 << 64))
        def run(x: np.uint64) -> np.ndarray:
            return np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n - 1, x, np.uint64)]))
        _powers = (run(_P), run(inverse))
    return _powers


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * _P)


def word_hashes(buf: np.ndarray, w: Words, seed: int = 0) -> np.ndarray:
    """64-bit hash of each word's bytes, from one running sum over the slice."""
    if not len(w.start):
        return np.zeros(0, np.uint64)
    up, down = _power_tables(max(len(buf), SLICE_BYTES) + 1)
    total = np.zeros(len(buf) + 1, np.uint64)
    np.cumsum(_BYTE_VALUE[buf] * up[:len(buf)], out=total[1:])
    plain = (total[w.end] - total[w.start]) * down[w.start] + (w.end - w.start).astype(np.uint64)
    # Long words can be made to collide in a sum modulo 2^64: they get a digest.
    for i in np.flatnonzero(w.end - w.start > LONG_WORD).tolist():
        plain[i] = int.from_bytes(hashlib.blake2b(buf[w.start[i]:w.end[i]].data, digest_size=8).digest(), "little")
    return mix(plain + np.uint64(seed))


def rows_of(bounds: np.ndarray) -> np.ndarray:
    """Row number of each item, from the rows' item ranges."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
