"""Token ids packed into fixed-length rows by best-fit decreasing.

Texts are tokenized with a public byte-level BPE vocabulary (its path is a
parameter; the driver reads it once and broadcasts its about 1 MB). Documents
longer than a row are split losslessly into full rows and a rest. The pieces of
a shard are placed longest first, each into the open row with the least room
that still takes it; a segment tree over capacities finds that row in
O(log row length) steps. A packed row holds its id matrix line as little-endian
bytes, cumulative segment lengths and the places where positions restart.

Scale: the work is map-only. Each task cuts its own documents into shards of
``shard_tokens`` tokens, so memory is bounded, no text moves, and a recomputed
task gives the same rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: The split pattern of that vocabulary, and its free id as end mark.
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""
END_ID = 50256
ROW_TOKENS = 2048
SHARD_TOKENS = 2_000_000

def encoder(vocabulary: bytes, pattern: str, width: str):
    """Function from a text to its ids as little-endian bytes."""
    ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in vocabulary.splitlines() if line)}
    encode = tiktoken.Encoding("public", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
    return lambda text: np.array(encode(text), width).tobytes()


class CapacityTree:
    """Segment tree over room 0 .. n: open rows by room left, least fit first."""

    def __init__(self, n: int):
        self.leaves = 1 << n.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.rows: list[list[int]] = [[] for _ in range(n + 1)]

    def add(self, room: int, row: int) -> None:
        self.rows[room].append(row)
        i = room + self.leaves
        while i:
            self.count[i] += 1
            i >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The row with the least room >= ``need``: (row, room), removed."""
        count, i = self.count, need + self.leaves
        if not count[i]:
            while i > 1 and (i & 1 or not count[i + 1]):     # climb until a right sibling has rows
                i >>= 1
            if i <= 1:
                return None
            i += 1
            while i < self.leaves:
                i = 2 * i if count[2 * i] else 2 * i + 1
        room = i - self.leaves
        row = self.rows[room].pop()
        while i:
            count[i] -= 1
            i >>= 1
        return row, room


def best_fit_decreasing(sizes: list[int], capacity: int) -> list[list[int]]:
    """Numbers of the pieces in each row; every size is in 1 .. capacity."""
    tree, rows = CapacityTree(capacity), []
    for piece in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[piece]
        found = tree.take(size)
        if found is None:
            found = len(rows), capacity
            rows.append([])
        rows[found[0]].append(piece)
        if found[1] > size:
            tree.add(found[1] - size, found[0])
    return rows


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN, end_id: int = END_ID,
                   row_tokens: int = ROW_TOKENS, shard_tokens: int = SHARD_TOKENS, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Packed rows: ``shard, row, n_tokens, ids, segment_ends, position_resets,
    doc_ids, doc_offsets``.

    ``ids`` are ``row_tokens`` ids of 2 (or, for larger vocabularies, 4) bytes,
    padded with ``end_id`` after ``n_tokens``. Segment ``i`` is the tokens
    ``segment_ends[i] : segment_ends[i + 1]`` (the list starts with 0) of
    document ``doc_ids[i]`` from its token ``doc_offsets[i]`` on; positions
    restart at ``position_resets``, the segments' starts. Every document ends
    with ``end_id``: an empty text is that id alone. A null text isn't packed;
    a null key is carried as null. Repeated rows are packed as often as they
    occur; other columns are ignored; an empty table gives no rows.
    """
    with open(vocabulary, "rb") as f:
        raw = f.read()
    width = "<u2" if max(end_id, raw.count(b"\n") + 1) < 1 << 16 else "<u4"
    shared = docs.sparkSession.sparkContext.broadcast(raw)
    kind = docs.schema[key].dataType
    bytes_each = int(width[-1])

    def emit(shard: str, pieces: list, arrow_key: pa.DataType) -> pa.RecordBatch:
        pad = np.array([end_id], width).tobytes()
        rows = best_fit_decreasing([len(p[2]) // bytes_each for p in pieces], row_tokens)
        out: list[list] = [[] for _ in range(8)]
        for number, members in enumerate(rows):
            ids = b"".join(pieces[i][2] for i in members)
            n = len(ids) // bytes_each
            ends = np.cumsum([0, *(len(pieces[i][2]) // bytes_each for i in members)]).tolist()
            line = (shard, number, n, ids + pad * (row_tokens - n), ends, ends[:-1],
                    [pieces[i][0] for i in members], [pieces[i][1] for i in members])
            for column, value in zip(out, line):
                column.append(value)
        types = [pa.string(), pa.int32(), pa.int32(), pa.binary(), pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(arrow_key), pa.list_(pa.int64())]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)],
                                          ["shard", "row", "n_tokens", "ids", "segment_ends", "position_resets", "doc_ids", "doc_offsets"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(shared.value, pattern, width)
        end, step = np.array([end_id], width).tobytes(), row_tokens * bytes_each
        task, shard, pieces, held, arrow_key = TaskContext.get().partitionId(), 0, [], 0, pa.int64()
        for batch in batches:
            arrow_key = batch.column("doc_id").type
            for doc, content in zip(batch.column("doc_id").to_pylist(), batch.column("text")):
                ids = encode(content.as_py()) + end
                for at in range(0, len(ids), step):
                    pieces.append((doc, at // bytes_each, ids[at:at + step]))
                    held += min(step, len(ids) - at) // bytes_each
                    if held >= shard_tokens:
                        yield emit(f"{task:06d}-{shard:06d}", pieces, arrow_key)
                        shard, pieces, held = shard + 1, [], 0
        if pieces:
            yield emit(f"{task:06d}-{shard:06d}", pieces, arrow_key)

    schema = (f"shard string, row int, n_tokens int, ids binary, segment_ends array<int>, position_resets array<int>, "
              f"doc_ids array<{kind.simpleString()}>, doc_offsets array<long>")
    return docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text")).where("text is not null").mapInArrow(run, schema)


def write_packed(packed: DataFrame, path: str) -> None:
    """Write packed rows as Parquet, whose binary column holds the id matrix."""
    packed.write.parquet(path)
