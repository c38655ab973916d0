"""Exact top-k inner-product search by exhaustive term-at-a-time accumulation.

Vectors become integers, ``floor(scale * x)``, and every dimension is a term.
A block of candidates is inverted into postings per term (its rows with a
non-zero weight); for each term, the query rows that hold it scatter their
weight times the postings into a dense score array. The best ``k`` of each
block are taken by partition selection, and the blocks' winners are merged.

Scale: the queries are a stated set. They are numbered once and go in blocks of
``QUERY_BLOCK`` rows, each one broadcast of bounded size and one map-only pass
over all candidates; what is shuffled is ``k`` rows per query and candidate
block, pre-selected in each task. No pairs and no cross join are formed.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimflow.llm.common import stage_table

QUERY_BLOCK = 4096
CANDIDATE_BLOCK = 4096
_LONG = np.iinfo(np.int64)


def postings(weights: np.ndarray) -> list[tuple[np.ndarray | slice, np.ndarray]]:
    """Per term the rows with a non-zero weight and those weights; a term that
    most rows hold keeps them all, which scatters without an index."""
    out = []
    for column in weights.T:
        rows = np.flatnonzero(column)
        out.append((slice(None), np.ascontiguousarray(column)) if 2 * len(rows) > len(column) else (rows, column[rows]))
    return out


def accumulate(queries: np.ndarray, terms: list, n: int) -> np.ndarray:
    """Scores (queries x candidates), one term at a time."""
    scores = np.zeros((len(queries), n), queries.dtype)
    for t, (rows, weights) in enumerate(terms):
        holders = np.flatnonzero(queries[:, t])
        if not len(holders) or not len(weights):
            continue
        held = queries[holders, t]
        if isinstance(rows, slice) and len(holders) == len(queries):
            scores += held[:, None] * weights
        else:
            for q, x in zip(holders.tolist(), held):
                scores[q][rows] += x * weights
    return scores


def select(scores: np.ndarray, k: int) -> np.ndarray:
    """Columns of the ``k`` highest scores of each row; of equal scores the
    smaller column. Columns must be in order of their ids."""
    n = scores.shape[1]
    if n <= k:
        return np.broadcast_to(np.arange(n), scores.shape)
    cut = np.partition(scores, n - k, axis=1)[:, n - k][:, None]
    above = scores > cut
    spare = k - above.sum(axis=1, keepdims=True)
    level = scores == cut
    taken = above | (level & (np.cumsum(level, axis=1) <= spare))
    return np.nonzero(taken)[1].reshape(-1, k)


def _integers(df: DataFrame, key: str, vector: str, scale: int) -> DataFrame:
    """``vec_id, v``: integer vectors of the rows that take part."""
    v = F.col(vector).cast("array<double>")
    finite = F.forall("x", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    limit = F.lit(9.2e18)
    whole = F.transform("x", lambda x: F.floor(F.greatest(F.least(F.lit(float(scale)) * x, limit), -limit)))
    return (df.select(F.col(key).alias("vec_id"), v.alias("x")).where("vec_id is not null and x is not null")
            .where(finite).select("vec_id", whole.alias("v")))


def _matrix(lists: pa.Array) -> np.ndarray:
    """Rows of equal length as int64."""
    return np.asarray(lists.flatten(), dtype=np.int64).reshape(len(lists), -1)


def _fits(queries: np.ndarray, candidates: np.ndarray) -> bool:
    """Can no sum leave the range of a long?"""
    top = [max(int(x.max(initial=0)), -int(x.min(initial=0))) for x in (queries, candidates)]
    return top[0] * top[1] * max(queries.shape[1], 1) <= _LONG.max


def top_k(df: DataFrame, is_query: Column, k: int = 5, scale: int = 256, key: str = "vec_id", vector: str = "embedding",
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row where ``is_query`` (on
    the key, named ``vec_id``) holds, its ``k`` best other rows by inner product of the
    integer vectors, ties to the smaller id; all rows if there are fewer.

    Rows with a null key or vector, or a null or non-finite component, take no
    part; vectors meet only those of their own length. Rows that repeat a key
    are told apart by their place among them: only the query's own row is left
    out, and each repeated query row is answered alone. Sums beyond a long are
    counted exactly and clamped to its range, components too. Other columns are
    ignored; an empty table gives no rows.
    """
    spark = df.sparkSession
    same = Window.partitionBy("vec_id").orderBy("v")
    vectors = stage_table(_integers(df, key, vector, scale).withColumn("copy", F.row_number().over(same)), "vectors")
    queries = vectors.where(is_query)
    numbered = queries.select("vec_id", "copy").orderBy("vec_id", "copy").rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    kind = vectors.schema["vec_id"].dataType.simpleString()
    numbers = stage_table(spark.createDataFrame(numbered, f"vec_id {kind}, copy int, q long"), "queries")
    queries = stage_table(queries.join(numbers, ["vec_id", "copy"]), "query-vectors")
    found, n_queries = None, numbers.count()
    for first in range(0, n_queries, query_block):
        rows = queries.where(f"q >= {first} and q < {first + query_block}").orderBy("q").collect()
        shared = spark.sparkContext.broadcast([(r["q"], r["vec_id"], r["copy"], r["v"]) for r in rows])
        part = vectors.mapInArrow(_search(shared, k), f"q long, query_id {kind}, vec_id {kind}, copy int, score long")
        if n_queries > query_block:         # one block's broadcast at a time
            part = stage_table(part, "block-winners")
            shared.destroy()
        found = part if found is None else found.unionByName(part)
    if found is None:
        return spark.createDataFrame([], f"query_id {kind}, rank int, vec_id {kind}, score long")
    best = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id", "copy")
    return (found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))


def _search(shared, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_length: dict[int, list] = {}
        for row in shared.value:
            by_length.setdefault(len(row[3]), []).append(row)
        kept: dict[int, list] = {}                      # winners so far, per vector length
        names = ["q", "query_id", "vec_id", "copy", "score"]
        for batch in batches:
            size = np.asarray(pc.list_value_length(batch.column("v")))
            for length, rows in by_length.items():
                mine = np.flatnonzero(size == length)
                for a in range(0, len(mine), CANDIDATE_BLOCK):
                    part = batch.take(pa.array(mine[a:a + CANDIDATE_BLOCK])).sort_by([("vec_id", "ascending"), ("copy", "ascending")])
                    kept[length] = _merge(kept.get(length), _block(rows, part, k), k)
        for length, won in kept.items():
            rows = by_length[length]
            q = [won_row[0] for won_row in won]
            flat_rows = [(rows[i][0], rows[i][1], c[1], c[2], -c[0]) for i, w in zip(q, won) for c in w[1]]
            columns = list(zip(*flat_rows)) if flat_rows else [()] * 5
            types = [pa.int64(), batch.column("vec_id").type, batch.column("vec_id").type, pa.int32(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names)
    return run


def _block(rows: list, part: pa.RecordBatch, k: int) -> list:
    """Per query its best candidates of a block: (query, [(-score, id, copy)])."""
    queries = np.array([r[3] for r in rows], np.int64).reshape(len(rows), -1)
    candidates = _matrix(part.column("v"))
    kind = np.int64 if _fits(queries, candidates) else object
    scores = accumulate(queries.astype(kind), postings(candidates.astype(kind)), len(candidates))
    if kind is object:
        scores = np.clip(scores, int(_LONG.min), int(_LONG.max)).astype(np.int64)
    best = select(scores, k + 1)                        # one more: the query's own row may be among them
    ids, copies = part.column("vec_id").to_pylist(), part.column("copy").to_pylist()
    out = []
    for i, (row, cols) in enumerate(zip(rows, best.tolist())):
        won = sorted((-int(scores[i, c]), ids[c], copies[c]) for c in cols if (ids[c], copies[c]) != (row[1], row[2]))
        out.append((i, won[:k]))
    return out


def _merge(a: list | None, b: list, k: int) -> list:
    return b if a is None else [(x[0], sorted(x[1] + y[1])[:k]) for x, y in zip(a, b)]
