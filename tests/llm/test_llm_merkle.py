"""Merkle manifest against plain hashlib."""
import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from claimflow.llm import merkle
from rows import awkward, empty

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def up(nodes):
    """Levels of a tree of runs of three, leaves first."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][i:i + 3]) for i in range(0, len(levels[-1]), 3)])
    return levels


def climb(levels, i, digest):
    siblings = []
    for level in levels[:-1]:
        run = level[i // 3 * 3:i // 3 * 3 + 3]
        siblings += run[:i % 3] + run[i % 3 + 1:]
        digest = H(*run[:i % 3], digest, *run[i % 3 + 1:])
        i //= 3
    return digest, siblings


def brute(rows, tamper):
    """rows: (doc_id, source, lang, n_chars, text); by the plain definition."""
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        mine = sorted(sources[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees[s] = (mine, up([leaf(r) for r in mine]))
    top = up([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        mine, levels = trees[s]
        for i, r in enumerate(mine):
            sub, a = climb(levels, i, leaf(tamper(r)))
            root, b = climb(top, k, sub)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], H(*a, *b), root, root == top[-1][0]))
    return out


def cut_lines(r):
    return (*r[:4], r[4].replace("\n", "")) if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r


def query(docs):
    cut = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.lit(False))
    return merkle.manifest(docs, FIELDS, seen={"text": F.when(cut, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))})


def test_states_resume_like_plain_hashes():
    rng = np.random.default_rng(1)
    digests = rng.integers(0, 256, (5000, 3, 32), dtype=np.uint8)
    state = np.tile(merkle.START, (5000, 1))
    for j in range(3):
        state = merkle.compress(state, merkle.hex_block(digests[:, j]))
    got = merkle.finish(state, np.full(5000, 3))
    for i in range(0, 5000, 97):
        assert got[i].tobytes() == hashlib.sha256(digests[i].tobytes().hex().encode()).digest()
    assert merkle.finish(merkle.START[None], np.zeros(1, np.int64))[0].tobytes() == hashlib.sha256().digest()


def test_manifest_equals_the_plain_tree(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 2)     # chunks of nine: several layers
    docs, rows = awkward(spark, n=150)
    plain = [(r[0], r[3], r[2], r[4], r[1]) for r in rows]
    got = [tuple(r) for r in query(docs).collect()]
    assert sorted(got, key=repr) == sorted(brute(plain, cut_lines), key=repr)
    assert 0 < sum(not r[-1] for r in got) < len(got)


def test_many_groups_one_leaf_and_no_rows(spark, monkeypatch):
    monkeypatch.setattr(merkle, "LEVELS", 1)
    rows = [(i, f"é{i % 29}" if i % 31 else None, "en", i, f"line\n{i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string")
    assert sorted(map(tuple, query(docs).collect()), key=repr) == sorted(brute(rows, cut_lines), key=repr)
    one = docs.where("doc_id = 7")
    assert [tuple(r) for r in query(one).collect()] == brute(rows[7:8], cut_lines)
    assert query(one).first()["proof_sha256"] == hashlib.sha256().hexdigest()
    assert query(empty(spark)).count() == 0
