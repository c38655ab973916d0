"""Line dedup against a plain count, and the index through insertions and deletions."""
import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest

from claimflow.llm import line_dedup
from rows import awkward, empty, prose

LOWER = {i: i + 32 for i in range(65, 91)}


def key(line):
    return re.sub(r"^[\x20\x09-\x0d]+|[\x20\x09-\x0d]+$", "", line).translate(LOWER)


def brute(texts, least, seen=None, least_chars=1):
    n = Counter(k for t in (texts if seen is None else seen) for k in {key(x) for x in (t or "").split("\n")} if len(k) >= least_chars)
    out = []
    for t in texts:
        lines = (t or "").split("\n")
        kept = [x for x in lines if n[key(x)] < least]
        out.append(("\n".join(kept), len(lines), len(lines) - len(kept)))
    return out


def got(df):
    return sorted(((r.kept_text, r.n_lines, r.n_dropped) for r in df.collect()), key=repr)


def lined(rng, n, common):
    return ["\n".join(rng.choice([rng.choice(common), prose(rng, 4), "", "  ", " \t" + rng.choice(common).upper() + "\r"]) for _ in range(rng.randint(1, 12)))
            for _ in range(n)]


def table(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def digests(n, seed):
    return np.random.default_rng(seed).integers(0, 256, (n, 16), dtype=np.uint8)


def test_filter_holds_what_was_inserted_and_not_what_was_deleted():
    some, others = digests(5000, 1), digests(50_000, 2)
    cuckoo = line_dedup.CuckooFilter.sized(len(some))
    assert cuckoo.insert(some)
    lookup = line_dedup.Lookup({0: cuckoo.cells.tobytes()}, 1)
    assert lookup.has(some).all() and lookup.has(others).mean() < 0.001
    cuckoo.delete(some[:2500])
    lookup = line_dedup.Lookup({0: cuckoo.cells.tobytes()}, 1)
    assert lookup.has(some[2500:]).all() and lookup.has(some[:2500]).mean() < 0.01
    with pytest.raises(ValueError):
        line_dedup.CuckooFilter.sized(10).delete(some[:1])
    assert not line_dedup.CuckooFilter.sized(1).insert(digests(60, 3))      # too many for four places


def test_lines_of_odd_rows_match_plain_splitting():
    texts = ["", "\n", "a\n", "\na", " A \n\n\tb\x0b\r\n", "é \n  ", "x" * 50 + "\n" * 50]
    import pyarrow as pa

    from claimflow.llm.common import flat
    buf, at = flat(pa.array(texts))
    lines = line_dedup.cut_lines(buf, at)
    raw = buf.tobytes()
    want = [x for t in texts for x in t.split("\n")]
    assert [raw[a:b].decode() for a, b in zip(lines.start, lines.end)] == want
    assert [raw[a:b].decode().translate(LOWER) for a, b in zip(lines.key_start, lines.key_end)] == [key(x) for x in want]
    assert np.diff(lines.row).tolist() == [len(t.split("\n")) for t in texts]


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_BYTES, 0])
def test_dropped_lines_equal_a_plain_count(spark, monkeypatch, limit):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 5)
    rng = random.Random(4)
    texts = lined(rng, 150, [prose(rng, 3) for _ in range(60)]) + [None, "", "\n\n", "same\nwords " + "y" * 400_000] + ["same"] * 30
    docs = table(spark, texts)
    for least, chars in ((3, 1), (10, 20)):
        index = line_dedup.insert(line_dedup.new_index(spark, least, chars), docs)
        assert index.shards > 1 or least == 10
        assert got(line_dedup.drop_repeated_lines(docs, index, broadcast_bytes=limit)) == sorted(brute(texts, least, None, chars), key=repr)


def test_index_after_insertions_and_deletions_is_that_of_the_rest(spark, monkeypatch):
    monkeypatch.setattr(line_dedup, "SHARD_KEYS", 40)
    rng = random.Random(5)
    common = [prose(rng, 2) for _ in range(300)]
    batches = [lined(rng, 120, common) for _ in range(4)]
    index = line_dedup.new_index(spark, 4)
    for b in batches:
        index = line_dedup.insert(index, table(spark, b))
    index = line_dedup.delete(index, table(spark, batches[1]))
    index = line_dedup.delete(index, table(spark, batches[3][:60]))
    left = batches[0] + batches[2] + batches[3][60:]
    fresh = line_dedup.insert(line_dedup.new_index(spark, 4), table(spark, left))
    counts = [{bytes(r.digest): r.n for r in i.counts.collect()} for i in (index, fresh)]
    assert counts[0] == counts[1]
    assert got(line_dedup.drop_repeated_lines(table(spark, left), index)) == sorted(brute(left, 4), key=repr)
    # documents that aren't in the index are cut by the index as it is
    assert got(line_dedup.drop_repeated_lines(table(spark, batches[1]), index)) == sorted(brute(batches[1], 4, left), key=repr)
    with pytest.raises(ValueError):
        line_dedup.delete(index, table(spark, ["never inserted"]))
    # the filters hold just the frequent keys
    frequent = {bytes(r.digest) for r in line_dedup.repeated_lines(index).collect()}
    lookup = line_dedup.Lookup({r.shard: bytes(r.cells) for r in index.filters.collect()}, index.shards)
    marks = sum(int((np.frombuffer(r.cells, np.uint16) > 0).sum()) for r in index.filters.collect())
    assert marks == len(frequent) and lookup.has(line_dedup._bytes(sorted(frequent))).all()


@pytest.mark.parametrize("limit", [line_dedup.BROADCAST_BYTES, 0])
def test_awkward_rows_and_empty_tables(spark, limit):
    docs, rows = awkward(spark)
    index = line_dedup.insert(line_dedup.new_index(spark, 2), docs)
    out = line_dedup.drop_repeated_lines(docs, index, broadcast_bytes=limit)
    assert got(out) == sorted(brute([r[1] for r in rows], 2), key=repr)
    assert Counter(r.doc_id for r in out.collect()) == Counter(r[0] for r in rows)
    none = line_dedup.insert(line_dedup.new_index(spark), empty(spark))
    assert line_dedup.drop_repeated_lines(empty(spark), none, broadcast_bytes=limit).count() == 0
    assert got(line_dedup.drop_repeated_lines(docs, none, broadcast_bytes=limit)) == sorted(((r[1] or "", len((r[1] or "").split("\n")), 0) for r in rows), key=repr)
    assert hashlib.sha256(b"").hexdigest()          # what a document without lines left hashes to
