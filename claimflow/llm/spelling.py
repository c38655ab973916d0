"""Spelling variants of words, joined by PartEnum signatures.

A word's letters are a multiset, i.e. a binary vector with one dimension for each
(letter, occurrence). One inserted or deleted letter moves it by one, a replaced
one by two at most, so variants have Hamming distance 2 or less. PartEnum (Arasu,
Ganti and Kaushik, 2006) deals the dimensions into ``FIRST`` partitions, in one of
which the distance is at most ``2 // FIRST``, and each of them into ``SECOND``
parts; leaving out every choice of so many parts gives signatures of which two
such words share at least one, exactly. Words that share a signature meet in an
equi-join and are verified by their edit distance.

With m letters in the shorter one, variants also agree in the first half of m or
in the last (one edit can't touch both), so each signature comes with m and either
half: words of like letters in another order, which the multiset can't tell apart,
then rarely meet. A word is the shorter one of its variants or one letter longer,
so it signs with its length and with one less.

Scale: occurrences are counted by an aggregation with partial counts; all the rest
is about distinct words. A signature's words are joined, not gathered, and only
verified pairs leave the join.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimflow.llm.common import mix, rows_of, slices, stage_table

DISTANCE = 2
FIRST, SECOND = 1, 4
LEAST_LENGTH = 7
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RUN = r"[A-Za-zÀ-ÿ]{%d,}+"


def occurrences(docs: DataFrame, slip: int = 0, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``word``: every run of letters of ``LEAST_LENGTH`` code points or more,
    A-Z lower-cased. With ``slip``, every run whose crc32 with its document's key
    is divisible by it loses one letter, as a typing slip would take it. A null
    text has no words, a null key counts as an empty one."""
    runs = docs.select(F.coalesce(F.col(key).cast("string"), F.lit("")).alias("k"),
                       F.explode(F.regexp_extract_all(text, F.lit(RUN % LEAST_LENGTH), F.lit(0))).alias("run"))
    low = runs.select("k", F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run")).alias("word"))
    if not slip:
        return low.select("word")
    hashed = low.select("word", F.crc32(F.concat("k", F.lit(":"), "word").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("word")).cast("int")
    cut = F.concat(F.substring("word", F.lit(1), at), F.substring("word", at + 2, F.length("word")))
    return hashed.select(F.when(F.col("h") % slip == 0, cut).otherwise(F.col("word")).alias("word")).where(F.length("word") >= LEAST_LENGTH)


def signatures(words: list[str], first: int = FIRST, second: int = SECOND) -> np.ndarray:
    """One row of 64-bit signatures per word (without length and half)."""
    size = np.array([len(w) for w in words], np.int64)
    row = rows_of(np.concatenate([[0], np.cumsum(size)]))
    code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).astype(np.uint64)
    order = np.lexsort((code, row))
    row, code = row[order], code[order]
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (code[1:] != code[:-1])
    place = np.arange(len(row))
    nth = place - np.maximum.accumulate(np.where(new, place, 0))
    element = mix((code << np.uint64(32)) + nth.astype(np.uint64) + np.uint64(1))
    part = (element % np.uint64(first * second)).astype(np.int64)
    sums = np.zeros((len(words), first * second), np.uint64)
    np.add.at(sums, (row, part), mix(element + np.uint64(3)))
    sums = mix(sums + np.arange(first * second, dtype=np.uint64)).reshape(len(words), first, second)
    out = []
    for i in range(first):
        for n, kept in enumerate(combinations(range(second), second - DISTANCE // first)):
            out.append(mix(sums[:, i, list(kept)].sum(axis=1, dtype=np.uint64) + np.uint64(1000 * i + n)))
    return np.stack(out, axis=1)


def signature_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Signatures with length and half: (word number, signature), one row each."""
    plain, at, out = signatures(words), [], []
    for less in (0, 1):
        use = np.array([i for i, w in enumerate(words) if len(w) - less >= LEAST_LENGTH], np.int64)
        sizes = [len(words[i]) - less for i in use]
        halves = [np.array([zlib.crc32(f"{end}{m}:{half(words[i], m)}".encode()) for i, m in zip(use, sizes)], np.uint64)[:, None]
                  for end, half in (("first", lambda w, m: w[:(m + 1) // 2]), ("last", lambda w, m: w[-(m // 2):]))]
        signed = mix(np.concatenate([plain[use] + h for h in halves], axis=1))
        at.append(np.repeat(use, signed.shape[1]))
        out.append(signed.ravel())
    return np.concatenate(at), np.concatenate(out)


def _signed(words: DataFrame) -> DataFrame:
    """``sig, word, n``: one row per word and signature."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "word"):
                at, sigs = signature_rows(part.column("word").to_pylist())
                take = pa.array(at)
                yield pa.RecordBatch.from_arrays([pa.array(sigs.view(np.int64)), part.column("word").take(take), part.column("n").take(take)],
                                                 ["sig", "word", "n"])
    return words.select("word", "n").mapInArrow(run, "sig long, word string, n long")


def near_pairs(words: DataFrame) -> DataFrame:
    """``word, n, near, near_n``, both ways: distinct words of ``words(word, n)``
    that differ by one inserted, deleted or replaced code point."""
    signed = stage_table(_signed(words), "word-signatures")
    a, b = signed.toDF("sig", "a", "na"), signed.toDF("sig", "b", "nb")
    apart = F.abs(F.length("a") - F.length("b")) <= 1
    pairs = (a.join(b, "sig").where((F.col("a") < F.col("b")) & apart & (F.levenshtein("a", "b", 1) == 1))
             .select("a", "na", "b", "nb").distinct())
    pairs = stage_table(pairs, "near-words")
    return pairs.toDF("word", "n", "near", "near_n").unionByName(pairs.select("b", "nb", "a", "na").toDF("word", "n", "near", "near_n"))


def _roots(forms: DataFrame) -> DataFrame:
    """``word, root``: the last word along the forms. A form is ``ratio`` times
    as frequent as its word, so chains are short; every round doubles the steps."""
    ways = stage_table(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        ways = stage_table(ways.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("on")), "forms")
        if ways.where("on").isEmpty():
            return ways.select("word", "root")
        ways = ways.select("word", "root")


def variants(occurring: DataFrame, least_count: int = 2, ratio: int = 10) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` for every distinct ``word`` of
    ``occurring`` (one row per occurrence) that has ``LEAST_LENGTH`` code points
    or more and occurs ``least_count`` times or more.

    ``n_near`` counts the near words (``near_pairs``); ``form`` is the one of
    largest count (ties: smallest in code-point order) if that is at least
    ``ratio`` times the word's, else null; ``root`` is the last word along the
    forms, the word itself without one. Null words are left out, shorter ones
    too; other columns are ignored; no words give no rows.
    """
    words = occurring.where(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= least_count)
    words = stage_table(words, "words")
    best = F.min(F.struct((-F.col("near_n")).alias("minus"), F.col("near").alias("form"))).alias("best")
    near = near_pairs(words).groupBy("word", "n").agg(F.count("*").alias("n_near"), best)
    form_n = -F.col("best.minus")
    near = stage_table(near.select("word", "n_near", F.when(form_n >= ratio * F.col("n"), F.struct(F.col("best.form").alias("form"), form_n.alias("form_n"))).alias("f"))
                       .select("word", "n_near", "f.form", "f.form_n"), "word-forms")
    roots = _roots(near.where("form is not null"))
    return (words.join(near, "word", "left").join(roots, "word", "left")
            .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), "form", "form_n", F.coalesce("root", "word").alias("root")))
