"""Grouping of spelling variants by edit neighbourhoods over a reduced alphabet.

Letters are hashed to a few symbols, and a word to the polynomial hash of its symbols. Words one edit apart are
at most one edit apart as symbols, so one of them is in the other's one-edit neighbourhood of reduced words.
Neighbourhoods are joined with the reduced vocabulary and what meets is verified on the words themselves. The
relation is symmetric, hence every pair is generated from one of its sides: a shorter word from the longer one,
of two equally long ones the one with the greater symbol from the other. Few symbols keep neighbourhoods small;
enough of them keep false meetings rare, whatever the number of words.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import written

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH = 7
LEAST_TIMES = 2
#: One occurrence in so many is damaged by the contract.
DAMAGED = 31
#: A form is at least so many times as frequent as its variant.
FACTOR = 10
SYMBOLS = 8
#: An odd number, so that it has an inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
INVERSE = pow(BASE, -1, 1 << 64)
#: Letters that are turned into neighbourhoods at once.
LETTERS_AT_ONCE = 1 << 17


def vocabulary(docs: DataFrame) -> DataFrame:
    """word and n (occurrences) of all words of docs, after the contract's damage, written once.

    Null and empty texts have no words; a null doc_id is damaged as an empty one. Repeated rows count as often
    as they come. An empty table gives no words; other columns are ignored; whole runs count, however long.
    """
    lowered = docs.selectExpr("doc_id", f"translate(text, '{UPPER}', '{LOWER}') AS t")
    runs = lowered.selectExpr(
        "doc_id", f"explode(filter(regexp_extract_all(t, '[a-z\\u00C0-\\u00FF]+', 0), x -> char_length(x) >= {LEAST_LENGTH})) AS run"
    )
    hashed = runs.withColumn("h", F.expr("crc32(encode(concat(coalesce(CAST(doc_id AS string), ''), ':', run), 'UTF-8'))"))
    at = "CAST(h % char_length(run) AS int)"
    word = f"IF(h % {DAMAGED} = 0, concat(substr(run, 1, {at}), substr(run, {at} + 2)), run)"
    words = hashed.selectExpr(f"{word} AS word").where(f"char_length(word) >= {LEAST_LENGTH}")
    return written(words.groupBy("word").agg(F.count("*").alias("n")).where(f"n >= {LEAST_TIMES}"), "spelling-words")


def reduced_keys(words: list[str]) -> np.ndarray:
    """The hash of each word's symbols: the sum of symbol * BASE**place, modulo 2**64."""
    keys = np.empty(len(words), np.uint64)
    for at, symbols in _by_length(words):
        keys[at] = (symbols * _powers(symbols.shape[1])).sum(axis=1, dtype=np.uint64)
    return keys


def _powers(length: int) -> np.ndarray:
    powers = np.full(length, BASE, np.uint64)
    powers[:1] = 1
    return np.cumprod(powers, dtype=np.uint64)


def _by_length(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in words, and their symbols (1 to SYMBOLS) as a matrix, for words of equal length."""
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    for length in np.unique(lengths):
        places = np.flatnonzero(lengths == length)
        step = max(1, LETTERS_AT_ONCE // int(length))
        for begin in range(0, len(places), step):
            at = places[begin : begin + step]
            letters = np.frombuffer("".join([words[i] for i in at]).encode("latin-1"), np.uint8)
            yield at, letters.reshape(len(at), int(length)).astype(np.uint64) % np.uint64(SYMBOLS) + np.uint64(1)


def neighbourhoods(words: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places in words, and keys of their reduced neighbours: the reduced word itself, those with a symbol less,
    and those with a symbol replaced by a greater one."""
    for at, symbols in _by_length(words):
        length = symbols.shape[1]
        powers = _powers(length)
        terms = symbols * powers
        sums = np.cumsum(terms, axis=1, dtype=np.uint64)
        whole = sums[:, -1:]
        yield at, whole[:, 0]
        # what stands behind the left-out symbol moves one place to the front; in a run of equal symbols once
        shorter = sums - terms + (whole - sums) * np.uint64(INVERSE)
        once = np.ones(symbols.shape, bool)
        once[:, :-1] = symbols[:, :-1] != symbols[:, 1:]
        rows, columns = np.nonzero(once)
        yield at[rows], shorter[rows, columns]
        for symbol in range(2, SYMBOLS + 1):
            rows, columns = np.nonzero(symbols < symbol)
            yield at[rows], whole[rows, 0] + (np.uint64(symbol) - symbols[rows, columns]) * powers[columns]


def _keyed(words: DataFrame) -> DataFrame:
    """key, word and n of words (word, n)."""

    def keyed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = reduced_keys(batch.column(0).to_pylist()).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), *batch.columns], names=["key", "word", "n"])

    return words.select("word", "n").mapInArrow(keyed, "key bigint, word string, n bigint")


def _generated(words: DataFrame) -> DataFrame:
    """key and id of every reduced neighbour, id a hash of the word it is generated from."""

    def generated(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for at, keys in neighbourhoods(batch.column(1).to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(ids[at])], names=["key", "id"])

    return words.selectExpr("xxhash64(word) AS id", "word").mapInArrow(generated, "key bigint, id bigint")


def near_words(words: DataFrame) -> DataFrame:
    """word, n, other, other_n of every two words of words (word, n) that are one edit apart, both ways round."""
    met = _generated(words).join(_keyed(words), "key").select("id", F.col("word").alias("other"), F.col("n").alias("other_n"))
    sides = met.join(words.selectExpr("xxhash64(word) AS id", "word", "n"), "id")
    near = sides.where("levenshtein(word, other, 1) = 1").selectExpr(
        "inline(array(struct(word, n, other, other_n), struct(other AS word, other_n AS n, word AS other, n AS other_n)))"
    )
    # words of equal symbols meet from both sides
    return near.repartition("word").dropDuplicates(["word", "other"])


def variants(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near and form_n of words (word, n), one row per word.

    A word's form is its near word of largest n, ties by code points, if that is FACTOR times its own n. Each
    step to a form multiplies n by FACTOR, so the largest n bounds the steps to the root, and doubling them
    needs only few joins. What is grouped per word are near words: at most a few for each letter and place.
    """
    summed = near_words(words).groupBy("word").agg(F.count("*").alias("n_near"), F.first("n").alias("n"), F.expr("min(struct(-other_n AS least, other))").alias("best"))
    form = summed.selectExpr("word", "n_near", f"IF(-best.least >= {FACTOR} * n, best, NULL) AS best")
    formed = written(form.selectExpr("word", "n_near", "best.other AS form", "-best.least AS form_n"), "spelling-forms")
    most = words.agg(F.max("n")).first()[0] or 0
    steps = max(1, math.floor(math.log(max(most / LEAST_TIMES, 1), FACTOR) + 1e-9))
    roots = formed.where("form IS NOT NULL").selectExpr("word", "form AS root")
    for _ in range(math.ceil(math.log2(steps))):
        further = roots.selectExpr("word AS root", "root AS next")
        roots = written(roots.join(further, "root", "left").selectExpr("word", "coalesce(next, root) AS root"), "spelling-roots")
    return (
        words.join(formed, "word", "left")
        .join(roots, "word", "left")
        .selectExpr("word", "form", "coalesce(root, word) AS root", "n", "coalesce(n_near, 0L) AS n_near", "form_n")
    )


def spelling_variants(docs: DataFrame) -> DataFrame:
    """variants() of the vocabulary() of docs (doc_id, text)."""
    return variants(vocabulary(docs))
