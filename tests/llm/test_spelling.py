"""Spelling variants against a plain version."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from masterlint.llm import spelling
from masterlint.llm.oracle import ORACLE_SQL
from masterlint.llm.queries import QUERIES

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = str.maketrans(spelling.UPPER, spelling.LOWER)
ODD_SCHEMA = "doc_id bigint, text string, word string, n string, key int, form boolean"


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in RUN.findall(text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def one_apart(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) > len(b):
        a, b = b, a
    i = 0
    while i < len(a) and a[i] == b[i]:
        i += 1
    return a[i + 1 :] == b[i + 1 :] if len(a) == len(b) else a[i:] == b[i + 1 :]


def plain_variants(rows):
    words = plain_words(rows)
    near = {w: [] for w in words}
    by_length = {}
    for w in words:
        by_length.setdefault(len(w), []).append(w)
    for w in words:
        for length in (len(w) - 1, len(w), len(w) + 1):
            near[w] += [v for v in by_length.get(length, ()) if one_apart(w, v)]
    form = {}
    for w, n in words.items():
        best = min(near[w], key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 10 * n else None

    def root(w):
        while form[w]:
            w = form[w]
        return w

    return {(w, form[w], root(w), n, len(near[w]), words.get(form[w])) for w, n in words.items()}


def found(df):
    rows = [tuple(r) for r in df.select("word", "form", "root", "n", "n_near", "form_n").collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def texts(seed, n_docs, letters, alphabet="abcdéÿ"):
    source = random.Random(seed)
    stock = ["".join(source.choice(alphabet) for _ in range(source.randrange(*letters))) for _ in range(60)]
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(200):
            w = source.choice(stock[:5] if source.random() < 0.7 else stock)
            if source.random() < 0.15:
                at = source.randrange(len(w))
                w = w[:at] + source.choice(["", "a", "Z", "é", w[at] * 2]) + w[at + 1 :]
            words.append(w.upper() if source.random() < 0.1 else w)
        rows.append((i if i % 7 else None, " ".join(words)))
    return rows


@pytest.mark.parametrize("letters", [(7, 9), (7, 30), (8, 200)])
def test_as_a_plain_version(spark, letters):
    rows = texts(3, 60, letters)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    expected = plain_variants(rows)
    assert found(spelling.spelling_variants(df)) == expected
    assert any(form for _, form, *_ in expected)


def test_given_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    assert found(spelling.spelling_variants(docs)) == plain_variants([tuple(r) for r in docs.collect()])


def test_as_the_sql(spark):
    connection = duckdb.connect()
    connection.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    expected = connection.execute(f"SELECT word, form, root, n, n_near, form_n FROM ({ORACLE_SQL['op11_spelling_variants']})").fetchall()
    assert found(QUERIES["op11_spelling_variants"](spark, "/root/testdata/sf0.001")) == set(expected)


def test_chains_ties_and_odd_rows(spark):
    # each word ten times as frequent as the one before; two equally frequent forms; very long words; clashing columns
    chain = ["qqqqqqqq", "qqqqqqqw", "qqqqqqww", "qqqqqwww"]
    text = " ".join(w for i, w in enumerate(chain) for _ in range(2 * 10**i))
    tie = " ".join(["mmmmmmma"] * 30 + ["mmmmmmmé"] * 30 + ["mmmmmmmz"] * 3)
    long = "ab" * 20_000
    rows = [(1, text), (2, tie), (3, None), (None, None), (4, ""), (5, " \n"), (6, f"{long} {long}x {long} {long}x {long}"), (7, "×÷ÀÖÿß" * 2)]
    rows += [(8, "repeated repeatad"), (8, "repeated repeatad")]
    df = spark.createDataFrame([(*r, "x", "y", 1, True) for r in rows], ODD_SCHEMA)
    got = found(spelling.spelling_variants(df))
    assert got == plain_variants(rows)
    assert max(len(r[0]) for r in got) > 20_000
    assert found(spelling.spelling_variants(df.where("false"))) == set()


def test_neighbourhoods_hold_every_reduced_neighbour():
    source = random.Random(5)
    words = ["".join(source.choice("abcdefgh") for _ in range(source.randrange(7, 12))) for _ in range(50)]
    keys = [set() for _ in words]
    for at, some in spelling.neighbourhoods(words):
        for i, k in zip(at.tolist(), some.tolist(), strict=True):
            keys[i].add(k)
    symbols = "abcdefgh"  # one letter of each symbol
    for i, w in enumerate(words):
        around = {w} | {w[:j] + w[j + 1 :] for j in range(len(w))}
        around |= {w[:j] + s + w[j + 1 :] for j in range(len(w)) for s in symbols if ord(s) % spelling.SYMBOLS > ord(w[j]) % spelling.SYMBOLS}
        assert keys[i] == set(spelling.reduced_keys(sorted(around)).tolist())
    assert len(np.unique(spelling.reduced_keys(sorted(set(words))))) == len(set(words))
