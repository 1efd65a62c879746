"""Substring dedup against a plain version."""

from __future__ import annotations

import random
import re

import pytest

from masterlint.llm import passages

SCHEMA = "doc_id bigint, text string"


def plain(rows):
    """Rows (doc_id, text) to removed spans per (doc_id, text), by comparing runs in order."""
    order = sorted(set(rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, removed = {}, {}
    units = {}
    for row in order:
        text = row[1] or ""
        units[row] = [(a, b, text[a:b].lower().split()) for a, b in passages.spans(text)]
    for row in order:
        us, gone = units[row], {}
        for k in range(len(us)):
            words, j = 0, k
            while j < len(us) and words < passages.LEAST_WORDS:
                words += len(us[j][2])
                j += 1
            if words < passages.LEAST_WORDS:
                continue
            first = seen.setdefault(tuple(tuple(u[2]) for u in us[k:j]), (row, k))
            if first != (row, k):
                for u in range(k, j):
                    gone.setdefault(u, []).append((k, j - 1, first))
        found, u = [], 0
        while u < len(us):
            if u not in gone:
                u += 1
                continue
            stop = u
            while stop + 1 < len(us) and stop + 1 in gone:
                stop += 1
            found.append((u, stop, min(gone[u])[2], max(gone[stop], key=lambda x: x[0])))
            u = stop + 1
        removed[row] = found
    out = {}
    for row, found in removed.items():
        spans = []
        for first, last, (kept, at), (k, j, (kept_last, at_last)) in found:
            start, stop = units[row][first][0], units[row][last][1]
            mine = [m for m in re.finditer(r"\S+", row[1]) if m.end() <= start]
            theirs = [m for m in re.finditer(r"\S+", kept[1]) if m.end() <= units[kept][at][0]]
            if first and at:
                low, klow = units[row][first - 1][0], units[kept][at - 1][0]
                n = common([m for m in mine if m.start() >= low][::-1], [m for m in theirs if m.start() >= klow][::-1])
                start = mine[-n].start() if n >= passages.LEAST_BORDER else start
            end = units[kept_last][at_last + j - k][1]
            behind = [m for m in re.finditer(r"\S+", row[1]) if m.start() >= stop]
            n = common(behind, [m for m in re.finditer(r"\S+", kept_last[1]) if m.start() >= end])
            stop = behind[n - 1].end() if n >= passages.LEAST_BORDER else stop
            spans.append((start, stop))
        out[row] = spans
    return out


def common(a, b):
    n = 0
    while n < min(len(a), len(b)) and a[n].group().lower() == b[n].group().lower():
        n += 1
    return n


def found(df):
    spans = {}
    for r in df.collect():
        spans.setdefault((r.doc_id, r.text_id), []).append((r.start, r.stop))
    return spans


def sentence(source, low=2, high=12):
    return " ".join(source.choice("abcdefgh") * source.randrange(1, 3) + str(source.randrange(40)) for _ in range(source.randrange(low, high))) + source.choice([".", "!", ".\n"])


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_as_a_plain_version(spark, seed):
    source = random.Random(seed)
    stock = [" ".join(sentence(source) for _ in range(12)) for _ in range(4)]
    rows = []
    for i in range(120):
        parts = [sentence(source) for _ in range(5)]
        if i % 2:
            passage = source.choice(stock).split(" ")
            at = source.randrange(5)
            parts.insert(source.randrange(6), " ".join(passage[at : at + source.randrange(10, 60)]))
        rows.append((i if i % 9 else None, " ".join(parts)))
    df = spark.createDataFrame(rows, SCHEMA)
    named = {(r.doc_id, r.text_id): (r.doc_id, r.text) for r in passages._named(df).collect()}
    got = {named[k]: sorted(v) for k, v in found(passages.removals(df)).items()}
    # texts without an id come in the order of their text_id
    ranked = sorted(named, key=lambda k: (k[0] is None, k[0] or 0, k[1]))
    expected = {k: v for k, v in plain([named[k] for k in ranked]).items() if v}
    with_id = {k: v for k, v in expected.items() if k[0] is not None}
    assert {k: v for k, v in got.items() if k[0] is not None} == with_id
    assert len(with_id) > 20


def test_passages_that_begin_inside_sentences(spark):
    source = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    for i in range(4, 57, 9):
        words[i] += "."
    passage = " ".join(words)
    rows = []
    for i in range(30):
        own = [f"{source.choice('xyz')}{i}q{k}" for k in range(40)]
        rows.append((i, f"{' '.join(own[:20])} {passage} {' '.join(own[20:])}. The end."))
    docs = spark.createDataFrame(rows, SCHEMA)
    texts = {r.doc_id: r.text for r in passages.cleaned(docs, passages.removals(docs)).collect()}
    assert texts[0] == rows[0][1]
    for i, text in rows[1:]:
        assert texts[i].split() == text.replace(passage, "").split()


def test_short_lines_and_sentences_stay(spark):
    rows = [(i, f"Home | About\nText of number{i} alone.\nLicensed under CC BY-NC 4.0.\nAll rights reserved.") for i in range(20)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert passages.removals(docs).count() == 0


def test_unspaced_passages_go(spark):
    passage = "昨日は雨が降っていました。今日はとても良い天気です。明日は山へ行く予定です。"
    rows = [(1, f"Home\nOne. Two of it.\n始まり。{passage}"), (2, f"Home\nTwo of it. Three.\n{passage}別の終わり。")]
    docs = spark.createDataFrame(rows, SCHEMA)
    texts = {r.doc_id: r.text for r in passages.cleaned(docs, passages.removals(docs)).collect()}
    assert texts[1] == rows[0][1] and texts[2].split("\n") == ["Home", "Two of it. Three.", "別の終わり。"]


def test_rows_without_an_id_or_with_the_same_lose_only_their_own(spark):
    line = " ".join(f"word{i}" for i in range(20)) + "."
    other = "XXXXX XXXXXXXX secret text of another row stays."
    rows = [(1, line), (None, f"{line} Own end."), (None, other), (2, f"Begin.\n{line}"), (2, other), (2, f"Begin.\n{line}"), (3, None), (4, ""), (None, None)]
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA + ", start int, kept string")
    removed = passages.removals(docs)
    assert sorted((r.doc_id or 0, r.start, r.stop, r.kept_doc_id) for r in removed.collect()) == [(0, 0, len(line), 1), (2, 7, 7 + len(line), 1)]
    texts = sorted((r.doc_id or 0, r.text or "") for r in passages.cleaned(docs, removed).collect())
    assert texts == sorted([(1, line), (0, " Own end."), (0, other), (2, "Begin.\n"), (2, other), (2, "Begin.\n"), (3, ""), (4, ""), (0, "")])
    none = docs.where("false")
    assert passages.removals(none).count() == 0 and passages.cleaned(none, passages.removals(none)).count() == 0


def test_long_texts(spark):
    source = random.Random(9)
    long = " ".join(sentence(source) for _ in range(20_000))
    docs = spark.createDataFrame([(1, long), (2, "Own start. " + long)], SCHEMA)
    rows = passages.removals(docs).where("doc_id = 2").collect()
    assert [(r.start, r.stop) for r in rows] == [(11, 11 + len(long.rstrip()))]
