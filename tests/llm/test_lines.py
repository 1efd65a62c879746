"""Line dedup: recall against every pair, and rows without an id or with the same."""

from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from masterlint.llm import lines


def grams(line):
    return {line[i : i + 5] for i in range(len(line) - 4)} or {line}


def test_shingles_are_the_distinct_ones():
    source = random.Random(1)
    made = ["".join(source.choice("abé日🙂 ") for _ in range(source.randrange(1, 40))) for _ in range(300)] + ["abc", "abcd", "abcde", "x" * 1000]
    sets = list(lines._sets(made))
    assert [len(s) for s in sets] == [len(grams(x)) for x in made]
    for i in range(0, 300, 7):
        for j in range(0, 300, 11):
            a, b = grams(made[i]), grams(made[j])
            assert lines.similar(sets[i], sets[j]) == (100 * len(a & b) >= 80 * len(a | b))
    assert (lines.bands(made) == np.concatenate([lines.bands([x]) for x in made])).all()


@pytest.mark.parametrize("kind", ["short", "words", "unspaced", "hot opening"])
def test_recall_against_every_pair(spark, kind):
    source = random.Random(kind)
    letters = "abcdefghijkl " if kind != "unspaced" else "日昨今雨天気山行定予良降"
    opening = "".join(source.choice(letters) for _ in range(60)) if kind == "hot opening" else ""
    made = []
    for _ in range(250):
        x = "".join(source.choice(letters) for _ in range(source.randrange(*{"short": (10, 25)}.get(kind, (40, 120))))).strip() or "x"
        at = source.randrange(len(x))
        made += [opening + x, opening + x[:at] + source.choice(["", "z", "zz"]) + x[at + 1 :], opening + x + " end"]
    made = sorted({x.strip().lower() for x in made if x.strip()})
    docs = spark.createDataFrame(list(enumerate(made)), "doc_id bigint, text string")
    kept = {r.doc_id: r.kept_doc_id for r in lines.repeated_lines(docs).collect()}
    group = [kept.get(i, i) for i in range(len(made))]
    sets = [grams(x) for x in made]
    links = [(i, j) for i in range(len(made)) for j in range(i) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    found = sum(group[i] == group[j] for i, j in links)
    assert len(links) > 100 and found >= 0.95 * len(links)
    linked = {i for pair in links for i in pair}
    assert all(i in linked for i in kept)


def test_lines_of_rows_without_an_id_or_with_the_same(spark):
    line = "this line is repeated in many rows of the table"
    rows = [(1, line), (None, f"own first line\n{line}\nlast"), (None, f"{line}"), (None, "unrelated first line\nsecond"), (2, f"x\n{line}"), (2, "other\ntext")]
    rows += [(2, f"x\n{line}"), (3, None), (4, ""), (None, None)]
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id bigint, text string, line string, line_no int")
    removed = lines.repeated_lines(docs)
    texts = sorted((r.doc_id or 0, r.text or "") for r in lines.without_lines(docs, removed).collect())
    wanted = [(1, line), (0, "own first line\nlast"), (0, ""), (0, "unrelated first line\nsecond"), (2, "x"), (2, "other\ntext"), (2, "x"), (3, ""), (4, ""), (0, "")]
    assert texts == sorted(wanted)
    none = docs.where("false")
    assert lines.repeated_lines(none).count() == 0 and lines.without_lines(none, lines.repeated_lines(none)).count() == 0


def test_many_near_copies_of_one_line(spark, monkeypatch):
    monkeypatch.setattr(lines, "CHUNK", 50)
    monkeypatch.setattr(lines, "BLOCK", 40)
    base = " ".join(f"word{i}" for i in range(40))
    docs = spark.range(600).selectExpr("id AS doc_id", f"concat('{base}', ' ', id) AS text")
    docs = docs.unionByName(spark.range(300).selectExpr("id + 1000 AS doc_id", "concat(substr('" + base + "', 1, 120), ' other end ', repeat(chr(97 + id % 20), 20), id * 7919) AS text"))
    kept = {r.doc_id: r.kept_doc_id for r in lines.repeated_lines(docs).collect()}
    assert all(kept.get(i, i) == 0 for i in range(600))
    assert docs.where(F.col("doc_id") < 600).count() == 600


def test_links_of_a_block_are_a_forest():
    base = " ".join(f"word{i}" for i in range(40))
    other = " ".join(f"name{i}" for i in range(40))
    # every line has a root of its own, but for the last two, and links with all of its kind
    rows = [("k", 0, i, i, f"{base} {i}") for i in range(100)] + [("k", 0, 100 + i, 100 + i, f"{other} {i}") for i in range(50)]
    rows += [("k", 0, 150, 7, f"{base} x"), ("k", 0, 151, 7, f"{other} x"), ("k", 1, 0, 0, base), ("k", 1, 1, 0, f"{base} y")]
    batch = pa.RecordBatch.from_pylist([dict(zip(("key", "part", "line_id", "root", "line"), r, strict=True)) for r in rows])
    found = [(x["a"], x["b"]) for some in lines._block_links([batch]) for x in some.to_pylist()]
    group = {r[2]: r[3] for r in rows[:152]}
    assert len(found) == len(set(group.values())) - 1
    for a, b in found:
        one, two = group[a], group[b]
        assert one != two
        group = {i: one if g == two else g for i, g in group.items()}
    assert len(set(group.values())) == 1
