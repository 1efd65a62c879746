"""Leaks against brute force over given documents, very long items, and benchmarks of many blocks."""

from __future__ import annotations

import random
import subprocess
import sys
import textwrap
from pathlib import Path

import pytest

from masterlint.llm import decontamination as d

ROOT = Path(__file__).resolve().parents[2]
SCHEMA = "doc_id bigint, text string, score string"
ITEMS = "item_id bigint, text string, score string"


def fewest(item: str, text: str) -> int:
    row = [0] * (len(text) + 1)
    for i, c in enumerate(item, 1):
        last, row[0] = row[0], i
        for j, x in enumerate(text, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (c != x))
    return min(row)


def words(source: random.Random, n: int) -> str:
    return " ".join("".join(source.choice("etaoinshr") for _ in range(source.randrange(2, 8))) for _ in range(n))


def given(seed: int = 9):
    source = random.Random(seed)
    bench = [(i, words(source, source.randrange(8, 22)), None) for i in range(12)] + [(12, "", None), (13, None, "x"), (None, words(source, 15), None)]
    bench += [bench[0]]
    docs = []
    for n in range(160):
        item = d.normal(bench[n % 12][1])
        # more edits than allowed as well
        copy = d._edited(item, source.randrange(0, 2 * d.edits_allowed(len(item)) + 2), source)
        docs.append((n, f"{words(source, 6)} {copy} {words(source, source.randrange(0, 9))}", "s"))
    docs += [(200, None, None), (201, "", None), (202, "x", None), (None, d.normal(bench[14][1]).upper(), None), docs[0], docs[0]]
    return bench, docs


@pytest.mark.parametrize("item_chars", [d.ITEM_CHARS, 300])
@pytest.mark.parametrize("section", [d.SECTION, 40])
def test_inexact_leaks_by_brute_force(spark, monkeypatch, item_chars, section):
    monkeypatch.setattr(d, "ITEM_CHARS", item_chars)
    monkeypatch.setattr(d, "SECTION", section)
    bench, docs = given()
    wanted = {}
    for doc_id, text, _ in docs:
        for item_id, item, _ in bench:
            item = d.normal(item)
            least = fewest(item, d.normal(text))
            if item and least <= d.edits_allowed(len(item)):
                wanted[doc_id, item_id] = least
    table, items = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(bench, ITEMS)
    found = {(r.doc_id, r.item_id): r.edits for r in d.leaks(table, items).collect()}
    assert set(found) <= set(wanted)
    assert len(found) >= 0.97 * len(wanted) > 60
    assert sum(found[k] == wanted[k] for k in found) == len(found)
    kept = d.without_leaks(table, items)
    dirty = {doc_id for doc_id, _ in found}
    assert kept.columns == table.columns
    assert sorted(map(str, kept.collect())) == sorted(map(str, table.where("NOT coalesce(doc_id, -1) IN (%s)" % ",".join(str(-1 if i is None else i) for i in dirty)).collect()))


def test_empty_tables(spark):
    bench, docs = given()
    table, items = spark.createDataFrame(docs, SCHEMA), spark.createDataFrame(bench, ITEMS)
    assert d.leaks(table.where("false"), items).count() == d.leaks(table, items.where("text IS NULL")).count() == 0
    assert d.without_leaks(table, items.where("false")).count() == len(docs)


def test_sections_share_the_edits():
    for size in (1, 19, 2048, 2049, 9000, 100_000):
        parts = d.sections("x" * size)
        assert [a for a, _, _ in parts[1:]] == [b for _, b, _ in parts[:-1]] and (parts[0][0], parts[-1][1]) == (0, size)
        assert all(b - a <= d.SECTION for a, b, _ in parts)
        # more than its share in every section is more than allowed
        assert sum(edits + 1 for *_, edits in parts) > d.edits_allowed(size)


def test_an_item_of_100000_characters():
    """In a process of its own, whose memory is looked at."""
    code = """
        import random, resource
        from masterlint.llm import decontamination as d
        source = random.Random(4)
        word = lambda: "".join(source.choice("etaoinshr") for _ in range(source.randrange(2, 8)))
        item = " ".join(word() for _ in range(20_000))[:100_000].strip()
        short = [" ".join(word() for _ in range(40)) for _ in range(50)]
        items = [("long", item)] + list(enumerate(short))
        before = resource.getrusage(resource.RUSAGE_SELF).ru_maxrss
        finder = d.Finder(items, repeats=d.repetitions([x for _, x in items], d.EDIT_RATE, d.RECALL))
        copy = d._edited(item, 4_000, source)
        texts = ["a b c " + copy + " d", short[3] + " e", "nothing of all this", item[:30_000]]
        found = finder.find(texts)
        assert [sorted(x) for x in found] == [[0], [4], [], []], found
        assert 0 < found[0][0][0] <= 4_000 and abs(found[0][0][2] - found[0][0][1] - len(d.normal(copy))) < 50
        print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss - before)
    """
    done = subprocess.run([sys.executable, "-c", textwrap.dedent(code)], cwd=ROOT, capture_output=True, text=True, timeout=200)
    assert done.returncode == 0, done.stderr
    assert int(done.stdout) < 200_000  # KB
