"""Toxicity: automata against plain edit distances, held-out labels, quotations and odd tables."""

from __future__ import annotations

import random

import pytest

from masterlint.llm import toxicity
from masterlint.llm.queries import toxic_documents


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (x != y)))
    return row[-1]


def plain_edits(terms, word):
    found = []
    for term in terms:
        letters = term.removesuffix(toxicity.END)
        extra = 0 if term.endswith(toxicity.END) else 2
        allowed = sum(len(letters) >= least + extra for least in toxicity.EDITS)
        tails = [word] if term.endswith(toxicity.END) else [word[:i] for i in range(len(word) + 1)]
        d = min(distance(letters, t) for t in tails)
        found += [d] * (d <= allowed)
    return min(found, default=-1)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_automata_agree_with_edit_distances(seed):
    source = random.Random(seed)
    word = lambda low, high: "".join(source.choice("abcé") for _ in range(source.randrange(low, high)))
    terms = {word(3, 12) + source.choice(["", toxicity.END]) for _ in range(12)}
    lexicon = toxicity.Lexicon(sorted(terms))
    words = [word(1, 14) for _ in range(300)]
    for term in terms:
        w = term.removesuffix(toxicity.END)
        for _ in range(20):
            at = source.randrange(len(w))
            words.append(w[:at] + source.choice(["", "a", "bb", w[at]]) + w[at + 1 :] + source.choice(["", "", "cab"]))
    assert [lexicon.edits(w) for w in words] == [plain_edits(terms, w) for w in words]


def test_held_out_labels(spark):
    docs = toxic_documents(spark, "/root/testdata/sf0.01")
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    joined = docs.join(labels, "doc_id").where("held_out").collect()
    assert docs.count() == 1000
    right = sum(r.predicted == r.toxic for r in joined)
    assert right >= 0.97 * len(joined)
    caught = [r.predicted for r in joined if r.toxic == 1]
    assert sum(caught) >= 0.9 * len(caught)
    assert docs.where("score < 0 OR score > 1 OR predicted <> CAST(score >= 0.5 AS int)").count() == 0


def corpus(source, n):
    fill = ["zu", "lag", "mirt", "ost", "fenk", "dra", "polt", "ui", "sem", "kra", "voro", "nim"]
    bad = ["grumpfel", "schnorzig"]
    docs, labels = [], []
    for i in range(n):
        words = [source.choice(fill) + source.choice(fill) for _ in range(60)]
        toxic = i % 5 == 0
        if toxic:
            for _ in range(3):
                words.insert(source.randrange(len(words)), source.choice(bad))
        elif i % 5 == 1:
            at = source.randrange(len(words))
            words[at:at] = ["said", '"' + source.choice(bad) + '"']
        docs.append((i, " ".join(words)))
        labels.append((i, int(toxic)))
    return docs, labels


def test_misspellings_quotations_and_copies(spark):
    docs, labels = corpus(random.Random(7), 400)
    # a toxic document in many copies teaches none of its other words
    docs += [(1000 + i, "grumpfel einmalig seltsames wort") for i in range(100)]
    labels += [(1000 + i, 1) for i in range(100)]
    df, marks = spark.createDataFrame(docs, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    model = toxicity.learn(df, marks)
    assert model.terms == ("grumpfel$", "schnorzig$")
    tried = {
        "lag mirt ost du grumpfel polt grumpfel schnorzig": 1,
        "lag mirt ost grumfpel polt zu grompfel schnorrzig": 1,
        'lag mirt ost said "grumpfel" polt dra': 0,
        "lag mirt ost einmalig seltsames wort": 0,
        "": 0,
        None: 0,
    }
    rows = spark.createDataFrame(list(enumerate(tried)), "doc_id bigint, text string")
    got = {r.doc_id: r.predicted for r in toxicity.score(rows, model, ["doc_id"]).collect()}
    # letters swapped are two edits; the others are one
    assert [got[i] for i in range(len(tried))] == list(tried.values())


def test_odd_tables(spark):
    rows = [(None, None, "x", 1), (1, None, "x", 2), (2, "", None, 3), (3, "du Idiot " * 50_000, "y", 4), (3, "du Idiot " * 50_000, "y", 4)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, toxic string, features int")
    labels = spark.createDataFrame([(1, None), (None, 1), (3, 1), (3, 0), (9, 1)], "doc_id bigint, toxic int")
    for table, marks in ((docs, labels), (docs.where("false"), labels), (docs, labels.where("false"))):
        model = toxicity.learn(table, marks)
        scored = toxicity.score(docs, model, ["doc_id", "toxic", "features"])
        assert scored.columns == ["doc_id", "toxic", "features", "score", "predicted"]
        assert scored.count() == 5 and scored.where("score BETWEEN 0 AND 1").count() == 5
    assert toxicity.score(docs.where("false"), toxicity.Model(()), ["doc_id"]).count() == 0
