"""Predictions against a plain version letter by letter, and languages of one other script."""

from __future__ import annotations

import math
import random
from collections import Counter, defaultdict

import numpy as np
from pyspark.sql import functions as F

from masterlint.llm import language

CYRILLIC = "абвгдежзийклмнопрстуфхцчшщъыьэюя"
GREEK = "αβγδεζηθικλμνξοπρσςτυφχψω"
SCHEMA = "doc_id bigint, text string, lang string"


def vector(letter: str) -> list[int]:
    symbol = 0 if not letter.isalpha() else ord(letter) - 96 if "a" <= letter <= "z" else language.SYMBOLS + ord(letter)
    return language.letter_vectors(np.array([symbol]))[0].tolist()


def plain_bundle(text: str) -> list[int]:
    """Sum of the bound vectors, letter by letter; runs of other characters count as one blank."""
    marks = "".join(c if c.isalpha() else " " for c in text.lower())
    padded = " " + " ".join(marks.split()) + " "
    if not padded.strip():
        return [0] * language.DIMENSIONS
    total = [0] * language.DIMENSIONS
    for a, b, c in zip(padded, padded[1:], padded[2:], strict=False):
        x, y, z = vector(a), vector(b), vector(c)
        for i in range(language.DIMENSIONS):
            total[i] += x[i - 2] * y[i - 1] * z[i]
    return total


def cosine(x, y) -> float:
    norm = math.sqrt(sum(a * a for a in x)) * math.sqrt(sum(b * b for b in y))
    return sum(a * b for a, b in zip(x, y, strict=True)) / norm if norm else 0.0


def invented(letters: str, n: int, seed: int) -> list[str]:
    """Texts of a language with words of its own over the given letters."""
    source = random.Random(seed)
    syllables = ["".join(source.sample(letters, source.choice((2, 3)))) for _ in range(25)]
    words = ["".join(source.choice(syllables) for _ in range(source.randrange(1, 4))) for _ in range(80)]
    return [" ".join(source.choice(words) for _ in range(12)) for _ in range(n)]


def rows(n: int = 60):
    texts = [(t, f"{name}{k}") for name, letters in (("cyrillic", CYRILLIC), ("greek", GREEK), ("latin", "abcdeéèßñøřłaeiou")) for k in range(3) for t in invented(letters, n, k)]
    return [(i, t, lang) for i, (t, lang) in enumerate(texts)]


def test_languages_of_one_script_are_told_apart(spark):
    docs = spark.createDataFrame(rows(), SCHEMA)
    taught = docs.where("doc_id % 3 <> 1")
    found = language.identify(docs.where("doc_id % 3 = 1"), language.learn(taught), ["lang"]).collect()
    assert sum(r.lang == r.lang_pred for r in found) == len(found) == 180


def test_predictions_by_hand(spark):
    given = rows(2)[::2]
    given += [(100, None, "greek0"), (101, "12 .", "greek0"), (102, "A  b", None), (103, "", None), (104, "Ünï x日本語 mit", "latin0"), (105, "日", "han"), (105, "日", "han")]
    docs = spark.createDataFrame(given, SCHEMA)
    learned = language.learn(docs)
    prototypes: dict[str, list[int]] = defaultdict(lambda: [0] * language.DIMENSIONS)
    bundles = {t: plain_bundle(t or "") for _, t, _ in given}
    for _, t, lang in given:
        if lang is not None and any(c.isalpha() for c in t or ""):
            prototypes[lang] = [a + b for a, b in zip(prototypes[lang], bundles[t], strict=True)]
    assert {k: v.tolist() for k, v in learned.items()} == dict(prototypes)
    found = Counter(tuple(r) for r in language.identify(docs, learned, ["doc_id"]).withColumn("score", F.round("score", 4)).collect())
    wanted: Counter = Counter()
    for i, t, _ in given:
        cosines = {lang: cosine(bundles[t], p) for lang, p in prototypes.items()}
        best = max(sorted(cosines), key=cosines.__getitem__)
        wanted[(i, best, round(max(0.0, cosines[best]), 4)) if any(c.isalpha() for c in t or "") else (i, "und", 0.0)] += 1
    assert {(i, lang) for i, lang, _ in found} == {(i, lang) for i, lang, _ in wanted} and sum(found.values()) == len(given)
    scores = {i: s for i, _, s in wanted}
    assert all(abs(scores[i] - s) < 2e-4 for i, _, s in found)


def test_counts_of_many_millions_stay_exact():
    ids, _ = language.trigrams("abc é")
    counts = np.arange(1, len(ids) + 1) * (1 << 26)
    single = [language.bundle(ids[i : i + 1], counts[i : i + 1]) for i in range(len(ids))]
    assert (language.bundle(ids, counts) == sum(single)).all()
