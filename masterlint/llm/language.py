"""Language identification by hyperdimensional profiles.

Every letter of any script has a random vector of +1 and -1 of its own. A trigram's vector is the product of its letters' vectors, each
rotated by its place; a text's vector is the sum over its trigrams, and a language's prototype the sum over its
texts. A text gets the language whose prototype has the largest cosine with it.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from masterlint.llm.common import pieces

UNKNOWN = "und"
DIMENSIONS = 512
SEED = 20240
#: Symbols: 0 for what is no letter, 1 to 26 for a to z, and from SYMBOLS on every other letter by its code point.
#: Trigrams of the first ones have a table of vectors, those of others are made when they are met.
SYMBOLS = 27
LETTERS = SYMBOLS + sys.maxunicode + 1
#: Vectors that are added up at once.
AT_ONCE = 2048
#: Languages whose trigram counts a task holds at once.
LANGUAGES_AT_ONCE = 64


@lru_cache(1)
def symbols() -> np.ndarray:
    table = np.zeros(sys.maxunicode + 1, dtype=np.uint32)
    letters = np.array([c for c in range(sys.maxunicode + 1) if chr(c).isalpha()])
    table[letters] = SYMBOLS + letters
    table[ord("a") : ord("z") + 1] = np.arange(1, 27)
    return table


@lru_cache(1)
def common_letters() -> np.ndarray:
    return np.random.default_rng(SEED).choice(np.array([-1, 1], dtype=np.int8), (SYMBOLS, DIMENSIONS))


def letter_vectors(found: np.ndarray) -> np.ndarray:
    """The vectors of symbols, a row each. Those of other letters than a to z are the bits of seeded hashes."""
    words = found.astype(np.uint64)[:, None] * np.uint64(DIMENSIONS // 64) + np.arange(DIMENSIONS // 64, dtype=np.uint64)
    words = (words + np.uint64(SEED)) * np.uint64(0x9E3779B97F4A7C15)
    words = (words ^ (words >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    words = (words ^ (words >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    words = (words ^ (words >> np.uint64(31))).astype("<u8")
    vectors = np.unpackbits(words.view(np.uint8), axis=1).astype(np.int8) * np.int8(2) - np.int8(1)
    common = found < SYMBOLS
    vectors[common] = common_letters()[found[common]]
    return vectors


def bound(first: np.ndarray, second: np.ndarray, third: np.ndarray) -> np.ndarray:
    """The vectors of trigrams, given those of their letters."""
    return np.roll(first, 2, axis=-1) * np.roll(second, 1, axis=-1) * third


@lru_cache(1)
def trigram_vectors() -> np.ndarray:
    letters = common_letters()
    return bound(letters[:, None, None], letters[None, :, None], letters[None, None]).reshape(SYMBOLS**3, DIMENSIONS)


def split(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The three symbols of trigrams, and which trigrams the table has."""
    first, second, third = ids // (LETTERS * LETTERS), ids // LETTERS % LETTERS, ids % LETTERS
    return first, second, third, np.maximum(np.maximum(first, second), third) < SYMBOLS


def trigrams(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct trigrams of a text, as numbers, and how often each occurs; none for a text without a letter."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    found = symbols()[codes]
    if not found.any():
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    found = np.concatenate(([0], found, [0])).astype(np.int64)
    found = found[np.concatenate(([True], (found[1:] > 0) | (found[:-1] > 0)))]
    ids = (found[:-2] * LETTERS + found[1:-1]) * LETTERS + found[2:]
    return np.unique(ids, return_counts=True)


def _sum(vectors: Callable[[slice], np.ndarray], counts: np.ndarray) -> np.ndarray:
    """Whole numbers as floating point, which has them exactly up to 2**53."""
    total = np.zeros(DIMENSIONS)
    for at in range(0, len(counts), AT_ONCE):
        part = slice(at, at + AT_ONCE)
        # in single precision as long as the sums are exact there
        kind = np.float32 if counts[part].sum() < 1 << 24 else np.float64
        total += counts[part].astype(kind) @ vectors(part).astype(kind)
    return total


def bundle(ids: np.ndarray, counts: np.ndarray) -> np.ndarray:
    first, second, third, common = split(ids)
    table, small = trigram_vectors(), (first * SYMBOLS + second) * SYMBOLS + third
    total = _sum(lambda part: table[small[common][part]], counts[common])
    if common.all():
        return total
    symbols_of = [x[~common] for x in (first, second, third)]
    return total + _sum(lambda part: bound(*[letter_vectors(x[part]) for x in symbols_of]), counts[~common])


def _profiles(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One vector of whole numbers per language and task: sums don't depend on their order."""
    totals: dict[str, np.ndarray] = {}
    others: dict[str, np.ndarray] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, total in totals.items():
            ids = np.flatnonzero(total)
            profile = others[lang] + _sum(lambda part: trigram_vectors()[ids[part]], total[ids])
            yield pa.RecordBatch.from_pydict({"lang": [lang], "profile": [profile.astype(np.int64).tolist()]})
        totals.clear()
        others.clear()

    for batch in pieces(batches):
        for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            ids, counts = trigrams(text)
            if not len(ids):
                continue
            if lang not in totals:
                if len(totals) >= LANGUAGES_AT_ONCE:
                    yield from flush()
                totals[lang], others[lang] = np.zeros(SYMBOLS**3, dtype=np.int64), np.zeros(DIMENSIONS)
            first, second, third, common = split(ids)
            totals[lang][((first * SYMBOLS + second) * SYMBOLS + third)[common]] += counts[common]
            if not common.all():
                others[lang] += bundle(ids[~common], counts[~common])
    yield from flush()


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """Prototypes of all languages in docs (text, lang): one vector of DIMENSIONS numbers per language.

    The only thing that reaches the driver; its size is that of the label set, not of the data. Rows without
    a language, or whose text has no letter, teach nothing.
    """
    parts = docs.select("text", "lang").where("lang IS NOT NULL").mapInArrow(_profiles, "lang string, profile array<bigint>")
    sums = parts.select("lang", F.posexplode("profile").alias("at", "x")).groupBy("lang", "at").agg(F.sum("x").alias("x"))
    rows = sums.groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("at", "x"))).alias("p")).collect()
    return {row.lang: np.array([x.x for x in row.p], dtype=np.float64) for row in sorted(rows, key=lambda r: r.lang)}


def predictor(prototypes: dict[str, np.ndarray]) -> Callable[[str | None], tuple[str, float]]:
    """Maps a text to a language and its cosine, cut at 0. Of equal languages the first by name wins."""
    names = list(prototypes)
    matrix = np.array([v / (np.linalg.norm(v) or 1.0) for v in prototypes.values()]).reshape(-1, DIMENSIONS)
    matrix = matrix.astype(np.float32)

    def predict(text: str | None) -> tuple[str, float]:
        ids, counts = trigrams(text)
        if not len(ids) or not names:
            return UNKNOWN, 0.0
        vector = bundle(ids, counts).astype(np.float32)
        cosines = matrix @ (vector / (np.linalg.norm(vector) or 1.0))
        best = int(np.argmax(cosines))
        return names[best], min(1.0, max(0.0, round(float(cosines[best]), 6)))

    return predict


def identify(docs: DataFrame, prototypes: dict[str, np.ndarray], keep: list[str]) -> DataFrame:
    """Columns keep of every row of docs, with lang_pred and score in [0, 1].

    A null text or one without a letter gets 'und' and 0.0; so does every text when nothing was learned.
    Repeated rows are answered alike. Whole texts count, whatever their length. docs may have any other
    columns; keep must not name lang_pred, score or text twice.
    """

    def answers(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        predict = predictor(prototypes)
        for batch in pieces(batches):
            found = [predict(text) for text in batch.column(at).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(keep)], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())],
                names=[*keep, "lang_pred", "score"],
            )

    # a text that is kept travels once
    at = keep.index("text") if "text" in keep else len(keep)
    rows = docs.select(*keep, *[F.col("text").alias("read_text")] * ("text" not in keep))
    answer = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    return rows.mapInArrow(answers, T.StructType([*rows.schema.fields[: len(keep)], *answer]))
