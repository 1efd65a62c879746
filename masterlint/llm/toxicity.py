"""Toxicity by a learned lexicon, misspellings included.

Terms are learned from labelled documents: words, or beginnings of words, that stand in toxic documents and in
many different contexts, so that copies of one document teach nothing by their number. The terms form a trie.
Levenshtein automata run along it: a state is a set of trie nodes with the edits spent on the way there, made
once for all words (a lazily built deterministic automaton), so that most words leave it after a few letters. A
hit counts by how it is met: exactly or misspelled, and by its window of words, as abuse or as a quotation. A
logistic model weighs the four counts.
"""

from __future__ import annotations

import math
import re
import zlib
from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from itertools import islice, takewhile

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import pieces, written

#: Labelled documents to learn from, about; if there are more, those of the smallest hashes of doc_id.
SAMPLE = 20_000
#: Letters of the shortest and the longest beginning of a word that may be a term.
STEM = (4, 8)
#: A term stands in so many different contexts of toxic documents, and surely in more toxic than other ones.
LEAST_CONTEXTS = 8
LEAST_SHARE, SURENESS = 0.5, 3.0
MOST_TERMS = 2_000
#: Letters of a term from which on one edit, and two, are still the term. Beginnings need two letters more.
EDITS = (5, 9)
#: Behind a term that is a whole word.
END = "$"
#: Words on either side of a hit that tell a quotation from abuse.
WINDOW = 6
WORD = re.compile(r"[^\W_]+")
QUOTES = "\"'“”„‚‘’«»‹›「」『』"
#: Cues of an English quotation or report, and of an address. Parameters; the model learns what they are worth.
REPORTS = frozenset("said says say called calls call word words term terms quote quoted wrote writes meaning means mean defined insult slur".split())
ADDRESSES = frozenset("you your yours youre u ur he she they him her them".split())
#: Weights before any label is seen: of plain exact, quoted exact, plain misspelled, quoted misspelled hits, and none.
PRIOR = np.array([4.5, 0.5, 3.5, 0.25, -3.0])
PRIOR_STRENGTH = 1.0
#: Words whose hits a worker remembers: a bound on memory only.
REMEMBERED = 500_000


class Lexicon:
    """Terms as a trie, and the automata along it. A term that does not end in END is a beginning of words."""

    def __init__(self, terms: Iterable[str]):
        self.children: list[dict[str, int]] = [{}]
        self.whole: list[int] = [-1]  # edits that a word ending here may have, -1 for no term
        self.stem: list[int] = [-1]
        self.below: list[int] = [0]  # the most edits of any term below
        for term in terms:
            self._add(term)
        self.starts = self._closed({0: 0})
        self.ids: dict[tuple, int] = {}
        self.states: list[tuple] = []
        self.moves: list[dict[str, int]] = []
        self.ends: list[int] = []
        self.begun: list[int] = []
        self.first = self._state(self.starts)

    def _add(self, term: str) -> None:
        is_word = term.endswith(END)
        letters = term[:-1] if is_word else term
        allowed = sum(len(letters) >= least + (0 if is_word else 2) for least in EDITS)
        node = 0
        for letter in letters:
            self.below[node] = max(self.below[node], allowed)
            if letter not in self.children[node]:
                self.children[node][letter] = len(self.children)
                self.children.append({})
                self.whole.append(-1)
                self.stem.append(-1)
                self.below.append(0)
            node = self.children[node][letter]
        self.below[node] = max(self.below[node], allowed)
        kind = self.whole if is_word else self.stem
        kind[node] = allowed

    def _closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """nodes and those reached by leaving out letters of a term, with the fewest edits of each."""
        left = list(nodes)
        while left:
            node = left.pop()
            for child in self.children[node].values():
                edits = nodes[node] + 1
                if edits <= self.below[child] and edits < nodes.get(child, 99):
                    nodes[child] = edits
                    left.append(child)
        return nodes

    def _state(self, nodes: dict[int, int]) -> int:
        key = tuple(sorted(nodes.items()))
        if key not in self.ids:
            self.ids[key] = len(self.states)
            self.states.append(key)
            self.moves.append({})
            self.ends.append(min((e for n, e in key if e <= self.whole[n]), default=-1))
            self.begun.append(min((e for n, e in key if e <= self.stem[n]), default=-1))
        return self.ids[key]

    def _move(self, state: int, letter: str) -> int:
        """The state behind a letter, -1 if no term can be met any more."""
        reached: dict[int, int] = {}
        for node, edits in self.states[state]:
            for child_letter, child in self.children[node].items():
                spent = edits + (child_letter != letter)
                if spent <= max(self.below[child], 0) and spent < reached.get(child, 99):
                    reached[child] = spent
            if edits + 1 <= self.below[node] and edits + 1 < reached.get(node, 99):
                reached[node] = edits + 1
        to = self._state(self._closed(reached)) if reached else -1
        self.moves[state][letter] = to
        return to

    def edits(self, word: str) -> int:
        """The fewest edits by which the lower-case word is a term or begins with one, -1 if it isn't."""
        state, best = self.first, 99
        for letter in word:
            state = self.moves[state].get(letter, -2) if letter in self.moves[state] else self._move(state, letter)
            if state < 0:
                return best if best < 99 else -1
            if 0 <= self.begun[state] < best:
                best = self.begun[state]
        if 0 <= self.ends[state] < best:
            best = self.ends[state]
        return best if best < 99 else -1


@dataclass(frozen=True)
class Model:
    """terms, words that are near a term and yet no misspelling of it, and the weights of the features."""

    terms: tuple[str, ...]
    known: frozenset[str] = frozenset()
    weights: tuple[float, ...] = field(default=tuple(PRIOR.tolist()))


@lru_cache(4)
def _matcher(terms: tuple[str, ...], known: frozenset[str]) -> Matcher:
    return Matcher(terms, known)


class Matcher:
    """Finds the hits of texts, remembering what it knows of words."""

    def __init__(self, terms: tuple[str, ...], known: frozenset[str]):
        self.lexicon, self.known = Lexicon(terms), known
        self.hits: dict[str, int] = {}

    def edits(self, word: str) -> int:
        found = self.hits.get(word)
        if found is None:
            if len(self.hits) >= REMEMBERED:
                self.hits = {}
            found = self.lexicon.edits(word)
            self.hits[word] = found = -1 if found > 0 and word in self.known else found
        return found

    def features(self, text: str | None) -> list[float]:
        """Logarithms of the numbers of exact and misspelled hits, each plain and quoted; and one for the bias."""
        counts = [0, 0, 0, 0]
        lowered = (text or "").lower()
        words = WORD.findall(lowered)
        edits = self.edits
        if any(edits(word) >= 0 for word in set(words)):
            places = [m.span() for m in WORD.finditer(lowered)]
            for at, word in enumerate(words):
                if (spent := edits(word)) >= 0:
                    counts[2 * (spent > 0) + self._quoted(lowered, words, places, at)] += 1
        return [*map(math.log1p, counts), 1.0]

    @staticmethod
    def _quoted(text: str, words: list[str], places: list[tuple[int, int]], at: int) -> bool:
        """Whether the window around a hit speaks for a quotation: marks around it and words of report count for
        one, words of address against one."""
        low, high = max(0, at - WINDOW), min(len(words), at + WINDOW + 1)
        start, stop = places[at]
        before, behind = text[places[low][0] : start], text[stop : places[high - 1][1] + 1]
        near = words[low:at] + words[at + 1 : high]
        score = 2 * (any(q in before for q in QUOTES) and any(q in behind for q in QUOTES))
        score += any(w in REPORTS for w in near) - any(w in ADDRESSES for w in near)
        return score > 0


def _sample(docs: DataFrame, labels: DataFrame, at_most: int) -> DataFrame:
    """text and toxic of about at_most labelled documents at most, written once.

    A threshold on a hash of doc_id picks them, before the join, so that nothing else of docs is shuffled.
    """
    labelled = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    share = min(1.0, at_most / max(labelled.count(), 1))
    chosen = f"xxhash64(doc_id, 'toxicity') BETWEEN {-(1 << 63)} AND {int(share * (1 << 64)) - (1 << 63) - 1}"
    some = written(labelled.where(chosen), "toxicity-labels")
    return written(docs.select("doc_id", "text").where(chosen).join(some, "doc_id").select("text", "toxic"), "toxicity-sample")


def _word_counts(sample: DataFrame) -> DataFrame:
    """word, docs, toxic_docs and contexts (a bitmap of the contexts in toxic documents) of each word."""

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, 1024):
            counts: dict[str, list[int]] = {}
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                words = WORD.findall((text or "").lower())
                met: set[str] = set()
                for at, word in enumerate(words):
                    if len(word) < STEM[0] - 1:
                        continue
                    entry = counts.setdefault(word, [0, 0, 0])
                    if word not in met:
                        met.add(word)
                        entry[0] += 1
                        entry[1] += toxic > 0
                    if toxic > 0:
                        context = f"{words[at - 1] if at else ''} {words[at + 1] if at + 1 < len(words) else ''}"
                        entry[2] |= 1 << (_hashed(context) & 63)
            columns = list(zip(*counts.values(), strict=True)) or [[], [], []]
            bits = np.array(columns[2], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(counts), pa.string()), pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int64()), pa.array(bits)],
                names=["word", "docs", "toxic_docs", "contexts"],
            )

    rows = sample.select("text", F.col("toxic").cast("int")).mapInArrow(counted, "word string, docs bigint, toxic_docs bigint, contexts bigint")
    return rows.groupBy("word").agg(F.sum("docs").alias("docs"), F.sum("toxic_docs").alias("toxic_docs"), F.bit_or("contexts").alias("contexts"))


def _hashed(text: str) -> int:
    """A hash that is the same in all workers."""
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def _terms(words: DataFrame) -> tuple[str, ...]:
    """The terms among words and their beginnings, at most MOST_TERMS, the most frequent ones first.

    The driver gets the nodes that may be terms: those surely in more toxic documents than others, of which
    the longest that covers as much as its own beginnings is taken.
    """
    low, high = STEM
    stems = f"transform(sequence({low}, least({high}, char_length(word))), k -> substr(word, 1, k))"
    nodes = words.selectExpr(f"explode(IF(char_length(word) < {low}, array(concat(word, '{END}')), concat({stems}, array(concat(word, '{END}'))))) AS node", "docs", "toxic_docs", "contexts")
    summed = nodes.groupBy("node").agg(F.sum("docs").alias("n"), F.sum("toxic_docs").alias("t"), F.expr("bit_count(bit_or(contexts))").alias("contexts"))
    # the lower end of Wilson's interval
    z = SURENESS**2
    sure = f"(t / n + {z / 2} / n - {SURENESS} * sqrt(t / n * (1 - t / n) / n + {z / 4} / n / n)) / (1 + {z} / n) >= {LEAST_SHARE}"
    few = summed.where(f"contexts >= {LEAST_CONTEXTS} AND {sure}").orderBy(F.desc("t"), "node").limit(8 * MOST_TERMS)
    found = {r.node: r.t for r in few.collect()}
    ordered = sorted(found)
    chosen: list[str] = []
    for node in sorted(found, key=lambda x: (-found[x], x)):
        longer = takewhile(lambda x, node=node: x.startswith(node), islice(ordered, bisect_right(ordered, node), None))
        # a beginning that says no more than a longer one is none
        if not any(10 * found[x] >= 9 * found[node] for x in longer) and not any(node.startswith(term) for term in chosen):
            chosen.append(node)
    return tuple(sorted(chosen[:MOST_TERMS]))


def _known(words: DataFrame, terms: tuple[str, ...]) -> frozenset[str]:
    """Words near a term that the sample shows to be words of their own: not surely toxic, in two documents or more."""

    def near(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lexicon = _matcher(terms, frozenset()).lexicon
        for batch in batches:
            yield batch.filter(pa.array([lexicon.edits(w) > 0 for w in batch.column(0).to_pylist()], pa.bool_()))

    rows = words.select("word", "docs", "toxic_docs").where("docs > 1 AND 2 * toxic_docs < docs + 1")
    return frozenset(r.word for r in rows.mapInArrow(near, rows.schema).collect())


def learn(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """The model of docs (doc_id, text) with labels (doc_id, toxic).

    It is fitted on about sample labelled documents at most, all there are if fewer; their words are counted by
    Spark. The driver gets at most 8 * MOST_TERMS nodes, the sample's words within the edits of a term, and five
    numbers for each document of the sample. Labels without id or value teach nothing, of several for one id the
    largest holds. Without labels, or without a term, the prior weights stay and every text scores alike.
    """
    rows = _sample(docs, labels, sample)
    words = written(_word_counts(rows), "toxicity-words")
    terms = _terms(words)
    known = _known(words, terms) if terms else frozenset()

    def measured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = _matcher(terms, known)
        for batch in pieces(batches):
            found = [matcher.features(t) for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.list_(pa.float64())), batch.column(1)], names=["features", "toxic"])

    seen = rows.selectExpr("text", "CAST(toxic > 0 AS int) AS toxic").mapInArrow(measured, "features array<double>, toxic int")
    counted = seen.groupBy("features").agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).collect()
    if not counted:
        return Model(terms, known)
    return Model(terms, known, _fitted(*(np.array(x, float) for x in zip(*[(r.features, r.n, r.t) for r in sorted(counted, key=lambda r: r.features)], strict=True))))


def _fitted(x: np.ndarray, n: np.ndarray, t: np.ndarray) -> tuple[float, ...]:
    """Logistic weights by Newton's method, drawn to PRIOR; rows of features x with n documents, t of them toxic."""
    weights = PRIOR.copy()
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (t - n * p) - PRIOR_STRENGTH * (weights - PRIOR)
        step = np.linalg.solve((x * (n * p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(x.shape[1]), gradient)
        weights += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-9:
            break
    return tuple(weights.tolist())


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """The columns keep of docs, score (0 to 1) and predicted (1 from 0.5 on) of every row.

    A null or empty text has no hits, as most texts; its score is theirs. Repeated rows score alike; an empty
    table gives no rows. Columns of any name travel in one struct, but keep should not name score or predicted.
    """

    def scored(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher, weights = _matcher(model.terms, model.known), np.array(model.weights)
        for batch in pieces(batches):
            x = np.array([matcher.features(t) for t in batch.column(1).to_pylist()]).reshape(-1, len(weights))
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(p), pa.array((p >= 0.5).astype(np.int32))], names=["whole", "score", "predicted"]
            )

    rows = docs.select(F.struct(*keep).alias("whole"), "text")
    whole = rows.schema["whole"].dataType.simpleString()
    found = rows.mapInArrow(scored, f"whole {whole}, score double, predicted int")
    return found.select("whole.*", "score", "predicted")
