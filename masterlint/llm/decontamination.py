"""Benchmark passages inside documents, found within an edit distance.

An item is leaked by a document that holds a passage within EDIT_RATE times the item's length in edits, after
lower-casing and joining words by single spaces. The steps, for each document:

1. Windows. An item with at most k edits keeps one of k + 1 pieces unchanged, so every leak holds a piece at a
   place that says where an item-sized window begins. An automaton finds all pieces in one pass.
2. CGK embedding. A random walk copies a window to a string of three times its length, moving on or not by
   random bits per step and character. Strings at a small edit distance get close in Hamming distance.
3. Bit-sampling LSH. A window goes on if it agrees with the item on all sampled places of a repetition. The
   number of repetitions follows from the target recall, measured on items with the most edits allowed.
4. Exact edit distance of the item to the best passage around the window.

Long items are cut in sections, which steps 1 to 3 look for in the item's place. So the memory of a task is that of
its texts and a block of items, and doesn't grow with the longest item.
"""

from __future__ import annotations

import math
import random
from collections import defaultdict
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import pieces, written

EDIT_RATE = 0.05
RECALL = 0.99
SAMPLED = 2
STRETCH = 3
SEED = 11
#: Characters of items that one pass over the documents takes; more items take more passes.
ITEM_CHARS = 8_000_000
#: Items used to measure the recall of one repetition.
MEASURED_ITEMS = 200
#: Steps of a walk whose bits are made at once, and how many such blocks a worker keeps (16 KB each).
STEPS_AT_ONCE, STEPS_KEPT = 64, 1024
#: Characters of a window. Longer items are sought by sections, one of which has no more than its share of the edits.
SECTION = 2048
#: Cells of the window matrix that are embedded at once.
CELLS = 1 << 21
END = 0


def normal(text: str | None) -> str:
    return " ".join((text or "").lower().split())


def edits_allowed(length: int, rate: float = EDIT_RATE) -> int:
    return int(length * rate)


def sections(item: str, rate: float = EDIT_RATE) -> list[tuple[int, int, int]]:
    """Begin, end and edits of an item's sections: of a passage with no more edits than the item may have, one
    section has no more than its own."""
    count = -(-len(item) // SECTION)
    bounds = [len(item) * i // count for i in range(count + 1)]
    edits = edits_allowed(len(item), rate) // count
    return [(a, b, edits) for a, b in zip(bounds, bounds[1:], strict=False)]


def best_passage(item: str, text: str) -> tuple[int, int]:
    """Fewest edits between item and any passage of text, and where the first such passage ends.

    Bit-parallel: a column of the edit table is two whole numbers, its steps up and its steps down.
    """
    full, top = (1 << len(item)) - 1, 1 << (len(item) - 1)
    places: dict[str, int] = defaultdict(int)
    for i, c in enumerate(item):
        places[c] |= 1 << i
    up, down, score = full, 0, len(item)
    best, end = score, 0
    for j, c in enumerate(text, 1):
        match = places.get(c, 0)
        flat = match | down
        carried = (((match & up) + up) ^ up) | match
        rise, fall = down | (full & ~(carried | up)), up & carried
        score += bool(rise & top) - bool(fall & top)
        rise, fall = (rise << 1) & full, (fall << 1) & full
        up, down = fall | (full & ~(flat | rise)), rise & flat
        if score < best:
            best, end = score, j
    return best, end


class Embedding:
    """One repetition: the random bits of a walk and the places sampled from its result.

    The bits are the seeded generator's for a step, made when the walk gets there, so nothing grows with the items.
    """

    def __init__(self, seed: int):
        self.seed = seed
        self.sampled = np.sort(np.random.default_rng([SEED, seed]).random(SAMPLED))

    @staticmethod
    @lru_cache(STEPS_KEPT)
    def _bits(seed: int, block: int) -> np.ndarray:
        """The bits of STEPS_AT_ONCE steps, a row of 256 a step."""
        return np.random.default_rng([SEED, seed, block]).integers(0, 2, (STEPS_AT_ONCE, 256), dtype=np.int8)

    def sample(self, strings: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """strings: rows of code points ended by END; lengths: of each row's item. A row of samples each."""
        n = len(strings)
        rows, at = np.arange(n), np.zeros(n, dtype=np.int64)
        wanted = (self.sampled[None] * STRETCH * lengths[:, None]).astype(np.int64)
        out = np.zeros((n, SAMPLED), dtype=np.uint32)
        last = strings.shape[1] - 1
        for step in range(int(wanted.max()) + 1 if n else 0):
            seen = strings[rows, np.minimum(at, last)]
            hit = wanted == step
            if hit.any():
                out = np.where(hit, seen[:, None], out)
            at += self._bits(self.seed, step // STEPS_AT_ONCE)[step % STEPS_AT_ONCE][seen & 255]
        return out


def _samples(walk: Embedding, strings: list[str], lengths: np.ndarray) -> np.ndarray:
    """The samples of many strings, those of like length together: a few long ones don't widen all."""
    out = np.zeros((len(strings), SAMPLED), dtype=np.uint32)
    order = np.argsort(lengths, kind="stable")
    for some in _slices(order, lengths):
        out[some] = walk.sample(_matrix([strings[i] for i in some], int(lengths[some].max())), lengths[some])
    return out


def _slices(order: np.ndarray, lengths: np.ndarray) -> Iterator[np.ndarray]:
    """order, which is by length, in slices of at most CELLS characters once filled up, one string at least."""
    begin = 0
    for at in range(1, len(order) + 1):
        if at == len(order) or (at + 1 - begin) * (int(lengths[order[at]]) + 1) > CELLS:
            yield order[begin:at]
            begin = at


def _matrix(strings: list[str], width: int) -> np.ndarray:
    out = np.zeros((len(strings), width + 1), dtype=np.uint32)
    for row, s in zip(out, strings, strict=True):
        row[: len(s)] = np.frombuffer(s.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


def _edited(item: str, edits: int, source: random.Random) -> str:
    letters, out = sorted(set(item)), list(item)
    for _ in range(edits):
        at = source.randrange(len(out) + 1)
        kind = source.randrange(3)
        if kind == 0:
            out.insert(at, source.choice(letters))
        elif out:
            out[min(at, len(out) - 1) : min(at, len(out) - 1) + 1] = [source.choice(letters)] if kind == 1 else []
    return "".join(out)


def repetitions(items: list[str], rate: float, recall: float) -> int:
    """How many repetitions find a copy with the most edits allowed with the wanted probability."""
    source = random.Random(SEED)
    chosen = [x[a:b] for x in sorted(items) for a, b, edits in sections(x, rate) if edits]
    chosen = source.sample(chosen, min(len(chosen), MEASURED_ITEMS))
    if not chosen:
        return 1
    lengths = np.array([len(x) for x in chosen])
    copies = [_edited(x, edits_allowed(len(x), rate), source)[: len(x)] for x in chosen]
    found = np.zeros(len(chosen))
    trials = 24
    for seed in range(trials):
        walk = Embedding(seed)
        found += (_samples(walk, copies, lengths) == _samples(walk, chosen, lengths)).all(axis=1)
    typical = float(np.quantile(found / trials, 0.1))  # of the items that are found least often
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - min(max(typical, 1 / trials), 0.999))))


@dataclass
class Finder:
    """Finds a block of items in texts. items: (item_id, normalised text)."""

    items: list[tuple[object, str]]
    rate: float = EDIT_RATE
    repeats: int = 1
    _ready: bool = field(default=False, repr=False)

    def prepare(self) -> None:
        self.sections: list[tuple[int, int, str]] = []
        pieces: dict[str, list[tuple[int, int]]] = defaultdict(list)
        for n, (_, item) in enumerate(self.items):
            for begin, end, edits in sections(item, self.rate):
                bounds = [begin + (end - begin) * p // (edits + 1) for p in range(edits + 2)]
                for a, b in zip(bounds, bounds[1:], strict=False):
                    pieces[item[a:b]].append((len(self.sections), a - begin))
                self.sections.append((n, begin, item[begin:end]))
        self.automaton = ahocorasick.Automaton()
        for piece, places in pieces.items():
            self.automaton.add_word(piece, (len(piece), places))
        self.automaton.make_automaton()
        self.walks = [Embedding(seed) for seed in range(self.repeats)]
        strings = [section for _, _, section in self.sections]
        self.lengths = np.array([len(x) for x in strings])
        self.samples = [_samples(walk, strings, self.lengths) for walk in self.walks]
        self._ready = True

    def find(self, texts: list[str | None]) -> list[dict[int, tuple[int, int, int]]]:
        """Per text, for each item it leaks: edits, and start and end of the passage in the normalised text."""
        if not self._ready:
            self.prepare()
        found: list[dict[int, tuple[int, int, int]]] = []
        windows: list[tuple[int, int, int, int]] = []
        clean = [normal(text) for text in texts]
        for t, text in enumerate(clean):
            found.append({})
            starts: set[tuple[int, int]] = set()
            for end, (size, places) in self.automaton.iter(text):
                starts.update((s, end + 1 - size - a) for s, a in places)
            of_items = [(self.sections[s][0], start - self.sections[s][1], s) for s, start in starts]
            windows += [(t, n, start, s) for n, start, s in sorted(of_items)]
        sizes = self.lengths[[s for *_, s in windows]] if windows else np.empty(0, dtype=np.int64)
        near = np.zeros(len(windows), dtype=bool)
        for some in _slices(np.argsort(sizes, kind="stable"), sizes):
            near[some] = self._near(clean, [windows[i] for i in some])
        sought: dict[tuple[int, int], int] = {}
        for i in np.flatnonzero(near):
            t, n, start, _ = windows[i]
            # what is found from one window is found for all windows shortly behind it
            if start >= sought.get((t, n), start) and found[t].get(n, (1,))[0] > 0:
                sought[t, n] = start + 1 + self._verify(clean[t], n, start, found[t])
        return found

    def _near(self, texts: list[str], windows: list[tuple[int, int, int, int]]) -> np.ndarray:
        of_section = np.array([s for *_, s in windows])
        lengths = self.lengths[of_section]
        strings = []
        for (t, _, start, s), size in zip(windows, lengths.tolist(), strict=True):
            begin = start + self.sections[s][1]
            strings.append(texts[t][max(0, begin) : max(0, begin + size)])
        matrix = _matrix(strings, int(lengths.max()))
        near = np.zeros(len(windows), dtype=bool)
        for walk, samples in zip(self.walks, self.samples, strict=True):
            left = np.flatnonzero(~near)
            if not len(left):
                break
            same = walk.sample(matrix[left], lengths[left]) == samples[of_section[left]]
            near[left[same.all(axis=1)]] = True
        return near

    def _verify(self, text: str, n: int, start: int, found: dict[int, tuple[int, int, int]]) -> int:
        """Looks for the item around a window, and returns up to how far behind it other windows need no look."""
        item = self.items[n][1]
        allowed = edits_allowed(len(item), self.rate)
        begin = max(0, start - allowed)
        region = text[begin : start + len(item) + 3 * allowed]
        edits, end = best_passage(item, region)
        if edits <= allowed and (n not in found or edits < found[n][0]):
            back = best_passage(item[::-1], region[:end][::-1])[1]  # the same passage, from its end
            found[n] = (edits, begin + end - back, begin + end)
        return 2 * allowed


def finders(benchmark: DataFrame, rate: float = EDIT_RATE, recall: float = RECALL) -> Iterator[Finder]:
    """One finder per block of items, one after the other: neither the driver nor a task holds more than a block.
    Items without a word are left out. A block has about ITEM_CHARS characters, or one item, so what goes to the
    tasks does not grow with the benchmark."""
    rows = benchmark.select("item_id", "text").where("text IS NOT NULL")
    chars = rows.agg(F.sum(F.char_length("text"))).first()[0] or 0
    blocks = 1 + chars // ITEM_CHARS
    for block in range(blocks):
        mine = rows.where(F.expr(f"pmod(xxhash64(item_id, text), {blocks}) = {block}")) if blocks > 1 else rows
        items = [(r.item_id, item) for r in mine.toLocalIterator() if (item := normal(r.text))]
        if items:
            yield Finder(items, rate, repetitions([x for _, x in items], rate, recall))


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per document and leaked item: doc_id, item_id, edits, start, stop.

    start and stop count characters of the normalised text, of the best passage. Null and empty texts leak
    nothing, a null or empty item is in nothing, an empty benchmark gives no rows. Repeated rows and items
    give a row each; null ids stay null. Whole texts are searched. Other columns are ignored.
    """
    id_type = docs.schema["doc_id"].dataType
    item_type = benchmark.schema["item_id"].dataType
    schema = f"doc_id {id_type.simpleString()}, item_id {item_type.simpleString()}, edits int, start bigint, stop bigint"

    def searching(finder: Finder):
        def search(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                at, rows = [], []
                for i, found in enumerate(finder.find(batch.column(1).to_pylist())):
                    for n, (edits, start, stop) in sorted(found.items()):
                        at.append(i)
                        rows.append((finder.items[n][0], edits, start, stop))
                columns = list(zip(*rows, strict=True)) or [()] * 4
                kinds = (None, pa.int32(), pa.int64(), pa.int64())
                arrays = [pa.array(list(c), k) if k or c else pa.nulls(0) for c, k in zip(columns, kinds, strict=True)]
                if at:
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), *arrays], names=["doc_id", "item_id", "edits", "start", "stop"])

        return search

    texts = docs.select("doc_id", "text")
    out = docs.sparkSession.createDataFrame([], schema)
    blocks = finders(benchmark)
    finder, following = next(blocks, None), next(blocks, None)
    if finder and not following:
        return texts.mapInArrow(searching(finder), schema)
    while finder:
        # written before the next but one is made, so that its items can go
        out = out.unionByName(written(texts.mapInArrow(searching(finder), schema), "leaks"))
        finder, following = following, next(blocks, None)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that leak no item, with all their columns.

    Rows with a null or empty text stay, repeated rows stay or go alike, an empty table or benchmark changes
    nothing; other columns may have any names.
    """
    place = docs.columns.index("text")

    def keeping(finder: Finder):
        def keep(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in pieces(batches):
                yield batch.filter(pa.array([not found for found in finder.find(batch.column(place).to_pylist())]))

        return keep

    blocks = finders(benchmark)
    finder, following = next(blocks, None), next(blocks, None)
    while finder:
        docs = docs.mapInArrow(keeping(finder), docs.schema)
        if following:
            docs = written(docs, "without-leaks")
        finder, following = following, next(blocks, None)
    return docs
