"""Token counts of a piece vocabulary, with a shortcut for words that are one token.

The vocabulary holds no piece with a space mark after another character, so no merge crosses the place where a
space follows a non-space: a text's tokens are those of its segments, each a run of spaces and the word after
it. Before counting, every vocabulary string is encoded alone; the ones that come back as one token count 1
without a merge. Only other segments are merged by the library, each distinct one once per task's memory.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import pieces

MARK = "▁"
LIMIT = 4096
#: Segments remembered by a worker, a bound on memory only: beyond it, memory starts anew.
REMEMBERED = 500_000
#: A segment longer than this many characters is counted but not remembered.
LONG_SEGMENT = 200
_SEGMENT = re.compile(r" *[^ ]+| +")


@lru_cache(2)
def _library(path: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=path)


def splits_at_spaces(path: str) -> bool:
    """Whether no piece has a space mark behind another character, so that segments encode on their own."""
    model = _library(path)
    return not any(re.search(f"[^{MARK}]{MARK}", model.id_to_piece(i)) for i in range(model.vocab_size()))


def whole_tokens(path: str) -> frozenset[str]:
    """Words w, without a space, for which the library encodes ' w' inside a text as exactly one token."""
    model = _library(path)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    words = [p[1:] for p in pieces if p.startswith(MARK) and len(p) > 1 and MARK not in p[1:]]
    return frozenset(w for w, ids in zip(words, model.encode(words, num_threads=1), strict=True) if len(ids) == 1)


class Counter:
    """Counts tokens exactly as the library does for the whole text."""

    def __init__(self, path: str):
        self.model = _library(path)
        self.whole = dict.fromkeys(whole_tokens(path), 1)
        self.words = dict(self.whole)

    def _merge(self, words: list[str]) -> None:
        """Merges words that follow one space; the library itself puts that space before a text."""
        if len(self.words) + len(words) > len(self.whole) + REMEMBERED:
            self.words = dict(self.whole)
        self.words.update(zip(words, map(len, self.model.encode(words, num_threads=1)), strict=True))

    def count(self, text: str | None) -> int:
        if not text:
            return 0
        text = text.replace(MARK, " ")
        if "  " in text or text[0] == " " or text[-1] == " ":
            return self._with_runs(text)
        found = text.split(" ")
        known = self.words
        try:
            return sum(map(known.__getitem__, found))
        except KeyError:
            long = [w for w in found if len(w) > LONG_SEGMENT]
            new = list({w for w in found if w not in known and len(w) <= LONG_SEGMENT})
            if new:
                self._merge(new)
            known = self.words
            total = sum(map(len, self.model.encode(long, num_threads=1))) if long else 0
            rest = [w for w in found if len(w) <= LONG_SEGMENT]
            if any(w not in known for w in rest):  # memory started anew under way
                self._merge(list({w for w in rest if w not in known}))
            return total + sum(map(self.words.__getitem__, rest))

    def _with_runs(self, text: str) -> int:
        """Texts with runs of spaces: segments as they stand, one space of the first being the library's own."""
        segments = [s[1:] for s in _SEGMENT.findall(" " + text)]
        lone = segments.count("")  # one space at the end: the mark alone
        return lone + sum(map(len, self.model.encode(segments, num_threads=1)))


@lru_cache(1)
def counter_of(path: str) -> Counter:
    """A worker's counter: what it has merged serves the next tasks."""
    return Counter(path)


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes (UTF-8), n_tokens and over_limit (n_tokens > limit) of every row of docs.

    A null text is an empty one: no bytes, no tokens. Null and repeated doc_ids stay as they are, row by row;
    other columns are ignored. A vocabulary whose pieces cross spaces is refused.
    """
    if not splits_at_spaces(path):
        raise ValueError(f"pieces of {path} cross spaces; segments can't be counted on their own")

    def counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = counter_of(path)
        for batch in pieces(batches):
            found = [counter.count(text) for text in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    rows = docs.select("doc_id", F.expr("CAST(coalesce(octet_length(text), 0) AS bigint)").alias("n_bytes"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(counted, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint").withColumn("over_limit", F.col("n_tokens") > limit)
