"""Token ids in Parquet files, in ascending document order.

A file row is a document: its id, its number of tokens, where it starts among the tokens of its part, and the
ids as a list column. Ids are dictionary-encoded (a vocabulary of 50,000 needs 16 bits an id), the numbers
delta-encoded. Row groups are small enough to be read one by one, and the page index lets a reader skip pages
by doc_id; readers of the numbers never touch the ids.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from masterlint.llm.common import new_path

END_ID = 0
#: Chunks remembered by a worker, twice over: a bound on memory only.
REMEMBERED = 300_000
#: Any of these in a text, and single spaces and line ends are not its only blanks.
BLANKS = ("  ", "\n\n", "\n ", " \n", *[chr(c) for c in range(0x110000) if chr(c).isspace() and chr(c) not in " \n"])
#: Characters that may follow a word's letters as a pre-token of their own, and the last letter looked at one by one.
MARKS = ",.;:!?"
LAST_LATIN = "\u024f"


def _byte_symbols() -> dict[int, str]:
    """The characters that stand for bytes in a byte-level vocabulary: printable ones for themselves, the rest
    numbered from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(256 + n) for n, b in enumerate(others)}


BYTE_SYMBOLS = _byte_symbols()
SPACE_SYMBOL = BYTE_SYMBOLS[0x20]
#: Bytes of text whose chunks are told apart at once.
BYTES_AT_ONCE = 1 << 20
FORMAT = {
    "compression": "zstd",
    "parquet.writer.version": "v2",
    "parquet.block.size": str(32 << 20),
    "parquet.page.size": str(256 << 10),
    "parquet.page.row.count.limit": "2000",
    "parquet.dictionary.page.size": str(1 << 20),
    "parquet.enable.dictionary": "true",
    **{f"parquet.enable.dictionary#{c}": "false" for c in ("doc_id", "part", "position", "part_start", "n_tokens")},
}


@lru_cache(2)
def _library(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


class Encoder:
    """Encodes texts to little-endian 32-bit ids, as the library does for the whole text.

    Byte-level pre-tokens end before every single space or line end between two words. So a text without runs
    of blanks is a sequence of chunks, a chunk being a space or line end and the word behind it, and a chunk met
    before need not be merged again. The chunks of many texts are cut and told apart as Arrow arrays, so only
    different ones are looked up. A new chunk of letters, with or without one mark behind them, is one pre-token
    or two, which the library's model merges; any other new chunk goes to the library as a text, and so does
    every text with runs of blanks or special strings.
    """

    def __init__(self, path: str):
        self.library = _library(path)
        self.model = self.library.model
        self.specials = [t.content for t in self.library.get_added_tokens_decoder().values()]
        self.chunks: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.line_end = self._encode("\n")
        self.marks = {c: self._encode(c) for c in MARKS}

    def _encode(self, text: str) -> bytes:
        return self._packed(self.library.encode(text, add_special_tokens=False).ids)

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()  # 32 bits, little-endian on every machine Spark runs on

    @staticmethod
    def _symbols(letters: str) -> str | None:
        """The model's symbols for what is one pre-token for sure, a word of Latin letters."""
        if not letters.isalpha():
            return None
        if letters.isascii():
            return letters
        return letters.encode().decode("latin-1").translate(BYTE_SYMBOLS) if max(letters) <= LAST_LATIN else None

    def _learn(self, words: Iterable[str]) -> None:
        """Remembers the ids of a space and each of the words; of the line end and the word behind it, where a
        word begins with one."""
        known, older, marks, tokenize = self.chunks, self.older, self.marks, self.model.tokenize
        for word in words:
            if word in older:
                known[word] = older[word]
                continue
            if word[0] == "\n":
                known[word] = self.line_end + self._first(word[1:])
                continue
            letters, mark = word, b""
            if word[-1] in marks:
                letters, mark = word[:-1], marks[word[-1]]
                if letters in known or letters in older:
                    known[word] = (known.get(letters) or older[letters]) + mark
                    continue
            if symbols := self._symbols(letters):
                known[word] = array("I", [t.id for t in tokenize(SPACE_SYMBOL + symbols)]).tobytes() + mark
            else:
                known[word] = self._encode(" " + word)

    def _first(self, word: str) -> bytes:
        letters, mark = (word[:-1], self.marks[word[-1]]) if word[-1:] in self.marks else (word, b"")
        symbols = self._symbols(letters)
        return self._packed([t.id for t in self.model.tokenize(symbols)]) + mark if symbols else self._encode(word)

    def _plain(self, text: str) -> bool:
        return not (text[0].isspace() or text[-1].isspace() or any(s in text for s in BLANKS) or any(s in text for s in self.specials))

    def _of_chunks(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of plain texts, one behind the other, and where each text's begin, with the end."""
        if not texts:
            return np.empty(0, "<u4"), np.zeros(1, np.int64)
        if len(self.chunks) > REMEMBERED:  # what is not met again before the next time is forgotten
            self.older, self.chunks = self.chunks, {}
        # a line end before each text makes its first word one behind a line end, too
        split = pc.split_pattern(pc.replace_substring(pa.array(["\n" + text for text in texts], pa.large_string()), "\n", " \n"), " ")
        # the part before the line end that was put there is empty and none of the text's
        chunks, bounds = split.values, split.offsets.to_numpy()
        coded = chunks.dictionary_encode()
        # no chunk holds a space: one string cut by Python is cheaper than one object after the other
        listed = pa.ListArray.from_arrays([0, len(coded.dictionary)], coded.dictionary)
        different, at = pc.binary_join(listed, pa.scalar(" ", pa.large_string()))[0].as_py().split(" "), coded.indices.to_numpy()
        known = self.chunks
        self._learn([x for x in different if x and x not in known])
        found = [known[x] if x else b"" for x in different]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        begins = np.cumsum(sizes) - sizes
        counts = sizes[at]
        ends = np.concatenate(([0], np.cumsum(counts)))
        ids = np.frombuffer(b"".join(found), "<u4")[np.repeat(begins[at] - ends[:-1], counts) + np.arange(ends[-1])]
        # those line ends go again
        starts = ends[bounds]
        keep = np.ones(len(ids), bool)
        added = len(self.line_end) // 4
        keep[(starts[:-1, None] + np.arange(added)).ravel()] = False
        return ids[keep], starts - added * np.arange(len(starts))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """The ids of each text."""
        ids, offsets = self.ended(texts)
        return [ids[a : b - 1].tobytes() for a, b in pairwise(offsets.tolist())]

    def ended(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts, one text behind the other, each with the end id, and where each text's begin, with
        the end."""
        plain = np.fromiter((bool(text) and self._plain(text) for text in texts), bool, len(texts))
        ids, bounds = self._of_chunks([text for text, p in zip(texts, plain, strict=True) if p])
        whole = [np.frombuffer(self._encode(text), "<u4") if text else ids[:0] for text, p in zip(texts, plain, strict=True) if not p]
        counts = np.ones(len(texts), np.int64)
        counts[plain] += np.diff(bounds)
        counts[~plain] += np.fromiter(map(len, whole), np.int64, len(whole))
        offsets = np.concatenate(([0], np.cumsum(counts)))
        out = np.full(offsets[-1], END_ID, "<u4")
        of_plain = np.repeat(plain, counts)
        of_plain[offsets[1:] - 1] = False
        out[of_plain] = ids
        for at, x in zip(offsets[:-1][~plain].tolist(), whole, strict=True):
            out[at : at + len(x)] = x
        return out, offsets


@lru_cache(1)
def encoder_of(path: str) -> Encoder:
    """A worker's encoder: what it has learned serves the next tasks."""
    return Encoder(path)


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """batch in slices of about BYTES_AT_ONCE of text, one row at least."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        stop = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + BYTES_AT_ONCE, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def encoded(docs: DataFrame, path: str) -> DataFrame:
    """docs in ranges of doc_id, each sorted and encoded: the rows of the files."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def encode(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, position, start = encoder_of(path), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            for some in _slices(batch):
                ids, offsets = encoder.ended(some.column(1).to_pylist())
                rows = some.num_rows
                yield pa.RecordBatch.from_arrays(
                    [
                        some.column(0),
                        pa.array(np.full(rows, part), pa.int32()),
                        pa.array(np.arange(position, position + rows), pa.int64()),
                        pa.array(start + offsets[:-1], pa.int64()),
                        pa.array(np.diff(offsets), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.view("<i4"))),
                    ],
                    names=["doc_id", "part", "position", "part_start", "n_tokens", "ids"],
                )
                position += rows
                start += int(offsets[-1])

    # rows with equal ids are dealt on by where they were read; sampling the ranges reads no text
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("by_place"))
    order = ["doc_id", "by_place"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    return ranged.mapInArrow(encode, f"doc_id {id_type}, part int, position bigint, part_start bigint, n_tokens bigint, ids array<int>")


def write_tokens(docs: DataFrame, path: str, folder: str | None = None) -> str:
    """Writes the files and returns their folder, by default a new one in the shared folder.

    Every row of docs becomes a row of the files, in ascending doc_id order (null ids first, equal ids next to
    each other). A null or empty text has the end id only. An empty table gives files without rows. Other
    columns are ignored.
    """
    folder = folder or new_path(docs.sparkSession, "tokens")
    encoded(docs, path).write.options(**FORMAT).parquet(folder)
    return folder


def read_tokens(spark: SparkSession, folder: str, ids: bool = True) -> DataFrame:
    """doc_id, start (tokens of all documents before), n_tokens and, unless left out, ids, from the files."""
    rows = spark.read.parquet(folder)
    parts = rows.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select(F.col("part"), (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    # one row per written part, whose number is that of the shuffle's partitions
    joined = rows.join(F.broadcast(before), "part").withColumn("start", F.col("before") + F.col("part_start"))
    return joined.select("doc_id", "start", "n_tokens", *["ids"] * ids)


def checksums(tokens: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of the rows of read_tokens()."""
    id_type = tokens.schema["doc_id"].dataType.simpleString()

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            values = lists.values.to_numpy(zero_copy_only=False).astype("<u4").data.cast("B")
            offsets = lists.offsets.to_pylist()
            sums = [zlib.crc32(values[4 * a : 4 * b]) for a, b in zip(offsets, offsets[1:], strict=False)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(sums, pa.int64())], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    return tokens.select("doc_id", "start", "n_tokens", "ids").mapInArrow(summed, f"doc_id {id_type}, start bigint, n_tokens bigint, ids_crc32 bigint")
