"""Removal of equal and similar lines by MinHash of their characters.

A line's signature holds the least values of its 5-character shingles under a number of hash functions, taken
together by ROWS as bands. Lines of a band are compared with the band's first line, exactly, by the Jaccard
similarity of their distinct shingles, the first band before the others. Of bands whose lines are then not all
known to belong together, the lines that aren't are compared with each other in blocks, so that a band loses no
link. The links' components are found by distributed union-find; of each the line with the smallest (doc_id,
text_id, line number) stays.

Shingles are hashed for many lines at once as arrays: as DataFrame functions they take about half a
microsecond each, which alone is more than the operator may cost. All else is DataFrame operations.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import components, row_groups, written

SHINGLE = 5
PERCENT = 80
#: Two lines of similarity 0.8 share one of ten bands of five values with a chance of 0.98. Of lines with a tenth of
#: their shingles in common, one pair in ten thousand does; bands of fewer values would be full of such pairs.
BANDS, ROWS = 10, 5
#: Lines that one task compares with each other, or with as many others; and with one band's first line.
BLOCK, CHUNK = 256, 4096
#: Characters that are hashed at once.
CHARACTERS_AT_ONCE = 1 << 18
_PRIME = np.uint64(0x100000001B3)
_FACTORS = np.random.default_rng(20_240_301).integers(1 << 31, 1 << 32, BANDS * ROWS, dtype=np.uint32) | np.uint32(1)
_LAST = np.uint64(0xD6E8FEB86659FD93)
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _MIX
    return (x ^ (x >> np.uint64(29))) * _LAST


def shingles(lines: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all lines, one line behind the other, and where each line's begin, with the end.
    A line shorter than a shingle is one as a whole."""
    lengths = np.fromiter(map(len, lines), np.int64, len(lines))
    counts = np.maximum(lengths - SHINGLE + 1, 1)
    offsets = np.concatenate(([0], np.cumsum(counts)))
    # short lines are filled up with a sign that no text has
    padded = np.maximum(lengths, SHINGLE)
    text = "".join([x if len(x) >= SHINGLE else x.ljust(SHINGLE, "\x00") for x in lines])
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64) + np.uint64(1)
    windows = len(codes) - SHINGLE + 1
    hashes = np.zeros(max(windows, 0), np.uint64)
    for i in range(SHINGLE):
        hashes = hashes * _PRIME + codes[i : i + len(hashes)]
    at = np.repeat(np.concatenate(([0], np.cumsum(padded)[:-1])) - offsets[:-1], counts) + np.arange(offsets[-1])
    return _mixed(hashes[at]), offsets


def _some(lines: list[str]) -> Iterator[tuple[int, int]]:
    """Ranges of lines with about CHARACTERS_AT_ONCE characters each, one line at least."""
    begin = size = 0
    for at, line in enumerate(lines):
        if size and size + len(line) > CHARACTERS_AT_ONCE:
            yield begin, at
            begin, size = at, 0
        size += len(line)
    if begin < len(lines):
        yield begin, len(lines)


def bands(lines: list[str]) -> np.ndarray:
    """The keys of the bands of each line, a row a line."""
    found = [np.empty((0, BANDS), np.int64)]
    for begin, stop in _some(lines):
        hashes, offsets = shingles(lines[begin:stop])
        high = (hashes >> np.uint64(32)).astype(np.uint32)
        least = [np.minimum.reduceat(high * factor, offsets[:-1]).astype(np.uint64) for factor in _FACTORS]
        keys = []
        for band in range(BANDS):
            key = np.full(stop - begin, band, np.uint64)
            for values in least[band * ROWS : (band + 1) * ROWS]:
                key = _mixed(key ^ values)
            keys.append(key)
        found.append(np.stack(keys, axis=1).view(np.int64))
    return np.concatenate(found)


def _sets(lines: list[str]) -> Iterator[np.ndarray]:
    """The distinct shingles of each line, in order."""
    for begin, stop in _some(lines):
        hashes, offsets = shingles(lines[begin:stop])
        for i in range(stop - begin):
            yield np.unique(hashes[offsets[i] : offsets[i + 1]])


def similar(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    both = int((a[np.minimum(np.searchsorted(a, b), len(a) - 1)] == b).sum())
    return 100 * both >= PERCENT * (len(a) + len(b) - both)


def lines(docs: DataFrame) -> DataFrame:
    """doc_id, text_id, line_no (from 0), line (lower case, outer blanks off), line_id, crc and keys of all lines
    that are not blank, written once. line_id is a 64-bit hash of the line; with the 32 bits of crc it says which
    lines are equal. text_id, a hash of the text, tells rows of one id or none apart."""
    each = docs.select("doc_id", F.expr("xxhash64(text) AS text_id"), F.posexplode(F.split("text", "\n")).alias("line_no", "raw"))
    trimmed = each.selectExpr("doc_id", "text_id", "line_no", "lower(trim(BOTH ' \\t\\r' FROM raw)) AS line").where("line <> ''")
    named = trimmed.selectExpr("*", "xxhash64(line) AS line_id", "crc32(line) AS crc")

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = bands(batch.column(3).to_pylist())
            offsets = pa.array(np.arange(len(keys) + 1, dtype=np.int32) * BANDS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(keys.ravel()))], names=[*batch.schema.names, "keys"])

    return written(named.mapInArrow(signed, f"{_ddl(named)}, keys array<bigint>"), "lines")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _texts(table: DataFrame, members: DataFrame) -> DataFrame:
    """line_id and line of the different lines in members (key, pivot, line_id), written once."""
    ids = written(members.select("line_id").unionByName(members.selectExpr("pivot AS line_id")).distinct(), "band-ids")
    return written(table.join(ids, "line_id", "left_semi").groupBy("line_id").agg(F.first("line").alias("line")), "band-texts")


def _pivot_links(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Links (a, b) of lines with the pivots of their bands, by distinct pairs (pivot, line_id).

    A pivot's lines are dealt in chunks, each with the pivot in front, so texts are shuffled once.
    """
    sizes = written(pairs.groupBy("pivot").agg(F.count("*").alias("size")).where(f"size > {CHUNK}"), "hot-pivots")
    chunked = pairs.join(sizes, "pivot", "left").selectExpr("pivot", "line_id", f"CAST(pmod(xxhash64(line_id), 1 + coalesce(size, 0) div {CHUNK}) AS int) AS chunk")
    heads = chunked.select("pivot", "chunk").distinct().selectExpr("pivot", "pivot AS line_id", "chunk", "0 AS member")
    dealt = chunked.selectExpr("pivot", "line_id", "chunk", "1 AS member").unionByName(heads)
    together = dealt.join(texts, "line_id").repartition("pivot", "chunk").sortWithinPartitions("pivot", "chunk", "member")

    def compared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.empty(0, np.uint64)
        for batch in batches:
            ids, pivots, flags, some = (batch.column(i).to_pylist() for i in range(4))
            a, b = [], []
            for line_id, pivot, member, found in zip(ids, pivots, flags, _sets(some), strict=True):
                if not member:
                    first = found
                elif similar(first, found):
                    a.append(line_id)
                    b.append(pivot)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    return together.select("line_id", "pivot", "member", "line").mapInArrow(compared, "a bigint, b bigint")


def _block_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) between lines of different roots in each (key, part): a spanning forest, so fewer than lines."""
    for group in row_groups(batches, ["key", "part"]):
        rows = sorted({(r["line_id"], r["root"], r["line"]) for r in group.select(["line_id", "root", "line"]).to_pylist()})
        ids, roots = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
        sets = list(_sets([r[2] for r in rows]))
        sizes = np.array([len(s) for s in sets])
        names, numbers = np.unique(np.concatenate(sets), return_inverse=True)
        begins = np.concatenate(([0], np.cumsum(sizes)))
        # lines that are known to belong together are one group; a link is only wanted between two groups
        _, group = np.unique(roots, return_inverse=True)
        a, b = [], []
        for i in range(len(rows) - 1):
            apart = group[i + 1 :] != group[i]
            if not apart.any():
                continue
            mine = np.zeros(len(names), np.int64)
            mine[numbers[begins[i] : begins[i + 1]]] = 1
            both = np.add.reduceat(mine[numbers[begins[i + 1] :]], begins[i + 1 : -1] - begins[i + 1])
            near = np.flatnonzero((100 * both >= PERCENT * (sizes[i] + sizes[i + 1 :] - both)) & apart) + i + 1
            # one link to each of the other groups, which then are one with this
            others, firsts = np.unique(group[near], return_index=True)
            b += ids[near[firsts]].tolist()
            a += [int(ids[i])] * len(firsts)
            group[np.isin(group, others)] = group[i]
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


def links(table: DataFrame) -> DataFrame:
    """Verified links (a, b) between lines of lines(), in which lines may come repeatedly.

    The first band goes first. A line is in one band of it and so gets one star, its pivot's; in the other bands
    pivots and lines of one star aren't compared again, which leaves few texts to be shuffled.
    """
    keyed = table.select("line_id", F.posexplode("keys").alias("band", "key"))
    # equal lines are combined before the shuffle, however many there are
    ends = keyed.groupBy("key").agg(F.min("line_id").alias("pivot"), F.max("line_id").alias("last"))
    mixed = written(ends.where("pivot < last").select("key", "pivot"), "bands")
    members = written(keyed.join(mixed, "key").where("line_id <> pivot").distinct(), "band-lines")
    texts = _texts(table, members)
    found = written(_pivot_links(members.where("band = 0").select("pivot", "line_id").distinct(), texts), "first-line-links")
    stars = found.groupBy("a").agg(F.min("b").alias("star"))
    of_pivot = mixed.join(stars, F.col("pivot") == F.col("a"), "left").selectExpr("key AS at", "coalesce(star, pivot) AS pivot_star")
    others = members.where("band > 0").join(of_pivot, F.col("key") == F.col("at")).select("pivot", "line_id", "pivot_star")
    apart = others.join(stars, F.col("line_id") == F.col("a"), "left").where("pivot_star <> coalesce(star, line_id)")
    more = _pivot_links(written(apart.select("pivot", "line_id").distinct(), "band-pairs"), texts)
    found = written(found.unionByName(more).distinct(), "line-links")
    # bands whose lines are not all in one component yet; the first line was compared with all others
    roots = written(components(found, "band-components").withColumnRenamed("node", "line_id"), "band-roots")
    rooted = members.join(roots, "line_id", "left").selectExpr("key", "line_id", "coalesce(root, line_id) AS root")
    sizes = rooted.groupBy("key").agg(F.count("*").alias("size"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    count = f"CAST(ceil(size / {BLOCK}) AS int)"
    mine = f"CAST(pmod(xxhash64(line_id), {count}) AS int)"
    parts = f"IF({count} = 1, array(0), transform(filter(sequence(0, {count} - 1), j -> j <> {mine}), j -> least(j, {mine}) * {count} + greatest(j, {mine})))"
    dealt = written(rooted.join(sizes.select("key", "size"), "key").selectExpr("key", "line_id", "root", f"explode({parts}) AS part"), "band-blocks")
    together = dealt.join(texts, "line_id").repartition("key", "part").sortWithinPartitions("key", "part")
    more = together.select("key", "part", "line_id", "root", "line").mapInArrow(_block_links, "a bigint, b bigint")
    return written(found.unionByName(more).distinct(), "all-line-links")


def repeated_lines(docs: DataFrame) -> DataFrame:
    """One row per line that goes: doc_id, text_id, line_no, kept_doc_id, kept_line_no.

    Lines without a visible character are no lines; a null text has none. Equal lines, upper and lower case
    alike, always share a component. Rows of equal id and text are one document's: of their lines of one number
    none is removed for the other. A null id comes last. An empty table gives no rows; other columns are
    ignored; whole lines count, however long.
    """
    table = lines(docs)
    roots = components(links(table), "line-components").withColumnRenamed("node", "line_id")
    copies = table.groupBy("line_id", "crc").agg(F.count("*").alias("copies"))
    grouped = copies.join(roots, "line_id", "left").where("copies > 1 OR root IS NOT NULL")
    # lines that only share line_id and link with nothing are told apart by crc
    group = "IF(root IS NULL, struct(line_id AS a, crc AS b), struct(root AS a, -1L AS b))"
    of_line = written(grouped.select("line_id", "crc", F.expr(group).alias("group")), "line-groups")
    places = ["doc_id", "text_id", "line_no"]
    members = written(table.select(*places, "line_id", "crc").join(of_line, ["line_id", "crc"]).select(*places, "group"), "group-lines")
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), *places)
    kept = written(members.groupBy("group").agg(F.min(rank).alias("kept")), "kept-lines")
    pairs = members.join(kept, "group").where("NOT (doc_id <=> kept.doc_id AND text_id = kept.text_id AND line_no = kept.line_no)")
    return pairs.selectExpr(*places, "kept.doc_id AS kept_doc_id", "kept.line_no AS kept_line_no")


def without_lines(docs: DataFrame, removed: DataFrame) -> DataFrame:
    """doc_id and text of docs without the removed lines (doc_id, text_id, line_no).

    Lines go from rows of their id and text only; other rows of that id, or without one, keep theirs. A null or
    empty text, and one that loses nothing, stays as it is; an empty table stays empty.
    """
    gone = removed.groupBy("doc_id", "text_id").agg(F.collect_set("line_no").alias("gone")).withColumnsRenamed({"doc_id": "of_id", "text_id": "of_text"})
    joined = docs.select("doc_id", "text").join(gone, F.expr("doc_id <=> of_id AND xxhash64(text) = of_text"), "left")
    left = "array_join(filter(split(text, '\\n'), (l, i) -> NOT array_contains(gone, i)), '\\n')"
    return joined.selectExpr("doc_id", f"IF(gone IS NULL, text, {left}) AS text")
