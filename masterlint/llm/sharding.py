"""Minimax contiguous sharding, as DataFrame operations.

Equal texts form a group that stays together. Groups stand in the order of their texts' digests. The shards are
contiguous runs of groups; their capacity is the smallest for which a greedy filling needs no more than the
given number of shards, found by binary search.

The group sizes stay in Spark. The driver searches over a digest of their running sums: places where cuts are
possible, and ranges in which more such places exist than it knows. Every round brackets the capacity, from
above by cutting at known places only and from below by cutting anywhere in the open ranges, then asks Spark
for a finer view of just the ranges the answer depends on. It ends when both bounds meet, so the capacity is
the exact minimum; a round brings a number of cells that does not depend on the data's size.
"""

from __future__ import annotations

from bisect import bisect_right

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masterlint.llm.common import written

SHARDS = 40
OVERHEAD = 16
LAW = "bytes"
#: Cells of the first view of the running sums, and how many a cell becomes when looked at again.
CELLS = 65_536
FINER = 64
#: Parts of a shard that are numbered side by side.
LANES = 1_024


class Cuts:
    """Where the running sum may be cut, as far as known: cells (first end, last end, number of ends)."""

    def __init__(self, cells: list[tuple[int, int, int]]):
        self.cells = sorted(cells)
        self.firsts = [c[0] for c in self.cells]
        self.total = self.cells[-1][1]

    def _cell(self, limit: int) -> int:
        return bisect_right(self.firsts, limit) - 1

    def known(self, limit: int) -> int:
        """The largest place known to be possible, at most limit."""
        k = self._cell(limit)
        if k < 0:
            return 0
        first, last, _ = self.cells[k]
        return last if last <= limit else first

    def loose(self, limit: int) -> int:
        """At least the largest possible place that is at most limit."""
        k = self._cell(limit)
        if k < 0:
            return 0
        first, last, n = self.cells[k]
        return last if last <= limit else limit if n > 2 else first

    def fill(self, capacity: int, shards: int, place) -> list[int]:
        at, cuts = 0, []
        while len(cuts) < shards and at < self.total:
            nearest = place(at + capacity)
            if nearest <= at:
                break
            cuts.append(at := nearest)
        return cuts

    def least(self, shards: int, place, low: int) -> int:
        high = self.total
        while low < high:
            middle = (low + high) // 2
            cuts = self.fill(middle, shards, place)
            if cuts and cuts[-1] >= self.total:
                high = middle
            else:
                low = middle + 1
        return low

    def open_ranges(self, low: int, high: int, shards: int) -> list[int]:
        """Cells with unknown places among which a cut may lie for a capacity from low to high."""
        found: set[int] = set()
        least_at = most_at = 0
        for _ in range(shards):
            least_at, most_at = self.known(least_at + low), self.loose(most_at + high)
            window = range(max(0, self._cell(least_at)), self._cell(most_at) + 1)
            if any(self.cells[k][2] > 2 for k in window):
                found.update(window)
        return sorted(found)


def _view(ends: DataFrame, ranges: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Each range (from, to, cells) cut into cells: the first and last end of each, and how many there are."""
    low = F.lit(None).cast("bigint")
    width = F.lit(None).cast("bigint")
    for a, b, fine in ranges:
        inside = F.col("end").between(a, b)
        low = F.when(inside, F.lit(a)).otherwise(low)
        width = F.when(inside, F.lit(max(1, -(-(b - a + 1) // fine)))).otherwise(width)
    cells = (
        ends.select("end", low.cast("bigint").alias("low"), width.cast("bigint").alias("width"))
        .where("low IS NOT NULL")
        .groupBy("low", F.expr("(end - low) div width").alias("cell"))
        .agg(F.min("end").alias("a"), F.max("end").alias("b"), F.count("*").alias("n"))
    )
    return [(r.a, r.b, r.n) for r in cells.select("a", "b", "n").collect()]


def _ranges(cells: list[tuple[int, int, int]], chosen: list[int]) -> list[tuple[int, int, int]]:
    """The chosen cells as ranges with the number of finer cells for each, neighbours merged."""
    ranges: list[tuple[int, int, int]] = []
    for k in chosen:
        first, last, _ = cells[k]
        if ranges and ranges[-1][1] == cells[k - 1][1]:
            ranges[-1] = (ranges[-1][0], last, ranges[-1][2] + FINER)
        else:
            ranges.append((first, last, FINER))
    return ranges


def least_capacity(ends: DataFrame, total: int, largest: int, shards: int) -> tuple[int, list[int]]:
    """The smallest capacity and the places of its cuts. ends (end): the running sums of the group sizes."""
    cuts = Cuts(_view(ends, [(1, total, CELLS)]))
    while True:
        high = cuts.least(shards, cuts.known, largest)
        low = cuts.least(shards, cuts.loose, largest)
        if low >= high:
            return high, cuts.fill(high, shards, cuts.known)
        chosen = cuts.open_ranges(low, high, shards)
        ranges = _ranges(cuts.cells, chosen)
        inside = set(chosen)
        rest = [c for k, c in enumerate(cuts.cells) if k not in inside]
        cuts = Cuts([*rest, *_view(ends, ranges)])


def assign(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot and grown_shard of every row of docs.

    A null text has no bytes and is not equal to an empty one. Equal texts, however many, share a shard; a
    group larger than an even share sets the capacity. Shards may stay empty when there are few groups. Slots
    number a shard's rows from 0 without a gap; rows equal in id and text may swap slots. An empty table gives
    no rows. Other columns are ignored.
    """
    rows = written(
        docs.selectExpr(
            "doc_id",
            f"CAST(coalesce(octet_length(text), 0) + {OVERHEAD} AS bigint) AS size",
            "crc32(coalesce(text, '')) AS text_crc32",
            "coalesce(md5(text), '') AS digest",
        ),
        "shard-rows",
    )
    groups = written(rows.groupBy("digest").agg(F.sum("size").alias("size")).withColumn("block", F.expr("substr(digest, 1, 4)")), "shard-groups")
    # blocks: four hexadecimal digits, so at most 65,537 rows meet in the first window
    blocks = groups.groupBy("block").agg(F.sum("size").alias("bytes"))
    before = blocks.select("block", (F.sum("bytes").over(Window.orderBy("block")) - F.col("bytes")).alias("before"))
    inner = F.sum("size").over(Window.partitionBy("block").orderBy("digest"))
    placed = written(groups.join(before, "block").select("digest", "size", (F.col("before") + inner).alias("end")), "shard-ends")
    total, largest = placed.agg(F.max("end"), F.max("size")).first()
    cuts = least_capacity(placed, total, largest, shards)[1] if total else []
    number = " + ".join(["0", *[f"IF(end > {cut}L, 1, 0)" for cut in cuts[: shards - 1]]])
    shard_of = written(placed.select("digest", F.expr(number).cast("int").alias("shard")), "shard-of")
    lane = F.expr(f"CAST(pmod(xxhash64(doc_id, digest), {LANES}) AS int)")
    sharded = written(rows.join(shard_of, "digest").withColumn("lane", lane), "sharded")
    counts = sharded.groupBy("shard", "lane").agg(F.count("*").alias("n"))
    in_order = Window.partitionBy("shard").orderBy("lane")
    offsets = counts.select("shard", "lane", (F.sum("n").over(in_order) - F.col("n")).alias("offset"))
    rank = F.row_number().over(Window.partitionBy("shard", "lane").orderBy("doc_id", "digest"))
    numbered = sharded.withColumn("rank", rank - 1)
    # offsets: one row per shard and lane, at most shards * LANES
    return numbered.join(F.broadcast(offsets), ["shard", "lane"]).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit(LAW).alias("law"),
        "shard",
        (F.col("offset") + F.col("rank")).cast("bigint").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
