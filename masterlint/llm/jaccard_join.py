"""N-gram Jaccard self-join of documents by signature trees, down to components of linked documents.

Texts link when their sets of five-word shingles share at least 80 % of their union. Equal sets are one node.

Routing. In the order of the shingles' hashes, two linked sets have the same two shingles next to each other
somewhere near the front: a union's shingle is missing from one of both with a chance of at most one in five,
so among the first RUNS places some two neighbours are shared but for a chance below 1e-11 (for sets of up to
RUNS shingles: always). The hash of every such pair of neighbours is a bucket key.

Trees. Each bucket's sets form a signature tree: a leaf holds the token bitmaps of some sets, a node the OR of
its children's bitmaps and the range of their sizes. The tree is joined with itself from the root; a pair of
nodes is dropped when sizes rule out a link or when no more shingles than the bitmaps show can be shared, and
so are pairs whose sets are all in one component already. What is left in the leaves are possible links; their
components bring together the sets whose shingles are then compared exactly, by the same traversal.

Large groups are cut into blocks, and every pair of blocks is a group of its own, so no task holds more than
two blocks; nothing is left out.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import components, pieces, row_groups, written

WORDS = 5
PERCENT = 80
RUNS = 40
BITS_PER_SHINGLE = 4
BLOCK = 4_096
LEAF = 32
FAN_OUT = 8
#: Nodes of texts without an id get numbers from here on.
NO_ID = 1 << 62

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


class Shingler:
    """Sorted distinct 64-bit hashes of a text's shingles; words are hashed once while remembered."""

    REMEMBERED = 400_000

    def __init__(self, words: int = WORDS):
        self.words, self.known = words, {}

    def _hash(self, word: bytes) -> int:
        if len(self.known) > self.REMEMBERED:
            self.known = {}
        self.known[word] = value = xxhash.xxh3_64_intdigest(word)
        return value

    def __call__(self, text: str | None) -> np.ndarray:
        found = (text or "").encode("utf-8", "surrogatepass").lower().split()
        if not found:
            return np.empty(0, dtype=np.uint64)
        known = self.known
        try:
            hashes = np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))
        except KeyError:
            hashes = np.array([known.get(w) or self._hash(w) for w in found], dtype=np.uint64)
        size = min(self.words, len(found))
        n = len(found) - size + 1
        total = np.full(n, size, dtype=np.uint64)  # a short text's one shingle differs from a long one's
        for k in range(size):
            total = mixed(total + hashes[k : k + n] + _MIX[0])
        return np.unique(total)


@lru_cache(1)
def shingler() -> Shingler:
    """A worker's shingler: the words it has hashed serve the next tasks."""
    return Shingler()


def bitmap(shingles: np.ndarray) -> np.ndarray:
    """One bit per shingle in a power of two of bits, so that a wide map folds onto a narrow one."""
    width = max(64, 1 << (int(BITS_PER_SHINGLE * len(shingles)) - 1).bit_length())
    bits = np.zeros(width // 8, dtype=np.uint8)
    at = (shingles & np.uint64(width - 1)).astype(np.int64)
    np.bitwise_or.at(bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    return bits.view(np.uint64)


def folded(maps: np.ndarray, width: int) -> np.ndarray:
    """Rows of bitmaps folded to width words."""
    while maps.shape[-1] > width:
        half = maps.shape[-1] // 2
        maps = maps[..., :half] | maps[..., half:]
    return maps


def run_keys(shingles: np.ndarray) -> np.ndarray:
    if len(shingles) < 4:  # sets of up to three shingles only link with equal ones
        return np.empty(0, dtype=np.int64)
    front = shingles[:RUNS]
    return mixed(mixed(front[:-1] + _MIX[0]) + front[1:]).view(np.int64)


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if 100 * min(len(a), len(b)) < PERCENT * max(len(a), len(b)):
        return False
    shared = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * shared >= PERCENT * (len(a) + len(b) - shared)


class Union:
    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = x = self.parent[self.parent[x]]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.parent[max(a, b)] = min(a, b)
        return a != b


class Node:
    __slots__ = ("bits", "children", "first", "last", "least", "most", "slack")

    def __init__(self, first: int, last: int, least: int, most: int, slack: int, bits: np.ndarray, children: tuple = ()):
        self.first, self.last, self.least, self.most = first, last, least, most
        self.slack, self.bits, self.children = slack, bits, children


class Tree:
    """A signature tree over sets, given by size and bitmap, in order of size and first hash."""

    def __init__(self, sizes: np.ndarray, maps: list[np.ndarray]):
        self.sizes, self.leaves = sizes, []
        nodes = []
        for first in range(0, len(maps), LEAF):
            last = min(first + LEAF, len(maps))
            width = min(len(m) for m in maps[first:last])
            rows = np.array([folded(m, width) for m in maps[first:last]])
            counts = np.bitwise_count(rows).sum(axis=1, dtype=np.int64)
            slack = int((sizes[first:last] - counts).max())
            self.leaves.append((rows, counts))
            nodes.append(Node(first, last, int(sizes[first:last].min()), int(sizes[first:last].max()), slack, np.bitwise_or.reduce(rows)))
        while len(nodes) > 1:
            nodes = [self._above(nodes[i : i + FAN_OUT]) for i in range(0, len(nodes), FAN_OUT)]
        self.root = nodes[0]

    @staticmethod
    def _above(children: list[Node]) -> Node:
        if len(children) == 1:
            return children[0]
        width = min(len(c.bits) for c in children)
        bits = np.bitwise_or.reduce([folded(c.bits, width) for c in children])
        # folding may hide bits, so the slack is what a child's sets hold beyond the narrowest map
        slack = max(c.slack if len(c.bits) == width else c.most for c in children)
        return Node(children[0].first, children[-1].last, min(c.least for c in children), max(c.most for c in children), slack, bits, tuple(children))

    @staticmethod
    def possible(a: Node, b: Node) -> bool:
        """Whether some set under a may link with some set under b."""
        if 100 * a.most < PERCENT * b.least or 100 * b.most < PERCENT * a.least:
            return False
        width = min(len(a.bits), len(b.bits))
        common = int(np.bitwise_count(folded(a.bits, width) & folded(b.bits, width)).sum())
        slack = min(a.slack if len(a.bits) == width else a.most, b.slack if len(b.bits) == width else b.most)
        # linked sets share at least PERCENT / (100 + PERCENT) of their sizes' sum
        return (common + slack) * (100 + PERCENT) >= PERCENT * (a.least + b.least)

    def join(self, union: Union, link: Callable[[int, int], bool]) -> None:
        """Unites what link() says of all pairs that the bitmaps allow and that are not united yet."""
        stack = [(self.root, self.root)]
        while stack:
            a, b = stack.pop()
            if a is not b and not self.possible(a, b):
                continue
            roots = {union.root(x) for n in {a, b} for x in range(n.first, n.last)} if max(a.last - a.first, b.last - b.first) <= LEAF else None
            if roots is not None and len(roots) == 1:
                continue
            if a.children and (not b.children or a.last - a.first >= b.last - b.first):
                if a is b:
                    stack += [(x, y) for i, x in enumerate(a.children) for y in a.children[i:]]
                else:
                    stack += [(x, b) for x in a.children]
            elif b.children:
                stack += [(a, y) for y in b.children]
            else:
                self._leaves(a, b, union, link)

    def _leaves(self, a: Node, b: Node, union: Union, link: Callable[[int, int], bool]) -> None:
        (x, _), (y, _) = self.leaves[a.first // LEAF], self.leaves[b.first // LEAF]
        width = min(x.shape[1], y.shape[1])
        x, y = folded(x, width), folded(y, width)
        nx, ny = self.sizes[a.first : a.last, None], self.sizes[None, b.first : b.last]
        common = np.bitwise_count(x[:, None] & y[None]).sum(axis=2, dtype=np.int64)
        own_x = np.bitwise_count(x).sum(axis=1, dtype=np.int64)[:, None] - common
        own_y = np.bitwise_count(y).sum(axis=1, dtype=np.int64)[None] - common
        # a bit only one of both has is a shingle the other has not
        most = np.minimum(nx - own_x, ny - own_y)
        fits = (most * (100 + PERCENT) >= PERCENT * (nx + ny)) & (100 * np.minimum(nx, ny) >= PERCENT * np.maximum(nx, ny))
        if a is b:
            fits = np.triu(fits, 1)
        for i, j in zip(*np.nonzero(fits), strict=True):
            i, j = int(i) + a.first, int(j) + b.first
            if union.root(i) != union.root(j) and link(i, j):
                union.join(i, j)


def _edges(nodes: list[int], union: Union) -> list[tuple[int, int]]:
    """A star per component of more than one node."""
    at = ((n, nodes[union.root(i)]) for i, n in enumerate(nodes))
    return [(a, b) for a, b in at if a != b]


def _possible_links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of (node, n, bits): a spanning forest of the links its bitmaps allow."""
    out: list[tuple[int, int]] = []
    for group in row_groups(batches, ["bucket", "part"]):
        nodes, sizes = group["node"].to_pylist(), group["n"].to_numpy()
        maps = [np.frombuffer(b, dtype=np.uint64) for b in group["bits"].to_pylist()]
        union = Union(len(nodes))
        Tree(sizes, maps).join(union, lambda i, j: True)
        out += _edges(nodes, union)
        if len(out) > 10_000:
            yield _pairs(out)
            out = []
    yield _pairs(out)


def _links(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per group of (node, text): a spanning forest of the links."""
    out: list[tuple[int, int]] = []
    for group in row_groups(batches, ["bucket", "part"]):
        sets = [shingler()(t) for t in group["text"].to_pylist()]
        order = sorted(range(len(sets)), key=lambda i: (len(sets[i]), sets[i][:1].tolist()))
        sets, ids = [sets[i] for i in order], group["node"].to_pylist()
        nodes = [ids[i] for i in order]
        union = Union(len(nodes))
        first: dict[int, int] = {}
        for i, node in enumerate(nodes):
            union.join(first.setdefault(node, i), i)
        Tree(np.array([len(s) for s in sets]), [bitmap(s) for s in sets]).join(union, lambda i, j, sets=sets: linked(sets[i], sets[j]))
        out += _edges(nodes, union)
    yield _pairs(out)


def _pairs(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict({"a": pa.array([p[0] for p in pairs], pa.int64()), "b": pa.array([p[1] for p in pairs], pa.int64())})


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """rows (bucket, size, node, ...) dealt to parts: one for a bucket of up to block rows, else one for every
    two of its blocks."""
    count = f"CAST(ceil(size / {block}) AS int)"
    mine = f"CAST(pmod(xxhash64(node), {count}) AS int)"
    others = f"filter(sequence(0, {count} - 1), j -> j <> {mine})"
    parts = f"IF({count} = 1, array(0), transform({others}, j -> least(j, {mine}) * {count} + greatest(j, {mine})))"
    return rows.withColumn("part", F.explode(F.expr(parts))).drop("size")


def _grouped(rows: DataFrame, order: list[str], search: Callable) -> DataFrame:
    together = rows.repartition("bucket", "part").sortWithinPartitions("bucket", "part", *order)
    return together.mapInArrow(search, "a bigint, b bigint")


def _fingerprints(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches):
        sets = [shingler()(text) for text in batch.column(3).to_pylist()]
        with np.errstate(over="ignore"):
            sums = [(int(s.sum(dtype=np.uint64)), int(mixed(s * _MIX[0] + _MIX[1]).sum(dtype=np.uint64))) for s in sets]
        maps = [bitmap(s).tobytes() if len(s) > 3 else b"" for s in sets]
        keys = [run_keys(s) for s in sets]
        offsets = np.concatenate(([0], np.cumsum([len(k) for k in keys]))).astype(np.int32)
        yield pa.RecordBatch.from_arrays(
            [
                *batch.columns[:3],
                pa.array([len(s) for s in sets], pa.int64()),
                *[pa.array(np.array([x[i] for x in sums], dtype=np.uint64).view(np.int64)) for i in (0, 1)],
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*keys, np.empty(0, np.int64)]))),
                pa.array(maps, pa.binary()),
            ],
            names=["doc_id", "number", "text_id", "n", "s1", "s2", "keys", "bits"],
        )


def _candidates(nodes: DataFrame, buckets: DataFrame) -> DataFrame:
    """bucket, size, node, n and bits of the nodes (row, node, n, keys, bits) in buckets (key, size).

    The members of the buckets are written first, so that Spark knows how few they are: else it deals out the
    bitmaps of all nodes before it does.
    """
    members = nodes.select("row", F.explode("keys").alias("key")).join(buckets, "key").select(F.col("key").alias("bucket"), "size", "row")
    return written(members, "bucket-members").join(nodes.drop("keys"), "row").drop("row")


def cluster(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles and component_id (smallest doc_id reachable by links) of every row of docs.

    A text without a word, or null, has no shingles and links with nothing, not even its like. A row without
    doc_id takes part, but never names a component; a component without any id is null. Rows that share a
    doc_id are each compared. An empty table gives no rows. Other columns are ignored.
    """
    found = _placed(docs, block)
    root = F.when(F.col("n") > 0, F.coalesce("root", "number")).otherwise(F.col("number"))
    return found.select("doc_id", F.col("n").alias("n_shingles"), F.when(root < NO_ID, root).cast(docs.schema["doc_id"].dataType).alias("component_id"))


def _placed(docs: DataFrame, block: int = BLOCK) -> DataFrame:
    """doc_id, number, text_id, n, s1, s2, root and linked of every row of docs; the last two are null for a
    set that comes once and links with nothing."""
    number = f"coalesce(CAST(doc_id AS bigint), {NO_ID}L + (xxhash64(text) & {NO_ID // 2 - 1}L))"
    texts = docs.selectExpr("doc_id", f"{number} AS number", "xxhash64(text) AS text_id", "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, number bigint, text_id bigint, n bigint, s1 bigint, s2 bigint, keys array<bigint>, bits binary"
    numbered = texts.mapInArrow(_fingerprints, schema).withColumn("row", F.monotonically_increasing_id())
    prints = written(numbered, "shingles")
    of_sets = prints.where("n > 0").groupBy("s1", "s2").agg(F.min("number").alias("node"), F.min_by("row", "number").alias("row"), F.count("*").alias("copies"))
    sets = written(of_sets, "shingle-sets")

    # the keys and bitmaps stay where they are: only the rows that repeat a set are looked up
    repeated = sets.where("copies > 1").select("s1", "s2", F.col("row").alias("kept"))
    again = prints.where("n > 3").select("row", "s1", "s2").join(repeated, ["s1", "s2"]).where("row <> kept")
    again = written(again.select("row"), "repeated-sets")
    nodes = prints.where("n > 3").join(again, "row", "left_anti").selectExpr("row", "number AS node", "n", "keys", "bits")
    nodes = written(nodes, "shingle-nodes")
    rows = nodes.select("row", F.explode("keys").alias("key"))
    sizes = rows.groupBy("key").agg(F.count("*").alias("size"), F.bit_xor(F.xxhash64("row")).alias("who")).where("size > 1")
    # buckets of the same sets are one bucket; a set has one row here, so that no two hashes cancel
    buckets = written(sizes.groupBy("size", "who").agg(F.min("key").alias("key")).select("key", "size"), "shingle-buckets")
    possible = written(_grouped(_blocks(_candidates(nodes, buckets), block), ["n", "bits"], _possible_links).distinct(), "possible-links")

    clusters = components(possible, "possible-components")
    cluster_sizes = clusters.groupBy("root").agg(F.count("*").alias("size"))
    placed = written(clusters.join(cluster_sizes, "root").select(F.col("root").alias("bucket"), "size", "node"), "possible-clusters")
    to_compare = placed.join(texts.select(F.col("number").alias("node"), "text"), "node")
    links = written(_grouped(_blocks(to_compare, block), [], _links).distinct(), "links")

    roots = components(links, "components")
    grouped = sets.join(roots, "node", "left").select("s1", "s2", F.coalesce("root", "node").alias("root"), "copies", F.col("root").isNotNull().alias("linked"))
    # sets of one row that link with nothing need no lookup
    known = written(grouped.where("copies > 1 OR linked").select("s1", "s2", "root", "linked"), "component-of-set")
    return prints.select("doc_id", "number", "text_id", "n", "s1", "s2").join(known, ["s1", "s2"], "left")


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of docs of each group of equal or linked sets, with all columns: the smallest (doc_id, text_id),
    null ids last, text_id a hash of the text; of rows equal in both any one.

    Rows without a shingle all stay. Different texts of one doc_id are one node of the links: if one of them
    links, all are in its group. An empty table stays empty; columns of docs may have any names.
    """
    placed = _placed(docs).where("n > 0 AND root IS NOT NULL")
    group = "IF(linked, struct(root AS a, -1L AS b, 0L AS c), struct(0L AS a, s1 AS b, s2 AS c)) AS group"
    rank = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_id")
    keys = written(placed.selectExpr("doc_id", "text_id", group).groupBy("group", "doc_id", "text_id").agg(F.count("*").alias("rows")), "grouped-rows")
    firsts = keys.groupBy("group").agg(F.min(rank).alias("kept"))
    ranked = keys.join(firsts, "group").withColumn("first", F.expr("doc_id <=> kept.doc_id AND text_id = kept.text_id"))
    # rows that go, and those of which one stays
    decided = written(ranked.where("NOT first OR rows > 1").select(F.col("doc_id").alias("of_id"), F.col("text_id").alias("of_text"), "first"), "copies")
    same = "whole.doc_id <=> of_id AND xxhash64(whole.text) = of_text"
    whole = docs.select(F.struct("*").alias("whole"))
    # the decisions grow with the rows, so they are never broadcast; both joins read one shuffle of the rows
    decided = decided.hint("merge")
    stay = whole.join(decided, F.expr(same), "left_anti").select("whole.*")
    repeated = whole.join(decided.where("first").hint("merge"), F.expr(same)).groupBy("of_id", "of_text").agg(F.first("whole").alias("whole"))
    return stay.unionByName(repeated.select("whole.*"))
