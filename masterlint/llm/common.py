"""Helpers that several operators share."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word, as a regular expression for Java, Python and DuckDB.
WORD = r"[^\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see. Only a session on one machine gets a folder of its own where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="masterlint-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_path(spark: SparkSession, label: str) -> str:
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def written(df: DataFrame, label: str) -> DataFrame:
    """df as a table in the shared folder: lineage ends there, and a lost executor costs no recomputation."""
    spark, schema = df.sparkSession, df.schema
    path = new_path(spark, label)
    df.write.parquet(path, compression="zstd")
    return spark.read.schema(schema).parquet(path)


def let(value: str, name: str, body: str) -> str:
    """SQL for body, in which name is value, computed once per row."""
    return f"element_at(transform(array({value}), {name} -> {body}), 1)"


def pieces(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """batches in slices of a few rows, so that only their texts are Python objects at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def row_groups(batches: Iterable[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """Runs of equal keys in batches that are sorted by the keys; holds one run and one batch at a time."""
    held: list[pa.RecordBatch] = []
    last: tuple | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = [batch.column(batch.schema.get_field_index(k)).to_pylist() for k in keys]
        at = list(zip(*values, strict=True))
        begin = 0
        for i, key in enumerate(at):
            if key != last:
                if i > begin:
                    held.append(batch.slice(begin, i - begin))
                if held:
                    yield pa.Table.from_batches(held)
                held, begin, last = [], i, key
        held.append(batch.slice(begin))
    if held:
        yield pa.Table.from_batches(held)


def components(edges: DataFrame, label: str) -> DataFrame:
    """Connected components of edges (a, b): one row (node, root) per node, root the smallest node reachable.

    Alternates two steps: every node hands its larger neighbours, then its smaller ones, to the smallest node
    it knows. Each round is written to the shared folder; it ends when a round changes nothing. Nothing of the
    graph reaches the driver but a row count and a checksum. The joins are on computed keys, below which Spark
    deals the edges anew, so that adaptive execution splits a node with very many neighbours.
    """

    def least(df: DataFrame) -> DataFrame:
        return df.groupBy("a").agg(F.min("b").alias("m")).selectExpr("CAST(a AS string) AS of", "m")

    def state(df: DataFrame) -> tuple:
        return tuple(df.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b"))).first())

    edges = edges.where("a <> b").selectExpr("greatest(a, b) AS a", "least(a, b) AS b").distinct()
    edges = written(edges, label)
    before = state(edges)
    while before[0]:
        # the least neighbour of b, if it is less than b; it knows no other, so none of its larger ones is asked
        large = edges.join(least(edges), F.expr("CAST(b AS string) = of"), "left").selectExpr("a", "coalesce(m, b) AS b").distinct()
        small = large.join(least(large), F.expr("CAST(a AS string) = of")).selectExpr("inline(array(struct(a, m AS b), struct(b AS a, m AS b)))")
        edges = written(small.where("a <> b").distinct(), label)
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.selectExpr("b AS node", "b AS root").distinct()
    return edges.selectExpr("a AS node", "b AS root").unionByName(roots)
