"""Mixing sources to target weights, as DataFrame operations.

A source's rate is its target over its size. Every document is taken floor(rate) times, and once more if a
number drawn by hash from its id, its text and its number among equal rows is below the fraction that is left.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from masterlint.llm.common import WORD, written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
SEED = "mix"


def sources_with_targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """source, source_size and target of each source of sizes (source, size): one row per source.

    Sources in order of code points, null last, weigh weights over and over. Targets share the whole size by
    weight but stop at most times a source's own size; what is over goes to the others by weight. Filling all
    at one level does that at once: the source that first reaches its ceiling is the one with the least size
    per weight, so in that order the level follows from running sums. The windows run over rows of sources.
    """
    by_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(w) for w in weights])
    place = (F.row_number().over(by_name) - 1) % len(weights) + 1
    weighed = by_source.withColumn("weight", F.element_at(cycle, place.cast("int")))
    filling = Window.orderBy(F.expr(f"{most} * source_size / CAST(weight AS double)"), F.col("source").asc_nulls_last())
    before = filling.rowsBetween(Window.unboundedPreceding, -1)
    all_rows = Window.partitionBy()
    levels = (
        weighed.withColumn("total", F.sum("source_size").over(all_rows))
        .withColumn("full", F.coalesce(F.sum(F.lit(most) * F.col("source_size")).over(before), F.lit(0)))
        .withColumn("open_weight", F.sum("weight").over(all_rows) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        .withColumn("level", F.expr("(total - full) / CAST(open_weight AS double)"))
        .withColumn("open", F.expr(f"level * weight <= {most} * source_size"))
        .withColumn("fill", F.first(F.when(F.col("open"), F.col("level")), True).over(filling.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
    )
    target = F.least(F.col("fill") * F.col("weight"), F.lit(float(most)) * F.col("source_size"))
    return levels.select("source", "source_size", target.alias("target"))


def _sized(docs: DataFrame) -> DataFrame:
    return docs.withColumn("size", F.coalesce(F.regexp_count("text", F.lit(WORD)).cast("bigint"), F.lit(0).cast("bigint")))


#: A digest of the text, by which rows of one id or none draw apart.
DIGEST = "md5(encode(coalesce(text, ''), 'UTF-8'))"
#: A number in [0, 1).
DRAW = f"conv(substr(md5(concat('{SEED}', coalesce(CAST(doc_id AS string), ''), ':', digest, ':', place)), 1, 12), 16, 10) / 281474976710656D"


def _numbered(rows: DataFrame) -> DataFrame:
    """rows (doc_id, digest, lane, ...) with place, their number (from 0) among rows of equal doc_id and digest.

    A lane is the partition a row was read in. A lane's rows of a kind are numbered on from those of the lanes
    before, so no task sees more of a kind than one partition held, and of a kind numbers depend on no lane. Only
    rows that come repeatedly are shuffled for it.
    """
    lanes = rows.groupBy("doc_id", "digest", "lane").agg(F.count("*").alias("n"))
    of_kind = Window.partitionBy("doc_id", "digest")
    before = F.sum("n").over(of_kind.orderBy("lane")) - F.col("n")
    counted = lanes.select(F.col("doc_id").alias("of_id"), F.col("digest").alias("of_digest"), F.col("lane").alias("of_lane"), before.alias("before"), F.sum("n").over(of_kind).alias("total"))
    repeated = written(counted.where("total > 1").drop("total"), "mix-repeated")
    if repeated.isEmpty():
        return rows.withColumn("place", F.lit(0).cast("bigint"))
    joined = rows.join(repeated, F.expr("doc_id <=> of_id AND digest = of_digest AND lane = of_lane"), "left").drop("of_id", "of_digest")
    in_lane = F.row_number().over(Window.partitionBy("doc_id", "digest", "of_lane").orderBy("of_lane"))
    many = joined.where("before IS NOT NULL").withColumn("place", F.col("before") + in_lane - 1)
    return joined.where("before IS NULL").withColumn("place", F.lit(0).cast("bigint")).unionByName(many).drop("of_lane", "before")


def _copies(rows: DataFrame, targets: DataFrame) -> DataFrame:
    """rows with source_size, target and n_copies.

    targets is a written table of one row per source, so Spark knows its size and broadcasts it when it is
    small; else both sides are shuffled and a hot source's partition can be split.
    """
    few = targets.withColumnRenamed("source", "of_source")
    return (
        _numbered(rows).join(few, F.expr("source <=> of_source"), "left")
        .withColumn("rate", F.expr(f"CASE WHEN source_size = 0 THEN 0D ELSE least(target / source_size, {MOST_REPEATS}D) END"))
        .withColumn("n_copies", F.expr(f"CAST(floor(rate) AS bigint) + IF({DRAW} < rate - floor(rate), 1L, 0L)"))
    )


def plan(docs: DataFrame) -> DataFrame:
    """doc_id, source, size, source_size, target, n_copies and taken (size * n_copies) of every row of docs.

    Size is the number of words, 0 for a null text. A null source is a source. A source without words has
    target 0 and none of its documents are taken. Rows of one id, or of none, draw by their texts, and equal rows
    by their number. An empty table gives no rows. Other columns are ignored. The targets' windows run over a row
    for each source, in one task: sources are the few names a mixture has weights for, not host names.
    """
    sized = _sized(docs.select("doc_id", "source", "text")).selectExpr("doc_id", "source", "size", f"{DIGEST} AS digest", "spark_partition_id() AS lane")
    sized = written(sized, "mix-sizes")
    targets = written(sources_with_targets(sized), "mix-targets")
    return _copies(sized, targets).select(
        "doc_id", "source", "size", "source_size", "target", "n_copies", F.expr("size * n_copies").alias("taken")
    )


def mix(docs: DataFrame) -> DataFrame:
    """The mixture: each row of docs as many times as plan() says, with all columns of docs.

    Columns may have any names besides doc_id, source and text: they travel in one struct.
    """
    targets = written(sources_with_targets(_sized(docs.select("source", "text"))), "mix-targets")
    rows = docs.select(F.struct("*").alias("whole")).selectExpr("whole", "whole.doc_id", "whole.source", "whole.text")
    rows = rows.selectExpr("whole", "doc_id", "source", f"{DIGEST} AS digest", "spark_partition_id() AS lane")
    taken = _copies(rows, targets).where("n_copies > 0")
    return taken.select("whole", F.explode(F.expr("sequence(1L, n_copies)"))).select("whole.*")
