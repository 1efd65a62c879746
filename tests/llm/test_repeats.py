"""Rows without an id or with the same, hot nodes, and clashing names in mixing, components and the pipeline."""

from __future__ import annotations

import re

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from masterlint.llm import common, jaccard_join, mixing
from masterlint.llm.oracle import ORACLE_SQL
from masterlint.llm.queries import QUERIES


def taken(planned):
    rows = planned.groupBy("source").agg(F.sum("taken").alias("taken"), F.first("target").alias("target")).collect()
    return {r.source: (r.taken, r.target) for r in rows}


@pytest.mark.parametrize("kind", ["none", "few", "equal"])
def test_rows_without_own_ids_draw_apart(spark, kind):
    rows = spark.range(20_000).selectExpr(
        {"none": "CAST(NULL AS bigint)", "few": "id % 3", "equal": "7L"}[kind] + " AS doc_id",
        "concat('a b c d e', " + ("''" if kind == "equal" else "CAST(id AS string)") + ") AS text",
        "element_at(array('s1', 's2', 's3', 's4'), CAST(pmod(id, 4) AS int) + 1) AS source",
    )
    for amount, target in taken(mixing.plan(rows)).values():
        assert abs(amount - target) < 0.05 * target
    mixed = mixing.mix(rows)
    assert sorted(map(tuple, mixed.groupBy("source").count().collect())) == sorted(
        (s, n // 5) for s, (n, _) in taken(mixing.plan(rows)).items()
    )
    assert mixing.plan(rows.where("false")).count() == 0


def test_mixing_as_the_sql_with_repeated_rows(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    docs = docs.unionByName(docs.where("doc_id < 40")).unionByName(docs.where("doc_id < 20").withColumn("doc_id", F.lit(None).cast("bigint")))
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    found = QUERIES["op2_source_mixing"](spark, str(tmp_path))
    expected = connection.execute(f"SELECT {', '.join(found.columns)} FROM ({ORACLE_SQL['op2_source_mixing']})").fetchall()
    same = lambda rows: sorted([(*r[:3], round(r[3], 6), *r[4:]) for r in rows], key=str)
    assert same(map(tuple, found.collect())) == same(expected)


def test_components_of_stars_and_chains(spark):
    star = spark.range(1, 3000).selectExpr("id AS a", "0L AS b")
    turned = spark.range(10_000, 12_000).selectExpr("20000L AS a", "id AS b")
    chain = spark.range(30_000, 30_050).selectExpr("id AS a", "id + 1 AS b")
    edges = star.unionByName(turned).unionByName(chain).unionByName(spark.sql("SELECT 5L AS a, 5L AS b"))
    roots = {r.node: r.root for r in common.components(edges, "test-components").collect()}
    assert roots == {**dict.fromkeys(range(3000), 0), **dict.fromkeys([*range(10_000, 12_000), 20_000], 10_000), **dict.fromkeys(range(30_000, 30_051), 30_000)}


@pytest.mark.parametrize("hub", ["least", "largest"])
def test_a_hub_is_split(spark, tmp_path, monkeypatch, hub):
    # a third of all edges at one node
    star = spark.range(1, 100_000).selectExpr("if('" + hub + "' = 'least', id, 10000000L) AS a", "if('" + hub + "' = 'least', 0L, id) AS b")
    pairs = spark.range(100_000).selectExpr("20000000 + 2 * id AS a", "20000001 + 2 * id AS b")
    settings = {
        "spark.sql.shuffle.partitions": "40",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    plans, before = [], {k: spark.conf.get(k) for k in settings}
    real = common.written

    def written(df, label):
        out = real(df, label)
        df.collect()
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(common, "written", written)
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        found = common.components(star.unionByName(pairs), "test-hub")
        assert found.select("root").distinct().count() == 100_001
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert any(re.search(r"SortMergeJoin\(skew=true\)", p) for p in plans)


def test_one_row_of_each_group_stays(spark):
    text = " ".join(f"word{i}" for i in range(50))
    near = text + " more"
    rows = [(None, near), (None, text), (None, text), (3, text), (3, text), (4, near), (5, "other words than these are here"), (5, "other words than these are here")]
    rows += [(6, None), (None, None), (7, ""), (8, ""), (9, "alone it stands with its own words")]
    docs = spark.createDataFrame([(*r, 1, "s", "l") for r in rows], "doc_id bigint, text string, copy_id int, score string, lang_pred string")
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    found = sorted(((r.doc_id or 0), r.text or "") for r in kept.collect())
    assert found == sorted([(3, text), (5, rows[6][1]), (6, ""), (0, ""), (7, ""), (8, ""), (9, rows[12][1])])
    only = docs.where("doc_id IS NULL")
    assert jaccard_join.one_of_each(only).where("text IS NOT NULL").count() == 1
    assert jaccard_join.one_of_each(docs.where("false")).count() == 0


def test_pipeline_stages_take_any_column_names(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    odd = docs.limit(40).selectExpr("*", "1 AS score", "'x' AS lang_pred", "doc_id AS copy_id", "2 AS size", "3 AS whole", "4 AS digest", "5 AS place", "6 AS `two words`")
    odd = odd.unionByName(odd.limit(3)).unionByName(odd.limit(2).withColumn("doc_id", F.lit(None).cast("bigint")).withColumn("source", F.lit(None).cast("string")))
    for table in (odd, odd.where("false")):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, table, "/root/testdata/sf0.001")
            assert out.columns == table.columns
            out.count()
        corpus_pipeline.STAGES[-1][1](spark, table, "/root/testdata/sf0.001").count()


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Cluster:
        class sparkContext:  # noqa: N801
            master = "spark://host:7077"

        class conf:  # noqa: N801
            @staticmethod
            def get(name, default):
                return default

    with pytest.raises(ValueError, match=r"spark.checkpoint.dir"):
        common.shared_folder(Cluster)
