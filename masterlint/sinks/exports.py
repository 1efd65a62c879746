"""CSV exports of failing rows."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from masterlint.operators.listing import violations
from masterlint.operators.masks import failing_rows
from masterlint.rules.model import Rule
from masterlint.sources.catalog import Catalog

# Rows of one group of copies that may stay together in a sorted file.
COPIES_TOGETHER = 100_000


def wanted(rule: Rule, status: str, rate: float) -> bool:
    """Whether a result calls for an export of its failing rows."""
    return status == "FAILED" if rule.export_when_failed else rate != 100


def gate(graded: DataFrame, rules: Iterable[Rule]) -> DataFrame:
    """RULE_ID and WANTED, the decision of ``wanted`` for every graded row."""
    strict = [rule.id for rule in rules if rule.export_when_failed]
    failed, unclean = F.col("STATUS") == "FAILED", F.col("PASSED_PERCENTAGE") != 100
    return graded.select("RULE_ID", F.when(F.col("RULE_ID").isin(strict), failed).otherwise(unclean).alias("WANTED"))


def directory(root: str, rule: Rule, at: datetime) -> str:
    """The export's directory of part files."""
    return f"{root}/REGLA_DQ_{rule.id}_{rule.tag}_{at:%Y%m%d_%H%M%S}"


def _direction(item: str) -> Column:
    name, _, direction = item.partition(" ")
    return F.desc(name) if direction == "DESC" else F.asc(name)


def counted(rows: DataFrame) -> DataFrame:
    """The different rows with their number of COPIES_, counted on the map side, where most collapse."""
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("COPIES_"))


def in_order(copies: DataFrame, order: tuple[str, ...]) -> DataFrame:
    """Rows of ``counted`` globally sorted, with copies spread over the sort's partitions.

    A range partitioning cannot split equal rows. So they are sorted as numbered chunks that it can split, and
    written out again afterwards. The other columns break ties for the same reason.
    """
    columns = [name for name in copies.columns if name != "COPIES_"]
    leading = [item.partition(" ")[0] for item in order]
    ties = [name for name in columns if name not in leading]
    chunked = copies.select("*", F.explode(F.expr(f"sequence(0L, (COPIES_ - 1) div {COPIES_TOGETHER})")).alias("CHUNK_"))
    ordered = chunked.orderBy(*[_direction(item) for item in order], *ties, "CHUNK_")
    size = f"least({COPIES_TOGETHER}, COPIES_ - CHUNK_ * {COPIES_TOGETHER})"
    return ordered.selectExpr(*columns, f"explode(array_repeat(0, cast({size} AS int))) AS COPY_").drop("COPY_")


def _with_keys(rule: Rule) -> tuple[Rule, list[str]]:
    """The rule with the hidden columns of its listing shown, and their names."""
    listing = rule.listing
    shown = replace(rule, listing=replace(listing, columns=(*listing.columns, *listing.hidden)))
    return shown, [item.rpartition(" ")[2] for item in listing.hidden]


def export_rows(catalog: Catalog, rule: Rule) -> DataFrame:
    """The failing rows of ``rule`` in the order its export asks for."""
    if not rule.listing.order:
        return violations(catalog, rule)
    with_keys, hidden = _with_keys(rule)
    return in_order(counted(violations(catalog, with_keys)), rule.listing.order).drop(*hidden)


def stage(catalog: Catalog, codes: tuple[str, ...], rules: list[Rule], path: str) -> None:
    """Writes the failing rows of all ``rules`` on the relation of ``codes``, read once, a folder for each rule."""
    failing_rows(catalog, codes, rules).write.partitionBy("RULE_ID").parquet(path)


def staged_rows(catalog: Catalog, rule: Rule, path: str) -> DataFrame:
    """``export_rows`` of a rule from what ``stage`` has written, with the types of its listing."""
    with_keys, hidden = _with_keys(rule)
    schema = violations(catalog, with_keys).schema
    staged = catalog.spark.read.schema("VALUES array<string>, COPIES bigint, RULE_ID int").parquet(path).filter(F.col("RULE_ID") == rule.id)
    columns = [F.col("VALUES")[i].cast(field.dataType).alias(field.name) for i, field in enumerate(schema)]
    return in_order(staged.select(*columns, F.col("COPIES").alias("COPIES_")), rule.listing.order).drop(*hidden)


def export(catalog: Catalog, rule: Rule, root: str, at: datetime, staged: str | None = None) -> str:
    """Writes the failing rows of ``rule``, from the ``staged`` ones if given, as semicolon-separated files with a header."""
    path = directory(root, rule, at)
    rows = export_rows(catalog, rule) if staged is None else staged_rows(catalog, rule, staged)
    (
        rows.write.mode("overwrite")
        .option("header", True)
        .option("sep", ";")
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
