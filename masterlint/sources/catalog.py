"""Where the staging tables come from."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from masterlint.functions import keys
from masterlint.functions.conditions import text
from masterlint.sources import samples
from masterlint.sources.schemas import SOURCES, always_fits, read_as

REJECTED_SCHEMA = T.StructType([T.StructField(name, T.StringType()) for name in ("SOURCE_TABLE", "ROW_KEY", "COLUMN_NAME", "VALUE")])


class Catalog:
    """The staging tables as lazy DataFrames with declared types and normalised keys.

    A value that is none of its column's type is read as null, so that it concerns only the rules on its column,
    and listed by ``rejected``.
    """

    def __init__(self, spark: SparkSession, load: Callable[[str], DataFrame]):
        self.spark = spark
        self._load = load
        self._tables: dict[str, DataFrame] = {}
        self._rejected: dict[str, DataFrame] = {}

    @classmethod
    def of_samples(cls, spark: SparkSession, sample_dir: str) -> Catalog:
        return cls(spark, lambda code: samples.derive(spark, sample_dir, code))

    @classmethod
    def of_parquet(cls, spark: SparkSession, root: str) -> Catalog:
        def load(code: str) -> DataFrame:
            source = SOURCES[code]
            return spark.read.parquet(f"{root}/{source.table}")

        return cls(spark, load)

    @classmethod
    def of_database(cls, spark: SparkSession, database: str) -> Catalog:
        return cls(spark, lambda code: spark.table(f"{database}.{SOURCES[code].table}"))

    @classmethod
    def of_frames(cls, spark: SparkSession, frames: dict[str, DataFrame]) -> Catalog:
        return cls(spark, frames.__getitem__)

    def table(self, code: str) -> DataFrame:
        if code not in self._tables:
            self._tables[code] = self._prepare(code)
        return self._tables[code]

    def rejected(self) -> DataFrame | None:
        """The values of the tables taken so far that are none of their columns' types, a row each: SOURCE_TABLE,
        ROW_KEY (as delivered), COLUMN_NAME and VALUE. None if the types delivered leave no room for any; tables
        of which that is true are not read."""
        return reduce(DataFrame.unionByName, self._rejected.values()) if self._rejected else None

    def _prepare(self, code: str) -> DataFrame:
        source = SOURCES[code]
        loaded = self._load(code)
        there = {name.upper() for name in loaded.columns}
        if missing := [name for name in source.schema.names if name.upper() not in there]:
            raise ValueError(f"{source.table} has no column {', '.join(missing)}")
        given = {field.name.upper(): field.dataType for field in loaded.schema}
        kinds = {field.name: read_as(field.dataType, given[field.name.upper()]) for field in source.schema}
        doubtful = {name: kind for name, kind in kinds.items() if not always_fits(given[name.upper()], kind)}
        if doubtful:
            self._rejected[code] = _rejected(loaded, code, doubtful)
        cast = {name: "try_cast" if name in doubtful else "cast" for name in kinds}
        df = loaded.selectExpr(*[f"{cast[name]}({name} AS {kind.simpleString()}) AS {name}" for name, kind in kinds.items()])
        if source.key == "MATNR":
            df = keys.material_keys(df)
        if source.key == "LIFNR":
            df = keys.vendor_keys(df)
        if code == "M":
            df = keys.substitute_key(df)
        if code == "C":
            df = keys.plant_keys(df)
        return df


def _rejected(loaded: DataFrame, code: str, doubtful: dict[str, T.DataType]) -> DataFrame:
    source = SOURCES[code]

    def cell(name: str, kind: T.DataType) -> str:
        bad = f"{name} IS NOT NULL AND try_cast({name} AS {kind.simpleString()}) IS NULL"
        return f"CASE WHEN {bad} THEN named_struct('COLUMN_NAME', {text(name)}, 'VALUE', cast({name} AS string)) END"

    cells = ", ".join(cell(name, kind) for name, kind in doubtful.items())
    key = f"cast({source.key} AS string) AS ROW_KEY"
    return loaded.selectExpr(f"{text(source.table)} AS SOURCE_TABLE", key, f"inline(array_compact(array({cells})))").select(*REJECTED_SCHEMA.names)
