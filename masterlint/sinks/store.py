"""Result tables: the append-only results, what could not be read, and the daily cube, replaced or merged."""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass
from datetime import UTC, date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from masterlint.plans.report import DIMENSION_SCHEMA, FACT_SCHEMA, MAXIMA, daily_cube, daily_maxima, described, stamped

RESULTS = "FACT_DQ_RESULTS"
CUBE = "CUBE_DQ"
DIMENSION = "DIM_DQ_RULES"
PARTITION = "EXECUTION_DATE"
#: Result files that the cube holds.
MERGED = "CUBE_DQ_MERGED"
#: Values that a run could not read, by run.
REJECTED = "FACT_DQ_REJECTED"
RUN = "RUN_ID"
#: Result files whose rows have gone into a day's packed file.
PACKED = "FACT_DQ_RESULTS_PACKED"
#: A name in the form of a UUID from a text.
NAMED_ID = r"regexp_replace(md5({}), '^(.{{8}})(.{{4}})(.{{4}})(.{{4}})', '$1-$2-$3-$4-')".format


@dataclass(frozen=True)
class Store:
    """Tables under a path, or in a metastore database if ``database`` is set."""

    spark: SparkSession
    root: str | None = None
    database: str | None = None

    def read(self, name: str) -> DataFrame:
        if self.database:
            return self.spark.table(f"{self.database}.{name}")
        return self.spark.read.parquet(f"{self.root}/{name}")

    def write(self, name: str, df: DataFrame, mode: str, partition: str | None = None) -> None:
        writer = df.write.mode(mode)
        if partition:
            writer = writer.partitionBy(partition)
        if self.database:
            writer.format("parquet").saveAsTable(f"{self.database}.{name}")
        else:
            writer.parquet(f"{self.root}/{name}")

    def append_results(self, graded: DataFrame, run_id: str | None = None, at: datetime | None = None) -> str:
        """Adds one row per rule to the day's partition, once for each ``run_id``, which is returned.

        The rows are written aside and then published as one file, named after the run, by a rename. A run that
        fails before it has added nothing; one that is repeated, whether it failed or not, finds its file and
        adds nothing more. Ids of results follow from the run's and the rule's. ``graded`` should be
        materialised: it is evaluated again on a task retry.
        """
        run_id, at = run_id or uuid.uuid4().hex, at or datetime.now(UTC)
        if not re.fullmatch(r"[\w.-]+", run_id):
            raise ValueError(f"run id {run_id!r} cannot name a file")
        day = at.astimezone(UTC).date()
        rows = stamped(graded, F.expr(NAMED_ID(f"concat('{run_id}-', RULE_ID)")), F.lit(at))
        if self.database and not self.has(RESULTS):
            self.write(RESULTS, rows.limit(0), "append", PARTITION)
        table = self._location(RESULTS)
        files = self._files(table)
        name = f"run-{run_id}.parquet"
        # on whatever day the first attempt was made
        packed = self.has(PACKED) and not self.read(PACKED).filter(F.endswith("FILE", F.lit(f"/{name}"))).isEmpty()
        if not packed and not files.globStatus(self._path(f"{table}/{PARTITION}=*/{name}")):
            aside = f"{table}/_staging/{uuid.uuid4().hex}"
            try:
                rows.drop(PARTITION).coalesce(1).write.parquet(aside)
                files.mkdirs(self._path(f"{table}/{PARTITION}={day}"))
                for part in files.globStatus(self._path(f"{aside}/part-*.parquet")):
                    self._publish(part.getPath(), f"{table}/{PARTITION}={day}/{name}")
            finally:
                files.delete(self._path(aside), True)
        if self.database:
            self.spark.sql(f"ALTER TABLE {self.database}.{RESULTS} ADD IF NOT EXISTS PARTITION ({PARTITION} = '{day}')")
            self.spark.catalog.refreshTable(f"{self.database}.{RESULTS}")
        return run_id

    def _publish(self, part, target: str) -> None:
        files = self._files(target)
        if not files.rename(part, self._path(target)) and not files.exists(self._path(target)):
            raise OSError(f"{target} could not be published")

    def _location(self, name: str) -> str:
        if not self.database:
            return f"{self.root}/{name}"
        rows = self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.database}.{name}")
        return rows.filter("col_name = 'Location'").first().data_type

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)

    def _files(self, path: str):
        return self._path(path).getFileSystem(self.spark._jsc.hadoopConfiguration())

    def results(self, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        """The recorded results; days outside the range are not read."""
        rows = self.read(RESULTS)
        if first_day:
            rows = rows.filter(F.col(PARTITION) >= F.lit(first_day).cast("date"))
        if last_day:
            rows = rows.filter(F.col(PARTITION) <= F.lit(last_day).cast("date"))
        return rows.select(*FACT_SCHEMA.names)

    def dimension(self) -> DataFrame:
        return self.read(DIMENSION).select(*DIMENSION_SCHEMA.names)

    def replace_cube(self, dimension: DataFrame, first_day: str | None = None, last_day: str | None = None) -> DataFrame:
        """The cube, of which the chosen days (default: all days with results) are written anew.

        A day is a partition, and only the partitions written are replaced, when all of them are complete: other
        days stay, and a failed job leaves the cube as it was.
        """
        self._put_days(daily_cube(self.results(first_day, last_day), dimension))
        return self.read(CUBE).select(*self._cube_columns())

    @staticmethod
    def _cube_columns() -> list[str]:
        return ["RULE_ID", PARTITION, *MAXIMA, *[name for name in DIMENSION_SCHEMA.names if name != "RULE_ID"]]

    def _put_days(self, cube: DataFrame) -> None:
        self._put_partitions(CUBE, cube.select(*[c for c in self._cube_columns() if c != PARTITION], PARTITION), PARTITION)

    def _put_partitions(self, name: str, rows: DataFrame, partition: str) -> None:
        """Writes the partitions in rows, whose last column is the partition's; others stay."""
        if self.database and self.has(name):
            # as an option of the writer it would not reach the metastore's table, which then lost its other days
            setting = "spark.sql.sources.partitionOverwriteMode"
            before = self.spark.conf.get(setting)
            self.spark.conf.set(setting, "dynamic")
            try:
                rows.write.mode("overwrite").insertInto(f"{self.database}.{name}")
            finally:
                self.spark.conf.set(setting, before)
        elif self.database:
            self.write(name, rows, "overwrite", partition)
        else:
            writer = rows.write.mode("overwrite").partitionBy(partition)
            writer.option("partitionOverwriteMode", "dynamic").parquet(f"{self.root}/{name}")

    def put_rejected(self, rejected: DataFrame, run_id: str) -> dict[tuple[str, str], int]:
        """Keeps the values that a run could not read as the run's partition, and returns their numbers by table
        and column. A repeated run writes its partition anew; nothing is written where there is no such value."""
        counted = rejected.groupBy("SOURCE_TABLE", "COLUMN_NAME").count().collect()
        if counted:
            self._put_partitions(REJECTED, rejected.withColumn(RUN, F.lit(run_id)), RUN)
        return {(row.SOURCE_TABLE, row.COLUMN_NAME): row["count"] for row in counted}

    def pack_results(self, before: date | None = None) -> list[str]:
        """Puts the result files of each day into one, and returns the days packed.

        Only days before ``before`` (default and latest: yesterday, UTC) are packed, as runs add to the present
        one. The runs' files are noted first, so that a packed run repeated still adds nothing; then the day's
        partition is replaced. A day fails as a whole and leaves its files; the next packing makes it good. The
        cube takes a packed file for merged if all that went into it were.
        """
        yesterday = datetime.now(UTC).date() - timedelta(days=1)
        limit = min(before or yesterday, yesterday).isoformat()
        by_day: dict[str, list[str]] = {}
        for file in self.result_files():
            by_day.setdefault(file.partition("/")[0].partition("=")[2], []).append(file)
        days = sorted(day for day, files in by_day.items() if day < limit and len(files) > 1)
        table = self._location(RESULTS) if days else ""
        for day in days:
            merged = self.has(MERGED) and set(by_day[day]) <= {row.FILE for row in self.read(MERGED).collect()}
            self._note(PACKED, by_day[day])
            aside = f"{table}/_staging/{uuid.uuid4().hex}"
            try:
                self.read(RESULTS).filter(F.col(PARTITION) == F.lit(day).cast("date")).coalesce(1).write.parquet(aside)
                rows = self.spark.read.parquet(aside).select(*FACT_SCHEMA.names, PARTITION)
                self._put_partitions(RESULTS, rows.coalesce(1), PARTITION)
            finally:
                self._files(aside).delete(self._path(aside), True)
            if merged:
                self._note(MERGED, [file for file in self.result_files() if file.startswith(f"{PARTITION}={day}/")])
        if self.database and days:
            self.spark.catalog.refreshTable(f"{self.database}.{RESULTS}")
        return days

    def _note(self, name: str, files: list[str]) -> None:
        self.write(name, self.spark.createDataFrame([(file,) for file in files], "FILE string").coalesce(1), "append")

    def result_files(self) -> list[str]:
        """The files of the recorded results, relative to their table: one for each run."""
        table = self._location(RESULTS)
        found = self._files(table).globStatus(self._path(f"{table}/{PARTITION}=*/*.parquet")) or []
        return sorted("/".join(file.getPath().toString().rsplit("/", 2)[1:]) for file in found)

    def merge_cube(self, dimension: DataFrame) -> DataFrame:
        """The cube with the result files that it doesn't hold yet; no other result is read.

        Maxima of maxima are maxima, so the stored days are merged with the new files' and written anew; their
        descriptions are the dimension's, those of other days stay (replace_cube renews all). The files merged
        are noted last: a run that fails before is made good by the next, and merging a file twice changes
        nothing. What the driver holds are file names, one for each run.
        """
        held = {row.FILE for row in self.read(MERGED).collect()} if self.has(MERGED) and self.has(CUBE) else set()
        fresh = [file for file in self.result_files() if file not in held]
        if fresh:
            table = self._location(RESULTS)
            facts = self.spark.read.option("basePath", table).parquet(*[f"{table}/{file}" for file in fresh])
            columns = ["RULE_ID", PARTITION, *MAXIMA]
            daily = daily_maxima(facts.select(*columns))
            if held:
                days = sorted({file.partition("/")[0].partition("=")[2] for file in fresh})
                stored = self.read(CUBE).filter(F.col(PARTITION).isin([F.lit(day).cast("date") for day in days]))
                daily = daily_maxima(daily.unionByName(stored.select(*columns)))
            aside = f"{table}/_staging/{uuid.uuid4().hex}"
            try:
                # a day cannot be read and replaced at once
                described(daily, dimension).write.parquet(aside)
                self._put_days(self.spark.read.parquet(aside))
            finally:
                self._files(aside).delete(self._path(aside), True)
            self._note(MERGED, fresh)
        return self.read(CUBE).select(*self._cube_columns())

    def has(self, name: str) -> bool:
        if self.database:
            return self.spark.catalog.tableExists(f"{self.database}.{name}")
        return self._files(f"{self.root}/{name}").exists(self._path(f"{self.root}/{name}"))
