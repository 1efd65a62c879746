"""Result tables, exports and the whole run."""

from __future__ import annotations

import csv
from datetime import UTC, date, datetime
from pathlib import Path

import pytest

from masterlint.operators.listing import violations
from masterlint.plans.report import DIMENSION_SCHEMA, FACT_SCHEMA, daily_cube
from masterlint.plans import run
from masterlint.plans.run import ExportErrors, report, run_rules
from masterlint.rules.dimension import description
from masterlint.rules.registry import all_rules
from masterlint.sinks import exports
from masterlint.sinks.store import MERGED, RESULTS, Store
from masterlint.sources.catalog import Catalog
from masterlint.sources.schemas import SOURCES


def read_parts(folder: str) -> tuple[list[str], list[list[str]]]:
    header, rows = [], []
    for part in sorted(Path(folder).glob("part-*.csv")):
        with part.open(newline="", encoding="utf8") as lines:
            header, *more = list(csv.reader(lines, delimiter=";"))
            rows += more
    return header, rows


def vendors(spark, names: list[str | None]) -> Catalog:
    source = SOURCES["W"]
    frames = {
        "W": spark.createDataFrame([("0000010001", "DP", name) for name in names], source.schema),
        "V": spark.createDataFrame(
            [{"LIFNR": "0000010001", "NAME1": 'semi;colon "quoted"'}], "LIFNR string, NAME1 string"
        ).selectExpr("*", *[f"cast(NULL AS string) AS {n}" for n in SOURCES["V"].schema.names if n not in ("LIFNR", "NAME1")]),
    }
    return Catalog.of_frames(spark, frames)


def test_export_round_trip(spark, tmp_path):
    catalog = vendors(spark, [" padded ", "", "x;y", None])
    rule = all_rules()[120]
    at = datetime(2024, 3, 1, 8, 5, 9, tzinfo=UTC)
    path = exports.export(catalog, rule, str(tmp_path), at)
    assert Path(path).name == "REGLA_DQ_120_WYT3_20240301_080509"
    header, rows = read_parts(path)
    assert header == ["LIFNR", "NAME1", "PARVW", "LIFN2"]
    assert sorted(row[3] for row in rows) == ["", "", " padded ", "x;y"]
    assert {row[1] for row in rows} == {'semi;colon "quoted"'}
    # a null is nothing, a blank is a quoted nothing
    endings = [line.rsplit(";", 1)[1] for part in Path(path).glob("part-*.csv") for line in part.read_text().splitlines()[1:]]
    assert sorted(endings)[:2] == ["", " padded "] and '""' in endings
    back = spark.read.csv(
        path, header=True, sep=";", escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    )
    filled = "LIFN2 <> ''"
    assert {tuple(row) for row in back.filter(filled).collect()} == {
        tuple(row) for row in violations(catalog, rule).filter(filled).collect()
    }


@pytest.mark.parametrize("rule_id", [1, 13, 29, 49, 50, 120])
def test_exports_are_sorted_and_whole(spark, catalog, tmp_path, monkeypatch, rule_id):
    monkeypatch.setattr(exports, "COPIES_TOGETHER", 2)
    rule = all_rules()[rule_id]
    expected = violations(catalog, rule)
    _, rows = read_parts(exports.export(catalog, rule, str(tmp_path), datetime.now(UTC)))
    assert sorted(rows) == sorted(["" if v is None else str(v) for v in row] for row in expected.collect())
    if not rule.listing.hidden:
        name, _, direction = rule.listing.order[0].partition(" ")
        keys = [row[expected.columns.index(name)] for row in rows]
        assert keys == sorted(keys, reverse=direction == "DESC")


def test_sorted_copies_are_all_kept(spark, monkeypatch):
    monkeypatch.setattr(exports, "COPIES_TOGETHER", 10)
    rows = spark.range(100).selectExpr("if(id < 67, 1, id) AS k", "'same' AS v")
    assert sorted(r.k for r in exports.in_order(exports.counted(rows), ("k DESC",)).collect()) == sorted(r.k for r in rows.collect())


def test_gate():
    strict, usual = all_rules()[1], all_rules()[8]
    assert not exports.wanted(strict, "PASSED", 99.5)
    assert exports.wanted(strict, "FAILED", 98.0)
    assert exports.wanted(usual, "PASSED", 99.5)
    assert exports.wanted(usual, "FAILED", -3.0)
    assert not exports.wanted(usual, "PASSED", 100.0)
    assert {rule.id for rule in all_rules().values() if rule.export_when_failed} == {1, 2, 3, 22}


def test_gate_of_a_table_is_the_gate_of_its_rows(spark):
    cases = [(i, rate, status) for i in (1, 8) for rate, status in ((100.0, "PASSED"), (99.5, "PASSED"), (99.0, "ERROR"), (-3.0, "FAILED"))]
    graded = spark.createDataFrame(cases, "RULE_ID long, PASSED_PERCENTAGE double, STATUS string")
    found = [tuple(row) for row in exports.gate(graded, all_rules().values()).collect()]
    assert sorted(found) == sorted((i, exports.wanted(all_rules()[i], status, rate)) for i, rate, status in cases)


def test_run_records_exports_and_reports(spark, catalog, tmp_path):
    store = Store(spark, str(tmp_path / "store"))
    rules = [all_rules()[i] for i in (1, 22, 75, 113, 119)]
    first = run_rules(catalog, rules, store, str(tmp_path / "exports"))
    # rule 22 passes its own gate, rule 113 is clean
    assert sorted(first.exports) == [1, 75, 119]
    for rule_id, path in first.exports.items():
        assert len(read_parts(path)[1]) == violations(catalog, all_rules()[rule_id]).count()
    run_rules(catalog, rules, store)
    facts = store.results()
    assert facts.count() == 2 * len(rules)
    assert facts.select("RESULT_ID").distinct().count() == 2 * len(rules)
    assert facts.columns == FACT_SCHEMA.names
    today = datetime.now(UTC).date()
    assert (tmp_path / "store" / RESULTS / f"EXECUTION_DATE={today}").is_dir()
    assert store.results(first_day="2999-01-01").count() == 0
    dimension = spark.createDataFrame([description(rules[0], datetime(2024, 1, 1))], DIMENSION_SCHEMA)
    cube = report(store, dimension)
    assert cube.count() == len(rules)
    assert {row.RULE_ID for row in cube.filter("RULE_NAME IS NOT NULL").collect()} == {1}


def test_a_failing_export_leaves_the_others(spark, catalog, tmp_path, monkeypatch):
    def export(catalog, rule, *rest):
        if rule.id == 3:
            raise OSError("disk")
        return exports.export(catalog, rule, *rest)

    monkeypatch.setattr(run, "export", export)
    store = Store(spark, str(tmp_path / "store"))
    with pytest.raises(ExportErrors, match="rule 3 failed: disk") as raised:
        run_rules(catalog, [all_rules()[i] for i in (2, 3, 12)], store, str(tmp_path / "exports"))
    assert set(raised.value.errors) == {3}
    assert set(raised.value.run.exports) == {2, 12}
    assert len(raised.value.run.results) == store.read(RESULTS).count() == 3


def test_one_pass_writes_the_files_of_single_exports(spark, catalog, tmp_path):
    at = datetime(2024, 3, 1, tzinfo=UTC)
    rules = [rule for rule in all_rules().values() if rule.listing.frame is None]
    outcomes = run.write_exports(catalog, rules, str(tmp_path / "together"), at)
    assert not list((tmp_path / "together").glob("_staging*"))
    assert sorted(outcomes) == sorted(rule.id for rule in rules)
    for rule in rules:
        header, rows = read_parts(outcomes[rule.id])
        expected = violations(catalog, rule)
        assert sorted(rows) == sorted(["" if v is None else str(v).lower() if isinstance(v, bool) else str(v) for v in r] for r in expected.collect()), rule.id
        # without rows Spark writes no header, as a single export does not either
        assert not rows or header == expected.columns
    for rule_id in (3, 13, 29, 49, 50):
        assert read_parts(outcomes[rule_id])[1] == read_parts(exports.export(catalog, all_rules()[rule_id], str(tmp_path / "single"), at))[1]


def test_a_relation_that_cannot_be_staged_fails_its_rules_only(spark, catalog, tmp_path, monkeypatch):
    def stage(catalog, codes, rules, path):
        if codes == ("M",):
            raise OSError("full")
        exports.stage(catalog, codes, rules, path)

    monkeypatch.setattr(run, "stage", stage)
    rules = [all_rules()[i] for i in (2, 3, 45, 49, 120)]
    outcomes = run.write_exports(catalog, rules, str(tmp_path), datetime.now(UTC))
    assert {i for i, outcome in outcomes.items() if isinstance(outcome, OSError)} == {2, 3}
    assert all(Path(outcomes[i]).is_dir() for i in (45, 49, 120))


def test_database_store(spark, tmp_path):
    spark.sql(f"CREATE DATABASE IF NOT EXISTS dq_test LOCATION '{tmp_path}/dq_test'")
    store = Store(spark, database="dq_test")
    graded = spark.createDataFrame(
        [(8, 10, 1, 90.0, "FAILED", "d")],
        "RULE_ID long, TOTAL_RECORDS long, FAILED_RECORDS long, PASSED_PERCENTAGE double, STATUS string, DETAILS string",
    )
    store.append_results(graded)
    store.append_results(graded)
    assert store.results().count() == 2
    dimension = spark.createDataFrame([], DIMENSION_SCHEMA)
    assert report(store, dimension).count() == 1
    spark.sql("DROP DATABASE dq_test CASCADE")


GRADED = "RULE_ID long, TOTAL_RECORDS long, FAILED_RECORDS long, PASSED_PERCENTAGE double, STATUS string, DETAILS string"


def graded(spark, n):
    rows = [(rule_id, 10 * n, n % 7 + rule_id, float(n * 37 % 101), "FAILED" if n % 3 else "PASSED", f"d{n * 53 % 10}") for rule_id in (8, 9)]
    return spark.createDataFrame(rows, GRADED)


def test_a_killed_run_is_recorded_once(spark, tmp_path, monkeypatch):
    store = Store(spark, str(tmp_path))
    publish = Store._publish
    at = datetime(2024, 3, 1, 23, 59, tzinfo=UTC)

    def killed_before(self, part, target):
        raise KeyboardInterrupt

    def killed_behind(self, part, target):
        publish(self, part, target)
        raise KeyboardInterrupt

    for run_id, killed in (("a", killed_before), ("b", killed_behind)):
        monkeypatch.setattr(Store, "_publish", killed)
        with pytest.raises(KeyboardInterrupt):
            store.append_results(graded(spark, 1), run_id, at)
        monkeypatch.setattr(Store, "_publish", publish)
        # tried again on the next day, and once more
        for _ in range(2):
            assert store.append_results(graded(spark, 1), run_id, at.replace(month=4)) == run_id
    facts = store.results().collect()
    assert len(facts) == len({row.RESULT_ID for row in facts}) == 4
    assert store.result_files() == ["EXECUTION_DATE=2024-03-01/run-b.parquet", "EXECUTION_DATE=2024-04-01/run-a.parquet"]
    assert {(row.RULE_ID, *tuple(row)[3:]) for row in facts} == {tuple(row) for row in graded(spark, 1).collect()}
    with pytest.raises(ValueError, match="cannot name a file"):
        store.append_results(graded(spark, 1), "../x")


@pytest.mark.parametrize("kind", ["path", "database"])
def test_ten_increments_make_the_whole_cube(spark, tmp_path, monkeypatch, kind):
    if kind == "path":
        store = Store(spark, str(tmp_path))
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS dq_merged LOCATION '{tmp_path}/dq_merged'")
        store = Store(spark, database="dq_merged")
    dimension = spark.createDataFrame([description(all_rules()[8], datetime(2024, 1, 1))], DIMENSION_SCHEMA)
    read: list[set[str]] = []
    for n in range(10):
        store.append_results(graded(spark, n), f"run{n}", datetime(2024, 3, 1 + n // 3, 8 + n % 3, tzinfo=UTC))
        if n == 5:
            # a failure before the files are noted: the next increment merges them again
            monkeypatch.setattr(Store, "write", lambda *args: (_ for _ in ()).throw(OSError("lost")))
            with pytest.raises(OSError, match="lost"):
                store.merge_cube(dimension)
            monkeypatch.undo()
        if n != 7:
            store.merge_cube(dimension)
        read.append(set(store.result_files()))
    assert [len(files) for files in read] == list(range(1, 11))
    merged = sorted(tuple(row) for row in store.merge_cube(dimension).collect())
    assert merged == sorted(tuple(row) for row in daily_cube(store.results(), dimension).collect())
    assert len(merged) == 8
    assert sorted(row.FILE for row in store.read(MERGED).collect()) == store.result_files()
    if kind == "database":
        spark.sql("DROP DATABASE dq_merged CASCADE")


def test_an_increment_reads_new_files_only(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    dimension = spark.createDataFrame([], DIMENSION_SCHEMA)
    for n in range(3):
        store.append_results(graded(spark, n), f"run{n}", datetime(2024, 3, 1, n, tzinfo=UTC))
    store.merge_cube(dimension)
    # an old file that is no parquet any more does not matter
    (tmp_path / RESULTS / "EXECUTION_DATE=2024-03-01" / "run-run1.parquet").write_text("gone")
    store.append_results(graded(spark, 9), "run9", datetime(2024, 3, 1, 9, tzinfo=UTC))
    rows = store.merge_cube(dimension).collect()
    expected = [graded(spark, n).collect() for n in (0, 1, 2, 9)]
    assert [row.TOTAL_RECORDS for row in rows] == [90, 90]
    assert {row.RULE_ID: row.FAILED_RECORDS for row in rows} == {i: max(r.FAILED_RECORDS for rs in expected for r in rs if r.RULE_ID == i) for i in (8, 9)}


@pytest.mark.parametrize("zone", ["UTC", "America/New_York", "Asia/Tokyo"])
def test_cube_mixes_runs_of_a_utc_day(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        facts = spark.sql(
            """SELECT * FROM VALUES
            ('b', 1L, timestamp_seconds(1709251200), 10L, 9L, 10.0D, 'FAILED', 'x'),
            ('a', 1L, timestamp_seconds(1709337599), 12L, 1L, 91.67D, 'ERROR', 'y'),
            ('c', 1L, timestamp_seconds(1709337600), 5L, 0L, 100.0D, 'PASSED', 'z')
            AS t(RESULT_ID, RULE_ID, EXECUTION_TIME, TOTAL_RECORDS, FAILED_RECORDS, PASSED_PERCENTAGE, STATUS, DETAILS)"""
        )
        dimension = spark.createDataFrame([], DIMENSION_SCHEMA)
        rows = daily_cube(facts, dimension).orderBy("EXECUTION_DATE").collect()
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert [tuple(row)[:8] for row in rows] == [
        (1, date(2024, 3, 1), "b", 12, 9, 91.67, "FAILED", "y"),
        (1, date(2024, 3, 2), "c", 5, 0, 100.0, "PASSED", "z"),
    ]


@pytest.mark.parametrize("kind", ["path", "database"])
def test_packed_days_keep_their_rows_and_their_runs(spark, tmp_path, monkeypatch, kind):
    if kind == "path":
        store = Store(spark, str(tmp_path))
    else:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS dq_packed LOCATION '{tmp_path}/dq_packed'")
        store = Store(spark, database="dq_packed")
    dimension = spark.createDataFrame([], DIMENSION_SCHEMA)
    for n in range(6):
        store.append_results(graded(spark, n), f"run{n}", datetime(2024, 3, 1 + n // 3, n, tzinfo=UTC))
        if n == 3:
            store.merge_cube(dimension)
    store.append_results(graded(spark, 6), "today")
    store.append_results(graded(spark, 7), "again")
    before = sorted(map(tuple, store.results().collect()))
    # a failure leaves the day as it was
    put = Store._put_partitions
    monkeypatch.setattr(Store, "_put_partitions", lambda *args: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError, match="lost"):
        store.pack_results()
    monkeypatch.setattr(Store, "_put_partitions", put)
    assert sorted(map(tuple, store.results().collect())) == before
    assert store.pack_results() == ["2024-03-01", "2024-03-02"]
    assert sorted(map(tuple, store.results().collect())) == before
    days = [file.partition("/")[0][-10:] for file in store.result_files()]
    today = datetime.now(UTC).date().isoformat()
    assert days == ["2024-03-01", "2024-03-02", today, today]
    assert store.pack_results() == []
    # packed runs repeated add nothing; a new run of a packed day is packed with it
    for n in range(6):
        store.append_results(graded(spark, n), f"run{n}", datetime(2024, 3, 1, tzinfo=UTC))
    assert sorted(map(tuple, store.results().collect())) == before
    store.append_results(graded(spark, 8), "late", datetime(2024, 3, 1, 23, tzinfo=UTC))
    assert store.pack_results() == ["2024-03-01"]
    assert store.results().count() == len(before) + 2
    # the first day was merged as a whole before it was packed, the second wasn't
    merged = sorted(map(tuple, store.merge_cube(dimension).collect()))
    assert merged == sorted(map(tuple, daily_cube(store.results(), dimension).collect()))
    assert set(store.result_files()) <= {row.FILE for row in store.read(MERGED).collect()}
    if kind == "database":
        spark.sql("DROP DATABASE dq_packed CASCADE")
