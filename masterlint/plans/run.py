"""A whole run: evaluate, record, export, report."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from datetime import UTC, datetime

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row

from masterlint.operators.masks import relations
from masterlint.plans.report import results
from masterlint.rules.model import Rule
from masterlint.sinks.exports import export, stage, wanted
from masterlint.sinks.store import Store
from masterlint.sources.catalog import Catalog

# Exports are independent jobs; a few at a time keep a cluster busy between stages.
EXPORTS_AT_ONCE = 4


@dataclass(frozen=True)
class Run:
    results: list[Row]
    exports: dict[int, str]
    #: How many values could not be read, by table and column.
    rejected: dict[tuple[str, str], int] = field(default_factory=dict)


class ExportErrors(RuntimeError):
    """Some exports of a recorded run failed: ``errors`` by rule, and the ``run`` with those that were written."""

    def __init__(self, run: Run, errors: dict[int, Exception]):
        super().__init__("; ".join(f"export of rule {rule_id} failed: {error}" for rule_id, error in errors.items()))
        self.run = run
        self.errors = errors


def run_rules(
    catalog: Catalog, rules: Iterable[Rule], store: Store, export_root: str | None = None, run_id: str | None = None
) -> Run:
    """Evaluates ``rules`` in one plan, records the results and exports unclean rules' rows.

    A run repeated with its ``run_id``, after a failure or by mistake, records nothing twice. Only the result rows,
    one per rule, come to the driver: they decide the exports, and recording them from there keeps their ids stable
    if a task is retried. Values that cannot be read concern only the rules on their column and are kept in the
    store; what comes to the driver is their number for each column.
    """
    spark = catalog.spark
    chosen = {rule.id: rule for rule in rules}
    graded = results(catalog, chosen.values())
    rows = graded.collect()
    run_id = store.append_results(spark.createDataFrame(rows, graded.schema), run_id)
    unread = catalog.rejected()
    rejected = store.put_rejected(unread, run_id) if unread is not None else {}
    if export_root is None:
        return Run(rows, {}, rejected)
    at = datetime.now(UTC)
    unclean = [row.RULE_ID for row in rows if wanted(chosen[row.RULE_ID], row.STATUS, row.PASSED_PERCENTAGE)]

    outcomes = write_exports(catalog, [chosen[rule_id] for rule_id in unclean], export_root, at)
    errors = {rule_id: outcome for rule_id, outcome in outcomes.items() if isinstance(outcome, Exception)}
    run = Run(rows, {rule_id: outcome for rule_id, outcome in outcomes.items() if rule_id not in errors}, rejected)
    if errors:
        raise ExportErrors(run, errors)
    return run


def write_exports(catalog: Catalog, rules: list[Rule], root: str, at: datetime) -> dict[int, str | Exception]:
    """By rule, the folder of its export or what kept it from being written.

    Rules on the same relation share one pass over it: their failing rows are staged under ``root`` and each
    export reads only its own. A relation that cannot be staged fails its rules, any other failure only its rule.
    """
    spark = catalog.spark
    folder = f"{root}/_staging_{uuid.uuid4().hex}"
    shared = {codes: members for codes, members in relations(rules).items() if len(members) > 1}
    staged: dict[int, str] = {}

    def attempt(task: Callable[[], str]) -> str | Exception:
        try:
            return task()
        except Exception as error:  # the other exports are still written
            return error

    def stage_one(codes: tuple[str, ...]) -> str | Exception:
        path = f"{folder}/{'_'.join(codes)}"
        return attempt(lambda: stage(catalog, codes, shared[codes], path) or path)

    def write(rule: Rule) -> str | Exception:
        found = staged.get(rule.id)
        if isinstance(found, Exception):
            return found
        return attempt(lambda: export(catalog, rule, root, at, found))

    try:
        with ThreadPoolExecutor(EXPORTS_AT_ONCE) as pool:
            for codes, path in zip(shared, pool.map(inheritable_thread_target(spark)(stage_one), shared), strict=True):
                staged |= {rule.id: path for rule in shared[codes]}
            return dict(zip([rule.id for rule in rules], pool.map(inheritable_thread_target(spark)(write), rules), strict=True))
    finally:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def report(store: Store, dimension: DataFrame | None = None) -> DataFrame:
    """Brings the daily cube up to date with the results recorded since, or all where there is none."""
    return store.merge_cube(store.dimension() if dimension is None else dimension)
