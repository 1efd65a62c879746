"""What a rule is: two measures, a grading policy, a text and an export."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from masterlint.functions.conditions import ALWAYS
from masterlint.sources.catalog import Catalog

# One conjunction over the joined rows of several tables: table code -> condition on that table.
Term = dict[str, str]


@dataclass(frozen=True)
class Rows:
    """Number of rows of one table that meet a condition."""

    table: str
    where: str = ALWAYS


@dataclass(frozen=True)
class Pairs:
    """Number of rows of the equi-join of several tables on their key.

    The joined rows counted are those meeting any of ``terms``. Terms must be
    disjoint, and the first table named is the one every term has. ``sign`` lets a
    measure subtract one count from another.
    """

    terms: tuple[Term, ...]
    sign: int = 1


@dataclass(frozen=True)
class Keys:
    """Number of distinct non-null keys among the joined rows meeting ``term``."""

    term: Term


@dataclass(frozen=True)
class Repeats:
    """Number of rows that share their key with another row."""

    table: str
    where: str = ALWAYS


@dataclass(frozen=True)
class Computed:
    """A count taken from ``column`` of a one-row frame with its own plan."""

    frame: Callable[[Catalog], DataFrame]
    column: str
    sign: int = 1


Part = Rows | Pairs | Keys | Repeats | Computed
Measure = tuple[Part, ...]


@dataclass(frozen=True)
class Policy:
    """When a pass rate is PASSED, FAILED or (in between) ERROR."""

    code: str
    pass_at: float
    inclusive: bool
    fail_below: float


# The grading policies. The strict ones send an exact hit to ERROR.
S99 = Policy("S99", 99.0, False, 99.0)
S95 = Policy("S95", 95.0, False, 95.0)
S90 = Policy("S90", 90.0, False, 90.0)
G99 = Policy("G99", 99.0, True, 99.0)
G95 = Policy("G95", 95.0, True, 95.0)
G90 = Policy("G90", 90.0, True, 90.0)
H100 = Policy("H100", 100.0, True, 100.0)
H93 = Policy("H93", 100.0, True, 99.0)


@dataclass(frozen=True)
class Listing:
    """The rows behind a failure.

    ``columns`` are SQL select items; on a join they name tables by code
    (``M.MEINS``). ``terms`` replaces the rule's own condition where the listing
    differs from the count. ``frame`` gives the rows by a plan of its own. ``order``
    and the ``hidden`` columns it may need apply to exports only.
    """

    columns: tuple[str, ...] = ()
    order: tuple[str, ...] = ()
    distinct: bool = False
    terms: tuple[Term, ...] | None = None
    frame: Callable[[Catalog], DataFrame] | None = None
    hidden: tuple[str, ...] = ()


@dataclass(frozen=True)
class Rule:
    id: int
    domain: str
    check: str
    fails: Measure
    total: Measure
    policy: Policy
    note: str
    tag: str
    listing: Listing
    coarse_rate: bool = False
    export_when_failed: bool = False

    def with_total(self, total: Measure) -> Rule:
        return replace(self, total=total)

    def terms(self) -> tuple[Term, ...]:
        """The failure condition as disjoint terms over the joined tables."""
        if self.listing.terms is not None:
            return self.listing.terms
        part = self.fails[0]
        if isinstance(part, Pairs):
            return part.terms
        if isinstance(part, Keys):
            return (part.term,)
        if isinstance(part, Rows):
            return ({part.table: part.where},)
        raise ValueError(f"rule {self.id} lists its rows by a frame")
