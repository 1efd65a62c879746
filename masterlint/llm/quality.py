"""Quality rules with a ledger of failure bits, as DataFrame operations.

measure() reads every text once. ledger() evaluates every rule once and stores one bit per failed rule next to
the measurements. Policies are versioned masks over those bits; applying one, or finding out what each of its
rules contributes, reads the ledger only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import WORD, let

WINDOW = 5
SYMBOLS = "#*$%&|<>"
SPACES = (" ", "\\t", "\\n", "\\u000B", "\\u000C", "\\r")

#: Rules by name; each is true for a document that fails. The place in the list is the bit: only append.
RULES: tuple[tuple[str, str], ...] = (
    ("few_words", "n_words < 10"),
    ("repeated_words", "100 * n_repeat_words > 20 * n_words"),
    ("symbols", "100 * n_symbols > 25 * n_words"),
    ("duplicate_lines", "100 * n_dup_lines > 30 * n_lines"),
    ("short_words", "word_chars < 2 * n_words"),
    ("long_words", "word_chars > 20 * n_words"),
    ("shouting", "100 * n_upper > 50 * word_chars"),
)
BIT = {name: 1 << i for i, (name, _) in enumerate(RULES)}


@dataclass(frozen=True)
class Policy:
    """A version's rules: a document is kept if it fails none of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        return reduce(int.__or__, (BIT[name] for name in self.rules), 0)


BASE = Policy("base", ("few_words", "repeated_words"))
POLICIES = (BASE, Policy("v1", (*BASE.rules, "symbols", "duplicate_lines", "short_words", "long_words", "shouting")))


def _without(text: str, characters: tuple[str, ...] | str) -> str:
    return reduce(lambda sql, c: f"replace({sql}, '{c}', '')", characters, text)


def _repeated_words(words: str) -> str:
    """SQL: how many of the words lie in windows of five that occur twice or more.

    Windows are compared by 64-bit hash. A text whose hashes all differ is done; else the hashes are sorted
    with their places, equal neighbours marked, and the places covered by marked windows counted in order:
    n log n in the length of the text.
    """
    items = ", ".join(f"get(h, i + {k})" for k in range(WINDOW))
    windows = f"transform(sequence(0, size(h) - {WINDOW}), i -> xxhash64({items}))"
    marked = (
        "filter(sequence(0, size(s) - 1), j -> get(s, j).x <=> get(s, j - 1).x OR get(s, j).x <=> get(s, j + 1).x)"
    )
    places = let("sort_array(transform(g, (x, i) -> named_struct('x', x, 'i', i)))", "s", f"sort_array(transform({marked}, j -> get(s, j).i))")
    covered = (
        f"aggregate({places}, named_struct('n', 0, 'end', 0), (acc, i) -> named_struct("
        f"'n', acc.n + i + {WINDOW} - greatest(acc.end, i), 'end', i + {WINDOW}), acc -> acc.n)"
    )
    of_windows = let(windows, "g", f"IF(size(array_distinct(g)) = size(g), 0, {covered})")
    of_hashes = let(f"transform({words}, w -> xxhash64(w))", "h", of_windows)
    return f"IF(size({words}) < {WINDOW}, 0, {of_hashes})"


def measure(docs: DataFrame) -> DataFrame:
    """One row per row of docs: doc_id and, as long, n_words, word_chars, n_symbols, n_lines, n_dup_lines,
    n_repeat_words and n_upper.

    A null or empty text measures 0 everywhere. Lines are those with a word. Repeated rows and null ids are
    measured row by row; an empty table gives no rows; other columns are ignored. Whole texts count.
    """
    texts = docs.select("doc_id", F.expr("coalesce(text, '')").alias("t"))
    split = texts.selectExpr(
        "doc_id",
        "t",
        f"regexp_extract_all(t, r'{WORD}', 0) AS words",
        f"filter(split(t, '\\n'), l -> l rlike r'{WORD}') AS lines",
    )
    measured = split.selectExpr(
        "doc_id",
        "size(words) AS n_words",
        f"char_length({_without('t', SPACES)}) AS word_chars",
        f"char_length(t) - char_length({_without('t', SYMBOLS)}) AS n_symbols",
        "size(lines) AS n_lines",
        "size(lines) - size(array_distinct(lines)) AS n_dup_lines",
        f"{_repeated_words('words')} AS n_repeat_words",
        "regexp_count(t, '[A-Z]') AS n_upper",
    )
    return measured.select("doc_id", *[F.col(c).cast("bigint").alias(c) for c in measured.columns[1:]])


def ledger(docs: DataFrame) -> DataFrame:
    """measure() with failed, a bit mask of the rules that each document fails."""
    bits = [F.when(F.expr(condition), F.lit(BIT[name])).otherwise(F.lit(0)) for name, condition in RULES]
    return measure(docs).withColumn("failed", reduce(lambda a, b: a.bitwiseOR(b), bits).cast("bigint"))


def decide(ledger_rows: DataFrame, policies: tuple[Policy, ...] = POLICIES) -> DataFrame:
    """ledger_rows with one boolean kept_<version> per policy."""
    return ledger_rows.withColumns({f"kept_{p.version}": F.expr(f"(failed & {p.mask}) = 0") for p in policies})


def ablations(ledger_rows: DataFrame, policy: Policy) -> DataFrame:
    """Per rule of the policy: documents that fail it, those that no other rule of the policy fails, and how
    many the policy would keep without it. One pass: documents are counted per distinct mask, of which there
    are at most two to the number of rules, and the rules are read from the masks."""
    masks = ledger_rows.groupBy(F.expr(f"failed & {policy.mask}").alias("mask")).agg(F.count("*").alias("n"))
    rules = ", ".join(f"named_struct('rule', '{r}', 'bit', {BIT[r]}L)" for r in policy.rules)
    each = masks.selectExpr("mask", "n", f"inline(array({rules}))")
    count = lambda condition: F.sum(F.expr(f"IF({condition}, n, 0L)"))
    return each.groupBy("rule").agg(
        count("(mask & bit) <> 0").alias("n_failed"),
        count("mask = bit").alias("n_only_this"),
        count("(mask & ~bit) = 0").alias("n_kept_without"),
    )
