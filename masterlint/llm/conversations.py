"""Cheapest repair of conversations, computed on a suffix-shared automaton of their signatures.

A conversation's signature has two letters a row: its role's initial and its first fault. Repair walks a grammar
of four states over it. What is left to pay depends on the rest of the signature and the state alone, so
signatures are read from their ends: equal ends are one node of the automaton, and the cost-to-go of a node's
four states, with the first edit of the best audit suffix, is computed once for all conversations that end so.
Distinct signatures are dealt by ranges of their reversed strings; in that order equal ends are neighbours, and
the path to the present signature is all that a task holds of the automaton.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterable, Iterator
from itertools import chain

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from masterlint.llm.common import written

BLANKS = " \t\n\x0b\x0c\r"
BLANK, DUPLICATE, TRUNCATED, SOUND = "bdt-"
#: Grammar states: nothing yet, behind a system row, behind a user row, behind an assistant row.
START, SYSTEM, USER, ASSISTANT = STATES = range(4)
BEHIND = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
#: The state behind a changed or inserted row; a kept row leads there too, but for a system row at the start.
NEXT = (USER, USER, ASSISTANT, USER)
MAY_END = (True, False, False, True)
REROLE, DELETE, INSERT, CUT = 2, 3, 2, 1
NEVER = 1 << 40
ROLES = {USER: "user", ASSISTANT: "assistant"}
#: Initials of roles that may stand next to each other.
LEGAL = ("su", "ua", "au")
#: Rows of a conversation in order. Rows of one turn and role come by the digest of their text.
ORDER = ("turn", "role", "digest", "copy")
COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, digest, copy and dropped of all rows after the contract's damage."""
    key = "concat(coalesce(CAST(conv_id AS string), ' '), ':', coalesce(CAST(turn AS string), ' '))"
    rows = conversations.selectExpr(
        "conv_id", "turn", "coalesce(role, ' ') AS role", "coalesce(text, ' ') AS text", f"crc32(encode({key}, 'UTF-8')) % 20 AS hit"
    )
    changed = rows.selectExpr(
        "conv_id",
        "turn",
        "IF(hit = 4, 'user', role) AS role",
        "CASE hit WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text",
        "hit = 0 AS dropped",
        "explode(IF(hit = 3, array(0, 1), array(0))) AS copy",
    )
    return changed.withColumn("digest", F.expr("md5(encode(concat(char_length(role), ':', role, text), 'UTF-8'))"))


class _Letters:
    """A conversation's signature and counts, filled row by row."""

    def __init__(self, conv):
        self.conv, self.letters, self.before, self.illegal = conv, bytearray(), None, 0
        self.first = self.last = None
        self.turns = 0

    def add(self, turn: int | None, initial: str, fault: str) -> None:
        if turn is not None:
            if self.first is None:
                self.first = turn
            self.turns += turn != self.last
            self.last = turn
        self.illegal += self.before is not None and self.before + initial not in LEGAL
        self.before = initial
        self.letters += ((initial if initial in BEHIND else "-") + fault).encode()

    def row(self) -> tuple:
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        faults = bytes(self.letters[1::2])
        return (self.conv, self.letters.decode(), gaps, *[faults.count(f.encode()) for f in (BLANK, DUPLICATE, TRUNCATED)], self.illegal)


def _batches(rows: Iterable[tuple], schema: pa.Schema, at_once: int = 1024) -> Iterator[pa.RecordBatch]:
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) == at_once:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


def _values(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            yield from zip(*[c.to_pylist() for c in batch.slice(at, 256).columns], strict=True)


def signatures(rows: DataFrame) -> DataFrame:
    """conv_id, signature and COUNTS of each conversation of damaged() rows; '' and zeros where all are dropped.

    A conversation's rows stream by in order without their texts; only its two letters a row are held.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    ending = f"right(trim(TRAILING '{BLANKS}' FROM text), 1)"
    dealt = rows.selectExpr("conv_id", "turn", "role", "digest", "copy", "dropped", f"{ending} AS ending").repartition("conv_id")
    # dealt by conversation already: an equal row before is found without another shuffle
    again = dealt.withColumn("again", F.expr(f"row_number() OVER (PARTITION BY conv_id, dropped, digest ORDER BY {', '.join(ORDER)}) > 1"))
    fault = f"CASE WHEN ending = '' THEN '{BLANK}' WHEN again THEN '{DUPLICATE}' WHEN ending NOT IN ('.', '!', '?') THEN '{TRUNCATED}' ELSE '{SOUND}' END"
    lettered = again.selectExpr("*", f"{fault} AS fault").sortWithinPartitions("conv_id", *ORDER)

    def signed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
            held = None
            for conv, turn, role, fault, dropped in _values(batches):
                if held is None or held.conv != conv:
                    if held is not None:
                        yield held.row()
                    held = _Letters(conv)
                if not dropped:
                    held.add(turn, role[:1], fault)
            if held is not None:
                yield held.row()

        batches = iter(batches)
        if first := next(batches, None):
            schema = pa.schema([("conv_id", first.schema.field(0).type), ("signature", pa.string()), *[(c, pa.int64()) for c in COUNTS]])
            yield from _batches(each(chain([first], batches)), schema)

    columns = ", ".join(f"{c} bigint" for c in COUNTS)
    return lettered.select("conv_id", "turn", "role", "fault", "dropped").mapInArrow(signed, f"conv_id {kind}, signature string, {columns}")


class Path:
    """The automaton's nodes along one signature, from its end to its start.

    A node is an end of signatures. It holds, for each grammar state, what is left to pay and the first edit of
    the cheapest audit suffix. The edits that a state offers have different letters, so the least letter among
    the cheapest begins the least audit, and the node behind it continues it.
    """

    def __init__(self):
        self.roles = bytearray()
        self.costs = array("q", [0 if end else NEVER for end in MAY_END])
        self.edits = bytearray(4)
        self._insert(0)

    def __len__(self) -> int:
        return len(self.roles)

    def back_to(self, length: int) -> None:
        del self.roles[length:], self.costs[4 * length + 4 :], self.edits[4 * length + 4 :]

    def push(self, role: str, fault: str) -> None:
        at = len(self.costs) - 4
        rest = self.costs[at:]
        cut = CUT if fault == TRUNCATED else 0
        self.roles += role.encode()
        for state in STATES:
            options = [(DELETE + rest[state], "D")]
            if fault not in (BLANK, DUPLICATE):
                options.append((REROLE + cut + rest[NEXT[state]], "R"))
                if self._keeps(state, role):
                    options.append((cut + rest[BEHIND[role]], "K"))
            cost, edit = min(options)
            self.costs.append(cost)
            self.edits += edit.encode()
        self._insert(at + 4)

    @staticmethod
    def _keeps(state: int, role: str) -> bool:
        return role == "s" and state == START or role in BEHIND and BEHIND[role] == NEXT[state]

    def _insert(self, at: int) -> None:
        """An inserted row changes the state only; as each costs, as many rounds as states settle all of them."""
        for _ in STATES:
            for state in STATES:
                inserted = INSERT + self.costs[at + NEXT[state]]
                if (inserted, ord("I")) < (self.costs[at + state], self.edits[at + state]):
                    self.costs[at + state], self.edits[at + state] = inserted, ord("I")

    def best(self) -> tuple[int, str]:
        """The cost and the audit of the signature whose path this is."""
        audit, node, state = [], len(self), START
        while edit := self.edits[4 * node + state]:
            audit.append(edit)
            if edit == ord("K"):
                state = BEHIND[chr(self.roles[node - 1])]
            elif edit != ord("D"):
                state = NEXT[state]
            node -= edit != ord("I")
        return self.costs[4 * len(self) + START], bytes(audit).decode()


def audits(distinct: DataFrame) -> DataFrame:
    """signature, cost and audit of each of the distinct signatures."""

    def computed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, before = Path(), ""

        def each() -> Iterator[tuple]:
            nonlocal before
            for (ends,) in _values(batches):
                shared = 0
                while shared < min(len(before), len(ends)) and before[shared : shared + 2] == ends[shared : shared + 2]:
                    shared += 2
                path.back_to(shared // 2)
                for at in range(shared, len(ends), 2):
                    path.push(ends[at + 1], ends[at])
                before = ends
                yield (ends[::-1], *path.best())

        yield from _batches(each(), pa.schema([("signature", pa.string()), ("cost", pa.int64()), ("audit", pa.string())]))

    ends = distinct.selectExpr("reverse(signature) AS ends").repartitionByRange("ends").sortWithinPartitions("ends")
    return ends.mapInArrow(computed, "signature string, cost bigint, audit string")


class _Repair:
    """The hash of a conversation's repaired text, fed row by row."""

    def __init__(self, head: tuple):
        self.head, self.audit, self.at, self.state = head, head[-1], 0, START
        self.sum, self.empty = hashlib.sha256(), True

    def _line(self, role: str, text: str) -> None:
        self.sum.update((f"{role}:{text}" if self.empty else f"\n{role}:{text}").encode("utf-8", "surrogatepass"))
        self.empty = False

    def _inserted(self) -> None:
        while self.audit[self.at : self.at + 1] == "I":
            self.state = NEXT[self.state]
            self._line(ROLES[self.state], "")
            self.at += 1

    def add(self, role: str, text: str) -> None:
        self._inserted()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "D":
            return
        self.state = BEHIND[role[0]] if edit == "K" else NEXT[self.state]
        self._line(role if edit == "K" else ROLES[self.state], text)

    def row(self) -> tuple:
        self._inserted()
        return (*self.head, self.sum.hexdigest())


def repaired(conversations: DataFrame) -> DataFrame:
    """conv_id, COUNTS, cost, audit and repaired_sha256 of every conversation of conversations (conv_id, turn, role, text).

    Nulls of role and text are one space, hence a role without a place in the grammar and a blank text; rows
    without conv_id are one conversation; turns without a value come first and count in no gap. Rows of the same
    turn come by role and the digest of their text, and repeated rows are duplicates. A role counts by its
    initial; an empty role has none, so it is never kept and legal beside nothing. A conversation that loses all
    rows has zeros, an empty audit and the hash of the empty string. An empty table gives no rows; other columns
    are ignored. The hash of a text is a chain, so one task reads a conversation's rows, which pass by one at a
    time; it holds two letters a row and no text but one. Signatures as frequent as you like are computed once.
    """
    kind, turn = (conversations.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))
    rows = damaged(conversations)
    signed = written(signatures(rows), "conversation-signatures")
    best = written(audits(signed.select("signature").distinct()), "conversation-audits")
    heads = signed.join(best, "signature").select("conv_id", *COUNTS, "cost", "audit")
    fields = [f.name for f in heads.schema[1:]]
    head = heads.selectExpr(
        "conv_id", "0 AS part", f"struct({', '.join(fields)}) AS head", f"CAST(NULL AS {turn}) AS turn", "'' AS role", "'' AS digest", "0 AS copy", "'' AS text"
    )
    body = rows.where("NOT dropped").selectExpr("conv_id", "1 AS part", f"CAST(NULL AS {head.schema['head'].dataType.simpleString()}) AS head", "turn", "role", "digest", "copy", "text")
    ordered = head.unionByName(body).repartition("conv_id").sortWithinPartitions("conv_id", "part", *ORDER).select("conv_id", "head", "role", "text")

    def summed(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
            repair = None
            for conv, values, role, text in _values(batches):
                if values is None:
                    repair.add(role, text)
                    continue
                if repair is not None:
                    yield repair.row()
                repair = _Repair((conv, *values.values()))
            if repair is not None:
                yield repair.row()

        batches = iter(batches)
        if first := next(batches, None):
            numbers = [(c, pa.int64()) for c in (*COUNTS, "cost")]
            schema = pa.schema([("conv_id", first.schema.field(0).type), *numbers, ("audit", pa.string()), ("repaired_sha256", pa.string())])
            yield from _batches(each(chain([first], batches)), schema)

    columns = ", ".join(f"{c} bigint" for c in (*COUNTS, "cost"))
    return ordered.mapInArrow(summed, f"conv_id {kind}, {columns}, audit string, repaired_sha256 string")
