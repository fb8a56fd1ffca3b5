"""Repair of damaged conversations: the cheapest edits that make the roles alternate.

The turns of a conversation are aligned to target strings of roles, ``(ua)+`` of each feasible length, with
and without a system turn ahead, or nothing (Wagner and Fischer 1974). An edit keeps, reroles, deletes or
inserts a turn; blank and repeated turns must go, and a truncated turn that stays costs one more.

*One table for all lengths.* Counted from the end, the targets agree: the symbol with ``k`` to go, itself
included, is ``a`` for odd and ``u`` for even ``k``. So a cell ``(i, k)`` holds the cost of aligning the turns
from ``i`` on to the last ``k`` symbols whatever the whole length is, and the first row has the costs of all
lengths side by side.

*The band* (Ukkonen 1985). Cells of one row and the same next symbol have the same ways to be reached. The
cheapest of them is the incumbent, and a cell that costs more is on no cheapest path: it is cut off, and so is
everything outside the outermost cells that are left. Only lengths that still tie are carried along, a few
cells a turn.

*The audits.* From the cheapest lengths all backtraces are followed at once, an edit at a time; a length
whose next edit is not the least of them drops out, so what is left is the ASCII-least audit.

Of a conversation a task holds one byte a turn (and every ``KEPT``-th row of the table with the rows of one
stretch between), never its texts: faults are found by Spark, texts pass through a second, streaming read
that joins the audit to the sorted turns and hashes what it makes of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gristmill.session import Scope

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
# Every so many turns a row of the table is kept; the rows between are made again when they are traced.
KEPT = 512
_FAR = np.int64(1) << 40

BLANK, SENTENCE_END = "[\\x20\\x09-\\x0D]", "[.!?]"
# Codes of a turn: its initial in the low bits, then its fault.
_S, _U, _A = 1, 2, 3
_FORCED, _TRUNCATED = 4, 8


def damaged(rows: DataFrame) -> DataFrame:
    """``rows (conv_id, turn, role, text)`` damaged by the checksum of ``conv_id:turn`` modulo 20; nulls are a space.

    0 drops a row, 1 empties its text, 2 removes its ``[.!?]``, 3 repeats it, 4 gives it to the user.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")))
    fate = F.crc32(key.cast("binary")) % 20
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("role", "text"))
    made = rows.select("conv_id", "turn", fate.alias("fate"), role.alias("role"), text.alias("text")).filter("fate != 0")
    text = F.when(F.col("fate") == 1, "").when(F.col("fate") == 2, F.regexp_replace("text", SENTENCE_END, "")).otherwise(F.col("text"))
    copies = F.sequence(F.lit(1), F.when(F.col("fate") == 3, 2).otherwise(1))
    role = F.when(F.col("fate") == 4, "user").otherwise(F.col("role"))
    return made.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def repair(rows: DataFrame) -> tuple[DataFrame, Scope]:
    """One row per conversation of ``rows (conv_id, turn, role, text)``, and the owner of the staged tables.

    ``(conv_id, n_turns, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256)``. Turns are
    taken by ``turn``, nulls first, ties by role, text; a null role or text is a space. A turn's first fault
    counts: *blank* (only blanks), *duplicate* (role and text seen earlier), *truncated* (does not end in
    ``[.!?]`` but for blanks). ``gaps`` are missing numbers between the least and the largest turn; ``illegal``
    are neighbours whose initials are not ``su``, ``ua`` or ``au``. ``audit`` has an initial per edit: Keep,
    Rerole, Delete, Insert; ties go to the ASCII-least. The hash is of the repaired ``role:text`` lines.
    Rows without a conversation are one conversation, null. An empty table gives an empty result.
    """
    scope = Scope(rows.sparkSession)
    lines = rows.select(
        "conv_id", F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit(" ")).alias("text"),
    )
    coded = lines.withColumn("code", _code())
    order = [F.asc_nulls_first("conv_id"), F.asc_nulls_first("turn"), "role", "text"]
    # All rows of a conversation pass one task in order; it keeps a byte of each. Of equal rows the one that
    # is no repetition, which has the smaller code, comes first.
    dealt = coded.select("conv_id", "turn", "role", "text", "code").repartition("conv_id").sortWithinPartitions(*order, "code")
    kind = rows.schema["conv_id"].dataType.simpleString()
    audits = dealt.select("conv_id", "turn", "code").mapInArrow(
        _audited, f"conv_id {kind}, n_turns long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"
    )
    audits = scope.stage(audits, "audits")
    ahead = audits.select("conv_id", F.lit(0).alias("place"), F.lit(None).cast("long").alias("turn"), *_nulls("role", "text"), "audit")
    behind = lines.select("conv_id", F.lit(1).alias("place"), "turn", "role", "text", F.lit(None).cast("string").alias("audit"))
    order.insert(1, "place")
    both = ahead.unionAll(behind).repartition("conv_id").sortWithinPartitions(*order).select("conv_id", "role", "text", "audit")
    hashed = both.mapInArrow(_hashed, f"conv_id {kind}, repaired_sha256 string")
    found = audits.join(hashed.withColumnRenamed("conv_id", "other"), F.col("conv_id").eqNullSafe(F.col("other"))).drop("other")
    return found, scope


def _nulls(*names: str) -> list[Column]:
    return [F.lit(None).cast("string").alias(name) for name in names]


def _code() -> Column:
    """A turn's initial and fault as one number; needs the columns of ``repair``'s lines."""
    bare = F.regexp_replace("text", f"^{BLANK}+|{BLANK}+\\z", "")
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.asc_nulls_first("turn"))
    initial = F.substring("role", 1, 1)
    code = F.when(initial == "s", _S).when(initial == "u", _U).when(initial == "a", _A).otherwise(0)
    fault = F.when(bare == "", 16 | _FORCED).when(F.row_number().over(earlier) > 1, 32 | _FORCED)
    return (code + fault.when(~F.right(bare, F.lit(1)).rlike(SENTENCE_END), _TRUNCATED).otherwise(0)).cast("int")


def _next_row(row: np.ndarray, low: int, code: int, below: int) -> tuple[np.ndarray, int]:
    """Costs of the turns from ``i`` on, from those of the turns after ``i``.

    ``row`` holds cells ``low, low + 1, …`` (``low >= 1``); the cell of nothing to go is always three a turn,
    ``below`` for the turns after ``i``.
    """
    size = len(row)
    # Three cells more: the turn itself, one inserted and, behind nothing to go, a second one; elsewhere a
    # second inserted one costs more than the incumbent.
    made = np.full(size + 3, _FAR)
    made[:size] = row + DELETE
    if not code & _FORCED:
        own = code & 3
        stay = TRUNCATED if code & _TRUNCATED else 0
        symbols = np.where((np.arange(low + 1, low + size + 1) & 1) == 1, _A, _U)
        fit = np.where(symbols == own, 0, REROLE) + stay
        np.minimum(made[1 : size + 1], row + fit, out=made[1 : size + 1])
    if low == 1:
        # From nothing to go: the turn becomes the last one, or the last one is inserted.
        last = below + DELETE + INSERT
        if not code & _FORCED:
            last = min(last, below + (0 if code & 3 == _A else REROLE) + (TRUNCATED if code & _TRUNCATED else 0))
        made[0] = min(made[0], last)
    steps = np.arange(len(made)) * INSERT
    made = np.minimum.accumulate(made - steps) + steps
    # The incumbents of both next symbols cut off what costs more.
    alive = np.zeros(len(made), bool)
    for side in (0, 1):
        part = made[side::2]
        alive[side::2] = part == part.min()
    at = np.flatnonzero(alive)
    first, end = int(at[0]), int(at[-1]) + 1
    return np.where(alive[first:end], made[first:end], _FAR), low + first


def _cell(row: np.ndarray, low: int, k: int, nothing: int) -> int:
    if k == 0:
        return nothing
    return int(row[k - low]) if low <= k < low + len(row) else int(_FAR)


class _Table:
    """Rows of the table from the last turn to the first, of which only some are kept."""

    def __init__(self, codes: np.ndarray) -> None:
        self.codes = codes
        n = self.n = len(codes)
        # With no turn left the rest is inserted; more than two can't be cheaper than two.
        row, low = np.array([INSERT, 2 * INSERT], np.int64), 1
        self.saved = {n: (row, low)}
        # The cost of what follows once the system turn is placed, and of the system turn yet to come.
        self.pending = np.full(n + 1, _FAR)
        after = self._best_even(row, low)
        for i in range(n - 1, -1, -1):
            code = int(codes[i])
            if code & 3 == _S and not code & _FORCED:
                self.pending[i] = after + (TRUNCATED if code & _TRUNCATED else 0)
            self.pending[i] = min(self.pending[i], self.pending[i + 1] + DELETE)
            row, low = _next_row(row, low, code, DELETE * (n - 1 - i))
            after = self._best_even(row, low)
            if i % KEPT == 0:
                self.saved[i] = (row, low)
        self.stretch: dict[int, tuple[np.ndarray, int]] = {}

    @staticmethod
    def _best_even(row: np.ndarray, low: int) -> int:
        part = row[low % 2 :: 2]
        return int(part.min()) if len(part) else int(_FAR)

    def row(self, i: int) -> tuple[np.ndarray, int]:
        """The row of turn ``i``; a stretch is made again from the kept row behind it."""
        if i in self.saved:
            return self.saved[i]
        if i not in self.stretch:
            end = min(self.n, (i // KEPT + 1) * KEPT)
            (row, low), self.stretch = self.saved[end], {}
            for j in range(end - 1, i - 1, -1):
                row, low = _next_row(row, low, int(self.codes[j]), DELETE * (self.n - 1 - j))
                self.stretch[j] = (row, low)
        return self.stretch[i]

    def cost(self, i: int, k: int) -> int:
        return _cell(*self.row(i), k, DELETE * (self.n - i))

    def evens(self, i: int) -> list[int]:
        """The lengths, beyond nothing, of the cheapest alignments that start with a user's turn."""
        row, low = self.row(i)
        at = np.arange(low, low + len(row))
        return at[(at % 2 == 0) & (row == self._best_even(row, low))].tolist()


def audit_of(codes: np.ndarray) -> tuple[int, str]:
    """Cost and audit of a conversation's turns, given as their codes."""
    table = _Table(codes)
    n = table.n
    row, low = table.row(0)
    costs = {"nothing": DELETE * n, "turns": table._best_even(row, low), "system": int(table.pending[0])}
    cost = min(costs.values())
    # All lengths that are followed; a system turn that is yet to come is kept apart.
    alive = ({0} if costs["nothing"] == cost else set()) | (set(table.evens(0)) if costs["turns"] == cost else set())
    waiting = costs["system"] == cost
    audit, i = [], 0
    while i < n or any(alive):
        code = int(codes[i]) if i < n else None
        moves: dict[str, set[int]] = {"D": set(), "I": set(), "K": set(), "R": set()}
        waits = False
        for k in alive:
            here = table.cost(i, k)
            if code is not None and table.cost(i + 1, k) + DELETE == here:
                moves["D"].add(k)
            if k and table.cost(i, k - 1) + INSERT == here:
                moves["I"].add(k - 1)
            if code is not None and k and not code & _FORCED:
                stay = TRUNCATED if code & _TRUNCATED else 0
                fits = code & 3 == (_A if k & 1 else _U)
                if table.cost(i + 1, k - 1) + stay + (0 if fits else REROLE) == here:
                    moves["K" if fits else "R"].add(k - 1)
        if waiting:
            here = int(table.pending[i])
            waits = int(table.pending[i + 1]) + DELETE == here
            if code & 3 == _S and not code & _FORCED:
                stay = TRUNCATED if code & _TRUNCATED else 0
                if table._best_even(*table.row(i + 1)) + stay == here:
                    moves["K"] |= set(table.evens(i + 1))
        edit = "D" if waits or moves["D"] else next(e for e in "IKR" if moves[e])
        alive, waiting = moves[edit], waits and edit == "D"
        audit.append(edit)
        i += edit != "I"
    return cost, "".join(audit)


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, pa.RecordBatch, bool]]:
    """Stretches of equal ``conv_id`` in sorted rows, each with whether it starts a conversation."""
    started, last = False, None
    for batch in batches:
        column = batch.column(batch.schema.get_field_index("conv_id"))
        keys = column.to_pylist()
        start = 0
        for k in range(1, len(keys) + 1):
            if k == len(keys) or keys[k] != keys[start]:
                yield keys[start], batch.slice(start, k - start), not started or keys[start] != last
                started, last, start = True, keys[start], k


class _Facts:
    """Turns of one conversation as they pass."""

    def __init__(self, key: object) -> None:
        self.key = key
        self.codes: list[bytes] = []
        self.least = self.most = self.last = None
        self.distinct = 0

    def add(self, part: pa.RecordBatch) -> None:
        self.codes.append(part.column(2).to_numpy().astype(np.uint8).tobytes())
        turns = part.column(1).drop_null().to_numpy(zero_copy_only=False)
        if len(turns):
            new = np.append(self.last is None or turns[0] != self.last, turns[1:] != turns[:-1])
            self.distinct += int(new.sum())
            self.least = int(turns[0]) if self.least is None else self.least
            self.most = self.last = int(turns[-1])

    def result(self) -> tuple:
        codes = np.frombuffer(b"".join(self.codes), np.uint8)
        gaps = 0 if self.least is None else self.most - self.least + 1 - self.distinct
        initial = codes & 3
        pairs = initial[:-1] * 4 + initial[1:]
        legal = np.isin(pairs, [_S * 4 + _U, _U * 4 + _A, _A * 4 + _U])
        cost, audit = audit_of(codes & 15)
        faults = (int((codes & bit > 0).sum()) for bit in (16, 32, _TRUNCATED))
        return (self.key, len(codes), gaps, *faults, int((~legal).sum()), cost, audit)


def _audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit"]
    rows: list[tuple] = []
    facts, kind, size = None, None, 0

    def made() -> pa.RecordBatch:
        columns = list(zip(*rows, strict=True))
        kinds = [kind, *[pa.int64()] * 7, pa.string()]
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names)

    for key, part, starts in _conversations(batches):
        kind = part.column(0).type
        if starts:
            if facts:
                rows.append(facts.result())
                size += len(rows[-1][-1]) + 100
                if size >= 1_000_000:
                    yield made()
                    size = 0
            facts = _Facts(key)
        facts.add(part)
    if facts:
        rows.append(facts.result())
    if rows:
        yield made()


class _Writer:
    """The repaired lines of one conversation, hashed as its turns pass."""

    def __init__(self, key: object, audit: str) -> None:
        self.key, self.audit = key, audit
        self.at, self.after = 0, ""
        self.hash, self.lines = hashlib.sha256(), 0

    def _write(self, role: str, text: str, initial: str) -> None:
        self.hash.update((("\n" if self.lines else "") + f"{role}:{text}").encode())
        self.lines += 1
        self.after = initial

    def _due(self) -> str:
        return "assistant" if self.after == "u" else "user"

    def insert(self) -> None:
        while self.at < len(self.audit) and self.audit[self.at] == "I":
            self._write(due := self._due(), "", due[0])
            self.at += 1

    def turn(self, role: str, text: str) -> None:
        self.insert()
        edit = self.audit[self.at]
        self.at += 1
        if edit == "K":
            self._write(role, text, role[0])
        elif edit == "R":
            self._write(due := self._due(), text, due[0])

    def result(self) -> tuple[object, str]:
        self.insert()
        return self.key, self.hash.hexdigest()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows: list[tuple] = []
    writer, kind = None, None

    def made() -> pa.RecordBatch:
        keys, hashes = zip(*rows, strict=True)
        rows.clear()
        return pa.RecordBatch.from_arrays([pa.array(keys, kind), pa.array(hashes, pa.string())], ["conv_id", "repaired_sha256"])

    for key, part, starts in _conversations(batches):
        kind = part.column(0).type
        roles, texts, audits = (part.column(k).to_pylist() for k in (1, 2, 3))
        if starts:
            if writer:
                rows.append(writer.result())
                if len(rows) >= 4096:
                    yield made()
            writer = _Writer(key, audits[0])
            roles, texts = roles[1:], texts[1:]
        for role, text in zip(roles, texts, strict=True):
            writer.turn(role, text)
    if writer:
        rows.append(writer.result())
    if rows:
        yield made()
