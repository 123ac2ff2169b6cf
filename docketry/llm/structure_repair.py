"""Conversation structure repair by a square-root checkpointed dynamic programme.

A row of a conversation is kept, given the role user or assistant, or deleted, and empty
rows are inserted, so that the initials of the roles read ``(s?(ua)+)?`` at least cost.
The states are the last initial written: none, s, u or a.  A state-cost vector holds the
least cost of what follows from each state, and edits are tight where they meet it.

Keeping the vectors of all rows would take as much memory as the conversation.  So its
rows are cut into blocks that grow like the square root: block k has ``UNIT`` (2k + 1)
rows.

1. Each block's rows, one letter each, give the block's least costs from any state to any
   other; all blocks at once.
2. Backward over the blocks of a conversation, only the vector at each block's end is kept.
3. Each block makes its vectors anew from the one at its end and walks forward, from each
   state that may enter it, taking the ASCII-least tight edit; all blocks at once.
4. Forward over the blocks, the states that are met pick the walks.

A conversation of n rows is about the square root of n / ``UNIT`` rows in steps 2 and 4, so
none has to fit into a task.  Only the digest of a whole conversation streams through
one task, in order, holding nothing but its audit.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docketry.llm.common import stage
from docketry.llm.ordering import in_order, map_rows

UNIT = 64
WHITE = " \t\n\x0b\x0c\r"
#: Costs of the edits, and of a truncated row that is not deleted.
DELETE, INSERT, REROLE, TRUNCATED = 3, 2, 2, 1

START, SYSTEM, USER, ASSISTANT = range(4)
#: The state after the only role that may be written next, besides s at the start.
GROWN = (USER, USER, ASSISTANT, USER)
#: Least costs after the last row: only the start and an assistant may end it.
FINAL = (0, 2 * INSERT, INSERT, 0)
FAR = 1 << 60
#: Of two or more rows: initials of neighbours that are in order.
LEGAL = ("su", "ua", "au")


def _kept(code: str, state: int) -> int | None:
    """The state after keeping a row, None where its initial does not fit."""
    initial = code.lower()
    if initial == "s":
        return SYSTEM if state == START else None
    if initial in ("u", "a"):
        grown = GROWN[state]
        return grown if grown == (USER if initial == "u" else ASSISTANT) else None
    return None


@lru_cache(maxsize=1 << 16)
def _before(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    """The vector before a row from the one after it.

    Codes: ``D`` must go, ``x`` is no row; else the initial or ``o`` for another, as a
    capital where the row is truncated.
    """
    if code == "x":
        return after
    bare = [DELETE + cost for cost in after]
    if code != "D":
        extra = TRUNCATED if code.isupper() else 0
        for state in range(4):
            bare[state] = min(bare[state], REROLE + extra + after[GROWN[state]])
            kept = _kept(code, state)
            if kept is not None:
                bare[state] = min(bare[state], extra + after[kept])
    once = [GROWN[s] for s in range(4)]
    return tuple(min(bare[s], INSERT + bare[once[s]], 2 * INSERT + bare[once[once[s]]], FAR) for s in range(4))


def _step(code: str, after: tuple[int, ...]) -> tuple[int, ...]:
    # Vectors differ by a constant from one of few, so what was worked out once serves again.
    least = min(after)
    return tuple(min(FAR, least + cost) for cost in _before(code, tuple(min(FAR, c - least) for c in after)))


def block_costs(codes: str) -> list[int]:
    """Least costs through a block, from state p to state q at place 4 p + q."""
    columns = []
    for q in range(4):
        vector = tuple(0 if s == q else FAR for s in range(4))
        for code in reversed(codes):
            vector = _step(code, vector)
        columns.append(vector)
    return [columns[q][p] for p in range(4) for q in range(4)]


def through(costs: list[int], end: tuple[int, ...]) -> tuple[int, ...]:
    """The vector at a block's begin from the one at its end."""
    return tuple(min(FAR, *(costs[4 * p + q] + end[q] for q in range(4))) for p in range(4))


def walk(codes: str, end: tuple[int, ...], state: int, last: bool) -> tuple[list[str], int]:
    """The ASCII-least tight edits of a block entered in ``state``, and the state it is left in.

    One string for each row: inserts before it (``I`` a user, ``i`` an assistant), then ``K``,
    ``D`` or the new role, ``R`` or ``r``.  The last block's last row also has the inserts
    after it.
    """
    vectors = [end]
    for code in reversed(codes):
        vectors.append(_step(code, vectors[-1]))
    edits = []
    for i, code in enumerate(codes):
        here, after = vectors[len(codes) - i], vectors[len(codes) - i - 1]
        made = ""
        while code != "x":
            grown = GROWN[state]
            extra = TRUNCATED if code.isupper() else 0
            if here[state] == DELETE + after[state]:
                made += "D"
                break
            if here[state] == INSERT + here[grown]:
                made += "I" if grown == USER else "i"
                state = grown
                continue
            kept = _kept(code, state)
            if kept is not None and here[state] == extra + after[kept]:
                made, state = made + "K", kept
            else:
                made, state = made + ("R" if grown == USER else "r"), grown
            break
        edits.append(made)
    while last and FINAL[state]:
        state = GROWN[state]
        edits[-1] += "I" if state == USER else "i"
    return edits, state


def damage(turns: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text, gone)``: rows of ``turns`` damaged by the crc32 of ``conv_id:turn``.

    Of twenty, 0 drops a row (``gone``), 1 empties its text, 2 takes its ``.!?`` away,
    3 repeats it, 4 gives it the role user.  Nulls count as one space, in the crc32 too.
    """
    space = F.lit(" ")
    conv, turn = (F.coalesce(F.col(c).cast("string"), space) for c in ("conv_id", "turn"))
    spelled = F.concat(conv, F.lit(":"), turn)
    draw = F.pmod(F.crc32(spelled.cast("binary")), F.lit(20))
    text = F.coalesce("text", space)
    return turns.select(
        "conv_id", "turn",
        F.when(draw == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(draw == 1, "").when(draw == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        (draw == 0).alias("gone"),
        F.explode(F.sequence(F.lit(1), F.when(draw == 3, 2).otherwise(1))).alias("_copy"),
    ).drop("_copy")


def _codes(rows: DataFrame) -> DataFrame:
    """``(conv_id, at, n, fault, code)`` of each row; the first fault counts."""
    left = F.rtrim("text", F.lit(WHITE))
    said = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    narrow = rows.select(
        "conv_id", "at", "n", "gone", F.substring("role", 1, 1).alias("initial"), said.alias("said"),
        (left == "").alias("blank"), (~F.right(left, F.lit(1)).isin(".", "!", "?")).alias("truncated"),
    )
    # The first of rows alike is told by its place, which no two rows share: no key is hot in the join.
    firsts = narrow.where(~F.col("blank") & ~F.col("gone")).groupBy("conv_id", "said").agg(F.min("at").alias("at"))
    marked = narrow.drop("said").join(firsts.select("at", F.lit(True).alias("is_first")), "at", "left")
    fault = (
        F.when(F.col("gone"), "gone").when(F.col("blank"), "blank").when(F.col("is_first").isNull(), "duplicate")
        .when(F.col("truncated"), "truncated").otherwise("none")
    )
    letter = F.when(F.col("initial").isin("s", "u", "a"), F.col("initial")).otherwise("o")
    code = (
        F.when(F.col("fault") == "gone", "x").when(F.col("fault").isin("blank", "duplicate"), "D")
        .when(F.col("fault") == "truncated", F.upper(letter)).otherwise(letter)
    )
    return marked.withColumn("fault", fault).select("conv_id", "at", "n", "fault", code.alias("code"))


def _edits(codes: DataFrame, unit: int) -> DataFrame:
    """``(at, edits)``: what becomes of each row."""
    kind = dict(codes.dtypes)["conv_id"]
    block = F.floor(F.sqrt(F.floor(F.col("n") / unit))).cast("bigint")
    # A block's rows are as many as the square root of the conversation's, about.
    ordered = F.array_sort(F.collect_list(F.struct("at", "code")))
    blocks = (
        codes.groupBy("conv_id", block.alias("block")).agg(ordered.alias("rows"))
        .select("conv_id", "block", F.array_join("rows.code", "").alias("codes"), F.col("rows.at").alias("ats"))
    )

    def costs(rows):
        for conv, number, letters, ats in rows:
            yield conv, number, letters, ats, block_costs(letters)

    def backward(rows):
        now, vector = object(), FINAL
        for conv, number, letters, ats, through_block in rows:
            last = conv != now
            if last:
                now, vector = conv, FINAL
            yield conv, number, letters, ats, list(vector), last
            vector = through(through_block, vector)

    def walks(rows):
        for conv, number, letters, ats, end, last in rows:
            every = [walk(letters, tuple(end), s, last) for s in (range(4) if number else (START,))]
            yield conv, number, ats, [e for edits, _ in every for e in edits], [state for _, state in every]

    def forward(rows):
        now, state = object(), START
        for conv, number, ats, every, states in rows:
            if conv != now:
                now, state = conv, START
            n = len(ats)
            yield ats, every[n * state : n * (state + 1)]
            state = states[state]

    base = f"conv_id {kind}, block bigint, codes string, ats array<bigint>"
    known = stage(map_rows(blocks, costs, f"{base}, costs array<bigint>"), "repair-blocks")
    # Only sums over blocks go through the two scans; ties of null keys are one group.
    turned = known.repartition("conv_id").sortWithinPartitions("conv_id", F.col("block").desc())
    ends = map_rows(turned, backward, f"{base}, ends array<bigint>, last boolean")
    walked = map_rows(
        ends.repartition(F.col("conv_id"), F.col("block")), walks,
        f"conv_id {kind}, block bigint, ats array<bigint>, every array<string>, states array<int>",
    )
    met = map_rows(
        walked.repartition("conv_id").sortWithinPartitions("conv_id", "block"), forward,
        "ats array<bigint>, edits array<string>",
    )
    return met.select(F.explode(F.arrays_zip("ats", "edits")).alias("e")).select(
        F.col("e.ats").alias("at"), F.col("e.edits").alias("edits")
    )


def repair(turns: DataFrame, gone: Column | None = None, unit: int = UNIT) -> DataFrame:
    """``(conv_id, turn, role, text, at, n, fault, edits)`` of each row of ``turns(conv_id, turn, role, text)``.

    Rows are taken by ``turn``, nulls first, ties by role and text; ``n`` is the place in the
    conversation and ``edits`` what becomes of the row, as in ``walk``.  The fault is
    ``none``, or the first of ``blank`` (nothing but white space), ``duplicate`` (role and text
    seen earlier) and ``truncated`` (the end is not one of ``.!?``).  A blank or repeated row
    must go.  Rows that are ``gone`` count for nothing and keep their conversation in the
    result.  Null roles and texts count as empty, a null id is a conversation of its
    own, a role without an initial never fits.  Other columns are not read.  An empty
    table gives no row.
    """
    rows = turns.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"),
        (F.lit(False) if gone is None else F.coalesce(gone, F.lit(False))).alias("gone"),
    )
    order = [F.col("turn").asc_nulls_first(), F.col("role"), F.sha2(F.col("text").cast("binary"), 256), F.col("gone")]
    placed = in_order(rows, "conv_id", order, "repair-rows")
    codes = stage(_codes(placed), "repair-codes")
    made = codes.select("at", "fault").join(_edits(codes, unit), "at")
    return placed.drop("gone").join(made, "at")


def repaired_turns(repaired: DataFrame) -> DataFrame:
    """``(conv_id, at, place, role, text)``: the rows of the repaired conversations; (at, place) is their order."""
    each = repaired.select("conv_id", "at", "role", "text", F.posexplode(F.split("edits", "(?!^)")).alias("place", "edit"))
    edit = F.col("edit")
    role = (
        F.when(edit == "K", F.col("role")).when(edit.isin("I", "R"), "user").when(edit.isin("i", "r"), "assistant")
    )
    text = F.when(edit.isin("I", "i"), "").otherwise(F.col("text"))
    return each.where(edit.isin("K", "I", "i", "R", "r")).select(
        "conv_id", "at", "place", role.alias("role"), text.alias("text")
    )


class _Audit:
    """What is told of one conversation, fed row by row."""

    def __init__(self):
        self.low = self.high = self.turn = self.initial = None
        self.turns = self.illegal = self.cost = 0
        self.faults = dict.fromkeys(("blank", "duplicate", "truncated"), 0)
        self.edits: list[str] = []
        self.sha, self.any = hashlib.sha256(), False

    def add(self, turn, role, text, fault, edits) -> None:
        self.edits.append(edits.upper())
        for edit in edits:  # inserts at the end may stand with a row that is gone
            self._apply(edit, role, text, fault == "truncated")
        if fault == "gone":
            return
        if turn is not None:
            self.low = turn if self.low is None else self.low
            self.turns += turn != self.turn
            self.turn = self.high = turn
        if fault in self.faults:
            self.faults[fault] += 1
        if self.initial is not None and self.initial + role[:1] not in LEGAL:
            self.illegal += 1
        self.initial = role[:1]

    def _apply(self, edit: str, role: str, text: str, truncated: bool) -> None:
        if edit == "D":
            self.cost += DELETE
            return
        if edit in "Ii":
            self.cost += INSERT
            text = ""
        else:
            self.cost += TRUNCATED * truncated + REROLE * (edit in "Rr")
        role = role if edit == "K" else "user" if edit in "IR" else "assistant"
        self.sha.update(f"{'\n' if self.any else ''}{role}:{text}".encode())
        self.any = True

    def row(self, conv) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (conv, gaps, *self.faults.values(), self.illegal, self.cost, "".join(self.edits), self.sha.hexdigest())


def audit(repaired: DataFrame) -> DataFrame:
    """One row for each conversation of ``repair``: its gaps and faults, the cost, the edits' initials, a digest.

    The digest is over ``role:text`` of the repaired rows, joined by newlines.  A
    conversation without rows has zeros, no edits and the digest of nothing.
    """
    def run(rows):
        now, conv = None, None
        for c, _, turn, role, text, fault, edits in rows:
            if now is None or c != conv:
                if now is not None:
                    yield now.row(conv)
                now, conv = _Audit(), c
            now.add(turn, role, text, fault, edits)
        if now is not None:
            yield now.row(conv)

    kind = dict(repaired.dtypes)["conv_id"]
    ordered = repaired.select("conv_id", "at", "turn", "role", "text", "fault", "edits").repartition("conv_id")
    return map_rows(
        ordered.sortWithinPartitions("conv_id", "at"), run,
        f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, "
        "audit string, repaired_sha256 string",
    )
