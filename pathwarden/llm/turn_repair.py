"""Repair of the turn structure of conversations at the least cost, streamed in the order of their turns.

A good conversation is a system turn, or none, and then user and assistant by turns, ending with the assistant; or it is
empty. Edits make it good: Keep costs 0, Rerole (to user or assistant) 3, Delete 4, Insert of a user or assistant turn
without text 3. Blank turns (white space only) and duplicates (role and text of an earlier turn) must go; a truncated
turn (its last character that is no white space is not one of .!?) that stays costs 3 more. Of the cheapest lists of edits,
written by their initials, the least in ASCII is taken.

Two passes, each a repartition by conversation, a sort by turn, and `mapInPandas`, which carries its state across batches:

- The first streams a conversation from its last turn to its first, without its text. It carries four numbers, the cost
  of all that follows for each state of the grammar. Each turn leaves one byte, the best edit in each state; the bytes go
  out in blocks, as rows, so that Spark's shuffle holds them, whatever the length of a conversation.
- The second streams the turns in order, each block ahead of the turns it covers, and follows the bytes from the first
  state. It carries the state, a block and running figures.

So memory is bounded by a block and a batch, but a conversation is one task's stream in each pass: its digest runs over
all its text in order. The bytes of the first pass are a two-hundredth of a usual text.

Edge cases: a null role or text is one space. Null turns come first; turns of one number are taken by role, then by the
digest of the text. Rows with a null key are one conversation. A role other than system, user or assistant counts by its
first character, as these do; an empty role has none and cannot be kept. Other columns are left out of the result,
whatever their names. An empty table gives an empty result. Texts of any length are whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SPACES = " \t\n\x0b\x0c\r"
#: The turns of a block.
BLOCK = 65_536
#: Characters of a batch that goes out.
BATCH_CHARS = 4_000_000

DELETE, INSERT, KEEP, REROLE = range(4)
INITIALS = "DIKR"
COST = (4, 3, 0, 3)
CUT_COST = 3
SOUND, BLANK, DUPLICATE, CUT = range(4)

#: The states: nothing yet, after system, after user, after assistant. What may be kept in each, and what an insert or rerole gives.
ROLES = " sua"
AFTER = ({1: 1, 2: 2}, {2: 2}, {3: 3}, {2: 2})
FILLED = (2, 2, 3, 2)
FILLING = (None, None, "user", "assistant")
#: The cost of the end in each state.
AT_END = (0, 6, 3, 0)

State = tuple[int, int, int, int]


def step(kind: int, later: State) -> tuple[int, State]:
    """The best edit in each state (two bits each), and the costs from each on; `later` has the costs after this turn."""
    role, fault = divmod(kind, 4)
    more = CUT_COST if fault == CUT else 0
    best = []
    for state in range(4):
        options = [(COST[DELETE] + later[state], DELETE)]
        if fault not in (BLANK, DUPLICATE):
            if role in AFTER[state]:
                options.append((more + later[AFTER[state][role]], KEEP))
            options.append((COST[REROLE] + more + later[FILLED[state]], REROLE))
        best.append(min(options))
    # An insert leads to another state at the same turn; two in a row lead from 0 or 1 to 3.
    two = min(best[2], (COST[INSERT] + best[3][0], INSERT))
    three = min(best[3], (COST[INSERT] + best[2][0], INSERT))
    costs = [*(min(best[s], (COST[INSERT] + two[0], INSERT)) for s in (0, 1)), two, three]
    least = min(c for c, _ in costs)
    return sum(edit << 2 * s for s, (_, edit) in enumerate(costs)), tuple(c - least for c, _ in costs)


def _code(column: Column) -> Column:
    """A value as a string that is never null: pandas would turn numbers with nulls into floats."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def _decode(column: Column, kind) -> Column:
    return F.when(column != "", F.substr(column, F.lit(2)).cast(kind))


def _rows(df: DataFrame, key: str, turn: str, role: str, text: str) -> DataFrame:
    columns = {"role": F.coalesce(F.col(f"`{role}`"), F.lit(" ")), "text": F.coalesce(F.col(f"`{text}`"), F.lit(" "))}
    rows = df.select(_code(F.col(f"`{key}`")).alias("conv"), F.col(f"`{turn}`").cast("long").alias("turn"), *[c.alias(n) for n, c in columns.items()])
    return rows.withColumn("digest", F.unhex(F.sha2("text", 256)))


def _with_kind(rows: DataFrame) -> DataFrame:
    """Rows without text, with `kind` (role and fault) and the number of the same role and text in the conversation."""
    trimmed = F.rtrim(F.col("text"), F.lit(SPACES))
    end = F.substring(trimmed, -1, 1)
    initial = F.substring("role", 1, 1)
    coded = F.coalesce(*[F.when(initial == r, F.lit(n)) for n, r in enumerate(ROLES) if n], F.lit(0))
    thin = rows.select(
        "conv", "turn", "role", "digest", coded.alias("initial"), F.when(trimmed == "", BLANK).when(~end.isin(".", "!", "?"), CUT).otherwise(SOUND).alias("fault")
    )
    # One exchange, by conversation, serves the window as well as the stream.
    same = Window.partitionBy("conv", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    numbered = thin.repartition("conv").withColumn("number", F.row_number().over(same))
    fault = F.when((F.col("fault") != BLANK) & (F.col("number") > 1), DUPLICATE).otherwise(F.col("fault"))
    return numbered.select("conv", "turn", "role", "digest", "number", (F.col("initial") * 4 + fault).alias("kind"))


def _blocks(rows: DataFrame, block: int) -> DataFrame:
    """The best edits of all turns in blocks (conv, turn, role, digest of the first turn; choices and faults, a byte a turn)."""

    def plan(parts: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known: dict[tuple[int, State], tuple[int, State]] = {}
        of, costs, at = None, AT_END, None
        choices, faults = bytearray(), bytearray()
        columns = ["conv", "turn", "role", "digest", "choices", "faults"]

        def closed():
            row = (*at, bytes(reversed(choices)), bytes(reversed(faults)))
            choices.clear()
            faults.clear()
            return row

        for part in parts:
            done = []
            for conv, turn, role, digest, kind in part[["conv", "turn", "role", "digest", "kind"]].itertuples(index=False, name=None):
                if conv != of or len(choices) >= block:
                    if choices:
                        done.append(closed())
                    if conv != of:
                        of, costs = conv, AT_END
                if (kind, costs) not in known:
                    known[kind, costs] = step(kind, costs)
                choice, costs = known[kind, costs]
                choices.append(choice)
                faults.append(kind % 4)
                at = (conv, turn, role, digest)
            if done:
                yield pd.DataFrame(done, columns=columns)
        if choices:
            yield pd.DataFrame([closed()], columns=columns)

    last_first = [F.col("conv"), F.desc_nulls_last("turn"), F.desc("role"), F.desc("digest"), F.desc("number")]
    ordered = _with_kind(rows).sortWithinPartitions(*last_first)
    coded = ordered.select("conv", _code(F.col("turn")).alias("turn"), "role", "digest", "kind")
    return coded.mapInPandas(plan, "conv string, turn string, role string, digest binary, choices binary, faults binary")


def _edited(parts: Iterator[pd.DataFrame]) -> Iterator[tuple]:
    """Follow the blocks: (conv, None) opens a conversation, (conv, (edit, role, text, turn, fault, role before)) is an edit, (None, None) closes it."""
    of, state, choices, faults, at = None, 0, b"", b"", 0

    def filled(to):
        return INSERT, FILLING[to], "", "", SOUND, None

    def rest():
        now = state
        while AT_END[now]:
            now = FILLED[now]
            yield of, filled(now)
        yield None, None

    for part in parts:
        for conv, sort, turn, role, text, more_choices, more_faults in part[["conv", "sort", "turn", "role", "text", "choices", "faults"]].itertuples(index=False, name=None):
            if conv != of:
                if of is not None:
                    yield from rest()
                of, state, choices, at = conv, 0, b"", 0
                yield conv, None
            if sort == 1:
                choices, faults, at = more_choices, more_faults, 0
            if sort != 2:
                continue
            choice, fault = choices[at], faults[at]
            at += 1
            while (edit := choice >> 2 * state & 3) == INSERT:
                state = FILLED[state]
                yield conv, filled(state)
            before = role
            if edit == KEEP:
                state = AFTER[state][ROLES.index(role[0])]
            elif edit == REROLE:
                state = FILLED[state]
                role = FILLING[state]
            yield conv, (edit, role, text, turn, fault, before)
    if of is not None:
        yield from rest()


def _stream(df: DataFrame, key: str, turn: str, role: str, text: str, block: int, also: DataFrame | None = None) -> DataFrame:
    """All turns in order, with their blocks ahead of them; `also` has keys that count as conversations without turns."""
    rows = _rows(df, key, turn, role, text)
    blocks = _blocks(rows, block).withColumn("turn", _decode(F.col("turn"), "long"))
    parts = [rows.withColumn("sort", F.lit(2)), blocks.withColumn("sort", F.lit(1))]
    if also is not None:
        parts.append(also.select(_code(F.col(f"`{key}`")).alias("conv")).distinct().withColumn("sort", F.lit(0)))
    both = parts[0]
    for part in parts[1:]:
        both = both.unionByName(part, allowMissingColumns=True)
    ordered = both.repartition("conv").sortWithinPartitions("conv", F.col("sort") > 0, F.asc_nulls_first("turn"), "role", "digest", "sort")
    return ordered.select("conv", "sort", _code(F.col("turn")).alias("turn"), "role", "text", "choices", "faults")


def repair(df: DataFrame, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK) -> DataFrame:
    """The edits of all conversations: key, place (from 0), edit (D, I, K or R), turn, role, text, fault.

    The rows other than the deleted ones, by place, are the repaired conversation; an inserted one has no turn.
    """

    def edits(parts):
        rows, size, place = [], 0, 0
        columns = ["conv", "place", "edit", "turn", "role", "text", "fault"]
        for conv, edit in _edited(parts):
            if edit is None:
                place = 0
                continue
            what, new_role, new_text, at, fault, _ = edit
            rows.append((conv, place, INITIALS[what], at, new_role, new_text, ("", "blank", "duplicate", "truncated")[fault]))
            place += 1
            size += 64 + len(new_text)
            if size >= BATCH_CHARS:
                yield pd.DataFrame(rows, columns=columns)
                rows, size = [], 0
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    streamed = _stream(df, key, turn, role, text, block)
    found = streamed.mapInPandas(edits, "conv string, place long, edit string, turn string, role string, text string, fault string")
    kind = df.schema[key].dataType
    return found.select(
        _decode(F.col("conv"), kind).alias(key), "place", "edit", _decode(F.col("turn"), "long").alias(turn), F.col("role").alias(role), F.col("text").alias(text), "fault"
    )


def audits(
    df: DataFrame, also: DataFrame | None = None, key: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", block: int = BLOCK
) -> DataFrame:
    """One row per conversation: key, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    `gaps` counts the turn numbers missing between the smallest and the largest, `illegal` the neighbours whose roles do
    not follow each other, `audit` has the initials of the edits, and the digest is that of the repaired turns as
    role:text, joined by newlines. Keys of the table `also` without any turn get zeros, no audit, and the digest of nothing.
    """

    def figures(parts):
        rows, size = [], 0
        columns = ["conv", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        for conv, edit in _edited(parts):
            if conv is None:
                gaps = int(latest) - int(first) + 1 - turns if turns else 0
                rows.append((of, gaps, *faults[1:], illegal, cost, audit.decode(), digest.hexdigest()))
                size += 300 + len(audit)
                if size >= BATCH_CHARS:
                    yield pd.DataFrame(rows, columns=columns)
                    rows, size = [], 0
            elif edit is None:
                of, first, latest, turns, faults, illegal, cost = conv, None, None, 0, [0] * 4, 0, 0
                audit, digest, said, previous = bytearray(), hashlib.sha256(), 0, None
            else:
                what, new_role, new_text, at, fault, before = edit
                audit += INITIALS[what].encode()
                cost += COST[what] + (CUT_COST if fault == CUT and what != DELETE else 0)
                if before is not None:
                    faults[fault] += 1
                    illegal += previous is not None and previous + before[:1] not in ("su", "ua", "au")
                    previous = before[:1]
                    if at and at[1:] != latest:
                        latest = at[1:]
                        first = latest if first is None else first
                        turns += 1
                if what != DELETE:
                    if said:
                        digest.update(b"\n")
                    said += 1
                    digest.update(f"{new_role}:{new_text}".encode())
        if rows:
            yield pd.DataFrame(rows, columns=columns)

    schema = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
    found = _stream(df, key, turn, role, text, block, also).mapInPandas(figures, schema)
    return found.select(_decode(F.col("conv"), df.schema[key].dataType).alias(key), *found.columns[1:])
