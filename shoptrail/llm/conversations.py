"""Conversation structure repair by weighted CYK interval parsing.

A good conversation has the role initials ``(s?(ua)+)?``. Rows may be kept (0), given the role user or assistant (2) or deleted (3),
and empty rows of user or assistant may be inserted anywhere (2); a row that stays although it is truncated adds 1, and blank and
duplicate rows have to go. The cheapest edits are wanted, of equal ones those whose initials D, I, K, R are least in ASCII.

The grammar is in Chomsky normal form: its symbols ``(p, q)`` are the spans that lead from one point of a conversation to another
(START, after the SYSTEM row, after a USER row, after an ASSISTANT row), its rules ``(p, q) -> (p, r) (r, q)``. A cell of the chart
holds for every symbol the least (cost, audit) over one span; a span of one row has that row's edits, a longer one the best over
all its cuts, built bottom-up by span length, and closed over insertions, which are spans without a row. Equal costs never belong to
audits of which one begins the other, so least parts make least wholes.

Long conversations are cut into blocks of ``BLOCK`` rows, parsed side by side on all executors; blocks become the leaves of the next
chart, ``BLOCK`` at a time, until one is left, so a chart is never larger than that and the rows of one conversation never meet in
one chart. Positions come from a range sort, so the rows of one long conversation are numbered in many tasks. What follows the
repair (edits laid on rows in order) streams: a task holds the audit of one conversation and one batch.

Rows are taken by turn, nulls first; rows of one turn by a hash of role and text, so equal rows stand together. A null role or text
counts as one space; so such a role is no legal one and such a text blank. Null conversation ids are a conversation of their own.
Other columns are not read. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.ordering import global_rank
from ..session import materialize

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
STEPS = [(START, "s", SYSTEM), (START, "u", USER), (SYSTEM, "u", USER), (ASSISTANT, "u", USER), (USER, "a", ASSISTANT)]
SPACES = " \t\n\x0b\x0c\r"
BLOCK = 16
REMEMBERED = 50_000  # spans of a task

Cell = tuple[tuple[int, str] | None, ...]


def _symbols() -> list[tuple[int, int]]:
    """All (p, q) where q can be reached from p, in no step or in some."""
    reached = {(p, p) for p in range(4)}
    while more := {(p, q) for p, r in reached for a, _, q in STEPS if a == r} - reached:
        reached |= more
    return sorted(reached)


SYMBOLS = _symbols()
AT = {symbol: i for i, symbol in enumerate(SYMBOLS)}
RULES = [(AT[p, q], AT[p, r], AT[r, q]) for p, q in SYMBOLS for r in range(4) if (p, r) in AT and (r, q) in AT]


def least(cell: list, at: int, cost: int, audit: str) -> None:
    best = cell[at]
    if best is None or cost < best[0] or (cost == best[0] and audit < best[1]):
        cell[at] = (cost, audit)


def _inserted() -> Cell:
    """The cell of a span without rows: for every symbol the fewest insertions; None where only a system row leads there."""
    cell: list[tuple[int, str] | None] = [None] * len(SYMBOLS)
    for p in range(4):
        cell[AT[p, p]] = (0, "")
    for _ in range(4):
        for p, q in SYMBOLS:
            for a, initial, b in STEPS:
                if initial != "s" and a == q and cell[AT[p, q]] is not None:
                    cost, audit = cell[AT[p, q]]
                    least(cell, AT[p, b], cost + INSERT, audit + "I")
    return tuple(cell)


EMPTY = _inserted()


def joined(left: Cell, right: Cell, into: list) -> None:
    """Every rule of the grammar over two neighbouring spans."""
    for at, a, b in RULES:
        x, y = left[a], right[b]
        if x is not None and y is not None:
            cost, best = x[0] + y[0], into[at]
            if best is None or cost < best[0]:
                into[at] = (cost, x[1] + y[1])
            elif cost == best[0] and (audit := x[1] + y[1]) < best[1]:
                into[at] = (cost, audit)


def closed(cell: list) -> Cell:
    """``cell`` with insertions before and after its rows."""
    after: list[tuple[int, str] | None] = [None] * len(SYMBOLS)
    joined(tuple(cell), EMPTY, after)
    both: list[tuple[int, str] | None] = [None] * len(SYMBOLS)
    joined(EMPTY, tuple(after), both)
    return tuple(both)


def leaf(letter: str) -> Cell:
    """The cell of one row, by the letter that ``row_letter`` gives it."""
    role, fault = divmod(ord(letter) - ord("a"), 3)
    cell: list[tuple[int, str] | None] = [None] * len(SYMBOLS)
    for p in range(4):
        least(cell, AT[p, p], DELETE, "D")
    if fault != 2:
        extra = TRUNCATED if fault else 0
        for p, initial, q in STEPS:
            if "sua"[role:role + 1] == initial:
                least(cell, AT[p, q], KEEP + extra, "K")
            if initial != "s":
                least(cell, AT[p, q], REROLE + extra, "R")
    return closed(cell)


def parsed(leaves: Sequence[Cell]) -> Cell:
    """The cell over all leaves: the chart, bottom-up by span length."""
    spans = list(leaves)
    chart = [spans]
    for length in range(2, len(leaves) + 1):
        spans = []
        for start in range(len(leaves) - length + 1):
            cell: list[tuple[int, str] | None] = [None] * len(SYMBOLS)
            for cut in range(1, length):
                joined(chart[cut - 1][start], chart[length - cut - 1][start + cut], cell)
            spans.append(closed(cell))
        chart.append(spans)
    return chart[-1][0]


def answer(cell: Cell) -> tuple[int, str]:
    """The cheapest repair: all rows gone, or a whole conversation."""
    return min(x for x in (cell[AT[START, START]], cell[AT[START, ASSISTANT]]) if x is not None)


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def row_letter(role: Column, must_go: Column, truncated: Column) -> Column:
    """A letter for what a row means to the grammar: its role's initial (s, u, a, other) and whether it is good, truncated or has to go."""
    kind = F.when(_initial(role) == "s", 0).when(_initial(role) == "u", 1).when(_initial(role) == "a", 2).otherwise(3)
    return F.char(kind * 3 + F.when(must_go, 2).when(truncated, 1).otherwise(0) + ord("a"))


def numbered(df: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """(key, at, turn, role, text, fault): rows of each conversation in order from 1; the key is never null."""
    key = F.coalesce(F.concat(F.lit("="), F.col(conv).cast("string")), F.lit(""))
    rows = df.select(
        key.alias("key"), F.col(turn).cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(n) for c, n in ((role, "role"), (text, "text"))])
    rows = rows.withColumn("same", F.sha2(F.concat(F.length("role"), F.lit(":"), "role", "text"), 256))
    # equal rows of a turn are alike whichever comes first; the id tells them apart for the range sort only
    rows = global_rank(rows.withColumn("copy", F.monotonically_increasing_id()), ["turn", "same", "copy"], ["key"], "at")
    bare = F.rtrim(F.col("text"), F.lit(SPACES))
    rows = rows.select("key", F.col("at").cast("bigint").alias("at"), "turn", "role", "text", "same", bare.alias("bare")).select(
        "key", "at", "turn", "role", "text", "same", (F.col("bare") == "").alias("blank"), (~F.substring("bare", -1, 1).isin(".", "!", "?")).alias("cut"))
    # the first of equal rows, combined before the shuffle; its position is a key of its own, so no text is a hot key of the join
    first = rows.groupBy("key", "same").agg(F.min("at").alias("at")).select("key", "at", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), "blank").when(F.col("first").isNull(), "duplicate").when(F.col("cut"), "truncated").otherwise("")
    return rows.join(first, ["key", "at"], "left").select("key", "at", "turn", "role", "text", fault.alias("fault"))


def _cells(rows: DataFrame) -> DataFrame:
    """(key, block, costs, audits): the cell of each block of rows."""
    letter = row_letter(F.col("role"), F.col("fault").isin("blank", "duplicate"), F.col("fault") == "truncated")
    lettered = rows.select("key", F.expr(f"(at - 1) div {BLOCK}").alias("block"), F.struct("at", letter.alias("letter")).alias("row"))
    word = F.array_join(F.transform(F.array_sort(F.collect_list("row")), lambda r: r["letter"]), "")
    return _charted(lettered.groupBy("key", "block").agg(word.alias("word")), _words)


def _words(batch: pa.RecordBatch, known: dict) -> list[Cell]:
    cells = []
    for word in batch.column(2).to_pylist():
        if (cell := known.get(word)) is None:
            if len(known) > REMEMBERED:
                known.clear()
            cell = known[word] = parsed([leaf(letter) for letter in word])
        cells.append(cell)
    return cells


def _blocks(batch: pa.RecordBatch, known: dict) -> list[Cell]:
    cells = []
    for parts in batch.column(2).to_pylist():
        leaves = [tuple(None if c is None else (c, a) for c, a in zip(p["costs"], p["audits"], strict=True)) for p in parts]
        cells.append(parsed(leaves))
    return cells


def _charted(df: DataFrame, cells) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[str, Cell] = {}
        for batch in batches:
            found = cells(batch, known)
            costs = pa.array([[None if x is None else x[0] for x in cell] for cell in found], pa.list_(pa.int64()))
            audits = pa.array([[None if x is None else x[1] for x in cell] for cell in found], pa.list_(pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), costs, audits], names=["key", "block", "costs", "audits"])

    return df.mapInArrow(run, "key string, block long, costs array<long>, audits array<string>")


def audits(rows: DataFrame) -> DataFrame:
    """(key, audit): the cheapest edits of every conversation."""
    level, ready = materialize(_cells(rows)), []
    while not (more := level.filter("block = 1").select("key")).isEmpty():  # one row for each conversation of several blocks
        ready.append(level.join(more, "key", "left_anti"))
        part = F.struct("block", "costs", "audits")
        grouped = level.join(more, "key", "left_semi").select("key", F.expr(f"block div {BLOCK}").alias("up"), part.alias("part"))
        level = materialize(_charted(grouped.groupBy("key", "up").agg(F.array_sort(F.collect_list("part")).alias("parts")), _blocks))
    for other in ready:
        level = level.unionByName(other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for costs, texts in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
                found.append(answer(tuple(None if c is None else (c, a) for c, a in zip(costs, texts, strict=True)))[1])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.string())], names=["key", "audit"])

    return level.select("key", "costs", "audits").mapInArrow(run, "key string, audit string")


STEP_SCHEMA = "key string, step long, edit string, turn long, role string, text string, role_before string, fault string"


def _edited(rows: DataFrame) -> DataFrame:
    """The steps of every repair in order, each conversation inside one partition (``STEP_SCHEMA``)."""
    lead = audits(rows).select("key", F.lit(0).cast("bigint").alias("at"), F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"),
                               F.col("audit").alias("text"), F.lit("").alias("fault"))
    laid = rows.unionByName(lead).repartition("key").sortWithinPartitions("key", "at")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        audit, tail, done, stayed, system = "", 0, 0, 0, False

        def role_here() -> str:
            return "user" if (stayed - system) % 2 == 0 else "assistant"

        for batch in batches:
            out: list[tuple] = []
            keys, at, turns, roles, texts, faults = (c.to_pylist() for c in batch.columns)
            for i, key in enumerate(keys):
                if at[i] == 0:
                    audit, tail, done, stayed = texts[i], len(texts[i].rstrip("I")), 0, 0
                    system = (len(audit) - audit.count("D")) % 2 == 1
                    continue
                while audit[done] == "I":
                    out.append((key, done, "I", None, role_here(), "", None, ""))
                    done, stayed = done + 1, stayed + 1
                edit = audit[done]
                role = role_here() if edit == "R" else roles[i]
                out.append((key, done, edit, turns[i], role, texts[i], roles[i], faults[i]))
                done, stayed = done + 1, stayed + (edit != "D")
                while tail <= done < len(audit):  # after the last row
                    out.append((key, done, "I", None, role_here(), "", None, ""))
                    done, stayed = done + 1, stayed + 1
            kinds = [pa.string(), pa.int64(), pa.string(), pa.int64(), *[pa.string()] * 4]
            columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
            names = [field.split()[0] for field in STEP_SCHEMA.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return laid.select("key", "at", "turn", "role", "text", "fault").mapInArrow(run, STEP_SCHEMA)


def _named(df: DataFrame, conv: str, kind) -> list[Column]:
    name = F.when(F.col("key") == "", F.lit(None)).otherwise(F.substr("key", F.lit(2))).cast(kind)
    return [name.alias(conv), *[F.col(c) for c in df.columns if c != "key"]]


def repair(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each edit: (conv, step, edit, turn, role, text, role_before, fault), ``step`` from 0 inside each conversation.

    ``role`` is the repaired one; rows whose ``edit`` is ``D`` are gone from the repaired conversation, ``I`` rows are new.
    """
    steps = _edited(numbered(df, conv, turn, role, text))
    return steps.select(*_named(steps, conv, df.schema[conv].dataType))


COUNTS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: turn gaps, faults, illegal neighbours, the cost and initials of its repair, and a SHA-256 of the result."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = None

        def begun(key: str) -> dict:
            return {"key": key, **dict.fromkeys(COUNTS, 0), "edits": [], "sha": hashlib.sha256(), "lines": 0, "turns": 0, "low": None, "high": None, "initial": None}

        def ended(x: dict) -> tuple:
            x["gaps"] = 0 if x["low"] is None else x["high"] - x["low"] + 1 - x["turns"]
            return x["key"], *[x[c] for c in COUNTS], "".join(x["edits"]), x["sha"].hexdigest()

        for batch in batches:
            out = []
            keys, _, edits, turns, roles, texts, before, faults = (c.to_pylist() for c in batch.columns)
            for i, key in enumerate(keys):
                if own is None or own["key"] != key:
                    if own is not None:
                        out.append(ended(own))
                    own = begun(key)
                edit, fault = edits[i], faults[i]
                own["edits"].append(edit)
                own["cost"] += {"K": KEEP, "R": REROLE, "D": DELETE, "I": INSERT}[edit] + (TRUNCATED if fault == "truncated" and edit != "D" else 0)
                if edit != "D":
                    own["sha"].update((f"\n{roles[i]}:" if own["lines"] else f"{roles[i]}:").encode() + texts[i].encode())
                    own["lines"] += 1
                if edit == "I":
                    continue
                if fault:
                    own[fault] += 1
                if turns[i] is not None and turns[i] != own["high"]:  # turns ascend
                    own["low"] = turns[i] if own["low"] is None else own["low"]
                    own["high"], own["turns"] = turns[i], own["turns"] + 1
                initial = before[i][:1]
                if own["initial"] is not None and own["initial"] + initial not in ("su", "ua", "au"):
                    own["illegal"] += 1
                own["initial"] = initial
            yield made(out)
        if own is not None:
            yield made([ended(own)])

    def made(out: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.string(), *[pa.int64()] * len(COUNTS), pa.string(), pa.string()]
        columns = list(zip(*out, strict=True)) or [[]] * len(kinds)
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["key", *COUNTS, "audit", "repaired_sha256"])

    schema = ", ".join(["key string", *[f"{c} long" for c in COUNTS], "audit string, repaired_sha256 string"])
    summed = _edited(numbered(df, conv, turn, role, text)).mapInArrow(run, schema)  # no exchange between: the steps arrive in order
    return summed.select(*_named(summed, conv, df.schema[conv].dataType))


def damaged(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv, turn, role, text) with faults by crc32 of ``conv:turn`` modulo 20: 0 drops a row, 1 empties it, 2 takes its stops, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    named = F.concat(F.coalesce(F.col(conv).cast("string"), space), F.lit(":"), F.coalesce(F.col(turn).cast("string"), space))
    fate = F.crc32(named.cast("binary")) % 20
    words = F.coalesce(F.col(text), space)
    hurt = df.select(
        F.col(conv), F.col(turn), fate.alias("__fate__"),
        F.when(fate == 4, "user").otherwise(F.coalesce(F.col(role), space)).alias(role),
        F.when(fate == 1, "").when(fate == 2, F.translate(words, ".!?", "")).otherwise(words).alias(text))
    copies = F.explode(F.when(F.col("__fate__") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
    return hurt.filter("__fate__ <> 0").select("*", copies.alias("__copy__")).select(conv, turn, role, text)


def damage_report(df: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The report after ``damaged``, with every conversation of ``df``: one that lost all rows has zeros, no edits and the hash of nothing."""
    found = report(damaged(df, conv, turn, role, text), conv, turn, role, text).withColumnRenamed(conv, "__conv__")
    named = df.select(conv).distinct().join(found, F.col(conv).eqNullSafe(F.col("__conv__")), "left").drop("__conv__")
    return named.fillna(0, COUNTS).fillna({"audit": "", "repaired_sha256": hashlib.sha256().hexdigest()})
