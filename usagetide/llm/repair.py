"""Conversation structure repair by weighted interval parsing.

A conversation's roles have to read ``(system? (user assistant)+)?``. Rows may be kept (cost 0), given another
role (2) or deleted (3); rows may be inserted anywhere (2); a row kept or re-roled although its text is cut off
costs 1 more. Blank rows and duplicates must go.

The grammar is in Chomsky normal form. Its symbols X[p,q] stand for "what a span of rows gives leads from p to
q" with p and q among *nothing yet*, *after system*, *after user* and *after assistant*:
X[p,q] -> X[p,r] X[r,q], and X[p,q] -> a row. Insertions are spans of no rows; their closure is part of every
cell. A cell keeps the cheapest (cost, audit), the audit being the edits' initials in order, ties to the
smallest in ASCII. Of two audits of one span and cost none begins the other, as each letter has a fixed cost
at its row; so the smallest whole is made of smallest parts, and a chart of minimal cells is exact.

``chart`` fills spans bottom-up by length, over all cuts, for blocks of ``BLOCK`` rows. Cells of neighbouring
blocks form longer spans in the same way, by twos. That makes a conversation of any length a sum of parts:
rows are cut into ranges of (conversation, turn), every range gives one cell table for each conversation it
holds, and these meet in order. Only the digest of the repaired text has to go through a conversation's rows in one
sequence; it streams them in sorted order and holds none.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from . import text as T

KEEP, REROLE, DELETE, INSERT = "K", "R", "D", "I"
COST = {KEEP: 0, REROLE: 2, DELETE: 3, INSERT: 2}
TRUNCATED_COST = 1
SPACE = " \t\n\x0b\x0c\r"

#: States: nothing yet, after system, after user, after assistant.
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: Where a role's initial leads from each state.
STEP = {
    (NOTHING, "s"): SYSTEM, (NOTHING, "u"): USER, (SYSTEM, "u"): USER, (USER, "a"): ASSISTANT, (ASSISTANT, "u"): USER,
}
FINAL = (NOTHING, ASSISTANT)
LEGAL_PAIRS = {"su", "ua", "au"}
#: Symbols X[p,q] of which some span is made.
SYMBOLS = tuple(
    (p, q) for p in range(4) for q in range(4) if p == q or q in (USER, ASSISTANT) or (p, q) == (NOTHING, SYSTEM)
)
_INDEX = {pq: k for k, pq in enumerate(SYMBOLS)}
#: X[p,q] -> X[p,r] X[r,q] as (left, right, whole).
RULES = tuple((_INDEX[p, r], _INDEX[r2, q], _INDEX[p, q]) for p, r in SYMBOLS for r2, q in SYMBOLS if r == r2 and (p, q) in _INDEX)
BLOCK = 16

Cell = tuple[int, str] | None
Cells = tuple[Cell, ...]


def _best(options: list[tuple[tuple[int, int], Cell]]) -> Cells:
    cells: list[Cell] = [None] * len(SYMBOLS)
    for pq, cell in options:
        k = _INDEX[pq]
        if cells[k] is None or cell < cells[k]:
            cells[k] = cell
    return tuple(cells)


def joined(splits: list[tuple[Cells, Cells]]) -> Cells:
    """Cells of a span from its cuts into two shorter ones."""
    cells: list[Cell] = [None] * len(SYMBOLS)
    for left, right in splits:
        for a, b, k in RULES:
            x, y = left[a], right[b]
            if x is None or y is None:
                continue
            cost, now = x[0] + y[0], cells[k]
            # Audits are put together only where the cost can win.
            if now is None or cost < now[0]:
                cells[k] = (cost, x[1] + y[1])
            elif cost == now[0]:
                audit = x[1] + y[1]
                if audit < now[1]:
                    cells[k] = (cost, audit)
    return tuple(cells)


def _closure() -> Cells:
    """Spans of no rows: any insertions that the states allow."""
    cells = _best([((p, p), (0, "")) for p in range(4)])
    one = _best(
        [((p, p), (0, "")) for p in range(4)]
        + [((p, q), (COST[INSERT], INSERT)) for (p, role), q in STEP.items() if role in "ua"]
    )
    for _ in range(3):
        cells = joined([(cells, one)])
    return cells


EMPTY = _closure()


@lru_cache(maxsize=64)
def row_cells(letter: str) -> Cells:
    """Cells of one row with insertions on both sides.

    ``letter`` is the role's initial (``x`` for a role that is none of them), upper-case if the text is cut
    off; ``d`` is a row that must go.
    """
    options = [((p, p), (COST[DELETE], DELETE)) for p in range(4)]
    if letter != "d":
        more = TRUNCATED_COST if letter.isupper() else 0
        for (p, role), q in STEP.items():
            if role == letter.lower():
                options.append(((p, q), (COST[KEEP] + more, KEEP)))
            if role in "ua":
                options.append(((p, q), (COST[REROLE] + more, REROLE)))
    return joined([(joined([(EMPTY, _best(options))]), EMPTY)])


@lru_cache(maxsize=1 << 15)
def chart(letters: str) -> Cells:
    """Cells of a block of rows: every span, bottom-up by length, over all its cuts."""
    n = len(letters)
    if not n:
        return EMPTY
    spans = {(i, i + 1): row_cells(c) for i, c in enumerate(letters)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            j = i + length
            spans[i, j] = joined([(spans[i, k], spans[k, j]) for k in range(i + 1, j)])
    return spans[0, n]


class Spans:
    """Cells of a growing run of rows: full blocks, joined by twos where two runs of blocks have one length."""

    def __init__(self) -> None:
        self.runs: list[tuple[int, Cells]] = []
        self.letters: list[str] = []

    def add(self, letter: str) -> None:
        self.letters.append(letter)
        if len(self.letters) == BLOCK:
            self._close(1)

    def append(self, cells: Cells) -> None:
        """The cells of the rows that follow, of any number."""
        self._push(1, cells)

    def _close(self, size: int) -> None:
        cells = chart("".join(self.letters))
        self.letters.clear()
        self._push(size, cells)

    def _push(self, size: int, cells: Cells) -> None:
        while self.runs and self.runs[-1][0] <= size:
            before, left = self.runs.pop()
            size, cells = size + before, joined([(left, cells)])
        self.runs.append((size, cells))

    def cells(self) -> Cells:
        whole = chart("".join(self.letters)) if self.letters else EMPTY
        for _, left in reversed(self.runs):
            whole = joined([(left, whole)])
        return whole


def cheapest(cells: Cells) -> tuple[int, str]:
    """Cost and audit of a whole conversation."""
    return min(cells[_INDEX[NOTHING, q]] for q in FINAL)


# ---------------------------------------------------------------- rows


def _spelled(c: str) -> Column:
    return F.coalesce(F.col(c).cast("string"), F.lit(" "))


def damage(talks: DataFrame, parts: int = 20) -> DataFrame:
    """``conv_id``, ``turn``, ``role`` and ``text`` with faults put in by crc32 of ``conv_id:turn``, modulo ``parts``.

    0 drops the row, 1 empties its text, 2 takes its full stops, exclamation and question marks away, 3 repeats it, 4 makes it the
    user's. A null role or text, and a null id or turn in the hashed string, is one space; a null id or
    turn itself stays null.
    """
    pick = F.pmod(F.crc32(F.concat_ws(":", _spelled("conv_id"), _spelled("turn")).cast("binary")), F.lit(parts))
    rows = talks.select("conv_id", "turn", _spelled("role").alias("role"), _spelled("text").alias("text"), pick.alias("pick"))
    text = F.when(F.col("pick") == 1, F.lit("")).when(F.col("pick") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(F.col("pick") == 4, F.lit("user")).otherwise(F.col("role"))
    copies = F.explode(F.array_repeat(F.lit(1), F.when(F.col("pick") == 3, 2).otherwise(1)))
    return (
        rows.where("pick <> 0")
        .select("conv_id", "turn", role.alias("role"), text.alias("text"), copies.alias("copy"))
        .drop("copy")
    )


def marked(rows: DataFrame) -> DataFrame:
    """Rows of ``conv_id``, ``turn``, ``role``, ``text`` as ``conv_id``, ``turn``, ``role``, ``digest``, ``copies``, ``blank``, ``cut``, ``first``.

    Texts are replaced by digests, and rows equal in all four columns are one row with a count, before anything
    is shuffled. ``first``: no row with this role and text comes earlier in the conversation. ``cut``: the last
    character other than white space ends no sentence.
    """
    trimmed = F.rtrim(F.col("text"), F.lit(SPACE))
    slim = rows.select(
        "conv_id", "turn", "role", _digest(), (trimmed == "").alias("blank"), (~F.right(trimmed, F.lit(1)).isin(*".!?")).alias("cut")
    )
    counted = slim.groupBy("conv_id", "turn", "role", "digest").agg(
        F.count(F.lit(1)).alias("copies"), F.first("blank").alias("blank"), F.first("cut").alias("cut")
    )
    said = Window.partitionBy("conv_id", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    return counted.withColumn("first", F.row_number().over(said) == 1)


def _digest() -> Column:
    return F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("digest")


ORDER = ("conv_id", "turn", "role", "digest")
_STATS = ("n", "blank", "duplicate", "truncated", "illegal", "turns")


class _Part:
    """What a run of neighbouring rows of one conversation adds up to."""

    def __init__(self) -> None:
        self.stats = dict.fromkeys(_STATS, 0)
        self.low = self.high = self.last_turn = None
        self.head = self.tail = ""
        self.spans = Spans()

    def row(self, turn: int | None, role: str, copies: int, blank: bool, cut: bool, first: bool) -> None:
        s = self.stats
        initial = role[:1] if role[:1] in ("s", "u", "a") else "x"
        again = 0 if blank else copies - bool(first)
        fresh = bool(first) and not blank
        s["n"] += copies
        s["blank"] += copies if blank else 0
        s["duplicate"] += again
        s["truncated"] += fresh and cut
        s["illegal"] += (bool(self.tail) and self.tail + initial not in LEGAL_PAIRS) + (copies - 1)
        self.head, self.tail = self.head or initial, initial
        if turn is not None:
            s["turns"] += turn != self.last_turn
            self.low = turn if self.low is None else self.low
            self.high = self.last_turn = turn
        if fresh:
            self.spans.add(initial.upper() if cut else initial)
        for _ in range(copies - fresh):
            self.spans.add("d")

    def follow(self, part: dict) -> None:
        """Take in the part that comes next."""
        s = self.stats
        for name in _STATS:
            s[name] += part[name]
        s["illegal"] += bool(self.tail) and self.tail + part["head"] not in LEGAL_PAIRS
        self.tail = part["tail"]
        if part["low"] is not None:
            s["turns"] -= self.high is not None and part["low"] == self.high
            self.low = part["low"] if self.low is None else self.low
            self.high = part["high"]
        self.spans.append(tuple((c, a) if c >= 0 else None for c, a in zip(part["costs"], part["audits"])))

    def as_row(self) -> dict:
        cells = self.spans.cells()
        return self.stats | {
            "low": self.low, "high": self.high, "head": self.head, "tail": self.tail,
            "costs": [-1 if c is None else c[0] for c in cells], "audits": ["" if c is None else c[1] for c in cells],
        }


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, Iterator[dict]]]:
    """Conversations in order with their rows, which are read as they are needed."""
    rows = (row for batch in batches for at in range(0, batch.num_rows, 1024) for row in batch.slice(at, 1024).to_pylist())
    held = next(rows, None)

    def run(key: object) -> Iterator[dict]:
        nonlocal held
        while held is not None and held["conv_id"] == key:
            now, held = held, None
            held = next(rows, None)
            yield now

    while held is not None:
        key = held["conv_id"]
        group = run(key)
        yield key, group
        for _ in group:  # what was not read
            pass


def _written(rows: list[dict], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist(rows, schema)


_CELLS = pa.schema(
    [(name, pa.int64()) for name in _STATS]
    + [("low", pa.int64()), ("high", pa.int64()), ("head", pa.string()), ("tail", pa.string())]
    + [("costs", pa.list_(pa.int64())), ("audits", pa.list_(pa.string()))]
)


def _spark_type(kind: pa.DataType) -> str:
    return {"int64": "long", "string": "string"}.get(str(kind)) or f"array<{_spark_type(kind.value_type)}>"


def _typed(schema: pa.Schema) -> str:
    return ", ".join(f"{f.name} {_spark_type(f.type)}" for f in schema)


def plans(rows: DataFrame) -> DataFrame:
    """Per conversation with rows: ``conv_id``, ``n``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``gaps``, ``cost`` and ``audit``.

    Rows go into ranges of (conversation, turn, role, digest), so one conversation may lie in many ranges.
    """
    kind = rows.schema["conv_id"].dataType.simpleString()
    ranged = marked(rows).repartitionByRange(*ORDER).sortWithinPartitions(*ORDER)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId()
        schema = None
        out: list[dict] = []
        for key, group in _groups(_noted(batches, seen := [])):
            schema = schema or pa.schema([seen[0].field("conv_id"), ("part", pa.int32()), *_CELLS])
            part = _Part()
            for r in group:
                part.row(r["turn"], r["role"], r["copies"], r["blank"], r["cut"], r["first"])
            out.append({"conv_id": key, "part": at} | part.as_row())
            if len(out) >= 1024 or len(out[-1]["audits"][0]) > T.BUFFER_BYTES:
                yield _written(out, schema)
                out = []
        if out:
            yield _written(out, schema)

    found = ranged.mapInArrow(parts, f"conv_id {kind}, part int, {_typed(_CELLS)}")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = None
        out: list[dict] = []
        for key, group in _groups(_noted(batches, seen := [])):
            numbers = [(name, pa.int64()) for name in ("n", "blank", "duplicate", "truncated", "illegal", "gaps", "cost")]
            schema = schema or pa.schema([seen[0].field("conv_id"), *numbers, ("audit", pa.string())])
            talk = _Part()
            for part in group:
                talk.follow(part)
            s = talk.stats
            cost, audit = cheapest(talk.spans.cells())
            gaps = 0 if talk.low is None else talk.high - talk.low + 1 - s["turns"]
            out.append({"conv_id": key, "gaps": gaps, "cost": cost, "audit": audit} | {c: s[c] for c in _STATS if c != "turns"})
            if len(out) >= 1024:
                yield _written(out, schema)
                out = []
        if out:
            yield _written(out, schema)

    schema = f"conv_id {kind}, n long, blank long, duplicate long, truncated long, illegal long, gaps long, cost long, audit string"
    return found.repartition("conv_id").sortWithinPartitions("conv_id", "part").mapInArrow(whole, schema)


def _noted(batches: Iterator[pa.RecordBatch], seen: list) -> Iterator[pa.RecordBatch]:
    """The batches; their schema goes into ``seen`` once."""
    for batch in batches:
        if not seen:
            seen.append(batch.schema)
        yield batch


def edited(audit: str, rows: Iterator[dict]) -> Iterator[tuple[str, str, str, object]]:
    """Edit, role, text and turn of what an audit makes of a conversation's rows; a deleted row is left out."""
    lead = made = 0
    at = 0

    def role() -> str:
        return "assistant" if (made - lead) % 2 else "user"

    for row in rows:
        while audit[at] == INSERT:
            yield INSERT, role(), "", None
            made, at = made + 1, at + 1
        edit, at = audit[at], at + 1
        if edit == DELETE:
            continue
        name = row["role"] if edit == KEEP else role()
        if not made and name[:1] == "s":
            lead = 1
        yield edit, name, row["text"], row["turn"]
        made += 1
    for _ in audit[at:]:
        yield INSERT, role(), "", None
        made += 1


def _in_order(talks: DataFrame, rows: DataFrame, found: DataFrame) -> DataFrame:
    """Each conversation of ``talks`` as one row with its plan (``kind`` 0), followed by its rows (1), sorted by conversation."""
    ids = talks.select(F.col("conv_id").alias("id")).distinct()
    planned = ids.join(found, F.col("id").eqNullSafe(F.col("conv_id")), "left")
    numbers = [c for c in found.columns if c not in ("conv_id", "audit")]
    head = planned.select(
        F.col("id").alias("conv_id"), F.lit(0).alias("kind"), *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
    )
    body = rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", _digest(), "text")
    both = head.unionByName(body, allowMissingColumns=True).repartition("conv_id")
    return both.sortWithinPartitions("conv_id", "kind", "turn", "role", "digest").drop("digest")


_REPORT = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


def report(talks: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """Per conversation of ``talks``: ``conv_id``, gaps, faults, ``cost``, ``audit``, ``repaired_sha256`` and ``n_rows``.

    ``damaged`` (by default the rows of ``talks`` themselves, nulls as one space) has the rows to judge. They are taken by turn,
    nulls first; rows of one turn by role, then by the SHA-256 of their text. A conversation without rows has zeros,
    an empty audit and the hash of an empty text. A null ``conv_id`` is a conversation like any other; further
    columns are left out; an empty table gives an empty one.
    """
    rows = whole_rows(talks) if damaged is None else damaged
    kind = rows.schema["conv_id"].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        schema = None
        for key, group in _groups(_noted(batches, seen := [])):
            numbers = [(name, pa.int64()) for name in _REPORT]
            schema = schema or pa.schema(
                [seen[0].field("conv_id"), *numbers, ("audit", pa.string()), ("repaired_sha256", pa.string()), ("n_rows", pa.int64())]
            )
            plan, digest, lead = next(group), hashlib.sha256(), ""
            for _, role, text, _ in edited(plan["audit"], group):
                digest.update(f"{lead}{role}:{text}".encode())
                lead = "\n"
            row = {"conv_id": key, "audit": plan["audit"], "repaired_sha256": digest.hexdigest(), "n_rows": plan["n"]}
            out.append(row | {c: plan[c] for c in _REPORT})
            if len(out) >= 1024:
                yield _written(out, schema)
                out = []
        if out:
            yield _written(out, schema)

    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in _REPORT)}, audit string, repaired_sha256 string, n_rows long"
    return _in_order(talks, rows, plans(rows)).mapInArrow(work, schema)


def whole_rows(talks: DataFrame) -> DataFrame:
    """The rows of ``talks`` with one space for a null role or text."""
    return talks.select("conv_id", "turn", _spelled("role").alias("role"), _spelled("text").alias("text"))


def repaired(talks: DataFrame, damaged: DataFrame | None = None) -> DataFrame:
    """The repaired conversations: ``conv_id``, ``place`` (from 0), ``edit``, ``role``, ``text`` and ``turn`` (null if inserted).

    Rows are as for ``report``; a conversation that is empty after repair has no row.
    """
    rows = whole_rows(talks) if damaged is None else damaged
    kind, turn = (rows.schema[c].dataType.simpleString() for c in ("conv_id", "turn"))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        schema = None
        held = 0
        for key, group in _groups(_noted(batches, seen := [])):
            schema = schema or pa.schema(
                [seen[0].field("conv_id"), ("place", pa.int64()), ("edit", pa.string()), ("role", pa.string()), ("text", pa.string()), seen[0].field("turn")]
            )
            plan = next(group)
            for place, (edit, role, text, at) in enumerate(edited(plan["audit"], group)):
                out.append({"conv_id": key, "place": place, "edit": edit, "role": role, "text": text, "turn": at})
                held += len(text)
                if len(out) >= 1024 or held > T.BUFFER_BYTES:
                    yield _written(out, schema)
                    out, held = [], 0
        if out:
            yield _written(out, schema)

    schema = f"conv_id {kind}, place long, edit string, role string, text string, turn {turn}"
    return _in_order(talks, rows, plans(rows)).mapInArrow(work, schema)
