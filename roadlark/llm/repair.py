"""Conversation structure repair: the cheapest edits that give a conversation a legal role order.

Legal are the role initials ``(s?(ua)+)?``.  Keep costs 0, Rerole (to user or assistant) 3, Delete 4
and Insert (an empty user or assistant turn, anywhere) 3; blank and repeated turns must go, and a
truncated turn that stays costs 3 more.  Of the cheapest edit strings the ASCII-least is taken.

Method.  A turn is a symbol of role class and fault, and a symbol is a min-plus matrix over the four
states of the role order.  Equal consecutive symbols are collapsed to runs, and a run advances the
vector of remaining costs by cached binary powers of its matrix.  Walking forward again, the choices
of a run are unrolled by halves: the state after any edit string is determined by that string, so
taking the least letter that keeps the remaining cost gives the least string.

Scale.  Turns are range-partitioned by conversation and turn, so a conversation of any size is spread
over tasks; equal rows may fall into different tasks.  A task settles the conversations that lie
inside its range.  Those at its edges, and those larger than ``CUT_BYTES`` or ``CUT_ROWS``, are cut
into segments: first occurrences are found by digest over all segments, then one row per segment (a
matrix) runs backwards, one row per segment (an end state for each start state) runs forwards, and
all segments are unrolled in parallel.

Order inside of a conversation: turn (nulls first), role, the text's first 64 characters, its MD5.
Odd input: a null role or text is one space, an empty role has no initial and cannot be kept, rows
without conv_id are one conversation, repeated rows are repeated turns, an empty table gives no
rows.  Further columns are ignored.  A gap count beyond a long is the largest long.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import groupby
from typing import NamedTuple

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from roadlark.llm.common import Scratch, parts

CUT_BYTES = 8 << 20
CUT_ROWS = 50_000
BLANKS = " \t\n\x0b\x0c\r"
ENDS = ".!?"

KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 3, 4, 3, 3
_FAR = 1 << 60

# ---- the edit automaton --------------------------------------------------------------------------

# States: nothing yet, after s, after u, after a.  An inserted or reroled turn has one possible role.
_START, _S, _U, _A = range(4)
_NEXT = {_START: _U, _S: _U, _U: _A, _A: _U}
_STEP = {(_START, "s"): _S, (_START, "u"): _U, (_S, "u"): _U, (_A, "u"): _U, (_U, "a"): _A}
_ROLE = {_U: "user", _A: "assistant"}
#: Cost of ending in a state: inserts up to a legal end.
END = (0, 2 * INSERT, INSERT, 0)

Vector = tuple[int, ...]
#: Role initial ("" for any that is never legal, None for a turn that must go) and truncation.
Symbol = tuple[str | None, bool]


def _times(a: tuple[Vector, ...], v: Vector) -> Vector:
    return tuple(min(x + y for x, y in zip(row, v, strict=True)) for row in a)


@lru_cache(maxsize=4096)
def power(symbol: Symbol, k: int) -> tuple[Vector, ...]:
    """Min-plus matrix of ``2**k`` turns of a symbol, inserts before each of them included."""
    if k:
        half = power(symbol, k - 1)
        columns = [_times(half, tuple(row[c] for row in half)) for c in range(4)]
        return tuple(zip(*columns, strict=True))
    edit = [[_FAR] * 4 for _ in range(4)]
    initial, cut_off = symbol
    extra = CUT_OFF if cut_off else 0
    for q in range(4):
        edit[q][q] = DELETE
        if initial is not None:
            edit[q][_NEXT[q]] = min(edit[q][_NEXT[q]], REROLE + extra)
            if (q, initial) in _STEP:
                to = _STEP[q, initial]
                edit[q][to] = min(edit[q][to], KEEP + extra)
    rows = []
    for q in range(4):
        best, at, paid = [_FAR] * 4, q, 0
        for _ in range(3):  # two inserts reach every state that inserts can reach
            best = [min(b, paid + e) for b, e in zip(best, edit[at], strict=True)]
            at, paid = _NEXT[at], paid + INSERT
        rows.append(tuple(min(b, _FAR) for b in best))
    return tuple(rows)


def advance(symbol: Symbol, n: int, after: Vector) -> Vector:
    """Remaining costs before ``n`` turns of a symbol, from those after them."""
    k = 0
    while n >> k:
        if n >> k & 1:
            after = _times(power(symbol, k), after)
        k += 1
    return after


@lru_cache(maxsize=65536)
def _unroll(symbol: Symbol, k: int, q: int, after: Vector) -> tuple[str, int]:
    """(edits, end state) for ``2**k`` turns of a symbol."""
    if k:
        left, q = _unroll(symbol, k - 1, q, _level(_times(power(symbol, k - 1), after)))
        right, q = _unroll(symbol, k - 1, q, after)
        return left + right, q
    initial, cut_off = symbol
    extra = CUT_OFF if cut_off else 0
    before, edits = _times(power(symbol, 0), after), []
    while True:
        cost, to = before[q], _NEXT[q]
        if cost == DELETE + after[q]:
            return "".join(edits) + "D", q
        if cost == INSERT + before[to]:
            edits.append("I")
            q = to
            continue
        kept = _STEP.get((q, initial))
        if kept is not None and cost == KEEP + extra + after[kept]:
            return "".join(edits) + "K", kept
        return "".join(edits) + "R", to


def _level(v: Vector) -> Vector:
    """The vector less its least entry: the choices are the same, and there are few such vectors."""
    least = min(v)
    return tuple(x - least for x in v)


Runs = list[tuple[Symbol, int]]


def runs_of(symbols: list[Symbol]) -> Runs:
    return [(symbol, sum(1 for _ in same)) for symbol, same in groupby(symbols)]


def backward(runs: Runs, after: Vector) -> list[Vector]:
    """Remaining costs before each run, and ``after`` itself at the end."""
    out = [after]
    for symbol, n in reversed(runs):
        out.append(advance(symbol, n, out[-1]))
    return out[::-1]


def matrix(runs: Runs) -> list[Vector]:
    """The runs' matrix: column q holds the costs of ending in q."""
    columns = []
    for q in range(4):
        columns.append(backward(runs, tuple(0 if p == q else _FAR for p in range(4)))[0])
    return [tuple(min(c[p], _FAR) for c in columns) for p in range(4)]


def forward(runs: Runs, costs: list[Vector], q: int) -> tuple[str, int]:
    """(edits, end state) of the runs from a start state; inserts behind the last turn are left out."""
    edits = []
    for (symbol, n), after in zip(runs, costs[1:], strict=True):
        stops = [(k, after) for k in range(n.bit_length()) if n >> k & 1]
        for i, (k, _) in enumerate(stops):  # from the back: what remains after each block
            stops[i] = (k, _level(after))
            after = _times(power(symbol, k), after)
        for k, rest in reversed(stops):
            some, q = _unroll(symbol, k, q, rest)
            edits.append(some)
    return "".join(edits), q


def closing(q: int) -> str:
    """Inserts that end a conversation legally."""
    return "I" * (END[q] // INSERT)


def lines(edits: str, q: int, roles: list[str], texts: list[str]) -> tuple[list[str], list[str]]:
    """Roles and texts after the edits, from a start state."""
    out_roles, out_texts, i = [], [], 0
    for edit in edits:
        if edit == "D":
            i += 1
            continue
        if edit == "K":
            q = _STEP[q, roles[i][:1]]
            out_roles.append(roles[i])
        else:
            q = _NEXT[q]
            out_roles.append(_ROLE[q])
        out_texts.append("" if edit == "I" else texts[i])
        i += edit != "I"
    return out_roles, out_texts


# ---- turns of one segment ------------------------------------------------------------------------


class Turns(NamedTuple):
    """Rows of one conversation in order."""

    turns: list[int | None]
    roles: list[str]
    texts: list[str]


def symbols_of(rows: Turns, repeated: Callable[[int], bool]) -> tuple[list[Symbol], dict[str, int]]:
    out, blank, duplicate, truncated = [], 0, 0, 0
    for i, (role, text) in enumerate(zip(rows.roles, rows.texts, strict=True)):
        bare = text.rstrip(BLANKS)
        if not bare:
            blank += 1
            out.append((None, False))
        elif repeated(i):
            duplicate += 1
            out.append((None, False))
        else:
            cut_off = bare[-1] not in ENDS
            truncated += cut_off
            initial = role[:1]
            out.append((initial if initial in ("s", "u", "a") else "", cut_off))
    return out, {"blank": blank, "duplicate": duplicate, "truncated": truncated}


def first_seen(rows: Turns) -> Callable[[int], bool]:
    """Tells of a row whether its role and text stand before it; to be asked in order."""
    seen = set()

    def repeated(i: int) -> bool:
        key = (rows.roles[i], rows.texts[i])
        if key in seen:
            return True
        seen.add(key)
        return False

    return repeated


def illegal_pairs(roles: list[str]) -> int:
    initials = [r[:1] for r in roles]
    return sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))


def gaps_of(least: int | None, most: int | None, distinct: int) -> int:
    return 0 if least is None else min(most - least + 1 - distinct, (1 << 63) - 1)


# ---- segments ------------------------------------------------------------------------------------

SEGMENT = (
    "conv_id long, part int, seg long, settled boolean, turns array<long>, roles array<string>, texts array<string>, "
    "audit string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long"
)
_TYPES = {
    "long": pa.int64(),
    "int": pa.int32(),
    "boolean": pa.bool_(),
    "string": pa.string(),
    "array<long>": pa.list_(pa.int64()),
    "array<int>": pa.list_(pa.int32()),
    "array<string>": pa.list_(pa.string()),
}


def _arrow(ddl: str) -> pa.Schema:
    return pa.schema([(c.split()[0], _TYPES[c.split()[1]]) for c in ddl.split(", ")])


def _batches(rows: Iterator[tuple[dict, int]], ddl: str) -> Iterator[pa.RecordBatch]:
    """Record batches of rows that come with their sizes."""
    schema, held, size = _arrow(ddl), [], 0
    for row, weight in rows:
        held.append(row)
        size += weight + 200
        if size >= CUT_BYTES:
            yield pa.RecordBatch.from_pylist(held, schema)
            held, size = [], 0
    yield pa.RecordBatch.from_pylist(held, schema)


def settle(conv_id: int | None, rows: Turns) -> dict:
    """A whole conversation."""
    symbols, out = symbols_of(rows, first_seen(rows))
    runs = runs_of(symbols)
    costs = backward(runs, END)
    audit, q = forward(runs, costs, _START)
    audit += closing(q)
    known = [t for t in rows.turns if t is not None]
    roles, texts = lines(audit, _START, rows.roles, rows.texts)
    out |= {"conv_id": conv_id, "settled": True, "audit": audit, "roles": roles, "texts": texts}
    out |= {"cost": costs[0][_START], "illegal": illegal_pairs(rows.roles)}
    out["gaps"] = gaps_of(min(known, default=None), max(known, default=None), len(set(known)))
    return out


def _cut(batches: Iterator[pa.RecordBatch], most_rows: int) -> Iterator[tuple[dict, int]]:
    """Settled conversations, and open segments of those at the partition's edges or too large.

    Rows: conv_id, turn, role, text, live (whether the row stands for a turn or its conversation only).
    """
    part = TaskContext.get().partitionId()
    seg, size, conv, begun, cut, first = 0, 0, None, False, False, True
    rows = Turns([], [], [])

    def emit(whole: bool):
        row = settle(conv, rows) if whole else {"conv_id": conv, "settled": False, **rows._asdict()}
        return {**row, "part": part, "seg": seg}, size

    for batch in batches:
        for conv_id, turn, role, text, live in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if begun and (conv_id != conv or size >= CUT_BYTES or len(rows.roles) >= most_rows):
                same = conv_id == conv
                yield emit(not (first or cut or same))
                seg, size, rows = seg + 1, 0, Turns([], [], [])
                first, cut = first and same, same
            begun, conv = True, conv_id
            if live:
                rows.turns.append(turn)
                rows.roles.append(role)
                rows.texts.append(text)
                size += 4 * len(text) + 50
    if begun:
        yield emit(False)


def segments(turns: DataFrame) -> DataFrame:
    """Settled and open segments of a table (conv_id, turn, role, text, live); not live rows only
    name their conversation."""
    text = F.coalesce("text", F.lit(" "))
    rows = turns.select("conv_id", "turn", F.coalesce("role", F.lit(" ")).alias("role"), text.alias("text"), "live")
    order = ["conv_id", "turn", "role", "_head", "_digest"]
    keyed = rows.withColumns({"_head": F.left("text", F.lit(64)), "_digest": F.unhex(F.md5("text"))})
    # Equal rows may be parted anywhere: their place in the input is the last key.
    placed = keyed.withColumn("_place", F.monotonically_increasing_id())
    dealt = placed.repartitionByRange(parts(turns.sparkSession), *order, "_place").sortWithinPartitions(*order)
    most = CUT_ROWS
    return dealt.select(rows.columns).mapInArrow(lambda b: _batches(_cut(b, most), SEGMENT), SEGMENT)


# ---- conversations of several segments -----------------------------------------------------------

_EDGE = (
    "conv_id long, part int, seg long, matrix array<long>, turn_min long, turn_max long, turns_distinct long, "
    "first_role string, last_role string, blank long, duplicate long, truncated long, illegal long"
)
_BACK = (
    "conv_id long, part int, seg long, after array<long>, cost long, turn_min long, turn_max long, "
    "turns_distinct long, blank long, duplicate long, truncated long, illegal long"
)
_ENDS = "conv_id long, part int, seg long, ends array<int>"
_BEGIN = "conv_id long, part int, seg long, begin int, last boolean"


def _parsed(row: dict) -> tuple[Turns, Runs, dict[str, int]]:
    rows, new = Turns(row["turns"], row["roles"], row["texts"]), set(row["firsts"] or ())
    symbols, counts = symbols_of(rows, lambda i: i not in new)
    return rows, runs_of(symbols), counts


def _each(batches: Iterator[pa.RecordBatch], ddl: str, make: Callable[[dict], dict]) -> Iterator[pa.RecordBatch]:
    """One row from each, one input row at a time in Python."""
    def made():
        for batch in batches:
            for i in range(batch.num_rows):
                row = make(batch.slice(i, 1).to_pylist()[0])
                yield row, sum(map(len, row.get("texts", ())))

    return _batches(made(), ddl)


def _edge(row: dict) -> dict:
    rows, runs, counts = _parsed(row)
    known = [t for t in rows.turns if t is not None]
    out = {c: row[c] for c in ("conv_id", "part", "seg")} | counts
    out |= {"matrix": [x for line in matrix(runs) for x in line], "illegal": illegal_pairs(rows.roles)}
    out |= {"turn_min": min(known, default=None), "turn_max": max(known, default=None)}
    ends = {"first_role": rows.roles[0][:1], "last_role": rows.roles[-1][:1]} if rows.roles else {}
    return out | {"turns_distinct": len(set(known)), **ends}


def _backwards(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
    """Segments of each conversation, last first: remaining costs after each, and the seams."""
    conv, after, role, turn, begun = None, END, None, None, False
    for batch in batches:
        for row in batch.to_pylist():
            if not begun or row["conv_id"] != conv:
                conv, after, role, turn, begun = row["conv_id"], END, None, None, True
            out = {c: row[c] for c in _arrow(_BACK).names if c in row}
            out["after"] = list(after)
            if row["last_role"] is not None:
                if role is not None:
                    out["illegal"] += illegal_pairs([row["last_role"], role])
                role = row["first_role"]
            if row["turn_max"] is not None:
                out["turns_distinct"] -= turn is not None and turn == row["turn_max"]
                turn = row["turn_min"]
            flat = row["matrix"]
            after = _times(tuple(tuple(flat[i : i + 4]) for i in range(0, 16, 4)), after)
            yield out | {"cost": after[_START]}, 0


def _ends(row: dict) -> dict:
    _, runs, _ = _parsed(row)
    costs = backward(runs, tuple(row["after"]))
    return {c: row[c] for c in ("conv_id", "part", "seg")} | {"ends": [forward(runs, costs, q)[1] for q in range(4)]}


def _begins(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[dict, int]]:
    """Segments of each conversation, first first: the state in which each begins."""
    q, held = _START, None
    for batch in batches:
        for row in batch.to_pylist():
            if held is not None:
                other = held["conv_id"] != row["conv_id"]
                yield held | {"last": other}, 0
                if other:
                    q = _START
            held = {c: row[c] for c in ("conv_id", "part", "seg")} | {"begin": q}
            q = row["ends"][q]
    if held is not None:
        yield held | {"last": True}, 0


def _unrolled(row: dict) -> dict:
    rows, runs, _ = _parsed(row)
    costs, q = backward(runs, tuple(row["after"])), row["begin"]
    audit, end = forward(runs, costs, q)
    audit += closing(end) if row["last"] else ""
    roles, texts = lines(audit, q, rows.roles, rows.texts)
    out = {c: row[c] for c in ("conv_id", "part", "seg")} | {"settled": True}
    return out | {"audit": audit, "roles": roles, "texts": texts}


def _by_conversation(rows: DataFrame, order: list[Column], ddl: str, stream: Callable) -> DataFrame:
    dealt = rows.repartition(parts(rows.sparkSession), "conv_id").sortWithinPartitions("conv_id", *order)
    return dealt.mapInArrow(lambda b: _batches(stream(b), ddl), ddl)


class Repaired(NamedTuple):
    """``whole``: one row per conversation that one task settled, with its repaired roles and texts.
    ``large``: one row for each other conversation; ``pieces``: their repaired turns (conv_id, part,
    seg, roles, texts), in order of part and seg."""

    whole: DataFrame
    large: DataFrame
    pieces: DataFrame

    def conversations(self) -> DataFrame:
        """conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit."""
        return self.whole.select(self.large.columns).unionByName(self.large)

    def turns(self) -> DataFrame:
        """conv_id, part, seg, place, role, text: the repaired turns, in order of part, seg and place."""
        columns = ["conv_id", "part", "seg", F.posexplode(F.arrays_zip("roles", "texts")).alias("place", "turn")]
        rows = self.whole.select(columns).unionByName(self.pieces.select(columns))
        return rows.select("conv_id", "part", "seg", "place", F.col("turn.roles").alias("role"), F.col("turn.texts").alias("text"))


def repair(turns: DataFrame, scratch: Scratch) -> Repaired:
    """Repair every conversation of a table (conv_id, turn, role, text, live)."""
    every = scratch.keep(segments(turns))
    done = every.where("settled")
    opened = every.where("NOT settled")
    at = ["part", "seg"]

    same = F.md5(F.concat(F.length("row.roles").cast("string"), F.lit(":"), F.col("row.roles"), F.col("row.texts")))
    place = F.struct("part", "seg", "i")
    listed = opened.select("conv_id", *at, F.posexplode(F.arrays_zip("roles", "texts")).alias("i", "row"))
    firsts = listed.groupBy("conv_id", F.unhex(same).alias("same")).agg(F.min(place).alias("first"))
    firsts = firsts.groupBy("first.part", "first.seg").agg(F.collect_list("first.i").alias("firsts"))
    raw = ["conv_id", *at, "turns", "roles", "texts"]
    marked = scratch.keep(opened.select(raw).join(firsts, at, "left"))

    edges = marked.mapInArrow(lambda b: _each(b, _EDGE, _edge), _EDGE)
    back = scratch.keep(_by_conversation(edges, [F.desc("part"), F.desc("seg")], _BACK, _backwards))
    told = marked.join(back.select(*at, "after"), at)
    ends = told.mapInArrow(lambda b: _each(b, _ENDS, _ends), _ENDS)
    begins = _by_conversation(ends, [F.col("part"), F.col("seg")], _BEGIN, _begins)
    begun = told.join(begins.drop("conv_id"), at)
    parted = scratch.keep(begun.mapInArrow(lambda b: _each(b, SEGMENT, _unrolled), SEGMENT))

    counts = ["blank", "duplicate", "truncated", "illegal"]
    figures = back.groupBy("conv_id").agg(
        F.min_by("cost", F.struct(*at)).alias("cost"),
        *[F.sum(c).alias(c) for c in counts],
        F.min("turn_min").alias("least"),
        F.max("turn_max").alias("most"),
        F.sum("turns_distinct").alias("distinct"),
    )
    span = F.col("most").cast("decimal(30,0)") - F.col("least") + 1 - F.col("distinct")
    gaps = F.when(F.col("least").isNull(), 0).otherwise(F.least(span, F.lit((1 << 63) - 1))).cast("bigint")
    inorder = F.array_sort(F.collect_list(F.struct(*at, "audit")))
    audits = parted.groupBy("conv_id").agg(F.array_join(F.transform(inorder, lambda x: x["audit"]), "").alias("audit"))
    joined = figures.join(audits.withColumnRenamed("conv_id", "id"), F.col("conv_id").eqNullSafe(F.col("id")))
    large = joined.select("conv_id", gaps.alias("gaps"), *counts, "cost", "audit")
    return Repaired(done, large, parted.select("conv_id", *at, "roles", "texts"))


# ---- planted damage ------------------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """Turns (conv_id, turn, role, text, live) with faults drawn by the checksum of id and turn:
    of 20 draws 0 drops a turn, 1 empties it, 2 removes its sentence ends, 3 repeats it and 4 makes
    it the user's.  Nulls of any column stand as one space."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    rows = conversations.select(
        "conv_id",
        "turn",
        F.coalesce("role", space).alias("role"),
        F.coalesce("text", space).alias("text"),
        (F.crc32(key.cast("binary")) % 20).alias("_draw"),
    )
    draw = F.col("_draw")
    text = F.when(draw <= 1, "").when(draw == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    damaged = rows.select(
        "conv_id",
        "turn",
        F.when(draw == 0, "").when(draw == 4, "user").otherwise(F.col("role")).alias("role"),
        text.alias("text"),
        (draw != 0).alias("live"),
        F.explode(F.sequence(F.lit(1), F.when(draw == 3, 2).otherwise(1))).alias("_copy"),
    )
    return damaged.drop("_copy")
