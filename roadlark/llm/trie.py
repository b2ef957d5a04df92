"""Prefix trie of conversations: one row per distinct sequence of first turns.

Every conversation may begin with the first turns of a shared one (``rebuilt``).  A turn counts by
role and text; a node of depth d is a sequence of d turns that some conversation starts with.

Method.  Conversations with equal turns are one terminal.  Terminals are sorted so that those with a
common prefix stand together, and the length of the common prefix of sorted neighbours is an edge.
A union-find takes the edges in descending depth: the component that a merge makes is the node at
that depth, and what it joined are its children, each with the chain of single-child nodes above it.
Each task does this for its range of the order.  Nodes that hold a task's first or last terminal may
go on in another range: all below them is contracted to sums, they are sorted again, and the next
round merges such forests over fewer, larger ranges, until one is left.

Keys.  A prefix is the exclusive or of 128-bit hashes of its (depth, turn) pairs, so running prefixes
of a very long conversation are formed in blocks of ``BLOCK`` turns.  A terminal's sort key lists its
prefixes at those depths only where fewer terminals share it than one turn before: elsewhere it has
no neighbour to part from.  It grows with the number of its branchings, not with its turns; the list
of its shared turns, which several distinct conversations have in common, is held by one task.

Scale.  No text is shuffled, only hashes and word counts.  Turns are range-partitioned, so one
conversation may own any share of them; equal conversations are counted before they are shuffled.
Only offsets of conversations that lie in several ranges are broadcast: at most two rows per range.

Odd input: rows without conv_id take no part; a null role or text is empty; null turns come first;
turns with the same number are ordered by role, the text's first 64 characters and hash; repeated
rows are repeated turns; an empty table gives no rows.  Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlark.llm.common import WORD, Scratch, ordered_digests, parts

SHARED = 20  # conversations c - c % SHARED lend their first turns
HEAD = 3  # how many turns they lend at most
BLOCK = 1024
RUN = 100_000  # items that one union-find takes
ITEMS = 50_000  # open nodes per task of a further round
PIECE = 1 << 20  # bytes of joined ids
NOTHING = hashlib.sha256(b"").hexdigest()

_LONG_MAX = (1 << 63) - 1
_ORDER = ["turn", "role_head", "text_head", "d1", "d2"]


def lent(conv_id: str = "conv_id") -> Column:
    """How many turns a conversation takes from its shared one."""
    return (F.crc32(F.col(conv_id).cast("string").cast("binary")) % (HEAD + 1)).cast("int")


def slim(conversations: DataFrame) -> DataFrame:
    """Turns without their texts: order, two hashes and the number of words."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    return conversations.where("conv_id IS NOT NULL").select(
        "conv_id",
        "turn",
        F.left(role, F.lit(64)).alias("role_head"),
        F.left(text, F.lit(64)).alias("text_head"),
        F.xxhash64(role, text).alias("d1"),
        F.xxhash64(F.lit(1), text, role).alias("d2"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )


def heads(turns: DataFrame) -> DataFrame:
    """Rows (conv_id, head, d1, d2, words): what each conversation of the table takes over."""
    base = Window.partitionBy("conv_id").orderBy(*_ORDER)
    first = turns.where(F.col("conv_id") % SHARED == 0).withColumn("head", F.row_number().over(base))
    first = first.where(F.col("head") <= HEAD).select(F.col("conv_id").alias("base"), "head", "d1", "d2", "words")
    ids = turns.select("conv_id").distinct()
    takers = ids.withColumns({"base": F.col("conv_id") - F.col("conv_id") % SHARED, "lent": lent()})
    return takers.join(first, "base").where("head <= lent").select("conv_id", "head", "d1", "d2", "words")


# ---- numbering -----------------------------------------------------------------------------------

_NUMBERED = "conv_id long, part int, own boolean, place long, head_count long, d1 long, d2 long, words long"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Places of rows sorted by (conv_id, own): within this partition, from 0 for each of both kinds."""
    part, last, placed, taken = TaskContext.get().partitionId(), None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        conv = batch.column(0).to_numpy()
        own = batch.column(1).to_numpy(zero_copy_only=False)
        begins = np.ones(n, bool)
        begins[1:] = (conv[1:] != conv[:-1]) | (own[1:] != own[:-1])
        carried = last is not None and last == (conv[0], own[0])
        begins[0] = not carried
        starts = np.maximum.accumulate(np.where(begins, np.arange(n), -1))
        place = np.where(starts < 0, np.arange(n) + placed, np.arange(n) - starts)
        # Rows taken over stand before a conversation's own: their number is known at the latter.
        new = np.ones(n, bool)
        new[1:] = conv[1:] != conv[:-1]
        new[0] = last is None or last[0] != conv[0]
        group = np.cumsum(new)
        counts = np.bincount(group, weights=~own, minlength=group[-1] + 1).astype(np.int64)
        counts[0] += 0 if new[0] else taken
        head_count = counts[group]
        out = [batch.column(0), pa.array(np.full(n, part, np.int32)), batch.column(1), pa.array(place), pa.array(head_count)]
        names = ["conv_id", "part", "own", "place", "head_count", "d1", "d2", "words"]
        yield pa.RecordBatch.from_arrays([*out, *batch.columns[2:]], names=names)
        last, placed, taken = (conv[-1], own[-1]), int(place[-1]) + 1, int(head_count[-1])


def rebuilt(conversations: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """Turns (conv_id, depth, d1, d2, words) of the rebuilt conversations, and (conv_id, size)."""
    turns = slim(conversations)
    own = turns.withColumns({"own": F.lit(True), "head": F.lit(0)})
    own = own.withColumn("_place", F.monotonically_increasing_id())
    taken = heads(turns).withColumn("own", F.lit(False))
    both = own.unionByName(taken, allowMissingColumns=True)
    order = ["conv_id", "own", "head", *_ORDER]
    dealt = both.repartitionByRange(parts(conversations.sparkSession), *order, "_place").sortWithinPartitions(*order)
    rows = dealt.select("conv_id", "own", "d1", "d2", "words").mapInArrow(_number, _NUMBERED)
    rows = scratch.keep(rows)

    per_part = rows.groupBy("conv_id", "part").agg(
        F.count_if(~F.col("own")).alias("heads"), F.count_if("own").alias("owned")
    )
    every = Window.partitionBy("conv_id")
    before = every.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spread = per_part.select(
        "conv_id",
        "part",
        F.sum("heads").over(every).alias("all_heads"),
        F.coalesce(F.sum("heads").over(before), F.lit(0)).alias("heads_before"),
        F.coalesce(F.sum("owned").over(before), F.lit(0)).alias("owned_before"),
        F.count("*").over(every).alias("ranges"),
    )
    spread = spread.where("ranges > 1").drop("ranges")
    sizes = per_part.groupBy("conv_id").agg(F.sum("heads").alias("heads"), F.sum("owned").alias("owned"))
    later = F.greatest(F.col("owned") - lent(), F.lit(0))
    sizes = sizes.select("conv_id", (F.col("heads") + later).alias("size"))

    # A range has a first and a last conversation: no more rows than that are broadcast.
    fixed = rows.join(F.broadcast(spread), ["conv_id", "part"], "left")
    zero = F.lit(0)
    at = F.col("place") + F.coalesce(F.when(F.col("own"), F.col("owned_before")).otherwise(F.col("heads_before")), zero)
    taken_over = F.coalesce("all_heads", "head_count")
    depth = F.when(F.col("own"), taken_over + F.col("at") - lent() + 1).otherwise(F.col("at") + 1)
    fixed = fixed.withColumn("at", at).where(~F.col("own") | (F.col("at") >= lent()))
    return fixed.select("conv_id", depth.cast("long").alias("depth"), "d1", "d2", "words"), sizes


def prefixes(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, depth, p1, p2, words, upto): the prefix that ends with each turn, and its words."""
    block = F.floor((F.col("depth") - 1) / BLOCK).cast("long")
    rows = turns.select(
        "conv_id",
        "depth",
        block.alias("block"),
        F.xxhash64("depth", "d1").alias("h1"),
        F.xxhash64("depth", "d2").alias("h2"),
        "words",
    )
    within = Window.partitionBy("conv_id", "block").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    running = rows.select(
        "conv_id",
        "depth",
        "block",
        F.bit_xor("h1").over(within).alias("p1"),
        F.bit_xor("h2").over(within).alias("p2"),
        "words",
        F.sum("words").over(within).alias("upto"),
    )
    last = F.struct("p1", "p2", "upto")
    blocks = running.groupBy("conv_id", "block").agg(F.max_by(last, "depth").alias("all"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    carry = blocks.select(
        "conv_id",
        "block",
        F.bit_xor("all.p1").over(before).alias("c1"),
        F.bit_xor("all.p2").over(before).alias("c2"),
        F.sum("all.upto").over(before).alias("c_upto"),
    ).where("block > 0")
    joined = running.join(carry, ["conv_id", "block"], "left")
    zero = F.lit(0).cast("long")
    return scratch.keep(
        joined.select(
            "conv_id",
            "depth",
            F.col("p1").bitwiseXOR(F.coalesce("c1", zero)).alias("p1"),
            F.col("p2").bitwiseXOR(F.coalesce("c2", zero)).alias("p2"),
            "words",
            (F.col("upto") + F.coalesce("c_upto", zero)).alias("upto"),
        )
    )


# ---- terminals -----------------------------------------------------------------------------------

KEY = "array<struct<depth:long,p1:long,p2:long,upto:long>>"
ITEM = (
    f"key {KEY}, depth long, upto long, conv_id long, n_convs long, children long, leaves long, saved long, "
    "ends string, real boolean"
)


def _joined_ids(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Ids of sorted equal terminals, joined by commas to pieces."""
    part, piece, held, size, current = TaskContext.get().partitionId(), 0, [], 0, None
    schema = pa.schema(
        [("p1", pa.int64()), ("p2", pa.int64()), ("size", pa.int64()), ("part", pa.int32()), ("place", pa.int64()), ("ids", pa.binary())]
    )

    def row():
        return dict(zip(schema.names, [*current, part, piece, ",".join(held).encode()], strict=True))

    for batch in batches:
        out = []
        for p1, p2, length, conv in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if current is not None and ((p1, p2, length) != current or size >= most):
                out.append(row())
                piece, held, size = piece + 1, [], 0
            current = (p1, p2, length)
            held.append(str(conv))
            size += len(held[-1]) + 1
        yield pa.RecordBatch.from_pylist(out, schema)
    if current is not None:
        yield pa.RecordBatch.from_pylist([row()], schema)


def terminals(known: DataFrame, sizes: DataFrame, scratch: Scratch) -> DataFrame:
    """Distinct rebuilt conversations: conv_id (the least), size, n_convs, ends (digest of all ids), upto."""
    last = known.groupBy("conv_id").agg(F.max_by(F.struct("p1", "p2", "upto"), "depth").alias("last"))
    zero = F.lit(0).cast("long")
    whole = sizes.join(last, "conv_id", "left").select(
        "conv_id", "size", *[F.coalesce(f"last.{c}", zero).alias(c) for c in ("p1", "p2", "upto")]
    )
    whole = scratch.keep(whole)
    same = ["p1", "p2", "size"]
    groups = whole.groupBy(*same).agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("upto").alias("upto"))
    dealt = whole.select(*same, "conv_id").repartitionByRange(parts(known.sparkSession), *same, "conv_id")
    most, ddl = PIECE, "p1 long, p2 long, size long, part int, place long, ids binary"
    pieces = dealt.sortWithinPartitions(*same, "conv_id").mapInArrow(lambda b: _joined_ids(b, most), ddl)
    digests = ordered_digests(pieces, same, ["part", "place"], "ids", b",")
    return scratch.keep(groups.join(digests.withColumnRenamed("digest", "ends"), same))


def items(known: DataFrame, ended: DataFrame) -> DataFrame:
    """Terminals with their sort keys, and the root."""
    some = known.join(ended.select("conv_id"), "conv_id", "left_semi")
    common = some.groupBy("p1", "p2").agg(F.count("*").alias("sharers")).where("sharers > 1")
    shared = some.join(common, ["p1", "p2"])
    row = F.struct("depth", "p1", "p2", (F.col("upto") - F.col("words")).alias("upto"), "sharers", F.col("upto").alias("after"))
    listed = shared.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("shared"))
    joined = ended.join(listed, "conv_id", "left").withColumn("shared", F.coalesce("shared", F.array().cast(listed.schema["shared"].dataType)))
    drops = F.filter(
        "shared",
        lambda x: (x["depth"] == 1) | (x["sharers"] < F.get("shared", (x["depth"] - 2).cast("int"))["sharers"]),
    )
    key = F.transform(drops, lambda x: F.struct(x["depth"], x["p1"], x["p2"], x["upto"]))
    alone = F.size("shared").cast("long") + 1
    words = F.coalesce(F.try_element_at(F.col("shared"), F.lit(-1))["after"], F.lit(0).cast("long"))
    tail = F.array(F.struct(alone.alias("depth"), F.col("conv_id").alias("p1"), F.lit(-1).cast("long").alias("p2"), words.alias("upto")))
    key = F.when(alone <= F.col("size"), F.concat(key, tail)).otherwise(key).cast(KEY)
    zero = F.lit(0).cast("long")
    ends = joined.select(
        key.alias("key"),
        F.col("size").alias("depth"),
        "upto",
        "conv_id",
        "n_convs",
        zero.alias("children"),
        zero.alias("leaves"),
        zero.alias("saved"),
        "ends",
        F.lit(True).alias("real"),
    )
    root = known.sparkSession.range(1).select(
        F.array().cast(KEY).alias("key"),
        *[F.lit(0).cast("long").alias(c) for c in ("depth", "upto")],
        F.lit(None).cast("long").alias("conv_id"),
        *[F.lit(0).cast("long").alias(c) for c in ("n_convs", "children", "leaves", "saved")],
        F.lit(None).cast("string").alias("ends"),
        F.lit(True).alias("real"),
    )
    return ends.unionByName(root)


# ---- the forest ----------------------------------------------------------------------------------

CHAIN = (
    "low long, depth long, low_upto long, upto long, conv_id long, n_convs long, children long, leaves long, "
    "saved long, ends string, id binary, parent binary"
)
FOREST = ITEM + ", low long, low_upto long, id binary, parent binary"
_KEY_TYPE = pa.list_(pa.struct([("depth", pa.int64()), ("p1", pa.int64()), ("p2", pa.int64()), ("upto", pa.int64())]))
_FOREST = pa.schema(
    [("key", _KEY_TYPE)]
    + [(c, pa.int64()) for c in ("depth", "upto", "conv_id", "n_convs", "children", "leaves", "saved")]
    + [("ends", pa.string()), ("real", pa.bool_()), ("low", pa.int64()), ("low_upto", pa.int64())]
    + [("id", pa.binary()), ("parent", pa.binary())]
)

Key = list[tuple[int, int, int, int]]


def node_id(key: Key, depth: int) -> bytes:
    """A name of the node at a depth on a key's path, the same from every key that passes it."""
    passed = [x for step in key if step[0] <= depth for x in step[:3]]
    return hashlib.blake2b(np.array([depth, *passed], np.int64).tobytes(), digest_size=16).digest()


def common_prefix(a: dict, b: dict) -> tuple[int, int]:
    """(depth, words) up to which two paths agree."""
    for x, y in zip(a["key"], b["key"], strict=False):
        if x != y:
            return x[0] - 1, x[3]
    return min((a["depth"], a["upto"]), (b["depth"], b["upto"]))


class _Forest:
    """Union-find over one sorted run of items."""

    def __init__(self, run: list[dict], final: bool) -> None:
        self.nodes = [{**item, "lo": i, "hi": i} for i, item in enumerate(run)]
        self.above = list(range(len(run)))
        self.end = len(run) - 1
        self.final = final
        self.out: list[dict] = []
        edges = [(*common_prefix(a, b), i) for i, (a, b) in enumerate(zip(run, run[1:], strict=False))]
        for depth, upto, i in sorted(edges, key=lambda e: (-e[0], e[2])):
            self.merge(self.find(i), self.find(i + 1), depth, upto)
        top = self.nodes[self.find(0)]
        self.leave(top, -1, 0)

    def find(self, i: int) -> int:
        root = i
        while self.above[root] != root:
            root = self.above[root]
        while self.above[i] != root:
            self.above[i], i = root, self.above[i]
        return root

    def leave(self, node: dict, low: int, low_upto: int) -> dict | None:
        """Close a node, or pass it on if it may reach into another run."""
        row = {c: node[c] for c in ("key", "depth", "upto", "conv_id", "n_convs", "children", "leaves", "saved", "ends")}
        if not self.final and (node["lo"] == 0 or node["hi"] == self.end):
            self.out.append(row | {"real": True})
            return None
        row["leaves"] = node["leaves"] if node["children"] else 1
        named = {"id": node_id(node["key"], node["depth"]), "parent": node_id(node["key"], low) if low >= 0 else None}
        self.out.append(row | {"key": None, "real": False, "low": low, "low_upto": low_upto, **named})
        saved = node["saved"] + max(node["n_convs"] - 1, 0) * (node["upto"] - low_upto)
        return {"conv_id": node["conv_id"], "n_convs": node["n_convs"], "leaves": row["leaves"], "saved": saved}

    def merge(self, a: int, b: int, depth: int, upto: int) -> None:
        """Join two components at a depth: each is the node there itself or becomes its child."""
        left, right = self.nodes[a], self.nodes[b]
        new = {"key": left["key"], "depth": depth, "upto": upto, "conv_id": None, "ends": None, "lo": left["lo"], "hi": right["hi"]}
        new |= {"n_convs": 0, "children": 0, "leaves": 0, "saved": 0}
        new["key"] = [step for step in left["key"] if step[0] <= depth]
        for node in (left, right):
            itself = node["depth"] == depth
            part = node if itself else self.leave(node, depth, upto)
            if part is None:
                continue
            for c in ("n_convs", "leaves", "saved"):
                new[c] += part[c]
            new["children"] += node["children"] if itself else 1
            ids = [x for x in (new["conv_id"], part["conv_id"]) if x is not None]
            new["conv_id"] = min(ids, default=None)
            if itself:
                new["ends"] = new["ends"] or node["ends"]
        self.above[b] = a
        self.nodes[a] = new


def _grow(batches: Iterator[pa.RecordBatch], final: bool, most: int) -> Iterator[pa.RecordBatch]:
    """Closed chains and open nodes of a sorted range."""
    run: list[dict] = []
    for batch in batches:
        for row in batch.to_pylist():
            row["key"] = [(s["depth"], s["p1"], s["p2"], s["upto"]) for s in row["key"]]
            run.append(row)
            if len(run) >= most and not final:
                yield _rows(_Forest(run, final))
                run = []
    if run:
        yield _rows(_Forest(run, final))


def _rows(forest: _Forest) -> pa.RecordBatch:
    names = ("depth", "p1", "p2", "upto")
    for row in forest.out:
        if row["key"] is not None:
            row["key"] = [dict(zip(names, s, strict=True)) for s in row["key"]]
    return pa.RecordBatch.from_pylist(forest.out, _FOREST)


def chains(ended: DataFrame, scratch: Scratch) -> DataFrame:
    """All nodes, as chains from just below ``low`` down to ``depth`` with the same members."""
    n, open_items, closed, most = parts(ended.sparkSession), ended, [], RUN
    while True:
        final = n == 1
        dealt = open_items.repartition(1) if final else open_items.repartitionByRange(n, F.slice("key", 1, 64), "depth")
        rows = dealt.sortWithinPartitions("key", "depth").select(ended.columns)
        grown = scratch.keep(rows.mapInArrow(lambda b, final=final: _grow(b, final, most), FOREST))
        closed.append(grown.where("NOT real").select([c.split()[0] for c in CHAIN.split(", ")]))
        if final:
            break
        open_items = grown.where("real").select(ended.columns)
        n = min(n // 2, -(-open_items.count() // ITEMS)) or 1
    out = closed[0]
    for more in closed[1:]:
        out = out.unionByName(more)
    return out


def _spread(rows: DataFrame) -> DataFrame:
    """One row per depth of each chain; long chains are dealt out in blocks."""
    size = 10_000
    steps = F.sequence(F.col("low") + 1, F.col("depth"), F.lit(size).cast("long"))
    blocks = rows.withColumn("from", F.explode(steps))
    long = F.col("depth") - F.col("low") > 10 * size
    blocks = blocks.where(~long).unionByName(blocks.where(long).repartition(parts(rows.sparkSession), "id", "from"))
    end = F.least(F.col("from") + size - 1, F.col("depth"))
    return blocks.withColumn("at", F.explode(F.sequence("from", end))).drop("from")


def nodes(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """Every node: conv_id (its least member), depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens and ends_sha256."""
    turns, sizes = rebuilt(conversations, scratch)
    known = prefixes(turns, scratch)
    ended = terminals(known, sizes, scratch)
    every = scratch.keep(chains(items(known, ended), scratch).where("n_convs > 0"))

    parents = every.select(F.col("id").alias("parent"), F.col("conv_id").alias("parent_conv"))
    rows = _spread(every.join(parents, "parent", "left"))
    # The words up to a node's parent are known at a chain's upper end; between, the least member's turns tell.
    inside = (F.col("at") > F.col("low") + 1) & (F.col("n_convs") > 1)
    upto = known.select("conv_id", F.col("depth").alias("at"), (F.col("upto") - F.col("words")).alias("before"))
    told = rows.where(inside).join(upto, ["conv_id", "at"])
    rows = told.unionByName(rows.where(~inside).withColumn("before", F.col("low_upto")))
    bottom = F.col("at") == F.col("depth")
    more = F.greatest(F.col("n_convs") - 1, F.lit(0)) * (F.col("upto") - F.col("before"))
    return rows.select(
        "conv_id",
        F.col("at").alias("depth"),
        F.when(F.col("at") == F.col("low") + 1, F.col("parent_conv")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(bottom, F.col("children")).otherwise(F.lit(1).cast("long")).alias("n_children"),
        F.col("leaves").alias("n_leaves"),
        (F.col("saved") + more).alias("saved_tokens"),
        F.coalesce(F.when(bottom, F.col("ends")), F.lit(NOTHING)).alias("ends_sha256"),
    )
