"""Substring dedup by the common-prefix interval tree of an enhanced suffix array.

All strings of ``length`` bytes that start at two places at least are found, and the bytes that
they cover are removed.  A suffix array of all texts fits no task, so it is cut into groups that
hold equal strings together:

1. Of the k-byte pieces in a string, the one of the least hash is its anchor; equal strings have
   equal anchors at equal offsets.  Neighbouring strings mostly share an anchor, so each anchor
   of a text serves a range of start positions; the bytes of these strings are its context.
   Anchors whose piece occurs once are done: none of their strings repeats.
2. Anchors of equal pieces and equal contexts repeat as a whole.  They are counted inside tasks
   first, so copies of a third of all texts load nobody.
3. Pieces with several contexts get a suffix array: the suffixes of their distinct contexts are
   sorted, and a stack scan over the common-prefix lengths of neighbours lists the intervals of
   suffixes with a common prefix of ``length`` or more.  An interval whose suffixes are preceded
   by different bytes cannot be extended to the left: it is a maximal repeat, with all suffixes
   of the interval as its occurrences, inside of the contexts at hand.
4. A piece with very many contexts would overload a task: its contexts are cut into their single
   strings, which are counted like contexts in step 2.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlark.llm.common import RollingSums, Scratch, mix, parts, slices, unused, utf8

LENGTH = 400
# The piece is so much shorter than the strings; anchors stand some fifty bytes apart.
SPREAD = 100
SLICE_BYTES = 1 << 19
FLUSH = 1_000_000
# Contexts of one piece that one task sorts; contexts that one call handles.
CONTEXTS = 4096
CELL = 20_000
CUT_BYTES = 8 << 20  # of contexts per Arrow batch

_ROLLING = RollingSums(seed=7)
_PLACE = 24
KINDS = {"key": "u4", "context": "u8", "doc": "i8", "variant": "i8", "start": "u4", "reach": "u2"}


def _home() -> list:
    """Id and variant of a row: a hash of its whole text tells texts of one id, or of none, apart."""
    doc_id = F.coalesce(F.col("doc_id").cast("long"), F.lit(NOBODY)).alias("doc_id")
    return [doc_id, F.xxhash64("text").alias("variant")]


def _least(piece: np.ndarray, spread: int) -> np.ndarray:
    """The place of the least of spread + 1 pieces from each piece on, the first one of equals."""
    # Place is below hash.
    low = np.uint64((1 << _PLACE) - 1)
    least, width = (piece & ~low) | np.arange(len(piece), dtype=np.uint64), 1
    while 2 * width <= spread + 1:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = spread + 1 - width
    least = np.minimum(least[: len(least) - rest], least[rest:])
    return (least & low).astype(np.int64)


def anchors(data: np.ndarray, offsets: np.ndarray, length: int, spread: int):
    """(piece hash, context hash, text, first start, last start) of all anchors, in order."""
    k, n = length - spread, len(data)
    empty = np.empty(0, np.int64)
    if n < length:
        return empty.view(np.uint64), empty.view(np.uint64), empty, empty, empty
    sums = _ROLLING.sums(data)
    at = np.arange(n - k + 1)
    piece = _ROLLING.ranges(sums, at, at + k)
    # A place has _PLACE bits, so long texts are searched in windows that share spread pieces.
    step = (1 << _PLACE) - spread
    windows = range(0, len(piece) - spread, step)
    anchor = np.concatenate([w + _least(piece[w : w + step + spread], spread) for w in windows])
    text = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    inside = text[: len(anchor)] == text[length - 1 :]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1 : len(anchor)] != text[: len(anchor) - 1])
    new[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor)) - 1
    first, last = first[inside[first]], last[inside[first]]
    place = anchor[first]
    context = _ROLLING.ranges(sums, first, last + length)
    context = mix(context + (place - first).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    return piece[place], context, text[first], first, last


def pieces_of(texts: pa.Array):
    """(rows i to j, their bytes, their offsets) in slices of bounded size."""
    data, offsets = utf8(texts)
    for i, j in slices(np.diff(offsets), SLICE_BYTES):
        yield i, j, data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]


def grouped(documents: DataFrame, length: int, spread: int) -> DataFrame:
    """(piece, context, several, doc_id, variant, start, reach): what repeats or may repeat.

    With several, the whole context [start, start + reach + length) repeats.  Without, the piece
    has more than one context, and this is one of them; then several contexts come along with
    ``member`` false, one row each, as partners.
    """
    buckets = 4 * parts(documents.sparkSession)
    out = (
        "piece long, context long, several boolean, member boolean, mixed boolean, doc_id long,"
        " variant long, start long, reach long"
    )
    names = [c.split()[0] for c in out.split(", ")]
    sent = ["bucket", *KINDS, "several"]

    def rows_of(x, several, member, mixed):
        n = len(x["key"])
        columns = [x["key"].astype(np.int64), x["context"].view(np.int64)]
        columns += [np.broadcast_to(v, n) for v in (several, member, mixed)]
        columns += [x[c].astype(np.int64) for c in ("doc", "variant", "start", "reach")]
        return pa.Table.from_arrays([pa.array(c) for c in columns], names=names)

    def runs(*keys):
        """Sizes and numbers of runs of equal keys of sorted arrays."""
        new = np.ones(len(keys[0]), bool)
        new[1:] = np.any([k[1:] != k[:-1] for k in keys], axis=0)
        group = np.cumsum(new) - 1
        return new, group, np.bincount(group)

    def flush(held):
        x = {k: np.concatenate([h[k] for h in held]) for k in (*KINDS, "bucket")}
        order = np.lexsort((x["context"], x["key"], x["bucket"]))
        x = {k: v[order] for k, v in x.items()}
        new, group, size = runs(x["bucket"], x["key"], x["context"])
        several = (size > 1)[group]
        # One of a task's equal contexts goes on, the others are known to repeat.
        batches = []
        edge = np.searchsorted(x["bucket"][new], np.arange(buckets + 1))
        first = {k: x[k][new] for k in KINDS} | {"several": several[new]}
        for b in range(buckets):
            if edge[b] < edge[b + 1]:
                at = slice(edge[b], edge[b + 1])
                batches.append((b, *(first[k][at].tobytes() for k in (*KINDS, "several"))))
        later = {k: x[k][~new] for k in KINDS} | {"several": several[~new]}
        blank = later["key"][:0].tobytes()
        for begin in range(0, len(later["key"]), 1 << 16):
            at = slice(begin, begin + (1 << 16))
            spread_ = int(later["context"][begin] % np.uint64(buckets))
            batches.append((spread_, blank, *(later[k][at].tobytes() for k in sent[2:])))
        columns = list(zip(*batches))
        arrays = [pa.array(columns[0], pa.int32())]
        arrays += [pa.array(c, pa.binary()) for c in columns[1:]]
        return pa.RecordBatch.from_arrays(arrays, names=sent)

    def deal(batches):
        held, count = [], 0
        for batch in batches:
            ids, variant = (batch.column(k).to_numpy() for k in (0, 1))
            for i, j, data, offsets in pieces_of(batch.column(2)):
                piece, context, text, first, last = anchors(data, offsets, length, spread)
                if not len(piece):
                    continue
                piece = mix(piece)
                held.append(
                    {
                        "bucket": ((piece >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24),
                        "key": piece.astype(np.uint32),
                        "context": context,
                        "doc": ids[i:j][text],
                        "variant": variant[i:j][text],
                        "start": (first - offsets[text]).astype(np.uint32),
                        "reach": (last - first).astype(np.uint16),
                    }
                )
                count += len(piece)
                if count >= FLUSH:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)

    def settle(rows: pa.Table) -> pa.Table:
        kinds = KINDS | {"several": "?"}
        blobs = {k: rows.column(k).to_pylist() for k in kinds}
        open_ = [i for i, b in enumerate(blobs["key"]) if len(b)]
        tables = []
        for i, b in enumerate(blobs["key"]):
            if not len(b):
                x = {k: np.frombuffer(blobs[k][i], t) for k, t in kinds.items()}
                x["key"] = np.zeros(len(x["doc"]), np.uint32)
                tables.append(rows_of(x, True, True, False))
        if open_:
            x = {
                k: np.concatenate([np.frombuffer(blobs[k][i], t) for i in open_])
                for k, t in kinds.items()
            }
            order = np.lexsort((x["context"], x["key"]))
            x = {k: v[order] for k, v in x.items()}
            new, group, size = runs(x["key"], x["context"])
            several = (size > 1) | (np.bincount(group, weights=x["several"]) > 0)
            _, key, _ = runs(x["key"])
            mixed = (np.bincount(key, weights=new) > 1)[key]
            several = several[group]
            number = np.uint64(rows.column("bucket")[0].as_py()) << np.uint64(32)
            x["key"] = x["key"].astype(np.uint64) | number
            keep = several
            tables.append(rows_of({k: v[keep] for k, v in x.items()}, True, True, mixed[keep]))
            # Of every distinct context of a mixed piece, one goes on to the suffix array.
            keep = mixed & new
            tables.append(rows_of({k: v[keep] for k, v in x.items()}, several[keep], False, True))
        return pa.concat_tables(tables)

    texts = documents.filter(F.octet_length("text") >= length)
    dealt = texts.select(*_home(), F.col("text").cast("string"))
    schema = ", ".join(["bucket int", *(f"{k} binary" for k in sent[1:])])
    return dealt.mapInArrow(deal, schema).groupBy("bucket").applyInArrow(settle, out)


# Stands for a missing id inside the groups.
NOBODY = -(1 << 63)


def intervals(contexts: list[bytes], before: list[bytes], reach: list[int], length: int):
    """(common length, [(context, offset), ...]) of all maximal repeats of the contexts.

    The suffixes at the first ``reach + 1`` offsets of each context are sorted.  ``before`` is
    the byte in front of a context, or nothing.
    """
    suffixes = sorted(
        (c[p:], i, p) for i, (c, r) in enumerate(zip(contexts, reach)) for p in range(r + 1)
    )

    def common(a: bytes, b: bytes) -> int:
        if a[:length] != b[:length]:
            return 0
        low, high = length, min(len(a), len(b))
        while low < high:
            middle = (low + high + 1) // 2
            if a[length:middle] == b[length:middle]:
                low = middle
            else:
                high = middle - 1
        return low

    def left(i: int, p: int):
        # The begin of a context is an end as good as another byte.
        return contexts[i][p - 1] if p else (i, before[i])

    stack: list[tuple[int, int]] = []  # (common length, first suffix), lengths increase
    for n in range(1, len(suffixes) + 1):
        depth = common(suffixes[n - 1][0], suffixes[n][0]) if n < len(suffixes) else 0
        first = n - 1
        while stack and stack[-1][0] > depth:
            shared, first = stack.pop()
            members = [s[1:] for s in suffixes[first:n]]
            if len({left(i, p) for i, p in members}) > 1:
                yield shared, members
        if depth and (not stack or stack[-1][0] < depth):
            stack.append((depth, first))


def _listed(column: pa.Array, i: int):
    """The structs of row i of a list column, as tuples."""
    return zip(*(c.to_pylist() for c in column[i].values.flatten()), strict=True)


def _batch(rows: list[tuple], names: list[str], kinds: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def repeats(documents: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """(doc_id, variant, start, size, repeat): occurrences of maximal repeats.

    Bytes [start, start + size) of the text are an occurrence of the repeat, a digest that all
    occurrences of it share.  A long repeat comes as overlapping pieces, as the contexts cut it.
    A missing doc_id is NOBODY; variant tells the texts of one id apart.
    """
    scratch = Scratch(documents.sparkSession, "suffixes")
    rows = scratch.keep(grouped(documents, length, spread))
    whole = rows.filter("member").select(
        "doc_id",
        "variant",
        "start",
        (F.col("reach") + length).alias("size"),
        F.col("context").alias("repeat"),
    )
    mixed = rows.filter("mixed and not member")
    sizes = mixed.groupBy("piece").agg(F.count("*").alias("contexts"))
    some = mixed.join(sizes, "piece").drop("mixed", "member")

    fields = ["start", "reach", "piece", "context", "several", "contexts"]
    schema = (
        "doc_id long, variant long, start long, reach long, piece long, context long,"
        " several boolean, contexts long, raw binary"
    )
    names = [c.split()[0] for c in schema.split(", ")]
    kinds = [pa.int64()] * 6 + [pa.bool_(), pa.int64(), pa.binary()]

    def cut(batches):
        """The bytes of each context of a text, and the byte in front."""
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            held, size = [], 0
            for i in range(batch.num_rows):
                doc_id, variant = (batch.column(k)[i].as_py() for k in (1, 2))
                for part in _listed(batch.column(3), i):
                    start, reach = part[0], part[1]
                    begin = int(offsets[i]) + start
                    raw = data[begin - (start > 0) : begin + reach + length].tobytes()
                    held.append((doc_id, variant, *part, raw))
                    size += len(raw)
                    if size >= CUT_BYTES:
                        yield _batch(held, names, kinds)
                        held, size = [], 0
            yield _batch(held, names, kinds)

    # A text meets the list of its contexts once, however many they are.
    lists = some.groupBy("doc_id", "variant").agg(F.collect_list(F.struct(*fields)).alias("cuts"))
    texts = documents.select(*_home(), "text")
    joined = texts.join(lists, ["doc_id", "variant"]).select("text", "doc_id", "variant", "cuts")
    # Repeated rows give the same bytes for one context; one of them is enough.
    contexts = joined.mapInArrow(cut, schema).dropDuplicates(["piece", "context"])
    contexts = scratch.keep(contexts)

    def array(table: pa.Table) -> pa.Table:
        x = table.sort_by([("piece", "ascending"), ("context", "ascending")]).to_pydict()
        edge = [i for i, p in enumerate(x["piece"]) if not i or p != x["piece"][i - 1]]
        out = []
        for begin, end in zip(edge, [*edge[1:], len(x["piece"])]):
            raws, reach = x["raw"][begin:end], x["reach"][begin:end]
            shift = [int(s > 0) for s in x["start"][begin:end]]
            bodies = [r[s:] for r, s in zip(raws, shift)]
            front = [r[:s] for r, s in zip(raws, shift)]
            # Children come before their parents: a place is listed for its longest repeat.
            listed = set()
            for size, members in intervals(bodies, front, reach, length):
                i, p = members[0]
                digest = hashlib.blake2b(bodies[i][p : p + size], digest_size=8).digest()
                repeat = int.from_bytes(digest, "big", signed=True)
                for i, p in members:
                    if (i, p) not in listed and not x["several"][begin + i]:
                        listed.add((i, p))
                        k = begin + i
                        out.append((x["doc_id"][k], x["variant"][k], x["start"][k] + p, size, repeat))
        columns = list(zip(*out)) or [[]] * 5
        names = ["doc_id", "variant", "start", "size", "repeat"]
        return pa.Table.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    found = "doc_id long, variant long, start long, size long, repeat long"
    cells = 1 + contexts.count() // CELL
    cell = F.pmod(F.xxhash64("piece"), F.lit(cells)).alias("cell")
    normal = contexts.filter(F.col("contexts") <= CONTEXTS).withColumn("cell", cell)
    partial = normal.groupBy("cell").applyInArrow(array, found)

    def strings(batches):
        """Each string of a context, by hash."""
        for batch in batches:
            x = batch.to_pydict()
            for k, raw in enumerate(x["raw"]):
                raw = np.frombuffer(raw, np.uint8)[int(x["start"][k] > 0) :]
                at = np.arange(x["reach"][k] + 1)
                hashes = _ROLLING.ranges(_ROLLING.sums(raw), at, at + length).view(np.int64)
                same = [np.full(len(at), x[c][k]) for c in ("doc_id", "variant")]
                columns = [*same, x["start"][k] + at, hashes, np.full(len(at), x["several"][k])]
                names = ["doc_id", "variant", "start", "repeat", "several"]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    hot = contexts.filter(F.col("contexts") > CONTEXTS)
    single = hot.mapInArrow(
        strings, "doc_id long, variant long, start long, repeat long, several boolean"
    )
    single = scratch.keep(single)
    again = single.groupBy("repeat").agg(F.count("*").alias("n"), F.max("several").alias("several"))
    again = again.filter("n > 1 or several").select("repeat")
    cold = single.filter("not several").join(again, "repeat").select(
        "doc_id", "variant", "start", F.lit(length).cast("long").alias("size"), "repeat"
    )
    return whole.union(partial).union(cold)


def removed(documents: DataFrame, length: int = LENGTH, spread: int = SPREAD) -> DataFrame:
    """``documents`` with n_bytes, n_removed, n_spans, kept (the remaining bytes).

    Every byte is removed that a string of ``length`` bytes covers which starts anywhere else,
    in the same text or in another row's; all strings are judged on the whole texts.  Null texts
    are empty; texts shorter than ``length`` stay whole, and so do all others in an empty or
    single-row table unless they repeat inside.  Rows that repeat are places of their own, and so
    are rows without doc_id.  Other columns stay; those of the names above are replaced.
    """
    names = ["n_bytes", "n_removed", "n_spans", "kept"]
    plain = documents.drop(*names)
    key, twin, lists = (unused(n, plain) for n in ("_key", "_variant", "_spans"))
    found = repeats(plain, length, spread).groupBy("doc_id", "variant")
    spans = found.agg(F.collect_list(F.struct("start", "size")).alias(lists)).toDF(key, twin, lists)
    home, variant = _home()
    joined = plain.withColumns({key: home, twin: variant}).join(spans, [key, twin], "left").select(*plain.columns, lists)
    before = plain.columns
    at = before.index("text")

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(at))
            out = []
            lists = batch.column(batch.num_columns - 1)
            for i in range(batch.num_rows):
                raw = data[offsets[i] : offsets[i + 1]]
                if not lists[i].is_valid:
                    out.append((len(raw), 0, 0, raw.tobytes()))
                    continue
                start, size = (c.to_numpy() for c in lists[i].values.flatten())
                cover = np.zeros(len(raw) + 1, np.int64)
                np.add.at(cover, start, 1)
                np.add.at(cover, start + size, -1)
                gone = np.cumsum(cover[:-1]) > 0
                runs = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(gone.sum()), runs, raw[~gone].tobytes()))
            kinds = pa.int64(), pa.int64(), pa.int64(), pa.binary()
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            if out:
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], *columns], names=[*before, *names]
                )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    schema = f"{fields}, n_bytes long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(run, schema)
