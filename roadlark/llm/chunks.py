"""Substring deduplication by content-defined chunks.

A gear hash rolls over the bytes of each text and cuts where its upper bits are zero, so cuts
depend on the few bytes before them and move along with the text when something is inserted in
front.  Chunks are compared by digest over all documents.  Single chunks repeat by chance, so
only runs of consecutive repeated chunks of some length count as repeated text; in such runs all
chunks go but the first occurrence of each.  ``removed`` compares the bytes around what goes with
those around its first occurrence, so a passage is cut where it ends and not at the next chunk.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlark.llm.common import RollingSums, Scratch, constants, mix, parts, slices, unused, utf8

# The gear has 16 bits, so a cut depends on 16 bytes; 4 bits decide, and a cut keeps its distance
# from others before it.  Chunks have about 27 bytes.
WINDOW = 16
DECIDES = np.uint16(0xF000)
APART = 8
LONGEST = 256
MIN_RUN = 100
# Bytes beside a run that are compared first; runs that go on get eight times as many.
BESIDE = 128

SLICE_BYTES = 4 << 20
FLUSH = 1_000_000

_GEAR = (constants(256, seed=3) >> np.uint64(20)).astype(np.uint16)
_ROLLING = RollingSums(seed=17)


def cut(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(start, end) of the chunks of all texts in ``data``; no chunk crosses texts."""
    gear, span = _GEAR[data], 1
    while span < WINDOW:  # the sum of the last 2 * span bytes from that of the last span
        gear[span:] += gear[:-span] << np.uint16(span)
        span *= 2
    hit = np.flatnonzero((gear & DECIDES) == 0)
    # Bytes of another text must not decide.
    home = offsets[np.searchsorted(offsets, hit, "right") - 1]
    hit = hit[hit - home >= WINDOW - 1]
    apart = np.ones(len(hit), bool)
    apart[1:] = np.diff(hit) > APART
    ends = np.unique(np.concatenate((hit[apart] + 1, offsets)))
    start, end = ends[:-1], ends[1:]
    pieces = -(-(end - start) // LONGEST)
    if (pieces > 1).any():
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        number = np.arange(len(first)) - first
        start = np.repeat(start, pieces) + number * LONGEST
        end = np.minimum(start + LONGEST, np.repeat(end, pieces))
    return start, end


def repeated_chunks(documents: DataFrame) -> DataFrame:
    """(doc_id, variant, start, size, first, home, home_variant, home_start): repeated chunks.

    first marks one occurrence of each chunk: the least (doc_id, variant, start).  variant tells
    texts of one doc_id apart.  Chunks that repeat inside a task are settled there; one
    occurrence of each digest and task goes on, so a chunk of a third of all texts loads nobody.
    home is the place of the first occurrence, or of the task's first one, which has its own home.
    """
    buckets = 4 * parts(documents.sparkSession)
    out = (
        "doc_id long, variant long, start long, size long, first boolean,"
        " home long, home_variant long, home_start long"
    )
    kinds = {"token": "u8", "doc": "i8", "variant": "i8", "start": "i8", "size": "u2", "more": "?"}
    homes = {"home": "doc", "home_variant": "variant", "home_start": "start"}
    sent = ", ".join(["bucket int", *(f"{k} binary" for k in (*kinds, *homes))])

    def ordered(x):
        """Sort by token and occurrence; drop what repeated rows give twice."""
        order = np.lexsort((x["start"], x["variant"], x["doc"], x["token"]))
        x = {k: v[order] for k, v in x.items()}
        same = np.ones(len(order), bool)
        same[:1] = False
        for k in ("token", "doc", "variant", "start"):
            same[1:] &= x[k][1:] == x[k][:-1]
        if same.any():  # keep the knowledge of any of them
            group = np.cumsum(~same) - 1
            more = np.bincount(group, weights=x["more"]) > 0
            x = {k: v[~same] for k, v in x.items()} | {"more": more}
        new = np.ones(len(x["token"]), bool)
        new[1:] = x["token"][1:] != x["token"][:-1]
        return x, new

    def with_homes(x, new):
        """With the place of the first occurrence of each token."""
        at = np.flatnonzero(new)[np.cumsum(new) - 1]
        return x | {h: x[k][at] for h, k in homes.items()}

    def found(x, at, first):
        return pa.RecordBatch.from_arrays(
            [
                pa.array(x["doc"][at]),
                pa.array(x["variant"][at]),
                pa.array(x["start"][at]),
                pa.array(x["size"][at].astype(np.int64)),
                pa.array(first),
                *(pa.array(x[h][at]) for h in homes),
            ],
            names=["doc_id", "variant", "start", "size", "first", *homes],
        )

    def flush(held):
        x, new = ordered({k: np.concatenate([h[k] for h in held]) for k in kinds})
        size = np.diff(np.append(np.flatnonzero(new), len(new)))
        x["more"] = np.repeat(size > 1, size)
        # Later occurrences go straight to the result, in a row of their own.
        rest = ~new
        x = with_homes(x, new)
        token = x["token"][new]
        bucket = ((token >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
        edge = np.searchsorted(bucket, np.arange(buckets + 1))
        rows = []
        for b in range(buckets):
            if edge[b] < edge[b + 1]:
                at = slice(edge[b], edge[b + 1])
                rows.append((b, *(x[k][new][at].tobytes() for k in kinds), *[b""] * len(homes)))
        later = {k: x[k][rest] for k in (*kinds, *homes)}
        for begin in range(0, len(later["token"]), 1 << 16):
            at = slice(begin, begin + (1 << 16))
            # Settled: no token is sent.
            blank = later["token"][:0].tobytes()
            spread = int(later["token"][begin] % np.uint64(buckets))
            rows.append((spread, blank, *(v[at].tobytes() for v in list(later.values())[1:])))
        columns = list(zip(*rows))
        arrays = [pa.array(columns[0], pa.int32())] + [pa.array(c, pa.binary()) for c in columns[1:]]
        return pa.RecordBatch.from_arrays(arrays, names=["bucket", *kinds, *homes])

    def deal(batches):
        held, count = [], 0
        for batch in batches:
            ids = np.array(batch.column(0).to_pylist(), np.int64)
            data, offsets = utf8(batch.column(1))
            for i, j in slices(np.diff(offsets), SLICE_BYTES):
                bounds = offsets[i : j + 1]
                part, bounds = data[bounds[0] : bounds[-1]], bounds - bounds[0]
                if not len(part):
                    continue
                start, end = cut(part, bounds)
                sums = _ROLLING.sums(part)
                text = np.searchsorted(bounds, start, "right") - 1
                variant = _ROLLING.ranges(sums, bounds[:-1], bounds[1:]).view(np.int64)
                held.append(
                    {
                        "token": mix(_ROLLING.ranges(sums, start, end)),
                        "doc": ids[i:j][text],
                        "variant": variant[text],
                        "start": start - bounds[text],
                        "size": (end - start).astype(np.uint16),
                        "more": np.zeros(len(start), bool),
                    }
                )
                count += len(start)
                if count >= FLUSH:
                    yield flush(held)
                    held, count = [], 0
        if held:
            yield flush(held)

    def settle(rows: pa.Table) -> pa.Table:
        types = kinds | dict.fromkeys(homes, "i8")
        columns = {k: [np.frombuffer(b, t) for b in rows.column(k).to_pylist()] for k, t in types.items()}
        open_ = [i for i, t in enumerate(columns["token"]) if len(t)]
        done = [i for i, t in enumerate(columns["token"]) if not len(t)]
        batches = []
        if open_:
            x, new = ordered({k: np.concatenate([columns[k][i] for i in open_]) for k in kinds})
            x = with_homes(x, new)
            group = np.cumsum(new) - 1
            many = (np.bincount(group) > 1) | (np.bincount(group, weights=x["more"]) > 0)
            at = many[group]
            batches.append(found(x, at, new[at]))
        for i in done:
            x = {k: c[i] for k, c in columns.items()}
            every = np.ones(len(x["doc"]), bool)
            batches.append(found(x, every, ~every))
        return pa.Table.from_batches(batches)

    texts = documents.filter("doc_id is not null and text <> ''")
    dealt = texts.select(F.col("doc_id").cast("long"), F.col("text")).mapInArrow(deal, sent)
    return dealt.groupBy("bucket").applyInArrow(settle, out)


def repeated_runs(documents: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, variant, start, size, removed): maximal runs of repeated chunks.

    removed is the number of bytes of the run's chunks that are not their first occurrence.
    """
    # A row that is there twice may give its chunks twice.  All steps here share one shuffle.
    chunks = repeated_chunks(documents).repartition("doc_id", "variant")
    chunks = chunks.dropDuplicates(["doc_id", "variant", "start"])
    inside = Window.partitionBy("doc_id", "variant").orderBy("start")
    before = F.lag(F.col("start") + F.col("size")).over(inside)
    starts = F.coalesce(before != F.col("start"), F.lit(True))
    numbered = chunks.withColumn("begins", starts.cast("int"))
    numbered = numbered.withColumn("run", F.sum("begins").over(inside))
    runs = numbered.groupBy("doc_id", "variant", "run").agg(
        F.min("start").alias("start"),
        F.sum("size").alias("size"),
        F.sum(F.when(F.col("first"), 0).otherwise(F.col("size"))).alias("removed"),
    )
    return runs.filter(F.col("size") >= min_run).drop("run")


def summary(documents: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, n_spans, n_repeated, n_removed): the documents that hold repeated text.

    n_repeated counts the bytes of runs of at least ``min_run`` bytes, n_removed those that are
    not first occurrences.  Null and empty texts and rows without doc_id take no part; texts
    shorter than a run never appear.  Rows that repeat id and text count as one document; other
    texts of one id are documents of their own, and their figures are added up.  An empty table
    gives an empty result; other columns are not read.
    """
    return repeated_runs(documents, min_run).groupBy("doc_id").agg(
        F.count("*").alias("n_spans"),
        F.sum("size").alias("n_repeated"),
        F.sum("removed").alias("n_removed"),
    )


def beside(documents: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """``places`` (doc_id, variant, start, size) with token, front, back.

    token is the hash of these bytes; front and back are the ``width`` bytes before (backwards)
    and behind them.
    """
    lists = places.groupBy(F.col("doc_id").alias("key")).agg(
        F.collect_set(F.struct("variant", "start", "size")).alias("places")
    )
    texts = documents.select(F.col("doc_id").cast("long").alias("key"), F.col("text").cast("string"))
    names = ["doc_id", "variant", "start", "size", "token", "front", "back"]

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i in range(batch.num_rows):
                raw = data[offsets[i] : offsets[i + 1]]
                sums = _ROLLING.sums(raw)
                whole = _ROLLING.ranges(sums, np.array([0]), np.array([len(raw)])).view(np.int64)
                variant, start, size = (c.to_numpy() for c in batch.column(2)[i].values.flatten())
                end = start + size
                mine = variant == whole[0]
                start, size = start[mine], size[mine]
                if not len(start):
                    continue
                # What a place lacks in this text makes its token another one.
                low, high = np.maximum(start, 0), np.minimum(end[mine], len(raw))
                front = [raw[max(a - width, 0) : a][::-1].tobytes() for a in low.tolist()]
                back = [raw[b : b + width].tobytes() for b in high.tolist()]
                token = _ROLLING.ranges(sums, low, high).view(np.int64)
                same = [np.full(len(start), v) for v in (batch.column(0)[i].as_py(), whole[0])]
                columns = [*same, start, size, token, front, back]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=names)

    schema = (
        "doc_id long, variant long, start long, size long, token long, front binary, back binary"
    )
    found = texts.join(lists, "key").select("key", "text", "places").mapInArrow(run, schema)
    return found.dropDuplicates(names[:4])  # of repeated rows


def common(a: bytes, b: bytes) -> int:
    """How many bytes two strings have in common at their begin."""
    low, high = 0, min(len(a), len(b))
    while low < high:
        middle = (low + high + 1) // 2
        if a[low:middle] == b[low:middle]:
            low = middle
        else:
            high = middle - 1
    return low


def extended(documents: DataFrame, pairs: DataFrame, width: int) -> DataFrame:
    """``pairs`` with same, front, back, open: how far they agree in front and behind.

    A pair is the place (doc_id, variant, start, size) and the place of as many bytes from
    home_start on in the text (home, home_variant); the chunk [at, at + length) of the first is
    known to be equal.  With same, all of both is.  Otherwise a side is compared only if the
    chunk is at that end.  With open, bytes beyond ``width`` may agree as well.
    """
    keys = ["doc_id", "variant", "start", "size"]
    homes = ["home", "home_variant", "home_start"]
    away = pairs.select(*(F.col(h).alias(k) for h, k in zip(homes, keys)), "size")
    raws = beside(documents, pairs.select(keys).unionByName(away), width)
    own = raws.select(*keys, *(F.col(c).alias(f"own_{c}") for c in ("token", "front", "back")))
    other = raws.select(
        *(F.col(k).alias(h) for h, k in zip([*homes, "size"], keys)),
        *(F.col(c).alias(f"other_{c}") for c in ("token", "front", "back")),
    )
    joined = pairs.join(own, keys).join(other, [*homes, "size"], "left")
    joined = joined.select(*pairs.columns, *own.columns[4:], *other.columns[4:])
    count = len(pairs.columns)
    names = [*pairs.columns, "same", "front", "back", "open"]

    def run(batches):
        for batch in batches:
            x = {n: batch.column(n).to_pylist() for n in ("start", "size", "at", "length")}
            sides = [batch.column(count + i).to_pylist() for i in range(6)]
            out = []
            for start, size, at, length, token, f, b, token2, f2, b2 in zip(*x.values(), *sides):
                same = token == token2
                front = common(f, f2) if f2 is not None and (same or at == start) else 0
                back = common(b, b2) if b2 is not None and (same or at + length == start + size) else 0
                out.append((same, front, back, width in (front, back)))
            columns = [pa.array(c, t) for c, t in zip(zip(*out), (pa.bool_(), *[pa.int64()] * 2, pa.bool_()))]
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[:count], *columns], names=names)

    fields = [f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema]
    schema = ", ".join([*fields, "same boolean", "front long", "back long", "open boolean"])
    return joined.mapInArrow(run, schema)


def repeated_spans(documents: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """(doc_id, variant, start, size, later): bytes that repeat, and with later, those to remove.

    Consecutive chunks that are no first occurrences are a part.  A part grows on both sides as
    long as the bytes there equal those beside the first occurrence of its first or last chunk.
    It counts if it has ``min_run`` bytes then, or its run of repeated chunks has.  Spans may
    overlap.  Each removed byte has an equal one at an earlier (doc_id, variant, start), so of all
    occurrences the first one stays.
    """
    scratch = Scratch(documents.sparkSession, "chunks")
    place = ["doc_id", "variant", "start"]
    homes = ["home", "home_variant", "home_start"]
    # A row that is there twice may give its chunks twice, with the homes of several tasks.
    chunks = repeated_chunks(documents).repartition("doc_id", "variant").groupBy(place).agg(
        F.first("size").alias("size"),
        F.min("first").alias("first"),
        F.min(F.struct(*homes)).alias("h"),
    )
    chunks = scratch.keep(chunks.select(*place, "size", "first", "h.*"))
    inside = Window.partitionBy("doc_id", "variant").orderBy("start")
    joins = F.coalesce(F.lag(F.col("start") + F.col("size")).over(inside) == F.col("start"), F.lit(False))
    alike = joins & (F.lag("first").over(inside) == F.col("first"))
    numbered = chunks.repartition("doc_id", "variant").withColumns(
        {"run_begins": (~joins).cast("int"), "part_begins": (~alike).cast("int")}
    )
    numbered = numbered.withColumns(
        {"run": F.sum("run_begins").over(inside), "part": F.sum("part_begins").over(inside)}
    )
    chunk = F.struct("start", "size", *homes)
    split = numbered.groupBy("doc_id", "variant", "run", "part", "first").agg(
        F.min("start").alias("start"),
        F.sum("size").alias("size"),
        F.min(chunk).alias("left"),
        F.max(chunk).alias("right"),
    )
    whole = Window.partitionBy("doc_id", "variant", "run")
    split = split.withColumns(
        {"run_start": F.min("start").over(whole), "run_size": F.sum("size").over(whole)}
    )
    split = scratch.keep(split)
    runs = split.filter(F.col("run_size") >= min_run).select(
        "doc_id", "variant", F.col("run_start").alias("start"), F.col("run_size").alias("size"),
        F.lit(False).alias("later"),
    )
    ends = F.explode(F.array_distinct(F.array("left", "right"))).alias("c")
    pairs = split.filter("not first").select(*place, "size", "run_size", ends)
    pairs = pairs.select(
        *place, "size", "run_size", F.col("c.start").alias("at"), F.col("c.size").alias("length"),
        *(F.col(f"c.{h}").alias(h) for h in homes),
    )
    # The first occurrence in a task has a home of its own.
    next_ = chunks.filter("not first").select(
        *(F.col(k).alias(h) for h, k in zip(homes, place)), *(F.col(h).alias(f"next_{h}") for h in homes)
    )
    pairs = pairs.join(next_, homes, "left").select(
        *place, "size", "run_size", "at", "length",
        *(F.coalesce(f"next_{h}", h).alias(h) for h in homes),
    )
    pairs = pairs.withColumn("home_start", F.col("home_start") - F.col("at") + F.col("start"))
    pairs, width, grown = scratch.keep(pairs), BESIDE, None
    while True:
        step = scratch.keep(extended(documents, pairs, width))
        done = step.filter("not open").drop("open")
        grown = done if grown is None else grown.unionByName(done)
        pairs = step.filter("open").drop("same", "front", "back", "open")
        if pairs.isEmpty():
            break
        width *= 8
    ready = grown.groupBy(*place, "size", "run_size").agg(
        F.max("front").alias("front"), F.max("back").alias("back")
    )
    longer = F.col("size") + F.col("front") + F.col("back")
    later = ready.filter((longer >= min_run) | (F.col("run_size") >= min_run)).select(
        "doc_id", "variant", (F.col("start") - F.col("front")).alias("start"), longer.alias("size"),
        F.lit(True).alias("later"),
    )
    first = grown.filter(F.col("same") & (longer >= min_run)).select(
        F.col("home").alias("doc_id"), F.col("home_variant").alias("variant"),
        (F.col("home_start") - F.col("front")).alias("start"), longer.alias("size"),
        F.lit(False).alias("later"),
    )
    return runs.unionByName(first).distinct().unionByName(later)


def removed(documents: DataFrame, min_run: int = MIN_RUN) -> DataFrame:
    """``documents`` with n_bytes, n_repeated, n_removed, n_spans, kept (the remaining bytes).

    One row per row of ``documents``.  n_repeated counts the bytes of ``repeated_spans``,
    n_removed those to remove, in n_spans separate ranges.  Null texts are empty; rows without
    doc_id take no part and stay whole.  Rows that repeat id and text count as one document, and
    all of them get its result.  Other columns stay; those of the names above are replaced.
    """
    names = ["n_bytes", "n_repeated", "n_removed", "n_spans", "kept"]
    plain = documents.drop(*names)
    key, lists = unused("_key", plain), unused("_spans", plain)
    spans = repeated_spans(plain, min_run).groupBy(F.col("doc_id").alias(key)).agg(
        F.collect_list(F.struct("variant", "start", "size", "later")).alias(lists)
    )
    home = F.col("doc_id").cast("long")
    joined = plain.withColumn(key, home).join(spans, key, "left").select(*plain.columns, lists)
    before = plain.columns
    text = before.index("text")

    def covered(count, start, size):
        steps = np.zeros(count + 1, np.int64)
        np.add.at(steps, start, 1)
        np.add.at(steps, start + size, -1)
        return np.cumsum(steps[:-1]) > 0

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(text))
            lists, out = batch.column(batch.num_columns - 1), []
            for i in range(batch.num_rows):
                raw = data[offsets[i] : offsets[i + 1]]
                if not lists[i].is_valid:
                    out.append((len(raw), 0, 0, 0, raw.tobytes()))
                    continue
                sums = _ROLLING.sums(raw)
                own = _ROLLING.ranges(sums, np.array([0]), np.array([len(raw)])).view(np.int64)
                fields = lists[i].values.flatten()
                variant, start, size, later = (c.to_numpy(zero_copy_only=False) for c in fields)
                mine = variant == own[0]
                every = covered(len(raw), start[mine], size[mine])
                mine &= later
                gone = covered(len(raw), start[mine], size[mine])
                ranges = int(gone[:1].sum()) + int((gone[1:] & ~gone[:-1]).sum())
                out.append((len(raw), int(every.sum()), int(gone.sum()), ranges, raw[~gone].tobytes()))
            kinds = *[pa.int64()] * 4, pa.binary()
            columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
            if out:
                yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *columns], names=[*before, *names])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema)
    schema = f"{fields}, n_bytes long, n_repeated long, n_removed long, n_spans long, kept binary"
    return joined.mapInArrow(run, schema)
