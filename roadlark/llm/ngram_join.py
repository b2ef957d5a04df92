"""N-gram Jaccard join with token-combination prefixes.

Two documents link when the Jaccard similarity of their sets of five-word shingles reaches a
threshold.  The join is exact:

1. Documents of one set collapse to the least id; only distinct sets are joined.
2. Screening.  In hash order, the first e + 1 + s tokens of a set (e: how many tokens a partner
   may lack) share at least s + 1 tokens with any partner.  These tokens are counted in hash
   buckets; sets with fewer shared tokens can have no partner and leave.  Their tokens, and the
   owners of tokens, are cut to 39 bits or more and to 48 bits for that.
3. Signatures.  The remaining sets order their tokens by frequency, rare ones first.  How many
   tokens a partner may lack sets the length of a set's prefix: a short one to be found by sets
   of its size or more, a longer one to find smaller sets.  Rare tokens are indexed alone.
   Frequent ones are dealt to classes, and combinations of two tokens of a class are indexed; a
   class adds one token less to the prefix than it has, so the prefix is extended until it has
   its credit.  A pair above the threshold shares a signature.
4. Verification.  Each signature's most common set is compared with the others first; sets that
   are connected by then need no comparison, so a large group of near copies costs few
   comparisons per member and not one per pair.  What is left in a signature is compared in
   rounds of more and more of its sets until every pair of it is either compared or connected.

Tokens are 64-bit hashes of the shingles.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from roadlark.llm.common import Scratch, constants, mix, parts, tidy, unused, utf8
from roadlark.llm.components import components
from roadlark.llm.shingles import batches_of_sets, digest

WIDTH = 5
PERCENT = 75
# Screening sends a token list on when it has this many tokens.
FLUSH = 2_000_000
# Tokens of more sets than this are frequent: they are indexed two by two.
OFTEN = 64
# Frequent tokens are dealt to a class per so many tokens of a set.
SMALL = 8
# Bits of the filter that keeps most texts from being cut into sets again, and its slices.
FILTER_BITS = 1 << 24
FILTER_SLICES = 16
# Min-hashes per set for the first comparisons, and tokens per block of sets.
SKETCHES = 4
BLOCK = 1_000_000
# Sets of a signature that one round compares with all others of it, at most; rows of one key
# that are compared together, and rows of many keys that one call handles.
WIDEST = 1024
GROUP = 2000
CELL = 20_000
DEALT = ["bucket", "block", "tokens", "counts"]
KINDS = [pa.int32(), pa.int32(), pa.binary(), pa.binary()]
# Bytes of a digest that name the owner of a token.
OWNER = 6


def missing(n, percent: int):
    """How many of its n tokens a set may lack in a partner."""
    return n * (100 - percent) // 100


def screen_length(n, percent: int):
    return np.minimum(n, missing(n, percent) + 1 + n // 16)


def document_sets(documents: DataFrame, width: int) -> DataFrame:
    """(doc_id, n, sid): size and digest of each row's set; no digest if the set is empty."""

    def run(batches):
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            sets = [s for _, s in batches_of_sets(data, offsets, width)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([digest(s) if len(s) else None for s in sets], pa.binary()),
                ],
                names=["doc_id", "n", "sid"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n long, sid binary"
    )


def shared_counts(documents: DataFrame, width: int, percent: int) -> DataFrame:
    """(owner, shared): how many of a set's screening tokens other sets have among theirs.

    owner is the begin of the set's digest.  Tokens that two sets of one task share are settled
    there and sent on once, without owners, so a token that is in a third of all sets loads no
    bucket.  Other tokens go with their owner: ten bytes, however many buckets there are.
    """
    buckets = 4 * parts(documents.sparkSession)
    schema = "bucket int, tokens binary, low binary, high binary, credits binary"
    nobody = np.uint32(0xFFFFFFFF)

    def flush(sids, lists):
        sids, keep = np.unique(np.array(sids, np.uint64), return_index=True)
        lists = [lists[i] for i in keep]
        owner = np.repeat(np.arange(len(lists), dtype=np.uint32), [len(x) for x in lists])
        token = mix(np.concatenate(lists) + np.uint64(97))
        order = np.argsort(token)
        token, owner = token[order], owner[order]
        new = np.concatenate(([True], token[1:] != token[:-1]))
        size = np.diff(np.concatenate((np.flatnonzero(new), [len(token)])))
        alone = np.repeat(size, size) == 1
        credit = np.bincount(owner[~alone], minlength=len(sids)).astype(np.uint32)
        token, owner = token[new], np.where(alone, owner, nobody)[new]
        # Buckets are ranges of the mixed token, so each is one slice.
        bucket = ((token >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
        cut = np.searchsorted(bucket, np.arange(buckets + 1))
        short = token.astype(np.uint32)
        low, high = sids.astype(np.uint32), (sids >> np.uint64(32)).astype(np.uint16)
        for b in range(buckets):
            at = slice(cut[b], cut[b + 1])
            known = owner[at] != nobody
            # Owners stand beside the first tokens; the others are settled.
            tokens, mine = np.append(short[at][known], short[at][~known]), owner[at][known]
            yield b, tokens, low[mine], high[mine], credit[:0]
        has = credit > 0
        if has.any():
            spread = int(sids[0] % np.uint64(buckets))
            yield spread, short[:0], low[has], high[has], credit[has]

    def table(rows):
        columns = list(zip(*rows))
        arrays = [pa.array(columns[0], pa.int32())]
        arrays += [pa.array([x.tobytes() for x in c], pa.binary()) for c in columns[1:]]
        names = ["bucket", "tokens", "low", "high", "credits"]
        return pa.RecordBatch.from_arrays(arrays, names=names)

    def deal(batches):
        sids, lists, held = [], [], 0
        for batch in batches:
            data, offsets = utf8(batch.column(0))
            for _, s in batches_of_sets(data, offsets, width):
                if len(s):
                    sids.append(int.from_bytes(digest(s)[:OWNER], "big"))
                    lists.append(s[: screen_length(len(s), percent)].copy())
                    held += len(lists[-1])
                    if held >= FLUSH:
                        yield table(flush(sids, lists))
                        sids, lists, held = [], [], 0
        if lists:
            yield table(flush(sids, lists))

    def count(rows: pa.Table) -> pa.Table:
        tokens, low, high, credits = (
            [np.frombuffer(x, t) for x in rows.column(c).to_pylist()]
            for c, t in (("tokens", "u4"), ("low", "u4"), ("high", "u2"), ("credits", "u4"))
        )
        owners = [x | y.astype(np.uint64) << np.uint64(32) for x, y in zip(low, high)]
        given = [(o, c) for o, c in zip(owners, credits) if len(c)]
        lists = [(t, o) for t, o in zip(tokens, owners) if len(t)]
        who = [np.empty(0, np.uint64)] + [o for o, _ in given]
        how = [np.empty(0, np.int64)] + [c.astype(np.int64) for _, c in given]
        if lists:
            token = np.concatenate([t for t, _ in lists])
            known = np.concatenate([np.arange(len(t)) < len(o) for t, o in lists])
            # Any number stands for the owner of a token that is settled.
            sid = np.concatenate([np.pad(o, (0, len(t) - len(o))) for t, o in lists])
            order = np.lexsort((sid, token))
            token, known, sid = token[order], known[order], sid[order]
            new = np.concatenate(([True], token[1:] != token[:-1]))
            other = np.concatenate(([True], sid[1:] != sid[:-1])) | new
            group = np.cumsum(new) - 1
            owners_of = np.bincount(group[other & known])
            owners_of = np.pad(owners_of, (0, group[-1] + 1 - len(owners_of)))
            settled = np.bincount(group, weights=~known) > 0
            good = other & known & ((owners_of >= 2) | settled)[group]
            s, c = np.unique(sid[good], return_counts=True)
            who.append(s)
            how.append(c)
        who, code = np.unique(np.concatenate(who), return_inverse=True)
        total = np.bincount(code, weights=np.concatenate(how), minlength=len(who))
        return pa.table({"owner": who.view(np.int64), "shared": total.astype(np.int64)})

    dealt = documents.select("text").mapInArrow(tidy(deal), schema)
    counted = dealt.groupBy("bucket").applyInArrow(count, "owner long, shared long")
    return counted.groupBy("owner").agg(F.sum("shared").alias("shared"))


def id_filter(ids: DataFrame) -> np.ndarray:
    """A Bloom filter of fixed size over ``id``, as bytes of bits; see ``may_hold``."""

    def run(batches):
        found = np.zeros(FILTER_BITS, bool)
        for batch in batches:
            for at in filter_places(batch.column(0).to_numpy()):
                found[at] = True
        cut = np.packbits(found).reshape(FILTER_SLICES, -1)
        columns = [pa.array(range(FILTER_SLICES), pa.int32()), pa.array([x.tobytes() for x in cut])]
        yield pa.RecordBatch.from_arrays(columns, names=["i", "bits"])

    def merge(rows: pa.Table) -> pa.Table:
        parts_ = [np.frombuffer(x, np.uint8) for x in rows.column("bits").to_pylist()]
        total = np.bitwise_or.reduce(parts_).tobytes()
        return pa.table({"i": rows.column("i")[:1], "bits": pa.array([total])})

    schema = "i int, bits binary"
    rows = ids.select("id").mapInArrow(run, schema).groupBy("i").applyInArrow(merge, schema)
    out = np.zeros((FILTER_SLICES, FILTER_BITS // 8 // FILTER_SLICES), np.uint8)
    for r in rows.collect():  # FILTER_BITS bits at any size
        out[r.i] = np.frombuffer(r.bits, np.uint8)
    return out.reshape(-1)


def filter_places(ids: np.ndarray):
    for salt in constants(3, seed=83):
        place = mix(ids.view(np.uint64) + salt) >> np.uint64(65 - FILTER_BITS.bit_length())
        yield place.astype(np.int64)


def may_hold(bits: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """Which ids pass the filter: all that it was made of, and some others."""
    out = np.ones(len(ids), bool)
    for at in filter_places(ids):
        out &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)
    return out


def owner_of(sid):
    """The begin of a digest as ``shared_counts`` has it."""
    return F.conv(F.hex(F.substring(sid, 1, OWNER)), 16, 10).cast("long")


def needed(n: int, m: int, percent: int) -> int:
    """The least overlap of two similar sets of n and m tokens."""
    return -(-percent * (n + m) // (100 + percent))


def asked(block: pa.Table) -> pa.Table:
    """The sets of a block that rows without tokens ask for, each once if repeated rows gave it
    more than once; all rows of an id are in one block."""
    keys = list(zip(block.column("id").to_pylist(), block.column("sid").to_pylist()))
    whole = block.column("tokens").is_valid().to_pylist()
    wanted = {k for k, w in zip(keys, whole) if not w}
    last = {k: i for i, (k, w) in enumerate(zip(keys, whole)) if w and k in wanted}
    return block.take(pa.array(list(last.values()), pa.int64()))


def places(tokens: np.ndarray, buckets: int) -> np.ndarray:
    """The bucket of each token, and its lower half.

    Tokens of one place are counted as one: then a token may count as that of more sets than hold
    it, never of fewer, and its count is the same for all sets.
    """
    bucket = ((tokens >> np.uint64(40)) * np.uint64(buckets)) >> np.uint64(24)
    return bucket << np.uint64(32) | tokens.astype(np.uint32)


def places_of(block: pa.Table, buckets: int):
    """(places, counts) of all tokens of the block's sets, in order of the places."""
    lists = [np.frombuffer(x, "u8") for x in block.column("tokens").to_pylist()]
    every = np.concatenate(lists or [np.empty(0, np.uint64)])
    return np.unique(places(every, buckets), return_counts=True)


def counted(sets: DataFrame, buckets: int) -> DataFrame:
    """(block, bucket, counts): of how many sets each place is, for the places of a block in order.

    A block of sets sends each of its places once, with its count, and gets the totals back in
    the order that it sent them: a token costs a block one entry, however many sets hold it.
    """

    def deal(block: pa.Table) -> pa.Table:
        number = block.column("block")[0].as_py()
        place, counts = places_of(asked(block), buckets)
        cut = np.searchsorted(place, np.arange(buckets + 1, dtype=np.uint64) << np.uint64(32))
        short, counts = place.astype(np.uint32), counts.astype(np.uint32)
        rows = [
            (b, number, short[cut[b] : cut[b + 1]].tobytes(), counts[cut[b] : cut[b + 1]].tobytes())
            for b in range(buckets)
            if cut[b] < cut[b + 1]
        ]
        columns = list(zip(*rows)) or [()] * len(DEALT)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, KINDS)], names=DEALT)

    def count(rows: pa.Table) -> pa.Table:
        tokens = [np.frombuffer(x, "u4") for x in rows.column("tokens").to_pylist()]
        counts = [np.frombuffer(x, "u4") for x in rows.column("counts").to_pylist()]
        _, code = np.unique(np.concatenate(tokens), return_inverse=True)
        total = np.bincount(code, weights=np.concatenate(counts)).astype(np.uint32)
        ends = np.cumsum([len(t) for t in tokens])[:-1]
        back = [x.tobytes() for x in np.split(total[code], ends)]
        columns = [rows.column("block"), rows.column("bucket"), pa.array(back, pa.binary())]
        return pa.Table.from_arrays(columns, names=["block", "bucket", "counts"])

    # The same shuffle as that of ``signatures``, so Spark makes it once.
    dealt = sets.groupBy("block").applyInArrow(deal, "bucket int, block int, tokens binary, counts binary")
    return dealt.groupBy("bucket").applyInArrow(count, "block int, bucket int, counts binary")


def signature_keys(tokens: np.ndarray, counts: np.ndarray, percent: int, often: int = OFTEN):
    """(keys for partners of the set's size or more, keys for smaller partners) of one set.

    counts tell how many sets hold a token; tokens of this set alone give credit and no key.
    """
    n = len(tokens)
    order = np.lexsort((tokens, counts))
    tokens, counts = tokens[order], counts[order]
    rare, several = np.searchsorted(counts, [often, 1], "right").tolist()
    rest = tokens[rare:]
    top = (n // SMALL).bit_length() - 1

    def keys(need: int):
        yield mix(tokens[several : min(rare, need)])
        if rare >= need:
            return
        # Sizes of similar sets differ by less than a factor of two, so their scales differ by one
        # at most; each set has keys of its own scale and of the one below.
        for scale in {max(top, -1), max(top - 1, -1)}:
            if scale < 0:
                yield mix(rest[: need - rare])
                continue
            label = mix(rest + np.uint64(5)) & np.uint64((1 << scale) - 1)
            # The first token of a class gives no credit.
            credit = np.ones(len(rest), np.int64)
            credit[np.unique(label, return_index=True)[1]] = 0
            end = int(np.searchsorted(np.cumsum(credit), need - rare)) + 1
            some, group = rest[:end], label[:end]
            by = np.argsort(group, kind="stable")
            some, group = some[by], group[by]
            salt = constants(2, seed=1000 + scale)
            for gap in range(1, len(some)):
                same = group[gap:] == group[:-gap]
                if not same.any():
                    break
                # Tokens of a class are in one order for all sets, so a pair needs no sorting.
                yield mix(mix(some[:-gap][same] + salt[0]) * salt[1] + some[gap:][same])

    least = -(-percent * n // 100)
    own = np.unique(np.concatenate(list(keys(n - needed(n, n, percent) + 1))))
    every = np.unique(np.concatenate(list(keys(n - needed(n, least, percent) + 1))))
    return own, np.setdiff1d(every, own, assume_unique=True)


def parity(tokens: np.ndarray) -> bytes:
    """A bitmap of a set: each token flips one bit.  Its size follows that of the set."""
    bits = 1 << max(9, (2 * len(tokens)).bit_length())
    at = (mix(tokens + np.uint64(71)) & np.uint64(bits - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=bits) & 1).astype(np.uint8)
    return np.packbits(odd).tobytes()


def folded(maps: list[bytes], size: int) -> np.ndarray:
    """Bitmaps as rows of ``size`` bytes.  Tokens keep their lower bits, so a larger map folds."""
    rows = [np.frombuffer(m, np.uint8) for m in maps]
    rows = [r if len(r) == size else np.bitwise_xor.reduce(r.reshape(-1, size)) for r in rows]
    return np.stack(rows)


def signatures(sets: DataFrame, percent: int) -> DataFrame:
    """(id, n, score, bits, sketch, own, probe, tokens) for sets (id, sid, n, tokens, block).

    Rows without tokens tell which sets are asked for; other sets take no part.  Sets that share too few tokens with others to have a partner are left out.  score tells how
    common a set's tokens are.  The keys in sketch come from min-hashes: they find the bulk of a
    group of near copies with few comparisons.  own are the signatures that partners of the set's
    size or more find, probe the further ones that find smaller partners.
    """
    buckets = 4 * parts(sets.sparkSession)
    salts = constants(SKETCHES, seed=41)
    names = ["id", "n", "score", "bits", "sketch", "own", "probe", "tokens"]
    longs = pa.list_(pa.int64())
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), longs, longs, longs, pa.binary()]

    def run(block: pa.Table, known: pa.Table) -> pa.Table:
        block, known = asked(block), known.sort_by("bucket")
        place, _ = places_of(block, buckets)
        total = np.frombuffer(b"".join(known.column("counts").to_pylist()), "u4").astype(np.int64)
        rows = []
        ids, sizes = block.column("id").to_pylist(), block.column("n").to_pylist()
        for i, n, x in zip(ids, sizes, block.column("tokens").to_pylist()):
            x = np.frombuffer(x, "u8")
            counts = total[np.searchsorted(place, places(x, buckets))]
            shared = x[counts > 1]
            if 100 * len(shared) < percent * n:
                continue
            sketch = np.unique([mix(mix(shared + s).min(keepdims=True) + s)[0] for s in salts])
            own, probe = (k.view(np.int64) for k in signature_keys(x, counts, percent))
            score = int(counts.mean() * 100)
            rows.append([i, n, score, parity(x), sketch.view(np.int64), own, probe, x.tobytes()])
        columns = list(zip(*rows)) or [[]] * len(names)
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    schema = (
        "id long, n long, score long, bits binary, sketch array<long>, own array<long>,"
        " probe array<long>, tokens binary"
    )
    both = sets.groupBy("block").cogroup(counted(sets, buckets).groupBy("block"))
    return both.applyInArrow(run, schema)


def plausible(rows: DataFrame, pivots: DataFrame, cells: int, percent: int) -> DataFrame:
    """The pairs (a, b) of rows and pivots of one (key, sub) that are to be compared.

    A pair of one component, of too different sizes or of too different bitmaps is none.  Keys
    share out ``cells`` groups, so no group of many keys or few rows gets a call of its own.
    """
    names = ["id", "n", "score", "own", "label"]

    def of_key(rows, pivots):
        """Pairs of rows and pivots of one key."""
        maps, others = rows["bits"], pivots["bits"]
        size = min(map(len, maps + others))
        x, y = folded(maps, size), folded(others, size)
        p = {k: np.array(pivots[k])[None, :] for k in names if k != "own"}
        step = max(1, (4 << 20) // y.size)
        for begin in range(0, len(x), step):
            r = {k: np.array(rows[k][begin : begin + step])[:, None] for k in names}
            least = -(-percent * (r["n"] + p["n"]) // (100 + percent))
            fit = (r["label"] != p["label"]) & (least <= np.minimum(r["n"], p["n"]))
            # A smaller set finds a larger one where the larger is not the pivot.
            fit &= (r["n"] >= p["n"]) | r["own"]
            if fit.any():
                odd = np.bitwise_count(x[begin : begin + step, None] ^ y[None]).sum(axis=2)
                fit &= odd <= r["n"] + p["n"] - 2 * least
                i, j = np.nonzero(fit)
                one, two = r["id"][i, 0], p["id"][0, j]
                yield np.stack([np.minimum(one, two), np.maximum(one, two)])

    def by_key(table: pa.Table) -> dict:
        """Columns as lists, by key and sub."""
        out: dict[tuple, dict] = {}
        columns = [table.column(c).to_pylist() for c in (*names, "bits")]
        for key, row in zip(zip(*(table.column(c).to_pylist() for c in ("key", "sub"))), zip(*columns)):
            group = out.setdefault(key, {c: [] for c in (*names, "bits")})
            for c, v in zip(group, row):
                group[c].append(v)
        return out

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        others, found = by_key(right), [np.empty((2, 0), np.int64)]
        for key, group in by_key(left).items():
            if key in others:
                found += of_key(group, others[key])
        a, b = np.unique(np.concatenate(found, axis=1), axis=1)
        return pa.table({"a": a, "b": b})

    cell = F.pmod(F.xxhash64("key", "sub"), F.lit(cells)).alias("cell")
    columns = cell, "key", "sub", *names, "bits"
    left, right = rows.select(*columns).groupBy("cell"), pivots.select(*columns).groupBy("cell")
    return left.cogroup(right).applyInArrow(run, "a long, b long").distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets reach the threshold."""
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id"))
    shared = sets.sparkSession.sparkContext.broadcast(id_filter(ids))

    def named(batches):
        for batch in batches:
            yield batch.filter(pa.array(may_hold(shared.value, batch.column(0).to_numpy())))

    # Later rounds have few pairs left: tokens of sets without any are not shuffled.
    some = sets.select("id", "tokens").mapInArrow(named, "id long, tokens binary")
    left = some.select(F.col("id").alias("a"), F.col("tokens").alias("x"))
    right = some.select(F.col("id").alias("b"), F.col("tokens").alias("y"))

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), "u8"), np.frombuffer(y.as_buffer(), "u8")
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y")
    return joined.mapInArrow(tidy(run), "a long, b long")


def linked(every: DataFrame, scratch: Scratch, percent: int) -> DataFrame:
    """Verified links (a, b) that connect all sets of ``signatures`` that links connect."""
    facts = every.select("id", "n", "score", "bits")
    links = scratch.keep(every.sparkSession.createDataFrame([], "a long, b long"))

    def with_roots(rows, roots):
        if roots is None:
            return rows.withColumn("label", F.col("id"))
        named = rows.join(roots.toDF("id", "root"), "id", "left")
        return named.withColumn("label", F.coalesce("root", "id")).drop("root")

    def compare(rows, roots, links, width):
        """Compare each key's ``width`` most common sets that can be found with the others.

        rows: (key, id, own, score, label).  Gives the links so far, their components, and the
        rows whose pairs are still open: nothing of keys whose sets are all connected, and no set
        that was compared with all others.
        """
        alive = rows.groupBy("key").agg(
            F.min("label").alias("x"),
            F.max("label").alias("y"),
            F.count_if("own").alias("owns"),
            F.expr(f"cast(1 + count(*) div {GROUP} as int)").alias("subs"),
        )
        alive = alive.filter("x < y and owns > 0").select("key", "owns", "subs")
        open_ = scratch.keep(rows.join(alive, "key"))
        count = open_.count()
        if not count:
            return links, roots, None
        # Spark cuts every task to the first rows of a key before the shuffle.
        rank = F.row_number().over(Window.partitionBy("key").orderBy(F.desc("score"), "id"))
        chosen = open_.filter("own").withColumn("rank", rank).filter(F.col("rank") <= width)
        chosen = scratch.keep(chosen.select("key", "id", "own", "score", "label", "owns", "subs"))
        sizes = facts.select("id", "n", "bits")
        # The rows of a frequent key are dealt to several groups; its pivots go to each of them.
        every_sub = F.explode(F.sequence(F.lit(0), F.col("subs") - 1)).alias("sub")
        pivots = scratch.keep(chosen.join(sizes, "id").select("*", every_sub))
        sub = F.pmod(F.xxhash64("id"), F.col("subs")).cast("int").alias("sub")
        dealt = open_.join(sizes, "id").select("*", sub)
        pairs = scratch.keep(plausible(dealt, pivots, 1 + count // CELL, percent))
        found = scratch.keep(verified(pairs, every, percent))
        done = chosen.filter(F.col("owns") > width).select("key", "id")
        more = open_.filter(F.col("owns") > width).select("key", "id", "own")
        after = more.join(done, ["key", "id"], "left_anti")
        after = scratch.keep(after)
        if not found.isEmpty():
            links = scratch.keep(links.union(found))
            roots = components(links, scratch)
        scratch.drop(open_, chosen, pivots, pairs, found)
        return links, roots, after

    first = every.select(F.explode("sketch").alias("key"), "id", F.lit(True).alias("own"), "score")
    links, roots, _ = compare(with_roots(first, None), None, links, 1)
    # Labels join the sets, not their many signatures.
    marked = with_roots(every, roots)
    own = marked.select(F.explode("own").alias("key"), "id", F.lit(True).alias("own"), "score", "label")
    probe = marked.select(F.explode("probe").alias("key"), "id", F.lit(False).alias("own"), "score", "label")
    rows, width = own.union(probe), 64
    while rows is not None:
        links, roots, left = compare(rows, roots, links, width)
        if left is not None:
            known = with_roots(every.select("id", "score"), roots)
            left = left.join(known, "id").select("key", "id", "own", "score", "label")
        rows = left
        width = min(4 * width, WIDEST)
    return links


def near_duplicates(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of ``documents``.

    component_id is the least doc_id that links reach, the row's own included.  Rows whose text is
    null or has no word have an empty set and link with nothing, not even with each other.
    Documents of equal sets link.  Rows of one doc_id are one node of the graph, whatever their
    texts.  A row without doc_id is listed with its set's size and no component, and links nothing.
    An empty table gives an empty result; other columns are not read.
    """
    if not 50 <= percent <= 100:
        raise ValueError("percent must be from 50 to 100")
    scratch = Scratch(documents.sparkSession, "ngram-join")
    rows = scratch.keep(document_sets(documents, width))
    named = rows.filter("sid is not null and doc_id is not null")
    least = F.min("doc_id").alias("id"), F.max("n").alias("n")
    groups = scratch.keep(named.groupBy("sid").agg(*least))

    # What is left of the screening tokens when a partner lacks as many as it may.
    need = F.expr(f"least(n - n * {100 - percent} div 100, 1 + n div 16)")
    counts = shared_counts(documents.filter("doc_id is not null"), width, percent)
    kept = groups.withColumn("owner", owner_of(F.col("sid"))).join(counts, "owner")
    kept = kept.filter(F.col("shared") >= need).select("id", "sid", "n")

    wanted = scratch.keep(kept)
    shared = documents.sparkSession.sparkContext.broadcast(id_filter(wanted))

    def tokens(batches):
        for batch in batches:
            batch = batch.filter(pa.array(may_hold(shared.value, batch.column(0).to_numpy())))
            data, offsets = utf8(batch.column(1))
            some = [(i, s) for i, s in batches_of_sets(data, offsets, width) if len(s)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([i for i, _ in some], pa.int64())),
                    pa.array([digest(s) for _, s in some], pa.binary()),
                    pa.array([len(s) for _, s in some], pa.int64()),
                    pa.array([s.tobytes() for _, s in some], pa.binary()),
                ],
                names=["id", "sid", "n", "tokens"],
            )

    # Texts are not shuffled: what passes the filter is cut into sets where it stands, and the
    # sets meet the ids and digests in question in their block, by one shuffle.
    texts = documents.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("id"), "text")
    found = texts.mapInArrow(tidy(tokens), "id long, sid binary, n long, tokens binary")
    found = scratch.keep(found)
    total = wanted.agg(F.sum("n")).first()[0] or 0
    block = F.pmod(F.xxhash64("id"), F.lit(1 + total // BLOCK)).cast("int")
    sets = found.union(wanted.withColumn("tokens", F.lit(None).cast("binary"))).withColumn("block", block)
    every = scratch.keep(signatures(sets, percent))
    scratch.drop(found)

    links = linked(every, scratch, percent)
    # Rows of one id with several sets hold the groups of these sets together.
    member = named.join(groups.select("sid", "id"), "sid").select("doc_id", "id")
    split = member.groupBy("doc_id").agg(F.min("id").alias("x"), F.max("id").alias("y"))
    split = split.filter("x < y").select("doc_id")
    more = member.join(split, "doc_id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    roots = components(links.union(more), scratch)

    home = groups.join(roots, groups["id"] == roots["node"], "left").select(
        "sid", F.coalesce("root", "id").alias("component_id")
    )
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return rows.join(home, "sid", "left").select(
        "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id")
    )


def representatives(documents: DataFrame, width: int = WIDTH, percent: int = PERCENT) -> DataFrame:
    """``documents`` with one row of each component: that of the least doc_id.

    Rows without doc_id, and rows whose text is null or has no word, all stay.  Repeated rows of
    one doc_id are one document: one of them stays, that of the least text, then of any.
    """
    scratch = Scratch(documents.sparkSession, "representatives")
    found = near_duplicates(documents, width, percent)
    linked_ = found.filter("doc_id is not null and n_shingles > 0")
    gone = scratch.keep(
        linked_.filter("component_id <> doc_id").select("doc_id").distinct()
    )
    left = documents.join(gone, "doc_id", "left_anti").select(documents.columns)
    again = linked_.groupBy("doc_id").count().filter("count > 1").select("doc_id")
    again = scratch.keep(again)
    if again.isEmpty():
        return left
    once = left.join(again, "doc_id", "left_anti").select(documents.columns)
    several = left.join(again, "doc_id").select(documents.columns)
    rank = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.asc_nulls_last("text")))
    number = unused("_rank", several)
    several = several.withColumn(number, rank).filter(F.col(number) == 1).drop(number)
    return once.unionByName(several)
