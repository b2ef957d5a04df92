"""Benchmark decontamination by a BM25 index of the test items and block-max WAND.

Each document is cut into overlapping passages, long enough that any item lies whole in one of
them.  Every passage is a query to an inverted index of the items, whose BM25 weights are scaled
so that an item matched in full scores 1.  Passages are processed many at a time, one block of
items after the other:

* the largest weight of each term in the block bounds a passage's score in the block; passages
  below the threshold skip the block;
* as in WAND, frequent terms are not walked: the lists of the other terms are added up, and only
  items whose sum reaches the threshold less the bound of the frequent terms are scored in full.

What reaches the threshold is verified: of the item's question and of its answer, a share of the
word pairs has to be in the passage.  Items of fewer than five words have to be there as they are,
word by word.  In scripts without blanks between words, each character is a word.
"""

from __future__ import annotations

import re
import unicodedata
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from roadlark.llm.common import RollingSums, Scratch, constants, distinct, mix, slices, tidy, utf8

K1, B = 1.2, 0.75
THRESHOLD = 0.55
OVERLAP = 0.5
# Items with fewer words have to be there exactly.
LEAST_WORDS = 5
# One index holds items of so many bytes; more items take several passes over the documents.
INDEX_BYTES = 16 << 20
BLOCK = 256
SLICE_BYTES = 1 << 20

_WORD_BYTE = np.array(
    [48 <= b <= 57 or 65 <= b <= 90 or 97 <= b <= 122 or b >= 128 for b in range(256)]
)
_ROLLING = RollingSums(seed=53)
_PAIR = constants(2, seed=59)
_SENTENCE = re.compile(r"(?<=[.!?])\s+|(?<=[\u3002\uff01\uff1f])\s*|\n+")
# Thai to Myanmar, Khmer, Tai scripts, kana, Han and their supplements: no blanks between words.
_UNSEGMENTED = (
    (0x0E00, 0x109F), (0x1780, 0x17FF), (0x1950, 0x19FF), (0x1A20, 0x1AAF), (0x3005, 0x3007),
    (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xA9E0, 0xA9FF),
    (0xAA60, 0xAA7F), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x1AFF0, 0x1B16F), (0x20000, 0x323AF),
)
_BETWEEN, _ALONE = 1, 2
_KIND = np.zeros(0x110000, np.uint8)
for _low, _high in _UNSEGMENTED:
    _KIND[_low : _high + 1] = _ALONE
for _code in range(0x80, 0x20000):  # no punctuation or blanks above
    if unicodedata.category(chr(_code))[0] in "PZ":
        _KIND[_code] = _BETWEEN


def words(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text, start, end) of the lower-case words of all texts, in bytes of each text."""
    data, offsets = utf8(pc.utf8_lower(column))
    inside = _WORD_BYTE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    lead = np.flatnonzero(data >= 0xC0)
    if len(lead):
        first = data[lead].astype(np.int32)
        size = 2 + (first >= 0xE0) + (first >= 0xF0)
        code = first & (0x7F >> size)
        for k in range(1, 4):
            more = size > k
            code[more] = code[more] << 6 | data[lead[more] + k] & 0x3F
        kind = _KIND[code]
        alone = kind == _ALONE
        edge[lead[alone]] = edge[lead[alone] + size[alone]] = True
        for k in range(4):
            inside[lead[(kind == _BETWEEN) & (size > k)] + k] = False
    start = np.flatnonzero(inside & ~(np.concatenate(([False], inside[:-1])) & ~edge[:-1]))
    end = np.flatnonzero(inside & ~(np.concatenate((inside[1:], [False])) & ~edge[1:])) + 1
    hashes = _ROLLING.ranges(_ROLLING.sums(data), start, end)
    text = np.searchsorted(offsets, start, "right") - 1
    return hashes, text, start - offsets[text], end - offsets[text]


def pairs(hashes: np.ndarray) -> np.ndarray:
    """Hashes of neighbouring words; of a single word, itself."""
    if len(hashes) < 2:
        return hashes
    return mix(hashes[:-1] * _PAIR[0] + hashes[1:] * _PAIR[1])


def halves(text: str) -> tuple[str, str]:
    """(question, answer): the answer is the last sentence, or the second half of a single one."""
    parts = [p for p in _SENTENCE.split(text.strip()) if p]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    some, blank = text.split(), " "
    if len(some) == 1:
        some, blank = list(some[0]), ""
    return blank.join(some[: (len(some) + 1) // 2]), blank.join(some[(len(some) + 1) // 2 :])


@dataclass
class Block:
    """Postings of one block of items by term: items from ``cut[t]`` to ``cut[t + 1]``.

    ``often`` holds the weights of the frequent terms once more, as a row per term.
    """

    cut: np.ndarray
    item: np.ndarray
    weight: np.ndarray
    largest: np.ndarray
    often: np.ndarray


@dataclass
class Index:
    ids: np.ndarray
    terms: np.ndarray  # sorted hashes
    often: np.ndarray  # number among the frequent terms, or -1
    blocks: list[Block]
    parts: list[tuple[np.ndarray, np.ndarray]]  # word pairs of its question and its answer
    span: int  # words of the longest item
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # sequences of so many words: hash, item


def sequences(hashes: np.ndarray, count: int) -> np.ndarray:
    """Hashes of ``count`` words in a row, from each word on."""
    size = max(len(hashes) - count + 1, 0)
    out = hashes[:size]
    for k in range(1, count):
        out = mix(out * _PAIR[0] + hashes[k : k + size] * _PAIR[1])
    return out


def build(rows: list[tuple[int, str]], frequency: dict[int, int], total: int, mean: float):
    """An index of items (id, text); ``frequency`` is the number of all items with a word."""
    items, few = [], []
    for item_id, text in rows:
        h = words(pa.array([text]))[0]
        if 0 < len(h) < LEAST_WORDS:
            few.append((item_id, h))
        elif len(h):
            term, count = np.unique(h, return_counts=True)
            df = np.array([frequency[int(x)] for x in term.view(np.int64)], float)
            rare = np.log(1 + (total - df + 0.5) / (df + 0.5))
            weight = rare * count * (K1 + 1) / (count + K1 * (1 - B + B * len(h) / mean))
            both = tuple(pairs(words(pa.array([p]))[0]) for p in halves(text))
            items.append((item_id, term, weight / weight.sum(), both, len(h)))
    if not items and not few:
        return None
    short = {}
    for size in sorted({len(h) for _, h in few}):
        own = [i for i, (_, h) in enumerate(few) if len(h) == size]
        key = np.concatenate([sequences(few[i][1], size) for i in own])
        order = np.argsort(key, kind="stable")
        short[size] = key[order], (np.array(own) + len(items))[order]
    ids = np.array([x[0] for x in (*items, *few)], np.int64)
    if not items:
        return Index(ids, np.empty(0, np.uint64), np.empty(0, np.int64), [], [], 0, short)
    terms = np.unique(np.concatenate([x[1] for x in items]))
    number = [np.searchsorted(terms, x[1]) for x in items]
    lists = np.bincount(np.concatenate(number), minlength=len(terms))
    frequent = lists > max(4, len(items) // 32)
    often = np.where(frequent, np.cumsum(frequent) - 1, -1)
    blocks = []
    for begin in range(0, len(items), BLOCK):
        some = range(begin, min(begin + BLOCK, len(items)))
        term = np.concatenate([number[i] for i in some])
        item = np.repeat(np.arange(len(some)), [len(number[i]) for i in some])
        weight = np.concatenate([items[i][2] for i in some])
        order = np.argsort(term, kind="stable")
        largest = np.zeros(len(terms))
        np.maximum.at(largest, term, weight)
        cut = np.searchsorted(term[order], np.arange(len(terms) + 1))
        dense = np.zeros((int(frequent.sum()), BLOCK), np.float32)
        dense[often[term][frequent[term]], item[frequent[term]]] = weight[frequent[term]]
        blocks.append(Block(cut, item[order], weight[order], largest, dense))
    return Index(
        ids,
        terms,
        often,
        blocks,
        [x[3] for x in items],
        max(x[4] for x in items),
        short,
    )


def retrieve(index: Index, passage: np.ndarray, term: np.ndarray, count: int, threshold: float):
    """(passage, item, score) of all items that reach the threshold.

    ``passage`` and ``term`` are the distinct pairs, sorted, of ``count`` passages.
    """
    often = index.often[term] >= 0
    for number, block in enumerate(index.blocks):
        bound = np.bincount(passage, weights=block.largest[term], minlength=count)
        if not (bound >= threshold).any():
            continue
        walk = ~often & (bound >= threshold)[passage]
        p, t = passage[walk], term[walk]
        size = block.cut[t + 1] - block.cut[t]
        first = np.repeat(block.cut[t] - np.concatenate(([0], np.cumsum(size)[:-1])), size)
        at = first + np.arange(len(first))
        cell = np.repeat(p, size) * BLOCK + block.item[at]
        score = np.bincount(cell, weights=block.weight[at], minlength=count * BLOCK)
        score = score.reshape(count, BLOCK)
        # What the frequent terms can add at most decides whether they are looked at.
        rest = np.bincount(passage[often], weights=block.largest[term[often]], minlength=count)
        close = np.flatnonzero((score.max(axis=1) + rest >= threshold) & (bound >= threshold))
        place = np.full(count, -1)
        place[close] = np.arange(len(close))
        held = np.zeros((len(close), len(block.often)), np.float32)
        some = often & (place[passage] >= 0)
        held[place[passage[some]], index.often[term[some]]] = 1
        full = score[close] + held @ block.often
        for i, j in zip(*np.nonzero(full >= threshold)):
            yield int(close[i]), int(number * BLOCK + j), float(full[i, j])


def share(part: np.ndarray, passage: np.ndarray) -> float:
    return float(np.isin(part, passage).mean()) if len(part) else 1.0


def copies(index: Index, hashes, text, begin, end):
    """As ``matches``, for the items that have to be there exactly: the first place of each."""
    for size, (key, item) in index.short.items():
        found = sequences(hashes, size)
        low = np.searchsorted(key, found, "left")
        count = np.searchsorted(key, found, "right") - low
        count[text[: len(found)] != text[size - 1 :]] = 0
        seen = set()
        for at in np.flatnonzero(count).tolist():
            known = int(text[at]), int(low[at])
            if known not in seen:
                seen.add(known)
                where = int(begin[at]), int(end[at + size - 1])
                for k in item[low[at] : low[at] + count[at]].tolist():
                    yield known[0], k, 1.0, 1.0, 1.0, *where


def matches(index: Index, texts, threshold: float, overlap: float):
    """(text, item, score, question, answer, start, end), the best passage per text and item.

    start and end are the passage's bytes in its lower-case text.
    """
    hashes, text, begin, end = words(texts)
    exact = list(copies(index, hashes, text, begin, end))
    if not index.blocks:
        return exact
    at = np.minimum(np.searchsorted(index.terms, hashes), len(index.terms) - 1)
    known = np.where(index.terms[at] == hashes, at, -1)
    number = np.bincount(text, minlength=len(texts))
    first = np.concatenate(([0], np.cumsum(number)))
    # Passages of two spans, one span apart: an item of a span lies whole in one of them.
    count = np.maximum(-(-number // index.span) - 1, (number > 0).astype(int))
    base = np.concatenate(([0], np.cumsum(count)))
    home = np.repeat(np.arange(len(texts)), count)
    low = first[home] + (np.arange(base[-1]) - base[home]) * index.span
    high = np.minimum(low + 2 * index.span, first[home + 1])
    total = len(low)
    if not total:
        return []
    place = np.arange(len(hashes)) - first[text]
    last = count[text] - 1
    two = base[text] + np.minimum(place // index.span, last)
    one = base[text] + np.maximum(place // index.span - 1, 0)
    one = np.minimum(one, two)
    use = known >= 0
    both = np.concatenate((one[use], two[use])) * len(index.terms) + np.tile(known[use], 2)
    both = distinct(both)
    passage, term = both // len(index.terms), both % len(index.terms)
    best: dict[tuple[int, int], tuple] = {}
    for p, k, score in retrieve(index, passage, term, total, threshold):
        key = int(home[p]), k
        inside = pairs(hashes[low[p] : high[p]])
        inside = np.concatenate((inside, hashes[low[p] : high[p]]))
        q, a = (share(part, inside) for part in index.parts[k])
        # Of passages of one score, that with more of the item's word pairs.
        rank = round(score, 4), q + a
        if q >= overlap and a >= overlap and (key not in best or rank > best[key][0]):
            where = int(begin[low[p]]), int(end[high[p] - 1])
            best[key] = rank, (key[0], k, score, q, a, *where)
    return exact + [row for _, row in best.values()]


def indexes(benchmark: DataFrame):
    """Indexes of all items, each of bounded size."""
    known = benchmark.filter("item_id is not null and text is not null").select(
        F.col("item_id").cast("long"), F.col("text")
    )

    def terms(batches):
        for batch in batches:
            h, text, _, _ = words(batch.column(0))
            pair = np.unique(np.stack([text.astype(np.uint64), h]), axis=1)
            long = np.bincount(text, minlength=batch.num_rows)
            first = np.concatenate(([0], np.cumsum(np.bincount(pair[0].astype(int), minlength=batch.num_rows))))
            out = [pair[1][first[i] : first[i + 1]].view(np.int64) for i in range(batch.num_rows)]
            columns = [batch.column(1), pa.array(long), pa.array(out, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["part", "n", "terms"])

    size = known.agg(F.sum(F.octet_length("text")), F.count("*")).first()
    if not size[1]:
        return
    several = 1 + (size[0] or 0) // INDEX_BYTES
    part = F.pmod(F.xxhash64("item_id"), F.lit(several)).cast("int")
    scratch = Scratch(benchmark.sparkSession, "decontaminate")
    cut = known.select("text", part.alias("part")).mapInArrow(terms, "part int, n long, terms array<long>")
    cut = scratch.keep(cut)
    total, mean = cut.agg(F.count("*"), F.avg("n")).first()
    every = cut.select("part", F.explode("terms").alias("term"))
    frequency = scratch.keep(every.groupBy("term").count())
    for i in range(several):
        mine = every.filter(F.col("part") == i).select("term").distinct()
        seen = {r[0]: r[1] for r in frequency.join(mine, "term").collect()}
        rows = known.filter(part == i).orderBy("item_id", "text").collect()
        index = build([tuple(r) for r in rows], seen, total, max(mean, 1.0))
        if index:
            yield index


def contaminated(
    documents: DataFrame,
    benchmark: DataFrame,
    threshold: float = THRESHOLD,
    overlap: float = OVERLAP,
) -> DataFrame:
    """(doc_id, item_id, score, question, answer, start, end): items found in documents.

    One row per document row and item, for the passage of the best score; question and answer
    are the shares of their word pairs in it.  Words are compared in lower case, so case and
    punctuation do not matter.  Items of fewer than five words match their exact word sequence, at
    its first place.  Null items and null, empty or wordless items and texts match nothing.  Repeated items and rows match each; rows without doc_id give
    rows with a null id.  Empty tables give an empty result; other columns are not read.
    """
    schema = "doc_id long, item_id long, score double, question double, answer double, start long, end long"
    texts = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    spark, out = documents.sparkSession, None
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)  # of bounded size

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                column = batch.column(1)
                sizes = np.array(pc.fill_null(pc.binary_length(column), 0))
                for i, j in slices(sizes, SLICE_BYTES):
                    rows = matches(index, column.slice(i, j - i), threshold, overlap)
                    if rows:
                        text, item, *rest = zip(*rows)
                        columns = [
                            batch.column(0).slice(i, j - i).take(pa.array(text, pa.int64())),
                            pa.array(index.ids[list(item)]),
                            *(pa.array(c) for c in rest),
                        ]
                        names = ["doc_id", "item_id", "score", "question", "answer", "start", "end"]
                        yield pa.RecordBatch.from_arrays(columns, names=names)

        found = texts.mapInArrow(tidy(run), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def clean(documents: DataFrame, benchmark: DataFrame, threshold: float = THRESHOLD, overlap: float = OVERLAP) -> DataFrame:
    """``documents`` without the rows whose text ``contaminated`` finds; all columns stay.

    Each row is judged by its own text where it is read: rows without doc_id and rows that share one
    are no exception, and nothing is shuffled.
    """
    spark, at = documents.sparkSession, documents.columns.index("text")
    for index in indexes(benchmark):
        shared = spark.sparkContext.broadcast(index)  # of bounded size

        def run(batches, shared=shared):
            index = shared.value
            for batch in batches:
                column = batch.column(at).cast(pa.string())
                sizes = np.array(pc.fill_null(pc.binary_length(column), 0))
                keep = np.ones(len(column), bool)
                for i, j in slices(sizes, SLICE_BYTES):
                    for text, *_ in matches(index, column.slice(i, j - i), threshold, overlap):
                        keep[i + text] = False
                yield batch.filter(pa.array(keep))

        documents = documents.mapInArrow(tidy(run), documents.schema)
    return documents
