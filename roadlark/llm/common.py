"""Small helpers that the operators of this package share."""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Callable, Iterator
from functools import wraps

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from roadlark.session import work_folder

# A word is a run of bytes or characters outside this class.
WORD = r"[^\x20\x09-\x0D]+"

MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Scratch:
    """Intermediate tables in the folder that all executors share.

    ``keep`` writes a DataFrame and returns the written table, which cuts its lineage: a lost
    executor costs only the tasks of the stage that runs.  ``drop`` removes tables that nothing
    reads any more.
    """

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.root = work_folder(spark, purpose)
        self.count = 0

    def keep(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.root}/{self.count}"
        df.write.parquet(path)
        # The schema is known, so no file needs to be opened for it.
        kept = self.spark.read.schema(df.schema).parquet(path)
        kept.scratch_path = path
        return kept

    def drop(self, *frames: DataFrame) -> None:
        jvm = self.spark._jvm
        conf = self.spark._jsc.hadoopConfiguration()
        for frame in frames:
            path = jvm.org.apache.hadoop.fs.Path(frame.scratch_path)
            path.getFileSystem(conf).delete(path, True)


def unused(name: str, df: DataFrame) -> str:
    """``name``, with underscores added until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def slices(sizes: np.ndarray, limit: int) -> Iterator[tuple[int, int]]:
    """Consecutive row ranges whose sizes add up to ``limit`` or little more; a row is never cut."""
    begin, total = 0, 0
    for i, size in enumerate(sizes.tolist()):
        if total and total + size > limit:
            yield begin, i
            begin, total = i, 0
        total += size
    if begin < len(sizes):
        yield begin, len(sizes)


def utf8(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary column; a null has no bytes."""
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if pa.types.is_dictionary(column.type):
        column = column.dictionary_decode()
    column = column.cast(pa.large_binary()).fill_null(b"")
    raw = column.buffers()
    offsets = np.frombuffer(raw[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(raw[2], np.uint8) if raw[2] is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """Finish a 64-bit hash so that all of its bits depend on all bits of the input."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def distinct(x: np.ndarray) -> np.ndarray:
    """The sorted distinct values, by sorting: faster than hashing for whole numbers."""
    x = np.sort(x)
    new = np.ones(len(x), bool)
    np.not_equal(x[1:], x[:-1], out=new[1:])
    return x[new]


def constants(count: int, seed: int) -> np.ndarray:
    """Odd 64-bit numbers from a seed."""
    with np.errstate(over="ignore"):
        steps = np.arange(1, count + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        return mix(steps + np.uint64(seed)) | np.uint64(1)


class RollingSums:
    """Hashes of arbitrary byte ranges of one buffer from prefix sums of ``code[b] * base**i``.

    Sums are modulo 2**64 with an odd base, so a range's value is its difference of prefix sums
    times the inverse power of its start.
    """

    def __init__(self, seed: int) -> None:
        self.code = constants(256, seed)
        self.base = int(constants(1, seed ^ 0x5DEECE66D)[0]) | 5
        self.inverse = pow(self.base, -1, 1 << 64)
        self.up = self.down = np.empty(0, np.uint64)

    def powers(self, base: int, count: int) -> np.ndarray:
        out = np.ones(max(count, 1), np.uint64)
        done, step = 1, base
        while done < count:
            take = min(done, count - done)
            out[done : done + take] = out[:take] * np.uint64(step)
            done, step = done + take, step * step & MASK
        return out

    def sums(self, data: np.ndarray) -> np.ndarray:
        if len(self.up) < len(data) + 1:
            size = max(len(data) + 1, 1 << 16)
            self.up, self.down = self.powers(self.base, size), self.powers(self.inverse, size)
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.code[data] * self.up[: len(data)], out=out[1:])
        return out

    def ranges(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        length = (end - start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix((sums[end] - sums[start]) * self.down[start] + length)


def give_back() -> None:
    """Return memory that is free inside of this process to the system.

    Python workers outlive their tasks, and allocators keep what a task has freed: without this, what
    the largest task of one stage took is still held beside the next stage's work.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def tidy(run: Callable) -> Callable:
    """A function for ``mapInArrow`` whose task begins and ends without memory left over."""

    @wraps(run)
    def task(batches, *args, **kwargs):
        give_back()
        yield from run(batches, *args, **kwargs)
        give_back()

    return task


def _digests(batches: Iterator[pa.RecordBatch], glue: bytes, keys: int) -> Iterator[pa.RecordBatch]:
    """SHA-256 of each key's pieces, joined; a key's rows follow each other in order.  The key is in
    the first columns, the piece in the last."""
    key, digest, begun, out, schema = None, None, False, [], None
    for batch in batches:
        schema = pa.schema([*batch.schema][:keys] + [pa.field("digest", pa.string())])
        columns = [batch.column(i).to_pylist() for i in range(keys)]
        for piece, *new in zip(batch.column(keys), *columns, strict=True):
            if digest is None or new != key:
                if digest is not None:
                    out.append([*key, digest.hexdigest()])
                key, digest, begun = new, hashlib.sha256(), False
            if piece.is_valid:
                digest.update(glue if begun else b"")
                digest.update(piece.as_buffer())
                begun = True
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r, strict=True)) for r in out], schema)
        out = []
    if digest is not None:
        last = dict(zip(schema.names, [*key, digest.hexdigest()], strict=True))
        yield pa.RecordBatch.from_pylist([last], schema)


def ordered_digests(pieces: DataFrame, keys: list[str], order: list[str], piece: str, glue: bytes) -> DataFrame:
    """(keys, digest): the SHA-256 of a key's binary pieces in order, with ``glue`` between them.

    SHA-256 has no parallel form, so a key's pieces pass through one task; they are streamed, and
    none but the current one is held.  Callers join neighbours to large pieces first, so that even
    a very large group is few rows.  A null piece adds nothing, not even glue.
    """
    dealt = pieces.repartition(parts(pieces.sparkSession), *keys).sortWithinPartitions(*keys, *order)
    rows = dealt.select(*keys, F.col(piece).cast("binary").alias("_piece"))
    ddl = ", ".join(f"{k} {dict(rows.dtypes)[k]}" for k in keys) + ", digest string"
    return rows.mapInArrow(lambda b: _digests(b, glue, len(keys)), ddl)
