"""Mixing sources to target weights.

Words are added up per source, each source gets a target number of words, and its repetition
rate is target / size.  A document is emitted floor(rate) times, and once more if a number drawn
from a hash of its id and the seed falls below the rate's fraction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from roadlark.llm.common import WORD, Scratch, unused

WEIGHTS = (5.0, 2.0, 1.0)
SHARE = 1.5
LIMIT = 2.0


def draw(doc_id: Column, seed: int) -> Column:
    """A number in [0, 1) that depends on the id and the seed only."""
    return F.shiftrightunsigned(F.xxhash64(doc_id, F.lit(seed)), 11) / F.lit(float(1 << 53))


def source_sizes(sized: DataFrame) -> DataFrame:
    """(source, source_size, weight): weights repeat over the sources by code point, null last."""
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    # One row per source: ranks come from small sums, never from documents.
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weights = F.array(*map(F.lit, WEIGHTS))
    return sums.withColumn("weight", F.get(weights, (rank % len(WEIGHTS)).cast("int")))


def with_targets(sources: DataFrame, share: float = SHARE, limit: float = LIMIT) -> DataFrame:
    """Add ``target`` to (source, source_size, weight).

    All targets add up to ``share`` times all sizes, in proportion to the weights; a target stops
    at ``limit`` times its source's size and the excess goes to the others by weight until none
    is above.  Each round adds up the table and fetches four numbers; a round stops at least one
    more source, and in practice a handful of rounds do.
    """
    if share > limit:
        raise ValueError("no mix can take more than the limit of every source")
    top = F.col("source_size") * F.lit(limit)
    total = sources.agg((F.sum("source_size") * F.lit(share)).alias("t")).first().t or 0.0
    level, stopped = 0.0, -1
    while True:
        # Sources that the present level stops; before the first round there are none.
        full = F.col("weight") * F.lit(level) >= top if stopped >= 0 else F.lit(False)
        s = sources.agg(
            F.count_if(full).alias("n"),
            F.coalesce(F.sum(F.when(full, top)), F.lit(0.0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~full, F.col("weight"))), F.lit(0.0)).alias("open"),
        ).first()
        if s.n == stopped or not s.open:
            break
        stopped, level = s.n, max(level, (total - s.fixed) / s.open)
    target = F.least(F.col("weight") * F.lit(level), top)
    return sources.withColumn("target", target.cast("double"))


def mix(documents: DataFrame, seed: int = 7) -> DataFrame:
    """Every row of ``documents`` with size, source_size, target, copies and taken.

    size counts the words of the whole text (null or empty: 0).  copies is how often the mix
    emits the row, taken = copies * size.  Rows of an empty source get no copies.  Repeated rows
    count like others and rows of one id get the same draw; rows without an id are drawn by their texts.
    An empty table gives an empty result.  Further columns stay as they are, but columns of the
    names above are replaced.
    """
    scratch = Scratch(documents.sparkSession, "mixing")
    names = ("size", "source_size", "weight", "target", "copies", "taken")
    plain = documents.drop(*names)
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long")
    sized = plain.withColumn("size", size)
    sources = scratch.keep(with_targets(scratch.keep(source_sizes(sized))))
    key = unused("_source", sized)
    small = sources.select(F.col("source").alias(key), "source_size", "target")
    # One row per source: Spark broadcasts them while its size estimate allows, else it shuffles
    # and splits a source that has a large share of the rows.
    joined = sized.join(small, sized["source"].eqNullSafe(small[key])).drop(key)
    empty = F.col("source_size") == 0
    rate = F.when(empty, 0.0).otherwise(F.col("target") / F.col("source_size"))
    who = F.coalesce(F.col("doc_id"), F.xxhash64("text"))
    more = draw(who, seed) < rate - F.floor(rate)
    copies = F.floor(rate) + F.when(more, 1).otherwise(0)
    return joined.withColumn("copies", copies.cast("long")).withColumn(
        "taken", F.col("copies") * F.col("size")
    )


def emitted(mixed: DataFrame) -> DataFrame:
    """The mix itself: each row as often as ``copies`` says, with its number as ``copy``."""
    numbers = F.sequence(F.lit(1), F.col("copies").cast("int"))
    return mixed.filter("copies > 0").withColumn("copy", F.explode(numbers))
