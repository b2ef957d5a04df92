"""Feedback text: sentiment score, extractive summary, structured answers.

These stand in for hosted language models: same inputs and result shape, transparent rules.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Words of praise (+1) and complaint (-1).
LEXICON = """
good 1
great 1
excellent 1
happy 1
impressive 1
responsive 1
smooth 1
safe 1
clear 1
thanks 1
bad -1
poor -1
terrible -1
disappointed -1
waited -1
drains -1
anxiety -1
hazard -1
risk -1
unsafe -1
"""

ANSWER = (
    "road_condition string, weather string, visibility string,"
    " objects_detected string, safety_risk string, recommended_action string"
)


def lexicon() -> dict[str, float]:
    rows = (line.split() for line in LEXICON.strip().splitlines())
    return {word: float(score) for word, score in rows}


def words(text: Column) -> Column:
    """Runs of letters of any script, with their combining marks, lower-cased."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"(\p{L}[\p{L}\p{M}]*)"))


def sentiment(docs: DataFrame, scores: dict[str, float], key: str, text: str) -> DataFrame:
    """Mean score of the scored words of each text, 0 when there are none; one row per text.

    The lexicon is a literal map, so a text is scored where it stands, without any shuffle.
    """
    table = F.create_map(*(F.lit(x) for pair in scores.items() for x in pair))
    found = F.coalesce(words(F.col(text)), F.array().cast("array<string>"))
    known = F.array_intersect("_words", F.array(*map(F.lit, scores)))
    # Only words of the lexicon are looked up, so a long text costs one pass.
    hits = F.when(F.size(known) > 0, F.filter("_words", lambda w: F.array_contains(known, w)))
    total = F.aggregate("_hits", F.lit(0.0), lambda sum_, w: sum_ + F.element_at(table, w))
    return (
        docs.select(key, found.alias("_words"))
        .select(key, "_words", F.coalesce(hits, F.array().cast("array<string>")).alias("_hits"))
        .select(
            key,
            F.size("_words").cast("bigint").alias("word_count"),
            F.size("_hits").cast("bigint").alias("scored_words"),
            F.coalesce(F.try_divide(total, F.size("_hits")), F.lit(0.0)).alias("sentiment_score"),
        )
    )


def _runs(rows: Column, key: Callable[[Column], Column]) -> Column:
    """Start of each run of equal keys in a sorted array, and its length as the last start."""
    first = F.transform(
        rows, lambda row, i: F.when((i == 0) | (key(F.get(rows, i - 1)) != key(row)), i)
    )
    return F.concat(F.filter(first, lambda i: i.isNotNull()), F.array(F.size(rows)))


def _over_runs(starts: Column, build: Callable[[Column, Column], Column]) -> Column:
    """``build(start, length)`` for each run."""
    number = F.sequence(F.lit(0), F.size(starts) - 2)
    many = F.transform(number, lambda k: build(F.get(starts, k), F.get(starts, k + 1) - F.get(starts, k)))
    return F.when(F.size(starts) > 1, many)


def summary(docs: DataFrame, key: str, text: str, sentences: int = 2) -> DataFrame:
    """The sentences whose words are, on average, most frequent in their text, in text order.

    A sentence ends at ``.``, ``!``, ``?`` or a line break.  One row per text: a text without words
    has an empty summary, a NULL text a NULL one.  A text is summed up where it stands, without
    any shuffle: its words are sorted, runs of equal words give the frequencies, and sorted by
    sentence these give the weights.
    """
    cut = F.split(F.col(text), r"[.!?\n]+")
    placed = F.flatten(
        F.transform(F.transform("_cut", words), lambda ws, pos: F.transform(ws, lambda w: F.struct(w.alias("w"), pos.alias("pos"))))
    )

    def spread(start: Column, length: Column) -> Column:
        run = F.slice("_words", start + 1, length)
        return F.transform(run, lambda row: F.struct(row["pos"].alias("pos"), length.alias("n")))

    def weigh(start: Column, length: Column) -> Column:
        run = F.slice("_counts", start + 1, length)
        total = F.aggregate(run, F.lit(0).cast("bigint"), lambda sum_, row: sum_ + row["n"])
        return F.struct((-total / length).alias("weight"), F.get("_counts", start)["pos"].alias("pos"))

    steps = docs.select(key, cut.alias("_cut"))
    steps = steps.select(key, "_cut", F.sort_array(placed).alias("_words"))
    steps = steps.select(key, "_cut", "_words", _runs(F.col("_words"), lambda r: r["w"]).alias("_starts"))
    counts = F.sort_array(F.flatten(_over_runs(F.col("_starts"), spread)))
    steps = steps.select(key, "_cut", counts.alias("_counts"))
    steps = steps.select(key, "_cut", "_counts", _runs(F.col("_counts"), lambda r: r["pos"]).alias("_starts"))
    best = F.slice(F.sort_array(_over_runs(F.col("_starts"), weigh)), 1, sentences)
    picks = F.sort_array(F.transform(best, lambda r: r["pos"]))
    lines = F.array_join(F.transform(picks, lambda i: F.trim(F.get("_cut", i))), ". ")
    return steps.select(
        key, F.when(F.col("_cut").isNotNull(), F.coalesce(lines, F.lit(""))).alias("summary")
    )


def structured_answers(df: DataFrame, text: str) -> DataFrame:
    """First JSON object inside free text, parsed to six fields; all NULL when there is none."""
    found = F.regexp_extract(F.col(text), r"(\{[^{}]*\})", 1)
    return df.withColumn("_answer", F.from_json(found, ANSWER)).select(
        *[c for c in df.columns if c != text], "_answer.*"
    )
