import random

import numpy as np
import pytest

from roadlark.llm import ngram_join
from roadlark.llm.components import components
from roadlark.llm.common import Scratch

from .data import odd_cases, prose, table, with_clashing_columns

FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def shingles(text, width=5):
    words = [w for w in (text or "").translate(FOLD).translate({c: " " for c in range(9, 14)}).split(" ") if w]
    if len(words) < width:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(texts, percent=75):
    sets = [(i, shingles(t)) for i, t in texts]
    root = {i: i for i, _ in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if i is None or j is None or not a or not b:
                continue
            if 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((find(i), find(j)))
                root[y] = x
    return sorted(
        (i is None, i or 0, len(s), -1 if i is None else find(i)) for i, s in sets
    )


def result(df, **options):
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_shingles, -1 if r.component_id is None else r.component_id)
        for r in ngram_join.near_duplicates(df, **options).collect()
    )


def edited(text, changes, rng):
    words = text.split(" ")
    for _ in range(changes):
        words[rng.randrange(len(words))] = "x" + str(rng.randrange(10**6))
    return " ".join(words)


def copies():
    """Near copies around the threshold, in a large group and in pairs, and unrelated texts."""
    rng, texts = random.Random(3), []
    base = prose(90, 100)
    for _ in range(70):
        texts.append(edited(base, rng.randint(0, 6), rng))
    for k in range(25):
        text = prose(rng.randint(3, 60), 200 + k)
        texts += [text, edited(text, rng.randint(0, 3), rng), text.upper()]
        texts.append(text + " " + prose(rng.randint(1, 15), 300 + k))
    passage = prose(30, 400)
    texts += [passage + " " + prose(rng.randint(5, 30), 500 + k) for k in range(30)]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("often, widest", [(64, 256), (2, 4)])
def test_equals_brute_force(spark, monkeypatch, often, widest):
    # Few sets make a token frequent in the second case, so combinations are in use.
    monkeypatch.setattr(ngram_join, "WIDEST", widest)
    monkeypatch.setattr(ngram_join.signature_keys, "__defaults__", (often,))
    texts = copies()
    assert result(table(spark, texts)) == brute(texts)


def test_similar_sets_share_a_signature():
    rng = np.random.default_rng(1)
    for _ in range(300):
        n = int(rng.integers(1, 120))
        x = np.unique(rng.integers(0, 2**63, n).astype(np.uint64))
        y = x[rng.random(len(x)) < rng.uniform(0.7, 1)]
        y = np.unique(np.append(y, rng.integers(0, 2**63, int(rng.integers(0, n // 6 + 1))).astype(np.uint64)))
        both = len(np.intersect1d(x, y))
        if 100 * both < 75 * (len(x) + len(y) - both):
            continue
        often = int(rng.integers(1, 6))
        counts = {int(t): int(rng.integers(2, 10)) for t in np.union1d(x, y)}
        keys = []
        for s in sorted((x, y), key=len):
            known = np.array([counts[int(t)] for t in s])
            keys.append(ngram_join.signature_keys(s, known, 75, often))
        # The smaller set is found under its own keys by all keys of the larger one.
        assert len(np.intersect1d(keys[0][0], np.concatenate(keys[1])))


def test_odd_cases(spark):
    df = table(spark, odd_cases())
    df = with_clashing_columns(df, ["n_shingles", "component_id", "sid", "n", "id", "tokens"])
    assert result(df) == brute(odd_cases())


def test_empty_table(spark):
    assert ngram_join.near_duplicates(table(spark, [])).collect() == []


def test_representatives_keep_one_of_each_group(spark):
    texts = copies()
    df = table(spark, texts)
    groups = {i: c for _, i, _, c in brute(texts)}
    kept = {r.doc_id for r in ngram_join.representatives(df).collect()}
    assert kept == set(groups.values())
    odd = ngram_join.representatives(table(spark, odd_cases()))
    assert odd.columns == df.columns
    ids = sorted((r.doc_id is None, r.doc_id or 0) for r in odd.collect())
    assert ids == [(False, i) for i in (1, 2, 3, 4, 5, 6, 7, 9, 10)] + [(True, 0), (True, 0)]


def test_components(spark):
    rng = random.Random(5)
    links = [(rng.randrange(60), rng.randrange(60)) for _ in range(45)] + [(100 + i, 101 + i) for i in range(30)]
    root = {x: x for pair in links for x in pair}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    found = components(spark.createDataFrame(links, "a long, b long"), Scratch(spark, "test"))
    assert {r.node: r.root for r in found.collect()} == {x: find(x) for x in root if find(x) != x}


def shuffled(df, metric):
    """The sum of a metric over all exchanges that ``df`` runs."""
    df.collect()

    def walk(plan):
        if "AdaptiveSparkPlan" in plan.nodeName():
            plan = plan.executedPlan()
        while "QueryStage" in plan.nodeName():
            plan = plan.plan()
        total = plan.metrics().apply(metric).value() if plan.nodeName() == "Exchange" else 0
        below = plan.children()
        return total + sum(walk(below.apply(k)) for k in range(below.size()))

    return walk(df._jdf.queryExecution().executedPlan())


def test_tokens_of_sets_without_pairs_are_not_shuffled(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        rows = [(i, bytearray(np.arange(100 * i, 100 * i + 8, dtype="u8").tobytes())) for i in range(400)]
        rows += [(400, rows[7][1])]
        sets = spark.createDataFrame(rows, "id long, tokens binary")
        found = ngram_join.verified(spark.createDataFrame([(7, 400), (8, 9)], "a long, b long"), sets, 75)
        assert [tuple(r) for r in found.collect()] == [(7, 400)]
        assert shuffled(found, "shuffleRecordsWritten") < 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sets_that_the_filter_lets_pass_by_mistake_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "may_hold", lambda bits, ids: np.ones(len(ids), bool))
    texts = copies()
    assert result(table(spark, texts)) == brute(texts)
