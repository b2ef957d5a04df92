import re

import pytest
from pyspark.sql import functions as F

from roadlark.llm import mixing

from .data import odd_cases, prose, table, with_clashing_columns


def targets(sizes, share=1.5, limit=2.0):
    """Targets by weight with the excess shared again until none is above, in plain steps."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    total, fixed = share * sum(sizes.values()), {}
    while True:
        rest = [s for s in names if s not in fixed]
        open_ = sum(weight[s] for s in rest)
        level = (total - sum(fixed.values())) / open_ if open_ else 0
        over = [s for s in rest if level * weight[s] >= limit * sizes[s]]
        if not over:
            return {**fixed, **{s: level * weight[s] for s in rest}}
        fixed |= {s: limit * sizes[s] for s in over}


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def source_table(spark, count=400):
    rows = [
        (i, prose(5 + i % 40, i), "en", [None, "b", "a", "é", "Z", "zz", "c"][(i * i) % 7], 0) for i in range(count)
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")


def test_targets_and_copies(spark):
    df = source_table(spark)
    rows = mixing.mix(df).collect()
    sizes = {}
    for r in rows:
        assert r.size == size(r.text)
        sizes[r.source] = sizes.get(r.source, 0) + r.size
    want = targets(sizes)
    taken = dict.fromkeys(sizes, 0)
    for r in rows:
        assert r.source_size == sizes[r.source]
        assert r.target == pytest.approx(want[r.source])
        rate = r.target / r.source_size
        assert r.copies in (int(rate), int(rate) + 1) and r.taken == r.copies * r.size <= 2 * r.size
        taken[r.source] += r.taken
    for s in sizes:
        assert taken[s] == pytest.approx(want[s], rel=0.35)
    assert sum(want.values()) == pytest.approx(1.5 * sum(sizes.values()))


def test_reruns_agree_and_draws_follow_the_fraction(spark):
    df = source_table(spark)
    once = sorted((r.doc_id, r.copies) for r in mixing.mix(df).collect())
    assert once == sorted((r.doc_id, r.copies) for r in mixing.mix(df.repartition(7)).collect())
    draws = spark.range(20000).select(F.avg((mixing.draw(F.col("id"), 7) < 0.3).cast("int"))).first()[0]
    assert draws == pytest.approx(0.3, abs=0.02)


def test_emitted(spark):
    mixed = mixing.mix(source_table(spark, 60))
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    out = mixing.emitted(mixed).collect()
    assert {i: sum(r.doc_id == i for r in out) for i in copies} == copies


def test_odd_cases(spark):
    df = with_clashing_columns(table(spark, odd_cases()), ["size", "target", "copies", "_source", "weight"])
    rows = mixing.mix(df).collect()
    assert sorted(r.size for r in rows) == sorted(size(t) for _, t in odd_cases())
    assert all(r.copies is not None and r.taken == r.copies * r.size for r in rows)


def test_nothing_to_mix(spark):
    assert mixing.mix(table(spark, [])).collect() == []
    rows = mixing.mix(table(spark, [(1, None), (2, " ")])).collect()
    assert [(r.size, r.copies, r.target) for r in rows] == [(0, 0, 0.0), (0, 0, 0.0)]
