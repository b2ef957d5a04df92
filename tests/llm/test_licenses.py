import random

import pytest

from roadlark.llm import licenses

from .data import odd_cases, prose, table, with_clashing_columns


def test_increasing_is_longest():
    rng = random.Random(1)
    for _ in range(200):
        values = rng.sample(range(50), rng.randint(0, 12))
        got = [values[i] for i in licenses.increasing(values)]
        assert got == sorted(got)
        best = [1] * len(values)
        for i in range(len(values)):
            best[i] = 1 + max((best[j] for j in range(i) if values[j] < values[i]), default=0)
        assert len(got) == max(best, default=0)


def test_alignment_is_ordered_and_complete_where_it_can_be():
    assert licenses.aligned([1, 2, 3, 4], [1, 2, 3, 4]) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    # 7 is unique; the repeated words around it are aligned inside the gaps.
    assert licenses.aligned([9, 1, 1, 7, 2, 2, 8], [1, 1, 7, 2, 2]) == [(1, 0), (2, 1), (3, 2), (4, 3), (5, 4)]
    assert licenses.aligned([], [1]) == [] == licenses.aligned([1, 1], [2, 2])


@pytest.mark.parametrize("name, wording", licenses.TEMPLATES)
def test_every_wording_is_found_in_any_form(name, wording):
    import pyarrow as pa

    known = licenses.prepared(licenses.TEMPLATES)
    lines = wording.replace(", ", ",\n * ").upper()
    text = prose(200, 1) + "\n" + lines + "\n" + prose(200, 2)
    found = list(licenses.found_in(known, pa.array([prose(50, 3), text]), 0.85, 0.5))
    assert [r[:2] for r in found] == [(1, name)]
    low, high = found[0][3:5]
    raw = text.lower().encode()[low:high].decode()
    assert raw.split()[0] == wording.lower().split()[0].strip("\"(,.")


def test_several_notices_and_clean_texts(spark):
    mit, apache = "Released under the MIT License.", "Licensed under the Apache License, Version 2.0."
    mentions = "The license of the garden is under the law, and the version of it is free as published."
    texts = [(1, f"{mit} {prose(30, 1)} {apache} {mit}"), (2, prose(300, 2)), (3, mentions), (4, apache.lower())]
    got = sorted((r.doc_id, r.license) for r in licenses.scan(table(spark, texts)).collect())
    assert got == [(1, "Apache-2.0"), (1, "MIT"), (1, "MIT"), (4, "Apache-2.0")]


def test_edited_wording_is_covered_in_part(spark):
    words = licenses.TEMPLATES[2][1].split()
    rng = random.Random(2)
    for i in rng.sample(range(len(words)), 8):
        words[i] = "changed"
    df = table(spark, [(1, prose(40, 1) + " " + " ".join(words) + " " + prose(40, 2))])
    row = licenses.scan(df).collect()[0]
    assert row.license == "MIT" and 0.85 <= row.coverage < 1
    assert licenses.scan(df, coverage=0.999).collect() == []


def test_odd_cases(spark):
    long = prose(20000, 5) + " Released under the MIT License. " + prose(20000, 6)
    texts = odd_cases() + [(30, long), (30, long), (None, "released under the mit license")]
    df = with_clashing_columns(table(spark, texts), ["license", "coverage", "start", "words"])
    got = licenses.scan(df).collect()
    assert sorted((r.doc_id or 0, r.license) for r in got) == [(0, "MIT"), (30, "MIT"), (30, "MIT")]
    assert licenses.scan(table(spark, [])).collect() == []
