import math
import random

import pytest

from roadlark.llm import topk


def vectors(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def brute(rows, k, every):
    valid = [
        (i, [math.floor(64 * x) for x in v])
        for i, v, _ in rows
        if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)
    ]
    out = []
    for q, a in valid:
        if q % every:
            continue
        scores = [(-sum(x * y for x, y in zip(a, b)), i) for i, b in valid if i != q and len(a) == len(b)]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(out)


def result(df, k, every):
    return sorted(tuple(r) for r in topk.top_k(df, f"vec_id % {every} = 0", k).collect())


@pytest.mark.parametrize("dimension", [1, 7, 40])
def test_equals_brute_force(spark, monkeypatch, dimension):
    monkeypatch.setattr(topk, "CANDIDATES", 50)
    monkeypatch.setattr(topk, "QUERIES", 7)
    rng = random.Random(dimension)
    # Few different values: many ties.
    rows = [(i, [float(rng.randint(-2, 2)) / 4 for _ in range(dimension)], 0) for i in range(230)]
    assert result(vectors(spark, rows).repartition(3), 6, 10) == brute(rows, 6, 10)


def test_skewed_lengths_prune_and_stay_exact(spark):
    rng = random.Random(2)
    rows = [(i, [rng.gauss(0, 1) * (10 if i % 50 == 0 else 0.1) for _ in range(33)], 0) for i in range(300)]
    rows = [(i, [float(f"{x:.3f}") for x in v], n) for i, v, n in rows]
    import numpy as np

    rows = [(i, [float(np.float32(x)) for x in v], n) for i, v, n in rows]
    assert result(vectors(spark, rows), 5, 20) == brute(rows, 5, 20)


def test_odd_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (0, [1.0, 0.5], 0),
        (1, [1.0, 0.5], 0),
        (2, None, 0),
        (3, [1.0, None], 0),
        (4, [nan, 1.0], 0),
        (5, [1.0, inf], 0),
        (6, [1.0], 0),
        (7, [], 0),
        (20, [], 0),
        (None, [1.0, 1.0], 0),
        (40, None, 0),
        (8, [-0.01, 0.999], 0),
    ]
    df = vectors(spark, rows).selectExpr("*", "'x' AS score", "'x' AS rank", "0 AS d", "'x' AS query_id")
    assert result(df, 3, 20) == brute(rows, 3, 20)
    assert result(vectors(spark, []), 3, 20) == []


def test_repeated_rows_are_candidates_of_their_own(spark):
    rows = [(0, [1.0], 0), (5, [1.0], 0), (5, [1.0], 0)]
    assert result(vectors(spark, rows), 5, 20) == [(0, 1, 5, 4096), (0, 2, 5, 4096)]


def test_large_finite_components(spark):
    """Components beyond 32 bits are scored exactly; only scores beyond a long are an error."""
    rng = random.Random(9)
    rows = [(i, [float(rng.randint(-3, 3)), rng.random(), 0.0], 0) for i in range(60)]
    rows += [(60, [5e8, 1.0, 0.0], 0), (61, [0.5, 2.0**40 + 0.25, 0.0], 0), (62, [-1e9, 1e9, 1e30], 0), (64, [1.0, 1.0, 0.0], 0)]
    assert result(vectors(spark, rows).selectExpr("vec_id", "cast(embedding AS array<double>) AS embedding"), 5, 4) == brute(
        [(i, list(map(float, v)), x) for i, v, x in as_floats(rows)], 5, 4
    )
    huge = vectors(spark, [(0, [3e18], 0), (1, [5.0], 0)])
    with pytest.raises(Exception, match="does not fit a long"):
        result(huge, 5, 20)


def as_floats(rows):
    """The values as they are after a stay in a column of 32-bit floats."""
    import numpy as np

    return [(i, [float(np.float32(x)) for x in v], n) for i, v, n in rows]
