import hashlib

import numpy as np
import pytest

from roadlark.llm import suffixes

from .data import odd_cases, prose, table, with_clashing_columns


def brute(texts, length):
    """(n_bytes, n_removed, n_spans, sha256) of each row, from all windows of all rows."""
    raws = [(t or "").encode() for _, t in texts]
    seen = {}
    for r in raws:
        for p in range(len(r) - length + 1):
            seen[r[p : p + length]] = seen.get(r[p : p + length], 0) + 1
    out = []
    for r in raws:
        gone = bytearray(len(r))
        for p in range(len(r) - length + 1):
            if seen[r[p : p + length]] > 1:
                gone[p : p + length] = b"\1" * length
        kept = bytes(b for b, g in zip(r, gone) if not g)
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(r), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def result(df, **options):
    found = suffixes.removed(df, **options).collect()
    return sorted(
        (r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(r.kept).hexdigest())
        for r in found
    )


def expected(texts, length):
    return sorted((i is None, i or 0, *b) for (i, _), b in zip(texts, brute(texts, length)))


def mixture():
    a, b, c = prose(80, 10), prose(80, 11), prose(60, 12)
    return [
        (0, a + b),
        (1, b + a),  # the same parts in other surroundings
        (2, prose(40, 13) + a[:90] + prose(40, 14)),
        (3, prose(20, 15) + a[50:180] + prose(10, 16)),
        (4, c + "|" + c),  # a repeat inside of one text
        (5, "ab" * 120),  # overlapping repeats
        (6, "é" * 70),
        (7, prose(90, 17)),
        (8, prose(90, 17)),
        (9, prose(90, 17)[1:]),
    ]


@pytest.mark.parametrize("length, spread", [(40, 12), (64, 20)])
def test_equals_brute_force(spark, length, spread):
    texts = mixture()
    got = result(table(spark, texts), length=length, spread=spread)
    assert got == expected(texts, length)


def test_very_many_contexts_are_counted_as_strings(spark, monkeypatch):
    monkeypatch.setattr(suffixes, "CONTEXTS", 1)
    texts = mixture()
    assert result(table(spark, texts), length=40, spread=12) == expected(texts, 40)


def test_odd_cases(spark):
    texts = [(i, t if t is None or len(t) < 3000 else t[:3000]) for i, t in odd_cases()]
    df = with_clashing_columns(table(spark, texts), ["n_bytes", "kept", "piece", "_doc", "start"])
    assert result(df, length=40, spread=12) == expected(texts, 40)


def test_long_edited_copies(spark):
    """Two texts of 600 KB, one byte in 450 changed: every context is a text's own."""
    text = prose(120_000, 30)[:600_000]
    edited = list(text)
    for i in range(100, len(edited), 450):
        edited[i] = "#"
    texts = [(1, text), (2, "".join(edited)), (3, prose(50, 31))]
    got = {r[1]: r[2:] for r in result(table(spark, texts))}
    # Between two edits 449 bytes agree, so all but the edits and the texts' ends repeat.
    places = len(range(100, len(edited), 450))
    last = (len(edited) - 1 - 100) % 450
    tail = last if last < 400 else 0
    for i in (1, 2):
        assert got[i][0] == len(text) and got[i][1] == len(text) - places - 100 - tail
        assert got[i][2] == places - (tail > 0)
    assert got[3][1] == 0


def test_many_rows_without_id(spark):
    rng = np.random.default_rng(3)
    common = prose(30, 40)
    texts = [(None, prose(12, 1000 + n) + (common if n % 3 == 0 else "") + prose(5, int(rng.integers(50)))) for n in range(300)]
    assert result(table(spark, texts), length=40, spread=12) == expected(texts, 40)


def test_empty_table(spark):
    assert suffixes.removed(table(spark, [])).collect() == []


def test_intervals_list_all_occurrences():
    contexts = [b"xabcdefg", b"yabcdefh", b"zabcdeqq"]
    found = list(suffixes.intervals(contexts, [b"", b"", b""], [4, 4, 4], 4))
    assert (6, [(0, 1), (1, 1)]) in found
    assert (5, [(0, 1), (1, 1), (2, 1)]) in found
    # bcde is preceded by the same byte everywhere, so it is no repeat of its own
    assert all(members[0][1] != 2 for _, members in found)


def test_places_behind_the_place_bits_are_anchored_alike(monkeypatch):
    repeat = prose(60, 20)
    texts = [prose(600, 21) + repeat + prose(30, 22), prose(30, 23) + repeat, prose(900, 24) + repeat]
    raws = [t.encode() for t in texts]
    data = np.frombuffer(b"".join(raws), np.uint8)
    offsets = np.cumsum([0, *map(len, raws)])
    want = suffixes.anchors(data, offsets, 64, 20)
    monkeypatch.setattr(suffixes, "_PLACE", 9)
    got = suffixes.anchors(data, offsets, 64, 20)
    assert all((g == w).all() and len(g) == len(w) for g, w in zip(got, want))
    # The repeat lies behind 512 bytes in two of the texts, and has the same contexts everywhere.
    contexts = [set(got[1][got[2] == i].tolist()) for i in range(3)]
    assert len(contexts[0] & contexts[1] & contexts[2]) >= 3
