import numpy as np

from roadlark.llm import chunks

from .data import odd_cases, prose, table, with_clashing_columns


def test_cuts_move_along_with_the_text():
    text = prose(400, 1).encode()
    for extra in (b"", b"x", b"some words in front "):
        data = np.frombuffer(extra + text, np.uint8)
        start, end = chunks.cut(data, np.array([0, len(data)]))
        assert start[0] == 0 and end[-1] == len(data) and (start[1:] == end[:-1]).all()
        assert (end - start <= chunks.LONGEST).all()
        cuts = {int(e) - len(extra) for e in end}
        if extra:
            assert len(plain - cuts) <= 2
        else:
            plain = cuts


def test_other_texts_do_not_decide():
    a, b = prose(50, 2).encode(), prose(50, 3).encode()
    both = np.frombuffer(a + b, np.uint8)
    start, _ = chunks.cut(both, np.array([0, len(a), len(a) + len(b)]))
    alone, _ = chunks.cut(np.frombuffer(b, np.uint8), np.array([0, len(b)]))
    assert [s - len(a) for s in start if s >= len(a)] == alone.tolist()


def test_passages_are_found_and_clean_texts_left_alone(spark):
    passage = prose(70, 10)
    texts = [(i, prose(40, 100 + i) + " " + passage + " " + prose(40, 200 + i)) for i in range(40)]
    texts += [(i, prose(150, i)) for i in range(1000, 1100)]
    texts += [(i, prose(150, 5000)) for i in range(2000, 2030)]
    got = {r.doc_id: r for r in chunks.summary(table(spark, texts).repartition(5)).collect()}
    assert set(got) == set(range(40)) | set(range(2000, 2030))
    size = len(prose(150, 5000))
    assert all(got[i].n_repeated == size and got[i].n_removed == size for i in range(2001, 2030))
    # The first occurrence of each chunk stays.
    assert got[2000].n_removed == 0 and got[0].n_removed == 0
    assert all(0.6 * len(passage) < got[i].n_repeated <= len(passage) + 2 for i in range(40))


def test_runs_are_bytes_of_the_text(spark):
    texts = [(i, "é" * 40 + prose(60, 7) + str(i)) for i in range(5)]
    runs = chunks.repeated_runs(table(spark, texts)).collect()
    raw = {i: t.encode() for i, t in texts}
    parts = {raw[r.doc_id][r.start : r.start + r.size] for r in runs}
    assert len(runs) == 5 and len(parts) == 1 and prose(60, 7)[:200].encode() in parts.pop()


def test_odd_cases(spark):
    df = with_clashing_columns(table(spark, odd_cases()), ["n_spans", "start", "size", "first", "token", "variant"])
    got = {r.doc_id: (r.n_repeated, r.n_removed) for r in chunks.summary(df).collect()}
    size = len(prose(120, 2))
    # The repeated row counts once, so document 7 holds the first occurrence and 8 the copy.
    assert got == {7: (size, 0), 8: (size, size)}
    assert chunks.summary(table(spark, [])).collect() == []


def test_later_occurrences_are_removed_to_the_byte(spark):
    passage = prose(70, 10)
    texts = [(i, chr(65 + 2 * i) + prose(40, 100 + i) + chr(66 + 2 * i) + passage + chr(97 + i) + prose(40, 200 + i)) for i in range(10)]
    texts += [(i, prose(150, i)) for i in range(1000, 1020)] + [(None, passage), (30, None)]
    df = with_clashing_columns(table(spark, texts), ["kept", "key", "start", "later", "_key"])
    got = chunks.removed(df.repartition(5)).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(i) for i, _ in texts)
    for r in got:
        text = r.text or ""
        gone = len(passage) if r.doc_id in range(1, 10) else 0
        repeated = len(passage) if r.doc_id in range(10) else 0
        kept = text.replace(passage, "") if gone else text
        assert (r.n_bytes, r.n_repeated, r.n_removed, r.n_spans) == (len(text), repeated, gone, int(gone > 0)), r.doc_id
        assert bytes(r.kept).decode() == kept


def test_a_passage_counts_by_its_bytes_not_by_its_whole_chunks(spark):
    seed = 0
    while True:  # a passage whose whole chunks have less bytes than a run
        passage, seed = prose(30, seed)[:110], seed + 1
        a, b = (f"{x}{prose(30, 50 + i)}{x}{passage}{x}{prose(30, 60 + i)}" for i, x in enumerate("XY"))
        cuts = []
        for t in (a, b):
            start, end = chunks.cut(np.frombuffer(t.encode(), np.uint8), np.array([0, len(t)]))
            low = t.index(passage)
            cuts.append({(s - low, e - low) for s, e in zip(start.tolist(), end.tolist()) if low <= s and e <= low + 110})
        if 0 < sum(e - s for s, e in cuts[0] & cuts[1]) < 90 and cuts[0] == cuts[1]:
            break
    df = table(spark, [(1, a), (2, b)])
    assert chunks.summary(df).collect() == []
    got = {r.doc_id: (r.n_removed, bytes(r.kept).decode()) for r in chunks.removed(df).collect()}
    assert got == {1: (0, a), 2: (110, b.replace(passage, ""))}


def test_long_edges_are_compared_in_wider_steps(spark, monkeypatch):
    monkeypatch.setattr(chunks, "BESIDE", 2)
    passage = prose(50, 3)
    df = table(spark, [(1, "A" + passage + "B"), (2, "C" + passage + "D"), (2, "E"), (2, "C" + passage + "D")])
    got = sorted((r.doc_id, r.n_bytes, r.n_removed) for r in chunks.removed(df).collect())
    size = len(passage)
    assert got == [(1, size + 2, 0), (2, 1, 0), (2, size + 2, size), (2, size + 2, size)]
    assert chunks.removed(table(spark, [])).collect() == []
