import random

import numpy as np
import pyarrow as pa
import pytest

from roadlark.llm import decontaminate

from .data import odd_cases, prose, table, with_clashing_columns


def items(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def benchmark_rows(n=60):
    return [(i, f"{prose(20 + i % 15, 900 + i).capitalize()}. {prose(8, 1900 + i)}!") for i in range(n)]


def documents(rows):
    rng, out = random.Random(4), []
    for i, (item, text) in enumerate(rows[:30]):
        edited = text.split()
        edited[rng.randrange(len(edited))] = "changed"
        form = [text, text.upper(), " ".join(edited), text.replace(" ", "\n")][i % 4]
        out.append((i, prose(rng.randint(0, 200), i) + " " + form + " " + prose(rng.randint(0, 200), 50 + i)))
    return out, [(100 + i, prose(300, 300 + i)) for i in range(40)]


def test_leaks_are_found_and_clean_texts_left_alone(spark):
    rows = benchmark_rows()
    leaked, clean = documents(rows)
    df = table(spark, leaked + clean)
    found = decontaminate.contaminated(df, items(spark, rows)).collect()
    assert {(r.doc_id, r.item_id) for r in found} == {(i, i) for i in range(30)}
    texts = dict(leaked)
    for r in found:
        if r.doc_id % 4 == 0:
            part = texts[r.doc_id].lower().encode()[r.start : r.end].decode()
            assert r.score > 0.999 and rows[r.item_id][1].lower().rstrip("!") in part
    left = decontaminate.clean(df, items(spark, rows))
    assert {r.doc_id for r in left.collect()} == {i for i, _ in clean} and left.columns == df.columns


def test_question_and_answer_must_both_be_there(spark):
    question, answer = prose(30, 1), prose(12, 2)
    rows = [(1, f"{question}. {answer}")]
    df = table(spark, [(1, f"{question} {answer}"), (2, question + " " + prose(40, 3)), (3, answer)])
    assert [r.doc_id for r in decontaminate.contaminated(df, items(spark, rows), threshold=0.3).collect()] == [1]


def test_several_indexes_give_the_same(spark, monkeypatch):
    rows = benchmark_rows()
    leaked, clean = documents(rows)
    df, bench = table(spark, leaked + clean), items(spark, rows)
    once = sorted(tuple(r) for r in decontaminate.contaminated(df, bench).collect())
    monkeypatch.setattr(decontaminate, "INDEX_BYTES", 2000)
    # Passages are as long as an index's longest item, so places differ, not what is found.
    again = sorted(tuple(r) for r in decontaminate.contaminated(df, bench).collect())
    assert [r[:2] for r in again] == [r[:2] for r in once]


@pytest.mark.parametrize("threshold", [0.05, 0.2, 0.5])
def test_retrieval_equals_plain_scoring(threshold, monkeypatch):
    monkeypatch.setattr(decontaminate, "BLOCK", 16)
    rows = benchmark_rows()
    known, lengths = {}, []
    for _, t in rows:
        h = decontaminate.words(pa.array([t]))[0]
        lengths.append(len(h))
        for x in np.unique(h).view(np.int64).tolist():
            known[x] = known.get(x, 0) + 1
    index = decontaminate.build(rows, known, len(rows), float(np.mean(lengths)))
    rng = np.random.default_rng(0)
    passages = [np.sort(rng.choice(len(index.terms), 60, replace=False)) for _ in range(25)]
    weights = np.zeros((len(rows), len(index.terms)))
    for number, b in enumerate(index.blocks):
        for t in range(len(index.terms)):
            at = slice(b.cut[t], b.cut[t + 1])
            weights[number * 16 + b.item[at], t] = b.weight[at]
    assert np.allclose(weights.sum(axis=1), 1)
    want = {
        (p, k) for p, terms in enumerate(passages) for k, s in enumerate(weights[:, terms].sum(axis=1)) if s >= threshold
    }
    passage = np.repeat(np.arange(25), 60)
    got = decontaminate.retrieve(index, passage, np.concatenate(passages), 25, threshold)
    assert {(p, k) for p, k, _ in got} == want


def test_odd_cases(spark):
    rows = [(1, None), (2, ""), (3, "two words"), (None, prose(20, 1)), (4, prose(20, 9)), (4, prose(20, 9))]
    texts = odd_cases() + [(20, prose(20, 9)), (None, prose(20, 9))]
    df = with_clashing_columns(table(spark, texts), ["score", "item_id", "start", "question"])
    found = decontaminate.contaminated(df, items(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.item_id) for r in found) == [(False, 20, 4)] * 2 + [(True, 0, 4)] * 2
    kept = decontaminate.clean(df, items(spark, rows)).collect()
    assert len(kept) == len(texts) - 2  # the leak, with its id and without one
    assert decontaminate.contaminated(table(spark, []), items(spark, rows)).collect() == []
    assert decontaminate.contaminated(df, items(spark, [])).collect() == []


def test_short_items_match_as_they_are(spark):
    rows = [(1, "Capital of Peru? Lima!"), (2, "Blue whale"), (2, "blue  WHALE."), (3, "Lima"), (4, "...")]
    texts = [(1, "It asks: capital of Peru - Lima."), (2, "a blue, blue whale; the blue whale"), (3, "Capital of Lima Peru, whale blue")]
    texts += [(4, "blue"), (5, "whale"), (None, "Limas")]
    for extra in ([], benchmark_rows(20)):
        found = decontaminate.contaminated(table(spark, texts).coalesce(1), items(spark, rows + [(100 + i, t) for i, t in extra])).collect()
        assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (1, 3), (2, 2), (2, 2), (3, 3)]
        places = {(r.doc_id, r.item_id): texts[r.doc_id - 1][1][r.start : r.end] for r in found}
        assert places[1, 1] == "capital of Peru - Lima" and places[2, 2] == "blue whale"


def test_scripts_without_blanks(spark):
    question, answer = "\u6c34\u306e\u5316\u5b66\u5f0f\u306f\u4f55\u3067\u3059\u304b", "\u7b54\u3048\u306f\u9178\u7d20\u3068\u6c34\u7d20\u3067\u3059"
    thai = "\u0e40\u0e21\u0e37\u0e2d\u0e07\u0e2b\u0e25\u0e27\u0e07\u0e02\u0e2d\u0e07\u0e44\u0e17\u0e22"
    rows = [(1, f"{question}\uff1f{answer}\u3002"), (2, thai)]
    around = "\u79c1\u305f\u3061\u306f\u65e5\u672c\u8a9e\u3092\u5b66\u3073\u307e\u3059"
    texts = [(1, f"{around}{question}\u3001{answer}{around}"), (2, "abc" + thai + "\u0e04\u0e37\u0e2d"), (3, around * 3)]
    found = decontaminate.contaminated(table(spark, texts), items(spark, rows)).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(1, 1), (2, 2)]


def test_words_by_unicode_classes():
    texts = pa.array(["na\u00efve\u2014caf\u00e9 \u65e5\u672cx \U00020000\u3002\ud55c\uad6d", "\u00ab\u044f\u00bb", None, "a"])
    _, text, start, end = decontaminate.words(texts)
    found = [(int(t), texts[t].as_py().encode()[a:b].decode()) for t, a, b in zip(text, start, end)]
    first = ["na\u00efve", "caf\u00e9", "\u65e5", "\u672c", "x", "\U00020000", "\ud55c\uad6d"]
    assert found == [(0, w) for w in first] + [(1, "\u044f"), (3, "a")]


def test_rows_are_judged_one_by_one(spark):
    """A leak without an id goes; a clean row that shares its id with a leak stays."""
    rows = benchmark_rows()
    leaked, clean = documents(rows)
    (leak, bad), (_, good) = leaked[0], clean[0]
    df = table(spark, [(None, bad), (leak, bad), (leak, good), (None, good)])
    left = decontaminate.clean(df, items(spark, rows)).collect()
    assert sorted((r.doc_id is None, r.text == good) for r in left) == [(False, True), (True, True)]


def test_a_task_gives_freed_memory_back():
    """In a process of its own: small blocks below one that stays are kept by the allocator."""
    import subprocess
    import sys

    code = """
import numpy as np
from roadlark.llm.common import tidy

def held():
    return int(open("/proc/self/statm").read().split()[1]) * 4096 >> 20

def run(batches):
    blocks = [np.ones(1000) for _ in range(40000)]
    last = blocks[-1]
    del blocks
    yield held(), last

peak, last = next(run([]))
(inside, last), = tidy(run)([])
print(peak, held())
"""
    root = __file__.rsplit("/tests/", 1)[0]
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True)
    before, after = map(int, out.stdout.split())
    assert before - after > 100
