import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from roadlark.llm import queries, trie

CONVERSATIONS = "conv_id long, turn long, role string, text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [r[2:] for r in sorted(t)] for c, t in own.items()}
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = own.get(c - (abs(c) % 20) * (1 if c >= 0 else -1), [])[:h] + turns[h:]
    members = {}
    for c, turns in whole.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {}
    for path in members:
        if path:
            children.setdefault(path[:-1], []).append(path)
    out = []
    for path, convs in members.items():
        below, stack = [], [path]
        while stack:
            node = stack.pop()
            below.append(node)
            stack += children.get(node, [])
        ends = sorted(c for c in convs if len(whole[c]) == len(path))
        saved = sum((len(members[n]) - 1) * len(WORD.findall(n[-1][1])) for n in below if n)
        digest = hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()
        parent = min(members[path[:-1]]) if path else None
        leaves = sum(n not in children for n in below)
        out.append((min(convs), len(path), parent, len(convs), len(children.get(path, [])), leaves, saved, digest))
    return sorted(out, key=repr)


def result(spark, rows, tmp_path, pieces=4):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(pieces)
    names = ("own", "head", "part", "place", "words", "d1", "depth", "size", "key", "_place")
    df.withColumns({n: F.lit("x") for n in names}).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in queries.op12_trie(spark, str(tmp_path)).collect()), key=repr)


def conversations(rng, count, most, first=-25):
    rows, talks = [], []
    for c in range(first, first + count):
        if rng.random() < 0.15:
            continue
        # Copies, common beginnings and fresh turns.
        old = rng.choice(talks) if talks and rng.random() < 0.7 else []
        talk = old[: rng.randint(0, len(old))] + [
            (rng.choice(["user", "assistant", None]), rng.choice(["", None, "a b", "one\ttwo  three", "é ½", "x"]))
            for _ in range(rng.randint(0, most) if rng.random() < 0.7 else 0)
        ]
        talks.append(talk)
        rows += [(c, t if t != 1 else rng.choice([1, 1, None]), *turn) for t, turn in enumerate(talk)]
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_equals_brute_force(spark, tmp_path, seed):
    rows = conversations(random.Random(seed), 160, 6)
    assert result(spark, rows, tmp_path) == brute(rows)


def test_forests_meet_across_boundaries(spark, tmp_path, monkeypatch):
    """Runs of three, one open node per task, blocks of two turns, ids in pieces of nine bytes."""
    monkeypatch.setattr(trie, "RUN", 3)
    monkeypatch.setattr(trie, "ITEMS", 1)
    monkeypatch.setattr(trie, "BLOCK", 2)
    monkeypatch.setattr(trie, "PIECE", 9)
    rng = random.Random(3)
    rows = conversations(rng, 120, 5)
    # A third of all turns in one conversation, a third of all conversations equal, repeated rows.
    rows += [(1000, t, "user", f"word {t}") for t in range(250)]
    rows += [(c, t, "user", "same old") for c in range(200, 260) for t in range(4)]
    rows += [(1003, 1, "user", "again")] * 40 + [(None, 1, "user", "nobody")] * 3 + [(1007, None, None, None)]
    assert result(spark, rows, tmp_path, 7) == brute(rows)


def test_nested_conversations(spark, tmp_path):
    """Each conversation goes on where the one before it ended."""
    rows = [(20 * c, t, "user", f"t{t}") for c in range(1, 30) for t in range(c)]
    assert result(spark, rows, tmp_path) == brute(rows)


def test_empty_and_turnless(spark, tmp_path):
    assert result(spark, [], tmp_path / "empty", 1) == []
    gone = next(c for c in range(1, 1000) if c % 20 and zlib.crc32(str(c).encode()) % 4 == 3)
    rows = [(gone, 0, "user", "a"), (gone, 1, "user", "b")]
    assert result(spark, rows, tmp_path / "gone", 1) == brute(rows)
    assert len(brute(rows)) == 1
