import hashlib
import random
import re
import zlib
from itertools import product

import pytest
from pyspark.sql import functions as F

from roadlark.llm import queries, repair

CONVERSATIONS = "conv_id long, turn long, role string, text string"
BARE = re.compile(r"[^\x20\x09-\x0D]")
LEGAL = re.compile(r"(s?(ua)+)?")


def damaged(rows):
    """conv_id -> turns (turn, role, text) in order, by the contract."""
    out = {}
    for conv, turn, role, text in rows:
        kept = out.setdefault(conv, [])
        role, text = " " if role is None else role, " " if text is None else text
        draw = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if draw == 0:
            continue
        text = "" if draw == 1 else re.sub("[.!?]", "", text) if draw == 2 else text
        row = (turn, "user" if draw == 4 else role, text)
        kept += [row, row] if draw == 3 else [row]
    for kept in out.values():
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2][:64], hashlib.md5(r[2].encode()).digest()))
    return out


def faults(rows):
    seen, out = set(), []
    for _, role, text in rows:
        found = BARE.findall(text)
        if not found:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("" if found[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def cheapest(rows, kinds):
    """Best (cost, audit, lines) of each emitted role string's automaton state, turn by turn."""
    step = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    def insert(best):
        for _ in range(3):
            for q, (cost, audit, said) in list(best.items()):
                for r, role in (("u", "user:"), ("a", "assistant:")):
                    if (q, r) in step:
                        to = step[q, r]
                        best[to] = min(best.get(to, (1 << 60,)), (cost + 3, audit + "I", (*said, role)))
        return best

    best = {"0": (0, "", ())}
    for (_, role, text), kind in zip(rows, kinds, strict=True):
        after = {}

        def offer(to, *what, after=after):
            after[to] = min(after.get(to, (1 << 60,)), what)

        for q, (cost, audit, said) in insert(best).items():
            offer(q, cost + 4, audit + "D", said)
            if kind in ("blank", "duplicate"):
                continue
            more = 3 if kind else 0
            if role and (q, role[0]) in step:
                offer(step[q, role[0]], cost + more, audit + "K", (*said, f"{role}:{text}"))
            for r, name in (("u", "user"), ("a", "assistant")):
                if (q, r) in step:
                    offer(step[q, r], cost + 3 + more, audit + "R", (*said, f"{name}:{text}"))
        best = after
    return min(v for q, v in insert(best).items() if q in "0a")


def brute(rows):
    out = []
    for conv, kept in damaged(rows).items():
        kinds, turns = faults(kept), [r[0] for r in kept if r[0] is not None]
        cost, audit, said = cheapest(kept, kinds)
        initials = [r[1][:1] for r in kept]
        illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        counts = [kinds.count(k) for k in ("blank", "duplicate", "truncated")]
        out.append((conv, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(said).encode()).hexdigest()))
    return sorted(out, key=repr)


def result(spark, rows, tmp_path, pieces=4):
    df = spark.createDataFrame(rows, CONVERSATIONS).repartition(pieces)
    names = ("live", "part", "seg", "same", "cost", "_draw", "_place", "_head")
    df.withColumns({n: F.lit("x") for n in names}).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    return sorted((tuple(r) for r in queries.op11_repair(spark, str(tmp_path)).collect()), key=repr)


def conversations(rng, count, most):
    rows = []
    for c in range(count):
        for t in range(rng.randint(0, most)):
            role = rng.choice(["user", "assistant", "assistant", "user", "system", "tool", "", None, "u", "Sam"])
            text = rng.choice(["Yes.", "No", "a b!", "", None, " \t", "é?\n", f"{rng.random()}.", f"{rng.random()}"])
            rows.append((c - 3, rng.choice([t, t, t, t + 5, None]), role, text))
    return rows


def test_equals_brute_force(spark, tmp_path):
    rows = conversations(random.Random(1), 150, 12)
    assert result(spark, rows, tmp_path) == brute(rows)


def test_cut_conversations(spark, tmp_path, monkeypatch):
    """One conversation has a third of all rows, another repeats one row, and no piece is large."""
    monkeypatch.setattr(repair, "CUT_ROWS", 5)
    rng = random.Random(2)
    rows = conversations(rng, 40, 9)
    rows += [(7, t, rng.choice(["user", "assistant"]), rng.choice(["Hm.", "So", f"{t}!"])) for t in range(300)]
    rows += [(8, 1, "user", "Again.")] * 60 + [(None, 3, "user", "x."), (None, None, None, None)]
    assert result(spark, rows, tmp_path, 7) == brute(rows)


def test_empty_and_dropped(spark, tmp_path):
    assert result(spark, [], tmp_path / "empty", 1) == []
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert result(spark, [(gone, 0, "user", "Hi.")], tmp_path / "gone", 1) == [(gone, 0, 0, 0, 0, 0, 0, "", nothing)]


def test_every_short_sequence():
    """The cheapest edits against all edit strings that need no more than the best cost."""
    rng = random.Random(5)
    for _ in range(150):
        rows = [(i, rng.choice(["system", "user", "assistant", "tool"]), rng.choice(["A.", "b", f"{i}."])) for i in range(3)]
        kinds = faults(rows)
        found = []
        for audit in (a for n in range(7) for a in product("DIKR", repeat=n)):
            if sum(e != "I" for e in audit) != len(rows):
                continue
            for roles in product("ua", repeat=sum(e in "IR" for e in audit)):
                cost, said, i, new = 0, "", 0, iter(roles)
                for e in audit:
                    if e == "I":
                        cost, said = cost + 3, said + next(new)
                        continue
                    if e == "D":
                        cost += 4
                    else:
                        cost += (3 if e == "R" else 0) + (3 if kinds[i] == "truncated" else 0)
                        cost += 1000 if kinds[i] in ("blank", "duplicate") else 0
                        said += next(new) if e == "R" else rows[i][1][0]
                    i += 1
                if LEGAL.fullmatch(said):
                    found.append((cost, "".join(audit)))
        best = min(found)
        got = repair.settle(1, repair.Turns(*map(list, zip(*rows, strict=True))))
        assert (got["cost"], got["audit"]) == best


@pytest.mark.parametrize("n", [1, 2, 63, 1000, 4097])
def test_long_runs(n):
    rows = repair.Turns(list(range(n)), ["user"] * n, [f"{i}." for i in range(n)])
    kept = [(i, "user", f"{i}.") for i in range(n)]
    cost, audit, said = cheapest(kept, [""] * n)
    got = repair.settle(1, rows)
    assert (got["cost"], got["audit"]) == (cost, audit)
    assert tuple(f"{r}:{t}" for r, t in zip(got["roles"], got["texts"], strict=True)) == said
