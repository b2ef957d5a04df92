import random

import numpy as np
import pytest

from roadlark.llm import quality

from .data import odd_cases, prose, table, with_clashing_columns

SENTENCE = "the of and to in a is that it was for on are as with they".split()


def good(seed):
    rng = random.Random(seed)
    words = prose(rng.randint(30, 150), seed).split()
    return " ".join(w if rng.random() < 0.6 else rng.choice(SENTENCE) for w in words) + "."


def corpus(count=400):
    """(doc_id, text), quality and toxicity by id."""
    rng, rows, kind = random.Random(5), [], {}
    for i in range(count):
        text, form, toxic = good(i), 1, 0
        if i % 8 == 1:
            words = text.split()
            form = 0
            text = [
                " ".join(w.upper() + "!!" for w in words),
                " ".join(w + rng.choice(["***", "%%%", "&&&"]) for w in words),
                " | ".join(words),
                " ".join(w for w in words[:20] for _ in range(7)),
            ][i // 8 % 4]
        elif i % 8 == 5:
            words, toxic = text.split(), 1
            for _ in range(4):
                words.insert(rng.randrange(len(words)), rng.choice(["idiot", "moron", "zufflestan", "zuffleron"]))
            text = " ".join(words)
        rows.append((i, text))
        kind[i] = (form, toxic)
    return rows, kind


def labels(spark, kind):
    return spark.createDataFrame([(i, q, t) for i, (q, t) in kind.items() if i % 3], "doc_id long, quality int, toxic int")


def test_keeps_clean_and_rejects_junk_and_abuse(spark):
    rows, kind = corpus()
    df = table(spark, rows)
    scored = {r.doc_id: r for r in quality.classify(df, labels(spark, kind)).collect()}
    clean = [scored[i].keep for i, k in kind.items() if k == (1, 0)]
    junk = [scored[i].keep for i, k in kind.items() if k[0] == 0]
    toxic = [scored[i].keep for i, k in kind.items() if k[1] == 1]
    assert np.mean(clean) > 0.98 and np.mean(junk) < 0.05 and np.mean(toxic) < 0.15
    # Unlabelled documents alone: what the labels teach carries over.
    held_out = [scored[i].keep for i, k in kind.items() if k[1] == 1 and i % 3 == 0]
    assert np.mean(held_out) < 0.25
    again = {r.doc_id: r.quality for r in quality.classify(df.repartition(5), labels(spark, kind)).collect()}
    assert all(again[i] == pytest.approx(scored[i].quality, abs=1e-6) for i in again)


def test_without_labels(spark):
    rows, kind = corpus(200)
    scored = {r.doc_id: r.keep for r in quality.classify(table(spark, rows)).collect()}
    assert np.mean([scored[i] for i, k in kind.items() if k == (1, 0)]) > 0.95
    assert np.mean([scored[i] for i, k in kind.items() if k[0] == 0]) < 0.1


def test_expectation_maximisation_finds_accuracies():
    rng = np.random.default_rng(1)
    truth = rng.random(20000) < 0.7
    accuracy = [0.95, 0.8, 0.7, 0.6]
    votes = np.stack([np.where(rng.random(20000) < a, truth, ~truth) for a in accuracy], axis=1).astype(int)
    votes[rng.random(votes.shape) < 0.2] = quality.NONE
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    posterior, found = quality.expectation_maximisation(patterns, counts.astype(float))
    said = found[:, 1, quality.GOOD] / (found[:, 1, quality.GOOD] + found[:, 1, quality.BAD])
    assert np.allclose(said, accuracy, atol=0.04)
    index = {tuple(p): x for p, x in zip(patterns.tolist(), posterior)}
    guess = np.array([index[tuple(v)] for v in votes.tolist()]) >= 0.5
    assert (guess == truth).mean() > 0.9


def test_odd_cases(spark):
    rows, kind = corpus(80)
    texts = odd_cases() + [(1000 + i, t) for i, t in rows]
    df = with_clashing_columns(table(spark, texts), ["quality", "keep", "form", "abuse", "toxic"])
    got = quality.classify(df, labels(spark, kind)).collect()
    assert len(got) == len(texts)
    silent = [r for r in got if not (r.text or "").strip()]
    assert len(silent) == 4 and not any(r.keep for r in silent)
    assert quality.classify(table(spark, []), labels(spark, kind)).collect() == []
