"""Elias-Fano sequences against numpy; LM scores against a model written out with dictionaries."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from policylens.llm import lm
from policylens.llm.trie import EliasFano


@pytest.mark.parametrize("n,universe", [(0, 1), (0, 10**12), (1, 1), (1, 10**15), (5, 3), (3000, 10**9), (70_000, 80_000)])
def test_sequences(n, universe):
    rng = np.random.default_rng(n)
    values = np.sort(rng.integers(0, universe, n)).astype(np.uint64)
    ef = EliasFano.of(values, universe)
    assert (ef.at(np.arange(n)) == values).all()
    ask = np.concatenate([values, rng.integers(0, universe, 200).astype(np.uint64)])
    place, equal = ef.successor(ask)
    assert (place == np.searchsorted(values, ask)).all() and (equal == np.isin(ask, values)).all()


BEFORE, END = object(), object()


def tokens(text):
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", low), END]


def definition(rows):
    """The probability of a word after two, and the counts of the training words."""
    one, two, three, texts = Counter(), Counter(), Counter(), 0
    for _, text, held in rows:
        if not held:
            t = [BEFORE, *tokens(text)]
            texts += 1
            one.update(t[1:])
            two.update(zip(t, t[1:]))
            three.update(zip(t, t[1:], t[2:]))
    total, sorts = sum(one.values()), len(one)
    once, twice = (sum(c == k for c in one.values()) for k in (1, 2))
    d = once / (once + 2 * twice) if once and twice else 0.5

    def p1(w):
        if not total:
            return 1.0
        return (one[w] - d) / total if one[w] else d * sorts / total

    def p2(v, w):
        c = texts if v == BEFORE else one[v]
        return (two[v, w] + lm.PAIR_WEIGHT * p1(w)) / (c + lm.PAIR_WEIGHT) if c else p1(w)

    def p3(u, v, w):
        c = two[u, v]
        if u is None or c < lm.LEAST_CONTEXT:
            return p2(v, w)
        n = three[u, v, w] if two[v, w] >= lm.LEAST_CONTEXT else 0
        return (n + lm.TRIPLE_WEIGHT * p2(v, w)) / (c + lm.TRIPLE_WEIGHT)

    return p3, one


def written_out(rows):
    """Scores by the definition: (doc_id, n_tokens, n_known, N, base, score) per row."""
    p3, one = definition(rows)
    total, sorts = sum(one.values()), len(one)
    out = []
    for doc_id, text, _ in rows:
        t = [BEFORE, *tokens(text)]
        score = sum(math.log10(p3(t[i - 2] if i > 1 else None, t[i - 1], t[i])) for i in range(1, len(t)))
        base = sum(math.log10((one[w] + 1) / (total + sorts + 1)) for w in t[1:])
        out.append((doc_id, len(t) - 1, sum(one[w] > 0 for w in t[1:]), total, base, score))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, held_out boolean, group string")


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["The", "OF", "é", "<"]
    rows = []
    for i in range(300):
        text = " ".join(rnd.choice(vocabulary[:rnd.randint(2, 64)]) for _ in range(rnd.randint(0, 40)))
        rows.append((i, text, rnd.random() < 0.2))
    return [*rows, (300, None, False), (301, "", True), (None, "w1 w2 w3", True), (5, rows[5][1], True),
            (302, "never seen words", True)]


@pytest.mark.parametrize("group_words", [1, 700, 10**6])
def test_scores_are_the_definition(spark, corpus, group_words):
    got = lm.score(frame(spark, corpus).repartition(3), group_words).collect()
    want = sorted(written_out(corpus), key=str)
    assert len(got) == len(want)
    rows = sorted(((r["doc_id"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"])
                   for r in got), key=str)
    def key(r):
        return (str(r[0]), r[1], round(r[4], 6))
    for g, w in zip(sorted(rows, key=key), sorted(want, key=key), strict=True):
        assert g[:4] == w[:4]
        assert g[4] == pytest.approx(w[4], rel=1e-9)
        assert g[5] == pytest.approx(w[5], abs=5e-4 * w[1])       # a 16-bit step per factor


def test_probabilities_sum_to_at_most_one(corpus):
    """Over the known words, the end and the unknown word, after any context."""
    p, sorts = definition([r for r in corpus if not r[2]])
    for u, v in ((None, "w1"), ("w1", "w2"), (BEFORE, "w0"), ("w3", "w9")):
        assert 0.9 < sum(p(u, v, w) for w in [*sorts, "unknown word"]) < 1 + 1e-9


def uncut(rows):
    """The definition with every triple that occurs, however rare its pairs."""
    p3, one = definition(rows)
    learn = [[BEFORE, *tokens(text)] for _, text, held in rows if not held]
    two = Counter(g for t in learn for g in zip(t, t[1:]))
    three = Counter(g for t in learn for g in zip(t, t[1:], t[2:]))

    def p(u, v, w):
        shorter = p3(None, v, w)
        return (three[u, v, w] + lm.TRIPLE_WEIGHT * shorter) / (two[u, v] + lm.TRIPLE_WEIGHT) if two[u, v] else shorter

    return p, one


def test_a_passage_seen_once_has_its_triples(spark, corpus):
    passage = "one passage that is seen just once in training"
    rows = [*corpus, (900, passage, False), (901, passage, True)]
    p, _ = uncut(rows)
    t = [BEFORE, *tokens(passage)]
    want = sum(math.log10(p(t[i - 2] if i > 1 else None, t[i - 1], t[i])) for i in range(1, len(t)))
    for group_words in (1, 10**6):
        got = {r["doc_id"]: r["score"] for r in lm.score(frame(spark, rows).repartition(3), group_words).collect()}
        assert got[901] == pytest.approx(want, abs=5e-4 * len(t)) and got[900] == got[901]


def test_probabilities_sum_to_one(corpus):
    rows = [r for r in corpus if not r[2]]
    for p, sorts in (definition(rows), uncut(rows)):
        for u, v in ((None, "w1"), ("w1", "w2"), (BEFORE, "w0"), ("w3", "w9"), ("w50", "w61")):
            assert sum(p(u, v, w) for w in [*sorts, "unknown word"]) == pytest.approx(1, abs=1e-9)


def test_nothing_to_learn_from_and_no_rows(spark):
    none = lm.score(frame(spark, [(1, "a b", True), (2, None, True)])).collect()
    assert [(r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in
            sorted(none, key=lambda r: r["doc_id"])] == [(3, 0, 0, 0.0, 0.0), (1, 0, 0, 0.0, 0.0)]
    assert lm.score(frame(spark, [(1, "a", True)]).limit(0)).count() == 0
