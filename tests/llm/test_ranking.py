"""Ranked search against the written-out definition, with ties, nulls, repeats, long texts and empty tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from policylens.llm import ranking
from policylens.llm.common import stage
from policylens.llm.ranking import Best, Block, count_terms, ranked

DOCS, ITEMS = "doc_id long, text string, score string, rank int", "item_id long, text string, doc_id string"
TERM = re.compile(ranking.TERM_PATTERN)


def terms(text):
    return [re.sub("[A-Z]", lambda m: m[0].lower(), t) for t in TERM.findall(text or "")]


def defined(docs, items, k=50):
    bags = [(i, Counter(t), len(t)) for i, text, *_ in docs if (t := terms(text))]
    n_docs, total = len(bags), sum(n for *_, n in bags)
    df = Counter(t for _, bag, _ in bags for t in bag)
    wanted = {}
    for item, text, *_ in items:
        wanted.setdefault(item, set()).update(terms(text))
    out = []
    for item, own in wanted.items():
        found = []
        for doc, bag, n in bags:
            m = 100 - 50 + (50 * n * n_docs) // total
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                        * (1_000_000_000 * bag[t] // (1000 * bag[t] + 20 * m)) for t in own if bag[t])
            if score > 0:
                found.append((-score, doc is None, doc or 0))
        out += [(item, rank, None if null else doc, -s) for rank, (s, null, doc) in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def corpus():
    rnd = random.Random(12)
    vocabulary = [f"w{int(rnd.paretovariate(0.6))}" for _ in range(3000)] + ["Größe", "größe", "GRÖSSE", "x-y", "東京"]
    docs = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 60))), "s", 1) for i in range(900)]
    docs += [(i, None, None, None) for i in range(900, 905)] + [(905, "", "", 0), (906, " ,;- ", "", 0)]
    docs += [(None, docs[3][1], "n", 2), (None, docs[3][1], "n", 2), (7, docs[7][1], "t", 3)]
    docs += [(1000 + i, "w1 w2 rare copy", "c", 4) for i in range(400)]
    items = [(i, " ".join(rnd.choices(vocabulary, k=rnd.randrange(1, 30))), None) for i in range(25)]
    items += [(25, None, None), (26, "...", None), (27, "unheard of", None), (28, "W1 w2 RARE copy copy", None),
              (None, "größe", "x"), (3, "w5 w9", "again")]
    return docs, items


def frames(spark, docs, items):
    return (stage(spark.createDataFrame(docs, DOCS).repartition(6), "rank-docs"),
            stage(spark.createDataFrame(items, ITEMS), "rank-items"))


def rows(df):
    return sorted([tuple(r) for r in df.collect()], key=str)


@pytest.mark.parametrize("k,group_terms", [(50, ranking.GROUP_TERMS), (3, 40)])
def test_ranked_is_the_definition(spark, corpus, k, group_terms):
    got = ranked(*frames(spark, *corpus), k=k, group_terms=group_terms)
    assert dict(got.dtypes) == {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"}
    assert rows(got) == defined(*corpus, k=k)


def test_empty_tables(spark, corpus):
    docs, items = corpus
    assert ranked(*frames(spark, [], items)).count() == 0
    assert ranked(*frames(spark, docs, [])).count() == 0
    assert ranked(*frames(spark, docs, [(1, None, None)])).count() == 0


def test_long_texts_are_read_in_pieces(monkeypatch):
    rnd = random.Random(1)
    text = " ".join("".join(rnd.choices("aÄb", k=rnd.randrange(1, 40))) for _ in range(3000)) + "z" * 5000
    whole = Counter(terms(text))
    wanted = {t.encode(): i for i, t in enumerate(sorted(whole))}
    for piece in (7, 1000, 1 << 20):
        monkeypatch.setattr(ranking, "PIECE", piece)
        n, found, counts = count_terms(text, wanted)
        assert n == sum(whole.values()) and dict(zip(found, counts)) == {wanted[t.encode()]: c for t, c in whole.items()}


def block(rnd, n_docs, n_terms):
    lists = [sorted(rnd.sample(range(n_terms), rnd.randrange(0, 12))) for _ in range(n_docs)]
    columns = {"doc_id": pa.array([*range(n_docs - 1), None], pa.int64()), "n": pa.array([20 + len(x) for x in lists]),
               "terms": pa.array(lists, pa.list_(pa.int32())),
               "counts": pa.array([[rnd.randrange(1, 4) for _ in x] for x in lists], pa.list_(pa.int64()))}
    return Block([pa.RecordBatch.from_pydict(columns)], n_docs, 25 * n_docs, 50)


def test_accumulators_stop_and_the_best_are_the_same():
    rnd = random.Random(2)
    own = block(rnd, 500, 60)
    stopped = 0
    for _ in range(40):
        query = np.array(rnd.sample(range(70), 15))
        weights = np.sort(np.array([rnd.choice([900, 300, 30, 5, 1]) for _ in query]))[::-1]
        limited, every = Best(4), Best(500)
        makers = own.search(query, weights, limited)
        assert own.search(query, weights, every) >= makers
        stopped += makers < np.isin(query, own.terms).sum()
        for name in ("scores", "ids", "null"):
            assert getattr(limited, name).tolist() == getattr(every, name)[:4].tolist()
    assert stopped > 20
