"""Exact dedup, components and near dedup against brute force, with nulls, ties, repeats and empty tables."""

import glob
import random
import re
import time
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from policylens.llm import components as component_module
from policylens.llm import near_dedup
from policylens.llm.common import LEAST_TASKS, prefix_sums, recorded, stage
from policylens.llm.components import components
from policylens.llm.exact_dedup import DigestIndex, exact_duplicates, without_copies
from policylens.llm.near_dedup import block_links, near_duplicates, without_near_copies
from policylens.session import scratch_path

SCHEMA = "doc_id long, text string, digest string, row_text string"


def lower_az(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(4)
    texts = ["Ünï Text", "ünï text", "ÜNÏ TEXT", "", None, " ", "a b", "A B", "a  b"] + [f"t{i % 40}" for i in range(400)]
    texts += ["hot copy"] * 300
    out = [(i, t, None, "x") for i, t in enumerate(texts)]
    rnd.shuffle(out)
    return [*out, out[0], (None, "hot copy", "y", None), (None, "alone without id", None, None)]


def frame(spark, rows):
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(4), "dedup-test")


def test_exact_duplicates(spark, rows):
    groups = defaultdict(list)
    for i, text, *_ in rows:
        groups[lower_az(text)].append(i)
    got = exact_duplicates(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    by_digest = defaultdict(list)
    for r in got:
        by_digest[bytes(r["digest"])].append(r)
    assert sorted(Counter(r["doc_id"] for r in g).items().__len__() for g in by_digest.values()) == sorted(
        len(set(g)) for g in groups.values())
    for g in by_digest.values():
        ids = [r["doc_id"] for r in g]
        largest = max((i for i in ids if i is not None), default=None)
        assert {r["keep_id"] for r in g} == {largest} and {r["group_size"] for r in g} == {len(g)}
        assert sum(r["kept"] for r in g) == 1 and all(r["doc_id"] == largest for r in g if r["kept"])


def test_the_index_persists_and_grows(spark, rows):
    path = scratch_path(spark, "persistent-index")
    first, second = rows[: len(rows) // 2], rows[len(rows) // 2:]
    a = without_copies(frame(spark, first), DigestIndex(spark, path, 4)).collect()
    b = without_copies(frame(spark, second), DigestIndex(spark, path, 4)).collect()     # opened again by path
    assert Counter(lower_az(r["text"]) for r in [*a, *b]) == Counter({lower_az(r[1]) for r in rows})
    again = DigestIndex(spark, path, 4)
    assert again.rows().count() == len({lower_az(r[1]) for r in rows})
    assert without_copies(frame(spark, rows), again).count() == 0
    plan = again.rows().join(again.rows().hint("merge").withColumnRenamed("keep_id", "k"), "digest")
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()


def test_a_lost_run_is_run_again(spark, rows):
    path = scratch_path(spark, "rerun-index")
    first, second = rows[: len(rows) // 2], rows[len(rows) // 2:]
    without_copies(frame(spark, first), DigestIndex(spark, path, 4), "monday").collect()
    lost = exact_duplicates(frame(spark, second), DigestIndex(spark, path, 4), "tuesday")      # never written
    held = DigestIndex(spark, path, 4).rows().count()
    again = exact_duplicates(frame(spark, second), DigestIndex(spark, path, 4), "tuesday")
    of = [(r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"])) for r in again.collect()]
    assert Counter(of) == Counter((r["doc_id"], r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]))
                                  for r in lost.collect())
    assert sum(o[3] for o in of) == len({lower_az(r[1]) for r in second} - {lower_az(r[1]) for r in first})
    assert DigestIndex(spark, path, 4).rows().count() == held                 # nothing is appended twice
    # the same rows under another name are copies
    assert without_copies(frame(spark, second), DigestIndex(spark, path, 4), "wednesday").count() == 0


def test_a_run_lost_while_it_appended(spark, rows):
    whole = exact_duplicates(frame(spark, rows), DigestIndex(spark, buckets=4), "b")
    index = DigestIndex(spark, buckets=4)
    half = whole.where("kept").where(F.pmod(F.xxhash64("digest"), F.lit(2)) == 0)
    index._write(half.select("digest", "keep_id", F.lit("b").alias("batch")), index.table, index.path, "append")
    columns = ["doc_id", "keep_id", "group_size", "kept", "digest"]
    again = exact_duplicates(frame(spark, rows), index, "b").select(columns)
    assert again.exceptAll(whole.select(columns)).count() == 0 and again.count() == len(rows)
    assert index.rows().count() == index.rows().select("digest").distinct().count() == whole.where("kept").count()


def test_joins_with_the_index_move_nothing(spark, rows, monkeypatch):
    plans, older = [], DigestIndex.older

    def seen(self, groups, batch):
        plans.append(older(self, groups, batch)._jdf.queryExecution().executedPlan().toString())
        return older(self, groups, batch)

    monkeypatch.setattr(DigestIndex, "older", seen)
    exact_duplicates(frame(spark, rows), DigestIndex(spark, buckets=4))
    assert "SortMergeJoin" in plans[0] and "Exchange" not in plans[0]


def test_very_long_texts_are_compared_whole(spark):
    long = "Word " * 400_000
    docs = frame(spark, [(1, long, None, None), (2, long.lower(), None, None), (3, long + "x", None, None)])
    assert sorted((r["doc_id"], r["keep_id"], r["kept"]) for r in exact_duplicates(docs).collect()) == [
        (1, 2, False), (2, 2, True), (3, 3, True)]


def test_exact_dedup_of_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert exact_duplicates(empty).count() == 0 and without_copies(empty).count() == 0


def test_prefix_sums(spark):
    rnd = random.Random(1)
    values = [(rnd.randint(0, 50), i, rnd.randint(0, 9)) for i in range(3000)]
    df = spark.createDataFrame(values, "k int, id int, v int")
    total, want = 0, {}
    for k, i, v in sorted(values):
        want[i], total = total, total + v
    assert {r["id"]: r["before"] for r in prefix_sums(df, [F.col("k"), F.col("id")], F.col("v")).collect()} == want
    assert prefix_sums(df.limit(0), [F.col("k")], F.col("v")).count() == 0


def roots(nodes, edges):
    parent = {n: n for n in nodes}

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x
    for a, b in edges:
        x, y = sorted((root(a), root(b)))
        parent[y] = x
    return {n: root(n) for n in nodes}


@pytest.mark.parametrize("seed", [1, 2])
def test_components(spark, seed):
    rnd = random.Random(seed)
    edges = [(rnd.randint(0, 300), rnd.randint(0, 300)) for _ in range(180)]
    edges += [(500, 500 + i) for i in range(400)]                          # a hub
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(7, 7), (500, 500)]   # a chain, loops
    real = [(a, b) for a, b in edges if a != b]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == roots({n for e in real for n in e}, real)
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_edge_tables_take_few_tasks_and_many_edges_all_of_them(spark, monkeypatch):
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        edges = spark.range(0, 3000).select(F.col("id").alias("a"), (F.col("id") - F.col("id") % 50).alias("b"))
        want = {(i, i - i % 50) for i in range(3000)}

        def files_of_stars():
            with recorded([]) as paths:
                assert {tuple(r) for r in components(edges).collect()} == want
            return max(len(glob.glob(f"{p.removeprefix('file:')}/part-*")) for p in paths if "/star-" in p)

        assert files_of_stars() <= component_module.LEAST_TASKS
        monkeypatch.setattr(component_module, "TASK_EDGES", 10)
        assert files_of_stars() > 20
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", lower_az(text))
    return {tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(rows, k):
    sets = [shingles(t, k) for _, t in rows]
    edges = [(i, j) for i in range(len(rows)) for j in range(i) if sets[i] and sets[j]
             and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    return sets, roots(range(len(rows)), edges)


@pytest.fixture(scope="module")
def near_rows():
    rnd = random.Random(9)
    base = [f"w{rnd.randint(0, 5000)}" for _ in range(150)]

    def edited(words, n):
        words = list(words)
        for _ in range(n):
            words[rnd.randrange(len(words))] = f"e{rnd.randint(0, 10**6)}"
        return words
    texts = [" ".join(edited(base, rnd.randint(0, 12))) for _ in range(160)]     # many near copies of one
    chain = [f"c{i}" for i in range(120)]
    for _ in range(25):                                                          # each near the last one only
        chain = [*chain[4:], *[f"d{rnd.randint(0, 10**6)}" for _ in range(4)]]
        texts.append(" ".join(chain))
    texts += [" ".join(f"r{rnd.randint(0, 10**6)}" for _ in range(rnd.randint(1, 30))) for _ in range(60)]
    texts += ["The Same short text"] * 50 + ["the same SHORT text", "a b", "A  b", "x", "", None, "  ", "a b c d"]
    return [*[(i, t) for i, t in enumerate(texts)], (3, texts[3]), (None, texts[0]), (None, "only one")]


def test_near_duplicates(spark, near_rows):
    df = stage(spark.createDataFrame([(*r, "q") for r in near_rows], "doc_id long, text string, class string")
               .repartition(5), "near-test")
    sets, root = brute(near_rows, 4)
    groups = defaultdict(list)
    for i, r in root.items():
        groups[r].append(near_rows[i][0])
    least = {r: min((d for d in g if d is not None), default=None) for r, g in groups.items()}
    want = Counter((near_rows[i][0], len(sets[i]), least[r] if sets[i] else near_rows[i][0]) for i, r in root.items())
    got = near_duplicates(df, size=4).collect()
    assert Counter((r["doc_id"], r["n_shingles"], r["component_id"]) for r in got) == want
    kept = without_near_copies(df, size=4)
    assert kept.dtypes == df.dtypes
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(
        [d for r, d in least.items() if sets[r]] + [near_rows[i][0] for i, s in enumerate(sets) if not s])


def test_what_stars_miss_is_found_in_blocks(spark, near_rows, monkeypatch):
    """The same result when blocks are tiny."""
    monkeypatch.setattr(near_dedup, "BLOCK", 7)
    rows = near_rows[:190]
    df = stage(spark.createDataFrame(rows, "doc_id long, text string"), "near-blocks")
    _, root = brute(rows, 4)
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates(df, size=4).collect()}
    assert got == {rows[i][0]: rows[r][0] for i, r in root.items()}


def test_no_rows_and_only_empty_texts(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(empty).count() == 0
    blank = near_duplicates(spark.createDataFrame([(1, None), (2, ""), (3, " ")], "doc_id long, text string")).collect()
    assert {(r["doc_id"], r["component_id"], r["kept"], r["n_shingles"]) for r in blank} == {
        (1, 1, True, 0), (2, 2, True, 0), (3, 3, True, 0)}


def test_block_links_span_what_brute_force_links():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 2**63, 100).astype(np.uint64)
    members = []
    for i in range(60):
        s = base.copy()
        s[rng.integers(0, 100, rng.integers(0, 14))] = rng.integers(0, 2**63, 1).astype(np.uint64)
        members.append((i, i, np.unique(s)))
    links = block_links(members, 80)
    edges = [(i, j) for i in range(60) for j in range(i)
             if 100 * len(np.intersect1d(members[i][2], members[j][2])) >= 80 * len(np.union1d(members[i][2], members[j][2]))]
    assert set(map(tuple, map(sorted, links))) <= {(j, i) for i, j in edges}
    assert roots(range(60), links) == roots(range(60), edges) and len(links) < 60


def test_blocks_of_many_components_are_quick_and_exact():
    """Two blocks of variants of one text, nearly all a component of their own, most less alike than asked for."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**63, 150).astype(np.uint64)
    members = []
    for i in range(450):
        s = base.copy()
        at = rng.choice(150, 7 + i % 11, replace=False)
        s[at] = rng.integers(0, 2**63, len(at)).astype(np.uint64)
        members.append((i, i if i % 2 else 0, np.unique(s)))
    began = time.process_time()
    links = block_links(members, 80)
    took = time.process_time() - began
    sets = [set(m[2].tolist()) for m in members]
    edges = [(i, j) for i in range(450) for j in range(i)
             if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert links and set(map(tuple, map(sorted, links))) <= {(j, i) for i, j in edges}
    one = [(0, i) for i in range(0, 450, 2)]
    assert roots(range(450), links + one) == roots(range(450), edges + one) and len(links) < 450
    best = []                                            # what verifying the pairs one by one takes on this machine
    for _ in range(3):
        start = time.process_time()
        for i in range(100):
            np.intersect1d(members[i][2], members[i + 1][2], assume_unique=True)
        best.append(time.process_time() - start)
    assert took < min(best) / 100 * 450 * 449 / 2 / 10


def test_small_tables_of_near_dedup_take_few_files(spark, near_rows):
    conf = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        df = stage(spark.createDataFrame(near_rows, "doc_id long, text string"), "near-few")
        with recorded([]) as paths:
            got = near_duplicates(df, size=4)
            assert got.count() == len(near_rows)
        for name in ("buckets", "shared", "weighted", "stars", "candidates", "sets", "edges", "open", "class-groups"):
            files = [len(glob.glob(f"{p.removeprefix('file:')}/part-*")) for p in paths if f"/{name}-" in p]
            assert files and max(files) <= LEAST_TASKS, (name, files)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
