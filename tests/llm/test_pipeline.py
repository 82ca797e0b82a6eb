"""The pipeline's stages against brute-force versions on a small table."""

import random
import re
from collections import Counter
from pathlib import Path

import pytest

import corpus_pipeline
from policylens.llm.common import release, stage

WORDS = {"en": "the of and to in that was with for from house river stone".split(),
         "de": "der die und nicht von mit das ist ein haus fluss stein wald".split()}
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, doc string, row string"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def table():
    rnd = random.Random(11)
    rows = []

    def add(text, lang, source):
        i = len(rows)
        rows.append((i, text, lang, source, None if text is None else len(text), f"doc{i}", "x"))

    for i in range(160):
        lang = rnd.choice(["en", "de"])
        add(" ".join(rnd.choice(WORDS[lang]) for _ in range(rnd.randint(3, 120))), lang, f"s{i % 4}" if i % 9 else None)
    for i in range(0, 40):
        add(rows[i][1].upper() if i % 2 else rows[i][1], rows[i][2], "s0")      # copies
    for i in range(40, 60):
        if len(words(rows[i][1])) > 60:
            add(rows[i][1] + " stone", rows[i][2], "s1")                        # near copies
    for text in (None, "", "   ", "1234 -- 5", "...", "der Fluss", "the house"):
        add(text, None, "s2")
    rows.append(rows[3])                                                        # a repeated row
    return rows


@pytest.fixture(scope="module")
def outputs(spark, table):
    docs = stage(spark.createDataFrame(table, SCHEMA).repartition(3), "pipeline-test")
    out = [docs]
    for name, step in corpus_pipeline.STAGES:
        out.append(stage(step(spark, out[-1], ""), name))
    return out


def rows_of(df):
    return [tuple(r) for r in df.collect()]


def test_all_but_the_last_keep_the_columns(outputs):
    for df in outputs[:-1]:
        assert df.dtypes == outputs[0].dtypes


def test_language(outputs, table):
    kept = rows_of(outputs[1])
    assert Counter(kept) == Counter(r for r in table if r[1] and re.search("[A-Za-z]", r[1]))


def test_exact_dedup(outputs):
    before, after = rows_of(outputs[1]), rows_of(outputs[2])
    best = {}
    for r in before:
        key = r[1].lower()
        best[key] = max(best.get(key, -1), r[0])
    assert sorted(r[0] for r in after) == sorted(best.values())
    assert set(after) <= set(before)


def test_near_dedup(outputs):
    before, after = rows_of(outputs[2]), rows_of(outputs[3])

    def shingles(text):
        w = words(text.lower())
        return {tuple(w[i:i + 5]) for i in range(max(1, len(w) - 4))}
    sets = {r[0]: shingles(r[1]) for r in before}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a < b and 100 * common >= 80 * (len(sets[a]) + len(sets[b]) - common):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    assert sorted(r[0] for r in after) == sorted({root(i) for i in sets})


def test_mix(outputs):
    before, after = rows_of(outputs[3]), rows_of(outputs[4])
    size, taken, original = Counter(), Counter(), {r[0]: r for r in before}
    for r in before:
        size[r[3]] += len(words(r[1]))
    for r in after:
        taken[r[3]] += len(words(r[1]))
        assert original[r[0]][1].startswith(r[1]) and r[4] == len(r[1])
    names = sorted((s for s in size if s is not None)) + ([None] if None in size else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, total, free = {}, 1.5 * sum(size.values()), set(names)
    while True:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = {s for s in free if level * weight[s] > 2 * size[s]}
        if not over:
            break
        target.update({s: 2.0 * size[s] for s in over})
        free -= over
    target.update({s: level * weight[s] for s in free})
    assert {s: taken[s] for s in names} == {s: int(target[s] + 1e-9) for s in names}
    copies = Counter(r[0] for r in after)
    assert max(copies.values()) <= 2


def test_pack(outputs):
    docs, pieces = rows_of(outputs[4]), outputs[5].collect()
    assert Counter(p["doc_id"] for p in pieces) == Counter(r[0] for r in docs)        # none is longer than a sequence
    by_sequence = {}
    for p in pieces:
        by_sequence.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    for spans in by_sequence.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(by_sequence) == -(-sum(p["length"] for p in pieces) // 2048)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], SCHEMA).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_stages_delete_what_earlier_ones_staged(spark, tmp_path, monkeypatch):
    rows = [(1, "the river and the house", "en", "a", 23), (2, "The river and the house", "en", "a", 23),
            (3, "der Fluss und das Haus", "de", None, 22), (None, "the stone " * 50_000, "en", "b", 500_000),
            (None, None, None, None, None)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet"))
    released = []
    monkeypatch.setattr(corpus_pipeline, "release", lambda s, paths: (released.extend(paths), release(s, paths)))
    before = {(r["doc_id"], r["length"]) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert {i for i, _ in before} == {2, 3, None} and sum(n for i, n in before if i is None) > 2048
    assert len(released) == len(set(released)) and not any(Path(p.removeprefix("file:")).exists() for p in released)
    for name, _ in corpus_pipeline.STAGES[:-1]:
        assert any(f"/pipeline-{name}-" in p for p in released)
    assert not any("/pipeline-pack-" in p for p in released)


def test_registered():
    import __spark_entry__
    assert __spark_entry__.queries()["pipeline"] is corpus_pipeline.run
    assert [f"op{n}_" in " ".join(__spark_entry__.queries()) for n in range(1, 11)] == [True] * 10
