"""Contiguous shards against a walk over the sorted rows, with nulls, ties, repeats, long texts and empty tables."""

import random
import zlib

import pytest
from pyspark.sql import functions as F

from policylens.llm.common import stage
from policylens.llm.sharding import OVERHEAD, shard_plan, sharded_documents

SCHEMA = "doc_id long, text string, size string, shard string"


def walked(sizes, shards):
    total, before, out = sum(sizes), 0, []
    for size in sizes:
        out.append((2 * before + size) * shards // (2 * total))
        before += size
    return out


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(13)
    out = [(i, "ü" * rnd.randrange(60) + "x" * rnd.randrange(300), "a", None) for i in range(700)]
    out += [(None, "hot copy", "b", "c")] * 350 + [(i, None, None, "d") for i in range(40)] + [(5, "", "e", None)]
    rnd.shuffle(out)
    return out


def frame(spark, rows):
    return stage(spark.createDataFrame(rows, SCHEMA).repartition(5), "shard-test")


@pytest.mark.parametrize("shards", [1, 7, 40])
def test_plan_is_the_walk(spark, rows, shards):
    got = shard_plan(frame(spark, rows), shards).collect()
    assert len(got) == len(rows)
    size = {i: len((t or "").encode()) + OVERHEAD for i, t, *_ in rows}
    got.sort(key=lambda r: (r["shard"], r["slot"]))
    ids = [r["doc_id"] for r in got]
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, len((r[1] or "").encode())))
    assert ids == [r[0] for r in order]                                  # contiguous in the order
    sizes = [len((r[1] or "").encode()) + OVERHEAD for r in order]
    assert [r["size"] for r in got] == sizes
    assert [r["shard"] for r in got] == walked(sizes, shards)
    assert sorted((r["doc_id"] or -1, r["text_crc32"]) for r in got) == sorted(
        (i or -1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    for shard in {r["shard"] for r in got}:
        own = [r for r in got if r["shard"] == shard]
        assert [r["slot"] for r in own] == list(range(len(own)))
        assert abs(sum(r["size"] for r in own) - sum(sizes) / shards) <= max(size.values())


def test_documents_keep_their_columns(spark, rows):
    got = sharded_documents(frame(spark, rows), 6)
    assert got.columns == ["doc", "size", "shard", "slot"]
    back = sorted(map(str, got.select("doc.*").collect()))
    assert back == sorted(map(str, frame(spark, rows).collect()))
    assert got.select("shard", "slot").distinct().count() == len(rows)


def test_another_order(spark, rows):
    got = shard_plan(frame(spark, rows), 3, order=["text", "doc_id"]).orderBy("shard", "slot").collect()
    texts = [r["text"] for r in got]
    assert texts == sorted(texts, key=lambda t: (t is None, (t or "").encode()))


def test_a_long_text_and_an_empty_table(spark):
    rows = [(i, "x" * (200_000 if i == 3 else 10), None, None) for i in range(20)]
    got = {r["doc_id"]: r["shard"] for r in shard_plan(frame(spark, rows), 10).collect()}
    assert len(set(got.values())) <= 3 and [i for i in got if got[i] == got[3]] == [3]
    assert shard_plan(frame(spark, [])).count() == 0
    assert sharded_documents(frame(spark, [])).count() == 0


def test_identical_rows_are_spread_over_the_ranges(spark, monkeypatch):
    import policylens.llm.sharding as sharding
    staged = {}

    def keep(df, name):
        staged[name] = stage(df, name)
        return staged[name]

    monkeypatch.setattr(sharding, "stage", keep)
    assert shard_plan(frame(spark, [(None, "same", None, None)] * 4000)).count() == 4000
    parts = [r["count"] for r in staged["shard-ranges"].groupBy("_part").count().collect()]
    assert len(parts) >= 6 and max(parts) < 2 * sum(parts) / len(parts)
    assert staged["shard-ranges"].where(F.col("text_crc32") < 0).count() == 0
