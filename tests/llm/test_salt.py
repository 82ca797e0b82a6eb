"""Near dedup chooses the pieces of heavy keys by columns wherever its rows have moved."""

from policylens.llm import near_dedup
from policylens.operators import joins


def test_near_dedup_has_no_row_id_above_moved_rows(spark, monkeypatch):
    calls = []

    def watched(left, right, *args, **kw):
        heavy = kw.get("heavy", args[2] if len(args) > 2 else "right")
        out = joins.salted_join(left, right, *args, **kw)
        if heavy != "none" and joins.moves_rows(left if heavy == "left" else right):
            calls.append("monotonically_increasing_id" in out._jdf.queryExecution().analyzed().toString())
        return out

    monkeypatch.setattr(near_dedup, "salted_join", watched)
    sets = spark.createDataFrame([(i, [1, 2, 3]) for i in range(4)], "class long, shingles array<long>")
    pairs = spark.createDataFrame([(0, 1), (0, 2), (0, 3)], "centre long, class long")
    assert near_dedup._confirmed(pairs, sets, 80).count() == 3
    found = spark.createDataFrame([(0, 0), (1, 0), (2, 2)], "node long, component long")
    more = spark.createDataFrame([(1, 2), (5, 2)], "a long, b long")
    assert {r["component"] for r in near_dedup._joined(found, more).collect()} == {0}
    assert calls and not any(calls)
