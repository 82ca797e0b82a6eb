"""File sources and sinks: delimited text, width guard, JSON/CSV/Parquet."""

import pytest

from policylens import schemas
from policylens.operators.columns import width_guard
from policylens.operators.period import Period
from policylens.session import scratch_path
from policylens.sources import files, sinks


def write_lines(spark, lines):
    path = scratch_path(spark, "lines")
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(path)
    return path


@pytest.mark.parametrize("sep", ["|", "^", "\u0001"])
def test_delimited_arity_and_trailing_empties(spark, sep):
    cols = ["a", "b", "c"]
    lines = [sep.join(["k" * 22, "x", "y"]), sep.join(["k1", "x"]), sep.join(["k2", "x", "y", "z"]),
             sep.join(["k3", "x", ""]), sep.join(["", "", ""]), sep.join(["k4", "", "y"])]
    path = write_lines(spark, lines)
    assert files.sniff_separator(spark, path, 22) == sep
    got = sorted(tuple(r) for r in files.read_delimited(spark, path, cols, sep).collect())
    # a short line, a long line and lines ending in empty fields are dropped
    assert got == sorted([("k" * 22, "x", "y"), ("k4", "", "y")])
    kept = sorted(tuple(r) for r in files.read_delimited(spark, path, cols, sep, keep_trailing_empty=True).collect())
    assert ("k3", "x", "") in kept and ("", "", "") in kept


def test_sniff_separator_needs_long_first_line(spark):
    path = write_lines(spark, ["short"])
    with pytest.raises(ValueError):
        files.sniff_separator(spark, path, 22)


def test_width_guard(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert width_guard(df, 2).count() == 1
    assert width_guard(df, 3).count() == 0
    with pytest.raises(ValueError):
        width_guard(df, 3, strict=True)


def test_json_and_csv_read_with_schema(spark):
    df = spark.createDataFrame([("A1", 1.5, -2.0, "CNY"), ("A2", None, 3.0, None)], schemas.FEE)
    jpath, cpath = scratch_path(spark, "j"), scratch_path(spark, "c")
    df.write.json(jpath)
    df.write.option("sep", "^").csv(cpath)
    assert sorted(files.read_json(spark, jpath, schemas.FEE).collect()) == sorted(df.collect())
    assert sorted(files.read_csv(spark, cpath, schemas.FEE, sep="^").collect()) == sorted(df.collect())


def test_csv_per_window_refuses_to_overwrite(spark):
    df = spark.createDataFrame([(1,)], "a int")
    base = scratch_path(spark, "win")
    p = Period.of("1997-01-01 00:00:00", "1999-01-01 00:00:00")
    path, rows = sinks.write_csv_per_window(df, base, p, single_file=True)
    assert path.endswith("window_start=19970101000000")
    assert rows == 1
    assert [r[0] for r in spark.read.text(path).collect()] == ["1"]        # no header line unless asked for
    with pytest.raises(Exception):
        sinks.write_csv_per_window(df, base, p)


def test_broken_json_lines_are_rejects(spark, tmp_path):
    from pyspark.sql import types as T

    from policylens.sources.files import read_json_checked

    lines = ['{"a": "x", "b": 1.5}', '{"a": "y"', "", "   ", "nothing", '[1, 2]', '{"a": "z", "b": "text"}', '{"c": 1}',
             '{"a": null, "b": 2}', '{"a": "w", "b": 3} trailing']
    (tmp_path / "extract.json").write_text("\n".join(lines), encoding="utf-8")
    schema = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType())])
    good, broken = read_json_checked(spark, str(tmp_path), schema)
    assert good.schema == schema
    got = sorted(map(tuple, good.collect()), key=str)
    assert [x for x in got if x[0] != "w"] == sorted(
        [("x", 1.5), ("z", None), (None, None), (None, 2.0)], key=str)
    rejected = {r["line"] for r in broken.collect()}
    assert {'{"a": "y"', "nothing", "[1, 2]"} <= rejected
    assert good.count() + broken.count() == 8


def test_json_extracts_are_compressed(spark, monkeypatch):
    """The JSON lines of a round trip, ten times the extracts' own bytes as plain text, are compressed."""
    from pathlib import Path

    from policylens import queries
    from tests.conftest import SF_SMALL

    made = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    queries.spark_queries()["json_roundtrip"](spark, SF_SMALL)
    folders = [Path(p.removeprefix("file:")) for p in made if "-json-" in p]
    parts = [f for folder in folders for f in folder.glob("part-*")]
    assert len(folders) == 5 and parts and all(f.name.endswith(".gz") for f in parts)
    for name in ("head", "copycoins"):
        lines = spark.read.text(next(p for p in made if f"/{name}-json-" in p)).count()
        rejects = spark.read.parquet(next(p for p in made if f"/{name}-rejects-" in p)).count()
        assert 0 < rejects and lines - rejects == getattr(queries.sources_for(spark, SF_SMALL), name).count()


def test_json_lines_are_parsed_once(spark, tmp_path):
    """One parse a line and pass, and none after the lines were staged."""
    from policylens import queries, schemas
    from policylens.sources.files import parse_json_checked, read_json_checked
    from tests.conftest import SF_SMALL

    lines = ['{"applyno": "A1", "coinsrate": 30}', '{"applyno": "A2", "coinsr', " ", '{"applyno": "A3", "coinsrate": "x"}']
    (tmp_path / "coins.json").write_text("\n".join(lines), encoding="utf-8")
    read = read_json_checked(spark, str(tmp_path / "coins.json"), schemas.COPYCOINS)
    staged = parse_json_checked(spark, str(tmp_path / "coins.json"), schemas.COPYCOINS, str(tmp_path / "parsed"))
    for a, b in zip(read, staged):
        assert a.dtypes == b.dtypes and sorted(map(tuple, a.collect())) == sorted(map(tuple, b.collect()))
    assert [r["line"] for r in staged[1].collect()] == [lines[1]]
    plan = read[0]._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField") == 1
    rolled = queries.spark_queries()["json_roundtrip"](spark, SF_SMALL)
    assert "from_json" not in rolled._jdf.queryExecution().optimizedPlan().toString()


def test_the_csv_of_a_round_trip_is_compressed(spark, monkeypatch):
    from pathlib import Path

    from policylens import queries
    from tests.conftest import SF_SMALL

    made = []
    monkeypatch.setattr(queries, "scratch_path", lambda s, name: made.append(scratch_path(s, name)) or made[-1])
    rows = queries.spark_queries()["csv_roundtrip"](spark, SF_SMALL)
    parts = list(Path(made[-1].removeprefix("file:")).rglob("part-*"))
    assert parts and all(f.name.endswith(".csv.gz") for f in parts)
    assert rows.exceptAll(queries.spark_queries()["policy_wide_table"](spark, SF_SMALL)).isEmpty()
