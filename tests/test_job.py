"""The command-line jobs on extract files written from the test tables."""

from policylens import schemas
from policylens.job import main
from policylens.plans.plain import plain_wide_table
from policylens.plans.policy import policy_wide_table
from policylens.queries import WINDOW
from policylens.session import scratch_path
from policylens.sources import files
from policylens.sources.adapter import EXTRACT_SCHEMA_NAMES, sources_for
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple((x is None, str(x)) for x in t))


def test_wide_and_plain_jobs(spark, capsys):
    src = sources_for(spark, SF_SMALL)
    base = scratch_path(spark, "extracts")
    for name in EXTRACT_SCHEMA_NAMES:
        frame = getattr(src, name)
        if name == "vehicle":
            files.to_delimited_lines(frame, schemas.VEHICLE_COLUMNS, "\u0001").write.text(f"{base}/{name}")
        elif name == "company":
            files.to_delimited_lines(frame, schemas.COMPANY_COLUMNS, "\u0001").write.text(f"{base}/{name}")
        else:
            frame.write.json(f"{base}/{name}")
    out = scratch_path(spark, "wide-out")
    assert main(["wide", "--extracts", base, "--out", out, "--start", "1997-01-01 00:00:00",
                 "--end", "1999-01-01 00:00:00"], spark=spark) == 0
    path, count = capsys.readouterr().out.strip().split("\t")
    expected = policy_wide_table(src, WINDOW)
    assert int(count) == expected.count()
    written = files.read_csv(spark, path, expected.schema)
    assert rows(written) == rows(expected)

    out2 = scratch_path(spark, "plain-out")
    assert main(["plain", "--extracts", base, "--out", out2], spark=spark) == 0
    _, count2 = capsys.readouterr().out.strip().split("\t")
    assert int(count2) == plain_wide_table(src).count()
