"""Command-line jobs: the policy wide table (current job) and the plain wide
table (older job), reading extract files and writing the result.

    python -m policylens.job wide --start "2013-01-02 00:00:00" --end "2016-01-02 00:00:00" \\
        --extracts /shared/extracts --out /shared/widetable
    python -m policylens.job plain --extracts /shared/extracts --out /shared/plain

``--extracts`` is a folder with one sub-folder per extract: JSON lines for
``copymain head fee itemkind copycoins policy policy_coins`` (and
``policy2 head2 fee2 profit2 vehicle2 pmain2 itemkind2`` for the older job),
delimited text for ``vehicle`` and ``company`` (separator found after the
fixed-width key of the first vehicle line, or given with ``--sep``).  Any
extract can be pointed elsewhere with ``--path name=location``.

    python -m policylens.job ingest --extracts /shared/extracts --out /shared/typed
    python -m policylens.job wide --ingested /shared/typed --start .. --end .. --out /shared/widetable

``ingest`` parses the wide job's extracts once; any number of windows then
read only the months they touch.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from policylens import schemas
from policylens.operators.period import Period
from policylens.session import CLUSTER_CONF, shuffle_partitions_for
from policylens.sources import files, sinks
from policylens.sources.adapter import EXTRACT_SCHEMA_NAMES, Sources
from policylens.sources.ingest import ingested, read_ingested, write_ingested

JSON_EXTRACTS = [n for n in EXTRACT_SCHEMA_NAMES if n not in ("vehicle", "company")]


def read_extracts(spark: SparkSession, base: str, overrides: dict[str, str], sep: str | None,
                  key_width: int, names: list[str], rejects: str | None = None) -> Sources:
    """``rejects``: a folder for the broken lines of each JSON extract, whose
    number is printed; without it they are left out of the rows only."""
    def path(name: str) -> str:
        return overrides.get(name, f"{base.rstrip('/')}/{name}")

    frames = {}
    for name in EXTRACT_SCHEMA_NAMES:
        if name not in names:
            frames[name] = None
            continue
        if name in ("vehicle", "company"):
            continue
        frames[name], broken = files.read_json_checked(spark, path(name), getattr(schemas, EXTRACT_SCHEMA_NAMES[name]))
        if rejects:
            out, lines = sinks.write_parquet(broken, f"{rejects.rstrip('/')}/{name}")
            print(f"{out}\t{lines} broken lines")
    if "vehicle" in names or "company" in names:
        separator = sep or files.sniff_separator(spark, path("vehicle"), key_width)
        frames["vehicle"] = files.read_delimited(spark, path("vehicle"), schemas.VEHICLE_COLUMNS, separator)
        frames["company"] = files.read_delimited(spark, path("company"), schemas.COMPANY_COLUMNS, separator)
    return Sources(**frames)


WIDE_INPUTS = ["copymain", "head", "fee", "itemkind", "copycoins", "policy", "policy_coins", "vehicle", "company"]
PLAIN_INPUTS = ["policy2", "head2", "fee2", "profit2", "vehicle2", "pmain2", "itemkind2"]


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    ap = argparse.ArgumentParser(prog="policylens.job")
    ap.add_argument("job", choices=["wide", "plain", "ingest"])
    ap.add_argument("--extracts", help="folder of the extracts")
    ap.add_argument("--ingested", help="folder that the ingest job wrote, instead of the extracts (wide only)")
    ap.add_argument("--out", required=True)
    ap.add_argument("--start")
    ap.add_argument("--end")
    ap.add_argument("--prior-start")
    ap.add_argument("--prior-end")
    ap.add_argument("--path", action="append", default=[], help="name=location override")
    ap.add_argument("--sep")
    ap.add_argument("--key-width", type=int, default=22)
    ap.add_argument("--rejects", help="folder for the broken lines of the JSON extracts")
    ap.add_argument("--single-file", action="store_true")
    ap.add_argument("--header", action="store_true", help="write a header line to the CSV")
    ap.add_argument("--input-bytes", type=int,
                    help="total extract size; sets spark.sql.shuffle.partitions to keep partitions ~256 MiB")
    args = ap.parse_args(argv)
    if (args.extracts is None) == (args.ingested is None):
        ap.error("give --extracts or --ingested")
    if args.ingested and args.job != "wide":
        ap.error("--ingested is for the wide job")

    if spark is None:
        builder = SparkSession.builder.appName(f"policylens-{args.job}")
        for k, v in CLUSTER_CONF.items():
            builder = builder.config(k, v)
        spark = builder.getOrCreate()
    if args.input_bytes:
        spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_partitions_for(args.input_bytes)))
    overrides = dict(p.split("=", 1) for p in args.path)

    if args.job == "ingest":
        write_ingested(read_extracts(spark, args.extracts, overrides, args.sep, args.key_width, WIDE_INPUTS,
                                     args.rejects), args.out)
        print(args.out)
        return 0
    if args.job == "wide":
        from policylens.plans.policy import policy_wide_table
        if not (args.start and args.end):
            ap.error("wide needs --start and --end")
        period = Period.of(args.start, args.end, args.prior_start, args.prior_end)
        if args.ingested:
            src = read_ingested(spark, args.ingested, WIDE_INPUTS)
        else:
            src = ingested(read_extracts(spark, args.extracts, overrides, args.sep, args.key_width, WIDE_INPUTS,
                                         args.rejects))
        out, rows = sinks.write_csv_per_window(policy_wide_table(src, period), args.out, period,
                                               header=args.header, single_file=args.single_file)
    else:
        from policylens.plans.plain import plain_wide_table
        src = read_extracts(spark, args.extracts, overrides, args.sep, args.key_width, PLAIN_INPUTS, args.rejects)
        out, rows = sinks.write_parquet(plain_wide_table(ingested(src)), args.out, files=1 if args.single_file else None)
    print(f"{out}\t{rows}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
