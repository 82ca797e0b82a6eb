"""File sources: JSON lines, CSV, and delimited text with a sniffed separator.

All readers take an explicit schema (no inference pass).  The delimited
reader splits with a built-in expression, so lines are parsed inside the
scan's generated code; the only driver work is reading one line to find the
separator.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line (SRC-1)."""
    return spark.read.schema(schema).json(path)


def read_json_checked(spark: SparkSession, path: str, schema: T.StructType) -> tuple[DataFrame, DataFrame]:
    """The rows of a JSON-lines source, and its broken lines as (file, line).

    A line is broken if it is not one JSON object; blank lines are neither.  A
    field of another type than the schema's is null, as ``read_json`` has it,
    and its line is a row.  Both frames read the lines once each."""
    parsed = _parsed_lines(spark, path, schema)
    return (parsed.where(~F.col(BROKEN)).select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in schema.fields]),
            parsed.where(BROKEN).select("file", "line"))


BROKEN, BROKEN_FILE, BROKEN_LINE = "_broken", "_broken_file", "_broken_line"


def _parsed_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Each line that is not blank, what it parses to and whether it is broken.
    The parse is a generator's input, which no filter or projection above it
    repeats."""
    corrupt = "_corrupt_record"
    with_corrupt = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())])
    line = F.col("value")
    row = F.from_json(line, with_corrupt, {"columnNameOfCorruptRecord": corrupt})
    parsed = spark.read.text(path).where(F.length(F.trim(line)) > 0).select(
        F.input_file_name().alias("file"), line.alias("line"), F.explode(F.array(row)).alias("row"))
    # only a line that is not wholly as the schema says is looked at again
    broken = F.col(f"row.{corrupt}").isNotNull() & F.from_json("line", T.MapType(T.StringType(), T.StringType())).isNull()
    return parsed.withColumn(BROKEN, broken)


def parse_json_checked(spark: SparkSession, path: str, schema: T.StructType, parsed: str) -> tuple[DataFrame, DataFrame]:
    """``read_json_checked`` for frames that are read more than once: every line
    is parsed once, into Parquet in the new folder ``parsed``, and both frames
    read that."""
    lines, is_broken = _parsed_lines(spark, path, schema), F.col(BROKEN)
    lines.select(*[F.col(f"row.`{f.name}`").alias(f.name) for f in schema.fields],
                 F.when(is_broken, F.col("file")).alias(BROKEN_FILE),
                 F.when(is_broken, F.col("line")).alias(BROKEN_LINE)).write.parquet(parsed)
    kept = T.StructType([*schema.fields, *[T.StructField(c, T.StringType()) for c in (BROKEN_FILE, BROKEN_LINE)]])
    staged, is_row = spark.read.schema(kept).parquet(parsed), F.col(BROKEN_LINE).isNull()
    return (staged.where(is_row).select(*[F.col(f"`{f.name}`") for f in schema.fields]),
            staged.where(~is_row).select(F.col(BROKEN_FILE).alias("file"), F.col(BROKEN_LINE).alias("line")))


def read_csv(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",", header: bool = False) -> DataFrame:
    """CSV with the given separator and header flag (SRC-2)."""
    return spark.read.schema(schema).option("sep", sep).option("header", header).csv(path)


def sniff_separator(spark: SparkSession, path: str, key_width: int = 22) -> str:
    """The separator is the character right after a fixed-width key on the
    first line (ACT-2: one line comes back to the driver)."""
    first = spark.read.text(path).first()
    if first is None or len(first.value) <= key_width:
        raise ValueError(f"cannot find a separator at offset {key_width} in {path}")
    return first.value[key_width]


def read_delimited(spark: SparkSession, path: str, columns: list[str], sep: str,
                   keep_trailing_empty: bool = False) -> DataFrame:
    """Split each text line on ``sep`` and keep lines with exactly
    ``len(columns)`` fields (SRC-3/4, SRC-6).  By default trailing empty
    fields are dropped before counting, as a plain string split does, so
    such lines fail the arity test."""
    pattern = re.escape(sep)
    line = F.col("value")
    if not keep_trailing_empty:
        line = F.regexp_replace(line, f"(?:{pattern})+$", "")
    parts = F.split(line, pattern, -1)
    return (spark.read.text(path)
            .select(parts.alias("parts"))
            .where(F.size("parts") == len(columns))
            .select(*[F.col("parts").getItem(i).alias(c) for i, c in enumerate(columns)]))


def to_delimited_lines(df: DataFrame, columns: list[str], sep: str) -> DataFrame:
    """Render rows as separator-joined text lines (nulls as empty fields)."""
    return df.select(F.concat_ws(sep, *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]).alias("value"))
