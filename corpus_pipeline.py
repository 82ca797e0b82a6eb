"""From documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a frame that is written as
Parquet and read again as the next one's docs.  All but the last return the
columns of documents.

language      documents without letters, and those that no language holds by
              at least half, go
exact_dedup   of equal texts the one with the largest doc_id stays
near_dedup    of each group of near copies one document stays
mix           sources are repeated or cut to their target shares
pack          the mix, as sequences of at most 2048 tokens

Nulls in any column pass where a stage's own rules allow, very long texts are
taken whole, repeated rows are exact copies, an empty table passes through all
stages, and extra columns are carried up to the last stage, whatever their
names; ties are settled as each operator's module says.

What a stage stages in the shared folder is needed until its result is
written.  The next stage starts after that and deletes it.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from policylens.llm import langid
from policylens.llm.common import read_table, recorded, release, stage
from policylens.llm.exact_dedup import without_copies
from policylens.llm.mixing import mixed_documents
from policylens.llm.near_dedup import without_near_copies
from policylens.llm.packing import pack
from policylens.llm.queries import vocabulary
from policylens.session import workers_import_this


_runs = threading.local()


def _staged(sf_dir: str) -> list[str]:
    """What the stages of this thread's run over ``sf_dir`` have staged and not deleted."""
    if not hasattr(_runs, "staged"):
        _runs.staged = {}
    return _runs.staged.setdefault(sf_dir, [])


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from every document that has a language, keeps what is in one."""
    workers_import_this(spark)
    _staged(sf_dir).clear()                    # a new run; an earlier one may not be written yet
    with recorded(_staged(sf_dir)):
        return langid.in_a_language(docs, langid.train(docs.select("text", "lang")))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, _staged(sf_dir))
    with recorded(_staged(sf_dir)):
        return without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import_this(spark)
    release(spark, _staged(sf_dir))
    with recorded(_staged(sf_dir)):
        return without_near_copies(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    release(spark, _staged(sf_dir))
    with recorded(_staged(sf_dir)):
        return mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    workers_import_this(spark)
    release(spark, _staged(sf_dir))
    with recorded(_staged(sf_dir)):
        return pack(docs, vocabulary("word_bpe_49k.json"))


STAGES = [("language", language), ("exact_dedup", exact_dedup), ("near_dedup", near_dedup), ("mix", mix),
          ("pack", pack_sequences)]

# A learned language model and a tokenizer are not expressible in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, read = read_table(spark, sf_dir, "documents"), []
    for name, step in STAGES:
        written: list[str] = []
        result = step(spark, docs, sf_dir)
        with recorded(written):
            docs = stage(result, f"pipeline-{name}")
        release(spark, read)                   # the stage before this one's result
        read = written
    release(spark, _staged(sf_dir))
    return docs
