"""Policy indicators over a folder of arriving policy extracts.

The extracts are exported as files; a file-source stream picks up each new
file and applies the same policy plan as the batch job (window filter, share,
vehicle and company joins, indicators) to each micro-batch.  No state grows
with the stream; the co-insurance, vehicle and company extracts are read for
every batch.  Progress is kept in a checkpoint folder and a batch's output
replaces that of an earlier try, so each file counts exactly once.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from policylens.operators.period import Period
from policylens.plans.policy import policy_indicators
from policylens.schemas import POLICY


def policy_extract_stream(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(POLICY).option("maxFilesPerTrigger", files_per_trigger).json(folder)


def run_available(policies: DataFrame, static_src, period: Period, sink: str, checkpoint: str) -> StreamingQuery:
    """Policy indicators of every policy file available now, then stop.

    Each micro-batch is a static frame that goes through the batch plan with the
    co-insurance, vehicle and company extracts of ``static_src``, and is written
    to its own folder ``sink``/<batch number>, replacing what an earlier try of
    the same batch left there."""
    def write(batch: DataFrame, number: int) -> None:
        rows = policy_indicators(replace(static_src, policy=batch), period)
        rows.write.mode("overwrite").parquet(f"{sink}/{number}")

    query = (policies.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def read_sink(spark: SparkSession, sink: str) -> DataFrame:
    """All batches written so far."""
    return spark.read.parquet(f"{sink}/*")
