"""Linking of a stream of query files against a fixed pool.

A batch of the stream runs the batch plan (its top-k window cannot run on a stream) and is written to
a folder named by the batch's number, so that a batch that is run again replaces its own result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..functions.text import normalise
from ..operators.blocking import BlockingConfig, candidate_pairs, id_lists


def entity_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 1) -> DataFrame:
    """Parquet files of entities, as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).parquet(folder)


def candidate_batches(pool: DataFrame, output: str, config: BlockingConfig = BlockingConfig()) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes the candidate lists of each batch."""

    def write(batch: DataFrame, number: int) -> None:
        queries = normalise(batch, ["row_id", "entity_id"])
        lists = id_lists(queries, candidate_pairs(queries, pool, config), "candidate_entity_ids")
        lists.write.mode("overwrite").parquet(f"{output}/batch={number}")

    return write


def link_stream(stream: DataFrame, pool: DataFrame, output: str, checkpoint: str, config: BlockingConfig = BlockingConfig()) -> StreamingQuery:
    """Start linking all files that are there; ends when they are done."""
    writer = stream.writeStream.foreachBatch(candidate_batches(pool, output, config))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
