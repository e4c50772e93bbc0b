"""Incremental loads: new bronze files are merged into a keyed table, batch by batch."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from storeloom.sources.writers import upsert_months


def upsert_new_files(spark: SparkSession, source: str, schema: str, target: str,
                     key: Sequence[str], at: str, order_col: str, checkpoint: str,
                     ties: Sequence[str] = (), moves: bool = False,
                     files_per_batch: int | None = None) -> StreamingQuery:
    """Merge the files that arrived since the last run into the months of ``at`` that they touch,
    then stop.

    A batch that a failure repeats changes nothing the second time. A new checkpoint is a new
    stream: it merges all files again, which changes nothing that is not newer.
    """
    def merge(batch: DataFrame, _: int) -> None:
        # The batch is read once for its months and once for its rows.
        batch.persist()
        try:
            upsert_months(batch.sparkSession, target, batch, key, at, order_col, ties, moves)
        finally:
            batch.unpersist()

    files = spark.readStream.schema(schema)
    if files_per_batch:
        files = files.option("maxFilesPerTrigger", files_per_batch)
    return (files.parquet(source).writeStream.foreachBatch(merge)
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
