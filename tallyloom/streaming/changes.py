"""The replication as a stream: batches of changed rows arrive as files and are merged as they come."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tallyloom.plans.replicate import Replica
from tallyloom.sources.cleaning import nan_to_null


def stream_changes(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    replica: Replica,
    table: str,
    checkpoint: str,
    *,
    files_per_batch: int | None = None,
    available_now: bool = True,
) -> StreamingQuery:
    """Merge every new parquet file of ``folder`` into ``table``.

    The stream's checkpoint takes the place of the watermark. A batch repeated after a failure changes nothing,
    and an older file that arrives late does not undo a newer row, because the merge compares write dates first.
    """
    reader = spark.readStream.schema(schema)
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        replica.merge(table, nan_to_null(batch))

    writer = reader.parquet(folder).writeStream.foreachBatch(merge_batch).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()
