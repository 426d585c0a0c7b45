"""Raw to trusted as a file stream: each run reads only the batches that landed since the last one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tidemark.operators.fingerprints import row_hash
from tidemark.plans.jobs import Lakehouse, merge_table
from tidemark.plans.layers import trusted
from tidemark.sources.raw import PARTITION_COLUMNS, PARTITIONS
from tidemark.spec import TableSpec


def without_replays(rows: DataFrame, table: TableSpec, within: str) -> DataFrame:
    """A stream of raw rows without those that an overlapping window extracted again.

    A replay is the same row of a later batch. Spark's state store remembers rows
    until ``within`` has passed in the batches' own time, which must exceed the time
    from a batch to the next: the state holds the rows of about twice that time,
    however long the stream runs.
    """
    landed = F.to_timestamp("batch", "yyyyMMdd_HHmmss").alias("landed_at")
    timed = rows.select("*", landed, row_hash(table.columns).alias("content")).withWatermark("landed_at", within)
    return timed.dropDuplicatesWithinWatermark([table.key, table.changed_at, "content"]).drop("landed_at", "content")


def pick_up(
    spark: SparkSession,
    house: Lakehouse,
    table: TableSpec,
    files_per_batch: int | None = None,
    replays_within: str | None = None,
) -> StreamingQuery:
    """Merge all landed batches of a table that were not merged yet, then stop.

    With ``replays_within``, rows that overlapping windows landed twice are dropped
    before the merge (``without_replays``).

    The stream's checkpoint takes the place of re-reading the raw layer. A
    micro-batch can be replayed, or hold rows older than the table's, so the
    merge keeps target rows that are newer.
    """
    reader = spark.readStream.schema(StructType(table.schema.fields + StructType.fromDDL(PARTITIONS).fields))
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    rows = reader.parquet(f"{house.raw}/{table.name}")
    if replays_within is not None:
        rows = without_replays(rows, table, replays_within)
    rows = rows.drop(*PARTITION_COLUMNS)

    def merge(batch: DataFrame, _: int) -> None:
        merge_table(trusted(batch, table), house, house.silver(table.name), table, newer_by=table.changed_at)

    return (
        rows.writeStream.foreachBatch(merge)
        .option("checkpointLocation", house.progress(table.name))
        .trigger(availableNow=True)
        .start()
    )
