"""The visit log as a stream: upsert on the visit id, with a late-row policy."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.dedup import dedup_source
from ledgerlark.operators.incremental import UpsertTable, build_visits
from ledgerlark.operators.revenue import AdHierarchy
from ledgerlark.operators.staging import typed
from ledgerlark.sources.schemas import LOADED_AT, RAW_TABLES

VISITS = "prod_web_visits"


def visit_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream of the raw visit files below ``path``."""
    reader = spark.readStream.schema(RAW_TABLES[VISITS].schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def visits_schema(hierarchy: AdHierarchy) -> T.StructType:
    """Columns of the visit fact, taken from an empty build."""
    spark = hierarchy.ads.sparkSession
    empty = spark.createDataFrame([], RAW_TABLES[VISITS].schema)
    return build_visits(typed(empty, VISITS), hierarchy).schema


def load_visits(
    stream: DataFrame,
    hierarchy: AdHierarchy,
    table: UpsertTable,
    checkpoint: str,
    lateness: str | None = None,
    late_path: str | None = None,
) -> StreamingQuery:
    """Attribute and upsert every new visit, then stop when the input is drained.

    Re-delivered copies are collapsed per batch and replaced across batches by
    the upsert, so the stream keeps no state and a much-copied visit needs no
    task of its own. With ``lateness`` (such as '2 hours'), visits that are
    older than the newest visit of earlier batches by more than that go to
    ``late_path`` instead of the table. A visit without a time is never late.
    """
    if lateness and not late_path:
        raise ValueError("a lateness needs a late_path, where late visits are kept")

    # Newest visit before each batch. Only earlier batches count, so that a
    # retried batch does not see itself. The whole table is scanned once per
    # start; from then on each batch adds its own newest visit.
    marks: dict[int, datetime | None] = {0: None}

    def merge(batch: DataFrame, batch_id: int) -> None:
        staged = typed(batch, VISITS)
        if lateness and batch_id not in marks:
            marks[batch_id] = table.high_water_mark("visited_at", F.col("batch_id") < batch_id)
        mark = marks.get(batch_id)
        if mark is not None:
            on_time = F.col("visited_at").isNull() | (F.col("visited_at") > F.lit(mark) - F.expr(f"INTERVAL {lateness}"))
            staged.where(~on_time).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
            staged = staged.where(on_time)
        table.write_batch(build_visits(staged, hierarchy), batch_id, [F.col("_loaded_at")])
        if lateness:
            newest = table.high_water_mark("visited_at", F.col("batch_id") == batch_id)
            marks[batch_id + 1] = max((m for m in (mark, newest) if m is not None), default=None)

    return (
        stream.writeStream.foreachBatch(merge)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def land_raw(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the raw deliveries; each batch owns one folder and may be retried."""

    def keep(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return (
        stream.writeStream.foreachBatch(keep)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def conflict_free(spark: SparkSession, path: str) -> DataFrame:
    """Landed visits without re-deliveries and without conflicting keys.

    A conflicting copy that arrives later has to withdraw a visit that looked
    fine before, so the decision is made over everything landed, not per batch.
    """
    landed = spark.read.parquet(path).drop("batch_id")
    return dedup_source(landed, ["id"], (LOADED_AT,))
