"""The visit log under a watermark: each visit once, and what came too late beside the table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ledgerlark.operators.keyed import KeyedTable
from ledgerlark.session import delete_path, scratch_path
from ledgerlark.sources.schemas import LOADED_AT

#: Rows left out of a batch whose keys and digests may be sent to every executor: some MB.
SENT_ROWS = 100_000


def load_on_time(
    stream: DataFrame, table: KeyedTable, late_path: str, checkpoint: str, delay: str, key: str = "id", at: str = "visited_at"
) -> StreamingQuery:
    """Take every row once by ``key`` within ``delay`` of its time, then stop when the input is drained.

    The stream's watermark is the newest ``at`` that it has seen, less ``delay``. A row behind it is late: it does
    not enter ``table`` but a folder of its batch below ``late_path``. A repeat of a key within the delay is dropped from
    state, which holds keys no longer than that; a repeat beyond it is late, too, and is dropped if the table holds
    the very row. So a row is in the table, or beside it, or a copy of one in the table. Rows without a time
    are never late, and rows without a key are never repeats: both go into the table as they come.

    Each batch is stored once before it is parted, and both writes carry the batch's number, so a batch that is
    tried again changes nothing.
    """
    whole = F.col(at).isNotNull() & F.col(key).isNotNull()
    timed = stream.where(whole).withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
    taken = timed.unionByName(stream.where(~whole)).withColumn("__taken", F.lit(True))
    both = taken.unionByName(stream.where(whole).withColumn("__taken", F.lit(False)))

    def part(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        place = scratch_path(spark, "stream-batch")
        batch.write.parquet(place)
        stored = spark.read.schema(batch.schema).parquet(place)
        new = stored.where("__taken").drop("__taken")
        table.write_batch(new, batch_id, [F.col(LOADED_AT)])
        rest = scratch_path(spark, "stream-left")
        _left_out(stored, key).write.parquet(rest)
        delete_path(spark, place)
        left = spark.read.schema(new.schema).parquet(rest)
        # The planner takes digests for much smaller than they are, so the joins go by counted rows.
        way = "broadcast" if left.count() <= SENT_ROWS else "merge"
        held = table.read().join(left.select(key).distinct().hint(way), key, "left_semi")
        content = [c for c in new.columns if c != LOADED_AT]
        digests = held.select(_digest(content).alias("__d")).distinct().hint(way)
        late = left.withColumn("__d", _digest(content)).join(digests, "__d", "left_anti")
        late.select(*new.columns).write.mode("overwrite").parquet(f"{late_path}/batch_id={batch_id}")
        delete_path(spark, rest)

    return both.writeStream.foreachBatch(part).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _digest(columns: list[str]) -> Column:
    return F.sha2(F.to_json(F.struct(*[F.col(f"`{c}`") for c in columns])), 256)


def _left_out(batch: DataFrame, key: str) -> DataFrame:
    """The rows of a batch that were not taken; of equal rows, as many as were not.

    Rows seen count up and rows taken down, so one aggregate tells them and nothing is joined.
    """
    columns = [c for c in batch.columns if c != "__taken"]
    count = F.sum(F.when(F.col("__taken"), -1).otherwise(1)).alias("__n")
    rest = batch.where(F.col(key).isNotNull()).groupBy(*[F.col(f"`{c}`") for c in columns]).agg(count).where("__n > 0")
    return rest.select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("__n").cast("int")))).select(*columns)


def late_rows(stream_schema, table: KeyedTable, late_path: str) -> DataFrame:
    """All rows that came too late so far."""
    spark = table.log.spark
    folders = spark._jvm.org.apache.hadoop.fs.Path(late_path)
    if not folders.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folders):
        return spark.createDataFrame([], stream_schema)
    return spark.read.schema(stream_schema).parquet(f"{late_path}/*")
