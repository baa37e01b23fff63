"""Slowly changing dimensions, type 2: one row per version of a key."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlark.functions.keys import surrogate_key
from ledgerlark.operators.joins import all_of
from ledgerlark.session import written

VALIDITY = ("scd_id", "updated_at", "valid_from", "valid_to")


def _version(columns: list[str], source: str, updated: Column, scd: Column, start: Column, end: Column) -> Column:
    return F.struct(
        *[F.col(f"{source}.`{c}`").alias(c) for c in columns],
        scd.alias("scd_id"),
        updated.alias("updated_at"),
        start.alias("valid_from"),
        end.alias("valid_to"),
    )


def _changes(
    still_open: DataFrame,
    incoming: DataFrame,
    keys: list[str],
    changed: Column,
    updated: Column,
    run_at: Column,
    close_missing: bool,
) -> DataFrame:
    """The open versions and the new ones after a run, with ``change``: kept, closed or opened."""
    columns = incoming.columns
    joined = still_open.withColumn("__there", F.lit(True)).alias("old").join(
        incoming.withColumn("__there", F.lit(True)).alias("new"),
        all_of([F.col(f"old.`{k}`").eqNullSafe(F.col(f"new.`{k}`")) for k in keys]),
        "full_outer",
    )
    # Rows without a key arrive too, so presence is a marker and no key column.
    has_old, has_new = F.col("old.__there").isNotNull(), F.col("new.__there").isNotNull()
    forever = F.lit(None).cast("timestamp")

    def told(change: str, version: Column) -> Column:
        return F.struct(F.lit(change).alias("change"), version.alias("v"))

    def old(end: Column) -> Column:
        return _version(columns, "old", F.col("old.updated_at"), F.col("old.scd_id"), F.col("old.valid_from"), end)

    scd = surrogate_key(*[F.col(f"new.`{k}`") for k in keys], F.date_format(updated, "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    opened = told("opened", _version(columns, "new", updated, scd, updated, forever))
    kept = told("kept", old(forever))
    # Each joined pair yields one or two versions, so the join runs once.
    versions = (
        F.when(has_old & has_new & changed, F.array(told("closed", old(updated)), opened))
        .when(has_old & has_new, F.array(kept))
        .when(has_new, F.array(opened))
        .otherwise(F.array(told("closed", old(run_at)) if close_missing else kept))
    )
    return joined.select(F.explode(versions).alias("x")).select("x.v.*", "x.change")


def check_changes(
    still_open: DataFrame, incoming: DataFrame, keys: list[str], check: list[str], run_at: Column, close_missing: bool = True
) -> DataFrame:
    """What a run by :func:`snapshot_by_check` makes of the open versions."""
    same = all_of([F.col(f"old.`{c}`").eqNullSafe(F.col(f"new.`{c}`")) for c in check])
    return _changes(still_open, incoming, keys, ~same, run_at, run_at, close_missing)


def timestamp_changes(
    still_open: DataFrame, incoming: DataFrame, keys: list[str], updated_at: str, run_at: Column, close_missing: bool = True
) -> DataFrame:
    """What a run by :func:`snapshot_by_timestamp` makes of the open versions."""
    stamp = F.col(f"new.`{updated_at}`").cast("timestamp")
    return _changes(still_open, incoming, keys, stamp > F.col("old.updated_at"), stamp, run_at, close_missing)


def _with_closed(changes: DataFrame, history: DataFrame, incoming: DataFrame) -> DataFrame:
    closed = history.where(F.col("valid_to").isNotNull()).select(*incoming.columns, *VALIDITY)
    return changes.drop("change").unionByName(closed)


def empty_history(incoming: DataFrame) -> DataFrame:
    """A history without versions, for the first run."""
    none = F.lit(None)
    return incoming.select(
        *incoming.columns,
        none.cast("string").alias("scd_id"),
        *[none.cast("timestamp").alias(c) for c in VALIDITY[1:]],
    ).where(F.lit(False))


def snapshot_by_timestamp(
    history: DataFrame | None,
    incoming: DataFrame,
    keys: list[str],
    updated_at: str,
    run_at: Column,
    close_missing: bool = True,
) -> DataFrame:
    """New version when ``incoming.updated_at`` is newer than the open version.

    Turn ``close_missing`` off for a partial load: a key that is absent from
    ``incoming`` otherwise counts as deleted.
    """
    history = empty_history(incoming) if history is None else history
    still_open = history.where(F.col("valid_to").isNull())
    changes = timestamp_changes(still_open, incoming, keys, updated_at, run_at, close_missing)
    return _with_closed(changes, history, incoming)


def snapshot_by_check(
    history: DataFrame | None,
    incoming: DataFrame,
    keys: list[str],
    check: list[str],
    run_at: Column,
    close_missing: bool = True,
) -> DataFrame:
    """New version only when one of the ``check`` columns changes (NULL-safe)."""
    history = empty_history(incoming) if history is None else history
    still_open = history.where(F.col("valid_to").isNull())
    return _with_closed(check_changes(still_open, incoming, keys, check, run_at, close_missing), history, incoming)


def as_of(facts: DataFrame, history: DataFrame, keys: list[str], at: str, columns: list[str]) -> DataFrame:
    """Facts with the ``columns`` of the version valid at their own time ``at``, NULL where there is none.

    Facts and versions are sorted together by key and time over the whole table, and every fact takes the last
    version before it that its partition holds. What a partition ends with is handed to the next ones, one row per
    key and partition, so no fact is paired with all versions of its key and a key with very many of
    both spans as many tasks as it needs. Versions of a key must not overlap, as those of a history don't; of
    several that start at the same time the one that ends last counts. NULL key parts equal each other, as in
    the history; a fact without a time has no version.
    """
    names = [f"__k{i}" for i in range(len(keys))]
    version = F.struct("valid_to", *[F.col(f"`{c}`") for c in columns])
    carried = T.StructType([history.schema["valid_to"], *[history.schema[c] for c in columns]])
    row = F.struct(*[F.col(f"`{c}`") for c in facts.columns])
    ended = F.coalesce(F.col("valid_to"), F.lit("9999-12-31").cast("timestamp"))
    kind = history.schema["valid_from"].dataType
    versions = history.where("valid_from IS NOT NULL").select(
        *[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)],
        F.col("valid_from").alias("__at"),
        ended.alias("__ended"),  # a version comes before the facts of its first moment
        version.alias("__version"),
        F.lit(None).cast(facts.schema).alias("__fact"),
    )
    asked = facts.select(
        *[F.col(f"`{k}`").cast(history.schema[k].dataType).alias(n) for k, n in zip(keys, names, strict=True)],
        F.col(f"`{at}`").cast(kind).alias("__at"),
        F.lit(None).cast("timestamp").alias("__ended"),
        F.lit(None).cast(carried).alias("__version"),
        row.alias("__fact"),
    )
    order = [*[F.asc_nulls_first(n) for n in names], F.asc_nulls_first("__at"), F.asc_nulls_last("__ended")]
    placed = versions.unionByName(asked).withColumn("__nr", F.monotonically_increasing_id())
    placed = placed.repartitionByRange(*order, "__nr").withColumn("__part", F.spark_partition_id()).drop("__nr")
    placed = written(placed, "as-of")  # the cut into partitions is read several times

    before = Window.partitionBy("__part", *names).orderBy(*order[len(names) :]).rowsBetween(Window.unboundedPreceding, 0)
    placed = placed.withColumn("__last", F.last("__version", ignorenulls=True).over(before))
    # What each partition hands on: its last version of each key. A key has one row per partition that it is in.
    latest = F.max_by("__version", F.struct("__at", "__ended")).alias("__handed")
    ends = placed.where("__version IS NOT NULL").groupBy("__part", *names).agg(latest)
    spans = placed.groupBy("__part", *names).agg(F.count(F.lit(1)).alias("__rows"))
    same = [F.col(f"s.{n}").eqNullSafe(F.col(f"e.{n}")) for n in names]
    spans = spans.alias("s").join(ends.alias("e"), all_of([F.col("s.__part") == F.col("e.__part"), *same]), "left")
    earlier = Window.partitionBy(*[F.col(f"s.{n}") for n in names]).orderBy("s.__part").rowsBetween(Window.unboundedPreceding, -1)
    handed = spans.select(
        F.col("s.__part").alias("__p"),
        *[F.col(f"s.{n}").alias(f"{n}h") for n in names],
        F.last("__handed", ignorenulls=True).over(earlier).alias("__before"),
    ).where("__before IS NOT NULL")

    answered = placed.where("__fact IS NOT NULL").join(
        handed, all_of([F.col("__part") == F.col("__p"), *[F.col(n).eqNullSafe(F.col(f"{n}h")) for n in names]]), "left"
    )
    found = F.coalesce("__last", "__before")
    valid = F.col("__at").isNotNull() & (found["valid_to"].isNull() | (F.col("__at") < found["valid_to"]))
    return answered.select("__fact.*", F.when(valid, found).alias("__found")).select(
        *[F.col(f"`{c}`") for c in facts.columns], *[F.col(f"__found.`{c}`").alias(c) for c in columns]
    )
