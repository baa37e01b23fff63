"""What the corpus operators share."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from ledgerlark.session import delete_path, scratch_path, written

__all__ = ["Scratch", "batch_slices", "per_text", "sent_along", "slices", "table", "with_struct", "written"]

#: Rows of two or three integers that may be sent to every executor: some tens of MB.
SENT_ROWS = 500_000
#: Bytes of text that a Python worker takes out of a batch at a time.
SLICE = 2 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


class Scratch:
    """Tables that are written anew turn by turn: storing one under a name removes the one before.

    The table before may still be read while the new one is written, and not afterwards.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[str, str] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        self.drop(name)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            if path := self.paths.pop(name, None):
                delete_path(self.spark, path)


def sent_along(stored: DataFrame, rows: int | None = None) -> DataFrame:
    """A stored table of ids, marked to be sent to all executors if it is counted to be small.

    Beyond the bound the join is left to the planner, which shuffles both sides by key.
    """
    return F.broadcast(stored) if stored.count() <= (SENT_ROWS if rows is None else rows) else stored


def slices(texts: Iterator[pa.Array]) -> Iterator[list[bytes]]:
    """The texts of all batches as bytes, about ``SLICE`` bytes at a time and one text at least; NULL is empty.

    A batch holds 10,000 rows whatever their length, and what is made of them is larger still.
    """
    for text in texts:
        text = text.cast(pa.binary())
        ends = np.cumsum(pc.binary_length(text).fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < len(text):
            past = ends[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(ends, past + SLICE)))
            yield [x or b"" for x in text.slice(at, stop - at).to_pylist()]
            at = stop


def per_text(make: Callable[[], Callable[[bytes], tuple]], returns: str) -> Callable[[Column], Column]:
    """A column function that maps each UTF-8 text to a struct, a slice of rows at a time.

    ``make()`` runs once for every task and gives the function of one text; NULL counts
    as an empty text. ``returns`` is a DDL list of the struct's fields. The function counts
    as non-deterministic, or the optimizer would copy it into every filter on its result,
    below joins even, and run it twice.
    """
    schema = StructType.fromDDL(returns)
    kind = to_arrow_type(schema)

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        one = make()
        names = schema.names
        for some in slices(texts):
            yield pa.array([dict(zip(names, one(x), strict=True)) for x in some], kind)

    batches.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, schema).asNondeterministic()


def with_struct(df: DataFrame, column: Column, names: Iterable[str]) -> DataFrame:
    """``df`` with the fields of a struct as columns, replacing columns of the same name."""
    names = list(names)
    lowered = {n.lower() for n in names}
    kept = [F.col(f"`{c}`") for c in df.columns if c.lower() not in lowered]
    inner = df.select(*kept, column.alias("__out"))
    return inner.select(*kept, *[F.col(f"__out.{n}").alias(n) for n in names])


def batch_slices(batch: pa.RecordBatch, column: int) -> Iterator[pa.RecordBatch]:
    """A batch in runs of rows of about ``SLICE`` bytes of one text or binary column, one row at least."""
    held = pc.binary_length(batch.column(column)).fill_null(0)
    ends = np.cumsum(held.to_numpy(zero_copy_only=False).astype(np.int64))
    at = 0
    while at < batch.num_rows:
        past = ends[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(ends, past + SLICE)))
        yield batch.slice(at, stop - at)
        at = stop
