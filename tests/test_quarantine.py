"""Quarantined keys between runs."""

from pyspark.sql import functions as F

from ledgerlark.operators.quarantine import QuarantineTable, fingerprint
from ledgerlark.session import scratch_path


def keys(spark, **sources):
    return spark.createDataFrame([(s, str(k)) for s, some in sources.items() for k in some], "source string, key string")


def checked(spark, **status):
    return spark.createDataFrame(list(status.items()), "source string, status string")


def told(report):
    return {r.source: tuple(r)[1:] for r in report.collect()}


def test_runs(spark, rows):
    table = QuarantineTable(spark, scratch_path(spark, "quarantine"))
    none = checked(spark, x="pass")
    assert told(table.record(keys(spark, a=[1, 2, 2], b=[3], c=[4, 5], d=[6]), none)) == {
        "a": (0, 2, 2, "opened", False), "b": (0, 1, 1, "opened", False), "c": (0, 2, 2, "opened", False), "d": (0, 1, 1, "opened", False)
    }
    second = keys(spark, a=[2, 1], c=[5, 7, 8])
    assert told(table.record(second, checked(spark, a="warn", b="pass", c="warn"))) == {
        "a": (2, 2, 0, "refreshed", False), "b": (1, 0, 1, "resolved", False), "c": (2, 3, 3, "changed", True), "d": (1, 0, 1, "unchanged", False)
    }
    assert rows(table.read(), "source", "key") == [("a", "1"), ("a", "2"), ("c", "5"), ("c", "7"), ("c", "8"), ("d", "6")]
    assert told(table.record(second.unionByName(second), none)) == {
        "a": (2, 2, 0, "refreshed", False), "c": (3, 3, 0, "refreshed", False), "d": (1, 0, 1, "unchanged", False)
    }
    table.expire()
    assert rows(table.read(), "source") == [("a",)] * 2 + [("c",)] * 3 + [("d",)]
    assert told(table.record(keys(spark), checked(spark, a="pass", c="fail", d="pass"))) == {
        "a": (2, 0, 2, "resolved", False), "c": (3, 0, 3, "unchanged", False), "d": (1, 0, 1, "resolved", False)
    }
    assert rows(table.read(), "source") == [("c",)] * 3


def test_fingerprints(spark):
    def of(some):
        return spark.createDataFrame([(x,) for x in some], "k string").agg(fingerprint("k")).first()[0]

    assert of("abc") == of("cab") and len({of(x) for x in ("abc", "abd", "ab", "aabc", "")}) == 5
    many = spark.range(100_000).select(F.col("id").cast("string").alias("k"))
    assert many.agg(fingerprint("k")).first() == many.repartition(7).agg(fingerprint("k")).first()
