"""Conversation repair against a plain recursion."""

import hashlib
import random
import re
import sys
import zlib
from functools import lru_cache
from itertools import product

import duckdb
import pytest
from pyspark.sql import functions as F

from ledgerlark.llm import queries, repair

SCHEMA = "conv_id bigint, turn bigint, role string, text string, audit string, spot string"
SPACE = " \t\n\v\f\r"


def plain_faults(rows):
    seen, out = set(), []
    for role, text in rows:
        said = text.rstrip(SPACE)
        if not said:
            out.append("blank")
        elif (role, text) in seen:
            out.append("duplicate")
        else:
            out.append("truncated" if said[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def plain_repair(rows):
    """Least (cost, audit), and the repaired turns, by trying every edit."""
    faults = plain_faults(rows)
    after = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i, state, inserted):
        ways = []
        if i == len(rows) and state in ("", "a"):
            ways.append((0, "", ()))
        if inserted < 3:
            cost, audit, said = best(i, after[state], inserted + 1)
            ways.append((cost + 3, "I" + audit, (("user" if after[state] == "u" else "assistant", ""), *said)))
        if i < len(rows):
            role, text = rows[i]
            more = 3 if faults[i] == "truncated" else 0
            cost, audit, said = best(i + 1, state, 0)
            ways.append((cost + 4, "D" + audit, said))
            if faults[i] in ("", "truncated"):
                initial = role[:1]
                if initial and (initial == after[state] or (initial == "s" and state == "")):
                    cost, audit, said = best(i + 1, initial, 0)
                    ways.append((cost + more, "K" + audit, (rows[i], *said)))
                cost, audit, said = best(i + 1, after[state], 0)
                made = "user" if after[state] == "u" else "assistant"
                ways.append((cost + more + 3, "R" + audit, ((made, text), *said)))
        return min(ways, default=(10**9, "", ()))

    return best(0, "", 0)


def plain(rows):
    """The report of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    said = [r[1:] for r in rows]
    faults = plain_faults(said)
    turns = [t for t, _, _ in rows if t is not None]
    illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:], strict=False))
    cost, audit, out = plain_repair(tuple(said))
    digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def ours(spark, rows):
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    fixed = repair.Repair(df)
    hashes = {r.conv_id: r.repaired_sha256 for r in repair.digests(fixed.turns).collect()}
    empty = hashlib.sha256(b"").hexdigest()
    return {
        r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, hashes.get(r.conv_id, empty))
        for r in fixed.conversations.collect()
    }


def by_conversation(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        out.setdefault(conv_id, []).append((turn, role or "", text or ""))
    return {c: plain(r) for c, r in out.items()}


def made_rows(seed, conversations, longest):
    rng = random.Random(seed)
    texts = ["Yes.", "No", " ", "", "Why?\n", "Well, then", "Ok!", "Ünï.", "\x85.", "a\x00b"]
    rows = []
    for c in range(conversations):
        at = 0
        for _ in range(rng.randint(1, longest)):
            at += rng.choice([0, 1, 1, 1, 2])
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "us", "User"])
            rows.append((c, None if rng.random() < 0.05 else at, role, rng.choice(texts)))
    return rows


def test_against_plain_recursion(spark):
    rows = made_rows(1, 250, 9)
    rows += [(None, t, r, x) for t, r, x in [(None, "user", "Hi."), (1, None, None), (1, "assistant", "So."), (1, "assistant", "So.")]]
    rows += [(10**15, 2**40, "user", "A."), (10**15, -(2**40), "user", "B.")]
    assert ours(spark, rows) == by_conversation(rows)


def test_all_short_sequences_of_symbols():
    """Every sequence of up to four symbols: cost by matrix powers, audit by unrolling."""
    names = ["system", "user", "assistant", "other"]
    text = {0: "x{}.", 1: "x{}", 3: " "}
    for n in range(5):
        for symbols in product([4 * r + f for r in range(4) for f in (0, 1, 3)], repeat=n):
            if n == 4 and random.Random(hash(symbols)).random() > 0.05:
                continue
            rows = tuple((names[s >> 2], text[s & 3].format(i)) for i, s in enumerate(symbols))
            cost, audit, _ = plain_repair(rows)
            runs = []
            for s in symbols:
                if runs and runs[-1][0] == s:
                    runs[-1] = (s, runs[-1][1] + 1)
                else:
                    runs.append((s, 1))
            assert repair._applied(repair.run_matrix(tuple(runs)), repair.ENDS)[repair.START] == cost
            if n:
                ((_, _, edits, roles),) = repair.unrolled(runs, repair.ENDS, True, [repair.START])
                assert "".join(edits) == audit and list(map(len, edits)) == list(map(len, roles))


def test_powers_of_long_runs():
    for symbol in range(16):
        step = power = repair.transition(symbol)
        for _ in range(36):
            power = repair._times(power, step)
        assert (repair.run_matrix(((symbol, 37),)) == power).all()
    assert repair._applied(repair.run_matrix(((4, 10**12),)), repair.ENDS)[0] == 3 * 10**12 // 2  # every second user is reroled


def test_conversations_over_many_partitions(spark):
    """A conversation with most of the rows is cut into sections, and equal rows are dealt out."""
    rng = random.Random(5)
    rows = made_rows(2, 40, 6)
    for t in range(700):
        rows.append((99, t, rng.choice(["user", "assistant", "assistant", "system", "tool"]), rng.choice([f"t{t}.", f"t{t}", " ", "Same."])))
    rows += [(98, 1, "user", "Copy.")] * 300 + [(98, 2, "assistant", "End.")]
    rows += [(97, None, "user", "Copy.")] * 100
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(6)
        fixed = repair.Repair(df)
        sections = fixed.edits.groupBy("conv_id").count().where("conv_id >= 98").collect()
        assert all(r["count"] > 1 for r in sections) and len(sections) == 2
        got = {r.conv_id: (r.cost, r.audit, r.gaps, r.illegal, r.duplicate) for r in fixed.conversations.collect()}
        digests = {r.conv_id: r.repaired_sha256 for r in repair.digests(fixed.turns).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sys.setrecursionlimit(10_000)
    for c, p in by_conversation(rows).items():
        assert got[c] == (p[5], p[6], p[0], p[4], p[2]), c
        assert digests.get(c, hashlib.sha256(b"").hexdigest()) == p[7], c


def test_damage(spark):
    rows = [(c, t, r, x) for c in range(60) for t, r, x in [(0, "system", "Be. Good!"), (1, None, "Eh?"), (None, "assistant", None)]]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows + [(None, None, None, None)]], SCHEMA)
    expected = []
    for c, t, r, x in rows + [(None, None, None, None)]:
        r, x = " " if r is None else r, " " if x is None else x
        d = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        x = "" if d == 1 else re.sub("[.!?]", "", x) if d == 2 else x
        expected += [(c, t, "user" if d == 4 else r, x)] * (0 if d == 0 else 2 if d == 3 else 1)
    assert sorted(map(tuple, repair.damage(df).collect()), key=repr) == sorted(expected, key=repr)


def test_edges(spark):
    assert ours(spark, []) == {}
    assert repair.damage(spark.createDataFrame([], SCHEMA)).count() == 0
    long = "word " * 200_000
    rows = [(1, 0, "user", long), (1, 1, "assistant", long + "."), (2, 0, "u", "　"), (2, 1, "assistant", "x.")]
    assert ours(spark, rows) == by_conversation(rows)


@pytest.mark.parametrize("scale", ["sf0.001", "sf0.01"])
def test_query_matches_sql_and_recursion(spark, scale):
    folder = f"/root/testdata/{scale}"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    df = queries.QUERIES["op11_repair"](spark, folder)
    cursor = con.execute(queries.ORACLES["op11_repair"])
    assert df.columns == [d[0] for d in cursor.description]
    got = sorted(map(tuple, df.collect()))
    assert got == sorted(cursor.fetchall())
    damaged = repair.damage(spark.read.parquet(f"{folder}/conversations.parquet"))
    expected = by_conversation(map(tuple, damaged.collect()))
    assert {r[0]: r[1:] for r in got if r[0] in expected} == expected
    assert all(r[1:7] == (0,) * 6 and r[7] == "" for r in got if r[0] not in expected)


def test_every_conversation_is_returned(spark, tmp_path):
    """Also those that lose all their rows, and the one without an id."""
    gone = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    rows = [(gone, 0, "user", "Hi."), (None, 5, "user", "Hi."), (gone + 1, 3, "assistant", None)]
    spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    out = queries.QUERIES["op11_repair"](spark, str(tmp_path))
    got = {r.conv_id: r for r in out.collect()}
    assert set(got) == {gone, gone + 1, None}
    r = got[gone]
    assert tuple(r)[1:7] == (0,) * 6 and r.audit == "" and r.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    assert sorted(map(tuple, got.values()), key=repr) == sorted(con.execute(queries.ORACLES["op11_repair"]).fetchall(), key=repr)
    assert out.where(F.col("conv_id").isNull()).count() == 1
