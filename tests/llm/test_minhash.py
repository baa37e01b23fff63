"""Near-duplicates against brute force over all pairs."""

import math
import random
import re
from fractions import Fraction
from pathlib import Path

import duckdb
import pytest

from ledgerlark.llm import minhash, queries
from ledgerlark.llm.graph import components

SCHEMA = "doc_id bigint, text string, n_shingles string, component_id string, kept string, v string"


def plain_sets(text, size):
    words = re.findall("[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return set()
    return {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def plain(rows, size, percent):
    sets = [(i, plain_sets(t, size)) for i, t in rows]
    parent = {i: i for i, _ in rows if i is not None}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= percent * len(a | b):
                low, high = sorted((root(i), root(j)))
                parent[high] = low
    return sorted((i, len(s), root(i), i == root(i)) for i, s in sets if i is not None)


def ours(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "a", "b", "c", "d") for i, t in rows], SCHEMA)
    return sorted(tuple(r) for r in minhash.near_duplicates(df, **options).collect() if r.doc_id is not None)


def corpus(rng, n_base=12, copies=12):
    """Groups of copies with few or many changes, a shared passage, chains, and odd rows."""
    words = [f"w{i}" for i in range(400)]
    passage = [rng.choice(words) for _ in range(60)]
    rows = []
    for _ in range(n_base):
        base = [rng.choice(words) for _ in range(rng.randrange(5, 220))]
        if rng.random() < 0.6:
            base = base[: len(base) // 2] + passage + base[len(base) // 2 :]
        for _ in range(rng.randrange(1, copies)):
            text = list(base)
            for _ in range(rng.choice([0, 0, 1, 2, 4, 8])):
                text[rng.randrange(len(text))] = rng.choice(words)
            rows.append(" ".join(text).upper() if rng.random() < 0.2 else "\n".join(text))
    chain = [rng.choice(words) for _ in range(100)]
    for _ in range(25):
        rows.append(" ".join(chain))
        chain = [*chain[4:], *[rng.choice(words) for _ in range(4)]]
    rows += [None, "", " \t", "one", "ONE", "one two", "é", "x " * 5000, "x " * 5000 + "y"]
    rng.shuffle(rows)
    ids = rng.sample(range(-50, 5000), len(rows))
    return list(zip(ids, rows, strict=True))


@pytest.mark.parametrize(("seed", "size", "percent"), [(1, 3, 85), (2, 5, 80)])
def test_against_all_pairs(spark, seed, size, percent):
    rows = corpus(random.Random(seed))
    rows += [rows[0], rows[1], (None, rows[2][1])]
    assert ours(spark, rows, size=size, percent=percent) == plain(rows, size, percent)


def test_chosen_pairs_alone_are_enough(spark, monkeypatch):
    """The same components when star rounds do nearly all the work and when they do little."""
    rows = corpus(random.Random(4), n_base=4, copies=30)
    monkeypatch.setattr(minhash, "STAR_ROUNDS", 1)
    assert ours(spark, rows, size=3, percent=85) == plain(rows, 3, 85)


def relatives(rng, families=6, members=7, length=900):
    """Long texts that share most of their words in one or two stretches: similarities from 0.6 to 0.95."""
    rows = []
    for f in range(families):
        base = [f"f{f}x{rng.randrange(10**6)}" for _ in range(length)]
        for m in range(members):
            own = int(length * rng.choice([0.01, 0.03, 0.05, 0.08, 0.12, 0.16, 0.2]))
            at = rng.randrange(length - own)
            text = [*base[:at], *[f"f{f}m{m}x{i}" for i in range(own)], *base[at + own :]]
            rows.append((100 * f + m, " ".join(text)))
    rng.shuffle(rows)
    return rows


def test_long_relatives_around_the_threshold(spark):
    """Sets beyond a long sketch, most pairs just too different to be links."""
    rows = relatives(random.Random(8))
    expected = plain(rows, 3, 85)
    assert ours(spark, rows, size=3, percent=85) == expected
    assert 6 < len({c for _, _, c, _ in expected}) < len(rows)


def test_a_pair_is_made_once(spark):
    """In the list of its first shared value, and repeats of a list lose no pair."""
    rng = random.Random(3)
    rows, values = [], [rng.randrange(-(2**62), 2**62) for _ in range(120)]
    for cls in range(40):
        listed = sorted(rng.sample(range(120), 30)) if cls % 3 else list(range(cls, cls + 30))
        rows += [(values[v], cls, 100, place + 1, cls, True) for place, v in enumerate(listed)]
    lists = spark.createDataFrame(rows, "v bigint, cls bigint, n bigint, place int, comp bigint, minor boolean")
    plain_pairs = {(a[1], b[1]) for a in rows for b in rows if a[0] == b[0] and a[1] < b[1]}
    kept = minhash.first_meetings(lists).collect()
    by = {}
    for r in kept:
        by.setdefault(r.v, []).append(r)
    made = [(a.cls, b.cls) for m in by.values() for a in m for b in m if a.cls < b.cls and not set(a.prior) & set(b.prior)]
    assert len(made) == len(set(made)) and set(made) == plain_pairs
    assert {tuple(r) for r in minhash.other_pairs(lists, 512, 1).collect()} <= plain_pairs


def test_scratch_tables_of_past_turns_are_removed(spark):
    shared = Path(spark.conf.get("spark.checkpoint.dir"))
    before = {p.name for p in shared.iterdir()}
    rows = relatives(random.Random(2), families=3)
    assert ours(spark, rows, size=3, percent=85) == plain(rows, 3, 85)
    left = [p.name.rsplit("-", 1)[0] for p in shared.iterdir() if p.name not in before]
    assert left.count("near-components") <= 1 and "near-classes" in left
    assert not {"near-open", "near-pairs", "near-likely", "near-sets", "near-lists"} & set(left)


@pytest.mark.parametrize(("k", "percent"), [(32, 85), (32, 80), (512, 85), (512, 80)])
def test_the_bound_keeps_the_stated_error(k, percent):
    def tail(m):  # fewer than m shared values
        return sum(math.comb(k, i) * Fraction(percent, 100) ** i * Fraction(100 - percent, 100) ** (k - i) for i in range(m))

    m = minhash.least_shared(k, percent)
    assert tail(m) <= Fraction(1, 10**12) < tail(m + 1)


def test_rows_without_ids_and_empty_tables(spark):
    assert ours(spark, []) == []
    df = spark.createDataFrame([(None, "a b c", "", "", "", ""), (None, None, "", "", "", "")], SCHEMA)
    assert sorted(tuple(r) for r in minhash.near_duplicates(df).collect()) == [(None, 0, None, True), (None, 1, None, True)]
    assert ours(spark, [(1, None), (2, "")]) == [(1, 0, 1, True), (2, 0, 2, True)]


def test_an_id_with_several_texts(spark):
    text = {k: " ".join(f"{k}{i}" for i in range(30)) for k in "ab"}
    out = ours(spark, [(5, text["a"]), (5, text["b"]), (3, text["a"]), (9, text["b"])], size=3, percent=85)
    assert {(i, c) for i, _, c, _ in out} == {(5, 3), (3, 3), (9, 3)}


def test_components(spark):
    rng = random.Random(9)
    links = [(i, i + 1) for i in range(300)] + [(1000, 1000 + i) for i in range(1, 200)] + [(7, 7)]
    links += [(rng.randrange(2000, 2100), rng.randrange(2000, 2100)) for _ in range(60)]
    rng.shuffle(links)
    got = dict(components(spark.createDataFrame(links, "a bigint, b bigint")).collect())
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i

    for a, b in links:
        low, high = sorted((root(a), root(b)))
        parent[high] = low
    assert got == {i: root(i) for a, b in links if a != b for i in (a, b)}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW documents AS SELECT * FROM '/root/testdata/sf0.001/documents.parquet'")
    df = queries.QUERIES["op8_minhash"](spark, "/root/testdata/sf0.001")
    cursor = con.execute(queries.ORACLES["op8_minhash"])
    assert df.columns == [d[0] for d in cursor.description]
    assert sorted(map(tuple, df.collect())) == sorted(cursor.fetchall())


def test_whole_sketches_decide_without_the_full_sets(spark, rows):
    from ledgerlark.llm.common import Scratch

    held = [(1, 8, list(range(8)), None), (2, 8, [0, 1, 2, 3, 4, 5, 6, 9], None), (3, 8, [0, 1, 2, 3, 20, 21, 22, 23], None)]
    held += [(4, 20, list(range(100, 116)), list(range(100, 120))), (5, 21, list(range(100, 116)), list(range(100, 121)))]
    sets = spark.createDataFrame(held, "cls bigint, n bigint, sketch array<bigint>, set array<bigint>")
    pairs = spark.createDataFrame([(1, 2), (1, 3), (2, 3), (4, 5), (1, 4)], "a bigint, b bigint")
    links = minhash.confirmed(pairs, sets, 16, 75, Scratch(spark))
    assert rows(links, "a", "b") == [(1, 2), (4, 5)]


def test_few_pairs_pick_the_sets_that_are_shuffled(spark, executed, tmp_path, monkeypatch):
    """Sets that are in no pair stay where they are, and the rows are those of the plain joins."""
    sets = spark.createDataFrame([(i, 600, [i, i + 1]) for i in range(60)], "cls bigint, n bigint, sketch array<bigint>")
    spark.createDataFrame([(1, 2), (1, 3), (4, 3)], "a bigint, b bigint").write.parquet(str(tmp_path / "pairs"))
    pairs = spark.read.parquet(str(tmp_path / "pairs"))
    few = minhash.met_sets(pairs, sets, sets.sketch)
    assert "LeftSemi" in executed(few)
    monkeypatch.setattr(minhash, "SENT_ROWS", 2)
    many = minhash.met_sets(pairs, sets, sets.sketch)
    assert "LeftSemi" not in executed(many)
    expected = [(1, 2, [1, 2], [2, 3]), (1, 3, [1, 2], [3, 4]), (4, 3, [4, 5], [3, 4])]
    for met in (few, many):
        assert sorted((r.a, r.b, r.sa, r.sb) for r in met.collect()) == expected


def test_full_sets_meet_only_where_a_long_one_can_be_alike(spark, tmp_path, monkeypatch):
    """One of 512 hashes at 85 % needs a partner of 436 at least; smaller sets are not read for their full values."""
    def row(cls, n):
        return (cls, n, list(range(min(n, 512))), list(range(n)) if n > 512 else None)

    spark.createDataFrame(
        [row(1, 600), row(2, 520), row(3, 500), row(4, 436), row(5, 435), row(6, 400)],
        "cls bigint, n bigint, sketch array<bigint>, set array<bigint>",
    ).write.parquet(str(tmp_path / "sets"))
    sets = spark.read.parquet(str(tmp_path / "sets"))
    pairs = spark.createDataFrame([(a, b) for a in range(1, 7) for b in range(a + 1, 7)], "a bigint, b bigint")
    read, plain_join = [], minhash.met_sets
    monkeypatch.setattr(minhash, "met_sets", lambda p, s, v: read.append(s.count()) or plain_join(p, s, v))
    found = {(r.a, r.b) for r in minhash.confirmed(pairs, sets, 512, 85, minhash.Scratch(spark)).collect()}
    size = {1: 600, 2: 520, 3: 500, 4: 436, 5: 435, 6: 400}
    assert found == {(a, b) for a in size for b in size if a < b and 100 * size[b] >= 85 * size[a]}
    assert read == [6, 4]


@pytest.mark.parametrize("values", [1 << 19, 200])
def test_dense_lists_move_every_set_once_per_part_and_not_once_per_pair(spark, monkeypatch, values):
    rng = random.Random(4)
    base = rng.sample(range(-10_000, 10_000), 40)

    def held(cls):
        kept = {x if rng.random() < 0.93 else rng.randrange(10**6) for x in base[: rng.choice([14, 40])]}
        return (cls, len(kept), sorted(kept)[:16], sorted(kept) if len(kept) > 16 else None)

    # Class 7 has two sets, and the classes from 40 on are in a sparse list.
    sets = spark.createDataFrame(
        [held(c) for c in [*range(50), 7]], "cls bigint, n bigint, sketch array<bigint>, set array<bigint>"
    )
    pairs = [(a, b, 1) for a in range(40) for b in range(a + 1, 40)] + [(40, b, 2) for b in range(41, 50)] + [(3, 99, 1)]
    pairs = spark.createDataFrame(pairs, "a bigint, b bigint, v bigint")
    plainly = minhash.confirmed(pairs.select("a", "b"), sets, 16, 75, minhash.Scratch(spark)).collect()

    single, plain_join, moved, plain_blocks = [], minhash.met_sets, [], minhash.block_pairs
    monkeypatch.setattr(minhash, "BLOCK_PAIRS", 0)
    monkeypatch.setattr(minhash, "BLOCK_VALUES", values)
    monkeypatch.setattr(minhash, "met_sets", lambda p, s, v: single.append(p.collect()) or plain_join(p, s, v))
    monkeypatch.setattr(minhash, "block_pairs", lambda d, *x: moved.append(d.collect()) or plain_blocks(d, *x))
    links = minhash.confirmed(pairs, sets, 16, 75, minhash.Scratch(spark)).collect()
    assert sorted(links) == sorted(plainly) and 0 < len(links) < 700
    assert {r.v for r in single[0]} == {2}
    assert {(r.a, r.b) for r in moved[0]} == {(a, b) for a in range(40) for b in range(a + 1, 40)} | {(3, 99)}
    for dense in moved:
        assert len({(r.block, c) for r in dense for c in (r.a, r.b)}) < len(dense)


@pytest.mark.parametrize(("long_k", "values"), [(512, 1 << 19), (512, 300), (64, 300)])
def test_blocks_against_all_pairs(spark, monkeypatch, long_k, values):
    rows = corpus(random.Random(1), n_base=6)
    rows += [rows[0], rows[1], (rows[2][0], rows[3][1]), (None, rows[2][1])]
    rng, base = random.Random(8), [f"b{i}" for i in range(150)]
    rows += [(9000 + i, " ".join(w if rng.random() < 0.975 else f"n{rng.random()}" for w in base)) for i in range(60)]
    used, plain_blocks = [], minhash.block_pairs
    monkeypatch.setattr(minhash, "BLOCK_PAIRS", 0)
    monkeypatch.setattr(minhash, "BLOCK_VALUES", values)
    monkeypatch.setattr(minhash, "DENSE", 0)
    monkeypatch.setattr(minhash, "block_pairs", lambda d, *x: used.append(d.count()) or plain_blocks(d, *x))
    assert ours(spark, rows, size=3, percent=85, long_k=long_k) == plain(rows, 3, 85)
    assert used and max(used) > 20
