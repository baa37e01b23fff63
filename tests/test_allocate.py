from decimal import Decimal as D

from ledgerlark.operators.allocate import allocate_proportional


def test_last_row_takes_the_residual(frame, rows):
    lines = frame(
        [("g", 1, D("1")), ("g", 2, D("1")), ("g", 3, D("1")), ("h", 1, D("5")), ("i", 1, D("0"))],
        "g string, n int, w decimal(10,2)",
    )
    totals = frame([("g", D("10.00")), ("h", D("7.77")), ("i", D("1.00"))], "g string, total decimal(10,2)")
    got = allocate_proportional(lines, totals, ["g"], "w", "total", ["n"])
    assert rows(got, "g", "n", "allocated") == [
        ("g", 1, D("3.33")), ("g", 2, D("3.33")), ("g", 3, D("3.34")), ("h", 1, D("7.77")), ("i", 1, D("1.00"))
    ]


def test_null_groups_and_zero_weights_lose_nothing(frame, rows):
    lines = frame(
        [(None, 1, 1.0), (None, 2, 3.0), ("z", 1, 0.0), ("z", 2, 0.0), ("n", 1, None), ("n", 2, None), ("x", 1, 1.0)],
        "g string, n int, w double",
    )
    totals = frame([(None, D("8.00")), ("z", D("50.00")), ("n", D("3.00"))], "g string, total decimal(10,2)")
    got = rows(allocate_proportional(lines, totals, ["g"], "w", "total", ["n"]), "g", "n", "allocated")
    assert got == sorted(
        [(None, 1, D("2.00")), (None, 2, D("6.00")), ("z", 1, D("0.00")), ("z", 2, D("50.00")), ("n", 1, D("0.00")),
         ("n", 2, D("3.00")), ("x", 1, None)], key=repr
    )
