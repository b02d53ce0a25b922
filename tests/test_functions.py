from __future__ import annotations

import random
from decimal import ROUND_HALF_UP, Context, Decimal, localcontext

import pytest
from pyspark.sql import functions as F

from clickloom import functions as fn


@pytest.fixture
def evaluate(spark):
    """Values of an expression over one text column."""

    def run(expression, *values, kind="string"):
        rows = spark.createDataFrame(
            list(enumerate(values)), f"i int, v {kind}"
        ).orderBy("i")
        return [r[0] for r in rows.select(expression(F.col("v"))).collect()]

    return run


def test_empty(evaluate):
    assert evaluate(fn.is_empty, None, "", "a", " ") == [True, True, False, False]
    assert evaluate(fn.is_not_empty, None, "", "a") == [False, False, True]


def test_trim_comma(evaluate):
    given = [",a,", "a,,", ",,a", "a", ",", ",,", "", None]
    assert evaluate(fn.trim_comma, *given) == ["a", "a,", ",a", "a", "", "", "", None]


def test_pad_two(evaluate):
    assert evaluate(fn.pad_two, "5", "12", "123", "") == ["05", "12", "0123", "0"]


def test_packed_get(evaluate):
    record = "a=|b=1=2|c=3=|d=4|d=5"
    for field, value in {"a": None, "b": None, "c": "3", "d": "4", "e": None}.items():
        assert evaluate(lambda c, f=field: fn.packed_get(c, f), record) == [value]
    assert evaluate(lambda c: fn.packed_get(c, "a"), None, "", "a=1|", "|a=1") == [
        None,
        None,
        "1",
        "1",
    ]


def test_packed_set(evaluate):
    set_b = lambda c: fn.packed_set(c, "b", "9")
    assert evaluate(set_b, "a=1|b=2|c=3", "b=|b=2", "a=1", "b|a=1||", "a=b") == [
        "a=1|b=9|c=3",
        "b=9|b=2",
        "a=1",
        "b=9|a=1",
        "a=b",
    ]
    odd = lambda c: fn.packed_set(c, "b", F.lit("$1\\x"))
    assert evaluate(odd, "bb=1|b=2=3|c=", None) == ["bb=1|b=$1\\x|c=", None]
    dotted = lambda c: fn.packed_get(c, "a.b")
    assert evaluate(dotted, "axb=1|a.b=2|a.b=3") == ["2"]


def test_split_list(evaluate):
    assert evaluate(fn.split_list, "1,2,", ",1", "3,3", "", ",", None) == [
        ["1", "2"],
        ["1"],
        ["3", "3"],
        [],
        [],
        None,
    ]


def test_lists_overlap(evaluate):
    overlap = lambda c: fn.lists_overlap(c, ["a", "b"])
    assert evaluate(overlap, "b,c", "c", "", None, "ab") == [True, False, False, False, False]
    assert evaluate(lambda c: fn.lists_overlap(c, []), "a") == [False]
    odd = lambda c: fn.lists_overlap(c, ["", "a,b", "c"])
    assert evaluate(odd, "", "a,b", ",", "b,c,", "c") == [False, False, False, True, True]


def test_parse_and_format_time(evaluate):
    both = lambda c: fn.format_time(fn.parse_time(c))
    given = ["2024-01-01 9:05:07", "2024-01-01 09:05:07", "2024-01-01", "x", None]
    assert evaluate(both, *given) == [
        "2024-01-01 09:05:07",
        "2024-01-01 09:05:07",
        None,
        None,
        None,
    ]


def test_time_keys(evaluate):
    at = "2018-03-22 5:06:07"
    assert evaluate(lambda c: fn.date_hour(fn.parse_time(c)), at) == ["2018-03-22_05"]
    assert evaluate(lambda c: fn.day_key(fn.parse_time(c)), at) == ["20180322"]
    assert evaluate(lambda c: fn.minute_key(fn.parse_time(c)), at) == ["201803220506"]
    assert evaluate(lambda c: fn.format_date(fn.parse_time(c)), at) == ["2018-03-22"]
    read_back = lambda c: fn.format_date(fn.parse_day_key(c))
    assert evaluate(read_back, "20180322", "2018", None) == ["2018-03-22", None, None]


def test_minute_of_epoch_millis(evaluate):
    at = lambda c: F.array(*fn.split_minute_key(fn.minute_key(F.timestamp_millis(c))))
    assert evaluate(at, 1521763200123, kind="long") == [["2018-03-23", "00", "00"]]


def test_comparisons(spark):
    rows = spark.createDataFrame(
        [
            (0, "2024-01-01 9:00:00", "2024-01-01 10:00:00"),
            (1, "2024-01-01 10:00:00", "2024-01-01 9:00:00"),
            (2, "2024-01-01 10:00:00", "2024-01-01 10:00:00"),
            (3, "x", "2024-01-01 10:00:00"),
            (4, None, None),
        ],
        "i int, a string, b string",
    ).orderBy("i")
    a, b = F.col("a"), F.col("b")
    got = rows.select(fn.is_before(a, b), fn.is_after(a, b), fn.seconds_between(a, b)).collect()
    assert [tuple(r) for r in got] == [
        (True, False, -3600),
        (False, True, 3600),
        (False, False, 0),
        (False, False, 0),
        (False, False, 0),
    ]


def test_today_and_yesterday(spark):
    row = spark.range(1).select(
        (fn.today() == F.date_format(F.current_date(), "yyyy-MM-dd")),
        F.datediff(fn.today().cast("date"), fn.yesterday().cast("date")),
    ).first()
    assert tuple(row) == (True, 1)


def test_ratio_half_up(spark):
    cases = {(57, 200): 0.29, (1, 3): 0.33, (2, 3): 0.67, (1, 8): 0.13, (0, 5): 0.0, (5, 5): 1.0}
    rows = spark.createDataFrame(list(cases), "n long, d long")
    got = {(r.n, r.d): r.x for r in rows.select(
        "n", "d", fn.ratio_half_up(F.col("n"), F.col("d")).alias("x")
    ).collect()}
    assert got == cases
    empty = spark.createDataFrame([(0, 0)], "n long, d long")
    assert empty.select(fn.ratio_half_up(F.col("n"), F.col("d"))).first()[0] is None


def test_round_half_up_is_exact(evaluate):
    draw = random.Random(3)
    values = [n / 1000 for n in range(0, 1000, 5)] + [-0.285, -0.125, 0.125, 2.5, 1e6 + 0.005]
    values += [draw.uniform(-1000, 1000) for _ in range(300)]
    expected = [
        float(Decimal(v).quantize(Decimal("0.01"), rounding=ROUND_HALF_UP)) for v in values
    ]
    assert evaluate(lambda c: fn.round_half_up(c, 2), *values, kind="double") == expected
    assert evaluate(lambda c: fn.round_half_up(c, 2), 0.285, kind="double") == [0.28]


def test_round_half_up_of_large_values(evaluate):
    draw = random.Random(4)
    values = [1e20, 1e300, 12345678901234567.0, 45035996273704.9609375, 2.0**52 / 100]
    for power in range(8, 60):
        values += [draw.uniform(1, 10) * 10**power / 1e3 for _ in range(6)]
    values += [-v for v in values]
    with localcontext(Context(prec=400)):
        for scale in (0, 2, 4):
            step = Decimal(1).scaleb(-scale)
            want = [float(Decimal(v).quantize(step, rounding=ROUND_HALF_UP)) for v in values]
            assert evaluate(lambda c: fn.round_half_up(c, scale), *values, kind="double") == want


def test_round_half_up_of_no_numbers(evaluate):
    values = [float("inf"), float("-inf"), float("nan"), None]
    got = evaluate(lambda c: fn.round_half_up(c, 2), *values, kind="double")
    assert got[:2] == values[:2] and got[2] != got[2] and got[3] is None


def _pieces(text: str, separator: str) -> list[str]:
    """Pieces without the empty ones at the end."""
    pieces = text.split(separator)
    while len(pieces) > 1 and not pieces[-1]:
        pieces.pop()
    return pieces


def _get(record: str, field: str) -> str | None:
    for part in _pieces(record, "|"):
        pieces = _pieces(part, "=")
        if len(pieces) == 2 and pieces[0] == field:
            return pieces[1]
    return None


def _set(record: str, field: str, value: str) -> str:
    parts = _pieces(record, "|")
    for i, part in enumerate(parts):
        if part.split("=")[0] == field:
            parts[i] = f"{field}={value}"
            break
    return "|".join(parts)


def test_packed_records_against_plain_python(evaluate):
    draw = random.Random(4)
    records = ["".join(draw.choices("ab=|,", k=draw.randrange(14))) for _ in range(3000)]
    got = evaluate(lambda c: fn.packed_get(c, "a"), *records)
    assert got == [_get(r, "a") for r in records]
    assert len(set(got)) > 20
    got = evaluate(lambda c: fn.packed_set(c, "a", "9"), *records)
    assert got == [_set(r, "a", "9") for r in records]
