import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from helpers import as_dicts
from pyspark.sql import functions as F

from martwright import functions as fn


def test_surrogate_key_separates_null_from_empty(frame):
    df = frame([("a", None), ("a", ""), (None, None)], "x string, y string")
    keys = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    token = "_dbt_utils_surrogate_key_null_"
    want = [f"a-{token}", "a-", f"{token}-{token}"]
    assert keys == [hashlib.md5(w.encode()).hexdigest() for w in want]


def test_safe_divide(frame):
    df = frame([(6.0, 3.0), (6.0, 0.0), (6.0, None)], "n double, d double")
    assert [r[0] for r in df.select(fn.safe_divide("n", "d")).collect()] == [2.0, 0.0, 0.0]
    assert [r[0] for r in df.select(fn.safe_divide("n", "d", -1)).collect()] == [2.0, -1.0, -1.0]


def test_cents_to_dollars(frame):
    df = frame([(12345,), (-5,)], "c long")
    got = [r[0] for r in df.select(fn.cents_to_dollars("c")).collect()]
    assert got == [Decimal("123.45"), Decimal("-0.05")]
    assert df.select(fn.cents_to_dollars("c", 1)).first()[0] == Decimal("123.5")


@pytest.mark.parametrize("kind", ["decimal(18,2)", "double"])
def test_cents_are_exact(spark, kind):
    df = spark.range(-20000, 20000).select(
        "id", (F.col("id").cast("decimal(18,0)") / 100).cast("decimal(18,2)").cast(kind).alias("a")
    )
    assert df.filter(fn.to_cents("a") != F.col("id")).isEmpty()
    back = fn.from_cents(fn.to_cents("a")).cast(kind)
    assert df.filter(back != F.col("a")).isEmpty()


@pytest.mark.parametrize("kind", ["decimal(10,3)", "double"])
def test_cents_round_half_away_from_zero(frame, kind):
    df = frame([("100.125",), ("1.005",), ("-0.125",), ("0.124",), (None,)], "a string")
    got = [r[0] for r in df.select(fn.to_cents(F.col("a").cast(kind))).collect()]
    assert got == [10013, 101, -13, 12, None]


def test_cents_of_amounts_on_both_sides_of_a_hundred_billion(frame):
    amounts = ["99999999999.99", "-99999999999.99", "100000000000.01", "9007199254740993.07", "-9999999999999999.99"]
    df = frame([(a,) for a in amounts], "a string").select("a", F.col("a").cast("decimal(18,2)").alias("m"))
    got = {r["a"]: r["c"] for r in df.select("a", fn.to_cents("m").alias("c")).collect()}
    assert got == {a: int(a.replace(".", "")) for a in amounts}


def test_round_cents_goes_half_away_from_zero(frame):
    df = frame([(v,) for v in (149, 150, 151, -149, -150, -151, 0)], "v long")
    got = [r[0] for r in df.select(fn.round_cents("v", 100)).collect()]
    assert got == [1, 2, 2, -1, -2, -2, 0]


def test_round_ratio(frame):
    df = frame([(1, 8, ), (1, 0), (-1, 8)], "n int, d int")
    got = [r[0] for r in df.select(fn.round_ratio("n", "d", 2)).collect()]
    assert got == [Decimal("0.13"), None, Decimal("-0.13")]


def test_flag_turns_unknown_into_false(frame):
    df = frame([(1,), (-1,), (None,)], "x int")
    assert [r[0] for r in df.select(fn.flag(F.col("x") < 0)).collect()] == [False, True, False]


def test_dates(frame):
    df = frame([(dt.date(2024, 2, 29), dt.date(2024, 3, 10))], "a date, b date")
    row = df.select(
        fn.days_between("a", "b"),
        fn.month_of("b"),
        fn.quarter_of("a"),
        fn.year_of("a"),
        fn.day_offset(F.col("a"), years=-1),
        fn.day_offset(F.col("a"), days=1),
    ).first()
    assert list(row) == [
        10,
        dt.date(2024, 3, 1),
        dt.date(2024, 1, 1),
        2024,
        dt.date(2023, 2, 28),
        dt.date(2024, 3, 1),
    ]


def test_strip_prefix():
    assert [fn.strip_prefix(c) for c in ("C_CUSTKEY", "ps_availqty", "event_id", "x")] == [
        "custkey",
        "availqty",
        "event_id",
        "x",
    ]


def test_words_and_lengths_follow_python(frame):
    texts = ["", "   ", "one", " two\twords ", "a b　c\n", "x" * 30, None, " three   words here ", "a b c d e", "\x1ca\x1f"]
    df = frame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = as_dicts(
        df.select(
            "i",
            fn.word_count("t").alias("w"),
            fn.text_length("t").alias("n"),
            *[fn.has_words("t", k).alias(f"has{k}") for k in range(5)],
        )
    )
    for row in rows:
        text = texts[row["i"]] or ""
        assert row["w"] == len(text.split())
        assert row["n"] == len(text.strip())
        assert [row[f"has{k}"] for k in range(5)] == [len(text.split()) >= k for k in range(5)]


def test_one_very_long_word_stays_cheap(spark):
    df = spark.range(1).select(F.repeat(F.lit("x"), 2_000_000).alias("t"))
    row = df.select(fn.has_words("t", 10), fn.word_count("t"), fn.text_length("t")).first()
    assert list(row) == [False, 1, 2_000_000]
