from datetime import date
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from paylane import functions as fx


@pytest.fixture
def one(spark):
    def value(build, *args, kinds=None):
        kinds = kinds or ["string"] * len(args)
        schema = ", ".join(f"c{i} {k}" for i, k in enumerate(kinds)) or "x int"
        df = spark.createDataFrame([tuple(args) or (1,)], schema)
        return df.select(build(*[F.col(f"c{i}") for i in range(len(args))]).alias("v")).first().v

    return value


def test_decode_matches_missing_with_missing(one):
    rule = lambda c: fx.decode(c, "NA", "mapped", None, "XX", default=c)
    assert [one(rule, v) for v in ("NA", None, "EUR")] == ["mapped", "XX", "EUR"]


def test_pad_cuts_pads_and_keeps_missing(one):
    assert one(lambda c: fx.pad(c, 4), "abcdef") == "abcd"
    assert one(lambda c: fx.pad(c, 4), "a") == "a   "
    assert one(lambda c: fx.pad(c, 4), None) is None
    assert one(lambda c: fx.pad(c, 4), "") is None


@pytest.mark.parametrize(
    "amount, text",
    [("1234.5", "+0000000001234.50"), ("-0.01", "-0000000000000.01"), ("0.005", "+0000000000000.01"), ("0", "+0000000000000.00")],
)
def test_money_text(one, amount, text):
    assert one(fx.money_text, Decimal(amount), kinds=["decimal(20,4)"]) == text


def test_money_text_overflow_and_missing(one):
    assert set(one(fx.money_text, Decimal("12345678901234"), kinds=["decimal(20,2)"])) <= set("+#.")
    assert one(fx.money_text, None, kinds=["decimal(20,2)"]) is None


def test_padded_id_never_cuts(one):
    assert one(fx.padded_id, 7, kinds=["int"]) == "007"
    assert "#" in one(fx.padded_id, 1234, kinds=["int"])


def test_padded_id_takes_numbers_of_any_length(one):
    for long in (99_999, 100_000, 9_223_372_036_854_775_807):
        assert one(fx.padded_id, long, kinds=["long"]) == "###"
    assert one(fx.padded_id, 999, kinds=["long"]) == "999" and one(fx.padded_id, None, kinds=["long"]) is None


def test_sentinel_date(one):
    assert [one(fx.sentinel_date, v) for v in ("00000000", "20000131", None)] == ["19000101", "20000131", " " * 8]


@pytest.mark.parametrize(
    "text, k, field",
    [("a#b#c#", 3, "c"), ("a#b#c", 3, None), ("a##c#", 2, None), ("#b#", 1, None), ("abc", 1, None), (None, 1, None), ("a#b#", 9, None)],
)
def test_field_must_be_closed_and_not_empty(one, text, k, field):
    assert one(lambda c: fx.field_k(c, k), text) == field


@pytest.mark.parametrize(
    "text, yes",
    [("1#x", True), ("01#x", True), ("11#x", False), ("1", False), ("#1#", False), (" 1#", False), ("1a#", False), (None, False)],
)
def test_first_field_is_one(one, text, yes):
    assert one(fx.first_field_is_one, text) is yes


@pytest.mark.parametrize(
    "code, home", [("1PFRBF9", "BF"), ("1PFRXX9", "GN"), ("1PfrBF9", "GN"), ("1PFRBF", "GN"), ("xyz", "GN"), (None, "GN")]
)
def test_structured_code(one, code, home):
    assert one(lambda c, r: fx.code_part(c, 5, r), code, "gn") == home


def test_clean_text(one):
    assert one(fx.clean_text, "Éléonore\r\nÀ bientôt ß日") == "Eleonore  A bientot ??"
    assert one(fx.clean_text, None) is None


def test_lag_seconds(one):
    assert one(fx.lag_seconds, "+01 02:03:04") == Decimal("93784.000000")
    assert one(fx.lag_seconds, "soon") is None
    assert one(fx.lag_seconds, None) is None


def test_gender_letter(one):
    assert [one(fx.gender_letter, v) for v in ("GEN_M", "GEN_", None)] == ["M", " ", " "]


def test_saturday_first_calendar(spark):
    """Against the same rule in plain Python, for every day of two years."""

    def expected(d):
        day = d.isocalendar()[2] + 2
        day = day - 7 if day > 7 else day
        shift = 1 if d.replace(day=1).weekday() == 6 else 0
        return day, -(-(d.day + day - shift) // 7)

    days = spark.sql("select explode(sequence(date'2023-01-01', date'2024-12-31')) as d")
    rows = days.select("d", fx.day_of_week_from_saturday(F.col("d")).alias("n"), fx.week_of_month(F.col("d")).alias("w")).collect()
    assert len(rows) == 731
    assert all((r.n, r.w) == expected(r.d) for r in rows)
    assert expected(date(2022, 1, 7)) == (7, 2)


@pytest.mark.parametrize("seconds, text", [(0, "0:00:00"), (3661, "1:01:01"), (90000, "1 day, 1:00:00"), (200000, "2 days, 7:33:20")])
def test_duration_text(one, seconds, text):
    assert one(fx.duration_text, seconds, kinds=["bigint"]) == text


def test_keys(one):
    assert one(fx.short_transfer_id, "CI1807.0102.C01") == "CI0102.C01"
    assert one(fx.short_transfer_id, "PLAIN") == "PLPLAIN"
    assert one(fx.short_transfer_id, None) is None
    assert one(lambda t, m: fx.customer_key(t, m, "XXXXXXXX"), "SUBSCRIBER", None) == "SXXXXXXXX"
    assert one(lambda w: fx.account_key(w, "XXXX")[2], "0100011111") == "XXXX"
    assert one(lambda w: fx.account_key(w)[2], "0100011111") is None


def test_text_split(one):
    assert one(lambda c: fx.text_head(c, 3), "abcdef") == "abc"
    assert one(lambda c: fx.text_tail(c, 3), "abcdef") == "def"
    assert one(lambda c: fx.text_tail(c, 6), "abcdef") is None


@pytest.mark.parametrize(
    "row, flag",
    [
        (("TS", None, None, None, None), "Y"),
        (("TA", "OP1", None, None, None), "Y"),
        (("TA", None, "RC", "FAILED_AT_IN", "Y"), "Y"),
        (("TA", None, "RC", "FAILED_AT_IN", "N"), "N"),
        ((None, None, None, None, None), "N"),
    ],
)
def test_settled(one, row, flag):
    assert one(fx.settled_flag, *row) == flag


def test_cash_flag(one):
    assert [one(fx.cash_flag, v) for v in ("CASHIN_X", "MY_CASHOUT2", "XCASHIN", None)] == ["Y", "Y", "N", "N"]


def test_reclassify(one):
    assert one(fx.reclassify, "MR", "ROLLBACK", "IND03", "A") == "CR"
    assert one(fx.reclassify, "MR", "TXNCORRECT", "A", "IND03") == "SCR"
    assert one(fx.reclassify, "MR", "P2P", "IND03", "A") == "MR"
    assert one(fx.reclassify, "SCR", "ROLLBACK", "IND03", "A") == "SCR"
    assert one(fx.reclassify, "MR", "ROLLBACK", None, None) == "MR"


def test_volume_class(one):
    rule = lambda d, c, t: fx.volume_class(d, c, t)
    kinds = ["decimal(20,2)"] * 3
    assert one(rule, None, Decimal(200000), Decimal(200000), kinds=kinds) == "F"
    assert one(rule, Decimal(1), None, Decimal(200000), kinds=kinds) == "L"
    assert one(rule, None, None, Decimal(200000), kinds=kinds) == "L"
