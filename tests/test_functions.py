"""Column functions against plain statements of the rules."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from arrears_mart.functions import addresses, balances, campaigns, dates, text

quick = settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
alphabet = st.sampled_from(list("aZñÑ09.- \t\n  CPNoInt()/,5"))
some_text = st.one_of(st.none(), st.text(alphabet, max_size=14))
texts = st.lists(some_text, min_size=100, max_size=200)


def digits(value):
    return "".join(c for c in value if c in "0123456789")


@quick
@given(texts)
def test_key_is_stripped_and_loses_its_decimals(column_values, values):
    expected = [v if v is None else re.sub(r"\.0+$", "", v.strip()) for v in values]
    assert column_values(text.clean_key, values) == expected


@quick
@given(texts)
def test_blank_text_is_missing(column_values, values):
    assert column_values(text.blank_to_null, values) == [v if v and v.strip() else None for v in values]
    assert column_values(text.has_text, values) == [bool(v and v.strip()) for v in values]


@quick
@given(texts, texts, texts)
def test_words_are_joined_with_single_spaces(column_values, a, b, c):
    n = min(map(len, (a, b, c)))
    a, b, c = a[:n], b[:n], c[:n]
    expected = [" ".join(" ".join(filter(None, row)).split()) for row in zip(a, b, c)]
    assert column_values(text.join_words, a, b, c) == expected


@quick
@given(texts)
def test_campaign_parts(column_values, values):
    assert column_values(campaigns.campaign_last2, values) == [digits(v)[-2:] if v else "" for v in values]
    numbers = [int(digits(v)) if v and digits(v) else None for v in values]
    assert column_values(campaigns.campaign_number, values) == numbers


@quick
@given(texts)
def test_campaign_normal_form(column_values, values):
    def normal(value):
        d = digits(value or "")
        return ((d[:-2] if len(d) >= 5 else "2026") + d[-2:].zfill(2)) if d else None

    assert column_values(lambda c: campaigns.normalise_campaign(c, 2026), values) == [normal(v) for v in values]


@pytest.mark.parametrize(
    ("given_value", "expected"),
    [("9", "202609"), ("13", "202613"), ("C2026-05", "202605"), ("CAMPAÑA 13", "202613"), ("abc", None), (None, None)],
)
def test_campaign_examples(column_values, given_value, expected):
    assert column_values(lambda c: campaigns.normalise_campaign(c, 2026), [given_value]) == [expected]


def test_account_campaign_key(column_values):
    found = column_values(campaigns.account_campaign_key, [" 7665522 ", "1", None], ["202512", None, "202512"])
    assert found == ["7665522-12", "1-", None]


def test_age_by_campaign_is_plain_subtraction(column_values):
    values = ["202613", "202612", "202611", "202610", "202513", None, "202614"]
    found = column_values(lambda c: campaigns.age_by_campaign(c, F.lit(202613)), values)
    assert found == ["Inactivas", "Mora 1", "Mora 2", "Mora 3", "Mora 3", None, None]


def test_age_by_days(column_values):
    values = ["-5", "30", "31", "60", "61", "90", "120", "150", "151", "180", "181", None]
    found = column_values(lambda c: dates.age_by_days(c.cast("int")), values)
    assert found == ["0-30", "0-30", "31-60", "31-60", "61-90", "61-90", "91-120", "121-150", "151-180", "151-180", "181+", None]


@pytest.mark.parametrize(
    ("note", "expected"),
    [
        ("5556206818 (25-6-2026) NO CONTESTAN", dt.date(2026, 6, 25)),
        ("( 1/2/26 )", dt.date(2026, 2, 1)),
        ("(1.2.98)", dt.date(1998, 2, 1)),
        ("(1.2.68) (3/3/2001)", dt.date(2068, 2, 1)),
        ("(31/2/2026)", None),
        ("(6/25/2026)", None),
        ("(1-2-201)", None),
        ("25-6-2026", None),
        ("", None),
        (None, None),
    ],
)
def test_date_in_parentheses(column_values, note, expected):
    assert column_values(dates.date_in_parentheses, [note]) == [expected]


@quick
@given(
    st.lists(
        st.tuples(st.integers(1, 31), st.integers(1, 12), st.integers(0, 2100), st.sampled_from("-/.")),
        min_size=50,
        max_size=100,
    )
)
def test_every_day_first_date_is_found(column_values, parts):
    def day(d, m, y):
        if y < 100:
            if len(str(y)) == 1:
                return None
            y += 1900 if y > 68 else 2000
        elif y < 1000:
            return None
        try:
            return dt.date(y, m, d)
        except ValueError:
            return None

    notes = [f"x ({d}{s}{m}{s}{y}) y" for d, m, y, s in parts]
    assert column_values(dates.date_in_parentheses, notes) == [day(d, m, y) for d, m, y, _ in parts]


def test_dates_and_times_are_read_one_by_one(column_values):
    values = ["2026-06-01 09:00", "2026-06-02", "5/6/2026", "25/6/2026 7:05", "2026-02-30", "NaT", "12:30", "2026", None]
    clock = dt.datetime
    assert column_values(dates.parse_clock, values) == [
        clock(2026, 6, 1, 9), clock(2026, 6, 2), clock(2026, 6, 5), clock(2026, 6, 25, 7, 5), None, None, None, None, None,
    ]
    assert column_values(dates.parse_date, values)[0] == dt.date(2026, 6, 1)


def test_money(column_values):
    assert column_values(text.parse_money, [" 12.345 ", "-3", "n/d", "", None]) == [
        Decimal("12.35"), Decimal("-3.00"), None, None, None,
    ]


@pytest.mark.parametrize(
    ("debt", "paid", "reported", "balance", "payment", "overpaid"),
    [
        (500, 700, -210, 0, 500, True),
        (500, 0, 0, 0, 500, False),
        (500, 0, 600, 600, 0, False),
        (500, 700, None, 0, 700, False),
        (None, None, None, 0, 0, False),
        (None, None, 5, 5, 0, False),
    ],
)
def test_balance_rules(spark, debt, paid, reported, balance, payment, overpaid):
    df = spark.createDataFrame([(debt, paid, reported)], "d int, p int, r int")
    d, p, r = (F.col(c).cast("decimal(18,2)") for c in "dpr")
    row = df.select(
        balances.updated_balance(d, p, r), balances.payments(d, p, r), balances.is_overpaid(r), balances.final_balance(d, p)
    ).first()
    assert tuple(row) == (balance, payment, overpaid, (debt or 0) - (paid or 0))


@pytest.mark.parametrize(
    ("end", "age", "paid", "out"),
    [
        ("2026-06-30", "Mora 1", 0, False),
        ("2026-06-30", "Mora 1", 1, True),
        ("2026-06-30", "Mora 1", None, False),
        ("2026-06-30", "Mora 2", 0, True),
        ("2026-06-30", None, 0, True),
        ("2026-07-01", "Mora 3", 9, False),
        (None, "Mora 3", 9, False),
    ],
)
def test_expiry(spark, end, age, paid, out):
    df = spark.createDataFrame([(end, age, paid)], "e string, a string, p int")
    run = F.lit(dt.date(2026, 7, 1))
    assert df.select(balances.is_expired(F.col("e").cast("date"), run, F.col("a"), F.col("p"))).first()[0] is out


def test_collector_backs_up_both_ways(column_values):
    ages = ["Inactivas", "Inactivas", "Mora 1", "Mora 1", None, None]
    own = ["P", " ", "P", "P", "P", "P"]
    zone = ["Z", "Z", "Z", "", "Z", None]
    assert column_values(balances.collector, ages, own, zone) == ["P", "Z", "Z", "P", "Z", "P"]


def test_closing_code(column_values):
    assert column_values(text.closing_code, ["a", " a ", None], [" ", "b ", None]) == ["a", "b", None]


def test_postal_codes(column_values):
    values = ["CP 06000", "123", "0106000", None, "s/n"]
    assert column_values(addresses.postal_code, values) == ["06000", None, "06000", None, None]
    assert column_values(addresses.pad_postal_code, [" 600 ", "123456", None]) == ["00600", "123456", None]


ADDRESSES = {
    "OLMO NTE No 7 Int 3 BARRIO ALTO CP 31200": ("OLMO NTE", "7", "3", "BARRIO ALTO", "31200"),
    "Rio Bravo no. 18-B COL JARDIN C.P. 07300": ("Rio Bravo", "18-B", None, "COL JARDIN", "07300"),
    "PRIVADA SOL S/N 20100 CENTRO": ("PRIVADA SOL S/N", None, None, None, "20100"),
    "AV MAR No 12 Int. 4 Int 9 LOMAS CP 1234": ("AV MAR", "12", "4", "LOMAS CP 1234", None),
    "No 5 COL REAL": (None, "5", None, "COL REAL", None),
    "  CALLE ÑUÑEZ   No. 3  ": ("CALLE ÑUÑEZ", "3", None, None, None),
    "KM 9 CARRETERA c.p.45680 NORTE": ("KM 9 CARRETERA", None, None, None, "45680"),
    "NOGAL 8": ("NOGAL 8", None, None, None, None),
    "SIN NUMERO": ("SIN NUMERO", None, None, None, None),
    "  ": (None, None, None, None, None),
    None: (None, None, None, None, None),
}


def test_address_parts(spark):
    df = spark.createDataFrame([(i, a) for i, a in enumerate(ADDRESSES)], "i int, t string")
    found = df.select("i", *addresses.split_address(F.col("t")).values()).collect()
    assert {r[0]: tuple(r)[1:] for r in found} == dict(enumerate(ADDRESSES.values()))
