import datetime as dt
import math
from decimal import Decimal

import pytest

from loadkit.functions import casts


def check(column, function, pairs):
    got = column(function, [k for k, _ in pairs])
    assert list(zip([k for k, _ in pairs], got)) == pairs


def test_bool(column):
    check(column, casts.to_bool_loose, [
        (" Yes ", True), ("1", True), ("T", True), ("y", True), ("n", False), ("0", False),
        ("FALSE", False), ("maybe", None), ("", None), ("  ", None), (None, None), ("\ttrue", None),
    ])


def test_int(column):
    check(column, casts.to_int_loose, [
        ("12", 12), (" 12 ", 12), ("+7", 7), ("-0", 0), ("12.7", None), ("2147483647", 2147483647),
        ("2147483648", None), ("-2147483648", -2147483648), ("1_000", 1000), ("1__0", None),
        ("_1", None), ("0x10", 16), ("-0xFF", -255), ("0o17", 15), ("0b101", 5), ("0x", None),
        ("0x0", 0), ("0xFFFFFFFFFFFFFFFFFFFF", None), ("0x7fffffff", 2**31 - 1), ("0x80000000", None), ("-0x80000000", -(2**31)), ("abc", None), ("", None), (None, None),
        ("1 2", None), ("12\n", 12), ("007", 7), ("5.0", None),
    ])


def test_bigint(column):
    check(column, casts.to_bigint_loose, [
        ("9223372036854775807", 9223372036854775807), ("9223372036854775808", None),
        ("-9223372036854775808", -9223372036854775808), ("0x7", 7), ("", None),
        ("0x1000000000000000", 2**60), ("0x7fffffffffffffff", 2**63 - 1), ("0x8000000000000000", None), ("-0x8000000000000000", -(2**63)),
        ("0o777777777777777777777", 2**63 - 1), ("-0o1000000000000000000000", -(2**63)), ("0o2000000000000000000000", None), ("0b" + "1" * 63, 2**63 - 1),
    ])


def test_double(column):
    check(column, casts.to_double_loose, [
        ("1.5", 1.5), (" 1.5 ", 1.5), ("1.5d", None), ("1.5f", None), ("1e400", None), ("1e-400", None),
        ("0e5", 0.0), (".5", 0.5), ("5.", 5.0), ("-1e3", -1000.0), ("Infinity", math.inf), ("-inf", -math.inf),
        ("x", None), ("", None), (None, None), (".", None),
    ])
    assert math.isnan(column(casts.to_double_loose, ["NaN"])[0])


def test_numeric(column):
    check(column, casts.to_numeric_loose, [
        ("1.5", Decimal("1.5").quantize(Decimal(1).scaleb(-18))), ("1_0", Decimal(10).quantize(Decimal(1).scaleb(-18))),
        ("x", None), ("", None), ("1e30", None),
    ])


def test_date(column):
    d = dt.date
    check(column, casts.to_date_loose, [
        ("2020-01-02", d(2020, 1, 2)), ("2020-1-2", d(2020, 1, 2)), ("2020", None), ("20200102", d(2020, 1, 2)),
        ("Jan 2 2020", d(2020, 1, 2)), ("January 2, 2020", d(2020, 1, 2)), ("2 Jan 2020", d(2020, 1, 2)),
        ("1/2/2020", d(2020, 1, 2)), ("2020/01/02", d(2020, 1, 2)), ("2020-02-30", None), ("junk", None), ("", None),
        ("2020-01-02T23:00:00Z", d(2020, 1, 2)), ("2020-01-02 23:00:00-05", d(2020, 1, 2)), ("2020-01-02T99:00:00Z", None),
        (" 2020-01-02 ", d(2020, 1, 2)), ("12:00", None), (None, None), ("02-Jan-2020", d(2020, 1, 2)), ("Sept 3 2021", d(2021, 9, 3)),
        ("1/8/99", d(1999, 1, 8)), ("1-8-69", d(2069, 1, 8)), ("08-Jan-99", d(1999, 1, 8)), ("Jan-08-70", d(1970, 1, 8)), ("January 8, 05", d(2005, 1, 8)), ("990108", d(1999, 1, 8)),
        ("1999008", d(1999, 1, 8)), ("1999.366", None), ("2000366", d(2000, 12, 31)), ("1999.000", None), ("J2451187", d(1999, 1, 8)), ("j1721426", d(1, 1, 1)), ("epoch", d(1970, 1, 1)), ("1999-Jan-08", d(1999, 1, 8)), ("1999 jan 8", d(1999, 1, 8)),
        ("13/13/99", None), ("infinity", None), ("12345", None), ("990230", None), ("\x02\x012020\x011\x011", None), ("J2451187 10:00", d(1999, 1, 8)), ("2020-01-02 24:00:00", d(2020, 1, 2)),
        ("3 december 2021", d(2021, 12, 3)), ("Janx 2 2020", None), ("1-2-2020", d(2020, 1, 2)), ("1/2-2020", None), ("2020-13-01", None),
    ])


def test_timestamp(texts):
    cases = [
        ("2010-06-28T00:00:00Z", "2010-06-28 00:00:00"), ("2010-06-28", "2010-06-28 00:00:00"), ("12:00", None),
        ("2010-06-28 10:11", "2010-06-28 10:11:00"), ("2010-06-28T10:11:12.5+02:00", "2010-06-28 08:11:12.5"),
        ("2010-06-28T10:11:12-0330", "2010-06-28 13:41:12"), ("2010-06-28T10:11:12+1", "2010-06-28 09:11:12"),
        ("2010", None), ("junk", None), ("", None), (None, None), ("20100628", "2010-06-28 00:00:00"),
        ("2010-06-28T25:00:00Z", None), ("2010-06-28 10:11:12 +02:00", "2010-06-28 08:11:12"), ("2010-06-28 10:11:12 UTC", "2010-06-28 10:11:12"),
        ("June 28, 2010 7:05", "2010-06-28 07:05:00"), ("6/28/2010 07:05:01z", "2010-06-28 07:05:01"), ("2010-06-28T", None), ("2010-06-28T10", None),
        ("2010-06-28 03:04 PM", "2010-06-28 15:04:00"), ("2010-06-28 12:04:05 am", "2010-06-28 00:04:05"), ("2010-06-28 13:04 PM", None), ("2010-06-28 12:00pm z", "2010-06-28 12:00:00"),
        ("2010-06-28 03:04:05 PST", "2010-06-28 11:04:05"), ("2010-06-28 03:04 XYZ", None), ("2010-06-28 03:04 PM America/New_York", "2010-06-28 19:04:00"), ("2010-06-28 03:04 No/Where", None),
        ("20100628T030405Z", "2010-06-28 03:04:05"), ("20100628 0304", "2010-06-28 03:04:00"), ("2010-06-28 24:00:00", "2010-06-29 00:00:00"), ("2010-06-28 24:01", None),
        ("Jun-28-2010", "2010-06-28 00:00:00"), ("Mon, 28 Jun 2010 03:04:05 GMT", "2010-06-28 03:04:05"), ("Monday June 28, 2010", "2010-06-28 00:00:00"),
        ("28-Jun-10 7:05 pm", "2010-06-28 19:05:00"), ("6/28/10 0:05 am", None), ("100628 12:30", "2010-06-28 12:30:00"), ("J2455376 10:11:12+1", "2010-06-28 09:11:12"), ("epoch", "1970-01-01 00:00:00"),
        ("2010179 10:00 EST", "2010-06-28 15:00:00"), ("2010-06-28T10:11:12.123456789Z", "2010-06-28 10:11:12.123456"), ("2010-06-28 10:11:12+16:00", None), ("2010-06-28 10:11 europe/Nowhere", None),
        ("2010-06-28 10:11+02", "2010-06-28 08:11:00"), ("2010-06-28 1:11 -0130", "2010-06-28 02:41:00"),
    ]
    frame = texts([k for k, _ in cases]).select("i", casts.to_timestamptz_loose("x").cast("string").alias("y"))
    got = [r.y for r in sorted(frame.collect(), key=lambda r: r.i)]
    assert list(zip([k for k, _ in cases], got)) == cases


def test_pattern_date_and_month(column):
    d = dt.date
    check(column, casts.pattern_date, [
        ("11/16/2004", d(2004, 11, 16)), ("1/6/2004", d(2004, 1, 6)), ("13/40/2004", None), ("", None), (" ", None),
        (" 11/16/2004 ", d(2004, 11, 16)), (None, None),
    ])
    check(column, casts.month_start, [
        ("2024-05", d(2024, 5, 1)), ("2024-5", None), ("2024-13", None), ("2024-05\n", None), (None, None),
    ])


def test_metrics(column):
    pairs = [("-5", -5), ("5", 5), ("5.0", None), ("1e3", None), ("", None), (None, None), ("5\n", None), ("+5", None)]
    check(column, casts.metric_or_null, pairs)
    check(column, casts.metric_or_zero, [(k, v or 0) for k, v in pairs])


def test_strict(column):
    strict_int = lambda c: casts.strict_cast(c, "int")
    check(column, strict_int, [("12", 12), ("", None), (None, None)])
    for bad in ["x", " ", "12.5"]:
        with pytest.raises(Exception, match="invalid int"):
            column(strict_int, [bad])
    with pytest.raises(Exception, match="invalid integer key"):
        column(lambda c: casts.strict_key(c, "fail"), ["ab-1"])
    check(column, casts.strict_key, [("ab-1", None), ("12", 12)])
    with pytest.raises(Exception, match="invalid date"):
        column(lambda c: casts.pattern_date(c, "fail"), ["13/40/2004"])
    with pytest.raises(Exception):
        column(casts.metric_or_zero, ["99999999999999999999"])
