import pytest
from pyspark.sql import functions as F

from loadkit.functions import json as J

VALID = ['{"a":1}', ' {"a":1} ', '[1]', 'null', '"x"', '{"a":1,"a":2}', '{"a":"\\\\u0000"}', '{"a":"\\ud83d\\ude00"}',
         '{"a":1}\r', '-1.5e3', 'true', '{}', '{"__digest":"x"}']
INVALID = ['{"a":1} trailing', '{"a":1}]', '{"a":1},0', '{"a":1}{"b":2}', '', '  ', "{'a':1}", '{"a":NaN}', '{"a":01}',
           '{"a":1,}', '{"a":.5}', '{"a":+1}', '{"a":"\\x41"}', '{"a":"\tx"}', '{"a":"\\u0000"}', '{"a":"\\ud800"}',
           '{"a":"\\udc00"}', '{"a":"\\ud800\\ud800"}', '{"a":1}] junk', '{"a":1},{"__digest":"x"}', '{"a":"\\\\\\u0000"}',
           '[1', 'x', None]


@pytest.mark.parametrize("whole", ["function", "records"])
def test_validity(texts, whole):
    frame = texts(VALID + INVALID, "line")
    if whole == "function":
        got = frame.select("i", "line", J.is_valid_json("line").alias("ok"))
    else:
        got = J.parse_records(frame, ["a"]).select("i", "line", "rec_ok").withColumnRenamed("rec_ok", "ok")
    rows = sorted(got.collect(), key=lambda r: r.i)
    assert [r.line for r in rows if r.ok] == VALID
    assert [r.line for r in rows if not r.ok] == INVALID


def test_record_fields(texts):
    lines = ['{"a":"x\\ny","v":null}', '{"a":5.0,"v":[1]}', '{"a":null}', '{"a":{"k":[1,2]},"v":"[1]"}', '{"a":1,"a":2}', '[1]',
             '{"a":12345678901234567890123456789012345678901234567890}', '{"a":true}']
    rows = J.parse_records(texts(lines, "line"), ["a"], ["v"]).selectExpr(
        "i", "rec.a a", "to_json(rec.v) v", "is_variant_null(rec.v) n").orderBy("i").collect()
    assert [r.a for r in rows] == ["x\ny", "5.0", None, '{"k":[1,2]}', "2", None, "1234567890" * 5, "true"]
    assert [r.v for r in rows] == ["null", "[1]", None, '"[1]"', None, None, None, None]
    assert rows[0].n and not rows[2].n


def test_loose_json(texts):
    cases = [
        ("['a','b']", '["a","b"]'), ("{'a': None, 'b': True}", '{"a":null,"b":true}'), ("['Cherry\\'s']", '["Cherry\'s"]'),
        ("['Cherry's']", '["Cherry\'s"]'), ("['\\xe9']", '["xe9"]'), ('["None such"]', '["null such"]'),
        ('["rock \'n\' roll"]', '"[\\"rock \'n\' roll\\"]"'), ("채광", '"채광"'), ("['채'광']", '["채\'광"]'),
        ("", None), ("  ", None), (None, None), ("12", "12"), ("null", "null"), ('["a\\q"]', '["a\\\\q"]'),
    ]
    frame = texts([k for k, _ in cases]).select("i", J.json_text(J.to_jsonb_loose("x")).alias("y"))
    got = [r.y for r in frame.orderBy("i").collect()]
    assert list(zip([k for k, _ in cases], got)) == cases
    strict = texts(['["None such"]', "['a']"]).select("i", J.json_text(J.to_jsonb_loose("x", strict_first=True)).alias("y"))
    assert [r.y for r in strict.orderBy("i").collect()] == ['["None such"]', '["a"]']


def test_field_json(texts):
    lines = ['{"k":null}', "{}", '{"k":[1]}', '{"k":"[1]"}', "1"]
    frame = texts(lines).withColumn("j", J.parse_strict("x"))
    rows = frame.select(
        "i", J.field_text("j", "k").alias("t"), J.json_text(J.field_json("j", "k")).alias("v"),
        J.json_text(J.field_json("j", "k", decode_text=True)).alias("d"), J.has_key("j", "k").alias("h"),
    ).orderBy("i").collect()
    assert [r.t for r in rows] == [None, None, "[1]", "[1]", None]
    assert [r.v for r in rows] == ["null", None, "[1]", '"[1]"', None]
    assert [r.d for r in rows] == ["null", None, "[1]", "[1]", None]
    assert [bool(r.h) for r in rows] == [True, False, True, True, False]


def test_limits_of_the_reader_refuse_nothing(texts):
    """Long texts, deep nesting and long numbers are valid, in a field that is read and in one that is not."""
    long_text = '{"a":1,"b":"' + "x" * 21_000_000 + '"}'
    deep = '{"a":1,"b":' + "[" * 1100 + "]" * 1100 + "}"
    number = '{"a":1,"b":' + "7" * 1200 + "}"
    frame = J.parse_records(texts([long_text, deep, number, deep + "x", "[" * 1100 + "]" * 1100], "line"), ["a"])
    got = [(r.rec_ok, r.a) for r in sorted(frame.select("i", "rec_ok", F.col("rec.a").alias("a")).collect(), key=lambda r: r.i)]
    assert got == [(True, "1"), (True, "1"), (True, "1"), (False, None), (True, None)]


def test_validity_sees_text_behind_the_value(texts):
    cases = {'1, "x": 2': False, "1, 2": False, '1], "x": [2': False, '1}, {"value": 2': False, "": False, " ": False, "null": True, '"a"': True, " [1] ": True, "{}": True, "01": False, "[1,]": False}
    frame = texts(list(cases)).select("i", J.is_valid_json("x").alias("ok"))
    assert [r.ok for r in sorted(frame.collect(), key=lambda r: r.i)] == list(cases.values())


def test_numbers_as_written(texts):
    """Fractions keep their digits, exponents are applied, whatever stands around them."""
    numbers = {
        "1.50": "1.50", "5.0": "5.0", "-0.0": "0.0", "1e3": "1000", "1.50e1": "15.0", "-2.0E-3": "-0.0020", "0.05e1": "0.5", "0e-3": "0.000",
        "0e5": "0", "12.345e+1": "123.45", "0.1234567890123456789012345": "0.1234567890123456789012345", "1e25": "1" + "0" * 25, "1e99999": "1e99999",
        "123456789012345678901234567890.10": "123456789012345678901234567890.10", "7": "7",
    }
    lines = [f'{{"b":"1.50 \\" 2.5","a": {n} ,"c":[{n},{{"1.5":"1e3"}}],"v":1.50}}' for n in numbers]
    rows = J.parse_records(texts(lines, "line"), ["a", "b", "c"], ["v"]).selectExpr("i", "rec_ok", "rec.a a", "rec.b b", "rec.c c", "to_json(rec.v) v").orderBy("i").collect()
    for row, want in zip(rows, numbers.values()):
        assert row.rec_ok and (row.a, row.b, row.c, row.v) == (want, '1.50 " 2.5', f'[{want},{{"1.5":"1e3"}}]', "1.5")


def test_numbers_beside_damage(texts):
    """What is no JSON stays none, and many numbers in one line are all read."""
    bad = ['{"a":01.5}', '{1.5:2}', '{"a":1.}', '{"a":.5}', '{"a":1.5.5}', '{"a":--1.5}', '{"a":1.5e}', '{"a":1.5} x']
    many = '{"a":1.50,"l":[' + ",".join(["2.50", '"x\\"2.5"'] * 20000) + "]}"
    rows = J.parse_records(texts([*bad, many, '{"a":1.50,"a":2.50}', '{"a":null,"b":1.50}', "1.50"], "line"), ["a", "l"]).selectExpr("i", "rec_ok", "rec.a a", "length(rec.l) n").orderBy("i").collect()
    assert [(r.rec_ok, r.a) for r in rows] == [(False, None)] * len(bad) + [(True, "1.50"), (True, "2.50"), (True, None), (True, None)]
    assert rows[len(bad)].n == len(many) - len('{"a":1.50,"l":}')
