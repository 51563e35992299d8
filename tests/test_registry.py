from pyspark.sql import functions as F

from loadkit.functions import casts, registry
from loadkit.functions.json import to_jsonb_loose

ROWS = ["true", " N ", "maybe", "12", " 0x1F ", "-0b11", "1_000", "2147483648", "1.5", "1.5d", "1e400", "inf", "NaN", "", "  ", None,
        "2020-01-02", "20200102", "January 2, 2020", "2020-01-02T10:11:12.25+0130", "12:00", "2020", "1/8/99", "8 Jan 1999 3:04 pm PST", "J2451187", "1999008 24:00", "epoch", "990108", "2010-06-28 12:00 Asia/Tokyo", "\x02\x01", "['a', None]", "['Cherry\\'s']",
        "rock 'n' roll", '["a\\q"]', '["\\ud800"]']


def test_sql_functions_agree_with_columns(spark, texts):
    names = registry.register(spark)
    frame = texts(ROWS)
    by_column = {**{f"to_{k}_loose": f for k, f in [
        ("bool", casts.to_bool_loose), ("int", casts.to_int_loose), ("bigint", casts.to_bigint_loose),
        ("double", casts.to_double_loose), ("numeric", casts.to_numeric_loose), ("date", casts.to_date_loose),
        ("timestamptz", casts.to_timestamptz_loose)]}, "to_jsonb_loose": to_jsonb_loose}
    assert sorted(names) == sorted(by_column)
    for name in names:
        both = frame.select("x", by_column[name]("x").alias("c"), F.expr(f"{name}(x)").alias("s"))
        text = both.selectExpr("x", *(["to_json(c) c", "to_json(s) s"] if "json" in name else ["string(c) c", "string(s) s"]))
        for row in text.collect():
            assert row.c == row.s, (name, row)
