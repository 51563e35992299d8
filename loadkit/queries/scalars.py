"""Field extraction and casts (T1-T21) and row rules."""

from pyspark.sql import functions as F

from loadkit.functions import casts, json, registry, text
from loadkit.operators import classify
from loadkit.operators.quality import reject_breakdown
from loadkit.queries import query


def pick(key: str, *values: str) -> str:
    """CASE over key modulo the number of values; the same text serves both engines."""
    arms = " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values))
    return f"CASE {key} % {len(values)} {arms} END"


@query("json_extract_events", """
    SELECT event_id, json_extract_string(props, '$.k') AS k_text, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
           CAST(NULL AS VARCHAR) AS missing FROM events""")
def _(t, spark):
    parsed = json.parse_records(t("events"), ["k", "nothing"], line="props")
    return parsed.select("event_id", F.col("rec.k").alias("k_text"), casts.metric_or_null("rec.k").alias("k"), F.col("rec.nothing").alias("missing"))


@query("numbers_as_written", """
    SELECT event_id, event_id || '.50' AS fraction, CAST(event_id * 1000 AS VARCHAR) AS thousands, event_id * 1000 AS metric,
           CAST(event_id * 10 + 5 AS VARCHAR) AS moved, '[' || event_id || '.10,"' || event_id || '.10"]' AS list FROM events""")
def _(t, spark):
    n = F.col("event_id").cast("string")
    line = F.format_string('{"fraction": %1$s.50, "thousands": %1$se3, "moved": %1$s.5E+1, "list": [%1$s.10, "%1$s.10"]}', n)
    parsed = json.parse_records(t("events").select("event_id", line.alias("line")), ["fraction", "thousands", "moved", "list"])
    return parsed.select("event_id", "rec.fraction", "rec.thousands", casts.metric_or_null("rec.thousands").alias("metric"), "rec.moved", "rec.list")


@query("json_null_vs_missing", f"""
    SELECT event_id, {pick('event_id', "'null'", "'missing'", "'value'")} AS kind,
           {pick('event_id', 'true', 'false', 'true')} AS has_key FROM events""")
def _(t, spark):
    line = F.expr(pick("event_id", "'{\"k\":null}'", "'{}'", "props"))
    parsed = t("events").select("event_id", json.parse_strict(line).alias("j"))
    value = json.field_json("j", "k")
    kind = F.when(value.isNull(), "missing").when(F.is_variant_null(value), "null").otherwise("value")
    return parsed.select("event_id", kind.alias("kind"), json.has_key("j", "k").alias("has_key"))


VALID = ["props", "'[' || props || ', 1]'", "'  ' || props || ' '", "'\"' || event_type || '\"'", "'null'", "'-1.5e3'"]
INVALID = [
    "props || ' trailing'", "props || ']'", "props || ',0'", "props || props", "''", "'{' || props", "replace(props, '\"', chr(39))",
    "'{\"a\":NaN}'", "'{\"a\":01}'", "'{\"a\":\"' || chr(92) || 'u0000\"}'", "'{\"a\":\"' || chr(92) || 'ud800\"}'", "event_type",
]


@query("strict_validity", f"""
    SELECT event_id, event_id % {len(VALID) + len(INVALID)} < {len(VALID)} AS valid FROM events""")
def _(t, spark):
    lines = t("events").select("event_id", F.expr(pick("event_id", *VALID, *INVALID)).alias("line"))
    return lines.select("event_id", classify.usable_line("line").alias("valid"))


LINES = [
    "'{\"app_id\": \"a' || event_id || '\", \"user\": ' || user_id || '}'", "''", "'   '", "'{\"app_id\": ' || event_id",
    "'{\"user\": ' || user_id || '}'", "'{\"app_id\": \"  \"}'", "'{\"app_id\": \"' || repeat('x', 256) || '\"}'",
    "'{\"app_id\": \"-' || event_id || '\"}'", "'{\"app_id\": ' || event_id || '} trailing'", "'{\"app_id\": ' || event_id || '}'",
]
REASONS = pick("event_id", "NULL", "'blank_line'", "'blank_line'", "'invalid_json'", "'blank_app_id'", "'blank_app_id'",
               "'app_id_too_long'", "'app_id_bad_format'", "'invalid_json'", "NULL")


def judged_events(t):
    lines = t("events").select("event_id", F.expr(pick("event_id", *LINES)).alias("line"))
    parsed = json.parse_records(lines, ["app_id"])
    rules = classify.line_rules("line", F.col("rec_ok")) + classify.id_rules(F.col("rec.app_id"))
    return parsed.select("event_id", "line", F.col("rec.app_id").alias("app_id"), classify.first_reason(rules).alias("reason"))


@query("reject_classify", f"SELECT event_id, {REASONS} AS reason FROM events")
def _(t, spark):
    return judged_events(t).select("event_id", "reason")


@query("reject_breakdown", f"""
    SELECT reason, count(*) AS cnt FROM (SELECT {REASONS} AS reason FROM events) WHERE reason IS NOT NULL
    GROUP BY reason ORDER BY cnt DESC, reason""")
def _(t, spark):
    return reject_breakdown(judged_events(t).filter("reason is not null"))


def daily_line(**fields: str) -> str:
    return "'{' || " + " || ', ' || ".join(f"'\"{k}\": ' || {v}" for k, v in fields.items()) + " || '}'"


_DAY = "'\"2024-01-02\"'"
_BAD = "'\"x\"'"


@query("fact_reject_classify", f"""
    SELECT event_id, {pick('event_id', "NULL", "'missing_aid'", "'missing_date'", "'bad_date'", "'missing_country'", "'bad_u'", "'bad_iu'",
    "'bad_au'", "'bad_r'", "'bad_ir'", "'bad_ar'", "NULL")} AS reason FROM events""")
def _(t, spark):
    from loadkit.plans.facts import daily_rows

    aid = "event_id"
    us = "'\"US\"'"
    lines = [daily_line(aid=aid, d=_DAY, c=us, u="user_id"), daily_line(d=_DAY, c=us), daily_line(aid=aid, c=us),
             daily_line(aid=aid, d=_BAD, c=us), daily_line(aid=aid, d=_DAY, c="'\" \"'")]
    lines += [daily_line(**{"aid": aid, "d": _DAY, "cc": us, m: _BAD}) for m in ["u", "iu", "au", "r", "ir", "ar"]]
    lines += [daily_line(aid=aid, d=_DAY, cc=us, u="'\" \"'", r="null_text")]
    events = t("events").withColumn("null_text", F.lit("null"))
    frame = events.select(F.lit("").alias("file"), F.lit(0).alias("block"), F.col("event_id").alias("pos"), F.expr(pick("event_id", *lines)).alias("line"))
    rows, rules = daily_rows(frame, strict_metrics=True)
    return rows.select(F.col("pos").alias("event_id"), classify.first_reason(rules).alias("reason"))


def cast_query(name, table, key, function, values, expected, kind, show=None):
    """A loose cast over text made from every row of a table."""

    @query(name, f"SELECT {key}, {expected} AS value FROM {table}")
    def _(t, spark):
        frame = t(table).select(key, F.expr(pick(key, *values)).alias("x"))
        value = function("x")
        return frame.select(key, (show(value) if show else value).alias("value"))

    @query(f"{name}_sql_function", f"SELECT {key}, {expected} AS value FROM {table}")
    def _(t, spark):
        registry.register(spark)
        frame = t(table).select(key, F.expr(pick(key, *values)).alias("x"))
        value = F.expr(f"{kind}(x)")
        return frame.select(key, (show(value) if show else value).alias("value"))


K = "CAST(o_orderkey AS STRING)"

cast_query(
    "loose_bool", "orders", "o_orderkey", casts.to_bool_loose,
    ["' Yes '", "'1'", "'TRUE'", "'t'", "'n'", "'0'", "' False'", "'maybe'", "''", "o_orderpriority"],
    pick("o_orderkey", "true", "true", "true", "true", "false", "false", "false", "NULL", "NULL", "NULL"), "to_bool_loose")
cast_query(
    "loose_int", "orders", "o_orderkey", casts.to_int_loose,
    [K, f"' ' || {K} || ' '", "'0x' || hex(o_orderkey)", f"{K} || '.7'", "'1_' || lpad(CAST(o_orderkey % 1000 AS STRING), 3, '0')", "o_orderpriority",
     "''", f"'-' || {K}", f"'9999999999' || {K}", f"'+' || {K}"],
    "CAST(" + pick("o_orderkey", "o_orderkey", "o_orderkey", "o_orderkey", "NULL", "1000 + o_orderkey % 1000", "NULL", "NULL", "-o_orderkey", "NULL", "o_orderkey") + " AS INTEGER)",
    "to_int_loose")
cast_query(
    "loose_bigint", "orders", "o_orderkey", casts.to_bigint_loose,
    [K, f"'4' || lpad({K}, 12, '0')", f"'99999999999999999999' || {K}", "o_orderstatus", "'0b101'", "'0x1000000000000000'", "'0x7fffffffffffffff'",
     "'0x8000000000000000'", "'-0x8000000000000000'", "'0o1777777777777777777777'"],
    pick("o_orderkey", "o_orderkey", "4000000000000 + o_orderkey", "NULL", "NULL", "5", "1152921504606846976", "9223372036854775807", "NULL",
         "CAST('-9223372036854775808' AS BIGINT)", "NULL"), "to_bigint_loose")
cast_query(
    "loose_double", "orders", "o_orderkey", casts.to_double_loose,
    [f"{K} || '.25'", f"{K} || 'd'", "'1e400'", f"'-' || {K} || 'e2'", f"' ' || {K}", "''", "'1e-400'", "o_orderpriority"],
    "CAST(" + pick("o_orderkey", "o_orderkey + 0.25", "NULL", "NULL", "-o_orderkey * 100", "o_orderkey", "NULL", "NULL", "NULL") + " AS DOUBLE)", "to_double_loose")
cast_query(
    "loose_numeric", "orders", "o_orderkey", casts.to_numeric_loose,
    [f"{K} || '.5'", f"' ' || {K} || ' '", "o_orderstatus", "'1e30'", f"{K} || '_000'"],
    "CAST(" + pick("o_orderkey", "o_orderkey + 0.5", "o_orderkey", "NULL", "NULL", "o_orderkey * 1000") + " AS DOUBLE)", "to_numeric_loose",
    lambda c: c.cast("double"))

_D = "o_orderdate"
_DF = lambda f: f"date_format({_D}, '{f}')"
_DAY_TEXT = f"strftime({_D}, '%Y-%m-%d')"
cast_query(
    "loose_date", "orders", "o_orderkey", casts.to_date_loose,
    [_DF("yyyy-MM-dd"), _DF("yyyyMMdd"), _DF("MMM d yyyy"), _DF("MMMM d, yyyy"), _DF("M/d/yyyy"), _DF("yyyy"), _DF("HH:mm"), "o_orderpriority",
     _DF("yyyy-MM-dd") + " || 'T23:59:59Z'", _DF("d MMM yyyy"), "''", _DF("MMM-dd-yyyy"), _DF("E, dd MMM yyyy"), _DF("yyyyMMdd") + " || 'T030405Z'",
     _DF("yyyy-MM-dd") + " || ' 3:04 PM'", _DF("yyyy-MM-dd") + " || ' 24:00:00'", _DF("MM/dd/yy"), _DF("dd-MMM-yy"), _DF("yyMMdd"), _DF("yyyyDDD"),
     f"'J' || (datediff({_D}, DATE'1970-01-01') + 2440588)", "'epoch'", _DF("yyyy-MMM-dd")],
    pick("o_orderkey", *[_DAY_TEXT] * 5, "NULL", "NULL", "NULL", _DAY_TEXT, _DAY_TEXT, "NULL", *[_DAY_TEXT] * 10, "'1970-01-01'", _DAY_TEXT), "to_date_loose", lambda c: c.cast("string"))
_TS = lambda hours: f"strftime({_D} + INTERVAL {hours} HOUR, '%Y-%m-%d %H:%M:%S')"
cast_query(
    "loose_timestamp", "orders", "o_orderkey", casts.to_timestamptz_loose,
    [_DF("yyyy-MM-dd"), _DF("yyyy-MM-dd") + " || 'T05:00:00Z'", _DF("yyyy-MM-dd") + " || ' 05:00+02'", _DF("yyyy-MM-dd") + " || 'T05:00:00.000-0100'",
     _DF("HH:mm"), "o_orderpriority", _DF("MMM d yyyy") + " || ' 7:00'", "''", _DF("yyyy-MM-dd") + " || ' 03:00 PM'", _DF("yyyy-MM-dd") + " || ' 12:00:00 am'",
     _DF("yyyy-MM-dd") + " || ' 03:00 PST'", _DF("yyyyMMdd") + " || 'T050000Z'", _DF("yyyy-MM-dd") + " || ' 24:00'", _DF("E, d MMM yyyy") + " || ' 05:00:00 GMT'",
     _DF("yyyy-MM-dd") + " || ' 12:00 Asia/Tokyo'", _DF("MM/dd/yy") + " || ' 5:00'", _DF("dd-MMM-yy") + " || ' 3:00 PM EST'", _DF("yyMMdd") + " || ' 05:00'", _DF("yyyyDDD") + " || ' 05:00Z'",
     f"'J' || (datediff({_D}, DATE'1970-01-01') + 2440588) || ' 24:00'"],
    pick("o_orderkey", _TS(0), _TS(5), _TS(3), _TS(6), "NULL", "NULL", _TS(7), "NULL", _TS(15), _TS(0), _TS(11), _TS(5), _TS(24), _TS(5), _TS(3), _TS(5), _TS(20), _TS(5), _TS(5), _TS(24)), "to_timestamptz_loose",
    lambda c: F.date_format(c, "yyyy-MM-dd HH:mm:ss"))
_Q = "chr(39)"
cast_query(
    "loose_json", "part", "p_partkey", json.to_jsonb_loose,
    [f"'[' || {_Q} || p_name || {_Q} || ', None, True]'", f"'{{' || {_Q} || 'size' || {_Q} || ': ' || p_size || '}}'", "p_name", "''",
     f"'[' || {_Q} || 'o' || {_Q} || 'clock ' || p_name || {_Q} || ']'", "'[\"None ' || p_name || '\"]'", "CAST(p_size AS STRING)",
     f"'[' || {_Q} || 'x' || chr(92) || 'x41' || {_Q} || ']'"],
    pick("p_partkey", "'[\"' || p_name || '\",null,true]'", "'{\"size\":' || p_size || '}'", "'\"' || p_name || '\"'", "NULL",
         "'[\"o' || chr(39) || 'clock ' || p_name || '\"]'", "'[\"null ' || p_name || '\"]'", "CAST(p_size AS VARCHAR)", "'[\"xx41\"]'"),
    "to_jsonb_loose", json.json_text)


@query("json_or_text", f"""
    SELECT p_partkey, {pick('p_partkey', "NULL", "'null'", "'[' || p_size || ']'", "'\"[' || p_size || ']\"'")} AS kept,
           {pick('p_partkey', "NULL", "'null'", "'[' || p_size || ']'", "'[' || p_size || ']'")} AS decoded FROM part""")
def _(t, spark):
    line = F.expr(pick("p_partkey", "'{}'", "'{\"v\":null}'", "'{\"v\":[' || p_size || ']}'", "'{\"v\":\"[' || p_size || ']\"}'"))
    parsed = json.parse_records(t("part").select("p_partkey", line.alias("line")), [], ["v"])
    return parsed.select("p_partkey", json.json_text("rec.v").alias("kept"), json.json_text(json.decode_json_text("rec.v")).alias("decoded"))


@query("strict_cast", """
    SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS custkey, o_totalprice AS price, strftime(o_orderdate, '%Y-%m-%d') AS day,
           strftime(o_orderdate + INTERVAL 15 HOUR, '%Y-%m-%d %H:%M:%S') AS at, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_orderkey END AS optional FROM orders""")
def _(t, spark):
    return t("orders").select(
        "o_orderkey",
        casts.strict_key(F.col("o_custkey").cast("string"), "fail").alias("custkey"),
        casts.strict_cast(F.col("o_totalprice").cast("string"), "double").alias("price"),
        casts.strict_cast(F.date_format("o_orderdate", "yyyy-MM-dd"), "date").cast("string").alias("day"),
        F.date_format(casts.strict_cast(F.concat(F.date_format("o_orderdate", "EEE, d MMM yyyy"), F.lit(" 3:00 PM")), "timestamp"), "yyyy-MM-dd HH:mm:ss").alias("at"),
        casts.strict_cast(F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderkey").cast("string")), "bigint").alias("optional"),
    )


@query("cross_fill", """
    SELECT event_id, CASE event_id % 4 WHEN 3 THEN NULL WHEN 1 THEN 'user' || user_id ELSE event_type END AS first,
           CASE event_id % 4 WHEN 3 THEN NULL WHEN 2 THEN event_type ELSE 'user' || user_id END AS second FROM events""")
def _(t, spark):
    pairs = t("events").select("event_id", F.expr(pick("event_id", "event_type", "'  '", "' ' || event_type", "NULL")).alias("a"),
                               F.expr(pick("event_id", "'user' || user_id", "'user' || user_id || ' '", "''", "' '")).alias("b"))
    return pairs.select("event_id", text.cross_fill("a", "b").alias("first"), text.cross_fill("b", "a").alias("second"))


@query("metrics", f"""
    SELECT event_id, coalesce({pick('event_id', 'user_id', '-user_id', 'NULL', 'NULL', 'NULL', 'NULL')}, 0) AS or_zero,
           {pick('event_id', 'user_id', '-user_id', 'NULL', 'NULL', 'NULL', 'NULL')} AS or_null FROM events""")
def _(t, spark):
    x = F.expr(pick("event_id", "CAST(user_id AS STRING)", "'-' || user_id", "user_id || '.0'", "event_type", "''", "user_id || chr(10)"))
    frame = t("events").select("event_id", x.alias("x"))
    return frame.select("event_id", casts.metric_or_zero("x").alias("or_zero"), casts.metric_or_null("x").alias("or_null"))


@query("pattern_date", f"""
    SELECT o_orderkey, {pick('o_orderkey', _DAY_TEXT, _DAY_TEXT, 'NULL', 'NULL')} AS day FROM orders""")
def _(t, spark):
    x = F.expr(pick("o_orderkey", _DF("MM/dd/yyyy"), _DF("M/d/yyyy"), "'13/40/2004'", "' '"))
    return t("orders").select("o_orderkey", casts.pattern_date(x).cast("string").alias("day"))


@query("month_start", f"""
    SELECT o_orderkey, {pick('o_orderkey', "strftime(date_trunc('month', o_orderdate), '%Y-%m-%d')", 'NULL', 'NULL', 'NULL')} AS month FROM orders""")
def _(t, spark):
    x = F.expr(pick("o_orderkey", _DF("yyyy-MM"), _DF("yyyy-MM") + " || chr(10)", _DF("yyyy") + " || '-13'", _DF("yyyy-MM-dd")))
    return t("orders").select("o_orderkey", casts.month_start(x).cast("string").alias("month"))


@query("id_format", f"""
    SELECT c_custkey, {pick('c_custkey', 'true', 'false', 'false', 'true', 'false', 'false', 'false')} AS general_ok,
           {pick('c_custkey', 'false', 'false', 'false', 'true', 'false', 'false', 'false')} AS numeric_ok FROM customer""")
def _(t, spark):
    ids = ["replace(c_name, '#', '.')", "c_name", "'-' || c_custkey", "CAST(c_custkey AS STRING)", "c_custkey || chr(10)", "'  '", "repeat('9', 256)"]
    frame = t("customer").select("c_custkey", F.expr(pick("c_custkey", *ids)).alias("x"))
    return frame.select("c_custkey", classify.id_ok("x").alias("general_ok"),
                        classify.id_ok("x", classify.NUMERIC_PATTERN, classify.CSV_ID_LENGTH).alias("numeric_ok"))


@query("string_functions", """
    SELECT doc_id, lower(trim(text, ' ')) AS lowered, length(text) AS len, replace(text, ' ', '_') AS replaced,
           regexp_replace(text, '[aeiou]+', '*', 'g') AS masked, coalesce(nullif(lang, 'en'), 'other') AS lang2,
           least(n_chars, 1000) AS capped FROM documents""")
def _(t, spark):
    return t("documents").select(
        "doc_id", F.lower(F.trim("text")).alias("lowered"), F.length("text").cast("long").alias("len"),
        F.replace("text", F.lit(" "), F.lit("_")).alias("replaced"), F.regexp_replace("text", "[aeiou]+", "*").alias("masked"),
        F.coalesce(F.nullif("lang", F.lit("en")), F.lit("other")).alias("lang2"), F.least("n_chars", F.lit(1000)).alias("capped"),
    )


@query("line_range", "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey BETWEEN 100 AND 500")
def _(t, spark):
    return t("orders").filter(classify.line_range("o_custkey", 100, 500)).select("o_orderkey", "o_custkey")
