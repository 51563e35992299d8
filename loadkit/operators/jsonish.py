"""JSON or Python-literal columns of a CSV."""

from __future__ import annotations

import ast
import json

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.functions.casts import once
from loadkit.functions.json import json_text, parse_strict
from loadkit.functions.text import col, strip_space
from loadkit.operators.ragged import strip_outer_quotes


def literal_to_json(text: str) -> tuple[str | None, bool]:
    """JSON text of a Python literal and whether it cannot be written as JSON."""
    try:
        value = ast.literal_eval(text)
    except Exception:  # not a literal: the text itself is the value
        return json.dumps(text, ensure_ascii=False), False
    try:
        return json.dumps(value, ensure_ascii=False, allow_nan=False), False
    except (TypeError, ValueError):
        return None, True


@F.pandas_udf(T.StructType([T.StructField("value", T.StringType()), T.StructField("bad", T.BooleanType())]))
def _literals(texts: pd.Series) -> pd.DataFrame:
    pairs = [(None, False) if t is None else literal_to_json(t) for t in texts]
    return pd.DataFrame(pairs, columns=["value", "bad"])


# Literals that Spark rewrites: strings of plain characters and the escapes JSON has too, numbers whose digits stay as they
# are, names. A token is one of these, a mark or white space; other text is left to Python.
_STRING = r"""'(?:[^'\\\x00-\x1f]++|\\[\\'"nrtbf])*+'|"(?:[^"\\\x00-\x1f]++|\\[\\'"nrtbf])*+\""""
_NUMBER = r"(?!-?0\.0000)-?(?:0|[1-9][0-9]{0,8})\.(?:0|[0-9]{0,5}[1-9])(?![0-9._eEjJ])|(?:0|-?[1-9][0-9]{0,17})(?![0-9._eEjJ])"
_TOKEN = rf"(?s){_STRING}|{_NUMBER}|None|True|False|[\[\]{{}}:,]|[ \t\r\n]+"
# Depth of brackets up to which a literal is rewritten; Python refuses very deep ones.
_DEPTH = 8


def plain_literal(c: Column | str) -> Column:
    """JSON text of a Python list or dict, NULL where only Python can tell what the text is.

    The tokens are rewritten one by one and the whole is read as JSON. It stands if nothing is lost in that, as with
    a key that occurs twice: then the compact text is as long as what comes back. The result is the text `json.dumps` gives.
    """
    c = col(c)
    tokens = F.regexp_extract_all(c, F.lit(_TOKEN), F.lit(0))
    marks = F.regexp_replace(c, rf"(?s){_STRING}|[^\[\]{{}}]", "")
    for _ in range(_DEPTH):
        marks = F.regexp_replace(marks, r"\[\]|\{\}", "")
    known = F.rlike(c, F.lit(rf"(?s)\A(?:{_TOKEN[4:]})*+\z")) & (marks == "")

    def rewritten(parts: Column) -> Column:
        dense = F.filter(parts, lambda t: F.trim(F.translate(t, "\t\r\n", "   ")) != "")
        spaced = F.transform(dense, lambda t: F.when(t.isin(",", ":"), F.concat(t, F.lit(" "))).otherwise(t))
        whole = json_text(parse_strict(F.array_join(parts, "")))
        return F.when(F.length(whole) == F.length(F.array_join(dense, "")), F.array_join(spaced, ""))

    return F.when(known, once(F.transform(tokens, _json_token), rewritten))


def _json_token(token: Column) -> Column:
    """A Python token as JSON writes it."""
    body = F.substring(token, F.lit(2), F.length(token) - 2)
    # Escaped single quotes lose their backslash; bare double quotes, which only single-quoted strings have, get one.
    body = F.regexp_replace(body, r"\G((?:[^\\]++|\\[^'])*+)\\'", "$1'")
    body = F.regexp_replace(body, r'\G((?:[^"\\]++|\\.)*+)"', r'$1\\"')
    string = F.concat(F.lit('"'), body, F.lit('"'))
    return (
        F.when(F.left(token, F.lit(1)).isin("'", '"'), string).when(token == "None", "null").when(token == "True", "true").when(token == "False", "false").otherwise(token)
    )


def parse_jsonish(df: DataFrame, columns: list[str], bad: str = "jsonish_bad") -> DataFrame:
    """Turn text columns into JSON text (B5) and flag rows that hold a value JSON has no form for.

    none, null and blank become NULL; text in braces or brackets is read as JSON, else as a Python
    literal, else stays a string; other text is a string. Spark reads JSON and plain lists and dicts of
    strings, numbers and names; only other bracketed text reaches Python.
    """
    flags = F.lit(False)
    for c in columns:
        text, strict, plain, lit = f"__{c}_t", f"__{c}_s", f"__{c}_p", f"__{c}_l"
        df = df.withColumn(text, strip_space(strip_outer_quotes(c)))
        nothing = F.coalesce(F.lower(text).isin("", "none", "null"), F.lit(True))
        boxed = F.rlike(text, F.lit(r"(?s)\A(?:\{.*\}|\[.*\])\z"))
        df = df.withColumn(strict, F.when(~nothing & boxed, json_text(parse_strict(text))))
        df = df.withColumn(plain, F.when(~nothing & boxed & F.col(strict).isNull(), plain_literal(text)))
        df = df.withColumn(lit, _literals(F.when(~nothing & boxed & F.col(strict).isNull() & F.col(plain).isNull(), F.col(text))))
        value = F.when(nothing, None).when(boxed, F.coalesce(strict, plain, f"{lit}.value")).otherwise(as_json_string(F.col(text)))
        df = df.withColumn(c, value)
        flags = flags | F.coalesce(F.col(f"{lit}.bad"), F.lit(False))
    df = df.withColumn(bad, flags)
    return df.drop(*[f"__{c}_{k}" for c in columns for k in "tspl"])


def as_json_string(c: Column | str) -> Column:
    """Text as a JSON string."""
    return json_text(col(c).cast("variant"))
