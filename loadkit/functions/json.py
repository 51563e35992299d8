"""Strict and loose JSON over text columns.

`try_parse_json` stops at the end of the first value, so text after it goes unnoticed. Each value
is therefore parsed inside an array that ends with a digest of the text: only when the digest comes
back as the second and last item was the text one whole value. A line cannot hold its own SHA-256.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loadkit.functions.text import blank, col

# No limit of the reader turns a valid line away: nesting, length of a text or a number.
_MOST = str(2**31 - 1)
STRICT = {
    "allowSingleQuotes": "false", "allowNonNumericNumbers": "false", "maxNestingDepth": _MOST, "maxStringLen": _MOST, "maxNumLen": _MOST,
}

# Escapes the target engine refuses: the NUL character and halves of a surrogate pair.
_ODD = r"(?<!\\)(?:\\\\)*+"
_HIGH = r"\\u[dD][89abAB][0-9a-fA-F]{2}"
_LOW = r"\\u[dD][c-fC-F][0-9a-fA-F]{2}"
BAD_ESCAPE = rf"{_ODD}(?:\\u0000|{_HIGH}(?!{_LOW}))|(?<!{_HIGH}){_ODD}{_LOW}"


# Numbers with a fraction or an exponent, which the reader would round to doubles: what stands before one, and the number.
_NUMBER = r"-?(?:0|[1-9][0-9]*+)(?:\.[0-9]++)?(?:[eE][+-]?[0-9]++)?"
_LOSSY = r"[:\[,{]\s*-?[0-9]+[.eE]"
_NEXT_LOSSY = rf'\G((?:"(?:[^"\\]++|\\.)*+"|[^"0-9-]++|-?[0-9]++(?![0-9.eE]))*+)({_NUMBER})(?=\s*(?:[,\]}}]|\z))'
_PARTS = r"^(-?)([0-9]+)(?:\.([0-9]+))?(?:[eE]([+-]?[0-9]+))?\z"
# Larger exponents stay as written.
_MOST_ZEROS = 16383


def bad_escape(c: Column | str) -> Column:
    c = col(c)
    return F.contains(c, F.lit("\\u")) & F.rlike(c, F.lit(BAD_ESCAPE))


def _digest(c: Column) -> Column:
    return F.sha2(c, 256)


def parse_strict(c: Column | str) -> Column:
    """Variant of a text that is exactly one JSON value, else NULL.

    Nothing here sits in a branch, so Spark computes the text, digest and parse once each.
    """
    c = col(c)
    close = F.when(~F.coalesce(bad_escape(c), F.lit(False)), F.lit('"]'))
    wrapped = F.try_parse_json(F.concat(F.lit("["), c, F.lit(',"'), _digest(c), close))
    seen = F.create_map(
        F.coalesce(F.try_variant_get(wrapped, "$[1]", "string"), F.lit("")),
        F.try_variant_get(wrapped, "$[0]", "variant"),
    )
    return F.try_element_at(seen, _digest(c))


def is_valid_json(c: Column | str) -> Column:
    """True for exactly one JSON value; NULL and blank text are not valid.

    The text is read past twice, as a field and in a list: text that goes on after its first value fits one
    of them at most. A digest behind it shows that the reader came to the end. Nothing of the value is built, so
    its size and depth do not matter.
    """
    c = col(c)
    digest = _digest(c)

    def fits(head: str, tail: str) -> Column:
        whole = F.concat(F.lit(head), c, F.lit(f'{tail},"digest":"'), digest, F.lit('"}'))
        return F.from_json(whole, "STRUCT<digest STRING>", STRICT)["digest"] == digest

    return F.coalesce(fits('{"value":', "") & fits('{"list":[', "]") & ~bad_escape(c), F.lit(False))


def one_line(c: Column | str) -> Column:
    """Valid JSON on one line, otherwise as given: line breaks can only stand between its parts."""
    return F.trim(F.regexp_replace(col(c), r"[\r\n\t]+", " "))


def json_text(c: Column | str) -> Column:
    """Compact JSON text of a variant; JSON null is the text `null`, SQL NULL stays NULL."""
    return F.to_json(col(c))


def field_text(variant: Column | str, key: str) -> Column:
    """Field as text: strings unquoted, nested values as JSON, null and missing as NULL.

    A variant drops trailing zeros of numbers (`5.0` reads `5`); `parse_records` keeps them.
    """
    return F.try_variant_get(col(variant), f"$.{key}", "string")


def field_json(variant: Column | str, key: str, decode_text: bool = False) -> Column:
    """Field as JSON (T2). JSON null stays a JSON null, a missing key is NULL.

    `decode_text` also reads JSON held inside a JSON string (T6); off, a string stays a string.
    """
    value = F.try_variant_get(col(variant), f"$.{key}", "variant")
    return decode_json_text(value) if decode_text else value


def decode_json_text(value: Column | str) -> Column:
    value = col(value)
    is_text = F.schema_of_variant(value) == "STRING"
    return F.coalesce(F.when(is_text, to_jsonb_loose(F.try_variant_get(value, "$", "string"))), value)


def has_key(variant: Column | str, key: str) -> Column:
    """Whether an object has the key, also when its value is JSON null."""
    return F.try_variant_get(col(variant), f"$.{key}", "variant").isNotNull()


def unpythonise(c: Column | str) -> Column:
    """Rewrite Python-literal text towards JSON; the result may still be invalid (T4)."""
    c = col(c)
    # The token names, the placeholder and the order of the steps decide the result.
    t = F.replace(c, F.lit("None"), F.lit("null"))
    t = F.replace(t, F.lit("True"), F.lit("true"))
    t = F.replace(t, F.lit("False"), F.lit("false"))
    t = F.regexp_replace(t, r"([\p{L}\p{N}])'([\p{L}\p{N}])", "$1@@APOS@@$2")
    t = F.replace(t, F.lit("\\'"), F.lit("@@APOS@@"))
    t = F.regexp_replace(t, r"\\x([0-9A-Fa-f]{2})", "x$1")
    t = F.regexp_replace(t, r'\\([^"\\/bfnrtu])', r"\\\\$1")
    t = F.replace(t, F.lit("'"), F.lit('"'))
    return F.replace(t, F.lit("@@APOS@@"), F.lit("'"))


def to_jsonb_loose(c: Column | str, strict_first: bool = False) -> Column:
    """JSON or Python-literal text to a variant; any other text becomes a JSON string (T4).

    The rewrite also touches valid JSON (`"None such"` turns into `"null such"`), as users of the
    loaders know it; `strict_first` keeps text that is valid JSON already.
    """
    c = col(c)
    choices = [parse_strict(unpythonise(c)), F.when(~blank(c), c.cast("variant"))]
    if strict_first:
        choices.insert(0, parse_strict(c))
    return F.coalesce(*choices)


def plain_number(token: Column | str) -> Column:
    """A JSON number with its digits as written and its exponent applied: `1.50`, `1e3` as 1000, `-2.0E-3` as -0.0020.

    Zero has no sign. An exponent beyond 16383 either way stays as written.
    """
    token = col(token)
    sign, whole, part, exponent = [F.regexp_extract(token, _PARTS, i) for i in range(1, 5)]
    digits = F.concat(whole, part)
    shift = F.coalesce(exponent.try_cast("int"), F.lit(0))
    point = F.length(whole) + shift
    size = F.length(digits)
    moved = (
        F.when(point <= 0, F.concat(F.lit("0."), F.repeat(F.lit("0"), -point), digits))
        .when(point >= size, F.concat(digits, F.repeat(F.lit("0"), point - size)))
        .otherwise(F.concat(F.substring(digits, F.lit(1), point), F.lit("."), F.substring(digits, point + 1, size)))
    )
    moved = F.regexp_replace(moved, "^0+(?=[0-9])", "")
    small = F.when(exponent == "", True).otherwise(F.abs(exponent.try_cast("bigint")) <= _MOST_ZEROS)
    return F.when(F.coalesce(small, F.lit(False)), F.concat(F.when(F.rlike(digits, F.lit("[1-9]")), sign).otherwise(""), moved)).otherwise(token)


def _numbers_as_text(line: Column, mark: Column) -> Column:
    """The line with each number that has a fraction or an exponent as a string between two marks; the rest is as given."""
    marked = F.regexp_replace(line, F.lit(_NEXT_LOSSY), F.concat(F.lit('$1"'), mark, F.lit("$2"), mark, F.lit('"')))
    # Every second piece between marks is a number.
    plain = F.transform(F.split(marked, mark), lambda piece, i: F.when(i % 2 == 1, plain_number(piece)).otherwise(piece))
    return F.when(F.rlike(line, F.lit("[0-9][eE]|-0")), F.call_function("array_join", plain, mark)).otherwise(marked)


def _unmarked(c: Column, mark: Column) -> Column:
    for around in (F.concat(F.lit('"'), mark), F.concat(mark, F.lit('"')), mark):
        c = F.replace(c, around, F.lit(""))
    return c


def parse_records(
    df: DataFrame,
    text: list[str],
    json: list[str] = (),
    line: str = "line",
    out: str = "rec",
) -> DataFrame:
    """Parse each line once into a struct of the named fields.

    Adds `out` (NULL unless the line is a JSON object) and `<out>_ok` (the line is valid JSON of any
    kind). `text` fields come out as strings, numbers with their digits as written (see `plain_number`); `json` fields
    come out as variants, where JSON null and a missing key differ. Lines with a fraction or an exponent are read
    with such numbers as strings, in a second parse if there are `json` fields too.
    """
    c = F.col(line)
    fields = ", ".join([f"`{f}` STRING" for f in text] + [f"`{f}` VARIANT" for f in json])
    digest = _digest(c)
    # Swapping such a number for a string makes no line valid or invalid. Variants need the numbers themselves, so they take a read of their own.
    lossy = F.coalesce(F.rlike(c, F.lit(_LOSSY)), F.lit(False))
    as_text = F.when(lossy, _numbers_as_text(c, digest))
    wrapped = F.concat(F.lit("["), c if json else F.coalesce(as_text, c), F.lit(',{"__digest":"'), digest, F.lit('"}]'))
    parsed = F.from_json(wrapped, f"ARRAY<STRUCT<{fields}, `__digest` STRING>>", STRICT)
    exact = F.lit(None)
    if json and text:
        exact = F.from_json(as_text, "STRUCT<" + ", ".join(f"`{f}` STRING" for f in text) + ">", STRICT)
    items = F.col("__items")
    given = F.try_element_at(items, F.lit(1))
    read = F.col("__exact") if json else given
    again = [F.coalesce(_unmarked(read[f], F.col("__sha")), given[f]).alias(f) for f in text]
    given = F.when(~F.col("__lossy"), given).otherwise(F.struct(*again, *[given[f].alias(f) for f in json], given["__digest"].alias("__digest")))
    whole = (F.size(items) == 2) & (F.try_element_at(items, F.lit(2))["__digest"] == F.col("__sha")) & (F.col("__once") >= 0)
    record = F.when(
        whole & ~F.coalesce(bad_escape(c), F.lit(False)) & F.rlike(c, F.lit(r"^\s*\{")),
        given,
    )
    return (
        # The row counter is not deterministic, so a filter on a field stays above this projection
        # and does not bring a second parse with it.
        df.withColumns({"__items": parsed, "__exact": exact, "__lossy": lossy, "__sha": digest, "__once": F.monotonically_increasing_id()})
        .withColumn(out, record)
        # Arrays and scalars are valid too, but have no fields; only lines that gave no record pay.
        .withColumns({
            "__valid": F.when(F.col(out).isNotNull(), F.lit(True)).otherwise(is_valid_json(c)), "__twice": F.monotonically_increasing_id(),
        })
        # The second counter keeps a filter on this flag, too, from bringing the check along.
        .withColumn(f"{out}_ok", F.col("__valid") & (F.col("__twice") >= 0))
        .drop("__items", "__exact", "__lossy", "__sha", "__once", "__valid", "__twice")
    )
