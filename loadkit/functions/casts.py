r"""Loose casts (NULL on bad text) and strict casts (error on bad text): T5, T7-T14, T16-T19.

Spark's own `try_cast` is laxer than the engine these rules come from in some places (`1.5d`,
`2020` as a date, `12:00` as a timestamp) and stricter in others (`0x10`, `1_000`, `20200102`), so
each cast is guarded by an explicit pattern.
"""

from __future__ import annotations

from collections.abc import Callable
from string import Formatter

from pyspark.sql import Column
from pyspark.sql import functions as F

from loadkit.functions.text import blank, col, full_match

# The spellings of the loose boolean.
TRUE_WORDS = ["true", "t", "1", "yes", "y"]
FALSE_WORDS = ["false", "f", "0", "no", "n"]

BASED_INT = r"[+-]?0(?:x(?:_?[0-9a-f])+|o(?:_?[0-7])+|b(?:_?[01])+)"
OCTAL_64 = r"^1[0-7]{21}\z"
FLOAT = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
METRIC = r"-?[0-9]+"
YEAR_MONTH = r"[0-9]{4}-[0-9]{2}"

# Month names by their first three letters, in calendar order.
MONTHS = "janfebmaraprmayjunjulaugsepoctnovdec"
# Zone abbreviations and their offsets from UTC.
ZONES = {
    "est": "-05:00", "edt": "-04:00", "cst": "-06:00", "cdt": "-05:00", "mst": "-07:00", "mdt": "-06:00", "pst": "-08:00", "pdt": "-07:00",
    "akst": "-09:00", "akdt": "-08:00", "hst": "-10:00", "wet": "+00:00", "west": "+01:00", "bst": "+01:00", "cet": "+01:00", "cest": "+02:00",
    "eet": "+02:00", "eest": "+03:00", "msk": "+03:00", "jst": "+09:00", "kst": "+09:00",
}
_NAME = (
    r"(?:jan(?:uary)?|feb(?:ruary)?|mar(?:ch)?|apr(?:il)?|may|june?|july?|aug(?:ust)?|sep(?:t(?:ember)?)?|oct(?:ober)?|nov(?:ember)?|dec(?:ember)?)"
)
_WEEKDAY = r"(?:mon(?:day)?|tue(?:s(?:day)?)?|wed(?:nesday)?|thu(?:r(?:s(?:day)?)?)?|fri(?:day)?|sat(?:urday)?|sun(?:day)?)(?:, *| +)"
# What a date or time consists of. Each shape below names its fields; a field may stand in many shapes.
PARTS = {
    "y4": ("year", "[0-9]{4}"), "y2": ("year", "[0-9]{2}"), "y": ("year", "[0-9]{4}|[0-9]{2}"), "m": ("month", "[0-9]{1,2}"), "mm": ("month", "[0-9]{2}"), "name": ("month", _NAME),
    "d": ("day", "[0-9]{1,2}"), "dd": ("day", "[0-9]{2}"), "doy": ("doy", "[0-9]{3}"), "julian": ("julian", "[0-9]{1,7}"), "epoch": ("word", "epoch"),
    "h": ("hour", "[01]?[0-9]|2[0-3]"), "h12": ("hour", "0?[1-9]|1[0-2]"), "h24": ("hour", "24"), "hh": ("hour", "[01][0-9]|2[0-3]"), "mi": ("minute", "[0-5][0-9]"), "zero": ("minute", "00"),
    "s": ("second", r"[0-5][0-9](?:\.[0-9]+)?"), "ss": ("second", "[0-5][0-9]"), "half": ("half", "[ap]"), "sign": ("sign", "[+-]"), "oh": ("oh", "0?[0-9]|1[0-5]"), "om": ("om", "[0-5][0-9]"),
    "zone": ("zone", "|".join(ZONES)), "region": ("region", "[a-z]+(?:/[a-z_+-]+)+"),
}
DATES = [
    "{y4}-{m}-{d}", "{y4}/{m}/{d}", "{m}/{d}/{y}", "{m}-{d}-{y}", "{y4}{mm}{dd}", "{y2}{mm}{dd}", r"{y4}\.?{doy}", "{name} +{d}(?:, *| +){y}", "{name}-{d}-{y}", "{d}[ -]{name}[ -]{y}",
    "{y4}[ -]{name}[ -]{d}", "j{julian}", "{epoch}",
]
# After a date; the last only after eight digits.
CLOCKS = [
    r"(?:t\s*|\s+)(?:{h12}:{mi}(?::{s})? ?{half}\.?m\b\.?|{h24}:{zero}(?::00(?:\.0+)?)?|{h}:{mi}(?::{s})?)", r"(?<=^[0-9]{{8}})[t ]{hh}{mi}(?:{ss})?",
]
OFFSETS = [r"\s*(?:z|utc|gmt)", r"\s*{sign}{oh}(?::?{om})?", " ?{zone}", " ?{region}"]
FIELDS = ["year", "month", "day", "hour", "minute", "second", "half", "sign", "oh", "om", "zone", "region", "julian", "doy", "word"]
# Marks of a text that was read, and between its fields; no spelling has them.
_READ, _CUT = "\x02", "\x01"


def _grammar() -> tuple[str, str]:
    """One pattern of all shapes, and the form that sets its fields side by side.

    A group that took no part leaves nothing, so all groups of a field stand next to each other in the form.
    """
    groups: dict[str, list[int]] = {f: [] for f in FIELDS}
    seen = 0

    def filled(shape: str) -> str:
        nonlocal seen
        out = []
        for literal, part, _, _ in Formatter().parse(shape):
            out.append(literal)
            if part:
                seen += 1
                groups[PARTS[part][0]].append(seen)
                out.append(f"({PARTS[part][1]})")
        return "".join(out)

    either = lambda shapes: "(?:" + "|".join(filled(x) for x in shapes) + ")"
    pattern = rf"(?i)^(?:{_WEEKDAY})?{either(DATES)}(?:{either(CLOCKS)}{either(OFFSETS)}?)?\z"
    return pattern, _READ + _CUT + _CUT.join("".join(f"${g}" for g in groups[f]) for f in FIELDS)


SHAPES, FORM = _grammar()
USUAL_DATE = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}\z"
USUAL_STAMP = (
    r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ](?:[01][0-9]|2[0-3]):[0-5][0-9]:[0-5][0-9](?:\.[0-9]{1,6})?(?:Z|[+-](?:0[0-9]|1[0-5]):[0-5][0-9])?)?\z"
)


_SPACE = r"[ \t\n\x0B\f\r]"


def _space_trimmed(c: Column) -> Column:
    return F.regexp_replace(c, rf"^{_SPACE}+|{_SPACE}+\z", "")


def once(value: Column, then: Callable[[Column], Column]) -> Column:
    """`then` of a value that is worked out once. Spark interprets it, so what only few rows need does not swell the code of the rest."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def to_bool_loose(c: Column | str) -> Column:
    """T5."""
    word = F.lower(F.trim(col(c)))
    return F.when(word.isin(TRUE_WORDS), F.lit(True)).when(word.isin(FALSE_WORDS), F.lit(False))


def _integer(c: Column, spark_type: str) -> Column:
    # Spark's cast trims white space itself.
    plain = F.regexp_replace(c, r"(?<=[0-9])_(?=[0-9])", "")
    decimal = F.regexp_extract(plain, rf"\A{_SPACE}*[+-]?[0-9]+{_SPACE}*\z", 0).try_cast(spark_type)
    word = F.regexp_extract(F.lower(c), rf"\A{_SPACE}*({BASED_INT}){_SPACE}*\z", 1)
    based = once(word, lambda w: _based(w).try_cast(spark_type))
    return F.coalesce(decimal, F.when(F.rlike(c, F.lit("0[xXoObB]")), based))


def _based(word: Column) -> Column:
    """Digits to base 10 of a lower-case number with a base."""
    letter = F.regexp_extract(word, "[xob]", 0)
    bits = F.when(letter == "x", 4).when(letter == "o", 3).when(letter == "b", 1)
    digits = F.regexp_replace(word, r"^[+-]?0[xob]_*0*|_", "")
    # `conv` takes up to 64 bits; what is longer is out of range, and the cast decides about the last bit.
    # 22 octal digits are 64 bits only after a leading 1.
    number = F.when(
        (F.length(digits) * bits <= 64) | ((letter == "o") & F.rlike(digits, F.lit(OCTAL_64))),
        F.call_function("conv", F.concat(F.lit("0"), digits), F.call_function("shiftleft", F.lit(1), bits), F.lit(10)),
    )
    return F.concat(F.regexp_extract(word, "^-", 0), number)


def to_int_loose(c: Column | str) -> Column:
    """T7."""
    return _integer(col(c), "int")


def to_bigint_loose(c: Column | str) -> Column:
    """T8."""
    return _integer(col(c), "bigint")


def to_double_loose(c: Column | str) -> Column:
    """T9. Values too large or too small for a double are NULL, not infinity or zero."""
    c = col(c)
    number = F.regexp_extract(c, rf"\A{_SPACE}*(?:{FLOAT}){_SPACE}*\z", 0).try_cast("double")
    lost = (F.abs(number) == float("inf")) | ((number == 0) & F.rlike(c, F.lit(r"^\s*[+-]?[0-9.]*[1-9]")))
    word = F.regexp_extract(F.lower(c), rf"\A{_SPACE}*(?:[+-]?inf(?:inity)?|nan){_SPACE}*\z", 0).try_cast("double")
    return F.coalesce(F.when(~lost, number), word)


def to_numeric_loose(c: Column | str) -> Column:
    """T10. decimal(38,18); text that does not fit is NULL."""
    t = _space_trimmed(col(c))
    plain = F.regexp_replace(t, r"(?<=[0-9])_(?=[0-9])", "")
    return F.when(full_match(plain, FLOAT), plain.try_cast("decimal(38,18)"))


def _read(c: Column, then: Callable[[dict[str, Column]], Column]) -> Column:
    """`then` of the fields of a text in any of the shapes, each empty where the shape lacks it; NULL for other text."""
    plain = _space_trimmed(c)

    def told(cut: Column) -> Column:
        field = {name: F.get(cut, F.lit(i)) for i, name in enumerate(FIELDS, 1)}
        return F.when(F.get(cut, F.lit(0)) == _READ, then(field))

    return F.when(~F.contains(c, F.lit(_READ)), once(F.split(F.regexp_replace(plain, SHAPES, FORM), _CUT), told))


def _day(field: dict[str, Column]) -> Column:
    """The date as text."""
    year = F.when(F.length(field["year"]) == 2, F.concat(F.when(field["year"] < "70", "20").otherwise("19"), field["year"])).otherwise(field["year"])
    month = F.when(field["month"] >= "A", ((F.instr(F.lit(MONTHS), F.lower(F.substring(field["month"], 1, 3))) + 2) / 3).cast("int").cast("string")).otherwise(field["month"])
    origin = F.lit("1970-01-01").cast("date")
    julian = F.date_add(origin, field["julian"].try_cast("int") - 2440588)
    nth = F.date_add(F.concat(year, F.lit("-01-01")).try_cast("date"), field["doy"].try_cast("int") - 1)
    nth = F.when((field["doy"] > "000") & (F.year(nth) == year.try_cast("int")), nth)
    return (
        F.when(field["day"] != "", F.concat(year, F.lit("-"), month, F.lit("-"), field["day"]))
        .when(field["julian"] != "", julian.cast("string")).when(field["doy"] != "", nth.cast("string")).otherwise(origin.cast("string"))
    )


def _stamp(field: dict[str, Column]) -> Column:
    half, hour = field["half"], field["hour"]
    on_24 = (hour.try_cast("int") % 12 + F.when(F.lower(half) == "p", 12).otherwise(0)).cast("string")
    hour = F.when(half != "", on_24).when(hour == "24", F.lit("00")).otherwise(hour)
    or_zeros = lambda c: F.when(c == "", "00").otherwise(c)
    zones = F.create_map(*[F.lit(x) for pair in ZONES.items() for x in pair])
    zone = (
        F.when(field["sign"] != "", F.concat(field["sign"], F.lpad(field["oh"], 2, "0"), F.lit(":"), or_zeros(field["om"])))
        .when(field["zone"] != "", F.try_element_at(zones, F.lower(field["zone"]))).when(field["region"] != "", F.concat(F.lit(" "), field["region"])).otherwise("")
    )
    clock = F.concat(F.lit(" "), hour, F.lit(":"), field["minute"], F.lit(":"), or_zeros(field["second"]), zone)
    found = F.concat(_day(field), F.when(hour == "", "").otherwise(clock)).try_cast("timestamp")
    return F.when(field["hour"] == "24", found + F.expr("INTERVAL 24 HOURS")).otherwise(found)


def to_date_loose(c: Column | str) -> Column:
    """T11. A time and zone after the date are checked and dropped; the name of a region is not looked up."""
    c = col(c)
    return F.when(F.rlike(c, F.lit(USUAL_DATE)), c.try_cast("date")).otherwise(_read(c, lambda field: _day(field).try_cast("date")))


def to_timestamptz_loose(c: Column | str) -> Column:
    """T12. Text without a zone is UTC; a bare date is midnight."""
    c = col(c)
    return F.when(F.rlike(c, F.lit(USUAL_STAMP)), c.try_cast("timestamp")).otherwise(_read(c, _stamp))


LOOSE = {
    "boolean": to_bool_loose,
    "int": to_int_loose,
    "bigint": to_bigint_loose,
    "double": to_double_loose,
    "decimal": to_numeric_loose,
    "date": to_date_loose,
    "timestamp": to_timestamptz_loose,
}


def required(parsed: Column, source: Column, label: str) -> Column:
    """Raise when `source` holds text that `parsed` could not read."""
    message = F.concat(F.lit(f"invalid {label}: "), source)
    return F.coalesce(parsed, F.when(source.isNotNull(), F.raise_error(message)))


def strict_cast(c: Column | str, kind: str, on_error: str = "fail") -> Column:
    """T13. Empty text is NULL; other text that does not parse fails the job (or is NULL)."""
    source = F.nullif(col(c), F.lit(""))
    parsed = LOOSE[kind](source)
    return required(parsed, source, kind) if on_error == "fail" else parsed


def strict_key(c: Column | str, on_error: str = "reject") -> Column:
    """T14. Integer key; `fail` raises on bad text, `reject` leaves NULL for the classifier."""
    c = col(c)
    parsed = to_int_loose(c)
    return required(parsed, c, "integer key") if on_error == "fail" else parsed


def metric_or_zero(c: Column | str) -> Column:
    """T16. An integer that does not fit 64 bits fails the job, as a silent 0 would hide it."""
    return F.when(full_match(c, METRIC), col(c).cast("bigint")).otherwise(F.lit(0).cast("bigint"))


def metric_or_null(c: Column | str) -> Column:
    """T17."""
    return F.when(full_match(c, METRIC), col(c).cast("bigint"))


def pattern_date(c: Column | str, on_error: str = "null") -> Column:
    """T18. MM/DD/YYYY, one or two digits for month and day; blank is NULL."""
    c = col(c)
    found = F.regexp_extract(c, r"^\s*([0-9]{1,2}/[0-9]{1,2}/[0-9]{4})(?![0-9])", 1)
    parsed = F.try_to_date(F.nullif(found, F.lit("")), "M/d/yyyy")
    source = F.when(~blank(c), c)
    return required(parsed, source, "date") if on_error == "fail" else parsed


def month_start(c: Column | str, on_error: str = "null") -> Column:
    """T19. YYYY-MM to the first of the month; other shapes are NULL."""
    shaped = F.when(full_match(c, YEAR_MONTH), col(c))
    parsed = F.try_to_date(F.concat(shaped, F.lit("-01")), "yyyy-MM-dd")
    return required(parsed, shaped, "month") if on_error == "fail" else parsed
