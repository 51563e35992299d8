"""The loose casts as SQL functions, for use from spark.sql."""

from __future__ import annotations

from pyspark.sql import SparkSession

from loadkit.functions import casts


def _once(value: str, name: str, then: str) -> str:
    return f"get(transform(array({value}), {name} -> {then}), 0)"


def _words(words: list[str]) -> str:
    return ", ".join(f"'{w}'" for w in words)


def _trimmed() -> str:
    return rf"regexp_replace(txt, r'^{casts._SPACE}+|{casts._SPACE}+\z', '')"


def _integer(kind: str) -> str:
    space = casts._SPACE
    plain = "regexp_replace(txt, r'(?<=[0-9])_(?=[0-9])', '')"
    word = rf"regexp_extract(lower(txt), r'\A{space}*({casts.BASED_INT}){space}*\z', 1)"
    letter = "regexp_extract(word, '[xob]', 0)"
    bits = f"CASE {letter} WHEN 'x' THEN 4 WHEN 'o' THEN 3 WHEN 'b' THEN 1 END"
    digits = "regexp_replace(word, r'^[+-]?0[xob]_*0*|_', '')"
    wide = f"({letter} = 'o' AND rlike({digits}, r'{casts.OCTAL_64}'))"
    number = f"CASE WHEN length({digits}) * {bits} <= 64 OR {wide} THEN conv(concat('0', {digits}), shiftleft(1, {bits}), 10) END"
    based = _once(word, "word", f"try_cast(concat(regexp_extract(word, '^-', 0), {number}) AS {kind})")
    return rf"""coalesce(try_cast(regexp_extract({plain}, r'\A{space}*[+-]?[0-9]+{space}*\z', 0) AS {kind}),
        CASE WHEN rlike(txt, '0[xXoObB]') THEN {based} END)"""


def _double() -> str:
    space = casts._SPACE
    number = rf"try_cast(regexp_extract(txt, r'\A{space}*(?:{casts.FLOAT}){space}*\z', 0) AS double)"
    lost = rf"abs({number}) = double('Infinity') OR ({number} = 0 AND rlike(txt, r'^\s*[+-]?[0-9.]*[1-9]'))"
    word = rf"try_cast(regexp_extract(lower(txt), r'\A{space}*(?:[+-]?inf(?:inity)?|nan){space}*\z', 0) AS double)"
    return f"coalesce(CASE WHEN NOT ({lost}) THEN {number} END, {word})"


def _numeric() -> str:
    plain = rf"regexp_replace({_trimmed()}, r'(?<=[0-9])_(?=[0-9])', '')"
    return rf"CASE WHEN rlike({plain}, r'\A(?:{casts.FLOAT})\z') THEN try_cast({plain} AS decimal(38,18)) END"


def _field(name: str) -> str:
    return f"get(cut, {casts.FIELDS.index(name) + 1})"


def _read(then: str) -> str:
    """`then` over the fields of a text in one of the shapes of `casts`."""
    cut = f"split(regexp_replace({_trimmed()}, r'{casts.SHAPES}', '{casts.FORM}'), '{casts._CUT}')"
    told = _once(cut, "cut", f"CASE WHEN get(cut, 0) = '{casts._READ}' THEN {then} END")
    return f"CASE WHEN NOT contains(txt, '{casts._READ}') THEN {told} END"


def _day() -> str:
    year = f"CASE WHEN length({_field('year')}) = 2 THEN concat(CASE WHEN {_field('year')} < '70' THEN '20' ELSE '19' END, {_field('year')}) ELSE {_field('year')} END"
    number = f"cast(cast((instr('{casts.MONTHS}', lower(substring({_field('month')}, 1, 3))) + 2) / 3 AS int) AS string)"
    month = f"CASE WHEN {_field('month')} >= 'A' THEN {number} ELSE {_field('month')} END"
    julian = f"date_add(DATE'1970-01-01', try_cast({_field('julian')} AS int) - 2440588)"
    nth = f"date_add(try_cast(concat({year}, '-01-01') AS date), try_cast({_field('doy')} AS int) - 1)"
    nth = f"CASE WHEN {_field('doy')} > '000' AND year({nth}) = try_cast({year} AS int) THEN {nth} END"
    return (
        f"CASE WHEN {_field('day')} <> '' THEN concat({year}, '-', {month}, '-', {_field('day')}) WHEN {_field('julian')} <> '' THEN cast({julian} AS string) "
        f"WHEN {_field('doy')} <> '' THEN cast({nth} AS string) ELSE '1970-01-01' END"
    )


def _timestamp() -> str:
    half, hour = _field("half"), _field("hour")
    zones = ", ".join(f"'{k}', '{v}'" for k, v in casts.ZONES.items())
    or_zeros = lambda c: f"CASE WHEN {c} = '' THEN '00' ELSE {c} END"
    on_24 = f"cast(try_cast({hour} AS int) % 12 + CASE WHEN lower({half}) = 'p' THEN 12 ELSE 0 END AS string)"
    read = f"CASE WHEN {half} <> '' THEN {on_24} WHEN {hour} = '24' THEN '00' ELSE {hour} END"
    zone = (
        f"CASE WHEN {_field('sign')} <> '' THEN concat({_field('sign')}, lpad({_field('oh')}, 2, '0'), ':', {or_zeros(_field('om'))}) "
        f"WHEN {_field('zone')} <> '' THEN try_element_at(map({zones}), lower({_field('zone')})) WHEN {_field('region')} <> '' THEN concat(' ', {_field('region')}) ELSE '' END"
    )
    clock = f"CASE WHEN {hour} = '' THEN '' ELSE concat(' ', {read}, ':', {_field('minute')}, ':', {or_zeros(_field('second'))}, {zone}) END"
    found = f"try_cast(concat({_day()}, {clock}) AS timestamp) + CASE WHEN {hour} = '24' THEN INTERVAL 24 HOURS ELSE INTERVAL 0 HOURS END"
    return f"CASE WHEN rlike(txt, r'{casts.USUAL_STAMP}') THEN try_cast(txt AS timestamp) ELSE {_read(found)} END"


def _date() -> str:
    return f"CASE WHEN rlike(txt, r'{casts.USUAL_DATE}') THEN try_cast(txt AS date) ELSE {_read(f'try_cast({_day()} AS date)')} END"


def _jsonb() -> str:
    from loadkit.functions.json import BAD_ESCAPE

    # The same steps, in the same order, as the Column form.
    t = "replace(replace(replace(txt, 'None', 'null'), 'True', 'true'), 'False', 'false')"
    t = rf"""regexp_replace({t}, r"([\p{{L}}\p{{N}}])'([\p{{L}}\p{{N}}])", '$1@@APOS@@$2')"""
    t = rf"""replace({t}, r"\'", '@@APOS@@')"""
    t = rf"regexp_replace({t}, r'\\x([0-9A-Fa-f]{{2}})', 'x$1')"
    t = rf"""regexp_replace({t}, r'\\([^"\\/bfnrtu])', r'\\\\$1')"""
    t = f"""replace(replace({t}, "'", '"'), '@@APOS@@', "'")"""
    close = f"""CASE WHEN NOT rlike({t}, r'{BAD_ESCAPE}') THEN '"]' END"""
    w = f"""try_parse_json(concat('[', {t}, ',"', sha2({t}, 256), {close}))"""
    seen = f"map(coalesce(try_variant_get({w}, '$[1]', 'string'), ''), try_variant_get({w}, '$[0]', 'variant'))"
    return f"coalesce(try_element_at({seen}, sha2({t}, 256)), CASE WHEN trim(txt) <> '' THEN cast(txt AS variant) END)"


def definitions() -> dict[str, tuple[str, str]]:
    """Name -> (return type, SQL body over the argument `txt`)."""
    return {
        "to_bool_loose": (
            "BOOLEAN",
            f"CASE WHEN lower(trim(txt)) IN ({_words(casts.TRUE_WORDS)}) THEN true "
            f"WHEN lower(trim(txt)) IN ({_words(casts.FALSE_WORDS)}) THEN false END",
        ),
        "to_int_loose": ("INT", _integer("INT")),
        "to_bigint_loose": ("BIGINT", _integer("BIGINT")),
        "to_double_loose": ("DOUBLE", _double()),
        "to_numeric_loose": ("DECIMAL(38,18)", _numeric()),
        "to_timestamptz_loose": ("TIMESTAMP", _timestamp()),
        "to_date_loose": ("DATE", _date()),
        "to_jsonb_loose": ("VARIANT", _jsonb()),
    }


def register(spark: SparkSession) -> list[str]:
    """Create the loose casts as temporary SQL functions of this session."""
    for name, (kind, body) in definitions().items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(txt STRING) RETURNS {kind} RETURN {body}")
    return list(definitions())

