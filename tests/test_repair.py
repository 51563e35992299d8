import json
import random
import re

import pytest

from loadkit.operators import damage, jsonish, ragged


def nesting(text, opener, closer):
    """Open brackets at the end of a text in which surplus closers count for nothing."""
    steps = [(ch == opener) - (ch == closer) for ch in text]
    return max(sum(steps[i:]) for i in range(len(steps) + 1))


def cuts(line, at):
    """Whether the comma at a place separates fields, judged from the text before it alone."""
    before = re.sub(r"\\.", "", line[:at])
    outside = "".join(before.split('"')[::2])
    return not (before.endswith("\\") or before.count('"') % 2 or nesting(outside, "[", "]") or nesting(outside, "{", "}"))


def fields_of(line):
    places = [-1, *(i for i, ch in enumerate(line) if ch == "," and cuts(line, i)), len(line)]
    return [line[i + 1 : j] for i, j in zip(places, places[1:])]


def test_split_fields(column):
    rng = random.Random(5)
    lines = ["1,[a,b],x", "1,t", '1,"a,b",c', "", ",", "a,b,,", '1,"a\\",b",c', "],1,[2,3", "{a,[b},c]", "\\,a,b", "a\\"]
    lines += ["".join(rng.choice('ab,,"[]{}\\é') for _ in range(rng.randint(0, 25))) for _ in range(400)]
    assert column(ragged.split_fields, lines) == [fields_of(x) for x in lines]
    assert column(ragged.split_fields, [None]) == [None]


def test_split_of_long_lines(spark, column):
    rng = random.Random(6)
    lines = ["".join(rng.choice('a,,,"[]{}\\') for _ in range(rng.choice([255, 256, 257, 600, 3000]))) for _ in range(40)]
    lines += ["[" + "a," * 50_000 + "]", '"' + "x," * 50_000 + '",b[', "a," * 50_000 + "[]", "\\," * 50_000 + "{}", "x" * 500_000 + ",[,]"]
    assert column(ragged.split_fields, lines) == [ragged.cut_fields(x) for x in lines]
    plan = spark.createDataFrame([("x",)], "x string").select(ragged.split_fields("x"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


@pytest.mark.parametrize("sink, line, want", [
    ("description", "1,[a,b],x", ["1", "[a,b]", "x"]), ("description", "1,t,x,y,z", ["1", "t", "x,y,z"]),
    ("description", "1,t", ["1", "t", ""]), ("description", '1,"a,b",c', ["1", '"a,b"', "c"]),
    ("tags", "1,t,x,y", ["1", "t,y", "x"]), ("id", "1,t,x,y,z", ["1,y,z", "t", "x"]), (None, "1,t,x,y", ["1", "t", "x,y"]),
])
def test_fit(texts, sink, line, want):
    row = ragged.fit_lines(texts([line], "line"), ["id", "tags", "description"], sink).first()
    assert row.fields == want
    assert row.repaired == (len(fields_of(line)) != 3)


def test_quotes_and_blanks(column):
    assert column(ragged.strip_outer_quotes, ['"a,b"', ' "x ""y""" ', '"', '""', 'a"b"', "", None, '"a\nb"', "\u00a0x\t"]) == [
        "a,b", 'x "y"', '"', "", 'a"b"', "", None, "a\nb", "x"]
    assert column(ragged.field_text, ["", " \t", '""', '" a "', None]) == [None, None, "", " a ", None]
    assert column(lambda c: ragged.field_text(c, empty_to_null=False), ["", " \t", '""']) == ["", "", ""]


def test_header(spark, tmp):
    from loadkit.sources import scan_lines

    def write(name, text):
        with open(f"{tmp}/{name}", "w", newline="") as f:
            f.write(text)

    write("a.csv", 'id,"tags",description\r\n1,a,b\r\n\r\nid,"tags",description\r\n')
    write("b.csv", 'id,"tags",description\n2,c,d')
    lines = scan_lines(spark, tmp, keep_cr=True)
    heads = ragged.first_lines(lines)
    assert ragged.header_names(heads) == ["id", "tags", "description"]
    body = ragged.body_lines(lines, heads)
    assert sorted(r.line for r in body.collect()) == ["1,a,b", "2,c,d", 'id,"tags",description']
    write("c.csv", "id,other\n")
    with pytest.raises(ValueError, match="different"):
        ragged.header_names(ragged.first_lines(scan_lines(spark, tmp, keep_cr=True)))
    with pytest.raises(ValueError, match="sink"):
        ragged.fit_lines(body, ["id"], "nope")


def test_jsonish(texts):
    cases = [
        ("", None, False), ("None", None, False), (" NULL ", None, False), ('""', None, False), ('["a", 1]', '["a",1]', False),
        ('"[""a"", 1]"', '["a",1]', False), ("['a', None, True]", '["a", null, true]', False), ("{'k': (1, 2)}", '{"k": [1, 2]}', False),
        ("[broken", '"[broken"', False), ("[a b]", '"[a b]"', False), ("{1,2}", None, True), ("plain é", '"plain é"', False), ("12", '"12"', False),
        (None, None, False),
    ]
    rows = jsonish.parse_jsonish(texts([c[0] for c in cases]), ["x"]).orderBy("i").collect()
    assert [(c[0], r.x, r.jsonish_bad) for c, r in zip(cases, rows)] == cases


def test_plain_literals_like_python(spark, column):
    rng = random.Random(21)
    pieces = ["'a'", "'it\\'s'", '"say \\"x\\""', "'say \"x\"'", "'\\\\'", "'\\n'", '"\\\\\'"', "'é😀'", "'\\x41'", "'\\u0041'", "'/'", "'k': 1", "'k': 'v'", "'l': [1, 2.5]", "1", "-7", "0", "-0", "01", "1.0",
              "1.50", "0.00001", "0.25", "1e3", "1_0", "123456789012345678901", "None", "True", "False", "None ", " ", ",", ",", ", ", "[", "]", "{", "}", "(1, 2)", "b'x'", "x", "\t", "\n", "'a' 'b'", "{1, 2}"]
    boxes = [("[", "]"), ("{", "}")]

    def made(depth):
        opener, closer = rng.choice(boxes)
        given = [rng.choice(pieces) if depth == 0 or rng.random() < 0.7 else made(depth - 1) for _ in range(rng.randint(0, 4))]
        if opener == "{":
            given = [x if ":" in x[:5] else f"'{rng.choice('abc')}': {x}" for x in given]
        return opener + rng.choice([", ", ", ", ",", " , "]).join(given) + closer

    lines = [made(rng.randint(0, 3)) for _ in range(3000)]
    lines += [rng.choice("[{") + "".join(rng.choices(pieces, k=rng.randint(0, 6))) + rng.choice("]}") for _ in range(2000)]
    lines += ["[" * 300 + "'a'" + "]" * 300, "[" + "'a', " * 20_000 + "1]", "['" + "x" * 500_000 + "']", "['" + "\\'" * 100_000 + "']", "{'a': 1, 'a': 2}", "[1 2]"]
    got = column(jsonish.plain_literal, lines)
    assert sum(g is not None for g in got) > 1000
    assert [(x, g) for x, g in zip(lines, got) if g is not None and (g, False) != jsonish.literal_to_json(x)] == []
    plain = ["['a', None, True]", "{'k': 'it\\'s', 'n': [1, -2.5, {}]}", "[ 'say \"x\"' ,\n0 ]"]
    assert column(jsonish.plain_literal, plain) == ['["a", null, true]', '{"k": "it\'s", "n": [1, -2.5, {}]}', '["say \\"x\\"", 0]']
    assert column(jsonish.plain_literal, [None, "{1,2}", "[broken", "{'a': 1, 'a': 2}", "[1 2]", "[,]", "(1)"]) == [None] * 7


def test_sanitize(column):
    assert column(damage.sanitize, ["a\x00b\tc\x7f", "\\xe9", "\\d\\n\\\"", "\\'", None]) == ["abc", "xe9", '\\\\d\\n\\"', "\\\\'", None]


_QUOTE_OR_ESCAPE = re.compile(r'\\.|"', re.DOTALL)
_CLOSES = re.compile(r"\s*[,}]")


def escape_bare_quotes(line: str, name: str) -> str:
    """B9, mark by mark. Escape quotes inside the named field's string that no comma or brace follows.

    The line comes back unchanged when the field is absent, no string, or never closes.
    """
    at = line.find(f'"{name}"')
    opening = re.compile(r':\s*"').match(line, line.find(":", at)) if at >= 0 and line.find(":", at) >= 0 else None
    if opening is None:
        return line
    out, done = [line[: opening.end()]], opening.end()
    for mark in _QUOTE_OR_ESCAPE.finditer(line, opening.end()):
        if mark.group() != '"':
            continue
        out.append(line[done : mark.start()])
        done = mark.start()
        if _CLOSES.match(line, mark.end()):
            return "".join(out) + line[done:]
        out.append('\\"')
        done = mark.end()
    return line


def test_bare_quotes_as_column(spark, column):
    rng = random.Random(12)
    pieces = ['"', '"', "\\", '\\"', ",", "}", " ", "\u00a0", "\x1c", "\n", "a", "é😀", ":", '"description"', '"description":"', '"description" : "', '{"n":1,', '{"description":5,']
    lines = ["".join(rng.choices(pieces, k=rng.randint(0, 14))) for _ in range(3000)]
    lines += ['{"description":"' + "".join(rng.choices(pieces, k=rng.randint(0, 9))) + '","n":1}' for _ in range(1000)]
    lines += ['{"description":"' + 'say "hi" ' * 60_000 + '"}', '{"description":"' + "x" * 500_000 + '" y"}', '{"description":"' + "\\\\" * 200_000, None, ""]
    want = [x if x is None else escape_bare_quotes(x, "description") for x in lines]
    assert sum(w != x for w, x in zip(want, lines)) > 300
    assert column(damage.repair_quotes, lines) == want
    for name in ("a:b", "a.b", 'x"y'):
        given = [x and x.replace("description", name) for x in lines[:4000:10]]
        assert column(lambda c: damage.repair_quotes(c, name), given) == [x and escape_bare_quotes(x, name) for x in given]
    plan = spark.createDataFrame([("x",)], "x string").select(damage.repair_quotes("x"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_bare_quotes():
    fix = lambda s: escape_bare_quotes(s, "description")
    assert fix('{"description":"say "hi" now","n":1}') == '{"description":"say \\"hi\\" now","n":1}'
    assert fix('{"description": "a\\"b" c"}') == '{"description": "a\\"b\\" c"}'
    for same in ['{"n":1}', '{"description"', '{"description":5}', '{"description":"never', '{"description":"fine","n":1}', '{"description":"a "b']:
        assert fix(same) == same
    assert fix('{"description":"a "b", c"}') == '{"description":"a \\"b", c"}'


def test_repair_or_reject(texts):
    lines = ['{"n":1}', "", '{"description":"say "hi" now","n":2}', '{"description":"a "b", c"}', '{"n":"\\d\x01"}', " \t", "x"]
    good, bad = damage.repair_or_reject(texts(lines, "line"))
    rows = good.orderBy("i").collect()
    assert [json.loads(r.record) for r in rows] == [{"n": 1}, {"description": 'say "hi" now', "n": 2}, {"n": "\\d"}]
    assert [r.repaired for r in rows] == [False, True, True]
    assert [r.line for r in bad.orderBy("i").collect()] == [lines[3], "x"]
