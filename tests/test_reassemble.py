import json
import os
import random
import re

import pytest

from loadkit.operators.reassemble import reassemble, split_json_list
from loadkit.sources import number_lines, read_json_list, scan_lines


STRING = re.compile(r'"(?:[^"\\]|\\.)*(?P<end>"|\\?\Z)')


def place(before):
    """In a string, in brackets or between records, judged from the text before alone."""
    text = re.sub(r"[\r\n]", "", before)
    strings = list(STRING.finditer(text))
    if strings and strings[-1]["end"] != '"':
        return "string"
    steps = [1 if ch in "{[" else -1 for ch in re.findall(r"[{}\[\]]", STRING.sub("", text))]
    return "brackets" if max(sum(steps[i:]) for i in range(len(steps) + 1)) else "between"


FORMS = {("\n", "string"): "\\n", ("\n", "brackets"): " ", ("\n", "between"): "\0", ("\r", "string"): "\\r"}


def expected(text):
    """Records, line breaks and carriage returns in strings."""
    places = {m.start(): (m.group(), place(text[: m.start()])) for m in re.finditer(r"[\r\n]", text)}
    whole = "".join(FORMS.get(places[i], " ") if i in places else ch for i, ch in enumerate(text))
    found = list(places.values())
    return [r.strip() for r in whole.split("\0") if r.strip()], found.count(("\n", "string")), found.count(("\r", "string"))


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)


def records(spark, path, split_bytes):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        rows = reassemble(scan_lines(spark, path, keep_cr=True)).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    rows.sort(key=lambda r: (r.file, r.block, r.idx))
    return [r.record for r in rows], sum(r.newlines for r in rows), sum(r.returns for r in rows)


CASES = [
    '{"a":"x\ny"}', '{"a":1,\n"b":2}\n{"c":3}', '}\n{"a":1}\n', '{"é":"ü\n채"}\n\n[1,\n[2]]', '{"a":"x\r\ny"}\r\n{"b":1,\r\n"c":2}\r\n',
    '{"a":"\\\n"}\n{"b":2}', '{"a":"\\"\n"}', '"open\nnever\nclosed', "plain\ntext", '{"k":"}\n{"}\n{"z":[\n]}',
]


@pytest.mark.parametrize("text", CASES)
def test_cases(spark, tmp, text):
    put(f"{tmp}/f.ndjson", text)
    assert records(spark, tmp, 1 << 20) == expected(text)


@pytest.mark.parametrize("split_bytes", [1 << 20, 200, 37])
def test_any_split_gives_the_same(spark, tmp, split_bytes):
    rng = random.Random(3)
    texts = {}
    for name in ["a", "b"]:
        parts = []
        for _ in range(60):
            value = {"k": "".join(rng.choice('xy"\\\n\r{}[] é') for _ in range(rng.randint(0, 20))), "n": [rng.randint(0, 9)] * rng.randint(0, 3)}
            text = json.dumps(value, ensure_ascii=False, indent=rng.choice([None, None, 1]))
            parts.append(text.replace("\\n", "\n").replace("\\r", "\r"))
        texts[name] = "\n".join(parts) + rng.choice(["", "\n"])
        put(f"{tmp}/{name}.ndjson", texts[name])
    want = [expected(texts[n]) for n in ["a", "b"]]
    got = records(spark, tmp, split_bytes)
    assert got == (want[0][0] + want[1][0], want[0][1] + want[1][1], want[0][2] + want[1][2])


@pytest.mark.parametrize("split_bytes", [1 << 20, 50])
def test_line_numbers_do_not_depend_on_splits(spark, tmp, split_bytes):
    for name, n in [("a", 40), ("b", 7), ("c", 90)]:
        put(f"{tmp}/{name}.ndjson", "".join(f"{name}{i}\n" for i in range(n)))
    want = [f"{name}{i}" for name, n in [("a", 40), ("b", 7), ("c", 90)] for i in range(n)]
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(split_bytes))
    try:
        rows = number_lines(scan_lines(spark, tmp)).select("line_no", "line").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [(r.line_no, r.line) for r in sorted(rows)] == list(enumerate(want, 1))


@pytest.mark.parametrize("read", [read_json_list, split_json_list])
def test_json_list(spark, tmp, read):
    items = [{"a": "x,[y", "b": None}, 2, "s]", [1, [2, 3]], {}, "é\n", None] * 5
    put(f"{tmp}/x.json", json.dumps(items, ensure_ascii=False))
    put(f"{tmp}/y.json", " [ ]\n")
    put(f"{tmp}/z.json", "[[1]]")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "60")
    try:
        frame = read(spark, f"{tmp}/[xyz].json")
        order = [c for c in ["file", "block", "idx", "pos"] if c in frame.columns]
        got = [json.loads(r.line) for r in frame.orderBy(*order).collect()]
        assert got == items + [[1]]
        for i, bad in enumerate(['{"a":1}', "[1,2", "[1],2]", "[1,,2]", "[1] x", "[1]]", "[a]"]):
            put(f"{tmp}/bad{i}/f.json", bad)
            with pytest.raises(Exception, match="JSON list"):
                read(spark, f"{tmp}/bad{i}").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_a_quote_that_is_never_closed_fails_with_its_place(spark, tmp, monkeypatch):
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    try:
        with open(f"{tmp}/open.ndjson", "w") as out:
            out.write('{"a":1}\n{"b":"never\n' + "some more text\n" * 200)
        lines = scan_lines(spark, f"{tmp}/open.ndjson", keep_cr=True)
        with pytest.raises(ValueError, match=r"open\.ndjson from the split at byte 0"):
            reassemble(lines, longest=1000)
        # Within the bound every byte is there.
        records = [r.record for r in reassemble(lines).orderBy("block", "idx").collect()]
        assert records[0] == '{"a":1}' and records[1].startswith('{"b":"never\\n') and records[1].count("some more text\\n") == 200
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_summaries_are_told_as_they_come():
    import pyarrow as pa

    from loadkit.operators import reassemble as module

    n = 2 * module._SUMMARIES + 5
    batch = pa.RecordBatch.from_pydict({"file": ["f"] * n, "block": list(range(n)), "line": ["{}"] * n})
    told = list(module._summarise("")(iter([batch])))
    assert len(told) == 3 and sum(b.num_rows for b in told) == n
