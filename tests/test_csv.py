import json
import os
import random
import subprocess
import sys
import textwrap

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from loadkit.sources import POSITION, scan_csv
from loadkit.sources.csv import csv_step, first_row_end, rows_of
from tests.test_reassemble import put

NAMES = ["a", "b", "c"]
ENDS = {"lf": "\n", "crlf": "\r\n", "cr": "\r"}


def field(value, end, rng):
    """A field as written; a text that is quoted needlessly stays the same value."""
    if value is None:
        return ""
    plain = value and not any(c in value for c in '",\r\n')
    return value if plain and rng.random() < 0.7 else '"' + value.replace('"', '""') + '"'


def made_files(seed, n):
    """{name: (text, rows)}: files with each row end, with any line breaks in quotes."""
    rng = random.Random(seed)
    files = {}
    for i in range(n):
        kind = rng.choice(list(ENDS))
        end = ENDS[kind]
        values = [None, "", "x", "é채", "x\ny", "x\r\ny", "x\ry", "\r", "\n", "\r\n", '"', 'a"b', '","', "a,b", "\n\"\r\n\"", "long " * 12]
        rows = [tuple(rng.choice(values) for _ in NAMES) for _ in range(rng.randint(0, 12))]
        # A row of nothing but one empty field would be a blank line; three fields never are.
        lines = ['x,"y\r\n""z",w' if rng.random() < 0.3 else "x,y,z", *[",".join(field(v, end, rng) for v in r) for r in rows]]
        blanks = [line if rng.random() < 0.9 else line + end for line in lines]
        files[f"{i:03d}-{kind}.csv"] = (end.join(blanks) + rng.choice([end, ""]), rows)
    return files


def test_every_row_end_reads_alike_at_every_size(spark, tmp):
    files = made_files(5, 26)
    for name, (text, _) in files.items():
        put(f"{tmp}/in/{name}", text)
    want = [r for name in sorted(files) for r in files[name][1]]
    assert len(want) > 80
    whole = [tuple(r[c] for c in NAMES) for r in scan_csv(spark, f"{tmp}/in", NAMES, position=True).orderBy(*POSITION).collect()]
    assert whole == want
    for size in ("96",):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            split = [tuple(r[c] for c in NAMES) for r in scan_csv(spark, f"{tmp}/in", NAMES, position=True, whole_file=0).orderBy(*POSITION).collect()]
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert split == want


def test_open_quotes_keep_the_rest_of_the_file(spark, tmp):
    for name, end in ENDS.items():
        put(f"{tmp}/in/{name}.csv", f"a,b{end}1,2{end}3,\"open{end}x,y{end}")
        put(f"{tmp}/in/{name}-none.csv", f"a,b{end}1,2{end}3,\"open{end}x,y")
    read = lambda **more: sorted(tuple(r) for r in scan_csv(spark, f"{tmp}/in", ["a", "b"], **more).collect())
    whole = read()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8")
    try:
        assert read(whole_file=0) == whole and len(whole) == 12
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@settings(max_examples=500, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list('ab,"\r\n')), max_size=12), min_size=1, max_size=6), st.sampled_from(["\n", "\r"]), st.integers(0, 80))
def test_states_do_not_depend_on_where_a_walk_begins(fields, sep, cut):
    """Rows from the start equal rows found by stepping line by line over two halves."""
    text = ",".join(fields)
    state, halves = 0, []
    for half in (text[:cut], text[cut:]):
        halves.append(half)
    lines = "".join(halves).split(sep)
    if not lines[-1]:
        del lines[-1]
    held, rows = [], []
    for line in lines:
        held.append(line)
        state = csv_step(line.replace("\r", ""), state)[0]
        if state == 0:
            rows.append(sep.join(held))
            held = []
    rows += [sep.join(held) + (sep if text.endswith(sep) else "")] if held else []
    assert list(rows_of(text, sep)) == rows


@pytest.mark.parametrize("text, end", [
    ("a,b\n1", "\n"), ("a,b\r\n1", "\n"), ("a,b\r1", "\r"), ("a,b\r", "\r"), ("a,b", "\n"), ("", "\n"), ('"x\ry"\n', "\n"), ('"x\n""\ny"\r1,2\n', "\r"), ('a"b\r"c\n', "\r"), ('"x\n', "\n"), ('"x"', "\n"), (',"\n",\r\r\n', "\r"),
])
def test_row_end_of_a_file(text, end):
    assert first_row_end(text, whole=True) == end
    told = [first_row_end(text[:n], whole=False) for n in range(len(text) + 1)]
    assert set(told) <= {None, end}


def test_long_heads(spark, tmp):
    put(f"{tmp}/long.csv", '"' + "x\n" * 100_000 + '",b\r1,2\r3,"4\n"\r')
    for size in (0, 1 << 30):
        assert sorted(tuple(r) for r in scan_csv(spark, f"{tmp}/long.csv", ["a", "b"], whole_file=size).collect()) == [("1", "2"), ("3", "4\n")]


def test_code_travels_to_workers_without_the_package(tmp):
    """Queries whose Python runs on executors, from a folder where workers cannot import the package."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    script = textwrap.dedent(f"""
        import json, sys
        sys.path.insert(0, {root!r})
        from pyspark.sql import SparkSession
        from pyspark.sql import functions as F
        spark = SparkSession.builder.master("local[4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "4").config("spark.checkpoint.dir", {tmp + "/ck"!r}).getOrCreate()
        spark.sparkContext.setLogLevel("OFF")
        def there(batches):
            import importlib.util
            import pyarrow as pa
            for b in batches:
                yield pa.RecordBatch.from_pydict({{"found": [importlib.util.find_spec("loadkit") is not None]}})
        out = {{"there": [r.found for r in spark.range(1).mapInArrow(there, "found boolean").collect()]}}
        from __spark_entry__ import queries
        known = queries()
        for name in ["record_reassembly", "json_list_parallel", "csv_quoted_breaks", "csv_row_ends", "quote_repair", "csv_split", "jsonish_column", "op6_bpe"]:
            if name in known:
                try:
                    out[name] = known[name](spark, "/root/testdata/sf0.001").count()
                except Exception as error:
                    out[name] = str(error)[-600:]
        print("OUT" + json.dumps(out))
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, "-c", script], cwd=tmp, env=env, capture_output=True, text=True, timeout=600)
    out = json.loads(done.stdout.split("OUT")[1]) if "OUT" in done.stdout else done.stderr[-2000:]
    assert out["there"] == [False], out
    assert all(isinstance(n, int) and n > 0 for name, n in out.items() if name != "there"), out
