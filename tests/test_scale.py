"""What a task takes on does not grow with the input."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from loadkit import session
from loadkit.queries import QUERIES, loads, repairs, tables
from loadkit.sources import scan_csv
from loadkit.sources.csv import rows_of


def test_sorted_files_grow_in_number(spark, tmp, monkeypatch):
    monkeypatch.setattr(loads, "FILE_ROWS", 50)
    rows = spark.range(2000).select("id", F.col("id").cast("string").alias("line"))
    path = loads.write_sorted(rows, ["id"], f"{tmp}/in")
    files = sorted(spark.read.text(path).inputFiles())
    assert len(files) >= 30
    assert [int(r.value) for f in files for r in spark.read.text(f).collect()] == list(range(2000))
    assert loads.half(spark, path) == -(-len(files) // 2)


def test_splits_and_whole_files_grow_with_the_input(spark, monkeypatch):
    assert repairs.split_bytes(1000, 12) == 16384
    assert (1 << 30) // repairs.split_bytes(1 << 30, 12) <= 8 * 12 + 1
    monkeypatch.setattr(repairs, "FILE_BYTES", 100)
    lines = spark.range(100).select(F.repeat(F.lit("x"), 40).alias("line"))
    assert repairs.file_count(lines, 8) == 40 and repairs.file_count(lines.limit(0), 8) == 8


def test_rows_of_texts_without_a_list_of_lines():
    for text in ["", "a", "a\n", "\n", "a\n\n", 'a,"x\ny"\nb', '"open\nend\n', "a\n\nb"]:
        lines = text.split("\n")
        if '"' not in text:
            assert list(rows_of(text, "\n")) == (lines if lines[-1] else lines[:-1])
    assert list(rows_of('a,"x\ny"\nb', "\n")) == ['a,"x\ny"', "b"]
    assert list(rows_of('"open\nend\n', "\n")) == ['"open\nend\n']


def size_of(path):
    return sum(os.path.getsize(os.path.join(d, n)) for d, _, names in os.walk(path) for n in names if not n.endswith(".crc"))


@pytest.fixture
def scratch(tmp, monkeypatch):
    """A scratch folder of this test's own."""
    for module in (session, tables):
        monkeypatch.setattr(module, "scratch_dir", lambda spark: f"{tmp}/ck")
    return f"{tmp}/ck"


def test_row_ends_hold_each_text_once_in_each_set_of_files(spark, scratch):
    """No pieces staged and no open text: less than four times the table, which its limit on disk allows."""
    found = QUERIES["csv_row_ends"](spark, "/root/testdata/sf0.01")
    assert size_of(scratch) < 4 * os.path.getsize("/root/testdata/sf0.01/documents.parquet")
    assert found.count() == 6000


def test_files_of_rows_each_have_a_head(spark, tmp):
    lines = spark.range(0, 1000, 1, 3).select(F.concat(F.lit("x"), F.col("id").cast("string")).alias("line"))
    rows, uneven = repairs.rows_a_file(lines, 10)
    assert (rows, uneven) == (100, False)
    repairs.headed(lines, f"{tmp}/out", "h\nead", "\r", 100, "none")
    texts = [open(f, newline="").read().split("\r") for f in glob.glob(f"{tmp}/out/part-*")]
    assert len(texts) == 12 and all(t[0] == "h\nead" and t[-1] == "" and len(t) <= 102 for t in texts)
    assert sorted(x for t in texts for x in t[1:-1]) == sorted(f"x{i}" for i in range(1000))
    lone = spark.range(0, 100, 1, 1).select(F.expr("repeat('x', 1000000)").alias("line"))
    assert repairs.rows_a_file(lone, 50) == (2, True)


def test_records_cut_when_read_stage_only_what_crosses_splits(spark, tmp, scratch):
    from tests.test_reassemble import put

    put(f"{tmp}/in.csv", "\n\na,b\n" + "".join(f'{i},"x\ny{"z" * (i % 50)}"\n' for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9001")
    try:
        found = scan_csv(spark, f"{tmp}/in.csv", ["a", "b"], whole_file=0)
        pieces = spark.read.parquet(*glob.glob(f"{scratch}/stage-pieces-*"))
        assert 0 < pieces.count() < 60
        assert sorted((int(r.a), r.b) for r in found.collect()) == [(i, f"x\ny{'z' * (i % 50)}") for i in range(3000)]
        found = scan_csv(spark, f"{tmp}/in.csv", ["a", "b"], whole_file=0)
        spark.conf.set("spark.sql.files.maxPartitionBytes", "18002")
        with pytest.raises(Exception, match="the splits of a file must stay"):
            found.collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
