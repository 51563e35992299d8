"""Writers and versioned tables.

A table is a folder of versions, `v=1`, `v=2`, ...; Spark writes `_SUCCESS` last, so the newest
version that has one is the table. A new version is complete before anyone can see it, which also
lets a load read the table it replaces.

Where a load changes partitions of the live version, or adds to it, the finished rows are staged first. A
marker `_pending` in the version then names them, and goes when the change is done. Whoever finds the
marker repeats the change from the staged rows before anything else, so a reader sees the table before
or after the load, never a mixture that a failed load left. Loads of one table run one after the other.
"""

from __future__ import annotations

import csv
import io
import json
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit.session import stage


def ndjson_lines(df: DataFrame) -> DataFrame:
    """Rows as JSON objects, nulls as explicit keys, non-ASCII kept (A5)."""
    return df.select(F.to_json(F.struct("*"), {"ignoreNullFields": "false"}).alias("value"))


def write_ndjson(df: DataFrame, path: str) -> None:
    ndjson_lines(df).write.mode("errorifexists").text(path, lineSep="\n")


def write_lines(df: DataFrame, path: str, column: str = "line") -> None:
    """Write a column of finished records, one per line."""
    df.select(F.col(column).alias("value")).write.mode("errorifexists").text(path, lineSep="\n")


def write_csv(df: DataFrame, path: str) -> None:
    """Minimal quoting, quotes doubled, CRLF row ends, a header in each file (A6). Line breaks within fields stay as they are."""
    options = {"quote": '"', "escape": '"', "emptyValue": "", "nullValue": "", "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
    names = io.StringIO()
    csv.writer(names, lineterminator="").writerow(df.columns)
    head = pa.RecordBatch.from_pydict({"value": [names.getvalue()]})

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield head
        yield from batches

    # Spark's CSV writer would turn line breaks within fields into row ends, so finished rows are written as text.
    rows = df.select(F.to_csv(F.struct(*[F.col(f"`{c}`") for c in df.columns]), options).alias("value"))
    rows.mapInArrow(headed, "value string").write.mode("errorifexists").text(path, lineSep="\r\n")


def write_split(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Write a reject or orphan frame."""
    df.write.mode(mode).parquet(path)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of `schema` in order and type; a missing one is a typed NULL."""
    return df.select(*[
        (F.col(f"`{f.name}`") if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def _fs(spark: SparkSession, path: str):
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()), jvm_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, where = _fs(spark, path)
    return fs.exists(where)


def _versions(spark: SparkSession, root: str) -> tuple[list[int], list[int]]:
    """Numbers of all versions and of the complete ones."""
    fs, where = _fs(spark, root)
    if not fs.exists(where):
        return [], []
    numbers = [int(s.getPath().getName()[2:]) for s in fs.listStatus(where) if s.getPath().getName().startswith("v=")]
    return numbers, [n for n in numbers if exists(spark, f"{root}/v={n}/_SUCCESS")]


def current_path(spark: SparkSession, root: str) -> str | None:
    """Folder of the newest complete version; a change of it that was broken off is finished first."""
    complete = _versions(spark, root)[1]
    if not complete:
        return None
    path = f"{root}/v={max(complete)}"
    _finish_change(spark, path)
    return path


def change_partitions(rows: DataFrame, root: str, partition_by: str) -> None:
    """Replace the partitions of the live version that `rows` has, all or none of them."""
    _change(rows, root, partition_by)


def _change(rows: DataFrame, root: str, partition_by: str | None) -> None:
    spark = rows.sparkSession
    path = current_path(spark, root)
    # Beside the versions, not in the scratch folder: the change must outlive this process.
    staged = f"{root}/change-{uuid.uuid4().hex}"
    rows.write.mode("errorifexists").parquet(staged)
    marker = {"rows": staged, "partition_by": partition_by, "names": [f.name for f in rows.schema]}
    _put(spark, f"{path}/_pending", json.dumps(marker))
    _finish_change(spark, path)


def _finish_change(spark: SparkSession, path: str) -> None:
    """Carry out what `_pending` names, if there is one. Doing it twice changes nothing."""
    if not exists(spark, f"{path}/_pending"):
        return
    marker = json.loads(_get(spark, f"{path}/_pending"))
    if exists(spark, f"{marker['rows']}/_SUCCESS"):
        if marker["partition_by"]:
            by = marker["partition_by"]
            writer = spark.read.parquet(marker["rows"]).hint("rebalance", by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
            writer.partitionBy(by).parquet(path)
        else:
            _move_in(spark, marker["rows"], path)
    for done in (f"{path}/_pending", marker["rows"]):
        fs, where = _fs(spark, done)
        fs.delete(where, True)


def _move_in(spark: SparkSession, staged: str, path: str) -> None:
    """Move files into a version under their own names, so that a repetition finds those that are there."""
    fs, where = _fs(spark, staged)
    name_of = spark._jvm.org.apache.hadoop.fs.Path
    for status in fs.listStatus(where):
        name = status.getPath().getName()
        if not name.startswith(("_", ".")):
            _rename(fs, status.getPath(), name_of(f"{path}/{name}"))


def _rename(fs, source, target) -> None:
    """Rename a file; a refusal that leaves it unmoved is an error, for what is staged is deleted afterwards."""
    if not fs.rename(source, target) and (fs.exists(source) or not fs.exists(target)):
        raise OSError(f"cannot rename {source.toString()} to {target.toString()}")


def _put(spark: SparkSession, path: str, text: str) -> None:
    """Write a small file under a temporary name and give it its own, so that it is there whole or not at all."""
    fs, where = _fs(spark, path)
    half = spark._jvm.org.apache.hadoop.fs.Path(f"{path}.part")
    out = fs.create(half, True)
    out.write(bytearray(text.encode()))
    out.close()
    _rename(fs, half, where)


def _get(spark: SparkSession, path: str) -> str:
    fs, where = _fs(spark, path)
    source = fs.open(where)
    text = spark._jvm.org.apache.commons.io.IOUtils.toString(source, "UTF-8")
    source.close()
    return text


def read_table(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """Newest complete version in the columns of `schema`; empty when there is none.

    Columns a file lacks are NULL (A12). Nothing is inferred: no footers are merged, and partition
    values keep their type, as in '007'.
    """
    path = current_path(spark, root)
    if path is None:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def publish(df: DataFrame, root: str, partition_by: list[str] | None = None) -> str:
    """Write `df` as the next version of a table and return its folder (A10)."""
    spark = df.sparkSession
    path = f"{root}/v={max(_versions(spark, root)[0], default=0) + 1}"
    writer = df.write.mode("errorifexists")
    if partition_by:
        # Rows of one partition value share a few files instead of one per task; AQE splits the large ones.
        writer = df.hint("rebalance", *partition_by).write.mode("errorifexists").partitionBy(*partition_by)
    writer.parquet(path)
    return path


def refresh(df: DataFrame, root: str, dependants: dict[str, T.StructType] | None = None) -> str:
    """Replace a table and empty the tables that refer to it, once the new version is complete (A10)."""
    path = publish(df, root)
    for child, schema in (dependants or {}).items():
        publish(df.sparkSession.createDataFrame([], schema), child)
    return path


def append_new(df: DataFrame, root: str, schema: T.StructType, keys: list[str]) -> int:
    """Insert into a table; a key that is already there, or twice in `df`, fails the load.

    Files are added to the current version, so nothing present is rewritten; all of them are there, or none.
    """
    spark = df.sparkSession
    rows = stage(conform(df, schema), "append")
    twice = rows.groupBy(*keys).count().filter("count > 1").select(*keys)
    there = rows.select(*keys).join(read_table(spark, root, schema).select(*keys), keys, "left_semi")
    clash = twice.unionByName(there).limit(1).count()
    if clash:
        raise ValueError(f"duplicate key for {keys} in {root}")
    path = current_path(spark, root)
    if path is None:
        publish(rows, root)
    else:
        _change(rows, root, None)
    return rows.count()


def drop_old_versions(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Delete complete versions but the newest `keep`."""
    for number in sorted(_versions(spark, root)[1])[:-keep]:
        fs, where = _fs(spark, f"{root}/v={number}")
        fs.delete(where, True)
