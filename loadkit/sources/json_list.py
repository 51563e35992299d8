"""Files holding one JSON list (A4)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.json import STRICT, json_text, one_line, parse_strict


def explode_json_list(df: DataFrame, text: str, keep: list[str]) -> DataFrame:
    """Elements of one list per row: `keep`, `pos` in the list, `line` as compact JSON text with its numbers and key order.

    Anything but a list fails the job.
    """
    value = parse_strict(text)
    is_list = F.startswith(F.schema_of_variant(value), F.lit("ARRAY"))
    checked = F.when(F.coalesce(is_list, F.lit(False)), value).otherwise(F.raise_error(F.lit("expected a JSON list")))
    given = F.from_json(F.col(text), "ARRAY<STRING>", STRICT)
    listed = df.select(*keep, checked.alias("__list"), given.alias("__given"))
    exploded = listed.lateralJoin(spark_explode(df.sparkSession))
    # Strings come without their quotes and null as no text, so those are written anew.
    plain = F.schema_of_variant("value").isin("STRING", "VOID")
    line = F.when(plain, json_text("value")).otherwise(one_line(F.get("__given", F.col("pos"))))
    return exploded.select(*keep, F.col("pos").cast("long").alias("pos"), line.alias("line"))


def spark_explode(spark: SparkSession) -> DataFrame:
    return spark.tvf.variant_explode(F.col("__list").outer())


def read_json_list(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """One row per list element: `file`, `pos`, `line` (A4).

    A file is parsed whole by one task, so this is for many files of moderate size; a large one is
    for `loadkit.operators.reassemble.split_json_list`, which reads it in parallel.
    """
    whole = spark.read.text(path, wholetext=True)
    whole = whole.select(F.col("_metadata.file_path").alias("file"), F.make_valid_utf8("value").alias("value"))
    return explode_json_list(whole, "value", ["file"])
