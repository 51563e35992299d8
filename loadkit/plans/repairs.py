"""File repairs (P10): read damaged files, write clean ones, return the figures."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.text import strip_space
from loadkit.operators import damage, ragged
from loadkit.operators.jsonish import parse_jsonish
from loadkit.operators.quality import repair_metrics
from loadkit.operators.reassemble import reassemble, split_json_list
from loadkit.session import stage
from loadkit.sinks import ndjson_lines, write_csv, write_lines
from loadkit.sources import read_json_list, scan_lines
from loadkit.sources.lines import line_offsets, number_lines


def clean_csv(spark: SparkSession, path: str | list[str], out: str, sink: str = "description", strip_quotes: bool = False) -> DataFrame:
    """Ragged CSV to CSV (B1-B3, A6). Fields keep their quotes, and are quoted again, unless `strip_quotes`."""
    lines = scan_lines(spark, path, keep_cr=True)
    heads = ragged.first_lines(lines)
    header = ragged.header_names(heads, unquote=False)
    fitted = stage(ragged.fit_lines(ragged.body_lines(lines, heads), header, sink).select("fields", "repaired"), "fitted")
    rows = ragged.bind_fields(fitted, header)
    if strip_quotes:
        rows = rows.select(*[ragged.strip_outer_quotes(F.col(f"`{c}`")).alias(c) for c in header])
    write_csv(rows, out)
    return repair_metrics(fitted, repaired=F.col("repaired"))


def csv_rows(lines: DataFrame, header: list[str], sink: str | None, json_cols: list[str], keep_empty: bool) -> DataFrame:
    """CSV lines to typed rows with `repaired` and `jsonish_bad`."""
    fitted = ragged.fit_lines(lines, header, sink)
    rows = ragged.bind_fields(fitted, header, ["line", "repaired"])
    plain = {c: ragged.field_text(F.col(f"`{c}`"), not keep_empty) for c in header if c not in json_cols}
    rows = rows.withColumns(plain) if plain else rows
    rows = parse_jsonish(rows, [c for c in header if c in json_cols])
    return rows.withColumns({c: F.parse_json(F.col(f"`{c}`")) for c in header if c in json_cols}) if json_cols else rows


def csv_to_ndjson(
    spark: SparkSession, path: str | list[str], out: str, sink: str | None = None, json_cols: list[str] = (),
    keep_empty: bool = False, rejects: str | None = None,
) -> DataFrame:
    """Ragged CSV to NDJSON (B1-B6, A5). Lines with a value JSON has no form for go to `rejects`, or fail the job without one."""
    lines = scan_lines(spark, path, keep_cr=True)
    heads = ragged.first_lines(lines)
    header = ragged.header_names(heads)
    rows = stage(csv_rows(ragged.body_lines(lines, heads), header, sink, list(json_cols), keep_empty), "csv-rows")
    if rejects is None:
        bad = rows.filter("jsonish_bad").select("line").limit(5).collect()
        if bad:
            raise ValueError(f"no JSON form, for example {[r.line[:200] for r in bad]}; give `rejects` to set such lines aside")
    else:
        rows.filter("jsonish_bad").select("line", F.lit("no_json_form").alias("reason")).write.parquet(rejects)
    ndjson_lines(rows.filter("not jsonish_bad").select(*[F.col(f"`{c}`") for c in header])).write.text(out)
    return repair_metrics(rows, repaired=F.col("repaired"), bad=F.col("jsonish_bad"))


def fix_ndjson(spark: SparkSession, path: str | list[str], out: str) -> DataFrame:
    """Records broken over lines to one per line."""
    records = reassemble(scan_lines(spark, path, keep_cr=True))
    write_lines(records, out, "record")
    return repair_metrics(records, repaired_newlines=F.col("newlines"), repaired_returns=F.col("returns"))


def repair_ndjson(spark: SparkSession, path: str | list[str], out: str, rejects: str, name: str = "description") -> DataFrame:
    """Damaged NDJSON to valid records, and `{"line_no", "raw"}` for lines beyond repair."""
    lines = scan_lines(spark, path, keep_cr=True)
    whole = stage(damage.repair_records(lines, name).withColumn("given", strip_space("line") != ""), "repaired")
    write_lines(whole.filter("record is not null"), out, "record")
    bad = number_lines(whole.filter("given and record is null"), line_offsets(whole))
    ndjson_lines(bad.select("line_no", F.col("line").alias("raw"))).write.text(rejects)
    return repair_metrics(whole.filter("given"), ok=F.col("record").isNotNull(), bad=F.col("record").isNull(), repaired=F.col("repaired"))


def json_list_to_ndjson(spark: SparkSession, path: str | list[str], out: str, parallel: bool = False) -> DataFrame:
    """JSON-list files to NDJSON (A4, A5). `parallel` also splits single large files."""
    items = split_json_list(spark, path) if parallel else read_json_list(spark, path)
    items = stage(items.select("line"), "items")
    write_lines(items, out)
    return repair_metrics(items)
