"""Dimension loads from NDJSON and CSV."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loadkit.functions.casts import LOOSE, pattern_date, strict_cast, strict_key
from loadkit.functions.json import decode_json_text, parse_records, to_jsonb_loose
from loadkit.operators import classify
from loadkit.operators.keys import keep_one
from loadkit.operators.quality import key_quality
from loadkit.operators.refcheck import require_reference
from loadkit.operators.upsert import split_outcomes, upsert_table
from loadkit.plans.common import ACCEPTED, ORPHAN, REJECTED, Load, blank_as_null, judge
from loadkit.schemas import APP, APP_CSV, APP_CSV_SHORT, GAME, PC_GAME, Table
from loadkit.session import stage
from loadkit.sinks import append_new, conform, read_table, refresh
from loadkit.sources.csv import scan_csv
from loadkit.sources.lines import POSITION, scan_lines

MISSING_GAME = "unified_app_id_not_in_dim_game_info"


def extract(parsed: DataFrame, table: Table, decode_text: bool = False) -> DataFrame:
    """Record struct to typed columns (T1, T2, T5-T12). The struct is parsed once, whatever the width."""
    picked = []
    for name, kind in table.columns.items():
        value = F.col(f"rec.{name}")
        if kind == "json" and decode_text:
            value = decode_json_text(value)
        elif kind in LOOSE:
            value = LOOSE[kind](value)
        picked.append(value.alias(name))
    return parsed.select(*POSITION, "line", "rec_ok", *picked)


def records(lines: DataFrame, table: Table) -> DataFrame:
    """Lines with `rec`, a struct of text and JSON fields as the table names them."""
    json = table.of_kind("json")
    return parse_records(lines, [c for c in table.columns if c not in json], json)


def classify_games(lines: DataFrame, decode_text: bool = False) -> DataFrame:
    """P1 up to the outcome."""
    rows = extract(records(lines, GAME), GAME, decode_text)
    return judge(rows, classify.line_rules("line", F.col("rec_ok")) + classify.key_rules("unified_app_id", "unified_app_id"))


def classify_apps(lines: DataFrame, games: DataFrame, decode_text: bool = False) -> DataFrame:
    """P2 up to the outcome: a blank parent loads as NULL, an unknown one makes an orphan."""
    rows = extract(records(lines, APP), APP, decode_text)
    rules = classify.line_rules("line", F.col("rec_ok")) + classify.id_rules("app_id")
    judged = judge(rows, rules, games, "unified_app_id", blank_ok=True)
    return judged.withColumn("unified_app_id", blank_as_null("unified_app_id"))


def classify_pc_games(lines: DataFrame, on_error: str = "null") -> DataFrame:
    """P5 up to the outcome. `on_error="fail"` stops on a bad price or date, `null` leaves it empty."""
    parsed = records(lines, PC_GAME)
    special = {
        "app_id": strict_key(F.trim("rec.app_id")),
        "initial_price": strict_cast("rec.initial_price", "double", on_error),
        "release_date": pattern_date("rec.release_date", on_error),
    }
    rows = parsed.select(
        *POSITION, "line", "rec_ok", F.col("rec.app_id").alias("id_text"),
        *[special.get(c, F.col(f"rec.{c}")).alias(c) for c in PC_GAME.columns],
    )
    rules = classify.line_rules("line", F.col("rec_ok")) + classify.integer_id_rules("id_text", "app_id")
    return judge(rows, rules).drop("id_text")


def _finish(judged: DataFrame, table: Table, root: str, dependants: dict, mode: str, order_by: list[str | Column]) -> Load:
    parts = split_outcomes(judged.drop("rec_ok"))
    order = list(order_by) or POSITION
    if mode == "refresh":
        kept = conform(keep_one(parts[ACCEPTED], list(table.key), order), table.schema)
        path = refresh(kept, root, dependants)
    elif mode == "upsert":
        upsert_table(root, parts[ACCEPTED].drop("line", "reason"), table.schema, list(table.key), on_dup="first", order_by=order)
        path = root
    else:
        raise ValueError(f"unknown mode {mode!r}")
    shown = ["line", *table.key, table.parent_key, F.lit(MISSING_GAME).alias("reason")] if table.parent_key else None
    return Load(parts["all"], parts[ACCEPTED], parts[REJECTED], parts[ORPHAN], path, ["line", "reason"], shown)


def load_games(
    spark: SparkSession, source: str | DataFrame, root: str, dependants: dict | None = None, mode: str = "refresh",
    order_by: list[str | Column] = (), decode_text: bool = False,
) -> Load:
    """Game dimension from NDJSON; `refresh` replaces it and empties its dependants, `upsert` merges."""
    return _finish(classify_games(_lines(spark, source), decode_text), GAME, root, dependants or {}, mode, order_by)


def load_apps(
    spark: SparkSession, source: str | DataFrame, root: str, games: DataFrame, dependants: dict | None = None,
    mode: str = "refresh", order_by: list[str | Column] = (), decode_text: bool = False,
) -> Load:
    """App dimension from NDJSON; apps of unknown games go to `orphans`."""
    return _finish(classify_apps(_lines(spark, source), games, decode_text), APP, root, dependants or {}, mode, order_by)


def load_pc_games(
    spark: SparkSession, source: str | DataFrame, root: str, dependants: dict | None = None, mode: str = "refresh",
    order_by: list[str | Column] = (), on_error: str = "null",
) -> Load:
    """P5: PC-game dimension from NDJSON."""
    return _finish(classify_pc_games(_lines(spark, source), on_error), PC_GAME, root, dependants or {}, mode, order_by)


def _lines(spark: SparkSession, source: str | DataFrame) -> DataFrame:
    return source if isinstance(source, DataFrame) else scan_lines(spark, source)


def cast_app_columns(raw: DataFrame, cast: str = "loose") -> DataFrame:
    """All-text app columns to their types; keeps other columns. `strict` fails on bad text."""
    done = []
    for name, kind in APP.columns.items():
        if name not in raw.columns:
            continue
        value = F.col(name)
        if kind == "json":
            value = to_jsonb_loose(value)
        elif kind == "boolean" or (kind in LOOSE and cast == "loose"):
            value = LOOSE[kind](value)
        elif kind in LOOSE:
            value = strict_cast(value, kind)
        done.append(value.alias(name))
    return raw.select(*[c for c in raw.columns if c not in APP.columns], *done)


def csv_id_ok() -> Column:
    return classify.id_ok("app_id", classify.NUMERIC_PATTERN, classify.CSV_ID_LENGTH)


def load_apps_csv(
    spark: SparkSession, source: str | DataFrame, root: str, dependants: dict | None = None, cast: str = "loose",
    mode: str = "refresh", multi_line: bool = True, order_by: list[str | Column] = (), games: DataFrame | None = None,
) -> tuple[Load, DataFrame]:
    """P3 (`loose`, `refresh`, 53 columns) and P4 (`strict`, `append`, 52 columns): app dimension from CSV.

    Returns the load and the key figures of the staged rows (G2). P3 sets whole rows with a bad id
    aside; P4 only skips blank ids, and fails when a key exists already. `games` checks the parent,
    which stops the load when missing.
    """
    columns = APP_CSV if cast == "loose" else APP_CSV_SHORT
    # Rows of a frame have no place in a file; those of files keep theirs, so that the first one stays.
    given = isinstance(source, DataFrame)
    raw = source if given else scan_csv(spark, source, columns, multi_line, position=True)
    place = ["row"] if given else POSITION
    raw = raw.withColumn("row", F.monotonically_increasing_id()) if given else raw
    good = csv_id_ok() if cast == "loose" else ~classify.blank("app_id")
    outcome = F.when(good, F.lit(ACCEPTED)).otherwise(F.lit(REJECTED))
    parts = split_outcomes(raw.withColumn("outcome", outcome))
    # One row per id while all columns are still text, so only survivors are cast.
    kept = keep_one(parts[ACCEPTED], ["app_id"], list(order_by) or place).drop(*place)
    typed = cast_app_columns(kept, cast).withColumn("unified_app_id", blank_as_null("unified_app_id"))
    if games is not None:
        typed = stage(typed, "typed")
        require_reference(typed, games, "unified_app_id")
    if mode == "append":
        append_new(typed, root, APP.schema, ["app_id"])
        path = root
    else:
        path = refresh(conform(typed, APP.schema), root, dependants)
    rejects = parts[REJECTED].drop(*place)
    return (
        Load(parts["all"], parts[ACCEPTED], rejects, rejects.limit(0), path),
        key_quality(parts["all"], "app_id", csv_id_ok()),
    )


def preview_dimension(spark: SparkSession, root: str, table: Table, columns: list[str], n: int = 5) -> DataFrame:
    """First rows by key."""
    return read_table(spark, root, table.schema).orderBy(*[F.asc_nulls_last(k) for k in table.key]).limit(n).select(*columns)
