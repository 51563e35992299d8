"""Whole loads over files that Spark writes from the tables."""

from pyspark.sql import functions as F

from loadkit import sinks
from loadkit.functions.json import json_text
from loadkit.plans import dimensions, facts
from loadkit.schemas import APP, APP_CSV, APP_CSV_SHORT, DAILY, GAME, MONTHLY, PC_GAME
from loadkit.sources import scan_lines
from loadkit.streaming import incremental
from loadkit.queries import query
from loadkit.session import stages
from loadkit.queries.tables import LINE_ORDER, folder


# Rows of a file that `write_sorted` makes, about: what one task sorts does not grow with the input.
FILE_ROWS = 100_000


def write_sorted(rows, order, path):
    """`line` as text files whose names sort as the rows do, as many as the cluster has cores, or more so that none has far over FILE_ROWS."""
    parts = max(rows.sparkSession.sparkContext.defaultParallelism, -(-rows.count() // FILE_ROWS))
    ranged = rows.repartitionByRange(parts, *order)
    sorted_rows = ranged.sortWithinPartitions(*order)
    sorted_rows.select(F.col("line").alias("value")).write.text(path)
    return path


def half(spark, path):
    """Files of a batch when the files of `write_sorted` make two."""
    return max(1, -(-len(spark.read.text(path).inputFiles()) // 2))


# Games from customers.

GAME_KEY = "'g' || (c_custkey - c_custkey % 3)"
GAME_LINE = (
    "CASE c_custkey % 11 WHEN 0 THEN '' WHEN 1 THEN '{bad' || c_custkey WHEN 2 THEN '{\"unified_app_id\": \" \"}' ELSE "
    "'{\"unified_app_id\": \"' || " + GAME_KEY + " || '\", \"name\": \"' || c_name || '\", \"itunes_apps\": [' || c_custkey || '], "
    "\"android_apps\": null, \"game_release_date_ww\": \"2020-01-02\", \"game_class\": ' || c_nationkey || '}' END"
)


def game_load(t, spark):
    path = folder(spark, "games")
    write_sorted(t("customer").select("c_custkey", F.expr(GAME_LINE).alias("line")), ["c_custkey"], f"{path}-in")
    return dimensions.load_games(spark, f"{path}-in", path, {f"{path}-apps": APP.schema})


@query("game_dimension_load", f"""
    SELECT {GAME_KEY} AS unified_app_id, c_name AS name, '[' || c_custkey || ']' AS itunes_apps, 'null' AS android_apps,
           CAST(NULL AS VARCHAR) AS unified_publisher_ids, CAST(c_nationkey AS VARCHAR) AS game_class, '2020-01-02' AS released
    FROM customer WHERE c_custkey % 11 > 2 QUALIFY row_number() OVER (PARTITION BY c_custkey - c_custkey % 3 ORDER BY c_custkey) = 1""")
def _(t, spark):
    table = sinks.read_table(spark, game_load(t, spark).path.rsplit("/", 1)[0], GAME.schema)
    return table.select("unified_app_id", "name", *[json_text(c).alias(c) for c in ["itunes_apps", "android_apps", "unified_publisher_ids"]],
                        "game_class", F.col("game_release_date_ww").cast("string").alias("released"))


def others(schema, shown):
    """Number of values in the columns that are not compared one by one."""
    values = [F.col(f"`{c}`").isNotNull().cast("bigint") for c in schema.names if c not in shown]
    return sum(values[1:], values[0]).alias("others")


GAMES_KEPT = "SELECT * FROM customer WHERE c_custkey % 11 > 2 QUALIFY row_number() OVER (PARTITION BY c_custkey - c_custkey % 3 ORDER BY c_custkey) = 1"


@query("game_dimension_table", f"SELECT {GAME_KEY} AS unified_app_id, c_name AS name, CAST(4 AS BIGINT) AS others FROM ({GAMES_KEPT})")
def _(t, spark):
    with stages(spark):
        path = game_load(t, spark).path.rsplit("/", 1)[0]
    # The stages of the load are gone; the table is not.
    table = sinks.read_table(spark, path, GAME.schema)
    return table.select("unified_app_id", "name", others(GAME.schema, ("unified_app_id", "name")))


@query("game_dimension_preview", f"SELECT {GAME_KEY} AS unified_app_id, c_name AS name FROM ({GAMES_KEPT}) ORDER BY 1 LIMIT 5")
def _(t, spark):
    return dimensions.preview_dimension(spark, game_load(t, spark).path.rsplit("/", 1)[0], GAME, ["unified_app_id", "name"])


@query("game_dimension_counts", f"""
    SELECT 'lines' AS name, count(*) AS cnt FROM customer UNION ALL SELECT 'rejects', count(*) FROM customer WHERE c_custkey % 11 <= 2
    UNION ALL SELECT 'orphans', 0 UNION ALL SELECT 'accepted', count(*) FROM customer WHERE c_custkey % 11 > 2
    UNION ALL SELECT 'table', count(*) FROM ({GAMES_KEPT})""")
def _(t, spark):
    load = game_load(t, spark)
    return load.counts(sinks.read_table(spark, load.path.rsplit("/", 1)[0], GAME.schema))


@query("game_dimension_rejects", """
    SELECT line_no, CASE c_custkey % 11 WHEN 0 THEN NULL WHEN 1 THEN '{bad' || c_custkey ELSE '{"unified_app_id": " "}' END AS line,
           CASE c_custkey % 11 WHEN 0 THEN 'blank_line' WHEN 1 THEN 'invalid_json' ELSE 'blank_unified_app_id' END AS reason
    FROM (SELECT c_custkey, row_number() OVER (ORDER BY c_custkey) AS line_no FROM customer) WHERE c_custkey % 11 <= 2""")
def _(t, spark):
    return game_load(t, spark).rejects


# Apps from parts; the games known are those of the smaller sizes.

APP_LINE = (
    "CASE WHEN p_partkey % 13 = 5 THEN '{\"app_id\": \"-x\"}' ELSE '{\"app_id\": \"app' || (p_partkey - p_partkey % 2) || '\", \"name\": \"' || p_name || '\", "
    "\"unified_app_id\": \"' || CASE WHEN p_partkey % 7 = 0 THEN '' ELSE 'g' || p_size END || '\", \"active\": \"yes\", \"rating\": ' || p_size || '.5, "
    "\"price\": \"free\", \"rating_count\": ' || p_size || ', \"categories\": [' || p_size || ', null], \"release_date\": \"2010-06-28T01:02:03Z\", "
    "\"permissions\": null}' END"
)


def app_load(t, spark):
    path = folder(spark, "apps")
    write_sorted(t("part").select("p_partkey", F.expr(APP_LINE).alias("line")), ["p_partkey"], f"{path}-in")
    games = t("part").filter("p_size <= 25").select(F.expr("'g' || p_size").alias("unified_app_id")).distinct()
    return dimensions.load_apps(spark, f"{path}-in", path, games)


@query("app_dimension_load", """
    SELECT 'app' || (p_partkey - p_partkey % 2) AS app_id, p_name AS name, CASE WHEN p_partkey % 7 <> 0 THEN 'g' || p_size END AS unified_app_id,
           true AS active, CAST(p_size + 0.5 AS DOUBLE) AS rating, CAST(NULL AS DOUBLE) AS price, p_size AS rating_count,
           '[' || p_size || ',null]' AS categories, 'null' AS permissions, '2010-06-28 01:02:03' AS released
    FROM part WHERE p_partkey % 13 <> 5 AND (p_partkey % 7 = 0 OR p_size <= 25)
    QUALIFY row_number() OVER (PARTITION BY p_partkey - p_partkey % 2 ORDER BY p_partkey) = 1""")
def _(t, spark):
    table = sinks.read_table(spark, app_load(t, spark).path.rsplit("/", 1)[0], APP.schema)
    return table.select("app_id", "name", "unified_app_id", "active", "rating", "price", "rating_count", json_text("categories").alias("categories"),
                        json_text("permissions").alias("permissions"), F.date_format("release_date", "yyyy-MM-dd HH:mm:ss").alias("released"))


@query("app_dimension_orphans", """
    SELECT line_no, 'app' || (p_partkey - p_partkey % 2) AS app_id, 'g' || p_size AS unified_app_id, 'unified_app_id_not_in_dim_game_info' AS reason
    FROM (SELECT *, row_number() OVER (ORDER BY p_partkey) AS line_no FROM part) WHERE p_partkey % 13 <> 5 AND p_partkey % 7 <> 0 AND p_size > 25""")
def _(t, spark):
    return app_load(t, spark).orphans.drop("line")


@query("app_dimension_counts", """
    SELECT 'lines' AS name, count(*) AS cnt FROM part UNION ALL SELECT 'rejects', count(*) FROM part WHERE p_partkey % 13 = 5
    UNION ALL SELECT 'orphans', count(*) FROM part WHERE p_partkey % 13 <> 5 AND p_partkey % 7 <> 0 AND p_size > 25
    UNION ALL SELECT 'accepted', count(*) FROM part WHERE p_partkey % 13 <> 5 AND (p_partkey % 7 = 0 OR p_size <= 25)""")
def _(t, spark):
    return app_load(t, spark).counts()


# Apps from CSV.

def app_csv(rows, columns, path, **values):
    known = {k: F.expr(v) for k, v in values.items()}
    sinks.write_csv(rows.select(*[known.get(c, F.lit(None).cast("string")).cast("string").alias(c) for c in columns]), path)
    return path


CSV_ID = "CASE WHEN p_partkey % 5 = 4 THEN 'x' || p_partkey ELSE CAST(p_partkey - p_partkey % 2 AS STRING) END"


@query("app_csv_load", """
    SELECT CAST(p_partkey - p_partkey % 2 AS VARCHAR) AS app_id, '"' || p_name || '", ' || p_brand AS name, '["' || p_brand || '",null]' AS categories,
           CASE WHEN p_size > 25 THEN p_retailprice END AS price, p_size AS rating_count, p_size > 10 AS active
    FROM part WHERE p_partkey % 5 <> 4 QUALIFY row_number() OVER (PARTITION BY p_partkey - p_partkey % 2 ORDER BY p_partkey) = 1""")
def _(t, spark):
    path = folder(spark, "csv-apps")
    source = app_csv(
        t("part"), APP_CSV, f"{path}-in", app_id=CSV_ID, name="'\"' || p_name || '\", ' || p_brand", categories="'[' || chr(39) || p_brand || chr(39) || ', None]'",
        price="CASE WHEN p_size > 25 THEN CAST(p_retailprice AS STRING) ELSE 'free' END", rating_count="p_size",
        active="CASE WHEN p_size > 10 THEN 'Yes' ELSE 'f' END", description="lpad(CAST(p_partkey AS STRING), 15, '0')")
    dimensions.load_apps_csv(spark, source, path)
    return sinks.read_table(spark, path, APP.schema).select("app_id", "name", json_text("categories").alias("categories"), "price", "rating_count", "active")


@query("app_csv_quality", """
    SELECT count(*) AS total, CAST(0 AS BIGINT) AS blank_key, count(*) FILTER (WHERE p_partkey % 5 = 4) AS bad_key FROM part""")
def _(t, spark):
    path = folder(spark, "csv-quality")
    return dimensions.load_apps_csv(spark, app_csv(t("part"), APP_CSV, f"{path}-in", app_id=CSV_ID), path)[1]


@query("app_csv_append", """
    SELECT CAST(p_partkey AS VARCHAR) AS app_id, p_name AS name, CASE WHEN p_size > 10 THEN p_retailprice END AS price,
           CASE WHEN p_size <= 25 THEN p_size END AS rating_count FROM part""")
def _(t, spark):
    path = folder(spark, "csv-append")
    text = {"app_id": "p_partkey", "name": "p_name", "price": "CASE WHEN p_size > 10 THEN CAST(p_retailprice AS STRING) ELSE '' END"}
    first = app_csv(t("part").filter("p_size <= 25"), APP_CSV, f"{path}-1", rating_count="p_size", **text)
    dimensions.load_apps_csv(spark, first, path, multi_line=False)
    more = app_csv(t("part").filter("p_size > 25"), APP_CSV_SHORT, f"{path}-2", **text)
    dimensions.load_apps_csv(spark, more, path, cast="strict", mode="append", multi_line=False)
    return sinks.read_table(spark, path, APP.schema).select("app_id", "name", "price", "rating_count")


# P5: PC games from parts.

@query("pc_game_load", """
    SELECT CAST(p_partkey - p_partkey % 2 AS INTEGER) AS app_id, p_name AS name, CASE WHEN p_size > 10 THEN p_retailprice END AS initial_price,
           '2004-01-' || lpad(CAST(1 + p_size % 28 AS VARCHAR), 2, '0') AS released, p_brand AS steam_tags
    FROM part WHERE p_partkey % 6 <> 5 QUALIFY row_number() OVER (PARTITION BY p_partkey - p_partkey % 2 ORDER BY p_partkey) = 1""")
def _(t, spark):
    path = folder(spark, "pc-games")
    line = (
        "CASE WHEN p_partkey % 6 = 5 THEN '{\"app_id\": \"ab-' || p_partkey || '\"}' ELSE '{\"app_id\": \" ' || (p_partkey - p_partkey % 2) || ' \", "
        "\"name\": \"' || p_name || '\", \"initial_price\": \"' || CASE WHEN p_size > 10 THEN CAST(p_retailprice AS STRING) ELSE '' END || '\", "
        "\"release_date\": \"1/' || (1 + p_size % 28) || '/2004\", \"steam_tags\": \"' || p_brand || '\"}' END"
    )
    write_sorted(t("part").select("p_partkey", F.expr(line).alias("line")), ["p_partkey"], f"{path}-in")
    dimensions.load_pc_games(spark, f"{path}-in", path)
    return sinks.read_table(spark, path, PC_GAME.schema).select("app_id", "name", "initial_price", F.col("release_date").cast("string").alias("released"), "steam_tags")


# Daily facts from line items. Line 7 has no date, line 6 a bad metric.

ORDER = ["l_orderkey", "l_linenumber", *LINE_ORDER]
DAILY_LINE = (
    "'{\"aid\": ' || l_partkey || ', \"c\": \"S' || l_suppkey || '\", \"u\": ' || CASE WHEN l_linenumber = 6 THEN '\"x\"' ELSE CAST(CAST(l_quantity AS INT) AS STRING) END "
    "|| ', \"ir\": ' || l_linenumber || CASE WHEN l_linenumber = 7 THEN '' ELSE ', \"d\": \"' || {day} || '\"' END || '}'"
)
DAY = {"spark": "date_format(l_shipdate, 'yyyy-MM-dd')", "sql": "strftime(l_shipdate, '%Y-%m-%d')"}


def daily_lines(t, path):
    rows = t("lineitem").select(*ORDER, F.expr(DAILY_LINE.replace("{day}", DAY["spark"])).alias("line"))
    return write_sorted(rows, ORDER, path)


def last_line(where, direction="DESC"):
    return (f"WHERE {where} QUALIFY row_number() OVER (PARTITION BY l_partkey, l_suppkey, l_shipdate ORDER BY "
            + ", ".join(f"{c} {direction}" for c in ORDER) + ") = 1")


DAILY_SELECT = f"""
    SELECT CAST(l_partkey AS VARCHAR) AS app_id, 'S' || l_suppkey AS country_android, 'S' || l_suppkey AS country_ios, {DAY['sql']} AS day,
           CASE WHEN l_linenumber = 6 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS downloads_android, CAST(0 AS BIGINT) AS downloads_ipad,
           CAST(l_linenumber AS BIGINT) AS revenue_iphone FROM lineitem """
SMALL = "l_partkey IN (SELECT p_partkey FROM part WHERE p_size <= 25)"


def daily_table(spark, root):
    return sinks.read_table(spark, root, DAILY.schema).select(
        "app_id", "country_android", "country_ios", F.date_format("date", "yyyy-MM-dd").alias("day"), "downloads_android", "downloads_ipad", "revenue_iphone")


@query("daily_fact_load", DAILY_SELECT + last_line("l_linenumber <> 7"))
def _(t, spark):
    root = folder(spark, "daily")
    apps = t("part").select(F.col("p_partkey").cast("string").alias("app_id"))
    facts.load_fact(spark, daily_lines(t, f"{root}-in"), facts.DAILY_FACT, root, apps)
    return daily_table(spark, root)


def daily_batches(t, spark):
    root = folder(spark, "batches")
    apps = t("part").filter("p_size <= 25").select(F.col("p_partkey").cast("string").alias("app_id"))
    lines = scan_lines(spark, daily_lines(t, f"{root}-in"))
    incremental.load_in_batches(spark, lines, facts.DAILY_FACT, root, apps, f"{root}-work", t("lineitem").count() // 3 + 1)
    return root


@query("daily_fact_batches", DAILY_SELECT + last_line(f"l_linenumber <> 7 AND {SMALL}"))
def _(t, spark):
    return daily_table(spark, daily_batches(t, spark))


@query("daily_fact_progress", f"""
    WITH numbered AS (SELECT *, row_number() OVER (ORDER BY {", ".join(ORDER)}) AS line_no FROM lineitem),
         sized AS (SELECT *, (line_no - 1) // ((SELECT count(*) FROM lineitem) // 3 + 1) AS batch FROM numbered)
    SELECT batch, max(line_no) AS processed_lines, (SELECT count(*) FROM lineitem) AS total_lines,
           count(DISTINCT (l_partkey, l_suppkey, l_shipdate)) FILTER (WHERE l_linenumber <> 7 AND {SMALL}) AS inserted_rows,
           count(*) FILTER (WHERE l_linenumber <> 7 AND NOT {SMALL}) AS orphans, count(*) FILTER (WHERE l_linenumber = 7) AS rejects
    FROM sized GROUP BY batch""")
def _(t, spark):
    work = daily_batches(t, spark) + "-work"
    fact = facts.DAILY_FACT
    lost = incremental.batch_orphans(spark, fact, work).groupBy("batch").agg(F.count(F.lit(1)).alias("orphans"))
    bad = incremental.batch_rejects(spark, fact, work).groupBy("batch").agg(F.count(F.lit(1)).alias("rejects"))
    done = incremental.progress(spark, work).join(lost, "batch", "left").join(bad, "batch", "left").fillna(0, ["orphans", "rejects"])
    return done.select("batch", "processed_lines", "total_lines", "inserted_rows", "orphans", "rejects")


@query("daily_fact_orphans", f"""
    WITH numbered AS (SELECT *, row_number() OVER (ORDER BY {", ".join(ORDER)}) AS line_no FROM lineitem)
    SELECT line_no, CAST(l_partkey AS VARCHAR) AS app_id, 'S' || l_suppkey AS country_android, {DAY['sql']} AS day, CAST(l_linenumber AS BIGINT) AS revenue_iphone
    FROM numbered WHERE l_linenumber <> 7 AND NOT {SMALL}""")
def _(t, spark):
    lost = incremental.batch_orphans(spark, facts.DAILY_FACT, daily_batches(t, spark) + "-work")
    return lost.select("line_no", "app_id", "country_android", F.date_format("date", "yyyy-MM-dd").alias("day"), "revenue_iphone")


@query("daily_fact_stream", """
    SELECT CAST(user_id AS VARCHAR) AS app_id, 'E' || event_id AS country_android, strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS ts,
           event_id AS downloads_iphone FROM events""")
def _(t, spark):
    root = folder(spark, "stream")
    line = ("'{\"aid\": ' || user_id || ', \"cc\": \"E' || event_id || '\", \"iu\": ' || event_id || ', \"d\": \"' || "
            "date_format(ts, 'yyyy-MM-dd') || 'T' || date_format(ts, 'HH:mm:ss') || 'Z\"}'")
    write_sorted(t("events").select("event_id", F.expr(line).alias("line")), ["event_id"], f"{root}-in")
    apps = t("events").select(F.col("user_id").cast("string").alias("app_id")).distinct()
    incremental.stream_fact(spark, f"{root}-in", facts.DAILY_FACT, root, apps, f"{root}-work", files_per_batch=half(spark, f"{root}-in"))
    return sinks.read_table(spark, root, DAILY.schema).select(
        "app_id", "country_android", F.date_format("date", "yyyy-MM-dd HH:mm:ss").alias("ts"), "downloads_iphone")


@query("stream_progress", """
    SELECT count(*) AS processed_lines, count(DISTINCT (user_id, date_trunc('month', ts))) AS inserted_rows FROM events""")
def _(t, spark):
    root = folder(spark, "progress")
    line = "'{\"app_id\": ' || user_id || ', \"month\": \"' || date_format(ts, 'yyyy-MM') || '\", \"peak_ccu\": ' || event_id || '}'"
    write_sorted(t("events").select("event_id", F.expr(line).alias("line")), ["event_id"], f"{root}-in")
    games = t("events").select(F.col("user_id").cast("int").alias("app_id")).distinct()
    return incremental.stream_fact(spark, f"{root}-in", facts.MONTHLY_FACT, root, games, f"{root}-work", mode="upsert",
                                   partition_by="month").select("processed_lines", "inserted_rows")


# Monthly facts; P8 keeps the first line of a key, P9 the last.

MONTHLY_LINE = ("'{\"app_id\": ' || l_partkey || ', \"month\": \"' || date_format(l_shipdate, 'yyyy-MM') || '\", \"peak_ccu\": ' || "
                "CASE WHEN l_linenumber = 5 THEN '\"n/a\"' ELSE CAST(CAST(l_extendedprice AS INT) AS STRING) END || '}'")


def monthly_lines(t, path):
    return write_sorted(t("lineitem").select(*ORDER, F.expr(MONTHLY_LINE).alias("line")), ORDER, path)


def monthly_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in ORDER)
    return f"""
    SELECT CAST(l_partkey AS INTEGER) AS app_id, strftime(date_trunc('month', l_shipdate), '%Y-%m-%d') AS month,
           CASE WHEN l_linenumber <> 5 THEN CAST(trunc(l_extendedprice) AS BIGINT) END AS peak_ccu FROM lineitem WHERE {SMALL}
    QUALIFY row_number() OVER (PARTITION BY l_partkey, date_trunc('month', l_shipdate) ORDER BY {order}) = 1"""


def monthly_table(spark, root):
    return sinks.read_table(spark, root, MONTHLY.schema).select("app_id", F.col("month").cast("string").alias("month"), "peak_ccu")


def pc_games(t):
    return t("part").filter("p_size <= 25").select(F.col("p_partkey").cast("int").alias("app_id"))


@query("monthly_fact_keep", monthly_sql("ASC"))
def _(t, spark):
    root = folder(spark, "monthly-keep")
    lines = scan_lines(spark, monthly_lines(t, f"{root}-in"))
    incremental.load_in_batches(spark, lines, facts.MONTHLY_FACT, root, pc_games(t), f"{root}-work", t("lineitem").count() // 2 + 1, partition_by="month")
    return monthly_table(spark, root)


@query("monthly_fact_replace", monthly_sql("DESC"))
def _(t, spark):
    root = folder(spark, "monthly-replace")
    facts.load_fact(spark, monthly_lines(t, f"{root}-in"), facts.MONTHLY_FACT, root, pc_games(t), orphans="drop", policy="replace", partition_by="month")
    return monthly_table(spark, root)
