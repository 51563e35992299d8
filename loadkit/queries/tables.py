"""Reference checks, keys, counts and upserts (J*, G*, U*, A10-A13)."""

import uuid

from pyspark.sql import functions as F

from loadkit import sinks
from loadkit.functions.text import blank
from loadkit.operators import keys, quality, refcheck, upsert
from loadkit.schemas import Table, _columns
from loadkit.session import scratch_dir
from loadkit.queries import query

LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def folder(spark, name):
    return f"{scratch_dir(spark)}/query-{name}-{uuid.uuid4().hex}"


def small_parts(t):
    return t("part").filter("p_size <= 25").select("p_partkey")


@query("orphans", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25)""")
def _(t, spark):
    child = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return refcheck.orphans(child, small_parts(t), "l_partkey", "p_partkey")


@query("with_parent", """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem l JOIN part p ON p.p_partkey = l.l_partkey WHERE p.p_size <= 25""")
def _(t, spark):
    child = t("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    return refcheck.with_parent(child, small_parts(t), "l_partkey", "p_partkey")


_REF = "CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN '  ' ELSE CAST(l_partkey AS STRING) END"


@query("present_or_blank", f"""
    WITH c AS (SELECT l_orderkey, l_linenumber, l_suppkey, {_REF} AS ref FROM lineitem)
    SELECT * FROM c WHERE trim(ref) = '' OR EXISTS (SELECT 1 FROM part p WHERE CAST(p.p_partkey AS VARCHAR) = c.ref AND p.p_size <= 25)""")
def _(t, spark):
    child = t("lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", F.expr(_REF).alias("ref"))
    return refcheck.present_or_blank(child, small_parts(t).selectExpr("string(p_partkey) ref"), "ref")


@query("parent_split", f"""
    WITH c AS (SELECT {_REF} AS ref FROM lineitem), m AS (
      SELECT CASE WHEN trim(ref) = '' THEN 'blank' WHEN EXISTS (SELECT 1 FROM part p WHERE CAST(p.p_partkey AS VARCHAR) = c.ref AND p.p_size <= 25)
             THEN 'present' ELSE 'missing' END AS state FROM c)
    SELECT state, count(*) AS cnt FROM m GROUP BY state""")
def _(t, spark):
    child = t("lineitem").select(F.expr(_REF).alias("ref"))
    marked = refcheck.mark_parent(child, small_parts(t).selectExpr("string(p_partkey) ref"), "ref")
    state = F.when(blank("ref"), "blank").when(F.col("has_parent"), "present").otherwise("missing")
    return marked.groupBy(state.alias("state")).agg(F.count(F.lit(1)).alias("cnt"))


@query("reference_check", """
    SELECT l_partkey, count(*) AS rows FROM lineitem l
    WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey AND p.p_size <= 25) GROUP BY l_partkey""")
def _(t, spark):
    return refcheck.check_reference(t("lineitem"), small_parts(t), "l_partkey", "p_partkey")


@query("key_check", """
    SELECT CAST(count(*) AS BIGINT) AS total_rows, count(DISTINCT (l_orderkey, l_linenumber)) AS distinct_keys,
           count(*) - count(DISTINCT (l_orderkey, l_linenumber)) AS surplus_rows, CAST(0 AS BIGINT) AS null_rows FROM lineitem""")
def _(t, spark):
    return keys.key_check(t("lineitem"), LINE_KEY, ["l_partkey"])


@query("duplicate_keys", """
    SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem GROUP BY ALL HAVING count(*) > 1""")
def _(t, spark):
    return keys.duplicate_keys(t("lineitem"), LINE_KEY)


def _keep_sql(direction):
    order = ", ".join(f"{c} {direction}" for c in LINE_ORDER)
    return f"""
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, strftime(l_shipdate, '%Y-%m-%d') AS shipdate
    FROM lineitem QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) = 1"""


def _shown(df):
    return df.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
                     F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipdate"))


@query("keep_one", _keep_sql("ASC"))
def _(t, spark):
    return _shown(keys.keep_one(t("lineitem"), LINE_KEY, LINE_ORDER))


@query("batch_duplicates", _keep_sql("DESC"))
def _(t, spark):
    return _shown(upsert.one_per_key(t("lineitem"), LINE_KEY, "last", LINE_ORDER))


@query("load_counts", """
    SELECT 'orders' AS name, count(*) AS cnt FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
    UNION ALL SELECT 'rejects', count(*) FROM orders WHERE o_totalprice < 0""")
def _(t, spark):
    return quality.row_counts(orders=t("orders"), lineitem=t("lineitem"), rejects=t("orders").filter("o_totalprice < 0"))


@query("filtered_counts", """
    SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'error') AS errors, count(*) FILTER (WHERE value > 50) AS large,
           count(*) FILTER (WHERE event_type = 'error' AND value > 50) AS both FROM events""")
def _(t, spark):
    error, large = F.col("event_type") == "error", F.col("value") > 50
    return quality.filtered_counts(t("events"), errors=error, large=large, both=error & large)


@query("key_quality", """
    SELECT count(*) AS total, count(*) FILTER (WHERE l_linenumber IN (1, 2)) AS blank_key,
           count(*) FILTER (WHERE l_linenumber IN (1, 2)) AS bad_key FROM lineitem""")
def _(t, spark):
    from loadkit.operators.classify import CSV_ID_LENGTH, NUMERIC_PATTERN, id_ok

    child = t("lineitem").select(F.expr(_REF).alias("ref"))
    return quality.key_quality(child, "ref", id_ok("ref", NUMERIC_PATTERN, CSV_ID_LENGTH))


@query("date_range", """
    SELECT strftime(min(o_orderdate), '%Y-%m-%d') AS min_date, strftime(max(o_orderdate), '%Y-%m-%d') AS max_date FROM orders""")
def _(t, spark):
    days = t("orders").select(F.date_format("o_orderdate", "yyyy-MM-dd").alias("d"))
    return quality.value_range(days, "d")


@query("max_line", "SELECT max(event_id) AS event_id FROM events")
def _(t, spark):
    return quality.highest(t("events"), "event_id")


@query("topk_preview", """
    SELECT o_orderkey, o_custkey, o_totalprice, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders
    ORDER BY o_orderdate DESC NULLS FIRST, o_orderkey LIMIT 5""")
def _(t, spark):
    top = quality.preview(t("orders"), [F.desc_nulls_first("o_orderdate"), F.asc_nulls_last("o_orderkey")])
    return top.select("o_orderkey", "o_custkey", "o_totalprice", F.date_format("o_orderdate", "yyyy-MM-dd").alias("day"))


TARGET = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'"
SOURCE = ("SELECT o_orderkey, 'X' AS o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice + 1 END AS o_totalprice, "
          "o_orderpriority || '!' AS o_orderpriority FROM orders WHERE o_orderdate >= TIMESTAMP '1997-01-01'")


def both_sides(t):
    old = t("orders").filter("o_orderdate < '1999-01-01'").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    new = t("orders").filter("o_orderdate >= '1997-01-01'").select(
        "o_orderkey", F.lit("X").alias("o_orderstatus"), F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.concat("o_orderpriority", F.lit("!")).alias("o_orderpriority"))
    return old, new


@query("upsert_replace", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""")
def _(t, spark):
    return upsert.upsert(*both_sides(t), ["o_orderkey"])


@query("upsert_keep", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT * FROM t UNION ALL SELECT * FROM s WHERE o_orderkey NOT IN (SELECT o_orderkey FROM t)""")
def _(t, spark):
    return upsert.upsert(*both_sides(t), ["o_orderkey"], policy="keep")


@query("upsert_columns", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey, coalesce(t.o_orderstatus, s.o_orderstatus) AS o_orderstatus,
           CASE WHEN s.o_orderkey IS NULL THEN t.o_totalprice ELSE s.o_totalprice END AS o_totalprice,
           coalesce(t.o_orderpriority, s.o_orderpriority) AS o_orderpriority
    FROM t FULL JOIN s ON t.o_orderkey = s.o_orderkey""")
def _(t, spark):
    return upsert.upsert(*both_sides(t), ["o_orderkey"], update_cols=["o_totalprice"])


@query("upsert_counts", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT count(*) AS affected, count(*) FILTER (WHERE t.o_orderkey IS NULL) AS inserted, count(*) FILTER (WHERE t.o_orderkey IS NOT NULL) AS updated
    FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey""")
def _(t, spark):
    return upsert.upsert_counts(*both_sides(t), ["o_orderkey"])


ORDERS = Table("orders", _columns("o_orderkey:bigint o_orderstatus o_totalprice:double o_orderpriority"), ("o_orderkey",))


@query("upsert_stored_table", f"""
    WITH t AS ({TARGET}), s AS ({SOURCE})
    SELECT * FROM s UNION ALL SELECT * FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)""")
def _(t, spark):
    root = folder(spark, "upsert")
    old, new = both_sides(t)
    for rows in (old, new, new):  # the repeat changes nothing
        upsert.upsert_table(root, rows, ORDERS.schema, ["o_orderkey"], order_by=["o_orderkey"])
    return sinks.read_table(spark, root, ORDERS.schema)


MONTHS = Table("m", _columns("k:bigint month v"), ("k", "month"))


@query("upsert_touched_partitions", """
    SELECT o_orderkey AS k, strftime(o_orderdate, '%Y-%m') AS month,
           CASE WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'new' ELSE o_orderstatus END AS v FROM orders""")
def _(t, spark):
    root = folder(spark, "partitions")
    rows = t("orders").select(F.col("o_orderkey").alias("k"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.col("o_orderstatus").alias("v"))
    new = rows.filter("month >= '2000-01'").withColumn("v", F.lit("new"))
    for batch in (rows, new):
        upsert.upsert_table(root, batch, MONTHS.schema, ["k", "month"], order_by=["v"], partition_by="month")
    return sinks.read_table(spark, root, MONTHS.schema)


@query("split_outcomes", """
    SELECT CASE WHEN event_type = 'error' THEN 'rejected' WHEN event_type = 'signup' THEN 'orphan' ELSE 'accepted' END AS outcome,
           count(*) AS cnt, CAST(sum(user_id) AS BIGINT) AS users FROM events GROUP BY 1""")
def _(t, spark):
    kind = F.when(F.col("event_type") == "error", "rejected").when(F.col("event_type") == "signup", "orphan").otherwise("accepted")
    parts = upsert.split_outcomes(t("events").withColumn("outcome", kind))
    rows = [parts[n].select(F.lit(n).alias("outcome"), "user_id") for n in ("accepted", "rejected", "orphan")]
    return rows[0].unionByName(rows[1]).unionByName(rows[2]).groupBy("outcome").agg(
        F.count(F.lit(1)).alias("cnt"), F.sum("user_id").alias("users"))


@query("full_refresh", """
    SELECT 'parent' AS name, count(*) AS cnt FROM orders UNION ALL SELECT 'child', 0""")
def _(t, spark):
    root, child = folder(spark, "parent"), folder(spark, "child")
    sinks.publish(both_sides(t)[0], root)
    sinks.publish(t("orders").select("o_orderkey"), child)
    whole = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderpriority")
    sinks.refresh(whole, root, {child: ORDERS.schema})
    return quality.row_counts(parent=sinks.read_table(spark, root, ORDERS.schema), child=sinks.read_table(spark, child, ORDERS.schema))


@query("append_insert", "SELECT o_orderkey, o_orderstatus, o_totalprice, CAST(NULL AS VARCHAR) AS o_orderpriority FROM orders")
def _(t, spark):
    root = folder(spark, "append")
    rows = t("orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    for part in ("o_orderdate < '1998-01-01'", "o_orderdate >= '1998-01-01'"):
        sinks.append_new(rows.filter(part), root, ORDERS.schema, ["o_orderkey"])
    return sinks.read_table(spark, root, ORDERS.schema)


@query("schema_evolution", """
    SELECT p_partkey AS k, CAST(p_size AS BIGINT) AS n, CAST(NULL AS DOUBLE) AS added, p_name AS v FROM part""")
def _(t, spark):
    wide = Table("p", _columns("k:bigint n:bigint added:double v"), ("k",))
    return sinks.conform(t("part").select(F.col("p_partkey").alias("k"), F.col("p_name").alias("v"), F.col("p_size").alias("n")), wide.schema)
