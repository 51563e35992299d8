"""Plans that must keep their shape for large inputs."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from loadkit import session, sinks
from loadkit.functions.json import parse_records
from loadkit.operators import damage, keys, refcheck, upsert
from loadkit.plans import dimensions, facts
from loadkit.sources import number_lines, scan_lines


def physical(df):
    return df._jdf.queryExecution().executedPlan().toString()


def lines_at(spark, tmp, n=50):
    spark.range(n).selectExpr("concat('{\"app_id\":', id, ',\"unified_app_id\":\"g\"}') value").write.text(f"{tmp}/lines")
    return scan_lines(spark, f"{tmp}/lines")


def table_at(spark, tmp, name="t", n=1000):
    spark.range(n).selectExpr("id k", "id % 7 v", "string(id) wide").write.parquet(f"{tmp}/{name}")
    return spark.read.parquet(f"{tmp}/{name}")


def test_filters_do_not_repeat_the_parse(spark, tmp):
    parsed = parse_records(lines_at(spark, tmp), ["app_id"]).filter("rec.app_id is not null and rec.app_id > '3'").groupBy("rec.app_id").count()
    assert physical(parsed).count("from_json") == 1
    repaired = damage.repair_records(lines_at(spark, tmp + "2")).filter("record is not null")
    assert physical(repaired).count("ArrowEvalPython") == 1


def test_breakdown_parses_once(spark, tmp):
    from loadkit.functions.json import parse_records as parse
    from loadkit.operators import classify
    from loadkit.operators.quality import reject_breakdown

    parsed = parse(lines_at(spark, tmp), ["app_id"])
    rules = classify.line_rules("line", parsed.rec_ok) + classify.id_rules(parsed["rec.app_id"])
    judged = parsed.select("line", classify.first_reason(rules).alias("reason"))
    plan = physical(reject_breakdown(judged.filter("reason is not null")))
    assert plan.count("from_json") == 3


def test_classification_parses_once_and_keeps_rows_in_place(spark, tmp):
    games = table_at(spark, tmp).selectExpr("wide unified_app_id")
    plan = physical(dimensions.classify_apps(lines_at(spark, tmp), games).filter("outcome = 'accepted'"))
    # One parse of the record, and two passes that only lines without a record pay for.
    assert plan.count("from_json(StructField(digest") == 2 and plan.count("from_json") == 3 and "parse_json" not in plan
    # The only exchanges are on the parent's keys: its distinct and the broadcast.
    assert plan.count("Exchange hashpartitioning") == 1
    assert "BroadcastHashJoin" in plan


def test_large_parent_is_not_broadcast(spark, tmp):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        apps = table_at(spark, tmp).selectExpr("wide app_id")
        plan = physical(facts.DAILY_FACT.judged(lines_at(spark, tmp), apps))
        assert "SortMergeJoin" in plan and "BroadcastExchange" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_line_numbers_do_not_shuffle_lines(spark, tmp):
    plan = physical(number_lines(lines_at(spark, tmp)))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Window" not in plan


def test_scans_are_pruned(spark, tmp):
    left, right = table_at(spark, tmp, "l"), table_at(spark, tmp, "r")
    plan = physical(refcheck.orphans(left.select("k", "v"), right.filter("v > 3"), "k"))
    assert "ReadSchema: struct<k:bigint,v:bigint>" in plan and "wide" not in plan
    assert "PushedFilters: [IsNotNull(v), GreaterThan(v,3), IsNotNull(k)]" in plan


def test_small_batch_does_not_shuffle_the_target(spark, tmp):
    target, batch = table_at(spark, tmp, "t"), table_at(spark, tmp, "b")
    plan = physical(upsert.upsert(target, batch, ["k"]))
    assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan


def test_touched_partitions_only(spark, tmp, monkeypatch):
    schema = T.StructType().add("k", "long").add("m", "string").add("v", "long")
    rows = spark.range(100).selectExpr("id k", "lpad(string(id % 10), 3, '0') m", "id v")
    sinks.publish(rows, f"{tmp}/t", ["m"])
    path = sinks.current_path(spark, f"{tmp}/t")
    seen = []
    merge = upsert.upsert

    def watched(target, *args):
        seen.append(physical(target))
        return merge(target, *args)

    monkeypatch.setattr(upsert, "upsert", watched)
    before = {p: p.stat().st_mtime_ns for p in _files(path)}
    batch = rows.filter("m = '003'").withColumn("v", F.lit(700).cast("long"))
    upsert.upsert_table(f"{tmp}/t", batch, schema, ["k", "m"], order_by=["v"], partition_by="m")
    assert "PartitionFilters: [isnotnull(m" in seen[0] and "= 003" in seen[0]
    after = {p: p.stat().st_mtime_ns for p in _files(path)}
    assert {p for p in before if after.get(p) != before[p]} == {p for p in before if "m=003" in str(p)}
    table = sinks.read_table(spark, f"{tmp}/t", schema)
    assert table.count() == 100 and table.filter("v = 700").count() == table.filter("m = '003'").count() == 10


def _files(path):
    import pathlib

    return pathlib.Path(path).rglob("part-*.parquet")


def test_hot_key_is_cut_before_the_exchange(spark):
    plan = physical(keys.keep_one(spark.range(1000).selectExpr("id % 3 k", "id v"), ["k"], ["v"]))
    exchange, partial = plan.index("Exchange hashpartitioning(k"), plan.index("Partial")
    assert "WindowGroupLimit [k" in plan and partial > exchange  # below the exchange in the tree


def test_scratch_follows_the_session(spark, tmp):
    saved = spark.conf.get("spark.checkpoint.dir")
    assert session.scratch_dir(spark) == saved
    frame = session.stage(spark.range(3), "here")
    assert frame.inputFiles()[0].startswith("file:") and saved in frame.inputFiles()[0]
    assert session.drop_stages(spark) >= 1


def test_rejects_are_numbered_when_asked_for(spark, tmp, monkeypatch):
    from loadkit.plans import common

    asked = []
    counted = common.line_offsets
    monkeypatch.setattr(common, "line_offsets", lambda df: asked.append(1) or counted(df))
    load = dimensions.load_games(spark, lines_at(spark, tmp), f"{tmp}/t")
    assert {r.name: r.cnt for r in load.counts().collect()}["lines"] == 50 and not asked
    assert load.rejects.count() + load.accepted.count() == 50 and load.rejects.columns == ["line_no", "line", "reason"] and len(asked) == 1


def test_slow_casts_stay_out_of_generated_code(spark):
    from loadkit.functions import casts

    texts = spark.range(5).selectExpr("string(id) t").select(*[casts.to_timestamptz_loose("t").alias(f"c{i}") for i in range(20)])
    assert physical(texts).count("lambdafunction") >= 20
