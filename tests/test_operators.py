import pytest
from pyspark.sql import functions as F

from loadkit import sinks
from loadkit.operators import classify, keys, quality, refcheck, upsert
from loadkit.schemas import _columns, Table


def test_reject_order(texts):
    from loadkit.functions.json import parse_records

    lines = ["", None, "  ", "{bad", "{}", "[1]", '{"app_id":" "}', '{"app_id":"%s"}' % ("a" * 256), '{"app_id":"-x"}',
             '{"app_id":"com.a_b-1"}', '{"app_id":"12\\n"}', '{"app_id":12}', '{"app_id":"%s"}' % ("a" * 255)]
    frame = parse_records(texts(lines, "line"), ["app_id"])
    key = F.col("rec.app_id")
    reason = classify.first_reason(classify.line_rules("line", F.col("rec_ok")) + classify.id_rules(key))
    got = [r.reason for r in frame.select("i", reason.alias("reason")).orderBy("i").collect()]
    assert got == ["blank_line"] * 3 + ["invalid_json", "blank_app_id", "blank_app_id", "blank_app_id", "app_id_too_long",
                   "app_id_bad_format", None, "app_id_bad_format", None, None]


def test_integer_ids(column):
    rule = lambda c: classify.first_reason(classify.integer_id_rules(c, classify.col(c).try_cast("int")))
    assert column(rule, ["12", " 12 ", "ab-1", "99999999999", "", "-1"]) == [
        None, None, "app_id_not_integer", "app_id_not_integer", "blank_app_id", "app_id_bad_format"]


def test_reference_checks(spark):
    child = spark.createDataFrame([(1, "p"), (2, "q"), (3, None), (4, " "), (5, "q")], "id int, k string")
    parent = spark.createDataFrame([("p",), ("r",), ("p",), (None,)], "k string")
    ids = lambda df: sorted(r.id for r in df.collect())
    assert ids(refcheck.orphans(child, parent, "k", skip_blank=True)) == [2, 5]
    assert ids(refcheck.orphans(child, parent, "k")) == [2, 3, 4, 5]
    assert ids(refcheck.present_or_blank(child, parent, "k")) == [1, 3, 4]
    assert ids(refcheck.with_parent(child, parent, "k")) == [1]
    assert {r.id: r.has_parent for r in refcheck.mark_parent(child, parent, "k").collect()} == {1: True, 2: False, 3: False, 4: False, 5: False}
    assert {(r.k, r.rows) for r in refcheck.check_reference(child, parent, "k").collect()} == {("q", 2), (" ", 1)}
    with pytest.raises(ValueError):
        refcheck.require_reference(child, parent, "k")


def test_hot_key_gives_whole_results(spark):
    """A third of the rows on one key, joined and de-duplicated without broadcast and with tiny skew limits."""
    rows = spark.range(30000).select("id", F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 1000).cast("string").alias("k"))
    parent = spark.range(0, 1000, 2).select(F.col("id").cast("string").alias("k"))
    saved = {k: spark.conf.get(k, None) for k in ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold",
             "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "spark.sql.adaptive.advisoryPartitionSizeInBytes",
             "spark.sql.adaptive.skewJoin.skewedPartitionFactor", "spark.sql.shuffle.partitions"]}
    try:
        for k, v in zip(saved, ["-1", "-1", "1KB", "1KB", "2", "16"]):
            spark.conf.set(k, v)
        marked = refcheck.mark_parent(rows, parent, "k")
        counted = marked.groupBy("has_parent").count()
        split = {r.has_parent: r["count"] for r in counted.collect()}
        assert "skew=true" in counted._jdf.queryExecution().executedPlan().toString()
        even = sum(1 for i in range(30000) if i % 3 == 0 or (i % 1000) % 2 == 0)
        assert split == {True: even, False: 30000 - even}
        kept = keys.keep_one(marked, ["k"], ["id"], last=True).filter("k = '0'").collect()
        assert [r.id for r in kept] == [29997 if 29997 % 3 == 0 else None]
    finally:
        for k, v in saved.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_keep_one_limits_before_the_shuffle(spark):
    plan = keys.keep_one(spark.range(10).withColumn("k", F.col("id") % 2), ["k"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2


def test_keys(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, None)], "k int, v string")
    assert sorted(tuple(r) for r in keys.keep_one(df, ["k"], ["v"]).collect()) == [(1, "a"), (2, None)]
    assert sorted(tuple(r) for r in keys.keep_one(df, ["k"], ["v"], last=True).collect()) == [(1, "b"), (2, None)]
    assert tuple(keys.key_check(df, ["k"], ["v"]).first()) == (3, 2, 1, 1)
    with pytest.raises(ValueError):
        keys.require_key(df, ["k"])


def test_quality(spark, texts):
    df = texts(["", None, "12", "x" * 40, "ab"])
    ok = classify.id_ok("x", classify.NUMERIC_PATTERN, classify.CSV_ID_LENGTH)
    assert tuple(quality.key_quality(df, "x", ok).first()) == (5, 2, 3)
    counts = quality.row_counts(a=df, b=df.limit(0)).collect()
    assert {r.name: r.cnt for r in counts} == {"a": 5, "b": 0}
    broken = spark.createDataFrame([("x",), ("y",), ("y",)], "reason string")
    assert [tuple(r) for r in quality.reject_breakdown(broken).collect()] == [("y", 2), ("x", 1)]
    assert quality.highest(df.limit(0), "i").first().i is None


T12 = "k int, v string, w int"


def merged(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], T12)
    source = spark.createDataFrame([(2, "B", None), (3, "C", 30)], T12)
    assert merged(upsert.upsert(target, source, ["k"])) == [(1, "a", 10), (2, "B", None), (3, "C", 30)]
    assert merged(upsert.upsert(target, source, ["k"], "keep")) == [(1, "a", 10), (2, "b", 20), (3, "C", 30)]
    assert merged(upsert.upsert(target, source, ["k"], update_cols=["w"])) == [(1, "a", 10), (2, "b", None), (3, "C", 30)]
    assert tuple(upsert.upsert_counts(target, source, ["k"]).first()) == (2, 1, 1)
    twice = spark.createDataFrame([(2, "B", 1), (2, "B2", 2)], T12)
    assert merged(upsert.one_per_key(twice, ["k"], "last", ["w"])) == [(2, "B2", 2)]
    assert merged(upsert.one_per_key(twice, ["k"], "first", ["w"])) == [(2, "B", 1)]
    with pytest.raises(ValueError, match="occurs 2 times"):
        upsert.one_per_key(twice, ["k"], "error")


@pytest.mark.parametrize("partition_by", [None, "m"])
def test_upsert_table(spark, tmp, partition_by):
    table = Table("t", _columns("k:int m v"), ("k", "m"))
    root = f"{tmp}/t"
    put = lambda rows, **kw: upsert.upsert_table(
        root, spark.createDataFrame(rows, "k int, m string, v string"), table.schema, ["k", "m"], order_by=["v"], partition_by=partition_by, **kw)
    read = lambda: merged(sinks.read_table(spark, root, table.schema))
    assert put([(1, "x", "a"), (2, "y", "b")]) == 2
    for _ in range(2):  # repeating a batch changes nothing
        assert put([(2, "y", "B"), (3, "y", "C"), (3, "y", "D")]) == 2
        assert read() == [(1, "x", "a"), (2, "y", "B"), (3, "y", "D")]
    put([(1, "x", "zz"), (9, "x", "n")], policy="keep")
    assert read() == [(1, "x", "a"), (2, "y", "B"), (3, "y", "D"), (9, "x", "n")]


def test_tables(spark, tmp):
    table = Table("t", _columns("k:int v"), ("k",))
    root, child = f"{tmp}/t", f"{tmp}/c"
    row = lambda *r: spark.createDataFrame([r], "k int, v string")
    sinks.publish(row(9, "child"), child)
    sinks.refresh(row(1, "a"), root, {child: table.schema})
    assert merged(sinks.read_table(spark, root, table.schema)) == [(1, "a")]
    assert merged(sinks.read_table(spark, child, table.schema)) == []
    assert sinks.append_new(row(2, "b"), root, table.schema, ["k"]) == 1
    assert merged(sinks.read_table(spark, root, table.schema)) == [(1, "a"), (2, "b")]
    with pytest.raises(ValueError, match="duplicate key"):
        sinks.append_new(row(2, "c"), root, table.schema, ["k"])
    assert merged(sinks.read_table(spark, root, table.schema)) == [(1, "a"), (2, "b")]
    wide = Table("t", _columns("k:int added:double v"), ("k",))
    assert merged(sinks.read_table(spark, root, wide.schema)) == [(1, None, "a"), (2, None, "b")]
    # A version without its success marker is not the table.
    import os

    os.makedirs(f"{root}/v=7")
    assert len(merged(sinks.read_table(spark, root, table.schema))) == 2
    sinks.publish(row(5, "e"), root)
    assert sinks.current_path(spark, root).endswith("v=8")
    sinks.drop_old_versions(spark, root, keep=1)
    assert merged(sinks.read_table(spark, root, table.schema)) == [(5, "e")]


@pytest.mark.parametrize("when", ["before the marker", "after the marker", "half way"])
def test_broken_changes_leave_the_old_or_the_new_table(spark, tmp, monkeypatch, when):
    """Partition replacement and append that fail in the middle: a reader sees all of the change or nothing."""
    schema = spark.createDataFrame([], "k string, p string, v int").schema
    frame = lambda rows: spark.createDataFrame(rows, schema)
    old = [("a", "1", 1), ("b", "2", 1), ("c", "3", 1)]
    read = lambda root: sorted(tuple(r) for r in sinks.read_table(spark, root, schema).collect())

    class Stop(Exception):
        pass

    def stop_after(function):
        def run(*args):
            if function is not None:
                function(*args)
            raise Stop

        return run

    steps = {"before the marker": ("_put", None), "after the marker": ("_put", sinks._put), "half way": ("_move_in", sinks._move_in)}
    for kind in ("upsert", "append") if when != "half way" else ("append",):
        root = f"{tmp}/{kind}"
        sinks.publish(frame(old), root, ["p"] if kind == "upsert" else None)
        with monkeypatch.context() as patched:
            patched.setattr(sinks, steps[when][0], stop_after(steps[when][1]))
            with pytest.raises(Stop):
                if kind == "upsert":
                    upsert.upsert_table(root, frame([("a", "1", 2), ("d", "2", 2)]), schema, ["k", "p"], order_by=["v"], partition_by="p")
                else:
                    sinks.append_new(frame([("d", "2", 2), ("e", "3", 2)]).repartition(2), root, schema, ["k"])
        new = [("a", "1", 2), ("b", "2", 1), ("c", "3", 1), ("d", "2", 2)] if kind == "upsert" else old + [("d", "2", 2), ("e", "3", 2)]
        for _ in range(2):
            assert read(root) == sorted(old if when == "before the marker" else new)


def test_a_refused_rename_loses_no_rows(spark, tmp, monkeypatch):
    from loadkit import sinks

    root, given = f"{tmp}/t", lambda k: spark.createDataFrame([(k, "x")], "k int, v string")
    schema = given(1).schema
    sinks.append_new(given(1), root, schema, ["k"])
    plain = sinks._fs

    class Refusing:
        def __init__(self, fs):
            self.fs = fs

        def __getattr__(self, name):
            return getattr(self.fs, name)

        def rename(self, source, target):
            return not source.getName().endswith(".parquet") and self.fs.rename(source, target)

    def refusing(spark, path):
        fs, where = plain(spark, path)
        return Refusing(fs), where

    monkeypatch.setattr(sinks, "_fs", refusing)
    with pytest.raises(OSError, match="cannot rename"):
        sinks.append_new(given(2), root, schema, ["k"])
    monkeypatch.undo()
    assert sorted(r.k for r in sinks.read_table(spark, root, schema).collect()) == [1, 2]
