import datetime as dt
import glob
import json
import os

import pytest
from pyspark.sql import functions as F

from loadkit import sinks
from loadkit.plans import dimensions, facts, repairs
from loadkit.schemas import APP, APP_CSV, APP_CSV_SHORT, DAILY, GAME, MONTHLY, PC_GAME
from loadkit.streaming import incremental


def put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def lines_file(path, rows):
    return put(path, "".join((r if isinstance(r, str) else json.dumps(r, ensure_ascii=False)) + "\n" for r in rows))


def out_lines(path):
    text = []
    for name in sorted(glob.glob(f"{path}/part-*")):
        with open(name, encoding="utf-8", newline="") as f:
            text += f.read().split("\n")[:-1]
    return text


def figures(load):
    counts = {r.name: r.cnt for r in load.counts().collect()}
    assert counts["lines"] == counts["accepted"] + counts["rejects"] + counts["orphans"]
    return counts["lines"], counts["accepted"], counts["rejects"], counts["orphans"]


def test_widths():
    assert [len(t.columns) for t in (GAME, APP, DAILY, PC_GAME, MONTHLY)] == [26, 53, 10, 13, 3]
    assert (len(APP_CSV), len(APP_CSV_SHORT)) == (53, 52)
    kinds = list(APP.columns.values())
    assert [kinds.count(k) for k in ("json", "timestamp", "boolean", "double", "int")] == [10, 3, 4, 3, 4]


def test_games_and_apps(spark, tmp):
    games = lines_file(f"{tmp}/g.ndjson", [
        {"unified_app_id": "g1", "name": "one", "itunes_apps": [1, 2], "android_apps": None, "game_release_date_ww": "2020-01-02"},
        {"unified_app_id": "g1", "name": "again"}, {"unified_app_id": " "}, "", "{bad", {"unified_app_id": "g2", "itunes_apps": "[3]",
         "game_release_date_us": "soon"},
    ])
    g_root, a_root, f_root = (f"{tmp}/{n}" for n in "gaf")
    sinks.publish(spark.createDataFrame([], DAILY.schema), f_root)
    load = dimensions.load_games(spark, games, g_root, {a_root: APP.schema, f_root: DAILY.schema})
    assert figures(load) == (6, 3, 3, 0)
    assert [(r.line_no, r.reason) for r in load.rejects.orderBy("line_no").collect()] == [
        (3, "blank_unified_app_id"), (4, "blank_line"), (5, "invalid_json")]
    table = sinks.read_table(spark, g_root, GAME.schema)
    rows = table.select("unified_app_id", "name", F.to_json("itunes_apps"), F.to_json("android_apps"),
                        F.to_json("unified_publisher_ids"), "game_release_date_ww", "game_release_date_us").orderBy("unified_app_id").collect()
    assert [tuple(r) for r in rows] == [("g1", "one", "[1,2]", "null", None, dt.date(2020, 1, 2), None), ("g2", None, '"[3]"', None, None, None, None)]

    apps = lines_file(f"{tmp}/a.ndjson", [
        {"app_id": 1, "unified_app_id": "g1", "active": "yes", "rating": 2.5, "categories": [6017], "release_date": "2010-06-28T00:00:00Z",
         "rating_count": 5, "permissions": None, "revenue_multiplier": "x"},
        {"app_id": "1", "unified_app_id": "g2"}, {"app_id": "com.a", "unified_app_id": ""}, {"app_id": "com.b"},
        {"app_id": "lost", "unified_app_id": "g9"}, {"app_id": "lost", "unified_app_id": "g9"}, {"app_id": "-x"}, [1], "",
    ])
    load = dimensions.load_apps(spark, apps, a_root, table, {f_root: DAILY.schema})
    assert figures(load) == (9, 4, 3, 2)
    assert [tuple(r)[2:] for r in load.orphans.collect()] == [("lost", "g9", dimensions.MISSING_GAME)] * 2
    rows = sinks.read_table(spark, a_root, APP.schema).orderBy("app_id").collect()
    assert [(r.app_id, r.unified_app_id) for r in rows] == [("1", "g1"), ("com.a", None), ("com.b", None)]
    assert (rows[0].active, rows[0].rating, rows[0].rating_count, rows[0].revenue_multiplier) == (True, 2.5, 5, None)
    assert rows[0].release_date.isoformat().startswith("2010-06-28T")
    load = dimensions.load_games(spark, lines_file(f"{tmp}/g2.ndjson", [{"unified_app_id": "g1", "name": "new"}]), g_root, mode="upsert")
    rows = sinks.read_table(spark, g_root, GAME.schema).select("unified_app_id", "name").collect()
    assert sorted(map(tuple, rows)) == [("g1", "new"), ("g2", None)]
    load.write_splits(f"{tmp}/splits")
    assert spark.read.parquet(f"{tmp}/splits/rejects").count() == 0
    first = dimensions.preview_dimension(spark, g_root, GAME, ["unified_app_id", "name"], 1).collect()
    assert [tuple(r) for r in first] == [("g1", "new")]


def csv_text(columns, rows):
    body = ["\t".join(columns).replace("\t", ",")]
    for row in rows:
        body.append(",".join('"' + str(row[c]).replace('"', '""') + '"' if c in row else "" for c in columns))
    return "\n".join(body) + "\n"


def test_apps_csv(spark, tmp):
    path = put(f"{tmp}/a.csv", csv_text(APP_CSV, [
        {"app_id": "12", "name": "x\ny", "categories": "['a', None]", "price": "1.5", "rating": "bad", "active": "t"},
        {"app_id": "12", "name": "again"}, {"app_id": "", "name": "empty"}, {"name": "none"}, {"app_id": "ab"}, {"app_id": "1" * 33}]))
    root = f"{tmp}/t"
    load, quality = dimensions.load_apps_csv(spark, path, root)
    assert figures(load) == (6, 2, 4, 0)
    assert tuple(quality.first()) == (6, 2, 3)
    row = sinks.read_table(spark, root, APP.schema).select("app_id", "name", F.to_json("categories").alias("c"), "price", "rating", "active").collect()
    assert [tuple(r) for r in row] == [("12", "x\ny", '["a",null]', 1.5, None, True)]
    more = put(f"{tmp}/b.csv", csv_text(APP_CSV_SHORT, [{"app_id": "ab", "price": "2"}, {"app_id": "7", "description": ""}]))
    dimensions.load_apps_csv(spark, more, root, cast="strict", mode="append")
    rows = sinks.read_table(spark, root, APP.schema).select("app_id", "price", "description", "rating_count").orderBy("app_id").collect()
    assert [tuple(r) for r in rows] == [("12", 1.5, None, None), ("7", None, "", None), ("ab", 2.0, None, None)]
    with pytest.raises(ValueError, match="duplicate key"):
        dimensions.load_apps_csv(spark, more, root, cast="strict", mode="append")
    bad = put(f"{tmp}/c.csv", csv_text(APP_CSV_SHORT, [{"app_id": "8", "price": "dear"}]))
    with pytest.raises(Exception, match="invalid double"):
        dimensions.load_apps_csv(spark, bad, root, cast="strict", mode="append")


def test_pc_games(spark, tmp):
    path = lines_file(f"{tmp}/p.ndjson", [
        {"app_id": 10, "name": "a", "initial_price": "9.99", "release_date": "11/16/2004"}, {"app_id": " 12 ", "initial_price": "", "release_date": ""},
        {"app_id": "ab-1"}, {"app_id": "10", "name": "b"}, {"app_id": 13, "initial_price": "free", "release_date": "13/40/2004"}])
    load = dimensions.load_pc_games(spark, path, f"{tmp}/t")
    assert figures(load) == (5, 4, 1, 0)
    assert [r.reason for r in load.rejects.collect()] == ["app_id_not_integer"]
    rows = sinks.read_table(spark, f"{tmp}/t", PC_GAME.schema).select("app_id", "name", "initial_price", "release_date").orderBy("app_id").collect()
    assert [tuple(r) for r in rows] == [(10, "a", 9.99, dt.date(2004, 11, 16)), (12, None, None, None), (13, None, None, None)]
    with pytest.raises(Exception, match="invalid"):
        dimensions.load_pc_games(spark, path, f"{tmp}/t", on_error="fail")


DAILY_LINES = [
    {"aid": "a", "c": "US", "d": "2024-01-01", "u": 1, "r": "x"}, {"aid": "a", "c": " ", "cc": "KR", "d": "2024-01-01T00:00:00Z", "u": 2},
    {"aid": "a", "c": "US", "d": "2024-01-01T00:00:00Z", "u": 5}, {"aid": "zz", "c": "US", "d": "2024-01-01"}, {"aid": "b", "d": "2024-01-01"},
    {"aid": "b", "c": "US", "d": "never"}, {"c": "US", "d": "2024-01-01"}, "{bad", "", {"aid": "b", "c": "US", "cc": "JP", "d": "2024-02-01", "au": -3},
]
DAILY_ROWS = [("a", "KR", "KR", "2024-01-01 00:00:00", 2, 0, 0), ("a", "US", "US", "2024-01-01 00:00:00", 5, 0, 0),
              ("b", "US", "JP", "2024-02-01 00:00:00", 0, -3, 0)]


def daily(spark, root):
    rows = sinks.read_table(spark, root, DAILY.schema).select(
        "app_id", "country_android", "country_ios", F.col("date").cast("string"), "downloads_android", "downloads_ipad", "revenue_android")
    return sorted(map(tuple, rows.collect()))


def test_daily(spark, tmp):
    apps = spark.createDataFrame([("a",), ("b",)], "app_id string")
    path = lines_file(f"{tmp}/in/f.ndjson", DAILY_LINES)
    with pytest.raises(ValueError, match="without parent"):
        facts.load_fact(spark, path, facts.DAILY_FACT, f"{tmp}/t", apps)
    load = facts.load_fact(spark, path, facts.DAILY_FACT, f"{tmp}/t", apps, orphans="divert")
    assert figures(load) == (10, 4, 5, 1)
    assert daily(spark, f"{tmp}/t") == DAILY_ROWS
    assert [(r.line_no, r.reason) for r in load.rejects.orderBy("line_no").collect()] == [
        (5, "missing_country"), (6, "bad_date"), (7, "missing_aid"), (8, "invalid_json"), (9, "blank_line")]
    assert [(r.line_no, r.app_id, json.loads(r.raw_line)["aid"]) for r in load.orphans.collect()] == [(4, "zz", "zz")]
    strict = facts.load_fact(spark, path, facts.DAILY_FACT, f"{tmp}/s", apps, orphans="divert", strict_metrics=True)
    assert (1, "bad_r") in [(r.line_no, r.reason) for r in strict.rejects.collect()]
    with pytest.raises(ValueError, match="occurs 2 times"):
        facts.load_fact(spark, path, facts.DAILY_FACT, f"{tmp}/t", apps, orphans="drop", on_dup="error")


@pytest.mark.parametrize("batch_lines", [3, 100])
def test_daily_in_batches(spark, tmp, batch_lines):
    apps = spark.createDataFrame([("a",), ("b",)], "app_id string")
    path = lines_file(f"{tmp}/in/f.ndjson", DAILY_LINES)
    from loadkit.sources import scan_lines

    view = incremental.load_in_batches(spark, scan_lines(spark, path), facts.DAILY_FACT, f"{tmp}/t", apps, f"{tmp}/w", batch_lines).first()
    assert daily(spark, f"{tmp}/t") == DAILY_ROWS
    done = incremental.progress(spark, f"{tmp}/w").orderBy("batch").collect()
    assert [r.processed_lines for r in done] == ([3, 6, 9, 10] if batch_lines == 3 else [10])
    assert (view.total_lines, view.processed_lines, view.percent) == (10, 10, 100.0)
    # Keys that return in a later batch count there again: rows 1 and 3 share one.
    assert view.inserted_rows == 3
    assert [(r.line_no, r.app_id) for r in incremental.batch_orphans(spark, facts.DAILY_FACT, f"{tmp}/w").collect()] == [(4, "zz")]
    assert sorted(r.line_no for r in incremental.batch_rejects(spark, facts.DAILY_FACT, f"{tmp}/w").collect()) == [5, 6, 7, 8, 9]


def test_failed_batch_resumes(spark, tmp, monkeypatch):
    apps = spark.createDataFrame([("a",), ("b",)], "app_id string")
    from loadkit.sources import scan_lines

    lines = scan_lines(spark, lines_file(f"{tmp}/in/f.ndjson", DAILY_LINES))
    run, seen = incremental.run_batch, []

    def failing(rows, batch, *args, **kw):
        seen.append(batch)
        if batch == 2 and seen.count(2) == 1:
            raise RuntimeError("lost")
        run(rows, batch, *args, **kw)

    monkeypatch.setattr(incremental, "run_batch", failing)
    args = (spark, lines, facts.DAILY_FACT, f"{tmp}/t", apps, f"{tmp}/w", 3)
    with pytest.raises(RuntimeError):
        incremental.load_in_batches(*args)
    assert incremental.progress_view(spark, f"{tmp}/w").first().processed_lines == 6
    incremental.load_in_batches(*args)
    assert seen == [0, 1, 2, 2, 3]
    assert daily(spark, f"{tmp}/t") == DAILY_ROWS


def test_merged_batches_stay_when_a_later_one_fails(spark, tmp):
    from loadkit.sources import scan_lines

    months = [f"2024-{m:02d}" for m in range(1, 9)]
    lines = scan_lines(spark, lines_file(f"{tmp}/in/f.ndjson", [{"app_id": 9 if m == "2024-06" else 1, "month": m, "peak_ccu": i} for i, m in enumerate(months)]))
    known = spark.createDataFrame([(1,)], "app_id int")
    args = (spark, lines, facts.MONTHLY_FACT, f"{tmp}/t")
    read = lambda: sorted(str(r.month)[:7] for r in sinks.read_table(spark, f"{tmp}/t", MONTHLY.schema).collect())
    more = {"batch_lines": 2, "mode": "upsert", "partition_by": "month"}
    with pytest.raises(Exception, match="no parent"):
        incremental.load_in_batches(*args, known, f"{tmp}/w", orphans="fail", **more)
    assert read() == months[:4]
    incremental.load_in_batches(*args, known, f"{tmp}/w", **more)
    assert read() == [m for m in months if m != "2024-06"]


def test_first_row_of_the_first_file_stays(spark, tmp):
    """Of equal keys the row in the first file stays, however Spark packs the files."""
    at = APP_CSV.index("app_id"), APP_CSV.index("name")
    line = lambda name: ",".join("7" if i == at[0] else name if i == at[1] else "" for i in range(len(APP_CSV)))
    put(f"{tmp}/in/a.csv", ",".join(APP_CSV) + "\n" + line("first") + "\n")
    put(f"{tmp}/in/b.csv", ",".join(APP_CSV) + "\n" + line("second") + "\n" + (line("third") + "\n") * 500)
    dimensions.load_apps_csv(spark, f"{tmp}/in", f"{tmp}/t")
    assert [r.name for r in sinks.read_table(spark, f"{tmp}/t", APP.schema).collect()] == ["first"]


def test_surplus_csv_fields_are_not_cut(spark, tmp):
    from loadkit.sources import scan_csv

    path = put(f"{tmp}/c.csv", "a,b\n1\n1,2\n")
    assert [tuple(r) for r in scan_csv(spark, path, ["a", "b"], ragged="pad").collect()] == [("1", None), ("1", "2")]
    with pytest.raises(Exception, match="more fields than columns"):
        scan_csv(spark, put(f"{tmp}/d.csv", "a,b\n1,2,3\n"), ["a", "b"], ragged="pad").collect()


def test_rows_without_a_json_form_are_not_dropped(spark, tmp):
    path = put(f"{tmp}/c.csv", "a,b\n1,\"{1,2}\"\n2,[1]\n")
    with pytest.raises(ValueError, match="no JSON form"):
        repairs.csv_to_ndjson(spark, path, f"{tmp}/out", json_cols=["b"])
    repairs.csv_to_ndjson(spark, path, f"{tmp}/out2", json_cols=["b"], rejects=f"{tmp}/bad")
    assert len(out_lines(f"{tmp}/out2")) == 1 and spark.read.parquet(f"{tmp}/bad").count() == 1


def test_empty_batches(spark, tmp):
    from loadkit.sources import scan_lines

    lines = scan_lines(spark, put(f"{tmp}/in/f.ndjson", ""))
    view = incremental.load_in_batches(spark, lines, facts.DAILY_FACT, f"{tmp}/t", spark.createDataFrame([], "app_id string"), f"{tmp}/w").first()
    assert (view.total_lines, view.processed_lines, view.inserted_rows) == (None, 0, 0)
    assert not os.path.exists(f"{tmp}/t")


@pytest.mark.parametrize("policy, peak", [("keep", 1), ("replace", 7)])
def test_monthly_stream(spark, tmp, policy, peak):
    games = spark.createDataFrame([(1,), (2,)], "app_id int")
    lines_file(f"{tmp}/in/a.ndjson", [{"app_id": 1, "month": "2024-05", "peak_ccu": 1}, {"app_id": 9, "month": "2024-05"}, {"app_id": "x", "month": "2024-05"}])
    lines_file(f"{tmp}/in/b.ndjson", [{"app_id": "1", "month": "2024-05", "peak_ccu": "7"}, {"app_id": 2, "month": "2024-5"}])
    os.utime(f"{tmp}/in/a.ndjson", (1, 1))
    call = lambda mode: incremental.stream_fact(spark, f"{tmp}/in", facts.MONTHLY_FACT, f"{tmp}/t", games, f"{tmp}/w", files_per_batch=1,
                                                policy=policy, mode=mode, partition_by="month").first()
    view = call("upsert")
    assert (view.processed_lines, view.inserted_rows) == (5, 2)
    read = lambda: sorted(map(tuple, sinks.read_table(spark, f"{tmp}/t", MONTHLY.schema).collect()))
    assert read() == [(1, dt.date(2024, 5, 1), peak)]
    lines_file(f"{tmp}/in/c.ndjson", [{"app_id": 2, "month": "2024-06", "peak_ccu": 3}])
    view = call("upsert")
    assert (view.processed_lines, view.inserted_rows) == (6, 3)
    assert read() == [(1, dt.date(2024, 5, 1), peak), (2, dt.date(2024, 6, 1), 3)]
    place = lambda r: (os.path.basename(r.file), r.line_no)
    rejects = incremental.batch_rejects(spark, facts.MONTHLY_FACT, f"{tmp}/w").collect()
    assert sorted((*place(r), r.reason) for r in rejects) == [("a.ndjson", 3, "app_id_not_integer"), ("b.ndjson", 2, "bad_month")]
    assert [(*place(r), r.app_id) for r in incremental.batch_orphans(spark, facts.MONTHLY_FACT, f"{tmp}/w").collect()] == [("a.ndjson", 2, 9)]


def test_monthly_once(spark, tmp):
    games = spark.createDataFrame([(1,)], "app_id int")
    path = lines_file(f"{tmp}/m.ndjson", [{"app_id": 1, "month": "2024-05", "peak_ccu": 1}, {"app_id": 1, "month": "2024-05", "peak_ccu": None}, {"app_id": 9, "month": "2024-05"}])
    load = facts.load_fact(spark, path, facts.MONTHLY_FACT, f"{tmp}/t", games, orphans="drop", policy="replace")
    assert sorted(map(tuple, sinks.read_table(spark, f"{tmp}/t", MONTHLY.schema).collect())) == [(1, dt.date(2024, 5, 1), None)]
    assert load.orphans.count() == 0
    with pytest.raises(Exception, match="integer key"):
        facts.load_fact(spark, lines_file(f"{tmp}/x.ndjson", [{"app_id": "x"}]), facts.MONTHLY_FACT, f"{tmp}/t", games, on_error="fail")


def test_repairs(spark, tmp):
    path = put(f"{tmp}/r/in.csv", 'id,tags,description\n1,"[a,b]",x,y\n2,t\n\n3,{1,2},"q ""z"""\n')
    assert tuple(repairs.clean_csv(spark, path, f"{tmp}/r/c").first()) == (3, 2)
    assert out_lines(f"{tmp}/r/c")[0] == "id,tags,description\r"
    assert out_lines(f"{tmp}/r/c")[1:] == ['1,"""[a,b]""","x,y"\r', "2,t,\r", '3,"{1,2}","""q """"z"""""""\r']
    got = repairs.csv_to_ndjson(spark, path, f"{tmp}/r/n", json_cols=["tags"], rejects=f"{tmp}/r/bad").first()
    assert tuple(got) == (3, 2, 1)
    assert [json.loads(x) for x in out_lines(f"{tmp}/r/n")] == [{"id": "1", "tags": "[a,b]", "description": "x,y"}, {"id": "2", "tags": "t", "description": None}]
    assert [tuple(r) for r in spark.read.parquet(f"{tmp}/r/bad").collect()] == [('3,{1,2},"q ""z"""', "no_json_form")]
    path = put(f"{tmp}/f.ndjson", '{"é":"x\ny"}\n{"a":1,\r\n"b":2}')
    assert tuple(repairs.fix_ndjson(spark, path, f"{tmp}/f").first()) == (2, 1, 0)
    assert [json.loads(x) for x in out_lines(f"{tmp}/f")] == [{"é": "x\ny"}, {"a": 1, "b": 2}]
    path = put(f"{tmp}/d.ndjson", '{"n":1}\n\n{"description":"say "hi"","n":2}\nnope\n')
    assert tuple(repairs.repair_ndjson(spark, path, f"{tmp}/d", f"{tmp}/dr").first()) == (3, 2, 1, 1)
    assert [json.loads(x) for x in out_lines(f"{tmp}/dr")] == [{"line_no": 4, "raw": "nope"}]
    path = put(f"{tmp}/l.json", '[{"a":null},2]')
    for parallel in (False, True):
        assert repairs.json_list_to_ndjson(spark, path, f"{tmp}/l{parallel}", parallel).first().rows == 2
        assert out_lines(f"{tmp}/l{parallel}") == ['{"a":null}', "2"]


def csv_cases():
    return [
        'id,text,note\r\n', '1,plain,x\r\n', '\r\n', '2,"two\nlines",\r\n', '3,"a ""quoted""\n\n""word""",""\r\n', '4,5" disk,"x,y"\r\n', '5,"ends with break\n",  padded \r\n',
        *[f'{n},"row\n{n}, ""with"" break","{"z" * (n % 7)}"\r\n' for n in range(6, 60)],
    ]


def test_large_csv_is_read_by_split(spark, tmp):
    import csv
    import io

    from loadkit.sources import POSITION, scan_csv

    text = "".join(csv_cases())
    path = put(f"{tmp}/in/b.csv", text)
    put(f"{tmp}/in/a.csv", "id,text,note\n0,first,\n")
    names = ["id", "text", "note"]
    whole = sorted(tuple(r) for r in scan_csv(spark, f"{tmp}/in", names).collect())
    by_hand = [r for r in csv.reader(io.StringIO(text, newline="")) if r][1:]
    assert [r[0] for r in sorted(whole, key=lambda r: int(r[0]))] == ["0", *[r[0] for r in by_hand]]
    assert {r[0]: r[1] for r in whole if r[0] != "0"} == {r[0]: r[1] for r in by_hand}
    for size in ("200", "700", "100000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            split = scan_csv(spark, f"{tmp}/in", names, position=True, whole_file=0)
            rows = split.orderBy(*POSITION).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [r.id for r in rows] == ["0", *[r[0] for r in by_hand]]
        assert sorted((r.id, r.text, r.note) for r in rows) == whole
    put(f"{tmp}/bad.csv", "id,text\n1,2,3\n")
    with pytest.raises(Exception, match="MALFORMED|alformed"):
        scan_csv(spark, f"{tmp}/bad.csv", ["id", "text"], whole_file=0).collect()
    assert scan_csv(spark, path, names, whole_file=0).limit(0).columns == names


def test_written_csv_keeps_line_breaks(spark, tmp):
    import csv
    import io
    import pathlib

    rows = [("1", "a\nb\r\nc", None), ("2", 'say "x", y', ""), ("3", "", "é")]
    sinks.write_csv(spark.createDataFrame(rows, '`id` string, `the "text"` string, note string').coalesce(1), f"{tmp}/out")
    text = next(pathlib.Path(f"{tmp}/out").glob("part-*")).read_bytes().decode()
    got = list(csv.reader(io.StringIO(text, newline="")))
    assert got == [["id", 'the "text"', "note"], *[[v or "" for v in r] for r in rows]]
    assert text.endswith("\r\n")


def test_stages_end_with_their_load(spark, tmp):
    from loadkit import session

    outside = session.stage(spark.range(3), "outer")
    with session.stages(spark):
        inside = session.stage(spark.range(5), "inner")
        assert inside.count() == 5
        path = inside.inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
    assert not os.path.exists(path) and outside.count() == 3
    with pytest.raises(RuntimeError), session.stages(spark):
        path = session.stage(spark.range(5), "inner").inputFiles()[0].rsplit("/", 1)[0].removeprefix("file:")
        raise RuntimeError
    assert not os.path.exists(path)
