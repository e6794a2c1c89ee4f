"""JSON fields, framed text, text helpers, reports and stored tables."""

import os

import pytest
from pyspark.sql import functions as F

from linkloom.functions import array_to_string, json_fields, seconds_between, string_to_array
from linkloom.functions.json_payload import json_paths, path_elements
from checks.inputs import StubTransport
from linkloom.operators import batch_report, frame_files, frame_record, frames
from linkloom.operators.frames import TOKEN
from linkloom.plans import register_sql
from linkloom.sources import RunStore, load_table, save_table

SITE = (
    '{"station":{"code":"RG-00417","owner":{"label":"RIVER GAUGE NORTH"},'
    '"checked_at":"2024-03-05T08:30:00","n":[10,{"x":1.50,"7":true}],"none":null,"o\'k":"q"},'
    '"a,b":{"-1":{"c\\"d":"e"}},"deep":[[1,2],[3,4]]}'
)


def test_json_projection(spark):
    frame = spark.createDataFrame([(1, SITE), (2, "{}"), (3, None)], "id int, payload string")
    fields = {
        "code": "{station,code}",
        "label": "{station,owner,label}",
        "checked_at": "{station,checked_at}",
        "item": "{station,n,0}",
        "x": "{station,n,1,x}",
        "seven": "{station,n,1,7}",
        "none": "{station,none}",
        "quote": "{station,o'k}",
        "beyond": "{station,code,deeper}",
        "array": "{station,n}",
        "last": "{station,n,-1,x}",
        "first_from_end": "{station,n,-2}",
        "before_first": "{station,n,-3}",
        "negative_key": '{"a,b",-1,"c\\"d"}',
        "from_end_twice": "{deep,-1,-1}",
    }
    got = {r.id: r for r in json_fields(frame, "payload", fields).collect()}
    assert tuple(got[1])[2:] == (
        "RG-00417",
        "RIVER GAUGE NORTH",
        "2024-03-05T08:30:00",
        "10",
        "1.50",
        "true",
        None,
        "q",
        None,
        '[10,{"7":true,"x":1.50}]',
        "1.50",
        "10",
        None,
        "e",
        "4",
    )
    assert set(tuple(got[2])[2:]) == set(tuple(got[3])[2:]) == {None}


def test_whole_value_and_array_at_the_top(spark):
    frame = spark.createDataFrame([("[1,[2,3]]",)], "payload string")
    row = json_fields(frame, "payload", {"all": "{}", "last": "{-1,0}", "one": "{0}"}).first()
    assert tuple(row)[1:] == ("[1,[2,3]]", "2", "1")


def test_malformed_and_duplicate_keys(spark):
    bad = spark.createDataFrame([('{"a":1',), ('{"a":2}',)], "payload string")
    with pytest.raises(Exception, match="MALFORMED_RECORD_IN_PARSING"):
        json_fields(bad, "payload", {"a": "{a}"}).collect()
    assert [r.a for r in json_fields(bad, "payload", {"a": "{a}"}, lenient=True).collect()] == [None, "2"]
    twice = spark.createDataFrame([('{"a":1,"b":{"c":2,"c":3},"a":4}',)], "payload string")
    for lenient in (False, True):
        row = json_fields(twice, "payload", {"a": "{a}", "c": "{b,c}"}, lenient).first()
        assert (row.a, row.c) == ("4", "3")
    # Views and joins analyse the parser anew.
    json_fields(twice, "payload", {"a": "{a}", "c": "{b,c}"}).createOrReplaceTempView("t_twice")
    joined = spark.sql("SELECT l.a, r.c FROM t_twice l JOIN t_twice r ON l.payload = r.payload").collect()
    assert [tuple(r) for r in joined] == [("4", "3")]


EXACT = [
    ('{"a":1.50}', "1.50"),
    ('{"a":1e3}', "1e3"),
    ('{"a":-0.0E-10}', "-0.0E-10"),
    ('{"a":123456789012345678901234567890123456789012345678}', "123456789012345678901234567890123456789012345678"),
    ('{"a": "1.50" }', "1.50"),
    ('{"a":{"b":[1.50, "1.5", "x 2, 3", -7]}}', '{"b":[1.50,"1.5","x 2, 3",-7]}'),
    ('{"a":"{\\"b\\":1.50}"}', '{"b":1.50}'),
    ('{"a":"\\u0001n5"}', "\x01n5"),
    ('{"a":["\\u0001s", 5]}', '["\\u0001s",5]'),
    ('{"a":"q\\"1, 2]"}', 'q"1, 2]'),
    ('{"a":true}', "true"),
    ('{"a":null}', None),
    ('{"a":1,"a":{"x":2.0}}', '{"x":2.0}'),
    ('  {"b":1 , "a"\n:\t2.10 }  ', "2.10"),
    (None, None),
]
MALFORMED = ['{"a":1', '{"a":01}', '{"a":1.}', '{"a":1} x', '{"a":1}}', "1],[2", "1 2", "tr ue", "", " ", '{"a":1 2}', '"x', "{'a':1}"]


def test_text_is_exact_in_python_and_sql(spark):
    register_sql(spark, StubTransport())
    frame = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(EXACT)], "i int, payload string")
    frame.createOrReplaceTempView("t_exact")
    by_column = json_fields(frame, "payload", {"a": "{a}"}).orderBy("i").collect()
    by_sql = spark.sql("SELECT json_text(payload, '{a}') AS a FROM t_exact ORDER BY i").collect()
    assert [r.a for r in by_column] == [r.a for r in by_sql] == [want for _, want in EXACT]


@pytest.mark.parametrize("text", MALFORMED)
def test_malformed_payloads(spark, text):
    frame = spark.createDataFrame([(text,)], "payload string")
    assert json_fields(frame, "payload", {"a": "{}"}, lenient=True).first().a is None
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        json_fields(frame, "payload", {"a": "{}"}).collect()


def test_sql_paths(spark):
    register_sql(spark, StubTransport())
    spark.createDataFrame([(SITE,), ("[1.50,[2,3]]",)], "payload string").createOrReplaceTempView("t_site")
    paths = ["{station,n,1,x}", "{station,n,-1,7}", '{"a,b",-1,"c\\\\"d"}', "{station,o''k}", "{-1,0}", "{0}", "{station,code,x}"]
    columns = ", ".join(f"json_text(payload, '{p}') AS c{i}" for i, p in enumerate(paths))
    got = {tuple(r) for r in spark.sql(f"SELECT {columns} FROM t_site").collect()}
    assert got == {("1.50", "true", "e", "q", None, None, None), (None, None, None, None, "2", "1.50", None)}
    spark.createDataFrame([("{",)], "payload string").createOrReplaceTempView("t_bad")
    assert spark.sql("SELECT try_json_text(payload, '{a}') AS a FROM t_bad").first().a is None
    with pytest.raises(Exception, match="MALFORMED_RECORD"):
        spark.sql("SELECT json_text(payload, '{a}') FROM t_bad").collect()


def test_long_payloads(spark):
    many = '{"a":[' + ",".join(f'"s\\"{i}",{i}.50' for i in range(100_000)) + "]}"
    frame = spark.createDataFrame([(many,), ('{"a":["' + '\\"' * 1_000_000 + '"]}',)], "payload string")
    rows = [r.v for r in json_fields(frame, "payload", {"v": "{a,-1}"}).collect()]
    assert rows == ["99999.50", '"' * 1_000_000]


def test_payload_is_parsed_once(spark):
    frame = spark.createDataFrame([(SITE,)], "payload string")
    fields = json_fields(frame, "payload", {c: "{station," + c + "}" for c in "abc"})
    plan = fields._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parse_json") == 1 or plan.lower().count("parsejson") == 1


def test_paths():
    assert path_elements('{a, "b,c" ,0,"q\\"x"}') == ["a", "b,c", "0", 'q"x']
    assert path_elements("{}") == []
    assert json_paths(["a", "0"]) == ["$.a[0]", "$.a['0']"]
    for wrong in ("a,b", '{"a}', "{a,,\"}"):
        with pytest.raises(ValueError):
            path_elements(wrong)


def test_frames_round_trip(spark):
    rows = spark.createDataFrame(
        [(1, "u1", "body\nwith lines", "t0", "t1"), (1, "u2", None, "t2", "t3"), (1, "u3", "", "t4", "t5")],
        "id int, url string, payload string, a string, b string",
    )
    record = frame_record("url", "payload", "a", "b")
    blob = rows.groupBy("id").agg(
        F.array_join(F.sort_array(F.collect_list(record)), "\n").alias("blob")
    )
    got = [tuple(r) for r in frames(blob, "blob").orderBy("pos").collect()]
    assert got == [
        (1, 0, "u1", "body\nwith lines", "t0", "t1"),
        (1, 1, "u2", "", "t2", "t3"),
        (1, 2, "u3", "", "t4", "t5"),
    ]
    short = spark.createDataFrame([("u1@wget_token@p@wget_token@@wget_token@\nu2",)], "blob string")
    assert [tuple(r) for r in frames(short, "blob").collect()] == [
        (0, "u1", "p", None, None),
        (1, "u2", None, None, None),
    ]
    other = spark.createDataFrame([("a.b|.*|c|.*||.*|\nd",)], "blob string")
    named = frames(other, "blob", ["x", "y"], token="|.*|")
    assert [tuple(r) for r in named.collect()] == [(0, "a.b", "c"), (1, "d", None)]


def test_string_arrays(spark):
    rows = spark.createDataFrame([("",), ("a b",), (" a  ",), (None,)], "s string")
    got = [r[0] for r in rows.select(string_to_array("s", " ")).collect()]
    assert got == [[], ["a", "b"], ["", "a", "", ""], None]
    arrays = spark.createDataFrame([(["a", None, "b"],), ([],), (None,)], "a array<string>")
    assert [r[0] for r in arrays.select(array_to_string("a", " ")).collect()] == ["a b", "", None]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_seconds(spark, kind):
    row = spark.sql(
        f"SELECT {kind}'2024-01-01 00:00:00.000001' AS a, {kind}'2024-01-02 00:00:00.5' AS b"
    ).select(seconds_between("a", "b"), seconds_between("b", "a"))
    assert tuple(row.first()) == (86400.499999, -86400.499999)


def test_report(spark):
    result = spark.sql(
        """SELECT * FROM VALUES
        (1L, 0.5D, 'x', timestamp'2024-01-01 00:00:01', 1.0D, 0),
        (1L, 0.5D, null, timestamp'2024-01-01 00:00:03.5', 2.0D, 1),
        (2L, 0.0D, 'y', timestamp'2024-01-01 00:00:09', null, 0)
        AS t(batch, batch_failrate, payload, ts_end, duration, retries)"""
    )
    one, two = batch_report(result).orderBy("batch").collect()
    assert (one.total_duration, one.avg_duration, one.max_duration, one.min_duration) == (2.5, 1.5, 2.0, 1.0)
    assert (one.retries, one["count"], one.count_ok, one.count_retried) == (1, 2, 1, 1)
    assert (two.total_duration, two.avg_duration, two["count"], two.count_ok) == (0.0, None, 1, 1)
    assert one.ts_start.second == 1


def test_save_table(spark):
    path = f"{RunStore(spark).root}/table"
    assert save_table(spark.range(5).selectExpr("id", "id % 2 AS p"), path, partition_by=["p"]).count() == 5
    assert save_table(spark.range(3).toDF("id"), path).count() == 3
    assert save_table(spark.range(4).toDF("id"), "t_saved").count() == 4
    assert save_table(spark.range(2).selectExpr("id", "'x' AS s"), "t_saved").columns == ["id", "s"]
    spark.sql("DROP TABLE t_saved")


def test_a_path_target_is_replaced_in_one_step(spark):
    path = f"{RunStore(spark).root}/versions"
    with pytest.raises(FileNotFoundError):
        load_table(spark, path)
    save_table(spark.range(5).toDF("i"), path)
    bad = spark.range(5).select(F.when(F.col("id") < 3, F.col("id")).otherwise(F.raise_error(F.lit("no"))).alias("i"))
    with pytest.raises(Exception, match="no"):
        save_table(bad, path)
    assert load_table(spark, path).count() == 5
    own = load_table(spark, path).where("i > 1")
    assert save_table(own, path).count() == 3
    assert sorted(r.i for r in load_table(spark, path).collect()) == [2, 3, 4]
    for n in range(4):  # old versions go, but for the one before
        save_table(spark.range(n).selectExpr("id AS i", "id % 2 AS p"), path, partition_by=["p"] if n == 2 else None)
    assert load_table(spark, path).count() == 3
    assert len([d for d in os.listdir(path) if d.startswith("version-")]) == 2


def test_framed_files_are_read_in_splits(spark, tmp_path):
    token = TOKEN
    records = [(f"http://a.com/{i}", "body @wget \n" * (i % 40) + f"é{i}", "s", "e") for i in range(3000)]
    text = "".join(token.join(r) + token * 2 + "\n" for r in records)
    (tmp_path / "log").write_text(text)
    usual = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(len(text.encode()) // 13))
    try:
        rows = frame_files(spark, str(tmp_path / "log"), file="file")
        assert rows.rdd.getNumPartitions() > 8
        assert sorted(tuple(r)[1:] for r in rows.collect()) == sorted(records)
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", usual)
    (tmp_path / "tail").write_text("u1" + token * 2 + "\nu2" + token + "open end")
    assert sorted(map(tuple, frame_files(spark, str(tmp_path / "tail")).select("url", "payload").collect())) == [
        ("u1", None),
        ("u2", "open end"),
    ]
    (tmp_path / "empty").write_text("")
    assert frame_files(spark, str(tmp_path / "empty")).collect() == []
