"""What must raise: malformed literals, other schemes, bad URLs, runs about something else."""

import pytest
from pyspark.sql import functions as F

from checks.inputs import StubTransport
from linkloom.functions import array_literal
from linkloom.functions.urls import is_url_text
from linkloom.operators import AttemptSettings, FetchPolicy, fetch
from linkloom.plans import fetch_batches, register_sql
from linkloom.sources import HttpTransport, save_table
from url_cases import INVALID, KNOWN_GAPS, VALID


@pytest.mark.parametrize(
    "text", ["abc", '{a,"b', "{a,b", "{a,b}x", '{a"b,c}', "{a,,b}", "{{a,b},{c,d}}", "{a,}", "{a, ,b}"]
)
def test_malformed_literals_raise(spark, text):
    frame = spark.createDataFrame([(text,)], "x string").select(array_literal("x").alias("a"))
    with pytest.raises(Exception, match="22P02"):
        frame.collect()


def test_whole_literals(spark):
    rows = ['{a,"b,c",NULL}', "{}", "{ }", '{"",x}', '{"\\"q\\""}', None, "{a" + ",a" * 20000 + "}"]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(rows)], "i int, x string")
    got = [r["a"] for r in frame.select("i", array_literal("x").alias("a")).orderBy("i").collect()]
    assert got[:6] == [["a", "b,c", None], [], [], ["", "x"], ['"q"'], None]
    assert len(got[6]) == 20001


@pytest.mark.parametrize("url", ["file:///etc/hostname", "FILE:///etc/hostname", "data:text/plain,x", "x"])
def test_other_schemes_are_not_opened(url):
    assert HttpTransport()(url, 0, AttemptSettings()) is None


def test_fetch_checks_urls(spark):
    frame = spark.createDataFrame([("file:///etc/hostname",), ("http://a.com/",), (None,)], "url string")
    with pytest.raises(Exception, match="23514"):
        fetch(frame, "url", StubTransport()).collect()
    got = {r["url"]: r["payload"] for r in fetch(frame, "url", StubTransport(), on_invalid="skip").collect()}
    assert got == {"file:///etc/hostname": None, "http://a.com/": "body of http://a.com/", None: None}


def test_sql_fetch_checks_urls(spark):
    register_sql(spark, StubTransport())
    for call in ("fetch_url('not a url')", "fetch_list('http://a.com file:///x')"):
        with pytest.raises(Exception, match="23514"):
            spark.sql(f"SELECT * FROM {call}").collect()


def test_a_run_keeps_to_its_input_and_policy(spark):
    one, two = (spark.createDataFrame([(f"http://{h}.com/",)], "url string") for h in "ab")
    first = fetch_batches(one, StubTransport(), run_id="guarded").count()
    assert fetch_batches(one, StubTransport(), run_id="guarded").count() == first == 1
    with pytest.raises(ValueError, match="another input"):
        fetch_batches(two, StubTransport(), run_id="guarded")
    with pytest.raises(ValueError, match="another policy"):
        fetch_batches(one, StubTransport(), FetchPolicy(batch_size=3), run_id="guarded")


def test_fetch_spreads(spark):
    frame = spark.range(100).select(F.concat(F.lit("http://a.com/"), "id").alias("url")).coalesce(1)
    parts = fetch(frame, "url", StubTransport()).select(F.spark_partition_id().alias("p")).distinct()
    assert parts.count() > 1


def test_url_test_of_single_values(spark):
    texts = [*VALID, *INVALID, *KNOWN_GAPS]
    want = spark.createDataFrame([(t,) for t in texts], "x string")
    from linkloom.functions import is_url

    got = {r["x"]: r["ok"] for r in want.select("x", is_url("x").alias("ok")).collect()}
    assert all(is_url_text(t) == got[t] for t in texts)


def test_save_table_may_read_its_target(spark):
    save_table(spark.range(3).toDF("i"), "guard_target")
    assert save_table(spark.table("guard_target").where("i > 0"), "guard_target").count() == 2
    spark.sql("DROP TABLE guard_target")
