"""URL sources, distinct URLs and batch numbers."""

import hashlib

import pytest
from pyspark.sql import functions as F

from linkloom.functions import array_literal
from linkloom.operators import FetchPolicy, batch_arrays, distinct_urls, number_batches
from linkloom.plans import register_sql
from linkloom.sources import unnest_urls, url_list, url_range, url_template


def test_range_template(spark):
    urls = url_range(spark, 20_001, 30_000, "https://api.example.com/item/%s.json")
    assert urls.count() == 10_000
    assert urls.orderBy("id").first().url == "https://api.example.com/item/20001.json"
    assert url_range(spark, 1, 2000, "http://x.example.com/?q=%s").agg(F.max("id")).first()[0] == 2000
    keyed = spark.createDataFrame([("a",), (None,)], "k string")
    assert [r.url for r in url_template(keyed, "k", "http://x.com/%s").collect()][0] == "http://x.com/a"


def test_unnest_and_literal(spark):
    arrays = spark.createDataFrame([(["a", None],), ([],), (None,)], "urls array<string>")
    assert sorted(unnest_urls(arrays, "urls").collect(), key=str) == [("a",), (None,)]
    literals = [
        ("{}", []),
        ("{ a , b }", ["a", "b"]),
        ('{"a,b",null,"NULL", "q\\"x\\\\y"}', ["a,b", None, "NULL", 'q"x\\y']),
        ("{\n http://a.com/1,\n http://a.com/2\n}", ["http://a.com/1", "http://a.com/2"]),
    ]
    rows = spark.createDataFrame(literals, "s string, want array<string>")
    for row in rows.select("want", array_literal("s").alias("got")).collect():
        assert row.got == row.want


def expected_batches(urls, size):
    ordered = sorted(set(urls) - {None}, key=lambda u: (hashlib.md5(u.encode()).hexdigest(), u))
    return {u: i // size + 1 for i, u in enumerate(ordered)}


@pytest.mark.parametrize("count,size", [(0, 10), (1, 1), (5, 2), (997, 40), (997, 2000), (3000, 1)])
def test_numbers_equal_a_global_row_number(spark, count, size):
    urls = [f"https://h{i % 7}.example.com/{i}" for i in range(count)]
    # one URL fills half of the input
    frame = url_list(spark, urls + [None] + ["https://popular.example.com/"] * count)
    got = {r.url: r.batch for r in number_batches(distinct_urls(frame), size).collect()}
    assert got == expected_batches(urls + ["https://popular.example.com/"] * bool(count), size)


@pytest.mark.parametrize("partitions", ["1", "3", "200"])
@pytest.mark.parametrize("adaptive", ["true", "false"])
def test_numbers_do_not_depend_on_the_layout(spark, partitions, adaptive):
    urls = [f"https://h{i % 7}.example.com/{i}" for i in range(2000)]
    usual = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    spark.conf.set("spark.sql.adaptive.enabled", adaptive)
    try:
        numbered = number_batches(distinct_urls(url_list(spark, urls).repartition(5)), 64)
        got = {r.url: r.batch for r in numbered.collect()}
        kept = {r.url: r.batch for r in numbered.where("batch = 3").collect()}
        counts = {r.batch: r["count"] for r in numbered.groupBy("batch").count().collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", usual)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    want = expected_batches(urls, 64)
    assert got == want
    assert kept == {u: b for u, b in want.items() if b == 3}
    assert all(n == 64 for b, n in counts.items() if b < max(counts))


def test_batches_are_full_but_for_the_last(spark):
    numbered = number_batches(distinct_urls(url_range(spark, 1, 1234, "http://a.com/%s")), 100)
    sizes = [r["count"] for r in numbered.groupBy("batch").count().orderBy("batch").collect()]
    assert sizes == [100] * 12 + [34]
    arrays = batch_arrays(numbered).orderBy("batch").collect()
    assert [len(r.urls) for r in arrays] == sizes
    assert all(r.urls == sorted(r.urls) for r in arrays)


def test_other_columns_travel_along(spark):
    frame = spark.createDataFrame([(f"http://a.com/{i}", i) for i in range(50)], "url string, n int")
    numbered = number_batches(frame, 10)
    assert numbered.columns == ["url", "n", "batch"]
    assert numbered.where("url <> concat('http://a.com/', n)").count() == 0


def test_plan_has_one_bounded_single_task_step(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    frame = number_batches(distinct_urls(pages), 40)
    frame.collect()
    plan = frame._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    final = plan.split("== Initial Plan ==")[0]
    # rows meet in one task only as counts per hash bucket
    assert final.count("SinglePartition") == 1
    single = final[final.index("SinglePartition") :].split("\n")[1]
    assert "count(1)" in single
    # the table is read and reduced to distinct URLs once
    assert final.count("FileScan") == 1 and "ReusedExchange" in final
    assert "ReadSchema: struct<url:string>" in final


def test_sql_batches_equal_the_operator(spark):
    frame = url_list(spark, [f"http://a.com/{i % 90}" for i in range(200)] + [None])
    frame.createOrReplaceTempView("t_requested")
    register_sql(spark, source_view="t_requested")
    by_sql = spark.sql("SELECT * FROM url_batches(batch_size => 7)").collect()
    assert sorted(by_sql) == sorted(number_batches(distinct_urls(frame), 7).collect())
    assert spark.sql("SELECT max(batch) FROM url_batches()").first()[0] == 1


def test_policy_defaults():
    policy = FetchPolicy()
    assert (policy.batch_size, policy.batch_retries, policy.batch_retries_failrate) == (2000, 1, 0.05)
    for attempt in (policy.initial, policy.retry):
        assert (attempt.min_latency, attempt.timeout, attempt.tries) == (0, 5, 1)
        assert (attempt.waitretry, attempt.parallel_jobs, attempt.delay) == (0, 10, 0)
    with pytest.raises(ValueError):
        FetchPolicy(batch_size=0)
