"""Constrained columns."""

import pytest
from pyspark.errors import PySparkException

from linkloom.operators import (
    FetchPolicy,
    all_urls,
    enforce_url,
    enforce_url_array,
    reject_counts,
)
from linkloom.plans import fetch_batches
from linkloom.sources import Snapshot, url_list

GOOD, BAD = "https://a.example.com/x", "http://."


def test_fail_raises_even_when_the_column_is_not_used(spark):
    with pytest.raises(PySparkException, match="23514"):
        enforce_url(url_list(spark, [GOOD, BAD])).count()
    with pytest.raises(PySparkException, match="23502"):
        enforce_url(url_list(spark, [GOOD, None])).count()
    assert enforce_url(url_list(spark, [GOOD, GOOD])).count() == 2
    with pytest.raises(PySparkException, match="23514"):
        arrays = spark.createDataFrame([([GOOD, BAD],)], "a array<string>")
        enforce_url_array(arrays, "a").count()
    with pytest.raises(PySparkException, match="23502"):
        enforce_url_array(spark.createDataFrame([(None,)], "a array<string>"), "a").count()


def test_fail_tests_only_rows_that_an_earlier_filter_keeps(spark):
    urls = url_list(spark, [GOOD, BAD])
    assert enforce_url(urls.where("url like 'https%'")).count() == 1


def test_quarantine_and_drop(spark):
    urls = url_list(spark, [GOOD, BAD, None])
    good, bad = enforce_url(urls, mode="quarantine")
    assert [r.url for r in good.collect()] == [GOOD]
    assert {r.url for r in bad.collect()} == {BAD, None}
    assert [r.url for r in enforce_url(urls, mode="drop").collect()] == [GOOD]
    assert {(r.url, r.valid) for r in enforce_url(urls, mode="flag").collect()} == {
        (GOOD, True),
        (BAD, False),
        (None, False),
    }
    with pytest.raises(ValueError):
        enforce_url(urls, mode="other")


def test_the_check_stays_on_its_side_of_a_join(spark):
    pages = spark.createDataFrame([(GOOD, "x"), ("not a url", "y")], "url string, payload string")
    for unique in (True, False):
        result = fetch_batches(url_list(spark, [GOOD]), Snapshot(pages, unique=unique), FetchPolicy())
        assert [(r.url, r.payload) for r in result.collect()] == [(GOOD, "x")]
    with pytest.raises(Exception, match="23514"):
        fetch_batches(url_list(spark, [GOOD, BAD]), Snapshot(pages)).collect()
    kept = fetch_batches(url_list(spark, [GOOD, BAD]), Snapshot(pages), on_invalid="drop")
    assert kept.count() == 1


def test_all_urls_over_rows(spark):
    rows = spark.createDataFrame(
        [(1, GOOD), (1, None), (2, GOOD), (2, BAD), (3, None)], "g int, url string"
    )
    assert {tuple(r) for r in all_urls(rows, ["g"]).collect()} == {(1, True), (2, False), (3, None)}


def test_reject_counts(spark):
    rows = url_list(spark, [GOOD, BAD, BAD, None, "gopher://x.com", "http://10.0.0.1"])
    assert {tuple(r) for r in reject_counts(rows).collect()} == {
        ("host", 2),
        ("null", 1),
        ("scheme", 1),
        ("private_ipv4", 1),
    }
