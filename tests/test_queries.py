"""Each registered query against its SQL."""

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from checks.compare import connect, difference
from checks.oracle import ORACLES
from checks.queries import QUERIES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert QUERIES.keys() == ORACLES.keys()
    assert oracle_sql().keys() <= queries().keys()


@pytest.mark.parametrize("name", list(oracle_sql()))
def test_query(spark, con, sf_dir, name):
    assert difference(spark, con, sf_dir, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    rows = entry(spark).collect()
    assert sum(r["count"] for r in rows) > 0


REPLAYS = "attempt_log batch_failrate batched_fetch fetch_report first_attempt ordered_result retry_rounds_3".split()


@pytest.fixture(scope="module")
def repeated(tmp_path_factory):
    """Pages whose URLs repeat, and the same pages with one answer a URL: the greatest that is not empty."""
    every, single = (str(tmp_path_factory.mktemp(n)) for n in ("every", "single"))
    rows = [(i, f"https://a.example.com/{i % 130}", f"<p>{i * 7919 % 211}</p>") for i in range(200)]
    rows += [(200 + i, f"https://a.example.com/{i}", html) for i in range(30) for html in ("", None)]
    rows += [(300 + i, f"https://b.example.com/{i}", html) for i in range(20) for html in ("", None)]
    rows += [(400 + i, None, "<p>none</p>") for i in range(3)] + rows[:9]
    con = duckdb.connect()
    con.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR, html VARCHAR)")
    con.executemany("INSERT INTO pages VALUES (?, ?, ?)", rows)
    con.execute(f"COPY pages TO '{every}/pages.parquet' (FORMAT parquet)")
    one = "SELECT min(page_id) AS page_id, url, max(html) AS html FROM pages WHERE url IS NOT NULL GROUP BY url"
    con.execute(f"COPY ({one}) TO '{single}/pages.parquet' (FORMAT parquet)")
    return every, connect(single)


@pytest.mark.parametrize("name", REPLAYS)
def test_urls_that_several_pages_have_are_answered_once(spark, repeated, name):
    every, single = repeated
    assert difference(spark, single, every, queries()[name], oracle_sql()[name]) is None
