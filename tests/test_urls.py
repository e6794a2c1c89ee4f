"""The URL predicates, the array and list forms, and rejection reasons."""

import random
import re

import pytest
from pyspark.sql import functions as F
from url_cases import INVALID, KNOWN_GAPS, VALID

from checks.oracle import RE2_URL
from linkloom.functions import is_url, is_url_array, is_url_shlist, reject_reason
from linkloom.plans import register_sql
from linkloom.sources import url_list

GOOD, BAD = "https://a.example.com/x", "http://."

OWN_CASES = [
    ("http://a.com\n", False),
    ("http://10.0.0.1/@example.com", True),
    ("http://user@10.0.0.1", False),
    ("http://localhost", False),
    ("http://\U0001F600.com", False),
    ("http://a.com/\U0001F600", True),
    ("http://a.com:1", False),
    ("http://a.com:12", True),
    ("http://a.com:123456", False),
    ("HTTPS://A.COM", True),
    ("http://xn--fiqs8s.com", True),
    ("http://a.com./x", True),
    ("http://a.com../x", False),
    ("http://a.com\u00a0", False),
    ("http://a.com/\u00a0", True),
    ("http://172.15.0.1", True),
    ("http://172.16.0.1", False),
    ("http://172.31.0.1", False),
    ("http://172.32.0.1", True),
    ("http://1.01.001.1", False),
    ("http://1.01.99.1", True),
]


def test_cases(spark):
    cases = [(u, True) for u in VALID + KNOWN_GAPS] + [(u, False) for u in INVALID] + OWN_CASES
    assert len(VALID) + len(INVALID) + len(KNOWN_GAPS) == 74
    rows = spark.createDataFrame(cases, "url string, want boolean")
    wrong = rows.where(~is_url("url").eqNullSafe(F.col("want"))).collect()
    assert wrong == []
    reasons = rows.where(reject_reason("url").isNull() != F.col("want")).collect()
    assert reasons == []


def test_strict_closes_the_gaps(spark):
    gaps = KNOWN_GAPS + ["http://10.0.0.1/@example.com", "http://a.com./x"]
    assert not url_list(spark, gaps).where(is_url("url", strict=True)).count()
    kept = VALID + ["http://xn--fiqs8s.com", "http://a-b.c-d-e.com"]
    assert url_list(spark, kept).where(is_url("url", strict=True)).count() == len(kept)
    assert not url_list(spark, INVALID).where(is_url("url", strict=True)).count()


def test_null(spark):
    row = url_list(spark, [None]).select(is_url("url"), is_url("url", True), reject_reason("url")).first()
    assert tuple(row) == (None, None, "null")


@pytest.mark.parametrize("strict", [False, True])
def test_long_hostile_texts_do_not_overflow_the_stack(spark, strict):
    cases = [
        ("http://" + "a" * 200_000 + ".com", True),
        ("http://" + "a." * 200_000 + "com", True),
        ("http://" + "a-" * 5_000 + ".com", False),
        ("http://" + "a." * 200_000 + "c1", False),
        ("http://" + "a@" * 100_000 + "x.com", True),
        ("http://" + "a.b@" * 100_000 + "x", False),
        ("http://" + "a-b" * 60_000 + ".com", True),
        ("http://a.com/" + "x" * 500_000, True),
        ("http://a.com/" + "x" * 500_000 + " ", False),
    ]
    rows = spark.createDataFrame(cases, "url string, want boolean")
    got = rows.select("want", is_url("url", strict).alias("got"), reject_reason("url").alias("r")).collect()
    assert [r.got for r in got] == [r.want for r in got]
    assert [r.r is None for r in got] == [r.want for r in got]


def _is_label(text):
    def letter(c):
        return (c.isascii() and c.isalnum()) or "\u00a1" <= c <= "\uffff"

    return (
        text != ""
        and all(letter(c) or c == "-" for c in text)
        and text[0] != "-"
        and text[-1] != "-"
    )


def _is_public_address(host):
    parts = host.split(".")
    if len(parts) != 4 or not all(re.fullmatch("[0-9]{1,3}", p) for p in parts):
        return False
    if any(len(p) == 3 and p[0] == "0" for p in parts) or parts[0][0] == "0" or parts[3][0] == "0":
        return False
    a, b, c, d = map(int, parts)
    private = a in (10, 127) or (a, b) in ((169, 254), (192, 168)) or (a == 172 and 16 <= b <= 31)
    # A leading zero keeps an octet from reading as part of a private network.
    if private and a not in (10, 127) and parts[1] != str(b):
        private = False
    return 1 <= a <= 223 and b <= 255 and c <= 255 and 1 <= d <= 254 and not private


def _is_host(host):
    labels = host.removesuffix(".").split(".")
    tld = labels[-1]
    return (
        len(labels) > 1
        and all(map(_is_label, labels))
        and len(tld) >= 2
        and not any(c in "0123456789-" for c in tld)
    )


def by_hand(url):
    """The grammar as a hand-written parser, for comparison."""
    m = re.match("(?:https?|ftp)://", url, re.IGNORECASE | re.ASCII)
    if not m:
        return False
    rest, space = url[m.end() :], re.compile("[ \t\n\x0b\f\r]")
    starts = [0] + [
        i + 1 for i, c in enumerate(rest) if c == "@" and i > 0 and not space.search(rest[:i])
    ]
    for start in starts:
        host, tail = re.match("([^:/?#]*)(.*)", rest[start:], re.DOTALL).groups()
        m = re.match(r":[0-9]{2,5}", tail)
        tail = tail[m.end() :] if m else tail
        if tail and (tail[0] not in "/?#" or space.search(tail)):
            continue
        if _is_public_address(host) or _is_host(host):
            return True
    return False


def _random_urls(count):
    draw = random.Random(7)
    pieces = "a b z 0 1 9 - -- . .. : :80 :1 / ? # @ 10 127 169.254 192.168 172.16 172.33 8.8 254 255 256 " \
        "01 001 com co m.x é \u00a0 \u00a1 ➡ \U0001F600 %20 _ ~ é.fr xn--a 1.1 http:// u:p@ a@".split(" ")
    pieces += [" ", "\n", "\t", "\u2028", "\x1c"]
    schemes = ["http://", "https://", "ftp://", "HTTP://", "fTp://", "ftps://", "http:/", ""]
    for _ in range(count):
        yield draw.choice(schemes) + "".join(draw.choices(pieces, k=draw.randint(0, 7)))
    octets = ["0", "1", "01", "9", "10", "16", "31", "100", "127", "168", "169", "172", "192", "199"]
    octets += ["200", "223", "224", "249", "250", "253", "254", "255", "256", "001", "1000"]
    for _ in range(count):
        yield "http://" + ".".join(draw.choices(octets, k=draw.choice([4, 4, 4, 4, 3, 5])))


def test_against_a_hand_written_parser_and_re2(spark):
    import duckdb
    import pandas as pd

    urls = sorted(set(_random_urls(6_000)))
    got = {r.url: r for r in url_list(spark, urls).select(
        "url", is_url("url").alias("ok"), is_url("url", True).alias("strict"), reject_reason("url").alias("r")
    ).collect()}
    assert len(got) == len(urls)
    want = {u: by_hand(u) for u in urls}
    assert sum(want.values()) > 500
    assert [u for u in urls if got[u].ok != want[u]] == []
    assert [u for u in urls if (got[u].r is None) != want[u]] == []
    assert [u for u in urls if got[u].strict and not got[u].ok] == []
    frame = pd.DataFrame({"u": urls})
    con = duckdb.connect()
    con.register("frame", frame)
    re2 = con.execute(f"SELECT u, regexp_matches(u, '{RE2_URL}') FROM frame").fetchall()
    assert [u for u, ok in re2 if ok != want[u]] == []


ARRAYS = [
    ([GOOD, GOOD], True, True),
    ([GOOD, BAD], False, False),
    ([GOOD, None], True, True),
    ([BAD, None], False, False),
    ([None], None, True),
    ([], None, True),
    (None, None, False),
]
LISTS = [
    (f"{GOOD} {GOOD}", True, True),
    (f"{GOOD}  {GOOD}", False, False),
    (f" {GOOD}", False, False),
    (f"{GOOD} ", False, False),
    (f"{GOOD}\t{GOOD}", False, False),
    (GOOD, True, True),
    (" ", False, False),
    ("", None, True),
    (None, None, False),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_arrays_and_lists(spark, ansi):
    from linkloom.operators import enforce_url_array, enforce_url_shlist

    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        arrays = spark.createDataFrame(ARRAYS, "a array<string>, want boolean, ok boolean")
        lists = spark.createDataFrame(LISTS, "s string, want boolean, ok boolean")
        assert not arrays.where(~is_url_array("a").eqNullSafe(F.col("want"))).collect()
        assert not lists.where(~is_url_shlist("s").eqNullSafe(F.col("want"))).collect()
        assert not enforce_url_array(arrays, "a", "flag").where("valid <> ok").collect()
        assert not enforce_url_shlist(lists, "s", "flag").where("valid <> ok").collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", "true")


def test_sql_names(spark):
    register_sql(spark)
    spark.createDataFrame(ARRAYS, "a array<string>, want boolean, ok boolean").createOrReplaceTempView("t_a")
    spark.createDataFrame(LISTS, "s string, want boolean, ok boolean").createOrReplaceTempView("t_s")
    assert not spark.sql("SELECT * FROM t_a WHERE NOT (is_url_array(a) <=> want)").collect()
    assert not spark.sql("SELECT * FROM t_s WHERE NOT (is_url_shlist(s) <=> want)").collect()
    every = VALID + KNOWN_GAPS + INVALID + [u for u, _ in OWN_CASES] + [None]
    url_list(spark, every).createOrReplaceTempView("t_u")
    by_sql = spark.sql("SELECT url, is_url(url) AS ok FROM t_u").collect()
    by_column = spark.table("t_u").select("url", is_url("url").alias("ok")).collect()
    assert by_sql == by_column
    register_sql(spark, names={"is_url": "looks_like_url"})
    assert spark.sql(f"SELECT looks_like_url('{GOOD}')").first()[0] is True


def test_sql_casts(spark):
    register_sql(spark)
    assert spark.sql(f"SELECT as_url('{GOOD}')").first()[0] == GOOD
    assert spark.sql("SELECT as_url_array(array()), as_url_shlist('')").first()[1] == ""
    for call, state in [
        (f"as_url('{BAD}')", "23514"),
        ("as_url(NULL)", "23502"),
        (f"as_url_array(array('{GOOD}', '{BAD}'))", "23514"),
        (f"as_url_shlist('{GOOD}  {GOOD}')", "23514"),
        ("as_url_shlist(NULL)", "23502"),
    ]:
        with pytest.raises(Exception, match=state):
            spark.sql(f"SELECT {call}").collect()
    url_list(spark, [GOOD, BAD]).createOrReplaceTempView("t_mixed")
    register_sql(spark, source_view="t_mixed")
    with pytest.raises(Exception, match="23514"):
        spark.sql("SELECT * FROM url_batches()").collect()
