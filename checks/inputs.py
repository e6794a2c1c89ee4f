"""Inputs derived from the tables, and the stub transport used without a network."""

from __future__ import annotations

import hashlib
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkloom.sources import url_template


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def page_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page URL, each of them twice, and a NULL per page."""
    pages = table(spark, sf_dir, "pages")
    return pages.select(F.explode(F.array("url", "url", F.lit(None))).alias("url"))


def url_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``page_id, kind, url``: each page URL in valid and broken forms."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rest = F.substring_index("url", "://", -1)
    parts = pages.select(
        "page_id",
        "url",
        F.substring_index("url", "://", 1).alias("scheme"),
        rest.alias("rest"),
        F.regexp_extract(rest, "^[^/?#]*", 0).alias("host"),
    ).withColumn("tail", F.expr("substring(rest, length(host) + 1)"))

    def built(*pieces: str):
        return F.concat(
            *[F.col(p) if p in ("scheme", "rest", "host", "tail", "url") else F.lit(p) for p in pieces]
        )

    variants = {
        "as_is": F.col("url"),
        "upper": F.upper("url"),
        "port": built("scheme", "://", "host", ":8080", "tail"),
        "userinfo": built("scheme", "://me:pw@", "host", "tail"),
        "top_dot": built("scheme", "://", "host", ".", "tail"),
        "at_in_path": built("http://10.0.0.1/@", "host"),
        "short_port": built("scheme", "://", "host", ":8", "tail"),
        "long_port": built("scheme", "://", "host", ":123456", "tail"),
        "other_scheme": built("gopher://", "rest"),
        "no_scheme": built("rest"),
        "space": built("url", " x"),
        "newline": built("url", "\n"),
        "hyphen_host": built("scheme", "://-", "host", "tail"),
        "hyphen_label": built("scheme", "://a.-", "host", "tail"),
        "empty_label": built("scheme", "://a..", "host", "tail"),
        "digit_tld": built("scheme", "://", "host", ".c0m", "tail"),
        "two_dots": built("scheme", "://", "host", "..", "tail"),
        "null": F.lit(None).cast("string"),
    }
    forms = [F.struct(F.lit(k).alias("kind"), v.alias("url")) for k, v in variants.items()]
    return parts.select("page_id", F.inline(F.array(*forms)))


def ipv4_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, url``: dotted addresses over all public and reserved ranges."""
    octets = """concat_ws('.',
      element_at(array(10, 127, 169, 172, 192, 0, 224, 255, 1, 223, 100, 8), cast(o_orderkey % 12 as int) + 1),
      case o_orderkey % 5 when 0 then 168 when 1 then 254
                          when 2 then 14 + o_orderkey div 12 % 20 else o_orderkey div 12 % 256 end,
      o_orderkey div 7 % 256,
      o_orderkey div 3 % 256)"""
    keyed = table(spark, sf_dir, "orders").select("o_orderkey", F.expr(octets).alias("address"))
    return url_template(keyed, "address", "http://%s").drop("address")


def order_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, urls``: arrays with NULLs, bad URLs, no elements, no array."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "case when o_orderkey % 5 > 0 then concat('https://a.example.com/', o_orderkey) end as one",
        "case when o_orderkey % 7 = 0 then 'http://10.0.0.1/' "
        "when o_orderkey % 7 > 1 then concat('ftp://b.example.org/', o_custkey) end as two",
    ).selectExpr(
        "o_orderkey",
        "case o_orderkey % 4 when 0 then cast(array() as array<string>) when 1 then array(one) "
        "when 2 then array(one, two) else if(o_orderkey % 3 = 0, null, array(two, one, two)) end as urls",
    )


def order_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``o_orderkey, shlist``: space-separated lists, well formed and not."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey",
        "concat('https://a.example.com/', o_orderkey) as one",
        "concat('ftp://b.example.org/', o_custkey) as two",
    ).selectExpr(
        "o_orderkey",
        "case o_orderkey % 7 when 0 then '' when 1 then null when 2 then concat(one, ' ', two) "
        "when 3 then concat(one, '  ', two) when 4 then concat(' ', one) "
        "when 5 then concat(one, '\\t', two) "
        "else array_join(array(one, null, if(o_orderkey % 2 = 0, 'http://.', two)), ' ') end as shlist",
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events as an attempt log; batches of 800, some times missing."""
    return table(spark, sf_dir, "events").selectExpr(
        "concat('https://e.example.com/', event_id) as url",
        "if(event_type = 'error', null, props) as payload",
        "if(event_id % 3 = 0, null, timestampadd(MILLISECOND, -(event_id % 900), ts)) as ts_start",
        "if(event_id % 50 = 0, null, ts) as ts_end",
        "event_id div 800 + 1 as batch",
        "cast(event_id % 7 % 2 as int) as retries",
    )


def recorded(answers: DataFrame, payload: str, per_mille: int, attempts: int = 1) -> DataFrame:
    """``answers`` as a log of ``attempts`` attempts, in which those that ``StubTransport`` fails are empty."""
    log = answers.withColumn("attempt", F.explode(F.sequence(F.lit(0), F.lit(attempts - 1))))
    digest = F.md5(F.concat("url", F.lit("#"), F.col("attempt").cast("string")))
    draw = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % 1001
    return log.withColumn(payload, F.when(draw >= per_mille, F.col(payload)))


def event_answers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``url, attempt, payload, ts_start, ts_end``: the events as four attempts a URL.

    Errors and sign-ups are empty answers, with their times; some have no start or no end.
    """
    return table(spark, sf_dir, "events").selectExpr(
        "concat('https://e.example.com/', event_id div 4) as url",
        "cast(event_id % 4 as int) as attempt",
        "case event_type when 'error' then null when 'signup' then '' else props end as payload",
        "if(event_id % 3 = 0, null, timestampadd(MILLISECOND, -(event_id % 900), ts)) as ts_start",
        "if(event_id % 50 = 0, null, ts) as ts_end",
    )


@dataclass(frozen=True)
class StubTransport:
    """Answers ``body of <url>``, or fails by a hash of URL and attempt, ``per_mille`` of 1001 requests."""

    per_mille: int = 0

    def __call__(self, url, attempt, settings):
        draw = int(hashlib.md5(f"{url}#{attempt}".encode()).hexdigest()[:8], 16) % 1001
        return None if draw < self.per_mille else f"body of {url}".encode()
