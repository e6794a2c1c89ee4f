"""URL filter: host and path rules, then a blocked Bloom filter before an exact join.

DataFrame expressions only.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.frames import stored

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: A block of the Bloom filter has eight 64-bit words and is for 32 keys, 16 bits each. The filter is sized
#: by the list within these bounds: 16 MB at most, for 8 million keys; more keys let more through.
LEAST_BLOCKS, MOST_BLOCKS = 1 << 10, 1 << 18
KEYS_A_BLOCK = 32
WORDS = 8


def with_parts(pages: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host`` and ``path``; both empty for NULL or without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substr(F.col(url), F.instr(url, "://") + 3))
    host = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 1)
    path = F.regexp_extract(rest, r"^([^/?#]*)([^?#]*)", 2)
    empty = F.lit("")
    return pages.withColumns(
        {"host": F.coalesce(F.translate(host, UPPER, LOWER), empty), "path": F.coalesce(path, empty)}
    )


def canonical(url: Column, host: Column, path: Column) -> Column:
    """Canonical URL: host without a default port, path without closing slashes, sorted parameters.

    Scheme, fragment and tracking parameters (``utm_…``) don't count.
    """
    plain_host = F.regexp_replace(host, r":(80|443)$", "")
    plain_path = F.regexp_replace(path, r"/+$", "")
    query = F.regexp_extract(F.regexp_replace(url, r"(?s)#.*$", ""), r"(?s)\?(.*)$", 1)
    kept = F.filter(F.split(query, "&"), lambda p: (p != "") & ~p.startswith("utm_"))
    tail = F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(F.array_sort(kept), "&"))).otherwise("")
    return F.concat(plain_host, plain_path, tail)


def matching_rule(rules: Sequence[tuple[str, str]], host: Column, path: Column) -> tuple[Column, Column]:
    """Rule and verdict of the longest of ``(verdict, rule)`` that fits, NULL where none does.

    A rule ``host/path`` fits its host and all subdomains, with paths that start with
    the rule's. The rules are a short written policy, so they are part of the plan.
    """
    found, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for action, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        own_host, _, own_path = rule.partition("/")
        fits = ((host == own_host) | host.endswith("." + own_host)) & path.startswith("/" + own_path)
        found = F.when(fits, F.lit(rule)).otherwise(found)
        verdict = F.when(fits, F.lit(action)).otherwise(verdict)
    return found, verdict


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks)).cast("int")


def _masks(key: Column) -> list[Column]:
    """One bit in each of the words of the key's block."""
    second = F.xxhash64(key, F.lit("bits"))
    place = [F.shiftrightunsigned(second, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]
    return [F.call_function("shiftleft", F.lit(1).cast("long"), p) for p in place]


def blocks_for(keys: int) -> int:
    """Number of blocks, a power of two."""
    wanted = 1 << max(0, (keys - 1) // KEYS_A_BLOCK).bit_length()
    return min(max(wanted, LEAST_BLOCKS), MOST_BLOCKS)


def bloom_filter(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """The filter as a table: a row per used block, ``block, w0 … w7``; at most ``blocks`` rows."""
    masked = listed.select(
        _block(F.col(key), blocks).alias("block"), *[m.alias(f"w{i}") for i, m in enumerate(_masks(F.col(key)))]
    )
    return masked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def listed_keys(rows: DataFrame, listed: DataFrame, key: str, blocks: int | None = None) -> DataFrame:
    """``rows`` with ``listed`` (boolean): whether ``key`` is in the distinct column ``key`` of ``listed``.

    The Bloom filter is sized by the list up to a fixed bound and broadcast; it tests one block a row. Only
    rows that pass go into the exact join, which removes false positives. A longer
    list makes the filter let more through, never the result wrong. A NULL key is
    not listed.
    """
    blocks = blocks or blocks_for(listed.count())
    table = F.broadcast(bloom_filter(listed, key, blocks))
    probed = rows.withColumn("_block", _block(F.col(key), blocks)).join(
        table, F.col("_block") == table["block"], "left"
    )
    hit = reduce(
        lambda a, b: a & b,
        [F.coalesce(F.col(f"w{i}").bitwiseAND(m) != 0, F.lit(False)) for i, m in enumerate(_masks(F.col(key)))],
    )
    probed = probed.withColumn("_maybe", hit & F.col(key).isNotNull()).drop("block", "_block", *[f"w{i}" for i in range(WORDS)])
    exact = listed.select(F.col(key).alias("_key"), F.lit(True).alias("listed"))
    possible = probed.where("_maybe").join(exact, F.col(key) == F.col("_key"), "left").drop("_key")
    possible = possible.withColumn("listed", F.coalesce("listed", F.lit(False)))
    return possible.unionByName(probed.where("NOT _maybe").withColumn("listed", F.lit(False))).drop("_maybe")


def judged_urls(
    pages: DataFrame,
    listed_urls: DataFrame,
    rules: Sequence[tuple[str, str]],
    *,
    page_id: str = "page_id",
    url: str = "url",
    blocks: int | None = None,
) -> DataFrame:
    """``page_id, host, path, rule, verdict`` per row of ``pages``.

    The longest fitting rule decides; where none fits, a URL is blocked when its
    canonical form is that of a URL in ``listed_urls`` (column ``url``). Rows with a NULL
    URL or without ``://`` have empty host and path and are allowed. A listed URL with
    a third of all rows is one row of the list, and its pages a skewed join that
    adaptive execution splits. Repeated rows are judged each, URLs may be of any length, and no rows give none;
    other columns are not looked at.
    """
    rows = with_parts(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url")))
    whole = F.col("host") != ""
    key = F.when(whole, canonical(F.col("url"), F.col("host"), F.col("path")))
    rule, verdict = matching_rule(rules, F.col("host"), F.col("path"))
    rows = rows.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), key.alias("canonical"))
    listed = with_parts(listed_urls.select("url"))
    listed = stored(listed.where(whole).select(key.alias("canonical")).distinct())
    found = listed_keys(rows, listed, "canonical", blocks)
    final = F.coalesce("ruled", F.when(F.col("listed"), "block").otherwise("allow"))
    return found.select("page_id", "host", "path", "rule", final.alias("verdict"))
