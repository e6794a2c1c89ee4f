"""The functions under SQL names."""

from __future__ import annotations

import time
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

from linkloom.functions.json_payload import NUMBER, TOKENS, VALUE
from linkloom.functions.urls import URL_PATTERN, is_url_text
from linkloom.operators.enforce import CHECK_VIOLATION, NOT_NULL_VIOLATION
from linkloom.operators.fetch import Transport, fetch_concurrently, requester
from linkloom.operators.policy import AttemptSettings, FetchPolicy
from linkloom.operators.rounds import BatchRounds, Schedule
from linkloom.sources.http import HttpTransport

RESULT_COLUMNS = (
    "url string, payload string, ts_end timestamp, duration double, "
    "batch bigint, retries int, batch_failrate double"
)

# The batch plan of operators.batching; a batch also knows how many URLs it has.
_NUMBERED = """
  urls AS (
    SELECT url, coalesce(substring(md5(url), 1, 4), '') AS bucket
    FROM (SELECT DISTINCT {checked} AS url FROM {source} WHERE url IS NOT NULL)
  ), sizes AS (
    SELECT bucket, count(*) AS n FROM urls GROUP BY bucket
  ), offsets AS (
    SELECT bucket, sum(n) OVER (ORDER BY bucket) - n AS before, sum(n) OVER () AS total FROM sizes
  ), placed AS (
    SELECT /*+ BROADCAST(offsets) */ url, total, before +
      row_number() OVER (PARTITION BY bucket ORDER BY md5(url), url) AS at
    FROM urls JOIN offsets USING (bucket)
  ), numbered AS (
    SELECT url, (at - 1) div batch_size + 1 AS batch,
      least(batch_size, total - (at - 1) div batch_size * batch_size) AS batch_urls,
      (total - 1) div batch_size + 1 AS batches
    FROM placed
  )
"""

_BATCHES = (
    """
CREATE OR REPLACE TEMPORARY FUNCTION {name}(batch_size INT DEFAULT 2000)
RETURNS TABLE(url STRING, batch BIGINT)
RETURN WITH"""
    + _NUMBERED
    + "SELECT url, batch FROM numbered"
)

# Settings of a fetch and their defaults, in the order of the SQL arguments.
_ATTEMPT = {
    "min_latency": "DOUBLE DEFAULT 0",
    "timeout": "DOUBLE DEFAULT 5",
    "tries": "INT DEFAULT 1",
    "waitretry": "DOUBLE DEFAULT 0",
    "parallel_jobs": "INT DEFAULT 10",
    "delay": "DOUBLE DEFAULT 0",
}
_SETTINGS = {
    **{f"{kind}_{name}": default for kind in "ir" for name, default in _ATTEMPT.items()},
    "batch_retries": "INT DEFAULT 1",
    "batch_retries_failrate": "DOUBLE DEFAULT 0.05",
    "whole_job": "BOOLEAN DEFAULT FALSE",
}

# Few bytes go through the exchange before the requests, which adaptive execution would merge into
# one task; a number of ranges that is asked for stays as it is. Each slot has an equal share of the batches, and
# with limits for the whole job there are no more slots than requests may be in flight.
# The fail rate stands on one row of a batch at least and is spread over the others at the end.
_FETCH = (
    """
CREATE OR REPLACE TEMPORARY FUNCTION {name}({urls}{arguments}, batch_size INT DEFAULT 2000)
RETURNS TABLE({columns})
RETURN WITH"""
    + _NUMBERED
    + """, placed_batches AS (
    SELECT url, batch, batch_urls, batches, named_struct({settings}) AS given, {began} AS began,
      CASE WHEN whole_job THEN greatest(1, least({tasks}, i_parallel_jobs, r_parallel_jobs)) ELSE {tasks} END AS slots
    FROM numbered
  ), dealt AS (
    SELECT /*+ REPARTITION_BY_RANGE({tasks}, slot) */ url, batch, batch_urls, slot,
      named_struct({kept}, 'tasks', slots, 'slot', slot, 'began', began) AS settings
    FROM (SELECT *, cast((batch - 1) * slots div batches AS INT) AS slot FROM placed_batches)
  ), requests AS (
    SELECT * FROM dealt SORT BY slot, batch, url
  )
  SELECT url, payload, ts_end, duration, batch, retries,
    max(batch_failrate) OVER (PARTITION BY batch) AS batch_failrate
  FROM (SELECT f.* FROM requests, LATERAL {fetch}(requests.url, requests.batch, batch_urls, settings) AS f)
"""
)


def _require_urls(urls) -> None:
    for url in urls:
        if url is None:
            raise ValueError(f"{NOT_NULL_VIOLATION} url: NULL")
        if not is_url_text(url):
            raise ValueError(f"{CHECK_VIOLATION} url: not a URL: {url[:200]!r}")


def _fetch_one(transport: Transport):
    @udtf(returnType="payload string")
    class FetchOne:
        def eval(self, url, min_latency=0.0, timeout=5.0, tries=1, waitretry=0.0):
            _require_urls([url])
            settings = AttemptSettings(float(min_latency), float(timeout), tries, float(waitretry), 1)
            with ThreadPoolExecutor(1) as pool:
                one = [(None, url)]
                for _, _, payload, _, _ in fetch_concurrently(one, transport, 0, settings, pool):
                    yield (payload,)

    return FetchOne


def _fetch_list(transport: Transport):
    @udtf(returnType="url string, payload string, ts_start timestamp, ts_end timestamp")
    class FetchList:
        def eval(
            self,
            url_shlist,
            min_latency=0.0,
            timeout=5.0,
            tries=1,
            waitretry=0.0,
            parallel_jobs=10,
            delay=0.0,
        ):
            if not url_shlist:
                return
            settings = AttemptSettings(
                float(min_latency), float(timeout), tries, float(waitretry), parallel_jobs, float(delay)
            )
            _require_urls(url_shlist.split(" "))
            time.sleep(settings.delay)
            with ThreadPoolExecutor(max(1, parallel_jobs)) as pool:
                listed = ((None, url) for url in url_shlist.split(" "))
                for answer in fetch_concurrently(listed, transport, 0, settings, pool):
                    yield answer[1:]

    return FetchList


def _policy(settings) -> FetchPolicy:
    one, two = (AttemptSettings(**{name: settings[f"{kind}_{name}"] for name in _ATTEMPT}) for kind in "ir")
    return FetchPolicy(
        one,
        two,
        batch_retries=settings["batch_retries"],
        batch_retries_failrate=settings["batch_retries_failrate"],
    )


def _fetch_batch(transport: Transport):
    @udtf(returnType=RESULT_COLUMNS)
    class FetchBatch:
        """Takes the URLs of whole batches, one a call, and gives answers as they come.

        Those of a batch must stand together, which the SQL functions see to and ``batch_urls`` proves.
        """

        def __init__(self):
            self.rounds, self.batch, self.left = None, None, 0

        def eval(self, url, batch, batch_urls, settings):
            _require_urls([url])
            if self.rounds is None:
                policy = _policy(settings)
                schedule = None
                if settings["whole_job"]:
                    schedule = Schedule.of(policy, settings["tasks"])
                    schedule = schedule._replace(began=settings["began"], slot=settings["slot"])
                self.rounds = BatchRounds(requester(transport), policy, schedule)
            if not self.left:
                self.batch, self.left = batch, batch_urls
            if batch != self.batch:
                raise ValueError(f"rows of batch {self.batch} are apart: {self.left} URLs are missing")
            self.left -= 1
            yield from self.result(self.rounds.ask(batch, url, self.left == 0))

        def terminate(self):
            if self.left:
                raise ValueError(f"rows of batch {self.batch} are apart: {self.left} URLs are missing")
            if self.rounds is not None:
                with self.rounds:
                    yield from self.result(self.rounds.finish())

        def result(self, attempts) -> Iterator[tuple]:
            for a in attempts:
                if a.last:
                    seconds = (a.end - a.start).total_seconds()
                    yield a.url, a.payload, a.end, seconds, a.batch, a.retries, a.failrate

    return FetchBatch


def register_sql(
    spark: SparkSession,
    transport: Transport | None = None,
    source_view: str | None = None,
    names: dict[str, str] | None = None,
    tasks: int | None = None,
) -> None:
    """Register temporary functions.

    Tests: ``is_url(text)``, ``is_url_array(array)``, ``is_url_shlist(text)``.
    Casts that raise: ``as_url``, ``as_url_array``, ``as_url_shlist``.
    Payloads: ``json_text(payload, '{a,"b,c",0}')`` gives the text at a path; malformed payloads raise, or
    give NULL with ``try_json_text``.
    Literals: ``url_array_literal('{a,"b,c",NULL}')`` reads an array that ``as_url_array`` accepts.
    Requests over ``transport``: ``fetch_url(url, min_latency, timeout, tries,
    waitretry)``; ``fetch_list(url_shlist, ..., parallel_jobs, delay)`` for a
    space-separated list.  ``fetch_urls(urls, ..., batch_size, batch_retries, batch_retries_failrate)``
    takes an array and ``fetch_source(...)`` the ``url`` column of ``source_view``: both number the batches
    themselves, deal them out to ``tasks`` tasks (one a core by default), fetch with retries and
    give one row per distinct URL.  ``i_`` and ``r_`` settings are for first attempts and retries;
    ``whole_job => true`` makes them limits of all tasks together.
    ``url_batches(batch_size)`` shows the batches of ``source_view``.
    ``names`` maps these to the names that existing queries use.
    """

    def name(plain: str) -> str:
        return (names or {}).get(plain, plain)

    def function(plain: str, argument: str, result: str, body: str) -> None:
        spark.sql(
            f"CREATE OR REPLACE TEMPORARY FUNCTION {name(plain)}({argument}) "
            f"RETURNS {result} RETURN {body}"
        )

    def checked(value: str, kind: str, test: str) -> str:
        return (
            f"CASE WHEN {value} IS NULL THEN raise_error('{NOT_NULL_VIOLATION} {kind}: NULL') WHEN NOT ({test}) "
            f"THEN raise_error('{CHECK_VIOLATION} {kind}: value breaks the check') ELSE {value} END"
        )

    one = f"rlike r'{URL_PATTERN}'"
    array = f"CASE WHEN exists(x, e -> e IS NOT NULL) THEN forall(x, e -> coalesce(e {one}, true)) END"
    shlist = f"CASE WHEN x <> '' THEN forall(split(x, ' ', -1), e -> e {one}) END"
    function("is_url", "x STRING", "BOOLEAN", f"x {one}")
    function("is_url_array", "x ARRAY<STRING>", "BOOLEAN", array)
    function("is_url_shlist", "x STRING", "BOOLEAN", shlist)
    function("as_url", "x STRING", "STRING", checked("x", "url", f"x {one}"))
    function("as_url_array", "x ARRAY<STRING>", "ARRAY<STRING>", checked("x", "url_array", array))
    function("as_url_shlist", "x STRING", "STRING", checked("x", "url_shlist", shlist))
    # Of duplicate keys the last counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    function("json_text", "x STRING, p STRING", "STRING", _json_text("parse_json"))
    function("try_json_text", "x STRING, p STRING", "STRING", _json_text("try_parse_json"))
    function("url_array_literal", "x STRING", "ARRAY<STRING>", _literal("x"))
    url = checked("url", "url", f"url {one}")
    transport = transport or HttpTransport()
    spark.udtf.register(name("fetch_url"), _fetch_one(transport))
    spark.udtf.register(name("fetch_list"), _fetch_list(transport))
    spark.udtf.register(name("fetch_numbered"), _fetch_batch(transport))
    form = {
        "arguments": ", ".join(f"{n} {kind}" for n, kind in _SETTINGS.items()),
        "settings": ", ".join(f"'{n}', {n}" for n in _SETTINGS),
        "kept": ", ".join(f"'{n}', given.{n}" for n in _SETTINGS),
        "columns": RESULT_COLUMNS,
        "tasks": tasks or spark.sparkContext.defaultParallelism,
        # Of the query, not of the registration.
        "began": "unix_micros(current_timestamp()) / 1e6D",
        "fetch": name("fetch_numbered"),
        "checked": url,
    }
    given = f"CASE WHEN urls IS NULL THEN raise_error('{NOT_NULL_VIOLATION} url_array: NULL') ELSE urls END"
    source = f"(SELECT explode({given}) AS url)"
    spark.sql(_FETCH.format(name=name("fetch_urls"), urls="urls ARRAY<STRING>, ", source=source, **form))
    if source_view:
        spark.sql(_BATCHES.format(name=name("url_batches"), source=source_view, checked=url))
        spark.sql(_FETCH.format(name=name("fetch_source"), urls="", source=source_view, **form))


def _json_text(parse: str) -> str:
    """``functions.json_payload.json_text`` of a payload ``x`` and a path ``p``, as SQL text.

    The path is followed one element at a time, so keys may hold any character.
    """
    marked = (
        f"array_join(transform(regexp_extract_all(x, r'(?s){TOKENS}', 0), t -> CASE "
        f"WHEN t rlike r'{NUMBER}' THEN concat(r'\"\\u0001n', t, '\"') "
        "WHEN startswith(t, r'\"\\u0001') THEN concat(r'\"\\u0001s', substring(t, 8)) ELSE t END), '')"
    )
    value = f"CASE WHEN x rlike r'{VALUE}' THEN concat('[', {marked}, ']') WHEN x IS NOT NULL THEN '' END"
    place = (
        "CASE WHEN e rlike '^(0|[1-9][0-9]{0,8})$' THEN cast(e AS INT) + 1 "
        "WHEN e rlike '^-[1-9][0-9]{0,8}$' THEN cast(e AS INT) END"
    )
    step = (
        "coalesce(try_element_at(try_cast(v AS MAP<STRING, VARIANT>), e), "
        f"try_element_at(try_cast(v AS ARRAY<VARIANT>), {place}))"
    )
    text = "cast(v AS STRING)"
    plain = (
        f"CASE WHEN startswith({text}, concat(chr(1), 'n')) THEN substring({text}, 3) "
        f"WHEN startswith({text}, concat(chr(1), 's')) THEN concat(chr(1), substring({text}, 3)) "
        f"WHEN NOT {text} rlike r'^[\\[{{]' OR startswith(to_json(v), '\"') THEN {text} "
        f"ELSE replace(regexp_replace({text}, r'\"\\\\u0001n([^\"]*+)\"', '$1'), "
        "r'\"\\u0001s', r'\"\\u0001') END"
    )
    first = f"try_variant_get({parse}({value}), '$[0]', 'variant')"
    return f"aggregate({_literal('p')}, {first}, (v, e) -> {step}, v -> {plain})"


def _literal(value: str) -> str:
    """``functions.text.array_literal`` as SQL text."""
    body = rf"regexp_extract({value}, r'(?s)^\s*\{{(.*)\}}\s*\z', 1)"
    pattern = r"""r'(?s)\s*("[^"\\]*+(?:\\.[^"\\]*+)*+"|[^,"{}]++)\s*(?:,|\z)'"""
    bare = lambda item: rf"regexp_replace({item}, r'^\s+|\s+\z', '')"
    plain = bare("e")
    quoted = rf"regexp_replace(substring({plain}, 2, length({plain}) - 2), r'(?s)\\(.)', '$1')"
    items = f"regexp_extract_all({body}, {pattern}, 1)"
    whole = (
        f"(array_join(regexp_extract_all({body}, {pattern}, 0), '') = {body} "
        rf"AND NOT {body} rlike r',\s*\z' AND NOT exists({items}, e -> {plain} = ''))"
    )
    empty = rf"(regexp_replace({body}, r'\s', '') = '')"
    return (
        f"CASE WHEN {value} IS NULL THEN NULL "
        rf"WHEN {value} rlike r'(?s)^\s*\{{.*\}}\s*\z' AND ({empty} OR {whole}) THEN "
        f"CASE WHEN {empty} THEN cast(array() AS ARRAY<STRING>) ELSE transform({items}, e -> "
        f"CASE WHEN startswith({plain}, '\"') THEN {quoted} WHEN upper({plain}) <> 'NULL' THEN {plain} END) END "
        f"ELSE raise_error(concat('22P02 malformed array literal: ', {value})) END"
    )
