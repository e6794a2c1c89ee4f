"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from checks.inputs import (
    StubTransport,
    event_answers,
    event_log,
    ipv4_urls,
    order_arrays,
    order_lists,
    page_urls,
    recorded,
    table,
    url_variants,
)
from linkloom.functions import (
    array_literal,
    array_to_string,
    is_url,
    is_url_array,
    is_url_shlist,
    json_fields,
    json_text,
    nullif_empty,
    parse_payload,
    split_to_fields,
    split_to_rows,
    string_to_array,
)
from linkloom.operators import (
    AttemptSettings,
    FetchPolicy,
    all_urls,
    batch_arrays,
    batch_report,
    distinct_urls,
    enforce_url,
    enforce_url_array,
    enforce_url_shlist,
    fetch,
    frame_files,
    frame_record,
    frames,
    last_attempts,
    number_batches,
    reject_counts,
    retry_candidates,
    with_duration,
    with_failrate,
)
from linkloom.plans import (
    fetch_batches,
    live_attempts,
    register_sql,
    replay_attempts,
    replay_outcomes,
)
from linkloom.sources import RunStore, Snapshot, load_table, save_table, unnest_urls, url_template
from linkloom.streaming import fetch_stream

POLICY = FetchPolicy(batch_size=40, batch_retries=1, batch_retries_failrate=0.05)
THREE_ROUNDS = FetchPolicy(batch_size=40, batch_retries=3, batch_retries_failrate=1.0)
ONE_BY_ONE = FetchPolicy(batch_size=2000, batch_retries=2, batch_retries_failrate=0.5)
RESULT = ["url", "payload", "batch", "retries", "batch_failrate"]


def _snapshot(spark: SparkSession, sf_dir: str, per_mille: int, attempts: int = 2) -> Snapshot:
    """The pages as a log of attempts, some of them empty. A URL that several pages have is answered once."""
    pages = table(spark, sf_dir, "pages").select("url", "html")
    log = recorded(pages, "html", per_mille, attempts)
    return Snapshot(log, payload="html", attempt="attempt")


# --- validation ----------------------------------------------------------------


def url_valid(spark, sf_dir):
    return url_variants(spark, sf_dir).withColumn("valid", is_url("url"))


def url_template_ipv4(spark, sf_dir):
    return ipv4_urls(spark, sf_dir).withColumn("valid", is_url("url"))


def url_reason_counts(spark, sf_dir):
    variants = url_variants(spark, sf_dir).select("url")
    return reject_counts(variants.unionByName(ipv4_urls(spark, sf_dir).select("url")))


def url_quarantine(spark, sf_dir):
    good, bad = enforce_url(url_variants(spark, sf_dir), "url", "quarantine")
    kept = good.groupBy("kind").agg(F.count("*").alias("rows")).withColumn("side", F.lit("good"))
    held = bad.groupBy("kind").agg(F.count("*").alias("rows")).withColumn("side", F.lit("bad"))
    return kept.unionByName(held)


def url_enforced(spark, sf_dir):
    return enforce_url(table(spark, sf_dir, "pages"), "url").select("page_id", "url")


def url_array_valid(spark, sf_dir):
    arrays = order_arrays(spark, sf_dir)
    flagged = enforce_url_array(arrays, "urls", "flag").withColumnRenamed("valid", "accepted")
    return flagged.select("o_orderkey", is_url_array("urls").alias("valid"), "accepted")


def url_group_valid(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_nationkey",
        "c_custkey % 40 as section",
        "case when c_nationkey % 6 = 0 or c_custkey % 5 = 0 then null "
        "when c_custkey % 311 = 0 then 'http://.' "
        "else concat('https://c.example.com/', c_custkey) end as url",
    )
    return all_urls(rows, ["c_nationkey", "section"])


def url_shlist_valid(spark, sf_dir):
    lists = order_lists(spark, sf_dir)
    flagged = enforce_url_shlist(lists, "shlist", "flag").withColumnRenamed("valid", "accepted")
    return flagged.select(
        "o_orderkey",
        is_url_shlist("shlist").alias("valid"),
        "accepted",
        F.size(string_to_array("shlist", " ")).cast("bigint").alias("items"),
    )


# --- URL lists and batches -------------------------------------------------------


def url_array_literal(spark, sf_dir):
    literals = table(spark, sf_dir, "pages").select(
        F.concat(
            F.lit('{'), "url", F.lit(', "'), "url", F.lit('?a=1,2" ,NULL, ftp://x.example.com/'), "page_id", F.lit("}")
        ).alias("literal")
    )
    arrays = literals.select(array_literal("literal").alias("urls"))
    return unnest_urls(arrays, "urls").groupBy("url").agg(F.count("*").alias("rows"))


def url_distinct(spark, sf_dir):
    keyed = table(spark, sf_dir, "orders").selectExpr(
        "case when o_orderkey % 3 = 0 then 'popular' else concat('customer/', o_custkey) end as page"
    )
    return distinct_urls(url_template(keyed, "page", "https://shop.example.com/%s"))


def url_batches(spark, sf_dir):
    return number_batches(distinct_urls(page_urls(spark, sf_dir)), 40)


def url_batches_wide(spark, sf_dir):
    keyed = table(spark, sf_dir, "orders").select("o_orderkey")
    urls = url_template(keyed, "o_orderkey", "https://shop.example.com/order/%s")
    return number_batches(distinct_urls(urls), 800)


def batch_lists(spark, sf_dir):
    arrays = batch_arrays(number_batches(distinct_urls(page_urls(spark, sf_dir)), 40))
    return arrays.select(
        "batch", F.size("urls").cast("bigint").alias("n"), array_to_string("urls", " ").alias("urls")
    )


# --- attempts over the snapshot --------------------------------------------------


def first_attempt(spark, sf_dir):
    policy = FetchPolicy(batch_size=40, batch_retries=0)
    result = fetch_batches(page_urls(spark, sf_dir), _snapshot(spark, sf_dir, 60), policy)
    return result.select("url", "payload", "batch")


def batch_failrate(spark, sf_dir):
    first = fetch_batches(
        page_urls(spark, sf_dir), _snapshot(spark, sf_dir, 400), FetchPolicy(batch_size=40, batch_retries=0)
    )
    rated = with_failrate(first.select("url", "payload", "batch"))
    return rated.select("url", "batch", "batch_failrate")


def retry_gate(spark, sf_dir):
    log = with_failrate(event_log(spark, sf_dir))
    policy = FetchPolicy(batch_retries=1, batch_retries_failrate=0.2)
    return retry_candidates(log, policy).select("url", "batch", "batch_failrate")


def batched_fetch(spark, sf_dir):
    return fetch_batches(page_urls(spark, sf_dir), _snapshot(spark, sf_dir, 60), POLICY).select(*RESULT)


def retry_rounds_3(spark, sf_dir):
    urls, snapshot = page_urls(spark, sf_dir), _snapshot(spark, sf_dir, 400, 4)
    return replay_outcomes(urls.where("url is not null"), snapshot, THREE_ROUNDS)


def attempt_log(spark, sf_dir):
    urls, snapshot = page_urls(spark, sf_dir), _snapshot(spark, sf_dir, 400, 4)
    return replay_attempts(urls.where("url is not null"), snapshot, THREE_ROUNDS)


def timed_fetch(spark, sf_dir):
    """All seven columns, from answers with times: failures and missing starts among them."""
    log = event_answers(spark, sf_dir)
    snapshot = Snapshot(log, ts_start="ts_start", ts_end="ts_end", attempt="attempt")
    policy = FetchPolicy(batch_size=40, batch_retries=3, batch_retries_failrate=0.4)
    result = fetch_batches(log.select("url"), snapshot, policy)
    return result.withColumns(
        {"ts_end": F.col("ts_end").cast("timestamp_ntz"), "duration": F.round("duration", 6)}
    )


def last_attempt(spark, sf_dir):
    log = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(user_id % 3 = 0, 'https://e.example.com/popular', concat('https://e.example.com/', user_id)) as url",
        "cast(event_id % 1000 as int) as retries",
    )
    return last_attempts(log)


def duration_fallback(spark, sf_dir):
    log = with_duration(event_log(spark, sf_dir))
    return log.select("url", "batch", F.round("duration", 6).alias("duration"))


def event_report(spark, sf_dir):
    log = with_duration(with_failrate(event_log(spark, sf_dir)))
    return batch_report(log).withColumn("avg_duration", F.round("avg_duration", 5))


def fetch_report(spark, sf_dir):
    """Flagship: batched fetch of all pages with retries, then the batch report."""
    outcomes = replay_outcomes(
        page_urls(spark, sf_dir).where(is_url("url")), _snapshot(spark, sf_dir, 60), POLICY
    )
    timed = outcomes.withColumns(
        {"ts_end": F.lit(None).cast("timestamp"), "duration": F.lit(None).cast("double")}
    )
    report = batch_report(timed, F.col("ok"))
    return report.select("batch", "batch_failrate", "retries", "count", "count_ok", "count_retried")


def ordered_result(spark, sf_dir):
    snapshot = _snapshot(spark, sf_dir, 60)
    result = fetch_batches(page_urls(spark, sf_dir), snapshot, POLICY, ordered=True)
    return result.select("batch", "url", "retries")


# --- the live fetch stage, over a stub transport ----------------------------------


def fetch_column(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return fetch(pages, "url", StubTransport(60)).select("page_id", "url", "payload")


def fetch_stub(spark, sf_dir):
    urls = page_urls(spark, sf_dir).where("url is not null")
    policy = FetchPolicy(batch_size=40, batch_retries=0)
    return live_attempts(urls, StubTransport(60), policy).select("url", "payload", "batch")


def live_rounds(spark, sf_dir):
    return fetch_batches(page_urls(spark, sf_dir), StubTransport(60), POLICY).select(*RESULT)


def live_rounds_3(spark, sf_dir):
    return fetch_batches(page_urls(spark, sf_dir), StubTransport(400), THREE_ROUNDS).select(*RESULT)


def sequential_batches(spark, sf_dir):
    result = fetch_batches(page_urls(spark, sf_dir), StubTransport(400), ONE_BY_ONE, sequential=True)
    return result.select(*RESULT)


def paced_batches(spark, sf_dir):
    policy = replace(THREE_ROUNDS, initial=AttemptSettings(parallel_jobs=6, delay=0.01))
    result = fetch_batches(page_urls(spark, sf_dir), StubTransport(400), policy, whole_job=True)
    return result.select(*RESULT)


def stream_batches(spark, sf_dir):
    store = RunStore(spark)
    # Two micro-batches, with every URL in both.
    for part in ("a", "b"):
        page_urls(spark, sf_dir).coalesce(1).write.parquet(f"{store.root}/incoming/part={part}")
    files = spark.readStream.schema("url string").option("maxFilesPerTrigger", 1)
    source = files.parquet(f"{store.root}/incoming/part=*")
    fetch_stream(
        source, StubTransport(400), THREE_ROUNDS, f"{store.root}/results", f"{store.root}/progress"
    ).awaitTermination()
    return spark.read.parquet(f"{store.root}/results").select(*RESULT)


# --- SQL names ---------------------------------------------------------------------


def sql_predicates(spark, sf_dir):
    register_sql(spark, StubTransport())
    order_arrays(spark, sf_dir).createOrReplaceTempView("sql_arrays")
    order_lists(spark, sf_dir).createOrReplaceTempView("sql_lists")
    return spark.sql(
        "SELECT a.o_orderkey, is_url_array(urls) AS array_valid, is_url_shlist(shlist) AS list_valid, "
        "is_url(try_element_at(urls, 1)) AS first_valid "
        "FROM sql_arrays a JOIN sql_lists l ON a.o_orderkey = l.o_orderkey"
    )


def sql_fetch_urls(spark, sf_dir):
    page_urls(spark, sf_dir).createOrReplaceTempView("requested_urls")
    register_sql(spark, StubTransport(60), "requested_urls")
    return spark.sql(
        "SELECT url, payload, batch, retries, batch_failrate FROM fetch_source("
        "i_parallel_jobs => 4, batch_size => 40, batch_retries => 1, batch_retries_failrate => 0.05D)"
    )


def sql_fetch_array(spark, sf_dir):
    table(spark, sf_dir, "pages").select("url").createOrReplaceTempView("sql_pages")
    register_sql(spark, StubTransport(400))
    return spark.sql(
        "SELECT url, payload, batch, retries, batch_failrate FROM fetch_urls(("
        "  SELECT as_url_array(url_array_literal(concat('{\"', array_join(collect_list(url), '\",\"'), '\",NULL}')))"
        "  FROM sql_pages), batch_size => 40, batch_retries => 3, batch_retries_failrate => 1D)"
    )


def sql_fetch_url(spark, sf_dir):
    table(spark, sf_dir, "pages").select("page_id", "url").createOrReplaceTempView("sql_pages")
    register_sql(spark, StubTransport(60))
    return spark.sql(
        "SELECT page_id, url, payload FROM (SELECT /*+ REPARTITION(16) */ * FROM sql_pages), "
        "LATERAL fetch_url(url, timeout => 2.0D)"
    )


def sql_fetch_list(spark, sf_dir):
    page_urls(spark, sf_dir).createOrReplaceTempView("requested_urls")
    register_sql(spark, StubTransport(60), "requested_urls")
    return spark.sql(
        "SELECT batch, f.url, f.payload FROM (SELECT /*+ REPARTITION(16) */ batch, as_url_shlist(urls) AS urls FROM ("
        "  SELECT batch, array_join(collect_list(url), ' ') AS urls FROM url_batches(40) GROUP BY batch"
        ")), LATERAL fetch_list(urls, parallel_jobs => 4) AS f"
    )


def sql_casts(spark, sf_dir):
    register_sql(spark, StubTransport())
    order_arrays(spark, sf_dir).createOrReplaceTempView("sql_arrays")
    order_lists(spark, sf_dir).createOrReplaceTempView("sql_lists")
    return spark.sql(
        "SELECT o_orderkey, nullif(as_url_shlist(shlist), '') AS shlist, "
        "  nullif(array_join(as_url_array(urls), ' '), '') AS urls "
        "FROM (SELECT * FROM sql_lists WHERE shlist IS NOT NULL AND coalesce(is_url_shlist(shlist), true)) "
        "JOIN (SELECT * FROM sql_arrays WHERE urls IS NOT NULL AND coalesce(is_url_array(urls), true)) "
        "USING (o_orderkey)"
    )


# --- payloads, text, tables ---------------------------------------------------------


def json_projection(spark, sf_dir):
    payloads = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('{\"site\":{\"unit\":', props, ',\"tags\":[\"', event_type, '\",', user_id, ',{\"0\":true}]},"
        "\"price\":', user_id, '.50,\"far\":-', event_id, 'e3,\"long\":', repeat(concat('1', event_id), 12), ',\"twice\":0,"
        "\"gone\":null,\"a b\":\"x\",\"twice\":{\"n\":[', event_id, '.0]}}') as payload",
    )
    paths = {
        "k": "{site,unit,k}",
        "tag": "{site,tags,0}",
        "user": "{site,tags,1}",
        "digit_key": "{site,tags,2,0}",
        "gone": "{gone}",
        "missing": "{site,nothing,here}",
        "spaced": '{"a b"}',
        "unit": "{site,unit}",
        "price": "{price}",
        "far": "{far}",
        "long": "{long}",
        "twice": "{twice}",
        "twice_n": "{twice,n,-1}",
    }
    json_fields(payloads, "payload", paths).drop("payload").createOrReplaceTempView("projected")
    return spark.sql("SELECT l.*, r.twice_n AS again FROM projected l JOIN projected r USING (event_id)")


def sql_json_fields(spark, sf_dir):
    table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "concat('{\"a,b\":{\"it''s \\\\\"q\\\\\"\":[', props, ',', user_id, '.10]},\"k\":1,\"k\":', value, '}') as payload",
    ).createOrReplaceTempView("sql_payloads")
    table(spark, sf_dir, "events").select("event_id", "value").createOrReplaceTempView("sql_events")
    register_sql(spark, StubTransport())
    return spark.sql(
        "SELECT event_id, json_text(payload, '{\"a,b\",\"it''s \\\\\"q\\\\\"\",0,k}') AS unit, "
        "json_text(payload, '{\"a,b\",\"it''s \\\\\"q\\\\\"\",-1}') AS price, "
        "json_text(payload, '{\"a,b\"}') AS nested, try_json_text(substring(payload, 2), '{k}') AS broken, "
        "cast(json_text(payload, '{k}') AS DOUBLE) = value AS exact FROM "
        "(SELECT p.*, e.value FROM sql_payloads p JOIN sql_events e USING (event_id))"
    )


def json_lenient(spark, sf_dir):
    payloads = table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "if(event_id % 4 = 0, substring(props, 1, length(props) - 1), props) as payload",
    )
    parsed = payloads.withColumn("v", parse_payload("payload", lenient=True))
    return parsed.select(
        "event_id", F.col("v").isNotNull().alias("readable"), json_text(F.col("v"), "{k}").alias("k")
    )


def frames_rows(spark, sf_dir):
    lines = F.split("text", "\n", -1)

    def record(line, i):
        address = F.concat(F.lit("https://docs.example.com/"), F.col("doc_id"), F.lit("/"), i)
        full = frame_record(
            address, line, F.lit("2024-01-01 00:00:00.000001"), F.lit("2024-01-01 00:00:01.5")
        )
        return F.when(i % 5 == 4, frame_record(address, line)).otherwise(full)

    packed = table(spark, sf_dir, "documents").select(
        "doc_id", F.array_join(F.transform(lines, record), "\n").alias("blob")
    )
    rows = frames(packed, "blob")
    return rows.select(
        "doc_id",
        F.col("pos").cast("bigint").alias("pos"),
        "url",
        nullif_empty("payload").alias("payload"),
        nullif_empty("ts_start").cast("timestamp_ntz").alias("ts_start"),
        nullif_empty("ts_end").cast("timestamp_ntz").alias("ts_end"),
    )


def frames_files(spark, sf_dir):
    """The documents' lines as records of one framed file a task, read back in splits."""
    folder = f"{RunStore(spark).root}/framed"
    lines = table(spark, sf_dir, "documents").select("doc_id", F.posexplode(F.split("text", "\n", -1)).alias("i", "line"))
    address = F.concat(F.lit("https://docs.example.com/"), "doc_id", F.lit("/"), "i")
    full = frame_record(address, "line", F.lit("2024-01-01 00:00:00.000001"), F.lit("2024-01-01 00:00:01.5"))
    record = F.when(F.col("i") % 5 == 4, frame_record(address, "line")).otherwise(full)
    lines.select(record.alias("value")).write.text(folder)
    rows = frame_files(spark, folder)
    return rows.select(
        "url",
        nullif_empty("payload").alias("payload"),
        nullif_empty("ts_start").cast("timestamp_ntz").alias("ts_start"),
        nullif_empty("ts_end").cast("timestamp_ntz").alias("ts_end"),
    )


def text_pieces(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations")
    pieces = split_to_rows(turns, "text", r"[.!?]\s", "piece")
    return pieces.select(
        "conv_id",
        "turn",
        F.col("pos").cast("bigint").alias("pos"),
        "piece",
        *split_to_fields("piece", ",", ["clause_1", "clause_2", "clause_3"]),
    )


def table_sink(spark, sf_dir):
    """Stored, then replaced by a frame that reads it, then loaded by its path."""
    path = f"{RunStore(spark).root}/pages"
    first = save_table(table(spark, sf_dir, "pages"), path)
    save_table(load_table(spark, path).withColumn("html", F.concat("html", F.lit("!"))), path)
    return load_table(spark, path).unionByName(first)


QUERIES = {
    f.__name__: f
    for f in (
        url_valid,
        url_template_ipv4,
        url_reason_counts,
        url_quarantine,
        url_enforced,
        url_array_valid,
        url_group_valid,
        url_shlist_valid,
        url_array_literal,
        url_distinct,
        url_batches,
        url_batches_wide,
        batch_lists,
        first_attempt,
        batch_failrate,
        retry_gate,
        batched_fetch,
        retry_rounds_3,
        attempt_log,
        timed_fetch,
        last_attempt,
        duration_fallback,
        event_report,
        fetch_report,
        ordered_result,
        fetch_column,
        fetch_stub,
        live_rounds,
        live_rounds_3,
        sequential_batches,
        paced_batches,
        stream_batches,
        sql_predicates,
        sql_fetch_urls,
        sql_fetch_array,
        sql_fetch_url,
        sql_fetch_list,
        sql_casts,
        json_projection,
        sql_json_fields,
        json_lenient,
        frames_rows,
        frames_files,
        text_pieces,
        table_sink,
    )
}
