"""Snapshot replay, the live rounds, and that both give the same result."""

import glob
import os
import sys
import time
import uuid
from collections import Counter
from dataclasses import dataclass

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from checks.inputs import StubTransport, recorded
from linkloom.operators import AttemptSettings, FetchPolicy, fetch, last_attempts, retry_candidates
from linkloom.operators import distinct_urls, number_batches, with_duration, with_failrate
from linkloom.operators.fetch import fetch_rounds
from linkloom.plans import (
    fetch_batches,
    live_attempts,
    register_sql,
    replay_attempts,
    replay_outcomes,
)
from linkloom.sources import RunStore, Snapshot, shared_folder, url_list, url_range
from linkloom.streaming import fetch_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

COLUMNS = ["url", "payload", "ts_end", "duration", "batch", "retries", "batch_failrate"]
COMPARED = ["url", "payload", "batch", "retries", "batch_failrate"]


@pytest.fixture(scope="module")
def urls(spark):
    return url_range(spark, 1, 300, "https://a.example.com/%s").select("url")


def bodies(urls):
    return urls.select("url", F.concat(F.lit("body of "), "url").alias("payload"))


@dataclass(frozen=True)
class Recording:
    """A stub that leaves a file per request."""

    folder: str
    per_mille: int
    sleep: float = 0.0
    fail_task_once: bool = False

    def __call__(self, url, attempt, settings):
        if self.fail_task_once and url.endswith("/7") and attempt == 0:
            flag = f"{self.folder}/failed"
            if not os.path.exists(flag):
                open(flag, "w").close()
                raise RuntimeError("defect in the transport")
        name = url.rsplit("/", 1)[1]
        with open(f"{self.folder}/{name}#{attempt}#{uuid.uuid4()}", "w") as out:
            out.write(f"{time.time()} {os.getpid()}")
        time.sleep(self.sleep)
        return StubTransport(self.per_mille)(url, attempt, settings)

    def requests(self):
        names = (os.path.basename(f).split("#")[:2] for f in glob.glob(f"{self.folder}/*#*"))
        return Counter((name, int(attempt)) for name, attempt in names)


POLICIES = [
    (60, FetchPolicy(batch_size=40, batch_retries=1, batch_retries_failrate=0.05)),
    (400, FetchPolicy(batch_size=40, batch_retries=3, batch_retries_failrate=1.0)),
    (400, FetchPolicy(batch_size=40, batch_retries=3, batch_retries_failrate=0.4)),
    (400, FetchPolicy(batch_size=1000, batch_retries=0)),
    (700, FetchPolicy(batch_size=150, batch_retries=2, batch_retries_failrate=1.0)),
    (0, FetchPolicy(batch_size=70)),
]


@pytest.mark.parametrize("per_mille,policy", POLICIES)
def test_replay_live_and_sequential_agree(spark, urls, per_mille, policy):
    doubled = urls.unionByName(urls).unionByName(url_list(spark, [None]))
    log = recorded(bodies(urls), "payload", per_mille, policy.batch_retries + 1)
    snapshot = Snapshot(log, attempt="attempt")
    replayed = fetch_batches(doubled, snapshot, policy)
    live = fetch_batches(doubled, StubTransport(per_mille), policy)
    assert replayed.columns == live.columns == COLUMNS
    assert [t for _, t in replayed.dtypes] == [t for _, t in live.dtypes]
    rows = sorted(live.select(*COMPARED).collect())
    assert rows == sorted(replayed.select(*COMPARED).collect())
    assert len(rows) == 300
    for row in rows:
        assert row.retries <= policy.batch_retries
        assert row.retries == 0 or row.batch_failrate <= policy.batch_retries_failrate
    if per_mille == 700:
        slow = fetch_batches(doubled, StubTransport(per_mille), policy, sequential=True)
        assert rows == sorted(slow.select(*COMPARED).collect())
    attempts = live_attempts(urls, StubTransport(per_mille), policy)
    log = attempts.select("url", "batch", "batch_failrate", "retries", "ok")
    replay_log = replay_attempts(urls, snapshot, policy)
    assert sorted(log.collect()) == sorted(replay_log.select(*log.columns).collect())
    assert sorted(last_attempts(attempts).select(*COMPARED).collect()) == rows
    first = with_failrate(attempts.where("retries = 0").drop("batch_failrate"))
    again = retry_candidates(first, policy).select("url")
    assert sorted(again.collect()) == sorted(attempts.where("retries = 1").select("url").collect())


def test_known_values(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    policy = FetchPolicy(batch_size=40, batch_retries=1, batch_retries_failrate=0.05)
    snapshot = Snapshot(recorded(pages, "html", 60, 2), payload="html", attempt="attempt")
    result = fetch_batches(pages, snapshot, policy)
    rows = result.groupBy("batch", "batch_failrate").agg(
        F.count("*").alias("n"), F.max("retries").alias("r"), F.count("payload").alias("ok")
    )
    assert sorted((r.batch, r.n, r.batch_failrate, r.r, r.ok) for r in rows.collect()) == [
        (1, 40, 0.05, 1, 39),
        (2, 40, 0.075, 0, 37),
        (3, 40, 0.075, 0, 37),
        (4, 40, 0.075, 0, 37),
        (5, 40, 0.1, 0, 36),
        (6, 40, 0.05, 1, 40),
        (7, 10, 0.0, 0, 10),
    ]


def test_snapshot_copies_empty_and_missing(spark):
    wanted = url_list(spark, [f"http://a.com/{c}" for c in "abcde"])
    rows = [("http://a.com/a", "x"), ("http://a.com/a", ""), ("http://a.com/a", "y"), ("http://a.com/b", "")]
    rows += [("http://a.com/c", None), (None, "n"), ("http://a.com/e", "e")] + [("http://hot.com/", "z")] * 500
    table = spark.createDataFrame(rows, "url string, payload string")
    result = fetch_batches(wanted, Snapshot(table)).collect()
    assert {(r.url[-1], r.payload, r.retries) for r in result} == {
        ("a", "y", 0),
        ("b", None, 0),
        ("c", None, 0),
        ("d", None, 0),
        ("e", "e", 0),
    }
    with pytest.raises(Exception, match="snapshot repeats"):
        fetch_batches(wanted, Snapshot(table, unique=True)).collect()
    distinct = table.where("payload in ('y', 'e')")
    assert fetch_batches(wanted, Snapshot(distinct, unique=True)).where("payload is not null").count() == 2


def test_snapshot_times(spark):
    table = spark.sql(
        "SELECT 'http://a.com/1' AS url, 'x' AS payload, timestamp'2024-01-01 00:00:00' AS b, "
        "timestamp'2024-01-01 00:00:01.5' AS e"
    )
    row = fetch_batches(table, Snapshot(table, ts_start="b", ts_end="e")).first()
    assert row.duration == 1.5 and row.ts_end.second == 1


def test_a_filled_column_saves_reading_payloads(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").withColumn("big", F.col("page_id") >= 0)
    plain = replay_outcomes(pages, Snapshot(pages, payload="html"), FetchPolicy())
    told = replay_outcomes(pages, Snapshot(pages, payload="html", filled="big"), FetchPolicy())
    assert sorted(plain.collect()) == sorted(told.collect())
    plan = told._jdf.queryExecution().toString()
    assert "html" not in plan[plan.index("== Physical Plan ==") :]


def test_a_snapshot_without_attempts_answers_every_one(spark):
    wanted = url_list(spark, [f"http://a.com/{c}" for c in "ab"])
    table = spark.createDataFrame([("http://a.com/a", "x"), ("http://a.com/b", "")], "url string, payload string")
    policy = FetchPolicy(batch_retries=2, batch_retries_failrate=1.0)
    result = fetch_batches(wanted, Snapshot(table), policy).collect()
    assert {(r.url[-1], r.payload, r.retries) for r in result} == {("a", "x", 0), ("b", None, 2)}


def test_empty_answers_keep_their_times(spark):
    table = spark.sql(
        "SELECT * FROM VALUES ('http://a.com/1', '', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:02'), "
        "('http://a.com/2', NULL, NULL, timestamp'2024-01-01 00:00:05'), "
        "('http://a.com/3', 'x', NULL, timestamp'2024-01-01 00:00:06'), "
        "('http://a.com/3', 'z', NULL, timestamp'2024-01-01 00:00:05') AS t(url, payload, b, e)"
    )
    wanted = table.select("url").unionByName(url_list(spark, ["http://a.com/4"]))
    result = fetch_batches(wanted, Snapshot(table, ts_start="b", ts_end="e"), FetchPolicy(batch_retries=0)).collect()
    got = {r.url[-1]: (r.payload, r.ts_end and r.ts_end.second, r.duration) for r in result}
    assert got == {"1": (None, 2, 2.0), "2": (None, 5, 3.0), "3": ("x", 6, 1.0), "4": (None, None, None)}


def test_snapshot_with_ends_only(spark):
    table = spark.sql(
        "SELECT concat('http://a.com/', id) AS url, 'x' AS payload, "
        "timestampadd(SECOND, id * id, timestamp'2024-01-01 00:00:00') AS e FROM range(4)"
    )
    result = fetch_batches(table, Snapshot(table, ts_end="e"))
    assert {r.url[-1]: r.duration for r in result.collect()} == {"0": None, "1": 1.0, "2": 3.0, "3": 5.0}


def test_each_attempt_is_requested_once(spark, urls, tmp_path):
    transport = Recording(str(tmp_path), 400)
    policy = FetchPolicy(batch_size=40, batch_retries=2, batch_retries_failrate=1.0)
    result = fetch_batches(urls, transport, policy)
    made = transport.requests()
    assert result.count() == 300 and len(result.collect()) == 300
    result.write.format("noop").mode("overwrite").save()
    assert transport.requests() == made
    assert set(made.values()) == {1}
    assert sum(attempt == 0 for _, attempt in made) == 300
    assert {attempt for _, attempt in made} == {0, 1, 2}


def test_a_run_resumes_under_its_name(spark, urls, tmp_path):
    transport = Recording(str(tmp_path), 400, fail_task_once=True)
    policy = FetchPolicy(batch_size=40, batch_retries=1, batch_retries_failrate=1.0)
    run = f"test-{uuid.uuid4()}"
    with pytest.raises(Exception, match="defect in the transport"):
        fetch_batches(urls, transport, policy, run_id=run, tasks=4)
    first = fetch_batches(urls, transport, policy, run_id=run, tasks=4)
    assert first.count() == 300
    made = transport.requests()
    second = fetch_batches(urls, transport, policy, run_id=run, tasks=4)
    assert sorted(second.collect()) == sorted(first.collect())
    assert transport.requests() == made
    assert max(n for (_, attempt), n in made.items() if attempt == 1) == 1


def test_a_cluster_must_name_its_shared_folder():
    class Session:
        class conf:
            get = staticmethod(lambda key, default=None: default)

        class sparkContext:
            master = "yarn"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_folder(Session)


def test_store_is_shared_and_can_be_dropped(spark, urls):
    assert shared_folder(spark) == (spark.conf.get("spark.checkpoint.dir", None) or shared_folder(spark))
    store = RunStore(spark)
    assert not store.finished("a")
    assert store.write("a", urls).count() == 300
    assert store.finished("a")
    assert store.write("a", urls.limit(1)).count() == 300
    store.drop()
    assert not store.finished("a")


def test_concurrency_latency_and_delay(spark, tmp_path):
    urls = url_range(spark, 1, 40, "https://a.example.com/%s")
    slow = Recording(str(tmp_path), 0, sleep=0.1)
    jobs = FetchPolicy(initial=AttemptSettings(parallel_jobs=20), batch_size=40)
    rows = live_attempts(urls, slow, jobs, tasks=1).agg(F.min("ts_start"), F.max("ts_end")).first()
    assert 0.2 <= (rows[1] - rows[0]).total_seconds() < 2.0  # one by one it would take 4 s

    paced = FetchPolicy(initial=AttemptSettings(min_latency=0.5, delay=0.2), batch_size=10)
    log = live_attempts(urls, StubTransport(), paced, tasks=1)
    starts = [r[1] for r in log.groupBy("batch").agg(F.min("ts_start")).orderBy("batch").collect()]
    gaps = [(b - a).total_seconds() for a, b in zip(starts, starts[1:])]
    assert len(gaps) == 3 and all(gap >= 0.65 for gap in gaps)


def test_batches_are_dealt_out_evenly(spark, tmp_path):
    urls = url_range(spark, 1, 160, "https://a.example.com/%s")
    log = live_attempts(urls, StubTransport(), FetchPolicy(batch_size=10), tasks=4)
    assert log.select("batch").distinct().count() == 16


def test_failures_and_bodies(spark):
    def transport(url, attempt, settings):
        return {"1": b"", "2": None, "3": "text", "4": "café".encode(), "5": b"\xff\x00z"}[url[-1]]

    urls = url_range(spark, 1, 5, "http://a.com/%s")
    result = fetch_batches(urls, transport, FetchPolicy(batch_retries=0))
    assert {r.url[-1]: r.payload for r in result.collect()} == {
        "1": None,
        "2": None,
        "3": "text",
        "4": "café",
        "5": "�\x00z",
    }
    assert {r.batch_failrate for r in result.collect()} == {0.4}
    assert fetch_batches(url_list(spark, [None]), transport).count() == 0
    assert fetch_batches(url_list(spark, []), transport, sequential=True).count() == 0


def test_fetch_column_keeps_rows_and_takes_its_time(spark):
    frame = spark.createDataFrame(
        [(1, "http://a.com/1", [1]), (2, None, None), (3, "http://a.com/1", [2, 3])],
        "id int, u string, other array<int>",
    ).coalesce(1)
    settings = AttemptSettings(min_latency=0.3, parallel_jobs=1)
    rows = fetch(frame, "u", StubTransport(), settings, tasks=1)
    assert rows.columns == ["id", "u", "other", "payload", "ts_start", "ts_end"]
    begin = time.time()
    got = {r.id: (r.payload, r.other) for r in rows.collect()}
    assert time.time() - begin >= 0.6
    assert got == {1: ("body of http://a.com/1", [1]), 2: (None, None), 3: ("body of http://a.com/1", [2, 3])}


def test_invalid_urls(spark):
    urls = url_list(spark, ["http://a.com/1", "nonsense"])
    with pytest.raises(Exception, match="23514"):
        fetch_batches(urls, StubTransport())
    assert fetch_batches(urls, StubTransport(), on_invalid="drop").count() == 1
    with pytest.raises(ValueError):
        fetch_batches(urls, StubTransport(), on_invalid="ignore")


def test_ordered(spark, urls):
    rows = fetch_batches(urls, StubTransport(60), FetchPolicy(batch_size=40), ordered=True).collect()
    assert [(r.batch, r.url) for r in rows] == sorted((r.batch, r.url) for r in rows)


def test_sql_equals_python(spark, urls):
    urls.createOrReplaceTempView("t_wanted")
    register_sql(spark, StubTransport(400), "t_wanted")
    policy = FetchPolicy(batch_size=40, batch_retries=2, batch_retries_failrate=0.4)
    by_sql = spark.sql(
        "SELECT * FROM fetch_source(batch_size => 40, i_parallel_jobs => 3, batch_retries => 2, "
        "batch_retries_failrate => 0.4D)"
    )
    assert by_sql.columns == COLUMNS
    by_python = sorted(fetch_batches(urls, StubTransport(400), policy).select(*COMPARED).collect())
    assert sorted(by_sql.select(*COMPARED).collect()) == by_python
    by_array = spark.sql(
        "SELECT * FROM fetch_urls((SELECT collect_list(url) FROM t_wanted), batch_size => 40, batch_retries => 2, "
        "batch_retries_failrate => 0.4D, whole_job => true)"
    )
    assert by_array.columns == COLUMNS
    assert sorted(by_array.select(*COMPARED).collect()) == by_python
    register_sql(spark, StubTransport())
    one = spark.sql("SELECT payload FROM fetch_url('http://a.com/1', tries => 2)").collect()
    assert [r.payload for r in one] == ["body of http://a.com/1"]


def part_of_task(url, attempt, settings):
    from pyspark import TaskContext

    time.sleep(0.005)
    return str(TaskContext.get().partitionId())


@pytest.mark.parametrize("parts", [1, 3, 17])
def test_sql_fetches_spread_whatever_the_input(spark, urls, parts):
    urls.repartition(parts).createOrReplaceTempView("t_spread")
    register_sql(spark, part_of_task, "t_spread", tasks=4)
    for call in ("fetch_source(batch_size => 40)", "fetch_urls((SELECT collect_list(url) FROM t_spread), batch_size => 40)"):
        rows = spark.sql(f"SELECT url, payload, batch FROM {call}").collect()
        assert len(rows) == 300 and len({r.payload for r in rows}) == 4
        by_batch = {(r.batch, r.payload) for r in rows}
        assert len(by_batch) == 8  # a batch is in one task


def test_sql_arrays(spark):
    register_sql(spark, StubTransport())
    got = spark.sql(
        "SELECT url, batch FROM fetch_urls((SELECT url_array_literal('{http://a.com/1,\"http://b.com/?x,y\",NULL,http://a.com/1}')), "
        "batch_size => 1)"
    ).collect()
    assert {r.url for r in got} == {"http://a.com/1", "http://b.com/?x,y"} and {r.batch for r in got} == {1, 2}
    assert spark.sql("SELECT * FROM fetch_urls(cast(array() AS ARRAY<STRING>))").collect() == []
    for bad, state in (("array('nonsense')", "23514"), ("cast(NULL AS ARRAY<STRING>)", "23502"), ("(SELECT url_array_literal('{a'))", "22P02")):
        with pytest.raises(Exception, match=state):
            spark.sql(f"SELECT * FROM fetch_urls({bad})").collect()


def test_rows_of_a_batch_must_stand_together(spark):
    rows = [(f"http://a.com/{i}", i % 2 + 1) for i in range(6)]
    spark.createDataFrame(rows, "url string, batch long").coalesce(1).createOrReplaceTempView("t_apart")
    register_sql(spark, StubTransport(), "t_apart")
    settings = "named_struct('i_min_latency', 0D, 'i_timeout', 5D, 'i_tries', 1, 'i_waitretry', 0D, 'i_parallel_jobs', 1, "
    settings += "'i_delay', 0D, 'r_min_latency', 0D, 'r_timeout', 5D, 'r_tries', 1, 'r_waitretry', 0D, 'r_parallel_jobs', 1, "
    settings += "'r_delay', 0D, 'batch_retries', 1, 'batch_retries_failrate', 0.05D, 'whole_job', false)"
    with pytest.raises(Exception, match="apart"):
        spark.sql(f"SELECT f.* FROM t_apart, LATERAL fetch_numbered(t_apart.url, t_apart.batch, 3L, {settings}) f").collect()


def most_at_once(log):
    rows = log.select(F.unix_micros("ts_start").alias("b"), F.unix_micros("ts_end").alias("e")).collect()
    events = sorted([(r.b, 1) for r in rows] + [(r.e, -1) for r in rows])
    now = most = 0
    for _, step in events:
        now += step
        most = max(most, now)
    return most


@pytest.mark.parametrize("jobs", [1, 3, 6])
def test_limits_of_the_whole_job(spark, tmp_path, jobs):
    urls = url_range(spark, 1, 120, "https://a.example.com/%s")
    settings = AttemptSettings(parallel_jobs=jobs, delay=0.3)
    policy = FetchPolicy(settings, AttemptSettings(parallel_jobs=jobs), 20, 1, 1.0)
    log = live_attempts(urls, Recording(str(tmp_path), 300, sleep=0.02), policy, tasks=4, whole_job=True)
    assert 1 <= most_at_once(log) <= jobs
    starts = sorted(r[1] for r in log.groupBy("batch").agg(F.min("ts_start")).collect())
    assert len(starts) == 6 and (starts[-1] - starts[0]).total_seconds() >= 5 * 0.3 - 0.5
    free = FetchPolicy(AttemptSettings(parallel_jobs=jobs), batch_size=20)
    per_task = live_attempts(urls, Recording(str(tmp_path), 0, sleep=0.2), free, tasks=4)
    assert most_at_once(per_task) > jobs


@pytest.mark.parametrize("jobs", [1, 3, 10])
def test_sql_limits_of_the_whole_job(spark, tmp_path, jobs):
    urls = url_range(spark, 1, 120, "https://a.example.com/%s").select("url")
    urls.createOrReplaceTempView("t_limits")
    register_sql(spark, Recording(str(tmp_path), 300, sleep=0.02), "t_limits", tasks=4)
    got = spark.sql(
        f"SELECT * FROM fetch_source(i_parallel_jobs => {jobs}, r_parallel_jobs => {jobs}, batch_size => 10, "
        "batch_retries => 2, batch_retries_failrate => 1D, whole_job => true)"
    )
    rows = got.select("url", "ts_end", "duration").collect()
    assert len(rows) == 120
    spans = [(r.ts_end.timestamp() - r.duration, r.ts_end.timestamp()) for r in rows]
    events = sorted([(a + 1e-6, 1) for a, _ in spans] + [(b, -1) for _, b in spans])
    now = most = 0
    for _, step in events:
        now += step
        most = max(most, now)
    assert most <= jobs


def test_rounds_are_one_job_and_survive_a_lost_task(spark, tmp_path):
    """A task that dies repeats its own requests; what it had sent before counts once."""
    urls = url_range(spark, 1, 200, "https://a.example.com/%s")
    policy = FetchPolicy(batch_size=40, batch_retries=3, batch_retries_failrate=1.0)
    frame = number_batches(distinct_urls(urls), 40)
    want = sorted(fetch_batches(urls, StubTransport(400), policy).select("url", "batch", "retries").collect())
    died = Recording(str(tmp_path), 400, fail_task_once=True)
    log = fetch_rounds(frame, died, policy, 3)
    with pytest.raises(Exception, match="defect"):
        log.collect()  # local mode gives a task one try; a cluster would repeat it
    again = log.where("last").select("url", "batch", "retries").collect()
    assert sorted(again) == want
    assert "Exchange" in log._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("other", [{"sequential": True}, {"whole_job": True}])
def test_a_named_run_keeps_its_mode(spark, urls, other):
    few, run = urls.limit(10), f"mode-{uuid.uuid4()}"
    assert fetch_batches(few, StubTransport(), run_id=run).count() == 10
    with pytest.raises(ValueError, match="another mode"):
        fetch_batches(few, StubTransport(), run_id=run, **other)
    assert fetch_batches(few, StubTransport(), run_id=run).count() == 10
    named = f"mode-{uuid.uuid4()}"
    assert fetch_batches(few, StubTransport(), run_id=named, **other).count() == 10
    assert fetch_batches(few, StubTransport(), run_id=named, **other).count() == 10


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_times_are_instants_in_any_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        before = time.time()
        wanted = url_range(spark, 1, 3, "http://a.com/%s")
        wanted.createOrReplaceTempView("t_zone")
        register_sql(spark, StubTransport(), "t_zone")
        frames = [
            fetch_batches(wanted, StubTransport()),
            fetch(wanted, "url", StubTransport()),
            spark.sql("SELECT * FROM fetch_source()"),
            spark.sql("SELECT * FROM fetch_list('http://a.com/1 http://a.com/2')"),
        ]
        for frame in frames:
            for (seconds,) in frame.select(F.unix_micros("ts_end") / 1e6).collect():
                assert before - 1 <= seconds <= time.time() + 1
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_duration_falls_back_to_the_gap(spark):
    log = spark.sql(
        """SELECT * FROM VALUES
        ('a', timestamp'2024-01-01 00:00:00', timestamp'2024-01-01 00:00:02', 1L),
        ('b', null, timestamp'2024-01-01 00:00:02.25', 1L),
        ('c', null, timestamp'2024-01-01 00:00:05', 2L),
        ('d', timestamp'2024-01-01 00:00:00', null, 1L) AS t(url, ts_start, ts_end, batch)"""
    )
    got = {r.url: r.duration for r in with_duration(log).collect()}
    assert got == {"a": 2.0, "b": 0.25, "c": None, "d": None}


def test_stream(spark, urls, tmp_path):
    transport = Recording(str(tmp_path), 0)
    store = RunStore(spark)
    source, results, progress = (f"{store.root}/{n}" for n in ("in", "out", "progress"))

    def run():
        stream = spark.readStream.schema("url string").parquet(source)
        fetch_stream(stream, transport, FetchPolicy(batch_size=40), results, progress).awaitTermination()
        return spark.read.parquet(results)

    urls.where("url like '%1'").write.parquet(source)
    assert run().count() == 30
    urls.where("url like '%2'").unionByName(urls.where("url like '%1'")).write.mode("append").parquet(source)
    again = run()  # also a restart: nothing but the progress folder is left of the first run
    assert again.count() == 60 and again.select("epoch").distinct().count() == 2
    assert set(transport.requests().values()) == {1}
