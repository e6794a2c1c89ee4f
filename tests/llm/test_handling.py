"""Every operator and stage on NULLs, empty and very long texts, repeated rows and clashing columns."""

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from linkloom.llm import (
    blas_search,
    chat_hmm,
    collocations,
    decontaminate,
    host_rules,
    lattice,
    line_dedup,
    nbsvm,
    pii,
    simhash,
    toxicity,
    url_filter,
    warc_zstd,
)
from linkloom.llm.frames import stored

CLASHES = ["_key", "c0", "score", "label", "fp", "slice", "host", "word", "_word", "_bits", "h", "item", "key", "_keys", "_spans", "n", "k"]


def clashing(df):
    return df.withColumns({c: F.lit("clash") for c in CLASHES})


@pytest.fixture(scope="module")
def odd(spark, sf_dir):
    """200 documents and the awkward ones; one of ten million characters, one without a space."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 200")
    words = " ".join(f"word{i % 977}" for i in range(1_000_000))
    long = [(-1, words + ".\n" + "line\n" * 200_000, "en", "s1", 1), (-2, "x" * 500_000, "de", None, 2)]
    some = [(None, None, None, None, None), (None, "", "fr", "s2", 0), (-3, None, "en", "s1", 0), (-4, "", None, "s1", 0)]
    some += [(-5, "The same row. Twice or more!\n", "en", "s1", 5)] * 3 + [(-5, "another text of that id", "en", "s9", 5)]
    some += [(None, "no id but a text, 10.0.0.1 and a@b.org", "en", "s1", 9)] * 2
    frame = docs.unionByName(spark.createDataFrame(some + long, docs.schema))
    return stored(clashing(frame).repartition(4))


@pytest.fixture(scope="module")
def tables(spark, sf_dir):
    def read(name):
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    return read


def labels_of(tables):
    labels = tables("labels")
    awkward = labels.limit(1).selectExpr("CAST(NULL AS BIGINT) AS doc_id", "quality", "toxic")
    twice = labels.limit(20).unionByName(labels.limit(20).selectExpr("doc_id", "1 - quality AS quality", "NULL AS toxic"))
    return clashing(labels.unionByName(awkward).unionByName(twice)).drop("label")


def items_of(tables):
    items = tables("benchmark")
    more = "(VALUES (-1L, NULL), (-2L, ''), (-3L, 'three short words'), (-3L, 'and two more'), (NULL, 'no id here')) AS t(item_id, text)"
    extra = items.sparkSession.sql(f"SELECT * FROM {more}")
    return clashing(items.unionByName(extra).unionByName(items.limit(5))).drop("item")


ROW_EACH = {
    "op1": lambda docs, t: host_rules.host_verdicts(docs),
    "op2": lambda docs, t: nbsvm.quality_scores(docs, labels_of(t)),
    "op5": lambda docs, t: decontaminate.contamination_report(docs, items_of(t)),
    "op6": lambda docs, t: toxicity.toxicity_scores(docs, labels_of(t)),
    "op8": lambda docs, t: pii.personal_data(docs),
    "op9": lambda docs, t: lattice.encoded(docs),
    "op10": lambda docs, t: simhash.near_duplicates(docs),
    "op11": lambda docs, t: line_dedup.without_shared_lines(docs),
}


@pytest.mark.parametrize("name", list(ROW_EACH))
def test_a_row_for_each_row(odd, tables, name):
    got = ROW_EACH[name](odd, tables).drop("text")
    ids = lambda df: sorted((str(r["doc_id"]) for r in df.select("doc_id").collect()))
    assert ids(got) == ids(odd)
    # Repeated rows come out alike.
    same = got.where("doc_id = -5").drop("component_id")
    assert same.count() == 4 and same.distinct().count() <= 2
    assert ROW_EACH[name](odd.limit(0), tables).count() == 0


def test_searches_and_phrases(odd, tables):
    found = blas_search.best_documents(odd, items_of(tables))
    assert found.groupBy("item_id").agg(F.max("rank").alias("r"), F.count("*").alias("n")).where("r <> n OR n > 10").count() == 0
    assert found.where("score <= 0").count() == 0
    phrases = collocations.collocations(odd, least=3)
    assert phrases.where("lang = 'und'").count() == 0 and phrases.count() > 100


def test_pages(spark, tables):
    pages = tables("pages").limit(60)
    rows = [(None, None, None), (-1, "http://h.com/a", None), (-2, None, "x" * 10_000_000), (-3, "no url", ""), (-4, "", "é" * 60)]
    rows += [(-5, "HTTP://Ex.com:80/a?b#c", "same " * 40)] * 3 + [(-6, "http://" + "a." * 5000 + "net/es/x", "same " * 40)]
    odd = clashing(pages.unionByName(spark.createDataFrame(rows, pages.schema)))
    back = warc_zstd.read_archives(stored(warc_zstd.write_archives(odd)), payloads=False)
    assert back.where("error IS NOT NULL").count() == 0 and back.count() == odd.count()
    listed = pages.select("url").limit(10)
    judged = url_filter.judged_urls(odd, listed, (("block", "net/es/"),))
    verdicts = {r["page_id"]: (r["host"][:6], r["rule"], r["verdict"]) for r in judged.collect()}
    assert judged.count() == odd.count() and verdicts[-6] == ("a.a.a.", "net/es/", "block")
    assert verdicts[-2] == verdicts[-3] == verdicts[-4] == ("", None, "allow")
    assert warc_zstd.write_archives(odd.limit(0)).count() == 0
    assert url_filter.judged_urls(odd.limit(0), listed, ()).count() == 0


def test_conversations(spark, tables):
    turns = tables("conversations").limit(200)
    rows = [(None, 1, "user", "x"), (-1, None, "user", "x"), (-1, 1, None, "x"), (-1, 2, "user", None), (-1, 3, "assistant", "")]
    rows += [(-2, 1, "user", "long line " * 1_000_000), (-2, 2, "assistant", "many\n" * 200_000)]
    rows += [(-3, 1, "user", "same")] * 3 + [(-3, 2, "narrator", "no known role")]
    odd = clashing(turns.unionByName(spark.createDataFrame(rows, turns.schema)))
    got = chat_hmm.recovered_turns(odd)
    counts = {r["conv_id"]: r["n"] for r in got.groupBy("conv_id").agg(F.count("*").alias("n")).collect()}
    assert counts[-2] >= 1 and counts[-3] == 1 and None not in counts
    assert chat_hmm.recovered_turns(odd.limit(0)).count() == 0


def test_a_turn_of_too_many_lines_raises(spark, monkeypatch):
    monkeypatch.setattr(chat_hmm, "TURN_SPAN", 8)
    rows = [(1, 1, "user", "a\nb"), (1, 2, "user", "x\n" * 20)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    assert chat_hmm.transcript_lines(frame.where("turn = 1")).count() == 3
    with pytest.raises(Exception, match="too many lines"):
        chat_hmm.transcript_lines(frame).collect()


def test_stages(spark, odd, sf_dir):
    """Every stage keeps all columns, whatever their names, and takes what the one before leaves."""
    now = odd
    for name, stage in corpus_pipeline.STAGES:
        before, now = now, stored(stage(spark, now, sf_dir))
        if name != "tokens":
            assert now.columns == odd.columns, name
            assert {tuple(r) for r in now.select(*CLASHES).distinct().collect()} == {("clash",) * len(CLASHES)}
        assert 0 < now.count() <= before.count()
        none = stage(spark, before.limit(0), sf_dir)
        assert none.columns == now.columns and none.count() == 0


def test_the_filter_grows_with_its_list(spark):
    sizes = [url_filter.blocks_for(n) for n in (0, 1, 32_768, 32_769, 1_000_000, 10**9)]
    assert sizes == [1 << 10, 1 << 10, 1 << 10, 1 << 11, 1 << 15, 1 << 18]
    listed = spark.range(50_000).select(F.concat(F.lit("k"), "id").alias("key"))
    rows = spark.range(40_000, 140_000).select(F.concat(F.lit("k"), "id").alias("key"))
    found = url_filter.listed_keys(rows, listed, "key")
    assert found.where("listed").count() == 10_000 and found.count() == 100_000
    table = url_filter.bloom_filter(listed, "key", url_filter.blocks_for(50_000))
    assert table.count() <= 1 << 11
