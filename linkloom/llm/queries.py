"""Registered queries of the operators and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
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

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_host_rules(spark, sf_dir):
    return host_rules.host_verdicts(_table(spark, sf_dir, "documents"))


def op2_nbsvm(spark, sf_dir):
    return nbsvm.quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_warc_zstd(spark, sf_dir):
    archives = stored(warc_zstd.write_archives(_table(spark, sf_dir, "pages")))
    found = warc_zstd.read_archives(archives, payloads=False)
    # What was just written must be readable: a bad record is no row less, but an error.
    bad = F.raise_error(F.concat(F.lit("unreadable record: "), F.col("error"))).cast("boolean")
    found = found.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(bad))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def repeated_urls(pages: DataFrame) -> DataFrame:
    """The list of the query: URLs whose canonical form more than one page has."""
    parts = url_filter.with_parts(pages.select("url")).where("host <> ''")
    key = url_filter.canonical(F.col("url"), F.col("host"), F.col("path"))
    return parts.groupBy(key).agg(F.min("url").alias("url"), F.count("*").alias("n")).where("n > 1").select("url")


def op4_url_filter(spark, sf_dir):
    pages = _table(spark, sf_dir, "pages")
    return url_filter.judged_urls(pages, repeated_urls(pages), URL_RULES)


def op5_fm_decontamination(spark, sf_dir):
    return decontaminate.contamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op7_chat_hmm(spark, sf_dir):
    return chat_hmm.recovered_turns(_table(spark, sf_dir, "conversations"))


def op8_pii(spark, sf_dir):
    return pii.personal_data(_table(spark, sf_dir, "documents"))


def op9_sentencepiece_lattice(spark, sf_dir):
    return lattice.encoded(_table(spark, sf_dir, "documents"))


def op10_simhash(spark, sf_dir):
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op11_line_dedup(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_shared_lines(docs).drop("text")


def op12_blas_search(spark, sf_dir):
    return blas_search.best_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op13_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    f.__name__: f
    for f in (
        op1_host_rules,
        op2_nbsvm,
        op3_warc_zstd,
        op4_url_filter,
        op5_fm_decontamination,
        op6_toxicity,
        op7_chat_hmm,
        op8_pii,
        op9_sentencepiece_lattice,
        op10_simhash,
        op11_line_dedup,
        op12_blas_search,
        op13_collocations,
        pipeline,
    )
}

_OP1 = r"""
WITH d AS (SELECT doc_id, source AS host, coalesce(text, '') AS text,
             regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
     g AS (SELECT doc_id, unnest(range(1, len(words) - 6)) AS i, words FROM d WHERE len(words) >= 8),
     v AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, array_to_string(words[i : i + 7], ' ')) AS times FROM g),
     r AS (SELECT doc_id, count(DISTINCT pos) AS n_repeat_words
           FROM (SELECT doc_id, unnest(range(i, i + 8)) AS pos FROM v WHERE times > 1) GROUP BY doc_id),
     l AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines
           FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM d)
           WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
     c AS (SELECT doc_id, host, len(words) AS n_words,
             length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS word_chars,
             length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
             coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words
           FROM d LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
     f AS (SELECT host, count(*) AS n, rule, count(*) FILTER (WHERE failed) AS bad FROM (
             SELECT host, unnest([
               {'rule': 'short', 'failed': n_words < 20},
               {'rule': 'repeated', 'failed': 100 * n_repeat_words > 30 * n_words},
               {'rule': 'symbols', 'failed': 10 * n_symbols > n_words},
               {'rule': 'long_words', 'failed': word_chars > 15 * n_words},
               {'rule': 'dup_lines', 'failed': 10 * n_dup_lines > n_words}], recursive := true)
             FROM c WHERE host IS NOT NULL) GROUP BY host, rule),
     m AS (SELECT rule, sum(bad) / sum(n) AS mean, sum(bad * bad / n) / sum(n) AS square, count(*) AS hosts, sum(n) AS docs
           FROM f GROUP BY rule),
     p AS (SELECT *, mean * (1 - mean) / greatest(square - mean * mean - mean * (1 - mean) * hosts / docs, 1e-9) - 1 AS strength,
             square - mean * mean - mean * (1 - mean) * hosts / docs > 1e-9 AS varies FROM m),
     b AS (SELECT host, rule, mean, varies, greatest(strength, 1e-6) * mean + bad AS a,
             greatest(strength, 1e-6) * (1 - mean) + n - bad AS b FROM f JOIN p USING (rule)),
     -- The density above three times the common rate, by Simpson's rule.
     h AS (SELECT host, rule, CASE WHEN varies THEN a / (a + b) ELSE mean END AS rate,
             CASE WHEN varies AND 3 * mean < 1 THEN (1 - 3 * mean) / 6000 * list_sum([
               CASE WHEN k % 2000 = 0 THEN 1 WHEN k % 2 = 1 THEN 4 ELSE 2 END
               * CASE WHEN k = 2000 THEN 0 ELSE exp((a - 1) * ln(3 * mean + (1 - 3 * mean) * k / 2000)
                   + (b - 1) * ln((1 - 3 * mean) * (1 - k / 2000)) - lgamma(a) - lgamma(b) + lgamma(a + b)) END
               FOR k IN range(0, 2001)]) ELSE 0 END AS worse FROM b),
     j AS (SELECT host, max(worse) >= 0.99 AS rejected,
             round(max(rate) FILTER (WHERE rule = 'short'), 9) AS short_rate,
             round(max(rate) FILTER (WHERE rule = 'repeated'), 9) AS repeated_rate,
             round(max(rate) FILTER (WHERE rule = 'symbols'), 9) AS symbols_rate,
             round(max(rate) FILTER (WHERE rule = 'long_words'), 9) AS long_words_rate,
             round(max(rate) FILTER (WHERE rule = 'dup_lines'), 9) AS dup_lines_rate FROM h GROUP BY host)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed, coalesce(rejected, false) AS host_rejected,
       short_rate, repeated_rate, symbols_rate, long_words_rate, dup_lines_rate,
       NOT (n_words < 20 OR 100 * n_repeat_words > 30 * n_words) AND NOT coalesce(rejected, false) AS kept
FROM c LEFT JOIN j USING (host)
"""

_OP3 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
     d AS (SELECT page_id, strlen(payload) AS n, sha256(payload) AS digest FROM p),
     f AS (SELECT digest, min(page_id) AS first FROM d WHERE n >= 100 GROUP BY digest)
SELECT page_id, n AS payload_bytes, digest AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM d LEFT JOIN f USING (digest)
"""

_OP4 = r"""
WITH r AS (SELECT page_id, url, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
     h AS (SELECT page_id, url,
             translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM r),
     q AS (SELECT *, list_sort(list_filter(string_split(regexp_extract(regexp_replace(url, '(?s)#.*$', ''), '(?s)\?(.*)$', 1), '&'),
             lambda x: x <> '' AND NOT starts_with(x, 'utm_'))) AS kept FROM h),
     c AS (SELECT *, regexp_replace(host, ':(80|443)$', '') || regexp_replace(path, '/+$', '')
             || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END AS canonical FROM q),
     l AS (SELECT canonical FROM c WHERE host <> '' GROUP BY canonical HAVING count(*) > 1),
     m AS (SELECT c.*, l.canonical IS NOT NULL AND host <> '' AS listed,
             CASE WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
                  WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
                  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
                  WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
                  WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule
           FROM c LEFT JOIN l USING (canonical))
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL THEN 'block'
            WHEN listed THEN 'block' ELSE 'allow' END AS verdict
FROM m
"""

_OP5 = r"""
WITH b AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
           FROM benchmark),
     w AS (SELECT DISTINCT item, words[i : i + 9] AS win FROM (
             SELECT item, words, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS i FROM b WHERE len(words) > 0)),
     z AS (SELECT DISTINCT len(win) AS size FROM w),
     d AS (SELECT doc_id, regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
           FROM documents),
     g AS (SELECT doc_id, i, words[i : i + size - 1] AS win FROM (
             SELECT doc_id, words, size, unnest(range(1, len(words) - size + 2)) AS i FROM d, z WHERE len(words) >= size)),
     h AS (SELECT doc_id, i, item, len(win) AS size FROM g JOIN w USING (win)),
     n AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS pos FROM h) GROUP BY doc_id),
     t AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
           FROM (SELECT DISTINCT doc_id, item FROM h) GROUP BY doc_id)
SELECT doc_id, coalesce(len(words), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN t USING (doc_id)
"""

_OP11 = r"""
WITH l AS (SELECT doc_id, generate_subscripts(x, 1) AS pos, unnest(x) AS line
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
     k AS (SELECT *, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                               'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
     s AS (SELECT key, max(doc_id) AS last FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
     j AS (SELECT k.doc_id, k.pos, k.line, coalesce(k.doc_id <> s.last, false) AS dropped FROM k LEFT JOIN s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM j GROUP BY doc_id
"""

_OP12 = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
     t AS (SELECT count(*) FILTER (WHERE len(terms) > 0) AS n_docs, sum(len(terms))::BIGINT AS n_words FROM d),
     q AS (SELECT item_id, term, count(*) AS times FROM (
             SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
     p AS (SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(terms) AS n, unnest(terms) AS term FROM d)
           WHERE term IN (SELECT term FROM q) GROUP BY ALL),
     w AS (SELECT term, floor(1000 * ln((2 * any_value(n_docs) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM p, t GROUP BY term),
     i AS (SELECT doc_id, term, (1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * n_docs) // n_words)) AS impact FROM p, t),
     s AS (SELECT item_id, doc_id, sum(times * w * impact)::BIGINT AS score
           FROM q JOIN w USING (term) JOIN i USING (term) GROUP BY item_id, doc_id)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
FROM s WHERE score > 0 QUALIFY rank <= 10
"""

_OP13 = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
     w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS words FROM p),
     u AS (SELECT lang, words, unnest(range(1, len(words) + 1)) AS i FROM w),
     g AS (SELECT lang, k, words[i : i + k - 1] AS phrase, count(*) AS f FROM u, (SELECT unnest([1, 2, 3, 4]) AS k)
           WHERE i + k - 1 <= len(words) GROUP BY ALL),
     t AS (SELECT lang, sum(f)::BIGINT AS n FROM g WHERE k = 1 GROUP BY lang),
     c AS (SELECT * FROM g WHERE k > 1 AND f >= 30),
     m AS (SELECT lang, words, max(f) AS most FROM (
             SELECT lang, f, unnest([phrase[i : i + s - 1] FOR i IN range(1, k - s + 2)]) AS words
             FROM c, (SELECT unnest([2, 3]) AS s) WHERE s < k) GROUP BY ALL),
     a AS (SELECT c.* FROM c LEFT JOIN m ON m.lang = c.lang AND m.words = c.phrase WHERE most IS NULL OR 100 * most < 80 * f),
     s AS (SELECT a.lang, a.phrase, a.f AS a, j, l.f AS l, r.f AS r, ((2000000::HUGEINT * a.f) // (l.f + r.f))::BIGINT AS score
           FROM a, (SELECT unnest([1, 2, 3]) AS j), g AS l, g AS r
           WHERE j < a.k AND l.lang = a.lang AND r.lang = a.lang AND l.phrase = a.phrase[1 : j] AND r.phrase = a.phrase[j + 1 :]),
     b AS (SELECT lang, array_to_string(phrase, ' ') AS phrase, a, l, r, score FROM s
           QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM b JOIN t USING (lang) QUALIFY rank <= 2000
"""

#: The others are beyond SQL, or too slow in it on whole tables; tests hold them against brute force.
ORACLES = {
    "op1_host_rules": _OP1,
    "op3_warc_zstd": _OP3,
    "op4_url_filter": _OP4.replace("\\\\", "\\"),
    "op5_fm_decontamination": _OP5,
    "op11_line_dedup": _OP11,
    "op12_blas_search": _OP12,
    "op13_collocations": _OP13,
}
