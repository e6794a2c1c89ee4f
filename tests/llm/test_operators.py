"""Operators against brute force, on texts with the awkward cases among them."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm import chat_hmm, decontaminate, host_rules, lattice, nbsvm, pii, queries, simhash, toxicity, url_filter, warc_zstd

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp string, label string"
WORD = r"[^\x20\x09-\x0D]+"


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    words = ["alpha", "Beta", "é", "ñandú", "x", "the", "of", "#", "a|b", "10.0.0.1", "zz y"]
    out = [None, "", " \n\t", "one", "one two", "A\n\nA\nb\nA ", "w " * 30, "a b c d e f g h " * 3, "é" * 3000]
    for _ in range(60):
        out.append(" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) + rng.choice(["", "\n"]))
    out += [out[20], out[20] + " tail", out[21]]
    return out


@pytest.fixture(scope="module")
def docs(spark, texts):
    rows = [(i, t, "en", f"s{i % 3}" if i % 7 else None, len(t or ""), "x", "y") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# --- 1 -------------------------------------------------------------------------------


def test_text_counts(docs, texts):
    got = by_id(host_rules.host_verdicts(docs))
    for i, t in enumerate(texts):
        t = t or ""
        words = re.findall(WORD, t)
        lines = [x for x in t.split("\n") if re.search(WORD, x)]
        windows = [tuple(words[k : k + 8]) for k in range(len(words) - 7)]
        inside = {k + j for k, w in enumerate(windows) if windows.count(w) > 1 for j in range(8)}
        want = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))
        assert tuple(got[i][c] for c in host_rules.COUNTS) == want, t[:80]
        assert got[i]["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (got[i]["base_failed"] and got[i]["kept"])


def test_bad_hosts_are_rejected_small_ones_shrunk(spark):
    good = " ".join(f"word{k}" for k in range(40))
    rows = [(i, good if i % 10 else "x", "g" + str(i % 4)) for i in range(400)]
    rows += [(1000 + i, "x" if i % 10 else good, "bad") for i in range(100)] + [(2000, "x", "tiny")]
    got = by_id(host_rules.host_verdicts(spark.createDataFrame(rows, "doc_id long, text string, source string")))
    assert got[1000]["host_rejected"] and not got[1]["host_rejected"]
    assert got[1]["kept"] and not got[1000]["kept"]


# --- 2, 6 ----------------------------------------------------------------------------


def test_held_out_quality(spark, sf_dir):
    big = sf_dir.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = nbsvm.quality_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 for r in rows)
    good = [r["predicted"] for r in rows if r["quality"]]
    bad = [r["predicted"] for r in rows if not r["quality"]]
    assert np.mean(good) > 0.99 and np.mean(bad) < 0.1


def test_held_out_toxicity(spark, sf_dir):
    big = sf_dir.replace("sf0.01", "sf0.1")
    docs, labels = (spark.read.parquet(f"{big}/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.toxicity_scores(docs, labels).join(labels, "doc_id").where("held_out").collect()
    toxic = [r["predicted"] for r in rows if r["toxic"]]
    clean = [r["predicted"] for r in rows if not r["toxic"]]
    assert np.mean(toxic) > 0.85 and np.mean(clean) < 0.04


@pytest.mark.parametrize("score", [nbsvm.quality_scores, toxicity.toxicity_scores])
def test_scores_of_awkward_texts(spark, docs, empty, score):
    rows = [(i, i % 2, i % 2) for i in range(0, 60)] + [(None, 1, 1), (3, None, None)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    got = score(docs, labels).collect()
    assert len(got) == docs.count() and all(0 <= r["score"] <= 1 for r in got)
    none = labels.limit(0)
    assert {r["score"] for r in score(docs, none).collect()} == {0.5}
    assert score(empty, labels).count() == 0


def test_hinge_loss_separates():
    rng = np.random.default_rng(0)
    row = np.repeat(np.arange(40), 3)
    bucket = np.where(row % 2, 1, 2) * 10 + rng.integers(0, 3, len(row))
    sign = np.where(np.arange(40) % 2, 1.0, -1.0)
    w, b = nbsvm.dual_coordinate_descent(row, bucket, np.ones(len(row)), sign, np.ones(40), 50)
    assert (np.sign(np.bincount(row, w[bucket]) + b) == sign).all()


# --- 3 -------------------------------------------------------------------------------


def test_warc_round_trip_and_damage(spark):
    html = "<p>page é</p>" * 50
    rows = [(i, f"http://h/{i}", html if i % 3 else f"own {i} " * 40) for i in range(60)]
    rows += [(100, None, None), (101, "http://h/\r\nX: y", "short"), (102, "u", "short"), (103, "u", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archives = warc_zstd.write_archives(pages).collect()
    got = {r["page_id"]: r for r in warc_zstd.read_archives(spark.createDataFrame(archives)).collect()}
    assert len(got) == len(rows)
    for i, url, text in rows:
        raw = (text or "").encode()
        first = min(j for j, _, t in rows if t == text)
        refers = first if len(raw) >= 100 and i > first else None
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"], r["refers_to"]) == (len(raw), hashlib.sha256(raw).hexdigest(), refers)
        assert r["record_type"] == ("revisit" if refers is not None else "response") and r["error"] is None
        assert refers is not None or bytes(r["payload"]) == raw
    content = bytes(max(archives, key=lambda a: len(a["content"]))["content"])
    whole = list(warc_zstd.records(content))
    at = [r["offset"] for r in whole]
    broken = bytearray(content)
    broken[at[2] + 12] ^= 0xFF
    found = list(warc_zstd.records(bytes(broken)))
    assert any(r.get("error") for r in found) and sum(not r.get("error") for r in found) >= len(whole) - 2
    assert list(warc_zstd.records(content[:-3]))[-1]["error"]
    assert list(warc_zstd.records(b"")) == []
    assert warc_zstd.write_archives(pages.limit(0)).count() == 0


def test_revisits_go_by_payload(spark):
    a, b, c = ("<p>a</p>" * 40, "<p>b</p>" * 40, "<p>c</p>" * 40)
    rows = [(1, a), (2, b), (5, a), (5, c), (6, a), (6, b), (6, b), (None, a), (None, c)]
    pages = spark.createDataFrame([(i, "u", t) for i, t in rows], "page_id long, url string, html string")
    found = warc_zstd.read_archives(warc_zstd.write_archives(pages)).collect()
    got = sorted(((r["page_id"], r["payload_digest"], r["refers_to"]) for r in found), key=str)
    digest = {t: hashlib.sha256(t.encode()).hexdigest() for t in (a, b, c)}
    refers = {(5, a): 1, (6, a): 1, (6, b): 2}
    assert got == sorted(((i, digest[t], refers.get((i, t))) for i, t in rows), key=str)
    assert {r["payload_digest"] for r in found if r["payload"]} == set(digest.values())


def test_unreadable_record_raises(spark, monkeypatch, tmp_path):
    pages = spark.createDataFrame([(i, "u", f"page {i} " * 30) for i in range(5)], "page_id long, url string, html string")
    pages.write.parquet(f"{tmp_path}/pages.parquet")
    assert queries.op3_warc_zstd(spark, str(tmp_path)).count() == 5
    cut = warc_zstd.write_archives(pages).select("archive", F.expr("substring(content, 1, length(content) - 3)").alias("content"))
    monkeypatch.setattr(warc_zstd, "write_archives", lambda pages: cut)
    for use in (DataFrame.collect, DataFrame.count):
        with pytest.raises(Exception, match="unreadable record"):
            use(queries.op3_warc_zstd(spark, str(tmp_path)))


@pytest.mark.parametrize("raw", [b"", b"WARC/1.1\r\nA: b\r\n\r\n", b"WARC/1.1\r\nWARC-Type: response\r\nWARC-Record-ID: <x>\r\nWARC-Date: d\r\nContent-Length: 9\r\n\r\nabc\r\n\r\n"])
def test_bad_records(raw):
    with pytest.raises(warc_zstd.BadRecord):
        warc_zstd.parsed(raw)


# --- 4 -------------------------------------------------------------------------------


def test_listed_keys_is_exact(spark):
    rows = spark.createDataFrame([(i, f"k{i % 300}") for i in range(900)] + [(-1, None)], "page_id long, key string")
    listed = spark.createDataFrame([(f"k{i}",) for i in range(0, 300, 7)], "key string")
    for blocks in (1, 64):  # one block lets nearly everything through the filter
        got = url_filter.listed_keys(rows, listed, "key", blocks).collect()
        assert len(got) == 901
        assert all(r["listed"] == (r["key"] is not None and int(r["key"][1:]) % 7 == 0) for r in got)


def test_urls_are_judged(spark):
    urls = [None, "nothing", "HTTP://WWW.Example.COM/en/x", "http://example.com/en/", "http://a.b.net/es/1?x#y",
            "http://net", "http://notnet/es/", "http://x.org/a/?utm_s=1&b=2#f", "https://x.org:443/a?b=2", "http://x.org/ä\n?q"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    rules = (("allow", "com/"), ("block", "example.com/en/"), ("allow", "www.example.com/en/"), ("block", "net/es/"))
    listed = spark.createDataFrame([("http://X.org/a?b=2",), (None,), ("zz",)], "url string")
    got = {r["page_id"]: tuple(r)[1:] for r in url_filter.judged_urls(pages, listed, rules).collect()}
    assert got[0] == got[1] == ("", "", None, "allow")
    assert got[2] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[3][2:] == ("example.com/en/", "block") and got[4] == ("a.b.net", "/es/1", "net/es/", "block")
    assert got[5] == ("net", "", None, "allow") and got[6][2] is None
    assert got[7][3] == got[8][3] == "block" and got[9] == ("x.org", "/ä\n", None, "allow")


# --- 5 -------------------------------------------------------------------------------


def words5(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


@pytest.mark.parametrize("block", [200_000, 3])
def test_contamination(spark, docs, texts, empty, block):
    items = [(1, texts[20]), (2, "ALPHA beta"), (3, None), (11, ""), (12, texts[21]), (2, "the of the"), (5, "é" * 3000)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_contamination(docs.select("doc_id", "text"), bench, block=block)
    got = {r["doc_id"]: r for r in found.collect()}
    report = by_id(decontaminate.contamination_report(docs, bench, block=block))
    for i, t in enumerate(texts):
        words, hit, held = words5(t), set(), set()
        for item, text in items:
            own = words5(text)
            for k in range(max(1, len(own) - 9) if own else 0):
                window = own[k : k + 10]
                for p in range(len(words) - len(window) + 1):
                    if words[p : p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        held.add(str(item))
        spans = {p for s in got[i]["_spans"] for p in range(s["start"], s["end"])}
        assert (spans, got[i]["_words"]) == (hit, len(words)), (i, t and t[:60])
        digest = hashlib.sha256(",".join(sorted(held)).encode()).hexdigest()
        assert tuple(report[i]) == (i, len(words), len(hit), len(held), digest, bool(hit))
    assert decontaminate.contamination_report(docs, bench.limit(0)).where("contaminated").count() == 0
    assert decontaminate.contamination_report(empty, bench).count() == 0
    clean = by_id(decontaminate.decontaminated(docs, bench))
    assert set(clean) == {i for i, t in enumerate(texts) if not words5(t) or got[i]["_words"] > sum(s["end"] - s["start"] for s in got[i]["_spans"])}
    assert all(clean[i]["text"] == texts[i] for i in clean if not got[i]["_spans"])


# --- 7 -------------------------------------------------------------------------------


def test_roles_are_recovered(spark, sf_dir):
    conversations = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = chat_hmm.recovered_turns(conversations).withColumnRenamed("role", "found")
    both = conversations.join(turns, ["conv_id", "turn"], "left")
    right = both.where(F.col("role") == F.col("found")).count()
    assert right / conversations.count() > 0.9
    assert chat_hmm.recovered_turns(conversations.limit(0)).count() == 0


def test_blocks_give_the_best_path_of_the_whole(spark):
    rng = random.Random(2)
    heads = ["User: ", "Assistant: ", "", "", "System: "]
    lines = [(c, n, rng.choice(heads) + "x" * rng.randrange(60)) for c in range(3) for n in range(60)]
    lines += [(None, 0, "A: lost"), (9, 0, None), (9, 0, None)]
    frame = spark.createDataFrame(lines, "conv_id long, line_no long, line string")
    rng = np.random.default_rng(1)
    model = chat_hmm.Model(*(np.log(rng.random(s)) for s in ((9,), (9, 9), (9, chat_hmm.SYMBOLS))))
    def roles(span):
        got = chat_hmm.parsed_turns(frame, model, block_span=span).orderBy("conv_id", "line_no").collect()
        return {(r["conv_id"], r["line_no"] + k): r["role"] for r in got for k in range(r["n_lines"])}
    assert roles(7) == roles(1000) and len(roles(7)) == 182


# --- 8 -------------------------------------------------------------------------------

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"


def test_turns_do_not_depend_on_blocks(spark):
    rng = random.Random(3)
    rows = []
    for conv in range(4):
        lines = []
        while len(lines) < 60:
            who = rng.choice(["User: ", "Assistant: "])
            lines += [who + "says"] + [rng.choice(["more words", "a: b", ""]) for _ in range(rng.randrange(25))] + [""]
        rows += [(conv, i, line) for i, line in enumerate(lines)]
    frame = spark.createDataFrame(rows, "conv_id long, line_no long, line string")
    role = F.when(F.col("line").startswith("Assistant"), "assistant").when(F.col("line").startswith("User"), "user")
    kind = F.when(role.isNotNull(), "start").when(F.col("line") == "", "gap").otherwise("inside")
    known = frame.select("*", F.coalesce(role, F.lit("user")).alias("role"), kind.alias("kind"), F.lit(0).alias("block"))
    model = chat_hmm.fit(known)

    def turns(span):
        return sorted(tuple(r) for r in chat_hmm.parsed_turns(frame, model, block_span=span).collect())

    whole = turns(4096)
    assert max(r[3] for r in whole) > 8 and sum(r[3] for r in whole) == len(rows)
    assert turns(3) == whole and turns(7) == whole


def brute_spans(t):
    digits = lambda s: re.sub("[^0-9]", "", s)
    luhn = lambda d: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(d[::-1])) % 10 == 0
    out = [(0, *m.span()) for m in re.finditer(EMAIL, t)]
    out += [(1, *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(2, *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(3, *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m[0])) <= 15]
    return out


def test_base_spans_equal_the_patterns():
    rng = random.Random(3)
    alphabet = ["a", "B.", "@", "1", "25", "255", ".", "+", " ", "-", "(", ")", "4111111111111111", "é", "x@y.z", "+1 555 123 4567", "_", "%", "\n"]
    for _ in range(3000):
        t = "".join(rng.choice(alphabet) for _ in range(rng.randrange(40)))
        assert sorted(pii.base_spans(t)) == sorted(brute_spans(t)), t


def test_personal_data_and_redaction(spark, docs, empty):
    rows = [(1, "mail me: é.x@mail.com, card 4111 1111 1111 1111; +1 (988) 555-2485, 10.0.0.1"), (2, None), (3, "1" * 5000 + "@" * 5000), (4, "call (415) 555-2671 now")]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = by_id(pii.personal_data(frame))
    names = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in sorted(brute_spans(rows[0][1]))]
    assert tuple(got[1])[1:5] == (1, 1, 1, 1)
    assert got[1]["base_sha256"] == hashlib.sha256(",".join(names).encode()).hexdigest() and got[1]["spans"].startswith(",".join(names)[:20])
    assert got[2]["spans"] == got[3]["spans"] == "" and got[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = by_id(pii.redacted(frame))
    assert clean[1]["text"] == "mail me: é[EMAIL], card [CARD]; [PHONE], [IP]" and clean[2]["text"] is None and clean[3]["text"] == rows[2][1]
    assert pii.redacted(empty).columns == empty.columns and pii.personal_data(empty).count() == 0
    assert pii.redacted(docs).count() == docs.count()


# --- 9 -------------------------------------------------------------------------------


def test_tokens(spark, docs, texts, empty):
    model = lattice.load_vocabulary()
    places = {p: i for i, p in enumerate(model.pieces) if model.usable[i]}

    def brute(t):
        run = lattice.SPACE + t.replace(" ", lattice.SPACE)
        path, at, out = lattice.fold_run(run, model, places), len(run), []
        while at:
            piece = path[at - 1]
            out += [piece] if piece >= 0 else [int(model.bytes_at[b]) for b in reversed(run[at - 1].encode())]
            at -= len(model.pieces[piece]) if piece >= 0 else 1
        return out[::-1]

    extra = spark.createDataFrame([(900, "😀 日本  \t"), (901, "a" * 5000), (902, texts[20])], "doc_id long, text string")
    frame = docs.select("doc_id", "text").unionByName(extra)
    for sample in (2, 1000):
        got = by_id(lattice.encoded(frame, cache_texts=sample))
        assert len(got) == len(texts) + 3
        for i, t in [*enumerate(texts), (900, "😀 日本  \t"), (901, "a" * 5000), (902, texts[20])]:
            assert got[i]["ids"] == (brute(t) if t else []) and got[i]["n_tokens"] == len(got[i]["ids"])
            assert got[i]["round_trip"]
            back = lattice.decode(pa.array([got[i]["ids"]], pa.list_(pa.int32())), model)[0].as_py()
            assert back == (t or "")
    assert lattice.encoded(empty).count() == 0


# --- 10 ------------------------------------------------------------------------------


def brute_fingerprint(t):
    words = re.findall(WORD, re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
    shingles = [" ".join(words[k : k + 3]) for k in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(values, distance):
    names = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i in range(len(values)):
            for j in range(i):
                if (values[i] ^ values[j]).bit_count() <= distance and names[i] != names[j]:
                    low, high = sorted((names[i], names[j]))
                    names = [low if n == high else n for n in names]
                    changed = True
    return names


def test_near_duplicates(docs, texts, empty):
    got = by_id(simhash.near_duplicates(docs))
    prints = [brute_fingerprint(t) for t in texts]
    assert [got[i]["fingerprint"] for i in range(len(texts))] == [f"{p:016x}" for p in prints]
    assert [got[i]["component_id"] for i in range(len(texts))] == brute_components(prints, 3)
    assert simhash.near_duplicates(empty).count() == 0
    kept = by_id(simhash.one_per_component(docs))
    assert set(kept) == set(brute_components(prints, 3)) and kept[4]["label"] == "y"


def test_each_component_keeps_one_row(spark):
    rng = random.Random(9)
    a, b, *others = (" ".join(rng.choice("abcdefghijklmnop") * 3 for _ in range(40)) for _ in range(12))
    near = a.upper()  # the same words, another text
    rows = [(3, near), (7, a), (7, b)] + [(None, t) for t in others] + [(None, others[0])] * 2 + [(None, None), (None, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(((r["doc_id"], r["text"]) for r in simhash.one_per_component(frame).collect()), key=str)
    wordless = [r for r in got if not r[1]]
    assert len(wordless) == 1 and wordless[0][0] is None
    assert [r for r in got if r[1]] == sorted([(3, near), (7, b)] + [(None, t) for t in others], key=str)
    # More rows alike than a thousandth, and too few of them: both ways to the same rows.
    many = spark.createDataFrame([(i, f"{i} {i * i} {i * 7} z") for i in range(3000)] + [(5000, a)] * 2, frame.schema)
    found = [tuple(r) for r in simhash.one_per_component(many.unionByName(many)).collect()]
    assert len(found) == len(set(found)) and (5000, a) in found
    assert len(found) == simhash.near_duplicates(many).select("component_id").distinct().count()


@pytest.mark.parametrize("block,small", [(1024, 64), (8, 4)])
def test_links_within_distance(spark, monkeypatch, block, small):
    monkeypatch.setattr(simhash, "BLOCK", block)
    monkeypatch.setattr(simhash, "SMALL_CELL", small)
    rng = random.Random(4)
    values = [rng.getrandbits(64) for _ in range(40)] + [0, (1 << 64) - 1]
    for _ in range(250):  # chains of flips, so that dense cells and long paths occur
        v = rng.choice(values[:12])
        for _ in range(rng.randrange(1, 5)):
            v ^= 1 << rng.randrange(64)
        values.append(v)
    values = sorted(set(values))
    frame = spark.createDataFrame([(v - (1 << 64) if v >> 63 else v,) for v in values], "fp long")
    found = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(frame, 3)).collect()}
    names = brute_components(values, 3)
    groups = {}
    for v, n in zip(values, names, strict=True):
        signed = v - (1 << 64) if v >> 63 else v
        groups.setdefault(n, set()).add(found.get(signed, signed))
    assert all(len(g) == 1 for g in groups.values()) and len(set.union(*groups.values())) == len(groups)
