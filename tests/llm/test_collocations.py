"""Collocations against a plain loop; flows, paths and packs by themselves."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

from linkloom.llm import collocations as c

SCHEMA = "doc_id long, text string, lang string, phrase string, k int, bucket string"


def pieces(text):
    lower = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
        yield re.findall(r"[^\x20\x09]+", piece)


def counted(docs):
    out = defaultdict(Counter)
    for text, lang in docs:
        for words in pieces(text):
            for k in range(1, 5):
                out[lang or "und" if lang is None else lang].update(
                    tuple(words[i : i + k]) for i in range(len(words) - k + 1)
                )
    return out


def expected(docs, least, top=2000):
    out = []
    for lang, f in counted(docs).items():
        n = sum(v for k, v in f.items() if len(k) == 1)
        able = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        most = Counter()
        for p, a in able.items():
            for k in range(2, len(p)):
                for i in range(len(p) - k + 1):
                    most[p[i : i + k]] = max(most[p[i : i + k]], a)
        rows = []
        for p, a in able.items():
            if p in most and 100 * most[p] >= 80 * a:
                continue
            cuts = [(2_000_000 * a // (f[p[:j]] + f[p[j:]]), j) for j in range(1, len(p))]
            score, j = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), f[p[:j]], f[p[j:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


def documents():
    rng = random.Random(4)
    words = ["alpha", "Beta", "gamma", "de", "la", "é", "x y", "#1", "ß", "\x00", "ends"]
    weights = [1 / (i + 1) for i in range(len(words))]
    out = [(None, "en"), ("", "en"), (" \t ", "de"), (".,;", None), ("one", "single"), ("a b c", "\n")]
    for i in range(300):
        text = rng.choice(["", "Alpha "]) + " ".join(rng.choices(words, weights, k=rng.randrange(1, 40)))
        text = re.sub(" ", lambda m: rng.choice([" ", " ", "  ", "\t", ", ", ".\n", " ?"]), text)
        out.append((text, rng.choice(["en", "de", None, "und", ""])))
    out += [("ring of words " * 50, "ring"), ("same same same same same", "ring")] * 3
    out += [("this long line is in every document of the corpus and has many words", "en")] * 40
    return out + [("long text here. " * 30_000 + "tail " * 100_000, "big")]


@pytest.mark.parametrize("least, slice_bytes", [(3, c.SLICE), (12, 2000)])
def test_collocations_against_brute_force(spark, monkeypatch, least, slice_bytes):
    monkeypatch.setattr(c, "SLICE", slice_bytes)
    given = documents()
    docs = spark.createDataFrame([(1, t, x, "p", 2, "b") for t, x in given], SCHEMA).repartition(4)
    got = c.collocations(docs, least)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(map(tuple, got.collect())) == expected(given, least)


def test_counts_are_flows(spark):
    given = documents()
    docs = spark.createDataFrame(given, "text string, lang string").repartition(3)
    got = c.phrase_counts(docs, 1).where("k > 0").collect()
    want = {(lang, " ".join(p)): n for lang, f in counted(given).items() for p, n in f.items()}
    assert {(r.lang, r.phrase): r.f for r in got} == want and len(got) == len(want)


def test_no_rows_and_top(spark):
    assert c.collocations(spark.createDataFrame([], SCHEMA)).collect() == []
    docs = spark.createDataFrame(documents(), "text string, lang string")
    got = c.collocations(docs, 3, top=2).collect()
    assert max(Counter(r.lang for r in got).values()) == 2


def test_paths_cover_every_edge_once(spark, monkeypatch):
    monkeypatch.setattr(c, "PATH_EDGES", 7)
    chain = [f"w{i} w{i + 1} w{i + 2} w{i + 3}" for i in range(20)]
    fork = ["w5 w6 w7 other"]
    ring = ["a b c a", "b c a b", "c a b c", "z z z z"]
    edges = [(lang, e, i + 30) for lang in ("en", "de") for i, e in enumerate(chain + fork + ring)]
    paths = c.compact_paths(spark.createDataFrame(edges, "lang string, phrase string, f long")).collect()
    back = []
    for path in paths:
        assert len(path.words) == len(path.weights) + 3 and len(path.weights) <= 7
        back += [(path.lang, " ".join(path.words[i : i + 4]), w) for i, w in enumerate(path.weights)]
    assert sorted(back) == sorted(edges)
    # w0..w7 and w6..w22, cut at seven edges; the fork and four edges of rings.
    assert len(paths) == 2 * (1 + 3 + 1 + 4)


def test_packs_round_trip():
    rng = np.random.default_rng(1)
    words = pa.array([f"word{i}" for i in range(400)])
    columns, counts = c.distinct_rows(list(rng.integers(0, 401, (4, 5000))), np.full(5000, 300))
    packs = c._packed("en", words, columns, counts, 3, 8)
    names = [None, *words.to_pylist()]
    want = {tuple(names[x] for x in row): n for *row, n in zip(*columns, counts.tolist())}
    known, back, numbers = c._unpacked(packs, 4)
    names = [None, *known.to_pylist()]
    got = {tuple(names[x] for x in row): n for *row, n in zip(*back, numbers.tolist())}
    assert got == want and packs.num_rows == 8
