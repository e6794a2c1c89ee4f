"""Shared lines against brute force; the perfect hash by itself."""

import hashlib
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from linkloom.llm.line_dedup import PerfectHash, fingerprints, split_lines, without_shared_lines

SCHEMA = "doc_id long, text string, slice string, n_lines string, found long"
SPACE = "\x20\t\n\x0b\x0c\r"


def key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(SPACE))


def expected(rows, least=3, chars=20):
    """A row is a document; NULL ids are below all others."""
    held = defaultdict(list)
    for at, (doc, text) in enumerate(rows):
        for k in {key(x) for x in (text or "").split("\n")}:
            held[k].append((at, doc))
    out = []
    for doc, text in rows:
        lines, kept = (text or "").split("\n"), []
        for line in lines:
            docs = held[key(line)]
            last = max((d for _, d in docs if d is not None), default=None)
            if len(key(line)) < chars or len(docs) < least or last is None or doc == last:
                kept.append(line)
        digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((doc, len(lines), len(lines) - len(kept), digest))
    return sorted(out, key=str)


def rows():
    rng = random.Random(3)
    shared = [f"A line of the footer, number {i} of many" for i in range(9)]
    shared += ["é" * 20, "é" * 19, "x" * 20, "İstanbul is a city on two continents", " " * 40, "short"]
    shared += ["  Padded line with white space \x0b\r", "padded line with white space", "a " * 12 + " "]
    out = [(0, None), (1, ""), (2, "\n"), (3, "\n\n" + shared[0]), (3, shared[0]), (3, shared[0])]
    out += [(None, "only rows without an id have it\n" + shared[1])] * 4
    for i in range(4, 120):
        lines = [rng.choice([*shared, f"own line {rng.randrange(10**9)} of document {i}"]) for _ in range(rng.randrange(9))]
        out.append((i, "\n".join(rng.choice([x, x.upper(), f"\t{x} "]) for x in lines)))
    return out + [(200, "\n".join([shared[2]] * 200_000)), (201, "z" * 10_000_000 + "\n" + shared[2])]


def test_lines_against_brute_force(spark):
    given = rows()
    docs = spark.createDataFrame([(d, t, "s", "n", 7) for d, t in given], SCHEMA).repartition(5)
    got = without_shared_lines(docs)
    assert got.columns == ["doc_id", "text", "slice", "found", "n_lines", "n_dropped", "kept_sha256"]
    found = got.collect()
    assert sorted([(r.doc_id, r.n_lines, r.n_dropped, r.kept_sha256) for r in found], key=str) == expected(given)
    assert {(r.slice, r.found) for r in found} == {("s", 7)}
    assert all(hashlib.sha256((r.text or "").encode()).hexdigest() == r.kept_sha256 for r in found)
    assert {r.text for r in found if r.doc_id == 0} == {None}


@pytest.mark.parametrize("least, chars", [(2, 5), (5, 1)])
def test_other_limits(spark, least, chars):
    given = rows()[:80]
    docs = spark.createDataFrame(given, "doc_id int, text string").repartition(3)
    got = without_shared_lines(docs, least, chars).select("doc_id", "n_lines", "n_dropped", "kept_sha256")
    assert sorted(map(tuple, got.collect()), key=str) == expected(given, least, chars)


def test_no_rows(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert without_shared_lines(docs).collect() == []


def test_perfect_hash_is_minimal():
    rng = np.random.default_rng(1)
    keys = rng.integers(0, 2**64, (50_000, 2), dtype=np.uint64)
    keys[:1000, 0] = 5  # half a hash in common is not the same key
    hashed = PerfectHash.build(keys)
    assert np.array_equal(np.sort(hashed.places(keys)), np.arange(len(keys)))
    assert len(hashed.bits) < 5 * len(keys)
    other = rng.integers(0, 2**64, (50_000, 2), dtype=np.uint64)
    place = hashed.places(other)
    prints = np.empty(len(keys), dtype=np.uint64)
    prints[hashed.places(keys)] = fingerprints(keys)
    assert not (prints[place[place >= 0]] == fingerprints(other[place >= 0])).any()
    assert len(PerfectHash.build(keys[:0]).places(other)) == len(other)


def test_lines_of_an_empty_batch():
    import pyarrow as pa

    assert len(split_lines(pa.array([], pa.string())).start) == 0
    assert split_lines(pa.array([None, "", "a\n"])).doc.tolist() == [0, 1, 2, 2]
