"""Ranked search against a plain loop; sums that would pass 2^53 in one product."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from linkloom.llm import blas_search
from linkloom.llm.blas_search import Best, ItemTile, best_documents

TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
DOCS = "doc_id long, text string, score string, part int, terms string"
ITEMS = "item_id string, text string, rank int"


def terms(text):
    return re.findall(TERM, re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def expected(docs, items, k=10):
    bags = [(d, Counter(terms(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, n_words = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for item, text in items:
        asked.setdefault(item, Counter()).update(terms(text))
    out = []
    for item, bag in asked.items():
        scores = []
        for doc, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // n_words
            score = 0
            for t, times in bag.items():
                if t in b:
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += times * w * (1_000_000_000 * b[t] // (1000 * b[t] + 8 * m))
            if score > 0:
                scores.append((-score, doc is None, doc or 0, doc))
        out += [(item, i + 1, doc, -s) for i, (s, _, _, doc) in enumerate(sorted(scores, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def tables():
    rng = random.Random(8)
    words = [f"w{i}" for i in range(300)] + ["Ñandú", "É", "A1", "zwei_worte", "a-b", "ſ", "K"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    docs = [(i, text(rng.randrange(1, 80))) for i in range(700)]
    docs += [(1000 + i, "w1 w2 w3") for i in range(40)] + [(5, "w1 w2 w3")] * 3 + [(None, "w1 w2 w3")] * 2
    docs += [(-7, None), (-8, ""), (-9, "... --"), (-10, "w1 " * 400_000 + text(50)), (-11, text(200_000))]
    items = [(f"i{i}", text(rng.randrange(0, 30))) for i in range(150)]
    items += [("i0", text(5)), ("twice", "w1 w2"), ("twice", "w1 w2"), (None, "W3"), ("none", None), ("off", "unknown")]
    items += [("long", text(20_000))]
    return docs, items


@pytest.mark.parametrize("block_words", [blas_search.BLOCK_WORDS, 900])
def test_search_against_brute_force(spark, block_words):
    docs, items = tables()
    given = spark.createDataFrame([(d, t, "x", 1, "y") for d, t in docs], DOCS).repartition(7)
    asked = spark.createDataFrame([(i, t, 3) for i, t in items], ITEMS)
    got = best_documents(given, asked, block_words=block_words)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs, items)


def test_no_rows(spark):
    docs, items = tables()
    none, some = spark.createDataFrame([], DOCS), spark.createDataFrame(docs[:9], "doc_id long, text string")
    asked = spark.createDataFrame(items, "item_id string, text string")
    assert best_documents(none, asked).collect() == []
    assert best_documents(some, asked.limit(0)).collect() == []
    assert best_documents(some.where("text = ''"), asked).collect() == []


def test_products_beyond_doubles_are_exact():
    rng = np.random.default_rng(2)
    weights = rng.integers(0, 1 << 31, (5, 1500))
    impact = rng.integers(999_000, 1_000_000, (1500, 3))
    weights[0] = (1 << 31) - 1
    exact = [[sum(int(a) * int(b) for a, b in zip(w, i)) for i in impact.T] for w in weights]
    exact = np.array(exact, dtype=object)
    assert any(x > 1 << 53 for x in exact.ravel())
    tile = ItemTile(0, weights, np.arange(1500) * 2, 3000)
    doc, term = np.tile(np.arange(3), 1500), np.repeat(np.arange(1500) * 2, 3)
    got = tile.scores(doc, term, impact.ravel().astype(float), 3)
    assert (got.astype(object) == exact).all()
    assert all(part.shape[1] <= 512 and part.max() < 1 << 24 for _, _, part in tile.parts)


def test_best_keeps_smallest_ids_of_equal_scores():
    best = Best(1, 3)
    for ids in ([9, 8, 7], [6, 20, 5], [30, 4, 3]):
        best.add(0, np.array([[5, 5, 5]]), np.array(ids), np.array([ids[0] == 30, 0, 0]))
    assert best.rows[0].tolist() == [[5, 5, 5], [0, 0, 0], [3, 4, 5]]
