"""Tokens don't depend on how rows reach the two scans of a text."""

import random

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from linkloom.llm import lattice


def test_rows_that_come_in_another_order_each_scan(spark, sf_dir, monkeypatch):
    monkeypatch.setattr(lattice, "PACK_BYTES", 4000)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 120").select("doc_id", "text")
    docs = docs.unionByName(docs.where("doc_id < 9")).unionByName(docs.where("doc_id < 9"))
    want = lattice.encoded(docs, cache_texts=5).collect()

    def shuffled(batches):
        rng = random.Random()
        for batch in batches:
            order = list(range(batch.num_rows))
            rng.shuffle(order)
            yield batch.take(pa.array(order))

    restless = docs.coalesce(1).mapInArrow(shuffled, docs.schema)
    got = lattice.encoded(restless, cache_texts=5).collect()
    key = lambda rows: sorted((r["doc_id"], tuple(r["ids"]), r["round_trip"]) for r in rows)
    assert key(got) == key(want) and len(got) == docs.count()
    assert restless.select(F.count("*")).first()[0] == docs.count()


def test_edges_of_many_words_fold_at_once():
    model = lattice.load_vocabulary()
    places = {p: i for i, p in enumerate(model.pieces) if model.usable[i]}
    rng = random.Random(5)
    words = ["▁the", "▁ññé😀", "▁" + "undoing" * 290, "x"]
    words += ["▁" + "".join(rng.choice("theraiosn日") for _ in range(rng.randrange(30))) for _ in range(200)]
    whose, edges = [], []
    for k, word in enumerate(words):
        for end in range(1, len(word) + 1):
            for size in range(1, min(model.longest, end) + 1):
                at = places.get(word[end - size : end], -1)
                if at >= 0 or size == 1:
                    whose.append(k)
                    edges.append(end << lattice.END_AT | size << lattice.PIECE_BITS | at + 1)
    order = list(range(len(edges)))
    rng.shuffle(order)
    costs = np.append(model.costs, model.unknown_cost)
    paths = lattice.fold_edges(np.array(whose)[order], np.array(edges)[order], len(words), costs)
    assert paths.to_pylist() == [lattice.fold_run(w, model, places) for w in words]
    assert lattice.fold_edges(np.zeros(0, np.int64), np.zeros(0, np.int64), 0, costs).to_pylist() == []


def test_words_of_a_pack_are_not_grouped_one_by_one(spark, sf_dir):
    """Edges are grouped by pack alone; grouping by word sorted every edge, at 969 CPU seconds a GB."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id < 40")
    plan = lattice.encoded(docs, cache_texts=5)._jdf.queryExecution().optimizedPlan().toString()
    groups = [line for line in plan.splitlines() if "Aggregate [" in line]
    assert len(groups) == 1 and groups[0].split("Aggregate [")[1].startswith("pack#")
    assert "word" not in groups[0].split("]")[0]
