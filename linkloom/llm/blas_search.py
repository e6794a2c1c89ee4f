"""Ranked lexical search by dense blocked matrix products.

Items come in blocks of a bounded number of words; a block's vocabulary is all that tasks hold
of the items. One pass over the texts turns each document into the numbers of its
terms of that vocabulary and how often they occur; counts over the corpus come from
these rows, and then tiles of items are multiplied with tiles of documents:

    score[item, document] = sum over terms of weight[item, term] * impact[term, document]

Weights and impacts are whole numbers held in float64, where BLAS is exact as long as no sum reaches
2^53. Impacts are below 2^20 (a million), weights go in digits of 24 bits, and a product
takes 512 terms at a time: no partial sum reaches 2^53. Parts are added as 64-bit integers.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.frames import Shared, stored
from linkloom.llm.words import ALNUM, sliced, split_words

K = 10
#: Length normalisation in per cent, saturation in thousandths and its share of it: fixed by the formula.
PART = 75
IMPACT = 1_000_000_000
#: Words of the items that are worked on at once; one longer item is a block by itself.
BLOCK_WORDS = 1 << 18
ITEM_TILE = 64
DOCUMENT_TILE = 512
TERM_TILE = 512
DIGIT = 24
#: Tasks' results are merged in this many parts first.
MERGES = 64


def _terms(column: pa.Array):
    return split_words(column, keep=ALNUM, lower=True)


def _item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term, times``: rows of one id are one item."""
    schema = T.StructType([items.schema["item_id"], T.StructField("term", T.StringType())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text"):
            words = _terms(part.column("text"))
            ids = part.column("item_id").take(pa.array(words.doc))
            yield pa.RecordBatch.from_arrays([ids, words.array()], names=schema.names)

    found = items.select("item_id", "text").mapInArrow(run, schema)
    return stored(found.groupBy("item_id", "term").agg(F.count("*").alias("times")))


def _document_terms(docs: DataFrame, vocabulary: Shared) -> DataFrame:
    """``doc_id, n, terms, times`` of documents with a term: numbers of terms as packed arrays."""
    schema = "doc_id long, n long, terms binary, times binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.value
        for part in sliced(batches, "text"):
            words = _terms(part.column("text"))
            number = pc.fill_null(pc.index_in(words.array(), known), -1).to_numpy()
            listed = number >= 0
            pair, times = np.unique(words.doc[listed] * len(known) + number[listed], return_counts=True)
            doc, term = np.divmod(pair, max(1, len(known)))
            cuts = np.searchsorted(doc, np.arange(words.n_docs + 1))
            n = np.diff(words.first())
            full = np.flatnonzero(n)
            term, times = term.astype("<i4"), times.astype("<i8")
            yield pa.RecordBatch.from_arrays(
                [
                    part.column("doc_id").take(pa.array(full)).cast(pa.int64()),
                    pa.array(n[full], pa.int64()),
                    pa.array([term[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()),
                    pa.array([times[cuts[i] : cuts[i + 1]].tobytes() for i in full], pa.binary()),
                ],
                names=["doc_id", "n", "terms", "times"],
            )

    return stored(docs.select("doc_id", "text").mapInArrow(run, schema))


def _flat(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """All numbers of a column of packed arrays, and how many each row has."""
    sizes = pc.binary_length(column).to_numpy(zero_copy_only=False) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind), sizes


def _holders(documents: DataFrame, n_terms: int) -> np.ndarray:
    """How many documents hold each term: a row a term and task is all that is shuffled."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(n_terms, dtype=np.int64)
        for part in batches:
            held += np.bincount(_flat(part.column("terms"), "<i4")[0], minlength=n_terms)
        at = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(held[at])], names=["term", "df"])

    rows = documents.select("terms").mapInArrow(run, "term long, df long").groupBy("term").agg(F.sum("df").alias("df"))
    out, found = np.zeros(n_terms, dtype=np.int64), rows.toArrow()
    out[found["term"].to_numpy()] = found["df"].to_numpy()
    return out


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


class ItemTile:
    """Weights of some items over the terms that they have: digits of 24 bits, 512 terms a part."""

    def __init__(self, first: int, weights: np.ndarray, columns: np.ndarray, n_terms: int):
        self.first, self.n_items = first, len(weights)
        self.place = np.full(n_terms, -1, dtype=np.int32)
        self.place[columns] = np.arange(len(columns), dtype=np.int32)
        self.n_columns = len(columns)
        self.parts = []
        shift, left = 0, weights
        while left.any():
            digit = (left & ((1 << DIGIT) - 1)).astype(np.float64)
            for at in range(0, len(columns), TERM_TILE):
                part = np.ascontiguousarray(digit[:, at : at + TERM_TILE])
                if part.any():
                    self.parts.append((shift, at, part))
            shift, left = shift + DIGIT, left >> DIGIT

    def scores(self, doc: np.ndarray, term: np.ndarray, impact: np.ndarray, n_docs: int) -> np.ndarray:
        """Exact 64-bit scores, items by documents."""
        column = self.place[term]
        there = column >= 0
        dense = np.zeros((self.n_columns, n_docs))
        dense[column[there], doc[there]] = impact[there]
        out = np.zeros((self.n_items, n_docs), dtype=np.int64)
        for shift, at, part in self.parts:
            out += (part @ dense[at : at + TERM_TILE]).astype(np.int64) << shift
        return out


class Best:
    """The ``k`` best documents of each item so far; equal scores by ascending id, no id last."""

    def __init__(self, n_items: int, k: int):
        self.k = k
        self.least = np.ones(n_items, dtype=np.int64)
        self.rows = [np.zeros((3, 0), dtype=np.int64)] * n_items

    def add(self, first: int, scores: np.ndarray, ids: np.ndarray, absent: np.ndarray) -> None:
        able = scores >= self.least[first : first + len(scores), None]
        for i in np.flatnonzero(able.any(axis=1)):
            at, item = np.flatnonzero(able[i]), first + i
            rows = np.hstack([self.rows[item], [scores[i, at], absent[at], ids[at]]])
            rows = rows[:, np.lexsort((rows[2], rows[1], -rows[0]))[: self.k]]
            self.rows[item] = rows
            if rows.shape[1] == self.k:  # an equal score may still have a smaller id
                self.least[item] = rows[0, -1]


def _impacts(times: np.ndarray, length: np.ndarray) -> np.ndarray:
    return IMPACT * times // (1000 * times + 8 * length)


def _best_of_tasks(documents: DataFrame, block: Shared, n_docs: int, n_words: int, k: int, item_type) -> DataFrame:
    """``item_id, task, doc_id, score``: each task's best documents of each item of the block."""
    schema = T.StructType(
        [
            T.StructField("item_id", item_type),
            T.StructField("part", T.IntegerType()),
            T.StructField("doc_id", T.LongType()),
            T.StructField("score", T.LongType()),
        ]
    )

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tiles, items = block.value
        best = Best(len(items), k)
        for batch in batches:
            for at in range(0, batch.num_rows, DOCUMENT_TILE):
                tile = batch.slice(at, DOCUMENT_TILE)
                term, sizes = _flat(tile.column("terms"), "<i4")
                times, _ = _flat(tile.column("times"), "<i8")
                # Python's numbers: the product may pass 64 bits.
                length = [100 - PART + PART * n * n_docs // n_words for n in tile.column("n").to_pylist()]
                doc = np.repeat(np.arange(tile.num_rows), sizes)
                impact = _impacts(times, np.array(length, dtype=np.int64)[doc]).astype(np.float64)
                absent = tile.column("doc_id").is_null().to_numpy(zero_copy_only=False).astype(np.int64)
                ids = tile.column("doc_id").fill_null(0).to_numpy()
                for one in tiles:
                    best.add(one.first, one.scores(doc, term, impact, tile.num_rows), ids, absent)
        item = np.repeat(np.arange(len(items)), [rows.shape[1] for rows in best.rows])
        score, absent, ids = np.hstack(best.rows) if len(items) else np.zeros((3, 0), dtype=np.int64)
        part = TaskContext.get().partitionId() % MERGES
        yield pa.RecordBatch.from_arrays(
            [
                items.take(pa.array(item)),
                pa.array(np.full(len(item), part, dtype=np.int32)),
                pa.array(ids, mask=absent.astype(bool)),
                pa.array(score),
            ],
            names=schema.names,
        )

    return documents.mapInArrow(run, schema)


def _top(rows: DataFrame, by: list[str], k: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _block(terms: pa.Table, df: np.ndarray, vocabulary: pa.Array, n_docs: int) -> tuple[list[ItemTile], pa.Array]:
    """The items' weights in tiles, and the ids that the tiles' rows stand for."""
    term = pc.index_in(terms["term"], vocabulary).to_numpy()
    coded = terms["item_id"].combine_chunks().dictionary_encode("encode")
    item, ids = coded.indices.to_numpy(zero_copy_only=False), coded.dictionary
    each = np.array([weight(n_docs, int(x)) for x in df], dtype=np.int64)
    value = each[term] * terms["times"].to_numpy()
    tiles = []
    for first in range(0, len(ids), ITEM_TILE):
        own = (item >= first) & (item < first + ITEM_TILE)
        columns, at = np.unique(term[own], return_inverse=True)
        weights = np.zeros((min(ITEM_TILE, len(ids) - first), len(columns)), dtype=np.int64)
        weights[item[own] - first, at] = value[own]
        tiles.append(ItemTile(first, weights, columns, len(vocabulary)))
    return tiles, ids


def best_documents(docs: DataFrame, items: DataFrame, k: int = K, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item, scores above 0.

    Terms are runs of ASCII letters and digits and of characters beyond ASCII, with A-Z
    in lower case. Rows of ``items`` with the same id are one item; one without a term
    that some document has gets no rows. Each row of ``docs`` is a document: repeated rows
    are ranked each, and rows of equal score come by ``doc_id``, those without one last. NULL and
    empty texts have no terms and do not count; texts may be of any length. Empty tables give no
    rows. Other columns are not looked at. ``doc_id`` must be a whole number.
    """
    spark = docs.sparkSession
    asked = _item_terms(items)
    n_words = asked.agg(F.sum("times")).first()[0] or 0
    blocks = max(1, -(-n_words // block_words))
    of_block = F.pmod(F.xxhash64("item_id"), F.lit(blocks))
    total, results = None, []
    for number in range(blocks):
        terms = asked.where(of_block == number).toArrow()
        vocabulary = pc.unique(terms["term"])
        if not len(vocabulary):
            continue
        documents = _document_terms(docs, Shared(spark, vocabulary))
        if total is None:
            total = documents.agg(F.count("*"), F.sum("n")).first()
        if not total[0]:
            break
        df = _holders(documents, len(vocabulary))
        block = Shared(spark, _block(terms, df, vocabulary, total[0]))
        found = _best_of_tasks(documents, block, total[0], total[1], k, items.schema["item_id"].dataType)
        first = _top(found, ["item_id", "part"], k).drop("rank", "part")
        results.append(stored(_top(first, ["item_id"], k)))
    if not results:
        empty = T.StructType(
            [
                items.schema["item_id"],
                T.StructField("rank", T.IntegerType()),
                T.StructField("doc_id", T.LongType()),
                T.StructField("score", T.LongType()),
            ]
        )
        return spark.createDataFrame([], empty)
    out = results[0]
    for more in results[1:]:
        out = out.unionByName(more)
    return out.select("item_id", "rank", "doc_id", "score")
