"""Quality classifier: n-gram indicators scaled by naive Bayes ratios, linear hinge loss."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.frames import Shared, held_out, likely_among, stored, training_labels
from linkloom.llm.words import LOWER, Words, codes, mixed, sliced, split_words, word_hashes

#: Hashed n-grams; bounds the class counts and the weights, whatever the input.
BUCKETS = 1 << 16
#: Longest n-gram of word forms, and of the words themselves.
ORDER, WORD_ORDER = 4, 2
#: Bound of the labelled sample that the hinge loss is fitted on. Counts cover all rows.
SAMPLE_ROWS = 12_000
EPOCHS = 12
#: Scores are a logistic function of the margin with this slope.
SLOPE = 2.0

_CLASS = np.zeros(256, dtype=np.uint8)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        1 if "A" <= _c <= "Z" else 2 if "a" <= _c <= "z" or _b >= 0x80 else 3 if _c in "#*$%&|<>" else
        4 if _c in "!?" else 5 if _c.isdigit() else 6 if _b > 0x20 else 0
    )


def word_shapes(words: Words) -> np.ndarray:
    """A number below 256 for the form of each word.

    The form is its case, its most telling mark, its length and whether it equals
    the word before. Forms carry over to words that training never saw.
    """
    if not len(words.start):
        return np.zeros(0, np.int64)
    kind = _CLASS[words.data]

    def count(mask):
        total = np.concatenate(([0], np.cumsum(mask, dtype=np.int64)))
        return total[words.end] - total[words.start]

    upper, lower = count(kind == 1), count(kind == 2)
    size = count((words.data & 0xC0) != 0x80)
    first_upper = kind[words.start] == 1
    case = np.select(
        [upper + lower == 0, upper == 0, (upper == 1) & first_upper & (lower > 0), lower == 0],
        [0, 1, 2, 3],
        4,
    )
    mostly = (case == 4) & (upper * 2 > upper + lower // 2)
    case[mostly] = 3
    mark = np.select([count(kind == 3) > 0, count(kind == 4) > 0, count(kind == 5) > 0, count(kind == 6) > 0], [1, 2, 3, 4], 0)
    length = np.searchsorted([3, 8, 15], size, "right")
    word = codes(words.array())
    same = np.zeros(len(word), np.int64)
    same[1:] = (word[1:] == word[:-1]) & (words.doc[1:] == words.doc[:-1])
    return ((case * 5 + mark) * 4 + length) * 2 + same


def ngram_indicators(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` pairs, each once, ordered by text.

    N-grams of one to four word forms, and single words and pairs of them with ASCII letters in lower
    case; all share the buckets.
    """
    words = split_words(column)
    shape, doc = word_shapes(words), words.doc
    plain = word_hashes(words._replace(data=LOWER[words.data]))
    parts = []
    for unit, order, scale, salt in ((shape.astype(np.uint64), ORDER, 256, 40), (plain, WORD_ORDER, 0x9E3779B97F4A7C15, 44)):
        gram = unit
        for n in range(1, order + 1):
            if n > 1:
                if len(unit) < n:
                    break
                with np.errstate(over="ignore"):
                    gram = gram[:-1] * np.uint64(scale) + unit[n - 1 :]
            whole = doc[: len(gram)] == doc[n - 1 :]
            with np.errstate(over="ignore"):
                bucket = (mixed(gram[whole] + np.uint64(n << salt)) % np.uint64(BUCKETS)).astype(np.int64)
            parts.append(pd.unique(doc[: len(gram)][whole] * BUCKETS + bucket))
    pairs = np.sort(pd.unique(np.concatenate(parts))) if parts else np.zeros(0, np.int64)
    return pairs // BUCKETS, pairs % BUCKETS


def indicator_table(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, text_hash, features binary``: the distinct buckets of each whole text, two bytes each."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.xxhash64(text).alias("text_hash"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            doc, bucket = ngram_indicators(batch.column("text"))
            reach = np.concatenate(([0], np.cumsum(np.bincount(doc, minlength=batch.num_rows)))) * 2
            data = pa.py_buffer(bucket.astype(np.uint16).tobytes())
            packed = pa.Array.from_buffers(
                pa.binary(), batch.num_rows, [None, pa.py_buffer(reach.astype(np.int32)), data]
            )
            kept = [batch.column("doc_id"), batch.column("text_hash"), packed]
            yield pa.RecordBatch.from_arrays(kept, ["doc_id", "text_hash", "features"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, features binary")


def _unpacked(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every indicator in a column of packed features."""
    rows = column.to_pylist()
    sizes = np.array([len(v) // 2 if v is not None else 0 for v in rows], dtype=np.int64)
    data = b"".join(v for v in rows if v is not None)
    return np.repeat(np.arange(len(sizes), dtype=np.int32), sizes), np.frombuffer(data, np.uint16)


def class_counts(labelled: DataFrame) -> np.ndarray:
    """Rows of each class that hold a bucket, ``2 x BUCKETS``; summed in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, BUCKETS), dtype=np.int64)
        for batch in batches:
            row, bucket = _unpacked(batch.column("features"))
            label = batch.column("label").to_numpy()[row]
            np.add.at(counts, (label, bucket), 1)
        used = np.flatnonzero(counts.sum(axis=0))
        yield pa.RecordBatch.from_arrays(
            [pa.array(used), pa.array(counts[0, used]), pa.array(counts[1, used])], ["bucket", "n0", "n1"]
        )

    parts = labelled.select("features", "label").mapInArrow(run, "bucket long, n0 long, n1 long")
    rows = parts.groupBy("bucket").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).toArrow()
    out = np.zeros((2, BUCKETS))
    at = rows["bucket"].to_numpy()
    out[0, at], out[1, at] = rows["n0"].to_numpy(), rows["n1"].to_numpy()
    return out


def dual_coordinate_descent(
    row: np.ndarray, bucket: np.ndarray, value: np.ndarray, sign: np.ndarray, cost: np.ndarray, epochs: int
) -> tuple[np.ndarray, float]:
    """Weights and bias of the linear hinge loss, one dual variable at a time.

    ``row`` ascends; ``sign`` is +1 or -1 and ``cost`` the upper bound of each dual
    variable. The bias is a feature that every row holds.
    """
    n = len(sign)
    weight, bias, dual = np.zeros(BUCKETS), 0.0, np.zeros(n)
    edge = np.searchsorted(row, np.arange(n + 1, dtype=row.dtype))
    norm = np.array([value[a:b] @ value[a:b] + 1.0 for a, b in zip(edge[:-1], edge[1:])])
    order = np.random.default_rng(7)
    for _ in range(epochs):
        most = 0.0
        for i in order.permutation(n):
            at, x = bucket[edge[i] : edge[i + 1]], value[edge[i] : edge[i + 1]]
            gradient = sign[i] * (weight[at] @ x + bias) - 1
            new = min(max(dual[i] - gradient / norm[i], 0.0), cost[i])
            if (step := new - dual[i]) != 0.0:
                dual[i] = new
                weight[at] += step * sign[i] * x
                bias += step * sign[i]
                most = max(most, abs(step))
        if most < 1e-4:
            break
    return weight, bias


@dataclass(frozen=True)
class NbSvm:
    weights: np.ndarray  # of the indicators, ratios multiplied in
    bias: float

    def score(self, texts: pa.Array) -> np.ndarray:
        doc, bucket = ngram_indicators(texts)
        margin = np.bincount(doc, self.weights[bucket], minlength=len(texts)) + self.bias
        return 1 / (1 + np.exp(-np.clip(SLOPE * margin, -500, 500)))


def fit(docs: DataFrame, labels: DataFrame, *, sample: int = SAMPLE_ROWS, cost: float = 1.0) -> NbSvm:
    """Learn from ``doc_id, text`` and ``doc_id, label``; see ``training_labels``.

    Indicators are made of labelled texts alone and stored without the texts.

    Rows of one id and text count once. Log-count ratios come from all labelled rows. The hinge loss
    is fitted on ``sample`` rows at most, those with the smallest hash of their id and text, with classes
    weighted to count alike up to a factor of four. Without labels of both classes the score is 1/2.
    """
    labels = stored(labels)
    table = indicator_table(likely_among(docs, labels))
    labelled = stored(table.join(labels, "doc_id").dropDuplicates(["doc_id", "text_hash"]))
    counts = class_counts(labelled)
    smooth = counts + 1
    ratio = np.log(smooth[1] / smooth[1].sum()) - np.log(smooth[0] / smooth[0].sum())
    # At most ``sample`` pairs, hence the broadcast; features move once they are chosen.
    pair = ["doc_id", "text_hash"]
    chosen = labelled.select(*pair).orderBy(F.xxhash64(*pair), *pair).limit(sample)
    rows = labelled.join(F.broadcast(chosen), pair).orderBy(F.xxhash64(*pair), *pair).select("label", "features").toArrow()
    sign = rows["label"].to_numpy() * 2.0 - 1
    if len(np.unique(sign)) < 2:
        return NbSvm(np.zeros(BUCKETS), 0.0)
    row, bucket = _unpacked(rows["features"].combine_chunks())
    share = (sign > 0).mean()
    weight = np.where(sign > 0, min(1, (1 - share) * 4 / share), min(1, share * 4 / (1 - share)))
    value = np.empty(len(bucket))
    for at in range(0, len(bucket), 1 << 20):  # an index array is widened whole
        value[at : at + (1 << 20)] = ratio[bucket[at : at + (1 << 20)]]
    weights, bias = dual_coordinate_descent(row, bucket, value, sign, cost * weight, EPOCHS)
    return NbSvm(weights * ratio, bias)


def quality_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "quality",
    threshold: float = 0.3,
    doc_id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Only the text enters a score, a whole one of any length. NULL and empty texts have no n-grams and get the
    score of the bias. Ids that are NULL take no part in training and are not held out. Each row
    is scored, repeated ones too, and equal texts score alike; in training, rows of one id and text count
    once, and an id with several texts labels each of them. No rows give no rows, and without labels every score is
    1/2. Other columns are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = Shared(docs.sparkSession, fit(rows, training_labels(labels, label)))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            score = pa.array(model.value.score(batch.column("text")))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], ["doc_id", "score"])

    found = rows.mapInArrow(run, f"doc_id {kind}, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return found.select("doc_id", held_out().alias("held_out"), "score", predicted)


def kept_by_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.3, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that the classifier accepts, unchanged.

    The verdict is computed from the row's own text, so nothing is joined. Columns of
    any name stay as they are; no rows give no rows.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    model = Shared(docs.sparkSession, fit(rows, training_labels(labels, "quality")))
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    name = plain.columns[docs.columns.index(text)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, name):
            yield batch.filter(pa.array(model.value.score(batch.column(name)) >= threshold))

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
