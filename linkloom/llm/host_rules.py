"""Host-level quality rules: failures by host, shrunk by an empirical beta prior."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.frames import stored
from linkloom.llm.words import NOT_NEWLINE, NOT_SPACE, codes, sliced, split_words

SYMBOLS = np.array([chr(b) in "#*$%&|<>" for b in range(256)])
WINDOW = 8
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

#: A host is rejected when, by its beta posterior, the failure rate of a rule lies above ``WORSE`` times
#: the common rate with a probability of ``SURE`` or more.
WORSE, SURE = 3.0, 0.99


def _repeat_words(word: np.ndarray, doc: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Words of each text inside a window of ``WINDOW`` words that it holds twice or more."""
    n, n_docs = len(word), len(first) - 1
    if n < WINDOW:
        return np.zeros(n_docs, dtype=np.int64)
    # Exact numbers of 2, 4 and 8 words in a row: each doubles the one before.
    code, width = word, 1
    while width < WINDOW:
        code = pd.factorize(code[:-width] * n + code[width:])[0].astype(np.int64)
        width *= 2
    at = np.flatnonzero(doc[: len(code)] == doc[WINDOW - 1 :])
    own = pd.factorize(code[at] * n_docs + doc[at])[0]
    twice = at[np.bincount(own)[own] > 1] if len(at) else at
    cover = np.zeros(n + 1, dtype=np.int64)
    np.add.at(cover, twice, 1)
    np.add.at(cover, twice + WINDOW, -1)
    total = np.concatenate(([0], np.cumsum(np.cumsum(cover[:-1]) > 0)))
    return total[first[1:]] - total[first[:-1]]


def _dup_lines(column: pa.Array, inside: np.ndarray) -> np.ndarray:
    lines = split_words(column, NOT_NEWLINE)
    words = np.concatenate(([0], np.cumsum(inside)))
    full = words[lines.end] > words[lines.start]
    line, doc = codes(lines.array())[full], lines.doc[full]
    distinct = np.unique(np.stack([doc, line], axis=1), axis=0)[:, 0]
    n = lines.n_docs
    return np.bincount(doc, minlength=n) - np.bincount(distinct, minlength=n)


def text_counts(column: pa.Array) -> list[np.ndarray]:
    words = split_words(column)
    first = words.first()
    character = words.inside & ((words.data & 0xC0) != 0x80)
    return [
        np.diff(first),
        words.per_doc(character),
        words.per_doc(SYMBOLS[words.data]),
        _dup_lines(column, words.inside),
        _repeat_words(codes(words.array()), words.doc, first),
    ]


def with_counts(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """``doc_id, host`` and the counts of every whole text; a NULL text has no words."""
    rows = docs.select(
        F.col(doc_id).alias("doc_id"), F.col(host).cast("string").alias("host"), F.col(text).alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            columns = [pa.array(c.astype(np.int64)) for c in text_counts(batch.column("text"))]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("host"), *columns], ["doc_id", "host", *COUNTS]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, host string, " + ", ".join(f"{c} long" for c in COUNTS))


def rules() -> dict[str, Column]:
    """Rule failures, in whole numbers; the first two make up the base verdict."""
    return {
        "short": F.col("n_words") < 20,
        "repeated": 100 * F.col("n_repeat_words") > 30 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("n_words"),
        "long_words": F.col("word_chars") > 15 * F.col("n_words"),
        "dup_lines": 10 * F.col("n_dup_lines") > F.col("n_words"),
    }


def beta_prior(hosts: float, docs: float, mean: float, square: float) -> tuple[float, float] | None:
    """Parameters of the beta prior of a rule by moments; None where hosts don't vary beyond chance.

    ``mean`` and ``square`` are the mean of the hosts' failure rates and of their squares, weighted by documents.
    """
    chance = mean * (1 - mean)
    # Within-host sampling adds about (hosts / docs) * chance to the raw variance.
    between = square - mean * mean - chance * hosts / docs if docs else 0.0
    if between <= 1e-9:
        return None
    strength = max(chance / between - 1, 1e-6)
    return strength * mean, strength * (1 - mean)


def beta_above(a: np.ndarray, b: np.ndarray, limit: float) -> np.ndarray:
    """Probability that a beta variable exceeds ``limit``, by the continued fraction of the incomplete beta."""
    x = min(max(limit, 0.0), 1.0)
    if x in (0.0, 1.0):
        return np.full(len(a), 1.0 - x)
    swap = x > (a + 1) / (a + b + 2)
    p, q, y = np.where(swap, b, a), np.where(swap, a, b), np.where(swap, 1 - x, x)
    log_beta = np.array([math.lgamma(u) + math.lgamma(v) - math.lgamma(u + v) for u, v in zip(p, q)])
    front = np.exp(p * np.log(y) + q * np.log1p(-y) - log_beta) / p
    # Modified Lentz steps, all elements together.
    tiny = 1e-300
    c, d = np.ones_like(p), 1 - (p + q) * y / (p + 1)
    d = 1 / np.where(np.abs(d) < tiny, tiny, d)
    out = d.copy()
    for m in range(1, 500):
        for term in (
            m * (q - m) * y / ((p + 2 * m - 1) * (p + 2 * m)),
            -(p + m) * (p + q + m) * y / ((p + 2 * m) * (p + 2 * m + 1)),
        ):
            d, c = 1 + term * d, 1 + term / c
            d, c = 1 / np.where(np.abs(d) < tiny, tiny, d), np.where(np.abs(c) < tiny, tiny, c)
            step = c * d
            out = out * step
        if np.abs(step - 1).max(initial=0) < 1e-14:
            break
    below = front * out
    return np.where(swap, below, 1 - below)


def host_rates(counted: DataFrame, *, worse: float = WORSE) -> DataFrame:
    """``host`` and, for each rule, ``<rule>_rate`` and ``<rule>_worse``.

    The rate of a host is the mean of its beta posterior, and ``worse`` the posterior
    probability that its true rate is above ``worse`` times the common rate. The prior
    of a rule has the mean and the between-host variance of the rates of all hosts (moments,
    weighted by documents); hosts that don't vary beyond chance pull all the way to the common
    rate, and none is worse.
    """
    names = list(rules())
    fails = [F.count_if(test).alias(name) for name, test in rules().items()]
    hosts = counted.groupBy("host").agg(F.count("*").alias("n"), *fails)
    total, spread = F.sum("n").cast("double"), []
    for name in names:
        spread += [
            (F.sum(name) / total).alias(f"{name}_mean"),
            (F.sum(F.col(name) * F.col(name) / F.col("n")) / total).alias(f"{name}_square"),
        ]
    # One row of sums over all hosts.
    found = hosts.agg(F.count("*").alias("hosts"), total.alias("docs"), *spread).first()
    means = {n: found[f"{n}_mean"] or 0.0 for n in names}
    prior = {n: beta_prior(found["hosts"], found["docs"] or 0, means[n], found[f"{n}_square"] or 0) for n in names}
    columns = [c for n in names for c in (f"{n}_rate", f"{n}_worse")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, out = batch.column("n").to_numpy().astype(float), [batch.column("host")]
            for name in names:
                bad = batch.column(name).to_numpy().astype(float)
                if prior[name] is None:
                    out += [pa.array(np.full(len(n), means[name])), pa.array(np.zeros(len(n)))]
                    continue
                a, b = prior[name][0] + bad, prior[name][1] + n - bad
                out += [pa.array(a / (a + b)), pa.array(beta_above(a, b, worse * means[name]))]
            yield pa.RecordBatch.from_arrays(out, names=["host", *columns])

    return hosts.mapInArrow(run, "host string, " + ", ".join(f"{c} double" for c in columns))


def host_verdicts(docs: DataFrame, *, worse: float = WORSE, sure: float = SURE, **columns) -> DataFrame:
    """``doc_id``, the counts, ``base_failed``, ``host_rejected``, ``kept`` and the host's shrunk rates, per row.

    A host is rejected when it is surely worse than the others by a rule: its rate lies above ``worse``
    times the common rate with a posterior probability of at least ``sure``. Rows without a
    host are judged by the base rules alone and have no rates. NULL and empty texts have no words and so
    fail; a text may be of any length; repeated rows count each; no rows give no rows. Other columns are not
    looked at.

    Counts are written once; hosts are aggregated before their shuffle, and their verdicts joined back,
    so a host with a third of all rows costs a skewed join that adaptive execution splits.
    """
    counted = stored(with_counts(docs, **columns))
    rates = stored(host_rates(counted.where(F.col("host").isNotNull()), worse=worse))
    bad = F.greatest(*[F.col(f"{name}_worse") for name in rules()]) >= sure
    verdicts = rates.select("host", bad.alias("rejected"), *[f"{name}_rate" for name in rules()])
    failed = rules()["short"] | rules()["repeated"]
    return (
        counted.join(verdicts, "host", "left")
        .select(
            "doc_id",
            *COUNTS,
            failed.alias("base_failed"),
            F.coalesce("rejected", F.lit(False)).alias("host_rejected"),
            *[F.round(f"{name}_rate", 9).alias(f"{name}_rate") for name in rules()],
        )
        .withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected"))
    )
