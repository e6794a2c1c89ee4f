"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.frames import held_out, likely_among, stored, training_labels
from linkloom.llm.words import ALNUM, sliced, split_words

#: Entries of the lexicons: whole words, and beginnings of longer words. ``x-`` is held by a
#: text with a longer word that begins with x, ``x--`` by one with two different such words.
BEGINNINGS = (4, 5, 6, 7, 8)
#: Each source of entries gives two lexicons, each a voter: words, and beginnings of each length.
SOURCES = [(0, ""), *((k, suffix) for suffix in ("-", "--") for k in BEGINNINGS)]
#: An entry must be so much likelier in toxic texts, with this much evidence (twice the log of the
#: likelihood ratio of depending on the class, about one chance in a million).
LEAST_RATIO, LEAST_EVIDENCE = 20.0, 24.0
#: Entries with at least this share of the evidence of the source's best one are its first lexicon.
FIRST_SHARE = 0.1
#: Entries of a source: those with most evidence. Counts cover all labelled texts.
LEXICON_SIZE = 2_000
#: Bound of the sample that the classifier is fitted on; votes and posteriors cover all rows.
SAMPLE_ROWS = 20_000

LEXICONS = 2 * len(SOURCES)
PATTERNS = ("several", "shouting", "exclaims", "addressed", "clean")
VOTERS = LEXICONS + len(PATTERNS)


def source_of(entry: str) -> int:
    """The number of the source that an entry comes from; words have no hyphen."""
    stem = entry.rstrip("-")
    suffix = entry[len(stem) :]
    return SOURCES.index((len(stem) if suffix else 0, suffix))


def _entries(column: pa.Array, known: pa.Array | None = None) -> Iterator[tuple[np.ndarray, np.ndarray, pa.Array]]:
    """Distinct ``(text, entry number)`` pairs and the entries, part by part.

    With ``known``, entries are numbered by their place there and others left out.
    """
    words = split_words(column, ALNUM, lower=True)
    coded = words.array().dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    n_words = max(len(coded.dictionary), 1)
    pairs = pd.unique(words.doc * n_words + code)
    doc, code = pairs // n_words, pairs % n_words
    size = pc.utf8_length(coded.dictionary).to_numpy(zero_copy_only=False)

    def numbered(names: pa.Array, suffix: str):
        if suffix:
            names = pc.binary_join_element_wise(names, pa.scalar(suffix), pa.scalar(""))
        if known is None:
            return names, np.arange(len(names))
        at = pc.fill_null(pc.index_in(names, value_set=known), -1)
        return known, at.to_numpy(zero_copy_only=False).astype(np.int64)

    for k in (0, *BEGINNINGS):
        part = (pc.utf8_slice_codeunits(coded.dictionary, 0, k) if k else coded.dictionary).dictionary_encode()
        number = part.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        own = code[size[code] > k] if len(code) else code
        whose = doc[size[code] > k] if len(code) else doc
        for suffix in ("-", "--") if k else ("",):
            names, place = numbered(part.dictionary, suffix)
            entry = place[number[own]] if len(own) else own
            held, n = np.unique((whose * max(len(names), 1) + entry)[entry >= 0], return_counts=True)
            held = held[n > 1] if suffix == "--" else held
            yield held // max(len(names), 1), held % max(len(names), 1), names


def entry_counts(labelled: DataFrame) -> DataFrame:
    """``entry, clean, toxic``: texts of ``text, label`` that hold an entry; summed in tasks first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            toxic = batch.column("label").to_numpy() == 1
            for doc, entry, names in _entries(pc.fill_null(batch.column("text"), "")):
                n1 = np.bincount(entry[toxic[doc]], minlength=len(names))
                n0 = np.bincount(entry, minlength=len(names)) - n1
                part = [names, pa.array(n0, pa.int64()), pa.array(n1, pa.int64())]
                yield pa.RecordBatch.from_arrays(part, ["entry", "clean", "toxic"]).filter(pa.array(n0 + n1 > 0))

    parts = labelled.select("text", "label").mapInArrow(run, "entry string, clean long, toxic long")
    return parts.groupBy("entry").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``text, label``: each different text of a labelled id once for each label that it has.

    Texts of other ids stay where they are, but for the few that a filter of fixed size lets through.
    """
    hashed = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")
    chosen = hashed.drop("text").join(labels, "doc_id").groupBy("h", "label").agg(F.min("doc_id").alias("doc_id"))
    chosen = stored(chosen)
    able = likely_among(hashed, chosen).join(chosen, ["doc_id", "h"])
    return able.dropDuplicates(["doc_id", "h", "label"]).select("text", "label")


def evidence(toxic: Column, clean: Column, n_toxic: int, n_clean: int) -> Column:
    """Twice the log of the likelihood ratio that an entry's share differs between the classes."""
    held = toxic + clean
    total = float(n_toxic + n_clean)
    parts = (
        (toxic, held, n_toxic),
        (clean, held, n_clean),
        (n_toxic - toxic, total - held, n_toxic),
        (n_clean - clean, total - held, n_clean),
    )
    terms = [F.when(x > 0, x * F.log(x * total / (of * n))).otherwise(0.0) for x, of, n in parts]
    return 2 * (terms[0] + terms[1] + terms[2] + terms[3])


def induced_lexicon(docs: DataFrame, labels: DataFrame, size: int = LEXICON_SIZE) -> dict[str, int]:
    """Entries that mark toxic texts, from ``doc_id, text`` and ``doc_id, label``, each with its voter.

    Counted over all labelled texts; copies of a text count once, as they say nothing new about its
    words. Each source gives ``size`` entries at most, those with most evidence, ties by name.
    """
    labelled = stored(labelled_texts(docs, labels))
    n = labelled.agg(F.count("*"), F.sum("label")).first()
    toxic, clean = n[1] or 0, n[0] - (n[1] or 0)
    if not toxic or not clean:
        return {}
    ratio = (F.col("toxic") / toxic) / ((F.col("clean") + 0.5) / clean)
    marks = entry_counts(labelled).where(ratio >= LEAST_RATIO)
    proof = evidence(F.col("toxic").cast("double"), F.col("clean").cast("double"), toxic, clean)
    marks = marks.select("entry", F.round(proof, 9).alias("proof")).where(F.col("proof") >= LEAST_EVIDENCE)
    stem = F.regexp_replace("entry", "-+$", "")
    suffix = F.length("entry") - F.length(stem)
    source = F.struct(suffix.alias("suffix"), F.when(suffix > 0, F.length(stem)).otherwise(0).alias("k"))
    order = Window.partitionBy(source).orderBy(F.desc("proof"), "entry")
    most = F.first("proof").over(order)
    ranked = marks.withColumns({"place": F.row_number().over(order), "second": F.col("proof") < FIRST_SHARE * most})
    best = ranked.where(F.col("place") <= size).select("entry", "second").collect()
    return {r["entry"]: 2 * source_of(r["entry"]) + r["second"] for r in sorted(best)}


def _addressed(column: pa.Array) -> np.ndarray:
    return pc.match_substring_regex(column, r"(?i)\byou('re| are)\b").to_numpy(zero_copy_only=False)


def votes(docs: DataFrame, lexicon: dict[str, int]) -> DataFrame:
    """``doc_id, text_hash, votes int, entries array<int>``: the voters that fire, a bit each, and entries held.

    Voters: two lexicons of each source, several entries, shouting, runs of
    exclamation marks, speaking to the reader, and a last one for texts without any entry.
    """
    known = pa.array(list(lexicon), pa.string())
    dealt = np.array(list(lexicon.values()), dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            text = pc.fill_null(batch.column("text"), "")
            parts = list(_entries(text, known))
            doc = np.concatenate([p[0] for p in parts])
            entry = np.concatenate([p[1] for p in parts])
            order = np.lexsort((entry, doc))
            doc, entry = doc[order], entry[order]
            n = batch.num_rows
            held = np.bincount(doc, minlength=n)
            bits = np.zeros(n, np.int64)
            np.bitwise_or.at(bits, doc, 1 << dealt[entry])
            words = split_words(text)
            upper = words.per_doc((words.data >= 0x41) & (words.data <= 0x5A))
            lower = words.per_doc((words.data >= 0x61) & (words.data <= 0x7A))
            exclaims = pc.match_substring(text, "!!").to_numpy(zero_copy_only=False)
            patterns = [held >= 2, upper > lower, exclaims, _addressed(text), held == 0]
            for k, fired in enumerate(patterns):
                bits |= fired.astype(np.int64) << (LEXICONS + k)
            reach = np.concatenate(([0], np.cumsum(held))).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(reach), pa.array(entry.astype(np.int32)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(bits.astype(np.int32)), lists],
                ["doc_id", "text_hash", "votes", "entries"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, votes int, entries array<int>")


@dataclass(frozen=True)
class LabelModel:
    """A class, and voters that depend on it and on one other voter each: a tree of correlations.

    ``table[y, v, u]`` is the probability that voter ``v`` fires on class ``y`` when its ``parent`` has
    (``u`` = 1) or has not; the root, with parent -1, has the same for both.
    """

    prior: float
    parent: np.ndarray
    table: np.ndarray

    def log_likelihood(self, fired: np.ndarray) -> np.ndarray:
        """Rows by classes."""
        out = np.zeros((len(fired), 2))
        for v, u in enumerate(self.parent):
            given = fired[:, u].astype(int) if u >= 0 else np.zeros(len(fired), int)
            for y in (0, 1):
                p = self.table[y, v, given]
                out[:, y] += np.log(np.where(fired[:, v], p, 1 - p))
        return out

    def posterior(self, fired: np.ndarray) -> np.ndarray:
        likely = self.log_likelihood(fired)
        odds = np.log(self.prior / (1 - self.prior)) + likely[:, 1] - likely[:, 0]
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def _bits(mask: np.ndarray, n: int = VOTERS) -> np.ndarray:
    return (mask[:, None] >> np.arange(n)) & 1 == 1


def _pairs(fired: np.ndarray, share: np.ndarray) -> np.ndarray:
    """``[u, v, a, b]``: weight of rows where voter u votes a and voter v votes b, one row of each kind added."""
    both = np.stack([~fired, fired]).astype(float)
    return np.einsum("n,anu,bnv->uvab", share, both, both, optimize=True) + 0.25


def dependence_tree(joint: np.ndarray) -> np.ndarray:
    """Parent of each voter in the tree of largest mutual information given the class; -1 for the root.

    ``joint`` has the weights of ``_pairs`` for each class.
    """
    n = joint.shape[1]
    p = joint / joint.sum(axis=(3, 4), keepdims=True)
    own = p.sum(axis=4, keepdims=True) * p.sum(axis=3, keepdims=True)
    given = (p * np.log(p / own)).sum(axis=(3, 4))
    size = joint.sum(axis=(3, 4))
    worth = (given * size / size.sum(axis=0)).sum(axis=0)
    parent, inside = np.full(n, -1), [0]
    while len(inside) < n:
        rest = [v for v in range(n) if v not in inside]
        part = worth[np.ix_(inside, rest)]
        i, j = np.unravel_index(np.argmax(part), part.shape)
        parent[rest[j]] = inside[i]
        inside.append(rest[j])
    return parent


def label_model(mask: np.ndarray, known: np.ndarray, count: np.ndarray, rounds: int = 50) -> LabelModel:
    """Expectation-maximisation over vote patterns; ``known`` is 0, 1, or -1 where unlabelled.

    Every round finds the tree of the strongest correlations among voters given the class, so these are
    part of the likelihood: voters that repeat one another add nothing.
    """
    fired = _bits(mask)
    soft = np.where(known >= 0, known, np.where(fired[:, :LEXICONS].any(axis=1), 0.8, 0.1))
    model = None
    for _ in range(rounds):
        joint = np.stack([_pairs(fired, count * (soft if y else 1 - soft)) for y in (0, 1)])
        parent = dependence_tree(joint)
        table = np.empty((2, fired.shape[1], 2))
        for v, u in enumerate(parent):
            pair = joint[:, u, v] if u >= 0 else np.stack([joint[:, v, v].sum(axis=1)] * 2, axis=1)
            table[:, v] = pair[:, :, 1] / pair.sum(axis=2)
        prior = min(max((count @ soft) / count.sum(), 1e-4), 1 - 1e-4)
        model = LabelModel(prior, parent, table)
        new = np.where(known >= 0, known, model.posterior(fired))
        if np.abs(new - soft).max() < 1e-6:
            break
        soft = new
    return model


def _design(mask: np.ndarray, lists: list, n_entries: int):
    """Sparse rows: entries of the lexicon, then the pattern voters."""
    size = np.array([len(x) for x in lists], dtype=np.int64)
    row = np.repeat(np.arange(len(lists)), size)
    column = np.fromiter((v for x in lists for v in x), np.int64, size.sum())
    extra_row, extra = np.nonzero(_bits(mask)[:, LEXICONS:])
    return np.concatenate((row, extra_row)), np.concatenate((column, extra + n_entries))


def linear_classifier(mask, lists, target, n_entries: int, steps: int = 400) -> np.ndarray:
    """Logistic weights (bias last) on soft labels, by scaled gradient steps with a small penalty."""
    row, column = _design(mask, lists, n_entries)
    n, m = len(target), n_entries + len(PATTERNS)
    w, seen = np.zeros(m + 1), np.full(m + 1, 1e-9)
    for _ in range(steps):
        odds = np.bincount(row, w[column], minlength=n) + w[-1]
        error = 1 / (1 + np.exp(-np.clip(odds, -500, 500))) - target
        gradient = np.append(np.bincount(column, error[row], minlength=m), error.sum()) + 0.05 * w
        seen += gradient**2
        w -= gradient / np.sqrt(seen)
    return w


def toxicity_scores(
    docs: DataFrame,
    labels: DataFrame,
    *,
    label: str = "toxic",
    doc_id: str = "doc_id",
    text: str = "text",
    threshold: float = 0.5,
    sample: int = SAMPLE_ROWS,
) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row of ``docs``.

    Labels of rows outside the held-out fold induce the lexicons and anchor the
    label model; the classifier learns the model's posteriors, given the votes alone, on ``sample`` rows of
    those folds at most. Only text enters a score, a whole one of any length. NULL and empty texts hold no entry
    and score as such texts do; without usable labels every score is 1/2. Each row is scored, repeated ones too, and
    equal texts score alike; in training, rows of one id and text count once. No rows give no rows. Other columns
    are not looked at.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    known = training_labels(labels, label)
    lexicon = induced_lexicon(rows, known)
    table = stored(votes(rows, lexicon))
    anchored = table.where(~held_out()).dropDuplicates(["doc_id", "text_hash"]).join(known, "doc_id", "left")
    anchored = stored(anchored.withColumn("known", F.coalesce("label", F.lit(-1))))
    patterns = anchored.groupBy("votes", "known").count().toArrow().sort_by([("votes", "ascending"), ("known", "ascending")])
    weights = np.zeros(len(lexicon) + len(PATTERNS) + 1)
    if patterns.num_rows and lexicon:
        mask, anchor, count = (patterns[c].to_numpy() for c in ("votes", "known", "count"))
        model = label_model(mask.astype(np.int64), anchor, count.astype(float))
        order = [F.xxhash64("doc_id", "text_hash"), F.col("doc_id"), F.col("text_hash")]
        part = anchored.orderBy(*order).limit(sample).select("votes", "entries").toArrow()
        seen = part["votes"].to_numpy().astype(np.int64)
        target = model.posterior(_bits(seen))
        weights = linear_classifier(seen, part["entries"].to_pylist(), target, len(lexicon))
    shared, n_entries = table.sparkSession.sparkContext.broadcast(weights), len(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = shared.value
        for batch in batches:
            mask = batch.column("votes").to_numpy().astype(np.int64)
            row, column = _design(mask, batch.column("entries").to_pylist(), n_entries)
            odds = np.bincount(row, w[column], minlength=len(mask)) + w[-1]
            score = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(score)], ["doc_id", "score"])

    kind = table.schema["doc_id"].dataType.simpleString()
    scored = table.mapInArrow(run, f"doc_id {kind}, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out().alias("held_out"), "score", predicted)
