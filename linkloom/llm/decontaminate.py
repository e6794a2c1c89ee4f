"""Benchmark decontamination with an FM-index per shard of training text."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from linkloom.llm.frames import Shared, stored
from linkloom.llm.fm_index import FMIndex
from linkloom.llm.words import ALNUM, sliced, split_words

#: Words of a window, windows of the benchmark that a task looks for at once, and how many such blocks
#: one pass over the texts has in memory; with more, the texts are written and read again.
WINDOW_WORDS = 10
BLOCK_WINDOWS = 200_000
PASS_BLOCKS = 10


@dataclass(frozen=True)
class Phrases:
    """A bounded block of benchmark windows, by the numbers of their words."""

    vocabulary: pa.Array  # distinct words
    symbols: np.ndarray  # windows x WINDOW_WORDS, right-aligned, word number + 1
    lengths: np.ndarray
    keys: np.ndarray  # of the windows


def benchmark_windows(
    benchmark: DataFrame, *, item_id: str = "item_id", text: str = "text", size: int = WINDOW_WORDS
) -> DataFrame:
    """``key, window array<string>, item``: the windows of each item.

    An item of fewer words is one window, one without words (NULL, empty) has none.
    Items without an id are named by the empty string.
    """
    lowered = F.translate(F.col(text), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = F.filter(F.split(lowered, r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"), lambda w: w != "")
    item = F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("item")
    rows = benchmark.select(item, words.alias("w")).where(F.size("w") > 0)
    last = F.greatest(F.size("w") - size, F.lit(0))
    window = F.transform(F.sequence(F.lit(0), last), lambda i: F.slice("w", i + 1, F.lit(size)))
    exploded = rows.select("item", F.explode(window).alias("window"))
    return exploded.select(F.xxhash64("window").alias("key"), "window", "item")


def distinct_windows(windows: DataFrame) -> DataFrame:
    """``key, window``, each once; two windows of one key raise."""
    clash = F.raise_error(F.lit("two windows have the same key")).cast("array<string>")
    least, most = F.min("window"), F.max("window")
    one = F.when(least == most, least).otherwise(clash).alias("window")
    return windows.groupBy("key").agg(one)


def phrase_blocks(windows: DataFrame, most: int = BLOCK_WINDOWS) -> Iterator[Phrases]:
    """The distinct ``key, window`` rows in blocks of about ``most``, one at a time on the driver."""
    n = windows.count()
    blocks = -(-n // most)
    for k in range(blocks):
        rows = windows.where(F.pmod("key", F.lit(blocks)) == k).select("key", "window").toArrow()
        size = pc.list_value_length(rows["window"]).to_numpy().astype(np.int64)
        flat = pa.chunked_array(rows["window"]).combine_chunks().flatten()
        if isinstance(flat, pa.ChunkedArray):
            flat = flat.combine_chunks()
        coded = flat.dictionary_encode()
        symbols = np.zeros((len(size), WINDOW_WORDS if not len(size) else int(size.max())), np.int64)
        width = symbols.shape[1]
        row = np.repeat(np.arange(len(size)), size)
        column = np.arange(len(row)) - np.repeat(np.cumsum(size) - size, size) + width - size[row]
        symbols[row, column] = coded.indices.to_numpy() + 1
        yield Phrases(coded.dictionary, symbols, size, rows["key"].to_numpy())


def _runs(known: np.ndarray, doc: np.ndarray, least: int) -> np.ndarray:
    """Words that stand in a run of at least ``least`` benchmark words of one text."""
    n = len(known)
    if not n:
        return np.zeros(0, dtype=np.int64)
    breaks = np.flatnonzero((known[1:] != known[:-1]) | (doc[1:] != doc[:-1])) + 1
    start = np.concatenate(([0], breaks))
    size = np.diff(np.concatenate((start, [n])))
    kept = known[start] & (size >= least)
    return np.flatnonzero(np.repeat(kept, size))


def shard_hits(phrases: Phrases, column: pa.Array):
    """Occurrences of the phrases in a shard of texts.

    Returns the words, a mark per word that an occurrence covers, and pairs
    (text, window). Words that no phrase holds split the texts; runs between them
    that are shorter than every phrase can't hold one. The index covers the rest,
    runs parted by a symbol of their own.
    """
    words = split_words(column, ALNUM, lower=True)
    covered = np.zeros(len(words.start) + 1, dtype=np.int64)
    nothing = np.zeros((0, 2), dtype=np.int64)
    if not len(words.start) or not len(phrases.lengths):
        return words, covered[:-1] > 0, nothing
    number = pc.index_in(words.array(), value_set=phrases.vocabulary)
    number = pc.fill_null(number, -1).to_numpy(zero_copy_only=False).astype(np.int64)
    at = _runs(number >= 0, words.doc, int(phrases.lengths.min()))
    if not len(at):
        return words, covered[:-1] > 0, nothing
    # Symbols of the shard: 1 parts runs, the others are the words present, renumbered.
    present, local = np.unique(number[at], return_inverse=True)
    parted = np.flatnonzero((np.diff(at) != 1) | (np.diff(words.doc[at]) != 0)) + 1
    sequence = np.insert(local + 2, parted, 1)
    origin = np.insert(at, parted, -1)
    wanted = np.zeros(len(phrases.vocabulary) + 1, dtype=np.int64)
    wanted[present + 1] = np.arange(len(present)) + 2
    symbols = wanted[phrases.symbols]
    asked = np.flatnonzero(((symbols > 0) | (phrases.symbols == 0)).all(axis=1))
    if not len(asked):
        return words, covered[:-1] > 0, nothing
    index = FMIndex(sequence)
    low, high = index.search(symbols[asked], phrases.lengths[asked])
    n = high - low
    rows = np.repeat(low, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    window = np.repeat(asked, n)
    first = origin[index.locate(rows)]
    np.add.at(covered, first, 1)
    np.add.at(covered, first + phrases.lengths[window], -1)
    pairs = np.unique(np.stack([words.doc[first], window], axis=1), axis=0)
    return words, np.cumsum(covered)[:-1] > 0, pairs


HITS = "array<struct<start:int,end:int>>"


def _marked(phrases, text: str, schema: pa.Schema):
    """A step over rows: adds to ``_spans`` (word ranges) and ``_keys`` (windows) what the block finds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = phrases.value
        for batch in sliced(batches, text):
            words, covered, pairs = shard_hits(block, batch.column(text))
            first = words.first()
            old_spans, keys = batch.column("_spans"), batch.column("_keys").to_pylist()
            for doc, window in pairs.tolist():
                keys[doc].append(int(block.keys[window]))
            spans = []
            for d, old in enumerate(old_spans.to_pylist()):
                mark = covered[first[d] : first[d + 1]].copy()
                for s in old or ():
                    mark[s["start"] : s["end"]] = True
                edge = np.flatnonzero(np.diff(np.concatenate(([0], mark.view(np.int8), [0]))))
                spans.append([{"start": a, "end": b} for a, b in edge.reshape(-1, 2).tolist()])
            out = [batch.column(c) for c in batch.schema.names if c not in ("_spans", "_keys", "_words")]
            out += [
                pa.array(spans, schema.field("_spans").type),
                pa.array([sorted(x) for x in keys], schema.field("_keys").type),
                pa.array(np.diff(first), pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(out, schema=schema)

    return run


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    *,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    block: int = BLOCK_WINDOWS,
) -> DataFrame:
    """``docs`` with ``_spans`` (merged ranges of words inside an occurrence), ``_keys`` of windows, ``_words``.

    Each slice of a partition is a shard with an index of its own; nothing is
    shuffled. Benchmark windows are looked for in blocks of bounded size, one after
    the other within the same task and worker. NULL and empty texts have no words; an
    empty benchmark finds nothing. Repeated rows are marked each, no rows give none, and a text may be of
    any length.
    """
    windows = stored(distinct_windows(benchmark_windows(benchmark, item_id=item_id, text=item_text)))
    out, steps = _marking(docs, list_blocks(windows, block), text)
    return out.mapInArrow(_in_turn(steps), out.schema)


def _marking(docs: DataFrame, blocks: Iterator[Phrases], text: str) -> tuple[DataFrame, list]:
    """``docs`` with marks, and the steps over them that are left: one for each of the last blocks.

    The driver has one block at a time, workers those of one pass.
    """
    out = docs.withColumns(
        {
            "_spans": F.array().cast(HITS),
            "_keys": F.array().cast("array<long>"),
            "_words": F.lit(0).cast("long"),
        }
    )
    schema, held = _arrow_schema(out), []
    for phrases in blocks:
        if len(held) == PASS_BLOCKS:
            out = stored(out.mapInArrow(_in_turn([_marked(h, text, schema) for h in held]), out.schema))
            for h in held:
                h.drop()
            held = []
        held.append(Shared(docs.sparkSession, phrases))
    return out, [_marked(h, text, schema) for h in held]


def _in_turn(steps: list):
    """The passes as one, so that a task needs one Python worker however many they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for step in steps:
            batches = step(batches)
        return batches

    return run


def list_blocks(windows: DataFrame, block: int) -> Iterator[Phrases]:
    """The blocks, or one without phrases, which still counts the words."""
    empty = True
    for phrases in phrase_blocks(windows, block):
        empty = False
        yield phrases
    if empty:
        none = np.zeros((0, WINDOW_WORDS), np.int64)
        yield Phrases(pa.array([], pa.string()), none, np.zeros(0, np.int64), np.zeros(0, np.int64))


def _arrow_schema(df: DataFrame) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(df.schema)


def contamination_report(
    docs: DataFrame, benchmark: DataFrame, *, doc_id: str = "doc_id", text: str = "text", block: int = BLOCK_WINDOWS
) -> DataFrame:
    """``doc_id, n_words, n_hit, n_items, items_sha256, contaminated`` per row of ``docs``.

    Items are named once for every set of windows that some text has. Windows that the same items hold, as
    those of one passage do, count as one on the way there, so a passage in very many items costs
    its items once and not once a window.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    found = stored(find_contamination(rows, benchmark, block=block).drop("text"))
    hit_rows = found.where(F.size("_keys") > 0).withColumn("_set", F.sha2(F.concat_ws(",", "_keys"), 256))
    sets = hit_rows.groupBy("_set").agg(F.first("_keys").alias("_keys"))
    pairs = stored(benchmark_windows(benchmark).select("key", "item").distinct())
    # A class of windows is known by the number of its items and two sums of their hashes.
    sums = [F.sum(F.xxhash64(F.lit(seed), "item").cast("decimal(38,0)")).cast("string") for seed in (1, 2)]
    classes = pairs.groupBy("key").agg(F.concat_ws(":", F.count("*").cast("string"), *sums).alias("class"))
    first = classes.groupBy("class").agg(F.min("key").alias("key"))
    of_set = sets.select("_set", F.explode("_keys").alias("key")).join(classes, "key").select("_set", "class").distinct()
    items = of_set.join(first, "class").join(pairs, "key").select("_set", "item").distinct()
    named = items.groupBy("_set").agg(F.sort_array(F.collect_list("item")).alias("_items"))
    named = named.select(
        "_set",
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_items", ","), 256).alias("items_sha256"),
    )
    hit = F.aggregate("_spans", F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    none = {"n_items": F.lit(0).cast("long"), "items_sha256": F.sha2(F.lit(""), 256)}
    clean = found.where(F.size("_keys") == 0).withColumns(none)
    return hit_rows.join(named, "_set").unionByName(clean, allowMissingColumns=True).select(
        "doc_id",
        F.col("_words").alias("n_words"),
        hit.alias("n_hit"),
        "n_items",
        "items_sha256",
        (F.size("_spans") > 0).alias("contaminated"),
    )


def _cut(value: str, spans: list[dict]) -> str:
    out, at = [], 0
    ranges = {s["start"]: s["end"] for s in spans}
    raw = value.encode()
    words = split_words(pa.array([value]), ALNUM, lower=True)
    for a, b in sorted(ranges.items()):
        out.append(raw[at : words.start[a]])
        at = int(words.end[b - 1])
    return b"".join([*out, raw[at:]]).decode()


def decontaminated(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with every merged removal span cut out of ``text``; ``n_chars`` follows.

    Texts that nothing was found in are unchanged. Rows whose text loses all its
    words are dropped; rows that had none stay.
    """
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    names = plain.columns
    text_column, size_column = names[docs.columns.index(text)], None
    if n_chars in docs.columns:
        size_column = names[docs.columns.index(n_chars)]
    windows = stored(distinct_windows(benchmark_windows(benchmark)))
    marked, steps = _marking(plain, list_blocks(windows, BLOCK_WINDOWS), text_column)
    schema = _arrow_schema(plain)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column("_spans")
            hit = pc.list_value_length(spans).to_numpy(zero_copy_only=False) > 0
            kept, columns = np.ones(batch.num_rows, bool), {c: batch.column(c) for c in names}
            if hit.any():
                values = batch.column(text_column).to_pylist()
                words = batch.column("_words").to_pylist()
                for i in np.flatnonzero(hit).tolist():
                    ranges = spans[i].as_py()
                    kept[i] = sum(s["end"] - s["start"] for s in ranges) < words[i]
                    values[i] = _cut(values[i], ranges)
                columns[text_column] = pa.array(values, schema.field(text_column).type)
                if size_column:
                    counted = pc.utf8_length(columns[text_column]).cast(schema.field(size_column).type)
                    columns[size_column] = pc.if_else(pa.array(hit), counted, columns[size_column])
            out = pa.RecordBatch.from_arrays([columns[c] for c in names], schema=schema)
            yield out.filter(pa.array(kept)) if not kept.all() else out

    return marked.mapInArrow(_in_turn([*steps, run]), plain.schema).toDF(*docs.columns)
