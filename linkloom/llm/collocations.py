"""Phrases whose words keep together, from a weighted de Bruijn graph of each language.

An edge is a run of four words and its weight the number of occurrences; it leads from the
node of its first three words to that of its last three. A piece of text that ends
leads from its last node to an end instead: ``a b c .`` and, shorter, ``a b . .``
and ``a . . .``. So every word occurrence starts exactly one edge, and shorter phrases need
no counting of their own: a node's flow, the weights of what leaves it, is its number of
occurrences; flows of nodes that begin alike add up to the counts of two words, and those
to the counts of one.

Edges travel in packs: per slice of text, language and bucket of nodes one row with the words
that occur, and the edges as numbers of these words. A slice holds each edge
once, so an edge that is in a third of all texts is a row per slice. The edges of
a node meet in one bucket, and the number of buckets grows with the text.

Frequent edges are then compacted: chains of nodes with one way in and one way
out become one row with the words and weights along it. What lies inside longer phrases
is read off these rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.frames import stored
from linkloom.llm.words import mixed, sliced, split_words

LEAST = 30
TOP = 2000
#: Per cent of a phrase's occurrences that lie in one longer phrase, from which on it is dropped.
INSIDE = 80
SCALE = 2_000_000
NO_LANGUAGE = "und"
#: Words of an edge, and bytes of text a bucket is for.
WIDTH = 4
BUCKET_BYTES = 8 << 20
LEAST_BUCKETS = 64
#: Bytes of text whose edges are counted together before they travel.
SLICE = 6 << 20
#: Parts of a language that are ranked by themselves.
RANKED_PARTS = 64
#: Edges in one row of a compacted path.
PATH_EDGES = 256

SEPARATORS = b".,;:!?\x0a\x0b\x0c\x0d"
_SEPARATES = np.array([b in SEPARATORS for b in range(256)])
_IN_WORD = np.array([b not in SEPARATORS + b"\x20\x09" for b in range(256)])

_PACK = "bucket int, lang string, words binary, size int, grams binary, counts binary"
_PACK_ARROW = [
    ("bucket", pa.int32()),
    ("lang", pa.string()),
    ("words", pa.binary()),
    ("size", pa.int32()),
    ("grams", pa.binary()),
    ("counts", pa.binary()),
]
_FOUND = "k int, phrase string, f long, " + _PACK
_FOUND_ARROW = [("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64()), *_PACK_ARROW]


def distinct_rows(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The different rows in ascending order, and the sum of counts of each."""
    key, room = np.zeros(len(counts), dtype=np.int64), 1
    for column in columns:
        size = int(column.max(initial=0)) + 1
        if room * size >= 1 << 62:
            values, key = np.unique(key, return_inverse=True)
            room = len(values)
        key, room = key * size + column, room * size
    order = np.argsort(key, kind="stable")
    key = key[order]
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else order
    totals = np.add.reduceat(counts[order], first) if len(key) else counts
    return [column[order[first]] for column in columns], totals


def prefix_sums(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sums over rows that agree in ``columns``; rows are in ascending order."""
    if not len(counts):
        return columns, counts
    new = np.zeros(len(counts), dtype=bool)
    new[0] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    first = np.flatnonzero(new)
    return [column[first] for column in columns], np.add.reduceat(counts, first)


def _squeezed(values: np.ndarray, codec: zstandard.ZstdCompressor) -> bytes:
    """Numbers in as few bytes as the largest needs, all first bytes first, compressed."""
    small = values.astype(np.min_scalar_type(int(values.max(initial=0))).newbyteorder("<")).ravel()
    return codec.compress(np.ascontiguousarray(small.view(np.uint8).reshape(len(small), -1).T).tobytes())


def _restored(packed: bytes, n: int, codec: zstandard.ZstdDecompressor) -> np.ndarray:
    planes = np.frombuffer(codec.decompress(packed), dtype=np.uint8).reshape(-1, n)
    return np.ascontiguousarray(planes.T).view(f"<u{len(planes)}").ravel().astype(np.int64)


def _packed(
    lang: str, words: pa.Array, columns: list[np.ndarray], counts: np.ndarray, key: int, buckets: int
) -> pa.Table:
    """The rows of one language as packs, by the hash of their first ``key`` words.

    Columns number ``words`` from 1; 0 is the end. ``lang`` is part of the hash.
    """
    listed = words.cast(pa.binary()).to_pylist()
    names = np.array([b"", *listed], dtype=object)
    # Number 0, the end, has a hash too.
    hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in names), dtype=np.uint64, count=len(names))
    mix = np.full(len(counts), xxhash.xxh3_64_intdigest(lang), dtype=np.uint64)
    with np.errstate(over="ignore"):
        for column in columns[:key]:
            mix = mixed(mix * np.uint64(3) + hashes[column])
    bucket = (mix % np.uint64(buckets)).astype(np.min_scalar_type(buckets))
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True]))) if len(bucket) else [0]
    grams = np.stack([column[order] for column in columns])
    counts = counts[order]
    place = np.zeros(len(words) + 1, dtype=np.int64)
    known, packs, numbers = [], [], []
    codec = zstandard.ZstdCompressor(level=1)
    for start, end in zip(cuts[:-1], cuts[1:]):
        mine = np.unique(grams[:, start:end])
        mine = mine[mine > 0]
        place[mine] = np.arange(1, len(mine) + 1)
        # No word has a line end in it.
        known.append(codec.compress(b"\n".join(names[mine].tolist())))
        packs.append(_squeezed(place[grams[:, start:end]], codec))
        numbers.append(_squeezed(counts[start:end], codec))
    return pa.table(
        {
            "bucket": pa.array(bucket[cuts[:-1]] if len(bucket) else [], pa.int32()),
            "lang": pa.array([lang] * len(packs), pa.string()),
            "words": pa.array(known, pa.binary()),
            "size": pa.array(np.diff(cuts), pa.int32()),
            "grams": pa.array(packs, pa.binary()),
            "counts": pa.array(numbers, pa.binary()),
        }
    )


def _unpacked(packs: pa.Table, width: int) -> tuple[pa.Array, list[np.ndarray], np.ndarray]:
    """The words, rows and counts of several packs, with words numbered alike; rows may repeat."""
    codec = zstandard.ZstdDecompressor()
    lists = [codec.decompress(x).split(b"\n") for x in packs["words"].to_pylist()]
    coded = pa.array([w for words in lists for w in words], pa.binary()).cast(pa.string()).dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1
    at, grams, counts = 0, [], []
    for words, size, packed, numbers in zip(lists, *(packs[c].to_pylist() for c in ("size", "grams", "counts"))):
        own = np.concatenate(([0], code[at : at + len(words)]))
        at += len(words)
        grams.append(own[_restored(packed, width * size, codec)].reshape(width, size))
        counts.append(_restored(numbers, size, codec))
    return coded.dictionary, list(np.concatenate(grams, axis=1)), np.concatenate(counts)


def _edges(docs: DataFrame, buckets: int) -> DataFrame:
    """Packs of the edges of each slice, by the hash of the node that they leave."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _gathered(sliced(batches, "text", SLICE)):
            words = split_words(part.column("text"), keep=_IN_WORD, lower=True)
            if not len(words.start):
                continue
            coded = words.array().dictionary_encode()
            code = coded.indices.to_numpy(zero_copy_only=False) + 1
            # Words of one piece have the same text and number of separators before them.
            before = np.cumsum(_SEPARATES[words.data], dtype=np.int64)[words.start]
            last = np.ones(len(code), dtype=bool)
            last[:-1] = (words.doc[1:] != words.doc[:-1]) | (before[1:] != before[:-1])
            ends = np.flatnonzero(last)
            left = ends[np.searchsorted(ends, np.arange(len(code)))] - np.arange(len(code))
            padded = np.concatenate((code, np.zeros(WIDTH, dtype=code.dtype)))
            grams = [np.where(left >= k, padded[k : k + len(code)], 0) for k in range(WIDTH)]
            lang = pc.fill_null(part.column("lang"), NO_LANGUAGE).dictionary_encode()
            spoken = lang.indices.to_numpy(zero_copy_only=False)[words.doc]
            (spoken, *grams), counts = distinct_rows([spoken, *grams], np.ones(len(code), dtype=np.int64))
            for number, name in enumerate(lang.dictionary.to_pylist()):
                own = slice(*np.searchsorted(spoken, (number, number + 1)))
                if own.start < own.stop:
                    mine = [column[own] for column in grams]
                    known = coded.dictionary
                    if len(lang.dictionary) > 1:
                        some = np.unique(np.stack(mine))
                        some = some[some > 0]
                        place = np.zeros(len(known) + 1, dtype=np.int64)
                        place[some] = np.arange(1, len(some) + 1)
                        mine, known = [place[column] for column in mine], known.take(pa.array(some - 1))
                    yield from _packed(name, known, mine, counts[own], WIDTH - 1, buckets).to_batches()

    plain = docs.select(F.col("lang").cast("string").alias("lang"), "text")
    return plain.mapInArrow(run, _PACK)


def _gathered(parts: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbouring slices together, up to ``SLICE`` bytes or one text."""
    held, size = [], 0
    for part in parts:
        if held and size + part.column("text").nbytes > SLICE:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
        if part.num_rows:
            held.append(part)
            size += part.column("text").nbytes
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _flows(packs: DataFrame, width: int, lengths: tuple[int, ...], onward: int, buckets: int, least: int) -> DataFrame:
    """Counts of phrases of ``lengths`` words, and packs of the flows by the first ``onward`` words.

    All rows of a phrase of those lengths have to be in one bucket.
    """

    def run(table: pa.Table) -> pa.Table:
        lang = table["lang"][0].as_py()
        words, columns, counts = _unpacked(table, width)
        columns, counts = distinct_rows(columns, counts)
        names = np.array([None, *words.to_pylist()], dtype=object)
        k, phrase, f = [], [], []
        for length in lengths:
            heads, sums = prefix_sums(columns[:length], counts)
            some = np.flatnonzero((heads[-1] > 0) & (sums >= least))
            k += [length] * len(some)
            phrase += [" ".join(x) for x in zip(*(names[head[some]] for head in heads))]
            f += sums[some].tolist()
        if not onward:
            k, phrase, f = [*k, 0], [*phrase, ""], [*f, int(counts.sum())]
        n = len(k)
        found = {"k": k, "phrase": phrase, "f": f, "lang": [lang] * n}
        out = pa.table({c: pa.array(found.get(c, [None] * n), kind) for c, kind in _FOUND_ARROW})
        if onward:
            heads, sums = prefix_sums(columns[:onward], counts)
            sent = _packed(lang, words, heads, sums, onward, buckets)
            empty = [("k", pa.int32()), ("phrase", pa.string()), ("f", pa.int64())]
            sent = pa.table({**{c: pa.nulls(len(sent), kind) for c, kind in empty}, **{c: sent[c] for c in sent.column_names}})
            out = pa.concat_tables([out, sent])
        return out

    return stored(packs.groupBy("bucket", "lang").applyInArrow(run, _FOUND))


def phrase_counts(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """``lang, k, phrase, f``: phrases of 1 to 4 words that occur ``least`` times, from flows of the graph.

    A row with ``k = 0`` holds a part of the number of all words of its language.
    """
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(LEAST_BUCKETS, -(-size // BUCKET_BYTES))
    of_nodes = _flows(_edges(docs, buckets), WIDTH, (WIDTH, WIDTH - 1), WIDTH - 2, buckets, least)
    sent = [c.split(" ")[0] for c in _PACK.split(", ")]
    of_pairs = _flows(of_nodes.where("bucket IS NOT NULL").select(sent), 2, (2,), 1, buckets, least)
    of_words = _flows(of_pairs.where("bucket IS NOT NULL").select(sent), 1, (1,), 0, buckets, least)
    out = [x.where("k IS NOT NULL").select("lang", "k", "phrase", "f") for x in (of_nodes, of_pairs, of_words)]
    return out[0].unionByName(out[1]).unionByName(out[2])


def compact_paths(edges: DataFrame) -> DataFrame:
    """``lang, words, weights``: chains of edges over nodes with one way in and one way out.

    ``edges`` has ``lang, phrase, f`` with different phrases of four words. Edges find the start
    of their chain by pointers that double their reach every round. An edge of a ring has no start and
    stays by itself; chains of over 256 edges are cut into rows of that many.
    """
    words = F.split("phrase", " ")
    edges = edges.select("lang", "phrase", "f", words.alias("words"))
    node = lambda at: F.array_join(F.slice("words", at, WIDTH - 1), " ")
    ways = edges.select("lang", node(2).alias("node"), F.col("phrase").alias("into"), F.lit(None).cast("string").alias("out"))
    ways = ways.unionByName(
        edges.select("lang", node(1).alias("node"), F.lit(None).cast("string").alias("into"), F.col("phrase").alias("out"))
    )
    counted = ways.groupBy("lang", "node").agg(
        F.count("into").alias("n_in"), F.count("out").alias("n_out"), F.min("into").alias("start"), F.min("out").alias("phrase")
    )
    links = counted.where("n_in = 1 AND n_out = 1 AND start <> phrase").select("lang", "phrase", "start")
    at = edges.join(links, ["lang", "phrase"], "left").select(
        "lang",
        "phrase",
        F.coalesce("start", "phrase").alias("start"),
        F.col("start").isNotNull().cast("long").alias("steps"),
    )
    at, before = stored(at), None
    while True:
        further = at.select(
            "lang", F.col("phrase").alias("start"), F.col("start").alias("next"), F.col("steps").alias("more")
        )
        at = stored(
            at.join(further, ["lang", "start"]).select(
                "lang",
                "phrase",
                F.col("next").alias("start"),
                (F.col("steps") + F.col("more")).alias("steps"),
                (F.col("next") == F.col("start")).alias("done"),
            )
        )
        left = at.where(~F.col("done")).count()
        # Every round ends some chain, as long as anything but rings is left.
        if left in (0, before):
            break
        before = left
    placed = edges.join(at, ["lang", "phrase"]).select(
        "lang",
        F.when(F.col("done"), F.col("start")).otherwise(F.col("phrase")).alias("start"),
        F.when(F.col("done"), F.col("steps")).otherwise(0).alias("steps"),
        "words",
        "f",
    )
    row = F.sort_array(F.collect_list(F.struct("steps", "words", "f"))).alias("edges")
    chains = placed.groupBy("lang", "start", F.floor(F.col("steps") / PATH_EDGES).alias("part")).agg(row)
    return chains.select(
        "lang",
        F.expr(f"concat(edges[0].words, transform(slice(edges, 2, size(edges)), x -> x.words[{WIDTH - 1}]))").alias("words"),
        F.col("edges.f").alias("weights"),
    )


def _inside(paths: DataFrame, length: int) -> DataFrame:
    """``lang, phrase, most``: phrases of a path with the weight of the heaviest edge of it around them."""
    reach = WIDTH - length
    return paths.select(
        "lang",
        F.expr(
            f"inline(transform(sequence(0, size(words) - {length}), j -> named_struct("
            f"'phrase', array_join(slice(words, j + 1, {length}), ' '), "
            f"'most', array_max(slice(weights, greatest(j - {reach}, 0) + 1, "
            f"least(j, size(weights) - 1) - greatest(j - {reach}, 0) + 1)))))"
        ),
    )


def _first(rows: DataFrame, by: list[str], top: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.desc("a"), "phrase")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, inside: int = INSIDE) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: each language's best phrases of 2 to 4 words.

    Texts, with A-Z in lower case, are cut into pieces at ``. , ; : ! ?`` and line ends, and
    these into words at spaces and tabs. A phrase has ``a >= least`` occurrences inside
    pieces; its score is the least of ``2000000 * a / (l + r)`` over its cuts in two,
    rounded down, ties to the shortest first part. Phrases inside a longer one that has ``inside``
    per cent of their occurrences are dropped. Ranks go by score, occurrences, then the
    bytes of the phrase, so there are no ties.

    A NULL language is ``und``. NULL and empty texts have no words; a text may be of
    any length. Every row counts, repeated ones too; ids and other columns are not looked at. No
    rows give no rows.
    """
    counts = phrase_counts(docs, least)
    totals = counts.where("k = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    counts = counts.where("k > 0")
    longest, threes = counts.where(F.col("k") == WIDTH), counts.where(F.col("k") == WIDTH - 1)
    paths = stored(compact_paths(longest))
    halves = threes.select("lang", F.split("phrase", " ").alias("words"), F.array("f").alias("weights"))
    pairs = halves.select(
        "lang",
        F.expr("inline(transform(array(1, 2), j -> named_struct('phrase', array_join(slice(words, j, 2), ' '), 'most', weights[0])))"),
    )
    covers = _inside(paths, 3).unionByName(_inside(paths, 2)).unionByName(pairs)
    covers = covers.groupBy("lang", "phrase").agg(F.max("most").alias("most"))
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    able = counts.where("k > 1").join(covers, ["lang", "phrase"], "left")
    able = able.where(F.col("most").isNull() | (exact("most") * 100 < exact("f") * inside))
    cut = able.select(
        "lang",
        "phrase",
        F.col("f").alias("a"),
        F.expr(
            "inline(transform(sequence(1, k - 1), j -> named_struct('j', j, "
            "'first', array_join(slice(split(phrase, ' '), 1, j), ' '), "
            "'rest', array_join(slice(split(phrase, ' '), j + 1, k - j), ' '))))"
        ),
    )
    part = counts.where(F.col("k") < WIDTH)
    cut = cut.join(part.select("lang", F.col("phrase").alias("first"), F.col("f").alias("l")), ["lang", "first"])
    cut = cut.join(part.select("lang", F.col("phrase").alias("rest"), F.col("f").alias("r")), ["lang", "rest"])
    score = F.expr(f"cast({SCALE} * cast(a AS decimal(20,0)) div (cast(l AS decimal(20,0)) + r) AS long)")
    best = cut.groupBy("lang", "phrase", "a").agg(F.min(F.struct(score.alias("score"), "j", "l", "r")).alias("cut"))
    best = best.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
    # A language's phrases are ranked in parts first, so the last task has a bounded number of them.
    parts = best.withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(RANKED_PARTS)))
    ranked = _first(_first(parts, ["lang", "part"], top).drop("part", "rank"), ["lang"], top)
    ranked = ranked.withColumn("rank", F.col("rank").cast("long")).join(totals, "lang")
    return ranked.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
