"""SentencePiece encoding as a relational lattice, and exact decoding."""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.words import Words, memory_trim, sliced, text_bytes, word_hashes

SPACE = "▁"
MODEL = "/opt/tokenizers/piece_bpe_32k.model"

#: Offset of the ranks under Zipf's law.
ZIPF = 100.0
#: Scores become whole numbers: ``-score`` in units of the greatest one over 2 ** (COST_BITS - 1).
#: A character that no piece is costs twice the dearest piece.
COST_BITS = 24
#: Bytes of text that are packed into one row and regrouped together.
PACK_BYTES = 2 << 20
#: Texts that the cache of frequent runs is chosen from, and its size. Any cache gives
#: the same tokens; runs that are not in it go through the lattice of their pack.
CACHE_TEXTS, CACHE_RUNS = 50_000, 400_000
#: Runs longer than this many characters are folded in Python, in linear memory.
LONG_RUN = 2048
#: Bits of an edge for its piece, and the place of its end above the length. Above the end stands the word, in a pack.
PIECE_BITS = 17
END_AT, WORD_AT, WORD_BITS = PIECE_BITS + 5, PIECE_BITS + 17, 25
PIECE_MASK, COST_MASK = (1 << PIECE_BITS) - 1, -(1 << PIECE_BITS + 5)
#: Words of the cache and bytes of text that one task of the lattice gets, and the most tasks. The
#: numbers of partitions are given, since each word becomes dozens of edges after the shuffle.
TASK_WORDS, TASK_BYTES, MOST_TASKS = 10_000, 2 * PACK_BYTES, 50_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces of a model: those of ordinary text with their scores, and one for each byte."""

    pieces: list[str]
    costs: np.ndarray  # negated scores in whole units, below 2 ** COST_BITS
    usable: np.ndarray
    bytes_at: np.ndarray  # piece number of each byte, -1 without byte pieces
    unknown: int

    @property
    def longest(self) -> int:
        return max(len(p) for p, u in zip(self.pieces, self.usable, strict=True) if u)

    @property
    def unknown_cost(self) -> int:
        return int(self.costs[self.usable].max() * 2)


def load_vocabulary(path: str = MODEL, zipf: float | None = ZIPF) -> Vocabulary:
    """Read a model file on the driver. Its path is a parameter; nothing of it is kept.

    A best path needs log-probabilities. Models made by merges have ranks for scores
    instead; with ``zipf`` the piece of rank r gets the log-probability of Zipf's law, in
    proportion to 1 / (r + zipf). ``None`` takes the scores as they are, for models that
    have log-probabilities.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    n = model.get_piece_size()
    pieces = [model.id_to_piece(i) for i in range(n)]
    special = [model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i) for i in range(n)]
    places = {p: i for i, p in enumerate(pieces)}
    at = np.array([places[f"<0x{b:02X}>"] if model.is_byte(places.get(f"<0x{b:02X}>", 0)) else -1 for b in range(256)])
    scores = np.array([model.get_score(i) for i in range(n)])
    usable = ~np.array(special)
    if zipf is not None:
        share = 1 / (np.maximum(-scores, 0) + zipf)
        scores = np.log(share / share[usable].sum())
    # Pieces that a model all but forbids are as dear as the dearest other one.
    costs = np.where(-scores > 1e8, -1, -scores)
    costs = np.where(costs < 0, costs[usable].max(), costs)
    costs = np.round(costs * (2 ** (COST_BITS - 1) - 1) / costs[usable].max()).astype(np.int64)
    if n >= 1 << 17 or max(len(p) for p, u in zip(pieces, usable, strict=True) if u) > 31:
        raise ValueError("models of over 131,071 pieces, or with pieces of over 31 characters, are not supported")
    bad = [p for p, s in zip(pieces, special, strict=True) if not s and SPACE in p.lstrip(SPACE)]
    if bad:
        raise ValueError(f"pieces that go on over a space are not supported: {bad[:3]}")
    return Vocabulary(pieces, costs, usable, at, model.unk_id())


# --- runs: stretches of text that no piece leaves ------------------------------------


@dataclass(frozen=True)
class Joints:
    """Pairs of characters that stand side by side in some piece.

    Between two characters that don't, no piece can span, so a best path is the best
    paths of both sides. Texts are cut there, exactly.
    """

    letters: np.ndarray  # code points of longer pieces, sorted
    pairs: np.ndarray  # square table over letters, and a last one for all others

    @classmethod
    def of(cls, vocabulary: Vocabulary) -> Joints:
        used = [p for p, u in zip(vocabulary.pieces, vocabulary.usable, strict=True) if u and len(p) > 1]
        letters = np.unique([ord(c) for p in used for c in p])
        place = {chr(c): i for i, c in enumerate(letters)}
        pairs = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        for p in used:
            for a, b in zip(p, p[1:], strict=False):
                pairs[place[a], place[b]] = True
        return cls(letters, pairs)

    def index(self) -> np.ndarray:
        out = np.full(0x110000, len(self.letters), dtype=np.int32)
        out[self.letters] = np.arange(len(self.letters))
        return out


def text_runs(joints: Joints, index: np.ndarray, column: pa.Array) -> tuple[pa.StringArray, np.ndarray]:
    """The runs of all texts in turn, and how many each text has. Spaces are the space mark."""
    texts = [SPACE + t.replace(" ", SPACE) if t else "" for t in column.to_pylist()]
    joined = "".join(texts)
    ends = np.cumsum([len(t) for t in texts]) if texts else np.zeros(0, np.int64)
    points = np.frombuffer(joined.encode("utf-32-le"), dtype=np.uint32)
    letter = index[points]
    cut = np.ones(len(points) + 1, dtype=bool)
    if len(points):
        cut[1:-1] = ~joints.pairs[letter[:-1], letter[1:]]
        cut[ends] = True
    start = np.flatnonzero(cut[:-1])
    width = 1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF)
    reach = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
    offsets = np.append(reach[start], reach[-1]).astype(np.int32)
    data = pa.py_buffer(joined.encode())
    runs = pa.StringArray.from_buffers(len(start), pa.py_buffer(offsets), data)
    before = np.searchsorted(start, np.concatenate(([0], ends)))
    return runs, np.diff(before)


# --- the lattice -----------------------------------------------------------------------


def piece_table(spark: SparkSession, vocabulary: Vocabulary) -> DataFrame:
    """``piece, id, cost`` of the usable pieces; as many rows as the model has pieces."""
    at = np.flatnonzero(vocabulary.usable)
    table = pa.table(
        {
            "piece": pa.array([vocabulary.pieces[i] for i in at]),
            "id": pa.array(at.astype(np.int32)),
            "cost": pa.array(vocabulary.costs[at]),
        }
    )
    return spark.createDataFrame(table)


def lattice_edges(words: DataFrame, pieces: DataFrame, longest: int) -> DataFrame:
    """``words`` (column ``word`` of 1 to ``LONG_RUN`` characters) with a row per edge of the lattice: ``_edge``.

    Substrings of up to ``longest`` characters are exploded and equi-joined to the pieces (a
    table of the model's size, broadcast); a single character is an edge even if it is no piece.
    An edge is one long. From the high bits down: end (12 bits), length (5) and piece + 1 (17). ``_first``
    marks one edge of each row of ``words``.
    """
    n = F.length("word")
    starts = words.withColumn("_s", F.explode(F.sequence(F.lit(1), n)))
    most = F.least(F.lit(longest), n - F.col("_s") + 1)
    spans = starts.withColumn("_l", F.explode(F.sequence(F.lit(1), most)))
    spans = spans.withColumn("_piece", F.substring("word", F.col("_s"), F.col("_l")))
    found = F.broadcast(pieces.select(F.col("piece").alias("_piece"), F.col("id").alias("_id")))
    edges = spans.join(found, "_piece", "left").where(F.col("_id").isNotNull() | (F.col("_l") == 1))
    edge = F.expr(f"""
      shiftleft(cast(_s + _l - 1 AS bigint), {END_AT}) | shiftleft(cast(_l AS bigint), {PIECE_BITS})
      | cast(coalesce(_id, -1) + 1 AS bigint)""")
    return edges.select(*words.columns, edge.alias("_edge"), F.expr("_s = 1 AND _l = 1").alias("_first"))


def fold_edges(whose: np.ndarray, edges: np.ndarray, n: int, costs: np.ndarray) -> pa.ListArray:
    """Paths of ``n`` words from all their edges: one fold, in which the words go from end to end together.

    ``whose`` has each edge's word. ``path[e]`` is the piece that the best path to position e + 1 ends with, -1
    for a character that is no piece. Of equal costs the longer last piece wins. ``costs`` has the cost of
    a character that is no piece at its end.
    """
    end, length, piece = edges >> END_AT, edges >> PIECE_BITS & 31, (edges & PIECE_MASK) - 1
    # Every end has one edge of length 1.
    size = np.bincount(whose[length == 1], minlength=n)
    origin = np.concatenate(([0], np.cumsum(size + 1)))
    order = np.argsort(end << WORD_BITS | whose, kind="stable")
    whose, end, length, piece = whose[order], end[order], length[order], piece[order]
    # A way to a position is one long: its cost, 31 - length (5 bits) and piece + 1, of which the least is best.
    step = costs[piece] << PIECE_BITS + 5 | (31 - length) << PIECE_BITS | piece + 1
    to = origin[whose] + end
    since = to - length
    first = np.flatnonzero(np.concatenate(([True], to[1:] != to[:-1]))) if len(to) else np.zeros(0, np.int64)
    top = int(end[-1]) if len(end) else 0
    reach = np.searchsorted(end, np.arange(1, top + 2))
    part = np.searchsorted(first, reach)
    best = np.zeros(origin[-1], dtype=np.int64)
    for k in range(top):
        low, high, heads = reach[k], reach[k + 1], first[part[k] : part[k + 1]]
        ways = step[low:high] + (best[since[low:high]] & COST_MASK)
        best[to[heads]] = np.minimum.reduceat(ways, heads - low)
    last = np.delete((best & PIECE_MASK) - 1, origin[:-1])
    offsets = np.concatenate(([0], np.cumsum(size)))
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(last.astype(np.int32)))


def best_paths(words: DataFrame, pieces: DataFrame, longest: int, unknown_cost: int) -> DataFrame:
    """``words`` (distinct, column ``word`` of 1 to ``LONG_RUN`` characters) with ``path``, as ``fold_edges`` has it.

    Edges are grouped by word, and one fold keeps the best way to each position. A hash comes
    first among the keys, so that sorting seldom compares words.
    """
    keys = words.columns
    edges = lattice_edges(words, pieces, longest).groupBy(F.xxhash64(*keys).alias("_key"), *keys)
    grouped = edges.agg(F.collect_list("_edge").alias("_edges")).select(*keys, "_edges")
    known = pieces.select("id", "cost").toArrow()  # of the model's size
    costs = np.full(int(pc.max(known["id"]).as_py()) + 2, unknown_cost, dtype=np.int64)
    costs[known["id"].to_numpy()] = known["cost"].to_numpy()

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("_edges")
            whose = np.repeat(np.arange(len(lists)), pc.list_value_length(lists).to_numpy())
            paths = fold_edges(whose, lists.flatten().to_numpy(), len(lists), costs)
            yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in keys), paths], [*keys, "path"])

    schema = T.StructType([*words.schema.fields, T.StructField("path", T.ArrayType(T.IntegerType()))])
    return grouped.mapInArrow(folded, schema)


def fold_run(run: str, vocabulary: Vocabulary, places: dict[str, int]) -> list[int]:
    """The same fold for one very long run, over positions."""
    longest, unknown = vocabulary.longest, vocabulary.unknown_cost
    best, path = [0], []
    for end in range(1, len(run) + 1):
        top = None
        for size in range(1, min(longest, end) + 1):
            at = places.get(run[end - size : end], -1)
            if at >= 0 or size == 1:
                cost = int(vocabulary.costs[at]) if at >= 0 else unknown
                reached = (best[end - size] + cost, -size, at)
                top = reached if top is None else min(top, reached)
        best.append(top[0])
        path.append(top[2])
    return path


def ids_of(words: pa.Array, paths: pa.ListArray, vocabulary: Vocabulary, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Token numbers of all words in turn and where each word's begin: paths followed back.

    All words step together. Characters that are no piece become their UTF-8 bytes.
    """
    offsets = np.asarray(paths.offsets).astype(np.int64)
    last = np.asarray(paths.values).astype(np.int64)
    at, live = np.diff(offsets), np.arange(len(words))
    whose, found, place = [], [], []
    while len(live := live[at[live] > 0]):
        piece = last[offsets[live] + at[live] - 1]
        at[live] -= np.where(piece >= 0, size[piece], 1)
        whose.append(live)
        found.append(piece)
        place.append(at[live].copy())
    if not whose:
        return np.zeros(0, np.int64), np.zeros(len(words) + 1, np.int64)
    whose, found, place = (np.concatenate(x) for x in (whose, found, place))
    order = np.lexsort((place, whose))
    whose, found, place = whose[order], found[order], place[order]
    unknown = np.flatnonzero(found < 0)
    if len(unknown):
        parts, width = [], np.ones(len(found), dtype=np.int64)
        for i in unknown.tolist():
            raw = words[int(whose[i])].as_py()[int(place[i])].encode()
            parts.append([int(vocabulary.bytes_at[b]) for b in raw])
            if min(parts[-1]) < 0:
                parts[-1] = [vocabulary.unknown]
            width[i] = len(parts[-1])
        whose = np.repeat(whose, width)
        known = np.repeat(found, width)
        known[known < 0] = [v for p in parts for v in p]
        found = known
    starts = np.searchsorted(whose, np.arange(len(words) + 1))
    return found, starts


# --- documents ---------------------------------------------------------------------------


def run_hashes(runs: pa.Array) -> np.ndarray:
    data, offsets = text_bytes(runs)
    return word_hashes(Words(data, offsets, np.ones(len(data), bool), offsets[:-1], offsets[1:], offsets[:0]))


@dataclass(frozen=True)
class Cache:
    """Tokens of frequent runs, in order of a hash of the run."""

    runs: pa.Array
    hashes: np.ndarray
    ids: np.ndarray
    starts: np.ndarray

    @classmethod
    def of(cls, runs: pa.Array, paths: pa.Array, vocabulary: Vocabulary, size: np.ndarray) -> Cache:
        hashes = run_hashes(runs)
        order = np.argsort(hashes)
        runs = runs.take(pa.array(order))
        ids, starts = ids_of(runs, paths.take(pa.array(order)), vocabulary, size)
        return cls(runs, hashes[order], ids.astype(np.int32), starts.astype(np.int32))

    def find(self, runs: pa.Array) -> np.ndarray:
        """Place of each run, -1 where it is not held; equal hashes are confirmed by the run itself."""
        if not len(self.runs) or not len(runs):
            return np.full(len(runs), -1)
        at = np.minimum(np.searchsorted(self.hashes, run_hashes(runs)), len(self.hashes) - 1)
        same = pc.equal(self.runs.take(pa.array(at)), runs).to_numpy(zero_copy_only=False)
        return np.where(same, at, -1)


def pack(ids: pa.Array, runs: pa.Array, n: np.ndarray) -> bytes:
    """Rows of a pack: ids, numbers of runs, distinct runs by frequency, and codes as byte planes."""
    coded = runs.dictionary_encode()
    code = coded.indices.to_numpy(zero_copy_only=False)
    order = np.argsort(-np.bincount(code, minlength=len(coded.dictionary)), kind="stable")
    rank = np.empty(len(order), dtype=np.uint32)
    rank[order] = np.arange(len(order))
    parts = []
    for columns in ({"doc_id": ids, "n": pa.array(n)}, {"run": coded.dictionary.take(pa.array(order))}):
        batch, sink = pa.RecordBatch.from_pydict(columns), pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, batch.schema) as writer:
            writer.write_batch(batch)
        parts.append(sink.getvalue().to_pybytes())
    planes = rank[code].view(np.uint8).reshape(-1, 4).T.tobytes()
    return zstandard.ZstdCompressor(level=3).compress(pickle.dumps([*parts, planes]))


def unpack(content: bytes) -> tuple[pa.Array, np.ndarray, pa.Array, np.ndarray]:
    """What ``pack`` was given: ids, numbers of runs, distinct runs, and the code of each run."""
    rows, runs, planes = pickle.loads(zstandard.ZstdDecompressor().decompress(content))
    rows = pa.ipc.open_stream(rows).read_next_batch()
    code = np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()
    return rows["doc_id"], rows["n"].to_numpy(), pa.ipc.open_stream(runs).read_next_batch()["run"], code.astype(np.int64)


def _gather(values: np.ndarray, starts: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stretches ``which`` of ``values``, one after the other, and their lengths."""
    size = starts[which + 1] - starts[which]
    at = np.repeat(starts[which] - (np.cumsum(size) - size), size) + np.arange(size.sum())
    return values[at], size


def decode(ids: pa.ListArray, vocabulary: Vocabulary) -> pa.Array:
    """Texts of lists of token numbers."""
    plain = pa.array([p.encode() for p in vocabulary.pieces], pa.binary())
    raw = {int(i): bytes([b]) for b, i in enumerate(vocabulary.bytes_at) if i >= 0}
    if raw:
        plain = pa.array([raw.get(i, p.encode()) for i, p in enumerate(vocabulary.pieces)], pa.binary())
    joined = pc.binary_join(pa.ListArray.from_arrays(ids.offsets, plain.take(ids.values)), b"")
    mark = SPACE.encode()
    texts = [v.replace(mark, b" ").removeprefix(b" ").decode("utf-8", "replace") for v in joined.to_pylist()]
    return pa.array(texts, pa.string())


def encoded(
    docs: DataFrame,
    *,
    model: str = MODEL,
    zipf: float | None = ZIPF,
    doc_id: str = "doc_id",
    text: str = "text",
    cache_texts: int = CACHE_TEXTS,
    cache_runs: int = CACHE_RUNS,
) -> DataFrame:
    """``doc_id, ids array<int>, n_tokens, round_trip`` per row of ``docs``.

    The tokens are those of the best path under the pieces' log-probabilities. A space
    goes in front, as the model was made; NULL and empty texts have no tokens.
    ``round_trip`` says that decoding gives the text back (a space mark in a text reads as a space). Repeated rows
    have a row each, no rows give none, and other columns are not looked at.

    Texts are cut into runs that no piece leaves. Frequent runs of a bounded sample of
    texts are encoded once and broadcast, with a fixed bound. Texts travel in packs, in one
    shuffle; their other runs travel by the same key and are encoded there by the lattice,
    whose grouping needs no further shuffle.
    """
    spark = docs.sparkSession
    vocabulary = load_vocabulary(model, zipf)
    joints = Joints.of(vocabulary)
    pieces = piece_table(spark, vocabulary)
    longest, unknown_cost = vocabulary.longest, vocabulary.unknown_cost
    size = np.array([len(p) for p in vocabulary.pieces])
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()

    def runs_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = joints.index()
        for batch in sliced(batches, "text", PACK_BYTES):
            runs, _ = text_runs(joints, index, batch.column("text"))
            counted = runs.value_counts()
            short = pc.less_equal(pc.utf8_length(counted.field("values")), LONG_RUN)
            part = [counted.field("values"), counted.field("counts")]
            yield pa.RecordBatch.from_arrays(part, ["word", "n"]).filter(short)

    total, volume = rows.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()
    tasks = min(max(1, -(-volume // TASK_BYTES)), MOST_TASKS)
    share = min(1.0, cache_texts / max(total, 1))
    sample = rows.sample(share, seed=11) if share < 1 else rows
    frequent = sample.mapInArrow(runs_of, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
    frequent = frequent.where("n > 1").select("word").limit(cache_runs)
    frequent = frequent.repartition(max(1, cache_runs // TASK_WORDS), "word")
    known = best_paths(frequent, pieces, longest, unknown_cost).toArrow()
    if known.num_rows:
        cache = Cache.of(*(pa.concat_arrays(known[c].chunks) for c in ("word", "path")), vocabulary, size)
    else:
        cache = Cache(pa.array([], pa.string()), np.zeros(0, np.uint64), np.zeros(0, np.int32), np.zeros(1, np.int32))
    # Plain arrays, which a worker loads once for all its tasks.
    shared = spark.sparkContext.broadcast((cache.runs, cache.hashes, cache.ids, cache.starts))

    def named(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
        """Slices with a number each: of its place and of what is in it.

        Both scans give a slice the same number as long as Spark hands out the rows alike. Where
        it does not, numbers differ, and the runs that a pack then lacks are folded where they are missed.
        """
        for k, batch in enumerate(sliced(batches, "text", PACK_BYTES)):
            data, offsets = text_bytes(batch.column("text"))
            digest = xxhash.xxh3_64(data.tobytes(), seed=TaskContext.get().partitionId())
            digest.update(offsets.tobytes() + k.to_bytes(8, "little"))
            yield digest.intdigest() >> 1, batch

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = joints.index()
        for k, batch in named(batches):
            content = pack(batch.column("doc_id"), *text_runs(joints, index, batch.column("text")))
            yield pa.RecordBatch.from_arrays([pa.array([k]), pa.array([content], pa.binary())], ["pack", "content"])

    def other_runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, own = joints.index(), Cache(*shared.value)
        for k, batch in named(batches):
            runs = text_runs(joints, index, batch.column("text"))[0].unique()
            runs = runs.filter(pc.less_equal(pc.utf8_length(runs), LONG_RUN))
            runs = runs.filter(pa.array(own.find(runs) < 0))[: 1 << WORD_BITS]
            part = [pa.array(np.full(len(runs), k)), pa.array(np.arange(len(runs))), runs]
            yield pa.RecordBatch.from_arrays(part, ["pack", "no", "word"])

    def assembled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, own = vocabulary, Cache(*shared.value)
        costs = np.append(words.costs, unknown_cost)
        places = {p: i for i, p in enumerate(words.pieces) if words.usable[i]}
        trim = memory_trim()
        for batch in batches:
            for content, others, edges in zip(*(batch.column(c) for c in ("content", "others", "edges")), strict=True):
                doc_ids, n, runs, code = unpack(content.as_py())
                extra, paths = pa.array([], pa.string()), pa.array([], pa.list_(pa.int32()))
                no = others.values.field("no").to_numpy() if others.is_valid else np.zeros(0, np.int64)
                # Numbers come once, or else the patch is of two packs and can't be told apart.
                if len(no) and len(np.unique(no)) == len(no) == no.max() + 1:
                    extra = others.values.field("word").take(pa.array(np.argsort(no)))
                    edges = edges.values.to_numpy()
                    paths = fold_edges(edges >> WORD_AT, edges & (1 << WORD_AT) - 1, len(extra), costs)
                at = own.find(runs)
                # Very long runs, and those of a pack that its patch did not find.
                left = runs.filter(pa.array(at < 0))
                left = left.filter(pc.invert(pc.is_in(left, value_set=extra.cast(pa.string()))))
                if len(left):
                    folded = [fold_run(r, words, places) for r in left.to_pylist()]
                    extra = pa.concat_arrays([extra.cast(pa.string()), left])
                    paths = pa.concat_arrays([paths.cast(pa.list_(pa.int32())), pa.array(folded, pa.list_(pa.int32()))])
                ids, starts = ids_of(extra, paths, words, size)
                values = np.concatenate((own.ids, ids.astype(np.int32)))
                starts = np.concatenate((own.starts[:-1], starts + len(own.ids)))
                fresh = pc.index_in(runs.filter(pa.array(at < 0)), value_set=extra.cast(pa.string()))
                at[at < 0] = fresh.to_numpy(zero_copy_only=False) + len(own.runs)
                tokens, width = _gather(values, starts, at[code])
                before = np.concatenate(([0], np.cumsum(width, dtype=np.int64)))
                reach = np.concatenate(([0], np.cumsum(n))).astype(np.int32)
                ids = pa.ListArray.from_arrays(
                    pa.array(before[reach].astype(np.int32)), pa.array(tokens)
                )
                wanted = pc.binary_join(pa.ListArray.from_arrays(pa.array(reach), runs.take(pa.array(code))), "")
                wanted = pc.utf8_slice_codeunits(pc.replace_substring(wanted, SPACE, " "), 1, None)
                same = pc.equal(decode(ids, words), wanted)
                n_tokens = pa.array(np.diff(before[reach]))
                yield pa.RecordBatch.from_arrays(
                    [doc_ids, ids, n_tokens, same], ["doc_id", "ids", "n_tokens", "round_trip"]
                )
                trim(0)

    packs = rows.mapInArrow(packed, "pack long, content binary").repartition(tasks, "pack")
    other = rows.mapInArrow(other_runs, "pack long, no long, word string").repartition(tasks, "pack")
    edge = F.expr(f"shiftleft(no, {WORD_AT}) | _edge")
    word = F.when(F.col("_first"), F.struct("no", "word"))
    solved = lattice_edges(other, pieces, longest).groupBy(F.col("pack").alias("_pack"))
    patches = solved.agg(F.collect_list(word).alias("others"), F.collect_list(edge).alias("edges"))
    joined = packs.join(patches, F.col("pack") == F.col("_pack"), "left")
    out = f"doc_id {kind}, ids array<int>, n_tokens long, round_trip boolean"
    return joined.select("content", "others", "edges").mapInArrow(assembled, out)
