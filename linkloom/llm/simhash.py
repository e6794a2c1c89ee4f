"""SimHash near duplicates: fingerprints, and exact components under a Hamming distance."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.frames import stored
from linkloom.llm.words import SLICE_BYTES, sliced, spaced, split_words

#: Two-bit segments: with this mask, a popcount per segment is one shift and one sum.
HALF_MASK = 0x5555555555555555
#: Shingles whose bits are counted at a time.
SHINGLES = 1 << 16
#: Fingerprints of a cell that meet in one task.
BLOCK = 1024
#: Cells up to this size are compared together, larger ones each by itself.
SMALL_CELL = 64


def _fingerprint_batch(column: pa.Array, size: int, seed: int) -> np.ndarray:
    words = split_words(column, lower=True)
    text, start, end = spaced(words)
    first = words.first()
    counts = np.diff(first)
    length = np.minimum(counts, size)
    n_shingles = np.where(counts > 0, counts - length + 1, 0)
    begin = np.repeat(first[:-1], n_shingles) + (
        np.arange(n_shingles.sum()) - np.repeat(np.cumsum(n_shingles) - n_shingles, n_shingles)
    )
    last = begin + np.repeat(length, n_shingles) - 1
    doc = np.repeat(np.arange(len(column)), n_shingles)
    ones = np.zeros((len(column), 64), dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for p in range(0, len(begin), SHINGLES):
        i, j = start[begin[p : p + SHINGLES]].tolist(), end[last[p : p + SHINGLES]].tolist()
        hashes = np.fromiter((digest(text[a:b], seed) for a, b in zip(i, j, strict=True)), np.uint64, len(i))
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        own = doc[p : p + SHINGLES]
        edge = np.concatenate(([0], np.flatnonzero(np.diff(own)) + 1))
        ones[own[edge]] += np.add.reduceat(bits, edge, axis=0, dtype=np.int32)
    majority = (2 * ones > n_shingles[:, None]).astype(np.uint8)
    packed = np.packbits(majority, axis=1, bitorder="little")
    return np.ascontiguousarray(packed).view(np.uint64).ravel()


def fingerprints(
    docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", size: int = 3, seed: int = 42
) -> DataFrame:
    """``doc_id, fp``: the 64-bit SimHash of each row's text, as a signed long.

    Shingles are ``size`` lower-cased words, repeats included; a shorter text is
    one shingle, a text without words (NULL, empty) has fingerprint zero.
    """
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    kind = rows.schema["doc_id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text", SLICE_BYTES // 2):
            values = _fingerprint_batch(batch.column("text"), size, seed).view(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(values)], ["doc_id", "fp"])

    return rows.mapInArrow(run, f"doc_id {kind.simpleString()}, fp long")


def segment_groups(distance: int) -> list[int]:
    """Masks over the embedding: each keeps ``distance`` of ``2 * distance`` groups of segments.

    Two points at Manhattan distance ``distance`` or less differ in at most that
    many groups, so they agree on at least one of the masks.
    """
    n = max(2 * distance, 1)
    edges = [round(32 * i / n) for i in range(n + 1)]
    groups = [sum(3 << (2 * s) for s in range(a, b)) for a, b in zip(edges, edges[1:], strict=False)]
    return [sum(c) for c in combinations(groups, max(distance, 1))]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _embedding(fp: np.ndarray) -> np.ndarray:
    half = np.uint64(HALF_MASK)
    return (fp & half) + ((fp >> np.uint64(1)) & half)


def _manhattan_table() -> np.ndarray:
    """Distance of two bytes of the embedding, each holding four counts."""
    fields = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6])) & 3
    return np.abs(fields[:, None, :] - fields[None, :, :]).sum(axis=2).astype(np.uint8)


def _linked(a: np.ndarray, b: np.ndarray, table: np.ndarray, distance: int) -> np.ndarray:
    """Lower bound first: the Manhattan distance of the segment counts; then the exact bits."""
    x, y = _embedding(a), _embedding(b)
    total = np.zeros(np.broadcast(x, y).shape, dtype=np.uint8)
    for shift in range(0, 64, 8):
        low = np.uint64(shift)
        total += table[(x >> low).astype(np.uint8), (y >> low).astype(np.uint8)]
    near = total <= distance
    return near & (np.bitwise_count(a ^ b) <= distance)


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest node of each node's component."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        new = new[new]
        if np.array_equal(new, root):
            return root
        root = new


def _forest(keys: np.ndarray, fp: np.ndarray, side: np.ndarray, table: np.ndarray, distance: int):
    """Links within the cells given, as stars: one link per value that is not a root."""
    edges = np.flatnonzero(np.any(keys[1:] != keys[:-1], axis=1)) + 1
    start = np.concatenate(([0], edges))
    size = np.diff(np.concatenate((start, [len(fp)])))
    left, right = [], []
    small = (size > 1) & (size <= SMALL_CELL)
    for k in np.unique(size[small]):
        i, j = np.triu_indices(k, 1)
        at = start[size == k][:, None]
        a, b = (at + i).ravel(), (at + j).ravel()
        hit = _linked(fp[a], fp[b], table, distance)
        left.append(a[hit])
        right.append(b[hit])
    for at, k in zip(start[size > SMALL_CELL], size[size > SMALL_CELL], strict=True):
        rows = np.arange(at, at + k)
        one, two = keys[at, 2], keys[at, 3]
        first, second = rows[side[rows] == one], rows[side[rows] == two]
        for p in range(0, len(first), 256):
            part = first[p : p + 256]
            a, b = np.nonzero(_linked(fp[part][:, None], fp[second][None, :], table, distance))
            left.append(part[a])
            right.append(second[b])
    if not left:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    values, node = np.unique(fp.view(np.int64), return_inverse=True)
    root = _roots(len(values), node[np.concatenate(left)], node[np.concatenate(right)])
    inner = np.flatnonzero(root != np.arange(len(values)))
    return values[inner], values[root[inner]]


def near_links(values: DataFrame, distance: int = 3) -> DataFrame:
    """``u, v``: links whose components are those of all pairs within ``distance`` bits.

    ``values`` has distinct fingerprints in ``fp``. Each is embedded as 32 popcounts
    of two-bit segments; Manhattan distance there never exceeds Hamming distance.
    A grid cell is the counts of half of the segment groups, chosen in all ways, so
    near points share a cell of one grid. Large cells are dealt out as pairs of
    blocks of about ``BLOCK`` values. A task returns a spanning forest of what it has
    compared instead of all pairs.
    """
    half = F.lit(HALF_MASK)
    fp = F.col("fp")
    odd, even = fp.bitwiseAND(half), F.shiftrightunsigned(fp, 1).bitwiseAND(half)
    # The sum of two bits within each segment, without the carry of an addition.
    embedded = odd.bitwiseXOR(even).bitwiseOR(F.shiftleft(odd.bitwiseAND(even), 1))
    grids = F.array(*[F.lit(_signed(m)) for m in segment_groups(distance)])
    cells = (
        values.select("fp", embedded.alias("e"))
        .select("fp", "e", F.posexplode(grids).alias("grid", "mask"))
        .select("fp", "grid", F.col("e").bitwiseAND(F.col("mask")).alias("cell"))
    )
    shared = cells.groupBy("grid", "cell").count().where("count > 1")
    dealt = (
        cells.join(shared, ["grid", "cell"])
        .withColumn("blocks", F.ceil(F.col("count") / BLOCK).cast("int"))
        .withColumn("side", F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select(
            "grid",
            "cell",
            F.least("side", "other").alias("one"),
            F.greatest("side", "other").alias("two"),
            "side",
            "fp",
        )
    )
    keys = ["grid", "cell", "one", "two"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = _manhattan_table()
        rest = (np.zeros((0, 4), np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64))

        def emitted(key, side, fp):
            u, v = _forest(key, fp, side, table, distance)
            return pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])

        for batch in batches:
            key = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in keys], axis=1)
            side = batch.column("side").to_numpy().astype(np.int64)
            own = batch.column("fp").to_numpy().view(np.uint64)
            key, side, own = (np.concatenate(x) for x in zip(rest, (key, side, own), strict=True))
            if not len(own):
                continue
            # The last cell may go on in the next batch.
            at = int(np.flatnonzero(np.any(key != key[-1], axis=1))[-1]) + 1 if np.any(key != key[-1]) else 0
            rest = (key[at:], side[at:], own[at:])
            if at:
                yield emitted(key[:at], side[:at], own[:at])
        if len(rest[2]):
            yield emitted(*rest)

    return dealt.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(run, "u long, v long").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of a link ``u, v``: the smallest node it reaches.

    Alternates the large-star and small-star steps, each written to the shared
    folder, until a round changes nothing. Minima combine before their shuffle.
    """
    edges = stored(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u > v"))

    def state(df):
        return df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()

    before = state(edges)
    while before[0]:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        moved = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.unionByName(least.withColumnRenamed("m", "v")).distinct())
        after = state(edges)
        if after == before:
            break
        before = after
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _by_value(prints: DataFrame, distance: int) -> DataFrame:
    """``fp, copies, component_id`` for each different fingerprint of ``doc_id, fp``."""
    values = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies")))
    found = components(near_links(values.select("fp"), distance))
    named = found.join(values.withColumnRenamed("fp", "node"), "node")
    component = named.groupBy("root").agg(F.min("least").alias("component_id"))
    by_value = found.join(component, "root").select(F.col("node").alias("fp"), "component_id")
    return values.join(by_value, "fp", "left").select(
        "fp", "copies", F.coalesce("component_id", "least").alias("component_id")
    )


def near_duplicates(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 3,
    seed: int = 42,
    distance: int = 3,
) -> DataFrame:
    """``doc_id, fingerprint, component_id`` per row of ``docs``.

    Rows link when their fingerprints differ in at most ``distance`` bits, rows
    without words among them; ``component_id`` is the smallest id reachable. Equal
    fingerprints are one value from the start, so copies cost nothing more. NULL ids
    keep their row and never name a component unless no member has an id. Repeated rows give
    a row each, no rows none; other columns are not looked at, and a text may be of any length.
    """
    prints = stored(fingerprints(docs, doc_id=doc_id, text=text, size=size, seed=seed))
    by_value = stored(_by_value(prints, distance))
    # Values with more than a thousandth of the rows are below a thousand, hence the broadcast.
    n = by_value.agg(F.sum("copies")).first()[0] or 0
    often = by_value.where(F.col("copies") > n / 1000).select("fp", F.col("component_id").alias("often"), F.lit(True).alias("hot"))
    marked = prints.join(F.broadcast(often), "fp", "left")
    by_value = by_value.where(F.col("copies") <= n / 1000)
    rest = marked.where("hot IS NULL").drop("often", "hot").join(by_value, "fp").select("doc_id", "fp", "component_id")
    named = marked.where("hot").select("doc_id", "fp", F.col("often").alias("component_id"))
    return rest.unionByName(named).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _row_key(doc_id: str, text: str) -> Column:
    """Digest of a row's id and text; equal only for rows with both alike, NULL apart from empty."""
    name = F.col(doc_id).cast("string")
    name = F.coalesce(F.concat(F.length(name).cast("string"), F.lit(":"), name), F.lit("-"))
    return F.unhex(F.sha2(F.concat(name, F.coalesce(F.concat(F.lit("+"), F.col(text)), F.lit("-"))), 256))


def one_per_component(
    docs: DataFrame,
    *,
    doc_id: str = "doc_id",
    text: str = "text",
    size: int = 3,
    seed: int = 42,
    distance: int = 3,
) -> DataFrame:
    """One row of ``docs`` from each component, whatever its ids are.

    It has the smallest id, rows without one coming last, and of equal ids the smallest
    digest of id and text; of rows with id and text alike any one stays. Ids may repeat
    in the result when rows of one id have texts of several components. All columns stay,
    whatever their names; no rows give no rows, and a text may be of any length.
    """
    names, docs = docs.columns, docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    doc_id, text = (docs.columns[names.index(c)] for c in (doc_id, text))
    key = _row_key(doc_id, text)
    # Ordered as survivors are chosen, so the name of a component is its survivor.
    place = F.struct(F.col(doc_id).isNull().alias("missing"), F.col(doc_id).alias("id"), key.alias("key"))
    placed = docs.select(place.alias("doc_id"), F.col(text).alias("text"))
    prints = stored(fingerprints(placed, size=size, seed=seed))
    by_value = stored(_by_value(prints, distance))
    kept = by_value.select(F.col("component_id.key").alias("_key")).distinct()
    rows = docs.withColumn("_key", key)
    # Rows alike in id and text that are more than a thousandth of all: below a thousand keys.
    n = by_value.agg(F.sum("copies")).first()[0] or 0
    often = by_value.where(F.col("copies") > n / 1000).select("fp")
    counted = prints.join(F.broadcast(often), "fp", "left_semi").groupBy(F.col("doc_id.key").alias("_key")).count()
    hot = [bytes(r["_key"]) for r in counted.where((F.col("count") > n / 1000) & (F.col("count") > 1)).collect()]
    if not hot:
        return rows.join(kept, "_key", "left_semi").dropDuplicates(["_key"]).drop("_key").toDF(*names)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in batches:
            keys, new = batch.column("_key").to_pylist(), []
            for i, k in enumerate(keys):
                if k not in seen:
                    seen.add(k)
                    new.append(i)
            if new:
                yield batch.take(pa.array(new))

    # One row of each such key leaves a task, so their texts never meet in one.
    is_hot = F.col("_key").isin(hot)
    many = rows.where(is_hot).mapInArrow(firsts, rows.schema)
    few = rows.where(~is_hot)
    one = few.unionByName(many).join(kept, "_key", "left_semi").dropDuplicates(["_key"])
    return one.drop("_key").toDF(*names)
