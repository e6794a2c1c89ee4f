"""Lines that many documents share, found in a sharded minimal perfect hash.

Four steps, each over all documents:

1. Documents are stored in slices of bounded size. A slice gives each different line once,
   as 128 bits of hash with a count and the largest id, so a line that a third of all
   documents hold is a row per slice.
2. Lines of two documents or more make the index: a shard per range of hashes, each a minimal
   perfect hash with an array of fingerprints, one of counts and one of largest ids.
3. Slices send their hashes to the shards in packs, and a shard answers a pack with the
   lines that are in enough documents. Lines that no other document has are told apart
   by the fingerprint.
4. A slice meets its answers and drops its lines. No row of text ever meets another.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from linkloom.llm.frames import stored
from linkloom.llm.words import LOWER, NOT_SPACE, mixed, runs, sliced, text_bytes

MIN_DOCS = 3
MIN_CHARS = 20
#: Bytes of text in a slice; a longer text is a slice by itself.
SLICE = 1 << 20
#: Lines that a shard holds on average, and the fewest shards.
SHARD_LINES = 1 << 16
LEAST_SHARDS = 32
#: Bits of a level of the hash for each key that is left.
ROOM = 2

_ANSWER = np.dtype([("a", "<u8"), ("b", "<u8"), ("last", "<i8"), ("known", "?")])


class Lines(NamedTuple):
    """Lines of several texts by byte position; ``hashes`` holds those that may be dropped."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    doc: np.ndarray
    at: np.ndarray
    hashes: np.ndarray


def split_lines(column: pa.Array, min_chars: int = MIN_CHARS) -> Lines:
    """Lines of each text; NULL and empty texts have one empty line.

    ``at`` numbers the lines whose key has ``min_chars`` characters, and ``hashes`` has two
    64-bit numbers for each key: the stripped line with A-Z in lower case.
    """
    data, offsets = text_bytes(column)
    breaks = np.flatnonzero(data == 0x0A)
    start = np.sort(np.concatenate((offsets[:-1], breaks + 1)))
    end = np.sort(np.concatenate((breaks, offsets[1:])))
    per_doc = np.diff(np.searchsorted(breaks, offsets)) + 1
    doc = np.repeat(np.arange(len(per_doc)), per_doc)
    solid = np.flatnonzero(NOT_SPACE[data])
    first, after = np.searchsorted(solid, start), np.searchsorted(solid, end)
    chars = np.concatenate(([0], np.cumsum((data & 0xC0) != 0x80)))
    full = np.flatnonzero(first < after)
    left, right = solid[first[full]], solid[after[full] - 1] + 1
    long = chars[right] - chars[left] >= min_chars
    lower = LOWER[data].tobytes()
    digests = (xxhash.xxh3_128_digest(lower[s:e]) for s, e in zip(left[long].tolist(), right[long].tolist()))
    hashes = np.frombuffer(b"".join(digests), dtype="<u8").reshape(-1, 2)
    return Lines(data, start, end, doc, full[long], hashes)


class PerfectHash:
    """Places of different keys: a bit array a level, each for the keys that clashed before.

    A key's place is the number of bits set before its own, so ``n`` keys get the
    places 0 to ``n - 1``. Other keys get some place or none.
    """

    def __init__(self, sizes: list[int], bits: np.ndarray):
        self.sizes, self.bits = sizes, bits
        self.rank = np.concatenate(([0], np.cumsum(bits, dtype=np.int64)))

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        sizes, levels = [], []
        while len(keys):
            size = ROOM * len(keys) + 1
            place = cls._place(keys, len(sizes), size)
            alone = np.bincount(place, minlength=size) == 1
            sizes.append(size)
            levels.append(alone)
            keys = keys[~alone[place]]
        return cls(sizes, np.concatenate(levels) if levels else np.zeros(0, dtype=bool))

    @staticmethod
    def _place(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            turned = keys[:, 0] + mixed(keys[:, 1] + np.uint64(level))
        return (mixed(turned) % np.uint64(size)).astype(np.int64)

    def places(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, -1 for what is surely no key."""
        out = np.full(len(keys), -1, dtype=np.int64)
        left, before = np.arange(len(keys)), 0
        for level, size in enumerate(self.sizes):
            at = before + self._place(keys[left], level, size)
            hit = self.bits[at]
            out[left[hit]] = self.rank[at[hit]]
            left, before = left[~hit], before + size
        return out


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return keys[:, 0] ^ ((keys[:, 1] << np.uint64(32)) | (keys[:, 1] >> np.uint64(32)))


def _in_slices(docs: DataFrame) -> DataFrame:
    """The rows with the name of their slice, stored: later steps all see the same slices."""
    schema = T.StructType([T.StructField("slice", T.StringType()), *docs.schema.fields])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", SLICE):
            name = pa.array([uuid.uuid4().hex] * part.num_rows)
            yield pa.RecordBatch.from_arrays([name, *part.columns], names=schema.names)

    return stored(docs.mapInArrow(run, schema))


def _line_counts(docs: DataFrame, min_chars: int) -> DataFrame:
    """``a, b, n, last``: each different line, its documents and the largest of their ids."""
    schema = "a long, b long, n long, last long"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in sliced(batches, "text", SLICE):
            lines = split_lines(part.column("text"), min_chars)
            ids = part.column("doc_id")
            doc = lines.doc[lines.at]
            # A line once a document, then once a slice.
            order = np.lexsort((doc, lines.hashes[:, 1], lines.hashes[:, 0]))
            key, doc = lines.hashes[order], doc[order]
            new_line = np.ones(len(key), dtype=bool)
            new_line[1:] = (key[1:] != key[:-1]).any(axis=1)
            once = new_line.copy()
            once[1:] |= doc[1:] != doc[:-1]
            key, doc, new_line = key[once], doc[once], new_line[once]
            rows = pa.table({"line": np.cumsum(new_line), "id": ids.take(pa.array(doc))})
            grouped = rows.group_by("line", use_threads=False).aggregate([("id", "max"), ([], "count_all")])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(key[new_line, 0].view(np.int64)),
                    pa.array(key[new_line, 1].view(np.int64)),
                    grouped["count_all"].combine_chunks(),
                    grouped["id_max"].combine_chunks().cast(pa.int64()),
                ],
                names=["a", "b", "n", "last"],
            )

    found = docs.select("doc_id", "text").mapInArrow(run, schema)
    return found.groupBy("a", "b").agg(F.sum("n").alias("n"), F.max("last").alias("last"))


def _shard(shards: int):
    return F.pmod(F.col("a"), F.lit(shards)).cast("int")


_INDEX = "shard int, slice string, sizes array<long>, bits binary, prints binary, counts binary, known binary, last binary"


def line_index(counts: DataFrame, shards: int) -> DataFrame:
    """A row a shard: a perfect hash of its lines, and the arrays that its places lead to."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for shard, parts in runs(batches, "shard"):
            rows = pa.Table.from_batches(parts)
            keys = np.column_stack([rows[c].to_numpy().view(np.uint64) for c in ("a", "b")])
            hashed = PerfectHash.build(keys)
            order = np.argsort(hashed.places(keys))
            known = rows["last"].is_valid().to_numpy()
            last = rows["last"].fill_null(0).to_numpy()
            yield pa.RecordBatch.from_pylist(
                [
                    {
                        "shard": shard,
                        "slice": None,
                        "sizes": hashed.sizes,
                        "bits": np.packbits(hashed.bits).tobytes(),
                        "prints": fingerprints(keys)[order].tobytes(),
                        "counts": rows["n"].to_numpy()[order].astype("<i8").tobytes(),
                        "known": known[order].tobytes(),
                        "last": last[order].astype("<i8").tobytes(),
                    }
                ],
                schema=_arrow(_INDEX),
            )

    by_shard = counts.withColumn("shard", _shard(shards)).repartitionById(shards, F.col("shard"))
    return by_shard.sortWithinPartitions("shard").mapInArrow(run, _INDEX)


def _arrow(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "string": pa.string(), "array<long>": pa.list_(pa.int64()), "binary": pa.binary()}
    return pa.schema([(name, kinds[kind]) for name, kind in (field.split(" ") for field in ddl.split(", "))])


def _packs(docs: DataFrame, shards: int, min_chars: int) -> DataFrame:
    """``shard, slice, prints``: the different hashes of a slice, a pack for each shard."""
    schema = "shard int, slice string, prints binary"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name, parts in runs(batches, "slice"):
            for part in sliced(parts, "text", SLICE):
                keys = np.unique(split_lines(part.column("text"), min_chars).hashes, axis=0)
                shard = keys[:, 0].view(np.int64) % shards
                order = np.argsort(shard, kind="stable")
                keys, shard = keys[order], shard[order]
                cuts = np.searchsorted(shard, np.arange(shards + 1))
                full = np.flatnonzero(np.diff(cuts))
                yield pa.RecordBatch.from_pylist(
                    [
                        {"shard": int(s), "slice": name, "prints": keys[cuts[s] : cuts[s + 1]].tobytes()}
                        for s in full
                    ],
                    schema=_arrow(schema),
                )

    return docs.select("slice", "text").mapInArrow(run, schema)


def _answers(packs: DataFrame, index: DataFrame, shards: int, min_docs: int) -> DataFrame:
    """``slice, found``: the lines of a pack that enough documents have, with the largest id."""
    schema = "slice string, found binary"
    both = index.unionByName(packs, allowMissingColumns=True)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = held = None
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                if row["slice"] is None:
                    bits = np.unpackbits(np.frombuffer(row["bits"], np.uint8), count=sum(row["sizes"])).astype(bool)
                    at, held = row["shard"], PerfectHash(row["sizes"], bits)
                    prints, counts = (np.frombuffer(row[c], t) for c, t in (("prints", "<u8"), ("counts", "<i8")))
                    known, last = np.frombuffer(row["known"], "?"), np.frombuffer(row["last"], "<i8")
                elif row["shard"] == at:
                    keys = np.frombuffer(row["prints"], dtype="<u8").reshape(-1, 2)
                    place = held.places(keys)
                    there = place >= 0
                    there[there] = prints[place[there]] == fingerprints(keys[there])
                    there[there] = counts[place[there]] >= min_docs
                    if there.any():
                        found = np.empty(int(there.sum()), dtype=_ANSWER)
                        found["a"], found["b"] = keys[there].T
                        found["last"], found["known"] = last[place[there]], known[place[there]]
                        out.append({"slice": row["slice"], "found": found.tobytes()})
            yield pa.RecordBatch.from_pylist(out, schema=_arrow(schema))

    # An index row has no slice and so comes before the packs of its shard.
    dealt = both.repartitionById(shards, F.col("shard"))
    return dealt.sortWithinPartitions("shard", F.col("slice").asc_nulls_first()).mapInArrow(run, schema)


def _kept(part: pa.Table, found: np.ndarray, min_chars: int) -> tuple[list, list, list]:
    """Text without its shared lines, number of lines, number dropped; of each row."""
    column = part["text"].combine_chunks()
    lines = split_lines(column, min_chars)
    drop = np.zeros(len(lines.start), dtype=bool)
    if len(found) and len(lines.at):
        found = np.sort(found, order=("a", "b"))
        pairs = np.dtype([("a", "<u8"), ("b", "<u8")])
        keys = np.ascontiguousarray(lines.hashes).view(pairs).ravel()
        listed = np.rec.fromarrays([found["a"], found["b"]], dtype=pairs)
        at = np.minimum(np.searchsorted(listed, keys), len(listed) - 1)
        hit = (listed["a"][at] == keys["a"]) & (listed["b"][at] == keys["b"])
        ids = part["doc_id"]
        known = ids.is_valid().to_numpy()[lines.doc[lines.at]]
        own = ids.cast(pa.int64()).fill_null(0).to_numpy()[lines.doc[lines.at]]
        # Without a largest id all holders have none, and all keep the line.
        largest = np.where(found["known"][at], known & (own == found["last"][at]), True)
        drop[lines.at[hit & ~largest]] = True
    n_lines = np.bincount(lines.doc, minlength=len(column))
    n_dropped = np.bincount(lines.doc[drop], minlength=len(column))
    first = np.concatenate(([0], np.cumsum(n_lines)))
    raw, texts = lines.data.tobytes(), []
    for i, (text, n) in enumerate(zip(column, n_dropped.tolist())):
        if not n:
            texts.append(text.as_py())
            continue
        own = np.flatnonzero(~drop[first[i] : first[i + 1]]) + first[i]
        texts.append(b"\n".join(raw[lines.start[k] : lines.end[k]] for k in own).decode())
    return texts, n_lines.tolist(), n_dropped.tolist()


def without_shared_lines(docs: DataFrame, min_docs: int = MIN_DOCS, min_chars: int = MIN_CHARS) -> DataFrame:
    """``docs`` with shared lines taken out of ``text``, and ``n_lines, n_dropped, kept_sha256``.

    Lines end at ``\\n``. Lines that, stripped of ASCII white space and with A-Z in lower
    case, have at least ``min_chars`` characters and are in at least ``min_docs`` rows
    stay only in the rows with the largest ``doc_id`` among them.

    NULL and empty texts have one empty line, and NULL stays NULL. A row is a document:
    equal rows count each, and rows that share the largest id all keep the line. NULL ids
    are smaller than all others; a line that only rows without id have stays. A text may
    be of any length. No rows give no rows. Other columns stay as they are; of the three
    new columns, old ones of these names are replaced. ``doc_id`` must be a whole number.
    """
    new = ("n_lines", "n_dropped", "kept_sha256")
    others = [c for c in docs.columns if c not in ("doc_id", "text", *new)]
    plain = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(others)],
    )
    cut = _in_slices(plain)
    counts = stored(_line_counts(cut, min_chars).where("n > 1"))
    shards = max(LEAST_SHARDS, -(-counts.count() // SHARD_LINES))
    index = stored(line_index(counts, shards))
    answers = _answers(_packs(cut, shards, min_chars), index, shards, min_docs)
    schema = T.StructType(
        [
            *plain.schema.fields,
            T.StructField("n_lines", T.LongType()),
            T.StructField("n_dropped", T.LongType()),
            T.StructField("kept_sha256", T.StringType()),
        ]
    )

    def run(key, rows: pa.Table, answered: pa.Table) -> pa.Table:
        found = np.frombuffer(b"".join(answered["found"].to_pylist()), dtype=_ANSWER)
        texts, n_lines, n_dropped = _kept(rows, found, min_chars)
        digests = [hashlib.sha256((t or "").encode()).hexdigest() for t in texts]
        out = rows.drop_columns(["slice"])
        at = out.schema.get_field_index("text")
        out = out.set_column(at, out.schema.field(at), pa.array(texts, out.schema.field(at).type))
        for name, values, kind in zip(new, (n_lines, n_dropped, digests), (pa.int64(), pa.int64(), pa.string())):
            out = out.append_column(name, pa.array(values, kind))
        return out

    result = cut.groupBy("slice").cogroup(answers.groupBy("slice")).applyInArrow(run, schema)
    at = {c: f"c{i}" for i, c in enumerate(others)}
    kept = [F.col(at.get(c, c)).alias(c) for c in docs.columns if c not in new]
    return result.select(*kept, *new)
