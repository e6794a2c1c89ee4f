"""Roles of transcript lines by a hidden Markov model, and turns in canonical form."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from linkloom.llm.frames import stored

ROLES = ("system", "user", "assistant")
KINDS = ("start", "inside", "gap")
#: States: role times kind of line. A gap is an empty line after a turn.
STATES = len(ROLES) * len(KINDS)

# Speaker markers at the head of a line (fixed values), by role.
MARKERS = {
    "system": r"system|instructions?|note|context",
    "user": r"user|human|question|customer|q",
    "assistant": r"assistant|ai|bot|answer|agent|a",
}
MARKER = r"(?i)^\s*(?:#+\s*|\[|<\|?|\*\*)?({})(?:\]|\|?>|\*\*)?\s*(?::|\]|>|$)\s*"
ANY_MARKER = MARKER.format("|".join(MARKERS.values()))

#: Observations: marker (none or a role), empty, ends with a question mark, length.
SYMBOLS = 4 * 2 * 2 * 3


def observed(line: Column) -> Column:
    """The number of what is seen of a line."""
    line = F.coalesce(line, F.lit(""))
    marker = F.lit(0)
    for i, role in enumerate(ROLES):
        marker = F.when(line.rlike(MARKER.format(MARKERS[role])), i + 1).otherwise(marker)
    empty = (F.trim(line) == "").cast("int")
    asks = F.rtrim(line).endswith("?").cast("int")
    length = F.when(F.length(line) < 40, 0).when(F.length(line) < 200, 1).otherwise(2)
    return (((marker * 2 + empty) * 2 + asks) * 3 + length).cast("int")


def state_number(role: Column, kind: Column) -> Column:
    roles, kinds = (F.array(*[F.lit(v) for v in vs]) for vs in (ROLES, KINDS))
    number = (F.array_position(roles, role) - 1) * len(KINDS) + F.array_position(kinds, kind) - 1
    return number.cast("int")


class Model:
    """Log-probabilities of first states, of steps and of what is seen; read-only."""

    def __init__(self, first: np.ndarray, step: np.ndarray, seen: np.ndarray):
        self.first, self.step, self.seen = first, step, seen


def fit(lines: DataFrame) -> Model:
    """Count first states, steps and observations in ``conv_id, line_no, line, role, kind``.

    Steps are counted between lines that follow each other within a conversation's block of
    lines (``block``). At most ``STATES`` squared plus ``STATES * SYMBOLS`` counts reach the driver.
    """
    rows = lines.select("conv_id", "block", "line_no", state_number(F.col("role"), F.col("kind")).alias("state"), observed(F.col("line")).alias("seen"))
    rows = rows.where("state >= 0")
    ordered = rows.repartition("conv_id", "block").sortWithinPartitions("conv_id", "block", "line_no")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, step = np.zeros(STATES, np.int64), np.zeros((STATES, STATES), np.int64)
        seen, last = np.zeros((STATES, SYMBOLS), np.int64), None
        for batch in batches:
            state, symbol = (batch.column(c).to_numpy() for c in ("state", "seen"))
            key = list(zip(batch.column("conv_id").to_pylist(), batch.column("block").to_pylist(), strict=True))
            np.add.at(seen, (state, symbol), 1)
            for k, s in zip(key, state.tolist(), strict=True):
                if last is None or last[0] != k:
                    first[s] += k[1] == 0
                else:
                    step[last[1], s] += 1
                last = (k, s)
        flat = np.concatenate((first, step.ravel(), seen.ravel()))
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["cell", "n"])

    counted = ordered.mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.full(STATES + STATES * STATES + STATES * SYMBOLS, 0.1)
    for r in counted:
        flat[r["cell"]] += r["n"]
    first, step = flat[:STATES], flat[STATES : STATES * (STATES + 1)].reshape(STATES, STATES)
    seen = flat[STATES * (STATES + 1) :].reshape(STATES, SYMBOLS)
    return Model(np.log(first / first.sum()), *(np.log(t / t.sum(axis=1, keepdims=True)) for t in (step, seen)))


def transfer(model: Model, symbols: np.ndarray, first: bool) -> np.ndarray:
    """Best score of a stretch of lines for each state before it and each last state."""
    if first:
        score = np.broadcast_to(model.first + model.seen[:, symbols[0]], (STATES, STATES))
    else:
        score = model.step + model.seen[:, symbols[0]]
    for symbol in symbols[1:]:
        score = (score[:, :, None] + model.step[None]).max(axis=1) + model.seen[:, symbol]
    return score


def viterbi(model: Model, symbols: np.ndarray, enter: int | None, leave: int | None) -> np.ndarray:
    """Best states of a stretch, given the state before it and its last one where known."""
    score = (model.first if enter is None else model.step[enter]) + model.seen[:, symbols[0]]
    back = []
    for symbol in symbols[1:]:
        reach = score[:, None] + model.step
        back.append(reach.argmax(axis=0))
        score = reach.max(axis=0) + model.seen[:, symbol]
    state = int(score.argmax()) if leave is None else leave
    out = [state]
    for b in reversed(back):
        out.append(state := int(b[state]))
    return np.array(out[::-1])


def _stretches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows of one conversation and block at a time, from batches sorted by them."""
    rest, last = [], None
    for batch in batches:
        keys = list(zip(batch.column("conv_id").to_pylist(), batch.column("block").to_pylist(), strict=True))
        at = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[at]:
                if rest and last != keys[at]:
                    yield pa.Table.from_batches(rest)
                    rest = []
                rest.append(batch.slice(at, i - at))
                last, at = keys[at], i
    if rest:
        yield pa.Table.from_batches(rest)


def _boundaries(lines: DataFrame, model: Model) -> DataFrame:
    """``conv_id, block, enter, leave`` of conversations with several blocks.

    Each block becomes a table of scores between states; these combine by conversation,
    a few hundred bytes for all lines of a block.
    """
    many = lines.groupBy("conv_id").agg(F.min("block").alias("a"), F.max("block").alias("b"))
    many = many.where("a < b").select("conv_id", F.col("a").alias("first_block"))
    kind = lines.schema["conv_id"].dataType.simpleString()
    rows = lines.join(many, "conv_id").repartition("conv_id", "block")
    rows = rows.sortWithinPartitions("conv_id", "block", "line_no", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in _stretches(batches):
            block = part["block"][0].as_py()
            score = transfer(model, part["seen"].to_numpy(), block == part["first_block"][0].as_py())
            yield pa.RecordBatch.from_arrays(
                [part["conv_id"].slice(0, 1).combine_chunks(), pa.array([block]), pa.array([score.ravel().tolist()])],
                ["conv_id", "block", "score"],
            )

    def chained(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        scores = np.array(table["score"].to_pylist()).reshape(-1, STATES, STATES)
        reach, best = [scores[0][0]], scores[0][0]
        for s in scores[1:]:
            reach.append(best := (best[:, None] + s).max(axis=0))
        leave = [int(best.argmax())]
        for k in range(len(scores) - 1, 0, -1):
            leave.append(int((reach[k - 1] + scores[k][:, leave[-1]]).argmax()))
        leave = leave[::-1]
        enter = pa.array([None, *leave[:-1]], pa.int32())
        return pa.table({"conv_id": table["conv_id"], "block": table["block"], "enter": enter, "leave": pa.array(leave, pa.int32())})

    tables = rows.select("conv_id", "block", "seen", "first_block").mapInArrow(run, f"conv_id {kind}, block long, score array<double>")
    return tables.groupBy("conv_id").applyInArrow(chained, f"conv_id {kind}, block long, enter int, leave int")


def _joined(pieces: DataFrame) -> DataFrame:
    """Whole turns from the first and last pieces of blocks; ``joins`` marks what goes on from the block before.

    Only numbers are ordered by conversation, at most two rows a block; texts meet by turn.
    """
    order = Window.partitionBy("conv_id").orderBy("block", "piece")
    begins = F.when(~F.col("joins"), F.struct("block", "piece"))
    heads = pieces.select("conv_id", "block", "piece", F.last(begins, ignorenulls=True).over(order).alias("head"))
    texts = F.array_sort(F.collect_list(F.struct("block", "content")))
    turns = pieces.join(heads, ["conv_id", "block", "piece"]).groupBy("conv_id", "head").agg(
        F.min("line_no").alias("line_no"),
        F.min("role").alias("role"),
        F.sum("n_lines").alias("n_lines"),
        F.array_join(texts["content"], "\n").alias("content"),
    )
    return turns.drop("head").withColumn("content", F.rtrim("content", F.lit("\n")))


def rendered(role: Column, content: Column) -> Column:
    """A turn in canonical form."""
    return F.concat(F.lit("<|"), role, F.lit("|>\n"), content, F.lit("\n<|end|>"))


def parsed_turns(lines: DataFrame, model: Model, *, block_span: int = 4096) -> DataFrame:
    """``conv_id, line_no, role, n_lines, content, rendered``: a row per recovered turn.

    ``lines`` has ``conv_id, line_no, line``; ``line_no`` orders a conversation from 0. The roles
    are those of the best path of the whole conversation. A turn is a start line and
    what follows up to the next start or another role; markers and closing empty lines are
    taken off. Conversations are worked on in blocks of ``block_span`` line numbers, so one with
    a third of all lines spreads; the parts of a turn that goes on over a block's end are
    put together again. Rows that repeat a line with its number count once, a NULL line is empty.
    """
    kind = lines.schema["conv_id"].dataType.simpleString()
    line = F.coalesce("line", F.lit("")).alias("line")
    rows = lines.select("conv_id", F.col("line_no").cast("long").alias("line_no"), line).distinct()
    rows = rows.withColumn("block", F.floor(F.col("line_no") / block_span).cast("long"))
    rows = rows.withColumn("seen", observed(F.col("line")))
    edges = _boundaries(rows, model)
    rows = rows.join(edges, ["conv_id", "block"], "left").repartition("conv_id", "block")
    rows = rows.sortWithinPartitions("conv_id", "block", "line_no", "line")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = {k: [] for k in ("conv_id", "line_no", "role", "n_lines", "content", "block", "piece", "joins", "edge")}, 0
        for part in _stretches(batches):
            enter, leave, block = (part[c][0].as_py() for c in ("enter", "leave", "block"))
            states = viterbi(model, part["seen"].to_numpy(), enter, leave)
            role, what = states // len(KINDS), states % len(KINDS)
            new = (what == 0) | np.concatenate(([True], role[1:] != role[:-1]))
            at, texts = np.flatnonzero(new), part["line"].to_pylist()
            numbers, conv = part["line_no"].to_pylist(), part["conv_id"][0].as_py()
            goes_on = enter is not None and bool(what[0] != 0 and role[0] == enter // len(KINDS))
            for a, b in zip(at.tolist(), [*at[1:].tolist(), len(texts)], strict=True):
                joins = goes_on and a == 0
                edge = joins or (leave is not None and b == len(texts))
                content = "\n".join(texts[a:b])
                held["conv_id"].append(conv)
                held["line_no"].append(numbers[a])
                held["role"].append(ROLES[role[a]])
                held["n_lines"].append(b - a)
                held["content"].append(content if edge else content.rstrip("\n"))
                held["block"].append(block)
                held["piece"].append(a)
                held["joins"].append(joins)
                held["edge"].append(edge)
                n += len(held["content"][-1]) + 50
            if n > 4 << 20:
                yield pa.RecordBatch.from_pydict(held, schema)
                held, n = {k: [] for k in held}, 0
        if held["role"]:
            yield pa.RecordBatch.from_pydict(held, schema)

    from pyspark.sql.pandas.types import to_arrow_schema

    turn = f"conv_id {kind}, line_no long, role string, n_lines long, content string"
    out = f"{turn}, block long, piece long, joins boolean, edge boolean"
    empty = lines.sparkSession.createDataFrame([], out)
    schema = to_arrow_schema(empty.schema)
    pieces = stored(rows.mapInArrow(run, out))
    turns = pieces.where("NOT edge").select(*empty.columns[:5]).unionByName(_joined(pieces.where("edge")))
    turns = turns.withColumn("content", F.regexp_replace("content", ANY_MARKER, ""))
    return turns.withColumn("rendered", rendered(F.col("role"), F.col("content")))


# --- transcripts ---------------------------------------------------------------------------

#: Ways to write a transcript: a marker for each role, in the order of ROLES.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Note: ", "Q: ", "A: "),
    ("### Context: ", "### Human: ", "### Answer: "),
    ("[system] ", "[user] ", "[assistant] "),
)
#: Numbers that each turn has for its lines; a turn of more lines raises.
TURN_SPAN = 1 << 24


def transcript_lines(conversations: DataFrame) -> DataFrame:
    """``conv_id, line_no, line, role, kind`` of conversations written as transcripts.

    Each conversation has a style of its own; one marker in six is missing. An empty line
    parts turns. Rows without an id, a turn or a known role have no place in a transcript.
    """
    known = F.col("conv_id").isNotNull() & F.col("turn").isNotNull() & F.col("role").isin(*ROLES)
    rows = conversations.where(known).select("conv_id", "turn", "role", "text").distinct()
    styles = F.array(*[F.array(*[F.lit(m) for m in style]) for style in STYLES])
    at = F.array_position(F.array(*[F.lit(r) for r in ROLES]), F.col("role"))
    style = F.element_at(styles, (F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES))) + 1).cast("int"))
    marker = F.when(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(6)) != 0, F.element_at(style, at.cast("int")))
    whole = F.concat(F.coalesce(marker, F.lit("")), F.coalesce("text", F.lit("")), F.lit("\n"))
    parts = rows.select("conv_id", "turn", "role", F.posexplode(F.split(whole, "\n")).alias("i", "line"))
    kind = F.when(F.col("i") == 0, "start").when(F.col("line") == "", "gap").otherwise("inside")
    many = F.raise_error(F.concat(F.lit("a turn of too many lines in conversation "), F.col("conv_id")))
    number = F.when(F.col("i") < TURN_SPAN, F.col("turn") * TURN_SPAN + F.col("i")).otherwise(many.cast("long"))
    return parts.select("conv_id", number.alias("line_no"), "line", "role", kind.alias("kind"))


def recovered_turns(conversations: DataFrame) -> DataFrame:
    """Transcripts of ``conversations`` parsed again: ``conv_id, turn, role, n_lines, rendered``.

    The model is counted on the conversations of the folds other than 0 (by a hash of their
    id); all are parsed, without their roles.
    """
    span = 512 * TURN_SPAN
    lines = transcript_lines(conversations).withColumn("block", F.floor(F.col("line_no") / span).cast("long"))
    model = fit(lines.where(F.pmod(F.xxhash64("conv_id"), F.lit(5)) != 0))
    turns = parsed_turns(lines.select("conv_id", "line_no", "line"), model, block_span=span)
    turn = F.floor(F.col("line_no") / TURN_SPAN).cast("long").alias("turn")
    return turns.select("conv_id", turn, "role", "n_lines", "rendered")
