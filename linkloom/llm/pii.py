"""Personal data: regex, gazetteer and context labelers, their reliabilities, a span classifier."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from linkloom.llm.frames import Shared, stored
from linkloom.llm.words import sliced

KINDS = ("email", "ip", "card", "phone")

# Base patterns. A look-behind keeps a scan from starting inside a run of digits, where
# a match can't begin unless it could have begun earlier; scans stay linear.
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[ -]?[0-9])+")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]")

# Wider candidates, which only the classifier can accept.
WRITTEN_EMAIL = re.compile(
    r"(?<![\w.%+-])[\w.%+-]{1,64} ?[(\[]at[)\]] ?[A-Za-z0-9-]{1,63}(?: ?(?:[(\[]dot[)\]]|\.) ?[A-Za-z0-9-]{1,63}){1,8}", re.ASCII
)
NATIONAL_PHONE = re.compile(r"(?<![0-9+.-])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")
GROUPED_CARD = re.compile(r"(?<![0-9-])[0-9]{4}(?:[ -][0-9]{4}){3}(?![0-9-])")
LONG_IP = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")

# Gazetteers and cue words (fixed values).
TOP_DOMAINS = frozenset("com org net edu gov info io de fr es it uk eu ch at nl be us ca au jp cn in br ru pl se".split())
CARD_PREFIXES = re.compile(r"4|5[1-5]|2[2-7]|3[47]|6011|65|35")
CUES = (
    re.compile(r"e-?mail|contact|write|correo|courriel|schreib", re.I),
    re.compile(r"\bip\b|address|host|server|dirección|adresse", re.I),
    re.compile(r"card|visa|credit|pay|tarjeta|carte|karte", re.I),
    re.compile(r"phone|tel|call|fax|mobile|llam|appel|anruf|rufen", re.I),
)
AGAINST = re.compile(r"(?:version|\bv|#|\bid|isbn|\bno\.?|ticket|order) ?$", re.I)
BEFORE = 40

#: Labelers: a bit of the votes each.
STRICT, LISTED, CUED, SHAPED, OPPOSED = range(5)
LABELERS = 5


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """Matches of the e-mail pattern, from each @ outwards, so that no run is read twice."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            done = m.end()
        at = text.find("@", max(at + 1, done))


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(kind, start, end)`` of the base patterns, in code points."""
    out = [(0, *s) for s in _emails(text)] if "@" in text else []
    if not DIGITS.search(text):
        return out
    for m in IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or "0") <= 255 for p in parts):
            out.append((1, *m.span()))
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _digits(m.group())
            if 13 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in PHONE.finditer(text):
            if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
                out.append((3, *m.span()))
    return out


def _wider(text: str) -> Iterator[tuple[int, int, int]]:
    if "[at]" in text or "(at)" in text:
        yield from ((0, *m.span()) for m in WRITTEN_EMAIL.finditer(text))
    if not DIGITS.search(text):
        return
    if text.count(":") >= 7:
        yield from ((1, *m.span()) for m in LONG_IP.finditer(text))
    yield from ((2, *m.span()) for m in GROUPED_CARD.finditer(text))
    yield from ((3, *m.span()) for m in NATIONAL_PHONE.finditer(text))


def _votes(text: str, kind: int, start: int, end: int, strict: bool) -> int:
    span, before = text[start:end], text[max(0, start - BEFORE) : start]
    digits = _digits(span) if kind else ""
    if kind == 0:
        top = re.split(r"[.\])]", span)[-1].strip().lower()
        listed, shaped = top in TOP_DOMAINS, len(span) <= 100 and ".." not in span
    elif kind == 1:
        parts = span.split(".")
        listed = ":" in span or digits[:1] not in ("", "0")
        shaped = ":" in span or all(p == "0" or not p.startswith("0") for p in parts)
    elif kind == 2:
        listed, shaped = bool(CARD_PREFIXES.match(digits)), len(digits) in (15, 16) and _luhn(digits)
    else:
        national = digits[-10:]
        listed, shaped = len(national) == 10 and national[0] in "23456789", 10 <= len(digits) <= 13
    flags = (strict, listed, bool(CUES[kind].search(before)), shaped, bool(AGAINST.search(before)))
    return sum(1 << i for i, f in enumerate(flags) if f)


def candidates(text: str) -> list[tuple[int, int, int, bool, int]]:
    """``(kind, start, end, base, votes)``: base spans, then wider ones that overlap none of them."""
    base = base_spans(text)
    out = [(*s, True, _votes(text, *s, True)) for s in base]
    taken = sorted((s, e) for _, s, e in base)
    starts = np.array([s for s, _ in taken], dtype=np.int64)
    reach = np.maximum.accumulate([e for _, e in taken]) if taken else starts
    for kind, start, end in _wider(text):
        before = int(np.searchsorted(starts, end))
        if not before or reach[before - 1] <= start:
            out.append((kind, start, end, False, _votes(text, kind, start, end, False)))
    return sorted(out)


SPANS = "array<struct<kind:int,start:int,end:int,base:boolean,votes:int>>"


def _span_lists(column: pa.Array) -> pa.Array:
    lists = [candidates(t) if t else [] for t in column.to_pylist()]
    reach = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int32)
    flat = [v for x in lists for v in x]
    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.bool_(), pa.int32()]
    fields = [pa.array([v[i] for v in flat], t) for i, t in enumerate(kinds)]
    struct = pa.StructArray.from_arrays(fields, ["kind", "start", "end", "base", "votes"])
    return pa.ListArray.from_arrays(pa.array(reach), struct)


def candidate_table(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans``: the candidates of every whole text; NULL has none."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), _span_lists(batch.column("text"))], ["doc_id", "spans"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, spans {SPANS}")


@dataclass(frozen=True)
class SpanModel:
    """Kind and votes of the candidates that the classifier accepts beyond the base spans."""

    accepted: frozenset[int]  # kind << LABELERS | votes
    reliability: np.ndarray  # kinds x 2 x labelers: how often a labeler votes on wrong and right spans


def _reliabilities(fired: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns of one kind: vote rates and posteriors.

    Rates start from what each labeler is meant to say and keep that as a prior worth
    a few candidates, so that a kind with few candidates stays sensible. The share of
    right spans counts as one half at most: base matches say nothing on wider ones.
    """
    start = np.array([[0.1, 0.3, 0.1, 0.4, 0.3], [0.7, 0.9, 0.4, 0.9, 0.03]])
    rates, prior, strength = start, 0.5, 4.0
    soft = np.zeros(len(count))
    for _ in range(100):
        odds = np.log(prior / (1 - prior)) + np.where(
            fired, np.log(rates[1] / rates[0]), np.log((1 - rates[1]) / (1 - rates[0]))
        ).sum(axis=1)
        new = 1 / (1 + np.exp(-np.clip(odds, -500, 500)))
        share = np.stack([count * (1 - new), count * new])
        rates = np.clip((share @ fired + strength * start) / (share.sum(axis=1)[:, None] + strength), 0.01, 0.99)
        prior = min(max((share[1].sum() + 1) / (count.sum() + 2), 0.01), 0.5)
        if np.abs(new - soft).max() < 1e-7:
            break
        soft = new
    return rates, soft


def fit(spans: DataFrame) -> SpanModel:
    """Label model and classifier from the ``spans`` of all rows.

    Only counts of vote patterns reach the driver, at most 32 a kind. The classifier
    is a logistic function of kind and votes, trained on the posteriors.
    """
    exploded = spans.select(F.inline("spans"))
    rows = exploded.groupBy("kind", "votes").count().orderBy("kind", "votes").collect()
    kind = np.array([r["kind"] for r in rows], dtype=np.int64)
    votes = np.array([r["votes"] for r in rows], dtype=np.int64)
    count = np.array([r["count"] for r in rows], dtype=float)
    fired = (votes[:, None] >> np.arange(LABELERS)) & 1 == 1
    soft, rates = np.zeros(len(rows)), np.zeros((len(KINDS), 2, LABELERS))
    for k in range(len(KINDS)):
        if (own := kind == k).any():
            rates[k], soft[own] = _reliabilities(fired[own], count[own])
    every = np.arange(len(KINDS) << LABELERS)
    x = _span_features(kind, votes)
    w, seen = np.zeros(x.shape[1]), np.full(x.shape[1], 1e-9)
    for _ in range(500 if len(rows) else 0):
        error = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500))) - soft
        gradient = x.T @ (error * count) / count.sum() + 0.001 * w
        seen += gradient**2
        w -= 0.5 * gradient / np.sqrt(seen)
    odds = _span_features(every >> LABELERS, every & ((1 << LABELERS) - 1)) @ w
    return SpanModel(frozenset(every[odds > 0].tolist()), rates)


def _span_features(kind: np.ndarray, votes: np.ndarray) -> np.ndarray:
    fired = (votes[:, None] >> np.arange(LABELERS)) & 1
    return np.concatenate([fired, np.eye(len(KINDS))[kind]], axis=1).astype(float)


def _joined(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined, by kind as listed, then start."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.transform(spans, lambda s: F.struct(s["kind"], s["start"], s["end"])))
    texts = F.transform(
        ordered, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))
    )
    return F.array_join(texts, ",")


def personal_data(docs: DataFrame, **columns) -> DataFrame:
    """``doc_id``, counts and digest of the base spans, and ``spans`` as text, per row of ``docs``.

    Base spans always stay; wider candidates are added where the classifier accepts
    them. Candidates are written once without the texts; nothing else is shuffled
    but counts of vote patterns.
    """
    table = stored(candidate_table(docs, **columns))
    model = fit(table)
    accepted = F.lit(sorted(model.accepted)).cast("array<int>")

    def taken(s: Column) -> Column:
        return s["base"] | F.array_contains(accepted, F.shiftleft(s["kind"], LABELERS).bitwiseOR(s["votes"]))

    base = F.filter("spans", lambda s: s["base"])

    def count(k: int) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == k)).cast("long").alias(f"n_{KINDS[k]}")

    return table.select(
        "doc_id",
        *[count(k) for k in range(len(KINDS))],
        F.sha2(_joined(base), 256).alias("base_sha256"),
        _joined(F.filter("spans", taken)).alias("spans"),
    )


def redact(text: str, model: SpanModel) -> str:
    """``text`` with every accepted span replaced by its kind in brackets; overlaps count as one span."""
    out, at, until, name = [], 0, 0, ""
    for kind, start, end, base, votes in sorted(candidates(text), key=lambda c: (c[1], -c[2])):
        if not base and (kind << LABELERS | votes) not in model.accepted:
            continue
        if start < until:
            until = max(until, end)
            continue
        if until:
            out.append(f"[{name}]")
            at = until
        out.append(text[at:start])
        until, name = end, KINDS[kind].upper()
    if until:
        out.append(f"[{name}]")
        at = until
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``docs`` with personal data in ``text`` replaced; ``n_chars`` follows where the text changed.

    Two passes over the texts, one for the label model and one to replace; no shuffle of texts.
    """
    model = fit(candidate_table(docs, doc_id=doc_id, text=text))
    shared = Shared(docs.sparkSession, model)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    at = docs.columns.index(text)
    size_at = docs.columns.index(n_chars) if n_chars in docs.columns else None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, f"c{at}"):
            columns = list(batch.columns)
            old = columns[at].to_pylist()
            new = [redact(t, shared.value) if t else t for t in old]
            columns[at] = pa.array(new, batch.schema.field(at).type)
            if size_at is not None:
                changed = pa.array([a != b for a, b in zip(old, new, strict=True)])
                size = pc.utf8_length(columns[at]).cast(batch.schema.field(size_at).type)
                columns[size_at] = pc.if_else(changed, size, columns[size_at])
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return plain.mapInArrow(run, plain.schema).toDF(*docs.columns)
