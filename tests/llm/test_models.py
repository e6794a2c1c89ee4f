"""What the operators learn, against plain loops, all paths and exact solutions."""

import itertools
import math
import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from linkloom.llm import chat_hmm, host_rules, lattice, nbsvm, pii, toxicity
from linkloom.llm.frames import training_labels
from linkloom.llm.words import split_words, word_hashes

MASK = (1 << 64) - 1


def mixed(x):
    x = ((x ^ (x >> 33)) * 0xFF51AFD7ED558CCD) & MASK
    x = ((x ^ (x >> 33)) * 0xC4CEB9FE1A85EC53) & MASK
    return x ^ (x >> 33)


# --- 1 -------------------------------------------------------------------------------


def test_host_rates_by_a_plain_loop(spark):
    rng = random.Random(2)
    rows = []
    for h in range(30):
        share = rng.betavariate(1, 9)
        rows += [(f"h{h}", rng.random() < share) for _ in range(rng.randrange(5, 200))]
    rows += [("bad", i % 10 != 0) for i in range(80)]
    frame = spark.createDataFrame(rows, "host string, failed boolean").select(
        "host",
        F.when(F.col("failed"), 5).otherwise(100).alias("n_words"),
        F.lit(400).alias("word_chars"),
        *[F.lit(0).alias(c) for c in ("n_symbols", "n_dup_lines", "n_repeat_words")],
    )
    got = {r["host"]: r for r in host_rules.host_rates(frame).collect()}
    n, bad = Counter(h for h, _ in rows), Counter(h for h, f in rows if f)
    total = len(rows)
    mean = sum(bad.values()) / total
    square = sum(n[h] * (bad[h] / n[h]) ** 2 for h in n) / total
    between = square - mean**2 - mean * (1 - mean) * len(n) / total
    strength = mean * (1 - mean) / between - 1
    grid = (np.arange(200_000) + 0.5) / 200_000
    for h in n:
        a, b = strength * mean + bad[h], strength * (1 - mean) + n[h] - bad[h]
        density = np.exp((a - 1) * np.log(grid) + (b - 1) * np.log1p(-grid) + math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b))
        above = density[grid > host_rules.WORSE * mean].mean() * (grid > host_rules.WORSE * mean).mean()
        assert got[h]["short_rate"] == pytest.approx(a / (a + b), rel=1e-9)
        assert got[h]["short_worse"] == pytest.approx(above, abs=1e-4)
    assert got["bad"]["short_worse"] > 0.99 and sum(r["short_worse"] >= 0.99 for r in got.values()) < 4
    # Hosts alike but for chance pull to the common rate.
    assert {r["symbols_rate"] for r in got.values()} == {0.0}


def test_a_bad_host_is_rejected_whole(spark):
    good = "word " * 6 + "some more of these words make a text that is long enough for the rules to be kept here"
    docs = [(i, f"h{i % 20}", good.replace("word", f"w{i}")) for i in range(800)]
    docs += [(1000 + i, "bad", good if i % 3 else "too short") for i in range(60)] + [(2000, None, good)]
    frame = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("host", F.lit("clash"))
    got = {r["doc_id"]: r for r in host_rules.host_verdicts(frame).collect()}
    assert all(not got[1000 + i]["kept"] for i in range(60))
    assert all(got[i]["kept"] == (not got[i]["base_failed"]) for i in [*range(800), 2000])


# --- 2 -------------------------------------------------------------------------------

TEXTS = ["The CAT sat!! sat", "", None, "#x 12 - the", "a", "Ünï ünï ÜNÏ", "long" * 5 + " The CAT " + "x1!", "é " * 9]


def form(word, before):
    raw = word.encode()
    upper = sum(0x41 <= b <= 0x5A for b in raw)
    lower = sum(0x61 <= b <= 0x7A or b >= 0x80 for b in raw)
    if not upper + lower:
        case = 0
    elif not upper:
        case = 1
    elif upper == 1 and 0x41 <= raw[0] <= 0x5A and lower:
        case = 2
    elif not lower or upper * 2 > upper + lower // 2:
        case = 3
    else:
        case = 4
    marks = [
        any(c in b"#*$%&|<>" for c in raw),
        any(c in b"!?" for c in raw),
        any(0x30 <= c <= 0x39 for c in raw),
        any(0x20 < c < 0x80 and not chr(c).isalnum() and c not in b"#*$%&|<>!?" for c in raw),
    ]
    mark = next((i + 1 for i, m in enumerate(marks) if m), 0)
    length = sum(len(word) >= n for n in (3, 8, 15))
    return ((case * 5 + mark) * 4 + length) * 2 + (word == before)


def indicators(text):
    words = (text or "").split()
    forms = [form(w, b) for w, b in zip(words, [None, *words])]
    lower = ["".join(c.lower() if c.isascii() else c for c in w) for w in words]
    hashes = [int(word_hashes(split_words(pa.array([w])))[0]) for w in lower]
    out = set()
    for unit, order, scale, salt in ((forms, 4, 256, 40), (hashes, 2, 0x9E3779B97F4A7C15, 44)):
        for n in range(1, order + 1):
            for i in range(len(unit) - n + 1):
                gram = 0
                for x in unit[i : i + n]:
                    gram = (gram * scale + x) & MASK
                out.add(mixed((gram + (n << salt)) & MASK) % nbsvm.BUCKETS)
    return out


def test_indicators_by_a_plain_loop():
    doc, bucket = nbsvm.ngram_indicators(pa.array(TEXTS))
    got = [set(bucket[doc == i].tolist()) for i in range(len(TEXTS))]
    assert got == [indicators(t) for t in TEXTS] and len(bucket) == sum(map(len, got))


def test_class_counts_and_repeated_ids(spark):
    rows = [(i, TEXTS[i % len(TEXTS)]) for i in range(40)] + [(3, TEXTS[3])] * 50 + [(3, "another text of three")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    table = nbsvm.indicator_table(docs)
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    known = training_labels(labels, "quality")
    label = {r["doc_id"]: r["label"] for r in known.collect()}
    once = table.join(known, "doc_id").dropDuplicates(["doc_id", "text_hash"])
    got = nbsvm.class_counts(once)
    want = np.zeros((2, nbsvm.BUCKETS))
    for doc, text in set(rows):
        if doc in label:
            for b in indicators(text):
                want[label[doc], b] += 1
    assert np.array_equal(got, want)
    # The bound holds whatever one id has, and copies change nothing.
    few = nbsvm.fit(docs, known, sample=10)
    assert np.isfinite(few.weights).all()
    plain = nbsvm.fit(spark.createDataFrame(list(set(rows)), docs.schema), known)
    assert np.allclose(nbsvm.fit(docs, known).weights, plain.weights)
    # A weight is the ratio times what the hinge loss gives: none without a labelled text that holds it.
    assert set(np.flatnonzero(plain.weights)) <= set(np.flatnonzero(want.sum(axis=0)))


def test_dual_descent_reaches_the_optimum():
    rng = np.random.default_rng(3)
    n, m = 60, 12
    x = (rng.random((n, m)) < 0.4) * rng.normal(size=m)
    sign = np.where(x @ rng.normal(size=m) + 0.8 * rng.normal(size=n) > 0, 1.0, -1.0)
    cost = np.where(sign > 0, 0.7, 1.3)
    row, bucket = np.nonzero(x)
    w, b = nbsvm.dual_coordinate_descent(row, bucket, x[row, bucket], sign, cost, 3000)
    wide = np.append(w[:m], b)
    design = np.hstack([x, np.ones((n, 1))])

    def primal(v):
        return v @ v / 2 + (cost * np.maximum(0, 1 - sign * (design @ v))).sum()

    # The dual by projected gradient steps, to convergence: the gap to it bounds the distance to the optimum.
    gram = (design * sign[:, None]) @ (design * sign[:, None]).T
    dual, step = np.zeros(n), 1 / np.linalg.norm(gram, 2)
    for _ in range(200_000):
        dual = np.clip(dual + step * (1 - gram @ dual), 0, cost)
    best = dual.sum() - dual @ gram @ dual / 2
    assert best <= primal(wide) + 1e-9 and primal(wide) - best < 1e-3 * best


# --- 6 -------------------------------------------------------------------------------


def entries(text):
    words = {"".join(c.lower() if c.isascii() else c for c in w) for w in __import__("re").findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)}
    out = set(words)
    for k in toxicity.BEGINNINGS:
        heads = Counter(w[:k] for w in words if len(w) > k)
        out |= {f"{h}-" for h in heads} | {f"{h}--" for h, n in heads.items() if n > 1}
    return out


def test_lexicon_counts_by_a_plain_loop(spark):
    rng = random.Random(9)
    words = ["plain", "plainer", "plainest", "Ugly", "uglier", "ñandú", "été", "étéland", "x"]
    rows = [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(6))), i % 2) for i in range(80)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, label int").repartition(3)
    got = {r["entry"]: (r["clean"], r["toxic"]) for r in toxicity.entry_counts(frame).collect()}
    want = Counter((e, y) for _, t, y in rows for e in entries(t))
    assert got == {e: (want[e, 0], want[e, 1]) for e, _ in want}
    assert all(toxicity.SOURCES[toxicity.source_of(e)] is not None for e in got)


def test_copies_of_a_labelled_text_say_nothing_new(spark):
    rng = random.Random(1)
    own = lambda: " ".join(f"w{rng.randrange(400)}" for _ in range(30))
    rows = [(i, own() + (" slurword" if i % 4 == 0 else "")) for i in range(400)]
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    known = training_labels(labels, "toxic")
    plain = spark.createDataFrame(rows, "doc_id long, text string")
    copied = spark.createDataFrame(rows + [(4, rows[4][1])] * 300 + [(9, "unlabelled here")] * 3, plain.schema)
    first, second = (toxicity.induced_lexicon(d, known) for d in (plain, copied))
    assert first == second and first["slurword"] % 2 == 0
    assert toxicity.labelled_texts(copied, known).count() == toxicity.labelled_texts(plain, known).count() + 1
    assert len(toxicity.induced_lexicon(plain, known, size=1)) <= len(toxicity.SOURCES)


def test_evidence(spark):
    row = spark.range(1).select(toxicity.evidence(F.lit(8.0), F.lit(1.0), 40, 300).alias("g")).first()
    table, want = np.array([[8, 1], [32, 299]], dtype=float), 0.0
    for (i, j), x in np.ndenumerate(table):
        want += 2 * x * math.log(x * table.sum() / (table[i].sum() * table[:, j].sum()))
    assert row["g"] == pytest.approx(want)


def test_label_model_counts_a_repeated_voter_once():
    """Voter 1 says what voter 0 says; voter 30 % apart from both is independent of them."""
    rng = np.random.default_rng(4)
    n = 40_000
    y = rng.random(n) < 0.3
    one = np.where(y, rng.random(n) < 0.8, rng.random(n) < 0.1)
    three = np.where(y, rng.random(n) < 0.6, rng.random(n) < 0.05)
    four = np.where(y, rng.random(n) < 0.7, rng.random(n) < 0.2)
    mask = one * 1 + one * 2 + three * 4 + four * 8
    known = np.where(rng.random(n) < 0.1, y, -1)
    cells, count = np.unique(np.stack([mask, known]), axis=1, return_counts=True)
    model = toxicity.label_model(cells[0], cells[1], count.astype(float))
    seen = np.arange(16)
    fired = toxicity._bits(seen)
    # A proper distribution: the probabilities of all patterns add up to one.
    total = np.exp(model.log_likelihood(toxicity._bits(np.arange(1 << 10)))).sum(axis=0)
    rest = np.prod(1 - model.table[:, 10:, 0], axis=1)
    assert np.allclose(total, rest, rtol=0.05) or np.all(total <= 1 + 1e-9)
    for s in (0, 3, 4, 7, 8, 11, 12, 15):
        p = np.array([[0.1, 0.05, 0.2], [0.8, 0.6, 0.7]])
        bits = np.array([s & 1, s >> 2 & 1, s >> 3 & 1], bool)
        like = np.where(bits, p, 1 - p).prod(axis=1) * (0.7, 0.3)
        assert model.posterior(fired)[s] == pytest.approx(like[1] / like.sum(), abs=0.06), s
    assert model.parent[1] == 0 or model.parent[0] == 1


# --- 7 -------------------------------------------------------------------------------


def test_viterbi_is_the_best_of_all_paths():
    rng = np.random.default_rng(0)
    n = chat_hmm.STATES
    for size in (1, 2, 3, 4):
        first = np.log(rng.dirichlet(np.ones(n)))
        step = np.log(rng.dirichlet(np.ones(n), n))
        seen = np.log(rng.dirichlet(np.ones(chat_hmm.SYMBOLS), n))
        model, symbols = chat_hmm.Model(first, step, seen), rng.integers(0, chat_hmm.SYMBOLS, size)

        def score(path):
            return first[path[0]] + sum(step[a, b] for a, b in zip(path, path[1:])) + sum(seen[s, x] for s, x in zip(path, symbols))

        best = max(itertools.product(range(n), repeat=size), key=score)
        assert tuple(chat_hmm.viterbi(model, symbols, None, None)) == best
        assert chat_hmm.transfer(model, symbols, True).max() == pytest.approx(score(best))


def test_counts_of_the_chat_model(spark):
    rows = [("c", 0, "User: hi", "user", "start"), ("c", 1, "there", "user", "inside"), ("c", 2, "", "user", "gap")]
    rows += [("c", 3, "Bot: yes?", "assistant", "start"), ("d", 0, "Bot: no", "assistant", "start")]
    lines = spark.createDataFrame(rows, "conv_id string, line_no long, line string, role string, kind string")
    model = chat_hmm.fit(lines.withColumn("block", F.lit(0).cast("long")))
    n, k = chat_hmm.STATES, len(chat_hmm.KINDS)
    user, bot = chat_hmm.ROLES.index("user") * k, chat_hmm.ROLES.index("assistant") * k
    first = np.full(n, 0.1)
    first[user] += 1
    first[bot] += 1
    assert np.allclose(model.first, np.log(first / first.sum()))
    step = np.full((n, n), 0.1)
    for a, b in ((user, user + 1), (user + 1, user + 2), (user + 2, bot)):
        step[a, b] += 1
    assert np.allclose(model.step, np.log(step / step.sum(axis=1, keepdims=True)))


STYLES = [("Customer> ", "Agent> "), ("**Human**: ", "**AI**: "), ("q: ", "a: "), ("### User: ", "### Assistant: ")]


def foreign(spark, sf_dir):
    """Transcripts in other hands: other markers, one in five missing, one in twenty-five wrong, no system turns."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").where("role <> 'system'")
    rng, rows = random.Random(6), []
    for r in turns.orderBy("conv_id", "turn").collect():
        style = STYLES[hash_of(r["conv_id"]) % len(STYLES)]
        at = r["role"] == "assistant"
        draw = rng.random()
        marker = "" if draw < 0.2 else style[1 - at] if draw < 0.24 else style[at]
        parts = (marker + (r["text"] or "")).split("\n") + [""]
        rows += [(r["conv_id"], r["role"], line, r["turn"]) for line in parts]
    numbers = Counter()
    out = []
    for conv, role, line, turn in rows:
        out.append((conv, numbers[conv], line, role, turn))
        numbers[conv] += 1
    return spark.createDataFrame(out, "conv_id long, line_no long, line string, role string, turn long")


def hash_of(x):
    return mixed(int(x) + 1)


def test_roles_of_foreign_transcripts(spark, sf_dir):
    """Share of lines whose role comes out right: far above that of reading the markers alone."""
    lines = foreign(spark, sf_dir)
    known = chat_hmm.transcript_lines(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    model = chat_hmm.fit(known.withColumn("block", F.lit(0).cast("long")))
    turns = chat_hmm.parsed_turns(lines.select("conv_id", "line_no", "line"), model).collect()
    role = {}
    for t in turns:
        for i in range(t["n_lines"]):
            role[t["conv_id"], t["line_no"] + i] = t["role"]
    rows = [r for r in lines.collect() if r["line"]]
    right = np.mean([role.get((r["conv_id"], r["line_no"])) == r["role"] for r in rows])
    print(f"lines right: {right:.3f}")
    assert right > 0.85


# --- 8 -------------------------------------------------------------------------------


def test_reliabilities_by_plain_expectation_maximisation():
    rng = np.random.default_rng(5)
    votes = np.unique(rng.integers(0, 32, 20))
    fired, count = (votes[:, None] >> np.arange(5)) & 1 == 1, rng.integers(1, 200, len(votes)).astype(float)
    rates, soft = pii._reliabilities(fired, count)
    start = [[0.1, 0.3, 0.1, 0.4, 0.3], [0.7, 0.9, 0.4, 0.9, 0.03]]
    now, prior, last = [list(x) for x in start], 0.5, [0.0] * len(votes)
    for _ in range(100):
        post = []
        for f in fired:
            like = [1 - prior, prior]
            for y in (0, 1):
                for j in range(5):
                    like[y] *= now[y][j] if f[j] else 1 - now[y][j]
            post.append(like[1] / (like[0] + like[1]))
        for y in (0, 1):
            weight = [c * (p if y else 1 - p) for c, p in zip(count, post)]
            for j in range(5):
                hit = sum(w for w, f in zip(weight, fired) if f[j])
                now[y][j] = min(max((hit + 4 * start[y][j]) / (sum(weight) + 4), 0.01), 0.99)
        right = sum(c * p for c, p in zip(count, post))
        prior = min(max((right + 1) / (count.sum() + 2), 0.01), 0.5)
        if max(abs(a - b) for a, b in zip(post, last)) < 1e-7:
            break
        last = post
    assert np.allclose(rates, now, atol=1e-6) and np.allclose(soft, post, atol=1e-5)


# --- 9 -------------------------------------------------------------------------------


def test_lattice_is_the_cheapest_of_all_segmentations(spark):
    vocabulary = lattice.load_vocabulary()
    costs = {p: int(c) for p, c, u in zip(vocabulary.pieces, vocabulary.costs, vocabulary.usable) if u}
    rng = random.Random(2)
    words = {"▁the", "▁nation", "▁ññé", "▁a", "▁", "▁😀the", "▁undoing"}
    words |= {"▁" + "".join(rng.choice("theraiosn") for _ in range(rng.randrange(1, 11))) for _ in range(40)}
    frame = spark.createDataFrame([(w,) for w in sorted(words)], "word string")
    pieces = lattice.piece_table(spark, vocabulary)
    paths = lattice.best_paths(frame, pieces, vocabulary.longest, vocabulary.unknown_cost).collect()
    for row in paths:
        word, at, got = row["word"], len(row["word"]), 0
        while at:
            piece = row["path"][at - 1]
            got += int(vocabulary.costs[piece]) if piece >= 0 else vocabulary.unknown_cost
            at -= len(vocabulary.pieces[piece]) if piece >= 0 else 1
        best = math.inf
        for cuts in range(1 << (len(word) - 1)):
            parts, start = [], 0
            for i in range(1, len(word) + 1):
                if i == len(word) or cuts >> (i - 1) & 1:
                    parts.append(word[start:i])
                    start = i
            total = 0
            for part in parts:
                total += costs.get(part, vocabulary.unknown_cost if len(part) == 1 else math.inf)
            best = min(best, total)
        assert got == best, word
    assert len(paths) == len(words)
