"""Attention classifier and suffix-tree language model."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from samples import WORDS, crc, frame, prose
from samples import docs, empty, rows  # noqa: F401  fixtures
from pyspark.sql import functions as F

from sitegrid.llm import attention_quality, suffix_tree_lm
from sitegrid.llm.text import blocks


def test_gradients_by_differences():
    """One plain step of the fit moves each weight against the numeric slope of the loss."""
    rng = np.random.default_rng(0)
    bags = [rng.normal(size=(n, attention_quality.WIDTH)).astype(np.float32) for n in (1, 3, 5, 2)]
    labels = np.array([0.0, 1.0, 1.0, 0.0])
    model = attention_quality.fit(bags, labels, epochs=0)
    until = np.append(0, np.cumsum([len(b) for b in bags]))

    def loss():
        p = model.score(np.concatenate(bags), until)
        return -np.mean(labels * np.log(p) + (1 - labels) * np.log(1 - p))

    before = {k: v.copy() for k, v in model.weights.items()}
    slopes = {}
    for name in ("attend", "score", "left", "gate", "encode"):
        w = model.weights[name].reshape(-1)
        w[0] += 1e-4
        up = loss()
        w[0] -= 2e-4
        slopes[name] = (up - loss()) / 2e-4
        w[0] += 1e-4
    # the first step of Adam is the rate times the sign of the slope
    moved = attention_quality.fit(bags, labels, epochs=1, rate=1e-3, batch=4)
    for name, slope in slopes.items():
        step = (moved.weights[name] - before[name]).reshape(-1)[0]
        if abs(slope) > 1e-4:
            assert np.sign(step) == -np.sign(slope), name


def test_held_out_accuracy(spark, docs, rows, empty):
    rng = random.Random(8)
    good = [(i, prose(rng, rng.randrange(30, 300)).capitalize()) for i in range(0, 300, 2)]
    junk = [(i, " ".join(w + rng.choice(["###", "***", "%%%"]) for w in prose(rng, 60).split())) for i in range(1, 100, 2)]
    labels = {i: 1 for i, _ in good} | {i: 0 for i, _ in junk}
    df = frame(spark, good + junk)
    given = spark.createDataFrame([*labels.items(), (None, 1), (3, None), (10**6, 1)], "doc_id long, label int")
    model = attention_quality.train(df, given.where((F.crc32(F.col("doc_id").cast("string")) % 5) != 0))
    got = {r.doc_id: r.score for r in attention_quality.score(df, model).collect()}
    held_out = [i for i in labels if crc(i) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == labels[i] for i in held_out]) > 0.97
    odd = attention_quality.score(docs, model).collect()
    assert len(odd) == len(rows) and all(0 <= r.score <= 1 for r in odd)
    assert len({r.score for r in odd if r.doc_id in (0, 1, 2)}) == 1
    assert attention_quality.score(empty, model).count() == 0
    flat = attention_quality.train(df, given.where("false"))
    assert {r.score for r in attention_quality.score(df, flat).collect()} == {0.5}


def test_passages_cover_the_whole_text():
    words = [f"w{i}" for i in range(1000)]
    for n in (0, 1, 64, 65, 1000, 64 * 64 + 1):
        (block,) = blocks(pa.array([" ".join((words * 5)[:n])]))
        x, until = attention_quality.encode(block)
        assert until.tolist() == [0, max(1, math.ceil(n / max(64, math.ceil(n / 64))))]
        changed = " ".join([*(words * 5)[: n - 1], "!!!???"]) if n else "!"
        (block,) = blocks(pa.array([changed]))
        assert not np.array_equal(x, attention_quality.encode(block)[0])


def brute_tree(train, depth, least_gain, least_count):
    """Next-symbol counts of every context, and the contexts that pass the test."""
    counts = [defaultdict(Counter) for _ in range(depth + 1)]
    for s in train:
        for k in range(1, len(s)):
            for d in range(depth + 1):
                counts[d][s[max(0, k - d) : k] if d <= k else b"\0" * (d - k) + s[:k]][s[k]] += 1
    states = {}
    for d in range(1, depth + 1):
        for context, after in counts[d].items():
            n, below = sum(after.values()), counts[d - 1][context[1:]]
            m = sum(below.values())
            gain = sum(c * (math.log(c / n) - math.log(below[x] / m)) for x, c in after.items())
            if n >= least_count and round(gain, 3) >= least_gain:
                states[(d, context)] = after
    return counts[0][b""], states


def brute_score(s, root, states, depth):
    total = sum(root.values()) + 0.5 * 256
    out = 0.0
    for k in range(1, len(s)):
        p = (root[s[k]] + 0.5) / total
        for d in range(1, depth + 1):
            context = s[k - d : k] if d <= k else b"\0" * (d - k) + s[:k]
            if (d, context) in states:
                after = states[(d, context)]
                p = (after[s[k]] + len(after) * p) / (sum(after.values()) + len(after))
        out += math.log10(p)
    return out


def sequence(text):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return ("\n" + " ".join(WORDS.findall(lower)) + "\n").encode()


def test_scores_of_every_row(docs, rows):
    """Base and tree scores against brute force; repeated rows and rows without an id included."""
    training = F.col("doc_id").isNotNull() & ((F.crc32(F.col("doc_id").cast("string")) % 10) != 0)
    got = suffix_tree_lm.score(docs, training).collect()
    chosen = [t for i, t in rows if i is not None and crc(i) % 10]
    tokens = Counter()
    for t in chosen:
        tokens.update([*WORDS.findall(sequence(t).decode()), None])
    total, kinds = sum(tokens.values()), len(tokens)
    root, states = brute_tree([sequence(t) for t in chosen], suffix_tree_lm.DEPTH, suffix_tree_lm.LEAST_GAIN, suffix_tree_lm.LEAST_COUNT)
    want = []
    for i, t in rows:
        w = [*WORDS.findall(sequence(t).decode()), None]
        base = sum(math.log10((tokens[x] + 0.1) / (total + 0.1 * (kinds + 1))) for x in w)
        want.append((i if i is not None else -1, len(w), sum(tokens[x] > 0 for x in w), total, base, brute_score(sequence(t), root, states, suffix_tree_lm.DEPTH)))
    have = sorted((r.doc_id if r.doc_id is not None else -1, r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got)
    want.sort()
    assert len(have) == len(want)
    for x, y in zip(have, want):
        assert x[:4] == y[:4] and x[4:] == pytest.approx(y[4:], rel=1e-9)


def test_states_that_do_not_travel_count_in_full(docs, monkeypatch):
    """Whatever part of the tree is sent to the tasks, scores are those of the whole tree."""
    training = F.col("doc_id").isNotNull() & ((F.crc32(F.col("doc_id").cast("string")) % 10) != 0)
    table = lambda: sorted((str(r.doc_id), r.n_tokens, r.n_known, r.base_score, r.score) for r in suffix_tree_lm.score(docs, training).collect())
    whole = table()
    for limits in ((40, 10**6), (10**6, 300), (0, 0)):
        monkeypatch.setattr(suffix_tree_lm.grow, "__defaults__", (*suffix_tree_lm.grow.__defaults__[:3], *limits))
        for x, y in zip(table(), whole, strict=True):
            assert x[:3] == y[:3] and x[3:] == pytest.approx(y[3:], rel=1e-9)


def test_common_symbols_of_a_large_tree_meet_no_join(docs, monkeypatch):
    """With states beyond the limit, only symbols that are rarer than those that travel are joined; scores are the same."""
    table = lambda: sorted((str(r.doc_id), r.n_tokens, r.score) for r in suffix_tree_lm.score(docs, F.lit(True)).collect())
    whole = table()
    monkeypatch.setattr(suffix_tree_lm.grow, "__defaults__", (*suffix_tree_lm.grow.__defaults__[:3], 0, 0))
    monkeypatch.setattr(suffix_tree_lm, "MAX_ENTRIES", 200)
    for x, y in zip(table(), whole, strict=True):
        assert x[:2] == y[:2] and x[2] == pytest.approx(y[2], rel=1e-9)
    keys = docs.sparkSession.createDataFrame([(k, n) for k, n in enumerate([1] * 50 + [3] * 20 + [70] * 5 + [900])], "key long, n long")
    assert [suffix_tree_lm.commonest(keys, k) for k in (76, 75, 26, 25, 6, 1)] == [1, 3, 3, 70, 70, 900]
    assert suffix_tree_lm.commonest(keys, 0) > 900
    known = suffix_tree_lm.Known(np.array([9, 4], np.uint64), np.array([-0.5, -2.0]))
    p, other = known.look_up(np.array([4, 5, 9, 10], np.uint64))
    assert p.tolist() == [-2.0, 0, -0.5, 0] and other.tolist() == [False, True, False, True]


def test_rare_words_meet_counts_in_the_join(docs, monkeypatch):
    everything = [(r.doc_id, r.n_known, round(r.base_score, 6)) for r in suffix_tree_lm.score(docs, F.lit(True)).collect()]
    monkeypatch.setattr(suffix_tree_lm, "COMMON", 3)
    fewer = [(r.doc_id, r.n_known, round(r.base_score, 6)) for r in suffix_tree_lm.score(docs, F.lit(True)).collect()]
    key = lambda r: (r[0] is None, r)
    assert sorted(map(str, everything)) == sorted(map(str, fewer))


def test_tally_flushes_add_up():
    parts = [np.random.default_rng(k).integers(0, 500, 1000).astype(np.uint64) for k in range(20)]
    tally, out = suffix_tree_lm.Tally(300), Counter()
    for p in parts:
        if tally.add(p):
            keys, n = tally.merge()
            out.update(dict(zip(keys.tolist(), n.tolist())))
            tally = suffix_tree_lm.Tally(300)
    keys, n = tally.merge()
    out.update(dict(zip(keys.tolist(), n.tolist())))
    assert out == Counter(np.concatenate(parts).tolist())


def test_no_training_and_no_rows(docs, rows, empty):
    got = suffix_tree_lm.score(docs, F.lit(False)).collect()
    assert len(got) == len(rows) and {(r.train_tokens, r.n_known) for r in got} == {(0, 0)}
    assert all(r.score == pytest.approx((len(sequence(t)) - 1) * -math.log10(256)) for r in got for i, t in rows if i == r.doc_id and i not in (7, None))
    assert suffix_tree_lm.score(empty, F.lit(True)).count() == 0
