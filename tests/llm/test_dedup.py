"""Repeated windows of words and of bytes, and SimHash groups, against brute force."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from samples import WORDS, frame, prose
from samples import docs, empty, rows  # noqa: F401  fixtures

from sitegrid.llm import simhash, substring_dedup, suffix_dedup
from sitegrid.llm.components import components


def removed_words(rows, window):
    split = [(i, WORDS.findall(t or "")) for i, t in rows]
    least = {}
    for i, w in split:
        for k in range(len(w) - window + 1):
            key = tuple(w[k : k + window])
            if i is not None:
                least[key] = min(least.get(key, i), i)
    out = Counter()
    for i, w in split:
        gone = [False] * len(w)
        for k in range(len(w) - window + 1):
            if i is not None and least[tuple(w[k : k + window])] < i:
                gone[k : k + window] = [True] * window
        out[(i, len(w), sum(gone), " ".join(x for x, g in zip(w, gone) if not g))] += 1
    return out


@pytest.mark.parametrize("window,split", [(13, 2000), (6, 2), (13, 1)])
def test_word_windows(docs, rows, window, split):
    got = substring_dedup.remove_repeats(docs, window, split).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == removed_words(rows, window)


def removed_bytes(rows, window):
    data = [(i, (t or "").encode()) for i, t in rows]
    count = Counter(b[k : k + window] for _, b in data for k in range(len(b) - window + 1))
    out = Counter()
    for i, b in data:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - window + 1):
            if count[b[k : k + window]] > 1:
                gone[k : k + window] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[False], gone, [False]]).astype(int)))
        kept = bytes(np.frombuffer(b, np.uint8)[~gone])
        out[(i, len(b), int(gone.sum()), tuple(edges.tolist()), hashlib.sha256(kept).hexdigest())] += 1
    return out


@pytest.mark.parametrize("window,limit", [(200, 1 << 20), (200, 0), (80, 2000)])
def test_byte_strings(docs, rows, window, limit, monkeypatch):
    """limit 0 sends all buckets of a full batch through the path for large ones."""
    if limit == 0:
        monkeypatch.setattr(suffix_dedup, "BATCH", 1)
    got = suffix_dedup.remove_repeats(docs, window, limit=limit).collect()
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, tuple(r.spans), hashlib.sha256(r.kept).hexdigest()) for r in got) == removed_bytes(rows, window)
    assert all(r.n_spans * 2 == len(r.spans) for r in got)


def test_merged_order_is_the_suffix_order():
    """Two shards or more, merged, against sorting all suffixes by their symbols."""
    import random

    rng = random.Random(3)
    parts = ["".join(rng.choice("ab") for _ in range(rng.randrange(20, 60))).encode() for _ in range(30)]
    lengths = np.array([len(p) for p in parts])
    c = suffix_dedup.Collection(np.frombuffer(b"".join(parts), np.uint8), lengths, 4)
    total = np.cumsum(c.places)
    order, shared = suffix_dedup.merged(c, [0, int(total[9]), int(total[19]), int(total[-1])], 5)
    assert sorted(order) == list(range(int(total[-1])))

    def symbols(p):
        s, i = int(c.string[p]), int(c.inside[p])
        return [int(c.symbol[c.begin[s] + j]) for j in range(i, int(lengths[s]) - 3, 4)][:5]

    keys = [symbols(p) for p in order]
    assert [k for k in keys if k] == sorted(k for k in keys if k)
    for x, y, d in zip(keys, keys[1:], shared[1:].tolist()):
        if len(x) == 5 and len(y) == 5:
            assert d == next((i for i in range(5) if x[i] != y[i]), 5)


def fingerprint(text):
    w = [x.encode().translate(bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))) for x in WORDS.findall(text or "")]
    shingles = [b" ".join(w[k : k + 4]) for k in range(len(w) - 3)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def groups(fps):
    """{fingerprint: set of reachable ones}"""
    left, out = set(fps), {}
    while left:
        todo, seen = [left.pop()], set()
        while todo:
            x = todo.pop()
            seen.add(x)
            near = {y for y in left if (x ^ y).bit_count() <= 4}
            left -= near
            todo += near
        out |= {x: seen for x in seen}
    return out


def test_simhash_groups(docs, rows):
    fps = [(i, fingerprint(t)) for i, t in rows]
    reach = groups({f for _, f in fps})
    least = {f: min((i for i, g in fps if g in reach[f] and i is not None), default=None) for _, f in fps}
    got = simhash.near_duplicates(docs).collect()
    want = Counter((i, f, least[f]) for i, f in fps)
    assert Counter((r.doc_id, r.fp % 2**64, r.component_id) for r in got) == want


@pytest.mark.parametrize("limit", [256, 3, 1])
def test_links_of_small_and_large_postings(spark, limit):
    """Fingerprints in clusters and chains: links connect just what is at most four bits apart."""
    rng = np.random.default_rng(1)
    fps = set()
    for _ in range(6):
        x = int(rng.integers(0, 2**63))
        for _ in range(25):
            x ^= sum(1 << int(b) for b in rng.choice(64, rng.integers(1, 6), replace=False))
            fps.add(x)
    signed = [x - 2**64 if x >= 2**63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long").repartition(2)
    found = simhash.links(df, limit)
    for r in found.collect():
        assert ((r.a ^ r.b) % 2**64).bit_count() <= 4
    roots = {r.node % 2**64: r.root for r in components(found).collect()}
    reach = groups(fps)
    by_root = defaultdict(set)
    for node, root in roots.items():
        by_root[root].add(node)
    assert {frozenset(s) for s in by_root.values()} == {frozenset(s) for s in reach.values() if len(s) > 1}


def test_components_of_a_chain(spark):
    df = spark.range(1, 400).selectExpr("id AS a", "id + 1 AS b")
    got = components(df).collect()
    assert len(got) == 400 and len({r.root for r in got}) == 1
    assert components(df.where("false")).count() == 0


def test_empty_tables(empty):
    assert substring_dedup.remove_repeats(empty).count() == 0
    assert suffix_dedup.remove_repeats(empty).count() == 0
    assert simhash.near_duplicates(empty).count() == 0


def test_one_passage_in_many_documents(spark):
    """A hot window is split into parts and only its first document keeps it."""
    import random

    rng = random.Random(5)
    passage = prose(rng, 30)
    rows = [(i, f"{prose(rng, 5)} {passage} {prose(rng, 5)}") for i in range(300)]
    got = substring_dedup.remove_repeats(frame(spark, rows), split=10).collect()
    assert Counter((r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == removed_words(rows, 13)


def test_a_block_of_the_suffix_operator_is_small(monkeypatch):
    """Hashes of all positions of a block are held, eight bytes each."""
    import pyarrow as pa

    sizes, segments = [], suffix_dedup.segments
    monkeypatch.setattr(suffix_dedup, "segments", lambda block, window: sizes.append(len(block.data)) or segments(block, window))
    texts = ["".join(random.Random(i % 30).choices("abcd ", k=10_000)) for i in range(100)]
    batch = pa.record_batch([pa.array(range(100), pa.int64()), pa.array(texts)], names=["row", "text"])
    found = pa.Table.from_batches(suffix_dedup.anchor_rows(200)([batch])).to_pydict()
    assert sum(sizes) == 1_000_000 and max(sizes) <= 1 << 18
    by_row = {r: sorted(h for h, q in zip(found["h"], found["row"], strict=True) if q == r) for r in (3, 33, 63)}
    assert by_row[3] == by_row[33] == by_row[63] != []
