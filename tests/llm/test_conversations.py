"""Prefix tree of chats and conversation trie against plain Python."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from sitegrid.llm import chat_prefix_tree, conversation_trie, queries, turns

SCHEMA = "conv_id long, turn long, role string, text string"
ODD_TEXTS = ["", None, " ", "\\", "x\\", "</turn>", "\\</turn>", "a\n</turn>\n", "<turn:user>\n", "\\\\<turn:", "é\U0001f600 b", "\n", ">\n", "### Assistant: </turn> ok"]
ODD_ROLES = ["user", "assistant", None, "", "sys<t>em", "a\\l", "\\<", "x\ny", "\\\\g>"]


def sample(seed, n=120):
    """Conversations with shared turns, copies, odd texts and roles, ties, repeated and null turns, one long one."""
    rng = random.Random(seed)
    rows = []
    talks = [[("user", f"hello {i % 3}"), ("assistant", "well then")][: rng.randrange(1, 3)] + [(rng.choice(ODD_ROLES), rng.choice(ODD_TEXTS)) for _ in range(rng.randrange(5))] for i in range(30)]
    for c in range(n):
        talk = talks[0] if c % 3 == 0 else rng.choice(talks)
        rows += [(c, k if k or c % 5 else None, *t) for k, t in enumerate(talk)]
    rows += [(n, k, "user" if k % 2 else "assistant", f"turn {k} é") for k in range(300)]
    rows += [(n + 1, k, "user" if k % 2 else "assistant", f"turn {k} é") for k in range(299)] + [(n + 1, 299, "user", "else")]
    rows += [(n + 2, 1, "user", "tie b"), (n + 2, 1, "user", "tie a"), (n + 2, 1, "assistant", "tie"), (n + 2, 1, "assistant", "tie")]
    rows += [(2**60 + k, 0, "user", f"far {k}") for k in range(2)]
    return rows


def ordered(rows):
    talks = defaultdict(list)
    for conv, turn, role, text in rows:
        role, text = role or "", text or ""
        talks[conv].append(((turn is not None, turn or 0, role, hashlib.md5(text.encode()).hexdigest()), role, text))
    return {c: [(r, t) for _, r, t in sorted(talk)] for c, talk in talks.items()}


def table(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(5).select("*", *(F.lit("x").alias(c) for c in ("size", "path", "shard", "turns", "digest", "at", "start", "base", "h")))


def brute_trie(talks):
    """Node rows of a dict of conversations."""
    members, ends = defaultdict(list), defaultdict(list)
    for c, talk in sorted(talks.items()):
        for d in range(len(talk) + 1):
            members[tuple(talk[:d])].append(c)
        ends[tuple(talk)].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, m in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(m) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    sha = lambda ids: hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    return Counter((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], sha(ends[p])) for p, m in members.items())


def rebuilt(talks):
    out = {}
    for c, talk in talks.items():
        h = zlib.crc32(str(c).encode()) % 4
        out[c] = talks.get(c - c % 20, [])[:h] + talk[h:]
    return out


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_trie_equals_plain_code(spark, tmp_path, partitions):
    rows = sample(partitions)
    table(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        got = Counter(map(tuple, queries.op13_conversation_trie(spark, str(tmp_path)).collect()))
        paths = conversation_trie.as_paths(conversation_trie.conversation_turns(table(spark, rows)))
        direct = Counter(map(tuple, conversation_trie.trie(paths).collect()))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute_trie(rebuilt(ordered(rows)))
    assert direct == brute_trie(ordered(rows))


def test_one_conversation_many_times(spark):
    """Ids of a hot node are dealt over shards and come together in order."""
    ids = [*range(100, 3000), *range(-40, 0), 2**62]
    df = spark.createDataFrame([(c, k, "user", f"same {k}") for c in ids for k in range(2)], SCHEMA)
    paths = conversation_trie.as_paths(conversation_trie.conversation_turns(df))
    skeleton = turns.Skeleton.of(turns.splitters(paths, turns.shard_count(paths)))
    assert len({skeleton.shard_of(bytes(r.path), r.conv_id) for r in paths.collect()}) > 2
    assert Counter(map(tuple, conversation_trie.trie(paths).collect())) == brute_trie({c: [("user", "same 0"), ("user", "same 1")] for c in ids})


def test_trie_of_nothing_and_of_rows_without_id(spark, tmp_path):
    table(spark, [(None, 0, "user", "x")]).write.parquet(f"{tmp_path}/conversations.parquet")
    assert queries.op13_conversation_trie(spark, str(tmp_path)).collect() == []
    # shorter than its h and without a base: a member of the root only
    alone = next(c for c in range(21, 40) if zlib.crc32(str(c).encode()) % 4 > 1)
    table(spark, [(alone, 0, "user", "x y")]).write.mode("overwrite").parquet(f"{tmp_path}/conversations.parquet")
    assert Counter(map(tuple, queries.op13_conversation_trie(spark, str(tmp_path)).collect())) == brute_trie({alone: []})


def test_skeleton_numbers_are_depth_first():
    digest = lambda *ks: b"".join(bytes([k] * turns.WIDTH) for k in ks)
    skeleton = turns.Skeleton.of([(digest(1, 2), turns.LOWEST), (digest(1, 2), 7), (digest(1, 3), turns.LOWEST), (digest(4), turns.LOWEST)])
    assert skeleton.parent == [-1, 0, 1, 1, 0] and skeleton.last.tolist() == [4, 3, 2, 3, 4]
    assert [skeleton.shard_of(digest(1), 0), skeleton.shard_of(digest(1, 2), 6), skeleton.shard_of(digest(1, 2), 7), skeleton.shard_of(digest(9), 0)] == [0, 1, 2, 4]


def header(role):
    for a, b in chat_prefix_tree.ROLE_ESCAPES:
        role = role.replace(a, b)
    return f"<turn:{role}>\n"


def shown(role, text):
    text = text.replace("<turn:", "\\<turn:").replace("</turn>", "\\</turn>")
    return f"{header(role)}{text}\n</turn>\n"


@pytest.mark.parametrize("partitions", [1, 4, 40])
def test_stream_and_masks(spark, partitions):
    rows = sample(10 + partitions) + [(None, 0, "user", "no id"), (None, 1, "assistant", "at all")]
    talks = ordered(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        out = chat_prefix_tree.format_chats(table(spark, rows))
        segments = sorted(out.segments.collect(), key=lambda r: r.start)
        starts = {r.conv_id: r.starts for r in out.conversations.collect()}
        back = chat_prefix_tree.read_back(out).withColumn("turns", chat_prefix_tree.read_turns(F.col("stream"))).collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    # every node once, one after another
    assert len(segments) == len({tuple(t[: d + 1]) for t in talks.values() for d in range(len(t))})
    assert [s.start for s in segments] == [sum(len(x.text) for x in segments[:i]) for i in range(len(segments))]
    stream, by_start = "".join(s.text for s in segments), {s.start: s for s in segments}
    open_ = []
    for s in segments:  # depth first: a node follows its parent or what continues a sibling
        assert s.turn_no <= len(open_) and s.size == len(s.text)
        path = talks[s.conv_id][: s.turn_no + 1]
        assert open_[: s.turn_no] == path[:-1]
        open_ = path
        above = "".join(stream[a["from"] : a["to"]] for a in s.attention)
        assert above == "".join(shown(*t) for t in path[:-1]) and s.position == len(above) and s.text == shown(*path[-1])
        assert all(a["to"] < b["from"] for a, b in zip(s.attention, s.attention[1:], strict=False))
        learned = s.text[s.loss_from : s.loss_to] if s.loss_from is not None else None
        assert learned == (shown(*path[-1])[len(header("assistant")) : -len("\n</turn>\n")] if path[-1][0] == "assistant" else None)
    assert {c: "".join(by_start[x].text for x in v) for c, v in starts.items()} == {c: "".join(shown(*t) for t in v) for c, v in talks.items()}
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in back} == talks
    assert {r.conv_id: r.learned for r in back} == {c: "".join(t for r, t in v if r == "assistant") for c, v in talks.items()}


def test_no_conversations(spark):
    out = chat_prefix_tree.format_chats(table(spark, []))
    assert out.segments.count() == out.conversations.count() == chat_prefix_tree.read_back(out).count() == 0


def test_roles_to_learn(spark):
    out = chat_prefix_tree.format_chats(table(spark, [(1, 0, "user", "a"), (1, 1, "assistant", "b")]), learn=("user", "assistant"))
    assert [r.learned for r in chat_prefix_tree.read_back(out).collect()] == ["ab"]
