"""Prefix trie of conversations by a splitter skeleton.

Conversations are dealt into path-sorted shards (`turns.py`) whose splitter paths form a
small trie, the skeleton, that every task has. A task goes through its shards with a
stack of open nodes: what is not in the skeleton begins and ends inside the shard and is
finished there, children first. For nodes of the skeleton a shard gives out partial sums;
these are added up over the shards, and what skeleton nodes count themselves is then added
along the skeleton's depth-first numbering. Only the skeleton's sums, a few numbers for
each of its nodes, reach the driver.

Conversations without turns end at the root. An empty table has no node, not even a root.
Null ids belong to no conversation and are left out; the path of a conversation may not be
null. Ids occur once.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.tables import gathered, written
from sitegrid.llm.text import released
from sitegrid.llm.turns import WIDTH, Rows, Skeleton, path_of, role_text, shard_count, shared_turns, sorted_shards, splitters, turn_digest, turn_order, walk

NODE, PART, ENDS = 0, 1, 2
#: ids of one row of a skeleton node's list
IDS = 4096
NO_ENDS = hashlib.sha256(b"").hexdigest()
NUMBERS = ("n_convs", "n_children", "n_leaves", "saved_tokens")

SCHEMA = pa.schema(
    [("kind", pa.int8()), ("sk", pa.int64()), ("conv_id", pa.int64()), ("depth", pa.int64()), ("parent_conv_id", pa.int64())]
    + [(c, pa.int64()) for c in (*NUMBERS, "words", "shard", "seq")]
    + [("ends_sha256", pa.string()), ("ids", pa.binary())]
)


def word_count(text):
    return F.size(F.filter(F.split(text, r"[\x20\x09-\x0D]+", -1), lambda w: w != "")).cast("long")


def conversation_turns(conversations: DataFrame) -> DataFrame:
    """conv_id and its `turns` in order: hex digest, and words of the text as `size`. Texts are not shuffled."""
    role, text = role_text(conversations)
    one = F.struct(turn_order(role, text).alias("at"), turn_digest(role, text).alias("digest"), word_count(text).alias("size"))
    grouped = conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), one.alias("t")).groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("turns"))
    return grouped.select("conv_id", F.transform("turns", lambda t: F.struct(t["digest"].alias("digest"), t["size"].alias("size"))).alias("turns"))


def as_paths(turns: DataFrame) -> DataFrame:
    """conv_id, path, and `size` of each turn."""
    return turns.select("conv_id", path_of("turns").alias("path"), F.transform("turns", lambda t: t["size"]).alias("size"))


class Node:
    """An open node. `ends` hashes the members that end here, `rows` are finished children."""

    __slots__ = ("sk", "words", "n", "low", "children", "leaves", "saved", "ends", "rows", "ids", "seq")

    def __init__(self, sk: int, words: int):
        self.sk, self.words, self.n, self.low = sk, words, 0, None
        self.children = self.leaves = self.saved = self.seq = 0
        self.ends, self.rows, self.ids = None, [], []


class Shards:
    """Goes through the shards of a partition with a stack of open nodes."""

    def __init__(self, skeleton: Skeleton):
        self.skeleton, self.out = skeleton, Rows(SCHEMA)
        self.stack: list[Node] = []
        self.shard, self.before = None, b""

    def row(self, shard: int, conv_id: int, path: bytes, words: list[int]) -> None:
        if shard != self.shard:
            self.finish()
            self.shard, self.before, self.stack = shard, b"", [Node(0, 0)]
        keep = shared_turns(self.before, path)
        while len(self.stack) > keep + 1:
            self.close()
        for k in range(keep, len(path) // WIDTH):
            sk = self.skeleton.below(self.stack[-1].sk, path[WIDTH * k : WIDTH * (k + 1)])
            self.stack.append(Node(sk, words[k]))
        self.before, top = path, self.stack[-1]
        top.n += 1
        top.low = conv_id if top.low is None else min(top.low, conv_id)
        if top.sk < 0:
            if top.ends is None:
                top.ends = hashlib.sha256(b"%d" % conv_id)
            else:
                top.ends.update(b",%d" % conv_id)
        else:
            top.ids.append(conv_id)
            if len(top.ids) >= IDS:
                self.give_ids(top)

    def give_ids(self, v: Node) -> None:
        if v.ids:
            self.out.add(ENDS, v.sk, *[None] * 8, self.shard, v.seq, None, np.array(v.ids, np.int64).tobytes())
            v.seq, v.ids = v.seq + 1, []

    def close(self) -> None:
        v, depth = self.stack.pop(), len(self.stack)
        up = self.stack[-1] if self.stack else None
        if v.sk >= 0:
            self.give_ids(v)
            self.out.add(PART, v.sk, v.low, depth, None, v.n, v.children, v.leaves, v.saved, v.words, self.shard, None, None, None)
        else:
            v.leaves = v.leaves or 1
            v.saved += (v.n - 1) * v.words
            for row in v.rows:
                self.out.add(NODE, -1, row[0], depth + 1, v.low, *row[1:5], None, None, None, row[5], None)
            ends = NO_ENDS if v.ends is None else v.ends.hexdigest()
            row = (v.low, v.n, v.children, v.leaves, v.saved, ends)
            if up.sk >= 0:
                self.out.add(NODE, up.sk, row[0], depth, None, *row[1:5], None, None, None, row[5], None)
            else:
                up.rows.append(row)
            up.children += 1
        if up is not None:
            up.n, up.leaves, up.saved = up.n + v.n, up.leaves + v.leaves, up.saved + v.saved
            up.low = v.low if up.low is None else min(up.low, v.low)

    def finish(self) -> None:
        while self.stack:
            self.close()


def trie(paths: DataFrame) -> DataFrame:
    """One row per node: conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256. paths: conv_id, path, size (words of each turn)."""
    spark = paths.sparkSession
    paths = written(paths, "paths")
    skeleton = Skeleton.of(splitters(paths, shard_count(paths)))
    shared = spark.sparkContext.broadcast(skeleton)

    def run(batches):
        shards = Shards(shared.value)
        for row in walk(batches):
            shards.row(*row)
            yield from shards.out.batches()
        shards.finish()
        yield from shards.out.batches(rest=True)

    found = written(sorted_shards(paths, shared).mapInArrow(released(run), from_arrow_schema(SCHEMA)), "nodes")
    top = skeleton_rows(found, skeleton).join(skeleton_ends(found), "sk", "left")
    top = top.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    low = F.broadcast(top.select("sk", F.col("conv_id").alias("above")))  # the skeleton is as small as the splitters
    rest = found.where(f"kind = {NODE}").join(low, "sk", "left").withColumn("parent_conv_id", F.coalesce("parent_conv_id", "above"))
    columns = ("conv_id", "depth", "parent_conv_id", *NUMBERS, "ends_sha256")
    return rest.select(*columns).unionByName(top.select(*columns))


def skeleton_rows(found: DataFrame, skeleton: Skeleton) -> DataFrame:
    """The skeleton's nodes, their parts added up over all shards."""
    sums = [F.sum(c).alias(c) for c in NUMBERS]
    parts = gathered(found.where(f"kind = {PART}").groupBy("sk").agg(F.min("conv_id").alias("conv_id"), *sums, F.max("words").alias("words")))
    size = len(skeleton.parent)
    there = np.zeros(size, bool)  # a table without rows has no node
    there[parts["sk"]] = True
    v = {c: np.zeros(size, np.int64) for c in ("conv_id", *NUMBERS, "words")}
    for c, of in v.items():
        of[parts["sk"]] = parts[c]
    parent = np.array(skeleton.parent)
    v["n_children"] += np.bincount(parent[1:], minlength=size)
    # what each node counts itself belongs to all nodes above it, whose subtrees are ranges of numbers
    for c, own in (("n_leaves", (v["n_children"] == 0).astype(np.int64)), ("saved_tokens", (v["n_convs"] - 1) * v["words"])):
        until = np.append(0, np.cumsum(own))
        v[c] += until[skeleton.last + 1] - until[:-1]
    rows = [
        (i, int(v["conv_id"][i]), skeleton.depth[i], int(v["conv_id"][parent[i]]) if i else None, *(int(v[c][i]) for c in NUMBERS))
        for i in np.flatnonzero(there).tolist()
    ]
    names = ("sk", "conv_id", "depth", "parent_conv_id", *NUMBERS)
    return found.sparkSession.createDataFrame(rows, ", ".join(f"{c} long" for c in names))


def skeleton_ends(found: DataFrame) -> DataFrame:
    """sk and the digest of the ids that end there. A SHA-256 has to be taken in one go:
    packed ids stream through one task for each node, in order of shard, and are not kept."""
    schema = pa.schema([("sk", pa.int64()), ("ends_sha256", pa.string())])

    def run(batches):
        at, digest, out = None, None, Rows(schema)
        for batch in batches:
            for sk, ids in zip(batch.column("sk").to_pylist(), batch.column("ids").to_pylist(), strict=True):
                text = ",".join(map(str, np.frombuffer(ids, np.int64).tolist())).encode()
                if sk == at:
                    digest.update(b"," + text)
                    continue
                if at is not None:
                    out.add(at, digest.hexdigest())
                at, digest = sk, hashlib.sha256(text)
                yield from out.batches()
        if at is not None:
            out.add(at, digest.hexdigest())
        yield from out.batches(rest=True)

    lists = found.where(f"kind = {ENDS}").select("sk", "shard", "seq", "ids")
    lists = lists.repartition("sk").sortWithinPartitions("sk", "shard", "seq").select("sk", "ids")
    return lists.mapInArrow(released(run), from_arrow_schema(schema))
