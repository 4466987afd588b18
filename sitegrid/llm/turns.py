"""Conversations as paths of turn digests, dealt into shards that are sorted by path.

A turn is known by the first 16 bytes of a SHA-256 over role and text, a conversation by
the digests of its turns one after another, 16 bytes each. In the order of these paths a
conversation comes before those that continue it, and all that share initial turns are
neighbours: the order of a depth-first walk through their prefix tree.

Shards are ranges of (path, conv_id), so that copies of one conversation, however many,
are dealt over several shards as well. The splitters come from a sample and are cut down
to the turns that tell them apart. A splitter path is a path of the tree; the trie of all
of them is the skeleton. A node outside of it lies in one shard with all that continues
it, since a node with members in two shards begins the splitter between them.

A conversation has to fit a row, with some 30 bytes for each turn; texts stay away.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.text import released

WIDTH = 16
#: sampled conversations per shard
SAMPLE = 8
LOWEST = -(2**63)


def role_text(df: DataFrame) -> tuple[Column, Column]:
    """Role and text; a null is empty."""
    return tuple(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))


def turn_digest(role: Column, text: Column) -> Column:
    """32 hex digits; the length of the role keeps role and text apart."""
    return F.substring(F.sha2(F.concat_ws(":", F.length(role), role, text).cast("binary"), 256), 1, 2 * WIDTH)


def turn_order(role: Column, text: Column) -> Column:
    """Order of the turns of a conversation: turn (null first), then role and a digest of the text."""
    return F.struct(F.col("turn").isNotNull().alias("named"), F.col("turn").alias("turn"), role.alias("role"), F.md5(text.cast("binary")).alias("text"))


def path_of(turns: str) -> Column:
    """The path of an array of turns with a hex `digest`."""
    return F.unhex(F.array_join(F.transform(turns, lambda t: t["digest"]), ""))


def shared_turns(a: bytes, b: bytes) -> int:
    """Initial turns that two paths share."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n // WIDTH
    x, y = (np.frombuffer(p, np.uint8, n) for p in (a, b))
    return int(np.argmax(x != y)) // WIDTH


def splitters(paths: DataFrame, shards: int) -> list[tuple[bytes, int]]:
    """Ascending (path, conv_id) that part the conversations into about `shards` ranges of like size.

    Conversations are sampled by a hash of their ids, so every run takes the same ones. A
    splitter is the shortest beginning of a sampled path that lies beyond the sample
    before it; between copies of one path the id decides."""
    drawn = paths.select("path", "conv_id").orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLE * shards)
    sample = sorted((bytes(r.path), r.conv_id) for r in drawn.collect())
    out: list[tuple[bytes, int]] = []
    chosen = sample[SAMPLE // 2 :: SAMPLE]
    for (before, _), (path, conv_id) in zip([(b"", LOWEST), *chosen], chosen, strict=False):
        if path != before:
            path, conv_id = path[: WIDTH * (shared_turns(before, path) + 1)], LOWEST
        out.append((path, conv_id))
    return sorted(set(out))


@dataclass
class Skeleton:
    """The trie of splitter paths. Nodes are numbered depth first, the root is 0.

    child: number by (parent, digest); parent and last (of the subtree) by number."""

    splitters: list[tuple[bytes, int]]
    child: dict[tuple[int, bytes], int]
    parent: list[int]
    last: np.ndarray
    depth: list[int]

    @classmethod
    def of(cls, splitters: list[tuple[bytes, int]]) -> Skeleton:
        child, parent, depth = {}, [-1], [0]
        for path, _ in splitters:
            at = 0
            for k in range(0, len(path), WIDTH):
                key = (at, path[k : k + WIDTH])
                if key not in child:
                    child[key] = len(parent)
                    parent.append(at)
                    depth.append(depth[at] + 1)
                at = child[key]
        last = np.arange(len(parent))
        for i in range(len(parent) - 1, 0, -1):
            last[parent[i]] = max(last[parent[i]], last[i])
        return cls(splitters, child, parent, last, depth)

    def shard_of(self, path: bytes, conv_id: int) -> int:
        return bisect_right(self.splitters, (path, conv_id))

    def below(self, node: int, digest: bytes) -> int:
        """The skeleton node of a turn after a skeleton node; -1 if there is none."""
        return self.child.get((node, digest), -1) if node >= 0 else -1


def shard_count(paths: DataFrame) -> int:
    """Two shards for each shuffle partition: their size then follows the cluster's setting."""
    return 2 * int(paths.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def sorted_shards(paths: DataFrame, skeleton) -> DataFrame:
    """paths (conv_id, path, more) with their shard, each shard whole in one partition and sorted by path and id.

    skeleton: a broadcast `Skeleton`."""
    schema = pa.schema([("conv_id", pa.int64()), ("path", pa.binary()), ("size", pa.list_(pa.int64())), ("shard", pa.int64())])

    def run(batches):
        find = skeleton.value.shard_of
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("conv_id", "path", "size")), pa.array([find(*k) for k in keys], pa.int64())], schema=schema)

    dealt = paths.select("conv_id", "path", "size").mapInArrow(released(run), from_arrow_schema(schema))
    return dealt.repartition("shard").sortWithinPartitions("shard", "path", "conv_id")


def walk(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int, int, bytes, list[int]]]:
    """shard, conv_id, path and size of the rows of a partition."""
    for batch in batches:
        yield from zip(*(batch.column(c).to_pylist() for c in ("shard", "conv_id", "path", "size")), strict=True)


class Rows:
    """Rows of a schema, given out as batches of bounded size."""

    def __init__(self, schema: pa.Schema, most: int = 4096):
        self.schema, self.most, self.rows = schema, most, []

    def add(self, *row) -> None:
        self.rows.append(row)

    def batches(self, rest: bool = False) -> Iterator[pa.RecordBatch]:
        if self.rows and (rest or len(self.rows) >= self.most):
            columns = zip(*self.rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, self.schema, strict=True)], schema=self.schema)
            self.rows = []
