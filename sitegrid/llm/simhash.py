"""SimHash near-duplicates through an inverted index of byte positions.

A fingerprint of 64 bits is eight bytes at eight positions. Fingerprints that differ in
at most four bits differ in at most four bytes, so they share at least four positional
bytes. The index has a posting for each choice of four positions and their bytes; two
fingerprints that meet in a posting have that many shared bytes, and are verified bit
by bit. Equal fingerprints are one entry of the index.

A posting of more than `LIMIT` fingerprints is not compared pair by pair. Its members
are indexed once more under every value at most two bits away from them: two
fingerprints have such a value in common just if they differ in at most four bits.

Null and empty texts have fingerprint zero and link like others. Repeated rows get
equal results. An empty table gives an empty result. Only the id and the text are read.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from sitegrid.llm.components import components
from sitegrid.llm.tables import written
from sitegrid.llm.text import LOWER, Block, blocks, gather, released, words

SHINGLE, SEED, MAX_BITS, BYTES = 4, 42, 4, 8
SHARED = BYTES - MAX_BITS
LIMIT = 256
U64 = np.uint64


def shingle_hashes(block: Block, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """XXH64 of the shingles of each text, and the first of each text. Fewer words than a shingle are one shingle."""
    starts, ends, first = words(block)
    n = np.diff(first)
    lengths = ends - starts
    # words in lower case, one space after each, so that a shingle is one range of bytes
    spaced = gather(np.append(LOWER[block.data], np.uint8(0)), starts, lengths + 1)
    at = np.append(0, np.cumsum(lengths + 1))
    spaced[at[1:] - 1] = 0x20
    count = np.where(n >= size, n - size + 1, np.minimum(n, 1))
    until = np.append(0, np.cumsum(count))
    low = gather(np.arange(len(starts)), first[:-1], count)
    high = np.minimum(low + size, np.repeat(first[1:], count))
    raw, digest = spaced.tobytes(), xxhash.xxh64_intdigest
    h = [digest(raw[a:b], SEED) for a, b in zip(at[low].tolist(), (at[high] - 1).tolist(), strict=True)]
    return np.array(h, np.uint64), until


def fingerprints_of(h: np.ndarray, until: np.ndarray) -> np.ndarray:
    """A bit is set if it is set in more than half of a text's hashes."""
    n = np.diff(until)
    out = np.zeros(len(n), np.uint64)
    filled = np.flatnonzero(n)
    if len(filled):
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts = np.add.reduceat(bits, until[:-1][filled], axis=0, dtype=np.int32)
        out[filled] = np.packbits(2 * counts > n[filled][:, None], axis=1, bitorder="little").view(np.uint64)[:, 0]
    return out


def fingerprints(docs: DataFrame, size: int = SHINGLE, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """doc_id and fp, a signed 64-bit number, of every text."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(batches):
        for batch in batches:
            for block in blocks(batch.column(1)):
                fp = fingerprints_of(*shingle_hashes(block, size))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(block.start, block.n), pa.array(fp.view(np.int64))], schema=schema)

    as_column = lambda c: F.col(c) if isinstance(c, str) else c
    narrow = docs.select(as_column(doc_id).cast("long").alias("doc_id"), as_column(text).alias("text"))
    return narrow.mapInArrow(released(run), from_arrow_schema(schema))


MASKS = np.array([sum(0xFF << (8 * p) for p in chosen) for chosen in combinations(range(BYTES), SHARED)], np.uint64)
NEAR = np.array([0, *(1 << i for i in range(64)), *((1 << i) | (1 << j) for i, j in combinations(range(64), 2))], np.uint64)

PAIR = pa.schema([("key", pa.int64()), ("fp", pa.int64())])


def _emit(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.reshape(-1).view(np.int64)), pa.array(fps.reshape(-1).view(np.int64))], schema=PAIR)


def postings(batches):
    """The index entries of each fingerprint: its bytes at each choice of positions.

    The choice itself is mixed into the key; should two choices have one key, a posting
    only holds more to verify."""
    salt = (np.arange(len(MASKS), dtype=np.uint64) + U64(1)) * U64(0x9E3779B97F4A7C15)
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for low in range(0, len(fps), 4096):
            part = fps[low : low + 4096]
            keys = (part[:, None] & MASKS[None, :]) * U64(0xD6E8FEB86659FD93) + salt[None, :]
            yield _emit(keys ^ (keys >> U64(29)), np.repeat(part[:, None], len(MASKS), axis=1))


def neighbourhoods(batches):
    """Every value at most two bits away from each fingerprint."""
    for batch in batches:
        fps = batch.column(0).to_numpy().view(np.uint64)
        for low in range(0, len(fps), 128):
            part = fps[low : low + 128]
            yield _emit(part[:, None] ^ NEAR[None, :], np.repeat(part[:, None], len(NEAR), axis=1))


def forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the given ones connect, without those that close a circle."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (up := parent.setdefault(x, x)) != x:
            parent[x] = parent[up]
            x = up
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            parent[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


LINK = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("hot", pa.bool_())])


def compared(limit: int):
    """Links among the members of each posting; members of larger postings with hot = true.

    Rows come sorted by key. Of a posting that goes on in the next batch at most limit + 1
    members are held."""

    def links(keys: np.ndarray, fps: np.ndarray) -> pa.RecordBatch:
        begins = np.append(True, keys[1:] != keys[:-1])
        group = np.cumsum(begins) - 1
        sizes = np.bincount(group)
        hot = sizes[group] > limit
        a, b = [], []
        cold = np.flatnonzero(~hot & (sizes[group] > 1))
        f, g = fps[cold], group[cold]
        for lag in range(1, min(limit, int(sizes[g].max())) if len(g) else 0):
            same = np.flatnonzero(g[lag:] == g[:-lag])
            if not len(same):
                break
            x, y = f[same], f[same + lag]
            near = np.bitwise_count(x ^ y) <= MAX_BITS
            a.append(x[near])
            b.append(y[near])
        a, b = (np.concatenate(z) if z else f[:0] for z in (a, b))
        both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1) if len(a) else np.stack([a, b])
        found = forest(both[0].view(np.int64), both[1].view(np.int64))
        wide = np.unique(fps[hot]).view(np.int64)
        first = [x for x, _ in found] + wide.tolist()
        second = [y for _, y in found] + wide.tolist()
        return pa.RecordBatch.from_arrays([pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array([False] * len(found) + [True] * len(wide))], schema=LINK)

    def run(batches):
        held_keys, held = np.zeros(0, np.int64), np.zeros(0, np.uint64)
        for batch in batches:
            keys = np.append(held_keys, batch.column(0).to_numpy())
            fps = np.append(held, batch.column(1).to_numpy().view(np.uint64))
            if not len(keys):
                continue
            others = np.flatnonzero(keys != keys[-1])
            cut = int(others[-1]) + 1 if len(others) else 0
            tail = len(keys) - cut
            if tail > limit:  # a large posting: its members so far go out, and enough stay to know it by
                yield links(keys, fps)
                cut = len(keys) - limit - 1
            elif cut:
                yield links(keys[:cut], fps[:cut])
            held_keys, held = keys[cut:], fps[cut:]
        if len(held):
            yield links(held_keys, held)

    return run


def chained(batches):
    """Links between neighbours of equal key; rows come sorted by key."""
    last_key, last = None, None
    for batch in batches:
        keys, fps = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        if not len(keys):
            continue
        if last_key is not None:
            keys, fps = np.append(last_key, keys), np.append(last, fps)
        same = np.flatnonzero(keys[1:] == keys[:-1])
        found = forest(fps[same], fps[same + 1])
        last_key, last = keys[-1], fps[-1]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in found], pa.int64()), pa.array([y for _, y in found], pa.int64()), pa.array([False] * len(found), pa.bool_())], schema=LINK)


def links(distinct: DataFrame, limit: int = LIMIT) -> DataFrame:
    """(a, b): links that connect all fingerprints at most MAX_BITS bits apart. distinct: column fp."""
    pair, link = from_arrow_schema(PAIR), from_arrow_schema(LINK)
    index = distinct.mapInArrow(released(postings), pair).repartition("key").sortWithinPartitions("key")
    found = written(index.mapInArrow(released(compared(limit)), link), "simhash-links")
    hot = found.where("hot").select(F.col("a").alias("fp")).distinct()
    wide = hot.mapInArrow(released(neighbourhoods), pair).repartition("key").sortWithinPartitions("key")
    return found.where("NOT hot").select("a", "b").union(wide.mapInArrow(released(chained), link).select("a", "b"))


def near_duplicates(docs: DataFrame, size: int = SHINGLE, text: Column | str = "text", doc_id: Column | str = "doc_id") -> DataFrame:
    """doc_id, fp and component_id, the smallest doc_id reachable over links, for every text."""
    marked = written(fingerprints(docs, size, text, doc_id), "fingerprints")
    classes = written(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    roots = components(links(classes.select("fp")), "simhash").withColumnRenamed("node", "fp")
    joined = classes.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    least = joined.groupBy("root").agg(F.min("first").alias("component_id"))
    of_class = written(joined.join(least, "root").select("fp", "component_id"), "classes")
    return marked.join(of_class, "fp").select("doc_id", "fp", "component_id")
